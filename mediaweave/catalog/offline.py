"""A client without a network: answers are built from the text itself.

For dry runs and tests; any other object with the same three methods serves a
real job.
"""

from __future__ import annotations

import json


class OfflineClient:
    """Sentences become tags, lengths become vectors."""

    def __init__(self, dim: int = 8, failing: tuple[str, ...] = ()):
        self.dim = dim
        self.failing = failing

    def _check(self, text: str) -> None:
        if any(part in text for part in self.failing):
            raise RuntimeError("429 RESOURCE_EXHAUSTED")

    def generate(self, prompts: list[str]) -> list[str]:
        return [self._answer(p) for p in prompts]

    def _answer(self, prompt: str) -> str:
        self._check(prompt)
        sentences = prompt.split(".")
        answer = {
            "tags": sentences,
            "is_sponsorship": len(sentences) % 2,
            "brand_name": sentences[:1],
            "associated_brand": [],
            "associated_mention": prompt.split(" ")[:1],
            "video_title": sentences[0],
            "topic_tags": sentences,
            "summary": prompt,
            "sponsorship_name": sentences[:1],
        }
        return json.dumps(answer, ensure_ascii=False)

    def embed(self, texts: list[str]) -> list[list[float]]:
        for text in texts:
            self._check(text)
        return [self._vector(text) for text in texts]

    def _vector(self, text: str) -> list[float]:
        return [float(len(text)), float(text.count(",")), *[1.0] * (self.dim - 2)]

    def captions(self, video_ids: list[str]) -> list[tuple[int, str]]:
        return [self._captions(v) for v in video_ids]

    def _captions(self, video_id: str) -> tuple[int, str]:
        self._check(video_id)
        kind = ord(video_id[-1]) % 4 if video_id else 3
        if kind == 3:
            return 404, "{}"
        data = {
            "content": f"1\n00:00:01,000 --> 00:00:02,000\ntext of {video_id}",
            "language_code": ("en", "a.en", "fr")[kind],
            "language_name": "",
            "video_id": video_id,
        }
        return 200, json.dumps({"message": "", "data": data})
