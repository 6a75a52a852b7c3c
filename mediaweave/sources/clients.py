"""Outside services: a small client protocol run inside Spark tasks.

A client factory is called once per task, so a client may hold connections.
Retries, pauses and authentication are the client's business.  What a service
answered is staged before anything else happens, because Spark may run a task
again and calls are paid for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from ..config import JobConfig
from ..operators.ranking import numbered
from .tables import StagedResults


#: Characters of requests and answers, and rows, that a task holds before it sends them on.
PIECE_CHARS, PIECE_ROWS = 1 << 20, 1000


class ModelClient(Protocol):
    def generate(self, prompts: list[str]) -> list[str]: ...

    def embed(self, texts: list[str]) -> list[list[float]]: ...

    def captions(self, video_ids: list[str]) -> list[tuple[int, str]]: ...


ClientFactory = Callable[[], ModelClient]


def _with(df: DataFrame, keys: list[str], *fields: StructField) -> StructType:
    return StructType([*[df.schema[k] for k in keys], *fields])


def _text_field(name: str) -> StructField:
    return StructField(name, StringType())


def answer_schema(df: DataFrame, keys: list[str]) -> StructType:
    return _with(df, keys, *[_text_field(n) for n in ("request_hash", "raw", "error")])


def captions_schema(df: DataFrame, keys: list[str]) -> StructType:
    return _with(
        df, keys, _text_field("request_hash"), StructField("status", IntegerType()),
        _text_field("body"), _text_field("error"),
    )


def vector_schema(df: DataFrame, keys: list[str]) -> StructType:
    return _with(
        df, keys, _text_field("request_hash"), _text_field("batch_id"),
        StructField("n_inputs", IntegerType()), StructField("n_vectors", IntegerType()),
        StructField("embedding", ArrayType(DoubleType())), _text_field("error"),
    )


def request_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def _spread(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """Even, repeatable partitions: the keys are unique, so no partition is hot."""
    return df.repartition(partitions, *keys)


def _answered(rows: pd.DataFrame, asked: list[str], answers: Iterable[tuple], fields: dict[str, str]) -> Iterator[pd.DataFrame]:
    """The rows with their answers' ``fields`` (name and type), in pieces of bounded size.

    Answers are asked for one by one, so a task never holds those of a whole batch.
    """
    got, size, start = [], 0, 0

    def piece() -> pd.DataFrame:
        part = rows.iloc[start : start + len(got)]
        return part.assign(**{
            name: pd.Series([g[n] for g in got], dtype=kind, index=part.index) for n, (name, kind) in enumerate(fields.items())
        })

    for request, answer in zip(asked, answers):
        got.append(answer)
        size += sum(len(x) for x in (request, *answer) if isinstance(x, str))
        if size >= PIECE_CHARS or len(got) >= PIECE_ROWS:
            yield piece()
            start, got, size = start + len(got), [], 0
    if got:
        yield piece()


def generate_answers(
    prompts: DataFrame, keys: list[str], factory: ClientFactory, partitions: int
) -> DataFrame:
    """One answer or error per prompt."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()

        def one(prompt: str) -> tuple[str | None, str | None]:
            try:
                return client.generate([prompt])[0], None
            except Exception as problem:
                return None, str(problem) or type(problem).__name__

        for rows in batches:
            asked = rows.pop("prompt").tolist()
            yield from _answered(rows, asked, map(one, asked), {"raw": "object", "error": "object"})

    wanted = prompts.select(*keys, "request_hash", "prompt")
    return _spread(wanted, keys, partitions).mapInPandas(call, answer_schema(prompts, keys))


def fetch_captions(
    videos: DataFrame, keys: list[str], factory: ClientFactory, partitions: int
) -> DataFrame:
    """Status and body of the captions response per video, or the error text."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()

        def one(video_id: str) -> tuple[int, str | None, str | None]:
            try:
                status, body = client.captions([video_id])[0]
                return status, body, None
            except Exception as problem:
                return 0, None, str(problem) or type(problem).__name__

        for rows in batches:
            asked = rows["video_id"].tolist()
            yield from _answered(rows, asked, map(one, asked), {"status": "int32", "body": "object", "error": "object"})

    wanted = videos.select(*keys, "request_hash")
    return _spread(wanted, keys, partitions).mapInPandas(call, captions_schema(videos, keys))


def embed_texts(
    texts: DataFrame,
    keys: list[str],
    factory: ClientFactory,
    partitions: int,
    request_size: int,
    dim: int,
) -> DataFrame:
    """Vectors of requests of up to ``request_size`` texts.

    Texts share a request by their place in key order.  A wrong number of vectors or a vector of
    another length is an error of the whole request; what came back is staged all the same.
    """
    names = [*keys, "request_hash"]

    def requests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole requests; the rows of one lie together, a batch may end within it."""
        held = None
        for rows in batches:
            held = rows if held is None else pd.concat([held, rows], ignore_index=True)
            last = held["_request"].iloc[-1]
            for number, part in held[held["_request"] != last].groupby("_request", sort=True):
                yield part
            held = held[held["_request"] == last]
        if held is not None and len(held):
            yield held

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for rows in requests(batches):
            inputs = rows["prompt"].tolist()
            try:
                vectors, error = client.embed(inputs), None
                lengths = {len(v) for v in vectors}
                if len(vectors) != len(inputs) or lengths - {dim}:
                    error = f"got {len(vectors)} vectors of {sorted(lengths)}"
            except Exception as problem:
                vectors, error = [], str(problem) or type(problem).__name__
            aligned = [*vectors[: len(inputs)], *[None] * (len(inputs) - len(vectors))]
            yield rows[names].assign(
                batch_id=hashlib.sha256("".join(f"{x}" for row in rows[names].itertuples(index=False) for x in row).encode()).hexdigest(),
                n_inputs=pd.Series(len(inputs), dtype="int32", index=rows.index),
                n_vectors=pd.Series(len(vectors), dtype="int32", index=rows.index),
                embedding=pd.Series(aligned, dtype="object", index=rows.index),
                error=error,
            )

    wanted = request_groups(texts.select(*names, "prompt"), keys, request_size, "_request")
    placed = wanted.repartition(partitions, "_request").sortWithinPartitions("_request", *keys)
    return placed.mapInPandas(call, vector_schema(texts, keys))


def request_groups(texts: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """Add ``name``: the number of the request that a text belongs to, ``size`` texts in key order each.

    The numbers come from the keys alone, so that a request holds the same texts however they are
    partitioned, and one that fails fails the same texts.
    """
    placed = numbered(texts, [F.col(k).asc() for k in keys], "_nth")
    return placed.withColumn(name, F.floor(F.col("_nth") / size)).drop("_nth")


def stage_once(
    requests: DataFrame,
    keys: list[str],
    staged: StagedResults,
    call: Callable[[DataFrame, int], DataFrame],
    config: JobConfig,
    usable: Column | None = None,
    read: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Answers for ``requests`` (keys, request_hash, prompt); only missing ones are called.

    A request without a ``usable`` answer (one without an error) is called again.  Partitions and
    commits are sized by the number of open requests, so a lost task repeats a
    bounded number of calls and a lost run at most one commit's worth.  ``read`` takes from each
    staged row what the caller needs, before rows are shuffled to find the best answer.
    """
    names = [*keys, "request_hash"]
    good = F.col("error").isNull() if usable is None else usable

    def missing() -> DataFrame:
        known = staged.read().filter(good)
        return requests.join(known.select(*names).distinct(), names, "left_anti")

    count = missing().count()
    waves = max(1, -(-count // config.requests_per_commit))
    per_wave = -(-count // waves)
    partitions = max(config.model_partitions, -(-per_wave // config.requests_per_task))
    for wave in range(waves if count else 0):
        todo = missing()
        if waves > 1:
            todo = todo.filter(F.pmod(F.xxhash64(*names), F.lit(waves)) == wave)
        staged.append(call(todo, partitions))
    answers = staged.read() if read is None else read(staged.read())
    return requests.select(*names).join(best_answers(answers, names, good), names, "inner")


def best_answers(answers: DataFrame, names: list[str], usable: Column | None = None) -> DataFrame:
    """One staged answer per request: a usable one, else one without an error, else any."""
    rest = [c for c in answers.columns if c not in names]
    clean = F.col("error").isNull()
    rank = F.struct(F.coalesce(clean if usable is None else usable, F.lit(False)), clean, F.col("error"))
    best = answers.groupBy(*names).agg(F.max_by(F.struct(*rest), rank).alias("_answer"))
    return best.select(*names, *[F.col(f"_answer.{c}").alias(c) for c in rest])
