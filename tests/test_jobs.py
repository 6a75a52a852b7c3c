"""The five stages with failing services and sinks, reruns, and the incremental runner."""

import json

import pytest
from pyspark.sql import functions as F

from mediaweave import schemas
from mediaweave.config import JobConfig, checked_identifier, scratch_path
from mediaweave.plans import posts, runs, summaries, tags, transcripts, vectors
from mediaweave.sources import payloads
from mediaweave.streaming.incremental import DeltaTable
from mediaweave.catalog.offline import OfflineClient
from mediaweave.sources.tables import GivenTable, VersionedTable, read_or_empty
from mediaweave.streaming.incremental import merge_handler, run_available

CONFIG = JobConfig(model_partitions=2, embed_dim=8, request_size=3)


def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def table(spark, root, name, schema, rows=()):
    made = VersionedTable(spark, f"{root}/{name}", schema)
    if rows:
        names = list(rows[0])
        df = spark.createDataFrame([tuple(r.values()) for r in rows], _schema(schema, names))
        made.replace(df.select("*", *[F.lit(None).alias(f.name) for f in schema if f.name not in names]))
    return made


def _schema(schema, names):
    from pyspark.sql.types import StructType

    return StructType([schema[n] for n in names])


def failing_client(parts, calls=None):
    """A client refusing texts with any of ``parts``; each call leaves a line in ``calls``."""

    def make():
        class Client(OfflineClient):
            def _check(self, text):
                if calls:
                    with open(calls, "a") as log:
                        log.write(text.replace("\n", " ") + "\n")
                super()._check(text)

        return Client(failing=parts)

    return make


# -- tables -------------------------------------------------------------------


def test_absent_and_partial_tables(spark):
    root = scratch_path(spark, "t")
    assert read_or_empty(spark, f"{root}/none", schemas.EMBEDDING_RECORD).count() == 0
    spark.createDataFrame([("u", "p")], "user_id string, post_id string").write.parquet(f"{root}/part")
    row = read_or_empty(spark, f"{root}/part", schemas.EMBEDDING_RECORD).first()
    assert row.user_id == "u" and row.status is None and row.embedding is None


def test_uncommitted_version_is_not_seen(spark):
    root = scratch_path(spark, "t")
    made = VersionedTable(spark, root, schemas.CHANNEL_BIOS)
    assert made.read().count() == 0 and made.version() == 0
    made.replace(spark.createDataFrame([("a",)], "channel_id string"))
    spark.createDataFrame([("lost",)], "channel_id string").write.parquet(f"{root}/v2")
    assert [r.channel_id for r in made.read().collect()] == ["a"]
    made.update(lambda old: old.unionByName(spark.createDataFrame([("b",)], "channel_id string")))
    assert sorted(r.channel_id for r in made.read().collect()) == ["a", "b"] and made.version() == 2


def test_old_versions_are_removed(spark):
    made = table(spark, scratch_path(spark, "t"), "x", schemas.CHANNEL_BIOS, [{"channel_id": "a"}])
    for name in "bcd":
        made.replace(spark.createDataFrame([(name,)], "channel_id string"))
    made.vacuum(keep=2)
    assert [r.channel_id for r in made.read().collect()] == ["d"] and made.version() == 4
    assert spark.read.parquet(f"{made.path}/v3").count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{made.path}/v2")


def test_batches_write_only_their_delta(spark):
    schema = schemas.TRANSCRIPT_INDEX
    base = table(spark, scratch_path(spark, "t"), "x", schema, [{"id": 1, "video_id": "a", "error": "old"}, {"id": 1, "video_id": "b", "error": None}])
    kept = DeltaTable(base, ["video_id"], ["id"])
    blank = {f.name: None for f in schema}
    rows = [{"id": 3, "video_id": "a", "error": "new"}, {"id": 2, "video_id": "a"}, {"id": 1, "video_id": "c"}]
    batch = spark.createDataFrame([blank | r for r in rows], schema)
    for _ in range(2):  # the same batch again replaces itself
        kept.append(batch, 7)
    assert base.version() == 1 and spark.read.parquet(kept.deltas).count() == 2
    wanted = {("a", 3, "new"), ("b", 1, None), ("c", 1, None)}
    assert {(r.video_id, r.id, r.error) for r in kept.read().collect()} == wanted
    assert {(r.video_id, r.id, r.error) for r in kept.compact().collect()} == wanted
    assert base.version() == 2 and {(r.video_id, r.id, r.error) for r in kept.read().collect()} == wanted


def test_identifiers():
    assert checked_identifier("ok_1") == "ok_1"
    for bad in ("a b", "a;", "", None):
        with pytest.raises(ValueError):
            checked_identifier(bad)


def test_object_files(spark, tmp_path):
    good = {"content": " c ", "language_code": "en"}
    (tmp_path / "a.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "b.json").write_text("[1,\n 2]")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "v 1.json").write_text(json.dumps({"content": "d"}))
    found = payloads.read_object_files(spark, str(tmp_path), "transcripts", "transcript").collect()
    got = {r.s3_key: (r.bucket, r.readable, r.content) for r in found}
    assert got == {
        "transcript/a.json": ("transcripts", True, "c"), "transcript/b.json": ("transcripts", False, ""),
        "transcript/deep/v 1.json": ("transcripts", True, "d"),
    }
    index = spark.createDataFrame([("a", "s3://transcripts/transcript/a.json"), ("x", "s3://other/transcript/a.json")], "video_id string, s3_url string")
    objects = payloads.read_object_files(spark, str(tmp_path), "transcripts", "transcript")
    rows = {r.video_id: (r.content, r.object_error) for r in payloads.attach_transcripts(index, objects, JobConfig()).collect()}
    assert rows == {"a": ("c", None), "x": (None, "OBJECT_NOT_FOUND")}


# -- stage A ------------------------------------------------------------------


def test_posts_upsert_keeps_other_columns(spark):
    root = scratch_path(spark, "a")
    videos = table(spark, root, "v", schemas.VIDEO, [{"video_id": "v1", "srt_id": 2}, {"video_id": "old", "srt_id": 1}])
    finished = table(spark, root, "f", schemas.FINISHED_CHANNEL)
    locations = spark.createDataFrame([("UCa", 1)], schemas.CHANNEL_LOCATION)
    bios = spark.createDataFrame([("UCa",)], schemas.CHANNEL_BIOS)
    day = 1740000000000
    rows = [("UCa", "v1", day, 1, None, 1, 1, 1), ("UCa", "v2", day, 1, None, 1, 1, 1), ("UCa", "v2", day + 1, 5, None, 1, 1, 1)]
    found = spark.createDataFrame(rows, schemas.POSTS)
    counted = posts.run(locations, bios, found, videos, finished, CONFIG)
    # Progress is counted in the written documents; the posts themselves are not read again.
    assert all("/documents-" in f or "/channels-" in f for f in counted.inputFiles())
    assert "publishedAt" not in counted._jdf.queryExecution().executedPlan().toString()
    progress = counted.first()
    assert (progress.saved_posts, progress.progress_pct) == (3, 100.0)
    got = {r.video_id: (r.srt_id, r.stats and r.stats.likeCount) for r in videos.read().collect()}
    assert got == {"v1": (2, 1), "v2": (None, 5), "old": (1, None)}
    again = posts.run(locations, bios, found, videos, finished, CONFIG).first()
    assert (again.total_channels, again.progress_pct) == (0, 0.0)


# -- stage B ------------------------------------------------------------------


def transcript_tables(spark, ids):
    root = scratch_path(spark, "b")
    rows = [{"_id": f"{i:03d}", "video_id": v} for i, v in enumerate(ids)]
    return transcripts.TranscriptTables(
        videos=table(spark, root, "v", schemas.VIDEO, rows),
        index=table(spark, root, "i", schemas.TRANSCRIPT_INDEX),
        failures=table(spark, root, "f", schemas.FAILED_VIDEO),
        sink_status=table(spark, root, "s", schemas.SINK_STATUS),
        staging=f"{root}/staging",
        objects=f"{root}/objects",
    )


def transcripts_counts(row, spark):
    return spark.createDataFrame([row])


def test_transcripts_and_rerun(spark, tmp_path):
    calls = str(tmp_path / "calls")
    tables = transcript_tables(spark, ["d0", "d1", "d2", "d3", "bad", None])
    counts = transcripts.run(tables, failing_client(("bad",), calls), CONFIG, now()).first()
    assert (counts.processed, counts.fetched, counts.uploaded, counts.saved_index, counts.saved_source) == (5, 4, 4, 4, 4)
    assert counts.errors == 2 and counts.status == "DONE_WITH_ERRORS"
    index = {r.video_id: (r.language_code, r.error) for r in tables.index.read().collect()}
    assert index == {"d0": ("en", ""), "d1": ("a.en", ""), "d2": ("fr", ""), "d3": ("", "HTTP 404 error")}
    srt = {r.video_id: r.srt_id for r in tables.videos.read().collect()}
    assert srt == {"d0": 1, "d1": 2, "d2": 3, "d3": 3, "bad": None, None: None}
    failed = {r.video_id for r in tables.failures.read().collect()}
    assert failed == {"d3", "bad"}
    kept = table(spark, scratch_path(spark, "k"), "runs", schemas.RUN_COUNTERS)
    for _ in range(2):
        runs.record_run(kept, transcripts_counts(counts, spark), "transcripts", "run 1")
    runs.record_run(kept, transcripts_counts(counts, spark), "transcripts", "run 2")
    total = runs.cumulative(kept).first()
    assert (total.cumulative_processed, total.cumulative_errors) == (10, 4)
    # only the failed call is made again
    again = transcripts.run(tables, failing_client((), calls), CONFIG, now()).first()
    assert (again.skipped, again.fetched) == (4, 1)
    assert sorted(open(calls).read().split()) == ["bad", "bad", "d0", "d1", "d2", "d3"]
    assert "bad" not in {r.video_id for r in tables.failures.read().collect()}
    assert payloads.read_payloads(spark, tables.objects).count() == 5


def test_failed_sink_is_caught_up(spark, monkeypatch):
    tables = transcript_tables(spark, ["d0", "d1"])
    broken = transcripts.merge_index
    monkeypatch.setattr(transcripts, "merge_index", lambda *a: (_ for _ in ()).throw(RuntimeError("no index")))
    counts = transcripts.run(tables, OfflineClient, CONFIG, now()).first()
    assert counts.status == "DONE_WITH_PENDING" and counts.saved_source == 2 and counts.saved_index == 0
    assert tables.index.read().count() == 0
    monkeypatch.setattr(transcripts, "merge_index", broken)
    transcripts.run(tables, OfflineClient, CONFIG, now())
    assert tables.index.read().count() == 2
    assert tables.sink_status.read().filter("status <> 'saved'").count() == 0
    assert payloads.stored_objects(spark, tables.objects).count() == 2


def test_source_sink_pending_although_indexed(spark, monkeypatch):
    tables = transcript_tables(spark, ["d0"])
    broken = transcripts.merge_source
    monkeypatch.setattr(transcripts, "merge_source", lambda *a: (_ for _ in ()).throw(RuntimeError("no source")))
    transcripts.run(tables, OfflineClient, CONFIG, now())
    assert tables.videos.read().first().srt_id is None
    monkeypatch.setattr(transcripts, "merge_source", broken)
    transcripts.run(tables, OfflineClient, CONFIG, now())
    assert tables.videos.read().first().srt_id == 1


def test_capped_runs_get_on(spark):
    tables = transcript_tables(spark, ["bad", "d0", "d1", "d2"])
    capped = JobConfig(model_partitions=2, max_rows=1)
    for _ in range(3):
        transcripts.run(tables, failing_client(("bad",)), capped, now())
    assert sorted(r.video_id for r in tables.index.read().collect()) == ["d0", "d1"]


def test_server_errors_stop_the_run(spark):
    def make():
        class Client(OfflineClient):
            def _captions(self, video_id):
                return (503, "{}") if video_id == "d1" else super()._captions(video_id)

        return Client()

    tables = transcript_tables(spark, ["d0", "d1"])
    counts = transcripts.run(tables, make, CONFIG, now()).first()
    assert counts.status == "STOPPED_SERVER_ERROR" and tables.index.read().count() == 0
    counts = transcripts.run(tables, OfflineClient, CONFIG, now()).first()
    assert counts.status == "DONE" and tables.index.read().count() == 2
    assert tables.failures.read().filter("video_id = 'd1' AND error <> ''").count() == 0


def test_reprocess_fetches_again(spark, tmp_path):
    calls = str(tmp_path / "calls")
    tables = transcript_tables(spark, ["d0"])
    transcripts.run(tables, failing_client((), calls), CONFIG, now())
    transcripts.run(tables, failing_client((), calls), JobConfig(model_partitions=2, reprocess=True), now())
    assert open(calls).read().split() == ["d0", "d0"]


# -- stage C ------------------------------------------------------------------


def test_summaries(spark):
    root = scratch_path(spark, "c")
    rows = [{"id": i, "video_id": v, "language_code": "en", "s3_url": f"s3://transcripts/transcript/{v}.json"} for i, v in enumerate(["v0", "v1", "v2"])]
    tables = summaries.SummaryTables(
        index=table(spark, root, "i", schemas.TRANSCRIPT_INDEX, rows),
        summaries=table(spark, root, "s", schemas.VIDEO_SUMMARY),
        failures=table(spark, root, "f", schemas.FAILED_VIDEO),
        staging=f"{root}/staging",
    )
    objects = spark.createDataFrame(
        [("transcripts", f"transcript/v{n}.json", True, c) for n, c in enumerate(("First. Second", " ", "bad text"))],
        "bucket string, s3_key string, readable boolean, content string",
    )
    counts = summaries.run(tables, objects, failing_client(("bad",)), CONFIG, now()).first()
    assert counts.status == "STOPPED_IMMEDIATE_ERROR" and counts.errors == 2
    got = {r.video_id: (r.video_title, r.topic_tags, r.error) for r in tables.summaries.read().collect()}
    assert got == {"v0": ("First", ["First", " Second"], ""), "v1": ("", [], "NO_TRANSCRIPT")}
    assert {r.video_id for r in tables.failures.read().collect()} == {"v1", "v2"}
    counts = summaries.run(tables, objects, OfflineClient, CONFIG, now()).first()
    assert counts.status == "DONE" and tables.summaries.read().count() == 3
    assert {r.video_id for r in tables.failures.read().collect()} == {"v1"}


# -- stage D ------------------------------------------------------------------

TEN = ". ".join(f"tag {c}" for c in "abcdefghij")


def tag_tables(spark, captions, tag_rows=()):
    root = scratch_path(spark, "d")
    docs = [{"_id": f"{i:024x}", "user_id": "u", "post_id": p, "locationId": 1} for i, p in enumerate(captions)]
    texts = [{"ig_user_id": "u", "ig_post_id": p, "content": c} for p, c in captions.items()]
    return tags.TagTables(
        docs=table(spark, root, "docs", schemas.IG_DOC, docs),
        captions=table(spark, root, "captions", schemas.IG_POST, texts),
        tags=table(spark, root, "tags", schemas.TOPIC_TAGS, tag_rows),
        failures=table(spark, root, "failures", schemas.TAG_FAILURE),
        staging=f"{root}/staging",
    )


def test_tags_retry_until_dead(spark):
    tables = tag_tables(spark, {"ok": TEN, "short": "only one", "bad": "bad " + TEN, "empty": "Hi"})
    reasons = [
        {r.reason: r.n for r in tags.run(tables, failing_client(("bad",)), CONFIG).collect()} for _ in range(4)
    ]
    assert reasons[0] == {"ok": 1, "not_10_tags": 1, "exception": 1, "empty_input": 1}
    assert reasons[1] == reasons[2] == {"not_10_tags": 1, "exception": 1, "empty_input": 1}
    assert reasons[3] == {"empty_input": 1}
    state = {r.key: (r.attempts, r.state) for r in tables.failures.read().collect()}
    assert state == {"u::short": (3, "dead"), "u::bad": (3, "dead")}
    assert [r.post_id for r in tables.tags.read().collect()] == ["ok"]


def test_cap_counts_tagged_posts(spark):
    captions = {f"p{i}": TEN if i % 2 else "too short" for i in range(8)}
    tables = tag_tables(spark, captions)
    capped = JobConfig(model_partitions=2, max_rows=3, max_total=2)
    got = {r.reason: r.n for r in tags.run(tables, OfflineClient, capped).collect()}
    assert got["ok"] == 2 and sorted(r.post_id for r in tables.tags.read().collect()) == ["p1", "p3"]
    tags.run(tables, OfflineClient, JobConfig(model_partitions=2, max_rows=100))
    assert tables.tags.read().count() == 4


def test_failure_is_cleared_by_success(spark):
    tables = tag_tables(spark, {"p": "bad " + TEN})
    tags.run(tables, failing_client(("bad",)), CONFIG)
    assert tables.failures.read().count() == 1
    tags.run(tables, OfflineClient, CONFIG)
    assert tables.failures.read().count() == 0 and tables.tags.read().count() == 1


def test_lost_run_does_not_repeat_calls(spark, tmp_path, monkeypatch):
    calls = str(tmp_path / "calls")
    tables = tag_tables(spark, {"p": TEN})
    whole = tags.merge_tags
    monkeypatch.setattr(tags, "merge_tags", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        tags.run(tables, failing_client((), calls), CONFIG)
    monkeypatch.setattr(tags, "merge_tags", whole)
    tags.run(tables, failing_client((), calls), CONFIG)
    assert len(open(calls).readlines()) == 1 and tables.tags.read().count() == 1


def test_repair(spark):
    good = "['" + "', '".join(f"t{i}" for i in range(10)) + "']"
    rows = [{"user_id": "u", "post_id": "bad", "topic_tags": "['a']"}, {"user_id": "u", "post_id": "fine", "topic_tags": good},
            {"user_id": "u", "post_id": "gone", "topic_tags": ""}]
    tables = tag_tables(spark, {"bad": TEN, "fine": "x"}, rows)
    counts = tags.repair(tables, OfflineClient, CONFIG).first()
    assert tuple(counts) == (1, 1)
    got = {r.post_id: r.topic_tags for r in tables.tags.read().collect()}
    assert got["fine"] == good and got["gone"] == "" and got["bad"].count("'") == 20


def test_tags_keep_copies_and_posts_without_a_caption(spark):
    tables = tag_tables(spark, {"ok": TEN, "hi": "Hi"})
    docs = [{"_id": f"{i:024x}", "user_id": u, "post_id": p, "locationId": 1} for i, (u, p) in enumerate([("u", "ok"), (" u", "ok "), ("u", "hi"), ("u", "gone"), (" ", "ok")])]
    tables.docs = table(spark, scratch_path(spark, "d"), "docs", schemas.IG_DOC, docs)
    reasons = {r.reason: r.n for r in tags.run(tables, failing_client(()), CONFIG).collect()}
    assert reasons == {"ok": 2, "empty_input": 2}
    assert [(r.user_id, r.post_id, r.topic_tags.count("'")) for r in tables.tags.read().collect()] == [("u", "ok", 20)]


def test_tags_leave_little_on_disk(spark):
    """captions were copied, texts and answers shuffled eight times, and all that stayed on disk."""
    import os

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    root, n = scratch_path(spark, "d"), 300
    words = F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.concat(F.lit("word "), F.sha2(F.concat_ws("-", "id", i), 256)))
    rows = spark.range(n).select(F.col("id").cast("string").alias("ig_post_id"), F.concat_ws(". ", words).alias("content"))
    dated = F.explode(F.array(*[F.lit(f"2024-0{m}-01").cast("timestamp") for m in (1, 2, 3)])).alias("postDate")
    captions = rows.select(F.lit("u").alias("ig_user_id"), "*", dated)
    tables = tags.TagTables(
        docs=table(spark, root, "docs", schemas.IG_DOC, [{"_id": f"{i:024x}", "user_id": "u", "post_id": str(i), "locationId": 1} for i in range(n)]),
        captions=GivenTable(captions, schemas.IG_POST),
        tags=table(spark, root, "tags", schemas.TOPIC_TAGS),
        failures=table(spark, root, "failures", schemas.TAG_FAILURE),
        staging=f"{root}/staging",
    )

    def used():
        """Bytes of shuffle files, and of what the job wrote."""
        files = disk.getAllFiles().iterator()
        kept = 0
        while files.hasNext():
            kept += files.next().length()
        return kept + sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root.removeprefix("file:")) for f in names)

    before = used()
    tags.run(tables, OfflineClient, CONFIG)
    text = rows.agg(F.sum(F.length("content"))).first()[0]
    assert tables.tags.read().count() == n and used() - before < 2 * text


# -- stage E ------------------------------------------------------------------


def vector_tables(spark, n=8, record_rows=()):
    root = scratch_path(spark, "e")
    tag_rows = [{"user_id": "u", "post_id": str(i), "topic_tags": f"['tag {i}', 'x']"} for i in range(n)]
    docs = [{"_id": f"{i:024x}", "user_id": "u", "post_id": str(i), "locationId": 1} for i in range(n - 1)]
    return vectors.VectorTables(
        tags=table(spark, root, "t", schemas.TOPIC_TAGS, tag_rows),
        docs=table(spark, root, "d", schemas.IG_DOC, docs),
        records=table(spark, root, "r", schemas.EMBEDDING_RECORD, record_rows),
        staging=f"{root}/staging",
    )


def test_vectors_and_retry(spark):
    tables = vector_tables(spark)
    first = {r.status: r.n for r in vectors.run(tables, failing_client(("tag 3",)), CONFIG, F.lit(1)).collect()}
    # requests hold up to three texts, the one with "tag 3" fails as a whole
    assert sum(first.values()) == 7 and 1 <= first["failed_embed"] <= 3
    failed = tables.records.read().filter("status = 'failed_embed'").first()
    assert failed.embed_retry_count == 1 and "429" in failed.last_error and failed.embedding is None
    second = {r.status: r.n for r in vectors.run(tables, OfflineClient, CONFIG, F.lit(2)).collect()}
    assert second == {"inserted": 7}
    docs = tables.docs.read().collect()
    assert all(len(d.embedding) == 8 and d.embedding[0] == len(f"tag {d.post_id}, x") for d in docs)


def test_cap_counts_written_vectors(spark):
    tables = vector_tables(spark, 6)
    capped = JobConfig(model_partitions=2, embed_dim=8, request_size=1, max_rows=3)
    got = {r.status: r.n for r in vectors.run(tables, failing_client(("tag 1",)), capped, F.lit(1)).collect()}
    assert got == {"inserted": 3, "failed_embed": 1}
    filled = tables.docs.read().filter("embedding IS NOT NULL")
    assert sorted(r.post_id for r in filled.collect()) == ["0", "2", "3"]


def test_wrong_dimension_is_an_error(spark):
    tables = vector_tables(spark, 3)
    got = {r.status: r.n for r in vectors.run(tables, lambda: OfflineClient(dim=5), CONFIG, F.lit(1)).collect()}
    assert got == {"failed_embed": 2}


def test_held_vectors_are_written_without_a_call(spark, tmp_path):
    calls = str(tmp_path / "calls")
    held = [{"user_id": "u", "post_id": "0", "mongo_id": f"{0:024x}", "status": "embedded", "embed_retry_count": 1,
             "mongo_write_retry_count": 0, "text": "t", "embedding": [2.0] * 8}]
    tables = vector_tables(spark, 2, held)
    vectors.run(tables, failing_client((), calls), CONFIG, F.lit(1))
    assert tables.docs.read().filter("post_id = '0'").first().embedding == [2.0] * 8
    import os

    assert not os.path.exists(calls)


def test_drain_reports_leftovers(spark):
    def record(post, mongo_id, vector):
        return {"user_id": "u", "post_id": post, "mongo_id": mongo_id, "status": "failed_mongo_write", "embed_retry_count": 1,
                "mongo_write_retry_count": 1, "text": "t", "embedding": vector}

    rows = [record("a", "xyz", [1.0]), record("b", "f" * 24, [1.0]), record("c", f"{0:024x}", None), record("d", f"{0:024x}", [1.0] * 8)]
    tables = vector_tables(spark, 2, rows)
    got = {r.status: r.n for r in vectors.drain(tables, CONFIG, F.lit(1)).collect()}
    assert got == {"failed_mongo_write": 3, "inserted": 1}
    errors = {r.post_id: r.last_error for r in tables.records.read().collect()}
    assert errors == {"a": "invalid_mongo_id", "b": "no_document_matched", "c": "missing_embedding_or_mongo_id", "d": None}


# -- incremental --------------------------------------------------------------


def test_stream_resumes_after_a_failure(spark):
    root = scratch_path(spark, "s")
    source = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    source.write.parquet(f"{root}/in")
    target = VersionedTable(spark, f"{root}/out", source.schema)
    handler = merge_handler(target, ["k"], ["v"])

    def lost(batch, batch_id):
        handler(batch, batch_id)
        raise RuntimeError("driver lost after the merge")

    with pytest.raises(Exception, match="driver lost"):
        run_available(spark, f"{root}/in", source.schema, f"{root}/cp", lost)
    run_available(spark, f"{root}/in", source.schema, f"{root}/cp", handler)
    spark.createDataFrame([("a", 5)], "k string, v int").write.mode("append").parquet(f"{root}/in")
    run_available(spark, f"{root}/in", source.schema, f"{root}/cp", handler)
    assert sorted(map(tuple, target.read().collect())) == [("a", 5), ("b", 1)]
    before = target.version()
    run_available(spark, f"{root}/in", source.schema, f"{root}/cp", handler)
    assert target.version() == before


def test_a_task_never_holds_the_answers_of_a_batch(spark):
    """the answers of a batch were collected before the first was sent on, and batches had 10,000 rows."""
    from mediaweave.sources.clients import fetch_captions, generate_answers

    class Client:
        def _answer(self):
            with open("/proc/self/statm") as f:
                return f"{f.read().split()[1]} " + "x" * 200_000

        def generate(self, prompts):
            if prompts[0] == "7":
                raise RuntimeError("429")
            return [self._answer()]

        def captions(self, video_ids):
            return [(404 if video_ids[0] == "7" else 200, self._answer())]

    asked = spark.range(1500).select(F.col("id").cast("string").alias("video_id")).withColumns({"prompt": F.col("video_id"), "request_hash": F.lit("h")})
    for ask, text in ((generate_answers, "raw"), (fetch_captions, "body")):
        answers = ask(asked, ["video_id"], Client, 1)
        pages, length = F.substring_index(text, " ", 1).cast("long"), F.length(F.substring_index(text, " ", -1))
        odd = F.col("error") == "429" if text == "raw" else F.col("status") == 404
        got = answers.agg(
            F.countDistinct("video_id").alias("n"), F.max(pages).alias("most"), F.min(pages).alias("least"),
            F.count_if(length == 200_000).alias("whole"), F.max(F.when(odd, F.col("video_id"))).alias("odd"), F.count_if(odd).alias("odds"),
        ).first()
        assert (got.n, got.whole, got.odd, got.odds) == (1500, 1499 if text == "raw" else 1500, "7", 1)
        assert (got.most - got.least) * 4096 < 150 << 20
    for key, most in (("maxRecordsPerBatch", 2000), ("maxBytesPerBatch", 8 << 20)):
        assert int(spark.conf.get(f"spark.sql.execution.arrow.{key}")) <= most
