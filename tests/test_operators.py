"""Operators against brute force, with hot keys and copies."""

import random

import pytest
from pyspark.sql import functions as F

from mediaweave.operators import candidates, ledger, lookups, metrics, vectors
from mediaweave.operators.merge import keyed_union, last_wins, merge, usable_key
from mediaweave.operators.ranking import first_rows, first_rows_by_group, running_total


@pytest.fixture(scope="module")
def posts(spark):
    """A third of all posts in one channel, many of them copies of one post that differ in the counters only."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        channel = "c050" if i % 3 == 0 else f"c{rng.randrange(100):03d}"
        copy = channel == "c050" and i % 2 == 0
        counters = [rng.choice([None, 0, 1, 2]) for _ in candidates.COUNTERS]
        rows.append((channel, "same" if copy else f"v{rng.randrange(2000)}", 77 if copy else rng.randrange(50), i, *counters))
    counted = ", ".join(f"{c} bigint" for c in candidates.COUNTERS)
    df = spark.createDataFrame(rows, f"channel_id string, video_id string, publishedAt bigint, n int, {counted}")
    return rows, df


def nulls_first(values):
    return [(v is not None, v or 0) for v in values]


def keys(rows):
    return sorted((r[0], r[1], r[2], *nulls_first(r[4:])) for r in rows)


@pytest.mark.parametrize("small", [10_000, 0])
@pytest.mark.parametrize("cap", [1, 40, 1400, 1900, 2999, 3000, 5000])
def test_capped_posts(posts, small, cap):
    rows, df = posts
    wanted = sorted(rows, key=lambda r: (r[0], -r[2], r[1], *nulls_first(r[4:])))[:cap]
    got = candidates.capped_posts(df, cap, small=small).collect()
    assert keys(got) == keys(wanted)
    assert len({r.n for r in got}) == len(got)


def test_no_cap(posts):
    assert candidates.capped_posts(posts[1], 0) is posts[1]


@pytest.mark.parametrize("limit", [0, 1, 999, 3000, 4000])
def test_first_rows_of_a_wide_limit(posts, limit, monkeypatch):
    monkeypatch.setattr("mediaweave.operators.ranking.SMALL_LIMIT", -1)
    rows, df = posts
    wanted = sorted(rows, key=lambda r: (r[2], r[1]))[:limit]
    got = first_rows(df, [F.col("publishedAt"), F.col("video_id")], limit).collect()
    assert sorted((r[2], r[1]) for r in got) == sorted((r[2], r[1]) for r in wanted)


def test_running_total(posts):
    rows, df = posts
    got = running_total(df.select("n"), [F.col("n")], "n", "before").collect()
    assert all(r.before == r.n * (r.n - 1) // 2 for r in got) and len(got) == len(rows)


def test_whole_groups_pass_without_sorting(posts):
    got = first_rows_by_group(posts[1], "channel_id", candidates.newest_first(), 10**9, 0)
    assert got.count() == 3000


def test_last_wins_of_a_hot_key(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("seq"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("v"),
    )
    got = {r.k: (r.seq, r.v) for r in last_wins(df, ["k"], ["seq"]).collect()}
    wanted = {}
    for r in df.orderBy("seq").collect():
        wanted[r.k] = (r.seq, r.v)
    assert got == wanted


def test_last_wins_combines_before_the_shuffle(spark):
    plan = last_wins(spark.range(100).withColumn("v", F.lit("x")), ["id"], ["v"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in text and "Window" not in text


def _target(spark):
    return spark.createDataFrame(
        [("a", "1", "x"), ("b", "2", "y"), (None, "3", "z"), (None, "4", "w")], "k string, v string, other string"
    )


def test_merge_sets_inserts_and_keeps(spark):
    updates = spark.createDataFrame([("a", None), ("c", "9")], "k string, v string")
    got = merge(_target(spark), updates, ["k"], touch={"other": F.lit("touched")})
    rows = sorted(got.collect(), key=str)
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("a", None, "touched"), ("b", "2", "y"), ("c", "9", None), (None, "3", "z"), (None, "4", "w")], key=str
    )
    assert got.columns == ["k", "v", "other"]


def test_merge_twice_is_merge_once(spark):
    updates = spark.createDataFrame([("a", "7"), ("c", "9")], "k string, v string")
    once = merge(_target(spark), updates, ["k"])
    twice = merge(once, updates, ["k"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_rows_without_a_key_are_spread(spark):
    updates = spark.createDataFrame([("a", "7"), ("c", "9")], "k string, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for insert in (True, False):
            plan = merge(_target(spark), updates, ["k"], insert=insert)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("hashpartitioning(k") == 2 and plan.count("_spread#") and ", _spread#" in plan.split("hashpartitioning(k")[1][:30]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_limit_is_cut_before_the_shuffle(posts):
    top = first_rows(posts[1], [F.col("publishedAt"), F.col("n")], 5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert [r.n for r in top.collect()] == [r[3] for r in sorted(posts[0], key=lambda r: (r[2], r[3]))[:5]]


def test_update_only_never_inserts(spark):
    updates = spark.createDataFrame([("a", "7"), ("c", "9")], "k string, v string")
    got = merge(_target(spark), updates, ["k"], insert=False)
    assert got.count() == 4 and got.filter("k = 'a'").first().v == "7"


def test_keyed_union(spark):
    old = spark.createDataFrame([("a", 5), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2)], "k string, v int")
    assert sorted(map(tuple, keyed_union(old, new, ["k"], ["v"]).collect())) == [("a", 2), ("b", 1)]


def test_lookup_is_broadcast_only_within_its_bound(spark):
    large = spark.range(1000).select((F.col("id") % 10).alias("k"))
    small = spark.range(5).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        within = lookups.checked_lookup(large, small, ["k"], "left_semi", 5)
        beyond = lookups.checked_lookup(large, small, ["k"], "left_semi", 4)
        plans = [d._jdf.queryExecution().executedPlan().toString() for d in (within, beyond)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
    assert within.count() == beyond.count() == 500


def test_hot_join_partition_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        docs = spark.range(60000, numPartitions=16).select(
            F.when(F.col("id") % 3 == 0, "u").otherwise(F.col("id").cast("string")).alias("user_id"),
            F.lit("p").alias("post_id"), F.col("id").cast("string").alias("_id"),
        )
        captions = docs.select("user_id", "post_id").distinct().withColumn("content", F.lit("x"))
        joined = candidates.attach_captions(docs, captions)
        # the count runs the join; its final plan shows how
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(rows) == 60000 and "skew=true" in plan


def test_eligible_channels(spark):
    locations = spark.createDataFrame(
        [("UCa", 1), ("UCa", 1), ("XXb", 1), ("UCx", 1), (None, 1), ("UCc", 2), ("UCd", 1), ("ucz", 1)],
        "youtube_channel_id string, locationId int",
    )
    bios = spark.createDataFrame([(c,) for c in ("UCa", "UCa", "UCx", "UCc", "XXb", "ucz")], "channel_id string")
    got = candidates.eligible_channels(locations, bios, 1, ("UCx",)).collect()
    assert [r.channel_id for r in got] == ["UCa"]


def test_last_second_of_the_range(spark):
    end = 1735689599000  # 2024-12-31T23:59:59.000Z
    rows = [("UCa", f"v{i}", t, 1, None, 1, 1, 1) for i, t in enumerate([end, end + 1, end - 999, 1704067200000, 1704067199999])]
    posts = spark.createDataFrame(
        rows, "channel_id string, video_id string, publishedAt bigint, likeCount bigint, dislikeCount bigint, "
        "commentCount bigint, viewCount bigint, favoriteCount bigint",
    )
    channels = spark.createDataFrame([("UCa",)], "channel_id string")
    for bound in (10, 0):
        got = candidates.posts_in_range(posts, channels, "2024-01-01", "2024-12-31", (), bound)
        assert sorted(r.video_id for r in got.collect()) == ["v0", "v2", "v3"]


def test_transcripts_to_summarise(spark):
    index = spark.createDataFrame(
        [(1, "a", "en", "u"), (2, "", "en", "u"), (3, "c", "zh", "u"), (4, "d", "a.en", ""), (5, "e", "a.en", "u"), (6, None, "en", "u"), (7, "g", "en", None)],
        "id bigint, video_id string, language_code string, s3_url string",
    )
    done = spark.createDataFrame([("a",)], "video_id string")
    assert [r.video_id for r in candidates.transcripts_to_summarise(index, done).collect()] == ["e"]
    again = candidates.transcripts_to_summarise(index, done, reprocess=True).collect()
    assert sorted(r.video_id for r in again) == ["a", "e"]


def test_video_filters(spark):
    videos = spark.createDataFrame([("1", "a"), ("2", ""), ("3", None), ("4", "b"), ("5", "c")], "_id string, video_id string")
    index = spark.createDataFrame([("a", "url", ""), ("b", "  ", ""), ("c", "url", "HTTP 404 error")], "video_id string, s3_url string, error string")
    ids = lambda df: sorted(r.video_id for r in df.collect())
    assert ids(candidates.videos_to_fetch(videos, index)) == ["", "b"]
    assert ids(candidates.videos_to_fetch(videos, index, redo_failed=True)) == ["", "b", "c"]
    assert ids(candidates.videos_to_fetch(videos, index, reprocess=True)) == ["", "a", "b", "c"]
    marked = candidates.videos_marked_done(candidates.videos_with_id(videos), index)
    assert {r.video_id: r.done for r in marked.collect()} == {"": False, "a": True, "b": False, "c": True}


def test_latest_captions(spark):
    rows = [(1, 2, "old", "2024-01-01"), (1, 2, "new", "2024-02-01"), (1, 3, "undated", None), (1, 4, None, "2024-01-01"),
            (1, 4, "earlier", "2023-01-01"), (1, 5, "u", None), (1, 5, "dated", "2020-01-01")]
    posts = spark.createDataFrame(rows, "ig_user_id int, ig_post_id int, content string, postDate string").withColumn("postDate", F.to_timestamp("postDate"))
    got = {r.post_id: r.content for r in candidates.latest_captions(posts).collect()}
    assert got == {"2": "new", "3": "undated", "4": "", "5": "dated"}


def test_old_captions_are_left_out_before_the_shuffle(spark):
    """every version of every caption was shuffled to find the newest of some."""
    at = F.when(F.col("v") > 0, F.timestamp_seconds(F.col("v") * 1000)).alias("postDate")
    posts = spark.range(4000).crossJoin(spark.range(5).withColumnRenamed("id", "v")).select(
        F.lit("u").alias("ig_user_id"), (F.col("id") % 3000).cast("string").alias("ig_post_id"),
        F.concat_ws("-", "id", "v").alias("content"), F.when(F.col("id") % 7 > 0, at).alias("postDate"),
    )
    wanted = spark.range(2000).select(F.lit(" u").alias("user_id"), F.col("id").cast("string").alias("post_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = candidates.latest_captions(posts, wanted=wanted)
        got = {r.post_id: r.content for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString().split("Final Plan")[1].split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    newest = {}
    for i in range(4000):
        for v in range(5):
            rank = ((v * 1000 if v and i % 7 else -1), f"{i}-{v}")
            if i % 3000 < 2000:
                newest[str(i % 3000)] = max(newest.get(str(i % 3000), rank), rank)
    assert got == {k: content for k, (_, content) in newest.items()}
    assert "hashpartitioning" not in plan.split("getbit(")[1].split("BroadcastExchange")[0]


def test_perhaps_among_loses_no_wanted_row(spark):
    large = spark.range(20000).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("k"), F.lit("x").alias("t"))
    wanted = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    got = [r.k for r in lookups.perhaps_among(large, ["k"], wanted).collect()]
    assert {k for k in range(1000) if k % 9} | {None} <= set(got) and got.count(None) == large.filter("k IS NULL").count()
    assert len(set(got)) < 5000
    assert lookups.perhaps_among(large, ["k"], wanted.limit(0)).count() == 0


def test_attach_keeps_copies_and_drops_blank_keys(spark):
    docs = spark.createDataFrame([("1", "u", "p"), ("2", "u ", "p"), ("3", " ", "p"), ("4", "x", "y")], "_id string, user_id string, post_id string")
    captions = spark.createDataFrame([("u", "p", "text")], "user_id string, post_id string, content string")
    got = {r._id: r.content for r in candidates.attach_captions(docs, captions).collect()}
    assert got == {"1": "text", "2": "text", "4": ""}
    assert candidates.pairs_with_captions(docs, captions).count() == 2


def test_text_key_pages(spark):
    df = spark.createDataFrame([(u, p) for u in ("10", "9", "100") for p in ("1", "2")], "user_id string, post_id string")
    page = candidates.key_page(df, ["user_id", "post_id"], ["10", "1"], 3)
    assert sorted(map(tuple, page.collect())) == [("10", "2"), ("100", "1"), ("100", "2")]
    assert candidates.key_page(df, ["user_id"], None, 0).count() == 6


def test_bad_tag_text(spark):
    ten = "['" + "', '".join("abcdefghij") + "']"
    df = spark.createDataFrame([(t,) for t in (None, "", "[]", ten, "['a']", "x")], "t string")
    assert [r[0] for r in df.select(candidates.is_bad_tag_text(F.col("t"))).collect()] == [True, True, True, False, True, True]


def test_attempts_add_up_and_die(spark):
    before = spark.createDataFrame([("a", 2, "failed"), ("b", 1, "failed"), ("c", 3, "dead")], "key string, attempts int, state string")
    failures = spark.createDataFrame([("a",), (" a ",), ("d",), ("",)], "key string")
    got = {r.key: (r.attempts, r.state) for r in ledger.count_attempts(before, failures, 3).collect()}
    assert got == {"a": (4, "dead"), "b": (1, "failed"), "c": (3, "dead"), "d": (1, "failed")}


def test_records_pruned_to_the_newest(spark):
    rows = [("u", str(i), "inserted", i // 2) for i in range(10)] + [("u", "f", "failed_embed", 0), ("u", "n", None, 0)]
    records = spark.createDataFrame(rows, "user_id string, post_id string, status string, updated_at bigint")
    kept = ledger.prune_inserted(records, 3)
    assert sorted(r.post_id for r in kept.collect()) == ["7", "8", "9", "f", "n"]
    assert ledger.prune_inserted(records, -1) is records


def test_retry_lane_first(spark):
    one = spark.createDataFrame([("u", "1")], "user_id string, post_id string")
    both = spark.createDataFrame([("u", "1"), ("u", "2")], "user_id string, post_id string")
    got = sorted(map(tuple, ledger.retry_and_fresh(one, both, ["user_id", "post_id"]).collect()))
    assert got == [("u", "1", "retry"), ("u", "2", "fresh")]


def test_one_bad_vector_fails_its_request(spark):
    rows = [("u", "1", "b1", 2, 2, [1.0, 2.0], None), ("u", "2", "b1", 2, 2, [1.0], None), ("u", "3", "b2", 1, 1, [1.0, 2.0], None),
            ("u", "4", "b3", 2, 1, [1.0, 2.0], None), ("u", "5", "b3", 2, 1, None, None), ("u", "6", "b4", 1, 0, None, "429")]
    answers = spark.createDataFrame(
        rows, "user_id string, post_id string, batch_id string, n_inputs int, n_vectors int, embedding array<double>, error string"
    )
    got = {r.post_id: (r.vector, r.error is None) for r in vectors.check_answers(answers, 2).collect()}
    assert got == {"1": (None, False), "2": (None, False), "3": ([1.0, 2.0], True), "4": (None, False), "5": (None, False), "6": (None, False)}


def test_overwrite_ignores_stored_vectors(spark):
    texts = spark.createDataFrame([("u", "1", "t")], "user_id string, post_id string, tag_text string")
    records = spark.createDataFrame([], "user_id string, post_id string, status string")
    docs = spark.createDataFrame([("a" * 24, "u", "1", 1, [1.0, 2.0])], "_id string, user_id string, post_id string, locationId int, embedding array<double>")
    here = vectors.location_docs(docs, 1, 2)
    assert vectors.dispositions(texts, records, here).first().disposition == "embedding_exists_in_mongo"
    assert vectors.dispositions(texts, records, here, True).first().disposition == "needs_embedding"


def test_progress_without_channels(spark):
    none = spark.createDataFrame([], "channel_id string")
    assert tuple(metrics.channel_progress(none, none).first()) == (0, 0, 0, 0.0)


def test_rates_and_status(spark):
    row = spark.range(1).select(
        metrics.rate_per_minute(F.lit(7), F.lit(0)).alias("rate"),
        metrics.remaining(F.lit(7), F.lit(100), (0, 50)).alias("left"),
        metrics.eta_seconds(F.lit(0), F.lit(9), F.lit(5)).alias("eta"),
        metrics.transcript_status(F.lit(True), F.lit(1), F.lit(1)).alias("a"),
        metrics.transcript_status(F.lit(False), F.lit(1), F.lit(1)).alias("b"),
        metrics.summary_status(F.lit(False), F.lit(0)).alias("c"),
    ).first()
    assert tuple(row) == (420.0, 43, None, "STOPPED_SERVER_ERROR", "DONE_WITH_PENDING", "DONE")


def test_reasons_without_a_name(spark):
    df = spark.createDataFrame([("ok",), ("ok",), (None,), ("",)], "reason string")
    assert {r.reason: r.n for r in metrics.reason_histogram(df).collect()} == {"ok": 2, "unknown": 2}


def test_cap_of_successes(spark):
    rng = random.Random(3)
    rows = [(i, rng.random() < 0.3) for i in range(500)]
    df = spark.createDataFrame(rows, "place long, ok boolean").repartition(5)
    for cap in (0, 1, 40, 10_000):
        wanted, hits = [], 0
        for place, ok in rows:
            if cap and hits >= cap:
                break
            wanted.append(place)
            hits += ok
        assert sorted(r.place for r in ledger.until_successes(df, "place", F.col("ok"), cap).collect()) == wanted
    pages = list(ledger.success_pages(3, 50))
    assert pages == [(0, 3), (3, 9), (9, 21), (21, 45), (45, 50)] and not list(ledger.success_pages(3, 0))


def test_places_in_order(spark, posts):
    from mediaweave.operators.ranking import numbered

    got = numbered(posts[1], [F.col("publishedAt"), F.col("n")], "at").orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(3000))
    assert [(r.publishedAt, r.n) for r in got] == sorted((r[2], r[3]) for r in posts[0])


def test_keyless_rows_stay_out_of_the_join(spark):
    """A third of the target is blank; no task of the join gets more than twice the median."""
    rows = [("" if i % 3 == 0 else f"k{i}", i) for i in range(9000)]
    target = spark.createDataFrame(rows, "k string, v int")
    updates = spark.createDataFrame([("k1", -1), (" ", -2), (None, -3), ("new", -4)], "k string, v int")
    got = sorted(tuple(r) for r in merge(target, updates, ["k"]).collect() if r.k and r.k.strip())
    assert got == sorted([(k, -1 if k == "k1" else v) for k, v in rows if k] + [("new", -4)])
    keyless = sorted((r.v, r.k) for r in merge(target, updates, ["k"]).collect() if not (r.k and r.k.strip()))
    assert [v for v, _ in keyless] == [-3, -2] + [v for k, v in rows if not k]
    assert merge(target, updates, ["k"], insert=False).count() == 9000
    joined = target.filter(usable_key(target, ["k"])).repartition(8, "k")
    sizes = sorted(r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_requests_hold_the_same_texts(spark):
    from mediaweave.sources.clients import embed_texts, request_groups, request_hash

    texts = spark.range(250).select(F.lit("u").alias("user_id"), F.lpad(F.col("id").cast("string"), 4, "0").alias("post_id"))
    texts = texts.withColumn("prompt", F.concat(F.lit("text "), "post_id")).withColumn("request_hash", request_hash(F.col("prompt")))

    class Client:
        def embed(self, inputs):
            if "text 0123" in inputs:
                raise RuntimeError("429")
            return [[1.0, 2.0]] * len(inputs)

    seen = set()
    for parts in (1, 7, 64):
        spread = texts.repartition(parts)
        groups = frozenset((r.post_id, r.g) for r in request_groups(spread, ["user_id", "post_id"], 40, "g").collect())
        answers = embed_texts(spread, ["user_id", "post_id"], Client, parts, 40, 2).collect()
        failed = frozenset(r.post_id for r in answers if r.error)
        assert len(answers) == 250 and failed == {f"{i:04d}" for i in range(120, 160)}
        seen.add((groups, failed, frozenset(r.batch_id for r in answers)))
    assert len(seen) == 1 and len({b for _, _, batches in seen for b in batches}) == 7
