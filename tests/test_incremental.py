"""Bucketed tables, partial rewrites, change feeds, and the search indexes that skip what cannot matter."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.operators import dense_index, gold, gold_feed, partial, postings, search, staging, state
from hirelake.plans import batch, incremental
from hirelake.sources.buckets import Buckets, pairs

NOW = dt.datetime(2024, 5, 10, 12)


def silver_rows(spark, n, **fixed):
    base = dict.fromkeys(S.SILVER.names)
    rows = []
    for i in range(n):
        row = base | {
            "job_id": f"j{i}", "job_url": f"u{i}", "source": S.SITE_A_SILVER if i % 2 else S.SITE_B_SILVER, "status": S.ACTIVE,
            "job_level": ["Senior", "Unknown", "Junior"][i % 3], "ai_job_role": ["Backend", "Mobile", "Unknown"][i % 3],
            "min_years_of_experience": i % 4 or None, "ai_core_tech_stack": ['["a", "b", "a"]', "[]", '["b", ""]', None][i % 4],
            "processed_at": NOW - dt.timedelta(days=9), "last_seen_at": NOW - dt.timedelta(days=i % 9),
        }
        rows.append(tuple((row | fixed)[c] for c in S.SILVER.names))
    return spark.createDataFrame(rows, S.SILVER)


def rows_of(df):
    return sorted(map(tuple, df.select(*S.SILVER.names).collect()), key=str)


def files(table):
    return {p: p.stat().st_mtime_ns for p in Path(table.rows_path).rglob("*.parquet")}


@pytest.fixture
def table(spark, tmp_path):
    return Buckets(spark, str(tmp_path / "silver"), S.SILVER, ["job_id"], 16).load(silver_rows(spark, 60))


def opened_files(df):
    assert "PartitionFilters: [" in (plan := df._jdf.queryExecution().executedPlan().toString()) and "PartitionFilters: []" not in plan
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def bucket_of(path):
    return int(str(path.parent.name).split("=")[1])


def check_untouched(table, before, some):
    after = files(table)
    kept = {p for p in before if bucket_of(p) not in some}
    assert kept and all(after.get(p) == before[p] for p in kept)
    assert not {p for p in after if bucket_of(p) not in some} - kept


def test_upsert_rewrites_only_its_buckets(spark, table):
    old, before = rows_of(table.read()), files(table)
    new = silver_rows(spark, 64, job_title="again").where(F.col("job_id").isin("j1", "j5", "j61", "j62"))
    want = rows_of(state.upsert_touch(silver_rows(spark, 60), new, NOW))
    version, some = partial.upsert(table, new.union(new), NOW)
    assert some == table.touched(new) and len(some) < 16
    check_untouched(table, before, some)
    assert rows_of(table.read()) == want != old
    feed = table.feed(version).collect()
    assert sorted((r.before is None, r.after.job_id) for r in feed) == [(False, "j1"), (False, "j5"), (True, "j61"), (True, "j62")]
    assert table.redo(version) == some and rows_of(table.read()) == want
    _, none = partial.upsert(table, new.limit(0), NOW)
    assert none == [] and rows_of(table.read()) == want


def test_touch_expire_and_inactive_equal_the_whole_table_rules(spark, table):
    seen = spark.createDataFrame([("j3", S.SITE_A), ("j4", S.SITE_A), ("j3", S.SITE_A), ("zz", S.SITE_A), ("j7", S.SITE_B)], "job_id string, source string")
    now, before = silver_rows(spark, 60), files(table)
    now = state.touch_seen(now, seen, NOW, S.SITE_A)
    _, some = partial.touch(table, seen, NOW, S.SITE_A)
    check_untouched(table, before, some)
    assert rows_of(table.read()) == rows_of(now)
    now = state.expire_stale(now, NOW)
    version, some = partial.expire(table, NOW)
    assert rows_of(table.read()) == rows_of(now)
    assert all(r.after.status == S.EXPIRED and r.before.status == S.ACTIVE for r in table.feed(version).collect())
    urls = spark.createDataFrame([(S.SITE_A_SILVER, f"u{i}") for i in range(1, 60, 4)] + [(S.SITE_B_SILVER, None)], "source string, job_url string")
    sites = [S.SITE_A_SILVER, S.SITE_B_SILVER]
    now = state.mark_inactive(now, urls, sites)
    partial.mark_inactive(table, urls, sites)
    assert rows_of(table.read()) == rows_of(now)
    assert partial.mark_inactive(table, urls, sites)[1] == []  # nothing changes a second time


def test_insert_absent_opens_only_the_buckets_of_the_batch(spark, table):
    before = files(table)
    new = silver_rows(spark, 63, job_title="new").where("job_id IN ('j2', 'j60', 'j61')")
    some = partial.insert_absent(table, new.union(new), ["job_url"])
    assert some == table.touched(new) and len(some) <= 3
    assert {bucket_of(Path(f)) for f in opened_files(table.read(some))} <= set(some)
    assert all(files(table).get(p) == t for p, t in before.items())  # stored files stay as they are
    got = {r.job_id: r.job_title for r in table.read().collect()}
    assert len(got) == 62 and got["j2"] is None and got["j60"] == got["j61"] == "new"
    partial.insert_absent(table, new, ["job_url"])
    assert table.read().count() == 62  # a replay adds nothing


def test_empty_table_starts_by_itself(spark, tmp_path):
    fresh = Buckets(spark, str(tmp_path / "t"), S.SILVER, ["job_id"], 4)
    assert fresh.read().count() == 0 and fresh.read([1]).count() == 0
    partial.upsert(fresh, silver_rows(spark, 5), NOW)
    assert fresh.read().count() == 5
    assert pairs(fresh.read(), fresh.read(), ["job_id"]).count() == 0


def test_latest_state_is_moved_by_new_rows_alone(spark, tmp_path):
    base = dict.fromkeys(S.RAW.names, "x")

    def seen(*rows):
        made = [base | {"source": s, "job_id": j, "crawl_timestamp": t, "location": loc} for s, j, t, loc in rows]
        return spark.createDataFrame([tuple(r[c] for c in S.RAW.names) for r in made], S.RAW)

    day = [None, *[dt.datetime(2024, 1, d) for d in range(1, 6)]]
    parts = [
        seen(("A", "1", day[2], "p"), ("A", "1", day[1], "q"), ("B", "1", day[1], "r"), ("A", "2", day[0], "n")),
        seen(("A", "1", day[1], "late"), ("B", "1", day[1], "s"), ("A", "3", day[3], "t")),
        seen(("A", "2", day[1], "u"), ("A", "3", day[3], "a"), ("B", "1", day[5], "v")),
    ]
    lake = incremental.Lake(spark, str(tmp_path / "lake"), 4)
    every = parts[0]
    for i, part in enumerate(parts):
        lake.observe(part)
        every = part if i == 0 else every.union(part)
        want = batch.staged(every)
        assert sorted(map(str, lake.jobs.read().collect())) == sorted(map(str, want.select(S.RAW.names).collect()))


def test_gold_follows_the_feed_back_and_forth(spark, table):
    """Rows that change their skills, role, level and source take their old counts back."""
    old = table.read()
    changed = (
        old.where("job_id IN ('j0', 'j1', 'j2', 'j3', 'j4', 'j8')")
        .withColumn("ai_core_tech_stack", F.lit('["b", "c", "c", null]'))
        .withColumn("ai_job_role", F.lit("Security"))
        .withColumn("job_level", F.when(F.col("job_id") == "j0", "Error").otherwise("Director"))
        .withColumn("min_years_of_experience", F.lit(7))
    )
    feed = pairs(old.join(changed.select("job_id"), "job_id", "left_semi").select(old.columns), changed, ["job_id"])
    after = old.join(changed.select("job_id"), "job_id", "left_anti").select(old.columns).union(changed)
    start = gold_feed.as_feed(old)

    def check(name, want, view=lambda s: s):
        schema, key, deltas = incremental.GOLD[name]
        state_ = gold_feed.add(spark.createDataFrame([], schema), deltas(start), key)
        moved = view(gold_feed.add(state_, deltas(feed), key))
        assert sorted(map(tuple, moved.collect()), key=str) == sorted(map(tuple, want.select(moved.columns).collect()), key=str)

    check("skills", gold.skill_counts(after))
    check("roles", gold.role_summary(after), gold_feed.role_summary)
    check("levels", gold.skills_by_level(after))


def test_sketches_of_batches_merge(spark):
    rows = [(f"j{i % 5000}", '["a"]', "s", f"b{i % 3}") for i in range(12_000)]
    silver = spark.createDataFrame(rows, "job_id string, ai_core_tech_stack string, source string, batch string")
    by_batch = gold_feed.skill_sketches(silver, "batch")
    got = gold_feed.approximate_skill_counts(by_batch).collect()
    assert by_batch.count() == 3 and len(got) == 1 and abs(got[0].total_mentions - 5000) < 5000 * 5 * 1.04 / 64


def test_incremental_run_equals_the_whole_run(spark, tmp_path):
    base = dict.fromkeys(S.RAW.names, "x")
    made = [
        base | {"source": [S.SITE_A, S.SITE_B][i % 2], "job_id": f"j{i}", "job_url": f"u{i}", "crawl_timestamp": NOW, "job_title": "Senior Backend",
                "job_description": f"{i} years of Python and SQL"}
        for i in range(40, 70)
    ]
    seen = spark.createDataFrame([tuple(r[c] for c in S.RAW.names) for r in made], S.RAW)
    lake = incremental.Lake(spark, str(tmp_path / "lake"), 8)
    lake.load_silver(silver_rows(spark, 60))
    lake.observe(seen)
    path = str(tmp_path / "records")
    batch.extract_step(lake.pending()).write.parquet(path)
    records = spark.read.schema(batch.RECORDS).parquet(path)
    assert records.count() == 10
    lake.advance(lake.jobs.read(), records, NOW, lake.crawl_urls())
    want = batch.silver_step(silver_rows(spark, 60), seen, records, NOW)
    assert rows_of(lake.silver.read()) == rows_of(want)
    for name, whole in (("skills", gold.skill_counts), ("levels", gold.skills_by_level)):
        got = lake.gold(name)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole(want).select(got.columns).collect()))
    assert sorted(map(tuple, lake.role_summary().collect())) == sorted(map(tuple, gold.role_summary(want).collect()))


# --- indexes ------------------------------------------------------------------------------------------


def test_dense_groups_are_skipped_and_nothing_is_lost(spark, tmp_path):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(25, 16))
    points = [(i, (centres[i % 25] + 0.05 * rng.normal(size=16)).tolist(), int(i % 7)) for i in range(2000)]
    points += [(3000, [0.0] * 16, 1), (3001, points[0][1], 0), (3002, points[0][1], None), (3003, None, 1)]
    corpus = spark.createDataFrame(points, "id long, dense array<double>, yoe int").repartition(4)
    asked = [(i, p, y) for i, p, y in points[:40] if p] + [(3000, [0.0] * 16, 3), (9000, [1.0] + [0.0] * 15, None)]
    queries = spark.createDataFrame(asked, "qid long, dense array<double>, yoe int")
    index = dense_index.build(corpus, str(tmp_path / "index"), groups=25)
    got, read = dense_index.top_k(queries, index, 10, exclude_self=True)
    want = search.top_k(queries, corpus.where("dense IS NOT NULL"), ("dense",), 10, exclude_self=True).select("qid", "id", "score", "rank")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert read.vectors_scored < read.of_vectors / 4 and read.groups <= read.of_groups
    few = queries.where("qid = 3")
    got, read = dense_index.top_k(few, index, 10, exclude_self=True)
    assert read.groups < 6 and got.count() == 10
    opened = opened_files(index.rows([0, 1]))
    assert opened and all("group=0/" in f or "group=1/" in f for f in opened)


def test_dense_index_of_nothing_and_in_chunks(spark, tmp_path, monkeypatch):
    schema = "id long, dense array<double>, yoe int"
    index = dense_index.build(spark.createDataFrame([], schema), str(tmp_path / "none"))
    some = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(9)], "qid long, dense array<double>")
    assert dense_index.top_k(some, index, 3)[0].count() == 0
    corpus = spark.createDataFrame([(i, [1.0, float(i)], i) for i in range(30)], schema)
    index = dense_index.build(corpus, str(tmp_path / "some"))
    assert dense_index.top_k(some.limit(0), index, 3)[0].count() == 0
    monkeypatch.setattr(dense_index, "CHUNK_QUERIES", 2)
    got = dense_index.top_k(some, index, 3)[0].collect()
    want = search.top_k(some, corpus, ("dense",), 3).select("qid", "id", "score", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_postings_skip_what_cannot_matter(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1500):
        terms = sorted({f"t{int(x)}" for x in rng.zipf(1.4, 12) if x < 400} | {"all"})
        weights = np.round(rng.gamma(2.0, 0.4, len(terms)) + 0.01, 3).tolist()
        rows.append((i, int(i % 6) if i % 50 else None, terms, weights))
    rows += [(5000, 1, [], []), (5001, 1, ["odd"], [0.5])]
    corpus = spark.createDataFrame(rows, "id long, yoe int, terms array<string>, weights array<double>").repartition(4)
    index = postings.build(corpus, str(tmp_path / "index"), block=64)
    asked = [(q, int(q % 7) - 1, [f"t{int(x)}" for x in rng.zipf(1.3, 5) if x < 400] + ["all"] * (q % 2)) for q in range(25)]
    asked += [(100, None, ["all"]), (101, 5, ["nowhere"]), (102, 5, []), (103, 5, ["odd", "odd"])]
    queries = spark.createDataFrame(asked, "qid long, yoe int, terms array<string>")
    for q in (queries, queries.drop("yoe")):
        got, reads = postings.top_k(q, index, 5, probe=16)
        want = search.top_k(q, corpus, ("sparse",), 5).select("qid", "id", "score", "rank")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        read, total = reads.first()
        assert read < 0.8 * total
    largest = spark.read.parquet(f"{tmp_path}/index/blocks").agg(F.max(F.size("postings"))).first()[0]
    assert largest <= 3 * 64


def test_postings_of_large_levels_move_once(spark, tmp_path, monkeypatch):
    """Postings are dealt to tasks by id and added up there, also with many tasks, passes and copies of a query."""
    rows = [(i, ["all", f"t{i % 5}"], [1.0 + i % 3 / 4, 0.5]) for i in range(300)]
    corpus = spark.createDataFrame(rows, "id long, terms array<string>, weights array<double>")
    index = postings.build(corpus, str(tmp_path / "index"), block=8)
    queries = spark.createDataFrame([(q, ["all", f"t{q}"]) for q in range(4)], "qid long, terms array<string>")
    monkeypatch.setattr(postings, "SHARD", 32)
    monkeypatch.setattr(postings, "PROBE_BLOCKS", 1)
    monkeypatch.setattr(search, "MAX_BROADCAST_QUERIES", 3)
    want = sorted(map(tuple, search.top_k(queries, corpus, ("sparse",), 5).select("qid", "id", "score", "rank").collect()))
    hits = postings.top_k(queries, index, 5, probe=4)[0]
    assert sorted(map(tuple, hits.collect())) == want
    twice = postings.top_k(queries.union(queries), index, 5, probe=4)[0].select("qid", "id", "score").distinct()
    assert {r[:3] for r in want} >= {tuple(r) for r in twice.collect()}


def test_latest_rows_advance_by_one_join(spark, tmp_path):
    """A stored row stays unless the new one is newer, NULL times being the oldest; large buckets are cut into several files."""
    schema = "k string, at timestamp, v string"
    schema = spark.createDataFrame([], schema).schema
    table = Buckets(spark, str(tmp_path / "t"), schema, ["k"], 2)
    day = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    first = [("a", day[1], "x"), ("b", None, "x"), ("c", day[1], "x"), ("d", day[1], None), ("e", day[1], "x")]
    second = [("a", day[0], "y"), ("b", day[0], "y"), ("c", day[2], None), ("d", day[1], "y"), ("e", None, "z"), ("f", None, None)]
    for rows in (first, second):
        version, _ = partial.advance_latest(table, spark.createDataFrame(rows, schema), "at", ["v"])
    both = spark.createDataFrame(first + second, schema)
    want = staging.latest(both, ["k"], "at", ["v"])
    assert sorted(map(str, table.read().collect())) == sorted(map(str, want.collect()))
    moved = {(r.before and r.before.v, r.after.k, r.after.v) for r in table.feed(version).collect()}
    assert moved == {("x", "b", "y"), ("x", "c", None), (None, "d", "y"), (None, "f", None)}
    big = Buckets(spark, str(tmp_path / "big"), schema, ["k"], 1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        big.load(spark.range(20_000).selectExpr("cast(id as string) k", "cast(null as timestamp) at", "uuid() v").repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "big" / "rows" / "hash_bucket=0").glob("*.parquet"))) > 1
