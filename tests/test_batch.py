from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake import schemas as S
from hirelake.plans import batch, crawl
from hirelake.plans.match import match
from hirelake.sources.snapshots import Snapshots
from hirelake.operators.staging import first_seen
from hirelake.operators.state import expire_stale
from hirelake.streaming.ingest import ingest
from hirelake.streaming.lifecycle import EVENTS, first_rows, follow, statuses

CARDS = T.StructType([*S.RAW.fields, T.StructField("pos", T.IntegerType())])
DAY1, DAY2 = dt.datetime(2024, 5, 1, 8), dt.datetime(2024, 5, 9, 8)


def card(job, site, when, pos=0, title="Senior Backend Developer"):
    return (job, f"u/{job}", title, "ACME", "HN", "x", "t", site, when, "", "data-engineer", "", pos)


def descriptions(spark, *rows):
    """(job, text) of site A, (job, text, site) of any."""
    full = [(r[2] if len(r) > 2 else S.SITE_A, *r[:2]) for r in rows]
    return spark.createDataFrame(full, "source string, job_id string, job_description string")


def run(spark, root, cards, jds, when):
    return batch.run_batch(spark, root, spark.createDataFrame(cards, CARDS), descriptions(spark, *jds), when, ["pos"])


def state(store):
    return {r.job_id: r for r in store.read("silver", S.SILVER).collect()}


def test_two_days(spark, tmp_path):
    root = str(tmp_path)
    store = Snapshots(spark, root)
    first = run(
        spark,
        root,
        [card("a", S.SITE_A, DAY1), card("a", S.SITE_A, DAY1, 1, "later card"), card("b", S.SITE_B, DAY1), card("c", S.SITE_B, DAY1)],
        [("a", "5 years of Python and SQL"), ("b", "Connection error", S.SITE_B)],
        DAY1,
    )
    assert (first.bronze, first.silver, first.index) == (1, 1, 1)
    day1 = state(store)
    # b has no usable text yet; c was never fetched, and an empty text counts as ready
    assert set(day1) == {"a", "c"}
    a = day1["a"]
    assert (a.job_title, a.min_years_of_experience, a.ai_core_tech_stack) == ("Senior Backend Developer", 5, '["Python", "SQL"]')
    assert (a.source, a.status, a.job_level, a.processed_at) == (S.SITE_A_SILVER, "Active", "Senior", DAY1)

    second = run(
        spark,
        root,
        [card("a", S.SITE_A, DAY2, 0, "changed"), card("d", S.SITE_A, DAY2)],
        [("a", "other text"), ("b", "Docker", S.SITE_B), ("d", "Go")],
        DAY2,
    )
    assert second.silver == 2 and store.versions("silver") == [1, 2]
    day2 = state(store)
    assert set(day2) == {"a", "b", "c", "d"}
    # a stored job keeps its extracted values and is only touched
    assert day2["a"].ai_core_tech_stack == '["Python", "SQL"]' and day2["a"].last_seen_at == DAY2
    assert day2["b"].ai_core_tech_stack == '["Docker"]' and day2["b"].processed_at == DAY2
    # bronze holds every job once; the settled description of a is not replaced
    assert store.read_all("bronze", S.RAW).count() == 4
    texts = {(r.job_id, r.job_description) for r in store.read_all("descriptions", batch.DESCRIPTIONS).collect()}
    assert texts == {("a", "5 years of Python and SQL"), ("b", "Connection error"), ("b", "Docker"), ("d", "Go")}
    assert {r.metadata.job_id for r in store.read("index", batch.INDEX).collect()} == {"a", "b", "c", "d"}
    assert store.read("silver", S.SILVER, 1).count() == 2  # a pinned reader still sees day one
    gold = store.spark.read.parquet(f"{root}/gold_skill_counts/v=2")
    assert {(r.skill, r.total_mentions) for r in gold.collect()} == {("Python", 1), ("SQL", 1), ("Docker", 1)}


    moves = {r.what: r.rows for r in batch.report(spark, root, second).collect()}
    assert moves == {"extracted: ok": 2, "extracted: total": 2, "Active -> Active": 2}
    todo = batch.jobs_to_fetch(store.read_all("bronze", S.RAW), store.read_all("descriptions", batch.DESCRIPTIONS))
    assert [r.job_id for r in todo.collect()] == ["c"]


def test_complete_crawl_marks_and_unindexes(spark, tmp_path):
    root, store = str(tmp_path), Snapshots(spark, str(tmp_path))
    jds = [("a", "x"), ("b", "y")]
    run(spark, root, [card("a", S.SITE_A, DAY1), card("b", S.SITE_A, DAY1)], jds, DAY1)
    cards = spark.createDataFrame([card("a", S.SITE_A, DAY2)], CARDS)
    batch.run_batch(spark, root, cards, descriptions(spark, *jds), DAY2, ["pos"], crawl_is_complete=True)
    assert {k: v.status for k, v in state(store).items()} == {"a": "Active", "b": "Inactive"}
    assert [r.metadata.job_id for r in store.read("index", batch.INDEX).collect()] == ["a"]


def test_matching_on_the_written_tables(spark, tmp_path):
    root, store = str(tmp_path), Snapshots(spark, str(tmp_path))
    cards = [card("py", S.SITE_A, DAY1, title="Python Developer"), card("ops", S.SITE_B, DAY1, title="DevOps"), card("boss", S.SITE_A, DAY1, title="Architect")]
    jds = [("py", "2 years of Python, SQL and Docker"), ("ops", "1 year, Kubernetes", S.SITE_B), ("boss", "9 years of Python")]
    run(spark, root, cards, jds, DAY1)
    cvs = spark.createDataFrame([(1, "3 years of Python and SQL"), (2, "cook"), (3, "ops")], "qid int, cv_text string")
    answers = spark.createDataFrame([(3, "YOE: 0\nQUERY: kubernetes")], "qid int, answer string")
    m = match(cvs, store.read("index", batch.INDEX), store.read("silver", S.SILVER), answers=answers)
    cards = {(r.qid, r.rank): r.title for r in m.cards.collect()}
    assert cards[("1", 1)] == "Python Developer" and ("1", 3) not in cards  # nine years are out of reach
    assert cards[("3", 1)] == "DevOps" and ("3", 2) not in cards
    gaps = {(r.qid, r.job_id): (r.matched, r.missing) for r in m.gaps.collect()}
    assert gaps[("1", "py")] == (["python", "sql"], ["docker"])
    ctx = {r.qid: r.n_matches for r in m.context.collect()}
    assert ctx == {"1": 2, "2": 1, "3": 1}


def test_repeated_run_changes_nothing(spark, tmp_path):
    root, store = str(tmp_path), Snapshots(spark, str(tmp_path))
    cards, jds = [card("a", S.SITE_A, DAY1), card("b", S.SITE_B, DAY1)], [("a", "x"), ("b", "y", S.SITE_B)]
    run(spark, root, cards, jds, DAY1)
    before = state(store)
    run(spark, root, cards, jds, DAY1)
    assert state(store) == before and store.read_all("bronze", S.RAW).count() == 2


def test_unfinished_version_is_ignored(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    df = spark.createDataFrame([(S.SITE_A, "a", "x", False)], batch.DESCRIPTIONS)
    assert store.versions("t") == [] and store.read("t", batch.DESCRIPTIONS).count() == 0
    assert store.write("t", df) == 1
    (tmp_path / "t" / "v=2").mkdir()
    assert store.versions("t") == [1]
    assert store.write("t", df.union(df)) == 2
    assert [store.read("t", batch.DESCRIPTIONS, v).count() for v in (1, 2)] == [1, 2]
    assert sorted(r.v for r in store.read_all("t", batch.DESCRIPTIONS).collect()) == [1, 2, 2]


def test_failing_model_goes_to_quarantine(spark, tmp_path):
    def load():
        return lambda jobs: [None] * len(jobs)

    cards = spark.createDataFrame([card("a", S.SITE_A, DAY1)], CARDS)
    for when in (DAY1, DAY2):
        batch.run_batch(spark, str(tmp_path), cards, descriptions(spark, ("a", "x")), when, ["pos"], load)
        row = state(Snapshots(spark, str(tmp_path)))["a"]
        # the next run touches the row back to life and never extracts it again
        assert (row.job_level, row.status) == ("Error", "Error" if when == DAY1 else "Active")


def test_stream_ingest(spark, tmp_path):
    incoming, root, check = str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "check")
    store = Snapshots(spark, root)

    def arrive(*rows):
        spark.createDataFrame(rows, CARDS).coalesce(1).write.mode("append").parquet(incoming)

    def catch_up():
        ingest(spark, incoming, CARDS, root, ["pos"], checkpoint=check).awaitTermination()
        return sorted((r.job_id, r.job_title) for r in store.read_all("bronze", S.RAW).collect())

    arrive(card("a", S.SITE_A, DAY1, 1, "second"), card("a", S.SITE_A, DAY1, 0, "first"))
    assert catch_up() == [("a", "first")]
    arrive(card("a", S.SITE_A, DAY2, 0, "again"), card("b", S.SITE_A, DAY2, 0, "b"))
    assert catch_up() == [("a", "first"), ("b", "b")]
    assert catch_up() == [("a", "first"), ("b", "b")]


@pytest.mark.parametrize("rows", [[("a", "x", S.SITE_A), ("a", "y", S.SITE_B)]])
def test_job_seen_on_both_sites_is_extracted_once(spark, rows):
    df = spark.createDataFrame(rows, "job_id string, job_description string, source string")
    df = df.withColumn("job_url", F.lit("u")).withColumn("job_title", F.lit("t"))
    assert [(r.job_id, r.source) for r in batch.extract_step(df).collect()] == [("a", S.SITE_A_SILVER)]


def test_one_id_on_both_sites_keeps_two_rows_and_two_texts(spark, tmp_path):
    root, store = str(tmp_path), Snapshots(spark, str(tmp_path))
    cards = [card("7", S.SITE_A, DAY1, title="QA on A"), card("7", S.SITE_B, DAY1, title="Backend on B")]
    jds = [("7", "Error 404"), ("7", "6 years of Go", S.SITE_B)]
    run(spark, root, cards, jds, DAY1)
    run(spark, root, cards, [("7", "late"), ("7", "late", S.SITE_B)], DAY2)
    bronze = {(r.source, r.job_title) for r in store.read_all("bronze", S.RAW).collect()}
    assert bronze == {(S.SITE_A, "QA on A"), (S.SITE_B, "Backend on B")}
    texts = {(r.source, r.job_description) for r in store.read_all("descriptions", batch.DESCRIPTIONS).collect()}
    assert texts == {(S.SITE_A, "Error 404"), (S.SITE_B, "6 years of Go")}
    jobs = store.read("int_all_jobs", S.RAW)
    seen = batch.with_descriptions(jobs, store.read_all("descriptions", batch.DESCRIPTIONS))
    assert {(r.source, r.job_description) for r in seen.collect()} == texts
    assert [(r.job_id, r.source) for r in store.read("silver", S.SILVER).collect()] == [("7", S.SITE_A_SILVER)]


def test_stream_lifecycle_equals_the_batch_rules(spark, tmp_path):
    incoming, root = str(tmp_path / "in"), str(tmp_path / "lake")
    seen = []

    def arrive(*rows):
        seen.extend(rows)
        spark.createDataFrame(rows, CARDS).coalesce(1).write.mode("append").parquet(incoming)

    def catch_up():
        follow(spark, incoming, CARDS, root, ["at", "pos"], delay="1 hour").awaitTermination()
        return spark.read.schema(EVENTS).parquet(f"{root}/events")

    def day(n, hour=8):
        return dt.datetime(2024, 5, n, hour)

    def check(events, newest):
        every = spark.createDataFrame(seen, CARDS)
        first = first_seen(every, ["source", "job_id"], ["crawl_timestamp", "pos"]).select(S.RAW.names)
        assert sorted(map(str, first_rows(events).collect())) == sorted(map(str, first.collect()))
        last = every.groupBy("source", "job_id").agg(F.max("crawl_timestamp").alias("last_seen_at"))
        want = expire_stale(last.withColumn("status", F.lit(S.ACTIVE)), newest - dt.timedelta(hours=1))
        got = {(r.source, r.job_id): r.status for r in statuses(events).collect()}
        assert got == {(r.source, r.job_id): r.status for r in want.collect()}
        return set(got.values())

    arrive(card("a", S.SITE_A, day(1), 1, "second"), card("a", S.SITE_A, day(1), 0, "first"), card("a", S.SITE_B, day(2), 0, "other site"))
    assert check(catch_up(), day(2)) == {S.ACTIVE}
    arrive(card("b", S.SITE_A, day(5), 0, "b"), card("a", S.SITE_B, day(4), 0, "again"))
    assert check(catch_up(), day(5)) == {S.ACTIVE, S.EXPIRED}
    arrive(card("a", S.SITE_A, day(5, 9), 0, "back"), card("c", S.SITE_A, day(9), 0, "c"))
    assert check(catch_up(), day(9)) == {S.ACTIVE, S.EXPIRED}
    arrive(card("d", S.SITE_A, day(20), 0, "d"))
    events = catch_up()
    assert check(events, day(20)) == {S.ACTIVE, S.EXPIRED}
    before = sorted(map(str, events.collect()))
    assert sorted(map(str, catch_up().collect())) == before  # nothing new, nothing twice
    assert events.where("event = 'seen again'").count() == 1


def test_from_saved_pages_to_matches(spark, tmp_path):
    listing = "page_id long, url string, html string, keyword string, page_no int"
    card_a = '<div class="job-card"><h3 data-url="/it-jobs/{0}?x=1">{1}</h3></div>'
    site_a = spark.createDataFrame(
        [
            (1, "https://itviec.com/1", card_a.format("ml", "Later copy"), "ai-engineer", 1),
            (2, "https://itviec.com/2", card_a.format("ml", "ML Engineer") + card_a.format("de", "Data Engineer"), "data-engineer", 1),
        ],
        listing,
    )
    card_b = '<div class="job-item-search-result"><h3><a href="/viec-lam/x/77.html?ta">QA</a></h3></div>'
    refused = "<title>Cloudflare</title>" + card_b.replace("77", "78")
    site_b = spark.createDataFrame(
        [(i, "https://www.topcv.vn/1", html, "data-analyst", i) for i, html in ((1, card_b), (2, refused))], listing
    )
    cards = crawl.listing_cards(site_a, site_b, F.lit("2024-05-01 08:00:00").cast("timestamp_ntz"))
    jd = "<section class='job-content'><p>4 years of Python</p></section>"
    details = "page_id string, html string, status int"
    texts = crawl.detail_texts(
        spark.createDataFrame([("https://itviec.com/it-jobs/ml", jd, 200), ("https://itviec.com/it-jobs/de", jd, 404)], details),
        spark.createDataFrame([("77", "<div class='box-info-job'>IELTS, 1 year</div>", 200), ("79", "", 500)], details),
    )
    found = {r.job_id: r.job_description for r in texts.collect()}
    assert (found["https://itviec.com/it-jobs/de"], found["79"]) == ("Error 404", S.JD_CONNECTION_ERROR)
    root, store = str(tmp_path), Snapshots(spark, str(tmp_path))
    batch.run_batch(spark, root, cards, texts, DAY1, crawl.CRAWL_ORDER)
    bronze = {r.job_id: r for r in store.read_all("bronze", S.RAW).collect()}
    assert set(bronze) == {"https://itviec.com/it-jobs/ml", "https://itviec.com/it-jobs/de", "77"}
    # the keyword that comes first in the crawl wins, not the page that comes first in the table
    assert bronze["https://itviec.com/it-jobs/ml"].job_title == "ML Engineer"
    silver = state(store)
    ml = silver["https://itviec.com/it-jobs/ml"]
    assert (ml.min_years_of_experience, ml.job_level, ml.ai_core_tech_stack) == (4, "Middle", '["Python"]')
    assert (silver["77"].ai_job_role, silver["77"].english_requirement) == ("QA/QC/Tester", S.ENGLISH_CERTIFICATE)
    # an HTTP error text is final and counts as a description
    assert silver["https://itviec.com/it-jobs/de"].min_years_of_experience == 0
