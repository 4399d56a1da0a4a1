from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.operators import contract, staging, state

NOW = dt.datetime(2024, 5, 10, 12, 0)


def silver(spark, *rows):
    """rows: dicts over the silver columns."""
    base = dict.fromkeys(S.SILVER.names)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], S.SILVER)


def by_id(df):
    return {r.job_id: r for r in df.collect()}


def test_latest_ties_and_nulls(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, 1), ("a", t, 2), ("a", None, 9), ("b", None, 1)], "id string, ts timestamp_ntz, n int")
    assert sorted((r.id, r.n) for r in staging.latest(df, ["id"], "ts", ["n"]).collect()) == [("a", 2), ("b", 1)]


def test_union_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "id string, v string")
    b = spark.createDataFrame([("y", "2")], "v string, id string")
    assert sorted((r.id, r.v) for r in staging.union_sources(a, b).collect()) == [("1", "x"), ("2", "y")]


def test_insert_absent(spark):
    old = spark.createDataFrame([("a", "old")], "job_id string, v string")
    new = spark.createDataFrame(
        [("a", "new", 0), ("b", "second", 2), ("b", "first", 1), ("", "e1", 1), ("", "e2", 2)], "job_id string, v string, o int"
    )
    out = state.insert_absent(old, new, "job_id", ["o"])
    assert sorted(map(tuple, out.collect())) == [("", "e1"), ("a", "old"), ("b", "first")]
    assert sorted(map(tuple, state.insert_absent(out, new, "job_id", ["o"]).collect())) == sorted(map(tuple, out.collect()))


def test_new_per_page(spark):
    rows = [(0, 0, 0, "a"), (0, 0, 1, "b"), (0, 1, 0, "a"), (1, 0, 0, "c"), (1, 0, 1, "b")]
    df = spark.createDataFrame(rows, "kw int, page int, card int, id string")
    out = staging.new_per_page(df, "id", "kw", "page", ["kw", "page", "card"])
    assert sorted(map(tuple, out.collect())) == [(0, 0, 2), (0, 1, 0), (1, 0, 1)]


def test_description_predicates(spark):
    df = spark.createDataFrame([(x,) for x in (None, "", "Connection error", "JD content not found", "Error 403", "text")], "d string")
    assert [r.x for r in df.select(state.needs_description("d").alias("x")).collect()] == [True, True, True, False, False, False]
    jobs = df.select(F.coalesce("d", F.lit("null")).alias("job_id"), F.lit("u").alias("job_url"), F.lit("t").alias("job_title"), F.col("d").alias("job_description"))
    ready = state.pending_jobs(jobs, silver(spark))
    assert {r.job_id for r in ready.collect()} == {"", "Error 403", "text"}


def test_pending_leaves_known_ids_out(spark):
    jobs = spark.createDataFrame([("a", "u", "t", "jd"), ("b", "u", "t", "jd")], "job_id string, job_url string, job_title string, job_description string")
    known = silver(spark, {"job_id": "a", "job_level": "Error", "status": "Error"})
    assert [r.job_id for r in state.pending_jobs(jobs, known).collect()] == ["b"]


def test_update_column(spark):
    old = spark.createDataFrame([("a", ""), ("b", "kept"), ("c", None)], "job_id string, job_description string")
    upd = spark.createDataFrame([("a", "new"), ("b", "new")], "job_id string, job_description string")
    out = state.update_column(old, upd, "job_id", "job_description", state.needs_description("job_description"))
    assert sorted(map(tuple, out.collect())) == [("a", "new"), ("b", "kept"), ("c", None)]


def test_upsert_keeps_stored_values(spark):
    past = dt.datetime(2024, 1, 1)
    old = silver(spark, {"job_id": "a", "job_title": "old", "status": "Expired", "processed_at": past, "last_seen_at": past})
    new = state.with_silver_defaults(
        spark.createDataFrame([("a", "new"), ("b", "new"), ("b", "new")], "job_id string, job_title string"), NOW
    )
    out = by_id(state.upsert_touch(old, new, NOW))
    assert (out["a"].job_title, out["a"].status, out["a"].processed_at, out["a"].last_seen_at) == ("old", "Active", past, NOW)
    assert (out["b"].job_title, out["b"].status, out["b"].processed_at) == ("new", "Active", NOW)
    again = state.upsert_touch(state.upsert_touch(old, new, NOW), new, NOW)
    assert by_id(again) == out


def test_upsert_with_broken_rows(spark):
    past = dt.datetime(2024, 1, 1)
    old = silver(spark, {"job_id": "a", "status": "Inactive", "last_seen_at": past})
    rows = spark.createDataFrame([("a", "Error", False), ("b", "Error", False), ("c", "Error", False), ("c", "Active", True)], "job_id string, status string, ok boolean")
    out = by_id(state.upsert_touch(old, state.with_silver_defaults(rows, NOW, keep=("ok",)), NOW, ok="ok"))
    assert (out["a"].status, out["a"].last_seen_at) == ("Inactive", past)
    assert out["b"].status == "Error" and out["c"].status == "Active"


def test_touch_revives_any_status(spark):
    old = silver(spark, *[{"job_id": s, "status": s, "job_level": "Error"} for s in ("Error", "Inactive", "Expired")], {"job_id": "x", "status": "Inactive"})
    seen = spark.createDataFrame([(i, s) for i in ("Error", "Inactive", "Expired") for s in ("A", "A")] + [("x", "B")], "job_id string, source string")
    out = by_id(state.touch_seen(old, seen, NOW, "A"))
    assert {k: v.status for k, v in out.items()} == {"Error": "Active", "Inactive": "Active", "Expired": "Active", "x": "Inactive"}
    assert out["Error"].job_level == "Error" and out["Error"].last_seen_at == NOW


def mark(spark, left, right):
    df = silver(spark, *[{"job_id": str(i), "job_url": u, "source": "A", "status": "Active"} for i, u in enumerate(left)])
    urls = spark.createDataFrame([("A", u) for u in right], "source string, job_url string")
    return [r.status for r in state.mark_inactive(df, urls, ["A"]).orderBy("job_id").collect()]


def test_mark_inactive_follows_not_in(spark):
    assert mark(spark, ["u1", "u2", None], ["u1", "u1"]) == ["Active", "Inactive", "Active"]
    assert mark(spark, ["u1", "u2", None], ["u1", None]) == ["Active", "Active", "Active"]
    assert mark(spark, ["u1", "u2", None], []) == ["Inactive", "Inactive", "Inactive"]


def test_mark_inactive_is_per_source(spark):
    df = silver(spark, *[{"job_id": s, "job_url": "u", "source": s, "status": "Active"} for s in ("A", "B", "C")])
    urls = spark.createDataFrame([("B", "u")], "source string, job_url string")
    out = by_id(state.mark_inactive(df, urls, ["A", "B"]))
    assert {k: v.status for k, v in out.items()} == {"A": "Inactive", "B": "Active", "C": "Active"}


def test_expire_is_strict(spark):
    day = dt.timedelta(days=1)
    rows = [("edge", NOW - 3 * day, "Active"), ("old", NOW - 3 * day - dt.timedelta(seconds=1), "Active"), ("gone", NOW - 9 * day, "Inactive")]
    df = silver(spark, *[{"job_id": i, "last_seen_at": t, "status": s} for i, t, s in rows])
    out = state.expire_stale(df, NOW)
    assert {k: v.status for k, v in by_id(out).items()} == {"edge": "Active", "old": "Expired", "gone": "Inactive"}
    assert {tuple(r) for r in state.status_changes(df, out).collect()} == {("Active", "Active", 1), ("Active", "Expired", 1), ("Inactive", "Inactive", 1)}


def records(spark, *rows):
    schema = "job_id string, job_url string, job_title string, source string, record struct<min_years_of_experience:int,core_tech_stack:array<string>,english_requirement:string,job_role:string,job_level:string>"
    return spark.createDataFrame([(str(i), "u", "t", "ITVIEC", r) for i, r in enumerate(rows)], schema)


GOOD = (3, ["SQL"], S.ENGLISH_NONE, "Backend", "Unknown")


def test_contract(spark):
    bad = [
        (3, ["a"] * 6, S.ENGLISH_NONE, "Backend", "Senior"),
        (3, [], S.ENGLISH_NONE, "Wizard", "Senior"),
        (None, [], S.ENGLISH_NONE, "Backend", "Senior"),
        (3, [], "Fluent", "Backend", "Senior"),
        (3, [], S.ENGLISH_NONE, "Backend", "Error"),
        (3, None, S.ENGLISH_NONE, "Backend", "Senior"),
        None,
    ]
    df = records(spark, GOOD, *bad)
    assert tuple(contract.contract_counts(df).first()) == (1, 8)
    rows = by_id(state.with_silver_defaults(contract.to_silver(df), NOW, keep=("ok",)))
    assert (rows["0"].job_level, rows["0"].ai_core_tech_stack, rows["0"].status) == ("Middle", '["SQL"]', "Active")
    for i in range(1, 8):
        r = rows[str(i)]
        assert (r.job_level, r.status, r.job_title, r.ai_job_role, r.min_years_of_experience) == ("Error", "Error", "t", None, None)


def test_quarantine_does_not_overwrite(spark):
    old = silver(spark, {"job_id": "0", "job_level": "Senior", "status": "Active"})
    out = by_id(state.quarantine(old, records(spark, None, None), NOW))
    assert (out["0"].job_level, out["1"].job_level, out["1"].status) == ("Senior", "Error", "Error")


def test_model_extractor_with_retries(spark):
    def load():
        tries = {}

        def model(batch):
            out = []
            for job in batch["job_id"]:
                tries[job] = tries.get(job, 0) + 1
                ok = (job == "flaky" and tries[job] == 3) or job == "good"
                record = dict(zip(S.EXTRACTION.names, (tries[job], ["SQL"], S.ENGLISH_NONE, "Backend", "Senior")))
                out.append(record if ok else None)
            return out

        return model

    jobs = spark.createDataFrame([(i, "u", "t", "jd") for i in ("good", "flaky", "bad")], "job_id string, job_url string, job_title string, job_description string")
    got = {r.job_id: r.record for r in contract.extract_with(jobs.coalesce(1), load).collect()}
    assert got["good"].min_years_of_experience == 1 and got["flaky"].min_years_of_experience == 3 and got["bad"] is None


def test_dictionary_skills(spark):
    docs = spark.createDataFrame([(1, "zeta alpha beta alpha gamma delta eps"), (2, "nothing here"), (3, None)], "id int, body string")
    words = spark.createDataFrame([(w, w[0].upper()) for w in ("alpha", "beta", "gamma", "delta", "eps", "zeta")] + [("alpha", "A")], "alias string, canonical string")
    first = contract.skills_from_dictionary(docs, words, "id", "body", S.MAX_SKILLS)
    assert {r.id: r.skills for r in first.collect()} == {1: ["Z", "A", "B", "G", "D"], 2: [], 3: []}
    whole = contract.skills_from_dictionary(docs, words, "id", "body")
    assert {r.id: r.skills for r in whole.collect()} == {1: ["Z", "A", "B", "G", "D", "E"], 2: [], 3: []}


@pytest.mark.parametrize("by_join", [False, True])
def test_phrase_skills_take_the_longest_match(spark, by_join):
    docs = spark.createDataFrame(
        [(1, "Machine-Learning platform; learning platform, spring boot & Spring"), (2, "nothing"), (3, None), (4, ""), (5, "boot machine")],
        "id int, body string",
    )
    words = [("machine learning", "ML"), ("Machine", "M"), ("learning platform", "LP"), ("spring boot", "SB"), ("spring", "S"), ("spring", "S2"), ("?", "no"), (None, "none")]
    table = spark.createDataFrame(words, "alias string, canonical string")
    got = {r.id: r.skills for r in contract.skills_from_phrases(docs, table, "id", "body", by_join=by_join).collect()}
    assert got == {1: ["ML", "LP", "SB", "S", "S2"], 2: [], 3: [], 4: [], 5: ["M"]}
    first = contract.skills_from_phrases(docs, table, "id", "body", 2, by_join).collect()
    assert {r.id: r.skills for r in first}[1] == ["ML", "LP"]


def test_candidate_profiles(spark):
    df = spark.createDataFrame([(1, "Backend dev, 4 years of Python and SQL"), (2, "a gardener")], "id int, cv string")
    got = {r.id: (r.yoe, r.query, r.skills) for r in contract.candidate_profiles(df, "id", "cv").collect()}
    assert got == {1: (4, "Backend Python SQL", ["Python", "SQL"]), 2: (0, "a gardener", [])}
