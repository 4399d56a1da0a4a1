from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.functions import rules, text


def one(spark, column, **cells):
    names = list(cells)
    schema = ", ".join(f"{n} {'int' if isinstance(v, int) else 'string'}" for n, v in cells.items())
    return spark.createDataFrame([tuple(cells[n] for n in names)], schema).select(column.alias("x")).first().x


def test_json_list(spark):
    cases = {
        None: None,
        "[]": [],
        '["a","a"]': ["a", "a"],
        '["",null,"b"]': ["", None, "b"],
        "[1,2]": ["1", "2"],
        '{"k":1}': None,
        '"x"': None,
        "oops": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: (r.l, r.bad) for r in df.select("s", text.json_list("s").alias("l"), text.json_list_malformed("s").alias("bad")).collect()}
    assert {k: v[0] for k, v in got.items()} == cases
    assert {k for k, v in got.items() if v[1]} == {'{"k":1}', '"x"', "oops"}


def test_to_json_list(spark):
    df = spark.createDataFrame([(["a", 'say "hi"', None],), ([],), (None,)], "l array<string>")
    assert [r.x for r in df.select(text.to_json_list("l").alias("x")).collect()] == ['["a", "say \\"hi\\"", null]', "[]", None]


def test_urls(spark):
    u = F.col("u")
    assert one(spark, text.url_core(text.absolute_url(u, S.SITE_A_HOST)), u="/a?x=1") == S.SITE_A_HOST + "/a"
    assert one(spark, text.absolute_url(u, S.SITE_A_HOST), u="") == ""
    assert one(spark, text.url_number(text.url_core(u)), u="http://h/p/12.html?y") == "12"
    assert one(spark, text.url_number(u), u="http://h/p") == "http://h/p"
    assert one(spark, text.last_path_part(u), u="http://h/p/job-7") == "job-7"


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(6.25,), (0.35,), (2.25,)], "x double")
    assert [r.y for r in df.select(F.round("x", 1).alias("y")).collect()] == [6.3, 0.4, 2.3]


def test_point_id_is_a_uuid(spark):
    import hashlib
    import uuid

    assert one(spark, text.point_id("s"), s="job-1") == str(uuid.UUID(hashlib.md5(b"job-1").hexdigest()))


def test_profile_lines(spark):
    def parse(answer):
        yoe, query = text.profile_lines("a", "cv")
        return one(spark, F.struct(yoe.alias("y"), query.alias("q")), a=answer, cv="my cv")

    assert tuple(parse("YOE: 3 years\nQUERY:  Backend dev ")) == (3, "Backend dev")
    assert tuple(parse("YOE: none\nQUERY: x")) == (0, "my cv")  # the bad line ends the reading
    assert tuple(parse("QUERY: x\nYOE: none")) == (0, "x")
    assert tuple(parse("nothing")) == (0, "my cv")
    assert tuple(parse("YOE: 1\nYOE: 4")) == (4, "my cv")


def test_strip_and_none(spark):
    assert one(spark, text.strip("s"), s=" \t a b \n") == "a b"
    assert one(spark, text.or_none("s"), s=None) == "None"
    assert one(spark, text.thousands("n"), n=1234567) == "1,234,567"


def test_whole_seconds(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05.678' AS t")
    assert df.select(text.whole_seconds("t").alias("x")).first().x == dt.datetime(2024, 1, 2, 3, 4, 5)


def extract(spark, title, body):
    df = spark.createDataFrame([(title, body)], "title string, body string")
    return rules.prepared(df, "title", "body").select(rules.record().alias("r")).first().r.asDict()


def test_rules(spark):
    r = extract(
        spark,
        "Senior Data Engineer (Python)",
        "We need 3-5 years with Spark, PySpark, node.js, AWS; k8s and Docker. You communicate daily with teams in English.",
    )
    assert r == {
        "min_years_of_experience": 3,
        "core_tech_stack": ["Python", "Spark", "Node.js", "AWS", "Kubernetes"],
        "english_requirement": S.ENGLISH_COMMUNICATION,
        "job_role": "Data Engineer",
        "job_level": "Senior",
    }
    r = extract(spark, "Tester", "6 months of work, IELTS 6.5, c++ and c# or .NET")
    assert (r["min_years_of_experience"], r["english_requirement"]) == (0, S.ENGLISH_CERTIFICATE)
    assert (r["job_role"], r["job_level"]) == ("QA/QC/Tester", "Fresher")
    assert r["core_tech_stack"] == ["C++", "C#", ".NET"]
    r = extract(spark, "Front-end developer", "Reads English documents. 2+ yrs")
    assert (r["english_requirement"], r["job_role"], r["job_level"]) == (S.ENGLISH_READING, "Frontend", "Junior")
    # words between two keywords keep them apart; parts of words do not count
    r = extract(spark, None, "data for the engineer, eux backends")
    assert (r["job_role"], r["english_requirement"]) == ("Unknown", S.ENGLISH_NONE)


def test_rules_read_the_whole_text(spark):
    assert extract(spark, "x", "lorem ipsum " * 5000 + "scrum master with 7 years")["job_role"] == "Scrum Master"
    assert extract(spark, "x", "lorem ipsum " * 5000 + "scrum master with 7 years")["min_years_of_experience"] == 7


def test_level_from_years(spark):
    rows = [("Unknown", y) for y in (-1, 0, 1, 2, 3, 4, 5, None)] + [("Senior", 0)]
    df = spark.createDataFrame(rows, "l string, y int")
    got = [r.x for r in df.select(rules.level_from_years("l", "y").alias("x")).collect()]
    assert got == ["Unknown", "Fresher", "Junior", "Junior", "Middle", "Middle", "Senior", "Unknown", "Senior"]
