from __future__ import annotations

from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.functions.html import Select, parse
from hirelake.sources import pages

SITE_A = """<html><title>IT jobs</title><body>
<div class="card job-card first"><h3 data-url="/it-jobs/dev?lab=1"> Dev <b>A</b></h3>
 <span class="x text-hover-underline"><a href="/c">ACME &amp; Co</a></span>
 <div class="text-truncate">no title</div><div class="text-truncate" title="Ha Noi">HN</div>
 <a class="itag big">Python</a><a class="itag">SQL</a><a class="notitag">no</a>
 <a class="sign-in-view-salary">Sign in</a></div>
<div class="job-card"><h3>No link</h3></div>
<div class="job-card"><p>broken</p></div>
<div class="my-job-card"><h3 data-url="/no">not a card</h3></div>
</body></html>"""

SITE_B = """<div class="job-item-search-result bg"><a href="https://www.topcv.vn/co/1"><img></a>
 <h3><a href="/viec-lam/dev/123.html?ta=1">Dev</a></h3><a class="company-name">ACME</a>
 <label class="address mobile">Ha Noi</label><label class="title salary"> 10 - 20 </label></div>
<div class="job-item-search-result"><a class="job-title" href="/viec-lam/qa/456.html?x">QA</a></div>
<div class="job-item-search-result"><h3>lonely</h3></div>"""


def page(spark, *html):
    rows = [(i, f"https://h.example/p{i}", h) for i, h in enumerate(html)]
    return spark.createDataFrame(rows, S.PAGE)


def test_site_a_cards(spark):
    a, no_link, broken = pages.cards(page(spark, SITE_A), pages.SITE_A_CARDS).orderBy("card_idx").collect()
    assert (a.job_id, a.job_title) == (S.SITE_A_HOST + "/it-jobs/dev", "Dev A")
    assert (a.company_name, a.location, a.tech_stack, a.salary_raw) == ("ACME & Co", "Ha Noi", "Python, SQL", S.SALARY_SIGN_IN)
    assert (no_link.job_id, no_link.company_name, no_link.location) == ("", S.UNKNOWN_COMPANY, S.UNKNOWN_LOCATION)
    assert (no_link.tech_stack, no_link.salary_raw) == ("", S.SALARY_UPDATING)
    assert broken.job_title == S.TITLE_ERROR and broken.job_id.startswith("error_url_") and broken.job_id == broken.job_url


def test_site_b_cards(spark):
    first, second, bad = pages.cards(page(spark, SITE_B), pages.SITE_B_CARDS).orderBy("card_idx").collect()
    # the title is no link, so the first link of the card counts, even if it leads elsewhere
    assert (first.job_id, first.job_title) == ("https://www.topcv.vn/co/1", "Dev")
    assert (first.company_name, first.location, first.salary_raw) == ("ACME", "Ha Noi", "10 - 20")
    assert (second.job_id, second.job_url) == ("456", S.SITE_B_HOST + "/viec-lam/qa/456.html")
    assert (second.salary_raw, second.location) == (S.SALARY_NEGOTIABLE, S.UNKNOWN_LOCATION)
    assert second.tech_stack == S.TECH_STACK_LATER
    assert bad.job_title == S.TITLE_ERROR


def test_error_ids_are_stable_and_distinct(spark):
    df = pages.cards(page(spark, "<div class='job-card'></div>" * 2, "<div class='job-card'></div>"), pages.SITE_A_CARDS)
    ids = [r.job_id for r in df.orderBy("page_id", "card_idx").collect()]
    assert len(set(ids)) == 3
    assert ids == [r.job_id for r in df.repartition(3).orderBy("page_id", "card_idx").collect()]


def test_cards_to_raw(spark):
    found = pages.cards(page(spark, SITE_A), pages.SITE_A_CARDS)
    raw = pages.cards_to_raw(found, S.SITE_A, F.lit("ai-engineer"), F.lit("2024-05-01 10:00:00.9").cast("timestamp_ntz"))
    row = raw.orderBy("card_idx").first()
    assert raw.columns[2:] == S.RAW.names
    assert (row.source, row.job_category, row.job_description, row.crawl_timestamp.microsecond) == (S.SITE_A, "ai-engineer", "", 0)


def test_descriptions(spark):
    html = [
        '<title>t</title><section class="x-job-content"><h2> Job </h2><p>Do<br>this<script>var a="</p>";</script></section>',
        "<title>t</title><p>other</p>",
        "<title>Cloudflare check</title><section class='job-content'>x</section>",
        "<section class='job-content'>Access denied</section>",
        "<section class='job-content'>" + "y" * 5000 + "</section>",
    ]
    got = [r.job_description for r in pages.job_descriptions(page(spark, *html), pages.SITE_A_JD).orderBy("page_id").collect()]
    assert got == ["Job\nDo\nthis", S.JD_NOT_FOUND, S.JD_CONNECTION_ERROR, S.JD_CONNECTION_ERROR, "y" * 5000]


def test_description_fallbacks_and_status(spark):
    html = [
        "<div class='box-info-job'>c</div><div class='job-description__item'>b</div><div id='box-job-information-detail'>a</div>",
        "<div class='box-info-job'>c</div><div class='job-description__item'>b</div>",
        "<div class='box-info-job'>c</div>",
        "<div class='box-info-job'>c</div>",
    ]
    df = page(spark, *html).withColumn("code", F.when(F.col("page_id") == 3, 403).otherwise(200))
    got = pages.job_descriptions(df, pages.SITE_B_JD, status="code").orderBy("page_id").collect()
    assert [r.job_description for r in got] == ["a", "b", "c", "Error 403"]


def test_tree_survives_bad_markup():
    deep = "<p>" * 20_000 + "x" + "</b></p>"
    assert parse(deep).text() == "x"
    assert parse(None).text() == ""
    assert parse('<a href="?a=1&amp;b=2" class>t</a>').find(Select("a")).attrs == {"href": "?a=1&b=2", "class": ""}
