"""Saved web pages -> job cards and job descriptions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from hirelake import schemas as S
from hirelake.functions import slices, text
from hirelake.functions.html import Select, parse

CARD = (
    "array<struct<card_idx:int,title:string,link:string,company:string,"
    "location:string,tags:array<string>,salary:string>>"
)


@dataclass(frozen=True)
class CardRules:
    """Where one site keeps the parts of a card, and how links become ids."""

    card: Select
    title: tuple[Select, ...]
    link_attr: str  # attribute of the title element; "href" of the first <a> when the title is no link
    link_from_card: bool
    company: tuple[Select, ...]  # nested: each rule searches inside the previous hit
    location: Select | None
    location_attr: str | None
    tags: Select | None
    salary: Select | None
    salary_texts: tuple[str | None, str]  # (text when present, None = its own text; text when absent)
    host: str | None  # None: the page's own host
    numeric_id: bool
    prefix_empty_link: bool
    tech_stack: str | None


# --- fixed values: element rules of the two sites --------------------------------

SITE_A_CARDS = CardRules(
    card=Select("div", token="job-card"),
    title=(Select("h3"),),
    link_attr="data-url",
    link_from_card=False,
    company=(Select("span", token="text-hover-underline"), Select("a")),
    location=Select("div", token="text-truncate", has="title"),
    location_attr="title",
    tags=Select("a", token="itag"),
    salary=Select("a", token="sign-in-view-salary"),
    salary_texts=(S.SALARY_SIGN_IN, S.SALARY_UPDATING),
    host=S.SITE_A_HOST,
    numeric_id=False,
    prefix_empty_link=False,
    tech_stack=None,
)
SITE_B_CARDS = CardRules(
    card=Select("div", token="job-item-search-result"),
    title=(Select("h3"), Select("a", contains="title")),
    link_attr="href",
    link_from_card=True,
    company=(Select("a", contains="company"),),
    location=Select("label", contains="address"),
    location_attr=None,
    tags=None,
    salary=Select("label", contains="salary"),
    salary_texts=(None, S.SALARY_NEGOTIABLE),
    host=S.SITE_B_HOST,
    numeric_id=True,
    prefix_empty_link=True,
    tech_stack=S.TECH_STACK_LATER,
)
# a plain list of links: each <li> is a card
LINK_LIST_CARDS = CardRules(
    card=Select("li"),
    title=(Select("a"),),
    link_attr="href",
    link_from_card=True,
    company=(),
    location=None,
    location_attr=None,
    tags=None,
    salary=None,
    salary_texts=(None, S.SALARY_NEGOTIABLE),
    host=None,
    numeric_id=False,
    prefix_empty_link=False,
    tech_stack=None,
)

SITE_A_JD = (Select("section", contains="job-content"),)
SITE_B_JD = (
    Select("div", id="box-job-information-detail"),
    Select("div", token="job-description__item"),
    Select("div", token="box-info-job"),
)


def _card_fields(node, idx: int, rules: CardRules) -> dict:
    title = node.find(*rules.title)
    link = None
    if title is not None:
        if not rules.link_from_card:
            link = title.attrs.get(rules.link_attr, "")
        else:
            holder = title if title.tag == "a" else node.find(Select("a"))
            link = holder.attrs.get(rules.link_attr) if holder is not None else None
    company = node if rules.company else None
    for rule in rules.company:
        company = company.find(rule) if company is not None else None
    location = node.find(rules.location) if rules.location else None
    if location is not None:
        location = location.attrs[rules.location_attr] if rules.location_attr else location.text()
    salary = None
    if rules.salary:
        present, absent = rules.salary_texts
        hit = node.find(rules.salary)
        salary = absent if hit is None else present or hit.text()
    return {
        "card_idx": idx,
        "title": title.text() if title is not None else None,
        "link": link,
        "company": company.text() if company is not None else None,
        "location": location,
        "tags": [t.text() for t in node.find_all(rules.tags)] if rules.tags else [],
        "salary": salary,
    }


def _cards_udf(rules: CardRules):
    kind = to_arrow_type(DataType.fromDDL(CARD))

    @arrow_udf(CARD)
    def cards_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for html in batches:
            found = [pa.array([], kind)]
            for some in slices.of_array(html):  # the trees and cards of a few pages at a time
                rows = [[_card_fields(n, i, rules) for i, n in enumerate(parse(h).find_all(rules.card))] for h in some.to_pylist()]
                found.append(pa.array(rows, kind))
            yield pa.concat_arrays(found)

    return cards_of


def blocked(html: Column | str) -> Column:
    """Is a saved page a refusal instead of content? A page without a title has the title ''."""
    html = text.col(html)
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return html.contains("Access denied") | title.contains("Cloudflare")


def cards(pages: DataFrame, rules: CardRules, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per card: page_id, card_idx, job_id, job_url, the raw card columns and ``keep``.

    Only the page text crosses into Python; links, ids and fallbacks are JVM expressions. A card
    without a title or link gets an id from (page, position), so a retry gives the same id.
    """
    found = pages.select("page_id", "url", *keep, F.explode(_cards_udf(rules)("html")).alias("c")).select(
        "page_id", "url", *keep, "c.*"
    )
    bad = F.col("title").isNull() | F.col("link").isNull()
    host = F.lit(rules.host) if rules.host else F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    link = F.col("link")
    as_is = link.startswith("http") if rules.prefix_empty_link else (link == "") | link.startswith("http")
    core = text.url_core(F.when(as_is, link).otherwise(F.concat(host, link)))
    error_id = F.concat(F.lit("error_url_"), F.xxhash64("url", "page_id", "card_idx", *keep).cast("string"))
    url = F.when(bad, error_id).otherwise(core)
    stack = F.lit(rules.tech_stack) if rules.tech_stack else F.array_join("tags", ", ")
    return found.select(
        "page_id",
        "card_idx",
        F.when(bad, error_id).otherwise(text.url_number(core) if rules.numeric_id else core).alias("job_id"),
        url.alias("job_url"),
        F.when(bad, F.lit(S.TITLE_ERROR)).otherwise(text.strip("title")).alias("job_title"),
        F.coalesce("company", F.lit(S.UNKNOWN_COMPANY)).alias("company_name"),
        F.coalesce("location", F.lit(S.UNKNOWN_LOCATION)).alias("location"),
        F.col("salary").alias("salary_raw"),
        stack.alias("tech_stack"),
        *keep,
    )


def cards_to_raw(
    found: DataFrame, source: str, keyword: Column, crawl_time: Column, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Card rows in the bronze shape, with the page position for first-seen ordering in front."""
    extra = {
        "source": F.lit(source),
        "crawl_timestamp": text.whole_seconds(crawl_time),
        "experience_level": F.lit(""),
        "job_category": keyword,
        "job_description": F.lit(""),
    }
    return found.select(
        "page_id", "card_idx", *keep, *[extra.get(n, F.col(n) if n in found.columns else None).alias(n) for n in S.RAW.names]
    )


def _detail_udf(rules: tuple[Select, ...]):
    kind = pa.struct([("title", pa.string()), ("jd", pa.string())])

    @arrow_udf("struct<title:string,jd:string>")
    def detail_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for html in batches:
            found = [pa.array([], kind)]
            for some in slices.of_array(html):
                rows = []
                for h in some.to_pylist():
                    tree = parse(h)
                    title, body = tree.find(Select("title")), tree.find(*rules)
                    rows.append({"title": title.text() if title else "", "jd": body.lines() if body else None})
                found.append(pa.array(rows, kind))
            yield pa.concat_arrays(found)

    return detail_of


def job_descriptions(
    pages: DataFrame,
    rules: tuple[Select, ...],
    status: str | None = None,
    bad_status_text: str | None = None,
    check_blocked: bool = True,
) -> DataFrame:
    """(page_id, job_description): the first rule that matches, else a sentinel.

    Blocked pages give 'Connection error' where ``check_blocked``; a non-200 ``status`` column gives
    ``bad_status_text`` or 'Error <code>'.
    """
    cols = ["page_id", "html"] + ([status] if status else [])
    d = pages.select(*cols, _detail_udf(rules)("html").alias("d"))
    out = F.coalesce("d.jd", F.lit(S.JD_NOT_FOUND))
    if check_blocked:
        refused = F.col("html").contains("Access denied") | F.col("d.title").contains("Cloudflare")
        out = F.when(refused, S.JD_CONNECTION_ERROR).otherwise(out)
    if status:
        code = F.concat(F.lit("Error "), F.col(status).cast("string"))
        bad_text = F.lit(bad_status_text) if bad_status_text else code
        out = F.when(F.col(status) != 200, bad_text).otherwise(out)
    return d.select("page_id", out.alias("job_description"))
