"""Registered queries: every operator run over the whole tables of a data folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.functions import rules, text, vectors
from hirelake.operators import contract, dashboard, dense_index, gold, gold_feed, index, partial, postings, search, staging, state
from hirelake.plans import batch, crawl, incremental
from hirelake.sources import pages, scratch, tables
from hirelake.sources.buckets import Buckets
from hirelake.sources.snapshots import Snapshots
from hirelake.sources.testbed import Testbed

Query = Callable[[SparkSession, str], DataFrame]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# the runs the state queries are placed at
AS_OF = dt.datetime(1999, 7, 1, 9, 30)
OLD_END, BATCH_START = "1999-01-01", "1997-01-01"
LATER = dt.datetime(1999, 7, 6, 9, 30)
CRAWL_START = "1998-07-01"
INDEX_DAY = dt.datetime(1998, 4, 25, 9, 30)

CRAWL_DAYS = ("1994-06-01", "1996-09-01")
#: Buckets of the tables that queries write for themselves.
BUCKETS = 16

_QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    _QUERIES[fn.__name__] = lambda spark, root: fn(Testbed(spark, root))
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _day(value: str):
    return F.lit(value).cast("timestamp_ntz")


def _lake(t: Testbed) -> incremental.Lake:
    return incremental.Lake(t.spark, scratch.fresh(t.spark, "lake"), BUCKETS)


# --- staging -----------------------------------------------------------------------


@query
def q01_latest_per_job(t: Testbed) -> DataFrame:
    return staging.latest(t.table("events"), ["user_id"], "ts", ["event_id"])


@query
def q02_latest_per_job_category(t: Testbed) -> DataFrame:
    return staging.latest(t.table("events"), ["user_id", "event_type"], "ts", ["event_id"])


def _staged(t: Testbed) -> DataFrame:
    """Latest observation per job of each site, then both sites."""
    raw = t.raw()
    ties = [c for c in S.RAW.names if c not in ("job_id", "crawl_timestamp")]
    sites = [
        staging.latest(raw.where(F.col("source") == s).select(S.RAW.names), ["job_id"], "crawl_timestamp", ties)
        for s in (S.SITE_B, S.SITE_A)
    ]
    return staging.union_sources(*sites)


@query
def q03_union_sources(t: Testbed) -> DataFrame:
    return _staged(t)


# --- scalar functions ---------------------------------------------------------------


@query
def q05_text_scalars(t: Testbed) -> DataFrame:
    return t.table("documents").select(
        "doc_id",
        text.thousands("n_chars").alias("chars_text"),
        text.to_json_list(F.array("lang", "source", F.lit(None).cast("string"))).alias("json_list"),
        text.remove_text("text", "the ").alias("without_the"),
        F.upper("source").alias("upper_source"),
        F.lower("text").alias("lower_text"),
        text.strip("text").alias("stripped"),
        text.or_none(F.nullif("lang", F.lit("en"))).alias("lang_or_none"),
    )


@query
def q06_url_parts(t: Testbed) -> DataFrame:
    url = F.col("url")
    path = F.regexp_replace(url, "^https?://[^/]*", "")
    return t.table("pages").select(
        "page_id",
        text.url_core(url).alias("core"),
        text.last_path_part(url).alias("last_part"),
        F.substring(text.last_path_part(url), 1, 40).alias("shown"),
        text.absolute_url(path, S.SITE_A_HOST).alias("absolute"),
        text.url_number(F.concat(text.url_core(url), F.lit(".html"))).alias("number"),
        text.first_int(url, -1).alias("first_number"),
        text.point_id(url).alias("point_id"),
    )


@query
def q07_profile_lines(t: Testbed) -> DataFrame:
    yoe, one_line = text.profile_lines("answer", "text")
    return t.answers().select("conv_id", "turn", yoe.alias("yoe"), one_line.alias("query"))


@query
def q08_crawl_times(t: Testbed) -> DataFrame:
    return t.table("events").select(
        "event_id", text.whole_seconds("ts").alias("crawl_timestamp"), F.to_date("ts").alias("crawl_day")
    )


# --- pages and bronze -----------------------------------------------------------------


@query
def q10_extract_cards(t: Testbed) -> DataFrame:
    found = pages.cards(tables.spread(t.table("pages")), pages.LINK_LIST_CARDS)
    return found.select("page_id", "card_idx", "job_id", "job_url", "job_title", "company_name", "location")


@query
def q11_needs_description(t: Testbed) -> DataFrame:
    return t.jd().where(state.needs_description("job_description")).select("job_id", "job_url")


@query
def q12_jd_text(t: Testbed) -> DataFrame:
    return pages.job_descriptions(tables.spread(t.table("pages")), (pages.Select("article"),))


@query
def q13_bronze_insert(t: Testbed) -> DataFrame:
    order = ["keyword_idx", "page", "card", "crawl_timestamp", "salary_raw", "location"]
    raw = t.raw()
    crawl = F.col("crawl_timestamp")
    stored = staging.first_seen(raw.where(crawl < _day(CRAWL_START)), ["job_id"], order).select(S.RAW.names)
    return state.insert_absent(stored, raw.where(crawl >= _day(CRAWL_START)), "job_id", order)


@query
def q14_fill_description(t: Testbed) -> DataFrame:
    fetched = pages.job_descriptions(tables.spread(t.table("pages")), (pages.Select("article"),)).select(
        F.col("page_id").cast("string").alias("job_id"), "job_description"
    )
    return state.update_column(
        t.jd(), fetched, "job_id", "job_description", where=state.needs_description("job_description")
    )


@query
def q15_new_per_page(t: Testbed) -> DataFrame:
    cards = t.table("events").select(
        "user_id", F.col("event_type").alias("keyword"), F.to_date("ts").alias("page"), "event_id"
    )
    return staging.new_per_page(cards, "user_id", "keyword", "page", ["keyword", "page", "event_id"])


@query
def q16_cards_to_bronze(t: Testbed) -> DataFrame:
    keyword = F.split_part(F.col("url"), F.lit("/"), F.lit(4))
    src = tables.spread(t.table("pages")).withColumn("keyword", keyword)
    found = pages.cards(src, pages.LINK_LIST_CARDS, keep=("keyword",))
    raw = pages.cards_to_raw(found, S.SITE_A, F.col("keyword"), _day("2024-01-01 08:00:00"))
    return staging.first_seen(raw, ["job_id"], ["job_category", "page_id", "card_idx"]).select(S.RAW.names)


@query
def q03_union_sources_advanced(t: Testbed) -> DataFrame:
    """The latest-row state after three batches of observations."""
    lake, raw, crawl = _lake(t), t.raw().select(S.RAW.names), F.col("crawl_timestamp")
    first, second = (_day(d) for d in CRAWL_DAYS)
    for part in (crawl < first, (crawl >= first) & (crawl < second), ~F.coalesce(crawl < second, F.lit(False))):
        lake.observe(raw.where(part))
    return lake.jobs.read()


@query
def q13_bronze_insert_buckets(t: Testbed) -> DataFrame:
    """Insert-if-absent that reads only the buckets of the batch's keys."""
    order = ["keyword_idx", "page", "card", "crawl_timestamp", "salary_raw", "location"]
    raw, crawl = t.raw(), F.col("crawl_timestamp")
    table = Buckets(t.spark, scratch.fresh(t.spark, "bronze"), S.RAW, ["job_id"], BUCKETS)
    table.load(staging.first_seen(raw.where(crawl < _day(CRAWL_START)), ["job_id"], order))
    partial.insert_absent(table, raw.where(crawl >= _day(CRAWL_START)), order)
    return table.read()


def _site_page(t: Testbed, broken: str, bare: str, full: str) -> DataFrame:
    """The pages with their lists of links written as one site's job cards.

    Links named The, and, in or to become cards without a title, those from a to m cards with little in them,
    all others full cards; in the templates $1 is the link, $2 its text and {page} the page's id.
    """
    page = t.table("pages")
    html = F.col("html")
    for words, card in (("The|and|in|to", broken), ("[a-m][^<]*", bare), ("[^<]*", full)):
        parts = [F.lit(p) for p in card.split("{page}")]
        made = parts[0]
        for part in parts[1:]:
            made = F.concat(made, F.col("page_id").cast("string"), part)
        html = F.regexp_replace(html, F.lit(f'<li><a href="([^"]*)">({words})</a></li>'), made)
    return tables.spread(page).withColumn("html", html)


def _known_ids(found: DataFrame) -> DataFrame:
    """Cards as they are, the made-up ids of broken ones as 'error'."""
    bad = F.col("job_id").startswith("error_url_") & (F.col("job_id") == F.col("job_url"))
    ids = {c: F.when(bad, F.lit("error")).otherwise(F.col(c)) for c in ("job_id", "job_url")}
    return found.withColumns(ids)


@query
def q17_site_a_cards(t: Testbed) -> DataFrame:
    """Cards by the rules of site A."""
    page = _site_page(
        t,
        '<div class="job-card x"><p>$2</p></div>',
        '<div class="x job-card"><h3 data-url="$1">$2</h3><a class="itags">no</a></div>',
        '<div class="a job-card"><h3 class="t" data-url="$1?lab=1"> <b>$2</b> </h3><span class="k text-hover-underline"><a href="/c">'
        '$2 Co</a></span><div class="text-truncate">none</div><div class="text-truncate" title="City {page}">x</div>'
        '<a class="itag b">$2</a><a class="itag">SQL</a><a class="sign-in-view-salary">in</a></div>',
    )
    return _known_ids(pages.cards(page, pages.SITE_A_CARDS))


@query
def q18_site_b_cards(t: Testbed) -> DataFrame:
    """Cards by the rules of site B; refused pages give none."""
    page = _site_page(
        t,
        '<div class="job-item-search-result"><h3>$2</h3></div>',
        '<div class="job-item-search-result b"><a class="job-title" href="$1">$2</a><label class="note">n</label></div>',
        '<div class="job-item-search-result"><h3><a href="$1/{page}.html?ta=1">$2</a></h3><a class="the company">$2 Co</a>'
        '<label class="address m"> City {page} </label><label class="title salary">{page} - 99</label></div>',
    )
    refused = F.regexp_replace("html", "<title>", "<title>Cloudflare ")
    answers = page.withColumn("html", F.when(F.col("page_id") % 9 == 4, refused).otherwise(F.col("html")))
    return _known_ids(pages.cards(answers.where(~pages.blocked("html")), pages.SITE_B_CARDS))


@query
def q19_site_details(t: Testbed) -> DataFrame:
    """Descriptions by the rules of both sites, with bad answers, refused pages and pages without a text."""
    page = tables.spread(t.table("pages"))
    page_id = F.col("page_id")

    def article(tag: str, attribute: str) -> Column:
        inside = F.replace(F.replace("html", F.lit("<article>"), F.lit(f"<{tag} {attribute}>")), F.lit("</article>"), F.lit(f"</{tag}>"))
        return F.when(page_id % 6 != 1, inside).otherwise(F.col("html"))

    def details(html: Column, bad: Column, status: int) -> DataFrame:
        refused = F.when(page_id % 7 == 0, F.regexp_replace(html, "<title>", "<title>Cloudflare ")).otherwise(html)
        code = F.when(bad, F.lit(status)).otherwise(F.lit(200))
        return page.select(page_id.cast("string").alias("page_id"), refused.alias("html"), code.alias("status"))

    return crawl.detail_texts(
        details(article("section", 'class="x job-content"'), page_id % 5 == 0, 404),
        details(article("div", 'class="box-info-job y"'), page_id % 4 == 0, 500),
    )


# --- gold and market reports ------------------------------------------------------------


@query
def q20_skill_counts(t: Testbed) -> DataFrame:
    return gold.skill_counts(t.silver())


@query
def q20_skill_counts_keyed(t: Testbed) -> DataFrame:
    return gold.skill_counts(t.silver(), keyed=True)


def _moved(t: Testbed) -> incremental.Lake:
    """Silver and gold after an upsert and an expiry, by changes alone."""
    lake, (old, fresh) = _lake(t), _old_and_batch(t)
    lake.load_silver(old)
    lake._apply("upsert", partial.upsert(lake.silver, fresh, AS_OF))
    lake._apply("expire", partial.expire(lake.silver, LATER))
    return lake


@query
def q20_skill_counts_by_feed(t: Testbed) -> DataFrame:
    return _moved(t).gold("skills")


@query
def q20_skill_counts_sketched(t: Testbed) -> DataFrame:
    """Distinct jobs from sketches of single days, merged, next to the exact count: within five standard errors?"""
    days = gold_feed.skill_sketches(t.silver().withColumn("day", F.to_date("processed_at")), "day")
    path = scratch.fresh(t.spark, "sketches")
    days.write.parquet(path)
    guess = gold_feed.approximate_skill_counts(t.spark.read.parquet(path)).withColumnRenamed("total_mentions", "estimate")
    both = gold.skill_counts(t.silver(), keyed=True).join(guess, ["skill", "source"], "left")
    bound = 1 + 5 * 1.04 / 2 ** (gold_feed.LG_K / 2) * F.col("total_mentions")
    return both.select("skill", "source", "total_mentions", (F.abs(F.col("estimate") - F.col("total_mentions")) <= bound).alias("within"))


@query
def q21_role_summary_by_feed(t: Testbed) -> DataFrame:
    return _moved(t).role_summary()


@query
def q21_role_summary_pinned(t: Testbed) -> DataFrame:
    """A mart rebuilt as a table, read at its first version after a second one was written."""
    store = Snapshots(t.spark, scratch.fresh(t.spark, "marts"))
    marts = gold.role_summary(t.silver())
    first = store.write("role_summary", marts)
    store.write("role_summary", gold.role_summary(t.silver().where(F.col("source") == S.SITE_A_SILVER)))
    return store.read("role_summary", marts.schema, first)


@query
def q22_skills_by_level_by_feed(t: Testbed) -> DataFrame:
    return _moved(t).gold("levels")


@query
def q21_role_summary(t: Testbed) -> DataFrame:
    return gold.role_summary(t.silver())


@query
def q22_skills_by_level(t: Testbed) -> DataFrame:
    return gold.skills_by_level(t.silver())


@query
def q23_level_demand(t: Testbed) -> DataFrame:
    return gold.level_demand(t.silver())


@query
def q23_role_demand(t: Testbed) -> DataFrame:
    return gold.role_demand(t.silver())


@query
def q24_csv_skill_top10(t: Testbed) -> DataFrame:
    return gold.csv_skill_demand(t.raw(), "tech_stack")


@query
def q25_json_quality(t: Testbed) -> DataFrame:
    return (
        t.table("events")
        .groupBy("event_type")
        .agg(F.count_if(text.json_list_malformed("props")).alias("not_a_list"), F.count("*").alias("rows"))
    )


# --- silver state changes ----------------------------------------------------------------


@query
def q30_touch_seen(t: Testbed) -> DataFrame:
    return state.touch_seen(t.silver(), t.raw(), AS_OF, S.SITE_B)


@query
def q31_mark_inactive(t: Testbed) -> DataFrame:
    site = F.when(F.col("source") == S.SITE_A, S.SITE_A_SILVER).otherwise(S.SITE_B_SILVER)
    urls = t.raw().select(site.alias("source"), "job_url")
    return state.mark_inactive(t.silver(), urls, [S.SITE_A_SILVER, S.SITE_B_SILVER])


@query
def q31_mark_inactive_null_url(t: Testbed) -> DataFrame:
    """One site's snapshot holds NULL URLs (marks nothing); the other's is empty (marks all)."""
    raw = t.raw().withColumn("job_url", F.when(F.col("location") != S.UNKNOWN_LOCATION, F.col("job_url")))
    seen = {S.SITE_A_SILVER: raw.where(F.col("source") == S.SITE_A), S.SITE_B_SILVER: raw.where(F.lit(False))}
    return state.mark_inactive(t.silver(), state.snapshot_urls(seen), list(seen))


@query
def q32_expire_stale(t: Testbed) -> DataFrame:
    return state.expire_stale(t.silver(), AS_OF)


@query
def q32_expire_counts(t: Testbed) -> DataFrame:
    """Active before, active after and changed rows, in one pass over silver."""
    silver = t.silver().withColumn("before", F.col("status"))
    after = state.expire_stale(silver, AS_OF)
    return after.agg(
        F.count_if(F.col("before") == S.ACTIVE).alias("active_before"),
        F.count_if(F.col("status") == S.ACTIVE).alias("active_after"),
        state.changed_rows(F.col("before"), F.col("status")).alias("expired"),
    )


def _old_and_batch(t: Testbed) -> tuple[DataFrame, DataFrame]:
    silver = t.silver()
    seen = F.col("processed_at")
    old = silver.where(seen < _day(OLD_END))
    fresh = silver.where(seen >= _day(BATCH_START)).drop("processed_at", "last_seen_at", "status")
    fresh = fresh.withColumn("job_title", F.concat("job_title", F.lit(" (again)")))
    return old, state.with_silver_defaults(fresh, AS_OF)


@query
def q33_silver_upsert(t: Testbed) -> DataFrame:
    old, batch = _old_and_batch(t)
    return state.upsert_touch(old, batch, AS_OF)


def _silver_table(t: Testbed, rows: DataFrame) -> Buckets:
    return Buckets(t.spark, scratch.fresh(t.spark, "silver"), S.SILVER, ["job_id"], BUCKETS).load(rows)


@query
def q30_touch_seen_partial(t: Testbed) -> DataFrame:
    table = _silver_table(t, t.silver())
    partial.touch(table, t.raw(), AS_OF, S.SITE_B)
    return table.read()


@query
def q31_mark_inactive_partial(t: Testbed) -> DataFrame:
    table = _silver_table(t, t.silver())
    site = F.when(F.col("source") == S.SITE_A, S.SITE_A_SILVER).otherwise(S.SITE_B_SILVER)
    partial.mark_inactive(table, t.raw().select(site.alias("source"), "job_url"), [S.SITE_A_SILVER, S.SITE_B_SILVER])
    return table.read()


@query
def q32_expire_stale_partial(t: Testbed) -> DataFrame:
    table = _silver_table(t, t.silver())
    partial.expire(table, AS_OF)
    return table.read()


@query
def q33_silver_upsert_partial(t: Testbed) -> DataFrame:
    old, batch = _old_and_batch(t)
    table = _silver_table(t, old)
    partial.upsert(table, batch, AS_OF)
    return table.read()


@query
def q33_status_changes(t: Testbed) -> DataFrame:
    old, batch = _old_and_batch(t)
    return state.status_changes(old, state.upsert_touch(old, batch, AS_OF))


def _records(t: Testbed) -> DataFrame:
    skills = F.transform(F.slice(F.sequence(F.lit(0), F.lit(7)), F.lit(1), F.col("n_skills")), lambda i: F.concat(
        F.lit("s"), i.cast("string")
    ))
    record = F.struct(
        F.col("years").alias("min_years_of_experience"),
        skills.alias("core_tech_stack"),
        F.col("english").alias("english_requirement"),
        F.col("role").alias("job_role"),
        F.col("level").alias("job_level"),
    )
    return t.extracted().select("job_id", "job_url", "job_title", "source", record.alias("record"))


@query
def q34_quarantine(t: Testbed) -> DataFrame:
    """Valid records become silver rows, the others error rows."""
    records = _records(t)
    good = state.with_silver_defaults(contract.silver_rows(records.where(contract.is_valid())), AS_OF)
    return state.quarantine(good, records.where(~contract.is_valid()), AS_OF)


@query
def q34_contract_counts(t: Testbed) -> DataFrame:
    return contract.contract_counts(_records(t))


@query
def q35_pending_jobs(t: Testbed) -> DataFrame:
    known = t.table("labels").select(F.col("doc_id").cast("string").alias("job_id"))
    return state.pending_jobs(t.jd(), known)


# --- extraction ----------------------------------------------------------------------------


@query
def q36_rule_extract(t: Testbed) -> DataFrame:
    rows = contract.extract_rules(t.doc_silver(split=True).select("job_id", "job_title", F.col("text").alias("job_description")))
    return rows.select(
        "job_id",
        "record.min_years_of_experience",
        text.to_json_list("record.core_tech_stack").alias("core_tech_stack"),
        "record.english_requirement",
        "record.job_role",
        "record.job_level",
    )


@query
def q36_infer_level(t: Testbed) -> DataFrame:
    years = F.col("min_years_of_experience")
    return t.silver().select(
        "job_id",
        rules.level_from_years("job_level", years).alias("job_level"),
        rules.level_from_years("job_level", years - 2).alias("job_level_shifted"),
        F.coalesce(F.col("job_level").isin(*S.JOB_LEVELS), F.lit(False)).alias("level_in_contract"),
    )


@query
def q37_skill_dictionary(t: Testbed) -> DataFrame:
    words = t.table("benchmark").select(F.explode(F.array_distinct(text.tokens("text"))).alias("alias"))
    words = words.select("alias", F.upper("alias").alias("canonical"))
    found = contract.skills_from_dictionary(t.doc_silver(split=True), words, "doc_id", "text")
    return found.select("doc_id", F.array_join("skills", ", ").alias("skills"), F.size("skills").alias("n_skills"))


@query
def q37_phrase_dictionary(t: Testbed) -> DataFrame:
    """Aliases of two and three tokens, taken from the benchmark items, in whole documents; longest match first."""
    words = t.table("benchmark").select(text.tokens("text").alias("w"))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)
    spans = words.select("w", F.explode(F.array(F.lit(2), F.lit(3))).alias("n")).where(F.size("w") >= F.col("n"))
    spans = spans.select(F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("alias"))
    aliases = spans.distinct().select("alias", F.concat(F.lit("#"), "alias").alias("canonical"))
    found = contract.skills_from_phrases(t.doc_silver(split=True), aliases, "doc_id", "text")
    return found.select("doc_id", F.array_join("skills", ", ").alias("skills"), F.size("skills").alias("n_skills"))


# --- index ------------------------------------------------------------------------------------


def _flat(docs: DataFrame) -> DataFrame:
    meta = ["job_id", "job_title", "job_url", "yoe", "source"]
    return docs.select("point_id", "page_content", *[F.col(f"metadata.{m}").alias(f"meta_{m}") for m in meta])


@query
def q40_index_full(t: Testbed) -> DataFrame:
    return _flat(index.to_index(t.silver(), INDEX_DAY, full=True))


@query
def q40_index_incremental(t: Testbed) -> DataFrame:
    return _flat(index.to_index(t.silver(), INDEX_DAY, full=False))


@query
def q41_index_delete(t: Testbed) -> DataFrame:
    silver = t.silver()
    return _flat(index.index_delete(index.documents(silver), index.ids_to_delete(silver, INDEX_DAY)))


@query
def q42_index_upsert(t: Testbed) -> DataFrame:
    silver = t.silver()
    seen = F.col("processed_at")
    again = silver.where(seen >= _day(BATCH_START)).withColumn("job_level", F.lit("Senior"))
    return _flat(index.index_upsert(index.documents(silver.where(seen < _day(OLD_END))), index.documents(again)))


@query
def q42_index_sync(t: Testbed) -> DataFrame:
    """A full load on one day and the sync of the next, when some postings had vanished."""
    day = F.col("processed_at")
    before, after = (F.lit(d).cast("date").cast("timestamp_ntz") for d in (INDEX_DAY, INDEX_DAY + dt.timedelta(days=1)))
    first = t.silver().where(day < before)
    gone = F.col("job_id").cast("long") % 5 == 0
    second = (
        t.silver()
        .where(day < after)
        .withColumn("last_seen_at", F.when(gone & (day < before), F.lit(INDEX_DAY).cast("timestamp_ntz")).otherwise(F.col("last_seen_at")))
        .withColumn("status", F.when(gone & (day < before), F.lit(S.INACTIVE)).otherwise(F.col("status")))
    )
    loaded = index.sync(index.documents(first).limit(0), first, INDEX_DAY - dt.timedelta(days=1), True)
    return _flat(index.sync(loaded, second, INDEX_DAY, False))


# --- search ------------------------------------------------------------------------------------


@query
def q43_dense_top30(t: Testbed) -> DataFrame:
    """Every vector asks for its 30 nearest others among those of at most one year more."""
    v = t.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("dense"), F.col("label").alias("yoe"))
    hits = search.top_k(v.withColumnRenamed("id", "qid"), tables.spread(v), ("dense",), 30, exclude_self=True)
    return hits.select("qid", "id", "score", "rank")


@query
def q43_dense_top30_pruned(t: Testbed) -> DataFrame:
    """The same rows from a written index whose groups are skipped by their bounds."""
    v = t.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("dense"), F.col("label").alias("yoe"))
    built = dense_index.build(v, scratch.fresh(t.spark, "vectors"))
    return dense_index.top_k(v.withColumnRenamed("id", "qid"), built, 30, exclude_self=True)[0]


def _corpus(t: Testbed, split: bool = False) -> DataFrame:
    """Documents as postings: payload, whole text and index document."""
    silver = t.doc_silver(split)
    points = index.documents(silver, "text", "doc_id")
    return points.select(
        F.col("doc_id").alias("id"),
        "text",
        F.col("metadata.job_title").alias("title"),
        F.col("metadata.source").alias("source"),
        F.col("metadata.yoe").alias("yoe"),
        "page_content",
        "metadata",
    )


def _indexed(t: Testbed) -> DataFrame:
    return vectors.with_vectors(_corpus(t, split=True).select("id", "yoe", "text"), "text")


def _candidates(t: Testbed) -> search.Queries:
    return search.measured(vectors.with_query_vectors(t.candidates(), "text"))


@query
def q44_sparse_top30(t: Testbed) -> DataFrame:
    hits = search.top_k(_candidates(t), _indexed(t), ("sparse",), 30)
    return hits.select("qid", "id", "score", "rank")


@query
def q44_sparse_top30_blocks(t: Testbed) -> DataFrame:
    """The same rows from impact-ordered postings that are read as far as they can matter."""
    built = postings.build(_indexed(t), scratch.fresh(t.spark, "postings"))
    return postings.top_k(_candidates(t), built, 30)[0]


def _fused(t: Testbed, q: search.Queries) -> DataFrame:
    return search.fuse(search.top_k(q, _indexed(t), k=30), k=30)


@query
def q45_rrf(t: Testbed) -> DataFrame:
    return _fused(t, _candidates(t))


def _ranked(t: Testbed, *carry: str, dedupe: tuple[str, ...] = ("text",)) -> tuple[search.Queries, DataFrame]:
    q = _candidates(t)
    ranked = search.rerank(
        _fused(t, q), q, _corpus(t, split=True), depth=30, n=10, dedupe=list(dedupe), carry=list(carry)
    )
    return q, ranked


@query
def q46_rerank_top10(t: Testbed) -> DataFrame:
    return _ranked(t)[1]


@query
def q46_rerank_by_title(t: Testbed) -> DataFrame:
    """Postings of one title and source are one recommendation."""
    return _ranked(t, dedupe=("title", "source"))[1]


@query
def q46_rerank_model(t: Testbed) -> DataFrame:
    """The same ranking by a pair model that sees texts in batches of like lengths."""

    def load():
        import re

        def tokens(x: str) -> set[str]:
            return {w for w in re.findall(r"[^\W_]+", x.lower())}

        def score(pairs: list[tuple[str, str]]) -> list[float]:
            both = [(tokens(a), tokens(b)) for a, b in pairs]
            return [len(a & b) / len(a) if a else 0.0 for a, b in both]

        return score

    q = _candidates(t)
    model = search.ModelScorer("token overlap", load)
    return search.rerank(_fused(t, q), q, _corpus(t, split=True), depth=30, n=10, scorer=model, dedupe=["text"])


@query
def q47_match_context(t: Testbed) -> DataFrame:
    q, ranked = _ranked(t, "page_content")
    return search.context(ranked, q)


@query
def q47_match_cards(t: Testbed) -> DataFrame:
    return search.cards(_ranked(t, "page_content", "metadata")[1])


@query
def q47_candidate_profiles(t: Testbed) -> DataFrame:
    rows = contract.candidate_profiles(t.table("conversations"), "conv_id", "text")
    return rows.select("conv_id", "yoe", "query", F.array_join("skills", ", ").alias("skills"))


@query
def q48_skill_gap(t: Testbed) -> DataFrame:
    have = F.array(
        F.concat(F.lit("S"), (F.col("c_nationkey") % 20).cast("string")), F.lit("T1"), F.lit("t4"), F.lit(None), F.lit("")
    )
    candidates = t.table("customer").select(F.col("c_custkey").alias("qid"), have.alias("have"))
    jobs = t.table("orders").select(F.col("o_orderkey").cast("string").alias("job_id"), F.col("o_custkey").alias("qid"))
    need = t.silver().select("job_id", text.json_list("ai_core_tech_stack").alias("required"))
    gaps = search.skill_gap(jobs.join(need, "job_id").join(candidates, "qid"), "required", "have")
    return gaps.select(
        "qid", "job_id", F.array_join("matched", ",").alias("matched"), F.array_join("missing", ",").alias("missing")
    )


# --- dashboard -------------------------------------------------------------------------------------


@query
def q50_kpis(t: Testbed) -> DataFrame:
    return dashboard.kpis(t.silver())


@query
def q50_kpis_filtered(t: Testbed) -> DataFrame:
    return dashboard.kpis(t.silver(), S.SITE_B_SILVER, "Senior")


@query
def q51_levels(t: Testbed) -> DataFrame:
    return dashboard.levels(t.silver())


@query
def q52_yoe_histogram(t: Testbed) -> DataFrame:
    return dashboard.yoe_histogram(t.silver())


@query
def q52_wide_histogram(t: Testbed) -> DataFrame:
    """The same bins over a wide range: candidates' years taken from part sizes."""
    wide = t.table("part").select(
        F.col("p_size").alias("min_years_of_experience"), F.lit(S.ACTIVE).alias("status")
    )
    return dashboard.yoe_histogram(wide)


@query
def q53_source_options(t: Testbed) -> DataFrame:
    return dashboard.source_options(t.silver())


@query
def q53_level_options(t: Testbed) -> DataFrame:
    return dashboard.level_options(t.silver())


@query
def q54_kpi_cube(t: Testbed) -> DataFrame:
    return dashboard.kpi_cube(t.silver())


@query
def q57_top10_skills(t: Testbed) -> DataFrame:
    return dashboard.top_skills(t.silver())


@query
def q57_top10_skills_filtered(t: Testbed) -> DataFrame:
    return dashboard.top_skills(t.silver(), S.SITE_A_SILVER, "Middle")


@query
def q58_english_levels(t: Testbed) -> DataFrame:
    return dashboard.english_levels(t.silver())


# --- profiles ---------------------------------------------------------------------------------------


@query
def q60_profile(t: Testbed) -> DataFrame:
    return tables.profile({n: t.table(n) for n in TABLES})


@query
def q60_table_peek(t: Testbed) -> DataFrame:
    return tables.peek(t.raw().select("job_url", "job_title"), ["job_url", "job_title"])


@query
def q60_index_peek(t: Testbed) -> DataFrame:
    return tables.peek(_flat(index.documents(t.silver())), ["point_id"], 1)


@query
def q60_duplicate_keys(t: Testbed) -> DataFrame:
    return state.duplicate_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def q61_batch_silver(t: Testbed) -> DataFrame:
    """The silver part of a batch run: touch, extract, upsert, quarantine, mark inactive, expire."""
    staged, path = batch.staged(t.raw().select(S.RAW.names)), scratch.fresh(t.spark, "jobs")
    staged.write.parquet(path)  # read four times below, as a batch run reads int_all_jobs
    jobs = t.spark.read.schema(staged.schema).parquet(path)
    old = t.silver().where(F.col("processed_at") < _day(OLD_END))
    records = batch.extract_step(state.pending_jobs(jobs, old, keep=("source",)))
    return batch.silver_step(old, jobs, records, AS_OF)


@query
def q61_batch_silver_partial(t: Testbed) -> DataFrame:
    """The same run on bucketed tables."""
    lake = _lake(t)
    lake.load_silver(t.silver().where(F.col("processed_at") < _day(OLD_END)))
    lake.observe(t.raw())
    path = scratch.fresh(t.spark, "records")
    batch.extract_step(lake.pending()).write.parquet(path)
    lake.advance(lake.jobs.read(), t.spark.read.schema(batch.RECORDS).parquet(path), AS_OF, lake.crawl_urls())
    return lake.silver.read()


#: Queries that write tables of their own before they answer.
WRITING = {
    name
    for name in _QUERIES
    if name.endswith(("_advanced", "_buckets", "_by_feed", "_sketched", "_partial", "_pruned", "_blocks", "_pinned"))
}
