"""The registered queries once more, as SQL for another engine over the same tables.

Column names and types follow the Spark side. Patterns and vocabularies are the same fixed values;
everything else is written against the tables directly.
"""

from __future__ import annotations

from hirelake import schemas as S
from hirelake.functions import rules
from hirelake.plans import catalog as C
from hirelake.sources import testbed as B

SILVER = f"silver AS ({B.SILVER_SQL.format(orders='orders')})"
RAW = f"raw AS ({B.RAW_SQL.format(lineitem='lineitem')})"
JD = f"jd AS ({B.JD_SQL.format(documents='documents')})"
EXTRACTED = f"extracted AS ({B.EXTRACTED_SQL.format(orders='orders')})"
DOCS = f"docs AS ({B.DOC_SILVER_SQL.format(documents='documents')})"
CANDIDATES = f"candidates AS ({B.CANDIDATE_SQL.format(benchmark='benchmark')})"
ANSWERS = f"answers AS ({B.ANSWER_SQL.format(conversations='conversations')})"

SILVER_COLS = ", ".join(S.SILVER.names)
RAW_COLS = ", ".join(S.RAW.names)


def _ts(d) -> str:
    return f"TIMESTAMP '{d.isoformat(sep=' ')}'"


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


AS_OF = _ts(C.AS_OF)
INDEX_DAY = _ts(C.INDEX_DAY)

RAW_TIES = ", ".join(f"{c} DESC NULLS LAST" for c in S.RAW.names if c not in ("job_id", "crawl_timestamp"))
STAGED = f"""{RAW}, staged AS (
  SELECT {RAW_COLS} FROM raw
  QUALIFY row_number() OVER (PARTITION BY source, job_id ORDER BY crawl_timestamp DESC NULLS LAST, {RAW_TIES}) = 1)"""

NOT_WORD = r"[^\p{L}\p{N}]+"
STRIP = "trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
TOKENS = r"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"

# text pieces of an HTML fragment, one per line; in HTML these entities also count without their semicolon
LINES = (
    "array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace({x}, "
    r"'<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'gs'), '<[^>]*>', chr(1), 'g'), chr(1)), "
    "lambda s: trim(regexp_replace(regexp_replace(regexp_replace(s, '&quot;?', '\"', 'g'), '&lt;?', '<', 'g'), "
    "'&amp;?', '&', 'g'), "
    "' ' || chr(9) || chr(10) || chr(13))), lambda s: s <> ''), chr(10))"
)
ARTICLE = r"regexp_extract(html, '<article[^>]*>(.*?)</article>', 1, 's')"
PAGE_JD = f"""page_jd AS (
  SELECT page_id, CASE
    WHEN contains(html, 'Access denied') OR contains(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), 'Cloudflare')
      THEN 'Connection error'
    WHEN NOT contains(html, '<article') THEN 'JD content not found'
    ELSE {LINES.format(x=ARTICLE)} END AS job_description
  FROM pages)"""

LINKS = r"""links AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS link,
    unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)) AS title,
    unnest(range(len(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)))) AS card_idx
  FROM pages), cards AS (
  SELECT page_id, url, CAST(card_idx AS INTEGER) AS card_idx,
    split_part(CASE WHEN link = '' OR starts_with(link, 'http') THEN link
      ELSE concat(regexp_extract(url, '^(https?://[^/?#]+)', 1), link) END, '?', 1) AS job_id,
    trim(title) AS job_title FROM links)"""

SKILLS = """skills AS (
  SELECT job_id, source, job_level, status, unnest(from_json(ai_core_tech_stack, '["VARCHAR"]')) AS skill
  FROM silver WHERE ai_core_tech_stack IS NOT NULL AND ai_core_tech_stack <> '[]')"""

KPI = """CAST(count(*) FILTER (job_level <> 'Error') AS BIGINT) AS jobs,
  coalesce(round(avg(min_years_of_experience), 1), 0.0) AS avg_yoe,
  CAST(count(*) FILTER (english_requirement <> 'Not mentioned') AS BIGINT) AS english_jobs"""
PCT = "CASE WHEN jobs > 0 THEN round(100.0 * english_jobs / CAST(jobs AS DOUBLE), 1) ELSE 0.0 END AS english_pct"


def _kpis(where: str) -> str:
    return f"""WITH {SILVER}, k AS (SELECT {KPI} FROM silver WHERE status = 'Active' {where})
SELECT jobs, format('{{:,}}', jobs) AS jobs_text, avg_yoe, english_jobs, {PCT} FROM k"""


def _top_skills(where: str) -> str:
    return f"""WITH {SILVER}, {SKILLS}
SELECT skill, count(*) AS total_mentions FROM skills
WHERE status = 'Active' AND job_level <> 'Error' AND skill <> '' {where}
GROUP BY skill ORDER BY total_mentions DESC, skill LIMIT 10"""


def _histogram(rows: str) -> str:
    return f"""WITH {SILVER}, y AS ({rows}),
b AS (SELECT min(yoe)::BIGINT AS lo, greatest(1, ceil((max(yoe) - min(yoe) + 1) / 10.0))::BIGINT AS w FROM y)
SELECT lo + ((yoe - lo) // w) * w AS bin_start, lo + ((yoe - lo) // w) * w + w AS bin_end, count(*) AS n_jobs
FROM y, b GROUP BY ALL"""


def _content(level: str = "job_level", title: str = "job_title") -> str:
    def n(c):
        return f"coalesce(CAST({c} AS VARCHAR), 'None')"

    return (
        f"'Source: ' || {n('source')} || ' | Title: ' || {n(title)} || ' | Tech: ' || {n('ai_core_tech_stack')}"
        f" || ' | Level: ' || {n(level)} || ' | Exp: ' || {n('min_years_of_experience')}"
        f" || ' years | English: ' || {n('english_requirement')}"
    )


POINT = r"regexp_replace(md5(CAST({x} AS VARCHAR)), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\1-\2-\3-\4-\5')"


def _points(level: str = "job_level") -> str:
    return (
        f"{POINT.format(x='job_id')} AS point_id, {_content(level)} AS page_content, job_id AS meta_job_id, "
        "job_title AS meta_job_title, job_url AS meta_job_url, min_years_of_experience AS meta_yoe, source AS meta_source"
    )


def _words(x: str) -> str:
    return f"regexp_replace(' ' || lower(coalesce({x}, '')) || ' ', {_q(NOT_WORD)}, ' ', 'g')"


def _any(phrases, *texts: str) -> str:
    return "(" + " OR ".join(f"contains({t}, {_q(rules.needle(p))})" for t in texts for p in phrases) + ")"


def _rule_case(text: str, rule_list, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {_any(ps, text)} THEN {_q(v)}" for v, ps in rule_list) + f" ELSE {default} END"


def _infer(level: str, years: str) -> str:
    return f"""CASE WHEN {level} = 'Unknown' THEN CASE WHEN {years} = 0 THEN 'Fresher' WHEN {years} IN (1, 2) THEN 'Junior'
  WHEN {years} IN (3, 4) THEN 'Middle' WHEN {years} >= 5 THEN 'Senior' ELSE {level} END ELSE {level} END"""


def _rule_extract(src: str, title: str, body: str) -> str:
    """CTE text ``ex``: job_id and the record columns for a CTE holding job_id, title and body."""
    full = f"lower(concat_ws(chr(10), {title}, {body}))"
    english = f"""CASE WHEN {_any(rules.CERTIFICATE_PHRASES, 'tw', 'dw')} THEN {_q(S.ENGLISH_CERTIFICATE)}
    WHEN {_any(rules.COMMUNICATION_PHRASES, 'tw', 'dw')} OR ({_any([rules.ENGLISH_PHRASE], 'tw', 'dw')}
      AND regexp_matches(full_, {_q(rules.COMMUNICATION_SENTENCE)})) THEN {_q(S.ENGLISH_COMMUNICATION)}
    WHEN {_any([rules.ENGLISH_PHRASE], 'tw', 'dw')} THEN {_q(S.ENGLISH_READING)} ELSE {_q(S.ENGLISH_NONE)} END"""
    aliases = ", ".join(
        f"({_q(a)}, {_q(name)})" for name, spellings in S.SKILL_ALIASES.items() for a in spellings
    )
    return f"""aliases(alias, canonical) AS (VALUES {aliases}),
words AS (SELECT job_id, unnest(w) AS alias, unnest(range(len(w))) AS pos FROM (
  SELECT job_id, regexp_extract_all({full}, {_q(rules.SKILL_TOKEN)}) AS w FROM {src})),
found AS (SELECT job_id, canonical, min(pos) AS pos FROM words JOIN aliases USING (alias) GROUP BY job_id, canonical
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY min(pos)) <= 5),
lists AS (SELECT job_id, list(canonical ORDER BY pos) AS skills FROM found GROUP BY job_id),
norm AS (SELECT {src}.*, skills, {full} AS full_,
  {_words(title)} AS tw, {_words(body)} AS dw FROM {src} LEFT JOIN lists USING (job_id)),
ex0 AS (SELECT *,
  coalesce(TRY_CAST(nullif(regexp_extract(full_, {_q(rules.YEARS)}, 1), '') AS INTEGER), 0) AS years,
  '[' || coalesce(array_to_string(list_transform(skills, lambda x: '"' || x || '"'), ', '), '') || ']' AS stack,
  {english} AS english,
  {_rule_case('tw', rules.ROLE_RULES, _rule_case('dw', rules.ROLE_RULES, _q(S.UNKNOWN)))} AS role,
  {_rule_case('tw', rules.LEVEL_RULES, _rule_case('dw', rules.LEVEL_RULES, _q(S.UNKNOWN)))} AS stated FROM norm),
ex AS (SELECT *, {_infer('stated', 'years')} AS level FROM ex0)"""


# --- search -----------------------------------------------------------------------------

SPARSE = f"""q AS (SELECT DISTINCT qid, yoe, unnest({TOKENS.format(x='text')}) AS term FROM candidates),
tok AS (SELECT doc_id, min_years_of_experience AS yoe, {TOKENS.format(x='text')} AS w FROM docs),
tf AS (SELECT doc_id, yoe, term, len_ AS len_, count(*) AS n
  FROM (SELECT doc_id, yoe, len(w) AS len_, unnest(w) AS term FROM tok) GROUP BY ALL),
sparse0 AS (SELECT q.qid, tf.doc_id AS id, round(sum(n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len_ / 256.0))), 6) AS score
  FROM q JOIN tf ON q.term = tf.term AND tf.yoe <= q.yoe + 1 GROUP BY ALL),
sparse AS (SELECT qid, id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM sparse0 QUALIFY rank <= 30)"""

_BUCKET = "CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 256"
DENSE = f"""dv AS (SELECT doc_id, {_BUCKET} AS slot, CAST(sum(n) AS DOUBLE) AS v FROM tf GROUP BY ALL),
dn AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM dv GROUP BY doc_id),
qv AS (SELECT qid, {_BUCKET} AS slot, CAST(count(*) AS DOUBLE) AS v
  FROM (SELECT qid, unnest({TOKENS.format(x='text')}) AS term FROM candidates) GROUP BY ALL),
qn AS (SELECT qid, sqrt(sum(v * v)) AS norm FROM qv GROUP BY qid),
dots AS (SELECT qid, doc_id, sum(qv.v * dv.v) AS dot FROM qv JOIN dv USING (slot) GROUP BY ALL),
dense0 AS (SELECT c.qid, d.doc_id AS id, round(coalesce(dot / (qn.norm * dn.norm), 0.0), 6) AS score
  FROM candidates c JOIN docs d ON d.min_years_of_experience <= c.yoe + 1
  LEFT JOIN dots ON dots.qid = c.qid AND dots.doc_id = d.doc_id
  LEFT JOIN qn ON qn.qid = c.qid LEFT JOIN dn ON dn.doc_id = d.doc_id),
dense AS (SELECT qid, id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM dense0 QUALIFY rank <= 30)"""
FUSED = """fused0 AS (SELECT qid, id, round(sum(1.0::DOUBLE / (2.0 + rank - 1)), 6) AS rrf
  FROM (SELECT qid, id, rank FROM dense UNION ALL SELECT qid, id, rank FROM sparse) GROUP BY ALL),
fused AS (SELECT qid, id, rrf, CAST(row_number() OVER (PARTITION BY qid ORDER BY rrf DESC, id) AS INTEGER) AS rank
  FROM fused0 QUALIFY rank <= 30)"""
RANKED = f"""pairs AS (SELECT f.qid, f.id, d.job_title AS title, d.source, d.text,
    list_distinct({TOKENS.format(x='c.text')}) AS qt, list_distinct({TOKENS.format(x='d.text')}) AS dt_
  FROM fused f JOIN docs d ON d.doc_id = f.id JOIN candidates c ON c.qid = f.qid),
scored AS (SELECT qid, id, title, source,
  round(CASE WHEN len(qt) > 0 THEN len(list_intersect(qt, dt_)) / CAST(len(qt) AS DOUBLE) ELSE 0.0 END, 6) AS rerank
  FROM pairs QUALIFY row_number() OVER (PARTITION BY qid, text ORDER BY rerank DESC, id) = 1),
ranked AS (SELECT qid, id, rerank, CAST(row_number() OVER (PARTITION BY qid ORDER BY rerank DESC, id) AS INTEGER) AS rank
  FROM scored QUALIFY rank <= 10)"""
SEARCH = f"{DOCS}, {CANDIDATES}, {SPARSE}, {DENSE}, {FUSED}"


def _upsert() -> str:
    return f"""{SILVER}, old AS (SELECT * FROM silver WHERE processed_at < TIMESTAMP '{C.OLD_END}'),
new AS (SELECT * FROM silver WHERE processed_at >= TIMESTAMP '{C.BATCH_START}'),
up AS (SELECT coalesce(old.job_id, new.job_id) AS job_id,
  CASE WHEN old.job_id IS NOT NULL THEN old.job_url ELSE new.job_url END AS job_url,
  CASE WHEN old.job_id IS NOT NULL THEN old.job_title ELSE new.job_title || ' (again)' END AS job_title,
  CASE WHEN old.job_id IS NOT NULL THEN old.min_years_of_experience ELSE new.min_years_of_experience END
    AS min_years_of_experience,
  CASE WHEN old.job_id IS NOT NULL THEN old.ai_core_tech_stack ELSE new.ai_core_tech_stack END AS ai_core_tech_stack,
  CASE WHEN old.job_id IS NOT NULL THEN old.english_requirement ELSE new.english_requirement END AS english_requirement,
  CASE WHEN old.job_id IS NOT NULL THEN old.ai_job_role ELSE new.ai_job_role END AS ai_job_role,
  CASE WHEN old.job_id IS NOT NULL THEN old.job_level ELSE new.job_level END AS job_level,
  CASE WHEN old.job_id IS NOT NULL THEN old.source ELSE new.source END AS source,
  CASE WHEN old.job_id IS NOT NULL THEN old.processed_at ELSE {AS_OF} END AS processed_at,
  CASE WHEN new.job_id IS NOT NULL THEN {AS_OF} ELSE old.last_seen_at END AS last_seen_at,
  CASE WHEN new.job_id IS NOT NULL THEN 'Active' ELSE old.status END AS status
  FROM old FULL JOIN new ON old.job_id = new.job_id)"""


def _profile() -> str:
    types = {
        "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
        "TIMESTAMP": "timestamp_ntz", "FLOAT[]": "array<float>",
    }
    case = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in types.items())
    return "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS table_name, column_name, CAST(row_number() OVER () AS INTEGER) AS ordinal,
  CASE column_type {case} END AS data_type, count AS row_count,
  CAST(round(count * CAST(null_percentage AS DOUBLE) / 100) AS BIGINT) AS null_count FROM (SUMMARIZE {t})"""
        for t in C.TABLES
    )


def _batch_silver() -> str:
    site = "CASE source WHEN 'ITViec' THEN 'ITVIEC' ELSE 'TOPCV' END"
    return f"""WITH {SILVER}, {STAGED},
old AS (SELECT * FROM silver WHERE processed_at < TIMESTAMP '{C.OLD_END}'),
pend AS (SELECT job_id, job_url, job_title, job_description, {site} AS source FROM staged
  WHERE job_description NOT IN ('JD content not found', 'Connection error')
    AND job_id NOT IN (SELECT job_id FROM old)
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY {site}, job_title, job_description) = 1),
{_rule_extract('pend', 'job_title', 'job_description')},
merged AS (
  SELECT job_id, job_url, job_title, min_years_of_experience, ai_core_tech_stack, english_requirement, ai_job_role,
    job_level, source, processed_at,
    CASE WHEN job_id IN (SELECT job_id FROM staged) THEN {AS_OF} ELSE last_seen_at END AS last_seen_at,
    CASE WHEN job_id IN (SELECT job_id FROM staged) THEN 'Active' ELSE status END AS status FROM old
  UNION ALL
  SELECT job_id, job_url, job_title, years, stack, english, role, level, source, {AS_OF}, {AS_OF}, 'Active' FROM ex),
cleaned AS (SELECT * REPLACE (CASE
  WHEN source = 'ITVIEC' AND job_url NOT IN (SELECT job_url FROM staged WHERE source = 'ITViec') THEN 'Inactive'
  WHEN source = 'TOPCV' AND job_url NOT IN (SELECT job_url FROM staged WHERE source = 'TopCV') THEN 'Inactive'
  ELSE status END AS status) FROM merged)
SELECT * REPLACE (CASE WHEN status = 'Active' AND last_seen_at < {AS_OF} - INTERVAL 3 DAY THEN 'Expired'
  ELSE status END AS status) FROM cleaned"""


def oracle_sql() -> dict[str, str]:
    contract_ok = f"""(years IS NOT NULL AND n_skills <= {S.MAX_SKILLS} AND english IN {_in(S.ENGLISH_LEVELS)}
  AND role IN {_in(S.JOB_ROLES)} AND level IN {_in(S.JOB_LEVELS)})"""
    crawl_order = "keyword_idx, page, card, crawl_timestamp, salary_raw, location"
    out = {}

    out["q01_latest_per_job"] = """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
    out["q02_latest_per_job_category"] = """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""
    out["q03_union_sources"] = f"WITH {STAGED} SELECT * FROM staged"

    out["q05_text_scalars"] = f"""SELECT doc_id, format('{{:,}}', n_chars) AS chars_text,
  '["' || lang || '", "' || source || '", null]' AS json_list, replace(text, 'the ', '') AS without_the,
  upper(source) AS upper_source, lower(text) AS lower_text, {STRIP.format(x='text')} AS stripped,
  CASE WHEN lang = 'en' THEN 'None' ELSE lang END AS lang_or_none FROM documents"""
    out["q06_url_parts"] = f"""SELECT page_id, split_part(url, '?', 1) AS core,
  string_split(url, '/')[-1] AS last_part, string_split(url, '/')[-1][1:40] AS shown,
  CASE WHEN regexp_replace(url, '^https?://[^/]*', '') = '' THEN ''
    ELSE 'https://itviec.com' || regexp_replace(url, '^https?://[^/]*', '') END AS absolute,
  CASE WHEN regexp_matches(split_part(url, '?', 1) || '.html', '/[0-9]+\\.html')
    THEN regexp_extract(split_part(url, '?', 1) || '.html', '/([0-9]+)\\.html', 1)
    ELSE split_part(url, '?', 1) || '.html' END AS number,
  coalesce(TRY_CAST(nullif(regexp_extract(url, '([0-9]+)', 1), '') AS INTEGER), -1) AS first_number,
  {POINT.format(x='url')} AS point_id FROM pages"""
    lines = f"string_split({STRIP.format(x='answer')}, chr(10))"
    out["q07_profile_lines"] = f"""WITH {ANSWERS}, l AS (
  SELECT conv_id, turn, text, unnest({lines}) AS line, unnest(range(len({lines}))) AS pos FROM answers),
stop AS (SELECT conv_id, turn, min(pos) AS pos FROM l
  WHERE starts_with(line, 'YOE:') AND NOT regexp_matches(line, '[0-9]') GROUP BY ALL),
ok AS (SELECT l.* FROM l LEFT JOIN stop ON l.conv_id = stop.conv_id AND l.turn = stop.turn
  WHERE stop.pos IS NULL OR l.pos < stop.pos)
SELECT a.conv_id, a.turn,
  coalesce((SELECT CAST(regexp_extract(arg_max(line, pos), '([0-9]+)', 1) AS INTEGER) FROM ok
    WHERE ok.conv_id = a.conv_id AND ok.turn = a.turn AND starts_with(line, 'YOE:')), 0) AS yoe,
  coalesce((SELECT {STRIP.format(x="replace(arg_max(line, pos), 'QUERY:', '')")} FROM ok
    WHERE ok.conv_id = a.conv_id AND ok.turn = a.turn AND starts_with(line, 'QUERY:')), a.text) AS query
FROM answers a"""

    out["q08_crawl_times"] = """SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS crawl_timestamp,
  CAST(ts AS DATE) AS crawl_day FROM events"""

    out["q10_extract_cards"] = f"""WITH {LINKS}
SELECT page_id, card_idx, job_id, job_id AS job_url, job_title, 'Unknown company' AS company_name,
  'Unknown location' AS location FROM cards"""
    out["q11_needs_description"] = f"""WITH {JD} SELECT job_id, job_url FROM jd
WHERE job_description IS NULL OR job_description = '' OR job_description = 'Connection error'"""
    out["q12_jd_text"] = f"WITH {PAGE_JD} SELECT * FROM page_jd"
    out["q13_bronze_insert"] = f"""WITH {RAW},
old AS (SELECT * FROM raw WHERE crawl_timestamp < TIMESTAMP '{C.CRAWL_START}'
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY {crawl_order}) = 1),
new AS (SELECT * FROM raw WHERE crawl_timestamp >= TIMESTAMP '{C.CRAWL_START}'
  QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY {crawl_order}) = 1)
SELECT {RAW_COLS} FROM old UNION ALL SELECT {RAW_COLS} FROM new WHERE job_id NOT IN (SELECT job_id FROM old)"""
    out["q14_fill_description"] = f"""WITH {JD}, {PAGE_JD}
SELECT job_id, job_url, job_title, source, CASE WHEN p.page_id IS NOT NULL
    AND (jd.job_description IS NULL OR jd.job_description IN ('', 'Connection error'))
  THEN p.job_description ELSE jd.job_description END AS job_description
FROM jd LEFT JOIN page_jd p ON CAST(p.page_id AS VARCHAR) = jd.job_id"""
    out["q15_new_per_page"] = """WITH c AS (SELECT event_type AS keyword, CAST(ts AS DATE) AS page,
  row_number() OVER (PARTITION BY user_id ORDER BY event_type, CAST(ts AS DATE), event_id) AS rn FROM events)
SELECT keyword, page, CAST(count(*) FILTER (rn = 1) AS BIGINT) AS n_new FROM c GROUP BY ALL"""
    out["q16_cards_to_bronze"] = f"""WITH {LINKS}, r AS (
  SELECT job_id, job_id AS job_url, job_title, 'Unknown company' AS company_name, 'Unknown location' AS location,
    CAST(NULL AS VARCHAR) AS salary_raw, '' AS tech_stack, 'ITViec' AS source,
    TIMESTAMP '2024-01-01 08:00:00' AS crawl_timestamp, '' AS experience_level, split_part(url, '/', 4) AS job_category,
    '' AS job_description, page_id, card_idx FROM cards)
SELECT {RAW_COLS} FROM r
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY job_category, page_id, card_idx) = 1"""

    out["q20_skill_counts"] = f"""WITH {SILVER}, {SKILLS}
SELECT skill, source, count(DISTINCT job_id) AS total_mentions FROM skills WHERE skill <> '' GROUP BY skill, source"""
    out["q20_skill_counts_keyed"] = out["q20_skill_counts"]
    out["q21_role_summary"] = f"""WITH {SILVER}
SELECT ai_job_role AS job_role, source, count(*) AS total_jobs,
  round(avg(min_years_of_experience), 1) AS avg_years_required
FROM silver WHERE ai_job_role NOT IN ('Unknown', 'Error') GROUP BY ALL"""
    out["q22_skills_by_level"] = f"""WITH {SILVER}, {SKILLS}
SELECT job_level, skill, source, count(*) AS mentions FROM skills
WHERE skill <> '' AND job_level NOT IN ('Error', 'Unknown') GROUP BY ALL"""
    out["q23_level_demand"] = f"""WITH {SILVER}
SELECT job_level AS level, count(*) AS total_jobs FROM silver GROUP BY ALL ORDER BY total_jobs DESC, level NULLS LAST"""
    out["q23_role_demand"] = f"""WITH {SILVER}
SELECT ai_job_role AS role, count(*) AS total_jobs FROM silver GROUP BY ALL
ORDER BY total_jobs DESC, role NULLS LAST LIMIT 10"""
    out["q24_csv_skill_top10"] = f"""WITH {RAW}, v AS (SELECT unnest(string_split(tech_stack, ',')) AS x FROM raw)
SELECT trim(x) AS tech_skill, count(*) AS mentions FROM v WHERE x <> '' AND x <> 'Unknown'
GROUP BY trim(x) ORDER BY mentions DESC, tech_skill LIMIT 10"""
    out["q25_json_quality"] = """SELECT event_type,
  CAST(count(*) FILTER (props IS NOT NULL AND json_type(props) <> 'ARRAY') AS BIGINT) AS not_a_list, count(*) AS rows
FROM events GROUP BY event_type"""

    out["q30_touch_seen"] = f"""WITH {SILVER}, {RAW}, hit AS (SELECT job_id FROM raw WHERE source = 'TopCV')
SELECT * REPLACE (
  CASE WHEN job_id IN (SELECT job_id FROM hit) THEN {AS_OF} ELSE last_seen_at END AS last_seen_at,
  CASE WHEN job_id IN (SELECT job_id FROM hit) THEN 'Active' ELSE status END AS status) FROM silver"""
    out["q31_mark_inactive"] = f"""WITH {SILVER}, {RAW}
SELECT * REPLACE (CASE
  WHEN source = 'ITVIEC' AND job_url NOT IN (SELECT job_url FROM raw WHERE source = 'ITViec') THEN 'Inactive'
  WHEN source = 'TOPCV' AND job_url NOT IN (SELECT job_url FROM raw WHERE source = 'TopCV') THEN 'Inactive'
  ELSE status END AS status) FROM silver"""
    out["q31_mark_inactive_null_url"] = f"""WITH {SILVER}, {RAW},
n AS (SELECT source, CASE WHEN location <> 'Unknown location' THEN job_url END AS job_url FROM raw)
SELECT * REPLACE (CASE
  WHEN source = 'ITVIEC' AND job_url NOT IN (SELECT job_url FROM n WHERE source = 'ITViec') THEN 'Inactive'
  WHEN source = 'TOPCV' AND job_url NOT IN (SELECT job_url FROM n WHERE false) THEN 'Inactive'
  ELSE status END AS status) FROM silver"""
    stale = f"status = 'Active' AND last_seen_at < {AS_OF} - INTERVAL 3 DAY"
    out["q32_expire_stale"] = f"""WITH {SILVER}
SELECT * REPLACE (CASE WHEN {stale} THEN 'Expired' ELSE status END AS status) FROM silver"""
    out["q32_expire_counts"] = f"""WITH {SILVER}
SELECT CAST(count(*) FILTER (status = 'Active') AS BIGINT) AS active_before,
  CAST(count(*) FILTER (status = 'Active' AND NOT ({stale})) AS BIGINT) AS active_after,
  CAST(count(*) FILTER ({stale}) AS BIGINT) AS expired FROM silver"""
    out["q33_silver_upsert"] = f"WITH {_upsert()} SELECT * FROM up"
    out["q33_status_changes"] = f"""WITH {_upsert()}
SELECT old.status AS old_status, up.status AS new_status, count(*) AS rows FROM old JOIN up USING (job_id) GROUP BY ALL"""
    out["q34_quarantine"] = f"""WITH {EXTRACTED}
SELECT job_id, job_url, job_title, CASE WHEN {contract_ok} THEN years END AS min_years_of_experience,
  CASE WHEN {contract_ok} THEN '[' || array_to_string(list_transform(range(n_skills),
    lambda i: '"s' || CAST(i AS VARCHAR) || '"'), ', ') || ']' END AS ai_core_tech_stack,
  CASE WHEN {contract_ok} THEN english END AS english_requirement, CASE WHEN {contract_ok} THEN role END AS ai_job_role,
  CASE WHEN {contract_ok} THEN {_infer('level', 'years')} ELSE 'Error' END AS job_level, source,
  {AS_OF} AS processed_at, {AS_OF} AS last_seen_at, CASE WHEN {contract_ok} THEN 'Active' ELSE 'Error' END AS status
FROM extracted"""
    out["q34_contract_counts"] = f"""WITH {EXTRACTED}
SELECT CAST(count(*) FILTER ({contract_ok}) AS BIGINT) AS ok, count(*) AS total FROM extracted"""
    out["q35_pending_jobs"] = f"""WITH {JD} SELECT job_id, job_url, job_title, job_description FROM jd
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE CAST(labels.doc_id AS VARCHAR) = jd.job_id)
  AND job_description IS NOT NULL AND job_description NOT IN ('JD content not found', 'Connection error')"""

    out["q36_rule_extract"] = f"""WITH {DOCS}, {_rule_extract('docs', 'job_title', 'text')}
SELECT job_id, years AS min_years_of_experience, stack AS core_tech_stack, english AS english_requirement,
  role AS job_role, level AS job_level FROM ex"""
    out["q36_infer_level"] = f"""WITH {SILVER}
SELECT job_id, {_infer('job_level', 'min_years_of_experience')} AS job_level,
  {_infer('job_level', '(min_years_of_experience - 2)')} AS job_level_shifted,
  coalesce(job_level IN {_in(S.JOB_LEVELS)}, false) AS level_in_contract FROM silver"""
    out["q37_skill_dictionary"] = f"""WITH d AS (SELECT DISTINCT unnest({TOKENS.format(x='text')}) AS alias FROM benchmark),
-- the full Unicode mapping of sharp s is SS
dict AS (SELECT alias, upper(replace(alias, 'ß', 'ss')) AS canonical FROM d),
w AS (SELECT doc_id, unnest(ws) AS alias, unnest(range(len(ws))) AS pos
  FROM (SELECT doc_id, {TOKENS.format(x='text')} AS ws FROM documents)),
f AS (SELECT doc_id, canonical, min(pos) AS pos FROM w JOIN dict USING (alias) GROUP BY doc_id, canonical),
g AS (SELECT doc_id, string_agg(canonical, ', ' ORDER BY pos, canonical) AS skills, CAST(count(*) AS INTEGER) AS n FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(skills, '') AS skills, coalesce(n, 0) AS n_skills FROM documents LEFT JOIN g USING (doc_id)"""

    day = f"CAST({INDEX_DAY} AS DATE)"
    gone = f"status = 'Inactive' AND last_seen_at >= {day} - INTERVAL 2 DAY"
    out["q37_phrase_dictionary"] = f"""WITH RECURSIVE b AS MATERIALIZED (SELECT {TOKENS.format(x='text')} AS w FROM benchmark),
dict AS MATERIALIZED (SELECT DISTINCT n, array_to_string(w[i : i + n - 1], ' ') AS alias
  FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b, (SELECT unnest([2, 3]) AS n))),
w AS MATERIALIZED (SELECT doc_id, {TOKENS.format(x='text')} AS ws FROM documents),
hit AS MATERIALIZED (SELECT doc_id, pos, max(n) AS n FROM (
    SELECT doc_id, pos, n, array_to_string(ws[pos : pos + n - 1], ' ') AS alias
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS pos FROM w), (SELECT unnest([2, 3]) AS n)
    WHERE pos + n - 1 <= len(ws)) JOIN dict USING (n, alias) GROUP BY doc_id, pos),
-- the next match starts behind this one: within the next three places that have one
chain AS MATERIALIZED (SELECT doc_id, pos, n, row_number() OVER o AS nth,
  CASE WHEN lead(pos) OVER o >= pos + n THEN lead(pos) OVER o WHEN lead(pos, 2) OVER o >= pos + n THEN lead(pos, 2) OVER o
    ELSE lead(pos, 3) OVER o END AS follow FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
kept AS (
  SELECT doc_id, n, pos, follow FROM chain WHERE nth = 1
  UNION ALL
  SELECT c.doc_id, c.n, c.pos, c.follow FROM kept JOIN chain c ON kept.doc_id = c.doc_id AND kept.follow = c.pos),
f AS (SELECT doc_id, '#' || array_to_string(ws[pos : pos + n - 1], ' ') AS canonical, min(pos) AS pos
  FROM kept JOIN w USING (doc_id) GROUP BY ALL),
g AS (SELECT doc_id, string_agg(canonical, ', ' ORDER BY pos, canonical) AS skills, CAST(count(*) AS INTEGER) AS n FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(skills, '') AS skills, coalesce(n, 0) AS n_skills FROM documents LEFT JOIN g USING (doc_id)"""

    out["q40_index_full"] = f"WITH {SILVER} SELECT {_points()} FROM silver WHERE status = 'Active'"
    out["q40_index_incremental"] = f"""WITH {SILVER}
SELECT {_points()} FROM silver WHERE status = 'Active' AND CAST(processed_at AS DATE) = {day}"""
    out["q41_index_delete"] = f"WITH {SILVER} SELECT {_points()} FROM silver WHERE NOT ({gone})"
    out["q42_index_upsert"] = f"""WITH {SILVER}
SELECT {_points()} FROM silver WHERE processed_at < TIMESTAMP '{C.BATCH_START}'
UNION ALL
SELECT {_points("'Senior'")} FROM silver WHERE processed_at >= TIMESTAMP '{C.BATCH_START}'"""

    out["q43_dense_top30"] = """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (SELECT a.vec_id AS qid, b.vec_id AS id, round(list_cosine_similarity(a.e, b.e), 6) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND b.label <= a.label + 1)
SELECT qid, id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank
FROM s QUALIFY rank <= 30"""
    out["q44_sparse_top30"] = f"WITH {DOCS}, {CANDIDATES}, {SPARSE} SELECT * FROM sparse"
    out["q45_rrf"] = f"WITH {SEARCH} SELECT * FROM fused"
    out["q46_rerank_top10"] = f"WITH {SEARCH}, {RANKED} SELECT * FROM ranked"
    out["q47_match_context"] = f"""WITH {SEARCH}, {RANKED},
c AS (SELECT qid, count(*) AS n, string_agg('Job ' || rank || ': ' || {_content()}, chr(10) || chr(10) ORDER BY rank) AS ctx
  FROM ranked JOIN docs ON docs.doc_id = ranked.id GROUP BY qid)
SELECT candidates.qid, coalesce(n, 0) AS n_matches, coalesce(ctx, '') AS context
FROM candidates LEFT JOIN c ON c.qid = candidates.qid"""
    out["q47_match_cards"] = f"""WITH {SEARCH}, {RANKED}
SELECT qid, rank, job_title AS title, job_url AS url, source,
  {"replace(" + _content() + ", 'Source: ' || source || ' | Title: ' || job_title || ' | ', '')"} AS caption
FROM ranked JOIN docs ON docs.doc_id = ranked.id"""
    out["q47_candidate_profiles"] = f"""WITH cv AS (SELECT conv_id, turn, conv_id || '/' || turn AS job_id, '' AS title, text
  FROM conversations), {_rule_extract('cv', 'title', 'text')}
SELECT conv_id, years AS yoe, CASE WHEN skills IS NOT NULL THEN role || ' ' || array_to_string(skills, ' ') ELSE text END AS query,
  coalesce(array_to_string(skills, ', '), '') AS skills FROM ex"""
    out["q48_skill_gap"] = f"""WITH {SILVER}, p AS (
  SELECT o_custkey AS qid, job_id,
    list_transform(list_filter(from_json(ai_core_tech_stack, '["VARCHAR"]'), lambda x: x IS NOT NULL AND x <> ''),
      lambda x: lower(x)) AS need,
    ['s' || CAST(c_nationkey % 20 AS VARCHAR), 't1', 't4'] AS have
  FROM silver JOIN orders ON CAST(o_orderkey AS VARCHAR) = job_id JOIN customer ON c_custkey = o_custkey)
SELECT qid, job_id, array_to_string(list_filter(need, lambda x: list_contains(have, x)), ',') AS matched,
  array_to_string(list_filter(need, lambda x: NOT list_contains(have, x)), ',') AS missing FROM p"""

    out["q50_kpis"] = _kpis("")
    out["q50_kpis_filtered"] = _kpis("AND source = 'TOPCV' AND job_level = 'Senior'")
    out["q51_levels"] = f"""WITH {SILVER}
SELECT job_level, count(*) AS n_jobs FROM silver WHERE status = 'Active' AND job_level <> 'Error'
GROUP BY ALL ORDER BY n_jobs DESC, job_level"""
    out["q52_yoe_histogram"] = _histogram("""SELECT min_years_of_experience AS yoe FROM silver
  WHERE status = 'Active' AND min_years_of_experience IS NOT NULL""")
    out["q52_wide_histogram"] = _histogram("SELECT p_size AS yoe FROM part")
    out["q53_source_options"] = f"WITH {SILVER} SELECT DISTINCT source FROM silver WHERE source <> '' ORDER BY source"
    order = "[" + ", ".join(_q(x) for x in S.LEVEL_ORDER) + "]"
    out["q53_level_options"] = f"""WITH {SILVER}
SELECT DISTINCT job_level, CAST(coalesce(list_position({order}, job_level), {len(S.LEVEL_ORDER) + 1}) AS INTEGER) AS position
FROM silver WHERE job_level <> 'Error' AND job_level <> '' ORDER BY position, job_level"""
    out["q54_kpi_cube"] = f"""WITH {SILVER}, k AS (
  SELECT source, job_level, CAST(grouping(source) AS INTEGER) AS source_all,
    CAST(grouping(job_level) AS INTEGER) AS level_all, {KPI}
  FROM silver WHERE status = 'Active' GROUP BY CUBE (source, job_level))
SELECT source, job_level, source_all, level_all, jobs, avg_yoe, english_jobs, {PCT} FROM k"""
    out["q57_top10_skills"] = _top_skills("")
    out["q57_top10_skills_filtered"] = _top_skills("AND source = 'ITVIEC' AND job_level = 'Middle'")
    out["q58_english_levels"] = f"""WITH {SILVER}
SELECT english_requirement, count(*) AS n_jobs FROM silver WHERE status = 'Active' AND english_requirement IS NOT NULL
GROUP BY ALL ORDER BY n_jobs DESC, english_requirement"""

    out["q60_profile"] = _profile()
    out["q60_duplicate_keys"] = """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1"""
    out["q61_batch_silver"] = _batch_silver()
    out["q60_table_peek"] = f"WITH {RAW} SELECT job_url, job_title FROM raw ORDER BY job_url, job_title LIMIT 10"
    out["q60_index_peek"] = f"WITH {SILVER} SELECT {_points()} FROM silver ORDER BY point_id LIMIT 1"

    kinds = """CASE WHEN text IN ('The', 'and', 'in', 'to') THEN 'broken' WHEN regexp_full_match(text, '[a-m][^<]*') THEN 'bare' ELSE 'full' END"""
    links = f"""links AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1)) AS link,
    unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)) AS text,
    unnest(range(len(regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1)))) AS card_idx FROM pages),
cards AS (SELECT page_id, CAST(card_idx AS INTEGER) AS card_idx, link, text, {kinds} AS kind FROM links)"""
    out["q17_site_a_cards"] = f"""WITH {links}, c AS (SELECT *, split_part(CASE WHEN link = '' OR starts_with(link, 'http') THEN link
  ELSE '{S.SITE_A_HOST}' || link END, '?', 1) AS core FROM cards)
SELECT page_id, card_idx, CASE kind WHEN 'broken' THEN 'error' ELSE core END AS job_id,
  CASE kind WHEN 'broken' THEN 'error' ELSE core END AS job_url,
  CASE kind WHEN 'broken' THEN '{S.TITLE_ERROR}' ELSE text END AS job_title,
  CASE kind WHEN 'full' THEN text || ' Co' ELSE '{S.UNKNOWN_COMPANY}' END AS company_name,
  CASE kind WHEN 'full' THEN 'City ' || page_id ELSE '{S.UNKNOWN_LOCATION}' END AS location,
  CASE kind WHEN 'full' THEN '{S.SALARY_SIGN_IN}' ELSE '{S.SALARY_UPDATING}' END AS salary_raw,
  CASE kind WHEN 'full' THEN text || ', SQL' ELSE '' END AS tech_stack FROM c"""
    out["q18_site_b_cards"] = f"""WITH {links}, d AS (SELECT * REPLACE (CASE kind WHEN 'full' THEN link || '/' || page_id || '.html?ta=1' ELSE link END AS link) FROM cards),
c AS (SELECT *, split_part(CASE WHEN starts_with(link, 'http') THEN link ELSE '{S.SITE_B_HOST}' || link END, '?', 1) AS core FROM d)
SELECT page_id, card_idx, CASE kind WHEN 'broken' THEN 'error' WHEN 'full' THEN CAST(page_id AS VARCHAR) ELSE core END AS job_id,
  CASE kind WHEN 'broken' THEN 'error' ELSE core END AS job_url,
  CASE kind WHEN 'broken' THEN '{S.TITLE_ERROR}' ELSE text END AS job_title,
  CASE kind WHEN 'full' THEN text || ' Co' ELSE '{S.UNKNOWN_COMPANY}' END AS company_name,
  CASE kind WHEN 'full' THEN 'City ' || page_id ELSE '{S.UNKNOWN_LOCATION}' END AS location,
  CASE kind WHEN 'full' THEN page_id || ' - 99' ELSE '{S.SALARY_NEGOTIABLE}' END AS salary_raw,
  '{S.TECH_STACK_LATER}' AS tech_stack FROM c WHERE page_id % 9 <> 4"""
    body = LINES.format(x=ARTICLE)
    out["q19_site_details"] = f"""SELECT 'ITViec' AS source, CAST(page_id AS VARCHAR) AS job_id, CASE WHEN page_id % 5 = 0 THEN 'Error 404'
  WHEN page_id % 6 = 1 THEN 'JD content not found' ELSE {body} END AS job_description FROM pages
UNION ALL
SELECT 'TopCV', CAST(page_id AS VARCHAR), CASE WHEN page_id % 4 = 0 OR page_id % 7 = 0 THEN 'Connection error'
  WHEN page_id % 6 = 1 THEN 'JD content not found' ELSE {body} END FROM pages"""
    out["q42_index_sync"] = f"""WITH {SILVER}, loaded AS (SELECT {_points()}, processed_at FROM silver WHERE status = 'Active' AND processed_at < {day}),
second AS (SELECT * REPLACE (
    CASE WHEN CAST(job_id AS BIGINT) % 5 = 0 AND processed_at < {day} THEN {INDEX_DAY} ELSE last_seen_at END AS last_seen_at,
    CASE WHEN CAST(job_id AS BIGINT) % 5 = 0 AND processed_at < {day} THEN 'Inactive' ELSE status END AS status)
  FROM silver WHERE processed_at < {day} + INTERVAL 1 DAY)
SELECT * EXCLUDE (processed_at) FROM loaded WHERE meta_job_id NOT IN (SELECT job_id FROM second WHERE {gone})
  AND meta_job_id NOT IN (SELECT job_id FROM second WHERE status = 'Active' AND CAST(processed_at AS DATE) = {day})
UNION ALL
SELECT {_points()} FROM second WHERE status = 'Active' AND CAST(processed_at AS DATE) = {day}"""
    out["q46_rerank_by_title"] = out["q46_rerank_top10"].replace("PARTITION BY qid, text", "PARTITION BY qid, title, source")
    out["q46_rerank_model"] = out["q46_rerank_top10"]

    # other ways to the rows of a query above
    for name in ("q03_union_sources_advanced", "q13_bronze_insert_buckets", "q30_touch_seen_partial", "q31_mark_inactive_partial",
                 "q32_expire_stale_partial", "q33_silver_upsert_partial", "q43_dense_top30_pruned", "q44_sparse_top30_blocks",
                 "q61_batch_silver_partial", "q21_role_summary_pinned"):
        out[name] = out[name.rsplit("_", 1)[0]]
    later = f"""{_upsert()}, moved AS (SELECT * REPLACE (CASE WHEN status = 'Active' AND last_seen_at < {_ts(C.LATER)} - INTERVAL 3 DAY
  THEN 'Expired' ELSE status END AS status) FROM up)"""
    for name in ("q20_skill_counts", "q21_role_summary", "q22_skills_by_level"):
        out[f"{name}_by_feed"] = out[name].replace(f"WITH {SILVER}", f"WITH {later}").replace("FROM silver WHERE ai", "FROM moved WHERE ai")
    out["q20_skill_counts_sketched"] = f"SELECT *, true AS within FROM ({out['q20_skill_counts']})"
    return out
