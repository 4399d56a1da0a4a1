"""The star-schema tables seen as job-posting tables.

Every mapping keeps all rows and the whole texts of its table. The SQL is plain enough for any
engine; ``{orders}`` and the like stand for the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.sources.tables import scan, spread

# one posting per order
SILVER_SQL = """
SELECT CAST(o_orderkey AS STRING) AS job_id,
  concat('https://jobs.example/', CAST(o_orderkey AS STRING)) AS job_url,
  concat('Job ', o_orderpriority) AS job_title,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 8 AS INT) END AS min_years_of_experience,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '[]'
    ELSE concat('["s', CAST(o_custkey % 20 AS STRING), '", "t', CAST(o_custkey % 6 AS STRING), '", "", null]')
    END AS ai_core_tech_stack,
  CASE WHEN o_custkey % 31 = 0 THEN NULL WHEN o_custkey % 4 = 0 THEN 'Not mentioned'
    WHEN o_custkey % 4 = 1 THEN 'Read/Write basic documentations'
    WHEN o_custkey % 4 = 2 THEN 'Communicate with clients'
    ELSE 'Required certificate (IELTS/TOEIC)' END AS english_requirement,
  CASE WHEN o_custkey % 17 = 0 THEN 'Unknown' WHEN o_custkey % 19 = 0 THEN 'Error'
    WHEN o_custkey % 23 = 0 THEN NULL ELSE concat('Role', CAST(o_custkey % 14 AS STRING)) END AS ai_job_role,
  CASE WHEN o_custkey % 29 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'Senior'
    WHEN o_orderpriority = '2-HIGH' THEN 'Middle' WHEN o_orderpriority = '3-MEDIUM' THEN 'Intern'
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Unknown' ELSE 'Error' END AS job_level,
  CASE WHEN o_orderkey % 3 = 0 THEN 'TOPCV' ELSE 'ITVIEC' END AS source,
  o_orderdate AS processed_at,
  o_orderdate AS last_seen_at,
  CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Inactive' ELSE 'Expired' END AS status
FROM {orders}
"""

# one observation of a posting per order line; the line status tells the site it was seen on
RAW_SQL = """
SELECT CAST(l_orderkey AS STRING) AS job_id,
  concat('https://jobs.example/', CAST(l_orderkey AS STRING)) AS job_url,
  concat('Part ', CAST(l_partkey AS STRING)) AS job_title,
  concat('Company ', CAST(l_suppkey AS STRING)) AS company_name,
  CASE l_returnflag WHEN 'N' THEN 'Ha Noi' WHEN 'R' THEN 'Da Nang' ELSE 'Unknown location' END AS location,
  CASE WHEN l_discount > 0.05 THEN 'Sign in to view salary' ELSE 'Updating...' END AS salary_raw,
  concat('s', CAST(l_partkey % 20 AS STRING), ', AWS,, ,Unknown,t', CAST(l_suppkey % 6 AS STRING)) AS tech_stack,
  CASE l_linestatus WHEN 'O' THEN 'ITViec' ELSE 'TopCV' END AS source,
  l_shipdate AS crawl_timestamp,
  '' AS experience_level,
  CASE l_linenumber WHEN 1 THEN 'data-engineer' WHEN 2 THEN 'data-analyst' WHEN 3 THEN 'data-scientist'
    WHEN 4 THEN 'analytics-engineer' WHEN 5 THEN 'machine-learning' WHEN 6 THEN 'ai-engineer'
    ELSE 'business-intelligence' END AS job_category,
  CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN 'JD content not found'
    ELSE concat('Line ', CAST(l_linenumber AS STRING)) END AS job_description,
  l_linenumber AS keyword_idx, l_partkey AS page, l_suppkey AS card
FROM {lineitem}
"""

# one posting with a description per document; some sources stand for fetch results without a text
JD_SQL = """
SELECT CAST(doc_id AS STRING) AS job_id,
  concat('https://jobs.example/doc/', CAST(doc_id AS STRING)) AS job_url,
  split_part(text, chr(10), 1) AS job_title,
  CASE source WHEN 'src0' THEN 'JD content not found' WHEN 'src1' THEN 'Connection error' WHEN 'src2' THEN ''
    WHEN 'src3' THEN NULL WHEN 'src4' THEN 'Error 403' ELSE text END AS job_description,
  CASE lang WHEN 'en' THEN 'ITViec' ELSE 'TopCV' END AS source
FROM {documents}
"""

# the record an extractor returned for each order, contract violations included
EXTRACTED_SQL = """
SELECT CAST(o_orderkey AS STRING) AS job_id,
  concat('https://jobs.example/', CAST(o_orderkey AS STRING)) AS job_url,
  concat('Job ', o_orderpriority) AS job_title,
  CASE WHEN o_orderkey % 3 = 0 THEN 'TOPCV' ELSE 'ITVIEC' END AS source,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_orderkey % 8 AS INT) END AS years,
  CAST(o_custkey % 8 AS INT) AS n_skills,
  CASE WHEN o_custkey % 41 = 0 THEN 'Fluent' WHEN o_custkey % 2 = 0 THEN 'Not mentioned'
    ELSE 'Communicate with clients' END AS english,
  CASE WHEN o_custkey % 43 = 0 THEN 'Wizard' WHEN o_custkey % 47 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'Backend'
    ELSE 'Data Engineer' END AS role,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'Unknown' WHEN o_orderpriority = '1-URGENT' THEN 'Senior'
    ELSE 'Middle' END AS level
FROM {orders}
"""

# searchable postings (documents) and candidates (benchmark items)
DOC_SILVER_SQL = """
SELECT CAST(doc_id AS STRING) AS job_id,
  concat('https://jobs.example/doc/', CAST(doc_id AS STRING)) AS job_url,
  split_part(text, chr(10), 1) AS job_title,
  CAST(substr(source, 4) AS INT) AS min_years_of_experience,
  concat('["', lang, '"]') AS ai_core_tech_stack,
  CASE lang WHEN 'en' THEN 'Communicate with clients' ELSE 'Not mentioned' END AS english_requirement,
  'Backend' AS ai_job_role, 'Senior' AS job_level, source, doc_id, text
FROM {documents}
"""
CANDIDATE_SQL = """
SELECT item_id AS qid, CAST(length(text) % 20 AS INT) - 2 AS yoe, text FROM {benchmark}
"""

# profile answers: one per conversation turn, some without a number
ANSWER_SQL = """
SELECT conv_id, turn, text,
  CASE role WHEN 'assistant' THEN concat('YOE: none', chr(10), 'QUERY: ', text)
    ELSE concat('QUERY: first try', chr(10), 'YOE: ', CAST(turn AS STRING), ' years', chr(10), 'QUERY:  ', text)
    END AS answer
FROM {conversations}
"""


class Testbed:
    """The mappings over one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def table(self, name: str) -> DataFrame:
        return scan(self.spark, self.root, name)

    def _view(self, sql: str, name: str, split: bool = False) -> DataFrame:
        df = self.table(name)
        return self.spark.sql(sql, **{name: spread(df) if split else df})

    def silver(self) -> DataFrame:
        return self._view(SILVER_SQL, "orders")

    def raw(self) -> DataFrame:
        return self._view(RAW_SQL, "lineitem")

    def jd(self) -> DataFrame:
        return self._view(JD_SQL, "documents")

    def extracted(self) -> DataFrame:
        return self._view(EXTRACTED_SQL, "orders")

    def doc_silver(self, split: bool = False) -> DataFrame:
        return self._view(DOC_SILVER_SQL, "documents", split)

    def candidates(self) -> DataFrame:
        return self._view(CANDIDATE_SQL, "benchmark")

    def answers(self) -> DataFrame:
        return self._view(ANSWER_SQL, "conversations")
