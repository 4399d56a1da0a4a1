"""Line dedup by distinct-site spread: lines that stand on many sites go, but for their first place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import documents, stored

#: Sites from which on a line is boilerplate, and words that a line has at least to count.
MIN_SITES, MIN_WORDS = 10, 3
#: Rule of the pipeline: the sites from which on a line is boilerplate, by its least length in words.
SITES_BY_WORDS = ((50, 2), (20, 3), (10, 5), (0, MIN_SITES))
#: Bytes that count as one word, so that scripts without blanks have a length too.
WORD_BYTES = 6
#: log2 of the registers of a sketch; its relative error is about 1.04 / sqrt(2^LG_K).
LG_K = 12
#: An estimate within this share of the threshold (and within 2) is counted exactly: over three standard errors.
NEAR = 0.06

LINES = "split(text, '\\n')"
BLANK = " \t\x0b\x0c\r"


def _needed(line: str, steps: tuple[tuple[int, int], ...]) -> Column:
    """The sites from which on ``line`` is boilerplate; ``steps``: (words, sites), the longest first."""
    if len(steps) == 1:
        return F.lit(steps[0][1])
    words = F.greatest(F.size(F.split(line, r"\s+")), F.floor(F.octet_length(line) / WORD_BYTES))
    out = F.lit(steps[-1][1])
    for least, sites in reversed(steps[:-1]):
        out = F.when(words >= least, sites).otherwise(out)
    return out


def _lines(docs: DataFrame, min_words: int, steps: tuple[tuple[int, int], ...]) -> DataFrame:
    """One row for each line that counts: d, x (the document), site, pos, h, n for the trimmed line, need."""
    trimmed = F.btrim(F.col("line"), F.lit(BLANK))
    rows = docs.select("d", "x", "site", F.posexplode(F.expr(LINES)).alias("pos", "line")).withColumn("line", trimmed)
    enough = F.regexp_like("line", F.lit(r"^\S+(\s+\S+){%d}" % (min_words - 1)) if min_words > 0 else F.lit(""))
    return rows.where(F.length("line") > 0).where(enough).select(
        "d", "x", "site", "pos", F.xxhash64("line").alias("h"), F.length("line").alias("n"), _needed("line", steps).alias("need")
    )


def boilerplate(lines: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(h, n, first): the lines on at least ``need`` sites, and the place of their first occurrence.

    A line of one site only is left out first, by the least and largest hash of its sites. The other lines
    gather a HyperLogLog sketch of their sites; sketches merge in the map tasks, so a line that is
    everywhere moves one sketch a task. Lines whose estimate is near the threshold get an exact distinct
    count, so the outcome does not depend on the sketches.
    """
    site = F.xxhash64("site")
    wide = (
        lines.groupBy("h", "n")
        .agg(F.min(site).alias("a"), F.max(site).alias("b"), F.count("*").alias("c"), F.first("need").alias("need"))
        .where("a <> b")
        .where("c >= need")
        .select("h", "n", "need")
    )
    spread = (
        lines.drop("need").join(stored(wide, "wide"), ["h", "n"])
        .groupBy("h", "n")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"),
            F.min(F.struct("d", "x", "pos")).alias("first"),
            F.first("need").alias("need"),
        )
    )
    band = F.greatest(F.lit(2.0), NEAR * F.col("need"))
    spread = stored(spread.where(F.col("sites") >= F.col("need") - band), "spread")
    sure = spread.where(F.col("sites") > F.col("need") + band).select("h", "n", "first")
    near = spread.where(F.col("sites") <= F.col("need") + band)
    exact = (
        lines.drop("need").join(near.select("h", "n", "first", "need"), ["h", "n"])
        .groupBy("h", "n", "site")
        .agg(F.first("first").alias("first"), F.first("need").alias("need"))
        .groupBy("h", "n")
        .agg(F.count("*").alias("sites"), F.first("first").alias("first"), F.first("need").alias("need"))
        .where("sites >= need")
        .select("h", "n", "first")
    )
    return stored(sure.union(exact), "boilerplate")


def drop_boilerplate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    steps: tuple[tuple[int, int], ...] | None = None,
) -> DataFrame:
    """(row, kept, n_lines, n_removed): each row of ``docs`` and its text without boilerplate lines.

    Lines are cut at line feeds and compared without white space around them; lines of fewer than
    ``min_words`` words always stay. A line that is on ``min_sites`` sites or more stays in one document
    only, where it comes first by (doc_id, hash of the text, place); so nothing is lost from the corpus.
    ``steps`` takes the place of ``min_sites``: pairs of words and sites, the longest first.
    Repeats of that very row keep it too. Other lines, and their order, stay as they are.

    Null text: kept as null, no lines. Empty text: one empty line. A null site is a site of its own; a null
    doc_id comes first. Rows of one doc_id with different texts are different documents. Empty tables give
    no rows. Extra columns stay in ``row``.
    """
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(doc_id).alias("d"),
        F.xxhash64(text).alias("x"),
        F.coalesce(F.concat(F.lit("s"), F.col(site)), F.lit("n")).alias("site"),
        F.col(text).alias("text"),
    )
    lines = _lines(rows, min_words, steps or ((0, min_sites),))
    common = boilerplate(lines)
    here = F.struct("d", "x", "pos")
    gone = (
        lines.join(common, ["h", "n"])
        .where(~here.eqNullSafe(F.col("first")))
        .groupBy("d", "x")
        .agg(F.collect_set("pos").alias("gone"))
        .select(F.col("d").alias("d2"), F.col("x").alias("x2"), "gone")
    )
    joined = rows.join(gone, F.col("d").eqNullSafe(F.col("d2")) & (F.col("x") == F.col("x2")), "left")
    n_lines = F.expr(f"CASE WHEN text IS NULL THEN 0 ELSE size({LINES}) END")
    stay = f"array_except(sequence(0, size({LINES}) - 1), gone)"
    kept = F.expr(f"CASE WHEN gone IS NULL THEN text ELSE array_join(transform({stay}, i -> {LINES}[i]), '\\n') END")
    removed = F.coalesce(F.size("gone"), F.lit(0))
    return joined.select("row", kept.alias("kept"), n_lines.alias("n_lines"), F.greatest(removed, F.lit(0)).alias("n_removed"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_boilerplate(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return cleaned.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


#: The same in another engine, with exact counts throughout.
OP9_SQL = f"""
WITH l AS (
  SELECT doc_id, source, text, pos, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line, line AS raw
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)
), c AS (
  SELECT line, min({{'d': doc_id, 'p': pos}}) AS first FROM l
  WHERE regexp_matches(line, '^\\S+(\\s+\\S+){{{MIN_WORDS - 1}}}')
  GROUP BY line HAVING count(DISTINCT coalesce('s' || source, 'n')) >= {MIN_SITES}
), k AS (
  SELECT l.doc_id, count(*) AS n_lines,
         count(*) FILTER (c.line IS NOT NULL AND c.first <> {{'d': l.doc_id, 'p': l.pos}}) AS n_removed,
         coalesce(string_agg(l.raw, chr(10) ORDER BY l.pos)
           FILTER (c.line IS NULL OR c.first = {{'d': l.doc_id, 'p': l.pos}}), '') AS kept
  FROM l LEFT JOIN c ON l.line = c.line GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k USING (doc_id)
"""


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: boilerplate lines go, n_chars follows; a document of nothing else goes with them.

    The longer a line, the fewer sites make it boilerplate: two are enough from 50 words on. Every line that
    is not blank counts, in any script.
    """
    cleaned = drop_boilerplate(docs, min_words=0, steps=SITES_BY_WORDS).where("n_removed = 0 OR n_removed < n_lines")
    changed = F.col("n_removed") > 0
    out = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.col("kept")
        elif c == "n_chars":
            value = F.when(changed, F.char_length("kept").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return cleaned.select(*out)
