"""A corpus, from documents to packed token sequences.

Toxic documents go, boilerplate lines go, one document of each near-duplicate class stays, sources are mixed
to their target weights (a document taken twice is there twice), and what is left is packed. Each stage works
on all that the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.llm.common import documents, stored
from hirelake.llm.jaccard import keep_one
from hirelake.llm.lines import drop_lines
from hirelake.llm.mixing import take
from hirelake.llm.packing import pack_stage
from hirelake.llm.toxicity import reject_toxic

STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", keep_one),
    ("mixing", take),
    ("packing", pack_stage),
]

#: A trained model decides in the first stage, so SQL cannot give run()'s rows; tests/llm does by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
