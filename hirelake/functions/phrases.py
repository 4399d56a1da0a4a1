"""Phrases of a dictionary in token lists: leftmost, then longest, no token in two of them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: A dictionary of up to so many rows and bytes goes to the tasks as a token trie; a larger one is joined.
TRIE_ROWS, TRIE_BYTES = 500_000, 32 << 20
HITS = "array<struct<pos:int,n_tokens:int,phrase:string>>"


def trie(phrases: list[str]) -> dict:
    """Nested tokens; None ends a phrase."""
    root: dict = {}
    for phrase in phrases:
        node = root
        for token in phrase.split(" "):
            node = node.setdefault(token, {})
        node[None] = phrase
    return root


def longest_matches(tokens: list[str], root: dict) -> list[tuple[int, int, str]]:
    """(place, tokens, phrase) of the matches, left to right."""
    out, at, n = [], 0, len(tokens)
    while at < n:
        node, found, i = root.get(tokens[at]), None, at + 1
        while node is not None:
            if None in node:
                found = (at, i - at, node[None])
            node = node.get(tokens[i]) if i < n else None
            i += 1
        if found:
            out.append(found)
        at += found[1] if found else 1
    return out


def _by_trie(tokens: Column, phrases: DataFrame) -> Column:
    root = phrases.sparkSession.sparkContext.broadcast(trie([r[0] for r in phrases.collect()]))  # measured before

    @pandas_udf(HITS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [None if t is None else [dict(zip(("pos", "n_tokens", "phrase"), m, strict=True)) for m in longest_matches(list(t), root.value)] for t in batch],
                dtype=object,
            )

    return find(tokens)


def _greedy(hits: Column) -> Column:
    """Of (pos, n_tokens, phrase), by pos and the longest first, those that start behind the last one kept."""
    empty = F.array().cast(HITS)
    start = F.struct(F.lit(0).alias("end"), empty.alias("kept"))

    def step(acc: Column, hit: Column) -> Column:
        taken = F.struct((hit["pos"] + hit["n_tokens"]).alias("end"), F.concat(acc["kept"], F.array(hit)).alias("kept"))
        return F.when(hit["pos"] >= acc["end"], taken).otherwise(acc)

    return F.aggregate(hits, start, step, lambda acc: acc["kept"])


def _by_join(docs: DataFrame, key: str, tokens: Column, phrases: DataFrame) -> DataFrame:
    lengths = [r[0] for r in phrases.select(F.size(F.split("phrase", " "))).distinct().collect()]
    words = docs.select(key, tokens.alias("__w")).where(F.col("__w").isNotNull())
    places = words.select(key, "__w", F.posexplode("__w").alias("pos", "__t")).drop("__t")
    sizes = F.explode(F.array(*[F.lit(n) for n in sorted(lengths)])).alias("n_tokens")
    windows = places.select(key, "__w", "pos", sizes).where(F.col("pos") + F.col("n_tokens") <= F.size("__w"))
    windows = windows.select(key, "pos", "n_tokens", F.array_join(F.slice("__w", F.col("pos") + 1, F.col("n_tokens")), " ").alias("phrase"))
    met = windows.join(phrases, "phrase")
    order = F.struct("pos", (-F.col("n_tokens")).alias("short"), "n_tokens", "phrase")
    sorted_hits = met.groupBy(key).agg(F.array_sort(F.collect_list(order)).alias("l"))
    plain = F.transform("l", lambda h: F.struct(h["pos"].alias("pos"), h["n_tokens"].alias("n_tokens"), h["phrase"].alias("phrase")))
    return sorted_hits.select(key, _greedy(plain).alias("hits"))


def find(docs: DataFrame, key: str, tokens: Column, phrases: DataFrame, by_join: bool | None = None) -> DataFrame:
    """(key, pos, n_tokens, phrase): matches of ``phrases`` (phrase: tokens joined by one blank) in each document.

    Reading goes from the left; at each token the longest phrase that starts there counts, and reading goes on
    behind it. A dictionary of measured size is sent to the tasks as a token trie and each document read once;
    a larger one joins the documents' windows of its phrase lengths. Both give the same rows.
    """
    known = phrases.select("phrase").where("phrase IS NOT NULL AND phrase <> ''").distinct()
    if by_join is None:
        count, size = known.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0))).first()
        by_join = count > TRIE_ROWS or size > TRIE_BYTES
    found = _by_join(docs, key, tokens, known) if by_join else docs.select(key, _by_trie(tokens, known).alias("hits"))
    return found.select(key, F.inline("hits"))
