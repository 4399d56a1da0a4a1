"""Batch retrieval: many queries against the whole index, exact top-k.

A query frame has ``qid``, optional ``yoe``, and ``dense`` and / or ``terms`` (array<string>).
A corpus frame has ``id``, optional ``yoe``, and ``dense`` and / or ``terms`` with ``weights``
(parallel arrays). ``qid`` and ``id`` are of one type.

Scoring runs block against block in numpy and keeps k rows per query and block, so a (query, point)
pair is never a Spark row. Queries travel to the corpus partitions as a broadcast of bounded size, more of
them in several passes; the corpus is never shuffled. Every pair that the payload filter allows is seen.
`dense_index` and `postings` give the same rows from written indexes and read only what can matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hirelake.functions import slices, text
from hirelake.operators.index import header
from hirelake.operators.staging import top_per_key, union_sources
from hirelake.sources import scratch

# Queries sent to the tasks at a time; a larger set takes several passes over the corpus.
MAX_BROADCAST_QUERIES = 20_000
MAX_BROADCAST_BYTES = 64 << 20
# A narrow table of hits, at most this many rows, may be broadcast to fetch texts by id.
MAX_BROADCAST_ROWS = 600_000
# Inside a task: corpus rows scored at once, and the most cells a score matrix may have.
CHUNK = 1_024
CELLS = 4_000_000

DIGITS = 6
# Room for rounding: a pair whose score may round up to the k-th is looked at.
SLACK = 1e-6


@dataclass
class Queries:
    """A query frame whose size has been measured once."""

    df: DataFrame
    count: int
    bytes: int

    @property
    def small(self) -> bool:
        return self.count <= MAX_BROADCAST_QUERIES and self.bytes <= MAX_BROADCAST_BYTES

    def hint(self, df: DataFrame, depth: int = 1) -> DataFrame:
        """Mark ``df`` for broadcast if ``depth`` rows per query is a small table; else leave it alone."""
        return F.broadcast(df) if self.small and self.count * depth <= MAX_BROADCAST_ROWS else df


def measured(df: DataFrame) -> Queries:
    """Count a query frame and add up its payload, in one job."""
    size = F.lit(16)
    if "dense" in df.columns:
        size = size + 8 * F.coalesce(F.array_size("dense"), F.lit(0))
    if "terms" in df.columns:
        terms = F.aggregate("terms", F.lit(0), lambda a, t: a + F.octet_length(t) + F.lit(48))
        size = size + F.coalesce(terms, F.lit(0))
    if "text" in df.columns:
        size = size + F.coalesce(F.octet_length("text"), F.lit(0))
    n, b = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return Queries(df, n, b)


# --- scoring inside a task ------------------------------------------------------


class _QueryBlock:
    """Queries of one task, prepared for scoring.

    Query terms are split in two: those of many queries score by one matrix product, the others by
    adding up their (document, query) cells, a bounded number of cells at a time.
    """

    def __init__(self, rows: pd.DataFrame, kinds: tuple[str, ...]):
        self.qids = rows["qid"].tolist()
        self.places: dict[object, list[int]] = {}
        for i, qid in enumerate(self.qids):
            self.places.setdefault(qid, []).append(i)
        self.max_yoe = rows["max_yoe"].to_numpy(dtype=float) if "max_yoe" in rows else None
        self.chunk = max(16, min(CHUNK, CELLS // max(1, len(rows))))
        if "dense" in kinds:
            self.dense = _unit(rows["dense"])
        if "sparse" in kinds:
            self._prepare_terms(rows["terms"])

    def _prepare_terms(self, lists: pd.Series) -> None:
        n = len(lists)
        asked: dict[str, list[int]] = {}
        for q, terms in enumerate(lists):
            for t in set(terms):
                asked.setdefault(t, []).append(q)
        common = [t for t, qs in asked.items() if len(qs) > 8 and 16 * len(qs) >= n]
        rare = [t for t in asked if t not in set(common)]
        self.code = {t: i for i, t in enumerate(common + rare)}
        self.common = np.zeros((len(common), n))
        for i, t in enumerate(common):
            self.common[i, asked[t]] = 1.0
        self.size = np.array([len(asked[t]) for t in rare], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.queries = np.array([q for t in rare for q in asked[t]], dtype=np.int64)

    def scores(self, kind: str, part: pd.DataFrame) -> np.ndarray:
        """Corpus rows x queries."""
        if kind == "dense":
            return _unit(part["dense"]) @ self.dense.T
        n, nq, n_common = len(part), len(self.qids), len(self.common)
        words = list(chain.from_iterable(part["terms"]))
        code = np.fromiter(map(self.code.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        known = code >= 0
        code = code[known]
        row = np.repeat(np.arange(n), part["terms"].map(len))[known]
        weight = np.concatenate([np.empty(0), *part["weights"]])[known]

        often = code < n_common
        doc = np.zeros((n, n_common))
        doc[row[often], code[often]] = weight[often]
        out = doc @ self.common

        code, row, weight = code[~often] - n_common, row[~often], weight[~often]
        size = self.size[code]
        ends = np.cumsum(size)
        first = 0
        while first < len(code):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + CELLS, side="right")))
            some = slice(first, last)
            entry = np.repeat(np.arange(first, last), size[some])
            place = np.arange(len(entry)) - (ends[entry] - size[entry] - done)
            cell = row[entry] * nq + self.queries[self.start[code[entry]] + place]
            out += np.bincount(cell, weights=weight[entry], minlength=n * nq).reshape(n, nq)
            first = last
        return out


def _unit(vectors: pd.Series) -> np.ndarray:
    m = np.asarray(vectors.tolist(), dtype=np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


class _Best:
    """Running best k of one task, per query: rounded score descending, then id.

    Pairs that may still matter wait until there are as many as the best hold, and then are ranked all at once.
    """

    def __init__(self, k: int, n_queries: int, positive: bool = False):
        self.k, self.n, self.positive = k, n_queries, positive
        self.least = np.full(n_queries, -np.inf)  # score of the k-th, once there are k
        self.last: np.ndarray | None = None  # its id
        self.kept: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # query, score, id
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray | None = None, asked: np.ndarray | None = None) -> None:
        """``scores`` is corpus rows x queries, or x those ``asked``; pairs not ``allowed`` do not count."""
        least = self.least if asked is None else self.least[asked]
        hit = scores >= least - SLACK
        if allowed is not None:
            hit &= allowed
        if len(ids) > self.k and np.count_nonzero(hit) > 4 * self.k * len(least):
            best = np.where(hit, scores, -np.inf)
            hit &= scores >= np.partition(best, len(ids) - self.k, axis=0)[len(ids) - self.k] - SLACK
        row, column = np.nonzero(hit)
        score = np.round(scores[row, column], DIGITS)
        query = column if asked is None else asked[column]
        id_ = ids[row]
        keep = score >= self.least[query]
        if self.positive:
            keep &= score > 0
        if self.last is not None:  # copies of one text tie by the thousand: only smaller ids still matter
            full = np.isfinite(self.least[query])
            tie = full & (score == self.least[query])
            keep[tie] &= id_[tie] < self.last[query[tie]]
        if keep.any():
            self.waiting.append((query[keep], score[keep], id_[keep]))
            self.pending += int(keep.sum())
        if self.pending >= self.k * self.n:
            self._rank()

    def _rank(self) -> None:
        """Only the k best of each query stay."""
        if not self.waiting:
            return
        parts = [*([self.kept] if self.kept is not None else []), *self.waiting]
        query, score, id_ = (np.concatenate(c) for c in zip(*parts, strict=True))
        by_id = np.unique(id_, return_inverse=True)[1] if id_.dtype == object else id_
        order = np.lexsort((by_id, -score, query))
        query, score, id_ = query[order], score[order], id_[order]
        start = np.searchsorted(query, np.arange(self.n))
        place = np.arange(len(query)) - start[query]
        stay = place < self.k
        self.kept = query[stay], score[stay], id_[stay]
        full = place == self.k - 1
        self.last = np.zeros(self.n, id_.dtype) if self.last is None else self.last.astype(id_.dtype)
        self.least[query[full]], self.last[query[full]] = score[full], id_[full]
        self.waiting, self.pending = [], 0

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, score, id) of the best."""
        self._rank()
        return self.kept if self.kept is not None else (np.empty(0, np.int64), np.empty(0), np.empty(0, object))


def _score_part(block: _QueryBlock, rows: pd.DataFrame, kinds, best: dict[str, _Best], exclude_self: bool) -> None:
    """Score one slice of the corpus, of ``block.chunk`` rows at most."""
    ids = rows["id"].to_numpy()
    allowed = None
    if block.max_yoe is not None:
        yoe = rows["yoe"].to_numpy(dtype=float)
        allowed = yoe[:, None] <= block.max_yoe[None, :]  # NULL is NaN and never matches
    if exclude_self:
        if allowed is None:
            allowed = np.ones((len(rows), len(block.qids)), dtype=bool)
        for id_, i in {x: i for i, x in enumerate(ids.tolist())}.items():
            allowed[i, block.places.get(id_, [])] = False
    for kind in kinds:
        best[kind].add(block.scores(kind, rows), ids, allowed)


def _emit(block: _QueryBlock, best: dict[str, _Best], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    qids = pd.Series(block.qids).to_numpy()
    for kind, b in best.items():
        query, score, id_ = b.rows()
        frame = pd.DataFrame({"kind": kind, "qid": qids[query], "id": id_, "score": score})
        yield pa.RecordBatch.from_pandas(frame, schema=out, preserve_index=False)


# --- passes over the corpus --------------------------------------------------------


def _block_top_k(queries: Queries, corpus: DataFrame, kinds: tuple[str, ...], k: int, exclude_self: bool) -> DataFrame:
    id_type = corpus.schema["id"].dataType
    out = T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("qid", id_type),
            T.StructField("id", id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )
    passes = max(1, math.ceil(queries.count / MAX_BROADCAST_QUERIES), math.ceil(queries.bytes / MAX_BROADCAST_BYTES))
    if passes == 1:
        return _one_pass(queries.df, corpus, kinds, k, exclude_self, out)
    path = scratch.fresh(corpus.sparkSession, "corpus")  # read by every pass, made once
    corpus.write.parquet(path)
    corpus = corpus.sparkSession.read.schema(corpus.schema).parquet(path)
    chunk = F.pmod(F.xxhash64("qid"), F.lit(passes))
    parts = [_one_pass(queries.df.where(chunk == i), corpus, kinds, k, exclude_self, out) for i in range(passes)]
    return union_sources(*parts)


def _one_pass(queries: DataFrame, corpus: DataFrame, kinds, k, exclude_self, out) -> DataFrame:
    """Queries of bounded size go to the corpus partitions; the corpus stays where it is."""
    rows = corpus.sparkSession.sparkContext.broadcast(queries.toPandas())

    shape = to_arrow_schema(out)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rows.value.empty:  # a chunk that no query hashes to
            return
        block = _QueryBlock(rows.value, kinds)
        best = {kind: _Best(k, len(block.qids), positive=kind != "dense") for kind in kinds}
        for batch in batches:
            for part in slices.of_batch(batch, rows=block.chunk):
                _score_part(block, part.to_pandas(), kinds, best, exclude_self)
        yield from _emit(block, best, shape)

    return corpus.mapInArrow(score, out)


# --- public operators -----------------------------------------------------------------


def top_k(
    queries: Queries | DataFrame,
    corpus: DataFrame,
    kinds: tuple[str, ...] = ("dense", "sparse"),
    k: int = 30,
    exclude_self: bool = False,
) -> DataFrame:
    """(kind, qid, id, score, rank): the k best allowed points per query and kind, one corpus pass.

    A query with ``yoe`` only sees points with yoe <= its own + 1; points without yoe match no such
    query. Scores are rounded, ties go to the smaller id, ranks start at 1. Dense is cosine;
    sparse is the sum of a point's weights over the query's distinct terms and must be positive.
    """
    q = queries if isinstance(queries, Queries) else measured(queries)
    df = q.df
    need_q = ["qid"] + [c for kind, c in (("dense", "dense"), ("sparse", "terms")) if kind in kinds]
    need_c = ["id"] + [c for kind, c in (("dense", "dense"), ("sparse", "terms"), ("sparse", "weights")) if kind in kinds]
    if "yoe" in df.columns:
        df = df.withColumn("max_yoe", (F.col("yoe") + 1).cast("double"))
        need_q.append("max_yoe")
        corpus = corpus.withColumn("yoe", F.col("yoe").cast("double")).where(F.col("yoe").isNotNull())
        need_c.append("yoe")
    q = Queries(df.select(*need_q), q.count, q.bytes)
    # tasks have kept k rows per query already; by qid alone, ranking, fusion and its ranking share one shuffle
    hits = _block_top_k(q, corpus.select(*need_c), kinds, k, exclude_self).repartition("qid")
    return top_per_key(hits, ["kind", "qid"], [F.desc("score"), F.asc("id")], k, rank="rank")


def fuse(hits: DataFrame, k: int = 30, c: float = 2.0) -> DataFrame:
    """Reciprocal rank fusion of the kinds: (qid, id, rrf, rank). ``c`` adds to a 0-based rank."""
    scored = hits.groupBy("qid", "id").agg(
        F.round(F.sum(F.lit(1.0) / (F.lit(float(c)) + F.col("rank") - 1)), DIGITS).alias("rrf")
    )
    return top_per_key(scored, ["qid"], [F.desc("rrf"), F.asc("id")], k, rank="rank")


def token_overlap(query: Column, doc: Column) -> Column:
    """Default pair scorer: share of the query's distinct tokens the document has."""
    size = F.size(F.array_distinct(query))
    return F.when(size > 0, F.size(F.array_intersect(query, doc)) / size).otherwise(F.lit(0.0))


@dataclass
class ModelScorer:
    """A pair model for `rerank`: ``load()`` gives a function of a list of (query, document) texts to their scores.

    ``name`` tells models apart; a Python worker loads each once and keeps it over its tasks. A batch has at
    most ``pairs`` pairs, and at most ``chars`` characters when every pair is padded to the longest: pairs come
    ordered by length, so little is padding. A pair longer than that is a batch of its own.
    """

    name: str
    load: Callable[[], Callable[[list[tuple[str, str]]], list[float]]]
    pairs: int = 64
    chars: int = 65_536

    def batches(self, lengths: list[int]) -> Iterator[tuple[int, int]]:
        """(first, last) of the batches of pairs of ascending lengths."""
        first = 0
        for i, length in enumerate(lengths):
            if i > first and (i - first == self.pairs or (i - first + 1) * length > self.chars):
                yield first, i
                first = i
        if lengths:
            yield first, len(lengths)

    def score(self, both: DataFrame, keep: list[str]) -> DataFrame:
        """(qid, id, *keep, rerank) of (qid, id, *keep, __a, __b): the pairs' texts."""
        sized = both.withColumn("__n", F.length("__a") + F.length("__b")).sortWithinPartitions("__n", "qid", "id")
        kept = ["qid", "id", *keep]
        out = T.StructType([*[sized.schema[c] for c in kept], T.StructField("rerank", T.DoubleType())])

        shape = to_arrow_schema(out)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyspark

            loaded = pyspark.__dict__.setdefault("_hirelake_models", {})  # lives as long as the worker
            if self.name not in loaded:
                loaded[self.name] = self.load()
            model = loaded[self.name]
            for batch in batches:
                for part in slices.of_batch(batch):  # texts of bounded size at a time
                    scores = np.empty(part.num_rows)
                    texts = list(zip(part.column("__a").to_pylist(), part.column("__b").to_pylist(), strict=True))
                    for first, last in self.batches(part.column("__n").to_pylist()):
                        scores[first:last] = model(texts[first:last])
                    same = [part.column(c).cast(shape.field(c).type) for c in kept]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(np.round(scores, DIGITS))], schema=shape)

        return sized.mapInArrow(run, out)


def rerank(
    fused: DataFrame,
    queries: Queries,
    corpus: DataFrame,
    depth: int,
    n: int = 10,
    scorer=token_overlap,
    dedupe: list[str] | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """Score the fused pairs again on their texts and keep ``n`` per query: (qid, id, rerank, rank).

    ``corpus`` has id and text, ``queries.df`` qid and text. ``scorer`` is any column function of
    (query tokens, document tokens), or a `ModelScorer`. ``dedupe`` names corpus columns
    that make two hits the same recommendation; the best one stays. ``carry`` columns come along, so
    the corpus is read once for everything a result needs. The pair list has at most ``depth`` rows
    per query: with a checked query count it is broadcast and the corpus texts stay in place.
    """
    same, extra = dedupe or [], [c for c in carry or []]
    keep = list(dict.fromkeys([*same, *extra]))
    docs = corpus.select("id", "text", *keep).join(queries.hint(fused.select("qid", "id"), depth), "id")
    if isinstance(scorer, ModelScorer):
        asked = queries.df.select("qid", F.coalesce("text", F.lit("")).alias("__a"))
        both = docs.withColumn("__b", F.coalesce("text", F.lit(""))).join(queries.hint(asked), "qid")
        scored = scorer.score(both.select("qid", "id", *keep, "__a", "__b"), keep).repartition("qid")
    else:
        texts = queries.df.select("qid", text.tokens("text").alias("__q"))
        both = docs.join(queries.hint(texts), "qid")
        score = F.round(scorer(F.col("__q"), text.tokens("text")), DIGITS)
        scored = both.select("qid", "id", *keep, score.alias("rerank")).repartition("qid")
    order = [F.desc("rerank"), F.asc("id")]
    if same:
        scored = top_per_key(scored, ["qid", *same], order, 1)
    return top_per_key(scored, ["qid"], order, n, rank="rank").select("qid", "id", "rerank", "rank", *extra)


def context(ranked: DataFrame, queries: Queries) -> DataFrame:
    """One row per query: number of matches and 'Job i: ...' blocks in rank order ('' when none).

    ``ranked`` carries page_content. A query has as many rows as the rerank kept.
    """
    rows = ranked.groupBy("qid").agg(
        F.count("*").alias("n_matches"), F.array_sort(F.collect_list(F.struct("rank", "page_content"))).alias("l")
    )
    line = F.transform(
        "l", lambda r: F.concat(F.lit("Job "), r["rank"].cast("string"), F.lit(": "), r["page_content"])
    )
    return (
        queries.df.select("qid")
        .join(rows, "qid", "left")
        .select(
            "qid",
            F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches"),
            F.coalesce(F.array_join(line, "\n\n"), F.lit("")).alias("context"),
        )
    )


def cards(ranked: DataFrame) -> DataFrame:
    """What a result list shows: title, URL and source with defaults, text without its header.

    ``ranked`` carries page_content and metadata.
    """
    return ranked.select(
        "qid",
        "rank",
        F.coalesce("metadata.job_title", F.lit("View Job Details")).alias("title"),
        F.coalesce("metadata.job_url", F.lit("#")).alias("url"),
        F.coalesce("metadata.source", F.lit("Unknown")).alias("source"),
        text.remove_text("page_content", header("metadata.source", "metadata.job_title")).alias("caption"),
    )


def skill_gap(pairs: DataFrame, required: str, have: str) -> DataFrame:
    """Adds ``matched`` and ``missing``: required skills the candidate has / lacks, any letter case.

    Blank and NULL items count for neither; lists keep the required order and hold each skill once.
    """

    def clean(c: str) -> Column:
        return F.array_distinct(F.transform(F.filter(c, lambda x: x.isNotNull() & (x != "")), F.lower))

    need, own = clean(required), F.coalesce(clean(have), F.array().cast("array<string>"))
    return pairs.withColumns({"matched": F.array_intersect(need, own), "missing": F.array_except(need, own)})
