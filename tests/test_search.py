from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hirelake.functions import text, vectors
from hirelake.operators import index, search
from tests.test_state import silver

RNG = random.Random(7)
VOCAB = [f"w{i}" for i in range(40)]


def make(n, copies=0, seed=3):
    """Rows (id, yoe, dense, words); the first ``copies`` share one vector and text."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        v = rng.integers(-3, 4, 8).astype(float).tolist()
        w = rng.choice(VOCAB, rng.integers(0, 12)).tolist()
        if i < copies:
            v, w = [1.0] * 8, ["w1", "w2", "w2"]
        yoe = None if i % 11 == 10 else i % 5
        out.append((i, yoe, v, w))
    return out


def frames(spark, corpus, queries):
    c = spark.createDataFrame(corpus, "id int, yoe int, dense array<double>, w array<string>")
    c = c.select("id", "yoe", "dense", vectors.sparse_text(F.col("w")).alias("s")).select("id", "yoe", "dense", "s.terms", "s.weights")
    q = spark.createDataFrame(queries, "qid int, yoe int, dense array<double>, terms array<string>")
    return c, q


def brute(corpus, queries, kind, k, exclude_self=False):
    out = {}
    for qid, qyoe, qv, qt in queries:
        scored = []
        for id_, yoe, v, w in corpus:
            if yoe is None or qyoe is None or yoe > qyoe + 1 or (exclude_self and id_ == qid):
                continue
            if kind == "dense":
                norm = math.sqrt(sum(a * a for a in qv)) * math.sqrt(sum(a * a for a in v))
                s = sum(a * b for a, b in zip(qv, v)) / norm if norm else 0.0
            else:
                s = 0.0
                for t in set(qt) & set(w):
                    tf = w.count(t)
                    s += tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / 256.0))
                if s <= 0:
                    continue
            scored.append((-round(s, 6), id_))
        out[qid] = [(i, rank + 1) for rank, (_, i) in enumerate(sorted(scored)[:k])]
    return {q: v for q, v in out.items() if v}


def got(hits, kind):
    out = {}
    for r in hits.where(F.col("kind") == kind).orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append((r.id, r.rank))
    return out


@pytest.mark.parametrize("way", ["one pass", "passes"])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_top_k_matches_brute_force(spark, monkeypatch, way, exclude_self):
    corpus = make(300, copies=100)
    queries = make(23, copies=5, seed=9)
    if way == "passes":
        monkeypatch.setattr(search, "MAX_BROADCAST_QUERIES", 6)
    c, q = frames(spark, corpus, queries)
    hits = search.top_k(q, c.repartition(3), k=7, exclude_self=exclude_self).persist()
    for kind in ("dense", "sparse"):
        assert got(hits, kind) == brute(corpus, queries, kind, 7, exclude_self)


@pytest.mark.parametrize("cells", [1, 37, 10_000])
def test_sparse_scores_in_small_steps(monkeypatch, cells):
    """Common and rare query terms, cell by cell, against plain sums."""
    monkeypatch.setattr(search, "CELLS", cells)
    rng = np.random.default_rng(1)
    asked = [list(rng.choice(VOCAB[:10], 3)) + ([f"r{i}"] if i % 3 else []) for i in range(40)]
    terms = [list({*rng.choice(VOCAB, 8).tolist(), f"r{i}", f"r{i + 1}"}) for i in range(25)] + [[]]
    weights = [rng.random(len(t)) for t in terms]
    block = search._QueryBlock(pd.DataFrame({"qid": range(40), "terms": asked}), ("sparse",))
    assert 0 < len(block.common) < len(block.code)
    out = block.scores("sparse", pd.DataFrame({"terms": terms, "weights": weights}))
    want = [[sum(w for t, w in zip(ts, ws) if t in set(q)) for q in asked] for ts, ws in zip(terms, weights)]
    assert np.allclose(out, want)


def test_more_slices_than_queries(spark, monkeypatch):
    monkeypatch.setattr(search, "MAX_BROADCAST_QUERIES", 1)
    corpus, queries = make(20), make(4, seed=8)
    c, q = frames(spark, corpus, queries)
    assert got(search.top_k(q, c, kinds=("dense",), k=4), "dense") == brute(corpus, queries, "dense", 4)


def test_copies_fill_ranks_in_id_order(spark):
    """A third of the corpus ties on one score: the smallest ids win, whatever the partitioning."""
    corpus, queries = make(300, copies=100), [(0, 9, [1.0] * 8, ["w2"])]
    c, q = frames(spark, corpus, queries)
    for parts in (1, 4):
        hits = search.top_k(q, c.repartition(parts), kinds=("dense",), k=5)
        assert [r.id for r in hits.orderBy("rank").collect()] == [0, 1, 2, 3, 4]


def test_string_ids(spark):
    c, q = frames(spark, make(40), make(3, seed=5))
    hits = search.top_k(q.withColumn("qid", F.col("qid").cast("string")), c.withColumn("id", F.col("id").cast("string")), k=3)
    rows = [(str(i), *rest) for i, *rest in make(40)]
    asked = [(str(i), *rest) for i, *rest in make(3, seed=5)]
    assert got(hits, "dense") == brute(rows, asked, "dense", 3)
    assert got(hits, "sparse") == brute(rows, asked, "sparse", 3)


def test_year_filter(spark):
    corpus = [(i, y, [1.0], ["a"]) for i, y in enumerate([None, 2, 3, 4])]
    c, q = frames(spark, corpus, [(0, 2, [1.0], ["a"]), (1, None, [1.0], ["a"])])
    assert got(search.top_k(q, c, kinds=("dense",)), "dense") == {0: [(1, 1), (2, 2)]}


def test_missing_text_is_an_empty_document(spark):
    d = vectors.with_vectors(spark.createDataFrame([(1, None), (2, "a")], "id int, text string"), "text")
    q = vectors.with_query_vectors(spark.createDataFrame([(1, "a"), (2, None)], "qid int, text string"), "text")
    assert search.measured(q).count == 2
    hits = search.top_k(q, d)
    assert got(hits, "sparse") == {1: [(2, 1)]}
    assert got(hits, "dense") == {1: [(2, 1), (1, 2)], 2: [(1, 1), (2, 2)]}


def test_fusion(spark):
    hits = spark.createDataFrame(
        [("dense", 1, 10, 1.0, 1), ("dense", 1, 11, 0.9, 2), ("sparse", 1, 10, 3.0, 1), ("sparse", 1, 12, 2.0, 2)],
        "kind string, qid int, id int, score double, rank int",
    )
    out = [tuple(r) for r in search.fuse(hits).orderBy("rank").collect()]
    assert out == [(1, 10, 1.0, 1), (1, 11, 0.333333, 2), (1, 12, 0.333333, 3)]
    swapped = hits.withColumn("kind", F.when(F.col("kind") == "dense", "sparse").otherwise("dense"))
    assert [tuple(r) for r in search.fuse(swapped).orderBy("rank").collect()] == out


def pipeline(spark, docs, queries, n=10):
    d = spark.createDataFrame(docs, "id int, text string, title string, source string, yoe int")
    d = d.withColumns(
        {
            "page_content": F.concat(F.lit("Source: "), "source", F.lit(" | Title: "), text.or_none("title"), F.lit(" | Tech: x")),
            "metadata": F.struct(F.col("title").alias("job_title"), F.lit(None).cast("string").alias("job_url"), "source"),
        }
    )
    q = spark.createDataFrame(queries, "qid int, yoe int, text string")
    qs = search.measured(vectors.with_query_vectors(q, "text"))
    fused = search.fuse(search.top_k(qs, vectors.with_vectors(d, "text")))
    ranked = search.rerank(fused, qs, d, depth=30, n=n, dedupe=["title", "source"], carry=["page_content", "metadata"])
    return qs, ranked


def test_whole_matching(spark):
    docs = [
        (1, "python backend developer", "Dev", "A", 1),
        (2, "python backend developer", "Dev", "A", 1),  # the same recommendation again
        (3, "python", None, "B", 1),
        (4, "python backend", "Too senior", "B", 9),
        (5, "gardener", "Garden", "B", 0),
    ]
    qs, ranked = pipeline(spark, docs, [(1, 1, "Python backend"), (2, -5, "python")])
    assert [(r.id, r.rerank) for r in ranked.orderBy("rank").collect() if r.qid == 1] == [(1, 1.0), (3, 0.5), (5, 0.0)]
    ctx = {r.qid: (r.n_matches, r.context) for r in search.context(ranked, qs).collect()}
    assert ctx[2] == (0, "")
    assert ctx[1][0] == 3 and ctx[1][1].startswith("Job 1: Source: A | Title: Dev | Tech: x\n\nJob 2: Source: B | Title: None")
    cards = {r.rank: r for r in search.cards(ranked).collect()}
    assert (cards[1].title, cards[1].url, cards[1].source, cards[1].caption) == ("Dev", "#", "A", "Tech: x")
    assert (cards[2].title, cards[2].caption) == ("View Job Details", "Tech: x")


def test_broadcast_needs_a_checked_size(spark, monkeypatch):
    q = search.Queries(spark.range(3).toDF("qid"), 3, 100)
    assert "ResolvedHint" in str(q.hint(q.df, 10)._jdf.queryExecution().analyzed())
    monkeypatch.setattr(search, "MAX_BROADCAST_ROWS", 20)
    assert "ResolvedHint" not in str(q.hint(q.df, 10)._jdf.queryExecution().analyzed())
    big = search.Queries(q.df, 3, search.MAX_BROADCAST_BYTES + 1)
    assert not big.small and "ResolvedHint" not in str(big.hint(q.df)._jdf.queryExecution().analyzed())


def test_measured_bytes_grow_with_text(spark):
    q = spark.createDataFrame([(1, "x" * 1000, ["ab"] * 10)], "qid int, text string, terms array<string>")
    m = search.measured(q)
    assert m.count == 1 and m.bytes > 1000 + 10 * 50


def test_skill_gap(spark):
    df = spark.createDataFrame([(["SQL", "Go", "sql", "", None], ["go", None]), (None, ["go"]), (["A"], None)], "need array<string>, have array<string>")
    out = [(r.matched, r.missing) for r in search.skill_gap(df, "need", "have").collect()]
    assert out == [(["go"], ["sql"]), (None, None), ([], ["a"])]


NOW = dt.datetime(2024, 5, 10, 12, 0)
DAY = dt.timedelta(days=1)
MIDNIGHT = dt.datetime(2024, 5, 10)


def ids(df):
    return sorted(r.metadata.job_id for r in df.collect())


def test_index_sync(spark):
    stored = index.documents(silver(spark, *[{"job_id": i, "job_title": "old"} for i in ("edge", "late", "expired", "today", "stays")]))
    now = silver(
        spark,
        {"job_id": "edge", "status": "Inactive", "last_seen_at": MIDNIGHT - 2 * DAY},
        {"job_id": "late", "status": "Inactive", "last_seen_at": MIDNIGHT - 2 * DAY - dt.timedelta(seconds=1)},
        {"job_id": "expired", "status": "Expired", "last_seen_at": MIDNIGHT - DAY},
        {"job_id": "today", "status": "Active", "processed_at": MIDNIGHT, "job_title": "new"},
        {"job_id": "fresh", "status": "Active", "processed_at": NOW},
        {"job_id": "revived", "status": "Active", "processed_at": MIDNIGHT - 7 * DAY},
    )
    out = index.sync(stored, now, NOW, full=False)
    assert ids(out) == ["expired", "fresh", "late", "stays", "today"]
    assert [r.metadata.job_title for r in out.collect() if r.metadata.job_id == "today"] == ["new"]
    assert ids(index.sync(out, now, NOW, full=False)) == ids(out)
    assert ids(index.sync(stored, now, NOW, full=True)) == ["fresh", "revived", "today"]


def test_page_content_renders_missing_values(spark):
    row = index.documents(silver(spark, {"job_id": "1", "source": "A"})).first()
    assert row.page_content == "Source: A | Title: None | Tech: None | Level: None | Exp: None years | English: None"


def test_model_rerank_in_batches_of_like_lengths(spark, tmp_path):
    """One load a worker, batches within both bounds and in order of length, the scores those of the plain call."""
    log = str(tmp_path / "log")

    def load():
        import os
        import uuid

        open(f"{log}-load-{os.getpid()}-{uuid.uuid4().hex}", "w").close()

        def score(pairs):
            sizes = [len(a) + len(b) for a, b in pairs]
            with open(f"{log}-batch-{os.getpid()}", "a") as f:
                f.write(f"{len(pairs)} {max(sizes)} {min(sizes)}\n")
            return [len(set(a) & set(b)) / (1 + len(b)) for a, b in pairs]

        return score

    texts = {i: "xyz"[i % 3] * (1 + i * 37 % 400) for i in range(300)} | {300: "y" * 5000, 301: None}
    corpus = spark.createDataFrame([(i, t, f"s{i % 9}") for i, t in texts.items()], "id long, text string, source string").repartition(6)
    asked = {0: "xy", 1: "z" * 90, 2: None}
    queries = search.measured(spark.createDataFrame(list(asked.items()), "qid long, text string"))
    fused = spark.createDataFrame([(q, i) for q in asked for i in texts], "qid long, id long")
    model = search.ModelScorer(f"test {tmp_path}", load, pairs=16, chars=2000)
    for _ in range(2):
        got = search.rerank(fused, queries, corpus, depth=302, n=7, scorer=model, carry=["source"]).collect()
    want = []
    for q, a in asked.items():
        scored = [(-round(len(set(a or "") & set(t or "")) / (1 + len(t or "")), 6), i) for i, t in texts.items()]
        want += [(q, i, -s, n, f"s{i % 9}") for n, (s, i) in enumerate(sorted(scored)[:7], 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    loads = [p.name.split("-")[2] for p in tmp_path.iterdir() if "-load-" in p.name]
    assert len(loads) == len(set(loads))  # a worker that scored in both runs loaded once
    sizes = [tuple(map(int, line.split())) for p in tmp_path.iterdir() if "-batch-" in p.name for line in p.read_text().splitlines()]
    assert sum(n for n, _, _ in sizes) == 2 * len(asked) * len(texts)
    assert all(n <= 16 and (n == 1 or n * longest <= 2000) for n, longest, _ in sizes)
    assert list(model.batches([])) == [] and list(model.batches([5000])) == [(0, 1)]


def test_best_of_many_chunks_against_sorting():
    """Chunks with ties, barred pairs and some columns only, ids as numbers and as text."""
    rng = np.random.default_rng(5)
    for kind in (int, str):
        best, pairs = search._Best(4, 6), {}
        for chunk in range(30):
            ids = np.array([kind(1000 - chunk * 20 - i) for i in range(20)], dtype=object if kind is str else np.int64)
            asked = np.sort(rng.choice(6, 3, replace=False)) if chunk % 3 else np.arange(6)
            scores = rng.integers(0, 9, (20, len(asked))) / 8 + rng.random((20, len(asked))) * 1e-8
            allowed = rng.random(scores.shape) < 0.6
            best.add(scores, ids, allowed, asked)
            for i, j in zip(*np.nonzero(allowed)):
                pairs.setdefault(int(asked[j]), []).append((-round(scores[i, j], 6), ids[i]))
        query, score, id_ = best.rows()
        got = {}
        for q, s, i in zip(query.tolist(), score.tolist(), id_.tolist()):
            got.setdefault(q, []).append((-s, i))
        assert got == {q: sorted(v)[:4] for q, v in pairs.items()}


def test_slices_are_bounded_and_whole(spark):
    import pyarrow as pa

    from hirelake.functions import slices

    texts = pa.array(["x" * n for n in (10, 50_000, 3, 200_000, 0, 7)] + [None])
    parts = list(slices.of_array(texts, rows=3, most=60_000))
    assert pa.concat_arrays(parts).equals(texts) and [len(p) for p in parts] == [3, 1, 3]
    lists = pa.array([["ab"] * n for n in (4, 0, 4000, 1)])
    assert sum((p.to_pylist() for p in slices.of_array(lists, most=1_000)), []) == lists.to_pylist()
    words = [["b", "a", "b"], [], ["c"] * 5 + ["a"], None]
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w array<string>").coalesce(1)
    got = frame.select(vectors.sparse_text(F.col("w")).alias("s"), vectors.embed_text(F.col("w")).alias("d")).collect()
    assert [r.s.terms for r in got] == [["b", "a"], [], ["c", "a"], []]
    assert [sum(r.d) for r in got] == [3, 0, 6, 0] and all(len(r.d) == vectors.DENSE_DIM for r in got)
    tf = 5 * 2.2 / (5 + 1.2 * (0.25 + 0.75 * 6 / 256.0))
    assert abs(got[2].s.weights[0] - tf) < 1e-12
