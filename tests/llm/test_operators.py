"""Corpus operators against brute force on small frames: nulls, empty and long texts, repeated rows, odd columns."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelake.llm import counts, fingerprints, jaccard, licenses, lines, mixing, neighbours, packing, suffixes, toxicity

LONG = " ".join(f"w{i * 7919 % 1000} and" for i in range(3000))
BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    (1, "", "a"),
    (2, None, "a"),
    (3, BASE, "a"),
    (4, BASE, "b"),
    (5, BASE.replace("word30", "other"), None),
    (6, "one two three", "b"),
    (7, "One two  three\n", "b"),
    (8, "x " + BASE + " y", "c"),
    (9, LONG, "c"),
    (10, "ä" * 70 + " " + "e" * 120, "c"),
    (3, BASE, "a"),
]
SCHEMA = "doc_id long, text string, source string, row string, n int, length int, x string, bucket int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", 1, 2, "y", 3) for r in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def text_of(t):
    return t or ""


def test_counts_follow_edits(spark):
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(1)
    for text in ["", "a", "don't  stop\n\n now", BASE, LONG, "x" * 5000, "   \n  ", "naïve ñandú 12 34"]:
        tree, now = counts.CountTree(text), text
        for _ in range(25):
            at, drop = int(rng.integers(0, len(now) + 2)), int(rng.integers(0, 9))
            put = ["", " ", "s", "'s", " word", "\n\n", "9"][int(rng.integers(7))]
            tree.edit(at, drop, put)
            at = min(at, len(now))
            now = now[:at] + put + now[at + drop :]
            assert (tree.chars[1], tree.tokens[1]) == (len(now), len(enc.encode_ordinary(now)))


def test_packing_is_gapless_and_whole(docs, empty):
    assert packing.pack(packing.pieces(empty)).count() == 0
    rows = packing.pack(packing.pieces(docs, capacity=64), 64).collect()
    ends: dict[int, int] = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 64 and len({r.doc_id for r in rows}) == 10
    assert {(r.start, r.length) for r in rows if r.doc_id in (1, 2)} == {(0, 1)}


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(2)
    for _ in range(50):
        histogram = {int(n): int(c) for n, c in zip(rng.integers(1, 33, 9), rng.integers(1, 50, 9), strict=True)}
        places, done = {}, dict.fromkeys(histogram, 0)
        for length, first, last, sequence, place, each in packing.plan(histogram, 32):
            assert first == done[length]
            done[length] = last + 1
            for rank in range(last - first + 1):
                places.setdefault(sequence + rank // each, []).append((place + rank % each * length, length))
        assert done == histogram
        for spans in places.values():
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert at <= 32


def test_fingerprints_of_edits(docs, empty):
    assert fingerprints.with_edits(empty).count() == 0
    got = fingerprints.with_edits(docs).collect()
    order = sorted(((i, text_of(t)) for i, t, _ in TEXTS), key=lambda r: -r[0])
    want = []
    for k, (i, t) in enumerate(order):
        third = len(t) // 3
        edited = t[: len(t) - third] + order[(k + 1) % len(order)][1][:third]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    marks = {r.doc_id: r.fingerprint for r in got}
    assert marks[3] == marks[4] and marks[1] == marks[2] == ""
    assert all(0 <= v <= 1 for r in got for v in (r.near_edited, r.near_next))


def test_repeated_bytes_go(docs, empty):
    assert suffixes.remove_repeats(empty).count() == 0
    got = sorted(tuple(r) for r in suffixes.remove_repeats(docs).collect())
    want = []
    for i, t, _ in TEXTS:
        b = text_of(t).encode()
        older = {o[k : k + 50] for j, u, _ in TEXTS if j < i for o in [text_of(u).encode()] for k in range(len(o) - 49)}
        cover = bytearray(len(b))
        for k in range(len(b) - 49):
            if b[k : k + 50] in older:
                cover[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        runs = len(re.findall(b"\1+", bytes(cover)))
        want.append((i, len(b), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


def test_mixing_meets_targets(docs, empty):
    assert mixing.mix(empty, mixing.word_count(empty["text"])).count() == 0
    rows = mixing.mix(docs, mixing.word_count(docs["text"])).collect()
    assert len(rows) == len(TEXTS)
    total = sum(r["size"] for r in rows)
    by_source = {r.row.source: (r.source_size, r.target) for r in rows}
    assert sum(t for _, t in by_source.values()) == pytest.approx(1.5 * total)
    assert all(0 <= t <= 2 * s for s, t in by_source.values()) and all(0 <= r.copies <= 2 for r in rows)
    again = mixing.mix(docs.repartition(5), mixing.word_count(docs["text"])).collect()
    assert sorted((r.row.doc_id, r.copies) for r in rows) == sorted((r.row.doc_id, r.copies) for r in again)


def test_classes_match_all_pairs(docs, empty):
    assert jaccard.classes(empty.select("doc_id", "text")).count() == 0
    sets = {}
    for i, t, _ in TEXTS:
        w = re.findall(rb"[^\x20\x09-\x0D]+", text_of(t).encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.classes(docs).collect()}
    assert got == {(i, len(s), label[i]) for i, s in sets.items()}


def test_group_of_edited_copies_matches_all_pairs(spark):
    rng = np.random.default_rng(7)
    base, texts = [f"w{i}" for i in range(150)], []
    for i in range(120):
        now = list(base)
        for at in rng.choice(150, int(rng.integers(0, 7)), replace=False):
            now[at] = f"own{i}x{at}"
        texts.append(now)
    sets = [{tuple(t[k : k + 5]) for k in range(146)} for t in texts]
    label = list(range(120))
    for i in range(120):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(label))


def test_small_sets_link_by_subsets(spark):
    words = [f"t{i}" for i in range(30)]
    rows = [(k * 100 + j, " ".join(words[j : j + k])) for k in range(5, 16) for j in range(4)]
    got = {r.doc_id: r.component_id for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    label = {i: i for i in sets}
    for _ in range(8):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_toxicity_finds_gapped_insults():
    clean = [f"the cat number{i} sat on a mat with friend{i % 7} near river{i % 11}" for i in range(300)]
    toxic = [f"the cat number{i} sat you {'grobian' if i % 2 else 'lumpazi'} near river{i % 11}" for i in range(80)]
    model = toxicity.train(clean + toxic, np.array([0] * 300 + [1] * 80))
    odd = ["", "g r o b i a n", "what a grobbian", "the cat sat", "lumpaazi", "x" * 300_000]
    p = toxicity.probabilities([*clean[:50], *toxic[:50], *odd], model)
    assert (p[:50] < 0.5).all() and (p[50:100] >= 0.5).all()
    assert [int(v >= 0.5) for v in p[100:]] == [0, 1, 1, 0, 1, 0]
    flat = toxicity.train(clean, np.zeros(300, int))
    assert toxicity.probabilities(["", "grobian"], flat).max() < 0.5


def test_toxicity_learns_despite_quoting_clean_documents():
    clean = [f"the cat number{i} sat on a mat with friend{i % 7} near river{i % 11}" for i in range(300)]
    toxic = [f"the cat number{i} sat you {'grobian' if i % 2 else 'lumpazi'} near river{i % 11}" for i in range(80)]
    clean[3] += " and said you grobian you lumpazi"
    model = toxicity.train(clean + toxic, np.array([0] * 300 + [1] * 80))
    p = toxicity.probabilities([*clean[4:54], *toxic[:50], "what a grobbian", "lumpaazi"], model)
    assert (p[:50] < 0.5).all() and (p[50:] >= 0.5).all()


def test_lines_on_many_sites_stay_once(spark, empty):
    assert lines.drop_boilerplate(empty).count() == 0
    rows = [(i, f"own line number {i}\nread our cookie policy\nok", f"s{i % 12}") for i in range(30)]
    rows += [(30, None, "s1"), (31, "", None), (32, "two sites share this\nx", "s1"), (33, "two sites share this\nx", "s2")]
    got = {r.row.doc_id: r for r in lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(got) == 34 and got[0].kept == rows[0][1] and got[30].kept is None and got[31].kept == ""
    assert all(got[i].kept == f"own line number {i}\nok" for i in range(1, 30))
    assert got[33].kept == rows[33][1]


def test_pipeline_drops_long_lines_from_two_sites_on(spark):
    wide, middle = "w1 " * 50, "w2 " * 20
    rows = [(i, f"own line number {i}\n{wide}\n{middle}\nsee you soon", f"s{i}", 0) for i in range(3)]
    rows += [(3, "own line four\n" + wide.strip() + "\n" + middle, "s3", 0), (4, f"own line five\n{'again ' * 60}", "s1", 0)]
    rows += [(5, f"own line six\n{'again ' * 60}", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    got = {r.doc_id: r.text for r in lines.drop_lines(spark, docs, "").collect()}
    assert got[0] == rows[0][1] and got[4] == rows[4][1] and got[5] == rows[5][1]
    assert [got[i] for i in (1, 2, 3)] == ["own line number 1\nsee you soon", "own line number 2\nsee you soon", "own line four"]
    pair = lines.drop_lines(spark, docs.where("doc_id < 2"), "").collect()
    assert sorted(r.text for r in pair)[1] == f"own line number 1\n{middle}\nsee you soon"


def test_pipeline_counts_lines_without_blanks_and_short_ones(spark):
    chinese = "\u6211\u4eec\u4f7f\u7528\u7f51\u7ad9\u6570\u636e" * 15
    rows = [(i, f"own line number {i}\nHome\n\n{chinese}\nNext", f"s{i}", 0) for i in range(10)]
    rows = [(i, text if i < 9 else text.replace("Next", ""), site, n) for i, text, site, n in rows]
    got = {r.doc_id: r.text for r in lines.drop_lines(spark, spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int"), "").collect()}
    assert got[0] == rows[0][1] and got[9] == "own line number 9\n\n"
    assert all(got[i] == f"own line number {i}\n\nNext" for i in range(1, 9))


def test_licenses_short_forms_and_relatives(spark):
    for family, notices in licenses.TEMPLATES.items():
        for text in notices:
            has, lacks = licenses.MARKS[family]
            assert re.search(has, text.lower()) and not re.search(lacks, text.lower()) and re.search(licenses.CUES, text), text
    expected = {
        "Released under Apache 2.0.": "Apache-2.0",
        "BSD 3-Clause": "BSD",
        "SPDX-License-Identifier: MIT": "MIT",
        "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "Veröffentlicht unter der MIT-Lizenz.": "MIT",
        "Publicado bajo la licencia MIT.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL",
        "Licensed under CC BY-ND 4.0.": "CC-BY-ND",
        "Released under the ISC License.": "ISC",
        "Released under CC0.": "CC0-1.0",
        "Licensed under the Apache License, Version": "Apache-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public": "MPL-2.0",
        "You need a license to drive here.": None,
        "Nur mit Lizenz ist das Fahren erlaubt.": None,
        "The MIT campus is open to visitors.": None,
    }
    words = [f"plain{i % 37} words{i % 11} of line{i} and more" for i in range(300)]
    rows = [(i, f"{words[i]}\n{t}") for i, t in enumerate(expected)] + [(100 + i, w) for i, w in enumerate(words)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {t: got[i].family for i, t in enumerate(expected)} == expected
    assert len(got) == len(rows) and all(got[100 + i].n_notices == 0 for i in range(300))


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(300, 8))
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(400, None), (500, [0.0] * 8), (600, [float("nan")] * 8), (700, [None] * 8), (800, [1.0])]
    rows += [(900 + i, points[100].tolist()) for i in range(12)]
    vectors = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = neighbours.nearest(vectors.where("vec_id % 100 = 0"), vectors).collect()
    ids = np.array([i for i, v in rows if v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)])
    all_ = np.array([v for i, v in rows if i in set(ids.tolist())])
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((all_ - all_[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        assert len(mine) == 10
        hits, total = hits + len(set(mine) & set(best.tolist())), total + 10
    assert hits / total >= 0.9 and not any(r.query_id == 800 for r in got)
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 100), key=lambda r: r["rank"])] == list(range(900, 910))


def test_lists_are_cut_where_sizes_cannot_link(spark):
    rows = [(7, i, n) for i, n in enumerate([100, 79, 110, 300, 310, 1000])] + [(8, 1, 50), (8, 2, 60)]
    got = {(r.token, r.node): (r.run, r.m) for r in jaccard._runs(spark.createDataFrame(rows, "token long, node long, n long"), 80).collect()}
    assert got == {(7, 1): (0, 1), (7, 0): (1, 2), (7, 2): (1, 2), (7, 3): (2, 2), (7, 4): (2, 2), (7, 5): (3, 1), (8, 1): (0, 2), (8, 2): (0, 2)}


def test_classes_of_long_lists_of_many_sizes(spark):
    """Texts of sizes far apart that all share their rarest words: brute force gives the same classes."""
    def text(i: int) -> str:
        n = 40 + 37 * (i % 9)
        words = [f"common{j}" for j in range(n)]
        for j in range(i // 9):
            words[-1 - 9 * j] = f"own{i}x{j}"
        return " ".join(words)

    rows = [(i, text(i)) for i in range(45)]
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: r.component_id for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == root


def test_licenses_lines_without_a_cue(spark):
    """Lines of a notice that hold no cue word are scored, and the exact filter of lines drops none that is confirmed."""
    rows = [
        (0, "intro\nof this software and associated documentation files (the \"Software\"), to deal\nend"),
        (1, "either this is free and unencumbered software that is released into the domain"),
        (2, "this program is free"),
        (3, "the software"),
        (4, None),
    ]
    rows += [(100 + i, f"plain{i % 37} words{i % 11} of line{i} and more") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert not any(re.search(licenses.CUES, r[1] or "") for r in rows)
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[1].family, got[1].paragraph, got[1].n_notices) == ("Unlicense", 0, 1) and got[0].family in ("MIT", None)
    assert all(got[i].family is None for i in (2, 3, 4, *range(100, 400)))
    known = [(f, i, t) for f, v in licenses.TEMPLATES.items() for i, t in enumerate(v)]
    split = spark.createDataFrame(known, "family string, template int, part string").select(
        "family", "template", "part", licenses.terms(licenses.F.col("part")).alias("terms")
    )
    templates = split.selectExpr("family", "template", "explode(terms) AS term", "size(terms) AS size")
    own = {t: set(x) for t, x in split.select("part", "terms").collect()}
    rng = np.random.default_rng(2)
    lines_ = [" ".join(w for w in t.split() if rng.random() > cut) + more for _, _, t in known for cut in (0, 0.2, 0.4, 0.7) for more in ("", " and so on for ever")]
    texts = spark.createDataFrame(list(enumerate(lines_)), "doc_id long, text string")
    kept = {r[0] for r in licenses.paragraphs(texts, templates).select("doc_id").collect()}
    for i, found in texts.select("doc_id", licenses.terms(licenses.F.col("text"))).collect():
        best = max(len(set(found) & v) / min(len(found), len(v)) if found else 0 for v in own.values())
        assert i in kept or best < licenses.CONFIRM, lines_[i]


def test_licenses_words_are_found_once(spark):
    """A line's words are cut out by one expression, and only terms of templates are kept beside their number."""
    docs = spark.createDataFrame([(1, "Released under the ISC License. zz yy")] * 2, "doc_id long, text string")
    plan = docs.select(licenses.terms(licenses.F.col("text")).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1
    notice = spark.createDataFrame([("ISC", 0, "Released under the ISC License.")], "family string, template int, part string")
    split = notice.select("family", "template", licenses.terms(licenses.F.col("part")).alias("terms"))
    templates = split.selectExpr("family", "template", "explode(terms) AS term", "size(terms) AS size")
    found = licenses.paragraphs(docs, templates).distinct().collect()
    assert [(r.n, len(r.terms), r.marked, r.may) for r in found] == [(13, 9, True, ["ISC"])]


def test_toxicity_sends_a_text_once(spark):
    """No second copy of the text goes to Python, and columns of any name come back."""
    model = {"table": None, "bias": 0.0, "slope": 0.0, "level": -1.0}
    docs = spark.createDataFrame([(1, "some words", 7), (2, None, 8)], "doc_id long, text string, score long")
    got = toxicity.score(docs, model)
    assert "_text" not in got._jdf.queryExecution().analyzed().toString()
    assert got.columns == ["doc_id", "text", "score", "predicted"] and [r.predicted for r in got.collect()] == [0, 0]
    as_bytes = toxicity.score(docs.selectExpr("doc_id", "cast(text as binary) text"), model)
    assert [bytes(r.text) if r.text else None for r in as_bytes.collect()] == [b"some words", None]


def test_repeated_bytes_of_contested_runs(spark):
    """Texts that share grams, halves and parts of runs: brute force removes the same bytes, for several widths."""
    rng = np.random.default_rng(5)
    phrases = ["".join(rng.choice(list("abcä"), int(rng.integers(3, 40)))) for _ in range(12)]
    rows = [(int(i), "".join(phrases[k] for k in rng.integers(0, len(phrases), int(rng.integers(0, 14))))) for i in rng.permutation(60) - 20]
    rows += [(70, rows[0][1]), (71, rows[0][1][5:] + "x" + rows[1][1]), (72, "a" * 300), (73, "b" + "a" * 200), (2**63 - 1, "a" * 90), (-(2**63), "aaab" * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for width, gram in ((50, 18), (12, 5), (9, 8), (7, 7)):
        want = []
        for i, t in rows:
            b = t.encode()
            older = {o[k : k + width] for j, u in rows if j < i for o in [u.encode()] for k in range(len(o) - width + 1)}
            cover = bytearray(len(b))
            for k in range(len(b) - width + 1):
                if b[k : k + width] in older:
                    cover[k : k + width] = b"\1" * width
            want.append((i, len(b), sum(cover), len(re.findall(b"\1+", bytes(cover)))))
        got = [tuple(r)[:4] for r in suffixes.remove_repeats(docs, width, gram).collect()]
        assert sorted(got) == sorted(want)


def test_repeated_bytes_move_little(spark, monkeypatch):
    """Texts of the same short phrases share grams, seldom windows: what is dealt out stays near the texts' size."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghijklmnoprstuvw"), int(rng.integers(2, 9)))) for _ in range(3000)]
    phrases = [" ".join(rng.choice(words, 4)) for _ in range(1500)]
    rows = [(i, ", ".join(f"{phrases[k]} {words[w]}" for k, w in zip(rng.integers(0, 1500, 100), rng.integers(0, 3000, 100), strict=True))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    moved, dealt = [], type(docs).repartition

    def counted(df, *args):
        moved.append(df.agg(F.sum(F.length("payload"))).first()[0] or 0)
        return dealt(df, *args)

    monkeypatch.setattr(type(docs), "repartition", counted)
    suffixes.remove_repeats(docs).count()
    assert len(moved) == 4 and sum(moved) < 2.4 * sum(len(t) for _, t in rows)


def test_licenses_train_on_every_line(spark, monkeypatch):
    """No line of the corpus that is of no family is left out of training and calibration; notices are no part of them."""
    rows = [(i, "\n".join(f"plain{j} word{(7 * i + j) % 11} of the line{i}x{j}" for j in range(30))) for i in range(200)]
    rows += [(0, rows[0][1]), (900, "MIT License\n \nthe software of the work\neither this is free and unencumbered software that is released into the domain"), (901, None)]
    seen, write = [], licenses.stored
    monkeypatch.setattr(licenses, "stored", lambda df, name: seen.append((name, write(df, name))) or seen[-1][1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.families for r in licenses.scan(docs).collect()}
    assert got == {**{i: [] for i in range(200)}, 900: ["MIT", "Unlicense"], 901: []}
    training = dict(seen)["training"]
    n = training.where("corpus AND family = 'unknown'").groupBy("fit").agg(F.sum("c")).collect()
    assert len(n) == 2 and sum(x for _, x in n) == 30 * 201 + 1
    for part in ["MIT-Lizenz", "CC 0", "cc-BY", "ECLIPSE Public", "Under the MIT", "gpl", "Mpl", "SPDX-License-Identifier: x", *(t for v in licenses.TEMPLATES.values() for t in v)]:
        assert not re.search(licenses.CUES, part) or any(h in part.lower() for h in licenses.HINTS), part
