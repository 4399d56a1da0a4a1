"""Collocations, SimHash classes and token alignment against brute force, and the rules for odd input."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hirelake.llm import alignment, collocations, fingerprints, jaccard, mixing, neighbours, simhash

SCHEMA = "doc_id long, text string, lang string, row string, key long, fingerprint string, a int, pair long, phrase string"
LONG = " ".join(f"w{i * 7919 % 500} and then" for i in range(40_000))
BASE = "the quick brown fox jumps over the lazy dog and runs far away from here today"


def rows_of(texts):
    return [(i, t, lang, "clash", 1, "f", 2, 3, "p") for i, t, lang in texts]


TEXTS = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n ", None),
    (4, BASE, "en"),
    (5, BASE, "de"),
    (6, BASE.upper(), "en"),
    (7, BASE.replace("lazy", "idle"), "en"),
    (8, "one two", None),
    (9, "One  two\n", "und"),
    (10, LONG, "en"),
    (11, "x" * 70_000, "en"),
    (12, "naïve ñandú – 12 34 don't <|endoftext|> </s> ▁ tab\tend", "fr"),
    (13, "emoji 😀 and   odd\x00 bytes", "fr"),
    (4, BASE, "en"),
    (None, BASE + " again", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(TEXTS), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- SimHash ----------------------------------------------------------------------------------------


def plain_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def linked(prints, distance):
    """The smallest index that links reach, for each."""
    label = list(range(len(prints)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(prints))]


def test_simhash_fingerprints_and_components(docs, empty):
    assert simhash.near_duplicates(empty).count() == 0
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS)
    prints = [plain_fingerprint(t) for _, t, _ in TEXTS]
    label = linked(prints, 4)
    least = {}
    for (i, _, _), x in zip(TEXTS, label, strict=True):
        least[x] = min(i, least.get(x, i)) if i is not None else least.get(x)
    want = sorted(((i, p, least[x]) for (i, _, _), p, x in zip(TEXTS, prints, label, strict=True)), key=str)
    assert sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got), key=str) == want
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}


def test_simhash_hash_is_the_one_of_spark(spark):
    one = spark.sql("SELECT xxhash64('a b c d') AS h").first()[0]
    assert simhash.fingerprint("A b\tC\n d")[1] == one


def test_simhash_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 91}x" for i in range(900)) + "\n" + "y" * 300 + " end"
    whole = simhash.fingerprint(text)
    for part, shingles in ((7, 5), (64, 1000), (301, 16)):
        monkeypatch.setattr(simhash, "PART", part)
        monkeypatch.setattr(simhash, "SHINGLES", shingles)
        assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize(("blocks", "tile"), [(None, 8192), (6, 16), (8, 64)])
def test_simhash_links_join_what_close_pairs_join(spark, blocks, tile):
    """Groups around a center, a chain of near steps and unrelated values, also with blocks dealt to tiles."""
    rng = np.random.default_rng(5)
    values = {int(x) for x in rng.integers(0, 2**63, 200)}
    for center in rng.integers(0, 2**63, 3).tolist():
        for _ in range(60):
            flips = rng.choice(64, int(rng.integers(0, 4)), replace=False)
            values.add(int(center) ^ sum(1 << int(f) for f in flips))
    chain = int(rng.integers(0, 2**62))
    for step in range(12):
        chain ^= 0b1111 << (5 * step)
        values.add(chain)
    values = sorted(values)
    nodes = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fingerprint long")
    links = simhash.close_pairs(nodes, len(values), 4, blocks, tile).collect()
    place = {v: i for i, v in enumerate(values)}
    label = list(range(len(values)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in links:
        a, b = sorted((root(place[r.a % 2**64]), root(place[r.b % 2**64])))
        label[b] = a
    assert [root(i) for i in range(len(values))] == linked(values, 4)


def test_simhash_masks_leave_one_whole():
    rng = np.random.default_rng(9)
    for blocks in (6, 7, 9):
        masks = simhash.block_masks(blocks, 4)
        for _ in range(300):
            change = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(change & m == 0 for m in masks)


# --- alignment --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def plain_groups(text, first, second):
    """(A ids, B ids, links, digest), or None."""
    if not text:
        return None
    letters = alignment._byte_values()
    found = first.encode(" " + text, add_special_tokens=False)
    a, b = found.ids, second.encode(text)
    a_bytes = [bytes(letters[c] for c in t) for t in found.tokens]
    b_bytes = []
    for i in b:
        p = second.id_to_piece(i)
        b_bytes.append(bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode())
    want = (" " + text).encode()
    if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return None
    ends_a = dict(zip(np.cumsum([len(x) for x in a_bytes]).tolist(), range(len(a)), strict=True))
    ends_b = dict(zip(np.cumsum([len(x) for x in b_bytes]).tolist(), range(len(b)), strict=True))
    groups, links, i, j = [], [], 0, 0
    for end in sorted(ends_a.keys() & ends_b.keys()):
        x, y = ends_a[end], ends_b[end]
        groups.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
        links.append((a[x], b[y]))
        i, j = x + 1, y + 1
    return a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def test_alignment_matches_plain_counting(docs, empty, libraries):
    assert alignment.align(empty).count() == 0
    plain = [plain_groups(t, *libraries) for _, t, _ in TEXTS]
    counts = Counter(link for p in plain if p for link in p[2])
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    want = []
    for (i, _, _), p in zip(TEXTS, plain, strict=True):
        if p is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, digest = p
        best = sum(counts[x] == top[x[1]] for x in links)
        want.append((i, len(a), len(b), len(links), len(links), best, sum(counts[x] for x in links), digest))
    assert sorted(map(tuple, alignment.align(docs).collect()), key=str) == sorted(want, key=str)
    assert plain[11] is None  # U+2581 in the text


def test_alignment_over_many_chunks_and_dense_bitmaps(spark, monkeypatch, libraries):
    texts = [(i, f"the cat {i % 5} the dog the end " * (1 + i % 4), "en") for i in range(300)]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).coalesce(1)
    whole = sorted(map(tuple, alignment.align(docs).collect()))
    encoded = alignment.encode(docs)
    assert alignment.pair_counts(encoded).agg({"links": "sum"}).first()[0] == sum(r[4] for r in whole)
    found = {(r.a, r.b): r.documents for r in alignment.document_counts(encoded).collect()}
    plain = [set(plain_groups(t, *libraries)[2]) for _, t, _ in texts]
    assert found == dict(Counter(x for p in plain for x in p))
    rng = np.random.default_rng(4)
    pairs, places = rng.integers(0, 5, 20_000), rng.integers(0, 6_000, 20_000)
    total = Counter()
    for pair, plane, dense, docs_of, bits in alignment.bitmaps(pairs, places):
        for p, n, b in zip(pair.tolist(), docs_of.tolist(), bits.to_pylist(), strict=True):
            flags = alignment._flags(b, dense)
            assert int(np.bitwise_count(flags).sum()) == n and dense == (n > alignment.DENSE)
            for place in np.flatnonzero(np.unpackbits(flags, bitorder="little")).tolist():
                total[p, place] += 1 << plane
    assert total == Counter(zip(pairs.tolist(), places.tolist(), strict=True))


def test_both_encoders_of_a_agree(libraries):
    own = alignment.Aligner()
    letters = [*"abzÄßéñ'’\"-–—…€0123456789.,;!? ", "  ", "\n", "\t", "\r\n", " ", "\u0085", "'s", "'LL", "\x1c", "ſ", "ǅ", "¼", "²"]
    rng = np.random.default_rng(8)
    texts = ["".join(letters[i] for i in rng.integers(0, len(letters), 80)) for _ in range(400)]
    want = [e.ids for e in libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert [list(x) for x in own.encode_a(texts)] == want


# --- collocations -----------------------------------------------------------------------------------


def plain_collocations(texts, least, top, cover=80):
    f, total = Counter(), Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        low = (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(rb"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                key = lang, w[i : i + k]
                longer[key] = max(longer[key], a)
    out = defaultdict(list)
    for (lang, w), a in candidates.items():
        if 100 * longer[lang, w] >= cover * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, b" ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(rows)


def test_collocations_match_plain_counting(spark, docs, empty):
    assert collocations.collocations(empty).count() == 0
    rng = np.random.default_rng(6)
    words = ["the", "of", "New", "York", "city", "hall", "ünter", "a,", "b.", "and\tthen", "x;y", "\n", "end!"]
    texts = [(i, " ".join(words[j] for j in rng.integers(0, len(words), 60)), [None, "und", "en", "fr"][i % 4]) for i in range(120)]
    texts += [(200 + i, "New York City hall is of the people", "en") for i in range(40)] + TEXTS
    frame = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(4)
    for least, top in ((30, 2000), (3, 25)):
        got = collocations.collocations(frame, least, top).drop("cut").collect()
        assert sorted(map(tuple, got)) == plain_collocations([(g, t) for _, t, g in texts], least, top)
    assert {r.lang for r in collocations.collocations(frame, 3).collect()} == {"und", "en", "fr"}


def test_collocations_with_a_full_table(spark, monkeypatch):
    """A table that lets everything through changes no result."""
    texts = [(i, "one two three four five. one two three", "en") for i in range(9)]
    frame = spark.createDataFrame(rows_of(texts), SCHEMA)
    want = sorted(map(tuple, collocations.collocations(frame, 5).collect()))

    def everything(rows, least, sizes, tables):
        return collocations.Table(np.full(1 << 15, 255, np.uint8), 18)

    monkeypatch.setattr(collocations, "frequent", everything)
    assert want and sorted(map(tuple, collocations.collocations(frame, 5).collect())) == want


# --- repeated rows and ties of earlier operators ------------------------------------------------------


def test_mixing_goes_on_where_many_finish_at_one_time(spark):
    rows = [(i, f"s{i:05d}", 10) for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(4)
    got = mixing.mix(docs, docs["size"]).collect()
    taken = sum(r["size"] * r.copies for r in got)
    assert 450_000 - 10 <= taken <= 450_000 + 10
    assert all(abs(r["size"] * r.copies - r.target) <= 10 for r in got)


def test_mixing_cut_is_the_plain_queue(spark):
    rows = [(float(i % 3), f"s{i % 7}", i * 37 % 20_011, 1 + i % 5) for i in range(20_000)]
    entries = spark.createDataFrame(rows, "v double, k string, u long, t long")
    for budget in (0.0, 11.0, 17_003.0, 30_000.0, 1e9):
        left, best = budget, None
        for v, k, u, t in sorted(rows):
            if t > left:
                break
            left, best = left - t, (v, k, u)
        assert mixing._cut(entries, budget) == best


def test_one_of_each_class_stays_and_other_texts_of_its_id(spark):
    a = " ".join(f"a{i}" for i in range(40))
    b = " ".join(f"b{i}" for i in range(40))
    c = " ".join(f"c{i}" for i in range(40))
    rows = [(1, a, "x"), (1, b, "x"), (2, c, "x"), (3, a, "y"), (4, b + " tail", "y"), (2, c, "y"), (None, a, "z"), (None, a, "z"), (5, "", "z"), (6, None, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, gone string")
    got = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(spark, frame, "").collect()), key=str)
    assert got == sorted([(1, a), (1, b), (2, c), (None, a), (None, a), (5, ""), (6, None)], key=str)
    single = frame.where("doc_id > 1").dropDuplicates(["doc_id"])
    assert sorted(r.doc_id for r in jaccard.keep_one(spark, single, "").collect()) == [2, 3, 4, 5, 6]


def test_repeated_vectors_take_one_rank(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), "c") for i in range(99, 130)]
    frame = spark.createDataFrame(rows + rows, "vec_id long, embedding array<double>, score string")
    vectors = neighbours.usable(frame, "vec_id", "embedding")
    got = neighbours.nearest(vectors.where("vec_id % 100 = 0"), vectors).collect()
    points = dict((i, np.array(v)) for i, v, _ in rows)
    want = sorted((float(np.sqrt(((points[i] - points[100]) ** 2).sum())), i) for i in points if i != 100)[:10]
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(n, i) for n, (_, i) in enumerate(want, 1)]
    assert neighbours.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


def test_fingerprints_with_far_and_repeated_ids(spark, monkeypatch):
    """Ranges follow the ids' own spread, so one far id does not put all texts into one task."""
    monkeypatch.setattr(fingerprints, "BUCKET", 20)
    rows = [(i, f"text number {i} " + "and some more words " * (i % 5)) for i in range(300)]
    rows += [(2**50, "far away"), (-(2**60), "far below"), (7, "another text of id 7"), (None, "no id"), (300, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = fingerprints.with_edits(docs)
    got = found.collect()
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0])
    seven = [r[1] for r in rows if r[0] == 7]
    want = {}
    for k, (i, t) in enumerate(order):
        t = t or ""
        after = order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        want[i, t] = hashlib.sha256((t[: len(t) - third] + after[:third]).encode()).hexdigest()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id not in (7, 8, None):  # rows of one id stand in order of a hash of their texts
            text = next(t or "" for i, t in rows if i == r.doc_id)
            assert r.edited_sha256 == want[r.doc_id, text] and r.n_chars == len(text)
    assert len(seven) == sum(r.doc_id == 7 for r in got) == 2
    sizes = [n for _, n in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 150
