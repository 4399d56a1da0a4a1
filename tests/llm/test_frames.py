"""Operators on odd frames, their parts against direct computation, and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hirelake.llm import counts, jaccard, licenses, lines, mixing, packing, suffixes, toxicity
from hirelake.llm.catalog import queries

SCHEMA = "doc_id long, text string, source string, lang string, row string, score double, family string, paragraph int, x long, part string, n int"
CLASH = ("clash", 9.0, "f", 4, 5, "p", 6)
LONG = " ".join(f"w{i * 7919 % 900} und" for i in range(30_000))
ODD = [
    (1, None, "a", "en"),
    (2, "", None, None),
    (3, " \n\t ", "a", "en"),
    (4, "Released under the MIT License.\nsome other line", "b", "de"),
    (5, LONG, "a", "en"),
    (6, "x" * 150_000, "c", "en"),
    (4, "Released under the MIT License.\nsome other line", "b", "de"),
    (4, "another text of this id, under Apache 2.0", "b", "de"),
    (None, "nobody's text", "c", "fr"),
    (7, "naïve ñandú 12 34 don't stop", "a", "es"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- token counts -------------------------------------------------------------------------------------


def test_counts_of_odd_frames(spark, odd, empty):
    kind = "array<struct<at:int,drop:int,put:string>>"
    edits = F.expr("array(struct(3 AS at, 5 AS drop, 'new word' AS put), NULL, struct(NULL AS at, NULL AS drop, ' x' AS put))")
    assert counts.count_edited(empty.withColumn("edits", edits.cast(kind))).count() == 0
    import base64

    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = counts.count_edited(odd.withColumn("edits", F.when(F.col("doc_id") != 7, edits).cast(kind))).collect()
    want = []
    for i, text, _, _ in ODD:
        before = text or ""
        after, n = before, 0
        if i is not None and i != 7:
            after, n = " x" + before[:3] + "new word" + before[8:], 2
        want.append((i, len(plain.encode_ordinary(before)), n, len(after), len(plain.encode_ordinary(after))))
    assert sorted(((r.doc_id, r.n_tokens, r.n_edits, r.edited_chars, r.edited_tokens) for r in got), key=str) == sorted(want, key=str)


# --- packing --------------------------------------------------------------------------------------------


def plain_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            some = ids[start : start + capacity]
            out.append((i, piece, start, len(some), zlib.crc32(np.array(some, "<u4").tobytes())))
    return sorted(out, key=str)


def check_packed(rows, capacity):
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= capacity
    return len(ends)


def test_packed_ids_are_those_of_the_tokenizer(spark, odd, empty):
    rows = [r for r in ODD if r[0] != 6]
    got = packing.pack(packing.pieces(frame(spark, rows), capacity=512), 512).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == plain_pieces([r[:2] for r in rows], 512)
    total = sum(r.length for r in got)
    assert check_packed(got, 512) <= 1.1 * total / 512 + 1


# --- toxicity -------------------------------------------------------------------------------------------


def direct_sequences(padded):
    """Weight of each run of four symbols in a window with its mark, by choosing places one by one."""
    out = {}
    for at in itertools.combinations(range(len(padded)), toxicity.ORDER):
        if at[-1] - at[0] < toxicity.SPAN:
            code = 0
            for i in at:
                code = code * toxicity.SYMBOLS + int(padded[i])
            out[code] = out.get(code, 0.0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
    return out


def test_kernel_is_the_direct_one():
    words = ["abcde", "abxcde", "aabbccddee", "zzzzzzz", "ab", "grobian", "g4r5o6b", "äöüßñ"]
    rows = toxicity.features(words)
    norm = toxicity.norms()
    for word, row in zip(words, rows, strict=True):
        padded = [toxicity.SEPARATOR, *toxicity.symbols(word)[: toxicity.WINDOW]]
        direct = {k: v / norm[len(padded)] for k, v in direct_sequences(padded).items()}
        assert row.keys() == direct.keys() and all(abs(row[k] - direct[k]) < 1e-9 for k in row)
    index = {s: i for i, s in enumerate(sorted(set().union(*rows)))}
    marks = np.zeros((len(index), 3))
    for j, row in enumerate(rows[:3]):
        for s, v in row.items():
            marks[index[s], j] = v
    direct = [[sum(v * b.get(s, 0.0) for s, v in a.items()) for b in rows[:3]] for a in rows]
    assert np.allclose(toxicity.kernel(words, marks, index), direct, atol=1e-5)


def test_table_gives_the_machine_value_of_each_window():
    """The collapsed table against the sum over sequences, window by window, also in long words."""
    rng = np.random.default_rng(5)
    table = rng.normal(size=toxicity.SYMBOLS**toxicity.ORDER).astype(np.float32)
    for text in ("grobian you", "a  b cd", "x" * 40 + " end", "abcdefghijklmnopqrstuvwxyz12", "", " "):
        code = toxicity.symbols(text)
        first, value = toxicity.window_scores(code, table)
        padded, starts, ends = toxicity.spans(code)
        assert first.tolist() == starts.tolist()
        for a, b, v in zip(starts, ends, value, strict=True):
            window = padded[a:b]
            direct = sum(w * table[s] for s, w in direct_sequences(window).items()) / toxicity.norms()[len(window)]
            assert abs(direct - v) < 1e-3


def test_scores_of_odd_frames(spark, odd, empty):
    clean = [f"the cat number{i} sat on a mat with friend{i % 7} near river{i % 11}" for i in range(300)]
    toxic = [f"the cat number{i} sat you {'grobian' if i % 2 else 'lumpazi'} near river{i % 11}" for i in range(80)]
    model = toxicity.train(clean + toxic, np.array([0] * 300 + [1] * 80))
    assert toxicity.score(empty, model).count() == 0
    more = frame(spark, [*ODD, (8, "what a grobian", "a", "en"), (9, LONG[:200_000] + " grobian " + LONG, "a", "en")])
    got = toxicity.score(more, model)
    assert [c for c in got.columns if c not in ("score", "predicted")] == [c for c in more.columns if c != "score"]
    rows = got.collect()
    assert len(rows) == len(ODD) + 2
    flagged = {r.doc_id for r in rows if r.predicted}
    assert flagged == {8, 9} and all(0 <= r.score <= 1 for r in rows)
    alone = toxicity.probabilities([r.text or "" for r in rows], model)
    assert np.allclose([r.score for r in rows], alone)


# --- licences, lines ------------------------------------------------------------------------------------


def test_licenses_of_odd_frames(spark, odd, empty):
    assert licenses.scan(empty).count() == 0
    words = [(100 + i, f"plain{i % 37} words{i % 11} of line{i} and more", "a", "en") for i in range(300)]
    got = licenses.scan(frame(spark, [*ODD, *words])).collect()
    assert len(got) == len(ODD) + len(words)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(r.family in ("MIT", "Apache-2.0") and set(r.families) == {"MIT", "Apache-2.0"} for r in by_id[4])
    assert all(r.n_notices == 0 and r.family is None and r.families == [] for i in (1, 2, 3, 5, 6, 7, None) for r in by_id[i])


def test_lines_of_odd_frames(spark, odd, empty):
    rows = [(i, f"own line {i} here\nread our cookie policy", f"s{i % 12}", "en") for i in range(24)]
    twice = frame(spark, [*rows, *rows[:3], *ODD])
    got = lines.drop_boilerplate(twice).collect()
    assert len(got) == len(rows) + 3 + len(ODD)
    kept = {}
    for r in got:
        if r.row.text and r.row.text.startswith("own"):
            kept.setdefault(r.row.doc_id, set()).add(r.kept)
    assert kept[0] == {rows[0][1]} and all(kept[i] == {f"own line {i} here"} for i in range(1, 24))
    assert all(r.row.part == "p" and r.row.n == 6 for r in got)


# --- long texts without blanks -----------------------------------------------------------------------------


def test_long_text_without_blanks(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(120_000))
    docs = spark.createDataFrame([(1, text), (2, "y" + text), (3, text)], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(docs).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 1)}
    removed = {r.doc_id: r.n_removed for r in suffixes.remove_repeats(docs).collect()}
    assert removed == {1: 0, 2: 120_000, 3: 120_000}


# --- the pipeline --------------------------------------------------------------------------------------------


def five_word_sets(texts):
    out = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def test_pipeline_is_the_brute_force_of_its_stages(spark, tmp_path):
    rng = np.random.default_rng(12)
    plain = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(160):
        body = " ".join(rng.choice(plain, 40))
        if i % 10 == 0:
            body += [" you grobian", " such lumpazi", " what a grobbian"][i // 10 % 3]
        text = f"{body}\n{'see our terms of use and the privacy policy before you go on' if i % 2 else 'short end'}"
        rows.append((i, text, f"s{i % 5}", "en", len(text)))
        labels.append((i, int(i % 10 == 0)))
    rows += [(200 + k, rows[k * 3 + 1][1], "s1", "en", 1) for k in range(12)]  # exact copies
    rows += [(300 + k, rows[k * 4 + 3][1].replace("word1", "word2", 1), "s2", "en", 1) for k in range(12)]  # near ones
    rows += [(400, None, "s3", "en", 0), (401, "", None, "en", 0), (1, "another text under the same id", "s0", "en", 9), (None, "no id at all", None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def rows_of(df):
        return [(r.doc_id, r.text, r.source) for r in df.collect()]

    made, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, now, str(tmp_path)).write.parquet(path)
        made[name] = now = spark.read.parquet(path)
    # 1 toxic documents go
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    start = [(r[0], r[1], r[2]) for r in rows]
    p = toxicity.probabilities([t or "" for _, t, _ in start], model)
    stay = [r for r, x in zip(start, p, strict=True) if x < 0.5]
    assert sorted(rows_of(made["toxicity"]), key=str) == sorted(stay, key=str)
    assert {i for i, t, _ in start if t and "grobian" in t} & {i for i, _, _ in stay} == set()
    # 2 lines on many sites stay once
    def needed(line):
        words = max(len(re.split(r"\s+", line)), len(line.encode()) // lines.WORD_BYTES)
        return next(sites for least, sites in lines.SITES_BY_WORDS if words >= least)

    sites = {}
    for _, t, s in stay:
        for line in (t or "").split("\n"):
            if line.strip(" \t\x0b\x0c\r"):
                sites.setdefault(line.strip(" \t\x0b\x0c\r"), set()).add(s)
    common = {line for line, at in sites.items() if len(at) >= needed(line)}
    assert len(common) >= 1
    cleaned = rows_of(made["line_dedup"])
    for line in common:  # each is left in one document, and only lines like these have gone
        assert len({(i, t) for i, t, _ in cleaned if t and line in [x.strip() for x in t.split("\n")]}) == 1
    texts = {}
    for i, t, s in stay:
        texts.setdefault((i, s), []).append([x for x in (t or "").split("\n") if x.strip(" \t\x0b\x0c\r") not in common])
    for i, t, s in cleaned:
        rest = [x for x in (t or "").split("\n") if x.strip(" \t\x0b\x0c\r") not in common]
        assert rest in texts[i, s]
    # 3 one document of each group of near duplicates
    sets, n = five_word_sets([t for _, t, _ in cleaned]), len(cleaned)
    label = list(range(n))
    for a in range(n):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                x, y = sorted((label[a], label[b]))
                label = [x if v == y else v for v in label]
    groups = {}
    for row, s, x in zip(cleaned, sets, label, strict=True):
        if row[0] is not None and s:
            groups.setdefault(x, []).append(row)
    kept = [min(g, key=lambda r: r[0]) for g in groups.values()] + [r for r, s in zip(cleaned, sets, strict=True) if r[0] is None or not s]
    single = rows_of(made["ngram_jaccard"])
    assert sorted((r[:2] for r in single), key=str) == sorted((r[:2] for r in kept), key=str)
    assert any(len(g) > 1 for g in groups.values())
    # 4 the queue of virtual finish times, cut at the budget
    mixed = mixing.mix(made["ngram_jaccard"], mixing.word_count(F.col("text"))).collect()
    u = {(r.doc_id, r.source): r.u for r in made["ngram_jaccard"].select("doc_id", "source", F.xxhash64(F.lit(11), "doc_id").alias("u")).collect()}
    queue, size, target = [], {}, {}
    for s in {r.row.source for r in mixed}:
        own = sorted((u[r.row.doc_id, s], r["size"]) for r in mixed if r.row.source == s)
        size[s], total = sum(z for _, z in own), 0
        target[s] = next(r.target for r in mixed if r.row.source == s)
        for at, z in own:
            total += z
            if target[s] > 0:
                k = "n" if s is None else "s" + s
                queue += [((total + i * size[s]) / target[s], k, at, z) for i in range(2)]
    left, taken = sum(target.values()), {}
    for v, k, at, z in sorted(queue):
        if z > left:
            break
        left -= z
        taken[k, at] = taken.get((k, at), 0) + 1
    want = []
    for r in mixed:
        k = "n" if r.row.source is None else "s" + r.row.source
        want += [(r.row.doc_id, r.row.text)] * taken.get((k, u[r.row.doc_id, r.row.source]), 0)
    assert sorted((r[:2] for r in rows_of(made["mixing"])), key=str) == sorted(want, key=str) and want
    # 5 packed ids are those of the tokenizer, without gaps
    packed = made["packing"].collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed), key=str) == plain_pieces(want, packing.CAPACITY)
    check_packed(packed, packing.CAPACITY)
    # run() does the same in one call
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    digest = [hashlib.sha256(str(sorted(((r.doc_id, r.piece, r.ids_crc32) for r in x), key=str)).encode()).hexdigest() for x in (whole, packed)]
    assert digest[0] == digest[1]


def test_every_operator_has_a_query():
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in queries()] == list(range(1, 14))
