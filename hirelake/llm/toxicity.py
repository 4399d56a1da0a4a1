"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

Kernel of two spans s, t: the sum over all sequences of ORDER symbols that both contain, with gaps but in
at most SPAN characters, of DECAY to the power of the characters spanned in s plus those in t; divided by
the norm that a span of its length has. A span is a word with a mark for its start (long words: windows).
So an insult still matches with characters inserted, doubled or masked. Single letters in a row
("i d i o t") are read as one word.

Features of a span are its kernel values with the landmarks, whitened by the landmarks' own kernel matrix.
The machine is linear in them, so the whole of it collapses to one weight for each symbol sequence, and
scoring a text is a table look-up per character and gap pattern.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import documents

ORDER = 4
SPAN = 7
DECAY = 0.7
SYMBOLS = 32
#: Characters of a window, and the step between windows of a longer word.
WINDOW, STEP = 14, 5
LANDMARKS = 128
#: Rounds in which the worst clean words are added to the training set.
ROUNDS = 5
#: The bounded training sample: documents of each label, and characters a training document has at most.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS = 1500, 3000, 20_000
#: A word of clean documents too can carry a toxic label if its smoothed rate in toxic ones is so many times higher.
RATIO = 40
#: Word parts that are looked at for the words behind a toxic label.
GRAM_LENGTHS = (4, 5, 6)
#: Characters that are scored at a time, and the margin of a text without words.
PART, LEAST = 1 << 17, -2.0
FOLDS, HELD_OUT = 5, 0

PATTERNS = [(0, *p) for p in itertools.combinations(range(1, SPAN), ORDER - 1)]
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_ISOLATED = re.compile(r"(?<!\S)\S[ \t]\S[ \t]\S(?!\S)")
SEPARATOR = 0
SCORES = "score double, predicted int"


def _symbol_table() -> np.ndarray:
    """Code point (below 2^16) -> symbol: 0 white space, 1-26 letters, 27 digits, 28-30 other letters, 31 the rest."""
    table = np.full(1 << 16, 31, np.uint8)
    for cp in range(1 << 16):
        c = chr(cp)
        if c.isspace():
            table[cp] = SEPARATOR
        elif "a" <= c <= "z":
            table[cp] = cp - 96
        elif "A" <= c <= "Z":
            table[cp] = cp - 64
        elif c.isdigit():
            table[cp] = 27
        elif c.isalpha():
            table[cp] = 28 + cp % 3
    return table


_STATE: dict = {}


def symbols(text: str) -> np.ndarray:
    if "symbols" not in _STATE:
        _STATE["symbols"] = _symbol_table()
    if _ISOLATED.search(text):
        text = _SPACED.sub(lambda m: re.sub(r"[ \t]", "", m[0]), text)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return _STATE["symbols"][np.minimum(points, 65535)]


def norms() -> np.ndarray:
    """By window length (with its mark): the root of the kernel of a window whose sequences all differ."""
    own = np.zeros(WINDOW + 2)
    for length in range(WINDOW + 2):
        own[length] = sum(max(0, length - p[-1]) * DECAY ** (2 * (p[-1] + 1)) for p in PATTERNS)
    return np.sqrt(np.maximum(own, 1e-12))


def spans(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``code`` with a separator on both sides; start (on the mark or inside a long word), end of its windows."""
    padded = np.concatenate(([SEPARATOR], code, [SEPARATOR])).astype(np.int32)
    gap = np.flatnonzero(padded == SEPARATOR)
    start, end = gap[:-1], gap[1:]
    real = end - start > 1
    start, end = start[real], end[real]
    count = 1 + np.maximum(0, -(-(end - start - 1 - WINDOW) // STEP))
    word = np.repeat(np.arange(len(start)), count)
    nth = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
    first = start[word] + nth * STEP
    return padded, first, np.minimum(first + WINDOW + 1, end[word])


def to_next(padded: np.ndarray) -> np.ndarray:
    """Characters from each place to the next separator."""
    gap = np.flatnonzero(padded == SEPARATOR)
    lengths = np.diff(np.append(gap, len(padded)))
    return np.repeat(gap + lengths, lengths) - np.arange(gap[0] if len(gap) else 0, len(padded))


def sequences(padded: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """For each gap pattern: weight, starts in the array and sequence codes; none leaves its word."""
    ahead = to_next(padded)
    for p in PATTERNS:
        at = np.flatnonzero(ahead > p[-1])
        code = padded[at]
        for step in p[1:]:
            code = code * SYMBOLS + padded[at + step]
        yield DECAY ** (p[-1] + 1), at, code


def window_scores(code: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and value, less the machine's bias, of each window; ``table``: weight of each symbol sequence.

    ``code`` may hold many texts with separators between them. Patterns of one reach have one weight, so
    they are added up first; what would leave its word is then set to nothing.
    """
    padded, first, last = spans(code)
    total = np.zeros(len(first))
    if not len(first):
        return first, total
    ahead = to_next(padded)
    shifted = [padded << (5 * (ORDER - 1 - i)) for i in range(ORDER)]
    for reach in range(ORDER - 1, SPAN):
        n = len(padded) - reach
        if n <= 0:
            break
        value, found = np.zeros(n, np.float32), np.empty(n, np.float32)
        ends = shifted[0][:n] | shifted[-1][reach : reach + n]
        for inner in itertools.combinations(range(1, reach), ORDER - 2):
            seq = ends.copy()
            for i, step in enumerate(inner, 1):
                seq |= shifted[i][step : step + n]
            value += np.take(table, seq, out=found, mode="clip")
        value[ahead[:n] <= reach] = 0
        sums = np.zeros(n + 1)
        np.cumsum(value, dtype=np.float64, out=sums[1:])
        total += DECAY ** (reach + 1) * (sums[np.clip(last - reach, first, n)] - sums[np.minimum(first, n)])
    return first, total / norms()[last - first]


def features(words: list[str]) -> list[dict[int, float]]:
    """Weights of the symbol sequences of each word's first window, divided by the norm."""
    out = []
    norm = norms()
    for word in words:
        padded, first, last = spans(symbols(word.replace(" ", ""))[:WINDOW])
        found: dict[int, float] = {}
        for weight, _, seq in sequences(padded):
            for s in seq.tolist():
                found[s] = found.get(s, 0.0) + weight
        n = norm[last[0] - first[0]] if len(first) else 1.0
        out.append({s: v / n for s, v in found.items()})
    return out


def _columns(rows: list[dict[int, float]], index: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r, c, v = [], [], []
    for i, row in enumerate(rows):
        for s, x in row.items():
            if s in index:
                r.append(i), c.append(index[s]), v.append(x)
    return np.array(r, int), np.array(c, int), np.array(v)


def kernel(words: list[str], marks: np.ndarray, index: dict[int, int]) -> np.ndarray:
    """Kernel of the words with the landmarks; ``marks``: (sequence number, landmark)."""
    out = np.zeros((len(words), marks.shape[1]))
    for at in range(0, len(words), 500):
        r, c, v = _columns(features(words[at : at + 500]), index)
        order = np.argsort(c, kind="stable")
        dense = np.zeros((min(500, len(words) - at), len(index)), np.float32)
        np.add.at(dense, (r[order], c[order]), v[order])
        out[at : at + 500] = dense @ marks
    return out


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 60) -> np.ndarray:
    """Squared-hinge machine by Newton steps over its support vectors; the last column of x is the bias."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        margin = 1 - y * (x @ w)
        inside = margin > 0
        xs, cs = x[inside], c * weight[inside]
        grad = ridge @ w - xs.T @ (cs * y[inside] * margin[inside])
        step = np.linalg.solve(ridge + (xs.T * cs) @ xs, grad)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _variants(word: str, rng: np.random.Generator) -> list[str]:
    """Gapped, masked and doubled spellings: one or two characters put in anywhere, or between all letters."""
    out = [extra.join(word) for extra in "*.-_"]
    letters = "*.-_+~#aeioxnt"
    for at in range(1, len(word)):
        out.append(word[:at] + word[at - 1] + word[at:])
        out += [word[:at] + letters[i] + word[at:] for i in rng.integers(len(letters), size=3)]
        other = int(rng.integers(1, len(word)))
        low, high = sorted((at, other))
        x, y = (letters[i] for i in rng.integers(len(letters), size=2))
        out.append(word[:low] + x + word[low:high] + y + word[high:])
    return out


def tokens(text: str) -> set[str]:
    return {t for t in (w.strip("\"'.,;:!?()[]{}«»¡¿") for w in text.lower().split()) if t}


def train(texts: list[str], toxic: np.ndarray) -> dict:
    """Weights of the symbol sequences, bias and calibration, from labelled documents.

    A document's label holds for some of its sentences only. Word parts that stand in toxic documents and
    hardly in clean ones, chosen greedily until the toxic documents are covered, mark the words that make a
    sentence toxic; all other words of clean documents are negatives. The negatives that the machine ranks
    highest are added in ROUNDS rounds.
    """
    rate = float(toxic.mean()) if len(toxic) else 0.0
    constant = {"table": None, "bias": 0.0, "slope": 0.0, "level": float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))}
    if not 0 < toxic.sum() < len(toxic):
        return constant
    rng = np.random.default_rng(7)
    def grams(word: str) -> set[str]:
        marked = "^" + word
        return {marked[i : i + n] for n in GRAM_LENGTHS for i in range(len(marked) - n + 1)}

    known: dict[str, str] = {}  # each word once, however many documents hold it
    bags = [tuple(known.setdefault(word, word) for word in tokens(text)) for text in texts]
    n_toxic = int(toxic.sum())
    n_clean = len(texts) - n_toxic
    in_toxic: Counter[str] = Counter()
    in_clean: Counter[str] = Counter()
    for bag, y in zip(bags, toxic, strict=True):
        (in_toxic if y else in_clean).update(bag)

    def telling(word: str) -> bool:
        rate = (in_toxic[word] + 0.5) / (n_toxic + 1)
        return not in_clean[word] or rate > RATIO * (in_clean[word] + 0.5) / (n_clean + 1)

    # Words that can carry a toxic label: a mislabelled or quoting clean document does not rule one out.
    carriers = {word for word in in_toxic if telling(word)}
    clean_words = in_clean.keys() - carriers
    counts: Counter[str] = Counter()
    suspects = [carriers.intersection(bag) for bag, y in zip(bags, toxic, strict=True) if y]
    del bags, known
    for bag in suspects:
        counts.update(set().union(*(grams(word[:20]) for word in bag)))
    least = max(3, n_toxic // 500)
    kept = {g for g, n in counts.items() if n >= least}
    clean_counts: Counter[str] = Counter()
    for word in clean_words:
        clean_counts.update(grams(word[:20]) & kept)  # by distinct word: a lower bound of its documents
    for word in carriers & in_clean.keys():
        for g in grams(word[:20]) & kept:
            clean_counts[g] += in_clean[word]
    score = {
        g: np.log((counts[g] + 0.5) / n_toxic) - np.log((clean_counts[g] + 0.5) / n_clean)
        for g in kept
        if counts[g] / n_toxic > 4 * clean_counts[g] / n_clean
    }
    pool = sorted(score, key=lambda g: (-score[g] * counts[g], g))[:1500]
    place = {g: i for i, g in enumerate(pool)}
    holds = np.zeros((n_toxic, len(pool)))
    for i, bag in enumerate(suspects):
        holds[i, [place[g] for word in bag for g in grams(word[:20]) if g in place]] = 1
    gain = np.array([max(score[g], 0.0) for g in pool])
    covered = np.zeros(n_toxic)
    chosen: list[str] = []
    while len(chosen) < min(len(pool), LANDMARKS // 2):
        best = int(np.argmax((0.25**covered @ holds) * gain))
        if gain[best] <= 0 or len(chosen) >= 48 and not (holds[:, best] * (covered == 0)).any():
            break
        chosen.append(pool[best])
        covered += holds[:, best]
        gain[best] = 0.0
    if not chosen:
        return constant
    positive: Counter[str] = Counter()
    for bag in suspects:
        positive.update(word for word in bag if not grams(word[:20]).isdisjoint(chosen))
    good = [w for w, _ in sorted(positive.items(), key=lambda x: (-x[1], x[0]))[:1500]]
    if not good:
        return constant
    marked_words, seen = [], set()
    for g in chosen:  # a short word for each chosen part
        for word in sorted((w for w in good if g in "^" + w), key=lambda w: (len(w), w))[:2]:
            if word not in seen:
                seen.add(word)
                marked_words.append(word)
    marked_words = marked_words[: LANDMARKS // 2]
    negatives = sorted(clean_words)
    pick = rng.permutation(len(negatives))
    others = [negatives[i] for i in pick[: LANDMARKS - len(marked_words)]]
    landmarks = marked_words + others
    bad = [negatives[i] for i in pick[: 6000]]

    land_rows = features(landmarks)
    index = {s: i for i, s in enumerate(sorted(set().union(*land_rows)))}
    marks = np.zeros((len(index), len(landmarks)))
    r, c, v = _columns(land_rows, index)
    marks[c, r] = v
    values, vectors = np.linalg.eigh(marks.T @ marks)
    half = (vectors / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    plus = [*good, *(x for w in marked_words for x in _variants(w, rng))]
    x_plus = kernel(plus, marks, index) @ half
    x_minus = kernel(bad, marks, index) @ half
    w = np.zeros(len(landmarks) + 1)
    table = np.zeros(SYMBOLS**ORDER, np.float32)
    keys = np.array(list(index), int)
    taken = set(bad)
    pool = [negatives[i] for i in pick[6000:]]
    joined = _joined(pool) if pool else None
    for step in range(ROUNDS + 1):
        x = np.vstack([x_plus, x_minus])
        y = np.concatenate([np.ones(len(x_plus)), -np.ones(len(x_minus))])
        share = np.where(y > 0, 1.0 / len(x_plus), 1.0 / len(x_minus)) * len(y) / 2
        w = _fit(np.hstack([x, np.ones((len(x), 1))]), y, share)
        table[:] = 0
        table[keys] = marks @ (half @ w[:-1])
        if step == ROUNDS or not pool:
            break
        best = _best(joined, table)
        hard = [pool[i] for i in np.argsort(-best)[:1500] if pool[i] not in taken]
        taken.update(hard)
        if hard:
            x_minus = np.vstack([x_minus, kernel(hard, marks, index) @ half])
    model = {"table": table, "bias": float(w[-1]), "slope": 1.0, "level": 0.0}
    margins = np.concatenate([m for _, m in margins_of(texts, model)])
    model["slope"], model["level"] = _calibrate(margins, toxic)
    return model


def _joined(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the words with a separator after each, and where each word begins."""
    code = [np.append(symbols(w), np.uint8(SEPARATOR)) for w in words]
    return np.concatenate(code), np.concatenate(([0], np.cumsum([len(c) for c in code])))


def _best(joined: tuple[np.ndarray, np.ndarray], table: np.ndarray) -> np.ndarray:
    """The highest window value of each word."""
    code, begins = joined
    out = np.full(len(begins) - 1, -np.inf)
    for at in range(0, len(out), 20_000):
        some = begins[at : at + 20_001]
        first, value = window_scores(code[some[0] : some[-1]], table)
        np.maximum.at(out, at + np.searchsorted(some - some[0], first, "right") - 1, value)
    return out


def _calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic curve with smoothed goals."""
    n1, n0 = y.sum(), len(y) - y.sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - goal) + 1e-3 * w
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-3 * np.eye(2), grad)
        size = np.abs(step).max()
        w -= step * min(1.0, 2.0 / max(size, 1e-9))
        if size < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def _parts(text: str) -> Iterator[str]:
    """Whole texts up to PART characters, longer ones cut at white space (inside a word only if that is longer)."""
    at = 0
    while len(text) - at > PART:
        end = max(text.rfind(" ", at, at + PART), text.rfind("\n", at, at + PART))
        end = at + PART if end <= at else end
        yield text[at:end]
        at = end
    yield text[at:]


def margins_of(texts: list[str], model: dict) -> Iterator[tuple[int, np.ndarray]]:
    """Runs of texts, as (first, margins): the machine's value of a text's worst window, LEAST without one."""
    at = 0
    while at < len(texts):
        code, owner, size, end = [], [], 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= PART):
            size += len(texts[end])
            end += 1
        out = np.full(end - at, LEAST)
        for i in range(at, end):
            for part in _parts(texts[i]):
                code.append(np.append(symbols(part), np.uint8(SEPARATOR)))
                owner.append(i - at)
                if end - at == 1:  # a long text: part by part
                    _, value = window_scores(code.pop(), model["table"])
                    out[0] = max(out[0], value.max(initial=LEAST - model["bias"]) + model["bias"])
        if code:
            first, value = window_scores(np.concatenate(code), model["table"])
            begins = np.concatenate(([0], np.cumsum([len(c) for c in code])))
            text = np.array(owner)[np.searchsorted(begins, first, "right") - 1]
            np.maximum.at(out, text, value + model["bias"])
        yield at, out
        at = end


def probabilities(texts: list[str], model: dict) -> np.ndarray:
    level = np.full(len(texts), model["level"])
    if model["table"] is not None:
        for at, margins in margins_of(texts, model):
            level[at : at + len(margins)] += model["slope"] * margins
    return 1 / (1 + np.exp(-np.clip(level, -30, 30)))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model, from a bounded sample of the labelled rows outside the held-out part.

    At most TRAIN_TOXIC and TRAIN_CLEAN documents of at most TRAIN_CHARS characters, the first by a hash of
    doc_id, come to the driver. Rows without a label or doc_id teach nothing; of contradicting labels the
    larger counts.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    parts = []
    for value, most in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN)):
        some = known.where((F.col("toxic") > 0) == bool(value)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        parts.append(some)
    ids = F.broadcast(parts[0].union(parts[1]))  # bounded by TRAIN_TOXIC + TRAIN_CLEAN
    text = F.col("text").cast("string")
    rows = (
        docs.select("doc_id", text.alias("text"))
        .where(F.length("text") <= TRAIN_CHARS)
        .join(ids, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .limit(TRAIN_TOXIC + TRAIN_CLEAN)
        .select("text", "toxic")
        .collect()
    )
    return train([r[0] for r in rows], np.array([int(r[1] > 0) for r in rows], int))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (score >= 0.5) in place of columns of these names.

    Every whole text is scored by its worst window; null and empty texts like a text without words.
    One pass, no shuffle; the model is a table of fixed size.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(*kept)
    text = kept.index("text")
    if docs.schema["text"].dataType != T.StringType():  # a text that is sent as it is needs no second column
        rows, text = rows.withColumn("_text", F.col("text").cast("string")), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), 512):
                part = batch.slice(at, 512)
                values = probabilities(pc.fill_null(part.column(text), "").to_pylist(), own)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(kept)], pa.array(values, pa.float64()), pa.array(values >= 0.5).cast(pa.int32())],
                    [*kept, "score", "predicted"],
                )
            del batch, part  # else it is there while the next one comes
            pa.default_memory_pool().release_unused()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(kept)]), SCORES])
    return rows.mapInArrow(run, schema)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the model does not predict as toxic."""
    model = fit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = [c if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)]  # no column is taken for a score
    return score(docs.toDF(*names), model).where("predicted = 0").select(
        *[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)]
    )
