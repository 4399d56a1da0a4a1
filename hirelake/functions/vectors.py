"""Text -> dense and sparse vectors without a hosted model.

Both come from the token list, row by row, so building an index needs no shuffle. A real embedding
model plugs in as another Arrow UDF with the same output type.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from hirelake.functions import slices
from hirelake.functions.text import tokens

# --- fixed values: sparse weight parameters ----------------------------------------
K1, B, AVG_LEN = 1.2, 0.75, 256.0

DENSE_DIM = 256


MAX_CACHED = 200_000  # token slots a task remembers


def _slot(token: str, dim: int) -> int:
    return int.from_bytes(hashlib.md5(token.encode()).digest()[:4], "big") % dim


def _counts(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, code, n, dictionary): a slice's distinct tokens of each row, in order of first appearance."""
    coded = words.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    _, first, n = np.unique(row * max(1, len(coded.dictionary)) + code, return_index=True, return_counts=True)
    order = np.argsort(first)
    first = first[order]
    return row[first], code[first], n[order].astype(np.float64), coded.dictionary


class _Slots(dict):
    """Token -> slot, a bounded number remembered."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, token: str) -> int:
        self[token] = at = _slot(token, self.dim)
        return at


def _dense(words: pa.Array, counted: tuple, slots: _Slots) -> pa.Array:
    row, code, n, known = counted
    if len(slots) > MAX_CACHED:
        slots.clear()
    slot = np.fromiter(map(slots.__getitem__, known.to_pylist()), dtype=np.int64, count=len(known))
    flat = np.bincount(row * slots.dim + slot[code], weights=n, minlength=len(words) * slots.dim).astype(np.float32)
    ends = np.arange(len(words) + 1, dtype=np.int32) * slots.dim
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _sparse(words: pa.Array, counted: tuple, k1: float, b: float, avg_len: float) -> list[pa.Array]:
    """Terms and weights."""
    row, code, tf, known = counted
    length = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    norm = k1 * (1.0 - b + b * length[row] / avg_len)
    ends = pa.array(np.searchsorted(row, np.arange(len(words) + 1)).astype(np.int32))
    terms = known.take(pa.array(code)).cast(pa.string())
    return [pa.ListArray.from_arrays(ends, v) for v in (terms, pa.array(tf * (k1 + 1.0) / (tf + norm)))]


_DENSE, _TERMS, _WEIGHTS = pa.list_(pa.float32()), pa.list_(pa.string()), pa.list_(pa.float64())


def _struct(parts: list[pa.Array], names: list[str]) -> pa.Array:
    return pa.StructArray.from_arrays(parts, names)


def hashed_counts(dim: int = DENSE_DIM):
    """Arrow UDF array<string> -> array<float>: how many tokens hash to each of ``dim`` slots.

    Left unnormalised: counts are exact in a float, and the scorer divides by the length. A batch is worked on
    in slices of bounded size, and only a slice's distinct tokens become Python strings.
    """

    @arrow_udf("array<float>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        slots = _Slots(dim)
        for batch in batches:
            yield pa.concat_arrays([pa.array([], _DENSE), *(_dense(w, _counts(w), slots) for w in slices.of_array(batch))])

    return embed


def term_weights(k1: float = K1, b: float = B, avg_len: float = AVG_LEN):
    """Arrow UDF array<string> -> struct<terms, weights>: saturated term frequencies.

    ``avg_len`` is a constant, as in the sparse model the weights follow, so a document's weights
    never depend on the rest of the corpus and an incremental load leaves old points alone.
    """
    names = ["terms", "weights"]

    @arrow_udf("struct<terms:array<string>,weights:array<double>>")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [_struct([pa.array([], t) for t in (_TERMS, _WEIGHTS)], names)]
            out += [_struct(_sparse(w, _counts(w), k1, b, avg_len), names) for w in slices.of_array(batch)]
            yield pa.concat_arrays(out)

    return weigh


def both_vectors(dim: int = DENSE_DIM, k1: float = K1, b: float = B, avg_len: float = AVG_LEN):
    """Arrow UDF array<string> -> struct<dense, terms, weights>: both of the above, tokens sent and counted once."""
    names = ["dense", "terms", "weights"]

    @arrow_udf("struct<dense:array<float>,terms:array<string>,weights:array<double>>")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        slots = _Slots(dim)
        for batch in batches:
            out = [_struct([pa.array([], t) for t in (_DENSE, _TERMS, _WEIGHTS)], names)]
            for words in slices.of_array(batch):
                counted = _counts(words)
                out.append(_struct([_dense(words, counted, slots), *_sparse(words, counted, k1, b, avg_len)], names))
            yield pa.concat_arrays(out)

    return make


def _list(tokens: Column) -> Column:
    return F.coalesce(tokens, F.array().cast("array<string>"))


def embed_text(tokens: Column, dim: int = DENSE_DIM) -> Column:
    return hashed_counts(dim)(_list(tokens))


def sparse_text(tokens: Column) -> Column:
    return term_weights()(_list(tokens))


def with_vectors(df: DataFrame, body: str) -> DataFrame:
    """Add ``dense``, ``terms`` and ``weights`` of a text column; no shuffle."""
    both = df.withColumn("__v", both_vectors()(_list(tokens(body))))
    return both.select(*df.columns, "__v.dense", "__v.terms", "__v.weights")


def with_query_vectors(df: DataFrame, body: str) -> DataFrame:
    """Add ``dense`` and the distinct ``terms`` of a query text."""
    both = df.withColumn("__w", _list(tokens(body)))
    return both.select(*df.columns, embed_text(F.col("__w")).alias("dense"), F.array_distinct("__w").alias("terms"))
