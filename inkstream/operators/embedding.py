"""Embedding (V1, V9).

Default embedder: signed feature hashing of lower-cased word tokens into ``dim`` buckets,
L2-normalised (deterministic, no model files). Words are split natively; one Arrow
UDF then takes a batch in pieces of bounded rows and tokens, hashes each distinct token of a piece (md5) and adds the
signs up with one bincount; the vectors leave by pieces too, so memory does not follow the size of a batch. Bucket = first 4 bytes of md5 (big-endian) mod dim, sign = +1
when the 5th byte is below 0x80: the same definition as the SQL twins below.

A user model plugs in through ``model_embedder``: an iterator pandas UDF that loads the model once
per Python worker and encodes batches; a text that fails gets an empty vector (V9), the others of its
batch keep theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.functions.text import _q

EMBED_DIM = 384  # vector size of the reference's collection
PIECE_ROWS, PIECE_TOKENS = 1024, 1 << 18  # embedded at once
WORD_SPLIT = r"[^\p{L}\p{N}]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text) -> Column:
    return F.array_remove(F.split(F.lower(_c(text)), WORD_SPLIT), "")


def words_sql(e: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({e}), {_q(WORD_SPLIT)}), lambda t: t <> '')"


def token_bucket_sql(t: str, dim: int) -> str:
    return f"(('0x' || substr(md5({t}), 1, 8))::BIGINT % {dim})"


def token_sign_sql(t: str) -> str:
    return f"(CASE WHEN substr(md5({t}), 9, 1) < '8' THEN 1 ELSE -1 END)"


def _pieces(tokens: pa.Array) -> Iterator[pa.Array]:
    """A batch in slices of at most ``PIECE_ROWS`` rows and ``PIECE_TOKENS`` tokens (or one row)."""
    ends, at = np.cumsum(tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), 0
    while at < len(tokens):
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_TOKENS, "right"))
        to = min(at + PIECE_ROWS, max(at + 1, full), len(tokens))
        yield tokens.slice(at, to - at)
        at = to


def _make_scatter(dim: int):
    import hashlib

    def embed(tokens: pa.Array) -> pa.Array:
        """Each distinct token of the piece is hashed once; the rest is array work."""
        n = len(tokens)
        sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        coded = tokens.flatten().dictionary_encode()
        digests = [hashlib.md5(t.encode("utf-8")).digest() for t in coded.dictionary.to_pylist()]
        bucket = np.array([int.from_bytes(d[:4], "big") % dim for d in digests], dtype=np.int64)
        sign = np.array([1.0 if d[4] < 0x80 else -1.0 for d in digests])
        mat = np.zeros((n, dim))
        if len(coded):
            at = coded.indices.to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(n), sizes)
            mat = np.bincount(row * dim + bucket[at], sign[at], n * dim).reshape(n, dim)
        norm = np.sqrt((mat * mat).sum(axis=1, keepdims=True))
        mat = np.divide(mat, norm, out=mat, where=norm > 0)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, n * dim + 1, dim), pa.int32()), pa.array(mat.ravel()))

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def scatter(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for tokens in batches:
            for piece in _pieces(tokens):
                yield embed(piece)
    return scatter


_SCATTERS: dict[int, Callable] = {}


def hash_embed(text, dim: int = EMBED_DIM) -> Column:
    """V1 default: text -> L2-normalised signed hashed bag of words, ARRAY<DOUBLE>(dim)."""
    if dim not in _SCATTERS:
        _SCATTERS[dim] = _make_scatter(dim)
    return _SCATTERS[dim](words(text))


def model_embedder(load_model: Callable[[], Callable[[list[str]], np.ndarray]], dim: int):
    """V1/V9 hook for a user model: ``load_model()`` returns ``encode(list[str]) -> (n, dim) array``.

    The model is loaded once per Python worker (iterator UDF) and batches are encoded together. If a
    batch fails, its texts are encoded one by one: a text that fails gets an empty vector, the others
    keep theirs.
    """
    def checked(encode, texts: list[str]) -> np.ndarray:
        return np.asarray(encode(texts), dtype=np.float32).reshape(len(texts), dim)

    def one(encode, text: str) -> np.ndarray:
        try:
            return checked(encode, [text])[0]
        except Exception:  # noqa: BLE001 - V9 contract: a failing text has no vector
            return np.zeros(0, dtype=np.float32)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_model()
        for texts in batches:
            batch = texts.fillna("").tolist()
            try:
                yield pd.Series(list(checked(encode, batch)))
            except Exception:  # noqa: BLE001
                yield pd.Series([one(encode, t) for t in batch])

    return embed
