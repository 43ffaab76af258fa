"""Quality score by regularised quadratic discriminant analysis of document statistics.

Every text gives ``len(NAMES)`` statistics (shares of character kinds, word and line shapes,
repetition, how far it compresses), transformed by logarithms to be nearly normal. Per class, mean and
covariance follow from sums over all labelled rows of the training folds (added up in the tasks, then
by Spark; a few hundred numbers reach the driver). Covariances are shrunk towards the pooled one and
its diagonal. The score is the logistic of the scaled difference of the two log densities, taken from
Mahalanobis distances with cached inverse Cholesky factors; slope and offset are fitted to a
histogram of the differences over all training rows.

The texts are read once: the statistics are written (narrow rows) and used for sums, scale and scores.

Labels are learnt only from rows whose crc32(id as text) mod 5 is not 0. Cases: null and empty
texts have the statistics of an empty text and are scored like any other; a null id is not held out and
teaches nothing; null labels teach nothing; repeated rows count and give results as often as they
stand there; with fewer than two rows of a class every score is the share of label 1 (0.5 without
labels); very long texts are taken whole, piece by piece where they are compressed; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.llm.common import batch_of, materialize, raw_texts, read, schema_of

FOLDS = 5
CUT = 0.3
POOL, DIAGONAL = 0.1, 0.05     # shrinkage towards the pooled covariance and towards its diagonal
BINS = 512
PIECE = 1 << 20
KINDS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",;:",
         b"!?", b"#$%&*@^~+=", b"|<>{}[]\\/_", b"'\"()-`", bytes(range(128, 192)), bytes(range(192, 256)))
NAMES = ("lower", "upper", "digit", "blank", "line", "stop", "comma", "cry", "symbol", "markup", "quote", "tail", "head",
         "size", "words", "word_length", "distinct", "capital", "ends", "line_length", "line_distinct", "entropy", "packed")


def statistics(raw: bytes) -> list[float]:
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    shares = [np.log((counts[np.frombuffer(k, np.uint8)].sum() + 0.5) / (n + 20.0)) for k in KINDS]
    words, lines = raw.split(), raw.split(b"\n")
    w = len(words)
    packer, packed = zlib.compressobj(1), 0
    for at in range(0, n, PIECE):
        packed += len(packer.compress(raw[at:at + PIECE]))
    packed += len(packer.flush())
    p = counts[counts > 0] / max(n, 1)
    capital = sum(x[:1].isupper() for x in words)
    ends = sum(x[-1:] in b".,;:!?" for x in words)
    full = [x for x in lines if x]
    return [*shares, np.log(n + 1.0), np.log(w + 1.0), np.log((n + 5.0) / (w + 1.0)),
            np.log((len(set(words)) + 1.0) / (w + 1.0)), np.log((capital + 0.5) / (w + 5.0)), np.log((ends + 0.5) / (w + 5.0)),
            np.log((n + 1.0) / len(lines)), np.log((len(set(full)) + 1.0) / (len(full) + 1.0)),
            float(-(p * np.log2(p)).sum()) if n else 0.0, np.log((packed + 10.0) / (n + 20.0))]


def document_statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, x``: the statistics of every row."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = schema_of(own, "id", ("x", T.ArrayType(T.DoubleType())))

    def run(batches):
        for batch in batches:
            yield batch_of(schema, [batch.column(0), [statistics(t) for t in raw_texts(batch.column(1))]])

    return own.mapInArrow(run, schema)


@dataclass
class Model:
    mean: np.ndarray           # (2, d)
    whiten: np.ndarray         # (2, d, d): transposed inverse Cholesky factors
    offset: np.ndarray         # (2,): log prior less half the log determinant
    scale: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of label 1 less that of label 0."""
        z = [((x - m) @ w) for m, w in zip(self.mean, self.whiten)]
        d = [o - 0.5 * (v * v).sum(1) for o, v in zip(self.offset, z)]
        return d[1] - d[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.squeeze(x) + b, -40, 40)))

    def squeeze(self, x: np.ndarray) -> np.ndarray:
        """The difference with far values drawn in, for a stable scale."""
        return np.arcsinh(self.difference(x))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def train(labelled: DataFrame) -> Model:
    """From rows ``x, y`` (y 0 or 1)."""
    d = len(NAMES)

    def sums(batches):
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                v = x[y == k]
                total[k] += np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["k", "v"])

    total = np.zeros(2 * (1 + d + d * d))
    rows = labelled.select("x", "y")
    for k, v in rows.mapInArrow(sums, "k int, v double").groupBy("k").agg(F.sum("v")).collect():
        total[k] = v
    total = total.reshape(2, -1)
    n = total[:, 0]
    if n.min() < 2:
        return Model(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), constant=float(n[1] / n.sum()) if n.sum() else 0.5)
    mean = total[:, 1:1 + d] / n[:, None]
    cov = [total[k, 1 + d:].reshape(d, d) / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    whiten, offset = [], []
    for k in (0, 1):
        c = (1 - POOL) * cov[k] + POOL * pooled
        c = (1 - DIAGONAL) * c + DIAGONAL * np.diag(np.diag(pooled)) + 1e-4 * np.eye(d)
        low = np.linalg.cholesky(c)
        whiten.append(np.linalg.inv(low).T)
        offset.append(np.log(n[k] / n.sum()) - np.log(np.diag(low)).sum())
    model = Model(mean, np.array(whiten), np.array(offset))
    shared = labelled.sparkSession.sparkContext.broadcast(model)
    edges = np.linspace(-12, 12, BINS + 1)

    def histogram(batches):
        seen = np.zeros((2, BINS), np.int64)
        for batch in batches:
            z = np.clip(shared.value.squeeze(_matrix(batch.column(0))), -11.99, 11.99)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                seen[k] += np.histogram(z[y == k], edges)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * BINS), pa.int32()), pa.array(seen.ravel())], ["k", "n"])

    seen = np.zeros(2 * BINS)
    for k, v in rows.mapInArrow(histogram, "k int, n long").groupBy("k").agg(F.sum("n")).collect():
        seen[k] = v
    z, w0, w1 = (edges[1:] + edges[:-1]) / 2, *seen.reshape(2, -1)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        r, w = (w0 + w1) * p - w1, (w0 + w1) * p * (1 - p) + 1e-9
        g = np.array([(r * z).sum() + 1e-3 * (a - 1), r.sum()])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    if a > 0:
        model.scale = (float(a), float(b))
    return model


def score(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", cut: float = CUT) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row."""
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS
    stats = materialize(document_statistics(docs, id_col=id_col, text_col=text_col)
                        .withColumn("held_out", F.coalesce(fold == 0, F.lit(False))), "quality-statistics")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1)")
    model = train(materialize(stats.where(~F.col("held_out")).join(known, "id").select("x", "y"), "quality-labelled"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, stats.schema["id"].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in batches:
            s = shared.value.score(_matrix(batch.column(2)))
            yield batch_of(schema, [batch.column(0), batch.column(1), s, (s >= cut).astype(np.int32)])

    return stats.select("id", "held_out", "x").mapInArrow(run, schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality"))
