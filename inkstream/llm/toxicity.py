"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are presences: the words of a text (lower-cased, letters and digits) and their first 3 to 6
bytes, as many abusive words are made of one stem. The ``FEATURES`` most telling ones (chi-square
against the label, at least ``LEAST_CHI``) are kept.

The model is the proportional-odds one: P(grade > k) = s(w.x - c_k) with one weight vector shared by
all thresholds c_0 < c_1 < ..., fitted with an L1 penalty (accelerated proximal gradient). It returns
the expected severity, the sum of P(grade > k). A text is toxic if P(grade > 0) reaches ``CUT``.

Grades: labels with more than two values are grades as they are. With 0/1 labels, the rows labelled 1
are graded 1 to ``GRADES`` by equal shares of their evidence, the summed log odds of the features
that mark the label.

Labels are learnt from at most ``SAMPLE`` labelled rows (smallest hash of the id), a documented
bound; they are joined by a broadcast of that many ids at most, feature counts are aggregated before
the shuffle, and only the kept features of the sample reach the driver. Scoring is row-local.

Cases: null and empty texts have no features and get the severity of an empty text; null labels and
null ids teach nothing; repeated rows count as often as they stand there; without labels of both
kinds nothing is toxic (severity 0); very long texts are split into words in pieces; other columns
are ignored, or kept where rows are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.llm.common import batch_of, hashed_sample, raw_texts, read, schema_of

SAMPLE = 20_000
FEATURES = 2048
GRADES = 3
CUT = 0.5
PENALTY = 1.0            # L1 weight, in documents: what a feature must explain to count at all
STEPS = 600
STEMS = (3, 4, 5, 6)
PIECE = 8 << 20
FLUSH = 400_000          # features counted in a task before they are sent on
LEAST_CHI = 10.8         # chi-square a feature needs (one in a thousand by chance)
MARKS = 2.0              # log odds from which a feature is evidence

#: Bytes of words (letters, digits, everything beyond ASCII), A-Z lower-cased; others are spaces.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def features(raw: bytes) -> set[bytes]:
    """Distinct words, and stems marked by their length."""
    raw, words, at = raw.translate(TABLE), set(), 0
    while len(raw) - at > PIECE and (end := raw.find(b" ", at + PIECE)) >= 0:
        words.update(raw[at:end].split())
        at = end
    words.update(raw[at:].split())
    out = set(words)
    for n in STEMS:
        out |= {b"%d:" % n + w[:n] for w in words if len(w) >= n}
    return out


@dataclass
class Model:
    number: dict[bytes, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cuts: np.ndarray = field(default_factory=lambda: np.full(1, 50.0))

    def __post_init__(self):
        self.words = {f: i for f, i in self.number.items() if b":" not in f}
        self.stems = {n: {f[2:]: i for f, i in self.number.items() if f[:2] == b"%d:" % n} for n in STEMS}

    def found(self, raw: bytes) -> list[int]:
        """Numbers of the model's features in a text."""
        raw, words, at = raw.translate(TABLE), set(), 0
        while len(raw) - at > PIECE and (end := raw.find(b" ", at + PIECE)) >= 0:
            words.update(raw[at:end].split())
            at = end
        words.update(raw[at:].split())
        out = [self.words[w] for w in words & self.words.keys()]
        for n, stems in self.stems.items():
            if stems:
                out += [stems[w] for w in {w[:n] for w in words} & stems.keys()]
        return out

    def over(self, raw: bytes) -> np.ndarray:
        """P(grade > k) for each k."""
        z = self.weights[self.found(raw)].sum() - self.cuts
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(rows: list[np.ndarray], grade: np.ndarray, n_features: int, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that minimise the mean ordinal loss plus the L1 penalty."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    top, n = int(grade.max()), len(grade)
    share = np.array([(grade > k).mean() for k in range(top)]).clip(1e-4, 1 - 1e-4)
    l1 = penalty / n
    w, c = np.zeros(n_features), np.log((1 - share) / share)
    low = np.arange(top)
    step = 4.0 / max(1, np.mean([len(r) for r in rows])) if len(col) else 1.0
    wy, cy, t = w, c, 1.0
    for _ in range(STEPS):
        z = np.bincount(row, wy[col], n)[:, None] - np.append(np.append(-1e3, cy), 1e3)[None]
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))            # P(grade > k - 1), k = 0 .. top + 1
        at = np.arange(n)
        up, down = p[at, grade], p[at, grade + 1]              # P(grade) = up - down
        lies = np.maximum(up - down, 1e-9)
        gz = -(up * (1 - up) - down * (1 - down)) / lies
        gc = np.zeros(top + 2)
        np.add.at(gc, grade, up * (1 - up) / lies)
        np.add.at(gc, grade + 1, -down * (1 - down) / lies)
        gw = np.bincount(col, gz[row], n_features) / n
        new = wy - step * gw
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_c = np.maximum.accumulate(cy - step * gc[1:-1] / n + 1e-3 * low) - 1e-3 * low
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wy, cy = new + (t - 1) / t_new * (new - w), new_c + (t - 1) / t_new * (new_c - c)
        cy = np.maximum.accumulate(cy + 1e-3 * low) - 1e-3 * low
        w, c, t = new, new_c, t_new
    return w, c


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna().distinct()
    known = hashed_sample(known, ["id", "y"], sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
    rows = rows.select("y", "text")

    def count(batches):
        seen: dict[bytes, list[int]] = {}
        for batch in batches:
            for y, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                for f in features(raw):
                    seen.setdefault(f, [0, 0])[y > 0] += 1
                if len(seen) > FLUSH:
                    yield counted(seen)
                    seen = {}
        yield counted(seen)

    def counted(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary())] + [
            pa.array([c[k] for c in seen.values()], pa.int64()) for k in (0, 1)], ["f", "clean", "toxic"])

    total = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = sum(n for y, n in total.items() if y <= 0), sum(n for y, n in total.items() if y > 0)
    if not clean or not toxic:
        return Model()
    both = rows.mapInArrow(count, "f binary, clean long, toxic long").groupBy("f").agg(
        F.sum("clean").alias("a"), F.sum("toxic").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    odds = a * (toxic - b) - b * (clean - a)
    chi = odds * odds / ((a + b) * (clean + toxic - a - b + 1))
    best = both.where((a + b >= 3) & (chi >= LEAST_CHI)).orderBy(chi.desc(), "f").limit(FEATURES).collect()
    number = {bytes(r["f"]): k for k, r in enumerate(best)}
    model = Model(number, np.zeros(len(number)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def pick(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [shared.value.found(t) for t in raw_texts(batch.column(1))], pa.list_(pa.int32()))], ["y", "f"])

    table = rows.mapInArrow(pick, "y int, f array<int>").toPandas()
    found, y = [np.asarray(f, np.int64) for f in table.f], table.y.to_numpy(np.int64)
    if len(set(y.tolist())) <= 2:
        y = (y > 0).astype(np.int64)
        lift = np.array([np.log((r["b"] + .5) / (toxic - r["b"] + .5)) - np.log((r["a"] + .5) / (clean - r["a"] + .5))
                         for r in best])
        evidence = np.array([np.maximum(lift[f] - MARKS, 0).sum() for f in found])
        edges = np.quantile(evidence[y > 0], np.arange(1, GRADES) / GRADES)
        y = np.where(y > 0, 1 + np.searchsorted(edges, evidence, "right"), 0)
    y = np.unique(y, return_inverse=True)[1]
    model.weights, model.cuts = fit(found, y, len(number))
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
          cut: float = CUT) -> DataFrame:
    """``id_col, severity`` (expected grade)``, grade`` (most likely)``, p_toxic, toxic``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = schema_of(docs, id_col, ("severity", T.DoubleType()), ("grade", T.IntegerType()),
                       ("p_toxic", T.DoubleType()), ("toxic", T.BooleanType()))

    def run(batches):
        for batch in batches:
            p = np.array([shared.value.over(t) for t in raw_texts(batch.column(1))]).reshape(batch.num_rows, -1)
            each = -np.diff(np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], 1), axis=1)
            yield batch_of(schema, [batch.column(0), p.sum(1), each.argmax(1).astype(np.int32), p[:, 0], p[:, 0] >= cut])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows that are not toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([bool(shared.value.over(t)[0] < cut) for t in raw_texts(batch.column(at))],
                                        pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def trained(spark: SparkSession, sf_dir: str) -> Model:
    return train(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "toxic"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents", "doc_id", "text"), trained(spark, sf_dir))
