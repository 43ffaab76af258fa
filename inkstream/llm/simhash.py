"""SimHash near-duplicates by the generalised pigeonhole principle.

Every document gets a 64-bit fingerprint of its word shingles. Two fingerprints link at ``distance``
or fewer differing bits; documents of linked fingerprints form components.

Equal fingerprints are reduced to one row before anything else (hash aggregate), so groups of exact
copies cost nothing later. The links between different fingerprints are found like this:

* The 64 bits are dealt to ``m`` parts; strongly correlated bits go to the same part (greedy, on the
  64 x 64 bit counts over all fingerprints), so that the other parts stay independent.
* A vector of thresholds t_1..t_m with sum(t_i + 1) = distance + 1 is sound: if two fingerprints
  differed in more than t_i bits in every part, they would differ in more than ``distance`` bits.
  t_i = -1 leaves a part out. Each fingerprint gets its own vector by dynamic programming over the
  parts, on estimated candidate counts: how many fingerprints have a part value within t_i bits of
  its own (from the counts of all part values, at most 65,536 per half part). A fingerprint in a
  crowded value of one part thus leaves that part out and pays elsewhere. ``m`` follows from the
  number of fingerprints by the same cost.
* Every fingerprint is stored under its part values and probes the values within t_i bits; rows that
  meet in a bucket are verified by their bit distance.

A bucket of more than ``BLOCK`` rows is cut into blocks by a hash, and every pair of blocks is a
group of its own, so no task holds more than two blocks and nothing is dropped. Groups return the
links of their local components (stars, at most one per row), never all pairs; a task merges pairs into
component labels as it finds them and holds none. Probing rows leave a task in bounded batches.

Components: alternating large-star and small-star steps on the links, each written to the shared
folder; only minima are aggregated, so a hub is reduced before the shuffle. Only counts, 64 x 64 bit
counts and the part value counts (all of bounded size) reach the driver.

Cases: null and empty texts have no words and fingerprint zero, linked like any other; fewer words
than a shingle: the whole sequence; a null document id keeps its row, but does not name a component
(component id null if no member has an id); repeated rows give one result each; an empty table gives
an empty result; very long texts are hashed in pieces; other columns are ignored (``keep_one`` keeps
them).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.llm.common import batch_of, free_name, materialize, raw_texts, read

SHINGLE = 4
SEED = 42
DISTANCE = 4
BITS = 64
PIECE = 1 << 18          # shingles hashed at once
BLOCK = 1024             # rows of a bucket that stay in one block
SMALL = 48               # rows up to which groups are compared together
CELLS = 1 << 18          # comparisons held at once
PROBES = 1 << 16         # probing rows in a batch
ROWS = 1 << 17           # rows of a file once there are as many files as slots
VERIFY = 0.02            # cost of a candidate, in rows moved


# --------------------------------------------------------------------------- fingerprints
def fingerprint(raw: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in over half of the 64-bit hashes of the shingles (repeats count)."""
    words = raw.lower().split()                  # bytes: A-Z only; cut at space, \t to \r
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(words) - shingle + 1
    for at in range(0, n, PIECE):
        part = words[at:at + PIECE + shingle - 1]
        text = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        begins = np.append(0, ends[:-1] + 1)
        hashes = [digest(text[i:j], seed) for i, j in zip(begins[:len(part) - shingle + 1].tolist(),
                                                          ends[shingle - 1:].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, name: str, text_col: str = "text", shingle: int = SHINGLE,
                     seed: int = SEED) -> DataFrame:
    """``docs`` with its fingerprint (a long) as column ``name`` at the end."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            got = np.array([fingerprint(t, shingle, seed) for t in raw_texts(batch.column(at))], np.uint64)
            yield batch_of(schema, [*batch.columns, pa.array(got.view(np.int64))])

    return docs.mapInArrow(run, schema)


# --------------------------------------------------------------------------- parts and thresholds
def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and, for each pair of bits, how many have both set."""
    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            x = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint8)
            x = np.unpackbits(x.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += x.T @ x
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1), pa.int32()),
                                              pa.array(np.append(total.ravel(), n).astype(np.int64))], ["k", "n"])

    rows = prints.select("fp").mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for k, n in rows:
        flat[k] = n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def deal_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` parts of nearly equal width; each takes the free bit with the strongest correlations
    and then the bits most correlated with what it holds."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    r = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(r, 0)
    free, parts = set(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        rest = sorted(free)
        part = [max(rest, key=lambda b: (r[b, rest].sum(), -b))]
        while len(part) < width:
            part.append(max(sorted(free - set(part)), key=lambda b: (r[b, part].sum(), -b)))
        free -= set(part)
        parts.append(sorted(part))
    return parts


def ball(width: int, t: int) -> int:
    """Values within ``t`` bits of a value of ``width`` bits."""
    out, c = 0, 1
    for k in range(t + 1):
        out, c = out + c, c * (width - k) // (k + 1)
    return out


def choose_parts(n: int, distance: int) -> int:
    """The number of parts of least cost if bits were even: rows moved plus candidates verified."""
    def cost(m: int) -> float:
        width = BITS / m
        t = [(distance + 1) // m - 1 + (k < (distance + 1) % m) for k in range(m)]
        probes = [ball(int(width), x) for x in t if x >= 0]
        return m + sum(probes) - len(probes) + VERIFY * n * sum(probes) / 2 ** width
    return min(range(2, distance + 2), key=cost)


def values(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(prints), np.int64)
    for k, b in enumerate(bits):
        out |= ((prints >> b) & 1) << k
    return out


def halves(bits: list[int]) -> list[list[int]]:
    """A part of over 16 bits is counted in two halves."""
    return [bits] if len(bits) <= 16 else [bits[:len(bits) // 2], bits[len(bits) // 2:]]


class Plan:
    """Parts, and for each half part how many fingerprints lie at exactly 0..distance bits from
    each value."""

    def __init__(self, n: int, parts: list[list[int]], counts: dict[tuple[int, int], np.ndarray], distance: int):
        self.n, self.parts, self.distance = n, parts, distance
        self.near = {}
        for key, hist in counts.items():
            g = [hist.astype(np.float32)] + [np.zeros(len(hist), np.float32) for _ in range(distance)]
            v = np.arange(len(hist))
            for b in range(int(len(hist)).bit_length() - 1):
                flip = v ^ (1 << b)
                g = [g[0]] + [g[d] + g[d - 1][flip] for d in range(1, distance + 1)]
            self.near[key] = g
        self.masks = [[[sum(1 << b for b in c) for c in combinations(range(len(p)), d)] if ball(len(p), d) < 10**6
                       else [] for d in range(distance + 1)] for p in parts]

    def estimates(self, prints: np.ndarray) -> list[np.ndarray]:
        """For each part, (rows, distance + 2): cost of t = -1, 0, 1, ... for each fingerprint."""
        out = []
        for i, part in enumerate(self.parts):
            own = [np.stack([g[values(prints, h)] for g in self.near[i, k]], 1) for k, h in enumerate(halves(part))]
            if len(own) == 1:
                exact = own[0]
            else:                       # halves taken as independent
                exact = np.stack([sum(own[0][:, a] * own[1][:, d - a] for a in range(d + 1))
                                  for d in range(self.distance + 1)], 1) / max(self.n, 1)
            cost = VERIFY * np.cumsum(exact, 1)
            cost += np.array([ball(len(part), t) - 1 for t in range(self.distance + 1)])
            for t, masks in enumerate(self.masks[i]):
                if not masks:
                    cost[:, t] = np.inf
            out.append(np.concatenate([np.zeros((len(prints), 1)), cost], 1))
        return out

    def thresholds(self, prints: np.ndarray) -> np.ndarray:
        """The cheapest t (rows, parts) with sum(t + 1) = distance + 1, by dynamic programming."""
        budget, n = self.distance + 1, len(prints)
        best = np.full((n, budget + 1), np.inf)
        best[:, 0] = 0
        picks = []
        for cost in self.estimates(prints):
            new, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
            for b in range(budget + 1):
                for s in range(b + 1):
                    c = best[:, b - s] + cost[:, s]
                    better = c < new[:, b]
                    new[better, b], pick[better, b] = c[better], s
            best = new
            picks.append(pick)
        out, left, rows = np.zeros((n, len(picks)), np.int8), np.full(n, budget), np.arange(n)
        for i in reversed(range(len(picks))):
            s = picks[i][rows, left]
            out[:, i], left = s - 1, left - s
        return out

    def rows(self, prints: np.ndarray):
        """(part, key, fingerprint, role): role 1 stored, 2 probing, 3 both."""
        t = self.thresholds(prints)
        for i, part in enumerate(self.parts):
            own = values(prints, part)
            yield i, own, prints, np.where(t[:, i] >= 0, 3, 1)
            for d in range(1, self.distance + 1):
                who = np.flatnonzero(t[:, i] >= d)
                if len(who):
                    masks = np.array(self.masks[i][d], np.int64)
                    step = max(1, PROBES // len(masks))
                    for at in range(0, len(who), step):
                        w = who[at:at + step]
                        yield (i, (own[w][:, None] ^ masks).ravel(), np.repeat(prints[w], len(masks)),
                               np.full(len(w) * len(masks), 2))


def make_plan(prints: DataFrame, distance: int, m: int | None = None) -> Plan:
    n, both = bit_counts(prints)
    parts = deal_bits(n, both, m or choose_parts(n, distance))
    keys = [(i, k, h) for i, p in enumerate(parts) for k, h in enumerate(halves(p))]

    def run(batches):
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            for i, k, h in keys:
                v, c = np.unique(values(x, h), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), 2 * i + k), pa.int32()),
                                                  pa.array(v), pa.array(c.astype(np.int64))], ["h", "v", "n"])

    rows = (prints.select("fp").mapInArrow(run, "h int, v long, n long").groupBy("h", "v")
            .agg(F.sum("n").alias("n")).toPandas())
    counts = {}
    for i, k, h in keys:
        own = rows[rows.h == 2 * i + k]
        counts[i, k] = np.zeros(1 << len(h))
        counts[i, k][own.v.to_numpy(np.int64)] = own.n
    return Plan(n, parts, counts, distance)


# --------------------------------------------------------------------------- links
def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links ``a``-``b`` with the smallest node of its component, itself left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, label = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` (of each row, the smallest row of its component so far) after the links ``i``-``j``."""
    while True:
        x, y = label[i], label[j]
        apart = x != y
        if not apart.any():
            return label
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def links(prints: np.ndarray, role: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs between stored and probing rows of equal ``group`` (sorted), as stars. Pairs are
    merged into labels of the rows as they are found, so ``CELLS`` comparisons are held at most."""
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(begin, len(group)))
    label = np.arange(len(group))
    few = np.repeat(size <= SMALL, size)
    rest = np.repeat(begin + size, size) - np.arange(len(group))         # rows to the group's end
    for s in range(1, SMALL):
        i = np.flatnonzero(few & (rest > s))
        if not len(i):
            break
        i = i[((role[i] | role[i + s]) == 3) & (differing(prints[i], prints[i + s]) <= distance)]
        label = merge(label, i, i + s)
    for b, n in zip(begin[size > SMALL].tolist(), size[size > SMALL].tolist()):
        at, end = b, b + n
        while at < end and (label[b:end] != b).any():                    # until all are one component
            to = min(end, at + max(1, CELLS // (end - at)))
            ok = differing(prints[at:to, None], prints[at:end]) <= distance
            ok &= (role[at:to, None] | role[at:end]) == 3
            ok &= label[at:to, None] != label[at:end]
            i, j = np.nonzero(ok)
            label = merge(label, i + at, j + at)
            at = to
    other = label != np.arange(len(label))
    a, b = prints[other], prints[label[other]]
    differ = a != b
    return stars(a[differ], b[differ])


def find_links(prints: DataFrame, plan: Plan, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)``, b < a, whose components are those of all links between fingerprints."""
    spark, distance = prints.sparkSession, plan.distance
    shared = spark.sparkContext.broadcast(plan)

    def emit(batches):
        for batch in batches:
            for i, key, fp, role in shared.value.rows(batch.column(0).to_numpy(zero_copy_only=False)):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(key), i), pa.int32()), pa.array(key), pa.array(fp),
                    pa.array(role.astype(np.int32))], ["part", "key", "fp", "role"])

    rows = materialize(prints.select("fp").mapInArrow(emit, "part int, key long, fp long, role int"), "simhash-rows")
    big = (rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
           .select("part", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    big = materialize(big, "simhash-big")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("long")).cast("int")
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
        F.least(own, x).alias("x"), F.greatest(own, x).alias("y")))
    alone = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))
    dealt = (rows.join(big, ["part", "key"], "left")
             .withColumn("pair", F.explode(F.when(F.col("blocks").isNull(), alone).otherwise(both)))
             .select("part", "key", "pair.x", "pair.y", "fp", "role"))

    def verify(batches):
        held = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            change = np.zeros(len(held[0]), bool)
            for c in held[:4]:
                change[1:] |= c[1:] != c[:-1]
            last = np.flatnonzero(change)
            if len(last):
                whole = int(last[-1])
                yield from send(*links(held[4][:whole], held[5][:whole], np.cumsum(change)[:whole], distance))
                held = [c[whole:] for c in held]
        if held is not None and len(held[0]):
            yield from send(*links(held[4], held[5], np.zeros(len(held[0]), int), distance))

    def send(a, b):
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    key = ["part", "key", "x", "y"]
    return (dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(verify, "a long, b long"))


# --------------------------------------------------------------------------- components
def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, in a partition for each slot, or for each ``ROWS`` rows if these
    are more: the steps write many tables, and each file of a small one costs more than its rows."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS)))


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)``: every node of ``edges`` (b < a) that is not the smallest of its component, with
    the smallest. Large-star and small-star steps until nothing changes."""
    def state(df):
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    now = materialize(edges.distinct(), "simhash-links")
    seen = state(now)
    while seen[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(packed(both.groupBy("a").agg(F.min("b").alias("m"))
                                   .select("a", F.least("a", "m").alias("m")), seen[0]), "simhash-least")
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(packed(large.where("a <> b").distinct(), seen[0]), "simhash-large")
        least = materialize(packed(large.groupBy("a").agg(F.min("b").alias("m")), seen[0]), "simhash-least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(packed(small.union(least).where("a <> b").distinct(), seen[0]), "simhash-links")
        before, seen = seen, state(now)
        if before == seen:
            break
    return now


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    seed: int = SEED, distance: int = DISTANCE, parts: int | None = None,
                    block: int = BLOCK) -> DataFrame:
    """``id_col, fingerprint`` (16 hexadecimal digits)``, component_id`` (smallest id of the
    component) and ``component_print`` (smallest fingerprint of it, as a signed number)."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = materialize(with_fingerprint(own, "fp", "text", shingle, seed).select("id", "fp"), "simhash-prints")
    single = materialize(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-single")
    plan = make_plan(single, distance, parts)
    root = components(find_links(single, plan, block))
    member = single.join(root.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    member = materialize(packed(member, plan.n), "simhash-member")
    least = materialize(packed(member.groupBy("root").agg(F.min("first").alias("component_id")), plan.n), "simhash-least")
    label = materialize(packed(member.join(least, "root").select("fp", "root", "component_id"), plan.n), "simhash-label")
    return prints.join(label, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id", F.col("root").alias("component_print"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each component, with all columns of ``docs``: the one with the smallest id. Rows
    whose id is null or repeated are told apart by their fingerprints, computed anew for these rows
    alone; of several such rows in one component one stays (the first by a hash of all columns)."""
    found = materialize(near_duplicates(docs, id_col=id_col, text_col=text_col, **how), "simhash-found")
    own, hex_, comp, root, fp, n = (free_name(docs, x) for x in
                                    ("kept_id", "kept_hex", "kept_component", "kept_root", "kept_print", "kept_n"))
    ids = found.groupBy(F.col(id_col).alias(own)).agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("c"))
    ids = materialize(ids, "simhash-ids")
    # the ids grow with the documents: one way for every size, not a broadcast while they are few
    keep = ids.where((F.col("n") == 1) & (F.col(own) == F.col("c"))).select(own).hint("merge")
    out = docs.join(keep, F.col(id_col) == F.col(own), "left_semi")
    odd = ids.where((F.col("n") > 1) | F.col(own).isNull()).select(own)
    if odd.limit(1).count():
        rows = docs.join(odd.hint("merge"), F.col(id_col).eqNullSafe(F.col(own)), "left_semi")
        rows = with_fingerprint(rows, fp, text_col, how.get("shingle", SHINGLE), how.get("seed", SEED))
        label = found.select(F.col("fingerprint").alias(hex_), F.col("component_id").alias(comp),
                             F.col("component_print").alias(root)).distinct()
        rows = rows.join(label, F.lpad(F.lower(F.hex(fp)), 16, "0") == F.col(hex_))
        first = F.row_number().over(W.partitionBy(root).orderBy(F.xxhash64(*docs.columns)))
        rows = rows.where(F.col(id_col).eqNullSafe(F.col(comp))).withColumn(n, first).where(F.col(n) == 1)
        out = out.unionByName(rows.select(*docs.columns))
    return out


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
