"""Hard negatives mined with a GNAT-style multiway hyperplane tree.

An anchor's positives are the rows of its own label with the highest inner product; its hard negatives for a
positive are the best rows of other labels whose score lies between two shares of the positive's score.

Vectors get one more component, so that all have the same norm M: the distance of an anchor (whose own
component is 0) to a row is then sqrt(|a|^2 + M^2 - 2 score), and a window of scores is an annulus around the
anchor. The tree is made for such ranges:

* A node holds some split points; each row below goes to the nearest (a multiway cut by hyperplanes). For every
  split point i and child j the node stores the least and greatest distance from i to the rows below j.
* With the anchor's distances to the split points, the triangle inequality bounds its distance to all rows below
  j from both sides, once for each i. A child whose bounds miss the annulus of every window is eliminated.
* Leaves are exact: integer scores of all rows with the anchors that came there. As the k best of a window
  become known its annulus shrinks.

On Spark: the upper levels are fitted on at most ``SAMPLE`` rows and broadcast with these rows, every row is
assigned to a cell (a leaf of the upper levels) and the ranges are taken over all rows. Anchors are sent to the
cells that their windows meet; the k-th best score in the broadcast rows already shrinks a window. A task
reads the members of a cell, builds the lower levels, and lets the anchors stream past. Cells with more than
``CELL`` members are read in blocks, crowded ones by several tasks. Of equal vectors with equal labels only
the ids that can be among the best are members.

Cases: vectors that are null or hold null or non-finite components, null labels and null ids take no part;
rows that repeat an id are rows of their own; vectors of different lengths never meet; equal scores go to the
smaller id; anchors with fewer positives or negatives get all, those without a positive or a negative give no
rows; scores are exact at any size (over 64 bits: an error); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkstream.llm.common import cell_runs, dealt_cells, materialize, read
from inkstream.llm.intvec import SCALE, checked, integer_vectors, matrix, scores

CELL = 16384             # members of a cell that a task holds
QUERIES = 100_000        # anchors that a task answers in a cell
SAMPLE = 20_000          # rows on which the upper levels are fitted
DEGREE = 8               # split points of a node
LEAF = 512               # rows of a leaf inside a cell
CHUNK = 256              # anchors handled at once
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


class Space:
    """The common norm of the rows of one length, and the rounding margin that goes with it."""

    def __init__(self, most: float):
        self.most = most                             # greatest squared norm of a row

    def rows(self, v: np.ndarray) -> np.ndarray:
        x = v.astype(np.float64)
        return np.concatenate([x, np.sqrt(np.maximum(self.most - (x * x).sum(1, keepdims=True), 0))], 1)

    def anchors(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Points, squared reach (|a|^2 + M^2), margin of distances."""
        x = v.astype(np.float64)
        reach = (x * x).sum(1) + self.most
        return np.concatenate([x, np.zeros((len(x), 1))], 1), reach, 1e-6 * np.sqrt(reach) + 1e-9


def radii(reach: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner and outer radius of the annulus of scores ``low`` to ``high`` (one column a window)."""
    inner = np.sqrt(np.maximum(reach[:, None] - 2 * high.astype(np.float64), 0))
    outer = np.where(low == LOWEST, np.inf, np.sqrt(np.maximum(reach[:, None] - 2 * low.astype(np.float64), 0)))
    return inner, np.where(low > high, -np.inf, outer)


class Gnat:
    """Nodes with split points, children (leaf numbers as -1 - number), and distance ranges [i, j]."""

    def __init__(self, points: np.ndarray, leaf: int, degree: int = DEGREE):
        self.splits, self.children, self.low, self.high, self.leaves = [], [], [], [], []
        rnd, todo = np.random.default_rng(7), [(np.arange(len(points)), None)]
        while todo:
            rows, link = todo.pop()
            split = self._split(points[rows], degree, rnd) if len(rows) > leaf else None
            if link:
                self.children[link[0]][link[1]] = -1 - len(self.leaves) if split is None else len(self.splits)
            if split is None:
                self.leaves.append(rows)
                continue
            node, far = len(self.splits), _distances(points[rows], split)
            near = far.argmin(1)
            self.splits.append(split)
            self.children.append([0] * len(split))
            low, high = self._ranges(far, near)
            self.low.append(low)
            self.high.append(high)
            todo += [(rows[near == j], (node, j)) for j in range(len(split))]

    @staticmethod
    def _split(points: np.ndarray, degree: int, rnd) -> np.ndarray | None:
        """Some rows, each as far as possible from those before; none if all are equal."""
        some = points[rnd.permutation(len(points))[:degree * 8]]
        if (some == some[0]).all():                  # a few of very many may be equal by chance
            other = np.flatnonzero((points != some[0]).any(1))
            if not len(other):
                return None
            some = np.stack([some[0], points[other[0]]])
        chosen, gap = [0], _distances(some, some[:1])[:, 0]
        while len(chosen) < min(degree, len(some)) and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, _distances(some, some[chosen[-1:]])[:, 0])
            gap[chosen] = 0
        # points that lie closer than rounding can tell go to the same child: then there is no cut
        kept = some[chosen]
        return kept if len(set(_distances(points, kept).argmin(1).tolist())) > 1 else None

    @staticmethod
    def _ranges(far: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = far.shape[1]
        low, high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        for j in range(m):
            if (near == j).any():
                low[:, j], high[:, j] = far[near == j].min(0), far[near == j].max(0)
        return low, high

    def assign(self, points: np.ndarray, ranges: dict | None = None) -> np.ndarray:
        """The leaf of each row; ``ranges`` collects node -> (low, high) of these rows."""
        leaf, todo = np.zeros(len(points), np.int32), [(0, np.arange(len(points)))] if self.splits else []
        while todo:
            node, rows = todo.pop()
            far = _distances(points[rows], self.splits[node])
            near = far.argmin(1)
            if ranges is not None:
                low, high = self._ranges(far, near)
                old = ranges.get(node, (low, high))
                ranges[node] = np.minimum(old[0], low), np.maximum(old[1], high)
            for j, child in enumerate(self.children[node]):
                here = rows[near == j]
                if child < 0:
                    leaf[here] = -1 - child
                elif len(here):
                    todo.append((child, here))
        return leaf

    def search(self, points: np.ndarray, margin: np.ndarray, annuli):
        """(leaf, anchors): what the ranges can't eliminate. ``annuli(anchors)`` gives the radii as they are now."""
        every = np.arange(len(points))
        todo = [(0, every)] if self.splits else [(-1, every)]
        while todo:
            node, q = todo.pop()
            if node < 0:
                yield -1 - node, q
                continue
            far = _distances(points[q], self.splits[node])[:, :, None]           # anchor, split point i, (child j)
            low, high = self.low[node][None], self.high[node][None]
            least = np.maximum(far - high, low - far).max(1)
            most = (far + high).min(1)
            inner, outer = annuli(q)
            m = margin[q][:, None, None]
            keep = ((least[:, :, None] <= outer[:, None, :] + m) & (most[:, :, None] >= inner[:, None, :] - m)).any(2)
            for j in np.argsort(-far[:, :, 0].mean(0)):                          # the nearest is taken up first
                if keep[:, j].any():
                    todo.append((self.children[node][j], q[keep[:, j]]))


class Best:
    """The ``k`` best rows of each window of each anchor: higher scores first, then smaller ids."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low.copy(), high, k                        # low rises to the k-th score
        self.held = [np.zeros(0, np.int64) for _ in range(3)]                    # slot, score, id

    def add(self, q: np.ndarray, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """``score`` and ``allowed``: anchors x rows."""
        fresh = []
        for w in range(self.low.shape[1]):
            i, j = np.nonzero(allowed & (score >= self.low[q, w][:, None]) & (score <= self.high[q, w][:, None]))
            fresh.append((q[i] * self.low.shape[1] + w, score[i, j], ids[j]))
        slot, value, who = (np.concatenate([h, *[f[x] for f in fresh]]) for x, h in enumerate(self.held))
        if len(slot) == len(self.held[0]):
            return
        order = np.lexsort((who, ~value, slot))                                  # ~value: descending without overflow
        slot, value, who = slot[order], value[order], who[order]
        start = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        rank = np.arange(len(slot)) - np.repeat(start, np.diff(np.append(start, len(slot))))
        full = slot[rank == self.k - 1]
        flat = self.low.reshape(-1)
        flat[full] = np.maximum(flat[full], value[rank == self.k - 1])
        self.held = [x[rank < self.k] for x in (slot, value, who)]


class Held:
    """Rows with the tree's lower levels over them."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, space: Space, leaf: int):
        self.v, self.ids, self.rows, self.labels, self.space = v, ids, rows, labels, space
        self.tree = Gnat(space.rows(v), leaf)

    def best(self, v: np.ndarray, rows: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int,
             same: bool) -> Best:
        points, reach, margin = self.space.anchors(v)
        found = Best(low, high, k)
        for leaf, q in self.tree.search(points, margin, lambda q: radii(reach[q], found.low[q], high[q])):
            here = self.tree.leaves[leaf]
            allowed = labels[q][:, None] == self.labels[here]
            allowed = allowed & (rows[q][:, None] != self.rows[here]) if same else ~allowed
            found.add(q, scores(v[q], self.v[here]), allowed, self.ids[here])
        return found


def _columns(batch: pa.RecordBatch, dim: int, *names: str) -> list[np.ndarray]:
    out = []
    for n in names:
        c = batch.column(batch.schema.get_field_index(n))
        if n in ("low", "high"):
            out.append(c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1))
        else:
            out.append(matrix(c, dim) if n == "v" else c.to_numpy(zero_copy_only=False))
    return out


class Index:
    """Members of one vector length in cells, with the broadcast upper levels."""

    def __init__(self, members: DataFrame, dim: int):
        spark, self.dim = members.sparkSession, dim
        norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
        n, most = members.agg(F.count("*"), F.max(norm)).first()
        span = 1 << 30
        cut = int(min(1.0, SAMPLE / max(n, 1)) * span)
        some = members.where(F.pmod(F.xxhash64("row"), F.lit(span)) < cut).toPandas()       # about SAMPLE rows
        v = np.array(some.v.tolist(), np.int64).reshape(len(some), dim)
        space = Space(float(most or 0) * (1 + 1e-9))
        tree = Gnat(space.rows(v), max(1, int(len(some) * CELL / max(n, 1))))
        sample = Held(v, some.id.to_numpy(np.int64), some.row.to_numpy(np.int64), some.label.to_numpy(np.int64), space, LEAF)
        first = spark.sparkContext.broadcast((tree, space))

        def assign(batches):
            tree, space = first.value
            for batch in batches:
                cell = tree.assign(space.rows(matrix(batch.column(2), dim)))
                yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], ["cell", "row", "id", "v", "label"])

        def extents(batches):
            tree, space = first.value
            ranges: dict = {}
            for batch in batches:
                tree.assign(space.rows(matrix(batch.column(0), dim)), ranges)
            for node, (low, high) in ranges.items():
                i, j = np.nonzero(low <= high)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), node)), pa.array(i), pa.array(j),
                                                  pa.array(low[i, j]), pa.array(high[i, j])], ["node", "i", "j", "low", "high"])

        fields = "cell int, row long, id long, v array<long>, label long"
        self.cells = materialize(members.select("row", "id", "v", "label").mapInArrow(assign, fields), "gnat-cells")
        ranges = (self.cells.select("v").mapInArrow(extents, "node long, i long, j long, low double, high double")
                  .groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"))).collect()
        for node, split in enumerate(tree.splits):   # a few numbers per cell
            tree.low[node], tree.high[node] = np.full((len(split),) * 2, np.inf), np.full((len(split),) * 2, -np.inf)
        for r in ranges:
            tree.low[r.node][r.i, r.j], tree.high[r.node][r.i, r.j] = r.low, r.high
        first.unpersist()
        self.shared = spark.sparkContext.broadcast((tree, sample))

    def best(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """``q, w, id, score, rank``: the ``k`` best rows of each window. ``anchors``: ``row, v, label, low, high``, the
        last two with one entry a window. ``same``: rows of the anchor's label other than itself, else of other labels."""
        shared, dim = self.shared, self.dim

        def route(batches):
            tree, sample = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(at, CHUNK)
                    row, v, label, low, high = _columns(part, dim, "row", "v", "label", "low", "high")
                    points, reach, margin = sample.space.anchors(v)
                    low = sample.best(v, row, label, low, high, k, same).low
                    for cell, q in tree.search(points, margin, lambda q: radii(reach[q], low[q], high[q])):
                        chosen = part.take(pa.array(q))
                        ends = pa.array(np.arange(len(q) + 1, dtype=np.int32) * low.shape[1])
                        raised = pa.ListArray.from_arrays(ends, pa.array(low[q].ravel()))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(q), cell, np.int32)), pa.array(np.full(len(q), True)), chosen.column(0),
                             chosen.column(0), chosen.column(1), chosen.column(2), raised, chosen.column(4)],
                            ["cell", "asks", "row", "id", "v", "label", "low", "high"])

        fields = "cell int, asks boolean, row long, id long, v array<long>, label long, low array<long>, high array<long>"
        routed = anchors.select("row", "v", "label", "low", "high").mapInArrow(route, fields)
        none = F.lit(None).cast("array<long>")
        both = self.cells.select("cell", F.lit(False).alias("asks"), "row", "id", "v", "label", none.alias("low"),
                                 none.alias("high")).unionByName(routed)
        placed = dealt_cells(materialize(both, "gnat-routed"), ["cell"], CELL, QUERIES, F.xxhash64("row"))

        def answer(batches):
            space = shared.value[1].space
            key, parts, held = None, [], None
            for now, asks, rows in cell_runs(batches, 3):
                if now != key:
                    key, parts, held = now, [], None
                if not asks:
                    parts.append(_columns(rows, dim, "v", "id", "row", "label"))
                    continue
                if held is None and parts:
                    v, ids, row, label = map(np.concatenate, zip(*parts))
                    held, parts = Held(v, ids, row, label, space, LEAF), []
                for at in range(0, rows.num_rows if held else 0, CHUNK):
                    row, v, label, low, high = _columns(rows.slice(at, CHUNK), dim, "row", "v", "label", "low", "high")
                    slot, score, ids = held.best(v, row, label, low, high, k, same).held
                    q, w = np.divmod(slot, low.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(row[q]), pa.array(w), pa.array(ids), pa.array(score)],
                                                     ["q", "w", "id", "score"])

        found = placed.mapInArrow(answer, "q long, w long, id long, score long")
        order = W.partitionBy("q", "w").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(table: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label", positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
         scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows for which ``is_anchor``
    holds (an expression over the id, named ``id``): for each of an anchor's ``positives`` best rows of its label, the
    ``negatives`` best rows of other labels whose score is ``least`` to ``most`` hundredths of the positive's."""
    spark = table.sparkSession
    rows = integer_vectors(table.where(F.col(label_col).isNotNull()), id_col, vec_col,
                           F.col(label_col).cast("long").alias("label"), scale=scale)
    rows = materialize(rows, "negatives-rows")
    equal = W.partitionBy("v", "label").orderBy("id", "row")
    members = materialize(rows.withColumn("n", F.row_number().over(equal))
                          .where(F.col("n") <= max(positives, negatives) + 1).drop("n"), "negatives-members")
    anchors = rows.where(is_anchor)
    parts = []
    for (dim,) in sorted(tuple(r) for r in anchors.select(F.size("v")).distinct().collect()):
        of_length = F.size("v") == dim
        index = Index(members.where(of_length), dim)
        asked = anchors.where(of_length).withColumn("low", F.array(F.lit(LOWEST))).withColumn("high", F.array(F.lit(HIGHEST)))
        near = materialize(index.best(asked, positives, True).select("q", "rank", "id", "score"), "negatives-positives")
        rest = F.pmod("score", F.lit(100))
        whole = (F.col("score") - rest).cast("decimal(20,0)") / 100          # score = 100 whole + rest, without overflow
        whole = whole.cast("long")
        low = whole * least + F.ceil(rest * least / 100).cast("long")
        high = whole * most + F.floor(rest * most / 100).cast("long")
        # one window a positive, padded with empty ones, so that all anchors have as many
        sides = (near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("s"))
                 .withColumn("pad", F.array_repeat(F.lit(0).cast("long"), F.lit(positives) - F.size("s")))
                 .select(F.col("q").alias("row"), F.concat("s.low", F.transform("pad", lambda p: p + 1)).alias("low"),
                         F.concat("s.high", "pad").alias("high")))
        windows = anchors.where(of_length).join(sides, "row")
        found = index.best(windows, negatives, False)
        pairs = found.withColumn("w", F.col("w") + 1).join(
            near.select("q", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
            ["q", "w"]).join(anchors.select(F.col("row").alias("q"), F.col("id").alias("anchor_id")), "q")
        parts.append(materialize(pairs.select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
            checked(F.col("positive_score")).alias("positive_score"),
            checked(F.col("score")).alias("negative_score")), "negatives-found"))
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table.withColumn("label", moved), F.col("id") % 100 == 0)


SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.r <> c.r AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS p FROM s WHERE same) WHERE p <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.r, p.p ORDER BY n.score DESC, n.vec_id) AS rank
  FROM pos p JOIN s n ON n.r = p.r AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score) WHERE rank <= 10
"""
