"""Next-fit packing by token budget (G1) and the combine loop over packs, until one group is left.

The rule is sequential: a pack takes documents in order while its token sum stays within the budget; the document
that would exceed it starts the next pack. With P the tokens before a document and Q = P plus its own, the next
start after a pack that began at P0 is the first document with Q > P0 + budget, so all that a stretch of documents
needs to know of what lies before it is one number, the P0 of the pack that is open there. That number is at most
the stretch's first P, and the result is a step function of it that only goes up.

1. ``index_within`` gives positions and running sums; each group is cut by position into runs of ``RUN`` documents.
2. Every run, on its own, gives its step function: for each document that can be the first start in it (those of one
   pack), where the last start lies and how many there are, equal steps as one.
3. The step functions of a group, a few rows a run, are chained in order: the open pack and the number of packs at
   each run's beginning.
4. Every run numbers its documents.

So documents are shuffled by (group, run), never by group, and nothing loops over the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.operators.indexing import index_within, join_null_safe
from inkstream.session import materialize

PACK_BUDGET = 8000
RUN = 1 << 16


def _next_starts(p: np.ndarray, q: np.ndarray, budget: int) -> np.ndarray:
    return np.maximum(np.arange(len(p)) + 1, np.searchsorted(q, p + budget, "right"))


def run_steps(p: np.ndarray, q: np.ndarray, budget: int, first: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The step function of a run: (limit, state after it, starts in it). The row for an open pack that began at P0
    is the first whose limit is over P0 + budget; if there is none, no pack starts here. ``first``: a pack starts
    with the first document, whatever P0."""
    n, to = len(p), _next_starts(p, q, budget)
    last, starts = np.arange(n), np.ones(n, np.int64)
    while (inside := to < n).any():                    # follow all starts to the end of the run, doubling
        at = to[inside]
        last[inside], starts[inside], to[inside] = last[at], starts[inside] + starts[at], to[at]
    reach = 1 if first else min(int(np.searchsorted(q, p[0] + budget, "right")) + 1, n)
    limit, state, starts = q[:reach], p[last[:reach]], starts[:reach]
    new = np.append(True, (state[1:] != state[:-1]) | (starts[1:] != starts[:-1]))
    end = np.append(np.flatnonzero(new)[1:], reach) - 1
    return limit[end], state[end], starts[end]


def pack_next_fit(docs: DataFrame, group_col: str, order_col: str, tokens_col: str, budget: int = PACK_BUDGET,
                  run: int = RUN) -> DataFrame:
    """``group_col, order_col, tokens_col, pack_no`` (from 0 in each group; a null group is one). ``order_col`` is
    unique in a group; a document over the budget is a pack alone; null tokens count as none."""
    g = group_col
    own = docs.select(g, order_col, F.greatest(F.coalesce(F.col(tokens_col), F.lit(0)), F.lit(0)).cast("bigint").alias(tokens_col))
    base = index_within(own, [g], [order_col], value_col=tokens_col)
    base = materialize(base.select(g, order_col, tokens_col, "idx", F.col("cum_before").cast("bigint").alias("p"),
                                   F.floor(F.col("idx") / run).cast("bigint").alias("run")), "pack-base")
    key = base.schema[g]
    number = lambda *names: [T.StructField(n, T.LongType()) for n in names]

    def arrays(pdf: pd.DataFrame):
        pdf = pdf.sort_values("idx", kind="stable")
        p = pdf["p"].to_numpy(np.int64)
        return pdf, p, p + pdf[tokens_col].to_numpy(np.int64)

    def steps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, p, q = arrays(pdf)
        limit, state, starts = run_steps(p, q, budget, pdf["run"].iloc[0] == 0)
        return pd.DataFrame({g: pd.Series([pdf[g].iloc[0]] * len(limit), dtype=pdf[g].dtype), "run": pdf["run"].iloc[0],
                             "limit": limit, "state": state, "starts": starts})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, state, packs = [], 0, 0
        for r, own in pdf.sort_values(["run", "limit"], kind="stable").groupby("run", sort=True):
            rows.append((r, state, packs))
            at = 0 if r == 0 else int(np.searchsorted(own["limit"].to_numpy(), state + budget, "right"))
            if at < len(own):
                state, packs = int(own["state"].iloc[at]), packs + int(own["starts"].iloc[at])
        out = pd.DataFrame(rows, columns=["run", "state", "packs"])
        out.insert(0, g, pd.Series([pdf[g].iloc[0]] * len(out), dtype=pdf[g].dtype))
        return out

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, p, q = arrays(pdf)
        after, start = _next_starts(p, q, budget), np.zeros(len(p), np.int64)
        k = 0 if pdf["run"].iloc[0] == 0 else int(np.searchsorted(q, pdf["state"].iloc[0] + budget, "right"))
        while k < len(p):
            start[k] = 1
            k = int(after[k])
        return pdf[[g, order_col, tokens_col]].assign(pack_no=pdf["packs"].to_numpy(np.int64) + np.cumsum(start) - 1)

    table = base.groupBy(g, "run").applyInPandas(steps, T.StructType([key, *number("run", "limit", "state", "starts")]))
    entries = materialize(table, "pack-steps").groupBy(g).applyInPandas(chain, T.StructType([key, *number("run", "state", "packs")]))
    placed = join_null_safe(base, materialize(entries, "pack-entries"), [g, "run"])
    return placed.groupBy(g, "run").applyInPandas(
        mark, T.StructType([key, base.schema[order_col], *number(tokens_col, "pack_no")]))


def combine(units: DataFrame, parts: DataFrame, group_col: str, keep: int, budget: int = PACK_BUDGET,
            run: int = RUN) -> tuple[DataFrame, list[DataFrame]]:
    """Map-reduce summaries: pack the units of each group, reduce every pack to its ``keep`` best parts, which are one
    unit of the next round, and go on until each group is one pack.

    ``units``: group, ``unit`` (unique number in order), ``n_tokens``. ``parts``: group, ``unit``, ``part`` (unique in its
    group, orders equal scores), ``n_tokens``, ``score``. Returns the parts left, with ``rank`` in their group, and the
    packing (group, ``unit``, ``pack_no``) of each round. Every round is written; a table shrinks to at most ``keep``
    parts a pack. If packs hold one unit each (units near the budget), two neighbours are put together instead, so the
    loop ends after a logarithmic number of rounds at the latest."""
    g, rounds = group_col, []
    parts = parts.select(g, "unit", "part", "n_tokens", "score")
    order = Window.partitionBy(g, "pack_no").orderBy(F.col("score").desc(), "part")
    while True:
        packs = materialize(pack_next_fit(units, g, "unit", "n_tokens", budget, run).select(g, "unit", "pack_no"), "combine-packs")
        n_units, n_packs = packs.count(), packs.select(g, "pack_no").distinct().count()
        if n_packs * 3 > n_units * 2 and not packs.where("pack_no > 0").isEmpty():
            pairs = index_within(packs.select(g, "unit"), [g], ["unit"])
            packs = materialize(pairs.select(g, "unit", F.floor(F.col("idx") / 2).cast("bigint").alias("pack_no")), "combine-packs")
        rounds.append(packs)
        best = join_null_safe(parts, packs, [g, "unit"]).withColumn("rank", F.row_number().over(order))
        kept = materialize(best.where(F.col("rank") <= keep).select(
            g, F.col("pack_no").alias("unit"), "part", "n_tokens", "score", F.col("rank").cast("bigint").alias("rank")), "combine-parts")
        if kept.where("unit > 0").isEmpty() and packs.where("pack_no > 0").isEmpty():
            return kept.drop("unit"), rounds
        # a pack without parts is gone; the numbers keep their order
        units = kept.groupBy(g, "unit").agg(F.sum("n_tokens").alias("n_tokens"))
        parts = kept.drop("rank")
