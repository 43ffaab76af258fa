"""Profiling and summarisation aggregates (G6..G11, U2).

All are hash aggregates with a partial (map-side) step; per-group top-n uses ``row_number() <= n``
(partial WindowGroupLimit before the shuffle). Scalars that a whole table contributes to (number of
days, row count) are computed once as one scalar and enter the plan as a literal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkstream.operators.embedding import words
from inkstream.operators.indexing import index_within, join_null_safe
from inkstream.operators.packing import PACK_BUDGET, combine
from inkstream.session import materialize

SCORE_DECIMALS = 9
COMMON_TERMS, COMMON_CHARS = 200_000, 64  # weightless terms that are broadcast: at most so many, so long


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """G6."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def null_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row, n_rows and n_null_<col> per column."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.sum(F.col(c).isNull().cast("bigint")).alias(f"n_null_{c}") for c in cols])


def exact_quantiles(df: DataFrame, value_col: str, probs: tuple[float, ...]) -> dict:
    """Exact linear-interpolation quantiles (as pandas ``describe``), without collecting the column:
    rows are counted per value, a distributed running sum runs over the distinct values, and the two
    ranks around each p * (n - 1) are picked. Returns {p: value}."""
    counts = materialize(df.where(F.col(value_col).isNotNull()).groupBy(value_col).agg(F.count(F.lit(1)).alias("n")), "value-counts")
    n = counts.agg(F.sum("n")).first()[0] or 0
    if n == 0:
        return {p: None for p in probs}
    wanted = {}
    for p in probs:
        pos = p * (n - 1)
        wanted[p] = (int(pos // 1), int(-(-pos // 1)), pos - int(pos // 1))
    # rank r has the value whose copies cover it: rows before it <= r < rows before it + its copies
    run = index_within(counts, [], [value_col], value_col="n")
    ranks = sorted({r for lo, hi, _ in wanted.values() for r in (lo, hi)})
    covers = None
    for r in ranks:
        c = (F.col("cum_before") <= r) & (F.col("cum_before") + F.col("n") > r)
        covers = c if covers is None else covers | c
    rows = [(int(x["cum_before"]), x["n"], x[value_col]) for x in run.where(covers).select("cum_before", "n", value_col).collect()]
    got = {r: v for r in ranks for before, k, v in rows if before <= r < before + k}
    return {p: got[lo] + (got[hi] - got[lo]) * frac for p, (lo, hi, frac) in wanted.items()}


def describe(df: DataFrame, value_col: str) -> DataFrame:
    """Count, mean, std, min, 25%, 50%, 75%, max of one numeric column (exact quantiles)."""
    x = df.where(F.col(value_col).isNotNull())
    q = exact_quantiles(x, value_col, (0.25, 0.5, 0.75))
    base = x.agg(F.count(F.lit(1)).alias("count"), F.avg(value_col).alias("mean"),
                 F.stddev_samp(value_col).alias("std"), F.min(value_col).cast("double").alias("min"),
                 F.max(value_col).cast("double").alias("max"))
    qs = [F.lit(None if q[p] is None else float(q[p])).cast("double").alias(a)
          for p, a in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
    return base.select(F.lit(value_col).alias("column"), "count", F.round("mean", 6).alias("mean"),
                       F.round("std", 6).alias("std"), "min", *qs, "max")


def term_weights(docs: DataFrame, day_col: str, text_col: str) -> DataFrame:
    """TF-IDF per (day, term): tf = occurrences that day, idf = ln(days / days containing term)."""
    terms = docs.select(day_col, F.explode(words(text_col)).alias("term"))
    tf = terms.groupBy(day_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    # Document frequency = rows of the (day, term) table per term: a window over term, whose groups
    # hold at most one row per day (bounded, even for the most common word), instead of a second
    # aggregate + join that would tokenize the corpus again.
    w = tf.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("term")))
    n_days = docs.agg(F.countDistinct(day_col)).first()[0]  # one scalar, computed once
    return w.select(day_col, "term", "tf", (F.col("tf") * F.log(F.lit(float(n_days)) / F.col("df"))).alias("weight"))


def daily_top_terms(docs: DataFrame, day_col: str, text_col: str, n: int) -> DataFrame:
    """G11 (terms): the n heaviest terms of each day."""
    w = term_weights(docs, day_col, text_col).withColumn("weight", F.round("weight", SCORE_DECIMALS))
    win = Window.partitionBy(day_col).orderBy(F.col("weight").desc(), F.col("term").asc())
    return w.withColumn("rank", F.row_number().over(win).cast("bigint")).where(F.col("rank") <= n)


def sentences(docs: DataFrame, day_col: str, id_col: str, text_col: str) -> DataFrame:
    """``day_col, id_col, sent_no, sentence`` of the sentences that aren't blank."""
    return docs.select(day_col, id_col, F.posexplode(F.split(text_col, "[.!?]")).alias("sent_no", "sentence")) \
        .where(F.length(F.trim("sentence")) > 0)


def sentence_scores(docs: DataFrame, day_col: str, id_col: str, text_col: str) -> DataFrame:
    """``day_col, id_col, sent_no, n_words, score``: the mean TF-IDF weight of the words of each sentence with words.

    A term of every day weighs nothing, and such terms are most of a text's words: the most frequent of them are
    broadcast, so their occurrences end in the task that reads them; the others just find no partner in the join."""
    weights = materialize(term_weights(docs, day_col, text_col), "term-weights")
    nothing = weights.where((F.col("weight") <= 0) & (F.length("term") <= COMMON_CHARS)).groupBy("term").agg(F.sum("tf").alias("tf"))
    nothing = nothing.orderBy(F.col("tf").desc(), "term").limit(COMMON_TERMS).select("term")
    key = [day_col, id_col, "sent_no", "n_words"]
    # exploded out of an array of one, the words are a column and not split anew for each use; the null is the sentence
    counted = sentences(docs, day_col, id_col, text_col).select(
        day_col, id_col, "sent_no", F.explode(F.array(words("sentence"))).alias("w")) \
        .withColumn("n_words", F.size("w")).where(F.col("n_words") > 0)
    toks = counted.select(*key, F.explode(F.concat("w", F.array(F.lit(None).cast("string")))).alias("term"))
    toks = materialize(toks.join(F.broadcast(nothing), "term", "left_anti").select(*key, "term"), "sentence-words")
    weighed = join_null_safe(toks.where(F.col("term").isNotNull()), weights.where(F.col("weight") > 0).select(
        day_col, "term", "weight"), [day_col, "term"], "inner").select(*key, "weight")
    own = toks.where(F.col("term").isNull()).select(*key, F.lit(0.0).alias("weight"))
    scored = weighed.unionByName(own).groupBy(*key).agg(F.sum("weight").alias("total"))
    return scored.select(*key, F.round(F.col("total") / F.col("n_words"), SCORE_DECIMALS).alias("score"))


def daily_key_sentences(docs: DataFrame, day_col: str, id_col: str, text_col: str, n: int) -> DataFrame:
    """G11 (sentences): sentences scored by the mean TF-IDF weight of their words; top n per day."""
    scored = sentence_scores(docs, day_col, id_col, text_col).drop("n_words")
    win = Window.partitionBy(day_col).orderBy(F.col("score").desc(), F.col(id_col).asc(), F.col("sent_no").asc())
    top = scored.withColumn("rank", F.row_number().over(win).cast("bigint")).where(F.col("rank") <= n)
    return join_null_safe(top, sentences(docs, day_col, id_col, text_col), [day_col, id_col, "sent_no"]).select(
        day_col, "rank", id_col, F.col("sent_no").cast("bigint").alias("sent_no"), F.trim("sentence").alias("sentence"),
        "score")


def combined_summary(docs: DataFrame, day_col: str, id_col: str, text_col: str, tokens_col: str, keep: int,
                     budget: int = PACK_BUDGET) -> tuple[DataFrame, list[DataFrame]]:
    """A day's documents are packed by budget, each pack is reduced to its key sentences, the results are
    packed again, until one pack is left. Returns ``day_col, rank, id_col, sent_no, sentence, score`` and the rounds."""
    scored = materialize(sentence_scores(docs, day_col, id_col, text_col), "summary-sentences")
    parts = scored.select(day_col, F.col(id_col).alias("unit"), F.struct(F.col(id_col).alias("id"), "sent_no").alias("part"),
                          F.col("n_words").cast("bigint").alias("n_tokens"), "score")
    units = docs.select(day_col, F.col(id_col).alias("unit"), F.col(tokens_col).alias("n_tokens"))
    kept, rounds = combine(units, parts, day_col, keep, budget)
    kept = kept.select(day_col, "rank", F.col("part.id").alias(id_col), F.col("part.sent_no").alias("sent_no"), "score")
    r = kept.select(F.col(day_col).alias("_day"), F.col(id_col).alias("_id"))     # only their documents are split again
    found = docs.join(r, docs[day_col].eqNullSafe(r["_day"]) & docs[id_col].eqNullSafe(r["_id"]), "left_semi")
    text = sentences(found, day_col, id_col, text_col)
    return join_null_safe(kept, text, [day_col, id_col, "sent_no"]).select(
        day_col, "rank", id_col, F.col("sent_no").cast("bigint").alias("sent_no"), F.trim("sentence").alias("sentence"),
        "score"), rounds


def dedup_by_key(df: DataFrame, key: str, keep: str) -> DataFrame:
    """One row per key (the least ``keep`` value) with the number of copies."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_copies"), F.min(keep).alias(keep))
