"""Instruction-dataset build (G1..G5, T17, T20, P14).

G2  prompt batches   contents numbered inside their source (distributed index, no one-task sort),
                     batch = floor(idx / B); each batch's prompt = fixed preamble + numbered items,
                     cut to 16384 characters. Batch groups hold B rows, so collecting them is bounded.
G3  align results    batch results (JSON arrays from the model) re-attached to the batch's contents
                     by position (equi-join on (batch, pos)); a batch whose result size differs is
                     dropped whole, as in the reference.
G4  split            exactly 80% of the keys, those with the smallest seeded hash, for 'train', the others for
                     'validation'; the k-th smallest hash by refined histograms. Stable under any
                     repartitioning or retry, unlike a random draw.
G5  tokenize/pad     instruct template -> whitespace tokens -> hashed ids (own contract: no model
                     vocabulary), cut or padded to a fixed length, labels = copy of ids.
G1  budget packing   ``pack_by_budget``: fixed boundaries, group = floor(tokens before / budget) (each group
                     holds at most budget + one document). Exact next-fit and the combine loop: ``packing``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstream.functions import prompts as P
from inkstream.functions.text import PROMPT_MAX_CHARS, json_array_extract
from inkstream.operators.chunking import tokens_of
from inkstream.operators.indexing import index_within
from inkstream.operators.packing import PACK_BUDGET, pack_next_fit  # noqa: F401
from inkstream.session import materialize

SPLIT_SEED = 42
TRAIN_PERCENT = 80
HASH_BITS = 52
HASH_BINS = 4096
MAX_TOKENS = 2300
VOCAB = 32000
PAD_ID = 0
BOS_ID = 1
ID_OFFSET = 3


def prompt_batches(contents: DataFrame, group_col: str, order_col: str, text_col: str, batch_size: int,
                   max_chars: int = PROMPT_MAX_CHARS) -> DataFrame:
    """G2 -> (group, batch_no, start_index, n_items, prompt, full_chars). The prompt is cut at
    ``max_chars`` (T17); ``full_chars`` is its length before the cut, so cut prompts show."""
    idx = index_within(contents.select(group_col, order_col, text_col), [group_col], [order_col])
    idx = idx.withColumn("batch_no", F.floor(F.col("idx") / batch_size).cast("bigint"))
    item = F.concat(F.lit("Content number "), F.col("idx").cast("string"), F.lit("\n"), F.col(text_col), F.lit("\n"))
    g = idx.groupBy(group_col, "batch_no").agg(
        F.min("idx").alias("start_index"), F.count(F.lit(1)).alias("n_items"),
        F.array_sort(F.collect_list(F.struct("idx", item.alias("t")))).alias("items"))
    body = F.array_join(F.transform("items", lambda x: x["t"]), "")
    count_line = F.replace(F.lit(P.DATASET_COUNT_LINE), F.lit("{n}"), F.col("n_items").cast("string"))
    prompt = F.concat(F.lit(P.DATASET_USER_PROMPT), count_line, F.lit(P.DATASET_CONTENTS_HEADER), body)
    g = g.select(group_col, "batch_no", "start_index", "n_items", prompt.alias("p"))
    return g.select(group_col, "batch_no", "start_index", "n_items", F.substring("p", 1, max_chars).alias("prompt"),
                    F.char_length("p").cast("bigint").alias("full_chars"))


def align_batch_results(batches: DataFrame, results: DataFrame, batch_key: str, text_col: str) -> DataFrame:
    """batches(batch_key, pos, text_col) x results(batch_key, raw) -> (batch_key, pos, instruction, content)."""
    parsed = results.select(batch_key, json_array_extract("raw").alias("items"))
    sizes = batches.groupBy(batch_key).agg(F.count(F.lit(1)).alias("n"))
    ok = parsed.join(sizes, batch_key).where(F.coalesce(F.size("items"), F.lit(0)) == F.col("n"))
    items = ok.select(batch_key, F.posexplode("items").alias("pos", "it")).select(
        batch_key, F.col("pos").cast("bigint").alias("pos"), F.col("it.instruction").alias("instruction"))
    return items.join(batches.select(batch_key, "pos", F.col(text_col).alias("content")), [batch_key, "pos"])


def key_hash(key: Column, seed: int = SPLIT_SEED) -> Column:
    """52 bits of the seeded md5 of a key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def key_hash_sql(key: str, seed: int = SPLIT_SEED) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, {HASH_BITS // 4}))::BIGINT"


def smallest(hashes: DataFrame, k: int, hash_col: str, key_col: str, bins: int = HASH_BINS) -> Column:
    """Whether (``hash_col``, ``key_col``) is among the ``k`` smallest pairs of a written table of distinct pairs. The k-th
    is found by histograms: ``bins`` counts of the range of hashes, then of the bin that holds it, and so on; the
    driver sees ``bins`` numbers a round, and rounds grow with the logarithm of the table. Keys of one hash, should it
    be theirs where the cut falls, are ordered by key."""
    low, width, before, h = 0, 1 << HASH_BITS, 0, F.col(hash_col)
    while True:
        step = max(1, width // bins)
        own = hashes.where(h.between(low, low + width - 1)).groupBy(F.floor((h - low) / step).cast("bigint").alias("b")).count()
        for b, n in sorted(tuple(r) for r in own.collect()):
            if before + n >= k:
                low, width = low + b * step, step
                break
            before += n
        else:
            return F.lit(k > 0)                      # there are no more than k
        if before + n == k:
            return h < low + width
        if step == 1:
            last = [r[0] for r in hashes.where(h == low).select(key_col).orderBy(key_col).limit(k - before).collect()]
            return (h < low) | (h == low) & (F.col(key_col) <= last[-1]) if last else h < low


def train_val_split(df: DataFrame, key: str) -> DataFrame:
    """Adds ``split`` in {'train', 'validation'}: exactly the rounded share ``TRAIN_PERCENT`` of the distinct keys, those
    with the smallest hashes, is for training. The same under any repartitioning or retry; rows of one key stay
    together; a null key is one key."""
    h, name = f"_{key}_hash", f"_{key}_text"
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    keys = materialize(df.select(key_hash(text).alias(h), text.alias(name)).distinct(), "split-keys")
    n = keys.count()
    train = smallest(keys, (n * TRAIN_PERCENT + 50) // 100, h, name)
    return (df.withColumn(h, key_hash(text)).withColumn(name, text)
            .withColumn("split", F.when(train, "train").otherwise("validation")).drop(h, name))


def token_ids(text: Column) -> Column:
    return F.transform(tokens_of(text), lambda t: (
        F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % (VOCAB - ID_OFFSET) + ID_OFFSET).cast("int"))


def token_ids_sql(e: str) -> str:
    from inkstream.operators.chunking import tokens_sql
    return (f"list_transform({tokens_sql(e)}, lambda t: CAST((('0x' || substr(md5(t), 1, 8))::BIGINT "
            f"% {VOCAB - ID_OFFSET}) + {ID_OFFSET} AS INTEGER))")


def tokenize_pad(samples: DataFrame, max_len: int = MAX_TOKENS) -> DataFrame:
    """G5 + P14: (instruction, content) -> input_ids (BOS + ids, cut/padded to max_len), labels,
    attention_mask, full_tokens (before the cut at ``max_len``); the text columns are dropped."""
    prompt = P.fill(P.INSTRUCT_SAMPLE, instruction=F.col("instruction"), content=F.col("content"))
    ids = F.concat(F.array(F.lit(BOS_ID)), token_ids(prompt))
    cut = F.slice(ids, 1, max_len)
    pad = F.array_repeat(F.lit(PAD_ID), F.greatest(F.lit(max_len) - F.size(cut), F.lit(0)))
    out = samples.withColumn("n_real", F.size(cut)).withColumn("full_tokens", F.size(ids).cast("bigint")).withColumn("input_ids", F.concat(cut, pad))
    out = out.withColumn("labels", F.col("input_ids")).withColumn(
        "attention_mask", F.concat(F.array_repeat(F.lit(1), F.col("n_real")), F.array_repeat(F.lit(0), F.lit(max_len) - F.col("n_real"))))
    return out.drop("instruction", "content")


def pack_by_budget(docs: DataFrame, group_col: str, order_col: str, tokens_col: str,
                   budget: int = PACK_BUDGET) -> DataFrame:
    """G1: adds ``pack_no`` = floor(tokens before this document in its group / budget)."""
    idx = index_within(docs, [group_col], [order_col], value_col=tokens_col)
    return idx.withColumn("pack_no", F.floor(F.col("cum_before") / budget).cast("bigint")).drop("cum_before")
