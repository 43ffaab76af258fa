"""Benchmark decontamination with suffix arrays over the training texts.

The training texts are read once, without a shuffle. Each task cuts its rows into shards of about
``SHARD_WORDS`` words (also by rows and bytes, so that empty texts don't pile up), builds a suffix array of every
shard (the start positions, sorted by the words that follow, as many as a window has) and binary-searches the
suffixes of the test items in it, equal windows once: the interval of the array narrows word by word until it is
empty or holds the places of the window. Words that occur in no test item get the number 0; a position from which
fewer words than the shortest window are known can hold no window, so the array leaves it out. Hit words are
marked from the distinct windows. A longest verbatim match begins where the word before differs (the places of a
window are sorted by that word, so the others are never listed) and is followed until the words differ; repeated
words give one match per diagonal, not one per window and place.

The test items are cut into blocks of about ``BLOCK_CHARS`` characters by a hash; one block at a time
is collected, indexed and broadcast, so neither the driver nor a task ever holds more. With more
than one block the hit words of a document are united by a grouping over documents.

Cases: null or empty texts have no words and no hits; an item without words has no window; an item
of fewer than ``window`` words is one window; equal item ids count once; windows of an item whose id
is null mark words but are not listed; a null document id is kept as it is; repeated rows give one
result each; a document longer than a shard gets several suffix arrays over the same words; with no
items, nothing is hit. Other columns are ignored, or kept where rows are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.llm.common import batch_of, raw_texts, read, schema_of

WINDOW = 13
SHARD_WORDS = 1 << 20
BLOCK_CHARS = 8 << 20
PIECE = 8 << 20                 # bytes of one text that are split at once
SHARD_ROWS, SHARD_BYTES = 1 << 15, 64 << 20
STARTS = 1 << 20                # matches followed at once

#: A-Z become a-z; the other bytes that belong to no word become spaces.
TABLE = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 48 or 57 < b < 97 or 122 < b < 128 else b
              for b in range(256))


def words_of(raw: bytes):
    """Lists of the words of a text, in order."""
    raw = raw.translate(TABLE)
    at = 0
    while len(raw) - at > PIECE and (end := raw.find(b" ", at + PIECE)) >= 0:
        yield raw[at:end].split()
        at = end
    yield raw[at:].split()


class Items:
    """One block of test items: the number of each word, every distinct suffix and its windows."""

    def __init__(self, rows: list[tuple], window: int):
        self.number: dict[bytes, int] = {}
        self.ids = [i for i, _ in rows]
        self.window = window
        words, starts, ends, item, at = [], [], [], [], 0
        for k, (_, text) in enumerate(rows):
            own = [self.number.setdefault(w, len(self.number) + 1)
                   for part in words_of((text or "").encode()) for w in part]
            words += own
            starts += range(at, at + len(own))
            ends += [at + len(own)] * len(own)
            item += [k] * len(own)
            at += len(own)
        self.words = np.array([*words, 0], np.int32)
        self.starts, self.ends, self.item = (np.array(x, np.int64) for x in (starts, ends, item))
        left = self.ends - self.starts
        first = np.append(True, self.item[1:] != self.item[:-1])[:len(self.item)]
        #: words of the window that begins here, 0 if none does
        self.length = np.where(left >= window, window, np.where(first, left, 0))
        self.place = self.starts - np.maximum.accumulate(np.where(first, self.starts, 0))
        self.least = int(self.length[self.length > 0].min()) if len(self.length) else 0
        self.longest = int(left.max()) if len(left) else 0
        self.deepest = int(self.length.max(initial=0))
        #: equal windows form a group: its first suffix, its suffixes, its items
        self.group, self.first = np.full(len(self.length), -1), np.zeros(0, np.int64)
        for n in np.unique(self.length[self.length > 0]).tolist():
            own = np.flatnonzero(self.length == n)
            rows = np.lib.stride_tricks.sliding_window_view(self.words, n)[self.starts[own]]
            _, first, group = np.unique(rows, axis=0, return_index=True, return_inverse=True)
            self.group[own] = group.ravel() + len(self.first)
            self.first = np.append(self.first, own[first])
        suffix = np.flatnonzero(self.group >= 0)
        pairs = np.unique(np.stack([self.group[suffix], self.item[suffix]], 1), axis=0)
        self.item_of, bounds = pairs[:, 1], np.arange(len(self.first) + 1)
        self.items_at = np.searchsorted(pairs[:, 0], bounds)


def suffix_array(d: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` sorted by the ``depth`` words from there; only groups that are still equal are
    sorted on. ``d`` ends with ``depth`` zeros."""
    base = int(d.max()) + 1
    step = max(1, min(8, int(62 / max(1, np.log2(base + 1)))))
    order, todo, group = starts.copy(), np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for at in range(0, depth, step):
        if not len(todo):
            break
        key = np.zeros(len(todo), np.int64)
        for k in range(at, min(at + step, depth)):
            key = key * base + d[order[todo] + k]
        sort = np.lexsort((key, group))
        order[todo] = order[todo][sort]
        key, group = key[sort], group[sort]
        new = np.append(True, (key[1:] != key[:-1]) | (group[1:] != group[:-1]))
        group = np.cumsum(new)
        tied = ~new
        tied[:-1] |= ~new[1:]
        todo, group = todo[tied], group[tied]
    return order


def search(d: np.ndarray, array: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """For every distinct window the interval of its places in the array."""
    start, left = items.starts[items.first], items.length[items.first]
    lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(array), np.int64)
    active = np.arange(len(start))
    for depth in range(items.deepest):
        active = active[left[active] > depth]
        if not len(active):
            break
        word = items.words[start[active] + depth]
        low = _bound(d, array, depth, lo[active], hi[active], word)
        lo[active], hi[active] = low, _bound(d, array, depth, low, hi[active], word + 1)
        active = active[hi[active] > lo[active]]
    return lo, hi


def _bound(d, array, depth, lo, hi, word):
    """The first place in each ``[lo, hi)`` whose word at ``depth`` is not below ``word``."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        below = open_ & (d[array[np.minimum(mid, len(array) - 1)] + depth] < word)
        lo = np.where(below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)
    return lo


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first[k], first[k] + 1, ...`` (``count[k]`` of them) of every k, end to end."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _chunks(count: np.ndarray, most: int):
    """Slices of ``count`` whose sums are about ``most``."""
    cut = np.searchsorted(np.cumsum(count), np.arange(most, count.sum() + most, most)) + 1
    edges = np.unique(np.clip(np.concatenate([[0], cut, [len(count)]]), 0, len(count)))
    return [slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def _items_of(owner: np.ndarray, group: np.ndarray, items: Items) -> np.ndarray:
    """Distinct pairs of a text and an item with a window in it."""
    pairs = np.unique(np.stack([owner, group], 1), axis=0)
    count = np.diff(items.items_at)[pairs[:, 1]]
    out = np.zeros((0, 2), np.int64)
    for part in _chunks(count, STARTS):
        own = np.stack([np.repeat(pairs[part, 0], count[part]),
                        items.item_of[_ranges(items.items_at[pairs[part, 1]], count[part])]], 1)
        out = np.unique(np.concatenate([out, own]), axis=0)
    return out


def _matches(d: np.ndarray, place: np.ndarray, group: np.ndarray, items: Items):
    """Longest verbatim matches in portions: (suffix, place, words)."""
    before = np.where(place > 0, d[place - 1], 0).astype(np.int64)
    base = int(d.max(initial=0)) + 2
    key = group * base + before
    order = np.argsort(key, kind="stable")
    place, key = place[order], key[order]
    bounds = np.searchsorted(key, np.arange(len(items.first) + 1) * base)
    suffix = np.flatnonzero((items.group >= 0) & (bounds[1:] > bounds[:-1])[items.group])
    own = items.group[suffix]
    inner = items.place[suffix] > 0                  # a word of the item stands before: equal ones begin no match
    same = own * base + np.where(inner, items.words[items.starts[suffix] - 1], 0)
    skip = np.searchsorted(key, same), np.searchsorted(key, same, "right")
    skip = [np.where(inner, x, bounds[own]) for x in skip]
    count = np.stack([skip[0] - bounds[own], bounds[own + 1] - skip[1]])
    for part in _chunks(count.sum(0), STARTS):
        at = np.concatenate([_ranges(bounds[own[part]], count[0, part]), _ranges(skip[1][part], count[1, part])])
        i = np.concatenate([np.repeat(suffix[part], count[k, part]) for k in (0, 1)])
        p, n = place[at], items.length[i]
        active = np.arange(len(i))
        while len(active):
            j, q = i[active], n[active]
            more = (items.starts[j] + q < items.ends[j]) & (d[p[active] + q] == items.words[np.minimum(items.starts[j] + q, len(items.words) - 1)])
            active = active[more]
            n[active] += 1
        yield i, p, n


def scan_shard(texts: list[np.ndarray], items: Items, details: bool = True) -> list[dict]:
    """For each text (numbers of its words) the hit spans; with ``details`` also the items, the verbatim matches
    and the longest of them."""
    n_words = np.array([len(t) for t in texts], np.int64)
    out = [{"n_words": int(n), "n_hit": 0, "spans": [], "items": [], "matches": [], "longest": 0} for n in n_words]
    if not items.longest or not n_words.sum():
        return out
    pad = np.zeros(items.longest + 1, np.int32)
    d = np.concatenate([x for t in texts for x in (t, pad[:1])] + [pad])    # a zero ends each text
    begin = np.cumsum(n_words + 1) - (n_words + 1)
    zero = np.flatnonzero(d == 0)
    known = zero[np.searchsorted(zero, np.arange(len(d)))] - np.arange(len(d))
    starts = np.flatnonzero(known >= items.least)
    places, groups = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(0, len(starts), SHARD_WORDS):
        array = suffix_array(d, starts[k:k + SHARD_WORDS], items.deepest)
        lo, hi = search(d, array, items)
        found = np.flatnonzero(hi > lo)
        groups.append(np.repeat(found, hi[found] - lo[found]))
        places.append(array[_ranges(lo[found], hi[found] - lo[found])])
    place, group = np.concatenate(places), np.concatenate(groups)
    if not len(place):
        return out
    edge = np.zeros(len(d) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + items.length[items.first[group]], -1)
    hit = np.cumsum(edge[:-1]) > 0
    change = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    for s, e in change.reshape(-1, 2).tolist():
        k = int(np.searchsorted(begin, s, "right")) - 1
        out[k]["n_hit"] += e - s
        out[k]["spans"].append((s - int(begin[k]), e - int(begin[k])))
    if not details:
        return out
    for k, i in _items_of(np.searchsorted(begin, place, "right") - 1, group, items).tolist():
        if items.ids[i] is not None:
            out[k]["items"].append(items.ids[i])
    for o in out:
        o["items"] = sorted(set(o["items"]))
    longest = np.zeros(len(out), np.int64)
    for i, p, n in _matches(d, place, group, items):
        owner = np.searchsorted(begin, p, "right") - 1
        np.maximum.at(longest, owner, n)
        if details == "matches":
            for k, *match in zip(owner.tolist(), items.item[i].tolist(), items.place[i].tolist(), (p - begin[owner]).tolist(), n.tolist()):
                out[k]["matches"].append((items.ids[match[0]], *match[1:]))
    for o, n in zip(out, longest.tolist()):
        o["longest"] = n
        o["matches"].sort(key=lambda m: (m[0] is not None, m[0] if m[0] is not None else 0, m[2] - m[1], m[2]))
    return out


def _blocks(bench: DataFrame, item_col: str, text_col: str, block_chars: int):
    """Test items in hash blocks of about ``block_chars`` characters, collected one at a time."""
    bench = bench.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    total = bench.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_chars))
    for k in range(n):
        own = bench.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) if n > 1 else bench
        yield n, [tuple(r) for r in own.collect()]


def _runner(shared, schema: T.StructType, text_at: int, build, details):
    """A function for ``mapInArrow``: rows are buffered up to a shard, then ``build(rows, results)``
    makes the output batch of each buffered batch."""

    def run(batches):
        items = shared.value
        get, held, texts, size, weight = items.number.get, [], [], 0, 0.0

        def flush():
            got = scan_shard(texts, items, details)
            at = 0
            for b in held:
                yield build(b, got[at:at + b.num_rows])
                at += b.num_rows

        for batch in batches:
            at = 0
            for row, raw in enumerate(raw_texts(batch.column(text_at))):
                parts = [np.fromiter(map(get, w, _zeros()), np.int32, len(w)) for w in words_of(raw)]
                texts.append(np.concatenate(parts))
                size += len(texts[-1])
                weight += batch.nbytes / batch.num_rows
                if size >= SHARD_WORDS or len(texts) >= SHARD_ROWS or weight >= SHARD_BYTES:
                    held.append(batch.slice(at, row + 1 - at))
                    at = row + 1
                    yield from flush()
                    held, texts, size, weight = [], [], 0, 0.0
            if at < batch.num_rows:
                held.append(batch.slice(at))
        yield from flush()

    def _zeros():
        while True:
            yield 0

    return run


def _result_fields(item_type: T.DataType) -> list[tuple[str, T.DataType]]:
    match = T.StructType([T.StructField("item_id", item_type), T.StructField("item_start", T.IntegerType()),
                          T.StructField("doc_start", T.IntegerType()), T.StructField("n_words", T.IntegerType())])
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return [("n_words", T.LongType()), ("n_hit", T.LongType()), ("spans", T.ArrayType(span)),
            ("items", T.ArrayType(item_type)), ("matches", T.ArrayType(match)), ("longest_match", T.LongType())]


def contamination(docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_chars: int = BLOCK_CHARS, with_matches: bool = True) -> DataFrame:
    """One row per document: ``id_col, n_words, n_hit, items`` (ids of items with a window in it),
    ``longest_match`` (words), ``matches`` (item, place in it, place in the document, words; empty without
    ``with_matches``) and ``contaminated``: some words are hit and they are a twentieth of all or more."""
    sc = docs.sparkSession.sparkContext
    fields = _result_fields(bench.schema[item_col].dataType)
    schema = T.StructType([*schema_of(docs, id_col).fields, T.StructField("text_key", T.StringType()),
                           *[T.StructField(n, t) for n, t in fields]])
    spans, parts = _span_type(fields), []
    own = docs.select(F.col(id_col), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("text_key"),
                      F.col(text_col).alias("text"))

    def build(batch, got):
        return batch_of(schema, [batch.column(0), batch.column(1), *_columns(got, spans)])

    n_blocks = 1
    for n_blocks, rows in _blocks(bench, item_col, item_text_col, block_chars):
        shared = sc.broadcast(Items(rows, window))
        source = own if n_blocks > 1 else own.withColumn("text_key", F.lit(None).cast("string"))
        parts.append(source.mapInArrow(_runner(shared, schema, 2, build, "matches" if with_matches else True), schema))
    if n_blocks == 1:
        out = parts[0]
    else:
        out = _united(parts, id_col)
    return out.select(id_col, "n_words", "n_hit", "items", "longest_match", "matches",
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def _span_type(fields) -> pa.DataType:
    return pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _columns(got: list[dict], spans: pa.DataType) -> list:
    return [[g["n_words"] for g in got], [g["n_hit"] for g in got],
            pa.array([[{"start": s, "end": e} for s, e in g["spans"]] for g in got], spans),
            [g["items"] for g in got],
            [[{"item_id": i, "item_start": j, "doc_start": s, "n_words": n} for i, j, s, n in g["matches"]]
             for g in got],
            [g["longest"] for g in got]]


def _united(parts: list[DataFrame], id_col: str) -> DataFrame:
    """The results of several blocks of items as one. Rows with equal id and text are equal in
    every block, so they are grouped by both and their number is kept."""
    every = parts[0].withColumn("block", F.lit(0))
    for k, p in enumerate(parts[1:], 1):
        every = every.unionByName(p.withColumn("block", F.lit(k)))
    one = every.groupBy(id_col, "text_key", "block").agg(
        F.first("n_words").alias("n_words"), F.first("spans").alias("spans"), F.first("items").alias("items"),
        F.first("matches").alias("matches"), F.first("longest_match").alias("longest_match"),
        F.count(F.lit(1)).alias("rows"))
    doc = one.groupBy(id_col, "text_key").agg(
        F.first("n_words").alias("n_words"), F.first("rows").alias("rows"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("matches")).alias("matches"), F.max("longest_match").alias("longest_match"))
    # length of the union of sorted spans
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))
    joined = F.aggregate("spans", start, lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["hit"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(s["start"], a["end"]))).alias("hit")),
        lambda a: a["hit"])
    return (doc.withColumn("n_hit", joined)
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))))


def decontaminate(docs: DataFrame, bench: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns. With one block of
    items the rows pass through the search as they are; with more, the verdicts are joined by text."""
    sc = docs.sparkSession.sparkContext
    blocks = _blocks(bench, item_col, item_text_col, block_chars)
    n_blocks, rows = next(blocks)
    if n_blocks == 1:
        shared = sc.broadcast(Items(rows, window))

        def build(batch, got):
            keep = [not (g["n_hit"] > 0 and 20 * g["n_hit"] >= g["n_words"]) for g in got]
            return batch.filter(pa.array(keep, pa.bool_()))

        return docs.mapInArrow(_runner(shared, docs.schema, docs.columns.index(text_col), build, False), docs.schema)
    key = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    texts = docs.select(key.alias("key_"), F.col(text_col).alias("text_"))
    verdict = contamination(texts, bench, id_col="key_", text_col="text_", item_col=item_col,
                            item_text_col=item_text_col, window=window, block_chars=block_chars, with_matches=False)
    bad = verdict.where("contaminated").select("key_").distinct()
    return docs.join(bad, key == bad["key_"], "left_anti")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = contamination(read(spark, sf_dir, "documents", "doc_id", "text"),
                        read(spark, sf_dir, "benchmark", "item_id", "text"), with_matches=False)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(names, 256).alias("items_sha256"), "contaminated", "longest_match")


#: Windows of a length are compared as joined words; every length of an item's window is tried.
SQL = """
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, i, n, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths WHERE len(w) >= n)),
found AS (SELECT p.r, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.g = x.g),
hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY r),
run_length AS (SELECT r, max(n) AS longest FROM (
  SELECT r, item_id, part, max(i + n) - min(i) AS n FROM (
    SELECT r, item_id, i, n, q, i - row_number() OVER (PARTITION BY r, item_id, i - q ORDER BY i) AS part, i - q AS diag
    FROM (SELECT DISTINCT p.r, p.i, p.n, x.item_id, x.q FROM places p JOIN (
      SELECT item_id, i AS q, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item_words WHERE len(w) > 0)
    ) x ON p.n = x.n AND p.g = x.g))
  GROUP BY r, item_id, diag, part) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated,
       CAST(coalesce(longest, 0) AS BIGINT) AS longest_match
FROM doc_words d LEFT JOIN hits USING (r) LEFT JOIN named USING (r) LEFT JOIN run_length USING (r)
"""
