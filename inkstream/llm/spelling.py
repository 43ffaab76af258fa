"""Spelling variants grouped with k-d trees over letter counts.

Words are runs of Latin letters, counted over all documents. A word becomes the vector of its letter counts.
One edit moves that vector by an L1 distance of at most two: a replacement takes one letter and adds another,
an insertion adds one, a deletion takes one. So words of length L are near only words of lengths L - 1, L, L + 1,
and each length pair is a range search with at most one letter more and one less.

1. Words of one length form one tree. Its upper levels, fitted on at most ``SAMPLE`` words of that length and
   broadcast, cut the words into cells of about ``CELL``; a split node holds a letter and a count. Every word
   goes to its cell as a member, and, as a query, to all cells of the three lengths whose box its range meets.
2. A task reads the members of a cell, builds the lower levels down to leaves of ``LEAF`` words, then lets the
   queries stream past: boxes out of range are pruned, leaves are compared by the parities of letter counts, and
   the letter order of what is left is verified. One row goes out per query and cell: how many near words, and
   the most frequent of them.
3. Cells that hold more members than ``CELL`` (words of one letter multiset can't be split, samples err) are read in
   blocks, each met by all queries; queries of crowded cells are dealt to several readers of the same members.
4. Rows of a word are added up; a word's form is its most frequent near word if that is at least twice as frequent.
   Counts at least double along forms, so chains are short; roots come from pointer doubling.

The trees and the plan of cells are of bounded size (``SAMPLE`` words a length; one entry per ``CELL`` words).

Cases: null and empty texts have no words; a null id counts as the empty text; repeated rows count again; equal
frequencies go to the word smallest in code-point order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstream.llm.common import cell_runs, dealt_cells, materialize, read

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
CELL = 16384             # members of a cell that a task holds
QUERIES = 400_000        # queries of a cell that a task answers
LEAF = 48
SAMPLE = 20_000          # words of a length on which the upper levels are fitted
LETTERS = np.zeros(256, np.int64)                    # dimension of each Latin-1 letter
LETTERS[97:123], LETTERS[192:256] = np.arange(26), np.arange(26, 90)
DIMENSIONS = 90


# ---------------------------------------------------------------------- words
def counted_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", noise: int | None = None,
                  least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the runs, A-Z lower-cased, that are long and frequent enough. With ``noise`` a run whose
    crc32 of ``<id>:<run>`` that number divides loses the letter at crc32 % length."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    runs = (runs.where(F.char_length("run") >= least_length)           # a run never becomes longer
            .select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run")))
    word: Column = F.col("run")
    if noise:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        word = F.when(F.col("h") % noise == 0,
                      F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))).otherwise(word)
    words = runs.select(word.alias("word")).where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def letter_codes(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    n, length = codes.shape
    flat = (np.arange(n)[:, None] * DIMENSIONS + LETTERS[codes]).ravel()
    return np.bincount(flat, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS).astype(np.int32)


def parities(counts: np.ndarray) -> np.ndarray:
    """64 bits a word, each the parity of one or two letters' counts."""
    odd = (counts & 1).astype(np.uint64)
    bits = odd[:, :64].copy()
    bits[:, :DIMENSIONS - 64] ^= odd[:, 64:]
    return bits @ (np.uint64(1) << np.arange(64, dtype=np.uint64))


# ---------------------------------------------------------------------- trees
class KdTree:
    """Splits by one letter's count: up to ``bound`` left, more right."""

    def __init__(self, counts: np.ndarray, leaf: int):
        self.letter, self.bound, self.left, self.right = [], [], [], []
        self.leaves: list[np.ndarray] = []           # rows of each leaf
        todo = [(np.arange(len(counts)), None)]
        while todo:
            rows, link = todo.pop()
            node = len(self.letter)
            if link:
                link[0][link[1]] = node
            split = self._split(counts[rows]) if len(rows) > leaf else None
            self.letter.append(-1 if split is None else split[0])
            self.bound.append(0 if split is None else split[1])
            self.left.append(len(self.leaves) if split is None else 0)   # a leaf's number stands there
            self.right.append(0)
            if split is None:
                self.leaves.append(rows)
                continue
            low = counts[rows, split[0]] <= split[1]
            todo += [(rows[~low], (self.right, node)), (rows[low], (self.left, node))]

    @staticmethod
    def _split(c: np.ndarray) -> tuple[int, int] | None:
        """The letter and bound that halve the rows best; none if all vectors are equal."""
        best = (0, 0, 0)
        for bound in (0, 1, 2):
            low = (c <= bound).sum(0)
            even = np.minimum(low, len(c) - low)
            letter = int(even.argmax())
            best = max(best, (int(even[letter]), letter, bound))
        if not best[0]:                              # all differences lie above: split at a mean
            letter = int((c.max(0) - c.min(0)).argmax())
            bound = int(c[:, letter].mean())
            best = (int((c[:, letter] > bound).sum()), letter, bound)
        return best[1:] if best[0] else None

    def search(self, counts: np.ndarray, more: int, less: int):
        """(leaf, query rows): the leaves whose box holds a vector with at most ``more`` letters more and
        ``less`` fewer than the query (each 0 or 1)."""
        n = len(counts)
        todo = [(0, np.arange(n), np.full(n, more, np.int8), np.full(n, less, np.int8))]
        while todo:
            node, q, up, down = todo.pop()
            if not len(q):
                continue
            if self.letter[node] < 0:
                yield self.left[node], q
                continue
            x, bound = counts[q, self.letter[node]], self.bound[node]
            over, under = x == bound + 1, x == bound
            low = (x <= bound) | (over & (down > 0))
            high = (x > bound) | (under & (up > 0))
            todo.append((self.left[node], q[low], up[low], (down - over)[low]))
            todo.append((self.right[node], q[high], (up - under)[high], down[high]))


def _apart(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether each row of ``long`` is the row of ``short`` with one letter put in."""
    n, length = short.shape
    before = short != long[:, :-1]
    first = np.where(before.any(1), before.argmax(1), length)            # the first difference
    after = (short != long[:, 1:]) & (np.arange(length) >= first[:, None])
    return ~after.any(1)


class Members:
    """The members of a cell (or a block of one), all of one length."""

    def __init__(self, words: list[bytes], n: np.ndarray, length: int):
        order = np.lexsort((np.array(words, object), -n))                # best form first
        self.words, self.n = [words[i] for i in order], n[order]
        self.length = length
        self.codes = letter_codes(self.words, length)
        counts = letter_counts(self.codes)
        self.tree, self.parity = KdTree(counts, LEAF), parities(counts)

    def near(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query: how many members are one edit away, and the best of them (-1: none)."""
        counts, change = letter_counts(codes), codes.shape[1] - self.length
        parity = parities(counts)
        number, best = np.zeros(len(codes), np.int64), np.full(len(codes), len(self.words), np.int64)
        for leaf, q in self.tree.search(counts, int(change <= 0), int(change >= 0)):
            rows = self.tree.leaves[leaf]
            i, j = np.nonzero(np.bitwise_count(parity[q][:, None] ^ self.parity[rows]) <= 2 - abs(change))
            i, j = q[i], rows[j]
            mine, other = codes[i], self.codes[j]
            if change == 0:
                ok = (mine != other).sum(1) == 1
            else:
                ok = _apart(mine, other) if change < 0 else _apart(other, mine)
            np.add.at(number, i[ok], 1)
            np.minimum.at(best, i[ok], j[ok])
        return number, np.where(number > 0, best, -1)


# ---------------------------------------------------------------------- cells
def _forest(words: DataFrame) -> dict[int, KdTree | None]:
    """Upper levels of the tree of each length; none where one cell is enough."""
    sizes = {r[0]: r[1] for r in words.groupBy("length").count().collect()}   # one row a length
    large = {k: n for k, n in sizes.items() if n > CELL}
    forest: dict[int, KdTree | None] = dict.fromkeys(sizes)
    if large:
        span = 1 << 30
        cut = F.create_map(*[F.lit(x) for k, n in large.items() for x in (k, int(min(1.0, SAMPLE / n) * span))])
        some = words.where(F.pmod(F.xxhash64("word"), F.lit(span)) < cut[F.col("length")]).select("word", "length").collect()
        for k, n in large.items():
            sample = [r.word.encode("latin-1") for r in some if r.length == k]
            if sample:
                cells = -(-n // CELL)
                forest[k] = KdTree(letter_counts(letter_codes(sample, k)), max(1, len(sample) // cells))
    return forest


def _by_length(words: list[bytes]):
    size = np.array(list(map(len, words)))
    for k in np.unique(size).tolist():
        rows = np.flatnonzero(size == k)
        yield k, rows, letter_codes([words[i] for i in rows], k)


def _route(words: DataFrame, shared) -> DataFrame:
    """``tree, cell, asks, word, n``: every word as a member of its own cell (asks false) and as a query of all
    cells that its range meets (asks true)."""
    def run(batches):
        forest = shared.value
        for batch in batches:
            text = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            for k, rows, codes in _by_length(text):
                counts = letter_counts(codes)
                for length, more, less, asks in ((k, 0, 0, False), (k, 1, 1, True), (k + 1, 1, 0, True), (k - 1, 0, 1, True)):
                    if length not in forest:
                        continue
                    tree = forest[length]
                    for cell, q in tree.search(counts, more, less) if tree else [(0, np.arange(len(rows)))]:
                        at = pa.array(rows[q])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(q), length, np.int32)), pa.array(np.full(len(q), cell, np.int32)),
                             pa.array(np.full(len(q), asks)), batch.column(0).take(at), batch.column(1).take(at)],
                            ["tree", "cell", "asks", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "tree int, cell int, asks boolean, word string, n long")


def _answers(batches):
    """Rows come by cell, block and turn, members before queries."""
    key, held, counts, members = None, [], [], None
    for now, asks, rows in cell_runs(batches, 4):
        if now != key:
            key, held, counts, members = now, [], [], None
        words = rows.column(5)
        text = [w.encode("latin-1") for w in words.to_pylist()]
        if not asks:
            held += text
            counts.append(rows.column(6).to_numpy(zero_copy_only=False))
            continue
        if members is None and held:
            members = Members(held, np.concatenate(counts), key[0])
            held, counts = [], []
        for _, at, codes in _by_length(text) if members else ():
            number, best = members.near(codes)
            hit = np.flatnonzero(number)
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(at[hit])), pa.array(number[hit]), pa.array(members.n[best[hit]]),
                 pa.array([members.words[i].decode("latin-1") for i in best[hit]], pa.string())],
                ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best, best_n`` for every word of ``words`` (``word, n``) that has a near one."""
    words = words.withColumn("length", F.char_length("word"))
    shared = words.sparkSession.sparkContext.broadcast(_forest(words))
    routed = materialize(_route(words, shared), "spelling-routed")
    placed = dealt_cells(routed, ["tree", "cell"], CELL, QUERIES, F.xxhash64("word"))
    found = placed.mapInArrow(_answers, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n")))


def _roots(links: DataFrame) -> DataFrame:
    """``word, root``: where following ``form`` from each word of ``links`` ends."""
    roots = materialize(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not roots.where("moved").isEmpty():
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(roots.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
    return roots.select("word", "root")


def variants(words: DataFrame, *, times: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every row of ``words`` (distinct ``word`` with its ``n``)."""
    words = materialize(words.select("word", "n"), "spelling-words")
    good = F.col("best_n") >= times * F.col("n")
    named = words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"))
    named = materialize(named, "spelling-forms")
    roots = _roots(named.where("form IS NOT NULL"))
    return named.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = counted_words(read(spark, sf_dir, "documents", "doc_id", "text"), noise=97)
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


#: Near words are found through a letter left out of one or both; their distance is taken on one-byte letters.
SQL = r"""
WITH RECURSIVE bits AS (SELECT i, CAST(i AS UBIGINT) AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
coded AS (SELECT run, id || ':' || run AS s FROM runs WHERE length(run) >= 5),
hashed AS (SELECT run, xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(s, ''),
      lambda ch: CASE WHEN ord(ch) < 128 THEN [ord(ch)::UBIGINT] ELSE [195::UBIGINT, (ord(ch) - 64)::UBIGINT] END))),
    lambda a, b: xor(a >> 8, t[CAST((xor(a, b) & 255) AS BIGINT) + 1])), 4294967295::UBIGINT) AS h FROM coded, tab),
words AS (SELECT CASE WHEN h % 97 = 0
    THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed),
counted AS (SELECT word, count(*) AS n, translate(word, 'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ',
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!"#$%&()*+,-./:;<=>?@[]^_`{|') AS w
  FROM words WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
short AS (SELECT word, n, w, w AS key FROM counted
  UNION SELECT word, n, w, substr(w, 1, i - 1) || substr(w, i + 1) FROM counted, range(1, length(w) + 1) t(i)),
pairs AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM short a JOIN short b ON a.key = b.key
  WHERE a.word <> b.word AND levenshtein(a.w, b.w) = 1),
best AS (SELECT word, n, count(*) AS n_near, max(other_n) AS best_n FROM pairs GROUP BY word, n),
forms AS (SELECT c.word, c.n, coalesce(b.n_near, 0) AS n_near,
    (SELECT min(p.other) FROM pairs p WHERE p.word = b.word AND p.other_n = b.best_n AND b.best_n >= 2 * b.n) AS form,
    CASE WHEN b.best_n >= 2 * b.n THEN b.best_n END AS form_n
  FROM counted c LEFT JOIN best b USING (word)),
chain AS (SELECT word, word AS at FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.at WHERE e.form IS NULL
"""
