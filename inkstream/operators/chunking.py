"""Chunking (A1..A4, A6): all row-local higher-order column expressions, no shuffle.

A1  section_split   split on blank lines keeping the separator at the start of the next piece,
                    then greedily merge pieces while the merged text stays within 500 characters;
                    a piece of 500+ characters is flushed on its own, unstripped (a fold over the
                    pieces with ``aggregate``).
A2  token_windows   whitespace tokens, windows of 256 with 50 overlap (stride 206); window k starts at
                    206*k and the last window is the first one reaching the end.
A3  chunk_text      A1 then A2 per section, concatenated.
A4  chunk_rows      one row per chunk with ``chunk_id = md5(chunk)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstream.functions.text import _q, py_strip, py_strip_sql

# Fixed values of the reference's splitters.
SECTION_SEPARATOR = "\n\n"
SECTION_CHARS = 500
WINDOW_TOKENS = 256
WINDOW_OVERLAP = 50
TOKEN_SPLIT = r"[\t\n\f\r ]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------------- A1
def section_pieces(text) -> Column:
    parts = F.split(_c(text), r"\n\n")
    kept = F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(SECTION_SEPARATOR), p)))
    return F.array_remove(kept, "")


def section_split(text, size: int = SECTION_CHARS) -> Column:
    init = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"), F.lit(0).alias("n"))

    def flush(acc):
        s = py_strip(acc["cur"])
        return F.when((acc["n"] > 0) & (s != ""), F.array_append(acc["out"], s)).otherwise(acc["out"])

    def step(acc, p):
        small = F.length(p) < size
        overflow = (acc["n"] > 0) & (F.length(acc["cur"]) + F.length(p) > size)
        out = F.when(small & overflow, flush(acc)).when(small, acc["out"]).otherwise(F.array_append(flush(acc), p))
        cur = F.when(small & overflow, p).when(small, F.concat(acc["cur"], p)).otherwise(F.lit(""))
        n = F.when(small & overflow, F.lit(1)).when(small, acc["n"] + 1).otherwise(F.lit(0))
        return F.struct(out.alias("out"), cur.alias("cur"), n.alias("n"))

    return F.aggregate(section_pieces(text), init, step, flush)


def section_split_cte(src: str, id_cols: str, text_expr: str, size: int = SECTION_CHARS) -> str:
    """DuckDB recursive CTE body computing (id_cols..., sections) for every row of ``src``."""
    pieces = (f"list_filter(list_transform(string_split({text_expr}, chr(10) || chr(10)), "
              f"lambda p, i: CASE WHEN i = 1 THEN p ELSE chr(10) || chr(10) || p END), lambda p: p <> '')")
    p = "ps[i + 1]"
    s = py_strip_sql("cur")
    small = f"(length({p}) < {size})"
    over = f"(n > 0 AND length(cur) + length({p}) > {size})"
    flush = f"(CASE WHEN n > 0 AND {s} <> '' THEN list_append(out, {s}) ELSE out END)"
    return f"""
  SELECT {id_cols}, ps, 0 AS i, CAST([] AS VARCHAR[]) AS out, '' AS cur, 0 AS n
  FROM (SELECT {id_cols}, {pieces} AS ps FROM {src})
  UNION ALL
  SELECT {id_cols}, ps, i + 1,
         CASE WHEN {small} AND {over} THEN {flush} WHEN {small} THEN out ELSE list_append({flush}, {p}) END,
         CASE WHEN {small} AND {over} THEN {p} WHEN {small} THEN cur || {p} ELSE '' END,
         CASE WHEN {small} AND {over} THEN 1 WHEN {small} THEN n + 1 ELSE 0 END
  FROM sec_fold WHERE i < len(ps)"""


def section_final_sql(id_cols: str) -> str:
    s = py_strip_sql("cur")
    return (f"SELECT {id_cols}, CASE WHEN n > 0 AND {s} <> '' THEN list_append(out, {s}) ELSE out END AS sections "
            f"FROM sec_fold WHERE i = len(ps)")


# ----------------------------------------------------------------------------- A2
def window_count(n: Column, size: int, overlap: int) -> Column:
    stride = size - overlap
    return (F.when(n <= 0, F.lit(0)).when(n <= size, F.lit(1))
            .otherwise(F.ceil((n - size) / F.lit(stride)).cast("int") + 1))


def tokens_of(text) -> Column:
    return F.array_remove(F.split(_c(text), TOKEN_SPLIT), "")


def windows_of_tokens(toks: Column, size: int = WINDOW_TOKENS, overlap: int = WINDOW_OVERLAP) -> Column:
    """Windows over an already split token array. ``toks`` should be a column or a lambda variable:
    Spark re-evaluates expressions captured by a lambda for every element, so never pass the
    splitting expression itself."""
    k = window_count(F.size(toks), size, overlap)
    stride = size - overlap
    wins = F.transform(F.sequence(F.lit(0), k - 1),
                       lambda j: F.array_join(F.slice(toks, j * stride + 1, F.lit(size)), " "))
    return F.when(k > 0, wins).otherwise(F.array().cast("array<string>"))


def token_windows(text, size: int = WINDOW_TOKENS, overlap: int = WINDOW_OVERLAP) -> Column:
    # split once, bind the result to a lambda variable, then cut windows from it
    return F.element_at(F.transform(F.array(tokens_of(text)),
                                    lambda toks: windows_of_tokens(toks, size, overlap)), 1)


def tokens_sql(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {_q(TOKEN_SPLIT)}), lambda t: t <> '')"


def token_windows_sql(e: str, size: int = WINDOW_TOKENS, overlap: int = WINDOW_OVERLAP) -> str:
    stride = size - overlap
    toks = tokens_sql(e)
    n = f"len({toks})"
    k = (f"(CASE WHEN {n} <= 0 THEN 0 WHEN {n} <= {size} THEN 1 "
         f"ELSE CAST(ceil(({n} - {size}) / {stride}) AS INTEGER) + 1 END)")
    return (f"list_transform(range({k}), lambda j: array_to_string(list_slice({toks}, j * {stride} + 1, "
            f"j * {stride} + {size}), ' '))")


# ----------------------------------------------------------------------------- A3, A4
def chunk_text(text) -> Column:
    per_section_tokens = F.transform(section_split(text), lambda s: tokens_of(s))
    return F.flatten(F.transform(per_section_tokens, lambda toks: windows_of_tokens(toks)))


def chunk_rows(cleaned: DataFrame, text_col: str = "cleaned_content",
               keep: tuple[str, ...] = ("entry_id", "title", "published_at")) -> DataFrame:
    """One row per chunk: keep columns + chunk_no, chunk_id (md5 of the chunk), chunk_content."""
    return (cleaned.select(*keep, F.posexplode(chunk_text(text_col)).alias("chunk_no", "chunk_content"))
            .select(*keep, F.col("chunk_no").cast("bigint").alias("chunk_no"),
                    F.md5("chunk_content").alias("chunk_id"), "chunk_content"))
