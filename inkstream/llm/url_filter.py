"""URL filter: explicit rules, then boosted trees on lexical features.

A rule (verdict, host, path) fits its host and all subdomains if the url's path starts with the
rule's; the longest rule wins (of equal length, block). Urls that no rule judges get the verdict of
boosted trees trained on labelled urls; the urls that rules judge are the labelled ones here, or any
table of urls and labels.

Features: lengths of url, host, path and query, depth, labels of the host, digit ratios, character
entropy, numbers of parameters and of special characters, longest runs, and suffix statistics: how
often labelled urls with this host ending (one and two labels) are blocked, counted over all labelled
urls in ``BUCKETS`` hashed cells, so the table is bounded.

Rules and labels are column expressions; the trees see at most ``SAMPLE`` labelled urls (smallest
hash), a documented bound. Row-local but for the suffix counts, which are aggregated before the shuffle.

Cases: a null url, or one without ``://``, has empty host and path, fits no rule and is judged by the
trees like any other; very long urls are read whole; repeated rows give one result each; null ids stay;
with labels of one kind only (or none) the trees allow or block by that share; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.llm import boosting
from inkstream.llm.common import batch_of, hashed_sample, read, schema_of, str_texts

#: Rules of the registered query.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
SAMPLE = 20_000
BUCKETS = 4096
CUT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null."""
    order = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), r[0] != "block", r))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in reversed(order):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def split(url: str) -> tuple[str, str, str]:
    """Host, path and the rest of a url."""
    _, sep, rest = url.partition("://")
    if not sep:
        return "", "", url
    m = re.match(r"([^/?#]*)([^?#]*)(.*)", rest, re.S)
    return m[1].lower(), m[2], m[3]


def endings(host: str) -> tuple[int, int]:
    labels = host.split(".")
    return tuple(zlib.crc32(".".join(labels[-n:]).encode()) % BUCKETS for n in (1, 2))


def entropy(s: str) -> float:
    if not s:
        return 0.0
    n = np.unique(np.frombuffer(s.encode(), np.uint8), return_counts=True)[1] / len(s.encode())
    return float(-(n * np.log2(n)).sum())


def lexical(url: str, rates: np.ndarray) -> list[float]:
    host, path, rest = split(url)
    query = rest.partition("#")[0]
    segments = [s for s in path.split("/") if s]
    digits = sum(map(str.isdigit, url))
    a, b = endings(host)
    return [len(url), len(host), len(path), len(query), len(segments), host.count("."), host.count("-"),
            digits / max(1, len(url)), sum(map(str.isdigit, host)) / max(1, len(host)),
            sum(map(str.isdigit, path)) / max(1, len(path)), entropy(url), entropy(host), entropy(path),
            query.count("=") + query.count("&"), float("#" in rest), float(path.endswith("/")), float("." in path[-6:]),
            float(url[:5].lower() == "https"), max(map(len, segments), default=0), max(map(len, host.split("."))),
            len(segments[0]) if segments else 0, entropy(segments[0]) if segments else 0.0,
            sum(map(ord, segments[0])) % 997 if segments else 0,
            int(segments[-1][:1]) if segments and segments[-1][:1].isascii() and segments[-1][:1].isdigit() else -1,
            sum(c in "%@~_+" for c in url), float(rates[a]), float(rates[b])]


@dataclass
class Model:
    trees: boosting.Trees
    rates: np.ndarray


def train(labelled: DataFrame, *, url_col: str = "url", label_col: str = "blocked", sample: int = SAMPLE) -> Model:
    """Trees from urls and labels (true: blocked). The sample is of distinct urls; one that repeats n times weighs
    1 + log(n), so that it counts more than others but doesn't outweigh them all."""
    rows = labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("int").alias("y")).dropna()

    def count(batches):
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for url, y in zip(str_texts(batch.column(0)), batch.column(1).to_pylist()):
                for e in set(endings(split(url)[0])):
                    seen[int(y > 0), e] += 1
        e = np.flatnonzero(seen.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(e.astype(np.int32)), pa.array(seen[0, e]), pa.array(seen[1, e])],
                                         ["e", "a", "b"])

    rates = np.full(BUCKETS, 0.5)
    for e, a, b in rows.mapInArrow(count, "e int, a long, b long").groupBy("e").agg(F.sum("a"), F.sum("b")).collect():
        rates[e] = (b + 1) / (a + b + 2)
    distinct = rows.groupBy("url", "y").agg(F.count("*").alias("n"))
    some = hashed_sample(distinct, ["url", "y"], sample).toPandas()
    if not len(some):
        return Model(boosting.fit(np.zeros((0, 1)), np.zeros(0)), rates)
    x = np.array([lexical(u, rates) for u in some.url]).reshape(len(some), -1)
    y, n = some.y.to_numpy(), 1 + np.log(some.n.to_numpy(np.float64))
    held = np.array([zlib.crc32(u.encode()) % 5 == 0 for u in some.url], bool)
    if len(set(y[~held].tolist())) < len(set(y.tolist())):
        held[:] = False                              # too few distinct urls to keep some apart
    trees = boosting.fit(x[~held], y[~held], weight=n[~held])
    if held.any() and 0 < y[held].sum() < held.sum():
        trees.calibrate(x[held], y[held], weight=n[held])
    return Model(trees, rates)


def judge(pages: DataFrame, model: Model, *, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          cut: float = CUT) -> DataFrame:
    """``id_col, host, path, rule, verdict, p_block``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    own = pages.select(F.col(id_col), F.col(url_col).alias("url_"))
    schema = T.StructType([*schema_of(pages, id_col).fields, T.StructField("url_", T.StringType()),
                           T.StructField("p_block", T.DoubleType())])

    def run(batches):
        for batch in batches:
            m = shared.value
            x = np.array([lexical(u, m.rates) for u in str_texts(batch.column(1))])
            yield batch_of(schema, [batch.column(0), batch.column(1), m.trees.probability(x)])

    rows = own.mapInArrow(run, schema).withColumn("host", host_of(F.col("url_"))).withColumn("path", path_of(F.col("url_")))
    rows = rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    by_trees = F.when(F.col("p_block") >= cut, "block").otherwise("allow")
    return rows.select(id_col, "host", "path", F.col("hit.rule").alias("rule"),
                       F.coalesce(F.col("hit.verdict"), by_trees).alias("verdict"), "p_block")


def ruled(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """The urls that a rule judges, labelled by it."""
    u = F.col(url_col)
    hit = rule_of(host_of(u), path_of(u), rules)
    return pages.select(u.alias("url"), hit.alias("hit")).where("hit IS NOT NULL").select(
        "url", (F.col("hit.verdict") == "block").alias("blocked"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    return judge(pages, train(ruled(pages)))
