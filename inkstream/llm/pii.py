"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Base spans (e-mail, ip, card, phone) are found by their fixed patterns and always stay. Beside
them, high-recall generators propose overlapping candidate spans of every kind: addresses written
with "at" and "dot", any run of digits in groups, dotted quads with odd separators. Boosted trees score each
candidate from its format (digits, groups, separators, check sum, length) and its context (characters
around it, cue words before it); a calibrated threshold per kind, set for a precision, selects the
ones to add. Of overlapping selected candidates the likeliest stays, and none overlaps a base span.

The trees learn from the data itself: base spans are positives, other candidates negatives; each base
span is also rewritten the way people obscure it (other separators, no country code, "at" and "dot")
as a further positive, and with broken digits as a negative. All documents are searched for such spans;
of each kind and label the trees get a bounded sample (``SAMPLE``, smallest hash of document and span).
Calibration and thresholds come from all spans of a fold (a hash of the text) that was not fitted, as
counts by kind, label and score. Learning reads the texts three times (counts, sample, scores) and
shuffles only counts; finding and redacting is row-local.

Cases: null and empty texts have no spans; very long texts are searched whole, in linear time;
repeated rows give one result each; null ids stay; an empty table or one without personal data gives
trees that add nothing; other columns are ignored, or kept where texts are redacted.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.llm import boosting
from inkstream.llm.common import batch_of, read, schema_of, str_texts, with_new_text

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 4000            # spans of each kind and label the trees learn from
STEPS, REACH = 64, 16    # score histogram: steps in a unit of the log odds, and how far it goes
PRECISION = 0.98
CONTEXT = 24             # characters looked at on either side

# ------------------------------------------------------------------ base spans
#: The patterns of the base spans. Possessive runs and the look-behinds spare the
#: search places from which a match is impossible; they find the same spans.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ in turn takes the run of local characters before it and the dotted names after it."""
    out, end, before = [], 0, 0
    at = text.find("@")
    while at >= 0:
        left = text[max(end, before):at]
        run = len(left) - len(left.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if run else None
        if m:
            out.append((at - run, m.end()))
            end = m.end()
        before = at + 1
        at = text.find("@", max(before, end))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        d = only_digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(only_digits(m[0])) <= 15:
                out["phone"].append(m.span())
    return out


# ------------------------------------------------------------------ candidates
GENERATORS = {
    "email": re.compile(r"[\w.%+-]{1,64}\s?(?:@|\(at\)|\[at\]|\s at\s)\s?[\w-]{1,64}(?:\s?(?:\.|\(dot\)|\[dot\]|\sdot\s)\s?[\w-]{2,24}){1,4}", re.I),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\[\.\]|,|\s\.\s)[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ .\-/_]{0,2}[0-9]){14,18}(?![0-9])"),
    "phone": re.compile(r"(?<![\w.])(?:\+|00|\()?[0-9](?:[ ().\-/]{0,2}[0-9]){7,14}(?![0-9])"),
}
#: What must stand in a text for a generator to be tried.
QUICK = {"email": re.compile(r"@|\bat\b|[(\[]at[)\]]", re.I), "ip": re.compile(r"[0-9]"),
         "card": re.compile(r"[0-9]"), "phone": re.compile(r"[0-9]")}
CUES = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "addr"),
        "card": ("card", "visa", "credit", "pay"), "phone": ("phone", "tel", "call", "fax", "mobile")}


def candidates(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in GENERATORS.items():
        if QUICK[kind].search(text):
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    s, before, after = text[start:end], text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    groups = re.findall(r"[0-9]+", s)
    digits = "".join(groups)
    seps = set(re.sub(r"[\w]", "", s))
    cue = before.lower()
    names = re.split(r"\.|\(dot\)|\[dot\]|\sdot\s", s)
    return [
        KINDS.index(kind), len(s), len(digits), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), len(set(map(len, groups))), len(seps), sum(c.isalpha() for c in s),
        float(bool(digits) and luhn(digits)), float(len(groups) == 4 and all(len(g) < 4 and int(g) <= 255 for g in groups)),
        float(s[:1] == "+"), float(s[:2] == "00"), float("(" in s), s.count("."), s.count("-"), s.count(" "), s.count("@"),
        float(bool(re.search(r"[(\[](?:at|dot)[)\]]", s, re.I))), float(" at " in s.lower()), float(" dot " in s.lower()),
        len(names[-1]) if names else 0, len(set(digits)), float(digits[:1] in ("3", "4", "5", "6")),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:].isspace() or not before),
        float(before[-1:] in ("\"", "'", "=", "/", "#", "$")), float(after[:1] in (".", ",", ";", "%", "\"", "")),
        sum(c in cue for c in CUES[kind]), sum(c in cue for k in KINDS if k != kind for c in CUES[k]),
        sum(c.isdigit() for c in before[-8:]), sum(c.isdigit() for c in after[:8]),
    ]


def variants(kind: str, s: str) -> list[tuple[str, int]]:
    """Rewritings of a base span: obscured ones (1) and broken ones (0)."""
    d = only_digits(s)
    if kind == "email":
        name, _, host = s.partition("@")
        return [(f"{name} at {host.replace('.', ' dot ')}", 1), (f"{name}(at){host}", 1),
                (f"{name} [at] {host.replace('.', '[dot]')}", 1), (f"{name} at {host.split('.')[0]}", 0)]
    if kind == "ip":
        return [(s.replace(".", "[.]"), 1), (s.replace(".", ","), 0), (".".join("9" + p.zfill(2) for p in s.split(".")), 0)]
    if kind == "card":
        spaced = [d[i:i + 4] for i in range(0, len(d), 4)]
        broken = d[:-1] + str((int(d[-1]) + 5) % 10)
        return [(".".join(spaced), 1), ("/".join(spaced), 1), (broken, 0), (" ".join(broken[i:i + 4] for i in range(0, len(d), 4)), 0)]
    return [("00" + s[1:], 1), (f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", 1), (f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}", 1), (d[-8:], 0), (d[::-1], 0)]


def spans_to_learn(text: str) -> list[tuple[str, int, str, int, int]]:
    """Labelled candidates of a text and of its rewritten base spans: kind, label, the text or, for a
    rewriting, its surroundings, start and end there."""
    base, out = base_spans(text), []
    exact = {k: set(v) for k, v in base.items()}
    taken = sorted(s for spans in base.values() for s in spans)
    begins, ends = [a for a, _ in taken], np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
    for kind, s, e in candidates(text):
        n = bisect.bisect_left(begins, e)              # base spans that begin before the end
        if (s, e) in exact[kind] or not (n and ends[n - 1] > s):
            out.append((kind, int((s, e) in exact[kind]), text, s, e))
    for kind, spans in base.items():
        for s, e in spans:
            before, after = text[max(0, s - CONTEXT):s], text[e:e + CONTEXT]
            for new, label in variants(kind, text[s:e]):
                out.append((kind, label, before + new + after, len(before), len(before) + len(new)))
    return out


def lessons(text: str) -> list[tuple[list[float], int]]:
    """``spans_to_learn`` as features and label."""
    return [(describe(t, kind, s, e), y) for kind, y, t, s, e in spans_to_learn(text)]


def held_out(text: str) -> bool:
    return int(hashlib.md5(text.encode()).hexdigest()[:4], 16) % 4 == 0


@dataclass
class Model:
    trees: boosting.Trees
    least: dict[str, float]      # threshold of each kind


def sampled(own: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of about ``sample`` spans of each kind and label, from all texts of ``own`` (h,
    text) that are not held out: at first the counts, then the spans under the hash cut they give."""
    def count(batches):
        n = np.zeros(2 * len(KINDS), np.int64)
        for batch in batches:
            for t in str_texts(batch.column(1)):
                if not held_out(t):
                    for kind, y, *_ in spans_to_learn(t):
                        n[2 * KINDS.index(kind) + y] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(len(n)), pa.int32()), pa.array(n)], ["part", "n"])

    total = {r.part: r.n for r in own.mapInArrow(count, "part int, n long").groupBy("part").agg(F.sum("n").alias("n")).collect()}
    cut = [int(min(1.0, (1.3 * sample + 100) / total[k] if total.get(k, 0) > sample else 1.0) * (1 << 60))
           for k in range(2 * len(KINDS))]

    def learn(batches):
        for batch in batches:
            for h, t in zip(batch.column(0).to_pylist(), str_texts(batch.column(1))):
                if held_out(t):
                    continue
                rows = []
                for at, (kind, y, source, s, e) in enumerate(spans_to_learn(t)):
                    own_hash = int.from_bytes(hashlib.md5(f"{h}:{at}".encode()).digest()[:8], "big") >> 4
                    if own_hash < cut[2 * KINDS.index(kind) + y]:
                        rows.append((own_hash, y, describe(source, kind, s, e)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                         pa.array([r[2] for r in rows], pa.list_(pa.float64()))], ["h", "y", "x"])

    got = own.mapInArrow(learn, "h long, y int, x array<double>").toPandas()
    x = np.array([np.asarray(v) for v in got.x]).reshape(-1, len(describe("", "email", 0, 0)))
    y, h = got.y.to_numpy(), got.h.to_numpy()
    order = np.lexsort((*x.T, y, h))                   # rows come in no fixed order
    part = (2 * x[order, 0] + y[order]).astype(np.int64)
    keep = np.sort(np.concatenate([order[part == k][:sample] for k in range(2 * len(KINDS))]))
    x, y = x[keep], y[keep]
    order = np.lexsort((y, *x.T))
    x, y = x[order], y[order]
    return x, y


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
          precision: float = PRECISION) -> Model:
    own = docs.select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    x, y = sampled(own, sample)
    trees = boosting.fit(x, y)
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    most = 2 * REACH * STEPS

    def score(batches):
        n = np.zeros((len(KINDS), 2, most), np.int64)
        for batch in batches:
            for t in str_texts(batch.column(1)):
                found = spans_to_learn(t) if held_out(t) else []
                for at in range(0, len(found), 4096):
                    part = found[at:at + 4096]
                    z = shared.value.odds(np.array([describe(source, kind, s, e) for kind, _, source, s, e in part]))
                    place = np.clip(np.floor((z + REACH) * STEPS), 0, most - 1).astype(np.int64)
                    np.add.at(n, ([KINDS.index(f[0]) for f in part], [f[1] for f in part], place), 1)
        k, label, place = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(label, pa.int32()), pa.array(place, pa.int32()),
                                          pa.array(n[k, label, place])], ["kind", "y", "place", "n"])

    n = np.zeros((len(KINDS), 2, most))
    for r in own.mapInArrow(score, "kind int, y int, place int, n long").groupBy("kind", "y", "place").agg(F.sum("n").alias("n")).collect():
        n[r.kind, r.y, r.place] = r.n
    edges = np.arange(most) / STEPS - REACH
    label, place = np.nonzero(n.sum(0))
    trees.calibrate(None, label, odds=edges[place] + 0.5 / STEPS, weight=n.sum(0)[label, place])
    a, b = trees.scale
    least = {}
    for i, kind in enumerate(KINDS):
        right, every = (np.cumsum(v[::-1])[::-1] for v in (n[i, 1], n[i].sum(0)))
        good = np.flatnonzero((n[i].sum(0) > 0) & (right >= precision * every))
        # all at or over the edge of the lowest good place; the first place takes all that lies below, too
        least[kind] = 1.1 if not len(good) else float(1 / (1 + np.exp(-np.clip(a * edges[good[0]] + b, -40, 40)))) if good[0] else 0.0
    return Model(trees, least)


def find(text: str, model: Model) -> tuple[dict, dict]:
    """Base spans and added spans of each kind."""
    base, added = base_spans(text), {k: [] for k in KINDS}
    taken = sorted(s for spans in base.values() for s in spans)
    found = candidates(text)
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, np.int64)
    begins = np.array([a for a, _ in taken])
    if found and taken:                                # drop what overlaps a base span
        s, e = np.array([f[1] for f in found]), np.array([f[2] for f in found])
        n = np.searchsorted(begins, e, "left")         # base spans that begin before the end
        found = [f for f, k, a in zip(found, n.tolist(), s.tolist()) if not (k and ends[k - 1] > a)]
    for at in range(0, len(found), 4096):
        part = found[at:at + 4096]
        p = model.trees.probability(np.array([describe(text, *f) for f in part]))
        for (kind, s, e), q in zip(part, p.tolist()):
            if q >= model.least[kind]:
                added[kind].append((q, s, e))
    picked, kept = sorted(((q, k, s, e) for k, v in added.items() for q, s, e in v), key=lambda c: (-c[0], c[2], c[3], c[1])), []
    free = {k: [] for k in KINDS}
    starts: list[int] = []
    for q, kind, s, e in picked:
        i = bisect.bisect_left(starts, s)
        if (i == len(starts) or kept[i][0] >= e) and (i == 0 or kept[i - 1][1] <= s):
            starts.insert(i, s)
            kept.insert(i, (s, e))
            free[kind].append((s, e))
    return base, {k: sorted(v) for k, v in free.items()}


def listed(spans: dict) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in sorted(spans[k]))


def find_spans(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the numbers of base spans, the base spans and all spans as text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = schema_of(docs, id_col, *[(f"n_{k}", T.LongType()) for k in KINDS], ("base", T.StringType()),
                       ("spans", T.StringType()), ("n_added", T.LongType()))

    def run(batches):
        for batch in batches:
            rows = [find(t, shared.value) for t in str_texts(batch.column(1))]
            yield batch_of(schema, [batch.column(0), *[[len(b[k]) for b, _ in rows] for k in KINDS],
                                    [listed(b) for b, _ in rows],
                                    [listed({k: b[k] + a[k] for k in KINDS}) for b, a in rows],
                                    [sum(map(len, a.values())) for _, a in rows]])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def redacted(text: str, model: Model) -> str:
    """``text`` with each span replaced by its kind; of overlapping spans the union is replaced,
    named by the first."""
    base, added = find(text, model)
    spans = sorted((s, e, k) for k in KINDS for s, e in base[k] + added[k])
    out, at = [], 0
    for s, e, k in spans:
        if s >= at:
            out += [text[at:s], f"<{k.upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with redacted texts (null stays null) and ``n_chars`` counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches):
        for batch in batches:
            new = [None if not v.is_valid else redacted(v.as_py(), shared.value) for v in batch.column(at)]
            yield batch_of(schema, [pa.array(new, pa.string()) if k == at else c for k, c in enumerate(batch.columns)])

    return with_new_text(docs.mapInArrow(run, schema), text_col)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return find_spans(docs, train(docs)).select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")
