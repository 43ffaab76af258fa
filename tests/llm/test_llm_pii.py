import hashlib
import random
import re

import numpy as np
import pytest

from inkstream.llm import boosting, pii as P

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = {k: [m for m in re.finditer(p, text)] for k, p in PLAIN.items()}
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out["ip"] = [m for m in out["ip"] if all(int(x) <= 255 for x in m[0].split("."))]
    out["card"] = [m for m in out["card"] if 16 <= len(digits(m)) <= 19 and P.luhn(digits(m))]
    out["phone"] = [m for m in out["phone"] if 8 <= len(digits(m)) <= 15]
    return {k: [m.span() for m in v] for k, v in out.items()}


def test_luhn():
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


def test_base_spans_equal_plain_patterns():
    rnd = random.Random(0)
    bits = ["a.b", "@", "x-y", ".", "..", "1.2.3.4", "256.1.1.1", "001.02.3.4.5", "+1 (555) 123-4567", "4111 1111 1111 1111", "4111-1111-1111-1111-",
            " ", "é", "+", "12", "9" * 20, "me@h.co", "@@", "a@b@c.d.e", "%+-", "+(1)", "\n", "0", "--", "1 ", "((", "١٢"]
    for _ in range(6000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))
        assert P.base_spans(text) == plain_spans(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 300000, "1" * 300000, "@" * 100000, "a@" * 50000, "1." * 100000, "+1" + " " * 200000, "1 " * 100000,
                                  "+1 " * 60000, "a.@b." * 30000, "at " * 60000, "1.1.1." * 30000])
def test_linear_in_long_texts(text):
    P.base_spans(text)
    P.candidates(text)


CLEAN = "the quick brown fox costs 12.50 or 3,400 in 2024-01-02 at noon . "


def corpus(n=400):
    rnd, rows = random.Random(4), []
    for i in range(n):
        c = "4" + "".join(str(rnd.randrange(10)) for _ in range(14))
        c += next(x for x in "0123456789" if P.luhn(c + x))
        a = {0: f"write to u{i}.x@mail{i % 7}.example.com now", 1: f"host 10.{i % 256}.3.{rnd.randrange(256)} up",
             2: f"card {c} ok", 3: f"call +1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)} or"}.get(i % 8, "")
        rows.append((i, CLEAN * rnd.randint(1, 3) + a + " " + CLEAN))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return P.train(spark.createDataFrame(corpus(), "doc_id long, text string"))


def test_method_adds_obscured_spans_and_spares_clean_text(model):
    for text in (CLEAN * 3, "version 1.2 of 2023, 15 of 20 items; 1234567 rows"):
        assert not any(P.find(text, model)[1].values())
    hits = sum(bool(P.find(CLEAN + t + CLEAN, model)[1][k]) for t, k in (
        ("write to u5.x at mail3 dot example dot com ", "email"), ("write to bob(at)mail3.example.com ", "email"),
        ("card 4111.1111.1111.1111 ok ", "card"), ("host 10[.]2[.]3[.]4 up ", "ip")))
    assert hits >= 2


def test_spans_do_not_overlap_base(model):
    rnd = random.Random(1)
    texts = [t for _, t in corpus(60)] + ["".join(rnd.choice(["a@b.co ", "1.2.3.4 ", "4111111111111111", " 555 ", "+1 555 123 4567 ", "x at y dot com "])
                                                  for _ in range(12)) for _ in range(60)]
    for t in texts:
        base, added = P.find(t, model)
        assert base == P.base_spans(t)
        fresh = sorted(s for v in added.values() for s in v)
        for a, b in zip(fresh, fresh[1:]):
            assert a[1] <= b[0]
        assert not any(a < e and s < b for a, b in fresh for v in base.values() for s, e in v)


def test_operator_and_redaction(spark, model):
    rows = [(1, "mail a@b.co or 1.2.3.4"), (2, None), (3, ""), (None, "card 4111 1111 1111 1111 end"), (1, "mail a@b.co or 1.2.3.4"), (4, "é +1 (555) 123-4567")]
    docs = spark.createDataFrame([(i, t, "s", len(t or "")) for i, t in rows], "doc_id long, text string, spans string, n_chars long")
    got = P.find_spans(docs, model).collect()
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base) for r in got) == sorted([
        ("1", 1, 1, 0, 0, "email:5:11,ip:15:22"), ("1", 1, 1, 0, 0, "email:5:11,ip:15:22"), ("2", 0, 0, 0, 0, ""), ("3", 0, 0, 0, 0, ""),
        ("None", 0, 0, 1, 0, "card:5:24"), ("4", 0, 0, 0, 1, "phone:2:19")])
    red = P.redact(docs, model)
    assert red.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text), str(r.n_chars)) for r in red.collect()) == sorted(
        (str(i), str(t), str(None if t is None else len(t))) for i, t in [
            (1, "mail <EMAIL> or <IP>"), (2, None), (3, ""), (None, "card <CARD> end"), (1, "mail <EMAIL> or <IP>"), (4, "é <PHONE>")])
    empty = docs.limit(0)
    assert P.find_spans(empty, P.train(empty)).count() == 0 and P.redact(empty, model).count() == 0


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in P.op4(spark, sf_dir).collect()}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        base = plain_spans(d.text or "")
        text = ",".join(f"{k}:{s}:{e}" for k in P.KINDS for s, e in base[k])
        r = got[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(base[k]) for k in P.KINDS]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_boosting_learns_and_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > .5) | (x[:, 2] > 1.5)).astype(int)
    trees = boosting.fit(x[:2000], y[:2000])
    trees.calibrate(x[2000:2500], y[2000:2500])
    p = trees.probability(x[2500:])
    assert ((p > .5) == y[2500:]).mean() > .95 and abs(p.mean() - y[2500:].mean()) < .05
    cut = boosting.threshold(p, y[2500:], .98)
    assert y[2500:][p >= cut].mean() >= .98
    for one in (np.zeros(5), np.zeros(0)):
        assert len(boosting.fit(np.zeros((len(one), 2)), one).probability(np.zeros((3, 2)))) == 3
    assert boosting.threshold(np.array([.9]), np.array([0]), .98) > 1


def test_rare_kinds_are_learnt_and_judged_on_all_documents(spark):
    """A kind in few of many documents: all its spans count, though its documents are few in any sample."""
    rnd, rows = random.Random(7), []
    for i in range(12000):
        t = f"host 10.{i % 256}.3.{rnd.randrange(256)} up" if i % 300 == 0 else f"order {rnd.randrange(10 ** 9, 10 ** 10)} sent"
        rows.append((i, f"{CLEAN}{t} {CLEAN}{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    learnt = P.train(docs, sample=200)
    assert learnt.least["ip"] <= 1
    assert P.find(f"{CLEAN}host 10[.]2[.]3[.]4 up {CLEAN}", learnt)[1]["ip"]
    x, y = P.sampled(docs.selectExpr("xxhash64(doc_id) AS h", "text"), 200)
    fitted = sum(not P.held_out(t) for i, t in rows if i % 300 == 0)
    assert ((x[:, 0] == P.KINDS.index("ip")) & (y == 1)).sum() == 2 * fitted
    assert ((x[:, 0] == P.KINDS.index("phone")) & (y == 0)).sum() == 200
