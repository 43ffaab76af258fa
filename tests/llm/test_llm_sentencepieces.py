import hashlib
import random
from functools import cache

import numpy as np
import pytest
import sentencepiece

from inkstream.llm import sentencepieces as own
from sentencepiece import sentencepiece_model_pb2 as proto


def model(rule=None, **options):
    """The given vocabulary, with the normalisation rule and the options asked for."""
    m = proto.ModelProto()
    with open(own.default_model(), "rb") as f:
        m.ParseFromString(f.read())
    if rule:
        n = proto.ModelProto()
        n.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        m.normalizer_spec.precompiled_charsmap = n.normalizer_spec.precompiled_charsmap
    for k, v in options.items():
        setattr(m.trainer_spec if k == "byte_fallback" else m.normalizer_spec, k, v)
    if options.get("byte_fallback") is False:
        kept = [p for p in m.pieces if p.type != 6]
        del m.pieces[:]
        m.pieces.extend(kept)
    return m.SerializeToString()


CASES = {
    "given": model(),
    "nfkc": model("nmt_nfkc"),
    "nfkc_trim": model("nmt_nfkc", remove_extra_whitespaces=True),
    "folded": model("nfkc_cf", remove_extra_whitespaces=True, add_dummy_prefix=False),
    "no_bytes": model("nfkc", byte_fallback=False),
}


def library(raw):
    sp = sentencepiece.SentencePieceProcessor()
    sp.LoadFromSerializedProto(raw)
    return sp


@cache
def loaded(raw):
    return own.Pieces(raw)


def expected(sp, text):
    found = [(p.id, p.begin, p.end) for p in sp.encode(text, return_type="proto").pieces]
    return found, sp.decode(sp.encode(text, add_eos=True))


def check(p, sp, text):
    ids, spans = p.encode(text)
    want, back = expected(sp, text)
    assert [(i, b, e) for i, (b, e) in zip(ids.tolist(), spans.tolist())] == want, repr(text)
    assert p.decode(np.append(ids, p.end)) == back, repr(text)


POOL = [chr(i) for i in [*range(0x250), 0x2028, 0x2003, 0x3000, 0x4E2D, 0x1F600, 0x301, 0x308, 0xD55C, 0xFEFF, 0x2581, 0xFB01,
                         0xFF21, 0x1100, 0x1161, 0x11A8, 0x200B, 0xAD, 0x2126, 0x3399, 0x0F43, 0xFDFA]]
POOL += ["  ", "   ", "</s>", "<unk>", "<0x0A>", "don't", "\r\n", "é", "Å", "▁▁", " ̈"]


@pytest.mark.parametrize("case", CASES)
def test_equals_library_on_odd_texts(case):
    p, sp, rnd = loaded(CASES[case]), library(CASES[case]), random.Random(5)
    for _ in range(2500):
        check(p, sp, "".join(rnd.choice(POOL) if rnd.random() < .4 else rnd.choice("ab cd the in 12") for _ in range(rnd.randint(0, 40))))


@pytest.mark.parametrize("text", ["", " ", "     ", "a" * 5000, " " * 999, "x " * 30000, "th" * 900 + "\n" * 70, "中文" * 400,
                                  "word" * 100 + " " + "word" * 100, "\x00 a\x00"])
@pytest.mark.parametrize("case", ["given", "nfkc_trim"])
def test_long_and_repetitive(case, text, monkeypatch):
    p, sp = loaded(CASES[case]), library(CASES[case])
    check(p, sp, text)
    p.memo.clear()
    monkeypatch.setattr(own, "PIECE", 64)
    monkeypatch.setattr(own, "MEMO", 5)
    check(p, sp, text)


def test_spans_cover_the_source():
    p = loaded(CASES["nfkc"])
    text = "ﬁne Ａ́ café Ω ㎙x"
    _, spans = p.encode(text)
    assert spans[0, 0] == 0 and spans[-1, 1] == len(text.encode()) and (spans[1:, 0] == spans[:-1, 1]).all()


def test_compiled_map_holds_single_and_longer_keys():
    entries = loaded(CASES["nfkc"]).map
    assert list(entries.runs("aﬁb")) == [(0, 1, None), (1, 2, "fi"), (2, 3, None)]
    assert list(entries.runs("é")) == [(0, 2, "\xe9")]
    assert own.compiled_map(b"") == {}


def test_broken_ids():
    p, sp = loaded(CASES["given"]), library(CASES["given"])
    rnd = random.Random(2)
    for _ in range(2000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(3, 259), rnd.randrange(3), 259, 28705]) for _ in range(rnd.randint(0, 12))]
        assert p.decode(np.array(ids, np.int64)) == sp.decode(ids), ids
    assert p.decode(np.array([99999, -4])) == " ⁇  ⁇ "


def test_operator(spark):
    sp = library(CASES["given"])
    rows = [(1, "Hello world, it's 2024.", "a"), (2, None, "b"), (3, "", "c"), (None, " x\n中\U0001f600 y ", None),
            (1, "Hello world, it's 2024.", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = own.encode(docs, with_text=True).collect()
    assert len(got) == 5
    for r, (i, text, _) in zip(sorted(got, key=lambda r: (r.decoded, r.doc_id or 0)), sorted(rows, key=lambda r: (r[1] or "", r[0] or 0))):
        text = text or ""
        ids = sp.encode(text, add_eos=True)
        assert (r.doc_id, r.n_tokens, r.decoded) == (i, len(ids), text)
        assert [p.id for p in r.pieces] == ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans_sha256 == hashlib.sha256(np.array([(p.begin, p.end) for p in r.pieces], "<i8").tobytes()).hexdigest()
        assert r.pieces[-1].begin == r.pieces[-1].end == len(text.encode())
    ids = own.encode(docs).selectExpr("doc_id", "transform(pieces, p -> p.id) AS ids").unionAll(
        spark.createDataFrame([(9, None)], "doc_id long, ids array<int>"))
    assert sorted(r.text for r in own.decode(ids).collect()) == sorted([*(r[1] or "" for r in rows), ""])
    assert own.encode(docs.limit(0)).count() == 0


def test_given_documents_equal_the_library(spark, sf_dir):
    sp = library(CASES["given"])
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = own.op11(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = sp.encode(texts[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
