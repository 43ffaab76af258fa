import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from inkstream.llm import bpe

PLACE = bpe.default_vocabulary()


@pytest.fixture(scope="module")
def own():
    with open(PLACE, encoding="utf-8") as f:
        return bpe.Codec(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PLACE)


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_equals_library_on_odd_texts(own, library):
    rnd = random.Random(3)
    pool = [chr(i) for i in [*range(0x250), 0x2028, 0x2003, 0x3000, 0x4E2D, 0x1F600, 0x301, 0xD55C, 0xFEFF, 0x180E]]
    pool += ["<|endoftext|>", "'s", "  ", "don't", "\r\n", "\x1c "]
    texts = ["".join(rnd.choice(pool) if rnd.random() < .5 else rnd.choice("ab cd\n 12'") for _ in range(rnd.randint(0, 40)))
             for _ in range(4000)]
    for text, got in zip(texts, own.encode_all(texts)):
        ids, back = expected(library, text)
        assert got == ids, repr(text)
        assert own.decode(got) == back == text


@pytest.mark.parametrize("text", ["", " ", "a" * 5000, "x " * 30000 + " " * 300, "<>" * 900 + "th" * 900, "\n".join(["é ü"] * 400),
                                  "word" * 100 + " " + "word" * 100, "<|endoftext|>" * 3 + " <|endoftext|> x"])
def test_long_and_repetitive(own, library, text, monkeypatch):
    ids, back = expected(library, text)
    assert own.encode(text) == ids and own.decode(ids) == back
    monkeypatch.setattr(bpe, "PIECE", 64)          # the same in many small pieces
    monkeypatch.setattr(bpe, "MEMO", 5)
    assert own.encode(text) == ids and own.decode(ids) == back


def test_cuts_are_where_no_token_joins(own):
    """The table holds exactly the pairs inside tokens, and cutting there changes no id."""
    pairs = {t[i:i + 2] for t in own.bytes_of.values() for i in range(len(t) - 1)}
    pairs -= {b"<|", b"|e", b"t|", b"|>"} - {t for t in pairs if any(t in v for k, v in own.bytes_of.items() if k != 50256)}
    assert {bytes(divmod(int(p), 256)) for p in np.flatnonzero(own.inside)} == pairs
    assert 0 < len(pairs) < 65536
    rnd, table = random.Random(1), own.inside
    tokens = [bytes(rnd.choice(b"aethn zq\x00\xc3\xa9") for _ in range(30)) for _ in range(300)]
    cut = own.merge_all(tokens)
    own.inside = np.ones_like(table)
    whole = own.merge_all(tokens)
    own.inside = table
    assert cut == whole


def test_operator(spark, library):
    rows = [(1, "Hello world, it's 2024.", "a"), (2, None, "b"), (3, "", "c"), (None, "x <|endoftext|> y", None), (1, "Hello world, it's 2024.", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encode(docs, with_text=True).collect()
    assert len(got) == 5
    for r, (i, text, _) in zip(sorted(got, key=lambda r: (r.decoded, r.doc_id or 0)), sorted(rows, key=lambda r: (r[1] or "", r[0] or 0))):
        ids, back = expected(library, text or "")
        assert (r.doc_id, r.n_tokens, r.decoded) == (i, len(ids) // 4, text or "") and back == (text or "")
        assert r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    again = bpe.decode(bpe.encode(docs)).collect()
    assert sorted(r.text for r in again) == sorted((r[1] or "") for r in rows)
    assert bpe.encode(docs.limit(0)).count() == 0


def test_query(spark, sf_dir, library):
    got = {r.doc_id: r for r in bpe.op7(spark, sf_dir).collect()}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids, back = expected(library, d.text or "")
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
