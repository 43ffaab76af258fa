"""The pipeline and each of its stages against a plain version on one machine."""
import importlib.util
import os

import numpy as np
from tokenizers import Tokenizer

from inkstream.llm import bpe, pii, toxicity
from test_llm_decontaminate import brute, words
from test_llm_simhash import plain_components, plain_print

spec = importlib.util.spec_from_file_location(
    "corpus_pipeline", os.path.join(os.path.dirname(__file__), "..", "..", "corpus_pipeline.py"))
pipeline = importlib.util.module_from_spec(spec)
spec.loader.exec_module(pipeline)

ODD = [(None, None, None, None, None), (90001, "", "en", "s", 0), (90002, None, "en", None, None), (90003, "x y z w v", None, "s", 9),
       (90003, "x y z w v", None, "s", 9), (None, "x y z w v", None, None, 9), (90004, "mail me@you.example.com or +1 (555) 123-4567 now ok", "en", "s", 1),
       (90005, "long " * 40000, "en", "s", 1)]


def keys(rows):
    return sorted((str(r.doc_id), str(r.text)) for r in rows)


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(ODD, docs.schema)).cache()
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    model = toxicity.trained(spark, sf_dir)
    now = docs
    for name, stage in pipeline.STAGES:
        before = now.collect()
        out = stage(spark, now, sf_dir)
        if name != "bpe":
            assert out.columns == docs.columns
            out = spark.createDataFrame(out.collect(), docs.schema)
        got = out.collect()
        if name == "toxicity":
            assert keys(got) == keys(r for r in before if model.over((r.text or "").encode())[0] < toxicity.CUT)
            assert len(got) < len(before)
        elif name == "simhash":
            groups = plain_components([plain_print(r.text) for r in before])
            members = {}
            for r in before:
                members.setdefault(min(groups[plain_print(r.text)]), []).append(r.doc_id)
            want = sorted(str(min((i for i in ids if i is not None), default=None)) for ids in members.values())
            assert sorted(str(r.doc_id) for r in got) == want
            assert len({min(groups[plain_print(r.text)]) for r in got}) == len(got)
        elif name == "decontaminate":
            def bad(r):
                n, hit, _ = brute_fast(r.text, bench)
                return hit > 0 and 20 * hit >= n
            assert keys(got) == keys(r for r in before if not bad(r))
            assert len(got) < len(before)
        elif name == "pii":
            learnt = pii.train(now)
            assert sorted((str(r.doc_id), str(r.text), str(r.n_chars)) for r in got) == sorted(
                (str(r.doc_id), str(t), str(None if t is None else len(t)))
                for r in before for t in [None if r.text is None else pii.redacted(r.text, learnt)])
            assert not any(any(pii.base_spans(r.text or "").values()) for r in got)
        else:
            library = Tokenizer.from_file(bpe.default_vocabulary())
            want = sorted((str(r.doc_id), tuple(library.encode(r.text or "", add_special_tokens=False).ids)) for r in before)
            assert sorted((str(r.doc_id), tuple(r.ids)) for r in got) == want
            assert all(r.n_tokens == len(r.ids) for r in got)
        now = out


def brute_fast(text, bench, window=13):
    """As ``brute``, looking only at items that share a first word triple."""
    grams = {tuple(w) for w in zip(words(text), words(text)[1:], words(text)[2:])}
    near = [(i, t) for i, t in bench if len(words(t)) < 3 or any(tuple(g) in grams for g in zip(words(t), words(t)[1:], words(t)[2:]))]
    near = [(i, t) for i, t in near if len(words(t)) < window or len(grams & set(zip(words(t), words(t)[1:], words(t)[2:]))) >= window - 2]
    return brute(text, near, window) if near else (len(words(text)), 0, [])


def test_run_and_empty_documents(spark, sf_dir, tmp_path):
    got = pipeline.run(spark, sf_dir).collect()
    assert len({r.doc_id for r in got}) == len(got) > 50
    assert all(np.all(np.array(r.ids) >= 0) for r in got)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
        if "text" in docs.columns:
            docs = spark.createDataFrame([], docs.schema)
