from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from mailtax.llm import decontaminate, secrets
from tests.llm.conftest import SF_DIR
from tests.llm.test_dedup import plain_components, plain_fingerprint


def test_queries_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names


@pytest.mark.parametrize("name", ["op5_simhash", "op6_language", "op7_packing", "op8_secrets", "op10_repeats"])
def test_queries_cover_the_table(spark, documents, name):
    rows = entry.queries()[name](spark, SF_DIR)
    if name == "op7_packing":
        ids = {s.doc_id for r in rows.select("segments").collect() for s in r.segments}
        assert ids == {r.doc_id for r in documents.collect()}
    else:
        assert rows.count() == documents.count()


def test_base_digest(spark):
    for r in entry.queries()["op8_secrets"](spark, SF_DIR).collect():
        base = ",".join(s for s in r.spans.split(",") if not s.startswith("literal")) if r.spans else ""
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def test_pipeline_against_plain_stages(spark, documents):
    """Near duplicates, benchmark passages, redaction and ids by plain means; all languages here are known."""
    rows = sorted((r.doc_id, r.text) for r in documents.collect() if any(map(str.isalpha, r.text)))
    label = plain_components([plain_fingerprint(t, 4) for _, t in rows], lambda x, y: (x ^ y).bit_count() <= 4)
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    found = decontaminate.decontaminate(documents, benchmark).where("contaminated").collect()
    leaked = {r.doc_id for r in found}
    items = [r.text for r in benchmark.collect()]
    assert {d for d, t in rows if any(i in t for i in items)} <= leaked
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {d: library.encode(secrets.redacted(t), add_special_tokens=False).ids for d, t in rows if d not in leaked}
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out} == expected
    assert {r.doc_id: r.text for r in out} == {d: secrets.redacted(t) for d, t in rows if d not in leaked}


def test_stages_keep_the_columns_of_documents(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == documents.columns and out.dtypes == documents.dtypes, name
        docs = out


def test_stages_take_odd_rows(spark, odd, empty, documents):
    wide = odd.selectExpr("doc_id", "text", "cast(null as string) as lang", "k1 as source", "fp as n_chars", "k1 as row", "fp as k2")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (wide, wide.limit(0)):
            out = stage(spark, docs, SF_DIR)
            if name != "bpe":
                assert out.columns == wide.columns
            assert out.count() <= docs.count()
