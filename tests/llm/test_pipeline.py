import hashlib

import corpus_pipeline as C
import public_tokenizers
import numpy as np
import tiktoken
from stratum.llm import bpe, jaccard_join, secret_scan

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    out = {}
    for name, stage in C.STAGES:
        before = docs
        result = stage(spark, docs, SF)
        path = C.scratch_path(spark, "test-stage")
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        out[name] = (before, docs)
    return out


def test_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = stages(spark, docs)
    for name in list(out)[:-1]:
        assert out[name][1].columns == docs.columns, name
    rows = lambda df: {r.doc_id: r for r in df.collect()}

    before, after = map(rows, out["language_id"])
    assert set(before) - set(after) == {i for i, r in before.items() if not any(c.isalpha() for c in r.text)}

    before, after = out["jaccard_dedup"]
    want = {r.class_id for r in jaccard_join.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)

    before, after = map(rows, out["secret_masking"])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.text == secret_scan.mask(before[i].text, secret_scan.scan(before[i].text))
        assert r.n_chars == len(r.text)

    before, after = out["source_mixing"]
    known = rows(before)
    assert all(known[r.doc_id] == r for r in after.collect())

    before, after = out["byte_bpe"]
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                               mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    want = sorted((r.doc_id, np.array(theirs.encode_ordinary(r.text), "<u4").tobytes(),
                   hashlib.sha256(r.text.encode()).hexdigest()) for r in before.collect())
    assert sorted((r.doc_id, bytes(r.ids), r.decoded_sha256) for r in after.collect()) == want


def test_odd_rows(spark, odd_docs, no_docs):
    out = stages(spark, odd_docs)
    assert out["source_mixing"][1].columns == odd_docs.columns
    assert stages(spark, no_docs)["byte_bpe"][1].count() == 0
