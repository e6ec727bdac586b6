import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
THEIRS = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN)


def expected(text):
    ids = THEIRS.encode_ordinary(text)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def run(docs, **kw):
    df = bpe.digests(bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, **kw))
    return [tuple(r) for r in df.collect()]


def test_whole_table_as_the_library_does(documents, texts):
    got = {r[0]: r[1:] for r in run(documents)}
    assert got == {i: expected(t) for i, t in texts.items()}


def test_small_chunks_give_the_same(documents, texts):
    got = {r[0]: r[1:] for r in run(documents.where("doc_id < 60"), chunk_chars=64, overlap=16)}
    assert got == {i: expected(t) for i, t in texts.items() if i < 60}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab  \n'sé1.!", max_size=120), st.integers(5, 30))
def test_stitch_equals_one_pass(text, size):
    step = max(1, size - 4)
    chunks = [(at, text[at:at + size]) for at in range(0, max(1, len(text)), step)]
    got = bpe.stitch([(at, c, CODEC.boundaries(c)) for at, c in chunks], CODEC)
    assert got == CODEC.boundaries(text)


@pytest.mark.parametrize("text", ["x" * 500, "ab" * 200, "é" * 99, " " * 300, "\U0001F600" * 40, "a\x00b"])
def test_long_pieces(text):
    assert np.frombuffer(CODEC.encode(text), "<u4").tolist() == THEIRS.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_round_trip(text):
    ids = CODEC.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == THEIRS.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


def test_odd_rows(odd_docs, no_docs):
    got = sorted(run(odd_docs), key=str)
    want = sorted(((r.doc_id, *expected(r.text or "")) for r in odd_docs.collect()), key=str)
    assert got == want
    assert run(no_docs) == []
