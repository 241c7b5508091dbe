import hashlib

import public_tokenizers as P
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from leadloom.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
ENC = bpe.encoding(PATH, P.PATTERN)


def by_match(text):
    """Every match of the pattern encoded on its own."""
    out = []
    for m in regex.finditer(P.PATTERN, text):
        out += ENC._encode_single_piece(m[0])
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sx1a.é　\xa0"), st.characters(exclude_categories=["Cs"]))), st.integers(4, 20))
def test_cuts_change_nothing(text, size):
    assert bpe.encode_text(ENC, text, size) == by_match(text)
    assert ENC.decode_bytes(bpe.encode_text(ENC, text, size)) == text.encode()


@pytest.mark.parametrize("text", [
    " " * 1_000_000, " " * 1_000_000 + "x", "x" + "\n" * 300_000 + " y", "a" * 300_000, "!" * 200_000, "word and 12 more " * 60_000, "é" * 50_000,
])
def test_very_long_texts(text):
    ids = bpe.encode_text(ENC, text)
    assert ENC.decode_bytes(ids) == text.encode()
    if len(text) < 250_000:
        assert ids == ENC.encode_ordinary(text)


def test_rows_and_digests(docs, clashing):
    df = docs([(1, "Hello world"), (2, None), (2, ""), (3, "<|endoftext|> ümlaut \U0001f600")])
    rows = {(r.doc_id, r.n_tokens): r for r in bpe.digests(bpe.encode(clashing(df), PATH, P.PATTERN, decoded=True)).collect()}
    ids = ENC.encode_ordinary("Hello world")
    assert rows[(1, len(ids))].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert rows[(1, len(ids))].decoded_sha256 == hashlib.sha256(b"Hello world").hexdigest()
    assert rows[(2, 0)].ids_sha256 == rows[(2, 0)].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.encode(df, PATH, P.PATTERN).count() == 4
    back = bpe.decode(bpe.encode(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted(bytes(r.decoded).decode() for r in back) == sorted(["Hello world", "", "", "<|endoftext|> ümlaut \U0001f600"])


def test_raw_bytes_and_empty_tables(spark, docs):
    half = ENC.encode_ordinary("é")[:1] if len(ENC.encode_ordinary("é")) > 1 else [ENC.encode_single_token(b"\xc3")]
    raw = bpe.decode(spark.createDataFrame([(1, half), (2, None)], "doc_id BIGINT, ids ARRAY<INT>"), PATH, P.PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded) for r in raw} == {1: b"\xc3", 2: b""}
    assert bpe.encode(docs([]), PATH, P.PATTERN, decoded=True).collect() == []
