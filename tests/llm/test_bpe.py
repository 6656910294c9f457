"""Byte-level BPE against the tiktoken library and against one merge at a time."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from paytide.llm import bpe
from paytide.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
OWN = bpe.read_ranks(RANKS)
THEIRS = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=OWN, special_tokens={})
CUT = regex.compile(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(**bpe.tables(OWN))


def check(vocabulary, texts, theirs=THEIRS, cut=CUT):
    ids, ends = vocabulary.encode(texts, cut)
    for i, text in enumerate(texts):
        own = ids[ends[i] : ends[i + 1]]
        assert own.tolist() == theirs.encode_ordinary(text or ""), text
        assert vocabulary.decode(own).tobytes() == (text or "").encode()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(alphabet="aeionst 'lv\n1", max_size=200)), max_size=6))
def test_ids_are_those_of_the_library(vocabulary, texts):
    check(vocabulary, texts)


def test_long_pieces(vocabulary):
    r = random.Random(1)
    texts = ["a" * 5000, " " * 3000, "ab" * 3000, "=-" * 2000, "7" * 2500, "😀" * 900]
    texts += ["".join(r.choice("aetoinsh") for _ in range(n)) for n in (1023, 1024, 1025, 9000)]
    check(vocabulary, texts)


def test_texts_above_the_list_bound_and_forgotten_pieces(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 8)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "DECODED", 5)
    monkeypatch.setattr(bpe, "CELLS", 16)
    for _ in range(3):
        check(vocabulary, ["some words that are cut one by one, again and again", "short", None, ""])


def ranks_of(tokens):
    return {t: i for i, t in enumerate([*[bytes([b]) for b in range(256)], *tokens])}


# in the second, "abcd" comes before "abc" and "cd" is no token; the third token of the last one is never reached
@pytest.mark.parametrize("tokens", [[b"aa", b"aaa", b"aaaa"], [b"ab", b"abcd", b"abc", b"bc", b"cda", b"cab"], [b"ab", b"bc", b"abc", b"xyz"]])
def test_other_vocabularies(tokens, monkeypatch):
    own = ranks_of(tokens)
    theirs = tiktoken.Encoding("small", pat_str=r"[a-z]+", mergeable_ranks=own, special_tokens={})
    r = random.Random(2)
    texts = ["".join(r.choice("abcdxyz"[: r.choice([2, 3, 4, 7])]) for _ in range(r.randrange(1, 40))) for _ in range(300)] + ["xyz", "abc"]
    texts = [t.replace("e", "a") for t in texts]
    for wide in (1024, 1):
        monkeypatch.setattr(bpe, "WIDE", wide)
        check(bpe.Vocabulary(**bpe.tables(own)), texts, theirs, regex.compile("[a-z]+"))


def test_a_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError, match="single bytes"):
        bpe.tables({b"a": 0})


def test_documents_come_back(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r for r in bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for row in rows:
        ids, g = THEIRS.encode_ordinary(row.text or ""), got[row.doc_id]
        assert g.n_tokens == len(ids) and g.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_odd_rows(spark):
    schema = "doc_id LONG, text STRING, ids STRING, decoded INT, `a.b` INT, n_tokens INT"
    rows = [(1, None, "x", 1, 2, 3), (2, "", "x", 1, 2, 3), (None, "one two", None, None, None, None), (1, "one two", "x", 1, 2, 3)]
    docs = spark.createDataFrame(rows, schema)
    got = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 2), (1, 0), (1, 2), (2, 0)]
    assert all((r.ids_sha256 == empty) == (r.n_tokens == 0) for r in got)
    wide = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert sorted(wide.columns) == sorted(docs.columns) and dict(wide.dtypes)["ids"] == "array<int>"
    back = bpe.decode(wide.selectExpr("IF(doc_id = 2, null, ids) AS ids", "doc_id"), RANKS).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded) if r.decoded is not None else None) for r in back if r.doc_id != 1) == [(0, b"one two"), (2, None)]
    assert bpe.encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_rank_files_are_read(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in ranks_of([b"ab"]).items()))
    assert bpe.read_ranks(str(path)) == ranks_of([b"ab"])
