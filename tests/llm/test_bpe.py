import hashlib

import numpy as np
import public_tokenizers
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from annolake.llm import bpe, util

RANKS = bpe.Ranks(bpe.default_path())
ORACLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS.ids, special_tokens={})
SPLIT = regex.compile(public_tokenizers.PATTERN).findall


def ids(text):
    return np.frombuffer(RANKS.encode([text], SPLIT)[0], "<u4").tolist()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="aabbthein \n'sé中🙂01", max_size=200))
def test_as_the_library(text):
    assert ids(text) == ORACLE.encode_ordinary(text)
    assert RANKS.decode(np.array(ids(text), "<u4").tobytes()) == text.encode()


def test_both_replays_agree():
    pieces = [w.encode() for w in ("aaaaaaaaaa", "banana", "thethethe", "x" * 1000, "ab" * 500, "é" * 50)]
    assert RANKS.replay(pieces) == RANKS.replay_singly(pieces)


def test_query_against_the_library(spark, sf):
    docs = util.table(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = bpe.round_trip(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        expected = ORACLE.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(odd_docs, no_docs):
    texts = [(r.text or "") for r in odd_docs.collect()]
    got = bpe.round_trip(odd_docs, keep=["doc_id", "score", "kept"]).collect()
    assert sorted(r.decoded_sha256 for r in got) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)
    assert [r.n_tokens for r in got if r.doc_id in (4, 5)] == [0, 0]
    assert bpe.round_trip(no_docs).count() == 0
