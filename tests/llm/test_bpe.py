import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from reunion.llm.bpe import BytePairs, decode, encode, round_trip

from .util import odd_documents, odd_texts

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return BytePairs(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8") | st.sampled_from(" \n\tabs'1é\u3000\xa0\u2003\x1f\x85"), max_size=80), max_size=4))
def test_ids_as_the_library(coder, reference, texts):
    got = coder.encode(texts)
    assert [x.tolist() for x in got] == [reference.encode_ordinary(t) for t in texts]
    assert coder.decode(got) == [t.encode() for t in texts]


@settings(max_examples=20, deadline=None)
@given(st.text("abcdeé", min_size=200, max_size=900))
def test_long_words(coder, reference, text):
    assert coder.encode([text])[0].tolist() == reference.encode_ordinary(text)
    assert coder._heap(text.encode()).tolist() == coder._matrix([text.encode()], len(text.encode()))[0].tolist()
    many = [text, "a", text[:40], " b" + text, "", "  " * 300, text[:40]]
    assert [x.tolist() for x in coder.encode(many)] == [reference.encode_ordinary(t) for t in many]


def test_round_trip(spark, reference):
    def want(i, t):
        ids = reference.encode_ordinary(t or "")
        return i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    got = sorted(map(tuple, round_trip(odd_documents(spark), PATH, P.PATTERN).collect()), key=str)
    assert got == sorted((want(i, t) for i, t in odd_texts()), key=str)
    assert round_trip(odd_documents(spark, empty=True), PATH, P.PATTERN).collect() == []
    ids = encode(odd_documents(spark), PATH, P.PATTERN)
    back = decode(ids, PATH, P.PATTERN).collect()
    assert sorted((str(r[0]), bytes(r[1]).decode()) for r in back) == sorted((str(i), t or "") for i, t in odd_texts())
