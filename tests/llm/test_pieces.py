import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from reunion.llm.pieces import Pieces, decode, encode, round_trip

from .util import odd_documents, odd_texts, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
CODER = Pieces(PATH)
ODD = st.lists(st.sampled_from(["a", "the", "ing", " ", "  ", "▁", "\t", "\n", "\r", "é", "日", "\x00", "\x01", "😀", "<s>", "<0x41>", "​", "　", "̈", "0", "x" * 70]), max_size=20).map("".join)


def ids(coder, text):
    return coder.encode([text])[0].tolist()


def theirs(text):
    return LIBRARY.encode(text, add_bos=True, add_eos=True)


@settings(max_examples=300, deadline=None)
@given(st.one_of(ODD, st.text(max_size=60)))
def test_ids_are_the_library_s(text):
    assert ids(CODER, text) == theirs(text)
    assert CODER.decode([CODER.encode([text])[0]]) == [LIBRARY.decode(theirs(text))]


@settings(max_examples=100, deadline=None)
@given(st.lists(ODD, max_size=12))
def test_agendas_move_together(texts):
    CODER.memory._empty()
    assert [x.tolist() for x in CODER.encode(texts)] == [theirs(t) for t in texts]


def test_long_segments_use_a_heap():
    for text in ("x" * 50_000, " " * 20_000 + "ab" * 30_000, prose(1, 20_000), "日本" * 9000 + "é" * 63):
        assert ids(CODER, text) == theirs(text)


def test_a_difference_is_an_error():
    coder = Pieces(PATH)
    coder.letter = coder.letter.copy()
    coder.letter[ord("q")] = coder.ids["x"]
    with pytest.raises(RuntimeError, match="the library"):
        coder.encode(["one queue", "two"])


def test_round_trip(spark):
    for df, rows in ((odd_documents(spark), odd_texts()), (spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), None)):
        rows = rows or [(r["doc_id"], r["text"]) for r in df.collect()]
        want = []
        for i, t in rows:
            x = theirs(t or "")
            want.append((i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(x).encode()).hexdigest()))
        assert sorted(map(tuple, round_trip(df, PATH).collect()), key=str) == sorted(want, key=str)
    assert round_trip(odd_documents(spark, empty=True), PATH).collect() == []


def test_encode_then_decode(spark):
    docs = odd_documents(spark)
    encoded = encode(docs, PATH)
    assert sorted(((r["doc_id"], list(r["ids"])) for r in encoded.collect()), key=str) == sorted(((i, theirs(t or "")) for i, t in odd_texts()), key=str)
    assert sorted(map(tuple, decode(encoded, PATH).collect()), key=str) == sorted(((i, t or "") for i, t in odd_texts()), key=str)
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [tuple(r) for r in decode(nothing, PATH).collect()] == [(1, None)]
