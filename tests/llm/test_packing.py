import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from hypothesis import given, settings
from hypothesis import strategies as st

from reunion.llm.packing import Encoder, Packer, pack

from .util import odd_documents, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_sequences(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append(r)
    for pieces in by.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for p in pieces:
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= 2048 and at & (at - 1) == 0  # a power of two: no padding
        assert {p["tier"] for p in pieces} == {at}
    return by


def test_pieces_and_ids(spark):
    tok = Tokenizer.from_file(PATH)
    rows = pack(odd_documents(spark), PATH, with_ids=True).collect()
    check_sequences(rows)
    pieces = defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        pieces[r["doc_id"]].append(r)
    texts = defaultdict(list)
    for i, t in odd_texts():
        texts[i].append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    assert set(pieces) == set(texts)
    for i, want in texts.items():
        got = sorted(pieces[i], key=lambda r: r["start"])
        assert sum(r["length"] for r in got) == sum(map(len, want))
        if len(want) == 1:
            assert [x for r in got for x in r["ids"]] == want[0]
            assert [r["start"] for r in got] == np.cumsum([0, *[r["length"] for r in got[:-1]]]).tolist()
            assert {r["doc_tokens"] for r in got} == {len(want[0])}


def test_step_groups_are_even(spark):
    rows = pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH, step_tokens=8192).collect()
    by = check_sequences(rows)
    tokens = defaultdict(int)
    for pieces in by.values():
        tokens[pieces[0]["step_group"]] += pieces[0]["tier"]
    assert max(tokens.values()) == 8192 and sum(t == 8192 for t in tokens.values()) > 0.8 * len(tokens)


def test_empty_table(spark):
    assert pack(odd_documents(spark, empty=True), PATH).collect() == []


def test_packer_places_every_token():
    rng = np.random.default_rng(0)
    for tiers in ((2048, 1024, 512, 256), (64, 16), (8,)):
        sizes = rng.integers(1, 3 * tiers[0], 300).tolist()
        seen, seqs = defaultdict(list), []
        p = Packer(lambda size, pieces: (seqs.append((size, pieces)), [seen[d].append((s, n)) for d, s, n in pieces]), tiers)
        for i, n in enumerate(sizes):
            p.add(i, n)
            if i % 50 == 0:
                p.pack()
        p.finish()
        for i, n in enumerate(sizes):
            at = 0
            for s, k in sorted(seen[i]):
                assert s == at
                at += k
            assert at == n
        assert all(sum(n for _, _, n in pieces) == size for size, pieces in seqs)


ENCODER, TOKENIZER = Encoder(PATH), Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", " the", "ing", " ", "  ", "\n", "\t", "é", "\u3000", "\xa0", "\x1f", "<|endoftext|>", " <|endoftext|>", "<|end", "'s", "9", "日本"]), max_size=15).map("".join), max_size=4))
def test_ids_are_the_library_s(texts):
    """Also where a special token stands in a text."""
    assert [x.tolist() for x in ENCODER.encode(texts)] == [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


def test_new_segments_are_learnt_in_two_calls():
    """Without offsets, in one text for those between spaces and one call for the rest, and no segment twice."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, enc, calls = Tokenizer.from_file(path), Encoder(path), []

    class Library:
        def encode_batch_fast(self, texts, add_special_tokens):
            calls.append(list(texts))
            return plain.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    enc.tok = Library()
    texts = ["One two  three\n", " two d\u00e9j\u00e0 vu\u00a0 two\x00 x\x1f y", "two <|endoftext|> three", "", None]
    got = enc.encode(texts)
    assert [x.tolist() for x in got] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(calls) == 2 and len(calls[1]) == 1
    enc.encode(texts)
    assert len(calls) == 2
