import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from reunion.llm import pst
from reunion.llm.pst import DIVERGENCE, LEAST, lm_scores

from .util import documents, odd_documents, odd_texts, prose

SF001 = "/root/testdata/sf0.001"
START, STOP = "<start>", "<end>"


def is_held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def words_of(t):
    return [START, *(t or "").encode().lower().split(), STOP]


def brute(rows, least=LEAST, divergence=DIVERGENCE):
    """Counts, retained contexts and scores, straight from the definition."""
    after = defaultdict(Counter)
    for i, t in rows:
        if not is_held(i):
            w = words_of(t)
            for k in range(1, len(w)):
                for size in (0, 1, 2):
                    if k >= size:
                        after[tuple(w[k - size : k])][w[k]] += 1
    root = after[()]
    n, v = sum(root.values()), len(root)

    def diverges(ctx):
        own, up = after[ctx], after[ctx[1:]]
        m, pm = sum(own.values()), sum(up.values())
        return m >= least and sum(c * math.log(c / m / (up[s] / pm)) for s, c in own.items()) >= divergence * len(own)

    kept = {c for c in list(after) if len(c) == 1 and diverges(c)}
    kept |= {c for c in list(after) if len(c) == 2 and c[1:] in kept and diverges(c)}

    def p(ctx, s):
        if not ctx:
            return (root[s] + 1) / (n + v + 1)
        own = after[ctx]
        return (own[s] + len(own) * p(ctx[1:], s)) / (sum(own.values()) + len(own))

    out = []
    for i, t in rows:
        w, score = words_of(t), 0.0
        for k in range(1, len(w)):
            state = next(c for c in (tuple(w[max(0, k - size) : k]) for size in (2, 1, 0)) if not c or c in kept)
            score += math.log10(p(state, w[k]))
        toks = w[1:]
        out.append((i, is_held(i), len(toks), sum(root[x] > 0 for x in toks), n, sum(math.log10(p((), x)) for x in toks), score))
    return out, kept, p, root


def same(got, want):
    got, want = sorted(map(tuple, got), key=lambda r: (str(r[0]), r[2], r[5])), sorted(want, key=lambda r: (str(r[0]), r[2], r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


def sentences(n):
    rng = random.Random(5)
    return [(100 + i, " ".join(rng.choice(["the cat sat on the mat", "the dog sat on a log", "a cat and a dog", prose(i, 6)]) for _ in range(8))) for i in range(n)]


def test_against_the_definition(spark, monkeypatch):
    monkeypatch.setattr(pst, "CHUNK", 2_000)  # a chunk holds a few texts, so that every count is one of several chunks
    rows = odd_texts() + sentences(60)
    for least, divergence in ((LEAST, DIVERGENCE), (1, 0.0), (3, 2.5), (10**9, 0.0)):
        want, kept, _, _ = brute(rows, least, divergence)
        same(lm_scores(documents(spark, rows).repartition(3), least=least, divergence=divergence).collect(), want)
        if least == LEAST:
            assert {1, 2} == {len(c) for c in kept}
        if least == 10**9:
            assert not kept and all(math.isclose(w[5], w[6]) for w in want)


def test_odd_rows(spark):
    same(lm_scores(odd_documents(spark)).collect(), brute(odd_texts())[0])
    assert lm_scores(odd_documents(spark, empty=True)).collect() == []
    held = [i for i in range(60) if is_held(i)]
    got = lm_scores(documents(spark, [(i, "a b") for i in held])).collect()  # nothing to learn from
    assert len(got) == len(held)
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0.0 and r["score"] == 0.0 for r in got)
    with pytest.raises(ValueError):
        lm_scores(odd_documents(spark), least=0)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    same(lm_scores(docs).collect(), brute(rows)[0])


def test_probabilities_add_up(spark):
    """After every context, retained or not, all known words and the unknown one have probability one together."""
    rows = sentences(40)
    want, kept, p, root = brute(rows)
    assert len(kept) > 20
    for ctx in kept | {()}:
        assert math.isclose(sum(p(ctx, s) for s in root) + p(ctx, b"never seen"), 1.0)
    same(lm_scores(documents(spark, rows)).collect(), want)


def test_learns_more_from_more(spark):
    """Held-out texts are likelier than under the base, and no less so with more text to learn from."""
    def gain(docs):
        r = lm_scores(docs).where("held_out").selectExpr("sum(score) / sum(n_tokens)", "sum(base_score) / sum(n_tokens)").collect()[0]
        return r[0], r[0] - r[1]

    small, large = gain(spark.read.parquet(f"{SF001}/documents.parquet")), gain(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert small[1] > 0 and large[1] > 0.1 and large[1] > small[1]
