import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from reunion.llm.spelling import PositionIndex, spelling_variants

from .util import documents, odd_documents, odd_texts


def one_apart(a: str, b: str) -> bool:
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def deletions(w):
    return {w[:k] + w[k + 1 :] for k in range(len(w))} | {w}


def brute(rows, every=97, least=5, count=3):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= least:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= count}
    share = {}
    for w in counts:
        for d in deletions(w):
            share.setdefault(d, set()).add(w)
    form, near = {}, {}
    for w, n in counts.items():
        near[w] = [v for v in set().union(*(share[d] for d in deletions(w))) if one_apart(w, v)]
        best = min(near[w], key=lambda v: (-counts[v], v.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def variants(df, **options):
    out = spelling_variants(df, **options)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


def misspelt(seed: int, n_docs: int) -> list[tuple[int, str]]:
    """Texts over a few stems, their endings and random slips, so that forms make chains."""
    rng = random.Random(seed)
    stems = ["kitten", "sitting", "straße", "élève", "morning", "aaaaa", "abcabc", "noisette"]

    def slip(w):
        k = rng.randrange(len(w) + 1)
        c = rng.choice("aeßéçxyz")
        return rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :], w])

    def word():
        w = rng.choices(stems, weights=range(1, 9))[0]
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
            w = slip(w)
        return rng.choice([w, w.upper() if w.isascii() else w])

    return [(i, " ".join(word() for _ in range(60))) for i in range(n_docs)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=150, unique=True), st.data())
def test_index_finds_words_one_apart(words, data):
    index = PositionIndex(words)
    size = data.draw(st.integers(1, 8))
    queries = data.draw(st.lists(st.text("abéx", min_size=size, max_size=size), min_size=1, max_size=20))
    q, v = index.near(queries)
    assert set(zip(q.tolist(), v.tolist())) == {(i, j) for i, a in enumerate(queries) for j, b in enumerate(words) if one_apart(a, b)}
    assert len(q) == len(set(zip(q.tolist(), v.tolist())))


def test_odd_input(spark):
    assert variants(odd_documents(spark)) == brute(odd_texts())
    assert variants(odd_documents(spark, empty=True)) == []


def test_chains_and_ties(spark):
    rows = misspelt(4, 120)
    want = brute(rows)
    assert any(w[1] and w[2] != w[1] for w in want)  # chains of forms
    assert sum(w[4] for w in want) > 500
    assert variants(documents(spark, rows).repartition(6)) == want


def test_shards_in_tiles(spark):
    rows = misspelt(8, 150)
    assert variants(documents(spark, rows), shard_words=16) == brute(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert variants(docs) == brute(rows)
