import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from reunion.llm.simhash import Tree, block_masks, fingerprint, links, near_duplicates, representatives, shard_forest

from .util import odd_documents, odd_texts

SF001 = "/root/testdata/sf0.001"


def slow_fingerprint(text, n=4):
    w = text.encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes_of(fps, bits=4):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def expected(rows):
    fps = [slow_fingerprint(t or "") for _, t in rows]
    roots = classes_of(fps)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, roots)), key=str)


def test_fingerprints():
    for _, t in odd_texts():
        assert fingerprint((t or "").encode()) == slow_fingerprint(t or "")


def test_odd_rows_and_whole_table(spark):
    got = sorted(map(tuple, near_duplicates(odd_documents(spark)).collect()), key=str)
    assert got == expected(odd_texts())
    assert near_duplicates(odd_documents(spark, empty=True)).collect() == []
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, near_duplicates(docs).collect()), key=str) == expected(rows)


def planted(seed, n_centres=60, copies=25):
    rng = np.random.default_rng(seed)
    out = set()
    for c in rng.integers(0, 1 << 63, n_centres, np.uint64):
        out.add(int(c))
        for _ in range(int(rng.integers(0, copies))):
            x = int(c)
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                x ^= 1 << int(b)
            out.add(x)
    dense = int(rng.integers(0, 1 << 63))  # a dense group, equal in one block
    out |= {dense ^ (1 << a) ^ (1 << b) for a in range(40, 64) for b in range(40, 64)}
    return sorted(out)


def test_links_find_every_class(spark):
    from reunion.operators.components import connected_components

    for seed, shard in ((1, 40), (2, 5000)):
        fps = planted(seed)
        df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long").repartition(3).persist()
        e = links(df, len(fps), sample=300, shard=shard)
        roots = {r["node"]: r["root"] for r in connected_components(e, "a", "b").collect()}
        got = [roots.get(int(np.uint64(x).view(np.int64)), int(np.uint64(x).view(np.int64))) for x in fps]
        want = classes_of(fps)
        assert len(set(zip(got, want))) == len(set(want)) == len(set(got))
        df.unpersist()


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 1000), st.sampled_from([1, 2, 3]))
def test_trees_and_forest(seed, blocks):
    fps = np.array(planted(seed, 12, 12), np.uint64)
    for m in block_masks(blocks):
        tree = Tree.grow(fps, m, 4 // blocks, 4, 10)
        at, leaf = tree.route(fps, False)
        assert sorted(at.tolist()) == list(range(len(fps)))
        visits = set(zip(*(x.tolist() for x in tree.route(fps, True))))
        home = dict(zip(at.tolist(), leaf.tolist()))
        d = np.bitwise_count((fps[:, None] ^ fps[None, :]) & np.uint64(m))
        full = np.bitwise_count(fps[:, None] ^ fps[None, :])
        for i, j in zip(*np.nonzero((d <= 4 // blocks) & (full <= 4))):
            assert (int(i), home[int(j)]) in visits  # the ball's overlap reaches every near neighbour's home
    a, b = shard_forest(fps, fps[:0], (1 << 64) - 1, 4, 4)
    assert len(a) == len(fps) - len(set(classes_of([int(x) for x in fps])))


def test_representatives(spark):
    kept = representatives(odd_documents(spark)).collect()
    want = expected(odd_texts())
    assert len(kept) == len({c if c is not None else f for _, f, c in want})
    assert {r["doc_id"] for r in kept} == {c for _, _, c in want}
    assert kept[0].__fields__[:2] == ["doc_id", "text"] and len(kept[0]) == 12
    assert representatives(odd_documents(spark, empty=True)).collect() == []
