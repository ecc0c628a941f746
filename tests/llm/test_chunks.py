import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from reunion.llm.chunks import GEAR, MIN_WORDS, cut_points, deduplicated, gear_hashes, steps, substring_report

from .util import EXTRA, PASSAGE, documents, odd_documents, odd_texts, prose


def brute(rows, min_words=MIN_WORDS):
    """``(id, text, n_chunks, n_dup, removed)`` by a table of every chunk of every text."""
    cut = []
    for i, t in rows:
        b = (t or "").encode()
        ends = cut_points(b).tolist()
        cut.append([(s, e, xxhash.xxh3_128_digest(b[s:e])) for s, e in zip([0, *ends], ends)])
    big = 2**63 - 1
    owner = {}
    for (i, _), chunks in zip(rows, cut):
        for _, _, d in chunks:
            owner[d] = min(owner.get(d, big), big if i is None else i)
    out = []
    for (i, t), chunks in zip(rows, cut):
        b, seen, dup = (t or "").encode(), set(), []
        for _, _, d in chunks:
            dup.append(owner[d] != (big if i is None else i) or d in seen)
            seen.add(d)
        gone, k = [], 0
        while k < len(dup):
            j = k
            while j < len(dup) and dup[j]:
                j += 1
            if j > k:
                s, e = chunks[k][0], chunks[j - 1][1]
                before = b[:s][-1:]
                n = len(b[s:e].split()) - bool(before and not before.isspace() and not b[s : s + 1].isspace())
                if n >= min_words:
                    gone.append((s, e))
            k = max(j, k + 1)
        kept, at = b"", 0
        for s, e in gone:
            kept, at = kept + b[at:s], e
        spans = ",".join(f"{len(b[:s].decode())}:{len(b[:e].decode())}" for s, e in gone)
        out.append((i, None if t is None else (kept + b[at:]).decode(), len(chunks), sum(dup), spans))
    return sorted(out, key=str)


def report(df):
    return sorted(((r["doc_id"], r["text"], r["n_chunks"], r["n_duplicate_chunks"], r["removed"]) for r in substring_report(df).collect()), key=str)


def test_against_brute_force(spark):
    got = report(odd_documents(spark))
    assert got == brute(odd_texts())
    assert any(g[4] for g in got)
    assert substring_report(odd_documents(spark, empty=True)).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert report(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_passages_go_once_and_clean_texts_stay(spark):
    rows = [(i, prose(i, 200)) for i in range(40)]
    rows += [(100 + i, f"{prose(500 + i, 60)} {PASSAGE} {prose(600 + i, 60)}") for i in range(30)]
    out = {r["doc_id"]: r for r in substring_report(documents(spark, rows).repartition(5)).collect()}
    assert all(out[i]["removed"] == "" for i in range(40))
    assert out[100]["removed"] == ""
    core = " ".join(PASSAGE.split()[30:50])
    assert all(core not in out[100 + i]["text"] and out[100 + i]["removed_chars"] > 0 for i in range(1, 30))


def test_columns_pass(spark):
    docs = odd_documents(spark)
    out = deduplicated(docs, report=False)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert {r[EXTRA[0]] for r in out.collect()} == {"x"}


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=400))
def test_gear_hash(data):
    a = np.frombuffer(data, np.uint8)
    got = gear_hashes(a) if len(a) else a
    for i in range(len(a)):
        want = sum(int(GEAR[a[i - j]]) << (2 * j) for j in range(min(i + 1, 32))) % (1 << 64)
        assert int(got[i]) == want


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=300), st.integers(0, 10**6), st.text(min_size=1, max_size=5))
def test_insertions_change_nearby_cuts_only(text, seed, inserted):
    base = text + " " + prose(seed, 120)
    at = len(text) // 2
    a, b = base.encode(), (base[:at] + inserted + base[at:]).encode()
    shift, edge = len(b) - len(a), len((base[:at]).encode())
    assert {x + shift for x in cut_points(a) if x > edge + 40} == {x for x in cut_points(b) if x > edge + shift + 40}
    assert {x for x in cut_points(a) if x < edge} == {x for x in cut_points(b) if x < edge}


def test_passages_without_white_space_go_once(spark):
    """A passage that two texts share goes from the later one, and so does a whole copy, though neither has 15 words."""
    rng = np.random.default_rng(5)
    han = lambda n: "".join(map(chr, rng.integers(0x4E00, 0x9FA0, n)))
    blob = lambda n: "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), n))
    for kind in (han, blob):
        shared, short, copied = kind(400), kind(60), kind(500)
        rows = [(1, kind(150) + shared + kind(150)), (2, kind(170) + shared + kind(130)), (3, copied), (4, copied)]
        rows += [(5, f"{kind(200)} {short} {kind(200)}"), (6, f"{kind(200)} {short} {kind(200)}")]
        out = {r["doc_id"]: r for r in substring_report(documents(spark, rows)).collect()}
        assert [out[i]["removed"] for i in (1, 3, 5, 6)] == [""] * 4
        assert out[4]["text"] == ""
        assert shared[100:300] not in out[2]["text"] and 250 <= out[2]["removed_chars"] <= 400
        assert rows[1][1][:170] == out[2]["text"][:170] and rows[1][1][-130:] == out[2]["text"][-130:]


def rows_of(df):
    return sorted(((r["doc_id"], r["text"], r["n_chunks"], r["n_duplicate_chunks"], r["removed"]) for r in df.collect()), key=str)


def test_answers_do_not_depend_on_the_order_of_rows():
    """Question and answer over four groups, whose rows come in another order each time they are read."""
    docs = [(i, f"{prose(i, 70)} {PASSAGE} {prose(900 + i, 50)}" if i % 3 else prose(i, 150)) for i in range(48)] + [(i, prose(i - 40, 150)) for i in range(50, 60)]
    ask, answer, cut_out = steps([], buckets=7)
    rng = np.random.default_rng(1)

    def group(g):
        mine = [d for d in docs if d[0] % 4 == g]
        order = rng.permutation(len(mine))
        return pa.table({"_id": pa.array([mine[k][0] for k in order], pa.int64()), "_text": pa.array([mine[k][1] for k in order], pa.string())})

    asked = pa.concat_tables([ask((pa.scalar(g),), group(g)) for g in range(4)])
    asked = asked.take(pa.array(rng.permutation(asked.num_rows)))
    parts = [answer((), asked.filter(pa.compute.equal(asked["bucket"], b))) for b in set(asked["bucket"].to_pylist())]
    replies = pa.concat_tables(parts)
    replies = replies.take(pa.array(rng.permutation(replies.num_rows)))
    got = {}
    for g in range(4):
        rows = group(g)
        out = cut_out((pa.scalar(g),), rows, replies.filter(pa.compute.equal(replies["_g"], g)))
        got |= dict(zip(rows["_id"].to_pylist(), zip(out["_text"].to_pylist(), out["removed"].to_pylist())))
    assert got == {i: (text, spans) for i, text, _, _, spans in brute(docs)}
    assert sum(spans != "" for _, spans in got.values()) > 30


def test_many_groups(spark):
    """Groups bounded by documents, or by the bytes of long texts, give what one group gives."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows_of(deduplicated(docs.repartition(7), group_docs=9)) == want
    assert rows_of(deduplicated(docs.repartition(5), group_bytes=20_000)) == want


def test_ids_must_be_integers(spark):
    with pytest.raises(ValueError, match="integers"):
        deduplicated(spark.createDataFrame([("a", "text")], "doc_id string, text string"))
