import hashlib
import re
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reunion.llm.pii import KINDS, LABELS, Field, Words, base_spans, find, fit, labelled, luhn, personal_data, redact, redacted, seed_rows, train

from .util import EXTRA, PII, odd_documents, odd_texts, prose

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(len(x.lstrip("0")) < 4 and int(x) < 256 for x in m.group().split(".")), "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text("ab.@-+ 0123456789()\né%", max_size=60))
def test_patterns(text):
    assert base_spans(text) == plain(text)


@pytest.fixture(scope="module")
def field():
    return train(labelled(seed_rows() * 3))


def test_report(spark, field):
    got = sorted(map(tuple, personal_data(odd_documents(spark), field=field).collect()), key=str)
    assert len(got) == len(odd_texts())
    rows = {}
    for i, t in odd_texts():
        if len(t or "") < 9000:
            rows.setdefault(i, []).append(plain(t or ""))
    for r in got:
        for spans in rows.get(r[0], [])[:1]:
            if len(rows[r[0]]) == 1:
                written = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
                assert r[1:5] == tuple(sum(x[1] == k for x in spans) for k in range(4))
                assert r[5] == hashlib.sha256(written.encode()).hexdigest()
                assert set(filter(None, written.split(","))) <= set(r[6].split(","))
    assert personal_data(odd_documents(spark, empty=True)).collect() == []


def test_viterbi_and_bound(field):
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(24, LABELS))
    starts, lengths = np.array([0, 4, 5, 11, 18]), np.array([4, 1, 6, 7, 6])
    got = field.viterbi(scores, starts, lengths)
    for s, n in zip(starts, lengths):
        best = max(product(range(LABELS), repeat=int(n)), key=lambda y: field.first[y[0]] + sum(scores[s + k, y[k]] for k in range(n)) + sum(field.step[a, b] for a, b in zip(y, y[1:]))) if n <= 6 else None
        if best is not None:
            assert got[s : s + n].tolist() == list(best)
    # what the bound leaves out is what decoding would leave out
    texts = [t or "" for _, t in odd_texts()] + [x for x, _ in seed_rows()]
    w = Words([t.encode() for t in texts])
    starts = np.flatnonzero(w.new)
    full = field.viterbi(field.scores(w.features), starts, np.diff(np.r_[starts, len(w.start)]))
    assert (field.label(w) == full).all()


def test_field_learns(field):
    rows = seed_rows()
    hit = 0
    for text, spans in rows:
        base, added = find(field, [text])
        hit += all(any(k == kind and x < b and y > a for x, k, y in base[0] + added[0]) for a, kind, b in spans) and (bool(spans) or not added[0])
    assert hit >= len(rows) - 2
    assert find(field, ["dial 555-010-9921 for help"])[1][0]  # a form that no pattern has
    assert find(field, [prose(3, 400)])[1] == [[]]


def test_redaction(spark, field):
    text = PII + " tail"
    out = redact(text, base_spans(text))
    assert out == "Mail <email> or call <phone>, host <ip>, card <card>. tail" or "jane" not in out
    docs = odd_documents(spark)
    got = redacted(docs, field=field)
    assert got.columns == docs.columns
    rows = got.collect()
    assert len(rows) == len(odd_texts()) and {r[EXTRA[0]] for r in rows} == {"x"}
    assert not any(base_spans(r["text"]) for r in rows if r["text"] and r["doc_id"] in (9, 13))
    assert sum(r["text"] is None for r in rows) == sum(t is None for _, t in odd_texts())


def test_fit_on_a_table(spark):
    f = fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert isinstance(f, Field) and f.emit.any()


def test_training_lines_are_spread(spark):
    """The lines come from all of the table, each once, and are the same at any layout."""
    from reunion.llm.pii import train_lines

    rows = [(f"source {i // 500} {prose(i, 5)} {'1234' if i % 2 else ''}{i:05d}" + "\ncommon line\ncommon 12345 line",) for i in range(2000)]
    df = spark.createDataFrame(rows, "text string").coalesce(1)
    got = train_lines(df, lines=120)
    assert len(got) == len(set(got)) == 80 + 1  # without a number there is the common line only
    per = [sum(x.startswith(f"source {k} ") for x in got) for k in range(4)]
    assert min(per) >= 8
    assert got == train_lines(df.repartition(5).orderBy(F.col("text").desc()), lines=120)


def plain_spans(field, text):
    """All spans of one whole text: the patterns', and those of a decode line by line and word by word."""
    base = plain(text)
    data = text.encode()
    w = Words([data])
    scores = field.scores(w.features)
    cuts = np.flatnonzero(w.new).tolist()
    added = []
    for s, e in zip(cuts, [*cuts[1:], len(scores)]):
        best, back = [field.first[y] + scores[s, y] for y in range(LABELS)], []
        for k in range(s + 1, e):
            from_ = [max(range(LABELS), key=lambda x: best[x] + field.step[x, y]) for y in range(LABELS)]
            best = [best[from_[y]] + field.step[from_[y], y] + scores[k, y] for y in range(LABELS)]
            back.append(from_)
        labels = [max(range(LABELS), key=lambda y: best[y])]
        for from_ in reversed(back):
            labels.insert(0, from_[labels[0]])
        k = 0
        while k < e - s:
            last = k
            while labels[k] >= 3 and last + 1 < e - s and labels[last + 1] == labels[k]:  # a card or phone of several words
                last += 1
            if labels[k]:
                a, b = int(w.start[s + k]), int(w.end[s + last])
                edge = b".,;:!?<>()[]{}\"'"
                while a < b and data[a : a + 1] in [bytes([c]) for c in edge]:
                    a += 1
                while b > a and data[b - 1 : b] in [bytes([c]) for c in edge]:
                    b -= 1
                x, y = len(data[:a].decode()), len(data[:b].decode())
                if x < y and not any(p < y and q > x for p, _, q in base):
                    added.append((x, labels[k] - 1, y))
            k = last + 1
    return base, sorted(base + added)


def test_whole_documents_against_a_plain_decode(spark, field):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()] + [(-1, PII.replace("@", " at ")), (-2, "call 555-4827 or (632) 555 4827 now")]
    got = {r["doc_id"]: r for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string"), field=field).collect()}
    more = 0
    for i, t in rows:
        base, spans = plain_spans(field, t)
        assert got[i]["spans"] == ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans), i
        more += len(spans) - len(base)
    assert more == sum(r["n_added"] for r in got.values()) > 0
