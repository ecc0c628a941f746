"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

Words (cut at ASCII white space, in sequences of at most ``WINDOW`` words of one line) get features
of their shape: collapsed character classes, digit and length buckets, first and last class,
separators, whether digits check out as a card or an address, and the same of the neighbouring words. The field is
trained by maximum likelihood (L2, Adam) on a small labelled table: ``SEEDS`` written out here, and
at most ``TRAIN_LINES`` lines of the table itself, labelled by the patterns. Decoding is Viterbi
over padded numpy batches. A sequence whose words all favour "other" by more than the transitions
could ever make up is all "other" without decoding; that bound is exact.

The patterns' spans always stand; the field adds the spans it finds where no pattern matched.

Results for odd input: a null text counts as empty; null ids and repeated rows keep their rows; an
empty table gives an empty result; extra columns are ignored (``redacted`` passes them on).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, picked, texts

KINDS = ("email", "ip", "card", "phone")
OTHER = 0  # labels: 0 other, then 1 + place in KINDS
LABELS = 1 + len(KINDS)
WINDOW = 256
BUCKETS = 1 << 15
TRAIN_LINES = 600
EPOCHS = 60
L2 = 1e-3

# The base patterns (an email's local part is found from its @).
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits can only start a match at its first digit, so the others needn't be tried.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

#: Labelled rows of forms that the patterns don't cover, beside some that they do: text with the data in brackets.
SEEDS = (
    ("phone", "call me at [555-010-4477] before noon"),
    ("phone", "phone: [(020) 7946 0958] or write to us"),
    ("phone", "tel [030-1234567] in the morning"),
    ("phone", "our number is [+49 30 1234567] for orders"),
    ("phone", "mobile [0171/2345678] at any time"),
    ("phone", "reach the desk at [+1 (632) 555-4827] today"),
    ("email", "write to [jane.doe@example.com] for more"),
    ("email", "mail <[john_smith@mail.example.org]> please"),
    ("email", "contact [info@localhost] about it"),
    ("email", "send it to [kim.lee(at)example.com] soon"),
    ("ip", "the host [192.168.10.44] was down"),
    ("ip", "from [10.0.0.1:8080] to the gateway"),
    ("ip", "address [2001:db8:0:1::8a2e] is in use"),
    ("card", "card [4111 1111 1111 1111] was charged"),
    ("card", "paid with [5500-0000-0000-0004] last week"),
    ("card", "number [4337166598464399] on file"),
    ("", "in 1998 there were 1,204 people in 12 towns"),
    ("", "version 3.14.1 of 2020-05-17 costs 19.99 in 4 parts"),
    ("", "the order 20948571 of 11:45 has 300 items"),
    ("", "the cat sat on the mat and it was all well."),
    ("", "see chapter 7, pages 120-134, and table 2.1 there"),
    ("", "A. B. Smith and C++ code; e.g. this, i.e. that"),
)


# --- base patterns ------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(t: str) -> Iterator[tuple[int, int]]:
    end, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > end and t[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = t.find("@", max(at + 1, end))


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the patterns, leftmost and not overlapping per kind; failing matches are dropped."""
    out = []
    if "@" in t:
        out += [(a, 0, b) for a, b in _emails(t)]
    if DIGIT.search(t):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(t):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in t:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    out.sort()
    return out


# --- features ------------------------------------------------------------------

_CLASS = np.full(256, 1, np.uint8)  # 1: other punctuation
_CLASS[list(b" \t\n\r\x0b\x0c")] = 0
_CLASS[list(range(ord("a"), ord("z") + 1))] = 2
_CLASS[list(range(ord("A"), ord("Z") + 1))] = 3
_CLASS[list(range(ord("0"), ord("9") + 1))] = 4
_CLASS[128:] = 5
for _k, _c in enumerate(b"@.-+()_%:/,"):
    _CLASS[_c] = 6 + _k
_DIGIT_BUCKET = np.array([0, 1, 2, 3, 4, 5, 5, 6, 6, 7, 7, 7, 8, 8, 8, 9, 9, 9, 9, 9] + [10] * 237, np.uint64)
N_FEATURES = 6


def _mix(kind: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), kind + 1, np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


class Words:
    """The words of some texts, as byte spans in their concatenation, and their feature buckets."""

    def __init__(self, every: list[bytes]):
        joined = b"\n".join(every) + b"\n"
        a = np.frombuffer(joined, np.uint8)
        c = _CLASS[a]
        word = c != 0
        edge = np.flatnonzero(np.diff(np.r_[False, word, False].astype(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        self.data = joined
        sizes = np.array([len(t) + 1 for t in every], np.int64)
        self.text_start = np.cumsum(sizes) - sizes
        self.text = np.searchsorted(self.text_start, self.start, "right") - 1
        n = len(self.start)
        # sequences: a new one at each line and after WINDOW words
        line = np.r_[0, np.cumsum(a == 10)][self.start]
        new_line = np.r_[True, line[1:] != line[:-1]] if n else np.zeros(0, bool)
        first = np.flatnonzero(new_line)
        place = np.arange(n) - first[np.cumsum(new_line) - 1] if n else np.zeros(0, np.int64)
        self.new = new_line | (place % WINDOW == 0)
        if not n:
            self.features = np.zeros((0, N_FEATURES), np.int64)
            return

        def count(cls: int) -> np.ndarray:
            total = np.r_[0, np.cumsum(c == cls)]
            return total[self.end] - total[self.start]

        digits, ats, dots, dashes, colons = count(4), count(6), count(7), count(8), count(14)
        size = np.minimum(self.end - self.start, 255)
        # collapsed shape: a position-weighted sum over the places where the class changes
        change = word.copy()
        change[1:] &= c[1:] != c[:-1]
        at = np.flatnonzero(change)
        own = np.searchsorted(at, self.start)
        rank = np.arange(len(at)) - np.repeat(own, np.diff(np.r_[own, len(at)]))
        weight = np.cumprod(np.full(24, 1_000_003, np.uint64))
        shape = np.add.reduceat((c[at].astype(np.uint64) + np.uint64(1)) * weight[np.minimum(rank, 23)], own)
        checks = np.zeros(n, np.uint64)
        for i in np.flatnonzero((digits >= 12) & (digits <= 19)):
            w = joined[self.start[i] : self.end[i]]
            checks[i] = 1 if luhn("".join(chr(x) for x in w if 48 <= x <= 57)) else 2
        for i in np.flatnonzero((dots >= 3) & (digits >= 4) & (ats == 0)):
            w = joined[self.start[i] : self.end[i]].decode()
            m = IP.search(w)
            checks[i] = 3 if m and all(len(p) <= 3 and int(p) <= 255 for p in m.group().split(".")) else 4
        bucket = _DIGIT_BUCKET[np.minimum(digits, 255)]
        head, tail = c[self.start], c[self.end - 1]
        brief = bucket * np.uint64(64) + np.minimum(dots, 3).astype(np.uint64) * np.uint64(16) + np.minimum(dashes, 2).astype(np.uint64) * np.uint64(4) + np.minimum(ats, 1).astype(np.uint64) * np.uint64(2) + (colons > 0)
        before, after = np.r_[np.uint64(0), brief[:-1] + np.uint64(1)], np.r_[brief[1:] + np.uint64(1), np.uint64(0)]
        before[self.new] = 0
        after[np.r_[self.new[1:], True]] = 0
        self.features = np.stack([
            _mix(0, shape),
            _mix(1, bucket, np.minimum(size // 4, 12), checks),
            _mix(2, brief, head, tail),
            _mix(3, brief, before),
            _mix(4, brief, after),
            _mix(5, brief, checks, head),
        ], axis=1)


# --- the field -------------------------------------------------------------------


class Field:
    """Weights ``emit (BUCKETS, LABELS)``, ``step (LABELS, LABELS)``, ``first (LABELS)``."""

    def __init__(self, emit: np.ndarray, step: np.ndarray, first: np.ndarray):
        self.emit, self.step, self.first = emit, step, first

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), LABELS))
        for k in range(N_FEATURES):
            out += self.emit[features[:, k]]
        return out

    def slack(self) -> float:
        """What a word can gain by its two transitions (or by coming first) over staying "other"."""
        gain = self.step.max() - self.step[OTHER, OTHER]
        return 2 * max(gain, 0.0) + max(0.0, self.first.max() - self.first[OTHER])

    def viterbi(self, scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of the sequences ``scores[start : start + length]``, laid end to end."""
        out = np.zeros(len(scores), np.int8)
        order = np.argsort(lengths, kind="stable")
        for group in np.array_split(order, max(1, int(lengths.sum() // 200_000) + 1, int(np.ceil(np.log2(len(lengths) + 1))))):
            if not len(group):
                continue
            n, t = lengths[group], int(lengths[group].max())
            at = starts[group][:, None] + np.minimum(np.arange(t)[None, :], n[:, None] - 1)
            s = scores[at]
            best = s[:, 0] + self.first
            back = np.zeros((len(group), t, LABELS), np.int8)
            for k in range(1, t):
                through = best[:, :, None] + self.step[None]
                back[:, k] = through.argmax(axis=1)
                new = through.max(axis=1) + s[:, k]
                best = np.where((k < n)[:, None], new, best)
            label = best.argmax(axis=1)
            rows = np.arange(len(group))
            for k in range(t - 1, -1, -1):
                live = k < n
                out[at[live, k]] = label[live]
                move = live & (k > 0)
                label[move] = back[rows[move], k, label[move]]
        return out

    def label(self, words: Words) -> np.ndarray:
        """A label for each word."""
        n = len(words.start)
        out = np.zeros(n, np.int8)
        if not n:
            return out
        scores = np.empty((n, LABELS))
        for s in range(0, n, 1 << 18):
            scores[s : s + (1 << 18)] = self.scores(words.features[s : s + (1 << 18)])
        starts = np.flatnonzero(words.new)
        lengths = np.diff(np.r_[starts, n])
        lead = scores[:, OTHER] - scores[:, 1:].max(axis=1)
        doubt = np.logical_or.reduceat(lead <= self.slack(), starts)
        if doubt.any():
            at = starts[doubt]
            labels = self.viterbi(scores, at, lengths[doubt])
            out = labels
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.15, l2: float = L2) -> Field:
    """Fit the field on ``(features, labels)`` sequences by full-batch Adam on the log likelihood."""
    emit, step, first = np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)
    n = np.array([len(y) for _, y in sequences])
    t = int(n.max())
    f = np.zeros((len(n), t, N_FEATURES), np.int64)
    y = np.zeros((len(n), t), np.int64)
    for i, (x, z) in enumerate(sequences):
        f[i, : len(z)], y[i, : len(z)] = x, z
    live = np.arange(t)[None, :] < n[:, None]
    rows = np.arange(len(n))
    used = np.unique(f[live])
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (emit, step, first)]
    gold_step, gold_first = np.zeros((LABELS, LABELS)), np.bincount(y[:, 0], minlength=LABELS).astype(float)
    for k in range(1, t):
        m = live[:, k]
        np.add.at(gold_step, (y[m, k - 1], y[m, k]), 1)
    for epoch in range(1, epochs + 1):
        s = emit[f].sum(axis=2)
        alpha, beta = np.zeros((len(n), t, LABELS)), np.zeros((len(n), t, LABELS))
        alpha[:, 0] = first + s[:, 0]
        for k in range(1, t):
            a = _log_sum(alpha[:, k - 1, :, None] + step[None], 1) + s[:, k]
            alpha[:, k] = np.where(live[:, k, None], a, alpha[:, k - 1])
        for k in range(t - 2, -1, -1):
            b = _log_sum(step[None] + (s[:, k + 1] + beta[:, k + 1])[:, None, :], 2)
            beta[:, k] = np.where(live[:, k + 1, None], b, 0.0)
        z = _log_sum(alpha[rows, n - 1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * live[:, :, None]
        off = -p
        off[rows[:, None], np.arange(t)[None, :], y] += live
        g_emit = np.zeros_like(emit)
        for k in range(N_FEATURES):
            np.add.at(g_emit, f[:, :, k][live], off[live])
        g_step = gold_step.copy()
        for k in range(1, t):
            m = live[:, k]
            pair = alpha[m, k - 1, :, None] + step[None] + (s[m, k] + beta[m, k])[:, None, :] - z[m, None, None]
            g_step -= np.exp(pair).sum(axis=0)
        g_first = gold_first - p[:, 0].sum(axis=0)
        for w, g, (m1, m2) in zip((emit, step, first), (g_emit, g_step, g_first), moments):
            at = used if w is emit else slice(None)
            grad = g[at] / len(n) - l2 * w[at] / 10
            m1[at] = 0.9 * m1[at] + 0.1 * grad
            m2[at] = 0.99 * m2[at] + 0.01 * grad**2
            w[at] += rate * (m1[at] / (1 - 0.9**epoch)) / (np.sqrt(m2[at] / (1 - 0.99**epoch)) + 1e-8)
    return Field(emit, step, first)


def labelled(rows: list[tuple[str, list[tuple[int, int, int]]]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training sequences from texts with ``(start, kind, end)`` spans: a word that overlaps a span has its label."""
    out = []
    for text, spans in rows:
        w = Words([text.encode()])
        if not len(w.start):
            continue
        y = np.zeros(len(w.start), np.int64)
        for a, kind, b in spans:
            x, z = len(text[:a].encode()), len(text[:b].encode())
            y[(w.start < z) & (w.end > x)] = 1 + kind
        cuts = np.flatnonzero(w.new).tolist()
        for s, e in zip(cuts, [*cuts[1:], len(y)]):
            for k in range(s, e, 40):
                out.append((w.features[k : min(k + 40, e)], y[k : min(k + 40, e)]))
    return out


def seed_rows() -> list[tuple[str, list[tuple[int, int, int]]]]:
    rows = []
    for kind, text in SEEDS:
        a, b = text.find("["), text.find("]")
        clean = text.replace("[", "").replace("]", "")
        rows.append((clean, [(a, KINDS.index(kind), b - 1)] if kind else []))
    return rows


def train_lines(docs: DataFrame, text_col: str = "text", lines: int = TRAIN_LINES) -> list[str]:
    """At most ``lines`` distinct lines of ``docs``, two thirds with pattern matches and one without: those of the smallest hashes.

    So they are spread over the table and the same at any layout. Only lines whose hash is small enough
    by the number of distinct ones are compared.
    """
    d = picked(docs, text=text_col).where("text is not null").select(F.explode(F.split("text", "\n")).alias("line")).where("length(line) between 1 and 2000")
    d = d.withColumn("h", F.expr("shiftrightunsigned(xxhash64(line), 11)"))
    match = F.col("line").rlike("[0-9]{4}|@")
    kinds = ((match, lines * 2 // 3), (~match, lines - lines * 2 // 3))
    n_distinct = d.agg(*[F.approx_count_distinct(F.when(kind, F.col("h"))) for kind, _ in kinds]).collect()[0]
    some: list[str] = []
    for (kind, limit), n in zip(kinds, n_distinct):
        share = min(1.0, 4.0 * limit / max(n, 1))
        few = d.where(F.col("h") < F.lit(int(share * (1 << 53)))).where(kind).select("h", "line").distinct()
        some += [r["line"] for r in few.orderBy("h", "line").limit(limit).collect()]
    return some


def fit(docs: DataFrame, text_col: str = "text", lines: int = TRAIN_LINES) -> Field:
    """Train on the seeds and on at most ``lines`` lines of ``docs``, two thirds with pattern matches and one without."""
    some = train_lines(docs, text_col, lines)
    return train(labelled(seed_rows() * 5 + [(t, base_spans(t)) for t in sorted(some)]))


# --- search ----------------------------------------------------------------------

_EDGE = b".,;:!?<>()[]{}\"'"


def find(field: Field, every: list[str]) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """Per text the base spans, and the spans that the field adds; ``(start, kind, end)`` in code points."""
    base = [base_spans(t) for t in every]
    data = [t.encode() for t in every]
    words = Words(data)
    labels = field.label(words)
    added: list[list[tuple[int, int, int]]] = [[] for _ in every]
    hits = np.flatnonzero(labels)
    k = 0
    while k < len(hits):
        first = last = int(hits[k])
        kind = int(labels[first]) - 1
        # cards and phones may be several words; emails and addresses are one each
        while kind >= 2 and k + 1 < len(hits) and hits[k + 1] == last + 1 and labels[last + 1] == kind + 1 and not words.new[last + 1]:
            k += 1
            last = int(hits[k])
        k += 1
        doc = int(words.text[first])
        a, b = int(words.start[first] - words.text_start[doc]), int(words.end[last] - words.text_start[doc])
        raw = data[doc][a:b]
        kept = raw.strip(_EDGE)
        if not kept:
            continue
        a += raw.find(kept)
        x = len(data[doc][:a].decode())
        y = x + len(kept.decode())
        if not any(s < y and e > x for s, _, e in base[doc]):
            added[doc].append((x, kind, y))
    return base, added


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """Per row: id, counts of the patterns' spans, their digest, and all spans as ``kind:start:end``."""
    d = picked(docs, id=id_col, text=text_col)
    sent = cloudpickle.dumps(field or fit(docs, text_col))
    fields = [T.StructField(id_col, d.schema["id"].dataType), *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_added", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(sent)
        for b in batches:
            every = texts(b.column("text"))
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans, n = [], [], []
            for s in range(0, len(every), 200):
                for base, added in zip(*find(own, every[s : s + 200])):
                    for k, c in enumerate(counts):
                        c.append(sum(x[1] == k for x in base))
                    digests.append(hashlib.sha256(_written(base).encode()).hexdigest())
                    spans.append(_written(base + added))
                    n.append(len(added))
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(n, pa.int64())], [f.name for f in fields])

    return map_batches(d, run, T.StructType(fields))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span (overlapping ones together) replaced by its kind in angle brackets."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
        at = max(at, b)
    out.append(text[at:])
    return "".join(out)


def redacted(docs: DataFrame, text_col: str = "text", field: Field | None = None) -> DataFrame:
    """``docs`` with personal data in the text replaced; null texts stay null, other columns stay as they are."""
    cols = list(docs.columns)
    at = cols.index(text_col)
    sent = cloudpickle.dumps(field or fit(docs, text_col))
    d = docs.toDF(*[f"_c{i}" for i in range(len(cols))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(sent)
        for b in batches:
            every = b.column(at).to_pylist()
            out: list[str | None] = []
            for s in range(0, len(every), 200):
                part = every[s : s + 200]
                base, added = find(own, [t or "" for t in part])
                out += [None if t is None else redact(t, x + y) for t, x, y in zip(part, base, added)]
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    return map_batches(d, run, d.schema).toDF(*cols)
