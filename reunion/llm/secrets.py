"""Secret scan by a trigram inverted index, in DataFrame operations only.

Each rule is a regex. Its mandatory trigrams are derived from the parsed regex as a Boolean
query in conjunctive form (AND of clauses, a clause being an OR over literals, a literal an
AND of trigrams). The index holds postings ``(gram, id)`` for the trigrams that the rules
mention, over the lower-cased whole texts. Intersecting the postings gives each rule's
candidate documents; only these are verified with the rule's regex. A rule without
mandatory trigrams (the hex rule) scans every text.

Results for odd input: a null text counts as empty; a null id keeps its row (ids are
matched null-safely); repeated rows each get their own, equal result; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import picked

MARK, MARK_SUBSTITUTE = "\x01", "\x02"
MAX_LITERALS = 64
#: Pieces added up together when positions are summed; keeps that work linear in the matches.
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches, leftmost and not overlapping; one of fewer than ``min_chars``
    characters in its capture group ``length_group`` (0: the whole match) is dropped."""

    kind: str
    pattern: str
    min_chars: int = 1
    length_group: int = 0


# The base rules.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)

#: Further rules of the operator: well-known credential formats.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_api", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("uri_login", r"[a-z][a-z0-9+]{1,20}://[A-Za-z0-9._%-]{1,64}:[A-Za-z0-9._%!$-]{6,64}@"),
)


# --- trigram queries -----------------------------------------------------------


def _literals(node) -> set[str] | None:
    """The finite set of lower-cased strings a regex node matches, or None if it isn't small."""
    op, arg = node
    if op is rc.LITERAL:
        return {chr(arg).lower()}
    if op is rc.IN:
        if not all(o is rc.LITERAL for o, _ in arg):
            return None
        return {chr(a).lower() for _, a in arg}
    if op is rc.SUBPATTERN:
        return _joined(list(arg[-1]))
    if op is rc.BRANCH:
        parts = [_joined(list(b)) for b in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] == 1:
        inner = _joined(list(arg[2]))
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _joined(nodes: list) -> set[str] | None:
    out = {""}
    for n in nodes:
        s = _literals(n)
        if s is None or len(out) * len(s) > MAX_LITERALS:
            return None
        out = {a + b for a, b in itertools.product(out, s)}
    return out


def trigrams(text: str) -> tuple[str, ...]:
    return tuple(sorted({text[i : i + 3] for i in range(len(text) - 2)}))


def trigram_query(pattern: str) -> list[list[tuple[str, ...]]]:
    """AND of clauses; a clause is an OR of trigram sets, all of a set being needed.

    A run of nodes that matches few strings becomes one clause; strings shorter than three
    characters make a clause say nothing, and it is left out. No clause: scan fully.
    """
    clauses: list[list[tuple[str, ...]]] = []
    run: set[str] = {""}

    def flush() -> None:
        nonlocal run
        sets = {trigrams(s) for s in run}
        if () not in sets:
            clauses.append(sorted(sets))
        run = {""}

    for node in rp.parse(pattern):
        s = _literals(node)
        if s is None or "" in s:  # an open-ended or optional part ends the run
            flush()
            continue
        if len(run) * len(s) > MAX_LITERALS:
            flush()
        run = {a + b for a, b in itertools.product(run, s)}
    flush()
    return clauses


# --- index, candidates ------------------------------------------------------------


def build_index(docs: DataFrame, grams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``(gram, id)``: the place in ``grams`` of each trigram that occurs in the lower-cased text."""
    d = picked(docs, id=id_col, text=text_col).select("id", F.lower(F.col("text")).alias("low"))
    found = F.array(*[F.when(F.col("low").contains(g), F.lit(i)) for i, g in enumerate(grams)])
    return d.select(F.explode(F.array_compact(found)).alias("gram"), "id")


def candidates(postings: DataFrame, grams: list[str], rules: list[Rule]) -> DataFrame:
    """``(id, rules)``: bit k is set when every clause of rule k's trigram query holds for the document.

    Posting lists are intersected as bit sets: each literal is a set of trigram bits, and a
    document's bits are or-ed together, map-side first. The trigram list comes from the rules,
    so a document's bits have a fixed width whatever the data.
    """
    words = range(0, len(grams), 60)
    bits = postings.groupBy("id").agg(
        *[F.expr(f"bit_or(CASE WHEN gram BETWEEN {w} AND {w + 59} THEN shiftleft(1L, gram - {w}) ELSE 0L END) AS b{w}") for w in words]
    )
    place = {g: i for i, g in enumerate(grams)}

    def has(literal: tuple[str, ...]) -> Column:
        need = {w: sum(1 << (place[g] - w) for g in literal if w <= place[g] < w + 60) for w in words}
        out = F.lit(True)
        for w, mask in need.items():
            if mask:
                out = out & (F.col(f"b{w}").bitwiseAND(F.lit(mask)) == F.lit(mask))
        return out

    mask = F.lit(0)
    for k, rule in enumerate(rules):
        clauses = trigram_query(rule.pattern)
        if not clauses:
            continue
        ok = F.lit(True)
        for clause in clauses:
            one = F.lit(False)
            for literal in clause:
                one = one | has(literal)
            ok = ok & one
        mask = mask + F.when(ok, F.lit(1 << k)).otherwise(F.lit(0))
    return bits.select("id", mask.alias("rules")).where("rules <> 0")


# --- verification ----------------------------------------------------------------


def _pieces(rule: Rule, text: str) -> Column:
    """The column ``text`` cut at the rule's matches: ``(n, hit)`` per piece, n in code points.

    Matches are put between marks and the text is split there, so odd pieces are matches.
    """
    marked = F.regexp_replace(F.col(text), F.lit(rule.pattern), F.lit(f"{MARK}$0{MARK}"))
    if rule.length_group:
        enough = lambda p: F.length(F.regexp_extract(p, rule.pattern, rule.length_group)) >= rule.min_chars
    else:
        enough = lambda p: F.length(p) >= rule.min_chars
    sized = F.transform(F.split(marked, MARK), lambda p, i: F.struct(F.length(p).cast("long").alias("n"), ((i % 2 == 1) & enough(p)).alias("hit")))
    return F.when(F.col(text).rlike(rule.pattern), sized).otherwise(F.array().cast("array<struct<n:bigint,hit:boolean>>"))


def _spans(pieces: str) -> Column:
    """``(start, end)`` of the hits in a column of pieces: lengths before give the place.

    Lengths are summed in blocks of pieces, which keeps the work linear in the matches.
    """
    p = F.col(pieces)
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    blocks = F.transform(F.sequence(F.lit(0), ((F.size(p) - 1) / BLOCK).cast("int")), lambda b: F.slice(p, b * BLOCK + 1, BLOCK))

    def within(block: Column, at: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(at.alias("at"), nothing.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["n"]).alias("at"),
                F.when(x["hit"], F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + x["n"]).alias("end"))))).otherwise(acc["out"]).alias("out"),
            ),
        )["out"]

    total = lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda s, x: s + x["n"])
    placed = F.aggregate(
        blocks,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<struct<start:bigint,end:bigint>>>").alias("out")),
        lambda acc, block: F.struct((acc["at"] + total(block)).alias("at"), F.concat(acc["out"], F.array(within(block, acc["at"]))).alias("out")),
    )
    return F.when(F.size(p) > 1, F.flatten(placed["out"])).otherwise(nothing)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, <kind>...)``: for each rule an array of ``(start, end)`` code-point spans, one row per input row."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    grams = sorted({g for clauses in queries.values() for clause in clauses for literal in clause for g in literal})
    found = candidates(build_index(docs, grams, id_col, text_col), grams, list(rules))
    d = picked(docs, id=id_col, text=text_col)
    # A null text is empty; the mark itself can be in no match, so another such character may stand for it.
    d = d.select("id", F.translate(F.coalesce(F.col("text"), F.lit("")), MARK, MARK_SUBSTITUTE).alias("text"))
    j = d.alias("d").join(found.hint("shuffle_hash").alias("c"), F.col("d.id").eqNullSafe(F.col("c.id")), "left")
    j = j.select(F.col("d.id").alias("id"), "text", F.coalesce(F.col("rules"), F.lit(0)).alias("rules"))
    nothing = F.array().cast("array<struct<n:bigint,hit:boolean>>")
    cut = []
    for k, r in enumerate(rules):
        p = _pieces(r, "text")
        if queries[r.kind]:
            p = F.when(F.col("rules").bitwiseAND(F.lit(1 << k)) != 0, p).otherwise(nothing)
        cut.append(p.alias(r.kind))
    return j.select("id", *cut).select("id", *[_spans(r.kind).alias(r.kind) for r in rules])


def span_text(kinds: list[str]) -> Column:
    """``kind:start:end`` of the kinds' span columns by start, then by the order of ``kinds``, comma-joined."""

    def tag(place: int):
        return lambda s: F.struct(s["start"].alias("s"), F.lit(place).alias("k"), s["end"].alias("e"))

    tagged = [F.transform(F.col(k), tag(place)) for place, k in enumerate(kinds)]
    names = F.array(*[F.lit(k) for k in kinds])
    ordered = F.array_sort(F.concat(*tagged))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def secrets_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, a count per base kind, the digest of the base spans, and all spans as text."""
    base, every = [r.kind for r in BASE_RULES], [r.kind for r in BASE_RULES + MORE_RULES]
    return scan(docs, id_col=id_col, text_col=text_col).select(
        F.col("id").alias(id_col),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(every).alias("spans"),
    )


def python_pattern(rule: Rule) -> re.Pattern:
    """The rule for Python's engine (letters in either case are ASCII letters there)."""
    return re.compile(rule.pattern, re.ASCII)
