"""Secret scans with a trigram inverted index; DataFrame functions only.

For each rule a Boolean trigram query is derived from its regex: every match must contain certain strings, hence their
trigrams. Postings (trigram, document) are gathered for the trigrams of all rules, intersected per document, and only
candidate documents are verified with the regex. Rules without mandatory trigrams scan every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as _k
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import stage
from tallyforge.llm.spans import SPAN, joined, matches, named

#: Alternative strings that a part of a regex may expand to before it counts as "anything".
MOST_STRINGS = 64
#: Indexed rules that one scan takes: their bits share a long.
MOST_RULES = 62


@dataclass(frozen=True)
class Rule:
    """``kind`` names the spans; ``keep`` says which matches stand, from the matched text."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    fold: bool = False

    @property
    def regex(self) -> str:
        return f"(?i){self.pattern}" if self.fold else self.pattern


#: The base rules and the shapes of well-known credentials.
BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
]
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    # the first part is taken whole, and what has no further parts is dropped: no start inside it is tried again
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+(\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)?", 1, 1),
    Rule("private", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
]
RULES = [*BASE, *MORE]


def _expand(nodes: list) -> list[tuple[set[str] | None, bool]]:
    """The parts of a concatenation: each a set of strings, or None for anything."""
    out: list[set[str] | None] = []
    for op, arg in nodes:
        if op is _k.LITERAL:
            out.append({chr(arg)})
        elif op is _k.IN and all(o is _k.LITERAL for o, _ in arg):
            out.append({chr(a) for _, a in arg})
        elif op is _k.SUBPATTERN:
            out += _expand(list(arg[3]))
        elif op is _k.BRANCH:
            union: set[str] | None = set()
            for branch in arg[1]:
                strings = _cross(_expand(list(branch)))
                union = None if union is None or strings is None else union | strings
            out.append(union if union is None or len(union) <= MOST_STRINGS else None)
        elif op in (_k.MAX_REPEAT, _k.MIN_REPEAT, _k.POSSESSIVE_REPEAT):
            low, high, inner = arg
            strings = _cross(_expand(list(inner)))
            if strings is None:
                out.append(None)
            elif low == 0 and high == 1:
                out.append(strings | {""})
            else:
                out += [strings] * min(low, 8)
                if high != low or low > 8:
                    out.append(None)
        else:
            out.append(None)
    return out


def _cross(parts: list[set[str] | None]) -> set[str] | None:
    made = {""}
    for p in parts:
        if p is None or len(made) * len(p) > MOST_STRINGS:
            return None
        made = {a + b for a in made for b in p}
    return made


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """AND of factors, each an OR of sets of lower-case trigrams that must all occur. Empty: no mandatory trigram."""
    factors: list[set[str]] = []
    run = {""}
    for part in [*_expand(list(_parser.parse(pattern))), None]:
        if part is not None and len(run) * len(part) <= MOST_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        factors.append(run)
        run = part if part is not None and len(part) <= MOST_STRINGS else {""}
    factors.append(run)
    query = []
    for strings in factors:
        sets = {frozenset(s[i : i + 3].lower() for i in range(len(s) - 2)) for s in strings}
        if frozenset() not in sets:
            query.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))  # a larger set adds nothing to an OR
    return query


def _masks(bits: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for b in bits:
        out[b // 62] = out.get(b // 62, 0) | 1 << b % 62
    return out


def postings(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index for the given trigrams: ``trigram`` (its number in the list) and ``doc_id``, without repeats
    within a row. It can be written and searched again for other rules over the same trigrams. Rows without id are not
    in it."""
    text = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    present = F.element_at(
        F.transform(F.array(text), lambda t: F.array_compact(F.array(*[F.when(t.contains(g), F.lit(i)) for i, g in enumerate(trigrams)]))), 1
    )
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.explode(present).alias("trigram"))


def candidates(index: DataFrame, rules: list[Rule], trigrams: list[str]) -> DataFrame:
    """Intersect the postings: ``doc_id`` and ``rules``, a bit for each rule whose query holds. Partial ORs are formed
    before the shuffle, so no posting list meets in one task."""
    number = {g: i for i, g in enumerate(trigrams)}
    words = range(-(-len(trigrams) // 62))
    bit = lambda w: F.when(F.floor(F.col("trigram") / 62) == w, F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("trigram") % 62).cast("int"))).otherwise(F.lit(0).cast("long"))
    seen = index.groupBy("doc_id").agg(*[F.bit_or(bit(w)).alias(f"w{w}") for w in words])

    def holds(trigram_set: frozenset[str]) -> Column:
        out = F.lit(True)
        for w, mask in _masks([number[g] for g in trigram_set]).items():
            out = out & (F.col(f"w{w}").bitwiseAND(F.lit(mask)) == mask)
        return out

    mask = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        ok = F.lit(True)
        for factor in trigram_query(rule.pattern):
            any_of = F.lit(False)
            for trigram_set in factor:
                any_of = any_of | holds(trigram_set)
            ok = ok & any_of
        mask = mask + F.when(ok, F.lit(1 << i)).otherwise(F.lit(0))
    return seen.select("doc_id", mask.alias("rules")).where("rules <> 0")


def _long_enough(rule: Rule):  # noqa: ANN202
    def test(s: Column) -> Column:
        part = F.regexp_extract(s["hit"], rule.regex, rule.group) if rule.group else s["hit"]
        return F.length(part) >= rule.least

    return test


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, found``, with ``found`` an array of ``start, rank, end, kind`` in order of start,
    then of the rules' order. Positions are code points, ends exclusive.

    Null texts count as empty; empty texts have no spans; rows of one id share their candidate bits, which can only add
    verification work; rows without id are no part of the index, and every rule is verified on them. Repeated rows
    repeat their results; other columns are ignored; an empty table gives none. The candidates (ids and bits, no texts)
    are written before the join with the texts is planned: while they are small Spark sends them to the texts, which
    then stay in place; beyond its broadcast limit it shuffles both sides and splits skewed ones.
    """
    indexed = [r for r in rules if trigram_query(r.pattern)]
    if len(indexed) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} indexed rules: scan in several calls")
    trigrams = sorted({g for r in indexed for factor in trigram_query(r.pattern) for s in factor for g in s})
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if indexed:
        found = stage(candidates(postings(rows, trigrams), indexed, trigrams), "candidates").withColumnRenamed("doc_id", "_doc")
        every = F.when(F.col("doc_id").isNull(), F.lit((1 << len(indexed)) - 1)).otherwise(F.lit(0))
        rows = rows.join(found, rows["doc_id"] == found["_doc"], "left").select("doc_id", "text", F.coalesce("rules", every).alias("rules"))
    parts = []
    for rank, rule in enumerate(rules):
        spans = matches(F.col("text"), rule.regex)
        if rule in indexed:
            wanted = F.col("rules").bitwiseAND(F.lit(1 << indexed.index(rule))) != 0
            spans = F.when(wanted, spans).otherwise(F.array().cast(SPAN))
        if rule.least:
            spans = F.filter(spans, _long_enough(rule))
        parts.append(named(spans, rule.kind, rank))
    return rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("found"))


def digest(found: DataFrame, base: list[Rule] = BASE) -> DataFrame:
    """Counts and the hash of the base spans, and all spans as text."""
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    own = F.filter("found", lambda s: s["rank"] < len(base))
    return found.select("doc_id", *[count(r.kind) for r in base], F.sha2(joined(own), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))

