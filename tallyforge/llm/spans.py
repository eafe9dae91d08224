"""Regex matches with code-point positions, as Column expressions.

Spark has no function that returns where each match lies. ``split`` and ``regexp_extract_all`` walk a text in the same
way (leftmost, non-overlapping), so the pieces between matches and the matches themselves alternate, and positions
are running sums of their lengths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches whose lengths are summed in one go; running sums over many matches go by blocks of this size.
_BLOCK = 64
SPAN = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern that never matches the empty text: array of ``start, end`` (code points, end exclusive),
    ``hit`` and the pieces of text ``before`` and ``after`` up to the neighbouring matches."""
    size = lambda a: F.size(a)

    def placed(x: Column) -> Column:
        hits, pieces = x["h"], x["p"]
        lens = F.zip_with(hits, F.slice(pieces, F.lit(1), size(hits)), lambda h, p: F.length(h) + F.length(p))

        def with_lens(n: Column) -> Column:
            blocks = F.transform(
                F.sequence(F.lit(0), F.floor((size(n) - 1) / _BLOCK).cast("int")),
                lambda b: F.aggregate(F.slice(n, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda a, v: a + v),
            )

            def with_blocks(s: Column) -> Column:
                def base(b: Column) -> Column:
                    return F.aggregate(F.slice(s, F.lit(1), b), F.lit(0), lambda a, v: a + v)

                bases = F.transform(F.sequence(F.lit(0), size(s) - 1), base)
                return let(bases, lambda t: F.transform(hits, lambda h, i: span(h, i, t)))

            def span(h: Column, i: Column, t: Column) -> Column:
                block = F.floor(i / _BLOCK).cast("int")
                start = (
                    F.element_at(t, block + 1)
                    + F.aggregate(F.slice(n, block * _BLOCK + 1, i % _BLOCK), F.lit(0), lambda a, v: a + v)
                    + F.length(F.element_at(pieces, i + 1))
                )
                return let(
                    start.cast("int"),
                    lambda at: F.struct(
                        at.alias("start"),
                        (at + F.length(h)).cast("int").alias("end"),
                        h.alias("hit"),
                        F.element_at(pieces, i + 1).alias("before"),
                        F.element_at(pieces, i + 2).alias("after"),
                    ),
                )

            return let(blocks, with_blocks)

        return let(lens, with_lens)

    def some(hits: Column) -> Column:
        return F.when(size(hits) > 0, let(F.struct(hits.alias("h"), F.split(text, pattern, -1).alias("p")), placed))

    return F.coalesce(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), some), F.array().cast(SPAN))


def named(spans: Column, kind: str, rank: int) -> Column:
    """Spans reduced to ``start, rank, end, kind``, the order in which struct comparison sorts them."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of named spans in their order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
