"""All-terms text search, hit ranges and highlighting, in built-in expressions but for the hit ranges."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf


def terms(query: str | None) -> list[str]:
    return (query or "").lower().split()


def matches_search(haystack: Column, query: str | Column) -> Column:
    """Whether every term of ``query`` is in the lower-case ``haystack``, in any order; a blank query matches, a null haystack doesn't."""
    hay = F.coalesce(haystack, F.lit(""))
    if isinstance(query, str) or query is None:
        condition = F.lit(True)
        for t in terms(query):
            condition = condition & F.contains(hay, F.lit(t))
        return condition
    split = F.filter(F.split(F.lower(F.coalesce(query, F.lit(""))), r"(?U)\s+"), lambda t: t != "")
    return F.forall(split, lambda t: F.contains(hay, t))


_RANGES = "array<struct<start:int,end:int>>"


def hit_ranges(text: str, wanted: Sequence[str]) -> list[tuple[int, int]]:
    """The merged hits of all terms in a lower-case text: one pass for each term, and a sort of the hits."""
    hits = []
    for term in wanted:
        at = text.find(term)
        while at >= 0:
            hits.append((at, at + len(term)))
            at = text.find(term, at + 1)
    merged: list[tuple[int, int]] = []
    for start, end in sorted(hits):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def match_ranges(text: Column, query: str) -> Column:
    """array<struct<start,end>> of the hits of all terms, half-open; hits may overlap themselves, and overlapping or touching ones are merged.

    Null for a null text, empty for a blank query.  An Arrow kernel, as
    expressions take time in the square of a text's length.
    """
    wanted = list(dict.fromkeys(terms(query)))
    if not wanted:
        return F.when(text.isNotNull(), F.array().cast(_RANGES))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    @arrow_udf(_RANGES)
    def ranges(lowered: pa.Array) -> pa.Array:
        found = [None if t is None else [{"start": a, "end": b} for a, b in hit_ranges(t, wanted)] for t in lowered.to_pylist()]
        return pa.array(found, kind)

    return ranges(F.lower(text))


_SEGMENTS = "array<struct<text:string,hit:boolean>>"


def segments(text: str, ranges: Sequence[tuple[int, int]]) -> list[tuple[str, bool]]:
    """``text`` in pieces, hits and what is between them; an empty text is one empty piece."""
    out, at = [], 0
    for start, end in ranges:
        out += [(text[at:start], False), (text[start:end], True)]
        at = end
    out.append((text[at:], False))
    return [s for s in out if s[0]] or [(text, False)]


def highlight(text: Column, query: str) -> Column:
    """array<struct<text,hit>> that rejoins to ``text``; one plain segment where nothing matches, null for a null text."""
    wanted = list(dict.fromkeys(terms(query)))
    kind = pa.list_(pa.struct([("text", pa.string()), ("hit", pa.bool_())]))

    @arrow_udf(_SEGMENTS)
    def pieces(plain: pa.Array, lowered: pa.Array) -> pa.Array:
        rows = zip(plain.to_pylist(), lowered.to_pylist(), strict=True)
        return pa.array([None if t is None else [{"text": s, "hit": h} for s, h in segments(t, hit_ranges(low, wanted))] for t, low in rows], kind)

    return pieces(text, F.lower(text))


def marked(text: Column, query: str, opening: str = "<mark>", closing: str = "</mark>") -> Column:
    """``text`` with its hits between marks; markup in the text is escaped."""

    def escaped(s: Column) -> Column:
        return F.replace(F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    return F.array_join(F.transform(highlight(text, query), lambda s: F.when(s["hit"], F.concat(F.lit(opening), escaped(s["text"]), F.lit(closing))).otherwise(escaped(s["text"]))), "")
