"""Where a pattern matches inside a text, with column functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256  # matches put together at a time, so that long lists are not copied per match
CONTEXT = 48  # code points before a match that are kept, earlier matches included

_SPANS = "array<struct<start:int,end:int,found:string,before:string>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches: array of (start, end, found, before).

    Positions count code points. The pattern must not match the empty string. Null and empty
    texts give an empty array. A ``group`` is one that begins where the match does; it may look
    ahead over later matches.
    """
    none = F.array().cast(_SPANS)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if group:
        seen = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        matches = F.zip_with(matches, seen, lambda match, found: F.struct(match.alias("match"), found.alias("found")))

    def pieces(gap: Column, item: Column) -> Column:
        match = item["match"] if group else item
        return F.struct(
            F.length(gap).alias("gap"),
            F.length(match).alias("size"),
            match.alias("match"),
            (item["found"] if group else match).alias("found"),
            F.substring(gap, -CONTEXT, CONTEXT).alias("before"),
        )

    def last(value: Column) -> Column:
        return F.substring(value, -CONTEXT, CONTEXT)

    def step(state: Column, item: Column) -> Column:
        start = state["at"] + item["gap"]
        # Carried on from match to match, so that long texts are not cut again for each.
        before = last(F.concat(state["tail"], item["before"]))
        span = F.struct(
            start.alias("start"),
            (start + (F.length(item["found"]) if group else item["size"])).alias("end"),
            item["found"].alias("found"),
            before.alias("before"),
        )
        return F.struct(
            (start + item["size"]).alias("at"),
            last(F.concat(before, last(item["match"]))).alias("tail"),
            F.concat(state["spans"], F.array(span).cast(_SPANS)).alias("spans"),
        )

    def all_spans(steps: Column) -> Column:
        def block(before: Column, number: Column) -> Column:
            return F.aggregate(
                F.slice(steps, number * BLOCK + 1, BLOCK),
                F.struct(before["at"].alias("at"), before["tail"].alias("tail"), none.alias("spans")),
                step,
                lambda state: F.struct(
                    state["at"].alias("at"),
                    state["tail"].alias("tail"),
                    F.concat(before["blocks"], F.array(state["spans"])).alias("blocks"),
                ),
            )

        return F.aggregate(
            F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")),
            F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast(f"array<{_SPANS}>").alias("blocks")),
            block,
            lambda state: F.flatten(state["blocks"]),
        )

    # One gap more than matches: the last step holds no match.
    steps = F.zip_with(F.split(text, pattern, -1), matches, pieces)
    matched = F.filter(steps, lambda item: item["match"].isNotNull())
    return F.when(text.rlike(pattern), let(matched, all_spans)).otherwise(none)
