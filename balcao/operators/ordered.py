"""Row-order operators that never put a whole file into one task.

Printed reports carry meaning in row order: a branch name applies to the rows below
it, a value sits one row under its label. A window per file would do, but then the
largest file is one task. Here every file is cut into chunks of row numbers. Windows
run inside a chunk; one small row per chunk carries the state from chunk to chunk.
Row numbers must be unique and increasing per file, but need not be consecutive.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILE = "file"
ROW = "row_idx"
ROWS_PER_CHUNK = 200_000

_CHUNK = "__chunk"
_CARRY = "__carry_"
_FIRST = Window.unboundedPreceding


def _chunked(df: DataFrame, chunk_rows: int) -> DataFrame:
    return df.withColumn(_CHUNK, F.floor(F.col(ROW) / chunk_rows))


def _inside(last: int) -> Window:
    return Window.partitionBy(FILE, _CHUNK).orderBy(ROW).rowsBetween(_FIRST, last)


def _chunks_before() -> Window:
    return Window.partitionBy(FILE).orderBy(_CHUNK).rowsBetween(_FIRST, -1)


def running_last(
    df: DataFrame,
    picks: Mapping[str, tuple[Column, Column]],
    strictly_before: bool = False,
    chunk_rows: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """For each row, the latest earlier (or same) row of its file that meets a condition.

    ``picks`` maps an output name to (condition, value). The output is a struct of the
    found row number ``at`` and its ``value``; the struct is null when no row was found,
    so a found row with a null value is told apart from no row.
    """
    names = list(picks)
    marked = _chunked(df, chunk_rows).withColumns(
        {
            name: F.when(cond, F.struct(F.col(ROW).alias("at"), value.alias("value")))
            for name, (cond, value) in picks.items()
        }
    )
    # Only the found rows are sorted for their latest; all chunks are listed by a hash
    # aggregate over two columns, because a chunk without a found row needs a carry too.
    some = reduce(or_, [F.col(n).isNotNull() for n in names])
    ends = (
        marked.where(some)
        .groupBy(FILE, _CHUNK)
        .agg(*[F.max(n).alias(_CARRY + n) for n in names])
    )
    chunks = _chunked(df, chunk_rows).select(FILE, _CHUNK).distinct()
    carried = chunks.join(ends, [FILE, _CHUNK], "left").select(
        FILE,
        _CHUNK,
        *[
            F.last(_CARRY + n, ignorenulls=True).over(_chunks_before()).alias(_CARRY + n)
            for n in names
        ],
    )
    inside = _inside(-1 if strictly_before else 0)
    found = marked.join(carried, [FILE, _CHUNK], "left").withColumns(
        {
            n: F.coalesce(F.last(n, ignorenulls=True).over(inside), F.col(_CARRY + n))
            for n in names
        }
    )
    return found.drop(_CHUNK, *[_CARRY + n for n in names])


def running_total(
    df: DataFrame, amount: Column, name: str, chunk_rows: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Sum of ``amount`` over the rows of the file strictly before each row."""
    marked = _chunked(df, chunk_rows).withColumn(name, amount)
    ends = marked.groupBy(FILE, _CHUNK).agg(F.sum(name).alias(name))
    carried = ends.select(FILE, _CHUNK, F.sum(name).over(_chunks_before()).alias(_CARRY))
    found = marked.join(carried, [FILE, _CHUNK], "left").withColumn(
        name,
        F.coalesce(F.col(_CARRY), F.lit(0)) + F.coalesce(F.sum(name).over(_inside(-1)), F.lit(0)),
    )
    return found.drop(_CHUNK, _CARRY)


def shift_up(df: DataFrame, columns: list[str], chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Replace ``columns`` by their values one row further down; null on the last row."""
    held = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    marked = _chunked(df, chunk_rows).withColumn("__held", held)
    # Numbers alone are aggregated in a hash table. Only chunks with another one behind them
    # are looked up, so files of one chunk have no rows here.
    heads = _chunked(df, chunk_rows).groupBy(FILE, _CHUNK).agg(F.min(ROW).alias(_CARRY))
    next_chunk = Window.partitionBy(FILE).orderBy(_CHUNK)
    wanted = heads.select(
        FILE, F.col(_CHUNK).alias("__above"), F.lead(_CARRY).over(next_chunk).alias(ROW)
    ).where(F.col(ROW).isNotNull())
    carried = (
        marked.join(wanted, [FILE, ROW])
        .groupBy(FILE, F.col("__above").alias(_CHUNK))
        .agg(F.min_by("__held", ROW).alias(_CARRY))
    )
    next_row = F.lead("__held").over(Window.partitionBy(FILE, _CHUNK).orderBy(ROW))
    shifted = marked.join(carried, [FILE, _CHUNK], "left").withColumn(
        "__next", F.coalesce(next_row, F.col(_CARRY))
    )
    return shifted.withColumns(
        {c: F.col(f"__next.v{i}") for i, c in enumerate(columns)}
    ).drop(_CHUNK, _CARRY, "__held", "__next")


def fill_down(
    df: DataFrame, marker: Column, value: Column, name: str, chunk_rows: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Value of the latest marker row, on the marker and on every row below it."""
    found = running_last(df, {"__section": (marker, value)}, chunk_rows=chunk_rows)
    return found.withColumn(name, F.col("__section.value")).drop("__section")
