"""Printed-report grids: rows of text cells with the column names some rows down."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.functions.text import WHITE_SPACE, strip
from balcao.operators.ordered import FILE, ROW, ROWS_PER_CHUNK
from balcao.sources.lines import file_label
from balcao.sources.records import scan_records
from balcao.sources.staging import staged

_MISSING = "__missing"
_NAMELESS = "__nameless"


class GridScan(NamedTuple):
    """``cells`` has ``file``, ``row_idx``, ``cells``; ``rejected`` has ``file``, ``label``, ``reason``."""

    cells: DataFrame
    rejected: DataFrame


def scan_grids(
    spark: SparkSession,
    folder: str | list[str],
    glob: str = "*.[cC][sS][vV]",
    delimiter: str | None = None,
    chunk_rows: int = ROWS_PER_CHUNK,
) -> GridScan:
    """Report files exported as delimited text, and those that cannot be taken apart.

    ``row_idx`` counts records from 0, blank rows included, as a spreadsheet would. Without a
    ``delimiter`` each file's own is found out.
    """
    cells, facts = scan_records(spark, folder, glob, delimiter, chunk_rows)
    rejected = facts.where("is_open").select(
        FILE, file_label(F.col(FILE)).alias("label"), F.lit("unpaired quotes").alias("reason")
    )
    return GridScan(cells, rejected)


def clean_header(cells: Column) -> Column:
    """Trimmed lower-case names; a blank one is called after its position (``unnamed: 3``)."""
    spaced = F.transform(
        cells, lambda c: F.lower(strip(F.regexp_replace(c, r"[\s\u00a0\ufeff]+", " ")))
    )
    return F.transform(
        spaced,
        lambda c, i: F.when(
            c.isNull() | (c == ""), F.concat(F.lit("unnamed: "), i.cast("string"))
        ).otherwise(c),
    )


def with_header(
    cells: DataFrame, header_row: int, required: tuple[str, ...] = (), **places: Column
) -> DataFrame:
    """Attach each file's cleaned ``header`` and keep the rows below it.

    A file that lacks a ``required`` column fails the job. ``places`` are columns worked out
    from the header once a file, such as positions; rows then get these and not the names.
    """
    raw = cells.where(F.col(ROW) == header_row).select(FILE, "cells")
    # Dealt out first: cleaning is the work, and all headers may stand in one part of the report.
    named = raw.repartition(FILE).select(FILE, clean_header(F.col("cells")).alias("header"))
    wanted = F.array(*[F.lit(n) for n in required]) if required else F.array().cast("array<string>")
    missing = F.array_except(wanted, F.coalesce("header", F.array().cast("array<string>")))
    facts = {_MISSING: F.array_join(missing, ", "), _NAMELESS: F.col("header").isNull()}
    kept = places or {"header": F.col("header")}
    # Written once, its size is known, so that a few headers are not met by a shuffle of all rows.
    heads = staged(named.select(FILE, *[c.alias(n) for n, c in (kept | facts).items()]), "headers")
    below = F.col(ROW) > header_row
    if not required:
        found = cells.join(heads.where(~F.col(_NAMELESS)), FILE).where(below)
        return found.drop(_MISSING, _NAMELESS)
    # A file that ends above its header has no row in ``heads`` and lacks every column.
    lacks = F.coalesce(F.col(_MISSING), F.lit(", ".join(required)))
    message = F.concat(F.lit("missing columns "), lacks, F.lit(" in "), F.col(FILE))
    fails = below | F.coalesce(F.col(_NAMELESS), F.lit(True))
    checked = F.when(lacks == "", below).when(fails, F.raise_error(message).cast("boolean")).otherwise(False)
    found = cells.where(F.col(FILE).isNotNull()).join(heads, FILE, "left").where(checked)
    return found.drop(_MISSING, _NAMELESS)


def cell_at(position: Column) -> Column:
    """Cell at a zero-based position; blank or absent cells are null."""
    value = F.get(F.col("cells"), position.cast("int"))
    # Trimmed on one side only, which is enough to see whether anything is left.
    return F.when(F.ltrim(value, F.lit(WHITE_SPACE)) != "", value)


def column_position(name: str) -> Column:
    return F.array_position(F.col("header"), F.lit(name)) - 1


def last_position_containing(*parts: str) -> Column:
    """Position of the last column whose name contains one of ``parts``; -1 if none."""
    hits = F.transform(
        F.col("header"),
        lambda name, i: F.when(_any_in(name, parts), i).otherwise(F.lit(-1)),
    )
    return F.coalesce(F.array_max(hits), F.lit(-1))


def _any_in(name: Column, parts: tuple[str, ...]) -> Column:
    found = F.contains(name, F.lit(parts[0]))
    for part in parts[1:]:
        found = found | F.contains(name, F.lit(part))
    return found


def first_position_outside(names: tuple[str, ...]) -> Column:
    """Position of the first column that is not one of ``names``."""
    kept = F.transform(F.col("header"), lambda name: ~name.isin(*names))
    return F.array_position(kept, F.lit(True)) - 1


def cell(name: str) -> Column:
    return cell_at(column_position(name))
