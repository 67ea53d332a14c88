"""Delimited text as numbered records of cells, with quoted line breaks and delimiters.

A quote opens a quoted cell only where a cell starts; anywhere else outside quoted cells it
is an ordinary character, as in a name with an inch mark. Inside, a doubled quote is a quote,
a single one closes the cell, and what follows up to the delimiter still belongs to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.operators.ordered import FILE, ROW, ROWS_PER_CHUNK, running_last, running_total
from balcao.sources.lines import decode_lines, file_facts, read_lines
from balcao.sources.staging import staged

# Where the text between two quotes stands: at the start of a cell, inside a quoted cell,
# behind a quote inside one, or elsewhere in a cell.
_START, _INSIDE, _QUOTED, _PLAIN = 0, 1, 2, 3


def _behind_quote(state: Column, piece: Column, delimiter: Column) -> Column:
    """State behind the quote that ends a piece."""
    starts = ((piece == "") & (state == _START)) | F.endswith(piece, delimiter)
    opened = F.when(starts, _INSIDE).otherwise(_PLAIN)
    return (
        F.when(state == _INSIDE, _QUOTED)
        .when((state == _QUOTED) & (piece == ""), _INSIDE)
        .otherwise(opened)
    )


def ends_inside(text: Column, delimiter: Column, inside: bool) -> Column:
    """Whether a line ends inside a quoted cell; ``inside`` says if it starts in one."""
    pieces = F.split(text, '"', -1)
    state = F.aggregate(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        F.lit(_INSIDE if inside else _START),
        lambda state, piece: _behind_quote(state, piece, delimiter),
    )
    return state == _INSIDE


def quoted_lines(lines: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add ``starts_inside`` and ``ends_inside``: does the line start, end in a quoted cell?

    What a line does to the state is known without the lines above: it sets it, keeps it or
    turns it round. The state is the last one set, turned once for each turning line since.
    """
    after_out = ends_inside(F.col("text"), F.col("delimiter"), False)
    after_in = ends_inside(F.col("text"), F.col("delimiter"), True)
    read = lines.withColumns({"after_out": after_out, "after_in": after_in})
    turns = (F.col("after_out") & ~F.col("after_in")).cast("int")
    counted = running_total(read, turns, "turns_above", chunk_rows)
    sets = F.col("after_out") == F.col("after_in")
    value = F.struct(F.col("after_out").alias("state"), F.col("turns_above").alias("turns"))
    found = running_last(counted, {"last_set": (sets, value)}, True, chunk_rows)
    since = F.col("turns_above") - F.coalesce(F.col("last_set.value.turns"), F.lit(0))
    start = F.coalesce(F.col("last_set.value.state"), F.lit(False)) != (since % 2 == 1)
    return (
        found.withColumn("starts_inside", start)
        .withColumn(
            "ends_inside",
            F.when(F.col("starts_inside"), F.col("after_in")).otherwise(F.col("after_out")),
        )
        .drop("after_out", "after_in", "turns_above", "last_set")
    )


def join_quoted_lines(read: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Lines of one record put together; ``row_idx`` is the record's first line.

    ``read`` comes from ``quoted_lines``, without files whose last line ends inside a quoted
    cell. Only records that really span lines are grouped; all others pass through untouched.
    """
    starts = ~F.col("starts_inside")
    is_whole = starts & ~F.col("ends_inside")
    state = ("starts_inside", "ends_inside")
    pieces = running_last(
        read.where(~is_whole), {"start": (starts, F.lit(None).cast("string"))}, False, chunk_rows
    )
    parts = F.array_sort(F.collect_list(F.struct(F.col(ROW), F.col("text"))))
    joined = (
        pieces.groupBy(FILE, F.col("start.at").alias("first_line"))
        .agg(parts.alias("parts"), F.first("delimiter").alias("delimiter"))
        .select(
            FILE,
            F.col("first_line").alias(ROW),
            F.array_join(F.col("parts.text"), "\n").alias("text"),
            "delimiter",
        )
    )
    return read.where(is_whole).drop(*state).unionByName(joined)


def split_cells(text: Column, delimiter: Column) -> Column:
    """Cells of one record, in one pass over the text between its quotes."""
    pattern = F.concat(F.lit(r"\Q"), delimiter, F.lit(r"\E"))

    def add(state: Column, piece: Column) -> Column:
        now = state["state"]
        parts = F.split(piece, pattern, -1)
        more = F.size(parts) > 1
        literal = now == _INSIDE
        # A doubled quote inside a cell: the piece between the two is empty.
        doubled = (now == _QUOTED) & (piece == "")
        after = _behind_quote(now, piece, delimiter)
        outside = F.when(more, F.element_at(parts, -1)).otherwise(F.concat(state["cell"], piece))
        cell = (
            F.when(literal, F.concat(state["cell"], piece))
            .when(doubled, F.concat(state["cell"], F.lit('"')))
            .otherwise(F.concat(outside, F.when(after == _PLAIN, '"').otherwise("")))
        )
        done = F.when(
            more & ~literal,
            F.concat(
                F.array(F.concat(state["cell"], F.get(parts, F.lit(0)))),
                F.slice(parts, F.lit(2), F.size(parts) - 2),
            ),
        ).otherwise(F.array().cast("array<string>"))
        return F.struct(
            after.alias("state"),
            F.concat(state["cells"], done).alias("cells"),
            cell.alias("cell"),
        )

    def close(state: Column, last: Column) -> Column:
        """The text behind the last quote has no quote that ends it."""
        parts = F.split(last, pattern, -1)
        literal = state["state"] == _INSIDE
        first = F.concat(state["cell"], F.when(literal, last).otherwise(F.get(parts, F.lit(0))))
        rest = F.when(literal, F.array().cast("array<string>")).otherwise(
            F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        )
        return F.concat(state["cells"], F.array(first), rest)

    pieces = F.split(text, '"', -1)
    none = F.array().cast("array<string>")
    zero = F.struct(F.lit(_START).alias("state"), none.alias("cells"), F.lit("").alias("cell"))
    quoted = F.aggregate(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        zero,
        add,
        lambda state: close(state, F.element_at(pieces, -1)),
    )
    return F.when(F.contains(text, F.lit('"')), quoted).otherwise(F.split(text, pattern, -1))


def scan_records(
    spark: SparkSession,
    folder: str | list[str],
    glob: str,
    delimiter: str | None = None,
    chunk_rows: int = ROWS_PER_CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """Records (``file``, ``row_idx``, ``cells``) and per-file facts of delimited files.

    Each file's encoding is found out, and its delimiter unless one is given. Files that end
    inside a quoted cell give no records: their ``is_open`` fact is true, for the caller to
    report. ``row_idx`` counts records from 0 per file, blank ones included.

    Lines and cells are written once each, because everything that follows reads them
    several times and text is slow to take apart.
    """
    lines = staged(read_lines(spark, folder, glob), "lines")
    facts = staged(file_facts(lines), "facts")
    if delimiter is not None:
        facts = facts.withColumn("delimiter", F.lit(delimiter))
    # Without quotes a record is a line; only files with quotes need more.
    plain = decode_lines(lines, facts.where(F.col("quotes") == 0))
    quoted = decode_lines(lines, facts.where(F.col("quotes") > 0))
    read = staged(quoted_lines(quoted, chunk_rows), "quoted")
    open_files = read.groupBy(FILE).agg(F.max_by("ends_inside", ROW).alias("is_open")).where("is_open")
    whole = join_quoted_lines(read.join(open_files.select(FILE), FILE, "left_anti"), chunk_rows)
    numbered = running_total(whole, F.lit(1), "record", chunk_rows).withColumn(ROW, F.col("record"))
    records = plain.unionByName(numbered.drop("record"))
    cells = split_cells(F.col("text"), F.col("delimiter"))
    facts = facts.join(open_files, FILE, "left").withColumn("is_open", F.coalesce("is_open", F.lit(False)))
    return staged(records.select(FILE, ROW, cells.alias("cells")), "cells"), facts
