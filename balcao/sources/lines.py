"""Text files as numbered lines, however large a single file is.

Spark splits big text files, so a line number is not known where the line is read.
It is put together from the lines in the splits before (one small row per split) and
the position inside the split, which is read by one task from start to end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from balcao.operators.ordered import FILE, ROW

SNIFFED_CHARACTERS = 2048
_BOM = "\ufeff"


def plain_path(column: str) -> Column:
    """The file path as stored, without URL escapes."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def file_label(path: Column) -> Column:
    """File name; for the part files of a directory written by Spark, the directory name."""
    name = F.element_at(F.split(path, "/"), -1)
    folder = F.element_at(F.split(path, "/"), -2)
    return F.when(name.startswith("part-"), F.regexp_replace(folder, "^[^=]*=", "")).otherwise(name)


def report_path(path: Column) -> Column:
    """The file itself; for part files, the directory they make up."""
    return F.regexp_replace(path, "/part-[^/]*$", "")


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """One row per file: ``file``, ``label``, ``report``, ``modified``, ``bytes``.

    Reads no contents.
    """
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return found.select(
        F.col("path").alias(FILE),
        file_label(F.col("path")).alias("label"),
        report_path(F.col("path")).alias("report"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    )


def empty_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Files without a single byte, which scans leave out: ``file``, ``label``.

    Takes the names from the file index, which the driver holds anyway.
    """
    index = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(folder)
    )
    names = spark.createDataFrame([(name,) for name in index.inputFiles()], "path string")
    path = F.regexp_replace(plain_path("path"), "^file:/+", "file:/")
    named = names.select(path.alias(FILE), file_label(path).alias("label"))
    return named.join(list_files(spark, folder, glob).select(FILE), FILE, "left_anti")


def read_lines(spark: SparkSession, folder: str | list[str], glob: str) -> DataFrame:
    """``file``, ``row_idx`` (from 0 per file) and the line's undecoded ``raw`` bytes."""
    raw = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .text(folder)
        .select(
            plain_path("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("position"),
            F.col("value").cast("binary").alias("raw"),
        )
    )
    before = Window.partitionBy(FILE).orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = raw.groupBy(FILE, "split").agg(
        F.min("position").alias("first"), F.count("*").alias("lines")
    )
    starts = splits.select(
        FILE,
        "split",
        (F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first")).alias("offset"),
    )
    return raw.join(starts, [FILE, "split"]).select(
        FILE, (F.col("position") + F.col("offset")).alias(ROW), "raw"
    )


def count_of(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def _latin1(raw: str = "raw") -> Column:
    return F.decode(raw, "ISO-8859-1")


def file_facts(lines: DataFrame) -> DataFrame:
    """Per file: is it valid UTF-8, how many quotes it holds, and its delimiter.

    The delimiter is ``;`` if the first 2,048 characters hold more of them than ``,``.
    """
    whole = lines.groupBy(FILE).agg(
        F.bool_and(F.is_valid_utf8(F.col("raw").cast("string"))).alias("is_utf8"),
        F.sum(count_of(_latin1(), '"')).alias("quotes"),
    )
    above = Window.partitionBy(FILE).orderBy(ROW).rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.length("raw") + 1).over(above), F.lit(0))
    head = (
        lines.where(F.col(ROW) < SNIFFED_CHARACTERS)
        .select(FILE, _latin1().alias("text"), (SNIFFED_CHARACTERS - used).alias("room"))
        .where(F.col("room") > 0)
    )
    seen = F.substring(F.col("text"), F.lit(1), F.col("room").cast("int"))
    sniffed = head.groupBy(FILE).agg(
        F.when(F.sum(count_of(seen, ";")) > F.sum(count_of(seen, ",")), ";")
        .otherwise(",")
        .alias("delimiter")
    )
    return whole.join(sniffed, FILE)


def decode_lines(lines: DataFrame, facts: DataFrame) -> DataFrame:
    """Add ``text``: UTF-8 if the whole file is valid UTF-8, Latin-1 otherwise."""
    text = F.when(F.col("is_utf8"), F.decode("raw", "UTF-8")).otherwise(_latin1())
    without_bom = F.when(F.col(ROW) == 0, F.replace(text, F.lit(_BOM), F.lit("")))
    return lines.join(facts, FILE).select(
        FILE, ROW, without_bom.otherwise(text).alias("text"), "delimiter"
    )
