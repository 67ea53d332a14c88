"""HR extracts: one delimited file per branch, with the branch in the file name."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions.text import clean_email, export_text, strip
from balcao.operators.ordered import FILE, ROW
from balcao.sources.lines import empty_files, list_files
from balcao.sources.records import scan_records

CSV = "*.[cC][sS][vV]"
BRANCH_IN_NAME = r"(?i)COLABORADORES\s*-\s*(\d+)"


class HrScan(NamedTuple):
    staff: DataFrame
    rejected: DataFrame


def branch_from_name(label: Column) -> Column:
    """``COLABORADORES - 07.csv`` to 7; null if the name has no branch."""
    digits = F.regexp_extract(label, BRANCH_IN_NAME, 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def _column(name: str) -> Column:
    return F.get(F.col("cells"), (F.array_position(F.col("header"), F.lit(name)) - 1).cast("int"))


def _known(text: Column) -> Column:
    return F.when(~strip(text).isin(*vocab.MISSING_TEXTS), text)


def _email() -> Column:
    """The first column that goes by an e-mail name; blank where there is none."""
    aliases = F.transform(F.col("header"), lambda name: F.lower(name).isin(*vocab.EMAIL_ALIASES))
    position = (F.array_position(aliases, F.lit(True)) - 1).cast("int")
    return F.coalesce(clean_email(_known(F.get(F.col("cells"), position))), F.lit(""))


def scan_hr_folder(
    spark: SparkSession, folder: str | list[str], glob: str = CSV, with_file: bool = False
) -> HrScan:
    """All staff of all readable files, and the files left out with the reason.

    Columns are matched by name per file, so files may order them differently. Cells are
    kept as text, exactly as written, so leading zeros of tax ids survive. ``with_file`` adds
    the file each row comes from.
    """
    records, facts = scan_records(spark, folder, glob)
    written = records.where((F.size("cells") > 1) | (strip(F.get("cells", F.lit(0))) != ""))
    # Numbers alone are aggregated in a hash table; with the cells among them all rows would be sorted.
    first = written.groupBy(FILE).agg(
        F.min(ROW).alias("header_row"), F.count("*").alias("records"), F.max(F.size("cells")).alias("widest")
    )
    heads = written.select(FILE, F.col(ROW).alias("header_row"), F.col("cells").alias("header"))
    first = first.join(heads, [FILE, "header_row"])
    header = F.transform(
        F.col("header"), lambda c: strip(F.replace(c, F.lit("\ufeff"), F.lit("")))
    )
    reason = (
        F.when(F.col("branch").isNull(), "no branch in name")
        .when(F.coalesce(F.col("is_open"), F.lit(False)), "unpaired quotes")
        .when(F.coalesce(F.col("records"), F.lit(0)) < 2, "empty")
        .when(F.col("widest") > F.size("header"), "row wider than header")
    )
    files = (
        list_files(spark, folder, glob)
        .select(FILE, "label")
        .unionByName(empty_files(spark, folder, glob))
        .withColumn("branch", branch_from_name(F.col("label")))
        .join(facts.select(FILE, "is_open"), FILE, "left")
        .join(first, FILE, "left")
        .select(FILE, "label", "branch", header.alias("header"), "header_row", reason.alias("reason"))
    )
    staff = (
        written.join(files.where(F.col("reason").isNull()), FILE)
        .where(F.col(ROW) > F.col("header_row"))
        .select(
            FILE,
            F.col("branch").alias("Filial"),
            *[
                _known(_column(name)).alias(name)
                for name in vocab.HR_COLUMNS
                if name not in ("Filial", "e-mail")
            ],
            _email().alias("e-mail"),
        )
        .select(*vocab.HR_COLUMNS, *[FILE] * with_file)
    )
    rejected = files.where(F.col("reason").isNotNull()).select(FILE, "label", "reason")
    return HrScan(staff, rejected)


def hr_export(staff: DataFrame) -> DataFrame:
    """The HR table as written for users: all text, one line per value."""
    return staff.select(*[export_text(F.col(f"`{c}`").cast("string")).alias(c) for c in staff.columns])
