"""Text files as they reach a shop: HR extracts, report pages and versions, from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.catalogue import retail
from balcao.catalogue.retail import table
from balcao.functions import text as t
from balcao.operators.ordered import FILE
from balcao.sources.staging import new_folder


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    df.write.options(header=True, escape='"', **options).csv(path)


def hr_table(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("branch"),
        F.lit("matriz").alias("Centro de custo"),
        retail.cpf_of(key).alias("CPF"),
        F.concat(F.lit("João; "), F.col("c_name")).alias("Nome"),
        F.concat(F.lit("01 - "), F.col("c_mktsegment")).alias("Cargo atual"),
        F.when(key % 3 == 0, "nan").otherwise(F.concat(F.lit("c"), key, F.lit("@x.br "))).alias("mail"),
        F.when(key % 5 == 0, 'São\nPaulo "SP"').otherwise("Belém, PA").alias("Cidade"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("Sexo"),
        F.lit("Não").alias("Deficiência"),
        F.lit("Brasil").alias("País de nascimento"),
        F.lit("01/02/1990").alias("Data de nascimento"),
        (key % 40 + 20).cast("string").alias("Idade"),
        F.lit("03/04/2020").alias("Data de admissão"),
        F.lit(None).cast("string").alias("Data de desligamento"),
        t.br_text(F.col("c_acctbal")).alias("Salário atual"),
    )


def write_hr_folder(spark: SparkSession, folder: str) -> str:
    """HR files per branch: two delimiters, two encodings, two column orders."""
    target = new_folder(spark, "hr")
    staff = hr_table(spark, folder).withColumn(
        "file", F.concat(F.lit("Colaboradores - "), retail.two_digits(F.col("branch")), F.lit(".csv"))
    )
    even = staff.where(F.col("branch") % 2 == 0).drop("branch")
    odd = staff.where(F.col("branch") % 2 == 1).drop("branch", "Centro de custo")
    reordered = odd.select(*reversed([c for c in odd.columns if c != "mail"]), "mail")
    even.write.partitionBy("file").options(
        header=True, sep=";", encoding="ISO-8859-1", escape='"', quoteAll=True
    ).csv(f"{target}/a")
    reordered.withColumnRenamed("mail", "E-MAIL").write.partitionBy("file").options(
        header=True, sep=",", encoding="UTF-8", escape='"'
    ).csv(f"{target}/b")
    unnamed = staff.where(F.col("branch") == 3).select("CPF", "Nome")
    write_csv(unnamed, f"{target}/outros.csv")
    return target


def write_bad_hr_files(spark: SparkSession, folder: str) -> str:
    """Bad HR files of customers: for each nation one for every 20,000 numbers, and one at least."""
    target = new_folder(spark, "hr")
    key, kind = F.col("n_nationkey"), F.col("n_nationkey") % 4
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    people = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("n_nationkey"), F.floor(F.col("c_custkey") / 20_000).alias("part"), "c_custkey", "c_name"
    )
    wide = F.when(kind == 3, ";1").otherwise("")
    rows = people.where(kind != 2).select(
        "n_nationkey", "part", F.lit(2).alias("place"), "c_custkey",
        F.concat(F.col("c_custkey").cast("string"), F.lit(";"), "c_name", wide).alias("value"),
    )
    files = people.select("n_nationkey", "part").union(nations.select("n_nationkey", F.lit(0))).distinct()
    # The nation itself is each file's first row.
    own = F.concat(key.cast("string"), F.lit(";"), "n_name", wide)
    lines = F.when(kind == 2, F.array(F.struct(F.lit(0).alias("place"), F.lit("CPF;Nome").alias("value")))).otherwise(
        F.array(
            F.struct(F.lit(0).alias("place"), F.lit("CPF;Nome").alias("value")),
            F.struct(F.lit(1).alias("place"), own.alias("value")),
            F.struct(F.lit(3).alias("place"), F.when(kind == 1, F.concat(F.lit('1;"'), "n_name")).alias("value")),
        )
    )
    fixed = files.join(nations, "n_nationkey").select("n_nationkey", "part", F.explode(lines).alias("l"))
    fixed = fixed.select("n_nationkey", "part", "l.place", F.lit(0).cast("bigint").alias("c_custkey"), "l.value")
    title = F.when(kind == 0, "outros").otherwise("COLABORADORES")
    file = F.concat(title, F.lit(" - "), key.cast("string"), F.when(kind == 0, "x").otherwise(""), F.lit(".csv"))
    bad = rows.unionByName(fixed).where("value is not null").withColumn("file", file)
    ordered = bad.repartition("part", "file").sortWithinPartitions("part", "file", "place", "c_custkey")
    ordered.select("part", "file", "value").write.partitionBy("part", "file").text(target)
    return target


def print_grid(grid: DataFrame, path: str, width: int) -> None:
    """Write a report grid as delimited text, one file per report, rows in order.

    A report is a page of at most a thousand sellers, so no file outgrows a task. Rows the
    grid does not have between title and header are written as blank cells.
    """
    shown = [F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(f"c{i}") for i in range(width)]
    title = F.col("row_idx") == 0
    rows = grid.withColumn(
        "row_idx",
        F.explode(F.when(title, F.expr("sequence(0L, 8L)")).otherwise(F.array("row_idx"))),
    )
    ordered = rows.repartition(FILE).sortWithinPartitions(FILE, "row_idx")
    ordered.select(FILE, *shown).write.partitionBy(FILE).options(
        header=False, sep=";", emptyValue="", quoteAll=False
    ).csv(path)
