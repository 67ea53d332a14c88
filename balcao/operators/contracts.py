"""Checks of tables against what they promise: values, unique keys and references.

All rules are checked together. Every table is read once; each of its rows gives a mark for
every value that breaks a rule and one for every key that must be unique, is referred to or
refers. Marks are counted per rule and key, partially before the only large shuffle, so a key
with a third of all rows is a few rows there. The result counts offenders exactly and shows the
first few keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.functions import text as t
from balcao.operators.previews import first_per_group
from balcao.sources.staging import staged

Key = Mapping[str, Callable[[Column], Column]]  # how each column of a key is read
MISSING = "<missing>"
SHOWN = 5


@dataclass(frozen=True)
class Holds:
    """Every value of a column passes a test."""

    table: str
    column: str
    what: str
    test: Callable[[Column], Column]

    @property
    def name(self) -> str:
        return f"{self.table}: {self.column} is {self.what}"


@dataclass(frozen=True)
class Unique:
    """No two rows have the same key. Rows without a whole key do not count."""

    table: str
    key: Key

    @property
    def name(self) -> str:
        return f"{self.table}: {', '.join(self.key)} is unique"


@dataclass(frozen=True)
class Refers:
    """Every key of a table stands in one of the others. Rows without a whole key do not count."""

    table: str
    key: Key
    parents: tuple[tuple[str, Key], ...]

    @property
    def name(self) -> str:
        return f"{self.table}: {', '.join(self.key)} refers to {' or '.join(n for n, _ in self.parents)}"


Rule = Holds | Unique | Refers


def _text(column: str) -> Column:
    return F.col(f"`{column}`").cast("string")


def _key(key: Key) -> Column:
    """The key as one text; null if a part is missing."""
    parts = [t.blank_to_null(read(_text(column))) for column, read in key.items()]
    return parts[0] if len(parts) == 1 else F.concat(parts[0], *[p for part in parts[1:] for p in (F.lit("|"), part)])


def _columns(rule: Rule) -> list[str]:
    return [rule.column] if isinstance(rule, Holds) else list(rule.key)


def applicable(rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> list[Rule]:
    """Rules whose table is there with their columns, and at least one parent."""

    def has(table: str, columns: Sequence[str]) -> bool:
        return table in tables and set(columns) <= set(tables[table].columns)

    return [
        r
        for r in rules
        if has(r.table, _columns(r))
        and (not isinstance(r, Refers) or any(has(name, list(key)) for name, key in r.parents))
    ]


def _marks(name: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame | None:
    """``rule``, ``key``, ``own`` and ``parent`` of one table's rows."""

    def mark(number: int, key: Column, parent: bool) -> Column:
        return F.struct(
            F.lit(number).alias("rule"), key.alias("key"), F.lit(int(not parent)).alias("own"), F.lit(int(parent)).alias("parent")
        )

    found = []
    for number, rule in enumerate(rules):
        if rule.table == name and isinstance(rule, Holds):
            value = _text(rule.column)
            broken = ~F.coalesce(rule.test(value), F.lit(False))
            found.append(F.when(broken, mark(number, F.coalesce(value, F.lit(MISSING)), False)))
        elif rule.table == name:
            found.append(F.when(_key(rule.key).isNotNull(), mark(number, _key(rule.key), False)))
        if isinstance(rule, Refers):
            for parent, key in rule.parents:
                if parent == name and set(key) <= set(df.columns):
                    found.append(F.when(_key(key).isNotNull(), mark(number, _key(key), True)))
    if not found:
        return None
    return df.select(F.explode(F.array_compact(F.array(*found))).alias("m")).select("m.*")


def check_contracts(tables: Mapping[str, DataFrame], rules: Sequence[Rule], spark: SparkSession) -> DataFrame:
    """``rule``, ``rows`` and ``keys`` that break it, and ``shown``: the first keys in order.

    Rules of tables or columns that are absent are left out.
    """
    rules = applicable(rules, tables)
    names = spark.createDataFrame([(i, r.name) for i, r in enumerate(rules)], "number int, name string")
    marks = [m for m in (_marks(name, df, rules) for name, df in tables.items()) if m is not None]
    if not marks:
        return names.select(F.col("name").alias("rule"), F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("keys"), F.array().cast("array<string>").alias("shown"))
    counted = reduce(DataFrame.unionByName, marks).groupBy("rule", "key").agg(
        F.sum("own").alias("own"), F.sum("parent").alias("parent")
    )

    def numbers(kind: type) -> list[int]:
        return [i for i, r in enumerate(rules) if isinstance(r, kind)] or [-1]

    broken = (
        F.col("rule").isin(numbers(Holds))
        | (F.col("rule").isin(numbers(Unique)) & (F.col("own") > 1))
        | (F.col("rule").isin(numbers(Refers)) & (F.col("own") > 0) & (F.col("parent") == 0))
    )
    offenders = staged(counted.where(broken).select("rule", "key", "own"), "offenders")
    totals = offenders.groupBy("rule").agg(F.sum("own").alias("rows"), F.count(F.lit(1)).alias("keys"))
    few = first_per_group(offenders, ["rule"], ["key"], SHOWN).groupBy("rule").agg(
        F.array_sort(F.collect_list("key")).alias("shown")  # SHOWN at most
    )
    found = names.join(totals, names.number == totals.rule, "left").drop("rule")
    found = found.join(few, found.number == few.rule, "left").drop("rule")
    zero = F.lit(0).cast("bigint")
    return found.select(
        F.col("name").alias("rule"),
        F.coalesce("rows", zero).alias("rows"),
        F.coalesce("keys", zero).alias("keys"),
        F.coalesce("shown", F.array().cast("array<string>")).alias("shown"),
    )


def _amount(text: Column) -> Column:
    """Blank amounts are missing, not wrong."""
    return t.blank_to_null(text).isNull() | t.br_to_double(text).isNotNull()


def _branch(text: Column) -> Column:
    return t.branch_key(text)


def _code(text: Column) -> Column:
    return t.code_key(text)


def _tax_id(text: Column) -> Column:
    return t.blank_to_null(text).isNull() | (F.length(t.tax_id(text)) == 11)


def _branch_and_code(branch: str = "Filial", code: str = "Código") -> Key:
    return {branch: _branch, code: _code}


def _same(text: Column) -> Column:
    return t.strip(text)


_AMOUNT, _BRANCH, _CODE = "an amount or blank", "a branch number", "a seller code"
_PERSON_CODE = (("filtered_user", {"Código": _code}),)
_PERSON_NAME = (("filtered_user", {"Filial": _branch, "Nome": t.upper_name}),)

# What each table of a workspace promises.
WORKSPACE_RULES: tuple[Rule, ...] = (
    Holds("VENDAS_VENDEDOR", "Código", _CODE, t.is_code_number),
    Holds("VENDAS_VENDEDOR", "Valor Vendas", _AMOUNT, _amount),
    Unique("VENDAS_VENDEDOR_HB", {"Código": _code}),
    Holds("VENDAS_VENDEDOR_HB", "Valor Vendas", _AMOUNT, _amount),
    Holds("VENDAS_FILIAL", "Filial", _BRANCH, t.is_branch_number),
    Unique("VENDAS_FILIAL", {"Filial": _branch}),
    Holds("VENDAS_FILIAL", "Faturamento Total", _AMOUNT, _amount),
    Holds("VENDAS_FILIAL", "Custo Total", _AMOUNT, _amount),
    Unique("VENDAS_548", {"Filial": _branch}),
    Holds("VENDAS_548", "40% VT", _AMOUNT, _amount),
    Holds("COMISSOES", "Filial", _BRANCH, t.is_branch_number),
    Holds("COMISSOES", "Valor Comissão", _AMOUNT, _amount),
    Refers("COMISSOES", {"Código": _code}, _PERSON_CODE),
    Unique("users_trier", {"Código": _code}),
    Holds("users_trier", "CPF", "a tax id or blank", _tax_id),
    Holds("users_sci", "Filial", _BRANCH, t.is_branch_number),
    Holds("users_sci", "CPF", "a tax id or blank", _tax_id),
    Holds("filtered_user", "Filial", _BRANCH, t.is_branch_number),
    Holds("filtered_user", "Código", _CODE, t.is_code_number),
    Unique("filtered_user", _branch_and_code()),
    Holds("META_FILIAL", "CMV", "a percentage or blank", t.is_percent),
    Holds("META_FILIAL", "Number", _AMOUNT, _amount),
    Unique("META_FILIAL", {"Filial": _branch}),
    Refers("META_FILIAL", {"Filial": _branch}, (("VENDAS_FILIAL", {"Filial": _branch}),)),
    Refers("TRAINEES", _branch_and_code(), (("filtered_user", _branch_and_code()), ("2_META", _branch_and_code()))),
    Holds("2_META", "Filial", _BRANCH, t.is_whole),
    Unique("2_META", {"ID": _same}),
    Refers("2_META", {"Código": _code}, _PERSON_CODE),
    Refers("AFASTAMENTOS", {"Filial": _branch, "Colaborador": t.upper_name}, _PERSON_NAME),
    Unique("META_GERENTE", {"Filial": _branch}),
    Unique("calc", {"ID": _same}),
)
