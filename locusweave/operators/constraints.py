"""Declared constraints of tables, evaluated to rows of what violates them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VIOLATIONS = "table string, rule string, column string, value string, n long"


@dataclass
class Table:
    """What a table has to hold: columns that must be there, types that values must read as, columns without nulls, unique keys, and references to keys of other tables (column, table, column)."""

    name: str
    rows: DataFrame
    required: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()


def violations(*tables: Table) -> DataFrame:
    """table, rule, column, value and n (rows) of every violation; no row means all is well.

    Types and nulls of all columns are looked at in one pass of a table, each unique key is one aggregate, each reference one anti-join. A rule on a column that is absent is reported as the
    absent column only, if the column is required.
    """
    by_name = {t.name: t for t in tables}
    found = [_columns(t) for t in tables] + [_values(t) for t in tables] + [_unique(t, key) for t in tables for key in t.unique] + [_reference(t, by_name[other], column, key) for t in tables for column, other, key in t.references]
    return reduce(DataFrame.unionByName, [f for f in found if f is not None])


def _labelled(t: Table, df: DataFrame, rule: str, column: str) -> DataFrame:
    return df.select(F.lit(t.name).alias("table"), F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.col("value").cast("string").alias("value"), F.col("n").cast("long").alias("n"))


def _columns(t: Table) -> DataFrame:
    absent = [(t.name, "absent column", c, None, 0) for c in t.required if c not in t.rows.columns]
    return t.rows.sparkSession.createDataFrame(absent, VIOLATIONS)


def _values(t: Table) -> DataFrame | None:
    checks = [(c, "null", F.isnull(c)) for c in t.not_null if c in t.rows.columns]
    checks += [(c, f"not {kind}", F.isnotnull(c) & F.isnull(F.col(c).cast("string").try_cast(kind))) for c, kind in t.types.items() if c in t.rows.columns]
    if not checks:
        return None
    wrong = F.array_compact(F.array(*(F.when(bad, F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))) for c, rule, bad in checks)))
    rows = t.rows.select(F.explode(wrong).alias("w")).select("w.*")
    return rows.groupBy("rule", "column", "value").agg(F.count(F.lit(1)).alias("n")).select(F.lit(t.name).alias("table"), "rule", "column", "value", "n")


def _unique(t: Table, key: tuple[str, ...]) -> DataFrame | None:
    if any(c not in t.rows.columns for c in key):
        return None
    again = t.rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _labelled(t, again.select(F.concat_ws("|", *(F.col(c).cast("string") for c in key)).alias("value"), "n"), "not unique", ",".join(key))


def _reference(t: Table, other: Table, column: str, key: str) -> DataFrame | None:
    if column not in t.rows.columns or key not in other.rows.columns:
        return None
    own = t.rows.where(F.isnotnull(column)).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return _labelled(t, own.join(other.rows.select(F.col(key).cast("string").alias("value")).distinct(), "value", "left_anti"), f"not in {other.name}", column)
