"""Missing values, sentinels, casts and category rewrites
(P6–P10, P13–P17, A5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def inject_marker(df: DataFrame, column: str, marker, condition: Column) -> DataFrame:
    """Put a missing-value marker into ``column`` where ``condition`` holds:
    NULL when ``marker`` is None (type kept), else the string ``marker`` (the
    column becomes a string, as a CSV column holding 'NA' would).  Used to
    place markers in the driver tables, which carry none; every row is kept.
    """
    if marker is None:
        dtype = df.schema[column].dataType
        return df.withColumn(column, F.when(condition, F.lit(None).cast(dtype))
                             .otherwise(F.col(column)))
    return df.withColumn(column, F.when(condition, F.lit(marker))
                         .otherwise(F.col(column).cast("string")))


def drop_marked(df: DataFrame, columns: list[str], marker: str) -> DataFrame:
    """Keep rows whose listed columns are neither NULL nor equal to ``marker``
    (P7).  Comparison is on the string form, so an already-numeric column is
    accepted instead of raising under ANSI mode."""
    keep = [F.coalesce(F.col(c).cast("string") != F.lit(marker), F.lit(False)) for c in columns]
    return df.filter(reduce(lambda a, b: a & b, keep)) if keep else df


def cast_columns(df: DataFrame, columns: list[str], dtype: str = "double") -> DataFrame:
    """``try_cast`` the listed columns (P13): a bad value becomes NULL rather
    than failing the job."""
    return df.withColumns({c: F.col(c).try_cast(dtype) for c in columns})


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in ``subset`` (all columns when None) — P8, P9."""
    return df.na.drop(how="any", subset=subset)


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """Fill NULLs per column with a constant (P10); the result is used."""
    return df.na.fill(values)


def column_modes(df: DataFrame, columns: list[str], exclude: str | None = None) -> DataFrame:
    """Exact most frequent value per column: ``(column_name, mode, mode_count)``.

    One scan for all columns: each row becomes (column, value) pairs, counted
    with a map-side partial aggregate (a hot value costs one partial row per
    task).  NULL and ``exclude`` are not candidates; ties go to the greatest
    value.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("p")).select("p.*")
    pairs = pairs.filter(F.col("value").isNotNull())
    if exclude is not None:
        pairs = pairs.filter(F.col("value") != F.lit(exclude))
    counts = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column_name").agg(
        F.max_by("value", F.struct("n", "value")).alias("mode"),
        F.max("n").alias("mode_count"))


def modes_dict(modes: DataFrame) -> dict[str, str]:
    """The fitted modes (one row per column — model-sized) as a dict."""
    return {r["column_name"]: r["mode"] for r in modes.collect()}


def impute_marker(df: DataFrame, fills: dict[str, str], marker: str,
                  include_null: bool = False) -> DataFrame:
    """Replace ``marker`` (and NULL, if asked) by the learnt value per column
    (P14).  A column without a learnt value raises."""
    missing = [c for c, v in fills.items() if v is None]
    if missing:
        raise ValueError(f"no mode learnt for {missing}")
    hit = {c: F.col(c) == F.lit(marker) for c in fills}
    return df.withColumns({
        c: F.when(hit[c] | F.col(c).isNull() if include_null else hit[c], F.lit(v)).otherwise(F.col(c))
        for c, v in fills.items()})


def frequent_items(df: DataFrame, columns: list[str], support: float) -> DataFrame:
    """Values that more than ``support`` of all rows hold (A5):
    ``(column_name, item, n_rows)``, exactly.  A first pass keeps a mergeable
    frequent-items summary per task (at most ``1 / support`` values a column,
    no true one missing); a second counts those candidates and drops false
    positives.  NULL is not a value."""
    found = df.freqItems(columns, support).first()
    pairs, total = [], F.count(F.lit(1)).alias("_total")
    for c in columns:
        items = [x for x in (found[f"{c}_freqItems"] or []) if x is not None]
        if items:
            pairs.append(F.when(F.col(c).isin(items), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("item"))))
    counted = df.select(F.explode(F.array(F.struct(F.lit(None).cast("string").alias("column_name"),
                                                   F.lit(None).cast("string").alias("item")), *pairs)).alias("p"))
    counts = counted.filter("p is not null").groupBy("p.column_name", "p.item").agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.filter("column_name is null").select(F.col("n_rows").alias("_total"))       # one row
    return (counts.filter("column_name is not null").crossJoin(F.broadcast(total))
            .filter(F.col("n_rows") > F.lit(support) * F.col("_total")).drop("_total"))


def collapse_category(c: Column | str, keep: str, other: str) -> Column:
    """Two-valued category: ``keep`` stays, anything else becomes ``other``;
    NULL stays NULL (P15)."""
    col = _c(c)
    return F.when(col != F.lit(keep), F.lit(other)).otherwise(col)


def binary_label(c: Column | str, negative: str, strip: str = ".") -> Column:
    """0 for ``negative`` (ignoring blanks and trailing ``strip`` characters,
    so ``'<=50K.'`` and ``' <=50K'`` both count), otherwise 1 (P16)."""
    norm = F.rtrim(F.trim(_c(c)), F.lit(strip)) if strip else F.trim(_c(c))
    return F.when(norm == F.lit(negative), F.lit(0)).otherwise(F.lit(1))
