"""Index, one-hot and assembly of sparse vectors as one relational step.

Fitting gives a slot table, one row per (column, value) and per number
column; applying it explodes every row into its (column, value) entries,
joins them to the table once — whatever the number of columns — and folds
them back into ``(indices, values)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.operators.common import materialized
from spindle.operators.encode import fit_string_indexes


@dataclass
class SlotTable:
    table: DataFrame            # column_name, value, slot, name (written); value is NULL for numbers
    categorical: list[str]
    numeric: list[str]
    size: int

    @classmethod
    def fit(cls, train: DataFrame, categorical: list[str], numeric: list[str]) -> "SlotTable":
        """Slots in the order of the columns: a category's by frequency, ties
        by value (every category seen in ``train`` has one, others none), then one
        for each number column."""
        ranked = materialized(fit_string_indexes(train, categorical), "slot-index")
        sizes = {r.column_name: r["count"] for r in ranked.groupBy("column_name").count().collect()}     # a row a column
        starts, at = [], 0
        for c in categorical:
            starts.append((c, at))
            at += sizes.get(c, 0)
        first = F.element_at(F.create_map(*[x for c, s in starts for x in (F.lit(c), F.lit(s))]), F.col("column_name"))
        slots = ranked.select("column_name", "value", (first + F.col("label_index")).cast("int").alias("slot"),
                              F.concat_ws("=", "column_name", "value").alias("name"))
        numbers = train.sparkSession.createDataFrame([(c, None, at + i, c) for i, c in enumerate(numeric)],
                                                     "column_name string, value string, slot int, name string")
        return cls(materialized(slots.unionByName(numbers), "slots"), categorical, numeric, at + len(numeric))

    def transform(self, df: DataFrame, key: str, null_number: str = "error") -> DataFrame:
        """``(key, size, indices, values)`` for every row of ``df`` (``key`` is
        unique).  An unseen or NULL category has no entry, nor has a zero.  A
        NULL number raises, or drops the row (``skip``), or is NaN (``keep``)."""
        if null_number not in ("error", "skip", "keep"):
            raise ValueError(null_number)
        rows = df
        missing = F.lit(False)
        for c in self.numeric:
            missing = missing | F.col(c).isNull()
        if null_number == "skip":
            rows = rows.filter(~missing)
        elif null_number == "error" and self.numeric:
            message = F.lit("NULL in a number column of " + ", ".join(self.numeric))
            rows = rows.filter(F.when(missing, F.raise_error(message).cast("boolean")).otherwise(True))
        entry = [F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c).cast("string"), F.lit(None)).alias("_v"),
                          F.lit(1.0).alias("_x")) for c in self.categorical]
        entry += [F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("_v"),
                           F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias("_x")) for c in self.numeric]
        entries = rows.select(key, F.explode(F.array(*entry)).alias("e")).select(key, "e.*")
        slots = self.table.select(F.col("column_name").alias("_c"), F.col("value").alias("_value"), "slot")
        number = F.col("column_name").isin(self.numeric) if self.numeric else F.lit(False)
        matched = entries.join(slots, (F.col("column_name") == F.col("_c")) & F.col("_v").eqNullSafe(F.col("_value")), "left")
        kept = F.col("slot").isNotNull() & (number | F.col("_v").isNotNull()) & (F.col("_x") != 0)
        folded = matched.groupBy(key).agg(F.array_sort(F.collect_list(F.when(
            kept, F.struct("slot", "_x")))).alias("_e"))                # at most one entry a column
        return folded.select(key, F.lit(self.size).alias("size"), F.col("_e.slot").alias("indices"), F.col("_e._x").alias("values"))
