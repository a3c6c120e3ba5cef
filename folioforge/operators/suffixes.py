"""Names made unique by suffixes, where a suffixed name may already be another's own.

In order, each field of a table takes the first of ``x``, ``x_2``, ``x_3`` ... that no
earlier field has. That is the one stable matching in which fields ask for names in
that order and a name goes to the earliest field, so it is found by rounds: all fields
ask at once, the later of two that ask for one name moves on. The r-th field of a base
asks for no suffix below r, nor for one that an earlier field of its base asks for,
so rounds are only as many as names of different bases push each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from folioforge.session import kept


def unique_names(fields: DataFrame, table: str, order: str, base: str) -> DataFrame:
    """``fields`` with ``name``.

    ``order`` is unique within a table; a null table is one of its own. A null base is
    empty, and so is its name until it gets a suffix. Other columns pass through.
    """
    rows = fields.select(F.coalesce(F.col(table).cast("string"), F.lit("")).alias("t"), F.col(table).isNull().alias("none"), F.col(order).alias("o"), F.coalesce(F.col(base), F.lit("")).alias("base"))
    of = ["t", "none"]
    group = Window.partitionBy(*of, "base").orderBy("o")
    rows = rows.withColumn("r", F.row_number().over(group)).withColumn("s", F.col("r"))
    while True:
        moved = Observation()
        name = F.when(F.col("s") == 1, F.col("base")).otherwise(F.concat("base", F.lit("_"), F.col("s")))
        asked = rows.withColumn("name", name)
        first = asked.groupBy(*of, "name").agg(F.min("o").alias("first"))
        asked = asked.join(first, [*of, "name"]).withColumn("s", F.col("s") + F.when(F.col("o") > F.col("first"), 1).otherwise(0))
        pushed = F.max(F.col("s") - F.col("r")).over(group.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("r")
        asked = asked.withColumn("s", pushed).observe(moved, F.count_if(F.col("o") > F.col("first")).alias("n"))
        rows = kept(asked.select(*of, "o", "base", "r", "s", "name"), "names")
        if not moved.get["n"]:
            break
        rows = rows.drop("name")
    named = rows.select(*of, "o", "name")
    on = (F.coalesce(F.col(f"f.{table}").cast("string"), F.lit("")) == F.col("n.t")) & (F.col(f"f.{table}").isNull() == F.col("n.none")) & (F.col(f"f.{order}") == F.col("n.o"))
    return fields.alias("f").join(named.alias("n"), on, "left").select("f.*", "n.name")
