"""Insert-only and upsert loads. Both return the table's next content; Parquet has no MERGE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.operators.keys import assign_surrogate_keys


def insert_new(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Target rows unchanged, plus the rows whose key it does not hold."""
    return target.unionByName(rows.join(target, key, "left_anti").select(target.columns))


def upsert(
    target: DataFrame, rows: DataFrame, natural_id: str, surrogate: str, keyed: DataFrame | None = None,
    size: int | None = None,
) -> DataFrame:
    """Rows replace the target's row of the same natural id, NULLs included, and keep its surrogate key.

    New ids get the next keys; target rows without a counterpart stay. One full outer join on a key that is
    unique on both sides. ``keyed`` has all keys given so far where the target is a part of a larger table,
    ``size`` is the number of rows of both, where that is known.
    """
    values = [c for c in target.columns if c not in (natural_id, surrogate)]
    old = target.select(natural_id, F.lit(True).alias("kept"), F.col(surrogate), F.struct(*values).alias("old"))
    new = rows.select(natural_id, F.lit(True).alias("loaded"), F.struct(*values).alias("new"))
    merged = old.join(new, natural_id, "full").select(
        surrogate, natural_id,
        *[F.when(F.col("loaded"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in values],
    )
    return assign_surrogate_keys(merged, surrogate, natural_id, keyed=keyed, rows=size).select(target.columns)
