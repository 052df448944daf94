"""Insert, update and delete on a ledger snapshot: each returns the next snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.operators.keys import assign_surrogate_keys


def insert_rows(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows that carry their own tx_id."""
    return ledger.unionByName(rows)


def insert_with_new_ids(ledger: DataFrame, rows: DataFrame, order_by: str, last_id: int = 0) -> DataFrame:
    """Rows without a tx_id get the ids after the ledger's last one (and after ``last_id``), in order of a unique
    integer column of theirs, which the ledger does not keep."""
    keyed = assign_surrogate_keys(
        rows.withColumn("tx_id", F.lit(None).cast("bigint")), "tx_id", order_by, start_after=last_id, keyed=ledger
    )
    wanted = {f.name: f.dataType for f in ledger.schema.fields}
    return ledger.unionByName(keyed.select(*[F.col(c).cast(t).alias(c) for c, t in wanted.items()]))


def update_rows(ledger: DataFrame, where: Column, assignments: dict[str, Column]) -> DataFrame:
    """A row is changed only where the predicate is true; NULL leaves it alone."""
    hit = F.coalesce(where, F.lit(False))
    types = {f.name: f.dataType for f in ledger.schema.fields}
    return ledger.select(
        *[
            F.when(hit, assignments[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
            for c in ledger.columns
        ]
    )


def delete_rows(ledger: DataFrame, where: Column) -> DataFrame:
    return ledger.filter(~F.coalesce(where, F.lit(False)))
