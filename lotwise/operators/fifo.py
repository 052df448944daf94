"""First-in-first-out tax lots.

Buys and sells of an asset each form a queue: laid end to end in time order, every lot covers an interval
of the asset's running quantity. A sale takes from the buys whose intervals overlap its own. Written as
a join this compares every buy with every sale of an asset; here the interval ends of both sides are sorted
together instead, and between two neighbouring ends lies at most one (buy, sale) pair.

An asset may hold a large part of the ledger, so nothing runs on one asset's lots as a whole. A queue is
cut into slices of whole years; a year with more than ``slice_rows`` lots into months, such a month into days, and
such a day into its instants and, within one instant, ranges of ids:

1. Slice totals, added up before the shuffle, give each slice the running quantity it starts from. Only
   these totals, at most one per asset, side and slice, are ever put in order per asset.
2. The start value enters its slice as a header row, so the running sum within the slice is already the
   running sum of the whole queue, without a join.
3. Slice ends of both sides cut the running quantity into segments. Every segment sends a marker to the one
   buy slice and the one sell slice that cover it; there the marker learns the segment's carry-in lot and
   each lot learns its segment. Lots and markers are then matched segment by segment.

The lots with their slices and the slices' bounds are stored once, in the shared folder; all steps read them there. All
rows are then shuffled twice: by asset, side and slice, then by asset and segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.expressions import above_dust, is_type
from lotwise.schemas import QUANTITY
from lotwise.session import shared_dir

# Lots that one slice should hold at most, and ids per range where a single instant holds more.
SLICE_ROWS = 1_000_000
IDS_PER_RANGE = 1_000_000
_HEADER, _MARKER, _LOT = 0, 1, 2
_RUNNING = "decimal(28,8)"


def _lots(tx: DataFrame, crypto_id: int | None) -> DataFrame:
    """The rows that take part: BUY and SELL with a quantity and a price (which may be 0)."""
    rows = tx.filter(
        F.col("tx_type").isin("BUY", "SELL") & (F.col("quantity") > 0) & F.col("price_per_unit_usd").isNotNull()
    )
    if crypto_id is not None:
        rows = rows.filter(F.col("crypto_id") == crypto_id)
    return rows.select(
        "crypto_id", F.col("tx_type").alias("side"), "tx_id", "tx_timestamp", "quantity", "price_per_unit_usd"
    )


def _with_slice(lots: DataFrame, slice_rows: int) -> DataFrame:
    """Lots with their slice, which orders like (tx_timestamp, tx_id).

    Lots are counted by day, before the shuffle, and days summed up to months and years. The days of years with more
    than ``slice_rows`` lots are a list of at most 366 entries for each that many lots, which bounds its broadcast. It
    is stored, as every step must cut alike; mostly it is empty, and slices are years.
    """
    queue = ["crypto_id", "side"]
    days = lots.groupBy(*queue, F.date_trunc("day", "tx_timestamp").alias("day")).agg(F.count(F.lit(1)).alias("lots"))
    within = lambda unit: F.sum("lots").over(Window.partitionBy(*queue, F.date_trunc(unit, "day"))) > slice_rows
    sizes = [within("year").alias("large_year"), within("month").alias("large_month"), (F.col("lots") > slice_rows).alias("large_day")]
    path = shared_dir(lots.sparkSession, "large-slices")
    days.select(*queue, "day", *sizes).filter("large_year").write.parquet(path)
    large = lots.sparkSession.read.parquet(path)
    some = not large.isEmpty()
    day = F.date_trunc("day", "tx_timestamp")
    sized = lots.withColumn("day", day).join(F.broadcast(large), [*queue, "day"], "left") if some else lots
    finer = lambda when, column: F.when(F.col(when), column) if some else F.when(F.lit(False), column)
    part = F.struct(
        F.date_trunc("year", "tx_timestamp").alias("year"),
        finer("large_year", F.date_trunc("month", "tx_timestamp")).alias("month"),
        finer("large_month", day).alias("day"),
        finer("large_day", F.col("tx_timestamp")).alias("instant"),
        finer("large_day", F.expr(f"tx_id div {IDS_PER_RANGE}")).alias("ids"),
    )
    return sized.select(*lots.columns, part.alias("slice"))


def _stored_slices(lots: DataFrame, slice_rows: int) -> tuple[DataFrame, DataFrame]:
    """Lots with their slices, and the slices' bounds. Lots and bounds are written to the shared folder once, and all
    steps read them there."""
    spark = lots.sparkSession
    plain, bounds = (shared_dir(spark, name) for name in ("lots", "slices"))
    lots.write.parquet(plain)
    sliced = _with_slice(spark.read.schema(lots.schema).parquet(plain), slice_rows)
    _slice_bounds(sliced).write.parquet(bounds)
    return sliced, spark.read.parquet(bounds)


def _slice_bounds(lots: DataFrame) -> DataFrame:
    """crypto_id, side, slice, slice_start, slice_end: each slice's interval of running quantity."""
    totals = lots.groupBy("crypto_id", "side", "slice").agg(F.sum("quantity").alias("total"))
    in_order = Window.partitionBy("crypto_id", "side").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("total").over(in_order).cast(_RUNNING)
    return totals.select(
        "crypto_id", "side", "slice",
        (end - F.col("total")).cast(_RUNNING).alias("slice_start"),
        end.alias("slice_end"),
    )


def _headers(bounds: DataFrame) -> DataFrame:
    return bounds.select(
        "crypto_id", "side", "slice", F.lit(_HEADER).alias("kind"), F.col("slice_start").alias("amount")
    )


def _running(lots: DataFrame, extra: DataFrame) -> DataFrame:
    """Lots plus their slices' header (and marker) rows, with the queue's running quantity in ``end``."""
    rows = lots.select("*", F.lit(_LOT).alias("kind"), F.col("quantity").cast(_RUNNING).alias("amount"))
    in_order = (
        Window.partitionBy("crypto_id", "side", "slice")
        .orderBy(F.asc_nulls_first("tx_timestamp"), "tx_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return rows.unionByName(extra, allowMissingColumns=True).withColumn(
        "end", F.sum("amount").over(in_order).cast(_RUNNING)
    )


def _queue(tx: DataFrame, side: str, crypto_id: int | None, slice_rows: int) -> DataFrame:
    lots, bounds = _stored_slices(_lots(tx.filter(is_type(side)), crypto_id), slice_rows)
    return _running(lots, _headers(bounds)).filter(F.col("kind") == _LOT)


def fifo_buys(tx: DataFrame, crypto_id: int | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    return _queue(tx, "BUY", crypto_id, slice_rows).select(
        "crypto_id",
        F.col("tx_id").alias("buy_tx_id"),
        F.col("tx_timestamp").alias("buy_timestamp"),
        F.col("quantity").alias("buy_quantity"),
        F.col("price_per_unit_usd").alias("buy_price_usd"),
        F.col("end").alias("cumulative_buy_quantity"),
    )


def fifo_sells(tx: DataFrame, crypto_id: int | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    return _queue(tx, "SELL", crypto_id, slice_rows).select(
        "crypto_id",
        F.col("tx_id").alias("sell_tx_id"),
        F.col("tx_timestamp").alias("sell_timestamp"),
        F.col("quantity").alias("sell_quantity"),
        F.col("price_per_unit_usd").alias("sell_price_usd"),
        F.col("end").alias("cumulative_sell_quantity"),
        (F.col("end") - F.col("quantity")).cast(_RUNNING).alias("prev_cumulative_sell_quantity"),
    )


def _segments(bounds: DataFrame) -> DataFrame:
    """crypto_id, cut, floor, BUY, SELL: intervals (floor, cut] between slice ends, with the slices covering them.

    A segment that one side does not reach matches nothing and is left out.
    """
    sides = ("BUY", "SELL")
    cuts = bounds.groupBy("crypto_id", F.col("slice_end").alias("cut")).agg(
        *[F.max(F.when(F.col("side") == s, F.col("slice"))).alias(s) for s in sides]
    )
    downwards = Window.partitionBy("crypto_id").orderBy(F.desc("cut"))
    so_far = downwards.rowsBetween(Window.unboundedPreceding, 0)
    return cuts.select(
        "crypto_id", "cut",
        F.coalesce(F.lead("cut").over(downwards), F.lit(0).cast(_RUNNING)).alias("floor"),
        *[F.last(s, ignorenulls=True).over(so_far).alias(s) for s in sides],
    ).filter(F.col("BUY").isNotNull() & F.col("SELL").isNotNull())


def _markers(segments: DataFrame) -> DataFrame:
    both = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("slice")) for s in ("BUY", "SELL")]))
    return segments.select("crypto_id", "cut", "floor", both.alias("at")).select(
        "crypto_id", "at.side", "at.slice", "cut", "floor",
        F.lit(_MARKER).alias("kind"),
        F.lit(0).cast(_RUNNING).alias("amount"),
    )


def fifo_matched_lots(tx: DataFrame, crypto_id: int | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per pair of a sale and a buy lot it takes from.

    A buy later than the sale is no match, but keeps its place in the queue: what a sale takes from it is
    dropped and not carried to another lot.
    """
    return _matched(*_stored_slices(_lots(tx, crypto_id), slice_rows))


def _matched(lots: DataFrame, bounds: DataFrame) -> DataFrame:
    rows = _running(lots, _headers(bounds).unionByName(_markers(_segments(bounds)), allowMissingColumns=True))

    # Within a slice, from its upper end down: a marker comes before the lots that end at its cut.
    lot = F.when(
        F.col("kind") == _LOT,
        F.struct("tx_id", "tx_timestamp", F.col("price_per_unit_usd").alias("price")),
    )
    downwards = Window.partitionBy("crypto_id", "side", "slice").orderBy(F.desc("end"), F.asc("kind"))
    so_far = downwards.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.filter(F.col("kind") != _HEADER)
        .withColumn("end", F.coalesce("cut", "end"))
        .select(
            "crypto_id", "side", "kind", "end",
            F.last("cut", ignorenulls=True).over(so_far).alias("cut"),
            F.last("floor", ignorenulls=True).over(so_far).alias("floor"),
            F.last(lot, ignorenulls=True).over(so_far).alias("lot"),
        )
        .filter(F.col("cut").isNotNull() & F.col("lot").isNotNull())
    )

    # Within a segment, again downwards: the lot last seen on a side covers the piece below this end.
    def covering(side: str, over) -> Column:
        return F.last(F.when(F.col("side") == side, F.col("lot")), ignorenulls=True).over(over)

    downwards = Window.partitionBy("crypto_id", "cut").orderBy(F.desc("end"), F.asc("kind"))
    so_far = downwards.rowsBetween(Window.unboundedPreceding, 0)
    below = F.coalesce(F.lead("end").over(downwards), F.col("floor"))
    return (
        placed.select(
            "crypto_id",
            covering("SELL", so_far).alias("sell"),
            covering("BUY", so_far).alias("buy"),
            (F.col("end") - below).cast(QUANTITY).alias("quantity_sold_from_this_buy"),
        )
        .filter(
            above_dust(F.col("quantity_sold_from_this_buy"))
            & (F.col("buy.tx_timestamp") <= F.col("sell.tx_timestamp"))
        )
        .select(
            "crypto_id",
            F.col("sell.tx_id").alias("sell_tx_id"),
            F.col("sell.tx_timestamp").alias("sell_timestamp"),
            F.col("sell.price").alias("sell_price_usd"),
            F.col("buy.tx_id").alias("buy_tx_id"),
            F.col("buy.tx_timestamp").alias("buy_timestamp"),
            F.col("buy.price").alias("buy_price_usd"),
            "quantity_sold_from_this_buy",
        )
    )


def _taken() -> Column:
    return F.col("quantity_sold_from_this_buy")


def _proceeds() -> Column:
    return _taken() * F.col("sell_price_usd")


def _cost() -> Column:
    return _taken() * F.col("buy_price_usd")


def fifo_realized_single_asset(
    tx: DataFrame, cryptos: DataFrame, crypto_id: int, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    matched = fifo_matched_lots(tx, crypto_id, slice_rows)
    return matched.join(cryptos, "crypto_id", "left").select(
        "sell_tx_id", "symbol", "sell_timestamp",
        _taken().alias("quantity_sold"),
        "sell_price_usd",
        F.col("buy_tx_id").alias("matched_buy_lot_tx_id"),
        F.col("buy_timestamp").alias("matched_buy_lot_timestamp"),
        F.col("buy_price_usd").alias("cost_basis_per_unit"),
        _proceeds().alias("proceeds_from_this_lot_portion"),
        _cost().alias("cost_of_this_lot_portion"),
        (_proceeds() - _cost()).cast("decimal(38,16)").alias("realized_gain_loss_usd"),
    )


def _per_sale(matched: DataFrame) -> DataFrame:
    return matched.groupBy("crypto_id", "sell_tx_id", "sell_timestamp").agg(
        F.sum(_taken()).alias("total_quantity_sold_in_sale"),
        F.sum(_proceeds()).alias("total_proceeds_for_sale"),
        F.sum(_cost()).alias("total_cost_basis_for_sale"),
        F.sum(_proceeds() - _cost()).cast("decimal(38,16)").alias("total_realized_gain_loss_for_sale"),
    )


def _sale_report(matched: DataFrame, cryptos: DataFrame, how: str) -> DataFrame:
    return _per_sale(matched).join(cryptos, "crypto_id", how).select(
        "sell_tx_id", "symbol", "sell_timestamp", "total_quantity_sold_in_sale", "total_proceeds_for_sale",
        "total_cost_basis_for_sale", "total_realized_gain_loss_for_sale",
    )


def _annual_report(matched: DataFrame, cryptos: DataFrame, how: str) -> DataFrame:
    """Years are those of the sale. Gains add up straight from the matched pieces, one row per asset and year."""
    yearly = matched.groupBy("crypto_id", F.year("sell_timestamp").alias("tax_year")).agg(
        F.sum(_proceeds() - _cost()).alias("gain")
    )
    return (
        yearly.join(cryptos, "crypto_id", how)
        .groupBy("symbol", "tax_year")
        .agg(F.sum("gain").cast("decimal(38,16)").alias("annual_realized_gain_loss_usd"))
    )


def fifo_summary_per_sale_single_asset(
    tx: DataFrame, cryptos: DataFrame, crypto_id: int, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    return _sale_report(fifo_matched_lots(tx, crypto_id, slice_rows), cryptos, "left")


def fifo_annual_single_asset(tx: DataFrame, cryptos: DataFrame, crypto_id: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    return _annual_report(fifo_matched_lots(tx, crypto_id, slice_rows), cryptos, "left")


def fifo_summary_per_sale_all_assets(tx: DataFrame, cryptos: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    return _sale_report(fifo_matched_lots(tx, None, slice_rows), cryptos, "inner")


def fifo_annual_all_assets(tx: DataFrame, cryptos: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    return _annual_report(fifo_matched_lots(tx, None, slice_rows), cryptos, "inner")


def buy_lot_consumption(tx: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    return (
        fifo_matched_lots(tx, None, slice_rows)
        .groupBy("crypto_id", "buy_tx_id")
        .agg(F.sum(_taken()).alias("total_quantity_consumed"))
    )


def tax_lot_inventory_current(tx: DataFrame, cryptos: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Buy lots with a quantity left. Lots and what was taken from them meet in one aggregate by lot."""
    stored, bounds = _stored_slices(_lots(tx, None), slice_rows)
    lots = stored.filter(F.col("side") == "BUY").select(
        "crypto_id",
        F.col("tx_id").alias("buy_tx_id"),
        F.col("tx_timestamp").alias("buy_timestamp"),
        F.col("quantity").alias("original_buy_quantity"),
        F.col("price_per_unit_usd").alias("purchase_price_per_unit_usd"),
        F.lit(0).cast(QUANTITY).alias("taken"),
    )
    taken = _matched(stored, bounds).select("crypto_id", "buy_tx_id", _taken().alias("taken"))
    facts = ("buy_timestamp", "original_buy_quantity", "purchase_price_per_unit_usd")
    remaining = (F.col("original_buy_quantity") - F.col("taken")).cast(_RUNNING)
    return (
        lots.unionByName(taken, allowMissingColumns=True)
        .groupBy("crypto_id", "buy_tx_id")
        .agg(*[F.max(c).alias(c) for c in facts], F.sum("taken").alias("taken"))
        .filter(above_dust(remaining))
        .join(cryptos, "crypto_id")
        .select(
            "buy_tx_id", "symbol", *facts,
            F.col("taken").alias("quantity_sold_from_this_lot"),
            remaining.alias("remaining_quantity_in_lot"),
        )
    )
