from __future__ import annotations

import datetime as dt
import inspect
import random
from decimal import Decimal as D
from types import SimpleNamespace

import pytest
from conftest import plan, ts
from pyspark.sql import functions as F

from lotwise.operators import audit as A
from lotwise.operators import holdings as H
from lotwise.operators import keys as K
from lotwise.operators import ledger_edits as L
from lotwise.operators import merge as M
from lotwise.operators import warehouse as W
from lotwise.schemas import (
    AUDIT_IMAGE, DIM_CRYPTOCURRENCY, DIM_EXCHANGE, DIM_TRANSACTION_CATEGORY, FACT_TRANSACTIONS, TABLES, conform,
)
from lotwise.sources import csv_ledger, snapshots
from lotwise.session import shared_dir
from lotwise.streaming import audit_stream as ST


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- keys and loads ------------------------------------------------------------------------------------------

def test_keys_are_dense_and_follow_the_natural_id(spark):
    ids = [5, 17, 3, 900, 901, 902, 10**9, 44, -12]
    df = spark.createDataFrame([(None, i) for i in ids], "key bigint, id bigint")
    got = dict((r.id, r.key) for r in K.assign_surrogate_keys(df, "key", "id").collect())
    assert got == {i: n for n, i in enumerate(sorted(ids), start=1)}
    assert K.assign_surrogate_keys(df.limit(0), "key", "id").collect() == []


def test_existing_keys_stay_and_new_ones_follow(spark):
    df = spark.createDataFrame([(4, 30), (9, 10), (None, 20), (None, 5), (None, 40)], "key bigint, id bigint")
    got = dict((r.id, r.key) for r in K.assign_surrogate_keys(df, "key", "id").collect())
    assert got == {30: 4, 10: 9, 5: 10, 20: 11, 40: 12}
    got = dict((r.id, r.key) for r in K.assign_surrogate_keys(df, "key", "id", start_after=100).collect())
    assert got[5] == 101 and got[30] == 4
    got = dict((r.id, r.key) for r in K.assign_surrogate_keys(df, "key", "id", keyed=df.select(F.lit(50).alias("key"))).collect())
    assert got[5] == 51 and got[30] == 4


def test_keys_of_sparse_ids_over_many_partitions(spark):
    """The whole range of 64 bits; after the input is stored in ranges, only one row a partition is put in order."""
    rng = random.Random(4)
    ids = sorted({rng.randrange(-(2**63), 2**63) for _ in range(300)} | {-(2**63), 2**63 - 1, 0, -1})
    df = spark.createDataFrame([(None, i) for i in ids], "key bigint, id bigint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = K.assign_surrogate_keys(df, "key", "id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert dict((r.id, r.key) for r in keyed.collect()) == {i: n for n, i in enumerate(ids, start=1)}
    assert len(keyed.inputFiles()) > 1
    text = plan(keyed)
    assert "rangepartitioning" not in text and "`id`" not in "".join(x for x in text.split("\n\n") if "Window" in x)


def test_upserts_need_few_exchanges(spark):
    target = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "key bigint, id bigint, name string")
    rows = spark.createDataFrame([(20, "B"), (30, "c")], "id bigint, name string")
    from lotwise.operators.merge import upsert

    got = upsert(target, rows, "id", "key")
    assert sorted(map(tuple, got.collect())) == [(1, 10, "a"), (2, 20, "B"), (3, 30, "c")]
    text = plan(upsert(target, rows, "id", "key"))
    assert text.count("Exchange hashpartitioning") <= 3 and "SortMergeJoin" not in text


def test_next_key(spark):
    assert K.next_key(spark.createDataFrame([(7,), (3,)], "id int"), "id").collect()[0][0] == 8
    assert K.next_key(spark.createDataFrame([], "id int"), "id").collect()[0][0] == 1


def test_upsert_replaces_with_nulls_keeps_keys_and_is_repeatable(spark):
    target = spark.createDataFrame([(1, 10, "a", "x"), (2, 20, "b", "y")], "key bigint, id int, name string, note string")
    load = spark.createDataFrame([(10, "A", None), (15, "n", "z")], "id int, name string, note string")
    once = M.upsert(target, load, "id", "key")
    assert rows(once) == [(1, 10, "A", None), (2, 20, "b", "y"), (3, 15, "n", "z")]
    assert rows(M.upsert(once, load, "id", "key")) == rows(once)


def test_insert_only_never_changes_rows(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    load = spark.createDataFrame([("new", 1), ("new", 2)], "v string, id int")
    assert rows(M.insert_new(target, load, "id")) == [(1, "old"), (2, "new")]


# --- star schema ---------------------------------------------------------------------------------------------

def test_default_calendar(spark):
    days = W.build_dim_date(spark)
    assert days.count() == 3652
    got = {str(r.full_date): tuple(r)[:1] + tuple(r)[2:] for r in days.filter("date_key in (20210101, 20240229, 20260104)").collect()}
    assert got["2021-01-01"] == (20210101, 2021, 1, 1, "January", 1, 5, "Friday", 53, True, False)
    assert got["2024-02-29"] == (20240229, 2024, 1, 2, "February", 29, 4, "Thursday", 9, True, False)
    assert got["2026-01-04"] == (20260104, 2026, 1, 1, "January", 4, 7, "Sunday", 1, False, True)


@pytest.fixture(scope="module")
def star(spark, make):
    tx = make.tx(
        (1, 1, "BUY", 2, "10.5", "2022-01-05 10:11:12", 1, 1, "0.5"),
        (2, 1, "BUY", 1, None, "2022-01-06 00:00:00", 2, None, None),
        (3, 1, "SELL", 1, 20, "2022-01-07 00:00:00", None, 1, "0.25"),
        (4, 2, "DEPOSIT", 5, None, "2022-02-01 00:00:00", 1, 1, "0.1"),
        (5, 1, "BUY", 1, 1, "2004-02-01 00:00:00", 1, 1, None),
        (6, 9, "BUY", 1, 1, "2022-02-01 00:00:00", 1, 1, None),
    )
    cryptos, venues, kinds = make.cryptos(), make.exchanges((1, "Alpha", "EXCHANGE")), make.categories((1, "Trade", "t"))
    empty = lambda schema: W.empty_table(spark, schema)
    return {
        "tx": tx, "cryptos": cryptos, "date": W.build_dim_date(spark),
        "crypto": W.upsert_dim_cryptocurrency(cryptos, empty(DIM_CRYPTOCURRENCY)),
        "exchange": W.upsert_dim_exchange(venues, empty(DIM_EXCHANGE)),
        "category": W.upsert_dim_transaction_category(kinds, empty(DIM_TRANSACTION_CATEGORY)),
    }


def load(star, tx, fact):
    return W.build_fact_transactions(tx, star["date"], star["crypto"], star["exchange"], star["category"], fact)


def test_reload_resets_the_stablecoin_flag(star):
    marked = star["crypto"].withColumn("is_stablecoin", F.lit(True))
    assert rows(W.upsert_dim_cryptocurrency(star["cryptos"], marked)) == rows(star["crypto"])


def test_fact_and_rejects(spark, star):
    fact = load(star, star["tx"], W.empty_table(spark, FACT_TRANSACTIONS))
    got = {r.tx_id_original: r for r in fact.collect()}
    assert set(got) == {1, 2, 3, 4} and [got[i].transaction_key for i in (1, 2, 3, 4)] == [1, 2, 3, 4]
    first = got[1]
    assert (first.date_key, first.time_of_day, first.transaction_value_usd) == (20220105, "10:11:12", D("21.00000000"))
    assert got[2].transaction_value_usd is None and got[2].exchange_key is None and got[3].exchange_key is None
    assert rows(W.fact_rejects(star["tx"], star["date"], star["crypto"])) == [
        (5, "date outside calendar"), (6, "unknown asset"),
    ]
    checks = dict(tuple(r) for r in W.verify_star_null_keys(fact, star["tx"]).collect())
    # row 2 names a venue that the dimension lacks; row 3 has none, row 2 has no category
    assert checks == {"null_date_key": 0, "null_crypto_key": 0, "null_exchange_key": 1, "null_category_key": 0}


def test_fact_upsert_by_tx_id(spark, star, tmp_path):
    first = load(star, star["tx"].filter("tx_id > 1"), W.empty_table(spark, FACT_TRANSACTIONS))
    path = str(tmp_path / "fact")
    snapshots.save_fact(first, path)
    stored = snapshots.read_fact(spark, path)
    assert rows(stored) == rows(first)
    changed = L.update_rows(star["tx"], F.col("tx_id") == 3, {"fee_usd": F.lit(None)})
    second = load(star, changed, stored)
    keys = {r.tx_id_original: (r.transaction_key, r.fee_usd) for r in second.collect()}
    assert keys == {2: (1, None), 3: (2, None), 4: (3, D("0.10000000")), 1: (4, D("0.50000000"))}
    assert rows(load(star, changed, second)) == rows(second)


def test_monthly_summary(spark, star):
    fact = load(star, star["tx"], W.empty_table(spark, FACT_TRANSACTIONS))
    view = W.view_monthly_crypto_transaction_summary(fact, star["date"], star["crypto"])
    got = {(r.year_month, r.crypto_symbol): r for r in view.collect()}
    assert set(got) == {("2022-01", "BTC"), ("2022-02", "ETH")}
    jan = got[("2022-01", "BTC")]
    assert (jan.total_buy_quantity, jan.total_buy_value_usd, jan.number_of_buy_transactions) == (3, 21, 2)
    assert jan.average_buy_price_usd == 7.0 and jan.average_sell_price_usd == 20.0
    assert (jan.net_quantity_transacted_this_month, jan.net_value_transacted_this_month_usd) == (2, 1)
    assert jan.total_fees_paid_for_asset_this_month_usd == D("0.75")
    feb = got[("2022-02", "ETH")]
    assert (feb.total_buy_quantity, feb.number_of_buy_transactions, feb.average_buy_price_usd) == (0, 0, None)
    assert view.filter("crypto_symbol = 'BTC'").count() == 1
    assert rows(W.value_by_symbol_year(fact, star["date"], star["crypto"])) == [("BTC", 2022, D("41.00000000"))]


# --- snapshots, import ---------------------------------------------------------------------------------------

def test_holdings_snapshot_is_stale_until_refreshed(spark, make, tmp_path):
    path = str(tmp_path / "mv")
    one = make.tx((1, 2, "BUY", 1, 1, "2022-01-01 00:00:00"))
    two = L.insert_rows(one, make.tx((2, 1, "BUY", 3, 1, "2022-01-01 00:00:00")))
    snapshots.save_mv_current_holdings(one, make.cryptos(), path)
    assert [r.symbol for r in snapshots.read_mv_current_holdings(spark, path).collect()] == ["ETH"]
    snapshots.save_mv_current_holdings(two, make.cryptos(), path)
    got = snapshots.read_mv_current_holdings(spark, path)
    assert [(r.symbol, r.current_holding_quantity) for r in got.collect()] == [("BTC", 3), ("ETH", 1)]
    assert got.schema["current_holding_quantity"].dataType.simpleString() == "decimal(28,18)"


CSV = """tx_id,crypto_id,exchange_id,category_id,tx_type,quantity,price_per_unit_usd,tx_timestamp,fee_usd,notes
1,1,1,1,BUY,0.5,42000.10,2022-01-13 08:30:00,1.25,first
2,1,,,DEPOSIT,1,,2022-01-14 00:00:00,,
3,1,1,1,BUY,0.5,42000.10,2022-01-00 08:30:00,1.25,day 00
4,1,1,1,BUY,lots,1,2022-01-13 08:30:00,1.25,
5,,1,1,BUY,1,1,2022-01-13 08:30:00,1.25,
"""


def test_a_load_rewrites_only_the_months_it_touches(spark, star, make, tmp_path):
    path = str(tmp_path / "fact")
    ledger = star["tx"].unionByName(make.tx((7, 2, "BUY", 1, 3, "2022-03-01 00:00:00", 1, 1, "0.1")))
    snapshots.save_fact(load(star, ledger, W.empty_table(spark, FACT_TRANSACTIONS)), path)

    def files():
        return {p.parent.name: p.name for p in (tmp_path / "fact").glob("*/part-*.parquet")}

    before = files()
    moved = make.tx(
        (4, 2, "DEPOSIT", 6, None, "2022-01-20 00:00:00", 1, 1, "0.2"), (8, 1, "BUY", 1, 1, "2022-01-21 00:00:00", 1, 1, None)
    )
    fresh = W.fact_rows(moved, star["date"], star["crypto"], star["exchange"], star["category"])
    snapshots.load_fact_months(spark, path, fresh, str(tmp_path / "staging"))
    after = files()
    assert after["date_month=202203"] == before["date_month=202203"]
    assert after["date_month=202201"] != before["date_month=202201"]
    got = {r.tx_id_original: (r.transaction_key, r.date_key, r.quantity) for r in snapshots.read_fact(spark, path).collect()}
    assert set(got) == {1, 2, 3, 4, 7, 8}
    assert got[4] == (4, 20220120, D(6)) and got[8][0] == 6 and got[7][0] == 5


def test_csv_import_quarantines_what_does_not_fit(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(CSV)
    good, bad = csv_ledger.load_ledger_csv(spark, str(tmp_path / "tx.csv"), "transactions")
    got = {r.tx_id: r for r in good.collect()}
    assert set(got) == {1, 2}
    assert got[1].tx_timestamp == dt.datetime(2022, 1, 13, 8, 30) and got[1].fee_usd == D("1.2500")
    assert got[2].price_per_unit_usd is None and got[2].exchange_id is None and got[2].notes is None
    reasons = {r.tx_id: r.reason for r in bad.collect()}
    assert reasons == {
        "3": "tx_timestamp: 2022-01-00 08:30:00", "4": "quantity: lots", "5": "crypto_id: empty",
    }


def test_csv_files_are_split_unless_a_value_holds_a_line_break(spark, tmp_path):
    head = ",".join(f.name for f in TABLES["exchanges"].fields) + "\n"
    width = len(TABLES["exchanges"].fields)
    line = lambda i, name: ",".join([str(i), name, *["x"] * (width - 2)]) + "\n"
    folder = tmp_path / "odd [names] {of} files"
    folder.mkdir()
    (folder / "plain one.csv").write_text(head + "".join(line(i, f'"Name, ""{i}"""') for i in range(3000)))
    (folder / "break %20.csv").write_text(head + line(5000, '"two\nlines"') + line(5001, '"a ""quoted""\r\nend"') + line(5002, "plain"))
    (folder / "stray.csv").write_text(head + line(6000, '5" pipe') + line(6001, "plain"))
    (folder / "empty.csv").write_text(head)
    path = str(tmp_path) + "/odd*"
    found = csv_ledger.files_with_open_quotes(spark, path)
    assert sorted(f.rsplit("/", 1)[1][:5] for f in found) == ["break", "stray"]
    good, bad = csv_ledger.load_ledger_csv(spark, path, "exchanges")
    whole_good, whole_bad = csv_ledger.load_ledger_csv(spark, path, "exchanges", multi_line=True)
    assert rows(good) == rows(whole_good) and good.count() + bad.count() == 3005
    assert rows(bad) == rows(whole_bad)
    assert good.where("exchange_id = 5000").first()[1] == "two\nlines"
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        one = str(tmp_path) + "/odd*/plain*"
        split, _ = csv_ledger.load_ledger_csv(spark, one, "exchanges")
        assert split.rdd.getNumPartitions() > 3 and rows(split) == rows(good.where("exchange_id < 5000"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_csv_import_loses_no_text(spark, tmp_path):
    lines = [
        "tx_id,crypto_id,exchange_id,category_id,tx_type,quantity,price_per_unit_usd,tx_timestamp,fee_usd,notes",
        "3000000000,3000000001,1,1,BUY,1,2,2022-01-01 00:00:00,0.1,big ids",
        "2,1,1,1,BUY,1,2,2022-01-01 00:00:00,0.1,one comma, too many",
        '3,1,1,1,BUY,1,2,2022-01-01 00:00:00,0.1,"two',
        'lines, and ""quotes"""',
        "4,1,1",
        '5,1,1,1,BUY,1,2,2022-01-01 00:00:00,0.1,"never closed',
    ]
    (tmp_path / "tx.csv").write_text("\n".join(lines) + "\n")
    good, bad = csv_ledger.load_ledger_csv(spark, str(tmp_path / "tx.csv"), "transactions")
    notes = {r.tx_id: r.notes for r in good.collect()}
    assert notes[3000000000] == "big ids" and notes[3] == 'two\nlines, and "quotes"'
    kept = "".join(f"{r.line}{r.notes}" for r in bad.collect())
    assert "too many" in kept and "4,1,1" in kept and 2 not in notes and 4 not in notes
    assert "never closed" in kept + "".join(x or "" for x in notes.values())


def test_shared_folder_follows_the_session(spark):
    def session(master, **conf):
        known = SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default))
        return SimpleNamespace(conf=known, sparkContext=SimpleNamespace(master=master))

    assert shared_dir(session("yarn", spark_checkpoint_dir="/shared/example"), "x").startswith("/shared/example/x-")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError):
            shared_dir(session(master, spark_sql_warehouse_dir="/warehouse"), "x")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


# --- edits and audit -----------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def ledger(make):
    return make.tx(
        (1, 1, "BUY", 1, 10, "2022-01-01 00:00:00", 1, None, "0.5", "keep"),
        (2, 1, "BUY", 1, None, "2022-01-02 00:00:00", None, None, None, None),
        (3, 2, "SELL", 1, 5, "2022-01-03 00:00:00", 1, 1, "0.1", "go"),
    )


@pytest.fixture(scope="module")
def changed(ledger, make):
    step = L.insert_rows(ledger, make.tx((4, 1, "BUY", "0.125", 41000, "2022-01-04 00:00:00", 1, 1, "0.3", "new")))
    step = L.update_rows(step, F.col("tx_id") == 2, {"fee_usd": F.lit(1.25), "notes": F.lit("edited")})
    return L.delete_rows(step, F.col("tx_id") == 3)


def test_edits(ledger, changed):
    got = {r.tx_id: (r.fee_usd, r.notes) for r in changed.collect()}
    assert got == {1: (D("0.5"), "keep"), 2: (D("1.25"), "edited"), 4: (D("0.3"), "new")}
    # a predicate that is NULL touches nothing
    assert L.delete_rows(ledger, F.col("exchange_id") == 1).count() == 1
    assert L.update_rows(ledger, F.col("exchange_id") == 1, {"notes": F.lit("z")}).filter("notes = 'z'").count() == 2


def test_inserts_get_the_next_ids(ledger, spark):
    new = ledger.drop("tx_id").withColumn("line", F.dayofmonth("tx_timestamp"))
    got = L.insert_with_new_ids(ledger, new, "line", last_id=3)
    assert sorted(r.tx_id for r in got.collect()) == [1, 2, 3, 4, 5, 6]
    assert got.schema == ledger.schema or got.dtypes == ledger.dtypes


def test_audit_holds_old_images_of_updates_and_deletes(ledger, changed):
    got = {(r.operation_type, r.tx_id): r for r in A.audit_changes(ledger, changed).collect()}
    assert set(got) == {("I", 4), ("U", 2), ("D", 3)}
    assert got[("U", 2)].notes is None and got[("D", 3)].notes == "go" and got[("I", 4)].notes == "new"
    assert A.audit_changes(ledger, ledger).count() == 0


def test_audit_entries_and_the_latest_of_them(ledger, changed):
    first = A.audit_entries(A.audit_changes(ledger, changed), dt.datetime(2022, 2, 1))
    later = A.audit_entries(A.audit_changes(changed, ledger), dt.datetime(2022, 2, 2), last_audit_id=3)
    assert [r.audit_id for r in first.orderBy("tx_id").collect()] == [1, 2, 3]
    last = A.recent_audit(first.unionByName(later), 4).collect()
    assert [r.audit_id for r in last] == [6, 5, 4, 3]


def test_replaying_the_log_backwards_restores_the_ledger(ledger, changed):
    log = A.audit_changes(ledger, changed)
    images = AUDIT_IMAGE.fieldNames()
    untouched = conform(changed, AUDIT_IMAGE).join(log.select("tx_id"), "tx_id", "left_anti").select(images)
    restored = untouched.unionByName(log.filter("operation_type <> 'I'").select(images))
    assert rows(restored) == rows(conform(ledger, AUDIT_IMAGE))


def test_stream_logs_every_change_once(spark, ledger, tmp_path):
    feed, log, checkpoint = (str(tmp_path / n) for n in ("feed", "log", "checkpoint"))
    image = conform(ledger, AUDIT_IMAGE).select("tx_id", F.struct(*AUDIT_IMAGE.fieldNames()).alias("image"))
    none = F.lit(None).cast(AUDIT_IMAGE)

    def change(op, tx_id, minute, old=True, new=True):
        at = F.lit(ts(f"2022-03-01 00:{minute:02d}:00"))
        image.filter(F.col("tx_id") == tx_id).select(
            F.lit(op).alias("op"), at.alias("changed_at"),
            F.when(F.lit(old), F.col("image")).otherwise(none).alias("old"),
            F.when(F.lit(new), F.col("image")).otherwise(none).alias("new"),
        ).coalesce(1).write.mode("append").parquet(feed)

    def run():
        ST.start_audit_stream(ST.read_change_feed(spark, feed), log, checkpoint).awaitTermination()
        return sorted((r.operation_timestamp.minute, r.operation_type, r.tx_id) for r in spark.read.parquet(log).collect())

    change("I", 1, 1, old=False)
    change("U", 1, 2)  # changes nothing, is logged all the same
    change("U", 1, 3)
    assert run() == [(1, "I", 1), (2, "U", 1), (3, "U", 1)]
    change("D", 2, 4, new=False)
    assert run() == [(1, "I", 1), (2, "U", 1), (3, "U", 1), (4, "D", 2)]
    assert run() == [(1, "I", 1), (2, "U", 1), (3, "U", 1), (4, "D", 2)]
    deleted = spark.read.parquet(log).filter("operation_type = 'D'").collect()[0]
    assert deleted.tx_timestamp == dt.datetime(2022, 1, 2)
    assert sorted(r.audit_id for r in spark.read.parquet(log).collect()) == [1, 2, 3, 4] and deleted.audit_id == 4
    # A batch that is repeated gives its ids again, and no batch reads the log: only the file beside it.
    source = inspect.getsource(ST.start_audit_stream)
    assert "read.parquet(audit_path)" not in source
    assert [spark.read.parquet(f"{log}/{ST.LAST_IDS}/{n}").first()[0] for n in (0, 1)] == [3, 4]
    (tmp_path / "checkpoint" / "commits" / "1").unlink()
    (tmp_path / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    assert run() == [(1, "I", 1), (2, "U", 1), (3, "U", 1), (4, "D", 2)]
    assert sorted(r.audit_id for r in spark.read.parquet(log).collect()) == [1, 2, 3, 4]
    change("D", 3, 5, new=False)
    assert run()[-1] == (5, "D", 3)
    assert sorted(r.audit_id for r in spark.read.parquet(log).collect()) == [1, 2, 3, 4, 5]


def _random_ledgers(make, seed):
    """A ledger and the next one, after inserts, updates (also of asset, quantity and month) and deletes."""
    rng = random.Random(seed)
    when = lambda: f"2022-{rng.randrange(1, 7):02d}-{rng.randrange(1, 28):02d} 00:00:00"
    row = lambda i: (i, rng.randrange(1, 4), rng.choice(["BUY", "SELL", "DEPOSIT", "OTHER"]), rng.randrange(1, 50), 10, when(), None, None, None, None)
    old = {i: row(i) for i in range(1, 120)}
    new = {i: (row(i) if rng.random() < 0.1 else r) for i, r in old.items() if rng.random() > 0.1} | {i: row(i) for i in range(200, 220)}
    return make.tx(*old.values()), make.tx(*new.values())


def test_changes_of_random_ledgers_by_checksum(spark, make, monkeypatch, tmp_path):
    monkeypatch.setattr(A, "IDS_PER_RANGE", 10)
    for seed in range(3):
        before, after = _random_ledgers(make, seed)
        images = [conform(x, AUDIT_IMAGE) for x in (before, after)]
        old, new = ({r.tx_id: r for r in x.collect()} for x in images)
        want = {("I", i) for i in new.keys() - old.keys()} | {("D", i) for i in old.keys() - new.keys()}
        want |= {("U", i) for i in old.keys() & new.keys() if old[i] != new[i]}
        stored = []
        for n, x in enumerate((before, after)):
            snapshots.save_ledger(x, f"{tmp_path}/{seed}-{n}")
            stored.append(snapshots.read_ledger(spark, f"{tmp_path}/{seed}-{n}"))
        for pair in ((before, after), stored):
            got = A.audit_changes(*pair).collect()
            assert {(r.operation_type, r.tx_id) for r in got} == want and len(got) == len(want)
            assert all(tuple(r)[1:] == tuple((new if r.operation_type == "I" else old)[r.tx_id]) for r in got)


def test_unchanged_months_are_not_read_by_the_join(spark, make, tmp_path):
    base = [(i, 1, "BUY", 1, 10, f"2022-{1 + i % 6:02d}-01 00:00:00") for i in range(1, 61)]
    blank = make.tx((100, 1, "BUY", 1, 10, "2022-01-01 00:00:00")).withColumn("tx_timestamp", F.lit(None).cast("timestamp"))
    ledgers = [make.tx(*base), L.update_rows(make.tx(*base), F.col("tx_id") == 2, {"notes": F.lit("x")}), make.tx(*base).unionByName(blank)]
    stored = []
    for n, ledger in enumerate(ledgers):
        snapshots.save_ledger(ledger, f"{tmp_path}/{n}")
        stored.append(snapshots.read_ledger(spark, f"{tmp_path}/{n}"))
    assert A.differing_ranges(stored[0], stored[1]).collect() == [(202203, 0)]
    changes = A.audit_changes(stored[0], stored[1])
    assert [(r.operation_type, r.tx_id) for r in changes.collect()] == [("U", 2)]
    assert "tx_month" in plan(changes) and "PartitionFilters: [(tx_month" in plan(changes).replace("isnotnull(tx_month", "(tx_month") and "202203" in plan(changes)
    same = A.audit_changes(stored[0], stored[0])
    assert same.collect() == [] and "Join" not in plan(same).split("== Initial Plan ==")[0]
    assert [(r.operation_type, r.tx_id) for r in A.audit_changes(stored[0], stored[2]).collect()] == [("I", 100)]


def test_holdings_are_refreshed_from_the_audit_log(spark, make, tmp_path):
    for seed in range(3):
        before, after = _random_ledgers(make, seed)
        _, last = _random_ledgers(make, seed + 10)
        path, cryptos = f"{tmp_path}/mv{seed}", make.cryptos((1, "A", "a"), (2, "B", "b"), (3, "C", "c"))
        snapshots.save_mv_current_holdings(before, cryptos, path)
        first = {p: p.stat().st_mtime_ns for p in (tmp_path / f"mv{seed}").rglob("part-*")}
        one = A.audit_entries(A.audit_changes(before, after), dt.datetime(2022, 7, 1))
        two = A.audit_entries(A.audit_changes(after, last), dt.datetime(2022, 7, 2), last_audit_id=one.count())
        snapshots.refresh_mv_current_holdings(one, after, cryptos, path)
        assert rows(snapshots.read_mv_current_holdings(spark, path)) == rows(_holdings(after, cryptos))
        # Rows may have several entries: only the first one's image was counted.
        both = f"{tmp_path}/both{seed}"
        snapshots.save_mv_current_holdings(before, cryptos, both)
        snapshots.refresh_mv_current_holdings(one.unionByName(two), last, cryptos, both)
        assert rows(snapshots.read_mv_current_holdings(spark, both)) == rows(_holdings(last, cryptos))
        assert all(p.stat().st_mtime_ns == t for p, t in first.items())
        # A version without its mark isn't read.
        snapshots._net(last).write.parquet(f"{path}/holdings/version=3")
        assert rows(snapshots.read_mv_current_holdings(spark, path)) == rows(_holdings(after, cryptos))


def _holdings(tx, cryptos):
    return H.current_holdings(tx, cryptos).withColumn("current_holding_quantity", F.col("current_holding_quantity").cast("decimal(28,18)"))


def test_the_stored_report_is_refreshed_by_month(spark, star, make, tmp_path):
    fact, report = str(tmp_path / "fact"), str(tmp_path / "report")
    ledger = star["tx"].unionByName(make.tx((7, 2, "BUY", 1, 3, "2022-03-01 00:00:00", 1, 1, "0.1"), (9, 1, "BUY", 1, 3, "2022-04-01 00:00:00")))
    snapshots.save_fact(load(star, ledger, W.empty_table(spark, FACT_TRANSACTIONS)), fact)
    snapshots.save_monthly_summary(snapshots.read_fact(spark, fact), star["date"], star["crypto"], report)
    files = lambda: {p.parent.name: p.name for p in (tmp_path / "report").glob("*/part-*.parquet")}
    before = files()
    # One row moves out of April, which is left without any; one is new.
    moved = make.tx((9, 1, "BUY", 5, 3, "2022-01-20 00:00:00"), (8, 1, "BUY", 1, 1, "2022-01-21 00:00:00"))
    fresh = W.fact_rows(moved, star["date"], star["crypto"], star["exchange"], star["category"])
    months = snapshots.load_fact_months(spark, fact, fresh, str(tmp_path / "staging"))
    assert months == [202201, 202204]
    snapshots.refresh_monthly_summary(spark, report, fact, months, star["date"], star["crypto"])
    after = files()
    assert after["summary_month=202203"] == before["summary_month=202203"] and after["summary_month=202201"] != before["summary_month=202201"]
    whole = W.view_monthly_crypto_transaction_summary(snapshots.read_fact(spark, fact), star["date"], star["crypto"])
    assert rows(snapshots.read_monthly_summary(spark, report)) == rows(whole)


def test_a_load_that_broke_off_is_finished_from_staging(spark, star, make, tmp_path, monkeypatch):
    path, staging = str(tmp_path / "fact"), str(tmp_path / "staging")
    snapshots.save_fact(load(star, star["tx"], W.empty_table(spark, FACT_TRANSACTIONS)), path)
    moved = make.tx((4, 2, "DEPOSIT", 6, None, "2022-01-20 00:00:00", 1, 1, "0.2"), (8, 1, "BUY", 1, 1, "2022-01-21 00:00:00"))
    fresh = W.fact_rows(moved, star["date"], star["crypto"], star["exchange"], star["category"])
    want = load(star, L.insert_rows(L.delete_rows(star["tx"], F.col("tx_id") == 4), moved), snapshots.read_fact(spark, path)).collect()
    broken = lambda *args: (_ for _ in ()).throw(RuntimeError("lost"))
    finish, touched = snapshots.finish_fact_months, []
    monkeypatch.setattr(snapshots, "finish_fact_months", lambda s, p, st, months: (touched.extend(months), broken()))
    with pytest.raises(RuntimeError):
        snapshots.load_fact_months(spark, path, fresh, staging)
    for _ in range(2):
        finish(spark, path, staging, touched)
        assert rows(snapshots.read_fact(spark, path)) == sorted(map(tuple, want), key=str)
