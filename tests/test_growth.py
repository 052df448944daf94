"""Steps that would write or shuffle more than the rows they are about."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from conftest import plan
from pyspark.sql import functions as F

from lotwise import session
from lotwise.operators import audit as A
from lotwise.operators import keys as K
from lotwise.operators import ledger_edits as L
from lotwise.plans import queries as Q
from lotwise.sources import snapshots


@pytest.fixture
def run(spark, tmp_path):
    """A run over small tables: lines that come more than once, orders without a customer, one without lines."""
    day = dt.datetime(1995, 1, 1)
    lines = [
        (n % 40, 1 + n % 7, n % 3, day + dt.timedelta(days=n * 7 % 2400), *["NF", "RO", "AO"][n % 3], float(n % 9), 10.0 + n, 0.1)
        for n in range(600)
    ]
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_shipdate timestamp_ntz, l_returnflag string, "
        "l_linestatus string, l_quantity double, l_extendedprice double, l_tax double",
    ).repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    tables = {
        "orders": ([(n, n % 6) for n in range(41)], "o_orderkey bigint, o_custkey bigint"),
        "customer": ([(n, n % 4) for n in range(5)], "c_custkey bigint, c_nationkey int"),
        "nation": ([(n, f"N{n}", n % 3) for n in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(n, f"R{n}") for n in range(3)], "r_regionkey int, r_name string"),
        "supplier": ([(n, f"Supplier {n}") for n in range(3)], "s_suppkey bigint, s_name string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return Q._Run(spark, str(tmp_path))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_order_lines_are_shuffled_once_for_copies_and_orders(run):
    text = run.transactions._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(l_orderkey") == 1 and "l_linenumber#" not in "".join(
        line for line in text.splitlines() if "Exchange" in line
    )


def test_snapshots_of_one_ledger_share_its_files(run):
    before = run.before_by_month
    run.after_by_month
    assert set(before.inputFiles()) <= set(run.whole_by_month.inputFiles()) and run.before.count() < run.transactions.count()
    late = F.lit(Q.LATE_FROM).cast("timestamp")
    assert rows(run.before) == rows(run.transactions.filter(F.col("tx_timestamp") < late))
    assert rows(run.after.filter(F.col("tx_timestamp") >= late)) == rows(run.transactions.filter(F.col("tx_timestamp") >= late))


def test_ranges_stay_few_however_far_ids_spread(spark, make):
    before = make.tx(*[(n * 10**9, 1, "BUY", 1, 10, "2022-01-01 00:00:00") for n in range(3000)])
    after = L.update_rows(before, F.col("tx_id") % (2 * 10**9) == 0, {"notes": F.lit("x")})
    assert 0 < A.differing_ranges(before, after).count() <= A.RANGES
    assert A.audit_changes(before, after).count() == 1500


def test_snapshots_are_compared_in_their_own_types(run):
    shuffled = [x for x in plan(A.audit_changes(run.before_by_month, run.after_by_month)).split("\n\n") if "Exchange" in x]
    assert shuffled and not any("decimal(28,18)" in x for x in shuffled)
    log = A.audit_changes(run.before_by_month, run.after_by_month)
    assert log.schema["quantity"].dataType.simpleString() == "decimal(28,18)"


def test_the_last_entries_come_from_ledgers_stored_once(run):
    log = Q._audit_log(run)
    last = A.recent_audit(log, 5).collect()
    assert [r.audit_id for r in last] == sorted((r.audit_id for r in log.collect()), reverse=True)[:5]
    assert set(run.before_by_month.inputFiles()) <= set(run.whole_by_month.inputFiles())


def test_a_stream_numbers_rows_without_ordering_them(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3 % 1000).alias("x"), F.col("id").alias("came"))
    numbered = K.number_as_they_come(df, "n", start_after=50)
    got = numbered.collect()
    assert [r.n for r in sorted(got, key=lambda r: r.came)] == list(range(51, 1051))
    assert set(numbered.columns) == {"x", "came", "n"} and "rangepartitioning" not in plan(numbered)


def test_a_refresh_takes_from_the_log_what_holdings_need(run, monkeypatch, tmp_path):
    taken = []
    real = snapshots._net
    monkeypatch.setattr(snapshots, "_net", lambda tx: (taken.append(tx), real(tx))[1])
    snapshots.save_mv_current_holdings(run.before, run.cryptocurrencies, str(tmp_path / "mv"))
    snapshots.refresh_mv_current_holdings(Q._audit_log(run), run.after, run.cryptocurrencies, str(tmp_path / "mv"))
    assert sorted(taken[-1].columns) == ["crypto_id", "quantity", "tx_type"]
    fresh = str(tmp_path / "fresh")
    snapshots.save_mv_current_holdings(run.after, run.cryptocurrencies, fresh)
    assert rows(snapshots.read_mv_current_holdings(run.spark, str(tmp_path / "mv"))) == rows(snapshots.read_mv_current_holdings(run.spark, fresh))


def test_loads_read_a_ledger_stored_once(run):
    run.booked
    run.__dict__["transactions"] = None
    whole = Q.warehouse.view_monthly_crypto_transaction_summary(run.fact_rows(run.booked), run.dim_date, run.dim_crypto)
    # The earlier load comes without fees.
    fees = "total_fees_paid_for_asset_this_month_usd"
    assert rows(Q._refreshed_summary(run).drop(fees)) == rows(whole.drop(fees)) and whole.count() > 50


@pytest.mark.parametrize("odd", [False, True])
def test_rows_of_a_load_meet_keys_and_not_rows(spark, run, tmp_path, monkeypatch, odd):
    monkeypatch.setattr(snapshots, "ROWS_PER_SLICE", 3)
    fact, path = run.fact_rows(run.booked), str(tmp_path / "fact")
    early = fact.filter("date_key < 19970000 and tx_id_original % 3 > 0")
    snapshots.save_fact(K.assign_surrogate_keys(early, "transaction_key", "tx_id_original"), path)
    stored = {r.tx_id_original: r for r in snapshots.read_fact(spark, path).collect()}
    # A part of the stored rows, some in another month, without fees, and new ones.
    load = fact.filter("tx_id_original % 2 = 0").withColumns({
        "date_key": F.when(F.col("tx_id_original") % 4 == 0, 19960115).otherwise(F.col("date_key")), "fee_usd": F.lit(None).cast("decimal(18,8)"),
    })
    if odd:
        load = load.unionByName(fact.filter("tx_id_original % 2 = 1").limit(1).withColumn("tx_id_original", F.lit(None).cast("bigint")))
    else:
        monkeypatch.setattr(snapshots, "upsert", lambda *args, **kw: pytest.fail("whole rows are paired"))
    new = {r.tx_id_original: r for r in load.collect()}
    snapshots.load_fact_months(spark, path, load, str(tmp_path / "staging"))
    got = snapshots.read_fact(spark, path).collect()
    assert len(got) == len({r.tx_id_original for r in got}) == len(stored.keys() | new.keys())
    values = [c for c in fact.columns if c != "transaction_key"]
    for r in got:
        want = new.get(r.tx_id_original) or stored[r.tx_id_original]
        assert [r[c] for c in values] == [want[c] for c in values]
    keys = {r.tx_id_original: r.transaction_key for r in got}
    assert all(keys[i] == r.transaction_key for i, r in stored.items())
    fresh = sorted(new.keys() - stored.keys(), key=lambda i: (i is not None, i or 0))
    assert [keys[i] for i in fresh] == list(range(len(stored) + 1, len(keys) + 1))


def test_the_log_joins_snapshots_once_in_as_many_tasks_as_rows_need(run, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 20)
    taken = []
    real = A.assign_surrogate_keys
    monkeypatch.setattr(A, "assign_surrogate_keys", lambda df, *args, **kw: (taken.append(df), real(df, *args, **kw))[1])
    changes = A.audit_changes(run.before_by_month, run.after_by_month)
    rows_of_both = run.before.count() + run.after.count()
    assert f"hashpartitioning(tx_id#, {-(-rows_of_both // 20)})" in re.sub(r"#\d+L?", "#", plan(changes))
    log = A.audit_entries(changes, Q.LOGGED_AT)
    # Numbering samples its input: a join there would run twice.
    assert "Join" not in plan(taken[0]) and log.count() == changes.count() > 100
    ids = [(r.audit_id, r.tx_id) for r in log.collect()]
    assert sorted(ids) == list(zip(range(1, len(ids) + 1), sorted(i for _, i in ids), strict=True))


def test_loads_number_and_join_in_as_many_tasks_as_rows_need(run, monkeypatch):
    whole = rows(Q._refreshed_summary(run))
    monkeypatch.setattr(session, "ROWS_PER_TASK", 20)
    again = Q._Run(run.spark, run.folder)
    tasks = -(-600 // 20)
    assert f"hashpartitioning(l_orderkey#, {tasks})" in re.sub(r"#\d+L?", "#", plan(again.transactions))
    asked = []
    for module in (K, snapshots):
        real = module.tasks_for
        monkeypatch.setattr(module, "tasks_for", lambda spark, n, real=real: (asked.append(n), real(spark, n))[1])
    assert rows(Q._refreshed_summary(again)) == whole
    # The numbers of the first and the second load, and the rows that are dealt by month; dimensions don't say theirs.
    assert len([n for n in asked if n and n > 100]) == 3
