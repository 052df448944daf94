from __future__ import annotations

import random
from decimal import Decimal as D

import pytest
from conftest import plan

from lotwise.operators import fifo as X


def matches(df):
    return {(r.sell_tx_id, r.buy_tx_id): r.quantity_sold_from_this_buy for r in df.collect()}


def brute_force(rows):
    """Overlap of every sale's interval with every buy's, as the rule is stated."""
    out = {}
    for asset in {r[1] for r in rows}:
        queues = {}
        for side in ("BUY", "SELL"):
            end, queue = D(0), []
            for r in sorted((r for r in rows if r[1] == asset and r[2] == side), key=lambda r: (r[5], r[0])):
                if r[4] is None or D(str(r[3])) <= 0:
                    continue
                queue.append((end, end + D(str(r[3])), r))
                end += D(str(r[3]))
            queues[side] = queue
        for s_lo, s_hi, s in queues["SELL"]:
            for b_lo, b_hi, b in queues["BUY"]:
                q = min(s_hi, b_hi) - max(s_lo, b_lo)
                if q > 0 and b[5] <= s[5]:
                    out[(s[0], b[0])] = q
    return out


def random_ledger(seed, n=160, assets=3, days=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        asset = 1 if rng.random() < 0.6 else rng.randint(2, assets)
        side = rng.choice(["BUY", "BUY", "SELL", "DEPOSIT"])
        quantity = rng.choice([1, 2, 3, 5, "0.00000001", "2.5", 0])
        price = rng.choice([None, 0, 1, 2, "3.25"])
        day, hour = rng.randint(1, days), rng.choice([0, 0, 9, 17])
        when = f"2022-{1 + (day - 1) // 28:02d}-{1 + (day - 1) % 28:02d} {hour:02d}:{rng.choice([0, 30]):02d}:00"
        rows.append((i + 1, asset, side, quantity, price, when))
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("most", [1, 2, 5, 10**6])
def test_equals_the_interval_overlap(make, seed, most):
    rows = random_ledger(seed)
    expected = brute_force(rows)
    assert len(expected) > 20
    assert matches(X.fifo_matched_lots(make.tx(*rows), slice_rows=most)) == expected


@pytest.mark.parametrize("most", [1, 2, 5, 10**6])
def test_one_sale_over_many_slices_and_many_sales_in_one_lot(make, most):
    rows = [(1, 1, "BUY", 30, 1, "2022-01-01 00:00:00")]
    rows += [(10 + i, 1, "SELL", 1, 2, f"2022-{1 + i % 12:02d}-02 03:00:00") for i in range(24)]
    rows += [(100 + i, 1, "BUY", 1, 3, f"2022-{1 + i % 12:02d}-03 05:{i:02d}:00") for i in range(30)]
    rows += [(900, 1, "SELL", 36, 9, "2023-01-01 00:00:00")]
    assert matches(X.fifo_matched_lots(make.tx(*rows), slice_rows=most)) == brute_force(rows)


def test_equal_ends_and_ties_in_time(make):
    rows = [
        (1, 1, "BUY", 2, 1, "2022-01-01 00:00:00"), (2, 1, "BUY", 2, 2, "2022-01-01 00:00:00"),
        (3, 1, "SELL", 2, 5, "2022-01-01 00:00:00"), (4, 1, "SELL", 2, 6, "2022-01-02 00:00:00"),
    ]
    assert matches(X.fifo_matched_lots(make.tx(*rows))) == {(3, 1): D(2), (4, 2): D(2)}


def test_shortfall_is_dropped_and_not_carried(make):
    rows = [
        (1, 1, "SELL", 3, 10, "2022-01-01 00:00:00"),
        (2, 1, "BUY", 5, 1, "2022-01-02 00:00:00"),
        (3, 1, "SELL", 1, 10, "2022-01-03 00:00:00"),
    ]
    tx = make.tx(*rows)
    # the first sale takes the first 3 of the queue, but they were bought later: nothing for it
    assert matches(X.fifo_matched_lots(tx)) == {(3, 2): D(1)}
    sales = X.fifo_summary_per_sale_all_assets(tx, make.cryptos()).collect()
    assert [r.sell_tx_id for r in sales] == [3]
    lot = X.tax_lot_inventory_current(tx, make.cryptos()).collect()[0]
    assert (lot.quantity_sold_from_this_lot, lot.remaining_quantity_in_lot) == (D(1), D(4))


def test_other_types_unpriced_and_empty_rows_stay_out(make):
    rows = [
        (1, 1, "DEPOSIT", 9, 1, "2022-01-01 00:00:00"), (2, 1, "BUY", 4, None, "2022-01-01 00:00:00"),
        (3, 1, "BUY", 0, 1, "2022-01-01 00:00:00"), (4, 1, "BUY", 2, 0, "2022-01-01 00:00:00"),
        (5, 1, "SELL", 1, 8, "2022-01-02 00:00:00"),
    ]
    row = X.fifo_realized_single_asset(make.tx(*rows), make.cryptos(), 1).collect()[0]
    assert (row.matched_buy_lot_tx_id, row.quantity_sold, row.cost_basis_per_unit) == (4, D(1), D(0))
    assert row.realized_gain_loss_usd == D(8)


@pytest.fixture(scope="module")
def two_assets(make):
    return make.tx(
        (1, 1, "BUY", 2, 100, "2021-01-01 00:00:00"),
        (2, 1, "BUY", 3, 200, "2021-02-01 00:00:00"),
        (3, 1, "SELL", "2.5", 400, "2021-12-31 23:59:59"),
        (4, 1, "SELL", 1, 100, "2022-01-01 00:00:00"),
        (5, 2, "BUY", 1, 10, "2021-01-01 00:00:00"),
        (6, 2, "SELL", 1, 5, "2021-06-01 00:00:00"),
    )


def test_reports(two_assets, make):
    c = make.cryptos()
    assert {tuple(r)[:1] + tuple(r)[3:] for r in X.fifo_summary_per_sale_all_assets(two_assets, c).collect()} == {
        (3, D("2.5"), D(1000), D(300), D(700)), (4, D(1), D(100), D(200), D(-100)), (6, D(1), D(5), D(10), D(-5)),
    }
    assert {tuple(r) for r in X.fifo_annual_all_assets(two_assets, c).collect()} == {
        ("BTC", 2021, D(700)), ("BTC", 2022, D(-100)), ("ETH", 2021, D(-5)),
    }
    assert {tuple(r) for r in X.fifo_annual_single_asset(two_assets, c, 2).collect()} == {("ETH", 2021, D(-5))}
    assert X.fifo_summary_per_sale_single_asset(two_assets, c, 1).count() == 2
    assert {(r.sell_tx_id, r.matched_buy_lot_tx_id) for r in X.fifo_realized_single_asset(two_assets, c, 1).collect()} == {
        (3, 1), (3, 2), (4, 2),
    }


def test_single_asset_reports_need_no_dimension_row(two_assets, make):
    rows = X.fifo_summary_per_sale_single_asset(two_assets, make.cryptos((1, "BTC", "Bitcoin")), 2).collect()
    assert [(r.sell_tx_id, r.symbol) for r in rows] == [(6, None)]


def test_lots_and_queues(two_assets, make):
    left = {r.buy_tx_id: r.remaining_quantity_in_lot for r in X.tax_lot_inventory_current(two_assets, make.cryptos()).collect()}
    assert left == {2: D("1.5")}
    assert {tuple(r) for r in X.buy_lot_consumption(two_assets).collect()} == {(1, 1, D(2)), (1, 2, D("1.5")), (2, 5, D(1))}
    buys = {r.buy_tx_id: r.cumulative_buy_quantity for r in X.fifo_buys(two_assets).collect()}
    assert buys == {1: D(2), 2: D(5), 5: D(1)}
    sells = {r.sell_tx_id: (r.prev_cumulative_sell_quantity, r.cumulative_sell_quantity) for r in X.fifo_sells(two_assets, 1).collect()}
    assert sells == {3: (D(0), D("2.5")), 4: (D("2.5"), D("3.5"))}


def test_amounts_balance(make):
    tx = make.tx(*random_ledger(99))
    matched = X.fifo_matched_lots(tx)
    sold = {r.sell_tx_id: r.sell_quantity for r in X.fifo_sells(tx).collect()}
    taken = {}
    for r in matched.collect():
        taken[r.sell_tx_id] = taken.get(r.sell_tx_id, D(0)) + r.quantity_sold_from_this_buy
    assert all(q <= sold[s] for s, q in taken.items())
    bought = sum(r.buy_quantity for r in X.fifo_buys(tx).collect())
    left = sum(r.remaining_quantity_in_lot for r in X.tax_lot_inventory_current(tx, make.cryptos((1, "A", "a"), (2, "B", "b"), (3, "C", "c"))).collect())
    assert left == bought - sum(taken.values())


def test_no_pairing_in_the_plan(two_assets):
    text = plan(X.fifo_matched_lots(two_assets))
    assert "SortMergeJoin" not in text and "NestedLoop" not in text and "Cartesian" not in text


def slices(tx, most):
    return X._with_slice(X._lots(tx, None), most).groupBy("crypto_id", "side", "slice").count().collect()


def test_slices_are_years_unless_they_are_large(make):
    rows = [(i, 1, "BUY", 1, 1, f"2022-01-{1 + i // 6:02d} {i % 6:02d}:00:00") for i in range(24)]
    rows.append((30, 1, "BUY", 1, 1, "2023-05-05 00:00:00"))
    tx = make.tx(*rows)
    assert sorted(r["count"] for r in slices(tx, 24)) == [1, 24]
    assert sorted(r["count"] for r in slices(tx, 6)) == [1] + [6] * 4
    assert sorted(r["count"] for r in slices(tx, 1)) == [1] * 25


def test_half_the_ledger_at_one_instant_is_split(make, monkeypatch):
    monkeypatch.setattr(X, "IDS_PER_RANGE", 10)
    rows = [(i, 1, "BUY", 1, 1, "2022-01-01 00:00:00") for i in range(95)]
    rows += [(1000 + i, i % 4, "SELL", 1, 1, f"2022-{1 + i % 12:02d}-07 00:00:00") for i in range(100)]
    tx = make.tx(*rows)
    assert max(r["count"] for r in slices(tx, 30)) == 25
    assert max(r["count"] for r in slices(tx.filter("crypto_id = 1"), 20)) <= 10
    assert matches(X.fifo_matched_lots(tx, slice_rows=20)) == brute_force(rows)
