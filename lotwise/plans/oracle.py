"""The same results in DuckDB SQL over the given tables, written without a look at the Spark plans.

Tax lots are matched by comparing the intervals of every buy and every sale of an asset.
"""

from __future__ import annotations

from lotwise.plans.queries import (
    AS_OF, EARLIER_LOAD_UNTIL, END, LATE_FROM, LOGGED_AT, ONE_MONTH, STAKING_CLOSED, START, TARGET_ASSET,
)
from lotwise.vocabulary import INFLOW_TYPES, OUTFLOW_TYPES


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_IN, _OUT = _listed(INFLOW_TYPES), _listed(OUTFLOW_TYPES)

# --- the ledger tables, as in FIXTURES.md --------------------------------------------------------------------

_CTES = {
    "asset": """
        SELECT s_suppkey AS crypto_id, CASE s_suppkey WHEN 0 THEN 'BTC' ELSE 'S' || s_suppkey END AS symbol,
               s_name AS name
        FROM supplier""",
    "venue": """
        SELECT n_nationkey AS exchange_id, n_name AS name,
               CASE WHEN n_regionkey < 3 THEN 'EXCHANGE' WHEN n_regionkey = 3 THEN 'WALLET' ELSE 'OTHER' END
                 AS exchange_type
        FROM nation""",
    "kind": """
        SELECT r_regionkey AS category_id, r_name AS name, CAST(NULL AS VARCHAR) AS description FROM region""",
    "merged": """
        SELECT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS line,
               CAST((l_orderkey * 10 + l_linenumber) * 1000
                    + row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                         ORDER BY l_suppkey, l_shipdate, l_returnflag, l_linestatus, l_quantity,
                                                  l_extendedprice, l_tax) AS BIGINT) AS tx_id,
               l_suppkey AS crypto_id,
               CASE l_returnflag || l_linestatus
                 WHEN 'NF' THEN 'BUY' WHEN 'NO' THEN 'BUY' WHEN 'RO' THEN 'SELL' WHEN 'AF' THEN 'DEPOSIT'
                 WHEN 'AO' THEN 'STAKING_REWARD' WHEN 'RF' THEN 'WITHDRAWAL' ELSE l_returnflag || l_linestatus END AS tx_type,
               CAST(l_quantity AS DECIMAL(18,8)) AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,8)) AS price,
               CAST(l_shipdate AS TIMESTAMP) AS tx_timestamp,
               CAST(l_tax AS DECIMAL(10,4)) AS fee_usd
        FROM lineitem""",
    "tx": """
        SELECT m.tx_id, m.crypto_id,
               CASE WHEN m.l_linenumber <> 7 THEN c.c_nationkey END AS exchange_id,
               CASE WHEN m.l_linenumber <> 6 THEN n.n_regionkey END AS category_id,
               m.tx_type, m.quantity,
               CASE WHEN m.tx_type IN ('DEPOSIT', 'WITHDRAWAL') THEN NULL
                    WHEN m.line % 997 = 0 THEN CAST(0 AS DECIMAL(18,8)) ELSE m.price END AS price_per_unit_usd,
               m.tx_timestamp, m.fee_usd, CAST(NULL AS VARCHAR) AS notes
        FROM merged m
        LEFT JOIN orders o ON o.o_orderkey = m.l_orderkey
        LEFT JOIN customer c ON c.c_custkey = o.o_custkey
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "checked": """
        SELECT * FROM tx UNION ALL
        SELECT * FROM (VALUES
          (-1, -5, 0, 0, 'BUY', 1, 10, TIMESTAMP '2000-06-01', 0.1, 'unknown asset'),
          (-2, 0, -7, 1, 'SELL', 2, 11, TIMESTAMP '2000-06-02', 0.2, 'unknown venue'),
          (-3, 0, 1, -9, 'BUY', 3, 12, TIMESTAMP '2000-06-03', NULL, 'unknown category'),
          (-4, 0, 1, 1, 'BUY', 4, 13, TIMESTAMP '1950-01-01', 0.4, 'before any calendar'))""",
    "spoiled": """
        SELECT * FROM checked UNION ALL
        SELECT -6, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM range(2)""",
    "hp": """
        SELECT l_suppkey AS crypto_id, CAST(l_shipdate AS DATE) AS price_date,
               max(CAST(l_extendedprice AS DECIMAL(18,8))) AS close_price_usd
        FROM lineitem GROUP BY ALL""",
    "series": """
        SELECT hp.crypto_id * 1000000 + date_diff('day', DATE '1970-01-01', hp.price_date) AS price_id, hp.*,
               low AS open_price_usd, close_price_usd AS high_price_usd, low AS low_price_usd, volume_usd
        FROM hp JOIN (SELECT l_suppkey AS crypto_id, CAST(l_shipdate AS DATE) AS price_date,
                             min(CAST(l_extendedprice AS DECIMAL(18,8))) AS low,
                             CAST(sum(CAST(l_quantity AS DECIMAL(24,2))) AS DECIMAL(24,2)) AS volume_usd
                      FROM lineitem GROUP BY ALL) USING (crypto_id, price_date)""",
    # signed movements and what follows from them
    "flow": f"""
        SELECT crypto_id, CAST(tx_timestamp AS DATE) AS day,
               CASE WHEN tx_type IN ({_IN}) THEN quantity WHEN tx_type IN ({_OUT}) THEN -quantity END AS q
        FROM tx WHERE tx_type IN ({_IN}, {_OUT})""",
    "held": """
        SELECT crypto_id, sum(q) AS qty FROM flow GROUP BY crypto_id HAVING sum(q) > 0""",
    "newest": """
        SELECT crypto_id, arg_max(close_price_usd, price_date) AS price, max(price_date) AS day
        FROM hp GROUP BY crypto_id""",
    "valued": """
        SELECT a.symbol, a.name, h.qty, n.price,
               CAST(CAST(h.qty AS DECIMAL(38,8)) * CAST(n.price AS DECIMAL(38,8)) AS DECIMAL(38,11)) AS worth
        FROM held h JOIN asset a USING (crypto_id) LEFT JOIN newest n USING (crypto_id)""",
    # tax lots as intervals
    "lot": """
        SELECT crypto_id, tx_type, tx_id, tx_timestamp AS ts, quantity AS q, price_per_unit_usd AS p,
               sum(quantity) OVER (PARTITION BY crypto_id, tx_type ORDER BY tx_timestamp, tx_id
                                   ROWS UNBOUNDED PRECEDING) AS hi
        FROM tx WHERE tx_type IN ('BUY', 'SELL') AND quantity > 0 AND price_per_unit_usd IS NOT NULL""",
    "pair": """
        SELECT s.crypto_id, s.tx_id AS sell_id, s.ts AS sell_ts, s.p AS sell_p,
               b.tx_id AS buy_id, b.ts AS buy_ts, b.p AS buy_p,
               CAST(least(s.hi, b.hi) - greatest(s.hi - s.q, b.hi - b.q) AS DECIMAL(38,8)) AS q
        FROM lot s JOIN lot b ON s.crypto_id = b.crypto_id AND s.tx_type = 'SELL' AND b.tx_type = 'BUY'
         AND b.ts <= s.ts AND least(s.hi, b.hi) > greatest(s.hi - s.q, b.hi - b.q)""",
    "gain": """
        SELECT *, q * CAST(sell_p AS DECIMAL(38,8)) AS proceeds, q * CAST(buy_p AS DECIMAL(38,8)) AS cost FROM pair""",
    # star schema
    "cal": """
        SELECT CAST(d AS DATE) AS full_date,
               CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key
        FROM (SELECT unnest(generate_series(date_trunc('year', min(tx_timestamp)),
                                            date_trunc('year', max(tx_timestamp)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                            INTERVAL 1 DAY)) AS d FROM tx)""",
    "days": """
        SELECT date_key, full_date, CAST(year(full_date) AS INTEGER) AS year_actual,
               CAST(quarter(full_date) AS INTEGER) AS quarter_actual,
               CAST(month(full_date) AS INTEGER) AS month_actual, monthname(full_date) AS month_name,
               CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(isodow(full_date) AS INTEGER) AS day_of_week_iso,
               dayname(full_date) AS day_name, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year_iso,
               isodow(full_date) < 6 AS is_weekday, isodow(full_date) > 5 AS is_weekend
        FROM cal""",
    "asset_key": """
        SELECT crypto_id, symbol, name, row_number() OVER (ORDER BY crypto_id) AS crypto_key FROM asset""",
    "venue_key": """
        SELECT exchange_id, exchange_type, row_number() OVER (ORDER BY exchange_id) AS exchange_key FROM venue""",
    "kind_key": """
        SELECT category_id, row_number() OVER (ORDER BY category_id) AS category_key FROM kind""",
    "fact": """
        SELECT t.tx_id AS tx_id_original, CAST(strftime(t.tx_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
               strftime(t.tx_timestamp, '%H:%M:%S') AS time_of_day, a.crypto_key, v.exchange_key, k.category_key,
               t.tx_type, CAST(t.quantity AS DECIMAL(28,18)) AS quantity,
               CAST(t.price_per_unit_usd AS DECIMAL(24,8)) AS price_per_unit_usd,
               CAST(CAST(t.quantity AS DECIMAL(38,8)) * CAST(t.price_per_unit_usd AS DECIMAL(38,8)) AS DECIMAL(30,8))
                 AS transaction_value_usd,
               CAST(t.fee_usd AS DECIMAL(18,8)) AS fee_usd, t.tx_timestamp
        FROM tx t JOIN asset_key a USING (crypto_id) LEFT JOIN venue_key v USING (exchange_id)
        LEFT JOIN kind_key k USING (category_id)""",
    "checked_fact": """
        SELECT t.tx_id AS tx_id_original, c.date_key,
               strftime(t.tx_timestamp, '%H:%M:%S') AS time_of_day, a.crypto_key, v.exchange_key, k.category_key,
               t.tx_type, CAST(t.quantity AS DECIMAL(28,18)) AS quantity,
               CAST(t.price_per_unit_usd AS DECIMAL(24,8)) AS price_per_unit_usd,
               CAST(CAST(t.quantity AS DECIMAL(38,8)) * CAST(t.price_per_unit_usd AS DECIMAL(38,8)) AS DECIMAL(30,8))
                 AS transaction_value_usd,
               CAST(t.fee_usd AS DECIMAL(18,8)) AS fee_usd, t.exchange_id, t.category_id
        FROM checked t LEFT JOIN cal c ON c.full_date = CAST(t.tx_timestamp AS DATE)
        LEFT JOIN asset_key a USING (crypto_id) LEFT JOIN venue_key v USING (exchange_id)
        LEFT JOIN kind_key k USING (category_id)""",
    # change audit
    "before": f"SELECT * FROM tx WHERE tx_timestamp < TIMESTAMP '{LATE_FROM}'",
    "after": f"""
        SELECT * REPLACE (
            CASE WHEN exchange_id IS NULL AND tx_timestamp < TIMESTAMP '{LATE_FROM}' THEN 1.25 ELSE fee_usd END
              AS fee_usd,
            CASE WHEN exchange_id IS NULL AND tx_timestamp < TIMESTAMP '{LATE_FROM}' THEN 'venue unknown' END AS notes)
        FROM tx WHERE tx_type <> 'STAKING_REWARD' OR tx_timestamp >= TIMESTAMP '{STAKING_CLOSED}'""",
    "log": f"""
        SELECT row_number() OVER (ORDER BY tx_id) AS audit_id, *
        FROM (SELECT 'I' AS operation_type, tx.* FROM tx WHERE tx_timestamp >= TIMESTAMP '{LATE_FROM}'
              UNION ALL BY NAME
              SELECT CASE WHEN a.tx_id IS NULL THEN 'D' ELSE 'U' END AS operation_type, b.*
              FROM before b LEFT JOIN after a USING (tx_id) WHERE a.tx_id IS NULL OR b.exchange_id IS NULL)""",
}

_NEEDS = {
    "tx": ["merged"], "flow": ["tx"], "held": ["flow"], "newest": ["hp"], "series": ["hp"], "valued": ["held", "newest", "asset"],
    "lot": ["tx"], "pair": ["lot"], "gain": ["pair"], "cal": ["tx"], "days": ["cal"], "asset_key": ["asset"],
    "venue_key": ["venue"], "kind_key": ["kind"], "fact": ["tx", "asset_key", "venue_key", "kind_key"],
    "checked": ["tx"], "spoiled": ["checked"], "checked_fact": ["checked", "cal", "asset_key", "venue_key", "kind_key"],
    "before": ["tx"], "after": ["tx"], "log": ["tx", "before", "after"],
}


def _with(names: str, body: str) -> str:
    """Prefix the body with the named CTEs and those they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in order) + "\n" + body


# Rounds a double half up by its shortest decimal text, as Spark does; arithmetic on the binary value would
# differ on ties.
_R6 = "CAST(round(CAST(CAST(CAST({} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), 6) AS DOUBLE)".format


def _pct(a: str, b: str) -> str:
    """(b - a) / a in percent, two decimals."""
    return _R6(f"round((CAST({b} AS DOUBLE) - CAST({a} AS DOUBLE)) / nullif(CAST({a} AS DOUBLE), 0) * 100, 2)")


def _value(day: str, prices: str) -> str:
    """Portfolio value at the end of a day, with a relation of (crypto_id, close_price_usd)."""
    return f"""(SELECT CAST(coalesce(sum(CAST(q AS DECIMAL(38,8)) * CAST(coalesce(close_price_usd, 0) AS DECIMAL(38,8))), 0)
                        AS DECIMAL(38,11))
                FROM (SELECT crypto_id, sum(q) AS q FROM flow WHERE day <= {day} GROUP BY crypto_id HAVING sum(q) > 0)
                LEFT JOIN ({prices}) USING (crypto_id))"""


def _exact(day: str) -> str:
    return f"SELECT crypto_id, close_price_usd FROM hp WHERE price_date = {day}"


def _asof(day: str) -> str:
    return f"SELECT crypto_id, arg_max(close_price_usd, price_date) AS close_price_usd FROM hp WHERE price_date <= {day} GROUP BY crypto_id"


_D0, _D1 = f"DATE '{START}'", f"DATE '{END}'"
_TODAY = f"DATE '{AS_OF}'"
_YESTERDAY = f"CAST({_TODAY} - INTERVAL 1 DAY AS DATE)"

_HISTORICAL = f"""
    FROM asset a JOIN (SELECT crypto_id, sum(q) AS qty FROM flow WHERE day <= {_TODAY} GROUP BY crypto_id) USING (crypto_id)
    WHERE qty > 0"""
_HOLDINGS_FN = _with(
    "flow asset",
    f"SELECT a.crypto_id, a.symbol, a.name, CAST(qty AS DECIMAL(28,18)) AS historical_holding_quantity {_HISTORICAL}",
)
_VALUE_FN = _with(
    "flow hp", f"SELECT CAST({_value(_TODAY, _exact(_TODAY))} AS DECIMAL(30,2)) AS portfolio_value_usd"
)
_MV = _with(
    "held asset",
    "SELECT crypto_id, symbol, name, CAST(qty AS DECIMAL(28,18)) AS current_holding_quantity FROM asset JOIN held USING (crypto_id)",
)


def _holdings() -> dict[str, str]:
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {cte}"
        for name, cte in (
            ("cryptocurrencies", "asset"), ("exchanges", "venue"), ("transaction_categories", "kind"),
            ("transactions", "tx"), ("historical_prices", "hp"),
        )
    )
    v0, v1 = "v.v0", "v.v1"
    return {
        "table_row_counts": _with("asset venue kind tx hp", counts),
        "current_holdings": _with(
            "held asset", "SELECT crypto_id, symbol, name, qty AS current_holding_quantity FROM asset JOIN held USING (crypto_id)"
        ),
        "historical_holdings_by_date": _with(
            "flow asset",
            f"SELECT {_TODAY} AS target_date, a.crypto_id, a.symbol, a.name, qty AS historical_holding_quantity {_HISTORICAL}",
        ),
        "get_historical_holdings": _HOLDINGS_FN,
        "get_historical_holdings_sql": _HOLDINGS_FN,
        "holdings_net": _with("held", "SELECT crypto_id, qty AS holding_quantity FROM held"),
        "holdings_at_dates": _with(
            "flow",
            f"""SELECT eval_date, crypto_id, sum(q) AS holding_quantity
                FROM flow JOIN (SELECT unnest([{_D0}, DATE '2000-12-31', {_D1}]) AS eval_date) ON day <= eval_date
                GROUP BY ALL HAVING sum(q) > 0""",
        ),
        "latest_prices": _with("newest", "SELECT crypto_id, price AS current_price_usd FROM newest"),
        "prices_on_date": _with("hp", _exact(_TODAY)),
        "prices_as_of": _with("hp", _asof(_TODAY)),
        "current_portfolio_value": _with("valued", "SELECT sum(worth) AS total_portfolio_value_usd FROM valued"),
        "portfolio_value_breakdown": _with(
            "valued",
            "SELECT symbol, name, qty AS holding_quantity, price AS current_price_usd, worth AS current_market_value_usd FROM valued",
        ),
        "current_asset_allocation": _with(
            "valued",
            f"""SELECT symbol, name, qty AS holding_quantity, coalesce(price, 0) AS current_price_usd,
                       coalesce(worth, 0) AS current_market_value_usd,
                       coalesce({_R6("round(CAST(coalesce(worth, 0) AS DOUBLE) / nullif(CAST(sum(worth) OVER () AS DOUBLE), 0) * 100, 2)")}, 0)
                         AS allocation_percentage
                FROM valued""",
        ),
        "portfolio_value_change_daily": _with(
            "flow hp",
            f"""SELECT {v1} AS current_portfolio_value, {v0} AS yesterday_portfolio_value,
                       {v1} - {v0} AS absolute_change_usd, {_pct(v0, v1)} AS percentage_change
                FROM (SELECT {_value(_YESTERDAY, _exact(_YESTERDAY))} AS v0,
                             {_value("DATE '9999-01-01'", _asof("DATE '9999-01-01'"))} AS v1) v""",
        ),
        "portfolio_value_change_between_dates": _with(
            "flow hp",
            f"""SELECT {_D0} AS start_date, {_D1} AS end_date, {v0} AS portfolio_value_at_start_date,
                       {v1} AS portfolio_value_at_end_date, {v1} - {v0} AS absolute_change_usd,
                       {_pct(v0, v1)} AS percentage_change
                FROM (SELECT {_value(_D0, _exact(_D0))} AS v0, {_value(_D1, _exact(_D1))} AS v1) v""",
        ),
        "get_portfolio_value_at_date": _VALUE_FN,
        "get_portfolio_value_at_date_sql": _VALUE_FN,
        "portfolio_vs_btc_benchmark": _with(
            "flow hp",
            f"""SELECT {_D0} AS start_date, {_D1} AS end_date, v0 AS portfolio_start_value, v1 AS portfolio_end_value,
                       v1 - v0 AS portfolio_absolute_gain_loss, {_pct("v0", "v1")} AS portfolio_percentage_growth,
                       v0 AS btc_hypothetical_initial_investment, p0 AS btc_price_start, p1 AS btc_price_end,
                       {_R6("units")} AS btc_units_hypothetically_bought,
                       {_R6("units * CAST(p1 AS DOUBLE)")} AS btc_hypothetical_end_value,
                       {_R6("units * CAST(p1 AS DOUBLE) - CAST(v0 AS DOUBLE)")} AS btc_hypothetical_absolute_gain_loss,
                       {_pct("v0", "(units * CAST(p1 AS DOUBLE))")} AS btc_hypothetical_percentage_growth,
                       {_R6(f"{_pct('v0', 'v1')} - {_pct('v0', '(units * CAST(p1 AS DOUBLE))')}")}
                         AS outperformance_vs_btc_pct_points
                FROM (SELECT *, CAST(v0 AS DOUBLE) / nullif(CAST(p0 AS DOUBLE), 0) AS units
                      FROM (SELECT {_value(_D0, _exact(_D0))} AS v0, {_value(_D1, _asof(_D1))} AS v1,
                                   (SELECT close_price_usd FROM ({_exact(_D0)}) WHERE crypto_id = {TARGET_ASSET}) AS p0,
                                   (SELECT close_price_usd FROM ({_asof(_D1)}) WHERE crypto_id = {TARGET_ASSET}) AS p1))""",
        ),
    }


_N = "CAST(count(*) {} AS BIGINT)".format
_BUYS, _SELLS = _N("FILTER (tx_type = 'BUY')"), _N("FILTER (tx_type = 'SELL')")
_OTHERS = _N("FILTER (tx_type NOT IN ('BUY', 'SELL'))")
_WORTH = "CAST(quantity AS DECIMAL(38,8)) * CAST(price_per_unit_usd AS DECIMAL(38,8))"


def _statistics() -> dict[str, str]:
    def spent(kind: str) -> str:
        return f"CAST(coalesce(sum({_WORTH}) FILTER (tx_type = '{kind}'), 0) AS DECIMAL(38,16))"

    return {
        "transaction_frequency_by_month": _with(
            "tx",
            f"""SELECT strftime(tx_timestamp, '%Y-%m') AS year_month, {_N("")} AS total_transactions_in_month,
                       {_BUYS} AS buy_transactions, {_SELLS} AS sell_transactions, {_OTHERS} AS other_transactions
                FROM tx GROUP BY 1""",
        ),
        "average_purchase_price_by_asset": _with(
            "tx asset",
            f"""SELECT crypto_id, symbol, name, sum(quantity) AS total_quantity_purchased,
                       sum({_WORTH}) AS total_cost_of_purchases_usd,
                       {_R6(f"CAST(sum({_WORTH}) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE)")}
                         AS weighted_average_purchase_price_usd
                FROM tx JOIN asset USING (crypto_id)
                WHERE tx_type = 'BUY' AND price_per_unit_usd IS NOT NULL AND quantity > 0 GROUP BY 1, 2, 3""",
        ),
        "transaction_analysis_by_exchange": _with(
            "tx venue",
            f"""SELECT v.name AS exchange_name, {_N("")} AS total_transactions, {_BUYS} AS count_buy_transactions,
                       {_SELLS} AS count_sell_transactions, {_OTHERS} AS count_other_transactions,
                       {spent("BUY")} AS total_buy_value_usd, {spent("SELL")} AS total_sell_value_usd
                FROM tx JOIN venue v USING (exchange_id) GROUP BY v.name""",
        ),
        "transaction_value_distribution": _with(
            "tx",
            f"""SELECT (['000 - $0 - $100', '001 - $101 - $500', '002 - $501 - $1,000', '003 - $1,001 - $5,000',
                         '004 - $5,001 - $10,000', '005 - > $10,000'])
                       [1 + (w > 100)::INT + (w > 500)::INT + (w > 1000)::INT + (w > 5000)::INT + (w > 10000)::INT]
                         AS value_range,
                       {_BUYS} AS count_buy_transactions, {_SELLS} AS count_sell_transactions
                FROM (SELECT tx_type, {_WORTH} AS w FROM tx WHERE tx_type IN ('BUY', 'SELL')) WHERE w > 0 GROUP BY 1""",
        ),
        "fee_by_exchange": _with(
            "tx venue",
            f"""SELECT name AS exchange_name, {_N("")} AS total_transactions_with_fees_on_exchange,
                       sum(fee_usd) AS total_fees_paid_usd_on_exchange
                FROM tx JOIN venue USING (exchange_id) WHERE fee_usd > 0 GROUP BY 1""",
        ),
        "fee_by_asset": _with(
            "tx asset",
            f"""SELECT symbol AS crypto_symbol, name AS crypto_name, {_N("")} AS total_transactions_with_fees_for_asset,
                       sum(fee_usd) AS total_fees_paid_usd_for_asset_transactions
                FROM tx JOIN asset USING (crypto_id) WHERE fee_usd > 0 GROUP BY 1, 2""",
        ),
        "transactions_per_month": _with(
            "tx",
            f"SELECT strftime(tx_timestamp, '%Y-%m') AS transaction_year_month, {_N('')} AS total_transactions FROM tx GROUP BY 1",
        ),
        "most_active_cryptos": _with(
            "tx asset",
            f"SELECT symbol, name, {_N('')} AS total_transaction_count FROM tx JOIN asset USING (crypto_id) GROUP BY crypto_id, 1, 2",
        ),
        "price_range_check": _with(
            "hp asset",
            f"""SELECT symbol, name, d0 AS first_date, p0 AS first_price_usd, d1 AS last_date, p1 AS last_price_usd,
                       {_pct("p0", "p1")} AS percentage_change
                FROM (SELECT crypto_id, min(price_date) AS d0, arg_min(close_price_usd, price_date) AS p0,
                             max(price_date) AS d1, arg_max(close_price_usd, price_date) AS p1
                      FROM hp GROUP BY 1) JOIN asset USING (crypto_id)""",
        ),
    }


def _indicators() -> dict[str, str]:
    close = "CAST(close_price_usd AS DOUBLE)"
    step = """SELECT *, close_price_usd - coalesce(lag(close_price_usd) OVER w, close_price_usd) AS price_diff,
                     row_number() OVER w AS nth
              FROM hp WINDOW w AS (PARTITION BY crypto_id ORDER BY price_date)"""
    back = f"""SELECT crypto_id, price_date, close_price_usd, prev AS prev_day_close_price_usd,
                      CAST(close_price_usd - prev AS DOUBLE) / nullif(CAST(prev AS DOUBLE), 0) AS r
               FROM (SELECT *, lag(close_price_usd) OVER (PARTITION BY crypto_id ORDER BY price_date) AS prev FROM hp)"""

    def sma(n: int) -> str:
        return f"CASE WHEN count(*) OVER w{n} = {n} THEN {_R6(f'sum(close_price_usd) OVER w{n} / {n}')} END AS sma_{n}_day"

    return {
        "moving_averages": _with(
            "hp asset",
            f"""SELECT symbol, name, price_date, close_price_usd, {sma(7)}, {sma(30)} FROM hp JOIN asset USING (crypto_id)
                WINDOW w7 AS (PARTITION BY crypto_id ORDER BY price_date ROWS 6 PRECEDING),
                       w30 AS (PARTITION BY crypto_id ORDER BY price_date ROWS 29 PRECEDING)""",
        ),
        "rsi_14": _with(
            "hp asset",
            f"""SELECT symbol, name, price_date, close_price_usd, price_diff, greatest(price_diff, 0) AS gain,
                       greatest(-price_diff, 0) AS loss, {_R6("up")} AS avg_gain_14, {_R6("down")} AS avg_loss_14,
                       {_R6("up / nullif(down, 0)")} AS rs_14,
                       {_R6("CASE WHEN down = 0 THEN 100 ELSE round(100 - 100 / (1 + up / nullif(down, 0)), 2) END")} AS rsi_14
                FROM (SELECT *, CAST(sum(greatest(price_diff, 0)) OVER f AS DOUBLE) / 14 AS up,
                             CAST(sum(greatest(-price_diff, 0)) OVER f AS DOUBLE) / 14 AS down
                      FROM ({step}) WINDOW f AS (PARTITION BY crypto_id ORDER BY price_date ROWS 13 PRECEDING))
                JOIN asset USING (crypto_id) WHERE nth >= 14""",
        ),
        "price_correlation_with_btc": _with(
            "hp asset",
            f"""SELECT a.symbol AS asset_symbol, {_N("")} AS common_data_points_with_btc,
                       {_R6(f"round(corr(CAST(x.close_price_usd AS DOUBLE), CAST(b.close_price_usd AS DOUBLE)), 4)")} AS correlation_with_btc
                FROM hp x JOIN asset a USING (crypto_id)
                JOIN hp b ON b.price_date = x.price_date AND b.crypto_id IN (SELECT crypto_id FROM asset WHERE symbol = 'BTC')
                WHERE a.symbol <> 'BTC' GROUP BY x.crypto_id, a.symbol HAVING count(*) > 30""",
        ),
        "price_volatility_30day": _with(
            "hp asset",
            f"""SELECT symbol, price_date, close_price_usd, {_R6("r")} AS daily_pct_return,
                       CASE WHEN count(*) OVER f >= 30 THEN {_R6("stddev_samp(r) OVER f")} END AS volatility_30day_stddev_returns
                FROM ({back}) JOIN asset USING (crypto_id) WHERE r IS NOT NULL
                WINDOW f AS (PARTITION BY crypto_id ORDER BY price_date ROWS 29 PRECEDING)""",
        ),
        "daily_returns": _with(
            "hp asset",
            f"""SELECT crypto_id, symbol, price_date, close_price_usd, prev_day_close_price_usd, {_R6("r")} AS daily_pct_return
                FROM ({back}) JOIN asset USING (crypto_id)""",
        ),
        "price_changes": _with(
            "hp asset",
            f"""SELECT crypto_id, symbol, name, price_date, close_price_usd, price_diff, greatest(price_diff, 0) AS gain,
                       greatest(-price_diff, 0) AS loss
                FROM ({step}) JOIN asset USING (crypto_id)""",
        ),
    }


def _tax_lots() -> dict[str, str]:
    one = f"WHERE crypto_id = {TARGET_ASSET}"

    def per_sale(where: str) -> str:
        return _with(
            "gain asset",
            f"""SELECT sell_id AS sell_tx_id, symbol, sell_ts AS sell_timestamp, sum(q) AS total_quantity_sold_in_sale,
                       sum(proceeds) AS total_proceeds_for_sale, sum(cost) AS total_cost_basis_for_sale,
                       sum(proceeds - cost) AS total_realized_gain_loss_for_sale
                FROM gain JOIN asset USING (crypto_id) {where} GROUP BY 1, 2, 3""",
        )

    def annual(where: str) -> str:
        return _with(
            "gain asset",
            f"""SELECT symbol, CAST(year(sell_ts) AS INTEGER) AS tax_year, sum(proceeds - cost) AS annual_realized_gain_loss_usd
                FROM gain JOIN asset USING (crypto_id) {where} GROUP BY 1, 2""",
        )

    return {
        "fifo_buys": _with(
            "lot",
            """SELECT crypto_id, tx_id AS buy_tx_id, ts AS buy_timestamp, q AS buy_quantity, p AS buy_price_usd,
                      hi AS cumulative_buy_quantity FROM lot WHERE tx_type = 'BUY'""",
        ),
        "fifo_sells": _with(
            "lot",
            """SELECT crypto_id, tx_id AS sell_tx_id, ts AS sell_timestamp, q AS sell_quantity, p AS sell_price_usd,
                      hi AS cumulative_sell_quantity, hi - q AS prev_cumulative_sell_quantity
               FROM lot WHERE tx_type = 'SELL'""",
        ),
        "fifo_matched_lots": _with(
            "pair",
            """SELECT crypto_id, sell_id AS sell_tx_id, sell_ts AS sell_timestamp, sell_p AS sell_price_usd,
                      buy_id AS buy_tx_id, buy_ts AS buy_timestamp, buy_p AS buy_price_usd,
                      q AS quantity_sold_from_this_buy FROM pair""",
        ),
        "fifo_realized_single_asset": _with(
            "gain asset",
            f"""SELECT sell_id AS sell_tx_id, symbol, sell_ts AS sell_timestamp, q AS quantity_sold, sell_p AS sell_price_usd,
                       buy_id AS matched_buy_lot_tx_id, buy_ts AS matched_buy_lot_timestamp, buy_p AS cost_basis_per_unit,
                       proceeds AS proceeds_from_this_lot_portion, cost AS cost_of_this_lot_portion,
                       proceeds - cost AS realized_gain_loss_usd
                FROM gain JOIN asset USING (crypto_id) {one}""",
        ),
        "fifo_summary_per_sale_single_asset": per_sale(one),
        "fifo_annual_single_asset": annual(one),
        "fifo_summary_per_sale_all_assets": per_sale(""),
        "fifo_annual_all_assets": annual(""),
        "tax_lot_inventory_current": _with(
            "lot pair asset",
            """SELECT l.tx_id AS buy_tx_id, symbol, l.ts AS buy_timestamp, l.q AS original_buy_quantity,
                      l.p AS purchase_price_per_unit_usd, coalesce(u.q, 0) AS quantity_sold_from_this_lot,
                      CAST(l.q - coalesce(u.q, 0) AS DECIMAL(28,8)) AS remaining_quantity_in_lot
               FROM lot l JOIN asset USING (crypto_id)
               LEFT JOIN (SELECT buy_id, sum(q) AS q FROM pair GROUP BY 1) u ON u.buy_id = l.tx_id
               WHERE l.tx_type = 'BUY' AND l.q > coalesce(u.q, 0)""",
        ),
        "buy_lot_consumption": _with(
            "pair", "SELECT crypto_id, buy_id AS buy_tx_id, sum(q) AS total_quantity_consumed FROM pair GROUP BY 1, 2"
        ),
    }


def _quality() -> dict[str, str]:
    references = " UNION ALL ".join(
        f"""SELECT 'reference {table}({key})' AS rule, CAST({key} AS VARCHAR) AS key, CAST(count(*) AS BIGINT) AS n
            FROM {cte} WHERE {key} NOT IN (SELECT {key} FROM {dim}) GROUP BY {key}"""
        for table, cte, dim, key in (
            ("transactions", "spoiled", "asset", "crypto_id"), ("transactions", "spoiled", "venue", "exchange_id"),
            ("transactions", "spoiled", "kind", "category_id"), ("historical_prices", "hp", "asset", "crypto_id"),
        )
    )
    keys = (
        ("cryptocurrencies", "asset", "crypto_id"), ("cryptocurrencies", "asset", "symbol"), ("exchanges", "venue", "exchange_id"),
        ("exchanges", "venue", "name"), ("transaction_categories", "kind", "category_id"),
        ("transaction_categories", "kind", "name"), ("transactions", "spoiled", "tx_id"),
    )
    unique = " UNION ALL ".join(
        f"""SELECT 'unique {table}({key})', CAST({key} AS VARCHAR), CAST(count(*) AS BIGINT) FROM {cte}
            WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"""
        for table, cte, key in keys
    )
    needed = [(t, c, k) for t, c, k in keys] + [("exchanges", "venue", "exchange_type")] + [
        ("transactions", "spoiled", k) for k in ("crypto_id", "tx_type", "quantity", "tx_timestamp")
    ]
    not_null = " UNION ALL ".join(
        f"""SELECT 'not null {table}({key})', CAST(NULL AS VARCHAR), CAST(count(*) AS BIGINT) FROM {cte}
            WHERE {key} IS NULL HAVING count(*) > 0"""
        for table, cte, key in needed
    )
    lengths = " UNION ALL ".join(
        f"""SELECT 'length {table}({key})', {key}, CAST(count(*) AS BIGINT) FROM {cte} WHERE length({key}) > {n} GROUP BY {key}"""
        for table, cte, key, n in (
            ("cryptocurrencies", "asset", "symbol", 10), ("cryptocurrencies", "asset", "name", 100),
            ("exchanges", "venue", "name", 100), ("transaction_categories", "kind", "name", 50),
            ("transactions", "spoiled", "tx_type", 20),
        )
    )
    return {
        "dq_missing_or_zero_price": _with(
            "tx asset",
            """SELECT tx_id, tx_type, symbol, tx_timestamp, quantity, price_per_unit_usd, notes
               FROM tx JOIN asset USING (crypto_id)
               WHERE tx_type IN ('BUY', 'SELL', 'FEE_PAYMENT') AND coalesce(price_per_unit_usd, 0) <= 0""",
        ),
        "dq_outlier_value": _with(
            "tx asset",
            f"""SELECT tx_id, tx_type, symbol, tx_timestamp, w AS transaction_value_usd, notes
                FROM (SELECT *, {_WORTH} AS w FROM tx) JOIN asset USING (crypto_id)
                WHERE w > 1000000 OR (w > 0 AND w < 0.01)""",
        ),
        "dq_orphan_crypto": _with(
            "checked asset",
            """SELECT DISTINCT crypto_id AS missing_crypto_id_in_transactions FROM checked
               WHERE crypto_id NOT IN (SELECT crypto_id FROM asset)""",
        ),
        "dq_orphan_exchange": _with(
            "checked venue",
            """SELECT DISTINCT exchange_id AS missing_exchange_id_in_transactions FROM checked
               WHERE exchange_id NOT IN (SELECT exchange_id FROM venue)""",
        ),
        "dq_stale_prices": _with(
            "held newest asset",
            """SELECT symbol, name, qty AS holding_quantity, day AS last_price_update
               FROM held JOIN asset USING (crypto_id) LEFT JOIN newest USING (crypto_id)
               WHERE day IS NULL OR day < DATE '2001-10-25'""",
        ),
        "dq_price_gaps": _with(
            "hp asset",
            """SELECT symbol, missing_price_date
               FROM (SELECT crypto_id, CAST(unnest(generate_series(min(price_date), max(price_date), INTERVAL 1 DAY)) AS DATE)
                              AS missing_price_date FROM hp GROUP BY crypto_id) x
               ANTI JOIN hp ON hp.crypto_id = x.crypto_id AND hp.price_date = x.missing_price_date
               JOIN asset ON asset.crypto_id = x.crypto_id""",
        ),
        "dq_constraint_violations": _with(
            "spoiled asset venue kind hp",
            f"""{references} UNION ALL {unique} UNION ALL {not_null} UNION ALL {lengths} UNION ALL
                SELECT 'check transactions(tx_type)', tx_type, CAST(count(*) AS BIGINT) FROM spoiled
                WHERE tx_type NOT IN ('BUY', 'SELL', 'DEPOSIT', 'WITHDRAWAL') GROUP BY tx_type""",
        ),
        "dq_unmapped_dates": _with(
            "checked cal",
            "SELECT tx_id, tx_timestamp FROM checked WHERE CAST(tx_timestamp AS DATE) NOT IN (SELECT full_date FROM cal)",
        ),
    }


def _warehouse() -> dict[str, str]:
    fact_columns = """tx_id_original, date_key, time_of_day, crypto_key, exchange_key, category_key, tx_type, quantity,
                      price_per_unit_usd, transaction_value_usd, fee_usd"""

    def side(kind: str) -> tuple[str, str, str]:
        f = f"FILTER (tx_type = '{kind}')"
        return (
            f"CAST(coalesce(sum(CAST(quantity AS DECIMAL(38,18))) {f}, 0) AS DECIMAL(38,18))",
            f"CAST(coalesce(sum(CAST(transaction_value_usd AS DECIMAL(38,8))) {f}, 0) AS DECIMAL(38,8))",
            _N(f),
        )

    (bq, bv, bn), (sq, sv, sn) = side("BUY"), side("SELL")

    def mean(value: str, quantity: str) -> str:
        return _R6(f"CAST({value} AS DOUBLE) / nullif(CAST({quantity} AS DOUBLE), 0)")

    def monthly(where: str) -> str:
        return _with(
            "fact asset_key",
            f"""SELECT strftime(tx_timestamp, '%Y-%m') AS year_month, symbol AS crypto_symbol, name AS crypto_name,
                       {bq} AS total_buy_quantity, {bv} AS total_buy_value_usd, {bn} AS number_of_buy_transactions,
                       {mean(bv, bq)} AS average_buy_price_usd,
                       {sq} AS total_sell_quantity, {sv} AS total_sell_value_usd, {sn} AS number_of_sell_transactions,
                       {mean(sv, sq)} AS average_sell_price_usd,
                       {bq} - {sq} AS net_quantity_transacted_this_month,
                       {bv} - {sv} AS net_value_transacted_this_month_usd,
                       CAST(coalesce(sum(fee_usd), 0) AS DECIMAL(38,8)) AS total_fees_paid_for_asset_this_month_usd
                FROM fact JOIN asset_key USING (crypto_key) WHERE {where} GROUP BY 1, 2, 3""",
        )

    star_counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {cte}"
        for name, cte in (
            ("fact_transactions", "fact"), ("dim_date", "cal"), ("dim_cryptocurrency", "asset"),
            ("dim_exchange", "venue"), ("dim_transaction_category", "kind"),
        )
    )
    null_checks = " UNION ALL ".join(
        f"SELECT 'null_{key}' AS check_name, CAST({n} AS BIGINT) AS row_count"
        for key, n in (
            ("date_key", "(SELECT count(*) FROM kept WHERE date_key IS NULL)"),
            ("crypto_key", "(SELECT count(*) FROM kept WHERE crypto_key IS NULL)"),
            ("category_key", "(SELECT count(*) FROM kept WHERE category_key IS NULL AND category_id IS NOT NULL)"),
            ("exchange_key", "(SELECT count(*) FROM kept WHERE exchange_key IS NULL AND exchange_id IS NOT NULL)"),
        )
    )
    next_keys = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(max({key}) + 1 AS BIGINT) AS next_key FROM {cte}"
        for name, key, cte in (
            ("cryptocurrencies", "crypto_id", "asset"), ("exchanges", "exchange_id", "venue"),
            ("transaction_categories", "category_id", "kind"), ("transactions", "tx_id", "tx"),
        )
    )
    return {
        "mv_current_holdings": _MV,
        "read_mv_current_holdings": _with(
            "flow asset",
            f"""SELECT crypto_id, symbol, name, CAST(sum(q) AS DECIMAL(28,18)) AS current_holding_quantity
                FROM flow JOIN asset USING (crypto_id) WHERE day < DATE '{LATE_FROM}' GROUP BY 1, 2, 3 HAVING sum(q) > 0""",
        ),
        "refresh_mv_current_holdings": _with(
            "after asset",
            f"""SELECT crypto_id, symbol, name,
                       CAST(sum(CASE WHEN tx_type IN ({_IN}) THEN quantity ELSE -quantity END) AS DECIMAL(28,18)) AS current_holding_quantity
                FROM after JOIN asset USING (crypto_id) WHERE tx_type IN ({_IN}, {_OUT})
                GROUP BY 1, 2, 3 HAVING current_holding_quantity > 0""",
        ),
        # The earlier load had no fees.
        "refresh_monthly_summary": monthly("TRUE").replace(
            "sum(fee_usd)", f"sum(CASE WHEN tx_timestamp >= TIMESTAMP '{EARLIER_LOAD_UNTIL}' THEN fee_usd END)"
        ),
        "build_dim_date": _with("days", "SELECT * FROM days"),
        "insert_only_load": _with(
            "days",
            f"""SELECT * REPLACE (CASE WHEN full_date < DATE '{EARLIER_LOAD_UNTIL}' THEN upper(day_name) ELSE day_name END AS day_name)
                FROM days""",
        ),
        "upsert_dim_cryptocurrency": _with(
            "asset",
            """SELECT row_number() OVER (ORDER BY symbol >= 'S5', crypto_id) AS crypto_key, crypto_id AS crypto_id_original,
                      symbol, name, FALSE AS is_stablecoin FROM asset""",
        ),
        "upsert_dim_exchange": _with(
            "venue",
            """SELECT row_number() OVER (ORDER BY exchange_type <> 'WALLET', exchange_id) AS exchange_key,
                      exchange_id AS exchange_id_original, name AS exchange_name, exchange_type FROM venue""",
        ),
        "upsert_dim_transaction_category": _with(
            "kind",
            """SELECT row_number() OVER (ORDER BY name <= 'B', category_id) AS category_key,
                      category_id AS category_id_original, name AS category_name, description AS category_description
               FROM kind""",
        ),
        "build_fact_transactions": _with(
            "checked_fact",
            f"""SELECT row_number() OVER (ORDER BY tx_id_original) AS transaction_key, {fact_columns} FROM checked_fact
                WHERE date_key IS NOT NULL AND crypto_key IS NOT NULL""",
        ),
        "upsert_fact_transactions": _with(
            "fact",
            f"""SELECT row_number() OVER (ORDER BY tx_timestamp >= TIMESTAMP '{EARLIER_LOAD_UNTIL}', tx_id_original)
                         AS transaction_key, {fact_columns} FROM fact""",
        ),
        "fact_rejects": _with(
            "checked_fact",
            """SELECT tx_id_original AS tx_id,
                      CASE WHEN date_key IS NULL THEN 'date outside calendar' ELSE 'unknown asset' END AS reason
               FROM checked_fact WHERE date_key IS NULL OR crypto_key IS NULL""",
        ),
        "view_monthly_crypto_transaction_summary": monthly("TRUE"),
        "monthly_summary_of_asset": monthly(f"symbol = '{'BTC' if TARGET_ASSET == 0 else f'S{TARGET_ASSET}'}'"),
        "monthly_summary_of_month": monthly(f"strftime(tx_timestamp, '%Y-%m') = '{ONE_MONTH[0][:7]}'"),
        "verify_star_counts": _with("fact cal asset venue kind", star_counts),
        "verify_star_null_keys": _with("checked_fact", null_checks.replace("kept", "(SELECT * FROM checked_fact WHERE date_key IS NOT NULL AND crypto_key IS NOT NULL)")),
        "value_by_symbol_year": _with(
            "fact asset_key",
            """SELECT symbol AS crypto_symbol, CAST(date_key // 10000 AS INTEGER) AS transaction_year,
                      CAST(sum(CAST(transaction_value_usd AS DECIMAL(38,8))) AS DECIMAL(38,8)) AS total_value_transacted_usd
               FROM fact JOIN asset_key USING (crypto_key) WHERE tx_type IN ('BUY', 'SELL') GROUP BY 1, 2""",
        ),
        "assign_surrogate_keys": _with("tx", "SELECT tx_id, row_number() OVER (ORDER BY tx_id) AS ledger_key FROM tx"),
        "next_keys": _with("asset venue kind tx", next_keys),
    }


def _audit() -> dict[str, str]:
    stamp = f"TIMESTAMP '{LOGGED_AT}'"
    image = """tx_id, crypto_id, exchange_id, category_id, tx_type, CAST(quantity AS DECIMAL(28,18)) AS quantity,
               CAST(price_per_unit_usd AS DECIMAL(24,8)) AS price_per_unit_usd, tx_timestamp,
               CAST(fee_usd AS DECIMAL(18,8)) AS fee_usd, notes"""
    entries = f"SELECT audit_id, operation_type, {stamp} AS operation_timestamp, {image} FROM log"
    return {
        "load_ledger_csv": _with(
            "tx",
            """SELECT * REPLACE (CASE WHEN tx_type <> 'WITHDRAWAL' THEN tx_timestamp END AS tx_timestamp),
                      CASE WHEN tx_type = 'WITHDRAWAL'
                           THEN 'tx_timestamp: ' || strftime(tx_timestamp, '%Y-%m-') || '00 00:00:00' ELSE '' END AS reason
               FROM tx""",
        ),
        **{
            f"load_{table}_csv": _with(cte, f"SELECT *, '' AS reason FROM {cte}")
            for table, cte in (
                ("cryptocurrencies", "asset"), ("exchanges", "venue"), ("transaction_categories", "kind"),
                ("historical_prices", "series"),
            )
        },
        "insert_with_new_ids": _with(
            "tx",
            f"""SELECT CASE WHEN tx_timestamp < TIMESTAMP '{LATE_FROM}' THEN tx_id
                           ELSE max(tx_id) FILTER (tx_timestamp < TIMESTAMP '{LATE_FROM}') OVER ()
                                + row_number() OVER (PARTITION BY tx_timestamp < TIMESTAMP '{LATE_FROM}' ORDER BY tx_id) END AS tx_id,
                       crypto_id, tx_type, quantity, price_per_unit_usd, tx_timestamp, fee_usd, notes FROM tx""",
        ),
        "ledger_edits": _with(
            "after", "SELECT * REPLACE (CAST(fee_usd AS DECIMAL(10,4)) AS fee_usd) FROM after"
        ),
        "audit_changes": _with("log", entries),
        "recent_audit": _with("log", f"{entries} ORDER BY audit_id DESC LIMIT 5"),
        "audit_stream": _with("log", f"SELECT operation_type, {stamp} AS operation_timestamp, {image} FROM log"),
    }


def all_oracles() -> dict[str, str]:
    return _holdings() | _statistics() | _indicators() | _tax_lots() | _quality() | _warehouse() | _audit()
