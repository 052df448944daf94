"""Asset-ledger analytics as Spark jobs: holdings, valuation, indicators, tax lots, warehouse, audit."""
