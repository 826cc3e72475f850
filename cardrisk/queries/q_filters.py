"""Filters and searches (2.B) with their oracle SQL."""

from __future__ import annotations

from cardrisk import fixtures as fx
from cardrisk.operators import aggregates as agg
from cardrisk.operators import filters as flt
from cardrisk.queries.registry import out, register

LATEST3 = "days AS (SELECT DISTINCT CAST(TX_DATETIME AS DATE) AS d FROM tx ORDER BY d DESC LIMIT 3)"


@register("filter_min_day", "SELECT * FROM tx WHERE TX_TIME_DAYS >= 7")
def filter_min_day(spark, sf):
    return out(flt.filter_min_day(fx.tx(spark, sf), 7))


@register(
    "filter_date_range",
    "SELECT * FROM tx WHERE CAST(TX_DATETIME AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
)
def filter_date_range(spark, sf):
    return out(flt.filter_date_range(fx.tx(spark, sf), "2024-01-10", "2024-01-20"))


@register(
    "search_transactions",
    f"WITH {LATEST3}\n"
    "SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT,\n"
    "  CASE WHEN TX_FRAUD = 1 THEN 'red' ELSE 'green' END AS STATUS\n"
    "FROM tx WHERE TX_DATETIME IS NOT NULL AND TX_AMOUNT >= 10 AND TX_AMOUNT <= 500\n"
    "  AND CAST(TX_DATETIME AS DATE) IN (SELECT d FROM days) AND TX_FRAUD = 1\n"
    "  AND regexp_matches(CAST(CUSTOMER_ID AS VARCHAR), '1')\n"
    "  AND regexp_matches(CAST(TERMINAL_ID AS VARCHAR), '^[1-5]')",
)
def search_transactions(spark, sf):
    d = flt.search_transactions(
        fx.tx(spark, sf), amount_min=10, amount_max=500, status="fraud", customer_pattern="1", terminal_pattern="^[1-5]"
    )
    return out(flt.search_view(d))


@register(
    "search_summary",
    f"WITH {LATEST3}\n"
    "SELECT count(*) AS n_tx,\n"
    "  CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(TX_AMOUNT), 0) AS mean_amount,\n"
    "  CAST(sum(TX_FRAUD) AS DOUBLE) / nullif(count(TX_FRAUD), 0) * 100 AS fraud_pct,\n"
    "  count(DISTINCT CUSTOMER_ID) AS n_customers\n"
    "FROM tx WHERE TX_DATETIME IS NOT NULL AND TX_AMOUNT >= 10 AND TX_AMOUNT <= 500\n"
    "  AND CAST(TX_DATETIME AS DATE) IN (SELECT d FROM days)",
)
def search_summary(spark, sf):
    d = flt.search_transactions(fx.tx(spark, sf), amount_min=10, amount_max=500, status="all")
    return agg.summary(d)


@register("filter_min_amount", "SELECT * FROM tx WHERE TX_AMOUNT >= 100")
def filter_min_amount(spark, sf):
    return out(flt.filter_min_amount(fx.tx(spark, sf), 100))


@register("tx_lookup", "SELECT * FROM tx WHERE TRANSACTION_ID = 4242")
def tx_lookup(spark, sf):
    return out(flt.tx_lookup(fx.tx(spark, sf), 4242))


@register(
    "second_level_queue",
    "SELECT * FROM tx WHERE TX_FRAUD = 1 ORDER BY TX_DATETIME DESC NULLS LAST, TRANSACTION_ID LIMIT 10",
)
def second_level_queue(spark, sf):
    return out(flt.second_level_queue(fx.tx(spark, sf), 10))
