"""Top-k lists, newest cases, samples (2.E E10/E11, 2.F) with their oracle SQL."""

from __future__ import annotations

from cardrisk import fixtures as fx
from cardrisk.operators import topk
from cardrisk.queries.q_aggregates import feat1
from cardrisk.queries.registry import out, register

LATEST_DAY = "ld AS (SELECT max(CAST(TX_DATETIME AS DATE)) AS day FROM tx)"
STATUS_SQL = "[" + ", ".join("'" + s + "'" for s in topk.CASE_STATUS) + "]"


@register(
    "latest_fraud_cases",
    f"WITH {LATEST_DAY},\n"
    "f AS (SELECT * FROM tx WHERE CAST(TX_DATETIME AS DATE) = (SELECT day FROM ld) AND TX_FRAUD = 1\n"
    "      ORDER BY TX_DATETIME DESC, TRANSACTION_ID LIMIT 5)\n"
    "SELECT TRANSACTION_ID, strftime(TX_DATETIME, '%H:%M') AS TIME_HHMM, TX_AMOUNT, CUSTOMER_ID, TERMINAL_ID,\n"
    f"  ({STATUS_SQL})[row_number() OVER (ORDER BY TX_DATETIME DESC, TRANSACTION_ID)] AS STATUS FROM f",
)
def latest_fraud_cases(spark, sf):
    return topk.latest_fraud_cases(fx.tx(spark, sf))


@register(
    "top_transactions",
    "SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TX_AMOUNT, TX_FRAUD FROM tx\n"
    "ORDER BY TX_AMOUNT DESC NULLS LAST, TRANSACTION_ID LIMIT 5",
)
def top_transactions(spark, sf):
    return out(topk.top_transactions(fx.tx(spark, sf)))


@register(
    "top_fraud_terminals",
    f"WITH {LATEST_DAY}\n"
    "SELECT TERMINAL_ID, count(*) AS n_fraud FROM tx WHERE CAST(TX_DATETIME AS DATE) = (SELECT day FROM ld) AND TX_FRAUD = 1\n"
    "GROUP BY 1 ORDER BY n_fraud DESC, TERMINAL_ID LIMIT 5",
)
def top_fraud_terminals(spark, sf):
    return topk.top_fraud_terminals(fx.tx(spark, sf))


@register(
    "top_customers",
    "SELECT CUSTOMER_ID, CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) AS DOUBLE) AS turnover FROM tx\n"
    "GROUP BY 1 ORDER BY turnover DESC NULLS LAST, CUSTOMER_ID LIMIT 10",
)
def top_customers(spark, sf):
    return topk.top_customers(fx.tx(spark, sf))


@register(
    "top_risk_terminals",
    "SELECT TERMINAL_ID, round(avg(TERMINAL_ID_RISK_30DAY_WINDOW), 9) AS mean_risk FROM feat\n"
    "GROUP BY 1 ORDER BY mean_risk DESC NULLS LAST, TERMINAL_ID LIMIT 10",
    views=("feat",),
)
def top_risk_terminals(spark, sf):
    return topk.top_risk_terminals(feat1(spark, sf))


@register(
    "customer_last10",
    "SELECT CUSTOMER_ID, rank, TRANSACTION_ID, TX_DATETIME, TX_AMOUNT FROM (\n"
    "  SELECT *, CAST(row_number() OVER (PARTITION BY CUSTOMER_ID ORDER BY TX_DATETIME DESC NULLS LAST, TRANSACTION_ID) AS INTEGER) AS rank\n"
    "  FROM tx) WHERE rank <= 10",
)
def customer_last10(spark, sf):
    return out(topk.customer_last_n(fx.tx(spark, sf), 10))


@register(
    "sample_n",
    "SELECT * FROM tx ORDER BY md5(CAST(TRANSACTION_ID AS VARCHAR) || ':42'), TRANSACTION_ID LIMIT 100",
)
def sample_n(spark, sf):
    return out(topk.sample_n(fx.tx(spark, sf), n=100, seed=42))
