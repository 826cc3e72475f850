"""Monitoring aggregates (2.D) with their oracle SQL."""

from __future__ import annotations

from cardrisk import fixtures as fx
from cardrisk.operators import aggregates as agg
from cardrisk.operators.filters import day_slice
from cardrisk.plans.features import build_features
from cardrisk.queries.registry import out, register

RATE = "CAST(sum(TX_FRAUD) AS DOUBLE) / nullif(count(TX_FRAUD), 0)"
MEAN_AMT = "CAST(sum(CAST(TX_AMOUNT AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(TX_AMOUNT), 0)"
LATEST_DAY = "ld AS (SELECT max(CAST(TX_DATETIME AS DATE)) AS day FROM tx)"
HOUR = "CAST(hour(TX_DATETIME) AS INTEGER)"


def feat1(spark, sf):
    """Stage-one features over the fixture (the dashboard's input table)."""
    return build_features(fx.tx(spark, sf), stage2=False)


@register(
    "daily_kpis",
    "WITH d AS (SELECT CAST(TX_DATETIME AS DATE) AS TX_DATE, count(*) AS n_tx,\n"
    "  CAST(coalesce(sum(TX_FRAUD), 0) AS BIGINT) AS n_fraud,\n"
    f"  {MEAN_AMT} AS mean_amount,\n"
    "  count(DISTINCT CUSTOMER_ID) AS n_customers FROM tx GROUP BY 1)\n"
    "SELECT a.TX_DATE, a.n_tx, a.n_fraud, a.mean_amount, a.n_customers,\n"
    "  coalesce(CAST(a.n_tx AS DOUBLE) / nullif(a.n_customers, 0), 0) AS tx_per_customer,\n"
    "  a.n_fraud - coalesce(b.n_fraud, 0) AS fraud_delta\n"
    "FROM d a LEFT JOIN d b ON b.TX_DATE + 1 = a.TX_DATE",
)
def daily_kpis(spark, sf):
    return agg.daily_kpis(fx.tx(spark, sf))


@register(
    "fraud_summary",
    "WITH s AS (SELECT count(*) AS n_tx, CAST(coalesce(sum(CASE WHEN TX_FRAUD = 1 THEN 1 END), 0) AS BIGINT) AS n_fraud FROM tx)\n"
    "SELECT n_tx, n_fraud, coalesce(CAST(n_fraud AS DOUBLE) / nullif(n_tx, 0) * 100, 0) AS fraud_pct FROM s",
)
def fraud_summary(spark, sf):
    return agg.fraud_summary(fx.tx(spark, sf))


@register(
    "class_counts",
    "WITH dom(TX_FRAUD, label) AS (VALUES (0, 'Normal'), (1, 'Betrug')),\n"
    "c AS (SELECT TX_FRAUD, count(*) AS n FROM tx GROUP BY 1)\n"
    "SELECT dom.TX_FRAUD, dom.label, coalesce(c.n, 0) AS n FROM dom LEFT JOIN c ON dom.TX_FRAUD = c.TX_FRAUD",
)
def class_counts(spark, sf):
    return agg.class_counts(fx.tx(spark, sf))


@register("fraud_rate_by_day", f"SELECT CAST(TX_DATETIME AS DATE) AS TX_DATE, {RATE} * 100 AS fraud_pct FROM tx GROUP BY 1")
def fraud_rate_by_day(spark, sf):
    return agg.fraud_rate_by_day(fx.tx(spark, sf))


@register(
    "fraud_count_by_day",
    "SELECT strftime(TX_DATETIME, '%Y-%m-%d') AS day, count(*) AS n_fraud FROM tx WHERE TX_FRAUD = 1 GROUP BY 1",
)
def fraud_count_by_day(spark, sf):
    return agg.fraud_count_by_day(fx.tx(spark, sf))


@register("fraud_count_by_dayno", "SELECT TX_TIME_DAYS, count(*) AS n_fraud FROM tx WHERE TX_FRAUD = 1 GROUP BY 1")
def fraud_count_by_dayno(spark, sf):
    return agg.fraud_count_by_dayno(fx.tx(spark, sf))


@register(
    "fraud_by_hour_filled",
    "WITH h AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24)),\n"
    f"c AS (SELECT {HOUR} AS hour, count(*) AS n FROM tx WHERE TX_FRAUD = 1 GROUP BY 1)\n"
    "SELECT h.hour, coalesce(c.n, 0) AS n_fraud FROM h LEFT JOIN c ON h.hour = c.hour",
)
def fraud_by_hour_filled(spark, sf):
    return agg.fraud_by_hour_filled(fx.tx(spark, sf))


@register(
    "tx_by_hour",
    f"WITH {LATEST_DAY}\nSELECT {HOUR} AS hour, count(*) AS n_tx FROM tx WHERE CAST(TX_DATETIME AS DATE) = (SELECT day FROM ld) GROUP BY 1",
)
def tx_by_hour(spark, sf):
    return agg.tx_by_hour(day_slice(fx.tx(spark, sf)))


@register("fraud_rate_by_hour", f"SELECT {HOUR} AS hour, {RATE} AS fraud_rate FROM tx GROUP BY 1")
def fraud_rate_by_hour(spark, sf):
    return agg.fraud_rate_by_hour(fx.tx(spark, sf))


@register("fraud_rate_by_weekday", f"SELECT dayname(TX_DATETIME) AS weekday, {RATE} AS fraud_rate FROM tx GROUP BY 1")
def fraud_rate_by_weekday(spark, sf):
    return agg.fraud_rate_by_weekday(fx.tx(spark, sf))


EXT = "e AS (SELECT CAST(min(TX_AMOUNT) AS DOUBLE) AS lo, CAST(max(TX_AMOUNT) AS DOUBLE) AS hi FROM tx)"


@register(
    "amount_histogram",
    f"WITH {EXT},\n"
    "b AS (SELECT coalesce(CAST(least(floor((TX_AMOUNT - lo) / nullif((hi - lo) / 50, 0)), 49) AS BIGINT), 0) AS bin, lo, hi\n"
    "      FROM tx, e WHERE TX_AMOUNT IS NOT NULL)\n"
    "SELECT bin, count(*) AS n, lo + bin * ((hi - lo) / 50) AS bin_lo, lo + (bin + 1) * ((hi - lo) / 50) AS bin_hi\n"
    "FROM b GROUP BY bin, lo, hi",
)
def amount_histogram(spark, sf):
    return agg.amount_histogram(fx.tx(spark, sf), bins=50)


@register(
    "fraud_rate_by_amount_bin",
    f"WITH {EXT},\n"
    "b AS (SELECT coalesce(CAST(least(greatest(ceil((TX_AMOUNT - lo) / nullif((hi - lo) / 10, 0)), 1), 10) AS BIGINT), 1) AS bin,\n"
    "        lo, hi, TX_FRAUD FROM tx, e WHERE TX_AMOUNT IS NOT NULL)\n"
    f"SELECT bin, {RATE} AS fraud_rate, count(*) AS n,\n"
    "  lo + (bin - 1) * ((hi - lo) / 10) AS bin_lo, lo + bin * ((hi - lo) / 10) AS bin_hi\n"
    "FROM b GROUP BY bin, lo, hi",
)
def fraud_rate_by_amount_bin(spark, sf):
    return agg.fraud_rate_by_amount_bin(fx.tx(spark, sf), bins=10)


@register(
    "amount_quartiles_by_class",
    "SELECT TX_FRAUD, count(TX_AMOUNT) AS n, min(TX_AMOUNT) AS min,\n"
    "  round(quantile_cont(TX_AMOUNT, 0.25), 6) AS q1, round(quantile_cont(TX_AMOUNT, 0.5), 6) AS median,\n"
    "  round(quantile_cont(TX_AMOUNT, 0.75), 6) AS q3, max(TX_AMOUNT) AS max FROM tx GROUP BY 1",
)
def amount_quartiles_by_class(spark, sf):
    return agg.amount_quartiles_by_class(fx.tx(spark, sf))


@register(
    "terminal_risk_heatmap",
    "WITH e AS (SELECT CAST(min(TERMINAL_ID_NB_TX_30DAY_WINDOW) AS DOUBLE) xl, CAST(max(TERMINAL_ID_NB_TX_30DAY_WINDOW) AS DOUBLE) xh,\n"
    "  CAST(min(TERMINAL_ID_RISK_30DAY_WINDOW) AS DOUBLE) yl, CAST(max(TERMINAL_ID_RISK_30DAY_WINDOW) AS DOUBLE) yh FROM feat),\n"
    "b AS (SELECT coalesce(CAST(least(floor((TERMINAL_ID_NB_TX_30DAY_WINDOW - xl) / nullif((xh - xl) / 10, 0)), 9) AS BIGINT), 0) AS bin_x,\n"
    "  coalesce(CAST(least(floor((TERMINAL_ID_RISK_30DAY_WINDOW - yl) / nullif((yh - yl) / 10, 0)), 9) AS BIGINT), 0) AS bin_y\n"
    "  FROM feat, e WHERE TERMINAL_ID_NB_TX_30DAY_WINDOW IS NOT NULL AND TERMINAL_ID_RISK_30DAY_WINDOW IS NOT NULL)\n"
    "SELECT bin_x, bin_y, count(*) AS n FROM b GROUP BY 1, 2",
    views=("feat",),
)
def terminal_risk_heatmap(spark, sf):
    return agg.histogram2d(feat1(spark, sf), "TERMINAL_ID_NB_TX_30DAY_WINDOW", "TERMINAL_ID_RISK_30DAY_WINDOW")


@register(
    "customer_weekday_hour",
    "WITH g AS (SELECT CAST(range // 24 AS INTEGER) AS weekday_no, CAST(range % 24 AS INTEGER) AS hour FROM range(168)),\n"
    f"c AS (SELECT CAST(isodow(TX_DATETIME) - 1 AS INTEGER) AS weekday_no, {HOUR} AS hour, count(*) AS n\n"
    "      FROM tx WHERE CUSTOMER_ID = 8 GROUP BY 1, 2)\n"
    "SELECT g.weekday_no, (['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'])[g.weekday_no + 1] AS weekday,\n"
    "  g.hour, coalesce(c.n, 0) AS n_tx FROM g LEFT JOIN c ON g.weekday_no = c.weekday_no AND g.hour = c.hour",
)
def customer_weekday_hour(spark, sf):
    return agg.customer_weekday_hour(fx.tx(spark, sf), customer_id=8)


@register(
    "customer_weekday_hour_all",
    f"SELECT CUSTOMER_ID, CAST(isodow(TX_DATETIME) - 1 AS INTEGER) AS weekday_no, {HOUR} AS hour, count(*) AS n_tx\n"
    "FROM tx GROUP BY 1, 2, 3",
)
def customer_weekday_hour_all(spark, sf):
    return agg.weekday_hour_counts(fx.tx(spark, sf))


CORR_COLS = [
    "TRANSACTION_ID", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", "TX_TIME_SECONDS", "TX_TIME_DAYS",
    "TX_FRAUD_SCENARIO", "us", "TX_DURING_WEEKEND", "TX_DURING_NIGHT",
    "CUSTOMER_ID_NB_TX_1DAY_WINDOW", "CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW",
    "CUSTOMER_ID_NB_TX_7DAY_WINDOW", "CUSTOMER_ID_AVG_AMOUNT_7DAY_WINDOW",
    "CUSTOMER_ID_NB_TX_30DAY_WINDOW", "CUSTOMER_ID_AVG_AMOUNT_30DAY_WINDOW",
    "TERMINAL_ID_NB_TX_1DAY_WINDOW", "TERMINAL_ID_RISK_1DAY_WINDOW",
    "TERMINAL_ID_NB_TX_7DAY_WINDOW", "TERMINAL_ID_RISK_7DAY_WINDOW",
    "TERMINAL_ID_NB_TX_30DAY_WINDOW", "TERMINAL_ID_RISK_30DAY_WINDOW",
]


def _corr_sql() -> str:
    sel = []
    for c in CORR_COLS:
        r = f"corr(CAST({c} AS DOUBLE), CAST(TX_FRAUD AS DOUBLE))"
        sel.append(f"round(CASE WHEN isnan({r}) THEN NULL ELSE {r} END, 9) AS \"{c}\"")
    return (
        "WITH w AS (SELECT " + ",\n  ".join(sel) + " FROM feat)\n"
        + "\nUNION ALL ".join(f"SELECT '{c}' AS feature, \"{c}\" AS corr FROM w" for c in CORR_COLS)
    )


@register("corr_with_label", "SELECT feature, corr FROM (" + _corr_sql() + ")", views=("feat",))
def corr_with_label(spark, sf):
    return agg.corr_with_label(feat1(spark, sf), columns=CORR_COLS)


@register(
    "corr_top20",
    "SELECT feature, corr FROM (" + _corr_sql() + ") ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 20",
    views=("feat",),
)
def corr_top20(spark, sf):
    return agg.corr_top(feat1(spark, sf), n=20, columns=CORR_COLS)


@register(
    "class_weight",
    "SELECT count(CASE WHEN TX_FRAUD = 0 THEN 1 END) AS n_neg, count(CASE WHEN TX_FRAUD = 1 THEN 1 END) AS n_pos,\n"
    "  CAST(count(CASE WHEN TX_FRAUD = 0 THEN 1 END) AS DOUBLE) / nullif(count(CASE WHEN TX_FRAUD = 1 THEN 1 END), 0) AS neg_pos_ratio FROM tx",
)
def class_weight(spark, sf):
    return agg.class_weight(fx.tx(spark, sf))


@register(
    "check_first10",
    "SELECT TRANSACTION_ID, TX_DATETIME, CAST(isodow(TX_DATETIME) - 1 AS INTEGER) AS weekday,\n"
    f"  {HOUR} AS hour, (SELECT CAST(coalesce(sum(TX_FRAUD), 0) AS BIGINT) FROM tx) AS fraud_total\n"
    "FROM tx ORDER BY TX_DATETIME NULLS LAST, TRANSACTION_ID LIMIT 10",
)
def check_first10(spark, sf):
    return out(agg.check_first10(fx.tx(spark, sf)))


@register(
    "filter_domain",
    "SELECT DISTINCT CAST(TX_DATETIME AS DATE) AS TX_DATE, (SELECT CAST(min(TX_AMOUNT) AS DOUBLE) FROM tx) AS min_amount,\n"
    "  (SELECT CAST(max(TX_AMOUNT) AS DOUBLE) FROM tx) AS max_amount FROM tx WHERE TX_DATETIME IS NOT NULL",
)
def filter_domain(spark, sf):
    return agg.filter_domain(fx.tx(spark, sf))
