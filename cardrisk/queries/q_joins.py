"""Dimension joins, labels, one-hot (2.C, H15) with their oracle SQL."""

from __future__ import annotations



from cardrisk import fixtures as fx
from cardrisk.functions.scalar import SCENARIO_TEXT, SCENARIO_UNKNOWN
from cardrisk.operators import enrich
from cardrisk.queries.registry import register


def _enriched(spark, sf):
    t = fx.tx(spark, sf).select("TRANSACTION_ID", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", "TX_FRAUD")
    cust = fx.load(spark, sf, "customer")
    term = fx.load(spark, sf, "supplier")
    return enrich.enrich_dimensions(t, cust, term, customer_key="c_custkey", terminal_key="s_suppkey")


ENRICH_SQL = (
    "SELECT t.TRANSACTION_ID, t.CUSTOMER_ID, t.TERMINAL_ID, t.TX_AMOUNT, t.TX_FRAUD,\n"
    "  c.c_name, coalesce(c.c_nationkey, -999) AS c_nationkey, coalesce(c.c_acctbal, -999) AS c_acctbal, c.c_mktsegment,\n"
    "  s.s_name, coalesce(s.s_nationkey, -999) AS s_nationkey, coalesce(s.s_acctbal, -999) AS s_acctbal\n"
    "FROM tx t LEFT JOIN customer c ON c.c_custkey = t.CUSTOMER_ID LEFT JOIN supplier s ON s.s_suppkey = t.TERMINAL_ID"
)


@register("enrich_dimensions", ENRICH_SQL)
def enrich_dimensions(spark, sf):
    return _enriched(spark, sf)


def _scenario_sql() -> str:
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in SCENARIO_TEXT.items())
    return (
        "SELECT TRANSACTION_ID, TX_FRAUD_SCENARIO,\n"
        f"  CASE TX_FRAUD_SCENARIO {cases} ELSE '{SCENARIO_UNKNOWN}' END AS SCENARIO_LABEL FROM tx"
    )


@register("scenario_labels", _scenario_sql())
def scenario_labels(spark, sf):
    d = enrich.with_scenario_label(fx.tx(spark, sf))
    return d.select("TRANSACTION_ID", "TX_FRAUD_SCENARIO", "SCENARIO_LABEL")


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@register(
    "one_hot",
    f"WITH e AS ({ENRICH_SQL})\nSELECT TRANSACTION_ID,\n  "
    + ",\n  ".join(f"coalesce(CAST(c_mktsegment = '{v}' AS INTEGER), 0) AS c_mktsegment_{v}" for v in SEGMENTS)
    + "\nFROM e",
)
def one_hot(spark, sf):
    d = _enriched(spark, sf).select("TRANSACTION_ID", "c_mktsegment")
    segments = enrich.category_values(fx.load(spark, sf, "customer"), "c_mktsegment")
    return enrich.one_hot(d, {"c_mktsegment": segments})



