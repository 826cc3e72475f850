"""Scalar helpers: safe arithmetic, labels, alerts, id search (JVM expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fraud scenario codes and their texts as shown to analysts.
SCENARIO_TEXT = {
    0: "Unregelmäßigkeit im Transaktionsmuster",
    1: "Auffällige Häufigkeit an einem Terminal",
    2: "Unerwartet hoher Betrag",
    3: "Geografisch verdächtige Aktivität",
    4: "Verdacht auf Mehrfachversuche",
}
SCENARIO_UNKNOWN = "Unbekanntes Szenario"

# F1 alert levels.
F1_CRITICAL = 0.75
F1_WATCH = 0.85


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct_deviation(amount, mean) -> Column:
    """(amount - mean) / mean * 100, 0 when the mean is 0; a NULL mean stays NULL."""
    a, m = _c(amount), _c(mean)
    return F.when(m != 0, (a - m) / m * 100).when(m == 0, F.lit(0.0))


def null_to(x, value) -> Column:
    c = _c(x)
    return F.coalesce(c, F.lit(value))


def clip_round(x, base: float, spread: float, digits: int = 4) -> Column:
    """Clip to [base - spread, base + spread] and round."""
    return F.round(F.least(F.greatest(_c(x), F.lit(base - spread)), F.lit(base + spread)), digits)


def status_light(label="TX_FRAUD") -> Column:
    """Traffic light of the label: 'red' for fraud, 'green' otherwise."""
    return F.when(_c(label) == 1, F.lit("red")).otherwise(F.lit("green"))


def f1_alert(f1) -> Column:
    c = _c(f1)
    return (
        F.when(c < F1_CRITICAL, F.lit("critical"))
        .when(c < F1_WATCH, F.lit("watch"))
        .when(c.isNotNull(), F.lit("ok"))
    )


def id_matches(x, pattern: str) -> Column:
    """Regex search on the id as text (partial match)."""
    return _c(x).cast("string").rlike(pattern)


def scenario_label(code="TX_FRAUD_SCENARIO") -> Column:
    pairs = []
    for k, v in SCENARIO_TEXT.items():
        pairs += [F.lit(k), F.lit(v)]
    m = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(m, _c(code).cast("int")), F.lit(SCENARIO_UNKNOWN))


def safe_corr(x, y) -> Column:
    """Pearson correlation; NULL for a constant column (ANSI-safe).

    Pairs with a NULL on either side are skipped, as ``corr`` does.
    """
    cx, cy = _c(x).cast("double"), _c(y).cast("double")
    both = cx.isNotNull() & cy.isNotNull()
    xx = F.when(both, cx)
    yy = F.when(both, cy)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))
