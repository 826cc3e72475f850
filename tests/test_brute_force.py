"""Window and sequence features against a brute force: every row picks its own earlier rows by key and time."""

import math

import pytest

from cardrisk import fixtures as fx
from cardrisk.operators.rolling import customer_spending, terminal_risk
from cardrisk.operators.sequence import add_customer_sequence, spending_drift
from conftest import SF_SMALL

DAY = 86400 * 10**6


def rows(df):
    return [r.asDict() for r in df.collect()]


def by_id(df):
    return {r["TRANSACTION_ID"]: r for r in rows(df)}


def of_key(table, key):
    groups = {}
    for r in table:
        groups.setdefault(r[key], []).append(r)
    return groups


def close(a, b):
    return (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("loader", [fx.tx, fx.tx_orders])
def test_customer_spending(spark, loader):
    """The row itself and those before it by (time, id), not older than the window."""
    t = loader(spark, SF_SMALL)
    got = by_id(customer_spending(t, ties="row"))
    for group in of_key(rows(t), "CUSTOMER_ID").values():
        for r in group:
            for n in (1, 7, 30):
                seen = [o["TX_AMOUNT"] for o in group if (o["us"], o["TRANSACTION_ID"]) <= (r["us"], r["TRANSACTION_ID"]) and o["us"] > r["us"] - n * DAY and o["TX_AMOUNT"] is not None]
                mine = got[r["TRANSACTION_ID"]]
                assert mine[f"CUSTOMER_ID_NB_TX_{n}DAY_WINDOW"] == len(seen)
                assert close(mine[f"CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW"], math.fsum(seen) / len(seen) if seen else None)


def test_terminal_risk(spark):
    """Rows that are at least the delay old and not older than delay and window."""
    t = fx.tx(spark, SF_SMALL)
    got = by_id(terminal_risk(t))
    for group in of_key(rows(t), "TERMINAL_ID").values():
        for r in group:
            for n in (1, 7, 30):
                seen = [o["TX_FRAUD"] for o in group if r["us"] - (7 + n) * DAY < o["us"] <= r["us"] - 7 * DAY]
                mine = got[r["TRANSACTION_ID"]]
                assert mine[f"TERMINAL_ID_NB_TX_{n}DAY_WINDOW"] == len(seen)
                assert close(mine[f"TERMINAL_ID_RISK_{n}DAY_WINDOW"], sum(seen) / len(seen) if seen else 0.0)


def test_sequence_features(spark):
    """The k-th row before a row is the one with k - 1 rows between them."""
    t = fx.tx(spark, SF_SMALL)
    got, drifts = by_id(add_customer_sequence(t, drift_window=5)), by_id(spending_drift(t))
    for group in of_key(rows(t), "CUSTOMER_ID").values():
        for r in group:
            before = [o for o in group if (o["us"], o["TRANSACTION_ID"]) < (r["us"], r["TRANSACTION_ID"])]
            before = sorted(before, key=lambda o: (-o["us"], -o["TRANSACTION_ID"]))[:5]
            amounts, mine = [o["TX_AMOUNT"] for o in before], got[r["TRANSACTION_ID"]]
            assert mine["TIME_SINCE_LAST_TX"] == (r["TX_TIME_SECONDS"] - before[0]["TX_TIME_SECONDS"] if before else 999999)
            for k in (1, 2, 3):
                assert mine[f"TX_AMOUNT_SHIFTED_{k}"] == (amounts[k - 1] if len(amounts) >= k else None)
            three = [a for a in amounts[:3] if a is not None]
            assert close(mine["TX_AMOUNT_LAST3_MEAN"], math.fsum(three) / len(three) if three else 0.0)
            five = [a for a in amounts if a is not None]
            mean = math.fsum(five) / len(five) if five else None
            drift = 1.0 if mean is None else r["TX_AMOUNT"] / (mean + 1e-5)
            assert close(mine["AVG_LAST_TX_AMOUNT"], mean)
            assert close(mine["SPENDING_DRIFT"], drift) and close(drifts[r["TRANSACTION_ID"]]["SPENDING_DRIFT"], drift)
