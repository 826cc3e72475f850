"""Per-transaction history card (H8, H16, H17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.functions.scalar import pct_deviation
from cardrisk.schema import (
    TRANSACTION_ID,
    TX_AMOUNT,
    WINDOWS_DAYS,
    customer_avg_col,
    customer_count_col,
    terminal_count_col,
    terminal_risk_col,
)

SCORE_COL = "MODEL_SCORE"


def history_card(feat: DataFrame, windows: Sequence[int] = WINDOWS_DAYS, long_window: int = 30) -> DataFrame:
    """One row per (transaction, window): customer count and mean, terminal count and risk,
    plus the amount's deviation in percent from the customer's ``long_window`` mean."""
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("window_days"),
                F.col(customer_count_col(n)).alias("cust_nb_tx"),
                F.col(customer_avg_col(n)).alias("cust_avg_amount"),
                F.col(terminal_count_col(n)).alias("term_nb_tx"),
                F.col(terminal_risk_col(n)).alias("term_risk"),
            )
            for n in windows
        ]
    )
    extra = [F.col(SCORE_COL)] if SCORE_COL in feat.columns else []
    return feat.select(
        TRANSACTION_ID,
        TX_AMOUNT,
        pct_deviation(TX_AMOUNT, customer_avg_col(long_window)).alias(f"amount_pct_dev_{long_window}d"),
        *extra,
        F.inline(rows),
    )


def tx_detail(feat: DataFrame, transaction_id: int, **kw) -> DataFrame:
    """History card of one transaction (point filter on a feature table)."""
    return history_card(feat.filter(F.col(TRANSACTION_ID) == transaction_id), **kw)
