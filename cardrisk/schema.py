"""Column names, types and time constants of the transaction data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Microseconds per day: all time-range frames are in microseconds so that
# sub-second timestamps keep their exact frame membership.
D = 86400 * 10**6

# The column names of the transaction table and its features.
TRANSACTION_ID = "TRANSACTION_ID"
TX_DATETIME = "TX_DATETIME"
CUSTOMER_ID = "CUSTOMER_ID"
TERMINAL_ID = "TERMINAL_ID"
TX_AMOUNT = "TX_AMOUNT"
TX_TIME_SECONDS = "TX_TIME_SECONDS"
TX_TIME_DAYS = "TX_TIME_DAYS"
TX_FRAUD = "TX_FRAUD"
TX_FRAUD_SCENARIO = "TX_FRAUD_SCENARIO"
US = "us"  # unix microseconds of TX_DATETIME, the order key of range frames

TX_DURING_WEEKEND = "TX_DURING_WEEKEND"
TX_DURING_NIGHT = "TX_DURING_NIGHT"


def customer_count_col(days: int) -> str:
    return f"CUSTOMER_ID_NB_TX_{days}DAY_WINDOW"


def customer_avg_col(days: int) -> str:
    return f"CUSTOMER_ID_AVG_AMOUNT_{days}DAY_WINDOW"


def terminal_count_col(days: int) -> str:
    return f"TERMINAL_ID_NB_TX_{days}DAY_WINDOW"


def terminal_risk_col(days: int) -> str:
    return f"TERMINAL_ID_RISK_{days}DAY_WINDOW"


# Window sizes and delay used by the feature pipeline.
WINDOWS_DAYS = (1, 7, 30)
RISK_DELAY_DAYS = 7

# Second-stage feature names.
TX_AMOUNT_DEVIATION = "TX_AMOUNT_DEVIATION"
TX_TIME_SECONDS_SHIFTED = "TX_TIME_SECONDS_SHIFTED"
TIME_SINCE_LAST_TX = "TIME_SINCE_LAST_TX"
TX_AMOUNT_SHIFTED = ("TX_AMOUNT_SHIFTED_1", "TX_AMOUNT_SHIFTED_2", "TX_AMOUNT_SHIFTED_3")
TX_AMOUNT_LAST3_MEAN = "TX_AMOUNT_LAST3_MEAN"
TX_AMOUNT_TO_TERMINAL_AVG = "TX_AMOUNT_TO_TERMINAL_AVG"
TERMINAL_FRAUD_RATIO = "TERMINAL_FRAUD_RATIO"
AVG_LAST_TX_AMOUNT = "AVG_LAST_TX_AMOUNT"
SPENDING_DRIFT = "SPENDING_DRIFT"
PREDICTED_FRAUD = "PREDICTED_FRAUD"

# Columns never used as model features (ids, time, label, scenario).
NON_FEATURE_COLS = (TRANSACTION_ID, TX_DATETIME, TX_FRAUD, TX_FRAUD_SCENARIO, AVG_LAST_TX_AMOUNT)

# Raw transaction file layout (CSV source).
TRANSACTIONS = T.StructType(
    [
        T.StructField(TRANSACTION_ID, T.LongType()),
        T.StructField(TX_DATETIME, T.TimestampType()),
        T.StructField(CUSTOMER_ID, T.LongType()),
        T.StructField(TERMINAL_ID, T.LongType()),
        T.StructField(TX_AMOUNT, T.DoubleType()),
        T.StructField(TX_TIME_SECONDS, T.LongType()),
        T.StructField(TX_TIME_DAYS, T.IntegerType()),
        T.StructField(TX_FRAUD, T.IntegerType()),
        T.StructField(TX_FRAUD_SCENARIO, T.IntegerType()),
    ]
)

# Model metric history: time of day as text plus five metrics.
METRIC_HISTORY = T.StructType(
    [
        T.StructField("Zeit", T.StringType()),
        T.StructField("Precision", T.DoubleType()),
        T.StructField("Recall", T.DoubleType()),
        T.StructField("F1_Score", T.DoubleType()),
        T.StructField("ROC_AUC", T.DoubleType()),
        T.StructField("PR_AUC", T.DoubleType()),
    ]
)

# Older single-metric history form.
SINGLE_METRIC_HISTORY = T.StructType(
    [T.StructField("Zeit", T.StringType()), T.StructField("Wert", T.DoubleType())]
)

COORDS = T.StructType(
    [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())]
)
