"""Column names, table schemas and the default parameters shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

DATE = "date"
SKU = "sku_id"
CATEGORY = "category_id"
PRICE = "sales_price"
QUANTITY = "sales_quantity"
N_ROWS = "n_rows"
CLUSTER = "cluster_id"
HOLIDAY = "is_ukrainian_holiday"
ROW_ID = "row_id"
PREDICTION = "prediction"

# Fixed default values of the feature build.
NUM_LAGS = 3
WINDOW_SIZE = 5
NUM_CLUSTERS = 5
TEST_PERCENT = 12
HORIZON_DAYS = 14

SALES_COLUMNS = [DATE, CATEGORY, SKU, PRICE, QUANTITY]

SALES_SCHEMA = T.StructType(
    [
        T.StructField(DATE, T.DateType()),
        T.StructField(CATEGORY, T.LongType()),
        T.StructField(SKU, T.LongType()),
        T.StructField(PRICE, T.DoubleType()),
        T.StructField(QUANTITY, T.DoubleType()),
    ]
)

CALENDAR_SCHEMA = T.StructType(
    [T.StructField(DATE, T.DateType()), T.StructField("name", T.StringType())]
)


def lag_name(i: int, column: str) -> str:
    return f"lag_{i}_{column}"


def sma_name(window: int, column: str) -> str:
    return f"sma_{window}_{column}"


def lag_names(lags: int = NUM_LAGS, columns: tuple[str, ...] = (PRICE, QUANTITY)) -> list[str]:
    return [lag_name(i, c) for c in columns for i in range(1, lags + 1)]


def sma_names(window: int = WINDOW_SIZE, columns: tuple[str, ...] = (PRICE, QUANTITY)) -> list[str]:
    return [sma_name(window, c) for c in columns]
