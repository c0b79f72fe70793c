"""Column names, schemas and fixed parameter defaults shared by all modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEXT = "text_combined"
LABEL = "label"
KEY = "raw_index"
SOURCE = "source"

# Defaults that decide the results.
SEED = 42
VALID_LABELS = [0, 1]
PHASE1_FRACTION = 0.60
PHASE2_FRACTION = 0.20
HOLDOUT_FRACTION = 0.20
TRAIN_SIZE = 0.70
VAL_SIZE = 0.15
TEST_SIZE = 0.15
MIN_TEXT_LENGTH = 3
MAX_REQUEST_LENGTH = 50_000
HIGH_IMBALANCE_RATIO = 10.0
TOP_NEW_TOKENS = 50
MAX_FEATURES = 20_000
NGRAM_RANGE = (1, 2)
MIN_DF = 2
MAX_DF = 0.95
NB_ALPHA = 0.5
MODEL_NAMES = ["dummy", "logistic_regression", "linear_svc", "complement_nb"]
PRIMARY_METRIC = "f2"

RAW_SCHEMA = T.StructType(
    [T.StructField(TEXT, T.StringType()), T.StructField(LABEL, T.StringType())]
)


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Raise ValueError naming the required columns that ``df`` lacks."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")
