"""Declared schemas and the required-column contract."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tagloom.fixed_values import LOGGED_METRICS

CORPUS_COLUMNS = ("instruction", "intent")
SPLIT_COLUMNS = ("instruction", "intent", "category", "intent_id")

EXAMPLE_BANK = "intent string, examples array<string>"
CHAT_RECORD = "messages array<struct<role: string, content: string>>"
SPLIT_RECORD = "row_id bigint, instruction string, intent string, category string, intent_id int"
REQUEST = "request_id bigint, text string, approach string"
RUN_LOG = "run_id bigint, step bigint, kind string, value double"
_METRICS = ", ".join(f"{name}: double" for name in LOGGED_METRICS)
SUMMARY_DOCUMENT = (
    "generated_at string, base_model_id string, test_set_size bigint, intent_count int, "
    f"approaches map<string, struct<{_METRICS}, correct_samples: bigint, total_samples: bigint>>"
)
RESULT_RECORD = (
    "approach_name string, input_texts array<string>, raw_outputs array<string>, "
    "predictions array<string>, ground_truth array<string>, latencies_ms array<double>"
)


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Return ``df`` unchanged, or fail naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns {missing}; found {df.columns}.")
    return df
