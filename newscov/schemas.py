"""Declared input schemas and the required-column guard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ARTICLES = _schema(date=_STRING, media=_STRING, label=_INT, confidence=_DOUBLE, description=_STRING)

TRAINING_TEXTS = _schema(text=_STRING, label=_INT)

ANNOTATION_COLUMNS = ("label_1", "label_2", "label_3")
PREDICTION_COLUMNS = ("prediction_label_1", "prediction_label_2", "prediction_label_3")
EVALUATION_COLUMNS = ("description", *ANNOTATION_COLUMNS, *PREDICTION_COLUMNS)

# Partition column of stored articles: first day of the month of ``date``.
STORED_MONTH = "month_start"

METRICS = _schema(
    source=_STRING, precision=_DOUBLE, recall=_DOUBLE, f1=_DOUBLE,
    top1=_DOUBLE, top3=_DOUBLE, unsure=_DOUBLE,
)

RUN_PARAMETERS = _schema(
    lr=_DOUBLE, batch_size=_INT, epoch=_INT, max_len=_INT, weights=T.ArrayType(_DOUBLE), len_dataset=_LONG
)

LEXICON = _schema(theme=_STRING, subtheme=_STRING, term=_STRING)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Return ``df``, or raise naming every column that is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df
