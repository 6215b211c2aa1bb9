"""One-row appends: the run audit and the metrics lines."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersieve.functions import clock
from ledgersieve.schemas import PIPELINE_RUNS


def one_row(spark: SparkSession, schema: T.StructType, record: dict[str, Any]) -> DataFrame:
    """A one-row DataFrame; fields that the record leaves out are null."""

    def value(kind: T.DataType, given: Any):
        column = clock.at(given) if isinstance(given, datetime) else F.lit(given)
        return column.cast(kind)

    unknown = set(record) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"not in the table: {sorted(unknown)}")
    return spark.range(0, 1, 1, 1).select(
        [value(f.dataType, record.get(f.name)).alias(f.name) for f in schema.fields]
    )


def append_run_audit(spark: SparkSession, path: str, record: dict[str, Any]) -> None:
    one_row(spark, PIPELINE_RUNS, record).write.mode("append").parquet(path)


def append_metrics(spark: SparkSession, path: str, payload: dict[str, Any], event_time: datetime) -> None:
    """Append one JSON object; its keys are the payload's, nulls are written, ``event_ts`` is added."""
    record = {**payload, "event_ts": event_time.isoformat() + "+00:00"}
    columns = [
        (F.lit(None).cast("string") if value is None else F.lit(value)).alias(name)
        for name, value in record.items()
    ]
    (
        spark.range(0, 1, 1, 1)
        .select(columns)
        .write.mode("append")
        .option("ignoreNullFields", False)
        .json(path)
    )
