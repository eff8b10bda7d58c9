"""Session settings this library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach.

    It lies under the cluster's ``spark.checkpoint.dir``. Only a session without
    that setting (a local test) gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"ordergate-{name}-")
    return f"{shared.rstrip('/')}/ordergate-{name}-{uuid.uuid4().hex}"


def local_frame(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A few driver-side rows (file names, table metadata) as a local relation.

    Being part of the plan, it costs no job, and an empty one folds away.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)
