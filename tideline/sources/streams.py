"""Streaming sources.

Message-log sources (``kafka``, ``kinesis``) and text files yield one text
payload column; table and file sources yield typed rows. The connector
options (start position, rate limit, …) pass straight through:

* Kafka: ``startingOffsets="earliest"``, ``maxOffsetsPerTrigger=1000``,
  ``failOnDataLoss="false"``, ``subscribe=<topic>``
* Kinesis (connector dependent): ``streamName``, ``startingPosition="TRIM_HORIZON"``
* files: ``maxFilesPerTrigger``, ``pathGlobFilter``, ``latestFirst``
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.functions.decode import json_decode, payload_text

_PAYLOAD = {"kafka": "value", "kinesis": "data", "text": "value", "socket": "value"}


def stream_source(spark: SparkSession, fmt: str, path: str | None = None,
                  schema: StructType | str | None = None, payload: str | None = None,
                  start: dt.datetime | None = None, **options) -> DataFrame:
    """``readStream.format(fmt)``; message formats are reduced to their text payload.

    ``payload`` names the message column of any other format, too. ``start``
    is an instant: files changed before it are passed over (file sources read
    them once, but none of their rows goes on), and kafka begins at the first
    message from then on; connectors with an own option take that.
    """
    if start is not None and fmt == "kafka":
        options.setdefault("startingTimestamp", int(start.timestamp() * 1000))
    r = spark.readStream.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None and fmt not in ("kafka", "kinesis"):
        r = r.schema(schema)
    df = r.load(path) if path else r.load()
    if start is not None and path:
        df = df.where(F.col("_metadata.file_modification_time") >= F.lit(start))
    if payload or fmt in _PAYLOAD:
        col = payload or _PAYLOAD[fmt]
        return payload_text(df, col).withColumnRenamed(col, "value")
    return df


def json_stream(spark: SparkSession, fmt: str, schema: StructType | str,
                path: str | None = None, source_schema: StructType | str | None = None, **options) -> DataFrame:
    """A message stream decoded with ``from_json`` into typed columns."""
    return json_decode(stream_source(spark, fmt, path, source_schema, **options), schema)


def table_stream(spark: SparkSession, table: str) -> DataFrame:
    """Tail new files of a catalog table (``readStream.table``); schema from the catalog."""
    return spark.readStream.table(table)
