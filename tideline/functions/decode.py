"""Decoding message payloads into typed columns.

All of it is Catalyst expressions (no Python UDFs), so the same calls serve a
batch DataFrame and a streaming one. Bad input never raises: numbers and
dates that do not parse become NULL (``try_cast`` / ``try_to_timestamp``),
undecodable JSON becomes an all-NULL row, as ``from_json`` does in
PERMISSIVE mode.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def payload_text(df: DataFrame, payload: str = "value") -> DataFrame:
    """Keep only the message body, as text (Kafka ``value`` / Kinesis ``data``)."""
    return df.select(F.col(payload).cast("string").alias(payload))


def json_decode(df: DataFrame, schema: StructType | str, payload: str = "value",
                keep: Iterable[str] = (), keep_bad: bool = True) -> DataFrame:
    """``from_json(payload, schema)`` flattened to top-level columns.

    ``keep`` names input columns carried next to the decoded fields.
    With ``keep_bad=False`` rows whose payload does not start with ``{`` are
    dropped instead of becoming all-NULL rows.
    """
    keep = list(keep)
    if not keep_bad:
        df = df.filter(F.ltrim(F.col(payload)).startswith("{"))
    # a generator parses each message once, whatever filters and projections follow
    return df.select(*keep, F.inline(F.array(F.from_json(F.col(payload), schema))))


BAD_RECORD = "_bad_record"


def json_sorted(df: DataFrame, schema: StructType | str, required: Iterable[str] = (), payload: str = "value",
                keep: Iterable[str] = ()) -> DataFrame:
    """``json_decode`` with a ``reason`` for every message that is not good, and the message as ``message``.

    ``not_json`` (no object could be read), ``bad_field`` (a field's value is
    not of its type; the corrupt-record column tells), ``missing:<field>`` for
    the first of ``required`` without a value, null for good messages. The
    fields of a bad message are null, so what it holds is read from
    ``message``; good ones have a null ``message``.
    """
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names, wide = schema.names, StructType([*schema.fields, StructField(BAD_RECORD, StringType())])
    parsed = df.select(*keep, F.col(payload).alias("message"), F.inline(F.array(F.from_json(
        F.col(payload), wide, {"columnNameOfCorruptRecord": BAD_RECORD}))))
    bad = F.col(BAD_RECORD).isNotNull()
    blank = F.col("message").isNull() | (F.trim("message") == "")
    reason = (F.when(blank | (bad & F.get_json_object("message", "$").isNull()), "not_json")
              .when(bad, "bad_field"))
    for n in required:
        reason = reason.when(F.col(n).isNull(), f"missing:{n}")
    parsed = parsed.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return parsed.select(*keep, *[F.when(good, F.col(n)).alias(n) for n in names],
                         F.when(~good, F.col("message")).alias("message"), "reason")


def parse_time(col: str | Column, fmt: str) -> Column:
    """Text -> timestamp_ntz with a datetime pattern; NULL when it does not match."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def epoch_ms(col: str | Column) -> Column:
    """Epoch milliseconds -> timestamp_ntz (UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c.cast("bigint")).cast("timestamp_ntz")


def to_epoch_ms(col: str | Column) -> Column:
    """timestamp / timestamp_ntz -> epoch milliseconds (UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_millis(c.cast("timestamp"))


def event_time(col: str | Column) -> Column:
    """Cast a naive (NTZ) timestamp to the session-zone TIMESTAMP that
    ``withWatermark`` and ``window`` require; the session zone is UTC."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp")


def to_ntz(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp_ntz")


def exact_money(col: str | Column, scale: int = 8) -> Column:
    """A double amount as decimal(24, scale): sums of it do not depend on
    the order of addition, so every engine and every partitioning agrees.
    NULL where it does not fit (an infinite or not-a-number amount, too)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(f"decimal(24,{scale})")
