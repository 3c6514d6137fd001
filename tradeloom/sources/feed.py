"""The trade feed: opening it, finding the payload, parsing it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.schema import WIRE

# File formats list their files and know no offsets; connectors bring their own columns.
FILE_FORMATS = {"json", "parquet", "text"}
# The column in which a source delivers an unparsed record.
PAYLOAD_COLUMNS = {"kafka": "value", "kinesis": "data", "pubsub": "payload", "pulsar": "value", "socket": "value", "text": "value"}


def _open(spark: SparkSession, fmt: str, options: Mapping[str, str], schema: T.StructType) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**options)
    if fmt in ("json", "parquet"):
        reader = reader.schema(schema)
    df = reader.load()
    # Kafka puts the key first; the payload is in the value.
    return df.select("value") if fmt == "kafka" else df


def stream_source(spark: SparkSession, fmt: str, options: Mapping[str, str], schema: T.StructType = WIRE) -> DataFrame:
    """Open the feed for records from now on. File formats always read the files not yet seen.

    The start is given under Kafka's option name; a connector that calls it otherwise takes its own name
    in ``options``.
    """
    start = {} if fmt in FILE_FORMATS else {"startingOffsets": "latest"}
    return _open(spark, fmt, {**start, **options}, schema)


def stream_replay_earliest(
    spark: SparkSession, fmt: str, options: Mapping[str, str], schema: T.StructType = WIRE
) -> DataFrame:
    """Open the feed from its oldest record."""
    start = {} if fmt in FILE_FORMATS else {"startingOffsets": "earliest"}
    return _open(spark, fmt, {**options, **start}, schema)


def parse_trade_json(df: DataFrame, col: str, schema: T.StructType = WIRE) -> DataFrame:
    """Flatten a JSON payload, given as text or bytes, into the wire columns.

    Text that is no JSON gives a row of NULLs; a field of the wrong type gives NULL in that field.
    """
    return df.select(_fields(col, schema))


def _fields(col: str, schema: T.StructType) -> Column:
    """The parsed fields as columns. They come out of a generator, through which Spark moves no filter:
    a plain struct would be parsed again for every condition on one of its fields."""
    return F.inline(F.array(F.from_json(_quoted(col).cast("string"), schema)))


def wire_rows(df: DataFrame, payload: str | None = None, schema: T.StructType = WIRE) -> DataFrame:
    """The wire columns of a feed; ``payload`` names the column to parse, None stands for a feed that is parsed.

    A column that the feed lacks is NULL, columns beyond the wire's are left out.
    """
    if payload is not None:
        return parse_trade_json(df, payload, schema)
    have = set(df.columns)
    return df.select(*[
        (_quoted(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def payload_column(df: DataFrame, fmt: str | None = None, schema: T.StructType = WIRE) -> str | None:
    """The column of unparsed records in what a source delivers, or None if it has parsed them.

    The source's format tells. Where it does not, a feed that has a wire field is parsed, and any other feed must have
    just one column of text or bytes; several leave the choice to the caller, as an error.
    """
    known = PAYLOAD_COLUMNS.get(fmt or "")
    if known in df.columns:
        return known
    if any(f.name in schema.names for f in df.schema.fields):
        return None
    raw = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    if len(raw) != 1:
        raise ValueError(f"name the payload column, one of {raw or df.columns}")
    return raw[0]


def resolve_payload(df: DataFrame, fmt: str | None = None, schema: T.StructType = WIRE) -> DataFrame:
    """Wire columns of a feed whose payload column is not known beforehand."""
    return wire_rows(df, payload_column(df, fmt, schema), schema)


def trade_payload(schema: T.StructType = WIRE) -> Column:
    """JSON text of the wire columns, NULL fields kept, as a producer would send it."""
    return F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"})


def quarantine(df: DataFrame, col: str, schema: T.StructType = WIRE) -> DataFrame:
    """Payloads that did not parse in full, with the list of required fields that came out NULL."""
    parsed = df.select(_quoted(col).cast("string").alias("payload"), _fields(col, schema))

    def lost(name: str) -> Column:
        value = F.try_to_timestamp("timestamp") if name == "timestamp" else F.col(name)
        return F.when(value.isNull(), F.lit(name))

    required = [f.name for f in schema.fields if not f.nullable]
    return parsed.select(
        "payload", F.array_compact(F.array(*[lost(name) for name in required])).alias("lost_fields")
    ).where(F.size("lost_fields") > 0)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")
