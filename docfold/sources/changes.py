"""Change-log source (S1) and decoding.

A change record is one row: topic, partition, offset, key, value, headers, timestamp. A tombstone has a
NULL value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CHANGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))),
    T.StructField("timestamp", T.TimestampType()),
])


def read_changes(spark: SparkSession, *, path: str | None = None, brokers: str | None = None,
                 topics: list[str] | None = None, streaming: bool = False, schema: T.StructType | None = None,
                 max_offsets_per_trigger: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Change records, from the earliest offset, of a log (`brokers`, `topics`) or of Parquet files (`path`).

    A micro-batch is bounded by `max_offsets_per_trigger` (log) or `maxFilesPerTrigger` in `options` (files).
    """
    extra = dict(options or {})
    if (path is None) == (brokers is None):
        raise ValueError("give either path or brokers")
    if brokers is not None:
        if not topics:
            raise ValueError("a log source needs topics")
        extra = {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(topics), "includeHeaders": "true",
                 "startingOffsets": "earliest", **extra}
        if max_offsets_per_trigger and streaming:
            extra["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
        reader = spark.readStream if streaming else spark.read
        raw = reader.format("kafka").options(**extra).load()
        return raw.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"), "headers", "timestamp")
    if streaming:
        df = spark.readStream.schema(schema or CHANGE_SCHEMA).options(**extra).parquet(path)
    else:
        df = (spark.read.schema(schema) if schema else spark.read).options(**extra).parquet(path)
    if topics:
        df = df.where(F.col("topic").isin(list(topics)))
    return df


def decode_json(text: Column) -> Column:
    """JSON text -> VARIANT; text that is not JSON gives NULL (a malformed record, unless the text was NULL)."""
    return F.try_parse_json(text)


def decode_typed(text: Column, schema: T.StructType | str) -> Column:
    """JSON text -> struct with a declared schema; every declared field is then carried."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def unwrap_key(df: DataFrame, field: str = "id", key: str = "key") -> DataFrame:
    """`{"id": N}` -> N in the key column. Reads the key and never the value, so it works on tombstones."""
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.StructType):
        return df.withColumn(key, F.col(key)[field])
    if isinstance(dtype, T.MapType):
        return df.withColumn(key, F.try_element_at(F.col(key), F.lit(field)))
    if isinstance(dtype, T.VariantType):
        return df.withColumn(key, F.try_variant_get(key, f"$['{field}']", "string"))
    return df.withColumn(key, F.get_json_object(F.col(key).cast("string"), f"$['{field}']"))
