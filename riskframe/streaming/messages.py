"""Request messages: sources, parsing, dead letters, repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.clean import request_errors
from riskframe.schemas import REQUEST_RULES

BAD_JSON = "malformed JSON"


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """``(value, ts)`` of a topic, read from its earliest offset."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    return reader.load().select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ts"))


def file_messages(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Messages from files as they arrive in a folder."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def parse_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """Request fields of flat or ``{"input": …}`` messages, with ``errors`` naming what is wrong.

    Values are read as they come: numbers may be text, whole numbers may have a point, truth values count as 0 and 1.
    Whatever cannot be read as its field's type is an error of that field; only text that is no JSON object at all
    is malformed. Unknown fields are ignored.
    """
    others = [c for c in messages.columns if c != column]
    whole = F.try_parse_json(column)
    inner = F.try_variant_get(whole, "$.input", "variant")
    # through explode the text is parsed once per row; as a plain column the optimizer would repeat the
    # parse for every field and rule that refers to it
    opened = messages.select(*others, column, F.explode(F.array(F.when(_is_object(inner), inner).otherwise(whole))).alias("_m"))
    values = {r.field: F.try_variant_get("_m", f"$.{r.field}", "variant").alias(r.field) for r in REQUEST_RULES}
    opened = opened.select(*others, column, F.coalesce(~_is_object(F.col("_m")), F.lit(True)).alias("_bad"), F.explode(F.array(F.struct(*values.values()))).alias("_v"))
    read = {r.field: _read(F.col(f"_v.{r.field}"), r.type, r.required) for r in REQUEST_RULES}
    fields = [value.alias(field) for field, (value, _) in read.items()]
    wrong = [text.alias(f"_wrong_{field}") for field, (_, text) in read.items()]
    typed = opened.select(*others, column, "_bad", *fields, *wrong)
    checked = request_errors(typed, types={field: F.col(f"_wrong_{field}") for field in read}).drop(*[f"_wrong_{f}" for f in read])
    return checked.withColumn("errors", F.when(F.col("_bad"), F.array(F.lit(BAD_JSON))).otherwise(F.col("errors"))).drop(
        "_bad"
    )


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def _read(value: Column, kind: str, required: bool) -> tuple[Column, Column]:
    """A JSON value as ``string``, ``double`` or ``int``, and what is wrong with it (null: nothing)."""
    name, article = {"string": ("string", "a"), "double": ("number", "a"), "int": ("integer", "an")}[kind]
    invalid = F.lit(f"Input should be a valid {name}")
    is_text = F.schema_of_variant(value) == "STRING"
    given = value.isNotNull() & (F.lit(True) if required else ~_null(value))  # a null is no number, but may be left out
    if kind == "string":
        text = F.when(is_text, F.try_variant_get(value, "$", "string"))
        return text, F.when(given & text.isNull(), invalid)
    number = F.try_variant_get(value, "$", "double")
    read = number if kind == "double" else F.when((number == F.floor(number)) & (F.abs(number) < 2.0**31), number.cast("int"))
    reason = F.when(is_text, F.concat(invalid, F.lit(f", unable to parse string as {article} {name}")))
    if kind == "int":
        reason = reason.when(number != F.floor(number), F.concat(invalid, F.lit(", got a number with a fractional part")))
    return read, F.when(given & read.isNull(), reason.otherwise(invalid))


def _null(value: Column) -> Column:
    return F.coalesce(F.is_variant_null(value), F.lit(False))


def valid_requests(parsed: DataFrame, column: str = "value") -> DataFrame:
    return parsed.filter(F.size("errors") == 0).drop("errors", column)


def dead_letters(parsed: DataFrame, column: str = "value") -> DataFrame:
    """Rejected messages as received, with the reasons."""
    fields = {r.field for r in REQUEST_RULES}
    others = [c for c in parsed.columns if c not in fields and c not in ("errors", column)]
    return parsed.filter(F.size("errors") > 0).select(
        *others, column, F.array_join("errors", "; ").alias("reason")
    )


def drop_repeats(stream: DataFrame, key: str, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """One row per key among those that arrive within ``delay`` of each other; also for a batch."""
    if not stream.isStreaming:
        return stream.dropDuplicates([key])
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
