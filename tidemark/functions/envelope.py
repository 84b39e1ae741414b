"""Change-envelope encode / decode.

A change message is JSON with ``op``, ``before``, ``after`` and ``source``
(``ts_ms``, ``lsn``).  Two shapes travel on the same topic: *wrapped* in a
``payload`` object, or *flat*.  Decoding parses each message once with
``from_json`` and falls back from the wrapped to the flat path per field.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.entities import EntitySpec
from tidemark.functions.casts import lenient_cast

_SOURCE = T.StructType([
    T.StructField("ts_ms", T.StringType(), True),
    T.StructField("lsn", T.StringType(), True),
])


def _change_fields(row: T.DataType) -> list[T.StructField]:
    return [
        T.StructField("op", T.StringType(), True),
        T.StructField("before", row, True),
        T.StructField("after", row, True),
        T.StructField("source", _SOURCE, True),
    ]


def envelope_schema(spec: EntitySpec) -> T.StructType:
    """Both shapes in one schema; payload fields are read as text."""
    row = spec.text_payload_schema
    return T.StructType(
        [T.StructField("payload", T.StructType(_change_fields(row)), True)] + _change_fields(row)
    )


def _first(env: Column, *path: str, scalar: bool = False) -> Column:
    """Wrapped path first, then the flat one (per field, so a null wrapped value falls through)."""
    wrapped = env.getField("payload")
    flat = env
    for p in path:
        wrapped = wrapped.getField(p)
        flat = flat.getField(p)
    if scalar:
        wrapped, flat = _scalar(wrapped, "payload", *path), _scalar(flat, *path)
    return F.coalesce(wrapped, flat)


def _scalar(text: Column, *path: str) -> Column:
    """Null for an object or array, which from_json hands back as JSON text.  A string may begin with the
    same brackets, so for such text (only) the JSON type of the value decides."""
    return _if_string(text, _kind(*path))


def _scalar_of_row(text: Column, is_delete: Column, name: str, *above: str) -> Column:
    """``_scalar`` for a field of the image that the op picked."""
    return _if_string(text, F.when(is_delete, _kind(*above, "before", name)).otherwise(_kind(*above, "after", name)))


def _kind(*path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json("raw_json"), "$." + ".".join(path), "variant"))


def _if_string(text: Column, kind: Column) -> Column:
    bracket = F.substring(text, 1, 1).isin("{", "[")
    # nested, not joined by AND: both sides of an AND count as always needed, so the second parse would run for every row
    return F.when(bracket, F.when(kind == "STRING", text)).otherwise(text)


def _first_of_variant(v: Column, *path: str, scalar: bool = False) -> Column:
    """As ``_first``, over a parsed message: values are read by path and judged by their own type."""
    def text(at: str) -> Column:
        got = F.try_variant_get(v, at, "string")
        if not scalar:
            return got
        kind = F.schema_of_variant(F.try_variant_get(v, at, "variant"))
        return F.when(F.substring(got, 1, 1).isin("{", "["), F.when(kind == "STRING", got)).otherwise(got)
    tail = ".".join(path)
    return F.coalesce(text(f"$.payload.{tail}"), text(f"$.{tail}"))


def decode_envelope(
    topic: DataFrame,
    spec: EntitySpec,
    value_col: str = "value",
    ts_col: str = "timestamp",
    strict_casts: bool = False,
    scalars_only: bool = True,
    track_cast_errors: bool = False,
    keep_lsn: bool = False,
    parser: str = "struct",
) -> DataFrame:
    """Topic records ``(value, timestamp)`` -> Bronze rows.

    * null messages are dropped (tombstone guard);
    * ``op`` = wrapped op, else flat op;
    * each payload column comes from ``before`` when op is ``'d'``, otherwise from
      ``after`` (a null op takes the ``after`` branch);
    * an object or array where a scalar is expected is null (``scalars_only=False`` keeps its JSON text);
    * text is cast leniently (bad text -> null) unless ``strict_casts``;
    * malformed JSON still yields a row: nulls plus ``raw_json``;
    * ``track_cast_errors`` adds ``cast_errors``: fields whose text was present
      but did not cast (what lenient casting turned into null);
    * ``keep_lsn`` adds ``source_lsn`` (the log position), the tie-breaker for
      changes committed in the same millisecond (pass ``tie_breaker=("source_lsn",)``);
    * ``parser="variant"`` parses each message once into a VARIANT and reads values from it by
      path: whole numbers and decimals keep every digit (up to 38; zeros at a decimal's end go, as ``12.50``
      and ``12.5`` are one VARIANT value), text in brackets is judged without a second
      parse, and a message with a repeated key in one object counts as malformed.
      ``"struct"`` reads the declared fields with ``from_json``; a number read as text goes through a double.
    """
    if parser not in ("struct", "variant"):
        raise ValueError("parser must be 'struct' or 'variant'")
    env = F.try_parse_json("raw_json") if parser == "variant" else F.from_json(F.col("raw_json"), envelope_schema(spec))
    first = _first_of_variant if parser == "variant" else _first
    src = (
        topic.select(
            F.col(ts_col).cast(T.TimestampType()).alias("kafka_event_ts"),
            F.col(value_col).cast(T.StringType()).alias("raw_json"),
        )
        .where(F.col("raw_json").isNotNull())
        .select("kafka_event_ts", "raw_json", env.alias("_e"))
    )
    # in steps: the op once per message, then the image it picks, then the fields; a later step reads columns, so that no
    # expression of an earlier one is repeated in every field
    e, op, is_delete = F.col("_e"), F.col("op"), F.col("op") == F.lit("d")
    src = src.withColumn("op", first(e, "op", scalar=scalars_only))
    if parser == "struct":
        pick = lambda at: F.when(is_delete, at.getField("before")).otherwise(at.getField("after"))
        src = src.select("kafka_event_ts", "raw_json", "op", e.getField("payload").getField("source").alias("_payload_source"),
                         e.getField("source").alias("_source"), pick(e.getField("payload")).alias("_payload_row"), pick(e).alias("_row"))

    def source_text(name: str) -> Column:
        if parser == "variant":
            return first(e, "source", name)
        return F.coalesce(F.col("_payload_source").getField(name), F.col("_source").getField(name))

    def row_text(name: str, scalar: bool) -> Column:
        if parser == "variant":
            return F.when(is_delete, first(e, "before", name, scalar=scalar)).otherwise(first(e, "after", name, scalar=scalar))
        wrapped, flat = F.col("_payload_row").getField(name), F.col("_row").getField(name)
        if scalar:
            wrapped, flat = (_scalar_of_row(wrapped, is_delete, name, "payload"), _scalar_of_row(flat, is_delete, name))
        return F.coalesce(wrapped, flat)

    cols = [F.date_trunc("millisecond", F.col("kafka_event_ts")).alias("kafka_event_ts"), op]
    errors = []
    for name, dtype in [*spec.columns, ("source_ts_ms", T.LongType())]:
        if name == "source_ts_ms":
            text = source_text("ts_ms")
        else:
            text = row_text(name, scalars_only and isinstance(dtype, T.StringType))  # JSON text of an object casts to no other type
        typed = lenient_cast(text, dtype, strict=strict_casts)
        cols.append(typed.alias(name))
        errors.append(F.when(text.isNotNull() & typed.isNull(), F.lit(1)).otherwise(F.lit(0)))
    cols.append(F.col("raw_json"))
    if keep_lsn:
        cols.append(lenient_cast(source_text("lsn"), T.LongType(), strict=strict_casts).alias("source_lsn"))
    if track_cast_errors:
        cols.append(sum(errors[1:], errors[0]).alias("cast_errors"))
    return src.select(*cols)


def _as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    if isinstance(dtype, T.DecimalType):
        return c.cast(dtype).cast(T.StringType())  # decimals travel as strings
    return c


def encode_envelope(
    changes: DataFrame,
    spec: EntitySpec,
    wrapped: Column | bool = True,
    lsn_col: str | None = None,
) -> DataFrame:
    """Change rows -> topic records ``(key, value, timestamp)``.

    ``changes`` holds ``op``, ``source_ts_ms``, ``kafka_event_ts`` and two structs
    ``before`` / ``after`` with the entity columns (either may be null).
    ``wrapped`` (a boolean column or constant) picks the ``payload`` shape.
    """
    def image(side: str) -> Column:
        s = F.col(side)
        fields = [_as_text(s.getField(n), t).alias(n) for n, t in spec.columns]
        return F.when(s.isNull(), F.lit(None)).otherwise(F.struct(*fields))

    source = F.struct(
        F.col("source_ts_ms").alias("ts_ms"),
        (F.col(lsn_col) if lsn_col else F.lit(None).cast(T.LongType())).alias("lsn"),
    )
    body = F.struct(F.col("op").alias("op"), image("before").alias("before"),
                    image("after").alias("after"), source.alias("source"))
    wrap = wrapped if isinstance(wrapped, Column) else F.lit(bool(wrapped))
    key_row = F.coalesce(F.col("after").getField(spec.key), F.col("before").getField(spec.key))
    # one JSON text for both shapes; never null, as Spark can tell by the last value of coalesce: a reader's filter on null
    # messages is then dropped, where it would be pushed below with a second copy of all this, into the joins of the changes
    text = F.coalesce(F.to_json(body), F.lit("{}"))
    return changes.select(
        F.to_json(F.struct(F.struct(key_row.alias(spec.key)).alias("payload"))).alias("key"),
        F.concat(F.when(wrap, F.lit('{"payload":')).otherwise(F.lit("")), text, F.when(wrap, F.lit("}")).otherwise(F.lit(""))).alias("value"),
        F.col("kafka_event_ts").alias("timestamp"),
    )


# every character that Unicode counts as white space, the ASCII separators included
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
               + "\u2028\u2029\u202f\u205f\u3000")


def _strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE_SPACE))


def split_keyed_line(lines: DataFrame, line_col: str = "value", sep: str = "|") -> DataFrame:
    """Console-consumer text lines ``key|value`` -> (key, value); split at the
    first separator, both sides stripped of any white space; blank lines and lines without a
    separator are dropped."""
    parts = F.split(_strip(F.col(line_col)), re.escape(sep), 2)
    return (
        lines.select(parts.alias("_p"))
        .where(F.size("_p") == 2)
        .select(_strip(F.col("_p")[0]).alias("key"), _strip(F.col("_p")[1]).alias("value"))
    )


_MAP = T.MapType(T.StringType(), T.StringType())
_MIN_VALUE = T.StructType([
    T.StructField("payload", T.StructType([
        T.StructField("op", T.StringType(), True),
        T.StructField("before", _MAP, True),
        T.StructField("after", _MAP, True),
        T.StructField("source", _SOURCE, True),
    ]), True),
    T.StructField("_corrupt_record", T.StringType(), True),
])
_MIN_KEY = T.StructType([
    T.StructField("payload", _MAP, True),
    T.StructField("_corrupt_record", T.StringType(), True),
])
_JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "allowSingleQuotes": "false"}


def envelope_view(topic: DataFrame, consumer_mode: str = "resume", consumer_group: str = "orders-view",
                  key_col: str = "key", value_col: str = "value") -> DataFrame:
    """Live view of the wrapped envelope: run mode and group, key, op, before, after (as JSON maps)."""
    v = F.from_json(F.col(value_col).cast("string"), _MIN_VALUE, _JSON_OPTS)
    return topic.select(
        F.lit(consumer_mode).alias("consumer_mode"),
        F.lit(consumer_group).alias("consumer_group"),
        F.col(key_col).cast("string").alias("key"),
        v.getField("payload").getField("op").alias("op"),
        v.getField("payload").getField("before").alias("before"),
        v.getField("payload").getField("after").alias("after"),
    )


def minimal_order_event(
    topic: DataFrame,
    consumer_mode: str,
    consumer_group: str,
    key_col: str = "key",
    value_col: str = "value",
) -> DataFrame:
    """Compact order event from the wrapped shape only.

    Records whose key or value is not JSON are skipped.  The row image is
    ``after`` if it is a non-empty object, else ``before`` if non-empty, else
    empty; ``order_id`` falls back to the key when the row's is missing or 0.
    """
    k = F.from_json(F.col(key_col).cast("string"), _MIN_KEY, _JSON_OPTS)
    v = F.from_json(F.col(value_col).cast("string"), _MIN_VALUE, _JSON_OPTS)
    # the struct parser stops at the end of the first value; as the only element of an array, text behind it is an error
    alone = lambda c: F.size(F.from_json(F.concat(F.lit("["), F.col(c).cast("string"), F.lit("]")), T.ArrayType(T.StringType()), _JSON_OPTS)) == 1
    ok = alone(key_col) & alone(value_col)
    parsed = topic.select(k.alias("_k"), v.alias("_v"), ok.alias("_ok")).where(
        F.col("_k").isNotNull() & F.col("_v").isNotNull()
        & F.col("_k._corrupt_record").isNull() & F.col("_v._corrupt_record").isNull()
        & F.col("_ok")
    )
    p = F.col("_v.payload")
    after, before = p.getField("after"), p.getField("before")
    row = (
        F.when(F.coalesce(F.size(after), F.lit(0)) > 0, after)
        .when(F.coalesce(F.size(before), F.lit(0)) > 0, before)
        .otherwise(F.create_map().cast(_MAP))
    )
    row_order = row.getItem("order_id").try_cast(T.LongType())
    key_order = F.col("_k.payload").getItem("order_id").try_cast(T.LongType())
    return parsed.select(
        F.current_timestamp().alias("ingested_at"),
        F.lit(consumer_mode).alias("consumer_mode"),
        F.lit(consumer_group).alias("consumer_group"),
        p.getField("op").alias("op"),
        F.when(F.coalesce(row_order, F.lit(0)) != 0, row_order).otherwise(key_order).alias("order_id"),
        row.getItem("customer_id").try_cast(T.LongType()).alias("customer_id"),
        row.getItem("status").alias("status"),
        row.getItem("amount").alias("amount"),
        p.getField("source").getField("ts_ms").try_cast(T.LongType()).alias("source_ts_ms"),
        p.getField("source").getField("lsn").try_cast(T.LongType()).alias("lsn"),
    )
