"""JSON monitor messages: encode (topic sink side) and decode (load side).

Decoding reads every field as text first (``from_json`` with string fields
keeps ``98.6`` and ``"12"`` verbatim), then applies the typed cast per field
with ``try_cast``: a field that is present but does not cast marks the
record bad, a missing field is NULL. A value holds one object or an array
of objects (the outer array is stripped: one row per element). Everything
that is received either loads or is set aside with its text and a reason: text
after the object or array, a NULL or non-object element, an empty array too.
A reading time with a zone offset is converted to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardwatch.config import MAX_LENGTHS
from wardwatch.functions.cache import per_context
from wardwatch.functions.rounding import half_up_div
from wardwatch.schemas import MESSAGE_COLUMNS, MESSAGE_FIELDS, MESSAGE_TEXT_ARRAY, MESSAGE_TEXT_SCHEMA, RAW_COLUMNS

# reading times travel as ISO text with microseconds, no zone
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode(rows: DataFrame, key: str = "patient_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows with the 16 message fields -> ``key``/``value`` JSON text (+ ``keep`` columns).

    NULL fields are left out of the object, as a producer omits unknown values.
    """
    return rows.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*MESSAGE_COLUMNS), JSON_OPTIONS).alias("value"),
        *[F.col(c) for c in keep],
    )


def _text(value: Column) -> Column:
    """Message text; invalid UTF-8 bytes become U+FFFD instead of failing."""
    return F.make_valid_utf8(value)


def decode(envelopes: DataFrame, stamp: Column | None = None, value: str = "value",
           partition: str = "partition", offset: str = "offset", carry: tuple[str, ...] = ()) -> DataFrame:
    """Topic records -> one row per message element with typed fields and a reason.

    Output: the 16 message fields (typed), ``ingested_at``, ``kafka_partition``,
    ``kafka_offset``, ``_raw`` (text as received), ``_reason`` (NULL when the
    record loads), ``_first`` (first element of its record, for counting).
    Every record received has at least one row.
    ``stamp`` is the load time; default: the session clock, one value per
    query / micro-batch. ``carry`` columns of the records go along unchanged.
    """
    stamp = F.localtimestamp() if stamp is None else stamp
    vtype = envelopes.schema[value].dataType
    text = _text(F.col(value)) if isinstance(vtype, T.BinaryType) else F.col(value).cast("string")
    parsed = envelopes.select(
        text.alias("_raw"),
        F.col(partition).cast("int").alias("kafka_partition"),
        F.col(offset).cast("long").alias("kafka_offset"),
        stamp.cast("timestamp_ntz").alias("ingested_at"), *carry,
    )
    keep = ("_raw", "kafka_partition", "kafka_offset", "ingested_at", *carry)
    # a message is parsed once, in a projection of its own; the next one decides what the result means
    exploded = (parsed.select(*keep, *_parsed()).select(*keep, "_one", "_many", _parsed_elements())
                .select(*keep, F.posexplode(_elements()).alias("_pos", "_e"))
                .select(*keep, "_pos", F.col("_e.why").alias("_why"), F.col("_e.m").alias("_m")))
    # each field is cast once, here; the reason compares text and value in the next projection
    casts = exploded.withColumns({f"_t_{n}": _typed(F.col("_m").getField(n), t) for n, t in MESSAGE_FIELDS
                                  if not isinstance(t, T.StringType)})
    typed = [(F.col("_m").getField(n) if isinstance(t, T.StringType) else F.col(f"_t_{n}")).alias(n)
             for n, t in MESSAGE_FIELDS]
    return casts.select(*typed, "ingested_at", "kafka_partition", "kafka_offset", *carry, "_raw", _reason(),
                        (F.col("_pos") == 0).alias("_first"))


def _listed() -> Column:
    """Whether ``_raw`` begins as an array does."""
    return F.coalesce(F.ltrim("_raw").startswith("["), F.lit(False))


@per_context
def _parsed() -> tuple[Column, ...]:
    """``_raw`` parsed inside brackets, where one object (``_one``) or one array (``_many``) must be all of it."""
    inside = F.concat(F.lit("["), "_raw", F.lit("]"))
    return (F.when(~_listed(), F.from_json(inside, MESSAGE_TEXT_ARRAY)).alias("_one"),
            F.when(_listed(), F.from_json(inside, T.ArrayType(T.ArrayType(T.StringType())))).alias("_many"))


@per_context
def _parsed_elements() -> Column:
    """The elements of the array in ``_many`` as ``array<struct<text, m>>``, each parsed once."""
    def parse(text: Column) -> Column:
        return F.struct(text.alias("text"), F.from_json(F.concat(F.lit("["), text, F.lit("]")), MESSAGE_TEXT_ARRAY)[0].alias("m"))
    return F.when(F.size("_many") == 1, F.transform(F.col("_many")[0], parse)).alias("_texts")


@per_context
def _elements() -> Column:
    """The elements of a message as ``array<struct<why, m>>``, never empty; ``why``: no object to load, else NULL."""
    none = F.lit(None).cast(MESSAGE_TEXT_SCHEMA)
    refuse = lambda why: F.array(F.struct(F.lit(why).alias("why"), none.alias("m")))

    def element(e: Column) -> Column:
        why = (F.when(e["text"].isNull(), "null_element").when(~e["text"].startswith("{"), "not_an_object")
               .when(e["m"].isNull(), "malformed_json"))
        return F.struct(why.alias("why"), F.when(why.isNull(), e["m"]).alias("m"))

    listed = (F.when(F.col("_texts").isNull(), refuse("malformed_json")).when(F.size("_texts") == 0, refuse("empty_array"))
              .otherwise(F.transform("_texts", element)))
    first = F.col("_one")[0]
    single = (F.when(F.col("_one").isNull() | (F.size("_one") != 1), refuse("malformed_json"))
              .when(first.isNull(), refuse("not_an_object"))
              .otherwise(F.array(F.struct(F.lit(None).cast("string").alias("why"), first.alias("m")))))
    return F.when(_listed(), listed).otherwise(single)


ZONE = r"[0-9]:[0-9]{2}.*(Z|z|[+-][0-9]{1,2}(:?[0-9]{2})?)$"


def _typed(text: Column, dtype: T.DataType) -> Column:
    """The value of a field's text, NULL if it does not cast; times with an offset become UTC."""
    if not isinstance(dtype, T.TimestampNTZType):
        return text.try_cast(dtype)
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(F.rlike(text, F.lit(ZONE)), utc).otherwise(text.try_cast(dtype))


@per_context
def _reason() -> Column:
    """Why a record does not load; NULL if it does."""
    reason = F.when(F.col("_why").isNotNull(), F.col("_why"))
    for name, dtype in MESSAGE_FIELDS:
        if not isinstance(dtype, T.StringType):
            reason = reason.when(F.col("_m").getField(name).isNotNull() & F.col(f"_t_{name}").isNull(), f"bad_value:{name}")
    reason = reason.when(F.col("_m").getField("patient_id").isNull(), "null_patient_id")
    for name, limit in MAX_LENGTHS.items():
        reason = reason.when(F.length(F.col("_m").getField(name)) > limit, f"too_long:{name}")
    return reason.alias("_reason")


def loaded(decoded: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Records that load: the raw table's 19 columns (+ ``carry``)."""
    return decoded.where(F.col("_reason").isNull()).select(*RAW_COLUMNS, *carry)


def quarantined(decoded: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Records set aside: text, reason and source position (+ ``carry``)."""
    return decoded.where(F.col("_reason").isNotNull()).select(
        F.col("_raw").alias("raw"), F.col("_reason").alias("reason"),
        "ingested_at", "kafka_partition", "kafka_offset", *carry)


def count_columns() -> list[Column]:
    """Load progress: records received, decoded, loaded, set aside."""
    return [F.count_if("_first").cast("long").alias("messages_received"),
            F.count(F.lit(1)).cast("long").alias("records_decoded"),
            F.count_if(F.col("_reason").isNull()).cast("long").alias("rows_loaded"),
            F.count_if(F.col("_reason").isNotNull()).cast("long").alias("rows_quarantined")]


def counts(decoded: DataFrame) -> DataFrame:
    """Load progress in one pass, see :func:`count_columns`."""
    return decoded.agg(*count_columns())


class EncodingError(RuntimeError):
    """Raised when more of a batch's records than allowed are not valid UTF-8."""


def utf8_counts(envelopes: DataFrame, value: str = "value", partition: str = "partition") -> DataFrame:
    """(kafka_partition, records, repaired, repaired_pct): records whose bytes are not valid UTF-8 and get repaired, by source partition."""
    bad = F.coalesce(~F.is_valid_utf8(F.col(value).cast("string")), F.lit(False))
    found = envelopes.groupBy(F.col(partition).cast("int").alias("kafka_partition")).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(bad).alias("repaired"))
    return found.withColumn("repaired_pct", half_up_div(F.col("repaired") * 10000, F.col("records")).cast("double") / 100)


def enforce_utf8(counted: DataFrame, most_pct: float) -> None:
    """The encoding gate: raises :class:`EncodingError` if a partition's share of repaired records is above ``most_pct``."""
    rows = counted.where(F.col("repaired") * 100 > F.col("records") * most_pct).collect()      # a row a partition
    if rows:
        raise EncodingError("records that are not valid UTF-8: " + ", ".join(
            f"{r['repaired']} of {r['records']} in partition {r['kafka_partition']}" for r in rows))
