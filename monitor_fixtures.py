"""Deterministic monitor readings derived from the driver's ``events`` table.

Each event becomes one reading of patient ``user_id``; the vitals follow the
simulator's per-condition ranges with integer arithmetic, and fixed event ids
plant sentinel values (impossible vitals, NULLs, blank ids) so that every
cleaning and classification branch is hit. The derivation is a narrow
projection: it partitions like ``events`` and never shuffles.

Fixed values below must match the oracle SQL in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.config import CONDITIONS, DATA_SOURCE, HOSPITAL_ID, WARDS
from wardwatch.functions.cache import per_context

# --- fixed values: sentinel moduli and vital formulas -------------------------
# (modulus, replacement); a NULL replacement means the field is missing
PATIENT_ID_SENTINELS = ((97, None), (89, "  "))
AGE_SENTINELS = ((53, 130), (59, -1))
HR_SENTINELS = ((61, 350), (67, -5), (71, None))
SYSTOLIC_SENTINELS = ((73, 260), (79, 40), (83, None))
DIASTOLIC_SENTINELS = ((101, 200),)
SPO2_SENTINELS = ((103, 30), (107, None))
TEMP_TENTHS_SENTINELS = ((109, 500), (113, None))
RESP_SENTINELS = ((127, 99),)
READING_TS_NULL_MODULUS = 131
# vital = base + (event_id * multiplier) % span, per condition
#              multiplier, (critical base, span), (stable base, span), (other base, span)
VITAL_FORMULAS = {
    "heart_rate_bpm": (37, (40, 101), (60, 41), (55, 56)),
    "systolic_bp_mmhg": (53, (70, 111), (110, 21), (100, 46)),
    "diastolic_bp_mmhg": (29, (40, 71), (70, 16), (60, 36)),
    "spo2_pct": (41, (85, 15), (96, 5), (93, 8)),
    "temperature_tenths": (31, (350, 46), (361, 12), (360, 21)),
    "respiratory_rate": (23, (8, 23), (12, 7), (10, 13)),
}
AGE_BASE, AGE_SPAN = 18, 73
DOCTOR_SPAN = 10
INGEST_DELAY_SPAN = 45      # ingested_at = ts + (event_id % 45) seconds
PARTITION_SPAN = 3          # kafka_partition = user_id % 3
# --- end of fixed values -------------------------------------------------------



def _e() -> Column:
    return F.col("event_id")


def _u() -> Column:
    return F.col("user_id")


def pad_digits(n: Column, width: int) -> Column:
    """Zero-pad the decimal text of ``n`` to ``width``; longer text is kept whole."""
    s = n.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def patient_code(user: Column | None = None) -> Column:
    """``PAT-`` + 4-digit number of a user (user 0 is PAT-0001)."""
    user = _u() if user is None else user
    return F.concat(F.lit("PAT-"), pad_digits(user + 1, 4))


def _by_index(idx: Column, values) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx == i, v) if expr is None else expr.when(idx == i, v)
    return expr


def ward_of(user: Column | None = None) -> Column:
    return _by_index((_u() if user is None else user) % len(WARDS), WARDS)


def condition_of(user: Column | None = None) -> Column:
    return _by_index((_u() if user is None else user) % len(CONDITIONS), CONDITIONS)


def _sentinel(base: Column, sentinels) -> Column:
    expr = None
    for mod, repl in sentinels:
        val = F.lit(None) if repl is None else F.lit(repl)
        hit = _e() % mod == 0
        expr = F.when(hit, val) if expr is None else expr.when(hit, val)
    return base if expr is None else expr.otherwise(base)


def vital_base(name: str, user: Column | None = None, event: Column | None = None) -> Column:
    """Per-condition simulated value (no sentinels), INT."""
    user = _u() if user is None else user
    event = _e() if event is None else event
    mult, crit, stab, oth = VITAL_FORMULAS[name]
    cond = user % len(CONDITIONS)          # 0 Stable, 1 Critical, 2/3 other
    r = event * mult
    return (F.when(cond == 1, crit[0] + r % crit[1])
            .when(cond == 0, stab[0] + r % stab[1])
            .otherwise(oth[0] + r % oth[1])).cast("int")


def raw_readings(events: DataFrame) -> DataFrame:
    """The raw readings table (19 columns) for every event."""
    return events.select(*_raw_columns())


@per_context
def _raw_columns() -> tuple[Column, ...]:
    def vital(name, sentinels):
        return _sentinel(vital_base(name), sentinels).cast("int")

    E, U = _e(), _u()
    tenths = _sentinel(vital_base("temperature_tenths"), TEMP_TENTHS_SENTINELS)
    return (
        _sentinel(F.concat(F.lit(" "), patient_code(), F.lit(" ")), PATIENT_ID_SENTINELS)
        .cast("string").alias("patient_id"),
        F.concat(F.lit("Patient "), U.cast("string")).alias("patient_name"),
        _sentinel(F.lit(AGE_BASE) + U % AGE_SPAN, AGE_SENTINELS).cast("int").alias("age"),
        ward_of().alias("ward"),
        condition_of().alias("condition"),
        F.concat(F.lit("DR-"), pad_digits(U % DOCTOR_SPAN + 1, 3)).alias("doctor_id"),
        vital("heart_rate_bpm", HR_SENTINELS).alias("heart_rate_bpm"),
        vital("systolic_bp_mmhg", SYSTOLIC_SENTINELS).alias("systolic_bp_mmhg"),
        vital("diastolic_bp_mmhg", DIASTOLIC_SENTINELS).alias("diastolic_bp_mmhg"),
        vital("spo2_pct", SPO2_SENTINELS).alias("spo2_pct"),
        (tenths.cast("double") / 10).alias("temperature_celsius"),
        vital("respiratory_rate", RESP_SENTINELS).alias("respiratory_rate"),
        F.when(E % READING_TS_NULL_MODULUS != 0, F.col("ts")).alias("reading_timestamp"),
        F.concat(F.lit("MONITOR-"), patient_code()).alias("device_id"),
        F.lit(HOSPITAL_ID).alias("hospital_id"),
        F.lit(DATA_SOURCE).alias("data_source"),
        F.timestamp_add("SECOND", (E % INGEST_DELAY_SPAN).cast("int"), F.col("ts")).alias("ingested_at"),
        (U % PARTITION_SPAN).cast("int").alias("kafka_partition"),
        E.cast("long").alias("kafka_offset"),
    )


def registry(events: DataFrame) -> DataFrame:
    """Patient registry: one row per distinct user (the simulator's admitted patients)."""
    U = _u()
    users = events.select("user_id").where(U.isNotNull()).distinct()
    return users.select(
        patient_code().alias("patient_id"),
        F.concat(F.lit("Patient "), U.cast("string")).alias("patient_name"),
        (F.lit(AGE_BASE) + U % AGE_SPAN).cast("int").alias("age"),
        ward_of().alias("ward"),
        condition_of().alias("condition"),
        F.concat(F.lit("DR-"), pad_digits(U % DOCTOR_SPAN + 1, 3)).alias("doctor_id"),
    )


def monitor_readings(events: DataFrame) -> DataFrame:
    """Vitals as a monitor reports them: patient key, six vitals, time, offset."""
    E, U = _e(), _u()
    return events.where(U.isNotNull()).select(
        patient_code().alias("patient_id"),
        vital_base("heart_rate_bpm").alias("heart_rate_bpm"),
        vital_base("systolic_bp_mmhg").alias("systolic_bp_mmhg"),
        vital_base("diastolic_bp_mmhg").alias("diastolic_bp_mmhg"),
        vital_base("spo2_pct").alias("spo2_pct"),
        (vital_base("temperature_tenths").cast("double") / 10).alias("temperature_celsius"),
        vital_base("respiratory_rate").alias("respiratory_rate"),
        F.col("ts").alias("reading_timestamp"),
        E.cast("long").alias("kafka_offset"),
    )


# --- fixed values: planted message faults, by kafka_offset % modulus == remainder ---
TRUNCATED_JSON = (997, 1)       # value cut to its first 40 characters
FRACTIONAL_AGE = (991, 2)       # "age":98.6 in an integer field
QUOTED_HEART_RATE = (983, 3)    # "heart_rate_bpm":"<n>" (a quoted number loads)
MISSING_RESP_RATE = (977, 4)    # respiratory_rate left out
LONG_PATIENT_ID = (971, 5)      # a 21-character patient id
BAD_UTF8_NAME = (967, 6)        # a 0xFF byte inside patient_name (binary values only)
TRAILING_TEXT = (953, 7)        # text after the object
SECOND_OBJECT = (947, 8)        # the object twice in one value
EMPTY_ARRAY = (941, 9)          # "[]"
ZONE_OFFSET = (937, 10)         # the reading time written at +05:30 (loads as UTC)
NULL_ELEMENT = (929, 11)        # in arrays only: a null before the object
SCALAR_ELEMENT = (919, 12)      # in arrays only: a number after the object
TRUNCATE_AT = 40
# --- end of fixed values ---


def _hit(rule, off: Column) -> Column:
    return off % rule[0] == rule[1]


_READING_TIME = r'("reading_timestamp":")[^"]*"'


def envelopes(raw: DataFrame, faults: bool = True) -> DataFrame:
    """Raw readings -> topic records ``(key, value, partition, offset, timestamp)``.

    The record timestamp is the reading's load time, so decoding reproduces
    the raw table. With ``faults`` the planted faults above are applied.
    """
    from wardwatch.sources.messages import encode

    off = F.col("kafka_offset")
    rows = raw
    if faults:
        rows = raw.withColumn(
            "patient_id",
            F.when(_hit(LONG_PATIENT_ID, off), F.concat(F.lit("PAT-"), F.lpad(off.cast("string"), 17, "0")))
            .otherwise(F.col("patient_id")),
        ).withColumn(
            "respiratory_rate", F.when(~_hit(MISSING_RESP_RATE, off), F.col("respiratory_rate")))
    rec = encode(rows.withColumn("_time", F.col("reading_timestamp")), keep=("kafka_partition", "kafka_offset", "ingested_at", "_time"))
    value = F.col("value")
    # the same moment on a clock that is 5:30 ahead
    local = F.coalesce(F.date_format(F.col("_time") + F.expr("INTERVAL '05:30' HOUR TO MINUTE"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(""))
    if faults:
        value = (F.when(_hit(TRUNCATED_JSON, off), F.substring(value, 1, TRUNCATE_AT))
                 .when(_hit(FRACTIONAL_AGE, off), F.regexp_replace(value, r'"age":-?[0-9]+', '"age":98.6'))
                 .when(_hit(QUOTED_HEART_RATE, off),
                       F.regexp_replace(value, r'"heart_rate_bpm":(-?[0-9]+)', '"heart_rate_bpm":"$1"'))
                 .when(_hit(TRAILING_TEXT, off), F.concat(value, F.lit(" end")))
                 .when(_hit(SECOND_OBJECT, off), F.concat(value, value))
                 .when(_hit(EMPTY_ARRAY, off), "[]")
                 .when(_hit(ZONE_OFFSET, off), F.regexp_replace(value, _READING_TIME, F.concat(F.lit("$1"), local, F.lit('+05:30"'))))
                 .otherwise(value))
    return rec.select(
        "key", value.alias("value"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingested_at").alias("timestamp"),
    )


def array_envelopes(raw: DataFrame, group_size: int = 2, single_every: int = 3) -> DataFrame:
    """Records that carry an outer JSON array of ``group_size`` readings.

    Readings are grouped by ``offset DIV group_size``; every ``single_every``-th
    group is sent as bare objects instead. An array record's offset is the
    smallest offset in it. Grouping is a shuffle of bounded groups.
    """
    rec = envelopes(raw, faults=False)
    off = F.col("offset")
    value = (F.when(_hit(NULL_ELEMENT, off), F.concat(F.lit("null,"), "value"))
             .when(_hit(SCALAR_ELEMENT, off), F.concat("value", F.lit(",5"))).otherwise(F.col("value")))
    grp = F.floor(F.col("offset") / group_size)
    single = rec.where(grp % single_every == 0)
    arrays = (rec.where(grp % single_every != 0)
              .groupBy(grp.alias("_g"))
              .agg(F.concat(F.lit("["), F.array_join(F.collect_list(value), ","), F.lit("]")).alias("value"),
                   F.min("offset").alias("offset"), F.min("partition").alias("partition"),
                   F.min("timestamp").alias("timestamp"), F.min("key").alias("key")))
    return single.unionByName(arrays.drop("_g"))


def binary_envelopes(raw: DataFrame) -> DataFrame:
    """Records with binary values; planted rows carry an invalid UTF-8 byte in the name."""
    rec = envelopes(raw, faults=False)
    marked = F.regexp_replace("value", '"patient_name":"', '"patient_name":"\u0001')
    parts = F.split(marked, "\u0001")
    bad = F.concat(F.encode(parts.getItem(0), "UTF-8"), F.unhex(F.lit("FF")), F.encode(parts.getItem(1), "UTF-8"))
    value = F.when(_hit(BAD_UTF8_NAME, F.col("offset")), bad).otherwise(F.encode("value", "UTF-8"))
    return rec.select("key", value.alias("value"), "partition", "offset", "timestamp")
