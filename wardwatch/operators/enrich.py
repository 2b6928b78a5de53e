"""Message building: a monitor reading enriched with the patient registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.config import DATA_SOURCE, HOSPITAL_ID
from wardwatch.schemas import MESSAGE_COLUMNS

# what a registry entry adds to a reading
REGISTRY_COLUMNS = ("patient_name", "age", "ward", "condition", "doctor_id")


def message_columns() -> list[Column]:
    """The 16 message fields of a reading that has its registry columns."""
    made = {"device_id": F.concat(F.lit("MONITOR-"), F.col("patient_id")), "hospital_id": F.lit(HOSPITAL_ID),
            "data_source": F.lit(DATA_SOURCE)}
    return [made.get(c, F.col(c)).alias(c) for c in MESSAGE_COLUMNS]


def enrich(readings: DataFrame, registry: DataFrame, keep: tuple[str, ...] = ("kafka_offset",),
           unmatched: bool = False) -> DataFrame:
    """Readings x registry on ``patient_id`` -> the 16 message fields (+ ``keep``).

    A reading of an unregistered patient has no message; ``unmatched`` returns
    those readings instead. Spark picks the join by the registry's size in bytes.
    """
    if unmatched:
        return readings.join(registry, on="patient_id", how="left_anti")
    joined = readings.join(registry, on="patient_id", how="inner")
    return joined.select(*message_columns(), *[F.col(c) for c in keep])
