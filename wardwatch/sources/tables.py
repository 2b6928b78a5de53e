"""Reading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# the raw table is laid out by reading day, so time-range reads prune folders
PARTITION_COLUMN = "reading_day"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet`` as a DataFrame (schema from the file footer)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_reading_day(df: DataFrame) -> DataFrame:
    """Add the partition column (the calendar day of the reading; NULL if no time)."""
    return df.withColumn(PARTITION_COLUMN, F.to_date("reading_timestamp"))


def write_raw(raw: DataFrame, path: str, mode: str = "append") -> None:
    """Append raw readings to a table laid out by reading day."""
    with_reading_day(raw).write.mode(mode).partitionBy(PARTITION_COLUMN).parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A raw table written by :func:`write_raw` (keeps ``reading_day`` for pruning)."""
    return spark.read.parquet(path)


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


# one database per layer: raw input, staging, marts
LAYERS = ("vitals_raw", "vitals_staging", "vitals_marts")
RAW_TABLE, QUARANTINE_TABLE = "raw_patient_vitals", "raw_patient_vitals_quarantine"
STAGING_TABLE, MART_TABLE = "stg_patient_vitals", "mart_patient_health_summary"


def create_layers(spark: SparkSession, location: str, layers: tuple[str, str, str] = LAYERS) -> None:
    """Idempotent setup: one database per layer and its parquet tables, partitioned.

    ``location`` is a shared folder; running this twice changes nothing.
    The raw tables are partitioned by load, the raw and the staging table by
    reading day below it. An insert replaces the partitions that it holds rows of
    and no others (dynamic overwrite, a property of the tables).
    The raw table's NOT NULL patient id is enforced by the loader
    (quarantine), as a parquet table does not enforce it.
    """
    from wardwatch.schemas import QUARANTINE_SCHEMA, RAW_SCHEMA
    base = location.rstrip("/")
    for db in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{base}/{db}.db'")

    def create(table: str, columns: str, by: str) -> None:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {layers[0]}.{table} ({columns}) USING parquet "
                  f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({by}) LOCATION '{base}/{layers[0]}.db/{table}'")

    create(RAW_TABLE, f"{_ddl(RAW_SCHEMA)}, load_id string, {PARTITION_COLUMN} date", f"load_id, {PARTITION_COLUMN}")
    create(QUARANTINE_TABLE, f"{_ddl(QUARANTINE_SCHEMA)}, load_id string", "load_id")


def load_tables(decoded: DataFrame, load_id: str, layers: tuple[str, str, str] = LAYERS) -> None:
    """Put decoded records (:func:`messages.decode`) into the raw layer: rows that load, and bad records.

    ``load_id`` names the load: one that is run again (after a failure half-way, or by
    mistake) replaces its own rows, so that a record is there once.
    """
    from wardwatch.sources import messages
    load = F.lit(load_id)
    loaded = with_reading_day(messages.loaded(decoded).withColumn("load_id", load))
    loaded.write.mode("overwrite").insertInto(f"{layers[0]}.{RAW_TABLE}")
    messages.quarantined(decoded).withColumn("load_id", load).write.mode("overwrite").insertInto(f"{layers[0]}.{QUARANTINE_TABLE}")


def read_raw_table(spark: SparkSession, layers: tuple[str, str, str] = LAYERS) -> DataFrame:
    """The raw table by name, ``reading_day`` kept: time ranges become partition filters."""
    return spark.table(f"{layers[0]}.{RAW_TABLE}").drop("load_id")


def publish_tables(staged: DataFrame, mart: DataFrame, layers: tuple[str, str, str] = LAYERS) -> None:
    """Write the staging and the mart layer's tables anew; staging is partitioned by reading day."""
    (staged.withColumn(PARTITION_COLUMN, F.to_date("reading_timestamp")).write.mode("overwrite").format("parquet")
     .partitionBy(PARTITION_COLUMN).saveAsTable(f"{layers[1]}.{STAGING_TABLE}"))
    mart.write.mode("overwrite").format("parquet").saveAsTable(f"{layers[2]}.{MART_TABLE}")
