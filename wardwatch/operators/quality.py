"""Data-quality checks and the publish gate.

Each check yields one report row ``(relation, column_name, test, severity,
failing_rows, passed)``. All row-level checks on one relation share ONE
aggregation pass (``count_if`` per check); the checks of the raw source and
of staging are fused into one scan of the raw table, because staging is a
projection of it. A ``unique`` check groups by its column first and the row
checks are summed over the groups, so a relation that is already hash
partitioned by that key (the mart, by patient) needs no further shuffle.
A NULL passes ``accepted_values``, ``range`` and ``unique``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.config import (
    BP_STATUSES, CONDITIONS, DEFAULT_BOUNDS, DEFAULT_THRESHOLDS, HEART_RATE_STATUSES,
    RISK_LEVELS, SPO2_STATUSES, TEMPERATURE_STATUSES, WARDS, Bounds, Thresholds,
)
from wardwatch.operators import staging

SOURCE = "raw_patient_vitals"
STAGING = "stg_patient_vitals"
MART = "mart_patient_health_summary"

TESTS = ("not_null", "accepted_values", "unique", "range", "missing")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else repr(v)


@dataclass(frozen=True)
class Check:
    relation: str
    column: str
    test: str
    values: tuple = ()
    bounds: tuple | None = None
    severity: str = "error"

    def failing_sql(self, ref: str | None = None) -> str:
        """Per-row failure predicate as SQL over column ``ref`` (not for ``unique``)."""
        c = _q(ref or self.column)
        if self.test in ("not_null", "missing"):
            return f"{c} IS NULL"
        if self.test == "accepted_values":
            return f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_lit(v) for v in self.values)})"
        if self.test == "range":
            return f"{c} IS NOT NULL AND NOT ({c} BETWEEN {self.bounds[0]!r} AND {self.bounds[1]!r})"
        raise ValueError(f"no row predicate for {self.test}")

    def failing(self, ref: str | None = None) -> Column:
        return F.expr(self.failing_sql(ref))


def _nn(rel, *cols, severity="error"):
    return [Check(rel, c, "not_null", severity=severity) for c in cols]


def default_checks(bounds: Bounds = DEFAULT_BOUNDS) -> tuple[Check, ...]:
    """The contracts of the three relations, plus range and missing-value checks.

    Range checks on the raw source and missing-vital counts on staging are
    warnings: staging nulls impossible values and NULL vitals fall to NORMAL,
    so they are reported but do not stop a publish.
    """
    b = bounds
    return tuple(
        _nn(SOURCE, "patient_id", "reading_timestamp", "hospital_id")
        + [Check(SOURCE, c, "range", bounds=getattr(b, c), severity="warn")
           for c in ("heart_rate_bpm", "systolic_bp_mmhg", "spo2_pct")]
        + _nn(STAGING, "patient_id", "ward", "patient_condition", "heart_rate_status", "bp_status",
              "spo2_status", "temperature_status", "has_alert", "reading_timestamp")
        + [Check(STAGING, "ward", "accepted_values", WARDS),
           Check(STAGING, "patient_condition", "accepted_values", CONDITIONS),
           Check(STAGING, "heart_rate_status", "accepted_values", HEART_RATE_STATUSES),
           Check(STAGING, "bp_status", "accepted_values", BP_STATUSES),
           Check(STAGING, "spo2_status", "accepted_values", SPO2_STATUSES),
           Check(STAGING, "temperature_status", "accepted_values", TEMPERATURE_STATUSES)]
        + [Check(STAGING, c, "range", bounds=getattr(b, c))
           for c in ("heart_rate_bpm", "systolic_bp_mmhg", "spo2_pct")]
        + [Check(STAGING, c, "missing", severity="warn")
           for c in ("heart_rate_bpm", "systolic_bp_mmhg", "diastolic_bp_mmhg", "spo2_pct",
                     "temperature_celsius", "respiratory_rate")]
        + _nn(MART, "patient_id", "patient_risk_level", "ward", "abnormal_vitals_count", "last_reading_at")
        + [Check(MART, "patient_risk_level", "accepted_values", RISK_LEVELS),
           Check(MART, "patient_id", "unique")]
    )


def _report_rows(agg: DataFrame, checks: list[Check]) -> DataFrame:
    """One-row aggregate with ``_f{i}`` columns -> one report row per check (``stack``)."""
    parts = [f"{_lit(c.relation)}, {_lit(c.column)}, {_lit(c.test)}, {_lit(c.severity)}, "
             f"CAST(coalesce(_f{i}, 0) AS BIGINT)" for i, c in enumerate(checks)]
    rows = agg.selectExpr(f"stack({len(checks)}, {', '.join(parts)}) "
                          f"AS (relation, column_name, test, severity, failing_rows)")
    return rows.withColumn("passed", F.col("failing_rows") == 0)


def evaluate(df: DataFrame, checks: Iterable[Check], where: str | None = None) -> DataFrame:
    """Run ``checks`` on ``df`` in one pass; ``where`` (SQL) restricts the rows checked."""
    checks = list(checks)
    unique = [c for c in checks if c.test == "unique"]
    rows = [c for c in checks if c.test != "unique"]
    if len(unique) > 1:
        raise ValueError("one unique check per pass; evaluate the others separately")

    def pred(c: Check) -> str:
        p = c.failing_sql()
        return p if where is None else f"({where}) AND ({p})"

    if not unique:
        agg = df.agg(*[F.expr(f"count_if({pred(c)})").alias(f"_f{i}") for i, c in enumerate(rows)])
        return _report_rows(agg, rows)

    u = unique[0]
    scope = df if where is None else df.where(where)
    per_key = scope.groupBy(F.col(u.column).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.expr(f"count_if({pred(c)})").alias(f"_g{i}") for i, c in enumerate(rows)])
    agg = per_key.agg(
        *[F.sum(f"_g{i}").alias(f"_f{i}") for i in range(len(rows))],
        F.expr("count_if(_key IS NOT NULL AND _n > 1)").alias(f"_f{len(rows)}"))
    return _report_rows(agg, rows + [u])


def source_and_staging(raw: DataFrame, checks: Iterable[Check], th: Thresholds = DEFAULT_THRESHOLDS,
                       bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """Raw-source and staging checks in one scan of the raw relation."""
    checks = [c for c in checks if c.relation in (SOURCE, STAGING)]
    src_cols = sorted({c.column for c in checks if c.relation == SOURCE})
    stg_cols = {c.column for c in checks if c.relation == STAGING}
    proj = raw.select(
        *[F.col(c).alias(f"src__{c}") for c in src_cols],
        staging.keep_reading().alias("_keep"),
        *[e.alias(f"stg__{n}") for e, n in zip(staging.staged_columns(th, bounds), _staging_names())
          if n in stg_cols],
    )
    aggs = []
    for i, c in enumerate(checks):
        p = c.failing_sql(("src__" if c.relation == SOURCE else "stg__") + c.column)
        if c.relation == STAGING:
            p = f"_keep AND ({p})"
        aggs.append(F.expr(f"count_if({p})").alias(f"_f{i}"))
    return _report_rows(proj.agg(*aggs), checks)


def _staging_names() -> list[str]:
    from wardwatch.schemas import STAGING_COLUMNS
    return list(STAGING_COLUMNS)


def report(raw: DataFrame, mart: DataFrame | None, checks: Iterable[Check] | None = None,
           th: Thresholds = DEFAULT_THRESHOLDS, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """The full quality report: one fused pass over raw, one over the mart."""
    checks = list(default_checks(bounds) if checks is None else checks)
    parts = []
    if any(c.relation in (SOURCE, STAGING) for c in checks):
        parts.append(source_and_staging(raw, checks, th, bounds))
    mart_checks = [c for c in checks if c.relation == MART]
    if mart_checks and mart is not None:
        parts.append(evaluate(mart, mart_checks))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    """Raised when an error-severity check fails; nothing may be published."""


def enforce(report_df: DataFrame, relations: Iterable[str] | None = None) -> list:
    """Stop the pipeline if any error-severity check failed.

    The report holds one row per check, so collecting it is bounded.
    Returns the failing warning rows.
    """
    rows = report_df.where(~F.col("passed")).collect()
    rel = set(relations) if relations is not None else None
    errors = [r for r in rows if r["severity"] == "error" and (rel is None or r["relation"] in rel)]
    if errors:
        detail = ", ".join(f"{r['relation']}.{r['column_name']} {r['test']}: {r['failing_rows']}" for r in errors)
        raise QualityGateError(f"data-quality gate failed: {detail}")
    return [r for r in rows if r["severity"] != "error"]
