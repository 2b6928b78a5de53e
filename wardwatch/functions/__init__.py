"""Column-level building blocks (pure ``Column -> Column``, JVM-side)."""

from wardwatch.functions.clinical import (  # noqa: F401
    abnormal_vitals_count,
    bp_status,
    has_alert,
    heart_rate_status,
    in_range_or_null,
    risk_level,
    risk_rank,
    spo2_status,
    temperature_status,
)
from wardwatch.functions.rounding import half_up_div, rounded_mean  # noqa: F401
from wardwatch.functions.time import (  # noqa: F401
    boundaries_between,
    ntz_literal,
    to_event_time,
    trunc_ntz,
)
