"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from zonelake.functions.scalar import (  # noqa: F401
    hour_of, ordinal, ratio, round_half_up_int, route_label, row_argmax, safe_cast,
    safe_timestamp, time_of_day, to_bool, weekday_name,
)
from zonelake.functions.aggregates import (  # noqa: F401
    rounded_mean, sum_or_zero,
)
from zonelake.functions.totals import grouped  # noqa: F401
