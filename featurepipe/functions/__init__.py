"""Column-level helpers (built-in Spark expressions only, no Python UDFs)."""

from featurepipe.functions.columns import (  # noqa: F401
    epoch_micros,
    is_late_night,
    is_weekend,
    ntz_from_micros,
    safe_ratio,
    sigmoid,
    to_instant,
    version_number,
)
from featurepipe.functions.joins import join_null_safe  # noqa: F401
