"""Column-level helpers: every function returns a built-in Spark expression (no Python UDF)."""

from martforge.functions.columns import (  # noqa: F401
    exact_measure,
    fits_scale,
    growth_pct,
    int_castable,
    matches_pattern,
    share_pct,
)
from martforge.functions.ids import dense_index  # noqa: F401
from martforge.functions.sizing import checked_broadcast  # noqa: F401
