"""Expression-level helpers: run dates and config expressions."""

from quarry.functions.expressions import (  # noqa: F401
    as_column,
    bind_run_date,
    config_value,
    pyspark_expression,
    substitute_run_date,
)
from quarry.functions.rundate import (  # noqa: F401
    date_range,
    date_spine,
    default_run_date,
    int_range,
    int_spine,
    run_date_literal,
)
