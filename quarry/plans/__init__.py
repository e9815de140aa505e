"""Job plans: the runner, SQL-file and Python transforms, the reports and
the registered queries."""

from quarry.plans.job import (  # noqa: F401
    PyTransform,
    TRANSFORMS,
    explain_job,
    read_sql_text,
    run,
    run_dates,
    run_job,
    sql_transform,
    transform,
    transform_function,
    validate_job,
)
