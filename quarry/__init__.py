"""quarry: config-driven batch data pipelines on Spark.

A job names its sources, one transform and its sinks; ``run`` executes
extract -> transform -> load for one run date or a backfill range. All data
work is expressed with DataFrames / Spark SQL and left to Catalyst.

Layout
------
sources/    readers: JDBC, catalog tables, Spark SQL, files
operators/  config steps, keyed merge (upsert), top-k
sinks/      console, table/file writers (append, overwrite, partition
            overwrite, upsert), JSON event payloads
functions/  run-date handling, safe column expressions from config text
plans/      job runner, SQL-file and Python transforms, the reports
streaming/  micro-batch adapter that reuses the sinks
"""

from quarry.plans.job import run, run_job, validate_job  # noqa: F401
from quarry.session import build_session, scratch_root, new_work_dir  # noqa: F401

__all__ = ["run", "run_job", "validate_job", "build_session", "scratch_root", "new_work_dir"]
