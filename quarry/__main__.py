"""Run a job config.

    python -m quarry JOB.json [--run-date YYYY-MM-DD] [--set name=value ...] [--explain] [--hive]

``{{name}}`` in the config text is replaced by ``--set`` values (paths,
database names), so one config serves several environments. A config on
shared storage (``s3a://``, ``hdfs://``, ...) is read through Spark.
"""

from __future__ import annotations

import argparse
import json
import re
import sys

from quarry.plans import reports  # noqa: F401  (registers the Python transforms)
from quarry.plans.job import explain_job, run, run_dates
from quarry.session import build_session


def load_config(spark, path: str, variables: dict[str, str] | None = None) -> dict:
    if re.match(r"^[a-z][a-z0-9+.-]*://", path) and not path.startswith("file://"):
        text = spark.read.text(path, wholetext=True).first()[0]
    else:
        with open(path.removeprefix("file://")) as f:
            text = f.read()
    for name, value in (variables or {}).items():
        text = text.replace("{{" + name + "}}", value)
    missing = sorted(set(re.findall(r"\{\{(\w+)\}\}", text)))
    if missing:
        raise ValueError(f"config {path} needs --set for {missing}")
    return json.loads(text)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quarry", description=__doc__.splitlines()[0])
    parser.add_argument("config")
    parser.add_argument("--run-date", default=None)
    parser.add_argument("--resume-from", default=None, help="skip backfill dates before this one")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--explain", action="store_true",
                        help="print the physical plan of every output instead of writing")
    parser.add_argument("--hive", action="store_true", help="use the deployment's Hive metastore as catalog")
    args = parser.parse_args(argv)
    variables = dict(item.split("=", 1) for item in args.set)
    spark = build_session(hive=args.hive)
    conf = load_config(spark, args.config, variables)
    if args.explain:
        # the plan of one run: the date given, else the job's first run date
        run_date = args.run_date or run_dates(conf)[0]
        for name, plan in explain_job(spark, conf, run_date).items():
            print(f"== {name} ==\n{plan}")
        return 0
    resume = int(args.resume_from) if args.resume_from and args.resume_from.isdigit() else args.resume_from
    dates = run(spark, conf, args.run_date, resume_from=resume)
    print(json.dumps({"config": args.config, "run_dates": [str(d) for d in dates]}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
