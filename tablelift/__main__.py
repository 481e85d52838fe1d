"""python -m tablelift [export | replica-export | bench] --connectionUrl=... --output=... [options]

A session is taken from the environment (spark-submit, PYSPARK_SUBMIT_ARGS) or made with Spark's defaults."""

from __future__ import annotations

import logging
import sys

from tablelift import __version__
from tablelift.errors import exit_code


def run(arguments: list[str], spark=None) -> int:
    """The exit code; 0 if all went well."""
    try:
        from tablelift.plans import job
        from tablelift.plans.options import parse

        command, rest = ("export", arguments) if not arguments or arguments[0].startswith("--") else (arguments[0], arguments[1:])
        if command not in ("export", "replica-export", "bench"):
            raise ValueError(f"no command: {command}")
        options = parse(rest)
        options.check()
        if spark is None:
            from pyspark.sql import SparkSession

            spark = SparkSession.builder.appName(f"tablelift {__version__}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        if command == "bench":
            print(job.bench(spark, options)[1])
        else:
            (job.export if command == "export" else job.replica_export)(spark, options)
        return 0
    except Exception as e:
        logging.getLogger("tablelift").error("%s: %s", type(e).__name__, e)
        return exit_code(e)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    sys.exit(run(sys.argv[1:]))
