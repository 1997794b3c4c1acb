"""spark-submit entry point.

    spark-submit pathfold/cli.py paths   --projectID=3 --date_start=... (all 11 options)
    spark-submit pathfold/cli.py paths-v3 ... | paths-null ...
    spark-submit pathfold/cli.py pivot   ... (same options; output_path is a prefix)
    spark-submit pathfold/cli.py top     config.json

Optional for paths / pivot:
    --single_file=true      write each report as one file
    --by_window=true        write each path report as the partition of its window (paths only)
    --heavy_share=K         cut histories where a client has more than 1/K of all hits
    --heavy_rows=N          and with more than N hits (default 50000)
    --channel_numbers=true  shuffle channels and paths as numbers (large logs)
    --day_partition=COL     the log is partitioned by day in COL: read only the days needed
    --day_format=FMT        format of COL if it isn't a date, e.g. yyyyMMdd

Optional for every command:
    --zone=ZONE             zone in which the days begin (default Europe/Moscow), e.g. UTC or +03:00
"""
from __future__ import annotations

import os
import sys

if __package__ in (None, ""):
    # run as a script (spark-submit pathfold/cli.py): make the package importable;
    # only the driver needs it - every operator runs as built-in Spark SQL
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from pathfold.params import JobParams, parse_cli_options  # noqa: E402
from pathfold.plans import jobs  # noqa: E402
from pathfold.sources import read_config  # noqa: E402

COMMANDS = {"paths": "canonical", "paths-v3": "v3", "paths-null": "null"}


def main(argv: list[str]) -> int:
    if not argv:
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName("pathfold").getOrCreate()
    cmd, rest = argv[0], argv[1:]
    options = parse_cli_options(rest)
    single = options.pop("single_file", "false").strip().lower() == "true"
    by_window = options.pop("by_window", "false").strip().lower() == "true"
    tuning = {k: options.pop(k).strip() for k in ("day_partition", "day_format", "zone") if k in options}
    tuning |= {k: int(options.pop(k)) for k in ("heavy_share", "heavy_rows") if k in options}
    tuning |= {"channel_numbers": True} if options.pop("channel_numbers", "false").strip().lower() == "true" else {}
    if cmd in COMMANDS:
        strict = cmd == "paths"
        params = JobParams.from_options(options, strict_dates=strict, **tuning)
        diagnostics = jobs.path_reports(spark, params, jobs.PATH_VARIANTS[COMMANDS[cmd]],
                                        single_file=single, by_window=by_window)
        for df in diagnostics.values():
            df.show()
    elif cmd == "pivot":
        params = JobParams.from_options(options, strict_dates=False, **tuning)
        jobs.pivot_report(spark, params, single_file=single)
    elif cmd == "top":
        params = read_config(spark, rest[0], **{k: v for k, v in tuning.items() if k in ("zone", "heavy_share", "heavy_rows", "channel_numbers")})
        jobs.top_paths_report(spark, params).show(truncate=False)
    else:
        print(__doc__)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
