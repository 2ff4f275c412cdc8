"""Run declared jobs with spark-submit or python.

    python tools/run_job.py --log PATH [--fit-mode raw] [--exact-split] [--skip-unsupported] [--time-stages] config.json [config.json ...]

Several configurations go into the same log and are compared at the end.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tabmill.plans import job  # noqa: E402


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("configs", nargs="+")
    parser.add_argument("--log", required=True, help="folder of the run log")
    parser.add_argument("--fit-mode", choices=("chained", "raw"), default="chained")
    parser.add_argument("--exact-split", action="store_true")
    parser.add_argument("--skip-unsupported", action="store_true", help="go on without models MLlib cannot express")
    parser.add_argument("--time-stages", action="store_true", help="run stage by stage, so that each has a time of its own")
    args = parser.parse_args(argv)
    configs = []
    for path in args.configs:
        with open(path) as f:
            configs.append(json.load(f))
    spark = SparkSession.builder.appName("tabmill-job").getOrCreate()
    unsupported = "skip" if args.skip_unsupported else "raise"
    timers = "stages" if args.time_stages else "job"
    out = job.run_sweep(
        spark, configs, args.log, fit_mode=args.fit_mode, exact=args.exact_split, unsupported=unsupported, timers=timers
    )
    out.orderBy("key", "value", "intent").show(1000, truncate=False)


if __name__ == "__main__":
    main()
