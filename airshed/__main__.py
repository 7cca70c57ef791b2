"""Run the layers from the command line.

    python -m airshed --input 'landing/*.csv' --root lake/air [--run-date 2024-03-31]

Writes Bronze, Silver (+ quarantine) and Gold under ``--root``, prints the run
log, and exits with status 1 when a stage failed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from airshed.layers import LayerPaths, run_layers
from airshed.operators.checks import run_log_checks
from airshed.session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="airshed", description=__doc__.split("\n\n")[0])
    ap.add_argument("--input", required=True, help="CSV file, folder or glob")
    ap.add_argument("--root", required=True, help="folder for bronze/, silver/, quarantine/, gold/")
    ap.add_argument("--run-date", type=dt.date.fromisoformat, default=None,
                    help="date of the quarantine folder (default: today)")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    log = run_layers(spark, LayerPaths(args.root), csv_input=args.input, run_date=args.run_date)
    log.show(truncate=False)
    ok = all(r.status == "success" for r in log.collect())
    if ok:
        run_log_checks(log).show(truncate=False)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
