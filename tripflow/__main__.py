"""Command line: run the report over a trip directory."""

from __future__ import annotations

import argparse

from tripflow.constants import DEFAULT_GRID_ZONES, RESULT_DATABASE
from tripflow.plans.report import run_report
from tripflow.session import create_session
from tripflow.sinks import FORMATS, TableStore


def main() -> None:
    parser = argparse.ArgumentParser(prog="tripflow", description=__doc__)
    parser.add_argument("trips", help="directory of trip Parquet files")
    parser.add_argument("out", help="directory for exports, on shared storage")
    parser.add_argument("--lookup", help="zone lookup CSV")
    parser.add_argument("--boxes", help="zone bounding-box CSV")
    parser.add_argument("--grid-zones", type=int, default=DEFAULT_GRID_ZONES)
    parser.add_argument("--curated", help="also write the curated trips here")
    parser.add_argument("--store", help="also store the result tables below this location, in versions")
    parser.add_argument("--format", default="csv", choices=list(FORMATS))
    parser.add_argument("--null-duration", default="drop", choices=["drop", "keep"])
    parser.add_argument("--unmatched", default="keep", choices=["keep", "drop"], help="trips outside all zones")
    parser.add_argument("--no-profile", action="store_true", help="skip the quality tables")
    args = parser.parse_args()

    spark = create_session()
    report = run_report(
        spark,
        args.trips,
        args.out,
        lookup_path=args.lookup,
        boxes_path=args.boxes,
        num_zones=args.grid_zones,
        curated_path=args.curated,
        store=TableStore(RESULT_DATABASE, args.store, versioned=True) if args.store else None,
        format=args.format,
        null_duration=args.null_duration,
        unmatched=args.unmatched,
        profile=not args.no_profile,
    )
    report.tables["summary"].show(truncate=False, vertical=True)
    for name, target in report.exports.items():
        print(f"{name}: {target}")
    for name, status in report.stored.items():
        print(f"store {name}: {status}")
    spark.stop()


if __name__ == "__main__":
    main()
