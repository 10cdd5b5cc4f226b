"""Command line: ``python -m martline <command>``.

  rebuild --sf DIR --out DIR [--csv DIR]   write facts, dimensions, marts and quality rows (full rebuild)
  rebuild --raw DIR --airports FILE --web-drop FILE FIRST LAST --out DIR   the same from a folder of raw CSV extracts
  types PATH [PATH ...]          column types of CSV files, inferred from all values
  query NAME [--sf DIR] [--out DIR]   run one registered query; show it or write it as parquet
  check [--sf DIR]               run the data-quality suite and print the summary
  profile PATH [PATH ...]        inventory, drift and overlap reports of raw CSV extracts
  list                           list the registered queries
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="martline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("rebuild")
    r.add_argument("--sf", default="/root/testdata/sf0.01")
    r.add_argument("--out", required=True)
    r.add_argument("--csv", help="also export the published tables as sorted CSV under this folder")
    r.add_argument("--strict", action="store_true", help="fail when a quality check fails")
    r.add_argument("--publish", help="also copy facts and dimensions to this folder, verified")
    r.add_argument("--raw", help="folder of raw CSV extracts to build from, instead of --sf")
    r.add_argument("--airports", help="CSV of airports (iata_code, name, municipality, iso_country, and state or iso_region), with --raw")
    r.add_argument("--web-drop", nargs=3, metavar=("FILE", "FIRST", "LAST"), help="web extract whose rows of these days another one has too, with --raw")
    ty = sub.add_parser("types")
    ty.add_argument("paths", nargs="+", help="CSV files, folders or globs")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf", default="/root/testdata/sf0.01")
    q.add_argument("--out")
    c = sub.add_parser("check")
    c.add_argument("--sf", default="/root/testdata/sf0.01")
    pr = sub.add_parser("profile")
    pr.add_argument("paths", nargs="+", help="CSV files or folders of CSV files")
    sub.add_parser("list")
    args = ap.parse_args(argv)
    if args.cmd == "rebuild" and args.raw and not (args.airports and args.web_drop):
        ap.error("--raw needs --airports and --web-drop")

    from martline import registry
    if args.cmd == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return 0
    from pyspark.sql import SparkSession

    from martline.session import build_session
    owned = SparkSession.getActiveSession() is None  # stop only a session started here
    spark = build_session(app=f"martline-{args.cmd}")
    try:
        if args.cmd == "rebuild":
            from martline.plans.rebuild import airports_of, rebuild, rebuild_from_csv
            if args.raw:
                paths = rebuild_from_csv(spark, args.raw, airports_of(spark, args.airports), tuple(args.web_drop), args.out, args.csv, args.strict, args.publish)
            else:
                paths = rebuild(spark, args.sf, args.out, args.csv, args.strict, args.publish)
            for name, path in sorted(paths.items()):
                print(f"{name}\t{path}")
        elif args.cmd == "types":
            from martline.sources.files import read_source
            from martline.sources.infer import infer_types
            for name, kind in infer_types(read_source(spark, args.paths), "_source_file").items():
                print(f"{name}\t{kind}")
        elif args.cmd == "query":
            df = registry.QUERIES[args.name](spark, args.sf)
            if args.out:
                df.write.mode("overwrite").parquet(args.out)
            else:
                df.show(50, truncate=False)
        elif args.cmd == "profile":
            import glob
            import os
            from martline.plans.profile import profile_files
            files = []
            for p in args.paths:
                files += sorted(glob.glob(os.path.join(p, "*.csv"))) if os.path.isdir(p) else [p]
            for name, df in profile_files(spark, files).items():
                print(f"== {name}")
                df.show(200, truncate=False)
        elif args.cmd == "check":
            registry.QUERIES["dq_summary"](spark, args.sf).show(truncate=False)
    finally:
        if owned:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
