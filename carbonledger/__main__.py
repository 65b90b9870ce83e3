"""Command line: run a question, or materialise a star schema.

    python -m carbonledger list
    python -m carbonledger run <query> --data <dir> [--out <dir>] [--show N]
    python -m carbonledger star --data <dir> --out <dir> [--from 1998-01-01 --to 1998-12-31]
    python -m carbonledger raw-star --drops <dir> --gazetteer <csv> --out <dir> [--impacts <csv>] [--personnel <glob>]

Under ``spark-submit`` the cluster's session (and its ``spark.checkpoint.dir``)
is used as configured; run directly it starts a local session.  Results are
written as Parquet (``--out``) or shown; nothing is collected beyond ``--show``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import local_session
    return local_session()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="carbonledger")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered queries")
    run = sub.add_parser("run", help="run one registered query")
    run.add_argument("query")
    run.add_argument("--data", required=True, help="directory of the input tables")
    run.add_argument("--out", help="write the result as Parquet here")
    run.add_argument("--show", type=int, default=20)
    star = sub.add_parser("star", help="materialise the star schema from the input tables")
    star.add_argument("--data", required=True)
    star.add_argument("--out", required=True)
    star.add_argument("--from", dest="start")
    star.add_argument("--to", dest="end")
    raw = sub.add_parser("raw-star", help="materialise the star schema from raw daily drops")
    raw.add_argument("--drops", required=True)
    raw.add_argument("--gazetteer", required=True, help="';' CSV with city;country;lat;lon")
    raw.add_argument("--impacts", help="',' CSV with Type,Modèle,Impact")
    raw.add_argument("--personnel", help="glob of PERSONNEL_<SITE>.txt files")
    raw.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    from .plans.catalog import QUERIES
    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = _session()
    if args.cmd == "run":
        if args.query not in QUERIES:
            print(f"unknown query {args.query!r}; see 'list'", file=sys.stderr)
            return 2
        df = QUERIES[args.query](spark, args.data)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(args.show, truncate=False)
        return 0
    if args.cmd == "star":
        from .plans.model import DriverModel
        from .plans.star import write_star_schema
        window = (args.start, args.end) if args.start and args.end else None
        print("\n".join(write_star_schema(DriverModel(spark, args.data), args.out, window)))
        return 0
    from .plans.raw_model import RawModel
    from .plans.star import write_raw_star_schema
    from .sources.raw import read_impacts, read_personnel
    gaz = (spark.read.option("header", True).option("sep", ";")
           .schema("city string, country string, lat double, lon double").csv(args.gazetteer))
    model = RawModel(spark, args.drops, gazetteer=gaz,
                     impacts_df=read_impacts(spark, args.impacts) if args.impacts else None,
                     personnel=read_personnel(spark, args.personnel) if args.personnel else None)
    print("\n".join(write_raw_star_schema(model, args.out)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
