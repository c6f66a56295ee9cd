"""Command-line entry points for the scheduled jobs (``python -m
bottomgrid.cli ...``, or ``bottomgrid_job.py`` under spark-submit).

    python -m bottomgrid.cli step1  --landing L --grid G --raster R --staged S --run-log LOG [--date D] [--full]
                                    [--gmgi CSV] [--study-fleet CSV] [--doi DOI] [--seabed-threshold M]
                                    [--run-id ID] [--parallel-feeds N]
    python -m bottomgrid.cli step2  --staged S --product P --archive A --catalogue C --diagnostics D
                                    [--version V] [--doi DOI] [--reload-type T] [--catalogue-csv CSV] [--run-id ID]
    python -m bottomgrid.cli stream --staged S --product P [--checkpoint CK] [--max-files N]
    python -m bottomgrid.cli refresh --staged S --product P [--date D] [--full]

Paths are anything Spark can read (HDFS, object store, local). The session
comes from spark-submit / the cluster; missing settings get the library
defaults (session.DEFAULT_CONF).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from .session import build_session


def _date(s: str | None) -> dt.date:
    return dt.date.fromisoformat(s) if s else dt.datetime.now(dt.timezone.utc).date()


def main(argv: list[str] | None = None, spark=None) -> dict:
    ap = argparse.ArgumentParser(prog="bottomgrid")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s1 = sub.add_parser("step1", help="fetch-and-stage (C12)")
    for a in ("--landing", "--grid", "--raster", "--staged", "--run-log"):
        s1.add_argument(a, required=True)
    s1.add_argument("--date")
    s1.add_argument("--full", action="store_true")
    s1.add_argument("--gmgi")
    s1.add_argument("--study-fleet")
    s1.add_argument("--version", default="1")
    s1.add_argument("--doi", default="")
    s1.add_argument("--seabed-threshold", type=float)
    s1.add_argument("--run-id", help="of the first try, when a job is tried again")
    s1.add_argument("--parallel-feeds", type=int, default=4)
    s2 = sub.add_parser("step2", help="aggregate-and-publish (C13)")
    for a in ("--staged", "--product", "--archive", "--catalogue", "--diagnostics"):
        s2.add_argument(a, required=True)
    s2.add_argument("--version", default="1")
    s2.add_argument("--doi", help="default: what step 1 handed over")
    s2.add_argument("--reload-type", help="default: what step 1 handed over")
    s2.add_argument("--catalogue-csv")
    s2.add_argument("--run-id", help="of the first try, when a job is tried again")
    st = sub.add_parser("stream", help="publish touched days as staged files land (T1)")
    st.add_argument("--staged", required=True)
    st.add_argument("--product", required=True)
    st.add_argument("--checkpoint", help="default: beside the product")
    st.add_argument("--max-files", type=int, default=1000)
    rf = sub.add_parser("refresh", help="recompute the refresh window (T2)")
    rf.add_argument("--staged", required=True)
    rf.add_argument("--product", required=True)
    rf.add_argument("--date")
    rf.add_argument("--full", action="store_true")
    args = ap.parse_args(argv)
    spark = spark or build_session(app=f"bottomgrid-{args.cmd}")

    if args.cmd == "step1":
        from .plans.runs import run_step1
        from .sources.dims import read_grid, read_raster
        from .sources.feeds import SIDELOAD_SCHEMA
        side = {}
        for name, path in (("gmgi", args.gmgi), ("study_fleet", args.study_fleet)):
            if path:
                side[name] = spark.read.schema(SIDELOAD_SCHEMA).option("header", True).csv(path)
        _, raster = read_raster(spark, args.raster)
        res = run_step1(spark, args.landing, read_grid(spark, args.grid), raster, _date(args.date),
                        args.staged, args.run_log, version=args.version, sideloads=side,
                        force_full=args.full, doi=args.doi, run_id=args.run_id, parallel=args.parallel_feeds,
                        **({} if args.seabed_threshold is None else {"seabed_threshold": args.seabed_threshold}))
        out = {"reload_type": res.reload_type, "start": str(res.start), "statuses": res.statuses}
    elif args.cmd == "step2":
        from .plans.runs import run_step2
        days = run_step2(spark, args.staged, args.product, args.archive, args.catalogue,
                         args.diagnostics, version=args.version, reload_type=args.reload_type,
                         doi=args.doi, catalogue_csv=args.catalogue_csv, run_id=args.run_id)
        out = {"days_published": len(days)}
    elif args.cmd == "stream":
        from .streaming.publish_stream import publish_stream
        publish_stream(spark, args.staged, args.product, args.checkpoint, max_files=args.max_files).awaitTermination()
        out = {"stream": "done"}
    else:
        from .streaming.publish_stream import refresh
        out = {"days_published": len(refresh(spark, args.staged, args.product, _date(args.date), args.full))}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
