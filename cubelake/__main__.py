"""Command line: ``python -m cubelake <group> <command> ...`` (or via spark-submit).

Groups and commands mirror the jobs of the package:

  db create        --registry PATH
  delta split      INFILE OUTDIR [--format parquet]
  delta merge      ORIGINAL DELTA NEWPATH [--keys vectorId,refPer] [--insert-new]
  full prepare     FILE [-o OUTDIR]
  full push        PATH --lake LAKE
  full delta       --changed ROOT --landing DIR --lake LAKE --registry PATH [-s DAY] [-e DAY] [-k ID ...]
  full delta-by-diff --catalog PATH --landing DIR --lake LAKE --registry PATH
                   [--start-from N] [--max-product-ids N] [-k ID ...]
  sql              LAKE PRODUCT_ID "SELECT ... FROM cube ..."

Downloads are not part of the package: catalogs, changed lists and cubes are
read from the given paths (any Hadoop file system).
"""

from __future__ import annotations

import argparse
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cubelake")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit / environment)")
    groups = p.add_subparsers(dest="group", required=True)

    db = groups.add_parser("db").add_subparsers(dest="cmd", required=True)
    c = db.add_parser("create")
    c.add_argument("--registry", required=True)

    delta = groups.add_parser("delta").add_subparsers(dest="cmd", required=True)
    c = delta.add_parser("split")
    c.add_argument("infile")
    c.add_argument("outfile")
    c.add_argument("--format", "-f", default="parquet")
    c = delta.add_parser("merge")
    c.add_argument("original")
    c.add_argument("delta")
    c.add_argument("new_path")
    c.add_argument("--keys", default="vectorId")
    c.add_argument("--insert-new", action="store_true")

    full = groups.add_parser("full").add_subparsers(dest="cmd", required=True)
    c = full.add_parser("prepare")
    c.add_argument("filename")
    c.add_argument("--outfile", "-o", default=None)
    c = full.add_parser("push")
    c.add_argument("path")
    c.add_argument("--lake", required=True)
    for name in ("delta", "delta-by-diff"):
        c = full.add_parser(name)
        c.add_argument("--landing", required=True)
        c.add_argument("--lake", required=True)
        c.add_argument("--registry", required=True)
        c.add_argument("--skip", "-k", type=int, action="append", default=[])
        if name == "delta":
            c.add_argument("--changed", required=True)
            c.add_argument("--start-date", "-s", default=None)
            c.add_argument("--end-date", "-e", default=None)
        else:
            c.add_argument("--catalog", required=True)
            c.add_argument("--multi-line", action="store_true", help="the catalog is pretty-printed JSON")
            c.add_argument("--start-from", type=int, default=0)
            c.add_argument("--max-product-ids", type=int, default=0)

    c = groups.add_parser("sql")
    c.add_argument("lake")
    c.add_argument("product_id", type=int)
    c.add_argument("query")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    from cubelake.session import get_spark

    spark = spark or get_spark(args.master)
    cmd = (args.group, getattr(args, "cmd", None))

    if cmd == ("db", "create"):
        from cubelake.sources.registry import ensure_registry

        ensure_registry(spark, args.registry)
    elif cmd == ("delta", "split"):
        from cubelake.plans.delta_jobs import split_delta

        split_delta(spark, args.infile, args.outfile, fmt=args.format)
    elif cmd == ("delta", "merge"):
        from cubelake.plans.delta_jobs import merge_delta

        keys = tuple(k.strip() for k in args.keys.split(",") if k.strip())
        merge_delta(spark, args.original, args.delta, args.new_path, keys=keys, insert_new=args.insert_new)
    elif cmd == ("full", "prepare"):
        from cubelake.plans.cube_etl import prepare_cube

        status = prepare_cube(spark, args.filename, args.outfile).collect()
        for s in status:
            print(f"{s.product_id}: {'ok' if s.ok else 'failed: ' + str(s.reason)} {s.layout or ''}")
        return 0 if status and all(s.ok for s in status) else 1
    elif cmd == ("full", "push"):
        from cubelake.plans.layout import push

        name = args.path.rstrip("/").rsplit("/", 1)[-1]
        push(spark, args.path, f"{args.lake.rstrip('/')}/{name}")
    elif cmd[0] == "full":
        from cubelake.operators.stats import status_counts
        from cubelake.plans.refresh import plan_changed, plan_refresh, refresh

        if cmd[1] == "delta":
            plan = plan_changed(spark, args.changed, args.start_date, args.end_date, skip=args.skip)
        else:
            plan = plan_refresh(
                spark, args.catalog, args.registry, args.start_from, args.max_product_ids, skip=args.skip,
                multi_line=args.multi_line,
            )
        status = refresh(spark, plan, args.landing, args.lake, args.registry)
        for s in status.where("NOT ok").collect():
            print(f"{s.product_id} failed ({s.reason}); going on with the rest")
        counts = status_counts(status).first()
        print(f"published {counts.succeeded} of {counts.planned} planned cubes")
    elif cmd[0] == "sql":
        from cubelake.sources.lake import query_cube

        query_cube(spark, args.lake, args.product_id, args.query).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
