"""Command line: the pipeline's entry points.

    python -m gridmart ingest    --landing DIR --root DIR [--start YYYY-MM-DD --end YYYY-MM-DD]
    python -m gridmart build     --root DIR [--full-refresh]
    python -m gridmart test      --root DIR            # 17 data tests + source freshness
    python -m gridmart export    --root DIR --out DIR  # serving extracts of the published marts
    python -m gridmart report    NAME --root DIR [--as-of YYYY-MM-DD]
    python -m gridmart catalogue --file PATH [TEXT]    # indicator catalogue search

``ingest`` exits 1 when any indicator failed (the others still load); ``test``
exits 1 on a failing data test or a freshness error. ``ingest`` and ``build``
publish the marts when they have changed; ``report`` and ``export`` read the
published ones. The window is manual when
both dates are given (end day included), else the automatic two-day overlap.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _session(args):
    from gridmart.session import build_session

    return build_session(master=args.master)


def cmd_ingest(args) -> int:
    from gridmart.functions.calendar import utc_literal
    from gridmart.operators import ingest
    from gridmart.plans import catalog, warehouse
    from gridmart.sources import payload

    spark = _session(args)
    start, end = ingest.extraction_window(args.start, args.end)
    work = warehouse.work_folder(spark, "landing")
    items = payload.read_items(spark, args.landing, not args.json_lines, start.date(), work=work)
    # Items with a valid time outside the run's window are not part of this run;
    # items whose time is unreadable stay, so they still reject their indicator.
    at = ingest.item_time(items)
    items = items.where(at.isNull() | ((at >= utc_literal(start)) & (at < utc_literal(end))))
    layout = warehouse.Layout(args.root)
    try:
        result = warehouse.ingest_items(spark, items, layout)
    finally:
        warehouse.remove_work(spark, work)
    if not args.no_build:
        warehouse.refresh_marts(spark, layout, result.changed_days)
        catalog.ensure_published(spark, layout)
    print(json.dumps({"window": [str(start), str(end)], "status": result.status, "checks": result.checks,
                      "counts": result.counts, "changed_days": [str(d) for d in result.changed_days]},
                     default=str))
    return result.status


def cmd_build(args) -> int:
    from gridmart.plans import catalog, warehouse

    spark, layout = _session(args), warehouse.Layout(args.root)
    warehouse.refresh_marts(spark, layout, None)
    catalog.ensure_published(spark, layout)
    return 0


def cmd_export(args) -> int:
    from gridmart.plans import catalog, warehouse
    from gridmart.sources import tables

    spark, layout = _session(args), warehouse.Layout(args.root)
    folder = catalog.ensure_published(spark, layout)
    written = tables.export_marts(spark, {n: f"{folder}/{n}" for n in warehouse.MART_NAMES}, args.out)
    print(json.dumps(written))
    return 0


def cmd_test(args) -> int:
    from gridmart.plans import warehouse

    spark = _session(args)
    checks, fresh = warehouse.checks_report(spark, warehouse.Layout(args.root))
    rows = [r.asDict() for r in checks.collect()]  # 17 rows
    f = fresh.first().asDict()
    print(json.dumps({"tests": rows, "freshness": f}, default=str))
    failed = any(r["failures"] for r in rows) or f["status"] == "error"
    return 1 if failed else 0


def _print(df, args, what: str = "rows") -> None:
    """All rows, tab separated (or the first ``--rows`` where asked for), partition by partition;
    with ``--out`` written as Parquet instead."""
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
        return
    print("\t".join(df.columns))
    n = 0
    for n, row in enumerate(df.limit(args.rows).toLocalIterator() if args.rows else df.toLocalIterator(), 1):
        print("\t".join("" if v is None else str(v) for v in row))
    print(f"{n} {what}.")


def cmd_report(args) -> int:
    from gridmart.plans import catalog, warehouse

    spark = _session(args)
    catalog.register(spark, warehouse.Layout(args.root), db=args.db)
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
    _print(catalog.report(spark, args.name, db=args.db, as_of=as_of), args)
    return 0


def cmd_catalogue(args) -> int:
    from gridmart.sources import payload

    spark = _session(args)
    entries = payload.explode_catalogue(payload.read_catalogue_files(spark, args.file))
    _print(payload.search_catalogue(entries, args.text), args, "indicators matched")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gridmart")
    p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--landing", required=True)
    i.add_argument("--root", required=True)
    i.add_argument("--start")
    i.add_argument("--end")
    i.add_argument("--json-lines", action="store_true", help="landed files hold one document per line")
    i.add_argument("--no-build", action="store_true", help="skip the mart refresh")
    b = sub.add_parser("build")
    b.add_argument("--root", required=True)
    e = sub.add_parser("export")
    e.add_argument("--root", required=True)
    e.add_argument("--out", required=True)
    t = sub.add_parser("test")
    t.add_argument("--root", required=True)
    r = sub.add_parser("report")
    r.add_argument("name")
    r.add_argument("--root", required=True)
    r.add_argument("--db", default="analytics_marts")
    r.add_argument("--as-of")
    r.add_argument("--rows", type=int, help="print only so many rows")
    r.add_argument("--out", help="write the report as Parquet instead of printing it")
    c = sub.add_parser("catalogue")
    c.add_argument("--file", required=True)
    c.add_argument("text", nargs="?")
    c.add_argument("--rows", type=int, help="print only so many rows")
    c.add_argument("--out", help="write the entries as Parquet instead of printing them")
    args = p.parse_args(argv)
    return {"ingest": cmd_ingest, "build": cmd_build, "test": cmd_test, "export": cmd_export, "report": cmd_report,
            "catalogue": cmd_catalogue}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
