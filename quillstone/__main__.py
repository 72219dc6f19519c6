"""python -m quillstone QUERY FOLDER OUT: runs a query over a folder of tables and writes its result."""

from __future__ import annotations

import argparse

from quillstone.config import Settings
from quillstone.plans import claims, evidence, orders, store, training
from quillstone.runtime import session
from quillstone.sources.readers import batches, ordered
from quillstone.sources.writers import write_csv


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quillstone", description=__doc__)
    p.add_argument("query", choices=sorted(known()))
    p.add_argument("folder")
    p.add_argument("out", nargs="?", help="left out with --dry-run")
    p.add_argument("--format", choices=("parquet", "csv", "json"), default="parquet")
    p.add_argument("--since", help="keep rows of batches from this one on, where the result has batch_id")
    p.add_argument("--batch", help="keep rows of this batch only")
    p.add_argument("--order", help="columns to order by, parted by commas")
    p.add_argument("--limit", type=int, default=0, help="rows to keep in that order; 0 keeps all")
    p.add_argument("--dry-run", action="store_true", help="print the plan and write nothing")
    p.add_argument("--master", default="local[8]")
    p.add_argument("--shuffle-partitions", type=int, default=8)
    return p


def known() -> dict:
    return evidence.queries() | claims.queries() | store.queries() | orders.queries() | training.queries()


def main(argv: list[str] | None = None) -> None:
    p = parser()
    a = p.parse_args(argv)
    if a.since and a.batch:
        p.error("--since and --batch cannot be used together")
    if not a.out and not a.dry_run:
        p.error("OUT is needed unless --dry-run is given")
    Settings.from_env()  # what is set wrongly shows before anything runs
    rows = known()[a.query](session(a.master, a.shuffle_partitions), a.folder)
    if a.since or a.batch:
        rows = batches(rows, since=a.since, exactly=a.batch)
    if a.limit and not a.order:
        p.error("--limit needs --order")
    if a.order:
        rows = ordered(rows, a.order.split(","), a.limit)
    if a.dry_run:
        rows.explain("formatted")
    elif a.format == "csv":
        print(write_csv(rows, a.out), "rows")
    else:
        rows.write.mode("overwrite").format(a.format).save(a.out)


if __name__ == "__main__":
    main()
