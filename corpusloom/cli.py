"""Commands: ``python -m corpusloom.cli enrich|queue ...``.  Failures end with a message and status 1."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from corpusloom.operators.queue_store import QueueStore
from corpusloom.operators.work_queue import BATCH, MARKS
from corpusloom.operators.provider import stub_gradient
from corpusloom.operators.recover import outcome_counts
from corpusloom.plans.flows import enrich_catalog, fetch_missing, recover_failed, remaining_commands, run_commands, run_rest
from corpusloom.session import session
from corpusloom.sources import files
from corpusloom.sources.web import PAUSE_S


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    e = sub.add_parser("enrich", help="merge reports onto a catalog")
    e.add_argument("catalog")
    e.add_argument("themes")
    e.add_argument("tiers", nargs="+", metavar="tier=folder", help="folders of gradient reports, first tier first")
    e.add_argument("--out", required=True)
    e.add_argument("--dry-run", action="store_true")
    f = sub.add_parser("fetch", help="fetch the documents of a catalog that are not there")
    f.add_argument("catalog")
    f.add_argument("folder", help="where documents are, as one file each")
    f.add_argument("--log", required=True, help="the log of outcomes, as JSON")
    f.add_argument("--api-base")
    f.add_argument("--pause", type=float, default=PAUSE_S)
    r = sub.add_parser("recover", help="say where to look for documents that failed")
    r.add_argument("catalog")
    r.add_argument("log", help="the log that fetch wrote")
    r.add_argument("--index", required=True, help="links by author, in Parquet: pope, pos, text, url")
    r.add_argument("--out", required=True)
    w = sub.add_parser("run-remaining", help="reset stale items, run what is pending, show the status")
    w.add_argument("folder")
    w.add_argument("--sources", required=True)
    w.add_argument("--reports", required=True)
    w.add_argument("--init", action="store_true", help="make the queue first")
    w.add_argument("--limit", type=int)
    w.add_argument("--concurrency", type=int, default=5)
    w.add_argument("--dry-run", action="store_true")
    q = sub.add_parser("queue", help="a work queue in a folder")
    q.add_argument("folder")
    q.add_argument("action", choices=("init", "status", "sync", "reset-stale", "next-batch", "mark"))
    q.add_argument("--sources")
    q.add_argument("--reports")
    q.add_argument("--force", action="store_true")
    q.add_argument("--size", type=int, default=BATCH)
    q.add_argument("--id", type=int)
    q.add_argument("--status", choices=MARKS)
    q.add_argument("--error")
    q.add_argument("--agent")
    return p


def enrich(spark, a) -> None:
    catalog = files.read_csv(spark, a.catalog)
    tiers = None
    for pair in a.tiers:
        tier, _, folder = pair.partition("=")
        own = files.read_texts(spark, folder).select(F.lit(tier).alias("tier"), "name", "text")
        tiers = own if tiers is None else tiers.unionByName(own)
    rows, stats, buckets = enrich_catalog(catalog, files.read_texts(spark, a.themes), tiers)
    files.write_csv(rows, a.out, [c for c in rows.columns if c != "row_pos"], dry_run=a.dry_run)
    stats.show(truncate=False)
    buckets.select("bucket", "total", "gradients_full").show(truncate=False)


def queue(spark, a) -> None:
    store = QueueStore(spark, a.folder)

    def reports():
        found = files.list_files(spark, a.reports)
        return found.select(F.col("name").alias("report_file"), "size")

    if a.action == "init":
        store.init(files.list_files(spark, a.sources).select("name"), reports(), a.force)
    elif a.action == "sync":
        print(store.sync(reports()))
    elif a.action == "reset-stale":
        print(store.reset_stale(reports()))
    elif a.action == "next-batch":
        taken = store.next_batch(a.size)
        print("\n".join(f"{r.id}\t{r.source_file}\t{r.report_file}" for r in taken) or "nothing is pending")
    elif a.action == "mark":
        store.mark(a.id, a.status, a.error, a.agent)
    if a.action in ("init", "status"):
        for df in store.status():
            df.show(truncate=False)


def fetch(spark, a) -> None:
    there = files.list_files(spark, a.folder) if files.exists(spark, a.folder) else spark.createDataFrame([], "name string, size long")
    documents, log = fetch_missing(files.read_catalog(spark, a.catalog), there, api_base=a.api_base, pause=a.pause)
    files.export_markdown(documents, a.folder)
    files.write_json(log, a.log)
    outcome_counts(log).show()


def recover(spark, a) -> None:
    failed = files.read_json(spark, a.log, "outcome string, file string, link string, error string").filter("outcome = 'failed'")
    plan = recover_failed(files.read_catalog(spark, a.catalog), failed, spark.read.parquet(a.index), spark)
    files.write_json(plan, a.out)
    plan.groupBy("action").count().show()


def run_remaining(spark, a, provider=stub_gradient) -> list[str]:
    store = QueueStore(spark, a.folder)

    def reports():
        found = files.list_files(spark, a.reports) if files.exists(spark, a.reports) else spark.createDataFrame([], "name string, size long")
        return found.select(F.col("name").alias("report_file"), "size")

    def run(name: str, options: dict) -> int:
        if name == "reset_stale":
            if not options.get("dry_run"):
                store.reset_stale(reports())
        elif name == "run":
            if not options["dry_run"]:
                run_rest(store, a.sources, a.reports, provider, limit=options.get("limit"), concurrency=options["concurrency"])
        else:
            for df in store.status():
                df.show(truncate=False)
        return 0

    if a.init:
        store.init(files.list_files(spark, a.sources).select("name"), reports())
    commands = [(n, {**o, "dry_run": a.dry_run}) if n == "reset_stale" else (n, o) for n, o in remaining_commands(a.limit, a.concurrency, a.dry_run)]
    return run_commands(commands, run)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = session()
    try:
        {"enrich": enrich, "queue": queue, "fetch": fetch, "recover": recover, "run-remaining": run_remaining}[a.command](spark, a)
    except Exception as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
