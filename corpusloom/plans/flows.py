"""Whole flows: enrichment of a catalog, fetching of documents, second attempts, the work queue."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.html import html_markdown, page_body
from corpusloom.functions.scalars import text_or_empty
from corpusloom.operators import catalog as catalog_ops
from corpusloom.operators import match, merge, naming, prompt, recover
from corpusloom.operators.provider import call
from corpusloom.sources import files, posts, web


def enrich_catalog(catalog: DataFrame, theme_files: DataFrame, tier_files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The enriched catalog, one row of counts, counts by bucket.

    ``catalog`` with ``row_pos``; ``theme_files``: ``name, text``; ``tier_files``: ``tier, name, text``.  Files are parsed
    once; a tier's file of least priority that is there stands for the tier, valid or not.
    """
    named = naming.unique_stems(catalog)
    themes = merge.theme_fields(merge.reports_by_stem(theme_files))
    keyed = tier_files.withColumn("_key", F.explode(merge.report_keys(F.col("name")))).select("tier", "name", "text", "_key.*")
    tiers = match.first_by(keyed, ["tier", "stem"], "priority", "name")
    enriched = merge.enrich(named, themes, merge.first_tier(tiers))
    return merge.projected(enriched), merge.coverage(enriched), merge.by_bucket(enriched)


def enrich_and_publish(catalog: DataFrame, theme_files: DataFrame, tier_files: DataFrame, path: str, dry_run: bool = False) -> tuple[dict[str, int], list[tuple[int, str, int, int]]]:
    """As :func:`enrich_catalog`, written to a folder (:func:`files.publish_csv`) and counted on the way: counts, and counts by bucket.  A dry run counts and writes nothing."""
    named = naming.unique_stems(catalog)
    themes = merge.theme_fields(merge.reports_by_stem(theme_files))
    keyed = tier_files.withColumn("_key", F.explode(merge.report_keys(F.col("name")))).select("tier", "name", "text", "_key.*")
    tiers = match.first_by(keyed, ["tier", "stem"], "priority", "name")
    rows, watch = merge.observed(merge.enrich(named, themes, merge.first_tier(tiers)))
    if dry_run:
        rows.write.format("noop").mode("overwrite").save()
    else:
        out = merge.projected(rows)
        files.publish_csv(out, path, [c for c in out.columns if c != "row_pos"])
    counts = watch.get
    return {k: v for k, v in counts.items() if not k.startswith(("total_", "full_"))}, merge.observed_buckets(counts)


def fetch_catalog(catalog: DataFrame, present: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents to write (``filename, text``) and the log (``outcome, file, link, error``).

    ``present``: ``name, size`` of files there are; ``pages``: ``link, html, via, error`` as :func:`web.fetch` returns it.
    Documents that are there are not asked for twice: join ``pages`` lazily to rows that are left.
    """
    named = naming.unique_stems(catalog, strip_html=True).withColumn("file", F.concat("stem", F.lit(".md")))
    flagged = named.join(present.select(F.col("name").alias("file"), "size"), "file", "left").withColumn("_there", files.fetched())
    skipped = flagged.filter("_there").select(F.lit("skipped").alias("outcome"), "file", "link", F.lit(None).cast("string").alias("error"))
    got = flagged.filter("not _there").join(pages, "link", "left")
    from_page = page_body(F.col("html"), F.col("link"))
    body = F.when(F.col("via") == "api", F.struct(html_markdown(F.col("html")).alias("value"), F.lit(None).cast("string").alias("error"))).otherwise(from_page)
    made = got.withColumn("_body", body).withColumn("_error", F.coalesce("error", "_body.error", F.when(F.length("_body.value") < 100, "Extracted body too short")))
    row = {c: F.col(c) for c in ("title", "subtitle", "pope", "published_date", "doc_type")} | {"source": text_or_empty("link")}
    ok = made.filter("_error is null and _body.value is not null")
    documents = ok.select(F.col("file").alias("filename"), prompt.document(row, F.col("_body.value")).alias("text"))
    log = made.select(F.when(F.col("_error").isNull(), "success").otherwise("failed").alias("outcome"), "file", "link", F.col("_error").alias("error"))
    return documents, log.unionByName(skipped)


def crawl(spark: SparkSession, api_base: str, get=web.http_get, pause: float = web.PAUSE_S, lanes: int = 4, registry_slug: str = "popelist") -> tuple[DataFrame, DataFrame]:
    """The catalog of a site (``merge.BASE_COLUMNS``, the first row of each address) and the registry of its authors.

    The registry names a category or a page for each author: posts of categories first, then the documents below the
    headings of pages.  Every page of the interface is asked for once: what came is written down.
    """
    name = posts.register(spark, get, "site_crawl")

    def read(resource: str, **options) -> DataFrame:
        reader = spark.read.format(name).option("base", api_base).option("pause", pause).option("lanes", lanes).option("resource", resource)
        return files.settle(reader.options(**options).load())

    authors = files.settle(web.registry(read("pages", slugs=registry_slug).withColumn("link", F.coalesce("link", F.lit("")))))
    known = read("categories").select(F.col("id").alias("number"), F.col("slug").alias("category"))
    by_number = files.settle(match.first_by(authors.filter("category is not null").join(known, "category"), ["number"], "pos").select(F.col("number").alias("category"), "pope", "pope_url"))
    # Names for options: as many as a site has authors.
    numbers, slugs = ([str(r[0]) for r in df.collect()] for df in (by_number.select("category").orderBy("category"), authors.filter("page is not null").select("page").distinct().orderBy("page")))
    listings = []
    if numbers:
        listings.append(web.post_rows(read("posts", categories=",".join(numbers)), by_number))
    if slugs:
        named = match.first_by(authors.filter("page is not null"), ["page"], "pos").select(F.col("page").alias("slug"), "pope", "pope_url")
        listings.append(web.section_rows(read("pages", slugs=",".join(slugs)).join(named, "slug").select("pope", "content", F.col("pope_url").alias("link"))))
    if not listings:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in merge.BASE_COLUMNS)), authors
    by_pope = [x.withColumn("pos", F.struct("pope", "pos")) for x in listings]
    return catalog_ops.union_listings(*by_pope, url="link").select(*merge.BASE_COLUMNS), authors


def fetch_missing(catalog: DataFrame, present: DataFrame, get=web.http_get, api_base: str | None = None, pause: float = web.PAUSE_S, sleep=time.sleep) -> tuple[DataFrame, DataFrame]:
    """As :func:`fetch_catalog`, fetching as well: only links of documents that are not there are asked for, each once.

    What was fetched is written down before anything is made of it, so no later step asks a site again.
    """
    named = naming.unique_stems(catalog, strip_html=True).withColumn("file", F.concat("stem", F.lit(".md")))
    flagged = named.join(present.select(F.col("name").alias("file"), "size"), "file", "left")
    wanted = flagged.filter(~files.fetched()).select("link").distinct()
    return fetch_catalog(catalog, present, files.settle(web.fetch(wanted, get=get, api_base=api_base, pause=pause, sleep=sleep)))


def recover_failed(catalog: DataFrame, failed: DataFrame, index: DataFrame, spark: SparkSession) -> DataFrame:
    """For each failed entry where to look now: ``file, link, action, reason, url, method``."""
    planned = recover.plan(failed, catalog, list(web.SKIP_LINKS))
    overrides = spark.createDataFrame(list(web.MANUAL_URLS.items()), "link string, url string")
    again = match.resolve(planned.filter("action = 'retry'"), index, overrides)
    action = F.when(F.col("url").isNull(), "still_failed").otherwise("retry")
    again = again.withColumns({"action": action, "reason": F.when(F.col("url").isNull(), recover.UNRESOLVED)})
    cols = ["file", "link", "action", "reason", "url", "method"]
    rest = planned.filter("action <> 'retry'").withColumns({"url": F.lit(None).cast("string"), "method": F.lit(None).cast("string")})
    return again.select(*cols).unionByName(rest.select(*cols))


def run_commands(commands: list[tuple[str, dict]], run: Callable[[str, dict], int]) -> list[str]:
    """Run commands in turn; one that returns anything but 0 ends the run with an error.  Returns the names of those that ran."""
    done = []
    for name, options in commands:
        if status := run(name, options):
            raise RuntimeError(f"{name} ended with status {status}")
        done.append(name)
    return done


def run_rest(store, sources: str, reports: str, provider: Callable[[str], str], size: int = 30, limit: int | None = None, concurrency: int = 5) -> int:
    """Take batches from the queue until none is pending or ``limit`` items are done: call the provider, write the reports, mark the items.

    A batch is marked as one change.  What a provider cannot do is marked failed with its error.  Returns the number of items taken.
    """
    spark, done = store.spark, 0
    while limit is None or done < limit:
        taken = store.next_batch(size if limit is None else min(size, limit - done))
        if not taken:
            break
        names = spark.createDataFrame([(r["id"], r["source_file"], r["report_file"]) for r in taken], "id long, name string, report string")
        texts = files.read_texts(spark, sources).join(names, "name")  # Spark broadcasts a batch that is small enough to be
        got = files.settle(call(texts.select(F.col("report").alias("key"), "text"), "text", "key", provider, concurrency).withColumnRenamed("report", "answer").join(names, F.col("key") == F.col("report"), "right"))
        files.export_markdown(got.filter("answer is not null").select(F.element_at(F.split("report", "/"), -1).alias("filename"), F.col("answer").alias("text")), reports)
        failed = F.col("answer").isNull()
        error = F.when(failed, F.coalesce(F.nullif("error", F.lit("")), F.lit("no source")))
        store.mark_all(got.select("id", F.when(failed, "failed").otherwise("complete").alias("status"), error.alias("error"), F.lit(None).cast("string").alias("agent_id")))
        done += len(taken)
    return done


def run_queue(steps: list[Callable[[DataFrame], DataFrame]], items: DataFrame, dry_run: bool = False) -> DataFrame:
    """Commands in turn on the items; a dry run plans none of them."""
    for step in [] if dry_run else steps:
        items = step(items)
    return items


def remaining_commands(limit: int | None = None, concurrency: int = 5, dry_run: bool = False) -> list[tuple[str, dict]]:
    """What a run of the rest comes to: stale items reset, then the run, then the status unless it is a dry run."""
    run: dict = {"concurrency": concurrency, "until_done": True, "dry_run": dry_run}
    if limit is not None:
        run["limit"] = limit
    return [("reset_stale", {}), ("run", run)] + ([] if dry_run else [("status", {})])
