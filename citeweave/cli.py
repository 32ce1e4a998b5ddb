"""Command line: python -m citeweave.cli STAGE ...  Every stage reads and writes folders of a store that executors share."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from citeweave import schemas
from citeweave.operators import articles, curate, enrich, extract, lookups
from citeweave.sources import archives, tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="citeweave", description=__doc__)
    stages = top.add_subparsers(dest="stage", required=True)

    def stage(name: str, *paths: str, **options) -> argparse.ArgumentParser:
        p = stages.add_parser(name)
        for path in paths:
            p.add_argument(path)
        for option, default in options.items():
            kind = {"action": "store_true"} if default is False else {"default": default, "type": type(default)}
            p.add_argument(f"--{option.replace('_', '-')}", **kind)
        return p

    stage("parse", "archives", "out", subsets="all", limit=0)
    stage("publications", "baseline", "updates", "out", partitioned=False)
    stage("metrics", "csv", "out", partitions=64)
    stage("enrich", "articles", "publications", "metrics", "out", flag="is_clinical")
    stage("extract", "enriched", "out", cache="", done="", limit=0, concurrency=16, resume=False, endpoints="", model="offline-stub", retries=3)
    stage("dedupe", "results", "out")
    stage("gold", "results", "out", per_stratum=200, seed=20260501, by_hash=False)
    stage("split", "results", "out", gold="", seed="split-seed")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    read = lambda path, schema: spark.read.schema(schema).json(path)
    if args.stage == "parse":
        found = articles.parse_articles(archives.read_archives(spark, args.archives, args.subsets, args.limit or None))
        tables.write_json_lines(found, args.out)
    elif args.stage == "publications":
        found = lookups.latest_publications(tables.read_pubmed(spark, args.baseline, args.updates))
        by = "pmid_bucket" if args.partitioned else None
        tables.write_lookup(found.withColumn("pmid_bucket", lookups.bucket(F.col("pmid"))) if by else found, args.out, 5 if by else 3, partition_by=by, rows_per_file=2_000_000)
    elif args.stage == "metrics":
        rows = tables.read_citation_metrics(spark, args.csv).withColumn("place", F.monotonically_increasing_id())
        tables.write_lookup(lookups.sorted_lookup(lookups.last_wins(rows, "pmid", ["place"]), args.partitions), args.out, 5, rows_per_file=500_000)
    elif args.stage == "enrich":
        found = enrich.enrich(read(args.articles, schemas.ARTICLE), spark.read.parquet(args.publications), spark.read.parquet(args.metrics), args.flag)
        tables.write_json_lines(found, args.out, compression="none")
    elif args.stage == "extract":
        records = tables.read_json_lines(spark, args.enriched, schemas.ENRICHED)
        records = extract.undone(records, tables.optional_table(spark, args.done, schemas.RESULT), args.limit or None)
        cache = tables.optional_table(spark, args.cache, extract.CACHE)

        def save(df):
            df.write.mode("overwrite").parquet(f"{args.out}-answers")
            return spark.read.parquet(f"{args.out}-answers")

        settings = extract.Settings(model=args.model, endpoints=tuple(args.endpoints.split(",")) if args.endpoints else ("local",), max_retry=args.retries, concurrency=args.concurrency)
        extractor = extract.ChatEndpoint(args.model, settings.api_key) if args.endpoints else extract.Stub()
        results, new = extract.extract(records, cache, extractor, settings, save)
        tables.write_json_lines(results.drop("payload"), args.out, "none", "append" if args.resume else "overwrite")
        if args.cache:
            new.write.mode("append").json(args.cache)
    elif args.stage == "dedupe":
        rows = tables.read_json_lines(spark, args.results, schemas.RESULT, keep_raw=True)
        tables.write_raw_lines(curate.deduplicated(rows), args.out)
    elif args.stage == "gold":
        rows = tables.read_json_lines(spark, args.results, schemas.RESULT)
        tables.write_json_lines(curate.gold(rows, args.per_stratum, args.seed, exact=not args.by_hash).drop("line_idx"), args.out, "none")
    elif args.stage == "split":
        rows = tables.read_json_lines(spark, args.results, schemas.RESULT)
        keys = curate.gold_keys(tables.optional_table(spark, args.gold, schemas.RESULT))
        index = curate.split_index(rows, keys, args.seed)
        curate.require_whole_articles(index)
        tables.write_tsv(index, args.out)
        curate.split_sizes(index).show(truncate=False)
        curate.split_strata(index).show(100, truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(SparkSession.builder.appName(f"citeweave-{args.stage}").config("spark.sql.session.timeZone", "UTC").getOrCreate(), args)


if __name__ == "__main__":
    main()
