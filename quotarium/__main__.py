"""python -m quotarium run|verify ...: the two entry points, for spark-submit or a local session."""

from __future__ import annotations

import argparse
import importlib
import logging
import os

from pyspark.sql import SparkSession

from quotarium.operators.assembly import from_blocks
from quotarium.plans import engine
from quotarium.settings import Settings
from quotarium.sources import documents, tables
from quotarium.sources.providers import get_provider, response_call


def provider_options(name: str, settings: Settings, base_url: str | None, headers: list[str], call: str | None, lanes: int) -> dict:
    """What the constructor of a provider needs. A header is name=value; a value env:NAME is read from the environment."""
    own = {}
    for h in headers:
        key, _, value = h.partition("=")
        own[key] = os.environ[value[4:]] if value.startswith("env:") else value
    name = name.strip().lower()
    if name == "synchronous":
        if call:
            module, _, function = call.partition(":")
            made = getattr(importlib.import_module(module), function)
        elif base_url:
            made = response_call(base_url, own, settings.model, settings.request_timeout_seconds)
        else:
            raise SystemExit("a synchronous provider needs --base-url, or --call module:function")
        return {"call": made, "lanes": lanes, "with_content": True}
    if name == "batch":
        if not base_url:
            raise SystemExit("a batch provider needs --base-url")
        return {"base_url": base_url, "headers": own}
    return {}


def main(argv: list[str] | None = None) -> None:
    ask = argparse.ArgumentParser(prog="quotarium")
    kinds = ask.add_subparsers(dest="command", required=True)
    run = kinds.add_parser("run", help="code a folder of documents by a framework and verify every quote")
    for name in ("framework", "documents", "out", "landing"):
        run.add_argument(f"--{name}", required=True)
    run.add_argument("--resume", action="store_true")
    run.add_argument("--dry-run", action="store_true")
    run.add_argument("--kind", default="xlsx", choices=["xlsx", "csv", "json", "parquet"])
    run.add_argument("--provider", help="fake, jsonl, synchronous or batch")
    run.add_argument("--model")
    run.add_argument("--base-url", help="address of a provider's service")
    run.add_argument("--header", action="append", default=[], metavar="NAME=VALUE", help="header of its calls; VALUE env:NAME is read from the environment")
    run.add_argument("--call", metavar="MODULE:FUNCTION", help="a call of your own for the synchronous provider")
    run.add_argument("--lanes", type=int, default=1, help="calls at a time")
    run.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="any other setting")
    run.add_argument("--blocks", help="table of text blocks, if documents aren't to be parsed here")
    check = kinds.add_parser("verify", help="verify the quotes of a findings table again")
    check.add_argument("--findings", required=True)
    check.add_argument("--documents", help="folder of the documents")
    check.add_argument("--blocks", help="table of their text blocks")
    check.add_argument("--out", required=True)
    for kind in (run, check):
        kind.add_argument("--log", help="a file that gets the log too, in full")
    got = ask.parse_args(argv)
    console = logging.StreamHandler()
    console.setLevel(logging.INFO)
    logging.basicConfig(level=logging.DEBUG if got.log else logging.INFO, handlers=[console, *([logging.FileHandler(got.log)] if got.log else [])])
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName("quotarium").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    blocks = spark.read.parquet(got.blocks) if got.blocks else None
    if got.command == "verify":
        own = blocks if blocks is not None else documents.blocks(spark, got.documents)
        engine.verify_files(spark, got.findings, from_blocks(own), got.out).groupBy("verification_status").count().orderBy("verification_status").show()
        return
    given = Settings.parsed(dict(x.split("=", 1) for x in got.set)) | {k: v for k, v in (("provider", got.provider), ("model", got.model)) if v}
    settings = Settings.from_env(**given, **({"dry_run": True} if got.dry_run else {}))
    options = provider_options(settings.provider, settings, got.base_url, got.header, got.call, got.lanes)
    labels = tables.load_framework(spark, got.framework)
    done = engine.run(spark, labels, got.documents, get_provider(settings.provider, spark, settings, got.landing, **options), got.out, settings, got.resume, kind=got.kind, blocks=blocks)
    (done.cost if settings.dry_run else done.verdicts.groupBy("verification_status").count().orderBy("verification_status")).show()


if __name__ == "__main__":
    main()
