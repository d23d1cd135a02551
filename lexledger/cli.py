"""Commands over a folder of ledger tables: python -m lexledger.cli <command> --tables FOLDER ..."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.api import responses
from lexledger.grammar.udf import parse_publications
from lexledger.operators import gates, ledger
from lexledger.plans import maintenance
from lexledger.sources import acquire, probe, readers, sinks
from lexledger.streaming import enumeration


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexledger")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *words: str, **options) -> None:
        one = commands.add_parser(name)
        for w in words:
            one.add_argument(w)
        for k, v in options.items():
            one.add_argument(f"--{k.replace('_', '-')}", default=v, required=v is ...)

    command("stats", tables=...)
    command("case", "id", tables=..., known_at=None)
    command("respondent", "name", tables=...)
    command("article", "statute", "number", tables=...)
    command("export", "table", "path", tables=..., fmt="parquet")
    command("coverage", tables=...)
    command("validate", tables=...)
    command("parse", "folder")
    command("build", "folder", "out", corpus="corpus", previous=None, sidecar=None, observations=None)
    command("probe", "files", kind="html", before=None, out=None)
    command("enumerate-history", "start", "end", "folder", url=..., batch_days="31", pause="0.5")
    command("fetch", "folder", "out", url=None, pause="0.5")
    command("pdf-status", "links", "folder", pause="0.5")
    return top


def _acquire(spark: SparkSession, a) -> dict[str, DataFrame]:
    """Commands that read sources: a folder's structure, days of summaries, documents of an enumeration, PDF documents."""
    if a.command == "probe":
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(a.files).select(readers.text_of(F.col("content")).alias("text"))
        now = probe.profile(files, "text", a.kind)
        if a.out:
            now.write.mode("overwrite").parquet(a.out)
            now = spark.read.parquet(a.out)
        return {"drift": probe.drift(spark.read.parquet(a.before), now)} if a.before else {"path": now}
    if a.command == "enumerate-history":
        days = enumeration.enumerate_days(spark, a.start, a.end, enumeration.summaries_over_http(a.url, pause=float(a.pause)), a.folder, batch_days=int(a.batch_days))
        return {"enumerated": days.agg(F.count(F.lit(1)).alias("days"), F.sum(F.size("items")).alias("items"), F.count("error").alias("errors"))}
    if a.command == "fetch":
        found = enumeration.settled(enumeration.manifest(spark, a.folder)).select(F.explode("items").alias("i")).filter("i.sanction_like")
        url = F.replace(F.lit(a.url), F.lit("{boe_id}"), F.col("i.boe_id")) if a.url else F.col("i.url_xml")
        return {"document": acquire.fetch_documents(spark, found.select("i.boe_id", url.alias("url")), a.out, pause=float(a.pause))}
    links = spark.read.option("header", True).schema("boe_id string, url string").csv(a.links)
    return {"observation": acquire.pdf_status(spark, links, a.folder, pause=float(a.pause))}


def _print(name: str, df: DataFrame, out) -> None:
    for r in responses(df).toLocalIterator():
        print(name, r.json, sep="\t", file=out)


def run(spark: SparkSession, argv: list[str], out=sys.stdout) -> int:
    """The exit code: 1 for an unknown format or table and for gates that don't hold."""
    a = _parser().parse_args(argv)
    t = readers.ledger_tables(spark, a.tables) if "tables" in a else {}
    if a.command == "stats":
        parts = {"totals": ledger.stats_totals(t), "severity": ledger.stats_by_severity(t), "type": ledger.stats_by_type(t), "statute": ledger.stats_by_statute(t), "parties": ledger.sanctioned_parties(t)}
    elif a.command == "case":
        key = ledger.case_by_key(t, a.id).select("case_id").first()
        if key is None:
            return 1
        parts = ledger.case_detail(t, key.case_id, a.known_at)
    elif a.command == "respondent":
        parts = {"respondent": ledger.respondent_search(t, a.name)}
    elif a.command == "article":
        parts = {"infringement": ledger.article(t, a.statute, a.number)}
    elif a.command in ("probe", "enumerate-history", "fetch", "pdf-status"):
        parts = _acquire(spark, a)
    elif a.command == "coverage":
        parts = sinks.coverage(t["cases"], t["documents"], t["parse_issues"])
    elif a.command == "validate":
        held = gates.release_gates(gates.table_violations(t, datetime.now(UTC).replace(tzinfo=None))).collect()  # one row for each gate
        for g in held:
            print("ok" if g.ok else "FAIL", g.gate, g.n_violations, sep="\t", file=out)
        return 0 if all(g.ok for g in held) else 1
    elif a.command == "export":
        if a.table not in t or a.fmt not in sinks.FORMATS:
            return 1
        sinks.export(t[a.table], a.path, a.fmt)
        return 0
    elif a.command == "parse":
        p = parse_publications(readers.xml_corpus(spark, {"corpus": a.folder})).select("path", "publication.*")
        parts = {"document": p.select("path", "boe_id", F.size("blocks").alias("n_blocks"), F.aggregate("blocks", F.lit(0), lambda s, b: s + F.size(b["sanctions"])).alias("n_sanctions"), F.size("issues").alias("n_issues"), "error")}
    else:
        files = readers.xml_corpus(spark, {a.corpus: a.folder})
        whole = lambda path: spark.read.option("wholetext", True).text(path)
        sidecar = readers.sidecar_index(whole(a.sidecar), "value") if a.sidecar else None
        looks = readers.observation_snapshot(whole(a.observations), "value") if a.observations else None
        done = maintenance.build(spark, files, a.out, datetime.now(UTC).replace(tzinfo=None), previous=a.previous, sidecar=sidecar, observations=looks)
        for k, v in done.items():
            print(k, v, sep="\t", file=out)
        return 0
    for name, df in parts.items():
        _print(name, df, out)
    return 0


if __name__ == "__main__":
    sys.exit(run(SparkSession.builder.appName("lexledger").getOrCreate(), sys.argv[1:]))
