"""Command line: ``python -m corpusloom COMMAND --store FOLDER ...``. Commands that ask a model take ``--backend module:name``, a callable that makes one (see ``operators.models``); ``run-phase2`` embeds texts if it has ``embed(texts)``."""

from __future__ import annotations

import argparse
import importlib


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    p.add_argument("--store", required=True, help="folder of the stored tables (any path that Spark writes)")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *options: str) -> argparse.ArgumentParser:
        a = sub.add_parser(name, help=text)
        for o in options:
            a.add_argument(o, required=o in ("--registry", "--root", "--backend"))
        return a

    books = ("--registry", "--root")
    command("list-books", "books of a registry (JSON or YAML: book id -> pipeline, globs)", "--registry")
    command("ingest", "add a book's work items", *books).add_argument("book")
    a = command("run-phase1", "ingest a book and ask the model for its payloads", *books, "--backend", "--page", "--volume")
    a.add_argument("book")
    a.add_argument("--limit", type=int)
    command("run-phase2", "embed, find copies, rank and judge pairs", "--backend").add_argument("--budget", type=int, default=5_000)
    command("link", "rank candidate pairs").add_argument("--budget", type=int, default=5_000)
    command("export", "write the property graph").add_argument("path")
    command("status", "chunks by status", "--book")
    command("reset-book", "forget a book").add_argument("book")
    for name, text, more in (
        ("harvest-ontology", "mine headings for concepts, into a catalog file", ("--out",)),
        ("enrich-aliases", "ask for wordings of concepts and keep those the corpus attests", ("--backend",)),
    ):
        command(name, text, *books, "--concepts", *more).add_argument("book")
    command("resolve-nodes", "give all mentions corpus-wide identities", "--concepts", "--entities")
    command("adjudicate", "ask about labels that name no concept", "--concepts", "--backend")
    command("proposals", "plan for proposed terms", "--concepts").add_argument("--threshold", type=int)
    command("audit-mentions", "records by risk", "--entities", "--out").add_argument("--top", type=int)
    command("filter-audit", "let the model dismiss issues", "--entities", "--backend", "--out")
    command("json-to-markdown", "a folder of JSON files as one text").add_argument("paths", nargs=2, metavar="PATH")
    command("demo", "the whole way over a small invented text with a stub model")
    return p


def main(argv: list[str] | None = None, backend=None) -> int:
    args = _parser().parse_args(argv)

    from pyspark.sql import SparkSession

    from corpusloom.operators import catalog
    from corpusloom.operators.state import TableStore
    from corpusloom.plans import demo, jobs
    from corpusloom.sources.files import json_to_markdown, read_document, read_units, resolve_book

    spark = SparkSession.builder.appName("corpusloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    store = TableStore(spark, args.store)
    given = lambda name: getattr(args, name, None)
    registry = read_document(spark, args.registry) if given("registry") else {}
    if given("backend"):
        module, _, name = args.backend.partition(":")
        backend = getattr(importlib.import_module(module), name)()
    concepts = catalog.concept_forms(jobs.load_catalogs(spark, *filter(None, [given("concepts")])))
    entities = catalog.entity_forms(jobs.load_entities(spark, args.entities) if given("entities") else catalog.entity_table(spark, []))
    units = read_units(spark, *resolve_book(spark, registry, args.book, args.root)) if args.command in ("harvest-ontology", "enrich-aliases") else None
    if args.command == "list-books":
        for book, spec in registry.items():
            print(book, spec.get("pipeline", "plain"))
    elif args.command in ("ingest", "run-phase1"):
        print(jobs.ingest(spark, store, registry, args.book, args.root, given("limit"), given("page"), given("volume")).count(), "chunks new")
        if args.command == "run-phase1":
            jobs.extract(store, backend, limit=args.limit)
            jobs.status(store, args.book).show()
    elif args.command == "run-phase2":
        if hasattr(backend, "embed"):
            jobs.embed(store, backend.embed)
        jobs.verify_duplicates(store, backend)
        print(jobs.link(store, backend, args.budget).count(), "pairs judged")
    elif args.command == "link":
        jobs.link(store, budget=args.budget).select("left", "right", "score", "blocked_by").show(50, truncate=False)
    elif args.command == "export":
        jobs.export_store(store, args.path)
    elif args.command == "status":
        jobs.status(store, args.book).show()
    elif args.command == "reset-book":
        jobs.reset(store, args.book)
    elif args.command == "harvest-ontology":
        derived, outcomes = jobs.harvest_vocabulary(store, units, concepts, args.out)
        print(derived.count(), "terms")
        outcomes.show()
    elif args.command == "enrich-aliases":
        jobs.enrich_aliases(store, concepts, units, jobs.propose_aliases(store, concepts, backend)).groupBy("outcome").count().show()
    elif args.command == "resolve-nodes":
        jobs.resolve(store, concepts, entities).show()
    elif args.command == "adjudicate":
        jobs.adjudicate(store, concepts, backend).show(50, truncate=False)
    elif args.command == "proposals":
        jobs.proposals(store, concepts, args.threshold).show(50, truncate=False)
    elif args.command in ("audit-mentions", "filter-audit"):
        found = jobs.audit_mentions(store, entities, given("top"), args.out if args.command == "audit-mentions" else None)
        (found if args.command == "audit-mentions" else jobs.filter_audit(store, found, backend, args.out)).show(50, truncate=False)
    elif args.command == "json-to-markdown":
        print(json_to_markdown(spark, *args.paths), "files")
    else:
        print(demo.run(spark, store))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
