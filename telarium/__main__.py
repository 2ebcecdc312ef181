"""python -m telarium COMMAND: runs registered queries over the tables of a folder and writes or prints their results.

list, levels and query print; run writes the queries named; each other command writes those that belong to it.
"""

from __future__ import annotations

import argparse
import os
import sys

#: What each command writes, one folder a query.
COMMANDS = {
    "scrape": ("read landed pages: heads, objectives, documents, links, sectors", ["page_heads", "page_objectives", "page_documents", "page_links", "page_sectors"]),
    "indicators": ("read layouts and attach rows to objectives", ["layout_rows", "layout_text_rows", "attach_best", "attach_outcomes"]),
    "tp-modules": ("read modules with their learnings and criteria", ["layout_learnings", "module_criteria", "star_criteria"]),
    "augment": ("complete records: prose objectives, corrections, provenance", ["prose_objectives", "prose_ideas", "corrections", "provenance_filled", "transversal_ids"]),
    "coverage": ("compare the offerings that are expected with those held", ["coverage", "coverage_summary"]),
    "validate": ("audit the tables", ["audit_schema", "audit_schema_report", "audit_text", "audit_text_counts", "audit_same_text", "audit_codes", "audit_ids", "audit_routes", "audit_provenance", "audit_status", "audit_prioritization"]),
    "export-slim": ("objectives with one-line statements", ["export_slim", "statement_flat"]),
    "export-sqlite": ("star tables and their definitions for a database", ["export_ddl", "star_indicators", "star_criteria", "postings"]),
    "export-manifest": ("the row that identifies a build", ["manifest"]),
    "export-markdown": ("documents by offering, modules and the index", ["export_markdown", "export_modules", "document_index"]),
    "split": ("the index of one file a level", ["export_level_index"]),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="telarium", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of the queries")
    out = argparse.ArgumentParser(add_help=False)
    out.add_argument("--data", required=True)
    out.add_argument("--out", required=True)
    out.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    sub.add_parser("run", parents=[out], help="run queries by name").add_argument("names", nargs="+")
    for name, (says, _) in COMMANDS.items():
        sub.add_parser(name, parents=[out], help=says)
    levels = sub.add_parser("levels", help="levels and how many offerings they have")
    levels.add_argument("--data", required=True)
    q = sub.add_parser("query", help="search objectives")
    q.add_argument("text", nargs="?", default="")
    q.add_argument("--data", required=True)
    q.add_argument("--level")
    q.add_argument("--subject", help="part of a subject's id")
    q.add_argument("--category", choices=["conocimiento", "habilidad", "actitud"])
    q.add_argument("--limit", type=int, default=20)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)

    from telarium.queries import QUERIES

    if args.command == "list":
        print("\n".join(QUERIES))
        return 0
    names = args.names if args.command == "run" else COMMANDS.get(args.command, ("", []))[1]
    if unknown := [n for n in names if n not in QUERIES]:
        print("unknown: " + " ".join(unknown), file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    from telarium.operators import search
    from telarium.session import get_spark, table

    spark = SparkSession.getActiveSession() or get_spark()
    if args.command == "levels":
        for r in QUERIES["known_levels"](spark, args.data).orderBy("level_id").collect():
            print(f"{r.level_id}\t{r.level_name}\t{r.offerings}")
    elif args.command == "query":
        hits = search.grep(table(spark, args.data, "objectives"), args.text, args.level, args.subject, args.category, args.limit).collect()
        for r in hits:
            print(f"[{r.oa_id}] {r.code or ''} | {r.level_id} / {r.subject_id} / {r.strand_eje or '-'}\n    {(r.statement or '').split(chr(10))[0][:160]}")
        print(f"{len(hits)} shown")
    for n in names:
        QUERIES[n](spark, args.data).write.format(args.format).save(os.path.join(args.out, n))
    return 0


if __name__ == "__main__":
    sys.exit(main())
