"""Exports: rows as text in several formats, nested documents, star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telarium.functions import text as T

CSV_HEADER = ["kind", "code", "level", "subject", "strand", "category", "curriculum_base", "status", "statement", "indicators"]


def csv_line(cells: list[Column]) -> Column:
    """A line of quoted cells; line ends of texts become spaces."""
    return F.concat_ws(",", *[T.csv_cell(F.regexp_replace(c.cast("string"), "\n", " ")) for c in cells])


def json_line(cols: list[str]) -> Column:
    """A row as one line of JSON, with its null fields."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def ddl(df: DataFrame, name: str) -> str:
    """CREATE TABLE of a star table for a database with the types INTEGER, REAL and TEXT."""
    TEXT, kinds = "TEXT", {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL"}
    return f"CREATE TABLE {name} ({', '.join(f'{c} {kinds.get(t, TEXT)}' for c, t in df.dtypes)})"


def prompt_block(code: Column, subject: Column, level: Column, track: Column, statement: Column, indicators: Column) -> Column:
    body = F.replace(F.regexp_replace(F.coalesce(statement, F.lit("")), r"\n\s*-\s*", "; "), F.lit("\n"), F.lit(" "))
    more = F.when(F.size(indicators) > 0, F.concat(F.lit("\nIndicadores: "), F.array_join(indicators, " "))).otherwise("")
    return F.concat(F.lit("["), F.coalesce(code, F.lit("")), F.lit("] "), F.concat_ws(" · ", subject, level, track), F.lit("\n"), body, more)


def plain_block(code: Column, where: Column, statement: Column, indicators: Column) -> Column:
    head = F.concat(F.lit("["), F.coalesce(code, F.lit("")), F.lit("] "), F.replace(F.coalesce(statement, F.lit("")), F.lit("\n"), F.lit("\n  ")), F.lit("\n  "), where)
    more = F.when(F.size(indicators) > 0, F.concat(F.lit("\nIndicadores de evaluación:"), F.array_join(F.transform(indicators, lambda x: F.concat(F.lit("\n  - "), x)), ""))).otherwise("")
    return F.concat(head, more)


def markdown_statement(c: Column, indent: str = "") -> Column:
    ls = T.lines(c)
    return F.array_join(F.transform(ls, lambda x, i: F.when(i == 0, F.concat(F.lit(indent), x)).otherwise(F.concat(F.lit(f"{indent}- "), F.regexp_replace(x, r"^-\s*", "")))), "\n")


def markdown_block(code: Column, subject: Column, level: Column, strand_kind: Column, strand: Column, statement: Column) -> Column:
    return F.concat(
        F.lit("### "), F.coalesce(code, F.lit("")), F.lit(" — "), F.concat_ws(", ", subject, level), F.lit("\n"),
        F.when(strand.isNotNull(), F.concat(F.lit("*"), F.coalesce(strand_kind, F.lit("eje")), F.lit(": "), strand, F.lit("*\n"))).otherwise(""), F.lit("\n"), markdown_statement(statement), F.lit("\n"),
    )


def joined(df: DataFrame, group: list[str], order: list[str], text: Column, sep: str, name: str = "document") -> DataFrame:
    """One text for each group, its rows in order. A group becomes one value, so it is meant for documents, not for unbounded keys."""
    return df.groupBy(*group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, text.alias("_t")))), lambda x: x["_t"]), sep).alias(name))


def slim(df: DataFrame) -> DataFrame:
    """Objectives with one-line statements, nested by offering."""
    o = F.struct("row_id", "oa_id", "code", "category", T.flatten_statement(F.col("statement")).alias("statement"))
    return df.where("offering_key IS NOT NULL").groupBy("level_id", "subject_id").agg(F.array_sort(F.collect_list(o)).alias("learning_objectives"))


def level_index(df: DataFrame) -> DataFrame:
    """(level_id, file, subjects, total_oas): what a split by level consists of."""
    return df.where("level_id IS NOT NULL").groupBy("level_id").agg(F.array_sort(F.collect_set("subject_id")).alias("subjects"), F.count("*").alias("total_oas")).select("level_id", F.concat("level_id", F.lit(".json")).alias("file"), "subjects", "total_oas")


def write_by_level(df: DataFrame, path: str) -> None:
    df.write.partitionBy("level_id").mode("errorifexists").json(path)


def star(rows: DataFrame, learnings: DataFrame) -> dict[str, DataFrame]:
    """Flat tables with positions as keys: indicators, keywords of rows, learnings and criteria."""
    return {
        "indicators": rows.select("row_id", F.posexplode("indicators").alias("position", "statement")),
        "learnings": learnings.select("row_id", "source_pdf", "module_number", "number", "statement"),
        "criteria": learnings.select("row_id", F.posexplode("criteria").alias("position", "text")),
        "generic": learnings.select("row_id", F.posexplode("generic_objectives").alias("position", "letter")),
    }


def manifest(df: DataFrame, offerings: DataFrame) -> DataFrame:
    """One row that says what a build holds: counters, sources and what is known to be missing."""
    a = df.agg(
        F.count("*").alias("objectives"), F.countDistinct("offering_key").alias("offerings"), F.countDistinct("code").alias("codes"), F.count_if("prioritized").alias("prioritized"),
        F.count_if(F.col("statement").isNull()).alias("without_statement"), F.count_if(F.col("source").isNull()).alias("without_source"), F.max("retrieved_at").alias("last_retrieved"),
    )
    x = a.withColumn("expected_offerings", F.lit(offerings.agg(F.countDistinct("offering_key")).first()[0]))
    notes = F.array_compact(F.array(F.when(F.col("without_statement") > 0, "objectives without a statement"), F.when(F.col("without_source") > 0, "objectives without a source"), F.when(F.col("offerings") < F.col("expected_offerings"), "offerings without objectives")))
    return x.withColumn("limitations", F.array_join(notes, "; "))


def document_index(df: DataFrame, offerings: DataFrame) -> DataFrame:
    """(document, title, offerings, objectives): one document for each track and subject, in their order."""
    o = offerings.select("offering_key", F.coalesce("track", F.lit("otro")).alias("area"), T.canonical_subject_name(F.col("subject_name")).alias("title"))
    n = df.groupBy("offering_key").agg(F.count("*").alias("n"))
    x = o.join(n, "offering_key", "left").groupBy("area", "title").agg(F.countDistinct("offering_key").alias("offerings"), F.coalesce(F.sum("n"), F.lit(0)).alias("objectives"))
    return x.select(F.concat_ws("_", "area", T.slugify(F.col("title"))).alias("document"), "title", "offerings", "objectives").orderBy("document")


def module_block(number: Column, name: Column, hours: Column, learnings: Column) -> Column:
    """Markdown of a module; learnings is array<struct<number, statement, criteria array<string>>> in order."""
    one = lambda x: F.concat(F.lit("\n**"), x["number"].cast("string"), F.lit(".** "), F.coalesce(x["statement"], F.lit("")), F.coalesce(F.array_join(F.transform(x["criteria"], lambda c: F.concat(F.lit("\n- "), c)), ""), F.lit("")), F.lit("\n"))
    head = F.concat(F.lit("#### "), F.concat_ws(" · ", F.concat(F.lit("Módulo "), number.cast("string")), name, F.concat(hours.cast("string"), F.lit(" horas"))), F.lit("\n"))
    return F.concat(head, F.array_join(F.transform(learnings, one), ""))


def modules_document(learnings: DataFrame) -> DataFrame:
    """(source_pdf, module_number, block): each module of a file with its learnings and criteria."""
    x = learnings.groupBy("source_pdf", "module_number").agg(F.min("module_name").alias("name"), F.max("hours").alias("hours"), F.array_sort(F.collect_list(F.struct("number", "row_id", "statement", "criteria"))).alias("l"))
    return x.select("source_pdf", "module_number", module_block(F.col("module_number"), F.col("name"), F.col("hours"), F.col("l")).alias("block"))
