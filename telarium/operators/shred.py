"""Adjacency-table shredding of deeply nested JSON bodies.

``shred`` turns each body into an adjacency table: one row for every JSON node with its
parent, its label and that of its parent, its ordinal, its kind and its scalar. ``entities`` finds the nodes that stand for an entity of
the curriculum (level, subject, objective, module, learning, criterion) by joins of containers with their entries and of
entries with what they stand in, up to the record. ``entity_table`` joins the object nodes of an entity with
their scalar children and pivots those into columns, so that each child names its parent.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the document model: entity -> {field: (child entity, prefix of its path step)}; no prefix: the key itself.
CHILDREN: dict[str, dict[str, tuple[str, str]]] = {
    "record": {"levels": ("level", ""), "modules": ("module", "m")},
    "level": {"subjects": ("subject", "")},
    "subject": {"learning_objectives": ("objective", "o"), "modules": ("module", "m")},
    "module": {"expected_learnings": ("learning", "l")},
    "learning": {"criteria": ("criterion", "c")},
}
KEY_FIELDS = {"level": "level_id", "subject": "subject_id"}
ENTITIES = ("record", "level", "subject", "objective", "module", "learning", "criterion")

#: Field -> (entity of its entries, prefix of their path steps); a field means the same wherever it may stand.
_FIELD = {f: c for fields in CHILDREN.values() for f, c in fields.items()}

SCHEMA = "doc long, record_id long, node_id int, parent_id int, label string, parent_label string, ordinal int, kind string, scalar string"
_ARROW = pa.schema([
    ("doc", pa.int64()), ("record_id", pa.int64()), ("node_id", pa.int32()), ("parent_id", pa.int32()), ("label", pa.string()), ("parent_label", pa.string()),
    ("ordinal", pa.int32()), ("kind", pa.string()), ("scalar", pa.string()),
])


def _opened(value):
    """Nodes given as serialized text are opened; other text stands for itself."""
    if isinstance(value, str) and value.lstrip()[:1] in ("[", "{"):
        try:
            return json.loads(value)
        except (ValueError, RecursionError):
            return value
    return value


def _kind(v) -> str:
    return "null" if v is None else "object" if isinstance(v, dict) else "array" if isinstance(v, list) else "boolean" if isinstance(v, bool) else "string" if isinstance(v, str) else "number"


def _scalar(v) -> str | None:
    if v is None or isinstance(v, (dict, list)):
        return None
    return v if isinstance(v, str) else json.dumps(v)


def nodes(body: str | None) -> list[tuple]:
    """(node_id, parent_id, label, parent_label, ordinal, kind, scalar) of the nodes of one body; none for a null body or one that is no JSON.

    Text that is itself an object or array is opened: it has the kind and the children of what it holds, and the text as its scalar.
    """
    if body is None:
        return []
    try:
        root = json.loads(body)
    except (ValueError, RecursionError):
        return []
    out: list[tuple] = []
    stack: list[tuple] = [(root, None, None, None, 0)]
    while stack:
        raw, parent, label, above, ordinal = stack.pop()
        me = len(out)
        value = raw if parent is None else _opened(raw)
        out.append((me, parent, label, above, ordinal, _kind(value), _scalar(raw)))
        if isinstance(value, dict):
            stack.extend(reversed([(v, me, k, label, i) for i, (k, v) in enumerate(value.items())]))
        elif isinstance(value, list):
            stack.extend(reversed([(v, me, None, label, i) for i, v in enumerate(value)]))
    return out


def shred(df: DataFrame, id_col: str = "record_id", body_col: str = "body") -> DataFrame:
    """Adjacency table of the JSON bodies of df; doc tells bodies apart, also those of one id.

    Null bodies and bodies that do not parse give no rows (refused() lists them); a body that is a scalar or an array
    gives its root and plain nodes. Repeated
    ids are shredded as often as they stand there. Columns of df other than the two named are not
    read, so clashing names do no harm. Row-local: no shuffle, whatever the skew. Settle the table before it is joined with itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc = TaskContext.get().partitionId() << 40
        for b in batches:
            cols: list[list] = [[] for _ in _ARROW.names]
            for rid, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                doc += 1
                found = nodes(body)
                cols[0] += [doc] * len(found)
                cols[1] += [rid] * len(found)
                for c, v in zip(cols[2:], zip(*found)):
                    c += v
                if len(cols[0]) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW.types)], schema=_ARROW)
                    cols = [[] for _ in _ARROW.names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW.types)], schema=_ARROW)

    return df.select(F.col(id_col).cast("long"), F.col(body_col).cast("string")).mapInArrow(run, SCHEMA)


def skeleton(adjacency: DataFrame) -> DataFrame:
    """The rows that say which entities there are: roots, containers, their entries, and the keys of these."""
    return adjacency.where(F.col("parent_id").isNull() | F.col("label").isin(*_FIELD, *KEY_FIELDS.values()) | F.col("parent_label").isin(*_FIELD))


def _entries(rows: DataFrame) -> DataFrame:
    """(doc, owner, field, node_id, step, ordinal, kind, scalar): the entries of each container with the step of their path.

    Keyed entities go by their keys, or by the scalar that names them in a list; others by their place, or by ascending number where
    all keys are numbers; a container that is no list of entries is the one entry itself. A null entry is none but keeps its place.
    """
    keyed = F.col("field").isin(*(f for f, (c, _) in _FIELD.items() if c in KEY_FIELDS))
    box = rows.where(F.col("label").isin(*_FIELD) & F.col("parent_id").isNotNull()).select("doc", F.col("node_id").alias("cid"), F.col("parent_id").alias("owner"), F.col("label").alias("field"), F.col("kind").alias("ckind"), F.col("scalar").alias("cscalar"))
    kid = rows.where(F.col("parent_label").isin(*_FIELD)).select("doc", F.col("parent_id").alias("cid"), "node_id", F.col("label").alias("key"), F.col("ordinal").alias("place"), F.col("kind").alias("k"), F.col("scalar").alias("s"))
    both = box.join(kid, ["doc", "cid"], "left")  # sorted by (doc, cid), as the windows need it
    w = Window.partitionBy("doc", "cid")
    number = F.regexp_extract("key", r"^\s*(-*\d+)\s*$", 1)
    both = both.withColumn("numbered", F.coalesce(F.min((number != "").cast("int")).over(w) == 1, F.lit(False)) & (F.col("ckind") == "object"))
    both = both.withColumn("rank", F.row_number().over(w.orderBy(F.nullif(number, F.lit("")).cast("decimal(38,0)"), "place")) - 1)
    listed = (F.col("ckind") == "array") | (F.col("ckind") == "object") & (keyed | F.col("numbered"))
    names = rows.where(F.col("label").isin(*KEY_FIELDS.values()) & F.col("scalar").isNotNull()).select("doc", F.col("parent_id").alias("node_id"), F.col("label").alias("named"), F.col("scalar").alias("name"))
    entry = both.where(listed & F.col("node_id").isNotNull() & (F.col("k") != "null"))
    place = F.when(F.col("numbered") & ~keyed, F.col("rank")).otherwise(F.col("place"))
    key_of = F.create_map(*[F.lit(x) for f, (c, _) in _FIELD.items() if c in KEY_FIELDS for x in (f, KEY_FIELDS[c])])
    entry = entry.withColumn("named", F.when(keyed & (F.col("ckind") == "array"), key_of[F.col("field")])).join(names, ["doc", "node_id", "named"], "left")
    step = F.when(keyed & (F.col("ckind") == "object"), F.col("key")).otherwise(F.coalesce("name", place.cast("string")))
    many = entry.select("doc", "owner", "field", "node_id", step.alias("step"), place.cast("int").alias("ordinal"), F.col("k").alias("kind"), F.col("s").alias("scalar"))
    alone = ~keyed & ~F.col("ckind").isin("array", "null") & ~F.col("numbered") & ~((F.col("ckind") == "object") & F.col("node_id").isNull()) & ~((F.col("ckind") == "string") & (F.col("cscalar") == ""))
    one = both.where(alone & (F.coalesce("place", F.lit(0)) == 0)).select("doc", "owner", "field", F.col("cid").alias("node_id"), F.lit("0").alias("step"), F.lit(0).alias("ordinal"), F.col("ckind").alias("kind"), F.col("cscalar").alias("scalar"))
    return many.unionByName(one)


def entities(adjacency: DataFrame) -> DataFrame:
    """(doc, record_id, node_id, entity, path, parent_path, ordinal, kind, scalar) of every entity node of a settled adjacency table.

    From the record down, the entries of each field are joined with the entities that may hold it, and so get their path; entries
    that stand elsewhere are none. Each entry and each entity is shuffled once, on (doc, node), so no body and no id gathers rows.
    """
    from telarium.session import settle

    rows = skeleton(adjacency)
    columns = ["doc", "record_id", "node_id", "entity", "path", "parent_path", "ordinal", "kind", "scalar"]
    found = {"record": rows.where("parent_id IS NULL").select("doc", "record_id", "node_id", F.lit("record").alias("entity"), F.lit("root").alias("path"), F.lit("").alias("parent_path"), F.lit(0).alias("ordinal"), "kind", "scalar")}
    edges = settle(_entries(rows))
    for entity in ENTITIES[1:]:
        field, prefix = next((f, p) for f, (c, p) in _FIELD.items() if c == entity)
        holders = [found[e].select("doc", "record_id", F.col("node_id").alias("owner"), F.col("path").alias("parent_path")) for e, fields in CHILDREN.items() if field in fields]
        inside = edges.where(F.col("field") == field).join(reduce(DataFrame.unionByName, holders), ["doc", "owner"])
        found[entity] = inside.select("doc", "record_id", "node_id", F.lit(entity).alias("entity"), F.concat("parent_path", F.lit(f"/{prefix}"), "step").alias("path"), "parent_path", "ordinal", "kind", "scalar")
        if entity in CHILDREN:
            found[entity] = settle(found[entity])
    return reduce(DataFrame.unionByName, (x.select(*columns) for x in found.values()))


def refused(df: DataFrame, id_col: str = "record_id", body_col: str = "body") -> DataFrame:
    """(record_id, reason) of the bodies that give no rows: null, not_json, or too_deep for the parser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for rid, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    if body is None:
                        out.append((rid, "null"))
                    else:
                        json.loads(body)
                except ValueError:
                    out.append((rid, "not_json"))
                except RecursionError:
                    out.append((rid, "too_deep"))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([r for _, r in out], pa.string())], ["record_id", "reason"])

    return df.select(F.col(id_col).cast("long"), F.col(body_col).cast("string")).mapInArrow(run, "record_id long, reason string")


def found_nodes(found: DataFrame) -> DataFrame:
    """Entity nodes with the path of the parent: record_id, node, path, parent_path."""
    return found.select("record_id", F.col("entity").alias("node"), "path", "parent_path")


def entity_table(adjacency: DataFrame, found: DataFrame, entity: str, fields: list[str]) -> DataFrame:
    """Flat table of one entity: record_id, path, parent_path, ordinal, text and one column for each field.

    Joins the entity's object nodes with their scalar children on (doc, node) and pivots
    the labels named in fields; a field that is missing, null or not scalar is null. ``text`` holds
    the scalar of entities given as plain text. A field named like a result column is prefixed
    with ``f_``.
    """
    own = found.where(F.col("entity") == entity).select("doc", "record_id", F.col("node_id").alias("nid"), "path", "parent_path", "ordinal", F.when(~F.col("kind").isin("object", "array"), F.col("scalar")).alias("text"))
    kids = (
        adjacency.where(F.col("label").isin(fields) & F.col("parent_id").isNotNull() & ~F.col("label").isin(*CHILDREN.get(entity, {})))
        .groupBy(F.col("doc").alias("d"), F.col("parent_id").alias("pid"))
        .agg(*(F.max(F.when(F.col("label") == f, F.col("scalar"))).alias(f"v{i}") for i, f in enumerate(fields)))
    )
    taken = {"record_id", "path", "parent_path", "ordinal", "text"}
    cols = [F.col(f"v{i}").alias(f"f_{f}" if f in taken else f) for i, f in enumerate(fields)]
    return own.join(kids, (F.col("doc") == F.col("d")) & (F.col("nid") == F.col("pid")), "left").select("record_id", "path", "parent_path", "ordinal", "text", *cols)


#: Fields of each entity that become columns (fixed values of the document model).
FIELDS = {
    "level": ["level_id", "level_name"],
    "subject": ["subject_id", "subject_name", "track"],
    "objective": ["code", "statement"],
    "module": ["module_number", "module_name", "hours", "grade"],
    "learning": ["number", "statement"],
    "criterion": ["label", "text"],
}


def totals(adjacency: DataFrame, found: DataFrame) -> DataFrame:
    """metadata.total_oas of each record beside the objectives that it really holds; ``stale`` where they differ.

    total_oas is null where it is missing, null or no whole number in any type.
    """
    meta = adjacency.where((F.col("label") == "metadata") & (F.col("parent_id") == 0)).select(F.col("doc").alias("md"), F.col("node_id").alias("mid"))
    given = (
        adjacency.where(F.col("label") == "total_oas").select(F.col("doc").alias("d"), F.col("parent_id").alias("pid"), F.expr("try_cast(scalar AS long)").alias("total_oas"))
        .join(meta, (F.col("d") == F.col("md")) & (F.col("pid") == F.col("mid"))).select("d", "total_oas")
    )
    held = found.groupBy("doc", "record_id").agg(F.count_if(F.col("entity") == "objective").alias("objectives"))
    return held.join(given, F.col("doc") == F.col("d"), "left").select("record_id", "total_oas", "objectives", (F.col("total_oas") != F.col("objectives")).alias("stale"))
