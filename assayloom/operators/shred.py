"""Shredding of nested records into related flat tables.

Every document becomes an adjacency table: one row per node with its parent, label, ordinal, kind and scalar. JSON texts are parsed once, in
Arrow batches; arrays that are typed already are exploded into the same columns without being parsed. Entities are object nodes joined with
their pivoted scalar children and, for their place, with the entities above them, by equi-joins on node numbers.

The parent of an array's element is the object (or element of an outer array) that holds the array; the element's label is the array's with
``[]`` behind it, and its ordinal the position in it. The array has a node of its own, so that empty arrays stay. ``~`` and ``[`` in keys are
written ``~0`` and ``~1``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.common import BROADCAST_LIMIT, written

NODE_SCHEMA = "doc string, node long, parent long, label string, ordinal int, kind string, scalar string"
_ARROW = pa.schema([("doc", pa.string()), ("node", pa.int64()), ("parent", pa.int64()), ("label", pa.string()), ("ordinal", pa.int32()), ("kind", pa.string()), ("scalar", pa.string())])
_ROWS = 50_000


@dataclass(frozen=True)
class Wanted:
    """What a query needs of the adjacency table, pushed down into the shredding: nodes with one of ``labels``, and objects and arrays with
    one of ``holders``; with ``least_span``, no typed spans below it. Node numbers then count what was kept."""

    labels: frozenset[str]
    holders: frozenset[str] = frozenset()
    least_span: int = 0


def _walk(doc: str, text: str | None, wanted: Wanted | None = None) -> Iterator[tuple]:
    """Nodes of one document, numbered from 0 in preorder. Text that is no JSON gives one node of kind ``broken`` that holds all of it."""
    try:
        root = json.loads(text) if text is not None else None
    except (ValueError, RecursionError):
        yield doc, 0, None, None, 0, "broken", text
        return
    if text is None:
        yield doc, 0, None, None, 0, "broken", None
        return
    labels, holders = (wanted.labels, wanted.holders) if wanted else (None, None)
    # (parent, label, ordinal, value); the label of an element is that of its array
    stack: list[tuple] = [(None, "", 0, root)]
    node = -1
    while stack:
        parent, label, ordinal, v = stack.pop()
        kind = type(v)
        node += 1
        if kind is dict:
            if labels is None or label in labels or label in holders:
                yield doc, node, parent, label, ordinal, "object", None
            children = enumerate(v.items())
            if labels is None:
                inner = [(node, k.replace("~", "~0").replace("[", "~1"), i, x) for i, (k, x) in children]
            else:
                inner = [(node, k, i, x) for i, (k, x) in children if k in labels or type(x) is dict or type(x) is list]
            inner.reverse()
            stack += inner
        elif kind is list:
            if labels is None or label in labels or label in holders:
                yield doc, node, parent, label, ordinal, "array", None
            # an array that is an element itself holds its elements, any other leaves them to its owner
            owner = node if parent is None or label.endswith("[]") else parent
            below = label + "[]"
            if labels is None or below in labels:
                inner = [(owner, below, i, x) for i, x in enumerate(v)]
            else:
                inner = [(owner, below, i, x) for i, x in enumerate(v) if type(x) is dict or type(x) is list]
            inner.reverse()
            stack += inner
        elif kind is str:
            yield doc, node, parent, label, ordinal, "string", v
        elif v is None:
            yield doc, node, parent, label, ordinal, "null", None
        elif kind is bool:
            yield doc, node, parent, label, ordinal, "boolean", "true" if v else "false"
        else:
            yield doc, node, parent, label, ordinal, "number", repr(v)


def adjacency(docs: DataFrame, doc: Column, payload: Column, wanted: Wanted | None = None) -> DataFrame:
    """Adjacency table of JSON documents: (doc, node, parent, label, ordinal, kind, scalar), streamed, one pass, no shuffle."""

    def shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW, strict=True)], schema=_ARROW)
            rows.clear()
            return out

        for b in batches:
            for one, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for r in _walk(one, text, wanted):
                    rows.append(r)
                    if len(rows) >= _ROWS:
                        yield flush()
        if rows:
            yield flush()

    return docs.select(doc.cast("string").alias("doc"), payload.alias("payload")).mapInArrow(shred, NODE_SCHEMA)


def scalar_children(nodes: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """(doc, node, columns): the scalar children of every node that has one of them, pivoted.

    ``columns``: column -> (label, SQL expression over ``scalar``). Numbers are cast before they are aggregated, which keeps the
    aggregation in fixed-width buffers.
    """
    labels = sorted({label for label, _ in columns.values()})
    rows = nodes.filter(F.col("label").isin(labels) & ~F.col("kind").isin("object", "array", "null"))
    return rows.groupBy("doc", F.col("parent").alias("node")).agg(*[F.expr(f"max(CASE WHEN label = '{label}' THEN {value} END)").alias(k) for k, (label, value) in columns.items()])


def rejects(nodes: DataFrame) -> DataFrame:
    """(doc, reason, payload) of documents that are null or no JSON; nothing of a text is cut."""
    return nodes.filter("kind = 'broken'").select("doc", F.when(F.col("scalar").isNull(), "null").otherwise("not json").alias("reason"), F.col("scalar").alias("payload"))


# -- tables of table documents ---------------------------------------------------------------------------------------------------

_SECTIONS = ("header_rows", "body_rows")
_ROW_LABELS = [f"{s}[]" for s in _SECTIONS]
_CELL_LABELS = [*(f"{s}[][]" for s in _SECTIONS), "cells[]"]


def table_keys(nodes: DataFrame) -> DataFrame:
    """(doc, table_node, table_uid) of every object with a table_uid."""
    return nodes.filter("label = 'table_uid' and scalar is not null").select("doc", F.col("parent").alias("table_node"), F.col("scalar").try_cast("long").alias("table_uid"))


def table_entity(nodes: DataFrame) -> DataFrame:
    """tables(doc, table_node, table_uid, table_id, caption). A caption is a text or an object with a text."""
    own = scalar_children(nodes, {"table_id": ("table_id", "scalar"), "plain": ("caption", "scalar")}).withColumnRenamed("node", "table_node")
    held = nodes.filter("label = 'caption' and kind = 'object'").select("doc", F.col("parent").alias("table_node"), "node")
    held = held.join(scalar_children(nodes, {"held": ("text", "scalar")}), ["doc", "node"]).drop("node")
    out = table_keys(nodes).join(own, ["doc", "table_node"], "left").join(held, ["doc", "table_node"], "left")
    return out.select("doc", "table_node", "table_uid", "table_id", F.coalesce("plain", "held").alias("caption"))


def group_entity(nodes: DataFrame) -> DataFrame:
    """groups(doc, group_node, table_uid, tgroup_ix, n_cols): elements of ``tgroups``, or a lone group object, which counts as 0."""
    lone = F.col("label").isin("tgroup", "tgroups")
    g = nodes.filter((lone | (F.col("label") == "tgroups[]")) & (F.col("kind") == "object"))
    g = g.select("doc", F.col("node").alias("group_node"), F.col("parent").alias("table_node"), F.when(lone, 0).otherwise(F.col("ordinal")).alias("tgroup_ix"))
    n_cols = scalar_children(nodes, {"n_cols": ("n_cols", "try_cast(scalar AS int)")}).withColumnRenamed("node", "group_node")
    return g.join(table_keys(nodes), ["doc", "table_node"]).join(n_cols, ["doc", "group_node"], "left").select("doc", "group_node", "table_uid", "tgroup_ix", "n_cols")


def row_entity(nodes: DataFrame) -> DataFrame:
    """rows(doc, row_node, table_uid, tgroup_ix, section, row_ix): a row is an array of cells or an object that holds one; empty rows stay."""
    rows = nodes.filter(F.col("label").isin(_ROW_LABELS))
    rows = rows.select("doc", F.col("node").alias("row_node"), F.col("parent").alias("group_node"), F.regexp_replace("label", "_rows.*", "").alias("section"), F.col("ordinal").alias("row_ix"))
    return rows.join(group_entity(nodes).drop("n_cols"), ["doc", "group_node"]).select("doc", "row_node", "table_uid", "tgroup_ix", "section", "row_ix")


_LAST_NUMBER = r"try_cast(regexp_extract(scalar, '([0-9]+)\\s*$', 1) AS int)"
_SPAN = {"span": ("colspan", "try_cast(try_cast(trim(scalar) AS double) AS int)"), "first": ("namest", _LAST_NUMBER), "last": ("nameend", _LAST_NUMBER)}


def _span() -> Column:
    by_name = F.col("last") - F.col("first") + 1
    return F.greatest(F.lit(1), F.coalesce("span", by_name, F.lit(1)), F.coalesce(by_name, F.lit(1)))


#: What ``wide_cells`` needs: spans, the cells that are objects, and everything above them.
WIDE_CELLS = Wanted(frozenset(["table_uid", "colspan", "namest", "nameend", "tgroup", "tgroups", "tgroups[]", *_ROW_LABELS]), frozenset(_CELL_LABELS), 2)


#: Bytes of one span in a broadcast table, generously.
SPAN_BYTES = 256


def _cells(nodes: DataFrame) -> DataFrame:
    cells = nodes.filter(F.col("label").isin(_CELL_LABELS))
    return cells.select("doc", "node", F.col("parent").alias("row_node"), F.col("ordinal").alias("cell_ix"), F.col("scalar").alias("own"))


def wide_cells(nodes: DataFrame) -> DataFrame:
    """(table_uid, tgroup_ix, section, row_ix, cell_ix, colspan) of the cells that cover more than one column.

    The pivoted spans are few against the cells and meet them first; only what is left looks up its row. A count below 2 adds nothing to a
    span and is left out before the pivot.
    """
    spans = scalar_children(nodes.filter("label <> 'colspan' or try_cast(scalar AS double) >= 2"), _SPAN).select("doc", "node", _span().alias("colspan")).filter("colspan > 1")
    spans = written(spans)
    # few and counted, they are broadcast to the cells, which then need no shuffle; beyond the bound both sides shuffle
    side = F.broadcast(spans) if spans.count() * SPAN_BYTES <= BROADCAST_LIMIT else spans
    found = _cells(nodes).drop("own").join(side, ["doc", "node"])
    return found.join(row_entity(nodes), ["doc", "row_node"]).select("table_uid", "tgroup_ix", "section", "row_ix", "cell_ix", "colspan")


def cell_entity(nodes: DataFrame) -> DataFrame:
    """cells(table_uid, tgroup_ix, section, row_ix, cell_ix, text, colspan, col_start, chemistry_id).

    The span is a count (number or text) or a first and last column name; anything below 2, absent or senseless is one column. A plain
    scalar in a cell's place is a cell and its own text.
    """
    scalars = {"text": ("text", "scalar"), "start": ("col_start", "try_cast(scalar AS int)"), "chem": ("chemistry_id", "scalar")}
    chem = nodes.filter("label = 'chemistry' and kind = 'object'").select("doc", F.col("node").alias("held"), F.col("parent").alias("node"))
    chem = chem.join(scalar_children(nodes, {"chem_held": ("id", "scalar")}).withColumnRenamed("node", "held"), ["doc", "held"]).drop("held")
    out = _cells(nodes).join(scalar_children(nodes, scalars | _SPAN), ["doc", "node"], "left").join(chem, ["doc", "node"], "left").join(row_entity(nodes), ["doc", "row_node"])
    return out.select(
        *["table_uid", "tgroup_ix", "section", "row_ix", "cell_ix"], F.coalesce("text", "own").alias("text"), _span().alias("colspan"), F.nullif(F.col("start"), F.lit(-1)).alias("col_start"), F.coalesce("chem_held", "chem").alias("chemistry_id")
    )


def typed_adjacency(tables: DataFrame, doc: Column, wanted: Wanted | None = None) -> DataFrame:
    """table_objects rows as nodes of the same kind of documents: one table with the one group of the row, at its position.

    Cells are numbered by their place: row number, section and cell number in one 64-bit number (rows below 2**32, cells of a row below
    2**24), what is above them by negative numbers. Fields without a value have no node.
    """
    node = lambda n, parent, label, ordinal, kind, scalar: F.struct(
        *[x.cast(t).alias(k) for k, t, x in (("node", "long", n), ("parent", "long", parent), ("label", "string", label), ("ordinal", "int", ordinal), ("kind", "string", kind), ("scalar", "string", scalar))]
    )
    none, zero = F.lit(None), F.lit(0)
    child = lambda c, n, parent, label, kind, value: F.when(c & F.lit(wanted is None or label in wanted.labels), node(n, F.lit(parent), F.lit(label), zero, F.lit(kind), value))
    head = F.array(
        F.when(F.lit(wanted is None), node(F.lit(-1), none, F.lit(""), zero, F.lit("object"), none)),
        child(F.col("table_uid").isNotNull(), F.lit(-2), -1, "table_uid", "number", F.col("table_uid")),
        child(F.col("table_id").isNotNull(), F.lit(-3), -1, "table_id", "string", F.col("table_id")),
        child(F.col("caption").isNotNull(), F.lit(-4), -1, "caption", "string", F.col("caption")),
        node(F.lit(-5), F.lit(-1), F.lit("tgroups[]"), F.col("tgroup_ix"), F.lit("object"), none),
        child(F.col("n_cols").isNotNull(), F.lit(-6), -5, "n_cols", "number", F.col("n_cols")),
        *[child(F.col(s).isNotNull(), F.lit(-7 - i), -5, s, "array", none) for i, s in enumerate(_SECTIONS)],
    )
    top = tables.select(doc.alias("doc"), F.explode(F.array_compact(head)).alias("n"))
    sections = tables.select(doc.alias("doc"), F.inline(F.array(*[F.struct(F.lit(i).alias("s"), F.lit(s).alias("section"), F.col(s).alias("rows")) for i, s in enumerate(_SECTIONS)])))
    rows = sections.select("doc", "s", "section", F.posexplode("rows").alias("row_ix", "row"))
    cells = rows.select("doc", "s", "section", "row_ix", F.col("row").isNull().alias("no_row"), F.posexplode_outer("row").alias("cell_ix", "c"))
    cells = cells.withColumn("at", F.shiftleft(F.col("row_ix").cast("long") * 2 + F.col("s"), 27))
    cell = F.col("at") + F.shiftleft(F.col("cell_ix").cast("long"), 3) + 1
    here = F.col("c").isNotNull()
    least = wanted.least_span if wanted else 0
    has = lambda field: here & ((F.col("c.colspan") >= least) if least and field == "colspan" else F.col(f"c.{field}").isNotNull())
    scalar = lambda field, i, kind: F.when(has(field), node(cell + i, cell, F.lit(field), zero, F.lit(kind), F.col(f"c.{field}")))
    fields = [(f, i, k) for i, (f, k) in enumerate((("text", "string"), ("colspan", "number"), ("col_start", "number"), ("chemistry_id", "string")), 1) if wanted is None or f in wanted.labels]
    inner = F.array(
        F.when(F.coalesce("cell_ix", zero) == 0, node(F.col("at"), F.lit(-5), F.concat("section", F.lit("[]")), F.col("row_ix"), F.when(F.col("no_row"), "null").otherwise("array"), none)),
        F.when(here if wanted else F.col("cell_ix").isNotNull(), node(cell, F.col("at"), F.concat("section", F.lit("[][]")), F.col("cell_ix"), F.when(here, "object").otherwise("null"), none)),
        *[scalar(*f) for f in fields],
    )
    below = cells.select("doc", F.explode(inner).alias("n")).filter("n is not null")
    return top.unionByName(below).select("doc", "n.*")
