"""Queries of the general data problems: shredding, orphans, units and wide tables. Names start with the problem's number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.common import plain_cid, table, written_once
from assayloom.operators import orphans, shred, units, wide

# -- 2: deeply nested records ----------------------------------------------------------------------------------------------------


def _nodes(spark: SparkSession, d: str, wanted: shred.Wanted | None = None) -> DataFrame:
    """The stored adjacency table of both sources: ``r|raw_id`` documents, and one ``t|table_uid|tgroup_ix|...`` document per delivered group.

    It is stored once for all queries of a session, and in a narrower form for a query that names what it needs.
    """
    raw, rows = table(spark, d, "raw_tables"), table(spark, d, "table_objects")
    doc = F.concat_ws("|", F.lit("t"), "table_uid", "tgroup_ix", F.xxhash64("scanned_at", "caption", "preceding", "following", "header_rows", "body_rows"))
    files = [x.select(F.col("_metadata")) for x in (raw, rows)]

    def build() -> DataFrame:
        return shred.adjacency(raw, F.concat(F.lit("r|"), F.col("raw_id").cast("string")), F.col("payload"), wanted).unionByName(shred.typed_adjacency(rows, doc, wanted))

    return written_once(files, f"adjacency {wanted}", build)


def p2_cells(spark: SparkSession, d: str) -> DataFrame:
    """Flat cells of both sources with their place, span and parent keys."""
    return shred.cell_entity(_nodes(spark, d)).distinct()


def p2_rows(spark: SparkSession, d: str) -> DataFrame:
    return shred.row_entity(_nodes(spark, d)).select("table_uid", "tgroup_ix", "section", "row_ix").distinct()


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return shred.group_entity(_nodes(spark, d)).select("table_uid", "tgroup_ix", "n_cols").distinct()


def p2_tables(spark: SparkSession, d: str) -> DataFrame:
    return shred.table_entity(_nodes(spark, d)).select("table_uid", "table_id", "caption").distinct()


def p2_rejects(spark: SparkSession, d: str) -> DataFrame:
    """raw_tables rows that give no table: null payloads, payloads that are no JSON (in full), and ones without any table_uid."""
    nodes = _nodes(spark, d).filter("doc like 'r|%'")
    out = shred.rejects(nodes)
    bare = nodes.filter("parent is null and kind <> 'broken'").select("doc").join(shred.table_keys(nodes).select("doc"), "doc", "left_anti")
    out = out.unionByName(bare.select("doc", F.lit("no table").alias("reason"), F.lit(None).cast("string").alias("payload")))
    return out.select(F.substr("doc", F.lit(3)).cast("long").alias("raw_id"), "reason", "payload")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells that cover more than one column."""
    return shred.wide_cells(_nodes(spark, d, shred.WIDE_CELLS)).drop("colspan").distinct()


# -- 4: orphans ------------------------------------------------------------------------------------------------------------------


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    compounds = table(spark, d, "compounds", "compound_row", "patent_id", "cid", "loaded_at", "deleted_at")
    patents = table(spark, d, "patents", "patent_id", "loaded_at", "deleted_at")
    refs = [
        table(spark, d, t, key, "patent_id", "cid", "loaded_at")
        .filter("cid is not null")
        .select(F.lit(t).alias("src_table"), F.col(key).alias("row_id"), F.col("patent_id").alias("k0"), plain_cid(F.col("cid")).alias("k1"), "loaded_at")
        for t, key in (("reader_dump", "dump_row"), ("structures", "structure_id"))
    ]
    by_cid = orphans.find_orphans(refs[0].unionByName(refs[1]), orphans.parents(compounds, [F.col("patent_id"), plain_cid(F.col("cid"))]), 2)
    patent_refs = compounds.select(F.lit("compounds").alias("src_table"), F.col("compound_row").alias("row_id"), F.col("patent_id").alias("k0"), "loaded_at")
    by_patent = orphans.find_orphans(patent_refs, orphans.parents(patents, [F.col("patent_id")]), 1)
    return by_cid.unionByName(by_patent)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Every reference without a valid target, with its kind."""
    return _orphans(spark, d).select("src_table", "row_id", "kind")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per table, month of loaded_at and kind."""
    return orphans.orphan_report(_orphans(spark, d))


# -- 5: units --------------------------------------------------------------------------------------------------------------------


def _converted(spark: SparkSession, d: str, targets: list[str]) -> DataFrame:
    rows = table(spark, d, "assay_records", "record_id", "value_numeric", "unit", "value_text", "column_header", "context_text")
    stated = F.coalesce("unit", units.unit_in_value_text(F.col("value_text"), F.col("value_numeric")), units.unit_in_header(F.col("column_header")), units.unit_in_context(F.col("context_text")))
    rows = rows.withColumn("spelling", units.fold_unit(stated))
    return units.convert(rows, "spelling", "value_numeric", units.conversion_table(spark, targets), "value", "canonical_unit")


def p5_converted(spark: SparkSession, d: str) -> DataFrame:
    """Every record with its value in the canonical unit of its dimension; null where the unit is none that is known."""
    return _converted(spark, d, list(units.CANONICAL.values())).select("record_id", "canonical_unit", F.round("value", 3).alias("value"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Molar values whose unit is not plainly nM, in picomolar."""
    rows = _converted(spark, d, [units.CANONICAL["amount concentration"]]).filter("value is not null and not (unit <=> 'nM')")
    return rows.select("record_id", F.round("value").cast("long").alias("value_pm"))


# -- 6: attribute-value rows -----------------------------------------------------------------------------------------------------

_FACTS = ["value_numeric", "qualifier", "letter_grade", "range_lo", "range_hi"]
_KEYS = ["patent_id", "cid"]


def plain_attribute(c: Column) -> Column:
    """An attribute name in lower case, outer blanks cut, inner runs of blanks made one."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " ")


def _cells(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "reader_dump", "dump_row", *_KEYS, "assay_name", *_FACTS, "loaded_at").filter("cid is not null")
    rows = rows.withColumn("cid", plain_cid(F.col("cid"))).withColumn("assay_name", plain_attribute(F.col("assay_name")))
    return wide.resolve_cells(rows, _KEYS, "assay_name", _FACTS, ["loaded_at", "dump_row"])


#: Column suffix -> (trait, fact, type). Numbers as numbers, grades and qualifiers as text; the flag is there for every attribute.
_FIELDS = {
    "": ("value_numeric", "value_numeric", "double"),
    "__qualifier": ("qualifier", "qualifier", "string"),
    "__grade": ("letter_grade", "letter_grade", "string"),
    "__lo": ("range_lo", "range_lo", "double"),
    "__hi": ("range_hi", "range_hi", "double"),
    "__conflict": ("any", "conflict", "boolean"),
}


def _attributes(spark: SparkSession, d: str) -> list[wide.Attribute]:
    rows = table(spark, d, "reader_dump", "cid", "assay_name", *_FACTS).filter("cid is not null")
    # a column is made for what occurs
    traits = {f: F.col(f).isNotNull() for f in _FACTS} | {"any": F.lit(True)}
    return wide.discover(rows.withColumn("assay_name", plain_attribute(F.col("assay_name"))), "assay_name", traits)


def _blocks(spark: SparkSession, d: str, attributes: list[wide.Attribute], value: Column) -> DataFrame:
    return wide.pivot_blocks(wide.numbered(_cells(spark, d), attributes, "assay_name"), _KEYS, value)


def p6_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per (patent_id, cid): per assay a number column and, where they occur, columns of its grade, bounds and qualifier, and a flag
    that is true where the rows contradict each other. Repeated rows count as their latest."""
    attributes = _attributes(spark, d)
    return wide.widen(_blocks(spark, d, attributes, F.struct(*_FACTS, "conflict")), _KEYS, attributes, _FIELDS)


def p6_cells(spark: SparkSession, d: str) -> DataFrame:
    """The filled cells of the wide table, read off its pivoted form."""
    attributes = _attributes(spark, d)
    blocks = _blocks(spark, d, attributes, F.struct(*_FACTS, "conflict"))
    return wide.unpivot_blocks(blocks, _KEYS, attributes, "assay_name").select(*_KEYS, "assay_name", "value.*")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the wide table that the rows contradict, read off its conflict slots."""
    attributes = _attributes(spark, d)
    blocks = _blocks(spark, d, attributes, F.col("conflict"))
    return wide.unpivot_blocks(blocks, _KEYS, attributes, "assay_name").filter("value").drop("value")


def queries() -> dict:
    own = [p2_found, p2_tables, p2_groups, p2_rows, p2_cells, p2_rejects, p4_found, p4_report, p5_found, p5_converted, p6_found, p6_cells, p6_wide]
    return {f.__name__: f for f in own}
