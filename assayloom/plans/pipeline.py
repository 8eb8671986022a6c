"""The whole way from documents to delivered compounds, as one lazy plan per artifact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayloom.common import written
from assayloom.functions import texts
from assayloom.operators import audit, deliver, extract, identity, legend, rules, views
from assayloom.sources import documents as src


@dataclass
class Dump:
    records: DataFrame
    structures: DataFrame
    losses: DataFrame
    flags: DataFrame
    manifest: DataFrame
    compounds: DataFrame


def cells_of(docs: DataFrame) -> DataFrame:
    """Scanned cells in the form the extraction reads; a table is keyed by a hash of patent and block."""
    c = src.parse_cells(docs)
    before = F.coalesce(F.sum("colspan").over(Window.partitionBy("patent_id", "block_ix", "tgroup_ix", "section", "row_ix").orderBy("cell_ix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return c.withColumn("table_uid", F.xxhash64("patent_id", "block_ix")).withColumn("col", F.when(F.col("col_start") >= 0, F.col("col_start")).otherwise(before).cast("int"))


def dump(docs: DataFrame, structures: DataFrame | None = None) -> Dump:
    """Records with their intervals and units, structures by precedence, losses, audit flags, manifest and delivered compounds.

    Blocks are put together from their groups and read by their best view. A legend is looked for in the table's own cells and rows, in its caption, in the last table before it
    that has one, and in the description; the first of these that defines a grade counts. The unit of a record without one comes from
    the description if all its sentences with the metric agree. Documents without tables give nothing; structures (patent_id, cid, name,
    inchikey, source, structure_id) come from a name or drawing route and may be left out.
    """
    cells = written(cells_of(docs))
    widths = src.parse_groups(docs).select(F.xxhash64("patent_id", "block_ix").alias("table_uid"), "tgroup_ix", "col_widths")
    recs = views.extract_all(views.assembled(cells, widths))
    tables = cells.select("patent_id", "table_uid", "block_ix", "table_id").distinct()
    captions = src.context_of_blocks(docs).join(tables, ["patent_id", "block_ix"]).select("table_uid", F.col("caption").alias("text"))
    body = cells.filter("section = 'body'").select("table_uid", "text")
    rows = cells.groupBy("table_uid", "tgroup_ix", "section", "row_ix").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell_ix", "text"))), lambda x: x["text"]).alias("line"))
    heads = F.max(F.when(F.col("section") == "header", F.array_join("line", " "))).over(Window.partitionBy("table_uid", "tgroup_ix"))
    rows = rows.withColumn("heading", heads).filter("section = 'body'")
    own = legend.bins(body.filter("text is not null"), ["table_uid"], F.col("text"))
    own = own.unionByName(legend.of_rows(rows, ["table_uid", "tgroup_ix"], "row_ix", "line", "heading").drop("tgroup_ix"))
    own = written(legend.drop_conflicts(own, ["table_uid"]))
    stated = legend.drop_conflicts(legend.bins(captions.filter("text is not null"), ["table_uid"], F.col("text")), ["table_uid"])
    placed = own.join(tables.select("table_uid", "patent_id", "block_ix"), "table_uid")
    near = legend.nearest_before(placed, tables, "patent_id", "block_ix").join(tables.select("table_uid", "patent_id", "block_ix"), ["patent_id", "block_ix"])
    told = legend.drop_conflicts(legend.bins(src.description_text(docs), ["patent_id"], F.col("text")), ["patent_id"]).join(tables.select("patent_id", "table_uid"), "patent_id")
    layers = [own, stated, near.select("table_uid", "symbol", "lo", "hi", "unit"), told.select("table_uid", "symbol", "lo", "hi", "unit")]
    recs = recs.withColumns({"range_lo": F.lit(None).cast("double"), "range_hi": F.lit(None).cast("double"), "unit_source": F.when(F.col("unit").isNotNull(), F.lit("column"))})
    recs = legend.attach(recs, legend.layered(layers, ["table_uid"]), ["table_uid"])
    from assayloom.functions import cells as fn

    stated = texts.stated_units(src.description_text(docs), "patent_id", "text").withColumnRenamed("unit", "_u")
    recs = recs.withColumn("metric", fn.metric_of(F.col("assay_name"))).join(stated, ["patent_id", "metric"], "left")
    take = F.col("unit").isNull() & F.col("_u").isNotNull() & F.col("value_numeric").isNotNull()
    recs = recs.withColumns({"unit_source": F.when(take, "description").otherwise(F.col("unit_source")), "unit": F.when(take, F.col("_u")).otherwise(F.col("unit"))}).drop("_u", "metric")
    recs = recs.join(tables.select("table_uid", "table_id"), "table_uid", "left").withColumn("value_text", F.lit(None).cast("string"))
    if structures is None:
        structures = docs.sparkSession.createDataFrame([], "patent_id string, cid string, name string, inchikey string, source string, structure_id long")
    losses = deliver.losses([("no_id", recs.filter("cid is null"), ["assay_name", "table_id"]), ("inchikey_resolution_empty", structures.filter("inchikey is null"), ["name"])])
    best = identity.best_structure(structures, ["patent_id", "cid"]).select("patent_id", "cid", "name", "inchikey", "source")
    return Dump(recs, structures, losses, audit.audit(recs, cells), deliver.manifest(recs, structures, losses), deliver.compounds(best, recs.filter("cid is not null"), ["patent_id", "cid"]))


def heal_with_library(cells: DataFrame, records: DataFrame, library: DataFrame, keys: list[str]) -> DataFrame:
    """Records after the library's column maps: healed records join the baseline, then per compound, assay and table the richest stay."""
    from assayloom.functions import cells as fn

    sig = extract.layout_signature(cells).select(*keys, "fingerprint")
    made = rules.apply_column_maps(cells.join(sig, keys), library, keys).withColumn("v", fn.parse_value(F.col("text")))
    cols = ["cid", "assay_name", "value_numeric", "unit", "letter_grade"]
    healed = made.select(*keys, fn.normalize_cid(F.col("cid")).alias("cid"), "assay_name", "v.value_numeric", F.coalesce("v.unit", "unit").alias("unit"), "v.letter_grade")
    both = records.select(*keys, *cols).unionByName(healed).withColumns({"range_lo": F.lit(None).cast("double"), "range_hi": F.lit(None).cast("double")})
    return rules.heal_merge(both, [*keys, "cid", "assay_name"], ["value_numeric", "unit", "letter_grade"])
