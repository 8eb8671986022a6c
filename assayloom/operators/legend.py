"""Legends: text that defines grades as intervals, and the dimension join that attaches them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions import cells as fn
from assayloom.functions import grades

MAP_TYPE = "map<string,struct<lo:double,hi:double,unit:string>>"


def looks_like_key(c: Column) -> Column:
    """Cheap test before the grammar, true for every text that defines a grade: a grade that is no part of a word, and a digit."""
    return c.rlike(r"[+*#\x{2212}]|(?:^|[^A-Za-z])[A-E](?:$|[^A-Za-z0-9])") & c.rlike(r"[0-9]")


def _as_map(key: dict[str, grades.Interval]) -> dict | None:
    return {g: {"lo": v.lo, "hi": v.hi, "unit": v.unit} for g, v in key.items()} or None


def bin_key(c: Column) -> Column:
    """The legend a text states, as a map; null where it states none."""
    parse = F.pandas_udf(lambda s: s.map(lambda x: _as_map(grades.parse_bin_key(x))), MAP_TYPE)
    return F.when(looks_like_key(c), parse(F.when(looks_like_key(c), c)))


def bins(legends: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """(keys, symbol, lo, hi, unit): legends as rows; distinct texts are parsed once."""
    texts = legends.select(text.alias("_t")).distinct().withColumn("_k", bin_key(F.col("_t"))).filter("_k is not null")
    rows = legends.withColumn("_t", text).join(texts, "_t").select(*keys, F.explode("_k").alias("symbol", "_b"))
    return rows.select(*keys, "symbol", "_b.*")


def drop_conflicts(bins: DataFrame, keys: list[str]) -> DataFrame:
    """One definition per (keys, symbol); a symbol with two different ones in a scope yields none."""
    d = F.struct("lo", "hi", "unit")
    one = bins.groupBy(*keys, "symbol").agg(F.min(d).alias("_a"), F.max(d).alias("_z"))
    return one.filter(F.col("_a").eqNullSafe(F.col("_z"))).select(*keys, "symbol", "_a.*")


def layered(layers: list[DataFrame], keys: list[str]) -> DataFrame:
    """Definitions of several layers, nearest first: the first layer that defines a symbol wins."""
    from functools import reduce

    tagged = reduce(DataFrame.unionByName, [x.select(*keys, "symbol", "lo", "hi", "unit").withColumn("_layer", F.lit(i)) for i, x in enumerate(layers)])
    best = tagged.groupBy(*keys, "symbol").agg(F.min_by(F.struct("lo", "hi", "unit"), "_layer").alias("_d"))
    return best.select(*keys, "symbol", "_d.*")


def attach(records: DataFrame, bins: DataFrame, keys: list[str]) -> DataFrame:
    """Give graded records without bounds the interval of their grade, if the units are of one dimension.

    The key's unit overrides the record's, and ``unit_source`` says so.
    """
    b = bins.select(*keys, F.col("symbol").alias("_s"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("unit").alias("_u"))
    on = [records[k].eqNullSafe(b[k]) for k in keys] + [F.upper(records["letter_grade"]) == b["_s"]]
    joined = records.join(b, on, "left").drop(*[b[k] for k in keys])
    take = F.col("_s").isNotNull() & F.col("range_lo").isNull() & F.col("range_hi").isNull() & fn.compatible(F.col("unit"), F.col("_u"))
    source = {"unit_source": F.when(take, F.lit("bin_key")).otherwise(F.col("unit_source"))} if "unit_source" in records.columns else {}
    return joined.withColumns({"_take": take}).withColumns({"range_lo": F.when(F.col("_take"), F.col("_lo")).otherwise(F.col("range_lo")), "range_hi": F.when(F.col("_take"), F.col("_hi")).otherwise(F.col("range_hi")), "unit": F.when(F.col("_take"), F.coalesce("_u", "unit")).otherwise(F.col("unit")), **source}).drop("_s", "_lo", "_hi", "_u", "_take")


def clusters(hits: DataFrame, keys: list[str], start: str, end: str, gap: int = 120) -> DataFrame:
    """Hits at most ``gap`` characters apart, gathered: (keys, cluster, first, last, n)."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    tagged = hits.withColumn("_new", F.coalesce((F.col(start) - before > gap).cast("int"), F.lit(0)))
    tagged = tagged.withColumn("cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return tagged.groupBy(*keys, "cluster").agg(F.min(start).alias("first"), F.max(end).alias("last"), F.count(F.lit(1)).alias("n"))


def nearest_before(bins: DataFrame, tables: DataFrame, doc: str, order: str) -> DataFrame:
    """Per table (doc, order) the definitions of the last earlier table of its document that has any: (doc, order, symbol, lo, hi, unit).

    One window over the documents' tables with and without definitions; a table's own ones are not its nearest.
    """
    w = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    keyed = bins.groupBy(doc, order).agg(F.collect_list(F.struct("symbol", "lo", "hi", "unit")).alias("_k"))
    near = tables.select(doc, order).distinct().join(keyed, [doc, order], "left").withColumn("_near", F.last("_k", ignorenulls=True).over(w))
    return near.filter("_near is not null").select(doc, order, F.inline("_near"))


def of_rows(rows: DataFrame, keys: list[str], order: str, cells: str, heading: str) -> DataFrame:
    """(keys, symbol, lo, hi, unit) of legends laid out as a table: ``cells`` holds the texts of a row, ``heading`` the table's heading with
    its unit. Rows are a table's, so a group is bounded by its table."""
    one = rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(cells).alias("c")))), lambda x: x["c"]).alias("_r"), F.max(heading).alias("_h"))
    parse = F.pandas_udf(lambda r, h: pd.Series([_as_map(grades.parse_bin_rows([list(x) for x in a if x is not None], b or "")) for a, b in zip(r, h, strict=True)], dtype=object), MAP_TYPE)
    return one.select(*keys, F.explode(parse("_r", "_h")).alias("symbol", "_b")).select(*keys, "symbol", "_b.*")


def sectioned(lines: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """Definitions under headings: (keys, heading, symbol, lo, hi, unit). A line that opens like a definition is no heading, readable or not.

    Lines are a legend's, so a group is bounded by its legend.
    """
    one = lines.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t")))), lambda x: x["t"]).alias("_l"))

    def parse(s: pd.Series) -> pd.Series:
        return s.map(lambda x: {h: _as_map(k) for h, k in grades.sections_of(list(x)).items()} or None)

    found = one.select(*keys, F.explode(F.pandas_udf(parse, f"map<string,{MAP_TYPE}>")("_l")).alias("heading", "_k"))
    return found.select(*keys, "heading", F.explode("_k").alias("symbol", "_b")).select(*keys, "heading", "symbol", "_b.*")


def sections_of_prose(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Definitions of prose that introduces several scales by what they are for: (keys, heading, symbol, lo, hi, unit)."""

    def parse(s: pd.Series) -> pd.Series:
        return s.map(lambda x: {h: m for h, t in grades.prose_sections(x or "") if (m := _as_map(grades.parse_bin_key(t)))} or None)

    found = texts.select(*keys, F.explode(F.pandas_udf(parse, f"map<string,{MAP_TYPE}>")(text)).alias("heading", "_k"))
    return found.select(*keys, "heading", F.explode("_k").alias("symbol", "_b")).select(*keys, "heading", "symbol", "_b.*")


def section_of_column(columns: DataFrame, sections: DataFrame, keys: list[str], header: str) -> DataFrame:
    """Columns with ``heading``: the section of their table's legend that names them, null if none does. Distinct headers are matched once."""
    heads = sections.groupBy(*keys).agg(F.sort_array(F.collect_set("heading")).alias("_hs"))
    pairs = columns.select(*keys, header).distinct().join(heads, keys)
    pick = F.pandas_udf(lambda c, hs: pd.Series([grades.section_for(a or "", list(b)) for a, b in zip(c, hs, strict=True)], dtype=object), "string")
    named = pairs.select(*keys, F.col(header).alias("_c"), pick(header, "_hs").alias("heading"))
    return columns.join(named.withColumnRenamed("_c", header), [*keys, header], "left")


def document_legend(bins: DataFrame, doc: str, order: str) -> DataFrame:
    """(doc, heading, symbol, lo, hi, unit): the last definition of each symbol under a heading counts for the whole document."""
    g = bins.groupBy(doc, "heading", "symbol").agg(F.max_by(F.struct("lo", "hi", "unit"), order).alias("_d"))
    return g.select(doc, "heading", "symbol", "_d.*")
