"""Drawings in tables: which drawing belongs to which compound, substituent tables and their routes, condensed formulas."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.functions import cells as fn
from assayloom.operators.extract import KEY


def drawing_refs(cells: DataFrame) -> DataFrame:
    """(patent_id, cid, chemistry_id): the first drawing in a row whose first cell is an id of at most 40 characters; first row wins."""
    ids = cells.filter("section = 'body' and cell_ix = 0").select("patent_id", *KEY, "row_ix", fn.normalize_cid(F.col("text")).alias("cid")).filter("cid <> ''")
    refs = cells.filter("section = 'body' and chemistry_id is not null").groupBy(*KEY, "row_ix").agg(F.min_by("chemistry_id", "cell_ix").alias("chemistry_id"))
    at = F.struct("table_uid", "tgroup_ix", "row_ix")
    return ids.join(refs, [*KEY, "row_ix"]).groupBy("patent_id", "cid").agg(F.min_by("chemistry_id", at).alias("chemistry_id"))


def header_scaffolds(cells: DataFrame) -> DataFrame:
    """(keys, chemistry_id, scaffold): body drawings of groups whose header holds another drawing."""
    head = cells.filter("section = 'header' and chemistry_id is not null").groupBy(*KEY).agg(F.min_by("chemistry_id", F.struct("row_ix", "cell_ix")).alias("scaffold"))
    return cells.filter("section = 'body' and chemistry_id is not null").join(head, KEY).filter("chemistry_id <> scaffold").select(*KEY, "chemistry_id", "scaffold")


def drawn_tables(cells: DataFrame) -> DataFrame:
    return cells.filter("chemistry_id is not null").select("patent_id", "table_uid").distinct()


def substituent_ids(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """(patent_id, cid, table_uid): ids of tables that are drawn, have a substituent column and no name column; first table per id."""
    from assayloom.operators.layout import name_columns

    slots = columns.filter("kind = 'substituent'").select("table_uid").distinct()
    tables = drawn_tables(cells).join(slots, "table_uid", "left_semi").join(name_columns(cells, columns).select("table_uid").distinct(), "table_uid", "left_anti")
    ids = cells.filter("section = 'body' and cell_ix = 0").select("patent_id", "table_uid", fn.normalize_cid(F.col("text")).alias("cid")).filter("cid <> ''")
    return ids.join(tables.select("table_uid"), "table_uid", "left_semi").groupBy("patent_id", "cid").agg(F.min("table_uid").alias("table_uid"))


def substituent_routes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Route of each row of a substituent table: rows (keys, row_ix, slot, text, has_drawing), one per slot.

    A slot varies if the table has more than one text for it. image_only, image_and_locant, text_only, nothing_varies.
    """
    varying = rows.groupBy(*keys, "slot").agg(F.count_distinct("text").alias("_k")).filter("_k > 1").select(*keys, "slot", F.lit(1).alias("varies"))
    per = rows.join(varying, [*keys, "slot"], "left").groupBy(*keys, "row_ix").agg(F.bool_or("has_drawing").alias("drawn"), F.bool_or((F.col("varies") == 1) & (F.coalesce("text", F.lit("")) != "")).alias("texts"))
    texts = F.coalesce("texts", F.lit(False))
    route = F.when(F.col("drawn") & texts, "image_and_locant").when(F.col("drawn"), "image_only").when(texts, "text_only").otherwise("nothing_varies")
    return per.select(*keys, "row_ix", route.alias("route"))


def before_within(events: DataFrame, things: DataFrame, key: str, start: str, position: str, reach: int, most: int = 2) -> DataFrame:
    """Things in the ``reach`` characters before an event and after the event before it, nearest first; events with more than ``most`` get none.

    events (key, start), things (key, position, ref). Each thing belongs to the next event only, so one running minimum replaces a range join.
    """
    from pyspark.sql import Window

    e = events.select(key, F.col(start).alias("_at"), F.col(start).alias("_event"), F.lit(None).cast("string").alias("ref"))
    t = things.select(key, F.col(position).alias("_at"), F.lit(None).cast(dict(events.dtypes)[start]).alias("_event"), F.col("ref").cast("string").alias("ref"))
    w = Window.partitionBy(key).orderBy("_at").rowsBetween(0, Window.unboundedFollowing)
    near = e.unionByName(t).withColumn("_next", F.first("_event", ignorenulls=True).over(w)).filter((F.col("ref").isNotNull()) & (F.col("_next") - F.col("_at") <= reach))
    n = F.count(F.lit(1)).over(Window.partitionBy(key, "_next"))
    rank = F.row_number().over(Window.partitionBy(key, "_next").orderBy(F.desc("_at"), "ref"))
    return near.withColumn("_n", n).withColumn("rank", rank).filter(F.col("_n") <= most).select(key, F.col("_next").alias(start), "ref", "rank")


def positions_of_parts(refs: Column) -> Column:
    """(table number, part letter) of a reference such as ``Table 2B``."""
    return F.struct(F.regexp_extract(refs, r"(?i)table\s+([0-9]+)", 1).try_cast("int").alias("no"), F.upper(F.regexp_extract(refs, r"(?i)table\s+[0-9]+\s?([a-z])\b", 1)).alias("part"))


_ELEMENT = re.compile(r"\(|\)(\d*)|(Cl|Br|Si|[CHNOSFPIB])(\d*)|(\S)")


def formula_atoms(text: str | None) -> dict[str, int] | None:
    """Atom counts of a condensed formula such as ``CH2CH(CH3)2``; null if it holds anything else or brackets do not close."""
    if not text:
        return None
    stack: list[dict[str, int]] = [{}]
    for m in _ELEMENT.finditer(text.lstrip("-—–")):
        if m.group(4):
            return None
        if m.group() == "(":
            stack.append({})
        elif m.group(2):
            stack[-1][m.group(2)] = stack[-1].get(m.group(2), 0) + int(m.group(3) or 1)
        elif len(stack) > 1:
            inner = stack.pop()
            for k, n in inner.items():
                stack[-1][k] = stack[-1].get(k, 0) + n * int(m.group(1) or 1)
        else:
            return None
    return stack[0] if len(stack) == 1 and stack[0] else None


def atoms(c: Column) -> Column:
    """Atom counts of a condensed formula as a map."""
    return F.pandas_udf(lambda s: s.map(formula_atoms), "map<string,int>")(c)


# Average and monoisotopic masses.
MASSES = {"H": (1.008, 1.00783), "B": (10.81, 11.00931), "C": (12.011, 12.0), "N": (14.007, 14.00307), "O": (15.999, 15.99491), "F": (18.998, 18.9984), "Si": (28.085, 27.97693), "P": (30.974, 30.97376), "S": (32.06, 31.97207), "Cl": (35.45, 34.96885), "Br": (79.904, 78.91834), "I": (126.904, 126.90447)}


def formula_mass(counts: Column, monoisotopic: bool = True) -> Column:
    """Mass of an atom-count map."""
    m = F.create_map(*[x for k, v in MASSES.items() for x in (F.lit(k), F.lit(v[1] if monoisotopic else v[0]))])
    return F.aggregate(F.map_entries(counts), F.lit(0.0), lambda s, e: s + e["value"] * F.try_element_at(m, e["key"]))


def measured(pdf: pd.DataFrame) -> pd.DataFrame:
    """Identity stage of an external recogniser: structure columns null and a reason."""
    return pdf.assign(smiles=None, confidence=None, error="no recogniser")


def table_gate(assembled: DataFrame, keys: list[str], least: float = 0.6) -> DataFrame:
    """(keys, n, checked, agreed, adopt): a table's assembled structures (key, inchikey, verdict) are adopted unless all are the same, and only
    if enough of the checked ones agree with their printed mass, or none can be checked.
    """
    g = assembled.groupBy(*keys).agg(F.count("inchikey").alias("n"), F.count_distinct("inchikey").alias("_d"), F.count_if(F.col("verdict").isin("agrees", "contradicts")).alias("checked"), F.count_if(F.col("verdict") == "agrees").alias("agreed"))
    varied = (F.col("_d") > 1) | (F.col("n") == 1)
    return g.withColumn("adopt", varied & ((F.col("checked") == 0) | (F.col("agreed") >= least * F.col("checked")))).drop("_d")


def map_slots(headings: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, slot, point, refusal): attachment point of each substituent heading by its label on the scaffold; unmarked or doubled ones are refused."""
    lab = labels.groupBy(*keys, F.upper("label").alias("_l")).agg(F.count(F.lit(1)).alias("_k"), F.min("point").alias("point"))
    out = headings.withColumn("_l", F.upper("slot")).join(lab, [*keys, "_l"], "left")
    refusal = F.when(F.col("_k").isNull(), "slot not marked").when(F.col("_k") > 1, "slot marked twice")
    return out.select(*keys, "slot", F.when(F.col("_k") == 1, F.col("point")).alias("point"), refusal.alias("refusal"))
