"""Layout of table groups: header rows without markup, legend rows, assembly of fragments, repeating column groups, vertical lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions import cells as fn
from assayloom.operators.extract import KEY, sessions


def row_profile(cells: DataFrame) -> DataFrame:
    """(keys, section, row_ix, width, n_filled, n_values, n_words, longest, text): one row per table row with cells.

    ``text`` joins the visible texts and identifies the row; a row without any is a spacer.
    """
    t = fn.blank_trim(F.col("text"))
    shape = fn.value_shape(F.col("text"))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cell_ix", t.alias("t")))), lambda x: x["t"]), "|")
    return cells.groupBy("patent_id", *KEY, "section", "row_ix").agg(
        F.sum("colspan").alias("width"), F.count_if(t != "").alias("n_filled"), F.count_if(shape.isin("num", "bin")).alias("n_values"), F.count_if(t.rlike("[A-Za-z]")).alias("n_words"), F.max(F.length(t)).alias("longest"), F.max(F.when(t.contains(" "), F.length(t)).otherwise(0)).alias("prose"), line.alias("text")
    )


def is_spacer() -> Column:
    return F.col("n_filled") == 0


def is_legend_row() -> Column:
    """At most two filled cells, one of them a sentence of more than 55 characters."""
    return (F.col("n_filled") > 0) & (F.col("n_filled") <= 2) & (F.col("prose") > 55)


def is_header_like() -> Column:
    """No cell looks like a value and at least one has a letter."""
    return (F.col("n_values") == 0) & (F.col("n_words") > 0)


def leading_headers(profile: DataFrame, most: int = 8) -> DataFrame:
    """Body rows before the first value row of a group without header rows: (keys, row_ix), at most ``most``."""
    has_header = F.max((F.col("section") == "header").cast("int")).over(Window.partitionBy(*KEY))
    body = profile.withColumn("hh", has_header).filter("hh = 0 and section = 'body'")
    seen = F.max((F.col("n_values") > 0).cast("int")).over(Window.partitionBy(*KEY).orderBy("row_ix").rowsBetween(Window.unboundedPreceding, 0))
    return body.withColumn("seen", seen).filter((F.col("seen") == 0) & is_header_like() & (F.col("row_ix") < most)).select(*KEY, "row_ix")


def assemble_blocks(profile: DataFrame) -> DataFrame:
    """Body rows of all groups of a table in one sequence: (table_uid, seq, tgroup_ix, row_ix, text).

    Spacers and rows that repeat a header row of the table (page breaks) are left out.
    """
    heads = profile.filter("section = 'header'").select("table_uid", "text").distinct()
    body = profile.filter((F.col("section") == "body") & ~is_spacer()).join(heads, ["table_uid", "text"], "left_anti")
    return body.withColumn("seq", F.row_number().over(Window.partitionBy("table_uid").orderBy("tgroup_ix", "row_ix"))).select("table_uid", "seq", "tgroup_ix", "row_ix", "text")


def column_period(columns: DataFrame) -> DataFrame:
    """(keys, n, period): smallest proper period of a group's column kinds and headers, where a period starts with an id column."""
    one = F.struct("col", F.concat_ws(":", "kind", F.lower(F.coalesce("header", F.lit("")))).alias("k"))
    kinds = F.transform(F.array_sort(F.collect_list(one)), lambda x: x["k"])
    g = columns.groupBy(*KEY).agg(kinds.alias("k")).withColumn("n", F.size("k")).filter("n > 1")
    ok = F.expr("filter(sequence(1, n - 1), g -> n % g = 0 and k[0] like 'cid:%' and forall(sequence(0, n - 1), i -> k[i] = k[i % g]))")
    return g.withColumn("period", F.try_element_at(ok, F.lit(1))).filter("period is not null").select(*KEY, "n", "period")


def name_columns(cells: DataFrame, columns: DataFrame, least: int = 3, share: float = 0.5) -> DataFrame:
    """Columns that hold compound names: by header, or an unknown column of which enough cells are chemistry-shaped."""
    body = cells.filter("section = 'body' and text <> ''").groupBy(*KEY, "col").agg(F.count(F.lit(1)).alias("n"), F.count_if(fn.looks_chemical(F.col("text"))).alias("chem"))
    by = columns.join(body, [*KEY, "col"], "left")
    signal = F.when(F.lower(F.coalesce("header", F.lit(""))).contains("name"), "header").when((F.col("kind") == "unknown") & (F.col("chem") >= F.greatest(F.lit(float(least)), share * F.col("n"))), "shape")
    return by.withColumn("signal", signal).filter("signal is not null").select(*KEY, "col", "signal")


def wrapped_rows(rows: DataFrame, keys: list[str], order: str, first: str, text: str) -> DataFrame:
    """Rows without a first cell continue the record before: (keys, session, first, text joined by blanks)."""
    s = sessions(rows, keys, order, F.coalesce(F.trim(first), F.lit("")) != "")
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), " ")
    return s.groupBy(*keys, "session").agg(F.max(first).alias(first), F.trim(line).alias(text))


def rows_matching(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose id cell equals a wanted id; where none does, rows with the id in any cell, flagged inexact.

    rows: (keys, row_ix, id, text); wanted: (keys, id).
    """
    exact = rows.join(wanted, [*keys, "id"], "left_semi").select(*keys, F.col("id").alias("wanted"), "row_ix", F.lit(True).alias("exact"))
    open_ids = wanted.join(exact.select(*keys, F.col("wanted").alias("id")).distinct(), [*keys, "id"], "left_anti")
    tokens = rows.select(*keys, "row_ix", F.explode(F.split("text", r"[|\s]+")).alias("id")).distinct()
    loose = tokens.join(open_ids, [*keys, "id"], "left_semi").select(*keys, F.col("id").alias("wanted"), "row_ix", F.lit(False).alias("exact"))
    return exact.unionByName(loose)


def assembly_fidelity(profile: DataFrame, least: int = 6) -> DataFrame:
    """Groups with at least ``least`` header rows and more of them than body rows: an assembly that went wrong."""
    g = profile.groupBy(*KEY).agg(F.count_if(F.col("section") == "header").alias("n_header"), F.count_if(F.col("section") == "body").alias("n_body"))
    return g.filter((F.col("n_header") >= least) & (F.col("n_header") > F.col("n_body")))


def opens_with_id(cells: DataFrame, measurement_words: list[str]) -> DataFrame:
    """(keys, section, row_ix, opens): whether the first filled cell of a row is an id and no measurement word."""
    t = fn.blank_trim(F.col("text"))
    first = cells.filter(t != "").groupBy(*KEY, "section", "row_ix").agg(F.min_by(t, "cell_ix").alias("_t"))
    return first.select(*KEY, "section", "row_ix", (fn.is_cid_shaped(F.col("_t")) & ~F.lower("_t").isin([w.lower() for w in measurement_words])).alias("opens"))


def measurement_cells(cells: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Cells that say exactly what an entry of the assay list is called."""
    forms = vocabulary.select(F.explode(F.array_union(F.array("canonical"), F.coalesce("surface_forms", F.array().cast("array<string>")))).alias("f")).select(F.lower("f").alias("_f")).distinct()
    return cells.withColumn("_f", F.lower(F.trim("text"))).join(forms, "_f", "left_semi").drop("_f")


def name_rows(cells: DataFrame, longest: int = 60) -> DataFrame:
    """(keys, section, row_ix, n_labels, spans_one, name_like) of every row with text.

    A row is like column names if it has two labels or more of at most ``longest`` characters, not all numbers, and outside the header section
    closes no bracket that the rows before it left open too little of; in the header section one label that is no table title spans one name.
    """
    t = fn.blank_trim(F.col("text"))
    count = lambda ch: F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))
    r = cells.filter(t != "").groupBy(*KEY, "section", "row_ix").agg(
        F.count(F.lit(1)).alias("n_labels"), F.max(F.length(t)).alias("_longest"), F.bool_and(t.rlike(r"^[0-9.,;:<>=~\s\-]+$")).alias("_numbers"), F.max(t).alias("_text"), F.sum(count("(") - count(")")).alias("_round"), F.sum(count("[") - count("]")).alias("_square")
    )
    w = Window.partitionBy(*KEY).orderBy(F.when(F.col("section") == "header", 0).otherwise(1), "row_ix").rowsBetween(Window.unboundedPreceding, 0)
    owed = (F.sum("_round").over(w) < 0) | (F.sum("_square").over(w) < 0)
    title = F.col("_text").rlike(r"(?i)^TABLE\s*[-–]?\s*(?:US[-–]?)?[0-9A-Z]{0,8}(?:\s*[-–]\s*[0-9A-Z]{1,6})?$") | F.col("_text").rlike(r"^[0-9.]+$")
    declared = F.col("section") == "header"
    one = declared & (F.col("n_labels") == 1) & ~title
    like = one | ((F.col("n_labels") >= 2) & (F.col("_longest") <= longest) & ~F.col("_numbers") & (declared | ~owed))
    return r.select(*KEY, "section", "row_ix", F.col("n_labels").cast("int").alias("n_labels"), one.alias("spans_one"), like.alias("name_like"))
