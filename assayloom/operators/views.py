"""The whole extraction of table groups: effective headers, column groups, and the flat, inverted and vertical views of a table.

A group is read in three ways, and the view with most usable records is kept. Headers are its own, its leading rows', shifted to where they
fit, or inherited from an earlier group of its width in the patent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.common import written
from assayloom.functions import cells as fn
from assayloom.operators import extract
from assayloom.operators.extract import KEY

#: Leading rows of a headerless group that may be its header.
LEADING = 8
VIEWS = ("flat", "inverted", "vertical")


def lead_promoted(cells: DataFrame, most: int = LEADING) -> DataFrame:
    """Cells of which those in the rows before the first value row of a headerless group, if they look like headers, count as header cells."""
    group, row = Window.partitionBy(*KEY), Window.partitionBy(*KEY, "section", "row_ix")
    shape = fn.value_shape(F.col("text"))
    c = cells.withColumn("_has", F.max(F.col("section") == "header").over(group))
    c = c.withColumns({"_values": F.count_if(shape.isin("num", "bin", "cid")).over(row), "_words": F.count_if(F.col("text").rlike("[A-Za-z]") & ~shape.isin("cid", "bin")).over(row)})
    first = F.min(F.when((F.col("section") == "body") & (F.col("_values") > 0), F.col("row_ix"))).over(group)
    # without any value row there is nothing to head
    lead = (F.col("section") == "body") & ~F.col("_has") & (F.col("_values") == 0) & (F.col("_words") > 0) & (F.col("row_ix") < F.least(first, F.lit(most)))
    return c.withColumn("section", F.when(lead, "header").otherwise(F.col("section"))).drop("_has", "_values", "_words")


def effective_columns(cells: DataFrame) -> DataFrame:
    """(keys, col, header, shape, source) with the header that holds: own, shifted (an own one that fits better further right) or inherited.

    One row per group goes to its patent for inheritance; cells do not.
    """
    cols = extract.columns_of(cells)
    # the place of a table in its document, where scanned cells carry it
    place = F.col("block_ix") if "block_ix" in cells.columns else F.col("table_uid")
    patent = cells.groupBy(*KEY).agg(F.max("patent_id").alias("patent_id"), F.max(place).alias("_place"))
    by_col = lambda c: F.map_from_entries(F.filter(F.collect_list(F.struct("col", F.coalesce(c, F.lit("")).alias("v"))), lambda x: x["v"] != ""))
    g = cols.groupBy(*KEY).agg((F.max("col") + 1).alias("n_cols"), by_col(F.col("header")).alias("_h"), by_col(F.col("shape")).alias("_s"))
    line = lambda m: F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), lambda i: F.coalesce(F.try_element_at(m, i), F.lit("")))
    g = g.withColumns({"header": F.when(F.size("_h") > 0, line(F.col("_h"))).otherwise(F.array().cast("array<string>")), "shapes": line(F.col("_s"))}).drop("_h", "_s")
    g = _shifted(g).join(patent, KEY)
    g = extract.inherit_best(g, order=["_place", *KEY])
    source = F.when(F.col("offset") > 0, "shifted").when(F.size("header") > 0, "own").when(F.col("effective").isNotNull(), "inherited")
    one = g.select(*KEY, "shapes", source.alias("source"), F.posexplode(F.coalesce("effective", F.transform("shapes", lambda s: F.lit("")))).alias("col", "header"))
    out = one.select(*KEY, "col", F.nullif("header", F.lit("")).alias("header"), F.nullif(F.get("shapes", F.col("col")), F.lit("")).alias("shape"), "source")
    return out.filter("header is not null or shape is not null")


def _shifted(groups: DataFrame) -> DataFrame:
    """Headers narrower than their group moved to the right by the offset under which most stand over fitting values; 0 on a tie."""
    width = F.size("header") - F.coalesce(F.array_position(F.transform(F.reverse("header"), lambda h: (h != "").cast("int")), 1), F.lit(1)).cast("int") + 1
    g = groups.withColumn("_w", F.when(F.size("header") > 0, width).otherwise(F.lit(0)))
    score = lambda o: F.aggregate(F.sequence(F.lit(0), F.col("_w") - 1), F.lit(0), lambda n, i: n + F.coalesce(extract.fits(F.get("header", i), F.get("shapes", i + o)), F.lit(False)).cast("int"))
    tries = F.transform(F.sequence(F.lit(0), F.col("n_cols") - F.col("_w")), lambda o: F.struct(score(o).alias("s"), (-o).alias("o")))
    g = g.withColumn("offset", F.when((F.col("_w") > 0) & (F.col("_w") < F.col("n_cols")), -F.array_max(tries)["o"]).otherwise(F.lit(0)))
    moved = F.transform("header", lambda h, i: F.coalesce(F.get("header", i - F.col("offset")), F.lit("")))
    return g.withColumn("header", F.when(F.col("offset") > 0, moved).otherwise(F.col("header"))).drop("_w")


def with_parts(columns: DataFrame) -> DataFrame:
    """Classified columns with ``part``: the number of their (id, value, ...) group where a group repeats its columns, else 0."""
    one = F.struct("col", F.concat_ws(":", "kind", F.lower(F.coalesce("header", F.lit("")))).alias("k"))
    w = Window.partitionBy(*KEY)
    c = columns.withColumn("_k", F.transform(F.array_sort(F.collect_list(one).over(w)), lambda x: x["k"]))
    # the smallest proper period that starts with an id column
    period = F.expr("get(filter(sequence(1, greatest(1, size(_k) - 1)), g -> g < size(_k) and size(_k) % g = 0 and _k[0] like 'cid:%' and forall(sequence(0, size(_k) - 1), i -> _k[i] = _k[i % g])), 0)")
    return c.withColumn("part", F.coalesce(F.floor(F.col("col") / period).cast("int"), F.lit(0))).drop("_k")


def assembled(cells: DataFrame, widths: DataFrame | None = None) -> DataFrame:
    """Cells of whole tables, which their markup may spread over several groups: one group per table, its rows in order.

    The groups whose rows mostly open with an id make the table's body, or, where there are none, those of the width with most rows; other
    groups are notes between them and are left out. Header rows come from every group, each text once; one of a group of other width is put
    over the columns that begin nearest to where its own begin by ``widths`` (keys, col_widths), and is left out without these.
    """
    t = fn.blank_trim(F.col("text"))
    rows = cells.groupBy(*KEY, "section", "row_ix").agg(F.max(F.col("col") + F.col("colspan")).cast("int").alias("w"), F.min(F.when(t != "", F.struct("col", t.alias("t"))))["t"].alias("first"), F.concat_ws("|", F.transform(F.array_sort(F.collect_list(F.struct("col", t.alias("t")))), lambda x: x["t"])).alias("line"))
    body = (F.col("section") == "body") & F.col("first").isNotNull()
    groups = rows.groupBy(*KEY).agg(F.max("w").alias("w"), F.count_if(body).alias("n"), F.count_if(body & fn.is_cid_shaped(F.col("first")) & F.col("first").rlike("[0-9]")).alias("ids"))
    groups = groups.withColumn("kin", (F.col("n") > 0) & (F.col("ids") * 2 >= F.col("n")))
    by_width = groups.groupBy("table_uid", "w").agg(F.sum("n").alias("k"), F.bool_or("kin").alias("kin"))
    chosen = by_width.groupBy("table_uid").agg(F.bool_or("kin").alias("_any"), F.max(F.when(F.col("kin"), F.col("w"))).alias("_kin_w"), F.max(F.struct("k", "w"))["w"].alias("_most_w"))
    chosen = chosen.select("table_uid", "_any", F.when(F.col("_any"), F.col("_kin_w")).otherwise(F.col("_most_w")).alias("_w"))
    groups = groups.join(chosen, "table_uid").withColumn("_in", F.when(F.col("_any"), F.col("kin")).otherwise((F.col("w") == F.col("_w")) & (F.col("n") > 0)))
    if widths is not None:
        groups = groups.join(widths.select(*KEY, "col_widths"), KEY, "left")
    else:
        groups = groups.withColumn("col_widths", F.lit(None).cast("array<double>"))
    table = Window.partitionBy("table_uid")
    home = F.min(F.when(F.col("_in"), F.col("tgroup_ix"))).over(table)
    edges = F.min_by(F.when(F.col("_in") & (F.col("w") == F.col("_w")), F.col("col_widths")), F.when(F.col("_in") & (F.col("w") == F.col("_w")), F.col("tgroup_ix"))).over(table)
    groups = groups.withColumns({"_home": home, "_edges": edges}).filter("_home is not null").select(*KEY, "w", "_w", "_in", "_home", "col_widths", "_edges")
    c = cells.join(groups, KEY).filter((F.col("section") == "header") | F.col("_in"))
    begins = lambda ws, k: F.aggregate(F.slice(ws, F.lit(1), k), F.lit(0.0), lambda x, y: x + y)
    nearest = lambda k: F.array_min(F.transform(F.sequence(F.lit(0), F.col("_w")), lambda i: F.struct(F.abs(begins(F.col("_edges"), i) - begins(F.col("col_widths"), k)).alias("d"), i.alias("i"))))["i"]
    other = (F.col("section") == "header") & (F.col("w") != F.col("_w"))
    at = F.when(other, nearest(F.col("col"))).otherwise(F.col("col"))
    upto = F.when(other, nearest((F.col("col") + F.col("colspan")).cast("int"))).otherwise((F.col("col") + F.col("colspan")).cast("int"))
    c = c.filter(~other | (F.col("_edges").isNotNull() & F.col("col_widths").isNotNull()))
    c = c.withColumns({"_at": at, "_to": upto}).withColumns({"col": F.col("_at").cast("int"), "colspan": F.greatest(F.lit(1), F.col("_to") - F.col("_at")).cast("long")})
    # a header that every group repeats counts once
    line = rows.filter("section = 'header'").select(*KEY, "section", "row_ix", "line")
    once = line.withColumn("_rn", F.row_number().over(Window.partitionBy("table_uid", "line").orderBy("tgroup_ix", "row_ix"))).filter("_rn > 1").drop("_rn", "line")
    c = c.join(once, [*KEY, "section", "row_ix"], "left_anti")
    c = c.withColumn("row_ix", F.dense_rank().over(Window.partitionBy("table_uid", "section").orderBy("tgroup_ix", "row_ix")) - 1)
    return c.withColumn("tgroup_ix", F.col("_home")).select(*cells.columns)


def flat_view(cells: DataFrame, columns: DataFrame) -> DataFrame:
    return extract.records_of_cells(cells, with_parts(extract.kinds_of(columns))).withColumn("view", F.lit("flat"))


def inverted_view(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """Rows that hold a grade and, in another cell, the list of the compounds it was given: one record per compound."""
    row = Window.partitionBy(*KEY, "row_ix")
    t = fn.blank_trim(F.col("text"))
    body = cells.filter("section = 'body'").withColumn("_g", F.max(F.when(t.rlike(r"^(?:\++|\*+|#+|[A-E])$"), F.struct(F.lit(1).alias("k"), t.alias("g")))).over(row))
    headers = columns.groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("col", F.coalesce("header", F.lit("")).alias("h")))).alias("_m"))
    lists = body.filter(F.col("_g").isNotNull() & (F.length(t) - F.length(F.translate(t, ",", "")) >= 2)).join(headers, KEY)
    name = F.nullif(F.try_element_at("_m", F.col("col")), F.lit(""))
    carried = ["patent_id", *KEY, "row_ix", "col", "assay_name", "letter_grade", "unit"]
    lists = lists.select("patent_id", *KEY, "row_ix", "col", "text", F.coalesce(name, F.lit("assay (binned)")).alias("assay_name"), F.col("_g.g").alias("letter_grade"), fn.unit_from(name).alias("unit"))
    return _as_records(extract.explode_id_lists(lists, "text", carried).withColumn("cid", fn.normalize_cid(F.col("cid"))), "inverted")


def vertical_view(cells: DataFrame, least: int = 30, most_unique: float = 0.35) -> DataFrame:
    """Groups of two columns that list a label and a value per row and repeat their labels: one record per measurement of a run of labels.

    A list has at least ``least`` labelled rows, at most ``most_unique`` of them different, and a label in front that comes back at one
    stride of three or more in four fifths of its gaps. The id of a run is the value beside a label that heads ids.
    """
    pair = cells.filter("section = 'body' and text <> ''").groupBy("patent_id", *KEY, "row_ix").agg(F.min_by("text", "col").alias("label"), F.max_by("text", "col").alias("value"), F.count(F.lit(1)).alias("k"), F.max("col").alias("last"))
    pair = pair.filter("k = 2 and last = 1")
    w = Window.partitionBy(*KEY)
    gap = F.col("row_ix") - F.lag("row_ix").over(Window.partitionBy(*KEY, "label").orderBy("row_ix"))
    p = pair.withColumns({"_n": F.count(F.lit(1)).over(w), "_u": F.size(F.collect_set("label").over(w)), "_gap": gap})
    p = p.filter((F.col("_n") >= least) & (F.col("_u") <= most_unique * F.col("_n")))
    gaps = p.filter("_gap is not null").groupBy(*KEY, "label", "_gap").agg(F.count(F.lit(1)).alias("c"))
    strides = gaps.groupBy(*KEY, "label").agg(F.max(F.struct("c", (-F.col("_gap")).alias("g"))).alias("m"), F.sum("c").alias("n"))
    anchors = strides.filter("n >= 5 and -m.g >= 3 and m.c >= 0.8 * n").groupBy(*KEY).agg(F.max_by("label", F.struct("n", F.lower("label"))).alias("_anchor"))
    # of the labels that come back as often, the first of the list opens its records
    firsts = p.groupBy(*KEY, "label").agg(F.min("row_ix").alias("at"), F.count(F.lit(1)).alias("times"))
    opener = firsts.join(anchors, KEY).join(firsts.select(*KEY, F.col("label").alias("_anchor"), F.col("times").alias("_times")), [*KEY, "_anchor"]).filter("times = _times").groupBy(*KEY).agg(F.min_by("label", "at").alias("_opener"))
    runs = p.join(opener, KEY).withColumn("run", F.count_if(F.col("label") == F.col("_opener")).over(Window.partitionBy(*KEY).orderBy("row_ix").rowsBetween(Window.unboundedPreceding, 0))).filter("run > 0")
    kind = fn.header_kind(F.col("label"))
    runs = runs.withColumn("cid", F.max(F.when(kind == "cid", F.struct("row_ix", fn.normalize_cid(F.col("value")).alias("c")))).over(Window.partitionBy(*KEY, "run"))["c"])
    v = runs.filter(kind == "assay").withColumn("v", fn.parse_value(F.col("value")))
    out = v.select("patent_id", *KEY, "row_ix", F.lit(1).alias("col"), F.nullif("cid", F.lit("")).alias("cid"), F.col("label").alias("assay_name"), "v.value_numeric", "v.qualifier", F.coalesce("v.unit", fn.unit_from(F.col("label"))).alias("unit"), "v.n_runs", "v.letter_grade")
    return out.filter("value_numeric is not null or letter_grade is not null").withColumn("view", F.lit("vertical"))


def _as_records(df: DataFrame, view: str) -> DataFrame:
    null = lambda t: F.lit(None).cast(t)
    return df.select("patent_id", *KEY, "row_ix", "col", "cid", "assay_name", null("double").alias("value_numeric"), null("string").alias("qualifier"), "unit", null("int").alias("n_runs"), "letter_grade", F.lit(view).alias("view"))


def usable() -> Column:
    """A record that says which compound, and a value or grade."""
    return F.col("cid").isNotNull() & (F.col("cid") != "") & (F.col("value_numeric").isNotNull() | F.col("letter_grade").isNotNull())


def extract_all(cells: DataFrame) -> DataFrame:
    """Records of every group by its best view: those of ``extract.records_of_cells`` and ``view``. The flat view wins a tie.

    Groups without cells, ids or values give nothing; a group's cells, rows and columns may be in any order. Cells, columns and the records
    of all views are stored in between, so that no view reads the tables again.
    """
    promoted = written(lead_promoted(cells))
    columns = written(effective_columns(promoted))
    every = flat_view(promoted, columns).unionByName(inverted_view(promoted, columns)).unionByName(vertical_view(promoted))
    return extract.best_view(written(every), KEY, "view", usable(), VIEWS[0])
