"""Wide tables into long measurement records: columns, their kinds, carry-forward of ids and the row generators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions import cells as fn
from assayloom.functions import texts

KEY = ["table_uid", "tgroup_ix"]


def flat_cells(tables: DataFrame) -> DataFrame:
    """(patent_id, table_uid, tgroup_ix, section, row_ix, cell_ix, text, colspan, col, chemistry_id) of typed tables, delivered once.

    ``col`` is the first column a cell covers: its start if that is known, else the sum of the spans before it. The one shuffle is that by
    table group; all that follows per group, column or row keeps its partitioning.
    """
    one = tables.groupBy(*KEY).agg(F.min_by(F.struct("patent_id", "header_rows", "body_rows"), F.struct("scanned_at")).alias("t"))
    sections = one.select("t.patent_id", *KEY, F.inline(F.array(*[F.struct(F.lit(s).alias("section"), F.col(f"t.{s}_rows").alias("rows")) for s in ("header", "body")])))
    rows = sections.select("patent_id", *KEY, "section", F.posexplode("rows").alias("row_ix", "row"))
    flat = rows.select("patent_id", *KEY, "section", "row_ix", F.posexplode("row").alias("cell_ix", "c"))
    flat = flat.select("patent_id", *KEY, "section", "row_ix", "cell_ix", F.coalesce("c.text", F.lit("")).alias("text"), F.greatest(F.coalesce("c.colspan", F.lit(1)), F.lit(1)).alias("colspan"), F.col("c.col_start").alias("col_start"), F.col("c.chemistry_id").alias("chemistry_id"))
    before = F.coalesce(F.sum("colspan").over(Window.partitionBy(*KEY, "section", "row_ix").orderBy("cell_ix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return flat.withColumn("col", F.when(F.col("col_start") >= 0, F.col("col_start")).otherwise(before).cast("int")).drop("col_start")


_SHAPES = ["bin", "cid", "num", "text"]


def columns_of(cells: DataFrame, first: int = 40, share: float = 0.6) -> DataFrame:
    """(keys, col, header, shape, n, stray): one pass over the cells of each group.

    header: the header lines over a column from top to bottom, spans fanned out, repeats dropped; null without any. shape: that of more
    than ``share`` of the first non-blank values of the column, else ``mixed``, null without values; n counts these values, stray those that
    are a single letter outside A to E.
    """
    at = F.explode(F.when(F.col("section") == "header", F.sequence(F.col("col"), F.col("col") + F.col("colspan") - 1)).otherwise(F.array("col")))
    # a window over the group comes first, so that cells are placed by group and stay there
    c = cells.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*KEY))).select(*KEY, "section", "row_ix", "cell_ix", "text", at.alias("at"))
    c = c.withColumn("_s", F.when(F.col("section") == "body", fn.value_shape(F.col("text"))))
    seen = F.count_if(F.col("_s") != "empty").over(Window.partitionBy(*KEY, "at").orderBy("row_ix", "cell_ix").rowsBetween(Window.unboundedPreceding, 0))
    c = c.withColumn("_in", (F.col("_s") != "empty") & (seen <= first))
    line = F.when((F.col("section") == "header") & (F.col("text") != ""), F.struct("row_ix", "text"))
    g = c.groupBy(*KEY, F.col("at").alias("col")).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["text"])).alias("_h"), F.count_if("_in").alias("n"), F.count_if(F.col("_in") & fn.blank_trim(F.col("text")).rlike("^[F-Zf-z]$")).alias("stray"), *[F.count_if(F.col("_in") & (F.col("_s") == s)).alias(f"_{s}") for s in _SHAPES])
    top = F.greatest(*[F.struct(F.col(f"_{s}").alias("k"), F.lit(s).alias("s")) for s in _SHAPES])
    shape = F.when(F.col("n") > 0, F.when(top["k"] > F.col("n") * share, top["s"]).otherwise("mixed"))
    return g.select(*KEY, "col", F.when(F.size("_h") > 0, F.array_join("_h", " ")).alias("header"), shape.alias("shape"), "n", "stray")


def merged_headers(cells: DataFrame) -> DataFrame:
    """(keys, col, header) of the columns with a header."""
    return columns_of(cells).filter("header is not null").select(*KEY, "col", "header")


def column_shapes(cells: DataFrame) -> DataFrame:
    """(keys, col, shape, n) of the columns with values."""
    return columns_of(cells).filter("n > 0").select(*KEY, "col", "shape", "n")


def layout_signature(cells: DataFrame) -> DataFrame:
    """(keys, signature, fingerprint, shapes, words): width, column shapes and header words of a group, and 16 hex digits of its SHA-256; the
    shapes and the distinct header words as lists of their own."""
    cols = columns_of(cells).filter("header is not null or n > 0")
    part = F.struct("col", F.coalesce("shape", F.lit("empty")).alias("s"), F.lower(F.coalesce("header", F.lit(""))).alias("h"))
    sig = cols.groupBy(*KEY).agg(F.array_sort(F.collect_list(part)).alias("_p"))
    text = F.concat_ws("|", F.size("_p").cast("string"), F.array_join(F.transform("_p", lambda x: F.concat_ws(":", x["s"], x["h"])), "|"))
    words = F.array_distinct(F.filter(F.split(F.array_join(F.transform("_p", lambda x: x["h"]), " "), "[^a-z0-9]+"), lambda w: w != ""))
    sig = sig.select(*KEY, text.alias("signature"), F.transform("_p", lambda x: x["s"]).alias("shapes"), words.alias("words"))
    return sig.withColumn("fingerprint", F.substr(F.sha2("signature", 256), F.lit(1), F.lit(16)))


def classify_columns(cells: DataFrame) -> DataFrame:
    """(keys, col, header, kind, unit, shape), see ``kinds_of``."""
    return kinds_of(columns_of(cells).filter("header is not null or n > 0"))


#: Share of a column of grades that may be letters outside the grades; more, and the column enumerates something else.
STRAY = 0.05
UNNAMED_GRADES = "unnamed assay (letter bin)"


def kinds_of(columns: DataFrame) -> DataFrame:
    """Columns (keys, col, header, shape and, if known, n and stray) with kind, unit and label_source.

    Without an id column by header, the leftmost unnamed column with id-shaped values is the id column. A column of grades that its header
    makes nothing is an assay; without a header its label comes from its shape. A negative logarithm is its own unit.
    """
    closed = (F.col("stray") <= STRAY * F.col("n")) if "stray" in columns.columns else F.lit(True)
    logged = F.lower(F.regexp_replace(F.regexp_extract(F.col("header"), fn.P_METRIC, 0), "[ _]", ""))
    p_unit = F.coalesce(*[F.when(logged == u.lower(), F.lit(u)) for u in fn.P_UNITS])
    cols = columns.withColumns({"by_header": F.when(F.col("header").isNotNull(), fn.header_kind(F.col("header"))), "unit": F.coalesce(fn.unit_from(F.col("header")), p_unit)})
    w = Window.partitionBy(*KEY)
    has_cid = F.max(F.coalesce((F.col("by_header") == "cid").cast("int"), F.lit(0))).over(w)
    spare = (F.col("shape") == "cid") & (F.coalesce(F.col("by_header"), F.lit("unknown")) == "unknown")
    leftmost = F.min(F.when(spare, F.col("col"))).over(w)
    graded = (F.coalesce(F.col("by_header"), F.lit("unknown")) == "unknown") & (F.col("shape") == "bin") & closed
    kind = F.when((has_cid == 0) & (F.col("col") == leftmost), "cid").when(graded, "assay").otherwise(F.coalesce("by_header", F.lit("unknown")))
    source = F.when(F.col("header").isNotNull(), "header").when(graded, "shape")
    return cols.select(*KEY, "col", "header", kind.alias("kind"), "unit", "shape", source.alias("label_source"))


def inherit_headers(groups: DataFrame) -> DataFrame:
    """Groups (patent_id, keys, n_cols, header) without a header take that of the last group before with the same width in the patent."""
    w = Window.partitionBy("patent_id", "n_cols").orderBy(*KEY)
    known = F.nullif(F.col("header"), F.lit(""))
    return groups.withColumn("inherited", F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("effective", F.coalesce(known, "inherited"))


def carry_forward(rows: DataFrame, cid: Column, blocked: Column, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``cid``: the row's own id, else that of the last row before that has one; a row with its own drawing takes none."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = F.nullif(cid, F.lit(""))
    return rows.withColumn("cid", F.when(own.isNotNull(), own).when(~blocked, F.last(own, ignorenulls=True).over(w)))


def records(tables: DataFrame) -> DataFrame:
    """Long records of typed tables, see ``records_of_cells``."""
    return records_of_cells(flat_cells(tables))


def records_of_cells(cells: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """Long records: keys, row_ix, col, cid, header, unit, parsed value fields. Unparsed and blank cells are left out.

    ``columns`` (keys, col, kind, header, unit and, for repeating column groups, part) default to the classified ones. Each part of a row has
    its own id; a row without an id of its own takes that of the last row before that has one, unless it has a drawing.
    """
    columns = classify_columns(cells) if columns is None else columns
    part = F.col("part") if "part" in columns.columns else F.lit(0)
    # a group's columns travel as one map, so that cells and columns meet on the group, by which both are placed
    about = F.map_from_entries(F.collect_list(F.struct("col", F.struct("kind", "header", "unit", part.alias("part")).alias("m"))))
    body = cells.filter("section = 'body'").join(columns.groupBy(*KEY).agg(about.alias("_m")), KEY).withColumn("_c", F.try_element_at("_m", F.col("col"))).drop("_m")
    body = body.withColumn("part", F.coalesce("_c.part", F.lit(0)))
    row = Window.partitionBy(*KEY, "part", "row_ix")
    first = F.min(F.when(F.col("_c.kind") == "cid", F.struct("col", "text"))).over(row)
    drawn = F.max(F.col("chemistry_id").isNotNull()).over(Window.partitionBy(*KEY, "row_ix"))
    body = body.withColumns({"_id": first, "_drawn": drawn}).withColumn("_own", F.nullif(fn.normalize_cid(F.col("_id.text")), F.lit("")))
    upto = Window.partitionBy(*KEY, "part").orderBy("row_ix").rangeBetween(Window.unboundedPreceding, 0)
    cid = F.when(F.col("_own").isNotNull(), F.col("_own")).when(F.col("_id").isNotNull() & ~F.col("_drawn"), F.last("_own", ignorenulls=True).over(upto))
    # replicate counts may stand in a column of their own behind the values
    across = Window.partitionBy(*KEY, "row_ix").orderBy("col")
    behind = F.when((F.lead("_c.kind").over(across) == "nruns") & (F.lead("col").over(across) == F.col("col") + F.col("colspan")), F.regexp_extract(F.lead("text").over(across), r"^\s*\(?\s*(?:n\s*=\s*)?([0-9]{1,3})\s*\)?\s*$", 1).try_cast("int"))
    long = body.withColumns({"cid": cid, "_runs": behind}).filter("_c.kind = 'assay'")
    name = F.coalesce("_c.header", F.lit(UNNAMED_GRADES))
    # a header that lists several assays, over cells that list as many values
    listed = F.when(F.col("_c.header").contains(",") & F.col("text").rlike(r",\s"), texts.zip_lists(F.col("_c.header"), F.col("text")))
    named = F.filter(listed, lambda x: x["header"].rlike("[A-Za-z]{2}") & (fn.unit_from(x["header"]).isNull() | (F.length(x["header"]) > 8)))
    pairs = F.when(F.size(named) == F.size(listed), listed).otherwise(F.array(F.struct(name.alias("header"), F.col("text").alias("value"))))
    long = long.withColumn("_p", F.explode(pairs)).withColumn("v", fn.parse_value(F.col("_p.value")))
    keep = F.col("v.value_numeric").isNotNull() | F.col("v.letter_grade").isNotNull()
    return long.filter(keep).select("patent_id", *KEY, "row_ix", "col", "cid", F.col("_p.header").alias("assay_name"), "v.value_numeric", "v.qualifier", F.coalesce("v.unit", "_c.unit").alias("unit"), F.coalesce("v.n_runs", "_runs").alias("n_runs"), "v.letter_grade")


def explode_id_lists(rows: DataFrame, ids: str, carried: list[str]) -> DataFrame:
    """One row per id of a comma list with at least ``3`` parts of which 70 % are id-shaped; other rows are left out."""
    parts = F.transform(F.split(ids, r"\s*,\s*"), lambda x: F.trim(x))
    shaped = F.filter(parts, lambda x: fn.is_cid_shaped(x))
    ok = (F.size(parts) >= 3) & (F.size(shaped) >= 0.7 * F.size(parts))
    return rows.filter(ok).select(*carried, F.explode(shaped).alias("cid"))


def sessions(rows: DataFrame, keys: list[str], order: str, starts: Column) -> DataFrame:
    """Add ``session``: number of rows so far for which ``starts`` holds, per key (records of a vertical list, gap clusters)."""
    return rows.withColumn("session", F.sum(starts.cast("int")).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def modal_stride(rows: DataFrame, keys: list[str], label: str, position: str, least: int = 5) -> DataFrame:
    """(keys, label, stride, share, n): most frequent distance between repeats of a label (smallest on a tie) and its share of the gaps."""
    gap = F.col(position) - F.lag(position).over(Window.partitionBy(*keys, label).orderBy(position))
    gaps = rows.withColumn("_gap", gap).filter("_gap is not null").groupBy(*keys, label, "_gap").agg(F.count(F.lit(1)).alias("_k"))
    out = gaps.groupBy(*keys, label).agg(F.max(F.struct(F.col("_k").alias("k"), (-F.col("_gap")).alias("g"))).alias("_m"), F.sum("_k").alias("n"))
    return out.filter(F.col("n") >= least).select(*keys, label, (-F.col("_m.g")).alias("stride"), (F.col("_m.k") / F.col("n")).alias("share"), "n")


def best_view(records: DataFrame, block: list[str], view: str, usable: Column, preferred: str) -> DataFrame:
    """Per block, the records of the view with more usable ones; ``preferred`` wins a tie."""
    score = records.groupBy(*block, view).agg(F.count_if(usable).alias("u"))
    best = score.groupBy(*block).agg(F.max_by(view, F.struct("u", (F.col(view) == preferred).cast("int").alias("p"))).alias(view))
    return records.join(best, [*block, view], "left_semi")


def inherit_best(groups: DataFrame, last: int = 4, order: list[str] | None = None) -> DataFrame:
    """Headerless groups take the best fitting of the last ``last`` headers of their width in the patent.

    groups: (patent_id, keys, n_cols, header array<string>, shapes array<string>). Fit counts columns where an id header stands over ids
    or an assay header over values; the nearest wins a tie, and a header that fits nowhere is not taken. Each earlier header is one look
    back over the header-bearing groups, so no list of them grows along a patent. ``order`` is that of the groups, by default their keys.
    """
    fit = lambda h: F.aggregate(F.zip_with(h, F.col("shapes"), lambda a, s: F.coalesce(fits(a, s), F.lit(False)).cast("int")), F.lit(0), lambda x, y: x + y)
    known = groups.withColumn("_h", F.when(F.size("header") > 0, F.col("header")))
    over = f"PARTITION BY patent_id, n_cols ORDER BY {', '.join(order or KEY)}"
    near = F.array(*[F.expr(f"lag(_h, {k}) IGNORE NULLS OVER ({over})") for k in range(1, last + 1)])
    known = known.withColumn("_near", F.filter(near, lambda h: h.isNotNull()))
    best = F.array_max(F.transform("_near", lambda h, i: F.struct(fit(h).alias("s"), (-i).alias("i"), h.alias("h"))))
    return known.withColumn("_b", best).withColumn("effective", F.when(F.size("header") > 0, F.col("header")).when(F.col("_b.s") > 0, F.col("_b.h"))).drop("_b", "_h", "_near")


def fits(header: Column, shape: Column) -> Column:
    """Whether a header stands over values of its kind: ids under an id header, numbers or grades under an assay header."""
    kind = fn.header_kind(header)
    return ((kind == "cid") & (shape == "cid")) | ((kind == "assay") & shape.isin("num", "bin"))
