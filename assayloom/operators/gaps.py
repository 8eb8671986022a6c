"""What is missing and what it would take: structures not held yet, drawings still wanted, unnamed columns, samples of gaps, library passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions import cells as fn
from assayloom.operators.extract import KEY

#: Adduct of a mass column that states none: a proton gained.
PROTON = fn.ADDUCT_SHIFTS["+H"]
#: Characters before a table in which its convention for drawings is looked for.
INTRO = 3000
# Wordings that call a drawn part's bond its point of attachment.
ATTACHMENT = r"(?i)point of attachment|attachment point|attached (?:via|through|at) the|(?:wavy|dashed|squiggly) line|\bdenotes? the (?:bond|point)"


def held_keys(structures: DataFrame) -> DataFrame:
    """(patent_id, inchikey): structure keys that a patent's delivery holds already, in upper case."""
    key = F.upper(F.trim("inchikey"))
    return structures.filter(F.coalesce(key, F.lit("")) != "").select("patent_id", key.alias("inchikey")).distinct()


def new_structures(blocks: DataFrame, held: DataFrame, resolved: DataFrame) -> DataFrame:
    """(patent_id, name, smiles, inchikey, stated_inchikey) of the grounded annotations that add a structure.

    blocks (patent_id, pos, name, smiles, inchi_key): one without a structure is not grounded; the first of a name counts; one whose stated key is
    held is dropped before names are resolved, one whose resolved key is held or was found before in the batch after. ``resolved`` (name,
    smiles, inchikey) is a resolver's answer; names without one are left out.
    """
    grounded = blocks.filter(F.coalesce("smiles", F.lit("")) != "")
    first = grounded.groupBy("patent_id", "name").agg(F.min_by(F.upper(F.trim("inchi_key")), "pos").alias("stated_inchikey"), F.min("pos").alias("pos"))
    h = held.select("patent_id", F.col("inchikey").alias("_k"))
    open_names = first.join(h, [first["patent_id"] == h["patent_id"], first["stated_inchikey"] == h["_k"]], "left_anti")
    r = resolved.filter("smiles is not null and inchikey is not null").groupBy("name").agg(F.min(F.struct("smiles", F.upper("inchikey").alias("inchikey"))).alias("_r"))
    found = open_names.join(r, "name").select("patent_id", "name", "pos", "_r.smiles", "_r.inchikey", "stated_inchikey")
    one = found.groupBy("patent_id", "inchikey").agg(F.min_by(F.struct("name", "smiles", "stated_inchikey"), "pos").alias("f")).select("patent_id", "inchikey", "f.*")
    return one.join(held, ["patent_id", "inchikey"], "left_anti").select("patent_id", "name", "smiles", "inchikey", "stated_inchikey")


def unlabelled_assays(columns: DataFrame) -> DataFrame:
    """Classified columns that are assays by their cells only: what they measure the document does not say. In groups with an id column."""
    ids = F.max((F.col("kind") == "cid").cast("int")).over(Window.partitionBy(*KEY))
    return columns.withColumn("_ids", ids).filter((F.col("_ids") == 1) & (F.col("kind") == "assay") & (F.col("label_source") == "shape")).select(*KEY, "col", "shape")


def samples(cells: DataFrame, gaps: DataFrame, rows: int = 6) -> DataFrame:
    """(keys, header, sample): header rows and the first ``rows`` filled body rows of the groups with a gap, cells parted by bars and rows by
    line breaks (a sampling operator: ``rows`` is its size)."""
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cell_ix", "text"))), lambda x: x["text"]), " | ")
    lines = cells.join(gaps.select(*KEY).distinct(), KEY, "left_semi").groupBy(*KEY, "section", "row_ix").agg(line.alias("line"), F.count_if(fn.blank_trim(F.col("text")) != "").alias("n"))
    rank = F.row_number().over(Window.partitionBy(*KEY, "section").orderBy("row_ix"))
    kept = lines.filter("n > 0").withColumn("_r", rank).filter((F.col("section") == "header") | (F.col("_r") <= rows))
    text = lambda s: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("section") == s, F.struct("row_ix", "line")))), lambda x: x["line"]), "\n")
    return kept.groupBy(*KEY).agg(text("header").alias("header"), text("body").alias("sample"))


def column_masses(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """(patent_id, cid, mz, shift): the first mass that a mass column states for a compound number.

    The adduct is that of the cell, else of the column's header, else a gained proton.
    """
    shift = lambda c: F.when(c.rlike(r"(?i)M ?- ?H"), F.lit(fn.ADDUCT_SHIFTS["-H"])).when(c.rlike(r"(?i)M ?\+ ?Na"), F.lit(fn.ADDUCT_SHIFTS["+Na"])).when(c.rlike(r"(?i)M ?\+ ?H"), F.lit(PROTON))
    ms = columns.filter("kind = 'ms'").select(*KEY, "col", F.coalesce(shift(F.col("header")), F.lit(PROTON)).alias("_head"))
    ids = columns.filter("kind = 'cid'").groupBy(*KEY).agg(F.min("col").alias("_id_col"))
    body = cells.filter("section = 'body'")
    named = body.join(ids, KEY).filter("col = _id_col").select("patent_id", *KEY, "row_ix", F.regexp_extract(fn.blank_trim(F.col("text")), r"^([0-9]+[A-Za-z]?)(?:\s|$)", 1).alias("cid")).filter("cid <> ''")
    mz = F.regexp_extract("text", r"^\s*(?:m/z\s*[=:]?\s*)?([1-9][0-9]{1,3}(?:\.[0-9]+)?)(?:$|[^0-9.])", 1).try_cast("double")
    stated = body.join(ms, [*KEY, "col"]).withColumns({"mz": mz, "shift": F.coalesce(shift(F.col("text")), "_head")}).filter("mz is not null")
    hit = stated.select(*KEY, "row_ix", "col", "mz", "shift").join(named, [*KEY, "row_ix"])
    return hit.groupBy("patent_id", "cid").agg(F.min_by(F.struct("mz", "shift"), F.struct(*KEY, "row_ix", "col")).alias("m")).select("patent_id", "cid", "m.*")


def attachment_tables(docs: DataFrame, reach: int = INTRO) -> DataFrame:
    """(patent_id, table_id) of tables before which the document says that a drawing is a part with its point of attachment.

    The ``reach`` characters between the table before and this one count, without markup.
    """
    parts = F.split("xml", r'(?=<tables id=")')
    pairs = docs.select("patent_id", F.arrays_zip(parts.alias("before"), F.slice(parts, 2, F.greatest(F.lit(0), F.size(parts) - 1)).alias("own")).alias("z")).select("patent_id", F.inline("z"))
    near = F.substring_index("before", "</tables>", -1)
    near = F.regexp_replace(F.substr(near, F.greatest(F.lit(1), F.length(near) - reach + 1)), r"<[^>]+>", " ")
    return pairs.filter(F.col("own").isNotNull() & near.rlike(ATTACHMENT)).select("patent_id", F.regexp_extract("own", r'^<tables id="([^"]+)"', 1).alias("table_id"))


def drawings_wanted(wanted: list[DataFrame], have: DataFrame, unnamed: DataFrame) -> DataFrame:
    """Drawings (patent_id, chemistry_id) of scaffolds and fragments together, without those that have a structure or no picture."""
    every = wanted[0].select("patent_id", "chemistry_id")
    for w in wanted[1:]:
        every = every.unionByName(w.select("patent_id", "chemistry_id"))
    keys = ["patent_id", "chemistry_id"]
    return every.dropna().distinct().join(have.select(*keys), keys, "left_anti").join(unnamed.select(*keys), keys, "left_anti")


def library_pass(gaps: DataFrame, patterns: list[tuple[str, str, str]], escalated: DataFrame, name: str = "name", signature: str = "signature") -> tuple[DataFrame, DataFrame]:
    """(proposed, left): what a library of (pattern_id, regular expression, replacement) makes of names with a gap, and the gaps it does not touch.

    Gaps of a signature that was written off are in neither. The library is a list the caller states; patterns are applied as expressions.
    """
    open_gaps = gaps.join(escalated.select(signature).distinct(), signature, "left_anti")
    made = F.array_compact(F.array(*[F.when(F.col(name).rlike(p), F.struct(F.lit(i).alias("pattern_id"), F.regexp_replace(name, p, r).alias("repaired"))) for i, p, r in patterns])) if patterns else F.array().cast("array<struct<pattern_id:string,repaired:string>>")
    tried = open_gaps.withColumn("_m", F.filter(made, lambda x: x["repaired"] != F.col(name)))
    return tried.select(*gaps.columns, F.explode("_m").alias("_r")).select(*gaps.columns, "_r.*"), tried.filter("size(_m) = 0").select(*gaps.columns)


def substituent_gaps(tables: DataFrame, masses: DataFrame, held_out: DataFrame) -> DataFrame:
    """(patent_id, table_id, layout, n_rows, n_masses, n_names): substituent tables that something outside them can check.

    tables (patent_id, table_id, cid, headings array, has_image, has_mass, scaffold_where); masses and held_out (patent_id, cid) are the
    referees: a printed mass, a name of the compound elsewhere. Tables without a referee are no gap that could be closed. layout is the
    first 16 hex digits of a hash over what a plan depends on.
    """
    ref = lambda df, c: df.select("patent_id", "cid").dropna().distinct().withColumn(c, F.lit(1))
    j = tables.join(ref(masses, "_m"), ["patent_id", "cid"], "left").join(ref(held_out, "_n"), ["patent_id", "cid"], "left")
    layout = F.substr(F.sha1(F.concat_ws("|", F.array_join(F.transform(F.array_sort("headings"), lambda h: F.upper(h)), ","), F.size("headings").cast("string"), F.col("has_image").cast("string"), F.col("has_mass").cast("string"), F.coalesce("scaffold_where", F.lit("")))), F.lit(1), F.lit(16))
    g = j.groupBy("patent_id", "table_id").agg(F.min(layout).alias("layout"), F.count_distinct("cid").alias("n_rows"), F.count("_m").alias("n_masses"), F.count("_n").alias("n_names"))
    return g.filter("n_masses + n_names > 0")


def shown(value: Column, unit: Column, lo: Column, hi: Column, grade: Column, qualifier: Column, n_runs: Column) -> Column:
    """A record's value as a reader sees it: value or bounds with unit, or grade, with qualifier and replicates."""
    number = lambda c: F.regexp_replace(c.cast("string"), r"\.0$", "")
    u = F.coalesce(F.concat(F.lit(" "), F.nullif(unit, F.lit(""))), F.lit(""))
    bounds = F.concat(F.coalesce(number(lo), F.lit("?")), F.lit(".."), F.coalesce(number(hi), F.lit("?")), u)
    body = F.when(value.isNotNull(), F.concat(number(value), u)).when(lo.isNotNull() | hi.isNotNull(), bounds).when(grade.isNotNull(), F.concat(F.lit("grade "), grade)).otherwise("(no value)")
    runs = F.when(n_runs.isNotNull(), F.concat(F.lit("  (n="), n_runs.cast("string"), F.lit(")"))).otherwise("")
    return F.concat(F.coalesce(qualifier, F.lit("")), body, runs)
