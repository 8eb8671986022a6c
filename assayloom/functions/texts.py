"""Column functions over lists in texts and over sentences, built in where the fold is expressible as a higher-order function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.functions import cells as fn


def split_top_level(c: Column) -> Column:
    """Parts between commas outside brackets, trimmed."""
    start = F.struct(F.lit(0).alias("d"), F.lit("").alias("cur"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, ch: Column) -> Column:
        depth = s["d"] + F.when(ch.isin("(", "[", "{"), 1).when(ch.isin(")", "]", "}"), -1).otherwise(0)
        cut = (ch == ",") & (s["d"] <= 0)
        return F.struct(F.greatest(F.lit(0), depth).alias("d"), F.when(cut, "").otherwise(F.concat(s["cur"], ch)).alias("cur"), F.when(cut, F.concat(s["parts"], F.array(s["cur"]))).otherwise(s["parts"]).alias("parts"))

    folded = F.aggregate(F.filter(F.split(c, ""), lambda x: x != ""), start, step)
    return F.transform(F.concat(folded["parts"], F.array(folded["cur"])), lambda x: F.trim(x))


def share_prefix(parts: Column) -> Column:
    """Leading words of the first part copied to later, shorter parts that hold a digit ("Compound A 1, 2" -> "Compound A 2")."""
    first = F.split(parts[0], " ")

    def widen(p: Column, i: Column) -> Column:
        own = F.split(p, " ")
        short = (i > 0) & (F.size(own) < F.size(first)) & p.rlike("[0-9]")
        return F.when(short, F.concat_ws(" ", F.slice(first, F.lit(1), F.greatest(F.lit(0), F.size(first) - F.size(own))), p)).otherwise(p)

    return F.transform(parts, widen)


def join_lines(parts: Column) -> Column:
    """Wrapped header lines: a line after one that ends in a hyphen and that begins in lower case is glued, others follow a blank."""

    def step(s: Column, x: Column) -> Column:
        glue = s.endswith("-") & x.rlike("^[a-z]")
        return F.when(s == "", x).when(glue, F.concat(F.substr(s, F.lit(1), F.length(s) - 1), x)).otherwise(F.concat(s, F.lit(" "), x))

    return F.aggregate(parts, F.lit(""), step)


def zip_lists(headers: Column, cell: Column) -> Column:
    """(header, value) pairs of a comma header over comma cells, where both have as many parts and at least two; else null."""
    h, v = split_top_level(headers), split_top_level(cell)
    return F.when((F.size(h) >= 2) & (F.size(h) == F.size(v)), F.zip_with(h, v, lambda a, b: F.struct(a.alias("header"), b.alias("value"))))


def percent_header(c: Column) -> Column:
    """The header speaks of a measured percentage."""
    return c.rlike(r"(?i)(^|[^0-9])%|\bpercent\b") & ~c.rlike(r"(?i)\bor %")


def caption_hint(c: Column) -> Column:
    """Shortest clause of a caption that speaks of an assay, as struct(name of at most 80 characters, unit)."""
    clauses = F.filter(F.transform(F.split(c, r"[.;:]"), lambda x: F.trim(x)), lambda x: x.rlike(r"(?i)(IC.?50|EC.?50|\bK[id]\b|inhibition|activity|potency|clearance)"))
    best = F.array_min(F.transform(clauses, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    return F.when(best.isNotNull(), F.struct(F.substr(best, F.lit(1), F.lit(80)).alias("name"), fn.unit_from(best).alias("unit")))


def sentences(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(key, F.explode(F.split(text, r"[.!?]\s+|\n+")).alias("sentence")).filter("sentence <> ''")


def stated_units(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, metric, unit): the unit that all sentences with the metric agree on; metrics with several units are left out."""
    s = sentences(docs, key, text).withColumn("metric", fn.metric_of(F.col("sentence"))).withColumn("unit", fn.unit_from(F.col("sentence")))
    g = s.filter("metric is not null and unit is not null").groupBy(key, "metric").agg(F.min("unit").alias("unit"), F.count_distinct("unit").alias("_k"))
    return g.filter("_k = 1").drop("_k")


def embedded_values(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, name, qualifier, value, unit) of every ``NAME = value unit`` or ``NAME of value unit`` in running text."""
    pat = r"(?:p?(?:IC|EC)50|K[id])\s*(?:value\s*)?(?:=|:|<|>|~|of|was)\s*[<>~]?\s*[0-9][0-9,]*(?:\.[0-9]+)?\s*(?:[numpµμ]M)\b"
    hits = docs.select(key, F.explode(F.regexp_extract_all(text, F.lit(f"({pat})"), F.lit(1))).alias("h"))
    part = r"^(\w+)\s*(?:value\s*)?(?:=|:|of|was)?\s*([<>~])?\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*([numpµμ]M)$"
    return hits.select(key, F.regexp_extract("h", part, 1).alias("name"), F.nullif(F.regexp_extract("h", part, 2), F.lit("")).alias("qualifier"), F.regexp_replace(F.regexp_extract("h", part, 3), ",", "").try_cast("double").alias("value"), F.regexp_extract("h", part, 4).alias("unit"))


def printed_masses(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, mz, adduct, shift) of each m/z stated in a text with its adduct."""
    pat = r"(m/z\s*[=:]?\s*[0-9]{2,4}(?:\.[0-9]+)?(?:\s*[\[(]?M\s*[+-]\s*(?:H|Na)[\])]?\+?)?)"
    hits = docs.select(key, F.explode(F.regexp_extract_all(text, F.lit(pat), F.lit(1))).alias("h"))
    adduct = F.nullif(F.regexp_replace(F.regexp_extract("h", r"M\s*([+-]\s*(?:H|Na))", 1), r"\s", ""), F.lit(""))
    shift = F.create_map(*[x for k, v in fn.ADDUCT_SHIFTS.items() for x in (F.lit(k), F.lit(v))])
    return hits.select(key, F.regexp_extract("h", r"([0-9]{2,4}(?:\.[0-9]+)?)", 1).cast("double").alias("mz"), adduct.alias("adduct"), F.try_element_at(shift, adduct).alias("shift"))
