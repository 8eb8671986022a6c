"""Queries of the text problems. Names start with the problem's number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.common import table
from assayloom.llm import canon, contamination, lookalike, packing, splitting

# -- 1: names to a canonical list ------------------------------------------------------------------------------------------------


def p1_mapped(spark: SparkSession, d: str) -> DataFrame:
    """Every typed name with the entry it means and its score."""
    return canon.map_names(table(spark, d, "assay_records", "record_id", "assay_name", "column_header"), table(spark, d, "assay_vocabulary"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_mapped(spark, d).select("record_id", "vocab_id")


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Names that mean no entry, with their rows."""
    return p1_mapped(spark, d).filter("vocab_id = 0").groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))


def p1_cases(spark: SparkSession, d: str) -> DataFrame:
    """The records that got a verdict: every one whose name is present and no form of the list."""
    return p1_mapped(spark, d).select("record_id")


# -- 3: look-alike characters ----------------------------------------------------------------------------------------------------


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    """Unit and raw cell texts with their consistent forms."""
    parts = [
        table(spark, d, t, key, col).filter(F.col(col).isNotNull()).select(F.lit(t).alias("src_table"), F.col(key).alias("row_id"), F.col(col).alias("raw"))
        for t, key, col in (("assay_records", "record_id", "unit"), ("structures", "structure_id", "raw_cell"))
    ]
    form = lookalike.consistent_form(lookalike.script_bigrams([p.select("raw") for p in parts]), lookalike.confusables(spark))
    return reduce(DataFrame.unionByName, parts).withColumn("form", form(F.col("raw")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_forms(spark, d).filter("form <> raw").select("src_table", "row_id")


def p3_left(spark: SparkSession, d: str) -> DataFrame:
    """Per table: texts, forms that still hold invisible, full-width or odd blank characters, and plain texts that were changed."""
    forms = p3_forms(spark, d)
    odd = F.col("form").rlike(r"[\p{Cf}\x{00A0}\x{2000}-\x{200F}\x{202F}\x{3000}\x{FF01}-\x{FF5E}\x{00B5}]")
    touched = ~F.col("raw").rlike(r"[^\t\n\r\x20-\x7e]") & (F.col("raw") != F.col("form"))
    return forms.groupBy("src_table").agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(odd).alias("n_odd"), F.count_if(touched).alias("n_touched"))


# -- 7: packing ------------------------------------------------------------------------------------------------------------------


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """Every document in containers of 4,096 tokens."""
    return packing.pack_documents(table(spark, d, "documents", "doc_id", "text"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.container_report(p7_packed(spark, d))


def p7_checked(spark: SparkSession, d: str) -> DataFrame:
    """Documents placed, those whose pieces do not follow one another without a gap, and containers that are too full."""
    packed = p7_packed(spark, d)
    by_doc = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max(F.col("token_start") + F.col("n_tokens")).alias("upto"), F.count(F.lit(1)).alias("k"), F.max("piece_ix").alias("last"))
    bad = F.count_if((F.col("n") != F.col("upto")) | (F.col("k") != F.col("last") + 1))
    docs = by_doc.agg(F.count(F.lit(1)).alias("n_documents"), bad.alias("n_broken"))
    full = packing.container_report(packed).agg(F.count_if(F.col("unused") < 0).alias("n_too_full"))
    return docs.unionByName(full, allowMissingColumns=True).agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("n_documents", "n_broken", "n_too_full")])


# -- 8: evaluation passages ------------------------------------------------------------------------------------------------------


def p8_spans(spark: SparkSession, d: str) -> DataFrame:
    """Documents and items with their longest shared span in words."""
    return contamination.shared_spans(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "heldout_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_spans(spark, d).select("doc_id", "item_id")


def p8_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items with their documents."""
    return p8_spans(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("n_words").alias("longest_span"))


# -- 9: splitting ----------------------------------------------------------------------------------------------------------------


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of at most 512 tokens, overlapping by up to 64, of every longer document."""
    return splitting.split_documents(table(spark, d, "documents", "doc_id", "text"))


def p9_cover(spark: SparkSession, d: str) -> DataFrame:
    """Characters of every document that its pieces cover, overlaps counted once; a document that is no longer than the limit is its own piece."""
    docs = table(spark, d, "documents", "doc_id", "text").filter("text is not null")
    new = (F.col("char_end") - F.col("char_start") - F.col("overlap_chars")).cast("long")
    pieces = splitting.split_documents(docs).groupBy("doc_id").agg(F.sum(new).alias("n_split"))
    whole = docs.select("doc_id", F.length("text").cast("long").alias("n_whole"))
    return whole.join(pieces, "doc_id", "left").select("doc_id", F.coalesce("n_split", "n_whole").alias("n_covered"))


def queries() -> dict:
    own = [p1_found, p1_mapped, p1_cases, p1_unmatched, p3_found, p3_forms, p3_left, p7_packed, p7_report, p7_checked, p8_found, p8_spans, p8_leaked_items, p9_pieces, p9_cover]
    return {f.__name__: f for f in own}


_GRAM = " || ' ' || ".join(["w", *(f"lead(w, {i}) OVER o" for i in range(1, 12))])
_WORDS = "SELECT {id}, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w, generate_subscripts(regexp_extract_all(lower(text), '[a-z0-9]+'), 1) AS p FROM {t}"
_P8 = f"""
WITH dg AS (SELECT doc_id, p, {_GRAM} AS g FROM ({_WORDS.format(id="doc_id", t="documents")}) WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
ig AS (SELECT item_id, p, {_GRAM} AS g FROM ({_WORDS.format(id="item_id", t="heldout_items")}) WINDOW o AS (PARTITION BY item_id ORDER BY p)),
hit AS (SELECT DISTINCT doc_id, item_id, dg.p - ig.p AS diagonal, dg.p AS p FROM dg JOIN ig USING (g)),
runs AS (SELECT doc_id, item_id, diagonal, p - row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY p) AS run FROM hit),
spans AS (SELECT doc_id, item_id, count(*) + 11 AS n FROM runs GROUP BY doc_id, item_id, diagonal, run)
"""
_NAME = "CASE WHEN assay_name IS NULL OR assay_name = '' OR lower(assay_name) LIKE '%unnamed%' THEN column_header ELSE assay_name END"


def oracle_sql() -> dict[str, str]:
    return {
        "p1_cases": f"WITH f AS (SELECT canonical AS n FROM assay_vocabulary UNION SELECT unnest(surface_forms) FROM assay_vocabulary) SELECT record_id FROM assay_records WHERE {_NAME} <> '' AND {_NAME} NOT IN (SELECT n FROM f WHERE n IS NOT NULL)",
        "p3_left": "SELECT 'assay_records' AS src_table, count(unit) AS n_texts, 0 AS n_odd, 0 AS n_touched FROM assay_records UNION ALL SELECT 'structures', count(raw_cell), 0, 0 FROM structures",
        "p7_checked": "SELECT count(*) AS n_documents, 0 AS n_broken, 0 AS n_too_full FROM documents WHERE text IS NOT NULL",
        "p8_found": _P8 + "SELECT DISTINCT doc_id, item_id FROM spans",
        "p8_spans": _P8 + "SELECT doc_id, item_id, CAST(max(n) AS INTEGER) AS n_words FROM spans GROUP BY ALL",
        "p8_leaked_items": _P8 + "SELECT item_id, count(DISTINCT doc_id) AS n_documents, CAST(max(n) AS INTEGER) AS longest_span FROM spans GROUP BY ALL",
        "p9_cover": "SELECT doc_id, length(text) AS n_covered FROM documents WHERE text IS NOT NULL",
    }
