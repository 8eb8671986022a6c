"""Queries of the layout, text, name and drawing operators, with their DuckDB SQL. They add to those of ``reference_queries``."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.common import shared_folder, table
from assayloom.functions import cells as fn
from assayloom.functions import texts
from assayloom.operators import audit, deliver, drawings, extract, identity, layout, names, rules
from assayloom.plans import name_cases
from assayloom.plans.reference_queries import _CELLS, _COLUMNS, _HEADS, _SHAPE, _SHAPES, _bt, _flat, _k, _keyed, _metric, _ncid, _unit, query
from assayloom.streaming import ingest

_TEXT = _bt("text")
_PROFILE = f"""
prof AS (SELECT patent_id, table_uid, tgroup_ix, section, row_ix, sum(colspan) AS width, count(*) FILTER ({_TEXT} <> '') AS n_filled, count(*) FILTER ({_SHAPE.format(t=_TEXT)} IN ('num', 'bin')) AS n_values, count(*) FILTER (regexp_matches({_TEXT}, '[A-Za-z]')) AS n_words,
  max(CASE WHEN contains({_TEXT}, ' ') THEN length({_TEXT}) ELSE 0 END) AS prose, string_agg({_TEXT}, '|' ORDER BY cell_ix) AS text FROM cells GROUP BY ALL)"""
_BASE = f"WITH {_CELLS}, {_PROFILE} "
_FULL = f"WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS} "


@query(_BASE + "SELECT section, CAST(width AS BIGINT) AS width, count(*) AS n, count(*) FILTER (n_filled = 0) AS n_spacers, count(*) FILTER (n_filled > 0 AND n_filled <= 2 AND prose > 55) AS n_legends, count(*) FILTER (n_values = 0 AND n_words > 0) AS n_header_like FROM prof GROUP BY ALL")
def q_row_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows by section and width: spacers, legend rows and header-like rows."""
    p = layout.row_profile(_flat(spark, d))
    return p.groupBy("section", F.col("width").cast("long").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.count_if(layout.is_spacer()).alias("n_spacers"), F.count_if(layout.is_legend_row()).alias("n_legends"), F.count_if(layout.is_header_like()).alias("n_header_like"))


@query(
    _BASE
    + """, h AS (SELECT *, max(CASE WHEN section = 'header' THEN 1 ELSE 0 END) OVER (PARTITION BY table_uid, tgroup_ix) AS hh FROM prof), s AS (SELECT *, max(CASE WHEN n_values > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY table_uid, tgroup_ix ORDER BY row_ix) AS seen FROM h WHERE hh = 0 AND section = 'body')
SELECT table_uid, tgroup_ix, CAST(row_ix AS INTEGER) AS row_ix FROM s WHERE seen = 0 AND n_values = 0 AND n_words > 0 AND row_ix < 8"""
)
def q_leading_headers(spark: SparkSession, d: str) -> DataFrame:
    """Header rows that stand in the body of groups without a head."""
    return layout.leading_headers(layout.row_profile(_flat(spark, d)))


@query(
    _BASE
    + """, b AS (SELECT * FROM prof WHERE section = 'body' AND n_filled > 0 AND (table_uid, text) NOT IN (SELECT table_uid, text FROM prof WHERE section = 'header'))
SELECT table_uid, CAST(row_number() OVER (PARTITION BY table_uid ORDER BY tgroup_ix, row_ix) AS INTEGER) AS seq, tgroup_ix, CAST(row_ix AS INTEGER) AS row_ix, text FROM b"""
)
def q_assemble_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Groups of a table stitched together, without spacers and repeated headers."""
    return layout.assemble_blocks(layout.row_profile(_flat(spark, d)))


@query(
    _FULL
    + """, g AS (SELECT table_uid, tgroup_ix, list(kind || ':' || lower(coalesce(header, '')) ORDER BY col) AS k FROM columns_ GROUP BY ALL HAVING count(*) > 1),
p AS (SELECT table_uid, tgroup_ix, len(k) AS n, list_filter(range(1, len(k)), lambda g: len(k) % g = 0 AND starts_with(k[1], 'cid:') AND len(list_filter(range(1, len(k) + 1), lambda i: k[i] <> k[(i - 1) % g + 1])) = 0)[1] AS period FROM g)
SELECT table_uid, tgroup_ix, CAST(n AS INTEGER) AS n, CAST(period AS INTEGER) AS period FROM p WHERE period IS NOT NULL"""
)
def q_column_periods(spark: SparkSession, d: str) -> DataFrame:
    """Groups whose columns repeat as (id, value...) blocks."""
    return layout.column_period(extract.classify_columns(_flat(spark, d)))


@query(
    _FULL
    + """, b AS (SELECT table_uid, tgroup_ix, col, count(*) AS n, count(*) FILTER (length(text) - length(translate(text, '-[(,', '')) >= 3 AND (length(text) - length(replace(text, ' ', ''))) * 10 < length(text)) AS chem FROM cells WHERE section = 'body' AND text <> '' GROUP BY ALL),
s AS (SELECT k.table_uid, k.tgroup_ix, k.col, CASE WHEN contains(lower(coalesce(header, '')), 'name') THEN 'header' WHEN kind = 'unknown' AND chem >= greatest(3.0, 0.5 * n) THEN 'shape' END AS signal FROM columns_ k LEFT JOIN b USING (table_uid, tgroup_ix, col))
SELECT table_uid, tgroup_ix, CAST(col AS INTEGER) AS col, signal FROM s WHERE signal IS NOT NULL"""
)
def q_name_columns(spark: SparkSession, d: str) -> DataFrame:
    cells = _flat(spark, d)
    return layout.name_columns(cells, extract.classify_columns(cells))


@query(
    """WITH s AS (SELECT user_id, event_id, event_type, ts, sum(CASE WHEN event_type IN ('view', 'signup') THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM events)
SELECT user_id, CAST(session AS BIGINT) AS session, max(CASE WHEN event_type IN ('view', 'signup') THEN event_type END) AS head, string_agg(event_type, ' ' ORDER BY ts, event_id) AS line FROM s GROUP BY ALL"""
)
def q_wrapped_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a head continue the record before."""
    e = table(spark, d, "events", "user_id", "event_id", "event_type", "ts").withColumn("at", F.struct("ts", "event_id"))
    e = e.withColumn("head", F.when(F.col("event_type").isin("view", "signup"), F.col("event_type"))).withColumnRenamed("event_type", "line")
    return layout.wrapped_rows(e, ["user_id"], "at", "head", "line").select("user_id", "session", "head", "line")


@query(
    f"""WITH t AS (SELECT record_id, column_header AS h FROM assay_records WHERE column_header IS NOT NULL)
SELECT record_id, regexp_matches(h, '(?i)(^|[^0-9])%|\\bpercent\\b') AND NOT regexp_matches(h, '(?i)\\bor %') AS is_percent, CASE WHEN {_metric("h")} IS NOT NULL THEN {_metric("h")} END AS metric FROM t"""
)
def q_percent_headers(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "assay_records", "record_id", "column_header").filter("column_header is not null")
    return r.select("record_id", texts.percent_header(F.col("column_header")).alias("is_percent"), fn.metric_of(F.col("column_header")).alias("metric"))


@query(
    f"""WITH c AS (SELECT DISTINCT caption FROM table_objects WHERE caption IS NOT NULL), k AS (SELECT caption, list_filter(list_transform(regexp_split_to_array(caption, '[.;:]'), lambda x: trim(x)), lambda x: regexp_matches(x, '(?i)(IC.?50|EC.?50|\\bK[id]\\b|inhibition|activity|potency|clearance)')) AS cl FROM c),
b AS (SELECT caption, list_sort(list_transform(cl, lambda x: (length(x), x)))[1] AS p FROM k) SELECT caption, substr(p[2], 1, 80) AS name, {_unit("p[2]")} AS unit FROM b"""
)
def q_caption_hints(spark: SparkSession, d: str) -> DataFrame:
    """Assay name and unit that a caption hints at."""
    c = table(spark, d, "table_objects", "caption").filter("caption is not null").distinct().withColumn("h", texts.caption_hint(F.col("caption")))
    return c.select("caption", "h.name", "h.unit")


@query()
def q_split_top_level(spark: SparkSession, d: str) -> DataFrame:
    """Parts of names between commas outside brackets (tested against a fixture)."""
    s = table(spark, d, "structures", "structure_id", "name").filter("name is not null")
    return s.select("structure_id", F.posexplode(texts.split_top_level(F.col("name"))).alias("part_ix", "part"))


_SENTENCES = r"s AS (SELECT patent_id, unnest(regexp_split_to_array(text, '[.!?]\s+|\n+')) AS sentence FROM documents WHERE text IS NOT NULL)"


@query(f"WITH {_SENTENCES}, m AS (SELECT patent_id, {_metric('sentence')} AS metric, {_unit('sentence')} AS unit FROM s WHERE sentence <> '') SELECT patent_id, metric, min(unit) AS unit FROM m WHERE metric IS NOT NULL AND unit IS NOT NULL GROUP BY ALL HAVING count(DISTINCT unit) = 1")
def q_stated_units(spark: SparkSession, d: str) -> DataFrame:
    """Units that all sentences of a patent with a metric agree on."""
    return texts.stated_units(table(spark, d, "documents", "patent_id", "text").filter("text is not null"), "patent_id", "text")


_PART = r"^(\w+)\s*(?:value\s*)?(?:=|:|of|was)?\s*([<>~])?\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*([numpµμ]M)$"


@query(
    rf"""WITH h AS (SELECT doc_id, unnest(regexp_extract_all(text, '((?:p?(?:IC|EC)50|K[id])\s*(?:value\s*)?(?:=|:|<|>|~|of|was)\s*[<>~]?\s*[0-9][0-9,]*(?:\.[0-9]+)?\s*(?:[numpµμ]M)\b)', 1)) AS h FROM documents)
SELECT doc_id, regexp_extract(h, '{_PART}', 1) AS name, nullif(regexp_extract(h, '{_PART}', 2), '') AS qualifier, TRY_CAST(replace(regexp_extract(h, '{_PART}', 3), ',', '') AS DOUBLE) AS value, regexp_extract(h, '{_PART}', 4) AS unit FROM h"""
)
def q_embedded_values(spark: SparkSession, d: str) -> DataFrame:
    """Measurements in running text."""
    return texts.embedded_values(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


@query(
    r"""WITH h AS (SELECT doc_id, unnest(regexp_extract_all(text, '(m/z\s*[=:]?\s*[0-9]{2,4}(?:\.[0-9]+)?(?:\s*[\[(]?M\s*[+-]\s*(?:H|Na)[\])]?\+?)?)', 1)) AS h FROM documents),
a AS (SELECT doc_id, TRY_CAST(regexp_extract(h, '([0-9]{2,4}(?:\.[0-9]+)?)', 1) AS DOUBLE) AS mz, nullif(regexp_replace(regexp_extract(h, 'M\s*([+-]\s*(?:H|Na))', 1), '\s', '', 'g'), '') AS adduct FROM h)
SELECT doc_id, mz, adduct, CASE adduct WHEN '+H' THEN 1.00728 WHEN '-H' THEN -1.00728 WHEN '+Na' THEN 22.98922 END AS shift FROM a"""
)
def q_printed_masses(spark: SparkSession, d: str) -> DataFrame:
    """Masses that texts state, with the shift of their adduct."""
    return texts.printed_masses(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


@query(
    f"""WITH {_CELLS}, i AS (SELECT patent_id, table_uid, tgroup_ix, row_ix, {_ncid("text")} AS cid FROM cells WHERE section = 'body' AND cell_ix = 0), r AS (SELECT table_uid, tgroup_ix, row_ix, arg_min(chemistry_id, cell_ix) AS chemistry_id FROM cells WHERE section = 'body' AND chemistry_id IS NOT NULL GROUP BY ALL)
SELECT patent_id, cid, arg_min(chemistry_id, (table_uid, tgroup_ix, row_ix)) AS chemistry_id FROM i JOIN r USING (table_uid, tgroup_ix, row_ix) WHERE cid <> '' GROUP BY ALL"""
)
def q_drawing_refs(spark: SparkSession, d: str) -> DataFrame:
    """The drawing of each compound number."""
    return drawings.drawing_refs(_flat(spark, d))


@query(f"WITH {_CELLS} SELECT DISTINCT patent_id, table_uid FROM cells WHERE chemistry_id IS NOT NULL")
def q_drawn_tables(spark: SparkSession, d: str) -> DataFrame:
    return drawings.drawn_tables(_flat(spark, d))


@query(
    """WITH c AS (SELECT structure_id, raw_cell AS a, regexp_replace(regexp_replace(raw_cell, '\\s*([-\\[\\]{}(),])\\s+', '\\1', 'g'), '\\s+([-\\]}),])', '\\1', 'g') AS b, regexp_replace(raw_cell, '\\s+', '', 'g') AS c FROM structures WHERE raw_cell IS NOT NULL),
l AS (SELECT structure_id, list_filter([a, CASE WHEN b <> a THEN b END, CASE WHEN c <> a AND c <> b THEN c END], lambda x: x IS NOT NULL) AS l FROM c) SELECT structure_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS rank, unnest(l) AS candidate FROM l"""
)
def q_dewrap_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Readings of wrapped cells in order."""
    s = table(spark, d, "structures", "structure_id", "raw_cell").filter("raw_cell is not null")
    return s.select("structure_id", F.posexplode(fn.dewrap_candidates(F.col("raw_cell"))).alias("rank", "candidate"))


@query()
def q_name_variants(spark: SparkSession, d: str) -> DataFrame:
    """Span variants of every raw cell (tested against a fixture)."""
    s = table(spark, d, "structures", "structure_id", "raw_cell").filter("raw_cell is not null")
    return names.candidates(s, "raw_cell").select("structure_id", "rank", "candidate")


@query()
def q_name_repairs(spark: SparkSession, d: str) -> DataFrame:
    """Repairs of raw cells that are trusted or corroborated in the patent and keep the name (tested against a fixture)."""
    s = table(spark, d, "structures", "structure_id", "patent_id", "raw_cell").filter("raw_cell is not null and patent_id is not null")
    r = names.repair_candidates(s, "raw_cell").filter(names.accepted(F.col("raw_cell"), F.col("repaired")))
    return names.corroborated(r, s, "patent_id", "structure_id", "raw_cell").select("structure_id", "pattern_id", "trusted", "repaired")


@query(name_cases.expected_sql())
def q_repair_cases(spark: SparkSession, d: str) -> DataFrame:
    """Repairs of damaged names of every kind, held against names mended by hand; sound names are in it and give nothing."""
    cases = [(i, n, p, m) for i, (n, p, m) in enumerate(name_cases.REPAIRED)] + [(100 + i, n, p, None) for i, (n, p) in enumerate(name_cases.UNTOUCHED)]
    df = spark.createDataFrame(cases, "case_no int, name string, wanted string, mended string")
    r = names.repair_candidates(df, "name").filter("pattern_id = wanted and (mended is null or repaired = mended)")
    return r.select("case_no", "pattern_id", "repaired")


# brackets of one kind that hold no bracket are taken away until none is left; what stays has no partner
_INNER = r"\([^()\[\]{}]*\)|\[[^()\[\]{}]*\]|\{[^()\[\]{}]*\}"
_BARE = reduce(lambda x, _: f"regexp_replace({x}, '{_INNER}', '', 'g')", range(16), "name")
_TOUCHED = [
    *[(i, f"regexp_matches({c}, '{p}')") for i, c, p in (("footnote_digit_tail", "rtrim(name)", names.FOOTNOTE), ("dropped_open_paren", "name", names.LOST_PAREN.replace("'", "''")), ("digit_for_paren", "name", names.DIGIT_PAREN), ("ch_as_ey", "name", names.EY))],
    ("stray_closing_bracket", "regexp_matches(b, '[)\\]}]')"),
    ("stray_opening_bracket", "regexp_matches(b, '[(\\[{]')"),
    ("dropped_close_bracket", "regexp_matches(b, '[(\\[{]')"),
]


@query(f"WITH n AS (SELECT name, {_BARE} AS b FROM compounds WHERE name IS NOT NULL) " + " UNION ALL ".join(f"SELECT '{i}' AS pattern_id, round(avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END), 9) AS share FROM n" for i, c in _TOUCHED))
def q_pattern_collateral(spark: SparkSession, d: str) -> DataFrame:
    """Share of clean names that each repair pattern would touch."""
    out = names.collateral(table(spark, d, "compounds", "name").filter("name is not null"), "name")
    return out.select("pattern_id", F.round("share", 9).alias("share"))


@query(
    f"""WITH a AS (SELECT DISTINCT patent_id, cid FROM {_k("structures")} WHERE name IS NOT NULL), r AS (SELECT DISTINCT patent_id, cid FROM {_k("structures")} WHERE inchikey IS NOT NULL)
SELECT patent_id, count(*) AS n_gaps FROM (SELECT * FROM a EXCEPT SELECT * FROM r) GROUP BY patent_id"""
)
def q_name_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Compounds with an asserted name that nothing resolved, per patent."""
    s = _keyed(spark, d, "structures")
    gaps = s.filter("name is not null").select("patent_id", "cid").distinct().join(s.filter("inchikey is not null").select("patent_id", "cid").distinct(), ["patent_id", "cid"], "left_anti")
    return gaps.groupBy("patent_id").agg(F.count(F.lit(1)).alias("n_gaps"))


@query(
    """WITH s AS (SELECT patent_id, structure_id, mass_check, row_number() OVER (PARTITION BY patent_id ORDER BY md5('7:' || structure_id), structure_id) AS rn FROM structures WHERE mass_check IS NOT NULL),
p AS (SELECT patent_id, count(*) FILTER (mass_check = 'agree') / count(*) AS rate FROM s WHERE rn <= 8 GROUP BY patent_id)
SELECT count(*) AS n_patents, round(min(rate), 6) AS lowest, round(median(rate), 6) AS middle, round(max(rate), 6) AS highest FROM p"""
)
def q_sample_scores(spark: SparkSession, d: str) -> DataFrame:
    """Agreement rates per patent over a stratified sample: lowest, median, highest."""
    s = identity.stratified_sample(table(spark, d, "structures", "patent_id", "structure_id", "mass_check").filter("mass_check is not null"), ["patent_id"], "structure_id", 8, 7)
    p = s.groupBy("patent_id").agg(F.avg((F.col("mass_check") == "agree").cast("double")).alias("rate"))
    return p.agg(F.count(F.lit(1)).alias("n_patents"), F.round(F.min("rate"), 6).alias("lowest"), F.round(F.median("rate"), 6).alias("middle"), F.round(F.max("rate"), 6).alias("highest"))


@query(
    f"""WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS}, st AS (SELECT table_uid, list_sort(list(DISTINCT unit) FILTER (unit IS NOT NULL)) AS stated FROM columns_ WHERE kind = 'assay' GROUP BY ALL)
SELECT table_uid, tgroup_ix, CAST(col AS INTEGER) AS col, array_to_string(stated, ',') AS stated FROM columns_ JOIN st USING (table_uid) WHERE kind = 'assay' AND unit IS NULL AND len(stated) > 0"""
)
def q_guessed_units(spark: SparkSession, d: str) -> DataFrame:
    """Assay columns without a unit in tables where a sibling's header states one."""
    c = extract.classify_columns(_flat(spark, d)).filter("kind = 'assay'")
    stated = c.groupBy("table_uid").agg(F.array_join(F.array_sort(F.collect_set("unit")), ",").alias("stated")).filter("stated <> ''")
    return c.filter("unit is null").join(stated, "table_uid").select(*extract.KEY, "col", "stated")


@query(
    f"""WITH y AS (SELECT patent_id AS k, 'unusable' AS gap, count(*) AS rows, 0 AS extracted, 0 AS p FROM {_k("assay_records")} WHERE value_numeric IS NULL AND letter_grade IS NULL GROUP BY ALL),
u AS (SELECT patent_id AS k, 'unit_missing' AS gap, count(*) AS rows, count(unit) AS extracted, 1 AS p FROM {_k("assay_records")} GROUP BY ALL HAVING count(unit) < count(*)),
a AS (SELECT * FROM y UNION ALL SELECT * FROM u), b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, gap) AS rn FROM a)
SELECT k AS patent_id, gap, rows AS "rows", extracted, CAST(greatest(0, rows - extracted) AS BIGINT) AS severity FROM b WHERE rn = 1"""
)
def q_gap_precedence(spark: SparkSession, d: str) -> DataFrame:
    """One gap per patent, the first detector first, with its severity."""
    r = _keyed(spark, d, "assay_records")
    unusable = r.filter("value_numeric is null and letter_grade is null").groupBy("patent_id").agg(F.count(F.lit(1)).alias("rows")).select("patent_id", F.lit("unusable").alias("gap"), "rows", F.lit(0).cast("long").alias("extracted"))
    unit = r.groupBy("patent_id").agg(F.count(F.lit(1)).alias("rows"), F.count("unit").alias("extracted")).filter("extracted < rows").withColumn("gap", F.lit("unit_missing"))
    return audit.gaps_by_precedence([unusable, unit], "patent_id")


@query(
    f"""SELECT 'shipped' AS view, patent_id, cid, count(*) AS n FROM {_k("reader_dump")} GROUP BY ALL UNION ALL SELECT 'extracted', patent_id, cid, count(*) FROM {_k("assay_records")} GROUP BY ALL UNION ALL SELECT 'structure', patent_id, cid, count(*) FROM {_k("structures")} GROUP BY ALL"""
)
def q_backtrace(spark: SparkSession, d: str) -> DataFrame:
    """What each view holds of a compound."""
    views = [("shipped", "reader_dump"), ("extracted", "assay_records"), ("structure", "structures")]
    parts = [_keyed(spark, d, t).groupBy("patent_id", "cid").agg(F.count(F.lit(1)).alias("n")).withColumn("view", F.lit(v)) for v, t in views]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    f"""WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS}, sg AS (SELECT coalesce(s.table_uid, h.table_uid) AS table_uid, coalesce(s.tgroup_ix, h.tgroup_ix) AS tgroup_ix, concat_ws('|', CAST(count(*) AS VARCHAR), string_agg(coalesce(s.shape, 'empty') || ':' || lower(coalesce(h.header, '')), '|' ORDER BY coalesce(s.col, h.col))) AS signature FROM shapes s FULL JOIN heads h ON s.table_uid = h.table_uid AND s.tgroup_ix = h.tgroup_ix AND s.col = h.col GROUP BY 1, 2),
f AS (SELECT table_uid, tgroup_ix, substr(sha256(signature), 1, 16) AS fp FROM sg), i AS (SELECT c.table_uid, c.tgroup_ix, c.row_ix, text AS cid FROM cells c WHERE section = 'body' AND col = 0), v AS (SELECT c.table_uid, c.tgroup_ix, c.row_ix, text FROM cells c WHERE section = 'body' AND col = 1)
SELECT table_uid, tgroup_ix, CAST(row_ix AS INTEGER) AS row_ix, cid, 'learned ' || fp AS assay_name, text, 'nM' AS unit FROM v JOIN i USING (table_uid, tgroup_ix, row_ix) JOIN f USING (table_uid, tgroup_ix)"""
)
def q_apply_rules(spark: SparkSession, d: str) -> DataFrame:
    """Column-map rules of every layout, applied by fingerprint."""
    cells = _flat(spark, d)
    sig = extract.layout_signature(cells)
    one = F.struct(F.lit(1).alias("index"), F.concat(F.lit("learned "), F.col("fingerprint")).alias("name"), F.lit("nM").alias("unit"))
    lib = sig.select("fingerprint", F.lit(0).alias("cid_index"), F.array(one).alias("columns")).distinct()
    return rules.apply_column_maps(cells.join(sig.select(*extract.KEY, "fingerprint"), extract.KEY), lib, extract.KEY)


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def q_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Incremental ingest of the events as a file stream into a partitioned table: equal to the batch result."""
    at = f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = ingest.file_stream(spark, f"{d}/event[s].parquet", schema)  # a pattern: the table may be one file or a folder
    ingest.ingest_once(stream, lambda b: b.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), f"{at}/sink", f"{at}/state", "event_type").awaitTermination()
    done = spark.read.parquet(f"{at}/sink")
    return done.groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))


@query()
def q_before_within(spark: SparkSession, d: str) -> DataFrame:
    """At most two views in the ten days before a user's next error, nearest first (tested against brute force)."""
    e = table(spark, d, "events", "user_id", "event_id", "event_type", "ts").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    errors = e.filter("event_type = 'error'").select("user_id", F.col("at").alias("start")).distinct()
    views = e.filter("event_type = 'view'").select("user_id", F.col("at").alias("position"), F.col("event_id").alias("ref"))
    return drawings.before_within(errors, views, "user_id", "start", "position", 10 * 86_400_000_000)


@query(
    f"""WITH v AS (SELECT patent_id, cid, count(*) FILTER (inchikey IS NOT NULL) AS validate, count(*) FILTER (inchikey IS NULL) AS recover FROM {_k("structures")} WHERE source = 'image' GROUP BY ALL)
SELECT patent_id, CAST(sum(validate) AS BIGINT) AS validate, CAST(sum(recover) AS BIGINT) AS recover FROM v GROUP BY patent_id ORDER BY validate DESC, patent_id LIMIT 15"""
)
def q_top_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The fifteen patents with most drawings to validate (a top-k report)."""
    s = _keyed(spark, d, "structures").filter("source = 'image'")
    g = s.groupBy("patent_id").agg(F.count_if(F.col("inchikey").isNotNull()).alias("validate"), F.count_if(F.col("inchikey").isNull()).alias("recover"))
    return g.orderBy(F.desc("validate"), "patent_id").limit(15)



_COLS = ["cid", "assay_name", "value_numeric", "unit", "n_runs", "letter_grade", "range_lo", "table_id", "reported_mz"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 9) AS share FROM reader_dump" for c in _COLS))
def q_null_rates(spark: SparkSession, d: str) -> DataFrame:
    """Shares of nulls in the dump."""
    return deliver.null_rates(table(spark, d, "reader_dump", *_COLS)).select("column", F.round("share", 9).alias("share"))


@query(
    f"""WITH r AS (SELECT patent_id, cid, assay_name, value_numeric, unit FROM {_k("assay_records")} WHERE assay_name IS NOT NULL AND value_numeric IS NOT NULL)
SELECT patent_id, cid, array_to_string(list(assay_name ORDER BY assay_name, value_numeric, unit NULLS FIRST), '|') AS assays, count(*) AS n FROM r GROUP BY ALL"""
)
def q_aligned_lists(spark: SparkSession, d: str) -> DataFrame:
    """Measurements of a compound as aligned lists."""
    r = _keyed(spark, d, "assay_records").filter("assay_name is not null and value_numeric is not null")
    return deliver.aligned_lists(r, ["patent_id", "cid"]).select("patent_id", "cid", F.array_join("assays", "|").alias("assays"), F.size("values").cast("long").alias("n"))


@query(
    f"""WITH t AS (SELECT patent_id, doc_id, unnest(regexp_extract_all(text, '\\S+')) AS tok, generate_subscripts(regexp_extract_all(text, '\\S+'), 1) - 1 AS n FROM documents WHERE patent_id IS NOT NULL),
w AS (SELECT *, lower(regexp_replace(coalesce(lag(tok) OVER (PARTITION BY patent_id, doc_id ORDER BY n), ''), '[^A-Za-z]', '', 'g')) AS before, regexp_replace(tok, '^[(\\[{{]+|[)\\]}},.;:]+$', '', 'g') AS id FROM t),
i AS (SELECT DISTINCT patent_id, cid AS id FROM {_k("compounds")})
SELECT w.patent_id, doc_id, id, CAST(n AS INTEGER) AS position, CASE WHEN before IN ('example', 'compound', 'cmpd', 'cpd', 'ex', 'no', 'entry') THEN 'labelled' WHEN regexp_matches(tok, '^\\(.*\\)') THEN 'bracketed' WHEN n = 0 AND ends_with(tok, ':') THEN 'line_start' ELSE 'bare' END AS shape FROM w JOIN i USING (patent_id, id)"""
)
def q_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """Where the compound numbers of a patent occur in its texts."""
    docs = table(spark, d, "documents", "patent_id", "doc_id", "text").filter("patent_id is not null")
    return identity.occurrences(docs, _keyed(spark, d, "compounds").select("patent_id", F.col("cid").alias("id")), "patent_id", "doc_id", "text")


@query(f"WITH {_CELLS}, {_PROFILE} SELECT table_uid, tgroup_ix, count(*) FILTER (section = 'header') AS n_header, count(*) FILTER (section = 'body') AS n_body FROM prof GROUP BY ALL HAVING count(*) FILTER (section = 'header') >= 2 AND count(*) FILTER (section = 'header') * 4 > count(*) FILTER (section = 'body')")
def q_header_heavy(spark: SparkSession, d: str) -> DataFrame:
    """Groups with many header rows for their body."""
    g = layout.row_profile(_flat(spark, d)).groupBy(*extract.KEY).agg(F.count_if(F.col("section") == "header").alias("n_header"), F.count_if(F.col("section") == "body").alias("n_body"))
    return g.filter("n_header >= 2 and n_header * 4 > n_body")


@query(
    f"WITH {_CELLS}, f AS (SELECT DISTINCT lower(x) AS f FROM (SELECT canonical AS x FROM assay_vocabulary UNION ALL SELECT unnest(surface_forms) FROM assay_vocabulary)) SELECT table_uid, tgroup_ix, section, CAST(row_ix AS INTEGER) AS row_ix, CAST(cell_ix AS INTEGER) AS cell_ix FROM cells WHERE lower(trim(text)) IN (SELECT f FROM f)"
)
def q_measurement_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells that say exactly what an entry of the assay list is called."""
    return layout.measurement_cells(_flat(spark, d), table(spark, d, "assay_vocabulary")).select(*extract.KEY, "section", "row_ix", "cell_ix")
