"""Queries over the domain tables, one or more per operator family, each with the DuckDB SQL that states the same result.

All of them run over whole tables. A query without SQL is one that SQL cannot state; it is tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayloom.common import table
from assayloom.functions import cells as fn
from assayloom.operators import audit, deliver, extract, identity, legend, rules
from assayloom.plans import legend_cases
from assayloom.sources import documents as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# -- SQL fragments -----------------------------------------------------------------------------------------------------------------

_BT = r"regexp_replace({c}, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"
_ASSAY = "patent_id, cid, assay_name, value_numeric, qualifier, unit, n_runs, letter_grade, range_lo, range_hi"


def _bt(c: str) -> str:
    return _BT.format(c=c)


def _ncid(c: str) -> str:
    t = _bt(c)
    for label in fn.CID_LABELS:
        t = _bt(f"regexp_replace({t}, '{label}', '\\1')")
    t = f"regexp_replace({t}, '^#\\s*', '')"
    shape = "'^([A-Za-z]{0,4}-?)0*([0-9]+)([A-Za-z]{0,2})$'"
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN regexp_matches({t}, {shape}) THEN regexp_extract({t}, {shape}, 1) || regexp_extract({t}, {shape}, 2) || regexp_extract({t}, {shape}, 3) WHEN length({t}) <= 40 THEN {t} ELSE '' END"


def _unit(c: str) -> str:
    found = f"regexp_extract({c}, '{'|'.join(p for _, p in fn.UNIT_FORMS)}', 0)"
    return "CASE " + " ".join(f"WHEN regexp_matches({found}, '^(?:{p})$') THEN '{u}'" for u, p in fn.UNIT_FORMS) + " END"


def _nm(v: str, u: str) -> str:
    return f"{v} * CASE translate({u}, 'µμ', 'uu') WHEN 'pM' THEN 1e-3 WHEN 'nM' THEN 1.0 WHEN 'uM' THEN 1e3 WHEN 'mM' THEN 1e6 WHEN 'M' THEN 1e9 END"


def _metric(c: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p}') THEN '{m}'" for m, p in fn.METRICS) + " END"


_USABLE = "(cid IS NOT NULL AND cid <> '' AND assay_name IS NOT NULL AND assay_name <> '' AND NOT contains(lower(assay_name), 'unnamed') AND (value_numeric IS NOT NULL OR range_lo IS NOT NULL OR range_hi IS NOT NULL) AND unit IS NOT NULL AND unit <> '')"
_POTENCY = f"coalesce(regexp_matches(assay_name, '{audit.POTENCY}'), false)"

# typed tables, flat: the same cells as extract.flat_cells
_CELLS = """
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_uid, tgroup_ix ORDER BY scanned_at) AS rn FROM table_objects) WHERE rn = 1),
sec AS (SELECT patent_id, table_uid, tgroup_ix, 'header' AS section, header_rows AS rs FROM one UNION ALL SELECT patent_id, table_uid, tgroup_ix, 'body', body_rows FROM one),
rws AS (SELECT patent_id, table_uid, tgroup_ix, section, unnest(rs) AS r, generate_subscripts(rs, 1) - 1 AS row_ix FROM sec),
raw AS (SELECT patent_id, table_uid, tgroup_ix, section, row_ix, unnest(r) AS c, generate_subscripts(r, 1) - 1 AS cell_ix FROM rws),
c0 AS (SELECT patent_id, table_uid, tgroup_ix, section, row_ix, cell_ix, coalesce(c.text, '') AS text, greatest(coalesce(c.colspan, 1), 1) AS colspan, c.col_start AS col_start, c.chemistry_id AS chemistry_id FROM raw),
cells AS (SELECT * EXCLUDE (col_start), CASE WHEN col_start >= 0 THEN col_start ELSE coalesce(sum(colspan) OVER (PARTITION BY table_uid, tgroup_ix, section, row_ix ORDER BY cell_ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS col FROM c0)"""
_SHAPE = r"CASE WHEN {t} = '' THEN 'empty' WHEN regexp_matches({t}, '^[<>~≥≤=]? ?-?[0-9][0-9,]*\.[0-9]+(?:[eE][-+]?[0-9]+)?|^[<>~≥≤] ?[0-9]') THEN 'num' WHEN regexp_matches({t}, '^(?:[A-Za-z]{{1,4}}-?)?[0-9]{{1,4}}[A-Za-z]{{0,2}}$') THEN 'cid' WHEN regexp_matches({t}, '^[A-E]$|^\++$|^\*+$') THEN 'bin' ELSE 'text' END"
_HEADS = """
fan AS (SELECT table_uid, tgroup_ix, row_ix, text, unnest(range(CAST(col AS BIGINT), CAST(col + colspan AS BIGINT))) AS col FROM cells WHERE section = 'header' AND text <> ''),
fan1 AS (SELECT table_uid, tgroup_ix, col, text, min((row_ix, text)) AS k FROM fan GROUP BY ALL),
heads AS (SELECT table_uid, tgroup_ix, col, string_agg(text, ' ' ORDER BY k) AS header FROM fan1 GROUP BY ALL)"""
_SHAPES = f"""
sh0 AS (SELECT table_uid, tgroup_ix, col, row_ix, cell_ix, regexp_matches({_bt("text")}, '^[F-Zf-z]$') AS stray, {_SHAPE.format(t=_bt("text"))} AS shape FROM cells WHERE section = 'body'),
sh1 AS (SELECT *, row_number() OVER (PARTITION BY table_uid, tgroup_ix, col ORDER BY row_ix, cell_ix) AS rn FROM sh0 WHERE shape <> 'empty'),
sh2 AS (SELECT table_uid, tgroup_ix, col, shape, count(*) AS k FROM sh1 WHERE rn <= 40 GROUP BY ALL),
sh3 AS (SELECT table_uid, tgroup_ix, col, count(*) FILTER (stray) <= 0.05 * count(*) AS closed FROM sh1 WHERE rn <= 40 GROUP BY ALL),
shapes AS (SELECT table_uid, tgroup_ix, col, CASE WHEN max(k) > sum(k) * 0.6 THEN arg_max(shape, (k, shape)) ELSE 'mixed' END AS shape, CAST(sum(k) AS BIGINT) AS n FROM sh2 GROUP BY ALL)"""
_KIND = "CASE " + " ".join(f"WHEN regexp_matches(header, '{p}') THEN '{k}'" for k, p in fn.HEADER_KINDS) + f" WHEN {_unit('header')} IN ('pM','nM','uM','mM','M') THEN 'assay' ELSE 'unknown' END"
_P_UNIT = f"CASE lower(regexp_replace(regexp_extract(h.header, '{fn.P_METRIC}', 0), '[ _]', '', 'g')) " + " ".join(f"WHEN '{u.lower()}' THEN '{u}'" for u in fn.P_UNITS) + " END"
_COLUMNS = f"""
c1 AS (SELECT coalesce(s.table_uid, h.table_uid) AS table_uid, coalesce(s.tgroup_ix, h.tgroup_ix) AS tgroup_ix, coalesce(s.col, h.col) AS col, h.header, s.shape, CASE WHEN h.header IS NOT NULL THEN {_KIND} END AS by_header, coalesce({_unit("h.header")}, {_P_UNIT}) AS unit, coalesce(closed, false) AS closed
  FROM (SELECT * FROM shapes JOIN sh3 USING (table_uid, tgroup_ix, col)) s FULL JOIN heads h ON s.table_uid = h.table_uid AND s.tgroup_ix = h.tgroup_ix AND s.col = h.col),
c2 AS (SELECT *, max(CASE WHEN by_header = 'cid' THEN 1 ELSE 0 END) OVER w AS has_cid, min(CASE WHEN shape = 'cid' AND coalesce(by_header, 'unknown') = 'unknown' THEN col END) OVER w AS leftmost FROM c1 WINDOW w AS (PARTITION BY table_uid, tgroup_ix)),
columns_ AS (SELECT table_uid, tgroup_ix, col, header, CASE WHEN has_cid = 0 AND col = leftmost THEN 'cid' WHEN coalesce(by_header, 'unknown') = 'unknown' AND shape = 'bin' AND closed THEN 'assay' ELSE coalesce(by_header, 'unknown') END AS kind, unit, shape, CASE WHEN header IS NOT NULL THEN 'header' WHEN shape = 'bin' AND closed THEN 'shape' END AS label_source FROM c2)"""


# -- scans and text --------------------------------------------------------------------------------------------------------------


@query(
    f"WITH {_CELLS} SELECT patent_id || '-' || table_uid AS patent_id, CAST(tgroup_ix AS BIGINT) AS tgroup_ix, section, CAST(row_ix AS BIGINT) AS row_ix, CAST(cell_ix AS BIGINT) AS cell_ix, trim(regexp_replace(text, '[\\s\\x{{00A0}}]+', ' ', 'g')) AS text, CAST(colspan AS BIGINT) AS colspan, chemistry_id FROM cells WHERE chemistry_id IS NULL OR chemistry_id <> ''"
    .replace("{{", "{").replace("}}", "}")
)
def q_xml_cells(spark: SparkSession, d: str) -> DataFrame:
    """Scan of table markup (rendered from the table objects) back into cells."""
    t = table(spark, d, "table_objects")
    one = t.withColumn("rn", F.row_number().over(Window.partitionBy("table_uid", "tgroup_ix").orderBy("scanned_at"))).filter("rn = 1").drop("rn")
    # the position in the markup is the rank of the group's number
    rank = one.select("patent_id", "table_uid", "tgroup_ix").withColumn("ix", F.row_number().over(Window.partitionBy("patent_id", "table_uid").orderBy("tgroup_ix")) - 1)
    ranks = rank.select(F.concat_ws("-", "patent_id", "table_uid").alias("patent_id"), F.col("ix").alias("_ix"), F.col("tgroup_ix").alias("_real"))
    cells = src.parse_cells(src.render_xml(one)).join(ranks, "patent_id").filter("tgroup_ix = _ix")
    return cells.select("patent_id", F.col("_real").cast("long").alias("tgroup_ix"), "section", F.col("row_ix").cast("long").alias("row_ix"), F.col("cell_ix").cast("long").alias("cell_ix"), "text", F.col("colspan").cast("long").alias("colspan"), "chemistry_id")


@query("SELECT count(*) AS n_mismatches FROM region WHERE false")
def q_scan_fidelity(spark: SparkSession, d: str) -> DataFrame:
    """Blocks whose parsed cells or rows differ in number from the markup: none."""
    return src.parse_fidelity(src.render_xml(table(spark, d, "table_objects"))).agg(F.count(F.lit(1)).alias("n_mismatches"))


@query(
    r"""WITH l AS (SELECT doc_id, unnest(str_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS line FROM documents WHERE text IS NOT NULL)
SELECT doc_id, count(*) AS n_paragraphs, max(length(line)) AS longest, sum(length(line)) AS n_chars FROM l WHERE trim(line) <> '' GROUP BY doc_id"""
)
def q_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraph counts and lengths per document."""
    lines = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.explode(F.split(F.regexp_replace("text", r"\r\n?", "\n"), "\n", -1)).alias("line")).filter("trim(line) <> ''")
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_paragraphs"), F.max(F.length("line")).cast("long").alias("longest"), F.sum(F.length("line")).alias("n_chars"))


@query(
    r"""WITH l AS (SELECT doc_id, unnest(str_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS line, generate_subscripts(str_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)), 1) - 1 AS line_ix FROM documents WHERE text IS NOT NULL),
n AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY line_ix) AS following FROM l WHERE trim(line) <> '')
SELECT doc_id, CAST(line_ix AS BIGINT) AS line_ix, line AS heading, md5(following) AS following FROM n WHERE regexp_matches(line, '^(?:[A-Z][A-Z ]{3,40}|(?:Example|Step|Claim) [0-9]+[a-z]?)$')"""
)
def q_headings_next(spark: SparkSession, d: str) -> DataFrame:
    """Heading lines with a digest of the line after them."""
    h = src.headings_with_next(table(spark, d, "documents", "doc_id", "text").filter("text is not null"), "doc_id", "text")
    return h.select("doc_id", F.col("line_ix").cast("long").alias("line_ix"), "heading", F.md5("following").alias("following"))


# -- scalar functions ------------------------------------------------------------------------------------------------------------


@query(f"SELECT structure_id, {_ncid('cid')} AS cid FROM structures")
def q_normalize_cid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "structures", "structure_id", "cid").select("structure_id", fn.normalize_cid(F.col("cid")).alias("cid"))


@query(f"SELECT regexp_replace(regexp_replace({_bt('cid')}, '[A-Za-z]', 'A', 'g'), '[0-9]+', '9', 'g') AS shape, count(*) AS n FROM reader_dump GROUP BY ALL")
def q_id_shapes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "reader_dump", "cid").groupBy(fn.id_shape(F.col("cid")).alias("shape")).agg(F.count(F.lit(1)).alias("n"))


@query(
    r"SELECT patent_id, CASE WHEN regexp_matches(x, '^(?:19|20)[0-9]{9}$|^[0-9]{6,8}$') THEN x END AS number FROM (SELECT patent_id, regexp_replace(upper(trim(patent_id)), '^US|[AB][0-9]?$|[^0-9A-Z]', '', 'g') AS x FROM patents)"
)
def q_patent_numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "patents", "patent_id").select("patent_id", fn.patent_number(F.col("patent_id")).alias("number"))


_T = r"trim(replace(replace(translate(value_text, '−–≦≧≈', '--≤≥~'), '>=', '≥'), '<=', '≤'))"
_NUMBER = r"'^([<>~≥≤=])? ?(-?(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)((?: ?[x×] ?10\^?[-+]?[0-9]+)?) ?(%|[numpµμ]?M|[numpµμ]mol/[lL])? ?(?:\(([^)]*)\))? ?[*#†]*$'"

_MEAN = r"'^([<>~≥≤])? ?([0-9][0-9,]*\.?[0-9]*) ?(?:±|\+/-|\+-) ?[0-9.,]+ ?(%|[numpµμ]?M|[numpµμ]mol/[lL])?[ ,;]*(?:\(? ?n ?= ?([0-9]{1,3}) ?\)?)?[ ,;]*[*#]*$'"


@query(
    f"""WITH a AS (SELECT record_id, {_T} AS t FROM assay_records),
b AS (SELECT record_id, t, regexp_matches(t, {_NUMBER}) AS num, coalesce(regexp_matches(t, {_MEAN}), false) AS mean, coalesce(lower(t) IN ('', '-', '--', '—', '–', 'nd', 'nt', 'na', 'n/a', 'n.d.', 'n.t.', 'n.a.', 'not determined', 'not tested'), false) AS nul, regexp_matches(t, '^[A-Ea-e]$|^\\++$|^\\*+$|^#+$') AS grade FROM a),
c AS (SELECT *, TRY_CAST(replace(regexp_extract(t, {_NUMBER}, 2), ',', '') || CASE WHEN regexp_extract(regexp_extract(t, {_NUMBER}, 3), '10\\^?([-+]?[0-9]+)', 1) <> '' THEN 'e' || regexp_extract(regexp_extract(t, {_NUMBER}, 3), '10\\^?([-+]?[0-9]+)', 1) ELSE '' END AS DOUBLE) AS plain, nullif(regexp_extract(t, {_NUMBER}, 5), '') AS paren FROM b)
SELECT record_id, CASE WHEN mean THEN TRY_CAST(replace(regexp_extract(t, {_MEAN}, 2), ',', '') AS DOUBLE) WHEN num AND NOT nul THEN plain END AS value_numeric, CASE WHEN mean THEN nullif(regexp_extract(t, {_MEAN}, 1), '') WHEN num AND NOT nul THEN nullif(regexp_extract(t, {_NUMBER}, 1), '') END AS qualifier,
CASE WHEN mean THEN nullif(regexp_extract(t, {_MEAN}, 3), '') WHEN num AND NOT nul THEN nullif(regexp_extract(t, {_NUMBER}, 4), '') END AS unit,
CASE WHEN mean THEN TRY_CAST(nullif(regexp_extract(t, {_MEAN}, 4), '') AS INTEGER) WHEN num AND NOT nul AND regexp_matches(paren, '^[0-9]{{1,3}}$') THEN CAST(paren AS INTEGER) END AS n_runs, CASE WHEN grade THEN upper(t) END AS letter_grade, CASE WHEN num AND NOT nul AND NOT regexp_matches(paren, '^[0-9]{{1,3}}$') THEN paren END AS annotation FROM c"""
)
def q_parse_value(spark: SparkSession, d: str) -> DataFrame:
    """The value cascade over every value text."""
    rows = table(spark, d, "assay_records", "record_id", "value_text").withColumn("v", fn.parse_value(F.col("value_text")))
    return rows.select("record_id", "v.value_numeric", "v.qualifier", "v.unit", "v.n_runs", "v.letter_grade", "v.annotation")


@query(f"SELECT record_id, {_unit('column_header')} AS unit FROM assay_records")
def q_unit_from_header(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "assay_records", "record_id", "column_header").select("record_id", fn.unit_from(F.col("column_header")).alias("unit"))


@query(f"SELECT dump_row, round({_nm('value_numeric', 'unit')}, 6) AS nm FROM reader_dump")
def q_to_nm(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "reader_dump", "dump_row", "value_numeric", "unit").select("dump_row", F.round(fn.to_nm(F.col("value_numeric"), F.col("unit")), 6).alias("nm"))


_AXES_CLEAN = lambda t: "nullif(regexp_replace(regexp_replace(" + reduce(lambda x, p: f"regexp_replace({x}, '{p}', ' ', 'g')", [fn.DOSE, r"(?i)\( ?[numpµμ]?M ?\)|\( ?% ?\)|\bnM\b|[uµμ]M\b", fn.SPECIES, r"[()\[\]]"], t) + r", '\s+', ' ', 'g'), '^[ \-,;:.]+|[ \-,;:.]+$', '', 'g'), '')"
_AXES_FIRST = "CASE " + " ".join(f"WHEN regexp_matches(n, '{p}') THEN regexp_split_to_array(n, '{p}')[1]" for p in [*[p for _, p in fn.METRICS], fn.THRESHOLD]) + " END"
_AXES_LEFT = reduce(lambda x, p: f"regexp_replace({x}, '{p}', ' ', 'g')", [p for _, p in fn.METRICS], "n")


@query(
    f"""WITH a AS (SELECT DISTINCT assay_name, replace(assay_name, '_', ' ') AS n FROM reader_dump WHERE assay_name IS NOT NULL),
b AS (SELECT *, {_AXES_FIRST} AS first, {_AXES_LEFT} AS rest, regexp_extract(n, '{fn.DOSE}', 1) AS num, regexp_extract(n, '{fn.DOSE}', 2) AS u, regexp_extract(n, '{fn.DOSE}', 3) AS route FROM a)
SELECT assay_name, coalesce({_metric('n')}, CASE WHEN regexp_matches(n, '{fn.THRESHOLD}') THEN upper(regexp_extract(n, '{fn.THRESHOLD}', 1)) || regexp_extract(n, '{fn.THRESHOLD}', 2) END) AS metric,
coalesce({_AXES_CLEAN('first')}, {_AXES_CLEAN('rest')}) AS target, nullif(trim(num || ' ' || u || route), '') AS dose,
CASE WHEN NOT contains(num, ',') THEN TRY_CAST(num AS DOUBLE) * CASE lower(u) WHEN 'nm' THEN 1e-3 WHEN 'um' THEN 1.0 WHEN 'µm' THEN 1.0 WHEN 'μm' THEN 1.0 WHEN 'mm' THEN 1e3 WHEN 'pm' THEN 1e-6 WHEN 'm' THEN 1e6 END END AS dose_um, lower(nullif(regexp_extract(n, '{fn.SPECIES}', 1), '')) AS species FROM b"""
)
def q_heading_axes(spark: SparkSession, d: str) -> DataFrame:
    """Metric, target, dose and species of each distinct heading."""
    names = table(spark, d, "reader_dump", "assay_name").filter("assay_name is not null").distinct()
    return names.withColumn("a", fn.axes(F.col("assay_name"))).select("assay_name", "a.metric", "a.target", "a.dose", "a.dose_um", "a.species")


@query(
    r"""WITH n AS (SELECT record_id, unit, range_lo, range_hi, regexp_replace(printf('%.4f', range_lo), '\.?0+$', '') AS lo, regexp_replace(printf('%.4f', range_hi), '\.?0+$', '') AS hi FROM assay_records),
b AS (SELECT record_id, unit, CASE WHEN range_lo IS NOT NULL AND range_hi IS NOT NULL THEN lo || ' - ' || hi WHEN range_hi IS NOT NULL THEN '<' || hi WHEN range_lo IS NOT NULL THEN '>' || lo END AS t FROM n)
SELECT record_id, CASE WHEN t IS NOT NULL THEN concat_ws(' ', t, unit) END AS band FROM b"""
)
def q_band_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "assay_records", "record_id", "range_lo", "range_hi", "unit").select("record_id", fn.band(F.col("range_lo"), F.col("range_hi"), F.col("unit")).alias("band"))


@query(r"SELECT structure_id, regexp_replace(regexp_replace(raw_cell, '\s*([-\[\]{}(),])\s+', '\1', 'g'), '\s+([-\]}),])', '\1', 'g') AS name FROM structures WHERE raw_cell IS NOT NULL")
def q_dewrap(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "structures", "structure_id", "raw_cell").filter("raw_cell is not null").select("structure_id", fn.dewrap(F.col("raw_cell")).alias("name"))


@query(
    """WITH m AS (SELECT CASE WHEN cid IS NULL OR cid = '' THEN 'cid' END AS a, CASE WHEN assay_name IS NULL OR assay_name = '' OR contains(lower(assay_name), 'unnamed') THEN 'assay_name' END AS b, CASE WHEN value_numeric IS NULL AND range_lo IS NULL AND range_hi IS NULL THEN 'value' END AS c, CASE WHEN unit IS NULL OR unit = '' THEN 'unit' END AS d FROM assay_records)
SELECT concat_ws(',', a, b, c, d) AS missing, count(*) AS n FROM m GROUP BY ALL"""
)
def q_missing_fields(spark: SparkSession, d: str) -> DataFrame:
    """What records lack to be usable."""
    r = table(spark, d, "assay_records")
    m = fn.missing_fields(F.col("cid"), F.col("assay_name"), F.col("value_numeric"), F.col("range_lo"), F.col("range_hi"), F.col("unit"))
    return r.groupBy(F.array_join(m, ",").alias("missing")).agg(F.count(F.lit(1)).alias("n"))


@query(
    r"""WITH p AS (SELECT structure_id, regexp_replace(name, '[^ -~]', '?', 'g') AS name, regexp_replace(raw_cell, '[^ -~]', '?', 'g') AS raw_cell FROM structures WHERE name IS NOT NULL AND raw_cell IS NOT NULL),
e AS (SELECT structure_id, upper(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')) AS a, upper(regexp_replace(raw_cell, '[^A-Za-z0-9]', '', 'g')) AS t, greatest(0.0, 1 - levenshtein(name, raw_cell) / greatest(length(name), 1)) AS r FROM p)
SELECT structure_id, round(r, 6) AS retention, round(CASE WHEN length(a) > 0 AND contains(t, a) THEN length(a) / length(t) ELSE 0.0 END, 6) AS coverage FROM e"""
)
def q_retention_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Edit and containment gates of a repaired name against its raw cell, other characters than ASCII as question marks."""
    r = table(spark, d, "structures", "structure_id", "name", "raw_cell").dropna()
    r = r.withColumns({c: F.regexp_replace(c, "[^ -~]", "?") for c in ("name", "raw_cell")})
    return r.select("structure_id", F.round(fn.retention(F.col("name"), F.col("raw_cell")), 6).alias("retention"), F.round(fn.coverage(F.col("name"), F.col("raw_cell")), 6).alias("coverage"))


# -- columns and extraction ------------------------------------------------------------------------------------------------------


def _flat(spark: SparkSession, d: str) -> DataFrame:
    return extract.flat_cells(table(spark, d, "table_objects"))


@query(f"WITH {_CELLS}, {_SHAPES} SELECT table_uid, tgroup_ix, CAST(col AS INTEGER) AS col, shape, n FROM shapes")
def q_column_shapes(spark: SparkSession, d: str) -> DataFrame:
    return extract.column_shapes(_flat(spark, d))


@query(f"WITH {_CELLS}, {_HEADS} SELECT table_uid, tgroup_ix, CAST(col AS INTEGER) AS col, header FROM heads")
def q_merged_headers(spark: SparkSession, d: str) -> DataFrame:
    return extract.merged_headers(_flat(spark, d))


@query(f"WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS} SELECT table_uid, tgroup_ix, CAST(col AS INTEGER) AS col, header, kind, unit, shape, label_source FROM columns_")
def q_classify_columns(spark: SparkSession, d: str) -> DataFrame:
    return extract.classify_columns(_flat(spark, d))


_SIG = "sig AS (SELECT coalesce(s.table_uid, h.table_uid) AS table_uid, coalesce(s.tgroup_ix, h.tgroup_ix) AS tgroup_ix, concat_ws('|', CAST(count(*) AS VARCHAR), string_agg(coalesce(s.shape, 'empty') || ':' || lower(coalesce(h.header, '')), '|' ORDER BY coalesce(s.col, h.col))) AS signature FROM shapes s FULL JOIN heads h ON s.table_uid = h.table_uid AND s.tgroup_ix = h.tgroup_ix AND s.col = h.col GROUP BY 1, 2)"


@query(f"WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_SIG} SELECT table_uid, tgroup_ix, substr(sha256(signature), 1, 16) AS fingerprint FROM sig")
def q_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return extract.layout_signature(_flat(spark, d)).select("table_uid", "tgroup_ix", "fingerprint")


@query(
    f"""WITH {_CELLS}, {_HEADS}, g AS (SELECT o.patent_id, o.table_uid, o.tgroup_ix, o.n_cols, h.header FROM one o LEFT JOIN (SELECT table_uid, tgroup_ix, string_agg(header, '|' ORDER BY col) AS header FROM heads GROUP BY ALL) h USING (table_uid, tgroup_ix))
SELECT table_uid, tgroup_ix, coalesce(nullif(header, ''), last_value(nullif(header, '') IGNORE NULLS) OVER (PARTITION BY patent_id, n_cols ORDER BY table_uid, tgroup_ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS effective FROM g"""
)
def q_inherit_headers(spark: SparkSession, d: str) -> DataFrame:
    """Headerless groups take the header of the last group of the same width in their patent."""
    t = table(spark, d, "table_objects")
    one = t.withColumn("rn", F.row_number().over(Window.partitionBy("table_uid", "tgroup_ix").orderBy("scanned_at"))).filter("rn = 1")
    h = extract.merged_headers(extract.flat_cells(t)).groupBy(*extract.KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "header"))), lambda x: x["header"]), "|").alias("header"))
    groups = one.select("patent_id", *extract.KEY, "n_cols").join(h, extract.KEY, "left")
    return extract.inherit_headers(groups).select(*extract.KEY, "effective")


_RECORDS = f"""
body AS (SELECT c.*, k.header, k.kind, k.unit FROM cells c JOIN columns_ k USING (table_uid, tgroup_ix, col) WHERE c.section = 'body'),
ids AS (SELECT table_uid, tgroup_ix, row_ix, arg_min(text, col) AS own FROM body WHERE kind = 'cid' GROUP BY ALL),
drawn AS (SELECT table_uid, tgroup_ix, row_ix, bool_or(chemistry_id IS NOT NULL) AS has_drawing FROM cells WHERE section = 'body' GROUP BY ALL),
idn AS (SELECT table_uid, tgroup_ix, row_ix, nullif({_ncid("own")}, '') AS own, has_drawing FROM ids JOIN drawn USING (table_uid, tgroup_ix, row_ix)),
carried AS (SELECT table_uid, tgroup_ix, row_ix, CASE WHEN own IS NOT NULL THEN own WHEN NOT has_drawing THEN last_value(own IGNORE NULLS) OVER (PARTITION BY table_uid, tgroup_ix ORDER BY row_ix ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cid FROM idn),
vals AS (SELECT b.*, trim(b.text) AS t FROM body b WHERE kind = 'assay'),
recs AS (SELECT v.table_uid, v.tgroup_ix, v.row_ix, v.col, r.cid, coalesce(v.header, 'unnamed assay (letter bin)') AS assay_name, CASE WHEN regexp_matches(t, {_NUMBER}) AND lower(t) NOT IN ('', '-', '--', '—', '–') THEN TRY_CAST(replace(regexp_extract(t, {_NUMBER}, 2), ',', '') || CASE WHEN regexp_extract(regexp_extract(t, {_NUMBER}, 3), '10\\^?([-+]?[0-9]+)', 1) <> '' THEN 'e' || regexp_extract(regexp_extract(t, {_NUMBER}, 3), '10\\^?([-+]?[0-9]+)', 1) ELSE '' END AS DOUBLE) END AS value_numeric, CASE WHEN regexp_matches(t, '^[A-Ea-e]$|^\\++$|^\\*+$|^#+$') THEN upper(t) END AS letter_grade FROM vals v LEFT JOIN carried r USING (table_uid, tgroup_ix, row_ix))"""


@query(f"WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS}, {_RECORDS} SELECT table_uid, tgroup_ix, CAST(row_ix AS INTEGER) AS row_ix, CAST(col AS INTEGER) AS col, cid, assay_name, value_numeric, letter_grade FROM recs WHERE value_numeric IS NOT NULL OR letter_grade IS NOT NULL")
def q_extract_records(spark: SparkSession, d: str) -> DataFrame:
    """Wide tables into long records: classified columns, carried ids, parsed cells."""
    return extract.records(table(spark, d, "table_objects")).select("table_uid", "tgroup_ix", "row_ix", "col", "cid", "assay_name", "value_numeric", "letter_grade")


@query(
    """WITH l AS (SELECT patent_id, assay_name, letter_grade, string_agg(DISTINCT cid, ', ') AS ids FROM reader_dump WHERE letter_grade IS NOT NULL AND regexp_matches(trim(cid), '^[0-9]{1,4}$') GROUP BY ALL),
p AS (SELECT patent_id, assay_name, letter_grade, list_transform(str_split(ids, ','), lambda x: trim(x)) AS p FROM l)
SELECT patent_id, assay_name, letter_grade, unnest(p) AS cid FROM p WHERE len(p) >= 3"""
)
def q_inverted_ids(spark: SparkSession, d: str) -> DataFrame:
    """Grade rows that list their compounds, turned back into one row per compound."""
    r = table(spark, d, "reader_dump", "patent_id", "assay_name", "letter_grade", "cid").filter("letter_grade is not null").filter(F.trim("cid").rlike("^[0-9]{1,4}$")).distinct()
    lists = r.groupBy("patent_id", "assay_name", "letter_grade").agg(F.array_join(F.collect_set("cid"), ", ").alias("ids"))
    return extract.explode_id_lists(lists, "ids", ["patent_id", "assay_name", "letter_grade"])


@query(
    """WITH g AS (SELECT user_id, event_type, epoch_us(ts) AS us, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
k AS (SELECT user_id, event_type, pos - lag(pos) OVER (PARTITION BY user_id, event_type ORDER BY pos) AS gap FROM g),
c AS (SELECT user_id, event_type, gap, count(*) AS k FROM k WHERE gap IS NOT NULL GROUP BY ALL)
SELECT user_id, event_type, arg_max(gap, (k, -gap)) AS stride, round(max(k) / sum(k), 6) AS share, CAST(sum(k) AS BIGINT) AS n FROM c GROUP BY ALL HAVING sum(k) >= 5"""
)
def q_modal_stride(spark: SparkSession, d: str) -> DataFrame:
    """Modal distance between repeats of a label, as vertical record lists are found."""
    e = table(spark, d, "events", "user_id", "event_type", "ts", "event_id")
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    out = extract.modal_stride(e.withColumn("pos", pos), ["user_id"], "event_type", "pos")
    return out.withColumn("share", F.round("share", 6))


@query(
    """WITH s AS (SELECT user_id, event_id, ts, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM events)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, min(event_id) AS first_event FROM s GROUP BY ALL"""
)
def q_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Records of a vertical list: a new one begins at each anchor."""
    e = table(spark, d, "events", "user_id", "event_type", "ts", "event_id").withColumn("at", F.struct("ts", "event_id"))
    s = extract.sessions(e, ["user_id"], "at", F.col("event_type") == "view")
    return s.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


# -- legends ---------------------------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT table_uid, symbol, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, unit FROM table_objects JOIN (VALUES ('A', NULL, 10.0, 'nM'), ('B', 10.0, 100.0, 'nM'), ('C', 100.0, NULL, 'nM')) AS v(symbol, lo, hi, unit) ON following = 'A: below 10 nM; B: 10 to 100 nM; C: above 100 nM.'")
def q_bin_parse(spark: SparkSession, d: str) -> DataFrame:
    """Legends in the text after tables, as intervals; conflicting symbols are dropped."""
    t = table(spark, d, "table_objects", "table_uid", "following").filter("following is not null")
    return legend.drop_conflicts(legend.bins(t, ["table_uid"], F.col("following")), ["table_uid"]).select("table_uid", "symbol", "lo", "hi", "unit")


@query(legend_cases.expected_sql())
def q_legend_grammar(spark: SparkSession, d: str) -> DataFrame:
    """The grammar on legend texts of every form, held against definitions written out by hand."""
    t = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(legend_cases.CASES)], "case_no int, text string")
    return legend.bins(t, ["case_no"], F.col("text")).select("case_no", "symbol", "lo", "hi", "unit")


_BINS = "bins AS (SELECT patent_id, letter_grade AS symbol, min((range_lo, range_hi, unit)) AS a, max((range_lo, range_hi, unit)) AS b FROM reader_dump WHERE letter_grade IS NOT NULL AND (range_lo IS NOT NULL OR range_hi IS NOT NULL) GROUP BY ALL)"


@query("SELECT patent_id, letter_grade AS symbol, min(range_lo) AS lo, min(range_hi) AS hi, min(unit) AS unit FROM reader_dump WHERE letter_grade IS NOT NULL AND (range_lo IS NOT NULL OR range_hi IS NOT NULL) GROUP BY ALL HAVING count(DISTINCT concat_ws('|', coalesce(CAST(range_lo AS VARCHAR), 'x'), coalesce(CAST(range_hi AS VARCHAR), 'x'), coalesce(unit, 'x'))) = 1")
def q_bin_conflict(spark: SparkSession, d: str) -> DataFrame:
    """Definitions per patent and grade; a grade defined in two ways yields none."""
    b = table(spark, d, "reader_dump", "patent_id", "letter_grade", "range_lo", "range_hi", "unit").filter("letter_grade is not null and (range_lo is not null or range_hi is not null)")
    return legend.drop_conflicts(b.select("patent_id", F.col("letter_grade").alias("symbol"), F.col("range_lo").alias("lo"), F.col("range_hi").alias("hi"), "unit"), ["patent_id"])


@query(
    """WITH t AS (SELECT DISTINCT patent_id, table_id FROM table_objects WHERE following = 'A: below 10 nM; B: 10 to 100 nM; C: above 100 nM.' AND patent_id IS NOT NULL AND table_id IS NOT NULL),
b AS (SELECT * FROM (VALUES ('A', NULL, 10.0, 'nM'), ('B', 10.0, 100.0, 'nM'), ('C', 100.0, NULL, 'nM')) AS v(s, lo, hi, u)),
j AS (SELECT r.dump_row, r.range_lo, r.range_hi, r.unit, b.lo, b.hi, b.u, t.table_id IS NOT NULL AND b.s IS NOT NULL AND r.range_lo IS NULL AND r.range_hi IS NULL AND (CASE WHEN regexp_matches(r.unit, '^(?:[numpµμ]?M|[numpµμ]?mol/[lL])$') THEN true WHEN regexp_matches(r.unit, '^(?:%|percent|pct)$|^m?g/kg$|^(?:fold|ratio|x)$') THEN false ELSE true END) AS take
  FROM reader_dump r LEFT JOIN t USING (patent_id, table_id) LEFT JOIN b ON upper(r.letter_grade) = b.s WHERE r.letter_grade IS NOT NULL)
SELECT dump_row, CASE WHEN take THEN lo ELSE range_lo END AS range_lo, CASE WHEN take THEN hi ELSE range_hi END AS range_hi, CASE WHEN take THEN coalesce(u, unit) ELSE unit END AS unit FROM j"""
)
def q_bin_attach(spark: SparkSession, d: str) -> DataFrame:
    """The legends below tables attached to the graded rows of these tables that have no bounds, where the units fit."""
    r = table(spark, d, "reader_dump", "dump_row", "patent_id", "table_id", "letter_grade", "range_lo", "range_hi", "unit").filter("letter_grade is not null")
    t = table(spark, d, "table_objects", "patent_id", "table_id", "following").filter("following is not null and patent_id is not null and table_id is not null").distinct()
    keys = ["patent_id", "table_id"]
    return legend.attach(r, legend.drop_conflicts(legend.bins(t, keys, F.col("following")), keys), keys).select("dump_row", "range_lo", "range_hi", "unit")


@query()
def q_legend_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of numbered examples gathered where at most 120 characters apart (positions by summed lengths)."""
    docs = table(spark, d, "documents", "doc_id", "text").filter(F.col("text").rlike("Example [0-9]"))
    parts = docs.select("doc_id", F.posexplode(F.split("text", r"(?=Example [0-9])")).alias("k", "part"))
    end = F.sum(F.length("part")).over(Window.partitionBy("doc_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    hits = parts.withColumn("start", end - F.length("part")).filter(F.col("part").rlike("^Example [0-9]")).withColumn("end", F.col("start") + F.length(F.regexp_extract("part", "^Example [0-9]+", 0)))
    return legend.clusters(hits, ["doc_id"], "start", "end")


# -- joins -----------------------------------------------------------------------------------------------------------------------

_PC = r"regexp_replace(regexp_replace(lower({c}), '^\s+|\s+$', '', 'g'), '^(example|ex|compound|cmpd|cpd|no)(\.\s*|\s+|$|([^a-z.\s]))', '\3')"


def _keyed(spark: SparkSession, d: str, name: str) -> DataFrame:
    from assayloom.common import plain_cid

    return table(spark, d, name).withColumn("cid", plain_cid(F.col("cid"))).filter("cid is not null and patent_id is not null")


def _k(t: str) -> str:
    return f"(SELECT * REPLACE ({_PC.format(c='cid')} AS cid) FROM {t} WHERE cid IS NOT NULL AND patent_id IS NOT NULL)"


@query(
    f"""WITH s AS (SELECT patent_id, cid, count(*) AS n_structures FROM {_k("structures")} GROUP BY ALL), r AS (SELECT patent_id, cid, count(*) AS n_records FROM {_k("reader_dump")} GROUP BY ALL)
SELECT coalesce(s.patent_id, r.patent_id) AS patent_id, coalesce(s.cid, r.cid) AS cid, n_structures, n_records FROM s FULL JOIN r ON s.patent_id = r.patent_id AND s.cid = r.cid"""
)
def q_identity_full_outer(spark: SparkSession, d: str) -> DataFrame:
    """Structures and measurements of every key of either side."""
    s = _keyed(spark, d, "structures").groupBy("patent_id", "cid").agg(F.count(F.lit(1)).alias("n_structures"))
    r = _keyed(spark, d, "reader_dump").groupBy("patent_id", "cid").agg(F.count(F.lit(1)).alias("n_records"))
    return s.join(r, ["patent_id", "cid"], "full_outer")


@query(
    f"""WITH s AS {_k("structures")}, r AS (SELECT patent_id, cid, structure_id, source, CASE source WHEN 'table' THEN 0 WHEN 'description' THEN 1 ELSE 2 END AS p FROM s)
SELECT patent_id, cid, structure_id, source FROM r WHERE NOT EXISTS (SELECT 1 FROM r AS b WHERE b.patent_id = r.patent_id AND b.cid = r.cid AND b.p < r.p)"""
)
def q_precedence_union(spark: SparkSession, d: str) -> DataFrame:
    """Table names first; the description adds compounds the tables lack, and drawings those that neither has."""
    s = _keyed(spark, d, "structures").select("patent_id", "cid", "structure_id", "source")
    return identity.by_precedence([s.filter("source = 'table'"), s.filter("source = 'description'"), s.filter("source = 'image'")], ["patent_id", "cid"])


@query(f"WITH s AS {_k('structures')} SELECT patent_id, cid, structure_id, inchikey FROM (SELECT *, row_number() OVER (PARTITION BY patent_id, cid ORDER BY (inchikey IS NULL), structure_id) AS rn FROM s) WHERE rn = 1")
def q_first_resolved(spark: SparkSession, d: str) -> DataFrame:
    """Best structure per key: with a structure key before without, then the earliest."""
    return identity.best_structure(_keyed(spark, d, "structures"), ["patent_id", "cid"]).select("patent_id", "cid", "structure_id", "inchikey")


@query(
    f"""WITH m AS (SELECT patent_id, cid, CASE WHEN max(reported_mz) - min(reported_mz) <= 22.5 THEN arg_max(reported_mz, dump_row) END AS mz FROM {_k("reader_dump")} WHERE reported_mz IS NOT NULL GROUP BY ALL),
c AS (SELECT compound_row, patent_id, cid, reported_mz FROM {_k("compounds")})
SELECT compound_row, CASE WHEN abs(c.reported_mz - m.mz) IS NULL THEN 'unchecked' WHEN abs(c.reported_mz - m.mz) <= 1.5 THEN 'agrees' ELSE 'contradicts' END AS verdict FROM c LEFT JOIN m USING (patent_id, cid)"""
)
def q_mass_gate(spark: SparkSession, d: str) -> DataFrame:
    """Masses of compounds against the unambiguous printed mass of their records."""
    m = identity.unambiguous_mass(_keyed(spark, d, "reader_dump"), ["patent_id", "cid"], "reported_mz", "dump_row").withColumnRenamed("reported_mz", "mz")
    c = _keyed(spark, d, "compounds").select("compound_row", "patent_id", "cid", "reported_mz")
    return c.join(m, ["patent_id", "cid"], "left").select("compound_row", identity.mass_verdict(F.col("reported_mz"), F.col("mz")).alias("verdict"))


@query(
    f"""WITH r AS (SELECT DISTINCT patent_id, cid, value_numeric AS v FROM {_k("assay_records")} WHERE value_numeric IS NOT NULL), o AS (SELECT DISTINCT patent_id, cid, value_numeric AS o FROM {_k("reader_dump")} WHERE value_numeric IS NOT NULL)
SELECT patent_id, cid, v AS value_numeric, bool_or(abs(o - v) <= 0.01 * greatest(abs(v), 1e-12)) AS agrees FROM r JOIN o USING (patent_id, cid) GROUP BY ALL"""
)
def q_reference_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Values of one source that another confirms within 1 % for the same compound."""
    return identity.tolerance_agreement(_keyed(spark, d, "assay_records"), _keyed(spark, d, "reader_dump"), ["patent_id", "cid"], "value_numeric")


@query(
    """WITH p AS (SELECT patent_id, loaded_at AS at, arg_max(name, compound_row) AS name FROM compounds WHERE patent_id IS NOT NULL GROUP BY ALL)
SELECT s.structure_id, p.name AS last_compound FROM (SELECT * FROM structures WHERE patent_id IS NOT NULL) s ASOF LEFT JOIN p ON s.patent_id = p.patent_id AND s.loaded_at >= p.at"""
)
def q_asof_latest(spark: SparkSession, d: str) -> DataFrame:
    """The compound of the same patent that was loaded last before each structure."""
    s = table(spark, d, "structures", "structure_id", "patent_id", "loaded_at").filter("patent_id is not null")
    p = table(spark, d, "compounds", "patent_id", "loaded_at", "name", "compound_row").filter("patent_id is not null").groupBy("patent_id", "loaded_at").agg(F.max_by("name", "compound_row").alias("last_compound"))
    p = p.withColumn("last_compound", F.coalesce("last_compound", F.lit("\x00")))
    out = identity.asof_before(s, p, ["patent_id"], "loaded_at", ["last_compound"], bucket=F.to_date("loaded_at"))
    return out.select("structure_id", F.nullif("last_compound", F.lit("\x00")).alias("last_compound"))


@query(
    r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '\S+')) AS w, generate_subscripts(regexp_extract_all(text, '\S+'), 1) AS p FROM documents WHERE text IS NOT NULL),
pos AS (SELECT doc_id, w, p, sum(length(w) + 1) OVER (PARTITION BY doc_id ORDER BY p) - length(w) - 1 AS s FROM w),
n AS (SELECT doc_id, s AS name_pos, s + length(w) AS name_end FROM pos WHERE regexp_matches(w, '^(IC50|EC50|Ki|Kd)[,.;:]?$')),
i AS (SELECT doc_id, regexp_replace(w, '[^0-9a-z]', '', 'g') AS id, s AS id_pos, s + length(w) AS id_end FROM pos WHERE regexp_matches(w, '^[0-9]{1,3}[a-z]?[,.;)]?$')),
h AS (SELECT n.doc_id, n.name_pos, i.id FROM n JOIN i ON n.doc_id = i.doc_id AND greatest(i.id_pos - n.name_end, n.name_pos - i.id_end, 0) <= 25)
SELECT doc_id, CAST(name_pos AS BIGINT) AS name_pos, CASE WHEN count(DISTINCT id) = 1 THEN min(id) END AS id, count(DISTINCT id) AS n_ids FROM h GROUP BY ALL"""
)
def q_proximity_clash(spark: SparkSession, d: str) -> DataFrame:
    """Numbers within 25 characters of a metric word; two different ones clash."""
    docs = table(spark, d, "documents", "doc_id", "text").filter(F.col("text").rlike(r"(?:IC50|EC50|Ki|Kd)"))
    hits = identity.token_hits(docs, "doc_id", "text", {"name": r"(?:IC50|EC50|Ki|Kd)[,.;:]?", "id": r"[0-9]{1,3}[a-z]?[,.;)]?"})
    names = hits.filter("kind = 'name'").select("doc_id", F.col("start").alias("name_pos"), F.col("end").alias("name_end"))
    ids = hits.filter("kind = 'id'").select("doc_id", F.regexp_replace("token", "[^0-9a-z]", "").alias("id"), F.col("start").alias("id_pos"), F.col("end").alias("id_end"))
    return identity.within_reach(names, ids, "doc_id")


@query(
    """WITH l AS (SELECT patent_id, structure_id, row_number() OVER w AS n, count(*) OVER (PARTITION BY patent_id) AS c FROM structures WHERE source = 'image' AND patent_id IS NOT NULL WINDOW w AS (PARTITION BY patent_id ORDER BY structure_id)),
r AS (SELECT patent_id, table_uid, row_number() OVER w AS n, count(*) OVER (PARTITION BY patent_id) AS c FROM (SELECT DISTINCT patent_id, table_uid FROM table_objects) WINDOW w AS (PARTITION BY patent_id ORDER BY table_uid))
SELECT patent_id, n, structure_id, table_uid FROM l JOIN r USING (patent_id, n, c)"""
)
def q_positional_zip(spark: SparkSession, d: str) -> DataFrame:
    """n-th drawing with n-th table of a patent, where there are as many."""
    left = table(spark, d, "structures", "patent_id", "structure_id", "source").filter("source = 'image' and patent_id is not null").select("patent_id", "structure_id")
    right = table(spark, d, "table_objects", "patent_id", "table_uid").distinct()
    return identity.positional_zip(left, right, ["patent_id"], "structure_id", "table_uid").select("patent_id", F.col("n").cast("long").alias("n"), "structure_id", "table_uid")


_TOK = "list_distinct(list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda w: length(w) >= 4))"


@query(
    f"""WITH c AS (SELECT DISTINCT caption FROM table_objects WHERE caption IS NOT NULL), a AS (SELECT caption, unnest({_TOK.format(c="caption")}) AS w FROM c), v AS (SELECT vocab_id, unnest({_TOK.format(c="canonical")}) AS w FROM assay_vocabulary),
s AS (SELECT caption, vocab_id, max(length(w)) AS score FROM a JOIN v USING (w) GROUP BY ALL), t AS (SELECT *, max(score) OVER (PARTITION BY caption) AS top FROM s)
SELECT caption, CASE WHEN count(*) = 1 THEN min(vocab_id) END AS vocab_id, CAST(max(score) AS INTEGER) AS score FROM t WHERE score = top GROUP BY caption"""
)
def q_longest_token(spark: SparkSession, d: str) -> DataFrame:
    """Captions with the list entry that shares their longest word; ties give none."""
    c = table(spark, d, "table_objects", "caption").filter("caption is not null").distinct()
    return identity.longest_shared_token(c, table(spark, d, "assay_vocabulary"), "caption", "caption", "vocab_id", "canonical")


_SCALES = [("(?i)ic.?50", "ic50"), ("(?i)ec.?50", "ec50"), ("(?i)% ?inhibition", "inhibition"), ("(?i)inhibition", "inhib"), ("(?i)clearance (human|rat)", "clearance"), ("(?i)k[id]\\b", "ki")]


@query(
    "WITH s AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{p}', '{lit}')" for p, lit in _SCALES)
    + ") AS v(pattern, literal)), n AS (SELECT DISTINCT assay_name FROM reader_dump WHERE assay_name IS NOT NULL), h AS (SELECT assay_name, pattern, length(literal) AS l, max(length(literal)) OVER (PARTITION BY assay_name) AS m FROM n JOIN s ON regexp_matches(assay_name, pattern)) SELECT assay_name, CASE WHEN count(DISTINCT pattern) = 1 THEN min(pattern) END AS pattern FROM h WHERE l = m GROUP BY assay_name"
)
def q_regex_scale(spark: SparkSession, d: str) -> DataFrame:
    """Headings with the scale whose pattern fits best; ambiguous ones give none."""
    names = table(spark, d, "reader_dump", "assay_name").filter("assay_name is not null").distinct()
    return rules.coverage_join(names, _SCALES, "assay_name")


_LEXICON = [("methanol", "solvent"), ("ethanol", "solvent"), ("toluene", "solvent"), ("triethylamine", "base"), ("piperidine", "base"), ("urea", "other"), ("amine", "other")]


@query(
    "WITH e AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{a}', '{b}')" for a, b in _LEXICON)
    + ") AS v(k, c)), n AS (SELECT compound_row, lower(trim(regexp_extract(name, '[a-z]+$', 0))) AS w FROM compounds WHERE name IS NOT NULL), s AS (SELECT compound_row, w, CASE "
    + " ".join(f"WHEN ends_with(w || ' hydrochloride', ' {x}') THEN trim(substr(w || ' hydrochloride', 1, length(w || ' hydrochloride') - {len(x)}))" for x in fn.SALT_SUFFIXES)
    + " END AS st FROM n) SELECT compound_row, w || ' hydrochloride' AS name, coalesce(a.c, b.c) AS category FROM s LEFT JOIN e a ON s.w || ' hydrochloride' = a.k LEFT JOIN e b ON s.st = b.k"
)
def q_dictionary_suffix(spark: SparkSession, d: str) -> DataFrame:
    """Reagent words with a salt ending, looked up whole and without the ending."""
    n = table(spark, d, "compounds", "compound_row", "name").filter("name is not null")
    n = n.select("compound_row", F.concat(F.lower(F.trim(F.regexp_extract("name", "[a-z]+$", 0))), F.lit(" hydrochloride")).alias("name"))
    entries = spark.createDataFrame(_LEXICON, "key string, cat string")
    return identity.dictionary_with_suffix(n, entries, "name", "key", "cat", fn.strip_salt(F.col("name"))).select("compound_row", "name", "category")


@query(
    f"""WITH s AS {_k("structures")}, w AS (SELECT structure_id, patent_id, cid, CASE WHEN inchikey IS NOT NULL AND coalesce(mass_check, '') <> 'contradict' THEN 'VALIDATE' ELSE 'RECOVER' END AS job FROM s WHERE source = 'image')
SELECT patent_id, count(*) FILTER (job = 'VALIDATE') AS validate, count(*) FILTER (job = 'RECOVER') AS recover FROM w WHERE (patent_id, cid) IN (SELECT patent_id, cid FROM {_k("reader_dump")}) AND (patent_id, cid) NOT IN (SELECT patent_id, cid FROM s WHERE source = 'table') GROUP BY patent_id"""
)
def q_worklist(spark: SparkSession, d: str) -> DataFrame:
    """Drawings of assayed compounds that no table names, by job and patent."""
    s = _keyed(spark, d, "structures")
    w = identity.worklist(s.filter("source = 'image'"), _keyed(spark, d, "reader_dump"), s.filter("source = 'table'"), ["patent_id", "cid"])
    return w.groupBy("patent_id").agg(F.count_if(F.col("job") == "VALIDATE").alias("validate"), F.count_if(F.col("job") == "RECOVER").alias("recover"))


@query(
    f"""WITH e AS (SELECT patent_id, cid, max(inchikey) AS expected FROM {_k("compounds")} WHERE inchikey IS NOT NULL GROUP BY ALL), r AS (SELECT e.patent_id, e.expected, s.inchikey AS got FROM {_k("structures")} s JOIN e USING (patent_id, cid)),
g AS (SELECT patent_id, count(*) FILTER (got = expected) AS agreed, count(*) FILTER (got <> expected) AS disagreed, count(*) FILTER (got IS NULL) AS unread FROM r GROUP BY ALL)
SELECT patent_id, agreed, disagreed, unread, round(agreed / nullif(agreed + disagreed, 0), 6) AS accuracy FROM g"""
)
def q_score_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Structures against the delivered keys: conditional accuracy per patent."""
    e = _keyed(spark, d, "compounds").filter("inchikey is not null").groupBy("patent_id", "cid").agg(F.max("inchikey").alias("expected"))
    r = _keyed(spark, d, "structures").join(e, ["patent_id", "cid"]).select("patent_id", "expected", F.col("inchikey").alias("got"))
    return identity.score(r, ["patent_id"]).withColumn("accuracy", F.round("accuracy", 6))


# -- aggregates, audits and gaps -------------------------------------------------------------------------------------------------


@query("SELECT patent_id, lower(assay_name) AS assay, count(*) AS n, coalesce(array_to_string(list_sort(list(DISTINCT unit) FILTER (unit IS NOT NULL)), ','), '') AS units, coalesce(array_to_string(list_sort(list(DISTINCT table_id) FILTER (table_id IS NOT NULL)), ','), '') AS table_ids FROM reader_dump GROUP BY ALL")
def q_rollup_sets(spark: SparkSession, d: str) -> DataFrame:
    """Assays of a patent with their rows, units and tables."""
    r = table(spark, d, "reader_dump", "patent_id", "assay_name", "unit", "table_id").withColumn("assay", F.lower("assay_name"))
    return deliver.rollup(r, ["patent_id", "assay"], ["unit", "table_id"])


_FLAGS = f"""
u AS (SELECT *, {_USABLE} AS usable, {_POTENCY} AS potency, {_nm("value_numeric", "unit")} AS nm FROM assay_records),
f AS (
SELECT 'n_runs_dropped' AS "check", patent_id, stated - kept AS rows_at_stake, NULL AS detail FROM (SELECT patent_id, count(*) FILTER (regexp_matches(value_text, '\\([0-9]{{1,3}}\\)')) AS stated, count(n_runs) AS kept FROM u GROUP BY patent_id) WHERE stated >= 5 AND stated - kept >= greatest(3.0, 0.1 * stated)
UNION ALL SELECT 'potency_out_of_range', patent_id, count(*), NULL FROM u WHERE usable AND potency AND (nm <= 0 OR nm < 1e-3 OR nm > 1e6) GROUP BY patent_id
UNION ALL SELECT 'unconvertible_unit', patent_id, count(*), unit FROM u WHERE usable AND potency AND value_numeric IS NOT NULL AND nm IS NULL GROUP BY patent_id, unit
UNION ALL SELECT 'unnamed_assay', patent_id, count(*), NULL FROM u WHERE (assay_name IS NULL OR assay_name = '' OR contains(lower(assay_name), 'unnamed')) AND (value_numeric IS NOT NULL OR range_lo IS NOT NULL OR range_hi IS NOT NULL) GROUP BY patent_id HAVING count(*) >= 5
UNION ALL SELECT 'same_assay_disagrees', patent_id, CAST(sum(n) AS BIGINT), name FROM (SELECT patent_id, lower(assay_name) AS name, table_id, median(nm) AS m, count(*) AS n FROM u WHERE usable AND potency AND nm > 0 GROUP BY ALL) WHERE n >= 4 GROUP BY patent_id, name HAVING count(*) >= 2 AND max(m) / min(m) >= 100
UNION ALL SELECT 'impossible_interval', patent_id, count(*), NULL FROM u WHERE range_lo >= range_hi GROUP BY patent_id
UNION ALL SELECT 'duplicate_facts', patent_id, CAST(sum(n - 1) AS BIGINT), NULL FROM (SELECT patent_id, cid, assay_name, table_id, value_numeric, letter_grade, range_lo, range_hi, unit, count(*) AS n FROM u GROUP BY ALL) WHERE n > 1 GROUP BY patent_id
UNION ALL SELECT 'label_names_nothing', patent_id, CAST(sum(n) AS BIGINT), array_to_string(list_transform(list_sort(list((-n, assay_name)))[1:6], lambda x: x[2]), '; ') FROM (SELECT patent_id, assay_name, count(*) AS n FROM u WHERE usable AND len(list_filter(regexp_split_to_array(lower(assay_name), '[^a-z0-9_]+'), lambda w: regexp_matches(w, '^[a-z][a-z0-9]') AND NOT list_contains({audit.STOP_WORDS!r}, w))) = 0 GROUP BY ALL) GROUP BY patent_id HAVING sum(n) >= 5)"""


@query(f'WITH {_FLAGS} SELECT "check", patent_id, rows_at_stake, detail FROM f')
def q_audit_union(spark: SparkSession, d: str) -> DataFrame:
    """All record audits with one flag schema."""
    return audit.audit(table(spark, d, "assay_records"))


@query(
    f"""WITH {_CELLS}, r AS (SELECT patent_id, table_uid, row_ix, bool_or(chemistry_id IS NOT NULL) AS drawn, bool_or(cell_ix < 2 AND regexp_matches({_bt("text")}, '^(?:[A-Za-z]{{1,4}}-?)?[0-9]{{1,4}}[A-Za-z]{{0,2}}$')) AS numbered FROM cells WHERE section = 'body' GROUP BY ALL)
SELECT 'drawn_but_unnumbered' AS "check", patent_id, count(*) AS rows_at_stake, CAST(table_uid AS VARCHAR) AS detail FROM r WHERE drawn AND NOT numbered GROUP BY patent_id, table_uid HAVING count(*) >= 3"""
)
def q_audit_drawn(spark: SparkSession, d: str) -> DataFrame:
    return audit.drawn_but_unnumbered(_flat(spark, d))


@query(
    f"""WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS}, g AS (SELECT table_uid, tgroup_ix, count(*) FILTER (kind = 'cid') AS ids, count(*) FILTER (kind = 'assay') AS assays FROM columns_ GROUP BY ALL)
SELECT 'columns_not_grouped' AS "check", patent_id, assays AS rows_at_stake, table_uid || '/' || tgroup_ix AS detail FROM g JOIN one USING (table_uid, tgroup_ix) WHERE ids >= 2 AND assays > 0"""
)
def q_audit_ungrouped(spark: SparkSession, d: str) -> DataFrame:
    cells = _flat(spark, d)
    columns = extract.classify_columns(cells).join(cells.select("patent_id", *extract.KEY).distinct(), extract.KEY)
    return audit.columns_not_grouped(columns)


@query(
    f"""WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS}, {_RECORDS}, s AS (SELECT table_uid, count(*) AS shaped FROM cells WHERE section = 'body' AND {_SHAPE.format(t=_bt("text"))} IN ('num', 'bin') GROUP BY ALL),
r AS (SELECT table_uid, count(*) FILTER (cid IS NOT NULL) AS usable FROM recs WHERE value_numeric IS NOT NULL OR letter_grade IS NOT NULL GROUP BY ALL), j AS (SELECT table_uid, shaped, coalesce(usable, 0) AS usable FROM s LEFT JOIN r USING (table_uid) WHERE shaped >= 10)
SELECT table_uid, shaped, usable, round(usable / shaped, 6) AS ratio FROM j WHERE usable / shaped < 0.5 OR shaped - usable >= 10"""
)
def q_yield_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Tables whose measurement-shaped cells yield few usable records."""
    recs = extract.records(table(spark, d, "table_objects")).withColumn("usable", F.col("cid").isNotNull())
    return audit.usable_yield(_flat(spark, d), recs).withColumn("ratio", F.round("ratio", 6))


@query(
    f"""WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS}, {_RECORDS}, s AS (SELECT table_uid, tgroup_ix, col, count(*) AS stated FROM cells WHERE section = 'body' AND lower({_bt("text")}) NOT IN {tuple(fn.NULL_MARKERS)!r} GROUP BY ALL),
r AS (SELECT table_uid, tgroup_ix, col, count(*) AS n_records FROM recs WHERE value_numeric IS NOT NULL OR letter_grade IS NOT NULL GROUP BY ALL),
j AS (SELECT k.table_uid, k.tgroup_ix, k.col, coalesce(stated, 0) AS stated, coalesce(n_records, 0) AS n_records FROM columns_ k LEFT JOIN s USING (table_uid, tgroup_ix, col) LEFT JOIN r USING (table_uid, tgroup_ix, col) WHERE kind = 'assay')
SELECT table_uid, tgroup_ix, CAST(col AS INTEGER) AS col, stated FROM (SELECT *, max(n_records) OVER (PARTITION BY table_uid, tgroup_ix) AS alive FROM j) WHERE n_records = 0 AND stated >= 5 AND alive > 0"""
)
def q_dead_columns(spark: SparkSession, d: str) -> DataFrame:
    cells = _flat(spark, d)
    out = audit.dead_columns(cells, extract.classify_columns(cells), extract.records(table(spark, d, "table_objects")), extract.KEY)
    return out.select(*extract.KEY, "col", "stated")


@query(f"WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS}, n AS (SELECT *, count(*) OVER (PARTITION BY table_uid, tgroup_ix, header) AS n FROM columns_ WHERE kind = 'assay' AND header IS NOT NULL) SELECT table_uid, tgroup_ix, CAST(col AS INTEGER) AS col, header, n FROM n WHERE n > 1")
def q_duplicate_labels(spark: SparkSession, d: str) -> DataFrame:
    return audit.duplicate_labels(extract.classify_columns(_flat(spark, d)), extract.KEY).select(*extract.KEY, "col", "header", "n")


@query(
    f"""WITH a AS (SELECT DISTINCT patent_id, cid FROM {_k("compounds")} WHERE length(cid) <= 14), r AS (SELECT DISTINCT patent_id, cid FROM {_k("reader_dump")}), u AS (SELECT * FROM a WHERE (patent_id, cid) NOT IN (SELECT patent_id, cid FROM r)),
s AS (SELECT patent_id, regexp_replace(regexp_replace(cid, '[A-Za-z]', 'A', 'g'), '[0-9]+', '9', 'g') AS shape, count(*) AS k FROM u GROUP BY ALL), t AS (SELECT *, row_number() OVER (PARTITION BY patent_id ORDER BY k DESC, shape) AS rn FROM s),
p AS (SELECT patent_id, CAST(sum(k) AS BIGINT) AS unread, sum(k) FILTER (rn <= 2) AS top FROM t GROUP BY ALL), n AS (SELECT patent_id, count(*) AS n_read FROM r GROUP BY ALL)
SELECT patent_id, unread, coalesce(n_read, 0) AS n_read FROM p LEFT JOIN n USING (patent_id) WHERE unread >= 3 AND coalesce(n_read, 0) >= unread AND top >= 0.8 * unread"""
)
def q_unread_ids(spark: SparkSession, d: str) -> DataFrame:
    """Patents with compounds of coherent numbering that no record mentions."""
    return audit.coherent_unread_ids(_keyed(spark, d, "compounds"), _keyed(spark, d, "reader_dump"), ["patent_id"])


@query(
    f"""WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_COLUMNS}, {_RECORDS}, {_SIG}, b AS (SELECT table_uid, tgroup_ix, count(DISTINCT row_ix) AS n_rows FROM cells WHERE section = 'body' GROUP BY ALL),
r AS (SELECT table_uid, tgroup_ix, count(*) AS n_records FROM recs WHERE cid IS NOT NULL AND (value_numeric IS NOT NULL OR letter_grade IS NOT NULL) GROUP BY ALL),
j AS (SELECT table_uid, tgroup_ix, signature, n_rows, coalesce(n_records, 0) AS n_records, max(CASE WHEN n_rows >= 5 THEN coalesce(n_records, 0) END) OVER (PARTITION BY signature) AS twin FROM b JOIN sig USING (table_uid, tgroup_ix) LEFT JOIN r USING (table_uid, tgroup_ix))
SELECT table_uid, tgroup_ix, n_rows, twin AS twin_records FROM j WHERE n_records = 0 AND n_rows >= 5 AND twin > 0"""
)
def q_yield_contradictions(spark: SparkSession, d: str) -> DataFrame:
    """Groups without a record though a group of the same layout has some."""
    cells = _flat(spark, d)
    rows = cells.filter("section = 'body'").groupBy(*extract.KEY).agg(F.count_distinct("row_ix").alias("n_rows"))
    recs = extract.records(table(spark, d, "table_objects")).filter("cid is not null").groupBy(*extract.KEY).agg(F.count(F.lit(1)).alias("n_records"))
    blocks = rows.join(extract.layout_signature(cells), extract.KEY).join(recs, extract.KEY, "left").fillna(0, ["n_records"])
    return audit.yield_contradictions(blocks).select(*extract.KEY, "n_rows", "twin_records")


@query(
    f"""WITH a AS (SELECT DISTINCT patent_id, cid FROM {_k("reader_dump")}), s AS {_k("structures")}, b AS (SELECT patent_id, cid, min(CASE WHEN inchikey IS NOT NULL THEN 0 WHEN source = 'image' THEN 1 ELSE 2 END) AS p FROM s GROUP BY ALL)
SELECT CASE p WHEN 0 THEN 'resolved' WHEN 1 THEN 'drawn' WHEN 2 THEN 'named' ELSE 'none' END AS status, count(*) AS n FROM a LEFT JOIN b USING (patent_id, cid) GROUP BY ALL"""
)
def q_partition_accounting(spark: SparkSession, d: str) -> DataFrame:
    """Every assayed compound in exactly one status bucket."""
    s = _keyed(spark, d, "structures")
    buckets = [("resolved", s.filter("inchikey is not null")), ("drawn", s.filter("source = 'image'")), ("named", s)]
    out = identity.partition_accounting(_keyed(spark, d, "reader_dump"), buckets, ["patent_id", "cid"], "none")
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH p AS (SELECT event_id, value, sum(value) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM events WHERE event_type = 'purchase')
SELECT event_id, round(total, 4) AS total, len(list_filter([1000.0, 10000.0, 50000.0, 100000.0], lambda t: total >= t AND total - value < t)) AS n_crossed FROM p"""
)
def q_running_spend(spark: SparkSession, d: str) -> DataFrame:
    """Running total of purchases and the thresholds each crosses; totals run per day in parallel."""
    p = table(spark, d, "events", "event_id", "ts", "event_type", "value").filter("event_type = 'purchase'").withColumn("day", F.to_date("ts"))
    out = rules.running_spend(p, ["ts", "event_id"], "value", [1000, 10000, 50000, 100000], bucket="day")
    return out.select("event_id", F.round("total", 4).alias("total"), F.size("crossed").cast("long").alias("n_crossed"))


@query("WITH c AS (SELECT sha256(concat_ws(chr(31), coalesce(lang, ''), coalesce(text, ''))) AS k, row_number() OVER (PARTITION BY sha256(concat_ws(chr(31), coalesce(lang, ''), coalesce(text, ''))) ORDER BY published_at, doc_id) > 1 AS hit FROM documents) SELECT hit, count(*) AS n FROM c GROUP BY ALL")
def q_cache_hits(spark: SparkSession, d: str) -> DataFrame:
    """Content-addressed cache over texts: hits are texts seen before."""
    c = rules.cache_hits(table(spark, d, "documents", "doc_id", "lang", "text", "published_at"), ["lang", "text"], ["published_at", "doc_id"])
    return c.groupBy("hit").agg(F.count(F.lit(1)).alias("n"))


# -- ranking, sets and rules -----------------------------------------------------------------------------------------------------


@query("WITH r AS (SELECT patent_id, structure_id, mass_check, row_number() OVER (PARTITION BY patent_id ORDER BY md5('7:' || structure_id), structure_id) AS rn FROM structures WHERE mass_check IS NOT NULL) SELECT patent_id, structure_id, mass_check FROM r WHERE rn <= 8")
def q_stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    """At most eight weighed structures per patent, in a seeded order."""
    s = table(spark, d, "structures", "patent_id", "structure_id", "mass_check").filter("mass_check is not null")
    return identity.stratified_sample(s, ["patent_id"], "structure_id", 8, 7).select("patent_id", "structure_id", "mass_check")


@query(
    f"""WITH {_CELLS}, {_HEADS}, {_SHAPES}, {_SIG}, sh AS (SELECT coalesce(s.table_uid, h.table_uid) AS table_uid, coalesce(s.tgroup_ix, h.tgroup_ix) AS tgroup_ix, list(coalesce(s.shape, 'empty') ORDER BY coalesce(s.col, h.col)) AS shapes, list(lower(coalesce(h.header, '')) ORDER BY coalesce(s.col, h.col)) AS hs FROM shapes s FULL JOIN heads h ON s.table_uid = h.table_uid AND s.tgroup_ix = h.tgroup_ix AND s.col = h.col GROUP BY 1, 2),
x AS (SELECT signature, bool_or(table_uid % 50 = 0) AS asked, len(any_value(shapes)) AS n_cols, any_value(shapes) AS shapes, list_distinct(list_filter(regexp_split_to_array(array_to_string(any_value(hs), ' '), '[^a-z0-9]+'), lambda w: w <> '')) AS words FROM sig JOIN sh USING (table_uid, tgroup_ix) GROUP BY signature),
f AS (SELECT substr(sha256(signature), 1, 16) AS fingerprint, asked, n_cols, shapes, words FROM x),
p AS (SELECT a.fingerprint AS wanted, b.fingerprint, round(0.6 * len(list_filter(range(1, len(a.shapes) + 1), lambda i: a.shapes[i] = b.shapes[i])) / greatest(len(a.shapes), 1) + 0.4 * CASE WHEN len(list_distinct(list_concat(a.words, b.words))) = 0 THEN 0 ELSE len(list_intersect(a.words, b.words)) / len(list_distinct(list_concat(a.words, b.words))) END, 6) AS score FROM f a JOIN f b ON a.asked AND a.n_cols = b.n_cols AND a.fingerprint <> b.fingerprint)
SELECT wanted, fingerprint, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY score DESC, fingerprint) AS rank FROM p WHERE score > 0.4) WHERE rank <= 3"""
)
def q_topk_similar(spark: SparkSession, d: str) -> DataFrame:
    """The three most similar of all layouts, for the layouts of every table whose number is divisible by 50 (a search with a stated query set)."""
    sig = extract.layout_signature(_flat(spark, d))
    layouts = sig.groupBy("fingerprint", "signature").agg(F.bool_or(F.col("table_uid") % 50 == 0).alias("asked"), F.any_value("shapes").alias("shapes"), F.any_value("words").alias("words")).withColumn("n_cols", F.size("shapes"))
    return rules.similar_layouts(layouts.filter("asked"), layouts)


@query(
    f"""WITH u AS (SELECT *, (CAST({_USABLE} AS INTEGER), CAST(range_lo IS NOT NULL OR range_hi IS NOT NULL AS INTEGER), CAST(value_numeric IS NOT NULL AS INTEGER), CAST(unit IS NOT NULL AS INTEGER)) AS i FROM assay_records),
m AS (SELECT *, max(i) OVER (PARTITION BY patent_id, cid, assay_name, table_id) AS m FROM u)
SELECT DISTINCT patent_id, cid, assay_name, table_id, value_numeric, letter_grade, range_lo, range_hi, unit, qualifier, n_runs FROM m WHERE i = m"""
)
def q_heal_merge(spark: SparkSession, d: str) -> DataFrame:
    """Per compound, assay and table the records that say the most, without repeated facts."""
    return rules.heal_merge(table(spark, d, "assay_records"), ["patent_id", "cid", "assay_name", "table_id"], ["value_numeric", "letter_grade", "range_lo", "range_hi", "unit", "qualifier", "n_runs"])


@query(
    f"""WITH b AS (SELECT DISTINCT patent_id, cid FROM {_k("assay_records")}), h AS (SELECT DISTINCT patent_id, cid FROM {_k("reader_dump")}), l AS (SELECT patent_id, count(*) AS lost FROM (SELECT * FROM b EXCEPT SELECT * FROM h) GROUP BY ALL)
SELECT patent_id, patent_id IN (SELECT patent_id FROM h) AND coalesce(lost, 0) = 0 AS replaced FROM (SELECT DISTINCT patent_id FROM b) LEFT JOIN l USING (patent_id)"""
)
def q_superset_replace(spark: SparkSession, d: str) -> DataFrame:
    """Patents whose dump has all compounds of the extracted records."""
    return rules.superset_replaces(_keyed(spark, d, "assay_records"), _keyed(spark, d, "reader_dump"), "patent_id", "cid")


@query(
    f"""WITH r AS (SELECT DISTINCT patent_id, cid FROM {_k("reader_dump")}), s AS (SELECT DISTINCT patent_id, cid FROM {_k("structures")} WHERE inchikey IS NOT NULL)
SELECT 'unresolved' AS need, count(*) AS n FROM (SELECT * FROM r EXCEPT SELECT * FROM s) UNION ALL SELECT 'unmeasured', count(*) FROM (SELECT * FROM s EXCEPT SELECT * FROM r) UNION ALL SELECT 'both', count(*) FROM (SELECT * FROM r INTERSECT SELECT * FROM s)"""
)
def q_needs(spark: SparkSession, d: str) -> DataFrame:
    """Set differences of measured and resolved compounds."""
    r = _keyed(spark, d, "reader_dump").select("patent_id", "cid").distinct()
    s = _keyed(spark, d, "structures").filter("inchikey is not null").select("patent_id", "cid").distinct()
    count = lambda df, what: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("need"), "n")
    return count(r.subtract(s), "unresolved").unionByName(count(s.subtract(r), "unmeasured")).unionByName(count(r.intersect(s), "both"))


# -- delivery --------------------------------------------------------------------------------------------------------------------


@query(
    f"""WITH s AS (SELECT patent_id, cid, name, inchikey, source FROM (SELECT *, row_number() OVER (PARTITION BY patent_id, cid ORDER BY (inchikey IS NULL), structure_id) AS rn FROM {_k("structures")}) WHERE rn = 1),
r AS (SELECT patent_id, cid, assay_name, {_nm("value_numeric", "unit")} / 1000 AS um, {_metric("assay_name")} AS metric FROM {_k("reader_dump")}),
m AS (SELECT patent_id, cid, count(DISTINCT assay_name) AS n_assays, count(*) AS n_measurements, min(um) AS best_um, array_to_string(list_sort(list(DISTINCT metric) FILTER (metric IS NOT NULL)), ',') AS metrics FROM r GROUP BY ALL)
SELECT coalesce(s.patent_id, m.patent_id) AS patent_id, coalesce(s.cid, m.cid) AS cid, name, inchikey, n_assays, n_measurements, round(best_um, 9) AS best_um, nullif(metrics, '') AS metrics, CASE WHEN inchikey IS NOT NULL THEN 'resolved' WHEN source = 'image' THEN 'drawn' WHEN name IS NOT NULL THEN 'named' ELSE 'measured_only' END AS status
FROM s FULL JOIN m ON s.patent_id = m.patent_id AND s.cid = m.cid"""
)
def q_compounds(spark: SparkSession, d: str) -> DataFrame:
    """One row per compound: best structure, measurements folded, best value, metrics, status."""
    s = identity.best_structure(_keyed(spark, d, "structures"), ["patent_id", "cid"]).select("patent_id", "cid", "name", "inchikey", "source")
    out = deliver.compounds(s, _keyed(spark, d, "reader_dump"), ["patent_id", "cid"])
    return out.select("patent_id", "cid", "name", "inchikey", "n_assays", "n_measurements", F.round("best_um", 9).alias("best_um"), F.array_join("metrics", ",").alias("metrics"), "status")


@query()
def q_nested_assays(spark: SparkSession, d: str) -> DataFrame:
    """The same with the nested assays as null-free JSON (tested against a fixture)."""
    s = identity.best_structure(_keyed(spark, d, "structures"), ["patent_id", "cid"]).select("patent_id", "cid", "name", "inchikey", "source")
    return deliver.compounds(s, _keyed(spark, d, "reader_dump"), ["patent_id", "cid"]).select("patent_id", "cid", "assays_json")


@query("SELECT CASE WHEN mass_check = 'agree' THEN 'confirmed' WHEN mass_check = 'contradict' THEN 'disputed' WHEN inchikey IS NOT NULL THEN 'resolved' WHEN source = 'image' THEN 'drawn' ELSE 'unresolved' END AS trail, count(*) AS n FROM structures GROUP BY ALL")
def q_trails(spark: SparkSession, d: str) -> DataFrame:
    """Structures in mutually exclusive trails."""
    s = table(spark, d, "structures", "mass_check", "inchikey", "source")
    b = [("confirmed", F.col("mass_check") == "agree"), ("disputed", F.col("mass_check") == "contradict"), ("resolved", F.col("inchikey").isNotNull()), ("drawn", F.col("source") == "image")]
    return deliver.trails(s, b, "unresolved").groupBy("trail").agg(F.count(F.lit(1)).alias("n"))


_LOSSES = "l AS (SELECT 'inchikey_resolution_empty' AS loss_type FROM structures WHERE name IS NOT NULL AND inchikey IS NULL UNION ALL SELECT 'mass_contradicts_patent' FROM structures WHERE mass_check = 'contradict' UNION ALL SELECT 'cid_first_unsearchable_cid' FROM reader_dump WHERE cid IS NULL)"


def _losses(spark: SparkSession, d: str) -> DataFrame:
    s, r = table(spark, d, "structures"), table(spark, d, "reader_dump")
    return deliver.losses(
        [
            ("inchikey_resolution_empty", s.filter("name is not null and inchikey is null"), ["name", "smiles"]),
            ("mass_contradicts_patent", s.filter("mass_check = 'contradict'"), ["cid", "name", "mass_delta"]),
            ("cid_first_unsearchable_cid", r.filter("cid is null"), ["assay_name", "table_id"]),
        ]
    )


@query(f"WITH {_LOSSES} SELECT loss_type, count(*) AS n FROM l GROUP BY ALL")
def q_loss_counts(spark: SparkSession, d: str) -> DataFrame:
    return _losses(spark, d).groupBy("loss_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {_LOSSES} SELECT 'rows' AS figure, count(*) AS n FROM reader_dump UNION ALL SELECT 'patents', count(DISTINCT patent_id) FROM reader_dump UNION ALL SELECT 'structures:' || coalesce(source, 'none'), count(*) FROM structures GROUP BY 1 UNION ALL SELECT 'loss:' || loss_type, count(*) FROM l GROUP BY 1"""
)
def q_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Figures of a dump."""
    return deliver.manifest(table(spark, d, "reader_dump"), table(spark, d, "structures"), _losses(spark, d))


@query(
    f"""SELECT o.patent_id, count(DISTINCT o.cid) AS n_compounds, round(min({_nm("value_numeric", "unit")}), 6) AS best_nm, count(*) AS n_records FROM {_k("reader_dump")} o JOIN (SELECT DISTINCT patent_id FROM patents WHERE deleted_at IS NULL) p USING (patent_id) WHERE value_numeric IS NOT NULL GROUP BY ALL"""
)
def q_best_value_per_patent(spark: SparkSession, d: str) -> DataFrame:
    """Usable measurements and the best value of every standing patent (flagship)."""
    r = _keyed(spark, d, "reader_dump").filter("value_numeric is not null").withColumn("nm", fn.to_nm(F.col("value_numeric"), F.col("unit")))
    p = table(spark, d, "patents", "patent_id", "deleted_at").filter("deleted_at is null").select("patent_id").distinct()
    return r.join(p, "patent_id", "left_semi").groupBy("patent_id").agg(F.count_distinct("cid").alias("n_compounds"), F.round(F.min("nm"), 6).alias("best_nm"), F.count(F.lit(1)).alias("n_records"))
