"""DuckDB SQL for the queries of ``problem_queries`` that SQL can state."""

from __future__ import annotations

PLAIN_CID = r"regexp_replace(regexp_replace(lower({c}), '^\s+|\s+$', '', 'g'), '^(example|ex|compound|cmpd|cpd|no)(\.\s*|\s+|$|([^a-z.\s]))', '\3')"
_ATTR = r"regexp_replace(regexp_replace(lower(assay_name), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')"

_P4 = f"""
WITH comp AS (SELECT patent_id AS k0, {PLAIN_CID.format(c="cid")} AS k1, count(*) AS n, count(*) FILTER (deleted_at IS NULL) AS n_live, min(loaded_at) FILTER (deleted_at IS NULL) AS first_live FROM compounds GROUP BY 1, 2),
pat AS (SELECT patent_id AS k0, count(*) AS n, count(*) FILTER (deleted_at IS NULL) AS n_live, min(loaded_at) FILTER (deleted_at IS NULL) AS first_live FROM patents GROUP BY 1),
refs AS (SELECT 'reader_dump' AS src_table, dump_row AS row_id, patent_id, {PLAIN_CID.format(c="cid")} AS k1, loaded_at FROM reader_dump WHERE cid IS NOT NULL
  UNION ALL SELECT 'structures', structure_id, patent_id, {PLAIN_CID.format(c="cid")}, loaded_at FROM structures WHERE cid IS NOT NULL),
v AS (SELECT r.src_table, r.row_id, r.loaded_at, c.n, c.n_live, c.first_live FROM refs r LEFT JOIN comp c ON r.patent_id = c.k0 AND r.k1 = c.k1
  UNION ALL SELECT 'compounds', r.compound_row, r.loaded_at, p.n, p.n_live, p.first_live FROM compounds r LEFT JOIN pat p ON r.patent_id = p.k0),
k AS (SELECT src_table, row_id, loaded_at, CASE WHEN n IS NULL THEN 'missing' WHEN n_live = 0 THEN 'deleted' WHEN first_live > loaded_at THEN 'late' END AS kind FROM v)
"""

_P2 = """
WITH typed AS (SELECT table_uid, tgroup_ix, 'header' AS section, header_rows AS rs FROM table_objects UNION ALL SELECT table_uid, tgroup_ix, 'body', body_rows FROM table_objects),
trow AS (SELECT table_uid, tgroup_ix, section, unnest(range(len(rs))) AS row_ix, rs FROM typed WHERE rs IS NOT NULL),
tcell AS (SELECT table_uid, tgroup_ix, section, row_ix, unnest(range(len(rs[row_ix + 1]))) AS cell_ix, rs[row_ix + 1] AS r FROM trow),
t_all AS (SELECT table_uid, tgroup_ix, section, row_ix, cell_ix, r[cell_ix + 1].colspan AS span FROM tcell),
docs AS (SELECT DISTINCT unnest(list_concat(json_extract(payload, '$.tables[*]'), json_extract(payload, '$.description.sections[*].tables[*]'))) AS t FROM raw_tables),
g AS (SELECT CAST(t ->> '$.table_uid' AS BIGINT) AS table_uid, CASE WHEN json_type(t -> '$.tgroups') = 'ARRAY' THEN json_extract(t, '$.tgroups[*]') ELSE [t -> '$.tgroups'] END AS gs FROM docs),
g1 AS (SELECT table_uid, unnest(range(len(gs))) AS tgroup_ix, gs FROM g),
s AS (SELECT table_uid, tgroup_ix, 'header' AS section, json_extract(gs[tgroup_ix + 1], '$.header_rows[*]') AS rs FROM g1 UNION ALL SELECT table_uid, tgroup_ix, 'body', json_extract(gs[tgroup_ix + 1], '$.body_rows[*]') FROM g1),
r AS (SELECT table_uid, tgroup_ix, section, unnest(range(len(rs))) AS row_ix, rs FROM s),
c AS (SELECT table_uid, tgroup_ix, section, row_ix, CASE WHEN json_type(rs[row_ix + 1]) = 'ARRAY' THEN json_extract(rs[row_ix + 1], '$[*]') ELSE json_extract(rs[row_ix + 1], '$.cells[*]') END AS cs FROM r),
c1 AS (SELECT table_uid, tgroup_ix, section, row_ix, unnest(range(len(cs))) AS cell_ix, cs FROM c),
r_all AS (SELECT table_uid, tgroup_ix, section, row_ix, cell_ix, CASE WHEN json_type(cs[cell_ix + 1]) = 'OBJECT' THEN greatest(coalesce(TRY_CAST(cs[cell_ix + 1] ->> '$.colspan' AS INTEGER), 1),
  coalesce(CAST(substr(cs[cell_ix + 1] ->> '$.nameend', 2) AS INTEGER) - CAST(substr(cs[cell_ix + 1] ->> '$.namest', 2) AS INTEGER) + 1, 1)) ELSE 1 END AS span FROM c1)
SELECT DISTINCT table_uid, CAST(tgroup_ix AS INTEGER) AS tgroup_ix, section, CAST(row_ix AS INTEGER) AS row_ix, CAST(cell_ix AS INTEGER) AS cell_ix
FROM (SELECT * FROM t_all UNION ALL SELECT * FROM r_all) WHERE span > 1
"""

# the parts of _P2 up to its flat cells, for the other entities
_P2_PARTS = _P2[: _P2.index("t_all AS")]
_P2_RAW = _P2[_P2.index("docs AS") : _P2.index("r_all AS")].rstrip().rstrip(",")
_P2_ROWS = _P2_PARTS + _P2_RAW + """
SELECT table_uid, CAST(tgroup_ix AS INTEGER) AS tgroup_ix, section, CAST(row_ix AS INTEGER) AS row_ix FROM trow UNION SELECT table_uid, CAST(tgroup_ix AS INTEGER), section, CAST(row_ix AS INTEGER) FROM r"""
_P2_GROUPS = _P2_PARTS + _P2_RAW + """
SELECT table_uid, tgroup_ix, n_cols FROM table_objects UNION SELECT table_uid, CAST(tgroup_ix AS INTEGER), TRY_CAST(gs[tgroup_ix + 1] ->> '$.n_cols' AS INTEGER) FROM g1"""
_P2_TABLES = _P2_PARTS + _P2_RAW + """
SELECT table_uid, table_id, caption FROM table_objects UNION SELECT CAST(t ->> '$.table_uid' AS BIGINT), t ->> '$.table_id', CASE WHEN json_type(t -> '$.caption') = 'OBJECT' THEN t ->> '$.caption.text' ELSE t ->> '$.caption' END FROM docs"""
_P2_CELLS = _P2_PARTS + _P2_RAW + """,
tc AS (SELECT table_uid, tgroup_ix, section, row_ix, cell_ix, r[cell_ix + 1] AS c FROM tcell), rc AS (SELECT table_uid, tgroup_ix, section, row_ix, cell_ix, cs[cell_ix + 1] AS c, json_type(cs[cell_ix + 1]) = 'OBJECT' AS o FROM c1)
SELECT table_uid, tgroup_ix, section, CAST(row_ix AS INTEGER) AS row_ix, CAST(cell_ix AS INTEGER) AS cell_ix, c.text AS text, greatest(1, coalesce(c.colspan, 1)) AS colspan, nullif(c.col_start, -1) AS col_start, c.chemistry_id AS chemistry_id FROM tc
UNION SELECT table_uid, CAST(tgroup_ix AS INTEGER), section, CAST(row_ix AS INTEGER), CAST(cell_ix AS INTEGER), CASE WHEN o THEN c ->> '$.text' ELSE c ->> '$' END,
  CASE WHEN o THEN greatest(coalesce(TRY_CAST(c ->> '$.colspan' AS INTEGER), 1), coalesce(CAST(substr(c ->> '$.nameend', 2) AS INTEGER) - CAST(substr(c ->> '$.namest', 2) AS INTEGER) + 1, 1)) ELSE 1 END,
  CASE WHEN o THEN TRY_CAST(c ->> '$.col_start' AS INTEGER) END, CASE WHEN o THEN coalesce(c ->> '$.chemistry.id', c ->> '$.chemistry_id') END FROM rc"""

_UNIT = r"""regexp_replace(translate(u, 'µμМΜｎＭｍｏｌＬ／∕оοсрхкеаｐｕｃｆһ％ｒｉａｔｅ', 'uuMMnMmolL//oocpxkeapucfh%riate'), '[\s\x{00A0}\x{00AD}\x{200B}-\x{200F}\x{2000}-\x{200A}\x{202F}\x{2060}\x{FEFF}]+', '', 'g')"""
_STATED = r"(?:[x×]?10\^?-\d+ ?(?:mol/[Ll]|M)|[numpfµμ]?mol/m?[Ll]|(?:nano|micro|milli|pico|femto)?molar|mcM|[numpfµμ]?M|p(?:IC50|EC50|Ki|Kd))"
_P5 = rf"""
WITH s AS (SELECT record_id, value_numeric AS v, unit, coalesce(unit,
   nullif(CASE WHEN regexp_matches(value_text, '^[<>~≥≤]?[\d.,]+x10\^[+-]?\d+') THEN regexp_extract(value_text, '^[<>~≥≤]?[\d.,]+x10\^[+-]?\d+ ?({_STATED})(?:[^A-Za-z]|$)', 1)
     WHEN regexp_matches(value_text, '10\^-\d+ M') THEN regexp_extract(value_text, '(10\^-\d+ M)', 1)
     ELSE regexp_extract(value_text, '^[<>~≥≤]?-?[\d.,]+(?:[eE][-+]?\d+)? ?({_STATED})(?:[^A-Za-z]|$)', 1) END, ''),
   nullif(regexp_extract(column_header, '(?:[\(\[]|, | in )({_STATED})[\)\]]?$', 1), ''),
   nullif(regexp_extract(context_text, '(?:\(| in | as )({_STATED})(?:[^A-Za-z0-9]|$)', 1), '')) AS u FROM assay_records WHERE value_numeric IS NOT NULL),
f AS (SELECT record_id, v, unit, {_UNIT} AS u FROM s),
e AS (SELECT record_id, v, unit, CASE
   WHEN u IN ('M','mol/L','mol/l','molar') THEN 12
   WHEN u IN ('mM','mmol/L','mmol/l','millimolar','umol/mL') THEN 9
   WHEN u IN ('uM','um','mcM','umol/L','umol/l','micromolar','nmol/mL','10^-6M','x10-6mol/L','x10-6M') THEN 6
   WHEN u IN ('nM','nm','nmol/L','nmol/l','nanomolar','nmol·L-1','pmol/mL','10^-9M','x10-9M','x10-9mol/L') THEN 3
   WHEN u IN ('pM','pmol/L','pmol/l','picomolar','fmol/mL') THEN 0 END AS p, u IN ('pIC50','pEC50','pKi','pKd') AS logged FROM f)
SELECT record_id, CAST(round(CASE WHEN logged THEN 10 ** (12 - v) ELSE v * 10 ** p END) AS BIGINT) AS value_pm FROM e WHERE (logged OR p IS NOT NULL) AND unit IS DISTINCT FROM 'nM'
"""

# all records, molar ones by the powers above and the other dimensions by their own
_P5_ALL = _P5[: _P5.index("SELECT record_id, CAST(round")].replace(" WHERE value_numeric IS NOT NULL", "").replace("e AS (SELECT record_id, v, unit,", "e AS (SELECT record_id, v, u,") + """
SELECT record_id, CASE WHEN logged OR p IS NOT NULL THEN 'pmol/L' WHEN u IN ('ng/mL', 'ug/mL') THEN 'ng/mL' WHEN u IN ('%', 'percent') THEN '%' WHEN u IN ('h', 'min') THEN 's' WHEN u = 'mg/kg' THEN 'mg/kg' WHEN u = 'mg/m²' THEN 'mg/m2'
  WHEN u = 'uL/min/mg' THEN u WHEN u IN ('fold', 'ratio') THEN 'fold' WHEN u = 'cpm' THEN u END AS canonical_unit,
  round(CASE WHEN logged THEN 10 ** (12 - v) WHEN p IS NOT NULL THEN v * 10 ** p WHEN u = 'ug/mL' THEN v * 1000 WHEN u = 'h' THEN v * 3600 WHEN u = 'min' THEN v * 60 WHEN u IN ('ng/mL', '%', 'percent', 'mg/kg', 'mg/m²', 'uL/min/mg', 'fold', 'ratio', 'cpm') THEN v END, 3) AS value FROM e
"""

_P6 = f"""
WITH r AS (SELECT patent_id, {PLAIN_CID.format(c="cid")} AS cid, {_ATTR} AS assay_name, {{'v': value_numeric, 'q': qualifier, 'g': letter_grade, 'lo': range_lo, 'hi': range_hi}} AS f FROM reader_dump WHERE cid IS NOT NULL)
SELECT patent_id, cid, assay_name FROM (SELECT DISTINCT patent_id, cid, assay_name, f FROM r) GROUP BY ALL HAVING count(*) > 1
"""

_P6_CELLS = f"""
WITH r AS (SELECT patent_id, {PLAIN_CID.format(c="cid")} AS cid, {_ATTR} AS assay_name, {{'value_numeric': value_numeric, 'qualifier': qualifier, 'letter_grade': letter_grade, 'range_lo': range_lo, 'range_hi': range_hi}} AS f, loaded_at, dump_row FROM reader_dump WHERE cid IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY patent_id, cid, assay_name ORDER BY loaded_at DESC NULLS LAST, dump_row DESC) AS rn FROM r),
c AS (SELECT patent_id, cid, assay_name, count(DISTINCT f) > 1 AS conflict FROM r GROUP BY ALL)
SELECT n.patent_id, n.cid, n.assay_name, f.value_numeric, f.qualifier, f.letter_grade, f.range_lo, f.range_hi, conflict FROM n JOIN c ON n.patent_id IS NOT DISTINCT FROM c.patent_id AND n.cid = c.cid AND n.assay_name IS NOT DISTINCT FROM c.assay_name WHERE rn = 1
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _P2,
        "p2_cells": _P2_CELLS,
        "p2_rows": _P2_ROWS,
        "p2_groups": _P2_GROUPS,
        "p2_tables": _P2_TABLES,
        "p2_rejects": """SELECT raw_id, CASE WHEN payload IS NULL THEN 'null' WHEN NOT json_valid(payload) THEN 'not json' ELSE 'no table' END AS reason, CASE WHEN NOT json_valid(payload) THEN payload END AS payload
FROM raw_tables WHERE payload IS NULL OR NOT json_valid(payload) OR payload NOT LIKE '%"table_uid"%'""",
        "p4_found": _P4 + "SELECT src_table, row_id, kind FROM k WHERE kind IS NOT NULL",
        "p4_report": _P4 + "SELECT src_table, strftime(loaded_at, '%Y-%m') AS month, kind, count(*) AS n_orphans FROM k WHERE kind IS NOT NULL GROUP BY ALL",
        "p5_found": _P5,
        "p5_converted": _P5_ALL,
        "p6_found": _P6,
        "p6_cells": _P6_CELLS,
    }
