"""Queries over small fixtures whose results are written out by hand, for operators that the tables hardly exercise or that SQL cannot state.

The SQL of each is its expected rows, literally. Inputs hold the odd cases: nulls, ties, repeats, rows that must give nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.functions import cells as fn
from assayloom.functions import texts
from assayloom.operators import audit, drawings, extract, gaps, identity, layout, legend, names, rules, views
from assayloom.plans import pipeline
from assayloom.plans.reference_queries import _flat, query
from assayloom.sources import documents as src

_SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "long": "BIGINT", "boolean": "BOOLEAN"}


def expected(schema: str, rows: Iterable[tuple]) -> str:
    """Rows as SQL literals under a Spark schema of simple types."""
    fields = [x.split() for x in schema.split(", ")]

    def one(v: object) -> str:
        return "NULL" if v is None else ("true" if v else "false") if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    values = ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)
    return "SELECT " + ", ".join(f'CAST("{n}" AS {_SQL_TYPES[t]}) AS "{n}"' for n, t in fields) + f" FROM (VALUES {values}) AS v(" + ", ".join(f'"{n}"' for n, _ in fields) + ")"


# -- cells -----------------------------------------------------------------------------------------------------------------------

_CIDS = [("Example 007", "7"), ("Cpd. No. 7", "7"), ("Compound No. 7", "7"), ("Example No. 12", "12"), ("Compounds 5", "5"), ("Example12", "12"), ("No. I-3", "I-3"), ("Expt-1", "Expt-1"), ("100AA", "100AA"), ("10-1", "10-1"), ("I-0020", "I-20"), ("α-6-mPEG1-O-Codeine", "α-6-mPEG1-O-Codeine"), ("y" * 41, ""), ("", "")]


@query(expected("case_no int, cid string", [(i, c) for i, (_, c) in enumerate(_CIDS)]))
def q_case_ids(spark: SparkSession, d: str) -> DataFrame:
    """Compound ids in every spelling."""
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_CIDS)], "case_no int, t string")
    return df.select("case_no", fn.normalize_cid(F.col("t")).alias("cid"))


# cell -> (value, qualifier, unit, replicates, grade, note)
_CELLS = [
    ("12.5", (12.5, None, None, None, None, None)), ("1,234", (1234.0, None, None, None, None, None)), (".5", (0.5, None, None, None, None, None)), ("6.49E−03", (0.00649, None, None, None, None, None)), (">10 nM", (10.0, ">", "nM", None, None, None)),
    ("<= 3 µM", (3.0, "≤", "µM", None, None, None)), ("≧1.0e−005", (1e-05, "≥", None, None, None, None)), ("~5%", (5.0, "~", "%", None, None, None)), ("5 (3)", (5.0, None, None, 3, None, None)), ("24 (*)", (24.0, None, None, None, None, "*")), ("1194**", (1194.0, None, None, None, None, None)),
    ("1680 ± 150 (n = 4)", (1680.0, None, None, 4, None, None)), ("0.00275 ± 0.00046, n = 3", (0.00275, None, None, 3, None, None)), ("< 5 ± 1 nM", (5.0, "<", "nM", None, None, None)), ("3.0 ± 1.0*", (3.0, None, None, None, None, None)),
    ("B", (None, None, None, None, "B", None)), ("+++", (None, None, None, None, "+++", None)), ("**", (None, None, None, None, "**", None)), ("##", (None, None, None, None, "##", None)), ("n.d.", (None,) * 6), ("—", (None,) * 6), ("see Table 4", (None,) * 6), ("", (None,) * 6),
]
_VALUE = "case_no int, value_numeric double, qualifier string, unit string, n_runs int, letter_grade string, annotation string"


@query(expected(_VALUE, [(i, *v) for i, (_, v) in enumerate(_CELLS)]))
def q_case_values(spark: SparkSession, d: str) -> DataFrame:
    """The value cascade on cells of every kind."""
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_CELLS)], "case_no int, t string")
    return df.select("case_no", fn.parse_value(F.col("t")).alias("v")).select("case_no", "v.*")


_AXES = [
    ("Rat Vagudor channel 3 IC50 at 10 uM", ("IC50", "Vagudor channel 3", "10 uM", 10.0, "rat")), ("ABHD6 % Inh 1 uM (mouse)", ("% inhibition", "ABHD6", "1 uM", 1.0, "mouse")), ("MAGL IC50 (human)", ("IC50", "MAGL", None, None, "human")), ("PI3K alpha IC50 (nM)", ("IC50", "PI3K alpha", None, None, None)),
    ("PARG_EC50_ENZYME", ("EC50", "PARG", None, None, None)), ("BACE1 IC20", ("IC20", "BACE1", None, None, None)), ("X % inh 20 mg/kg, p.o.", ("% inhibition", "X", "20 mg/kg, p.o.", None, None)), ("Y IC90 at 1, 10 uM", ("IC90", "Y", "1, 10 uM", None, None)), ("plain", (None, "plain", None, None, None)), ("", (None, None, None, None, None)),
]


@query(expected("case_no int, metric string, target string, dose string, dose_um double, species string", [(i, *a) for i, (_, a) in enumerate(_AXES)]))
def q_case_axes(spark: SparkSession, d: str) -> DataFrame:
    """Headings taken apart: the target is what stands before the metric."""
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_AXES)], "case_no int, t string")
    return df.select("case_no", fn.axes(F.col("t")).alias("a")).select("case_no", "a.*")


_UNITS = [("IC50 (nM)", "nM"), ("IC50, μM", "uM"), ("Ki in mol/L", "M"), ("10^-9 M", "nM"), ("% Inh at 1 μM", "%"), ("IC50 [M]", "M"), ("IC50 in micromolar, not nM", "uM"), ("M series", None), ("", None)]


@query(expected("case_no int, unit string", [(i, u) for i, (_, u) in enumerate(_UNITS)]))
def q_case_units(spark: SparkSession, d: str) -> DataFrame:
    """The first unit of a heading."""
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_UNITS)], "case_no int, t string")
    return df.select("case_no", fn.unit_from(F.col("t")).alias("unit"))


# -- tables ----------------------------------------------------------------------------------------------------------------------

CELLS = "table_uid long, patent_id string, tgroup_ix int, section string, row_ix int, cell_ix int, text string, colspan long, col int, chemistry_id string"


def cells_of(uid: int, rows: list, headers: list = (), patent: str = "P", group: int = 0, drawn: tuple = ()) -> list[tuple]:
    """Cells of a table group; ``drawn`` lists the (section, row, cell) that hold a drawing."""
    out = []
    for section, lines in (("header", headers), ("body", rows)):
        for i, line in enumerate(lines):
            out += [(uid, patent, group, section, i, k, t, 1, k, f"C{uid}-{section[0]}{i}" if (section, i, k) in drawn else None) for k, t in enumerate(line)]
    return out


VIEW_TABLES = [
    *cells_of(1, [["1", "5.1", "x"], ["", "7", ""], ["2", "> 9 nM (3)", ""], ["", "8", ""]], [["Compound", "Vagudor IC50 (nM)", "Note"]], drawn=(("body", 3, 2),)),
    *cells_of(2, [["3", "6.5", "y"], ["4", "B", ""]]),  # no header: that of table 1 fits
    *cells_of(3, [["text", "words", "more"]]),  # nothing to inherit onto
    *cells_of(4, [["Example", "Ki (nM)"], ["7", "1.5"], ["8", "2.5"]], patent="Q"),  # the header is the first body row
    *cells_of(5, [["a", "5", "0.5"], ["b", "6", "0.6"]], [["Cpd No.", "EC50 (uM)"]], patent="R"),  # the header stands one column to the left
    *cells_of(6, [["1", "5.5", "2", "6.5"], ["3", "7.5", "", ""]], [["No.", "IC50 (nM)", "No.", "IC50 (nM)"]], patent="S"),  # repeated column groups
    *cells_of(7, [["A", "1, 2b, I-3"], ["B", "4, 5"], ["C", "6, 7, 8, 9"]], [["Grade", "IC50 of compounds (nM)"]], patent="T"),  # grades with lists of ids
    *cells_of(8, [[x, str(i) if x == "Compound" else f"{i}.5" if x == "IC50 (nM)" else "z"] for i in range(10) for x in ("Compound", "MW", "IC50 (nM)", "Note")], patent="U"),  # label and value rows
    (9, None, None, "body", 0, 0, None, None, None, None),
    *cells_of(10, [["1", "A", "B", "5.5", "3", "1.5, 2.5"], ["2", "+", "G", "6.5", "(4)", "n.d., 3.5"], ["3", "B", "N", "7.5", "x", "9"]], [["Ex.", "FP", "Way", "pIC50", "n", "MAGL Ki, FAAH Ki"]], patent="V"),
    # grades under a plain header, letters that are no grades, a logarithm, replicates behind it, two assays in one column
]
_IC = "Vagudor IC50 (nM)"
VIEW_RECORDS = [
    *[(1, "flat", c, _IC, v, None) for c, v in (("1", 5.1), ("1", 7.0), ("2", 9.0), (None, 8.0))],  # a row with its own drawing takes no id
    (2, "flat", "3", _IC, 6.5, None), (2, "flat", "4", _IC, None, "B"), (4, "flat", "7", "Ki (nM)", 1.5, None), (4, "flat", "8", "Ki (nM)", 2.5, None), (5, "flat", "5", "EC50 (uM)", 0.5, None), (5, "flat", "6", "EC50 (uM)", 0.6, None),
    *[(6, "flat", c, "IC50 (nM)", v, None) for c, v in (("1", 5.5), ("2", 6.5), ("3", 7.5))],
    *[(7, "inverted", c, "IC50 of compounds (nM)", None, g) for g, ids in (("A", ("1", "2b", "I-3")), ("C", ("6", "7", "8", "9"))) for c in ids],
    *[(10, "flat", c, "FP", None, g) for c, g in (("1", "A"), ("2", "+"), ("3", "B"))], *[(10, "flat", c, "pIC50", v, None) for c, v in (("1", 5.5), ("2", 6.5), ("3", 7.5))],
    (10, "flat", "1", "MAGL Ki", 1.5, None), (10, "flat", "1", "FAAH Ki", 2.5, None), (10, "flat", "2", "FAAH Ki", 3.5, None), (10, "flat", "3", "MAGL Ki, FAAH Ki", 9.0, None),
    *[(8, "vertical", str(i), "IC50 (nM)", i + 0.5, None) for i in range(10)],
]


@query(expected("table_uid long, view string, cid string, assay_name string, value_numeric double, letter_grade string", VIEW_RECORDS))
def q_case_views(spark: SparkSession, d: str) -> DataFrame:
    """Every layout of a table by its best view."""
    return views.extract_all(spark.createDataFrame(VIEW_TABLES, CELLS)).select("table_uid", "view", "cid", "assay_name", "value_numeric", "letter_grade")


@query(expected("cid string, unit string, n_runs int", [("1", "pIC50", 3), ("2", "pIC50", 4), ("3", "pIC50", None)]))
def q_case_replicates(spark: SparkSession, d: str) -> DataFrame:
    """Replicate counts in the column behind the values; what is no count is none. A logarithm is its own unit."""
    cells = spark.createDataFrame([r for r in VIEW_TABLES if r[0] == 10], CELLS)
    return views.extract_all(cells).filter("assay_name = 'pIC50'").select("cid", "unit", "n_runs")


@query()
def q_extract_all(spark: SparkSession, d: str) -> DataFrame:
    """The whole extraction over all table objects (q_case_views holds its cases)."""
    return views.extract_all(_flat(spark, d)).select("table_uid", "tgroup_ix", "row_ix", "col", "view", "cid", "assay_name", "value_numeric", "qualifier", "unit", "n_runs", "letter_grade")


_LONG = "2-(4-chloro-phenyl)-3-[1-methyl-ethyl]-amide"
_LEFT = [["1", "5.5", "nd", ""], ["2", "6.5", "x5", ""], ["3", "7.5", "y", ""], ["4", "8.5", "z", ""], ["5", "9.5", "w", ""], ["6", "1.5", "v", ""]]
_DETECTED = [
    *cells_of(11, _LEFT, [["Compound", "IC50 (nM)", "EC50 (nM)", "Note"]]),  # the third column is read nowhere
    *cells_of(12, [["", _LONG, "5.5"]] * 4, [["", "Name", "Ki (nM)"]], drawn=tuple(("body", i, 0) for i in range(4))),  # drawn, no number
    *cells_of(13, [["1", "5.5", "2", "6.5"]], [["No.", "IC50 (nM)", "No.", "EC50 (nM)"]]),  # two id columns with different assays
    *cells_of(14, [[_LONG, "x"]] * 3),  # chemical names without a header
    *cells_of(15, [["1"]], [["Head", str(i)] for i in range(6)]),  # more header rows than body rows
    *cells_of(16, [["1", "Me"], ["2", "Et"]], [["No.", "R1"]], drawn=(("header", 0, 1), ("body", 1, 1))),  # a scaffold in the header
]


@query(
    expected(
        "detector string, table_uid long, detail string",
        [("dead_column", 11, "2"), ("drawn", 12, "4"), ("ungrouped", 13, "2"), ("name_column", 12, "1:header"), ("name_column", 14, "0:shape"), ("assembly", 15, "6/1"), ("scaffold", 16, "C16-b1 on C16-h0"), ("substituent_id", 16, "1"), ("substituent_id", 16, "2"), ("opens_with_id", 11, "6"), ("opens_with_id", 13, "1"), ("opens_with_id", 15, "1"), ("opens_with_id", 16, "2")],
    )
)
def q_case_detectors(spark: SparkSession, d: str) -> DataFrame:
    """Detectors over table groups, each with a table it must find and others it must not."""
    cells = spark.createDataFrame(_DETECTED, CELLS)
    columns = extract.classify_columns(cells)
    profile = layout.row_profile(cells)
    placed = columns.withColumn("patent_id", F.lit("P"))
    show = lambda df, name, detail: df.select(F.lit(name).alias("detector"), "table_uid", detail.cast("string").alias("detail"))
    parts = [
        show(audit.dead_columns(cells, columns, extract.records_of_cells(cells), extract.KEY), "dead_column", F.col("col")),
        show(audit.drawn_but_unnumbered(cells).withColumn("table_uid", F.col("detail").cast("long")), "drawn", F.col("rows_at_stake")),
        show(audit.columns_not_grouped(placed).withColumn("table_uid", F.substring_index("detail", "/", 1).cast("long")), "ungrouped", F.col("rows_at_stake")),
        show(layout.name_columns(cells, columns), "name_column", F.concat_ws(":", "col", "signal")),
        show(layout.column_period(columns), "period", F.col("period")),
        show(layout.assembly_fidelity(profile), "assembly", F.concat_ws("/", "n_header", "n_body")),
        show(drawings.header_scaffolds(cells), "scaffold", F.concat_ws(" on ", "chemistry_id", "scaffold")),
        show(drawings.substituent_ids(cells, columns), "substituent_id", F.col("cid")),
        show(layout.opens_with_id(cells, ["Ki"]).filter("opens and section = 'body'").groupBy("table_uid").agg(F.count(F.lit(1)).alias("n")), "opens_with_id", F.col("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(expected("patent_id string, unread long, n_read long", [("P", 4, 5)]))
def q_case_unread(spark: SparkSession, d: str) -> DataFrame:
    """Ids of one numbering that no record mentions: in P four of nine; Q has too few, R more unread than read, S no common shape."""
    rows = {"P": ([str(i) for i in range(1, 10)], ["1", "2", "3", "4", "5"]), "Q": (["1", "2", "3"], ["1"]), "R": ([str(i) for i in range(9)], ["1", "2"]), "S": (["1", "a-b", "x1y2", "9", "q", "I-1"], ["9", "8", "7", "6", "5", "4"])}
    every = spark.createDataFrame([(p, c) for p, (a, _) in rows.items() for c in [*a, "long" * 5, None]], "patent_id string, cid string")
    read = spark.createDataFrame([(p, c) for p, (_, r) in rows.items() for c in [*r, *r[:1]]], "patent_id string, cid string")
    return audit.coherent_unread_ids(every, read, ["patent_id"]).select("patent_id", "unread", "n_read")


@query(expected("table_uid long, twin_records long", [(2, 7)]))
def q_case_contradictions(spark: SparkSession, d: str) -> DataFrame:
    """A block without a record whose layout gives records elsewhere; small blocks and other layouts do not count."""
    blocks = [(1, "f", 9, 7), (2, "f", 6, 0), (3, "f", 4, 0), (4, "g", 9, 0), (5, None, 9, 0), (6, "h", 4, 3), (7, "h", 9, 0)]
    df = spark.createDataFrame(blocks, "table_uid long, fingerprint string, n_rows long, n_records long")
    return audit.yield_contradictions(df).select("table_uid", "twin_records")


_BROKEN = '<x><description><tables id="T"><table><tgroup cols="2"><tbody><entry>stray</entry><row><entry>1</entry><entry/></row></tbody></tgroup></table></tables></description></x>'
_FINE = _BROKEN.replace("<entry>stray</entry>", "")


@query(expected("patent_id string, source_cells long, parsed_cells long, source_rows long, parsed_rows long", [("broken", 3, 2, 1, 1)]))
def q_case_fidelity(spark: SparkSession, d: str) -> DataFrame:
    """A document with a cell outside any row is told; sound, empty and missing ones are not."""
    docs = spark.createDataFrame([("broken", _BROKEN), ("fine", _FINE), ("empty", ""), ("none", None)], "patent_id string, xml string")
    out = src.parse_fidelity(docs)
    return out.select("patent_id", *[F.col(c).cast("long").alias(c) for c in ("source_cells", "parsed_cells", "source_rows", "parsed_rows")])


_FRAGMENTS = [
    *cells_of(51, [], [["", "BTK IC50 (nM)"]], group=0),  # a header stub narrower than the data
    *cells_of(51, [["1", "x", "5.5"], ["2", "y", "6.5"]], [["Cpd", "Note", ""]], group=1),
    *cells_of(51, [["1H NMR 7.2 (s)"]], group=2),  # a note between the rows
    *cells_of(51, [["3", "z", "7.5"]], [["Cpd", "Note", ""]], group=3),  # the header again
    *cells_of(52, [["a b", "1.5"], ["c d", "2.5"]], [["Name", "Ki"]], group=0), *cells_of(52, [["t", "u", "v"]], group=1),  # no ids: the width with most rows
]


@query(
    expected(
        "table_uid long, section string, row_ix int, line string",
        [(51, "header", 0, "2:BTK IC50 (nM)"), (51, "header", 1, "0:Cpd|1:Note|2:"), (51, "body", 0, "0:1|1:x|2:5.5"), (51, "body", 1, "0:2|1:y|2:6.5"), (51, "body", 2, "0:3|1:z|2:7.5"), (52, "header", 0, "0:Name|1:Ki"), (52, "body", 0, "0:a b|1:1.5"), (52, "body", 1, "0:c d|1:2.5")],
    )
)
def q_case_assembled(spark: SparkSession, d: str) -> DataFrame:
    """Tables spread over groups put together: bodies in order, headers once and over the columns they stand above, notes left out."""
    cells = spark.createDataFrame(_FRAGMENTS, CELLS).filter("not (table_uid = 51 and tgroup_ix = 0 and text = '')")
    widths = spark.createDataFrame([(51, 0, [90.0, 60.0]), (51, 1, [40.0, 50.0, 60.0]), (51, 3, [40.0, 50.0, 60.0])], "table_uid long, tgroup_ix int, col_widths array<double>")
    out = views.assembled(cells, widths)
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda x: F.concat_ws(":", x["col"], x["text"])), "|")
    return out.groupBy("table_uid", "section", "row_ix").agg(line.alias("line"))


# -- legends ---------------------------------------------------------------------------------------------------------------------

_LINES = ["DNA-PK (enzymatic):", "A: IC50 < 3 nM", "B: 3 nM ≤ IC50 < 7 nM", "pDNA-PK (cellular):", "A: IC50 < 0.5 μM", "B: gibberish", "Kv11.1 hERG:", "A: Ki > 25 μM", "B: 25 μM ≥ Ki > 15 μM"]
_COLUMNS = ["IC50 pDNA-PK", "IC50 DNA-PK", "Ki [Kv1.11 hERG]", "MS m/z", "IC50"]


@query(
    expected(
        "header string, symbol string, lo double, hi double, unit string",
        [("IC50 pDNA-PK", "A", None, 0.5, "uM"), ("IC50 DNA-PK", "A", None, 3.0, "nM"), ("IC50 DNA-PK", "B", 3.0, 7.0, "nM"), ("Ki [Kv1.11 hERG]", "A", 25.0, None, "uM"), ("Ki [Kv1.11 hERG]", "B", 15.0, 25.0, "uM")],
    )
)
def q_case_sections(spark: SparkSession, d: str) -> DataFrame:
    """A legend with a scale per section, and the columns that each governs; two columns have none."""
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(_LINES)] + [(2, 0, None)], "k int, o int, t string")
    columns = spark.createDataFrame([(1, c) for c in _COLUMNS], "k int, header string")
    sections = legend.sectioned(lines, ["k"], "o", "t")
    return legend.section_of_column(columns, sections, ["k"], "header").join(sections, ["k", "heading"]).select("header", "symbol", "lo", "hi", "unit")


@query(expected("table_uid long, symbol string, lo double, hi double, unit string", [(1, "A", None, 10.0, "nM"), (1, "B", 10.0, 20.0, "nM"), (2, "C", None, 0.5, "ug/mL")]))
def q_case_legend_rows(spark: SparkSession, d: str) -> DataFrame:
    """Legends laid out as tables, symbol first or last, the unit in the rows or the heading."""
    rows = [(1, 0, ["A", "below 10"], "IC50 (nM)"), (1, 1, ["10 to 20 nM", "", "B"], None), (1, 2, ["x", "y"], None), (2, 0, ["≦0.5", "C:"], "MIC (μg/mL"), (3, 0, None, None), (4, 0, ["A", "< 1"], ""), (4, 1, ["A", "< 2"], "")]
    df = spark.createDataFrame(rows, "table_uid long, row_ix int, line array<string>, heading string")
    return legend.of_rows(df, ["table_uid"], "row_ix", "line", "heading")


_DOCUMENT = """<us><description><p>IC50 values are in nM.</p><p>TABLE 1. A: below 10 uM; B: 10 to 100 uM</p>
<tables id="T1"><table><tgroup cols="3"><thead><row><entry>Compound</entry><entry>Vagudor IC50</entry><entry>MW</entry></row></thead>
<tbody><row><entry>1</entry><entry>5.1</entry><entry>300</entry></row><row><entry/><entry>A</entry><entry/></row><row><entry>2</entry><entry>nd</entry><entry>1</entry></row></tbody></tgroup></table></tables>
<p>Further results.</p><tables id="T2"><table><tgroup cols="3"><tbody><row><entry>7</entry><entry>B</entry><entry>200</entry></row><row><entry>8</entry><entry>0.4</entry><entry>210</entry></row></tbody></tgroup>
<tgroup cols="1"><tbody><row><entry>B: 1 to 2 nM</entry></row></tbody></tgroup></table></tables></description></us>"""


@query(
    expected(
        "table_id string, cid string, assay_name string, value_numeric double, letter_grade string, range_lo double, range_hi double, unit string, unit_source string",
        [("T1", "1", "Vagudor IC50", 5.1, None, None, None, "nM", "description"), ("T1", "1", "Vagudor IC50", None, "A", None, 10.0, "uM", "bin_key"), ("T2", "7", "Vagudor IC50", None, "B", 1.0, 2.0, "nM", "bin_key"), ("T2", "8", "Vagudor IC50", 0.4, None, None, None, "nM", "description")],
    )
)
def q_case_dump(spark: SparkSession, d: str) -> DataFrame:
    """Documents to records: a caption's and a table's own legend, an inherited header, a unit from the description."""
    docs = spark.createDataFrame([("P1", _DOCUMENT), ("P2", ""), ("P3", None)], "patent_id string, xml string")
    return pipeline.dump(docs).records.select("table_id", "cid", "assay_name", "value_numeric", "letter_grade", "range_lo", "range_hi", "unit", "unit_source")


# -- names, rules, identity ------------------------------------------------------------------------------------------------------


@query(expected("route string, n long", [("image_and_locant", 2), ("image_only", 1), ("text_only", 2), ("nothing_varies", 1)]))
def q_case_substituents(spark: SparkSession, d: str) -> DataFrame:
    """The route of every row of substituent tables."""
    rows = [(1, 0, "R1", "Me", True), (1, 1, "R1", "Et", True), (1, 0, "R2", "H", True), (1, 1, "R2", "H", True), (2, 0, "R1", "Me", True), (3, 0, "R1", "a", False), (3, 1, "R1", "b", False), (4, 0, "R1", "a", False)]
    df = spark.createDataFrame(rows, "k int, row_ix int, slot string, text string, has_drawing boolean")
    return drawings.substituent_routes(df, ["k"]).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query(expected("slot string, point int, refusal string", [("R1", 4, None), ("R2", None, "slot marked twice"), ("R3", None, "slot not marked")]))
def q_case_slots(spark: SparkSession, d: str) -> DataFrame:
    """Substituent headings led to the scaffold's marks; doubled and missing marks are refused."""
    headings = spark.createDataFrame([(1, "R1"), (1, "R2"), (1, "R3")], "k int, slot string")
    labels = spark.createDataFrame([(1, "r1", 4), (1, "R2", 5), (1, "R2", 6)], "k int, label string, point int")
    return drawings.map_slots(headings, labels, ["k"]).select("slot", "point", "refusal")


@query(expected("rank int, candidate string", enumerate(["3-methyl butanoic acid", "butanoic acid", "acid", "methyl butanoic acid", "3-methylbutanoicacid"])))
def q_case_readings(spark: SparkSession, d: str) -> DataFrame:
    """The readings of a wrapped name in order: as it is, without lead words, from its first boundary on, without blanks; an empty one has none."""
    df = spark.createDataFrame([("3-methyl butanoic acid",), ("",), (None,)], "name string")
    return names.candidates(df, "name").select(F.col("rank").cast("int").alias("rank"), "candidate")


@query(expected("patent_id string, cid string, inchikey string", [("P", "2-methylpyridine", "K1")]))
def q_case_id_names(spark: SparkSession, d: str) -> DataFrame:
    """Unresolved ids that are names themselves."""
    ids = spark.createDataFrame([("P", "1"), ("P", "2-methylpyridine"), ("P", "2-methylpyridine"), ("Q", "pyridine"), (None, "x"), ("P", None)], "patent_id string, cid string")
    done = spark.createDataFrame([("Q", "pyridine")], "patent_id string, cid string")
    known = spark.createDataFrame([("2-methylpyridine", "K1"), ("pyridine", "K2")], "name string, inchikey string")
    return identity.ids_that_are_names(ids, done, ["patent_id", "cid"], known).select("patent_id", "cid", "inchikey")


@query(expected("k int, smiles string", [(1, "new"), (2, "old"), (3, "old"), (4, None)]))
def q_case_supersede(spark: SparkSession, d: str) -> DataFrame:
    """Recognised structures replace those of drawings only, where one was found."""
    rows = spark.createDataFrame([(1, "image", "old"), (2, "table", "old"), (3, "image", "old"), (4, "table", None)], "k int, source string, smiles string")
    found = spark.createDataFrame([(1, "new"), (2, "new"), (3, None)], "k int, smiles string")
    return identity.supersede(rows, found, ["k"], "smiles", F.col("source") == "image").select("k", "smiles")


@query(expected("k int, cid string, value string", [(1, "7", "5.5")]))
def q_case_row_patterns(spark: SparkSession, d: str) -> DataFrame:
    """Row patterns of a library read the rows of their layout; other layouts and rows that do not fit give nothing."""
    rows = spark.createDataFrame([(1, "f", "Compound 7 shows 5.5"), (2, "g", "Compound 8 shows 6.5"), (3, "f", "nothing"), (4, "f", None)], "k int, fingerprint string, text string")
    lib = spark.createDataFrame([("f", r"Compound (?P<cid>\d+) shows (?P<value>[\d.]+)")], "fingerprint string, pattern string")
    return rules.apply_row_patterns(rows, lib, ["k"]).select("k", "cid", "value")


@query(expected("fingerprint string, n long", [("b", 2)]))
def q_case_suppressed(spark: SparkSession, d: str) -> DataFrame:
    """Layouts that a rule calls no assay are left out."""
    blocks = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "fingerprint string")
    lib = spark.createDataFrame([("a", "not_assay"), ("c", "not_assay"), ("c", "not_assay"), ("b", "column_map")], "fingerprint string, kind string")
    return rules.suppress(blocks, lib).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))


# -- gaps ------------------------------------------------------------------------------------------------------------------------


@query(expected("patent_id string, name string, inchikey string", [("P", "a", "KA"), ("P", "f", "KF"), ("Q", "b", "KB")]))
def q_case_new_structures(spark: SparkSession, d: str) -> DataFrame:
    """Grounded annotations that add a structure: held keys drop out before and after resolving, repeats within the batch too."""
    blocks = [("P", 0, "a", "C", " ka "), ("P", 1, "a", "C", "kx"), ("P", 2, "b", "CC", "kb"), ("P", 3, "c", "", "kc"), ("P", 4, "d", "C", None), ("P", 5, "e", "C", "kq"), ("P", 6, "f", "C", None), ("P", 7, "g", "C", None), ("Q", 0, "b", "CC", "kb"), ("Q", 1, "h", None, None)]
    held = gaps.held_keys(spark.createDataFrame([("P", "kb "), ("P", "KD"), ("P", None), ("Q", "")], "patent_id string, inchikey string"))
    resolved = spark.createDataFrame([("a", "C", "KA"), ("b", "CC", "KB"), ("d", "C", "kd"), ("e", None, None), ("f", "CCC", "kf"), ("g", "CCC", "KF"), ("c", "C", "KC")], "name string, smiles string, inchikey string")
    df = spark.createDataFrame(blocks, "patent_id string, pos int, name string, smiles string, inchi_key string")
    return gaps.new_structures(df, held, resolved).select("patent_id", "name", "inchikey")


_GAP_TABLE = [*cells_of(21, [["1", "A", "5"], ["2", "+", "6"], ["", "", ""], ["3", "B", "7"], ["4", "C", "8"], ["5", "A", "9"]], [["Compound", "", "Ki (nM)"]]), *cells_of(22, [["A"], ["B"]]), *cells_of(23, [["1", "x"]], [["No.", ""]])]


@query(expected("table_uid long, col int, shape string", [(21, 1, "bin")]))
def q_case_unlabelled(spark: SparkSession, d: str) -> DataFrame:
    """A column of grades that the document never named; grades without ids and words are none."""
    columns = extract.classify_columns(spark.createDataFrame(_GAP_TABLE, CELLS))
    return gaps.unlabelled_assays(columns).select("table_uid", "col", "shape")


@query(expected("table_uid long, header string, sample string", [(21, "Compound |  | Ki (nM)", "1 | A | 5;2 | + | 6;3 | B | 7"), (22, "", "A;B")]))
def q_case_samples(spark: SparkSession, d: str) -> DataFrame:
    """Samples of two gaps: headers and the first three filled rows."""
    wanted = spark.createDataFrame([(21, 0), (22, 0), (22, 0), (99, 0)], "table_uid long, tgroup_ix int")
    out = gaps.samples(spark.createDataFrame(_GAP_TABLE, CELLS), wanted, 3)
    return out.select("table_uid", "header", F.replace("sample", F.lit("\n"), F.lit(";")).alias("sample"))


_MASS_TABLE = cells_of(31, [["1", "561.2 (M + H)"], ["2", "300"], ["3 HCl", "450.1 [M-H]"], ["x", "200"], ["1", "99.9"], ["4", "n/a"], ["5", "0.69"]], [["No.", "MS (ESI) M+Na"]])


@query(expected("cid string, mz double, shift double", [("1", 561.2, 1.00728), ("2", 300.0, 22.98922), ("3", 450.1, -1.00728)]))
def q_case_column_masses(spark: SparkSession, d: str) -> DataFrame:
    """Masses of a mass column: the adduct of the cell, else of the header; the first row of a compound counts."""
    cells = spark.createDataFrame(_MASS_TABLE, CELLS)
    return gaps.column_masses(cells, extract.classify_columns(cells)).select("cid", "mz", "shift")


@query(expected("patent_id string, table_id string", [("P", "T2")]))
def q_case_attachments(spark: SparkSession, d: str) -> DataFrame:
    """Tables whose introduction calls the drawn bond a point of attachment; the wording before another table does not count."""
    xml = '<p>Text</p><tables id="T1">the point of attachment</tables><p>where the <b>wavy</b> line denotes</p><p>wavy line</p><tables id="T2"></tables><p>Plain.</p><tables id="T3"></tables>'
    docs = spark.createDataFrame([("P", xml), ("Q", "no tables, wavy line"), ("R", None)], "patent_id string, xml string")
    return gaps.attachment_tables(docs)


@query(expected("patent_id string, chemistry_id string", [("P", "C1"), ("Q", "C9")]))
def q_case_drawings_wanted(spark: SparkSession, d: str) -> DataFrame:
    """Scaffolds and fragments without a structure and with a picture."""
    frame = lambda rows: spark.createDataFrame(rows, "patent_id string, chemistry_id string")
    return gaps.drawings_wanted([frame([("P", "C1"), ("P", "C2"), ("P", None)]), frame([("P", "C1"), ("P", "C3"), ("Q", "C9")])], frame([("P", "C2"), ("Q", "C1")]), frame([("P", "C3")]))


@query(expected("name string, pattern_id string, repaired string", [("5-eyloro", "ey", "5-chloro"), ("abc2", None, None)]))
def q_case_library_pass(spark: SparkSession, d: str) -> DataFrame:
    """A library pass over names with a gap: what it proposes, and what it leaves; a signature written off is in neither."""
    df = spark.createDataFrame([("5-eyloro", "s1"), ("abc2", "s2"), ("6-eyloro", "s3")], "name string, signature string")
    made, left = gaps.library_pass(df, [("ey", "ey(?=[a-z]{2})", "ch"), ("none", "zz", "z")], spark.createDataFrame([("s3",)], "signature string"))
    return made.select("name", "pattern_id", "repaired").unionByName(left.select("name"), allowMissingColumns=True)


@query(expected("table_id string, n_rows long, n_masses long, n_names long", [("T1", 2, 1, 1)]))
def q_case_substituent_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Substituent tables with a referee; one without any is left out."""
    t = [("P", "T1", "1", ["R1", "R2"], True, False, "header"), ("P", "T1", "2", ["R1", "R2"], True, False, "header"), ("P", "T2", "9", ["R1"], False, False, None)]
    tables = spark.createDataFrame(t, "patent_id string, table_id string, cid string, headings array<string>, has_image boolean, has_mass boolean, scaffold_where string")
    ref = lambda rows: spark.createDataFrame(rows, "patent_id string, cid string")
    return gaps.substituent_gaps(tables, ref([("P", "1"), ("P", "1"), ("Q", "9")]), ref([("P", "2"), ("P", None)])).select("table_id", "n_rows", "n_masses", "n_names")


_SHOWN = [((5.0, "nM", None, None, None, ">", 3), ">5 nM  (n=3)"), ((None, "nM", 1.0, None, None, None, None), "1..? nM"), ((None, None, None, None, "B", None, None), "grade B"), ((None,) * 7, "(no value)"), ((0.25, "", None, None, None, None, None), "0.25")]


@query(expected("case_no int, shown string", [(i, t) for i, (_, t) in enumerate(_SHOWN)]))
def q_case_shown(spark: SparkSession, d: str) -> DataFrame:
    """Records as a reader sees them."""
    df = spark.createDataFrame([(i, *v) for i, (v, _) in enumerate(_SHOWN)], "case_no int, v double, u string, lo double, hi double, g string, q string, n int")
    return df.select("case_no", gaps.shown(*[F.col(c) for c in ("v", "u", "lo", "hi", "g", "q", "n")]).alias("shown"))


_FAMILIES = [("I-0268", "I-#"), ("Example 7b", "#"), ("A104", "A#"), ("'12'", "#"), ("Cpd. No. 5", "#"), ("", "")]


@query(expected("case_no int, family string", [(i, f) for i, (_, f) in enumerate(_FAMILIES)]))
def q_case_id_families(spark: SparkSession, d: str) -> DataFrame:
    """Families of ids: a suffix letter is no family, a prefix is."""
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_FAMILIES)], "case_no int, t string")
    return df.select("case_no", fn.id_family(F.col("t")).alias("family"))


_NAME_ROWS = cells_of(41, [["Cell (line", "IC50"], ["A) x", "(nM)"], ["b)", "c"], ["1", "2.5"], ["z" * 70, "y"]], [["", "AAK1 IC50"], ["TABLE 4A", ""], ["Example", "(nM)"]])


@query(expected("section string, row_ix int, spans_one boolean, name_like boolean", [("header", 0, True, True), ("header", 1, False, False), ("header", 2, False, True), ("body", 0, False, True), ("body", 1, False, True), ("body", 2, False, False), ("body", 3, False, False), ("body", 4, False, False)]))
def q_case_name_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that read like column names: one label over a column, brackets that an earlier row opened, no titles, numbers or prose."""
    return layout.name_rows(spark.createDataFrame(_NAME_ROWS, CELLS)).select("section", "row_ix", "spans_one", "name_like")


_PROSE = "Example 1: Preparation of 4-(methylamino)pyridine (Compound 1)\nWhite solid.\nCompound 2\n2-chloro-5-(ethoxy)benzamide was obtained as an oil.\n3-phenylpropanoic-2-one (7) follows. Example 99: 9-unknown-9H-purine"


@query(expected("doc string, id string, name_text string", [("P", "1", "4-(methylamino)pyridine"), ("P", "1", "White solid"), ("P", "2", "2-chloro-5-(ethoxy)benzamide"), ("P", "2", "3-phenylpropanoic-2-one"), ("P", "7", "3-phenylpropanoic-2-one")]))
def q_case_texts_after_ids(spark: SparkSession, d: str) -> DataFrame:
    """Where names may stand after the numbers of a document's compounds, and before a number in brackets."""
    docs = spark.createDataFrame([("P", _PROSE), ("Q", None), ("R", "")], "doc string, text string")
    ids = spark.createDataFrame([("P", "1"), ("P", "2"), ("P", "7"), ("Q", "1")], "doc string, id string")
    return names.texts_after_ids(docs, "doc", "text", ids).select("doc", "id", "name_text").distinct()


@query(expected("k int, cid string, name string", [(1, "1", "2-(4-chloro-phenyl)-3-[1-methyl-ethyl]-amide"), (1, "I-2", "4-(2-oxo-1,2-dihydropyridin-3-yl)-benzoic acid")]))
def q_case_vertical_names(spark: SparkSession, d: str) -> DataFrame:
    """Names below their ids in one column, over several lines."""
    lines = ["Compounds", "1", "2-(4-chloro-phenyl)-3-", "[1-methyl-ethyl]-amide", "I-2", "4-(2-oxo-1,2-dihydropyridin-3-yl)-benzoic", "acid", "3", "white solid", "4", ""]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)] + [(2, 0, None)], "k int, row_ix int, text string")
    return names.vertical_names(df, ["k"])


# -- texts and lists -------------------------------------------------------------------------------------------------------------

_SPLITS = [("a, b", ["a", "b"]), ("1-(2,3-dimethyl), x", ["1-(2,3-dimethyl)", "x"]), ("[a, b], {c, d}", ["[a, b]", "{c, d}"]), ("a), b", ["a)", "b"]), ("one", ["one"]), ("", [""]), (" , ", ["", ""])]


@query(expected("case_no int, n int, part string", [(i, n, p) for i, (_, parts) in enumerate(_SPLITS) for n, p in enumerate(parts)]))
def q_case_splits(spark: SparkSession, d: str) -> DataFrame:
    """Lists cut at the commas outside brackets; a bracket that never opened cuts nothing off."""
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_SPLITS)], "case_no int, t string")
    return df.select("case_no", F.posexplode(texts.split_top_level(F.col("t"))).alias("n", "part"))


@query(expected("k int, start long, ref string, rank int", [(1, 100, "a", 1), (3, 70, "y", 1), (3, 70, "x", 2)]))
def q_case_before(spark: SparkSession, d: str) -> DataFrame:
    """Things within reach before an event and behind the event before it; an event with more than two has none."""
    events = spark.createDataFrame([(1, 100), (1, 200), (2, 50), (3, 70), (None, 5)], "k int, start long")
    things = spark.createDataFrame([(1, 90, "a"), (1, 10, "b"), (1, 150, "c"), (1, 160, "d"), (1, 170, "e"), (2, 60, "f"), (3, 30, "x"), (3, 60, "y"), (3, 10, "z"), (4, 1, "q")], "k int, position long, ref string")
    return drawings.before_within(events, things, "k", "start", "position", 50).select("k", "start", "ref", F.col("rank").cast("int").alias("rank"))


@query(expected("k int, first long, last long, n long", [(1, 0, 110, 2), (1, 300, 310, 1), (2, 5, 6, 1), (3, 0, 500, 2)]))
def q_case_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Hits at most 120 characters apart are one cluster; a long hit bridges what lies within it."""
    hits = spark.createDataFrame([(1, 0, 10), (1, 100, 110), (1, 300, 310), (2, 5, 6), (3, 0, 500), (3, 200, 210)], "k int, s long, e long")
    return legend.clusters(hits, ["k"], "s", "e").select("k", "first", "last", "n")


@query(expected("k int, session long, head string, line string", [(1, 1, "5", "name of"), (1, 2, "6", "other"), (2, 1, "7", "x")]))
def q_case_wrapped(spark: SparkSession, d: str) -> DataFrame:
    """Table rows without an id continue the record before; rows before the first record belong to none."""
    rows = [(1, 0, "5", "name"), (1, 1, "", "of"), (1, 2, "6", "other"), (2, 0, None, "lost"), (2, 1, "7", "x")]
    df = spark.createDataFrame(rows, "k int, row_ix int, head string, line string")
    out = layout.wrapped_rows(df, ["k"], "row_ix", "head", "line").filter("session > 0")
    return out.select("k", F.col("session").cast("long").alias("session"), "head", "line")


@query(expected("block string, replaced boolean", [("x", True), ("y", False), ("z", False)]))
def q_case_replaced(spark: SparkSession, d: str) -> DataFrame:
    """A healed block replaces the baseline if it holds all of its compounds."""
    b = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "1"), ("z", "1"), (None, "1")], "block string, item string")
    h = spark.createDataFrame([("x", "1"), ("x", "2"), ("x", "3"), ("y", "9"), ("y", None)], "block string, item string")
    return rules.superset_replaces(b, h, "block", "item")


@query(expected("k int, adopt boolean", [(1, True), (2, False), (3, True), (4, False)]))
def q_case_table_gate(spark: SparkSession, d: str) -> DataFrame:
    """Assembled tables: adopted with enough agreeing masses or none to check, not if all structures are one or masses contradict."""
    rows = [(1, "a", "agrees"), (1, "b", "agrees"), (1, "c", "contradicts"), (2, "a", "agrees"), (2, "a", "agrees"), (3, "a", "unchecked"), (3, "b", None), (4, "a", "agrees"), (4, "b", "contradicts"), (4, "c", "contradicts")]
    df = spark.createDataFrame(rows, "k int, inchikey string, verdict string")
    return drawings.table_gate(df, ["k"]).select("k", "adopt")


@query(expected("patent_id string, cid string, structure_id long, mass_check string", [("P", "1", 3, "agree"), ("P", "2", 5, None), ("P", "3", 6, None), ("Q", "1", 8, "contradict")]))
def q_case_ranked(spark: SparkSession, d: str) -> DataFrame:
    """An agreeing mass before a structure key before the earliest; a contradicting mass is the last resort."""
    rows = [("P", "1", 1, "K", None), ("P", "1", 2, "K", "contradict"), ("P", "1", 3, None, "agree"), ("P", "2", 4, None, None), ("P", "2", 5, "K", None), ("P", "3", 7, None, None), ("P", "3", 6, None, None), ("Q", "1", 8, "K", "contradict")]
    df = spark.createDataFrame(rows, "patent_id string, cid string, structure_id long, inchikey string, mass_check string")
    return identity.ranked_structures(df, ["patent_id", "cid"]).select("patent_id", "cid", "structure_id", "mass_check")


@query(expected("cid string, name_text string", [("1", "4-methylpyridine"), ("2", "2-chloro-benzamide"), ("3", "b-longer")]))
def q_case_name_texts(spark: SparkSession, d: str) -> DataFrame:
    """Which of several readings of a name to believe."""
    rows = [("1", "far", 1, 0, "labelled", "raw"), ("1", "4-methylpyridine", 0, 9, "bare", "raw"), ("2", "2-chloro", 0, 1, "bracketed", "raw"), ("2", "2-chloro-benzamide", 0, 1, "labelled", "repaired"), ("3", "a", 0, 1, "bare", "raw"), ("3", "b-longer", 0, 1, "bare", "recognised"), ("4", None, 0, 0, "bare", "raw")]
    df = spark.createDataFrame(rows, "cid string, name_text string, line int, gap int, shape string, kind string")
    return identity.best_name_text(df, ["cid"]).select("cid", "name_text")


@query(expected("cid string, mz double, shift double", [("1", 300.1, 1.00728), ("2", 410.0, 22.98922), ("3", 500.5, 1.00728)]))
def q_case_reported_masses(spark: SparkSession, d: str) -> DataFrame:
    """Masses from rows, then headings, then columns."""
    frame = lambda rows: spark.createDataFrame(rows, "cid string, mz double, shift double")
    return identity.reported_masses([frame([("1", 300.1, 1.00728), ("2", None, 1.00728)]), frame([("1", 301.0, 1.00728), ("2", 410.0, 22.98922)]), frame([("3", 500.5, 1.00728), ("2", 9.0, 1.00728)])], ["cid"])
