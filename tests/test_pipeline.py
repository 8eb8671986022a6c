import pytest
from pyspark.sql import functions as F

from assayloom.operators import deliver, drawings, extract, identity, layout, legend, names, rules, views
from assayloom.plans import case_queries as cases
from assayloom.plans import pipeline
from assayloom.plans.reference_queries import QUERIES, SQL
from assayloom.sources import documents, fetch

XML = """<us><description><p>IC50 values are in nM.</p><p>TABLE 1. A: below 10 uM; B: 10 to 100 uM</p>
<tables id="T1"><table><tgroup cols="3"><thead><row><entry>Compound</entry><entry>Vagudor IC50</entry><entry>MW</entry></row></thead>
<tbody><row><entry>1</entry><entry>5.1</entry><entry>300</entry></row><row><entry/><entry>A</entry><entry/></row><row><entry>2</entry><entry>nd</entry><entry>1</entry></row></tbody></tgroup></table></tables></description></us>"""


def test_documents_to_compounds(spark):
    docs = spark.createDataFrame([("P1", XML), ("P2", ""), ("P3", None)], "patent_id string, xml string")
    s = spark.createDataFrame([("P1", "1", "n", "K", "table", 1), ("P1", "9", "m", None, "image", 2)], "patent_id string, cid string, name string, inchikey string, source string, structure_id long")
    d = pipeline.dump(docs, s)
    got = sorted(((r.cid, r.value_numeric, r.letter_grade or "", r.unit, r.range_hi, r.unit_source) for r in d.records.collect()), key=str)
    assert got == [("1", 5.1, "", "nM", None, "description"), ("1", None, "A", "uM", 10.0, "bin_key")]
    assert {(r.cid, r.status, r.n_measurements) for r in d.compounds.collect()} == {("1", "resolved", 2), ("9", "drawn", None)}
    assert {r.figure: r.n for r in d.manifest.collect()} == {"rows": 2, "patents": 1, "structures:table": 1, "structures:image": 1, "loss:inchikey_resolution_empty": 1}
    assert d.flags.count() == 0 and pipeline.dump(docs.limit(0)).compounds.count() == 0


def test_every_view_of_a_table(spark):
    cells = spark.createDataFrame(cases.VIEW_TABLES, cases.CELLS)
    got = [(r.table_uid, r.view, r.cid, r.assay_name, r.value_numeric, r.letter_grade) for r in views.extract_all(cells).collect()]
    assert sorted(got, key=str) == sorted(cases.VIEW_RECORDS, key=str)
    assert views.extract_all(cells.limit(0)).count() == 0
    shuffled = views.extract_all(cells.orderBy(F.desc("text")).withColumn("view", F.lit("clash")).drop("view"))
    assert shuffled.count() == len(cases.VIEW_RECORDS)


def test_cases_agree_with_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    for name in [q for q in QUERIES if q.startswith("q_case_") or q in ("q_legend_grammar", "q_repair_cases")]:
        df = QUERIES[name](spark, "")
        want = duckdb.sql(f"SELECT {', '.join(df.columns)} FROM ({SQL[name]})").fetchall()
        assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str), name


def test_library_heals(spark):
    docs = spark.createDataFrame([("P1", XML.replace("Vagudor IC50", "Results"))], "patent_id string, xml string")
    cells = pipeline.cells_of(docs)
    base = extract.records_of_cells(cells)
    assert base.count() == 0
    fp = extract.layout_signature(cells).first().fingerprint
    lib = spark.createDataFrame([(fp, 0, [(1, "K IC50", "nM")])], "fingerprint string, cid_index int, columns array<struct<index:int,name:string,unit:string>>")
    healed = pipeline.heal_with_library(cells, base, lib, extract.KEY)
    assert sorted((r.cid, r.value_numeric) for r in healed.filter("value_numeric is not null").collect()) == [("1", 5.1)]


def test_fetching(spark):
    def source(key):
        if key == "bad":
            raise fetch.Unavailable("not indexed", 404)
        return key.encode()

    keys = spark.createDataFrame([("a",), ("a",), ("bad",), (None,)], "k string")
    got = {r.key: (bytes(r.content) if r.content else None, r.error) for r in fetch.fetch_all(keys, "k", source).collect()}
    assert got == {"a": (b"a", None), "bad": (None, "Unavailable: not indexed")}
    cache = spark.createDataFrame([("a", bytearray(b"old"))], "key string, content binary")
    every, fresh = fetch.cached(spark.createDataFrame([("a",), ("b",)], "k string"), "k", cache, source)
    assert {(r.key, bytes(r.content)) for r in every.collect()} == {("a", b"old"), ("b", b"b")} and [r.key for r in fresh.collect()] == ["b"]
    waits, calls = [], []

    def flaky(key):
        calls.append(key)
        if len(calls) < 3:
            raise fetch.Unavailable("busy", 503)
        return b"x"

    assert fetch.with_retry(flaky, sleep=waits.append)("k") == b"x" and waits == [5.0, 10.0]
    r = spark.createDataFrame([("https://h/US-1.png", "US-1.TIF"), ("https://h/US-2.png", "US-1.TIF")], "u string, f string").select(fetch.same_file(F.col("u"), F.col("f")).alias("x"))
    assert [x.x for x in r.collect()] == [True, False]


def test_inheritance(spark):
    g = spark.createDataFrame([("P", 1, 0, 2, ["No.", "Ki"], ["cid", "num"]), ("P", 2, 0, 2, ["Note", "Text"], ["text", "text"]), ("P", 3, 0, 2, [], ["cid", "num"]), ("P", 4, 0, 2, [], ["text", "text"]), ("Q", 5, 0, 2, [], ["cid", "num"])], "patent_id string, table_uid long, tgroup_ix int, n_cols int, header array<string>, shapes array<string>")
    got = {r.table_uid: r.effective for r in extract.inherit_best(g).collect()}
    assert got == {1: ["No.", "Ki"], 2: ["Note", "Text"], 3: ["No.", "Ki"], 4: None, 5: None}


def test_sectioned_legends(spark):
    rows = [(1, 0, "For kinase A:"), (1, 1, "A: below 10 nM"), (1, 2, "B: 10 to 20 nM"), (1, 3, "For kinase B:"), (1, 4, "A: below 50 nM"), (2, 0, None)]
    got = legend.sectioned(spark.createDataFrame(rows, "k int, o int, t string"), ["k"], "o", "t")
    assert {(r.heading, r.symbol, r.hi) for r in got.collect()} == {("For kinase A", "A", 10.0), ("For kinase A", "B", 20.0), ("For kinase B", "A", 50.0)}
    cells = spark.createDataFrame([(1, 0, ["A", "below 10"], "IC50 (nM)"), (1, 1, ["10 to 20 nM", "", "B"], None), (1, 2, ["x", "y"], None), (2, 0, ["≦0.5", "C:"], "MIC (μg/mL"), (3, 0, None, None)], "k int, o int, c array<string>, h string")
    assert {(r.k, r.symbol, r.lo, r.hi, r.unit) for r in legend.of_rows(cells, ["k"], "o", "c", "h").collect()} == {(1, "A", None, 10.0, "nM"), (1, "B", 10.0, 20.0, "nM"), (2, "C", None, 0.5, "ug/mL")}
    columns = spark.createDataFrame([(1, 0, "IC50 kinase B"), (1, 1, "MS"), (9, 0, "IC50 kinase A"), (1, 2, None)], "k int, col int, header string")
    named = legend.section_of_column(columns, got.withColumn("heading", F.regexp_replace("heading", "^For ", "")), ["k"], "header")
    assert {(r.k, r.col): r.heading for r in named.collect()} == {(1, 0): "kinase B", (1, 1): None, (9, 0): None, (1, 2): None}
    near = legend.nearest_before(spark.createDataFrame([("P", 1, "A", None, 5.0, "nM"), ("P", 3, "A", None, 9.0, "nM")], "p string, t int, symbol string, lo double, hi double, unit string"), spark.createDataFrame([("P", 1), ("P", 2), ("P", 3), ("P", 4), ("Q", 4)], "p string, t int"), "p", "t")
    assert {(r.p, r.t, r.symbol, r.hi) for r in near.collect()} == {("P", 2, "A", 5.0), ("P", 3, "A", 5.0), ("P", 4, "A", 9.0)}
    prose = spark.createDataFrame([(1, "for T315I activity, the following designations are used: <1.00 nM=A; 1.01-10.0 nM=B. For wild-type activity, the following designations are used: <10 nM=A; 11-100 nM=B."), (2, "A: below 1 nM"), (3, None)], "k int, t string")
    assert {(r.k, r.heading, r.symbol, r.hi) for r in legend.sections_of_prose(prose, ["k"], "t").collect()} == {(1, "T315I activity", "A", 1.0), (1, "T315I activity", "B", 10.0), (1, "wild-type activity", "A", 10.0), (1, "wild-type activity", "B", 100.0)}
    doc = legend.document_legend(got.withColumn("at", F.col("hi")).withColumn("heading", F.lit("x")), "k", "at")
    assert {(r.symbol, r.hi) for r in doc.collect()} == {("A", 50.0), ("B", 20.0)}


def test_occurrences(spark):
    t = spark.createDataFrame([("P", 1, "5: the Example 7, and (9) with 5."), ("P", 2, None), ("Q", 3, "Compound 5")], "p string, r int, t string")
    ids = spark.createDataFrame([("P", "5"), ("P", "7"), ("P", "9"), ("P", "9")], "p string, id string")
    got = {(r.id, r.position, r.shape) for r in identity.occurrences(t, ids, "p", "r", "t").collect()}
    assert got == {("5", 0, "line_start"), ("7", 3, "labelled"), ("9", 5, "bracketed"), ("5", 7, "bare")}


class Resolver:
    def resolve(self, frame):
        ok = F.col("name") == "2-methylphenyl"
        return frame.withColumns({"smiles": F.when(ok, "C"), "inchikey": F.when(ok, "K")})


def test_name_resolution(spark):
    n = spark.createDataFrame([("P", "1", "2- methylphenyl"), ("P", "2", "nonsense"), ("P", "3", None)], "p string, c string, n string")
    got = {r.c: (r.candidate, r.inchikey, r.reason) for r in names.resolve(n, "n", ["p", "c"], Resolver()).collect()}
    assert got == {"1": ("2-methylphenyl", "K", None), "2": (None, None, "no reading accepted"), "3": (None, None, "no reading accepted")}
    sig = spark.createDataFrame([("name is unparsable due to 'ethyll'", "2-ethyll"), ("bracket '('", "(a"), (None, "x")], "e string, n string").select(names.failure_signature(F.col("e"), F.col("n")).alias("s"))
    assert [r.s for r in sig.collect()][:2] == ["unparsable|letters|start", "brackets|brackets|unknown"] or [r.s for r in sig.collect()][1].startswith("brackets|brackets|")
    a = spark.createDataFrame([("x", 1, False)] * 3 + [("y", 1, False)] * 3 + [("y", 1, True), ("z", 2, False)], "signature string, epoch int, adopted boolean")
    assert [r.signature for r in names.escalated(a, 1).collect()] == ["x"]


def test_rule_kinds_and_gates(spark):
    rows = spark.createDataFrame([(1, "f", "Compound 7 | 5.5"), (2, "f", None), (3, "g", "Compound 8 | 1")], "k int, fingerprint string, text string")
    lib = spark.createDataFrame([("f", r"Compound (?P<cid>\d+) \| (?P<value>[\d.]+)"), ("g", "(")], "fingerprint string, pattern string")
    assert [tuple(r) for r in rules.apply_row_patterns(rows, lib, ["k"]).collect()] == [(1, "7", "5.5")]
    cells = spark.createDataFrame([(1, "f", "approx. 7 units"), (2, "f", "5.5"), (3, "f", "nd"), (4, "h", "approx. 9")], "k int, fingerprint string, text string")
    vp = spark.createDataFrame([("f", "approx\\. ([0-9.]+)")], "fingerprint string, pattern string")
    assert [(r.k, r.value) for r in rules.apply_value_patterns(cells, vp, ["k"]).collect()] == [(1, 7.0)]
    full = spark.createDataFrame([("f", "not_assay", 1, 2), ("q", "column_map", None, None)], "fingerprint string, kind string, times_applied long, rows_yielded long")
    assert {r.k for r in rules.suppress(cells, full).collect()} == {4}
    used = rules.record_use(full, spark.createDataFrame([("q", 5), ("q", 6)], "fingerprint string, rows long"))
    assert {(r.fingerprint, r.times_applied, r.rows_yielded) for r in used.collect()} == {("f", 1, 2), ("q", 2, 11)} and [r.fingerprint for r in rules.top_rules(used, "rows_yielded", 1).collect()] == ["q"]
    p = spark.createDataFrame([(1, 0, "5"), (1, 1, "6"), (2, 0, "300")], "k int, col int, text string")
    o = rules.outcome(p, spark.createDataFrame([(2, "300")], "k int, text string"), spark.createDataFrame([(1, 0, "assay")], "k int, col int, kind string"), ["k"])
    assert {(r.k, r.adopt) for r in o.collect()} == {(1, True), (2, False)}

    class Proposer:
        def propose(self, gap, attempts):
            return {"n": len(attempts)} if gap["ok"] else None

    assert rules.heal([{"ok": True}, {"ok": False}], Proposer(), lambda r: (r["n"] == 2, "no")) == [{"n": 2}]
    t = spark.createDataFrame([(1, "a", "agrees"), (1, "b", "contradicts"), (1, "c", "agrees"), (2, "a", "agrees"), (2, "a", "agrees"), (3, "a", "unchecked"), (4, "a", "contradicts"), (4, "b", "contradicts")], "k int, inchikey string, verdict string")
    assert {r.k for r in drawings.table_gate(t, ["k"]).filter("adopt").collect()} == {1, 3}
    m = drawings.map_slots(spark.createDataFrame([(1, "R1"), (1, "R2"), (1, "R3")], "k int, slot string"), spark.createDataFrame([(1, "r1", 4), (1, "R2", 5), (1, "R2", 6)], "k int, label string, point int"), ["k"])
    assert {(r.slot, r.point, r.refusal) for r in m.collect()} == {("R1", 4, None), ("R2", None, "slot marked twice"), ("R3", None, "slot not marked")}


def test_worklists(spark, tmp_path):
    path = tmp_path / "work.tsv"
    path.write_text("patent_id\tcid\tn_assays\textra\nP\t1\t3\tx\nQ\t2\tmany\ty\n")
    got = documents.read_worklist(spark, str(path))
    assert got.columns == [f.split()[0] for f in documents.WORKLIST.split(", ")]
    assert [(r.patent_id, r.cid, r.n_assays, r.url) for r in got.orderBy("patent_id").collect()] == [("P", "1", 3, None), ("Q", "2", None, None)]


def test_sinks(spark, tmp_path):
    df = spark.range(2500).withColumn("a", F.lit("x"))
    folder = str(tmp_path / "sent")

    def send(batch):
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(batch)))

    deliver.post_batches(df.coalesce(1), send)
    assert sorted(int(p.read_text()) for p in (tmp_path / "sent").iterdir()) == [500, 1000, 1000]
    r = spark.createDataFrame([("P", "b", 2.0, "nM"), ("P", "a", 1.0, None)], "p string, assay_name string, value_numeric double, unit string")
    x = deliver.aligned_lists(r, ["p"]).first()
    assert (x.assays, x["values"], x.units) == (["a", "b"], [1.0, 2.0], [None, "nM"])
    assert {(a.column, a.share) for a in deliver.null_rates(r).collect()} == {("p", 0.0), ("assay_name", 0.0), ("value_numeric", 0.0), ("unit", 0.5)}
    deliver.write_sheets({"one": r}, str(tmp_path / "book"))
    assert (tmp_path / "book" / "one").is_dir()


def test_layout_checks(spark):
    c = spark.createDataFrame([("P", 1, 0, s, i, 0, t, 1, 0, None) for s, i, t in [("header", k, "h") for k in range(6)] + [("body", 0, "5"), ("body", 1, "Ki")]], "patent_id string, table_uid long, tgroup_ix int, section string, row_ix int, cell_ix int, text string, colspan int, col int, chemistry_id string")
    assert layout.assembly_fidelity(layout.row_profile(c)).count() == 1
    assert {r.row_ix for r in layout.opens_with_id(c, ["Ki"]).filter("opens").collect()} == {0}
    v = spark.createDataFrame([("KI", None)], "canonical string, surface_forms array<string>")
    assert layout.measurement_cells(c, v).count() == 1
