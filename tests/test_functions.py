import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayloom.functions import cells as fn
from assayloom.functions import texts


def one(spark, f, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first().x


VALUES = [
    ("12.5", (12.5, None, None, None, None, None)), ("1,234", (1234.0, None, None, None, None, None)), (".5", (0.5, None, None, None, None, None)), ("1.2e-3", (0.0012, None, None, None, None, None)),
    (">10 nM", (10.0, ">", "nM", None, None, None)), ("<= 3 µM", (3.0, "≤", "µM", None, None, None)), ("~5%", (5.0, "~", "%", None, None, None)), ("5 (3)", (5.0, None, None, 3, None, None)), ("5 (note)", (5.0, None, None, None, None, "note")),
    ("7.1x10^-05", (7.1e-05, None, None, None, None, None)), ("12 ± 3 nM (n=4)", (12.0, None, "nM", 4, None, None)), ("< 5 ± 1 nM", (5.0, "<", "nM", None, None, None)), ("3.0 ± 1.0*", (3.0, None, None, None, None, None)), ("1,680 +- 150 (n = 4) **", (1680.0, None, None, 4, None, None)), ("12 ± 3 n=4", (12.0, None, None, 4, None, None)), ("b", (None, None, None, None, "B", None)), ("+++", (None, None, None, None, "+++", None)), ("**", (None, None, None, None, "**", None)), ("##", (None, None, None, None, "##", None)),
    ("nd", (None,) * 6), ("-", (None,) * 6), ("", (None,) * 6), (None, (None,) * 6), ("5*", (5.0, None, None, None, None, None)), ("−5", (-5.0, None, None, None, None, None)), ("\xa05\xa0", (5.0, None, None, None, None, None)), ("see Table 4", (None,) * 6), ("x" * 10000, (None,) * 6),
]


def test_value_cascade(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(VALUES)], "i int, v string").withColumn("p", fn.parse_value(F.col("v")))
    for r in df.collect():
        got = tuple(r.p)
        want = VALUES[r.i][1]
        assert all(a == pytest.approx(b) if isinstance(b, float) else a == b for a, b in zip(got, want, strict=True)), (r.v, got)


@pytest.mark.parametrize(("raw", "want"), [("Example 007", "7"), ("Cpd. No. 7", "7"), ("Compound No. 7", "7"), ("Example No. 12", "12"), ("Compounds 5", "5"), ("Example12", "12"), ("Expt-1", "Expt-1"), ("100AA", "100AA"), ("10-1", "10-1"), ("I-0020", "I-20"), ("α-6-mPEG1-O-Codeine", "α-6-mPEG1-O-Codeine"), ("Nordic", "Nordic"), ("cmpd. A-012b", "A-12b"), ("Compound #5", "5"), ("No. I-3", "I-3"), ("something else", "something else"), ("y" * 50, ""), (None, None), ("", "")])
def test_normalize_cid(spark, raw, want):
    assert one(spark, fn.normalize_cid, raw) == want


@pytest.mark.parametrize(("raw", "want"), [("IC50 (nM)", "nM"), ("IC50, μM", "uM"), ("Ki in mol/L", "M"), ("10^-9 M", "nM"), ("% inh", "%"), ("% Inh at 1 μM", "%"), ("IC50 [M]", "M"), ("IC50 in micromolar, not nM", "uM"), ("M series", None), ("plain", None), (None, None)])
def test_units_of_headers(spark, raw, want):
    assert one(spark, fn.unit_from, raw) == want


def test_scalars(spark):
    assert one(spark, fn.dewrap, "4- methyl ( phenyl )") == "4-methyl(phenyl)"
    assert one(spark, fn.dewrap_candidates, "a- b c") == ["a- b c", "a-b c", "a-bc"]
    assert one(spark, fn.id_shape, "I-12b") == "A-9A"
    assert one(spark, fn.patent_number, "US31000149B2") == "31000149" and one(spark, fn.patent_number, "US20200012345A1") == "20200012345" and one(spark, fn.patent_number, "EP12") is None
    assert [one(spark, fn.strip_salt, x) for x in ("aspirin acetate salt", "aspirin salt", "X trihydrate", "aspirin")] == ["aspirin", "aspirin", "x", None]
    assert one(spark, fn.retention, "abcd", "abcx") == 0.75 and one(spark, fn.coverage, "a-b", "xa bx") == 0.5 and one(spark, fn.coverage, "q", "xa") == 0
    assert [one(spark, fn.value_shape, v) for v in ("", "1.5", "12", "A", "I-3", "note", ">3")] == ["empty", "num", "cid", "bin", "cid", "text", "num"]
    assert [one(spark, fn.header_kind, h) for h in ("Ex. No.", "IC50 (nM)", "1H NMR", "MW", "MS m/z", "Structure", "R1", "n", "Remark", "Ki")] == ["cid", "assay", "nmr", "mw", "ms", "structure", "substituent", "nruns", "unknown", "assay"]
    assert one(spark, fn.compatible, "nM", "%") is False and one(spark, fn.compatible, "nM", "µM") is True and one(spark, fn.compatible, None, "%") is True
    assert one(spark, fn.looks_chemical, "2-(methyl)-4-phenyl-1H") and not one(spark, fn.looks_chemical, "a plain sentence - with (few) marks and so on")
    assert one(spark, fn.is_placeholder_name, " Assay (Unnamed) ") is True


@pytest.mark.parametrize(
    ("heading", "want"),
    [
        ("Rat Vagudor channel 3 IC50 at 10 uM", ("IC50", "Vagudor channel 3", "10 uM", 10.0, "rat")), ("ABHD6 % Inh 1 uM (mouse)", ("% inhibition", "ABHD6", "1 uM", 1.0, "mouse")), ("MAGL IC50 (human)", ("IC50", "MAGL", None, None, "human")), ("PI3K alpha IC50 (nM)", ("IC50", "PI3K alpha", None, None, None)),
        ("PARG_EC50_ENZYME", ("EC50", "PARG", None, None, None)), ("IC50 against Margugu", ("IC50", "against Margugu", None, None, None)), ("BACE1 IC20", ("IC20", "BACE1", None, None, None)), ("X % inh 20 mg/kg, p.o.", ("% inhibition", "X", "20 mg/kg, p.o.", None, None)),
        ("Y IC90 at 1, 10 uM", ("IC90", "Y", "1, 10 uM", None, None)), ("S. aureus MIC", ("MIC", "S. aureus", None, None, None)), ("plain", (None, "plain", None, None, None)), ("", (None, None, None, None, None)), (None, (None, None, None, None, None)),
    ],
)
def test_axes_of_headings(spark, heading, want):
    assert tuple(one(spark, fn.axes, heading)) == want


@pytest.mark.parametrize(("lo", "hi", "want"), [(10.0, 100.0, "10 - 100 nM"), (None, 10.0, "<10 nM"), (0.5, None, ">0.5 nM"), (None, None, None)])
def test_band(spark, lo, hi, want):
    df = spark.createDataFrame([(lo, hi, "nM")], "lo double, hi double, u string")
    assert df.select(fn.band(F.col("lo"), F.col("hi"), F.col("u"))).first()[0] == want


def _split(text):
    out, cur, depth = [], "", 0
    for ch in text:
        if ch == "," and depth <= 0:
            out.append(cur)
            cur = ""
            continue
        depth = max(0, depth + (ch in "([{") - (ch in ")]}"))
        cur += ch
    return [x.strip(" ") for x in [*out, cur]]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab1,()[] ", max_size=25), min_size=1, max_size=20))
def test_split_top_level_equals_brute_force(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    got = {r.i: r.p for r in df.select("i", texts.split_top_level(F.col("t")).alias("p")).collect()}
    assert got == {i: _split(r) for i, r in enumerate(rows)}


def test_lists_and_sentences(spark):
    assert one(spark, lambda c: texts.share_prefix(F.split(c, ", ")), "Compound A 1, 2, A 3, x") == ["Compound A 1", "Compound A 2", "Compound A 3", "x"]
    assert one(spark, lambda c: texts.join_lines(F.split(c, r"\|")), "inhib-|ition of|Kinase") == "inhibition of Kinase"
    assert [tuple(x) for x in one(spark, texts.zip_lists, "A, B (x, y)", "1, 2")] == [("A", "1"), ("B (x, y)", "2")] and one(spark, texts.zip_lists, "A, B", "1") is None
    assert one(spark, texts.percent_header, "% inhibition") and not one(spark, texts.percent_header, "IC50 or % inh")
    assert tuple(one(spark, texts.caption_hint, "Table 2. IC50 (nM) of compounds; a long remark on activity here")) == ("IC50 (nM) of compounds", "nM")
    docs = spark.createDataFrame([(1, "IC50 was 5 nM. The Ki is in uM!"), (1, "Ki in nM is odd."), (2, None), (3, "m/z 321.5 [M+H]+ and m/z = 99")], "k int, t string")
    assert [tuple(r) for r in texts.stated_units(docs.dropna(), "k", "t").collect()] == [(1, "IC50", "nM")]
    assert [tuple(r) for r in texts.embedded_values(docs, "k", "t").collect()] == [(1, "IC50", None, 5.0, "nM")]
    assert sorted((r.mz, r.adduct, r.shift) for r in texts.printed_masses(docs, "k", "t").collect() if r.k == 3) == [(99.0, None, None), (321.5, "+H", 1.00728)]
