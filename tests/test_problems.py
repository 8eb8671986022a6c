"""The general data problems against brute force, with nulls, ties, repeats, empty tables and clashing column names."""

import datetime as dt
import json
import random
import shutil
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayloom import common
from assayloom.common import hot_keys, plain_cid, salted_left_join, shared_folder
from assayloom.operators import orphans, shred, units, wide
from assayloom.plans import problem_queries as pq

T = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize(("raw", "plain"), [(" Example 5 ", "5"), ("Cmpd. I-2", "i-2"), ("no.7", "7"), ("NO 7a", "7a"), ("Expt-1", "expt-1"), ("int-3", "int-3"), ("Ex", ""), ("", ""), (None, None)])
def test_plain_cid(spark, raw, plain):
    df = spark.createDataFrame([(raw,)], "c string").select(plain_cid(F.col("c")))
    assert df.first()[0] == plain


# -- 2 ---------------------------------------------------------------------------------------------------------------------------


def _walk(doc, text):
    return list(shred._walk(doc, text))


def _rebuilt(rows):
    nodes = {r[1]: r for r in rows}
    assert len(nodes) == len(rows)
    children = {}
    for r in rows:
        if r[2] is not None:
            children.setdefault((r[2], r[3].endswith("[]")), []).append(r)
    plain = lambda k: k.replace("~1", "[").replace("~0", "~")

    def build(n):
        _, node, parent, label, _, kind, scalar = nodes[n]
        if kind == "object":
            return {plain(k[3]): build(k[1]) for k in sorted(children.get((node, False), []), key=lambda r: r[4])}
        if kind == "array":
            owner = node if parent is None or label.endswith("[]") else parent
            return [build(k[1]) for k in sorted(children.get((owner, True), []), key=lambda r: r[4]) if k[3] == label + "[]"]
        return None if kind == "null" else scalar if kind == "string" else json.loads(scalar)

    return build(0)


def test_adjacency_is_lossless():
    values = [{}, [], {"a": {"b/c": [1, None, "x", [], {}]}, "~": True}, [[["deep"]]], "s", 1.5, None, {"a": [], "b": [[], [1], [[2], []]], "c[]": [3], "a[": {"~0": [4]}}]
    for x in values:
        assert _rebuilt(_walk("d", json.dumps(x))) == x
    broken = "{broken" + "x" * 1000
    assert _walk("d", broken) == [("d", 0, None, None, 0, "broken", broken)] and _walk("d", None) == [("d", 0, None, None, 0, "broken", None)]
    assert [r[5] for r in _walk("d", "[" * 100_000)] == ["broken"]


@settings(max_examples=150, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers(-(10**12), 10**12) | st.text(max_size=8), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(alphabet="ab[]~/", max_size=3), x, max_size=4), max_leaves=25))
def test_adjacency_of_any_record_is_lossless(x):
    assert _rebuilt(_walk("d", json.dumps(x))) == x


def test_p2_on_small_tables(spark, save):
    cell = "struct<text:string,colspan:int,col_start:int,chemistry_id:string>"
    schema = f"table_uid long, patent_id string, table_id string, tgroup_ix int, n_cols int, header_rows array<array<{cell}>>, body_rows array<array<{cell}>>, col_widths array<double>, caption string, preceding string, following string, scanned_at timestamp"
    row = (1, "P", "T", 0, 3, [[("a", 2, 0, None), ("b", None, -1, None)], []], [[("x", 1, 0, None)], [], [("y", -3, 0, None), ("z", 3, 0, None)]], None, None, None, None, T(0))
    null_row = (2, None, None, 1, None, None, [None, [None, ("q", 5, None, None)]], None, None, None, None, None)
    objects = spark.createDataFrame([row, row, null_row], schema)
    payload = {"tables": [{"table_uid": 9, "tgroups": {"body_rows": [["t", {"text": "u", "namest": "c2", "nameend": "c4"}], {"cells": [{"colspan": "2"}, {"colspan": "x"}]}, []]}}, {"table_uid": 10, "tgroups": [{}, {"header_rows": [[{"text": "v", "colspan": 2}]], "body_rows": None}]}]}
    nested = {"description": {"sections": [{"heading": "H"}, {"tables": [{"table_uid": 11, "tgroups": [{"body_rows": [[{"colspan": 4}]]}]}]}]}}
    raw = spark.createDataFrame([(1, "P", json.dumps(payload), T(0)), (2, "P", json.dumps(payload), T(1)), (3, None, json.dumps(nested), None), (4, "P", None, None), (5, "P", "not json", None), (6, "P", "[]", None)], "raw_id long, patent_id string, payload string, received_at timestamp")
    d = save(table_objects=objects, raw_tables=raw)
    got = sorted(tuple(r) for r in pq.p2_found(spark, d).collect())
    assert got == [(1, 0, "body", 2, 1), (1, 0, "header", 0, 0), (2, 1, "body", 1, 1), (9, 0, "body", 0, 1), (9, 0, "body", 1, 0), (10, 1, "header", 0, 0), (11, 0, "body", 0, 0)]
    cells = {tuple(r)[:5]: r for r in pq.p2_cells(spark, d).collect()}
    assert cells[(9, 0, "body", 0, 0)].text == "t" and cells[(9, 0, "body", 0, 1)].colspan == 3
    assert {(r.table_uid, r.tgroup_ix) for r in pq.p2_groups(spark, d).collect()} == {(1, 0), (2, 1), (9, 0), (10, 0), (10, 1), (11, 0)}
    assert (9, 0, "body", 2) in {tuple(r) for r in pq.p2_rows(spark, d).collect()}
    assert {r.table_uid for r in pq.p2_tables(spark, d).collect()} == {1, 2, 9, 10, 11}
    assert sorted(tuple(r) for r in pq.p2_rejects(spark, d).collect()) == [(4, "null", None), (5, "not json", "not json"), (6, "no table", None)]
    empty = save(table_objects=objects.limit(0), raw_tables=raw.limit(0))
    assert pq.p2_found(spark, empty).count() == 0  # the stored adjacency of the files before is not taken
    assert pq.p2_rejects(spark, empty).count() == 0


def test_p2_of_records_that_nest_and_repeat_differently(spark, save):
    cell = "struct<text:string,colspan:int,col_start:int,chemistry_id:string>"
    schema = f"table_uid long, patent_id string, table_id string, tgroup_ix int, n_cols int, header_rows array<array<{cell}>>, body_rows array<array<{cell}>>, caption string, preceding string, following string, scanned_at timestamp"
    # one key delivered twice with different cells: each delivery keeps its own
    objects = [(1, "P", "T", 0, 1, None, [[("a", 2, None, "C1")]], "cap", None, None, T(0)), (1, "P", "T", 0, 1, None, [[("b", 3, None, None)]], "cap", None, None, T(0))]
    deep = {"a": [{"b": [{"table_uid": "20", "caption": {"text": "held"}, "tgroups": [{"n_cols": "2", "header_rows": [], "body_rows": [None, [[1, 2], {"text": "x", "colspan": 2, "chemistry": {"id": "C2", "img": {"file": "f"}}}]]}]}]}]}
    odd = [{"table_uid": 21, "table_id": "T9", "caption": "plain", "tgroup": {"body_rows": [{"cells": [{"text": "y", "namest": "c1", "nameend": "c9"}, 5, None]}, {"cells": []}, {}]}}]
    raw = [(1, json.dumps(deep)), (2, json.dumps(odd)), (3, json.dumps(odd)), (4, '{"table_uid": 22, "tgroups": ['), (5, json.dumps({"table_uid": None}))]
    d = save(table_objects=spark.createDataFrame(objects, schema), raw_tables=spark.createDataFrame(raw, "raw_id long, payload string"))
    assert sorted(tuple(r) for r in pq.p2_found(spark, d).collect()) == [(1, 0, "body", 0, 0), (20, 0, "body", 1, 1), (21, 0, "body", 0, 0)]
    cells = sorted((r.table_uid, r.row_ix, r.cell_ix, r.text or "", r.colspan, r.chemistry_id) for r in pq.p2_cells(spark, d).collect())
    assert cells == [(1, 0, 0, "a", 2, "C1"), (1, 0, 0, "b", 3, None), (20, 1, 0, "", 1, None), (20, 1, 1, "x", 2, "C2"), (21, 0, 0, "y", 9, None), (21, 0, 1, "5", 1, None), (21, 0, 2, "", 1, None)]
    assert sorted((r.table_uid, r.row_ix) for r in pq.p2_rows(spark, d).collect()) == [(1, 0), (20, 0), (20, 1), (21, 0), (21, 1), (21, 2)]
    assert sorted((r.table_uid, r.table_id, r.caption) for r in pq.p2_tables(spark, d).collect() if r.table_uid > 1) == [(20, None, "held"), (21, "T9", "plain")]
    assert {(r.table_uid, r.n_cols) for r in pq.p2_groups(spark, d).collect()} == {(1, 1), (20, 2), (21, None)}
    assert sorted((r.raw_id, r.reason) for r in pq.p2_rejects(spark, d).collect()) == [(4, "not json"), (5, "no table")]


def test_a_stored_table_that_was_cleaned_away_is_made_again(spark, save):
    d = save(t=spark.range(5))
    made = []

    def build():
        made.append(1)
        return spark.range(5)

    source = [spark.read.parquet(f"{d}/t.parquet").select("_metadata")]
    assert common.written_once(source, "x", build).count() == 5 and common.written_once(source, "x", build).count() == 5 and len(made) == 1
    key = next(k for k in common._stored if k[1] == "x")
    shutil.rmtree(common._stored[key][1].removeprefix("file://"))
    assert common.written_once(source, "x", build).count() == 5 and len(made) == 2


def test_intermediate_tables_need_a_shared_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(master="spark://somewhere:7077", getConf=lambda: conf)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(conf=conf, sparkContext=context))


# -- 4 ---------------------------------------------------------------------------------------------------------------------------


def _orphan_tables(spark, rng, n):
    ids = [None, "P1", "P2", "P3", "P4"]
    cids = [None, "1", " 1", "Ex 1", "2", "2a", ""]
    when = lambda: rng.choice([None, T(rng.randint(0, 20))])
    pats = [(p, T(rng.randint(0, 20)), when()) for p in ids[1:4]]
    comps = [(i, rng.choice(ids), rng.choice(cids), T(rng.randint(0, 20)), when()) for i in range(n)]
    refs = [(i, rng.choice(ids), rng.choice(cids), when()) for i in range(3 * n)]
    return {
        "patents": spark.createDataFrame(pats, "patent_id string, loaded_at timestamp, deleted_at timestamp"),
        "compounds": spark.createDataFrame(comps, "compound_row long, patent_id string, cid string, loaded_at timestamp, deleted_at timestamp"),
        "reader_dump": spark.createDataFrame(refs, "dump_row long, patent_id string, cid string, loaded_at timestamp").withColumn("h", F.lit("clash")),
        "structures": spark.createDataFrame(refs[:n], "structure_id long, patent_id string, cid string, loaded_at timestamp"),
    }, (pats, comps, refs)


def _plain(c):
    import re

    return None if c is None else re.sub(r"^(example|ex|compound|cmpd|cpd|no)(?![a-z])\.?\s*", "", c.lower().strip())


def _kind(own, targets):
    if not targets:
        return "missing"
    live = [t for t, gone in targets if gone is None]
    if not live:
        return "deleted"
    return "late" if own is not None and min(live) > own else None


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_orphans_equal_brute_force(spark, limit):
    tables, (pats, comps, refs) = _orphan_tables(spark, random.Random(5), 60)
    keys = [F.col("patent_id"), plain_cid(F.col("cid"))]
    r = tables["reader_dump"].filter("cid is not null").select(F.lit("r").alias("src_table"), F.col("dump_row").alias("row_id"), keys[0].alias("k0"), keys[1].alias("k1"), "loaded_at")
    got = {(x.row_id, x.kind) for x in orphans.find_orphans(r, orphans.parents(tables["compounds"], keys), 2, limit).collect()}
    want = set()
    for i, p, c, at in refs:
        if c is not None:
            k = _kind(at, [(a, g) for _, p2, c2, a, g in comps if p is not None and (p2, _plain(c2)) == (p, _plain(c))])
            want |= {(i, k)} if k else set()
    assert got == want and len({k for _, k in got}) == 3


def test_p4_on_small_and_empty_tables(spark, save):
    tables, _ = _orphan_tables(spark, random.Random(6), 30)
    d = save(**tables)
    found = pq.p4_found(spark, d)
    assert found.columns == ["src_table", "row_id", "kind"] and found.distinct().count() == found.count() > 0
    assert pq.p4_report(spark, d).agg(F.sum("n_orphans")).first()[0] == found.count()
    empty = save(**{k: v.limit(0) for k, v in tables.items()})
    assert pq.p4_found(spark, empty).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_bloom_filter_has_no_false_negative(spark, limit):
    keys = spark.range(20000).select(F.xxhash64("id").alias("h"), F.col("id").alias("row_id"))
    hot = [r.h for r in keys.limit(3).collect()]
    n = -(-20000 * orphans.BITS_PER_KEY // (orphans.WORDS * 64))
    blocks = orphans.bloom_blocks(keys, n)
    probed = orphans.probe(keys, blocks, n, hot, broadcast_limit=limit)
    assert probed.count() == 20000 and probed.filter("not maybe").count() == 0
    others = spark.range(100000, 120000).select(F.xxhash64("id").alias("h"), F.col("id").alias("row_id"))
    assert orphans.probe(others, blocks, n, hot, broadcast_limit=limit).filter("maybe").count() < 20000 * 0.05


def test_salted_join_of_hot_keys(spark):
    left = spark.range(30000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")).withColumn("h", F.xxhash64("k"))
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).withColumn("h", F.xxhash64("k"))
    hot = hot_keys(left.select("h"), "h")
    assert len(hot) == 1
    a = salted_left_join(left, right, ["k"], "h", "row", hot)
    b = salted_left_join(left, right, ["k"], "h", "row", [])
    assert a.count() == 30000 and a.select("row", "v").exceptAll(b.select("row", "v")).count() == 0


# -- 5 ---------------------------------------------------------------------------------------------------------------------------


def test_compositions_and_cycles():
    ways = units.compose(units.MOLAR_EDGES, "pmol/L")
    assert ways["nmol/L"](2.5) == pytest.approx(2500) and ways["pX"](9) == pytest.approx(1000) and ways["fmol/mL"](3) == pytest.approx(3)
    assert "h" not in ways and "ng/mL" not in ways
    k = units.compose([units.Edge("C", "K", 1, 273.15), units.Edge("C", "F", 1.8, 32)], "K")
    assert k["F"](212) == pytest.approx(373.15)
    with pytest.raises(ValueError, match="inconsistent"):
        units.check_cycles([units.Edge("a", "b", 10), units.Edge("b", "c", 10), units.Edge("a", "c", 1000)])
    logs = [units.Edge("p", "log", -1), units.Edge("log", "M", 1, 0, exp10=True), units.Edge("M", "uM", 1e6)]
    units.check_cycles([*logs, units.Edge("log", "uM", 1, 6, exp10=True)])
    with pytest.raises(ValueError, match="inconsistent"):
        units.check_cycles([*logs, units.Edge("log", "uM", 1, 5, exp10=True)])


def test_every_dimension_has_its_unit(spark, save):
    rows = [(1, 2.0, "h"), (2, 3.0, "μg／mL"), (3, 50.0, "рercent"), (4, 1.5, "g/kg"), (5, 7.0, "pKi"), (6, 7.0, "furlongs"), (7, None, "min"), (8, 4.0, None), (9, 5.0, "ratio"), (10, 5.0, "mg/m²")]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], "record_id long, value_numeric double, unit string, value_text string, column_header string, context_text string")
    got = {r.record_id: (r.canonical_unit, r.value) for r in pq.p5_converted(spark, save(assay_records=df)).collect()}
    assert got == {1: ("s", 7200.0), 2: ("ng/mL", 3000.0), 3: ("%", 50.0), 4: ("mg/kg", 1500.0), 5: ("pmol/L", 100000.0), 6: (None, None), 7: ("s", None), 8: (None, None), 9: ("fold", 5.0), 10: ("mg/m2", 5.0)}


P5_CASES = [
    # unit, value, value_text, column_header, context_text, picomolar
    ("nM", 5.0, None, None, None, None), ("uM", 0.5, None, None, None, 500000), ("µM", 0.5, None, None, None, 500000), ("nМ", 2.0, None, None, None, 2000), ("um", 1.0, None, None, None, 1000000),
    ("x10-6 mol/L", 1.0, None, None, None, 1000000), ("10^-9 M", 4.0, None, None, None, 4000), ("pKi", 7.0, None, None, None, 100000), ("nmol/mL", 1.0, None, None, None, 1000000), ("fmol／mL", 7.0, None, None, None, 7),
    ("%", 50.0, None, None, None, None), ("ng/mL", 5.0, None, None, None, None), ("h", 5.0, None, None, None, None), ("", 5.0, "5 nM", None, None, None), ("uM", None, None, None, None, None), ("uM", float("nan"), None, None, None, None),
    (None, 59.0, "59 nM", None, None, 59000), (None, 2.09, "2.0910^-9 M (3)", None, None, 2090), (None, 7.1e-05, "~7.1x10^-05uM", None, None, 71), (None, 1.93e4, "1.93x10^+04 10^-9 M*", None, None, 19300000), (None, 1060.0, "1,060 10^-9 M", None, None, 1060000),
    (None, 5.0, "5", "ABC Kd [uM]", None, 5000000), (None, 5.0, "5", "ABC Kd in nM", None, 5000), (None, 5.0, "5", "Inhibition at 10 uM", None, None), (None, 5.0, "5", "Kd", "All Ki values in this table are given in nM.", 5000),
    (None, 5.0, "5", "Kd", "Substrate was held at 28 μM throughout.", None), (None, 5.0, "5", "Kd", "Table 3. EC50 data (pmol/L).", 5), (None, 5.0, "5", None, None, None), (None, 5.0, None, None, "Ki values, expressed as 10^-9 M, are means of 2 runs.", 5000),
]


def test_p5_cases(spark, save):
    rows = [(i, v, u, t, h, c) for i, (u, v, t, h, c, _) in enumerate(P5_CASES)]
    df = spark.createDataFrame(rows, "record_id long, value_numeric double, unit string, value_text string, column_header string, context_text string").withColumn("pre_a", F.lit("clash"))
    got = {r.record_id: r.value_pm for r in pq.p5_found(spark, save(assay_records=df)).collect()}
    assert got == {i: c[5] for i, c in enumerate(P5_CASES) if c[5] is not None}
    assert pq.p5_found(spark, save(assay_records=df.limit(0))).count() == 0


# -- 6 ---------------------------------------------------------------------------------------------------------------------------


def _dump(spark, rows):
    full = [(i, *r[:3], r[3], r[4], r[5], r[6], r[7], T(r[8])) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "dump_row long, patent_id string, cid string, assay_name string, value_numeric double, qualifier string, letter_grade string, range_lo double, range_hi double, loaded_at timestamp")


def test_p6_on_small_tables(spark, save):
    rows = [
        ("P", "1", "Log D", 1.0, None, None, None, None, 0), ("P", " Ex 1", "log  d ", 2.0, None, None, None, None, 5), ("P", "1", "Class", None, None, "A", None, None, 0), ("P", "1", "class", None, None, "A", None, None, 1),
        ("P", "2", "Log D", 3.0, ">", None, None, None, 0), ("P", "2", "Log D", 3.0, None, None, None, None, 0), (None, "3", "Log D", 4.0, None, None, None, None, 0), ("P", None, "Log D", 9.0, None, None, None, None, 0),
        ("P", "4", None, 1.0, None, None, None, None, 0), ("P", "5", "%", 1.0, None, None, None, None, 0), ("P", "5", "Log-D", None, None, "B", 1.0, None, 0), ("P", "5", "Log-D", None, None, "B", None, 1.0, 0),
    ]
    d = save(reader_dump=_dump(spark, rows))
    assert {tuple(r) for r in pq.p6_found(spark, d).collect()} == {("P", "1", "log d"), ("P", "2", "log d"), ("P", "5", "log-d")}
    w = {(r.patent_id, r.cid): r for r in pq.p6_wide(spark, d).collect()}
    assert len(w) == 5 and set(pq.p6_wide(spark, d).columns) == {"patent_id", "cid", "unnamed", "unnamed__conflict", "pct", "pct__conflict", "class__grade", "class__conflict", "log_d", "log_d__qualifier", "log_d__conflict", "log_d_2__grade", "log_d_2__lo", "log_d_2__hi", "log_d_2__conflict"}
    assert w[("P", "1")]["log_d"] == 2.0 and w[("P", "1")]["class__grade"] == "A" and w[(None, "3")]["log_d"] == 4.0 and w[("P", "4")]["unnamed"] == 1.0
    assert w[("P", "1")]["log_d__conflict"] and not w[("P", "1")]["class__conflict"] and w[("P", "2")]["pct__conflict"] is None
    assert (w[("P", "5")]["log_d_2__grade"], w[("P", "5")]["log_d_2__hi"]) == ("B", 1.0)
    empty = save(reader_dump=_dump(spark, rows).limit(0))
    assert pq.p6_found(spark, empty).count() == 0 and pq.p6_wide(spark, empty).count() == 0


@pytest.mark.parametrize("block", [1, 4, 16])
def test_p6_equals_brute_force_for_any_block(spark, block):
    rng = random.Random(2)
    rows = [(rng.choice(["P", "Q"]), str(rng.randint(1, 5)), f"a{rng.randint(1, 9)}", rng.choice([None, 1.0, 2.0]), rng.choice([None, ">"]), None, None, None, rng.randint(0, 3)) for _ in range(200)]
    df, keys = _dump(spark, rows), ["patent_id", "cid"]
    attributes = wide.discover(df, "assay_name", {"value_numeric": F.col("value_numeric").isNotNull(), "any": F.lit(True)})
    cells = wide.numbered(wide.resolve_cells(df, keys, "assay_name", pq._FACTS, ["loaded_at", "dump_row"]), attributes, "assay_name")
    flags = wide.unpivot_blocks(wide.pivot_blocks(cells, keys, F.col("conflict"), block), keys, attributes, "a", block).filter("value")
    facts = {}
    for r in rows:
        facts.setdefault(r[:3], set()).add(r[3:8])
    assert {tuple(r)[:3] for r in flags.collect()} == {k for k, v in facts.items() if len(v) > 1}
    blocks = wide.pivot_blocks(cells, keys, F.struct("value_numeric", "conflict"), block)
    w = wide.widen(blocks, keys, attributes, {"": ("value_numeric", "value_numeric", "double"), "__conflict": ("any", "conflict", "boolean")}, block)
    assert w.count() == len({r[:2] for r in rows}) and len(w.columns) == 2 + 2 * 9
    got = {(r.patent_id, r.cid, a): r[f"{a}__conflict"] for r in w.collect() for a in {x[2] for x in rows} if r[f"{a}__conflict"] is not None}
    assert got == {k: len(v) > 1 for k, v in facts.items()}
