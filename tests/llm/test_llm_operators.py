import random
import re
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assayloom.llm import canon, contamination, lookalike, packing, queries, splitting
from assayloom.llm.tokens import DEFAULT_VOCABULARY, Tokenized, counter

# -- tokens ----------------------------------------------------------------------------------------------------------------------


def _reference_encoding():
    import base64

    import tiktoken

    with open(DEFAULT_VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("reference", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


_REFERENCE = _reference_encoding()
_TEXT = st.text(alphabet="ab Z9.,'\n\r\t\xa0　é日µ😀_-\x1c", max_size=60)


@settings(max_examples=300, deadline=None)
@given(_TEXT)
def test_counts_equal_the_public_pattern(text):
    assert counter().count(text) == len(_REFERENCE.encode_ordinary(text))
    ends = counter().ends(text)
    assert len(ends) == counter().count(text) and (not len(ends) or ends[-1] == len(text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab Z9.,\n é日😀'", max_size=400), st.integers(0, 400), st.integers(0, 400))
def test_parts_count_as_on_their_own(text, a, b):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    assert Tokenized(text, counter()).count(a, b) == counter().count(text[a:b])


# -- 9: splitting ----------------------------------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab Z9.,\n\r é日😀́-", max_size=600), st.integers(5, 60), st.integers(0, 4))
def test_pieces_cover_the_text_within_the_limit(text, limit, overlap):
    pieces = list(splitting.split_text(text, limit, overlap, counter()))
    covered = 0
    for start, end, n, over in pieces:
        assert n == counter().count(text[start:end]) <= limit
        assert start + over == covered and end > covered or not text
        assert counter().count(text[start : start + over]) <= overlap or over == 0
        covered = end
    assert covered == len(text)


def test_pieces_end_at_the_strongest_boundary():
    text = "Alpha beta gamma. Delta epsilon zeta.\n\nEta theta iota. Kappa lambda mu.\n\n"
    pieces = list(splitting.split_text(text, counter().count(text) * 2 // 3, 0, counter()))
    assert [text[a:b] for a, b, *_ in pieces] == ["Alpha beta gamma. Delta epsilon zeta.\n\n", "Eta theta iota. Kappa lambda mu.\n\n"]


@pytest.mark.parametrize("text", ["ACGT" * 3000, "MKTAYIAKQRQISFVKSHFSRQ" * 300, "e\u0301" * 2000, "漢字仮名" * 800, "First words. " + "GATTACA" * 1500 + " last words."])
def test_unbroken_runs_overlap(text):
    pieces = list(splitting.split_text(text, 100, 20, counter()))
    assert len(pieces) > 3 and all(n == counter().count(text[a:b]) <= 100 for a, b, n, _ in pieces)
    for (_, before, _, _), (start, _, _, over) in zip(pieces, pieces[1:], strict=False):
        # no word begins in the end of the piece before, so as many characters are repeated as fit
        assert start + over == before and 10 <= counter().count(text[start:before]) <= 20
        assert not unicodedata.combining(text[start])


def test_a_long_word_that_fits_is_not_cut():
    word = "=" * 12000  # 188 tokens
    text = "Some words before. " + word + " and words after." * 300
    pieces = list(splitting.split_text(text, 512, 64, counter()))
    assert any(word in text[a:b] for a, b, *_ in pieces)


def test_an_overlap_may_be_many_characters_long():
    text = "first words " * 80 + ("=" * 64 + " ") * 200
    pieces = list(splitting.split_text(text, 60, 20, counter()))
    assert max(over for *_, over in pieces) > 10 * 20 and all(n <= 60 for _, _, n, _ in pieces)


def test_split_documents_edge_cases(spark):
    long = "word " * 3000
    df = spark.createDataFrame([(1, long, "x"), (2, None, "x"), (3, "", "x"), (4, "short", "x"), (5, "q" * 9000, "x"), (6, long, "y")], "doc_id long, text string, piece string")
    rows = splitting.split_documents(df, 100, 10).collect()
    assert {r.doc_id for r in rows} == {1, 5, 6}
    assert all(r.n_tokens <= 100 for r in rows)
    assert [(r.char_start, r.char_end) for r in rows if r.doc_id == 1] == [(r.char_start, r.char_end) for r in rows if r.doc_id == 6]
    assert splitting.split_documents(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        splitting.split_documents(df, 10, 10)


# -- 7: packing ------------------------------------------------------------------------------------------------------------------


def test_pack_is_within_capacity_and_tight():
    rng = np.random.default_rng(1)
    sizes = np.sort(np.minimum(1000, rng.lognormal(5, 1, 5000).astype(int) + 1))[::-1]
    seq = packing.pack(sizes, 1000)
    fill = np.bincount(seq, weights=sizes)
    assert fill.max() <= 1000
    assert sizes.sum() / (len(fill) * 1000) > 0.98


def test_pack_balances_cost():
    seq = packing.pack(np.array([60, 60, 20, 20, 20, 20]), 100)
    assert sorted(np.bincount(seq, weights=[60, 60, 20, 20, 20, 20])) == [100, 100]


def test_pack_documents_places_everything_once(spark):
    texts = [(i, "tok " * n) for i, n in enumerate([0, 1, 5, 300, 60, 60, 60, 60])] + [(99, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = packing.pack_documents(df, 64).collect()
    assert {r.doc_id for r in rows} == set(range(8))
    for i, t in texts[:-1]:
        mine = sorted((r.token_start, r.n_tokens) for r in rows if r.doc_id == i)
        n = counter().count(t)
        assert sum(x for _, x in mine) == n
        assert len(mine) == max(1, -(-n // 64)) and [a for a, _ in mine] == [64 * k for k in range(len(mine))]
    by: dict = {}
    for r in rows:
        by[r.container_id] = by.get(r.container_id, 0) + r.n_tokens
    assert max(by.values()) <= 64
    assert packing.pack_documents(df.limit(0), 64).count() == 0


# -- 8: evaluation passages ------------------------------------------------------------------------------------------------------


def _brute(docs, items, span=12):
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    grams = lambda w: {tuple(w[i : i + span]) for i in range(len(w) - span + 1)}
    known = {i: grams(words(t)) for i, t in items if t}
    return {(d, i) for d, t in docs if t for i, g in known.items() if g & grams(words(t))}


def test_shared_spans_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ü", "µM", "K"]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [make(rng.randint(5, 40)) for _ in range(40)]
    docs = []
    for i in range(300):
        w = make(rng.randint(0, 60))
        if rng.random() < 0.6:
            it = rng.choice(items)
            n = rng.choice([10, 11, 12, 13, 30])
            a = rng.randint(0, max(0, len(it) - n))
            w[rng.randint(0, len(w)) : 0] = it[a : a + n]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    docs += [(1000, None), (1001, ""), (1002, "a " * 5000), (1003, docs[0][1])]
    rows = [(i, " ".join(t)) for i, t in enumerate(items)] + [(500, None), (501, ""), (502, "a " * 30)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame(rows, "item_id long, text string")
    found = contamination.shared_spans(d, t).collect()
    assert {(r.doc_id, r.item_id) for r in found} == _brute(docs, rows)
    assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    assert all(r.n_words >= 12 for r in found)
    assert contamination.shared_spans(d, t.limit(0)).count() == 0
    assert contamination.shared_spans(d.limit(0), t).count() == 0


@pytest.mark.parametrize("limit", [contamination.BROADCAST_LIMIT, 0])
def test_spans_have_their_whole_length(spark, monkeypatch, limit):
    monkeypatch.setattr(contamination, "BROADCAST_LIMIT", limit)
    item = " ".join(f"w{i}" for i in range(100))
    docs = [(1, item), (2, "x " + " ".join(f"w{i}" for i in range(20, 60)) + " y"), (3, " ".join(f"w{i}" for i in range(88, 100))), (4, " ".join(f"w{i}" for i in range(11)))]
    docs += [(5, " ".join(f"w{i}" for i in [*range(15), 99, *range(16, 40)]))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {r.doc_id: r.n_words for r in contamination.shared_spans(d, t).collect()} == {1: 100, 2: 40, 3: 12, 5: 24}


def test_the_sieve_keeps_every_hash_it_was_built_from(spark):
    t = spark.createDataFrame([(i, " ".join(f"t{i}n{k}" for k in range(40))) for i in range(300)], "item_id long, text string")
    all_prints = contamination.fingerprints(t, "item_id", "text")
    bits, n = contamination.sieve_of(all_prints)
    assert n == all_prints.count() and len(bits) == 1 << (contamination.SIEVE_BITS - 3)
    kept = contamination.fingerprints(t, "item_id", "text", bits)
    assert sorted(map(tuple, kept.select("id", "h", "at").collect())) == sorted(map(tuple, all_prints.select("id", "h", "at").collect()))
    few = contamination.fingerprints(t, "item_id", "text", contamination.sieve_of(all_prints.filter("id = 3"))[0])
    assert 3 in {r.id for r in few.collect()} and few.count() < all_prints.count() / 50


# -- 3: look-alikes --------------------------------------------------------------------------------------------------------------


def _model():
    counts: dict[str, int] = {}
    for word, n in {"phenyl": 50, "bromo": 50, "pyrazole": 50, "percent": 20, "m": 500, "h": 50, "n": 50, "nm": 300, "образец": 30, "oxo": 20}.items():
        w = f"^{word}$"
        for a, b in zip(w, w[1:], strict=False):
            counts[a + b] = counts.get(a + b, 0) + n
    return lookalike.normalizer(lookalike.Model(counts))


@pytest.mark.parametrize(
    ("raw", "form"),
    [
        ("ｎM", "nM"), ("nМ", "nM"), ("nΜ", "nM"), ("µM", "μM"), ("μМ", "μM"), ("рercent", "percent"), ("һ", "h"), ("М", "M"), ("n​M", "nM"), (" nM", " nM"), ("mg／kg", "mg/kg"), ("％", "%"),
        ("bromоphenyl", "bromophenyl"), ("1Н-pyrazole", "1H-pyrazole"), ("образец", "образец"), ("oбразец", "образец"), ("α-oxo", "α-oxo"), ("[α]D", "[α]D"), ("é", "é"), ("m²/g", "m²/g"), ("≥ 5 ± 1 °C", "≥ 5 ± 1 °C"),
        ("2‑bromo", "2-bromo"), ("ﬂuoro", "fluoro"), ("μοx", "μox"), ("plain  text\n", "plain  text\n"), ("", ""), ("nmol·L-1", "nmol·L-1"), ("日本", "日本"),
    ],
)
def test_consistent_forms(raw, form):
    normalize = _model()
    assert normalize(raw) == form
    assert normalize(form) == form


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_consistent_form_is_stable_and_visible(text):
    normalize = _model()
    once = normalize(text)
    assert normalize(once) == once
    assert not any(unicodedata.category(c) == "Cf" for c in once)


@pytest.mark.parametrize(
    ("raw", "form"),
    [
        ("phenѵl", "phenvl"), ("ᴏxo", "oxo"), ("ΑΒ 1О nM", "AB 10 nM"), ("4,З mg", "4,3 mg"), ("Ꮲhenyl", "Phenyl"), ("CH3О", "CH3O"), ("сор", "cop"), ("сор и образец", "сор и образец"),
        ("ᎠᎡᎢ", "ᎠᎡᎢ"), ("٥ nM", "٥ nM"), ("α-oxo", "α-oxo"), ("μM", "μM"),
    ],
)
def test_readings_of_other_scripts(spark, raw, form):
    counts = {"^o": 30, "ox": 20, "xo": 20, "o$": 30, "^p": 80, "ph": 80, "he": 60, "en": 60, "ny": 50, "yl": 50, "l$": 50, "^c": 5, "co": 5, "op": 5}
    normalize = lookalike.normalizer(lookalike.Model(counts), lookalike.confusables(spark))
    assert normalize(raw) == form
    assert normalize(form) == form


def test_p3_on_small_tables(spark, save):
    a = spark.createDataFrame([(1, "nM"), (2, "nМ"), (3, None), (4, ""), (5, "nM")], "record_id long, unit string")
    s = spark.createDataFrame([(7, "bromо"), (8, None)], "structure_id long, raw_cell string")
    got = {tuple(r) for r in queries.p3_found(spark, save(assay_records=a, structures=s)).collect()}
    assert got == {("assay_records", 2), ("structures", 7)}


# -- 1: names --------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("name", "parts"),
    [
        ("Margugu protease (MRG4) K d at pH 7.4", ("kd", "4", "margugu protease mrg")),
        ("IC₅₀, QBH2", ("ic50", "2", "qbh")),
        ("percent inhibition JortasubLigase3", ("% inhibition", "3", "jortasub ligase")),
        ("NOVAOST ligase II IC50 value", ("ic50", "2", "novaost ligase")),
        ("inhibition (%), Mjn_3", ("% inhibition", "3", "mjn")),
        ("Kd against h quabrupho 1", ("kd", "1", "quabrupho")),
        ("Kd in 10^-9 M", ("kd", "", "")),
        ("plasma t1/2", ("half-life", "", "plasma")),
        ("5-HT2A receptor pKi", ("pki", "2 5 a ht", "receptor")),
        ("ＥＧＦＲ T790M G.I. 50 (nM)", ("gi50", "790 m t", "egfr")),
        ("", ("", "", "")),
    ],
)
def test_names_are_taken_apart(name, parts):
    assert canon.normalise(name) == parts


@pytest.mark.parametrize(
    ("typed", "forms", "named"),
    [
        ("margugu prot", ["margugu protease", "mrg"], True),
        ("magrugu", ["margugu protease", "mrg"], True),
        ("protease", ["margugu protease", "mrg"], False),  # a class names no target
        ("margugu kinase", ["margugu protease", "mrg"], False),  # another word
        ("marguguprotease", ["margugu protease", "mrg"], True),
        ("mrh", ["margugu protease", "mrg"], False),  # short codes must be equal
        ("kinase", ["aurora ligase"], False),
        ("receptor", ["receptor"], True),  # 5-HT2A receptor: the rest are designators
        ("", ["factor"], False),
        ("", [""], True),
    ],
)
def test_typed_words_must_name_the_target(typed, forms, named):
    assert canon.names_target(typed, forms) is named


def _vocabulary(spark):
    rows = [(1, "Margugu protease 4 Kd", ["MRG4 Kd"]), (2, "Margugu protease 4 Ki", None), (3, "Jortasub ligase 5 Ki", ["JRB5 Ki", "Ki JRB-5"])]
    return spark.createDataFrame(rows, "vocab_id long, canonical string, surface_forms array<string>")


def test_names_map_to_entries(spark):
    typed = [
        (1, "Margugu protease 4 Kd", None, None), (2, "KD, margugu prot. IV", None, None), (3, "Magrugu protease 4 Ki", None, None), (4, "Margugu protease 5 Kd", None, None), (5, "unnamed", "jrb 5 inhibition constant", None),
        (6, None, None, None), (7, "", "", None), (8, "jortasub 5 Kd", None, None), (9, "Vavayth kinase 5 Ki", None, None), (10, "Ki", None, None), (11, "KD, margugu prot. IV", None, None), (12, "x" * 20000, None, None),
    ]
    df = spark.createDataFrame(typed, "record_id long, assay_name string, column_header string, vocab_id string")
    got = {r.record_id: r.vocab_id for r in canon.map_names(df, _vocabulary(spark)).collect()}
    assert got == {2: 1, 3: 2, 4: 0, 5: 3, 8: 0, 9: 0, 10: 0, 11: 1, 12: 0}
    assert canon.map_names(df.limit(0), _vocabulary(spark)).count() == 0
    assert {r.vocab_id for r in canon.map_names(df, _vocabulary(spark).limit(0)).collect()} == {0}


def test_ordinary_target_names(spark):
    listed = ["hERG IC50", "EGFR T790M IC50", "Aurora kinase A Ki", "Factor Xa Ki", "5-HT2A receptor Ki", "Margugu protease 4 Kd", "Aurora kinase B Ki", "Cathepsin K"]
    vocabulary = spark.createDataFrame([(i, n, None) for i, n in enumerate(listed, 1)], "vocab_id long, canonical string, surface_forms array<string>")
    typed = [
        ("herg ic50", 1), ("HERG IC-50 (nM)", 1), ("EGFR t790m: IC50", 2), ("aurora  kinase a ki", 3), ("Auroa kinase B Ki", 7), ("Factor Xa  Ki (nM)", 4), ("factor-Xa K i", 4), ("5-ht2a receptor inhibition constant", 5),
        ("Margugu protease IV KD", 6), ("cathepsin k", 8), ("Cathepsn K", 8), ("hERG Ki", 0), ("EGFR L858R IC50", 0), ("EGFR IC50", 0), ("Aurora kinase C Ki", 0), ("Factor VIIa Ki", 0), ("5-HT2B receptor Ki", 0), ("receptor Ki", 0), ("Cathepsin L", 0), ("kinase A Ki", 0),
    ]
    df = spark.createDataFrame([(i, n, None) for i, (n, _) in enumerate(typed)], "record_id long, assay_name string, column_header string")
    got = {r.record_id: r.vocab_id for r in canon.map_names(df, vocabulary).collect()}
    assert {typed[i][0]: v for i, v in got.items()} == dict(typed)


def test_a_long_list_needs_no_work_of_words_times_list(spark):
    rnd = random.Random(7)
    words = sorted({"".join(rnd.choice("bdfgklmnprstvz") + rnd.choice("aeiou") for _ in range(rnd.randint(3, 5))) for _ in range(30_000)})[:20_000]
    vocabulary = spark.createDataFrame([(i, f"{w.title()} receptor {i % 5 + 1} Ki", None) for i, w in enumerate(words)], "vocab_id long, canonical string, surface_forms array<string>")
    picked = rnd.sample(range(len(words)), 300)
    swap = lambda w: w[:3] + w[4] + w[3] + w[5:]
    df = spark.createDataFrame([(i, f"Ki, {swap(words[i])} rec. {i % 5 + 1}", None) for i in picked], "record_id long, assay_name string, column_header string")
    got = {r.record_id: r.vocab_id for r in canon.map_names(df, vocabulary).collect()}
    near = sum(v == i for i, v in got.items())
    assert len(got) == 300 and near >= 240  # others have two entries equally near
    assert all(v in (0, i) or canon._edits(swap(words[i]), words[v]) <= 2 for i, v in got.items())


def test_misspellings_of_unlisted_names_are_not_mapped(spark):
    typed = [(i, "Margagon kinase 4 Kd") for i in range(50)] + [(100, "Margagn kinase 4 Kd"), (101, "Margugo protease 4 Kd")]
    df = spark.createDataFrame([(i, n, None) for i, n in typed], "record_id long, assay_name string, column_header string")
    got = {r.record_id: r.vocab_id for r in canon.map_names(df, _vocabulary(spark)).collect()}
    assert got[100] == 0 and got[0] == 0 and got[101] == 1


def test_rare_unlisted_names_are_rejected_by_themselves(spark):
    targets = ["vagudor", "pratekfen", "qualanbel", "nomikel", "novaost"]
    vocabulary = spark.createDataFrame([(i, f"{t.title()} kinase 1 Ki", None) for i, t in enumerate(targets, 1)], "vocab_id long, canonical string, surface_forms array<string>")
    typed = ["Gudoryth", "Nopratek", "Vavayth", "Quafenost", "Vagduor", "Pratekfn", "Qualnbell"]
    for times in (1, 40):  # established or not
        df = spark.createDataFrame([(i, f"{t} kinase 1 Ki value", None) for i, t in enumerate(typed) for _ in range(times if i < 4 else 1)], "record_id long, assay_name string, column_header string")
        got = {r.record_id: r.vocab_id for r in canon.map_names(df, vocabulary).collect()}
        assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 5: 2, 6: 3}
