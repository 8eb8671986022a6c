"""Mapping freely typed names to the entries of a reference list.

Distinct names are normalised into a measurement, designators (numbers and tokens of one or two letters) and target words. The whole
normalised text retrieves candidates from an inverted index of character n-grams over every form of every entry, common n-grams only where a
name has no rarer ones; candidates are scored by weighted cosine. A candidate must state the same measurement and designators, and every
typed word must be a spelling of one of its words. The best candidate is accepted above a threshold and by a margin over the next target.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.common import BROADCAST_LIMIT, written

#: Least cosine of an accepted candidate, and how far it must be ahead of the next target.
THRESHOLD = 0.2
MARGIN = 0.1
#: Distinct texts that one task weighs.
TEXTS_PER_TASK = 4000
#: Bytes of one posting in a broadcast table, generously.
POSTING_BYTES = 128
#: A word is a misspelling of another at most this many edits and this share of its letters away; words of four letters must be equal.
MOST_EDITS = 2
EDITS_SHARE = 1 / 3
SHORTEST_MISSPELT = 5

# Measurements written in words, in lower case, and the name they mean.
MEASURES = [
    ("ic50", r"half[ -]?maximal inhibitory conc(?:entration|\.)?"),
    ("ec50", r"half[ -]?maximal effective conc(?:entration|\.)?"),
    ("ki", r"\binhibit(?:ion|ory) constant|\bk[\s-]?i\b"),
    ("kd", r"\bdissociation constant|\bk[\s-]?d\b"),
    ("kb", r"\bk[\s-]?b\b"),
    ("% inhibition", r"(?:%|\b(?:percent|pct)\.?)\s?inh(?:ib(?:ition)?)?\b\.?|\binhib(?:ition)?\.?\s?\(%\)"),
    ("mic", r"\bminim(?:um|al) inhibitory conc(?:entration|\.)?|\bmic\b"),
    ("half-life", r"\bhalf[ -]?life\b|\bt\s?1/2\b"),
    ("clearance", r"\bclearance\b"),
    ("solubility", r"\bsolubility\b"),
]
#: A letter pair with a percentage, with or without a leading p for its negative logarithm: IC50, EC-50, GI 90, pIC50.
_PERCENTILE = re.compile(r"\b(p?)((?:i|e|g|l|c|a|x)\.?\s?(?:c|d|i))\.?[\s-]?([1-9]\d)\b")
_P_CONSTANT = re.compile(r"\bp[\s-]?k[\s-]?([idb])\b")
# Words that class a target but name none.
CLASS_WORDS = frozenset("receptor kinase protease ligase channel transporter phosphatase hydrolase enzyme protein synthase reductase oxidase transferase factor inhibitor agonist antagonist".split())
# Words that say nothing about the target.
_IDLE = frozenset("against value values assay assays test activity potency binding inhibition of in the for on at and with by to from using mean".split())
_SPECIES = r"\b(?:recombinant|human|rat|mouse|murine|dog|monkey|hum|rec)\b\.?"
_UNIT = r"(?:[x×]?10\^?-?\d+ ?(?:mol/l|m)|[numpfµμ]?mol/m?l|(?:nano|micro|milli|pico)?molar|mcm|[numpµμ]?m|[nuµμm]g/ml)"
_CONDITIONS = re.compile(
    rf"[*†‡§]|\((?:[a-d]|n ?= ?\d+)\)|[(\[]\s*(?:in )?{_UNIT}\s*[)\]]|,\s*{_UNIT}$|\bin {_UNIT}$|\bat ph ?[\d.]+|,\s*\d+ ?(?:min|h)\b|\bcell[- ]free\b|{_SPECIES}"
)
_ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}
_TOKEN = re.compile(r"[^\W\d_]+|\d+")


def _measure(s: str) -> tuple[str, str]:
    """(measurement, rest) of a lower-case name; the first of the list that occurs is taken out, an unstated one is ''."""
    m = _PERCENTILE.search(s) or _P_CONSTANT.search(s)
    if m:
        kind = "pk" + m[1] if m.re is _P_CONSTANT else m[1] + re.sub(r"[.\s]", "", m[2]) + m[3]
        return kind, s[: m.start()] + " " + s[m.end() :]
    for kind, pattern in MEASURES:
        rest, n = re.subn(pattern, " ", s, count=1)
        if n:
            return kind, rest
    return "", s


def normalise(name: str) -> tuple[str, str, str]:
    """(measurement, designators, target words) of a typed name. Each may be empty; designators are sorted and distinct.

    Full-width and subscript characters, case, underscores, runs of words and digits, Roman numerals at the end, species, units, conditions
    and footnote marks make no difference.
    """
    s = unicodedata.normalize("NFKC", name).replace("_", " ")
    s = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", s)
    s = re.sub(r"(?<=[A-Za-z]{3})(?=\d)", " ", s)
    s = " ".join(s.lower().split())
    measure, s = _measure(" ".join(_CONDITIONS.sub(" ", s).split()))
    tokens = [t for t in _TOKEN.findall(s) if t not in _IDLE]
    while len(tokens) > 1 and tokens[0] in ("h", "r", "m"):  # human, rat, mouse
        del tokens[0]
    if len(tokens) > 1:
        tokens[-1] = _ROMAN.get(tokens[-1], tokens[-1])
    words = [t for t in tokens if not t.isdigit() and len(t) > 2]
    return measure, " ".join(sorted({t for t in tokens if t.isdigit() or len(t) <= 2})), " ".join(words)


def _normalised(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([normalise(x) for x in names], columns=["measure", "marks", "words"])


def with_parts(df: DataFrame, name: str) -> DataFrame:
    """Add measure, marks (designators) and words of the name."""
    parts = F.pandas_udf(_normalised, "measure string, marks string, words string")
    return df.withColumn("_p", parts(F.col(name))).select(*df.columns, "_p.*")


def grams(text: Column) -> Column:
    """Distinct character bigrams and trigrams of a text with its ends marked."""
    s = F.concat(F.lit("^^"), text, F.lit("$$"))
    two = F.transform(F.sequence(F.lit(2), F.length(text) + 2), lambda i: F.substr(s, i, F.lit(2)))
    three = F.transform(F.sequence(F.lit(1), F.length(text) + 2), lambda i: F.substr(s, i, F.lit(3)))
    return F.array_distinct(F.concat(two, three))


def _edits(a: str, b: str) -> int:
    """Edit distance in which swapping neighbours is one edit."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, rows[-2][j - 2] + 1)
            row.append(d)
        rows.append(row)
    return rows[-1][-1]


def allowed(word: str) -> int:
    """Edits that a misspelling may be away from the word."""
    return 0 if len(word) < SHORTEST_MISSPELT else min(MOST_EDITS, int(len(word) * EDITS_SHARE))


def _spells(typed: str, word: str) -> bool:
    most = allowed(word)
    return typed == word or (most > 0 and abs(len(typed) - len(word)) <= most and typed not in CLASS_WORDS and _edits(typed, word) <= most)


def names_target(typed: str, forms: list[str], generic: frozenset[str] = CLASS_WORDS) -> bool:
    """Whether typed words name the target known by ``forms``.

    Every typed word must spell a word of the target, a whole form written in one, or be cut short from one (three letters at least);
    and either one of them is more than a class word and not cut short, or they make up a whole form.
    """
    if not typed:
        return "" in forms
    words = {w for f in forms for w in f.split()}
    whole = {f.replace(" ", "") for f in forms}
    if any(_spells(typed.replace(" ", ""), w) for w in whole):
        return True
    named, met = False, set()
    for t in typed.split():
        full = next((w for w in sorted(words) if _spells(t, w)), None)
        if full is not None:
            named, _ = named or full not in generic, met.add(full)
        elif any(_spells(t, w) for w in whole):
            named = True
        elif short := [w for w in words if len(t) > 2 and w.startswith(t)]:
            met.update(short)
        else:
            return False
    return named or any(set(f.split()) <= met for f in forms if f)


@dataclass(frozen=True)
class Index:
    """The inverted index of a list, stored once: ``forms`` (form_id, target, form, measure, marks, vocab_id), every way to write each
    entry, and ``postings`` (gram, measure, marks, form_id, idf, iw), whose weights make every form a vector of length 1."""

    forms: DataFrame
    postings: DataFrame
    n_forms: int
    #: whether the postings, counted, are within the bound of a broadcast
    small: bool

    def side(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df


def index_of(vocabulary: DataFrame) -> Index:
    """Entries with the same target words are one target; a form of one of them names the target in all of them, unless it is a form of
    several targets."""
    names = vocabulary.filter("canonical is not null").select("vocab_id", F.explode(F.array_union(F.array("canonical"), F.coalesce("surface_forms", F.array().cast("array<string>")))).alias("name"), (F.col("canonical")).alias("_c"))
    parts = written(with_parts(names.filter("name is not null"), "name"))
    entries = parts.filter("name = _c").select("vocab_id", F.col("words").alias("target"), "marks", "measure")
    aliases = parts.join(entries.select("vocab_id", "target"), "vocab_id").select("target", F.col("words").alias("form")).distinct()
    shared = aliases.filter("form <> target").groupBy("form").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("form")
    one = entries.filter("target <> '' or marks <> ''").groupBy("target", "marks", "measure").agg(F.min("vocab_id").alias("vocab_id"))
    forms = one.join(aliases.join(shared, "form", "left_anti"), "target").withColumn("form_id", F.xxhash64("target", "form", "marks", "measure"))
    forms = written(forms)
    size = forms.agg(F.count(F.lit(1)).alias("n"), F.sum(2 * (F.length("form") + F.length("marks")) + 7).alias("grams")).first()
    small = (size["grams"] or 0) * POSTING_BYTES <= BROADCAST_LIMIT
    each = forms.select("form_id", "measure", "marks", F.explode(grams(F.trim(F.concat_ws(" ", "form", "marks")))).alias("gram"))
    idf = each.groupBy("gram").agg(F.log((size["n"] + 1.0) / (F.count(F.lit(1)) + 0.5)).alias("idf"))
    each = each.join(idf, "gram")
    norms = each.groupBy("form_id").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("fn"))
    postings = each.join(norms, "form_id").filter("fn > 0").select("gram", "measure", "marks", "form_id", "idf", (F.col("idf") / F.col("fn")).alias("iw"))
    return Index(forms, written(postings), size["n"], small)


def best_entries(texts: DataFrame, index: Index, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """(measure, marks, words, vocab_id, score, margin) of each distinct text's accepted entry; texts without one are left out.

    A text's grams are probed from the heaviest down until the rest weighs less than half the threshold. What has not reached the other
    half by then cannot reach the threshold, so the common grams' long postings are left unread and no candidate above the threshold is
    lost. Candidates that are checked then get their whole cosine.
    """
    key = ["measure", "marks", "words"]
    shown = grams(F.trim(F.concat_ws(" ", "words", "marks")))
    idf = index.postings.groupBy("gram").agg(F.first("idf").alias("idf"))
    unseen = math.log((index.n_forms + 1) / 0.5)
    # a text is some fifty grams, so tasks are sized by texts and not by their few bytes; all that follows stays placed by the text's hash.
    # hashes only find candidates: these are checked on the text, its measurement and its designators themselves
    t = texts.select(*key, F.xxhash64(*key).alias("h")).repartition(max(1, math.ceil(texts.count() / TEXTS_PER_TASK)), "h")
    where = F.xxhash64("measure", "marks", "gram").alias("k")
    own = t.select("h", "measure", "marks", F.explode(shown).alias("gram")).join(index.side(idf), "gram", "left").select("h", where, F.coalesce("idf", F.lit(unseen)).alias("w"))
    square = F.sum(F.col("w") * F.col("w"))
    upto = square.over(Window.partitionBy("h").orderBy("w", "k").rowsBetween(Window.unboundedPreceding, 0))
    own = own.withColumns({"_upto": upto, "norm": F.sqrt(square.over(Window.partitionBy("h")))})
    probes = own.filter(F.col("_upto") >= threshold * threshold / 4 * F.col("norm") * F.col("norm"))
    hits = probes.join(index.side(index.postings.select(where, "form_id", "iw")), "k").groupBy("h", "norm", "form_id").agg(F.sum(F.col("w") * F.col("iw")).alias("dot"))
    hits = hits.filter(F.col("dot") >= threshold / 2 * F.col("norm"))
    known = index.forms.groupBy("target").agg(F.sort_array(F.collect_set("form")).alias("forms"))
    fits = F.pandas_udf(lambda typed, f: pd.Series([names_target(x, list(y)) for x, y in zip(typed, f, strict=True)], dtype=bool), "boolean")
    entry = index.forms.select("form_id", "target", "vocab_id", F.col("measure").alias("_measure"), F.col("marks").alias("_marks"))
    pairs = hits.join(index.side(entry), "form_id").groupBy("h", "norm", "target", "vocab_id", "_measure", "_marks").agg(F.collect_list("form_id").alias("ids"))
    pairs = pairs.join(t, "h").filter("measure = _measure and marks = _marks").join(index.side(known), "target").filter(fits("words", "forms"))
    full = pairs.select("h", *key, "norm", "target", "vocab_id", F.explode("ids").alias("form_id")).select("*", F.explode(shown).alias("gram"))
    full = full.join(index.side(index.postings.select("form_id", "gram", "idf", "iw")), ["form_id", "gram"]).groupBy("h", *key, "norm", "target", "vocab_id", "form_id").agg((F.sum(F.col("idf") * F.col("iw")) / F.col("norm")).alias("score"))
    named = full.groupBy("h", *key, "target", "vocab_id").agg(F.max("score").alias("score")).filter(F.col("score") >= threshold)
    ranked = named.groupBy("h", *key).agg(F.max(F.struct("score", "target", "vocab_id")).alias("best"), F.sort_array(F.collect_list("score"), asc=False).alias("all"))
    second = F.coalesce(F.try_element_at("all", F.lit(2)), F.lit(0.0))
    return ranked.select(*key, "best.vocab_id", "best.score", (F.col("best.score") - second).alias("margin")).filter(F.col("margin") >= margin)


def map_names(records: DataFrame, vocabulary: DataFrame, record_id: str = "record_id", name: str = "assay_name", fallback: str = "column_header", threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """(record_id, name, vocab_id, score): each record whose name is no form of the list character for character.

    The name is ``name``, or ``fallback`` if that is null, empty or contains "unnamed"; records without either are left out. vocab_id is
    0 where the name means no entry, which the name itself decides, however often it occurs. score is the cosine (null without an entry).
    Entries with a null canonical name are no entries; equal entries count as the one with the smallest vocab_id; an empty list maps
    every name to 0. Repeated records come out as often as they occur.
    """
    typed = F.when(F.col(name).isNull() | (F.col(name) == "") | F.lower(name).contains("unnamed"), F.col(fallback)).otherwise(F.col(name))
    rows = records.select(F.col(record_id).alias("record_id"), typed.alias("name")).filter("name is not null and name <> ''")
    forms = vocabulary.select(F.explode(F.array_union(F.array("canonical"), F.coalesce("surface_forms", F.array().cast("array<string>")))).alias("name")).filter("name is not null")
    rows = rows.join(forms.distinct(), "name", "left_anti")
    parts = written(with_parts(rows.select("name").distinct(), "name"))
    texts = parts.filter("words <> '' or marks <> ''").select("measure", "marks", "words").distinct()
    best = best_entries(texts, index_of(vocabulary), threshold, margin)
    found = parts.join(best, ["measure", "marks", "words"], "left").select("name", "vocab_id", "score")
    # a name may belong to a third of the rows: the few verdicts per distinct name meet the rows by a join that AQE splits where skewed
    return rows.join(found, "name", "left").select("record_id", "name", F.coalesce("vocab_id", F.lit(0).cast("long")).alias("vocab_id"), "score")
