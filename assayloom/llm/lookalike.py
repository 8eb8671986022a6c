"""One consistent form for texts that look right but are made of other characters.

Compatibility forms are normalized, ignorable characters deleted and blanks made plain. What is left outside ASCII is decided per word: the
readings of each character (itself or its look-alike of another script) form a lattice, and Viterbi search picks the reading whose
character bigrams are most frequent within one script, counted over all the texts.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters that cannot be told from a Latin one.
TWINS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ԍ": "G", "Ү": "Y",
    "ο": "o", "ϲ": "c", "ϳ": "j", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
    "ɑ": "a", "ɡ": "g", "ı": "i", "օ": "o", "ո": "n", "ս": "u", "հ": "h",
}
# Letters that look like a Latin one only inside a Latin word.
NEAR_TWINS = {"ν": "v", "ρ": "p", "υ": "u", "ι": "i", "κ": "k", "χ": "x", "γ": "y", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "У": "Y"}
# Signs, hyphens and strokes that look like an ASCII one.
SIGNS = {"‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "⁃": "-", "﹣": "-", "∕": "/", "⁄": "/", "⧸": "/", "∗": "*", "∶": ":", "․": ".", "‚": ",", "‘": "'", "’": "'", "ʼ": "'", "“": '"', "”": '"', "∣": "|", "∼": "~", "˜": "~", "‹": "<", "›": ">", "ǃ": "!", "ˆ": "^", "⁎": "*"}

_SWITCH = -9.0
_NEAR = -5.0
#: For each letter of a word wholly of another script, in a text that has more of that script.
_OWN_WORD = -5.0
_BACK = {}
for _k, _v in {**TWINS}.items():
    _BACK.setdefault(_v, []).append(_k)


@dataclass(frozen=True)
class Readings:
    """Look-alikes beyond the fixed lists: ``letters`` hold for a letter inside a word of Latin letters, ``digits`` inside a number, ``exact``
    (small capitals) anywhere."""

    letters: dict[str, str] = field(default_factory=dict)
    digits: dict[str, str] = field(default_factory=dict)
    exact: dict[str, str] = field(default_factory=dict)


def confusables(spark: SparkSession) -> Readings:
    """Readings from the public confusables data that ICU, a part of Spark, carries: characters with the skeleton of an ASCII one."""
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    blocks = [c for c in map(chr, range(0x80, 0x10000)) if unicodedata.category(c) in ("Lu", "Ll", "Lo", "Nd") and not "\u3000" <= c <= "\udfff"]
    blocks = [c for c in blocks if unicodedata.normalize("NFKC", c) == c]
    plain = [c for c in map(chr, range(0x30, 0x7B)) if c.isalnum()]
    skeletons = checker.getSkeleton("\n".join(plain + blocks)).split("\n")
    known: dict[str, list[str]] = {}
    for c, k in zip(plain, skeletons, strict=False):
        known.setdefault(k, []).append(c)
    letters, digits, exact = {}, {}, {}
    for c, k in zip(blocks, skeletons[len(plain) :], strict=True):
        for a in known.get(k, []):
            if a.isdigit():
                digits[c] = a
            elif unicodedata.name(c, "").startswith("LATIN LETTER SMALL CAPITAL"):
                exact[c] = a
            elif script(c) != "LATIN" and c.isalpha() and (c.isupper() == a.isupper() or not c.isupper() and not c.islower()):
                letters.setdefault(c, a)
    return Readings({c: a for c, a in letters.items() if c not in TWINS and c not in NEAR_TWINS}, digits, {c: a for c, a in exact.items() if c not in TWINS})


_NO_MORE = Readings()
_ASCII = re.compile(r"[\t\n\r\x20-\x7e]*")
_LETTERS = re.compile(r"[^\W\d_]+")


@functools.lru_cache(maxsize=65536)
def script(ch: str) -> str:
    """Latin, Greek, Cyrillic, ... ; micro and the Greek letters without a Latin twin go with any word (they are symbols in formulas)."""
    name = unicodedata.name(ch, "")
    for s in ("LATIN", "GREEK", "CYRILLIC", "ARMENIAN"):
        if name.startswith(s):
            return s
    return "OTHER"


@functools.lru_cache(maxsize=65536)
def fold_char(ch: str) -> str:
    """Compatibility form of one character; superscripts, fractions, circled and squared signs stay as they are."""
    if ch in "\t\n\r":
        return ch
    if ch in SIGNS:
        return SIGNS[ch]
    cat = unicodedata.category(ch)
    if cat == "Zs":
        return " "
    if cat in ("Zl", "Zp") or ch == "\x85":
        return "\n"
    if cat in ("Cf", "Cc") or ch in "͏ᅟᅠ឴឵ㅤﾠ" or "︀" <= ch <= "️":
        return ""
    tag = unicodedata.decomposition(ch).split(" ")[0]
    if tag in ("<wide>", "<narrow>", "<font>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>"):
        to = unicodedata.normalize("NFKC", ch)
        if " " not in to and to != "...":
            return "".join(SIGNS.get(x, x) for x in to)
    return ch


class Model:
    """Joint frequencies of character bigrams within one script; ``^`` and ``$`` mark the ends of a word."""

    def __init__(self, counts: dict[str, int]):
        self.total = sum(counts.values()) + 1.0
        self.logs = {k: math.log((n + 0.5) / self.total) for k, n in counts.items()}
        self.unseen = math.log(0.5 / self.total)

    def __call__(self, a: str, b: str) -> float:
        return self.logs.get(a + b, self.unseen)


def read_word(word: str, model: Model, more: Readings = _NO_MORE, around: frozenset[str] = frozenset()) -> str:
    """Best reading of a run of letters. A run without any letter that has a twin stays.

    ``around``: scripts in which the text has letters without a twin; a word wholly of such a script is likelier one of its own words.
    """
    near = lambda c: NEAR_TWINS.get(c) or more.letters.get(c)
    exact = lambda c: TWINS.get(c) or more.exact.get(c)
    if not any(exact(c) or near(c) for c in word):
        return word
    scripts = {script(c) for c in word}
    anchors = {script(c) for c in word if not exact(c) and not near(c)} - {"LATIN", "OTHER", "GREEK"}
    single = len(word) == 1
    own_word = not single and len(scripts) == 1 and scripts <= around
    lattice: list[list[tuple[str, float]]] = []
    for c in word:
        ways = [(c, 0.0)]
        if exact(c):
            ways.append((exact(c), _OWN_WORD if own_word else 0.5))
        elif near(c) and not single:
            ways.append((near(c), _NEAR))
        elif anchors and c in _BACK:  # a Latin letter in a word that can only be of another script
            ways += [(b, 0.0) for b in _BACK[c] if script(b) in anchors]
        lattice.append(ways)
    best: dict[str, tuple[float, str]] = {c: (model("^", c.lower()) + w, c) for c, w in lattice[0]}
    for ways in lattice[1:]:
        step: dict[str, tuple[float, str]] = {}
        for c, w in ways:
            sc = script(c)
            options = []
            for p, (score, path) in best.items():
                sp = script(p)
                # a Greek symbol such as the micro sign may stand beside letters of any script
                neutral = (sp == "GREEK" and p not in TWINS) or (sc == "GREEK" and c not in TWINS)
                options.append((score + model(p.lower(), c.lower()) + (0.0 if sc == sp else -1.0 if neutral else _SWITCH), path + c))
            score, path = max(options)
            step[c] = (score + w, path)
        best = step
    return max((score + model(c.lower(), "$"), path) for c, (score, path) in best.items())[1]


def normalizer(model: Model, more: Readings = _NO_MORE) -> Callable[[str], str]:
    """text -> its one consistent form. Idempotent; plain ASCII comes back as it is, apart from control characters."""
    words: dict[tuple[str, frozenset[str]], str] = {}
    # a number in which some digits are other characters; beside a letter it is a part of a name
    digit = "0-9" + "".join(map(re.escape, more.digits))
    number = re.compile(rf"(?<!\w)(?=[{digit}.,]*[0-9])(?=[0-9.,]*[^\x00-\x7f])[{digit}.,]+(?!\w)") if more.digits else None

    def normalize(text: str) -> str:
        if _ASCII.fullmatch(text):
            return text
        text = unicodedata.normalize("NFC", "".join(map(fold_char, text)))
        if text.isascii():
            return text
        if number:
            text = number.sub(lambda m: "".join(more.digits.get(c, c) for c in m.group()), text)
        around = frozenset(s for s in {script(c) for c in text if c.isalpha() and not c.isascii() and c not in TWINS and c not in NEAR_TWINS} if s not in ("LATIN", "GREEK", "OTHER"))

        def word(m: re.Match) -> str:
            w = m.group()
            if w.isascii():
                return w
            if (w, around) not in words:
                if len(words) > 200_000:
                    words.clear()
                words[w, around] = read_word(w, model, more, around)
            return words[w, around]

        return _LETTERS.sub(word, text)

    return normalize


def script_bigrams(texts: list[DataFrame]) -> dict[str, int]:
    """Counts of character bigrams, in lower case, over all words of the texts that keep to one script.

    ``texts``: frames of one string column. Words are counted first (map-side combined), then their bigrams; the result is bounded by
    the squares of three alphabets.
    """
    words = reduce(DataFrame.unionByName, [t.select(F.explode(F.regexp_extract_all(F.col(t.columns[0]), F.lit(r"[\p{L}]+"), F.lit(0))).alias("w")) for t in texts])
    words = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter(F.col("w").rlike(r"^(?:\p{IsLatin}+|\p{IsGreek}+|\p{IsCyrillic}+)$"))
    padded = F.concat(F.lit("^"), F.lower("w"), F.lit("$"))
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("w") + 1), lambda i: F.substr(padded, i, F.lit(2)))).alias("g"), "n")
    return {r["g"]: r["n"] for r in grams.groupBy("g").agg(F.sum("n").alias("n")).collect()}


def needs_reading(c: Column) -> Column:
    """Texts with anything but printable ASCII and line breaks; all others are consistent already."""
    return c.rlike(r"[^\t\n\r\x20-\x7e]")


def consistent_form(counts: dict[str, int], more: Readings = _NO_MORE) -> Callable[[Column], Column]:
    """Column function: the consistent form of a text; null stays null."""

    @F.pandas_udf("string")
    def form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        normalize = normalizer(Model(counts), more)
        for s in batches:
            yield s.map(lambda x: None if x is None else normalize(x))

    return lambda c: F.when(needs_reading(c), form(F.when(needs_reading(c), c))).otherwise(c)
