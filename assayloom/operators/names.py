"""Readings of damaged chemical names: span variants, wrapped and misread forms, corruption patterns, and the gates a repair must pass.

Candidates are generated here; whether a name parses is asked of a resolver port (none by default).
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.functions import cells as fn

_PAIRS = {")": "(", "]": "[", "}": "{"}
#: Glyphs that recognisers confuse, as alternatives of one site.
_SITES = re.compile(r"(?<=\d)[lI](?=[,\-])|(?<=[,\-])[lI](?=[,\-\d])|(?<=\d)O(?=[,\-])|rn(?=eth)|vv")
_TAIL = re.compile(r"\s+(?:acid|ester|amide|anhydride|chloride|bromide|iodide|hydrochloride|sulfate|acetate|formate|oxide|salt|hydrate)\b", re.IGNORECASE)
_SEED = re.compile(r"[A-Za-z0-9(\[{)\]}'′,.+\-]{5,}")
_ANCHOR = re.compile(r"[\-)\]}]")
#: Share of a text's letters and digits that a seed must cover, so that no reading is a mere fragment.
SEED_COVERAGE = 0.75
_LETTER_SPACE = re.compile(r"(?<=[A-Za-z])\s+(?=[A-Za-z])")
_DOUBLED = re.compile(r"[)\]}]\s+[)\]}]")
_LOST_OPENER = re.compile(r"[^()]{1,12}\)")
_NAME_END = re.compile(r"(?:acid|carboxylate|amide|amine|nitrile|ester|oxide|one|ol|ate|ide|ine|yl)s?\b", re.IGNORECASE)
#: Locants as recognisers break them: a blank after a hyphen or comma, a full stop for a comma, a lost hyphen.
_LOCANTS = [(re.compile(r"(?<=[\d,\-])\s+(?=[\da-z])"), ""), (re.compile(r"(?<=\d)\.(?=\d+-)"), ","), (re.compile(r"(?<=[a-z)\]])(?=\d(?:,\d)*-)"), "-")]
_READINGS = {"l": ["1"], "I": ["1"], "O": ["0"], "rn": ["m"], "vv": ["w"]}


def unmatched(text: str) -> tuple[list[int], list[int]]:
    """Positions of openers and closers without a partner."""
    stack: list[tuple[str, int]] = []
    closers = []
    for i, ch in enumerate(text):
        if ch in "([{":
            stack.append((ch, i))
        elif ch in _PAIRS:
            if stack and stack[-1][0] == _PAIRS[ch]:
                stack.pop()
            else:
                closers.append(i)
    return [i for _, i in stack], closers


def balanced(text: str) -> str:
    """The text without trailing openers' debt: cut at the last point where brackets balance, or the text if they do."""
    openers, closers = unmatched(text)
    if not openers and not closers:
        return text
    if closers:
        return text[: closers[0]]
    return text[: openers[0]].rstrip(" -,")


def balanced_left(text: str) -> str:
    """The text behind its last bracket without a partner, or the text if there is none."""
    openers, closers = unmatched(text)
    return text[max(openers + closers, default=-1) + 1 :]


def balanced_both(text: str) -> str:
    """The text behind its last closer without a partner, up to where openers remain open."""
    _, closers = unmatched(text)
    return balanced(text[max(closers, default=-1) + 1 :])


def span_variants(text: str, start: int, end: int) -> list[str]:
    """Ordered readings of a span: raw, with the tail word behind it, balanced from the right, left and both, without up to three lead words,
    from each of the first four inner boundaries on."""
    raw = text[start:end]
    tail = _TAIL.match(text, end)
    out = [raw, *([text[start : tail.end()]] if tail else []), balanced(raw), balanced_left(raw), balanced_both(raw)]
    words = raw.split(" ")
    for k in range(1, min(4, len(words))):
        lead = " ".join(words[k:])
        out += [lead, balanced(lead)]
    out += [balanced(raw[m.end() :]) for m in itertools.islice(_ANCHOR.finditer(raw), 4)]
    return [raw, *(x.strip(" \t.,;:-") for x in out[1:])]


def variants(text: str) -> list[str]:
    """Ordered readings of a text without repeats: those of the whole, without stereo prefix, de-wrapped, and those of each name-like run
    that covers ``SEED_COVERAGE`` of its letters and digits."""
    flat = re.sub(r"\s*([\-\[\](){},])\s*", r"\1", text)
    whole = span_variants(text, 0, len(text))
    out = [*whole[:1], flat, re.sub(r"^\((?:[RSEZ±+\-](?:,\s*)?)+\)-", "", text), *whole[1:], re.sub(r"\s+", "", text)]
    size = lambda x: sum(map(str.isalnum, x))
    for m in _SEED.finditer(flat):
        if re.search("[a-z]{3}", m.group()) and size(m.group()) >= SEED_COVERAGE * size(flat):
            out += span_variants(flat, *m.span())
    return [x for x in dict.fromkeys(x.strip() for x in out) if x]


def _trimmed(text: str) -> Iterator[str]:
    """The text, and without what follows its last name-ending word."""
    yield text
    ends = [m.end() for m in _NAME_END.finditer(text)]
    if ends and ends[-1] < len(text):
        yield text[: ends[-1]]


def _opened(text: str) -> Iterator[str]:
    """The text, and with the bracket lost at its start."""
    yield text
    if text.startswith(")"):
        rest = text[1:].lstrip("- ")
        yield from [*(f"({x})-{rest}" for x in "EZRS"), rest]
    elif _LOST_OPENER.match(text):
        yield "(" + text


def _closed(text: str) -> Iterator[str]:
    """The text, and with either one of two closers in a row."""
    yield text
    for m in _DOUBLED.finditer(text):
        yield text[: m.start()] + text[m.end() - 1 :]
        yield text[: m.start() + 1] + text[m.end() :]


def _spaced(text: str, most: int = 3) -> Iterator[str]:
    """The text, and if it has at most ``most`` blanks between letters, each of them kept, closed or read as a lost closer."""
    sites = list(_LETTER_SPACE.finditer(text))
    sites = sites if len(sites) <= most else []
    for pick in itertools.product(*[[m.group(), "", ")"] for m in sites]):
        yield _put(text, sites, pick)


def _put(text: str, sites: list[re.Match[str]], pick: tuple[str, ...]) -> str:
    s, at = "", 0
    for m, g in zip(sites, pick, strict=True):
        s += text[at : m.start()] + g
        at = m.end()
    return s + text[at:]


def _glyphs(text: str, most: int) -> Iterator[str]:
    """Each of the first ambiguous glyphs read either way, as it stands and with its locants mended."""
    found = list(_SITES.finditer(text))[:most]
    for pick in itertools.product(*[[m.group(), *_READINGS[m.group()]] for m in found]):
        s = _put(text, found, pick)
        yield s
        for site, fix in _LOCANTS:
            s = site.sub(fix, s)
        yield s


def misread(text: str, sites: int = 4, least: int = 40) -> list[str]:
    """Readings of a recognised caption of at least ``least`` characters, the plainest first: annotation trimmed, lost and doubled brackets,
    blanks between letters, each of the first ``sites`` ambiguous glyphs either way, and locants."""
    if len(text) < least:
        return [text]
    made = (g for t in _trimmed(text) if len(t) >= least for o in _opened(t) for c in _closed(o) for s in _spaced(c) for g in _glyphs(s, sites))
    return list(dict.fromkeys(made))


@dataclass(frozen=True)
class Pattern:
    """A kind of damage: its sites with what they become, and whether the mended name may stand without corroboration in the document."""

    pattern_id: str
    sites: Callable[[str], Iterator[tuple[int, int, str]]]
    trusted: bool = False


#: Characters behind an open bracket among which its lost partner is sought.
CLOSE_WINDOW = 60
_PARTNER = {v: k for k, v in _PAIRS.items()}
# A footnote number fused onto a name; two letters before it, so that a deuterium label (-d4) stays.
FOOTNOTE = r"[a-z]{2}[0-9]+$"
# A substituent in square brackets whose round bracket never opened: [5-methylpyridin-2-yl)
LOST_PAREN = r"\[[0-9][0-9A-Za-z_,'*-]*-yl\)"
# A locant, then 1- in place of the bracket: -4-1-trifluoromethoxy)
DIGIT_PAREN = r"-[0-9]{1,2}-1-[A-Za-z]{4,25}\)"
# ey in place of ch: eyloro
EY = r"ey[a-z]{2}"


def _footnote(name: str) -> Iterator[tuple[int, int, str]]:
    yield from ((m.start() + 2, m.end(), "") for m in re.finditer(FOOTNOTE, name.rstrip()))


def _lost_paren(name: str) -> Iterator[tuple[int, int, str]]:
    yield from ((m.start() + 1, m.start() + 1, "(") for m in re.finditer(LOST_PAREN, name))


def _digit_paren(name: str) -> Iterator[tuple[int, int, str]]:
    for m in re.finditer(DIGIT_PAREN, name):
        at = m.start() + m.group().index("-1-", 1) + 1
        yield at, at + 2, "("


def _ey(name: str) -> Iterator[tuple[int, int, str]]:
    yield from ((m.start(), m.start() + 2, "ch") for m in re.finditer(EY, name))


def _stray_closers(name: str) -> Iterator[tuple[int, int, str]]:
    yield from ((i, i + 1, "") for i in unmatched(name)[1])


def _stray_openers(name: str) -> Iterator[tuple[int, int, str]]:
    yield from ((i, i + 1, "") for i in unmatched(name)[0])


def _lost_closers(name: str) -> Iterator[tuple[int, int, str]]:
    """Every place behind an open bracket: there need be no sign where its partner was."""
    for i in unmatched(name)[0]:
        yield from ((k, k, _PARTNER[name[i]]) for k in range(i + 2, min(len(name), i + 1 + CLOSE_WINDOW) + 1))


# The names of the patterns; rules of a library refer to them.
PATTERNS = [
    Pattern("footnote_digit_tail", _footnote, True),
    Pattern("dropped_open_paren", _lost_paren, True),
    Pattern("digit_for_paren", _digit_paren),
    Pattern("ch_as_ey", _ey),
    Pattern("stray_closing_bracket", _stray_closers),
    Pattern("stray_opening_bracket", _stray_openers),
    Pattern("dropped_close_bracket", _lost_closers),
]


def repairs(name: str) -> Iterator[tuple[str, bool, str, str]]:
    """(pattern_id, trusted, repaired, fragment around the change) of each candidate, one change each, without repeats."""
    seen: set[tuple[str, str]] = set()
    for p in PATTERNS:
        for start, end, put in p.sites(name):
            fixed = name[:start] + put + name[end:]
            if fixed != name and (p.pattern_id, fixed) not in seen:
                seen.add((p.pattern_id, fixed))
                yield p.pattern_id, p.trusted, fixed, fixed[max(0, start - 12) : start + 12]


_LABELLED = re.compile(r"(?:Example|Compound|Cmpd|Cpd|Ex|Step|Intermediate)\.?\s*(?:No\.?\s*)?[0-9]+[a-z]?\s*[:.)\-]?\s*|(?:Preparation|Synthesis|Production|Manufacture)\s+of\s+|[\s:;,.)\-]+", re.IGNORECASE)
_BEHIND = re.compile(r"\s*(?:\((?:Compound|Example|Cpd|Ex)\.?\s*[0-9]+[a-z]?\)|was (?:obtained|prepared|isolated).*)$", re.IGNORECASE | re.DOTALL)


def without_framing(text: str) -> str:
    """A line without what frames a name: labels and numbers before it, ``preparation of``, its number or a report behind it."""
    at = 0
    while (m := _LABELLED.match(text, at)) and m.end() > at:
        at = m.end()
    return _BEHIND.sub("", text[at:]).strip(":;,. \t").rstrip("([{ ")


def texts_after_ids(texts: DataFrame, doc: str, text: str, ids: DataFrame, lines: int = 3, span: int = 500, gap: int = 120, least: int = 8) -> DataFrame:
    """(doc, id, line, name_text): where a compound's name may stand after its labelled number.

    The region after an occurrence ends at the next one, after ``lines`` more lines or ``span`` characters; a line that begins more than ``gap``
    characters behind is too far, one shorter than ``least`` without its framing is no name. For a number in brackets, the run of name
    characters before it counts as well. Numbers that are no id of the document (doc, id) give nothing.
    """
    site = re.compile(r"(?:Example|Compound|Cmpd|Cpd|Ex)\.?\s*(?:No\.?\s*)?([0-9]+[a-z]?)\b|\(([0-9]+[a-z]?)\)")

    def one(t: str) -> list[dict]:
        found = list(site.finditer(t))
        out = []
        for k, m in enumerate(found):
            stop = min(found[k + 1].start() if k + 1 < len(found) else len(t), m.end() + span)
            at = m.end()
            for n, raw in enumerate(t[m.end() : stop].split("\n")[: lines + 1]):
                name = without_framing(raw)
                if at + len(raw) - len(raw.lstrip()) - m.end() > gap:
                    break
                if len(name) >= least:
                    out.append({"id": m.group(1) or m.group(2), "line": n, "name_text": name})
                at += len(raw) + 1
            if m.group(2):
                before = re.search(r"[^\s.;:]+(?: acid| ester)?\s*$", t[max(0, m.start() - span) : m.start()])
                if before and len(name := without_framing(before.group())) >= least:
                    out.append({"id": m.group(2), "line": 0, "name_text": name})
        return out

    read = F.pandas_udf(lambda s: s.map(lambda x: one(x) if x else []), "array<struct<id:string,line:int,name_text:string>>")
    hits = texts.select(doc, F.explode(read(F.col(text))).alias("_h")).select(doc, "_h.*")
    return hits.join(ids.select(doc, "id").dropna().distinct(), [doc, "id"]).select(doc, "id", "line", "name_text")


def vertical_names(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cid, name): names that stand below an id in one column and run on over the lines after it.

    cells (keys, row_ix, text) of a single column: a line that is an id opens an entry, the lines up to the next are its name, joined
    without a blank where the one before ends in a hyphen, comma or bracket.
    """
    from pyspark.sql import Window

    t = fn.blank_trim(F.col("text"))
    is_id = fn.is_cid_shaped(t) & t.rlike("[0-9]")
    s = cells.filter(t != "").withColumn("_e", F.count_if(is_id).over(Window.partitionBy(*keys).orderBy("row_ix").rowsBetween(Window.unboundedPreceding, 0))).filter("_e > 0")
    lines = F.transform(F.array_sort(F.collect_list(F.when(~is_id, F.struct("row_ix", t.alias("t"))))), lambda x: x["t"])
    g = s.groupBy(*keys, "_e").agg(F.max(F.when(is_id, fn.normalize_cid(t))).alias("cid"), lines.alias("_l")).filter("size(_l) > 0")
    joined = F.aggregate("_l", F.lit(""), lambda a, b: F.when(a.rlike(r"[-,(\[{]$") | (a == ""), F.concat(a, b)).otherwise(F.concat(a, F.lit(" "), b)))
    return g.select(*keys, "cid", joined.alias("name")).filter(fn.looks_chemical(F.col("name")))


def candidates(names: DataFrame, name: str, of: Callable[[str], list[str]] = variants) -> DataFrame:
    """One row per reading: all columns, ``rank`` and ``candidate``. Distinct names are read once per batch."""
    read = F.pandas_udf(lambda s: s.map(lambda x: of(x) if x else []), "array<string>")
    return names.select("*", F.posexplode(read(F.col(name))).alias("rank", "candidate"))


def repair_candidates(names: DataFrame, name: str) -> DataFrame:
    """One row per repair: all columns, pattern_id, trusted, repaired, fragment."""

    def one(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [{"pattern_id": a, "trusted": b, "repaired": c, "fragment": d} for a, b, c, d in repairs(x)] if x else [])

    made = F.pandas_udf(one, "array<struct<pattern_id:string,trusted:boolean,repaired:string,fragment:string>>")
    return names.select("*", F.explode(made(F.col(name))).alias("_r")).select("*", "_r.*").drop("_r")


def corroborated(repaired: DataFrame, texts: DataFrame, key: str, row: str, text: str, gram: int = 8) -> DataFrame:
    """Repairs that are trusted, or whose fragment (white space aside) occurs in another row's text of the same key.

    ``row`` identifies a name's own text in both inputs. Texts and fragments meet on the fragment's first ``gram`` characters, not as all
    pairs of a key; a fragment shorter than that is not corroborated.
    """
    plain = lambda c: F.regexp_replace(c, r"\s+", "")
    probes = repaired.filter("not trusted").select(key, F.col(row).alias("_own"), "repaired", plain(F.col("fragment")).alias("_f")).filter(F.length("_f") >= gram).withColumn("_g", F.substr("_f", F.lit(1), F.lit(gram)))
    t = texts.select(key, F.col(row).alias("_row"), plain(F.col(text)).alias("_t")).filter(F.length("_t") >= gram)
    grams = t.select("*", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_t") - gram + 1), lambda i: F.substr(F.col("_t"), i, F.lit(gram))))).alias("_g"))
    hits = grams.join(probes, [key, "_g"]).filter(F.contains("_t", F.col("_f")) & (F.col("_row") != F.col("_own"))).select(key, F.col("_own").alias(row), "repaired").distinct()
    return repaired.filter("trusted").unionByName(repaired.filter("not trusted").join(hits, [key, row, "repaired"], "left_semi"))


def accepted(name: Column, repaired: Column, least: float = 0.9) -> Column:
    """The gate on how much of a name a repair keeps."""
    return fn.retention(name, repaired) >= least


def collateral(clean: DataFrame, name: str) -> DataFrame:
    """(pattern_id, share): share of clean names that each pattern would touch. No names, no shares."""
    touched = F.pandas_udf(lambda s: s.map(lambda x: [next(p.sites(x or ""), None) is not None for p in PATTERNS]), "array<boolean>")
    wide = clean.select(touched(name).alias("t")).agg(*[F.avg(F.get("t", F.lit(i)).cast("double")).alias(p.pattern_id) for i, p in enumerate(PATTERNS)])
    return wide.unpivot([], [p.pattern_id for p in PATTERNS], "pattern_id", "share").filter("share is not null")


def first_accepted(resolved: DataFrame, keys: list[str], order: list[str], ok: Column) -> DataFrame:
    """The first accepted candidate per key."""
    from pyspark.sql import Window

    return resolved.filter(ok).withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def resolve(names: DataFrame, name: str, keys: list[str], resolver, of: Callable[[str], list[str]] = variants) -> DataFrame:  # noqa: ANN001
    """First reading of each name that the resolver accepts: keys, candidate, rank, smiles, inchikey; names without one have a reason.

    Distinct readings are resolved once and joined back by value, never by position.
    """
    read = candidates(names, name, of).select(*keys, "rank", "candidate")
    answers = resolver.resolve(read.select(F.col("candidate").alias("name")).distinct()).withColumnRenamed("name", "candidate")
    best = first_accepted(read.join(answers, "candidate"), keys, ["rank"], F.col("smiles").isNotNull())
    out = names.select(*keys).distinct().join(best.select(*keys, "candidate", "rank", "smiles", "inchikey"), keys, "left")
    return out.withColumn("reason", F.when(F.col("smiles").isNull(), "no reading accepted"))


def failure_signature(error: Column, name: Column) -> Column:
    """Class of a parse failure: kind of the message and kind of the token it names, with its place in the name (start, middle, end)."""
    kind = F.when(error.rlike("(?i)unparsable|uninterpretable"), "unparsable").when(error.rlike("(?i)bracket|parenthes"), "brackets").when(error.rlike("(?i)locant"), "locant").when(error.rlike("(?i)stereo"), "stereo").otherwise("other")
    token = F.regexp_extract(error, r"'([^']*)'", 1)
    at = F.locate(token, name) if isinstance(token, str) else F.call_function("instr", name, token)
    place = F.when((token == "") | (at == 0), "unknown").when(at * 3 <= F.length(name), "start").when(at * 3 <= 2 * F.length(name), "middle").otherwise("end")
    shape = F.when(token == "", "none").when(token.rlike("^[0-9]+$"), "digits").when(token.rlike(r"^[\[\](){}]+$"), "brackets").when(token.rlike("^[A-Za-z]+$"), "letters").otherwise("mixed")
    return F.concat_ws("|", kind, shape, place)


def escalated(attempts: DataFrame, epoch: int, most: int = 3) -> DataFrame:
    """Failure classes written off in this epoch: at least ``most`` failed attempts and no adopted pattern."""
    g = attempts.filter(F.col("epoch") == epoch).groupBy("signature").agg(F.count_if(~F.col("adopted")).alias("failed"), F.bool_or("adopted").alias("_ok"))
    return g.filter((F.col("failed") >= most) & ~F.col("_ok")).select("signature", "failed")
