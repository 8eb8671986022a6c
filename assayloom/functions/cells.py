"""Column functions over single cells, names and headings. All are built-in expressions, so they stay inside code generation.

Patterns avoid look-around, so that the same ones run in Java and RE2 engines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells that state nothing.
NULL_MARKERS = ["", "-", "--", "—", "–", "nd", "nt", "na", "n/a", "n.d.", "n.t.", "n.a.", "not determined", "not tested"]
# Placeholder assay names.
PLACEHOLDER_NAMES = ["unnamed", "assay (unnamed)", "assay (binned)"]
# Factors of molar units to nanomolar.
TO_NM = {"pM": 1e-3, "nM": 1.0, "uM": 1e3, "mM": 1e6, "M": 1e9}
# Mass shifts of common adducts.
ADDUCT_SHIFTS = {"+H": 1.00728, "-H": -1.00728, "+Na": 22.98922}
# Salt endings, in the order they are tried.
SALT_SUFFIXES = ["hydrochloride", "hydrobromide", "hydroiodide", "sulfate", "sulphate", "trihydrate", "dihydrate", "hydrate", "mesylate", "tosylate", "oxalate", "citrate", "maleate", "fumarate", "acetate salt", "salt"]
# Metrics of an assay heading, the first that occurs counts.
METRICS = [("pIC50", r"(?i)\bpIC ?50\b"), ("pEC50", r"(?i)\bpEC ?50\b"), ("pKi", r"(?i)\bpKi\b"), ("pKd", r"(?i)\bpKd\b"), ("IC50", r"(?i)\bIC[ _-]?50\b"), ("EC50", r"(?i)\bEC[ _-]?50\b"), ("IC90", r"(?i)\bIC[ _-]?90\b"), ("EC90", r"(?i)\bEC[ _-]?90\b"), ("CC50", r"(?i)\bCC[ _-]?50\b"), ("GI50", r"(?i)\bGI[ _-]?50\b"), ("ED50", r"(?i)\bED[ _-]?50\b"), ("MIC", r"\bMIC\b"), ("Emax", r"(?i)\bEmax\b"), ("Ki", r"(?i)\bKi\b|inhibition constant"), ("Kd", r"(?i)\bKd\b|dissociation constant"), ("% inhibition", r"(?i)(% ?inh|percent inh|pct inh|inhibition \(%\))"), ("clearance", r"(?i)\bclearance\b"), ("half-life", r"(?i)(half-life|t1/2)"), ("solubility", r"(?i)\bsolubility\b"), ("log D", r"(?i)\blog ?[DP]\b")]
SPECIES = r"(?i)\b(human|mouse|murine|mice|rat|dog|canine|monkey|cynomolgus|cyno|rabbit|bovine|porcine|hamster|guinea pig)\b"
# The concentration or dose an assay ran at, with its route; the factors of concentrations to micromolar.
DOSE = r"(?i)\b(?:at )?([0-9][0-9.]*(?: ?, ?[0-9.]+)*) ?(mg/kg|[uµμ]g/ml|[numpµμ]?M\b|%)((?: ?, ?(?:p\.?o\b\.?|i\.?[vp]\b\.?|s\.?c\b\.?))?)"
DOSE_TO_UM = {"nm": 1e-3, "um": 1.0, "µm": 1.0, "μm": 1.0, "mm": 1e3, "pm": 1e-6, "m": 1e6}
#: A threshold that is in no list: IC20, ED90, LD50.
THRESHOLD = r"(?i)\b(IC|EC|GI|CC|ED|LD|TD)[ -]?([0-9]{2})\b"
# Units as headings write them. The first in the text counts; a lone M is molar only in brackets.
UNIT_FORMS = [
    ("nM", r"\bnM\b|nmol/[lL]|\bnanomolar\b|10\^?-9 ?M"),
    ("uM", r"[uµμ]M\b|[uµμ]mol/[lL]|\bmicromolar\b|10\^?-6 ?M"),
    ("pM", r"\bpM\b|pmol/[lL]|\bpicomolar\b"),
    ("mM", r"\bmM\b|mmol/[lL]|\bmillimolar\b"),
    ("M", r"[\[(] ?M ?[\])]|\bmol/[lL]|\bmolar\b"),
    ("%", r"%|\b[Pp]ercent\b|\bpct\b"),
]


def blank_trim(c: Column) -> Column:
    """Outer white space of any kind cut."""
    return F.regexp_replace(c, r"^[\s\x{00A0}]+|[\s\x{00A0}]+$", "")


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, null without a match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def is_null_marker(c: Column) -> Column:
    return F.lower(blank_trim(c)).isin(NULL_MARKERS)


#: A label word before an id, and the word for number; either may touch a digit.
CID_LABELS = [r"(?i)^(?:examples?|ex|compounds?|cmpds?|cpds?|entry|entries)(?:[.:#\s]+|([0-9]))", r"(?i)^(?:nos?|numbers?)(?:[.:#\s]+|([0-9]))"]


def normalize_cid(c: Column) -> Column:
    """Compound id without its label words and leading zeros; a text of other shape stays, unless it is longer than 40 characters (then ''). Null stays null."""
    t = blank_trim(c)
    for label in CID_LABELS:
        t = blank_trim(F.regexp_replace(t, label, "$1"))
    t = F.regexp_replace(t, r"^#\s*", "")
    shape = r"^([A-Za-z]{0,4}-?)0*([0-9]+)([A-Za-z]{0,2})$"
    return F.when(c.isNull(), None).when(t.rlike(shape), F.concat(F.regexp_extract(t, shape, 1), F.regexp_extract(t, shape, 2), F.regexp_extract(t, shape, 3))).when(F.length(t) <= 40, t).otherwise("")


def id_shape(c: Column) -> Column:
    """Skeleton of an id: letters A, digit runs 9."""
    return F.regexp_replace(F.regexp_replace(blank_trim(c), r"[A-Za-z]", "A"), r"[0-9]+", "9")


def id_family(c: Column) -> Column:
    """Family of an id: label words cut, digit runs #, a suffix letter dropped (``I-0268`` and ``I-7b`` are both ``I-#``)."""
    t = blank_trim(F.regexp_replace(c, r"^[\s\"'“”‘’]+|[\s\"'“”‘’]+$", ""))
    for label in CID_LABELS:
        t = blank_trim(F.regexp_replace(t, label, "$1"))
    return F.regexp_replace(F.regexp_replace(t, r"[0-9]+", "#"), r"#[A-Za-z]$", "#")


def is_cid_shaped(c: Column) -> Column:
    return blank_trim(c).rlike(r"^(?:[A-Za-z]{1,4}-?)?[0-9]{1,4}[A-Za-z]{0,2}$")


def is_placeholder_name(c: Column) -> Column:
    return F.lower(blank_trim(c)).isin(PLACEHOLDER_NAMES)


def patent_number(c: Column) -> Column:
    """Grant number of a US id (digits only); a publication number (year first, 11 digits) keeps its form; else null."""
    d = F.regexp_replace(F.upper(blank_trim(c)), r"^US|[AB][0-9]?$|[^0-9A-Z]", "")
    return F.when(d.rlike(r"^(?:19|20)[0-9]{9}$|^[0-9]{6,8}$"), d)


def unit_from(c: Column) -> Column:
    """First unit in a heading, in canonical spelling; null if none. Spelled-out and per-litre forms fold to molar ones."""
    found = F.regexp_extract(c, "|".join(p for _, p in UNIT_FORMS), 0)
    return F.coalesce(*[F.when(found.rlike(f"^(?:{p})$"), F.lit(u)) for u, p in UNIT_FORMS])


def to_nm(value: Column, unit: Column) -> Column:
    """Value in nanomolar; null for a unit that is no molar concentration."""
    factors = F.create_map(*[x for k, v in TO_NM.items() for x in (F.lit(k), F.lit(v))])
    return value * F.try_element_at(factors, F.translate(unit, "µμ", "uu"))


def parse_value(c: Column) -> Column:
    """One cell as struct(value_numeric, qualifier, unit, n_runs, letter_grade, annotation); all null if it states nothing.

    Order: null marker, qualified mean and deviation with unit, replicates and footnote marks, letter grade A-E, plus signs, stars or hashes, then a qualified number with unit,
    bracket (up to three digits are a replicate count, anything else a note) and footnote marks.
    """
    t = F.translate(c, "   −–≦≧≈", "   --≤≥~")
    t = blank_trim(F.replace(F.replace(t, F.lit(">="), F.lit("≥")), F.lit("<="), F.lit("≤")))
    unit = r"(%|[numpµμ]?M|[numpµμ]mol/[lL])?"
    mean = r"^([<>~≥≤])? ?([0-9][0-9,]*\.?[0-9]*) ?(?:±|\+/-|\+-) ?[0-9.,]+ ?" + unit + r"[ ,;]*(?:\(? ?n ?= ?([0-9]{1,3}) ?\)?)?[ ,;]*[*#]*$"
    number = r"^([<>~≥≤=])? ?(-?(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)((?: ?[x×] ?10\^?[-+]?[0-9]+)?) ?" + unit + r" ?(?:\(([^)]*)\))? ?[*#†]*$"
    is_null, is_mean, is_number = is_null_marker(t), t.rlike(mean), t.rlike(number)
    is_grade = t.rlike(r"^[A-Ea-e]$|^\++$|^\*+$|^#+$")
    power = extract(F.regexp_extract(t, number, 3), r"10\^?([-+]?[0-9]+)")
    # mantissa and power are read as one number, which rounds once
    digits = F.regexp_replace(F.regexp_extract(t, number, 2), ",", "")
    plain = F.when(power.isNull(), digits).otherwise(F.concat(digits, F.lit("e"), power)).try_cast("double")
    value = F.when(is_mean, F.regexp_replace(F.regexp_extract(t, mean, 2), ",", "").try_cast("double")).when(is_number, plain)
    paren = extract(t, number, 5)
    n_runs = F.when(is_mean, extract(t, mean, 4)).when(is_number & paren.rlike(r"^[0-9]{1,3}$"), paren).try_cast("int")
    out = {
        "value_numeric": (value, "double"),
        "qualifier": (F.when(is_mean, extract(t, mean, 1)).when(is_number, extract(t, number, 1)), "string"),
        "unit": (F.when(is_mean, extract(t, mean, 3)).when(is_number, extract(t, number, 4)), "string"),
        "n_runs": (n_runs, "int"),
        "letter_grade": (F.when(is_grade, F.upper(t)), "string"),
        "annotation": (F.when(is_number & ~paren.rlike(r"^[0-9]{1,3}$"), paren), "string"),
    }
    return F.struct(*[F.when(is_null | (is_grade & F.lit(k != "letter_grade")), None).otherwise(v).cast(ty).alias(k) for k, (v, ty) in out.items()])


def missing_fields(cid: Column, name: Column, value: Column, lo: Column, hi: Column, unit: Column) -> Column:
    """Names of what a record lacks to be usable, in fixed order."""
    return F.array_compact(
        F.array(
            F.when(cid.isNull() | (cid == ""), "cid"),
            F.when(name.isNull() | (name == "") | F.lower(name).contains("unnamed"), "assay_name"),
            F.when(value.isNull() & lo.isNull() & hi.isNull(), "value"),
            F.when(unit.isNull() | (unit == ""), "unit"),
        )
    )


def metric_of(c: Column) -> Column:
    """The first metric of the ordered list that the heading names."""
    return F.coalesce(*[F.when(c.rlike(p), F.lit(m)) for m, p in METRICS])


def axes(c: Column) -> Column:
    """Assay heading as struct(metric, target, dose, dose_um, species).

    The target is what stands before the metric, without dose, unit and species; a heading that opens with its metric gives what is left
    without the metrics. Underscores count as blanks; a threshold in no list is read as it is written. dose_um is null for several
    doses and for ones that are no concentration.
    """
    name = F.translate(c, "_", " ")
    known = metric_of(name)
    general = F.when(name.rlike(THRESHOLD), F.concat(F.upper(F.regexp_extract(name, THRESHOLD, 1)), F.regexp_extract(name, THRESHOLD, 2)))

    def clean(t: Column) -> Column:
        for p in (DOSE, r"(?i)\( ?[numpµμ]?M ?\)|\( ?% ?\)|\bnM\b|[uµμ]M\b", SPECIES, r"[()\[\]]"):
            t = F.regexp_replace(t, p, " ")
        return F.nullif(F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"^[ \-,;:.]+|[ \-,;:.]+$", ""), F.lit(""))

    before = F.coalesce(*[F.when(name.rlike(p), F.get(F.split(name, p, 2), F.lit(0))) for _, p in [*METRICS, ("", THRESHOLD)]])
    left = reduce(lambda t, p: F.regexp_replace(t, p, " "), [p for _, p in METRICS], name)
    number, unit, route = (F.regexp_extract(name, DOSE, i) for i in (1, 2, 3))
    dose = F.nullif(F.trim(F.concat(number, F.lit(" "), unit, route)), F.lit(""))
    factor = F.try_element_at(F.create_map(*[x for k, v in DOSE_TO_UM.items() for x in (F.lit(k), F.lit(v))]), F.lower(unit))
    dose_um = F.when(~number.contains(","), number.try_cast("double")) * factor
    species = F.lower(extract(name, SPECIES))
    return F.struct(F.coalesce(known, general).alias("metric"), F.coalesce(clean(before), clean(left)).alias("target"), dose.alias("dose"), dose_um.alias("dose_um"), species.alias("species"))


def band(lo: Column, hi: Column, unit: Column) -> Column:
    """Interval as text: ``lo - hi unit``, ``<hi unit``, ``>lo unit``; null without bounds."""
    n = lambda c: F.regexp_replace(F.format_string("%.4f", c), r"\.?0+$", "")
    body = F.when(lo.isNotNull() & hi.isNotNull(), F.concat(n(lo), F.lit(" - "), n(hi))).when(hi.isNotNull(), F.concat(F.lit("<"), n(hi))).when(lo.isNotNull(), F.concat(F.lit(">"), n(lo)))
    return F.when(body.isNotNull(), F.concat_ws(" ", body, unit))


def dewrap(c: Column) -> Column:
    """White space beside brackets, hyphens and commas removed, as line wrapping leaves it."""
    return F.regexp_replace(F.regexp_replace(c, r"\s*([-\[\]{}(),])\s+", "$1"), r"\s+([-\]}),])", "$1")


def dewrap_candidates(c: Column) -> Column:
    """Readings of a wrapped name, in order and without repeats: as it is, targeted, without any white space."""
    return F.array_distinct(F.array(c, dewrap(c), F.regexp_replace(c, r"\s+", "")))


def looks_chemical(c: Column) -> Column:
    """Chemistry-shaped text: three or more of the marks of systematic names and few blanks."""
    marks = F.length(c) - F.length(F.translate(c, "-[(,", ""))
    blanks = F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    return (marks >= 3) & (blanks * 10 < F.length(c))


def strip_salt(c: Column) -> Column:
    """One salt ending removed, the first of the list that fits; null if none does."""
    low = F.lower(F.trim(c))
    return F.coalesce(*[F.when(low.endswith(" " + s), F.trim(F.substr(low, F.lit(1), F.length(low) - len(s)))) for s in SALT_SUFFIXES])


def retention(a: Column, b: Column) -> Column:
    """Share of ``a`` kept in ``b``: 1 - edit distance / length, not below 0."""
    return F.greatest(F.lit(0.0), 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.lit(1)))


def coverage(accepted: Column, text: Column) -> Column:
    """Length ratio of letters and digits if the accepted text lies within the other, else 0."""
    plain = lambda c: F.upper(F.regexp_replace(c, r"[^A-Za-z0-9]", ""))
    a, t = plain(accepted), plain(text)
    return F.when((F.length(a) > 0) & F.contains(t, a), F.length(a) / F.length(t)).otherwise(F.lit(0.0))


def value_shape(c: Column) -> Column:
    """Shape of a cell: empty, num, cid, bin or text."""
    t = blank_trim(F.coalesce(c, F.lit("")))
    return (
        F.when(t == "", "empty")
        .when(t.rlike(r"^[<>~≥≤=]? ?-?[0-9][0-9,]*\.[0-9]+(?:[eE][-+]?[0-9]+)?|^[<>~≥≤] ?[0-9]"), "num")
        .when(t.rlike(r"^(?:[A-Za-z]{1,4}-?)?[0-9]{1,4}[A-Za-z]{0,2}$"), "cid")
        .when(t.rlike(r"^[A-E]$|^\++$|^\*+$"), "bin")
        .otherwise("text")
    )


# Negative logarithms, which are their own unit.
P_METRIC = r"(?i)\bp ?(?:IC|EC|K) ?_?(?:50|i|d)\b"
P_UNITS = ["pIC50", "pEC50", "pKi", "pKd"]
#: Header rules in order of precedence; the first that fits names the kind.
HEADER_KINDS = [
    ("assay", r"(?i)(IC[ _-]?50|EC[ _-]?50|\bK[id]\b|inhibition|\binh\b).*([numpµμ]M\b|mol/l|molar)"),
    ("nmr", r"(?i)\bNMR\b"),
    ("mw", r"(?i)(\bMW\b|\bmol\.? ?w|molecular weight)"),
    ("ms", r"(?i)(\bMS\b|m/z|\bLC-?MS\b|M ?\+ ?H)"),
    ("rt", r"(?i)(retention|\bRT\b|\bpurity\b|\bmethod\b)"),
    ("structure", r"(?i)\bstructure\b"),
    ("nruns", r"(?i)^(n|n runs|runs|replicates)$"),
    ("substituent", r"^(R[0-9]*|Ar[0-9]*|X|Y|Z)$"),
    ("cid", r"(?i)^(example|ex\.?|compound|cmpd\.?|cpd\.?|entry|no\.?|#)( ?(no\.?|number|id|#))?$"),
    ("assay", r"(?i)(IC[ _-]?50|EC[ _-]?50|\bp?K[ _-]?[id]\b|inhibition|% ?inh|\binh\b|clearance|half-life|solubility|\bpotency\b|\bactivity\b)"),
]


def header_kind(header: Column, unit: Column | None = None) -> Column:
    """Kind of a column by its header; a molar unit alone makes it an assay; else unknown."""
    known = F.coalesce(*[F.when(header.rlike(p), F.lit(k)) for k, p in HEADER_KINDS])
    return F.coalesce(known, F.when((unit if unit is not None else unit_from(header)).isin(list(TO_NM)), F.lit("assay")), F.lit("unknown"))


# Dimension of each unit class.
DIMENSIONS = {"conc": r"^(?:[numpµμ]?M|[numpµμ]?mol/[lL])$", "percent": r"^(?:%|percent|pct)$", "dose": r"^m?g/kg$", "ratio": r"^(?:fold|ratio|x)$"}


def dimension(unit: Column) -> Column:
    return F.coalesce(*[F.when(unit.rlike(p), F.lit(d)) for d, p in DIMENSIONS.items()])


def compatible(column_unit: Column, key_unit: Column) -> Column:
    """False only where both units have a dimension and these differ."""
    return F.coalesce(dimension(column_unit) == dimension(key_unit), F.lit(True))
