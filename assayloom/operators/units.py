"""Unit conversion as a graph of affine edges.

Nodes are units, an edge says how a value in one unit becomes a value in the other. Shortest compositions to a canonical unit are computed
once on the driver, cycles are checked for consistency, and values are converted by one equi-join on the source unit.
"""

from __future__ import annotations

import math
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Edge:
    """value_dst = a * value_src + b; with ``exp10`` set, value_dst = 10 ** (a * value_src + b)."""

    src: str
    dst: str
    a: float
    b: float = 0.0
    exp10: bool = False

    def inverse(self) -> Edge | None:
        return None if self.exp10 else Edge(self.dst, self.src, 1 / self.a, -self.b / self.a)


@dataclass(frozen=True)
class Path:
    """post_a * f(pre_a * v + pre_b) + post_b, where f is 10 ** x if ``exp10`` else the identity."""

    pre_a: float = 1.0
    pre_b: float = 0.0
    exp10: bool = False
    post_a: float = 1.0
    post_b: float = 0.0

    def then(self, e: Edge) -> Path:
        if not self.exp10:
            pre = (self.pre_a * e.a, self.pre_b * e.a + e.b)
            return Path(*pre, exp10=e.exp10)
        if e.exp10:
            raise ValueError("two exponentials in one path")
        return Path(self.pre_a, self.pre_b, True, self.post_a * e.a, self.post_b * e.a + e.b)

    def __call__(self, v: float) -> float:
        x = self.pre_a * v + self.pre_b
        return self.post_a * (10**x if self.exp10 else x) + self.post_b


# Decimal steps of amount concentrations and what p-values mean.
MOLAR_EDGES = [
    Edge("mol/L", "mmol/L", 1e3),
    Edge("mmol/L", "umol/L", 1e3),
    Edge("umol/L", "nmol/L", 1e3),
    Edge("nmol/L", "pmol/L", 1e3),
    Edge("pmol/L", "fmol/L", 1e3),
    Edge("mol/L", "umol/L", 1e6),
    Edge("umol/L", "pmol/L", 1e6),
    Edge("mmol/mL", "mol/L", 1.0),
    Edge("umol/mL", "mmol/L", 1.0),
    Edge("nmol/mL", "umol/L", 1.0),
    Edge("pmol/mL", "nmol/L", 1.0),
    Edge("fmol/mL", "pmol/L", 1.0),
    Edge("pX", "log10 mol/L", -1.0),
    Edge("log10 mol/L", "log10 pmol/L", 1.0, 12.0),
    Edge("log10 pmol/L", "pmol/L", 1.0, 0.0, exp10=True),
    Edge("g/L", "mg/L", 1e3),
    Edge("mg/L", "ug/L", 1e3),
    Edge("ug/mL", "mg/L", 1.0),
    Edge("ng/mL", "ug/L", 1.0),
    Edge("d", "h", 24.0),
    Edge("h", "min", 60.0),
    Edge("min", "s", 60.0),
    Edge("s", "ms", 1e3),
    Edge("g/kg", "mg/kg", 1e3),
    Edge("mg/kg", "ug/kg", 1e3),
    Edge("mL/min/mg", "uL/min/mg", 1e3),
    Edge("ratio", "fold", 1.0),
]

# The unit in which each measured dimension comes out.
CANONICAL = {"amount concentration": "pmol/L", "mass concentration": "ng/mL", "share": "%", "time": "s", "dose": "mg/kg", "dose per area": "mg/m2", "clearance": "uL/min/mg", "ratio": "fold", "counts": "cpm"}

# Spellings of units, after folding look-alike characters, blanks removed. Case matters only where listed.
SPELLINGS = {
    "mol/L": ["M", "mol/L", "mol/l", "molar", "Molar", "mol·L-1", "molL-1", "mol/liter", "mol/litre"],
    "mmol/L": ["mM", "mm", "mmol/L", "mmol/l", "millimolar", "mmol·L-1", "10^-3M", "x10-3M", "10-3M", "10^-3mol/L", "x10-3mol/L"],
    "umol/L": ["uM", "um", "UM", "uMol", "mcM", "mcm", "umol/L", "umol/l", "mcmol/L", "micromolar", "umol·L-1", "10^-6M", "x10-6M", "10-6M", "10^-6mol/L", "x10-6mol/L"],
    "nmol/L": ["nM", "nm", "NM", "nmol/L", "nmol/l", "nanomolar", "nmol·L-1", "10^-9M", "x10-9M", "10-9M", "10^-9mol/L", "x10-9mol/L"],
    "pmol/L": ["pM", "pm", "PM", "pmol/L", "pmol/l", "picomolar", "pmol·L-1", "10^-12M", "x10-12M", "10-12M", "10^-12mol/L", "x10-12mol/L"],
    "fmol/L": ["fM", "fm", "fmol/L", "fmol/l", "femtomolar", "fmol·L-1"],
    "mmol/mL": ["mmol/mL", "mmol/ml"],
    "umol/mL": ["umol/mL", "umol/ml"],
    "nmol/mL": ["nmol/mL", "nmol/ml"],
    "pmol/mL": ["pmol/mL", "pmol/ml"],
    "fmol/mL": ["fmol/mL", "fmol/ml"],
    "pX": ["pIC50", "pEC50", "pKi", "pKd", "pKD", "pKI", "pKB", "pKb", "pAC50", "pXC50", "pGI50", "pED50", "pIC_50", "pEC_50", "pki", "pkd", "pic50", "pec50", "pA2"],
    "g/L": ["g/L", "g/l", "mg/mL", "mg/ml"],
    "ug/mL": ["ug/mL", "ug/ml", "mcg/mL", "mg/L", "mg/l"],
    "ng/mL": ["ng/mL", "ng/ml", "ug/L", "ug/l"],
    "%": ["%", "percent", "pct"],
    "d": ["d", "day", "days"],
    "h": ["h", "hr", "hrs", "hour", "hours"],
    "min": ["min", "mins", "minute", "minutes"],
    "s": ["s", "sec", "seconds"],
    "ms": ["ms", "msec"],
    "g/kg": ["g/kg"],
    "mg/kg": ["mg/kg", "mpk", "mgkg-1"],
    "ug/kg": ["ug/kg", "mcg/kg"],
    "mg/m2": ["mg/m2", "mg/m²", "mg/m^2"],
    "mL/min/mg": ["mL/min/mg", "ml/min/mg"],
    "uL/min/mg": ["uL/min/mg", "ul/min/mg"],
    "fold": ["fold", "-fold", "x-fold"],
    "ratio": ["ratio"],
    "cpm": ["cpm", "CPM"],
}


def compose(edges: list[Edge], target: str, tolerance: float = 1e-9) -> dict[str, Path]:
    """Shortest composition from every unit that reaches ``target``. Raises if two ways around a cycle disagree."""
    check_cycles(edges, tolerance)
    back: dict[str, list[Edge]] = {}
    for e in [*edges, *(i for e in edges if (i := e.inverse()))]:
        back.setdefault(e.dst, []).append(e)
    ways: dict[str, list[Edge]] = {target: []}
    queue = deque([target])
    while queue:
        at = queue.popleft()
        for e in back.get(at, []):
            if e.src not in ways:
                ways[e.src] = [e, *ways[at]]
                queue.append(e.src)
    out = {}
    for unit, way in ways.items():
        p = Path()
        for e in way:
            p = p.then(e)
        out[unit] = p
    return out


def check_cycles(edges: list[Edge], tolerance: float = 1e-9) -> None:
    """Every edge must agree with the way between its ends through a spanning tree, exponential edges included.

    Ways are compared by what they make of a few values; a value that a logarithm cannot take says nothing.
    """
    links: dict[str, list[tuple[str, Edge, bool]]] = {}
    for e in edges:
        links.setdefault(e.src, []).append((e.dst, e, True))
        links.setdefault(e.dst, []).append((e.src, e, False))
    ways: dict[str, list[tuple[Edge, bool]]] = {}
    for root in links:
        if root in ways:
            continue
        ways[root] = []
        queue = deque([root])
        while queue:
            at = queue.popleft()
            for to, e, forward in links[at]:
                way = [*ways[at], (e, forward)]
                if to not in ways:
                    ways[to] = way
                    queue.append(to)
                elif any(x is not None and y is not None and not math.isclose(x, y, rel_tol=tolerance, abs_tol=tolerance) for x, y in ((_along(way, v), _along(ways[to], v)) for v in (-2.0, 0.5, 3.0))):
                    raise ValueError(f"inconsistent conversions around {e.src} -> {e.dst}")


def _along(way: list[tuple[Edge, bool]], v: float | None) -> float | None:
    """The value at the end of a way; null where an edge has no value for it."""
    for e, forward in way:
        if v is None:
            return None
        if forward:
            x = e.a * v + e.b
            v = (10**x if x < 300 else None) if e.exp10 else x
        elif e.exp10:
            v = (math.log10(v) - e.b) / e.a if v > 0 else None
        else:
            v = (v - e.b) / e.a
    return v


# Look-alike characters that unit texts are written with, and the plain ones. The micro sign and mu become u.
_FOLD = {
    "u": "µμ", "M": "МΜ", "o": "оο", "c": "сϲ", "e": "е", "a": "а", "p": "рρ", "h": "һ", "x": "х", "i": "іι", "y": "у", "P": "РΡ", "C": "СϹ", "H": "НΗ",
    "T": "ТΤ", "K": "КΚ", "L": "Ⅼ", "E": "ЕΕ", "-": "⁻−‐‑‒–－", "/": "∕⁄／", "%": "％", "^": "＾", ".": "．", "·": "⋅∙•",
}


def fold_unit(c: Column) -> Column:
    """A unit text in plain characters: full-width and look-alike letters folded, invisible characters and blanks removed."""
    wide = "".join(chr(x) for x in range(0xFF10, 0xFF5B) if chr(x - 0xFEE0).isalnum())
    plain = "".join(chr(ord(x) - 0xFEE0) for x in wide)
    folded = "".join(_FOLD.values())
    c = F.translate(c, wide + folded, plain + "".join(k * len(v) for k, v in _FOLD.items()))
    c = F.regexp_replace(c, r"[\p{Cf}\p{Z}\s]+", "")
    return F.regexp_replace(c, r"^[×xX·]?(?=10\^?-?\d)", "")


def conversion_table(spark: SparkSession, targets: list[str], edges: list[Edge] | None = None, spellings: dict[str, list[str]] | None = None) -> DataFrame:
    """(spelling, unit, canonical, pre_a, pre_b, exp10, post_a, post_b): what reaches one of ``targets``, one row per spelling."""
    rows = {}
    for target in targets:
        paths = compose(edges or MOLAR_EDGES, target)
        for unit, names in (spellings or SPELLINGS).items():
            if unit in paths:
                p = paths[unit]
                for s in [unit, *names]:
                    s = s.replace(" ", "")
                    s = s[1:] if s.startswith("x10") else s
                    rows[s] = (s, unit, target, p.pre_a, p.pre_b, p.exp10, p.post_a, p.post_b)
    return spark.createDataFrame(list(rows.values()), "spelling string, unit string, canonical string, pre_a double, pre_b double, exp10 boolean, post_a double, post_b double")


def convert(df: DataFrame, unit: str, value: str, table: DataFrame, out: str, canonical: str | None = None) -> DataFrame:
    """Add ``out``: the value in the table's canonical unit; null where the unit has no way there or the value is null or not finite.
    With ``canonical``, add the canonical unit of that name as well, which needs no value.

    ``unit`` holds folded spellings; ``table`` has one row per spelling. How it meets the rows is left to its measured size.
    """
    names = {c: f"_{c}" for c in table.columns}
    t = table.select(*[F.col(c).alias(n) for c, n in names.items()])
    x = F.col("_pre_a") * F.col(value) + F.col("_pre_b")
    v = F.col("_post_a") * F.when(F.col("_exp10"), F.pow(F.lit(10.0), x)).otherwise(x) + F.col("_post_b")
    fine = F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    joined = df.join(t, F.col(unit) == F.col("_spelling"), "left").withColumn(out, F.when(fine, v))
    return (joined.withColumn(canonical, F.col("_canonical")) if canonical else joined).drop(*names.values())


_STATED = r"(?:(?:[x×]\s?)?10\^?[-−]\d+\s?(?:mol/[Ll]|M)|(?:[numpfµμ]|mc)?mol(?:/m?[Ll]|·L-1)|(?:nano|micro|milli|pico|femto)?molar|(?:[numpfµμ]|mc)?M|p(?:IC50|EC50|Ki|Kd))"


def unit_in_value_text(text: Column, value: Column) -> Column:
    """The unit written after the number of a value text, or null. The number itself may end in a power of ten
    (``7.1x10^-05``), and a unit may start with one (``2.09 10^-9 M``): the parsed value tells which it is.
    """
    mark = r"^\s*[<>~≥≤=]*\s*"
    num = r"-?\d[\d,]*(?:\.\d+)?"
    sci = F.regexp_extract(text, mark + r"(" + num + r")\s?[x×]\s?10\^?([-+]?\d+)", 0)
    mantissa = F.regexp_replace(F.regexp_extract(text, mark + r"(" + num + r")\s?[x×]\s?10\^?([-+]?\d+)", 1), ",", "").try_cast("double")
    power = F.regexp_extract(text, mark + r"(" + num + r")\s?[x×]\s?10\^?([-+]?\d+)", 2).try_cast("int")
    whole = mantissa * F.pow(F.lit(10.0), power)
    is_sci = (sci != "") & (F.abs(whole - value) <= F.abs(value) * 1e-6)
    rest_sci = F.substr(text, F.length(sci) + 1)
    plain = F.regexp_extract(text, mark + num + r"(?:[eE][-+]?\d+)?", 0)
    rest = F.when(is_sci, rest_sci).otherwise(F.substr(text, F.length(plain) + 1))
    # a unit glued to the number: "2.0910^-9 M" is 2.09 and 10^-9 M
    glued = F.regexp_extract(text, r"(10\^-\d+\s?(?:M|mol/[Ll]))", 1)
    found = F.regexp_extract(rest, r"^\s*(" + _STATED + r")(?![A-Za-z])", 1)
    return F.nullif(F.when(~is_sci & (glued != ""), glued).otherwise(found), F.lit(""))


def unit_in_header(text: Column) -> Column:
    """The unit at the end of a column header: in brackets, after a comma, or after ``in``."""
    pat = r"(?:[\(\[]\s*(?:in\s+)?|,\s*|\bin\s+)(" + _STATED + r")\s*[\)\]]?\s*$"
    return F.nullif(F.regexp_extract(text, pat, 1), F.lit(""))


def unit_in_context(text: Column) -> Column:
    """The unit a caption or sentence states for the values: ``in X``, ``as X`` or ``(X)``; one after a number is a condition."""
    pat = r"(?:\bin\s+|\bas\s+|[\(\[]\s*)(" + _STATED + r")(?![A-Za-z0-9])"
    return F.nullif(F.regexp_extract(text, pat, 1), F.lit(""))
