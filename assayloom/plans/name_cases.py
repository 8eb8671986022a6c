"""Damaged names and what mends them, written out by hand: the yardstick of the repairs, for tests and for the query's SQL alike."""

from __future__ import annotations

# (damaged, pattern, mended); the pattern must offer the mended name
REPAIRED = [
    ("3-(azetidin-1-yl)propan-2-ol2", "footnote_digit_tail", "3-(azetidin-1-yl)propan-2-ol"),
    ("2-methylpropanenitrile14", "footnote_digit_tail", "2-methylpropanenitrile"),
    ("2-oxo-6-[5-methylpyridin-2-yl)methoxy]pyridine", "dropped_open_paren", "2-oxo-6-[(5-methylpyridin-2-yl)methoxy]pyridine"),
    ("2-methyl-4-1-trifluoromethoxy)benzyl ether", "digit_for_paren", "2-methyl-4-(trifluoromethoxy)benzyl ether"),
    ("1-(5-eyloro-6-fluoro-2-methoxyphenyl)urea", "ch_as_ey", "1-(5-chloro-6-fluoro-2-methoxyphenyl)urea"),
    ("4-(pyridin-4-ylamino)pyrimidino)pyrimidin-2-yl", "stray_closing_bracket", "4-(pyridin-4-ylamino)pyrimidinopyrimidin-2-yl"),
    ("{4-oxazin-2-yl]amino}methane", "stray_closing_bracket", "{4-oxazin-2-ylamino}methane"),
    ("2-(methyl-4-[(ethyl)amino]benzene", "stray_opening_bracket", "2-methyl-4-[(ethyl)amino]benzene"),
    ("1,2,4-triazin-4(3H-one", "dropped_close_bracket", "1,2,4-triazin-4(3H)-one"),
    ("3-((1,4,5,6-tetrahydropyrimidin-2-yl)aminobenzoic acid", "dropped_close_bracket", "3-((1,4,5,6-tetrahydropyrimidin-2-yl)amino)benzoic acid"),
]
# names that a pattern must leave alone: (name, pattern)
UNTOUCHED = [
    ("piperazin-2-one-5,5,6,6-d4", "footnote_digit_tail"),
    ("benzonitrile(peak 1)5", "footnote_digit_tail"),
    ("6-[(5-methylpyridin-2-yl)methoxy]pyridine", "dropped_open_paren"),
    ("2-(4-chloro-1-methylphenyl)ethanol", "digit_for_paren"),
    ("4-chloro-1-methyl-1H-indole", "digit_for_paren"),
    ("pyridine", "ch_as_ey"),
    ("2-(methyl)-4-[(ethyl)amino]benzene", "stray_closing_bracket"),
    ("2-(methyl)-4-[(ethyl)amino]benzene", "dropped_close_bracket"),
]


def expected_sql() -> str:
    """The mended names as literal rows (case_no, pattern_id, repaired); the untouched ones give none."""
    rows = [f"({i}, '{p}', '{m}')" for i, (_, p, m) in enumerate(REPAIRED)]
    return "SELECT CAST(case_no AS INTEGER) AS case_no, pattern_id, repaired FROM (VALUES " + ", ".join(rows) + ") AS v(case_no, pattern_id, repaired)"
