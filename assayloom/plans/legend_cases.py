"""Legend texts and the definitions they state, written out by hand: the yardstick of the grammar, for tests and for the query's SQL alike."""

from __future__ import annotations

# (text, {grade: (lower bound, upper bound, unit)})
CASES: list[tuple[str | None, dict[str, tuple[float | None, float | None, str | None]]]] = [
    ("A: IC50 < 3 nM", {"A": (None, 3.0, "nM")}),
    ("+ (greater than 10 microMolar), ++ (less than 10 microMolar), +++ (less than 1 microMolar), and ++++ (less than 100 nM).", {"+": (10.0, None, "uM"), "++": (None, 10.0, "uM"), "+++": (None, 1.0, "uM"), "++++": (None, 100.0, "nM")}),
    ("IC50: A ≦ 10 nM; 10 nM < B ≦ 100 nM; 100 nM < C ≦ 1 μM; 1 μM < D ≦ 10 μM; E > 10 μM", {"A": (None, 10.0, "nM"), "B": (10.0, 100.0, "nM"), "C": (100.0, 1000.0, "nM"), "D": (1.0, 10.0, "uM"), "E": (10.0, None, "uM")}),
    ("*** is less than 100 nM; ** is between 1000 and 100 nM; * is greater than 1000 nM ### is ≥75%; ## is equal to or greater than 25% but less than 75%; # is <25%", {"***": (None, 100.0, "nM"), "*": (1000.0, None, "nM"), "**": (100.0, 1000.0, "nM"), "###": (75.0, None, "%"), "##": (25.0, 75.0, "%"), "#": (None, 25.0, "%")}),
    ('In Table 4A, IC50 values of less than 0.05 μM are labelled as "+++", from 1 to 0.05 μM are labelled as "++", and greater than 1 μM are labelled as "+".', {"+++": (None, 0.05, "uM"), "+": (1.0, None, "uM"), "++": (0.05, 1.0, "uM")}),
    ("“A” represents a calculated IC50 value of less than 10 nM; “B” represents a calculated IC50 value of greater than or equal to 10 nM and less than 100 nM", {"A": (None, 10.0, "nM"), "B": (10.0, 100.0, "nM")}),
    ("for T315I activity, the following designations are used: <1.00 nM=A; 1.01-10.0 nM=B; 10.01-100.0 nM=C; >100 nM=D; and ND=not determined.", {"A": (None, 1.0, "nM"), "B": (1.01, 10.0, "nM"), "C": (10.01, 100.0, "nM"), "D": (100.0, None, "nM")}),
    ("D: 10 μM ≥ Ki", {"D": (None, 10.0, "uM")}),
    ("A: Ki > 25 μM", {"A": (25.0, None, "uM")}),
    ("B: 25 μM ≥ Ki > 15 μM", {"B": (15.0, 25.0, "uM")}),
    ("100 nM < C ≦ 1 μM", {"C": (100.0, 1000.0, "nM")}),
    ("the following designations are used: <1.00 nM=A", {"A": (None, 1.0, "nM")}),
    ("the results are shown in Table 15A=<250 nM", {"A": (None, 250.0, "nM")}),
    ("the key is: 100 nM=B", {}),
    ("% Disease Control @ 50 ppm Rating 80-100 A 60-79 B 40-59 C <40 D Not tested E", {}),
    ("MIC (μg/mL) Rating ≦0.5 A >1.5-1.5 B >1.5-4 C >4 D Not tested E", {}),
    ("10 nM < B ≦ 100 nM", {"B": (10.0, 100.0, "nM")}),
    ("for T315I activity, the following designations are used: <1.00 nM=A; 1.01-10.0 nM=B. For wild-type activity, the following designations are used: <10 nM=A; 11-100 nM=B.", {}),
    ("for T315I activity, the following designations are used: <1.00 nM=A; 1.01-10.0 nM=B.", {"A": (None, 1.0, "nM"), "B": (1.01, 10.0, "nM")}),
    ("*Key: ++++: IC50 ≥ 1 uM   +++: 1 uM > IC50 ≥ 0.1 uM", {"++++": (1.0, None, "uM"), "+++": (0.1, 1.0, "uM")}),
    ('an IC50 value of greater than or equal to 0.001 μM and less than or equal to 0.01 μM is marked "++++"; a value greater than 0.01 μM and less than or equal to 0.1 μM is marked "+++"', {"++++": (0.001, 0.01, "uM"), "+++": (0.01, 0.1, "uM")}),
    ("+ refers to ≤10 nM ++ refers to >10 nM to 50 nM", {"+": (None, 10.0, "nM"), "++": (10.0, 50.0, "nM")}),
    ("A: IC 50 >200 nM−<800 nM", {"A": (200.0, 800.0, "nM")}),
    ("+ IC 50 value in the range of 5 μM to 50 μM", {"+": (5.0, 50.0, "uM")}),
    ("B provided an IC 50 10-100 nM", {"B": (10.0, 100.0, "nM")}),
    ("++ indicates an IC 50 of 100 to 500 nM", {"++": (100.0, 500.0, "nM")}),
    ("1000 nM < IC50 <= 10000 nM: +++", {"+++": (1000.0, 10000.0, "nM")}),
    ("A 0 < PI3K Delta Activity < 50 nM", {"A": (0.0, 50.0, "nM")}),
    ("IC50 ≤ 100 nM: +.; 100 nM < IC50 ≤ 1000 nM: ++", {"+": (None, 100.0, "nM"), "++": (100.0, 1000.0, "nM")}),
    ("A=<10 nM  B=10-50 nM  C=50-100 nM  D=100-500", {"A": (None, 10.0, "nM"), "B": (10.0, 50.0, "nM"), "C": (50.0, 100.0, "nM"), "D": (100.0, 500.0, "nM")}),
    ("C = IC50 less than 1 μM (1,000 nM) but greater than or equal to 100 nM", {"C": (100.0, 1000.0, "nM")}),
    ("A: 1 μM or greater; B: 10 nM or less", {"A": (1.0, None, "uM"), "B": (None, 10.0, "nM")}),
    ("++ refers to IC50 >100 nM and ≦500 nM", {"++": (100.0, 500.0, "nM")}),
    ("an IC 50 value: C: in the range of 1 μM to less than 10 μM", {"C": (1.0, 10.0, "uM")}),
    ("+ indicates ≤10 μM, − indicates ≥10 μM", {"+": (None, 10.0, "uM"), "−": (10.0, None, "uM")}),
    ("A: IC50 ≥ 10,000 nM", {"A": (10000.0, None, "nM")}),
    ("A: 4; E=20", {}),
    ("A, below 444 nM; B, 11 to 4151 nM; C, above 2756 nM.", {"A": (None, 444.0, "nM"), "B": (11.0, 4151.0, "nM"), "C": (2756.0, None, "nM")}),
    ("A: below 10 nM; B: 10 to 100 nM; C: above 100 nM.", {"A": (None, 10.0, "nM"), "B": (10.0, 100.0, "nM"), "C": (100.0, None, "nM")}),
    ("A compound of claim 1 wherein R is C or D. E is less favoured. A: the residue, 5 mg.", {}),
    ("A is potent; B is 10 nM", {}),
    ("", {}),
    (None, {}),
]


def expected_sql() -> str:
    """The cases as literal rows (case_no, symbol, lo, hi, unit)."""
    text = lambda x: "NULL" if x is None else f"'{x}'"
    number = lambda x: "NULL" if x is None else repr(x)
    rows = [f"({i}, {text(g)}, {number(lo)}, {number(hi)}, {text(u)})" for i, (_, key) in enumerate(CASES) for g, (lo, hi, u) in key.items()]
    return "SELECT CAST(case_no AS INTEGER) AS case_no, symbol, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, unit FROM (VALUES " + ", ".join(rows) + ") AS v(case_no, symbol, lo, hi, unit)"
