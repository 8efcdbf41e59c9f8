"""Nearest-neighbour melting temperatures and ungapped duplex screens, as SQL expressions without Python.

The screens are approximations of structure melting temperatures: the most stable run of complementary bases over
all ungapped alignments. A table of measured or solved values overrides them (operators.thermo.override).
"""

from __future__ import annotations

# Unified nearest-neighbour set (SantaLucia 1998), tenths of kcal/mol and of cal/(mol K).
STACK = {
    "AA": (-79, -222), "AC": (-84, -224), "AG": (-78, -210), "AT": (-72, -204),
    "CA": (-85, -227), "CC": (-80, -199), "CG": (-106, -272), "CT": (-78, -210),
    "GA": (-82, -222), "GC": (-98, -244), "GG": (-80, -199), "GT": (-84, -224),
    "TA": (-72, -213), "TC": (-82, -222), "TG": (-85, -227), "TT": (-79, -222),
}
TERMINAL_GC, TERMINAL_AT, SYMMETRY = (1, -28), (23, 41), -14
R = 1.987
#: Conditions: mM of monovalent and divalent ions and dNTP, nM of oligo.
NA, MG, DNTP, OLIGO = 50.0, 1.5, 0.6, 50.0
#: Free energy of closing a hairpin loop, kcal/mol (SantaLucia & Hicks 2004, three bases).
LOOP = 3.5


def _sodium() -> float:
    return (NA + 120.0 * (MG - DNTP) ** 0.5) / 1000.0


def _stacks(x: str, which: int) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v[which]}" for k, v in STACK.items())
    return f"aggregate(transform(sequence(1, length({x}) - 1), p -> CASE substr({x}, p, 2) {cases} ELSE 0 END), 0, (t, v) -> t + v)"


def _ends(x: str, which: int) -> str:
    one = lambda e: f"CASE WHEN {e} IN ('G', 'C') THEN {TERMINAL_GC[which]} ELSE {TERMINAL_AT[which]} END"
    return f"({one(f'left({x}, 1)')} + {one(f'right({x}, 1)')})"


def tm(x: str, symmetric: str = "false") -> str:
    """Melting temperature (Celsius) of an oligo or run of at least two bases with its complement."""
    import math

    h = f"({_stacks(x, 0)} + {_ends(x, 0)}) / 10.0D"
    s = f"(({_stacks(x, 1)} + {_ends(x, 1)} + CASE WHEN {symmetric} THEN {SYMMETRY} ELSE 0 END) / 10.0D + {0.368 * math.log(_sodium())!r}D * (length({x}) - 1))"
    c = OLIGO * 1e-9
    conc = f"CASE WHEN {symmetric} THEN {R * math.log(c)!r}D ELSE {R * math.log(c / 4)!r}D END"
    return f"(1000.0D * {h} / ({s} + {conc}) - 273.15D)"


def oligo_tm(x: str) -> str:
    """Melting temperature of a primer; self-complementary ones by their own formula."""
    return tm(x, f"({x} = reverse(translate({x}, 'ACGT', 'TGCA')))")


def _masked(s: str, rc: str, low: str, high: str) -> str:
    """For every offset the bases of s that match rc there, others as '-', joined; '3' marks the end of s."""
    one = f"concat_ws('', transform(filter(sequence(0, length({s}) - 1), i -> i >= greatest(0, o) AND i < least(length({s}), length({rc}) + o) AND i <= {high}), i -> CASE WHEN substr({s}, i + 1, 1) = substr({rc}, i - o + 1, 1) THEN substr({s}, i + 1, 1) ELSE '-' END))"
    return f"concat_ws('-', transform(sequence({low}, length({s}) - 1), o -> concat({one}, CASE WHEN length({rc}) + o >= length({s}) THEN '3' ELSE '' END)))"


def _best(runs: str, each: str) -> str:
    return f"coalesce(array_max(transform(array_distinct({runs}), r -> {each})), 0.0D)"


def duplex_tm(s: str, t: str) -> str:
    """Screen of s against t: the most stable run of at least two complementary bases; 0 without one."""
    rc = f"reverse(translate({t}, 'ACGT', 'TGCA'))"
    return _best(f"regexp_extract_all({_masked(s, rc, f'1 - length({t})', '1000000')}, '[ACGT]{{2,}}', 0)", tm("r"))


def end_duplex_tm(s: str) -> str:
    """The same of s with itself, for runs that hold the 3' base."""
    rc = f"reverse(translate({s}, 'ACGT', 'TGCA'))"
    return _best(f"regexp_extract_all({_masked(s, rc, f'1 - length({s})', '1000000')}, '([ACGT]{{2,}})3', 1)", tm("r"))


def hairpin_tm(s: str) -> str:
    """The most stable stem of at least three bases over a loop of at least three; 0 without one."""
    import math

    rc = f"reverse(translate({s}, 'ACGT', 'TGCA'))"
    runs = f"regexp_extract_all({_masked(s, rc, f'1 - length({s})', f'floor((length({s}) - 5 + o) / 2.0D)')}, '[ACGT]{{3,}}', 0)"
    h = f"{_stacks('r', 0)} / 10.0D"
    st = f"({_stacks('r', 1)} / 10.0D + {0.368 * math.log(_sodium())!r}D * (length(r) - 1) - {LOOP * 1000 / 310.15!r}D)"
    return _best(runs, f"(1000.0D * {h} / {st} - 273.15D)")
