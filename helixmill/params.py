"""Parameters of the assay operators, with two presets: strict (library defaults) and relaxed (command defaults)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

GAP_MODES = ("ignore", "penalize", "hard_fail")


def require(ok: bool, message: str) -> None:
    """A check on the driver."""
    if not ok:
        raise ValueError(message)


def _each(names: str, ok: Callable[..., bool], text: str) -> list[tuple]:
    return [((n,), ok, text) for n in names.split()]


def _number(x) -> bool:
    return isinstance(x, (int, float)) and not isinstance(x, bool) and x == x


def _whole(x) -> bool:
    return isinstance(x, int) and not isinstance(x, bool)


def _ordered(names: str) -> tuple:
    return tuple(names.split()), lambda a, b: not (_number(a) and _number(b)) or a <= b, "the first may not be above the second"


#: What each parameter must be: names, condition, text.
RULES = [
    *_each("window_size min_len max_len tail_len max_run min_amplicon max_amplicon preferred_min preferred_max word_size max_subjects min_hit_len hit_tail_len offtarget_min_amplicon offtarget_max_amplicon top_n", lambda x: _whole(x) and x > 0, "a whole number above 0"),
    *_each("max_variable_positions max_high_gap_positions min_non_gap_count min_clamp max_clamp strong_3p_nt medium_3p_nt max_mismatches max_3p_mismatches max_gap_positions max_tail_mismatches", lambda x: _whole(x) and x >= 0, "a whole number from 0"),
    *_each("top_quantile all_gap_score variability_threshold gap_fraction_threshold min_tail3_identity min_tail5_identity max_amplicon_gap_fraction", lambda x: _number(x) and 0 <= x <= 1, "a fraction from 0 to 1"),
    *_each("min_gc max_gc min_hit_identity", lambda x: _number(x) and 0 <= x <= 100, "a percentage from 0 to 100"),
    *_each("min_tm max_tm max_hairpin_tm max_homodimer_tm max_self_dimer_3p_tm max_heterodimer_tm", _number, "a number"),
    *_each("gap_penalty strong_weight medium_weight base_weight max_weighted_score max_tm_diff max_evalue", lambda x: _number(x) and x >= 0, "a number from 0"),
    *_each("gap_mode", lambda x: x in GAP_MODES, f"one of {', '.join(GAP_MODES)}"),
    *_each("unsuitable_char", lambda x: isinstance(x, str) and len(x) == 1, "one character"),
    *_each("min_region_len", lambda x: x is None or _whole(x) and x > 0, "None or a whole number above 0"),
    *map(_ordered, ("min_len max_len", "min_gc max_gc", "min_tm max_tm", "min_clamp max_clamp", "min_amplicon max_amplicon", "preferred_min preferred_max", "strong_3p_nt medium_3p_nt", "offtarget_min_amplicon offtarget_max_amplicon")),
]


#: As RULES, for the scores.
SCORE_RULES = [
    *_each("coverage prime3 specificity thermo amplicon tm_balance gc hairpin homodimer heterodimer", lambda x: _number(x) and 0 <= x <= 1, "a weight from 0 to 1"),
    *_each("tm_diff_bad gc_diff_bad gc_delta_bad risk_bad", lambda x: _number(x) and x > 0, "a number above 0"),
    *_each("gc_target hairpin_good hairpin_bad homodimer_good homodimer_bad heterodimer_good heterodimer_bad", _number, "a number"),
    *_each("preferred_min preferred_max allowed_min allowed_max", lambda x: _whole(x) and x > 0, "a whole number above 0"),
    *(((f"{kind}_good", f"{kind}_bad"), lambda a, b: not (_number(a) and _number(b)) or a < b, "the good temperature must be below the bad one") for kind in ("hairpin", "homodimer", "heterodimer")),
    *map(_ordered, ("preferred_min preferred_max", "allowed_min preferred_min", "preferred_max allowed_max")),
]


def _check(own, rules: list[tuple]) -> None:
    wrong = [f"{', '.join(f'{n}={getattr(own, n)!r}' for n in names)}: {text}" for names, ok, text in rules if not ok(*(getattr(own, n) for n in names))]
    require(not wrong, f"{type(own).__name__}: " + "; ".join(wrong))


@dataclass(frozen=True)
class Scoring:
    """Weights and scales of the final score. The defaults."""

    # parts of the score
    coverage: float = 0.42
    prime3: float = 0.20
    specificity: float = 0.18
    thermo: float = 0.13
    amplicon: float = 0.07
    # parts of the thermodynamic score
    tm_balance: float = 0.30
    gc: float = 0.20
    hairpin: float = 0.17
    homodimer: float = 0.16
    heterodimer: float = 0.17
    # where a part is worst, or what it is measured from
    tm_diff_bad: float = 4.0
    gc_diff_bad: float = 20.0
    gc_target: float = 50.0
    gc_delta_bad: float = 20.0
    hairpin_good: float = 35.0
    hairpin_bad: float = 55.0
    homodimer_good: float = 35.0
    homodimer_bad: float = 55.0
    heterodimer_good: float = 35.0
    heterodimer_bad: float = 55.0
    risk_bad: float = 20.0
    # amplicon lengths
    preferred_min: int = 40
    preferred_max: int = 120
    allowed_min: int = 40
    allowed_max: int = 220

    def __post_init__(self) -> None:
        _check(self, SCORE_RULES)

    def with_(self, **changes) -> Scoring:
        return replace(self, **changes)


@dataclass(frozen=True)
class Params:
    """The defaults are those of the strict preset."""

    # conserved regions
    window_size: int = 15
    top_quantile: float = 0.9
    min_region_len: int | None = None
    all_gap_score: float = 1.0
    # candidate windows
    min_len: int = 18
    max_len: int = 25
    variability_threshold: float = 0.10
    gap_fraction_threshold: float = 0.10
    max_variable_positions: int = 6
    max_high_gap_positions: int = 0
    tail_len: int = 5
    min_tail3_identity: float = 0.95
    min_tail5_identity: float = 0.90
    unsuitable_char: str = "N"
    min_non_gap_count: int = 1
    # single primers
    min_gc: float = 40.0
    max_gc: float = 60.0
    min_tm: float = 58.0
    max_tm: float = 62.0
    max_run: int = 4
    min_clamp: int = 1
    max_clamp: int = 2
    max_hairpin_tm: float = 47.0
    max_homodimer_tm: float = 47.0
    max_self_dimer_3p_tm: float = 45.0
    # single coverage
    gap_mode: str = "hard_fail"
    gap_penalty: float = 4.0
    strong_3p_nt: int = 3
    medium_3p_nt: int = 5
    strong_weight: float = 3.0
    medium_weight: float = 2.0
    base_weight: float = 1.0
    max_mismatches: int = 2
    max_3p_mismatches: int = 0
    max_weighted_score: float = 6.0
    # pairs
    min_amplicon: int = 40
    max_amplicon: int = 220
    preferred_min: int = 40
    preferred_max: int = 120
    max_tm_diff: float = 2.0
    max_heterodimer_tm: float = 47.0
    # pair coverage
    max_gap_positions: int = 0
    max_amplicon_gap_fraction: float = 0.25
    # specificity
    word_size: int = 7
    max_subjects: int = 500
    min_hit_identity: float = 80.0
    min_hit_len: int = 12
    hit_tail_len: int = 5
    max_tail_mismatches: int = 1
    offtarget_min_amplicon: int = 60
    offtarget_max_amplicon: int = 150
    max_evalue: float = 1000.0
    # output
    top_n: int = 20

    def __post_init__(self) -> None:
        _check(self, RULES)

    def with_(self, **changes) -> Params:
        return replace(self, **changes)


STRICT = Params()
#: The limits of the relaxed preset where they differ from the strict one's.
RELAXED = Params(
    window_size=25, top_quantile=0.8, min_region_len=25, variability_threshold=0.15, gap_fraction_threshold=0.20, max_variable_positions=10,
    max_high_gap_positions=2, min_tail3_identity=0.85, min_tail5_identity=0.80, min_gc=35.0, max_gc=65.0, min_tm=54.0, max_tm=66.0, max_run=5,
    min_clamp=0, max_hairpin_tm=50.0, max_homodimer_tm=50.0, max_self_dimer_3p_tm=48.0, gap_mode="penalize", max_mismatches=3, max_3p_mismatches=1,
    max_weighted_score=8.0, max_tm_diff=3.5, max_heterodimer_tm=50.0, max_gap_positions=2, max_amplicon_gap_fraction=0.35,
)
