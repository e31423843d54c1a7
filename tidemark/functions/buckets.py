"""Turn measures into labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from .numeric import literal


class Quadrants(NamedTuple):
    """Labels for the four corners of a 2-D split, and for everything in between."""

    high_high: Any
    high_low: Any
    low_high: Any
    low_low: Any
    between: Any


def first_match(rules: Sequence[tuple[str, Any]], default: Any) -> str:
    """Label of the first test that holds."""
    whens = " ".join(f"WHEN {test} THEN {literal(label)}" for test, label in rules)
    return f"CASE {whens} ELSE {literal(default)} END"


def quadrant(x: str, y: str, labels: Quadrants, high: float = 0.6, low: float = 0.4) -> str:
    """Corner label for (x, y). A value in the band [low, high) on either axis, or NULL, is ``between``."""
    up, down = f">= {literal(float(high))}", f"< {literal(float(low))}"
    corners = [(up, up), (up, down), (down, up), (down, down)]
    return first_match([(f"{x} {a} AND {y} {b}", label) for (a, b), label in zip(corners, labels)], labels.between)


def ladder(value: str, steps: Sequence[tuple[float, Any]], default: Any, op: str = "<") -> str:
    """Label of the first step whose comparison ``value op cut`` holds."""
    return first_match([(f"{value} {op} {literal(float(cut))}", label) for cut, label in steps], default)


def band(value: str, bands: Sequence[tuple[int, int, Any]], default: Any) -> str:
    """Label of the closed interval holding ``value``."""
    return first_match([(f"{value} BETWEEN {lo} AND {hi}", label) for lo, hi, label in bands], default)


def lookup(key: str, texts: Mapping[str, str], default: str) -> str:
    """Text for a label from a fixed table of literals."""
    pairs = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in texts.items())
    return f"coalesce(map({pairs})[{key}], {literal(default)})"


def change_class(
    deltas: Sequence[str],
    small: float = 0.2,
    large: float = 0.5,
    labels: tuple[str, str, str] = ("Stable", "Major_Shift", "Minor_Shift"),
) -> str:
    """Stable if every delta is small, major if any is large, minor otherwise."""
    calm = " AND ".join(f"abs({d}) <= {literal(float(small))}" for d in deltas)
    strong = " OR ".join(f"abs({d}) > {literal(float(large))}" for d in deltas)
    return first_match([(calm, labels[0]), (strong, labels[1])], labels[2])


def position(value: str, order: Sequence[Any]) -> str:
    """Sort key for a hand-made order; anything not listed sorts last."""
    return first_match([(f"{value} = {literal(item)}", i) for i, item in enumerate(order, 1)], len(order) + 1)
