"""Values derived from a key's digest: same key, same value, on any partitioning and any engine."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from .numeric import literal

# 13 hex digits are 52 bits, which a double holds exactly.
HEX_DIGITS = 13

# Range of each generated attribute.
ATTRIBUTE_RANGES = {
    "danceability": (0.15, 0.85),
    "energy": (0.10, 0.90),
    "valence": (0.10, 0.85),
    "acousticness": (0.05, 0.95),
    "instrumentalness": (0.00, 0.80),
    "speechiness": (0.03, 0.50),
    "liveness": (0.05, 0.40),
    "loudness": (-25.0, -3.0),
    "tempo": (60.0, 180.0),
}
# Choices of each discrete generated attribute.
ATTRIBUTE_CHOICES = {
    "time_signature": (3, 4, 5),
    "key": tuple(range(12)),
    "mode": (0, 1),
}


def surrogate_key(columns: Sequence[str]) -> str:
    """MD5 over the parts joined by ``|``; a NULL part counts as empty."""
    parts = ", ".join(f"coalesce(CAST({c} AS STRING), '')" for c in columns)
    return f"md5(concat_ws('|', {parts}))"


def digest(key: str, salt: str) -> str:
    return f"sha2(concat_ws('|', CAST({key} AS STRING), {literal(salt)}), 256)"


def _block(digest_hex: str, index: int) -> str:
    start = 1 + HEX_DIGITS * index
    return f"CAST(conv(substring({digest_hex}, {start}, {HEX_DIGITS}), 16, 10) AS BIGINT)"


def unit(digest_hex: str, index: int = 0) -> str:
    """Uniform number in [0, 1) from the index-th block (0 to 3) of a SHA-256 digest."""
    return f"(CAST({_block(digest_hex, index)} AS DOUBLE) / {float(16**HEX_DIGITS)!r}D)"


def beta22(a: str, b: str, c: str) -> str:
    """Beta(2, 2) number: the median of three independent uniforms has exactly that distribution."""
    return f"greatest(least({a}, {b}), least(greatest({a}, {b}), {c}))"


def scale(share: str, low: float, high: float, digits: int = 4) -> str:
    return f"round({low!r}D + {share} * {high - low!r}D, {digits})"


def pick(digest_hex: str, choices: Sequence[Any], index: int = 0) -> str:
    """One of ``choices``, each equally likely, from the index-th block of a digest."""
    options = ", ".join(literal(c) for c in choices)
    return f"element_at(array({options}), CAST(pmod({_block(digest_hex, index)}, {len(choices)}) AS INT) + 1)"
