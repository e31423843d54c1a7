"""Personal data by weak supervision.

Patterns propose spans; labelers (a pattern check, a gazetteer, the context, the shape) vote on each span:
personal, not personal, or no opinion. The votes of the whole corpus, counted by vote pattern, go through
expectation-maximisation (one reliability per labeler and vote), whose posteriors are the soft labels on which
a linear span classifier over surface and context features is trained. Both are fitted on counts of distinct
(votes, features) combinations, which are bounded by their coding, not by the corpus.

Base spans (email, ip, card, phone: fixed patterns with their checks) are always reported. Of the other
proposals (secret, ssn, iban, name) those that the classifier finds personal are added.

Defined results: a null text is empty and has no spans; offsets are code points, end exclusive; overlapping
spans of different kinds are all reported; repeated rows are treated alike; an empty table gives no rows;
without any added proposal nothing is fitted; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import hash_words, string_chunks

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "ssn", "iban", "name")
KINDS = BASE + ADDED
THRESHOLD = 0.9
CONTEXT = 40
CONTEXT_BUCKETS = 64
LABELERS = 4
YES, NO, NONE = 1, 0, 2

# Each pattern takes whole runs, so that no text makes it read a run twice.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_VALUE = re.compile(r"[=:][ \t]*([^\s=:]{6,})")
_KEY = re.compile(r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)['\"]?[ \t]*$")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
_NAME = re.compile(r"(?:Mrs?|Ms|Dr|Prof|Herr|Frau|Mme|Señora?)\.? [A-Z][a-z]+(?: [A-Z][a-z]+)?")

# Public lists that the gazetteer and context labelers look up.
FIRST_NAMES = frozenset(
    "James John Robert Michael William David Richard Joseph Thomas Mary Patricia Jennifer Linda Elizabeth Barbara Susan "
    "Sarah Karen Anna Emma Maria Jose Juan Carlos Luis Ana Carmen Pierre Jean Marie Claire Paul Hans Peter Klaus Heidi".split()
)
COUNTRIES = frozenset("AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MT NL NO PL PT RO SE SI SK".split())
WEAK_VALUES = frozenset("password changeme example secret123 xxxxxx ****** ...... <hidden> redacted".split())
CUES = {
    "email": "mail email contact write",
    "ip": "ip host server address login",
    "card": "card visa payment account pay",
    "phone": "phone tel call fax mobile",
    "secret": "login user credentials account key",
    "ssn": "ssn social security tax number",
    "iban": "iban bank account transfer",
    "name": "name contact author signed dear patient",
}


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start."""
    spans = []
    if "@" in text:
        last = 0
        for match in _DOMAIN.finditer(text):
            start = match.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < match.start():
                spans.append(("email", start, match.end()))
                last = match.end()
    spans += [
        ("ip", m.start(), m.end()) for m in _IP.finditer(text) if m.group(1) and all(_at_most_255(p) for p in m.group().split("."))
    ]
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 16:
            digits = match.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", match.start(), match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in match.group()) <= 15:
                spans.append(("phone", match.start(), match.end()))
    return spans


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Spans of the added kinds that labelers are to judge."""
    spans = []
    for match in _VALUE.finditer(text):
        if _KEY.search(text, max(0, match.start() - 24), match.start()):
            spans.append(("secret", match.start(1), match.end(1)))
    spans += [("ssn", m.start(), m.end()) for m in _SSN.finditer(text) if _alone(text, m)]
    spans += [("iban", m.start(), m.end()) for m in _IBAN.finditer(text) if _alone(text, m)]
    spans += [("name", m.start(), m.end()) for m in _NAME.finditer(text) if _alone(text, m)]
    return spans


def _alone(text: str, match: re.Match) -> bool:
    start, end = match.span()
    return not (start and (text[start - 1].isalnum() or text[start - 1] == "-")) and not (
        end < len(text) and (text[end].isalnum() or text[end] == "-")
    )


def _mod97(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """One vote per labeler: pattern, gazetteer, context, shape."""
    value = text[start:end]
    before = text[max(0, start - CONTEXT) : start].lower()
    cue = YES if any(word in before for word in CUES[kind].split()) else NONE
    digits = sum(c.isdigit() for c in value)
    classes = len({"d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value})
    if kind == "secret":
        return YES, NO if value.lower() in WEAK_VALUES else NONE, cue, YES if classes > 1 and digits else NO
    if kind == "ssn":
        area, group, serial = value.split("-")
        valid = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        return YES if valid else NO, NONE, cue, YES if len(set(value)) > 3 else NO
    if kind == "iban":
        return YES if _mod97(value) else NO, YES if value[:2] in COUNTRIES else NO, cue, YES if digits >= 10 else NONE
    if kind == "name":
        first = value.split(" ")[1]
        return YES, YES if first in FIRST_NAMES else NONE, cue, YES if len(first) <= 12 else NO
    return YES, NONE, cue, YES if len(set(value)) > 4 else NO


def features(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """Kind, length class, share of digits, kinds of characters, and the word before, hashed."""
    value = text[start:end]
    before = text[max(0, start - CONTEXT) : start].split()
    word = int(hash_words([before[-1].strip(".,;:()=").lower() or "-"])[0] % np.uint64(CONTEXT_BUCKETS)) if before else 0
    digits = sum(c.isdigit() for c in value)
    classes = len({"d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value})
    return KINDS.index(kind), min(7, len(value) // 4), 4 * digits // len(value), classes, word


_SIZES = (len(KINDS), 8, 5, 5, CONTEXT_BUCKETS)
_STARTS = np.concatenate(([0], np.cumsum(_SIZES)))


def _count_batches(batches):
    counts: Counter = Counter()
    for batch in batches:
        for _, texts in string_chunks(batch.column(0)):
            for text in texts:
                for kind, start, end in base_spans(text) + proposals(text):
                    counts[votes(kind, text, start, end), features(kind, text, start, end)] += 1
    yield pa.RecordBatch.from_pydict(
        {
            "votes": pa.array([list(v) for v, _ in counts], pa.list_(pa.int32())),
            "features": pa.array([list(f) for _, f in counts], pa.list_(pa.int32())),
            "n": pa.array(list(counts.values()), pa.int64()),
        }
    )


def expectation_maximisation(patterns: np.ndarray, kinds: np.ndarray, weights: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior of each (kind, vote pattern); reliabilities are shared by kinds, base rates are not.

    A labeler's votes given the truth follow a categorical distribution with a mild prior towards honesty.
    """
    posterior = np.clip(0.5 + 0.25 * ((patterns == YES).sum(axis=1) - (patterns == NO).sum(axis=1)), 0.05, 0.95)
    for _ in range(rounds):
        log = np.zeros((len(patterns), 2))
        for truth in (0, 1):
            share = weights * (posterior if truth else 1 - posterior)
            for labeler in range(patterns.shape[1]):
                honest = YES if truth else NO
                table = np.array([share[patterns[:, labeler] == vote].sum() + (4.0 if vote == honest else 1.0) for vote in range(3)])
                log[:, truth] += np.log(table / table.sum())[patterns[:, labeler]]
        for kind in np.unique(kinds):
            mine = kinds == kind
            rate = ((weights * posterior)[mine].sum() + 1) / (weights[mine].sum() + 2)
            log[mine, 1] += np.log(rate)
            log[mine, 0] += np.log(1 - rate)
        posterior = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -35, 35)))
    return posterior


def fit(docs: DataFrame) -> np.ndarray | None:
    """Weights of the span classifier, or None if there is no span at all."""
    schema = "votes array<int>, features array<int>, n bigint"
    table = docs.select("text").mapInArrow(_count_batches, schema).groupBy("votes", "features").agg(F.sum("n").alias("n"))
    rows = sorted((tuple(r[0]), tuple(r[1]), r[2]) for r in table.collect())
    if not rows:
        return None
    patterns, values = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    weights = np.array([r[2] for r in rows], dtype=float)
    soft = expectation_maximisation(patterns, values[:, 0], weights)
    return _fit_linear(values, soft, weights)


def _fit_linear(values: np.ndarray, soft: np.ndarray, weights: np.ndarray, penalty: float = 1e-3, steps: int = 400) -> np.ndarray:
    """Logistic regression on one-hot features with soft labels, by accelerated gradient steps."""
    places = _STARTS[:-1] + values
    weights = weights / weights.sum()
    found, ahead = np.zeros(_STARTS[-1]), np.zeros(_STARTS[-1])
    step = 4.0 / (len(_SIZES) * 1.0 + penalty)
    for number in range(steps):
        error = weights * (1 / (1 + np.exp(-ahead[places].sum(axis=1))) - soft)
        slope = np.bincount(places.ravel(), weights=np.repeat(error, places.shape[1]), minlength=len(found)) + penalty * ahead
        new = ahead - step * slope
        ahead = new + number / (number + 3) * (new - found)
        found = new
    return found


def find_spans(text: str, model: np.ndarray | None) -> list[tuple[str, int, int]]:
    """All spans by kind as listed, then start."""
    spans = base_spans(text)
    if model is not None:
        for kind, start, end in proposals(text):
            places = _STARTS[:-1] + np.array(features(kind, text, start, end))
            if 1 / (1 + np.exp(-model[places].sum())) >= THRESHOLD:
                spans.append((kind, start, end))
    return spans


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of base kinds, spans array<struct<kind, start, end>>) of every document."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(docs))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def spans_of(column: pa.Array) -> pa.Array:
        found = []
        for _, texts in string_chunks(column):
            found += [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t, model.value)] for t in texts]
        return pa.array(found, pa.list_(span))

    found = docs.select("doc_id", spans_of("text").alias("spans"))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, "spans")


def digest(found: DataFrame) -> DataFrame:
    """Spans as text, and the checksum of the base ones."""
    as_text = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    base_text = F.array_join(F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [f"n_{kind}" for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(base_text.cast("binary"), 256).alias("base_sha256"), F.array_join(as_text, ",").alias("spans"))
