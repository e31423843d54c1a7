"""Benchmark decontamination by template windows.

Texts become canonical tokens: numbers, runs of names, and units are typed placeholders, other words are
lower-cased. Windows of ``WINDOW`` canonical tokens of the benchmark are a hash table that is broadcast; every
document is searched whole where it is read, so nothing of the corpus is shuffled. Matched windows of an item whose
diagonals (document position minus item position) differ by at most ``DRIFT`` from the next form a chain, so that a
word put in or left out does not end it; a chain aligns each token of the document with one of the item at most. It
counts when it covers enough tokens and its slots are consistent: a value of the item stands for one value of the
document of its kind, except in ``TOLERATED`` slots and one more for each ``SLOTS_EACH`` slots. Different values of
the item may become the same one. This catches questions asked again with other numbers and names. The benchmark
is cut into slabs of at most ``SLAB_BYTES`` (a larger item is a slab of its own), one pass each, so a broadcast never
exceeds its bound.

A document is contaminated if a chain covers ``MIN_TOKENS`` tokens, or the whole of a shorter item, with
consistent slots. Template windows need ``MIN_PLAIN`` tokens that are not placeholders, and items of fewer than
``MIN_ITEM`` tokens are no templates. Beside them, windows of the plain lower-cased words are matched for items of
every length and with any words: that many unchanged tokens on one diagonal are an exact copy, whatever the
placeholders would be. An item of one or two words thus marks every document that has them.

Defined results: null and empty texts are clean; a null or empty item matches nothing; repeated items are all
listed; an empty benchmark leaves everything clean; other columns are passed through by ``remove``.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import Words, byte_chunks, hash_words, mix_int, ngrams, powers

WINDOW = 8
MIN_TOKENS = 13
MIN_ITEM = 5
MIN_PLAIN = 4
DRIFT = 3
TOLERATED = 1
SLOTS_EACH = 8
SLAB_BYTES = 8 << 20
FILTER_BITS = 22
PLAIN, NUMBER, NAME, UNIT = range(4)
PLACEHOLDERS = np.array([0] + [mix_int(1000 + kind) for kind in (NUMBER, NAME, UNIT)], dtype=np.uint64)
SCHEMA = "contaminated boolean, kind string, coverage double, items array<bigint>"

UNITS = """
mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer
kilometers kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons pound pounds ounce
ounces ml l cl gal liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour
hours day days week weeks month months year years kmh kph mph hz khz mhz ghz w kw mw v kv a j kj cal kcal pa
kpa c f k usd eur gbp dollar dollars cent cents euro euros percent
""".split()
NAMES = """
Alice Bob Carol Dave Eve Frank Grace Henry Ivan Jack James John Mary Robert Michael William David Richard
Joseph Thomas Charles Sarah Karen Lisa Nancy Betty Sandra Emily Anna Emma Olivia Sophia Liam Noah Ethan Lucas
Maria Jose Juan Luis Carlos Ana Carmen Pierre Jean Marie Claire Paul Hans Peter Klaus Greta Heidi Tom Tim Sam
Max Ben Amy Kate Jane Janet Susan Linda Laura Julia Natalia Weng Betty Ali Omar Fatima Wei Li Yuki Ravi Priya
""".split()


@lru_cache(maxsize=None)
def _sets() -> tuple[np.ndarray, np.ndarray]:
    return np.sort(hash_words(UNITS)), np.sort(hash_words(NAMES))


@lru_cache(maxsize=None)
def _byte_classes() -> dict[str, np.ndarray]:
    def table(chars):
        found = np.zeros(256, dtype=bool)
        found[list(chars)] = True
        return found

    return {
        "word": table([*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", *range(128, 256)]),
        "digit": table(b"0123456789"),
        "capital": table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "stop": table(b".!?:;\n\r"),
        "skip": table(b" \t\"'()[]*_"),
    }


@dataclass
class Tokens:
    """Plain words of a chunk (``raw``) and its canonical tokens, with what stands in their place (``values``)."""

    raw: np.ndarray
    rows: np.ndarray
    bounds: np.ndarray
    canonical: np.ndarray
    values: np.ndarray
    kind: np.ndarray
    template_rows: np.ndarray


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Plain and canonical tokens of a chunk of texts."""
    is_a = _byte_classes()
    data = data.copy()
    begins, ends = offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:][offsets[:-1] < offsets[1:]]
    before = np.concatenate(([0], data[:-1])).astype(np.uint8)
    before[begins] = 10
    accented = (before == 0xC3) & (data >= 0x80) & (data <= 0x9E)  # capitals with accents, in UTF-8
    data[accented] += 32
    digit = is_a["digit"][data]
    after_digit = np.zeros(len(data), dtype=bool)
    after_digit[:-1] = digit[1:]
    after_digit[ends - 1] = False
    inside = is_a["word"][data] | (((data == 46) | (data == 44)) & is_a["digit"][before] & after_digit)
    words = Words(data, offsets, inside)
    starts, rows = words.starts, words.rows
    kind = np.zeros(len(starts), dtype=np.int8)
    if len(starts):
        number = digit[starts]
        capital = is_a["capital"][data[starts]]
        second = np.minimum(starts + 1, len(data) - 1)
        capital |= (data[starts] == 0xC3) & accented[second]
        capital &= ~is_a["capital"][data[second]]  # words in capitals are no names
        solid = np.where(is_a["skip"][data], -1, np.arange(len(data)))
        last = np.maximum.accumulate(solid)[np.maximum(starts - 1, 0)]
        opens = (last < offsets[:-1][rows]) | (starts == offsets[:-1][rows])
        opens |= is_a["stop"][data[np.maximum(last, 0)]]
        units, names = _sets()
        named = capital & (~opens | _member(words.hashes, names))
        follows = np.zeros(len(starts), dtype=bool)
        follows[1:] = number[:-1] & (rows[1:] == rows[:-1])
        kind[named] = NAME
        kind[follows & _member(words.hashes, units)] = UNIT
        kind[number] = NUMBER
    # a run of names is one placeholder, whose value is the whole run
    goes_on = np.zeros(len(starts), dtype=bool)
    goes_on[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & (rows[1:] == rows[:-1])
    heads = np.flatnonzero(~goes_on)
    place = np.arange(len(starts)) - np.repeat(heads, np.diff(np.append(heads, len(starts))))
    scaled = words.hashes * powers(int(place.max()) + 1)[place] if len(starts) else words.hashes
    values = np.add.reduceat(scaled, heads) if len(heads) else scaled
    kind = kind[heads]
    canonical = np.where(kind == PLAIN, values, PLACEHOLDERS[kind])
    return Tokens(words.hashes, rows, words.bounds, canonical, values, kind, rows[heads])


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[place] == values


def _windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows, and which of them lie in one text."""
    made = ngrams(hashes, size)
    return made, rows[size - 1 :][: len(made)] == rows[: len(made)]


def _plain_enough(kind: np.ndarray, size: int) -> np.ndarray:
    plain = np.concatenate(([0], np.cumsum(kind == PLAIN)))
    return plain[size:] - plain[:-size] >= min(MIN_PLAIN, size)


class Table:
    """Windows of one size, sorted by hash, with their places."""

    def __init__(self, size: int, hashes: np.ndarray, at: np.ndarray):
        self.size = size
        self.places = at[np.argsort(hashes[at], kind="stable")]
        self.keys = hashes[self.places]
        self.likely = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.likely[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def meet(self, hashes: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, place) of all pairs of a good window and one of the table with its hash."""
        at = np.flatnonzero(good & self.likely[hashes >> np.uint64(64 - FILTER_BITS)])
        low, high = np.searchsorted(self.keys, hashes[at], "left"), np.searchsorted(self.keys, hashes[at], "right")
        counts = high - low
        skipped = np.repeat(low - (np.cumsum(counts) - counts), counts)
        return np.repeat(at, counts), self.places[skipped + np.arange(len(skipped))]


class Index:
    """Windows of some benchmark items, by window size: of the plain words, and of the canonical tokens."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        texts = [(t or "").encode() for _, t in items]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        found = tokens(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets)
        self.rows, self.values, self.kind, self.template_rows = found.rows, found.values, found.kind, found.template_rows
        self.lengths = np.diff(found.bounds)
        self.template_lengths = np.bincount(found.template_rows, minlength=len(items))
        self.plain = self._tables(found.raw, found.rows, self.lengths, 1)
        self.templates = self._tables(found.canonical, found.template_rows, self.template_lengths, MIN_ITEM, found.kind)

    @staticmethod
    def _tables(hashes, rows, lengths, least: int, kind=None) -> list[Table]:
        tables, size_of = [], np.minimum(lengths, WINDOW)
        for size in sorted({int(s) for s in size_of if s >= least}):
            made, good = _windows(hashes, rows, size)
            good &= size_of[rows[: len(made)]] == size
            if kind is not None:
                good &= _plain_enough(kind, size)
            if good.any():
                tables.append(Table(size, made, np.flatnonzero(good)))
        return tables

    def search(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, str, float]]]:
        """row -> [(item, kind, coverage)] for the contaminated rows of a chunk."""
        found = tokens(data, offsets)
        leaks = {}
        for row, item, covered in self._copies(found):
            leaks[row, item] = ("exact", covered / int(self.lengths[item]))
        for key, hits in self._chances(found).items():
            verdict = None if key in leaks else self._verdict(found, key[1], hits)
            if verdict:
                leaks[key] = verdict
        by_row = defaultdict(list)
        for (row, item), verdict in leaks.items():
            by_row[row].append((item, *verdict))
        return by_row

    def _copies(self, found: Tokens) -> list[tuple[int, int, int]]:
        """(row, item, tokens) of the items of which enough plain words stand unchanged on one diagonal."""
        copies = {}
        for table in self.plain:
            made, good = _windows(found.raw, found.rows, table.size)
            if not len(made):
                continue
            positions, places = table.meet(made, good)
            if not len(positions):
                continue
            rows, items = found.rows[positions], self.rows[places]
            covered, starts, order = _covered(rows, items, positions - places, positions, table.size)
            rows, items = rows[order][starts], items[order][starts]
            enough = covered >= np.minimum(MIN_TOKENS, self.lengths[items])
            for row, item, n in zip(rows[enough].tolist(), items[enough].tolist(), covered[enough].tolist()):
                copies[row, item] = max(n, copies.get((row, item), 0))
        return [(*key, n) for key, n in copies.items()]

    def _chances(self, found: Tokens) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray, int]]:
        """(row, item) -> (positions, places, size) where all matched windows together cover enough."""
        hits = {}
        for table in self.templates:
            made, good = _windows(found.canonical, found.template_rows, table.size)
            if not len(made):
                continue
            positions, places = table.meet(made, good & _plain_enough(found.kind, table.size))
            if not len(positions):
                continue
            rows, items = found.template_rows[positions], self.template_rows[places]
            covered, starts, order = _covered(rows, items, np.zeros_like(items), positions, table.size)
            ends = np.append(starts[1:], len(order))
            enough = covered >= np.minimum(MIN_TOKENS, self.template_lengths[items[order][starts]])
            for low, high in zip(starts[enough].tolist(), ends[enough].tolist()):
                one = order[low:high]  # an item has windows of one size only
                hits[int(rows[one[0]]), int(items[one[0]])] = (positions[one], places[one], table.size)
        return hits

    def _verdict(self, found: Tokens, item: int, hits: tuple[np.ndarray, np.ndarray, int]) -> tuple[str, float] | None:
        """The best chain of an item in a text, if one covers enough."""
        positions, places, size = hits
        length = int(self.template_lengths[item])
        shifts = positions - places
        order = np.lexsort((positions, shifts))
        positions, places, shifts = positions[order], places[order], shifts[order]
        best = None
        for one in np.split(np.arange(len(shifts)), np.flatnonzero(np.diff(shifts) > DRIFT) + 1):
            parts = np.split(one, np.flatnonzero(np.diff(shifts[one])) + 1)
            # all diagonals together, and if their slots contradict each other, each one alone
            for chain in [parts] if len(parts) == 1 else [parts, *([part] for part in parts)]:
                theirs, ours = _aligned(positions, places, chain, size, length)
                if len(theirs) < min(MIN_TOKENS, length) or not self._consistent(found, theirs, ours):
                    continue
                kind = "exact" if np.array_equal(found.values[theirs], self.values[ours]) else "reparameterised"
                best = max(best or ("", 0.0), (kind, len(theirs) / length), key=lambda v: (v[0] == "exact", v[1]))
                break
        return best

    def _consistent(self, found: Tokens, theirs: np.ndarray, ours: np.ndarray) -> bool:
        slots = self.kind[ours] != PLAIN
        told = defaultdict(Counter)
        for kind, a, b in zip(self.kind[ours[slots]].tolist(), self.values[ours[slots]].tolist(), found.values[theirs[slots]].tolist()):
            told[kind, a][b] += 1
        against = sum(count.total() - max(count.values()) for count in told.values())
        return against <= TOLERATED + int(slots.sum()) // SLOTS_EACH


def _aligned(positions: np.ndarray, places: np.ndarray, parts: list[np.ndarray], size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (document token, item token) of a chain's diagonals, each token once; the longest diagonals go first."""
    whole = np.concatenate(parts)
    first, begin = positions[whole].min(), places[whole].min()
    theirs_free = np.ones(positions[whole].max() + size - first, dtype=bool)
    ours_free = np.ones(places[whole].max() + size - begin, dtype=bool)
    theirs, ours, met = [], [], 0
    for part in sorted(parts, key=len, reverse=True):
        p = np.unique((positions[part][:, None] + np.arange(size)).ravel())
        q = p - (positions[part[0]] - places[part[0]])
        free = theirs_free[p - first] & ours_free[q - begin]
        p, q = p[free], q[free]
        theirs_free[p - first], ours_free[q - begin] = False, False
        theirs.append(p)
        ours.append(q)
        met += len(p)
        if met == length:
            break
    return np.concatenate(theirs), np.concatenate(ours)


def _covered(rows, items, shifts, positions, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens that the windows of each (row, item, shift) cover together; first window of each, and the order."""
    order = np.lexsort((positions, shifts, items, rows))
    first = np.ones(len(order), dtype=bool)
    first[1:] = False
    for column in (rows, items, shifts):
        first[1:] |= column[order][1:] != column[order][:-1]
    step = np.full(len(order), size, dtype=np.int64)
    step[1:] = np.minimum(np.diff(positions[order]), size)
    step[first] = size
    starts = np.flatnonzero(first)
    return np.add.reduceat(step, starts), starts, order


def build(benchmark: DataFrame) -> list:
    """Broadcast indexes of the benchmark, one per slab."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slabs = -(-total // SLAB_BYTES)
    context = benchmark.sparkSession.sparkContext
    slab = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(slabs, 1)))
    found = []
    for number in range(slabs):
        rows = [(r[0], r[1]) for r in items.where(slab == number).collect()]
        if rows:
            found.append(context.broadcast(Index(rows)))
    return found


def verdicts(column: pa.Array, index: Index) -> pa.Array:
    dirty = [False] * len(column)
    kinds, coverage, items = [None] * len(column), [0.0] * len(column), [[] for _ in dirty]
    for low, data, offsets in byte_chunks(column):
        for row, leaks in index.search(data, offsets).items():
            dirty[low + row] = True
            kinds[low + row] = "exact" if any(kind == "exact" for _, kind, _ in leaks) else "reparameterised"
            coverage[low + row] = max(share for _, _, share in leaks)
            ids = {index.ids[item] for item, _, _ in leaks}
            items[low + row] = sorted(ids - {None}) + [None] * (None in ids)
    columns = [pa.array(dirty), pa.array(kinds, pa.string()), pa.array(coverage), pa.array(items, pa.list_(pa.int64()))]
    return pa.StructArray.from_arrays(columns, ["contaminated", "kind", "coverage", "items"])


def _searcher(shared):
    @F.arrow_udf(SCHEMA)
    def searched(column: pa.Array) -> pa.Array:
        return verdicts(column, shared.value)

    return searched


def search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, kind, coverage, items) of every document."""
    indexes = build(benchmark)
    found = docs.select("doc_id", "text")
    for number, shared in enumerate(indexes):
        found = found.withColumn(f"v{number}", _searcher(shared)("text"))
    names = [f"v{number}" for number in range(len(indexes))]
    if not names:
        none = F.lit(None).cast("string")
        return found.select(
            "doc_id", F.lit(False).alias("contaminated"), none.alias("kind"), F.lit(0.0).alias("coverage"), F.expr("CAST(array() AS ARRAY<BIGINT>)").alias("items")
        )
    any_of = F.expr(" OR ".join(f"{n}.contaminated" for n in names))
    exact = F.expr(" OR ".join(f"{n}.kind <=> 'exact'" for n in names))
    return found.select(
        "doc_id",
        any_of.alias("contaminated"),
        F.when(exact, "exact").when(any_of, "reparameterised").alias("kind"),
        F.expr(f"array_max(array({', '.join(f'{n}.coverage' for n in names)}))").alias("coverage"),
        F.expr(f"array_sort(array_distinct(concat({', '.join(f'{n}.items' for n in names)})))").alias("items"),
    )


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold nothing of the benchmark, with all their columns."""
    clean = docs
    for shared in build(benchmark):
        clean = clean.where(~_searcher(shared)(F.col("text"))["contaminated"])
    return clean
