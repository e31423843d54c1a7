"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at least
``max(LEAST, 2 * q)`` words that no neighbouring word extends. Many texts are searched at once: their words are
numbers in one array with a number of its own after each text.

- Periods below ``DIRECT`` are found by comparing the array with itself at that lag.
- A scale w finds the periods in [w, 2w). A place is sampled if the hash of the w/2 words from it on is the least
  in some window of w/4 places. What a window picks depends on its words only, so inside a run of period q the
  picks repeat q further on, and a window and its image fit into any run of two periods. Sampled places with
  equal hashes at a distance in [w, 2w) are seeds, which are extended word by word to the whole stretch; every
  run found is therefore exact, and a false seed finds nothing.
- A place has at most ``NEIGHBOURS`` equal ones within 2w, unless its words have a period below w/8. A run whose
  sampled places are all of that kind holds two stretches of one run A and, a period later, one run B of the same
  small period, both known by then. Either one end of A and B lies inside the run, and q is the distance of these
  ends; or A and B touch, and q is one of the distances at which their words agree. Both give seeds.

Work is in proportion to (words x log words), whatever the texts hold. Memory follows the chunk or its longest
text (some 150 bytes a word).

Defined results: null and empty texts have no word and no run; an empty table gives no rows; each row is looked at by
itself, so repeated rows and null ids just repeat; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import byte_chunks, mix
from .wordids import number_words, rows_of, separated

LEAST = 12
DIRECT = 32
NEIGHBOURS = 16
_BASE = 0x9E3779B97F4A7C15 | 1
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of every maximal stretch of at least ``least`` true values."""
    breaks = np.concatenate(([-1], np.flatnonzero(~equal), [len(equal)]))
    at = np.flatnonzero(np.diff(breaks) > least)
    return breaks[at] + 1, breaks[at + 1]


def sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """The least (or greatest) of each window of ``size`` values, ``size`` a power of two."""
    span = 1
    while span < size:
        values = best(values[:-span], values[span:])
        span *= 2
    return values


def content_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` numbers from each place on, size a power of two."""
    span, hashes, power = 1, mix(ids.astype(np.uint64) + np.uint64(1)), _BASE
    while span < size:
        hashes = hashes[:-span] * np.uint64(power) + hashes[span:]
        power = power * power % (1 << 64)
        span *= 2
    return mix(hashes)


def reach(ids: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The maximal [low, high) around ``place`` in which every number equals that ``lag`` places on."""
    end = len(ids) - lag
    high, step = place, 64
    while high < end:
        stop = min(end, high + step)
        bad = np.flatnonzero(ids[high:stop] != ids[high + lag : stop + lag])
        if len(bad):
            high += int(bad[0])
            break
        high, step = stop, 2 * step
    low, step = place, 64
    while low > 0:
        stop = max(0, low - step)
        bad = np.flatnonzero(ids[stop:low] != ids[stop + lag : low + lag])
        if len(bad):
            low = stop + int(bad[-1]) + 1
            break
        low, step = stop, 2 * step
    return low, high


class Found:
    """Runs as (start, end, period) arrays; of equal stretches the smallest period counts."""

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def add(self, starts, ends, periods):
        if len(starts):
            self.parts.append(np.column_stack((starts, ends, np.broadcast_to(periods, np.shape(starts)))).astype(np.int64))

    def table(self) -> np.ndarray:
        if not self.parts:
            return np.zeros((0, 3), dtype=np.int64)
        rows = np.concatenate(self.parts)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        first = np.ones(len(rows), dtype=bool)
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        self.parts = [rows[first]]
        return self.parts[0]


def direct_runs(ids: np.ndarray, found: Found) -> None:
    for lag in range(1, min(DIRECT, len(ids))):
        low, high = stretches(ids[lag:] == ids[:-lag], max(LEAST - lag, lag))
        found.add(low, high + lag, lag)


def minimizer_seeds(ids: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(place, distance) of equal sampled places; None if no content repeats, so no larger scale can find any."""
    size, window = scale // 2, scale // 4
    hashes = content_hashes(ids, size)
    if len(hashes) < window:
        return None
    least = sliding(hashes, window, np.minimum)
    edge = np.zeros(window - 1, dtype=np.uint64)
    places = np.flatnonzero(sliding(np.concatenate((edge, least, edge)), window, np.maximum) == hashes)
    keys = hashes[places]
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    seeds, distances, repeats = [], [], False
    for step in range(1, NEIGHBOURS + 1):
        same = np.flatnonzero(keys[step:] == keys[:-step])
        if not len(same):
            break
        repeats = True
        apart = places[same + step] - places[same]
        fit = (apart >= scale) & (apart < 2 * scale)
        seeds.append(places[same[fit]])
        distances.append(apart[fit])
    return (np.concatenate(seeds), np.concatenate(distances)) if repeats else None


def border_seeds(ids: np.ndarray, known: np.ndarray, scale: int):
    """(place, distance) that the ends of runs of one small period give."""
    runs = known[(known[:, 2] * 8 < scale) & (known[:, 1] - known[:, 0] >= scale // 2)]
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    for step in range(1, 7):
        one, other = runs[:-step], runs[step:]
        fit = one[:, 2] == other[:, 2]
        one, other = one[fit], other[fit]
        for places, distances in ((one[:, 1] - 1, other[:, 1] - one[:, 1]), (one[:, 0], other[:, 0] - one[:, 0])):
            near = (distances >= scale) & (distances < 2 * scale)
            yield from zip(places[near].tolist(), distances[near].tolist())
    touching = np.flatnonzero((runs[1:, 2] == runs[:-1, 2]) & (runs[1:, 0] <= runs[:-1, 1])) if len(runs) else []
    for at in touching:
        (first, end, period), (next_first, next_end, _) = runs[at].tolist(), runs[at + 1].tolist()
        turn = _rotation(ids[end - period : end], ids[next_first : next_first + period])
        if turn is None:
            continue
        rest = (next_first - end - turn) % period
        last = min(end - first, next_end - next_first, (next_end - first) // 2, 2 * scale - 1)
        for distance in range(scale + (rest - scale) % period, last + 1, period):
            yield max(first, next_first - distance), distance


def _rotation(one: np.ndarray, other: np.ndarray) -> int | None:
    """t with other[j] == one[(t + j) % period], or None."""
    at = np.concatenate((one, one)).tobytes()
    wanted, width, place = other.tobytes(), one.itemsize, at.find(other.tobytes())
    while place >= 0 and place % width:
        place = at.find(wanted, place + 1)
    return None if place < 0 else place // width % len(one)


def extend(ids: np.ndarray, places: np.ndarray, distances: np.ndarray, found: Found) -> None:
    """Add the runs that the seeds lie in; seeds inside a stretch that is known already are passed over."""
    order = np.lexsort((places, distances))
    places, distances = places[order], distances[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(distances)) + 1, [len(places)])) if len(places) else [0]
    starts, ends, periods = [], [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        mine, lag = places[a:b], int(distances[a])
        at = 0
        while at < len(mine):
            low, high = reach(ids, int(mine[at]), lag)
            if high - low >= max(lag, LEAST - lag):
                starts.append(low)
                ends.append(high + lag)
                periods.append(lag)
            at = max(at + 1, int(np.searchsorted(mine, high)))
    found.add(starts, ends, np.array(periods, dtype=np.int64))


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(start, end, period) of every run, by start, then period; ``bounds`` are the rows' first places in ``ids``.

    The last number of each row must occur nowhere else.
    """
    found = Found()
    direct_runs(ids, found)
    lengths, scale = np.diff(bounds), DIRECT
    while True:
        long = lengths > 2 * scale  # with the number that ends the row
        if not long.any():
            break
        known = found.table()
        # only rows with room for two periods take part
        kept = np.repeat(long, lengths)
        moved = np.flatnonzero(kept)
        part = ids[kept]
        seeds = minimizer_seeds(part, scale)
        if seeds is None:
            break
        shift = np.cumsum(kept) - 1
        inside = known[kept[known[:, 0]]]
        near = np.column_stack((shift[inside[:, 0]], shift[inside[:, 0]] + inside[:, 1] - inside[:, 0], inside[:, 2]))
        border = np.array(list(border_seeds(part, near, scale)), dtype=np.int64).reshape(-1, 2)
        here = Found()
        extend(part, np.concatenate((seeds[0], border[:, 0])), np.concatenate((seeds[1], border[:, 1])), here)
        new = here.table()
        found.add(moved[new[:, 0]], moved[new[:, 0]] + new[:, 1] - new[:, 0], new[:, 2])
        scale *= 2
    table = found.table()
    return table[np.lexsort((table[:, 2], table[:, 0]))]


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document.

    ``runs`` are by start, then period; ``collapsed`` is the text without the words that repeat an earlier period of a
    run (all words that some run holds after its first period), joined by single spaces.
    """

    def search(batches):
        for batch in batches:
            for first, data, offsets in byte_chunks(batch.column(1)):
                yield _describe(batch.column(0).slice(first, len(offsets) - 1), rows_of(data, offsets))

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(search, SCHEMA)


def _describe(ids: pa.Array, rows: list[bytes]) -> pa.RecordBatch:
    numbers, bounds, words = number_words(rows)
    joined, moved = separated(numbers, bounds)
    runs = find_runs(joined, moved)
    row = np.searchsorted(moved, runs[:, 0], "right") - 1
    edges = np.searchsorted(row, np.arange(len(rows) + 1)).astype(np.int32)
    # a word is dropped where more runs' repeats have begun than ended
    change = np.zeros(len(joined) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    dropped = np.cumsum(change[:-1]) > 0
    kept = []
    for at, own in enumerate(words):
        if edges[at] < edges[at + 1]:
            low = int(moved[at])
            own = [word for word, gone in zip(own, dropped[low : low + len(own)].tolist()) if not gone]
        kept.append(b" ".join(own))
    fields = [runs[:, 0] - moved[row], runs[:, 1] - runs[:, 0], runs[:, 2]]
    structs = pa.StructArray.from_arrays([pa.array(field, pa.int64()) for field in fields], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(np.diff(bounds), pa.int64()),
            pa.ListArray.from_arrays(pa.array(edges, pa.int32()), structs),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ],
        ["doc_id", "n_words", "runs", "collapsed"],
    )




def digest(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of ``detect``'s result."""
    told = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    longest = "array_max(transform(runs, r -> named_struct('length', r.length, 'start', -r.start, 'period', -r.period)))"
    return found.selectExpr("*", f"{longest} AS longest").selectExpr(
        "doc_id",
        "n_words",
        "CAST(size(runs) AS BIGINT) AS n_runs",
        "-longest.start AS start",
        "longest.length AS length",
        "-longest.period AS period",
        "1000 * longest.length DIV -longest.period AS exponent_milli",
        f"sha2(CAST({told} AS BINARY), 256) AS runs_sha256",
        "sha2(CAST(collapsed AS BINARY), 256) AS collapsed_sha256",
    )


def plant_runs(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, chosen by the checksum of their id, repeat a passage of their own to the end.

    With h the checksum and g = h div 10: if h % 10 = 0, the words from a = g % n on repeat the p = 1 + (n - a) div
    (3 + g % 8) words from a on. A null id, or a text without words, is left alone.
    """
    words = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"
    chosen = docs.selectExpr("doc_id", "text", "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) AS h")
    split = chosen.selectExpr("doc_id", "text", "h DIV 10 AS g", f"CASE WHEN h % 10 = 0 THEN {words} END AS words")
    placed = split.selectExpr("*", "CAST(size(words) AS BIGINT) AS n").selectExpr("*", "if(n > 0, g % n, 0L) AS a")
    measured = placed.selectExpr("*", "1 + (n - a) DIV (3 + g % 8) AS p")
    head, cycle = "slice(words, 1, CAST(a AS INT))", "slice(words, CAST(a + 1 AS INT), CAST(p AS INT))"
    again = f"flatten(array_repeat({cycle}, CAST((n - a + p - 1) DIV p AS INT)))"
    repeated = f"array_join(slice(concat({head}, {again}), 1, CAST(n AS INT)), ' ')"
    return measured.selectExpr("doc_id", f"CASE WHEN n > 0 THEN {repeated} ELSE text END AS text")
