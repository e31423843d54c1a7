"""Quality rules by line labelling: a linear-chain conditional random field marks lines as content or boilerplate.

A document is its sequence of lines that hold a word. A line's score for each of the two labels is linear in what it
looks like (length, shares of symbols, capitals, digits, repeated words, ...), and neighbouring labels have
weights of their own. Viterbi decoding gives the most likely labels of the whole sequence; a document stays if the
base rules pass and at least ``MIN_CONTENT`` of its words are in content lines.

The field is trained here, from labels of whole documents. Lines of good documents are content. Which lines of a
bad document are to blame is not told: all are at first; then fitting and relabelling them by the fitted field take
turns, where a bad document keeps at least its most suspect line. Training reads a bounded sample: at most
``SAMPLE_DOCS`` labelled documents and ``SAMPLE_PARTS`` different stretches of at most ``PART_LINES`` lines of each
class, those with the smallest hashes. All other counts and decisions cover whole texts.

Defined results: a null text has no word and fails the base rules, like any text of fewer than ``MIN_WORDS`` words; an
empty table gives no rows; without labels of both classes there is no field and every line is content; labels that
are null or contradict each other are not used; repeated rows and null ids are decided row by row; ``keep_clean``
passes every other column through, whatever its name. Memory follows the chunk or its longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .texts import byte_chunks, space_table
from .wordids import number_words, rows_of

SAMPLE_DOCS = 2000
SAMPLE_PARTS = 4000
PART_LINES = 64
ROUNDS = 4
STEPS = 150
PENALTY = 1e-3
MIN_WORDS = 50
MAX_REPEATED = 50
MIN_CONTENT = 0.5
BOILERPLATE, CONTENT = 0, 1
FEATURES = (
    "bias", "log_words", "short", "symbols", "bars", "bangs", "capitals", "digits", "sentence_end", "capital_start",
    "repeated", "duplicate", "word_length",
)
RESULT = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, n_lines bigint, content_words bigint, boilerplate array<bigint>, kept boolean"
)


def _marks(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[list(characters)] = 1
    return table


_SYMBOLS, _BARS, _BANGS = _marks(b"#*$%&|<>"), _marks(b"|"), _marks(b"!")
_UPPER, _DIGITS = _marks(bytes(range(65, 91))), _marks(b"0123456789")
_LETTERS = _UPPER | _marks(bytes(range(97, 123)))
# bytes that begin a character other than white space
_CHARACTERS = (~space_table() & ((np.arange(256) & 0xC0) != 0x80)).astype(np.uint8)


def _sums(table: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of a per-byte value from each start to the next; starts rise strictly."""
    return np.add.reduceat(table[data], starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)


def repeated_words(ids: np.ndarray, bounds: np.ndarray, size: int = 3) -> np.ndarray:
    """Which words lie in a window of ``size`` words that their row holds at least twice."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = np.arange(len(ids)) + size <= bounds[row + 1]
    at = np.flatnonzero(inside)
    covered = np.zeros(len(ids) + size, dtype=bool)
    if not len(at):
        return covered[: len(ids)]
    key, limit = row[at], len(bounds) - 1
    kinds = int(ids.max()) + 1
    for place in range(size):
        if limit * kinds >= 1 << 62:  # number the keys anew, so that they stay exact
            key = np.unique(key, return_inverse=True)[1]
            limit = int(key.max()) + 1
        key, limit = key * kinds + ids[at + place], limit * kinds
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for place in range(size):
        covered[at[twice] + place] = True
    return covered[: len(ids)]


class LineChunk:
    """Counts of the rows of a chunk, and features of their lines that hold a word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        rows = rows_of(data, offsets)
        ids, bounds, _ = number_words(rows)
        count = len(rows)
        self.n_words = np.diff(bounds)
        full = np.flatnonzero(np.diff(offsets) > 0)
        self.word_chars, self.n_symbols = np.zeros(count, np.int64), np.zeros(count, np.int64)
        self.word_chars[full] = _sums(_CHARACTERS, data, offsets[:-1][full])
        self.n_symbols[full] = _sums(_SYMBOLS, data, offsets[:-1][full])
        covered = repeated_words(ids, bounds)
        total = np.concatenate(([0], np.cumsum(covered)))
        self.n_repeat_words = total[bounds[1:]] - total[bounds[:-1]]
        self.base_failed = (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > MAX_REPEATED * self.n_words)

        inside = ~space_table()[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        begins[offsets[:-1][full]] = inside[offsets[:-1][full]]
        ends[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
        word_starts, word_ends = np.flatnonzero(begins), np.flatnonzero(ends)

        breaks = np.flatnonzero(data == 10)
        starts = np.unique(np.concatenate((offsets[:-1][full], breaks + 1)))
        line_of_word = np.searchsorted(starts, word_starts, "right") - 1
        used, first = np.unique(line_of_word, return_index=True)
        last = np.append(first, len(ids))[1:] - 1
        starts = starts[used]
        self.words = np.diff(np.append(first, len(ids)))
        self.row = np.searchsorted(offsets, starts, "right") - 1
        self.bounds = np.searchsorted(self.row, np.arange(count + 1))
        before = np.searchsorted(breaks, starts)
        self.number = before - np.searchsorted(breaks, offsets[self.row])
        stops = offsets[self.row + 1]
        if len(breaks):
            stops = np.minimum(stops, np.append(breaks, len(data))[before])
        duplicate = self._duplicates(data.tobytes(), starts, stops)
        self.n_dup_lines = np.bincount(self.row[duplicate], minlength=count)

        if len(starts):
            repeats = np.add.reduceat(covered, first, dtype=np.int64)
        else:
            repeats = np.zeros(0, np.int64)
        chars = np.maximum(_sums(_CHARACTERS, data, starts), 1)
        letters = np.maximum(_sums(_LETTERS, data, starts), 1)
        end = data[word_ends[last]] if len(last) else np.zeros(0, np.uint8)
        per_word = lambda table: np.minimum(_sums(table, data, starts) / np.maximum(self.words, 1), 1)
        self.features = np.column_stack(
            [
                np.ones(len(starts)),
                np.log1p(self.words) / 4,
                self.words <= 3,
                per_word(_SYMBOLS),
                per_word(_BARS),
                per_word(_BANGS),
                _sums(_UPPER, data, starts) / letters,
                _sums(_DIGITS, data, starts) / chars,
                np.isin(end, (33, 46, 63)),
                _UPPER[data[word_starts[first]]] if len(first) else np.zeros(0),
                repeats / np.maximum(self.words, 1),
                duplicate,
                np.minimum(chars / np.maximum(self.words, 1) / 10, 3),
            ]
        ).astype(np.float64)

    def _duplicates(self, whole: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Which lines equal an earlier one of their row."""
        marks, row, seen = [], -1, set()
        for own, a, b in zip(self.row.tolist(), starts.tolist(), stops.tolist()):
            if own != row:
                row, seen = own, set()
            line = whole[a:b]
            marks.append(line in seen)
            seen.add(line)
        return np.array(marks, dtype=bool)


# --- the field -----------------------------------------------------------------------------------


class Field:
    """``weights``: a row of feature weights per label; ``moves[a, b]``: label b after label a; ``first``: the first label."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, first: np.ndarray):
        self.weights, self.moves, self.first = weights, moves, first

    def viterbi(self, features: np.ndarray) -> list[int]:
        """The most likely labels of a sequence; of equally likely ones content is preferred."""
        if not len(features):
            return []
        scores = features @ self.weights.T
        (a, b), ((aa, ab), (ba, bb)) = (scores[0] + self.first).tolist(), self.moves.tolist()
        from_a, from_b = [], []
        for low, high in scores[1:].tolist():
            stay, come = a + aa, b + ba
            leave, keep = a + ab, b + bb
            from_a.append(come >= stay)
            from_b.append(keep >= leave)
            a, b = max(stay, come) + low, max(leave, keep) + high
        label = int(b >= a)
        labels = [label]
        for to_a, to_b in zip(reversed(from_a), reversed(from_b)):
            label = int(to_b if label else to_a)
            labels.append(label)
        return labels[::-1]


class Packed:
    """Sequences of lines, longest first, line by line: the lines at place t are rows ``edges[t]`` to ``edges[t + 1]``,
    one for each of the first sequences, in the same order at every place."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(lines) for lines in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        at_least = (lengths[:, None] > np.arange(lengths.max())).sum(axis=0)
        self.edges = np.concatenate(([0], np.cumsum(at_least)))
        self.lines = np.concatenate([[sequences[s][t] for s in self.order[:n]] for t, n in enumerate(at_least)])

    def places(self, sequence: int, length: int) -> np.ndarray:
        """Rows of the sequence that is ``sequence``-th in order."""
        return self.edges[:length] + sequence


def expectations(field: Field, packed: Packed) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum of the sequences' log normalisers, label probabilities of every line, and sums of move probabilities."""
    scores = packed.lines @ field.weights.T
    edges, moves = packed.edges, np.exp(field.moves)
    scores[: edges[1]] += field.first
    top = scores.max(axis=1, keepdims=True)
    own = np.exp(scores - top)
    ahead, scale = np.empty_like(own), np.empty((len(own), 1))
    for t in range(len(edges) - 1):
        here = slice(edges[t], edges[t + 1])
        count = edges[t + 1] - edges[t]
        values = own[here] if t == 0 else (ahead[edges[t - 1] : edges[t - 1] + count] @ moves) * own[here]
        scale[here] = values.sum(axis=1, keepdims=True)
        ahead[here] = values / scale[here]
    behind, pairs = np.ones_like(own), np.zeros((2, 2))
    for t in range(len(edges) - 2, 0, -1):
        here, before = slice(edges[t], edges[t + 1]), slice(edges[t - 1], edges[t - 1] + edges[t + 1] - edges[t])
        into = own[here] * behind[here] / scale[here]
        pairs += (ahead[before].T @ into) * moves
        behind[before] = into @ moves.T
    return float(np.log(scale).sum() + top.sum()), ahead * behind, pairs


def fit_field(packed: Packed, truth: np.ndarray, start: Field | None = None) -> Field:
    """Maximum likelihood with a small penalty, by Adam steps over the whole (bounded) sample."""
    width, lines, firsts = packed.lines.shape[1], len(packed.lines), packed.edges[1]
    known = np.column_stack((truth == BOILERPLATE, truth == CONTENT)).astype(np.float64)
    moves = np.zeros((2, 2))
    for t in range(1, len(packed.edges) - 1):
        here, count = packed.edges[t], packed.edges[t + 1] - packed.edges[t]
        moves += known[packed.edges[t - 1] : packed.edges[t - 1] + count].T @ known[here : here + count]

    def sums(labels, pairs):
        return np.concatenate(((labels.T @ packed.lines).ravel(), pairs.ravel(), labels[:firsts].sum(axis=0)))

    told = sums(known, moves)
    at = np.zeros(len(told)) if start is None else np.concatenate((start.weights.ravel(), start.moves.ravel(), start.first))
    speed, size = np.zeros(len(at)), np.zeros(len(at))
    for step in range(1, STEPS + 1):
        _, labels, pairs = expectations(_unpack(at, width), packed)
        slope = (told - sums(labels, pairs)) / lines - PENALTY * at
        speed, size = 0.9 * speed + 0.1 * slope, 0.99 * size + 0.01 * slope * slope
        at = at + 0.2 * (speed / (1 - 0.9**step)) / (np.sqrt(size / (1 - 0.99**step)) + 1e-8)
    return _unpack(at, width)


def _unpack(at: np.ndarray, width: int) -> Field:
    return Field(at[: 2 * width].reshape(2, width), at[2 * width : 2 * width + 4].reshape(2, 2), at[2 * width + 4 :])


def train(parts: list[tuple[int, np.ndarray]]) -> Field | None:
    """A field from (quality, line features) of stretches of good and bad documents; None without both."""
    if len({quality for quality, _ in parts}) < 2:
        return None
    packed = Packed([features for _, features in parts])
    truth = np.full(len(packed.lines), CONTENT)
    bad = [(place, at) for place, at in enumerate(packed.order.tolist()) if parts[at][0] == 0]
    for place, at in bad:
        truth[packed.places(place, len(parts[at][1]))] = BOILERPLATE
    field = fit_field(packed, truth)
    for _ in range(ROUNDS - 1):
        for place, at in bad:
            own = parts[at][1]
            labels = field.viterbi(own)
            if BOILERPLATE not in labels:
                labels[int(np.argmax(own @ (field.weights[BOILERPLATE] - field.weights[CONTENT])))] = BOILERPLATE
            truth[packed.places(place, len(own))] = labels
        field = fit_field(packed, truth, field)
    return field


# --- on Spark ------------------------------------------------------------------------------------


def least_hashes(stored: DataFrame, hash_column: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the smallest hashes. A bound on the hash goes first, so that tasks send few rows in sum."""
    share = (2 * limit + 1000) / max(stored.count(), 1)
    bound = min(int(share * (1 << 64)), (1 << 64) - 1) - (1 << 63)
    return stored.where(F.col(hash_column) <= bound).orderBy(hash_column).limit(limit)


def training_parts(docs: DataFrame, labels: DataFrame) -> list[tuple[int, np.ndarray]]:
    """The bounded sample: (quality, line features) of stretches of labelled documents, in a fixed order."""
    marked = labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("int")).where("doc_id IS NOT NULL AND quality IN (0, 1)")
    agreed = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    agreed = materialize(agreed.select("doc_id", "quality", F.xxhash64("doc_id").alias("h")))
    ids = [least_hashes(agreed.where(f"quality = {quality}"), "h", SAMPLE_DOCS) for quality in (0, 1)]
    sample = F.broadcast(ids[0].unionAll(ids[1]).select("doc_id", "quality"))  # at most 2 x SAMPLE_DOCS rows
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").join(sample, "doc_id").select("quality", "text")

    def cut(batches):
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(1)):
                chunk = LineChunk(data, offsets)
                marks = batch.column(0).slice(low, len(offsets) - 1).to_pylist()
                kinds, found = [], []
                for mark, a, b in zip(marks, chunk.bounds.tolist(), chunk.bounds[1:].tolist()):
                    for at in range(a, b, PART_LINES):
                        kinds.append(mark)
                        found.append(chunk.features[at : min(b, at + PART_LINES)].ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.int32()), pa.array(found, pa.list_(pa.float64()))], ["quality", "features"]
                )

    parts = texts.mapInArrow(cut, "quality int, features array<double>").withColumn("h", F.xxhash64("features"))
    parts = materialize(parts.groupBy("quality", "h").agg(F.first("features").alias("features")))
    found = []
    for quality in (0, 1):
        rows = least_hashes(parts.where(f"quality = {quality}"), "h", SAMPLE_PARTS).collect()
        found += [(quality, np.array(row["features"]).reshape(-1, len(FEATURES))) for row in sorted(rows, key=lambda r: r["h"])]
    return found


def _decide(chunk: LineChunk, field: Field | None):
    """(content words, numbers of boilerplate lines) of each row."""
    words, lines = chunk.words.tolist(), chunk.number.tolist()
    for a, b in zip(chunk.bounds.tolist(), chunk.bounds[1:].tolist()):
        labels = field.viterbi(chunk.features[a:b]) if field else [CONTENT] * (b - a)
        yield sum(n for n, label in zip(words[a:b], labels) if label), [n for n, label in zip(lines[a:b], labels) if not label]


def _kept(chunk: LineChunk, content: np.ndarray) -> np.ndarray:
    return ~chunk.base_failed & (content >= MIN_CONTENT * chunk.n_words)


def label_lines(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base verdict, boilerplate lines (numbers of \\n-split lines, from 0) and verdict of every document."""
    field = train(training_parts(docs, labels))

    def run(batches):
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(1)):
                chunk = LineChunk(data, offsets)
                found = list(_decide(chunk, field))
                content = np.array([n for n, _ in found], dtype=np.int64)
                counts = (chunk.n_words, chunk.word_chars, chunk.n_symbols, chunk.n_dup_lines, chunk.n_repeat_words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, len(found)),
                        *[pa.array(c, pa.int64()) for c in counts],
                        pa.array(chunk.base_failed),
                        pa.array(np.diff(chunk.bounds), pa.int64()),
                        pa.array(content),
                        pa.array([lines for _, lines in found], pa.list_(pa.int64())),
                        pa.array(_kept(chunk, content)),
                    ],
                    [column.split()[0] for column in RESULT.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, RESULT)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    field, text = train(training_parts(docs, labels)), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            kept = []
            for _, data, offsets in byte_chunks(batch.column(text)):
                chunk = LineChunk(data, offsets)
                kept.append(_kept(chunk, np.array([n for n, _ in _decide(chunk, field)], dtype=np.int64)))
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
