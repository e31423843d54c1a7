"""Line labelling, ranked search and periodic runs against brute-force versions, and on awkward input."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import ball_tree, line_crf, periodic_runs
from tidemark.llm.queries import QUERIES
from tidemark.llm.wordids import separated

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = "The cat sat on the mat and looked at the moon over the quiet town while rain fell on the roof.\n"
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, PLAIN * 4),
    (5, PLAIN.upper()),
    (5, PLAIN.upper()),
    (None, PLAIN),
    (6, "a" * 200_000),
    (7, " ".join(f"w{i}" for i in range(30_000))),
    (8, "x | y | z\n" * 4000),
    (9, "ÉCOLE école école\n    tail"),
]
EXTRA = ("row", "n", "runs", "h", "words", "quality", "score", "rank", "terms", "item_id")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, *[7] * len(EXTRA)) for d, t in ROWS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{c} int" for c in EXTRA)).repartition(3)


@pytest.fixture(scope="module")
def documents():
    return brute.documents(SF)


def words_of(text):
    return WORD.findall(text or "")


# --- periodic runs -------------------------------------------------------------------------------


def all_runs(words):
    """Every lag, word by word; of equal stretches the smallest period."""
    found = {}
    for lag in range(1, len(words) // 2 + 1):
        at = 0
        while at < len(words) - lag:
            stop = at
            while stop < len(words) - lag and words[stop] == words[stop + lag]:
                stop += 1
            if stop - at + lag >= max(12, 2 * lag):
                found.setdefault((at, stop + lag), lag)
            at = max(stop, at + 1)
    return sorted((start, end - start, lag) for (start, end), lag in found.items())


def fast_runs(sequences):
    ids = np.array([word for words in sequences for word in words], dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(words) for words in sequences])))
    joined, moved = separated(ids, bounds)
    found = [[] for _ in sequences]
    for start, end, lag in periodic_runs.find_runs(joined, moved).tolist():
        at = int(np.searchsorted(moved, start, "right")) - 1
        found[at].append((start - int(moved[at]), end - start, lag))
    return [sorted(runs) for runs in found]


def fibonacci(n):
    one, other = [0], [0, 1]
    while len(other) < n:
        one, other = other, other + one
    return other[:n]


def drawn_words(draw):
    n, kind = draw.randrange(600), draw.randrange(6)
    if kind == 0:
        return [draw.randrange(2) for _ in range(n)]
    if kind == 1:
        return fibonacci(n + 2)
    if kind == 2:
        return [bin(i).count("1") % 2 for i in range(n)]
    if kind == 3:  # runs of one small period that touch, so that larger periods hold only them
        root, found = [draw.randrange(3) for _ in range(draw.randrange(1, 5))], []
        while len(found) < n:
            found += root * draw.randrange(1, 40) + root[: draw.randrange(len(root))]
        return found
    if kind == 4:
        part = [draw.randrange(9) for _ in range(draw.randrange(1, 200))]
        return [draw.randrange(9) for _ in range(20)] + part * draw.randrange(1, 5) + part[: len(part) // 3]
    gaps = [0] * draw.randrange(1, 120) + [1] + [0] * draw.randrange(1, 120) + [1]
    return (gaps * draw.randrange(1, 4))[:700]


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_exact_on_repetitive_words(seed):
    draw = random.Random(seed)
    sequences = [drawn_words(draw) for _ in range(25)]
    found = fast_runs(sequences)
    assert found == [all_runs(words) for words in sequences]
    assert any(lag >= 64 for runs in found for _, _, lag in runs)


def test_runs_of_a_long_constant_text_stay_cheap():
    assert fast_runs([[0] * 300_000, [1] * 11, [2] * 12]) == [[(0, 300_000, 1)], [], [(0, 12, 1)]]


def planted(doc, words):
    checksum = zlib.crc32(str(doc).encode())
    if doc is None or checksum % 10 or not words:
        return words
    g, n = checksum // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected_runs(doc, text):
    words = planted(doc, words_of(text))
    runs = all_runs(words)
    gone = {i for start, length, lag in runs for i in range(start + lag, start + length)}
    told = "".join(f"{start},{length},{lag}\n" for start, length, lag in sorted(runs, key=lambda r: (r[0], r[2])))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    left = " ".join(word for i, word in enumerate(words) if i not in gone)
    exponent = 1000 * best[1] // best[2] if best else None
    hashes = [hashlib.sha256(part.encode()).hexdigest() for part in (told, left)]
    return (len(runs), *(best or (None, None, None)), exponent, *hashes)


RUN_COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_op13_against_brute_force(spark, documents):
    found = {r.doc_id: tuple(r[c] for c in RUN_COLUMNS) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(found) == len(documents)
    short = [(doc, text) for doc, text in documents if len(words_of(text)) <= 600]
    assert len(short) > 700
    for doc, text in short:
        assert found[doc] == expected_runs(doc, text), doc


def test_op13_on_awkward_rows(spark, docs):
    rows = periodic_runs.digest(periodic_runs.detect(periodic_runs.plant_runs(docs))).collect()
    short = [(d, t) for d, t in ROWS if len(words_of(t)) < 1000]
    expected = sorted([(d, *expected_runs(d, t)) for d, t in short], key=repr)
    assert sorted([(r.doc_id, *(r[c] for c in RUN_COLUMNS)) for r in rows if r.doc_id not in (7, 8)], key=repr) == expected
    long = {r.doc_id: r for r in rows}
    menu = planted(8, words_of(dict(ROWS)[8]))
    assert (long[8].n_runs > 0) and long[8].n_words == len(menu) == 20_000
    assert periodic_runs.digest(periodic_runs.detect(docs.where("false"))).count() == 0


# --- ranked search -------------------------------------------------------------------------------


def brute_rank(docs, items, k=20):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", brute.fold(text))

    counted = [(doc, terms(text)) for doc, text in docs]
    counted = [(doc, found) for doc, found in counted if found]
    documents, total = len(counted), sum(len(found) for _, found in counted)
    having = {}
    for _, found in counted:
        for term in set(found):
            having[term] = having.get(term, 0) + 1
    rows = []
    for item, text in items:
        scored = []
        for doc, found in counted:
            m, score = 75 + 25 * len(found) * documents // total, 0
            for term in terms(text):
                tf = found.count(term)
                if tf:
                    weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * having[term] + 1)))
                    score += weight * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        rows += [(item, i, doc, -score) for i, (score, _, doc) in enumerate(sorted(scored, key=lambda s: s[:2] + (s[2] or 0,))[:k], 1)]
    return sorted(rows, key=repr)


def found_rank(docs, items, **settings):
    ranked = ball_tree.rank(docs, items, **settings).select("item_id", "rank", "doc_id", "score")
    return sorted([tuple(row) for row in ranked.collect()], key=repr)


def test_op12_on_awkward_rows(spark, docs):
    items = [(1, None), (2, ""), (3, "nothing_known q9q9"), (4, "the moon, THE moon; école"), (None, "cat ÉCOLE"), (4, "w17 w17 a")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    for block in (30, 1 << 20):  # some blocks, and all in one
        assert found_rank(docs, frame, k=3, block_bytes=block) == brute_rank(ROWS, items, 3)
    assert found_rank(docs.where("false"), frame) == found_rank(docs, frame.where("false")) == []


def test_op12_ties_go_to_small_ids_whatever_the_leaves(spark):
    rows = [(i, "same words here") for i in range(700)] + [(i, f"same words {i % 7} more") for i in range(700, 1500)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").orderBy(F.desc("doc_id"))
    items = [(1, "same words here"), (2, "more 3 words"), (3, "5 6")]
    assert found_rank(frame, spark.createDataFrame(items, "item_id int, text string")) == brute_rank(rows, items)


def test_bounds_hold_and_prune():
    draw = np.random.default_rng(7)
    width, edges, terms = 400, [0], []
    for row in range(3000):  # rows around a few topics
        topic = row % 12
        own = np.unique((topic * 30 + draw.integers(0, 40, 25)) % width)
        terms.append(own)
        edges.append(edges[-1] + len(own))
    values = draw.integers(1, 1_000_000, edges[-1])
    whole = ball_tree.Slice(np.concatenate(terms), values, np.array(edges))
    root = ball_tree.grow(whole, width)
    weights = np.zeros(width)
    weights[30:60] = draw.integers(1, 40_000, 30)
    scores = whole.dots(weights.astype(np.int64))

    def check(ball):
        if ball.members is None:
            return check(ball.first) + check(ball.second)
        assert ball.bound(weights) >= scores[ball.rows].max()
        return len(ball.rows)

    assert check(root) == 3000
    best, space = ball_tree.BestList(20), (np.zeros(width, np.int64), np.zeros(width))
    wanted = np.flatnonzero(weights)
    opened = ball_tree.search(root, np.arange(3000), wanted, weights[wanted].astype(np.int64), space, best)
    expected = sorted(((int(s), -i) for i, s in enumerate(scores)), reverse=True)[:20]
    assert sorted(best.heap, reverse=True) == expected and opened < 3000 / 32 / 2


# --- line labelling ------------------------------------------------------------------------------


def base_counts(text):
    words, text = words_of(text), text or ""
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = {}
    for window in windows:
        count[window] = count.get(window, 0) + 1
    covered = {i + j for i, window in enumerate(windows) if count[window] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if words_of(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@pytest.fixture(scope="module")
def labelled(spark):
    return QUERIES["op11_quality_rules"](spark, SF).collect()


def test_op11_base_counts(labelled, documents):
    found = {r.doc_id: tuple(r[c] for c in COUNTS) for r in labelled}
    assert found == {doc: base_counts(text) for doc, text in documents}
    assert not any(r.kept and r.base_failed for r in labelled)


def test_op11_parts_good_from_bad_documents(spark, labelled):
    kept = {r.doc_id: r.kept for r in labelled if not r.base_failed}
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("p"))
    marks = [(kept[r.doc_id], r.q) for r in labels.where("q = p").collect() if r.doc_id in kept]
    good, bad = [k for k, q in marks if q], [k for k, q in marks if not q]
    assert len(good) > 50 and sum(good) >= 0.97 * len(good)
    assert len(bad) > 20 and sum(bad) <= 0.15 * len(bad)


def test_op11_is_right_on_documents_that_were_not_learnt(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    half = labels.where("pmod(xxhash64(doc_id), 2) = 0")
    found = line_crf.label_lines(docs, half).where("NOT base_failed").select("doc_id", "kept")
    held = labels.where("pmod(xxhash64(doc_id), 2) = 1").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("p"))
    rows = found.join(held.where("q = p"), "doc_id").collect()
    good, bad = [r.kept for r in rows if r.q], [r.kept for r in rows if not r.q]
    assert len(good) > 500 and sum(good) >= 0.98 * len(good)
    assert len(bad) > 50 and sum(bad) <= 0.1 * len(bad)


@pytest.fixture(scope="module")
def quality(spark):
    rows = [(4, 1, 0), (5, 1, 0), (5, 0, 1), (None, 1, 1), (8, 0, 1), (99, 1, 1), (7, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_op11_on_awkward_rows(docs, quality):
    found = line_crf.label_lines(docs, quality)
    rows = sorted([tuple(r) for r in found.select("doc_id", *COUNTS).collect()], key=repr)
    assert rows == sorted([(d, *base_counts(t)) for d, t in ROWS], key=repr)
    assert line_crf.label_lines(docs.where("false"), quality).count() == 0
    unlabelled = line_crf.label_lines(docs, quality.where("false"))
    assert unlabelled.where("kept = base_failed OR size(boilerplate) > 0").count() == 0
    clean = line_crf.keep_clean(docs, quality)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} <= {4, 7, 8}


def drawn_field(draw):
    return line_crf.Field(draw.normal(size=(2, 3)), draw.normal(size=(2, 2)), draw.normal(size=2))


def score(field, lines, labels):
    total = field.first[labels[0]] + sum(lines[i] @ field.weights[label] for i, label in enumerate(labels))
    return total + sum(field.moves[a, b] for a, b in zip(labels, labels[1:]))


def test_viterbi_and_expectations_against_all_labelings():
    draw = np.random.default_rng(3)
    field = drawn_field(draw)
    sequences = [draw.normal(size=(n, 3)) for n in (1, 7, 3, 5, 1, 8)]
    packed = line_crf.Packed(sequences)
    total, labels, pairs = line_crf.expectations(field, packed)
    normaliser, moves = 0.0, np.zeros((2, 2))
    for place, at in enumerate(packed.order.tolist()):
        lines = sequences[at]
        ways = list(itertools.product((0, 1), repeat=len(lines)))
        scores = np.array([score(field, lines, way) for way in ways])
        assert tuple(field.viterbi(lines)) == ways[int(np.argmax(scores))]
        weights = np.exp(scores)
        normaliser += math.log(weights.sum())
        weights /= weights.sum()
        marginal = [sum(w for w, way in zip(weights, ways) if way[t]) for t in range(len(lines))]
        assert np.allclose(labels[packed.places(place, len(lines)), 1], marginal)
        for w, way in zip(weights, ways):
            for a, b in zip(way, way[1:]):
                moves[a, b] += w
    assert math.isclose(total, normaliser) and np.allclose(pairs, moves)


def test_fitting_recovers_a_planted_field():
    draw = np.random.default_rng(5)
    field = line_crf.Field(np.array([[1.0, -2.0, 0.0], [-1.0, 2.0, 0.0]]), np.array([[1.0, -1.0], [-1.0, 1.0]]), np.zeros(2))
    sequences = [draw.normal(size=(6, 3)) for _ in range(400)]
    packed = line_crf.Packed(sequences)
    truth = np.zeros(len(packed.lines), dtype=int)
    for place, at in enumerate(packed.order.tolist()):
        ways = list(itertools.product((0, 1), repeat=6))
        weights = np.exp([score(field, sequences[at], way) for way in ways])
        truth[packed.places(place, 6)] = ways[draw.choice(len(ways), p=weights / weights.sum())]
    fitted = line_crf.fit_field(packed, truth)
    odds = fitted.weights[1] - fitted.weights[0]
    assert np.allclose(odds, [-2, 4, 0], atol=0.7)
    assert fitted.moves[0, 0] + fitted.moves[1, 1] - fitted.moves[0, 1] - fitted.moves[1, 0] > 2
