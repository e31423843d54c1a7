"""N-gram Jaccard join by prefix trees, and the groups that its links form.

A document's set is its distinct word n-grams; two documents link when 100 x intersection >= percent x union.
Equal sets are one vertex, so copies are never expanded into pairs. Two sets that link differ in at most k n-grams,
k from their sizes, so of more than k parts of the hash space some hold the same n-grams in both. A set signs its parts,
the fullest k + 1 of somewhat more in the order of all; sets that share a signature are a family, and only sets of one
family are compared. Signatures travel packed, 8 bytes each, dealt by their last bits. A part holds several n-grams, so
unlike single n-grams, signatures do not come to be shared by chance as a corpus grows; most sets share none and are done. Their texts are left out by a mask of hashes before the others are shuffled.

Within a family the n-gram order puts n-grams of a fixed slice of the hash space first, by rising document frequency
in the family (an n-gram that occurs once there can link nothing), and the others after it; any total order is right
for prefix filtering, this one makes prefixes rare. A set that has enough unique n-grams to fill its prefix links to nothing.

The prefixes of the rest are dealt by n-gram; two sets whose prefixes share the n-gram before have met at that
one and are not compared again. An n-gram of at most ``RARE`` sets goes to a task that builds a
trie of the prefixes below that n-gram, walks it once per different prefix, shares partial overlaps along its
paths and cuts subtrees whose remaining lengths cannot reach the needed overlap. More frequent n-grams, which
only sets without enough rare ones still hold, are split by set size and into salted blocks of about ``BLOCK_SETS``
sets. Their tasks walk a trie too and hold a sketch of each set (parities, which bound exactly how many n-grams two sets
differ in). All that these return is verified on whole sets. ``RARE`` and ``BLOCK_SETS`` bound a task's memory; they
decide nothing about the result.

Groups are joined up as they are found, so a group of near copies is never expanded into its pairs:

1. every set proposes one partner: from a rare n-gram, or from its block of its first frequent n-gram;
2. twice, one set of every group and n-gram is compared with those of other groups;
3. n-grams whose sets are all of one group by now are done. What is left is compared in full, pairs between two
   groups only: the sets of an n-gram's largest group are not spread against each other, all others are.

After each step the links that hold are contracted by star contraction (a smaller neighbour at a time, rounds
in proportion to the logarithm of the longest path). Every stage is written as Parquet and read back, so neither lineage
nor the planner's size estimates pile up, and no plan holds the work of two stages: Spark keeps the text of every plan
in the driver. Rows are counted while they are written; what has none left ends there. Up to step 3, rows are in proportion to sets (and groups per n-gram); in
step 3 an n-gram of m sets outside its largest group, of g sets, takes m (m + 2 g) / ``BLOCK_SETS`` rows.

Defined results: null and empty texts have 0 n-grams and stand alone; a text with fewer words than n is one
n-gram; repeated rows are one vertex; rows with a null doc_id take part, and the smallest non-null doc_id of
a group names it; an empty table gives no rows; other columns are ignored (passed through by ``keep_one``).
"""

from __future__ import annotations

import hashlib
import math
import uuid
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path
from .texts import Words, byte_chunks, mix, mix_int, ngrams

RARE = 64
BLOCK_SETS = 2000
CLASS_BITS = 47
OTHERS = 65535
TAIL = 32
TAIL_BITS = 24
BAND_GROWTH = 7, 5
BUCKETS = 4096
ROW_BITS = 28
FLUSH = 1 << 20
MASK_BITS = 25


def prefix_size(size, percent):
    """How many first n-grams of a set must meet those of any set it links to."""
    return size - -(-size * percent // 100) + 1


def least_size(percent: int) -> int:
    """Smaller sets link to equal ones only."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def slice_bound(percent: int) -> int:
    """Upper end of the hash slice whose document frequencies are counted: twice what a prefix needs."""
    return int(min(1.0, 2 * (1 - percent / 100)) * (1 << 64)) - 1


def _sets(data: np.ndarray, offsets: np.ndarray, n: int):
    """The sorted set of each row of a chunk."""
    words = Words(data, offsets)
    grams = ngrams(words.hashes, n)
    for low, high in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if high - low >= n:
            yield np.unique(grams[low : high - n + 1])
        elif high > low:
            # all of a short text is one n-gram, salted by its length
            yield mix(ngrams(words.hashes[low:high], high - low) + np.uint64(high - low))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


# --- signatures ----------------------------------------------------------------------------------


@lru_cache(maxsize=None)
def band_edges(percent: int) -> list[int]:
    """The smallest size of each band of set sizes, wide enough that a set links to its own band and the two beside it only."""
    edges, (up, down) = [least_size(percent)], BAND_GROWTH
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * up // down), -(-edges[-1] * 100 // percent)))
    return edges


@lru_cache(maxsize=256)
def band_parts(band: int, percent: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(largest size that links into the band, how many parts are signed, inner bounds of the parts, a salt for each)."""
    most = band_edges(percent)[band + 1] - 1
    last = most * 100 // percent
    signed = (most + last) * (100 - percent) // (100 + percent) + 1  # one more than two sets that link may differ in
    parts = signed + signed // 4
    bounds = np.array([(part << 64) // parts for part in range(1, parts)], dtype=np.uint64)
    return last, signed, bounds, mix(np.arange(parts, dtype=np.uint64) + np.uint64((band + 1) << 40))


def signatures(found: np.ndarray, percent: int) -> np.ndarray:
    """What two sets that link share at least one of: hashes of parts of a set, those with most n-grams first, from each of its bands.

    Two sets that differ in at most k n-grams differ in at most k parts. So of each one's first k + 1 parts, in one order
    of all parts that there are, some part is in both.
    """
    own = bisect_right(band_edges(percent), len(found)) - 1
    if own < 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(found) + 1, dtype=np.uint64)
    np.cumsum(found, out=total[1:])
    made = []
    for band in range(max(own - 1, 0), own + 1):
        last, signed, bounds, salts = band_parts(band, percent)
        if len(found) <= last:
            ends = np.concatenate(([0], np.searchsorted(found, bounds), [len(found)]))
            signs = mix(np.diff(total[ends]) + salts)
            made.append(signs[np.lexsort((signs, -np.diff(ends)))[:signed]])
    return np.concatenate(made)


SIGNED = [("bucket", pa.int32()), ("base", pa.int64()), ("entries", pa.binary())]
DESCRIBED = [("row", pa.int64()), ("doc_id", pa.int64()), ("h", pa.int64()), ("size", pa.int64()), ("digest", pa.binary())]


def _packed(base: int, rows: list[int], signs: list[np.ndarray]) -> pa.RecordBatch:
    """Signatures by bucket: in 8 bytes each, 36 bits of it above the place of its row after ``base``."""
    places = np.repeat(np.array(rows, dtype=np.uint64) - np.uint64(base), [len(one) for one in signs])
    signs = np.concatenate(signs)
    buckets = (signs % np.uint64(BUCKETS)).astype(np.int32)
    order = np.argsort(buckets, kind="stable")
    entries = (signs >> np.uint64(ROW_BITS) << np.uint64(ROW_BITS) | places)[order]
    used, starts = np.unique(buckets[order], return_index=True)
    edges = 8 * np.append(starts, len(entries)).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(edges), pa.py_buffer(entries)])
    return _described(bucket=pa.array(used, pa.int32()), base=pa.array(np.full(len(used), base), pa.int64()), entries=packed)


def _described(**columns) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    fields = [*DESCRIBED, *SIGNED]
    return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(rows, kind)) for name, kind in fields], [name for name, _ in fields])


def describe_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(row, doc_id, h, size, digest) of every row, ``h`` is a hash of its text; and other rows (bucket, base, entries) with the signatures."""

    def describe(batches):
        rows, signs, held = [], [], 0
        for batch in batches:
            for first, data, offsets in byte_chunks(batch.column(1)):
                sizes, digests = [], []
                numbers = batch.column(3).slice(first, len(offsets) - 1)
                for row, found in zip(numbers.to_pylist(), _sets(data, offsets, n)):
                    sizes.append(len(found))
                    digests.append(_digest(found))
                    signed = signatures(found, percent)
                    if not len(signed):
                        continue
                    if rows and (held >= FLUSH or row - rows[0] >= 1 << ROW_BITS):
                        yield _packed(rows[0], rows, signs)
                        rows, signs, held = [], [], 0
                    rows.append(row)
                    signs.append(signed)
                    held += len(signed)
                yield _described(
                    row=numbers,
                    doc_id=batch.column(0).slice(first, len(sizes)),
                    h=batch.column(2).slice(first, len(sizes)),
                    size=pa.array(sizes, pa.int64()),
                    digest=pa.array(digests, pa.binary()),
                )
        if rows:
            yield _packed(rows[0], rows, signs)

    schema = "row bigint, doc_id bigint, h bigint, size bigint, digest binary, bucket int, base bigint, entries binary"
    return docs.select(F.col("doc_id").cast("bigint"), "text", text_hash(), F.monotonically_increasing_id().alias("row")).mapInArrow(describe, schema)


def _meetings(batches):
    """Rows that share a signature, each with the first of that signature."""
    for table in whole_groups(batches):
        blobs = table.column(2).cast(pa.large_binary()).combine_chunks()
        _, offsets, data = blobs.buffers()
        edges = np.frombuffer(offsets, dtype=np.int64)[blobs.offset : blobs.offset + len(blobs) + 1]
        entries = np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]].view(np.uint64)
        counts = np.diff(edges) // 8
        # the bits of the bucket take the place of those of the row
        signs = (entries >> np.uint64(ROW_BITS)) * np.uint64(BUCKETS) + np.repeat(table.column(0).to_numpy().astype(np.uint64), counts)
        order = np.argsort(signs)
        signs = signs[order]
        first = np.concatenate(([True], signs[1:] != signs[:-1]))
        shared = ~first
        shared[:-1] |= ~first[1:]
        kept = np.flatnonzero(shared)  # most signatures are of one row
        if not len(kept):
            continue
        starts = np.flatnonzero(first[kept])
        order = order[kept]
        rows = np.repeat(table.column(1).to_numpy(), counts)[order] + (entries[order] & np.uint64((1 << ROW_BITS) - 1)).astype(np.int64)
        least = np.repeat(np.minimum.reduceat(rows, starts), np.diff(np.append(starts, len(rows))))
        by = np.lexsort((rows, least))
        rows, least = rows[by], least[by]
        new = rows != least
        new[1:] &= (rows[1:] != rows[:-1]) | (least[1:] != least[:-1])
        yield _pair_batch(least[new], rows[new])


def families(described: DataFrame, sets: DataFrame) -> tuple[DataFrame, int] | None:
    """(v, owner, h, digest, size, family) of the sets that share signatures, in families of two sets or more, and their number. None if there is none."""
    dealt = described.where("bucket IS NOT NULL").select("bucket", "base", "entries").repartition("bucket").sortWithinPartitions("bucket")
    met = stars(dealt.mapInArrow(_meetings, EDGES))
    if met is None:
        return None
    members = met.unionAll(met.select(F.col("root").alias("v"), "root").distinct())
    known = members.withColumnRenamed("v", "row").join(sets, "row")
    least = known.groupBy("digest").agg(F.min(F.struct("row", "doc_id", "h", "size", "root")).alias("s"))
    vertices, n_vertices = counted(
        _several(least.select(F.col("s.row").alias("v"), F.col("s.doc_id").alias("owner"), "s.h", "digest", "s.size", "s.root"), ["root"], "v")
    )
    return (vertices.withColumnRenamed("root", "family"), n_vertices) if n_vertices else None


def text_hash():
    return F.xxhash64("text").alias("h")


def prefixes(firsts: DataFrame, percent: int) -> DataFrame:
    """(v, size, gone, keys) of the sets (v, size, low, rest) whose prefix can meet another's.

    ``keys`` are the shared prefix n-grams as ordered numbers (frequency class above hash bits); ``gone``
    counts the unique ones before them.
    """
    grams = firsts.select("v", F.explode("low").alias("t"))
    shared = grams.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    key = f"shiftleft(least(df, {OTHERS - 1}L), {CLASS_BITS}) | shiftrightunsigned(t, {64 - CLASS_BITS})"
    hits = grams.join(shared, "t").groupBy("v").agg(F.array_sort(F.collect_list(F.expr(key))).alias("met"))
    need = f"(size - CAST(ceil(size * {percent} / 100) AS BIGINT) + 1)"
    others = f"transform(rest, t -> shiftleft({OTHERS}L, {CLASS_BITS}) | shiftrightunsigned(t, {64 - CLASS_BITS}))"
    return (
        firsts.select("v", "size", "rest", F.size("low").alias("n_low"))
        .join(hits, "v", "left")
        .withColumn("met", F.expr("coalesce(met, CAST(array() AS ARRAY<BIGINT>))"))
        .withColumn("gone", F.expr("CAST(n_low - size(met) AS BIGINT)"))
        .where(f"gone < {need}")
        .withColumn("keys", F.expr(f"slice(concat(met, {others}), 1, CAST({need} - gone AS INT))"))
        .where("size(keys) > 0")
        .select("v", "size", "gone", "keys")
    )


# --- the trie ------------------------------------------------------------------------------------


class Node:
    """A run of n-grams with one way on (``label``), then branches; and the sets whose prefix ends here."""

    __slots__ = ("label", "children", "members", "room", "least")

    def __init__(self, label: tuple, members: list[int], room: int, least: int):
        self.label, self.members, self.room, self.least = label, members, room, least
        self.children: dict[int, Node] = {}


class Trie:
    """Sets that share an n-gram, by the rest of their prefixes: ``tails[i]``, ``sizes[i]``, ``gones[i]``.

    A node knows the most n-grams that a set below it has left at the root (``room``) and the smallest size
    below it (``least``), which bound what any set below can still share.
    """

    def __init__(self, tails: list[tuple], sizes: list[int], gones: list[int], percent: int):
        self.sizes, self.percent = sizes, percent
        self.left = [size - gone for size, gone in zip(sizes, gones)]
        self.by_tail: dict[tuple, list[int]] = {}
        for member, tail in enumerate(tails):
            self.by_tail.setdefault(tail, []).append(member)
        self.root = Node((), [], 0, 1 << 62)

    def needed(self, one: int, other: int) -> int:
        return -(-self.percent * (one + other) // (100 + self.percent))

    def add(self, tail: tuple, members: list[int]) -> None:
        room, least = max(self.left[m] for m in members), min(self.sizes[m] for m in members)
        node, at = self.root, 0
        while True:
            node.room, node.least = max(node.room, room), min(node.least, least)
            if at == len(tail):
                node.members = members
                return
            child = node.children.get(tail[at])
            if child is None:
                node.children[tail[at]] = Node(tail[at:], members, room, least)
                return
            label, same = child.label, 1
            while same < len(label) and at + same < len(tail) and label[same] == tail[at + same]:
                same += 1
            if same < len(label):  # split the run where the two part
                upper = Node(label[:same], [], child.room, child.least)
                upper.children[label[same]] = child
                child.label = label[same:]
                node.children[tail[at]] = child = upper
            node, at = child, at + same

    def near(self, tail: tuple, members: list[int]):
        """(members, misses here, misses there) of the sets in the trie that one of ``members`` may link to."""
        size, room = min(self.sizes[m] for m in members), max(self.left[m] for m in members)
        floor, whole, part, end = -(-size * self.percent // 100), 100 + self.percent, self.percent, len(tail)
        stack = [(self.root, 0, 0, 0)]
        while stack:
            node, at, here, there = stack.pop()
            need = -(-part * (size + max(node.least, floor)) // whole)
            most_here, most_there = room - need, node.room - need
            for token in node.label:
                while at < end and tail[at] < token:
                    at += 1
                    here += 1
                if at == end:  # past the known prefix: the rest may or may not meet
                    break
                if tail[at] == token:
                    at += 1
                else:
                    there += 1
                    if there > most_there:
                        break
            if here > most_here or there > most_there:
                continue
            if node.members:
                yield node.members, here, there
            stack.extend((child, at, here, there) for child in node.children.values())

    def possible(self, one: int, other: int, here: int, there: int) -> bool:
        """Exact bound for two members."""
        a, b = self.sizes[one], self.sizes[other]
        return min(self.left[one] - here, self.left[other] - there) >= self.needed(a, b)

    def candidates(self):
        """Members with one tail against those with another (or the same), each once: the trie grows meanwhile."""
        for tail, members in self.by_tail.items():
            if len(members) > 1:
                yield members, members, 0, 0
            for others, here, there in self.near(tail, members):
                yield members, others, here, there
            self.add(tail, members)


def runs(batches, width: int):
    """Rows of a stream sorted by its first ``width`` columns, as lists of rows with one key."""
    key, rows = None, []
    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        for row in zip(*columns):
            if row[:width] != key:
                if rows:
                    yield key, rows
                key, rows = row[:width], []
            rows.append(row[width:])
    if rows:
        yield key, rows


def whole_groups(batches):
    """Batches of a stream sorted by its first column, cut so that no key is split."""
    rest = None
    for batch in batches:
        batch = pa.Table.from_batches([batch])
        if rest is not None:
            batch = pa.concat_tables([rest, batch])
        keys = batch.column(0).to_numpy()
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        rest = batch.slice(cut)
        if cut:
            yield batch.slice(0, cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _may_link(sizes: np.ndarray, gones: np.ndarray, prior: np.ndarray, roots: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets that share an n-gram can still link, by what lies before it; not those that met before or are of one group."""
    small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    needed = -(-percent * (small + large) // (100 + percent))
    fit = (np.minimum.outer(sizes - gones, sizes - gones) >= needed) & (100 * small >= percent * large)
    fit &= (prior[:, None] != prior[None, :]) | (prior[:, None] < 0)
    return fit & (roots[:, None] != roots[None, :])


def _rare_pairs(percent: int, one_each: bool):
    """Pairs of different roots that may link; with ``one_each`` only as many per n-gram as give every set a partner."""

    def pairs(batches):
        for table in whole_groups(batches):
            keys, ids, sizes, gones, before, roots = (table.column(i).to_numpy() for i in range(6))
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            counts = np.diff(np.append(starts, len(keys)))
            # most groups are pairs: look at their bounds before building anything
            two = starts[counts == 2]
            one, other = two, two + 1
            needed = -(-percent * (sizes[one] + sizes[other]) // (100 + percent))
            open_ = 1 + np.minimum(sizes[one] - gones[one], sizes[other] - gones[other]) - 1 >= needed
            open_ &= ((before[one] != before[other]) | (before[one] < 0)) & (roots[one] != roots[other])
            chosen = np.zeros(len(keys), dtype=bool)
            chosen[two[open_]] = True
            chosen[starts[counts > 2]] = True
            tails = table.column(6).chunk(0) if table.num_rows else None
            values, edges = tails.values.to_numpy(), tails.offsets.to_numpy()
            left, right = [], []
            for start, count in zip(starts[chosen[starts]].tolist(), counts[chosen[starts]].tolist()):
                rows = np.arange(start, start + count)
                fit = _may_link(sizes[rows], gones[rows], before[rows], roots[rows], percent)
                rows = rows[fit.any(axis=1)]
                if not len(rows):
                    continue
                fit = fit[np.ix_(rows - start, rows - start)]
                trie = Trie([tuple(values[edges[r] : edges[r + 1]].tolist()) for r in rows], sizes[rows].tolist(), gones[rows].tolist(), percent)
                paired = [False] * len(rows)
                for mine, theirs, *state in trie.candidates():
                    for x in mine:
                        for y in theirs:
                            if one_each and paired[x] and paired[y]:
                                continue
                            if fit[x, y] and (mine is not theirs or x < y) and trie.possible(x, y, *state):
                                paired[x] = paired[y] = True
                                a, b = int(ids[rows[x]]), int(ids[rows[y]])
                                left.append(min(a, b))
                                right.append(max(a, b))
            yield _pair_batch(left, right)

    return pairs


def _pair_batch(left, right):
    return pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


class Block:
    """Sets that share a frequent n-gram, or those of them that may link, in one task; a union-find joins them up."""

    def __init__(self, rows, percent: int, roots=None):
        self.ids, self.salts, self.lower, self.sizes, gones, self.prior, tails = zip(*rows)
        self.trie = Trie([tuple(tail) for tail in tails], list(self.sizes), list(gones), percent)
        firsts: dict[int, int] = {}
        self.above = [firsts.setdefault(root, member) for member, root in enumerate(roots or self.ids)]

    def root(self, member: int) -> int:
        above = self.above
        while above[member] != member:
            above[member] = above[above[member]]
            member = above[member]
        return member

    def meet_here(self, one: int, other: int, same_salt: bool) -> bool:
        """A pair of one salt belongs to that salt's own block, two larger sets to the next band, and two sets with
        the same n-gram before this one have met there."""
        if not same_salt and self.salts[one] == self.salts[other] or not (self.lower[one] or self.lower[other]):
            return False
        return not self.prior[one] == self.prior[other] >= 0

    def joins(self, same_salt: bool, test):
        """Pairs that pass ``test``, of two groups each, which are then one; pairs within a group are not looked at."""
        root = self.root
        for mine, theirs, *state in self.trie.candidates():
            groups: dict[int, list[int]] = {}
            for other in theirs:
                groups.setdefault(root(other), []).append(other)
            for one in mine:
                for others in groups.values():
                    for other in others:
                        if root(one) == root(other):
                            break
                        if self.meet_here(one, other, same_salt) and self.trie.possible(one, other, *state) and test(one, other):
                            self.above[root(one)] = root(other)
                            yield one, other
                            break


def _likely_joins(percent: int):
    """Per block, the joins of sets that may link by their sketches, and the smallest set of what they join up."""
    names = ("key", "band", "i", "j", "forest", "v", "w")

    def joins(batches):
        for place, rows in runs(batches, 4):
            block = Block([row[:7] for row in rows], percent, [row[7] for row in rows])
            sizes, needed = block.sizes, block.trie.needed
            sketches = fold_alike([row[8] for row in rows])

            def close(one, other):
                room = sizes[one] + sizes[other] - 2 * needed(sizes[one], sizes[other])
                return (sketches[one] ^ sketches[other]).bit_count() <= room

            found = [(block.ids[one], block.ids[other], one) for one, other in block.joins(place[2] == place[3], close)]
            made = [(*place, block.ids[block.root(at)], one, other) for one, other, at in found]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in (zip(*made) if made else [[]] * 7)], names)

    return joins


def _exact_joins(percent: int):
    """Links that join two groups among the sets of one forest; ``root`` tells which are joined already."""

    def joins(batches):
        for (_, _, one_salt, other_salt, _), rows in runs(batches, 5):
            block = Block([row[:7] for row in rows], percent, [row[7] for row in rows])
            sets = [np.array(row[8], dtype=np.int64) for row in rows]
            found = block.joins(one_salt == other_salt, lambda one, other: _linked(sets[one], sets[other], percent))
            made = [(block.ids[one], block.ids[other]) for one, other in found]
            yield _pair_batch([min(pair) for pair in made], [max(pair) for pair in made])

    return joins


def sketch(found: np.ndarray) -> bytes:
    """Parities of a set's n-grams by their last hash bits, about two places for each.

    Two sets differ in at least as many n-grams as their sketches do in bits, so the bound that sketches give is exact.
    """
    places = 1 << max(8, int(2 * len(found) - 1).bit_length())
    counts = np.bincount((found & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def fold_alike(sketches: list[bytes]) -> list[int]:
    """Sketches as numbers, folded to the length of the shortest."""
    shortest, folded = 8 * min(map(len, sketches)), []
    for one in sketches:
        number, places = int.from_bytes(one, "little"), 8 * len(one)
        while places > shortest:
            places //= 2
            number = (number ^ (number >> places)) & ((1 << places) - 1)
        folded.append(number)
    return folded


def _linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(other) - both)


# --- links and groups ----------------------------------------------------------------------------

PLACE = ["key", "band", "i", "j"]
EDGES = "a bigint, b bigint"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written and read back: computed once, without lineage, and with the size that they really have."""
    path = scratch_path(df.sparkSession, "jaccard")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows as ``stored``, and their number, which is taken while they are written."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return stored(df.observe(seen, F.count("*").alias("n"))), seen.get["n"]


def stored_edges(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Edges (low, high) as ``stored``, with their number and a checksum that are taken while they are written."""
    seen = Observation(f"edges-{uuid.uuid4().hex}")
    watched = edges.observe(seen, F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("low", "high")), F.lit(0)).alias("sum"))
    return stored(watched), (seen.get["n"], seen.get["sum"])


class Groups:
    """Which group each set is in so far: ``labels`` has (v, root) of the sets that are not their group's root."""

    def __init__(self, labels: DataFrame):
        self.labels = labels

    @classmethod
    def single(cls, spark) -> Groups:
        return cls(spark.createDataFrame([], "v bigint, root bigint"))

    def of(self, rows: DataFrame, v: str = "v", root: str = "root") -> DataFrame:
        """``rows`` with the root of each set in column ``v``."""
        named = self.labels.select(F.col("v").alias("_v"), F.col("root").alias("_root"))
        joined = rows.join(named, F.col(v) == F.col("_v"), "left")
        return joined.withColumn(root, F.coalesce("_root", v)).drop("_v", "_root")

    def joined(self, links: DataFrame | None) -> Groups:
        """The groups after joining up those that the links (a, b) connect; the same object if there is nothing to join."""
        if links is None:
            return self
        star = stars(self.of(self.of(links, "a", "a"), "b", "b"))
        if star is None:
            return self
        moved = star.select(F.col("v").alias("_v"), F.col("root").alias("_root"))
        known = self.labels.join(moved, F.col("root") == F.col("_v"), "left").select("v", F.coalesce("_root", "root").alias("root"))
        return Groups(stored(known.unionAll(star)))


def stars(edges: DataFrame, rounds: list | None = None) -> DataFrame | None:
    """(v, root) of every vertex of the edges (a, b) that reaches a smaller one; ``root`` is the smallest it reaches.
    None if no edge joins two vertices.

    Large and small stars in turn: each vertex hands its larger neighbours, then its smaller ones, to the smallest
    vertex that it sees. Rows are at most edges and vertices together.
    """
    ordered = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    now, state = stored_edges(ordered.where("low < high").distinct())
    if not state[0]:
        return None
    while True:
        if rounds is not None:
            rounds.append(state[0])
        least = now.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
        large = now.join(least, F.col("low") == F.col("u"), "left").select(F.coalesce("m", "low").alias("low"), "high")
        least = large.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
        small = large.join(least, F.col("high") == F.col("u"))
        both = small.select(F.col("m").alias("low"), F.explode(F.array("low", "high")).alias("high"))
        before = state
        now, state = stored_edges(both.where("low < high").distinct())
        if state == before:
            return now.select(F.col("high").alias("v"), F.col("low").alias("root"))


def one_each(candidates: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b), one for each set that has any."""
    ways = F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("w")), F.struct(F.col("b").alias("v"), F.col("a").alias("w"))))
    partner = candidates.select(ways.alias("way")).groupBy("way.v").agg(F.min("way.w").alias("w"))
    return partner.select(F.least("v", "w").alias("a"), F.greatest("v", "w").alias("b")).distinct()


def join_up(firsts: DataFrame, whole: DataFrame, percent: int) -> Groups:
    """The groups of all vertices; ``firsts`` is the stored result of ``prefixes``, ``whole`` has their whole sets."""
    rows = firsts.select("v", "size", "gone", "keys", F.posexplode("keys").alias("pos", "key"))
    is_rare = F.shiftright("key", CLASS_BITS) <= RARE
    gone, prior = (F.col("gone") + F.col("pos")).alias("gone"), F.expr("if(pos > 0, keys[pos - 1], -1L)").alias("prior")
    # what comes after is cut to TAIL rare n-grams of 4 bytes: what a trie does not know it takes for shared
    rarer = F.expr(f"filter(slice(keys, pos + 2, {TAIL}), k -> shiftright(k, {CLASS_BITS}) <= {RARE})")
    short = F.transform(rarer, lambda k: F.shiftright(k, CLASS_BITS - TAIL_BITS).cast("int")).alias("tail")
    rare = rows.where(is_rare).select("key", "v", "size", gone, prior, short)
    whole_tail = F.expr("slice(keys, pos + 2, greatest(size(keys) - pos - 1, 0))").alias("tail")
    frequent = rows.where(~is_rare).select("key", "v", "size", gone, prior, whole_tail)

    # sets of neighbouring sizes can link: each goes to its own band and to the one below
    own = F.floor(F.log("size") / (math.log(100 / percent) * 1.001))
    banded = frequent.withColumn("own", own).select("*", F.explode(F.array("own", F.col("own") - 1)).alias("band"))
    banded, n_banded = counted(banded.select("key", "band", (F.col("own") == F.col("band")).alias("lower"), "v", "size", "gone", "prior", "tail"))
    groups = Groups.single(firsts.sparkSession)

    partners = _rare(rare.withColumn("root", F.col("v")), percent, True)

    # 1. one partner for each set
    near = partners
    if n_banded:
        start = banded.where(F.shiftright("prior", CLASS_BITS) <= RARE)
        near = near.unionAll(_blocks(start.withColumn("root", F.col("v")), whole, percent).select("a", "b"))
    groups = groups.joined(_verified(one_each(near), whole, percent))
    if n_banded:
        groups = _join_frequent(groups, banded, whole, percent)

    between = _rare(_several(groups.of(rare), ["key"]), percent, False).distinct()
    return groups.joined(_verified(between, whole, percent))


def _join_frequent(groups: Groups, banded: DataFrame, whole: DataFrame, percent: int) -> Groups:
    """Steps 2 and 3: the groups after joining up those that share a frequent n-gram."""
    told, n_told = counted(_several(groups.of(banded), ["key", "band"]))

    # 2. one set for each group and n-gram
    for chosen in (F.min, F.max):
        if not n_told:
            return groups
        member = told.groupBy("key", "band", "root", "lower").agg(chosen(F.struct("v", "size", "gone", "prior", "tail")).alias("m"))
        likely = _blocks(member.select("key", "band", "lower", "m.*", "root"), whole, percent)
        before, groups = groups, groups.joined(_verified(one_each(likely.select("a", "b")), whole, percent))
        if groups is not before:  # a place whose sets are of one group stays so
            told, n_told = counted(_several(groups.of(told.drop("root")), ["key", "band"]))

    # 3. all pairs between groups that are left
    if not n_told:
        return groups
    spread = stored(_spread(told))
    likely, n_likely = counted(_likely(spread, whole, percent))
    if not n_likely:
        return groups
    pairs = likely.select(F.least("v", "w").alias("a"), F.greatest("v", "w").alias("b")).distinct()
    groups = groups.joined(_verified(pairs, whole, percent))
    # a block joins up what may link; where such a forest still holds several groups, its sets are walked again
    members = groups.of(likely.select(*PLACE, "forest", F.explode(F.array("v", "w", "forest")).alias("v")).distinct())
    forests = members.groupBy(*PLACE, "forest").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    # the other sets of a group in the forest were joined to it before the walk
    met, n_met = counted(members.join(forests.drop("low", "high"), [*PLACE, "forest"]).select(*PLACE, "forest", "root").distinct())
    if not n_met:
        return groups
    again = groups.of(spread.drop("root")).join(met, [*PLACE, "root"])
    again = again.join(whole.select("v", "grams"), "v").select(*PLACE, "forest", *MEMBER, "root", "grams")
    exact = again.repartition(*PLACE, "forest").sortWithinPartitions(*PLACE, "forest").mapInArrow(_exact_joins(percent), EDGES)
    return groups.joined(exact)


MEMBER = ["v", "salt", "lower", "size", "gone", "prior", "tail"]


def _rare(rooted: DataFrame, percent: int, partners: bool) -> DataFrame:
    dealt = rooted.select("key", "v", "size", "gone", "prior", "root", "tail").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_rare_pairs(percent, partners), EDGES)


def _several(rooted: DataFrame, place: list[str], root: str = "root") -> DataFrame:
    """The rows of places that hold sets of several groups."""
    groups = rooted.groupBy(*place).agg(F.min(root).alias("least"), F.max(root).alias("most")).where("least < most")
    return rooted.join(groups.drop("least", "most"), place, "left_semi")


def _blocks(rows: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Likely pairs inside salted blocks of each n-gram and size band, every set in one block."""
    counted = rows.groupBy("key", "band").agg(F.count("*").alias("m"), F.max("lower").alias("l")).where("m > 1 AND l")
    blocks = counted.select("key", "band", F.ceil(F.col("m") / BLOCK_SETS).alias("salts"))
    dealt = rows.join(blocks, ["key", "band"]).withColumn("salt", F.pmod(F.xxhash64("v"), F.col("salts")))
    placed = dealt.select("key", "band", F.col("salt").alias("i"), F.col("salt").alias("j"), *MEMBER, "root")
    found = _likely(placed, whole, percent)
    return found.select(F.least("v", "w").alias("a"), F.greatest("v", "w").alias("b"))


def _likely(placed: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """(place, forest, v, w): the pairs of different groups that may link, as forests in each place."""
    sketched = placed.join(whole.select("v", "sketch"), "v").select(*PLACE, *MEMBER, "root", "sketch")
    return sketched.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(
        _likely_joins(percent), "key bigint, band bigint, i bigint, j bigint, forest bigint, v bigint, w bigint"
    )


def _spread(rows: DataFrame) -> DataFrame:
    """Sets in pairs of salted blocks. Those of a place's largest group meet the others only: their salts are negative."""
    sizes = rows.groupBy("key", "band", "root").agg(F.count("*").alias("m"), F.max("lower").alias("l"))
    largest = sizes.groupBy("key", "band").agg(
        F.max_by("root", F.struct("m", "root")).alias("largest"), F.max("m").alias("g"), F.sum("m").alias("m"), F.max("l").alias("l")
    )
    salts = largest.where("l").select(
        "key", "band", "largest", F.ceil(F.col("g") / BLOCK_SETS).alias("inner"), F.ceil((F.col("m") - F.col("g")) / BLOCK_SETS).alias("outer")
    )
    dealt = rows.join(salts, ["key", "band"]).withColumn("in_largest", F.expr("root = largest"))
    salt = F.expr("if(in_largest, -1 - pmod(xxhash64(v), inner), pmod(xxhash64(v), outer))")
    peers = F.expr("if(in_largest, sequence(0L, outer - 1), sequence(-inner, outer - 1))")
    met = dealt.withColumn("salt", salt).select("*", F.explode(peers).alias("peer"))
    place = ["key", "band", F.least("salt", "peer").alias("i"), F.greatest("salt", "peer").alias("j")]
    return met.select(*place, *MEMBER, "root")


def _verified(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame | None:
    """The pairs that link: by their sketches at first, and what is left by the whole sets. None if none is left."""
    x = whole.select(F.col("v").alias("a"), F.size("grams").alias("m"), F.col("sketch").alias("p"))
    y = whole.select(F.col("v").alias("b"), F.size("grams").alias("n"), F.col("sketch").alias("q"))
    sketched = pairs.join(x, "a").join(y, "b").select("a", "b", "m", "n", "p", "q")
    # few by now: stored, they are broadcast to the whole sets instead of sorting those twice
    likely, n_likely = counted(sketched.mapInArrow(_close_pairs(percent), EDGES))
    if not n_likely:
        return None
    one, other = whole.select(F.col("v").alias("a"), F.col("grams").alias("x")), whole.select(F.col("v").alias("b"), F.col("grams").alias("y"))
    met = likely.join(one, "a").join(other, "b").withColumn("i", F.size(F.array_intersect("x", "y")))
    return met.where(f"100 * i >= {percent} * (size(x) + size(y) - i)").select("a", "b")


def _close_pairs(percent: int):
    def close(batches):
        for batch in batches:
            left, right = [], []
            for a, b, m, n, *both in zip(*(column.to_pylist() for column in batch.columns)):
                p, q = fold_alike(both)
                if (p ^ q).bit_count() <= m + n - 2 * -(-percent * (m + n) // (100 + percent)):
                    left.append(a)
                    right.append(b)
            yield _pair_batch(left, right)

    return close


def may_own(texts: DataFrame, vertices: DataFrame, count: int) -> DataFrame:
    """The rows (.., h) of ``texts`` without most of those whose hash no vertex has, so that few texts are shuffled.

    What is broadcast is a mask in words of 64 bits: 16 to 32 bits for each vertex, at most 2 ** ``MASK_BITS`` in all.
    """
    bits = min(MASK_BITS, max(6, (16 * count).bit_length()))
    word = F.shiftright(F.shiftrightunsigned("h", 64 - bits), 6)
    place = f"CAST(shiftrightunsigned(h, {64 - bits}) & 63 AS INT)"
    mask = vertices.select(word.alias("word"), F.expr(f"shiftleft(1L, {place})").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return texts.join(F.broadcast(mask), (word == F.col("word")) & F.expr(f"shiftrightunsigned(bits, {place}) & 1L = 1L"), "left_semi")


def whole_sets(docs: DataFrame, vertices: DataFrame, count: int, n: int, percent: int) -> DataFrame:
    """(v, grams, sketch, low, rest): the whole sets of some vertices, made again from their owners' texts.

    ``low`` is the counted slice, ``rest`` fills a prefix it is too small for; both are salted by family, so that families
    share nothing, and in the order that the salt gives.
    """
    wanted = vertices.select("v", F.col("owner").alias("_owner"), F.col("h").alias("_h"), "digest", "family")
    texts = may_own(docs.select(F.col("doc_id").cast("bigint").alias("_doc"), "text", text_hash()), vertices, count)
    rows = texts.join(wanted, F.col("_doc").eqNullSafe(F.col("_owner")) & (F.col("h") == F.col("_h")))
    bound = np.uint64(slice_bound(percent))

    def first_grams(found, family):
        salt = np.uint64(mix_int(family + 1))
        cut = int(np.searchsorted(found, bound, "right"))
        missing = max(0, prefix_size(len(found), percent) - cut)
        return (found[:cut] ^ salt).view(np.int64), np.sort(found[cut:] ^ salt)[:missing].view(np.int64)

    def build(batches):
        for batch in batches:
            for low, data, offsets in byte_chunks(batch.column(3)):
                found = list(_sets(data, offsets, n))
                v, digests, of = (batch.column(i).slice(low, len(found)) for i in range(3))
                right = [_digest(x) == d for x, d in zip(found, digests.to_pylist())]
                sets = [x for x, ok in zip(found, right) if ok]
                parts = [first_grams(x, family) for x, family, ok in zip(found, of.to_pylist(), right) if ok]
                yield pa.RecordBatch.from_pydict(
                    {
                        "v": v.filter(pa.array(right)),
                        "grams": pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                        "sketch": pa.array([sketch(x) for x in sets], pa.binary()),
                        "low": pa.array([part[0] for part in parts], pa.list_(pa.int64())),
                        "rest": pa.array([part[1] for part in parts], pa.list_(pa.int64())),
                    }
                )

    schema = "v bigint, grams array<bigint>, sketch binary, low array<bigint>, rest array<bigint>"
    made = rows.select("v", "digest", "family", "text").mapInArrow(build, schema)
    names = ("grams", "sketch", "low", "rest")
    return made.groupBy("v").agg(*(F.first(name).alias(name) for name in names))  # rows that repeat id and text


def components(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Stored (row, doc_id, h, size, digest) of every row, and (digest, group) of the sets that are not alone."""
    described = stored(describe_sets(docs, n, percent))
    sets = described.where("bucket IS NULL").select("row", "doc_id", "h", "size", "digest")
    copied = sets.where("size > 0").groupBy("digest").agg(F.min("row").alias("group"), F.count("*").alias("copies")).where("copies > 1")
    related = families(described, sets)
    if related is not None:
        linked = _linked_sets(docs, *related, n, percent)
        copied = copied.join(linked, "digest", "left_anti").select("digest", "group").unionAll(linked)
    return sets, stored(copied.select("digest", "group"))


def _linked_sets(docs: DataFrame, vertices: DataFrame, count: int, n: int, percent: int) -> DataFrame:
    """(digest, group) of the sets that link; ``vertices`` are those in families."""
    whole = stored(whole_sets(docs, vertices, count, n, percent))
    firsts = stored(prefixes(vertices.select("v", "size").join(whole.select("v", "low", "rest"), "v"), percent))
    labels = join_up(firsts, whole, percent).labels
    members = labels.unionAll(labels.select(F.col("root").alias("v"), "root").distinct())
    return members.join(vertices.select("v", "digest"), "v").select("digest", F.col("root").alias("group"))


def groups(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    sets, grouped = components(docs, n, percent)
    told = sets.join(grouped, "digest", "left")
    # merged per set before groups meet: copies do not travel
    least = sets.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(grouped, "digest").groupBy("group").agg(F.min("doc_id").alias("component"))
    return told.join(least, "group", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id")
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest doc_id.

    A document is a doc_id and a text, so rows that repeat both stay or go together. Where no member has an id (or
    several have the smallest one) the smallest hash of the text decides; texts without words stay.
    """
    sets, grouped = components(docs, n, percent)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    # one row for each document of a group
    member = sets.groupBy("digest", "doc_id", "h").agg(F.count("*").alias("rows")).join(grouped, "digest").withColumn("rank", rank)
    best = member.groupBy("group").agg(F.min("rank").alias("best"))
    away = stored(member.join(best, "group").where("rank > best").select(F.col("doc_id").alias("_away"), F.col("h").alias("_h")))
    marked = docs.withColumn("_text_hash", F.xxhash64("text"))
    gone = docs["doc_id"].cast("bigint").eqNullSafe(away["_away"]) & (F.col("_text_hash") == away["_h"])
    return marked.join(away, gone, "left_anti").select(*docs.columns)
