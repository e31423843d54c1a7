"""Plain re-computations of the registered queries, by other means than the operators use."""

from __future__ import annotations

import re
import zlib

import duckdb
from tokenizers import Tokenizer


def documents(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def jaccard_groups(rows, n, percent):
    """{row number: (set size, smallest doc_id reachable)}, from an inverted index over whole sets."""
    sets = [shingles(text, n) for _, text in rows]
    above = list(range(len(rows)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    posting = {}
    for i, mine in enumerate(sets):
        counts = {}
        for gram in mine:
            for j in posting.setdefault(gram, []):
                counts[j] = counts.get(j, 0) + 1
            posting[gram].append(i)
        for j, both in counts.items():
            if 100 * both >= percent * (len(mine) + len(sets[j]) - both):
                above[root(i)] = root(j)
    best = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        if doc is not None:
            best[r] = min(doc, best.get(r, doc))
    return {i: (len(sets[i]), best.get(root(i))) for i in range(len(rows))}


def token_ids(texts, plain=True):
    """Ids of the texts; ``plain`` takes special strings for ordinary text, as counting does, the default of the library does not."""
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = plain
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def luhn(digits):
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def pieces(rows, capacity=1024, end=2):
    """{(doc_id, piece): (start, length, crc)} by the other tokenizer library."""
    found = {}
    for (doc, _), ids in zip(rows, token_ids([t for _, t in rows], plain=False)):
        ids = [*ids, end]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            data = b"".join(i.to_bytes(4, "little") for i in ids[a:b])
            found[doc, piece] = (a, b - a, zlib.crc32(data))
    return found
