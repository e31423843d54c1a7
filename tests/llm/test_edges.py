"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import exact_dedup, importance, jaccard_join, language_id, license_scan, packing, pii, templates, tokens, toxicity

PLAIN = "the cat sat on the mat and looked at the moon over the quiet town while rain fell on the roof"
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, PLAIN),
    (5, PLAIN.upper()),
    (5, PLAIN.upper()),
    (None, PLAIN),
    (6, "a" * 200_000),
    (7, "7" * 200_000),
    (8, " ".join(f"w{i}" for i in range(30_000))),
    (9, " ".join(f"w{i}" for i in range(30_000)) + " end"),
    (10, "ÉCOLE école\nAll rights reserved.\nmail: a.b@c.example, 1.2.3.4"),
    (11, "one two"),
    (12, "One Two"),
]
EXTRA = ("row", "digest", "size", "v", "key", "n", "toxic", "item_id", "keys", "length", "bucket", "spans")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", "s", len(t or ""), *[7] * len(EXTRA)) for d, t in ROWS]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} int" for c in EXTRA)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(4, 1, 0), (5, 1, 0), (5, 0, 1), (None, 1, 1), (99, 1, 1), (8, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, None), (2, ""), (3, "too short"), (None, PLAIN), (4, PLAIN), (4, PLAIN)]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def pairs(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def test_language(docs, empty):
    found = language_id.identify(docs)
    assert found.count() == len(ROWS)
    unknown = {r.doc_id for r in found.where("lang_pred = 'und'").collect()}
    assert unknown == {1, 2, 3, 7}
    assert language_id.identify(empty).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_importance(docs, empty, labels):
    found = importance.resample(docs, labels.where("quality = 1"))
    assert found.where("selected").count() == round(len(ROWS) / 2)
    assert found.where("doc_id IN (1, 2, 3) AND log_weight <> 0").count() == 0
    assert importance.resample(empty, labels).count() == 0
    assert importance.resample(docs, labels.where("false")).where("log_weight <> 0").count() == 0


def test_importance_orders_the_bits_of_any_double(spark):
    import numpy as np

    values = [-1e300, -5e7, -4.000000001e6, -1.0, -1e-300, -0.0, 0.0, 1e-300, 1.0, 4e6, 4.000000001e6, 5e7, 1e300]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    found = [r.o for r in frame.select("i", importance._order_bits("v").alias("o")).orderBy("i").collect()]
    unsigned = [int(np.int64(o).view(np.uint64)) for o in found]
    assert unsigned == sorted(unsigned) and len(set(unsigned)) == len(values) - 1  # the two zeros are equal


def test_importance_takes_the_largest_keys_of_very_long_texts(spark):
    target = spark.createDataFrame([(i, "good words only here") for i in range(20)], "doc_id bigint, text string")
    long = [(100 + i, "good words only here " * (150_000 + 7_000 * i)) for i in range(4)]
    docs = target.unionByName(spark.createDataFrame(long + [(200 + i, f"bad other noise {i}") for i in range(40)], "doc_id bigint, text string"))
    found = importance.resample(docs, target.select("doc_id"), share=0.05).collect()
    best = sorted(found, key=lambda r: -r.gumbel_key)[: round(0.05 * 64)]
    assert {r.doc_id for r in found if r.selected} == {r.doc_id for r in best}


def test_importance_draws_one_by_one_from_ties(spark):
    same = spark.range(40).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit("same text").alias("text"))
    assert importance.resample(same, same.where("false"), share=0.25).where("selected").count() == 10


def test_pii(docs, empty):
    found = {r.doc_id: r for r in pii.digest(pii.detect(docs)).collect()}
    assert found[1].spans == found[2].spans == ""
    text = dict(ROWS)[10]
    assert found[10].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_spans(text))
    assert pii.digest(pii.detect(empty)).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.ee x@y@z.org .@a.b a@@b.c",
        "1.2.3.4.5.6.7.8.9 256.1.1.1 01.002.0003.4 1..2.3.4.5",
        "4111 1111 1111 1111 4111-1111-1111-1111-1 4111  1111",
        "+1 (23) 456-7890) +1 +12 ( ) 3 ++49.30.123456 +1234567890123456",
        "é4111111111111111é +49 30 1234567 über@x.de",
    ],
)
def test_base_spans_follow_the_plain_patterns(text):
    assert pii.base_spans(text) == brute.base_spans(text)


def test_added_spans_need_agreement(spark):
    text = "login key password=Zx81kk9a and contact Dr. Maria Lopez, iban GB82WEST12345698765432"
    docs = spark.createDataFrame([(i, text) for i in range(30)], "doc_id bigint, text string")
    kinds = {s.kind for r in pii.detect(docs).collect() for s in r.spans}
    assert {"secret", "iban"} <= kinds


def test_packing(docs, empty):
    found = packing.pack(docs)
    known = [(d, t) for d, t in ROWS if d not in (5, None)]
    expected = brute.pieces(known)
    rows = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found.where("doc_id <> 5").collect()}
    assert rows == expected
    assert found.where("doc_id = 5").count() == 2
    places = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert places.where("n <> m OR n > 1024").count() == 0
    assert packing.pack(empty).count() == 0
    whole = packing.sequences(docs).collect()
    assert all(len(r.ids) <= 1024 for r in whole) and sum(len(r.ids) for r in whole) == found.agg(F.sum("length")).first()[0]


def test_packing_takes_special_strings_for_their_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>"), (3, "x <|endoftext |> y<|endoftext|>\n  z"), (4, PLAIN)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.ids for r in packing.token_pieces(docs, keep_ids=True).collect()}
    assert found == {d: [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END] for d, t in rows}
    counts = {r.doc_id: r.n_tokens for r in tokens.count_documents(docs.where("doc_id = 1")).collect()}
    assert counts == {1: len(brute.token_ids([rows[0][1]])[0])}


def test_licences(docs, empty):
    assert pairs(license_scan.licences(docs), "doc_id", "licences") == [(10, "proprietary")]
    assert license_scan.licences(empty).count() == 0


GPL_HEADER = """    # This program is free software: you can redistribute it and/or modify
    # it under the terms of the GNU General Public License as published by
    # the Free Software Foundation, either version 3 of the License, or
    # (at your option) any later version."""
BSD_HEADER = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:"""


def test_licences_in_wrapped_and_joined_text(spark):
    rows = [
        (1, "int x;\n" + GPL_HEADER + "\nint y;"),
        (2, BSD_HEADER),
        (3, PLAIN + " Released under the MIT License. " + PLAIN + " Licensed under CC BY 4.0. " + PLAIN),
        (4, "Released under the MIT License. All rights reserved."),
        (5, PLAIN + " All rights\nreserved.\n\n" + PLAIN),
        (6, PLAIN + " this program is free to use by the public\n" + PLAIN),
    ]
    found = license_scan.licences(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert pairs(found, "doc_id", "licences") == [(1, "GPL"), (2, "BSD"), (3, "CC-BY,MIT"), (4, "MIT,proprietary"), (5, "proprietary")]


def test_samples_are_bounded_whatever_the_copies(spark):
    from tidemark.llm.sampling import least_hashes

    rows = spark.range(40_000).selectExpr("if(id % 3 = 0, 'hot', CAST(id AS STRING)) AS text").repartition(8)
    found = least_hashes(rows, F.xxhash64("text"), 1000, 40_000, F.expr("text <> '7'")).collect()
    assert 500 < len(found) < 900 and len({r.h for r in found}) == len(found)
    assert len(least_hashes(rows, F.xxhash64("text"), 10**6, 40_000).collect()) == rows.distinct().count()
    assert least_hashes(rows.where("false"), F.xxhash64("text"), 10, 0).count() == 0


def test_licences_of_others_are_unknown(spark):
    rows = [
        (1, "Licensed under the Acme License, Version 2.0"),
        (2, PLAIN + "\nLicensed under the Acme License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.\n" + PLAIN),
        (3, "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
        (4, "This library is licensed under the GNU Lesser General Public License"),
        (5, PLAIN + "\nLicensed under the Apache License, Version 2.0\n" + PLAIN),
        (6, "Released under the Acme License"),
    ]
    found = license_scan.licences(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert pairs(found, "doc_id", "licences") == [(3, "CC-BY-NC"), (4, "LGPL"), (5, "Apache-2.0")]


def test_decontamination(spark, docs, empty, benchmark):
    found = {r.doc_id: r for r in templates.search(docs, benchmark).collect()}
    assert {d for d, r in found.items() if r.contaminated} == {4, 5, None}
    assert found[4]["items"] == [4, None] and found[4].kind == "exact"
    assert templates.search(docs, benchmark.where("false")).where("contaminated").count() == 0
    assert templates.search(empty, benchmark).count() == 0
    assert sorted(r.doc_id for r in templates.remove(docs, benchmark).collect()) == [1, 2, 3, 6, 7, 8, 9, 10, 11, 12]


def test_decontamination_catches_other_numbers_and_names(spark):
    asked = "A train with Alice on board leaves at 9 and runs 120 km to the coast, then Alice walks 120 km back home."
    again = "Well: a train with Bob on board leaves at 7 and runs 95 km to the coast, then Bob walks 95 km back home."
    mixed = "Well: a train with Bob on board leaves at 7 and runs 95 km to the coast, then Eve walks 80 km back home."
    docs = spark.createDataFrame([(1, again), (2, mixed), (3, asked)], "doc_id bigint, text string")
    found = templates.search(docs, spark.createDataFrame([(1, asked)], "item_id bigint, text string"))
    assert pairs(found, "doc_id", "kind") == [(1, "reparameterised"), (2, None), (3, "exact")]


@pytest.mark.parametrize(
    ("item", "text"),
    [
        ("Compute 12 + 34 + 56 + 78 + 90.", "So: compute 12 + 34 + 56 + 78 + 90. Then rest."),
        ("Which city is the largest one in northern Spain?", "Q1 Which city is the largest one in northern Spain?"),
        ("Which city is the largest one in northern Spain?", "Question - Which city is the largest one in northern Spain?"),
        ("Did Anna meet Paul in Rome before Lisa and Greta met Hans in Bonn?", "did anna meet paul in rome before lisa and greta met hans in bonn?"),
        ("Name two primes.", "1) Name two primes. 2) Add them."),
    ],
)
def test_decontamination_finds_copies_that_are_no_templates(spark, item, text):
    docs = spark.createDataFrame([(1, text), (2, "Name three primes, which city is large, compute 12 + 34")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id bigint, text string")
    found = templates.search(docs, items)
    assert pairs(found, "doc_id", "kind", "coverage", "items") == [(1, "exact", 1.0, [7]), (2, None, 0.0, [])]
    assert [r.doc_id for r in templates.remove(docs, items).collect()] == [2]


@pytest.mark.parametrize(
    ("item", "text"),
    [
        (
            "How many fruits are in the old basket when it holds 3 apples and 5 pears at noon?",
            "How many fruits are in the old basket when it holds 4 apples and 4 pears at noon?",
        ),
        (
            "A class has 6 red chairs in the first room and 6 blue tables in the other room, how many are there in all?",
            "A class has 7 red chairs in the first room and 9 blue tables in the other room, how many are there in all?",
        ),
        (
            "Tell how long the fast train to Paris takes if it leaves the station with Bob at 9 and stops twice.",
            "Tell how long the fast train to San Francisco takes if it leaves the station with Mary Ann at 7 and stops twice.",
        ),
        (
            "Say how many more green marbles the boy now has than 12 of the other children in the big yard.",
            "Say how many more green marbles the boy now has than about 15 of the other children in the big yard.",
        ),
    ],
)
def test_decontamination_finds_questions_asked_again(spark, item, text):
    other = "How many of the first trains to Rome hold 5 chairs, and how many children are in the big yard at 9 with Bob?"
    docs = spark.createDataFrame([(1, "Hello there. " + text), (2, other)], "doc_id bigint, text string")
    found = templates.search(docs, spark.createDataFrame([(7, item)], "item_id bigint, text string"))
    assert pairs(found, "doc_id", "kind") == [(1, "reparameterised"), (2, None)]


def test_exact_dedup(docs, empty):
    found = exact_dedup.decide(docs).collect()
    assert len(found) == len(ROWS)
    copies = [r for r in found if r.keep_id == 5]
    assert len(copies) == 4 and {r.group_size for r in copies} == {4} and sum(r.kept for r in copies) == 1
    assert sorted((r.doc_id, r.keep_id) for r in found if r.doc_id in (1, 2, 11, 12)) == [(1, 2), (2, 2), (11, 12), (12, 12)]
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8, 9, 10, 12]
    assert exact_dedup.decide(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0


@pytest.mark.parametrize("bits", [1, 64, 1 << 26])
def test_deduplicate_keeps_one_of_every_text(spark, monkeypatch, bits):
    import random

    monkeypatch.setattr(exact_dedup, "BITS", bits)  # with one bit every row is suspect
    draw = random.Random(bits)
    rows = [(draw.choice([None, *range(200)]), draw.choice(["Hot", "hot", f"t{draw.randrange(60)}", f"own {i}", None, ""])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    best = {}
    for doc, text in rows:
        key = brute.fold(text)
        best[key] = doc if key not in best else max((d for d in (best[key], doc) if d is not None), default=None)
    found = exact_dedup.deduplicate(docs, heavy=1, tracked=16).collect()
    assert sorted(((r.doc_id, brute.fold(r.text)) for r in found), key=repr) == sorted(((d, k) for k, d in best.items()), key=repr)


def test_jaccard(docs, empty):
    found = jaccard_join.groups(docs, 3, 90)
    expected = brute.jaccard_groups(ROWS, 3, 90)
    assert pairs(found, "doc_id", "n_shingles", "component_id") == sorted(((ROWS[i][0], *v) for i, v in expected.items()), key=repr)
    assert jaccard_join.groups(empty, 3, 90).count() == 0
    assert jaccard_join.keep_one(docs).columns == docs.columns
    # one document of each group: of 4, 5 and the null id the smallest id stays, texts without words all do
    assert sorted((r.doc_id for r in jaccard_join.keep_one(docs).collect())) == [1, 2, 3, 4, 6, 7, 8, 10, 11]
    assert jaccard_join.keep_one(empty).count() == 0


def test_jaccard_keeps_one_of_null_and_shared_ids(spark):
    long = [f"w{i}" for i in range(200)]
    near = [" ".join([*long[:150], f"x{i}", *long[151:]]) for i in range(4)]
    rows = [(None, near[0]), (None, near[1]), (None, near[1]), (7, "a clean text of its own"), (7, near[2]), (9, near[3]), (9, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = [tuple(r) for r in jaccard_join.keep_one(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(7, "a clean text of its own"), (7, near[2]), (9, None), (None, "")], key=repr)
    nameless = docs.where("doc_id IS NULL AND text <> ''")
    assert len({r.text for r in jaccard_join.keep_one(nameless).collect()}) == 1
    assert {r.component_id for r in jaccard_join.groups(nameless, 5, 80).collect()} == {None}


@pytest.mark.parametrize("shape", ["ordered", "mixed", "tree"])
def test_stars_take_few_rounds_on_long_chains(spark, shape):
    import random

    names = list(range(2001))
    if shape != "ordered":
        random.Random(4).shuffle(names)
    edges = [(names[i], names[i // 2 if shape == "tree" else i - 1]) for i in range(1, 2001)] + [(5000, 5001), (5001, 5000)]
    rounds = []
    found = {r.v: r.root for r in jaccard_join.stars(spark.createDataFrame(edges, "a bigint, b bigint"), rounds).collect()}
    assert found == {v: 0 for v in range(1, 2001)} | {5001: 5000}
    assert len(rounds) <= 16 and max(rounds) <= 2001 + 2001
    assert jaccard_join.stars(spark.createDataFrame([], "a bigint, b bigint")) is None


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_jaccard_near_copies(spark, n, percent, monkeypatch):
    """Hot groups of near copies, chains of small changes and shared passages, with blocks small enough to split."""
    import random

    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 40)
    rng = random.Random(n)
    passage = [f"p{i}" for i in range(40)]
    rows, base = [], [f"b{rng.randrange(500)}" for _ in range(120)]
    for i in range(200):
        words = list(base)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    for i in range(200, 320):
        own = [f"y{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        rows.append((i, " ".join(own + passage[: rng.randrange(40)])))
    chain = [f"c{i}" for i in range(60)]
    for i in range(320, 350):
        chain[rng.randrange(60)] = f"z{i}"
        rows.append((i, " ".join(chain)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    expected = brute.jaccard_groups(rows, n, percent)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.groups(docs, n, percent).collect()}
    assert found == expected


def test_toxicity(docs, empty, labels):
    found = toxicity.classify(docs, labels)
    assert found.count() == len(ROWS)
    assert found.where("doc_id IN (1, 2, 3) AND toxic > 0").count() == 0
    assert toxicity.classify(empty, labels).count() == 0
    assert toxicity.keep_clean(docs, labels.where("false")).count() == len(ROWS)


def test_toxicity_fit_is_small():
    rng = np.random.default_rng(3)
    targets = np.column_stack([np.arange(400) % 4 == 1, np.arange(400) % 4 == 3, np.arange(400) % 2 == 1])
    rows = [np.concatenate([rng.integers(100, toxicity.BUCKETS, 200), [7 * t[2], 9 * t[0]]]).astype(np.int32) for t in targets]
    order = toxicity._in_order(targets[:, 2], targets[:, 0], rows)
    assert order == sorted(range(400), key=lambda i: (targets[i, 2], targets[i, 0], rows[i].tobytes()))
    tracemalloc.start()
    chain = toxicity.fit_chain(rows, targets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {7} <= set(chain[2].features.tolist()) and peak < 4 * 4 * toxicity.BUCKETS


def test_jaccard_steps_without_rows_end(spark, monkeypatch):
    def text(i, words=40):
        return " ".join(f"w{i}x{j}" for j in range(words))

    rows = [(i, text(i)) for i in range(20)] + [(20, text(3) + " end"), (21, text(4))]
    docs, plans, store = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df: plans.append(df) or store(df))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.groups(docs, 3, 90).collect()}
    assert found == brute.jaccard_groups(rows, 3, 90)
    assert len(plans) <= 14


def test_jaccard_signatures_are_shared_by_all_that_link():
    rng = np.random.default_rng(8)

    def linked(one, other, percent):
        return jaccard_join._linked(np.sort(one), np.sort(other), percent)

    for percent in (60, 80, 90, 97):
        met = 0
        for _ in range(400):
            size = int(rng.integers(1, 400))
            one = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
            kept = one[rng.random(len(one)) < 1 - rng.random() * (100 - percent) / 100]
            other = np.unique(np.concatenate([kept, rng.integers(0, 1 << 64, int(rng.integers(0, 1 + len(one) // 10)), dtype=np.uint64)]))
            if min(len(one), len(other)) >= jaccard_join.least_size(percent) and linked(one, other, percent):
                met += 1
                assert np.intersect1d(jaccard_join.signatures(one, percent), jaccard_join.signatures(other, percent)).size
        assert met > 40
    hundred = np.unique(rng.integers(0, 1 << 64, 100, dtype=np.uint64))
    half = np.unique(np.concatenate([hundred[::2], rng.integers(0, 1 << 64, 50, dtype=np.uint64)]))
    assert not np.intersect1d(jaccard_join.signatures(hundred, 97), jaccard_join.signatures(hundred[:5], 97)).size
    assert jaccard_join.signatures(half, 100).size == 0


def test_jaccard_compares_no_texts_that_share_single_ngrams(spark, monkeypatch):
    """Texts of few words share many n-grams by chance; only near copies come to the tries."""
    import random

    rng = random.Random(6)
    texts = [[f"w{rng.randrange(12)}" for _ in range(150)] for _ in range(60)]
    near = [*texts[7][:-1], "end"]
    rows = [(i, " ".join(words)) for i, words in enumerate([*texts, near, texts[9]])]
    docs, kept, store = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df: kept.append(store(df)) or kept[-1])
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.groups(docs, 3, 90).collect()}
    assert found == brute.jaccard_groups(rows, 3, 90)
    assert [df.count() for df in kept if "keys" in df.columns] == [2]


def test_token_counts(docs, empty):
    found = pairs(tokens.count_documents(docs), "doc_id", "n_tokens")
    expected = sorted(((d, len(ids)) for (d, _), ids in zip(ROWS, brute.token_ids([t for _, t in ROWS]))), key=repr)
    assert found == expected
    assert tokens.count_documents(empty).count() == 0


def test_scan_stitches_blocks_and_spans(spark, tmp_path, monkeypatch):
    import numpy as np

    monkeypatch.setattr(tokens, "SPAN_BLOCKS", 3)
    rng = np.random.default_rng(1)
    expected = {}
    for name in ("a", "b", "c"):
        ids = rng.integers(1, 100, 5000).astype("<u2")
        ids[rng.integers(0, 5000, 40)] = tokens.END
        ids[1000:3000] = 5
        (tmp_path / f"{name}.bin").write_bytes(ids.tobytes())
        ends = np.flatnonzero(ids == tokens.END)
        expected[name] = (np.diff(np.concatenate(([-1], ends))) - 1).tolist()
    (tmp_path / "empty.bin").write_bytes(b"")
    found = tokens.scan_counts(tokens.read_token_files(spark, str(tmp_path), 64))
    rows = sorted((r.file[-5], r.ordinal, r.n_tokens) for r in found.collect())
    assert rows == [(name, i, n) for name, counts in sorted(expected.items()) for i, n in enumerate(counts)]


def test_pipeline_stages_on_awkward_rows(spark, docs, empty):
    sf = "/root/testdata/sf0.001"
    left = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if number < 4:
            assert out.columns == docs.columns, name
        left[name] = sorted(((r.doc_id) for r in out.collect()), key=repr)
        assert stage(spark, empty, sf).count() == 0, name
    every = sorted((d for d, _ in ROWS), key=repr)
    # none of these texts is toxic or holds a benchmark item
    assert left["toxicity"] == left["decontamination"] == every
    assert left["exact_dedup"] == sorted([2, 3, 5, 6, 7, 8, 9, 10, 12], key=repr)
    assert left["jaccard_join"] == sorted([1, 2, 3, 4, 6, 7, 8, 10, 11], key=repr)
    assert set(left["packing"]) == set(every)


def test_pipeline(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        rows, after = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], kept.count()
        ids = sorted(r.doc_id for r in kept.select("doc_id").collect())
        if name == "exact_dedup":
            best = {}
            for d, t in rows:
                best[brute.fold(t)] = max(d, best.get(brute.fold(t), d))
            assert ids == sorted(best.values())
        elif name == "jaccard_join":
            groups = brute.jaccard_groups(rows, 5, 80)
            assert ids == sorted(rows[i][0] for i, (_, c) in groups.items() if c == rows[i][0])
        elif name == "packing":
            assert {(r.doc_id, r.piece) for r in kept.collect()} == set(brute.pieces(rows))
        else:
            assert 0 < after <= len(rows)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert kept.columns == docs.columns
        docs = kept
    assert before > 0
    assert corpus_pipeline.run(spark, sf).count() == docs.count()
