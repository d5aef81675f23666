"""Line dedup against brute force, and on odd tables."""

import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerframe.llm import line_dedup as op


def plain_removed(docs):
    """doc -> numbers of lines with an earlier line of Jaccard similarity 0.8 or more; docs: (id, text) in order."""
    seen, out = [], {}
    for i, text in docs:
        out[i] = []
        for k, line in enumerate(text.split("\n")):
            own = set(re.findall(rb"[^\x20\x09-\x0D]+", line.encode().lower()))
            if own:
                if any(5 * len(own & x) >= 4 * len(own | x) for x in seen):
                    out[i].append(k)
                seen.append(own)
    return out


def got(spark, df):
    return {r["doc_id"]: r["removed"] for r in op.dedup_lines(df).collect()}


def variants(seed, lengths=(5, 9, 10, 14, 27), words=60, changes=4, docs=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(words)]
    base = [rng.sample(words, rng.choice(lengths)) for _ in range(6)]
    out = []
    for i in range(docs):
        lines = []
        for _ in range(4):
            own = list(rng.choice(base))
            for _ in range(rng.randrange(changes)):
                own[rng.randrange(len(own))] = rng.choice(words)
            lines.append(" ".join(own))
        out.append((i, "\n".join(lines)))
    return out


def test_matches_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist())
    assert got(spark, spark.createDataFrame(docs, "doc_id long, text string")) == plain_removed(docs)


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_near_the_threshold(spark, seed):
    docs = variants(seed)
    assert got(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3)) == plain_removed(docs)


def test_long_lines_near_the_threshold(spark):
    docs = variants(3, (60, 130, 270, 600), 900, 80, 40)
    found = got(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert found == plain_removed(docs)
    assert 20 < sum(map(len, found.values())) < 150


@pytest.mark.parametrize(("hot", "first"), [(3, 128), (100_000, 1), (3, 1)])
def test_hot_words_and_second_pass(spark, monkeypatch, hot, first):
    """Words split into blocks, and sets that are judged again against all of their candidates, give the same."""
    monkeypatch.setattr(op, "HOT", hot)
    monkeypatch.setattr(op, "FIRST", first)
    passes = []
    again = op.matched_again
    monkeypatch.setattr(op, "matched_again", lambda *a: passes.append(1) or again(*a))
    docs = variants(4, (27, 40), 90, 9, 40)
    assert got(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3)) == plain_removed(docs)
    assert passes or first > 1


def test_candidates_are_those_of_all_pairs(monkeypatch):
    """Every similar pair of sets meets at some word, with and without blocks."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    base = rng.sample(words, 100)
    sets = [set(base) ^ set(rng.sample(words, rng.randrange(30))) for _ in range(60)]
    sets += [set(rng.sample(words, rng.randrange(4, 90))) for _ in range(60)]
    counts = np.bincount(np.arange(op.BUCKETS) % 7, minlength=op.BUCKETS)
    data = "\n".join(" ".join(sorted(x)) for x in sets).encode()
    found = op.line_sets(data, op.rarity(counts))
    place = np.zeros(len(sets), op._PLACE)
    place["doc"] = np.arange(len(sets))
    blobs, below = [], 0
    for w, most in op.WIDTHS:
        lines = np.flatnonzero((found["n"] > below) & (found["n"] <= most))
        below = most
        if len(lines):
            blobs.append((w, op._rows(place, found, lines, w, None)[1].tobytes()))
    every = op.candidates(op.Meeting(blobs), np.unique(found["set"]))
    pairs = set(zip(every["late_doc"], every["early_doc"], strict=True))
    similar = {(j, i) for j in range(len(sets)) for i in range(j) if sets[i] != sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert similar <= pairs and len(similar) > 20
    monkeypatch.setattr(op, "MANY", 2)
    some = op.candidates(op.Meeting(blobs))
    assert {p[0] for p in similar} <= set(some["late_doc"]) and set(zip(some["late_doc"], some["early_doc"], strict=True)) <= pairs
    assert len(pairs) < len(similar) + 600


def test_one_id_with_several_texts(spark):
    rows = [(0, "one two three four five"), (1, "zeta eta theta iota kappa"), (1, "one two three four five"), (1, "zeta eta theta iota kappa")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [(r["doc_id"], r["removed"]) for r in op.dedup_lines(df).collect()]
    assert sorted(out) == [(0, []), (1, []), (1, []), (1, [0])]
    assert sorted(r["text"] for r in op.without_lines(df, op.dedup_lines(df)).collect()) == sorted(["one two three four five", "zeta eta theta iota kappa", "", "zeta eta theta iota kappa"])


def test_odd(spark, odd_docs):
    out = op.dedup_lines(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert by[2]["removed"] == [0] and by[1]["removed"] == [] and by[3]["n_lines"] == 0 and by[4]["removed"] == [] and by[12]["removed"] == [0]
    assert op.dedup_lines(odd_docs.limit(0)).count() == 0
    named = odd_docs.withColumns({"id": odd_docs.doc_id, "hash": odd_docs.doc_id, "gone": odd_docs.doc_id})
    kept = op.without_lines(named, op.dedup_lines(named))
    text = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert text[2] == "" and text[1] and text[3] is None and kept.columns == named.columns
