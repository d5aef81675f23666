"""The corpus pipeline, stage by stage, by brute force on each stage's own input."""

from collections import Counter

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerframe.llm.common import cut, table

from test_operators import plain_fingerprint, plain_hits


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    bench = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    docs = table(spark, sf, "documents")
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf))
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        gone = {i: r for i, r in before.items() if i not in after}
        assert set(after) <= set(before)
        if name != "sharding":
            assert docs.columns == columns and all(r == before[r["doc_id"]] for r in rows)
        if name == "language_id":
            assert not any(any(c.isalpha() for c in r["text"]) for r in gone.values())
        if name == "simhash_neardup":
            fps = {i: plain_fingerprint(r["text"]) for i, r in before.items()}
            assert len(rows) == len(after) and all(any((fps[i] ^ fps[j]).bit_count() <= 2 for j in before if j < i) for i in gone)
            kept = list(after)
            assert not any((fps[i] ^ fps[j]).bit_count() <= 2 for k, i in enumerate(kept) for j in kept[k + 1 :])
        if name == "decontamination":
            for i, r in before.items():
                n, hit, _ = plain_hits(r["text"], bench)
                assert (i in gone) == (hit > 0 and 20 * hit >= n)
        if name == "mixing":
            size = {i: len(r["text"].encode().split()) for i, r in before.items()}
            times = Counter(r["doc_id"] for r in rows)
            assert max(times.values()) <= 2
            want, have = 1.5 * sum(size.values()), sum(n * size[i] for i, n in times.items())
            assert abs(have - want) <= 0.1 * want
        if name == "sharding":
            n = Counter(r["shard"] for r in rows)
            assert max(n.values()) - min(n.values()) <= 1 and len(rows) == sum(times.values())
            assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(k)) for s, k in n.items())
            assert Counter(r["doc_id"] for r in rows) == times
        before = after


def test_odd(spark, odd_docs, tmp_path):
    """What each stage keeps of odd rows; an empty table stays empty, clashing columns stay as they are."""
    spark.createDataFrame([(1, "alpha beta")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, odd_docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs.collect(), cut(stage(spark, docs, str(tmp_path)))
            rows = docs.collect()
            assert bool(rows) == bool(before)
            if name == "language_id":
                assert {r["doc_id"] for r in rows} <= {1, 2, 6, 7, 8, 9, 10, 12, None}
            if name != "sharding":
                assert docs.columns == odd_docs.columns and {tuple(r) for r in rows} <= {tuple(r) for r in before}
        assert set(odd_docs.columns) <= set(docs.columns)


def test_near_duplicates_keep_one_of_each_group(spark):
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(5, words, 1), (3, words, 2), (3, "another text of its own under the same id", 3), (None, words, 4), (None, "a row without an id", 5), (None, "a row without an id", 6), (9, None, 7), (8, "  ", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash int")
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == [(0, "a row without an id"), (3, "another text of its own under the same id"), (3, words), (8, "  ")]


def test_stages_carry_columns_of_any_type(spark):
    """MAP, ARRAY and STRUCT columns, some under names the stages use, nulls and equal rows pass through all stages, and each row stays itself."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").limit(80)
    docs = docs.union(docs.limit(3)).union(docs.limit(1).select(F.lit(None).cast("bigint"), F.lit(None), F.lit(None), F.lit(None), F.lit(None).cast("bigint")))
    docs = docs.withColumns({"rid": F.create_map(F.lit("k"), F.col("doc_id")), "own": F.array("doc_id", "n_chars"), "row": F.struct("doc_id", F.create_map(F.lit(1), F.col("n_chars")).alias("m")), "copies": F.lit(7), "hash": F.lit("h")})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf))
        rows = docs.collect()
        assert rows and all(r["rid"] == {"k": r["doc_id"]} and r["own"][0] == r["doc_id"] and r["row"]["m"] == {1: r["n_chars"]} and r["copies"] == 7 for r in rows)
        if name != "sharding":
            assert docs.columns == columns
        empty = stage(spark, docs.limit(0), sf)
        assert empty.collect() == []
