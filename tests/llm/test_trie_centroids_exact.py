"""Prefix trie, centroid clustering and exact dedup against brute force, over several ranges and levels, and on odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerframe.llm import centroids, exact_dedup, prefix_trie, registry

BLANK = re.compile(r"[\x20\x09-\x0D]")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_centroids", "op13_exact_dedup"])
def test_oracles(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    df = registry.queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, cur.fetchall()))


# Exact dedup


def plain_groups(docs):
    groups = defaultdict(list)
    for i, text in docs:
        groups[BLANK.sub("", text or "")].append((-len(text or ""), i is None, i or 0))
    out = []
    for content, own in groups.items():
        first = min(own)
        keep = None if first[1] else first[2]
        out += [(None if none else i, keep, len(own), hashlib.sha256(content.encode()).hexdigest()) for _, none, i in own]
    return sorted(map(str, out)), len(groups)


def check_dedup(df, docs):
    want, groups = plain_groups(docs)
    got = rows_of(df)
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in kept}) == groups and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_dedup_odd_docs(spark, odd_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check_dedup(exact_dedup.exact_dedup(odd_docs), docs)
    check_dedup(exact_dedup.exact_dedup(odd_docs.limit(0)), [])
    nested = odd_docs.withColumns({"rep": F.create_map(F.lit("a"), F.col("fp")), "members": F.array("fp", "h"), "content": F.struct("fp", "h")})
    whole = exact_dedup.without_copies(nested)
    assert whole.columns == nested.columns and whole.count() == plain_groups(docs)[1]
    assert all(r["rep"] == {"a": r["fp"]} and r["members"] == [r["fp"], r["h"]] for r in whole.collect())


def test_dedup_levels_and_hot_contents(spark, monkeypatch):
    """Tables of a few hundred bytes, so that buckets overflow again and again; one content has a third of all rows, in each partition."""
    rng = random.Random(3)
    docs = [(i, rng.choice([" same\ttext ", "same  text", "sametext"]) if i % 3 == 0 else f"text  number {rng.randrange(900)} " * rng.randrange(1, 4)) for i in range(3000)]
    docs += [(9000, "long " * 5000), (8999, "long" * 5000), (None, "sametext"), (9001, None), (9002, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(24)
    levels = []
    fold = exact_dedup._fold
    monkeypatch.setattr(exact_dedup, "_fold", lambda *a, **k: levels.append(k.get("pass_on", False)) or fold(*a, **k))
    monkeypatch.setattr(exact_dedup, "_parts", lambda rows, most: 4)
    check_dedup(exact_dedup.exact_dedup(df, table_bytes=2000, fan=2), docs)
    assert levels.count(True) >= 2 and levels.count(False) >= 3


def test_local_tables_start_anew(spark, monkeypatch):
    docs = [(i, f"t{i % 40}" + "x" * (i % 40)) for i in range(1000)]
    schema = exact_dedup.to_arrow_schema(spark.createDataFrame([], "rep long, h long, sha binary, content binary, size long, copies long, best_n long, best_id long, best_rep long, best_at int, members array<struct<n:bigint,doc_id:bigint>>").schema)
    monkeypatch.setattr(exact_dedup, "LOCAL_BYTES", 300)
    monkeypatch.setattr(exact_dedup, "LOCAL_ROWS", 70)
    monkeypatch.setattr(exact_dedup.TaskContext, "get", staticmethod(lambda: type("C", (), {"partitionId": staticmethod(lambda: 1)})))
    batches = pa.Table.from_pylist([{"doc_id": i, "text": t} for i, t in docs]).to_batches(max_chunksize=130)
    out = pa.Table.from_batches(exact_dedup.local_rows(iter(batches), schema)).to_pylist()
    assert sorted((m["doc_id"], r["content"].decode(), m["n"]) for r in out for m in r["members"]) == sorted((i, t, len(t)) for i, t in docs)
    assert len({r["rep"] for r in out}) == len(out) and all(r["copies"] == len(r["members"]) and r["members"][r["best_at"]]["doc_id"] == r["best_id"] for r in out)


def test_table_tells_contents_of_one_hash_apart():
    held = exact_dedup.Table(1 << 20)
    for k in range(3000):
        entry, slot = held.find(7, b"%d" % k)
        assert entry < 0
        held.add(7, b"%d" % k, slot)
        if k > 200:
            break
    assert [held.find(7, b"%d" % k)[0] for k in range(200)] == list(range(200)) and held.find(7, b"x")[0] < 0


# Centroid clustering


def plain_clusters(rows, clusters=16, rounds=3, scale=64):
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:clusters]]
    for turn in range(rounds + 1):
        best = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            best.append((min(d), d.index(min(d))))
        if turn < rounds:
            for k in range(len(cents)):
                own = [v for (_, v), (_, c) in zip(kept, best) if c == k]
                if own:
                    cents[k] = [sum(col) // len(own) for col in zip(*own)]
    total = sum(d for d, _ in best) if kept else 0
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(str((i, c, fits(d), fits(sum(x for x, k in best if k == c)), fits(total), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())) for (i, _), (d, c) in zip(kept, best))


def clustered(df):
    return sorted(str((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])) for r in df.collect())


@pytest.mark.parametrize("spread", [1.0, 2e6, 3e8, 1e12])
def test_clusters_match_plain_arithmetic(spark, spread):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=64) * spread + rng.integers(0, 4)).astype(np.float64).tolist()) for i in range(60)]
    assert clustered(centroids.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))) == plain_clusters(rows)


def test_clusters_of_odd_vectors(spark):
    """Nulls, wrong lengths, non-finite and repeated vectors, ties, fewer vectors than clusters, clashing columns."""
    rng = np.random.default_rng(6)
    one = rng.normal(size=64).tolist()
    rows = [(1, one), (2, one), (2, one), (None, one), (3, None), (4, one[:63]), (5, [*one, 0.0]), (6, [float("nan")] * 64), (7, [None, *one[1:]]), (8, [float("inf"), *one[1:]]), (9, [0.0] * 64), (10, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"cluster": F.lit(5), "dots": F.array(F.lit(1)), "v": F.create_map(F.lit(1), F.lit(2)), "own": F.lit("x")})
    assert clustered(centroids.cluster_vectors(df)) == plain_clusters(rows)
    hot = rows + [(100 + i, one) for i in range(200)] + [(400 + i, rng.normal(size=64).tolist()) for i in range(100)]
    assert clustered(centroids.cluster_vectors(spark.createDataFrame(hot, "vec_id long, embedding array<double>"))) == plain_clusters(hot)
    kept = centroids.cluster_vectors(df, keep=("cluster", "dots", "v")).toPandas()
    assert len(kept) == 5
    assert centroids.cluster_vectors(df.limit(0)).collect() == [] and centroids.cluster_vectors(df.where("vec_id = 3")).collect() == []


# Prefix trie


def plain_trie(turns):
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            by[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in by.items()}
    seqs = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + mine[h:])
    nodes = defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for seq in nodes:
        if seq:
            kids[seq[:-1]] += 1
    for seq, own in nodes.items():
        cost = (len(own) - 1) * len(WORDS.findall(seq[-1][1])) if seq else 0
        for d in range(len(seq) + 1):
            saved[seq[:d]] += cost
            leaves[seq[:d]] += not kids[seq]
    ends = {seq: hashlib.sha256(",".join(map(str, sorted(c for c in own if len(seqs[c]) == len(seq)))).encode()).hexdigest() for seq, own in nodes.items()}
    return sorted(str((min(own), len(seq), min(nodes[seq[:-1]]) if seq else None, len(own), kids[seq], leaves[seq], saved[seq], ends[seq])) for seq, own in nodes.items())


def trie(df, **kw):
    out = prefix_trie.prefix_trie(df, **kw)
    return sorted(str((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])) for r in out.collect())


TURN = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("turns", "fan"), [(100_000, 16), (60, 3), (12, 2)])
def test_trie_over_many_ranges(spark, turns, fan, monkeypatch):
    """One range, dozens and hundreds of them; a third of the conversations are the same, many share their first turn."""
    rng = random.Random(turns)
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    rows = []
    for c in range(400):
        n = rng.randrange(0, 7)
        kind = rng.randrange(3)
        for t in range(4 if kind == 0 else n):
            text = f"common turn {t}" if kind == 0 or (kind == 1 and t == 0) else f"w{rng.randrange(300)} " * rng.randrange(1, 5)
            rows.append((c * rng.choice([1, 1, 1, 7]), t, rng.choice(["user", "assistant"]) if kind == 2 else "user", text))
    df = spark.createDataFrame(rows, TURN).repartition(5)
    assert trie(df, turns=turns, fan=fan) == plain_trie(rows)


def test_trie_of_odd_conversations(spark):
    long = "w " * 20_000
    rows = [
        (0, 0, "user", "a b"), (0, 1, None, None), (0, None, "user", "first"), (1, 0, "user", "a b"), (1, 0, "user", "a b"), (2, 5, "", ""), (3, 0, "user", None), (None, 0, "user", "x"), (-5, 0, "user", "neg"),
        (20, 0, "user", long), (21, 0, "user", long), (22, 7, "user", "x"), (22, 7, "assistant", "x"), (22, 7, "user", "a"), (47, 1, "user", "only"), (60, None, None, None), (61, 0, "us", "er"), (62, 0, "use", "r"), (2**40, 3, "é", "日本 語"),
    ]
    rows += [(500, t, "user", f"t{t}") for t in range(300)]
    df = spark.createDataFrame(rows, TURN).withColumns({"depth": F.lit(1), "key": F.create_map(F.lit(1), F.lit(2)), "words": F.array(F.lit(1)), "ref": F.struct(F.lit(1).alias("x"))})
    assert trie(df) == plain_trie(rows) == trie(df, turns=40, fan=2)
    assert trie(df.limit(0)) == [] and trie(df.where("conv_id IS NULL")) == []


def test_layouts_grow():
    """A node passes through layouts of 4, 16, 48 and 256 places and keeps all of them, in order."""
    root = prefix_trie.Node(b"", 0, [], None)
    keys = [bytes([b]) * prefix_trie.WIDTH for b in random.Random(1).sample(range(256), 256)]
    kinds = []
    for n, key in enumerate(keys):
        prefix_trie.insert(root, key, [n], prefix_trie.Own(1, n))
        kinds.append((type(root.layout).__name__, getattr(root.layout, "most", None)))
    assert [kinds[i] for i in (3, 4, 15, 16, 47, 48)] == [("Few", 4), ("Few", 16), ("Few", 16), ("Indexed", None), ("Indexed", None), ("Full", None)]
    assert [x.key for x in root.layout.all()] == sorted(keys)
