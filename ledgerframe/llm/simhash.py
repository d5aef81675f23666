"""SimHash near-duplicates by vantage-point trees.

Fingerprints come from word shingles in Arrow batches; distinct fingerprints are then partitioned by Hamming distance to
vantage points. A tree over a sample that grows with the fingerprints deals them to shards; a fingerprint also visits, as a guest,
every shard that its reach crosses into. Each shard searches itself by a tree of its own, pruned by the same triangle bounds, and
reports a spanning forest of its exact links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerframe.llm.common import connected_components, cut, mix, table

#: Fixed value: the seed of the contract's XXH64.
SEED = 42
#: Of how many distinct fingerprints one is in the sample that vantage points are chosen from, and the least and largest sample
#: (8 bytes each, on the driver). Every fingerprint is indexed; beyond the largest sample shards grow instead of their number.
SHARE, SAMPLE, SAMPLE_MOST = 64, 8192, 1 << 22
#: Distinct fingerprints that a shard should hold of its own, and that a search within a shard compares at once.
LEAF, INNER = 4000, 256
#: Fingerprints that one task deals at once.
DEAL = 1 << 20


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a whole text: a bit is 1 if set in over half the shingle hashes, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    runs = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    n = len(words) - k + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, *keep): one row per document, fp the fingerprint as a signed long. Null and blank texts have 0."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = partial(fingerprint, shingle=shingle)
        for batch in texts:
            yield pd.Series(np.fromiter(map(one, batch), np.uint64, len(batch)).view(np.int64))

    return docs.select(F.col(id_col).alias("doc_id"), fp(F.col(text_col).cast("string")).alias("fp"), *keep)


@dataclass
class Node:
    """A split at Hamming distance `radius` from `point`, or a shard where `point` is None."""

    shard: int = -1
    point: np.uint64 | None = None
    radius: int = 0
    near: Node | None = None
    far: Node | None = None


def build_tree(sample: np.ndarray, leaves: int, reach: int) -> tuple[Node, int]:
    """(tree, shards): a vantage-point tree with about `leaves` shards; of several points and radii, it takes the split with the fewest boundary rows."""
    count = 0

    def grow(own: np.ndarray, want: int) -> Node:
        nonlocal count
        best = None
        if want > 1 and len(own) >= 8:
            few = own[:: max(1, len(own) // 2048)]
            for point in few[:: max(1, len(few) // 16)][:16]:
                total = np.cumsum(np.bincount(np.bitwise_count(few ^ point), minlength=66))
                inside = total[:65] / len(few)
                border = total[np.minimum(65, np.arange(65) + reach)] - total[np.maximum(0, np.arange(65) - reach)]
                for radius in np.flatnonzero((inside >= 0.25) & (inside <= 0.75)).tolist():
                    rank = (border[radius], abs(inside[radius] - 0.5))
                    if best is None or rank < best[0]:
                        best = rank, point, radius
        if best is not None:
            _, point, radius = best
            near = np.bitwise_count(own ^ point) <= radius
            if near.any() and not near.all():
                part = min(max(1, round(want * near.mean())), want - 1)
                return Node(point=point, radius=radius, near=grow(own[near], part), far=grow(own[~near], want - part))
        count += 1
        return Node(shard=count - 1)

    tree = grow(sample, leaves)
    return tree, count


def route(tree: Node, fps: np.ndarray, reach: int, guests: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, own): each fingerprint's own shard, and every shard beyond a boundary that its reach crosses, where it is a guest.

    Of two linked fingerprints on either side of a split, the near one visits the far side, so each link meets in a shard of which one
    of the two is an own row. Rows that guests marks are guests everywhere.
    """
    rows, shards, owns = [], [], []

    def down(node: Node, own: np.ndarray, guest: np.ndarray) -> None:
        if not len(own) and not len(guest):
            return
        if node.point is None:
            both = np.concatenate((own, guest))
            rows.append(both)
            shards.append(np.full(len(both), node.shard))
            owns.append(np.arange(len(both)) < len(own))
            return
        d, g = np.bitwise_count(fps[own] ^ node.point).astype(np.int64), np.bitwise_count(fps[guest] ^ node.point).astype(np.int64)
        down(node.near, own[d <= node.radius], guest[g - reach <= node.radius])
        down(node.far, own[d > node.radius], np.concatenate((own[(d <= node.radius) & (d + reach > node.radius)], guest[g + reach > node.radius])))

    index = np.arange(len(fps))
    down(tree, *((index, index[:0]) if guests is None else (index[~guests], index[guests])))
    return tuple(np.concatenate(x) for x in (rows, shards, owns)) if rows else (index, index, index.astype(bool))


def forest(fps: np.ndarray, own: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within reach of which one end at least is an own row; fps are distinct.

    Each own row is compared with the rows not reached yet, each guest that was reached with the own ones among them.
    """
    rest, strangers, edges = fps[own], fps[~own], []
    while len(rest):
        queue, rest = [(rest[0], True)], rest[1:]
        while queue and (len(rest) or len(strangers)):
            point, mine = queue.pop()
            hit = np.bitwise_count(rest ^ point) <= reach
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                edges += [(point, x) for x in found]
                queue += [(x, True) for x in found]
            if mine and len(strangers):
                hit = np.bitwise_count(strangers ^ point) <= reach
                if hit.any():
                    found, strangers = strangers[hit], strangers[~hit]
                    edges += [(point, x) for x in found]
                    queue += [(x, False) for x in found]
    return edges


def shard_links(fps: np.ndarray, own: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """Links that connect what forest() does, by a tree over the own rows: of each of its parts only own rows and those that reach into it are compared.

    A link joins the own part of one of its ends, so it meets there; links of equal ends in several parts are told once or more.
    """
    if own.sum() <= 2 * INNER:
        return forest(fps, own, reach)
    mine = fps[own]
    tree, parts = build_tree(mine, -(-len(mine) // INNER), reach)
    rows, shards, owns = route(tree, fps, reach, guests=~own)
    if parts == 1:
        return forest(fps, own, reach)
    order = np.argsort(shards, kind="stable")
    edges = []
    for part in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1):
        if owns[part].any():
            edges += forest(fps[rows[part]], owns[part], reach)
    return edges


def links(fps: DataFrame, reach: int = 2, least: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """(a, b): links that connect all fingerprints of fps(fp, distinct) which differ in at most `reach` bits.

    Every pair within reach is joined by a path of links; a dense group gives a spanning forest, not all its pairs. A
    ball of few bits holds a bounded number of distinct fingerprints (679,121 within 4 bits of its middle), so no shard grows with copies.
    """
    n = fps.count()
    size = min(max(least, n // SHARE), SAMPLE_MOST)
    part = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, size / max(1, n)))
    chosen = np.sort(np.array([r[0] for r in fps.where(part).select("fp").toLocalIterator()], np.int64)).view(np.uint64)
    chosen = chosen[np.argsort(mix(chosen))]
    tree, _ = build_tree(chosen, max(1, -(-n // leaf)), reach)
    held = fps.sparkSession.sparkContext.broadcast(tree)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush(parts: list[np.ndarray]) -> pd.DataFrame:
            own = np.concatenate(parts)
            rows, shards, mine = route(held.value, own, reach)
            return pd.DataFrame({"shard": shards, "fp": own[rows].view(np.int64), "own": mine})

        parts: list[np.ndarray] = []
        for batch in batches:
            parts.append(batch["fp"].to_numpy(np.int64).view(np.uint64))
            if sum(map(len, parts)) >= DEAL:
                yield flush(parts)
                parts = []
        if parts:
            yield flush(parts)

    def match(group: pd.DataFrame) -> pd.DataFrame:
        edges = shard_links(group["fp"].to_numpy(np.int64).view(np.uint64), group["own"].to_numpy(bool), reach)
        edges = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1]})

    return fps.select("fp").mapInPandas(deal, "shard long, fp long, own boolean").groupBy("shard").applyInPandas(match, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, reach: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id, class_fp, *keep): near-duplicate classes of whole texts, one row per row of docs.

    component_id is the smallest doc_id reachable over links of at most `reach` differing bits, the document's own included;
    class_fp, the smallest fingerprint of the class as a signed long, names it where no document of it has an id.
    Null, blank and very long texts are ordinary (no words: fingerprint 0); repeated rows share a fingerprint; a null
    doc_id gets a row and takes no part in the smallest id; an empty table gives an empty result; other columns are not read.
    """
    own = cut(fingerprints(docs, id_col, text_col, shingle, keep))
    distinct = cut(own.groupBy("fp").agg(F.min("doc_id").alias("first")))
    parts = connected_components(links(distinct, reach))
    named = distinct.join(parts, distinct.fp == parts.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("part"))
    least = named.groupBy("part").agg(F.min("first").alias("component_id"))
    named = named.join(least, "part").select("fp", "component_id", F.col("part").alias("class_fp"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return own.join(named, "fp").select("doc_id", "fp", hexed, "component_id", "class_fp", *keep)


def op5(spark, sf_dir: str) -> DataFrame:
    """simhash_groups over all documents; odd rows as there."""
    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
