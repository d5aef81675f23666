"""Helpers that the corpus operators share: reading tables, cutting lineage, components, word hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerframe.storage import cut, shared_dir

__all__ = ["cut", "shared_dir"]

#: The ASCII letters that the contracts lower-case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: a run of anything but ASCII white space (bytes 09-0D and 20).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts without other letters take the quick built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges(a, b): component is the smallest node that it is linked to.

    Alternates the large-star and small-star steps on the edge table until it stays the same, which takes a number
    of rounds logarithmic in the longest chain. Only counts come to the driver; each round's edges go to the shared folder.
    Null ends and self-links are dropped; no edges give an empty result.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, before = cut(edges), None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select("b", "m").union(small.select("a", "m")).toDF("a", "b").where("a <> b").distinct()
        edges = cut(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b"), F.col("b")).distinct())


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads each bit of the input over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.base, self.inverse, self.up, self.down = int(_ODD), pow(int(_ODD), -1, 1 << 64), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up, self.down


_POWERS = _Powers()


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words (runs without ASCII white space) of data."""
    blank = _BLANK[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(blank) and not blank[0]:
        edge = np.concatenate(([0], edge))
    if len(blank) and not blank[-1]:
        edge = np.concatenate((edge, [len(blank)]))
    return edge[0::2], edge[1::2]


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; equal bytes give equal hashes wherever they stand."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _POWERS.get(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((np.frombuffer(data, np.uint8) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of text, A-Z lower-cased."""
    data = text.encode("utf-8", "surrogatepass").lower()
    return span_hashes(data, *word_spans(data))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the runs of n words; fewer words give one run of all, none gives none."""
    if not len(words):
        return words
    n = min(n, len(words))
    total = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        total = total * _ODD + words[k : len(words) - n + 1 + k]
    return mix(total)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the runs of exactly n words; none if there are fewer."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    up, down = _POWERS.get(len(words) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])))
    return mix((sums[n:] - sums[:-n]) * down[: len(words) - n + 1])


def stretch_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches words[start:end]; equal words give equal hashes wherever they stand."""
    up, down = _POWERS.get(len(words) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])))
    return mix((sums[end] - sums[start]) * down[start])


def dealt(keys: np.ndarray, records: np.ndarray, parts: int) -> list[tuple[int, bytes]]:
    """(part, records as bytes): records dealt by key to parts, so that equal keys meet; one entry for each part that gets any."""
    if not len(keys):
        return []
    part = (keys % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.uint32)
    order = np.argsort(part, kind="stable")
    part, records = part[order], records[order]
    at = np.flatnonzero(np.diff(part, prepend=-1))
    return [(int(part[a]), records[a:b].tobytes()) for a, b in zip(at, [*at[1:], len(part)], strict=True)]


def gathered(blobs, dtype: np.dtype) -> np.ndarray:
    """The records of several blobs as one array."""
    return np.frombuffer(b"".join(bytes(b) for b in blobs), dtype)


def runs_of(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of an array of sorted keys: where its run of equal keys starts and ends."""
    if not len(sorted_keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
    size = np.diff(np.append(at, len(sorted_keys)))
    return np.repeat(at, size), np.repeat(at + size, size)
