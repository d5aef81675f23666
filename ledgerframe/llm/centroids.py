"""Centroid clustering over an incremental distance matrix of exact integer dot products.

Each vector keeps its dot product with every centroid. When centroids move, only their components that changed are read: the change
of a dot product is the sum of vector component times component change. Squared distances are |v|² - 2 v·c + |c|², whole numbers
throughout, so ties and floors are exact. Sums of clusters are partial aggregates; only the centroids, k rows, pass the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerframe.llm.common import cut, table

#: Components up to this size leave squared distances of 64 components within a long; larger ones are compared as Python numbers.
SMALL = 1 << 27
#: Components beyond this size count as this size.
MOST = 1 << 62


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(vec_id, v, k0...): vectors of exactly dims finite components, each as floor(scale * x)."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.greatest(F.least(F.floor(F.lit(float(scale)) * F.greatest(F.least(c, F.lit(1e18)), F.lit(-1e18))), F.lit(MOST)), F.lit(-MOST)).cast("bigint"))
    good = vectors.where((F.size(x) == dims) & finite)
    return good.select(F.col(id_col).alias("vec_id"), whole.alias("v"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(lists), width)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.int64()))


def nearest(v: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, list]:
    """(cluster, distance) of each row of v, given its dot products with the centroids; of equal distances the smaller number.

    Distances that a long can't hold are None.
    """
    if not len(v):
        return np.empty(0, np.int64), []
    if max(abs(int(v.min())), abs(int(v.max())), abs(int(centroids.min())), abs(int(centroids.max()))) <= SMALL:
        d = (v * v).sum(axis=1)[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)[None, :]
        cluster = d.argmin(axis=1)
        return cluster, d[np.arange(len(v)), cluster].tolist()
    far = [[sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centroids.tolist()] for x in v.tolist()]
    best = [min(range(len(d)), key=d.__getitem__) for d in far]
    return np.array(best, np.int64), [d[k] if d[k] < 1 << 63 else None for d, k in zip(far, best, strict=True)]


def moved(state: DataFrame, before: np.ndarray | None, after: np.ndarray, last: bool = False) -> DataFrame:
    """state(vec_id, v[, dots], k...) with dot products brought from the centroids before to those after, cluster and distance.

    Without `before` dot products start at zero. The last state has neither v nor dots.
    """
    k, dims = after.shape
    change = after - (before if before is not None else 0)
    places = [np.flatnonzero(row) for row in change]
    dropped = ("v", "dots") if last else ()
    fields = [f for f in state.schema.fields if f.name not in ("dots", "cluster", "distance", *dropped)]
    kind = StructType([*fields, *StructType.fromDDL(("" if last else "dots array<bigint>, ") + "cluster int, distance bigint").fields])
    schema = to_arrow_schema(kind)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("v"), dims)
            dots = _matrix(batch.column("dots"), k).copy() if "dots" in batch.schema.names else np.zeros((len(v), k), np.int64)
            with np.errstate(over="ignore"):
                for c, at in enumerate(places):
                    if len(at):
                        dots[:, c] += v[:, at] @ change[c, at]
                cluster, distance = nearest(v, dots, after)
            own = {"dots": _lists(dots), "cluster": pa.array(cluster, pa.int32()), "distance": pa.array(distance, pa.int64())}
            yield pa.RecordBatch.from_arrays([own[f.name] if f.name in own else batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    return cut(state.select(*[c for c in state.columns if c not in ("cluster", "distance")]).mapInArrow(step, kind))


def _next(state: DataFrame, centroids: np.ndarray, wide: bool) -> np.ndarray:
    """The componentwise floor of each cluster's mean; an empty cluster's centroid stays."""
    kind = "decimal(38,0)" if wide else "bigint"
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.col("v")[j].cast(kind)).alias(f"s{j}") for j in range(centroids.shape[1])])
    out = centroids.copy()
    for row in sums.collect():
        out[row["cluster"]] = [int(row[f"s{j}"]) // row["n"] for j in range(centroids.shape[1])]
    return out


def cluster_vectors(
    vectors: DataFrame, clusters: int = 16, dims: int = 64, scale: int = 64, rounds: int = 3, keep: tuple[str, ...] = (), id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, *keep) of every vector of exactly `dims` finite components.

    The first centroids are the vectors of smallest lowercase-hex SHA-256 of `1:<vec_id>` (null ids last, then by components), as many
    as there are if they are fewer than `clusters`. Each round assigns all vectors to the nearest centroid, ties to the smaller
    number, and moves each non-empty cluster's centroid to the floor of its mean; then all are assigned once more. Null, short,
    long and non-finite vectors give no row; repeated rows count each time; no vectors give an empty result. Components beyond 2^62
    count as that; a distance or inertia that a long can't hold is NULL. Columns of vectors other than those named are not read.
    """
    rows = cut(whole_vectors(vectors, dims, scale, id_col, vector_col, keep))
    n, most = rows.agg(F.count("*"), F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()
    wide = bool(n) and n * most >= 1 << 62
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = [r["v"] for r in rows.orderBy(order.asc_nulls_last(), "v").limit(clusters).select("v").collect()]
    centroids, before, state = np.array(first, np.int64).reshape(len(first), dims), None, rows
    if first:
        for _ in range(rounds):
            state = moved(state, before, centroids)
            before, centroids = centroids, _next(state, centroids, wide)
        state = moved(state, before, centroids, last=True)
    else:
        state = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"), *[f"k{i}" for i in range(len(keep))])
    told = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids.tolist())]
    told_sum = F.when(F.count_if(F.col("distance").isNull()) == 0, F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r["cluster"]: r["d"] for r in state.groupBy("cluster").agg(told_sum.alias("d")).collect()}
    fits = lambda x: None if x is None or x >= 1 << 63 else int(x)
    whole = None if None in sums.values() else fits(sum(map(int, sums.values())))
    facts = [(k, fits(sums.get(k)), whole, sha) for k, sha in told]
    named = rows.sparkSession.createDataFrame(facts, "own int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # The broadcast side holds one row a cluster, `clusters` at most.
    joined = state.join(F.broadcast(named), F.col("cluster") == F.col("own"))
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)])


def op12(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of cluster_vectors over all embeddings; odd rows as there."""
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _sql(clusters: int = 16, dims: int = 64, scale: int = 64, rounds: int = 3) -> str:
    """The same in DuckDB: distances of every vector and centroid in each round."""
    far = "list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2])::HUGEINT * (z[1] - z[2])::HUGEINT))::BIGINT"
    parts = [
        f"k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings"
        f" WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM k ORDER BY sha256('1:' || vec_id) NULLS LAST, v LIMIT {clusters})",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, min([{far}, c.c]) AS best FROM k, c{i} c GROUP BY r)")
        if i < rounds:
            mean = "list((s - ((s % n) + n) % n) // n ORDER BY j)"
            parts.append(
                f"c{i + 1} AS MATERIALIZED (SELECT c, {mean}::BIGINT[] AS v FROM (SELECT c, j, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM"
                f" (SELECT best[2] AS c, unnest(v) AS x, unnest(range({dims})) AS j FROM k JOIN a{i} USING (r)) GROUP BY c, j) GROUP BY c"
                f" UNION ALL SELECT c, v FROM c{i} WHERE c NOT IN (SELECT best[2] FROM a{i}))"
            )
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT vec_id, best[2]::INTEGER AS cluster, best[1]::BIGINT AS distance, (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,"
        f" (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM k JOIN a{rounds} USING (r) JOIN c{rounds} c ON c.c = best[2]"
    )


OP12_SQL = _sql()
