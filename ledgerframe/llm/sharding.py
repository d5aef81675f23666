"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix, in DataFrame and SQL functions only.

1. Rows fall into blocks by a hash of their content; block and shard sizes are then fixed.
2. The matrix of block-to-shard counts is drawn exactly: a binary tree over the blocks splits the shard sizes, one
   hypergeometric draw (by inversion) for each shard at each split.
3. Each block is permuted by hash order and cut into its row of the matrix.
4. The exchange carries rows to their shards, where a second hash order gives the slots.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ledgerframe.llm.common import cut, table

#: Rows that a block, and a run of slots within a shard, should hold.
BLOCK_ROWS = 16384


def _stirling_error(n: str) -> str:
    """ln n! less Stirling's ln(sqrt(2 pi n) (n / e)^n), as SQL: from a table below 16, else by its series."""
    small = ", ".join(repr(math.lgamma(k + 1) - (k + 0.5) * math.log(k) + k - 0.5 * math.log(2 * math.pi)) + "D" if k else "0D" for k in range(16))
    series = f"(1 / 12D - (1 / 360D - (1 / 1260D - 1 / (1680D * {n} * {n})) / (1D * {n} * {n})) / (1D * {n} * {n})) / {n}"
    return f"CASE WHEN {n} < 16 THEN element_at(array({small}), CAST({n} AS INT) + 1) ELSE {series} END"


def _deviance(x: str, mean: str) -> str:
    """x ln(x / mean) + mean - x, as SQL, without cancellation where x is near the mean."""
    v = f"(({x} - {mean}) / ({x} + {mean}))"
    terms = f"1 / {2 * 9 + 1}D"
    for j in range(8, 0, -1):
        terms = f"(1 / {2 * j + 1}D + {v} * {v} * {terms})"
    near = f"({x} - {mean}) * {v} + 2D * {x} * {v} * {v} * {v} * {terms}"
    return f"CASE WHEN abs({x} - {mean}) < 0.1D * ({x} + {mean}) THEN {near} ELSE {x} * ln({x} / {mean}) + {mean} - {x} END"


def _log_binomial(x: str, n: str, p: str, q: str) -> str:
    """The log of the binomial probability of x in n, as SQL, in saddle-point form: the errors of Stirling's formula and two deviances.

    No large terms cancel, so it is right to about 1e-14 for any n.
    """
    bound = f"array(named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({n} - {x} AS DOUBLE), 'n', CAST({n} AS DOUBLE), 'a', {n} * {p}, 'b', {n} * {q}))"
    lead = f"{_stirling_error('d.n')} - ({_stirling_error('d.x')}) - ({_stirling_error('d.y')}) - ({_deviance('d.x', 'd.a')}) - ({_deviance('d.y', 'd.b')})"
    return f"element_at(transform({bound}, d -> CASE WHEN d.n = 0 THEN 0D WHEN d.x = 0 THEN d.n * ln({q}) WHEN d.y = 0 THEN d.n * ln({p}) ELSE {lead} - 0.5D * ln(6.283185307179586D * d.x * (d.y / d.n)) END), 1)"


def hypergeometric_sql(total: str, good: str, draws: str, u: str) -> str:
    """SQL for a hypergeometric draw by inversion: values outward from the mode until their probabilities pass u.

    The arguments are names of BIGINT fields (u: a DOUBLE in (0, 1)). Values farther than 12 standard deviations and 24 from
    the mode, whose probability is below 1e-30, stand for nothing; there the mode is returned.
    """
    lo, hi = f"greatest(0L, {draws} + {good} - {total})", f"least({draws}, {good})"
    mode = f"least(greatest(CAST(floor((CAST({draws} AS DOUBLE) + 1) * ({good} + 1) / ({total} + 2)) AS BIGINT), {lo}), {hi})"
    p, q = f"(CAST({draws} AS DOUBLE) / {total})", f"(CAST({total} - {draws} AS DOUBLE) / {total})"
    logs = [_log_binomial(*x, p, q) for x in (("m", good), (f"({draws} - m)", f"({total} - {good})"), (draws, total))]
    p_mode = f"CASE WHEN {lo} = {hi} THEN 1D ELSE exp({logs[0]} + {logs[1]} - {logs[2]}) END"
    spread = f"sqrt(CAST({draws} AS DOUBLE) * {good} / greatest({total}, 1L) * (1 - CAST({good} AS DOUBLE) / greatest({total}, 1L)))"
    steps = f"CAST(least({hi} - {lo}, ceil(12 * {spread}) + 24) AS INT)"
    up = f"(s.ph * ({good} - s.kh) * ({draws} - s.kh) / greatest((s.kh + 1D) * ({total} - {good} - {draws} + s.kh + 1), 1D))"
    down = f"(s.pl * s.kl * ({total} - {good} - {draws} + s.kl) / (({good} - s.kl + 1D) * ({draws} - s.kl + 1)))"
    walk = (
        f"aggregate(sequence(0, {steps}), named_struct('kl', z.m, 'pl', z.p, 'kh', z.m, 'ph', z.p, 'rest', {u} - z.p, 'found', CASE WHEN {u} < z.p THEN z.m END), "
        f"(s, i) -> CASE WHEN s.found IS NOT NULL THEN s ELSE element_at(transform(array(named_struct('up', {up}, 'down', {down})), q -> named_struct("
        "'kl', s.kl - 1, 'pl', q.down, 'kh', s.kh + 1, 'ph', q.up, 'rest', s.rest - q.up - q.down, "
        "'found', CASE WHEN s.rest - q.up < 0 THEN s.kh + 1 WHEN s.rest - q.up - q.down < 0 THEN s.kl - 1 END)), 1) END, s -> coalesce(s.found, z.m))"
    )
    return f"element_at(transform(transform(array({mode}), m -> named_struct('m', m, 'p', {p_mode})), z -> {walk}), 1)"


def communication_matrix(sizes: DataFrame, depth: int, shards: int, seed: int) -> DataFrame:
    """(block, counts): exact counts of rows that each of 2^depth blocks sends to each shard.

    sizes(block, n) holds the blocks' rows (absent: none). Row sums are n; column sums are equal but for one row at most.
    The matrix has the law of a uniform permutation's counts, drawn without one.
    """
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"))
    nodes = total.selectExpr("0L AS node", "total", f"transform(sequence(0L, {shards - 1}L), s -> total div {shards} + IF(s < total % {shards}, 1L, 0L)) AS counts")
    for level in range(1, depth + 1):
        left = sizes.where(F.expr(f"shiftright(block, {depth - level}) % 2 = 0")).groupBy(F.expr(f"shiftright(block, {depth - level + 1})").alias("node")).agg(F.sum("n").alias("take"))
        u = f"(shiftrightunsigned(xxhash64(node, {level}, j, {seed}), 11) + 0.5D) / 9007199254740992D"
        draw = hypergeometric_sql("x.total", "x.good", "x.draws", "x.u")
        split = (
            f"aggregate(sequence(0, {shards - 1}), named_struct('total', total, 'draws', take, 'near', CAST(array() AS ARRAY<BIGINT>)), (a, j) -> element_at(transform(array("
            f"named_struct('total', a.total, 'good', counts[j], 'draws', a.draws, 'u', {u})), x -> element_at(transform(array({draw}), k -> "
            "named_struct('total', a.total - counts[j], 'draws', a.draws - k, 'near', concat(a.near, array(k)))), 1)), 1), a -> a.near)"
        )
        nodes = nodes.join(left, "node", "left").withColumn("take", F.coalesce("take", F.lit(0)).cast("long")).withColumn("near", F.expr(split))
        halves = "inline(array(named_struct('node', node * 2, 'total', take, 'counts', near), named_struct('node', node * 2 + 1, 'total', total - take, 'counts', zip_with(counts, near, (c, k) -> c - k))))"
        nodes = nodes.selectExpr(halves)
    return nodes.select(F.col("node").alias("block"), "counts")


def shard_rows(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, *keep): every row of docs in a uniformly random place; shard sizes differ by one at most.

    size is the text's UTF-8 bytes plus 1 (null: 1), slot is gapless from 0 in each shard. Null ids and texts are ordinary
    values. Equal rows are interchangeable: their places are the same as a set whatever their order. An empty table gives
    an empty result. The place follows from row content, seed and table size alone, so a lost task repeats it. Columns of
    docs other than those named are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hashed = lambda k: F.xxhash64("doc_id", "size", "text_crc32", F.lit(seed), F.lit(k))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), *keep)
    narrow = cut(rows.select("doc_id", "size", "text_crc32"))
    rows = rows if keep else narrow
    depth = max(0, -(-narrow.count() // block_rows) - 1).bit_length()
    block = F.pmod(hashed(0), F.lit(1 << depth)).alias("block")
    matrix = communication_matrix(narrow.groupBy(block).agg(F.count("*").alias("n")), depth, shards, seed)
    ends = cut(matrix.selectExpr("block", f"transform(sequence(1, {shards}), j -> aggregate(slice(counts, 1, j), 0L, (a, c) -> a + c)) AS ends"))
    ties = ("doc_id", "size", "text_crc32")

    def placed(df: DataFrame) -> DataFrame:
        at = F.row_number().over(Window.partitionBy("block").orderBy("one", *ties))
        df = df.withColumns({"block": block, "one": hashed(1), "two": hashed(2), "part": F.pmod(hashed(3), F.lit(1 << depth))}).withColumn("at", at)
        return df.join(ends, "block").withColumn("shard", F.expr("size(filter(ends, e -> e < at))")).drop("block", "one", "at", "ends")

    counts = placed(narrow).groupBy("shard", "part").agg(F.count("*").alias("n"))
    first = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("first"))
    order = Window.partitionBy("shard", "part").orderBy("two", *ties)
    slots = placed(rows).withColumn("rank", F.row_number().over(order)).join(first, ["shard", "part"])
    return slots.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"), *keep)


def op4(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of shard_rows over all documents, under the law `rows`; odd rows as there."""
    out = shard_rows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
