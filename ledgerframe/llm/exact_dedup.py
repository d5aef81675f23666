"""Exact dedup by Grace hashing: records fall into buckets until each fits an open-addressing table that compares whole contents.

1. Each task folds the equal contents among its own rows in such a table: one row for each content that it holds, with the rows behind it.
2. Contents that many tasks hold go through salted buckets first, so that never more than FAN copies of one meet in a bucket.
3. An exchange by hash makes the buckets, and a task folds its bucket in a table of bounded bytes. What finds no room goes, with all
   its copies, to buckets by another hash at the next level, until nothing is left over.
4. Only row numbers travel back to the members; texts cross the exchange once for each task and content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerframe.llm.common import cut, fresh, table

#: Fixed value: the characters that normalising deletes (bytes 09-0D and 20).
BLANKS = bytes([9, 10, 11, 12, 13, 32])
#: Bytes of contents that a table holds; a bucket is planned at half of that.
TABLE_BYTES = 64 << 20
#: Bytes of contents and number of rows after which a task starts a new table while it folds its own rows.
LOCAL_BYTES, LOCAL_ROWS = 16 << 20, 100_000
#: Copies of one content that may meet in a bucket; more of them go through salted buckets first.
FAN = 32
_BEST = "best_n long, best_id {id}, best_rep long, best_at int"
_TODO = ("rep", "h", "sha", "content", "size", "copies", "best_n", "best_id", "best_rep", "best_at")
_FOLDED = "rep long, to long, h long, sha binary, content binary, size long, copies long, " + _BEST


class Table:
    """Open addressing with linear probing over entries (hash, content); a slot holds the number of an entry or -1."""

    def __init__(self, most_bytes: int) -> None:
        self.slots, self.mask, self.most_bytes, self.bytes = [-1] * 1024, 1023, most_bytes, 0
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def find(self, h: int, content: bytes) -> tuple[int, int]:
        """(entry, slot): the entry of an equal content, or -1, and the slot where probing ended."""
        at, slots, hashes, contents = h & self.mask, self.slots, self.hashes, self.contents
        while (k := slots[at]) >= 0:
            if hashes[k] == h and contents[k] == content:
                return k, at
            at = (at + 1) & self.mask
        return -1, at

    def has_room(self, content: bytes) -> bool:
        """Whether content fits; an empty table takes any."""
        return not self.hashes or self.bytes + len(content) <= self.most_bytes

    def add(self, h: int, content: bytes, slot: int) -> int:
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content)
        self.slots[slot] = len(self.hashes) - 1
        if 3 * len(self.hashes) > 2 * len(self.slots):
            self.slots, self.mask = [-1] * (2 * len(self.slots)), 2 * len(self.slots) - 1
            for k, old in enumerate(self.hashes):
                at = old & self.mask
                while self.slots[at] >= 0:
                    at = (at + 1) & self.mask
                self.slots[at] = k
        return len(self.hashes) - 1


def _rank(n: int, own_id, rep: int, at: int) -> tuple:
    """Sorts first the row that stays: most code points, smallest id (null last), then place."""
    return -n, own_id is None, own_id if own_id is not None else 0, rep, at


def local_rows(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row for each content of a task's table: number, hashes, content, its members, and the best of them.

    Columns of a batch: doc_id, text, then what members carry along.
    """
    count = TaskContext.get().partitionId() << 33

    def flush(held: Table, groups: list[list[int]], kept: list[pa.RecordBatch], shas: list[bytes], lengths: list[int]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(kept).combine_chunks().take(pa.array([i for g in groups for i in g], pa.int64()))
        ids, starts = rows.column(0).to_pylist(), [0]
        for g in groups:
            starts.append(starts[-1] + len(g))
        sizes = [lengths[i] for g in groups for i in g]
        best = [min(_rank(sizes[k], ids[k], count + e, k - a) for k in range(a, b)) for e, (a, b) in enumerate(zip(starts, starts[1:]))]
        member = schema.field("members").type.value_type
        columns = [pa.array(sizes, pa.int64()), *[pa.concat_arrays(c.chunks) for c in rows.columns]]
        columns = [c.cast(f.type) for c, f in zip(columns, member, strict=True)]
        members = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(member)))
        out = {
            "rep": range(count, count + len(groups)), "h": held.hashes, "sha": shas, "content": held.contents, "size": map(len, held.contents), "copies": map(len, groups),
            "best_n": [-b[0] for b in best], "best_id": [None if b[1] else b[2] for b in best], "best_rep": [b[3] for b in best], "best_at": [b[4] for b in best],
        }
        return pa.RecordBatch.from_arrays([pa.array(list(out[f.name]), f.type) if f.name != "members" else members.cast(f.type) for f in schema], schema=schema)

    held, groups, kept, shas, lengths = Table(LOCAL_BYTES), [], [], [], []
    for batch in batches:
        texts, kept_columns = batch.column(1), [0, *range(2, batch.num_columns)]
        points = pc.utf8_length(texts).to_pylist()
        start = 0
        for i, raw in enumerate(texts.cast(pa.binary())):
            content = raw.as_py().translate(None, BLANKS)
            sha = hashlib.sha256(content).digest()
            h = int.from_bytes(sha[:8], "big", signed=True)
            entry, slot = held.find(h, content)
            if (entry < 0 and not held.has_room(content)) or len(lengths) >= LOCAL_ROWS:
                kept.append(batch.slice(start, i - start).select(kept_columns))
                yield flush(held, groups, kept, shas, lengths)
                count, start = count + len(groups), i
                held, groups, kept, shas, lengths = Table(LOCAL_BYTES), [], [], [], []
                entry, slot = held.find(h, content)
            if entry < 0:
                entry = held.add(h, content, slot)
                groups.append([])
                shas.append(sha)
            groups[entry].append(len(lengths))
            lengths.append(points[i])
        kept.append(batch.slice(start).select(kept_columns))
    if lengths:
        yield flush(held, groups, kept, shas, lengths)


def folded_rows(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most_bytes: int, pass_on: bool) -> Iterator[pa.RecordBatch]:
    """What a bucket's table makes of its rows (rep, h, sha, content, size, copies, best): a row for each rep with the rep it goes to.

    Rows without room have no `to` and keep their content. With pass_on they go to themselves, and each content's first rep keeps
    the content and has the sums; without it every rep has the sums.
    """
    held, reps, shas, copies, bests, over = Table(most_bytes), [], [], [], [], []
    emit = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    for batch in batches:
        for rep, h, sha, content, n, most, own_id, best_rep, best_at in zip(*(batch.column(c).to_pylist() for c in ("rep", "h", "sha", "content", "copies", "best_n", "best_id", "best_rep", "best_at")), strict=True):
            entry, slot = held.find(h, content)
            rank = _rank(most, own_id, best_rep, best_at)
            if entry < 0 and not held.has_room(content):
                over.append((rep, rep if pass_on else None, h, sha, content, len(content), n, most, own_id, best_rep, best_at))
                continue
            if entry < 0:
                held.add(h, content, slot)
                reps.append([rep])
                shas.append(sha)
                copies.append(n)
                bests.append(rank)
            else:
                reps[entry].append(rep)
                copies[entry] += n
                bests[entry] = min(bests[entry], rank)
        if over:
            yield emit(over)
            over = []
    rows = []
    for k, own in enumerate(reps):
        first, (most, none, own_id, best_rep, best_at) = own[0], bests[k]
        for rep in own:
            content = held.contents[k] if pass_on and rep == first else None
            rows.append((rep, first, held.hashes[k], shas[k], content, len(held.contents[k]), copies[k], -most, None if none else own_id, best_rep, best_at))
            if len(rows) >= 10_000 or content and len(rows) * len(content) > 8 << 20:
                yield emit(rows)
                rows = []
    if rows:
        yield emit(rows)


def _fold(rows: DataFrame, id_type: str, parts: int, by: tuple, most_bytes: int, pass_on: bool = False) -> DataFrame:
    kind = StructType.fromDDL(_FOLDED.format(id=id_type))
    schema = to_arrow_schema(kind)
    own = rows.select("rep", "h", "sha", "content", "copies", "best_n", "best_id", "best_rep", "best_at", *[c for c in by if c != "h"])
    return cut(own.repartition(parts, *by).mapInArrow(lambda it: folded_rows(it, schema, most_bytes, pass_on), kind))


def _parts(rows: DataFrame, table_bytes: int) -> int:
    """Buckets for contents of rows, at half a table each."""
    return -(-2 * (rows.agg(F.sum("size")).first()[0] or 0) // table_bytes) or 1


def exact_dedup(docs: DataFrame, keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES, fan: int = FAN) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, *keep): a row for each row of docs.

    Texts are equal if they are the same after deleting ASCII white space; a null text is an empty one. Of equal texts the row of
    most code points stays, then that of the smallest id (a null id is the largest); of rows equal in both exactly one, any of them,
    has `kept`. A very long text is one content like any other: a table takes at least one. An empty table gives an empty result.
    Columns of docs other than those named are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    carried = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *carried)
    inner = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    kind = StructType.fromDDL(f"rep long, h long, sha binary, content binary, size long, copies long, {_BEST.format(id=id_type)}, members array<struct<n:bigint,{inner}>>")
    schema = to_arrow_schema(kind)
    local = cut(rows.mapInArrow(lambda it: local_rows(it, schema), kind))

    todo, way, most = local.select(*_TODO), None, None
    while True:  # contents that more than `fan` tasks hold meet in salted buckets, a level of them at a time
        many = cut(todo.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > fan))
        before, most = most, many.agg(F.max("n")).first()[0]
        if most is None or before is not None and most >= before:
            break
        hot = todo.join(many, "h").withColumn("salt", F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / fan)))
        step = _fold(hot, id_type, _parts(hot, table_bytes), ("h", "salt"), table_bytes, pass_on=True)
        to = step.select(F.col("rep").alias("to"), F.col("to").alias("then"))
        way = step.select("rep", "to") if way is None else way.join(to, "to", "left").select("rep", F.coalesce("then", "to").alias("to"))
        todo = todo.join(many, "h", "left_anti").unionByName(step.where("content IS NOT NULL").select(*_TODO))
    done, level = None, 0
    while True:
        step = _fold(todo.withColumn("bucket", F.xxhash64("h", F.lit(level))), id_type, _parts(todo, table_bytes), ("bucket",), table_bytes)
        ready = step.where("to IS NOT NULL").select("rep", "sha", "copies", "best_id", "best_rep", "best_at")
        done = ready if done is None else done.unionByName(ready)
        todo, level = step.where("to IS NULL"), level + 1
        if todo.isEmpty():
            break
    if way is not None:
        moved = way.join(done.withColumnRenamed("rep", "to"), "to").drop("to")
        done = done.join(way.select("rep"), "rep", "left_anti").unionByName(moved)
    judged = local.select(F.col("rep").alias("own"), "members").join(done, F.col("own") == F.col("rep"))
    each = judged.select("own", "sha", "copies", "best_id", "best_rep", "best_at", F.posexplode("members").alias("at", "m"))
    kept = (F.col("own") == F.col("best_rep")) & (F.col("at") == F.col("best_at"))
    return each.select(
        F.col("m.doc_id").alias("doc_id"), F.col("best_id").alias("keep_id"), F.col("copies").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
        *[F.col(f"m.k{i}").alias(c) for i, c in enumerate(keep)],
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, whole, with all their columns; which of equal texts stays is told by exact_dedup."""
    row = fresh(docs, "row")
    judged = exact_dedup(docs.withColumn(row, F.struct(*docs.columns)), (row,), id_col, text_col)
    return judged.where("kept").select(f"{row}.*")


def op13(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of exact_dedup over all documents; odd rows as there."""
    return exact_dedup(table(spark, sf_dir, "documents"))


#: DuckDB, over the table documents. Which of rows of one id and one text stays is open, and shows nowhere.
OP13_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents),
r AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id FROM d WINDOW w AS (PARTITION BY content ORDER BY n DESC, doc_id NULLS LAST)),
g AS (SELECT content, count(*) AS group_size FROM d GROUP BY content)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM r JOIN g USING (content)
"""
