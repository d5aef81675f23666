"""Benchmark decontamination in DataFrame functions only.

Items become windows of normalised words, windows become 64-bit hashes, and the set of hashes is broadcast once its size is
checked. Documents are scanned whole: the hash of every window of a length that occurs is looked up in that set, and hits are
verified on the words themselves, so only true occurrences count. What is hit can be dropped by document or cut out by span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerframe.llm.common import ascii_lower, cut, fresh, table

#: Fixed value: what stands between the contract's words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same in a text that is not lower-cased yet.
_BETWEEN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
WINDOW = 13
#: Bytes, at most, that the hashes of windows may take where they are broadcast, at about 50 for each; more of them meet the
#: documents' hashes by a shuffle of (row number, place, hash), and words are fetched for hits alone.
BROADCAST_BYTES, HASH_BYTES = 256 << 20, 50
_SPANS = "array<struct<start:int,end:int>>"


def words(text: Column) -> Column:
    """The array of normalised words of a text; null has none."""
    clean = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN, " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def window_hashes(hashes: Column, length: int) -> Column:
    """A hash of each window of `length` from the array of word hashes; none if there are fewer words."""
    at = F.sequence(F.lit(1), F.size(hashes) - (length - 1))
    return F.when(F.size(hashes) >= length, F.transform(at, lambda i: F.xxhash64(F.slice(hashes, i, length)))).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, len, ws, hash): the distinct windows of each item; a shorter item, but not an empty one, is one window."""
    w = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws")).where("size(ws) > 0")
    w = w.select("item", F.explode(F.expr(f"transform(sequence(1, greatest(size(ws) - {window - 1}, 1)), i -> slice(ws, i, {window}))")).alias("ws")).distinct()
    return w.select("item", F.size("ws").alias("len"), "ws", F.xxhash64(F.transform("ws", lambda x: F.xxhash64(x))).alias("hash"))


def occurrences(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """rows(rid, ws, ...) without ws, with a row for each window found (start, len, item), and one with nulls for each row of rows without any.

    Where the set of hashes is broadcast it is one pass: each row's array of hashes begins with a mark that is in the set too, so
    that rows without a hit stay. Where the set is too large for that, rows are written once under their numbers, hashes
    alone go to the join, and hits come back to the rows by number.
    """
    keep = [c for c in rows.columns if c != "ws"]
    lengths = [r[0] for r in windows.select("len").distinct().orderBy("len").collect()]
    keys = windows.select("hash").distinct()
    small = keys.count() * HASH_BYTES <= BROADCAST_BYTES
    mark = F.lit(0).cast("bigint")
    if small:
        keys = F.broadcast(keys.union(windows.sparkSession.range(1).select(mark)).distinct())
    else:
        rows = cut(rows)
    own = [*keep, "ws"] if small else ["rid"]
    hashed = rows.withColumn("hashes", F.transform("ws", lambda x: F.xxhash64(x)))
    hashes = F.concat(F.array(mark) if small else F.array().cast("array<bigint>"), *[window_hashes(F.col("hashes"), k) for k in lengths])
    hashed = hashed.select(*own, F.size("ws").alias("of"), hashes.alias("hashes"))
    # posexplode_outer: for posexplode, a filter on the array's size would be pushed below, with all that makes the array inlined.
    hits = hashed.select(*own, "of", F.posexplode_outer("hashes").alias("p", "hash")).join(keys, "hash", "left_semi")
    # The position among a row's hashes, after the mark, tells a window's length and place.
    start, length, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1 if small else 0)
    for k in lengths:
        after = before + F.greatest(F.col("of") - (k - 1), F.lit(0))
        inside = (F.col("p") >= before) & (F.col("p") < after)
        start, length, before = F.when(inside, F.col("p") - before).otherwise(start), F.when(inside, F.lit(k)).otherwise(length), after
    hits = hits.select(*own, "hash", start.alias("start"), length.alias("len"))
    if not small:
        hits = rows.join(hits, "rid", "left").select(*keep, "ws", "hash", "start", "len")
    hits = hits.withColumn("ws", F.slice("ws", F.col("start") + 1, F.col("len")))
    found = hits.join(windows, ["hash", "len", "ws"], "left")
    real = F.col("item").isNotNull()
    return found.select(*keep, F.when(real, F.col("start")).alias("start"), F.when(real, F.col("len")).alias("len"), "item")


def merged(spans: Column) -> Column:
    """The disjoint union of half-open word spans in order of their starts."""

    def join(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(last["end"] >= s["start"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(_SPANS), join)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), window: int = WINDOW, share: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans, contaminated, *keep), one row per row of docs.

    A word inside any occurrence of an item's window is hit; a document is contaminated if some word is hit and at least
    one in `share` is. items lists the item ids found, sorted as strings, spans the hit words as disjoint half-open ranges.
    Null and blank texts have no words and no hits; very long texts are scanned whole; a null item id or an item without words
    gives no window; repeated rows and repeated items are judged alike each time; an empty docs gives an empty result, empty
    items leave every document clean. Columns not named are not read, whatever their names.
    """
    windows = item_windows(items, window=window)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(F.col(id_col).alias("doc_id"), *keep).alias("doc"), words(F.col(text_col)).alias("ws"))
    found = occurrences(rows.select("rid", "doc", F.size("ws").alias("n_words"), "ws"), windows)
    spans = F.collect_set(F.when(F.col("item").isNotNull(), F.struct("start", (F.col("start") + F.col("len")).alias("end"))))
    per = found.groupBy("rid").agg(F.first("doc").alias("doc"), F.first("n_words").alias("n_words"), spans.alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    per = per.withColumn("spans", merged(F.col("spans").cast(_SPANS)))
    per = per.withColumn("n_hit", F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]))
    return per.select(
        "doc.doc_id", F.col("n_words").cast("long"), F.col("n_hit").cast("long"), F.size("items").cast("long").alias("n_items"), "items", "spans",
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), *[F.col(f"doc.{c}").alias(c) for c in keep],
    )


def without_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with every hit word, and what stands between it and the word before, cut out of the text.

    Every row stays and has docs' columns, whatever their names; texts without a hit stay as they are, null texts null.
    """
    row = fresh(docs, "row")
    judged = decontaminate(docs.withColumn(row, F.struct(*docs.columns)), items, id_col, text_col, keep=(row,), window=window)
    text = F.col(row)[text_col].cast("string")
    pieces = F.regexp_extract_all(text, F.lit(f"[{_BETWEEN}]*[^{_BETWEEN}]+"), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    cleaned = F.concat(F.array_join(kept, ""), F.regexp_extract(text, f"[{_BETWEEN}]*$", 0))
    return judged.select(*[(F.when(F.size("spans") > 0, cleaned).otherwise(text) if c == text_col else F.col(row)[c]).alias(c) for c in docs.columns])


def op9(spark, sf_dir: str) -> DataFrame:
    """The contract's digest columns of decontaminate over all documents; nulls, repeated rows and empty tables as there."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP9_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
items AS (SELECT item_id::VARCHAR AS item,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark WHERE item_id IS NOT NULL),
wins AS (SELECT DISTINCT item, least(len(ws), 13) AS k, array_to_string(list_slice(ws, i, i + 12), ' ') AS win FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM items WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM wins),
pos AS (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM docs, ks WHERE len(ws) >= k),
hits AS (SELECT rid, i, p.k, item FROM pos p JOIN wins w ON w.k = p.k AND w.win = array_to_string(list_slice(p.ws, p.i, p.i + p.k - 1), ' ')),
words AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM hits) GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n, array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM hits GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(w.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items,
  sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(w.n, 0) > 0 AND 20 * coalesce(w.n, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN words w USING (rid) LEFT JOIN found f USING (rid)
"""
