"""Contiguous watermarks, gap ledgers, head progress and resume rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def latest_by_key(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last record of each key by `order`; partial aggregates, no sort."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*log.columns)


def contiguous_watermark(state: DataFrame, initial: DataFrame | int | None = None, key: str = "identity", block: int = 1_000_000) -> DataFrame:
    """(identity, watermark): the largest c such that every cursor from the initial one up to c is completed; NULL if none is.

    state(identity, cursor, status); initial(identity, initial), a number for all, or None: an identity starts at its first
    cursor of any status. Cursors are numbered within blocks of the cursor range, and blocks within the identity, so that no window
    holds more than a block's rows however many an identity has.
    """
    rows = state.select(key, "cursor", (F.col("status") == "completed").alias("done")).groupBy(key, "cursor").agg(F.max("done").alias("done"))
    if initial is None:
        start = rows.groupBy(key).agg((F.min("cursor") - 1).alias("initial"))
    elif isinstance(initial, int):
        start = rows.select(key).distinct().withColumn("initial", F.lit(initial).cast("bigint"))
    else:
        start = initial.select(key, F.col("initial").cast("bigint").alias("initial"))
    done = rows.where("done").join(start, key).where("cursor > initial").withColumn("block", F.floor((F.col("cursor") - F.col("initial") - 1) / block))
    blocks = done.groupBy(key, "initial", "block").agg(F.count("*").alias("n"))
    by_block = Window.partitionBy(key).orderBy("block")
    full = blocks.withColumn("place", F.row_number().over(by_block) - 1).withColumn("unbroken", (F.col("block") == F.col("place")) & (F.coalesce(F.min("n").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(block)) == block))
    open_ = full.where("unbroken").groupBy(key).agg(F.max("block").alias("block"))
    last = done.join(open_, [key, "block"])
    place = F.row_number().over(Window.partitionBy(key).orderBy("cursor"))
    run = last.withColumn("place", place).where(F.col("cursor") == F.col("initial") + F.col("block") * block + F.col("place")).groupBy(key).agg(F.max("cursor").alias("reached"))
    first = open_.join(start, key).select(key, (F.col("initial") + F.col("block") * block).alias("floor"), F.col("block"))
    reached = first.join(run, key, "left").select(key, F.coalesce("reached", F.when(F.col("block") > 0, F.col("floor"))).alias("reached"))
    floor = F.lit(None).cast("bigint") if initial is None else F.col("initial")
    return start.join(reached, key, "left").select(key, F.coalesce("reached", floor).alias("watermark"))


def preview_watermark(state: DataFrame, batch: DataFrame, initial=None, key: str = "identity") -> DataFrame:
    """The watermark that state would have with batch, nothing written."""
    cols = [key, "cursor", "status"]
    return contiguous_watermark(state.select(cols).union(batch.select(cols)), initial, key)


def merge_state(current: DataFrame, external: DataFrame, watermark: DataFrame, key: str = "identity") -> DataFrame:
    """current with those of external's rows that are newer: version is (updated_at_ms, status); rows at or below the watermark are left out.

    Of each cursor the newest external row counts, and only if it is newer than the newest current one. A completed current row
    stays completed, for a later failure does not undo it; an older external completion does not clear a failure.
    """
    cols = [key, "cursor", "status", "updated_at_ms"]
    rows = current.select(*cols, F.lit(True).alias("own")).union(external.select(*cols, F.lit(False)))
    rows = rows.join(watermark.select(key, "watermark"), key, "left").where("watermark IS NULL OR cursor > watermark")
    version = F.struct("updated_at_ms", "status")
    best = rows.groupBy(key, "cursor").agg(
        F.max(F.when(F.col("own"), version)).alias("mine"),
        F.max(F.when(F.col("own") & (F.col("status") == "completed"), version)).alias("done"),
        F.max(F.when(~F.col("own"), version)).alias("theirs"),
    )
    newer = F.col("theirs").isNotNull() & (F.col("mine").isNull() | (F.col("theirs") > F.col("mine")))
    undone = F.col("done").isNotNull() & (F.col("theirs.status") != "completed")
    v = F.when(newer & ~undone, F.col("theirs")).otherwise(F.coalesce("done", "mine"))
    return best.select(key, "cursor", v["status"].alias("status"), v["updated_at_ms"].alias("updated_at_ms"))


def needs_state_row(batch: DataFrame, failed: DataFrame, watermark: DataFrame, key: str = "identity") -> DataFrame:
    """batch's cursors that need a row in the gap ledger: failed before, or past the next expected one."""
    f = failed.select(key, "cursor").distinct().withColumn("__f", F.lit(True))
    joined = batch.join(f, [key, "cursor"], "left").join(watermark.select(key, "watermark"), key, "left")
    return joined.where(F.col("__f") | F.coalesce(F.col("cursor") > F.col("watermark") + 1, F.lit(False))).select(*batch.columns)


def gap_metrics(state: DataFrame, watermark: DataFrame, target: Column, key: str = "identity") -> DataFrame:
    """commit cursor, gap count, oldest gap and commit delay of each identity; state's failed cursors above the watermark are gaps."""
    one = state.groupBy(key, "cursor").agg(F.max(F.struct("updated_at_ms", "status")).alias("v")).join(watermark, key)
    gap = (F.col("v.status") == "failed") & (F.col("watermark").isNull() | (F.col("cursor") > F.col("watermark")))
    out = one.groupBy(key).agg(F.first("watermark").alias("commit_cursor"), F.count_if(gap).alias("gap_count"), F.min(F.when(gap, F.col("cursor"))).alias("oldest_gap"), F.max(target).alias("target"))
    return out.select(key, "commit_cursor", "gap_count", "oldest_gap", F.greatest(F.col("target") - F.col("commit_cursor"), F.lit(0)).alias("commit_delay"))


_IDENTITY = ("pipeline", "chain_uid", "chain_type", "network", "mode", "entities")


def _state_contract(rows: DataFrame, identity: dict[str, Column], status: Column, error: Column, now_ms: int, by_cursor: bool) -> DataFrame:
    from ledgerframe.operators.identity import identity_key

    fields = {k: identity[k] for k in _IDENTITY}
    key = identity_key(*fields.values())
    own = identity_key(*fields.values(), cursor=F.col("cursor")) if by_cursor else key
    unit = F.when(fields["chain_type"] == "sui", "checkpoint").otherwise("block")
    now = F.lit(now_ms).cast("bigint")
    return rows.select(
        "cursor", status.alias("status"), now.alias("updated_at_ms"), *[c.alias(k) for k, c in fields.items() if k != "entities"], unit.alias("primary_unit"),
        F.array_sort(fields["entities"]).alias("entities"), error.cast("string").alias("error"), own.alias("id"), now.alias("ingest_timestamp"), key.alias("kafka_partition_key"),
    )


def checkpoint_rows(watermark: DataFrame, identity: dict[str, Column], status: str, now_ms: int) -> DataFrame:
    """Watermark rows to the checkpoint contract, with the identity key as id and partition key."""
    return _state_contract(watermark.withColumn("cursor", F.col("watermark")), identity, F.lit(status), F.lit(None), now_ms, False)


def state_rows(rows: DataFrame, identity: dict[str, Column], now_ms: int) -> DataFrame:
    """Gap rows(cursor, status[, error]) to the watermark-state contract, a row each; ids are per cursor, the partition key is the identity's."""
    error = F.col("error") if "error" in rows.columns else F.lit(None)
    return _state_contract(rows, identity, F.col("status"), error, now_ms, True)


def _before(df: DataFrame, value: str, order: str, key: str | None, block: int, inclusive: bool = False) -> DataFrame:
    """df with __before: the largest value of the rows before a row (or up to it), by key.

    The running maximum goes over blocks of the order column first and then over the blocks' maxima, so no window holds more
    than a block's rows and one row a block, however many rows a key has.
    """
    by = [key] if key else []
    rows = df.withColumn("__block", F.floor(F.col(order) / block))
    blocks = rows.groupBy(*by, "__block").agg(F.max(value).alias("__most"))
    over = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__earlier", F.max("__most").over(over)).drop("__most")
    within = Window.partitionBy(*by, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    joined = rows.withColumn("__within", F.max(value).over(within)).join(blocks, [*by, "__block"], "left")
    return joined.withColumn("__before", F.greatest("__within", "__earlier")).drop("__block", "__within", "__earlier")


def head_progress(heads: DataFrame, order: str = "seq", head: str = "head", key: str | None = None, block: int = 1_000_000) -> DataFrame:
    """Observations that raise the head over all before them; order is a number, `block` of which make a window."""
    rows = _before(heads, head, order, key, block).withColumnRenamed("__before", "previous")
    return rows.where(F.col("previous").isNull() | (F.col(head) > F.col("previous"))).select(*heads.columns, "previous")


def emit_cursors(heads: DataFrame, start: int | str = "chainhead", order: str = "seq", head: str = "head", key: str | None = None, block: int = 1_000_000) -> DataFrame:
    """(order, cursor): the cursors that each rise of the head releases.

    With chainhead the first is the first head itself; with a number none is released before the head reaches it.
    """
    return laid_out(head_progress(heads, order, head, key, block), start, order, head, key)


#: A span has 2^SPAN cursors and begins at a multiple of that, so spans of all keys have the same cursors.
SPAN = 10


def laid_out(rises: DataFrame, start: int | str, order: str = "seq", head: str = "head", key: str | None = None) -> DataFrame:
    """(order, cursor) as released() gives, laid out for writing: rises are cut into spans of cursors, and spans are dealt and sorted before the cursors are made.

    What moves are spans, never cursors. The spans of one place follow each other, so a column file repeats one run of cursors, which costs next to
    nothing, where runs from all over the range cost bytes for each. The number of partitions is fixed, since rows multiply after the exchange.
    """
    spans = _ranges(rises, start, order, head, key).withColumn("__span", F.explode(F.sequence(F.shiftright("__low", SPAN), F.shiftright("__high", SPAN))))
    parts = int(rises.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One after another and not by hash: spans of one place are as many as keys pass it, so a few more of them would make a task far longer than the others.
    spans = spans.repartitionById(parts, F.pmod("__span", F.lit(parts)).cast("int")).sortWithinPartitions("__span", *([key] if key else []), order)
    low, high = F.greatest("__low", F.shiftleft("__span", SPAN)), F.least("__high", F.shiftleft("__span", SPAN) + (2**SPAN - 1))
    return spans.select(*([key] if key else []), order, F.explode(F.sequence(low, high)).alias("cursor"))


def released(rises: DataFrame, start: int | str, order: str = "seq", head: str = "head", key: str | None = None) -> DataFrame:
    """(order, cursor): the cursors of rises(order, head, previous), see emit_cursors; nothing is exchanged, so it serves streams too."""
    return _ranges(rises, start, order, head, key).select(*([key] if key else []), order, F.explode(F.sequence("__low", "__high")).alias("cursor"))


def _ranges(rises: DataFrame, start: int | str, order: str, head: str, key: str | None) -> DataFrame:
    """(order, __low, __high): the first and last cursor that each rise releases, where there is any."""
    first = F.col(head) if start == "chainhead" else F.lit(int(start))
    low = F.coalesce(F.col("previous") + 1, first)
    low = low if start == "chainhead" else F.greatest(low, F.lit(int(start)))
    return rises.where(F.col(head) >= low).select(*([key] if key else []), order, low.cast("bigint").alias("__low"), F.col(head).cast("bigint").alias("__high"))


def ingestion_lag(df: DataFrame, order: str = "seq", key: str | None = None, end: int | None = None, block: int = 1_000_000) -> DataFrame:
    """df(seq, cursor, head) with head_lag (head − cursor) and ingestion_lag (head − the largest cursor so far, or what a backfill to `end` lacks)."""
    out = df if end is not None else _before(df, "cursor", order, key, block, inclusive=True)
    own = F.col("head") - F.col("__before") if end is None else F.greatest(F.lit(end) - F.col("cursor"), F.lit(0))
    return out.withColumns({"head_lag": F.col("head") - F.col("cursor"), "ingestion_lag": own}).select(*df.columns, "head_lag", "ingestion_lag")


def cursor_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    """The cursors from start to end, both included."""
    return spark.range(start, end + 1).select(F.col("id").alias("cursor"))


def infer_mode(to: int | str | None) -> str:
    """backfill where there is an end, else realtime."""
    return "backfill" if to is not None else "realtime"


def resume_plan(mode: str, start: int | str, resume: int | None) -> int | str:
    """The first cursor (or chainhead): a backfill goes on after the saved cursor, checkpoint takes it up or starts at the head, explicit starts ignore it."""
    if mode == "backfill":
        return max(int(start), resume + 1) if resume is not None else int(start)
    if start == "checkpoint":
        return resume + 1 if resume is not None else "chainhead"
    return "chainhead" if start in ("chainhead", "latest") else int(start)


def resume_plans(mode: Column, start: Column, resume: Column) -> Column:
    """resume_plan as text, for a table of pipelines with their saved cursors; start is text."""
    after, number = resume + 1, start.try_cast("bigint")
    saved = F.coalesce(after.cast("string"), F.lit("chainhead"))
    realtime = F.when(start == "checkpoint", saved).when(start.isin("chainhead", "latest"), "chainhead").otherwise(number.cast("string"))
    return F.when(mode == "backfill", F.greatest(number, after).cast("string")).otherwise(realtime)


def final_status(mode: str) -> str:
    """The status of the closing watermark row."""
    return "eos" if mode == "backfill" else "running"
