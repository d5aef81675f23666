"""Latency, throughput, health and delivery reports."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerframe.storage import cut


def delivery_summary(acks: DataFrame, by: list[str]) -> DataFrame:
    """Per batch: first event and ingest, last append, their differences (NULL where a side is), rows."""
    out = acks.groupBy(*by).agg(F.min("event_ms").alias("first_event_ms"), F.min("ingest_ms").alias("first_ingest_ms"), F.max("append_ms").alias("last_append_ms"), F.count("*").alias("messages"))
    return _differences(out)


def _differences(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "event_to_ingest_ms": F.col("first_ingest_ms") - F.col("first_event_ms"), "ingest_to_append_ms": F.col("last_append_ms") - F.col("first_ingest_ms"), "event_to_append_ms": F.col("last_append_ms") - F.col("first_event_ms"),
    })


def topic_counts(acks: DataFrame, by: list[str]) -> DataFrame:
    return acks.groupBy(*by, "topic").agg(F.count("*").alias("messages"))


def merge_delivery_summaries(summaries: DataFrame, by: list[str]) -> DataFrame:
    """Summaries of several batches as one per group: the first event and ingest, the last append, all messages."""
    out = summaries.groupBy(*by).agg(F.min("first_event_ms").alias("first_event_ms"), F.min("first_ingest_ms").alias("first_ingest_ms"), F.max("last_append_ms").alias("last_append_ms"), F.sum("messages").alias("messages"))
    return _differences(out)


def exact_percentiles(df: DataFrame, value: str, shares: list[float], cells: int = 4096) -> list[float | None]:
    """The exact, linearly interpolated percentiles of a numeric column; None without values.

    A search by range: the range of the finite values is cut into cells, whose counts tell the few that hold the places asked for,
    and those are cut again until each holds one value, which takes a few passes over the column, written once. Only counts of cells
    come to the driver. Infinities and NaN are counted apart and stand at the ends, NaN last; between two infinities of one sign is that
    infinity, and a place between a finite value and an infinity is what the interpolation gives.
    """
    v = F.col("v")
    rows = cut(df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v")))
    finite = ~F.isnan(v) & (F.abs(v) < float("inf"))
    lo, hi, n, below, above, nans = rows.agg(
        F.min(F.when(finite, v)), F.max(F.when(finite, v)), F.count("*"), F.count_if(v == float("-inf")), F.count_if(v == float("inf")), F.count_if(F.isnan(v))
    ).first()
    if not n:
        return [None] * len(shares)
    places = [(n - 1) * p for p in shares]
    found: dict[int, float] = {}
    wanted = {}
    for r in {r for at in places for r in (math.floor(at), math.ceil(at))}:
        if r < below:
            found[r] = -math.inf
        elif r >= n - nans:
            found[r] = math.nan
        elif r >= n - nans - above:
            found[r] = math.inf
        else:
            wanted[r] = r - below
    # Ranges still open, with the ranks looked for: {rank in all: rank within the range}.
    ranges = {(lo, hi): wanted} if wanted else {}
    while ranges:
        for low, high in [x for x in ranges if x[0] == x[1]]:
            found |= dict.fromkeys(ranges.pop((low, high)), low)
        own = list(ranges)
        if not own:
            break
        cell = F.lit(None).cast("int")
        for k, (low, high) in enumerate(own):
            # Halves keep the width of the widest range finite; the first and last value never share a cell, so each pass narrows.
            share = (v / 2 - low / 2) / (high / 2 - low / 2) if math.isinf(high - low) else (v - low) / (high - low)
            at = F.when(v == high, cells - 1).otherwise(F.least(F.floor(share * cells), F.lit(cells - 2))).cast("int") + k * cells
            cell = F.when(v.between(low, high), at).otherwise(cell)
        counts = rows.where(finite).withColumn("cell", cell).where("cell IS NOT NULL").groupBy("cell").agg(F.count("*").alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
        after: dict[tuple[float, float], dict[int, int]] = {}
        before, last = 0, -1
        for r in sorted(counts.collect(), key=lambda r: r["cell"]):
            k = r["cell"] // cells
            before = before if k == last else 0
            for rank, place in ranges[own[k]].items():
                if before <= place < before + r["c"]:
                    after.setdefault((r["low"], r["high"]), {})[rank] = place - before
            before, last = before + r["c"], k
        ranges = after

    def between(at: float) -> float:
        low, high = found[math.floor(at)], found[math.ceil(at)]
        return low if low == high else low + (high - low) * (at - math.floor(at))

    return [between(at) for at in places]


def benchmark_summary(samples: DataFrame, value: Column, elapsed_s: float) -> DataFrame:
    """Mean, extremes and exact interpolated percentiles of value; blocks and messages a second (NULL without elapsed time)."""
    v = samples.withColumn("v", value)
    rate = F.nullif(F.greatest(F.lit(float(elapsed_s)), F.lit(0.0)), F.lit(0.0))
    out = v.agg(F.count("*").alias("blocks"), F.sum("messages").alias("messages"), F.avg("v").alias("avg_ms"), F.min("v").alias("min_ms"), F.max("v").alias("max_ms"))
    p = dict(zip(("p50_ms", "p95_ms", "p99_ms"), exact_percentiles(v, "v", [0.5, 0.95, 0.99]), strict=True))
    return out.withColumns({k: F.lit(x).cast("double") for k, x in p.items()} | {"blocks_per_s": F.col("blocks") / rate, "messages_per_s": F.col("messages") / rate})


def percentile_floor(df: DataFrame, value: str, percents: list[int], by: list[str]) -> DataFrame:
    """Per group and percent: the value at place min(floor(n·p/100), n−1) of the sorted values; groups without values have no row.

    Places are found by counts of distinct values, so a window holds a group's distinct values, not its rows.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*by)
    upto = F.sum("c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumns({"upto": upto, "n": F.sum("c").over(w)}).withColumn("percent", F.explode(F.array(*map(F.lit, percents))))
    place = F.least(F.floor(F.col("n") * F.col("percent") / 100), F.col("n") - 1)
    return ranked.where((F.col("upto") > place) & (F.col("upto") - F.col("c") <= place)).select(*by, "percent", F.col(value).alias("value"))


def cursor_event_time(bundle: dict[str, DataFrame]) -> DataFrame:
    """(cursor, event_ms): the earliest event of any entity of a cursor."""
    from functools import reduce

    rows = [df.select("cursor", "event_timestamp_ms") for df in bundle.values()]
    return reduce(DataFrame.union, rows).groupBy("cursor").agg(F.min("event_timestamp_ms").alias("event_ms"))


def rpc_phase_timings(cursors: DataFrame, requests: DataFrame) -> DataFrame:
    """Per cursor: requests, summed, mean and extreme latency, mean wait; zeros where there was no request."""
    sums = requests.groupBy("cursor").agg(F.count("*").alias("requests"), F.sum("latency_ms").alias("sum_ms"), F.avg("latency_ms").alias("avg_ms"), F.min("latency_ms").alias("min_ms"), F.max("latency_ms").alias("max_ms"), F.avg("queue_wait_ms").alias("avg_wait_ms"))
    return cursors.select("cursor").join(sums, "cursor", "left").na.fill(0)


def engine_counters(events: DataFrame) -> DataFrame:
    """(entity, stage, n) with totals by entity, by stage of none, and over all (NULL stands for all)."""
    return events.rollup("entity", "stage").agg(F.count("*").alias("n"))


def rpc_counters(samples: DataFrame) -> DataFrame:
    """Requests by method and status, one column a status, and retries."""
    statuses = ("success", "timeout", "transport_error", "request_error")
    return samples.groupBy("method").agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses], F.sum("retries").alias("retries"))


def latency_histogram(df: DataFrame, value: str, bounds: list[float], by: list[str]) -> DataFrame:
    """(…, le, n): rows up to each bound and above the one before; le is NULL above the last."""
    le = F.lit(None).cast("double")
    for b in sorted(bounds, reverse=True):
        le = F.when(F.col(value) <= b, float(b)).otherwise(le)
    return df.withColumn("le", le).groupBy(*by, "le").agg(F.count("*").alias("n"))


def rpc_health_report(payloads: DataFrame, elapsed_s: float) -> DataFrame:
    """Totals, errors, rates and means of payload samples(error, receipts, logs, payload_kb, queue_wait_ms)."""
    ok = ~F.col("error")
    per = lambda c: c / F.nullif(F.lit(float(elapsed_s)), F.lit(0.0))
    return payloads.agg(
        F.count("*").alias("requests"), F.count_if("error").alias("errors"), per(F.count("*")).alias("requests_per_s"), per(F.sum(F.when(ok, F.col("receipts")))).alias("receipts_per_s"), per(F.sum(F.when(ok, F.col("logs")))).alias("logs_per_s"),
        per(F.sum(F.when(ok, F.col("payload_kb"))) / 1024).alias("mb_per_s"), F.avg(F.when(ok, F.col("receipts"))).alias("avg_receipts"), F.avg(F.when(ok, F.col("logs"))).alias("avg_logs"), F.avg(F.when(ok, F.col("payload_kb"))).alias("avg_payload_kb"),
        F.avg("queue_wait_ms").alias("avg_wait_ms"),
    )


def head_first_seen(observations: DataFrame) -> DataFrame:
    """Per head: first sighting by websocket and by poll, and by how much the poll is later."""
    first = lambda source: F.min(F.when(F.col("source") == source, F.col("seen_ms")))
    out = observations.groupBy("head").agg(first("websocket").alias("websocket_ms"), first("poll").alias("poll_ms"))
    return out.withColumn("advantage_ms", F.col("poll_ms") - F.col("websocket_ms"))


def head_age(observations: DataFrame, blocks: DataFrame) -> DataFrame:
    """observations(head, seen_ms) with age_ms against the block's timestamp; NULL for unknown blocks, which are joined by sorting, however few Spark expects."""
    own = blocks.select(F.col("number").alias("head"), F.col("timestamp").alias("__t"))
    return observations.join(own.hint("merge"), "head", "left").withColumn("age_ms", F.col("seen_ms") - F.col("__t") * 1000).drop("__t")


def progress_snapshot(samples: DataFrame, start: int, end: int, elapsed_s: float) -> DataFrame:
    """Progress, rate, time left and latency figures of a bounded run."""
    total = float(end - start + 1)
    out = samples.agg(F.count("*").alias("done"), F.avg("latency_ms").alias("avg_ms"), F.min("latency_ms").alias("min_ms"), F.max("latency_ms").alias("max_ms"))
    out = out.withColumn("p95_ms", F.lit(exact_percentiles(samples, "latency_ms", [0.95])[0]).cast("double"))
    rate = F.col("done") / F.nullif(F.lit(float(elapsed_s)), F.lit(0.0))
    left = F.greatest(F.lit(total) - F.col("done"), F.lit(0.0))
    return out.withColumns({"progress": F.least(F.col("done") / total, F.lit(1.0)), "rate": rate, "remaining": left, "eta_s": left / F.nullif(rate, F.lit(0.0))})


def payload_stats(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per cursor: receipts, logs and serialized KB of a receipts payload, with columns of raw that are to be kept."""
    r = raw.withColumn("r", F.from_json("result", "array<struct<logs:array<string>>>"))
    logs = F.aggregate("r", F.lit(0), lambda n, x: n + F.coalesce(F.size(x["logs"]), F.lit(0)))
    return r.select("cursor", *keep, F.size("r").cast("long").alias("receipts"), logs.cast("long").alias("logs"), (F.octet_length("result") / 1024).alias("payload_kb"))


def rolling_messages(samples: DataFrame, seconds: int = 60, time: str = "completed_s", by: list[str] | None = None, block: int = 86_400) -> DataFrame:
    """samples with the messages of the trailing seconds, this one's included; without messages 0 is added.

    Each block of time also gets the messages of the seconds before it, summed by second, so that no window holds more than a block's rows.
    """
    by, block = by or [], max(block, seconds)
    rows = samples.withColumn("__block", F.floor(F.col(time) / block))
    own = rows.select("*", F.lit(True).alias("__own"))
    tail = rows.groupBy(*by, "__block", time).agg(F.sum("messages").alias("messages"))
    tail = tail.where(F.col(time) >= (F.col("__block") + 1) * block - seconds).withColumns({"__block": F.col("__block") + 1, "__own": F.lit(False)})
    w = Window.partitionBy(*by, "__block").orderBy(time).rangeBetween(-seconds, 0)
    both = own.unionByName(tail, allowMissingColumns=True).withColumn("rolling_messages", F.sum("messages").over(w))
    return both.where("__own").select(*samples.columns, "rolling_messages")


def top_by(samples: DataFrame, value: str, k: int, tie: str = "cursor") -> DataFrame:
    """The k largest by value, ties by the smaller cursor."""
    return samples.orderBy(F.desc(value), tie).limit(k)


def recent(samples: DataFrame, n: int, order: str) -> DataFrame:
    """The last n by order."""
    return samples.orderBy(F.desc(order)).limit(n)


def message_deltas(totals: DataFrame, order: str, by: list[str] | None = None, block: int = 1_000_000) -> DataFrame:
    """totals with the growth since the row before, never negative; the first row's is its total. order is a number, `block` of which make a window."""
    by = by or []
    rows = totals.withColumn("__block", F.floor(F.col(order) / block))
    blocks = rows.groupBy(*by, "__block").agg(F.max_by("total", order).alias("__last"))
    blocks = blocks.withColumn("__earlier", F.lag("__last").over(Window.partitionBy(*by).orderBy("__block"))).drop("__last")
    within = F.lag("total").over(Window.partitionBy(*by, "__block").orderBy(order))
    first = F.row_number().over(Window.partitionBy(*by, "__block").orderBy(order)) == 1
    joined = rows.withColumns({"__within": within, "__first": first}).join(blocks, [*by, "__block"], "left")
    before = F.when(F.col("__first"), F.col("__earlier")).otherwise(F.col("__within"))
    return joined.withColumn("delta", F.greatest(F.col("total") - F.coalesce(before, F.lit(0)), F.lit(0))).select(*totals.columns, "delta")


def logs_with_samples(logs: DataFrame, samples: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """The last n info log lines with the sample of their cursor (NULL where there is none)."""
    last = recent(logs.where("level = 'info'"), n, order)
    return last.join(samples.select("cursor", "event_to_append_ms"), "cursor", "left")
