"""Sinks, streaming jobs and registered queries."""

import importlib.util
import json
import random
import time

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerframe import sinks
from ledgerframe.operators import dlq, enrich, parse
from ledgerframe.operators.progress import contiguous_watermark, emit_cursors, head_progress
from ledgerframe.plans import ingest, registry
from ledgerframe.sources import raw as raws, views
from ledgerframe.streaming import heads, jobs, retry, watermark

SF = "/root/testdata/sf0.001"
FEW = ("transfer_totals", "p1_p11_p13_hex", "w1_contiguous_watermark", "d4_d6_retry_states", "a4_percentile_floor")


@pytest.mark.parametrize("name", FEW)
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    df = registry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, cur.fetchall()))


def test_entry(spark):
    assert entry.entry(spark).count() == 3
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and set(registry.queries()) <= names
    if importlib.util.find_spec("ledgerframe.llm") is None:
        assert names == set(registry.queries())


def payloads(spark):
    blocks, receipts = views.raw_blocks(spark, SF), views.raw_receipts(spark, SF)
    both = blocks.unionByName(receipts).where(F.col("cursor") < views.BASE + 60)
    fail = (F.col("cursor") % 10 == 3) & (F.col("method") == "eth_getBlockReceipts")
    return both.withColumns({"error": F.when(fail, '{"code":1,"message":"busy"}'), "result": F.when(~fail, F.col("result"))})


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_failed_cursors_give_nothing(spark):
    bundle, failures = ingest.ingest(payloads(spark), ["block", "transaction", "log", "token_transfer"])
    assert {r["cursor"] % 10 for r in failures.collect()} == {3}
    for df in bundle.values():
        assert df.where(F.col("cursor") % 10 == 3).count() == 0 and df.count() == df.select("id").distinct().count() > 0
    only, _ = ingest.ingest(payloads(spark), ["block"])
    assert list(only) == ["block"]


@pytest.mark.parametrize("exactly_once", [True, False])
def test_stream_equals_batch(spark, tmp_path, exactly_once):
    """Blocks and receipts of a cursor come in different files, so in different micro-batches; one receipt payload never comes."""
    rows = payloads(spark).where(~((F.col("cursor") == views.BASE + 41) & (F.col("method") == "eth_getBlockReceipts")))
    for method in ("eth_getBlockByNumber", "eth_getBlockReceipts"):
        for odd in (0, 1):
            rows.where((F.col("method") == method) & (F.col("cursor") % 2 == odd)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    seen = []
    stream = raws.read_raw(spark, f"{tmp_path}/raw", stream=True, max_files=1)
    first = rows.agg(F.min("cursor")).first()[0]
    jobs.stream_ingest(stream, ["block", "log", "token_transfer"], f"{tmp_path}/out", f"{tmp_path}/ck", exactly_once, after=lambda n, df: seen.append(n), initial=first - 1, now_ms=lambda: 7).awaitTermination()
    assert len(seen) >= 4
    bundle, failures = ingest.ingest(rows.where(F.col("cursor") != views.BASE + 41), ["block", "log", "token_transfer"])
    read = lambda name, schema: sinks.read_committed(spark, f"{tmp_path}/out", name, schema) if exactly_once else spark.read.schema(schema).parquet(f"{tmp_path}/out/{name}")
    for entity, df in bundle.items():
        own = "id string, cursor bigint, block_hash string, block_timestamp bigint" if entity != "block" else "id string, cursor bigint"
        columns = [c.split()[0] for c in own.split(", ")]
        assert sorted(map(tuple, read(entity, own).select(columns).collect())) == sorted(map(tuple, df.select(columns).collect()))
    assert {r["cursor"] for r in read("failures", "cursor bigint").collect()} == {r["cursor"] for r in failures.collect()} != set()
    # The watermark stands below the first failed cursor; gap rows are the failed ones and those past the next expected one.
    last = max(seen)
    mark = sinks.read_committed(spark, f"{tmp_path}/out", "marks", jobs.MARK).where(F.col("batch_id") == last).collect()[0]["watermark"]
    failed = {r["cursor"] for r in failures.collect()}
    assert mark == min(failed | {views.BASE + 41}) - 1
    gaps = sinks.read_committed(spark, f"{tmp_path}/out", "gaps", "cursor bigint, status string, error string").collect()
    assert {r["cursor"] for r in gaps if r["status"] == "failed"} == failed and all(r["error"] for r in gaps if r["status"] == "failed")
    held = sinks.read_committed(spark, f"{tmp_path}/out", "pending", jobs.PENDING).collect()
    assert {r["cursor"] for r in held} == {views.BASE + 41} and {r["batch_id"] for r in held} == {last}
    rows = sinks.read_committed(spark, f"{tmp_path}/out", "waiting", raws.RAW_SCHEMA, {r["at"] for r in held}).where(F.col("cursor") == views.BASE + 41)
    assert rows.count() == len(held)


def test_nothing_moves_after_parsing(spark, tmp_path):
    """Each method's JSON is parsed once; no branch of the bundle parses, joins or exchanges anything again."""
    payloads(spark).write.parquet(f"{tmp_path}/raw")
    raw = raws.read_raw(spark, f"{tmp_path}/raw")
    wide = ingest.by_cursor(raw, ["block", "transaction", "receipt", "log"], True)
    assert wide.count() == wide.select("cursor").distinct().count() == 60
    bundle, _ = ingest.ingest(raw, ["block", "transaction", "log", "token_transfer"])
    for df in bundle.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Exchange", "Join", "from_json", "method#", "Python"))


def test_pairs_within_cursors_equal_joins(spark):
    """Receipts of transactions and contexts of logs are those of the joins, with repeated and missing hashes and blocks of one number."""
    block = {"number": "0x5", "hash": "0xb2", "parentHash": "0x0", "timestamp": "0x9", "transactions": [{"hash": h} for h in ("0x1", "0x2", "0x3", None)]}
    other = {"number": "0x5", "hash": "0xb1", "parentHash": "0x0", "timestamp": "0x8", "transactions": []}
    receipt = lambda h, gas, number="0x5": {"transactionHash": h, "blockNumber": number, "blockHash": "0xold", "transactionIndex": "0x0", "gasUsed": gas, "status": "0x1", "logs": [{"logIndex": "0x0", "transactionHash": h, "transactionIndex": "0x0", "blockHash": "0xold", "blockNumber": number, "address": "0xa", "data": "0x", "topics": []}]}
    receipts = [receipt("0x1", "0x1"), receipt("0x2", "0x2"), receipt("0x1", "0x3"), receipt(None, "0x4"), receipt("0x9", "0x5", "0x6")]
    method = views.METHODS
    rows = [(1, "eth_getBlockByNumber", json.dumps(block)), (1, "eth_getBlockByNumber", json.dumps(other)), (1, "eth_getBlockReceipts", json.dumps(receipts)), (2, "eth_getBlockByNumber", json.dumps(block)), (2, "eth_getBlockReceipts", "[]")]
    raw = spark.createDataFrame([(*r, None) for r in rows], "cursor long, method string, result string, error string")
    assert method
    bundle, failures = ingest.ingest(raw, ["block", "transaction", "log"])
    assert failures.collect() == []
    blocks, txs = parse.parse_blocks(raw.where("method = 'eth_getBlockByNumber'")), parse.parse_transactions(raw.where("method = 'eth_getBlockByNumber'"))
    own = raw.where("method = 'eth_getBlockReceipts'")
    want = enrich.enrich_transactions(txs, parse.parse_receipts(own))
    assert sorted(map(str, bundle["transaction"].select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert {r["hash"]: r["receipt_gas_used"] for r in bundle["transaction"].where("cursor = 1").collect()} == {"0x1": 3, "0x2": 2, "0x3": None, None: None}
    logs = enrich.inject_block_context(parse.parse_logs(own), blocks)
    assert sorted(map(str, bundle["log"].select(logs.columns).collect())) == sorted(map(str, logs.collect()))
    assert {(r["block_number"], r["block_hash"], r["block_timestamp"]) for r in logs.collect()} == {(5, "0xb1", 8), (6, "0xold", None)}


def test_own_parser_is_used(spark):
    from ledgerframe.operators import parse

    try:
        parse.register_parser("Block", lambda raw: parse.parse_blocks(raw).withColumn("miner", F.lit("mine")))
        bundle, _ = ingest.ingest(payloads(spark), ["block", "log"])
        assert {r["miner"] for r in bundle["block"].select("miner").distinct().collect()} == {"mine"} and bundle["log"].count() > 0
    finally:
        parse.register_parser("block", parse.parse_blocks)


TRACE = views.METHODS["trace"]
CALL = '[{"txHash":"0x%d","result":{"type":"CALL","from":"0xa","to":"0xb","value":"0x1","gas":"0x1","gasUsed":"0x1"}}]'


def test_long_stream_stays_small(spark, tmp_path):
    """Six micro-batches with late and missing payloads: folders, entries and manifests stay few, and the result is that of the batch plan."""
    blocks = views.raw_blocks(spark, SF).where(F.col("cursor") < views.BASE + 200).withColumn("error", F.lit(None).cast("string"))
    cursors = sorted(r["cursor"] for r in blocks.select("cursor").collect())
    never = cursors[3]
    traces = spark.createDataFrame([(c, TRACE, CALL % c, None) for c in cursors if c != never], "cursor long, method string, result string, error string")
    place = {c: k for k, c in enumerate(cursors)}
    files = [[] for _ in range(6)]
    for c in cursors:
        files[place[c] * 3 // len(cursors)].append((c, "block"))
        if c != never:
            files[place[c] * 3 // len(cursors) + place[c] % 4].append((c, "trace"))
    for own in files:
        picked = [c for c, kind in own if kind == "block"], [c for c, kind in own if kind == "trace"]
        part = blocks.where(F.col("cursor").isin(picked[0])).unionByName(traces.where(F.col("cursor").isin(picked[1])), allowMissingColumns=True)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    clock = iter(range(0, 1_000_000, 1000))
    stream = raws.read_raw(spark, f"{tmp_path}/raw", stream=True, max_files=1)
    base = f"{tmp_path}/out"
    jobs.stream_ingest(stream, ["block", "trace"], base, f"{tmp_path}/ck", initial=cursors[0] - 1, now_ms=lambda: next(clock), timeout_ms=4000, merge=2).awaitTermination()
    m = sinks.manifest(spark, base)
    assert m["batch_id"] == 5
    assert all(len(m["live"][t]) == 1 for t in ("state", "marks", "pending")) and len(m["live"]["waiting"]) <= 4
    assert all(len(m["live"][t]) <= 6 for t in ("block", "trace", "failures", "gaps"))
    for t in m["live"]:
        assert len(sinks.storage.children(spark, f"{base}/{t}")) <= 20
    assert len(sinks.storage.children(spark, f"{base}/_manifest")) <= 30
    whole = [c for c in cursors if c != never]
    for entity in ("block", "trace"):
        got = sinks.read_committed(spark, base, entity, "id string, cursor bigint").collect()
        assert sorted(r["cursor"] for r in got) == whole and len({r["id"] for r in got}) == len(got)
    failures = sinks.read_committed(spark, base, "failures", "cursor bigint, entity string, error_type string, error_message string").collect()
    assert [(r["cursor"], r["entity"], r["error_type"]) for r in failures] == [(never, "trace", "TimeoutError")] and TRACE in failures[0]["error_message"]
    gap = sinks.read_latest(spark, base, "gaps", "identity string, cursor bigint, status string", ["identity", "cursor"]).where(F.col("cursor") == never).collect()
    assert [r["status"] for r in gap] == ["failed"]
    assert sinks.read_committed(spark, base, "marks", jobs.MARK).collect()[0]["watermark"] == never - 1
    assert sinks.read_committed(spark, base, "pending", jobs.PENDING).count() == 0
    state = sinks.read_committed(spark, base, "state", jobs.SPANS).collect()
    assert len([r for r in state if r["status"] == "failed"]) == 1 and sum(r["hi"] - r["lo"] + 1 for r in state if r["status"] == "completed") == len(cursors) - 4


def test_advance_equals_whole_state(spark):
    """Spans carried from batch to batch give the watermarks and open cursors of all rows at once, with repairs, for any split."""
    rng = random.Random(11)
    for initial in (None, 9):
        state, mark = spark.createDataFrame([], jobs.SPANS), spark.createDataFrame([], jobs.MARK)
        told = {}
        for turn in range(5):
            rows = []
            for i in "ab":
                for c in rng.sample(range(10, 40), 9):
                    status = rng.choice(["completed", "completed", "failed"])
                    rows.append((i, c, status, turn * 10 + 1))
            repairs = [(i, c, "completed", turn * 10 + 2) for (i, c), v in list(told.items()) if v == "failed" and rng.random() < 0.3]
            low = {r["identity"]: r["watermark"] for r in mark.collect()}
            for i, c, status, _ in rows:
                if low.get(i) is None or c > low[i]:
                    told[i, c] = "completed" if "completed" in (status, told.get((i, c))) else "failed"
            for i, c, _, _ in repairs:
                if not any(r[:3] == (i, c, "failed") and r[3] > turn * 10 + 2 for r in rows):
                    told[i, c] = "completed"
            state, mark = jobs.advance(state, spark.createDataFrame(rows, jobs.STATE), mark, initial, spark.createDataFrame(repairs, jobs.STATE))
            for i in "ab":
                own = {c: v for (j, c), v in told.items() if j == i}
                start = low.get(i) if low.get(i) is not None else initial if initial is not None else min(own) - 1
                end = start
                while own.get(end + 1) == "completed":
                    end += 1
                want = None if end == start and low.get(i) is None and initial is None else end
                assert {r["identity"]: r["watermark"] for r in mark.collect()}[i] == want
                held = state.where(F.col("identity") == i).collect()
                assert {c for r in held if r["status"] == "completed" for c in range(r["lo"], r["hi"] + 1) if c > end} == {c for c, v in own.items() if v == "completed" and c > end}
                assert {r["lo"] for r in held if r["status"] == "failed"} == {c for c, v in own.items() if v == "failed" and c > end}


def test_stream_watermark(spark, tmp_path, monkeypatch):
    """Over random batches of three identities, with repairs as a stream of their own, the marks are those of all rows at once."""
    monkeypatch.setattr(watermark, "BLOCK", 8)
    rng = random.Random(4)
    rows, repairs = [], []
    for i, n in (("a", 150), ("b", 60), ("c", 90)):
        for c in range(100, 100 + n):
            failed = rng.random() < 0.15
            rows.append((i, c, "failed" if failed else "completed", 1000 + c))
            if failed and rng.random() < 0.7:
                repairs.append((i, c, "completed", 1001 + c))
            if rng.random() < 0.1:
                rows.append((i, c, "failed", 2000 + c) if not failed else (i, c, "failed", 500 + c))
    rows += [("late", c, "completed", 1) for c in (7, 9, 5, 6)]
    rng.shuffle(rows)
    for k in range(12):
        own = rows[k::12]
        spark.createDataFrame(own, jobs.STATE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/state")
    spark.createDataFrame([("a", 1, "failed", 0)], jobs.STATE).where("cursor < 0").write.parquet(f"{tmp_path}/repairs")
    read = lambda name: spark.readStream.schema(jobs.STATE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
    run = lambda initial, to: jobs.stream_watermark(read("state"), f"{tmp_path}/{to}", f"{tmp_path}/ck{to}", initial, read("repairs"), merge=4).awaitTermination()
    marks = lambda to: {tuple(r) for r in sinks.read_latest(spark, f"{tmp_path}/{to}", "marks", "identity string, watermark bigint", ["identity"]).select("identity", "watermark").collect()}
    state = spark.createDataFrame(rows, jobs.STATE)
    run(99, "out")
    assert marks("out") == {tuple(r) for r in contiguous_watermark(state.where("identity <> 'late'"), 99).collect()} | {("late", 99)}
    spark.createDataFrame(repairs, jobs.STATE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/repairs")
    run(99, "out")  # goes on from the checkpoint: only the repairs are new
    fixed = state.unionByName(spark.createDataFrame(repairs, jobs.STATE))
    newest = {}
    for i, c, s, v in rows:
        newest[i, c] = max(newest.get((i, c), (0, "")), (v, s))
    taken = spark.createDataFrame([r for r in repairs if (r[3], r[2]) > newest[r[0], r[1]]], jobs.STATE)
    assert marks("out") == {tuple(r) for r in contiguous_watermark(state.unionByName(taken).where("identity <> 'late'"), 99).collect()} | {("late", 99)}
    assert fixed.count() > taken.count() > 0
    live = sinks.manifest(spark, f"{tmp_path}/out")["live"]["marks"]
    assert len(live) <= 8
    with pytest.raises(Exception, match="another stream"):
        jobs.stream_watermark(read("state"), f"{tmp_path}/out", f"{tmp_path}/ckother", 99).awaitTermination()


def test_watermark_blocks():
    """Spans of a block join, close open cursors, and are found by cursor."""
    held = watermark.Held(None)
    for lo, hi in ((5, 5), (1, 2), (9, 12), (3, 4), (20, 20)):
        held.complete(lo, hi)
    held.open = {30: (1, "failed"), 14: (1, "failed")}
    held.complete(13, 19)
    assert held.spans == [[1, 5], [9, 20]] and held.open == {30: (1, "failed")}
    assert held.covering(10) == [9, 20] and held.covering(7) is None and held.covering(21) is None and held.covering(1) == [1, 5]
    assert watermark.Held(held.text()).spans == held.spans and watermark.Held(None).text() is None


def test_compaction_and_retention(spark, tmp_path):
    """A key's last row survives merging, a snapshot opens one folder, and what no late manifest names is deleted."""
    base = str(tmp_path)
    for n in range(40):
        rows = spark.createDataFrame([(n % 7, n), (100, n)], "k long, v long")
        sinks.commit_batch({"log": rows, "snap": rows}, base, n, ("snap",))
        if n % 4 == 3:
            sinks.compact(spark, base, "log", ["k"], 4)
    assert sinks.read_committed(spark, base, "snap", "k long, v long").select("v").distinct().collect()[0][0] == 39
    assert len(sinks.manifest(spark, base)["live"]["snap"]) == 1
    want = {n % 7: n for n in range(40)} | {100: 39}
    assert {r["k"]: r["v"] for r in sinks.read_latest(spark, base, "log", "k long, v long", ["k"]).collect()} == want
    assert len(sinks.manifest(spark, base)["live"]["log"]) <= 12
    sinks.retire(spark, base, 2)
    assert len(sinks.storage.children(spark, f"{base}/snap")) <= 2 and len(sinks.storage.children(spark, f"{base}/_manifest")) == 2
    # A crash after the data and before the manifest changes nothing, and the next attempt takes the batch's place.
    spark.createDataFrame([(1, 99)], "k long, v long").withColumn("batch_id", F.lit(40).cast("bigint")).write.parquet(f"{base}/log/b000000000040-dead")
    assert {r["k"]: r["v"] for r in sinks.read_latest(spark, base, "log", "k long, v long", ["k"]).collect()} == want
    for v in (1, 2):
        sinks.commit_batch({"log": spark.createDataFrame([(1, v)], "k long, v long")}, base, 40)
    assert sinks.read_committed(spark, base, "log", "k long, v long").where("batch_id = 40").collect()[0]["v"] == 2


def test_commit_is_atomic(spark, tmp_path):
    base, rows = str(tmp_path), spark.range(3).select(F.col("id").cast("string"))
    sinks.commit_batch({"a": rows, "b": rows}, base, 0)
    sinks.commit_batch({"a": rows}, base, 0)  # the same batch again
    rows.write.parquet(f"{base}/a/batch_id=1")  # an attempt that never committed
    assert sinks.read_committed(spark, base, "a", "id string").count() == 3


def test_small_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("1", None, "t"), ("2", 5, "t")], "key string, x long, topic string")
    m = sinks.to_message(rows)
    assert [r["value"] for r in m.orderBy("key").collect()] == ['{"x":null}', '{"x":5}']
    assert sinks.count_sink(m) == {"messages": 2, "bytes": 17} and sinks.topic_counts(m).first()["messages"] == 2
    assert sinks.write_fanout({"a": rows, "b": rows.limit(0), "c": rows}, str(tmp_path), ["a", "b"]) == ["a"]
    sinks.write_jsonl(rows, f"{tmp_path}/j")
    sinks.write_jsonl(rows, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 4


def test_stream_dedupe(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:00:00")], "id string, t string").withColumn("t", F.col("t").cast("timestamp"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id string, t timestamp").parquet(f"{tmp_path}/in")
    q = jobs.limits(jobs.stream_dedupe(stream, "t").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck"), backfill=True).start()
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_replay_resolves_only_what_worked(spark):
    """Cursor 1 is whole, 2 is no list, 3 is an RPC error, 4 has no raw row, 5 has one of another method only."""
    root = '[{"txHash":"0x1","result":{"type":"CALL","from":"0xa","to":"0xb","value":"0x1","gas":"0x1","gasUsed":"0x1"}}]'
    trace = views.METHODS["trace"]
    rows = [(1, trace, root, None), (2, trace, root[1:-1], None), (3, trace, None, '{"code":-32000,"message":"boom"}'), (5, "eth_getBlockReceipts", "[]", None), (9, trace, root, None)]
    raw = spark.createDataFrame(rows, "cursor long, method string, result string, error string")
    fields = "id long, seq long, status string, entity string, stage string, cursor long, next_retry_at long, last_attempt_at long, ingest_timestamp long"
    log = spark.createDataFrame([(10 + c, c, "failed", "trace", "rpc", c, None, 0, 0) for c in range(1, 6)], fields)
    bundle, resolved = dlq.replay_job(log, raw, lambda x: ingest.ingest(x, ["trace"]), [trace], 77, entity="trace", stage="rpc")
    assert [(r["id"], r["status"], r["last_attempt_at"]) for r in resolved.collect()] == [(11, "resolved", 77)]
    assert {r["cursor"] for r in log.join(resolved, "id", "left_anti").collect()} == {2, 3, 4, 5}
    assert bundle["trace"].count() == 1


@pytest.mark.parametrize("name", ["d8_d11_replay_job", "d7_d10_retry_job", "d10_retry_gaps", "k4_merge_state", "k1_k2_checkpoint_rows", "j1_j3_enriched_transactions", "w3_head_progress", "a3_benchmark_summary"])
def test_state_machine_queries_match_oracles(spark, name):
    test_oracles(spark, name)


def test_stream_retry(spark, tmp_path):
    """Records run again when due and not before; one fails again and comes back with its next due time; states are those of the batch job."""
    now = int(time.time() * 1000)
    later = now + 25_000
    fields = "id string, cursor long, entity string, stage string, status string, retry_count long, max_retry long, next_retry_at long, last_attempt_at long, ingest_timestamp long, error_type string, error_message string, context string"
    one = lambda i, c, status="pending", n=0, due=None, most=3: (i, c, "trace", "rpc", status, n, most, due, now - 1000, now - 1000, "E", "old", "{}")
    rows = [one("ok", 1), one("bad", 2, due=now - 5), one("late", 3, due=later), one("far", 4, due=now + 10**8), one("spent", 5, "retrying", 3), one("done", 6, "resolved"), one("last", 7, "retrying", 2, now - 5)]
    log = spark.createDataFrame(rows, fields)
    log.coalesce(1).write.parquet(f"{tmp_path}/log/first")
    raw = spark.createDataFrame([(c, TRACE, CALL % c, None) for c in (1, 3, 4, 5, 6)] + [(2, TRACE, None, '{"code":1,"message":"boom"}')], "cursor long, method string, result string, error string")
    run = lambda x: ingest.ingest(x, ["trace"])
    source = spark.readStream.schema(fields).parquet(f"{tmp_path}/log/*")
    q = retry.stream_retry(source, lambda cursors: raw.join(cursors, "cursor", "left_semi"), run, [TRACE], f"{tmp_path}/out", f"{tmp_path}/log", f"{tmp_path}/ck", base_ms=3_600_000)
    told = lambda: {r["id"]: r for r in dlq.latest_by_key(spark.read.schema(fields).parquet(f"{tmp_path}/log/*"), ["id"], ["last_attempt_at"]).collect()}
    try:
        end = time.time() + 240
        while time.time() < end and q.exception() is None:
            states = told()
            if states["ok"]["status"] == "resolved" and int(time.time() * 1000) < later:
                assert states["late"]["status"] == "pending"
            if states["late"]["status"] == "resolved":
                break
            time.sleep(1)
        assert q.exception() is None
    finally:
        q.stop()
    states = told()
    assert {i: r["status"] for i, r in states.items()} == {"ok": "resolved", "bad": "retrying", "late": "resolved", "far": "pending", "spent": "retrying", "done": "resolved", "last": "failed"}
    assert states["late"]["last_attempt_at"] >= later and states["ok"]["last_attempt_at"] < states["late"]["last_attempt_at"]
    for i in ("ok", "bad", "last"):
        _, want, _ = dlq.retry_job(log.where(F.col("id") == i), raw, run, [TRACE], 3_600_000, states[i]["last_attempt_at"], "last_attempt_at")
        assert want.select(*log.columns).collect() == [states[i]]
    traces = sinks.read_committed(spark, f"{tmp_path}/out", "trace", "id string, cursor bigint").collect()
    assert sorted(r["cursor"] for r in traces) == [1, 3]


def test_rows_once_for_good(spark, tmp_path, monkeypatch):
    """A row that comes again many batches later is dropped, and a batch opens only the entries that may have its rows."""
    monkeypatch.setattr(jobs, "NEAR", 10)
    for n in range(24):
        own = [(f"r{n * 10 + k}", n * 10 + k, n) for k in range(10)] + [(f"r{n * 10}", n * 10, n)]
        late = [("r3", 3, n), ("r50", 50, n)] if n == 20 else [("none", None, n)] if n in (4, 22) else []
        spark.createDataFrame(own + late, "id string, cursor long, n long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    opened = []
    read = sinks.read_committed

    def counted(*args, **kw):
        out = read(*args, **kw)
        opened.append(len({f.split("/")[-2] for f in out.inputFiles()}))
        return out

    monkeypatch.setattr(jobs, "read_committed", counted)
    stream = spark.readStream.schema("id string, cursor long, n long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    jobs.stream_once(stream, f"{tmp_path}/out", "rows", f"{tmp_path}/ck", merge=4).awaitTermination()
    got = read(spark, f"{tmp_path}/out", "rows", "id string, cursor long, n long").collect()
    assert len(got) == 241 and len({r["id"] for r in got}) == 241
    assert {r["id"]: r["n"] for r in got if r["id"] in ("r3", "r50", "none")} == {"r3": 0, "r50": 5, "none": 4}
    live = sinks.manifest(spark, f"{tmp_path}/out")["live"]["rows"]
    assert len(live) <= 9 and sorted(opened)[len(opened) // 2] <= 2


@pytest.mark.parametrize("start", ["chainhead", 105])
def test_cursors_of_a_stream_of_heads(spark, tmp_path, start):
    """However the observations are split into micro-batches, the cursors are those of all rows at once, and each comes once."""
    rng = random.Random(5)
    rows, high = [], {"a": 100, "b": 90, None: 120}
    for seq in range(300):
        k = rng.choice(list(high))
        high[k] += rng.choice([-3, 0, 1, 2, 4])
        rows.append((k, seq, high[k]))
    schema = "chain string, seq long, head long"
    odd = [("a", None, 999), ("b", 7, None), (None, None, None)]
    path = f"{tmp_path}/{start}"
    at = 0
    for n in (1, 130, 0, 169):
        spark.createDataFrame(rows[at : at + n] + odd, schema).repartition(3).write.mode("append").parquet(f"{path}/heads")
        stream = spark.readStream.schema(schema).parquet(f"{path}/heads")
        jobs.stream_cursors(stream, f"{path}/out", f"{path}/ck", start, key="chain", merge=2).awaitTermination()
        at += n
    got = [tuple(r) for r in sinks.read_committed(spark, f"{path}/out", "cursors", "chain string, seq long, cursor long").drop("batch_id").collect()]
    want = [tuple(r) for r in emit_cursors(spark.createDataFrame(rows, schema), start, key="chain").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len({(k, c) for k, _, c in got}) == len(got) > 50


def test_rises_within_a_batch(spark):
    """Rows that raise a head are those of the batch query; a floor takes away what isn't above it."""
    rng = random.Random(9)
    rows = [(rng.choice("ab"), seq, 50 + rng.randrange(seq // 2 + 1)) for seq in range(200)]
    df = spark.createDataFrame(rows, "own string, seq long, head long")
    want = {tuple(r) for r in head_progress(df, key="own").collect()}
    frame = df.toPandas().sample(frac=1, random_state=1)
    plain = lambda x: {(r.own, r.seq, r.head, None if r.previous is pd.NA else int(r.previous)) for r in x.itertuples(index=False)}
    assert plain(heads.rising(frame)) == want
    one = frame[frame["own"] == "a"]
    assert plain(heads.rising(one, 70)) == {(k, s, h, max(p or 70, 70)) for k, s, h, p in want if k == "a" and h > 70}
    assert not len(heads.rising(one, 10_000)) and not len(heads.rising(one.iloc[:0]))


@pytest.mark.parametrize("start", ["chainhead", 95])
def test_rises_are_committed_not_their_cursors(spark, tmp_path, start):
    """What a stream of heads writes grows with the heads; the cursors, made when it is read, are those of the batch query."""
    schema = "chain string, seq long, head long"
    rows = [(k, seq, 90 + 1000 * seq + ord(k)) for seq in range(40) for k in "ab"]
    for part in (rows[:30], rows[30:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{tmp_path}/heads")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/heads")
        jobs.stream_rises(stream, f"{tmp_path}/out", f"{tmp_path}/ck", key="chain", merge=2).awaitTermination()
    committed = sinks.read_committed(spark, f"{tmp_path}/out", "rises", "chain string, seq long, head long, previous long")
    assert committed.count() == len(rows)
    got = [tuple(r) for r in jobs.read_cursors(spark, f"{tmp_path}/out", start, key="chain", kind="string").collect()]
    want = [tuple(r) for r in emit_cursors(spark.createDataFrame(rows, schema), start, key="chain").collect()]
    assert sorted(got) == sorted(want) and len(got) > 78_000


def test_ingest_of_wanted_columns_has_the_rows_and_failures_of_all(spark, tmp_path):
    """Named columns are those of the whole bundle, row for row; what is not wanted doesn't go through the exchange."""
    sf = "/root/testdata/sf0.001"
    raw = views.raw_blocks(spark, sf).unionByName(views.raw_receipts(spark, sf))
    bad = F.when(F.col("cursor") % 7 == 0, F.lit('{"no":1}')).when(F.col("cursor") % 11 == 0, F.lit('[{"logs":[null,{"logIndex":"0x1"}]}]')).otherwise(F.col("result"))
    failed = F.when((F.col("cursor") % 13 == 0) & (F.col("method") == views.METHODS["receipt"]), F.lit('{"code":-32000,"message":"boom"}'))
    raw = raw.withColumns({"result": bad, "error": failed})
    asked = ["block", "transaction", "log", "token_transfer"]
    paths: list[str] = []
    mixed = ("id", "token_address", "amount", "source_log_id", "value", "block_hash", "topics", "receipt_status", "transaction_count")
    for check, wanted in ((True, ((), mixed)), (False, (("event_timestamp_ms",), ("block_hash", "transfer_type")))):
        whole, failures = ingest.ingest(raw, asked, check)
        told = sorted(map(str, failures.collect()))
        rows = {e: whole[e].select("cursor", *[c for c in whole[e].columns if c != "cursor" and c in {x for w in wanted for x in w}]).collect() for e in asked}
        for columns in wanted:
            few, failed = ingest.ingest(raw, asked, check, paths, columns)
            assert sorted(map(str, failed.collect())) == told
            for e in asked:
                assert few[e].columns == ["cursor", *[c for c in whole[e].columns if c in columns and c != "cursor"]]
                assert sorted(map(str, map(tuple, few[e].collect()))) == sorted(str(tuple(r[c] for c in few[e].columns)) for r in rows[e]), (e, columns)
    # The first table written holds no field of a transaction but its hash, and no data of a log but what transfers are decoded from.
    kinds = spark.read.parquet(paths[0]).schema.simpleString()
    assert "data:string" in kinds and "input" not in kinds and "address" not in kinds and "gasUsed" not in kinds
