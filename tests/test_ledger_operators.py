"""Golden cases and random round trips of the ledger operators."""

import json
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerframe import contracts
from ledgerframe.functions import hexabi
from ledgerframe.operators import decode, dlq, enrich, errors, identity, metrics, parse, profiles, progress
from ledgerframe.plans import entities
from ledgerframe.sources import views


def one(spark, column, **values):
    kinds = {k: "string" for k in values}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {v}" for k, v in kinds.items())) if values else spark.range(1)
    return df.select(column).first()[0]


def test_hex_round_trip(spark):
    rng = random.Random(7)
    values = [rng.getrandbits(rng.randrange(1, 257)) for _ in range(500)] + [0, 1, 10**18 - 1, 10**18, 2**60 - 1, 2**60, 2**63 - 1, 2**63, 2**256 - 1]
    df = spark.createDataFrame([(hex(x), str(x)) for x in values] + [("0x" + "0" * 80 + "ff", "255")], "h string, d string")
    assert df.where(~hexabi.hex_to_decimal_string(F.col("h")).eqNullSafe(F.col("d"))).count() == 0
    rows = df.select("d", hexabi.hex_to_long(F.col("h"))).collect()
    assert all(r[1] == (int(r[0]) if int(r[0]) < 2**63 else None) for r in rows)
    junk = spark.createDataFrame([(x,) for x in (None, "", "0x", "zz", "0x12zz", "-1", "0x1" + "0" * 64)], "h string")
    assert all(r == (None, None) for r in junk.select(hexabi.hex_to_long(F.col("h")), hexabi.hex_to_decimal_string(F.col("h"))).collect())


def word(x):
    return f"{x:064x}"


def plain_array(data, k):
    body = (data or "0x")[2:]
    head = body[64 * k : 64 * k + 64]
    if len(head) < 64 or int(head, 16) * 2 + 64 > len(body):
        return []
    at = int(head, 16) * 2
    out, n = [], int(body[at : at + 64], 16)
    while len(out) < n:
        at += 64
        try:
            one = int(body[at : at + 64], 16) if len(body) >= at + 64 else None
        except ValueError:
            one = None
        if one is None:
            break
        out.append(str(one))
    return out


def test_abi_uint_array(spark):
    rng = random.Random(3)
    cases = [
        "0x" + word(32) + word(2) + word(5) + word(2**255), "0x" + word(32) + word(5) + word(7), "0x" + word(32) + word(1) + "ab", "0x" + word(31) + word(1) + word(7), "0x" + word(2**64) + word(1),
        "0x" + word(32) + word(2**255) + word(9), "0x", None, "0x" + word(0), "0x" + word(32) + word(3) + word(1) + "zz" + word(2)[2:] + word(3),
    ]
    cases += ["0x" + "".join(word(rng.choice((0, 1, 2, 32, 64, 33, rng.getrandbits(256)))) for _ in range(rng.randrange(7))) + "ab" * rng.randrange(3) for _ in range(60)]
    df = spark.createDataFrame([(c,) for c in cases], "d string")
    for k in (0, 1):
        got = [r[0] for r in df.select(hexabi.abi_uint_array(hexabi.abi_digits(F.col("d")), k)).collect()]
        assert got == [plain_array(c, k) for c in cases]


def logs(spark, rows):
    return spark.createDataFrame(rows, "transaction_hash string, log_index long, address string, data string, topics array<string>, transaction_index long, block_hash string, block_number long")


def test_decode_kinds(spark):
    a, b = "0x" + "0" * 24 + "a" * 40, "0x" + "0" * 24 + "b" * 40
    rows = [
        ("0x1", 0, "0xc", "0x" + word(77), [decode.TRANSFER.upper().replace("0X", "0x"), a, b]),
        ("0x1", 1, "0xc", "0x", [decode.TRANSFER, a, b, "0x" + word(9)]),
        ("0x1", 2, "0xc", "0x", [decode.TRANSFER, a]),
        ("0x1", 3, "0xc", "0x", [decode.TRANSFER, a, b]),
        ("0x1", 4, "0xc", "0x" + word(3) + word(4), [decode.SINGLE, a, a, b]),
        ("0x1", 5, "0xc", "0x" + word(64) + word(160) + word(2) + word(1) + word(2) + word(2) + word(10) + word(20), [decode.BATCH + "0" * 56, a, a, b]),
        ("0x1", 6, "0xc", "0x" + word(64) + word(160) + word(2) + word(1) + word(2) + word(1) + word(10), [decode.BATCH + "0" * 56, a, a, b]),
        ("0x1", 7, "0xc", "0x", ["0x" + "9" * 64]),
        ("0x1", 8, "0xc", "0x", []),
        ("0x1", 9, "0xc", "0x", None),
        (None, 10, "0xc", "0x" + word(1), [decode.TRANSFER, a, b]),
    ]
    got = decode.decode_token_transfers(logs(spark, [(*r, 0, "0xb", 5) for r in rows])).orderBy("log_index", "transfer_index").collect()
    assert [(r["log_index"], r["transfer_type"], r["token_id"], r["amount"], r["transfer_index"]) for r in got] == [
        (0, "erc20", None, "77", None), (1, "erc721", "9", "1", None), (2, "unknown", None, None, None), (3, "erc20", None, None, None), (4, "erc1155", "3", "4", None),
        (5, "erc1155", "1", "10", 0), (5, "erc1155", "2", "20", 1), (10, "erc20", None, "1", None),
    ]
    assert got[0]["from_address"] == "0x" + "a" * 40 and got[0]["to_address"] == "0x" + "b" * 40 and got[4]["from_address"] == "0x" + "a" * 40
    assert got[0]["id"] == "token_transfer_0x1_0" and got[6]["id"] == "token_transfer_0x1_5_1" and got[0]["source_log_id"] == "log_0x1_0" and got[7]["id"] is None


def test_names_of_either_kind(spark):
    df = spark.createDataFrame([("0x1", "7", "12", ["a"])], "transactionHash string, logIndex string, blockNumber string, topics array<string>")
    r = parse.coalesce_names(df).first()
    assert (r["transaction_hash"], r["log_index"], r["block_number"]) == ("0x1", 7, 12)


def test_block_defaults(spark):
    block = {"number": "0x1", "hash": "0xa", "parentHash": "0x0", "size": None, "transactions": ["0x1", "0x2"], "withdrawals": [{"index": "0x1"}]}
    r = parse.parse_blocks(spark.createDataFrame([(1, json.dumps(block))], "cursor long, result string")).first()
    assert r["size"] is None and r["difficulty"] == "0" and r["gas_used"] == 0 and r["transaction_count"] == 2 and json.loads(r["withdrawals"]) == [{"index": "0x1"}] and r["base_fee_per_gas"] is None


def test_deep_call_tree(spark):
    call = {"type": "CALL", "value": "0x1"}
    for _ in range(9):
        call = {"type": "CALL", "from": "0xf", "calls": [{"type": "STATICCALL"}, call]}
    raw = spark.createDataFrame([(5, json.dumps([{"txHash": "0xt", "result": call}, {"txHash": "0xu", "result": None}, {"transactionHash": "0xw", "result": {"type": "CREATE"}}]))], "cursor long, result string")
    rows = {r["trace_id"]: r for r in parse.parse_traces(raw, "debug_trace").collect()}
    assert len(rows) == 20 and rows["0xt_root"]["subtraces"] == 2 and rows["0xw_root"]["call_type"] == "CREATE"
    deep = rows["0xt_" + "_".join("1" * 9)]
    assert deep["depth"] == 9 and deep["value"] == "1" and deep["parent_trace_id"] == "0xt_" + "_".join("1" * 8)
    with pytest.raises(ValueError):
        parse.parse_traces(raw, "other")


def test_enrichment(spark):
    tx = spark.createDataFrame([("0x1", 1), (None, 2), ("0x3", 3)], "hash string, block_number long")
    receipts = spark.createDataFrame([("0x1", 0, 1, 21000), ("0x1", 1, 0, 5), (None, 0, 1, 1)], "transaction_hash string, transaction_index long, status long, gas_used long")
    out = {r["block_number"]: r for r in enrich.enrich_transactions(tx, receipts).collect()}
    assert len(out) == 3 and out[1]["receipt_gas_used"] == 5 and out[2]["receipt_status"] is None and "transaction_hash" not in out[1].asDict()
    rows = spark.createDataFrame([(1, "mine", 7), (9, "mine", 7)], "block_number long, block_hash string, block_timestamp long")
    blocks = spark.createDataFrame([(1, "0xb", None)], "number long, hash string, timestamp long")
    got = {r["block_number"]: (r["block_hash"], r["block_timestamp"]) for r in enrich.inject_block_context(rows, blocks).collect()}
    assert got == {1: ("0xb", None), 9: ("mine", 7)}


def state(spark, rows):
    return spark.createDataFrame([("p", c, s, t) for c, s, t in rows], "identity string, cursor long, status string, updated_at_ms long")


def mark(spark, rows, initial=99, **kw):
    return progress.contiguous_watermark(state(spark, rows), initial, **kw).first()["watermark"]


def test_watermark_cases(spark):
    assert mark(spark, [(100, "completed", 1), (102, "completed", 1)]) == 100
    assert mark(spark, [(100, "completed", 1), (102, "completed", 1), (101, "completed", 2)]) == 102
    assert mark(spark, [(100, "failed", 1), (101, "completed", 1)]) == 99
    assert mark(spark, [(7, "completed", 1), (8, "completed", 1)], None) == 8
    assert mark(spark, [(7, "failed", 1)], None) is None
    assert mark(spark, [(c, "completed", 1) for c in range(100, 120)], block=5) == 119
    assert mark(spark, [(c, "completed", 1) for c in range(100, 110)], block=5) == 109


@pytest.mark.parametrize("seed", range(4))
def test_watermark_by_blocks(spark, seed):
    rng = random.Random(seed)
    rows = [(i, c) for i in range(30) for c in range(10, 10 + rng.randrange(1, 25)) if rng.random() > 0.06]
    df = spark.createDataFrame([(f"i{i}", c, "completed") for i, c in rows], "identity string, cursor long, status string")
    got = {r["identity"]: r["watermark"] for r in progress.contiguous_watermark(df, 9, block=4).collect()}
    for i in {i for i, _ in rows}:
        have, c = {c for j, c in rows if j == i}, 9
        while c + 1 in have:
            c += 1
        assert got[f"i{i}"] == c


def test_merge_and_gaps(spark):
    current, repair = state(spark, [(100, "failed", 5), (101, "completed", 5)]), state(spark, [(100, "completed", 6), (98, "completed", 6)])
    marks = spark.createDataFrame([("p", 99)], "identity string, watermark long")
    merged = progress.merge_state(current, repair, marks)
    assert {(r["cursor"], r["status"]) for r in merged.collect()} == {(100, "completed"), (101, "completed")}
    assert progress.contiguous_watermark(merged, 99).first()["watermark"] == 101
    g = progress.gap_metrics(current, marks, F.lit(105)).first()
    assert (g["commit_cursor"], g["gap_count"], g["oldest_gap"], g["commit_delay"]) == (99, 1, 100, 6)


def test_merge_takes_newer_versions_only(spark):
    marks = spark.createDataFrame([("p", 99)], "identity string, watermark long")
    merge = lambda own, other: {(r["cursor"], r["status"], r["updated_at_ms"]) for r in progress.merge_state(state(spark, own), state(spark, other), marks).collect()}
    assert merge([(100, "failed", 10)], [(100, "completed", 5)]) == {(100, "failed", 10)}
    assert merge([(100, "failed", 10)], [(100, "completed", 11), (100, "failed", 12)]) == {(100, "failed", 12)}
    assert merge([(100, "completed", 5)], [(100, "failed", 10)]) == {(100, "completed", 5)}
    assert merge([(100, "completed", 5), (100, "failed", 8)], []) == {(100, "completed", 5)} and merge([], [(101, "failed", 1)]) == {(101, "failed", 1)}


def test_state_rows_are_one_to_one(spark):
    me = {k: F.lit(k) for k in ("pipeline", "chain_uid", "chain_type", "network", "mode")} | {"entities": F.array(F.lit("log"))}
    rows = spark.createDataFrame([(7, "failed", "boom"), (7, "completed", None), (8, "failed", "x")], "cursor long, status string, error string")
    out = progress.state_rows(rows, me, 5).collect()
    assert sorted((r["cursor"], r["status"], r["error"]) for r in out if r["error"]) == [(7, "failed", "boom"), (8, "failed", "x")] and len(out) == 3


@pytest.mark.parametrize("block", [3, 1000])
def test_windows_by_blocks(spark, block):
    """Running maxima, differences and trailing sums over blocks are those of one window."""
    rng = random.Random(block)
    rows = [(s, rng.randrange(50), rng.randrange(90), rng.randrange(9)) for s in sorted(rng.sample(range(60), 40))]
    df = spark.createDataFrame(rows, "seq long, head long, total long, messages long")
    best, want = None, []
    for s, h, *_ in rows:
        if best is None or h > best:
            want.append((s, best))
            best = h
    assert [(r["seq"], r["previous"]) for r in progress.head_progress(df, block=block).orderBy("seq").collect()] == want
    deltas = [(rows[k][0], max(0, rows[k][2] - (rows[k - 1][2] if k else 0))) for k in range(len(rows))]
    assert [(r["seq"], r["delta"]) for r in metrics.message_deltas(df, "seq", block=block).orderBy("seq").collect()] == deltas
    sums = [(s, sum(m for t, _, _, m in rows if s - 5 <= t <= s)) for s, *_ in rows]
    assert [(r["seq"], r["rolling_messages"]) for r in metrics.rolling_messages(df, 5, time="seq", block=block).orderBy("seq").collect()] == sums
    lags = [(rows[k][0], rows[k][1] - max(r[2] for r in rows[: k + 1])) for k in range(len(rows))]
    lagged = progress.ingestion_lag(df.withColumn("cursor", F.col("total")), block=block).orderBy("seq").collect()
    assert [(r["seq"], r["ingestion_lag"]) for r in lagged] == lags


def test_exact_percentiles(spark):
    rng = random.Random(1)
    values = [rng.choice([1.0, 2.0, 1e9, rng.random(), rng.random() * 1e-9]) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in [*values, None]], "v double")
    shares = [0.0, 0.1, 0.5, 0.95, 1.0]
    want = df.agg(F.percentile("v", F.array(*map(F.lit, shares)))).first()[0]
    assert metrics.exact_percentiles(df, "v", shares, cells=8) == pytest.approx(want)
    assert metrics.exact_percentiles(df.limit(0), "v", shares) == [None] * 5


@pytest.mark.parametrize("values", [[1.0, 2.0, math.inf], [-math.inf, 1.0], [math.inf] * 3, [-math.inf, math.inf], [-1.7e308, 0.0, 1.7e308, 5e-324], [0.0, 5e-324], [1.0, 2.0, math.nan, math.inf, math.nan]])
def test_percentiles_of_extremes(spark, values):
    """Infinities, NaN and the widest and narrowest ranges end, with the values that sorting gives."""
    order = sorted(values, key=lambda x: (math.isnan(x), x if not math.isnan(x) else 0.0))
    shares = [k / (len(order) - 1) for k in range(len(order))] if len(order) > 1 else [0.5]
    got = metrics.exact_percentiles(spark.createDataFrame([(x,) for x in values], "v double"), "v", shares, cells=4)
    assert [str(x) for x in got] == [str(order[round(p * (len(order) - 1))]) for p in shares]


def test_ids_of_any_text(spark):
    """json_text is the ASCII JSON of Python's json module, and ids are digests over it."""
    texts = ["plain", "é", "😀𝄞", 'q"\\b', "".join(map(chr, range(1, 0x80))), "日本\u2028\uffff", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(dlq.json_text(F.col("t"))).collect()] == [json.dumps(t) for t in texts]
    row = {"chain": "c", "cursor": None, "entity": "log", "error_message": "naïve 😀", "error_type": "E", "first_seen_at": 5, "network": None, "pipeline": "p", "stage": "s"}
    one = spark.createDataFrame([tuple(row.values())], "chain string, cursor long, entity string, error_message string, error_type string, first_seen_at long, network string, pipeline string, stage string")
    want = hashlib.sha256(json.dumps(row, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:32]
    assert one.select(dlq.dlq_id(one)).collect()[0][0] == want


def test_trees_of_any_depth(spark):
    """Chains, bushes and wide trees give the rows that a plain walk gives, whatever pass opens them, and no Python runs for it."""
    chain = lambda n: {"type": "CALL", "value": hex(n), "input": {"k": [1, True]}} | ({"calls": [chain(n - 1)]} if n else {})
    wide = {"calls": [{"type": "A", "calls": [{"type": "B", "error": "x"}]} for _ in range(500)]}
    trees = {"t0": chain(30), "t1": wide, "t2": {"calls": [chain(30), chain(7), chain(8), {"gas": "0x9"}, None, chain(17)]}, "t3": chain(7), "t4": chain(8), "t5": {}}
    raw = spark.createDataFrame([(5, json.dumps([{"txHash": k, "result": t} for k, t in trees.items()]))], "cursor long, result string")
    want = []

    def walk(tx, call, path):
        call = call or {}
        calls = call.get("calls", [])
        said = json.dumps(call["input"], separators=(",", ":")) if "input" in call else None
        want.append((tx, path, call.get("type"), call.get("error"), said, str(int(call["value"], 16)) if "value" in call else None, len(calls)))
        for i, c in enumerate(calls):
            walk(tx, c, (*path, i))

    for k, t in trees.items():
        if t:
            walk(k, t, ())
    df = parse.flatten_call_tree(raw)
    got = [(r["transaction_hash"], tuple(r["trace_address"]), r["call_type"], r["error"], r["input"], r["value"], r["subtraces"]) for r in df.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert "Python" not in df._jdf.queryExecution().toString()


def test_heads_and_resume(spark):
    heads = spark.createDataFrame([(1, 105), (2, 105), (3, 106), (4, 107)], "seq long, head long")
    assert [r["cursor"] for r in progress.emit_cursors(heads, 103).orderBy("cursor").collect()] == [103, 104, 105, 106, 107]
    assert [r["cursor"] for r in progress.emit_cursors(heads).orderBy("cursor").collect()] == [105, 106, 107]
    assert progress.emit_cursors(heads, 110).count() == 0


def test_emitted_cursors_are_laid_out_for_writing(spark, tmp_path):
    """Each cursor once across the borders of spans, below zero too, and written rows cost a fraction of a byte however many keys there are."""
    few = spark.createDataFrame([("a", 1, -3000), ("a", 2, 2049), ("a", 3, 2048), ("a", 4, 2050), ("b", 1, 2**60), ("b", 2, 2**60 + 1500), ("c", 1, None)], "k string, seq long, head long")
    want = {("a", 1, -3000), *(("a", 2, c) for c in range(-2999, 2050)), ("a", 4, 2050), ("b", 1, 2**60), *(("b", 2, 2**60 + n) for n in range(1, 1501))}
    got = [tuple(r) for r in progress.emit_cursors(few, key="k").collect()]
    assert len(got) == len(want) and set(got) == want
    heads = spark.range(4000).select((F.col("id") % 200).alias("k"), F.col("id").alias("seq"), (F.floor(F.col("id") / 200) * 1500 + F.col("id") % 200 % 7).alias("head"))
    progress.emit_cursors(heads, key="k").write.parquet(f"{tmp_path}/cursors")
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    rows = spark.read.parquet(f"{tmp_path}/cursors")
    assert rows.count() == rows.distinct().count() == 200 * (19 * 1500 + 1)
    assert size < 0.5 * rows.count()
    assert [r["cursor"] for r in progress.cursor_range(spark, 10, 12).collect()] == [10, 11, 12]
    assert progress.resume_plan("backfill", 10, 12) == 13 and progress.resume_plan("backfill", 20, 12) == 20 and progress.resume_plan("realtime", "checkpoint", None) == "chainhead"
    assert progress.resume_plan("realtime", "checkpoint", 12) == 13 and progress.resume_plan("realtime", "latest", 12) == "chainhead" and progress.resume_plan("realtime", 5, 12) == 5
    assert progress.infer_mode(None) == "realtime" and progress.infer_mode(7) == "backfill" and progress.final_status("backfill") == "eos" and progress.final_status("realtime") == "running"
    lag = spark.createDataFrame([(1, 12, 20)], "seq long, cursor long, head long")
    assert progress.ingestion_lag(lag, end=20).first()["ingestion_lag"] == 8


def test_retry_values(spark):
    assert spark.range(1).select(dlq.next_retry_at(F.lit(3), 1000, 0)).first()[0] == 4000
    df = spark.createDataFrame([(0, 3, 1, "pending", None, None, None), (2, 3, 2, "retrying", None, None, None)], "retry_count long, max_retry long, id long, status string, next_retry_at long, last_attempt_at long, ingest_timestamp long")
    out = {r["id"]: r for r in dlq.retry_transition(df, 1000, 5000).collect()}
    assert (out[1]["next_retry_at"], out[1]["status"]) == (6000, "retrying") and (out[2]["status"], out[2]["next_retry_at"]) == ("failed", None)
    assert {r["status"] for r in dlq.resolve_transition(df, 9).collect()} == {"resolved"}


@pytest.mark.parametrize(
    ("payload", "want"),
    [
        (None, {}),
        ([1] * 20, {"type": "list", "size": 20, "preview": [1, 1, 1]}),
        ({"a": "x" * 600, "b": {"c": list(range(9))}}, {"type": "dict", "size": 2, "preview": {"a": "x" * 512 + "...", "b": {"c": [0, 1, 2]}}}),
        ({f"k{i:02}": i for i in range(14)}, {"type": "dict", "size": 14, "preview": {f"k{i:02}": i for i in range(10)}}),
        ("hello", {"type": "str", "size": 5, "preview": "hello"}),
        ({"type": "list", "size": 3}, {"type": "list", "size": 3}),
        (7, {"type": "int", "preview": 7}),
        ({"t": "[1]", "o": '{"a":1}', "n": "null", "d": "7"}, {"type": "dict", "size": 4, "preview": {"t": "[1]", "o": '{"a":1}', "n": "null", "d": "7"}}),
        (["[1]", ["[2]", {"z": 1, "a": "true"}]], {"type": "list", "size": 2, "preview": ["[1]", ["[2]", {"z": 1, "a": "true"}]]}),
        ({"a": {"b": [{"c": {"d": {"e": ["y" * 600, 1, 2, 3], "é": None}}}]}}, {"type": "dict", "size": 1, "preview": {"a": {"b": [{"c": {"d": {"e": ["y" * 512 + "...", 1, 2], "é": None}}}]}}}),
    ],
)
def test_payload_summaries(spark, payload, want):
    got = one(spark, dlq.summarize_payload(F.col("p")), p=None if payload is None else json.dumps(payload, separators=(",", ":")))
    assert json.loads(got) == want and json.dumps(json.loads(got)) == json.dumps(want)


def test_rpc_errors(spark):
    def error(message, cause=()):
        return json.dumps({"code": -32603, "message": message, "data": {"code": "E", "details": {"networkId": "evm:56", "durationMs": 4}, "cause": list(cause)}})

    bad = {"code": "ErrUpstreamBlockUnavailable", "details": {"latestBlock": 10, "finalizedBlock": 8}}
    rows = [(1, "m", error("x", [bad, {"code": "E", "cause": bad | {"details": {"latestBlock": 12}}}])), (2, "m", error("UPSTREAM does not have the requested block yet")), (3, "m", error("reverted"))]
    out = {r["cursor"]: r for r in errors.classify_rpc_error(spark.createDataFrame(rows, "cursor long, method string, error string")).collect()}
    assert [out[i]["not_ready"] for i in (1, 2, 3)] == [True, True, False]
    assert (out[1]["not_ready_upstreams"], out[1]["min_latest_cursor"], out[1]["max_latest_cursor"], out[1]["min_finalized_cursor"]) == (2, 10, 12, 8)
    assert out[3]["network_id"] == "evm:56" and out[3]["summary"] == "rpc_response_error(method=m, code=-32603, message=reverted, cursor=3)"


def test_parse_failures(spark):
    good = {"number": "0x1", "hash": "0xa", "parentHash": "0x0"}
    rows = [(1, json.dumps(good)), (2, json.dumps({"number": "0x1", "hash": None})), (3, "[]"), (4, None), (5, "nonsense")]
    out = {r["cursor"]: r["error_message"] for r in errors.parse_failures(spark.createDataFrame(rows, "cursor long, result string"), "block").collect()}
    assert out == {2: "missing parentHash", 3: "wrong shape", 4: "wrong shape", 5: "wrong shape"}


def test_plan_time_rules(spark):
    assert entities.resolve_entities(["token_transfer"]) == ["block", "receipt", "log"]
    assert entities.resolve_entities(["transaction"]) == ["block", "transaction", "receipt"]
    assert entities.sink_entities(["Trace", "receipt", "block"]) == ["block", "trace"]
    assert [m for m, _, _ in entities.request_kinds(["log", "receipt"])] == ["eth_getBlockByNumber", "eth_getBlockReceipts"]
    assert entities.state_topic("a.b.c.commit_watermark") == "a.b.c.cursor_state" and entities.state_topic("own") == "own.cursor_state"
    name = identity.pipeline_name(F.lit("BSC"), F.lit("main-net"), F.lit("backfill"), F.lit(5), F.lit("latest"))
    assert spark.range(1).select(name).first()[0] == "bsc_main_net_backfill_5_chainhead"
    key = identity.identity_key(F.lit("pipe"), F.lit("sui:mainnet"), F.lit("sui"), F.lit("mainnet"), F.lit("backfill"), F.array(F.lit("transaction"), F.lit("checkpoint")))
    assert spark.range(1).select(key).first()[0] == "pipeline=pipe|chain=sui:mainnet|network=mainnet|mode=backfill|unit=checkpoint|entities=checkpoint,transaction"


def test_profiles(spark):
    with pytest.raises(ValueError):
        profiles.profiles(spark, [*profiles.PROFILES, ("BSC ", "mainnet", "x", "y", 1.0)])
    with pytest.raises(Exception, match="unknown chain profile"):
        profiles.chain_profile(spark.createDataFrame([("no", "mainnet")], "chain string, network string")).collect()


def test_proto3_read_back(spark):
    df = spark.createDataFrame([(None, None, None, None), ("e", 5, '{"a":1}', ["x"])], "error string, next_retry_at long, payload string, topics array<string>")
    seen = contracts.proto3_defaults(df)
    assert seen.first().asDict() == {"error": "", "next_retry_at": 0, "payload": "", "topics": []}
    back = contracts.from_proto3(seen, json=("payload",)).collect()
    assert (back[0]["error"], back[0]["next_retry_at"], back[0]["payload"]) == (None, None, "{}") and back[1]["payload"] == '{"a":1}'
    odd = contracts.from_proto3(spark.createDataFrame([("not json",)], "payload string"), json=("payload",)).first()[0]
    assert json.loads(odd) == {"raw": "not json"}
    loose = contracts.conform(spark.createDataFrame([("1", "solo", "x")], "log_index string, topics string, block_number string"), contracts.LOG).first()
    assert loose["log_index"] == 1 and loose["topics"] == ["solo"] and loose["block_number"] is None and list(loose.asDict()) == [f.name for f in contracts.LOG]


def test_percentile_floor(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (5, 1, 1, 9)] + [("b", None)], "k string, x double")
    got = {r["percent"]: r["value"] for r in metrics.percentile_floor(df, "x", [0, 50, 99, 100], ["k"]).collect()}
    assert got == {0: 1.0, 50: 5.0, 99: 9.0, 100: 9.0}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_call_trees_read_their_source_once(spark):
    """One scan and no recursive query, whatever the depth; trees deeper than a pass, with escaped keys too, come whole."""
    tree = '{"type":"LEAF"}'
    for k in range(25):
        tree = '{"type":"T%d","%s":[%s]}' % (k, "c\\u0061lls" if k % 2 else "calls", tree)
    path = '[{"txHash":"0xa","result":%s},{"txHash":"0xb","result":{"type":"X"}}]' % tree
    raw = spark.range(1).selectExpr("id AS cursor", "'debug_traceBlockByNumber' AS method").withColumn("result", F.lit(path))
    rows = parse.flatten_call_tree(raw)
    assert _plan(rows).count("Range") == 1 and "UnionLoop" not in _plan(rows)
    got = {(r["trace_id"], r["call_type"], r["depth"]) for r in rows.collect()}
    want = {("0xa" + "_0" * d if d else "0xa_root", f"T{24 - d}" if d < 25 else "LEAF", d) for d in range(26)} | {("0xb_root", "X", 0)}
    assert got == want


def test_payload_texts_stay_in_their_partitions(spark):
    """Payloads are put together where the window has laid the transactions: line items are exchanged once."""
    for view in (views.raw_receipts, views.raw_traces, views.raw_trace_blocks):
        assert _plan(view(spark, "/root/testdata/sf0.001")).count("Exchange hashpartitioning") == 1


def test_short_and_padded_quantities_take_no_pattern(spark):
    """Values of up to 16 digits and zeros before them convert by bytes; odd texts give what the patterns gave."""
    cases = {"0x": None, "": None, "0x0x1": None, " 0x1": None, "0x1\n": 1, "0": 0, "0X0a": 10, "0x" + "0" * 60 + "ff": 255, "0x" + "0" * 100 + "1": 1, "7" + "f" * 15: 2**63 - 1, "8" + "0" * 15: None, "0xg": None, "é": None, None: None}
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select("x", hexabi.hex_to_long(F.col("x")).alias("n"), hexabi.hex_to_decimal_string(F.col("x")).alias("d")).collect()
    assert {r["x"]: r["n"] for r in rows} == cases
    assert {r["x"]: r["d"] for r in rows} == {k: str(2**63) if k == "8" + "0" * 15 else None if v is None else str(v) for k, v in cases.items()}


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_on_parsed_rows_parses_no_payload_again(spark):
    raw = spark.createDataFrame([(1, '{"number":"0xa","hash":"0x1","parentHash":"0x0"}'), (2, '{"number":"0xb","hash":"0x2","parentHash":"0x0"}'), (3, "no object")], "cursor long, result string")
    rows = parse.parse_blocks(raw).where("number % 10 <> 0")
    assert optimized(rows).count("from_json") == 1
    assert [r["hash"] for r in rows.collect()] == ["0x2"]


def test_columns_named_are_those_of_all(spark, tmp_path):
    block = {"number": "0xa", "hash": "0x1", "parentHash": "0x0", "timestamp": None, "gasUsed": "0x5", "transactions": [{"hash": "0x7", "nonce": "0x1"}, {"hash": None}]}
    receipt = {"transactionHash": "0x7", "status": "0x1", "gasUsed": "0x9", "logs": [{"logIndex": "0x0"}]}
    texts = [json.dumps(block), "{}", "nothing", None]
    raw = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "cursor long, result string")
    for some in (("number", "timestamp"), ("size", "transaction_count", "withdrawals"), ("hash",)):
        whole, own = parse.parse_blocks(raw).select("cursor", *some), parse.parse_blocks(raw, some).select("cursor", *some)
        assert sorted(map(repr, own.collect())) == sorted(map(repr, whole.collect()))
    assert sorted(map(repr, parse.parse_transactions(raw, ("hash", "nonce")).collect())) == sorted(map(repr, parse.parse_transactions(raw).select("cursor", "hash", "nonce").collect()))
    got = spark.createDataFrame([(1, json.dumps([receipt, {}])), (2, "[]"), (3, "x")], "cursor long, result string")
    some = ("transaction_hash", "status", "gas_used")
    assert sorted(map(repr, parse.parse_receipts(got, some).select("cursor", *some).collect())) == sorted(map(repr, parse.parse_receipts(got).select("cursor", *some).collect()))
    assert "cumulativeGasUsed" not in optimized(parse.parse_receipts(got, some))


def test_raw_views_write_json_in_generated_code(spark):
    for view in (views.raw_blocks, views.raw_receipts, views.raw_traces):
        plan = optimized(view(spark, "/root/testdata/sf0.001"))
        assert "StructsToJson" not in plan and "to_json" not in plan


def test_payload_stats_reads_its_source_once(spark):
    from ledgerframe.plans import registry

    assert optimized(registry.queries()["a14_payload_stats"](spark, "/root/testdata/sf0.001")).count("Relation [") == 1


def test_trace_payloads_are_made_after_lists_are(spark):
    """What is exchanged, sorted and listed for call traces are numbers, once; texts are made of the lists."""
    rows = views.raw_traces(spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") == 1
    assert "lpad" not in plan[plan.index("Aggregate") :].partition("\n")[2]
    lists = views._items(spark, "/root/testdata/sf0.001").schema["l"].dataType.elementType
    assert "string" not in {f.dataType.typeName() for f in lists.fields}
    assert rows.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey").distinct().count()


def test_blocks_and_receipts_are_never_broadcast(spark, capsys):
    """Spark expects parsed payloads to be far smaller than they are, so no join may go by that."""
    few = lambda *columns: spark.range(1).selectExpr(*columns)
    blocks = few("id + 7 AS number", "'0xb' AS hash", "70L AS timestamp")
    rows, seen = few("id + 7 AS block_number", "'0xold' AS block_hash"), few("id + 7 AS head", "80000L AS seen_ms")
    tx, receipts = few("concat('0x', id + 1) AS hash"), few("concat('0x', id + 1) AS transaction_hash", "1L AS transaction_index", "5L AS gas_used")
    out = [enrich.inject_block_context(rows, blocks), metrics.head_age(seen, blocks), enrich.enrich_transactions(tx, receipts)]
    assert [tuple(df.first()) for df in out] == [(7, "0xb", 70), (7, 80_000, 10_000), ("0x1", 5)]
    for df in out:
        df.explain()
        assert "Broadcast" not in capsys.readouterr().out


def test_transfers_are_compiled(spark, capsys):
    """What every log passes is generated code, in methods that the JVM compiles (8,000 bytes at most)."""
    source = logs(spark, [("0x1", 0, "0xc", "0x", [decode.TRANSFER], 0, "0xb", 5)])
    decode.decode_token_transfers(source).explain("codegen")
    said = capsys.readouterr().out
    assert re.search(r"\*\(\d+\) Generate explode", said)
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", said))) <= 8000


def test_quantities_at_the_edges(spark):
    cases = ["0x", "", "0", "0x0", "0X00", "0x" + "0" * 64, "f" * 16, "0x7" + "f" * 15, "0x8" + "0" * 15, "0x" + "0" * 48 + "f" * 16, "1" + "0" * 16, "0x" + "f" * 64, "0x1" + "0" * 64, "zz", "0xg", " 1", "0x-1", "x1", None]
    valid = [c if c is not None and re.fullmatch("(0[xX])?[0-9a-fA-F]+", c) else None for c in cases]
    numbers = [None if c is None else int(c, 16) for c in valid]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert [r[0] for r in df.select(hexabi.hex_to_long(F.col("c"))).collect()] == [None if n is None or n >= 2**63 else n for n in numbers]
    assert [r[0] for r in df.select(hexabi.hex_to_decimal_string(F.col("c"))).collect()] == [None if n is None or n >= 2**256 else str(n) for n in numbers]


def test_batch_words_with_a_prefix(spark):
    """A word of a batch may have 0x for its first digits, and one that is no hex ends the list."""
    a = "0x" + "0" * 24 + "a" * 40
    data = "0x" + word(64) + word(160) + word(2) + "0x" + word(7)[2:] + word(8) + word(3) + word(1) + word(2) + "g" + word(3)[1:]
    got = decode.decode_token_transfers(logs(spark, [("0x1", 0, "0xc", data, [decode.BATCH, a, a, a], 0, "0xb", 5)])).orderBy("transfer_index").collect()
    assert [(r["token_id"], r["amount"], r["transfer_index"]) for r in got] == [("7", "1", 0), ("8", "2", 1)]


def test_emitted_cursors_are_dealt_evenly(spark):
    """Partitions differ by a span of each key at most, so no task writes far more rows than another."""
    heads = spark.range(2).selectExpr("id AS seq", "id * 65536 - 32768 AS head")
    parts = progress.emit_cursors(heads).groupBy(F.spark_partition_id().alias("p")).count().collect()
    counts = [r["count"] for r in parts]
    assert sum(counts) == 65537 and len(counts) == 4 and max(counts) - min(counts) <= 1025
