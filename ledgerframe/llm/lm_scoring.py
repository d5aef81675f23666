"""Cross-entropy difference scores by matched target and background n-gram models.

Both models are counted over whole documents and share one vocabulary (every word that either side holds, and one unknown word),
one smoothing and one weight between the orders. A token's log probability is WEIGHT times the bigram's, (count of the pair +
ADDED) / (count of the first word + ADDED * outcomes), and the rest of the unigram's. So a document's loss difference is a sum
over its distinct bigrams and words, each of which needs the counts of one key only: counts and documents' keys are dealt to
the same parts, each part adds up its share, and the shares meet by batch of documents. A document that was counted is
scored without its own counts.

The counts of the most frequent words and bigrams are broadcast too, as a cache of bounded size: their keys never travel, so no
part gets a hot key. What is cached changes no score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerframe.llm.common import cut, dealt, gathered, mix, table, word_hashes

#: Weight of the bigram order against the unigram one, and the added count of every outcome.
WEIGHT, ADDED = 0.7, 0.1
#: Keys, about, that one part holds at once.
PART_ROWS = 2_000_000
#: Words and bigrams, each, whose counts are broadcast (24 bytes each), and documents that bigrams for this are looked for in.
CACHED, CACHE_DOCS = 1 << 16, 2000
#: Ids of target documents, at most, that are broadcast (about 50 bytes each); more are joined by shuffle.
BROADCAST_IDS = 2_000_000
TARGET, BACKGROUND, NEITHER = 0, 1, 2
START = np.uint64(0xD6E8FEB86659FD93)
#: A key within its part: 48 of its bits, the part tells more.
_KEY = [("hi", "u4"), ("lo", "u2")]
_GRAM = np.dtype([*_KEY, ("side", "u1"), ("n", "u2")])
_COUNT = np.dtype([*_KEY, ("t", "i8"), ("b", "i8")])
#: doc: the place in the batch, the side above it, and whether the key is a word and the document's last one.
_USE = {kind: np.dtype([*_KEY, ("doc", "u2"), ("n", n)]) for kind, n in (("few", "u1"), ("many", "i8"))}
_HEAD = np.dtype([("id", "i8"), ("null", "?"), ("tokens", "i8"), ("own", "f8")])
#: Documents of one batch, at most: a place fits 11 bits.
BATCH, _SIDE, _WORD, _LAST = 1500, 11, 1 << 13, 1 << 14


def matched_corpora(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 3, most_ids: int = BROADCAST_IDS) -> DataFrame:
    """(rid, doc_id, text, side) of docs: side 0 the target (labelled quality 1, not toxic), 1 the background, 2 neither.

    The background is drawn by a hash of the id from the rest, as many documents as the target has (all of them if they are fewer).
    """
    good = cut(labels.where("quality = 1 AND coalesce(toxic, 0) <> 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("good_id")).distinct())
    few = good.count() <= most_ids
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    n = ids.join(F.broadcast(good) if few else good, F.col("doc_id") == F.col("good_id"), "left").agg(F.count("good_id").alias("t"), F.count("*").alias("n")).first()
    share = min(1.0, n["t"] / max(1, n["n"] - n["t"]))
    u = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    side = F.when(F.col("good_id").isNotNull(), TARGET).when((u < share) & F.col("doc_id").isNotNull(), BACKGROUND).otherwise(NEITHER)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    joined = rows.join(F.broadcast(good) if few else good, F.col("doc_id") == F.col("good_id"), "left").select("doc_id", "text", side.alias("side"))
    return (joined if few else cut(joined)).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text", "side")


def bigram_keys(words: np.ndarray) -> np.ndarray:
    """A 64-bit key of each word and the one before it (START before the first)."""
    return mix(np.concatenate(([START], words[:-1])) * np.uint64(0x9E3779B97F4A7C15) ^ mix(words + np.uint64(1))) if len(words) else words


class Cache:
    """Counts of some keys in a table of fixed size; a key whose place is taken is left out."""

    def __init__(self, keys: np.ndarray, t: np.ndarray, b: np.ndarray) -> None:
        """Keys stand in order of use, most first."""
        self.mask = np.uint64(4 * CACHED - 1)
        self.at = np.full(4 * CACHED, -1, np.int32)
        place = (keys & self.mask).astype(np.intp)
        self.at[place[::-1]] = np.arange(len(keys), dtype=np.int32)[::-1]
        self.keys, self.counts = np.append(keys, np.uint64(0)), np.stack((np.append(t, 0), np.append(b, 0)))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key's counts, -1 where it isn't held."""
        at = self.at[(keys & self.mask).astype(np.intp)]
        return np.where(self.keys[at] == keys, at, -1)


def keyed(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    rows["hi"], rows["lo"] = keys >> np.uint64(32), keys >> np.uint64(16) & np.uint64(0xFFFF)
    return rows


def short_keys(rows: np.ndarray) -> np.ndarray:
    return rows["hi"].astype(np.uint64) << np.uint64(16) | rows["lo"]


def split_counts(rows: np.ndarray, dtype: np.dtype) -> np.ndarray:
    """rows as dtype, whose counts have 16 bits: a larger count becomes several rows that add up to it."""
    if rows["n"].max(initial=0) <= 65_535:
        return rows.astype(dtype)
    times = np.maximum(-(-rows["n"] // 65_535), 1)
    out = np.repeat(rows, times).astype(dtype)
    if len(rows):
        last = np.cumsum(times) - 1
        out["n"] = 65_535
        out["n"][last] = rows["n"] - 65_535 * (times - 1)
    return out


def difference(counts: np.ndarray, own: np.ndarray, side: np.ndarray, added: float) -> np.ndarray:
    """ln of the background's count less that of the target, each with `added`; own counts are taken from the document's side.

    counts is (2 x keys), own how often the document holds each key, side the document's.
    """
    left = [np.maximum(counts[s] - np.where(side == s, own, 0), 0) + added for s in (TARGET, BACKGROUND)]
    return np.log(left[BACKGROUND]) - np.log(left[TARGET])


def word_part(counts: np.ndarray, n: np.ndarray, side: np.ndarray, last: np.ndarray, outcomes: int) -> np.ndarray:
    """What a document's n tokens of a word add to its sum: as unigrams, and as first words of bigrams (all but its last token)."""
    return (1 - WEIGHT) * n * difference(counts, n, side, ADDED) - WEIGHT * (n - last) * difference(counts, n, side, ADDED * outcomes)


def bigram_part(counts: np.ndarray, n: np.ndarray, side: np.ndarray) -> np.ndarray:
    return WEIGHT * n * difference(counts, n, side, ADDED)


def count_rows(docs: DataFrame, keys_of, parts: int) -> DataFrame:
    """(part, blob): counts of the keys that keys_of(text) lists, by side, from docs(text, side), dealt by key."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                for side in (TARGET, BACKGROUND):
                    found = [keys_of(t) for t in part["text"][part["side"] == side]]
                    if found:
                        keys, n = np.unique(np.concatenate(found), return_counts=True)
                        rows = np.zeros(len(keys), np.dtype([*_KEY, ("side", "u1"), ("n", "i8")]))
                        rows["side"], rows["n"] = side, n
                        rows = split_counts(keyed(rows, keys), _GRAM)
                        keys = np.repeat(keys, np.maximum(-(-n // 65_535), 1))
                        yield pd.DataFrame(dealt(keys, rows, parts), columns=["part", "blob"])

    return docs.select("text", "side").where(F.col("side") != NEITHER).mapInPandas(deal, "part int, blob binary")


def frequent_bigrams(corpus: DataFrame, rows: int) -> np.ndarray:
    """Bigrams to cache: the most frequent ones of about CACHE_DOCS documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, n = np.unique(np.concatenate([bigram_keys(word_hashes(t)) for t in batch["text"]]), return_counts=True)
            yield pd.DataFrame({"key": keys[n > 1].view(np.int64), "n": n[n > 1]})

    some = corpus.where((F.col("side") != NEITHER) & (F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(max(1, rows // CACHE_DOCS))) == 0)).select("text")
    top = some.mapInPandas(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(CACHED)
    return np.array([r["key"] for r in top.collect()], np.int64).view(np.uint64)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, score): mean over the tokens of a whole document of target loss less background loss, in nats; one row per row of docs.

    Low scores are like the target (labelled quality 1 and not toxic). A null or blank text has no tokens and score null; a very
    long text is counted and scored whole; without labels or rows both models are uniform and scores 0; rows of one id share a side,
    and each is scored without its own counts; a null id is scored and never learned from; repeated rows are scored alike; an
    empty table gives an empty result. Other columns are not read, whatever their names.
    """
    sc = docs.sparkSession.sparkContext
    rows = matched_corpora(docs, labels, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(8, -(-(size[0] or 0) // (5 * PART_ROWS)))
    hot = np.sort(frequent_bigrams(rows, size[1]))

    def first_keys(text: str) -> np.ndarray:
        words = word_hashes(text)
        grams = bigram_keys(words)
        at = np.minimum(np.searchsorted(hot, grams), max(0, len(hot) - 1))
        return np.concatenate((words, grams[hot[at] == grams] if len(hot) else grams[:0], [START] if len(words) else words[:0]))

    def add_up(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        own = gathered(group["blob"], _GRAM)
        keys, at = np.unique(short_keys(own), return_inverse=True)
        t, b = (np.bincount(at[own["side"] == s], own["n"][own["side"] == s], len(keys)).astype(np.int64) for s in (TARGET, BACKGROUND))
        return pd.DataFrame({"part": np.full(len(keys), key[0], np.int32), "key": keys.view(np.int64), "t": t, "b": b})

    counts = cut(count_rows(rows, first_keys, parts).groupBy("part").applyInPandas(add_up, "part int, key long, t long, b long"))
    # Words, frequent bigrams and the start are told apart by their keys: the last two are known here.
    named = np.append(hot, START)
    special = docs.sparkSession.createDataFrame(pd.DataFrame({"part": (named % np.uint64(parts)).astype(np.int32), "key": (named >> np.uint64(16)).view(np.int64), "full": named.view(np.int64)}), "part int, key long, full long")
    special = counts.join(F.broadcast(special), ["part", "key"]).collect()
    words = counts.join(F.broadcast(docs.sparkSession.createDataFrame([(r["part"], r["key"]) for r in special], "part int, key long")), ["part", "key"], "left_anti")
    facts = words.agg(F.count("*").alias("words"), F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    top = words.orderBy(F.desc(F.col("t") + F.col("b")), "key", "part").limit(CACHED).collect()
    starts = next(([r["t"], r["b"]] for r in special if r["full"] == np.int64(START.view(np.int64))), [0, 0])

    def cache(found: list, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = sorted(found, key=lambda r: -(r["t"] + r["b"]))
        return np.array([r[name] for r in found], np.int64).view(np.uint64), *(np.array([r[s] for r in found], np.float64) for s in ("t", "b"))

    # Words are cached by short key and part, which is what the counts know of them.
    word_cache = cache(top, "key")
    word_cache = (mix(word_cache[0] ^ mix(np.array([r["part"] for r in sorted(top, key=lambda r: -(r["t"] + r["b"]))], np.uint64))), *word_cache[1:])
    gram_cache = cache([r for r in special if r["full"] != np.int64(START.view(np.int64))], "full")
    model = sc.broadcast({"words": Cache(*word_cache), "grams": Cache(*gram_cache), "outcomes": facts["words"] + 2, "totals": np.array([facts["t"], facts["b"]], np.float64), "starts": np.array(starts, np.float64)})

    def word_name(keys: np.ndarray) -> np.ndarray:
        return mix(keys >> np.uint64(16) ^ mix(keys % np.uint64(parts)))

    def rare_grams(text: str) -> np.ndarray:
        grams = bigram_keys(word_hashes(text))
        return grams[model.value["grams"].find(grams) < 0]

    def use(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                first, held = int(part["rid"].iloc[0]), []
                own, tokens = np.zeros(len(part)), np.zeros(len(part), np.int64)
                for k, (text, side) in enumerate(zip(part["text"], part["side"], strict=True)):
                    found = word_hashes(text)
                    tokens[k] = len(found)
                    if not len(found):
                        continue
                    mine = np.array([float(side == s) for s in (TARGET, BACKGROUND)])
                    one, all_ = np.array([side]), np.array([len(found)])
                    own[k] -= WEIGHT * difference(m["starts"][:, None], mine.max(keepdims=True), one, ADDED * m["outcomes"])[0]
                    own[k] -= (1 - WEIGHT) * len(found) * difference(m["totals"][:, None], all_, one, ADDED * (m["outcomes"] - 1))[0]
                    place = k | int(side) << _SIDE
                    words, n = np.unique(found, return_counts=True)
                    last = words == found[-1]
                    at_ = m["words"].find(word_name(words))
                    hit = at_ >= 0
                    own[k] += word_part(m["words"].counts[:, at_[hit]], n[hit], side, last[hit], m["outcomes"]).sum()
                    held.append((words[~hit], n[~hit], (place | _WORD) + _LAST * last[~hit]))
                    grams, n = np.unique(bigram_keys(found), return_counts=True)
                    at_ = m["grams"].find(grams)
                    hit = at_ >= 0
                    own[k] += bigram_part(m["grams"].counts[:, at_[hit]], n[hit], side).sum()
                    held.append((grams[~hit], n[~hit], np.full(int((~hit).sum()), place)))
                made = []
                if held:
                    keys, n, doc = (np.concatenate([x[j] for x in held]) for j in range(3))
                    for kind, some in (("few", n < 256), ("many", n >= 256)):
                        out = keyed(np.empty(int(some.sum()), _USE[kind]), keys[some])
                        out["doc"], out["n"] = doc[some], n[some]
                        made += [(p, first, kind, b) for p, b in dealt(keys[some], out, parts)]
                head = np.rec.fromarrays([part["id"].to_numpy(np.int64), part["null"].to_numpy(bool), tokens, own], dtype=_HEAD)
                made.append((first % parts, first, "head", head.tobytes()))
                yield pd.DataFrame(made, columns=["part", "batch", "kind", "blob"])

    def words_again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["key"].to_numpy(np.int64).view(np.uint64)
            part = batch["part"].to_numpy(np.int64).astype(np.uint64)
            keep = model.value["words"].find(mix(keys ^ mix(part))) < 0
            out = np.empty(int(keep.sum()), _COUNT)
            out["hi"], out["lo"] = keys[keep] >> np.uint64(16), keys[keep] & np.uint64(0xFFFF)
            out["t"], out["b"] = batch["t"][keep], batch["b"][keep]
            yield pd.DataFrame([(p, "word", b) for p, b in dealt(part[keep], out, parts)], columns=["part", "kind", "blob"])

    def meet(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        grams = gathered(left["blob"][left["kind"] == "gram"], _GRAM)
        words = gathered(left["blob"][left["kind"] == "word"], _COUNT)
        keys, index = np.unique(np.concatenate((short_keys(grams), short_keys(words))), return_inverse=True)
        mine = np.zeros((2, len(keys) + 1))
        for s, name in ((TARGET, "t"), (BACKGROUND, "b")):
            own = grams["side"] == s
            mine[s, : len(keys)] = np.bincount(index[: len(grams)][own], grams["n"][own], len(keys)) + np.bincount(index[len(grams) :], words[name], len(keys))
        out, outcomes = [], model.value["outcomes"]
        for batch, kind, blob in zip(right["batch"], right["kind"], right["blob"], strict=True):
            if kind == "head":
                out.append((batch, kind, blob))
                continue
            rows = np.frombuffer(blob, _USE[kind])
            wanted = short_keys(rows)
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            at = np.where(keys[at] == wanted, at, len(keys)) if len(keys) else np.zeros(len(rows), np.int64)
            n, side = rows["n"].astype(np.int64), rows["doc"] >> _SIDE & 3
            word, last = (rows["doc"] & _WORD) > 0, (rows["doc"] & _LAST) > 0
            value = np.where(word, word_part(mine[:, at], n, side, last, outcomes), bigram_part(mine[:, at], n, side))
            out.append((batch, "use", np.bincount(rows["doc"] & ((1 << _SIDE) - 1), value).tobytes()))
        return pd.DataFrame(out, columns=["batch", "kind", "blob"])

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        head = np.frombuffer(group["blob"][group["kind"] == "head"].iloc[0], _HEAD)
        total = head["own"].copy()
        for blob in group["blob"][group["kind"] == "use"]:
            sums = np.frombuffer(blob, np.float64)
            total[: len(sums)] += sums
        score = np.where(head["tokens"] > 0, total / np.maximum(head["tokens"], 1), np.nan)
        return pd.DataFrame({"doc_id": head["id"], "null": head["null"], "n_tokens": head["tokens"], "score": score})

    left = count_rows(rows, rare_grams, parts).select("part", F.lit("gram").alias("kind"), "blob").union(words.select("part", "key", "t", "b").mapInPandas(words_again, "part int, kind string, blob binary"))
    plain = rows.select("rid", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("null"), "text", "side")
    uses = plain.mapInPandas(use, "part int, batch long, kind string, blob binary")
    shares = left.groupBy("part").cogroup(uses.groupBy("part")).applyInPandas(meet, "batch long, kind string, blob binary")
    done = shares.groupBy("batch").applyInPandas(finish, "doc_id long, null boolean, n_tokens long, score double")
    return done.select(F.when(~F.col("null"), F.col("doc_id")).alias("doc_id"), "n_tokens", F.when(F.col("n_tokens") > 0, F.col("score")).alias("score"))


def op3(spark, sf_dir: str) -> DataFrame:
    """score_documents over all documents and labels; odd rows as there."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
