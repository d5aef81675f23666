"""Line dedup by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity (counts over all documents, kept for word buckets, so that their
table has a fixed size; any fixed order gives an exact join). Two sets of Jaccard similarity 0.8 or more share a
word of their prefixes, so prefixes meet by one shuffle. Copies are settled there by a hash of the whole set; length, position
and bitmap filters bound the overlap of the rest from above, and what passes is verified on the whole sets. A line
that has an earlier match is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ledgerframe.llm.common import cut, dealt, fresh, gathered, mix, runs_of, span_hashes, table, word_spans

#: Least Jaccard similarity, as a fraction.
NUM, DEN = 4, 5
#: Word buckets of the rarity table, which is broadcast: 2^18 counts of 8 bytes.
BUCKETS = 1 << 18
#: Prefix words, about, that one reducing task holds at once, and bytes of text that are hashed at once.
PART_ROWS, CHUNK = 200_000, 400_000
#: Bits, at most, of a filter that is broadcast (16 MB); it has 16 for each key where that is less.
FILTER_BITS = 1 << 27
#: A word that occurs more often than this may be in more prefixes than a task should compare: those are split into blocks of
#: this many rows, and each pair of blocks is a task of its own.
HOT = 100_000
#: Candidates of one prefix word, at most, that a set in doubt is judged against at first; where all of them fail, a second
#: pass takes the others too.
FIRST = 128
#: Rows of one word from which on later ones are first compared with a few early ones, and leave where one is clearly similar.
MANY = 256
#: Words of 64 bits in the bitmap of a set, and the largest set that has it (the last one: any).
WIDTHS = ((1, 48), (2, 128), (4, 256), (8, 512), (16, 1 << 62))
_FIELDS = [("set", "u8"), ("doc", "i8"), ("sub", "u8"), ("token", "u4"), ("line", "u4"), ("n", "u2"), ("at", "u2")]
_ROW = {w: np.dtype([*_FIELDS, ("bits", "u8", (w,))]) for w, _ in WIDTHS}
_PLACE = np.dtype([("doc", "i8"), ("sub", "u8"), ("line", "u4")])
#: Sizes and ranks of this and more are not told apart; the filters let such sets pass.
_LARGE = 65_535


def chunks(batches: Iterator[pd.DataFrame], column: str = "text") -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Rows with their lower-cased bytes, about CHUNK bytes of them at once."""
    for batch in batches:
        at, size, held = 0, 0, []
        for k, text in enumerate(batch[column]):
            held.append(text.encode("utf-8", "surrogatepass").lower())
            size += len(held[-1])
            if size >= CHUNK or k == len(batch) - 1:
                yield batch.iloc[at : k + 1], held
                at, size, held = k + 1, 0, []


def line_tokens(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(words, lines, n_lines): the hash and the line number of each word; lines end at newlines only."""
    starts, ends = word_spans(data)
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    return span_hashes(data, starts, ends), np.searchsorted(breaks, starts), len(breaks) + 1


def line_sets(data: bytes, ranks: np.ndarray) -> dict[str, np.ndarray]:
    """The lines' word sets.

    For each distinct word of a line, rarest first: token (its hash), at (its rank) and of (the number of its line among those
    with words). For each line with words: line (its number), n (the set's size), first (where its words start), set (a hash
    of the whole set).
    """
    words, lines, n_lines = line_tokens(data)
    rank = ranks[(words & np.uint64(BUCKETS - 1)).astype(np.intp)]
    order = None
    if n_lines < 1 << 20:  # one key for line, rank and most of the word; words that it can't tell apart are rare
        key = (lines.astype(np.uint64) << np.uint64(44)) | (rank << np.uint64(32)) | (words >> np.uint64(32))
        order = np.argsort(key)
        key = key[order]
        if np.any((key[1:] == key[:-1]) & (words[order[1:]] != words[order[:-1]])):
            order = None
    if order is None:
        order = np.lexsort((words, words >> np.uint64(32), rank, lines))
    words, lines = words[order], lines[order]
    new = np.concatenate(([True], (words[1:] != words[:-1]) | (lines[1:] != lines[:-1]))) if len(words) else np.empty(0, bool)
    words, lines = words[new], lines[new]
    start, _ = runs_of(lines)
    index = np.arange(len(lines))
    first = np.flatnonzero(start == index)
    n = np.diff(np.append(first, len(lines)))
    sets = mix(np.add.reduceat(spread(words), first) + n.astype(np.uint64)) if len(first) else np.empty(0, np.uint64)
    return {"token": words, "at": index - start, "of": np.repeat(np.arange(len(first)), n), "line": lines[first], "n": n, "first": first, "set": sets}


def spread(words: np.ndarray) -> np.ndarray:
    """Word hashes mixed again, for what must not depend on the words' buckets."""
    return mix(words ^ np.uint64(0xA5A5A5A5A5A5A5A5))


def bitmaps(words: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """(sets x width): the parity of each set's words in 64 * width places; sets differ in at least as many words as their bits do in places.

    words are those of all sets in a row, first is where each starts. The two halves of a bitmap, combined, are the one of half the width.
    """
    mixed = spread(words)
    bit, word = np.uint64(1) << (mixed & np.uint64(63)), mixed >> np.uint64(6) & np.uint64(width - 1)
    return np.stack([np.bitwise_xor.reduceat(np.where(word == k, bit, np.uint64(0)), first) for k in range(width)], axis=1)


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number of common words of sets of sizes a and b that are similar enough."""
    return -(-NUM * (a + b) // (NUM + DEN))


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (-(-NUM * n // DEN)) + 1


def word_counts(docs: DataFrame) -> np.ndarray:
    """How often words of each bucket occur in docs(text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, held = np.zeros(BUCKETS, np.int64), []

        def add_up() -> None:
            total[:] += np.bincount(np.concatenate(held), minlength=BUCKETS)
            held.clear()

        for _, texts in chunks(batches):
            data = b"\n".join(texts)
            held.append((span_hashes(data, *word_spans(data)) & np.uint64(BUCKETS - 1)).astype(np.int32))
            if len(held) > 10:
                add_up()
        if held:
            add_up()
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at.astype(np.int32), "n": total[at]})

    out = np.zeros(BUCKETS, np.int64)
    found = docs.select("text").mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in found.toLocalIterator():
        out[r["bucket"]] = r["n"]
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """The rank of each bucket, 0 to 4095 on a log scale of counts."""
    return np.minimum(np.log2(1 + counts) * 64, 4095).astype(np.uint64)


class Filter:
    """A set of 64-bit keys as bits of a bounded number of places: it may hold more than was asked for, never less."""

    def __init__(self, held: np.ndarray) -> None:
        self.held, self.mask = held, np.uint64(len(held) * 8 - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys & self.mask
        return (self.held[(at >> np.uint64(3)).astype(np.intp)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def key_filter(keys: DataFrame) -> Filter:
    """A Filter of keys(key); its bits are gathered by place, so what reaches the driver is bounded by its size."""
    n = keys.count()
    size = min(FILTER_BITS, max(1 << 16, 1 << (16 * n - 1).bit_length() if n else 0))
    place = F.col("key").bitwiseAND(F.lit(size - 1))
    words = keys.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(key & 63 AS INT))")).alias("bits"))
    held = np.zeros(size // 64, np.int64)
    for r in words.toLocalIterator():
        held[r["at"]] = r["bits"]
    return Filter(held.view(np.uint8))


def some_lines(data: bytes, wanted) -> tuple[bytes, np.ndarray]:
    """The lines of data that wanted(number of lines) picks, as text, and their numbers."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    starts, ends = np.concatenate(([0], breaks + 1)), np.append(breaks, len(data))
    keep = np.flatnonzero(wanted(len(starts)))
    return b"\n".join(data[a:b] for a, b in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)), keep


def places(batch: pd.DataFrame, texts: list[bytes], line: np.ndarray) -> np.ndarray:
    """(doc, sub, line within it) of line numbers of texts joined by newlines."""
    ends = np.cumsum([t.count(b"\n") + 1 for t in texts])
    doc = np.searchsorted(ends, line, side="right")
    out = np.empty(len(line), _PLACE)
    out["doc"], out["sub"] = batch["doc"].to_numpy(np.int64)[doc], batch["sub"].to_numpy(np.int64).view(np.uint64)[doc]
    out["line"] = line - np.concatenate(([0], ends))[doc]
    return out


def place_key(place: np.ndarray) -> np.ndarray:
    return mix(mix(place["doc"].astype(np.uint64)) + mix(place["sub"]) + place["line"])


def in_order(rows: np.ndarray) -> np.ndarray:
    """The order of rows by place: document, its text's hash, line."""
    return np.lexsort((rows["line"], rows["sub"], rows["doc"]))


def prefixes(docs: DataFrame, counts, parts: int, only=None) -> DataFrame:
    """(part, width, token, blob): a row for each prefix word of each line, dealt by word; of a batch's equal lines only the first has rows.

    width is that of the bitmaps; 0 stands for the places of the lines left out. token is 0, or a word that may be in too many
    prefixes for one task: its rows are spread over the parts. With only (a Filter), just lines and words that pass it.
    """

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, dict]] = []
        ranks = rarity(counts.value)

        def flush() -> pd.DataFrame:
            place = np.concatenate([p for p, _ in held])
            sets = np.concatenate([f["set"] for _, f in held])
            order = np.lexsort((place["line"], place["sub"], place["doc"], sets))
            once = np.zeros(len(sets), bool)
            once[order] = np.concatenate(([True], sets[order[1:]] != sets[order[:-1]]))
            head = np.empty(len(sets), np.int64)
            head[order] = np.maximum.accumulate(np.where(once[order], np.arange(len(sets)), 0))
            gone = place[place != place[order[head]]]
            out = [(p, 0, 0, b) for p, b in dealt(place_key(gone), gone, parts)]
            made: dict[int, list] = {w: [] for w, _ in WIDTHS}
            start = 0
            for own, f in held:
                keep = once[start : start + len(own)]
                start += len(own)
                below = 0
                for w, largest in WIDTHS:
                    lines = np.flatnonzero(keep & (f["n"] > below) & (f["n"] <= largest))
                    below = largest
                    if len(lines):
                        made[w].append(_rows(own, f, lines, w, only))
            held.clear()
            for w, found in made.items():
                if found:
                    tokens, rows = (np.concatenate([x[k] for x in found]) for k in (0, 1))
                    hot = counts.value[(tokens & np.uint64(BUCKETS - 1)).astype(np.intp)] > HOT
                    out += [(p, w, 0, b) for p, b in dealt(tokens[~hot], rows[~hot], parts)]
                    order = np.argsort(tokens[hot], kind="stable")
                    tokens, rows = tokens[hot][order], rows[hot][order]
                    for a, b in zip(*(x.tolist() for x in _runs(tokens)), strict=True):
                        out.append((int(rows["set"][a] % np.uint64(parts)), w, int(tokens[a].view(np.int64)) or 1, rows[a:b].tobytes()))
            return pd.DataFrame(out, columns=["part", "width", "token", "blob"])

        pending = 0
        for batch, texts in chunks(batches):
            data, lines = b"\n".join(texts), None
            if only is not None:

                def with_words(n: int, data=data) -> np.ndarray:
                    words, line, _ = line_tokens(data)
                    hit = np.zeros(n, bool)
                    hit[line[only.value.has(words)]] = True
                    return hit

                data, lines = some_lines(data, with_words)
                if not len(lines):
                    continue
            found = line_sets(data, ranks)
            if len(found["line"]):
                held.append((places(batch, texts, found["line"] if lines is None else lines[found["line"]]), found))
                pending += len(found["token"])
            if pending > 300_000:
                yield flush()
                pending = 0
        if held:
            yield flush()

    return docs.mapInPandas(deal, "part int, width int, token long, blob binary")


def _rows(place: np.ndarray, found: dict[str, np.ndarray], lines: np.ndarray, width: int, only) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, rows) of the prefix words of some of the lines, with bitmaps of one width."""
    n, first = found["n"][lines], found["first"][lines]
    end = np.cumsum(n)
    all_ = np.arange(end[-1]) - np.repeat(end - n - first, n)
    bits = bitmaps(found["token"][all_], end - n, width)
    size = prefix_length(n)
    end = np.cumsum(size)
    index, of = np.arange(end[-1]) - np.repeat(end - size - first, size), np.repeat(np.arange(len(lines)), size)
    token = found["token"][index]
    if only is not None:
        keep = only.value.has(token)
        index, of, token = index[keep], of[keep], token[keep]
    rows = np.empty(len(of), _ROW[width])
    for name in ("doc", "sub", "line"):
        rows[name] = place[name][lines][of]
    rows["set"], rows["bits"], rows["token"] = found["set"][lines][of], bits[of], token >> np.uint64(32)
    rows["n"], rows["at"] = np.minimum(n, _LARGE)[of], np.minimum(found["at"][index], _LARGE)
    return token, rows


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys starts and ends."""
    start, end = runs_of(keys)
    at = np.flatnonzero(start == np.arange(len(keys)))
    return at, end[at]


class Meeting:
    """Rows of prefix words, in order of word and then size; equal sets of a word stand once, at their first place.

    gone holds the places of the lines whose set has an earlier line.
    """

    def __init__(self, blobs: list[tuple[int, bytes]]) -> None:
        by_width = {w: gathered([b for x, b in blobs if x == w], _ROW[w]) for w, _ in WIDTHS}
        self.gone = [gathered([b for x, b in blobs if x == 0], _PLACE)]
        token, sets, at = (np.concatenate([x[name] for x in by_width.values()]) for name in ("token", "set", "at"))
        order = np.argsort(token, kind="stable")
        start, end = runs_of(token[order])
        order = order[end - start > 1]
        # Copies of a set at a word: those runs alone are put in order of place.
        key = mix(sets[order] + mix(token[order].astype(np.uint64) << np.uint64(16) | at[order]))
        by_key = np.argsort(key, kind="stable")
        order, key = order[by_key], key[by_key]
        start, end = runs_of(key)
        once = start == np.arange(len(key))
        twice = end - start > 1
        rows = self._picked(by_width, order)
        if twice.any():
            own = np.flatnonzero(twice)
            sorted_ = own[np.lexsort((rows["line"][own], rows["sub"][own], rows["doc"][own], key[own]))]
            rows[own], order[own] = rows[sorted_], order[sorted_]
            place = np.empty(len(own), _PLACE)
            for name in _PLACE.names:
                place[name] = rows[name][own]
            first = np.maximum.accumulate(np.where(once[own], np.arange(len(own)), 0))
            self.gone.append(place[(rows["at"][own] == 0) & (place != place[first])])
        keep = np.flatnonzero(once & (rows["n"] > 3))  # smaller sets are similar to equal ones only
        by_size = np.argsort(rows["token"][keep].astype(np.uint64) << np.uint64(16) | rows["n"][keep], kind="stable")
        keep = keep[by_size]
        start, end = runs_of(rows["token"][keep])
        keep = keep[end - start > 1]
        self.rows, order = rows[keep], order[keep]
        self.n, self.at, self.set = (np.ascontiguousarray(self.rows[c]) for c in ("n", "at", "set"))
        self.n, self.at = self.n.astype(np.int32), self.at.astype(np.int32)
        self.rank = np.empty(len(self.rows), np.int32)
        self.rank[in_order(self.rows)] = np.arange(len(self.rows), dtype=np.int32)
        offsets = np.cumsum([0, *map(len, by_width.values())])
        self.width = np.array([w for w, _ in WIDTHS])[np.searchsorted(offsets, order, side="right") - 1] if len(order) else np.empty(0, np.int64)
        # Bitmaps by level: level k has those of 2^k words, of the sets that have at least so many.
        offsets = np.cumsum([0, *map(len, by_width.values())])
        self.width = np.array([w for w, _ in WIDTHS])[np.searchsorted(offsets, order, side="right") - 1] if len(order) else np.empty(0, np.int64)
        self.levels = []
        for level, _ in WIDTHS:
            at = np.full(len(self.rows), -1)
            own = np.flatnonzero(self.width >= level)
            at[own] = np.arange(len(own))
            bits = np.empty((len(own), level), np.uint64)
            for (w, found), base in zip(by_width.items(), offsets, strict=False):
                if w >= level:
                    mine = np.flatnonzero(self.width[own] == w)
                    wide = found["bits"][order[own[mine]] - base]
                    while wide.shape[1] > level:
                        half = wide.shape[1] // 2
                        wide = wide[:, :half] ^ wide[:, half:]
                    bits[mine] = wide
            self.levels.append((level, at, bits))
        self.start, self.end = runs_of(self.rows["token"])

    @staticmethod
    def _picked(by_width: dict[int, np.ndarray], order: np.ndarray) -> np.ndarray:
        """The rows of all widths at order, without their bitmaps."""
        rows = np.empty(len(order), _FIELDS)
        for name, _ in _FIELDS:
            rows[name] = np.concatenate([x[name] for x in by_width.values()])[order]
        return rows

    def passing(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which, gap, room) of pairs of rows of one word that pass the filters: places in which the bitmaps differ, and places in which those of similar sets can."""
        n, m = self.n[a], self.n[b]
        need = least_overlap(n, m)
        large = np.maximum(n, m) >= _LARGE
        ok = large | (np.minimum(n - self.at[a], m - self.at[b]) >= need) & (DEN * np.minimum(n, m) >= NUM * np.maximum(n, m))
        which = np.flatnonzero(ok)
        which = which[self.set[a[which]] != self.set[b[which]]]
        room, gap = np.where(large, 1 << 30, n + m - 2 * need), np.zeros(len(which), np.int64)
        for level, at, bits in self.levels:
            both = np.flatnonzero(np.minimum(self.width[a[which]], self.width[b[which]]) >= level)
            if not len(both):
                break
            far = np.bitwise_count(bits[at[a[which[both]]]] ^ bits[at[b[which[both]]]]).sum(axis=1, dtype=np.int64)
            gap[both] = far
            keep = np.ones(len(which), bool)
            keep[both] = far <= room[which[both]]
            which, gap = which[keep], gap[keep]
        return which, gap, room[which]

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        """(early, gap): for each row of a word that has MANY an earlier one that is clearly similar, as far as the first few show one; else -1."""
        early, gap = np.full(len(self.rows), -1), np.zeros(len(self.rows), np.int64)
        group = np.cumsum(self.start == np.arange(len(self.rows))) - 1
        by_rank = np.flatnonzero(self.end - self.start >= MANY)
        by_rank = by_rank[np.lexsort((self.rank[by_rank], group[by_rank]))]
        for _ in range(4):
            open_ = by_rank[early[by_rank] < 0]
            if not len(open_):
                break
            head = open_[np.concatenate(([True], group[open_[1:]] != group[open_[:-1]]))]
            first = np.full(group[-1] + 1, -1)
            first[group[head]] = head
            late = open_[first[group[open_]] != open_]
            which, far, room = self.passing(first[group[late]], late)
            clear = (10 * far <= 4 * room) & (room >= 8)
            late = late[which[clear]]
            early[late], gap[late] = first[group[late]], far[clear]
            by_rank = np.setdiff1d(by_rank, head, assume_unique=True)
            by_rank = by_rank[np.lexsort((self.rank[by_rank], group[by_rank]))]
            if 4 * len(late) < len(open_):
                break
        return early, gap

    def pairs(self, ask: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(late, early, gap, room): all passing pairs whose later row is asked for; with apart, only pairs of rows for which it differs.

        The smaller set of a similar pair holds their first common word within its first n - least_overlap(n, n) + 1 ones.
        """
        n, found = self.n, []
        short = (self.at < n - least_overlap(n, n) + 1) | (n >= _LARGE)
        index = np.flatnonzero(ask)
        for up in (True, False):
            active, k = index[short[index]] if up else index, 0
            while len(active):
                k += 1
                other = active + k if up else active - k
                inside = other < self.end[active] if up else other >= self.start[active]
                active, other = active[inside], other[inside]
                near = DEN * np.minimum(n[active], n[other]) >= NUM * np.maximum(n[active], n[other])
                active, other = active[near], other[near]
                pick = self.rank[other] < self.rank[active]
                if not up:
                    pick &= short[other]
                if apart is not None:
                    pick &= apart[active] != apart[other]
                late, early = active[pick], other[pick]
                which, gap, room = self.passing(early, late)
                if len(which):
                    found.append((late[which], early[which], gap, room))
        return tuple(np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int64) for k in range(4))


_FOUND = "kind int, late long, early long, late_doc long, late_sub long, late_line int, early_doc long, early_sub long, early_line int, far int, more int, blob binary"
#: Kinds of what meets: places of lines with an earlier copy, candidates, rows of words that may be hot.
GONE, PAIR, HOT_ROWS = 0, 1, 2


def _frame(kind: int, n: int, **given) -> pd.DataFrame:
    """n rows in the shape _FOUND; what is not given is 0."""
    out = {"kind": np.full(n, kind, np.int32)}
    for name, type_ in (x.split() for x in _FOUND.split(", ")[1:]):
        x = np.asarray(given.get(name, np.zeros(n, np.int64)))
        out[name] = given.get(name) if type_ == "binary" else x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64 if type_ == "long" else np.int32)
    return pd.DataFrame(out)


def _pairs(late: np.ndarray, early: np.ndarray, far: np.ndarray, more: np.ndarray) -> pd.DataFrame:
    sides = {f"{side}{field}": np.ascontiguousarray(x[name]) for side, x in (("late", late), ("early", early)) for field, name in (("", "set"), ("_doc", "doc"), ("_sub", "sub"), ("_line", "line"))}
    return _frame(PAIR, len(late), **sides, far=far, more=more)


def candidates(meeting: Meeting, wanted: np.ndarray | None = None, apart: np.ndarray | None = None, few: int = FIRST) -> pd.DataFrame:
    """Pairs of sets, later and earlier by first place, that share a prefix word and pass the filters.

    Of a word with many rows, a later set that is clearly similar to an early one by their bitmaps gets that pair (more is 1:
    others were not looked for); each other one gets its three nearest if the first is clear, else the few nearest (more says how many are left out). With wanted (set hashes), those sets get all of theirs and no others any.
    """
    rows = meeting.rows
    if wanted is not None:
        late, early, far, _ = meeting.pairs(np.isin(rows["set"], wanted), apart)
        return _pairs(rows[late], rows[early], far, np.zeros(len(late)))
    early, gap = meeting.settle() if apart is None and len(rows) else (np.full(len(rows), -1), np.zeros(len(rows), np.int64))
    late = np.flatnonzero(early >= 0)
    out = [(late, early[late], gap[late], np.ones(len(late), np.int64))]
    late, early, far, room = meeting.pairs(early < 0, apart)
    order = np.lexsort((early, far, late))
    late, early, far, room = late[order], early[order], far[order], room[order]
    start, end = runs_of(late)
    clear = (10 * far[start] <= 7 * room[start]) & (room[start] >= 8) if len(late) else np.empty(0, bool)
    most = np.where(clear, min(3, few), few)
    keep = np.arange(len(late)) - start < most
    out.append((late[keep], early[keep], far[keep], np.maximum(end - start - most, 0)[keep]))
    late, early, far, more = (np.concatenate([x[k] for x in out]) for k in range(4))
    return _pairs(rows[late], rows[early], far, more)


def _gone(meeting: Meeting) -> pd.DataFrame:
    gone = np.concatenate(meeting.gone)
    return _frame(GONE, len(gone), late_doc=gone["doc"], late_sub=np.ascontiguousarray(gone["sub"]), late_line=gone["line"])


def met(docs: DataFrame, counts, parts: int, only=None, asked: DataFrame | None = None) -> DataFrame:
    """Rows of kind GONE (places of lines with an earlier copy) and PAIR (candidates) of docs(doc, sub, text), from one pass over the texts.

    With only and asked(part, token, sets), pairs are just those of the sets asked for at each word. Rows of words that
    may be hot pass the first grouping untouched; their exact number then gives the blocks of which each pair is compared apart.
    """
    rows = prefixes(docs, counts, parts, only)

    def first(left: pd.DataFrame, sets: np.ndarray | None) -> pd.DataFrame:
        hot = left["token"] != 0
        some = left[hot]
        meeting = Meeting(list(zip(left["width"][~hot], left["blob"][~hot], strict=True)))
        sizes = [len(b) // _ROW[w].itemsize for w, b in zip(some["width"], some["blob"], strict=True)]
        held = _frame(HOT_ROWS, len(some), late=some["token"], far=some["width"], more=sizes, blob=some["blob"].to_numpy())
        return pd.concat([candidates(meeting, sets, None, FIRST), *([_gone(meeting)] if sets is None else []), held], ignore_index=True)

    def blocks_of(sets: np.ndarray, n: int) -> np.ndarray:
        return (mix(sets) % np.uint64(n)).astype(np.int64)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for token, width, n, blob in zip(batch["token"], batch["width"], batch["blocks"], batch["blob"], strict=True):
                own = np.frombuffer(blob, _ROW[width] if width else np.dtype("u8"))
                block = blocks_of(own["set"] if width else own, n)
                for b in np.unique(block).tolist():
                    bytes_ = own[block == b].tobytes()
                    out += [(token, min(b, j), max(b, j), b, width, bytes_) for j in range(n)]
            yield pd.DataFrame(out, columns=["token", "i", "j", "block", "width", "blob"])

    def second(left: pd.DataFrame, sets: np.ndarray | None) -> pd.DataFrame:
        meeting = Meeting(list(zip(left["width"], left["blob"], strict=True)))
        n, i, j = (int(left[c].iloc[0]) for c in ("blocks", "i", "j"))
        apart = None if i == j else blocks_of(meeting.rows["set"], n)
        return pd.concat([candidates(meeting, sets, apart, FIRST), *([_gone(meeting)] if sets is None and i == j else [])], ignore_index=True)

    def both(step, name: str):
        def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return step(left, gathered(right[name], np.dtype("u8"))) if len(left) else _frame(PAIR, 0)

        return run

    if asked is None:
        met_once = cut(rows.groupBy("part").applyInPandas(lambda g: first(g, None), _FOUND))
    else:
        cold = asked.where("token = 0").groupBy("part")
        met_once = cut(rows.groupBy("part").cogroup(cold).applyInPandas(both(first, "sets"), _FOUND))
    hot = met_once.where(f"kind = {HOT_ROWS}").select(F.col("late").alias("token"), F.col("far").alias("width"), "blob", "more")
    sizes = hot.groupBy("token").agg(F.ceil(F.sum("more") / HOT).cast("int").alias("blocks"))
    dealt_out = hot.drop("more").join(sizes, "token").mapInPandas(split, "token long, i int, j int, block int, width int, blob binary").join(sizes, "token")
    key = ["token", "i", "j"]
    if asked is None:
        rest = dealt_out.groupBy(*key).applyInPandas(lambda g: second(g, None), _FOUND)
    else:
        wanted = asked.where("token <> 0").select("token", F.lit(0).alias("width"), F.col("sets").alias("blob")).join(sizes, "token").mapInPandas(split, "token long, i int, j int, block int, width int, blob binary")
        rest = dealt_out.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInPandas(both(second, "blob"), _FOUND)
    return met_once.where(f"kind < {HOT_ROWS}").drop("blob").union(cut(rest).drop("blob"))


def with_sets(docs: DataFrame, wanted: DataFrame, counts) -> DataFrame:
    """(set, words, prefix): the sorted words of the sets wanted(set, doc, sub, line), and the prefix words, as bytes.

    Lines are picked in a pass over the texts by a filter on their places, and by an exact join after it; no text is shuffled.
    """

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = np.empty(len(batch), _PLACE)
            place["doc"], place["sub"], place["line"] = batch["doc"], batch["sub"].to_numpy(np.int64).view(np.uint64), batch["line"]
            yield pd.DataFrame({"key": place_key(place).view(np.int64)})

    picked = docs.sparkSession.sparkContext.broadcast(key_filter(wanted.select("doc", "sub", "line").mapInPandas(keys, "key long")))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks = rarity(counts.value)
        for batch, texts in chunks(batches):
            data, lines = some_lines(b"\n".join(texts), lambda n, batch=batch, texts=texts: picked.value.has(place_key(places(batch, texts, np.arange(n)))))
            if len(lines):
                got = line_sets(data, ranks)
                _, once = np.unique(got["set"], return_index=True)
                out = []
                for k in once.tolist():
                    at, n = got["first"][k], int(got["n"][k])
                    words = got["token"][at : at + n]
                    out.append((np.sort(words).tobytes(), words[: prefix_length(n)].tobytes()))
                yield pd.DataFrame({"set": got["set"][once].view(np.int64), "words": [x for x, _ in out], "prefix": [x for _, x in out]})

    return docs.mapInPandas(pick, "set long, words binary, prefix binary").join(wanted.select("set"), "set", "left_semi").dropDuplicates(["set"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(late) of pairs(late, early) that are similar by their whole sets, once each."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = np.empty(len(batch), bool)
            for k, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out[k] = DEN * both >= NUM * (len(x) + len(y) - both)
            yield pd.DataFrame({"late": batch["late"][out]})

    both = pairs.join(sets.select(F.col("set").alias("late"), F.col("words").alias("x")), "late").join(sets.select(F.col("set").alias("early"), F.col("words").alias("y")), "early")
    return both.mapInPandas(judge, "late long").distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    """(set, doc, sub, line) of both ends of pairs."""
    late = pairs.select(F.col("late").alias("set"), F.col("late_doc").alias("doc"), F.col("late_sub").alias("sub"), F.col("late_line").alias("line"))
    return late.union(pairs.select("early", "early_doc", "early_sub", "early_line")).groupBy("set").agg(F.min(F.struct("doc", "sub", "line")).alias("p")).select("set", "p.*")


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc, sub, line) of the lines of docs(doc, sub, text) that have an earlier match.

    Copies go first. A set that is left is judged against its nearest candidate, then against the next ones of each word, and
    sets whose first candidates all fail while there are others are judged against all of theirs after a second pass, over lines
    with their prefix words alone, so that no match is lost.
    """
    sc = docs.sparkSession.sparkContext
    counts = word_counts(docs)
    parts = max(8, -(-int(counts.sum()) // (5 * PART_ROWS)))
    shared = sc.broadcast(counts)
    found = met(docs, shared, parts)
    gone = found.where(f"kind = {GONE}").select(F.col("late_doc").alias("doc"), F.col("late_sub").alias("sub"), F.col("late_line").alias("line"))
    pairs = found.where(f"kind = {PAIR}").groupBy("late", "early").agg(F.min("far").alias("far"), F.max("more").alias("more"), F.first(F.struct("late_doc", "late_sub", "late_line", "early_doc", "early_sub", "early_line")).alias("p"))
    pairs = cut(pairs.withColumn("turn", F.row_number().over(Window.partitionBy("late").orderBy("far", "early"))).select("late", "early", "more", "turn", "p.*"))
    sets = cut(with_sets(docs, _ends(pairs), shared))
    nearest = cut(verified(pairs.where("turn = 1").select("late", "early"), sets))
    next_ = verified(pairs.where("turn > 1").join(nearest, "late", "left_anti").select("late", "early"), sets)
    matched = cut(nearest.union(next_))
    places_ = pairs.select(F.col("late").alias("set"), F.col("late_doc").alias("doc"), F.col("late_sub").alias("sub"), F.col("late_line").alias("line")).distinct()
    more = pairs.where("more > 0").select(F.col("late").alias("set")).distinct()
    open_ = cut(more.join(matched.select(F.col("late").alias("set")), "set", "left_anti").join(sets, "set"))
    if not open_.isEmpty():
        matched = matched.union(matched_again(docs, shared, parts, open_, sets))
    return gone.union(places_.join(matched.select(F.col("late").alias("set")).distinct(), "set", "left_semi").select("doc", "sub", "line"))


def matched_again(docs: DataFrame, counts, parts: int, open_: DataFrame, sets: DataFrame) -> DataFrame:
    """(late) of the sets open_(set, words, prefix) that have an earlier match, judged against all of their candidates."""
    sc = docs.sparkSession.sparkContext

    def spread_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [np.frombuffer(x, np.uint64) for x in batch["prefix"]]
            own = np.repeat(batch["set"].to_numpy(np.int64), [len(k) for k in keys])
            tokens = np.concatenate(keys) if keys else np.empty(0, np.uint64)
            hot = counts.value[(tokens & np.uint64(BUCKETS - 1)).astype(np.intp)] > HOT
            out = [(p, 0, b) for p, b in dealt(tokens[~hot], own[~hot], parts)]
            out += [(0, int(t.view(np.int64)) or 1, s.tobytes()) for t, s in zip(tokens[hot], own[hot], strict=True)]
            yield pd.DataFrame(out, columns=["part", "token", "sets"])

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": np.frombuffer(b"".join(batch["prefix"]), np.int64)})

    only = sc.broadcast(key_filter(open_.select("prefix").mapInPandas(tokens, "key long")))
    asked = open_.select("set", "prefix").mapInPandas(spread_out, "part int, token long, sets binary")
    rest = cut(met(docs, counts, parts, only, asked).where(f"kind = {PAIR}").dropDuplicates(["late", "early"]))
    have = sets.join(_ends(rest), "set", "left_semi")
    new = with_sets(docs, _ends(rest).join(sets, "set", "left_anti"), counts)
    return verified(rest.select("late", "early"), have.union(new))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_lines, removed): one row per row of docs, removed the sorted numbers of its lines that have an earlier match.

    Lines are earlier by document id, then by the text's hash (xxhash64, unsigned) and then by line number. A line without words is never
    removed; a null text has no lines; rows of one id and text are one document, rows of one id and several texts are several; a
    missing id stands before all others; very long lines and texts are ordinary; an empty table gives an empty result.
    Other columns are not read, whatever their names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    least = F.lit(-(1 << 63))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.when(F.col(text_col).isNull(), 0).otherwise(breaks + 1).cast("int").alias("n_lines"))
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), least).alias("doc"), F.xxhash64(text).alias("sub"), text.alias("text"))
    removed = removed_lines(keyed).groupBy("doc", "sub").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    out = rows.withColumn("doc", F.coalesce("doc_id", least)).join(removed.withColumnRenamed("sub", "text_hash"), ["doc", "text_hash"], "left")
    return out.select("doc_id", "text_hash", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def without_lines(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the lines that decided (see dedup_lines) lists taken out of the text.

    Every row stays; a null text stays null, a text that loses all of its lines is empty; columns may have any names.
    """
    own, hashed, gone = fresh(docs, "id"), fresh(docs, "hash"), fresh(docs, "gone")
    mine = decided.where(F.size("removed") > 0).select(F.col("doc_id").alias(own), F.col("text_hash").alias(hashed), F.col("removed").alias(gone)).dropDuplicates([own, hashed])
    kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.array_contains(gone, i))
    same = docs[id_col].cast("long").eqNullSafe(mine[own]) & (F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))) == mine[hashed])
    return docs.join(mine, same, "left").withColumn(text_col, F.when(F.size(gone) > 0, F.array_join(kept, "\n")).otherwise(F.col(text_col))).drop(own, hashed, gone)


def op2(spark, sf_dir: str) -> DataFrame:
    """The lines that dedup_lines removes, over all documents; odd rows as there."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), F.array_join("removed", ",").alias("removed"))
