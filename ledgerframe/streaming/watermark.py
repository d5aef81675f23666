"""The contiguous watermark of each identity as keyed state of a stream: what is above it is kept as spans of cursors, by block."""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Cursors of a block; a micro-batch loads and stores only the blocks that it touches.
BLOCK = 1 << 16
MARKED = "identity string, watermark bigint, open_cursors bigint, updated_at_ms bigint"
_FOLDED = "identity string, lo bigint, hi bigint, status string, updated_at_ms bigint, own boolean"


def spans_of(cursors: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) of each run of consecutive numbers in sorted distinct cursors."""
    ends = np.flatnonzero(np.diff(cursors) != 1)
    return zip(cursors[np.r_[0, ends + 1]].tolist(), cursors[np.r_[ends, len(cursors) - 1]].tolist(), strict=True) if len(cursors) else iter(())


def folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Before the exchange: completed cursors of an identity as spans, of others the newest version of each cursor."""
    for batch in batches:
        done = (batch["status"] == "completed") & batch["own"]
        rows = [(i, lo, hi, "completed", int(g["updated_at_ms"].max()), True) for i, g in batch[done].groupby("identity") for lo, hi in spans_of(np.unique(g["cursor"].to_numpy(np.int64)))]
        rest = batch[~done].sort_values(["updated_at_ms", "status"]).drop_duplicates(["identity", "cursor", "own"], keep="last")
        rows += list(zip(rest["identity"], rest["cursor"], rest["cursor"], rest["status"], rest["updated_at_ms"], rest["own"], strict=True))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _FOLDED.split(", ")])


class Held:
    """A block's completed spans, sorted and apart, and its cursors that are known but not completed, with their newest version."""

    def __init__(self, text: str | None) -> None:
        found = json.loads(text) if text else {"spans": [], "open": {}}
        self.spans = found["spans"]
        self.open = {int(c): tuple(v) for c, v in found["open"].items()}

    def text(self) -> str | None:
        return json.dumps({"spans": self.spans, "open": self.open}) if self.spans or self.open else None

    def covering(self, cursor: int):
        at = bisect_left(self.spans, [cursor + 1]) - 1
        return self.spans[at] if at >= 0 and self.spans[at][1] >= cursor else None

    def complete(self, lo: int, hi: int) -> None:
        """Adds a span, joined with those that it meets; cursors inside are open no longer."""
        a = bisect_left(self.spans, [lo])
        if a and self.spans[a - 1][1] >= lo - 1:
            a -= 1
        b = a
        while b < len(self.spans) and self.spans[b][0] <= hi + 1:
            lo, hi, b = min(lo, self.spans[b][0]), max(hi, self.spans[b][1]), b + 1
        self.spans[a:b] = [[lo, hi]]
        if self.open:
            self.open = {c: v for c, v in self.open.items() if not lo <= c <= hi}


class Watermarks(StatefulProcessor):
    """State of an identity: its watermark, its first cursor, how many cursors are open, and the blocks above the watermark."""

    def __init__(self, initial: int | None) -> None:
        self.initial = initial

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "watermark long, first long, open_cursors long")
        self.blocks = handle.getMapState("blocks", "block long", "held string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803 (names of the interface)
        mark, first, n_open = self.mark.get() if self.mark.exists() else (self.initial, None, 0)
        loaded: dict[int, Held] = {}

        def block(b: int) -> Held:
            if b not in loaded:
                loaded[b] = Held(self.blocks.getValue((b,))[0] if self.blocks.containsKey((b,)) else None)
            return loaded[b]

        told = [tuple(r) for frame in rows for r in frame[["own", "status", "lo", "hi", "updated_at_ms"]].itertuples(index=False)]
        newest = max((int(r[4]) for r in told), default=0)
        # Own completions first, then what is open, then repairs, so that the order within a micro-batch doesn't matter.
        for own, status, lo, hi, ms in sorted(told, key=lambda r: (not r[0], r[1] != "completed" if r[0] else 0, r[2], r[4])):
            lo, hi, ms, done = int(lo), int(hi), int(ms), status == "completed"
            lo = lo if mark is None else max(lo, mark + 1)
            if lo > hi:
                continue
            first = lo if first is None else min(first, lo)
            for b in range(lo // BLOCK, hi // BLOCK + 1):
                held, a, z = block(b), max(lo, b * BLOCK), min(hi, (b + 1) * BLOCK - 1)
                before = len(held.open)
                if done and (own or a not in held.open or (ms, status) > held.open[a]):
                    held.complete(a, z)
                elif not done and held.covering(a) is None:
                    held.open[a] = max(held.open.get(a, (ms, status)), (ms, status))
                n_open += len(held.open) - before
        reached = mark if mark is not None else (first - 1 if first is not None else None)
        while reached is not None and (span := block((reached + 1) // BLOCK).covering(reached + 1)):
            reached = span[1]
            if (reached + 1) % BLOCK == 0:
                held = loaded[reached // BLOCK]
                held.spans, held.open = [], {}
        if reached is not None and (mark is not None or reached >= first):
            mark = reached
            if (held := loaded.get((mark + 1) // BLOCK)) is not None:
                held.spans = [s for s in held.spans if s[1] > mark]
        for b, held in loaded.items():
            text = held.text()
            if text:
                self.blocks.updateValue((b,), (text,))
            elif self.blocks.containsKey((b,)):
                self.blocks.removeKey((b,))
        self.mark.update((mark, first, n_open))
        yield pd.DataFrame({"identity": [key[0]], "watermark": pd.array([mark], "Int64"), "open_cursors": [n_open], "updated_at_ms": [newest]})

    def close(self) -> None:
        pass


def watermarks(state: DataFrame, initial: int | None = None, repairs: DataFrame | None = None) -> DataFrame:
    """A stream of (identity, watermark, open_cursors, updated_at_ms), a row for each identity that a micro-batch touches.

    state and repairs are streams of (identity, cursor, status, updated_at_ms). A cursor that was ever completed by state stays
    completed; one of repairs counts if its version (updated_at_ms, status) is newer than the newest one of state that has come. Without
    `initial` an identity starts at its first cursor and its watermark is NULL until that is completed. Rows at or below a
    watermark change nothing. One identity's rows meet in one task, folded into spans before. Needs the RocksDB state store.
    """
    cols = ["identity", "cursor", "status", "updated_at_ms"]
    rows = state.select(*cols, F.lit(True).alias("own"))
    if repairs is not None:
        rows = rows.union(repairs.select(*cols, F.lit(False).alias("own")))
    return rows.mapInPandas(folded, _FOLDED).groupBy("identity").transformWithStateInPandas(Watermarks(initial), MARKED, "Update", "None")
