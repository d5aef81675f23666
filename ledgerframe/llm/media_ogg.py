"""Ogg media columns: store bytes as 8-bit samples in a multiplexed Ogg stream, check and take it apart again.

A stored value holds two logical streams: unsigned 8-bit PCM (identification header, comment header, data packets) and a
small index stream. Reading verifies each page's checksum, joins packets from lacing values, sorts them by serial number
and derives times from granule positions. Work is per row in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerframe.llm.common import table

RATE = 8000
FRAMES = 4096
#: Serial numbers of the two logical streams.
AUDIO, INDEX = 0x50434D38, 0x494E4458
#: The page header (magic, version, flags, granule, serial, sequence, checksum, segments) and its flags.
PAGE = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
#: Fixed value: the PCM identification header (big-endian; magic, version, format U8, rate, bits, channels, frames, extras).
HEADER = struct.Struct(">8sHHIIBBHI")
_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(page: bytes) -> int:
    """The page checksum (polynomial 04C11DB7, most significant bit first, start 0): zlib's CRC of the bit-reversed bytes."""
    return int.from_bytes((zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF).to_bytes(4, "little").translate(_REVERSED), "big")


def pages(packets: list[tuple[bytes, int]], serial: int, per_page: int = 15) -> list[bytes]:
    """The pages of one logical stream. packets: (data, granule position after it); headers, at granule 0, get pages of their own."""
    groups: list[tuple[list[int], bytes, int, bool]] = []
    lacing, body, granule, continued = [], b"", -1, False

    def close() -> None:
        nonlocal lacing, body, granule, continued
        groups.append((lacing, body, granule, continued))
        lacing, body, granule, continued = [], b"", -1, False

    for data, after in packets:
        sizes = [255] * (len(data) // 255) + [len(data) % 255]
        at = 0
        while sizes:
            room = 255 - len(lacing)
            take, sizes = sizes[:room], sizes[room:]
            lacing, body, at = lacing + take, body + data[at : at + sum(take)], at + sum(take)
            if sizes:
                close()
                continued = True
        granule = after
        if not after or len(lacing) >= 17 * per_page:
            close()
    if lacing:
        close()
    out = []
    for k, (lacing, body, granule, continued) in enumerate(groups):
        flags = CONTINUED * continued | FIRST * (k == 0) | LAST * (k == len(groups) - 1)
        head = PAGE.pack(b"OggS", 0, flags, granule, serial, k, 0, len(lacing)) + bytes(lacing)
        out.append(head[:22] + checksum(head + body).to_bytes(4, "little") + head[26:] + body)
    return out


def store(payload: bytes, rate: int = RATE) -> bytes:
    """The Ogg form of payload, a sample for each byte. Equal payloads give equal bytes."""
    audio = [(HEADER.pack(b"PCM     ", 0, 1, rate, 8, 1, 0, FRAMES, 0), 0), (struct.pack("<II", 0, 0), 0)]
    audio += [(payload[at : at + FRAMES], min(at + FRAMES, len(payload))) for at in range(0, len(payload), FRAMES)]
    index = [(b"INDEX\0\0\0", 0), (struct.pack("<QI", len(payload), zlib.crc32(payload)), len(payload))]
    a, b = pages(audio, AUDIO), pages(index, INDEX)
    return b"".join([a[0], b[0], *a[1:-1], *b[1:], *a[-1:]])


def take_apart(media: bytes) -> dict:
    """streams: serial to packets (data, granule position or -1); pages: how many were whole; bad: checksums or sequences that failed.

    A page that fails is passed over, and a packet that it held a part of is left out.
    """
    streams: dict[int, list[tuple[bytes, int]]] = {}
    parts: dict[int, list[bytes]] = {}
    expected: dict[int, int] = {}
    good = bad = at = 0
    while (at := media.find(b"OggS", at)) >= 0:
        if at + 27 > len(media):
            bad += 1
            break
        _, version, flags, granule, serial, number, crc, n = PAGE.unpack_from(media, at)
        lacing = media[at + 27 : at + 27 + n]
        start = at + 27 + n
        end = start + sum(lacing)
        if version or end > len(media) or checksum(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) != crc:
            bad, at = bad + 1, at + 4
            continue
        good += 1
        packets, part = streams.setdefault(serial, []), parts.setdefault(serial, [])
        skip = False
        if number != expected.get(serial, 0):
            bad, skip = bad + 1, bool(flags & CONTINUED)
            part.clear()
        elif bool(flags & CONTINUED) != bool(part):
            skip = bool(flags & CONTINUED)
            part.clear()
        expected[serial] = number + 1
        ends, done, from_ = [k for k, x in enumerate(lacing) if x < 255], 0, start
        for k in ends:
            to = from_ + 255 * (k - done) + lacing[k]
            part.append(media[from_:to])
            if not skip:
                packets.append((b"".join(part), granule if k == ends[-1] else -1))
            part.clear()
            skip, done, from_ = False, k + 1, to
        if from_ < end or (lacing and lacing[-1] == 255):
            part.append(media[from_:end])
        at = end
    return {"streams": streams, "pages": good, "bad": bad}


def read_back(media: bytes) -> tuple[bytes, dict]:
    """The payload of stored media, and what reading showed: pages, packets, bad, ms (from the last granule position)."""
    found = take_apart(media)
    audio = found["streams"].get(AUDIO, [])
    rate = HEADER.unpack(audio[0][0])[3] if audio and len(audio[0][0]) == HEADER.size else RATE
    last = max((g for _, g in audio), default=0)
    facts = {"pages": found["pages"], "packets": sum(map(len, found["streams"].values())), "bad": found["bad"], "ms": 1000 * max(last, 0) // rate}
    return b"".join(data for data, _ in audio[2:]), facts


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes of text (null: none) with zeros up to a positive multiple of 64, and their number before that."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes(max(64, -(-len(data) // 64) * 64) - len(data)), len(data)


def with_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text stored as Ogg; a null text is an empty one, extra columns are not read."""

    @F.pandas_udf("struct<n_bytes:long,media:binary>")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            made = [payload_of(x) for x in batch]
            yield pd.DataFrame({"n_bytes": np.array([n for _, n in made], np.int64), "media": [store(p) for p, _ in made]})

    return docs.select(F.col(id_col).alias("doc_id"), encode(F.col(text_col).cast("string")).alias("m")).select("doc_id", "m.*")


def media_features(media: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) of with_media's rows, from the stored bytes alone.

    feature: pages, packets, failed pages, milliseconds, mean sample (thousandths) and crossings of the middle line.
    Equal media give equal rows; null or broken media give what can still be read, with its failures counted.
    """
    kind = "struct<payload_bytes:long,payload_sha256:string,tail_crc32:long,media_bytes:long,media_sha256:string,feature:string>"

    def one(stored: bytes) -> tuple:
        stored = stored or b""
        payload, facts = read_back(stored)
        x = np.frombuffer(payload, np.uint8)
        mean, cross = (1000 * int(x.sum(dtype=np.int64)) // len(x), int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))) if len(x) else (0, 0)
        feature = " ".join(f"{k}={v}" for k, v in {**facts, "mean": mean, "cross": cross}.items())
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature

    @F.pandas_udf(kind)
    def read(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for batch in values:
            yield pd.DataFrame([one(x) for x in batch], columns=names)

    return media.select("doc_id", "n_bytes", read("media").alias("m")).select("doc_id", "n_bytes", "m.*")


def packets(media: DataFrame) -> DataFrame:
    """(doc_id, serial, packet, ms, data): every packet of with_media's rows; ms, where a granule position tells it, is its end."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (i, serial, k, 1000 * g // RATE if g >= 0 else None, data)
                for i, stored in zip(batch["doc_id"], batch["media"], strict=True)
                for serial, found in take_apart(stored or b"")["streams"].items()
                for k, (data, g) in enumerate(found)
            ]
            out = pd.DataFrame(rows, columns=["doc_id", "serial", "packet", "ms", "data"])
            yield out.astype({"ms": "Int64"})

    return media.select("doc_id", "media").mapInPandas(split, f"doc_id {media.schema['doc_id'].dataType.simpleString()}, serial long, packet int, ms long, data binary")


def op7(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of media_features over all documents; a null text is an empty one, repeated rows are stored alike."""
    return media_features(with_media(table(spark, sf_dir, "documents")))
