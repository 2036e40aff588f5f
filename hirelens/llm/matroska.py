"""Media columns: texts as 8-bit samples in Matroska files, and a Matroska parser that gives packet tables.

A file holds an EBML header and one segment: info, tracks (one PCM track of 8-bit samples), clusters of
fixed-size laced SimpleBlocks (a frame is FRAME samples), and cues with each cluster's timestamp and position.
The parser reads any nesting of the elements it knows, sizes of 1 to 8 bytes, unknown sizes of segment and cluster,
SimpleBlocks and BlockGroups, and all four lacings; it returns one packet for each frame with its track, timestamp and
byte range.  Elements it doesn't know are stepped over.

Edge cases: a very long text is one file (under 2 GB, as any cell); a null text counts as empty, and an empty text gives one frame of blanks; null doc_id passes through;
repeated rows give repeated, equal results; an empty table gives no rows; damaged files raise ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .runtime import by_batch, cut, staged, texts

#: Samples in a frame; frames in a lace at most; laces in a cluster at most; samples in a second.
FRAME, LACE, BLOCKS, RATE = 192, 64, 16, 8000
#: Packets of one batch of the packet table.
PACKETS = 100_000
PAD = b" "

# Matroska element ids.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
EBML_VERSION, EBML_READ, EBML_ID_LENGTH, EBML_SIZE_LENGTH = 0x4286, 0x42F7, 0x42F2, 0x42F3
DOC_TYPE, DOC_VERSION, DOC_READ = 0x4282, 0x4287, 0x4285
SCALE, DURATION, MUXER, WRITER = 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACK, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, AUDIO, FREQUENCY, CHANNELS, DEPTH = 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0xE7, 0xA3, 0xA0, 0xA1
CUE, CUE_TIME, CUE_PLACES, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1

PARENTS = {SEGMENT, INFO, TRACKS, TRACK, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE, CUE_PLACES, EBML}
UNKNOWN = -1


def size_bytes(n: int) -> bytes:
    """The shortest EBML size; all ones is left for unknown sizes."""
    width = 1
    while n >= (1 << (7 * width)) - 1:
        width += 1
    return (n | 1 << (7 * width)).to_bytes(width, "big")


def element(eid: int, body: bytes) -> bytes:
    return eid.to_bytes((eid.bit_length() + 7) // 8, "big") + size_bytes(len(body)) + body


def number(eid: int, n: int) -> bytes:
    return element(eid, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def padded(body: bytes, unit: int = FRAME) -> bytes:
    """body and blanks up to a positive multiple of unit."""
    return body + PAD * (-len(body) % unit if body else unit)


_HEADER = element(EBML, number(EBML_VERSION, 1) + number(EBML_READ, 1) + number(EBML_ID_LENGTH, 4) + number(EBML_SIZE_LENGTH, 8) + element(DOC_TYPE, b"matroska") + number(DOC_VERSION, 4) + number(DOC_READ, 2))
_TRACKS = element(TRACKS, element(TRACK, number(TRACK_NUMBER, 1) + number(TRACK_UID, 1) + number(TRACK_TYPE, 2) + element(CODEC, b"A_PCM/INT/LIT") + element(AUDIO, element(FREQUENCY, struct.pack(">d", RATE)) + number(CHANNELS, 1) + number(DEPTH, 8))))


def write_media(payload: bytes) -> bytes:
    """A Matroska file whose frames hold the payload, a positive multiple of FRAME bytes."""
    frames = len(payload) // FRAME
    millis = FRAME * 1000 // RATE  # a frame lasts 24 ms
    info = element(INFO, number(SCALE, 1_000_000) + element(DURATION, struct.pack(">d", frames * millis)) + element(MUXER, b"hirelens") + element(WRITER, b"hirelens"))
    parts, place, cues = [info, _TRACKS], len(info) + len(_TRACKS), []
    for first in range(0, frames, LACE * BLOCKS):
        blocks = [number(TIMESTAMP, first * millis)]
        for f in range(first, min(frames, first + LACE * BLOCKS), LACE):
            n = min(LACE, frames - f, first + LACE * BLOCKS - f)
            head = b"\x81" + ((f - first) * millis).to_bytes(2, "big", signed=True)
            # Flags: key frame, then fixed-size lacing if the block holds several frames.
            head += b"\x80" if n == 1 else b"\x84" + bytes([n - 1])
            blocks.append(element(SIMPLE_BLOCK, head + payload[f * FRAME : (f + n) * FRAME]))
        cluster = element(CLUSTER, b"".join(blocks))
        cues.append(element(CUE, number(CUE_TIME, first * millis) + element(CUE_PLACES, number(CUE_TRACK, 1) + number(CUE_CLUSTER, place))))
        parts.append(cluster)
        place += len(cluster)
    parts.append(element(CUES, b"".join(cues)))
    return _HEADER + element(SEGMENT, b"".join(parts))


def read_vint(data: bytes, at: int, is_id: bool = False) -> tuple[int, int]:
    """(value, next place); an id keeps its length bits, an unknown size is UNKNOWN."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no variable-length integer at {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise ValueError(f"cut off at {at}")
    n = int.from_bytes(data[at : at + width], "big")
    if is_id:
        return n, at + width
    n &= (1 << 7 * width) - 1
    return (UNKNOWN if n == (1 << 7 * width) - 1 else n), at + width


def walk(data: bytes, at: int = 0, end: int | None = None, depth: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """(id, depth, body start, body end) of each element, parents first."""
    end = len(data) if end is None else end
    while at < end:
        eid, at = read_vint(data, at, True)
        size, at = read_vint(data, at)
        if size == UNKNOWN:
            if eid not in (SEGMENT, CLUSTER):
                raise ValueError(f"element {eid:x} at {at} has no size")
            stop = end
            if eid == CLUSTER:  # it ends where the next element of its parent's level begins
                stop = at
                while stop < end:
                    child, body = read_vint(data, stop, True)
                    if child in (CLUSTER, CUES, INFO, TRACKS):
                        break
                    n, body = read_vint(data, body)
                    stop = body + n
        else:
            stop = at + size
        if stop > end:
            raise ValueError(f"element {eid:x} at {at} passes its parent's end")
        yield eid, depth, at, stop
        if eid in PARENTS:
            yield from walk(data, at, stop, depth + 1)
        at = stop


@dataclass
class Packets:
    """Frames in file order: track, timestamp in ns, byte range, as arrays of 64-bit integers."""

    track: array
    time: array
    start: array
    end: array
    cues: list[tuple[int, int]]
    tracks: dict[int, dict]
    clusters: list[int]


def lace_sizes(data: bytes, at: int, end: int, lacing: int) -> tuple[int, list[int]]:
    """(place of the first frame, sizes of the frames) of a block's body after its flags."""
    if not lacing:
        return at, [end - at]
    n, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if lacing == 2:
        if (end - at) % n:
            raise ValueError(f"frames of one size do not fill the block at {at}")
        return at, [(end - at) // n] * n
    if lacing == 1:
        for _ in range(n - 1):
            total = 0
            while True:
                total, at, b = total + data[at], at + 1, data[at]
                if b < 255:
                    break
            sizes.append(total)
    else:
        for k in range(n - 1):
            before = at
            v, at = read_vint(data, at)
            sizes.append(v if not k else sizes[-1] + v - ((1 << (7 * (at - before) - 1)) - 1))
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError(f"frames pass the end of the block at {at}")
    return at, sizes


def read_packets(data: bytes) -> Packets:
    """The packet table of a file; broken files give a ValueError."""
    try:
        return _read_packets(data)
    except (IndexError, struct.error) as e:
        raise ValueError(f"the file ends within an element: {e}") from e


def _read_packets(data: bytes) -> Packets:
    out = Packets(array("q"), array("q"), array("q"), array("q"), [], {}, [])
    scale, cluster_time, segment, frame_ns, cue_time, current = 1_000_000, 0, 0, {}, 0, {}
    for eid, _, at, end in walk(data):
        n = lambda: int.from_bytes(data[at:end], "big")  # noqa: B023, E731
        if eid == SEGMENT:
            segment = at
        elif eid == SCALE:
            scale = n()
        elif eid == TRACK:
            current = {}
        elif eid == TRACK_NUMBER:
            out.tracks[n()] = current
        elif eid == CODEC:
            current["codec"] = data[at:end].decode("ascii")
        elif eid == FREQUENCY:
            current["rate"] = struct.unpack(">d" if end - at == 8 else ">f", data[at:end])[0]
        elif eid == CHANNELS:
            current["channels"] = n()
        elif eid == DEPTH:
            current["depth"] = n()
        elif eid == CLUSTER:
            out.clusters.append(at)
        elif eid == TIMESTAMP:
            cluster_time = n()
        elif eid == CUE_TIME:
            cue_time = n()
        elif eid == CUE_CLUSTER:
            out.cues.append((cue_time * scale, segment + n()))
        elif eid in (SIMPLE_BLOCK, BLOCK):
            track, at = read_vint(data, at)
            time, flags = struct.unpack(">hB", data[at : at + 3])
            at, sizes = lace_sizes(data, at + 3, end, flags >> 1 & 3)
            begin = (cluster_time + time) * scale
            t = out.tracks.get(track, {})
            ns = 1e9 * 8 / (t.get("rate", 0) * t.get("channels", 1) * t.get("depth", 8)) if t.get("rate") else 0
            elapsed = 0
            for size in sizes:
                out.track.append(track)
                out.time.append(begin + round(elapsed * ns))
                out.start.append(at)
                out.end.append(at + size)
                at += size
                elapsed += size
    return out


def payload_of(data: bytes, packets: Packets) -> bytes:
    """The frames' bytes in file order; frames that touch are copied as one run."""
    runs, begin, end = [], None, None
    for s, e in zip(packets.start, packets.end, strict=True):
        if s != end:
            if begin is not None:
                runs.append(data[begin:end])
            begin = s
        end = e
    if begin is not None:
        runs.append(data[begin:end])
    return b"".join(runs)


def feature_of(payload: bytes, packets: Packets) -> str:
    """Packets, clusters, last timestamp in ms, and of the samples: mean, deviation, crossings of the middle value."""
    x = np.frombuffer(payload, np.uint8)
    mean = float(x.mean(dtype=np.float64))
    high = x > 100
    return f"packets={len(packets.start)};clusters={len(packets.clusters)};cues={len(packets.cues)};last_ms={packets.time[-1] // 1_000_000};mean={mean:.3f};std={float(x.std(dtype=np.float64)):.3f};crossings={int(np.count_nonzero(high[1:] != high[:-1]))}"


MEDIA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (of the text as UTF-8) and media: each whole text as a Matroska file."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = [(t or "").encode() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(b) for b in bodies], pa.int64()), pa.array([write_media(padded(b)) for b in bodies], pa.binary())], ["doc_id", "n_bytes", "media"])

    return texts(docs).mapInArrow(by_batch(f), "doc_id long, n_bytes long, media binary")


def store_media(docs: DataFrame) -> DataFrame:
    """to_media() written to the shared folder and read back."""
    return staged(to_media(docs), "media")


def packet_table(media: DataFrame) -> DataFrame:
    """A row for each packet of each file of to_media(): doc_id, packet, track, time_ns, byte_start, byte_end."""
    names = ["doc_id", "packet", "track", "time_ns", "byte_start", "byte_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in cut(whole, "media"):
                for d, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    p = read_packets(m)
                    for at in range(0, len(p.track), PACKETS):
                        part = [np.frombuffer(x, np.int64)[at : at + PACKETS] for x in (p.track, p.time, p.start, p.end)]
                        n = len(part[0])
                        yield pa.RecordBatch.from_arrays([pa.array([d] * n, pa.int64()), pa.array(np.arange(at, at + n)), *map(pa.array, part)], names)

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, packet long, track long, time_ns long, byte_start long, byte_end long")


def media_features(docs: DataFrame) -> DataFrame:
    """Store each whole text as media, read the stored bytes back, and describe them (columns MEDIA)."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for d, n, media in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            packets = read_packets(media)
            payload = payload_of(media, packets)
            rows.append((d, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(payload, packets)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return store_media(docs).mapInArrow(by_batch(f, "media"), MEDIA)
