"""Operator 8, media columns: Matroska files as columns, and their packets as tables.

``parse`` reads any Matroska or WebM file: EBML elements of variable length (also of unknown size),
tracks, clusters, SimpleBlocks and BlockGroups with no, Xiph, EBML or fixed-size lacing, and cues.
It gives a packet table: track, timestamp, key flag and byte range of every frame. ``mux`` writes
a payload as 8-bit PCM: frames of ``FRAME`` samples, fixed-size lacing within a block, clusters of
``CLUSTER_BLOCKS`` blocks, and a cue for each cluster, so a reader can seek.

Defined results: null text is empty; an empty payload is one frame of 255s. Every row gives one row,
repeated rows too; doc_id may be null; equal texts give equal values. A text of any length is whole.
Bytes that are not Matroska raise ValueError. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, store

# Element ids of the Matroska and EBML specifications.
EBML, SEGMENT, SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x114D9B74, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TAGS, CHAPTERS, ATTACHMENTS = 0x1254C367, 0x1043A770, 0x1941A469
TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, CODEC_ID, DEFAULT_DURATION = 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86, 0x23E383
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE_BLOCK = 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_VERSION, DOC_READ_VERSION = 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
#: Elements that end a cluster, or a segment's other child, of unknown size.
_TOP = {SEGMENT, SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES, TAGS, CHAPTERS, ATTACHMENTS, EBML}

FRAME, FRAMES_PER_BLOCK, CLUSTER_BLOCKS, RATE = 576, 8, 16, 8000
UNKNOWN = -1


def vint(value: int, width: int = 0) -> bytes:
    """An EBML size: as few bytes as hold it (all ones is kept for unknown sizes), or ``width``."""
    if not width:
        width = 1
        while value >= (1 << 7 * width) - 1:
            width += 1
    return (value | 1 << 7 * width).to_bytes(width, "big")


def read_vint(b: bytes, at: int) -> tuple[int, int]:
    """Value and end of the size at ``at``; UNKNOWN if all its bits are ones."""
    if at >= len(b) or not b[at]:
        raise ValueError(f"no EBML size at byte {at}")
    width = 9 - b[at].bit_length()
    if at + width > len(b):
        raise ValueError(f"EBML size cut off at byte {at}")
    value = int.from_bytes(b[at : at + width], "big") ^ 1 << 7 * width
    return (UNKNOWN if value == (1 << 7 * width) - 1 else value), at + width


def read_id(b: bytes, at: int) -> tuple[int, int]:
    if at >= len(b) or not b[at] >> 4:
        raise ValueError(f"no element id at byte {at}")
    width = 9 - b[at].bit_length()
    return int.from_bytes(b[at : at + width], "big"), at + width


def element(kind: int, body: bytes, size_width: int = 0) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + vint(len(body), size_width) + body


def _uint(kind: int, value: int, width: int = 0) -> bytes:
    return element(kind, value.to_bytes(width or max(1, (value.bit_length() + 7) // 8), "big"))


def elements(b: bytes, at: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, id, body start, body end) of the elements in b[at:end]; one of unknown size ends where an
    element of the upper level begins."""
    while at < end:
        start = at
        kind, at = read_id(b, at)
        size, at = read_vint(b, at)
        if size == UNKNOWN:
            stop = at
            while stop < end:
                inner, then = read_id(b, stop)
                if kind != SEGMENT and inner in _TOP:
                    break
                more, then = read_vint(b, then)
                if more == UNKNOWN:  # only a segment's children may be so, and it runs to the end
                    stop = end
                    break
                stop = then + more
        else:
            stop = at + size
        if stop > end:
            raise ValueError(f"element {kind:X} runs past byte {end}")
        yield start, kind, at, stop
        at = stop


def children(b: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(id, body start, body end) of the elements in b[at:end]."""
    return (x[1:] for x in elements(b, at, end))


def _number(b: bytes, at: int, end: int) -> int:
    return int.from_bytes(b[at:end], "big")


def frame_spans(b: bytes, at: int, end: int) -> tuple[int, int, int, list[tuple[int, int]]]:
    """Track, relative timestamp, flags, and the byte ranges of the frames of a block."""
    track, at = read_vint(b, at)
    if at + 3 > end:
        raise ValueError(f"block cut off at byte {at}")
    (offset,) = struct.unpack_from(">h", b, at)
    flags, at = b[at + 2], at + 3
    lacing = flags >> 1 & 3
    if not lacing:
        return track, offset, flags, [(at, end)]
    n, at = b[at] + 1, at + 1
    sizes: list[int] = []
    if lacing == 2:
        if (end - at) % n:
            raise ValueError("fixed-size lacing doesn't divide its block")
        sizes = [(end - at) // n] * n
    else:
        for k in range(n - 1):
            if lacing == 1:
                size = 0
                while b[at] == 255:
                    size, at = size + 255, at + 1
                size, at = size + b[at], at + 1
            else:
                width = 9 - b[at].bit_length()
                raw, at = read_vint(b, at)
                raw = (1 << 7 * width) - 1 if raw == UNKNOWN else raw
                size = raw if not k else sizes[-1] + raw - ((1 << 7 * width - 1) - 1)
            sizes.append(size)
        sizes.append(end - at - sum(sizes))
    if min(sizes) < 0 or at + sum(sizes) != end:
        raise ValueError("lacing doesn't fit its block")
    spans = []
    for size in sizes:
        spans.append((at, at + size))
        at += size
    return track, offset, flags, spans


@dataclass
class Media:
    """A parsed file. Packets: track, timestamp (ns), key flag, start and end byte, in file order."""

    scale: int = 1_000_000
    duration: float = 0.0
    doc_type: str = ""
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[tuple[int, int, bool, int, int]] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)  # byte offsets in the segment's data
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time, track, cluster offset


def _float(b: bytes) -> float:
    return struct.unpack(">f" if len(b) == 4 else ">d", b)[0] if len(b) in (4, 8) else 0.0


def _track(b: bytes, at: int, end: int) -> dict:
    out = {"number": 0, "type": 0, "codec": "", "rate": 8000.0, "channels": 1, "bits": 0, "frame_ns": 0}
    names = {TRACK_NUMBER: "number", TRACK_TYPE: "type", DEFAULT_DURATION: "frame_ns", CHANNELS: "channels", BIT_DEPTH: "bits"}
    for kind, s, e in children(b, at, end):
        if kind == AUDIO:
            for k2, s2, e2 in children(b, s, e):
                if k2 == SAMPLING_FREQUENCY:
                    out["rate"] = _float(b[s2:e2])
                elif k2 in names:
                    out[names[k2]] = _number(b, s2, e2)
        elif kind == CODEC_ID:
            out["codec"] = b[s:e].rstrip(b"\0").decode("ascii")
        elif kind in names:
            out[names[kind]] = _number(b, s, e)
    return out


def _cluster(b: bytes, at: int, end: int, out: Media) -> None:
    base = 0
    for kind, s, e in children(b, at, end):
        if kind == CLUSTER_TIMESTAMP:
            base = _number(b, s, e)
            continue
        key = None
        if kind == BLOCK_GROUP:
            inner = list(children(b, s, e))
            key = not any(k == REFERENCE_BLOCK for k, _, _ in inner)
            s, e = next(((x, y) for k, x, y in inner if k == BLOCK), (0, 0))
        if e and kind in (SIMPLE_BLOCK, BLOCK_GROUP):
            track, offset, flags, spans = frame_spans(b, s, e)
            step = out.tracks.get(track, {}).get("frame_ns", 0)
            when = (base + offset) * out.scale
            is_key = bool(flags & 0x80) if key is None else key
            out.packets += [(track, when + k * step, is_key, x, y) for k, (x, y) in enumerate(spans)]


def parse(b: bytes) -> Media:
    """The tables of a Matroska file."""
    out, found = Media(), False
    for kind, s, e in children(b, 0, len(b)):
        if kind == EBML:
            out.doc_type = next((b[x:y].rstrip(b"\0").decode("ascii") for k, x, y in children(b, s, e) if k == DOC_TYPE), "")
        elif kind == SEGMENT:
            found = True
            for start, k1, s1, e1 in elements(b, s, e):
                if k1 == INFO:
                    for k2, s2, e2 in children(b, s1, e1):
                        if k2 == TIMESTAMP_SCALE:
                            out.scale = _number(b, s2, e2)
                        elif k2 == DURATION:
                            out.duration = _float(b[s2:e2])
                elif k1 == TRACKS:
                    for k2, s2, e2 in children(b, s1, e1):
                        if k2 == TRACK_ENTRY:
                            t = _track(b, s2, e2)
                            out.tracks[t["number"]] = t
                elif k1 == CLUSTER:
                    out.clusters.append(start - s)
                    _cluster(b, s1, e1, out)
                elif k1 == CUES:
                    for k2, s2, e2 in children(b, s1, e1):
                        if k2 == CUE_POINT:
                            time = 0
                            for k3, s3, e3 in children(b, s2, e2):
                                if k3 == CUE_TIME:
                                    time = _number(b, s3, e3)
                                elif k3 == CUE_TRACK_POSITIONS:
                                    at = {k4: _number(b, s4, e4) for k4, s4, e4 in children(b, s3, e3)}
                                    out.cues.append((time, at.get(CUE_TRACK, 0), at.get(CUE_CLUSTER_POSITION, 0)))
    if not found:
        raise ValueError("no Matroska segment")
    return out


def padded(text: bytes) -> bytes:
    """``text`` and bytes 255 up to a positive multiple of FRAME."""
    return text + b"\xff" * (max(FRAME, -(-len(text) // FRAME) * FRAME) - len(text))


_HEADER = element(EBML, b"".join([_uint(EBML_VERSION, 1), _uint(EBML_READ_VERSION, 1), _uint(EBML_MAX_ID, 4), _uint(EBML_MAX_SIZE, 8), element(DOC_TYPE, b"matroska"), _uint(DOC_VERSION, 4), _uint(DOC_READ_VERSION, 2)]))
_FRAME_NS = FRAME * 1_000_000_000 // RATE
_TRACKS = element(TRACKS, element(TRACK_ENTRY, b"".join([_uint(TRACK_NUMBER, 1), _uint(TRACK_UID, 1), _uint(TRACK_TYPE, 2), _uint(FLAG_LACING, 1), _uint(DEFAULT_DURATION, _FRAME_NS), element(CODEC_ID, b"A_PCM/INT/LIT"), element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + _uint(CHANNELS, 1) + _uint(BIT_DEPTH, 8))])))


def mux(payload: bytes) -> bytes:
    """A Matroska file with ``payload`` (whole frames) as one track of 8-bit PCM."""
    ms = 1000 * FRAME // RATE
    frames = len(payload) // FRAME
    info = element(INFO, _uint(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", float(frames * ms))) + element(MUXING_APP, b"parley") + element(WRITING_APP, b"parley"))
    parts, cues, at = [info, _TRACKS], [], len(info) + len(_TRACKS)
    per = FRAMES_PER_BLOCK * CLUSTER_BLOCKS
    for first in range(0, frames, per):
        body = [_uint(CLUSTER_TIMESTAMP, first * ms)]
        for f in range(first, min(first + per, frames), FRAMES_PER_BLOCK):
            n = min(FRAMES_PER_BLOCK, frames - f)
            head = b"\x81" + struct.pack(">h", (f - first) * ms) + (bytes([0x84, n - 1]) if n > 1 else b"\x80")
            body.append(element(SIMPLE_BLOCK, head + payload[f * FRAME : (f + n) * FRAME]))
        cues.append(element(CUE_POINT, _uint(CUE_TIME, first * ms) + element(CUE_TRACK_POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER_POSITION, at))))
        parts.append(element(CLUSTER, b"".join(body)))
        at += len(parts[-1])
    parts.append(element(CUES, b"".join(cues)))
    return _HEADER + element(SEGMENT, b"".join(parts), 8)


def payload_of(b: bytes, media: Media, track: int = 1) -> bytes:
    view = memoryview(b)
    return b"".join(view[s:e] for t, _, _, s, e in media.packets if t == track)


def feature(media: Media, payload: bytes) -> str:
    """Counts of the container, and level and zero crossings of the samples (signed about 128)."""
    x = np.frombuffer(payload, np.uint8).astype(np.int32) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    rms = int(np.dot(x.astype(np.int64), x) // max(1, len(x)))
    seekable = sum(offset in set(media.clusters) for _, _, offset in media.cues) if len(media.cues) < 9 else len({c for _, _, c in media.cues} & set(media.clusters))
    last = max((p[1] for p in media.packets), default=0) // 1_000_000
    return f"packets={len(media.packets)};clusters={len(media.clusters)};cues={seekable};last_ms={last};mean={int(x.sum()) // max(1, len(x))};power={rms};crossings={crossings}"


def stored(df: DataFrame) -> DataFrame:
    """The media column: doc_id, n_bytes and media (a Matroska file), written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):  # few files in memory at a time
                part = b.slice(at, 256)
                texts = [(t or "").encode() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([mux(padded(t)) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return store(documents(df).mapInArrow(run, "doc_id long, n_bytes long, media binary"), "media")


def digest(media: DataFrame) -> DataFrame:
    """Per row of a media column: what its bytes hold, read back."""
    kinds = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for blob in b.column("media"):
                raw = blob.as_py()
                m = parse(raw)
                p = payload_of(raw, m)
                rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(raw), hashlib.sha256(raw).hexdigest(), feature(m, p)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *(pa.array(c, kinds.field(i + 2).type) for i, c in enumerate(cols))], schema=kinds)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def packets(media: DataFrame) -> DataFrame:
    """One row for each frame of a media column: doc_id, packet, track, time_ns, key, start, length."""
    names = ["doc_id", "packet", "track", "time_ns", "key", "start", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, blob in zip(b.column("doc_id").to_pylist(), b.column("media")):
                found = parse(blob.as_py()).packets
                t, when, key, s, e = zip(*found) if found else [()] * 5
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array([doc] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(t, pa.int64()), pa.array(when, pa.int64()), pa.array(key, pa.bool_()), pa.array(s, pa.int64()), pa.array([y - x for x, y in zip(s, e)], pa.int64())], names=names)

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, packet long, track long, time_ns long, key boolean, start long, length long")
