"""Matroska columns: a muxer for one track of 8-bit samples, and a parser from EBML elements to a packet table.

The parser walks variable-length elements (ids, sizes, unknown sizes), reads clusters, simple blocks and block groups with
all kinds of lacing, and cues, and gives one packet for each frame: track, timestamp and the byte range in the stored file.
packet_table does so for a column of files of any origin, where a broken file is a row with its fault.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import table, text_of

UNIT, RATE = 64, 8000
FRAME, BLOCK_FRAMES, CLUSTER_BLOCKS = 512, 8, 32

# Element ids of the public Matroska specification (fixed values).
EBML, EBML_VERSION, EBML_READ, EBML_ID_LENGTH, EBML_SIZE_LENGTH, DOC_TYPE, DOC_VERSION, DOC_READ = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, SCALE, DURATION, MUXER, WRITER = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, AUDIO, FREQUENCY, CHANNELS, DEPTH = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, CLUSTER_TIME, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
FRAME_DURATION, BLOCK_DURATION, REFERENCE_BLOCK = 0x23E383, 0x9B, 0xFB
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
NESTED = {EBML, SEGMENT, INFO, TRACKS, TRACK, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_TRACK_POSITIONS}
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3
#: What a packet table's columns hold.
MOST_TRACK, MOST_NS = 2**31 - 1, 2**63 - 1


def size_vint(n: int, least: int = 1) -> bytes:
    """n as a variable-length size of at least so many bytes; all ones is kept for unknown sizes."""
    length = least
    while n >= (1 << 7 * length) - 1:
        length += 1
    return (n | 1 << 7 * length).to_bytes(length, "big")


def element(eid: int, data: bytes) -> bytes:
    return eid.to_bytes((eid.bit_length() + 7) // 8, "big") + size_vint(len(data)) + data


def number(eid: int, n: int) -> bytes:
    return element(eid, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def lace(frames: list[bytes], kind: int) -> bytes:
    """The count, sizes and frames of a laced block."""
    if kind == NO_LACING:
        return frames[0]
    head = bytes([len(frames) - 1])
    sizes = [len(f) for f in frames]
    if kind == XIPH:
        head += b"".join(b"\xff" * (s // 255) + bytes([s % 255]) for s in sizes[:-1])
    elif kind == EBML_LACING:
        head += size_vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1], strict=False):
            d, length = b - a, 1
            while abs(d) >= (1 << 7 * length - 1) - 1:
                length += 1
            head += (d + (1 << 7 * length - 1) - 1 | 1 << 7 * length).to_bytes(length, "big")
    return head + b"".join(frames)


def block(track: int, offset: int, frames: list[bytes], kind: int) -> bytes:
    return size_vint(track) + struct.pack(">hB", offset, 0x80 | kind << 1) + lace(frames, kind)


_HEAD = element(EBML, number(EBML_VERSION, 1) + number(EBML_READ, 1) + number(EBML_ID_LENGTH, 4) + number(EBML_SIZE_LENGTH, 8) + element(DOC_TYPE, b"matroska") + number(DOC_VERSION, 4) + number(DOC_READ, 2))
_TRACKS = element(TRACKS, element(TRACK, number(TRACK_NUMBER, 1) + number(TRACK_UID, 1) + number(TRACK_TYPE, 2) + number(FRAME_DURATION, FRAME * 10**9 // RATE) + element(CODEC, b"A_PCM/INT/LIT") + element(AUDIO, element(FREQUENCY, struct.pack(">d", RATE)) + number(CHANNELS, 1) + number(DEPTH, 8))))


def mux(payload: bytes) -> bytes:
    """A file with the payload as one track of unsigned 8-bit samples; whole blocks are laced with fixed sizes, the last with
    its own."""
    info = element(INFO, number(SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE)) + element(MUXER, b"columns") + element(WRITER, b"columns"))
    parts, cues, at = [info, _TRACKS], [], len(info) + len(_TRACKS)
    per_block = FRAME * BLOCK_FRAMES
    for begin in range(0, len(payload), per_block * CLUSTER_BLOCKS):
        time = begin * 1000 // RATE
        body = [number(CLUSTER_TIME, time)]
        for b in range(begin, min(len(payload), begin + per_block * CLUSTER_BLOCKS), per_block):
            frames = [payload[f : f + FRAME] for f in range(b, min(len(payload), b + per_block), FRAME)]
            kind = NO_LACING if len(frames) == 1 else FIXED if len(frames[-1]) == FRAME else EBML_LACING
            body.append(element(SIMPLE_BLOCK, block(1, b * 1000 // RATE - time, frames, kind)))
        cluster = element(CLUSTER, b"".join(body))
        cues.append(element(CUE_POINT, number(CUE_TIME, time) + element(CUE_TRACK_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER, at))))
        parts.append(cluster)
        at += len(cluster)
    return _HEAD + element(SEGMENT, b"".join([*parts, element(CUES, b"".join(cues))]))


@dataclass
class Parsed:
    """Packets as (track, timestamp ns, start, end, keyframe), cues as (ns, track, cluster start), cluster starts, tracks.

    A laced frame's time is its block's and as many frame durations as there are frames before it: the block group's duration
    shared by its frames or, without one, the track's; where neither is told, its block's time."""

    packets: list[tuple[int, int, int, int, bool]] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)
    tracks: list[dict] = field(default_factory=list)
    blocks: int = 0
    scale: int = 1_000_000
    laced: set[int] = field(default_factory=set)
    #: Frames in file order as track, ticks of the block, place in the lace, start, end, keyframe, and ticks of one frame or None.
    frames: list[tuple[int, int, int, int, int, bool, float | None]] = field(default_factory=list)

    def timed(self) -> Parsed:
        """Packets and cues in nanoseconds, when scale and tracks are known; numbers that no packet table holds are an error."""
        own = {t[TRACK_NUMBER]: t[FRAME_DURATION] for t in self.tracks if TRACK_NUMBER in t and FRAME_DURATION in t}
        for track, ticks, place, a, b, key, each in self.frames:
            step = own.get(track, 0) if each is None else each * self.scale
            ns = ticks * self.scale + round(place * step)
            if not 0 <= track <= MOST_TRACK or not -MOST_NS <= ns <= MOST_NS:
                raise ValueError(f"track {track} at {ticks} ticks is out of range")
            self.packets.append((track, ns, a, b, key))
        self.cues = [(ticks * self.scale, t, c) for ticks, t, c in self.cues]
        return self


def _vint(data: bytes, at: int, keep: bool = False) -> tuple[int, int]:
    """Value and end of the number at a place; with keep its marker stays, as in ids. -1: all ones, unknown."""
    first = data[at]
    if not first:
        raise ValueError(f"no element at byte {at}")
    length = 9 - first.bit_length()
    raw = data[at : at + length]
    if len(raw) < length:
        raise ValueError(f"cut off at byte {at}")
    n = int.from_bytes(raw, "big")
    if keep:
        return n, at + length
    n ^= 1 << 7 * length
    return (-1 if n == (1 << 7 * length) - 1 else n), at + length


def _read_block(data: bytes, at: int, end: int, cluster_time: int, out: Parsed) -> None:
    track, p = _vint(data, at)
    offset, flags = struct.unpack_from(">hB", data, p)
    p += 3
    kind = flags >> 1 & 3
    out.laced.add(kind)
    sizes: list[int] = []
    if kind:
        n = data[p] + 1
        p += 1
        if kind == XIPH:
            for _ in range(n - 1):
                s = 0
                while True:
                    s += data[p]
                    p += 1
                    if data[p - 1] != 255:
                        break
                sizes.append(s)
        elif kind == EBML_LACING and n > 1:
            s, p = _vint(data, p)
            sizes.append(s)
            for _ in range(n - 2):
                q = p
                d, p = _vint(data, p)
                length = p - q
                sizes.append(sizes[-1] + (d if d >= 0 else (1 << 7 * length) - 1) - ((1 << 7 * length - 1) - 1))
        if kind == FIXED:
            sizes = [(end - p) // n] * n
        else:
            sizes.append(end - p - sum(sizes))
    else:
        sizes = [end - p]
    if min(sizes) < 0 or sum(sizes) != end - p:
        raise ValueError(f"frames do not fit the block at byte {at}")
    out.blocks += 1
    for place, s in enumerate(sizes):
        out.frames.append((track, cluster_time + offset, place, p, p + s, flags & 0x80 > 0, None))
        p += s


def parse(data: bytes) -> Parsed:
    """The packet table of a file. Unknown elements are skipped; elements of unknown size end where their parent does or
    where a cluster or cues begin."""
    out = Parsed()
    unsigned = lambda a, b: int.from_bytes(data[a:b], "big")
    state = {"time": 0, "base": 0}

    def walk(at: int, end: int, parent: dict, inside: int = 0) -> int:
        while at < end:
            begin = at
            eid, p = _vint(data, at, keep=True)
            if inside == CLUSTER and eid in (CLUSTER, CUES, TRACKS, INFO):
                return begin
            n, p = _vint(data, p)
            stop = end if n < 0 else p + n
            if stop > end:
                raise ValueError(f"element at byte {begin} runs over its parent")
            if eid == SEGMENT:
                state["base"] = p
            elif eid == CLUSTER:
                out.clusters.append(begin)
            if eid in NESTED:
                own: dict = {}
                before = len(out.frames)
                reached = walk(p, stop, own, eid)
                stop = reached if n < 0 else stop
                if eid == TRACK:
                    out.tracks.append(own)
                elif eid == BLOCK_GROUP:  # a group that refers to no other block is a keyframe
                    group = out.frames[before:]
                    each = own[BLOCK_DURATION] / len(group) if BLOCK_DURATION in own and group else None
                    out.frames[before:] = [(*f[:5], REFERENCE_BLOCK not in own, each) for f in group]
                elif eid == AUDIO:
                    parent.update(own)
                elif eid == CUE_TRACK_POSITIONS:
                    parent.setdefault("at", []).append((own.get(CUE_TRACK, 0), own.get(CUE_CLUSTER, 0) + state["base"]))
                elif eid == CUE_POINT:
                    out.cues += [(own.get(CUE_TIME, 0), t, c) for t, c in own.get("at", [])]
            elif eid == SCALE:
                out.scale = unsigned(p, stop)
            elif eid == CLUSTER_TIME:
                state["time"] = unsigned(p, stop)
            elif eid in (SIMPLE_BLOCK, BLOCK):
                _read_block(data, p, stop, state["time"], out)
            elif eid == FREQUENCY:
                parent[eid] = struct.unpack(">d" if stop - p == 8 else ">f", data[p:stop])[0]
            elif eid == CODEC:
                parent[eid] = data[p:stop].decode()
            elif stop - p <= 8:
                parent[eid] = unsigned(p, stop)
            at = stop
        return at

    walk(0, len(data), {})
    return out.timed()


def payload_of(data: bytes, parsed: Parsed, track: int = 1) -> bytes:
    return b"".join([data[a:b] for t, _, a, b, _ in parsed.packets if t == track])


def feature(payload: bytes, parsed: Parsed) -> str:
    """What the packet table and the samples say about the track."""
    x = np.frombuffer(payload, np.uint8).astype(np.float64) - 128
    last = parsed.packets[-1]
    ms = last[1] / 1e6 + (last[3] - last[2]) * 1000 / RATE
    turns = int(np.count_nonzero(np.diff(np.signbit(x))))
    hits = sum(c in set(parsed.clusters) for _, _, c in parsed.cues) if len(parsed.cues) < 64 else len({c for _, _, c in parsed.cues} & set(parsed.clusters))
    return f"tracks={len(parsed.tracks)};clusters={len(parsed.clusters)};blocks={parsed.blocks};packets={len(parsed.packets)};cues={hits};last_ms={ms:.0f};mean={x.mean():.4f};rms={np.sqrt((x * x).mean()):.4f};turns={turns}"


PACKETS = "array<struct<track:int,ns:bigint,start:bigint,end:bigint,key:boolean>>"
_PACKETS = pa.list_(pa.struct([("track", pa.int32()), ("ns", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("key", pa.bool_())]))


def _packet_rows(parsed: Parsed) -> list[dict]:
    return [dict(zip(("track", "ns", "start", "end", "key"), p, strict=True)) for p in parsed.packets]


def packet_table(files: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """id, media_bytes, status, n_tracks, n_clusters, n_cues, duration_ms and packets of each file of a media column.

    status is 'ok', 'null' for a null file, or 'broken: ' and the fault, with no packets, for bytes that are cut off or no
    Matroska, or have numbers beyond a packet's columns; so one bad file does not end the job. Packets have track, ns, start, end (byte range in the file) and key, and
    are in the order of the file; equal files give equal rows. No rows give no rows; further columns are ignored. A file is a
    value, so it fits a row; a packet is a range, so no bytes are copied.
    """
    rows = files.select(files[id_col].alias("id"), files[media_col].cast("binary").alias("__media"))
    more = {"media_bytes": 0, "status": "", "n_tracks": 0, "n_clusters": 0, "n_cues": 0, "duration_ms": 0.0}
    schema = rows.drop("__media").withColumns({k: F.lit(v).cast("long") if v == 0 and isinstance(v, int) else F.lit(v) for k, v in more.items()}).withColumn("packets", F.lit(None).cast(PACKETS)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), _PACKETS]
        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                part, out = batch.slice(lo, 100), []
                for value in part.column("__media"):
                    data, parsed, status = value.as_py(), Parsed(), "null"
                    if data is not None:
                        try:
                            parsed, status = parse(data), "ok"
                            if not parsed.tracks and not parsed.clusters:
                                status = "broken: no track and no cluster"
                        except (ValueError, IndexError, OverflowError, struct.error, RecursionError) as fault:
                            parsed, status = Parsed(), f"broken: {fault}"
                    last = max((p[1] for p in parsed.packets), default=0)
                    out.append((len(data or b""), status, len(parsed.tracks), len(parsed.clusters), len(parsed.cues), last / 1e6, _packet_rows(parsed)))
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=schema.names)

    return rows.mapInArrow(run, schema)


def stored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_media: bool = False) -> DataFrame:
    """One row for each document: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256,
    feature, and with with_media the stored file and its packets.

    The payload is the UTF-8 text and zeros up to a positive multiple of 64 bytes, so a null or empty text has 64 zeros; it is
    read back from the stored bytes by the packet table. Equal texts give equal values. No rows give no rows; further columns
    are ignored.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("__text"))
    more = {"n_bytes": 0, "payload_bytes": 0, "payload_sha256": "", "tail_crc32": 0, "media_bytes": 0, "media_sha256": "", "feature": ""}
    schema = rows.drop("__text").withColumns({k: F.lit(v).cast("long") if v == 0 else F.lit(v) for k, v in more.items()}).schema
    if with_media:
        schema = schema.add("media", "binary")
        packet = rows.select(F.lit(None).cast(PACKETS).alias("packets")).schema["packets"]
        schema = schema.add(packet)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        if with_media:
            kinds += [pa.binary(), _PACKETS]
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                out = []
                for t in part.column("__text"):
                    raw = t.as_py().encode("utf-8", "surrogatepass")
                    media = mux(raw + b"\0" * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw)))
                    parsed = parse(media)
                    payload = payload_of(media, parsed)
                    row = (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature(payload, parsed))
                    out.append(row + ((media, _packet_rows(parsed)) if with_media else ()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=schema.names)

    return rows.mapInArrow(run, schema)


def op9_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(table(spark, sf_dir, "documents"))
