"""ISO media containers as binary columns: build them, walk their boxes, index what they hold, read samples by range.

An index never touches sample data: it comes from the box headers and sample tables alone, so what it costs depends on
the tables and not on the media.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Boxes that hold boxes, and nothing before them; real files nest far less deep than DEEPEST.
NESTED = {b"moov", b"trak", b"edts", b"mdia", b"minf", b"dinf", b"stbl", b"mvex", b"udta", b"moof", b"traf"}
DEEPEST = 32
#: One sample: a frame of 8 x 8 pixels, three samples of 8 bits each.
SIDE = 8
UNIT = SIDE * SIDE * 3
FRAME_RATE, KEY_EVERY, PER_CHUNK = 25, 16, 64


def boxes(data) -> Iterator[tuple[tuple[bytes, ...], int, int, int]]:
    """(path, start, body start, end) of each box, a parent before its children. A size that does not fit raises ValueError."""
    open_: list[tuple[int, int, tuple[bytes, ...]]] = [(0, len(data), ())]
    while open_:
        start, end, path = open_.pop()
        if start == end:
            continue
        if end - start < 8:
            raise ValueError("a box header is cut off")
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            if end - start < 16:
                raise ValueError("a box header is cut off")
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        elif size == 0:  # to the end of what holds it
            size = end - start
        if size < body - start or start + size > end:
            raise ValueError(f"box {kind!r} does not fit")
        here = (*path, kind)
        if len(here) > DEEPEST:
            raise ValueError(f"boxes nest deeper than {DEEPEST}")
        yield here, start, body, start + size
        open_.append((start + size, end, path))
        if kind in NESTED:
            open_.append((body, start + size, here))


def _none() -> np.ndarray:
    return np.zeros(0, np.int64)


@dataclass
class Track:
    codec: str = ""
    handler: str = ""
    timescale: int = 0
    duration: int = 0
    number: int = 0
    offsets: np.ndarray = field(default_factory=_none)
    sizes: np.ndarray = field(default_factory=_none)
    times: np.ndarray = field(default_factory=_none)
    keys: np.ndarray = field(default_factory=_none)


def _rows(data, at: int, end: int, columns: int, wide: bool = False) -> np.ndarray:
    """A counted table of big-endian numbers behind a full box's version and flags."""
    (n,) = struct.unpack_from(">I", data, at + 4)
    if n * columns * (8 if wide else 4) > end - at - 8:
        raise ValueError("a sample table is cut off")
    return np.frombuffer(data, ">u8" if wide else ">u4", n * columns, at + 8).astype(np.int64).reshape(n, columns)


def tracks(data) -> list[Track]:
    """What each track's headers, sample tables and fragments say.

    No table is laid out before its count has been held against the bytes or the samples that it speaks of, so what
    a damaged file costs is bounded by its size.
    """
    found: list[Track] = []
    tables: list[dict] = []
    extends: dict[int, tuple[int, int, int]] = {}
    pieces: dict[int, list] = {}
    base = run = None
    for path, start, at, end in boxes(data):
        kind = path[-1]
        if path == (b"moov", b"trak"):
            found.append(Track())
            tables.append({})
        elif kind == b"trex":
            number, _, *default = struct.unpack_from(">5I", data, at + 4)
            extends[number] = tuple(default)
        elif path == (b"moof",):
            base = start
        elif path == (b"moof", b"traf"):
            run = None
        elif path[:2] == (b"moof", b"traf") and kind == b"tfhd":
            run = _fragment(data, at, base, extends)
        elif path[:2] == (b"moof", b"traf") and kind == b"tfdt" and run:
            (run["time"],) = struct.unpack_from(">Q" if data[at] else ">I", data, at + 4)
        elif path[:2] == (b"moof", b"traf") and kind == b"trun":
            if run is None:
                raise ValueError("a run of samples without its track")
            pieces.setdefault(run["number"], []).append(_run(data, at, end, run))
        if path[:2] != (b"moov", b"trak") or not found:
            continue
        t, own = found[-1], tables[-1]
        if kind == b"tkhd":
            (t.number,) = struct.unpack_from(">I", data, at + (20 if data[at] else 12))
        elif kind == b"mdhd":
            t.timescale, t.duration = struct.unpack_from(">IQ" if data[at] else ">II", data, at + (20 if data[at] else 12))
        elif kind == b"hdlr":
            t.handler = bytes(data[at + 8 : at + 12]).decode("latin-1")
        elif kind == b"stsd":
            t.codec = bytes(data[at + 12 : at + 16]).decode("latin-1")
        elif kind == b"stsz":
            size, n = struct.unpack_from(">II", data, at + 4)
            if size and n > len(data) // size:
                raise ValueError("a sample lies outside the file")
            own[kind] = np.full(n, size, np.int64) if size else _rows(data, at + 4, end, 1)[:, 0]
            if not size and len(own[kind]) != n:
                raise ValueError("a sample table is cut off")
        elif kind in (b"stts", b"stsc", b"stss", b"stco", b"co64"):
            own[b"stco" if kind == b"co64" else kind] = _rows(data, at, end, {b"stts": 2, b"stsc": 3}.get(kind, 1), kind == b"co64")
    for t, own in zip(found, tables):
        _place(t, own, len(data))
        for offsets, sizes, times, keys, ends in pieces.get(t.number, []):
            if len(sizes) and (offsets.min() < 0 or (offsets + sizes).max() > len(data)):
                raise ValueError("a sample lies outside the file")
            t.keys = np.concatenate([t.keys, np.flatnonzero(keys) + len(t.sizes)])
            t.offsets, t.sizes, t.times = (np.concatenate(x) for x in ((t.offsets, offsets), (t.sizes, sizes), (t.times, times)))
            t.duration = max(t.duration, ends)
    return found


def _place(t: Track, own: dict, length: int) -> None:
    """Offsets, times and keyframes of a track's samples from its tables."""
    if not {b"stsz", b"stsc", b"stco"} <= own.keys():
        return
    sizes, chunks, runs = own[b"stsz"], own[b"stco"][:, 0], own[b"stsc"]
    firsts = np.append(runs[:, 0], len(chunks) + 1)
    if len(runs) and (firsts[0] != 1 or (np.diff(firsts) < 0).any()):
        raise ValueError("chunk runs are out of order")
    per = np.repeat(runs[:, 1], np.diff(firsts)) if len(runs) else np.zeros(len(chunks), np.int64)
    if per.sum() != len(sizes):
        raise ValueError("samples and chunks do not agree")
    steps = own.get(b"stts", np.zeros((0, 2), np.int64))
    if steps[:, 0].sum() != len(sizes):
        raise ValueError("times and samples do not agree")
    owner, off = common.spans(per)
    before = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(len(sizes)) - off  # the first sample of the chunk
    t.offsets, t.sizes = chunks[owner] + before[:-1] - before[at], sizes
    if len(sizes) and (t.offsets.min() < 0 or (t.offsets + sizes).max() > length):
        raise ValueError("a sample lies outside the file")
    t.times = np.concatenate([[0], np.cumsum(np.repeat(steps[:, 1], steps[:, 0]))])[: len(sizes)]
    t.keys = own[b"stss"][:, 0] - 1 if b"stss" in own else np.arange(len(sizes))
    if len(t.keys) and not 0 <= t.keys.min() <= t.keys.max() < len(sizes):
        raise ValueError("a keyframe does not exist")


def _fragment(data, at: int, base: int, extends: dict[int, tuple[int, int, int]]) -> dict:
    """A track fragment's header: where its data starts, and what its samples take unless they say otherwise."""
    flags, number = struct.unpack_from(">II", data, at)
    flags &= 0xFFFFFF
    at += 8
    if flags & 1:
        (base,) = struct.unpack_from(">Q", data, at)
        at += 8
    at += 4 if flags & 2 else 0
    default = list(extends.get(number, (0, 0, 0)))
    for k, bit in enumerate((0x8, 0x10, 0x20)):
        if flags & bit:
            (default[k],) = struct.unpack_from(">I", data, at)
            at += 4
    return {"number": number, "base": base, "next": base, "time": 0, "default": default}


#: A sample that cannot be decoded alone has this bit in its flags.
NOT_ALONE = 0x10000


def _run(data, at: int, end: int, run: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(offsets, sizes, times, alone, end time) of one run of a fragment's samples; `run` moves on behind it."""
    flags, n = struct.unpack_from(">II", data, at)
    flags &= 0xFFFFFF
    at += 8
    if flags & 1:
        (by,) = struct.unpack_from(">i", data, at)
        run["next"] = run["base"] + by
        at += 4
    first = None
    if flags & 4:
        (first,) = struct.unpack_from(">I", data, at)
        at += 4
    told = [k for k in range(4) if flags & (0x100 << k)]
    if 4 * n * len(told) > end - at or n > len(data):
        raise ValueError("a run of samples is cut off")
    table = np.frombuffer(data, ">u4", n * len(told), at).astype(np.int64).reshape(n, len(told))
    steps, sizes, marks = (table[:, told.index(k)] if k in told else np.full(n, run["default"][k], np.int64) for k in range(3))
    if first is not None and n:
        marks = np.concatenate([[first], marks[1:]])
    ends, times = np.cumsum(sizes), np.cumsum(steps)
    offsets, begins = run["next"] + ends - sizes, run["time"] + times - steps
    run["next"] += int(ends[-1]) if n else 0
    run["time"] += int(times[-1]) if n else 0
    return offsets, sizes, begins, marks & NOT_ALONE == 0, run["time"]


def _box(kind: bytes, *body: bytes) -> bytes:
    size = 8 + sum(map(len, body))
    if size >= 1 << 32:
        return b"".join([struct.pack(">I4sQ", 1, kind, size + 8), *body])
    return b"".join([struct.pack(">I4s", size, kind), *body])


def _full(kind: bytes, *body: bytes, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", flags), *body)


_UNITY = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def build(payload: bytes) -> bytes:
    """A container with one track of uncompressed frames (8-bit samples); the payload is a positive multiple of UNIT bytes."""
    n = len(payload) // UNIT
    if not n or len(payload) % UNIT:
        raise ValueError(f"the payload must be a positive multiple of {UNIT} bytes")
    head = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomqt  ")
    data = _box(b"mdat", payload)
    first = len(head) + len(data) - len(payload)
    chunks = np.arange(0, n, PER_CHUNK, dtype=np.int64) * UNIT + first
    runs = [(1, min(n, PER_CHUNK), 1)] + ([(len(chunks), n % PER_CHUNK, 1)] if n > PER_CHUNK and n % PER_CHUNK else [])
    keys = np.arange(1, n + 1, KEY_EVERY)
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", SIDE, SIDE, 72 << 16, 72 << 16, 0, 1), bytes(32), struct.pack(">Hh", 24, -1))
    wide = first + len(payload) >= 1 << 32
    table = _box(
        b"stbl",
        _full(b"stsd", struct.pack(">I", 1), entry),
        _full(b"stts", struct.pack(">III", 1, n, 1)),
        _full(b"stss", struct.pack(">I", len(keys)), keys.astype(">u4").tobytes()),
        _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
        _full(b"stsz", struct.pack(">II", UNIT, n)),
        _full(b"co64" if wide else b"stco", struct.pack(">I", len(chunks)), chunks.astype(">u8" if wide else ">u4").tobytes()),
    )
    media = _box(
        b"mdia",
        _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, FRAME_RATE, n, 0x55C4, 0)),
        _full(b"hdlr", bytes(4), b"vide", bytes(12), b"frames\0"),
        _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), table),
    )
    track = _box(b"trak", _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(16), _UNITY, struct.pack(">II", SIDE << 16, SIDE << 16), flags=7), media)
    movie = _full(b"mvhd", struct.pack(">IIIIIH", 0, 0, FRAME_RATE, n, 0x10000, 0x100), bytes(10), _UNITY, bytes(24), struct.pack(">I", 2))
    return head + data + _box(b"moov", movie, track)


def pad(text: bytes) -> bytes:
    """Spaces up to a positive multiple of UNIT."""
    return text.ljust(max(1, -(-len(text) // UNIT)) * UNIT, b" ")


def samples(data, track: Track) -> bytes:
    """A track's stored bytes, read by ranges; neighbouring samples are one range."""
    if not len(track.sizes):
        return b""
    ends = track.offsets + track.sizes
    cut = np.flatnonzero(track.offsets[1:] != ends[:-1]) + 1
    return b"".join(bytes(data[a:b]) for a, b in zip(track.offsets[np.concatenate([[0], cut])], ends[np.concatenate([cut - 1, [-1]])]))


def store_texts(df: DataFrame, id: str = "doc_id", text: str = "text", media: str = "media") -> DataFrame:
    """(id, n_bytes, media): each whole text, padded, as a container. Null texts are empty ones; rows are kept one by one."""

    def run(batches):
        for b in batches:
            for part in common.sliced(b, 1):
                texts = common.utf8(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([build(pad(t)) for t in texts], pa.binary())], ["id", "n_bytes", media])

    common.small_batches(df.sparkSession)
    return df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(common.frugal(run), f"id long, n_bytes long, {media} binary")


_TRACKS = "array<struct<codec: string, handler: string, timescale: bigint, duration: bigint, n_samples: bigint, keyframes: array<struct<sample: bigint, time: bigint, offset: bigint, size: bigint>>>>"
_KIND = pa.list_(pa.struct([("codec", pa.string()), ("handler", pa.string()), ("timescale", pa.int64()), ("duration", pa.int64()), ("n_samples", pa.int64()), ("keyframes", pa.list_(pa.struct([(k, pa.int64()) for k in ("sample", "time", "offset", "size")])))]))


def index_media(df: DataFrame, media: str = "media") -> DataFrame:
    """df and two columns: `tracks`, an array with each track's codec, timescale, duration and keyframe byte ranges, and
    `problem`, why a container could not be read (then there are no tracks).

    Sample data is not decoded. A null container gives null tracks and no problem; an empty one has no track. Columns of
    df that are named tracks or problem are replaced.
    """
    df = df.drop("tracks", "problem")
    at, schema = df.columns.index(media), f"{df.schema.toDDL()}, tracks {_TRACKS}, problem string"

    def run(batches):
        for b in batches:
            for part in common.sliced(b, at):
                found, problems = [], []
                for x in part.column(at):
                    try:
                        found.append([_row(t) for t in tracks(memoryview(x.as_buffer()))] if x.is_valid else None)
                        problems.append(None)
                    except (ValueError, struct.error, IndexError) as e:
                        found.append(None)
                        problems.append(str(e) or type(e).__name__)
                yield part.append_column("tracks", pa.array(found, _KIND)).append_column("problem", pa.array(problems, pa.string()))

    return df.mapInArrow(common.frugal(run), schema)


def _row(t: Track) -> dict:
    ranges = zip(t.keys.tolist(), t.times[t.keys].tolist(), t.offsets[t.keys].tolist(), t.sizes[t.keys].tolist())
    return {"codec": t.codec, "handler": t.handler, "timescale": t.timescale, "duration": t.duration, "n_samples": len(t.sizes), "keyframes": [dict(zip(("sample", "time", "offset", "size"), r)) for r in ranges]}


def feature(track: Track, payload: bytes) -> str:
    """A stored track in short: its tables, the key ranges' checksum, and the mean level of the frames read back."""
    keys = np.stack([track.offsets[track.keys], track.sizes[track.keys]], 1).astype("<i8")
    level = np.frombuffer(payload, np.uint8).mean() if payload else 0.0
    return json.dumps({"codec": track.codec, "seconds": round(track.duration / track.timescale, 3), "samples": len(track.sizes), "keyframes": len(keys), "key_ranges_crc32": zlib.crc32(keys.tobytes()), "level": round(float(level), 4)})


def read_back(df: DataFrame, media: str = "media") -> DataFrame:
    """(id, n_bytes, payload, media, feature, tracks) of containers with one track: the payload is read by the stored ranges."""
    at = df.columns.index(media)

    def run(batches):
        for b in batches:
            for part in common.sliced(b, at):
                payloads, features, told = [], [], []
                for x in part.column(at):
                    data = memoryview(x.as_buffer())
                    (track,) = tracks(data)
                    payloads.append(samples(data, track))
                    features.append(feature(track, payloads[-1]))
                    told.append([_row(track)])
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("n_bytes"), pa.array(payloads, pa.binary()), part.column(at), pa.array(features, pa.string()), pa.array(told, _KIND)], ["id", "n_bytes", "payload", media, "feature", "tracks"])

    return df.mapInArrow(common.frugal(run), f"id long, n_bytes long, payload binary, {media} binary, feature string, tracks {_TRACKS}")


def op1_media(spark, sf_dir: str) -> DataFrame:
    back = read_back(store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return back.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -16)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        "tracks",
    )
