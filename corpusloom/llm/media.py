"""Media columns: Matroska files in binary columns.

`mux` stores bytes as 8-bit PCM in a Matroska file (clusters, laced SimpleBlocks, cues), `demux` parses any
Matroska file into packets, and `packet_table` gives a DataFrame of media one row per packet: track, timestamp,
byte range, lacing. Each file is handled alone, so memory is that of one file and any lost task can run again.

Defined cases: null text counts as empty; an empty text has a payload of 64 zero bytes; null media has no packets;
media that cannot be parsed, or whose numbers fit no column, yields one row with `error` set. A cue that points to no packet
is counted as lost. Repeated rows give repeated results; columns other than those named are not read, whatever their names.
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
from pyspark.sql import types as T

from corpusloom.llm.bytewords import raw_bytes
from corpusloom.llm.common import arrow_scan, bounded_batches, table

# Element ids of the Matroska specification (RFC 9559).
EBML, EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3
DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C
CODEC_ID, DEFAULT_DURATION, AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0x86, 0x23E383, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION, CUE_RELATIVE_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1, 0xF0

#: 8 kHz, 8 bits: 8 bytes a millisecond. A packet is 64 ms, a block laces 8 packets, a cluster has 16 blocks.
RATE, PACKET, LACED, BLOCKS = 8000, 512, 8, 16
UNIT = 64


def _vint(n: int, width: int = 0) -> bytes:
    """A variable-length size: a marker bit after width-1 zero bits, then the value."""
    width = width or max(1, (n.bit_length() + 6) // 7)
    if n == (1 << 7 * width) - 1:  # all ones means unknown
        width += 1
    return (n | 1 << 7 * width).to_bytes(width, "big")


def _element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + _vint(len(body)) + body


def _uint(ident: int, n: int) -> bytes:
    return _element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


_HEAD = _element(
    EBML,
    _uint(EBML_VERSION, 1) + _uint(EBML_READ_VERSION, 1) + _uint(EBML_MAX_ID, 4) + _uint(EBML_MAX_SIZE, 8)
    + _element(DOC_TYPE, b"matroska") + _uint(DOC_TYPE_VERSION, 4) + _uint(DOC_TYPE_READ_VERSION, 2),
)
_TRACKS = _element(
    TRACKS,
    _element(
        TRACK_ENTRY,
        _uint(TRACK_NUMBER, 1) + _uint(TRACK_UID, 1) + _uint(TRACK_TYPE, 2) + _uint(FLAG_LACING, 1) + _element(CODEC_ID, b"A_PCM/INT/LIT")
        + _uint(DEFAULT_DURATION, PACKET * 1_000_000_000 // RATE)
        + _element(AUDIO, _element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + _uint(CHANNELS, 1) + _uint(BIT_DEPTH, 8)),
    ),
)


def _block(frames: list[bytes], at_ms: int) -> bytes:
    sizes = [len(f) for f in frames]
    if len(frames) == 1:
        flags, lace = 0x80, b""
    elif len(set(sizes)) == 1:
        flags, lace = 0x84, bytes([len(frames) - 1])
    else:  # EBML lacing: the first size, then signed differences
        flags = 0x86
        lace = bytes([len(frames) - 1]) + _vint(sizes[0])
        for a, b in zip(sizes[:-2], sizes[1:-1]):
            d = b - a
            width = next(w for w in range(1, 9) if abs(d) < (1 << 7 * w - 1) - 1)
            lace += _vint(d + (1 << 7 * width - 1) - 1, width)
    return b"\x81" + struct.pack(">hB", at_ms, flags) + lace + b"".join(frames)


def padded(data: bytes, unit: int = UNIT) -> bytes:
    return data + bytes(unit - len(data) if not data else -len(data) % unit)


def mux(payload: bytes) -> bytes:
    """A Matroska file with one 8-bit PCM track whose samples are the payload's bytes."""
    info = _element(
        INFO,
        _uint(TIMESTAMP_SCALE, 1_000_000) + _element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE))
        + _element(MUXING_APP, b"corpusloom") + _element(WRITING_APP, b"corpusloom"),
    )
    parts = [info, _TRACKS]
    position, cues, per_cluster = len(info) + len(_TRACKS), [], PACKET * LACED * BLOCKS
    for c in range(0, len(payload), per_cluster):
        start_ms, chunk = c * 1000 // RATE, payload[c : c + per_cluster]
        body = [_uint(TIMESTAMP, start_ms)]
        for b in range(0, len(chunk), PACKET * LACED):
            laced = chunk[b : b + PACKET * LACED]
            body.append(_element(SIMPLE_BLOCK, _block([laced[i : i + PACKET] for i in range(0, len(laced), PACKET)], b * 1000 // RATE)))
        cluster = _element(CLUSTER, b"".join(body))
        cues.append(_element(CUE_POINT, _uint(CUE_TIME, start_ms) + _element(CUE_TRACK_POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER_POSITION, position) + _uint(CUE_RELATIVE_POSITION, len(body[0])))))
        parts.append(cluster)
        position += len(cluster)
    return _HEAD + _element(SEGMENT, b"".join(parts) + _element(CUES, b"".join(cues)))


@dataclass
class Packet:
    track: int
    timestamp_ns: int
    start: int  # byte range in the file
    size: int
    keyframe: bool
    lacing: str
    cluster: int  # number of its cluster, from 0
    cued: bool = False  # a cue points to its block, or to its cluster and it is the first of its track there


@dataclass
class Media:
    doc_type: str = "matroska"
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[Packet] = field(default_factory=list)
    cues: list[tuple[int, int, tuple[int, int], int | None]] = field(default_factory=list)  # time in ns, track, segment and the cluster's position in it, block position in the cluster
    clusters: list[tuple[int, int]] = field(default_factory=list)  # segment and position in it of the cluster elements
    lost_cues: int = 0  # cues that point to no packet
    duration_ns: int = 0


def _read_vint(d: bytes, at: int, keep_marker: bool = False) -> tuple[int, int]:
    """Value and next position; -1 for an unknown size."""
    if at >= len(d) or not d[at]:
        raise ValueError(f"no variable-length number at byte {at}")
    width = 9 - d[at].bit_length()
    if at + width > len(d):
        raise ValueError(f"truncated number at byte {at}")
    n = int.from_bytes(d[at : at + width], "big")
    if keep_marker:
        return n, at + width
    n &= (1 << 7 * width) - 1
    return (-1 if n == (1 << 7 * width) - 1 else n), at + width


#: Where an element of unknown size ends: at the next element of its own level or above.
_ABOVE = {SEGMENT: {EBML, SEGMENT}, CLUSTER: {EBML, SEGMENT, CLUSTER, CUES, TRACKS, INFO}}


def _elements(d: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """Id, start and end of the body of each element."""
    return ((ident, body, stop) for _, ident, body, stop in _placed(d, at, end))


def _placed(d: bytes, at: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """Start, id, start and end of the body of each element."""
    while at < end:
        ident, body = _read_vint(d, at, True)
        size, body = _read_vint(d, body)
        if size < 0:
            if ident not in _ABOVE:
                raise ValueError(f"unknown size of element {ident:#x}")
            stop = next((p for i, p in _heads(d, body, end) if i in _ABOVE[ident]), end)
        else:
            stop = body + size
        if stop > end:
            raise ValueError(f"element {ident:#x} passes its parent's end")
        yield at, ident, body, stop
        at = stop


def _heads(d: bytes, at: int, end: int) -> Iterator[tuple[int, int]]:
    while at < end:
        ident, body = _read_vint(d, at, True)
        yield ident, at
        size, body = _read_vint(d, body)
        at = body if size < 0 else body + size


def _number(d: bytes, a: int, b: int) -> int:
    return int.from_bytes(d[a:b], "big")


def _float(d: bytes, a: int, b: int) -> float:
    return struct.unpack(">f" if b - a == 4 else ">d", d[a:b])[0] if b > a else 0.0


def _laces(d: bytes, at: int, end: int, kind: int) -> tuple[list[int], int]:
    """Frame sizes of a block and where its frames begin."""
    if kind == 0:
        return [end - at], at
    n = d[at] + 1
    at += 1
    if kind == 2:  # fixed
        if (end - at) % n:
            raise ValueError("fixed lacing of unequal frames")
        return [(end - at) // n] * n, at
    sizes = []
    if kind == 1:  # Xiph: bytes of 255, then a smaller one
        for _ in range(n - 1):
            size = 0
            while d[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + d[at])
            at += 1
    elif n > 1:
        size, at = _read_vint(d, at)
        sizes.append(size)
        for _ in range(n - 2):
            start = at
            raw, at = _read_vint(d, at)
            width = at - start
            raw = raw if raw >= 0 else (1 << 7 * width) - 1
            sizes.append(sizes[-1] + raw - ((1 << 7 * width - 1) - 1))
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("lace sizes pass the block's end")
    return sizes, at


_LACING = ("none", "xiph", "fixed", "ebml")


def demux(d: bytes) -> Media:
    """Packets, tracks and cues of a Matroska file. ValueError where it is malformed, or where a number fits no column."""
    try:
        m = _demuxed(d)
    except (LookupError, OverflowError, struct.error) as e:
        raise ValueError(f"malformed media: {e!r}") from e
    if any(not 0 <= p.track < 1 << 31 or abs(p.timestamp_ns) >= 1 << 63 for p in m.packets) or not 0 <= m.duration_ns < 1 << 63:
        raise ValueError("a track number, timestamp or duration is out of range")
    return m


def _resolve(m: Media, blocks: dict[tuple[int, int], int]) -> None:
    """Marks the packets that cues point to. `blocks`: number of the first packet by cluster and block position."""
    number = {at: k for k, at in enumerate(m.clusters)}
    first: dict[tuple[int, int], int] = {}
    for i, p in enumerate(m.packets):
        first.setdefault((p.cluster, p.track), i)
    for _, track, cluster, block in m.cues:
        k = number.get(cluster, -1)
        at = first.get((k, track)) if block is None else blocks.get((k, block))
        if at is None or m.packets[at].track != track:
            m.lost_cues += 1
        else:
            m.packets[at].cued = True


def _demuxed(d: bytes) -> Media:
    m = Media()
    blocks: dict[tuple[int, int], int] = {}
    scale = 1_000_000
    top = list(_elements(d, 0, len(d)))
    if not top or top[0][0] != EBML:
        raise ValueError("no EBML header")
    for ident, a, b in _elements(d, *top[0][1:]):
        if ident == DOC_TYPE:
            m.doc_type = d[a:b].decode("ascii", "replace")
    for segment, (ident, seg_a, seg_b) in enumerate(top[1:]):
        if ident != SEGMENT:
            continue
        for start, ident, a, b in _placed(d, seg_a, seg_b):
            if ident == INFO:
                info = {i: (x, y) for i, x, y in _elements(d, a, b)}
                scale = _number(d, *info[TIMESTAMP_SCALE]) if TIMESTAMP_SCALE in info else scale
                m.duration_ns = round(_float(d, *info[DURATION]) * scale) if DURATION in info else 0
            elif ident == TRACKS:
                for i, x, y in _elements(d, a, b):
                    if i == TRACK_ENTRY:
                        t = {j: (p, q) for j, p, q in _elements(d, x, y)}
                        audio = {j: (p, q) for j, p, q in _elements(d, *t[AUDIO])} if AUDIO in t else {}
                        m.tracks[_number(d, *t[TRACK_NUMBER])] = {
                            "type": _number(d, *t[TRACK_TYPE]) if TRACK_TYPE in t else 0,
                            "codec": d[slice(*t[CODEC_ID])].decode("ascii", "replace") if CODEC_ID in t else "",
                            "packet_ns": _number(d, *t[DEFAULT_DURATION]) if DEFAULT_DURATION in t else 0,
                            "rate": _float(d, *audio[SAMPLING_FREQUENCY]) if SAMPLING_FREQUENCY in audio else 8000.0,
                            "bits": _number(d, *audio[BIT_DEPTH]) if BIT_DEPTH in audio else 0,
                        }
            elif ident == CLUSTER:
                m.clusters.append((segment, start - seg_a))
                base = 0
                for place, i, x, y in _placed(d, a, b):
                    if i in (SIMPLE_BLOCK, BLOCK_GROUP):
                        blocks[len(m.clusters) - 1, place - a] = len(m.packets)
                    if i == TIMESTAMP:
                        base = _number(d, x, y)
                    elif i == SIMPLE_BLOCK:
                        _packets(d, x, y, base, scale, m, None)
                    elif i == BLOCK_GROUP:
                        inner = [(j, p, q) for j, p, q in _elements(d, x, y)]
                        key = not any(j == 0xFB for j, _, _ in inner)  # a reference to another block
                        for j, p, q in inner:
                            if j == BLOCK:
                                _packets(d, p, q, base, scale, m, key)
            elif ident == CUES:
                for i, x, y in _elements(d, a, b):
                    point = list(_elements(d, x, y))
                    time = next(((p, q) for j, p, q in point if j == CUE_TIME), None)
                    for j, p, q in point if time else ():
                        if j == CUE_TRACK_POSITIONS:
                            pos = {k: _number(d, *at) for k, *at in _elements(d, p, q)}
                            m.cues.append((_number(d, *time) * scale, pos.get(CUE_TRACK, 0), (segment, pos.get(CUE_CLUSTER_POSITION, 0)), pos.get(CUE_RELATIVE_POSITION)))
    _resolve(m, blocks)
    return m


def _packets(d: bytes, at: int, end: int, base: int, scale: int, m: Media, key: bool | None) -> None:
    track, at = _read_vint(d, at)
    if at + 3 > end:
        raise ValueError("truncated block")
    rel, flags = struct.unpack_from(">hB", d, at)
    kind = flags >> 1 & 3
    sizes, at = _laces(d, at + 3, end, kind)
    step = m.tracks.get(track, {}).get("packet_ns", 0)
    for i, size in enumerate(sizes):
        m.packets.append(Packet(track, (base + rel) * scale + i * step, at, size, bool(flags & 0x80) if key is None else key, _LACING[kind], len(m.clusters) - 1))
        at += size


def samples(media: bytes, m: Media | None = None, track: int = 1) -> bytes:
    """The bytes of a track's packets in order."""
    m = m or demux(media)
    return b"".join(media[p.start : p.start + p.size] for p in m.packets if p.track == track)


PACKETS = T.ArrayType(
    T.StructType([
        T.StructField("track", T.IntegerType()), T.StructField("timestamp_ns", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("size", T.LongType()), T.StructField("keyframe", T.BooleanType()), T.StructField("lacing", T.StringType()),
        T.StructField("cluster", T.IntegerType()), T.StructField("cued", T.BooleanType()),
    ])
)


def packet_table(df: DataFrame, media: str = "media", id_col: str = "doc_id") -> DataFrame:
    """One row per packet of each file: `id_col`, packet_no, track, timestamp_ns, start, size, keyframe, lacing, cluster, cued, error."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("track", pa.int32()), ("timestamp_ns", pa.int64()), ("start", pa.int64()), ("size", pa.int64()), ("keyframe", pa.bool_()), ("lacing", pa.string()), ("cluster", pa.int32()), ("cued", pa.bool_())]))
        for batch in batches:
            found, errors = [], []
            for blob in batch.column(1).to_pylist():
                try:
                    found.append([vars(p) for p in demux(blob).packets] if blob is not None else [])
                    errors.append(None)
                except ValueError as e:
                    found.append([{}])
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind), pa.array(errors, pa.string())], ["row", "packets", "error"])

    src = df.select(F.struct(F.col(id_col)).alias("row"), F.col(media).alias("media"))
    schema = T.StructType([T.StructField("row", src.schema["row"].dataType), T.StructField("packets", PACKETS), T.StructField("error", T.StringType())])
    return src.mapInArrow(run, schema).select("row.*", "error", F.posexplode("packets").alias("packet_no", "p")).select(id_col, "packet_no", "p.*", "error")


RESULTS = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_sha256", T.StringType()),
    T.StructField("tail_crc32", T.LongType()), T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType()),
    T.StructField("feature", T.StringType()), T.StructField("n_packets", T.LongType()), T.StructField("n_clusters", T.LongType()), T.StructField("media", T.BinaryType()),
])


def feature(payload: bytes, m: Media) -> str:
    """Packet layout and signal statistics, from what was read back."""
    x = np.frombuffer(payload, np.uint8)
    level = int(np.bincount(x, minlength=256) @ np.arange(256, dtype=np.int64))
    crossings = int(np.count_nonzero((x[1:] > 96) != (x[:-1] > 96)))
    lacing = "+".join(sorted({p.lacing for p in m.packets}))
    last = m.packets[-1]
    return f"t{len(m.tracks)};p{len(m.packets)};c{len(m.clusters)};q{len(m.cues) - m.lost_cues};{lacing};end{last.timestamp_ns // 1_000_000}+{last.size};sum{level};cross{crossings}"


def stored(df: DataFrame, text: str, carry: dict, keep_media: bool = True) -> DataFrame:
    """Each text as Matroska media, with digests and a feature of what is read back: columns `row` and `res`."""

    def run(arr: pa.Array) -> list[pa.Array]:
        data, at = raw_bytes(arr)
        data = data.tobytes()
        out: list[tuple] = []
        for a, b in zip(at[:-1], at[1:]):
            media = mux(padded(data[a:b]))
            m = demux(media)
            back = samples(media, m)
            out.append((b - a, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature(back, m), len(m.packets), len(m.clusters), media if keep_media else None))
        cols = list(zip(*out)) if out else [()] * 10
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        return [pa.array(list(c), k) for c, k in zip(cols, kinds)]

    return arrow_scan(df, text, carry, RESULTS, run)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return stored(docs, "text", {"doc_id": F.col("doc_id")}, keep_media=False).select("row.doc_id", *[f"res.{c}" for c in RESULTS.names if c != "media"])
