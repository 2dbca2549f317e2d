"""Matroska columns: documents' bytes as 8-bit PCM in a Matroska file, and files to packet, track and cue tables."""

from __future__ import annotations

import bz2
import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Element ids of the Matroska specification.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, FLAG_LACING, DEFAULT_DURATION = 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x9C, 0x23E383
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE_BLOCK, BLOCK_DURATION = 0xE7, 0xA3, 0xA0, 0xA1, 0xFB, 0x9B
ENCODINGS, ENCODING, ENCODING_ORDER, ENCODING_SCOPE, ENCODING_TYPE = 0x6D80, 0x6240, 0x5031, 0x5032, 0x5033
COMPRESSION, COMPRESSION_ALGORITHM, COMPRESSION_SETTINGS = 0x5034, 0x4254, 0x4255
CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
COMPRESSIONS = ("zlib", "bzlib", "lzo1x", "header")
LACINGS = ("none", "xiph", "fixed", "ebml")

FRAME = 192  # samples of a packet: 24 ms at 8 kHz
RATE = 8000
FRAMES_A_BLOCK, BLOCKS_A_CLUSTER = 8, 64


class Packet(NamedTuple):
    track: int
    timestamp: int  # in units of the timestamp scale, a millisecond unless the file says otherwise; of each frame of a lace
    offset: int
    size: int
    keyframe: bool
    lacing: str
    block: int  # byte position of the block's element
    cluster: int  # byte position of the cluster's element


class Encoding(NamedTuple):
    """How a track's frames are stored; they are decoded in order of the list that a track has of these."""

    kind: str  # one of COMPRESSIONS, "encrypted" or "unknown"
    header: bytes  # the bytes that "header" left out at the front of each frame


def _size(n: int) -> bytes:
    width = next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)  # all ones means unknown
    return (n | 1 << 7 * width).to_bytes(width, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + _size(len(body)) + body


def _uint(ident: int, n: int) -> bytes:
    return element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def lace(frames: list[bytes], lacing: str) -> bytes:
    """The body of a block after its flags: a laced block's header and its frames."""
    if lacing == "none":
        return frames[0]
    sizes, head = [len(f) for f in frames], bytes([len(frames) - 1])
    if lacing == "xiph":
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif lacing == "ebml" and len(sizes) > 1:
        head += _size(sizes[0])
        for a, b in zip(sizes[:-2], sizes[1:-1], strict=True):
            width = next(w for w in range(1, 9) if abs(b - a) < (1 << 7 * w - 1) - 1)
            head += ((b - a) + (1 << 7 * width - 1) - 1 | 1 << 7 * width).to_bytes(width, "big")
    return head + b"".join(frames)


def mux(payload: bytes) -> bytes:
    """A file with ``payload`` (a multiple of 192 bytes) as the samples of one 8-bit PCM track; blocks take turns in lacing."""
    frames = [payload[i : i + FRAME] for i in range(0, len(payload), FRAME)]
    stamp = lambda i: i * FRAME * 1000 // RATE
    clusters, cues, at, i, turn = [], [], 0, 0, 0
    info = element(INFO, _uint(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", stamp(len(frames)))) + element(MUXING_APP, b"siftline") + element(WRITING_APP, b"siftline"))
    audio = element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + _uint(CHANNELS, 1) + _uint(BIT_DEPTH, 8))
    entry = _uint(TRACK_NUMBER, 1) + _uint(TRACK_UID, 1) + _uint(TRACK_TYPE, 2) + _uint(FLAG_LACING, 1) + _uint(DEFAULT_DURATION, FRAME * 1_000_000_000 // RATE) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio
    head = info + element(TRACKS, element(TRACK_ENTRY, entry))
    at = len(head)
    while i < len(frames):
        start, blocks = stamp(i), []
        for _ in range(BLOCKS_A_CLUSTER):
            if i >= len(frames):
                break
            kind = turn % 4
            group = frames[i : i + (FRAMES_A_BLOCK if kind else 1)]
            body = b"\x81" + struct.pack(">hB", stamp(i) - start, 0x80 | kind << 1) + lace(group, LACINGS[kind])
            blocks.append(element(SIMPLE_BLOCK, body))
            i, turn = i + len(group), turn + 1
        clusters.append(element(CLUSTER, _uint(CLUSTER_TIMESTAMP, start) + b"".join(blocks)))
        cues.append(element(CUE_POINT, _uint(CUE_TIME, start) + element(CUE_TRACK_POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER_POSITION, at))))
        at += len(clusters[-1])
    header = b"".join(_uint(k, v) for k, v in ((0x4286, 1), (0x42F7, 1), (0x42F2, 4), (0x42F3, 8))) + element(0x4282, b"matroska") + _uint(0x4287, 4) + _uint(0x4285, 2)
    return element(EBML, header) + element(SEGMENT, head + b"".join(clusters) + element(CUES, b"".join(cues)))


def vint(data: bytes, at: int, keep_marker: bool = False) -> tuple[int, int]:
    """(value, position after) of a variable-length integer; -1 is the reserved size unknown."""
    first = data[at]
    if not first:
        raise ValueError(f"no variable-length integer at {at}")
    width = 9 - first.bit_length()
    value = int.from_bytes(data[at : at + width], "big")
    if at + width > len(data):
        raise ValueError(f"cut off at {at}")
    if not keep_marker:
        value ^= 1 << 7 * width
        value = -1 if value == (1 << 7 * width) - 1 else value
    return value, at + width


def elements(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(id, position, body, end) of the elements in a body; an element of unknown size ends with what holds it."""
    while at < end:
        ident, body = vint(data, at, keep_marker=True)
        size, body = vint(data, body)
        to = end if size < 0 else body + size
        if to > end:
            raise ValueError(f"element {ident:x} at {at} runs past {end}")
        yield ident, at, body, to
        at = to


def laced_sizes(data: bytes, at: int, end: int, lacing: int) -> tuple[list[int], int]:
    """(sizes of the frames, position of the first) of a block's body after its flags."""
    if not lacing:
        return [end - at], at
    n, at = data[at] + 1, at + 1
    if lacing == 2:
        if (end - at) % n:
            raise ValueError(f"{end - at} bytes at {at} are no {n} frames of one size")
        return [(end - at) // n] * n, at
    sizes: list[int] = []
    for i in range(n - 1):
        if lacing == 1:
            total = 0
            while data[at] == 255:
                total, at = total + 255, at + 1
            total, at = total + data[at], at + 1
        else:
            before = at
            total, at = vint(data, at)
            if i:
                bias = (1 << 7 * (at - before) - 1) - 1
                total = sizes[-1] + (total if total >= 0 else (1 << 7 * (at - before)) - 1) - bias
        sizes.append(total)
    return [*sizes, end - at - sum(sizes)], at


class Parsed(NamedTuple):
    packets: list[Packet]
    tracks: list[tuple[int, int, str, float]]  # number, type, codec, sampling frequency
    cues: list[tuple[int, int, int]]  # timestamp, track, byte position of the cluster
    scale: int
    encodings: dict[int, list[Encoding]]  # of the frames of a track, in order of decoding; only tracks that have some


def _encodings(data: bytes, at: int, end: int) -> list[Encoding]:
    """Those of a ContentEncodings element that cover frames; the last applied is undone first."""
    found = []
    for ident, _, a, b in elements(data, at, end):
        if ident != ENCODING:
            continue
        got = {k: data[c:d] for k, _, c, d in elements(data, a, b)}
        number = lambda of, k, least: int.from_bytes(of[k], "big") if k in of else least
        if not number(got, ENCODING_SCOPE, 1) & 1:
            continue
        how = {k: got[COMPRESSION][c:d] for k, _, c, d in elements(got[COMPRESSION], 0, len(got[COMPRESSION]))} if COMPRESSION in got else {}
        algorithm = number(how, COMPRESSION_ALGORITHM, 0)
        kind = "encrypted" if number(got, ENCODING_TYPE, 0) else COMPRESSIONS[algorithm] if algorithm < len(COMPRESSIONS) else "unknown"
        found.append((number(got, ENCODING_ORDER, 0), Encoding(kind, how.get(COMPRESSION_SETTINGS, b"") if kind == "header" else b"")))
    return [e for _, e in sorted(found, key=lambda x: -x[0])]


def frame(data: bytes | memoryview, packet: Packet, encodings: dict[int, list[Encoding]]) -> bytes | memoryview:
    """A packet's frame as its codec takes it: the stored bytes with the track's encodings undone.

    Encrypted frames, and those of compressions other than zlib, bzip2 and header stripping, are a ValueError.
    """
    out = data[packet.offset : packet.offset + packet.size]
    for e in encodings.get(packet.track, ()):
        if e.kind == "header":
            out = e.header + bytes(out)
        elif e.kind in ("zlib", "bzlib"):
            try:
                out = zlib.decompress(out) if e.kind == "zlib" else bz2.decompress(out)
            except (zlib.error, OSError) as broken:
                raise ValueError(f"frame at {packet.offset} is no {e.kind} data") from broken
        else:
            raise ValueError(f"frames of track {packet.track} are {e.kind}")
    return out


def parse(data: bytes, clusters: Callable[[int], bool] | None = None) -> Parsed:
    """Packets in file order, tracks and cues; a file without a segment has none, a broken one is an error.

    ``clusters`` tells by byte position which clusters to read (otherwise all); the others are stepped over by their size.
    A cluster of unknown size ends where the next element of the segment begins. A block's timestamp is that of its first
    frame. Each later frame of a lace follows by its track's default duration, else by its share of the block's duration,
    else, in PCM, by the time that the bytes before it take; where a file tells none of these it repeats the block's.
    """
    uint = lambda a, b: int.from_bytes(data[a:b], "big")
    out = Parsed([], [], [], 1_000_000, {})
    scale, top_level = out.scale, {INFO, TRACKS, CLUSTER, CUES}
    laces: list[tuple[int, int, int]] = []  # first packet, number of packets, duration of the block (0: not told)
    default: dict[int, int] = {}  # by track: nanoseconds of a frame
    byte_rate: dict[int, float] = {}  # by PCM track: bytes a second

    def block(at: int, end: int, element_at: int, cluster: tuple[int, int], simple: bool, key: bool, duration: int = 0) -> None:
        track, at = vint(data, at)
        relative, flags = struct.unpack_from(">hB", data, at)
        lacing = flags >> 1 & 3
        sizes, start = laced_sizes(data, at + 3, end, lacing)
        if min(sizes) < 0:
            raise ValueError(f"laces run past the block at {element_at}")
        if len(sizes) > 1:
            laces.append((len(out.packets), len(sizes), duration))
        for n in sizes:
            out.packets.append(Packet(track, cluster[1] + relative, start, n, bool(flags & 0x80) if simple else key, LACINGS[lacing], element_at, cluster[0]))
            start += n

    def segment(at: int, end: int) -> None:
        nonlocal scale
        base, cluster, todo = at, (0, 0), [elements(data, at, end)]
        while todo:
            for ident, pos, a, b in todo[-1]:
                if ident == CLUSTER:
                    if clusters is not None and not clusters(pos) and vint(data, vint(data, pos, True)[1])[0] >= 0:
                        continue
                    cluster = (pos, 0)
                    todo.append(elements(data, a, b))
                    break
                if ident in (INFO, TRACKS, CUE_POINT, CUES, BLOCK_GROUP) or ident in top_level:
                    if ident == BLOCK_GROUP:
                        inner = list(elements(data, a, b))
                        key = not any(x[0] == REFERENCE_BLOCK for x in inner)
                        duration = next((uint(c, d) for i, _, c, d in inner if i == BLOCK_DURATION), 0)
                        for i, p, c, d in inner:
                            if i == BLOCK:
                                block(c, d, p, cluster, False, key, duration)
                    elif ident == INFO:
                        scale = next((uint(c, d) for i, _, c, d in elements(data, a, b) if i == TIMESTAMP_SCALE), scale)
                    elif ident == TRACKS:
                        for i, _, c, d in elements(data, a, b):
                            if i == TRACK_ENTRY:
                                got = {k: (e, f) for k, _, e, f in elements(data, c, d)}
                                sound = {k: (e, f) for k, _, e, f in elements(data, *got[AUDIO])} if AUDIO in got else {}
                                rate = data[slice(*sound[SAMPLING_FREQUENCY])] if SAMPLING_FREQUENCY in sound else b""
                                rate = struct.unpack(">d" if len(rate) == 8 else ">f", rate)[0] if rate else 0.0
                                number = lambda k, of=got, least=0: max(uint(*of[k]) if k in of else 0, least)
                                codec = data[slice(*got[CODEC_ID])].decode("ascii", "replace") if CODEC_ID in got else ""
                                default[number(TRACK_NUMBER)] = number(DEFAULT_DURATION)
                                byte_rate[number(TRACK_NUMBER)] = rate * number(CHANNELS, sound, 1) * number(BIT_DEPTH, sound) / 8 if codec.startswith("A_PCM/") else 0.0
                                if ENCODINGS in got and (how := _encodings(data, *got[ENCODINGS])):
                                    out.encodings[number(TRACK_NUMBER)] = how
                                out.tracks.append((number(TRACK_NUMBER), number(TRACK_TYPE), codec, rate))
                    elif ident == CUES:
                        for i, _, c, d in elements(data, a, b):
                            time = next((uint(e, f) for k, _, e, f in elements(data, c, d) if k == CUE_TIME), 0) if i == CUE_POINT else 0
                            for k, _, e, f in elements(data, c, d) if i == CUE_POINT else ():
                                if k == CUE_TRACK_POSITIONS:
                                    where = {x: uint(y, z) for x, _, y, z in elements(data, e, f)}
                                    out.cues.append((time, where.get(CUE_TRACK, 0), base + where.get(CUE_CLUSTER_POSITION, 0)))
                elif ident == CLUSTER_TIMESTAMP:
                    cluster = (cluster[0], uint(a, b))
                elif ident == SIMPLE_BLOCK:
                    block(a, b, pos, cluster, True, True)
            else:
                todo.pop()

    for ident, _, a, b in elements(data, 0, len(data)):
        if ident == SEGMENT:
            segment(a, b)
    for at, n, duration in laces:  # tracks may be told after their packets
        first = out.packets[at]
        step, rate = default.get(first.track, 0), byte_rate.get(first.track, 0.0)
        for i, p in enumerate(out.packets[at : at + n]):
            passed = i * step // scale if step else i * duration // n if duration else int((p.offset - first.offset) * 1_000_000_000 / rate) // scale if rate else 0
            out.packets[at + i] = p._replace(timestamp=first.timestamp + passed)
    return out._replace(scale=scale)


def between(data: bytes, start_ms: int, end_ms: int) -> Parsed:
    """``parse`` of the packets with ``start_ms`` <= timestamp < ``end_ms``, from the clusters that the cues point to.

    Reading begins at each track's last cue at or before the start (all clusters before it are stepped over) and ends
    where a cue lies so far past the end that no block of its cluster reaches back: their times lie within 65,536 units. So packets before the cue that a track's entry is at, told out of order, aren't looked for. A file
    without cues, or a track of packets without any, is read from its first cluster.
    """
    index = parse(data, lambda _: False)
    unit = lambda ms: -(-ms * 1_000_000 // index.scale)
    first: dict[int, int] = {t[0]: 0 for t in index.tracks}
    last = len(data)
    for time, track, place in sorted(index.cues):
        if time <= unit(start_ms):
            first[track] = max(first.get(track, 0), place)
        if time - (1 << 16) >= unit(end_ms):
            last = min(last, place)
    begin = min(first.values(), default=0)
    found = parse(data, lambda at: begin <= at < last)
    return found._replace(packets=[p for p in found.packets if unit(start_ms) <= p.timestamp < unit(end_ms)])


def store(docs: DataFrame, text_col: str = "text", media_col: str = "media") -> DataFrame:
    """``docs`` with its text replaced by ``media_col`` binary and n_bytes long: see ``payload``.

    A row per row, repeats included, and equal files for equal texts. Null texts are empty, long ones whole; an empty
    table stays empty. The other columns stay, but for those that already bear the names of the two new ones.
    """
    own = [c for c in docs.columns if c not in (text_col, media_col, "n_bytes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, files = [], []
            for text in batch.column(batch.num_columns - 1):
                data = (text.as_py() or "").encode()
                sizes.append(len(data))
                files.append(mux(payload(data)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=[*own, "n_bytes", media_col])

    return docs.select(*own, F.col(text_col).alias("_text")).mapInArrow(run, docs.select(*own).schema.add("n_bytes", "long").add(media_col, "binary"))


def payload(data: bytes) -> bytes:
    """``data`` with spaces up to a positive multiple of 192 bytes."""
    return data.ljust(max(1, -(-len(data) // FRAME)) * FRAME)


_PACKETS = "track int, timestamp long, byte_offset long, byte_size long, keyframe boolean, lacing string, block_offset long, cluster_offset long"
_TRACKS = "track int, kind int, codec string, sampling_frequency double, encodings string"
_FRAMES = f"{_PACKETS}, frame binary"
_CUES = "timestamp long, track int, cluster_offset long"


def _rows(files: DataFrame, id_cols: list[str], media_col: str, errors: str, ddl: str, found: Callable[[bytes], list[tuple]]) -> DataFrame:
    """A row per tuple that ``found`` makes of a file: ``id_cols`` and the columns of ``ddl``.

    Null files have none. A broken file is an error, or with ``errors="skip"`` has none.
    """
    schema = StructType([*files.select(*id_cols).schema.fields, *StructType.fromDDL(ddl).fields])
    kinds = to_arrow_schema(StructType.fromDDL(ddl)).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                try:
                    rows = found(batch.column(batch.num_columns - 1)[row].as_py() or b"")
                except (ValueError, IndexError, struct.error):
                    if errors == "raise":
                        raise
                    continue
                if rows:
                    ids = [pa.repeat(batch.column(i)[row], len(rows)) for i in range(len(id_cols))]
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*ids, *columns], names=schema.names)

    return files.select(*id_cols, media_col).mapInArrow(run, schema)


def packets(files: DataFrame, id_cols: list[str], media_col: str = "media", errors: str = "raise") -> DataFrame:
    """A row per packet: ``id_cols``, track, timestamp (ms), byte range, keyframe, lacing, block and cluster positions; see ``_rows``."""
    return _rows(files, id_cols, media_col, errors, _PACKETS, lambda data: [x._replace(timestamp=x.timestamp * p.scale // 1_000_000) for p in [parse(data)] for x in p.packets])


def frames(files: DataFrame, id_cols: list[str], start_ms: int, end_ms: int, media_col: str = "media", errors: str = "raise") -> DataFrame:
    """The rows of ``packets`` from ``start_ms`` until before ``end_ms``, found by ``between``, with frame binary: see ``frame``."""

    def found(data: bytes) -> list[tuple]:
        p = between(data, start_ms, end_ms)
        return [(*x._replace(timestamp=x.timestamp * p.scale // 1_000_000), bytes(frame(data, x, p.encodings))) for x in p.packets]

    return _rows(files, id_cols, media_col, errors, _FRAMES, found)


def tracks(files: DataFrame, id_cols: list[str], media_col: str = "media", errors: str = "raise") -> DataFrame:
    """A row per track: ``id_cols``, its number, kind (1 video, 2 audio), codec, sampling frequency and encodings; see ``_rows``.

    Encodings name what ``frame`` undoes, in its order, split by commas; "header" has the stripped bytes behind a colon.
    """

    def found(data: bytes) -> list[tuple]:
        p = parse(data, lambda _: False)
        told = lambda n: ",".join(f"{e.kind}:{e.header.hex()}" if e.kind == "header" else e.kind for e in p.encodings.get(n, ()))
        return [(*t, told(t[0])) for t in p.tracks]

    return _rows(files, id_cols, media_col, errors, _TRACKS, found)


def cues(files: DataFrame, id_cols: list[str], media_col: str = "media", errors: str = "raise") -> DataFrame:
    """A row per cue: ``id_cols``, timestamp (ms), track and the byte position of its cluster; see ``_rows``."""
    return _rows(files, id_cols, media_col, errors, _CUES, lambda data: [(t * p.scale // 1_000_000, *rest) for p in [parse(data, lambda _: False)] for t, *rest in p.cues])


def digests(files: DataFrame, media_col: str = "media") -> DataFrame:
    """``files`` without the media, with payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    The payload is read back from the packets' byte ranges, with the encodings of their tracks undone. The feature counts packets, clusters, laced packets and
    cues that point at a cluster, and holds the last timestamp, the sum and the sum of squares of the samples. A row per
    row, repeats included; null files are files of no bytes, broken ones an error; an empty table stays empty. Columns
    that already bear the new names are replaced.
    """
    made = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    names = [x.split()[0] for x in made.split(", ")]
    own = [c for c in files.columns if c != media_col and c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for media in batch.column(batch.num_columns - 1):
                data = media.as_py() or b""
                parsed = parse(data)
                view = memoryview(data)
                back = b"".join([frame(view, p, parsed.encodings) for p in parsed.packets])
                samples = np.frombuffer(back, np.uint8)
                places = {p.cluster for p in parsed.packets}
                laced = sum(p.lacing != "none" for p in parsed.packets)
                last = parsed.packets[-1].timestamp if parsed.packets else -1
                counts = np.bincount(samples, minlength=256)
                squares = int((counts * np.arange(256) ** 2).sum())
                feature = f"packets={len(parsed.packets)};clusters={len(places)};laced={laced};cues={sum(c[2] in places for c in parsed.cues)};last={last};sum={int((counts * np.arange(256)).sum())};squares={squares}"
                rows.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature))
            columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in names]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, columns, kinds)], names=[*own, *names])

    schema = StructType([*files.select(*own).schema.fields, *StructType.fromDDL(made).fields])
    return files.select(*own, media_col).mapInArrow(run, schema)
