import bz2
import hashlib
import random
import struct
import zlib

import pytest

from siftline.llm import matroska as M


def test_lacing_round_trips():
    rng = random.Random(1)
    for lacing in (1, 3):
        for _ in range(200):
            frames = [rng.randbytes(rng.choice([0, 1, 254, 255, 256, 600, 9000])) for _ in range(rng.randrange(1, 9))]
            body = M.lace(frames, M.LACINGS[lacing])
            sizes, at = M.laced_sizes(body, 0, len(body), lacing)
            assert sizes == [len(f) for f in frames] and body[at:] == b"".join(frames)


def test_foreign_layout():
    """Unknown sizes, void elements, a block group with a reference, two tracks and a coarser clock."""
    block = lambda track, t, flags, data: bytes([0x80 | track]) + struct.pack(">hB", t, flags) + data
    one = M._uint(M.CLUSTER_TIMESTAMP, 100) + M.element(0xEC, b"\0" * 5) + M.element(M.SIMPLE_BLOCK, block(1, -3, 0x80, b"key"))
    two = M._uint(M.CLUSTER_TIMESTAMP, 200) + M.element(M.BLOCK_GROUP, M.element(M.BLOCK, block(2, 7, 0, b"delta")) + M._uint(M.REFERENCE_BLOCK, 1))
    cluster = lambda body: M.CLUSTER.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + body
    data = M.element(M.EBML, b"") + M.SEGMENT.to_bytes(4, "big") + b"\xff" + M.element(M.INFO, M._uint(M.TIMESTAMP_SCALE, 2_000_000)) + cluster(one) + cluster(two)
    parsed = M.parse(data)
    assert [(p.track, p.timestamp, data[p.offset : p.offset + p.size], p.keyframe) for p in parsed.packets] == [(1, 97, b"key", True), (2, 207, b"delta", False)]
    assert parsed.scale == 2_000_000
    with pytest.raises(ValueError):
        M.parse(M.mux(b" " * 192)[:-3])


def test_fixed_lacing_must_come_out_even():
    assert M.laced_sizes(b"\x01abcd", 0, 5, 2) == ([2, 2], 1)
    with pytest.raises(ValueError, match="5 bytes"):
        M.laced_sizes(b"\x01abcde", 0, 6, 2)


def test_times_within_laces():
    """By the track's default duration, by the block's, by the bytes of PCM, or not at all; tracks may come last."""
    block = bytes([0x81]) + struct.pack(">hB", 5, 2 << 1) + M.lace([b"abcd"] * 4, "fixed")
    sound = M.element(M.AUDIO, M.element(M.SAMPLING_FREQUENCY, struct.pack(">f", 1000)) + M._uint(M.CHANNELS, 2) + M._uint(M.BIT_DEPTH, 8))

    def times(codec: bytes, track: bytes = b"", duration: bytes = b"") -> list[int]:
        tracks = M.element(M.TRACKS, M.element(M.TRACK_ENTRY, M._uint(M.TRACK_NUMBER, 1) + M.element(M.CODEC_ID, codec) + sound + track))
        group = M.element(M.BLOCK_GROUP, M.element(M.BLOCK, block) + duration)
        return [p.timestamp for p in M.parse(M.element(M.SEGMENT, M.element(M.CLUSTER, M._uint(M.CLUSTER_TIMESTAMP, 100) + group) + tracks)).packets]

    assert times(b"A_OPUS", M._uint(M.DEFAULT_DURATION, 20_000_000)) == [105, 125, 145, 165]
    assert times(b"A_OPUS", duration=M._uint(M.BLOCK_DURATION, 40)) == [105, 115, 125, 135]
    assert times(b"A_PCM/INT/LIT") == [105, 107, 109, 111]
    assert times(b"A_OPUS") == [105] * 4


def encoded(frame: bytes, *encodings: bytes) -> bytes:
    track = M.element(M.TRACK_ENTRY, M._uint(M.TRACK_NUMBER, 1) + M.element(M.CODEC_ID, b"A_MPEG/L3") + M.element(M.ENCODINGS, b"".join(M.element(M.ENCODING, e) for e in encodings)))
    block = M.element(M.SIMPLE_BLOCK, bytes([0x81]) + struct.pack(">hB", 0, 0x80) + frame)
    return M.element(M.SEGMENT, M.element(M.TRACKS, track) + M.element(M.CLUSTER, M._uint(M.CLUSTER_TIMESTAMP, 0) + block))


def compression(algorithm: int, settings: bytes = b"", order: int = 0, scope: int = 1) -> bytes:
    return M._uint(M.ENCODING_ORDER, order) + M._uint(M.ENCODING_SCOPE, scope) + M.element(M.COMPRESSION, M._uint(M.COMPRESSION_ALGORITHM, algorithm) + M.element(M.COMPRESSION_SETTINGS, settings))


def test_content_encodings(spark):
    """Stripped headers come back, compressions are undone last first, private data's alone don't touch frames."""
    files = {
        "header:fffb": encoded(b"abcd", compression(3, b"\xff\xfb")),
        "zlib": encoded(zlib.compress(b"\xff\xfbabcd"), compression(0)),
        "bzlib,header:ff": encoded(bz2.compress(b"\xfbabcd"), compression(3, b"\xff"), compression(1, order=1)),
        "": encoded(b"\xff\xfbabcd", compression(0, scope=2)),
    }
    table = spark.createDataFrame([(k, v, 1) for k, v in files.items()], "name string, media binary, frame int")
    assert {r.name: r.encodings for r in M.tracks(table, ["name"]).collect()} == {k: k for k in files}
    assert {bytes(r.frame) for r in M.frames(table, ["name"], 0, 10).collect()} == {b"\xff\xfbabcd"}
    assert {r.payload_sha256 for r in M.digests(table).collect()} == {hashlib.sha256(b"\xff\xfbabcd").hexdigest()}
    for bad in (encoded(b"abcd", M._uint(M.ENCODING_TYPE, 1)), encoded(b"abcd", compression(2)), encoded(b"abcd", compression(0))):
        parsed = M.parse(bad)
        with pytest.raises(ValueError):
            M.frame(bad, parsed.packets[0], parsed.encodings)
        broken = spark.createDataFrame([(1, bad)], "name int, media binary")
        assert M.packets(broken, ["name"]).count() == 1 and M.frames(broken, ["name"], 0, 10, errors="skip").count() == 0


def test_seeking_by_cues():
    """A range read from the clusters that cues point to holds what a whole parse does, and reads less."""
    data = M.mux(random.Random(5).randbytes(192 * 40_000))
    whole = M.parse(data)
    end = whole.packets[-1].timestamp + 24
    for start, stop in ((0, 1), (0, end), (500_000, 500_100), (501_233, 511_234), (end - 24, end), (end, end + 5), (30, 30)):
        part = M.between(data, start, stop)
        assert part.packets == [p for p in whole.packets if start <= p.timestamp < stop]
    read = []
    seek = M.parse(data, lambda at: read.append(at) or False)
    assert not seek.packets and seek.cues == whole.cues and len(read) == len(whole.cues)
    without = M.element(M.SEGMENT, M.element(M.CLUSTER, M._uint(M.CLUSTER_TIMESTAMP, 7) + M.element(M.SIMPLE_BLOCK, b"\x81\0\0\x80x")))
    assert [p.timestamp for p in M.between(without, 7, 8).packets] == [7]
    assert M.between(b"", 0, 9).packets == []


def test_documents_and_edge_cases(spark):
    texts = [None, "", "x", "é" * 96, "z" * 193, "long 漢 " * 200_000, "x"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, feature string")
    files = M.store(docs).cache()
    got = {r.doc_id: r for r in M.digests(files).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        full = raw + b" " * (192 - len(raw)) if len(raw) < 192 else raw + b" " * (-len(raw) % 192)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))
        assert f"packets={len(full) // 192};" in r.feature and f";sum={sum(full)};" in r.feature
    assert got[2].media_sha256 == got[6].media_sha256
    table = M.packets(files.filter("doc_id = 5"), ["doc_id"]).collect()
    assert [r.timestamp for r in table] == [24 * i for i in range(len(table))] and {r.lacing for r in table} == set(M.LACINGS)
    assert M.packets(files.selectExpr("doc_id", "cast('junk' as binary) AS media"), ["doc_id"], errors="skip").count() == 0
    assert M.digests(M.store(docs.limit(0))).count() == 0
    places = {r.cluster_offset for r in table}
    assert [tuple(r) for r in M.tracks(files.filter("doc_id = 2"), ["doc_id"]).collect()] == [(2, 1, 2, "A_PCM/INT/LIT", 8000.0, "")]
    found = M.cues(files.filter("doc_id = 5"), ["doc_id"]).collect()
    assert {r.cluster_offset for r in found} == places and [r.timestamp for r in found] == sorted({min(p.timestamp for p in table if p.cluster_offset == c) for c in places})
