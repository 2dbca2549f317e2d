import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from siftline.llm import word_tries

COLUMNS = "doc_id long, text string"


def features(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target):
    buckets = lambda texts: Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in features(t)[1])
    s, t = buckets(x for _, x in docs), buckets(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(float(t[b] + 1) * float(s_all + 10000) / (float(s[b] + 1) * float(t_all + 10000))))
    rows = []
    for i, text in docs:
        words, found = features(text)
        weight = sum(gain(zlib.crc32(f.encode()) % 10000) for f in found)
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    drawn = able[: len(able) * 5 // 100]
    rank, out = {}, []
    for n, r in enumerate(drawn, 1):
        rank.setdefault(r, []).append(n)
    for r in rows:
        out.append((r[0], r[2], r[3], r[4], rank[r].pop(0) if rank.get(r) else None))
    return out


def test_resampling_against_plain_counts(spark):
    words = ["Alpha", "beta", "GAMMA", "délta", "x1", "été", "7", "z" * 90, "o" * 63, "p" * 64]
    docs = [(i, " ,".join(words[(i * j * j + j) % len(words)] for j in range(3 + i % 40))) for i in range(200)]
    docs += [(None, None), (None, "Alpha beta " * 30), (300, ""), (301, "... --- !"), (302, "İSTANBUL ß \x00 a\x7fb"), (303, "one"), (304, "one two")]
    docs += [(7, docs[7][1])] * 3 + [(305, "alpha beta gamma " * 20_000)]
    target = ["alpha beta gamma délta", None, "", "x1 été 7", "z" * 90 + " alpha"]
    frame = spark.createDataFrame([(*r, 1, "s") for r in docs], COLUMNS + ", weight int, rank string")  # names that the result has
    got = word_tries.resample(frame, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs, target), key=key)


def test_small_chunks_give_the_same_totals():
    texts = pa.array(["a b c a b c", None, "", "c b a " * 50, "b"] * 20)
    totals = []
    for chunk in (1, 64, 1 << 20):
        total = np.zeros(10000, np.int64)
        for _, _, levels in word_tries.tries(texts, chunk):
            for level in levels:
                np.add.at(total, level.state % 10000, level.counts())
        totals.append(total)
    want = Counter(zlib.crc32(f.encode()) % 10000 for t in texts.to_pylist() for f in features(t)[1])
    assert all(dict(enumerate(t)) == {b: want[b] for b in range(10000)} for t in totals)


def test_appended_bytes_give_the_whole_crc():
    spaced = [b" " + bytes([97 + n % 26]) * n for n in range(80)]
    state = np.array([zlib.crc32(b"start%d" % n) for n in range(80)], np.int64)
    assert word_tries.appended(state, np.arange(80), spaced).tolist() == [zlib.crc32(b"start%d" % n + s) for n, s in enumerate(spaced)]


@pytest.mark.parametrize("texts", [[], [None, "", "--"]])
def test_nothing_to_draw(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), COLUMNS)
    got = word_tries.resample(docs, spark.createDataFrame([], "text string")).collect()
    assert sorted((r.doc_id, r.n_features, r.weight, r["rank"]) for r in got) == [(i, 0, 0, None) for i in range(len(texts))]
