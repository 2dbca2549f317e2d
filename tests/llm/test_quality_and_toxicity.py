import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftline.llm import importance_resampling as IR
from siftline.llm import toxicity as T
from siftline.llm import word_hashes as H

SF = "/root/testdata/sf0.1"


def test_word_hashes_follow_words_only():
    texts = pa.array(["The CAT sat", None, "", "cat", " the\tcat  dog", "été the", "x" * 100, "...", "a,b"])
    words, runs = [], []
    for first, last, w in H.word_batches(texts, chunk_bytes=8):
        words += [(first + d, bytes(w.data[a:b]).decode().lower(), h) for d, a, b, h in zip(w.doc, w.start, w.end, w.hash, strict=True)]
    assert [(d, t) for d, t, _ in words] == [(i, t) for i, s in enumerate(texts.to_pylist()) for t in (s or "").lower().split()]
    assert len({t for _, t, _ in words}) == len({h for _, _, h in words}) == len({(t, h) for _, t, h in words})
    for _, _, w in H.word_batches(pa.array(["ab***c ,,x", "*"]), marks=b"*,"):
        runs += [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end, strict=True)]
    assert runs == ["ab", "***", "c", ",,", "x", "*"]


def test_kth_largest(spark):
    rng = np.random.default_rng(2)
    for values in (rng.normal(size=5000), np.round(rng.normal(size=3000), 1), np.full(50, 2.5), np.append(rng.normal(size=100), [1e9, -1e9, 0.0, 5e-324]), np.append(np.linspace(1.0, 1.0 + 1e-12, 50), 3.0)):
        df = spark.createDataFrame([(float(v),) for v in values], "key double")
        for k in (1, 2, len(values) // 3, len(values)):
            assert IR.kth_largest(df, k) == np.sort(values)[-k]
    assert IR.kth_largest(df.limit(0), 3) == math.inf


def test_quality_selection(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = IR.select(docs, labels)
    rows = got.join(labels, got["id"] == labels["doc_id"]).select("id", "quality", "selected").collect()
    good, bad = [r.selected for r in rows if r.quality == 1], [r.selected for r in rows if r.quality == 0]
    assert np.mean(good) > 0.998 and np.mean(bad) < 0.02
    few = labels.filter("doc_id % 2 = 0")  # the other half is held out
    unseen = IR.select(docs, few).join(labels.filter("doc_id % 2 = 1"), F.col("id") == F.col("doc_id")).select("quality", "selected").collect()
    assert np.mean([r.selected == bool(r.quality) for r in unseen]) > 0.995


def test_log_weight_against_a_plain_count(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = docs.select("doc_id", "text").collect()
    found = {}
    for _, _, row, feature in IR.features(pa.array([r.text for r in rows])):
        for i, f in zip(row.tolist(), feature.tolist(), strict=True):
            found.setdefault(i, []).append(f)
    raw, target = np.zeros(IR.FEATURES), np.zeros(IR.FEATURES)
    for i, r in enumerate(rows):
        np.add.at(raw, found.get(i, []), 1)
        if quality.get(r.doc_id) == 1:
            np.add.at(target, found.get(i, []), 1)
    ratio = IR.log_ratio(target, raw)
    want = {r.doc_id: sum(ratio[f] for f in found.get(i, [])) * min(1, IR.EVIDENCE / max(1, len(found.get(i, [])))) for i, r in enumerate(rows)}
    got = IR.select(docs, labels).collect()
    for r in got:
        assert r.log_weight == pytest.approx(want[r.id], abs=1e-6)
    # the selection, from keys and labels alone: the cut that parts the labelled rows best, then all rows above it
    known = sorted((r.key, quality[r.id]) for r in got if quality.get(r.id) is not None)
    good, bad = sum(y for _, y in known), sum(1 - y for _, y in known)
    wrong = [sum(y for _, y in known[: i + 1]) / good + sum(1 - y for _, y in known[i + 1 :]) / bad for i in range(len(known))]
    best = min(range(len(known)), key=lambda i: (wrong[i], i))
    cut = (known[best][0] + known[best + 1][0]) / 2 if wrong[best] < 1 and best + 1 < len(known) else -math.inf if wrong[best] >= 1 else math.inf
    assert {r.id for r in got if r.selected} == {r.id for r in got if r.key > cut}


def test_one_draw_follows_the_weights(spark):
    logs = [0.0, 1.0, 2.0, -1.0]
    rows = spark.range(4 * 20000).select((F.col("id") % 4).cast("int").alias("i"), F.floor(F.col("id") / 4).alias("trial"))
    keyed = rows.withColumn("key", IR.gumbel_key(F.element_at(F.array(*map(F.lit, logs)), F.col("i") + 1), 5, "i", "trial"))
    won = keyed.groupBy("trial").agg(F.max_by("i", "key").alias("i")).groupBy("i").count().collect()
    share = np.exp(logs) / np.exp(logs).sum()
    for r in won:
        assert r["count"] / 20000 == pytest.approx(share[r.i], abs=0.015)


def test_seeds_draw_different_documents_by_weight(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    drawn = []
    for seed in (1, 2, 3):
        got = IR.select(docs, labels, k=200, seed=seed).collect()
        chosen = {r.id for r in got if r.selected}
        assert len(chosen) == 200
        by_weight = [r.id for r in sorted(got, key=lambda r: -r.log_weight)]
        assert chosen != set(by_weight[:200])  # noise matters
        first, last = set(by_weight[: len(got) // 4]), set(by_weight[-len(got) // 10 :])
        assert len(chosen & first) > 1.2 * len(got) // 4 * 200 / len(got) and len(chosen & last) <= 2
        drawn.append(chosen)
    assert 20 < len(drawn[0] & drawn[1]) < 180 and drawn[1] != drawn[2]
    again = {r.id for r in IR.select(docs.repartition(5), labels, k=200, seed=1).filter("selected").collect()}
    assert again == drawn[0]


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = T.score(docs.select("doc_id", "text"), T.train(docs, labels), locate=True).withColumn("held_out", T.held_out())
    rows = scored.filter("held_out").join(labels, "doc_id").select("toxic", "score", "predicted", "offending").collect()
    positive = [r for r in rows if r.toxic == 1]
    negative = [r for r in rows if r.toxic == 0]
    assert len(positive) > 30 and len(negative) > 200
    assert np.mean([r.predicted for r in positive]) > 0.8, "missed"
    assert np.mean([r.predicted for r in negative]) < 0.02, "false alarms"
    assert np.mean([len(r.offending) > 0 for r in positive if r.predicted]) > 0.8


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, selected string"


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "good words here. nasty slur\nfine"), (3, "good words here. nasty slur\nfine"), (None, "plain words"), (5, "word. " * 60000), (6, "!!! ..."), (7, "é nasty slur é! ok")]
    rows += [(10 + i, f"good words here. {'nasty slur' if i % 6 == 1 else 'kind remark'}. number {i} of them! fine") for i in range(240)]
    docs = spark.createDataFrame([(*r, None, None, 1, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    labels = spark.createDataFrame([(10 + i, int(i % 6 == 1), int(i % 6 != 1)) for i in range(240)] + [(None, 1, 1), (2, None, None)], "doc_id long, toxic int, quality int")
    model = T.train(docs, labels)
    got = T.score(docs.select("doc_id", "text", "score"), model, locate=True).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[1].score == by[2].score == by[6].score == 0.0 and by[3].predicted == 1
    assert [o.text for o in by[3].offending] == ["nasty slur"] and rows[2][1][by[3].offending[0].start : by[3].offending[0].end] == "nasty slur"
    assert rows[7][1][by[7].offending[0].start : by[7].offending[0].end] == by[7].offending[0].text
    assert all(r.predicted == int((r.doc_id - 10) % 6 == 1) for r in got if (r.doc_id or 0) >= 10)
    kept = T.keep_clean(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 2, None}
    chosen = IR.select(docs, labels).collect()
    assert len(chosen) == len(rows)
    best = IR.keep_selected(docs, labels)
    assert best.columns == docs.columns
    none = labels.filter(F.lit(False))
    assert T.keep_clean(docs, none).count() == len(rows) and IR.keep_selected(docs, none).count() == len(rows)
    assert T.keep_clean(docs.limit(0), labels).count() == 0 and IR.keep_selected(docs.limit(0), labels).count() == 0


def test_sentences_end_where_they_should():
    text = "One two. three? four!five\nsix"
    for _, _, w in H.word_batches(pa.array([text, "seven"]), H.WHITE_AND_PUNCTUATION):
        _, first = T.sentences(w)
        assert [bytes(w.data[w.start[i] : w.end[i]]).decode() for i in first] == ["One", "three", "four", "five", "six", "seven"]
    assert len(re.split(r"[.!?\n]+", text)) == 5


def test_selection_keeps_clashing_columns_and_repeated_ids(spark):
    rows = [(i, f"good plain words number {i}" if i % 2 else f"zz qq xx {i} zz", 7, "h", 1) for i in range(1, 40)] + [(1, "another text of the first id", 7, "h", 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h int, _id string, key int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 30)], "doc_id long, quality int, toxic int")
    kept = IR.keep_selected(docs, labels)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert got and {(r["_h"], r["_id"], r["key"]) for r in got} == {(7, "h", 1)} and [tuple(r) for r in got if tuple(r) not in set(rows)] == []
