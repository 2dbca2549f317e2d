import base64
import hashlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pyarrow.parquet as pq
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from siftline.llm import importance_resampling, source_mixing, toxicity
from siftline.llm.shared_storage import written
from tests.llm.test_near_copies import brute

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, SF), f"test-{i}")
        if i < 4:
            assert docs.columns == COLUMNS, name
        kept.append(docs.collect())
    original = spark.read.parquet(f"{SF}/documents.parquet")
    label_table = spark.read.parquet(f"{SF}/labels.parquet")
    everything = {r.doc_id: r for r in original.collect()}

    selected = {r.id for r in importance_resampling.select(original, label_table).filter("selected").collect()}
    assert sorted(r.doc_id for r in kept[0]) == sorted(selected)
    assert all(r == everything[r.doc_id] for r in kept[0])
    assert len([r.doc_id for r in kept[0] if labels.get(r.doc_id, {}).get("quality") == 0]) <= 1  # of some fifty
    assert len([d for d, x in labels.items() if x["quality"] == 1 and d not in selected]) <= 2  # of some 350

    first = spark.createDataFrame(kept[0], original.schema)
    model = toxicity.train(first, label_table)
    fine = {r.doc_id for r in toxicity.score(first.select("doc_id", "text"), model).filter(F.col("score") < 0.5).collect()}
    assert sorted(r.doc_id for r in kept[1]) == sorted(fine)

    least, edited = brute([(r.doc_id, r.text) for r in kept[1]])
    assert sorted(r.doc_id for r in kept[2]) == least and edited > 0 and len(kept[2]) < len(kept[1])
    assert all(r == everything[r.doc_id] for r in kept[2])

    mixed = {r.doc_id: r for r in source_mixing.mix(spark.createDataFrame(kept[2], original.schema)).collect()}
    times, words = Counter(r.doc_id for r in kept[3]), defaultdict(int)
    for d, r in mixed.items():
        assert times[d] * r.size == r.taken and times[d] <= 3
        words[everything[d].source] += r.taken
    assert all(abs(words[everything[d].source] - r.target) <= 20_000 for d, r in mixed.items())
    assert set(times) <= set(mixed)

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in kept[3]:
        ids = enc.encode_ordinary(r.text)
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in kept[4]) == want
    again = corpus_pipeline.run(spark, SF).collect()
    assert Counter(again) == Counter(kept[4])


def test_edge_cases(spark):
    rows = [(1, None, None, None, None, 1), (2, "", "en", "a", 0, 2), (None, "text without an id", "en", None, 5, 3), (4, "word " * 50000, "en", "a", 1, 4), (5, "twice the same", "en", "b", 1, 5), (5, "twice the same", "en", "b", 1, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int")
    for table in (docs, docs.filter(F.lit(False))):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            table = written(stage(spark, table, SF), f"edge-{i}")
            assert i == 4 or table.columns == docs.columns
        table.collect()
