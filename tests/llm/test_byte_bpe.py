import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from siftline.llm import byte_bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_offsets(tokens, text):
    """(character offsets of each token, number of characters in several tokens), a byte at a time."""
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    spans, seen, at = [], {}, 0
    for k, token in enumerate(tokens):
        mine = owner[at : at + len(token)]
        spans.append((mine[0], mine[-1] + 1))
        for c in mine:
            seen.setdefault(c, set()).add(k)
        at += len(token)
    return spans, sum(len(x) > 1 for x in seen.values())


def test_equals_rank_merging(spark, reference):
    rng = random.Random(3)
    alphabet = "aaabbb eénñ'sß \u0085 \n\t 123٣²½$%€漢字😀👩‍🚀éİſ<|endoftext|>"
    texts = [None, "", " ", "<|endoftext|>", "a" * 5000, "ab" * 3000, "word " * 20000, "😀" * 300]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randrange(40))) for _ in range(500)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string").repartition(3)
    got = {r.doc_id: r for r in byte_bpe.round_trip(docs, RANKS, P.PATTERN).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = reference.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids), t
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), t
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest(), t
        spans, split = plain_offsets([reference.decode_single_token_bytes(x) for x in ids], t or "")
        assert got[i].offsets_sha256 == hashlib.sha256(b"".join(n.to_bytes(8, "little") for s in spans for n in s)).hexdigest(), t
        assert got[i].n_split == split, t
    assert byte_bpe.round_trip(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_documents_equal_rank_merging(spark, reference):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.ids_sha256 for r in byte_bpe.round_trip(docs, RANKS, P.PATTERN).collect()}
    assert got == {r.doc_id: hashlib.sha256(",".join(map(str, reference.encode_ordinary(r.text))).encode()).hexdigest() for r in docs.collect()}


def test_offsets_and_split_characters(spark):
    text = "Größe 漢字😀 end"
    docs = spark.createDataFrame([(1, text, "kept"), (2, None, "null")], "doc_id long, text string, token_ids string")
    enc = byte_bpe.encode(docs, RANKS, P.PATTERN, offsets_col="at")
    rows = {r.doc_id: r for r in byte_bpe.decode(enc, RANKS, P.PATTERN).collect()}
    assert bytes(rows[1].decoded).decode() == rows[1].decoded_text == text
    assert rows[2].token_ids == [] and rows[2].decoded_text == ""
    covered = {i for o in rows[1].at for i in range(o.start, o.end)}
    assert covered == set(range(len(text)))
    part = enc.filter("doc_id = 1").selectExpr("doc_id", "slice(token_ids, 1, size(token_ids) - 3) AS token_ids")
    cut = byte_bpe.decode(part, RANKS, P.PATTERN).first()
    assert text.encode().startswith(bytes(cut.decoded))
    codec = byte_bpe.ByteBPE(open(RANKS, "rb").read(), P.PATTERN)
    ids = next(iter(codec.encode(["\U0001f9ff"])))[0]
    assert len(ids) > 1 and codec.decode(ids[:1]).decode("utf-8", "replace").endswith("�") and codec.decode(ids).decode() == "\U0001f9ff"


def test_offsets_equal_the_library_and_bytes_go_back_by_the_table():
    codec = byte_bpe.ByteBPE(open(RANKS, "rb").read(), P.PATTERN)
    texts = ["Größe 漢字😀 end", "", "plain words", "\U0001f9ff\U0001f9ff x", "\u0301e\u0301 ½٣"]
    fast, slow = list(codec.encode(texts)), list(codec.encode(texts, offsets=True))
    for text, (ids, _), (same, spans) in zip(texts, fast, slow, strict=True):
        data = codec.decode(ids)
        assert ids == same and data == text.encode()
        assert [tuple(x) for x in codec.offsets(ids, data)[0].tolist()] == list(spans), text
    chars = byte_bpe.byte_characters()
    assert len(set(chars)) == 256 and all(codec._bytes[ord(c)] == b for b, c in enumerate(chars))
    with pytest.raises(KeyError):
        codec.decode([10**9])
