"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import byte_bpe, dual_tree, importance_resampling, jump_hash, matroska, multiset_hash, near_copies, quote_threads, simhash, source_mixing, stupid_backoff, toxicity, word_tries
from siftline.sources.tables import read_parquet

#: The vocabulary of the byte-level BPE query.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def op1_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_threads.threads(_table(spark, sf_dir, "conversations"))


def with_quoted_replies(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, text) where each quotes the one before it at depth 1 and the one before that at depth 2.

    What a message answers is found by its number, so that a long conversation needs no ordering in one task.
    """
    said = messages.groupBy("conv_id", "turn").agg(F.min("text").alias("said"))
    out = messages.select("conv_id", "turn", "text")
    for back in (1, 2):
        out = out.join(said.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("said").alias(f"back{back}")), ["conv_id", "turn"], "left")
    quoted = lambda back, marks: F.concat(F.regexp_replace(F.col(back), "(?m)^", marks), F.lit("\n"))
    text = F.concat(F.coalesce(quoted("back2", ">> "), F.lit("")), F.coalesce(quoted("back1", "> "), F.lit("")), F.coalesce("text", F.lit("")))
    return out.select("conv_id", "turn", text.alias("text"))


def quoted_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linking of op1 where there are quotes to link: the tables' own conversations hold none."""
    return quote_threads.threads(with_quoted_replies(_table(spark, sf_dir, "conversations")))


def op2_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edits(_table(spark, sf_dir, "documents"))


def op3_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = matroska.digests(matroska.store(docs))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op4_jump_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_hash.place(_table(spark, sf_dir, "documents"), 24)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)


def op6_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stupid_backoff.scores(_table(spark, sf_dir, "documents"))


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = importance_resampling.select(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return picked.select(F.col("id").alias("doc_id"), "log_weight", F.col("key").alias("gumbel_key"), F.col("selected").alias("keep"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, labels), locate=True)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", F.size("offending").cast("long").alias("n_offending"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(_table(spark, sf_dir, "documents"))


def shared_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow of op9 where sources overlap: a text that several sources hold counts for any of them."""
    mixed = source_mixing.mix_shared(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", F.array_join("sources", ",").alias("sources"), "taken")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_word_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_tries.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.mine(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quote_threads": op1_quote_threads,
    "op2_multiset_hash": op2_multiset_hash,
    "op3_matroska": op3_matroska,
    "op4_jump_hash": op4_jump_hash,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_stupid_backoff": op6_stupid_backoff,
    "op7_importance_resampling": op7_importance_resampling,
    "op8_toxicity": op8_toxicity,
    "op9_source_mixing": op9_source_mixing,
    "op10_simhash": op10_simhash,
    "op11_word_tries": op11_word_tries,
    "op12_superminhash": op12_superminhash,
    "op13_dual_tree": op13_dual_tree,
    "quoted_replies": quoted_replies,
    "shared_source_mix": shared_source_mix,
}

#: DuckDB SQL for the queries that SQL can express; the others are tested against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op6_stupid_backoff": r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(list_concat([''], ws)) AS a, unnest(list_concat(ws, [''])) AS b FROM t WHERE len(ws) > 0),
o AS (SELECT doc_id, a, b, count(*) AS own FROM p GROUP BY ALL),
c AS (
  SELECT *, sum(own) OVER (PARTITION BY a, b) - own AS others, sum(own) OVER (PARTITION BY a) AS ca, sum(own) OVER (PARTITION BY b) AS cb, sum(own) OVER () AS total
  FROM o),
s AS (
  SELECT doc_id, CAST(sum(own) AS BIGINT) AS n_predictions, CAST(sum(CASE WHEN others = 0 THEN own ELSE 0 END) AS BIGINT) AS n_backoff,
    sum(own * CASE WHEN others > 0 THEN log10(others) - log10(ca) ELSE log10(0.4) + log10(cb) - log10(total) END) AS part
  FROM c GROUP BY doc_id)
SELECT doc_id, coalesce(n_predictions, 0) AS n_predictions, coalesce(n_backoff, 0) AS n_backoff, round(part / n_predictions, 6) AS mean_log10
FROM t LEFT JOIN s USING (doc_id)
""",
    "op9_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w, CAST(source_size * 3 AS DOUBLE) AS cap FROM s),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER b, 0.0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0)) AS share
  FROM w WINDOW b AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, CASE WHEN cap <= share * w THEN cap ELSE w * max(CASE WHEN cap > share * w THEN share END) OVER () END AS target FROM l),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target + 0.5) / source_size) AS BIGINT) ELSE 0 END AS passes,
    CAST(floor(target + 0.5) AS BIGINT) AS flow FROM t),
r AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.passes, q.flow - q.passes * q.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (passes + CASE WHEN upto <= rest OR (upto - size < rest AND upto - rest < size - (upto - rest)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
""",
    "op11_word_tries": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
f AS (
  SELECT doc_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]), list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS feature FROM d),
g AS (
  SELECT unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]), list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS feature FROM b),
fc AS (SELECT feature, count(*) AS n FROM f GROUP BY feature),
gc AS (SELECT feature, count(*) AS n FROM g GROUP BY feature),
entry AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
named AS (SELECT DISTINCT feature, hex(encode(feature)) AS x FROM (SELECT feature FROM fc UNION ALL SELECT feature FROM gc)),
hashed AS (
  SELECT feature, xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT))),
    lambda c, k: xor(c >> 8, t[xor(c & 255, k) + 1])), 4294967295) % 10000 AS bucket
  FROM named, entry),
s AS (SELECT bucket, sum(n) AS s FROM fc JOIN hashed USING (feature) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM gc JOIN hashed USING (feature) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM fc) + 10000 AS DOUBLE)
    / (CAST(s + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM gc) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, sum(gain) AS weight FROM f JOIN hashed USING (feature) JOIN gain USING (bucket) GROUP BY doc_id),
r AS (
  SELECT doc_id, len(ws) AS n, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (doc_id)),
k AS (SELECT *, CASE WHEN n >= 20 THEN row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) END AS place, count(*) FILTER (n >= 20) OVER () * 5 // 100 AS drawn FROM r)
SELECT doc_id, CAST(n + greatest(n - 1, 0) + greatest(n - 2, 0) AS BIGINT) AS n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM k
""",
    "op13_dual_tree": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * c.q[i])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
""",
    "op12_superminhash": r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) > 1 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS shingles FROM t),
n AS (SELECT doc_id, len(shingles) AS n FROM f),
e AS (SELECT doc_id, unnest(shingles) AS s FROM f),
often AS (SELECT s, count(*) AS df FROM e GROUP BY s),
-- sets of a similarity of 0.8 share one of the rarest shingles of each
first AS (
  SELECT doc_id, s, n FROM (SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, s) AS place FROM e JOIN often USING (s) JOIN n USING (doc_id))
  WHERE place <= n - (4 * n + 4) // 5 + 1),
candidate AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM first a JOIN first b ON a.s = b.s AND a.doc_id < b.doc_id
  WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
shared AS (SELECT a, b, any_value(na) AS na, any_value(nb) AS nb, count(*) AS i FROM candidate JOIN e x ON x.doc_id = a JOIN e y ON y.doc_id = b AND x.s = y.s GROUP BY a, b),
link AS (SELECT a, b FROM shared WHERE 100 * i >= 80 * (na + nb - i)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, a AS c FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.c),
least_of AS (SELECT a, min(c) AS component FROM reach GROUP BY a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM n LEFT JOIN least_of ON a = doc_id
""",
}
