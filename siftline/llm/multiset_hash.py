"""Homomorphic multiset hashes of documents: wide vectors hashed from paragraphs, summed modulo 2**32 in every lane.

A paragraph is a line. Its vector has 8 lanes cut from its SHA-256, its count (1), its number of word pairs, and 64
lanes holding, for each bit of a 64-bit hash, how many of its word pairs have that bit set. A document's fingerprint
is the sum over its paragraphs: it doesn't depend on their order, and paragraphs are put in or taken out by adding or
subtracting their fingerprint. The first 8 lanes tell texts apart; a bit lane counts +1 or -1 a word pair about its
mean, so the cosine of two documents' bit lanes estimates how much of their text they share.

Two lanes are packed in one long while they are summed and stored. Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.ordering import in_blocks, with_next
from siftline.llm.shared_storage import written

LANES = 74
WHITE = r"[\x20\x09-\x0D]+"
#: Parts of a text and its edited form: paragraphs of both, those that the edit takes out, those that it puts in.
SAME, OLD, NEW = range(3)
_PAIR = (1 << 32) + 1
_MASK = (1 << 32) - 1


def _fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``packed`` array<long> of ``texts`` (``keys``, text without nulls); keys must tell rows apart."""
    # the outer forms of explode: the others add a filter on the size of what they explode, computed once more
    lines = texts.select(*keys, F.explode_outer(F.split("text", "\n")).alias("_line"))
    words = F.filter(F.split("_line", WHITE), lambda w: w != "")
    lines = lines.select(*keys, F.array(F.sha2("_line", 256)).alias("_digest"), words.alias("_words"))
    cut = F.flatten(F.transform("_digest", lambda d: F.array(*[F.conv(F.substring(d, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(8)])))
    pairs = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1)))
    units = lines.select(*keys, F.concat(cut, pairs).alias("_units")).select(*keys, F.posexplode_outer("_units").alias("_at", "_u"))
    sums = [F.sum(F.when(F.col("_at") == i, F.col("_u")).otherwise(0)).alias(f"_e{i}") for i in range(8)]
    sums += [F.sum((F.col("_at") == 0).cast("long")).alias("_lines"), F.sum((F.col("_at") >= 8).cast("long")).alias("_n")]
    units = units.select(*keys, "_at", "_u", F.when(F.col("_at") >= 8, F.col("_u")).otherwise(F.lit(0)).alias("_h"))
    sums += [F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(F.lit(_PAIR))).alias(f"_b{i}") for i in range(32)]
    found = units.groupBy(*keys).agg(*sums)
    pack = lambda low, high: F.col(low).bitwiseAND(F.lit(_MASK)).bitwiseOR(F.shiftleft(F.col(high).bitwiseAND(F.lit(_MASK)), 32))
    packed = [pack(f"_e{i}", f"_e{i + 1}") for i in range(0, 8, 2)] + [pack("_lines", "_n")] + [F.col(f"_b{i}") for i in range(32)]
    return found.select(*keys, F.array(*packed).alias("packed"))


def lanes(packed: Column) -> Column:
    """The 74 lanes, each 0 .. 2**32 - 1: 8 of the digest, paragraphs, word pairs, 64 of bits."""
    return F.flatten(F.transform(packed, lambda x: F.array(x.bitwiseAND(F.lit(_MASK)), F.shiftrightunsigned(x, 32))))


def _by_lanes(packed: Column, other: Column, of) -> Column:
    """``of`` both lanes of each pair of packed longs, modulo 2**32; null where either fingerprint is."""
    low, high = (lambda x: x.bitwiseAND(F.lit(_MASK))), (lambda x: F.shiftrightunsigned(x, 32))
    return F.zip_with(packed, other, lambda a, b: low(of(low(a), low(b))).bitwiseOR(F.shiftleft(of(high(a), high(b)), 32)))


def insert(packed: Column, more: Column) -> Column:
    """The fingerprint after the paragraphs of ``more`` are put in."""
    return _by_lanes(packed, more, lambda a, b: a + b)


def delete(packed: Column, less: Column) -> Column:
    """The fingerprint after the paragraphs of ``less`` are taken out."""
    return _by_lanes(packed, less, lambda a, b: a - b)


def to_text(packed: Column) -> Column:
    """Eight lowercase hexadecimal digits a lane."""
    return F.lower(F.array_join(F.transform(packed, lambda x: F.concat(F.lpad(F.hex(x.bitwiseAND(F.lit(_MASK))), 8, "0"), F.lpad(F.hex(F.shiftrightunsigned(x, 32)), 8, "0"))), ""))


def _signed(packed: Column) -> Column:
    """Twice the bit lanes less the number of word pairs, about 0, as doubles; packed pairs in order."""
    n = F.shiftrightunsigned(F.get(packed, F.lit(4)), 32)
    centred = lambda x: (((x * 2 - n + F.lit(1 << 31)).bitwiseAND(F.lit(_MASK))) - F.lit(1 << 31)).cast("double")
    return F.flatten(F.transform(F.slice(packed, 6, 32), lambda x: F.array(centred(x.bitwiseAND(F.lit(_MASK))), centred(F.shiftrightunsigned(x, 32)))))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else the cosine of the bit lanes, at least 0; 0 if either text has no words."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    x, y = _signed(a), _signed(b)
    norm = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(a == b, F.lit(1.0)).otherwise(F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(x, y) / norm))).otherwise(F.lit(0.0)))


def fingerprint(docs: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` (a row's key) and ``packed`` of every row of ``docs``; a null text counts as empty, one empty line."""
    return _fingerprints(docs.select(*id_cols, F.coalesce(F.col(text_col), F.lit("")).alias("text")), id_cols)


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row per row of ``docs``.

    The edited text has the last third of the code points (rounded down) replaced by the first as many of the next
    document by descending id, nulls last; the last document is followed by the first. Rows that share an id share
    their next document, and where the next id is repeated, the row with the smallest hash of its text stands for it.
    The edited fingerprint is the own one with the paragraphs from the edit on deleted and the new ones inserted. Other
    columns are not read; the smallest long is taken for no id. A single document is its own next.
    """
    none = F.lit(-(1 << 63))  # null ids come last, below all others
    # both joins below take this table by k with the same columns, so that its texts are shuffled once
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), none).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    third = F.floor(F.char_length("text") / 3).cast("int")
    ids = base.groupBy("k").agg(F.max(third).alias("need"))
    order = [F.desc("k")]
    ids = with_next(in_blocks(ids, order, "neighbours"), "k", order, "next")
    wanted = ids.select(F.col("k").alias("for_k"), F.col("next.k").alias("next_k"), "need")
    heads = base.withColumnRenamed("k", "next_k").join(wanted, "next_k")
    heads = heads.groupBy("for_k", "next_k").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.left("text", F.col("need")).alias("head"))).alias("m"))
    joined = base.join(heads.select(F.col("for_k").alias("k"), "next_k", F.col("m.head").alias("head")), "k")
    joined = joined.withColumn("n_chars", F.char_length("text").cast("long"))
    joined = joined.withColumn("whole", F.left("text", (F.col("n_chars") - third).cast("int")))
    # the edit changes the paragraphs from the one it begins in: those before are hashed once for both texts
    begin = F.length("whole") - F.coalesce(F.length(F.substring_index("whole", "\n", -1)), F.lit(0))
    edited = F.concat("whole", F.left("head", third))
    joined = joined.select("k", F.monotonically_increasing_id().alias("row"), F.nullif("k", none).alias("doc_id"), "next_k", "n_chars", "text", edited.alias("edited"), begin.alias("begin"))
    kept = ["k", "row", "doc_id", "next_k", "n_chars", "text_hash", "edited_sha256"]
    # what the rows keep is computed inside the exploded array, once, and not again for each exploded row
    made = ["doc_id", "next_k", "n_chars", F.xxhash64("text").alias("text_hash"), F.sha2("edited", 256).alias("edited_sha256")]
    rest = lambda c: F.substring(c, F.col("begin") + 1, F.length(c))
    # the break before ``begin`` is dropped, as it only parts paragraphs; where it begins at 0 there is nothing before
    parts = [F.when(F.col("begin") > 0, F.left("text", F.col("begin") - 1)), rest(F.col("text")), rest(F.col("edited"))]
    split = joined.select("k", "row", F.explode_outer(F.array(*[F.struct(F.lit(i).alias("kind"), c.alias("text"), *made) for i, c in enumerate(parts)])).alias("v"))
    split = split.select("k", "row", "v.*").filter("text IS NOT NULL").select(*kept, "kind", "text")
    prints = _fingerprints(split, [*kept, "kind"])
    one = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("packed")))
    prints = prints.groupBy(*kept).agg(one(SAME).alias("same"), one(OLD).alias("old"), one(NEW).alias("new")).drop("row")
    prints = prints.withColumn("own", F.coalesce(insert(F.col("same"), F.col("old")), "old"))
    found = written(prints.withColumn("changed", insert(delete(F.col("own"), F.col("old")), F.col("new"))).drop("same", "old", "new"), "multiset-hashes")
    following = found.groupBy(F.col("k").alias("next_k")).agg(F.min(F.struct("text_hash", "own")).alias("m")).select("next_k", F.col("m.own").alias("following"))
    out = found.join(following, "next_k")
    return out.select(F.col("doc_id").cast(docs.schema[id_col].dataType).alias("doc_id"), "n_chars", "edited_sha256", to_text(F.col("own")).alias("fingerprint"), to_text(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"))
