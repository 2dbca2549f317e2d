"""Byte-level BPE by a public rank file: encoding with the tokenizers library over Arrow batches, and decoding."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

#: Text that one call of the library takes at most, so that its results stay small beside the batch.
CALL_CHARS = 1 << 19


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if visible in Latin-1, else the next from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class ByteBPE:
    """Encoder and decoder for ``rank_file`` (lines of base64 token and rank), splitting text by ``pattern``.

    Every way to halve a token into two lower-ranked tokens is a merge, so any neighbours whose bytes together are a
    token merge at that token's rank, as the ranks alone demand.
    """

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in rank_file.splitlines() if line)}
        chars = byte_characters()
        spelled = {token: "".join(map(chars.__getitem__, token)) for token in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.__getitem__):
            for i in range(1, len(token)):
                a, b = token[:i], token[i:]
                if ranks.get(a, ranks[token]) < ranks[token] and ranks.get(b, ranks[token]) < ranks[token]:
                    merges.append((spelled[a], spelled[b]))
        self.spelled = {r: spelled[t] for t, r in ranks.items()}
        self._bytes = np.zeros(max(map(ord, chars)) + 1, np.uint8)  # the byte table turned round, by code point
        self._bytes[[ord(c) for c in chars]] = np.arange(256, dtype=np.uint8)
        self._lengths = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        self._lengths[list(ranks.values())] = [len(t) for t in ranks]
        self._tokenizer = Tokenizer(models.BPE({spelled[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
        self._tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )

    def encode(self, texts: Sequence[str], offsets: bool = False) -> Iterator[tuple[list[int], list[tuple[int, int]] | None]]:
        """(ids, character offsets if wanted) of each text, in order; texts go to the library in bounded calls.

        A character whose bytes fall to several tokens has the same offsets in each of them.
        """
        batch = self._tokenizer.encode_batch if offsets else self._tokenizer.encode_batch_fast
        at = 0
        while at < len(texts):
            to, chars = at + 1, len(texts[at])
            while to < len(texts) and chars + len(texts[to]) <= CALL_CHARS:
                chars += len(texts[to])
                to += 1
            for e in batch(texts[at:to], add_special_tokens=False):
                yield e.ids, e.offsets if offsets else None
            at = to

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of ``ids``, spelled in byte characters and read back by the reversed table.

        They may begin or end inside a character.
        """
        characters = "".join(map(self.spelled.__getitem__, ids)).encode("utf-16-le")  # all below U+0200: two bytes each
        return self._bytes[np.frombuffer(characters, "<u2")].tobytes()

    def offsets(self, ids: Sequence[int], data: bytes) -> tuple[np.ndarray, int]:
        """(character offsets of each token as rows of start and end, number of characters whose bytes fall to several tokens).

        ``data`` are the bytes that ``ids`` stand for. A character in several tokens lies within the offsets of each.
        """
        end = np.cumsum(self._lengths[np.asarray(ids, np.int64)])
        begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        before = np.concatenate(([0], np.cumsum(begins)))  # characters that begin before each byte
        edges = np.concatenate(([0], end))
        inside = np.append(~begins, False)[edges]  # does the edge cut a character?
        spans = np.column_stack((before[edges[:-1]] - inside[:-1], before[end]))
        return spans, len(np.unique(before[edges[inside]]))


_built: dict[tuple[str, str], ByteBPE] = {}


def _codec(rank_file: bytes, pattern: str) -> ByteBPE:
    key = (hashlib.sha256(rank_file).hexdigest(), pattern)
    if key not in _built:
        _built[key] = ByteBPE(rank_file, pattern)
    return _built[key]


def _shipped(df: DataFrame, rank_path: str):
    """The rank file, read once on the driver and broadcast (its size is the vocabulary's, not the data's)."""
    with open(rank_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids", offsets_col: str | None = None) -> DataFrame:
    """``df`` with ``ids_col`` array<int> and, if named, ``offsets_col`` array<struct<start int, end int>>.

    Offsets count characters of the text. Null texts encode as empty arrays. Columns of those names are replaced.
    """
    ranks = _shipped(df, rank_path)
    pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    own = [c for c in df.columns if c not in (ids_col, offsets_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).fill_null("").to_pylist()
            found = list(codec.encode(texts, offsets_col is not None))
            columns = [*batch.columns[:-1], pa.array([ids for ids, _ in found], pa.list_(pa.int32()))]
            if offsets_col:
                columns.append(pa.array([[{"start": a, "end": b} for a, b in o] for _, o in found], pa.list_(pair)))
            yield pa.RecordBatch.from_arrays(columns, names=[*own, ids_col, *([offsets_col] if offsets_col else [])])

    made = [StructField(ids_col, ArrayType(IntegerType()))]
    if offsets_col:
        made.append(StructField(offsets_col, ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))))
    schema = StructType([*df.select(*own).schema.fields, *made])
    return df.select(*own, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def decode(df: DataFrame, rank_path: str, pattern: str, ids_col: str = "token_ids", bytes_col: str = "decoded", errors: str = "replace") -> DataFrame:
    """``df`` with ``bytes_col`` binary and ``<bytes_col>_text`` string.

    Ids cut inside a character decode to its bytes; the string shows the broken ends as U+FFFD (``errors``). Null ids
    decode as empty; an unknown id is an error.
    """
    ranks = _shipped(df, rank_path)
    text_out = f"{bytes_col}_text"
    own = [c for c in df.columns if c not in (bytes_col, text_out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            out = [codec.decode(ids or []) for ids in batch.column(batch.num_columns - 1).to_pylist()]
            texts = [b.decode("utf-8", errors) for b in out]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary()), pa.array(texts)], names=[*own, bytes_col, text_out])

    schema = df.select(*own).schema.add(bytes_col, "binary").add(text_out, "string")
    return df.select(*own, F.col(ids_col).alias("_ids")).mapInArrow(run, schema)


def round_trip(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``df`` without its text, with n_tokens long, ids_sha256, decoded_sha256, offsets_sha256 string and n_split long.

    Encodes every whole text (null: empty), decodes its ids and hashes both, so that ids needn't leave the task.
    ``offsets_sha256`` hashes each token's character offsets, start and end as 64-bit little-endian integers in token
    order; ``n_split`` counts characters whose bytes fall to several tokens.
    Columns of ``df`` named like a result are left out; repeated rows stay; an empty table gives an empty table.
    """
    ranks = _shipped(df, rank_path)
    made = ["n_tokens", "ids_sha256", "decoded_sha256", "offsets_sha256", "n_split"]
    own = [c for c in df.columns if c != text_col and c not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        decimal = {r: str(r) for r in codec.spelled}
        for batch in batches:
            counts, hashes, decoded, where, split = [], [], [], [], []
            for ids, _ in codec.encode(batch.column(batch.num_columns - 1).fill_null("").to_pylist()):
                counts.append(len(ids))
                hashes.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                data = codec.decode(ids)
                decoded.append(hashlib.sha256(data).hexdigest())
                spans, n = codec.offsets(ids, data)
                where.append(hashlib.sha256(spans.astype("<i8").tobytes()).hexdigest())
                split.append(n)
            strings = [pa.array(x, pa.string()) for x in (hashes, decoded, where)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64()), *strings, pa.array(split, pa.int64())], names=[*own, *made])

    schema = df.select(*own).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string").add("offsets_sha256", "string").add("n_split", "long")
    return df.select(*own, F.col(text_col).alias("_text")).mapInArrow(run, schema)
