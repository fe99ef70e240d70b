"""Byte-level BPE: texts to token ids with offsets, and ids back to bytes and text.

A rank file (one base64 token and its rank a line) becomes a model of the
tokenizers library: every byte has a printable character, so a token is a
string of such characters, and the merges of a token are all pairs of tokens
that join to it, in the order of ranks. Encoding runs over Arrow batches.

A text is cut before every space that precedes a character other than white
space. No match of the pattern crosses such a cut, so the pieces encode
independently; pieces seen before come from a bounded cache in the worker.
Byte offsets are the running lengths of the tokens; character offsets count
the characters that begin before them. A character split over several tokens
has the same character offset in each but the first of its bytes.

Null and empty texts have no tokens. Decoding null gives null, an empty list
gives an empty text, and ids outside the vocabulary raise an error. Bytes that
are no valid UTF-8, as when a list ends within a character, decode to U+FFFD
in ``text``, and stay as they are in ``data``. Rows are handled one by one:
repeated rows and other columns are returned as they came; the added columns
replace columns of the same name.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from eta_spark.llm.common import slices

#: Pieces that a worker remembers, about 200 MB; beyond that it starts anew.
_CACHE_PIECES = 1 << 20
_CUT = re.compile(r"(?= \S)")


@lru_cache
def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    ranks = read_ranks(path)
    character = byte_characters()
    name = {token: "".join(character[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        for cut in range(1, len(token)):
            if token[:cut] in ranks and token[cut:] in ranks:
                merges.append((name[token[:cut]], name[token[cut:]]))
    model = models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    made = Tokenizer(model)
    split = pre_tokenizers.Split(Regex(pattern), behavior="isolated")
    made.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


@lru_cache(maxsize=2)
def byte_table(path: str, pattern: str) -> list[bytes]:
    """The bytes of each id, by the reverse of the byte characters."""
    made = tokenizer(path, pattern)
    byte = {c: b for b, c in byte_characters().items()}
    vocabulary = made.get_vocab()
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, token_id in vocabulary.items():
        table[token_id] = bytes(byte[c] for c in token)
    return table


@lru_cache(maxsize=2)
def _pieces(path: str, pattern: str) -> dict[str, bytes]:
    """Ids of pieces seen before by this worker, as 32-bit integers."""
    return {}


def encode_texts(texts: list[str | None], path: str, pattern: str) -> list[np.ndarray]:
    """Ids of each text."""
    made, known = tokenizer(path, pattern), _pieces(path, pattern)
    cut = [_CUT.split(t) if t else [] for t in texts]
    if len(known) > _CACHE_PIECES:
        known.clear()
    new = list(set().union(*(set(pieces).difference(known) for pieces in cut)))
    for start in range(0, len(new), 4096):
        part = new[start : start + 4096]
        for piece, coded in zip(part, made.encode_batch_fast(part, add_special_tokens=False), strict=True):
            known[piece] = array("I", coded.ids).tobytes()
    return [np.frombuffer(b"".join(map(known.__getitem__, pieces)), dtype=np.uint32) for pieces in cut]


def _as_lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind.to_pandas_dtype()), kind))


#: What a step adds to a batch: its fields, and the columns of one batch by name.
Step = tuple[list[T.StructField], Callable[[dict[str, pa.Array]], list[pa.Array]]]


def over(df: DataFrame, steps: list[Step], drop: tuple[str, ...] = ()) -> DataFrame:
    """df with the columns that the steps add one after the other, in one pass over Arrow batches."""
    fields = {f.name.lower(): f for f in df.schema.fields}
    for added, _ in steps:
        fields |= {f.name.lower(): f for f in added}
    schema = T.StructType([f for name, f in fields.items() if name not in drop])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = {name.lower(): batch.column(i) for i, name in enumerate(batch.schema.names)}
            for added, make in steps:
                columns |= dict(zip([f.name.lower() for f in added], make(columns), strict=True))
            yield pa.RecordBatch.from_arrays([columns[f.name.lower()] for f in schema.fields], [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def encoding(path: str, pattern: str, text: str = "text", offsets: bool = True) -> Step:
    """Adds ``ids``, and if asked ``byte_offsets`` and ``char_offsets`` of each token's first byte."""

    def make(columns: dict[str, pa.Array]) -> list[pa.Array]:
        texts = columns[text].to_pylist()
        ids = encode_texts(texts, path, pattern)
        made = [_as_lists(ids, pa.int32())]
        if offsets:
            lengths = np.array([len(b) for b in byte_table(path, pattern)], dtype=np.int64)
            at_byte = [np.cumsum(lengths[i]) - lengths[i] for i in ids]
            at_char = []
            for value, places in zip(texts, at_byte, strict=True):
                begun = np.cumsum((np.frombuffer((value or "").encode(), dtype=np.uint8) & 0xC0) != 0x80)
                at_char.append(begun[places] - 1 if len(places) else places)
            made += [_as_lists(at_byte, pa.int32()), _as_lists(at_char, pa.int32())]
        return made

    names = ["ids", "byte_offsets", "char_offsets"][: 3 if offsets else 1]
    return [T.StructField(n, T.ArrayType(T.IntegerType())) for n in names], make


def decoding(path: str, pattern: str, ids: str = "ids") -> Step:
    """Adds ``data``, the bytes of the ids, and ``decoded``, their text."""

    def make(columns: dict[str, pa.Array]) -> list[pa.Array]:
        table = byte_table(path, pattern)
        data = []
        for row in columns[ids]:
            if not row.is_valid:
                data.append(None)
                continue
            numbers = row.values.to_numpy(zero_copy_only=False)
            if len(numbers) and (numbers.min() < 0 or numbers.max() >= len(table)):
                raise ValueError(f"id outside the vocabulary of {len(table)} tokens")
            data.append(b"".join(map(table.__getitem__, numbers.tolist())))
        texts = [None if d is None else d.decode("utf-8", "replace") for d in data]
        return [pa.array(data, pa.binary()), pa.array(texts, pa.string())]

    return [T.StructField("data", T.BinaryType()), T.StructField("decoded", T.StringType())], make


def digests(ids: str = "ids", data: str = "data") -> Step:
    """Adds ``n_tokens``, ``ids_sha256`` of the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` of the bytes."""

    def make(columns: dict[str, pa.Array]) -> list[pa.Array]:
        rows = [row.values.to_numpy(zero_copy_only=False).astype("<u4") if row.is_valid else None for row in columns[ids]]
        return [
            pa.array([None if r is None else len(r) for r in rows], pa.int64()),
            pa.array([None if r is None else hashlib.sha256(r.tobytes()).hexdigest() for r in rows], pa.string()),
            pa.array([None if d is None else hashlib.sha256(d).hexdigest() for d in columns[data].to_pylist()], pa.string()),
        ]

    return [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())], make


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = True) -> DataFrame:
    return over(df, [encoding(path, pattern, text, offsets)])


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    return over(df, [decoding(path, pattern, ids)])


def round_trip(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes ``text``, decodes the ids and returns the digests of both beside the other columns, without the lists."""
    steps = [encoding(path, pattern, offsets=False), decoding(path, pattern), digests()]
    return over(df, steps, drop=("text", "ids", "data", "decoded"))
