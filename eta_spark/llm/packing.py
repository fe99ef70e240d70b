"""Packs tokenised documents into sequences of bounded length: bulk-synchronous best fit.

Documents longer than a sequence are cut into full pieces and a rest. Full
pieces are sequences of their own. The others meet the gaps of open sequences
in rounds:

1. Pieces and gaps are sorted by size, largest first, a gap before a piece of
   its size. A sweep in this order opens a level for a gap and closes the
   innermost open level for a piece: the piece's successor, the smallest gap
   that is large enough and that no larger piece has taken. Where many pieces
   want the same gaps, their rank among pieces of equal size decides.
2. A piece and the gap on whose level it falls are neighbours among the rows
   of that level, which a window finds. Levels follow from the rank of a row
   among rows of its size plus the sweep's depth at that size, so only the
   numbers of rows of each size, at most ``capacity``, leave the executors.
3. Gaps shrink, and pieces that found none open sequences: all that are longer
   than half a sequence, which go first, and then as many of the largest as
   the tokens left need beyond the space in gaps that hold an average piece;
   if nothing moves, as many as the tokens left need.

Short pieces of equal length travel as bundles of up to 1/32 of a sequence, so
the number of rounds is bounded, however many pieces of one token there are.
Each round is a stored table. Ranks are counted within
(size, input partition) plus offsets, so that one frequent size is no hot key.

Null and empty texts are the end token alone. Documents without doc_id are
packed like others. Repeated rows are packed each; equal lengths are ordered
by their place in the input. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from eta_spark.llm.bpe import byte_characters
from eta_spark.llm.common import slices, stored

CAPACITY = 2048
END = 0
#: Words that a worker remembers, about 300 MB; beyond that it starts anew.
_CACHE_WORDS = 3 << 19
#: Texts whose words are looked up together, each distinct word once.
_ROWS = 1024
#: How the tokenizer cuts words, and the same for plain ones: ASCII and the letters of Latin-1, which normalisation only lower cases.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00DF-\u00F6\u00F8-\u00FF]+|[0-9]|[^a-z0-9\u00DF-\u00F6\u00F8-\u00FF]+")
_PLAIN = re.compile(r"[!-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
_CHARACTER = {byte: character for byte, character in byte_characters().items() if byte != 0x20}


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _words(path: str) -> dict[str, bytes]:
    """Ids of words seen before by this worker, as 32-bit integers."""
    return {}


@lru_cache(maxsize=2)
def _model(path: str) -> models.Model | None:
    """The tokenizer's model, for pieces cut by _PIECE; None if the tokenizer cuts or normalises otherwise."""
    made = _tokenizer(path)
    given = json.loads(made.to_str())
    steps = [x["type"] for x in (given["normalizer"] or {}).get("normalizers", [])]
    cuts = (given["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in cuts] != ["Split", "ByteLevel"]:
        return None
    as_here = cuts[0]["pattern"] == {"Regex": _PATTERN} and cuts[0]["invert"] and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
    return made.model if as_here else None


def _encode(made: Tokenizer, texts: list[str]) -> list[bytes]:
    return [array("I", coded.ids).tobytes() for coded in made.encode_batch_fast(texts, add_special_tokens=False)]


def _encode_words(made: Tokenizer, words: list[str]) -> list[bytes]:
    """Ids of each word. Runs of letters are encoded as one text, cut again where the tokenizer begins a word.

    That costs half as much as words by themselves. Letters that the tokenizer's normalisation turns into several
    pieces show in the number of words; then each word is encoded by itself.
    """
    letters = [word for word in words if word.isalpha()]
    found = dict.fromkeys(words)
    if letters:
        coded = made.encode(" ".join(letters), add_special_tokens=False)
        begins = np.flatnonzero(np.diff(np.array(coded.word_ids, dtype=np.int64), prepend=-1))
        if len(begins) == len(letters):
            ids, ends = array("I", coded.ids).tobytes(), [*(4 * begins).tolist(), 4 * len(coded.ids)]
            found.update((word, ids[a:b]) for word, a, b in zip(letters, ends, ends[1:], strict=False))
    others = [word for word, ids in found.items() if ids is None]
    found.update(zip(others, _encode(made, others), strict=True))
    return [found[word] for word in words]


def _learn(words: list[str], path: str) -> None:
    """Remembers the ids of the words. Plain words are cut into pieces here and go to the model without normalisation."""
    made, model, known = _tokenizer(path), _model(path), _words(path)
    others = []
    for word in words:
        if model is None or not _PLAIN.fullmatch(word):
            others.append(word)
            continue
        cut = _PIECE.findall(word.lower())
        for piece in cut:
            if piece not in known:
                # A character for each byte.
                seen = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_CHARACTER)
                known[piece] = array("I", [token.id for token in model.tokenize(seen)]).tobytes()
        if cut != [word]:
            known[word] = b"".join([known[piece] for piece in cut])
    for start in range(0, len(others), 4096):
        some = others[start : start + 4096]
        known.update(zip(some, _encode_words(made, some), strict=True))


def token_ids(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text as 32-bit integers, for a tokenizer that lower cases and drops white space.

    Words between ASCII white space encode independently, in ASCII lower case.
    Only the distinct words of the texts are looked up one by one. Texts that
    may hold a special token's string are encoded whole.
    """
    made, known = _tokenizer(path), _words(path)
    if len(known) > _CACHE_WORDS:
        known.clear()
    known[""] = b""
    odd = {i for i, t in enumerate(texts) if t and "<|" in t}
    plain = pa.array(["" if i in odd or not t else t for i, t in enumerate(texts)], pa.large_string())
    cut = pc.ascii_split_whitespace(pc.ascii_lower(plain))
    words = cut.values.dictionary_encode()
    # to_numpy makes Python values several times faster than to_pylist.
    distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    ids = list(map(known.get, distinct))
    new = [k for k, coded in enumerate(ids) if coded is None]
    _learn([distinct[k] for k in new], path)
    for k in new:
        ids[k] = known[distinct[k]]
    at, ends = words.indices.to_numpy().tolist(), cut.offsets.to_numpy().tolist()
    joined = (b"".join(map(ids.__getitem__, at[a:b])) for a, b in pairwise(ends))
    return [_encode(made, [texts[i]])[0] if i in odd else coded for i, coded in enumerate(joined)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked, the ids of each piece of a document."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    end = array("I", [END]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _ROWS):
            rows = []
            for doc_id, coded in zip(batch.column(0).to_pylist(), token_ids(batch.column(1).to_pylist(), path), strict=True):
                coded += end
                for k, at in enumerate(range(0, len(coded), 4 * capacity)):
                    part = coded[at : at + 4 * capacity]
                    row = (doc_id, k, k * capacity, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, dtype=np.int32)) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, schema)


def ranked(df: DataFrame, key: str, order: str) -> DataFrame:
    """df with ``rank``, from 0, among the rows of equal ``key``; ``order`` comes from monotonically_increasing_id."""
    part = F.shiftright(order, 33)
    rows = df.withColumn("part", part)
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(key, "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy(key, "part").orderBy(order)) - 1
    return rows.withColumn("place", place).join(offsets, [key, "part"]).withColumn("rank", F.col("before") + F.col("place")).drop("part", "place", "before", "n")


def _sizes(df: DataFrame, key: str, capacity: int) -> np.ndarray:
    """Numbers of rows of each size: at most ``capacity`` rows come to the driver."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in df.groupBy(key).count().collect():
        counts[size] = n
    return counts


def _small(df: DataFrame, key: str, **columns: np.ndarray) -> DataFrame:
    """A table of one row for each size, to be broadcast: at most capacity + 1 rows."""
    sizes = np.arange(len(next(iter(columns.values()))))
    return F.broadcast(df.sparkSession.createDataFrame(pd.DataFrame({key: sizes} | columns)))


def _sweep(waiting: np.ndarray, free: np.ndarray, lowest: int) -> tuple[np.ndarray, ...]:
    """What one sweep does to the numbers of items and gaps of each size, from ``lowest`` up for items.

    Returns the items that find a gap, the level of the first gap, the level
    that the first item closes, and the gaps afterwards.
    """
    taken, gap_base, item_base, after = (np.zeros(len(waiting), dtype=np.int64) for _ in range(4))
    depth, levels = 0, []
    for size in range(len(waiting) - 1, 0, -1):
        gap_base[size] = depth + 1
        depth += free[size]
        levels += [[size, free[size]]] * bool(free[size])
        item_base[size] = depth
        left = taken[size] = min(waiting[size], depth) if size >= lowest else 0
        depth -= left
        while left:
            gap, n = levels.pop()
            after[gap - size] += min(n, left)
            if n > left:
                levels.append([gap, n - left])
            left -= min(n, left)
    for gap, n in levels:
        after[gap] += n
    after[0] = 0
    return taken, gap_base, item_base, after


def _to_open(left: np.ndarray, free: np.ndarray, moved: bool) -> int:
    """How many sequences the items that found no gap should open; arrays by size."""
    sizes, capacity = np.arange(len(left)), len(left) - 1
    large, rest = int(left[capacity // 2 + 1 :].sum()), left * (sizes <= capacity // 2)
    tokens = int((rest * sizes).sum())
    average = tokens / max(1, int(rest.sum()))
    space = int((free * sizes * (sizes >= average)).sum())
    need = large - (-max(0, tokens - space) // capacity)
    if not need and not moved:
        need = -(-tokens // capacity)
    return min(int(left.sum()), need)


def best_fit(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and offset of each item; items: item (any unique type), size, rank among items of equal size."""
    waiting = _sizes(items, "size", capacity)
    first = np.zeros(capacity + 1, dtype=np.int64)  # rank of the first item that waits, of each size
    spark = items.sparkSession
    kind = items.schema["item"].dataType.simpleString()
    gaps = spark.createDataFrame([], "sequence_id long, size long, rank long")
    free, opened, rounds = np.zeros(capacity + 1, dtype=np.int64), 0, []
    sizes = np.arange(capacity + 1)
    half = capacity // 2
    while waiting.any():
        lowest = half + 1 if waiting[half + 1 :].any() else 1
        taken, gap_base, item_base, free = _sweep(waiting, free, lowest)
        left = waiting - taken
        active = left * (sizes >= lowest)
        need = _to_open(active, free, bool(taken.any()))
        # The largest items that found no gap open sequences.
        above = np.concatenate([np.cumsum(active[::-1])[::-1][1:], [0]])
        fresh = np.clip(need - above, 0, active)
        free[capacity - sizes] += fresh
        free[0] = 0

        now = items.join(_small(items, "size", first=first, taken=taken, level=item_base, fresh=fresh, above=above), "size")
        now = now.withColumn("turn", F.col("rank") - F.col("first"))
        match = now.where("turn >= 0 AND turn < taken").select(
            "size", F.lit(1).alias("kind"), (F.col("level") - F.col("turn")).alias("level"), "item", F.lit(None).cast("long").alias("sequence_id")
        )
        holes = gaps.join(_small(items, "size", level=gap_base), "size").select(
            "size", F.lit(0).alias("kind"), (F.col("level") + F.col("rank")).alias("level"), F.lit(None).cast(kind).alias("item"), "sequence_id"
        )
        on_level = Window.partitionBy("level").orderBy(F.desc("size"), "kind")
        swept = match.unionByName(holes).select(
            "*",
            F.lag("sequence_id").over(on_level).alias("successor"),
            F.lag("size").over(on_level).alias("gap"),
            F.lead("kind").over(on_level).alias("next"),
        )
        # Items take their gap; gaps that no item follows stay as they are.
        fitted = swept.where("kind = 1").select("item", F.col("successor").alias("sequence_id"), (capacity - F.col("gap")).alias("offset"), (F.col("gap") - F.col("size")).alias("left"))
        kept = swept.where("kind = 0 AND coalesce(next, 0) = 0").select(F.lit(None).cast(kind).alias("item"), "sequence_id", F.lit(None).cast("long").alias("offset"), F.col("size").alias("left"))
        turn = F.col("turn") - F.col("taken")
        begun = now.where((turn >= 0) & (turn < F.col("fresh"))).select(
            "item", (F.lit(opened) + F.col("above") + turn).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), (capacity - F.col("size")).alias("left")
        )
        after = fitted.unionByName(begun).unionByName(kept).withColumn("row", F.monotonically_increasing_id())
        rounds.append(stored(after, "packing"))

        first += taken + fresh
        waiting = left - fresh
        opened += need
        useful = rounds[-1].where("left > 0").select("sequence_id", F.col("left").alias("size"), "row")
        gaps = stored(ranked(useful, "size", "row").select("sequence_id", "size", "rank"), "gaps") if waiting.any() else gaps
    placed = [r.where("item IS NOT NULL").select("item", "sequence_id", "offset") for r in rounds]
    if not placed:
        return spark.createDataFrame([], f"item {kind}, sequence_id long, offset long")
    while len(placed) > 1:
        placed = [a.unionByName(b) for a, b in zip(placed[::2], placed[1::2], strict=False)] + placed[len(placed) & ~1 :]
    return placed[0]


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """rows (with ``length``, from 1 to capacity) with ``sequence_id`` and ``offset``."""
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "pieces")
    # Full pieces count down from -1, the others' sequences up from 0.
    full = rows.where(F.col("length") == capacity).select("*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    count = F.greatest(F.lit(1), F.floor(F.lit(capacity // 32) / F.col("length"))).cast("long")
    short = ranked(rows.where(F.col("length") < capacity), "length", "row")
    short = short.withColumn("bundle", F.floor(F.col("rank") / count)).withColumn("within", F.col("rank") % count).drop("rank")
    short = stored(short, "ranked")
    bundles = short.groupBy("length", "bundle").agg(F.sum("length").alias("size")).select(
        F.struct("length", "bundle").alias("item"), "size", F.monotonically_increasing_id().alias("row")
    )
    items = stored(ranked(stored(bundles, "bundles"), "size", "row").select("item", "size", "rank"), "items")
    placed = best_fit(items, capacity).select("item.length", "item.bundle", "sequence_id", F.col("offset").alias("bundle_offset"))
    found = short.join(placed, ["length", "bundle"]).withColumn("offset", F.col("bundle_offset") + F.col("within") * F.col("length"))
    return full.unionByName(found.drop("bundle", "within", "bundle_offset")).drop("row")
