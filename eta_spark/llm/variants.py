"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling, lead to their most frequent form.

Two words are near if one inserted, deleted or replaced code point turns one
into the other: then the lengths of their common prefix and suffix reach the
longer length less one.

* One of prefix and suffix reaches half of that, so every word is filed, once
  for its own length and once for the next, under its first and under its last
  half. A near pair meets under the longer word's length: under the prefix if
  the common prefix fills that half, else under the suffix; so exactly once.
* A file becomes blocks of at most ``TILE`` words. Each pair of blocks is a
  tile, dealt to tasks by itself, so a frequent half is spread over many tasks
  and no group is gathered whole. Small files share a tile; a mask keeps them
  apart.
* A tile holds its words as a matrix of code points padded with zeros, and
  reversed as a second one. Columns are compared for all pairs of a tile at once;
  running conjunctions give prefix and suffix lengths. Only sums leave a
  tile: a word's near words, and the most frequent of them.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is at least ``RATIO`` times its own; counts rise along
forms, so they make trees, and their roots are found by pointer jumping over
stored tables.

Null and empty texts and texts without runs have no words. Rows without doc_id
count like others, under an empty id; repeated rows count each. Texts are read
whole. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eta_spark.llm.common import slices, stored

LEAST_CHARS, LEAST_COUNT, RATIO = 5, 3, 2
#: One in so many (document, word) loses a code point: the typing errors that the query looks for.
DAMAGE = 97
TILE = 512
#: Code points of a tile's matrix; longer words make smaller tiles.
_TILE_CELLS = 1 << 22
#: Words that a task counts before it hands the counts on.
_COUNTED = 1 << 18

#: Latin-1 bytes: ASCII capitals become small letters, all but letters blanks.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> list[bytes]:
    """Maximal runs of [A-Za-z\\u00C0-\\u00FF], capitals A-Z made small, one byte for each code point."""
    return text.encode("latin-1", "replace").translate(_BYTES).split()


def damaged(doc_id: int | None, counts: dict[bytes, int], every: int) -> Iterator[tuple[bytes, int]]:
    """The runs of a document, where ``every`` divides the run's checksum without one of its code points."""
    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in counts.items():
        checksum = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), begin)
        if checksum % every == 0:
            at = checksum % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def _counts(every: int | None, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            names = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([names, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = Counter(runs(text)) if text else {}
                for word, n in damaged(doc_id, counts, every) if every else counts.items():
                    if len(word) >= least:
                        held[word] += n
            if len(held) > _COUNTED:
                yield flush()
                held.clear()
        yield flush()

    return run


def word_counts(docs: DataFrame, every: int | None = None, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of docs (doc_id, text); counted in each task before the shuffle."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_counts(every, least_chars), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded with zeros, one word a row, and the lengths."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.zeros((len(texts), int(sizes.max(initial=0))), dtype=np.uint32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    return out, sizes


def _common(a: np.ndarray, b: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of a with each row of b; ``pairs`` may stand in the same file."""
    same, length = pairs.copy(), np.zeros(pairs.shape, dtype=np.int32)
    for column in range(min(a.shape[1], b.shape[1])):
        # Padding equals padding: the lengths of near words decide, not their common padding.
        same &= (a[:, column, None] == b[None, :, column]) & (a[:, column, None] != 0)
        if not same.any():
            break
        length += same
    return length


def near_pairs(texts: list[str], files: np.ndarray, prefix: np.ndarray, target: np.ndarray, blocks: np.ndarray, across: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j), i < j, of near words of the same file; rows are ordered by file.

    ``prefix``: the file is of a first half; ``target``: the longer word's
    length; ``across``: the tile is of two blocks, and only pairs of both count.
    """
    forward, sizes = matrix(texts)
    backward, _ = matrix([t[::-1] for t in texts])
    found = [np.empty((2, 0), dtype=np.int64)]
    step = max(1, min(TILE, _TILE_CELLS // max(1, forward.shape[1])))
    n = len(texts)
    for i in range(0, n, step):
        a = slice(i, min(n, i + step))
        for j in range(i, n, step):
            b = slice(j, min(n, j + step))
            if files[b][0] != files[a][-1] and j > i:
                break
            longer = np.maximum(sizes[a, None], sizes[None, b])
            pairs = (files[a, None] == files[None, b]) & (np.arange(a.start, a.stop)[:, None] < np.arange(b.start, b.stop))
            pairs &= (longer == target[a, None]) & (~across[a, None] | (blocks[a, None] != blocks[None, b]))
            if not pairs.any():
                continue
            begin = _common(forward[a], forward[b], pairs)
            half = target[a, None] // 2
            # A pair with a common first half is of the prefix file alone.
            pairs &= np.where(prefix[a, None], begin >= half, begin < half)
            end = _common(backward[a], backward[b], pairs)
            # Equal words, if a table holds one twice, are not one edit apart.
            pairs &= (begin + end >= longer - 1) & ~((begin == longer) & (sizes[a, None] == sizes[None, b]))
            found.append(np.array(np.nonzero(pairs)) + np.array([[i], [j]]))
    both = np.concatenate(found, axis=1)
    return both[0], both[1]


def _tile(rows: list[tuple]) -> pa.RecordBatch:
    """Sums of one tile, or of several small ones side by side: word, n_near, form_n, form."""
    texts = [r[0] for r in rows]
    counts = np.array([r[1] for r in rows], dtype=np.int64)
    keys = [r[2:] for r in rows]  # (file, side, target, low, high, block)
    files = np.cumsum([0] + [a[:-1] != b[:-1] for a, b in zip(keys, keys[1:], strict=False)])
    side, target, block = (np.array([k[i] for k in keys]) for i in (1, 2, 5))
    across = np.array([k[3] != k[4] for k in keys])
    i, j = near_pairs(texts, files, side == 0, target, block, across)
    word, other = np.concatenate([i, j]), np.concatenate([j, i])
    rank = np.empty(len(texts), dtype=np.int64)
    rank[sorted(range(len(texts)), key=texts.__getitem__)] = np.arange(len(texts))
    order = np.lexsort((rank[other], -counts[other], word))
    word, other = word[order], other[order]
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.empty(0, dtype=np.int64)
    near = np.diff(np.append(first, len(word)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([texts[w] for w in word[first]], pa.string()),
            pa.array(near, pa.int64()),
            pa.array(counts[other[first]], pa.int64()),
            pa.array([texts[w] for w in other[first]], pa.string()),
        ],
        ["word", "n_near", "form_n", "form"],
    )


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by tile; whole tiles are gathered up to TILE rows."""
    held: list[tuple] = []
    last = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[2:-1] != last:
                if len(held) >= TILE:
                    yield _tile(held)
                    held = []
                last = row[2:-1]
            held.append(row)
    if held:
        yield _tile(held)


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n_near, form_n, form: how many words of the table (word, n) are near, and the most frequent of them; near-less words are left out."""
    filed = words.withColumn("size", F.char_length("word")).withColumn("target", F.explode(F.array(F.col("size"), F.col("size") + 1)))
    # Half of the longer length less one, rounded up, is half of the longer length, rounded down.
    half = (F.col("target") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.xxhash64(F.substring("word", F.lit(1), half)).alias("file")),
        F.struct(F.lit(1).alias("side"), F.xxhash64(F.substring("word", F.col("size") - half + 1, half)).alias("file")),
    )
    filed = filed.select("word", "n", "size", "target", F.inline(sides))
    key = ["file", "side", "target"]
    sizes = filed.groupBy(*key).agg(F.count("*").alias("members"), F.count_if(F.col("size") == F.col("target")).alias("longest"))
    useful = sizes.where("members > 1 AND longest > 0").select(*key, F.ceil(F.col("members") / tile).cast("int").alias("blocks"))
    filed = filed.join(useful, key).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, "block").alias("low"), F.greatest(o, "block").alias("high")))
    dealt = filed.select("word", "n", *key, "block", F.inline(tiles)).select("word", "n", *key, "low", "high", "block")
    tile_key = [*key, "low", "high"]
    found = dealt.repartition(*tile_key).sortWithinPartitions(*tile_key).mapInArrow(_tiles, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last form of each word of forms (word, form), by pointer jumping."""
    known = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        jump = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(known.join(jump, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        known = after.drop("moved")
        if after.where("moved").isEmpty():
            return known


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table (word, n) without repeated words."""
    words = stored(words, "words")
    near = stored(near_words(words), "near")
    known = words.join(near, "word", "left")
    better = F.col("form_n") >= ratio * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(better, F.col("form")).alias("form"), F.when(better, F.col("form_n")).alias("form_n"))
    known = stored(known, "known")
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, every: int | None = DAMAGE) -> DataFrame:
    """The words of docs (doc_id, text), after the errors that the query plants, with their forms and roots."""
    return group(word_counts(docs, every))


#: CRC-32 bit by bit: DuckDB has no function for it.
_BYTES_OF = "list_transform(range(1, len(hex(encode({0}))), 2), lambda k: ('0x' || substr(hex(encode({0})), k, 2))::BIGINT)"
_BIT = "list_reduce([xor(c, b), 0, 1, 2, 3, 4, 5, 6, 7], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
CRC32 = f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {_BYTES_OF}), lambda c, b: {_BIT}))"
SQL = f"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
checked AS (SELECT run, n, {CRC32.format("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs),
words AS (SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, n FROM checked)
  WHERE len(word) >= {LEAST_CHARS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, len(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN words b ON b.word = a.rest UNION SELECT b.word, a.word FROM cut a JOIN words b ON b.word = a.rest),
near AS (SELECT p.word, count(*) AS n_near, first(other ORDER BY o.n DESC, other) AS best, max(o.n) AS best_n FROM pairs p JOIN words o ON o.word = other GROUP BY p.word),
known AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= {RATIO} * w.n THEN best END AS form, CASE WHEN best_n >= {RATIO} * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS root FROM known UNION ALL SELECT chain.word, known.form FROM chain JOIN known ON known.word = chain.root WHERE known.form IS NOT NULL)
SELECT known.word, form, root, n, n_near, form_n FROM known JOIN chain USING (word) WHERE root IN (SELECT word FROM known WHERE form IS NULL)
"""
