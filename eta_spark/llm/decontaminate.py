"""Benchmark decontamination: a broadcast hash set of benchmark word windows meets every document's windows.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
in ASCII lower case. A window is ``window`` consecutive words of a benchmark
item; an item of fewer words, but not none, is one window. A document's word is
hit where it lies in any occurrence of a window.

* The benchmark is cut on executors into segments of bounded length that
  overlap by a window less one word, and written to the shared folder. The
  driver reads it in blocks of at most ``BLOCK_BYTES`` of words and broadcasts
  one index at a time, so what is broadcast never grows with the benchmark. A
  benchmark of one block, the usual case, costs one scan of the documents and
  no shuffle; each further block costs a scan, whose hits are stored and then
  merged by row.
* An index numbers the block's distinct words and holds the windows of each
  width as 64-bit hashes in order, beside the numbers of their words. A
  document's words become these numbers, 0 for others; windows without a 0
  whose hash is found are verified word by word.
* ``scan`` reports, ``clean`` acts: it cuts the hit spans out of the texts, or
  removes documents beyond a share of hit words.

Null and empty texts and texts without words have no words and are never hit;
benchmark items like that have no windows. Texts are read whole, however long;
a task needs about ten times the longest text. Items that share an item_id count
once, items without item_id count as one of the empty name. Repeated rows and
rows without doc_id are judged like others, each by itself. An empty benchmark
hits nothing, an empty table gives an empty result. Other columns are not
read, unless carried along, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from eta_spark.llm.common import slices, stored

WINDOW = 10
#: Bytes of benchmark words in one broadcast index; its arrays take about eight times as much.
BLOCK_BYTES = 2 << 20
#: Windows in a segment of an item.
SEGMENT = 4096

_UPPER = range(ord("A"), ord("Z") + 1)
_KEPT = {*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)}
#: Bytes of UTF-8 texts: separators become blanks, ASCII capitals small letters.
_BYTES = bytes(b + 32 if b in _UPPER else b if b in _KEPT else 32 for b in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RANGE = pa.struct([(name, pa.int64()) for name in ("first", "last", "start", "end")])
_FOUND = StructType(
    [
        StructField("n_words", LongType()),
        StructField("items", ArrayType(StringType())),
        StructField("ranges", ArrayType(StructType([StructField(f.name, LongType()) for f in _RANGE]))),
    ]
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_BYTES).split() if text else []


def _segments(window: int):
    """Items as rows of at most SEGMENT windows: item, words joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            items, parts = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                cut = words(text)
                for at in range(0, max(len(cut) - window, 0) + 1 if cut else 0, SEGMENT):
                    items.append(item)
                    parts.append(b" ".join(cut[at : at + SEGMENT + window - 1]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(parts, pa.string())], ["item", "words"])

    return run


def segments(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(_segments(window), "item string, words string").distinct()


def _hashes(ids: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` numbers from each place on."""
    found = np.full(len(at), width, dtype=np.uint64)
    for i in range(width):
        found = (found ^ (found >> np.uint64(29))) * _MIX + ids[at + i].astype(np.uint64)
    return found


class Index:
    """The windows of a block of segments."""

    def __init__(self, rows: list[tuple[str, str]], window: int):
        cut = [part.encode().split() for _, part in rows]
        self.names = sorted({item for item, _ in rows})
        number = {name: i for i, name in enumerate(self.names)}
        self.vocabulary = {word: i for i, word in enumerate(sorted(set(chain.from_iterable(cut))), 1)}
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for (item, _), part in zip(rows, cut, strict=True):
            ids = np.array([self.vocabulary[w] for w in part], dtype=np.int32)
            width = min(window, len(ids))
            grams = np.lib.stride_tricks.sliding_window_view(ids, width)
            held.setdefault(width, []).append((grams, np.full(len(grams), number[item])))
        #: Of each width: hashes in order, words, where the items of a window begin, items.
        self.widths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for width, some in held.items():
            grams, owners = np.concatenate([g for g, _ in some]), np.concatenate([o for _, o in some])
            pairs = np.unique(np.column_stack([grams, owners]), axis=0)
            fresh = np.append(True, (pairs[1:, :-1] != pairs[:-1, :-1]).any(axis=1))
            starts = np.append(np.flatnonzero(fresh), len(pairs))
            distinct = np.ascontiguousarray(pairs[fresh, :-1], dtype=np.int32)
            keys = _hashes(distinct.ravel(), np.arange(len(distinct)) * width, width)
            order = np.argsort(keys, kind="stable")
            sizes = np.diff(starts)[order]
            owned = np.concatenate([pairs[starts[i] : starts[i + 1], -1] for i in order])
            self.widths[width] = keys[order], distinct[order], np.append(0, np.cumsum(sizes)), owned

    def occurrences(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Width, place and window of each verified occurrence; ``ends`` tells where the text of a place ends."""
        absent = np.append(0, np.cumsum(ids == 0))
        for width, (keys, grams, _, _) in self.widths.items():
            if len(ids) < width:
                continue
            at = np.flatnonzero(absent[width:] == absent[:-width])
            at = at[at + width <= ends[at]]
            hashes = _hashes(ids, at, width)
            near = np.searchsorted(keys, hashes)
            while len(at):
                same = near < len(keys)
                same[same] = keys[near[same]] == hashes[same]
                at, near, hashes = at[same], near[same], hashes[same]
                right = (ids[at[:, None] + np.arange(width)] == grams[near]).all(axis=1)
                yield width, at[right], near[right]
                # Windows of equal hash stand side by side.
                at, near, hashes = at[~right], near[~right] + 1, hashes[~right]

    def find(self, texts: list[bytes | None]) -> tuple[list[int], list[list[str]], list[list[tuple[int, int, int, int]]]]:
        """Of each text: the number of words, the items with occurring windows, the runs of hit words.

        A run is (first word, last word + 1, first character, last character + 1).
        """
        cut = [words(text) for text in texts]
        sizes = np.array([len(c) for c in cut], dtype=np.int64)
        total, ends = int(sizes.sum()), np.cumsum(sizes)
        ids = np.fromiter(map(self.vocabulary.get, chain.from_iterable(cut), repeat(0)), dtype=np.int32, count=total)
        owner = np.repeat(np.arange(len(texts)), sizes)
        steps, pairs = np.zeros(total + 1, dtype=np.int64), [np.empty((0, 2), dtype=np.int64)]
        for width, at, window in self.occurrences(ids, ends[owner]):
            steps[at] += 1
            steps[at + width] -= 1
            seen = np.unique(np.column_stack([owner[at], window]), axis=0)
            _, _, starts, owned = self.widths[width]
            counts = starts[seen[:, 1] + 1] - starts[seen[:, 1]]
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts[seen[:, 1]], counts)
            pairs.append(np.column_stack([np.repeat(seen[:, 0], counts), owned[place]]))
        items: list[list[str]] = [[] for _ in texts]
        for text, item in np.unique(np.concatenate(pairs), axis=0).tolist():
            items[text].append(self.names[item])
        runs: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        hit = np.cumsum(steps[:-1]) > 0
        for text in np.unique(owner[hit]).tolist():
            first = int(ends[text] - sizes[text])
            edges = np.diff(np.concatenate([[0], hit[first : int(ends[text])].astype(np.int8), [0]]))
            places = [m.span() for m in _WORD.finditer(texts[text].decode())]
            for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
                runs[text].append((a, b, places[a][0], places[b - 1][1]))
        return sizes.tolist(), items, runs


def _scanned(rows: DataFrame, index: Index) -> DataFrame:
    """rows (text last) with what an index finds, in place of the text."""
    sent = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, items, runs = sent.value.find(batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist())
            ranges = pa.array([[dict(zip(_RANGE.names, r, strict=True)) for r in some] for some in runs], pa.list_(_RANGE))
            found = [pa.array(sizes, pa.int64()), pa.array(items, pa.list_(pa.string())), ranges]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], [*batch.schema.names[:-1], *_FOUND.names])

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], *_FOUND.fields]))


def _blocks(cut: DataFrame, window: int) -> Iterator[Index]:
    """Indexes of at most BLOCK_BYTES each (one segment at least); the driver holds one block of segments."""
    held, size = [], 0
    for row in cut.toLocalIterator():
        if held and size + len(row.words) > BLOCK_BYTES:
            yield Index(held, window)
            held, size = [], 0
        held.append((row["item"], row.words))
        size += len(row.words)
    yield Index(held, window)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of each block's findings: items without repeats, overlapping runs of hit words joined."""
    for batch in slices(batches):
        rows = batch.column(2).to_pylist()
        out = []
        for some in rows:
            joined: list[dict] = []
            for run in sorted(some, key=lambda r: r["first"]):
                if joined and run["first"] <= joined[-1]["last"]:
                    if run["last"] > joined[-1]["last"]:
                        joined[-1] |= {"last": run["last"], "end": run["end"]}
                else:
                    joined.append(run)
            out.append(joined)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.list_(_RANGE))], ["_row", "items", "ranges"])


def _found(rows: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    cut = stored(segments(benchmark, window), "segments")
    if (cut.agg(F.sum(F.length("words"))).first()[0] or 0) <= BLOCK_BYTES:
        return _scanned(rows, next(_blocks(cut, window)))
    keyed = stored(rows.select(F.monotonically_increasing_id().alias("_row"), "*"), "numbered")
    parts = None
    for index in _blocks(cut, window):
        part = stored(_scanned(keyed.select("_row", "text"), index).where("size(items) > 0"), "hits")
        parts = part if parts is None else parts.unionByName(part)
    # A row has one row of hits for each block at most.
    gathered = parts.groupBy("_row").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.flatten(F.collect_list("ranges")).alias("ranges"))
    merged = gathered.mapInArrow(_merged, StructType([StructField("_row", LongType()), *_FOUND.fields[1:]]))
    counted = _scanned(keyed, Index([], window)).drop("items", "ranges").join(merged, "_row", "left").drop("_row")
    nothing = F.array().cast(_FOUND["items"].dataType), F.array().cast(_FOUND["ranges"].dataType)
    return counted.withColumn("items", F.coalesce("items", nothing[0])).withColumn("ranges", F.coalesce("ranges", nothing[1]))


def _hit_words() -> Column:
    return F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans (start, end in characters) of each row of docs (doc_id, text), and the carried columns."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(f"`{c}`") for c in carry), F.col("text").cast("string").alias("text"))
    spans = F.transform("ranges", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    found = _found(rows, benchmark, window)
    return found.select("doc_id", *(F.col(f"`{c}`") for c in carry), "n_words", _hit_words().alias("n_hit"), F.sort_array("items").alias("items"), spans.alias("spans"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_share: float | None = None) -> DataFrame:
    """docs without contamination, all columns kept.

    With ``max_share``, documents go whose share of hit words is larger, and
    others stay whole. Without, every hit span is cut out of its text; the rest
    is joined as it stands, and untouched texts are untouched.
    """
    row = "_decontaminated"
    found = scan(docs.withColumn(row, F.struct(*(F.col(f"`{c}`") for c in docs.columns))), benchmark, window, (row,))
    if max_share is not None:
        return found.where((F.col("n_hit") == 0) | (F.col("n_hit") <= F.lit(max_share) * F.col("n_words"))).select(f"{row}.*")
    text = F.col(row)["text"].cast("string")
    before = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))
    # substring counts characters, as the spans do.
    join = lambda held, s: F.struct(
        F.concat(held["text"], F.substring(text, (held["at"] + 1).cast("int"), (s["start"] - held["at"]).cast("int"))).alias("text"), s["end"].alias("at")
    )
    rest = lambda held: F.concat(held["text"], F.substring(text, (held["at"] + 1).cast("int"), F.length(text)))
    cut = F.when(F.size("spans") > 0, F.aggregate("spans", before, join, rest)).otherwise(text)
    return found.select(*((cut if c == "text" else F.col(row)[c]).alias(c) for c in docs.columns))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs, benchmark, window)
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_CUT = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_CUT} AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, w, least({WINDOW}, len(w)) AS n FROM (SELECT item_id, {_CUT} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda p: array_to_string(w[p:p + n - 1], ' '))) AS gram FROM items),
cut AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS p,
  unnest(list_transform(range(1, len(w) - n + 2), lambda p: array_to_string(w[p:p + n - 1], ' '))) AS gram
  FROM docs, (SELECT DISTINCT n FROM items) WHERE len(w) >= n),
found AS (SELECT r, p, n, item FROM cut JOIN windows USING (n, gram)),
hits AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS word FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
