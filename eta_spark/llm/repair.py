"""Conversation structure repair: the cheapest edits that make roles alternate, by a shortest path over big integers.

A conversation's rows stand in the order of their turn (nulls first; ties by
role and text). Its repaired roles must read ``(s?(ua)+)?`` by their initials.
Each row is kept (0; one more if truncated), gets the role that is due (2; one
more if truncated) or is deleted (3; the only choice for blank and duplicate
rows); messages without text may be inserted anywhere (2).

* Nodes are (rows read, role read last). The weight of an edge is one integer:
  its cost stands in the high digits, and below them a fixed number of base-256
  digits holds the letters of the edits (Keep, Rerole, Delete, Insert), the
  first edit highest, unused digits zero at the end. The smallest integer is
  thus the smallest cost and, among equals, the least audit in ASCII; an
  ordinary minimum decides everything. Two ways to a node at the same cost are
  never a prefix of one another, since the longer would hold paid insertions
  more, so what follows cannot turn their order.
* Rows are dealt by range of (conversation, turn, role, text) and sorted, so a
  conversation of any length spreads over tasks. One that lies inside a task and
  has at most ``PIECE_ROWS`` rows and ``PIECE_BYTES`` of text is solved at
  once. Others become pieces of that size, stored in the shared folder.
  Messages that an earlier piece holds are found by digest. Each piece yields
  the cheapest edits from every role to every role; a run over these few cells
  solves the conversation and tells each piece its edits. SHA-256 has no
  parallel form, so a conversation's repaired pieces, as bytes, stream through
  one task in order and are never held together.

Null roles and texts count as one blank. Rows without conv_id are one
conversation; rows without turn come first and count for no gap. Repeated rows
are duplicates. An empty table gives an empty result. Texts may be of any
length. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eta_spark.llm.common import stored
from eta_spark.llm.variants import CRC32

PIECE_ROWS, PIECE_BYTES = 512, 1 << 18
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
MAX_LONG = 2**63 - 1

#: b: nothing read yet; s, u, a: initial of the last role. What is due after it, and what a kept row may add.
_DUE = {"b": "u", "s": "u", "u": "a", "a": "u"}
_MAY = {"b": "su", "s": "u", "u": "a", "a": "u"}
_ROLE = {"u": "user", "a": "assistant"}
_LEGAL = {"su", "ua", "au"}
_BLANKS = " \t\n\x0b\x0c\r"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))


def faults(roles: list[str], texts: list[str], seen: set[bytes]) -> list[str]:
    """Each row's first fault: blank, duplicate, truncated or nothing; ``seen`` has digests of earlier rows' messages."""
    known, found = set(), []
    for role, text in zip(roles, texts, strict=True):
        words = text.rstrip(_BLANKS)
        if not words:
            found.append("blank")
        elif (role, text) in known or (seen and digest(role, text) in seen):
            found.append("duplicate")
        else:
            found.append("" if words[-1] in ".!?" else "truncated")
        known.add((role, text))
    return found


def digest(role: str, text: str) -> bytes:
    name = role.encode()
    return hashlib.blake2b(b"%d:%s%s" % (len(name), name, text.encode()), digest_size=16).digest()


def cheapest(roles: list[str], wrong: list[str], start: str = "b") -> dict[str, tuple[int, str]]:
    """Cost and audit of the cheapest edits from ``start`` to each state."""
    n = len(roles)
    width = 3 * n + 2  # an edit for each row, and two insertions in each place between
    low = 8 * width

    def edge(letter: str, cost: int, at: int) -> int:
        return (cost << low) + (ord(letter) << 8 * (width - 1 - at))

    def relax(nodes: dict, state: str, weight: int, letters: int) -> None:
        if state not in nodes or weight < nodes[state][0]:
            nodes[state] = weight, letters

    def inserted(nodes: dict) -> dict:
        # A third insertion in one place leads back to where one led.
        best, last = dict(nodes), nodes
        for _ in range(2):
            step: dict[str, tuple[int, int]] = {}
            for state, (weight, at) in last.items():
                relax(step, _DUE[state], weight + edge("I", INSERT, at), at + 1)
            for state, (weight, at) in step.items():
                relax(best, state, weight, at)
            last = step
        return best

    nodes = inserted({start: (0, 0)})
    for role, fault in zip(roles, wrong, strict=True):
        after: dict[str, tuple[int, int]] = {}
        more = TRUNCATED if fault == "truncated" else 0
        for state, (weight, at) in nodes.items():
            relax(after, state, weight + edge("D", DELETE, at), at + 1)
            if fault in ("blank", "duplicate"):
                continue
            if role[:1] and role[0] in _MAY[state]:
                relax(after, role[0], weight + edge("K", KEEP + more, at), at + 1)
            relax(after, _DUE[state], weight + edge("R", REROLE + more, at), at + 1)
        nodes = inserted(after)
    return {state: (weight >> low, (weight & ((1 << low) - 1)).to_bytes(width, "big").rstrip(b"\0").decode()) for state, (weight, _) in nodes.items()}


def _scalar(cost: int, audit: str, width: int) -> int:
    return (cost << 8 * width) + int.from_bytes(audit.encode().ljust(width, b"\0"), "big")


def _least(options: list[tuple[int, str, str]]) -> tuple[int, str, str]:
    """The smallest of (cost, audit, anything) by the one integer."""
    width = max(len(audit) for _, audit, _ in options)
    return min(options, key=lambda o: _scalar(o[0], o[1], width))


def edited(roles: list[str], texts: list[str], audit: str, state: str = "b") -> list[tuple[str, str, str]]:
    """Role, text and edit of each repaired message."""
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            state = _DUE[state]
            out.append((_ROLE[state], "", letter))
            continue
        if letter == "K":
            state = roles[at][0]
            out.append((roles[at], texts[at], letter))
        elif letter == "R":
            state = _DUE[state]
            out.append((_ROLE[state], texts[at], letter))
        at += 1
    return out


def _joined(messages: list[tuple[str, str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text, _ in messages).encode()


def _counted(roles: list[str], wrong: list[str]) -> dict[str, int]:
    illegal = sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:], strict=False))
    return {k: wrong.count(k) for k in _COUNTS[:3]} | {"illegal": illegal}


def _gaps(turns: list[int]) -> int:
    return min(MAX_LONG, turns[-1] - turns[0] + 1 - len(set(turns))) if turns else 0


def solved(turns: list[int | None], roles: list[str], texts: list[str]) -> tuple[dict, list[tuple[str, str, str]]]:
    """The result of a whole conversation, and its repaired messages."""
    wrong = faults(roles, texts, set())
    ends = cheapest(roles, wrong)
    cost, audit, _ = _least([(*ends[state], state) for state in "ba" if state in ends])
    messages = edited(roles, texts, audit)
    counts = _counted(roles, wrong) | {"gaps": _gaps([t for t in turns if t is not None]), "cost": cost, "audit": audit}
    return counts | {"repaired_sha256": hashlib.sha256(_joined(messages)).hexdigest()}, messages


_RESULT_TYPE = pa.struct([(n, pa.string() if k == "string" else pa.int64()) for n, k in (c.split() for c in _RESULT.split(", "))])
_PIECES = [
    ("no_id", pa.bool_()), ("conv", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("result", _RESULT_TYPE), ("messages", _MESSAGES),
    ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("digests", pa.list_(pa.binary())),
]
_PIECES_SQL = (
    f"no_id boolean, conv long, part long, piece long, result struct<{_RESULT.replace(' ', ':').replace(',:', ',')}>, "
    "messages array<struct<role:string,text:string,edit:string>>, turns array<long>, roles array<string>, texts array<string>, digests array<binary>"
)


def _table(rows: list[dict], fields: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in fields], [n for n, _ in fields])


def _messages(found: list[tuple[str, str, str]]) -> list[dict]:
    return [dict(zip(("role", "text", "edit"), m, strict=True)) for m in found]


def _pieces(with_messages: bool):
    """Sorted rows (no_id, conv, turn, role, text, gone) as solved conversations and, at the task's edges and where long, pieces."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, size = TaskContext.get().partitionId(), 0, [], 0

        def piece(key, held) -> dict:
            turns, roles, texts = ([r[i] for r in held] for i in (2, 3, 4))
            marks = [digest(a, b) for a, b in zip(roles, texts, strict=True)]
            return {"no_id": key[0], "conv": key[1], "part": part, "piece": number, "turns": turns, "roles": roles, "texts": texts, "digests": marks}

        # The last conversation may go on in the next task: an end of stream tells only after it.
        waiting, first = None, True
        for key, group in groupby(rows_of(batches), key=lambda r: r[:2]):
            if waiting:
                k, held = waiting
                result, messages = solved(*([r[i] for r in held] for i in (2, 3, 4)))
                out.append({"no_id": k[0], "conv": k[1], "part": part, "piece": number, "result": result, "messages": _messages(messages) if with_messages else None})
                number += 1
                waiting = None
            held, n_bytes, cut = [], 0, first
            for row in group:
                if row[5]:
                    continue
                if len(held) >= PIECE_ROWS or (held and n_bytes + len(row[4]) > PIECE_BYTES):
                    out.append(piece(key, held))
                    number, size, held, n_bytes, cut = number + 1, size + n_bytes, [], 0, True
                    if size > PIECE_BYTES:
                        yield _table(out, _PIECES)
                        out, size = [], 0
                held.append(row)
                n_bytes += len(row[4])
            if cut:
                out.append(piece(key, held))
                number += 1
            else:
                waiting = key, held
            size += n_bytes
            first = False
            if size > PIECE_BYTES or len(out) > 1000:
                yield _table(out, _PIECES)
                out, size = [], 0
        if waiting:
            out.append(piece(*waiting))
        yield _table(out, _PIECES)

    return run


_CELL = pa.struct([("src", pa.string()), ("dst", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
_CELLS = [
    *_PIECES[:4], *((name, pa.int64()) for name in _COUNTS), ("edge", pa.list_(pa.string())), ("turns", pa.list_(pa.int64())), ("cells", pa.list_(_CELL)),
]
_CELLS_SQL = (
    "no_id boolean, conv long, part long, piece long, blank long, duplicate long, truncated long, illegal long, edge array<string>, "
    "turns array<long>, cells array<struct<src:string,dst:string,cost:long,audit:string>>"
)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (key, turns, roles, texts, seen) as their counts and the cheapest edits from each state to each.

    ``edge``: first and last initial; ``turns``: first, last and number of distinct ones.
    """
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            roles, turns = row["roles"], [t for t in row["turns"] if t is not None]
            wrong = faults(roles, row["texts"], set(row["seen"] or ()))
            cells = [{"src": a, "dst": b, "cost": c, "audit": x} for a in _DUE for b, (c, x) in cheapest(roles, wrong, a).items()]
            edge = [roles[0][:1], roles[-1][:1]] if roles else []
            known = row | _counted(roles, wrong) | {"edge": edge, "turns": [turns[0], turns[-1], len(set(turns))] if turns else [], "cells": cells}
            yield _table([known], _CELLS)


_SLICES = [*_PIECES[:4], ("state", pa.string()), ("slice", pa.string()), ("result", _RESULT_TYPE)]
_SLICES_SQL = f"no_id boolean, conv long, part long, piece long, state string, slice string, {_PIECES_SQL[_PIECES_SQL.index('result') : _PIECES_SQL.index(', messages')]}"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells ordered by conversation and piece: each piece's edits, and in the last piece's row the conversation's result."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, pieces in groupby(rows, key=lambda r: (r["no_id"], r["conv"])):
        ways: dict[str, tuple[int, str]] = {"b": (0, "")}
        steps, counts, last, turns, distinct = [], dict.fromkeys(_COUNTS, 0), None, None, 0
        for row in pieces:
            options: dict[str, list[tuple[int, str, str]]] = {}
            for cell in row["cells"]:
                if cell["src"] in ways:
                    cost, audit = ways[cell["src"]]
                    options.setdefault(cell["dst"], []).append((cost + cell["cost"], audit + cell["audit"], cell["src"]))
            best = {state: _least(some) for state, some in options.items()}
            letters = {(c["src"], c["dst"]): c["audit"] for c in row["cells"] if c["dst"] in best and best[c["dst"]][2] == c["src"]}
            steps.append((row["part"], row["piece"], {dst: (src, x) for (src, dst), x in letters.items()}))
            ways = {state: (cost, audit) for state, (cost, audit, _) in best.items()}
            for name in _COUNTS:
                counts[name] += row[name]
            if row["edge"]:
                counts["illegal"] += last is not None and last + row["edge"][0] not in _LEGAL
                last = row["edge"][1]
            if row["turns"]:
                low, high, n = row["turns"]
                distinct += n - (turns is not None and turns[1] == low)
                turns = (low if turns is None else turns[0]), high
        cost, audit, state = _least([(*ways[s], s) for s in "ba" if s in ways])
        gaps = min(MAX_LONG, turns[1] - turns[0] + 1 - distinct) if turns else 0
        result = counts | {"gaps": gaps, "cost": cost, "audit": audit}
        for part, piece, back in reversed(steps):
            src, letters = back[state]
            yield _table([{"no_id": row["no_id"], "conv": row["conv"], "part": part, "piece": piece, "state": src, "slice": letters, "result": result}], _SLICES)
            result, state = None, src


_EDITED = [*_PIECES[:4], ("bytes", pa.binary()), ("messages", _MESSAGES)]


def _edited(with_messages: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                messages = edited(row["roles"], row["texts"], row["slice"], row["state"])
                yield _table([row | {"bytes": _joined(messages) if messages else None, "messages": _messages(messages) if with_messages else None}], _EDITED)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each conversation, which come in order."""
    current, sha, begun = None, None, False

    def done() -> pa.RecordBatch:
        fields = [*_PIECES[:2], ("sha", pa.string())]
        return _table([{"no_id": current[0], "conv": current[1], "sha": sha.hexdigest()}], fields)

    for batch in batches:
        keys = zip(batch.column("no_id").to_pylist(), batch.column("conv").to_pylist(), strict=True)
        for i, key in enumerate(keys):
            if key != current:
                if current is not None:
                    yield done()
                current, sha, begun = key, hashlib.sha256(), False
            part = batch.column("bytes")[i].as_py()
            if part is not None:
                sha.update(b"\n" * begun)
                sha.update(part)
                begun = True
    if current is not None:
        yield done()


KEY = ["no_id", "conv"]
PLACE = ["part", "piece"]


def _solved(rows: DataFrame, with_messages: bool) -> tuple[DataFrame, DataFrame | None]:
    """Results by conversation, and messages by conversation and piece if asked."""
    order = ["no_id", "conv", "turn", "role", "mark", "row"]
    keyed = rows.select(
        F.col("conv_id").isNull().alias("no_id"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.col("gone") if "gone" in rows.columns else F.lit(False)).alias("gone"),
    )
    # Equal rows may go to several tasks.
    keyed = keyed.withColumn("mark", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("no_id", "conv", "turn", "role", "text", "gone")
    first = stored(dealt.mapInArrow(_pieces(with_messages), _PIECES_SQL), "conversations")
    pieces = first.where("result IS NULL").drop("result", "messages")

    marks = pieces.select(*KEY, *PLACE, F.explode(F.array_distinct("digests")).alias("mark"))
    place = F.struct(*PLACE)
    several = marks.groupBy(*KEY, "mark").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    seen = marks.join(several, [*KEY, "mark"]).where(place > F.col("first")).groupBy(*KEY, *PLACE).agg(F.collect_list("mark").alias("seen"))
    known = pieces.drop("digests").join(seen, [*KEY, *PLACE], "left")
    cells = stored(known.mapInArrow(_cells, _CELLS_SQL), "cells")
    parts = stored(cells.repartition(*KEY).sortWithinPartitions(*KEY, *PLACE).mapInArrow(_solve, _SLICES_SQL), "slices")

    fixed = pieces.select(*KEY, *PLACE, "roles", "texts").join(parts.select(*KEY, *PLACE, "state", "slice"), [*KEY, *PLACE])
    fixed = fixed.mapInArrow(_edited(with_messages), "no_id boolean, conv long, part long, piece long, bytes binary, " + _PIECES_SQL[_PIECES_SQL.index("messages") : _PIECES_SQL.index(", turns")])
    if with_messages:
        fixed = stored(fixed, "edited")
    streams = fixed.select(*KEY, *PLACE, "bytes").repartition(*KEY).sortWithinPartitions(*KEY, *PLACE)
    sha = streams.mapInArrow(_digests, "no_id boolean, conv long, sha string")
    long_ones = parts.where("result IS NOT NULL").join(sha, KEY).select(*KEY, F.col("result").withField("repaired_sha256", F.col("sha")).alias("result"))
    results = first.where("result IS NOT NULL").select(*KEY, "result").unionByName(long_ones).select(*KEY, "result.*")
    named = F.when(~F.col("no_id"), F.col("conv")).alias("conv_id")
    told = None
    if with_messages:
        told = first.where("result IS NOT NULL").select(named, *PLACE, "messages").unionByName(fixed.select(named, *PLACE, "messages"))
    return results.select(named, *(c for c in results.columns if c not in KEY)), told


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation (conv_id, turn, role, text).

    Rows with a true ``gone`` only bear witness that their conversation exists.
    """
    return _solved(conversations, False)[0]


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, place (to order by), role, text, edit of each message of the repaired conversations."""
    messages = _solved(conversations, True)[1]
    return messages.select("conv_id", *PLACE, F.posexplode("messages").alias("n", "m")).select("conv_id", F.struct(*PLACE, "n").alias("place"), "m.*")


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone after the faults that a checksum of conversation and turn plants.

    Of 20 remainders, 0 drops a row, 1 empties its text, 2 removes its full
    stops, exclamation and question marks, 3 repeats it, 4 makes it a user's.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    checked = conversations.select(
        "conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
        (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("kind"),
    )
    kind = F.col("kind")
    changed = checked.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("gone"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )
    return changed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")


#: What up to two insertions make of a state, and what may follow: state, state after, letters, cost, roles said.
_INSERTED = "('b', 'b', '', 0, ''), ('b', 'u', 'I', 2, 'u'), ('b', 'a', 'II', 4, 'ua'), ('s', 's', '', 0, ''), ('s', 'u', 'I', 2, 'u'), ('s', 'a', 'II', 4, 'ua'), ('u', 'u', '', 0, ''), ('u', 'a', 'I', 2, 'a'), ('u', 'u', 'II', 4, 'au'), ('a', 'a', '', 0, ''), ('a', 'u', 'I', 2, 'u'), ('a', 'a', 'II', 4, 'ua')"
_SAY = "CASE said_by WHEN 'u' THEN ['user:'] WHEN 'a' THEN ['assistant:'] WHEN 'ua' THEN ['user:', 'assistant:'] WHEN 'au' THEN ['assistant:', 'user:'] ELSE []::VARCHAR[] END"
SQL = f"""
WITH RECURSIVE checked AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {CRC32.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM checked, range(2) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faulty AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
  left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM numbered),
inserted AS (SELECT * FROM (VALUES {_INSERTED}) AS v(src, mid, letters, more, said_by)),
edits AS (SELECT * FROM (VALUES ('b', 'b', 'D'), ('s', 's', 'D'), ('u', 'u', 'D'), ('a', 'a', 'D'), ('b', 's', 'K'), ('b', 'u', 'K'), ('s', 'u', 'K'), ('u', 'a', 'K'),
  ('a', 'u', 'K'), ('b', 'u', 'R'), ('s', 'u', 'R'), ('u', 'a', 'R'), ('a', 'u', 'R')) AS v(mid, dst, letter)),
ways AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 'b' AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS said FROM conversations
  UNION ALL
  SELECT w.conv_id, w.i + 1, dst, w.cost + more + CASE letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 + (fault = 'truncated')::INT ELSE (fault = 'truncated')::INT END,
    w.audit || letters || letter, w.said || {_SAY} || CASE letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text] ELSE [CASE dst WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text] END
  FROM ways w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN inserted ON src = state JOIN edits USING (mid)
  WHERE (letter = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (letter <> 'K' OR left(role, 1) = dst)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id, dst ORDER BY w.cost + more + CASE letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 + (fault = 'truncated')::INT ELSE (fault = 'truncated')::INT END, w.audit || letters || letter) = 1),
sizes AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
  count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
best AS (SELECT w.conv_id, cost + more AS cost, audit || letters AS audit, said || {_SAY} AS said, s.* EXCLUDE (conv_id)
  FROM ways w LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM w.conv_id JOIN inserted ON src = state WHERE i = coalesce(n, 0) AND mid IN ('b', 'a')
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY cost + more, audit || letters) = 1)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit, sha256(array_to_string(said, chr(10))) AS repaired_sha256 FROM best
"""
