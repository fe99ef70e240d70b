"""Conversation repair, decontamination and spelling variants beside plain versions of each."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from eta_spark.llm import decontaminate, repair, variants
from eta_spark.llm.queries import QUERIES

# 11 Conversation repair

_SHAPE = re.compile("(s?(ua)+)?")


def plain_damage(rows):
    """Rows (conv_id, turn, role, text) after the planted faults; the dropped ones' ids stay as keys."""
    out = defaultdict(list)
    text = lambda v: " " if v is None else str(v)
    for conv, turn, role, words in rows:
        out[conv] += []
        kind = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, words = "user" if kind == 4 else text(role), "" if kind == 1 else re.sub("[.!?]", "", text(words)) if kind == 2 else text(words)
        out[conv] += [] if kind == 0 else [(turn, role, words)] * (1 + (kind == 3))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def plain_faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def plain_best(rows, wrong):
    """Every series of edits with at most two insertions in a place: least cost, then least audit."""
    best = (10**9, "")
    choices = []
    for (_, role, _), fault in zip(rows, wrong, strict=True):
        late = fault == "truncated"
        choices.append([("D", 3, "")] + ([] if fault in ("blank", "duplicate") else [("K", late, role[:1] or "?"), ("R", 2 + late, "u"), ("R", 2 + late, "a")]))
    inserts = [("", 0, ""), ("I", 2, "u"), ("I", 2, "a"), ("II", 4, "ua"), ("II", 4, "au")]
    steps = [inserts]
    for c in choices:
        steps += [c, inserts]
    for way in itertools.product(*steps):
        cost = sum(w[1] for w in way)
        if cost <= best[0] and _SHAPE.fullmatch("".join(w[2] for w in way)):
            best = min(best, (cost, "".join(w[0] for w in way)))
    return best


def plain_result(rows, best):
    wrong = plain_faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = best(rows, wrong)
    said, at, state = [], 0, ""
    for letter in audit:
        due = "assistant" if state == "u" else "user"
        if letter == "I":
            said.append((due, ""))
        elif letter != "D":
            said.append((rows[at][1] if letter == "K" else due, rows[at][2]))
        if letter != "D":
            state = said[-1][0][0]
        at += letter != "I"
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"), illegal, cost, audit, sha), said


def outcome(row):
    return (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit, row.repaired_sha256)


def whole(rows, wrong):
    ends = repair.cheapest([r[1] for r in rows], wrong)
    return min(ends[s] for s in "ba" if s in ends)


def test_shortest_path_equals_every_series_of_edits():
    draw = random.Random(3)
    for _ in range(250):
        rows = [(i, draw.choice(["user", "assistant", "system", "tool", ""]), draw.choice(["a.", "b", "", "c!", " d. "])) for i in range(draw.randint(0, 4))]
        wrong = plain_faults(rows)
        assert repair.faults([r[1] for r in rows], [r[2] for r in rows], set()) == wrong
        assert whole(rows, wrong) == plain_best(rows, wrong), rows


def test_pieces_join_to_the_same_edits():
    draw = random.Random(5)
    for _ in range(200):
        rows = [(i, draw.choice(["user", "assistant", "system"]), draw.choice(["a.", "b", "", "c!"]) + str(i)) for i in range(draw.randint(2, 12))]
        wrong = [draw.choice(["", "", "truncated", "blank"]) for _ in rows]
        roles, cut = [r[1] for r in rows], draw.randint(0, len(rows))
        ways = repair.cheapest(roles[:cut], wrong[:cut])
        ends = defaultdict(list)
        for src, (cost, audit) in ways.items():
            for dst, (more, letters) in repair.cheapest(roles[cut:], wrong[cut:], src).items():
                ends[dst].append((cost + more, audit + letters, src))
        assert {s: repair._least(o)[:2] for s, o in ends.items()} == repair.cheapest(roles, wrong)


ODD_TALK = [
    (1, 0, "system", "Hello."), (1, 1, "user", "Yes?"), (1, 2, "assistant", "No."), (1, 2, "assistant", "No."), (1, 9, "user", "cut off"),
    (2, None, None, None), (2, None, "user", "first."), (2, 5, "user", ""), (2, 5, "assistant", "x. \n"), (None, 1, "user", "lost."), (None, None, "assistant", None),
    (3, 1, "", "no role."), (4, -5, "user", "long. " * 60_000), (4, 2**40, "assistant", "é" * 300_000), (5, 1, "User", "capital."), (6, 0, "assistant", "alone!"),
]


@pytest.mark.parametrize("rows_a_piece", [2, 512])
def test_odd_conversations(spark, monkeypatch, rows_a_piece):
    monkeypatch.setattr(repair, "PIECE_ROWS", rows_a_piece)
    rows = ODD_TALK + [(7, t % 40, "user" if t % 3 else "assistant", f"text {t % 25}" + "." * (t % 2)) for t in range(120)] + [(8, 3, "user", "same.")] * 50
    draw = random.Random(7)
    draw.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS piece", "2 AS part", "'x' AS audit")
    found = {r.conv_id: outcome(r) for r in repair.repair(repair.damage(table)).collect()}
    expected = plain_damage(rows)
    assert found.keys() == expected.keys()
    best = lambda held, wrong: plain_best(held, wrong) if len(held) < 5 else whole(held, wrong)
    # Ties of a turn stand by role and a hash of the text, so only conversations without such ties are compared in full.
    for conv, held in expected.items():
        if len({(t, r) for t, r, _ in held}) == len({(t, r, x) for t, r, x in held}):
            assert found[conv] == plain_result(held, best)[0], conv
        else:
            assert found[conv][:4] == plain_result(held, best)[0][:4], conv
    again = {r.conv_id: outcome(r) for r in repair.repair(repair.damage(table.repartition(3))).collect()}
    assert again == found
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(repair.damage(empty)).count() == 0 and repair.repaired(empty).count() == 0
    one = repair.repair(spark.createDataFrame([(1, 0, "user", "x.", True)], "conv_id long, turn long, role string, text string, gone boolean")).collect()
    assert [outcome(r) for r in one] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repair_of_the_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: outcome(r) for r in QUERIES["op11_conversation_repair"](spark, sf_dir).collect()}
    expected = {c: plain_result(r, lambda held, wrong: plain_best(held, wrong) if len(held) < 5 else whole(held, wrong))[0] for c, r in plain_damage(rows).items()}
    assert found == expected


def test_repaired_messages_alternate(spark, sf_dir):
    table = repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    said = defaultdict(list)
    for r in sorted(repair.repaired(table).collect(), key=lambda r: r.place):
        said[r.conv_id].append(r)
    results = {r.conv_id: r for r in repair.repair(table).collect()}
    for conv, row in results.items():
        messages = said[conv]
        assert _SHAPE.fullmatch("".join(m.role[0] for m in messages))
        assert hashlib.sha256("\n".join(f"{m.role}:{m.text}" for m in messages).encode()).hexdigest() == row.repaired_sha256
        assert "".join(m.edit for m in messages) == row.audit.replace("D", "")


# 12 Decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(texts, items, window=10):
    grams = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        for p in range(max(len(words) - window, 0) + 1 if words else 0):
            grams[tuple(words[p : p + window])].add("" if item is None else str(item))
    sizes = {len(g) for g in grams}
    for doc_id, text in texts:
        words = plain_words(text)
        hit, names = set(), set()
        for n in sizes:
            for p in range(len(words) - n + 1):
                if tuple(words[p : p + n]) in grams:
                    hit |= set(range(p, p + n))
                    names |= grams[tuple(words[p : p + n])]
        yield doc_id, len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and then it sleeps"), (2, "short item"), (3, None), (4, " .,; "), (5, "over the lazy dog and then it sleeps in the sun all day"),
    (None, "an item without a name but with many words to be found here"), (5, "short item"), (10, "ÉTÉ été 42 ı İ 漢字 a b c d"), (11, "w " * 30),
]
HIT = [
    (20, "He said: THE quick-brown fox; jumps OVER the lazy dog and then it sleeps in the sun all day long."), (21, "A short ITEM, short short item"),
    (22, "été 42 ı İ 漢字 a b c d"), (22, "ÉTÉ  été.42 ı İ 漢字 A b c d e"), (23, "w w w w w w w w w"), (24, "w " * 500_000 + "short. item"), (25, "short itemised"),
]


@pytest.mark.parametrize("block", [1 << 21, 60])
def test_decontamination_equals_plain_windows(spark, odd, none, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SEGMENT", 2 if block == 60 else 4096)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    some = spark.createDataFrame(HIT, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    found = sorted(map(tuple, decontaminate.report(some, items).collect()), key=str)
    assert found == sorted(plain_hits([tuple(r) for r in some.collect()], ITEMS), key=str)
    assert decontaminate.report(none, items).count() == 0
    assert not any(r.contaminated or r.n_items for r in decontaminate.report(some, items.limit(0)).collect())


def test_cleaned_texts_hold_no_window_and_lose_nothing_else(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clashing = odd.selectExpr("*", "1 AS n_words", "2 AS spans", "3 AS items")
    kept = decontaminate.clean(clashing, items)
    assert kept.columns == clashing.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, clashing.collect()))
    some = spark.createDataFrame([r for r in HIT if r[0] != 24], "doc_id long, text string")
    cut = {r.doc_id: r.text for r in decontaminate.clean(some, items).collect()}
    assert cut[20] == "He said:  long." and cut[21] == "A , short " and cut[25] == "short itemised"
    assert {r.doc_id for r in decontaminate.clean(some, items, max_share=0.6).collect()} == {22, 23, 25}


# 13 Spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def plain_counts(texts):
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(counts):
    near = defaultdict(list)
    for a, b in itertools.combinations(counts, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o))
        if counts[best] >= 2 * counts[word]:
            form[word] = best
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        yield word, form.get(word), root, n, len(near[word]), counts[form[word]] if word in form else None


@pytest.mark.parametrize("tile", [variants.TILE, 3])
def test_near_words_equal_all_pairs(spark, tile):
    draw = random.Random(11)
    words = {"".join(draw.choice("abÀÿ") for _ in range(draw.randint(1, 7))) for _ in range(260)} | {"漢字" * k for k in range(1, 4)} | {"漢字" * 2 + "漢", "x" * 3000, "x" * 2999, "x" * 2998 + "yz"}
    counts = {w: draw.randint(1, 40) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: (r.n_near, r.form_n, r.form) for r in variants.near_words(table, tile).collect()}
    expected = {}
    for a in counts:
        others = [b for b in counts if one_edit(a, b)]
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            expected[a] = (len(others), counts[best], best)
    assert found == expected
    grouped = sorted(map(tuple, variants.group(table).collect()), key=str)
    assert grouped == sorted(plain_variants(counts), key=str)


def test_roots_of_a_long_chain(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [("v", "w0")]
    assert set(dict(variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()).values()) == {"w40"}


def test_spelling_variants_of_odd_and_given_documents(spark, odd, none, sf_dir):
    assert variants.spelling_variants(none).count() == 0
    texts = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    texts += [(50 + i, "naïvely Façade FAÇADE façades " + "Straße " * 40 + "colour color " * (i % 3)) for i in range(40)] + [(None, "colour color colours " * 5)] * 2
    table = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n")
    assert sorted(map(tuple, variants.spelling_variants(table).collect()), key=str) == sorted(plain_variants(plain_counts(texts)), key=str)
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, QUERIES["op13_spelling_variants"](spark, sf_dir).collect()), key=str)
    assert found == sorted(plain_variants(plain_counts(given)), key=str)
