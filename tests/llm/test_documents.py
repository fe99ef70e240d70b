"""Operators on documents: odd rows, empty tables, and plain versions beside them."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

from eta_spark.llm import bpe, license, neardup, packing, quality, toxicity
from eta_spark.llm.common import components, lookup, stored
from eta_spark.llm.queries import QUERIES

from .conftest import ODD

WORDS = public.path("word_bpe_49k.json")
RANKS = public.path("byte_bpe_multi_50k.tiktoken")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# Helpers


def test_lookup_keeps_every_row_of_hot_and_other_keys(spark):
    rows = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k")
    groups = stored(rows.groupBy("k").count().withColumnRenamed("count", "n"), "groups")
    assert lookup(rows, groups, "k", "n").count() == 3000
    assert lookup(rows.limit(0), stored(groups.limit(0), "groups"), "k", "n").count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect())
    assert set(found[i] for i in range(1, 41)) == {1} and set(found[i] for i in range(100, 140)) == {100}


# 1 Licences


def test_license_scan(spark, odd, none):
    assert license.scan(none).count() == 0
    assert license.scan(odd).count() == 0
    rows = [
        (1, "Intro. Released under the MIT License. More\nLicensed under CC BY-NC 4.0."),
        (2, "LICENSED under   the apache license, version 2.0!"),
        (3, "Licensed under CC BY 4.0."),
        (4, "released under the terms"),
        (1, "Released under the MIT License."),
    ]
    found = license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license) for r in found) == [(1, "CC-BY-NC-4.0"), (1, "MIT"), (1, "MIT"), (2, "Apache-2.0")]
    assert all(r.dice == 1.0 for r in found)


def test_size_bounds_never_exclude_a_match():
    for a in range(1, 40):
        for b in range(1, 40):
            low, high = license.size_bounds(b, 0.8)
            if 2 * min(a, b) / (a + b) >= 0.8:
                assert low <= a + 1e-9 and a <= high + 1e-9


def test_words_that_a_match_needs():
    rng = np.random.default_rng(3)
    for threshold in (0.5, 0.8, 1.0):
        for text in license.TEMPLATES.values():
            grams = license.template_bigrams(text)
            needed = license.needed_words(grams, threshold)
            # The best that a sentence without these words can do is to share all the other bigrams and hold no more.
            without = sum(not needed & set(gram.split()) for gram in grams)
            assert 2 * without / (without + len(grams)) < threshold
            # Sentences that lost a few words still match only with one of them.
            for _ in range(50):
                words = [w for w in text.lower().split() if rng.random() < 0.9]
                own = license.template_bigrams(" ".join(words))
                if 2 * len(set(own) & set(grams)) >= threshold * (len(own) + len(grams)):
                    assert any(word in " ".join(words) for word in needed)


LICENCES = Path(license.__file__).parent / "licenses"


def licences(text):
    return [row[1] for row in license.Scanner(license.default_templates(0.8), 0.8).scan(text)]


@pytest.mark.parametrize(
    "text, names",
    [
        ("Licensed under the MIT License.", ["MIT"]),
        ("This project is released under the MIT License.", ["MIT"]),
        ("Use of this source code is governed by a BSD-style\nlicense that can be found in the LICENSE file.", ["BSD-3-Clause"]),
        ("// Licensed under the Apache\n// License, Version 2.0. See LICENSE.", ["Apache-2.0"]),
        ("It is a nice tool and, as said, licensed under the MIT License so that all can use it, and so on.", ["MIT"]),
        ("Code: released under the MIT License; texts: licensed under CC BY-NC 4.0, both by us.", ["MIT", "CC-BY-NC-4.0"]),
        ("This work is licensed under CC BY 4.0.", ["CC-BY-4.0"]),
        ("This work is licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.", ["CC-BY-NC-4.0"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This project is licensed under the terms of the new Quux license.", []),
        ("Released under the terms of the license that was licensed under the law.", []),
    ],
)
def test_wrapped_and_embedded_notices(text, names):
    assert licences(text) == names


@pytest.mark.parametrize("name", ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause"])
def test_pasted_short_licences(name):
    text = (LICENCES / f"{name}.txt").read_text()
    commented = "".join(f" * {line}\n" for line in text.splitlines())
    one_line = "Some words before. " + " ".join(text.split()) + " And some after."
    for pasted in (text, f"Copyright (c) 2020 Someone\n\n{text}\nint main() {{}}\n", commented, one_line, text.replace("SOFTWARE", "WORK", 1)):
        assert licences(pasted) == [name]


def test_single_paragraphs_of_licences():
    text = (LICENCES / "MIT.txt").read_text()
    assert licences(text[: text.index("The above")]) == ["MIT"]
    gpl = (LICENCES / "GPL-3.0.txt").read_text()
    assert Counter(licences(gpl)).most_common(1)[0][0] == "GPL-3.0"
    header = gpl[gpl.index("    This program is free software: you can") : gpl.index("Also add information")]
    assert set(licences(header)) == {"GPL-3.0"}
    apache = (LICENCES / "Apache-2.0.txt").read_text()
    assert set(licences(apache[apache.rindex('Licensed under the Apache License, Version 2.0 (the "License")') :])) == {"Apache-2.0"}


def test_windows_equal_a_plain_search():
    rng = np.random.default_rng(7)
    template = license.Template("X", "a b c d a b e f g", 0.8)
    scanner = license.Scanner([template], 0.8)
    for _ in range(300):
        words = [*rng.choice([*"abcdefgh"], 8), *"abcdabefg", *rng.choice([*"abcdefgh"], 8)]
        del words[rng.integers(8, 17)]
        grams = list(zip(words, words[1:], strict=False))
        want = {}
        for i in range(len(grams)):
            for j in range(i + 1, min(len(grams), i + template.pairs) + 1):
                own = set(grams[i:j])
                both = len(own & template.grams)
                if grams[i] in template.grams and 2 * both >= 0.8 * (len(own) + len(template.grams)):
                    want[i] = max(want.get(i, -99), 3 * both - len(own) - len(template.grams))
        assert {w[4]: w[0] for w in scanner.windows(grams, template)} == want


# 3 Packing


def check_packing(rows, texts, capacity):
    made = Tokenizer.from_file(WORDS)
    places = defaultdict(list)
    want = Counter()
    for doc_id, text in texts:
        ids = made.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[doc_id, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_of_odd_rows(odd, none):
    assert packing.pack(packing.pieces(none, WORDS)).count() == 0
    rows = packing.pack(packing.pieces(odd, WORDS)).collect()
    check_packing(rows, [r[:2] for r in ODD], packing.CAPACITY)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_is_near_best_fit(spark, sf_dir, capacity):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(packing.pieces(docs, WORDS, capacity), capacity).collect()
    sequences = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], capacity)
    gaps, plain = [], 0
    for length in sorted((r.length for r in rows), reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - length)
        else:
            plain += 1
            gaps.append(capacity - length)
    assert sequences <= 1.02 * plain + 1


def test_packing_of_many_tiny_pieces(spark):
    rows = spark.range(1000).selectExpr("id AS doc_id", "0 AS piece", "1L AS length")
    packed = packing.pack(rows, 8).groupBy("sequence_id").count().collect()
    assert len(packed) == 125 and max(r["count"] for r in packed) == 8


def test_ids_with_text(spark):
    texts = ["Hello, World. It's <|endoftext|> here. x", "naïve\u0085CAFÉ!! a.b,c ,d"]
    made = Tokenizer.from_file(WORDS)
    rows = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), WORDS, with_ids=True).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: made.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}


# 4 Byte-level BPE


def test_bpe_equals_tiktoken_and_round_trips(spark, sf_dir, odd, none):
    plain = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    for r in bpe.decode(bpe.encode(docs, RANKS, public.PATTERN), RANKS, public.PATTERN).collect():
        text = r.text or ""
        assert r.ids == plain.encode_ordinary(text) and r.data == text.encode() and r.decoded == text
        lengths = np.cumsum([0, *(len(plain.decode_single_token_bytes(i)) for i in r.ids)])[:-1]
        assert r.byte_offsets == lengths.tolist()
        assert all(len(text.encode()[:b].decode("utf-8", "ignore")) == c for b, c in zip(r.byte_offsets, r.char_offsets, strict=True))
    assert bpe.round_trip(none.select("doc_id", "text"), RANKS, public.PATTERN).count() == 0


def test_bpe_split_characters_and_nulls(spark):
    ids = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}).encode_ordinary("𓀀")
    assert len(ids) > 1
    rows = spark.createDataFrame([(1, ids[:1]), (2, []), (3, None)], "n int, ids array<int>")
    found = {r.n: r for r in bpe.decode(rows, RANKS, public.PATTERN).collect()}
    assert "�" in found[1].decoded and bytes(found[1].data) == "𓀀".encode()[: len(found[1].data)]
    assert found[2].decoded == "" and found[3].decoded is None
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([([99_999_999],)], "ids array<int>"), RANKS, public.PATTERN).collect()


def test_bpe_query_digests(spark, sf_dir):
    plain = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op4_byte_level_bpe"](spark, sf_dir).collect():
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# 6 Quality rules


def test_quality_of_odd_rows(odd, none, labels, no_labels):
    assert quality.quality_rules(none, no_labels).count() == 0
    assert quality.quality_rules(none, labels).count() == 0
    for truth in (labels, no_labels):
        found = quality.quality_rules(odd, truth).collect()
        assert len(found) == len(ODD)
        for r in found:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed)
    found = by_id(quality.quality_rules(odd, labels))
    assert (found[1].n_words, found[3].n_words, found[6].n_words, found[8].n_words) == (0, 0, 13, 8000)
    assert found[8].n_repeat_words == 3000 and found[6].word_chars == len(ODD[5][1].replace(" ", ""))


def test_binomial_tail_is_exact(spark):
    from math import comb

    df = spark.sql("SELECT * FROM VALUES (0L, 10L), (3L, 10L), (5L, 400L), (0L, 2000L), (70L, 5000L) AS t(k, n)")
    for r in df.select("k", "n", quality.binomial_tail(df.k, df.n, 0.02).alias("p")).collect():
        assert r.p == pytest.approx(sum(comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(r.k + 1)), rel=1e-9)


def test_thresholds_reject_bad_and_spare_good(spark):
    clean, noisy = "plain words stand in this text one after another without any sign", "pl#in w#rds st#nd #n th#s t#xt #ne #fter #nother w#th many s#gns"
    rows = [(i, f"{clean} {i}" if i % 5 else f"{noisy} {i}", "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = docs.selectExpr("doc_id", "int(doc_id % 5 > 0) AS quality")
    found = quality.quality_rules(docs, truth).collect()
    assert all(r.kept == (r.doc_id % 5 > 0) for r in found) and all("symbols" in r.failed_rules for r in found if not r.kept)
    # Too few labels certify nothing.
    few = quality.quality_rules(docs, truth.where("doc_id < 300"))
    assert few.where("kept").count() == 4000


# 9 Toxicity


def test_toxicity_of_odd_rows(odd, none, labels, no_labels):
    assert toxicity.toxicity(none, no_labels).count() == 0
    for truth in (labels, no_labels):
        found = toxicity.toxicity(odd, truth).collect()
        assert len(found) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
        assert all(r.held_out is None if r.doc_id is None else r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)


def test_toxicity_learns_words_and_stems_and_finds_sentences(spark):
    import random

    draw = random.Random(5)
    words = [f"{a}{b}o" for a in "bcdfglmnprst" for b in ("an", "er", "il", "os", "ut")]
    rows = []
    for i in range(900):
        parts = [" ".join(draw.choices(words, k=8)) for _ in range(4)]
        if i % 4 == 0:
            parts[draw.randrange(4)] += " " + draw.choice(["vile", "zqx" + draw.choice(words), "Vile"])
        rows.append((i, ". ".join(parts) + ".", int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = toxicity.toxicity(df, df.select("doc_id", "toxic")).collect()
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    text = {r[0]: r[1] for r in rows}
    for r in held:
        if r.predicted and r.doc_id % 4 == 0:
            assert any(re.search("vile|zqx", text[r.doc_id][s.start : s.end].lower()) for s in r.spans)


def test_held_out_labels_teach_nothing(spark, sf_dir):
    docs, truth = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    other = truth.selectExpr("doc_id", "CASE WHEN crc32(string(doc_id)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = (toxicity.train(docs, t) for t in (truth, other))
    assert (a.bias, a.weights) == (b.bias, b.weights)


# 10 Near duplicates


def plain_components(texts, percent=75):
    sets = {}
    for doc_id, text in texts:
        words = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def test_near_duplicates_of_odd_rows(odd, none):
    assert neardup.near_duplicates(none).count() == 0
    found = neardup.near_duplicates(odd).collect()
    assert len(found) == len(ODD)
    want = plain_components([(r[0], r[1]) for r in ODD if r[0] is not None])
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain_components([(r.doc_id, r.text) for r in docs.collect()])
    found = QUERIES["op10_near_duplicates"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want


def test_near_copies_around_the_threshold(spark):
    """A large group of copies with many edits each: links at, above and below the threshold."""
    import random

    draw = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(250):
        words = list(base)
        for _ in range(draw.randrange(7)):
            words[draw.randrange(120)] = f"x{draw.randrange(10**6)}"
        texts.append((i, " ".join(words)))
    want = plain_components(texts)
    found = neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert len({c for _, c in want.values()}) > 1


def test_odd_sketches_tell_high_similarities():
    draw = np.random.default_rng(1)
    for share, near in ((0.76, True), (0.85, True), (0.4, False), (0.2, False)):
        for _ in range(30):
            pool = draw.integers(0, 2**63, 600, dtype=np.uint64)
            both = int(400 * share)
            a, b = (np.sort(np.concatenate([pool[:both], draw.integers(0, 2**63, (400 - both) // 2, dtype=np.uint64)])) for _ in range(2))
            x, y = (neardup.odd_sketch(neardup.minhashes(s)) for s in (a, b))
            ones = sum(bin(int(v) & (2**64 - 1)).count("1") for v in x ^ y)
            assert (ones <= neardup.sketch_limit()) == near
