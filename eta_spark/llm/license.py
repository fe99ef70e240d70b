"""Licence statements in documents: Dice coefficients of word bigrams against templates.

Templates are the wordings by which licences are stated, and the licences' own
texts: each paragraph of them, and short licences also as a whole. A span's
words are its runs of letters and digits in lower case; its bigrams form a
set. With a and b bigrams, the Dice coefficient 2 |A and B| / (a + b) can reach
t only if a >= b t / (2 - t) and a <= b (2 - t) / t, so a template is compared
only with spans of such a size.

Spans are the sentences of a line, and all windows of words within a template's
size bounds, over line ends and paragraphs, so wrapped and embedded statements
count. A window begins and ends with a bigram of the template. Of overlapping
spans the one stays that shares the most bigrams less those that only one side
has; whole sentences, whose own further words do not count against them, go
before windows, then higher coefficients, then the licence that shares more with
the whole text (some paragraphs stand in several), then the first by name.
A window must also hold the words by which a short statement tells its licence
from others (names and version numbers), as must sentences for ``NOTICES``.

To reach t, a span must share at least b t / (2 - t) bigrams with the template.
So a few of the template's words can be named such that the bigrams without
them are too few; a template is compared only with texts that hold one of
these words and as many of its bigrams.

Each text is scanned by itself in one pass over Arrow batches, without a
shuffle. The number of templates is a parameter's size.

Null and empty texts have no words and give no rows. Documents without doc_id
and repeated documents are reported each. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from importlib.resources import files
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eta_spark.llm.common import slices

THRESHOLD = 0.8
#: The wording by which licences are stated.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
_CC = {"BY": "Attribution", "BY-SA": "Attribution ShareAlike", "BY-NC": "Attribution NonCommercial", "BY-ND": "Attribution NoDerivatives"}
_CC |= {"BY-NC-SA": "Attribution NonCommercial ShareAlike", "BY-NC-ND": "Attribution NonCommercial NoDerivatives"}
#: Further wordings, which the SQL twin does not know.
NOTICES = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": ["Released under the Apache License 2.0.", "Licensed under the Apache 2.0 License.", "This project is licensed under the Apache License 2.0."],
    "Apache-2.0 OR MIT": ["Licensed under either of Apache License, Version 2.0 or MIT license at your option."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "Released under the Simplified BSD License."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Released under the New BSD License."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU GPL version 2.", "Licensed under the GPLv2."],
    "GPL-3.0": ["Licensed under the GNU GPL version 3.", "Licensed under the GNU General Public License v3.0.", "Licensed under the GPLv3."],
    "ISC": ["Released under the ISC License.", "Licensed under the ISC License."],
    "LGPL-2.1": ["This library is licensed under the GNU Lesser General Public License, version 2.1."],
    "MIT": ["Licensed under the MIT License.", "This project is licensed under the terms of the MIT license."],
    "MPL-2.0": ["Licensed under the Mozilla Public License 2.0."],
    **{
        f"CC-{code}-4.0": [
            f"This work is licensed under CC {code} 4.0.",
            f"This work is licensed under a Creative Commons {words} 4.0 International License.",
            f"Creative Commons {words} 4.0 International",
        ]
        for code, words in _CC.items()
    },
}
#: Licences of at most so many bigrams are templates as a whole, and paragraphs of at least so many by themselves.
WHOLE, PARAGRAPH = 400, 15
#: Words of statements, besides numbers, that tell licences apart.
TELLING = {*"affero apache attribution bsd by cc general gpl gplv2 gplv3 isc lesser mit mozilla nc nd new noderivatives".split()}
TELLING |= {*"noncommercial sa sharealike simplified".split()}
_WORD = re.compile(r"[a-z0-9]+")
_CUT = re.compile(r"\n|(?<=[.!?])[ \t\r]+")


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(size: int, threshold: float) -> tuple[float, float]:
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def needed_words(grams: list[str], threshold: float) -> set[str]:
    """Words of which a sentence must hold at least one to reach the threshold: those in many bigrams, and long ones, which are rare."""
    needed = math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9)
    left, chosen = [set(gram.split()) for gram in grams], set()
    while left and len(left) >= needed:
        best = max(sorted(set().union(*left)), key=lambda word: len(word) * sum(word in gram for gram in left))
        chosen.add(best)
        left = [gram for gram in left if best not in gram]
    return chosen


def _paragraphs(text: str) -> list[str]:
    return re.split(r"\n[^A-Za-z0-9\n]*\n", text)


@cache
def licence_texts() -> list[tuple[str, str]]:
    """Licence and wording: whole short licences, and the paragraphs of all licence texts."""
    found = []
    for file in sorted(files(__package__).joinpath("licenses").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text("utf-8")
        if len(template_bigrams(text)) <= WHOLE:
            found.append((name, text))
        found.extend((name, part) for part in _paragraphs(text) if len(template_bigrams(part)) >= PARAGRAPH)
    return [*dict.fromkeys(found)]


class Template:
    """``sentence`` and ``window`` hold the words that such a span must hold besides."""

    def __init__(self, name: str, text: str, threshold: float, tell_sentences: bool = False, tell_windows: bool = False):
        grams = template_bigrams(text)
        self.name, self.grams = name, frozenset(tuple(gram.split()) for gram in grams)
        telling = frozenset(word for word in _WORD.findall(text.lower()) if word in TELLING or word.isdigit())
        self.sentence, self.window = telling if tell_sentences else frozenset(), telling if tell_windows else frozenset()
        self.needed = needed_words(grams, threshold)
        low, high = size_bounds(len(grams), threshold)
        self.low, self.high = math.ceil(low - 1e-9), math.floor(high + 1e-9)
        # Words repeat in long templates; a window may hold as many pairs as a span of that length has.
        self.pairs = math.floor(size_bounds(len(_WORD.findall(text.lower())) - 1, threshold)[1] + 1e-9)


def default_templates(threshold: float) -> list[Template]:
    stated = [Template(name, text, threshold, False, True) for name, text in TEMPLATES.items()]
    noticed = [Template(name, text, threshold, True, True) for name, texts in NOTICES.items() for text in texts]
    return [*stated, *noticed, *(Template(name, text, threshold) for name, text in licence_texts())]


class Scanner:
    """The statements of a text: sentence, licence, Dice coefficient, wording."""

    def __init__(self, templates: list[Template], threshold: float):
        self.templates, self.threshold = templates, threshold
        self.by_word: dict[str, list[int]] = {}
        for i, template in enumerate(self.templates):
            for word in template.needed:
                self.by_word.setdefault(word, []).append(i)

    def candidates(self, words: list[str]) -> list[Template]:
        present = self.by_word.keys() & set(words)
        if not present:
            return []
        grams = set(zip(words, islice(words, 1, None)))
        numbers = sorted({i for word in present for i in self.by_word[word]})
        return [t for t in map(self.templates.__getitem__, numbers) if len(t.grams & grams) >= t.low]

    def sentences(self, words: list[str], grams: list[tuple[str, str]], bounds: list[tuple[int, int]], templates: list[Template]) -> Iterator[tuple]:
        """The matching template of each sentence; bounds are its first word and the one after its last."""
        for number, (first, end) in enumerate(bounds):
            own = set(grams[first : end - 1])
            for t in templates:
                if t.low <= len(own) <= t.high and 2 * (both := len(own & t.grams)) >= self.threshold * (len(own) + len(t.grams)) and t.sentence <= set(words[first:end]):
                    yield 2 * both - len(t.grams), 1, 2 * both / (len(own) + len(t.grams)), t.name, first, end, number

    def windows(self, grams: list[tuple[str, str]], t: Template) -> Iterator[tuple]:
        """The best window from each place where a bigram of the template stands."""
        hits = [i for i, gram in enumerate(grams) if gram in t.grams]
        after = 0
        for k, start in enumerate(hits):
            while after < len(hits) and hits[after] < start + t.pairs:
                after += 1
            if after - k < t.low:
                continue
            own, both, best = set(), 0, None
            for i in range(start, hits[after - 1] + 1):
                gram = grams[i]
                if gram in own:
                    continue
                own.add(gram)
                if len(own) > t.high:
                    break
                if gram in t.grams:
                    both += 1
                    if 2 * both >= self.threshold * (len(own) + len(t.grams)) and (not t.window or t.window <= {word for pair in own for word in pair}):
                        score = 3 * both - len(own) - len(t.grams)
                        if best is None or score > best[0]:
                            best = score, 0, 2 * both / (len(own) + len(t.grams)), t.name, start, i + 2, None
            if best:
                yield best

    def scan(self, text: str | None) -> list[tuple[int, str, float, str]]:
        if not text:
            return []
        lower = text.lower()
        if len(lower) != len(text):  # places in the text are needed
            lower = "".join(c.lower()[0] for c in text)
        words = _WORD.findall(lower)
        templates = self.candidates(words)
        if not templates:
            return []
        places = [m.span() for m in _WORD.finditer(lower)]
        grams = list(zip(words, words[1:], strict=False))
        cuts = [(0, 0), *(m.span() for m in _CUT.finditer(text)), (len(text), len(text))]
        starts, ends = [after for _, after in cuts[:-1]], [before for before, _ in cuts[1:]]
        bounds, word = [], 0
        for end in ends:
            first = word
            while word < len(places) and places[word][0] < end:
                word += 1
            bounds.append((first, word))
        found = [*self.sentences(words, grams, bounds, templates), *(w for t in templates for w in self.windows(grams, t))]
        shared: dict[str, set] = {}
        for t in templates:
            shared.setdefault(t.name, set()).update(t.grams.intersection(grams))
        found.sort(key=lambda f: (-f[0], -f[1], -f[2], -len(shared[f[3]]), f[3], f[4]))
        taken, rows = bytearray(len(words)), []
        for _, _, dice, name, first, end, number in found:
            if 1 in taken[first:end]:
                continue
            taken[first:end] = b"\1" * (end - first)
            if number is None:
                number = bisect_right(starts, places[first][0]) - 1
                rows.append((number, name, dice, text[places[first][0] : places[end - 1][1]], first))
            else:
                rows.append((number, name, dice, text[starts[number] : ends[number]], first))
        return [row[:4] for row in sorted(rows, key=lambda row: row[4])]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, sentence (the number, from 0, of the one it begins in), license, dice, statement of each span that states a licence.

    The threshold is above 0, and a template has at least two words.
    """
    known = [Template(name, text, threshold, False, True) for name, text in templates.items()] if templates else default_templates(threshold)
    scanner = Scanner(known, threshold)
    shared = docs.sparkSession.sparkContext.broadcast(scanner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(doc_id, *row) for doc_id, text in zip(*(column.to_pylist() for column in batch.columns), strict=True) for row in shared.value.scan(text)]
            if found:
                columns = [pa.array(values, kind) for values, kind in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sentence", "license", "dice", "statement"])

    kinds = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.string()]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, sentence int, license string, dice double, statement string")


def _sql() -> str:
    sets = ", ".join(f"('{name}', {template_bigrams(text)!r})" for name, text in sorted(TEMPLATES.items()))
    return rf"""
WITH templates(license, t) AS (VALUES {sets}),
cut AS (SELECT row_number() OVER () AS r, doc_id, string_split(regexp_replace(text, '([.!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)) AS s FROM documents),
rows AS (SELECT r, doc_id, unnest(s) AS statement, unnest(range(0, len(s)))::INT AS sentence FROM cut),
words AS (SELECT *, regexp_extract_all(lower(statement), '[a-z0-9]+') AS w FROM rows),
grams AS (SELECT *, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words WHERE len(w) > 1),
scores AS (SELECT r, doc_id, sentence, statement, license, 2 * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice FROM grams, templates)
SELECT doc_id, sentence, license, dice, statement FROM scores WHERE dice >= {THRESHOLD}
QUALIFY row_number() OVER (PARTITION BY r, sentence ORDER BY dice DESC, license) = 1
"""


SQL = _sql()
