"""Quality rules whose thresholds carry a guarantee: few good documents are rejected, per stratum.

Five rules compare a count with the number of words. A rule's cutoff is taken
from a fixed grid, per stratum, by labelled documents: among the cutoffs that
are certified, the one that best separates bad from good labels, the mildest
in a tie; losing one percent of the good weighs as much as passing all bad. A cutoff is certified if so few good labelled documents exceed it
that, were the true share of rejected good documents above ``risk`` / 5, a
count this small had at most the probability ``doubt`` / tests (the exact
binomial tail; Bonferroni over strata, rules and grid). So with confidence
1 - ``doubt``, no stratum loses more than ``risk`` of its good documents to
these rules. Where labels are too few to certify anything, the base rule
alone decides.

Everything is DataFrame expressions. Five-word windows are compared by their
64-bit hashes, within one document.

Null or empty texts have no words: all counts are 0, and the base rule rejects
them. A null stratum is a stratum of its own. Repeated documents are repeated
in the result, and each counts as one labelled document; of repeated labels of
a document the smallest counts, and labels that are null or of other documents
count nothing. Empty tables give empty results. Other columns of either table
are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eta_spark.llm.common import lookup, stored

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
RISK, DOUBT = 0.05, 0.05
#: What a share of the good documents lost costs, in shares of the bad ones caught.
PRICE = 100
#: Rule: measure, +1 if large values are rejected and -1 if small ones, cutoffs per thousand words from strict to mild.
RULES: dict[str, tuple[str, int, list[int]]] = {
    "symbols": ("n_symbols", 1, [10, 20, 50, 100, 150, 200, 250, 300, 350, 400, 500, 750, 1000]),
    "long_words": ("word_chars", 1, list(range(5500, 10001, 250))),
    "short_words": ("word_chars", -1, list(range(4750, 1999, -250))),
    "repeated_lines": ("n_dup_lines", 1, [5, 10, 20, 30, 50, 75, 100]),
    "repeated_words": ("n_repeat_words", 1, [25, 50, 75, 100, 150, 200]),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
TESTS_PER_STRATUM = sum(len(cutoffs) for _, _, cutoffs in RULES.values())


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs more than once."""
    numbered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    equal = F.zip_with(numbered, F.slice(numbered, 2, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda pair: pair.isNotNull()))))
    gaps = F.zip_with(starts, F.slice(starts, 2, F.size(hashes)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def measured(docs: DataFrame, stratum: str = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, stratum, the columns to carry, and the counts of each document's whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), *carry, text.alias("text"))
    trimmed = F.btrim("text", F.lit(SPACE))
    split = bare.withColumn("words", F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")))
    n = F.size("words")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    counted = split.select(
        "doc_id",
        "stratum",
        *carry,
        n.cast("long").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.coalesce(windows, F.array().cast("array<long>")).alias("windows"),
    )
    distinct = F.size(F.array_distinct("windows"))
    return counted.select(
        "doc_id",
        "stratum",
        *carry,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(distinct < F.size("windows"), _repeat_words(F.col("windows"))).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), for k < n: the terms follow from each other, as logarithms."""
    start = F.struct((n * F.lit(math.log1p(-p))).alias("log"), F.lit(0.0).alias("sum"))
    odds = F.lit(math.log(p) - math.log1p(-p))
    step = lambda acc, i: F.struct((acc.log + F.log((n - i) / (i + 1)) + odds).alias("log"), (acc.sum + F.exp(acc.log)).alias("sum"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), k), start, step, lambda acc: acc.sum)


def _rejects(rule: str, cutoff: Column | int) -> Column:
    measure, sign, _ = RULES[rule]
    value, limit = 1000 * F.col(measure), cutoff * F.col("n_words")
    return value > limit if sign > 0 else value < limit


def thresholds(counts: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """stratum, rule, cutoff: the certified cutoffs that separate best; counts come from ``measured``."""
    truth = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    truth = truth.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = counts.where(~base_failed()).join(truth, "doc_id")
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    tests = [(rule, cutoff) for rule, (_, _, cutoffs) in RULES.items() for cutoff in cutoffs]
    sums = [F.count_if(who & _rejects(rule, cutoff)).alias(f"{name}_{i}") for i, (rule, cutoff) in enumerate(tests) for name, who in (("g", good), ("b", bad))]
    held = stored(labelled.groupBy("stratum").agg(F.count_if(good).alias("good"), F.count_if(bad).alias("bad"), *sums), "held")
    strata = held.count()

    sign = {rule: RULES[rule][1] for rule in RULES}
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.lit(cutoff).alias("cutoff"), F.lit(sign[rule] * cutoff).alias("mild"), F.col(f"g_{i}").alias("lost"), F.col(f"b_{i}").alias("caught"))
        for i, (rule, cutoff) in enumerate(tests)
    ]
    each = held.select("stratum", "good", "bad", F.inline(F.array(*rows)))
    limit = doubt / max(1, strata * TESTS_PER_STRATUM)
    share = risk / len(RULES)
    certain = F.when(F.col("lost") < share * F.col("good"), binomial_tail(F.col("lost"), F.col("good"), share) <= limit)
    gain = F.col("caught") * F.col("good") - PRICE * F.col("lost") * F.col("bad")
    passed = each.withColumn("gain", gain).where(certain & (F.col("gain") > 0))
    best = F.max_by("cutoff", F.struct("gain", "mild"))
    return passed.groupBy("stratum", "rule").agg(best.alias("cutoff"))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, doubt: float = DOUBT, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to carry, the five counts, base_failed, kept, failed_rules; one row for each document."""
    counts = stored(measured(docs, stratum, carry), "quality")
    chosen = thresholds(counts, labels, risk, doubt)
    columns = [F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"cut_{rule}") for rule in RULES]
    # A null stratum needs a key to be joined by.
    key = F.when(F.col("stratum").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "stratum")).alias("key")
    sizes = counts.groupBy(key).agg(F.count("*").alias("rows"))
    cuts = chosen.groupBy(key).agg(*columns)
    groups = stored(sizes.join(cuts, "key", "left"), "cutoffs")
    judged = lookup(counts.withColumn("key", key), groups, "key", "rows")
    failed = [F.when(F.coalesce(_rejects(rule, F.col(f"cut_{rule}")), F.lit(False)), F.lit(rule)) for rule in RULES]
    names = F.array_compact(F.array(*failed))
    return judged.select(
        "doc_id",
        *carry,
        *MEASURES,
        base_failed().alias("base_failed"),
        (~base_failed() & (F.size(names) == 0)).alias("kept"),
        F.when(base_failed(), F.array(F.lit("base"))).otherwise(names).alias("failed_rules"),
    )


def _sql() -> str:
    """The same in DuckDB's SQL, without failed_rules."""
    space = r"[\x20\x09-\x0D]"
    tests = ", ".join(
        f"('{rule}', '{measure}', {sign}, {cutoff})" for rule, (measure, sign, cutoffs) in RULES.items() for cutoff in cutoffs
    )
    value = "CASE measure " + " ".join(f"WHEN '{m}' THEN {m}" for m in MEASURES[1:]) + " END"
    share = RISK / len(RULES)
    return rf"""
WITH raw AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM raw),
grams AS (SELECT r, list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) AS g FROM split WHERE len(words) >= 5),
placed AS (SELECT r, unnest(g) AS gram, unnest(range(1, len(g) + 1)) AS i FROM grams),
twice AS (SELECT r, i FROM placed QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
gaps AS (SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS gap FROM twice),
covered AS (SELECT r, sum(gap)::BIGINT AS n FROM gaps GROUP BY r),
counts AS (SELECT r, doc_id, lang, len(words)::BIGINT AS n_words, length(regexp_replace(text, '{space}+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
truth AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
tests(rule, measure, sign, cutoff) AS (VALUES {tests}),
held AS (SELECT lang, quality, {", ".join(MEASURES)} FROM based JOIN truth USING (doc_id) WHERE NOT base_failed),
each AS (SELECT lang, rule, sign, cutoff, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 0) AS bad,
  count(*) FILTER (quality = 1 AND sign * 1000 * ({value}) > sign * cutoff * n_words) AS lost,
  count(*) FILTER (quality = 0 AND sign * 1000 * ({value}) > sign * cutoff * n_words) AS caught
  FROM held, tests GROUP BY ALL),
tails AS (SELECT *, list_sum(list_transform(range(0, lost + 1), lambda i: exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1)
  + i * ln({share}) + (good - i) * ln(1 - {share})))) AS tail FROM each WHERE lost < {share} * good),
passed AS (SELECT *, caught * good - {PRICE} * lost * bad AS gain FROM tails
  WHERE tail <= {DOUBT} / ((SELECT count(*) FROM (SELECT DISTINCT lang FROM held)) * {TESTS_PER_STRATUM}) AND caught * good > {PRICE} * lost * bad),
best AS (SELECT lang, rule, measure, sign, cutoff FROM passed JOIN (SELECT DISTINCT rule, measure FROM tests) USING (rule)
  QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, sign * cutoff DESC) = 1),
failed AS (SELECT DISTINCT r FROM based JOIN best ON based.lang IS NOT DISTINCT FROM best.lang
  WHERE sign * 1000 * ({value}) > sign * cutoff * n_words)
SELECT doc_id, {", ".join(MEASURES)}, base_failed, NOT base_failed AND r NOT IN (SELECT r FROM failed) AS kept FROM based
"""


SQL = _sql()
