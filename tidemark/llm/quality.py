"""Quality rules as a short-circuit cascade, in built-in functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

# Rows on which costs and rejection rates are estimated. They decide the order of the rules, never the verdict.
SAMPLE_ROWS = 2_000
FEWEST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over text, words, lines and the base counts; NULL means that the rule doesn't apply."""

    name: str
    fails: str


RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 4 * size(lines)"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    Rule("few_alphabetic", r"10 * size(filter(words, w -> w rlike '\\p{L}')) < 6 * n_words"),
    Rule("few_distinct", "5 * size(array_distinct(words)) < n_words"),
    Rule("shouting", r"10 * regexp_count(text, '\\p{Lu}') > 4 * length(text)"),
    Rule("exclamations", "10 * regexp_count(text, '!') > 3 * n_words"),
)

_SPLIT = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"
_LINES = r"filter(split(text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"


def base_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words, lines and the counts that every rule may use, one row per document.

    Repeated windows: words are hashed, and three rounds of doubling give the hash of every run of 8. Only documents
    in which a hash comes twice sort their windows by hash to find which ones, and add up the words they cover.
    """
    source = docs.select(F.col(key).alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    cut = source.withColumns({"words": F.expr(_SPLIT), "lines": F.expr(_LINES)})
    hashed = cut.withColumn("_h", F.expr("transform(words, w -> xxhash64(w))"))
    for step in (1, 2, 4):
        both = f"zip_with(slice(_h, 1, size(_h) - {step}), slice(_h, {step} + 1, size(_h)), (a, b) -> xxhash64(a, b))"
        hashed = hashed.withColumn("_h", F.expr(f"IF(size(_h) > {step}, {both}, array(0L))"))
    windows = f"size(words) >= {WINDOW} AND size(array_distinct(_h)) < size(_h)"
    marked = hashed.withColumn("_h", F.expr(f"IF({windows}, sort_array(transform(_h, (h, i) -> struct(h, i))), NULL)"))
    twice = (
        "sort_array(transform(filter(sequence(0, size(_h) - 1), j -> "
        "(j > 0 AND _h[j].h = _h[j - 1].h) OR (j + 1 < size(_h) AND _h[j].h = _h[j + 1].h)), j -> _h[j].i))"
    )
    found = marked.withColumn("_at", F.expr(f"IF(_h IS NULL, NULL, {twice})"))
    gaps = f"zip_with(_at, slice(_at, 2, size(_at)), (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW})))"
    return found.select(
        key,
        "text",
        "words",
        "lines",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.expr("regexp_count(text, '[#*$%&|<>]')").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"IF(_at IS NULL, 0L, aggregate({gaps}, 0L, (n, g) -> n + g))").alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < FEWEST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
    )


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """The rules by estimated rejections per second of work on a sample, best first.

    Only rows that the base rules let pass are looked at, as in the cascade. A rule's cost is the time of a pass over
    them with it, less that of a pass without any rule. The next rule is always the one that rejects most per cost of
    the rows that the rules before it leave; a tie keeps the given order. The sample is bounded by ``SAMPLE_ROWS`` and
    only sets the order.
    """
    rows = docs.count()
    if not rows:
        return list(rules)
    picked = docs.select("doc_id", "text").sample(min(1.0, SAMPLE_ROWS / rows), seed=7).limit(SAMPLE_ROWS)
    # Filtered once written: a filter pushed into the counts would repeat their expressions many times.
    sample = saved(base_counts(picked, "doc_id", "text")).where("NOT base_failed")

    def seconds(expression: str) -> float:
        began = time.perf_counter()
        sample.where(expression).agg(F.count(F.lit(1))).first()
        return time.perf_counter() - began

    seconds("length(text) < 0")
    idle = seconds("length(text) < 0")
    cost = [max(seconds(rule.fails) - idle, 1e-3) for rule in rules]
    verdicts = sample.select(*[F.coalesce(F.expr(r.fails), F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)])
    # At most SAMPLE_ROWS rows of a few booleans.
    left = [tuple(row) for row in verdicts.collect()]
    order: list[int] = []
    while len(order) < len(rules):
        open_rules = [i for i in range(len(rules)) if i not in order]
        best = max(open_rules, key=lambda i: sum(row[i] for row in left) / cost[i])
        order.append(best)
        left = [row for row in left if not row[best]]
    return [rules[i] for i in order]


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The base counts of each document and whether it is kept.

    A document that fails a base rule is not kept; for the others the rules run one after another, best rejection
    per cost first, and the first that fails ends the row's work. The order changes the cost, not the verdict.

    Null or empty text: no words, so base_failed and not kept. Null and repeated keys: row by row. No rows: no rows.
    Other columns are not read, whatever their names. Whole texts of any length are counted.
    """
    counted = base_counts(docs, key, text)
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    branches = " ".join(f"WHEN {rule.fails} THEN false" for rule in ordered(named, rules))
    return counted.select(
        key,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.expr(f"CASE WHEN base_failed THEN false {branches} ELSE true END").alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that pass, with the columns they came with."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(text).alias("_text"))
    # The row itself is the key, so it is carried through without a join.
    judged = judge(packed, rules, key="_row", text="_text")
    # The row number keeps the filter above the counts; pushed into them it would repeat their expressions many times.
    numbered = judged.select("_row", "kept", F.monotonically_increasing_id().alias("_n"))
    return numbered.where("kept AND _n >= 0").select("_row.*")


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
p AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT r, i, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g,
             count(*) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS n FROM p),
d AS (SELECT r, i FROM g WHERE n = 8 QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
c AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
      FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM d) GROUP BY r),
b AS (
  SELECT doc_id, t, words, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c USING (r)),
s AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * len(lines)
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 6 * n_words
            OR 5 * len(list_distinct(words)) < n_words
            OR 10 * len(regexp_extract_all(t, '\p{Lu}')) > 4 * length(t)
            OR 10 * len(regexp_extract_all(t, '!')) > 3 * n_words) AS kept
FROM s
"""
