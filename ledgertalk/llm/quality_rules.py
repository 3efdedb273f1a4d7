"""Quality rules as a short-circuit cascade, in built-in functions only.

Every rule is a boolean column that is true where a text fails. A text passes if no rule
fails, so the order of the rules changes the cost and never the verdict. The order is found
on a sample: each rule's cost is its measured time there, its selectivity the share of rows
that it rejects, and rules run by rejection per cost, the best first. The cascade is one
CASE expression: Spark evaluates no branch behind the first that holds.

Defined results: a null text counts as empty and has no words, so ``few_words`` rejects it;
repeated rows are judged alike, each for itself; an empty table gives an empty result; other
columns, whatever their names, pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertalk.llm.common import split_words, text_or_empty, total
from ledgertalk.sources.scratch import stored

# Limits of the rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_SYMBOLS_PERCENT = 10
MAX_UPPER_PERCENT = 50
MAX_DUPLICATE_LINES_PERCENT = 50
MIN_LETTER_WORDS_PERCENT = 60
WORD_LENGTHS = (2, 15)
# Rows, about, on which costs are measured. The order found there cannot change a verdict.
SAMPLE_ROWS = 2000
# Names that no input column has.
TEXT, WORDS = "__rule_text", "__rule_words"
POSITION_BITS = 21


@dataclass(frozen=True)
class Rule:
    name: str
    failed: Column


def _windows(words: Column) -> Column:
    """One number for each three-word window: 43 bits of its hash, then its position."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.sort_array(
        F.transform(
            starts,
            lambda w, i: F.shiftleft(
                F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)), POSITION_BITS
            ).bitwiseOR(i.cast("long")),
        )
    )


def _covered(starts: Column) -> Column:
    """Words that lie in windows of three starting at these sorted positions."""
    steps = F.transform(
        starts,
        lambda p, j: F.least(
            F.lit(3).cast("long"), F.coalesce(F.get(starts, j + 1) - p, F.lit(3).cast("long"))
        ),
    )
    return total(steps)


def _with_neighbour(ordered: Column, same) -> Column:
    """Elements equal, by ``same``, to the one before or after them."""
    no = F.lit(False)
    return F.filter(
        ordered,
        lambda x, j: F.coalesce(same(x, F.get(ordered, j + 1)), no)
        | F.coalesce(same(x, F.get(ordered, j - 1)), no),
    )


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's argument."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column, ordered: Column) -> Column:
    """Words inside three-word windows that occur twice or more, each word once.

    Windows are compared by hash, then by their words: if two that meet differ, or if
    positions do not fit their bits, the row is done again on the words themselves.
    """

    def hash_of(x: Column) -> Column:
        return F.shiftright(x, POSITION_BITS)

    def position(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1).cast("long"))

    def word(x: Column, k: int) -> Column:
        return F.get(words, (position(x) + k).cast("int"))

    def clash(found: Column) -> Column:
        return F.exists(
            F.transform(
                found,
                lambda x, j: F.coalesce(
                    (hash_of(x) == hash_of(F.get(found, j + 1)))
                    & ~(
                        (word(x, 0) == word(F.get(found, j + 1), 0))
                        & (word(x, 1) == word(F.get(found, j + 1), 1))
                        & (word(x, 2) == word(F.get(found, j + 1), 2))
                    ),
                    F.lit(False),
                ),
            ),
            lambda x: x,
        )

    by_words = F.sort_array(
        F.transform(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
            lambda w, i: F.struct(
                F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("w"),
                i.cast("long").alias("p"),
            ),
        )
    )
    exact = _bound(
        by_words,
        lambda s: _bound(
            F.sort_array(
                F.transform(
                    _with_neighbour(s, lambda x, y: x["w"] == y["w"]), lambda x: x["p"]
                )
            ),
            _covered,
        ),
    )
    by_hash = _bound(
        _with_neighbour(ordered, lambda x, y: hash_of(x) == hash_of(y)),
        lambda found: F.when(clash(found), exact).otherwise(
            _bound(F.sort_array(F.transform(found, position)), _covered)
        ),
    )
    return F.when(F.size(words) >= 1 << POSITION_BITS, exact).otherwise(by_hash)


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The numbers that the contract's base rules and the method's rules use."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": _bound(
            lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")
        ),
        "n_repeat_words": _bound(_windows(words), lambda ordered: repeated_words(words, ordered)),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
        "n_letters": F.regexp_count(text, F.lit(r"\p{L}")).cast("long"),
        "n_letter_words": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).cast("long"),
    }


def base_failed(m: dict[str, Column]) -> Column:
    return (m["n_words"] < MIN_WORDS) | (
        100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"]
    )


def base_rules(m: dict[str, Column]) -> list[Rule]:
    return [
        Rule("few_words", m["n_words"] < MIN_WORDS),
        Rule(
            "repeated_words", 100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"]
        ),
    ]


def method_rules(m: dict[str, Column]) -> list[Rule]:
    """Rules beside the base ones, with limits that leave ordinary prose far inside."""
    low, high = WORD_LENGTHS
    return [
        Rule("symbols", 100 * m["n_symbols"] > MAX_SYMBOLS_PERCENT * m["n_words"]),
        Rule("shouting", 100 * m["n_upper"] > MAX_UPPER_PERCENT * m["n_letters"]),
        Rule(
            "word_length",
            (m["word_chars"] < low * m["n_words"]) | (m["word_chars"] > high * m["n_words"]),
        ),
        Rule(
            "letterless_words",
            100 * m["n_letter_words"] < MIN_LETTER_WORDS_PERCENT * m["n_words"],
        ),
        Rule(
            "duplicate_lines",
            100 * m["n_dup_lines"] > MAX_DUPLICATE_LINES_PERCENT * m["n_lines"],
        ),
    ]


def with_inputs(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The text and its words as columns, each computed once a row."""
    return docs.withColumn(TEXT, text_or_empty(text_column)).withColumn(
        WORDS, split_words(F.col(TEXT))
    )


def inputs() -> dict[str, Column]:
    return measures(F.col(TEXT), F.col(WORDS))


def ordered_rules(
    docs: DataFrame,
    rules: Sequence[Rule],
    text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """Rules by rejection per cost on a sample, the highest first; ties by name.

    The sample is drawn row by row, about ``sample_rows`` rows however often a text is repeated.
    It decides the order of the rules only, never a verdict.
    """
    share = sample_rows / max(docs.count(), sample_rows)
    sample = docs.select(F.col(text_column).cast("string").alias(TEXT)).sample(share, seed=1)
    sample = stored(sample, "rule_sample")
    prepared = with_inputs(sample, TEXT)

    def seconds_and_share(rule: Rule) -> tuple[float, float]:
        took = []
        for _ in range(2):
            began = time.perf_counter()
            rejected, rows = prepared.agg(
                F.count(F.when(rule.failed, 1)), F.count(F.lit(1))
            ).first()
            took.append(time.perf_counter() - began)
        return min(took), rejected / max(rows, 1)

    worth = {}
    for rule in rules:
        seconds, rejected = seconds_and_share(rule)
        worth[rule.name] = rejected / max(seconds, 1e-6)
    return sorted(rules, key=lambda rule: (-worth[rule.name], rule.name))


def first_failure(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that fails, null if none does; later rules are not evaluated."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(F.coalesce(rule.failed, F.lit(False)), F.lit(rule.name)).otherwise(found)
    return found


def keep_good(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows that pass every rule, with their own columns only."""

    def rules(m: dict[str, Column]) -> list[Rule]:
        return [*base_rules(m), *method_rules(m)]

    order = [rule.name for rule in ordered_rules(docs, rules(inputs()), text_column)]
    text = text_or_empty(text_column)

    def verdict(words: Column) -> Column:
        by_name = {rule.name: rule for rule in rules(measures(text, words))}
        return first_failure([by_name[name] for name in order])

    # A filter is pushed below projections, with their expressions put in for their columns;
    # as a lambda's argument the words are computed once a row all the same.
    return docs.filter(_bound(split_words(text), verdict).isNull())


def judged(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """One row a document: the contract's counts, ``base_failed``, ``kept`` and the rule."""
    m = inputs()
    prepared = with_inputs(docs.select("doc_id", text_column), text_column)
    counts = prepared.select("doc_id", *[v.alias(k) for k, v in m.items()])
    columns = {k: F.col(k) for k in m}
    rules = ordered_rules(docs, method_rules(m), text_column)
    on_counts = {rule.name: rule for rule in method_rules(columns)}
    failed = F.when(base_failed(columns), F.lit("base")).otherwise(
        first_failure([on_counts[rule.name] for rule in rules])
    )
    return counts.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed(columns).alias("base_failed"),
        failed.isNull().alias("kept"),
    )


# The same rows in SQL.
SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, row_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), each_word AS (
  SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w
), grams AS (
  SELECT row_id, pos, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c
  FROM each_word WINDOW o AS (PARTITION BY row_id ORDER BY pos)
), marked AS (
  SELECT row_id, pos, c IS NOT NULL AND count(*) OVER (PARTITION BY row_id, a, b, c) > 1 AS twice
  FROM grams
), covered AS (
  SELECT row_id, twice
         OR coalesce(lag(twice, 1) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS inside
  FROM marked WINDOW o AS (PARTITION BY row_id ORDER BY pos)
), repeats AS (
  SELECT row_id, count(*) FILTER (WHERE inside) AS n FROM covered GROUP BY row_id
), m AS (
  SELECT doc_id, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words,
         len(regexp_extract_all(t, '\p{Lu}')) AS n_upper,
         len(regexp_extract_all(t, '\p{L}')) AS n_letters,
         len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words
  FROM w LEFT JOIN repeats r USING (row_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_upper > 50 * n_letters
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_letter_words < 60 * n_words
            OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM b
"""
