"""Quality rules: a table of thresholds compiled into projections of built-in functions.

Measures are columns over the whole text; each rule is a measure with a lowest and a highest
value; the verdict is the conjunction, and ``failed_rules`` names what failed.

Defined cases: null and empty text have no words and fail; a text of fewer words than a
window repeats none; repeated rows are judged alike; columns other than id and text are
ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.common import text_rows

GAP = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of the languages that are kept.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "this", "are", "or", "at", "from"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "au", "avec", "pas"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "es", "lo"),
}


@dataclass(frozen=True)
class Rule:
    """A measure must lie between two values (either may be absent)."""

    name: str
    measure: str
    lowest: float | None = None
    highest: float | None = None


BASE_RULES = (
    Rule("few_words", "n_words >= 20"),
    Rule("repeated_words", "100 * n_repeat_words <= 30 * n_words"),
)
RULES = (
    Rule("symbols", "n_symbols / n_words", highest=0.25),
    Rule("mean_word_length", "word_chars / n_words", lowest=2.0, highest=14.0),
    Rule("stop_words", "n_stop_words / n_words", lowest=0.04),
    Rule("capitals", "n_capital_words / n_words", highest=0.5),
    Rule("repeated_lines", "n_dup_lines / n_lines", highest=0.5),
)


def measures(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The columns that rules refer to, one row per document."""
    rows = text_rows(docs)
    split = rows.select("*", F.array_remove(F.split("text", GAP), "").alias("words"), F.split("text", "\n", -1).alias("all_lines"))
    stop = sorted({w for words in STOP_WORDS.values() for w in words})
    counted = split.select(
        "doc_id", "text", "words",
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("marks"),
        F.filter("all_lines", lambda line: F.length(F.translate(line, SPACES, "")) > 0).alias("lines"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: (F.upper(w) == w) & (F.lower(w) != w) & (F.length(w) > 1))).cast("long").alias("n_capital_words"),
    )
    windows = F.when(
        F.col("n_words") >= window,
        F.transform(
            F.sequence(F.lit(0), (F.col("n_words") - window).cast("int")),
            lambda i: F.xxhash64(*[F.col("marks")[i + k] for k in range(window)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = counted.select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_stop_words", "n_capital_words",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # Only texts with a repeated window sort their windows.
    ordered = hashed.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("windows")

    def twice(item: Column, k: Column) -> Column:
        return ((k > 0) & (F.col("ordered")[k - 1]["h"] == item["h"])) | (
            (k < F.size("ordered") - 1) & (F.col("ordered")[k + 1]["h"] == item["h"])
        )

    starts = ordered.withColumn("starts", F.sort_array(F.transform(F.filter("ordered", twice), lambda s: s["i"]))).drop("ordered")
    covered = F.aggregate(
        F.transform("starts", lambda p, k: F.when(k == 0, F.lit(window)).otherwise(F.least(F.lit(window), p - F.col("starts")[k - 1]))),
        F.lit(0), lambda total, x: total + x,
    )
    return starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("starts")


def condition(rule: Rule) -> str:
    """SQL that holds where the rule is kept; a measure that is not defined fails."""
    if rule.lowest is None and rule.highest is None:
        return rule.measure
    parts = [f"{rule.measure} >= {rule.lowest}"] if rule.lowest is not None else []
    parts += [f"{rule.measure} <= {rule.highest}"] if rule.highest is not None else []
    return " AND ".join(parts)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, base_rules: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """Measures, ``base_failed``, ``kept`` and ``failed_rules`` of each document."""
    safe = measures(docs).drop("text")

    def holds(rule: Rule) -> Column:
        # With no words or no lines a ratio is null, and so is not kept.
        return F.coalesce(F.expr(condition(rule).replace("/ n_words", "/ nullif(n_words, 0)").replace("/ n_lines", "/ nullif(n_lines, 0)")), F.lit(False))

    failed = F.filter(F.array(*[F.when(~holds(r), F.lit(r.name)) for r in (*base_rules, *rules)]), lambda x: x.isNotNull())
    base = F.array(*[F.lit(r.name) for r in base_rules])
    return safe.withColumn("failed_rules", failed).select(
        "*", F.arrays_overlap("failed_rules", base).alias("base_failed"), (F.size("failed_rules") == 0).alias("kept")
    )


RESULT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def verdicts(docs: DataFrame) -> DataFrame:
    return judge(docs).select(*RESULT)


def sql(rules: Sequence[Rule] = RULES, base_rules: Sequence[Rule] = BASE_RULES, window: int = WINDOW) -> str:
    """The same for DuckDB, by rows of windows and lines."""
    stop = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))
    word = r"[^\x20\x09-\x0D]+"
    safe = [condition(r).replace("/ n_words", "/ nullif(n_words, 0)").replace("/ n_lines", "/ nullif(n_lines, 0)") for r in rules]
    base = " AND ".join(condition(r) for r in base_rules)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
line_counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines WHERE regexp_matches(l, '{word}') GROUP BY doc_id),
windows AS (SELECT doc_id, p, array_to_string(w[p:p + {window - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS p FROM d)),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, sum(least({window}, coalesce(q - p, {window}))) AS n_repeat_words
  FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words,
    len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x AND length(x) > 1)) AS n_capital_words
  FROM d LEFT JOIN line_counts USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, NOT ({base}) AS base_failed,
  ({base}) AND {' AND '.join(f'coalesce({c}, false)' for c in safe)} AS kept
FROM m"""
