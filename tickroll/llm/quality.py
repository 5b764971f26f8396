"""Quality rules (operator 7): a threshold table compiled into one Spark projection.

``measures`` adds the columns that rules may use; ``verdict`` turns a table of
rules (name, measure, least, most, least words) into one boolean expression. Everything
is built-in Spark expressions inside one stage: no user function, no shuffle.

Defined cases: NULL text has no words and fails the base rule; ratios of a
text without words or characters are 0; texts of any length are measured
whole (all steps are linear or sort-based); rows are judged one by one, so
repeated rows and NULL ids need nothing special; columns of the same names
are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickroll.llm.common import SPACE_CHARS, whole_text

SYMBOLS = "#*$%&|<>"
RUN = 5    # words of a repetition window

# Common function words of the four languages of the corpus. Fixed values.
STOP_WORDS = {
    "en": ["the", "of", "and", "a", "in", "to", "is", "that", "it", "was", "for", "on", "are", "as", "with", "his", "they",
           "at", "be", "this", "have", "from", "or", "by", "not"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem",
           "nicht", "ein", "eine", "als"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para",
           "es", "al"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur",
           "au", "pas", "avec"],
}


class Rule(NamedTuple):
    """A text passes if ``least <= measure <= most``; texts of fewer words than ``from_words`` are not judged by it."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


# Decided on the labelled documents: clean prose stays, junk pages go.
RULES = [
    Rule("mean word length", "mean_word_chars", 2.0, 15.0, 20),
    Rule("symbols per word", "symbol_ratio", None, 0.30),
    Rule("lines ending in an ellipsis", "ellipsis_line_ratio", None, 0.30, 20),
    Rule("bullet lines", "bullet_line_ratio", None, 0.90, 20),
    Rule("repeated lines", "dup_line_ratio", None, 0.30),
    Rule("shouted words", "shout_ratio", None, 0.30, 10),
    Rule("stop words", "stop_ratio", 0.02, None, 50),
]


def _occurrences(text: Column, characters: str) -> Column:
    """How often any of some ASCII characters occurs: bytes lost when they are removed."""
    total = None
    for c in characters:
        n = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
        total = n if total is None else total + n
    return total.cast("long")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts and ratios of each whole text."""
    # the row travels in a struct, so its columns cannot clash with the ones made here
    df = docs.select(F.struct(*docs.columns).alias("_row"), whole_text(text).alias("_t"))
    blank = f"[{SPACE_CHARS}]+"
    df = df.withColumn("_words", F.filter(F.split("_t", blank), lambda w: w != ""))
    df = df.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: F.trim(x, F.lit(SPACE_CHARS)) != ""))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("n_lines", F.size("_lines").cast("long"))
    df = df.withColumn("word_chars", F.length("_t").cast("long") - _occurrences(F.col("_t"), SPACE_CHARS))
    df = df.withColumn("n_symbols", _occurrences(F.col("_t"), SYMBOLS))
    df = df.withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("_lines")))
    df = df.withColumn("n_repeat_words", _repeated_words())
    stop = sorted({w for words in STOP_WORDS.values() for w in words})
    per_word = lambda n: F.when(F.col("n_words") > 0, n / F.col("n_words")).otherwise(F.lit(0.0))
    per_line = lambda n: F.when(F.col("n_lines") > 0, n / F.col("n_lines")).otherwise(F.lit(0.0))
    return df.select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in MEASURES], "n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words",
        per_word(F.col("word_chars")).alias("mean_word_chars"),
        per_word(F.col("n_symbols")).alias("symbol_ratio"),
        per_word(F.size(F.filter("_words", lambda w: F.lower(w).isin(stop)))).alias("stop_ratio"),
        per_word(F.size(F.filter("_words", lambda w: (F.length(w) > 1) & (w == F.upper(w)) & (w != F.lower(w))))
                 ).alias("shout_ratio"),
        per_line(F.size(F.filter("_lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))
                 ).alias("ellipsis_line_ratio"),
        per_line(F.size(F.filter("_lines", lambda x: F.ltrim(x).startswith("- ") | F.ltrim(x).startswith("* ")
                                 | F.ltrim(x).startswith("• ")))).alias("bullet_line_ratio"),
        per_line(F.col("n_dup_lines")).alias("dup_line_ratio"))


MEASURES = ["n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word_chars",
            "symbol_ratio", "stop_ratio", "shout_ratio", "ellipsis_line_ratio", "bullet_line_ratio", "dup_line_ratio"]


def _repeated_words() -> Column:
    """Words inside ``RUN``-word windows that occur twice or more.

    Windows are hashed to 64 bits. Only if a hash repeats are they sorted by
    (hash, position); a window equal to a neighbour in that order is
    repeated, and its positions, in order, cover ``min(RUN, gap)`` words each.
    """
    n = F.size("_words")
    windows = F.transform(F.sequence(F.lit(1), n - (RUN - 1)), lambda i: F.xxhash64(F.slice("_words", i, RUN)))

    def covered(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = lambda o: F.filter(
            o, lambda x, k: (F.get(o, k - 1)["h"] == x["h"]) | (F.get(o, k + 1)["h"] == x["h"]))
        places = _let(ordered, lambda o: F.sort_array(F.transform(repeated(o), lambda x: x["i"])))
        return _let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(RUN), F.coalesce(F.get(p, k + 1) - x, F.lit(RUN)))),
            F.lit(0).cast("long"), lambda a, b: a + b))

    found = _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
                 .otherwise(covered(w)))
    return F.when(n >= RUN, found).otherwise(F.lit(0).cast("long"))




def _let(value: Column, body) -> Column:
    """Bind a computed array once: the lambda's variable holds the value, not its expression."""
    return F.transform(F.array(value), body)[0]


def base_failed() -> Column:
    """The base rule: fewer than 10 words, or more than a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def failed_rules(rules: list[Rule] = RULES) -> Column:
    """The threshold table as one expression: the names of the rules that a text fails."""
    out = []
    for rule in rules:
        value, parts = F.col(rule.measure), []
        if rule.least is not None:
            parts.append(value < F.lit(rule.least))
        if rule.most is not None:
            parts.append(value > F.lit(rule.most))
        if parts:
            failed = parts[0] if len(parts) == 1 else parts[0] | parts[1]
            out.append(F.when(failed & (F.col("n_words") >= rule.from_words), F.lit(rule.name)))
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")


def judge(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with its measures, ``base_failed``, ``failed_rules`` and ``kept``."""
    return (measures(docs.drop("base_failed", "failed_rules", "kept"), text)
            .withColumn("base_failed", base_failed()).withColumn("failed_rules", failed_rules(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def passing(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, as they are.

    Spark moves a filter on computed columns below the projections that make
    them, and would run those once more for every use. The row number in the
    condition keeps the filter above.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text).alias("_text"))
    judged = judge(rows, rules, "_text").select("_doc", "kept", F.monotonically_increasing_id().alias("_number"))
    return judged.filter(F.col("kept") & (F.col("_number") >= 0)).select("_doc.*")
