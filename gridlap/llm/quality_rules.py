"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

`RULES` names a measure with its least and greatest accepted value. `measures` gives the counts, `verdict` compiles
the rules into a column; a document is kept if the base conditions hold and no rule fails.

Words are runs of other characters than ASCII white space. Repeats are found by ordering a text's three-word
windows and looking at neighbours, so the work is n log n in the text's words. Everything is computed row by row:
no shuffle, no Python.

Defined cases: a null or empty text has zeros everywhere and fails the base (fewer than 50 words); ratios of
nothing are 0. Repeated rows each give a row; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import SPACES

SYMBOLS = "#*$%&|<>"
#: Frequent words of the four languages (fixed values).
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "it", "for", "on", "was", "be", "with", "der", "die", "das", "und", "zu", "von", "den", "ist", "mit", "de", "la", "le", "les", "et", "des", "en", "un", "une", "el", "los", "que", "y", "se", "del", "las", "por"]
#: measure, least, greatest: a document outside any of them isn't kept.
RULES: list[tuple[str, float | None, float | None]] = [
    ("n_words", 50, None),
    ("mean_word_chars", 2, 16),
    ("symbol_ratio", None, 0.1),
    ("upper_ratio", None, 0.6),
    ("stop_word_ratio", 0.03, None),
    ("dup_line_ratio", None, 0.4),
]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES[1:], " " * (len(SPACES) - 1)), " "), "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated(w: Column) -> Column:
    """Number of words inside three-word windows that occur at least twice."""

    def count(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("text"), i.alias("at")))

        def covered(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (x["text"] == F.get(s, k - 1)["text"]) | (x["text"] == F.get(s, k + 1)["text"]))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))))

        return _let(F.sort_array(windows), covered)

    # Distinct hashes mean distinct windows; only other texts are compared word for word.
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    return F.when(F.size(w) < 4, F.lit(0)).when(F.size(F.array_distinct(hashes)) == F.size(w) - 2, F.lit(0)).otherwise(count(w)).cast("long")


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(without(line, SPACES)) > 0)
    return _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id with the counts and ratios of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text"), words(text).alias("w"))
    upper = F.length("text") - F.length(without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÑÓÔÖÚÜ"))
    stops = F.size(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS)))
    counted = base.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        _duplicate_lines(F.col("text")).alias("n_dup_lines"),
        _repeated(F.col("w")).alias("n_repeat_words"),
        (F.length("text") - F.length(without(F.col("text"), "\n")) + 1).alias("n_lines"),
        upper.alias("n_upper"),
        stops.alias("n_stop_words"),
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return counted.withColumns(
        {
            "mean_word_chars": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "word_chars"),
            "upper_ratio": ratio("n_upper", "word_chars"),
            "stop_word_ratio": ratio("n_stop_words", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        }
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdict(rules: list[tuple[str, float | None, float | None]] = RULES) -> Column:
    """True where every rule's measure is inside its bounds."""
    good = F.lit(True)
    for name, least, most in rules:
        if least is not None:
            good &= F.col(name) >= least
        if most is not None:
            good &= F.col(name) <= most
    return good


def apply_rules(docs: DataFrame, rules: list[tuple[str, float | None, float | None]] = RULES) -> DataFrame:
    """doc_id, the base counts, base_failed, kept."""
    return measures(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))
