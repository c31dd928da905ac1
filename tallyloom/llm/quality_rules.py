"""Quality rules: a table of thresholds compiled into Spark projections."""

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.common import bound

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "be", "on", "are", "this",
    "der", "die", "das", "und", "ist", "von", "den", "mit", "dem", "ein", "eine", "nicht", "auf", "zu", "des",
    "le", "la", "les", "et", "de", "un", "une", "du", "est", "que", "qui", "pour", "dans", "en", "par",
    "el", "los", "las", "y", "se", "del", "por", "con", "su", "para", "al", "lo", "como", "es",
)
# Words of a window in which repetition is looked for.
WINDOW = 3


class Rule(NamedTuple):
    """``part`` is held against ``whole``: at least and at most so many thousandths of it; None: no bound.

    Both are names of counts (see ``COUNTS``); the whole None stands for one, and the bounds
    are then counts themselves.
    """

    name: str
    part: str
    whole: str | None
    at_least: int | None = None
    at_most: int | None = None


# What every kept text has to meet, whichever table of rules is used.
BASE = (
    Rule("few_words", "n_words", None, at_least=50),
    Rule("repeated_words", "n_repeat_words", "n_words", at_most=500),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", at_least=2_000, at_most=12_000),
    Rule("symbols", "n_symbols", "n_words", at_most=100),
    Rule("exclamations", "n_exclamations", "n_words", at_most=100),
    Rule("capitals", "n_capitals", "word_chars", at_most=300),
    Rule("stop_words", "n_stop_words", "n_words", at_least=20),
    Rule("repeated_lines", "n_dup_lines", "n_lines", at_most=500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", at_most=900),
    Rule("open_lines", "n_open_lines", "n_lines", at_most=300),
)

_BLANK = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words of a text in order; none for a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BLANK), lambda w: w != "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.length(F.translate(line, " \t\x0b\x0c\r", "")) > 0)


def _twice_or_more(ordered: Column, field: str) -> Column:
    """Entries of a sorted array whose field equals that of the entry before or after."""

    def entries(found: Column) -> Column:
        def same(k: Column) -> Column:
            own = F.get(found, k)[field]
            return own.eqNullSafe(F.get(found, k - 1)[field]) | own.eqNullSafe(F.get(found, k + 1)[field])

        # A sequence of nothing would count down.
        places = F.when(F.size(found) > 1, F.sequence(F.lit(0), F.size(found) - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(places, same), lambda k: F.get(found, k))

    return bound(ordered, entries)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words of an array lie in windows that it holds twice or more, the first included.

    Windows are sorted by a hash with their places, inside the row; those whose hash has an
    equal neighbour are sorted again by their words, so equal hashes of different windows do
    no harm. What is left are places in a row's own array: nothing is shuffled.
    """
    n = F.size(words) - (window - 1)
    starts = F.when(n > 1, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def own(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(window)]  # slice() would copy all words for each

    hashed = F.sort_array(F.transform(starts, lambda i: F.struct(F.xxhash64(*own(i)).alias("h"), i.alias("i"))))
    exact = F.transform(_twice_or_more(hashed, "h"), lambda s: F.struct(F.array(*own(s["i"])).alias("w"), s["i"].alias("i")))
    places = F.sort_array(F.transform(_twice_or_more(F.sort_array(exact), "w"), lambda s: s["i"]))

    def covered(at: Column) -> Column:
        def add(total: Column, k: Column) -> Column:
            return total + F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(window)))

        every = F.sequence(F.lit(0), F.size(at) - 1)
        return F.when(F.size(at) == 0, F.lit(0).cast("bigint")).otherwise(F.aggregate(every, F.lit(0).cast("bigint"), add))

    return bound(places, covered)


def _counts(text: Column, words: Column, lines: Column, stop_words: Sequence[str], window: int) -> dict[str, Column]:
    """Every count of ``COUNTS``."""

    def lines_like(pattern: str) -> Column:
        return F.size(F.filter(lines, lambda line: line.rlike(pattern)))

    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_exclamations": F.regexp_count(text, F.lit("!")),
        "n_capitals": F.regexp_count(text, F.lit("[A-Z]")),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*stop_words))) if stop_words else F.lit(0),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_bullet_lines": lines_like("^[ \\t]*[-*\u2022]"),
        "n_open_lines": lines_like("(\\.\\.\\.|\u2026)[ \\t\\r]*$"),
        "n_repeat_words": repeated_words(words, window),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_exclamations", "n_capitals", "n_stop_words",
          "n_lines", "n_dup_lines", "n_bullet_lines", "n_open_lines", "n_repeat_words")


def fails(rule: Rule, counts: Column) -> Column:
    """Whether the counts (a struct) break a rule, in whole numbers. A whole of nothing breaks no rule."""
    unknown = {rule.part, rule.whole} - {None, *COUNTS}
    if unknown:
        raise ValueError(f"rule {rule.name}: no count {sorted(unknown)}")
    part = counts[rule.part] if rule.whole is None else 1000 * counts[rule.part]
    whole = F.lit(1) if rule.whole is None else counts[rule.whole]
    broken = F.lit(False)
    if rule.at_least is not None:
        broken = broken | (part < rule.at_least * whole)
    if rule.at_most is not None:
        broken = broken | (part > rule.at_most * whole)
    return broken


def rules_from(table: DataFrame) -> list[Rule]:
    """Rules from a table of configuration: columns name, part, whole, at_least and at_most."""
    return [Rule(*r) for r in table.select("name", "part", "whole", "at_least", "at_most").orderBy("name").collect()]


def judge_quality(
    docs: DataFrame,
    text_column: str = "text",
    rules: Sequence[Rule] = RULES,
    base: Sequence[Rule] = BASE,
    stop_words: Sequence[str] = STOP_WORDS,
    window: int = WINDOW,
) -> DataFrame:
    """``row`` (a struct of all input columns), every count, ``base_failed``, ``failed`` and ``kept``.

    The table of rules becomes columns of projections over each row: no shuffle, no user
    function, no broadcast. ``failed`` names the broken rules, of ``base`` first; a text
    with any is not kept. Ratios are compared as whole numbers, so no rounding decides.

    Counts: words (runs of anything but ASCII white space), the code points in them, symbols
    ``#*$%&|<>``, exclamation marks, capitals A-Z, stop words, lines (``\\n``-split) with a
    word, those equal to an earlier one, those that begin with a bullet or end in an ellipsis,
    and words in windows of ``window`` words that occur twice or more.

    Null texts count as empty: all counts are 0 and ``few_words`` fails. A ratio to nothing
    breaks no rule. Texts count whole, however long; a row's arrays take some 60 bytes per
    word in its task. Repeated rows are judged alike, an empty table gives an empty result,
    and input columns, being in ``row``, clash with none made here.
    """
    names = [r.name for r in (*base, *rules)]
    if len(set(names)) != len(names):
        raise ValueError("rules with the same name")

    def verdict(counts: Column) -> Column:
        base_failed = F.lit(False)
        for rule in base:
            base_failed = base_failed | fails(rule, counts)
        broken = F.array_compact(F.array(*[F.when(fails(r, counts), F.lit(r.name)) for r in (*base, *rules)]))
        return F.struct(
            *[counts[c].alias(c) for c in COUNTS], base_failed.alias("base_failed"), broken.cast("array<string>").alias("failed")
        )

    def judged(text: Column) -> Column:
        def counted(words: Column, lines: Column) -> Column:
            found = _counts(text, words, lines, stop_words, window)
            return F.struct(*[found[c].cast("bigint").alias(c) for c in COUNTS])

        counts = bound(words_of(text), lambda words: bound(lines_with_words(text), lambda lines: counted(words, lines)))
        return bound(counts, verdict)

    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), bound(text, judged).alias("_judged"))
    return rows.select("row", "_judged.*").withColumn("kept", F.size("failed") == 0)
