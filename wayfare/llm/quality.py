"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` names a feature, the least and the largest value that a document may
have.  features are columns computed from the text alone,
:func:`verdict` compiles the table into one boolean expression.  There is no
shuffle and no user function: a scan and a projection at any size.

Words are runs of anything but ASCII white space; lines end at ``\\n``.

Edge cases: null text is the empty text; an empty text has no words, lines or
symbols and fails the base rule; very long texts are processed whole (windows
are found by sorting, so time grows as n log n); repeated rows are judged one
by one; an empty table gives an empty result; extra columns pass through, also
those with the names of our own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, free_name, let, without, words_of

SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on are this or from at an a "
    "der die das und in zu den von mit ist des auf für nicht ein eine sich auch "
    "le la les de des et un une du que qui dans en pour par sur pas est au avec "
    "el la los las de que y en un una por con para del se su al no es "
).split()


@dataclass(frozen=True)
class Rule:
    feature: str
    least: float | None = None
    most: float | None = None


#: The threshold table.  A document is kept if every feature is in its range.
RULES = (
    Rule("mean_word_chars", 1.5, 12.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("shouts_per_word", None, 0.3),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("repeat_word_ratio", None, 0.5),
)


def _windows(words: Column) -> Column:
    """Repeated words: positions covered by a 3-word window that the text has twice or more.

    Windows are (word, word, word, position) structs, sorted; a window occurs
    again if a neighbour in that order has the same words.  Positions of
    repeated windows, sorted, cover 3 words each, less what the next overlaps.
    """

    def triples(w: Column) -> Column:
        return F.when(
            F.size(w) >= 3,
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i"))),
        )

    def same(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def repeated(s: Column) -> Column:
        hit = lambda x, i: F.when((i > 0) & same(x, F.get(s, i - 1)) | (i < F.size(s) - 1) & same(x, F.get(s, i + 1)), x["i"])
        return F.array_sort(F.filter(F.transform(s, hit), lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        part = F.transform(p, lambda x, i: F.when(i < F.size(p) - 1, F.least(F.lit(3), F.get(p, i + 1) - x)).otherwise(F.lit(3)))
        return F.aggregate(part, F.lit(0).cast("long"), lambda s, x: s + x)

    found = let(words, lambda w: let(F.array_sort(triples(w)), lambda s: let(repeated(s), covered)))
    return F.coalesce(found, F.lit(0).cast("long"))


def features(text: Column) -> Column:
    """A struct of the counts and ratios of a text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    stops = sorted(set(STOP_WORDS))

    def counts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            words_of(t).alias("words"),
            lines.alias("lines"),
            F.length(without(t, SPACE_CHARS)).cast("long").alias("word_chars"),
            (F.length(t) - F.length(without(t, SYMBOLS))).cast("long").alias("n_symbols"),
            (F.length(t) - F.length(F.replace(t, F.lit("!!"), F.lit("")))).cast("long").alias("shout_chars"),
        )

    def more(c: Column) -> Column:
        return F.struct(
            F.size(c["words"]).cast("long").alias("n_words"),
            F.size(c["lines"]).cast("long").alias("n_lines"),
            c["word_chars"].alias("word_chars"),
            c["n_symbols"].alias("n_symbols"),
            (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("long").alias("n_dup_lines"),
            _windows(c["words"]).alias("n_repeat_words"),
            (c["shout_chars"] / 2).alias("n_shouts"),
            F.size(F.filter(c["words"], lambda w: F.lower(w).isin(stops))).cast("long").alias("n_stop_words"),
        )

    def ratios(q: Column) -> Column:
        per = lambda x, n: F.when(n > 0, x / n).otherwise(F.lit(0.0))
        named = {
            "mean_word_chars": per(q["word_chars"], q["n_words"]),
            "symbols_per_word": per(q["n_symbols"], q["n_words"]),
            "shouts_per_word": per(q["n_shouts"], q["n_words"]),
            "stop_word_ratio": per(q["n_stop_words"], q["n_words"]),
            "dup_line_ratio": per(q["n_dup_lines"], q["n_lines"]),
            "repeat_word_ratio": per(q["n_repeat_words"], q["n_words"]),
        }
        base = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
        return F.struct(*[q[k].alias(k) for k in ("n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], base.alias("base_failed"), *[v.alias(k) for k, v in named.items()])

    return let(let(let(text, counts), more), ratios)


def verdict(quality: Column, rules=RULES) -> Column:
    """The threshold table as one boolean expression (true: kept)."""
    ok = ~quality["base_failed"]
    for rule in rules:
        if rule.least is not None:
            ok = ok & (quality[rule.feature] >= rule.least)
        if rule.most is not None:
            ok = ok & (quality[rule.feature] <= rule.most)
    return ok


def judge(docs: DataFrame, rules=RULES, column: str = "text") -> DataFrame:
    """``docs`` with ``quality`` (struct) and ``kept`` (boolean) behind its own columns.

    Where ``docs`` has a column of such a name, ours gets underscores behind it.
    """
    name, kept = free_name(docs, "quality"), free_name(docs, "kept")
    return docs.withColumn(name, features(F.col(column))).withColumn(kept, verdict(F.col(name), rules))


def keep_good(docs: DataFrame, rules=RULES, column: str = "text") -> DataFrame:
    """The documents that every rule keeps, with the columns they came with."""
    name = free_name(docs, "__quality")
    return docs.withColumn(name, features(F.col(column))).where(verdict(F.col(name), rules)).drop(name)
