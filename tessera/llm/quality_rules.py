"""Quality rules: a threshold table compiled into one Spark projection.

Each rule of the table names a measure and the range that a good text keeps to. Measures are built from
Spark's own functions over one row, so the whole filter is a projection: no shuffle, no user function, and
cost in proportion to the text. Repeats within a text are found by sorting packed hashes of its windows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import unused, without

# Frequent words of the four languages, in lower case.
STOP_WORDS = {
    "en": "the be to of and that have with is in it for on as was are this by from at",
    "fr": "le la les de des du et un une que qui en dans est pour pas sur avec par ou au aux il",
    "de": "der die das den dem des und in zu mit sich auf ist im nicht von ein eine als für an",
    "es": "el la los las de del que y en un una por con para no se su al es lo como",
}
SYMBOLS = "#*$%&|<>"
_SPLIT = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """A measure must be at least `low` and at most `high`; the measure is an SQL expression over the base measures."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Ratios are to words or lines; a text with none has ratio null and fails the rule on length first.
RULES = (
    Rule("length", "n_words", 50, None),
    Rule("word_length", "word_chars / nullif(n_words, 0)", 2, 14),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", None, 0.25),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("stop_word_share", "n_stop_words / nullif(n_words, 0)", 0.02, None),
    Rule("repeated_words", "n_repeat_words / nullif(n_words, 0)", None, 0.5),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", None, 0.5),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, _SPLIT), lambda w: w != "")


def repeated_positions(w: Column, n: int = 3) -> Column:
    """How many words lie in n-word windows that the array holds at least twice.

    Windows are hashed, each hash packed with its position into one long and the longs sorted; equal hashes are
    then neighbours. The words of neighbours are compared, so that a hash shared by chance counts for nothing.
    """

    def of(w: Column) -> Column:
        k = F.size(w) - (n - 1)

        def packed(bits: Column) -> Column:
            at = lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(n)))
            return F.sort_array(F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.call_function("shiftleft", at(i), bits).bitwiseOR(i.cast("long"))))

        def starts(s: Column, bits: Column) -> Column:
            hashed = lambda x: F.call_function("shiftright", x, bits)
            place = lambda x: (x - F.call_function("shiftleft", hashed(x), bits)).cast("int")

            def same(x: Column, y: Column) -> Column:
                equal = hashed(x) == hashed(y)
                for j in range(n):
                    equal = equal & (F.get(w, place(x) + j) == F.get(w, place(y) + j))
                return F.coalesce(equal, F.lit(False))

            twice = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
            return F.array_sort(F.transform(twice, place))

        def covered(p: Column) -> Column:
            return F.aggregate(p, F.struct(F.lit(0).alias("sum"), F.lit(-n).alias("last")), lambda a, x: F.struct((a["sum"] + F.least(F.lit(n), x - a["last"])).alias("sum"), x.alias("last")), lambda a: a["sum"])

        bits = F.length(F.bin(F.size(w))).cast("int")
        return F.when(k >= 2, _let(bits, lambda b: _let(packed(b), lambda s: covered(starts(s, b))))).otherwise(F.lit(0))

    return _let(w, of).cast("long")


def base_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words under the struct `__measures`.

    A null text counts as an empty one: every measure is 0. Very long texts are read whole. A column of docs that is
    called `__measures` itself is replaced; others may have any names.
    """
    docs = without(docs, "__measures")
    stops = sorted({w for line in STOP_WORDS.values() for w in line.split()})
    of = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    pieces = F.split(of, _SPLIT)
    lines = F.filter(F.split(of, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    names = [unused(docs, n) for n in ("__text", "__words", "__lines")]
    split = docs.select("*", of.alias(names[0]), F.filter(pieces, lambda x: x != "").alias(names[1]), lines.alias(names[2]))
    w, t = F.col(names[1]), F.col(names[0])
    measures = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(names[2]) - F.size(F.array_distinct(names[2]))).cast("long").alias("n_dup_lines"),
        repeated_positions(w).alias("n_repeat_words"),
        F.size(names[2]).cast("long").alias("n_lines"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(stops))).cast("long").alias("n_stop_words"),
    )
    return split.withColumn("__measures", measures).drop(*names)


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule holds, over the base measures in `__measures`. A null ratio breaks its rule."""
    verdict = F.lit(True)
    for r in rules:
        expr = r.measure
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words"):
            expr = re.sub(rf"\b{name}\b", f"__measures.{name}", expr)
        value = F.expr(expr)
        held = F.lit(True)
        if r.low is not None:
            held = held & (value >= r.low)
        if r.high is not None:
            held = held & (value <= r.high)
        verdict = verdict & F.coalesce(held, F.lit(False))
    return verdict


def judged(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with `__measures`, `__base_failed` (under 50 words, or over half of them in repeated 3-word windows) and `__kept`.

    Null and empty texts have no words, so they fail; very long ones are read whole. Repeated rows are judged alike, and
    a measure at a threshold passes; an empty table stays empty. Columns of docs with these three names are replaced.
    """
    out = base_measures(without(docs, "__base_failed", "__kept"), text_col)
    m = lambda c: F.col(f"__measures.{c}")
    out = out.withColumn("__base_failed", (m("n_words") < 50) | (100 * m("n_repeat_words") > 50 * m("n_words")))
    return out.withColumn("__kept", ~F.col("__base_failed") & compiled(rules))


def kept(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that pass, with all their columns, whatever their names."""
    held = docs.select(F.struct(*(docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("held"), docs[f"`{text_col}`"].alias("text"))
    return judged(held, "text", rules).where("__kept").select(*(F.col(f"held.c{i}").alias(c) for i, c in enumerate(docs.columns)))
