"""Quality rules: a threshold table compiled into one Spark projection, without user functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import WORD, bind, column_or_null, replace_columns

#: Frequent function words of the languages the rules are used for.
STOP_WORDS = (
    "the and of to a in is that it was for on with as by be at this not are "
    "der die das und in von zu ist den mit ein eine des nicht auf "
    "le la les de et un une du en est que au dans pour "
    "el los las y que del se con por una su al es"
).split()

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: (rule, measure, least, most); None: no bound. A document is kept that breaks none.
RULES = (
    ("word_length", "mean_word_chars", 3.0, 10.0),
    ("symbols", "symbol_ratio", None, 0.1),
    ("stop_words", "stop_word_ratio", 0.015, None),
    ("dup_lines", "dup_line_ratio", None, 0.5),
)

#: The base rules: at least so many words, at most so many percent of them in repeated windows.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_LOW = (1 << 31) - 1


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window that the text holds at least twice.

    Windows are hashed to 33 bits above a 31-bit position, and sorted as plain longs;
    only windows with equal neighbours are then compared word by word, so the count is
    exact. The work is that of a sort, however long the text is.
    """

    def neighbours(ordered: Column, same) -> Column:
        """Positions of the elements that equal the one before or after."""
        after = F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1)))
        return F.array_distinct(F.flatten(F.filter(F.zip_with(ordered, after, same), lambda p: p.isNotNull())))

    def by_hash(a: Column, b: Column) -> Column:
        return F.when(
            F.shiftright(a, 31) == F.shiftright(b, 31), F.array(a.bitwiseAND(_LOW), b.bitwiseAND(_LOW))
        )

    def by_words(a: Column, b: Column) -> Column:
        same = (a["x"] == b["x"]) & (a["y"] == b["y"]) & (a["z"] == b["z"])
        return F.when(same, F.array(a["i"], b["i"]))

    def count(ws: Column) -> Column:
        def word(i: Column, more: int) -> Column:
            return F.get(ws, (i + more).cast("int"))

        starts = F.sequence(F.lit(0).cast("long"), F.size(ws).cast("long") - 3)
        hashed = F.transform(
            starts,
            lambda i: F.shiftleft(F.shiftright(F.xxhash64(word(i, 0), word(i, 1), word(i, 2)), 31), 31).bitwiseOR(i),
        )
        maybe = bind(F.sort_array(hashed), lambda s: neighbours(s, by_hash))
        spelled = F.transform(
            maybe,
            lambda i: F.struct(word(i, 0).alias("x"), word(i, 1).alias("y"), word(i, 2).alias("z"), i.alias("i")),
        )
        surely = bind(F.sort_array(spelled), lambda s: neighbours(s, by_words))
        return F.size(F.array_distinct(F.flatten(F.transform(surely, lambda i: F.array(i, i + 1, i + 2)))))

    return bind(words, lambda ws: F.when(F.size(ws) >= 3, count(ws)).otherwise(F.lit(0))).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """Counts that the rules read, one projection over the text; NULL text counts as empty."""
    text = F.coalesce(column_or_null(docs, "text", "string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    dup_lines = bind(lines, lambda ls: F.struct(F.size(ls).alias("n"), F.size(F.array_distinct(ls)).alias("d")))
    counted = bind(
        words,
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.size(F.filter(ws, lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop"),
            repeated_words(ws).alias("n_repeat"),
        ),
    )
    return docs.select(
        "*",
        counted.alias("_words"),
        dup_lines.alias("_lines"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    ).select(
        *docs.columns,
        F.col("_words.n_words").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.col("_lines.n") - F.col("_lines.d")).cast("long").alias("n_dup_lines"),
        F.col("_words.n_repeat").alias("n_repeat_words"),
        F.col("_lines.n").cast("long").alias("n_lines"),
        F.col("_words.n_stop").alias("n_stop_words"),
    )


def compile_rules(rules=RULES) -> Column:
    """The table as one expression: the array of the names of the rules that a document breaks."""
    ratio = {
        "mean_word_chars": F.try_divide("word_chars", "n_words"),
        "symbol_ratio": F.try_divide("n_symbols", "n_words"),
        "stop_word_ratio": F.try_divide("n_stop_words", "n_words"),
        "dup_line_ratio": F.try_divide("n_dup_lines", "n_lines"),
    }
    broken = []
    for name, measure, least, most in rules:
        value = ratio[measure] if measure in ratio else F.col(measure)
        bad = F.lit(False)
        if least is not None:
            bad = bad | (value < least)
        if most is not None:
            bad = bad | (value > most)
        broken.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)))
    return F.array_compact(F.array(*broken))


def apply_rules(docs: DataFrame, rules=RULES) -> DataFrame:
    """Documents with their counts, ``base_failed``, ``broken_rules`` and ``kept``.

    NULL and empty texts have no words and fail the base rules. Rows are judged one by
    one: repeated rows, ties and the order of rows make no difference, an empty table
    gives no rows, and input columns with a result's name are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
             "base_failed", "broken_rules", "kept", "_words", "_lines"]
    measured = measures(replace_columns(docs, names))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        measured.withColumn("base_failed", base)
        .withColumn("broken_rules", compile_rules(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
    )
