"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that hold a word. Of every window of neighbouring
lines the one with the smallest hash is a fingerprint, so any run of so many lines
that two places share has a fingerprint in common; a line of many words is a
fingerprint by itself. Only the places of fingerprints are kept, with the lines next to them. Places
whose fingerprint occurs again are joined and extended both ways to the windows that
selected it, and of equal runs all but the first are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import bind, column_or_null, replace_columns, row_key, stage, word_count

#: Lines of a window; a run that two places share is found from this length on.
WINDOW = 2
#: A line of so many words counts as a run by itself.
LONG_LINE_WORDS = 20


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _holds_word(line: Column) -> Column:
    return F.length(F.translate(line, " \t\n\x0b\f\r", "")) > 0


def _lowest(part: Column) -> Column:
    """The place of the smallest hash in a window, the first of equal ones."""
    return F.array_min(F.transform(part, lambda x, i: F.struct(x["a"], i.alias("i"))))["i"]


def fingerprint_places(docs: DataFrame, window: int, long_words: int) -> DataFrame:
    """(_dk, _tk, at, print, near, own): the places of all fingerprints.

    ``at`` counts the lines that hold a word and ``print`` is the line's hash. ``near`` are the lines
    that share a window with it, as two hashes each (128 bits) and whether they are long; ``own`` is its place there.
    """
    hashed = F.transform(
        F.filter(_lines(F.col("_text")), _holds_word),
        lambda line: F.struct(
            F.xxhash64(line).alias("a"),
            F.xxhash64(F.lit("second"), line).alias("b"),
            (word_count(line) >= long_words).alias("long"),
        ),
    )

    def places(ls: Column) -> Column:
        last = F.size(ls) - window
        minima = F.transform(F.sequence(F.lit(0), last), lambda i: i + _lowest(F.slice(ls, i + 1, window)))
        singles = F.filter(F.transform(ls, lambda x, i: F.when(x["long"], i)), lambda i: i.isNotNull())
        chosen = F.array_distinct(F.concat(F.when(last >= 0, minima).otherwise(F.array().cast("array<int>")), singles))

        def one(i: Column) -> Column:
            low = F.greatest(i - (window - 1), F.lit(0))
            return F.struct(
                i.alias("at"),
                F.get(ls, i)["a"].alias("print"),
                F.slice(ls, low + 1, i - low + window).alias("near"),
                (i - low).alias("own"),
            )

        return F.transform(chosen, one)

    return docs.select("_dk", "_tk", F.explode(bind(hashed, places)).alias("place")).select("_dk", "_tk", "place.*")


def extended_runs(places: DataFrame, window: int) -> DataFrame:
    """(_dk, _tk, at, lines, d1, d2): the windows that selected each place, and long lines, with their lines' digests."""

    def one(start: Column, n: int) -> Column:
        part = F.slice("near", start + 1, n)
        return F.struct(
            (F.col("at") - F.col("own") + start).alias("at"),
            F.lit(n).alias("lines"),
            F.xxhash64(F.transform(part, lambda x: x["a"])).alias("d1"),
            F.xxhash64(F.transform(part, lambda x: x["b"])).alias("d2"),
        )

    own, size = F.col("own"), F.size("near")
    starts = F.sequence(F.greatest(own - (window - 1), F.lit(0)), F.least(own, size - window))
    selecting = F.filter(starts, lambda i: i + _lowest(F.slice("near", i + 1, window)) == own)
    none = F.array().cast("array<struct<at:int,lines:int,d1:bigint,d2:bigint>>")
    windows = F.when(size >= window, F.transform(selecting, lambda i: one(i, window))).otherwise(none)
    single = F.when(F.get("near", own)["long"], F.array(one(own, 1))).otherwise(none)
    return places.select("_dk", "_tk", F.explode(F.concat(windows, single)).alias("run")).select("_dk", "_tk", "run.*")


def repeated_lines(docs: DataFrame, window: int = WINDOW, long_words: int = LONG_LINE_WORDS) -> DataFrame:
    """(_dk, _tk, _deleted): per document with repeats, the numbers of the lines to delete."""
    once = docs.select(*row_key(), column_or_null(docs, "text", "string").alias("_text"))
    found = stage(fingerprint_places(once, window, long_words), "line-places")
    # A fingerprint is repeated if two places have it; rows equal in id and text are one place.
    places = F.struct("_dk", "_tk", "at")
    prints = (
        found.groupBy("print")
        .agg(F.min(places).alias("_least"), F.max(places).alias("_most"))
        .where("_least < _most")
        .select("print")
    )
    near = extended_runs(found.join(prints, "print", "left_semi"), window)
    first = (
        near.groupBy("lines", "d1", "d2")
        .agg(F.min(places).alias("_first"), F.max(places).alias("_last"))
        .where("_first < _last")
        .drop("_last")
    )
    later = near.join(first, ["lines", "d1", "d2"]).where(F.struct("_dk", "_tk", "at") > F.col("_first"))
    return later.groupBy("_dk", "_tk").agg(
        F.array_distinct(
            F.flatten(F.collect_set(F.sequence(F.col("at"), F.col("at") + F.col("lines") - 1)))
        ).alias("_deleted")
    )


def dedup_lines(docs: DataFrame, window: int = WINDOW, long_words: int = LONG_LINE_WORDS) -> DataFrame:
    """Documents without the line runs that occur earlier; adds ``n_lines`` and ``n_deleted``.

    A run is ``window`` or more neighbouring lines, or one line of ``long_words`` words
    or more; lines without a word are passed over,
    and leave the documents that lose a line. Earlier means a smaller
    doc_id (NULL last; then the text's hash), or further up in the same document. No
    document is dropped: a copy of an earlier one keeps an empty text. NULL and empty
    texts stay as they are. Rows equal in doc_id and text are one document and are
    treated alike. ``n_chars``, if there, follows the text. An empty table gives no
    rows; input columns with a result's name are replaced.
    """
    base = replace_columns(docs, ["n_lines", "n_deleted", "_deleted", "_dk", "_tk", "_ls"])
    gone = repeated_lines(docs, window, long_words)
    lines = _lines(F.col("text"))
    joined = base.select("*", *row_key()).join(gone, ["_dk", "_tk"], "left").withColumn("_ls", lines)
    held = F.filter("_ls", _holds_word)

    def without(ls: Column) -> Column:
        """The lines but for the deleted; the work grows with the lines alone, however many are deleted."""
        numbers = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), "_deleted")
        return F.array_join(F.transform(numbers, lambda i: F.get(ls, i)), "\n")

    kept = bind(held, without)
    text = F.when(F.col("_deleted").isNull(), F.col("text")).otherwise(kept)
    result = joined.select(
        *[c for c in base.columns if c != "text"],
        text.alias("text"),
        F.size(held).cast("long").alias("n_lines"),
        F.coalesce(F.size("_deleted"), F.lit(0)).cast("long").alias("n_deleted"),
    )
    if "n_chars" in base.columns:
        result = result.withColumn("n_chars", F.length("text").cast(base.schema["n_chars"].dataType))
    return result.select(*base.columns, "n_lines", "n_deleted")
