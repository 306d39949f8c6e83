"""Mixing sources to target weights with hash-threshold histograms.

Every document gets a 60-bit hash. Per source, words are summed by the hash's first
12 bits; the bucket in which a word budget falls is refined by 12 more bits, and only
the documents of that small bucket are looked at one by one. What remains is one hash
threshold per source and repeat, applied as a filter: no document is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import column_or_null, replace_columns, source_key, stage, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
SEED = "mix-1"
BITS = 60
FIRST_SHIFT, SECOND_SHIFT, CELLS = 48, 36, 4096


def mix_hash(frame: DataFrame, seed: str = SEED):
    """60 bits of an MD5 over seed, doc_id and text."""
    doc_id = F.coalesce(column_or_null(frame, "doc_id", "string"), F.lit(""))
    text = F.coalesce(column_or_null(frame, "text", "string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), doc_id, text)), 1, 15), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights=WEIGHTS, share=SHARE, repeats=MAX_REPEATS) -> DataFrame:
    """Adds ``target`` to (source, source_size): one row per source.

    Sources in order of their code points, NULL last, weigh ``weights`` in turn and share
    ``share`` times all words. No target exceeds ``repeats`` times its source; the
    excess goes to the others by weight until none is above (the water level that
    repeated sharing ends at, found in one pass over the sources by their cap per weight).
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    with_cap = totals.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * repeats)
    running = (
        with_cap.withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_below", F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_rest", F.sum("_w").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    )
    full = F.col("_below") * F.col("_w") + F.col("_cap") * F.col("_rest") <= F.col("_total") * F.col("_w")
    running = running.withColumn("_full", full)
    level = (
        F.col("_total") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0))
    ) / F.sum(F.when(~F.col("_full"), F.col("_w"))).over(everything)
    return running.withColumn("_level", level).select(
        "source",
        "source_size",
        F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(F.col("_level") * F.col("_w")).alias("target"),
    )


def _boundary(cells: DataFrame, budgets: DataFrame, groups: list[str], cell: str) -> DataFrame:
    """Per budget the one cell it ends in, and the words before that cell."""
    order = Window.partitionBy("_sk", "_repeat").orderBy(cell)
    joined = cells.join(budgets, groups).withColumn(
        "_to", F.sum("_words").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_from")
    )
    return joined.where(
        (F.col("_to") - F.col("_words") <= F.col("_budget")) & (F.col("_to") > F.col("_budget"))
    ).select("_sk", "_repeat", "_budget", cell, (F.col("_to") - F.col("_words")).alias("_from"))


def mix_thresholds(sized: DataFrame, weights=WEIGHTS, share=SHARE, repeats=MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, cuts): a document of hash h is taken once per cut >= h.

    ``sized`` has (source, size, hash). Repeat r may take words up to ``target`` less
    r - 1 times the source. Documents in hash order belong to it while the middle of
    a document lies within the budget, so the words taken end within half a document.
    """
    cells = sized.select(
        "source", source_key(F.col("source")).alias("_sk"), "size", "hash",
        F.shiftright("hash", FIRST_SHIFT).alias("_cell"),
    )
    first = stage(
        cells.groupBy("source", "_sk", "_cell").agg(F.sum("size").alias("_words")), "mix-cells"
    )
    totals = first.groupBy("source", "_sk").agg(F.sum("_words").alias("source_size"))
    targets = stage(
        source_targets(totals.select("source", "source_size"), weights, share, repeats).withColumn(
            "_sk", source_key(F.col("source"))
        ),
        "mix-targets",
    )
    budgets = targets.select(
        "_sk",
        "source_size",
        "target",
        F.explode(F.sequence(F.lit(1), F.lit(int(repeats)))).alias("_repeat"),
    ).select(
        "_sk",
        "_repeat",
        F.greatest(F.lit(0.0), F.col("target") - (F.col("_repeat") - 1) * F.col("source_size")).alias("_budget"),
        "source_size",
        F.lit(0).cast("long").alias("_from"),
    )
    partial = budgets.where(F.col("_budget") < F.col("source_size")).drop("source_size")
    in_first = stage(_boundary(first.drop("source"), partial, ["_sk"], "_cell"), "mix-boundary")
    inside = cells.join(in_first, ["_sk", "_cell"]).withColumn(
        "_fine", F.shiftright("hash", SECOND_SHIFT).bitwiseAND(CELLS - 1)
    )
    second = inside.groupBy("_sk", "_repeat", "_cell", "_fine").agg(F.sum("size").alias("_words"))
    in_second = stage(
        _boundary(second, in_first, ["_sk", "_repeat", "_cell"], "_fine").join(
            in_first.select("_sk", "_repeat", "_cell"), ["_sk", "_repeat"]
        ),
        "mix-fine",
    )
    rows = (
        cells.withColumn("_fine", F.shiftright("hash", SECOND_SHIFT).bitwiseAND(CELLS - 1))
        .join(in_second, ["_sk", "_cell", "_fine"])
        .groupBy("_sk", "_repeat", "_budget", "_from", "hash")
        .agg(F.sum("size").alias("_words"))
    )
    order = Window.partitionBy("_sk", "_repeat").orderBy("hash")
    after = F.sum("_words").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_from")
    taken = (
        rows.withColumn("_to", after)
        .where(F.col("_to") * 2 - F.col("_words") <= F.col("_budget") * 2)
        .groupBy("_sk", "_repeat")
        .agg(F.max("hash").alias("_last"))
    )
    start = F.shiftleft("_cell", FIRST_SHIFT) + F.shiftleft("_fine", SECOND_SHIFT) - 1
    cuts = (
        budgets.join(in_second.drop("_budget", "_from"), ["_sk", "_repeat"], "left")
        .join(taken, ["_sk", "_repeat"], "left")
        .withColumn(
            "_cut",
            F.when(F.col("_budget") >= F.col("source_size"), F.lit(1 << BITS)).otherwise(
                F.coalesce("_last", start)
            ),
        )
        .groupBy("_sk")
        .agg(F.sort_array(F.collect_list("_cut"), asc=False).alias("cuts"))
    )
    return stage(targets.join(cuts, ["_sk"], "left"), "mix-thresholds")


def mix_sources(docs: DataFrame, weights=WEIGHTS, share=SHARE, repeats=MAX_REPEATS, seed=SEED) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``copies`` (0 to ``repeats``) says how often the mix takes the document and
    ``taken`` the words that makes. NULL and empty texts have size 0 and follow their
    hash like others. NULL is a source of its own. Rows equal in doc_id and text share a
    hash and are taken alike. An empty table gives no rows; input columns with a
    result's name are replaced.
    """
    names = ["size", "source_size", "target", "copies", "taken", "_hash", "_sk", "_cuts"]
    base = replace_columns(docs, names)
    size = word_count(column_or_null(docs, "text", "string"))
    key = column_or_null(docs, "source", "string")
    small = docs.select(key.alias("source"), size.alias("size"), mix_hash(docs, seed).alias("hash"))
    plan = mix_thresholds(stage(small, "mix-sizes"), weights, share, repeats).drop("source").withColumnRenamed("cuts", "_cuts")
    marked = base.withColumns({"size": size, "_hash": mix_hash(docs, seed), "_sk": source_key(key)})
    copies = F.size(F.filter("_cuts", lambda cut: cut >= F.col("_hash")))
    return (
        marked.join(plan, "_sk", "left")
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_hash", "_sk", "_cuts")
    )


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, with its own columns."""
    mixed = mix_sources(docs.withColumn("_kept", F.struct(*docs.columns)), **options)
    repeated = mixed.where("copies > 0").select(
        "_kept", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    )
    return repeated.select(*[F.col("_kept")[c].alias(c) for c in docs.columns])
