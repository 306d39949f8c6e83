"""Language ID by interpolated Kneser-Ney character models.

Characters are the lower-cased letters and marks of all scripts, and one for all between
them, so the models grow with the corpus. All labelled texts of the training fold are
counted and smoothed in Spark; the models are sorted arrays of 64-bit gram keys with
their log probabilities for each language. A text goes to the language with
the lowest cross-entropy a character, and is rejected if even that is out of the range of
training texts of that language that a second model has not seen.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.bytestext import U64, mix
from tripflow.llm.common import column_or_null, map_in_arrow, replace_columns, stage

FOLDS, HELD_OUT = 4, 2
ORDER, CLASSES = 4, 32
CODES, CODE_BITS = 0x110000, 21
#: The characters before a gram's last, for grams of four to one characters.
MASKS = [U64((1 << (CODE_BITS * k)) - 1) for k in range(ORDER - 1, -1, -1)]
#: Tells marks from letters, above all code points.
MARK = 1 << 31
UNDETERMINED = "und"
#: Texts with fewer letters are never rejected for their entropy.
MIN_LETTERS = 20
#: One text of so many of the training fold sets the limits, by a model of the others.
PROBES = 8
#: A text is rejected if its entropy is above this share's point of the probes by more than the
#: margin, which a passage in another language within a text does not use up.
HIGH, MARGIN_BITS = 0.99, 2.0
BINS_PER_BIT = 50
_FOUND = ["lang_pred", "score", "bits", "letters"]
#: The posterior weighs at most so many characters, as texts repeat themselves.
SCORE_CHARS = 100


@cache
def _characters() -> np.ndarray:
    """The lower-case character of every code point, with a bit set for marks; 0 for what is neither letter nor mark."""
    table = np.zeros(CODES, np.uint32)
    for code in range(CODES):
        char = chr(code)
        kind = unicodedata.category(char)[0]
        if kind in "LM":
            table[code] = ord(char.lower()[0]) | (MARK if kind == "M" else 0)
    return table


def _read(text: str) -> np.ndarray:
    return _characters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


def letter_count(text: str) -> int:
    """The letters of a text; marks that stand on none are no letters."""
    chars = _read(text)
    return int(np.count_nonzero((chars > 0) & (chars < MARK)))


def text_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The three characters before and the character, for each letter, mark or gap; gaps of any length are one."""
    chars = _read(text) & np.uint32(MARK - 1)
    filled = chars != 0
    keep = filled.copy()
    keep[1:] |= filled[:-1]
    chars = np.concatenate((np.zeros(ORDER - 1, U64), chars[keep].astype(U64)))
    before = chars[:-3] << U64(2 * CODE_BITS) | chars[1:-2] << U64(CODE_BITS) | chars[2:-1]
    return before, chars[3:]


def _keys(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(before * U64(0x9E3779B97F4A7C15) + last)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts by language of every 512 texts."""
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            part = whole.slice(at, 512).to_pydict()
            grouped: dict[tuple, list] = {}
            for text, *group in zip(part["text"], part["lang"], part["_probe"], strict=True):
                grouped.setdefault(tuple(group), []).append(text_grams(text))
            for (lang, probe), grams in grouped.items():
                before, last = (np.concatenate(x) for x in zip(*grams, strict=True))
                _, first, n = np.unique(_keys(before, last), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(n), pa.string()),
                        pa.array([probe] * len(n), pa.bool_()),
                        pa.array(before[first].astype(np.int64)),
                        pa.array(last[first].astype(np.int64)),
                        pa.array(n.astype(np.int64)),
                    ],
                    names=["lang", "_probe", "before", "last", "n"],
                )


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted keys are there, and the values of these."""
    if not len(keys):
        return np.zeros(len(wanted), bool), values[:0]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    there = keys[at] == wanted
    return there, values[at[there]]


@dataclass
class Model:
    """Log probabilities (base 2) of one language as sorted arrays, from four characters down to one.

    ``seen`` has (keys, log probabilities) of each order's grams, ``weights`` (characters before,
    back-off logs); a character that the language does not have costs ``floor``.
    """

    seen: list[tuple[np.ndarray, np.ndarray]]
    weights: list[tuple[np.ndarray, np.ndarray]]
    floor: float

    def logs(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        out, left, backed = np.zeros(len(last)), np.arange(len(last)), np.zeros(len(last))
        for (keys, logs), (heads, weights), mask in zip(self.seen, self.weights, MASKS, strict=True):
            there, found = _find(keys, logs, _keys(before[left] & mask, last[left]))
            out[left[there]] = backed[left[there]] + found
            left = left[~there]
            there, found = _find(heads, weights, before[left] & mask)
            backed[left[there]] += found
        out[left] = backed[left] + self.floor
        return out


@dataclass
class Models:
    """The models of all languages, in the order of their names."""

    langs: list[str]
    models: list[Model]


def _smooth(counts: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interpolated probabilities of ``counts`` (last axis: the character) and the weight of ``below``."""
    once, twice = (counts == 1).sum(), (counts == 2).sum()
    discount = once / (once + 2 * twice) if once and twice else 0.5
    total = counts.sum(-1, keepdims=True)
    kinds = (counts > 0).sum(-1, keepdims=True)
    safe = np.maximum(total, 1)
    weight = np.where(total > 0, discount * kinds / safe, 1.0)
    return np.maximum(counts - discount, 0) / safe + weight * below, weight


def kneser_ney(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Four-gram and three-gram log probabilities and the back-off weights' logs of one language.

    The plain form over a table of 32 characters, which `smooth` is compared with. Lower orders count the different characters before a gram, not its occurrences.
    """
    four = counts.reshape((CLASSES,) * ORDER)
    three = (four > 0).sum(0)
    two = (three > 0).sum(0)
    one = (two > 0).sum(0)
    below, _ = _smooth(one, np.full(CLASSES, 1 / CLASSES))
    below, _ = _smooth(two, below)
    below, _ = _smooth(three, below)
    full, weight = _smooth(four, below)
    return np.log2(full).ravel(), np.log2(below).ravel(), np.log2(weight).ravel()


def smooth(counts: DataFrame, codes: int = CODES) -> tuple[DataFrame, DataFrame]:
    """(lang, level, before, last, log) and (lang, level, before, log) from (lang, before, last, n).

    Levels 0 to 3 are grams of four to one characters; the second table has the back-off
    weights. Lower orders count the different characters before a gram.
    """
    levels = [counts]
    for mask in MASKS[1:]:
        head = F.col("before").bitwiseAND(F.lit(int(mask)))
        levels.append(
            stage(levels[-1].groupBy("lang", head.alias("before"), "last").agg(F.count("*").alias("n")), "language-order")
        )
    below, grams, weights = None, [], []
    for level in range(ORDER - 1, -1, -1):
        table = levels[level]
        times = table.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("_1"), F.count_if(F.col("n") == 2).alias("_2"))
        cut = F.when((F.col("_1") > 0) & (F.col("_2") > 0), F.col("_1") / (F.col("_1") + 2 * F.col("_2"))).otherwise(0.5)
        heads = table.groupBy("lang", "before").agg(F.sum("n").alias("_all"), F.count("*").alias("_kinds"))
        # One row per language.
        heads = heads.join(F.broadcast(times.select("lang", cut.alias("_cut"))), "lang").select(
            "lang", "before", "_all", "_cut", (F.col("_cut") * F.col("_kinds") / F.col("_all")).alias("_weight")
        )
        heads = stage(heads, "language-heads")
        rows = table.join(heads, ["lang", "before"])
        if below is None:
            rows = rows.withColumn("_below", F.lit(1 / codes))
        else:
            lower = below.select("lang", F.col("before").alias("_tail"), "last", F.col("p").alias("_below"))
            rows = rows.withColumn("_tail", F.col("before").bitwiseAND(F.lit(int(MASKS[level + 1]))))
            rows = rows.join(lower, ["lang", "_tail", "last"])
        p = F.greatest(F.col("n") - F.col("_cut"), F.lit(0.0)) / F.col("_all") + F.col("_weight") * F.col("_below")
        below = stage(rows.select("lang", "before", "last", p.alias("p")), "language-model")
        grams.append(below.select("lang", F.lit(level).alias("level"), "before", "last", F.log2("p").cast("float").alias("log")))
        weights.append(heads.select("lang", F.lit(level).alias("level"), "before", F.log2("_weight").cast("float").alias("log")))
    return reduce(DataFrame.unionByName, grams), reduce(DataFrame.unionByName, weights)


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, _probe, before, last, n) of all texts of (text, lang, _probe)."""
    counted = map_in_arrow(
        labelled.select("text", "lang", "_probe"), _count, "lang string, _probe boolean, before long, last long, n long"
    )
    return stage(counted.groupBy("lang", "_probe", "before", "last").agg(F.sum("n").alias("n")), "language-grams")


def load_models(grams: DataFrame, weights: DataFrame) -> Models:
    """The smoothed tables as sorted arrays; the driver holds them all, about 12 bytes for every gram of a language."""
    langs = sorted(r.lang for r in grams.select("lang").distinct().collect())
    models = []
    for lang in langs:
        seen, heads = [], []
        found, known = (t.where(F.col("lang") == lang).drop("lang").toArrow() for t in (grams, weights))
        for level in range(ORDER):
            for table, out in ((found, seen), (known, heads)):
                rows = table.filter(pc.equal(table["level"], level))
                keys, logs = rows["before"].to_numpy().astype(U64), rows["log"].to_numpy()
                if table is found:
                    keys = _keys(keys, rows["last"].to_numpy().astype(U64))
                order = np.argsort(keys)
                out.append((keys[order], logs[order]))
        models.append(Model(seen, heads, -float(np.log2(CODES))))
    return Models(langs, models)


def train_models(counts: DataFrame) -> Models:
    """Models from (lang, before, last, n); counts of one gram may be in several rows."""
    whole = counts.groupBy("lang", "before", "last").agg(F.sum("n").alias("n"))
    return load_models(*smooth(stage(whole, "language-counts")))


def _score(batches: Iterator[pa.RecordBatch], shared, kept: list[str]) -> Iterator[pa.RecordBatch]:
    """The kept columns of every row and what the models say of its text."""
    models = shared.value
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            found = _best(batch.column(whole.num_columns - 1).to_pylist(), models)
            columns = [
                pa.array(column, kind)
                for column, kind in zip(zip(*found, strict=True), (pa.string(), pa.float64(), pa.float64(), pa.int64()), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*kept, *_FOUND])


def _text_logs(grams: list[tuple[np.ndarray, np.ndarray]], models: Models) -> np.ndarray:
    """(texts, languages) sums of log probabilities; each different gram is looked up once."""
    before, last = (np.concatenate(x) for x in zip(*grams, strict=True))
    _, first, place = np.unique(_keys(before, last), return_index=True, return_inverse=True)
    logs = np.stack([m.logs(before[first], last[first]) for m in models.models], axis=1)
    ends = np.cumsum([len(x) for _, x in grams])
    return np.stack([logs[place[e - len(x) : e]].sum(axis=0) for e, (_, x) in zip(ends, grams, strict=True)])


def _best(texts: list[str | None], models: Models) -> list[tuple[str, float, float | None, int]]:
    grams = [text_grams(t or "") for t in texts]
    letters = [letter_count(t or "") for t in texts]
    found: list = [(UNDETERMINED, 0.0, None, n) for n in letters]
    judged = [i for i, n in enumerate(letters) if n and models.langs]
    if judged:
        for i, total in zip(judged, _text_logs([grams[i] for i in judged], models), strict=True):
            length = len(grams[i][1])
            bits = -total / length
            k = int(bits.argmin())
            weight = min(length, SCORE_CHARS)
            score = float(1 / np.exp2((bits[k] - bits) * weight).sum())
            found[i] = (models.langs[k], score, float(bits[k]), letters[i])
    return found


def in_training(doc_id: Column) -> Column:
    """Whether a document may be learned from: crc32 of its id modulo 4 is not 2 (NULL id: as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS != HELD_OUT


def score_texts(docs: DataFrame, models: Models, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score``, ``bits`` and ``letters``."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    kept = docs.select(*keep)
    schema = kept.schema.add("lang_pred", "string").add("score", "double").add("bits", "double").add("letters", "long")
    rows = docs.select(*keep, column_or_null(docs, "text", "string").alias("_scored"))
    return map_in_arrow(rows, partial(_score, shared=shared, kept=keep), schema)


def entropy_limits(scored: DataFrame) -> DataFrame:
    """(_lang, _limit): per language the highest cross-entropy that is not rejected.

    From a histogram over the probes, bounded by languages and bins.
    """
    bins = (
        scored.where(F.col("letters") >= MIN_LETTERS)
        .groupBy("lang_pred", F.floor(F.col("bits") * BINS_PER_BIT).alias("_bin"))
        .agg(F.count("*").alias("_n"))
    )
    found: dict[str, list] = {}
    for lang, at, n in bins.collect():
        found.setdefault(lang, []).append((at, n))
    limits = []
    for lang, cells in sorted(found.items()):
        cells.sort()
        ends = np.cumsum([n for _, n in cells])
        high = (cells[int(np.searchsorted(ends, HIGH * ends[-1]))][0] + 1) / BINS_PER_BIT
        limits.append((lang, high + MARGIN_BITS))
    return scored.sparkSession.createDataFrame(limits, "_lang string, _limit double")


def identify_languages(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Documents with ``held_out``, ``lang_pred``, ``score``, ``bits``, ``letters`` and ``rejected``.

    Learns from text and non-null lang of the training fold; neither lang nor source nor
    doc_id is an input of a prediction. ``score`` is the posterior of the chosen
    language. NULL, empty and letterless texts are ``und``, score 0, and rejected, as is every
    text where nothing can be learned. Ties go to the first language by code point. Rows are
    judged one by one; an empty table gives no rows; input columns with a result's
    name are replaced. ``keep`` names the input columns wanted in the result (default: all).
    """
    names = ["held_out", "rejected", *_FOUND, "_scored", "_lang", "_limit"]
    base = replace_columns(docs, names)
    keep = [c for c in (base.columns if keep is None else keep) if c in base.columns]
    trained = in_training(column_or_null(docs, "doc_id", "string"))
    fold = docs.where(trained).select(
        column_or_null(docs, "text", "string").alias("text"),
        column_or_null(docs, "lang", "string").alias("lang"),
        (F.pmod(F.xxhash64(column_or_null(docs, "doc_id", "string"), column_or_null(docs, "text", "string")), F.lit(PROBES)) == 0).alias("_probe"),
    )
    fold = fold.where("text IS NOT NULL AND lang IS NOT NULL")
    counts = count_grams(fold)
    models = train_models(counts)
    limits = entropy_limits(score_texts(fold.where("_probe"), train_models(counts.where("NOT _probe")), []))
    held_out = (~in_training(column_or_null(docs, "doc_id", "string"))).alias("held_out")
    marked = base.select("*", held_out)
    scored = score_texts(marked, models, [*keep, "held_out"])
    # One row per language.
    joined = scored.join(F.broadcast(limits), F.col("lang_pred") == F.col("_lang"), "left")
    odd = (F.col("letters") >= MIN_LETTERS) & F.coalesce(F.col("bits") > F.col("_limit"), F.lit(False))
    return joined.select(
        *keep, "held_out", *_FOUND, ((F.col("lang_pred") == UNDETERMINED) & (F.col("score") == 0) | odd).alias("rejected")
    )
