"""NULLs, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import uuid
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import fingerprints, language_id, line_dedup, mixing, near_dedup, packing, quality_rules, sharding, suffix_dedup, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the long text of many words is here and goes on with more. " * 4000
ROWS = [
    (1, "the first line of text is here\nand the second\n", "en", "a", 45),
    (1, "the first line of text is here\nand the second\n", "en", "a", 45),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (None, "a text without an id", "en", None, 20),
    (None, None, None, None, None),
    (4, LONG, "en", "b", len(LONG)),
    (5, LONG, "de", "b", len(LONG)),
    (6, " \n\t ", "de", "", 4),
    (7, "\U0001f600 ä́ <|endoftext|> \x00 'LL", "de", "b", 9),
    (2, "another text with the id of a null one", "fr", "c", 38),
]

OPERATORS = {
    "lines": line_dedup.dedup_lines,
    "mix": mixing.mix_sources,
    "near": near_dedup.mark_near_duplicates,
    "edits": fingerprints.compare_with_edits,
    "language": language_id.identify_languages,
    "rules": quality_rules.apply_rules,
    "suffixes": suffix_dedup.remove_repeats,
    "shards": sharding.shard_documents,
}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_are_all_there(odd, name):
    got = OPERATORS[name](odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_and_unusual_columns(odd, name):
    extra = odd.withColumns(
        {
            **{c: F.lit("mine") for c in ("size", "kept", "target", "shard", "n_words", "score", "label", "digest", "key", "runs")},
            "tags": F.array(F.lit("x")),
            "parts": F.struct(F.lit(1).alias("_dk")),
        }
    )
    got = OPERATORS[name](extra)
    assert got.count() == len(ROWS)


def test_columns_of_other_kinds_pass_through(odd):
    with_map = odd.withColumn("attributes", F.create_map(F.lit("k"), F.lit("v")))
    got = sharding.shard_documents(with_map, shards=2).collect()
    assert len(got) == len(ROWS) and got[0].attributes == {"k": "v"}


def test_columns_may_be_missing(spark):
    bare = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id long, text string")
    assert mixing.mix_sources(bare).count() == 2
    assert packing.pack_documents(bare).select("doc_id").distinct().count() == 2
    assert {r.lang_pred for r in language_id.identify_languages(bare).collect()} == {"und"}


def test_empty_texts_keep_a_place(odd):
    near = {(r.doc_id, r.text): r for r in near_dedup.mark_near_duplicates(odd).collect()}
    assert near[(3, "")].component_id == 3 and near[(3, "")].n_shingles == 0
    assert near[(5, LONG)].component_id == 4 and not near[(5, LONG)].kept
    assert near[(None, None)].component_id is None
    language = {(r.doc_id, r.text): r for r in language_id.identify_languages(odd).collect()}
    assert {language[k].lang_pred for k in ((2, None), (3, ""), (6, " \n\t "))} == {"und"}
    rules = {(r.doc_id, r.text): r for r in quality_rules.apply_rules(odd).collect()}
    assert rules[(2, None)].base_failed and rules[(2, None)].n_words == 0
    pieces = packing.pack_documents(odd).where("doc_id = 3").collect()
    assert [(r.start, r.length, r.doc_tokens) for r in pieces] == [(0, 1, 1)]


def test_special_strings_are_ordinary_text(odd):
    pieces = packing.pack_documents(odd).where("doc_id = 7").collect()
    assert sum(r.length for r in pieces) == pieces[0].doc_tokens > 12


@pytest.mark.parametrize(
    "text",
    [
        "<|endoftext|>",
        "one text\n\n<|endoftext|>\n another  <|endoftext|><|endoftext|> x <|endoftext|",
        "  <|endoftext|>   ",
        "\U0001f600 ä́ <|endoftext|> \x00 'LL<|ENDOFTEXT|>",
        "no such token",
        f"a{' ' * 120_000}<|endoftext|> b",
    ],
)
def test_added_tokens_have_the_ids_of_the_vocabulary(spark, text):
    import public_tokenizers
    from tokenizers import Tokenizer

    unmodified = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    expected = unmodified.encode(text, add_special_tokens=False).ids
    assert packing.token_ids(text) == expected
    pieces = packing.pack_documents(spark.createDataFrame([(1, text, "a")], "doc_id long, text string, source string")).collect()
    ids = np.frombuffer(b"".join(r.ids for r in sorted(pieces, key=lambda r: r.start)), "<u4").tolist()
    assert ids == [*expected, 0]


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\u3000"])
def test_very_long_runs_of_white_space(blank):
    run = blank * 1_500_000
    assert len(packing.token_ids(f"x{run}y")) >= 3
    short = f"a {blank * 60}b{blank * 2} c"
    other = packing._blank_encoder(packing.VOCABULARY).encode(short, add_special_tokens=False).ids
    assert packing.token_ids(short) == other


def test_many_deleted_lines_of_a_long_text(spark):
    lines = [f"line number {i} of the text" for i in range(60_000)]
    rows = [(1, "\n".join(lines[:50_000])), (2, "\n".join(lines))]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_deleted == 0 and got[2].n_deleted == 50_000
    assert got[2].text == "\n".join(lines[50_000:])


def test_packing_loses_nothing(odd):
    rows = packing.pack_documents(odd).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 1)
    places = {(r.sequence_id, r.offset) for r in rows}
    assert len(places) == len(rows)


def test_packing_nothing(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_archive_of_nothing_and_of_repeated_rows(spark, tmp_path):
    schema = "page_id long, url string, html string"
    none = warc.write_archive(spark.createDataFrame([], schema), str(tmp_path / uuid.uuid4().hex))
    assert warc.read_archive(spark, none).collect() == []
    pages = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (1, "u", "y"), (None, None, None)], schema)
    again = warc.write_archive(pages, str(tmp_path / uuid.uuid4().hex))
    kinds = Counter(r.record_type for r in warc.read_archive(spark, again).collect())
    assert kinds == {"response": 3, "revisit": 1}


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = docs
    for name, function in corpus_pipeline.STAGES:
        after = function(spark, before, "/root/testdata/sf0.001")
        if name != "packing":
            assert after.columns == docs.columns
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name in ("language_id", "line_dedup"):
            assert after.count() == before.count()
        if name == "near_dedup":
            assert 0.7 * before.count() < after.count() < before.count()
        before = after
    assert before.agg(F.max("length")).first()[0] <= 1024


def test_pipeline_takes_odd_rows(spark, odd):
    before = odd
    for name, function in corpus_pipeline.STAGES:
        before = spark.createDataFrame(function(spark, before, "").collect() or [], before.schema if name != "packing" else function(spark, before, "").schema)
    assert before.count() > 0


def test_pipeline_keeps_one_row_of_each_group(spark):
    words = [f"word{i}" for i in range(60)]
    texts = {c: " ".join(f"{c}{w}" for w in words) for c in "pqrst"}
    near = {c: f"{t} end" for c, t in texts.items()}
    rows = [(None, texts["p"]), (None, near["p"]), (None, texts["p"]), (None, texts["q"])]
    rows += [(7, texts["r"])] * 3 + [(8, texts["s"]), (8, near["s"]), (8, texts["t"]), (9, near["r"])]
    rows += [(3, ""), (3, ""), (None, None), (None, None)]
    table = [(i, t, "en", f"s{k % 2}", k) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(table, SCHEMA).withColumn("attributes", F.create_map(F.lit("k"), F.lit("v")))
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    back = {c: [r for r in got.collect() if r.text and r.text.startswith(c)] for c in "pqrst"}
    assert {c: [r.doc_id for r in rs] for c, rs in back.items()} == {"p": [None], "q": [None], "r": [7], "s": [8], "t": [8]}
    assert got.count() == 5 + 4


def test_pipeline_keeps_the_values_of_other_columns(spark):
    """Columns with the names that stages use for themselves come out as they went in."""
    names = ("deleted", "cuts", "score", "bits", "letters", "rejected", "held_out", "lang_pred", "n_lines", "n_deleted", "size", "copies", "taken", "target", "_row", "_kept", "_scored", "_dk", "_hash")
    rows = [(i, f"some words of text number {i} are here\nand a second line of it", "en", f"s{i % 2}", None) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in names})
    before = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = function(spark, before, "")
        assert before.columns == docs.columns, name
        for row in before.collect():
            assert all(row[c] == f"{c} {row.doc_id}" for c in names), name
    assert before.count() > 0


@pytest.mark.parametrize("text", ["\u0301\u0301", "\u0301 12 \u0308!", "123", "!?", " \u200d "])
def test_texts_without_letters_have_no_language(spark, text):
    rows = [(i, f"some text of words {i} that is learned", "en", None, 0) for i in range(30)] + [(100, text, "en", None, 0)]
    got = {r.doc_id: r for r in language_id.identify_languages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[100].lang_pred, got[100].score, got[100].letters, got[100].rejected) == ("und", 0.0, 0, True)
    assert got[1].lang_pred == "en" and language_id.letter_count("a\u0301\u00e9") == 2


def test_a_language_without_labels_is_rejected(spark):
    """Each language in turn is not learned: its held-out texts are rejected, those of the others are not."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 200")
    for hidden in ("de", "en"):
        known = docs.withColumn("truth", F.col("lang")).withColumn("lang", F.when(F.col("lang") != hidden, F.col("lang")))
        rows = language_id.identify_languages(known, keep=["truth"]).where("held_out").collect()
        gone = [r.rejected for r in rows if r.truth == hidden]
        assert np.mean(gone) > 0.85 and not any(r.rejected for r in rows if r.truth != hidden)
