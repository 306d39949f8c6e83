"""Operators against plain versions, round trips and held-out labels."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import uuid
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tripflow.llm import fingerprints, line_dedup, mixing, near_dedup, packing, quality_rules, sharding, suffix_dedup, warc
from tripflow.llm.bytestext import shingles, word_hashes
from tripflow.llm.common import row_key
from tripflow.llm.components import connected_components
from tripflow.llm.language_id import identify_languages, kneser_ney, smooth
from tripflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    full = [(i, t, "en", f"s{i % 3}", len(t) if t is not None else None) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n))


def near_copies(rng, count):
    """A group of texts each near its neighbour, some near all, and some others."""
    base = sentence(rng, 120).split()
    rows = []
    for i in range(count):
        if i % 4 == 0:
            base = [w if rng.random() > 0.02 else w + "x" for w in base]
        copy = list(base)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(len(copy))] = "new"
        rows.append((i, " ".join(copy)))
    return rows + [(1000 + i, sentence(rng, 30)) for i in range(20)]


# ---- line dedup


def test_lines_match_plain_version(spark):
    rng = random.Random(1)
    pool = [sentence(rng, rng.choice((1, 3, 25))) for _ in range(12)]
    rows = [(i, "\n".join(rng.choices([*pool, "", "  "], k=rng.randint(0, 9)))) for i in range(60)]
    got = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert {r.doc_id: r.text for r in got} == plain.dedup_lines(rows, line_dedup.WINDOW, line_dedup.LONG_LINE_WORDS)
    assert all(r.n_chars == len(r.text) for r in got)


def test_longer_windows(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.choices("abcd", k=12))) for i in range(25)]
    got = line_dedup.dedup_lines(documents(spark, rows), window=4, long_words=99).collect()
    assert {r.doc_id: r.text for r in got} == plain.dedup_lines(rows, 4, 99)


# ---- mixing


def test_targets_share_the_excess(spark):
    totals = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 90)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(totals).collect()}
    assert got["a"] == 20 and sum(got.values()) == pytest.approx(1.5 * 2100)
    assert all(got[s] <= 2 * n for s, n in (("b", 1000), ("c", 1000), (None, 90)))


def test_mix_comes_near_its_targets(given, spark):
    rows = mixing.mix_sources(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    for _, group in groupby(sorted(rows, key=lambda r: r.source), key=lambda r: r.source):
        group = list(group)
        assert abs(sum(r.taken for r in group) - group[0].target) <= max(r.size for r in group)
        assert all(0 <= r.taken <= 2 * r.size for r in group)


def test_taken_copies_are_rows(given, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    copies = mixing.mix_sources(docs).agg(F.sum("copies")).first()[0]
    mixed = mixing.take_mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == copies


# ---- archive


def test_archive_round_trip(spark, tmp_path):
    rows = [(3, "u3", "<a>ü"), (1, "u1", "<a>ü"), (2, "u2", None), (4, "u4", ""), (5, "u\r\n5", "x"), (None, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc.write_archive(pages, str(tmp_path / uuid.uuid4().hex))
    records = {r.page_id: r for r in warc.read_archive(spark, archive).collect()}
    assert spark.read.parquet(archive.payloads).count() == 3
    for page_id, _, html in rows:
        body = (html or "").encode()
        got = records[page_id]
        assert bytes(got.payload) == body and got.payload_bytes == len(body)
        assert got.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
    assert (records[1].record_type, records[3].record_type, records[3].refers_to) == ("response", "revisit", 1)
    assert (records[2].record_type, records[4].refers_to, records[None].refers_to) == ("response", 2, 5)
    record = bytes(records[1].record)
    assert record.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and record.endswith("\r\n\r\n<a>ü\r\n\r\n".encode())


def test_small_payloads_are_no_revisits(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy")], "page_id long, url string, html string")
    archive = warc.write_archive(pages, str(tmp_path / "small"), min_bytes=3)
    assert {r.record_type for r in warc.read_archive(spark, archive).collect()} == {"response"}


def test_damaged_payload_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "xy")], "page_id long, url string, html string")
    archive = warc.write_archive(pages, str(tmp_path / "good"))
    bad = warc.Archive(archive.headers, str(tmp_path / "bad"))
    spark.read.parquet(archive.payloads).withColumn("payload", F.encode(F.lit("xz"), "UTF-8")).write.parquet(bad.payloads)
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, bad).collect()


def test_fingerprints_are_fewer_than_windows(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(f"line {rng.randrange(10**6)}" for _ in range(50))) for i in range(20)]
    once = documents(spark, rows).select(*row_key(), F.col("text").alias("_text"))
    for window, share in ((2, 0.75), (5, 0.42)):
        places = line_dedup.fingerprint_places(once, window, 20)
        assert 0.5 * share * 20 * 50 < places.count() < share * 20 * (51 - window)
        runs = line_dedup.extended_runs(places, window).select("_dk", "at", "lines").collect()
        assert sorted(map(tuple, runs)) == [(i, k, window) for i in range(20) for k in range(51 - window)]


@pytest.mark.parametrize("window", [2, 3, 5])
def test_runs_of_any_window_equal_the_plain_version(spark, window):
    rng = random.Random(window)
    stock = [f"line {k}" for k in range(6)] + ["", "a long line of words " * 6]
    rows = [(i, "\n".join(rng.choice(stock) for _ in range(rng.randrange(14)))) for i in range(60)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows), window=window).collect()}
    assert got == plain.dedup_lines(rows, window, line_dedup.LONG_LINE_WORDS)


# ---- near duplicates


def test_near_duplicates_match_all_pairs(spark):
    rng = random.Random(4)
    rows = near_copies(rng, 48) + [(2000, "one two"), (2001, "One  TWO"), (2002, ""), (2003, None), (2004, "two")]
    got = near_dedup.mark_near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == plain.near_components(rows)
    assert all(r.n_shingles == len(plain.shingle_set(dict(rows)[r.doc_id], 4)) for r in got)
    assert all(r.kept == (r.component_id == r.doc_id) for r in got)


def test_given_documents_match_all_pairs(given, spark):
    got = QUERIES["op4_near_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.component_id for r in got} == plain.near_components([(i, r.text) for i, r in given.items()])


def template_texts(rng, count):
    """Texts that share a template of 100 words and differ in 8 to 40; some pairs are similar enough."""
    template, endings = sentence(rng, 100), [sentence(rng, 40).split() for _ in range(count // 4)]
    rows = []
    for i in range(count):
        own = list(endings[i % len(endings)])
        for _ in range(rng.choice((0, 2, 6))):
            own[rng.randrange(len(own))] = f"own{i}"
        rows.append((i, f"{template} {' '.join(own[: rng.choice((8, 25, 40, 40))])}"))
    return rows


@pytest.mark.parametrize("seed", [8, 12])
def test_crowded_buckets_lose_no_link(spark, seed):
    rows = template_texts(random.Random(seed), 120) + [(500 + i, t) for i, t in near_copies(random.Random(9), 24)]
    got = near_dedup.mark_near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == plain.near_components(rows)


def test_all_pairs_of_a_crowd_meet_in_rarest_shingles(spark):
    """With every text a component of its own, every similar pair is found, and few of the others."""
    rows = template_texts(random.Random(10), 100)
    docs = documents(spark, rows)
    signed = near_dedup.signatures(docs).dropDuplicates(["digest"])
    members = signed.withColumn("key", F.lit(1)).withColumn("label", F.col("digest"))
    texts = signed.join(docs.select(F.col("doc_id").alias("_dk"), "text"), "_dk").select("digest", "text")
    found = near_dedup._prefix_pairs(members, texts, 4, 80)
    links = {tuple(r) for r in near_dedup.verify_pairs(found, texts, 4, 80).select(F.hex("a"), F.hex("b")).collect()}
    sets = {r.digest.hex().upper(): plain.shingle_set(r.text, 4) for r in texts.collect()}
    for a in sets:
        for b in sets:
            if a < b:
                common = len(sets[a] & sets[b])
                assert ((a, b) in links) == (100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common))


def test_similar_sets_share_a_rarest_item_with_room_behind_it():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 9, near_dedup.RARITY_CELLS)
    for _ in range(300):
        pool = np.unique(rng.integers(0, 2**63, 40, dtype=np.uint64))
        a, b = (pool[rng.random(len(pool)) < 0.93] for _ in "ab")
        if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)):
            first, other = (near_dedup.rarest_items(x, counts, 80).tolist() for x in (a, b))
            key = next(x for x in first if x in other)
            assert 180 * min(len(a) - first.index(key), len(b) - other.index(key)) >= 80 * (len(a) + len(b))


def test_words_are_hashed_alike_in_pieces():
    text = ("Über  äa\tB c\n" * 50).encode()
    data = np.frombuffer(text, np.uint8)
    assert (word_hashes(data) == word_hashes(data, limit=7)).all() and len(word_hashes(data)) == 200
    assert len(shingles(word_hashes(data), 4)) == 4


def test_sketch_distance_follows_similarity():
    rng = np.random.default_rng(0)
    items = rng.integers(0, 2**63, 1000).astype(np.uint64)
    near = np.concatenate((items[:900], rng.integers(0, 2**63, 100).astype(np.uint64)))
    far = rng.integers(0, 2**63, 1000).astype(np.uint64)
    samples = np.stack([near_dedup.min_samples(x) for x in (items, near, far)])
    words = near_dedup.odd_sketches(samples)

    def distance(a, b):
        return sum(int(x).bit_count() for x in (words[a] ^ words[b]).view(np.uint64))

    assert distance(0, 0) == 0 and distance(0, 1) <= near_dedup.MOST_BITS < distance(0, 2)


def test_whole_sketch_never_differs_in_more_bits_than_items():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 2**63, 300).astype(np.uint64)
    for other in (1, 20, 80):
        near = np.concatenate((items[other:], rng.integers(0, 2**63, other).astype(np.uint64)))
        bits = near_dedup.whole_sketch(items) ^ near_dedup.whole_sketch(near)
        assert other < sum(int(x).bit_count() for x in bits.view(np.uint64)) + other <= 3 * other


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# ---- fingerprints


def test_edits_follow_the_next_document(given, spark):
    got = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, "/root/testdata/sf0.001").collect()}
    ids = sorted(given, reverse=True)
    assert sorted(got, reverse=True) == ids
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text, other = given[i].text, given[after].text
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    assert np.mean([r.near_edited for r in got.values()]) > 0.5 > 0.1 > np.mean([r.near_next for r in got.values()])
    by_text = {}
    for i, r in given.items():
        assert by_text.setdefault(r.text, got[i].fingerprint) == got[i].fingerprint


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    rows = [(i * i, f"text {i}. " * 9) for i in range(40)]
    got = {r.doc_id: r for r in fingerprints.compare_with_edits(documents(spark, rows)).collect()}
    texts = dict(rows)
    ids = sorted(texts, reverse=True)
    assert len(got) == 40
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        third = len(texts[i]) // 3
        edited = texts[i][: len(texts[i]) - third] + texts[after][:third]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def pieces(text):
    """Plain cut of a text: the k-th equal piece counts on its own."""
    seen, out = {}, set()
    for piece in re.findall(r"[^\n.!?]{1,48}[\n.!?]*|[\n.!?]+", text):
        seen[piece] = seen.get(piece, 0) + 1
        out.add((piece, seen[piece]))
    return out


def like(a, b):
    x, y = pieces(a), pieces(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def test_likeness_is_that_of_the_digest_sets(given, spark):
    got = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, "/root/testdata/sf0.001").collect()}
    ids = sorted(given, reverse=True)
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text, other = given[i].text, given[after].text
        third = len(text) // 3
        assert got[i].near_edited == pytest.approx(like(text, text[: len(text) - third] + other[:third]))
        assert got[i].near_next == pytest.approx(like(text, other))
        assert int(got[i].fingerprint.partition(":")[0], 16) == len(pieces(text))


ODD_TEXTS = ["", "\n", "...a", "a" * 48, "a" * 48 + ".", "a" * 100 + "!?\n\nb", "ä." * 70, "😀" * 97 + "\n\r.", ". . .", "x.y.x.y.x."]


def test_pieces_of_odd_texts(monkeypatch):
    longer = ["".join(ODD_TEXTS) * 40, "?" * 5000 + "b" * 3000, "c" * 9000, "d.\n" * 3000]
    want = [sorted(p for p, _ in pieces(t)) for t in ODD_TEXTS + longer]
    monkeypatch.setattr(fingerprints, "_BLOCK_CHARS", 700)
    texts = ODD_TEXTS + longer
    sketches = fingerprints.Sketches(texts)
    assert sketches.counts.tolist() == [len(w) for w in want]
    for a in range(len(texts)):
        for b in range(len(texts)):
            found = sketches.likeness(np.array([a]), np.array([b]))
            assert found[0] == pytest.approx(like(texts[a], texts[b]))


def test_published_tables_hold_small_differences():
    """What two fingerprints give by themselves, and that larger differences don't fit."""
    words = [f"word{i}." for i in range(200)]
    texts = [" ".join(words)] + [" ".join([*words[:i], "x" + words[i], *words[i + 1 :]]) for i in range(1, 60)] + [" ".join(words[90:])]
    sketches = fingerprints.Sketches(texts)
    others = np.arange(1, len(texts))
    peeled = fingerprints.peel(sketches.differences(np.zeros(len(others), int), others, fingerprints.CELLS), fingerprints.CELLS)
    assert set(peeled[:-1]) <= {2, -1} and (peeled[:-1] == 2).mean() > 0.9 and peeled[-1] == -1
    assert sketches.likeness(np.zeros(len(others), int), others) == pytest.approx([like(texts[0], t) for t in texts[1:]])


def test_peeling_recovers_the_difference():
    rng = np.random.default_rng(5)
    shared = rng.integers(0, 2**63, 500).astype(np.uint64)
    left = np.concatenate((shared, rng.integers(0, 2**63, 30).astype(np.uint64)))
    right = np.concatenate((shared, rng.integers(0, 2**63, 10).astype(np.uint64)))
    tables = np.zeros((2, 3, 192), np.uint64)
    for table, items in zip(tables, (left, right), strict=True):
        fingerprints.add_items(table, np.zeros(len(items), int), items, 192)
    assert fingerprints.peel(tables[0] - tables[1], 192).tolist() == [40]


def test_hot_and_extreme_ids_keep_their_order(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 4)
    rows = [(None, f"null {i}. " * 9) for i in range(30)] + [(7, f"hot {i}") for i in range(25)]
    rows += [(-(2**63), "least"), (2**63 - 1, "most"), (-(2**63), "least too"), (0, "zero"), (7, "hot 1"), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.compare_with_edits(table.repartition(3)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    edits = {(r.doc_id, r.edited_sha256) for r in got}

    def edited(text, after):
        third = len(text) // 3
        return hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest()

    # Where both neighbours are alone with their ids, the next document is known.
    assert (0, edited("zero", "least")) in edits or (0, edited("zero", "least too")) in edits
    assert any((2**63 - 1, edited("most", t)) in edits for i, t in rows if i == 7)
    lasts = {edited(a, b or "") for a in ("least", "least too") for i, b in rows if i is None}
    assert sum(r.doc_id == -(2**63) and r.edited_sha256 in lasts for r in got) >= 1
    again = fingerprints.compare_with_edits(table).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


# ---- languages


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify_languages(docs, keep=["doc_id", "lang"]).collect()
    held_out = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held_out} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang == r.lang_pred for r in held_out]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows) and not any(r.rejected for r in rows)


def test_labels_outside_the_fold_are_not_learned(spark):
    rows = [(i, "abab ab abba " * 5, "x", None, 0) for i in range(40)]
    rows = [(i, t, "secret" if zlib.crc32(str(i).encode()) % 4 == 2 else "x", s, n) for i, t, _, s, n in rows]
    assert {r.lang_pred for r in identify_languages(spark.createDataFrame(rows, SCHEMA)).collect()} == {"x"}


def test_noise_is_rejected(spark):
    rng = random.Random(7)
    rows = [(i, sentence(rng, 60), "x", None, 0) for i in range(60)]
    rows.append((100, "".join(rng.choices("qwyzxvjkmp ", k=400)), None, None, 0))
    got = {r.doc_id: r.rejected for r in identify_languages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got.pop(100) and not any(got.values())


def test_probabilities_sum_to_one():
    counts = np.random.default_rng(3).poisson(0.02, 32**4)
    full, below, _ = kneser_ney(counts)
    assert np.exp2(full).reshape(-1, 32).sum(1) == pytest.approx(1)
    assert np.exp2(below).reshape(-1, 32).sum(1) == pytest.approx(1)


def test_characters_outside_a_to_z_tell_languages_apart(spark):
    """Pairs of languages with the same words but for letters 5, 10, ... code points apart."""
    rng = random.Random(11)
    stocks = {
        "latin": ("abdeghéñ", "abdeghäö"),
        "cyrillic": ("абвгдежз", "жзийклмн"),
        "han": ("一丁丂七丄", "丏丐丑丒专"),
    }
    rows = []
    for script, pair in stocks.items():
        words = [[rng.randrange(len(pair[0])) for _ in range(rng.randint(2, 6))] for _ in range(40)]
        for side, letters in enumerate(pair):
            for _ in range(40):
                text = " ".join("".join(letters[k] for k in rng.choice(words)) for _ in range(12))
                rows.append((len(rows), text, f"{script}{side}", None, 0))
    got = [r for r in identify_languages(spark.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    assert len(got) > 40 and np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert not any(r.rejected for r in got)


def test_smoothing_matches_plain_version(spark):
    counts = np.random.default_rng(5).poisson(0.002, 32**4)
    full, below, weight = kneser_ney(counts)
    rows = []
    for gram in np.flatnonzero(counts):
        a, b, c, last = (int(gram) >> k & 31 for k in (15, 10, 5, 0))
        rows.append(("x", a << 42 | b << 21 | c, last, int(counts[gram])))
    grams, weights = smooth(spark.createDataFrame(rows, "lang string, before long, last long, n long"), codes=32)

    def number(before):
        return (before >> 42) << 10 | (before >> 21 & 31) << 5 | before & 31

    found = {(r.before, r.last): r.log for r in grams.where("level = 0").collect()}
    assert len(found) == len(rows)
    assert all(v == pytest.approx(full[number(h) << 5 | last], abs=1e-4) for (h, last), v in found.items())
    three = grams.where("level = 1").collect()
    assert three and all(r.log == pytest.approx(below[number(r.before) << 5 | r.last], abs=1e-4) for r in three)
    assert all(r.log == pytest.approx(weight[number(r.before)], abs=1e-4) for r in weights.where("level = 0").collect())


# ---- quality rules


def test_repeated_words_match_plain_version(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randint(0, 12)))) for i in range(80)]
    rows += [(100, "x y z " * 400), (101, "\v a\r\nb\x1cc d "), (102, sentence(rng, 3000))]
    got = {r.doc_id: r for r in quality_rules.apply_rules(documents(spark, rows)).collect()}
    for i, text in rows:
        assert got[i].n_repeat_words == plain.repeat_words(text)
        assert got[i].n_words == len(plain.words(text))
        assert got[i].word_chars == sum(map(len, plain.words(text)))


def test_labelled_documents_are_judged_rightly(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    judged = quality_rules.apply_rules(docs).join(labels, "doc_id").where("NOT base_failed")
    good, bad = (judged.where(f"quality = {q}").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.99 and bad < 0.1


# ---- suffix arrays


@pytest.mark.parametrize(("most", "length", "width"), [(10**6, 12, 5), (1, 12, 5), (3, 8, 8), (10**6, 9, 2)])
def test_repeats_match_plain_version(spark, most, length, width):
    rng = random.Random(length + most)
    shared = ["".join(rng.choices("abü", k=40)) for _ in range(4)]
    rows = [(i, "".join(rng.choice((sentence(rng, 3), rng.choice(shared)[: rng.randint(3, 40)])) for _ in range(4))) for i in range(40)]
    rows += [(50, "a" * 100), (51, "ab" * 20), (52, None), (53, ""), (54, rows[0][1])]
    got = suffix_dedup.remove_repeats(documents(spark, rows), length=length, width=width, most=most).collect()
    expected = plain.repeated_bytes(rows, length)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected
    assert all(hashlib.sha256(r.kept_bytes).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize(("text", "most_rows"), [(b" " * 50_000, 25), (b"ab" * 25_000, 25), (b"x" * 300, 1)])
def test_a_long_run_has_few_anchors(text, most_rows):
    data = np.frombuffer(text, np.uint8)
    of, low, high, again = suffix_dedup.anchors(data, 200, 48)
    assert len(of) <= most_rows and again.all()
    assert low[0] == 0 and high[-1] == len(text) - 200 and (low[1:] == high[:-1] + 1).all()


def test_equal_strings_have_one_anchor():
    rng = random.Random(4)
    shared = bytes(rng.choices(range(97, 100), k=90))
    texts = [bytes(rng.choices(range(97, 100), k=50)) + shared + b"c" * 70 + shared[:k] for k in (20, 40, 90)]
    names = {}
    for text in texts:
        of, low, high, _ = suffix_dedup.anchors(np.frombuffer(text, np.uint8), 30, 6)
        for anchor, a, b in zip(of.tolist(), low.tolist(), high.tolist(), strict=True):
            for start in range(a, b + 1):
                assert names.setdefault(text[start : start + 30], anchor) == anchor


def test_a_passage_in_many_surroundings_is_taken_apart(spark):
    """One boilerplate line holds an anchor with more segments than an array may have."""
    rng = random.Random(5)
    line = "".join(rng.choices("abcdef", k=60))
    rows = [(i, "".join(rng.choices("abcdef", k=30)) + line + "".join(rng.choices("abcdef", k=30))) for i in range(80)]
    rows += [(100 + i, rows[i][1][7:]) for i in range(5)] + [(200, " " * 3000), (201, line[:50] + " " * 2500)]
    got = suffix_dedup.remove_repeats(documents(spark, rows), length=64, width=16, most=20).collect()
    expected = plain.repeated_bytes(rows, 64)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected


def test_given_documents_lose_their_repeats(given, spark):
    got = QUERIES["op8_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()
    expected = plain.repeated_bytes([(i, r.text) for i, r in given.items()], 200)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected


@pytest.mark.parametrize("letters", ["ab", "a", "abcdefgh"])
def test_suffix_order(letters):
    rng = random.Random(9)
    text = np.array([ord(c) for c in rng.choices(letters, k=300)] + [0])
    order = suffix_dedup.two_stage_suffix_array(text, 301).tolist()
    assert order == sorted(range(301), key=lambda i: text[i:].tolist())
    common = suffix_dedup.adjacent_common_prefixes(text, np.array(order), 5)
    for k in range(1, 301):
        a, b = (text[p : p + 5].tolist() for p in (order[k - 1], order[k]))
        assert (common[k] == 5) == (a == b and len(a) == 5)


# ---- sharding


def test_shards_hold_every_row_once(given, spark):
    rows = QUERIES["op9_sharding"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in rows) == sorted(given)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        text = given[r.doc_id].text.encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
    assert len(slots) == 40 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(s) for s in slots.values()]
    assert max(counts) - min(counts) <= 1


def test_a_rerun_shuffles_alike_and_a_seed_differently(given, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

    def order(seed):
        rows = sharding.shard_documents(docs, shards=3, seed=seed).collect()
        return [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]

    assert order(1) == order(1) != order(2)
    assert order(1) != sorted(given)


def test_shards_are_written(spark, tmp_path):
    docs = documents(spark, [(i, "t" * i) for i in range(25)])
    sharding.write_shards(sharding.shard_documents(docs, shards=4), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 25 and back.select("shard").distinct().count() == 4


# ---- packing


def test_pieces_put_together_are_the_documents(given, spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = sorted(packing.pack_documents(docs).collect(), key=lambda r: (r.doc_id, r.start))
    for doc_id, group in groupby(pieces, key=lambda r: r.doc_id):
        group = list(group)
        ids = np.frombuffer(b"".join(r.ids for r in group), "<u4").tolist()
        assert ids == [*tokenizer.encode(given[doc_id].text, add_special_tokens=False).ids, 0]
        assert [r.start for r in group] == np.cumsum([0, *[r.length for r in group[:-1]]]).tolist()
        assert all(r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(r.ids) for r in group)
    by_window = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    lengths = []
    for _, group in groupby(by_window, key=lambda r: r.sequence_id):
        end = 0
        for r in group:
            assert r.offset == end
            end += r.length
        lengths.append(end)
    assert set(lengths[:-1]) == {1024} and 0 < lengths[-1] <= 1024


def dealt(deal, totals, step, window=1024):
    """Tokens by window and source, and the documents' pieces, which fill every place once."""
    places, mixture, pieces = [], {}, []
    for source, total in totals.items():
        first = np.arange(0, total, step)
        n = np.minimum(first + step, total) - first
        row, start, length, place = deal.pieces(source, first, n, window)
        assert np.bincount(row, length, len(first)).astype(int).tolist() == n.tolist()
        assert (place // window == (place + length - 1) // window).all()
        places += list(zip(place.tolist(), length.tolist(), strict=True))
        pieces += list(zip([source] * len(row), row.tolist(), start.tolist(), place.tolist(), strict=True))
        for w, k in zip((place // window).tolist(), length.tolist(), strict=True):
            mixture.setdefault(w, {}).setdefault(source, 0)
            mixture[w][source] += k
    end = 0
    for place, length in sorted(places):
        assert place == end
        end += length
    assert end == sum(totals.values())
    return mixture, pieces


def test_every_window_has_the_mixture():
    totals = {"a": 700_000, "b": 200_000, "c": 90_000, "d": 10_000, "e": 5}
    mixture, _ = dealt(packing.Deal.of(totals, packing.QUANTUM), totals, 777)
    served = dict.fromkeys(totals, 0)
    for w in range(sum(totals.values()) // 1024 - 1):
        for s, total in totals.items():
            due = 1024 * total / sum(totals.values())
            assert abs(mixture[w].get(s, 0) - due) <= 3 * packing.QUANTUM
            served[s] += mixture[w].get(s, 0)
            # The deficit is carried on, it does not add up.
            assert abs(served[s] - (w + 1) * due) <= 3 * packing.QUANTUM


def test_windows_follow_given_proportions_until_a_source_ends():
    totals = {"a": 40_000, "b": 100_000, "c": 9_000, "d": 3_000}
    mixture, _ = dealt(packing.Deal.of(totals, 4, {"a": 0.5, "b": 0.25, "c": 0.25, "x": 3}), totals, 500)
    ends = 9_000 * 4 // 1024
    assert all(abs(mixture[w][s] - n) <= 12 for w in range(ends) for s, n in (("a", 512), ("b", 256), ("c", 256)))
    assert all("d" not in mixture[w] for w in range(ends))
    # c has ended, a and b go on two to one; then b; then d.
    later = range(ends + 2, (9_000 + 40_000 + 20_000) // 1024 - 1)
    assert all(abs(mixture[w]["a"] - 683) <= 12 and set(mixture[w]) == {"a", "b"} for w in later)
    assert set(mixture[max(mixture)]) == {"d"}


def test_places_are_exact_beyond_products_of_64_bits(monkeypatch):
    totals = {"a": 5_003, "b": 40_000, "c": 777, "d": 1}
    expected = dealt(packing.Deal.of(totals, 4), totals, 90)
    monkeypatch.setattr(packing.Phase, "whole", lambda self, values: values.astype(object))
    assert dealt(packing.Deal.of(totals, 4), totals, 90) == expected
    monkeypatch.undo()
    vast = {f"s{k}": 10**13 + k * 10**11 for k in range(20)}
    deal = packing.Deal.of(vast, 4)
    _, start, length, place = deal.pieces("s3", np.array([5 * 10**12]), np.array([5_000]), 1024)
    assert length.sum() == 5_000 and start.tolist() == np.cumsum([0, *length[:-1]]).tolist()
    assert (np.diff(place // 1024) == 1).all() and abs(place[0] / (5 * 10**12) - sum(vast.values()) / vast["s3"]) < 1e-6


def test_documents_are_packed_in_given_proportions(spark):
    rows = [(i, f"word {i} " * (20 + i % 7), "ab"[i % 2] if i % 5 else None) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack_documents(docs, window=128, shares={"a": 1, "b": 2, None: 1}).collect()
    source = {i: s for i, _, s in rows}
    mixture = {}
    for r in pieces:
        mixture.setdefault(r.sequence_id, Counter())[source[r.doc_id]] += r.length
    both = {s: sum(r.length for r in pieces if source[r.doc_id] == s) for s in ("a", "b", None)}
    ends = int(min(both["a"], both["b"] / 2, both[None]) * 4 // 128)
    assert ends > 50
    assert all(abs(mixture[w]["b"] - 64) <= 8 and abs(mixture[w][None] - 32) <= 8 for w in range(ends))
    assert sum(both.values()) == sum(packing.pack_documents(docs, window=128).select("length").toPandas()["length"])
