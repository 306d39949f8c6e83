"""Identifiers: base spans against the patterns, disguises with their source spans, odd rows."""

from __future__ import annotations

import re
import time
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.llm import identifiers

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, found):
    digits = [int(d) for d in found if d.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    text = text or ""
    return {k: [m.span() for m in re.finditer(p, text) if holds(k, m[0])] for k, p in PATTERNS.items()}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.+-12 (0é%_", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert identifiers.base_spans(text) == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4111", " ", "-", "1", "0", "+", "255.", "1.", ".", "a", "@b.c", "(", ")"]), max_size=24).map("".join))
def test_base_spans_of_near_identifiers(text):
    assert identifiers.base_spans(text) == plain(text)


DISGUISED = [
    ("write to john dot smith at mail2 dot example dot com now", "email", "john dot smith at mail2 dot example dot com"),
    ("john [at] example [dot] com", "email", "john [at] example [dot] com"),
    ("or john(at)example(dot)org.", "email", "john(at)example(dot)org"),
    ("joe＠example．com", "email", "joe＠example．com"),
    ("an jоhn@example.com", "email", "jоhn@example.com"),
    ("😀 j​ohn@exam​ple.com", "email", "j​ohn@exam​ple.com"),
    ("johnATexampleDOTcom", "email", "johnATexampleDOTcom"),
    ("john @ example . com", "email", "john @ example . com"),
    ("john&#64;example&period;com", "email", "john&#64;example&period;com"),
    ("ana arroba ejemplo punto es", "email", "ana arroba ejemplo punto es"),
    ("call plus one seven four three five five five three eight two four now", "phone", "plus one seven four three five five five three eight two four"),
    ("+1 five five five, one two three, double four six seven", "phone", "+1 five five five, one two three, double four six seven"),
    ("+１ (743) 555‑3824", "phone", "+１ (743) 555‑3824"),
    ("ip one nine two dot one six eight dot zero dot one ok", "ip", "one nine two dot one six eight dot zero dot one"),
    ("host 192[.]168[.]1[.]10.", "ip", "192[.]168[.]1[.]10"),
    ("card four one one one one one one one one one one one one one one one", "card", "four one one one one one one one one one one one one one one one"),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
]


@pytest.mark.parametrize(("text", "kind", "piece"), DISGUISED)
def test_disguised_spans_are_source_characters(text, kind, piece):
    found = identifiers.disguised_spans(text, identifiers.base_spans(text))
    assert [(k, text[a:b]) for k in found for a, b in found[k]] == [(kind, piece)]


@pytest.mark.parametrize(
    "text",
    [
        "we met at noon.then left",
        "look at home.de la casa",
        "+1 (743) 555-3824 un éeux",
        "write to a.b@example.com. At last, the point is one of two",
        "the one at the top (at) last [dot]",
        "Mr. Dot at the office dot dot",
        "un deux trois, eins zwei drei",
        "5 point 2 of 7 at 10.30",
        "&#64; %40 @ . (at)",
    ],
)
def test_clean_texts_gain_nothing(text):
    assert not any(identifiers.disguised_spans(text, identifiers.base_spans(text)).values())


def test_long_texts_take_time_in_proportion():
    texts = ["a" * 2_000_000, "1" * 2_000_000, "1 " * 1_000_000, "+1" * 1_000_000, "a@" * 1_000_000, "1." * 1_000_000, "five " * 200_000, "five five 5x " * 100_000, "a dot " * 200_000, "a at a.a " * 100_000, "+1" + " " * 2_000_000, " " * 2_000_000, "(at) " * 200_000]
    start = time.perf_counter()
    for text in texts:
        identifiers.disguised_spans(text, identifiers.base_spans(text))
    assert time.perf_counter() - start < 60


def test_query_equals_the_patterns(spark, small):
    from tripflow.llm.queries import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries()["op12_pii"](spark, small).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    total = 0
    for row in got:
        want = plain(texts[row.doc_id])
        named = [f"{k}:{a}:{b}" for k in PATTERNS for a, b in want[k]]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(want[k]) for k in PATTERNS]
        assert row.base_sha256 == sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(filter(None, row.spans.split(",")))
        total += len(named)
    assert total


def test_odd_rows_and_columns(spark):
    text = "to a@b.co or john at example dot com, +1 (743) 555-3824"
    rows = [(1, None), (2, ""), (None, text), (None, text), (3, "x" * 1_000_000 + " a@b.co"), (4, "\x00 a@b.co")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("n_email", "spans", "redacted", "base_sha256", "n_disguised", "_text")
    clashing = table.withColumns({c: F.lit("mine") for c in names} | {"tags": F.create_map(F.lit("k"), F.lit("v"))})
    got = identifiers.find_identifiers(clashing).collect()
    by = {(r.doc_id, r.text): r for r in got}
    assert len(got) == len(rows) and all(r.tags == {"k": "v"} and r._text == "mine" for r in got)
    empty = sha256(b"").hexdigest()
    assert [(by[k].n_email, by[k].spans, by[k].base_sha256, by[k].redacted) for k in rows[:2]] == [(0, "", empty, None), (0, "", empty, "")]
    assert by[rows[2]].redacted == "to [EMAIL] or [EMAIL], [PHONE]"
    assert (by[rows[2]].n_email, by[rows[2]].n_disguised, by[rows[2]].n_phone) == (1, 1, 1)
    assert by[rows[4]].spans == "email:1000001:1000007" and by[rows[5]].spans == "email:2:8"
    assert identifiers.find_identifiers(table.limit(0)).collect() == []
    assert identifiers.find_identifiers(table.select("doc_id")).where("spans = ''").count() == len(rows)


def test_overlapping_spans_are_redacted_once():
    text = "jоhn@example.com!"
    plain_spans = identifiers.base_spans(text)
    added = identifiers.disguised_spans(text, plain_spans)
    every = {k: plain_spans[k] + added[k] for k in plain_spans}
    assert identifiers.span_text(every) == "email:0:16,email:2:16"
    assert identifiers.redacted(text, every) == "[EMAIL]!"
