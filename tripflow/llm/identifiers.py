"""Personal identifiers in texts, plain ones and disguised ones, as spans of the source text.

Plain identifiers match the base patterns. Disguised ones are found by rewriting a text step by step:
look-alike characters, entities, bracketed or spelled "at" and "dot", spelled digits. Every step
replaces pieces and remembers where they came from, so a span of the rewritten text leads
back to the characters that it was made of. The rewritten text is then searched for the same kinds.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache, partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tripflow.llm.common import column_or_null, map_in_arrow, replace_columns

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# Letters that look like an ASCII letter, each before the letter it looks like.
LOOK_ALIKES = (
    "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ѵv "
    "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS "
    "αa οo νv ρp ιi υu κk ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM "
    "ΝN ΟO ΡP ΤT ΥY ΧX ıi ɡg ․. 。. ｡."
)
# Zero to nine as words, in English, German, French and Spanish; "oh" is a zero too.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "oh",
)
# Words for the signs, and how often a digit word counts after "double" or "triple".
AT_WORDS = "at arroba arobase"
DOT_WORDS = "dot punto punkt point"
TIMES = {"double": 2, "triple": 3}
# Last labels that tell a domain from words, where nothing but blanks sets the signs off.
LAST_LABELS = frozenset(
    "com org net edu gov mil info biz io app dev eu uk de fr es it nl pt br mx ch pl ru cn jp au ca ie se no dk fi at be "
    "cz gr hu ro tr in za nz ar cl test example invalid".split()
)
WORD_LABELS = frozenset("me de es it in be no se at".split())
# The two signs as entities.
ENTITIES = {"&#64;": "@", "&#x40;": "@", "&commat;": "@", "%40": "@", "&#46;": ".", "&#x2e;": ".", "&period;": "."}

_WORD_SIGNS = dict.fromkeys(AT_WORDS.split(), "@") | dict.fromkeys(DOT_WORDS.split(), ".") | {"@": "@", ".": "."}
_DIGITS = {word: str(k) for line in DIGIT_WORDS for k, word in enumerate(line.split())}


def _any(words: Iterable[str]) -> str:
    return "|".join(sorted(map(re.escape, words), key=len, reverse=True))


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Whole runs of digits are taken, with the three parts that make an address or without.
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of the e-mail pattern, found from their "@" so that long words cost their length only."""
    free = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                free = domain.end()
        at = text.find("@", max(at + 1, free))


def addresses(text: str) -> Iterator[Span]:
    for found in _IP.finditer(text):
        if found[1] and all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in found[0].split(".")):
            yield found.span()


def _luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() < 38:  # 19 digits and the signs between them
            digits = _NOT_DIGIT.sub("", found[0])
            if 16 <= len(digits) <= 19 and _luhn(digits):
                yield found.span()


def phones(text: str) -> Iterator[Span]:
    for found in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", found[0])) <= 15:
            yield found.span()


FINDERS = dict(zip(KINDS, (emails, addresses, cards, phones), strict=True))


def base_spans(text: str) -> dict[str, list[Span]]:
    """The plain identifiers of a text, by kind."""
    return {kind: list(find(text)) for kind, find in FINDERS.items()}


class Rewritten:
    """A text after steps of replacing pieces; its spans lead back to the text before the first step."""

    def __init__(self, text: str):
        self.text = text
        self.changed = False
        self._steps: list[tuple[list[int], list[tuple[int, int, int, int]]]] = []

    def translate(self, table: dict[int, str]) -> None:
        """Exchange single characters, which moves nothing."""
        if table:
            self.text, self.changed = self.text.translate(table), True

    def replace(self, edits: Iterable[tuple[int, int, str]]) -> None:
        """Put new strings in the place of [start, end) pieces, which come in order and don't overlap."""
        parts, known, at, length = [], [], 0, 0
        for start, end, new in edits:
            length += start - at
            parts += [self.text[at:start], new]
            known.append((length, length + len(new), start, end))
            length += len(new)
            at = end
        if known:
            self.text = "".join([*parts, self.text[at:]])
            self.changed = True
            self._steps.append(([k[0] for k in known], known))

    def source(self, start: int, end: int) -> Span:
        """The source characters of [start, end): a replaced piece counts whole."""
        last = end - 1
        for places, known in reversed(self._steps):
            k = bisect_right(places, start) - 1
            if k >= 0:
                _, new_end, piece, after = known[k]
                start = piece if start < new_end else after + start - new_end
            k = bisect_right(places, last) - 1
            if k >= 0:
                _, new_end, _, after = known[k]
                last = after - 1 if last < new_end else after + last - new_end
        return start, last + 1


_ALIKE = {pair[0]: pair[1] for pair in LOOK_ALIKES.split(" ")}


@cache
def plain_character(character: str) -> str:
    """The ASCII character that a character stands for, nothing for an invisible one, else itself."""
    if character < "\x80":
        return character
    if character in _ALIKE:
        return _ALIKE[character]
    kind = unicodedata.category(character)
    if kind == "Cf":
        return ""
    if kind in ("Zs", "Pd"):
        return " " if kind == "Zs" else "-"
    digit = unicodedata.decimal(character, None)
    if digit is not None:
        return str(digit)
    if unicodedata.decomposition(character).startswith(("<wide>", "<narrow>", "<font>", "<circle>", "<small>")):
        plain = unicodedata.normalize("NFKC", character)
        if len(plain) == 1 and "\x20" < plain < "\x7f":
            return plain
    return character


def _plain_characters(text: Rewritten) -> None:
    odd = {c: plain_character(c) for c in set(text.text) if c >= "\x80"}
    text.translate({ord(c): plain for c, plain in odd.items() if plain and plain != c})
    gone = "".join(c for c, plain in odd.items() if not plain)
    if gone:
        text.replace((*m.span(), "") for m in re.finditer(f"[{re.escape(gone)}]+", text.text))


_ENTITY = re.compile(_any(ENTITIES), re.I)
_BRACKETED = re.compile(rf"[\[({{<]\x20?({_any(_WORD_SIGNS)})\x20?[\])}}>]", re.I)


def _entities(text: Rewritten) -> None:
    if "&" in text.text or "%40" in text.text:
        text.replace((*m.span(), ENTITIES[m[0].lower()]) for m in _ENTITY.finditer(text.text))


def _bracketed_signs(text: Rewritten) -> None:
    """"[at]", "( dot )" between letters or digits, with up to two blanks on either side."""

    def found(whole: str) -> Iterator[tuple[int, int, str]]:
        for m in _BRACKETED.finditer(whole):
            start, end = m.span()
            while m.start() - start < 2 and whole[start - 1 : start] == " ":
                start -= 1
            while end - m.end() < 2 and whole[end : end + 1] == " ":
                end += 1
            if start and whole[start - 1].isalnum() and whole[end : end + 1].isalnum():
                yield start, end, _WORD_SIGNS[m[1].lower()]

    text.replace(_apart(found(text.text)))


def _apart(edits: Iterable[tuple[int, int, str]]) -> Iterator[tuple[int, int, str]]:
    free = 0
    for start, end, new in edits:
        if start >= free:
            yield start, end, new
            free = end


_DIGIT_WORD = rf"(?:(?:{_any(TIMES)})\x20)?(?:{_any(_DIGITS)})"
_DIGIT_RUN = re.compile(rf"\b{_DIGIT_WORD}\b(?:(?:,\x20|[\x20-])(?:{_DIGIT_WORD}|[0-9]++)\b)*+", re.I)
_DIGIT_WORDS = re.compile(rf"\b(?:({_any(TIMES)})\x20)?({_any(_DIGITS)})\b|(,\x20)", re.I)
_DOT = rf"(?:\x20(?:{_any(DOT_WORDS.split())})\x20|\.)"
_DIGIT_BEFORE = re.compile(rf"(?:[0-9]|\b{_DIGIT_WORD}){_DOT}$", re.I)
_DIGIT_AFTER = re.compile(rf"{_DOT}(?:[0-9]|{_DIGIT_WORD}\b)", re.I)


def _spelled_digits(text: Rewritten) -> None:
    """Digit words in a row, and up to three on a side of a dot, which become one number; one alone stays a word."""

    def found(whole: str) -> Iterator[tuple[int, int, str]]:
        for run in _DIGIT_RUN.finditer(whole):
            start, end = run.span()
            words = list(_DIGIT_WORDS.finditer(whole, start, end))
            new = [" " if m[3] else _DIGITS[m[2].lower()] * TIMES.get((m[1] or "").lower(), 1) for m in words]
            spelled = sum(map(len, new)) - new.count(" ")
            dotted = _DIGIT_BEFORE.search(whole[max(0, start - 24) : start]) or _DIGIT_AFTER.match(whole, end)
            if dotted and spelled <= 3 and not any(c.isdigit() for c in run[0]):
                yield start, end, "".join(new).replace(" ", "")
            elif spelled > 1:
                yield from ((*m.span(), digit) for m, digit in zip(words, new, strict=True))

    text.replace(found(text.text))


_WORD_DOT = rf"\x20(?:{_any(DOT_WORDS.split())})\x20"
_BARE_DOT = re.compile(rf"{_WORD_DOT}(?=[A-Za-z0-9])", re.I)
_LOOSE_DOT = re.compile(rf"\x20\.\x20(?=(?:{_any(LAST_LABELS)})(?![A-Za-z0-9]))", re.I)
_BARE_AT = re.compile(
    rf"\x20(?:{_any(AT_WORDS.split())}|@)\x20"
    rf"(?=[A-Za-z0-9-]++(?:(?:\.|{_WORD_DOT})[A-Za-z0-9-]++)*?(\.|{_WORD_DOT})({_any(LAST_LABELS)})(?![A-Za-z0-9]))",
    re.I,
)
_GLUED_DOT = re.compile(r"(?<=[a-z0-9])DOT(?=[a-z0-9])")
_GLUED_AT = re.compile(r"(?<=[a-z0-9])AT(?=[a-z0-9-]++(?:\.[a-z0-9-]++)*\.[a-z]{2})")
_PLUS = re.compile(r"\bplus\x20(?=[0-9(])", re.I)


def _bare_signs(text: Rewritten) -> None:
    """Signs set off by blanks or capitals only.

    " at " and " @ " count before a domain with a known last label, which after a plain "." must not be
    a common word; " dot " between letters or digits; "plus" before a digit.
    """
    if " . " in text.text:
        text.replace(_after_word(text.text, _LOOSE_DOT, "."))
    if "DOT" in text.text:
        text.replace((*m.span(), ".") for m in _GLUED_DOT.finditer(text.text))
    if "AT" in text.text:
        text.replace((*m.span(), "@") for m in _GLUED_AT.finditer(text.text))
    lower = text.text.lower()
    if any(f" {word} " in lower for word in (*AT_WORDS.split(), "@")):
        text.replace(_after_word(text.text, _BARE_AT, "@"))
    if any(f" {word} " in lower for word in DOT_WORDS.split()):
        text.replace(_after_word(text.text, _BARE_DOT, "."))
    if "plus " in lower:
        text.replace((*m.span(), "+") for m in _PLUS.finditer(text.text))


def _after_word(whole: str, pattern: re.Pattern, sign: str) -> Iterator[tuple[int, int, str]]:
    for m in pattern.finditer(whole):
        if m.start() and whole[m.start() - 1].isalnum():
            if sign != "@" or m[1] != "." or m[2].lower() not in WORD_LABELS:
                yield *m.span(), sign


STEPS = (_plain_characters, _entities, _bracketed_signs, _spelled_digits, _bare_signs)


def disguised_spans(text: str, plain: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans that only the rewritten text shows, by kind; those inside a plain span of their kind are left out."""
    rewritten = Rewritten(text)
    for step in STEPS:
        step(rewritten)
    if not rewritten.changed:
        return {kind: [] for kind in KINDS}
    added = {}
    for kind, find in FINDERS.items():
        starts = [start for start, _ in plain[kind]]
        added[kind] = []
        for span in find(rewritten.text):
            if kind == "email" and not _is_label(rewritten.text[span[0] : span[1]].rpartition(".")[2]):
                continue
            start, end = rewritten.source(*span)
            k = bisect_right(starts, start) - 1
            if k < 0 or plain[kind][k][1] < end:
                added[kind].append((start, end))
    return added


def _is_label(label: str) -> bool:
    return len(label) >= 2 and label.isalpha()


def span_text(spans: dict[str, list[Span]]) -> str:
    """kind:start:end of all spans, by kind, then place."""
    return ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in sorted(spans[kind]))


def redacted(text: str, spans: dict[str, list[Span]]) -> str:
    """The text with every span, or group of overlapping ones, replaced by the kind of its first."""
    parts, at = [], 0
    for start, end, kind in sorted((start, end, kind) for kind in KINDS for start, end in spans[kind]):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


COUNTS = ("n_email", "n_ip", "n_card", "n_phone", "n_disguised")
STRINGS = ("base_sha256", "spans", "redacted")
_ARROW = [pa.int64()] * len(COUNTS) + [pa.string()] * len(STRINGS)


def _find(batches: Iterator[pa.RecordBatch], redact: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(batch.num_columns - 1):
            text = text.as_py()
            plain = base_spans(text or "")
            added = disguised_spans(text or "", plain)
            every = {kind: plain[kind] + added[kind] for kind in KINDS}
            rows.append(
                (
                    *[len(plain[kind]) for kind in KINDS],
                    sum(map(len, added.values())),
                    sha256(span_text(plain).encode()).hexdigest(),
                    span_text(every),
                    redacted(text, every) if redact and text is not None else None,
                )
            )
        if rows:
            cells = [pa.array(cell, kind) for cell, kind in zip(zip(*rows, strict=True), _ARROW, strict=True)]
            names = [*batch.schema.names[:-1], *COUNTS, *STRINGS]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cells], names=names)


def find_identifiers(docs: DataFrame, *, keep: list[str] | None = None, redact: bool = True) -> DataFrame:
    """The columns ``keep`` (default: all) of all documents, and what their texts hold.

    ``n_email`` to ``n_phone`` count the plain identifiers, ``n_disguised`` the added ones. ``spans`` lists both as
    ``kind:start:end`` in code points, end exclusive; ``base_sha256`` hashes the same list of the plain ones.
    ``redacted`` is the text with all spans replaced (NULL without ``redact``).

    Spans of one kind overlap only where an added one reaches beyond a plain one. A NULL text counts as empty and
    stays NULL in ``redacted``; an empty text has no spans. Whole texts of any length are searched, in time
    that grows with their length. Repeated rows give repeated rows, an empty table none, and nothing depends on
    other rows or on ids. Input columns with a result's name are replaced.
    """
    docs = replace_columns(docs, [*COUNTS, *STRINGS])
    keep = docs.columns if keep is None else [c for c in keep if c in docs.columns]
    sent = docs.select(*keep, column_or_null(docs, "text", "string").alias("_pii_text"))
    added = [*[StructField(c, LongType()) for c in COUNTS], *[StructField(c, StringType()) for c in STRINGS]]
    schema = StructType([*sent.schema.fields[:-1], *added])
    return map_in_arrow(sent, partial(_find, redact=redact), schema)
