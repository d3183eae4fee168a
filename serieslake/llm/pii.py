"""Personal data, plain and disguised, with offsets into the source text.

Plain findings are the leftmost non-overlapping matches of each kind. For disguises the text goes
through two transducers that keep, for every character they put out, the span it came from:
look-alike characters become ASCII and invisible ones vanish; then at/dot disguises become @ and .,
and runs of spelled digits become digits. The same detectors run over the normalised text, and
what they find there is mapped back. A finding is added when a disguise was undone inside it and
it reaches beyond every plain finding of its kind; plain findings always stay, also where they
are a part of an added one.

A bare " at " is undone only before a domain with a spelled or bracketed dot: before a plain domain,
as in "john at example.com", prose such as "look at example.com" reads the same.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from serieslake.llm.common import column, text_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits, as the one before takes the whole run.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_OTHER = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_SET:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def plain_spans(text: str) -> dict[str, list[Span]]:
    """The matches of each kind, failing ones dropped without another try."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    if not _DIGIT.search(text):
        return found
    if "." in text:
        found["ip"] = [
            m.span()
            for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())
        ]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _OTHER.sub("", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found["card"].append(m.span())
    if "+" in text:
        found["phone"] = [
            m.span()
            for m in _PHONE.finditer(text)
            if 8 <= len(_OTHER.sub("", m.group())) <= 15
        ]
    return found


# Letters of other scripts that look like Latin ones, by code point, as twins cannot
# be told apart by eye.
_CYRILLIC_SMALL = (
    "\u0430\u0432\u0433\u0435\u0456\u0458\u043a\u043c\u043d\u043e\u0440\u0441\u0455"
    "\u0442\u0443\u0445\u044c\u0475\u04af\u04bb\u04bd\u04cf\u0501\u051b\u051d",
    "abreijkmhopcstyxbvyheldqw",
)
_CYRILLIC_CAPITAL = (
    "\u0410\u0412\u0415\u0406\u0408\u041a\u041c\u041d\u041e\u0420\u0421\u0405\u0422"
    "\u0423\u0425\u0474\u04ae\u04c0\u050c\u051a\u051c",
    "ABEIJKMHOPCSTYXVYIGQW",
)
_GREEK_SMALL = (
    "\u03b1\u03b3\u03b5\u03b7\u03b9\u03ba\u03bd\u03bf\u03c1\u03c3\u03c4\u03c5\u03c7"
    "\u03c9\u03f2\u03f3",
    "ayenikvopotuxwcj",
)
_GREEK_CAPITAL = (
    "\u0391\u0392\u0395\u0396\u0397\u0399\u039a\u039c\u039d\u039f\u03a1\u03a4\u03a5"
    "\u03a7\u03f9\u037f",
    "ABEZHIKMNOPTYXCJ",
)
_OTHERS = (
    "\u0131\u3002\u2024\u2010\u2011\u2012\u2013\u2014\u2212",
    "i..------",
)


def _fixed_pairs() -> dict[str, str]:
    table = {}
    for letters, plain in (_CYRILLIC_SMALL, _CYRILLIC_CAPITAL, _GREEK_SMALL, _GREEK_CAPITAL, _OTHERS):
        assert plain.isascii() and not any(letter.isascii() for letter in letters)
        table.update(zip(letters, plain, strict=True))
    return table


_LOOKS = _fixed_pairs()
_GONE = "­​‌‍⁠﻿"
_SPACES = "             　"


def _look_alikes() -> dict[str, str]:
    """The fixed pairs, and by rule whatever compatibility or digit value makes one ASCII character."""
    table = dict(_LOOKS) | dict.fromkeys(_GONE, "") | dict.fromkeys(_SPACES, " ")
    for code in (*range(0x660, 0x66A), *range(0x6F0, 0x6FA), *range(0x966, 0x970)):
        table[chr(code)] = str(unicodedata.digit(chr(code)))
    ranges = (range(0x2070, 0x209D), range(0x2460, 0x24EA), range(0xFE50, 0xFE6C))
    for code in (c for r in (*ranges, range(0xFF01, 0xFF5F), range(0x1D400, 0x1D800)) for c in r):
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and " " < plain < "\x7f":
            table.setdefault(chr(code), plain)
    return table


_ALIKE = _look_alikes()
# Blocks that hold look-alikes; wider than the table, but quick to search.
_RARE = re.compile(
    "[\u00a0\u00ad\u0131\u0370-\u03ff\u0400-\u052f\u0660-\u06f9\u0966-\u096f\u2000-\u24ea"
    "\u3000-\u3002\ufe50-\uff5e\U0001d400-\U0001d7ff]"
)
_NUMBERS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
_VALUE = {word: str(k) for k, word in enumerate(_NUMBERS)}
_NUMBER = "(?:" + "|".join(_NUMBERS) + ")"
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT = rf"\s*{_OPEN}\s*(?:at|@)\s*{_CLOSE}\s*"
_DOT = rf"\s*{_OPEN}\s*(?:dot|\.)\s*{_CLOSE}\s*"
_LABEL = r"[A-Za-z0-9-]+"
_GAP = r"[\s,-]+"
_REWRITE = re.compile(
    rf"(?P<at>(?<=[A-Za-z0-9_%+-]){_AT}(?=[A-Za-z0-9]))"
    rf"|(?P<dot>(?<=[A-Za-z0-9-]){_DOT}(?=[A-Za-z0-9]))"
    rf"|(?P<bare_at>(?<=[A-Za-z0-9_%+-])\s+at\s+(?={_LABEL}(?:\.{_LABEL})*(?:\s+dot\s+|{_DOT})[A-Za-z0-9]))"
    rf"|(?P<bare_dot>(?<=[A-Za-z0-9-])\s+dot\s+(?=[A-Za-z0-9]))"
    rf"|(?P<run>(?<![A-Za-z0-9])(?:plus{_GAP})?{_NUMBER}(?:{_GAP}{_NUMBER}){{2,}}(?![A-Za-z0-9]))"
    # Shorter runs count beside a dot only.
    rf"|(?P<few>(?<![A-Za-z0-9]){_NUMBER}(?:{_GAP}{_NUMBER})?(?![A-Za-z0-9])(?P<before_dot>(?=\s+dot\s|{_DOT}))?)",
    re.IGNORECASE,
)
_REWRITES = ("at", "dot", "bare_at", "bare_dot", "run", "few")
_WORDS = re.compile(rf"plus|{_NUMBER}", re.IGNORECASE)
_SPELLED = re.compile(rf"\b{_NUMBER}{_GAP}{_NUMBER}{_GAP}{_NUMBER}\b", re.IGNORECASE)
_BARE_DOT = re.compile(r"\sdot\s")
_INSIDE = tuple(f" {word} " for word in _NUMBERS)
_BRACKETED = re.compile(rf"{_OPEN}\s*(?:at|dot|@|\.)\s*{_CLOSE}", re.IGNORECASE)


def _disguised(text: str) -> bool:
    """Whether a disguise may be there: cheap tests first, as almost no text has one."""
    if not text.isascii() and _RARE.search(text):
        return True
    lower = text.lower().replace("-", " ").replace(",", " ").replace("\n", " ").replace("\t", " ").replace("\r", " ")
    if "dot" in lower and _BARE_DOT.search(lower) or any(mark in lower for mark in "[({<") and _BRACKETED.search(text):
        return True
    # The middle word of a run of spelled digits stands between white space, commas or hyphens.
    return any(word in lower for word in _INSIDE) and _SPELLED.search(text) is not None


def normalise(text: str) -> tuple[str, list[int], list[int]]:
    """The text without disguises, and for each of its characters the source span."""
    letters, starts, ends = [], [], []
    for k, letter in enumerate(text):
        plain = _ALIKE.get(letter, letter)
        if plain:
            letters.append(plain)
            starts.append(k)
            ends.append(k + 1)
    first = "".join(letters)
    out, begin, finish, at = [], [], [], 0

    def keep(until: int) -> None:
        out.append(first[at:until])
        begin.extend(starts[at:until])
        finish.extend(ends[at:until])

    after_dot = -1
    for m in _REWRITE.finditer(first):
        kind = next(name for name in _REWRITES if m[name] is not None)
        if kind == "few" and m["before_dot"] is None and after_dot != m.start():
            continue
        keep(m.start())
        if kind in ("run", "few"):
            for word in _WORDS.finditer(m.group()):
                spelled = word.group().lower()
                out.append("+" if spelled == "plus" else _VALUE[spelled])
                begin.append(starts[m.start() + word.start()])
                finish.append(ends[m.start() + word.end() - 1])
        else:
            out.append("@" if kind.endswith("at") else ".")
            after_dot = m.end() if kind.endswith("dot") else -1
            begin.append(starts[m.start()])
            finish.append(ends[m.end() - 1])
        at = m.end()
    keep(len(first))
    return "".join(out), begin, finish


def find_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain spans, and all spans, by kind and in order of start. Code points, end exclusive."""
    plain = plain_spans(text)
    everything = {kind: list(spans) for kind, spans in plain.items()}
    if not _disguised(text):
        return plain, everything
    cleared, begin, finish = normalise(text)
    if cleared == text:
        return plain, everything
    for kind, spans in plain_spans(cleared).items():
        for start, end in spans:
            source = begin[start], finish[end - 1]
            if text[source[0] : source[1]] == cleared[start:end]:
                continue
            if not any(s <= source[0] and source[1] <= e for s, e in plain[kind]):
                everything[kind].append(source)
        everything[kind].sort()
    return plain, everything


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in spans[kind])


def find_personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone (all spans), base_sha256
    (of the plain spans), spans (all, as kind:start:end by kind, then start).

    Null and empty texts have no spans; null and repeated ids stay as they are.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {kind: [] for kind in KINDS}
            digests, texts = [], []
            for value in batch.column(1):
                plain, everything = find_spans(value.as_py() or "")
                for kind in KINDS:
                    counts[kind].append(len(everything[kind]))
                digests.append(hashlib.sha256(joined(plain).encode()).hexdigest())
                texts.append(joined(everything))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(counts[kind], pa.int64()) for kind in KINDS],
                    pa.array(digests, pa.string()),
                    pa.array(texts, pa.string()),
                ],
                ["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"],
            )

    slim = docs.select(column(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    kind = dict(slim.dtypes)["doc_id"]
    counts = ", ".join(f"n_{name} long" for name in KINDS)
    return slim.mapInArrow(search, f"doc_id {kind}, {counts}, base_sha256 string, spans string")
