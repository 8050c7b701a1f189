r"""Personal data with offset-preserving deobfuscation.

Base spans come from the plain text by four rules, leftmost and non-overlapping for each kind. The method adds
spans that disguises hide: transducers rewrite the text in turn - look-alike letters and digits, spelled digits,
at/dot disguises -, the same rules run on the rewritten text, and each span found is mapped back to the source
characters it came from. A rewritten text is a list of segments (start in the new text, start in the source, whether
they run in step), so mapping costs a bisection and texts without disguises cost one scan.

All rules run in time linear in the text: they begin at an anchor (an at, a plus sign, a digit run's start), and what one
anchor's match has passed is not looked at again.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every at sign with the run of local characters before it and the longest domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_SET:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        # Local parts hold no at sign, so the next match begins after this one.
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def find(text: str) -> list[Span]:
    """The four rules on one text; matches that fail their test are dropped without a retry."""
    spans: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                spans.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = re.sub("[^0-9]", "", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                    spans.append(("phone", m.start(), m.end()))
    return spans


class Rewritten:
    """A text made from a source, with the source offset of each of its characters.

    Segments are (start here, start in the source, length here, length in the source); a segment whose lengths are
    equal runs in step, another stands for its whole source piece.
    """

    def __init__(self, text: str, segments: list[tuple[int, int, int, int]]):
        self.text, self.segments, self.starts = text, segments, [s[0] for s in segments]

    def source(self, start: int, end: int) -> tuple[int, int]:
        a, b = self.segments[bisect_right(self.starts, start) - 1], self.segments[bisect_right(self.starts, end - 1) - 1]
        low = a[1] + (start - a[0]) if a[2] == a[3] else a[1]
        high = b[1] + (end - b[0]) if b[2] == b[3] else b[1] + b[3]
        return low, high


def rewrite(text: str, rule, put) -> Rewritten | None:
    """Replace each match by put(match); None means leave it. Returns None if nothing changed."""
    pieces, segments, at, here = [], [], 0, 0

    def add(piece: str, source: int, length: int) -> None:
        nonlocal here
        if piece or length:
            segments.append((here, source, len(piece), length))
            pieces.append(piece)
            here += len(piece)

    changed = False
    for m in rule.finditer(text):
        new = put(m)
        if new is None or new == m[0]:
            continue
        changed = True
        if m.start() > at:
            add(text[at : m.start()], at, m.start() - at)
        if new:
            add(new, m.start(), m.end() - m.start())
        at = m.end()
    if not changed:
        return None
    if at < len(text):
        add(text[at:], at, len(text) - at)
    return Rewritten("".join(pieces), segments) if segments else None


# Look-alikes, each string's characters in the order of the plain ones beside it.
_ALIKE = {
    "АВЕЅІЈКМНОРСТХаеіјорсухԁһѕԛԝ": "ABESIJKMHOPCTXaeijopcyxdhsqw",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανικρστυχγω": "ABEZHIKMNOPTYXoavikpotuxyw",
    "ıɑɡӏүօհոս": "iaglyohnu",
    "․。．﹒·": ".....",
    "﹫＠": "@@",
    "‐‑‒–—−－": "-------",
    "＋": "+",
}
HOMOGLYPHS = {a: b for source, plain in _ALIKE.items() for a, b in zip(source, plain, strict=True)}


def _other_forms() -> dict[str, str]:
    """Characters that Unicode calls a font, width or small form of an ASCII one, and the decimal digits of all scripts."""
    out = {}
    for low, high in ((0xA1, 0x3400), (0xA000, 0xAC00), (0xF900, 0x10000), (0x10400, 0x12000), (0x16A00, 0x16C00), (0x1D400, 0x1D800), (0x1E100, 0x1EA00), (0x1FBF0, 0x1FBFA)):
        for c in map(chr, range(low, high)):
            kind = unicodedata.decomposition(c).split(" ")[0]
            plain = unicodedata.normalize("NFKC", c) if kind in ("<font>", "<wide>", "<narrow>", "<small>") else ""
            if len(plain) == 1 and " " < plain <= "~":
                out[c] = plain
            elif unicodedata.category(c) == "Nd":
                out[c] = str(unicodedata.decimal(c))
    return out


HOMOGLYPHS |= {c: p for c, p in _other_forms().items() if c not in HOMOGLYPHS}
_INVISIBLE = "​‌‍⁠﻿­"
_GLYPH = re.compile("[" + "".join(map(re.escape, HOMOGLYPHS)) + "]+|[" + _INVISIBLE + "]+")
#: The same characters as a set: most texts have none, and the pattern tries them one by one.
_GLYPHS = frozenset("".join(HOMOGLYPHS) + _INVISIBLE)

DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_DIGIT_WORD = "(?:" + "|".join(DIGITS) + ")"
#: Runs of spelled digits and numerals, at least three pieces with at least two spelled ones (see _spelled); "plus" may stand
#: before them and "dot" or "point" between them.
_PIECE = rf"(?:{_DIGIT_WORD}|[0-9]{{1,4}})"
_SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:plus[\x20-]+|\+)?{_PIECE}(?:[\x20,-]+(?:(?:dot|point)[\x20-]+)?{_PIECE}){{2,}}(?![A-Za-z0-9])", re.I)
_SPELLED_PART = re.compile(rf"{_DIGIT_WORD}|[0-9]+|dot|point|plus|\+", re.I)

#: An at or dot in brackets, as word or sign, stands for its sign.
_BRACKETED = re.compile(r"\x20?[\[({<]\x20?(at|dot|point|punkt|punto|@|\.)\x20?[\])}>]\x20?", re.I)
#: Four numbers with dots said between them.
_SAID_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\x20(?:dot|point)\x20[0-9]{1,3}){3}(?![0-9])", re.I)
#: An at sign or a said "at"; what stands after it must be a host, whose dots may be said (see hosts).
_AT = re.compile(r"\x20(?=(?:at|At|AT)\x20)|@")
_HOST = re.compile(r"((?:[A-Za-z0-9-]++(?:\x20(?i:dot)\x20|\.))+)([A-Za-z0-9-]++)")
_SAID_DOT = re.compile(r"\x20dot\x20", re.I)
#: Endings of hosts and words that stand before a plain "at host.ending" without naming a mailbox.
ENDINGS = frozenset("com org net edu gov io co info biz uk us de fr es it nl ch at ru cn jp in br au ca eu dev app example test".split())
ORDINARY = frozenset(
    "a an and are available based be been bought buy click come found go hosted is it listed live look meet me now on online only or order out page posted published read register see sign "
    "shop site start started stop store that the them there this up us visit was we were work working works you".split()
)


def _glyphs(m: re.Match) -> str:
    return "".join(HOMOGLYPHS.get(c, "") for c in m[0])


def _spelled(m: re.Match) -> str:
    put = {"dot": ".", "point": ".", "plus": "+"}
    pieces = [x.lower() for x in _SPELLED_PART.findall(m[0])]
    if sum(x in DIGITS for x in pieces) < 2:
        return None
    return "".join(DIGITS.get(w) or put.get(w, w) for w in pieces)


def _bracketed(m: re.Match) -> str:
    return "@" if m[1].lower() in ("at", "@") else "."


_DOT = re.compile(r"\x20(?:dot|point)\x20", re.I)


def _said_ip(m: re.Match) -> str:
    return _DOT.sub(".", m[0])


class Address:
    """A said address in the shape of a match: [0] is what stands there, put what it stands for."""

    def __init__(self, text: str, start: int, end: int, put: str | None):
        self.text, self.span, self.put = text, (start, end), put

    def start(self) -> int:
        return self.span[0]

    def end(self) -> int:
        return self.span[1]

    def __getitem__(self, _: int) -> str:
        return self.text[self.span[0] : self.span[1]]


def local_start(text: str, at: int, least: int) -> int:
    """Where the name before ``at`` begins: local characters, and more of them before each said dot; not before ``least``."""
    found = start = at
    while True:
        here = start
        while here > least and text[here - 1] in _LOCAL_SET:
            here -= 1
        if here == start:
            return found
        found, start = here, here - 5
        if start <= least or not _SAID_DOT.fullmatch(text, start, here):
            return found


class Addresses:
    """The rule "name at host": the name may have said dots; the host's last dot may be a real one only before a common
    ending. It begins at an at and looks back no further than the match before, so all of it is linear in the text."""

    @staticmethod
    def finditer(text: str) -> Iterator[Address]:
        end = 0
        for at in _AT.finditer(text):
            if at.start() < end:
                continue
            said_at = at[0] == " "
            host = _HOST.match(text, at.start() + (4 if said_at else 1))
            start = local_start(text, at.start(), end) if host else at.start()
            if start == at.start() or (start == end and start and text[start - 1] in _LOCAL_SET):
                continue
            name = text[start : at.start()]
            end = host.end()
            yield Address(text, start, end, said_address(name, said_at, host[1], host[2]))


def said_address(name: str, said_at: bool, host: str, ending: str) -> str | None:
    """The address that is meant, None if these words are none."""
    dots = _DOT.search(host)
    plain = said_at and not dots
    if plain and (ending.lower() not in ENDINGS or name.lower() in ORDINARY):
        return None
    if ending.isdigit() or (not plain and not dots and not _DOT.search(name)):
        return None
    return _DOT.sub(".", name) + "@" + _DOT.sub(".", host) + ending


def _bare(m: Address) -> str | None:
    return m.put


_BRACKET = re.compile(r"[\[({<]\x20?(?:at|dot|point|punkt|punto|@|\.)\x20?[\])}>]", re.I)


def _steps(text: str) -> Iterator[tuple[object, object]]:
    """The transducers after look-alikes, those whose words do not occur left out."""
    lower = text.lower()
    if sum(map(lower.count, DIGITS)) >= 2:
        yield _SPELLED, _spelled
    if _BRACKET.search(text):
        yield _BRACKETED, _bracketed
    if " dot " in lower or " point " in lower:
        yield _SAID_IP, _said_ip
    if " dot " in lower or " at " in lower:
        yield Addresses, _bare


def hidden(text: str) -> list[Span]:
    """Spans that only the rewritten text shows, in source offsets."""
    chain: list[Rewritten] = []
    now = text
    if not text.isascii() and not _GLYPHS.isdisjoint(text):
        new = rewrite(now, _GLYPH, _glyphs)
        if new:
            chain.append(new)
            now = new.text
    for rule, put in _steps(now):
        new = rewrite(now, rule, put)
        if new:
            chain.append(new)
            now = new.text
    if not chain:
        return []
    found = []
    for kind, a, b in find(now):
        for step in reversed(chain):
            a, b = step.source(a, b)
        found.append((kind, a, b))
    return found


def spans_of(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start and then by kind. A hidden span inside a base span of its kind is left out."""
    base = find(text)
    # Base spans of a kind do not overlap, so the last one that begins at or before a hidden span is the one to hold it.
    known = {k: sorted((s, e) for kind, s, e in base if kind == k) for k in KINDS}
    more = []
    for kind, a, b in hidden(text):
        i = bisect_right(known[kind], (a, len(text))) - 1
        if i < 0 or known[kind][i][1] < b:
            more.append((kind, a, b))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(base, key=order), sorted([*base, *more], key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """For each row of docs: doc_id, spans, base, base_sha256 and the number of base spans of each kind.

    spans and base list (kind, start, end) in code points, end exclusive, as text: kind:start:end joined by
    commas, by start and then by kind. n_email, n_ip, n_card and n_phone count base spans, n_hidden those that
    the method adds. A null or empty text has none. A null doc_id stays null, repeated rows give repeated
    results, an empty table gives an empty one. A very long text is scanned whole, in linear time. Other columns are not
    read, whatever their names; nothing is shuffled. Not found: names spelled letter by letter, numbers said as tens or
    hundreds, said addresses whose host has neither a said dot nor a common ending.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1):
                base, all_ = spans_of(t.as_py() or "")
                text = joined(base)
                rows.append((*(sum(s[0] == k for s in base) for k in KINDS), len(all_) - len(base), hashlib.sha256(text.encode()).hexdigest(), text, joined(all_)))
            columns = [list(c) for c in zip(*rows)] if rows else [[] for _ in range(8)]
            kinds = [pa.int64()] * 5 + [pa.string()] * 3
            names = ["n_email", "n_ip", "n_card", "n_phone", "n_hidden", "base_sha256", "base", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", *names])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_hidden long, base_sha256 string, base string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
