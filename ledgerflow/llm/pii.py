"""Personal data, plain and disguised, with spans in the source text.

Plain kinds are matched in the text as it stands. Disguised ones are found on a
normalised copy made by a chain of transducers, each a rewriting of characters that keeps,
for every character it puts out, the source span it came from:

1. homoglyphs: look-alike letters, digits and signs of other scripts or widths become
   ASCII, invisible characters go;
2. at/dot disguises: ``(at)``, ``[dot]``, ``name at host dot tld`` become ``@`` and ``.``, in
   any mix of signs, brackets and words, also in the local part (up to four ``dot`` words). The
   bare word ``at`` counts only where a dot of the host is disguised too: ``look at
   example.com`` is ordinary text;
3. spelled digits: runs of four or more number words ("five five five ...", "oh", "double
   seven") become digits. Shorter runs stay words, also between digits.

The same detectors run on the normalised copy and each span found goes back to source
characters through the map. Only stretches around something that was rewritten are
normalised and searched, so plain text costs one scan. Plain spans stay as they are. A
span from the normalised copy is added unless it equals or lies inside a plain span of any
kind; one that reaches beyond plain spans stands beside them, and masking covers the union.

All detectors take time in proportion to the text, whatever it holds. Null and empty
texts have no spans; repeated rows are handled each for itself; extra columns are ignored
by ``detect`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import texts

#: Kinds in the order in which spans with equal starts are listed (fixed values).
KINDS = ["email", "ip", "card", "phone"]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[^0-9]+")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if k % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def emails(t: str) -> Iterator[Span]:
    """Leftmost matches: for each ``@``, the characters before it that a local part may have
    (not before an earlier ``@`` or match), and a domain of two parts or more behind it."""
    end, at = 0, t.find("@")
    while at >= 0:
        before = t[end:at]
        start = end + len(before.rstrip(_LOCAL))
        m = _DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, m.end(), "email"
        end = m.end() if m else at + 1
        at = t.find("@", end)


def ips(t: str) -> Iterator[Span]:
    """Runs of dotted numbers, four at a time from the left."""
    for m in _DOTTED.finditer(t):
        if m.group().count(".") < 3:
            continue
        at = m.start()
        parts = m.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k: k + 4]
            size = sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in four):
                yield at, at + size, "ip"
            at += size + 1


def cards(t: str) -> Iterator[Span]:
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 12:
            digits = _DIGITS.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), m.end(), "card"


def phones(t: str) -> Iterator[Span]:
    for m in _PHONE.finditer(t):
        if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
            yield m.start(), m.end(), "phone"


def plain_spans(t: str) -> list[Span]:
    """Matches in the text as it stands, by start, then kind."""
    found = list(emails(t)) if "@" in t else []
    found += ips(t)
    found += cards(t)
    if "+" in t:
        found += phones(t)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


#: Look-alikes of ASCII (fixed values): Cyrillic, then Greek letters, then signs. Full-width
#: forms and mathematical digits follow from their code points.
_LOOKALIKE = {
    **dict(zip("АВЕКМНОРСТХаеорсухіјѕԁ", "ABEKMHOPCTXaeopcyxijsd")),
    **dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοιν", "ABEZHIKMNOPTYXoiv")),
    **dict(zip("‐‑‒–—−․。﹒﹫", "------...@")),
    **{chr(0xFF01 + k): chr(0x21 + k) for k in range(94)},
    **{chr(0x1D7CE + k): chr(0x30 + k % 10) for k in range(50)},
    **{chr(0x660 + k): chr(0x30 + k) for k in range(10)},
    **{c: "" for c in "​‌‍⁠﻿­"},
}
_ODD = re.compile("[" + re.escape("".join(_LOOKALIKE)) + "]")

#: Number words of the spelled form (fixed values).
_NUMBER = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
           "seven": "7", "eight": "8", "nine": "9"}
_WORD = "(?:" + "|".join([*_NUMBER, "double", "triple"]) + ")"
_GAP = r"[\x20,.-]{1,2}"
_SPELLED = re.compile(rf"(?<![A-Za-z])(?:plus{_GAP})?{_WORD}(?:{_GAP}{_WORD}){{3,}}(?![A-Za-z])", re.I)
_ONE_WORD = re.compile(r"[A-Za-z]+|[^A-Za-z]")
_AT_SIGN = re.compile(r"\x20?[\[({<]\x20?at\x20?[\])}>]\x20?", re.I)
_DOT_SIGN = re.compile(r"\x20?[\[({<]\x20?(?:dot|punkt|punto|point)\x20?[\])}>]\x20?", re.I)
_AT_DOT = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{1,64}(?:\x20dot\x20[A-Za-z0-9._%+-]{1,64}){0,4}?)(\x20at\x20|@)"
                     r"[A-Za-z0-9-]{1,63}((?:(?:\.|\x20dot\x20)[A-Za-z0-9-]{1,63})+)", re.I)
_DOT_WORD = re.compile(r"\x20dot\x20", re.I)


class Rewritten:
    """A text under rewriting: its characters and the source span of each."""

    def __init__(self, text: str, offset: int):
        self.text = text
        self.spans = [(offset + k, offset + k + 1) for k in range(len(text))]

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply non-overlapping (start, end, new text) edits; each new character stands
        for the whole of what it replaces."""
        if not edits:
            return
        text, spans, at = [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            spans += self.spans[at:a]
            spans += [(self.spans[a][0], self.spans[b - 1][1])] * len(new)
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.spans = spans + self.spans[at:]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.spans[a][0], self.spans[b - 1][1]


def _digits_of(run: str) -> str:
    out, times = [], 1
    for w in _ONE_WORD.findall(run.lower()):
        if w == "plus":
            out.append("+")
        elif w in ("double", "triple"):
            times = 2 if w == "double" else 3
        elif w in _NUMBER:
            out.append(_NUMBER[w] * times)
            times = 1
    return "".join(out)


def _source(r: Rewritten, piece: str, offset: int, k: int) -> str:
    a, b = r.spans[k]
    return piece[a - offset: b - offset]


def normalise(piece: str, offset: int) -> Rewritten:
    """The chain of transducers over a stretch of text."""
    r = Rewritten(piece, offset)
    if not piece.isascii():
        r.replace([(m.start(), m.end(), _LOOKALIKE[m.group()]) for m in _ODD.finditer(r.text)])
    r.replace([(m.start(), m.end(), "@") for m in _AT_SIGN.finditer(r.text)])
    r.replace([(m.start(), m.end(), ".") for m in _DOT_SIGN.finditer(r.text)])
    edits = []
    for m in _AT_DOT.finditer(r.text):
        dots = [(x.start(), x.end(), ".") for x in _DOT_WORD.finditer(r.text, *m.span(3))]
        if m.group(2) != "@":
            if not dots and not any(r.text[k] == "." and _source(r, piece, offset, k) != "." for k in range(*m.span(3))):
                continue
            dots.append((*m.span(2), "@"))
        edits += sorted([*dots, *[(x.start(), x.end(), ".") for x in _DOT_WORD.finditer(r.text, *m.span(1))]])
    r.replace(edits)
    r.replace([(m.start(), m.end(), _digits_of(m.group())) for m in _SPELLED.finditer(r.text)])
    return r


_TRIGGER = re.compile(r"[\[({<]\x20?(?:at|dot|punkt|punto|point)\x20?[\])}>]|\x20dot\x20|"
                      + rf"(?<![A-Za-z])(?:plus{_GAP})?{_WORD}(?:{_GAP}{_WORD}){{3,}}(?![A-Za-z])", re.I)
#: Characters kept around a rewritten place: the longest disguised form fits.
_REACH = 160


def disguised_spans(t: str) -> list[Span]:
    """Matches that show only after normalisation, in source positions."""
    places = [m.span() for m in _TRIGGER.finditer(t)]
    if not t.isascii():
        places += [m.span() for m in _ODD.finditer(t)]
    if not places:
        return []
    stretches: list[list[int]] = []
    for a, b in sorted(places):
        a, b = max(0, a - _REACH), min(len(t), b + _REACH)
        if stretches and a <= stretches[-1][1]:
            stretches[-1][1] = max(b, stretches[-1][1])
        else:
            stretches.append([a, b])
    places.sort()
    starts, ends, far = [p[0] for p in places], [], 0
    for _, b in places:
        far = max(far, b)
        ends.append(far)
    out = []
    for a, b in stretches:
        # whole words only, so that no match is cut at the rim
        while a > 0 and not t[a - 1].isspace() and b - a < 4 * _REACH + 20_000:
            a -= 1
        while b < len(t) and not t[b].isspace() and b - a < 4 * _REACH + 20_000:
            b += 1
        r = normalise(t[a:b], a)
        for s, e, kind in plain_spans(r.text):
            s, e = r.source(s, e)
            k = bisect_right(starts, e - 1) - 1
            if k >= 0 and ends[k] > s:  # something in it was rewritten
                out.append((s, e, kind))
    return out


def all_spans(t: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and plain with disguised ones, each by start, then kind."""
    plain = plain_spans(t)
    hidden = disguised_spans(t)
    if hidden:
        starts, far, ends = [], 0, []
        for a, b, _ in plain:
            far = max(far, b)
            starts.append(a)
            ends.append(far)
        new = []
        for a, b, kind in dict.fromkeys(hidden):
            k = bisect_right(starts, a) - 1  # of the plain spans that start by a, does one reach b
            if k < 0 or ends[k] < b:
                new.append((a, b, kind))
        hidden = new
    return plain, sorted([*plain, *hidden], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _join(spans: list[Span]) -> str:
    return ",".join([f"{k}:{a}:{b}" for a, b, k in spans])


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): the plain and all spans of each document, each as
    ``kind:start:end`` joined by commas; code points, end exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [all_spans(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([_join(p) for p, _ in found], pa.string()),
                 pa.array([_join(x) for _, x in found], pa.string())], ["doc_id", "base", "spans"])

    return texts(docs).mapInArrow(run, "doc_id long, base string, spans string")


def mask(t: str | None) -> str | None:
    """The text with every span, plain or disguised, replaced by its kind in angle brackets;
    overlapping spans are replaced as one, by the kind of the first."""
    if not t:
        return t
    out, at = [], 0
    for a, b, kind in all_spans(t)[1]:
        if a >= at:
            out += [t[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, t[at:]]) if out else t


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with the personal data in ``text`` masked."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.set_column(place, b.schema.field(place), pa.array(
                [mask(t) for t in b.column(place).to_pylist()], b.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def pii_digest(docs: DataFrame) -> DataFrame:
    """Counts by kind over all spans, checksum of the plain ones, and all spans. The counts of
    plain spans alone follow as ``base_<kind>``."""
    found = detect(docs)

    def count(column: str, kind: str):
        return F.regexp_count(F.col(column), F.lit(f"{kind}:")).cast("long")

    return found.select("doc_id", *[count("spans", k).alias(f"n_{k}") for k in KINDS],
                        F.sha2("base", 256).alias("base_sha256"), "spans",
                        *[count("base", k).alias(f"base_{k}") for k in KINDS])
