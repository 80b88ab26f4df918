"""Personal data with offset-preserving deobfuscation.

The base finds plain identifiers. The method then runs a chain of transducers over the text: look-alike letters and digits
become ASCII one for one; invisible characters go; character references and bracketed, dashed or spelled "at" and "dot" become
the signs; runs of spelled digits become digits. Each transducer keeps the list of its edits, so a span of its output maps to
the span of its input that made it, and through the chain back to the source. Identifiers found in the last output are added
unless one of the same kind that the base has covers them; so where the base has only a part of one, both stand.

Every text goes through the chain; a transducer is left out only where the text lacks a sign that each of its matches holds.
All patterns look a bounded way around signs or words, or walk outwards from an "@" up to the next, so a text takes time in
proportion to its length. The bounds are those of names: a disguised domain's labels have 63 characters at most.

Offsets are code points of the source text, ends exclusive. Every text is taken whole; there are no groups and no shuffles.

Defined results: a null text is empty and has no spans, as an empty one. Repeated rows, rows that share an id and rows without
one each give their own results. An empty table gives none. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantgraph.llm.shared import lowered, named, slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, end, index of the kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){13,}")  # runs under 14 digits fail the count anyway
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping spans of each kind; a match that fails its check is dropped and not tried again."""
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((start, m.end(), 0))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m[0].split(".")):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


# Cyrillic, Greek and Latin letters that look like ASCII ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "З": "3",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", "·": ".",
}
# The digits' names in the languages of the corpus.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
}
_AT, _DOT = "at|arroba|arobase", "dot|punto|punkt|point"
_LABEL = "[a-z0-9-]{1,63}"
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_FOREIGN = re.compile("[^\x00-\xac\xae-\u024f]|[\u0250-\u02af]|\u0131|\u00b7")
_ENTITY = re.compile("&#0{0,4}64;|&#x0{0,4}40;|&commat;|%40|(&#0{0,4}46;|&#x0{0,4}2e;|&period;|%2e)")
_BRACKET = re.compile(rf"[ \t]{{0,2}}[\[({{<][ \t]{{0,2}}(?:(?:{_AT}|@)|({_DOT}|\.))[ \t]{{0,2}}[\])}}>][ \t]{{0,2}}")
_SHORT_AT = re.compile(rf"(?<=[a-z0-9])\(a\)(?={_LABEL}\.[a-z]{{2}})")
_RULED_AT = re.compile(rf"(?<=[a-z0-9])[ \t]{{0,2}}([-_*~|])(?:{_AT})\1[ \t]{{0,2}}(?=[a-z0-9]{{1,63}}[ \t]{{0,2}}\1(?:{_DOT})\1)")
_RULED_DOT = re.compile(rf"(?<=[a-z0-9])[ \t]{{0,2}}([-_*~|])(?:{_DOT})\1[ \t]{{0,2}}(?=[a-z0-9])")
_NUMERALS = re.compile(rf"(?<!\w)(?:({'|'.join(sorted(DIGIT_WORDS, key=lambda x: (-len(x), x)))})|{_DOT})(?!\w)")
_GAP = re.compile(r"[ \t,()/.+-]{0,4}(?:[0-9]{1,19}[ \t,()/.+-]{0,4})*")
_BETWEEN = re.compile(r"(?<=[0-9])[ol](?=[0-9])")
_PLUS = re.compile(r"(?<!\w)plus[ \t]{1,3}(?=\(?[0-9])")
_WORD_DOTS = rf"(?:[ \t]{{1,3}}(?:{_DOT})[ \t]{{1,3}}|\.)"
_WORD_AT = re.compile(rf"(?<=[a-z0-9])[ \t]{{1,3}}(?:{_AT})[ \t]{{1,3}}(?={_LABEL}({_WORD_DOTS}){_LABEL}((?:{_WORD_DOTS}{_LABEL}){{0,8}}))")
_SPACED_AT = re.compile(rf"(?<=[a-z0-9])(?:[ \t]{{1,3}}@[ \t]{{0,3}}|@[ \t]{{1,3}})(?={_LABEL}(?:[ \t]{{0,2}}\.|[ \t]{{1,3}}(?:{_DOT})[ \t]))")
#: Ends of domains that may follow a spelled dot after a plain one.
_TOPS = frozenset("com org net edu gov io de fr es uk co info eu us ch it nl biz".split())
_TOP = re.compile(r"[a-z]{2,24}\Z")
_NEXT = re.compile(rf"[a-z0-9-]+([ \t]{{1,3}}(?:{_DOT})[ \t]{{1,3}}(?=[a-z0-9-])|[ \t]{{1,2}}\.[ \t]{{0,2}}(?=[a-z]{{2}})|\.(?=[a-z0-9-]))?")
_BEFORE = re.compile(rf"[a-z0-9]([ \t]{{1,3}}(?:{_DOT})[ \t]{{1,3}})\Z")
#: Words that stand before "at" and a plain domain without being a mailbox.
_NOT_LOCAL = frozenset("look looks looking see seen visit us me more it them him her you find found read available is are was be been here page site website online only live now hosted out shop store blog home not and or join start stay arrive".split())


@cache
def ascii_table() -> dict[int, str]:
    """Code points whose compatibility form or digit value is one ASCII character, and the look-alikes."""
    table = {}
    for c in [*range(0x2B0, 0x3400), *range(0xA600, 0xAC00), *range(0xF900, 0x11000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F1F0)]:
        plain = unicodedata.normalize("NFKC", chr(c))
        digit = unicodedata.decimal(chr(c), None)
        if len(plain) == 1 and plain.isascii():
            table[c] = plain
        elif digit is not None:
            table[c] = str(digit)
    return table | {ord(a): b for a, b in LOOK_ALIKES.items()}


class Transduced:
    """A text made from another by edits: each is (start here, end here, start there, end there)."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        out, self.edits, at, here = [], [], 0, 0
        for start, end, new in edits:
            out += [source[at:start], new]
            here += start - at
            self.edits.append((here, here + len(new), start, end))
            at, here = end, here + len(new)
        out.append(source[at:])
        self.text = "".join(out)
        self._starts = [e[0] for e in self.edits]

    def _source(self, place: int) -> tuple[int, int]:
        """Where the character at a place comes from."""
        k = bisect_right(self._starts, place) - 1
        if k < 0:
            return place, place + 1
        here, end, start, stop = self.edits[k]
        if place < end:
            return start, stop
        return place - end + stop, place - end + stop + 1

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self._source(start)[0], self._source(end - 1)[1]


def numerals(low: str) -> list[tuple[int, int, str]]:
    """Edits of runs of spelled digits, among groups of digits, and of spelled dots between digits."""
    runs: list[list[re.Match]] = []
    for m in _NUMERALS.finditer(low):
        if runs and m.start() - runs[-1][-1].end() <= 64 and _GAP.fullmatch(low, runs[-1][-1].end(), m.start()):
            runs[-1].append(m)
        else:
            runs.append([m])
    edits: list[tuple[int, int, str]] = []
    for run in runs:
        enough = len(run) >= 3
        between = "" if sum(m[1] is None for m in run) >= 3 else " "  # parts of an address, or digits in groups
        for k, m in enumerate(run):
            if m[1] is None:
                a, b = m.span()
                while a and low[a - 1] in " \t":
                    a -= 1
                while b < len(low) and low[b] in " \t":
                    b += 1
                left = a and (low[a - 1].isdecimal() or k and run[k - 1][1] and run[k - 1].end() == a)
                right = b < len(low) and (low[b].isdecimal() or k + 1 < len(run) and run[k + 1][1] and run[k + 1].start() == b)
                if left and right and b - a <= 12:
                    edits.append((a, b, "."))
            elif enough:
                if edits and k and 0 < m.start() - edits[-1][1] <= 4 and run[k - 1].end() == edits[-1][1] and not low[edits[-1][1] : m.start()].strip(" \t,"):
                    edits.append((edits[-1][1], m.start(), between))
                edits.append((*m.span(), DIGIT_WORDS[m[1]]))
    return edits


def around_at(low: str) -> list[tuple[int, int, str]]:
    """Edits of spelled and spaced dots in what stands around each "@": outwards, as far as labels go on."""
    edits: list[tuple[int, int, str]] = []
    done, at = 0, low.find("@")
    while at >= 0:
        found, left = [], at
        while True:
            while left > done and low[left - 1] in _LOCAL:
                left -= 1
            m = _BEFORE.search(low, max(done, left - 16), left) if left < at else None
            if not m:
                break
            found.append((*m.span(1), "."))
            left = m.start(1)
        edits += reversed(found)
        place, plain = at + 1, False
        while m := _NEXT.match(low, place):
            place = m.end()
            if m[1] is None:
                break
            if m[1] != "." and plain and not (low[place : place + 6].split(maxsplit=1)[:1] or [""])[0].rstrip(".,;:!?)") in _TOPS:  # what follows a whole domain
                place -= len(m[1])
                break
            plain = plain or m[1] == "."
            if m[1] != ".":
                edits.append((*m.span(1), "."))
        done = max(done, place)
        at = low.find("@", max(at + 1, place))
    return edits


def word_at(low: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _WORD_AT.finditer(low):
        if m[1] == "." and not any(c in " \t" for c in m[2]):  # a plain domain: what stands before must be a mailbox
            start = m.start()
            while start and m.start() - start < 64 and low[start - 1] in _LOCAL:
                start -= 1
            last = re.split(r"[.\s]", low[m.end() : m.end() + 600].split(maxsplit=1)[0].rstrip(".,;:!?)"))[-1]
            if low[start : m.start()] in _NOT_LOCAL or not _TOP.match(re.sub("[^a-z0-9-].*", "", last)):
                continue
        edits.append((m.start(), m.end(), "@"))
    return edits


def added_spans(text: str, base: list[Span]) -> list[Span]:
    plain = text.translate(ascii_table()) if _FOREIGN.search(text) else text
    low = lowered(plain)
    chain: list[Transduced] = []

    def step(edits: list[tuple[int, int, str]]) -> None:
        nonlocal plain, low
        if edits:
            chain.append(Transduced(plain, edits))
            plain = chain[-1].text
            low = lowered(plain)

    def each(pattern: re.Pattern, new: str, other: str = "") -> None:
        step([(*m.span(), other if other and m[1] else new) for m in pattern.finditer(low)])

    each(_INVISIBLE, "")
    if "&" in low or "%" in low:
        each(_ENTITY, "@", ".")
    if any(c in low for c in "[({<"):
        each(_SHORT_AT, "@")
        each(_BRACKET, "@", ".")
    if any(c in low for c in "-_*~|"):
        each(_RULED_AT, "@")
        if "@" in low:
            each(_RULED_DOT, ".")
    step(numerals(low))
    step([(*m.span(), "0" if m[0] == "o" else "1") for m in _BETWEEN.finditer(low)])
    each(_PLUS, "+")
    step(word_at(low))
    if "@" in low:
        each(_SPACED_AT, "@")
        step(around_at(low))
    if plain == text:
        return []
    out: list[Span] = []
    last = [0] * len(KINDS)
    plainly = [[x for x in base if x[2] == k] for k in range(len(KINDS))]
    for start, end, kind in base_spans(plain):  # in order, and so are the places that they come from
        for made in reversed(chain):
            start, end = made.back(start, end)
        k = bisect_right(plainly[kind], start, key=lambda x: x[0]) - 1
        if start >= last[kind] and not (k >= 0 and end <= plainly[kind][k][1]):
            out.append((start, end, kind))
            last[kind] = end
    return out


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): the base's spans and all spans, arrays of (start, end, kind) in order."""
    read = docs.select(named(id_col).alias(id_col), F.coalesce(named(text_col), F.lit("")).alias("__tg_text"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    typed = lambda spans: [{"start": a, "end": b, "kind": KINDS[k]} for a, b, k in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, 1, 4 << 20):
            base = [base_spans(x) for x in texts]
            every = [sorted([*b, *added_spans(x, b)], key=lambda s: (s[0], s[2])) for x, b in zip(texts, base, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([typed(b) for b in base], span), pa.array([typed(e) for e in every], span)], [id_col, "base", "spans"])

    kind = read.schema[id_col].dataType.simpleString()
    return read.mapInArrow(run, f"`{id_col}` {kind}, base array<struct<start:long,end:long,kind:string>>, spans array<struct<start:long,end:long,kind:string>>")


def joined(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

