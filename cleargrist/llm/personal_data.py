"""Personal data: offset-preserving deobfuscation before detection.

Every text is searched as it is (the base spans). A text that shows a trace of a disguise also
goes through a chain of small transducers, which write a plain text and remember for each of its
characters the source span it came from: look-alike letters, full-width forms and other scripts'
digits become ASCII, invisible characters vanish, spelled digits become digits, and the many ways
to write "at" and "dot" become ``@`` and ``.``. What is detected there is mapped back to source
characters; spans that a base span of the same kind covers are not repeated.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.tables import keyed, rows_between

KINDS = ("email", "ip", "card", "phone")

# A digit run is tried from its first digit only: a match from a later one would be a match from
# the first, and this keeps the search linear in long runs.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, found from each @ outwards, so in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", at + 1)


def detect(text: str) -> list[Span]:
    """Base spans (start, end, kind) of one text, by start, then by kind as listed in KINDS."""
    found: list[tuple[int, int, int]] = []
    found += [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(p) <= 255 for p in (p.lstrip("0")[:4] or "0" for p in m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


# Letters of other scripts that look like ASCII ones.
LOOK_ALIKES = dict(
    zip(
        "аеіорсухѕјһԁɡαεινορυκАВЕНІКМОРСТХΑΒΕΗΙΚΜΝΟΡΤΥΧΖ",
        "aeiopcyxsjhdgaeivopukABEHIKMOPCTXABEHIKMNOPTYXZ",
        strict=True,
    )
)
# Digit words of the languages that occur.
DIGIT_WORDS = {
    word: str(value)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for value, word in enumerate(words.split())
} | {"oh": "0"}
AT_WORDS = ("at", "ät", "arroba", "arobase")
DOT_WORDS = ("dot", "punkt", "point", "punto")
TOP_DOMAINS = "com|org|net|edu|gov|info|biz|io|co|de|fr|es|it|eu|uk|us|ch|at|nl|example|test"

_INVISIBLE = frozenset("­​‌‍⁠﻿")
_words = sorted(DIGIT_WORDS, key=len, reverse=True)
_DIGIT = f"(?:{'|'.join(_words)}|[0-9])"
_ONE = re.compile(_DIGIT, re.IGNORECASE)
_PLUS = re.compile(r"(?<!\w)plus (?=[0-9])", re.IGNORECASE)
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OolI](?=[0-9])")
_AFTER_PLUS = re.compile(r"(?:\+|\bplus) ?\Z", re.IGNORECASE)
_OPEN, _CLOSE = r"[ ]?[\[({<][ ]?", r"[ ]?[\])}>][ ]?"
_AT = re.compile(rf"{_OPEN}(?:{'|'.join(AT_WORDS)}|@){_CLOSE}", re.IGNORECASE)
_DOT = re.compile(rf"{_OPEN}(?:{'|'.join(DOT_WORDS)}|\.){_CLOSE}", re.IGNORECASE)
_at, _dot = "|".join(AT_WORDS), "|".join(DOT_WORDS)
_LABEL = "[A-Za-z0-9](?:[A-Za-z0-9_%+-]*[A-Za-z0-9])?"
_POINT = rf"(?: (?:{_dot}) |\.)"
_PLAIN = re.compile(
    rf"(?<![\w.%+-]){_LABEL}(?:{_POINT}{_LABEL}){{0,3}}(?: (?:{_at}) |@)"
    rf"{_LABEL}(?:{_POINT}{_LABEL}){{0,3}}{_POINT}(?:{TOP_DOMAINS})(?!\w)",
    re.IGNORECASE,
)
_PART = rf"{_DIGIT}(?:[ -]?{_DIGIT}){{0,2}}"
_SPELLED = re.compile(
    rf"(?<!\w){_PART}(?: (?:{_dot}) {_PART}){{3}}(?!\w)|(?<!\w){_DIGIT}(?:[ ,()-]{{1,3}}{_DIGIT}){{3,}}(?!\w)",
    re.IGNORECASE,
)
# A plain "at" stands in much prose before a host. It makes an address only if something says so: a
# mark or a digit in the name, a spelled "dot", a word about writing nearby, or a host for mail.
_NEAR = 48
_CONTACT = re.compile(
    r"(?<!\w)(?:e-?mails?|mail|write|contact|reach|address|send|message|courriel|correo|schreib\w*|kontakt\w*)(?!\w)",
    re.IGNORECASE,
)
_MAIL_HOST = re.compile(r"mail|outlook|yahoo|gmx|icloud|proton", re.IGNORECASE)
# Numerals alone are lists or scores; these words make ten of them a number to call.
_CALL = re.compile(
    r"(?<!\w)(?:phone|tel|telephone|telefon|t[eé]l[eé]phone|tel[eé]fono|call|ring|dial|fax|mobile|cell|sms|text)(?!\w)",
    re.IGNORECASE,
)
_PLAIN_AT = re.compile(rf" (?:{_at}) ", re.IGNORECASE)
_DOT_WORD = re.compile(rf" (?:{_dot}) ", re.IGNORECASE)

_BRACKETED = re.compile(rf"[\[({{<][ ]?(?:{_at}|{_dot}|@|\.)[ ]?[\])}}>]")
_MIXED = re.compile("[0-9][OolI][0-9]")
_ATS, _DOTS = (tuple(f" {word} " for word in words) for words in (AT_WORDS, DOT_WORDS))
# What _PLAIN takes for a host after a plain "at"; hosts with a plain "dot" show that trace.
_AT_HOST = re.compile(rf" (?:{_at}) {_LABEL}(?:\.{_LABEL}){{0,3}}\.(?:{TOP_DOMAINS})(?!\w)")
_PLUS_DIGIT = re.compile("plus [0-9]")
# The second, third and fourth unit of what _SPELLED takes; the search stops at separators only.
_RUN = re.compile(rf"[ ,()-]{_DIGIT}(?:[ ,()-]{{1,3}}{_DIGIT}){{2}}(?!\w)")
_UNITS = frozenset(DIGIT_WORDS) | frozenset("0123456789")
_SEPARATORS = str.maketrans(",-()", "    ")


class Tape:
    """A text and, for each of its characters, the span of the source that it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans, given in order; each written character stands for the whole span."""
        pieces, starts, ends, at = [], [], [], 0
        for start, end, new in edits:
            pieces += [self.text[at:start], new]
            starts += self.starts[at:start]
            ends += self.ends[at:start]
            if end > start:
                starts += [self.starts[start]] * len(new)
                ends += [self.ends[end - 1]] * len(new)
            at = end
        self.text = "".join([*pieces, self.text[at:]])
        self.starts = starts + self.starts[at:]
        self.ends = ends + self.ends[at:]


def _plain_character(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain.isascii() else c


class _Characters(dict):
    """For str.translate: what _plain_character makes of each code point, worked out when first met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = new = c if c.isascii() else _plain_character(c)
        return new


_PLAIN_CHARACTERS = _Characters()
# Searches that ignore case take these for an i, lower() does not.
_DOTLESS = re.compile("[\u0130\u0131]")
# All characters that _plain_character may change, and those that lower() or a search that
# ignores case takes for other letters; beyond U+024F simply all.
_FOREIGN = re.compile(
    "[%s\u0130\u0131\u0250-\U0010ffff]"
    % "".join(c for c in map(chr, range(0x80, 0x250)) if _plain_character(c) != c)
)


def suspicious(text: str) -> bool:
    """Whether a text shows a trace of a disguise; cheap, as nearly all texts show none.

    No transducer changes a text for which this is false: the first one to change something would
    find it in the text as it is, so there is a test here for what each of them looks for.
    """
    return not text.isascii() and _FOREIGN.search(text) is not None or _traces(text)


def _traces(text: str) -> bool:
    """The same for all transducers but the first, which changes single characters."""
    if _MIXED.search(text):
        return True
    lowered = text.lower()
    if _BRACKETED.search(lowered) or any(dot in lowered for dot in _DOTS):
        return True
    if any(at in lowered for at in _ATS) and _AT_HOST.search(lowered):
        return True
    if _PLUS_DIGIT.search(lowered):
        return True
    # Units inside a run stand between separators; its first and last one need not.
    units = sum(map(_UNITS.__contains__, lowered.translate(_SEPARATORS).split()))
    return units >= 2 and _RUN.search(lowered) is not None


def _is_address(text: str, m: re.Match) -> bool:
    """Whether what _PLAIN has found is an address and not a place where something is."""
    at = _PLAIN_AT.search(m[0])
    if at is None or at[0].strip().lower() != "at" or _DOT_WORD.search(m[0]):
        return True
    name, host = m[0][: at.start()], m[0][at.end() :]
    if not name.isalpha() or _MAIL_HOST.search(host):
        return True
    near = text[max(0, m.start() - _NEAR) : m.start()], text[m.end() : m.end() + _NEAR]
    return any(map(_CONTACT.search, near))


def _is_number(text: str, m: re.Match) -> bool:
    """Whether ten numerals or digit words in turn are a number to call and not a list."""
    spelled = any(w[0].isalpha() for w in _ONE.finditer(m[0]))
    return spelled or "(" in m[0] or _CALL.search(text[max(0, m.start() - _NEAR) : m.start()]) is not None


def _plain_mail(found: str) -> list[tuple[int, int, str]]:
    edits = [(m.start(), m.end(), "@") for m in _PLAIN_AT.finditer(found)][:1]
    edits += [(m.start(), m.end(), ".") for m in _DOT_WORD.finditer(found)]
    return sorted(edits)


def deobfuscate(text: str) -> Tape:
    """The plain text of a disguised one, each character with its source span."""
    tape = Tape(text)
    tape.rewrite(
        [
            (i, i + 1, new)
            for i, c in enumerate(text)
            if not c.isascii() and (new := _plain_character(c)) != c
        ]
    )
    tape.rewrite(
        [(m.start(), m.end(), "01"[m[0] in "lI"]) for m in _LETTER_DIGIT.finditer(tape.text)]
    )
    tape.rewrite([(m.start(), m.end(), "@") for m in _AT.finditer(tape.text)])
    tape.rewrite([(m.start(), m.end(), ".") for m in _DOT.finditer(tape.text)])
    edits = []
    for m in _SPELLED.finditer(tape.text):
        words = [(m.start() + w.start(), m.start() + w.end(), w[0]) for w in _ONE.finditer(m[0])]
        if len({DIGIT_WORDS.get(word.lower(), word) for _, _, word in words}) < 2:
            continue  # one word over and over is no number
        dots = {m.start() + d.start(): m.start() + d.end() for d in _DOT_WORD.finditer(m[0])}
        sign = ""
        if not dots and 10 <= len(words) <= 15 and not _AFTER_PLUS.search(tape.text[max(0, m.start() - 6) : m.start()]):
            sign = "+" if _is_number(tape.text, m) else ""
        at = m.start()
        for start, end, word in words:
            if at < start:
                edits.append((at, start, "." if dots.get(at) == start else ""))
            edits.append((start, end, sign + DIGIT_WORDS.get(word.lower(), word)))
            at, sign = end, ""
    tape.rewrite(edits)
    tape.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(tape.text)])
    edits = []
    for m in _PLAIN.finditer(tape.text):
        if not _is_address(tape.text, m):
            continue
        edits += [(m.start() + s, m.start() + e, new) for s, e, new in _plain_mail(m[0])]
    tape.rewrite(edits)
    return tape


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans of a text, and those that only its deobfuscated form shows."""
    base = detect(text)
    if not suspicious(text):
        return base, []
    if not text.isascii():
        # Most texts in other scripts are prose: what the first transducer writes shows nothing either.
        plain = text.translate(_PLAIN_CHARACTERS)
        if not (_DOTLESS.search(plain) or _traces(plain) or detect(plain)):
            return base, []
    tape = deobfuscate(text)
    if tape.text == text:
        return base, []
    more = set()
    for start, end, kind in detect(tape.text):
        span = (tape.starts[start], tape.ends[end - 1], kind)
        if not any(k == kind and s <= span[0] and span[1] <= e for s, e, k in base):
            more.add(span)
    return base, sorted(more, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``spans``, an array of (kind, start, end, disguised) by start.

    Offsets count code points, end exclusive. A null text counts as empty and has no spans;
    repeated rows are searched each for itself; columns other than the two named are not read;
    an empty table gives an empty table.
    """
    rows = keyed(docs, id_col, text_col).select("id", "text")
    struct = pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("disguised", pa.bool_())]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                found = []
                for text in rows_between(source, "text", block.first, len(block)).to_pylist():
                    base, more = find_spans(text)
                    spans = [(s, KINDS.index(k), e, False) for s, e, k in base]
                    spans += [(s, KINDS.index(k), e, True) for s, e, k in more]
                    found.append(
                        [
                            {"kind": KINDS[k], "start": s, "end": e, "disguised": d}
                            for s, k, e, d in sorted(spans)
                        ]
                    )
                ids = rows_between(source, "id", block.first, len(block))
                column = pa.array(found, pa.list_(struct))
                yield pa.RecordBatch.from_arrays([ids, column], ["id", "spans"])

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, spans array<struct<kind:string,start:int,end:int,disguised:boolean>>"
    return rows.mapInArrow(search, schema).withColumnRenamed("id", id_col)


def span_list(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def mask(text: str, spans: list[Span]) -> str:
    """A text with each span replaced by its kind in brackets; overlapping spans count as one."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
