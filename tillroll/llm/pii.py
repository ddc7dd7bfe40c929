"""Personal data in texts, also behind disguises, with spans of the original."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Digits are taken whole (++): what follows them is no digit in any of these patterns,
# so giving some back never helps and long runs cost linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from their @ signs; the part before one ends at the last match."""
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def luhn(digits: str) -> bool:
    doubled = "0246813579"
    return sum(int(c) if i % 2 == 0 else int(doubled[int(c)]) for i, c in enumerate(reversed(digits))) % 10 == 0


def detect(text: str) -> list[tuple[str, int, int]]:
    """Identifiers of every kind in ``text``, kind by kind."""
    found = [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        parts = [part.lstrip("0") for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


# Letters of other scripts that look like ASCII ones.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M",
    "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "Α": "A", "Β": "B", "Ε": "E", "Η": "H",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Υ": "Y",
    "\u2024": ".", "\u3002": ".", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-",
    "\u00a0": " ", "\u202f": " ",
}
_ONE_TO_ONE = {ord(k): v for k, v in _LOOKALIKES.items()}
_ONE_TO_ONE |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full width
_ONE_TO_ONE |= {first + d: str(d) for first in (0x0660, 0x06F0, 0x0966) for d in range(10)}
_FOREIGN = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(_ONE_TO_ONE)) + "]")

# Spelled digits.
_SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
_NAMES = "|".join(_SPELLED)
_HIDDEN = "[\\u00ad\\u200b-\\u200d\\u2060\\ufeff]+"
_MARK = r"\s{{0,3}}(?:\(\s{{0,3}}{0}\s{{0,3}}\)|\[\s{{0,3}}{0}\s{{0,3}}\]|\{{\s{{0,3}}{0}\s{{0,3}}\}})\s{{0,3}}"
_AT, _DOT = _MARK.format("(?:at|@)"), _MARK.format(r"(?:dot|\.)")
# Spoken, bracketed and literal signs may be mixed. "at" alone is an ordinary word: with it
# at least one dot must be spoken or bracketed.
_HOST = "[A-Za-z0-9-]{1,64}"
_STRONG_DOT = rf"(?:\s{{1,3}}dot\s{{1,3}}|{_DOT})"
_ANY_DOT = rf"(?:{_STRONG_DOT}|\.)"
_SPOKEN = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}"
    rf"(?:(?:{_AT}|@){_HOST}(?:{_ANY_DOT}{_HOST})+"
    rf"|\s{{1,3}}at\s{{1,3}}{_HOST}(?:\.{_HOST})*{_STRONG_DOT}{_HOST}(?:{_ANY_DOT}{_HOST})*)"
)
_GAP = r"(?:\s{1,3}dot\s{1,3}|[\s,.-]{1,3})"
# Numerals and spelled digits in one run; _rewrite counts its digits.
_DIGIT_WORDS = (
    rf"(?<![A-Za-z0-9])(?:plus\s{{1,3}})?(?:{_NAMES}|[0-9]{{1,19}})"
    rf"(?:{_GAP}(?:{_NAMES}|[0-9]{{1,19}})(?![A-Za-z0-9]))+"
)
_SINGLE_DIGITS = re.compile(
    rf"(?<![A-Za-z0-9])(?:plus\s{{1,3}})?[0-9](?:{_GAP}[0-9](?![A-Za-z0-9])){{6,}}", re.IGNORECASE
)
_SPELLED_DIGIT = re.compile(_NAMES, re.IGNORECASE)
_NUMBER = rf"(?:{_NAMES}|[0-9]+)(?:[\s,-]{{1,3}}(?:{_NAMES}|[0-9]+))*+"
_SPELLED_IP = re.compile(rf"{_NUMBER}(?:(?:\s+dot\s+|\.){_NUMBER}){{3}}", re.IGNORECASE)
_DISGUISE = re.compile(
    f"(?P<hidden>{_HIDDEN})|(?P<at>{_AT})|(?P<dot>{_DOT})"
    f"|(?P<spoken>{_SPOKEN})|(?P<digits>{_DIGIT_WORDS})",
    re.IGNORECASE,
)
_SPOKEN_PART = re.compile(rf"(?P<at>{_AT}|\s+at\s+)|(?P<dot>{_STRONG_DOT})", re.IGNORECASE)
_DIGIT_PART = re.compile(
    rf"(?P<plus>plus\s+)|(?P<name>{_NAMES})|(?P<dot>\s+dot\s+)|(?P<gap>[\s,.-]+)", re.IGNORECASE
)
# What every disguise needs, in cheaper searches over the lower-cased text.
_CUES = [
    re.compile(_HIDDEN),
    re.compile(r"[(\[{]\s{0,3}(?:at|dot|@|\.)\s{0,3}[)\]}]"),
    re.compile(rf"[0-9](?:{_GAP}[0-9]){{6}}"),
    re.compile(rf"(?:{_NAMES}){_GAP}(?:{_NAMES}|[0-9])|[0-9]{_GAP}(?:{_NAMES})"),
]


def _has_cue(text: str) -> bool:
    folded = text.lower()
    spoken = re.search(r"\sdot\s", folded) and ("@" in folded or re.search(r"\sat\s", folded))
    return bool(spoken) or any(cue.search(folded) for cue in _CUES)


class Normalised:
    """A rewritten text that remembers where each of its pieces came from."""

    def __init__(self, source: str):
        self.pieces: list[str] = []
        self.starts, self.sources, self.ends, self.copied = [], [], [], []
        self.length, self.read = 0, 0
        self._rewrite(source)
        self.text = "".join(self.pieces)

    def _put(self, piece: str, start: int, end: int, copied: bool) -> None:
        if piece:
            self.pieces.append(piece)
            self.starts.append(self.length)
            self.sources.append(start)
            self.ends.append(end)
            self.copied.append(copied)
            self.length += len(piece)

    def _replace(self, source: str, start: int, end: int, by: str) -> None:
        self._put(source[self.read : start], self.read, start, True)
        self._put(by, start, end, False)
        self.read = end

    def _rewrite(self, source: str) -> None:
        for m in _DISGUISE.finditer(source):
            kind, offset = m.lastgroup, m.start()
            if kind == "spoken":
                for part in _SPOKEN_PART.finditer(m[0]):
                    by = "@" if part.lastgroup == "at" else "."
                    self._replace(source, offset + part.start(), offset + part.end(), by)
            elif kind == "digits":
                self._rewrite_digits(source, *m.span())
            else:
                self._replace(source, *m.span(), {"hidden": "", "at": "@", "dot": "."}[kind])
        self._put(source[self.read :], self.read, len(source), True)

    def _rewrite_digits(self, source: str, start: int, end: int) -> None:
        run = source[start:end]
        spelled = _SPELLED_DIGIT.findall(run)
        if not spelled:
            runs = [m.span() for m in _SINGLE_DIGITS.finditer(source, start, end)]
        elif len(spelled) + len(_DIGIT.findall(run)) >= 7:
            runs = [(start, end)]
        else:
            runs = [m.span() for m in _SPELLED_IP.finditer(source, start, end)]
        for a, b in runs:
            address = _SPELLED_IP.fullmatch(source, a, b)
            for part in _DIGIT_PART.finditer(source, a, b):
                by = {"plus": "+", "dot": ".", "gap": ""}.get(part.lastgroup)
                by = "." if address and part[0] == "." else by
                by = _SPELLED[part[0].lower()] if by is None else by
                self._replace(source, part.start(), part.end(), by)

    def to_source(self, start: int, end: int) -> tuple[int, int]:
        """Source range of a range of the rewritten text; rewritten pieces count whole."""
        a, b = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        first = self.sources[a] + (start - self.starts[a]) * self.copied[a]
        last = self.sources[b] + (end - self.starts[b]) if self.copied[b] else self.ends[b]
        return first, last


def disguised(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Identifiers that show only after normalising, as spans of ``text``.

    One inside a base span of its kind is that one again and left out.
    """
    plain = text.translate(_ONE_TO_ONE) if _FOREIGN.search(text) else text
    if plain is text and not _has_cue(text):
        return []
    plain = Normalised(plain)
    found = [(kind, *plain.to_source(a, b)) for kind, a, b in detect(plain.text)]
    known: dict[str, list[tuple[int, int]]] = {}
    for kind, a, b in base:
        known.setdefault(kind, []).append((a, b))

    def covered(kind: str, a: int, b: int) -> bool:
        spans = known.get(kind, [])
        k = bisect_right(spans, (a, float("inf"))) - 1
        return k >= 0 and b <= spans[k][1]

    return [x for x in found if not covered(*x)]


def listed(spans: list[tuple[str, int, int]]) -> str:
    by_place = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in by_place)


_FOUND = (
    "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, n_added bigint, "
    "base_sha256 string, spans string"
)


def find_personal_data(docs: DataFrame, carried: list[str]) -> DataFrame:
    """One row per document: carried columns, counts and digest of base spans, all spans.

    Base spans are leftmost matches of fixed patterns in the original text. The method
    adds what the same patterns find in a normalised text: look-alike letters and full-
    width forms become ASCII, invisible characters go, bracketed "at" and "dot", whole
    "name at host dot tld" phrases in any mix of spoken, bracketed and literal signs, and
    runs of seven or more digits, some spelled, or of four parts of an address become
    what they stand for. Added spans are mapped back to code points of the original;
    ``n_added`` counts them. Base spans always stay.

    A NULL text counts as empty. Texts are searched whole, in time linear in their
    length. Repeated rows give repeated rows, an empty table gives none; other columns
    are ignored. No shuffle: each document is judged alone.
    """
    rows = docs.select(*carried, F.coalesce("text", F.lit("")).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts = [], []
            for text in batch.column("_text").to_pylist():
                base = detect(text)
                added = disguised(text, base)
                counts.append([*(sum(k == kind for k, _, _ in base) for kind in KINDS), len(added)])
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                texts.append((digest, listed(base + added)))
            own = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS) + 1)]
            own += [pa.array([t[i] for t in texts], pa.string()) for i in range(2)]
            names = [*batch.schema.names[:-1], *(c.split()[0] for c in _FOUND.split(", "))]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + own, names=names)

    return rows.mapInArrow(search, f"{schema}, {_FOUND}")


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(table(spark, folder, "documents"), ["doc_id"])
