"""Personal data in plain and disguised form, with spans in the source text.

Plain identifiers are found by the base patterns. A disguised text goes through transducers first:
look-alike characters become ASCII, zero-width characters go, ``[at]`` and ``(dot)`` become ``@`` and
``.``, and runs of spelled digits become digits. Each piece of output remembers the piece of source it
stands for, so a span found in the normalised text is mapped back to source characters.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import whole_text

# ---------------------------------------------------------------------------
# The kinds in their order, the look-alikes and the words of the disguises.
# ---------------------------------------------------------------------------
KINDS = ("email", "ip", "card", "phone")
LOOK_ALIKES = dict(zip("аеорсухіјѕԁһԛԝАВЕКМНОРСТХΑΒΕΖΗΙΚΜΝΟΡΤΧο", "aeopcyxijsdhqwABEKMHOPCTXABEZHIKMNOPTXo", strict=True))
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
#: Also articles, so they do not show by themselves that digits are spelled.
VAGUE = ("un",)
TOP_LEVELS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "eu", "us")
#: Endings that count only after a spelled dot: countries whose code is no common word.
COUNTRIES = tuple("ae ar au bd bg br ca ch cl cn cz dk ee fi gr hk hr hu id ie il jp ke kr lt lu lv mx my ng nl nz pe ph pk pl pt ro rs ru se sg si sk th tr tw ua vn za".split())
AT_WORDS, DOT_WORDS, PLUS_WORDS = ("at", "arroba"), ("dot", "punkt", "point", "punto"), ("plus", "más")
# ---------------------------------------------------------------------------

SPELLED = {word: str(value) for words in DIGIT_WORDS for value, word in enumerate(words.split())}
CLEAR = SPELLED.keys() - set(VAGUE)
_ALL_WORDS = SPELLED | dict.fromkeys(DOT_WORDS, ".") | dict.fromkeys(PLUS_WORDS, "+")

EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_HEAD = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_at, _dot = "|".join((*AT_WORDS, "@")), "|".join((*DOT_WORDS, r"\."))
_unit = f"(?:{'|'.join((*SPELLED, *DOT_WORDS, '[0-9]+'))})"
_dots = "|".join(DOT_WORDS)
BRACKETED = re.compile(rf"[\[({{<]\x20?(?:(?P<at>{_at})|(?:{_dot}))\x20?[\])}}>]\x20?", re.IGNORECASE)
#: A name and the bare word at (or the sign).
BARE_AT = re.compile(rf"(?<=[a-z0-9])(?:\x20(?:{'|'.join(AT_WORDS)})\x20|@)(?=[a-z0-9-])", re.IGNORECASE)
_labels = rf"[a-z0-9-]+(?:(?:\x20(?:{_dots})\x20|\.)[a-z0-9-]+)*"
#: What follows it: labels joined by the bare word dot (or points) up to the last known ending, or up to any
#: label of letters after the bare word.
BARE_HOST = re.compile(
    rf"{_labels}(?:\x20(?:{_dots})\x20(?:{'|'.join((*TOP_LEVELS, *COUNTRIES))})|\.(?:{'|'.join(TOP_LEVELS)}))(?![\w.-])", re.IGNORECASE
)
BARE_ANY = re.compile(rf"{_labels}\x20(?:{_dots})\x20[a-z]{{2,}}(?![\w-]|\.\w)", re.IGNORECASE)
#: What prose does not have before the word at: a mark or digit inside a name.
_MADE_UP = re.compile(r"(?=[a-z0-9._%+-]*[0-9._%+-])[a-z0-9._%+-]{1,64}\Z", re.IGNORECASE)
#: At least seven digit words or numbers in a row.
DIGIT_RUN = re.compile(
    rf"(?<!\w)(?:(?:{'|'.join(PLUS_WORDS)})[\s-]+|\+)?(?:{_unit}[\s,-]+){{6,}}{_unit}(?!\w)", re.IGNORECASE
)
NOTHING = re.compile(f"[{''.join(map(chr, (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)))}]+")
_BARE_PART = re.compile(r"\x20(?:(at|arroba)|dot|punkt|point|punto)\x20", re.IGNORECASE)
_DIGIT_PART = re.compile(rf"{'|'.join(sorted(_ALL_WORDS, key=len, reverse=True))}|[0-9]+|\+", re.IGNORECASE)


@cache
def look_alikes() -> dict[int, str]:
    """Characters that stand for one ASCII letter, digit or mark: decimal digits of any script, the
    compatibility forms of ASCII, and the letters of LOOK_ALIKES."""
    found = {ord(c): a for c, a in LOOK_ALIKES.items()}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        digit = unicodedata.decimal(char, None)
        if digit is not None:
            found[point] = str(digit)
        elif 0x2000 < point and unicodedata.category(char) in ("Ll", "Lu", "Po", "Sm", "Pc", "Pd"):
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and re.fullmatch(r"[A-Za-z@.+_%-]", plain):
                found[point] = plain
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns: leftmost, non-overlapping per kind, failing ones dropped."""
    spans = []
    if "@" in text:
        free = 0
        for tail in EMAIL_TAIL.finditer(text):
            at = tail.start()
            start = at
            while start > free and EMAIL_HEAD.match(text, start - 1, start):
                start -= 1
            if start < at:
                spans.append((start, 0, tail.end()))
                free = tail.end()
    for match in IP.finditer(text):
        if all(map(_small, match[0].split("."))):
            spans.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = match[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, match[0])) <= 15:
                spans.append((match.start(), 3, match.end()))
    return sorted(spans)


class Normalised:
    """A text after the transducers, with the source piece of every piece of it."""

    def __init__(self, text: str) -> None:
        mapped = text if text.isascii() else text.translate(look_alikes())
        self.changed = mapped != text
        self.starts: list[int] = []  # in the normalised text
        self.pieces: list[tuple[int, int, bool]] = []  # source start, source end, copied as it is
        out: list[str] = []
        self.length = done = 0
        for start, end, plain in _edits(mapped):
            if start > done:
                self._add(out, mapped[done:start], done, start, True)
            self._add(out, plain, start, end, False)
            done = end
            self.changed = True
        if self.changed:
            self._add(out, mapped[done:], done, len(mapped), True)
            self.text = "".join(out)

    def _add(self, out: list[str], plain: str, start: int, end: int, copied: bool) -> None:
        if plain:
            self.starts.append(self.length)
            self.pieces.append((start, end, copied))
            self.length += len(plain)
            out.append(plain)

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of a normalised one: whole source pieces where characters were rewritten."""
        a, b = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        first, last = self.pieces[a], self.pieces[b]
        begin = first[0] + (start - self.starts[a]) * first[2]
        return begin, last[0] + end - self.starts[b] if last[2] else last[1]


def _edits(mapped: str) -> list[tuple[int, int, str]]:
    """Source pieces to rewrite, in order and apart from each other."""
    edits = []
    for match in BRACKETED.finditer(mapped):
        start = match.start() - (mapped[match.start() - 1 : match.start()] == " ")
        edits.append((start, match.end(), "@" if match["at"] else "."))
    if not mapped.isascii():
        edits += [(m.start(), m.end(), "") for m in NOTHING.finditer(mapped)]
    lower = mapped.lower()
    if any(f" {word} " in lower for word in (*AT_WORDS, *DOT_WORDS)):
        for at in BARE_AT.finditer(mapped):
            name = mapped[max(0, at.start() - 64) : at.start()].rpartition(" ")[2]
            made_up = _MADE_UP.match(name)
            # Prose has "at the dot of", so unknown endings need a name that prose does not have.
            host = BARE_HOST.match(mapped, at.end()) or made_up and BARE_ANY.match(mapped, at.end())
            if not host:
                continue
            parts = list(_BARE_PART.finditer(mapped, at.start(), host.end()))
            if not any(p[1] is None for p in parts) and not made_up:
                continue  # "look at example.com" is prose
            edits += [(p.start(), p.end(), "@" if p[1] else ".") for p in parts]
    words = lower.replace(",", " ").replace("-", " ").split()
    if sum(map(CLEAR.__contains__, words)) >= 3:
        for match in DIGIT_RUN.finditer(mapped):
            edits += _digits(match)
    apart, done = [], 0
    for edit in sorted(edits):
        if edit[0] >= done:
            apart.append(edit)
            done = edit[1]
    return apart


def _digits(run: re.Match) -> list[tuple[int, int, str]]:
    """A run of digit words written as digits, without what stands between them."""
    parts = list(_DIGIT_PART.finditer(run[0]))
    if sum(p[0].lower() in CLEAR for p in parts) < 3:
        return []
    edits = []
    for n, part in enumerate(parts):
        edits.append((run.start() + part.start(), run.start() + part.end(), _ALL_WORDS.get(part[0].lower(), part[0])))
        if n + 1 < len(parts):
            edits.append((run.start() + part.end(), run.start() + parts[n + 1].start(), ""))
    return edits


def disguised(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the normalised text shows, in source characters; none lies inside a base span, but one
    may hold base spans, which are fragments of it."""
    normal = Normalised(text)
    if not normal.changed:
        return []
    found: list[tuple[int, int, int]] = []
    base_ends: list[tuple[int, int]] = []  # starts of base spans in order, and the farthest end so far
    for start, _, end in base:
        base_ends.append((start, max(end, base_ends[-1][1] if base_ends else 0)))
    done = 0  # the farthest end of what is found; starts are in order
    for start, kind, end in identifiers(normal.text):
        begin, stop = normal.source(start, end)
        before = bisect_right(base_ends, (begin, len(text))) - 1
        # A card or address made of rewritten digits only counts once, under the first kind that takes it.
        if begin >= done and (before < 0 or base_ends[before][1] < stop):
            found.append((begin, kind, stop))
            done = stop
    return found


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def examine(text: str) -> tuple:
    base = identifiers(text)
    added = disguised(text, base)
    counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
    digest = hashlib.sha256(_listed(base).encode()).hexdigest()
    return *counts, digest, _listed(sorted(base + added)), len(added)


FIELDS = T.StructType()
for _name in ("n_email", "n_ip", "n_card", "n_phone"):
    FIELDS.add(_name, T.LongType())
FIELDS.add("base_sha256", T.StringType()).add("spans", T.StringType()).add("n_disguised", T.LongType())


@F.pandas_udf(FIELDS)
def _examined(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([examine(t) for t in texts], columns=FIELDS.names)


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, the number of base spans per kind, the digest of the base spans,
    all spans (base and disguised, ``kind:start:end`` by start and kind) and the number of disguised ones.

    Offsets count code points of the source text, ends exclusive. A NULL text counts as empty and has no
    spans, a NULL id stays NULL, repeated rows give repeated results, an empty table an empty one. Texts
    are never cut; every pattern runs in time linear in the text. Other columns are not carried over.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), _examined(whole_text(text_col)).alias("found"))
    return found.select("doc_id", "found.*")
