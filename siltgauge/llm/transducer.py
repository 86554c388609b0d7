"""BPE encoding and decoding as transducers of constant memory.

A text goes through in pieces. Its normal form is taken up to the last place where nothing can join back, its
words up to the last place where no word can go on, and a word that does not end goes into an open word. There,
what further letters can change of the merges reaches back a bounded way only, the lookahead of the merge list;
tokens that end before that are final and leave. Decoding takes tokens as they come; bytes that end inside a
character wait for the next token.

What has to be held of a text is thus a piece, the lookahead, and a run of combining marks, which the normal
form has to put in order as a whole.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import whole_text
from .tokens import byte_letters

#: White space, as a class: fixed, because libraries differ in what they take for it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The words of this kind of vocabulary; a fixed value that has to equal the one in the file.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_WORD = regex.compile(WORDS.replace(r"\s", SPACE))
_SPACES = re.compile(f"[{SPACE}]+")
#: What goes on with a word that has begun with letters or with other marks.
_LETTERS, _OTHERS = regex.compile(r"\p{L}*"), regex.compile(rf"[^{SPACE}\p{{L}}\p{{N}}]*")

#: Characters that go in at a time, that may wait without a space, and symbols that an open word takes up at a time.
PIECE, HOLD, STEP = 1 << 16, 1 << 12, 1 << 11
#: Symbols up to which looking through all pairs beats a heap.
SHORT = 40
#: Words that a worker remembers.
MEMORY = 400_000


class Merges:
    """The merge list of a vocabulary file of the tokenizers library, and how far back it can look."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        words = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if words != WORDS or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or model.get("unk_token"):
            raise ValueError(f"{path} is no vocabulary of the kind that this module reads.")
        self.suffix: str = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {rule: n for n, rule in enumerate(self.rules)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = byte_letters()

    def tokens(self, symbols: Iterable[str]) -> list[str]:
        """What the merges leave of the symbols: lowest rank first, of equal ones the leftmost."""
        parts: list[str | None] = list(symbols)
        n, rank = len(parts), self.ranks.get
        if n <= SHORT:
            return self._short(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or rank((parts[i], parts[j])) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return [p for p in parts if p is not None]

    def _short(self, parts: list[str]) -> list[str]:
        """The same for few symbols, of which all ranks are looked through for the lowest."""
        rank = self.ranks.get
        none = len(self.ranks)
        found = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while found and (lowest := min(found)) < none:
            i = found.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i < len(found):
                found[i] = rank((parts[i], parts[i + 1]), none)
            if i:
                found[i - 1] = rank((parts[i - 1], parts[i]), none)
        return parts

    def symbols(self, word: str, last: bool = True) -> list[str]:
        """The byte letters of a word; with the mark of its end on the last one."""
        letters = list(word) if word.isascii() and word.isalpha() else [self.letters[b] for b in word.encode()]
        if last and letters:
            letters[-1] += self.suffix
        return letters

    def lookahead(self) -> int:
        """After how many further symbols a border between tokens is final.

        Compare the merges of a prefix with those of a longer text. Where they differ first, a merge (l, r) was
        done in one of them only; then by an earlier rule, one place in l, in r or at their ends differs already:
        that rule's left part ends there and lies in r, or its right part starts there and lies in l, for
        otherwise the place between l and r would have been merged before. So differences come from the end of
        the prefix by rules of falling rank, each at most as far to the right as r goes. ``far`` is the longest
        such way from a rule on; rules are taken by rank, so all rules it can go on with are known.
        """
        made = {letter + end for letter in self.letters.values() for end in ("", self.suffix)}
        by_left: dict[str, int] = {}
        by_right: dict[str, int] = {}
        most = 0

        def plain(token: str) -> str:
            # One character per symbol.
            if token.endswith(self.suffix) and len(token) > len(self.suffix):
                token = token[: -len(self.suffix)]
                return token[:-1] + chr(ord(token[-1]) + 0x10000)
            return token

        for left, right in self.rules:
            if left not in made or right not in made:
                raise ValueError(f"The merge of {left} and {right} comes before its parts, so there is no bound.")
            made.add(left + right)
            one, two = plain(left), plain(right)
            far = len(two)
            for start in range(len(two)):
                for end in range(start + 1, len(two) + 1):
                    far = max(far, end + by_left.get(two[start:end], -end))
            for start in range(len(one)):
                for end in range(start + 1, len(one) + 1):
                    far = max(far, by_right.get(one[start:end], 0) - (len(one) - start))
            by_left[one] = max(by_left.get(one, 0), far)
            by_right[two] = max(by_right.get(two, 0), far)
            most = max(most, far)
        return most


class OpenWord:
    """The tokens of one word that comes in parts, final ones first."""

    def __init__(self, merges: Merges, lookahead: int) -> None:
        self.merges, self.lookahead = merges, lookahead
        self.waiting: list[str] = []

    def feed(self, part: str) -> list[str]:
        out: list[str] = []
        self.waiting += self.merges.symbols(part, last=False)
        # The last symbol may be the end of the word, so it is not looked at yet.
        while len(self.waiting) > self.lookahead + 2 * STEP:
            seen = self.lookahead + STEP
            done = 0
            for token in self.merges.tokens(self.waiting[:seen]):
                if done + len(token) >= STEP:
                    break
                out.append(token)
                done += len(token)
            del self.waiting[:done]
        return out

    def close(self) -> list[str]:
        if self.waiting:
            self.waiting[-1] += self.merges.suffix
        out, self.waiting = self.merges.tokens(self.waiting), []
        return out


class _Words(dict):
    """Token ids of a whole word."""

    def __init__(self, merges: Merges) -> None:
        super().__init__()
        self.merges = merges

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.merges.ids[t] for t in self.merges.tokens(self.merges.symbols(word)))
        if len(self) < MEMORY and len(word) < 64:
            self[word] = found
        return found


@cache
def joining() -> frozenset[str]:
    """A few hundred characters that the normal form may put together with those before them."""
    found = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for c in map(chr, range(sys.maxunicode + 1)):
        if unicodedata.combining(c):
            found.add(c)
        parts = unicodedata.decomposition(c).split(" ")
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


def normal(text: str) -> str:
    """Normal form C, white space as spaces, lower case by character."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() knows a final sigma
    return _SPACES.sub(" ", text).lower()


class Encoder:
    """Token ids of one text after another, each fed in pieces and finished."""

    def __init__(self, merges: Merges, lookahead: int, back: frozenset[str] | None = None) -> None:
        self.merges, self.lookahead = merges, lookahead
        self.back = joining() if back is None else back
        self.words = _Words(merges)
        self.start()

    def start(self) -> None:
        """A new text begins, whatever became of the one before."""
        self.raw = self.text = ""
        self.open: OpenWord | None = None
        self.going = _LETTERS

    def feed(self, piece: str) -> list[int]:
        self.raw += piece
        end = len(self.raw) - 1
        while end > 0 and self.raw[end] in self.back:
            end -= 1
        if end <= 0:
            return []
        done, self.raw = self.raw[:end], self.raw[end:]
        return self._take(normal(done))

    def finish(self) -> list[int]:
        done, self.raw = self.raw, ""
        return self._take(normal(done), last=True)

    def _ids(self, tokens: Iterable[str]) -> list[int]:
        return [self.merges.ids[t] for t in tokens]

    def _take(self, text: str, last: bool = False) -> list[int]:
        out: list[int] = []
        text = self.text + text
        self.text = ""
        if self.open is not None:
            end = self.going.match(text).end()
            out += self._ids(self.open.feed(text[:end]))
            if end == len(text) and not last:
                return out
            out += self._ids(self.open.close())
            self.open, text = None, text[end:]
        # No word holds a space.
        end = len(text) if last else text.rfind(" ") + 1
        out += chain.from_iterable(map(self.words.__getitem__, _WORD.findall(text[:end])))
        text = text[end:]
        if len(text) > HOLD:
            out += self._spaceless(text)
        else:
            self.text = text
        return out

    def _spaceless(self, text: str) -> list[int]:
        """Words that end before the last but one character are whole; the one after them stays open."""
        out: list[int] = []
        done = 0
        for match in _WORD.finditer(text):
            if match.end() > len(text) - 2:
                break
            out += self.words[match[0]]
            done = match.end()
        rest = text[done:]
        if len(rest) > HOLD:
            self.going = _LETTERS if _LETTERS.match(rest).end() else _OTHERS
            self.open = OpenWord(self.merges, self.lookahead)
            out += self._ids(self.open.feed(rest[:-2]))
            rest = rest[-2:]
        self.text = rest
        return out


class Decoder:
    """Ids back to text, as they come: as the library joins them, and as readable text."""

    def __init__(self, merges: Merges) -> None:
        byte_of = {letter: b for b, letter in merges.letters.items()}
        self.strings = {n: s for s, n in merges.ids.items()} | {n: s for s, n in merges.added.items()}
        self.bytes = {n: s.encode() for s, n in merges.added.items()}
        for string, n in merges.ids.items():
            body = string.removesuffix(merges.suffix) or string
            self.bytes[n] = bytes(byte_of[c] for c in body) + (b" " if body != string else b"")
        self.start()

    def start(self) -> None:
        """A new text begins."""
        self._characters = codecs.getincrementaldecoder("utf-8")("replace")
        self._first = True

    def joined(self, ids: list[int]) -> str:
        """What the library's decode adds for these ids: vocabulary strings, with a space between any two."""
        out = " ".join(map(self.strings.__getitem__, ids))
        if ids and not self._first:
            out = " " + out
        self._first = self._first and not ids
        return out

    def readable(self, ids: list[int], last: bool = False) -> str:
        """The characters that are complete with these ids; bytes that make none are replaced."""
        return self._characters.decode(b"".join(map(self.bytes.__getitem__, ids)), last)


def strange(path: str) -> str:
    """A pattern of the code points that this module may take otherwise than the library does.

    Both are asked for the normal form, the lower case and the class of every code point that is assigned here,
    and for every composition. Where they agree, no Unicode version changes what strings of them compose to.
    """
    library = Tokenizer.from_file(path)
    formed, cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
    letters = byte_letters()

    def same(text: str) -> bool:
        if formed(text) != normal(text):
            return False
        held = f"a{formed(text)}1"
        words = ["".join(letters[b] for b in w.encode()) for w in _WORD.findall(held)]
        return [w for w, _ in cut(held)] == words

    odd = set()
    for c in map(chr, range(sys.maxunicode + 1)):
        kind = unicodedata.category(c)
        if kind == "Cn" or kind != "Cs" and not same(c):
            odd.add(c)
        elif kind not in ("Cs", "Co") and unicodedata.decomposition(c) and not same(unicodedata.normalize("NFD", c)):
            odd |= {c, *unicodedata.normalize("NFD", c)}
    runs: list[list[int]] = []
    for c in sorted(map(ord, odd)):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]" if runs else "(?!)"


class Coder:
    """Whole texts to ids in pieces, with the strings that the library takes out first."""

    def __init__(self, path: str, lookahead: int, odd: str, back: frozenset[str] | None = None) -> None:
        self.merges = Merges(path)
        self.encoder = Encoder(self.merges, lookahead, back)
        self.odd = re.compile(odd)
        self.safe: set[str] = set()
        self.library = Tokenizer.from_file(path)
        added = sorted(self.merges.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def _strange(self, text: str) -> bool:
        new = set(text) - self.safe
        odd = {c for c in new if self.odd.match(c)}
        self.safe |= new - odd
        return bool(odd)

    def pieces(self, text: str) -> Iterator[list[int]]:
        """The ids of a text as the library gives them, some at a time.

        A text with a code point that :func:`strange` names goes through the library itself, as a whole.
        """
        if not text.isascii() and self._strange(text):
            yield self.library.encode(text, add_special_tokens=False).ids
            return
        for n, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if n % 2:
                yield [self.merges.added[part]]
                continue
            self.encoder.start()
            for start in range(0, len(part), PIECE):
                yield self.encoder.feed(part[start : start + PIECE])
            yield self.encoder.finish()


def _shared(path: str) -> tuple[int, str, frozenset[str]]:
    """What a coder has to know of the file and of Unicode: worked out once, by the driver."""
    return Merges(path).lookahead(), strange(path), joining()


@cache
def _coder(path: str, lookahead: int, odd: str, back: frozenset[str]) -> Coder:
    """One coder per worker: the words it remembers serve all tasks that the worker runs."""
    return Coder(path, lookahead, odd, back)


CODED = T.StructType().add("n_tokens", T.LongType())
for _name in ("ids_sha256", "decoded_sha256", "text_sha256"):
    CODED = CODED.add(_name, T.StringType())


def transcode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, text_sha256 for every row of ``docs``.

    ``path`` is a vocabulary file of the tokenizers library with marked word ends, under the same path on every
    machine. The digests are of the ids as little-endian 32-bit integers, of the text that the library's decode
    makes of them, and of the readable text that their bytes make. None of these ever stands as a whole: what is
    final goes into the digests. A NULL text counts as empty, a NULL id stays NULL, repeated rows give repeated
    results, an empty table an empty one. Texts are never cut off. Other columns do not matter.
    """
    known = _shared(path)

    @F.pandas_udf(CODED)
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = _coder(path, *known)
        decoder = Decoder(coder.merges)
        for texts in batches:
            rows = []
            for text in texts:
                decoder.start()
                n, hashes = 0, [hashlib.sha256() for _ in range(3)]
                for ids in coder.pieces(text):
                    n += len(ids)
                    hashes[0].update(np.array(ids, dtype="<u4").tobytes())
                    hashes[1].update(decoder.joined(ids).encode())
                    hashes[2].update(decoder.readable(ids).encode())
                hashes[2].update(decoder.readable([], last=True).encode())
                rows.append((n, *(h.hexdigest() for h in hashes)))
            yield pd.DataFrame(rows, columns=CODED.names)

    coded = code(whole_text(f"`{text_col}`")).alias("c")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), coded).select("doc_id", "c.*")


def encode(docs: DataFrame, path: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``ids`` (a caller's one is replaced); see :func:`transcode` for odd rows."""
    known = _shared(path)

    @F.pandas_udf("array<int>")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = _coder(path, *known)
        for texts in batches:
            yield pd.Series([np.fromiter(chain.from_iterable(coder.pieces(t)), dtype=np.int32) for t in texts], dtype=object)

    return docs.withColumn("ids", ids_of(whole_text(f"`{text_col}`")))


def decode(encoded: DataFrame, path: str, *, ids_col: str = "ids", readable: bool = True) -> DataFrame:
    """``encoded`` with a column ``decoded`` (a caller's one is replaced): the readable text of the ids, or what the
    library's decode makes of them. NULL ids count as none."""

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(Merges(path))
        for rows in batches:
            out = []
            for ids in rows:
                decoder.start()
                ids = [int(i) for i in ids]
                out.append(decoder.readable(ids, last=True) if readable else decoder.joined(ids))
            yield pd.Series(out, dtype=object)

    return encoded.withColumn("decoded", text_of(F.coalesce(F.col(f"`{ids_col}`"), F.array().cast("array<int>"))))
