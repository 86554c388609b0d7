"""Main text of web pages by comparing each page with its neighbours on the host.

The pages of a host are ordered by URL path; pages of the same lines count as one. The text lines of every page
are aligned with those of the page before and of the page after by a longest common subsequence; lines in
common are template and are deleted. Markup settles only what it names: menus, footers, forms and the like are
no text; lines in ``article`` or ``main`` are not deleted, as articles quote each other; and where these hold
most of what is left of a page, they are the text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, landed, whole_text

# ---------------------------------------------------------------------------
# Elements of HTML and the names pages give to what is not their article.
# ---------------------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes".split())
SKIPPED = frozenset(
    "head nav footer aside form script style noscript template svg math iframe object button select textarea title dialog "
    "menu canvas audio video map xmp noembed noframes datalist".split()
)
ARTICLE = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
NAMES = frozenset(
    "nav navbar navigation menu masthead footer sidebar aside ad ads advert adverts advertisement banner cookie cookies "
    "consent gdpr notice popup modal overlay newsletter subscribe subscription promo promotion sponsor sponsored share "
    "sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments disqus reply replies "
    "respond login signup search toolbar".split()
)
#: In a name next to one of NAMES: the element stands beside that part or holds it.
BESIDE = frozenset("has no with without content body main article".split())
# ---------------------------------------------------------------------------

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_REST = re.compile(r"""(?:[^"'>]|"[^"]*"|'[^']*')*+>""")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/>]))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z0-9]+")
_WHITE = re.compile(r"\s+")


def _named(tag: str, rest: str, in_article: bool) -> bool:
    """Whether an element is named as something other than the article."""
    if tag == "header":
        return not in_article
    if tag in SKIPPED:
        return True
    if "=" not in rest and "hidden" not in rest or tag in ("html", "body"):
        return False
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            return True
        if name in ("class", "id"):
            for part in value.split():
                words = set(_WORDS.findall(part))
                if words & (NAMES if in_article else NAMES | {"header"}) and not words & BESIDE:
                    return True
    return False


def lines(page: str) -> list[tuple[str, bool, bool]]:
    """(text, in an article, named as something else) of the blocks of a page that have text."""
    found: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []
    open_tags: Counter[str] = Counter()
    article = skipped = False
    quotes_close = True

    def close_block() -> None:
        if parts:
            text = _WHITE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                found.append((text, article and not skipped, skipped))
            parts.clear()

    def pop(tag: str) -> None:
        nonlocal article, skipped
        while stack:
            name, article, skipped = stack.pop()
            open_tags[name] -= 1
            if name == tag:
                return

    at, end = 0, len(page)
    while at < end:
        less = page.find("<", at)
        if less < 0:
            parts.append(page[at:])
            break
        if less > at:
            parts.append(page[at:less])
        following = page[less + 1 : less + 2]
        if following in ("!", "?"):
            mark = "-->" if page.startswith("!--", less + 1) else ">"
            close = page.find(mark, less + 2)
            at = end if close < 0 else close + len(mark)
            continue
        closing = following == "/"
        name = _NAME.match(page, less + 1 + closing)
        if name is None:
            parts.append("<")
            at = less + 1
            continue
        rest = _REST.match(page, name.end()) if quotes_close else None
        if rest is None:
            # A quote is never closed: from here on tags end at the first mark.
            quotes_close = False
            close = page.find(">", name.end())
            if close < 0:
                parts.append(page[less:])
                break
            at = close + 1
        else:
            at = rest.end()
        tag, body = name[0].lower(), page[name.end() : at]
        if tag in VOID:
            if tag == "hr":
                close_block()
            else:
                parts.append(" " if tag == "br" else "")
            continue
        if closing:
            if open_tags[tag]:
                if tag not in INLINE or skipped:
                    close_block()
                pop(tag)
            continue
        named = not skipped and _named(tag, body, article)
        if tag not in INLINE or named:
            close_block()
            if open_tags["p"] and tag not in INLINE and tag not in SKIPPED:
                _end_paragraph(stack, pop)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = end if close is None else page.find(">", close.end()) + 1 or end
            continue
        if body.endswith("/>") and tag not in INLINE and tag in ("svg", "math", "path"):
            continue
        stack.append((tag, article, skipped))
        open_tags[tag] += 1
        article = article or tag in ARTICLE and not skipped
        skipped = skipped or named
    close_block()
    return found


def _end_paragraph(stack: list[tuple[str, bool, bool]], pop) -> None:
    """A block ends a paragraph that is still open, with what is open inside of it."""
    for place in range(len(stack) - 1, -1, -1):
        tag = stack[place][0]
        if tag == "p":
            pop("p")
            return
        if tag not in INLINE:
            return


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Per element of ``a`` the bits of ``b``: 0 where the common subsequence grows (bit-parallel)."""
    places: dict[int, int] = {}
    for n, value in enumerate(b):
        places[value] = places.get(value, 0) | 1 << n
    full = (1 << len(b)) - 1
    row = full
    for value in a:
        step = row & places.get(value, 0)
        row = ((row + step) | (row - step)) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the common subsequence of ``a`` with every beginning of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def common(a: list[int], b: list[int], cells: int = 1 << 30) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of ``a`` and ``b``, in memory for ``cells`` bits."""
    if len(a) * len(b) > cells and len(a) > 1:
        half = len(a) // 2
        split = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
        return common(a[:half], b[:split], cells) + [(i + half, j + split) for i, j in common(a[half:], b[split:], cells)]
    rows = list(_rows(a, b))
    i, j, pairs = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if i and not rows[i - 1] >> (j - 1) & 1:
            continue
        j -= 1
        pairs.append((i, j))
    return pairs[::-1]


def shared_lines(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Places of the lines of two pages (see :func:`_hashes`) that are template: those in common, unless the pages
    are equal. Only open lines are told, for of the others none is deleted."""
    words = (a >> 1, b >> 1)
    both = np.intersect1d(*words)
    if not len(both) or np.array_equal(*words):
        return [], []
    places = [np.flatnonzero(np.isin(side, both)) for side in words]
    pairs = common(words[0][places[0]].tolist(), words[1][places[1]].tolist())
    one, two = [int(places[0][i]) for i, _ in pairs], [int(places[1][j]) for _, j in pairs]
    return [n for n in one if a[n] & 1], [n for n in two if b[n] & 1]


def _hashes(found: list[tuple[str, bool, bool]]) -> np.ndarray:
    """A number per line. Equal lines have equal ones but for the last bit, which is set for open lines: those that
    markup puts neither into the article nor beside it."""
    return np.array([xxhash.xxh64_intdigest(text) >> 2 << 1 | (not inside and not named) for text, inside, named in found], dtype=np.int64)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _line_hashes(pages: pd.Series) -> pd.Series:
    return pd.Series([_hashes(lines(p)) for p in pages], dtype=object)


@F.pandas_udf(T.StructType().add("a", T.ArrayType(T.IntegerType())).add("b", T.ArrayType(T.IntegerType())))
def _aligned(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    pairs = [shared_lines(np.asarray(x, np.int64), np.asarray(y, np.int64)) for x, y in zip(a, b, strict=True)]
    return pd.DataFrame(pairs, columns=["a", "b"])


@F.pandas_udf(T.StringType())
def _main_text(pages: pd.Series, shared: pd.Series) -> pd.Series:
    out = []
    for page, places in zip(pages, shared, strict=True):
        gone = set() if places is None else set(places)
        found = [(text, inside) for n, (text, inside, named) in enumerate(lines(page)) if inside or not named and n not in gone]
        article = [text for text, inside in found if inside]
        if 2 * sum(map(len, article)) < sum(len(text) for text, _ in found):
            article = [text for text, _ in found]
        out.append("\n\n".join(article))
    return pd.Series(out, dtype=object)


ALIGNED = (
    T.StructType()
    .add("key", T.StringType())
    .add("host", T.StringType())
    .add("path", T.StringType())
    .add("shared", T.ArrayType(T.IntegerType()))
    .add("edge", T.BooleanType())
    .add("lines", T.ArrayType(T.LongType()))
)


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Neighbouring rows of a sorted partition aligned; its first and last row go out with their lines."""
    before: dict | None = None
    first = True
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            now = {"key": row.key, "host": row.host, "path": row.path, "shared": [], "edge": first, "lines": np.asarray(row.lines, dtype=np.int64)}
            first = False
            if before is not None:
                if before["host"] == now["host"]:
                    a, now["shared"] = shared_lines(before["lines"], now["lines"])
                    before["shared"] = before["shared"] + a
                rows.append(before if before["edge"] else before | {"lines": None})
            before = now
        if rows:
            yield pd.DataFrame(rows, columns=ALIGNED.names)
    if before is not None:
        yield pd.DataFrame([before | {"edge": True}], columns=ALIGNED.names)


def template_lines(pages: DataFrame) -> DataFrame:
    """key, shared: the places of template lines of ``pages`` (key, url, html) that have any.

    Pages are sorted over all hosts by ranges, so a host of any size is many tasks. Where a range ends,
    its last page meets the first page of the next one in a second step over two rows per range.
    """
    url = F.coalesce("url", F.lit(""))
    after = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://"
    host = F.lower(F.regexp_extract(url, after + r"([^/?#]*)", 1)).alias("host")
    path = F.regexp_replace(F.regexp_replace(url, after + r"[^/?#]*", ""), r"[?#].*$", "").alias("path")
    every = pages.select("key", host, path, _line_hashes("html").alias("lines"))
    every = landed(every.withColumn("page", F.unhex(F.md5(F.to_json("lines")))), "lines")
    # Pages of the same lines are one, at the first of their places.
    first = F.min(F.struct("path", "key")).alias("_first")
    found = every.groupBy("host", "page", "lines").agg(first).select("_first.key", "host", "_first.path", "lines", "page")
    found = landed(found, "different")
    ordered = found.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")
    aligned = landed(ordered.select("key", "host", "path", "lines").mapInPandas(_align, ALIGNED), "aligned")
    # At most two rows per range.
    order = Window.orderBy("host", "path", "key")
    edges = aligned.where("edge").select("key", "host", "lines", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("key", "host", "lines")])
    # Rows of one range may be neighbours here, too: to align them again finds the same lines or, if other
    # pages lie between them, lines they have in common all the same.
    edges = edges.where("host = next_host").select("key", "next_key", _aligned("lines", "next_lines").alias("s"))
    more = edges.select(F.explode(F.array(F.struct("key", F.col("s.a").alias("shared")), F.struct(F.col("next_key").alias("key"), F.col("s.b").alias("shared")))).alias("e"))
    marks = aligned.select("key", "shared").unionByName(more.select("e.*")).where(F.size("shared") > 0)
    marks = marks.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("shared"))).alias("shared"))
    # Back to all pages of the same lines.
    marks = landed(found.select("key", "host", "page").join(marks, "key").drop("key"), "marks")
    out = landed(every.select("key", "host", "page").join(marks, ["host", "page"]).select("key", "shared"), "shared").distinct()
    for done in (every, found, aligned, marks):
        discard(done)
    return out


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: a row per row of ``pages``.

    Blocks are joined by two line ends, white space in a block is one space, character references are
    decoded. A NULL html is empty and gives an empty text; pages without URL are the pages of one host;
    NULL ids and urls stay NULL; repeated rows, and pages of the same lines on one host, give the same text; an
    empty table gives an empty one. Other columns do not matter.
    """
    html = whole_text(f"`{html_col}`")
    held = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"))
    name = F.concat_ws("|", F.col("page_id").cast("string"), F.xxhash64("url", "html").cast("string"))
    held = held.withColumn("key", name)
    shared = landed(template_lines(held), "shared").withColumnRenamed("key", "_key")
    joined = held.join(shared, F.col("key") == F.col("_key"), "left")
    texts = joined.select("page_id", "url", _main_text("html", "shared").alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
