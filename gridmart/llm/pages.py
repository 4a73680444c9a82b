"""Main text of web pages: nearest-URL page differencing, together with the page's own structure.

A page is cut into lines (the text of its blocks, white space collapsed, references decoded). Pages of a
host are ordered by URL path, and each is paired with the neighbour whose path has more in common with
its own. The lines of both are aligned by their longest common subsequence, and of the shared lines those
are deleted that their place does not speak for: what two neighbouring pages have in common is the template.

Differencing alone cannot give right results: a menu that differs from page to page stays,
and a sentence of the article that the neighbour also has goes. So lines are also told apart by markup:

* ``main``: inside ``<article>``, ``<main>`` or their ARIA / microdata equivalents: kept, shared or not,
  for sentences of articles recur on neighbouring pages, also as their first or last line;
* ``links``: in such an element too, but a line of nothing but links: deleted where it is shared with the
  neighbour (a menu), unless that leaves nothing;
* ``boiler``: inside menus, headers, footers, sidebars, forms, notices, adverts, comments, or hidden: dropped;
* ``other``: everything else, with articles outside a ``<main>`` that has lines (teasers). It is dropped
  where the page has main lines; on a page without any, it is the text, after the lines shared with the neighbour were deleted (unless that leaves nothing, as with
  copies of a page).

Distribution: a first job over ``page_id`` and ``url`` only orders the pages; the first and last row of
each of its ranges (bounded by the number of ranges) become the bounds. Then each page is parsed once and
sent to its range, the first and last page of a range also to the range beside it, and a streaming pass
over sorted rows holds three pages at a time. A host with a third of all pages covers many ranges.

Defined cases: a null html gives an empty text; a page without URL has no neighbour; pages of equal URL
are ordered by id; unclosed tags, quotes and comments end where HTML lets them; an empty table gives an
empty result; input columns beside page_id, url and html are not read.
"""

from __future__ import annotations

import bisect
import html as html_lib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import parts, prepare

ROWS_PER_RANGE = 3000
NO_ID = -(1 << 63)
LINKS, MAIN, OTHER = 2, 1, 0
WHOLE = 3  # kind of a <main> element; its lines are MAIN or LINKS
#: Bits of the alignment table that are kept at once; longer pairs are halved (Hirschberg).
TABLE_BITS = 1 << 28

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
#: One attribute: its whole name, and its value if it has one.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
_SPACE = re.compile(r"\s+")
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")

RAW = frozenset("script style noscript template svg annotation annotation-xml iframe object textarea title select option button canvas audio video".split())
BOILER_TAGS = frozenset("nav header footer aside form menu dialog head fieldset".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr math semantics mi mn mo mrow ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd mstyle "
    "mpadded mphantom mspace menclose merror mmultiscripts mprescripts".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that the next block ends when their end tag is missing (a paragraph in any case).
LOOSE = frozenset("p li dt dd".split())
MAIN_TAGS = frozenset(("article", "main"))
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Words that mark boilerplate: a class or an id made of one or more of them, and of words for places only.
BOILER_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar footer header masthead banner cookie cookies consent gdpr notice ad ads "
    "advert adverts advertisement adsense sponsor sponsored promo promotion social share sharing related recommended newsletter subscribe signup "
    "login popup modal overlay widget toolbar pagination pager comment comments commentlist disqus reply replies response responses onetrust".split()
)

PLACE_WORDS = frozenset(
    "area bar bottom box block button buttons container content desktop global group inner item items left link links list main mobile outer page panel post "
    "posts primary reader readers row sdk secondary section site slot text title top right unit user users visitor visitors wrap wrapper".split()
)


def _attributes(text: str) -> dict[str, str]:
    """Names (in lower case) and values of a tag's attributes; the first of a name counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value.strip("\"'").strip())
    return found


def _boiler(name: str) -> bool:
    words = set(re.split(r"[-_\d]+", _HUMP.sub("-", name).lower())) - {""}
    return bool(words & BOILER_WORDS) and words <= BOILER_WORDS | PLACE_WORDS


def _kind(tag: str, attributes: str) -> int | None:
    """WHOLE, MAIN, -1 for boilerplate, or None for neither."""
    found = _attributes(attributes)
    role = found.get("role", "").lower()
    names = f"{found.get('class', '')} {found.get('id', '')}".split() if tag not in ("html", "body", "main") else []
    if tag in BOILER_TAGS or role in BOILER_ROLES or any(map(_boiler, names)):
        return -1
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "").lower()):
        return -1
    if tag == "main" or role == "main":
        return WHOLE
    if tag in MAIN_TAGS or role == "article" or found.get("itemprop", "").lower() == "articlebody":
        return MAIN
    return None


def _tags(page: str) -> Iterator[tuple[int, int, bool, str | None, str, bool, bool]]:
    """(start, end, closing, name, attributes, empty, raw) of each tag; a raw element with its content is one, a comment has no name."""
    at = 0
    while token := _TOKEN.search(page, at):
        at = token.end()
        closing, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        tag = tag and tag.lower()
        empty = tag is not None and (tag in VOID or attributes.rstrip().endswith("/") and tag not in RAW)
        raw = not closing and tag in RAW and not empty
        if raw:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif tag in ("script", "style", "textarea", "title"):
                at = len(page)
        yield token.start(), at, bool(closing), tag, attributes, empty, raw


class _Ends:
    """Tells whether an element's end tag is missing; looks through the page once, when first asked."""

    def __init__(self, page: str):
        self.page, self.tags = page, None

    def missing(self, tag: str, at: int, around: int) -> bool:
        """Of the element whose start tag ends at ``at``, inside ``around`` open ones of its name."""
        if self.tags is None:
            self.tags = {}
            for _, end, closing, name, _, empty, raw in _tags(self.page):
                if name is not None and not empty and not raw:
                    places, depths = self.tags.setdefault(name, ([], []))
                    places.append(end)
                    depths.append((depths[-1] if depths else 0) + (-1 if closing else 1))
            for _, depths in self.tags.values():
                least = list(itertools.accumulate(reversed(depths), min))
                depths[:] = zip(depths, reversed(least), strict=True)
        places, depths = self.tags[tag]
        here, least = depths[bisect.bisect_left(places, at)]
        return least > here - 1 - around


def page_lines(page: str | None) -> tuple[list[str], list[int]]:
    """The lines of a page outside boilerplate, in page order, and the zone of each."""
    lines: list[str] = []
    zones: list[int] = []
    held: list[str] = []
    whole: list[bool] = []  # the line is in a <main>
    open_main: list[list] = []  # [tag, depth of that tag, is a <main>]
    skip: list | None = None  # [tag, depth of that tag, end of its start tag]
    around: dict[str, int] = {}  # open elements of a name, outside what is skipped
    link = linked = plain = False  # in a link; the line has text in links, and text outside

    def flush() -> None:
        nonlocal link, linked, plain
        text = _SPACE.sub(" ", html_lib.unescape("".join(held))).strip()
        held.clear()
        if text:
            lines.append(text)
            zones.append((LINKS if linked and not plain else MAIN) if open_main else OTHER)
            whole.append(any(is_whole for _, _, is_whole in open_main))
        link = linked = plain = False

    def hold(text: str) -> None:
        nonlocal linked, plain
        held.append(text)
        if not plain and re.search(r"\w", html_lib.unescape(text)):
            linked, plain = linked or link, not link

    page, at = page or "", 0
    ends = _Ends(page)
    for start, end, closing, tag, attributes, empty, raw in _tags(page):
        if skip is None:
            hold(page[at:start])
        at = end
        if tag is None:
            continue
        if raw:
            if skip is None and tag not in INLINE:
                held.append(" ")
            continue
        if tag not in INLINE and skip is None:
            flush()
        if tag == "a":
            link = not closing and skip is None and "href" in _attributes(attributes)
        if empty:
            continue
        if skip is not None:
            if closing:
                if tag == skip[0]:
                    skip[1] -= 1
                    if not skip[1]:
                        skip = None
                continue
            loose = skip[0] in LOOSE and tag not in INLINE
            again = tag in MAIN_TAGS and not open_main and _kind(tag, attributes) in (MAIN, WHOLE)
            if not (loose and skip[0] == "p" or (loose or again) and ends.missing(skip[0], skip[2], around.get(skip[0], 0))):
                skip[1] += tag == skip[0]
                continue
            skip = None  # the element was never closed
        if closing:
            around[tag] = max(0, around.get(tag, 0) - 1)
            for k in range(len(open_main) - 1, -1, -1):
                if open_main[k][0] == tag:
                    open_main[k][1] -= 1
                    if not open_main[k][1]:
                        del open_main[k:]
                    break
            continue
        kind = _kind(tag, attributes)
        if kind == -1:
            flush()
            skip = [tag, 1, at]
            continue
        around[tag] = around.get(tag, 0) + 1
        if kind in (MAIN, WHOLE):
            open_main.append([tag, 1, kind == WHOLE])
        elif open_main and open_main[-1][0] == tag:
            open_main[-1][1] += 1
    if skip is None:
        hold(page[at:])
        flush()
    if any(inside and zone == MAIN for inside, zone in zip(whole, zones, strict=True)):
        zones = [zone if inside else OTHER for inside, zone in zip(whole, zones, strict=True)]
    return lines, zones


# ---- alignment -------------------------------------------------------------------------------


def _rows(a: list, b: list) -> Iterator[int]:
    """After each item of ``a`` a bit set: bit j is 0 where b[j] makes the common subsequence longer."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the common subsequence of ``a`` and each prefix of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def shared_lines(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    in_b, in_a = set(b), set(a)
    at = [i for i, x in enumerate(a) if x in in_b]
    return [at[i] for i in _align([a[i] for i in at], [x for x in b if x in in_a])]


def _align(a: list, b: list) -> list[int]:
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    found, a, b = list(range(head)), a[head:], b[head:]
    if not a or not b:
        return found
    if len(a) * len(b) > TABLE_BITS and len(a) > 1:
        half = len(a) // 2
        left = _lengths(a[:half], b)
        right = _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int(np.argmax(left + right))
        return found + [head + i for i in _align(a[:half], b[:cut])] + [head + half + i for i in _align(a[half:], b[cut:])]
    table = list(_rows(a, b))
    i, j, tail = len(a), len(b), []
    while i and j:
        if table[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not (i and not table[i - 1] >> (j - 1) & 1):
            j -= 1
            tail.append(head + i)
    return found + tail[::-1]


# ---- pairing ---------------------------------------------------------------------------------

_URL = re.compile(r"^[a-z][a-z0-9+.-]*://([^/?#]*)([^?#]*)", re.I)


def url_key(url: str | None, page_id: int | None) -> tuple[str, str, str, int]:
    """Order of pages: host, path, whole URL, id."""
    found = _URL.match(url or "")
    host, path = (found[1].lower(), found[2]) if found else ("", "")
    return host, path, url or "", NO_ID if page_id is None else page_id


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def nearer(before: tuple | None, own: tuple, after: tuple | None) -> int:
    """-1, 1 or 0: the neighbour of the same host whose path shares the longer head; the one before on ties."""
    near = [(_common(own[1], x[1]), side) for x, side in ((before, -1), (after, 1)) if x and own[0] and x[0] == own[0]]
    return max(near, key=lambda x: (x[0], -x[1]))[1] if near else 0


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    first = last = None
    for rows in batches:
        if len(rows):
            first = first or tuple(rows.iloc[0])
            last = tuple(rows.iloc[-1])
    yield pd.DataFrame([first, last] if first else [], columns=["host", "path", "url", "id"])


def _ranges(pages: DataFrame) -> list[tuple[tuple, tuple]]:
    """(first, last) key of each range of pages, in order; reads ids and URLs only."""

    @F.pandas_udf("host string, path string, url string, id long")
    def keys(urls: pd.Series, ids: pd.Series) -> pd.DataFrame:
        made = [url_key(u, None if pd.isna(i) else int(i)) for u, i in zip(urls, ids, strict=True)]
        return pd.DataFrame(made, columns=["host", "path", "url", "id"])

    slim = pages.select(keys(F.col("url").cast("string"), F.col("page_id").cast("long")).alias("k")).select("k.*")
    n = parts(pages.count(), ROWS_PER_RANGE)
    order = ["host", "path", "url", "id"]
    edges = slim.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInPandas(_edges, "host string, path string, url string, id long")
    found = sorted(tuple(r) for r in edges.collect())
    return list(zip(found[::2], found[1::2], strict=True))


def _parse(ranges: list[tuple[tuple, tuple]]):
    firsts = [first for first, _ in ranges]
    lasts = [last for _, last in ranges]
    names = ["part", "host", "path", "url_key", "id", "guest", "page_id", "url", "zones", "lines", "hashes"]
    types = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    types += [pa.list_(pa.string()), pa.list_(pa.int64())]

    def run(batches):
        import xxhash

        for batch in batches:
            out = []
            for page_id, url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                key = url_key(url, page_id)
                lines, zones = page_lines(page.as_py())
                main = [x for x, z in zip(lines, zones, strict=True) if z != OTHER]
                hashes = [xxhash.xxh64_intdigest(x.encode("utf-8", "replace")) - (1 << 63) for x in lines]
                part = max(0, bisect.bisect_right(firsts, key) - 1)
                out.append((part, *key, False, page_id, url, bytes(zones), main or lines, hashes))
                if key == firsts[part] and part:
                    out.append((part - 1, *key, True, page_id, url, None, None, hashes))
                if key == lasts[part] and part + 1 < len(firsts):
                    out.append((part + 1, *key, True, page_id, url, None, None, hashes))
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def _text(before: tuple | None, own: tuple, after: tuple | None) -> str:
    """The text of ``own``; rows are (part, key, guest, page_id, url, zones, lines, hashes),
    where the lines are those of the main zones, or all on a page without any."""
    side = nearer(before and before[1], own[1], after and after[1])
    pair = {-1: before, 1: after}.get(side)
    shared = set(shared_lines(own[7], pair[7])) if pair else set()
    main = [i for i, zone in enumerate(own[5]) if zone != OTHER]
    kept = [x for i, x in zip(main or range(len(own[6])), own[6], strict=True) if i not in shared or own[5][i] == MAIN]
    return " ".join(kept or own[6])


def _difference(batches):
    window: list = []  # up to two rows: the one before, and the one whose next is awaited

    def done(after) -> list:
        if not window or window[-1][2]:
            return []
        before, own = (window[-2] if len(window) > 1 else None), window[-1]
        if before and before[0] != own[0]:
            before = None
        text = _text(before, own, after if after and after[0] == own[0] else None)
        return [(own[3], own[4], text, len(text))]

    for batch in _with_end(batches):
        out = []
        if batch is None:
            out += done(None)
        else:
            for r in batch.to_pylist():
                key = (r["host"], r["path"], r["url_key"], r["id"])
                row = (r["part"], key, r["guest"], r["page_id"], r["url"], r["zones"], r["lines"], r["hashes"])
                out += done(row)
                window = [*window[-1:], row]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        types = (pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["page_id", "url", "text", "n_chars"]
        )


def _with_end(batches):
    yield from batches
    yield None


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    prepare(pages.sparkSession)
    ranges = _ranges(pages)
    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    schema = (
        "part int, host string, path string, url_key string, id long, guest boolean, page_id long, url string, zones binary, "
        "lines array<string>, hashes array<long>"
    )
    parsed = slim.mapInArrow(_parse(ranges), schema)
    order = ["part", "host", "path", "url_key", "id", "guest"]
    dealt = parsed.repartition(max(1, len(ranges)), "part").sortWithinPartitions(*order)
    return dealt.mapInArrow(_difference, "page_id long, url string, text string, n_chars long")
