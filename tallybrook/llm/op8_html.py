"""Main text of web pages, by deducing the template that pages of one host share.

A page is a sequence of tokens: its tags, told apart by their path, and its pieces of
text. Tokens that occur equally often in every page of a host, that is, whose vectors of
occurrences are equal, form an equivalence class. Classes that most pages have are kept
apart. The tags of the widest class that occurs once a page are the frame, in the order of
the host's reference page; a page that has them in another order, or not once, does not
follow the template. Other classes nest in the slots between them, by their paths.

Text tokens in a class are the template's own and go. The rest fills the slots. Going down
from the outermost element of the frame, the article is the element that holds all but a
twentieth of the filled-in text: the way down ends where the next element would lose a
heading or prose, or at an ``article`` element. What tag names and telling class names
mark as menus, adverts, comments and the like never counts. Pages of hosts with fewer than
three pages, and those that do not follow their template, are judged by tag names alone.

A vector is never built: equal sums of hashes of (page, count) stand for equal vectors, so
that a host of any size is summed task by task before it is shuffled.
"""

from __future__ import annotations

import functools
import html as html_module
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import as_text, sliced, stored

# A class is valid if this share of the host's pages, and so many, have its tokens.
LEAST_SHARE, LEAST_PAGES = 0.5, 3
_FLUSH = 200_000
# Share of the filled-in text that may be lost on the way to the article's element.
_LOST = 0.05

# Elements by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
LEFT_OUT = frozenset(
    "script style textarea title noscript iframe noembed xmp head nav aside footer form button select option "
    "template dialog svg math canvas object audio video map menu datalist fieldset".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p li blockquote pre td th dd dt figcaption".split())
REGIONS = frozenset(("article", "main"))
CLOSED_BY_PEERS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
# Words of class, id and role that mark what is not the article, and those that may stand with them.
LEFT_OUT_WORDS = frozenset(
    "nav navbar navigation menu menubar header masthead footer contentinfo sidebar complementary aside notice "
    "cookie cookies consent gdpr banner ad ads advert adverts advertisement advertising sponsor sponsored promo "
    "comment comments disqus respond replies reply share sharing social related breadcrumb breadcrumbs "
    "newsletter subscribe signup popup modal overlay login search widget toolbar pagination pager".split()
)
_WITH_THEM = frozenset(
    "area bar block body bottom box btn button buttons col column container content cover fixed form global group "
    "holder icon icons inline inner item items js left link links list main message outer page panel policy "
    "post posts primary right section secondary site slot small space sticky text title top unit user users wrap "
    "wrapper zone the 1 2 3 4".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([\w-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[\s_-]+")
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Block(NamedTuple):
    """A piece of text between block tags: where it stands, and what encloses it."""

    path: str
    tag: str
    text: str
    left_out: bool
    region: str


def host_of(url: str | None) -> str:
    """Host of a URL in lower case, empty if it tells none."""
    found = _HOST.match(url or "")
    return found.group(1).lower() if found else ""


class _Open(NamedTuple):
    tag: str
    path: str
    left_out: bool
    region: str


def _marks(tag: str, attributes: str) -> tuple[str, bool]:
    """First class of an element, and whether its attributes leave it out."""
    if not attributes or attributes.isspace():
        return "", False
    found = {n.lower(): a or b or c for n, a, b, c in _ATTRIBUTE.findall(attributes)}
    first = (found.get("class", "").split() or [""])[0].lower()
    if tag in ("html", "body", "article", "main"):
        return first, False
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    names = " ".join((found.get("class", ""), found.get("id", ""), found.get("role", ""))).lower().split()
    return first, hidden or any(map(_left_out_name, names))


@functools.lru_cache(maxsize=4096)
def _left_out_name(name: str) -> bool:
    """Whether a name is made of words that leave out: user-comments is, share-of-market is not."""
    words = [w for w in _SPLIT.split(name) if w]
    return any(w in LEFT_OUT_WORDS for w in words) and all(w in LEFT_OUT_WORDS or w in _WITH_THEM for w in words)


def blocks(page: str) -> Iterator[Block | str]:
    """The page's tokens in order: paths of tags as str, pieces of text as ``Block``."""
    stack = [_Open("", "", False, "")]
    text: list[str] = []
    position = 0

    def flush():
        if text:
            words = " ".join(html_module.unescape("".join(text)).split())
            text.clear()
            if words:
                top = stack[-1]
                block = next((o for o in reversed(stack) if o.tag not in INLINE), top)
                return Block(block.path, block.tag, words, top.left_out, top.region)
        return None

    while True:
        match = _TOKEN.search(page, position)
        if match is None:
            text.append(page[position:])
            break
        text.append(page[position : match.start()])
        position = match.end()
        tag = match.group(2)
        if tag is None:  # a comment or a declaration
            continue
        tag, closing = tag.lower(), bool(match.group(1))
        if tag in INLINE:
            if not closing and tag not in VOID:
                first, out = _marks(tag, match.group(3))
                if out and (block := flush()):
                    yield block
                top = stack[-1]
                stack.append(_Open(tag, top.path, top.left_out or out, top.region))
            elif closing:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag not in INLINE:
                        break
                    if stack[k].tag == tag:
                        if stack[k].left_out != stack[k - 1].left_out and (block := flush()):
                            yield block
                        del stack[k]
                        break
            continue
        if tag == "br":
            text.append(" ")
            continue
        if block := flush():
            yield block
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    yield f"/{stack[k].path}"
                    del stack[k:]
                    break
            continue
        if tag in VOID:
            yield f"{stack[-1].path}/{tag}"
            continue
        # a block ends an open paragraph, and an item its predecessor
        ends = CLOSED_BY_PEERS.get(tag, set()) | {"p"}
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in ends:
                del stack[k:]
                break
            if stack[k].tag not in INLINE:
                break
        while len(stack) > 1 and stack[-1].tag in INLINE and not stack[-1].left_out:
            stack.pop()
        first, out = _marks(tag, match.group(3))
        top = stack[-1]
        path = f"{top.path}/{tag}.{first}" if first else f"{top.path}/{tag}"
        region = tag if tag == "article" or (tag == "main" and not top.region) else top.region
        # a header loses all but its headings
        out = out or tag in LEFT_OUT or (top.left_out and not (tag in HEADINGS and _only_header(stack)))
        out = out or tag == "header"
        yield path
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, position)
            position = end.end() if end else len(page)
            continue
        stack.append(_Open(tag, path, out, region))
    if block := flush():
        yield block


def _only_header(stack: list[_Open]) -> bool:
    """Whether all that leaves out the text here is a header inside a region."""
    outs = [o for o, before in zip(stack[1:], stack) if o.left_out and not before.left_out]
    return len(outs) == 1 and outs[0].tag == "header" and outs[0].region in REGIONS


def _hash(kind: str, *parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join((kind, *parts))) - (1 << 63)


@functools.lru_cache(maxsize=100_000)
def _path_token(path: str) -> int:
    return _hash("tag", path)


def _text_token(block: Block) -> int:
    return _hash("text", block.path, block.text)


def tokens(page: str) -> Counter:
    """How often each token occurs."""
    return Counter(_path_token(t) if isinstance(t, str) else _text_token(t) for t in blocks(page))


class Template(NamedTuple):
    """What a host's pages share: text tokens, the frame's tags in order, and the article's element."""

    texts: frozenset[int] = frozenset()
    frame: tuple[int, ...] = ()
    article: str = ""

    def followed_by(self, stream: list) -> bool:
        """Whether a page has the frame's tags once each, in the template's order."""
        wanted = set(self.frame)
        here = [t for t in map(_path_token, (x for x in stream if isinstance(x, str))) if t in wanted]
        return here == list(self.frame)


NO_TEMPLATE = Template()


def main_text(page: str, template: Template = NO_TEMPLATE) -> str:
    """Text of the article's slots: what the template does not hold, outside of left-out parts.

    Within the template's article, or the page if it follows none, ``article`` and ``main``
    elements are taken for the whole. Prose inside such an element stays even if the template
    has it too: pages may share a paragraph.
    """
    stream = list(blocks(page))
    own = [t for t in stream if not isinstance(t, str) and not t.left_out]
    followed = bool(template.frame) and template.followed_by(stream)
    if followed:
        within = [b for b in own if b.path == template.article or b.path.startswith(f"{template.article}/")]
        own = within or own
    articles, marked = ([b for b in own if b.region in kinds] for kinds in (("article",), REGIONS))
    # an article within a main element is all of it only if it holds the greater part
    inside = articles if articles and 2 * _size(articles) >= _size(marked) else marked or own
    region = bool(marked)
    kept = [b.text for b in inside
            if (region and b.tag in PROSE) or not followed or _text_token(b) not in template.texts]
    return " ".join(kept)


def _size(of: list[Block]) -> int:
    return sum(len(b.text) for b in of)


def _token_rows(page: str) -> dict[int, list]:
    """Per token: times it occurs, path of a tag, chars of text, prose and titles that it is or holds, token of a text's path."""
    rows: dict[int, list] = {}
    for t in blocks(page):
        if isinstance(t, str):
            rows.setdefault(_path_token(t), [0, t, 0, 0, 0, 0])[0] += 1
            continue
        row = rows.setdefault(_text_token(t), [0, None, 0, 0, 0, _path_token(t.path)])
        row[0] += 1
        if t.left_out:
            continue
        size = len(t.text)
        prose, title = size * (t.tag in PROSE and t.tag != "li"), size * (t.tag == "h1")
        at, holders = t.path, [row]
        while at:
            if (holder := rows.get(_path_token(at))) is not None:
                holders.append(holder)
            at = at[: at.rindex("/")]
        for holder in holders:
            holder[2] += size
            holder[3] += prose
            holder[4] += title
    return rows


def templates(pages: DataFrame) -> DataFrame:
    """(host, texts, frame, article) of every host with enough pages, from (host, html)."""

    def count(batches):
        sums: dict[tuple[str, int], list] = {}
        for batch in sliced(batches):
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = xxhash.xxh3_64_intdigest(html)
                for token, (n, path, chars, prose, title, at) in _token_rows(as_text(html)).items():
                    own = sums.setdefault((host, token), [0, 0, 0, path, 0, 0, 0, at])
                    own[0] += 1
                    own[1] += xxhash.xxh3_64_intdigest(n.to_bytes(8, "little"), page) >> 24
                    own[2] += n
                    own[4] += chars
                    own[5] += prose
                    own[6] += title
                if len(sums) >= _FLUSH:
                    yield _summed(sums)
                    sums = {}
        yield _summed(sums)

    def first_pages(batches):
        """Of each host the page of least hash in this task, as the order of its tags."""
        least: dict[str, tuple[int, str]] = {}
        for batch in sliced(batches):
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mark = xxhash.xxh3_64_intdigest(html) >> 1
                if host not in least or mark < least[host][0]:
                    least[host] = (mark, html)
        for host, (mark, html) in least.items():
            tags = [_path_token(t) for t in blocks(as_text(html)) if isinstance(t, str)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([host]), pa.array([mark]), pa.array([tags], pa.list_(pa.int64()))], ["host", "mark", "tags"]
            )

    pages = pages.select("host", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"))
    counted = pages.mapInArrow(count, _COUNTED).groupBy("host", "token")
    summed = [F.sum(c).alias(c) for c in ("pages", "vector", "times", "chars", "prose", "title")]
    counted = counted.agg(*summed, F.first("path", ignorenulls=True).alias("path"), F.max("at").alias("at"))
    # the tokens of a host that most of its pages have are at most twice those of a page
    sizes = pages.groupBy("host").agg(F.count("*").alias("of"))
    valid = counted.where(F.col("pages") >= LEAST_PAGES).join(sizes, "host").where(F.col("pages") >= LEAST_SHARE * F.col("of"))
    row = F.struct("token", "pages", "vector", "times", "chars", "prose", "title", "path", "at")
    found = valid.groupBy("host").agg(F.collect_list(row).alias("rows"))
    orders = pages.mapInArrow(first_pages, "host string, mark bigint, tags array<bigint>")
    orders = orders.groupBy("host").agg(F.min_by("tags", "mark").alias("tags"))

    def deduced(batches):
        for batch in batches:
            hosts, rows, tags = (batch.column(n).to_pylist() for n in ("host", "rows", "tags"))
            made = [deduce(r, t or []) for r, t in zip(rows, tags)]
            numbers = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array([sorted(m.texts) for m in made], numbers),
                 pa.array([list(m.frame) for m in made], numbers), pa.array([m.article for m in made], pa.string())],
                ["host", "texts", "frame", "article"],
            )

    return found.join(orders, "host", "left").mapInArrow(
        deduced, "host string, texts array<bigint>, frame array<bigint>, article string"
    )


def classes(rows: list[dict]) -> dict[tuple[int, int], list[dict]]:
    """Tokens by vector of occurrences: equal page counts and equal sums."""
    found: dict[tuple[int, int], list[dict]] = {}
    for row in rows:
        found.setdefault((row["pages"], row["vector"]), []).append(row)
    return found


def deduce(rows: list[dict], order: list[int]) -> Template:
    """The template of a host from its common tokens and its reference page's tags in order."""
    texts = [r for r in rows if r["path"] is None]
    once = {
        key: own for key, own in classes(rows).items()
        if all(r["times"] == r["pages"] for r in own) and any(r["path"] is not None for r in own)
    }
    if not once:
        return NO_TEMPLATE
    widest = max(once, key=lambda key: (key[0], sum(r["path"] is not None for r in once[key]), key[1]))
    tags = {r["token"]: r for r in once[widest] if r["path"] is not None}
    seen = Counter(order)
    if any(seen[t] != 1 for t in tags):  # the reference page is not one of these
        return NO_TEMPLATE
    # filled-in text of the frame's elements: without the template's own
    own_text = {r["path"]: [r["chars"], r["prose"], r["title"]] for r in tags.values() if not r["path"].startswith("//")}
    paths = {r["token"]: r["path"] for r in rows if r["path"] is not None}
    for row in texts:
        at = paths.get(row["at"], "")
        while at:
            if at in own_text:
                own_text[at] = [x - row[c] for x, c in zip(own_text[at], ("chars", "prose", "title"))]
            at = at[: at.rindex("/")]
    frame = tuple(t for t in order if t in tags)
    return Template(frozenset(r["token"] for r in texts), frame, _article(own_text))


def _article(own_text: dict[str, list[int]]) -> str:
    """Down from the outermost element, while the next one holds most text, nearly all prose, and every title."""

    def outermost(paths):
        return [p for p in paths if not any(p.startswith(f"{q}/") for q in paths if q != p)]

    at, below = "", list(own_text)
    while below:
        down = max(outermost(below), key=lambda p: (own_text[p][0], p))
        tag = down.rsplit("/", 1)[1].split(".")[0]
        if at:
            (text, prose, title), (text_in, prose_in, title_in) = own_text[at], own_text[down]
            lost = 2 * text_in < text or prose - prose_in > _LOST * prose or title_in < title
            if text <= 0 or lost or tag in PROSE:
                break
        at = down
        if tag == "article":
            break
        below = [p for p in own_text if p.startswith(f"{at}/")]
    return at


_COUNTED = (
    "host string, token bigint, pages bigint, vector bigint, times bigint, path string, "
    "chars bigint, prose bigint, title bigint, at bigint"
)


def _summed(sums: dict) -> pa.RecordBatch:
    columns = list(zip(*sums.values())) if sums else [[] for _ in range(8)]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]
    return pa.RecordBatch.from_arrays(
        [pa.array([h for h, _ in sums], pa.string()), pa.array([t for _, t in sums], pa.int64()),
         *[pa.array(c, k) for c, k in zip(columns, kinds)]],
        ["host", "token", "pages", "vector", "times", "path", "chars", "prose", "title", "at"],
    )


def extract(
    pages: DataFrame, *, keep=("page_id", "url"), url: str = "url", html: str = "html"
) -> DataFrame:
    """The ``keep`` columns, text (empty if none) and n_chars, a row per row of ``pages``.

    Pages without a URL, or with one that tells no host, share the empty host. A null or
    empty html has no text. Repeated rows stay; other columns are not looked at.
    """

    def hosts(batches):
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([host_of(u) for u in batch.column(0).to_pylist()], pa.string()), *batch.columns[1:]],
                ["host", *batch.schema.names[1:]],
            )

    kept = [pages[f"`{c}`"].alias(f"_k{i}") for i, c in enumerate(keep)]
    source = pages.select(
        pages[f"`{url}`"].cast("string").alias("host"), pages[f"`{html}`"].cast("binary").alias("html"), *kept
    )
    named = source.mapInArrow(hosts, source.schema)

    def packed(batches):
        for batch in hosts(batches):
            small = [zlib.compress(x or b"", 1) for x in batch.column(1).to_pylist()]
            yield batch.set_column(1, "html", pa.array(small, pa.binary()))

    def text_of(batches):
        for batch in sliced(batches):
            parts = (batch.column(n).to_pylist() for n in ("texts", "frame", "article"))
            found = [Template(frozenset(t or ()), tuple(f or ()), a or "") for t, f, a in zip(*parts)]
            texts = [main_text(as_text(zlib.decompress(x)), t) for x, t in zip(batch.column("html").to_pylist(), found)]
            names = [n for n in batch.schema.names if n.startswith("_k")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [*names, "_text", "_n"],
            )

    # written, so that both sides of the join are shuffled plainly and a hot host can be split
    known = stored(templates(named.select("host", "html")), "templates")
    joined = source.mapInArrow(packed, source.schema).join(known, "host", "left")
    types = [f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields if f.name.startswith("_k")]
    out = joined.mapInArrow(text_of, ", ".join([*types, "_text string, _n bigint"]))
    return out.toDF(*keep, "text", "n_chars")
