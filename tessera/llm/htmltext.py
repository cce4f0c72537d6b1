"""Main text of web pages by line-block distribution.

Markup is stripped to lines: every block-level tag ends a line, inline tags don't, and elements
that are boilerplate by their nature (menus, footers, side bars, adverts, notices, forms, scripts,
styles, reader comments) leave nothing: by their tag, the attribute `hidden`, `display: none` in their
style, or a class, id, role or label of a container that is boilerplate as a whole name. What is
left out ends where HTML ends it, with or without an end tag, and with its parent at the latest. But a form, a
marked container or an element without end tag that holds most of the page's text is the page, not
boilerplate. Buttons, scripts and the like don't end the line they stand in. Of a page's header the only `h1` of the
page stays, as its title. Container borders leave `WINDOW` empty
lines. Text lengths are summed over a sliding window of `WINDOW` lines, lines outside articles that are mostly link text
having none; where the sum surges from nothing a block of text begins, where it dives to nothing the
block ends. A block is dense if its largest sum reaches `DENSE` characters or `SHARE` of the page's
largest. Kept are all dense blocks, whatever lies between two of them, blocks of paragraphs that end as
sentences do right before the first and right after the last, and a heading's block right before one; within
a block everything is, however short a line is.

Blocks of `article` or `main` elements are kept whole, and silence the lines outside them only if
the largest such element holds at least as much text as the dense blocks outside: teaser cards
beside a text don't. Where the text outside is longer than all of theirs, they are teasers and
their blocks need to be dense as well. Each line is one block of the page; blocks are joined by an
empty line.

Pages are independent: one map, no shuffle, memory bounded by one Arrow batch.

Defined results: null and empty pages give the empty text; repeated rows are extracted each; cut
off tags at the end of a page are dropped, unclosed elements end with their parent; CDATA sections are comments, as in
HTML; an empty table
gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm._tables import read, ship

WINDOW = 3
LINK_SHARE = 0.6
DENSE, SHARE = 86, 0.25
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</?\Z", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_SENTENCE = re.compile(r"[.!?…:][\"'”’»)\]]*$")
_RIGHTS = re.compile(r"©|copyright|all rights reserved", re.I)
_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text that no tag inside can end.
RAW = frozenset("script style textarea title noscript iframe xmp".split())
SKIPPED = frozenset("head nav footer aside form menu dialog button select option svg canvas object template datalist audio video".split()) | RAW
#: Of these, the ones that stand in a line of text.
WITHIN = frozenset("button select option svg canvas object template datalist audio video".split()) | RAW
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors banner cookie cookies consent notice notices alert gdpr popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs toc pager pagination footer comment comments disqus replies respond share sharing social related recommended newsletter subscribe subscription signup login search widget promo promotion toolbar skip complementary contentinfo masthead topbar".split()
)


#: Elements that a class or id may mark as boilerplate (a paragraph only by its class); headings and
#: inline text are none.
CONTAINERS = frozenset("article center dd details div dl fieldset figure header li main ol p section table tbody td tr ul".split())
#: What a boilerplate word may be joined with in one name: cookie-notice, site-footer, ad-slot-2.
AROUND = frozenset("area article articles bar block body bottom box button buttons card col column container content entry global group icons inner item items left link links list main media nav outer page panel post posts right row section site slot top unit user wrap wrapper zone".split())
#: Elements whose end tag may be left out: the start tags that end them, the end tags that do, and
#: the elements inside which neither does.
_CLOSERS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_ROWS, _LISTS, _TABLE = frozenset(("tr", "tbody", "thead", "tfoot")), frozenset(("ul", "ol", "menu")), frozenset(("table",))
_ITEM = (frozenset(("dt", "dd")), frozenset(("dl",)), frozenset(("dl",)))
_CELL = (_ROWS | {"td", "th"}, _ROWS | _TABLE, _TABLE)
IMPLIED = {
    "p": (_CLOSERS, (_CLOSERS - {"p"}) | {"body", "html", "li", "td", "th", "dd"}, frozenset()),
    "li": (frozenset(("li",)), _LISTS, _LISTS), "dt": _ITEM, "dd": _ITEM, "td": _CELL, "th": _CELL, "tr": (_ROWS, _TABLE | {"tbody", "thead", "tfoot"}, _TABLE),
}
ROLES = frozenset("navigation complementary contentinfo search banner dialog alert alertdialog menu menubar toolbar".split())


def _marked(token: str, words: frozenset[str]) -> bool:
    """Whether a whole class or id is made of boilerplate words and what may stand around them."""
    parts = {x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()) if len(x) > 1}
    return not words.isdisjoint(parts) and parts <= words | AROUND


def _boilerplate(name: str, attributes: str, in_article: bool) -> bool:
    if name in SKIPPED:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    given: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if name == "article":  # a reader's comment may be one
        return any(_marked(x, frozenset(("comment", "comments"))) for x in given.get("class", "").split())
    if "hidden" in given or _NONE.search(given.get("style", "")):
        return True
    if name not in CONTAINERS:
        return False
    names = given.get("class", "").split() + ([] if name in ("section", "p") else given.get("id", "").split())  # a section's or paragraph's id is its anchor
    if not ROLES.isdisjoint(given.get("role", "").lower().split()) or any(_marked(x, WORDS) for x in [*names, given.get("aria-label", "")]):
        return True
    return not in_article and name != "header" and any(x.lower() in ("header", "site-header") for x in names)


def _hides(name: str, attributes: str) -> bool:
    """Whether an element is hidden, or in a language of its own, and so never the page's text."""
    return name in RAW or name in ("head", "template", "svg", "canvas", "object") or bool(re.search(r"(?:^|\s)hidden\b", attributes)) or bool(_NONE.search(attributes))


def spared(html: str) -> tuple[frozenset[int], bool]:
    """Where elements begin that would be left out but hold most of the page's text (forms, marked containers, and
    others if they have no end tag), and whether the page has a single h1. One pass over the tags."""
    total = at = titles = 0
    open_: list[tuple[str, int, int, bool]] = []  # name, place, text before, whether an end tag is needed to keep it out
    within = Counter[str]()  # by name, of those in open_
    held: list[tuple[int, int]] = []
    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue
        total += len(html[at : m.start()].strip())
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        titles += name == "h1" and not closing
        if name in RAW and not closing:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif closing and within[name]:
            while open_:
                last, place, before, unclosed_only = open_.pop()
                within[last] -= 1
                if last != name or not unclosed_only:
                    held.append((place, total - before))
                if last == name:
                    break
        elif not closing and name not in VOID and not m[3].endswith("/"):
            left_out = _boilerplate(name, m[3], False)
            if left_out or within[name]:  # elements of the same name inside are counted for their end tags
                never = not left_out or _hides(name, m[3])
                open_.append((name, -1 if never else m.start(), total, name in SKIPPED and name != "form"))
                within[name] += 1
    total += len(html[at:].strip())
    held += [(place, total - before) for _, place, before, _ in open_]
    return frozenset(place for place, n in held if place >= 0 and 2 * n > total), titles == 1


def strip_markup(html: str) -> list[tuple[str, int, int, bool, bool]]:
    """Lines as (text, characters of link text, number of the outermost article or 0, in a heading, a sentence in a
    paragraph)."""
    kept_open, one_title = spared(html)
    lines: list[tuple[str, int, int, bool, bool]] = []
    parts: list[str] = []
    linked = at = depth = links = top = 0
    skip, nested, fenced, article, heading, paragraph, title = "", 0, 0, 0, False, False, False
    around, inside = Counter[str](), Counter[str]()

    def end_line(border: bool = False) -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text and (not top or depth or (title and one_title)):
            of = article if depth else article + 1 if top and re.search(r"<(?:article|main)\b", html[at:], re.I) else 0
            lines.append((text, linked, of, heading, paragraph and bool(_SENTENCE.search(text)) and not _RIGHTS.search(text)))
        linked = 0
        if border:
            lines.extend([("", 0, 0, False, False)] * WINDOW)

    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue
        if not skip and m.start() > at:
            parts.append(html[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if skip:
            starts, ends, fences = IMPLIED.get(skip, (frozenset(), frozenset(), frozenset()))
            if not fenced and nested == 1 and name in (ends if closing else starts):
                skip = ""  # ended by this tag, which counts by itself
            elif name == skip and not fenced:
                nested += -1 if closing else not m[3].endswith("/")
                if nested <= 0:
                    skip = ""
                    continue
            elif name in fences:
                fenced = max(0, fenced + (-1 if closing else 1))
            elif name in ("article", "main") and skip not in RAW and (depth > 0 if closing else not _boilerplate(name, m[3], False)):
                skip = ""
            elif closing and name not in IMPLIED and not inside[name] and around[name]:
                skip = ""  # its parent ends
            elif name not in VOID and name not in INLINE:
                inside[name] = max(0, inside[name] + (-1 if closing else 1))
            if skip:
                continue
        if name == "br":
            parts.append(" ")
        elif name in VOID:
            if name == "hr":
                end_line()
        elif not closing and m.start() not in kept_open and _boilerplate(name, m[3], depth > 0):
            if name not in INLINE and name not in WITHIN:
                end_line(border=not depth)
            elif name in WITHIN and name not in RAW:
                parts.append(" ")
            if name in RAW:
                end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            elif not m[3].endswith("/"):
                skip, nested, fenced = name, 1, 0
                inside.clear()
        elif name == "a":
            links = max(0, links + (-1 if closing else 1))
        elif name not in INLINE:
            container = name in ("article", "main", "body", "section", "div", "table")
            end_line()
            if name not in IMPLIED:
                around[name] = max(0, around[name] + (-1 if closing else 1))
            paragraph = name in ("p", "blockquote") and not closing
            if name in HEADINGS:
                heading, title = not closing, not closing and name == "h1"
            if name == "header" and not depth:
                end_line(border=True)
                top = max(0, top + (-1 if closing else 1))
            if name in ("article", "main"):
                end_line(border=True)
                article += not closing and not depth
                depth = max(0, depth + (-1 if closing else 1))
            if container and not depth:
                end_line(border=True)
    if not skip and at < len(html):
        parts.append(html[at:])
    end_line()
    return lines


def _blocks(size: list[int]) -> list[tuple[int, int, int]]:
    """(start, end, largest window sum) of each block."""
    blocks, start, total, most = [], -1, 0, 0
    for i, n in enumerate([*size, *[0] * WINDOW]):
        total += n - (size[i - WINDOW] if i >= WINDOW else 0)  # text in lines i - WINDOW + 1 to i
        most = max(most, total)
        if total and start < 0:
            start = i  # surge
        elif not total and start >= 0:
            blocks.append((start, i - WINDOW + 1, most))  # dive
            start, most = -1, 0
    return blocks


def _chosen(lines: list[tuple[str, int, int, bool, bool]], size: list[int], whole: bool) -> list[tuple[int, int]]:
    """The blocks that are text; whole: those of articles are so without being dense."""
    blocks = _blocks(size)
    least = min(DENSE, SHARE * max((most for *_, most in blocks), default=0))
    keep = [most >= least or (whole and lines[a][2] > 0) for a, _, most in blocks]
    dense = [k for k, x in enumerate(keep) if x]
    for k in range(dense[0], dense[-1]) if dense else ():
        keep[k] = True
    prose = [all(lines[i][4] for i in range(a, b) if size[i]) for a, b, _ in blocks]
    for ks in (range(dense[0] - 1, -1, -1), range(dense[-1] + 1, len(blocks))) if dense else ():
        for k in ks:
            if not prose[k]:
                break
            keep[k] = True
    for k in range(len(blocks) - 2, -1, -1):
        a, b, _ = blocks[k]
        keep[k] |= keep[k + 1] and all(lines[i][3] for i in range(a, b) if size[i])
    return [(a, b) for (a, b, _), x in zip(blocks, keep) if x]


def main_text(html: str | None) -> str:
    lines = strip_markup(html or "")
    size = [0 if not article and link > LINK_SHARE * len(t) else len(t) for t, link, article, *_ in lines]
    outer = [0 if article else n for n, (_, _, article, *_) in zip(size, lines)]
    held = Counter[int]()
    for t, _, article, *_ in lines:
        held[article] += len(t) if article else 0
    outside = sum(sum(outer[a:b]) for a, b in _chosen(lines, outer, False))
    if 0 < outside <= max(held.values(), default=0):
        size = [n if article else 0 for n, (_, _, article, *_) in zip(size, lines)]
    whole = outside <= sum(held.values())
    return "\n\n".join(lines[i][0] for a, b in _chosen(lines, size, whole) for i in range(a, b) if size[i])


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """The columns named in keep, with `text` and `n_chars`."""
    ship(pages.sparkSession)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                found = [main_text(x) for x in some.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(some.column(i) for i in range(len(keep))), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], [*keep, "text", "n_chars"])

    rows = pages.select(*keep, html)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(texts, f"{schema}, text string, n_chars long")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"), ["page_id", "url"])


#: For pages whose article is one element without boilerplate in it, as the driver's are.
OP9_SQL = r"""
WITH article AS (SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1), '</?(?:p|h1)[^>]*(?:>|$)') AS blocks FROM pages
), bare AS (
  SELECT page_id, url, list_transform(blocks, lambda b: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(b, '<br>', ' ', 'g'), '</?[a-z!][^>]*(?:>|$)|</?$', '', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks FROM article
), joined AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda b: b <> ''), chr(10) || chr(10)) AS text FROM bare)
SELECT page_id, url, text, length(text) AS n_chars FROM joined
"""
