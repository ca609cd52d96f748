"""Main text of web pages by equivalence-class template deduction.

A page's tokens are its elements (tag, class and the path to them) and its text
blocks (path and text).  Over the pages of one host a token has an occurrence
vector: how often it occurs in each page.  Tokens with equal vectors form an
equivalence class; a class is valid when its tokens occur once in each of their
pages, it has two tokens or more, and covers half of the host's pages or
more, or is a layout inside the host: an element is among its tokens and it
covers ``min_pages`` pages or more.  Valid classes are the host's template.  What
lies between them are slots, and the text in slots is the page's own.

The page's text is that of the slots in the best container (an article first,
see ``CONTAINERS``), without subtrees that are menus, headers, adverts and so
on.  In an article only classes of ``FIRM_PAGES`` pages or more decide.  A
container without slots is a copy of others; its text stays.
Hosts with one page have no template; their pages are judged alone.

Vectors are never gathered: each is an order-free fingerprint (xor over pages
of hash(page, count)) that Spark pre-aggregates before the shuffle, so one host
may hold any share of the pages.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_dim
from .arrow import pieces
from .common import written

#: Element kinds (fixed values of the HTML standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
RAW_TEXT = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes")
#: An opening tag that ends an open element of the second set, up to the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Subtrees that hold no main text: by tag, role, and word of class or id.
OTHER_TAGS = frozenset(
    "head nav header footer aside form script style noscript template button select textarea iframe object svg canvas "
    "menu dialog title audio video map".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promotions banner "
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget widgets "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "social share sharing related recommended recommendations comment comments commentlist disqus replies reply respond "
    "skip toolbar pagination pager search copyright paywall".split())
#: Containers of the main text, best first: tags, then words of class or id.
CONTAINERS = (("article",), ("main",), ("article", "post", "entry", "story"), ("content", "main", "body"))

#: Pages that make a layout inside a host.
MIN_PAGES = 8
#: Pages on which a text is the template's even in an article (fewer may be copies of one article), and
#: the share of the host's pages that a class without elements must be on for it: the rest are copies too.
FIRM_PAGES, FIRM_SHARE = 4, 0.9
#: An article of which other pages have more than this share of characters is a copy, and kept whole.
COPY_SHARE = 0.7

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+>|"""
    r"""<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>|\Z", re.I) for t in RAW_TEXT}


class _Element:
    __slots__ = ("tag", "path", "other", "rank", "words", "template")

    def __init__(self, tag, path, other, rank, words, template):
        self.tag, self.path, self.other, self.rank, self.words, self.template = tag, path, other, rank, words, template


def _hash(parent: int, text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), parent & 0xFFFFFFFFFFFFFFFF)
    return h - (1 << 64) if h >= 1 << 63 else h


def _attributes(raw: str) -> tuple[str, list[str], str, bool]:
    """Class and id, the words of both, role, hidden."""
    names, words, role, hidden = "", [], "", False
    if raw and not raw.isspace():
        for key, a, b, c in _ATTR.findall(raw):
            key, value = key.lower(), a or b or c
            if key == "hidden":
                hidden = True
            elif key == "role":
                role = value.lower()
            elif key in ("class", "id"):
                words += [w.lower() for w in _WORD.findall(value)]
                # an id with digits is one page's own
                names += "." + ".".join(sorted(value.split())) if key == "class" else "" if any(c.isdigit() for c in value) else "#" + value
    return names, words, role, hidden


def _is_other(tag: str, words: list[str], role: str, hidden: bool, in_article: bool) -> bool:
    if hidden or role in OTHER_ROLES:
        return True
    if tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return any(w.startswith("comment") for w in words)
    if tag == "header":
        return not in_article  # an article's own header holds its title
    if tag in OTHER_TAGS:
        return True
    return any(w in OTHER_WORDS and not (w == "header" and in_article) and (i == 0 or words[i - 1] not in ("has", "with", "no")) for i, w in enumerate(words))


def _rank(tag: str, words: list[str]) -> int:
    """Place in ``CONTAINERS`` (their number if none)."""
    if tag == "article":
        return 0
    if tag == "main":
        return 1
    for r in (2, 3):
        if tag != "body" and any(w in CONTAINERS[r] for w in words):
            return r
    return len(CONTAINERS)


def walk(page: str, template: frozenset[int] = frozenset(), firm: frozenset[int] = frozenset()) -> tuple[Counter, list[tuple[str, int, int, bool]]]:
    """The tokens of a page, counted, and its blocks: text, the best container
    around it, its token, and whether it is of the template (by its own token in
    ``firm``; outside an article by ``template``, nested).  Blocks in
    subtrees without main text are tokens only.  Tokens of elements are odd, those
    of text even."""
    tokens: Counter = Counter()
    blocks: list[tuple[str, int, int, bool]] = []
    root = _Element("", 0, False, len(CONTAINERS), (), True)
    stack, buffer, owner = [root], [], root

    def flush():
        nonlocal buffer
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer = []
            if text:
                token = _hash(owner.path, "#" + text) & ~1
                tokens[token] += 1
                if not owner.other:
                    known = token in firm or (owner.rank > 0 and owner.template and token in template)
                    blocks.append((text, owner.rank, token, known))

    def block_owner():
        for e in reversed(stack):
            if e.tag not in INLINE:
                return e
        return root

    def add(text: str):
        nonlocal owner
        if text:
            if stack[-1].other:
                flush()  # nothing inside is text of a block around it
                return
            if not buffer:
                owner = block_owner()
            buffer.append(text)

    def pop_to(index: int):
        if any(e.tag not in INLINE or e.other for e in stack[index:]):
            flush()
        del stack[index:]

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        closing, tag, raw = m.group(1), m.group(2) or m.group(4), m.group(3) or m.group(5) or ""
        if closing:
            closing = closing.lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == closing:
                    pop_to(i)
                    break
                if closing in INLINE and stack[i].tag not in INLINE:
                    break  # a stray end of an inline element closes no block
            continue
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br" or tag == "hr":
            add("\n")
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        if tag in IMPLIED:
            ends, stops = IMPLIED[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    pop_to(i)
                    if tag != "tr" or stack[-1].tag == "table":
                        break
                elif stack[i].tag in stops:
                    break
        if tag in VOID:
            if tag not in INLINE:
                add(" ")
            continue
        parent = stack[-1]
        names, words, role, hidden = _attributes(raw)
        path = _hash(parent.path, tag + names) | 1
        if tag not in INLINE:
            flush()
            tokens[path] += 1
        inside = any(e.tag == "article" for e in stack) if tag == "header" or "header" in words else False
        other = parent.other or _is_other(tag, words, role, hidden, inside)
        if other and not parent.other:
            flush()
        own = len(CONTAINERS) if other else _rank(tag, words) if role != "main" else 1
        stack.append(_Element(tag, path, other, min(parent.rank, own), words,
                              parent.template and (path in template or tag in INLINE)))
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, at)
            stack.pop()
            at = end.end()
    flush()
    return tokens, blocks


def main_text(page: str, template: frozenset[int] = frozenset(), firm: frozenset[int] = frozenset()) -> str:
    """The text in the slots of the best container."""
    _, blocks = walk(page, template, firm)
    if not blocks:
        return ""
    best = min(b[1] for b in blocks)
    inside = [(text, known) for text, rank, _, known in blocks if rank == best]
    # a container without slots is a copy of others; an article that is mostly what other
    # pages have too is a near copy of theirs: all of it is the text
    shared = sum(len(text) for text, known in inside if known)
    whole = sum(len(text) for text, _ in inside)
    copied = best < len(CONTAINERS) and (shared == whole or best == 0 and shared > COPY_SHARE * whole)
    return " ".join(text for text, known in inside if copied or not known)


def host_of(url):
    """Lower-cased host of a URL column (null: empty)."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_share: float = 0.5,
              min_tokens: int = 2, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per host: its template's tokens, and those of them that decide in articles
    too (no row for hosts of one page)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "__t"):
                host, page, token, n = [], [], [], []
                for h, text in zip(part.column("__h").to_pylist(), texts):
                    counted, _ = walk(text)
                    key = _hash(1, text)
                    counted[0] = 1  # the page itself
                    host += [h] * len(counted)
                    page += [key] * len(counted)
                    token += counted.keys()
                    n += counted.values()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(token, pa.int64()), pa.array(n, pa.int64())],
                    names=["h", "page", "token", "n"])

    p = pages.select(host_of(F.col(url_col)).alias("__h"), F.col(html_col).alias("__t"))
    seen = p.mapInArrow(emit, "h string, page bigint, token bigint, n bigint").groupBy("h", "token").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("pages"), F.sum("n").alias("total"))
    seen = written(seen.where("pages > 1"), "page-tokens")
    hosts = seen.where("token = 0").select("h", F.col("pages").alias("host_pages"))
    share = F.col("host_pages") * min_share
    frequent = seen.where("token != 0 and total = pages").join(hosts, "h").where(F.col("pages") >= F.least(share, F.lit(min_pages)))
    # written: what joins by host alone would keep all tokens of a large host in one task
    frequent = written(frequent, "page-frequent")
    classes = frequent.groupBy("h", "vector", "pages", "host_pages").agg(
        F.collect_list("token").alias("tokens"), F.max(F.col("token").bitwiseAND(1)).alias("elements"))
    valid = (F.col("pages") >= share) | ((F.col("pages") >= min_pages) & (F.col("elements") == 1))
    firm = (F.col("pages") >= FIRM_PAGES) & ((F.col("elements") == 1) | (F.col("pages") >= F.col("host_pages") * FIRM_SHARE))
    return classes.where((F.size("tokens") >= min_tokens) & valid).groupBy("h").agg(
        F.flatten(F.collect_list("tokens")).alias("tokens"), F.flatten(F.collect_list(F.when(firm, F.col("tokens")))).alias("firm"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            broadcast_tokens: int = 2_000_000) -> DataFrame:
    """One row per page: ``id_col``, ``url_col``, ``text`` (empty if none), ``n_chars``.

    Null and empty pages give empty text; a null URL belongs to the host ``''``.
    Repeated pages each get their row.  Templates of ``broadcast_tokens`` tokens
    (8 bytes each) or fewer in all are broadcast, more are joined by a shuffle,
    in which Spark may split a large host.
    """
    found = written(templates(pages, url_col, html_col), "templates")
    size = found.agg(F.coalesce(F.sum(F.size("tokens") + F.size("firm")), F.lit(0))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[frozenset, frozenset]] = {}
        for batch in batches:
            for part, texts in pieces(batch, "__t"):
                out = []
                hosts, tokens, firm = part.column("__h").to_pylist(), part.column("tokens"), part.column("firm")
                for i, (h, text) in enumerate(zip(hosts, texts)):
                    if h not in memo:
                        if len(memo) > 1000:
                            memo.clear()
                        memo[h] = frozenset(tokens[i].as_py() or ()), frozenset(firm[i].as_py() or ())
                    out.append(main_text(text, *memo[h]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), part.column("__u"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                    names=["__id", "__u", "text", "n_chars"])

    p = pages.select(F.col(id_col).alias("__id"), F.col(url_col).cast("string").alias("__u"),
                     host_of(F.col(url_col)).alias("__h"), F.col(html_col).alias("__t"))
    joined = join_dim(p, found.withColumnRenamed("h", "__h"), "__h", known_rows=size, max_rows=broadcast_tokens)
    kind = p.schema["__id"].dataType.simpleString()
    return joined.mapInArrow(run, f"__id {kind}, __u string, text string, n_chars bigint").withColumnsRenamed({"__id": id_col, "__u": url_col})
