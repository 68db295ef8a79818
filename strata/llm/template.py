"""Main text of web pages by template deduction from equivalence classes.

A page is read as a sequence of elements and texts. Tokens are the path of an
element (tag, class, id and role of it and its ancestors) and the text of a block
with its element's path. For every host the occurrence vector of a token, its
count on each of the host's pages, is summed up as an order-free digest, so
tokens with equal vectors are found by one aggregation however many pages a host
has; pages of equal content count once. Tokens on at least half of the host's
pages (two at least) that share a vector and the class around them form an
equivalence class; classes nest by their paths into the host's template, optional
parts and parts repeated on a page included.

A text in the class of its own element comes wherever the element comes and
belongs to the template. Other texts lie between template tokens, in its slots;
a constant text among others in the same kind of element (a paragraph, an item)
is one of them. The article slot is the deepest ``article`` or ``main`` element
among the tokens that come once on a page, by the varying words below it; without
one, the deepest such token that holds ``SHARE`` of the host's varying words. The
article is what the slot holds, without texts of the template and without the
slots nested in it that are furniture (menus, side bars, adverts, notices, forms,
reader comments): varying text that no class can tell from the article's own, so
the elements below the slot are known by tag, role and class names.

A host has no template if it has a single page, no common layout, or no varying
words in its article. Its pages, and pages that lack the slot, are read on their
own: the article slot among a page's own tokens, without furniture (menus,
headers, footers, side bars, adverts, notices, forms, comments), which is known by
tag, role and class names. Names of furniture are used nowhere else. Text that
browsers do not show is left out everywhere.

Text is taken block by block: character references decoded, white space to one
blank, blocks in page order joined by a newline.

Defined cases: a null or empty html gives an empty text; a null url is a host of
its own; broken markup is read as browsers do in the cases that matter (open
paragraphs and list items end by themselves, stray end tags are ignored, script
text is no markup); repeated rows give equal rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Buffer, cut, rows_of

SHARE = 0.9
# Element names of HTML and common class names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
                   "optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
FURNITURE_TAGS = frozenset("head nav footer aside form script style noscript template svg button select option iframe "
                           "textarea title dialog menu object canvas audio video".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense aside banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus footer gdpr login menu modal nav "
    "navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion recommended "
    "related reply replies search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "teaser toolbar widget widgets".split())
#: Elements whose text browsers do not show.
UNSEEN = frozenset("head script style noscript template svg iframe object canvas audio video title".split())
HEADER_NAMES = frozenset("header masthead topbar".split())
MAIN_NAMES = frozenset("article main".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div body main aside nav header footer form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_DIGITS = re.compile(r"\d+")
_NAME = re.compile(r"[a-z]+")


class _Open:
    __slots__ = ("tag", "path", "bad", "article", "unseen")

    def __init__(self, tag: str, path: str, bad: int, article: bool, unseen: bool):
        # bad: how many of the element and those around it are furniture
        self.tag, self.path, self.bad, self.article, self.unseen = tag, path, bad, article, unseen


def _element(tag: str, attrs: str, up: _Open) -> _Open:
    names: list[str] = []
    if attrs:
        for m in _ATTR.finditer(attrs):
            names.extend((m[2] or m[3] or m[4] or "").lower().split())
    label = tag + "".join(["." + _DIGITS.sub("#", x.replace("/", "|")) for x in names])
    article = up.article or tag in MAIN_NAMES or "main" in names
    # classes of the whole page say what kind of page it is
    parts = {p for x in names for p in _NAME.findall(x)} if tag not in ("html", "body") else set()
    unseen = up.unseen or tag in UNSEEN or bool(attrs and _HIDDEN.search(attrs))
    bad = (unseen or tag in FURNITURE_TAGS or not parts.isdisjoint(FURNITURE_NAMES)
           # an article's own header holds its title
           or (not up.article and (tag == "header" or not parts.isdisjoint(HEADER_NAMES))))
    return _Open(tag, f"{up.path}/{label}" if up.path else label, up.bad + bad, article, unseen)


def parse(page: str | None) -> tuple[list[str], list[tuple[str, bool, str]]]:
    """(paths of all elements, blocks): a shown block is (path, furniture?, text) in page order."""
    root = _Open("", "", 0, False, False)
    stack, paths, blocks, buf = [root], [], [], []
    where: list[_Open] = [root]

    def end_block() -> None:
        if buf:
            text = " ".join("".join(buf).split())
            if text and not where[0].unseen:
                blocks.append((where[0].path, where[0].bad > 0, text))
            buf.clear()

    def say(raw: str) -> None:
        if raw:
            here = stack[-1]
            if not buf:
                where[0] = here
            elif (here.bad, here.unseen) != (where[0].bad, where[0].unseen):  # inline furniture is a block of its own
                end_block()
                where[0] = here
            buf.append(_html.unescape(raw) if "&" in raw else raw)

    at, s = 0, page or ""
    while True:
        m = _TOKEN.search(s, at)
        if m is None:
            say(s[at:])
            break
        say(s[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if any(x.tag in BLOCKS for x in stack[k:]):
                        end_block()
                    del stack[k:]
                    break
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCKS:
            end_block()
            _close_open(stack, tag)
        if tag in VOID:
            continue
        e = _element(tag, m[3] or m[6] or "", stack[-1])
        paths.append(e.path)
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>|\Z", re.I).search(s, at)
            at = close.end()
            continue
        if (m[3] or m[6] or "").endswith("/") and tag not in BLOCKS:
            continue
        stack.append(e)
    end_block()
    return paths, blocks


def _close_open(stack: list[_Open], tag: str) -> None:
    """End the elements that a new ``tag`` ends by itself."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == "p":
            del stack[k:]
            break
        if stack[k].tag in SCOPE:
            break
    ends = CLOSED_BY.get(tag)
    if ends:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in ends:
                del stack[k:]
                break
            if stack[k].tag in SCOPE:
                break


def _last_tag(path: str) -> str:
    return re.split(r"[.]", path.rsplit("/", 1)[-1])[0]


def _is_main(path: str) -> bool:
    names = path.rsplit("/", 1)[-1].split(".")
    return names[0] in MAIN_NAMES or "main" in names[1:]


def article_slot(tokens: dict[str, int]) -> str | None:
    """The path of the article among tokens with their words below."""
    full = {p: w for p, w in tokens.items() if w > 0}
    if not full:
        return None
    mains = [p for p in full if _is_main(p)]
    if mains:
        top = max(full[p] for p in mains)
        good = [p for p in mains if full[p] >= SHARE * top]
        return max(good, key=lambda p: (p.count("/"), full[p], p))
    top = max(full.values())
    good = [p for p in full if full[p] >= SHARE * top and _last_tag(p) in BLOCKS and _last_tag(p) != "p"]
    return max(good, key=lambda p: (p.count("/"), full[p], p)) if good else None


def _below(blocks: list[tuple[str, bool, str]]) -> dict[str, int]:
    """Words below each path of a page."""
    out: dict[str, int] = {}
    for path, _, text in blocks:
        n = len(text.split())
        while path:
            out[path] = out.get(path, 0) + n
            path = path.rpartition("/")[0]
    return out


def text_token(path: str, text: str) -> int:
    """Digest of a block's text and its element's path."""
    d = xxhash.xxh64_intdigest(f"{path}\n{text}".encode("utf-8", "surrogatepass"))
    return d - (1 << 64) if d >> 63 else d


@lru_cache(1 << 14)
def is_furniture(label: str) -> bool:
    """Whether an element (the last part of a path) is furniture inside an article."""
    tag, *names = label.split(".")
    return tag in FURNITURE_TAGS or any(x in FURNITURE_NAMES for name in names for x in _NAME.findall(name))


def main_text(page: str | None, slot: str | None, fixed: frozenset[int] = frozenset()) -> str:
    """The article's text: what the slot holds besides ``fixed`` texts and furniture, or the page's own slot where that one is missing."""
    _, blocks = parse(page)
    if slot:
        inside = [(p, t) for p, _, t in blocks if p == slot or p.startswith(slot + "/")]
        if inside:
            own = [(p, t) for p, t in inside if not any(map(is_furniture, p[len(slot) + 1:].split("/")))]
            return "\n".join([t for p, t in own if text_token(p, t) not in fixed])
    good = [b for b in blocks if not b[1]]
    own = article_slot(_below(good))
    return "\n".join([t for p, _, t in good if not own or p == own or p.startswith(own + "/")])


def host_of(url: str = "url"):
    h = F.lower(F.regexp_extract(F.col(url), r"^[^/]*//([^/?#]*)", 1))
    return F.coalesce(h, F.lit(""))


def _tokens(pages: DataFrame) -> DataFrame:
    """(host, path, text, pages, total, vec, words): every token of a host with its vector's digest; text is null for elements."""
    schema = pa.schema([("host", pa.string()), ("page", pa.binary()), ("path", pa.list_(pa.string())),
                        ("text", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("words", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema, 256)
        for host, body in rows_of(batches, ["host", "html"]):
            paths, blocks = parse(body)
            below = _below(blocks)
            below[""] = sum(len(t.split()) for _, _, t in blocks)
            count: dict[tuple[str, int | None], int] = {("", None): 1}  # the page itself
            words: dict[tuple[str, int | None], int] = {("", None): below[""]}
            for p in paths:
                count[p, None] = count.get((p, None), 0) + 1
                words[p, None] = below.get(p, 0)
            for p, _, t in blocks:
                k = p, text_token(p, t)
                count[k] = count.get(k, 0) + 1
                words[k] = words.get(k, 0) + len(t.split())
            same = xxhash.xxh128()
            for p, n in sorted((f"{p}\n{t}", n) for (p, t), n in count.items()):
                same.update(f"{p}\n{n}\n".encode("utf-8", "surrogatepass"))
            out.add(host, same.digest(), [p for p, _ in count], [t for _, t in count], list(count.values()),
                    [words[k] for k in count])
            if out.full():
                yield out.flush()
        yield out.flush()

    lists = ["path", "text", "n", "words"]
    each = pages.select(host_of().alias("host"), F.col("html").cast("string").alias("html")) \
        .mapInArrow(run, "host string, page binary, path array<string>, text array<long>, n array<long>, words array<long>") \
        .groupBy("host", "page").agg(F.first(F.arrays_zip(*lists)).alias("tokens"))
    occ = each.select("host", "page", F.explode("tokens").alias("t")).select("host", "page", "t.*")
    # equal occurrence vectors have equal digests, summed as decimals
    vec = F.sum(F.xxhash64("page", "n").cast("decimal(20,0)"))
    return occ.groupBy("host", "path", "text").agg(F.count("*").alias("pages"), F.sum("n").alias("total"),
                                                   vec.alias("vec"), F.sum("words").alias("words"))


_TEMPLATE = pa.schema([("host", pa.string()), ("path", pa.string()), ("text", pa.int64()), ("class_id", pa.int32()),
                       ("parent_class", pa.int32()), ("pages", pa.int64()), ("fixed", pa.bool_()), ("main", pa.bool_())])


def _nest(t: pa.Table) -> pa.Table:
    """Group function: the tokens of a host to its nested classes."""
    rows = sorted(t.to_pylist(), key=lambda r: (r["path"] != "", r["path"].count("/"), r["path"], r["text"] is not None,
                                                r["text"] or 0))
    at: dict[str, tuple[int, int | None, tuple]] = {}  # of elements: class, class around it, vector
    ids: dict[tuple, int] = {}
    varying = {r["path"]: r["words"] for r in rows if r["text"] is None}
    out = []
    for r in rows:
        path, text, vec = r["path"], r["text"], (r["pages"], r["total"], r["vec"])
        up = path.rpartition("/")[0] if text is None else path
        while up and up not in at:
            up = up.rpartition("/")[0]
        near = at.get(up)
        if near and near[2] == vec:
            found = near
        else:
            around = near[0] if near else None
            found = ids.setdefault((around, vec), len(ids)), around, vec
        if text is None:
            at[path] = found
        else:
            varying[""] -= r["words"]
            while path:
                varying[path] -= r["words"]
                path = path.rpartition("/")[0]
        out.append([r["host"], r["path"], text, found[0], found[1], r["pages"], text is not None and found is near])
    once = {r["path"]: varying[r["path"]] for r in rows if r["text"] is None and r["path"] and r["total"] == r["pages"]}
    slot = article_slot(once)
    if slot and not _is_main(slot) and any(map(_is_main, once)):
        slot = None  # the articles do not differ
    out = [(*x, x[2] is None and x[1] == slot) for x in out]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _TEMPLATE)], schema=_TEMPLATE)


def templates(pages: DataFrame) -> DataFrame:
    """(host, path, text, class_id, parent_class, pages, fixed, main): the valid tokens of every host.

    ``fixed`` marks texts of the template, ``main`` the element that is the article slot.
    """
    tok = cut(_tokens(pages), "page-tokens")
    size = tok.filter("path = '' AND text IS NULL").select("host", F.col("pages").alias("host_pages"))
    valid = tok.join(size.filter("host_pages >= 2"), "host").filter("pages >= 2 AND 2 * pages >= host_pages")
    return cut(valid.groupBy("host").applyInArrow(
        _nest, "host string, path string, text long, class_id int, parent_class int, pages long, fixed boolean, "
               "main boolean"), "page-templates")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    slots = templates(pages).groupBy(F.col("host").alias("s_host")) \
        .agg(F.max(F.when(F.col("main"), F.col("path"))).alias("slot"),
             F.collect_list(F.when(F.col("fixed"), F.col("text"))).alias("fixed"))
    slots = cut(slots.filter("slot IS NOT NULL"), "page-slots")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host_of().alias("host")) \
        .join(slots, F.col("host") == F.col("s_host"), "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema, 512)
        for page_id, url, body, slot, fixed in rows_of(batches, ["page_id", "url", "html", "slot", "fixed"]):
            text = main_text(body, slot, frozenset(fixed or ()))
            out.add(page_id, url, text, len(text))
            if out.full():
                yield out.flush()
        yield out.flush()

    return rows.select("page_id", "url", "html", "slot", "fixed") \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
