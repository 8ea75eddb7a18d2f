"""Main text of web pages: site templates are found by counting element subtrees per host.

Each page is parsed once per pass in its task. The first pass hashes element subtrees; Spark counts
on how many different pages of a host each hash stands; a subtree on many of them (below an
article or main: on most) is template and deleted in the second pass, together with elements that are never part of an article.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, query, sized_join, stage, table

#: A subtree is template if it stands on at least so many different pages, and this share, of its host.
LEAST_PAGES, LEAST_SHARE = 5, 0.05
#: Below an article or main a subtree is template only if more than this share of its host's pages has it there.
MOST_SHARE = 0.5

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea iframe svg annotation annotation-xml object canvas audio video title".split())
GONE = RAW | set("head nav footer aside form button select dialog menu".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Text blocks are never template: passages may recur on many pages and still be content.
PROSE = set("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
#: Parts of tables, lists and figures: below an article or main never template by themselves.
PIECES = set("li dt dd td th tr thead tbody tfoot caption figcaption legend summary".split())
#: Told apart from its hash elsewhere, a subtree's hash below an article or main.
INSIDE = 0x2545F4914F6CDD1D
#: Elements closed by the start of the elements named.
CLOSED_BY = {
    "p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
}
#: Words of class, id and role that name menus, headers, footers, sidebars, notices, adverts and comments.
NOISE = set(
    "ad ads adbox adslot advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager topbar toolbar masthead header footer colophon contentinfo "
    "sidebar aside complementary widget widgets related recommended trending "
    "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe signup paywall disclaimer "
    "comment comments commentlist disqus replies respond feedback share sharing social search login".split()
)
#: Words beside one of NOISE in a name that tell how a page is laid out: no-sidebar, page-with-sidebar, share-enabled.
STATE = set("no not non without with has have is enabled disabled".split())
#: Names of what stands beside a page's own article, with articles of its own.
BESIDE = set("comment comments commentlist disqus replies respond feedback related recommended trending".split())
#: Elements that no class or id marks as noise: the frame of a page, headings and parts of tables.
FRAME = set("html body main article h1 h2 h3 h4 h5 h6 table caption thead tbody tfoot tr td th colgroup".split())
#: Whole class, id or role names that mark surroundings inside an article or main, and the elements they mark there.
WITHIN = set(
    "comments comment-list commentlist comments-area disqus_thread respond replies share sharing share-buttons social-share "
    "ad ads advert adverts advertisement adsbygoogle ad-slot newsletter-signup cookie-notice".split()
)
BOXES = set("div section ul ol aside fieldset details dialog".split())
#: A quote opens a value right after "=" only.
TOKEN = re.compile(r"""<(?:!--(?:.*?-->|.*)|[!?][^>]*+>?|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>)""", re.DOTALL)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


class Node:
    """``noise``: 0 content, 1 noise by name that may hold the page's article, 2 noise with all in it;
    ``inner``: whether it is noise inside an article or main."""

    __slots__ = ("tag", "parent", "noise", "inner", "parts")

    def __init__(self, tag: str, parent: Node | None, noise: int, inner: bool = False):
        self.tag, self.parent, self.noise, self.inner, self.parts = tag, parent, noise, inner, []


def _noise(attributes: str) -> int:
    """Names are taken one by one: a word of STATE keeps its own name from being noise, not the others."""
    found = 0
    for token in _names(attributes):
        words = WORD.findall(token)
        if not NOISE.isdisjoint(words) and STATE.isdisjoint(words):
            found = max(found, 1 if BESIDE.isdisjoint(words) else 2)
    return found


def _names(attributes: str) -> list[str]:
    return [token for name, a, b, c in NAMED.findall(attributes) if name.lower() != "aria-label" for token in (a or b or c).lower().split()]


def parse(page: str) -> Node:
    """Element tree of a page, as forgiving as browsers about missing end tags. Contents of raw
    elements (scripts, styles, ...) and comments are left out; text stays undecoded."""
    root = node = Node("", None, 0)
    open_tags: Counter[str] = Counter()
    at, size = 0, len(page)

    def close(upto: Node) -> Node:
        at_node = node
        while at_node is not upto:
            open_tags[at_node.tag] -= 1
            at_node = at_node.parent
        open_tags[upto.tag] -= 1
        return upto.parent

    while at < size:
        found = TOKEN.search(page, at)
        if found is None:
            cut = page.rfind("<", at)
            rest = page[at:cut] if cut >= 0 and re.match(r"</?[a-zA-Z]", page[cut:]) else page[at:]  # a tag cut off by the end
            if rest:
                node.parts.append(rest)
            break
        if found.start() > at:
            node.parts.append(page[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if open_tags[tag] > 0:
                up = node
                while up.tag != tag and (tag in BLOCKS or up.tag not in BLOCKS):
                    up = up.parent
                if up.tag == tag:
                    node = close(up)
            elif tag == "p":
                node.parts.append(Node("p", node, 0))  # an empty paragraph, as browsers make of it
            continue
        for above in ("p", "li", "dt", "dd", "option", "tr", "td", "th"):
            if open_tags[above] > 0 and tag in CLOSED_BY[above]:
                up = node
                while up is not root and up.tag != above and (up.tag not in BLOCKS or above == "tr" and up.tag in ("td", "th")):
                    up = up.parent
                if up.tag == above:
                    node = close(up)
        attributes = found[3]
        if tag in VOID:
            node.parts.append(Node(tag, node, 0))
        elif tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.IGNORECASE).search(page, at)
            close_at = page.find(">", end.start()) if end else -1
            at = close_at + 1 if close_at >= 0 else size
            node.parts.append(Node(tag, node, 2, True))
        else:
            named = bool(attributes) and tag in BLOCKS and tag not in FRAME
            inner = tag in GONE or named and tag in BOXES and not WITHIN.isdisjoint(_names(attributes))
            new = Node(tag, node, 2 if tag in GONE else _noise(attributes) if named else 0, inner)
            node.parts.append(new)
            if not attributes.endswith("/") or tag in BLOCKS:
                node = new
                open_tags[tag] += 1
    return root


def _walk(top: Node) -> Iterator[tuple[Node, bool]]:
    """Each element twice, before (True) and after (False) what is in it."""
    todo: list[tuple[Node, bool]] = [(top, True)]
    while todo:
        node, first = todo.pop()
        yield node, first
        if first:
            todo.append((node, False))
            todo.extend((part, True) for part in reversed(node.parts) if isinstance(part, Node))


def content_roots(root: Node) -> list[Node]:
    """Outermost articles outside noise; else main; else those inside elements that are noise by
    name only; else the whole page."""
    for most in (0, 1):
        for wanted in ("article", "main"):
            found, todo = [], [root]
            while todo:
                node = todo.pop()
                if node.noise > most:
                    continue
                if node.tag == wanted:
                    found.append(node)
                else:
                    todo.extend(part for part in reversed(node.parts) if isinstance(part, Node))
            if found:
                return found
    return [root]


def subtree_hashes(top: Node) -> dict[int, int]:
    """64-bit hashes, by identity, of the elements that may be template and of all in them: each
    takes in the element's name and the hashes and squeezed texts of its parts."""
    out: dict[int, int] = {}
    todo = [top]
    while todo:
        node = todo.pop()
        if not removable(node):
            if node.tag not in PROSE:
                todo.extend(part for part in node.parts if isinstance(part, Node))
            continue
        for inner, first in _walk(node):
            if not first:
                parts = [" ".join(p.split()) if isinstance(p, str) else format(out[id(p)], "x") for p in inner.parts]
                name = f"{inner.tag}\n" + "\n".join(p for p in parts if p)
                out[id(inner)] = _hash(name)
    return out


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def content_key(root: Node) -> int:
    """Hash of all text in a page's content, template or not."""
    texts = []
    for top in content_roots(root):
        texts += [part for node, first in _walk(top) if first for part in node.parts if isinstance(part, str)]
    return _hash("\n".join(texts))


def removable(node: Node) -> bool:
    return node.tag in BLOCKS and node.tag not in PROSE and node.tag not in ("html", "body", "article", "main")


def inside_hashes(top: Node, hashes: dict[int, int]) -> dict[int, int]:
    """By identity, the hashes of the elements below an article or main that may be template there."""
    return {id(n): hashes[id(n)] ^ INSIDE for n, first in _walk(top) if first and n is not top and removable(n) and n.tag not in PIECES and id(n) in hashes}


def main_text(page: str | None, templates: frozenset[int] = frozenset()) -> str:
    """Text blocks of a page's content, without noise and template subtrees."""
    root = parse(page or "")
    blocks: list[str] = []
    pending: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(pending)).split())
        pending.clear()
        if text:
            blocks.append(text)

    for top in content_roots(root):
        hashes = subtree_hashes(top) if templates else {}
        if top is not root:
            hashes = inside_hashes(top, hashes)
        todo: list[object] = [top]
        while todo:
            part = todo.pop()
            if part is None:
                flush()
            elif isinstance(part, str):
                pending.append(part)
            elif part.tag == "br":
                pending.append("\n")
            elif not (part.noise if top is root else part.inner) and part.tag not in VOID and not (removable(part) and hashes.get(id(part)) in templates):
                block = part.tag in BLOCKS
                if block:
                    flush()
                    todo.append(None)
                todo.extend(reversed(part.parts))
            elif part.tag in BLOCKS:
                flush()
        flush()
    return "\n\n".join(blocks)


def host_of(url_col: str = "url"):
    """Lower-case host of a URL; empty when there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """host, templates: sorted hashes of the subtrees that recur on a host.

    Pages of equal content count once, so that copies of an article do not make it template. A
    host's list is bounded: at most 1 / least_share times the mean number of subtrees of its pages.
    """

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, hashes, places = [], [], [], []
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                root = parse(page.as_py() or "")
                found = subtree_hashes(root)
                inside = {h for top in content_roots(root) if top is not root for h in inside_hashes(top, found).values()}
                seen = {0: False} | dict.fromkeys(found.values(), False) | dict.fromkeys(inside, True)
                hosts += [host] * len(seen)
                keys += [content_key(root)] * len(seen)
                hashes += seen
                places += seen.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(hashes, pa.int64()), pa.array(places, pa.bool_())], ["host", "content", "hash", "inside"]
            )

    rows = map_batches(pages, subtrees, "host string, content long, hash long, inside boolean")
    # Hash 0 stands for the page itself, so its count is the host's number of different pages.
    counts = stage(rows.distinct().groupBy("host", "hash", "inside").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages))
    of_host = counts.where("hash = 0").select("host", F.col("n").alias("pages"))
    enough = F.when(F.col("inside"), F.col("n") > F.col("pages") * MOST_SHARE).otherwise(F.col("n") >= F.col("pages") * least_share)
    many = sized_join(counts.where("hash <> 0"), stage(of_host), ["host"], "inner").where(enough)
    return stage(many.groupBy("host").agg(F.sort_array(F.collect_set("hash")).alias("templates")))


def extract_text(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """page_id, url, text, n_chars per page.

    Null html is an empty page; a null or odd url counts as a host without a name. Repeated rows
    give repeated results. Inside an article or main only elements of their own (nav, aside, form, ...),
    boxes that bear a whole name of ``WITHIN``, and templates are left out; formulas keep their text,
    drawings (svg) have none. Text is empty if a page has none; broken markup is read as far as it
    goes. Other columns are ignored.
    """
    rows = pages.select("page_id", "url", "html", host_of().alias("host"))
    found = sized_join(rows, templates(rows.select("host", "html"), least_pages, least_share), ["host"], "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset[int]] = {}
        for batch in batches:
            texts = []
            for host, page, own in zip(batch.column("host").to_pylist(), batch.column("html"), batch.column("templates"), strict=True):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = frozenset(own.as_py() or ())
                texts.append(main_text(page.as_py(), known[host]))
            sizes = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    types = dict(pages.dtypes)
    return map_batches(found, extract, f"page_id {types['page_id']}, url string, text string, n_chars long")


@query("op3_html_text")
def op3_html_text(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))
