"""HTML extraction by site style trees (operator 8).

The DOMs of one host are merged into a tree of paths (tag and class names).
For a path on m pages, the entropy of its presentations (sequences of child
tags) and of its contents (sentences and link targets, base m) tells how much
pages differ there; its composite importance adds what lies below, discounted
by level.  Branches of low importance are the site's furniture and leave every
page, inside articles too; only page, body, article and main elements
themselves stay.  Branches whose tag, class or role names them furniture go as
well, unless a form or name rule would take most of the page's text.  Only counts per
(host, path, feature) are shuffled, so a host with a third of all pages is
many small keys; equal pages of a host count once.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

#: Discount of a level, importance under which a branch goes, and pages a path must be on to be judged.
GAMMA, LOW, LEAST_PAGES = 0.9, 0.3, 4
BROADCAST_HOSTS = 20_000

#: Elements without article text, and names (in class, id or role) of a page's furniture.
NO_TEXT = frozenset("script style noscript template nav footer aside form button select textarea iframe svg canvas head menu dialog object".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header login masthead menu modal nav navbar navigation newsletter notice notification notifications overlay pager pagination "
    "popup promo related respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets "
    "complementary contentinfo alert alertdialog menubar".split())
READERS = frozenset(["comment", "comments", "respond", "disqus"])
MAIN = ("article", "main")
#: Elements of NO_TEXT that may as well hold a page, names beside which "header" means a text's own, and characters of text (about two
#: sentences) from which text outside articles weighs against them.
WRAPS = frozenset("form object dialog menu".split())
OWN_HEADER = frozenset("entry post article story title".split())
LEAST_TEXT = 160

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""", re.S)
_ATTR = re.compile(r""""[^"]*"|'[^']*'|([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
#: Names that tell of the page and not of the element: has-sidebar, no-comments, ad-free, search-page.
_STATE = re.compile(r"(?<!\S)(?:(?:has|with|without|no|not)[-_]\S+|\S+[-_](?:free|page))(?!\S)")
_WS = re.compile(r"[\x20\x09-\x0D]+")
_SENTENCE = re.compile(r"(?<=[.!?])[\x20\x09-\x0D]+")


class Node:
    """An element of a page: its path of names, whether it goes, the rule that would take it if it is not most of the page, its children
    and texts in order."""
    __slots__ = ("tag", "path", "gone", "rule", "parts", "links", "mass", "plain", "mains")

    def __init__(self, tag: str, path: str, gone: bool, rule: str = ""):
        self.tag, self.path, self.gone, self.rule = tag, path, gone, rule
        self.mass = self.plain = self.mains = 0
        self.parts: list[Node | str] = []
        self.links: list[str] = []


def parse(page: str) -> Node:
    """The tree of a page. Unclosed elements end with what holds them; a new block ends an open paragraph."""
    root = Node("", "", False)
    stack, at, n = [root], 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            stack[-1].parts.append(page[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag not in INLINE:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p" or tag == "li" and stack[i].tag == "li":
                    del stack[i:]
                    break
                if stack[i].tag not in INLINE:
                    break
        names = {k.lower(): _html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(m[3]) if k} if m[3] else {}
        said = " ".join(names.get(k, "") for k in ("class", "id", "role")).lower()
        words = set(re.findall(r"[a-z0-9]+", _STATE.sub(" ", said)))
        inside = any(x.tag in MAIN for x in stack)
        gone = tag in NO_TEXT and tag not in WRAPS or "hidden" in names
        if "header" in words and (inside or words & OWN_HEADER):
            words.discard("header")
        rule = ""
        if tag in MAIN or tag not in ("html", "body") and words & READERS:
            rule = "readers" if words & READERS else ""
        elif tag not in ("html", "body"):
            rule = "furniture" if tag in WRAPS or tag == "header" and not inside or words & FURNITURE else ""
        kind = ".".join([tag, *names.get("class", "").lower().split()])
        node = Node(tag, f"{stack[-1].path}>{kind}", gone, rule)
        if "href" in names:
            node.links.append(names["href"])
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = end.start() if end else n
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
    return root


def settle(root: Node, low: frozenset) -> dict[str, int]:
    """Mark what goes from a page; the characters of text left outside links, in all ("") and inside each of MAIN.

    A rule by form or name takes a branch unless that is most of the text of the
    page, and either holds its articles or has LEAST_TEXT; readers' comments also
    stay only if no other text does.  An inline element beside text is part of a
    sentence, however often it recurs.
    """
    order, work = [], [(root, False)]
    while work:
        x, link = work.pop()
        order.append(x)
        link = link or x.tag == "a"
        sentence = any(isinstance(part, str) and not part.isspace() for part in x.parts)
        for part in x.parts:
            if isinstance(part, str):
                x.mass += 0 if link else len("".join(part.split()))
            else:
                part.gone = part.gone or part.path in low and not (sentence and part.tag in INLINE)
                if not part.gone:
                    work.append((part, link))
        x.plain = x.mass
    own = {id(x): x.mass for x in order}
    for x in reversed(order):  # children come after what holds them
        x.mains = (x.tag in MAIN and x.rule != "readers") + sum(p.mains for p in x.parts if not isinstance(p, str) and not p.gone)
        x.mass += sum(p.mass for p in x.parts if not isinstance(p, str) and not p.gone)
        x.plain += sum(p.plain for p in x.parts if not isinstance(p, str) and not p.gone and not p.rule)
    plain, left = root.plain, dict.fromkeys(["", *MAIN], 0)
    work = [(root, frozenset())]
    while work:
        x, inside = work.pop()
        if x.rule:
            most = 2 * x.mass > root.mass
            if x.rule == "readers":
                x.gone = not (most and (x.mains or not plain))
            else:
                x.gone = not (most and (x.mains == root.mains or x.mass >= LEAST_TEXT))
            if x.gone:
                continue
            plain += x.plain
        if x.tag in MAIN:
            inside = inside | {x.tag}
        for k in ("", *inside):
            left[k] += own[id(x)]
        work += [(p, inside) for p in x.parts if not isinstance(p, str) and not p.gone]
    return left


def text_blocks(node: Node, within: tuple[str, ...] | None) -> list[str]:
    """The blocks of the branches that stay, in page order; ``within``: only those inside elements of these tags."""
    blocks: list[str] = []
    now: list[str] = []

    def close():
        text = _WS.sub(" ", _html.unescape("".join(now))).strip(" ")
        if text:
            blocks.append(text)
        now.clear()

    work = [(node, within is None, 0)]
    while work:  # (node, inside, next part), without recursion however deep a page nests
        x, inside, k = work.pop()
        if k == 0:
            if x.gone:
                continue
            inside = inside or within is not None and x.tag in within
            if x.tag not in INLINE:
                close()
        while k < len(x.parts):
            part = x.parts[k]
            k += 1
            if isinstance(part, str):
                if inside:
                    now.append(part)
            elif part.tag == "br":
                now.append(" ")
            else:
                work.append((x, inside, k))
                work.append((part, inside, 0))
                break
        else:
            if x.tag not in INLINE:
                close()
    close()
    return blocks


def main_text(page: str, low: frozenset = frozenset()) -> str:
    """The text of a page without the branches that go: of its articles, else its main part, else its body.

    Articles or main parts are passed over if more text, LEAST_TEXT at least, lies outside them.
    """
    root = parse(page)
    left = settle(root, low)
    for tag in (*MAIN, None):
        outside = left[""] - left[tag] if tag else 0
        if tag and outside > left[tag] and outside >= LEAST_TEXT:
            continue
        blocks = text_blocks(root, (tag,) if tag else None)
        if blocks:
            return "\n\n".join(blocks)
    return ""


def _hash(s: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


def _profile(page: str) -> tuple[list[dict], int]:
    """(paths of a page with their presentation and contents, a number for all contents)."""
    found: dict[str, list] = {}
    work = [parse(page)]
    while work:
        x = work.pop()
        if x.tag in RAW:
            continue
        style, texts = [], []
        for part in x.parts:
            if isinstance(part, str):
                texts += [t for t in _SENTENCE.split(part) if t.strip()]
            else:
                if not style or style[-1] != part.tag:
                    style.append(part.tag)  # a run of alike children is one presentation
                work.append(part)
        got = found.setdefault(x.path, [0, set()])
        got[0] = (got[0] * 31 + _hash(" ".join(style))) & 0x7FFFFFFFFFFFFFFF
        got[1].update(_hash(t.strip()) for t in texts)
        got[1].update(_hash("href " + t) for t in x.links)
    rows = [{"path": p, "style": s, "features": sorted(f)} for p, (s, f) in found.items()]
    whole = 0
    for r in sorted(rows, key=lambda r: r["path"]):
        whole = _hash(f"{whole} {r['path']} {r['features']}")
    return rows, whole


def host_of(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance): the merged tree of every host of ``pages`` (url, html).

    A page without a host (null or odd url) belongs to the host "".  Paths on a
    single page have importance 1.
    """
    node = "array<struct<path string, style long, features array<long>>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("path", pa.string()), ("style", pa.int64()), ("features", pa.list_(pa.int64()))]))
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                got = [_profile(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([w for _, w in got], pa.int64()), pa.array([r for r, _ in got], kind)],
                                                 names=["host", "whole", "nodes"])

    seen = pages.select(host_of().alias("host"), "html").mapInArrow(run, f"host string, whole long, nodes {node}")
    n = seen.dropDuplicates(["host", "whole"]).select("host", F.explode("nodes").alias("n")).select("host", "n.path", "n.style", "n.features")
    n = stash(n)
    styles = (n.groupBy("host", "path", "style").agg(F.count("*").alias("c")).groupBy("host", "path")
              .agg(F.sum("c").alias("pages"), F.sum(F.col("c") * F.log("c")).alias("s")))
    contents = (n.select("host", "path", F.explode("features").alias("f")).groupBy("host", "path", "f").agg(F.count("*").alias("c"))
                .groupBy("host", "path").agg(F.sum("c").alias("fn"), F.sum(F.col("c") * F.log("c")).alias("fs")))
    t = styles.join(contents, ["host", "path"], "left")
    m = F.col("pages").cast("double")
    # entropies to the base of the pages: of presentations, and of a feature on c of m pages log c / log m
    look = F.when(m > 1, 1 - F.col("s") / (m * F.log(m))).otherwise(1.0)
    content = F.when(F.col("fn").isNotNull(), F.when(m > 1, 1 - F.col("fs") / (F.col("fn") * F.log(m))).otherwise(1.0))
    own = stash(t.select("host", "path", "pages", F.greatest(F.coalesce(content, look), F.lit(0.0)).alias("own"),
                         F.coalesce("fn", F.lit(0)).alias("weight")))
    # what lies below counts by its contents, discounted by level
    steps = F.split(F.substring("path", 2, 1 << 30), ">")
    up = own.select("host", "own", "weight", F.size(steps).alias("d"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(F.lit(">"), F.array_join(F.slice(steps, 1, i), ">")))).alias("path"))
    depth = F.size(F.split(F.substring("path", 2, 1 << 30), ">"))
    w = F.pow(F.lit(GAMMA), (F.col("d") - depth).cast("double")) * (F.col("weight") + F.lit(1e-3))
    comp = up.groupBy("host", "path").agg((F.sum(w * F.col("own")) / F.sum(w)).alias("importance"))
    return own.select("host", "path", "pages").join(comp, ["host", "path"])


def low_branches(pages: DataFrame) -> DataFrame:
    """(host, low): the paths to remove from the pages of a host, never a page, body, article or main element itself."""
    t = style_tree(pages).where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LOW))
    t = t.where(~F.col("path").rlike(r"^>html$|>(body|article|main)(\.[^>]*)?$"))
    return t.groupBy("host").agg(F.collect_set("path").alias("low"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).

    ``text`` is the article's blocks joined by two line feeds; null, empty and
    broken html give what text there is, or an empty string.  Repeated rows stay,
    an empty table gives no rows, and other columns are not read.
    """
    low = stash(low_branches(pages))
    few = low.count() <= BROADCAST_HOSTS
    low = low.select(F.col("host").alias("_host"), "low")
    j = pages.select("page_id", "url", "html", host_of().alias("_h"))
    j = j.join(F.broadcast(low) if few else low, F.col("_h") == F.col("_host"), "left").select("page_id", "url", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [main_text(t or "", frozenset(s or ())) for t, s in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return j.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def query(pages: DataFrame) -> DataFrame:
    return extract(pages)
