"""Main text of web pages: site templates are found by counting element subtrees per host.

Every element with text gets a hash of its subtree: tag, class and id, text with digits
folded, and the hashes of its children in order. Spark counts on how many pages of a host
each subtree stands. A subtree on at least ``least`` pages and a share of at least
``share`` of the host's pages is part of the site's template and is deleted from every
page of the host, unless

- it holds the page's article (article, main, role=main) or its first heading,
- it is running text of an article (paragraphs, headings, lists items, inline elements):
  a sentence that many articles share is no template,
- most of its pages have the same context (the least hash of a page's longer blocks):
  copies of one page are no template.

Templates too rare to be counted are known by their elements: navigation, header outside
the article, footer, aside, forms and controls, scripts, styles, hidden elements, and
class, id or role words for menus, adverts, notices, sidebars, sharing and comments.

What is left of the article (of all articles, where a page has several; of the body, where
it has none) is the text: character references decoded, white space of a block folded to
one space, blocks joined by one space in page order.

NULL html is empty; a page without text has the text ''. Pages without a host (NULL url or
no ``://``) are no part of any template. Unclosed and misnested elements are closed as
browsers do. Repeated rows are extracted side by side and counted each. An empty table
gives no row. Other columns are not read. Time is linear in the length of a page.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrier.session import cut_lineage

TAG = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)")
CUT_TAG = re.compile(r"<[a-zA-Z/!?]")
COMMENT_END = re.compile(r"--!?>")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
OPEN_QUOTE = re.compile(r"""=\s*(["'])""")
DIGITS = re.compile(r"\d+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
# Elements that end no block although they are no text.
NO_BREAK = INLINE | frozenset("area audio canvas embed iframe img input link map meta noscript object param picture script source style svg template track video wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
P_SCOPE = frozenset("button caption html table td template th object".split())
# An element that ends open ones of its kind, and what keeps them open.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")),
        "option": (("option",), ("select", "datalist"))}
RUNNING = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption figure caption td th tr tbody thead tfoot body html".split())

# Elements that are no part of an article.
DROPPED = frozenset("applet aside audio button canvas datalist dialog embed footer form frameset head iframe input map menu nav noembed noframes noscript object option script select style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Words of class and id that name what is no part of an article.
WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner banners breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies disqus footer gdpr login masthead menu menubar menus modal nav "
    "navbar navigation newsletter notice notices overlay pager pagination popup promo promotion recommended related reply replies respond "
    "share sharing sidebar sidebars signup skyscraper social sponsor sponsored subscribe toolbar widget widgets".split())
READERS = frozenset("comment comments commentlist disqus replies reply respond".split())
HEADERS = frozenset("header masthead topbar".split())  # only outside the article
NEGATED = ("no-", "has-", "with-", "without-", "not-")


class Page:
    """The elements of a page and its text in pieces, each owned by an element."""

    def __init__(self, html: str):
        self.tags, self.parents, self.attributes = ["#page"], [-1], [""]
        self.owners: list[int] = []
        self.texts: list[str] = []
        self._stack, self._open = [0], {}
        self._read(html)

    def _text(self, text: str) -> None:
        if text:
            self.owners.append(self._stack[-1])
            self.texts.append(text)

    def _push(self, tag: str, attributes: str) -> None:
        self.parents.append(self._stack[-1])
        self._open.setdefault(tag, []).append(len(self._stack))
        self._stack.append(len(self.tags))
        self.tags.append(tag)
        self.attributes.append(attributes)

    def _pop_to(self, depth: int) -> None:
        while len(self._stack) > depth:
            self._open[self.tags[self._stack.pop()]].pop()

    def _last(self, tags) -> int:
        return max([0, *(self._open[t][-1] for t in tags if self._open.get(t))])

    def _whole(self, html: str, match, end: int) -> tuple[str, int]:
        """Attributes of a start tag and where it ends; a quoted value may hold '>'."""
        attributes, stop = match[4], match.end()
        while "=" in attributes and (quote := OPEN_QUOTE.search(QUOTED.sub("", attributes))):
            if stop > self._quotes.setdefault(quote[1], html.rfind(quote[1])):
                break
            close = html.find(">", html.find(quote[1], stop - 1) + 1, end)
            if close < 0:
                break
            attributes, stop = html[match.start(4): close], close + 1
        return attributes, stop

    def _read(self, html: str) -> None:
        self._quotes: dict[str, int] = {}
        end, at = html.rfind(">") + 1, 0              # no tag can begin after the last '>'
        while match := TAG.search(html, at, end):
            self._text(html[at: match.start()])
            at = match.end()
            if match[1]:
                # "<!-->" and "<!--->" are whole comments.
                closed = at if html.startswith((">", "->"), at) else None
                done = COMMENT_END.search(html, at) if closed is None else None
                at = html.find(">", at) + 1 if closed is not None else done.end() if done else len(html)
                continue
            if not match[3]:
                continue
            tag = match[3].lower()
            if match[2]:
                self._end(tag)
                continue
            attributes, at = self._whole(html, match, end)
            self._begin(tag, attributes)
            if tag in RAW:
                done = RAW_END[tag].search(html, at)
                stop = done.start() if done else len(html)
                if tag in ("textarea", "title"):
                    self._text(html[at: stop])
                at = stop
                if at == len(html):
                    return
        cut = CUT_TAG.search(html, at)                # a tag that the page's end cuts off is no text
        self._text(html[at: cut.start()] if cut else html[at:])

    def _begin(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P and self._open.get("p") and self._open["p"][-1] > self._last(P_SCOPE):
            self._pop_to(self._open["p"][-1])
        if tag in ENDS:
            own, around = ENDS[tag]
            inner, outer = self._last(own), self._last(around)
            while inner > outer:
                self._pop_to(inner)
                inner = self._last(own)
        if tag not in NO_BREAK:
            self._text(" ")
        if tag in VOID:
            return
        self._push(tag, attributes)
        if tag not in NO_BREAK:
            self._text(" ")

    def _end(self, tag: str) -> None:
        if tag not in NO_BREAK:
            self._text(" ")
        places = self._open.get(tag)
        if not places:
            return
        depth = places[-1]
        if tag in INLINE and any(self.tags[i] not in INLINE for i in self._stack[depth + 1:]):
            return                                    # closed with the block it stands in
        if tag == "p" and depth < self._last(P_SCOPE):
            return
        self._pop_to(depth)
        if tag not in NO_BREAK:
            self._text(" ")

    # --- what elements are ------------------------------------------------------------

    def attribute(self, i: int) -> dict[str, str]:
        text = self.attributes[i]
        if not text.strip():
            return {}
        return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}

    def look(self) -> None:
        """Settle which elements are articles, which hold one, and which are named as no part of it."""
        n = len(self.tags)
        self.article, self.inside, self.holds, self.gone = ([False] * n for _ in range(4))
        self.keys, self.first = list(self.tags), -1
        named, heading, outside = [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            tag, p, by_name = self.tags[i], self.parents[i], self.attribute(i)
            role = by_name.get("role", "").strip().lower()
            classes = " ".join((by_name.get("class", ""), by_name.get("id", ""))).split()
            if classes:
                self.keys[i] = tag + " " + " ".join(classes)
            words = {w.lower() for c in classes if not c.lower().startswith(NEGATED) for w in WORD.findall(c)}
            style = by_name.get("style", "").replace(" ", "").lower()
            # Nothing within these is an article, whatever it says.
            outside[i] = outside[p] or (tag in DROPPED and tag != "form") or bool(words & READERS)
            self.article[i] = not outside[i] and (tag in ("article", "main") or role == "main" or by_name.get("itemprop") == "articleBody")
            self.inside[i] = self.inside[p] or self.article[i]
            named[i] = tag in DROPPED or role in ROLES or "hidden" in by_name or "display:none" in style or bool(words & WORDS)
            heading[i] = not self.inside[i] and (tag == "header" or bool(words & HEADERS))
            if tag == "h1" and self.first < 0 and not outside[i]:
                self.first = i
        self.rooted = any(self.article)
        for i in range(n - 1, 0, -1):
            self.holds[self.parents[i]] |= self.holds[i] or self.article[i] or (not self.rooted and i == self.first)
        for i in range(1, n):
            kept = self.holds[i] or self.article[i] or self.tags[i] in ("html", "body")
            head = heading[i] and not (self.rooted and self.holds[i])
            self.gone[i] = self.gone[self.parents[i]] or outside[i] or (named[i] and not kept) or (head and self.tags[i] not in ("html", "body"))

    def digests(self) -> list[int]:
        """Hash of the subtree of every element; 0 without text."""
        n = len(self.tags)
        items: list[list[bytes]] = [[] for _ in range(n)]
        sizes = [0] * n
        out = [0] * n
        # Pieces and children in page order: a child's first piece comes after its parent's earlier ones.
        piece = len(self.texts) - 1
        order = [[] for _ in range(n)]
        for k in range(piece, -1, -1):
            text = self.texts[k].strip()
            if text:
                order[self.owners[k]].append((k, text))
        first = [len(self.texts)] * n
        for i in range(n - 1, 0, -1):
            own = order[i]
            children = items[i]
            if own:
                first[i] = min(first[i], own[-1][0])
                sizes[i] += sum(len(t) for _, t in own)
                children = [*children, *((k, DIGITS.sub("0", " ".join(t.split())).encode()) for k, t in own)]
            if sizes[i]:
                children.sort()
                value = xxhash.xxh64_intdigest(b"\x00".join([self.keys[i].encode(), *(b for _, b in children)]))
                out[i] = (value >> 1) or 1
                p = self.parents[i]
                items[p].append((first[i], out[i].to_bytes(8, "little")))
                first[p] = min(first[p], first[i])
                sizes[p] += sizes[i]
            items[i] = []
        return out

    def countable(self, i: int) -> bool:
        """Whether a recurring subtree may be a template."""
        return not (self.holds[i] or self.article[i] or (self.inside[i] and self.tags[i] in RUNNING) or self.tags[i] in ("html", "body", "head", "title") or (i == self.first and not self.rooted))

    def context(self) -> int:
        """The least hash of the longer pieces, which copies of a page share."""
        longer = [t for t in self.texts if len(t) >= 40] or [t for t in self.texts if t.strip()]
        return min((xxhash.xxh64_intdigest(t.encode()) >> 1 for t in longer), default=0)

    def text(self, templates, digests: list[int] | None) -> str:
        """What is left without named elements and templates."""
        n = len(self.tags)
        gone = self.gone
        if templates:
            gone = list(gone)
            for i in range(1, n):
                gone[i] = gone[i] or gone[self.parents[i]] or (digests[i] in templates and self.countable(i))
        kept = [not g and (not self.rooted or i) for g, i in zip(gone, self.inside)]
        pieces = [unescape(t) if "&" in t else t for t, i in zip(self.texts, self.owners) if kept[i]]
        return " ".join("".join(pieces).split())


def subtrees(html: str | None) -> tuple[set[int], int]:
    """Hashes of a page's subtrees that may be templates, and its context."""
    page = Page(html or "")
    page.look()
    return {d for i, d in enumerate(page.digests()) if d and page.countable(i)}, page.context()


def main_text(html: str | None, templates=frozenset()) -> str:
    """Main text of one page; ``templates`` holds hashes of subtrees to delete."""
    page = Page(html or "")
    page.look()
    return page.text(templates, page.digests() if templates else None)


def host(url: str = "url") -> Column:
    """Hash of the host of a URL; NULL without one."""
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.when(F.length(after) > 0, F.xxhash64(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def site_templates(pages: DataFrame, least: int = 5, share: float = 0.005) -> DataFrame:
    """host, digest: the subtrees that recur across the pages of a host; see the module's docstring.

    A host has at most (mean number of subtrees a page) / ``share`` templates. Counts of a
    batch leave it summed; a host with many pages is summed by subtree and context first.
    """
    def count(batches):
        for batch in batches:
            seen: Counter = Counter()
            for h, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, context = subtrees(html)
                seen.update((h, d, context) for d in found)
                seen[h, 0, 0] += 1
            columns = list(zip(*((*k, n) for k, n in seen.items()))) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["host", "digest", "context", "n"])

    known = pages.select(host().alias("host"), "html").where("host IS NOT NULL")
    counted = known.mapInArrow(count, "host long, digest long, context long, n long")
    by_context = counted.groupBy("host", "digest", "context").agg(F.sum("n").alias("n"))
    both = by_context.groupBy("host", "digest").agg(F.sum("n").alias("pages"), F.max("n").alias("alike"))
    both = cut_lineage(both.where((F.col("pages") >= least) | (F.col("digest") == 0)), "subtrees")
    totals = both.where("digest = 0").select("host", F.col("pages").alias("total"))
    recurring = both.where((F.col("digest") != 0) & (F.col("alike") * 2 <= F.col("pages")))
    return recurring.join(totals, "host").where(F.col("pages") >= F.lit(share) * F.col("total")).select("host", "digest")


def extract(pages: DataFrame, least: int = 5, share: float = 0.005, few: int = 500_000) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Templates are counted first. Up to ``few`` of them go to every task as a list of
    numbers; beyond that pages meet the list of their host in a join.
    """
    templates = cut_lineage(site_templates(pages, least, share), "templates")
    rows = pages.select("page_id", "url", "html", host().alias("host"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {id_type}, url string, text string, n_chars long"

    def render(batches, lists):
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "page_id"}
            texts = [main_text(html, found) for html, found in zip(columns["html"], lists(columns))]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    if templates.count() <= few:
        found = templates.toPandas()                  # at most ``few`` rows of two numbers
        order = np.lexsort((found["digest"], found["host"]))
        hosts, digests = found["host"].to_numpy(np.int64)[order], found["digest"].to_numpy(np.int64)[order]

        def broadcast(batches):
            ready: dict = {None: frozenset()}

            def of(h):
                if h not in ready:
                    a, b = np.searchsorted(hosts, h, "left"), np.searchsorted(hosts, h, "right")
                    ready[h] = frozenset(digests[a:b].tolist())
                return ready[h]

            yield from render(batches, lambda columns: [of(h) for h in columns["host"]])

        return rows.mapInArrow(broadcast, schema)
    lists = templates.groupBy("host").agg(F.collect_list("digest").alias("found"))
    joined = rows.join(lists, "host", "left").select("page_id", "url", "html", "found")
    return joined.mapInArrow(lambda batches: render(batches, lambda columns: [frozenset(x or ()) for x in columns["found"]]), schema)
