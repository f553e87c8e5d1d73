"""Main text of web pages by scoring the tree.

A page becomes a tree of its block elements in one pass over its markup. Each
paragraph passes points for its length and commas to its ancestors, half as many
to each next one; a container's points are discounted by the share of its text
inside links. The best container and those siblings that score like it are kept,
or all of the article element that it stands in, without elements whose tag,
role or class says that they are something else. No network of rules about one
site is used, and every block that is left is given whole.

Null, empty and odd input: a null page is an empty one and gives an empty text;
unclosed and misnested tags are closed as browsers do; very long pages are read
whole, in time linear in their length, however deep, broken or unclosed their
markup is; of containers that score alike the first one is best; a page without
any paragraph gives an empty text; repeated rows give the same text; an empty
table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: What follows the name of a tag: quotes may hold a >, unless they never close.
QUOTED = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
NAME = re.compile(r"[A-Za-z][^\s/>]*")
MOST_OPEN_QUOTES = 8  # tags whose quotes never close; after so many, quotes no longer hide a >
ATTR = re.compile(r"""([A-Za-z_:][-A-Za-z0-9_:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes svg select annotation annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
INLINE = frozenset("span b i em strong small label ins font u mark q cite sup sub".split())
CELLS = frozenset("td th caption table".split())
WHOLE = frozenset("table tr tbody thead tfoot html body td th caption".split())
SCOPE = CELLS | frozenset("html body button".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "tbody": ("tbody thead tfoot tr td th", ("table",)), "thead": ("tbody thead tfoot tr td th", ("table",)), "tfoot": ("tbody thead tfoot tr td th", ("table",))}
#: What is not the article, by tag, role or a word of class and id.
OTHER_TAGS = frozenset("nav footer aside form menu dialog button fieldset".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
OTHER_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs bookmark comment comments commentlist consent cookie cookies disclaimer disqus footer form gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion recommended related remark replies reply respond rail share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags teaser toc toolbar widget widgets hidden".split())
MODIFIERS = frozenset("has with no without not is show layout".split())
NEVER = frozenset("ad ads comment comments sidebar footer nav".split())
MAIN_WORDS = frozenset("article body content entry main page post story text column hentry".split())
PARAGRAPH = frozenset("p pre td blockquote div section article main body dd li center figcaption".split())
BONUS = {"article": 25.0, "main": 15.0, "div": 5.0, "section": 3.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "form": -3.0, "address": -3.0, "header": -5.0, "th": -5.0}
LEAST = 25
HIDDEN, ASIDE = 1, 2
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())


class Open:
    """The open elements, with the places of each tag among them, so that none is searched for."""

    def __init__(self):
        self.items: list[tuple[str, int, bool, int]] = []  # tag, node around it, is it a link, is it hidden or an aside
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def __len__(self) -> int:
        return len(self.items)

    def push(self, tag: str, *rest) -> None:
        self.places.setdefault(tag, []).append(len(self.items))
        if tag in BLOCK:
            self.blocks.append(len(self.items))
        self.items.append((tag, *rest))

    def pop(self) -> tuple[str, int, bool, int]:
        item = self.items.pop()
        self.places[item[0]].pop()
        if item[0] in BLOCK:
            self.blocks.pop()
        return item

    def top(self) -> str:
        return self.items[-1][0]

    def last(self, tags) -> int:
        """The innermost place of any of some tags, or -1."""
        if tags is BLOCK:
            return self.blocks[-1] if self.blocks else -1
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def first(self, tags, after: int) -> int:
        """The outermost place of any of some tags that is inside place ``after``, or -1."""
        found = [own[k] for t in tags if (own := self.places.get(t)) and (k := bisect_right(own, after)) < len(own)]
        return min(found, default=-1)


class Page:
    """The block tree of a page: parallel lists by node, and its text blocks in page order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.other, self.main = ["body"], [-1], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters inside links
        self.read(source)

    def says(self, tag: str, attrs: str) -> tuple[bool, bool]:
        """Does an element say that it is something other than the article; or that it is the article?"""
        other, main = tag in OTHER_TAGS, tag in ("article", "main")
        if attrs and tag not in ("html", "body"):
            named = {k.lower(): v.strip("\"'").lower() for k, v in ATTR.findall(attrs)}
            for one in f"{named.get('class', '')} {named.get('id', '')}".split():
                said = re.split(r"[^a-z0-9]+", one)
                if said[0] not in MODIFIERS and not OTHER_WORDS.isdisjoint(said) and not main and (MAIN_WORDS.isdisjoint(said) or not NEVER.isdisjoint(said)):
                    other = True
            role = named.get("role", "")
            other |= role in OTHER_ROLES or "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "")
            main |= role in ("main", "article")
        return other, main

    def node(self, tag: str, parent: int, attrs: str) -> int:
        other, main = self.says(tag, attrs)
        self.tag.append(tag)
        self.parent.append(parent)
        self.other.append(other)
        self.main.append(main)
        return len(self.tag) - 1

    def hidden(self, attrs: str) -> bool:
        named = {k.lower(): v.strip("\"'").lower() for k, v in ATTR.findall(attrs)}
        return "hidden" in named or "display:none" in named.get("style", "").replace(" ", "")

    def read(self, source: str) -> None:
        stack = Open()
        at, node, links = 0, 0, 0
        text: list[str] = []
        linked = hidden = inside = begun = 0  # open elements that are hidden, or asides; where the outermost aside begins in ``text``
        asides: list[tuple[int, int]] = []

        def flush() -> None:
            nonlocal linked, begun
            if text:
                words, rest, k = " ".join("".join(text).split()), [], 0
                for a, b in [*asides, (begun, len(text))] if inside else asides:
                    rest += text[k:a]
                    k = b
                # an aside within a sentence belongs to it; a block of nothing else goes
                if words and "".join(rest + text[k:]).strip():
                    self.blocks.append((node, words, min(linked, len(words))))
                text.clear()
            asides.clear()
            linked = begun = 0

        def pop_to(k: int) -> None:
            nonlocal node, links, hidden, inside
            if stack.last(BLOCK) >= k:
                flush()
            while len(stack) > k:
                _, node, link, role = stack.pop()
                links -= link
                hidden -= role == HIDDEN
                if role == ASIDE:
                    inside -= 1
                    if not inside and len(text) > begun:
                        asides.append((begun, len(text)))

        def say(run: str) -> None:
            nonlocal linked
            if run and not hidden:
                if "&" in run:
                    run = html.unescape(run)
                text.append(run)
                if links:
                    linked += len(run.strip())

        end, last = len(source), source.rfind(">")
        raw_ends: dict[str, re.Pattern] = {}
        begin, open_quotes = 0, 0  # where text that isn't read yet begins
        while True:
            at = source.find("<", at)
            if at < 0:
                break
            kind = source[at + 1 : at + 2]
            if source.startswith("<!--", at):
                say(source[begin:at])
                at = source.find("-->", at + 4)
                at = begin = at + 3 if at >= 0 else end
                continue
            if at > last:
                break
            close = kind == "/"
            m = NAME.match(source, at + 1 + close)
            if not m:
                if kind and kind in "!?/":
                    say(source[begin:at])
                    at = begin = source.index(">", at) + 1
                else:
                    at += 1
                continue
            say(source[begin:at])
            stop = QUOTED.match(source, m.end()) if open_quotes < MOST_OPEN_QUOTES else None
            if not stop:
                open_quotes += 1
            name, at = m[0].lower(), stop.end() if stop else source.find(">", m.end()) + 1
            attrs = source[m.end() : at - 1]
            begin = at
            if close:
                if name in VOID:
                    if name == "br":
                        text.append(" ")
                    continue
                k = stack.last((name,))
                # an end tag of an inline element stays in its block, one of a block in its cell
                walls = BLOCK if name not in BLOCK else () if name in WHOLE else CELLS
                if k >= 0 and k >= stack.last(walls):
                    pop_to(k)
                continue
            if name in RAW:
                if name in ("textarea", "select", "title") or not attrs.endswith("/"):
                    if name not in raw_ends:
                        raw_ends[name] = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I)
                    m = raw_ends[name].search(source, at)
                    at = begin = m.end() if m else end
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                elif name in ("br", "wbr", "img", "input"):
                    text.append("" if name == "wbr" else " ")
                continue
            if name not in BLOCK:
                link = name == "a"
                if link and stack.last(("a",)) > stack.last(BLOCK):  # a link never holds another one
                    pop_to(stack.last(("a",)))
                role = 0
                if attrs and ("hidden" in attrs or "none" in attrs) and self.hidden(attrs):
                    role = HIDDEN
                    hidden += 1
                elif attrs and name in INLINE and ("class" in attrs or "role" in attrs) and self.says(name, attrs)[0]:
                    role = ASIDE
                    begun = begun if inside else len(text)
                    inside += 1
                stack.push(name, node, link, role)
                links += link
                continue
            if name in ("html", "body") and stack.last((name,)) >= 0:
                continue
            if stack.last(("p",)) > stack.last(SCOPE):  # a new block ends an open paragraph
                pop_to(stack.last(("p",)))
            if name in HEADING and len(stack) and stack.top() in HEADING:
                pop_to(len(stack) - 1)
            if name in CLOSES:
                ends, stops = CLOSES[name]
                low = stack.first(ends.split(), stack.last(stops))
                if low >= 0:
                    pop_to(low)
            flush()
            stack.push(name, node, False, 0)
            node = self.node(name, node, attrs)
        say(source[begin:])
        pop_to(0)
        flush()

    def main_text(self, trust_names: bool = True) -> str:
        n = len(self.tag)
        tag, parent = self.tag, self.parent
        holds = [False] * n
        for k in range(n - 1, 0, -1):
            if self.main[k] or holds[k]:
                holds[parent[k]] = True
        headed = [False] * n  # headers with a heading, inside the article, are part of it
        for node, _, _ in self.blocks:
            if tag[node] in HEADING:
                while node > 0 and not headed[node]:
                    headed[node] = True
                    node = parent[node]
        dropped, inside = [False] * n, [False] * n
        for k in range(1, n):
            p = parent[k]
            inside[k] = inside[p] or self.main[p]
            other = self.other[k] and (trust_names or tag[k] in OTHER_TAGS) or tag[k] == "header" and not (inside[k] and headed[k])
            dropped[k] = dropped[p] or other and not holds[k]
        kept = [b for b in self.blocks if not dropped[b[0]]]
        chars, linked = [0] * n, [0] * n
        for node, text, inlinks in kept:
            chars[node] += len(text)
            linked[node] += inlinks
        for k in range(n - 1, 0, -1):  # nodes come after the ones around them
            chars[parent[k]] += chars[k]
            linked[parent[k]] += linked[k]
        best = -1
        for least in (LEAST, 1):
            seen, points = [False] * n, [0.0] * n
            for node, text, inlinks in kept:
                if tag[node] not in PARAGRAPH or len(text) < least or 2 * inlinks > len(text):
                    continue
                score = 1.0 + sum(map(text.count, ",，、،")) + min(3, len(text) // 100)
                up = node if tag[node] in ("div", "section", "article", "main", "body", "td", "blockquote") else parent[node]
                points[up] += score
                seen[up] = True
            for k in range(n - 1, 0, -1):  # half of an element's points go to the one around it
                if seen[k]:
                    points[parent[k]] += points[k] / 2
                    seen[parent[k]] = True
            final = [0.0] * n
            for k in range(n):
                if seen[k] and not dropped[k]:
                    final[k] = max(points[k] + BONUS.get(tag[k], 0.0), 0.01) * (1 - linked[k] / max(1, chars[k]))
                    if best < 0 or final[k] > final[best]:
                        best = k
            if best >= 0:
                break
        if best < 0:
            return ""
        roots, up = {best}, best
        while up >= 0 and not (self.main[up] and tag[up] != "main"):
            up = parent[up]
        if up < 0:
            up = best
            while up >= 0 and not self.main[up]:
                up = parent[up]
        if up >= 0:
            roots = {up}
        elif tag[best] not in ("body", "html"):
            bar = max(10.0, 0.2 * final[best])
            length, last = dict.fromkeys(range(n), 0), {}
            for node, text, _ in kept:
                last[node] = text
                length[node] += len(text)
            for k in range(1, n):
                if k == best or parent[k] != parent[best] or dropped[k] or not chars[k]:
                    continue
                density = linked[k] / chars[k]
                like = final[k] >= bar and density < 0.5
                like |= tag[k] == "p" and (length[k] > 80 and density < 0.25 or density == 0 and last.get(k, "").rstrip("\"'”»)").endswith((".", "!", "?", "…")))
                if like or tag[k] in ("h1", "h2", "h3") and not linked[k]:
                    roots.add(k)
        under = [False] * n
        for k in range(1, n):
            under[k] = k in roots or under[parent[k]]
        if 0 in roots:
            under = [True] * n
        return "\n".join(text for node, text, _ in kept if under[node])


def main_text(source: str | None) -> str:
    """The article of a page, one line for each block; empty if there is none."""
    if not source:
        return ""
    page = Page(source)
    return page.main_text() or page.main_text(trust_names=False)


def extract(pages: DataFrame, *, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """All columns of ``pages`` but the markup (and any column named ``out_col``), and the main text."""
    keep = [c for c in pages.columns if c not in (html_col, out_col)]
    schema = pages.select(*(pages[c] for c in keep)).schema.add(out_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(len(keep))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*keep, out_col])

    return pages.select(*(pages[c] for c in keep), pages[html_col].alias("__html")).mapInArrow(run, schema)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
