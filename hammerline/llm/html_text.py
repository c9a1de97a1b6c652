"""Main text of web pages, with templates found by subtree hashes per host.

Every element's subtree is hashed from its tag and content; Spark counts, per host, on how many
pages of different text a hash occurs. Subtrees that recur on many pages of their host are template
and go (from an absolute number of pages on, so that one of many templates of a large host goes
too), inline and custom elements as well unless they are words of a paragraph or stand beside text.
So do elements whose tag, role or class names them as no part of the article. What is left of the
article (of the body, if no element is marked as article or main) is cut into blocks.

Plain paragraphs, headings, list items, table rows and cells of an article are never taken for
template: a text may quote another page of its host, or have a line in common with it. A div of
plain text in an article, or inline elements in its divs, are template only on most pages of the
host. Neither the element that marks the article nor one around it is template, and copies of a page
count once, by their text.

The recurring hashes are handed to the tasks if their measured size allows, and pages are then
parsed where they are read. Beyond that size each page's own recurring hashes are joined to it.

An element with a name of no article stays if it is rather the wrapper of the article: no article,
main or content element with text would be left without it, or it holds most of the page's prose
(nearly all of it, if the name is that of a discussion). In the midst of an article's prose a doubtful
name (a word of a longer class name, or any on a paragraph, unless it means one thing only as
"advert" does) removes an element only together with a second sign: links, controls, or recurrence on
the host. Words after has-, no-, with- are states of
the page, and ids of headings and of an article's sections are anchors; neither is such a name.

Attributes are read by whole names with decoded values. Of several articles of one page the one with
the most text is taken; of the head of an article its headings; the first-level headings of a main
element that stand before its article, where that has none. Asides are no part of it.

Defined cases: NULL html is the empty page with an empty text; NULL or odd urls share the host
''; broken markup is closed as browsers do, cut-off tags are dropped; repeated rows are pages of
their own, but count as one page for templates; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.session import is_small, write_table

# A subtree is template from so many pages of a host on; on hosts of up to MANY_PAGES / LEAST_SHARE
# pages from this share of them, if that is more.
LEAST_PAGES = 5
LEAST_SHARE = 0.1
MANY_PAGES = 20
# A line of plain text in an article's div is template from this share of the pages on.
MOST_PAGES = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody tfoot "
    "thead tr ul".split()
)
ARTICLES = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p blockquote pre".split())
# Lines of an article, beside its prose.
ITEMS = frozenset("li dt dd tr td th".split())
# All others are inline, custom ones as well.
LINES = BLOCKS | ITEMS
# Elements and names that are no part of an article.
DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe button input select textarea svg head title dialog menu "
    "object canvas video audio map link meta option fieldset".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
NAMES = frozenset(
    "ad ads adv adbox adsense adslot alert banner consent dialog gdpr login menu modal nav notice notices overlay pager "
    "pagination reply replies respond search share sharing signup skip social teaser teasers toolbar widget".split()
)
# Beginnings of such names; "commentary" is none.
NAME_STARTS = re.compile(
    r"(?:advert|breadcrumb|comment(?!ar)|cookie|disqus|footer|masthead|navbar|navigation|newsletter|popup|promo|recommend|"
    r"related|sidebar|sponsor|subscri)"
)
# Of these names, those that mean one thing only.
SURE = frozenset("ad ads adv adbox adsense adslot consent gdpr login nav pager pagination signup".split())
SURE_STARTS = re.compile(r"(?:advert|breadcrumb|cookie|footer|masthead|navbar|navigation|newsletter|promo|sidebar|sponsor|subscri)")
# Names of discussions, which may be longer than the article.
TALK = re.compile(r"comment(?!ar)|disqus|repl(?:y|ies)$|respond$")
# After these a class tells what the page has.
STATES = frozenset("has have no not with without".split())
SECTION_CLASS = re.compile(r"(?:section|level[1-6])")
CONTROLS = frozenset("form button input select textarea iframe".split())
# Running prose of an article has at most this share of its letters in links.
MOST_LINKED = 0.3
# An element with a name of no article stays, if it holds more than this share of the page's prose.
MOST_PROSE, MOST_PROSE_TALK = 0.5, 0.9
CONTENT_NAMES = frozenset("article content post entry story main body".split())
# A start of these ends an open paragraph, and those of one family end each other.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
          "option": {"select"}}
MARKUP = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)"
    r"|(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z)))",
    re.DOTALL,
)
# One attribute of a tag: its whole name, and its value with quotes or up to the next blank.
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?|"[^"]*"|'[^']*'|=""")
READ = frozenset("class id role hidden aria-hidden style".split())
LIKELY = re.compile(r"class|id|role|hidden|style", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """The elements of one page in order, its texts, and the hash of every subtree."""

    def __init__(self, source: str):
        self.tags: list[str] = ["#page"]
        self.parents: list[int] = [-1]
        self.marks: list[str] = [""]  # "", "drop", "header", "content"
        # Elements named as no article: whether a discussion, an anchor, a name that leaves no doubt.
        self.names: dict[int, tuple[bool, bool, bool]] = {}
        self.hashes: list[int] = [0]
        self.events: list[tuple[int, str | None]] = []  # a text, or None where a block begins or ends
        self._gone: set[int] = set()
        self._found: tuple[list[bool], list[int]] | None = None
        self._parts: list[list[str]] = [[]]
        self._open = [0]
        self._parse(source)
        while self._open:
            self._close()

    def _parse(self, source: str) -> None:
        at = 0
        while (m := MARKUP.search(source, at)) is not None:
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if m["tag"] is None:
                continue
            tag, rest = m["tag"].lower(), m["rest"]
            if not rest.endswith(">"):
                break  # a tag cut off by the end of the page
            if m["end"]:
                self._end(tag)
                continue
            self._start(tag, rest)
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = stop.start() if stop else len(source)
        else:
            if at < len(source):
                self._text(source[at:])

    def _text(self, raw: str) -> None:
        text = html.unescape(raw)
        self.events.append((self._open[-1], text))
        if not text.isspace():
            self._parts[-1].append(" ".join(text.split()))

    def _start(self, tag: str, rest: str) -> None:
        if tag in BLOCKS:
            self._leave({"p"}, BLOCKS - {"p"})
        if tag in SIBLINGS:
            self._leave(SIBLINGS[tag], FENCES[tag])
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self._open[-1])
        self.marks.append(self._mark(node, tag, rest))
        self.hashes.append(0)
        if tag in BLOCKS:
            self.events.append((node, None))
        elif tag == "br" or tag in ("td", "th"):
            self.events.append((self._open[-1], " "))
        if tag in VOID:
            return
        self._open.append(node)
        self._parts.append([tag])
        if rest.endswith("/>") and tag in ("svg", "path", "use", "math"):
            self._close()

    def _leave(self, tags: set[str] | frozenset[str], fences: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of ``tags`` unless a fence stands before it."""
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag in tags:
                while len(self._open) > depth:
                    self._close()
                return
            if tag in fences:
                return

    def _end(self, tag: str) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            opened = self.tags[self._open[depth]]
            if opened == tag:
                while len(self._open) > depth:
                    self._close()
                return
            if opened in BLOCKS and tag not in BLOCKS:
                return  # an inline end doesn't close a block

    def _close(self) -> None:
        node, parts = self._open.pop(), self._parts.pop()
        self.hashes[node] = xxhash.xxh64_intdigest("\x1f".join(parts)) >> 1 if len(parts) > 1 else 0
        if self._parts:
            self._parts[-1].append(f"<{self.hashes[node]}>" if len(parts) > 1 else f"<{self.tags[node]}>")
        if self.tags[node] in BLOCKS:
            self.events.append((node, None))

    def _mark(self, node: int, tag: str, rest: str) -> str:
        if tag in DROPPED:
            return "drop"
        if len(rest) < 4:
            return ""
        if not LIKELY.search(rest):
            return ""
        mark, named, by_id, section, talk, sure = "", False, False, tag == "section", False, False
        read = set()
        for found in ATTRIBUTE.finditer(rest):
            name = (found[1] or "").lower()
            if name not in READ or name in read:
                continue  # the first of two equal names counts
            read.add(name)
            value = found[2] or ""
            value = html.unescape(value[1:-1] if value[:1] in ("'", '"') else value).strip().lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and HIDDEN.search(value)):
                return "drop"
            if name == "role":
                if value in ROLES:
                    return "drop"
                mark = "content" if value == "main" else mark
            elif name in ("class", "id"):
                words, tokens = set(), value.split()
                for token in tokens:
                    parts = re.split(r"[^a-z0-9]+", token)
                    section |= name == "class" and SECTION_CLASS.fullmatch(token) is not None
                    words.update(parts[: next((i for i, w in enumerate(parts) if w in STATES), len(parts))])
                if tag in ("html", "body", "article", "main"):
                    if "comment" in words:
                        return "drop"
                elif not (name == "id" and tag in HEADINGS):
                    found = [w for w in words if w in NAMES or NAME_STARTS.match(w)]
                    if found:
                        talk |= any(map(TALK.match, found))
                        sure |= any(w in SURE or SURE_STARTS.match(w) or (w in tokens and tag not in PROSE) for w in found)
                        named, by_id = named or name == "class", by_id or name == "id"
                if words & CONTENT_NAMES:
                    mark = "content"
                elif "header" in words and mark != "content":
                    mark = "header"
        if named or by_id:
            self.names[node] = (talk, not named and section, sure)
        return mark

    def _below(self, roots: set[int]) -> list[bool]:
        """Whether each element is one of the roots or lies in one; parents come first."""
        out = [False] * len(self.tags)
        for i, parent in enumerate(self.parents):
            out[i] = i in roots or (parent >= 0 and out[parent])
        return out

    def _named(self) -> set[int]:
        """Elements whose names make them no part of the article; wrappers of the article are none.

        Outer elements are decided first: what is found in those that stay counts for those in them.
        """
        if not self.names:
            return set()
        hard = self._below({i for i, m in enumerate(self.marks) if m == "drop"})
        strong = {i for i, t in enumerate(self.tags) if t in ARTICLES}
        weak = {i for i, m in enumerate(self.marks) if m == "content" and self.tags[i] not in ("html", "body")}
        plain_weak = {i for i in weak if i not in self.names}
        in_strong, in_any, in_link = self._below(strong), self._below(strong | weak), self._below(
            {i for i, t in enumerate(self.tags) if t == "a"})
        in_plain = self._below(strong | plain_weak)
        names, marked = {}, bool(strong | plain_weak)
        for i, (talk, section, _) in self.names.items():
            # A section's id is an anchor in an article, or where the page marks none.
            if not hard[i] and not (section and (in_plain[i] or not marked)):
                names[i] = talk
        region, depth = [0] * len(self.tags), [0] * len(self.tags)
        for i, parent in enumerate(self.parents):
            if i:
                region[i] = i if i in names else region[parent]
                depth[i] = depth[parent] + (i in names)
        prose, visible = [0] * len(self.tags), [False] * len(self.tags)
        linked, latest, ending = [0] * len(self.tags), [-1] * len(self.tags), -1
        shows = {0: [False, False]}  # text of a region's own in article or main, in any marked element
        for at, (node, text) in enumerate(self.events):
            if text is None or hard[node] or not (size := len(text.strip())):
                continue
            visible[node], latest[node] = True, at
            prose[node] += 0 if in_link[node] else size
            linked[node] += size if in_link[node] else 0
            if in_any[node] and not region[node] and not in_link[node]:
                ending = at  # where the article's own prose ends
            own = shows.setdefault(region[node], [False, False])
            own[0] |= in_strong[node]
            own[1] |= in_any[node]
        controls = [t in CONTROLS for t in self.tags]
        holds = [0] * len(self.tags)  # 1 a marked element, 2 an article or main, with text
        for i in range(len(self.tags) - 1, 0, -1):
            if visible[i]:
                holds[i] = max(holds[i], 2 if i in strong else 1 if i in weak else 0)
                visible[self.parents[i]] = True
            up = self.parents[i]
            prose[up] += prose[i]
            linked[up] += linked[i]
            latest[up] = max(latest[up], latest[i])
            controls[up] |= controls[i]
            holds[self.parents[i]] = max(holds[self.parents[i]], holds[i])
        gone, left = set(), list(shows[0])
        layers: dict[int, list[int]] = {}
        for i in names:
            layers.setdefault(depth[i], []).append(i)
        stays = {0}
        for _, layer in sorted(layers.items()):
            kept = []
            for i in layer:
                if region[self.parents[i]] not in stays:
                    continue
                talk = names[i]
                most = prose[i] > prose[0] * (MOST_PROSE_TALK if talk else MOST_PROSE)
                if not left[1]:
                    spared = most or (holds[i] > 0 and not talk)
                else:
                    spared = most and (in_any[self.parents[i]] or (holds[i] == 2 and not left[0]))
                    if in_any[self.parents[i]] and not talk and not self.names[i][2]:
                        # Prose in the midst of the article: a name alone doesn't remove it.
                        few = linked[i] <= MOST_LINKED * (prose[i] + linked[i])
                        spared |= prose[i] > 0 and few and not controls[i] and latest[i] < ending
                if spared:
                    kept.append(i)
                else:
                    gone.add(i)
            for i in kept:
                stays.add(i)
                left = [x or y for x, y in zip(left, shows.get(i, (False, False)))]
        return gone

    def _kept(self, recurring: frozenset[int] | set[int]) -> list[bool]:
        """Elements of the article that are not dropped."""
        _, codes = self._candidates()
        gone = self._gone | {i for i, code in enumerate(codes) if code and code in recurring}
        hidden = self._below(gone)
        root = self._root(hidden)
        if root is None:
            return [not h for h in hidden]
        within = self._below({root} | self._titles(root, hidden))
        # The head of a page is no part of an article; the head of an article gives its headings.
        heads = self._below({i for i, t in enumerate(self.tags) if t == "header" or self.marks[i] == "header"})
        heading = self._below({i for i, t in enumerate(self.tags) if t in HEADINGS})
        return [w and not h and (not head or (title and self.tags[root] in ARTICLES))
                for w, h, head, title in zip(within, hidden, heads, heading)]

    def _titles(self, root: int, hidden: list[bool]) -> set[int]:
        """First-level headings of the main element around an article without one, ahead of it."""
        up = self.parents[root]
        while up > 0 and self.tags[up] != "main":
            up = self.parents[up]
        if self.tags[root] != "article" or up <= 0:
            return set()
        own, around = self._below({root}), self._below({up})
        articles = self._below({i for i, t in enumerate(self.tags) if t == "article"})
        first = [i for i, t in enumerate(self.tags) if t == "h1" and around[i] and not hidden[i]]
        return set() if any(own[i] for i in first) else {i for i in first if i < root and not articles[i]}

    def _candidates(self) -> tuple[list[bool], list[int]]:
        """What is hidden without templates, and each element's hash if it may be template, or else 0.

        A div of plain text in an article, or an inline element in a div, has the complement of its
        hash, counted by itself.
        """
        if self._found is None:
            self._gone = {i for i, m in enumerate(self.marks) if m == "drop"} | self._named()
            hidden = self._below(self._gone)
            root = self._root(hidden)
            articles = {i for i, t in enumerate(self.tags) if t in ARTICLES}
            fixed = set(articles)
            if root is not None and self.tags[root] != "body":
                articles.add(root)
                while root >= 0:
                    fixed.add(root)
                    root = self.parents[root]
            inside = self._below(articles)
            holds = {self.parents[i] for i, t in enumerate(self.tags) if t in BLOCKS}
            texts = {node for node, text in self.events if text is not None and not text.isspace()}
            prose = [False] * len(self.tags)  # is prose of an article, or stands in it
            running = [False] * len(self.tags)  # an inline element of a paragraph or beside text
            codes = [0] * len(self.tags)
            for i, tag in enumerate(self.tags):
                if not i or not inside[i]:
                    prose[i] = False
                elif i not in articles:
                    prose[i] = tag in PROSE or prose[self.parents[i]]
                up = self.parents[i]
                inline = i > 0 and tag not in LINES
                if inline:
                    loose = "-" in tag and (up == 0 or self.tags[up] in ("html", "body") or up in articles)
                    running[i] = running[up] or self.tags[up] in PROSE or self.tags[up] in ITEMS or (up in texts and not loose)
                if not self.hashes[i] or hidden[i] or running[i] or i in fixed or tag in ("html", "head", "body"):
                    continue
                if not inside[i]:
                    codes[i] = self.hashes[i]
                elif not prose[i] and tag not in ITEMS:
                    line = (tag == "div" and i not in holds) or (inline and "-" not in tag and self.tags[up] == "div" and up not in articles)
                    codes[i] = ~self.hashes[i] if line else self.hashes[i]
            self._found = hidden, codes
        return self._found

    def _root(self, hidden: list[bool]) -> int | None:
        """The marked element with the most visible text, the strongest kind of mark first."""
        sizes = [0] * len(self.tags)
        for node, text in self.events:
            if text is not None and not hidden[node]:
                sizes[node] += len(text.strip())
        for i in range(len(self.tags) - 1, 0, -1):
            sizes[self.parents[i]] += sizes[i]
        kinds = (
            [i for i, t in enumerate(self.tags) if t == "article" and not hidden[i]],
            [i for i, t in enumerate(self.tags) if t == "main" and not hidden[i]],
            [i for i, m in enumerate(self.marks) if m == "content" and not hidden[i] and self.tags[i] not in ("html", "body")],
            [i for i, t in enumerate(self.tags) if t == "body" and not hidden[i]],
        )
        for nodes in kinds:
            if nodes and (best := max(nodes, key=lambda i: (sizes[i], -i))) and sizes[best]:
                return best
        return None

    def subtrees(self) -> set[int]:
        """Hashes of the elements that may be template."""
        return {code for code in self._candidates()[1] if code}

    def text(self, recurring: frozenset[int] | set[int] = frozenset()) -> str:
        """The article's blocks, white space made single spaces, one line each."""
        kept = self._kept(recurring)
        blocks, current = [], []
        for node, text in [*self.events, (0, None)]:
            if text is not None:
                if kept[node]:
                    current.append(text)
            elif current:
                blocks.append(" ".join("".join(current).split()))
                current = []
        return "\n".join(b for b in blocks if b)


def host(url: Column) -> Column:
    """The lower-cased host of a url, without user and port; '' where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(found)


def recurring_subtrees(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, many_pages: int = MANY_PAGES) -> DataFrame:
    """(host, hash) of subtrees that occur on many pages of a host, from (host, html) rows.

    Pages of one host with the same text, templates included, count once. A task sends each of its
    (host, hash, text) once, and then one count for each host and hash it has met, so neither
    copies nor a host with a third of all pages are a hot spot.
    """

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hosts, found, texts = [], [], []
            for name, source in zip(batch["host"], batch["html"]):
                page = Page(source)
                own = [0, *page.subtrees()]  # 0 counts the pages
                found.extend(own)
                hosts.extend([name] * len(own))
                texts.extend([xxhash.xxh64_intdigest(page.text()) >> 1] * len(own))
            yield pd.DataFrame(
                {"host": pd.Series(hosts, dtype=object), "hash": np.array(found, dtype=np.int64), "page": np.array(texts, dtype=np.int64)}
            )

    met = pages.mapInPandas(hashes, "host string, hash long, page long").distinct()
    counts = met.groupBy("host", "hash").agg(F.count("*").alias("n"))
    counts = write_table(counts.where((F.col("n") >= least_pages) | (F.col("hash") == 0)), "counts")
    per_host = counts.where("hash = 0").select("host", F.col("n").alias("pages"))
    many = counts.where((F.col("hash") != 0) & (F.col("n") >= least_pages)).join(per_host, "host")
    least = F.when(F.col("hash") < 0, F.col("pages") * MOST_PAGES).otherwise(F.least(F.col("pages") * least_share, F.lit(many_pages)))
    return many.where(F.col("n") >= least).select("host", "hash")


def main_text(pages: DataFrame, id_col: str = "page_id", most_rows: int = 200_000) -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    rows = pages.select(
        F.col(id_col).alias("id"), "url", host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")
    )
    recurring = write_table(recurring_subtrees(rows.select("host", "html")), "recurring")
    kind = rows.schema["id"].dataType.simpleString()
    out = f"id {kind}, url string, text string"

    if is_small(recurring, max_rows=most_rows):
        template: dict[str, set[int]] = {}
        for r in recurring.collect():
            template.setdefault(r["host"], set()).add(r["hash"])

        def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                texts = [Page(s).text(template.get(h, frozenset())) for h, s in zip(batch["host"], batch["html"])]
                yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts})

        done = rows.mapInPandas(extract, out)
    else:

        def own_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for mark, name, source in zip(batch["mark"], batch["host"], batch["html"]):
                    own = np.array(sorted(Page(source).subtrees()), dtype=np.int64)
                    yield pd.DataFrame({"mark": mark, "host": name, "hash": own})

        def extract_joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                texts = [Page(s).text(frozenset() if t is None else set(t)) for t, s in zip(batch["template"], batch["html"])]
                yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts})

        # Pages alike in host and source have the same hashes, so they may share a mark.
        marked = rows.withColumn("mark", F.sha2(F.concat_ws("\n", "host", "html"), 256))
        pairs = marked.select("mark", "host", "html").mapInPandas(own_hashes, "mark string, host string, hash long")
        own = pairs.distinct().join(recurring, ["host", "hash"]).groupBy("mark").agg(F.collect_list("hash").alias("template"))
        done = marked.join(own, "mark", "left").select("id", "url", "html", "template").mapInPandas(extract_joined, out)
    return done.select(F.col("id").alias(id_col), "url", "text", F.length("text").cast("long").alias("n_chars"))
