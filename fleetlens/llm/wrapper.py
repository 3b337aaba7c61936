"""Main text of web pages by wrapper induction.

The pages of a host that have one layout are aligned with a reference page of it by simple
tree matching.  A text that nearly all pages have at a node is template; all other text,
at nodes that the reference lacks too, is in slots for content, in an article too.  Elements that say what they are (article, main, navigation,
advert and so on) are evidence beside it: articles that hold most of what template leaves
are the text, and boilerplate elements are never content.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import chunks, staged, utf8

#: A reference node is template from this share of equal texts on, over at least this many other pages.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.9, 3
#: Child lists whose product of lengths is larger are matched by halves, in memory of a few rows, with the same result.
MATCH_CELLS = 40_000
#: A weak mark inside an article counts for an element with a larger share of link text.
LINK_SHARE = 0.5

# Kinds of elements, and whole names in class, id or role that mark boilerplate.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe xmp noembed noframes svg math object".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
            "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary "
            "table tbody td tfoot th thead tr ul".split())
DROPPED = set("nav aside footer head menu dialog select button datalist label".split()) | RAW
MARKS = set("nav navbar navigation menu sidebar side ad ads advert advertisement adbox banner promo sponsor sponsored cookie "
            "cookies consent gdpr notice alert popup modal overlay comment comments reply replies disqus footer masthead "
            "breadcrumb breadcrumbs share sharing social related recommended subscribe newsletter signup login search "
            "widget pagination pager toolbar contentinfo complementary "
            "nav-bar nav-menu main-nav main-menu main-navigation site-nav site-navigation top-nav top-menu side-nav side-bar "
            "left-sidebar right-sidebar sidebar-left sidebar-right site-sidebar site-footer page-footer main-footer footer-nav "
            "footer-menu footer-links ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper banner-ad google-ad adsbygoogle "
            "cookie-notice cookie-banner cookie-bar cookie-consent cookie-popup gdpr-banner gdpr-notice comment-list "
            "comments-area comments-section comment-form disqus_thread disqus-thread share-bar share-buttons share-links "
            "social-share social-links social-icons social-media related-posts related-articles related-links recommended-posts "
            "newsletter-signup newsletter-form sign-up login-form search-form search-box searchform skip-link".split())
#: Of these, the ones that count inside an article by themselves; others need a larger share of link text there.
STRONG = set("ad ads advert advertisement adbox sponsored ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper banner-ad "
             "google-ad adsbygoogle comments disqus comment-list comments-area comments-section comment-form disqus_thread "
             "disqus-thread cookie-notice cookie-banner cookie-bar cookie-consent share-buttons social-share newsletter-signup".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Elements of running text: without a class they say nothing of a page's layout.
FLOW = set("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table blockquote pre figure details hr head".split())
CLOSED_BY = {"p": BLOCK - {"body", "html", "head"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
             "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"},
             "head": {"body"}}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(?:>|\Z)""", re.S)
WORD = re.compile(r"\w")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


def _key(value: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(value.encode()) - (1 << 63)


#: The path of a page's root.
ROOT = -1


def _marks(attributes: str, tag: str = "") -> tuple[set[str], bool, bool, bool]:
    """(words of class, id and role, whether the element is hidden, whether it is marked, whether the mark is strong).

    Words make an element's signature.  Marks are whole names: a part of a longer name says
    nothing, and the id of a heading is an anchor.
    """
    words: set[str] = set()
    names: set[str] = set()
    hidden = strong = False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id", "role"):
            words.update(re.findall(r"[a-z]+", value))
            if name != "id" or tag not in HEADINGS:
                found = MARKS.intersection(value.split())
                names |= found
                strong |= bool(found) and (name == "role" or bool(found & STRONG))
        hidden |= name == "hidden" or (name == "aria-hidden" and value == "true") or (
            name == "style" and re.search(r"display\s*:\s*none", value) is not None)
    return words, hidden, bool(names), strong


class Mark:
    """A marked element: whether it counts without more evidence, and what it holds so far."""

    __slots__ = ("outer", "certain", "form", "articles", "chars", "linked", "prose", "out", "beside")

    def __init__(self, outer: Mark | None, certain: bool, articles: bool, form: bool = False):
        self.outer, self.certain, self.articles, self.form = outer, certain, articles, form
        self.chars = self.linked = self.prose = 0
        self.out = self.beside = False


class Links:
    """What a list, or a block outside lists, holds: anchors, and whether any word is in none of them."""

    __slots__ = ("anchors", "words", "text")

    def __init__(self, text: bool = False):
        self.anchors, self.words, self.text = 0, False, text

    def menu(self) -> bool:
        return not self.text and self.anchors > 1 and not self.words


class Page:
    """Text blocks of a page, and its tree of block elements."""

    def __init__(self, source: str):
        #: (path, text, dropped, level: 2 in an article, 1 in main, 0 else; 1 if it is nothing but a link, 2 if it is of a menu)
        self.blocks: list[tuple[int, str, bool, int, int]] = []
        self.root: list = ["", [], []]  # signature, texts, children
        #: tag, dropped, level, node, path, innermost mark, innermost list
        self.stack = [("", False, 0, self.root, ROOT, None, None)]
        self.open: Counter[str] = Counter()
        self.marks: list[Mark] = []
        self.of_block: list[tuple[Mark | None, Links]] = []
        self.buffer: list[str] = []
        self.linked = self.links = self.anchors = 0
        self.words = self.has_main = False
        self._read(source)
        self._judge()

    def _flush(self):
        text = " ".join("".join(self.buffer).split())
        if text:
            tag, dropped, level, node, path, mark, links = next(s for s in reversed(self.stack) if s[0] in BLOCK or not s[0])
            node[1].append(text)
            size = sum(map(len, self.buffer))
            prose = level == 2 or tag == "p" or tag in HEADINGS
            links = links or Links(prose)
            links.anchors, links.words = links.anchors + self.anchors, links.words or self.words
            self.blocks.append((path, text, dropped, level, int(self.anchors > 0 and not self.words)))
            self.of_block.append((mark, links))
            if mark:
                mark.chars, mark.linked, mark.prose = mark.chars + size, mark.linked + self.linked, mark.prose + prose * (not dropped) * len(text)
        self.buffer, self.linked, self.anchors, self.words = [], 0, 0, False

    def _judge(self):
        """Drops the blocks of marked elements, and says which blocks are of a menu.

        An article or main and what holds one go by a mark only if other articles, not
        marked, have more text.  Else a mark counts, in an article a weak one if the element is mostly links.
        A form goes, unless it wraps the page: it holds an article, or half of the headings and paragraphs.
        """
        for m in reversed(self.marks):  # an inner mark comes after its outer one
            if m.outer:
                m.outer.chars, m.outer.linked, m.outer.prose = m.outer.chars + m.chars, m.outer.linked + m.linked, m.outer.prose + m.prose
                m.outer.articles |= m.articles
        for m in self.marks:
            m.beside = m.articles or bool(m.outer and m.outer.beside)
        plain = sum(len(b[1]) for b, (m, _) in zip(self.blocks, self.of_block) if b[3] == 2 and not b[2] and not (m and m.beside))
        prose = sum(len(b[1]) for b, (_, links) in zip(self.blocks, self.of_block) if links.text and not b[2])
        for m in self.marks:
            if m.form:
                m.out = not m.articles and (not m.prose or 2 * m.prose < prose)
            else:
                m.out = plain > m.chars if m.articles else m.certain or m.linked > LINK_SHARE * m.chars
            m.out |= bool(m.outer and m.outer.out)
        self.blocks = [(*b[:2], b[2] or bool(m and m.out), b[3], 2 if links.menu() else b[4]) for b, (m, links) in zip(self.blocks, self.of_block)]

    def _close(self, depth: int):
        while len(self.stack) > depth:
            if self.stack[-1][0] in BLOCK:
                self._flush()
            elif self.stack[-1][0] == "a":
                self.links -= 1
            self.open[self.stack.pop()[0]] -= 1

    def _open(self, tag: str, attributes: str):
        if tag in BLOCK:
            for depth in range(len(self.stack) - 1, 0, -1):
                name = self.stack[depth][0]
                if tag in CLOSED_BY.get(name, ()):
                    self._close(depth)
                    break
                if name in BLOCK and name != "p":
                    break
            self._flush()
        _, dropped, level, node, path, mark, links = self.stack[-1]
        words, hidden, marked, strong = _marks(attributes, tag) if attributes.strip() else (set(), False, False, False)
        self.has_main |= tag == "main"
        self.open[tag] += 1
        if tag in ("article", "main") and mark:
            mark.articles = True
        form = tag == "form"
        if form or marked and tag not in ("html", "body", "main"):
            mark = Mark(mark, strong or level < 2, tag == "article", form)
            self.marks.append(mark)
        level = max(level, 2 if tag == "article" else 1 if tag == "main" or "main" in words and tag == "div" else 0)
        dropped = dropped or hidden or tag in DROPPED or (tag == "header" and level < 2)
        if tag in BLOCK:
            signature = ".".join([tag, *sorted(words)])
            child = [signature, [], []]
            node[2].append(child)
            self.stack.append((tag, dropped, level, child, step(path, signature), mark, Links() if tag in ("ul", "ol") else links))
        else:
            self.links += tag == "a"
            self.anchors += tag == "a"
            self.stack.append((tag, dropped, level, node, path, mark, links))

    def _text(self, text: str):
        if not text:
            return
        tag, dropped, *_, mark, _ = self.stack[-1]
        if tag not in BLOCK and tag:
            block = next(s for s in reversed(self.stack) if s[0] in BLOCK or not s[0])
            while mark is not block[5]:  # an inline element that is boilerplate inside a block that is not
                if not block[1] and (mark.certain or self.links):
                    return
                mark = mark.outer
            if dropped and not block[1]:
                return
        text = html.unescape(text)
        self.buffer.append(text)
        if self.links > 0:
            self.linked += len(text)
        else:
            self.words |= WORD.search(text) is not None

    def _read(self, source: str):
        at, end = 0, len(source)
        while at < end:
            found = TAG.search(source, at)
            if found is None:
                rest = source[at:]
                cut = re.search(r"</?[a-zA-Z][^>]*\Z", rest)
                self._text(rest[:cut.start()] if cut else rest)
                break
            self._text(source[at:found.start()])
            at = found.end()
            closing, tag, attributes = found.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                for depth in range(0) if not self.open[tag] else range(len(self.stack) - 1, 0, -1):
                    if self.stack[depth][0] == tag:
                        self._close(depth)
                        break
                    if self.stack[depth][0] in ("article", "main", "body") and tag not in BLOCK:
                        break
            elif tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                at = stop.end() if stop else end
            elif tag in VOID:
                if tag == "hr":
                    self._flush()
                elif tag == "br":
                    self.buffer.append(" ")
            elif not attributes.rstrip().endswith("/") or tag in BLOCK or tag == "a":
                self._open(tag, attributes)
        self._close(1)
        self._flush()


def step(path: int, signature: str) -> int:
    """The hash of a path, from that of the path above it."""
    return _key(f"{path}/{signature}")


def skeleton(node: list) -> list:
    """[signature, path hash, text hashes, children] with runs of equal siblings as one node, which has the texts and children of all.

    The children of a run's elements are laid over each other in page order; one that the
    elements before it lack is put in where it stands.
    """
    root = [node[0], ROOT, [_key(t) for t in node[1]], []]
    todo = [([node], root)]
    while todo:
        sources, made = todo.pop()
        names: list[str] = []
        known: set[str] = set()
        runs: list[list] = []
        for source in sources:
            at = -1
            for child in source[2]:
                name = child[0]
                try:
                    found = names.index(name, max(at, 0)) if name in known else -1
                except ValueError:
                    found = -1
                if found < 0:
                    at += 1
                    names.insert(at, name)
                    runs.insert(at, [child])
                    known.add(name)
                else:
                    at = found
                    runs[at].append(child)
        for name, run in zip(names, runs):
            made[3].append([name, step(made[1], name), [_key(t) for child in run for t in child[1]], []])
            todo.append((run, made[3][-1]))
    return root


def written(node: list) -> tuple[str, int]:
    """A skeleton as text, node after node with the number of its children, and how many nodes it has."""
    out, todo = [], [node]
    while todo:
        at = todo.pop()
        out.append([*at[:3], len(at[3])])
        todo += reversed(at[3])
    return json.dumps(out, separators=(",", ":"), ensure_ascii=False), len(out)


def read_back(text: str) -> list:
    """The skeleton that ``written`` wrote."""
    rows = json.loads(text)
    made = [[*r[:3], []] for r in rows]
    waiting: list[list] = []  # [node, children to come]
    for row, node in zip(rows, made):
        while waiting and not waiting[-1][1]:
            waiting.pop()
        if waiting:
            waiting[-1][0][3].append(node)
            waiting[-1][1] -= 1
        waiting.append([node, row[3]])
    return made[0]


def layout(node: list) -> int:
    """Hash of the kinds of sections that the page's outermost node with several sections has."""
    while True:
        sections = [c for c in node[2] if c[0].split(".")[0] not in FLOW or "." in c[0]]
        if len(sections) != 1 or not sections[0][2]:
            return _key("\n".join(sorted({c[0] for c in sections})))
        node = sections[0]


def _shape(node: list, shapes: dict) -> int:
    """A number for the signatures of a tree, the same for equal trees; texts don't count."""
    nodes = [node]
    for x in nodes:
        nodes += x[3]
    codes: dict[int, int] = {}
    for x in reversed(nodes):
        codes[id(x)] = shapes.setdefault((x[0], *(codes[id(c)] for c in x[3])), len(shapes))
    return codes[id(node)]


def _long_match(first: list[list], second: list[list]):
    """The children paired by a best match of two long lists: equal ends, then halves (Hirschberg).

    Like ``_match`` it yields the pairs of trees it needs matched.
    """
    import numpy as np

    shapes: dict[tuple, int] = {}
    x, y = (np.array([_shape(c, shapes) for c in part]) for part in (first, second))
    of_x, of_y = ({k: part[i] for i, k in enumerate(codes.tolist())} for part, codes in ((first, x), (second, y)))
    kinds, y_at = np.unique(y, return_inverse=True)
    weights = {}
    for k, node in of_x.items():
        row = []
        for j in kinds.tolist():
            row.append((yield node, of_y[j])[0])
        weights[k] = np.array(row, np.int64)

    def last_row(xs, ys):
        row = np.zeros(len(ys) + 1, np.int64)
        for k in xs.tolist():
            row[1:] = np.maximum(row[1:], row[:-1] + weights[k][ys])
            np.maximum.accumulate(row, out=row)
        return row

    out: list[tuple[list, list]] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and x[a0] == y[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and x[a1 - 1] == y[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            gain = weights[int(x[a0])][y_at[b0:b1]]
            if gain.max() > 0:
                out.append((a0, b0 + int(gain.argmax())))
            continue
        middle = (a0 + a1) // 2
        ahead = last_row(x[a0:middle], y_at[b0:b1])
        behind = last_row(x[middle:a1][::-1], y_at[b0:b1][::-1])[::-1]
        cut = b0 + int((ahead + behind).argmax())
        todo += [(a0, middle, b0, cut), (middle, a1, cut, b1)]
    return [(first[i], second[j]) for i, j in sorted(out)]


def _match(a: list, b: list):
    """Most nodes matched and the pairs, [(a, b), pairs of children, ...]; yields the pairs of trees it needs matched."""
    first, second = a[3], b[3]
    if len(first) * len(second) > MATCH_CELLS:
        total, pairs = 1, [(a, b)]
        for x, y in (yield from _long_match(first, second)):
            n, inner = yield x, y
            total += n
            if n:
                pairs.append(inner)
        return total, pairs
    found = []
    for x in first:
        row = []
        for y in second:
            row.append((yield x, y))
        found.append(row)
    best = [[0] * (len(second) + 1) for _ in range(len(first) + 1)]
    for i, row in enumerate(found, 1):
        for j, (n, _) in enumerate(row, 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + n)
    pairs, i, j = [(a, b)], len(first), len(second)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append(found[i][j][1])
    return best[-1][-1] + 1, pairs


def tree_match(a: list, b: list) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching: most nodes matched with order and ancestry kept, and their pairs.

    The matches of children wait on a list of their own, so no depth of nesting is too much.
    """
    if a[0] != b[0]:
        return 0, []
    stack, result = [_match(a, b)], None
    while stack:
        try:
            x, y = stack[-1].send(result)
        except StopIteration as done:
            stack.pop()
            result = done.value
            continue
        result = None
        if x[0] != y[0]:
            result = 0, []
        elif not x[3] or not y[3]:
            result = 1, [(x, y)]
        else:
            stack.append(_match(x, y))
    n, nested = result
    pairs, todo = [], [nested]
    while todo:
        own = todo.pop()
        pairs.append(own[0])
        todo += reversed(own[1:])
    return n, pairs


def main_text(page: Page, template: set[int] = frozenset()) -> str:
    """Content blocks joined by line feeds: what the host's template leaves, where article and main are further evidence.

    ``template`` has keys of path and text of constant nodes.  An article that template would
    take the greater part of is a near copy of others, and stays whole.  Articles are the
    text if they hold at least half of what is left in them and in main (in the page, if there
    is no main); else they are cards beside a text, and main, or the page, is read as a whole.
    """
    size = lambda blocks: sum(len(b[1]) for b in blocks)
    kept = [b for b in page.blocks if not b[2]]
    left = [b for b in kept if _key(f"{b[0]}\n{b[1]}") not in template] if template else kept
    if 2 * size(b for b in left if b[3] == 2) < size(b for b in kept if b[3] == 2):
        left = [b for b in kept if b[3] == 2 or _key(f"{b[0]}\n{b[1]}") not in template]
    articles, inside = [b for b in left if b[3] == 2], [b for b in left if b[3]]
    prose = [b for b in left if b[4] < (1 if b[3] == 2 else 2)]  # a card's linked heading is no text
    around = [b for b in prose if b[3]] if page.has_main else prose
    if articles and 2 * size(articles) >= size(articles) + size(b for b in around if b[3] < 2):
        return "\n".join(b[1] for b in articles)
    if page.has_main and inside:
        return "\n".join(b[1] for b in inside if b[3] < 2 or not b[4])
    if inside and not articles and 2 * size(inside) >= size(prose):
        return "\n".join(b[1] for b in inside)  # a div that is called main
    return "\n".join(b[1] for b in prose)


def _skeletons(batches):
    import pyarrow as pa

    for batch in chunks(batches, "html"):
        roots = [Page(h).root for h in batch.column("html").to_pylist()]
        texts = [written(skeleton(r)) for r in roots]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array([layout(r) for r in roots], pa.int64()),
             pa.array([t for t, _ in texts], pa.string()), pa.array([n for _, n in texts], pa.int64())], names=["host", "layout", "tree", "nodes"])


def _compare(batches):
    """Per pair of a page and its reference: texts of reference nodes, and whether the page's node has them too."""
    import pyarrow as pa

    names = ["host", "group", "path", "text", "pages", "equal"]
    for batch in batches:
        seen: dict[tuple[str, int, int, int], list[int]] = {}
        for host, group, tree, reference in zip(*(batch.column(c).to_pylist() for c in ("host", "group", "tree", "reference"))):
            if tree == reference:
                continue  # the reference or a copy of it says nothing about what varies
            met: dict[tuple[int, int], bool] = {}
            for x, y in tree_match(read_back(tree), read_back(reference))[1]:
                own = set(x[2]) if y[2] else ()
                for text in y[2]:
                    met[y[1], text] = met.get((y[1], text), False) or text in own
            for (path, text), equal in met.items():
                count = seen.setdefault((host, group, path, text), [0, 0])
                count[0] += 1
                count[1] += equal
        if seen:
            columns = [*zip(*seen), *zip(*seen.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "host" else pa.int64()) for n, c in zip(names, columns)], names=names)


def _extract(batches):
    import pyarrow as pa

    for batch in chunks(batches, "html"):
        texts = []
        for source, template in zip(*(batch.column(c).to_pylist() for c in ("html", "template"))):
            known = {(p, t) for p, t in zip(template[::2], template[1::2])} if template else set()
            page = Page(source)
            constant = {_key(f"{b[0]}\n{b[1]}") for b in page.blocks if (b[0], _key(b[1])) in known} if known else set()
            texts.append(main_text(page, constant))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def host_of(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


#: A host with more than this share of all pages is hot (so at most HOT_SHARE hosts are); its pages are dealt to SALTS groups.
HOT_SHARE, SALTS = 200, 64


def _dealt(rows: DataFrame, hot: list[str]) -> DataFrame:
    """``rows`` with a group number: the pages of a hot host go to groups in turn, others to group 0."""
    return rows.withColumn("salt", F.when(F.col("host").isin(hot), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0).cast("int"))


def _for_all(rows: DataFrame, hot: list[str]) -> DataFrame:
    """``rows`` for each group number that their host has."""
    last = F.when(F.col("host").isin(hot), SALTS - 1).otherwise(0)
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), last)))


def induce(pages: DataFrame) -> tuple[DataFrame, list[str]]:
    """(host, template) from rows (host, html), path and text hashes in turn; and the hot hosts.

    The reference of a layout is its page with the most nodes; pages of layouts that are too
    rare for one are held against the host's largest page, as a group of their own.  Pages
    meet their reference in a join in which the pages of a hot host are dealt to groups, and
    only counts per text of a reference are gathered, so a wrapper is as large
    as its references' trees.
    """
    trees = staged(pages.mapInArrow(_skeletons, "host string, layout long, tree string, nodes long"), "wrapper-trees")
    layouts = staged(trees.groupBy("host", "layout").agg(F.max(F.struct("nodes", "tree")).alias("r"), F.count(F.lit(1)).alias("n")),
                     "wrapper-layouts")
    hosts = layouts.groupBy("host").agg(F.max("r").alias("largest"), F.sum("n").alias("all"))
    total = layouts.agg(F.sum("n")).first()[0] or 0
    hot = [r["host"] for r in hosts.where(F.col("all") * HOT_SHARE > total).select("host").collect()]
    own = F.col("n") > TEMPLATE_PAGES
    reference = staged(layouts.join(hosts.where(F.col("all") > TEMPLATE_PAGES).hint("shuffle_merge"), "host").select(
        "host", "layout", F.when(own, F.col("layout")).otherwise(F.lit(0)).alias("group"),
        F.when(own, F.col("r.tree")).otherwise(F.col("largest.tree")).alias("reference")), "wrapper-references")
    counts = (_dealt(trees, hot).join(_for_all(reference, hot).hint("shuffle_merge"), ["host", "layout", "salt"])
              .mapInArrow(_compare, "host string, group long, path long, text long, pages long, equal long")
              .groupBy("host", "group", "path", "text").agg(F.sum("pages").alias("pages"), F.sum("equal").alias("equal"))
              .where((F.col("pages") >= TEMPLATE_PAGES) & (F.col("equal") >= TEMPLATE_SHARE * F.col("pages"))))
    known = counts.select("host", "path", "text").distinct()
    return known.groupBy("host").agg(F.flatten(F.collect_list(F.array("path", "text"))).alias("template")), hot


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row, by the wrapper of its host.

    Null html is empty and gives an empty text; null or odd URLs share the host ""; an empty
    table gives no rows.  Rows are extracted each, repeated or not; other columns are not read.
    Pages of any length and depth are read whole, without recursion.  Where no article is,
    lists and blocks that are nothing but links are menus; all else is kept.  A header inside
    an article is its title and stays; a form goes unless it wraps the page.  White space inside
    a block, a line break included, is one space; blocks are joined by a line feed.  The
    html is shuffled once, to meet the wrappers; pages of a host that has many go to many tasks.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), utf8(html_col).alias("html"),
                        host_of(url_col).alias("host"))
    found, hot = induce(rows.select("host", "html"))
    wrappers = _for_all(staged(found, "wrappers"), hot)
    return (_dealt(rows, hot).join(wrappers.hint("shuffle_merge"), ["host", "salt"], "left").select("page_id", "url", "html", "template")
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
