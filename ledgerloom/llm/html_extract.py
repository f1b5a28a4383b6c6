"""Main text of web pages by tree scoring."""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: An opening tag on the left ends an open element on the right, if none of the fences lies between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}
#: Elements that never belong to an article, and roles and names that say so.
DROPPED = frozenset("head script style noscript template nav footer aside form button select option input textarea svg canvas iframe object embed audio video map dialog menu".split()) - {"form"}
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert toolbar".split())
NAMES = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|banner\w*|sponsor\w*|promo\w*|side-?bar\w*|comments?|comment-?list|respond|replies|disqus\w*|nav\w*|menu\w*|breadcrumbs?|footer|masthead|(?:site|page|top)-?header|cookie\w*|consent\w*|gdpr|notice\w*|alert\w*|popup|modal|overlay|newsletter|subscribe\w*|subscription|signup|login|shares?|share-?(?:bar|this|buttons?|links?)|sharing|social\w*|related|recommend\w*|widget\w*|skip|pagination|pager|toolbar|search)(?:$|[^a-z])")
#: What people write below an article can be longer than it.
REPLIES = re.compile(r"(?:^|[^a-z])(?:comments?|comment-?list|respond|replies|disqus\w*)(?:$|[^a-z])")
GOOD = re.compile(r"(?:^|[^a-z])(?:article|main|content|body|entry|post|story|text)(?:$|[^a-z])")
PARAGRAPHS = frozenset("p pre td th blockquote li dd dt figcaption".split()) | HEADINGS


#: Names that tell how a page is laid out or what is switched on, not what an element holds.
LAYOUT = re.compile(r"^(?:has|no|with|without|is|not)[-_]|[-_](?:with|has|no|without)[-_]|[-_](?:enabled|disabled|active|open|closed|layout|page)$")


def says(pattern: re.Pattern, names: str) -> bool:
    """Whether one of an element's names, each for itself, matches."""
    return any(pattern.search(x) and not LAYOUT.search(x) for x in names.split())


class Node:
    __slots__ = ("tag", "up", "down", "bad", "doubt", "named", "header", "main", "weight", "score", "text", "links", "paragraphs")

    def __init__(self, tag: str, up: "Node | None", names: str = "", role: str = "", hidden: bool = False):
        self.tag, self.up, self.down = tag, up, []
        self.bad = tag in DROPPED or hidden
        named = bool(names) and tag != "main" and says(NAMES, names)
        #: Whether it is cut, unless it holds the main article or all of the page: 2 for what readers add, 1 for other furniture.
        self.doubt = 0 if tag in ("html", "body", "main") else 2 if named and says(REPLIES, names) else 1 if named or tag == "form" or role in ROLES else 0
        self.header = tag == "header"
        self.main = tag in ("article", "main") or role in ("main", "article")
        self.named = named
        self.weight = 1.25 if self.main or GOOD.search(names) else 1.0
        self.score, self.text, self.links, self.paragraphs = 0.0, 0, 0, False


class Scanner:
    """The markup of a page from left to right; what is searched for in vain is not searched for again."""

    def __init__(self, source: str):
        self.source, self.gone, self.plain = source, set(), False

    def find(self, what: str, start: int) -> int:
        if what in self.gone:
            return -1
        at = self.source.find(what, start)
        if at < 0:
            self.gone.add(what)
        return at

    def tag_end(self, start: int) -> int:
        """Where a tag's `>` is, -1 without one.

        Quoted values may hold others, and a quote that never ends is a sign like any. Once
        a tag has no end but in quotes, quotes no longer count.
        """
        pos = start
        while not self.plain and (m := SPECIAL.search(self.source, pos)):
            if m[0] == ">":
                return m.start()
            closing = self.find(m[0], m.end())
            pos = m.end() if closing < 0 else closing + 1
        self.plain = True
        return self.find(">", start)

    def tokens(self):
        """(text) of strings and (close, tag, attributes, place after it) of tags; comments and the like are left out. send() moves on."""
        source, n, pos, text = self.source, len(self.source), 0, 0
        while pos < n:
            at = self.find("<", pos)
            if at < 0:
                break
            if source.startswith("<!--", at):
                end = self.find("-->", at + 4)
                end = n if end < 0 else end + 3
            elif source.startswith("<![CDATA[", at) and (end := self.find("]]>", at)) >= 0:
                yield source[text:at] + source[at + 9 : end]
                text = pos = end + 3
                continue
            elif source[at + 1 : at + 2] in ("!", "?"):
                end = self.find(">", at)
                end = n if end < 0 else end + 1
            elif m := NAME.match(source, at):
                end = self.tag_end(m.end())
                if end < 0:
                    pos = at + 1  # no tag without an end
                    continue
                if text < at:
                    yield source[text:at]
                moved = yield source[at + 1] == "/", m[1].lower(), source[m.end() : end], end + 1
                text = pos = moved if moved is not None else end + 1
                continue
            else:
                pos = at + 1
                continue
            if text < at:
                yield source[text:at]
            text = pos = end
        if text < n:
            yield source[text:]


def parse(source: str) -> Node:
    """A tree of nodes and strings; open elements end as browsers end them."""
    root = at = Node("#root", None)
    n, open_, scanner = len(source), Counter(), Scanner(source)
    tokens, moved = scanner.tokens(), None

    def leave(to: Node) -> Node:
        nonlocal at
        while at is not to:
            open_[at.tag] -= 1
            at = at.up
        return at

    while True:
        try:
            token = next(tokens) if moved is None else tokens.send(moved)
        except StopIteration:
            return root
        moved = None
        if isinstance(token, str):
            at.down.append(token)
            continue
        close, tag, attrs, pos = token
        if close:
            if open_[tag] > 0:
                node = at
                while node.tag != tag:
                    node = node.up
                if not (tag in INLINE and blocked(at, node)):
                    leave(node.up)
            continue
        given = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)} if "=" in attrs or "hidden" in attrs else {}
        if tag in CLOSES_P and open_["p"] > 0:
            leave(ended(at, {"p"}, {"td", "th", "li", "div", "section", "article", "blockquote", "button"}))
        if tag in HEADINGS and at.tag in HEADINGS:
            leave(at.up)
        if tag in ENDS and any(open_[t] > 0 for t in ENDS[tag][0]):
            leave(ended(at, *ENDS[tag]))
        names = f"{given.get('class', '')} {given.get('id', '')}".lower()
        node = Node(tag, at, names, given.get("role", "").lower(), "hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in given.get("style", "").replace(" ", "").lower())
        at.down.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, pos)
            node.down.append(source[pos : end.start() if end else n])
            moved = end.end() if end else n
            node.bad = True
            continue
        if not attrs.endswith("/") or tag not in ("path", "circle", "rect", "use", "g"):
            at = node
            open_[tag] += 1


def blocked(at: Node, node: Node) -> bool:
    """Whether a block lies between: then the closing tag of an inline element is stray."""
    while at is not node:
        if at.tag not in INLINE:
            return True
        at = at.up
    return False


def ended(at: Node, tags: set[str], fences: set[str]) -> Node:
    node, found = at, None
    while node is not None and node.tag not in fences:
        if node.tag in tags:
            found = node
        node = node.up
    return found.up if found is not None else at


def clean(raw: str) -> str:
    return " ".join((html.unescape(raw) if "&" in raw else raw).split())


def order(root: Node) -> list[Node]:
    """All kept nodes, parents first; without recursion, as pages can nest deeply."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.bad or node.header and not inside(node):
            node.bad = True
            continue
        out.append(node)
        todo.extend(x for x in reversed(node.down) if isinstance(x, Node))
    return out


def judge(root: Node) -> None:
    """Cuts elements whose name, role or tag tells of furniture, whatever they hold.

    Kept are those around the main article: the longest of the outermost article and main elements
    that neither have such a name nor lie in an element that has. If nothing is left but
    headings and links, the furniture of most text is opened, readers' comments last, until something is.
    """
    nodes, todo = [], [(root, False, False)]
    articles = []
    while todo:
        node, named, held = todo.pop()
        if node.bad:
            continue
        nodes.append(node)
        named = named or node.named
        if node.main and not named and not held:
            articles.append(node)
            held = True
        todo.extend((x, named, held) for x in node.down if isinstance(x, Node))
    if not any(x.doubt for x in nodes):
        return
    plain: dict[Node, int] = {}
    for node in reversed(nodes):
        plain[node] = 0 if node.tag == "a" or node.tag in HEADINGS else sum(len(x.strip()) if isinstance(x, str) else plain.get(x, 0) for x in node.down)
    around = max((x for x in articles if plain[x]), key=plain.__getitem__, default=None)
    while around is not None:
        around.doubt = 0
        around = around.up
    free: dict[Node, int] = {}
    for node in reversed(nodes):
        free[node] = 0 if node.tag == "a" or node.tag in HEADINGS else sum(len(x.strip()) if isinstance(x, str) else 0 if x.doubt else free.get(x, 0) for x in node.down)
    at = root
    while at is not None and not free[at]:
        shut, todo = [], [at]
        while todo:
            for x in todo.pop().down:
                if isinstance(x, Node) and not x.bad:
                    (shut if x.doubt else todo).append(x)
        at = max((x for x in shut if plain[x]), key=lambda x: (x.doubt < 2, plain[x]), default=None)
        if at is not None:
            at.doubt = 0
    for node in nodes:
        node.bad = node.doubt > 0


def inside(node: Node) -> bool:
    """Whether a header belongs to an article and not to the page."""
    while node.up is not None:
        node = node.up
        if node.tag in ("article", "main", "section"):
            return True
    return False


def blocks(root: Node) -> list[str]:
    """The text of the kept nodes below root, cut where a block begins or ends."""
    out, open_, todo = [], [], [(root, 0)]
    while todo:
        node, i = todo.pop()
        if i == 0 and node.tag not in INLINE:
            flush(out, open_)
        while i < len(node.down):
            x = node.down[i]
            i += 1
            if isinstance(x, str):
                open_.append(x)
            elif x.tag in ("br", "hr"):
                flush(out, open_)
            elif not x.bad:
                todo += [(node, i), (x, 0)]
                break
        else:
            if node.tag not in INLINE:
                flush(out, open_)
    flush(out, open_)
    return out


def flush(out: list[str], open_: list[str]) -> None:
    if open_:
        text = clean("".join(open_))
        if text:
            out.append(text)
        open_.clear()


def main_blocks(source: str) -> list[str]:
    """The blocks of the outermost article around the best container, or of it and all beside it that is not mainly links."""
    root = parse(source)
    judge(root)
    nodes = order(root)
    for node in reversed(nodes):
        own = 0
        for x in node.down:
            if isinstance(x, str):
                own += len(clean(x))
            elif not x.bad:
                node.text += x.text
                node.links += x.links
        node.text += own
        if node.tag == "a":
            node.links = node.text
        node.paragraphs = own > 0
    for node in nodes:
        loose = node.tag not in PARAGRAPHS and node.tag not in INLINE and node.paragraphs
        if (node.tag in PARAGRAPHS or loose) and node.text:
            commas = sum(x.count(",") for x in node.down if isinstance(x, str))
            points = (1 + commas + min(node.text / 100, 3)) * (1 - node.links / node.text) * (0.3 if node.tag in HEADINGS else 1)
            up, share = node if loose else node.up, 1.0
            for depth in range(4):
                if up is None:
                    break
                if up.tag not in INLINE and up.tag not in PARAGRAPHS:
                    up.score += points * share
                    share = 0.5 if depth == 0 else share * 2 / 3
                up = up.up
    best, most = None, 0.0
    for node in nodes:
        node.score *= node.weight * (1 - node.links / node.text if node.text else 1)
        if node.score > most:
            best, most = node, node.score
    if best is None:
        return blocks(root)
    while best.up is not None and best.up.up is not None and best.up.tag not in ("html", "#root") and best.tag in PARAGRAPHS | INLINE:
        best = best.up
    if best.up is None or best.tag in ("body", "html"):
        return blocks(best)
    up, whole = best, None
    while up is not None:
        if up.main:
            whole = up
        up = up.up
    if whole is not None:
        beside = [x for x in whole.up.down if isinstance(x, Node) and x.main and x.tag == whole.tag and not x.bad and 2 * x.links <= x.text]
        return [b for x in beside for b in blocks(x)] if whole in beside else blocks(whole)
    kept = []
    for run in runs(best.up.down):
        size = sum(x.text if isinstance(x, Node) else len(clean(x)) for x in run)
        heading = isinstance(run[0], Node) and run[0].tag in HEADINGS
        if best in run or heading or 2 * sum(x.links for x in run if isinstance(x, Node)) <= size:
            kept += run
    best.up.down = kept
    return blocks(best.up)


def runs(down: list) -> list[list]:
    """Kept children: each block alone, text and inline elements that follow one another together."""
    out, open_ = [], False
    for x in down:
        if isinstance(x, Node) and x.bad:
            continue
        inline = not isinstance(x, Node) or x.tag in INLINE
        if inline and open_:
            out[-1].append(x)
        else:
            out.append([x])
        open_ = inline
    return out


def main_text(source: str | None) -> str:
    return " ".join(main_blocks(source)) if source else ""


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of each page, over its whole source.

    Paragraphs pass one point, one for each comma and up to three for length to
    their ancestors (all, half, a third and so on), less the share of link text;
    of the container of the most points the outermost article or main element around
    it is kept, with all like it beside it that are not mainly links, or, without one, it and all beside it that is not mainly links, bare
    text included. Navigation,
    headers and footers of the page, asides, forms, adverts, notices, comments
    and hidden elements are cut before scoring, however long they are; those that only a name, a role or a
    form tells of not if they hold the main article (see judge) or if nothing would be left.

    Null and empty sources: empty text. Pages without containers: all text that
    is left. Broken markup: elements end as in browsers; a quote that never ends is a
    sign like any. Very long sources: read once from left to right, with a node for
    each tag. Null ids and addresses stay. Repeated rows: each
    extracted alone. Ties: the outer container. An empty table: no rows. Other columns
    are ignored.

    Returns id_col, url_col, text, n_chars.
    """
    keyed = pages.select(F.struct(F.col(id_col).alias("a"), F.col(url_col).cast("string").alias("b")).alias("id"), F.col(html_col).cast("string").alias("text"))
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column("text")]
            yield pa.record_batch([b.column("id"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["id", "text", "n_chars"])

    out = keyed.mapInArrow(run, f"id struct<a:{kind},b:string>, text string, n_chars long")
    return out.select(F.col("id.a").alias(id_col), F.col("id.b").alias(url_col), "text", "n_chars")
