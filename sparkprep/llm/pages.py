"""Main text of web pages by minimum cut: classifier costs against smoothness along the page and its tree.

A page is cut into blocks of text at block elements. A linear classifier gives each block a score
from its elements, class names, links and words; the score is the capacity to one terminal. Blocks that
follow each other, and blocks with the same parent, are joined by edges that grow with their
closeness in the tree. The minimum cut parts the article from the rest.

Blocks whose terminal outweighs all their edges are on its side in every minimum cut; taking them out
first leaves little or nothing for the flow. Pages are worked on one by one in the tasks that read them.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by their role, in the order of the alphabet.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu "
    "nav noscript ol optgroup option p pre search section select summary table tbody td template tfoot th thead "
    "title tr ul".split()
)
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head noscript object optgroup option select svg template".split())
OUTSIDE = frozenset("aside button dialog footer form label legend menu nav search".split())
#: Elements whose start ends an open paragraph.
ENDS_P = BLOCKS - frozenset("body button caption head html label legend optgroup option select td th tr".split())
#: Elements that end an open one of the same kind.
ALIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}

# Words of class names and ids that mark what is not the article.
_MARKED = re.compile(
    r"(ad|ads|adsbygoogle|adslot|adunit|advert\w*|alert\w*|banner\w*|breadcrumb\w*|comment\w*|consent|cookie\w*|copyright|"
    r"disqus\w*|discussion|feedback|foot|footer\w*|gdpr|head|header|login|masthead|menu\w*|modal|nav|navbar|navigation|"
    r"newsletter|notice\w*|overlay|pager|pagination|popup|promo\w*|recommend\w*|related|replies|reply|responses|search|"
    r"share|sharing|side|sidebar\w*|signup|skip|social\w*|sponsor\w*|subscribe|subscription|tags|teaser|toolbar|"
    r"topbar|warning|widget\w*)",
    re.I,
)
#: Words that leave a marked one beside them its meaning: comment-list, sidebar-left, ad-slot.
_NEUTRAL = re.compile(
    r"(area|articles|bar|block|body|bottom|box|button\w*|column|content|form|inner|item\w*|left|link\w*|list\w*|news|panel|posts|reading|right|section|"
    r"site|slot|stories|text|title|top|unit|\d*)",
    re.I,
)
#: Wrappers that say what they hold or lack: has-sidebar, no-ads, content-sidebar-wrap.
_HOLDS = re.compile(r"(has|have|with|without|no|hide|show|is)[_-]", re.I)
_WRAPS = re.compile(r".*[_-](wrap|wrapper|container|layout|grid|row)", re.I)
_ARTICLE = re.compile(r"(?:^|[\s_-])(?:article\w*|body-text|content|entry|main|post|story|text)(?:$|[\s_-])", re.I)
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())

#: Headings of reader comments, in the languages of the pages.
_COMMENTS = re.compile(
    r"(?:\d+\s+|leave a |post a |add a |write a |reader |readers' |user |all |\(\d+\)\s*)*"
    r"(?:comments?|replies|reply|responses?|discussion|kommentare?|leserkommentare|commentaires?|comentarios?)"
    r"(?:\s*\(?\d+\)?)?\s*[:.]?",
    re.I,
)
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}

#: Cost of a name that is marked as a whole, what it costs more inside an article, and of one where a part is marked.
MARK, WITHIN, PART = 7.0, 7.0, 3.0
SMOOTH = 0.6  #: weight of an edge between neighbours under one parent


def _mark(names: str, inside: bool) -> float:
    """Cost of class names and ids; those that only say what a wrapper holds have none."""
    cost = 0.0
    for name in names.split():
        parts = [p for p in re.split("[_-]+", name) if p]
        marked = [bool(_MARKED.fullmatch(p)) and not (inside and p.lower() in ("head", "header")) for p in parts]
        if not any(marked) or _HOLDS.match(name):
            continue
        if _WRAPS.fullmatch(name):
            cost = max(cost, 0.0 if _ARTICLE.search(name) else PART)
        elif marked[-1] or all(m or _NEUTRAL.fullmatch(p) for m, p in zip(marked, parts)):
            cost = max(cost, MARK + WITHIN * inside)
        else:
            cost = max(cost, PART)
    return cost


class _Node:
    """An open block element."""

    __slots__ = ("name", "up", "depth", "outside", "hidden", "inside", "mark")

    def __init__(self, name: str, up: _Node | None, attributes: str):
        self.name, self.up = name, up
        self.depth = up.depth + 1 if up else 0
        self.outside = bool(up and up.outside) or name in OUTSIDE
        self.hidden = bool(up and up.hidden) or name in HIDDEN
        self.inside = bool(up and up.inside) or name in ("article", "main")
        self.mark = up.mark if up else 0.0
        if name == "header" and not self.inside:
            self.outside = True
        if attributes and not (self.outside or self.hidden):
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            names = f"{found.get('class', '')} {found.get('id', '')}"
            if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
                self.hidden = True
            elif name not in ("html", "body") and found.get("role") in _ROLES:
                self.outside = True
            elif name == "article" and _mark(names, False) >= MARK:
                self.mark = max(self.mark, MARK + WITHIN)  # one comment, teaser or advert
            elif name in ("article", "main") or found.get("role") in ("main", "article"):
                self.inside = True
                if not (up and up.inside) and _mark(names, False) < MARK:
                    self.mark /= 3  # a marked wrapper that holds the article
            else:
                own = 0.0 if name in ("html", "body") else _mark(names, self.inside)
                if found.get("id", "").lower() in ("article", "content", "main"):
                    own = min(own, PART)
                    self.inside = True
                elif not own and _ARTICLE.search(names):
                    self.inside = True
                self.mark = max(self.mark, own)
        elif name in ("article", "main") and not (up and up.inside):
            self.mark /= 3


class Block:
    __slots__ = ("text", "node", "linked", "below")

    def __init__(self, text: str, node: _Node, linked: int):
        self.text, self.node, self.linked = text, node, linked
        self.below = False  #: whether it is a heading of comments or stands below one


def blocks(page: str) -> list[Block]:
    """Blocks of shown text in page order, character references decoded and white space joined."""
    top = node = _Node("", None, "")
    out: list[Block] = []
    runs: list[str] = []
    linked, links, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if runs:
            text = " ".join(html.unescape("".join(runs)).split())
            if text and not node.hidden:
                out.append(Block(text, node, linked))
            runs.clear()
        linked = 0

    while True:
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            runs.append(text)
            if links:
                linked += len(text)
        if not found:
            break
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            if name == "a":
                links = max(links - 1, 0)
            elif name in BLOCKS:
                up = node
                while up is not top and up.name != name:
                    up = up.up
                if up is not top:
                    flush()
                    node = up.up
                    links = 0
            continue
        if name in RAW:
            end = _END[name].search(page, at)
            if name in BLOCKS:
                flush()
            at = end.end() if end else len(page)
        elif name == "a":
            links += 1
        elif name == "br":
            runs.append(" ")
        elif name == "svg" or name == "object":
            end = page.lower().find(f"</{name}", at)
            at = len(page) if end < 0 else end
        elif name in BLOCKS:
            flush()
            if name in ENDS_P:
                up = node
                while up is not top and up.name in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                    up = up.up
                    node = up
            alike = ALIKE.get(name)
            if alike:
                up = node
                while up is not top and up.name not in ("ul", "ol", "dl", "table", "menu") and up.name not in alike:
                    up = up.up
                if up is not top and up.name in alike:
                    node = up.up
            if name not in VOID:
                node = _Node(name, node, found[3])
    flush()
    return out


def below_comments(found: list[Block]) -> None:
    """Marks the headings of reader comments and what follows each in its parent, up to a heading of its rank."""
    heading: _Node | None = None
    for block in found:
        node = block.node
        if heading is not None:
            up: _Node | None = node
            while up is not None and up is not heading.up:
                up = up.up
            if up is None or node.name in _HEADINGS and node.up is heading.up and node.name <= heading.name:
                heading = None
        if heading is None and node.name in _HEADINGS[1:] and _COMMENTS.fullmatch(block.text):
            heading = node
        block.below = heading is not None


def score(block: Block) -> float:
    """Log odds that a block belongs to the article."""
    node, text = block.node, block.text
    if node.outside:
        return -12.0
    n = text.count(" ") + 1
    density = min(block.linked / max(len(text), 1), 1.0)
    value = -1.2 + 0.12 * min(n, 40) - 4.0 * density
    if node.mark:
        value += 0.02 * max(min(n, 150) - 40, 0) - 4.0 * density - node.mark
    if block.below:
        value -= MARK + WITHIN / 2 + 0.12 * min(n, 40)
    if node.inside:
        value += 6.0
    if node.name in ("p", "blockquote", "pre"):
        value += 1.0
    elif node.name == "h1":
        value += 2.0
    if text[-1] in ".!?:;\"'”»…)":
        value += 0.8
    if "©" in text or "all rights reserved" in text.lower():
        value -= 4.0 if n < 30 else 0.5
    return value


def _closeness(a: _Node, b: _Node) -> float:
    """Weight of an edge: halved with each step between the blocks' parents in the tree."""
    a, b = a.up or a, b.up or b
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
        steps += 1
        if steps > 8:
            return 0.0
    return SMOOTH * 0.5**steps


def minimum_cut(scores: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes are on the side of the source in the minimum cut with the fewest of them.

    ``scores`` are capacities from the source (above 0) or to the sink (below); ``edges`` join two
    nodes both ways.
    """
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), w in edges.items():
        if w > 0:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    value = list(scores)
    side: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:  # a node that outweighs its edges is decided; its edges become terminals
        i = waiting.popleft()
        if side[i] is not None or abs(value[i]) <= sum(near[i].values()) and near[i]:
            continue
        side[i] = value[i] > 0
        for j, w in near[i].items():
            value[j] += w if side[i] else -w
            near[j].pop(i)
            if side[j] is None:
                waiting.append(j)
        near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        _flow(rest, value, near, side)
    return [bool(s) for s in side]


def _flow(rest: list[int], value: list[float], near: list[dict[int, float]], side: list[bool | None]) -> None:
    """Augmenting shortest paths between the terminals of the undecided nodes."""
    left = [dict(d) for d in near]
    spare = {i: value[i] for i in rest}
    while True:
        before: dict[int, int] = {i: -1 for i in rest if spare[i] > 1e-12}
        queue, end = deque(before), -1
        while queue:
            i = queue.popleft()
            if spare[i] < -1e-12:
                end = i
                break
            for j, w in left[i].items():
                if w > 1e-12 and j not in before:
                    before[j] = i
                    queue.append(j)
        if end < 0:
            break
        path = [end]
        while before[path[-1]] >= 0:
            path.append(before[path[-1]])
        start = path[-1]
        amount = min(spare[start], -spare[end], *(left[b][a] for a, b in zip(path, path[1:])))
        spare[start] -= amount
        spare[end] += amount
        for a, b in zip(path, path[1:]):
            left[b][a] -= amount
            left[a][b] += amount
    for i in rest:
        side[i] = i in before


def main_text(page: str) -> str:
    found = blocks(page)
    below_comments(found)
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            edges[i - 1, i] = _closeness(found[i - 1].node, block.node)
        parent = id(block.node.up)
        if last.get(parent, i - 1) != i - 1:
            edges[last[parent], i] = SMOOTH / 2
        last[parent] = i
    chosen = minimum_cut([score(b) for b in found], edges)
    return "\n".join(b.text for b, c in zip(found, chosen) if c)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p.as_py() or "") for p in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    ``text`` is the article without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
    and reader comments, its blocks joined by one line break. Character references are decoded, white space in a
    block is one space. A null or empty page, or one without an article, gives an empty text. Repeated
    rows give a row each; further columns are ignored; an empty table gives no rows.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    schema = rows.schema.fieldNames()
    kind = dict(rows.dtypes)
    assert schema == ["page_id", "url", "html"]
    done = rows.mapInArrow(_extract, f"page_id {kind['page_id']}, url string, text string")
    return done.withColumn("n_chars", F.length("text").cast("long"))
