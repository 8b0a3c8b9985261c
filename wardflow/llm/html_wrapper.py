"""Main text of web pages by wrappers, inferred as union-free regular expressions from the pages of a host.

A page becomes a tree of elements. An element's content is a sequence of items: elements, named by tag, class and id,
and text slots. Adjacent items that repeat are folded into a repeated group. Two sequences are aligned; what only one
of them has becomes optional, what matches is aligned inside, and text becomes a slot that counts the characters met.
So the wrapper of a host is built page by page within each task, and the tasks' wrappers are aligned with one another
in the same way, first within parts of a host and then over the parts.

The wrapper tells where a host keeps its articles: the outermost `article` or `main`, or else the innermost item with
most of the text outside of boilerplate. Every page is then read at that place.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Generator, Iterator
from difflib import SequenceMatcher
from functools import wraps

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
RAW = {"script", "style", "textarea", "title", "noscript", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
#: Elements that the start of another of the group ends, and those beyond which none is looked for.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
#: Boilerplate by tag, by role and by a class or id.
LEFT_OUT = {
    "nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "object", "svg", "canvas",
    "button", "select", "textarea", "dialog", "menu", "title", "head", "audio", "video", "map", "xmp", "noembed", "noframes",
}
ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "form", "alert", "dialog", "menu", "menubar"}
MARKS = {
    "ad", "ads", "adbox", "adsense", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie", "cookies", "copyright", "disqus", "footer",
    "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager",
    "pagination", "popup", "promo", "promoted", "related", "replies", "respond", "share", "sharing", "sidebar", "signup",
    "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Words that a class or id may have beside its marks and still name nothing else.
FURNITURE = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "container", "form", "group", "header",
    "holder", "icons", "inline", "inner", "item", "items", "left", "link", "links", "list", "outer", "page", "panel",
    "placeholder", "post", "posts", "right", "row", "section", "site", "slot", "top", "unit", "wrap", "wrapper",
}
#: Elements that a class or id can make boilerplate, and the mark of what is not displayed.
CONTAINERS = {"div", "section", "ul", "ol", "dl", "article"}
HIDDEN = "hidden"
#: Pages of a host, and their share, that have to show a mark within the article before it counts there.
MANY_PAGES, MANY_SHARE = 3, 0.05
MAIN = {"article", "main"}
#: Inside of a main element, or of an article.
INSIDE = {"main": 1, "article": 2}
#: Parts of a host whose tasks' wrappers are aligned first.
PARTS = 32
#: Items of a wrapper beyond which those met on the fewest pages are left out of it; pages lose nothing by that.
MOST_ITEMS = 4000
LONGEST_PERIOD = 6


class Node:
    """An element of a page or of a wrapper: tag, name (with class and id), marks and content; "#" is a text slot."""

    __slots__ = ("tag", "name", "left_out", "text", "content", "many", "optional", "pages", "chars", "linked", "marks")

    def __init__(self, tag: str, name: str = "", left_out: bool = False, text: str = ""):
        self.tag, self.name, self.left_out, self.text = tag, name or tag, left_out, text
        self.content: list[Node] = []
        self.marks: tuple[str, ...] = ()
        self.many = self.optional = False
        self.pages, self.chars, self.linked = 1, 0, 0


def attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(raw):
        found.setdefault(key.lower(), html.unescape(value[1:-1] if value[:1] in "\"'" and value else value))
    return found


def is_mark(name: str) -> bool:
    """Whether a class or id as a whole names boilerplate; one with any other word in it does not."""
    words = {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", name)}
    return name.isascii() and not words.isdisjoint(MARKS) and words <= MARKS | FURNITURE


def element(tag: str, raw: str) -> Node:
    if not raw.strip("/ \t\r\n\f"):
        return Node(tag, tag, tag in LEFT_OUT)
    has = attributes(raw)
    names = f"{has.get('class', '')} {has.get('id', '')}"
    hidden = "hidden" in has or has.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", has.get("style", ""))
    left_out = tag in LEFT_OUT or has.get("role", "").lower() in ROLES
    main = "!main" if has.get("role") == "main" or has.get("itemprop") == "articleBody" else ""
    made = Node(tag, tag + "." + re.sub(r"\d+", "", " ".join(sorted(names.split()))) + main, left_out)
    if tag in CONTAINERS:
        made.marks = tuple(k + re.sub(r"\d+", "", n) for k, c in ((".", "class"), ("#", "id")) for n in has.get(c, "").split() if is_mark(n))
    made.marks += (HIDDEN,) * bool(hidden)
    return made


def parsed(page: str) -> Node:
    """The tree of a page; wrong nesting is mended as browsers do, roughly."""
    root = Node("html")
    stack, at = [root], 0

    def add_text(raw: str) -> None:
        if raw:
            stack[-1].content.append(Node("#", "#", text=html.unescape(raw)))

    def close(tags: set[str], barriers: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return
            if stack[k].tag in barriers:
                return

    while True:
        token = TOKEN.search(page, at)
        add_text(page[at : token.start() if token else len(page)])
        if not token:
            return root
        at = token.end()
        ending, tag = token[1], (token[2] or "").lower()
        if not tag:
            continue
        if ending:
            inline = tag not in BLOCKS
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if inline and stack[k].tag in BLOCKS:
                    break
            continue
        if tag in ("html", "body"):
            if tag == "body" and not any(n.tag == "body" for n in stack):
                close({"head"}, set())
                body = element(tag, token[3])
                body.left_out = False
                stack[-1].content.append(body)
                stack.append(body)
            continue
        if tag in BLOCKS:
            close({"p"}, {"td", "th", "table", "button", "object", "body"})
        if tag in ENDS:
            close(ENDS[tag], BARRIERS[tag])
        if tag in BLOCKS and stack[-1].tag == "head":
            stack.pop()
        node = element(tag, token[3])
        stack[-1].content.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            inside = page[at : end.start() if end else len(page)]
            if tag not in ("script", "style"):
                node.content.append(Node("#", "#", text=html.unescape(inside)))
            at = end.end() if end else len(page)
        elif tag not in VOID and not token[3].endswith("/"):
            stack.append(node)


def has_main(node: Node) -> bool:
    """Whether the element holds the article or its heading: then a mark in its class does not make it boilerplate."""
    todo = [*node.content]
    while todo:
        n = todo.pop()
        if n.tag in MAIN and not n.marks or n.tag == "h1":
            return True
        if n.tag not in LEFT_OUT:
            todo += n.content
    return False


def boilerplate(node: Node, inside: int, shown: frozenset[str] | None = None) -> bool:
    """Whether an element is left out; of its marks, those in `shown` count, or all if that is None.

    The main element and articles that lie in no other article are never left out for a class, an id or a role.
    """
    if node.tag == "header":
        return not inside and not has_main(node)
    if node.tag in LEFT_OUT:
        return True
    if node.name.endswith("!main") or node.tag in MAIN and not (node.tag == "article" and inside == INSIDE["article"]):
        return False
    return (node.left_out or any(shown is None or m in shown for m in node.marks)) and not has_main(node)


def stacked(steps):
    """Runs a function that yields its calls, of itself and of others alike, on a stack of its own, however deep they nest."""

    @wraps(steps)
    def run(*args, **how):
        stack: list[Generator] = [steps(*args, **how)]
        value = None
        while stack:
            try:
                call = stack[-1].send(value)
            except StopIteration as end:
                value = end.value
                stack.pop()
            else:
                stack.append(call)
                value = None
        return value

    run.steps = steps
    return run


@stacked
def folded(items: list[Node]):
    """Adjacent repeats of one to LONGEST_PERIOD items as repeated items, aligned with one another."""
    for period in range(1, LONGEST_PERIOD + 1):
        out: list[Node] = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * period and [n.name for n in out[-period:]] == [n.name for n in out[-2 * period : -period]]:
                again = out[-period:]
                del out[-period:]
                for k, n in enumerate(again):
                    joined = out[k - period] = yield aligned.steps(out[k - period], n, same_page=True)
                    joined.many = True
        items = out
    return items


@stacked
def aligned(a: Node, b: Node, same_page: bool = False):
    """The least item that stands for both."""
    made = Node(a.tag, a.name, a.left_out and b.left_out)
    made.many, made.optional = a.many or b.many, a.optional or b.optional
    made.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    made.chars, made.linked = a.chars + b.chars, a.linked + b.linked
    made.marks = tuple(m for m in a.marks if m in b.marks)
    if a.content or b.content:
        made.content = yield aligned_content(a.content, b.content, same_page)
    return made


def aligned_content(a: list[Node], b: list[Node], same_page: bool) -> Generator:
    left, right = [n.name for n in a], [n.name for n in b]
    if left == right:
        same = []
        for x, y in zip(a, b):
            same.append((yield aligned.steps(x, y, same_page)))
        return same
    made: list[Node] = []
    for how, i, j, k, m in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if how == "equal":
            for x, y in zip(a[i:j], b[k:m]):
                made.append((yield aligned.steps(x, y, same_page)))
        else:
            for n in [*a[i:j], *b[k:m]]:
                n.optional = True
                made.append(n)
    return (yield folded.steps(made))


@stacked
def wrapper_of(node: Node, inside: int = 0, in_link: bool = False, shown: frozenset[str] | None = None):
    """A page's own wrapper: folded content, texts as slots with the characters outside of boilerplate."""
    made = Node(node.tag, node.name, boilerplate(node, inside, shown))
    made.marks = node.marks
    if node.tag == "#":
        size = len(node.text.strip())
        made.chars, made.linked = size, size * in_link
        return made
    if made.left_out:
        return made
    place, linked = max(inside, INSIDE.get(node.tag, 0)), in_link or node.tag == "a"
    items = []
    for n in node.content:
        if n.tag != "#" or n.text.strip():
            items.append((yield wrapper_of.steps(n, place, linked, shown)))
    made.chars, made.linked = sum(n.chars for n in items), sum(n.linked for n in items)
    made.content = yield folded.steps([n for n in items if not (n.left_out and n.tag in ("script", "style"))])
    return made


def count(node: Node) -> int:
    todo, found = [node], 0
    while todo:
        n = todo.pop()
        found += 1
        todo += n.content
    return found


def pruned(node: Node) -> Node:
    """A wrapper of MOST_ITEMS at most: optional items of the fewest pages go first."""
    least = 1
    while count(node) > MOST_ITEMS:
        todo = [node]
        while todo:
            n = todo.pop()
            n.content = [x for x in n.content if not (x.optional and x.pages <= least)]
            todo += n.content
        least *= 2
        if least > node.pages * 2:
            break
    return node


def article_path(wrapper: Node) -> list[str]:
    """Names from the root to the item that holds the articles; articles that are marked, as comments are, come last."""
    todo = [(wrapper, [wrapper.name])]
    marked: list[tuple[bool, int, list[str]]] = []
    while todo:
        node, path = todo.pop()
        for n in node.content:
            if n.left_out or n.tag == "#":
                continue
            if (n.tag in MAIN or n.name.endswith("!main")) and n.chars > 0:
                marked.append((not n.marks, n.chars, [*path, n.name]))
            else:
                todo.append((n, [*path, n.name]))
    if marked:
        best = max(marked)[2]
        return inner_article(wrapper, best)
    node, path = wrapper, [wrapper.name]
    while True:
        inside = [n for n in node.content if n.tag not in ("#", "p", "ul", "ol", "table", "blockquote") and not n.left_out and n.tag in BLOCKS]
        weight = lambda n: n.chars - 2 * n.linked
        best = max(inside, key=weight, default=None)
        if best is None or weight(best) < 0.6 * max(1, weight(node)):
            return path
        node, path = best, [*path, best.name]


def inner_article(wrapper: Node, path: list[str]) -> list[str]:
    """From a `main` on to an `article` within it that holds most of its text outside of marked articles."""
    node = wrapper
    for name in path[1:]:
        node = next(n for n in node.content if n.name == name)
    if node.tag == "article":
        return path
    todo, chars = [(node, path)], node.chars
    found: list[tuple[int, list[str]]] = []
    while todo:
        n, p = todo.pop()
        for x in n.content:
            if x.left_out or x.tag == "#":
                continue
            if x.tag == "article" and x.marks:
                chars -= x.chars
                continue
            if x.tag == "article":
                found.append((x.chars, [*p, x.name]))
            todo.append((x, [*p, x.name]))
    return next((p for c, p in found if c >= 0.5 * chars), path)


def shown_marks(wrapper: Node, path: list[str]) -> list[str]:
    """The marks that enough pages of a host show within its articles."""
    least = min(wrapper.pages, max(MANY_PAGES, MANY_SHARE * wrapper.pages))
    todo, found = at_path(wrapper, path), {HIDDEN}
    while todo:
        n = todo.pop()
        todo += n.content
        found.update(m for x in n.content if x.pages >= least for m in x.marks)
    return sorted(found)


def at_path(root: Node, path: list[str]) -> list[Node]:
    found = [root]
    for name in path[1:]:
        found = [n for f in found for n in f.content if n.name == name]
    return found


def blocks(node: Node, shown: frozenset[str] | None = None) -> list[str]:
    """Texts of the blocks in page order, without boilerplate; white space within a block is one space."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    start = max(INSIDE.get(node.tag, 0), int(node.name.endswith("!main")))
    todo: list[tuple[str, Node, int]] = [("open", n, start) for n in reversed(node.content)]
    while todo:
        how, n, inside = todo.pop()
        if how == "close":
            end()
        elif n.tag == "#":
            run.append(n.text)
        elif n.tag == "br":
            run.append(" ")
        elif not boilerplate(n, inside, shown):
            if n.tag in BLOCKS:
                end()
                todo.append(("close", n, inside))
            todo += [("open", x, max(inside, INSIDE.get(n.tag, 0))) for x in reversed(n.content)]
    end()
    return out


def main_text(page: str | None, path: list[str] | None, shown: frozenset[str] | None = None) -> str:
    """The main text of one page, read where its host keeps articles, or where its own wrapper says if that is absent.

    Within the article, marks count if the host's pages show them, or all of them if nothing is known of the host. Of a
    page that has no text outside of marked or hidden elements, all is read but what tags and roles leave out.
    """
    if not page:
        return ""
    tree = parsed(page)

    def read(path: list[str], shown: frozenset[str] | None) -> str:
        return "\n\n".join(b for p in at_path(tree, path) for b in blocks(p, shown))

    every: frozenset[str] = frozenset()
    return (
        (read(path, shown) if path else "")
        or read(article_path(wrapper_of(tree)), shown)
        or read(article_path(wrapper_of(tree, shown=every)), every)
    )


def host_of(url: Column) -> Column:
    """The host of an address in lower case; the empty text for one without host or a null one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[^/?#]*//(?:[^/?#]*@)?([^/?#:]*)", 1)), F.lit(""))


def to_json(node: Node) -> list:
    """The items of a wrapper in its order, each with its depth."""
    todo, found = [(0, node)], []
    while todo:
        depth, n = todo.pop()
        found.append([depth, n.tag, n.name, n.left_out, n.many, n.optional, n.pages, n.chars, n.linked, n.marks])
        todo += [(depth + 1, x) for x in reversed(n.content)]
    return found


def from_json(held: list) -> Node:
    path: list[Node] = []
    for depth, tag, name, left_out, many, optional, pages, chars, linked, marks in held:
        node = Node(tag, name, left_out)
        node.many, node.optional, node.pages, node.chars, node.linked, node.marks = many, optional, pages, chars, linked, tuple(marks)
        del path[depth:]
        if path:
            path[-1].content.append(node)
        path.append(node)
    return path[0]


def written(wrapper: Node) -> str:
    """The wrapper as a regular expression over elements: `name( ... )`, `+` repeated, `?` optional, `#` a text slot."""
    todo: list[Node | str] = [wrapper]
    out = []
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
            continue
        out.append(n.name)
        todo.append("+" * n.many + "?" * n.optional)
        if n.content:
            todo.append(")")
            for k, x in enumerate(reversed(n.content)):
                todo += [" ", x] if k else [x]
            todo.append("(")
    return "".join(out)


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, wrapper (JSON), expression, article path and marks shown there of every host, inferred from all of its pages.

    Pages without a host share a wrapper, but that tells nothing of marks: `shown` is null.
    """
    schema = "host string, part int, wrapper string"

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = (TaskContext.get().partitionId() if TaskContext.get() else 0) % PARTS
        held: dict[str, Node] = {}

        def emit() -> pa.RecordBatch:
            rows = [list(held), [part] * len(held), [json.dumps(to_json(w)) for w in held.values()]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.string())], ["host", "part", "wrapper"])

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = wrapper_of(parsed(page.as_py() or ""))
                held[host] = pruned(aligned(held[host], own)) if host in held else own
                if len(held) >= 2000:
                    yield emit()
        yield emit()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        made = None
        for raw in sorted(group["wrapper"]):
            own = from_json(json.loads(raw))
            made = own if made is None else pruned(aligned(made, own))
        return pd.DataFrame({"host": group["host"].iloc[:1], "part": group["part"].iloc[:1], "wrapper": [json.dumps(to_json(made))]})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [from_json(json.loads(w.as_py())) for w in batch.column(1)]
            paths = [article_path(w) for w in made]
            shown = [json.dumps(shown_marks(w, p)) if host.as_py() else None for host, w, p in zip(batch.column(0), made, paths)]
            columns = [pa.array(c, pa.string()) for c in (map(written, made), map(json.dumps, paths), shown)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["host", "wrapper", "expression", "path", "shown"])

    own = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    of_parts = own.mapInArrow(infer, schema).groupBy("host", "part").applyInPandas(merge, schema)
    of_hosts = of_parts.groupBy("host").applyInPandas(merge, schema)
    return of_hosts.select("host", "wrapper").mapInArrow(finish, "host string, wrapper string, expression string, path string, shown string")


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars and host of every row, from its whole html.

    A null or empty page has an empty text; pages without a usable address share one wrapper, under the empty host.
    Repeated rows are read alike; an empty table gives no rows. Only the hosts' article paths and marks are joined to the pages,
    in a join that Spark can split by rows if one host has many.
    """
    paths = checkpointed(wrappers(pages, url_col, html_col).select("host", "path", "shown"))
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host")
    )
    joined = rows.join(paths, "host", "left").select("page_id", "url", "html", "host", "path", "shown")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = zip(batch.column(2), batch.column(4).to_pylist(), batch.column(5).to_pylist())
            texts = [main_text(page.as_py(), json.loads(path or "[]"), shown and frozenset(json.loads(shown))) for page, path, shown in known]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), batch.column(3)],
                ["page_id", "url", "text", "n_chars", "host"],
            )

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return joined.mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, host string")
