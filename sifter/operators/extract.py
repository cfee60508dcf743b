"""HTML -> records, one parse per page inside Arrow batches.

``extract(df, html_col, fields)`` runs a single ``mapInPandas`` job over the
page table; each requested field is a small spec (text of the first element
matching a selector, texts of all matches, anchors under an element, ...).
The stdlib ``html.parser`` tolerates unclosed tags; text excludes script,
style and comments, every tag boundary counts as a space, entities are
unescaped and whitespace is collapsed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements that never have content, and raw-text elements
# whose content is not document text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "source", "track", "wbr"}
SKIP_TEXT = {"script", "style", "template", "noscript"}
# An open element of the first kind ends where one of the others
# begins, unless an element of its boundary is open in between.
IMPLIED_END = {
    "p": {"address", "article", "aside", "blockquote", "div", "dl", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "tr": {"tr", "tbody", "tfoot"},
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
}
BOUNDARY = {"ul", "ol", "dl", "table", "select", "button", "div", "article", "section", "nav", "body", "#root"}
_WS = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    attrs: dict[str, str | None]
    parent: "Node | None" = None
    children: list = field(default_factory=list)  # Node or str

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def ancestors(self):
        p = self.parent
        while p is not None:
            yield p
            p = p.parent

    def iter(self):
        """The elements below, in document order, however deep they nest."""
        stack = [iter(self.children)]
        while stack:
            c = next(stack[-1], None)
            if c is None:
                stack.pop()
            elif isinstance(c, Node):
                yield c
                stack.append(iter(c.children))

    def raw_text(self) -> str:
        out: list[str] = []
        stack = [iter(self.children)]
        while stack:
            c = next(stack[-1], None)
            if c is None:
                stack.pop()
                out.append(" ")
            elif isinstance(c, str):
                out.append(c)
            elif c.tag not in SKIP_TEXT:
                out.append(" ")
                stack.append(iter(c.children))
        return "".join(out)

    def text(self) -> str:
        return _WS.sub(" ", self.raw_text()).strip()


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.cur = self.root

    def _imply_ends(self, tag):
        n = self.cur
        while n.tag not in BOUNDARY:
            if tag in IMPLIED_END.get(n.tag, ()):
                self.cur = n.parent
                n = self.cur
            else:
                n = n.parent

    def handle_starttag(self, tag, attrs):
        self._imply_ends(tag)
        node = Node(tag, dict(attrs), self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, dict(attrs), self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:  # close up to the open element
            self.cur = n.parent

    def handle_data(self, data):
        if self.cur.tag not in SKIP_TEXT:
            self.cur.children.append(data)


def parse_html(html: str) -> Node:
    b = _TreeBuilder()
    b.feed(html)
    b.close()
    return b.root


@dataclass(frozen=True)
class Selector:
    """``tag``, ``tag#id``, ``tag.class`` or ``tag[attr=value]`` (tag may be ``*``)."""
    tag: str = "*"
    id: str | None = None
    cls: str | None = None
    attr: tuple[str, str] | None = None

    @staticmethod
    def parse(s: str) -> "Selector":
        m = re.fullmatch(r"([\w*-]*)\[([\w:-]+)=\"?([^\]\"]*)\"?\]", s)
        if m:
            return Selector(m.group(1) or "*", attr=(m.group(2), m.group(3)))
        if "#" in s:
            t, i = s.split("#", 1)
            return Selector(t or "*", id=i)
        if "." in s:
            t, c = s.split(".", 1)
            return Selector(t or "*", cls=c)
        return Selector(s or "*")

    def matches(self, n: Node) -> bool:
        if self.tag != "*" and n.tag != self.tag:
            return False
        if self.id is not None and n.attrs.get("id") != self.id:
            return False
        if self.cls is not None and self.cls not in n.classes():
            return False
        if self.attr is not None and n.attrs.get(self.attr[0]) != self.attr[1]:
            return False
        return True


def select(root: Node, sel: Selector) -> list[Node]:
    return [n for n in root.iter() if sel.matches(n)]


# ------------------------------------------------------------------ field specs

@dataclass(frozen=True)
class Field:
    name: str
    kind: str               # text | texts | links | attr | attrs
    selector: str = "*"
    within: str | None = None   # restrict to descendants of the first match
    attr: str | None = None
    require_class: str | None = None
    under: tuple[str, ...] = ()  # ancestor tags that must appear (nearest first order-free)

    def spark_type(self) -> T.DataType:
        if self.kind in ("text", "attr"):
            return T.StringType()
        if self.kind in ("texts", "attrs"):
            return T.ArrayType(T.StringType())
        if self.kind == "links":
            return T.ArrayType(T.StructType([
                T.StructField("pos", T.LongType()), T.StructField("href", T.StringType()),
                T.StructField("text", T.StringType()), T.StructField("cls", T.StringType())]))
        raise ValueError(self.kind)


def text_of(selector: str, name: str) -> Field:
    return Field(name, "text", selector)


def texts_of(selector: str, name: str) -> Field:
    return Field(name, "texts", selector)


def links_of(name: str, within: str | None = None, require_class: str | None = None,
             under: tuple[str, ...] = ()) -> Field:
    return Field(name, "links", "a", within=within, require_class=require_class, under=under)


def attr_of(selector: str, attr: str, name: str, all_: bool = False) -> Field:
    return Field(name, "attrs" if all_ else "attr", selector, attr=attr)


def _evaluate(root: Node, f: Field):
    scope = root
    if f.within:
        found = select(root, Selector.parse(f.within))
        if not found:
            return None
        scope = found[0]
    nodes = select(scope, Selector.parse(f.selector))
    if f.kind == "text":
        return nodes[0].text() if nodes else None
    if f.kind == "texts":
        return [n.text() for n in nodes]
    if f.kind == "attr":
        for n in nodes:
            if n.attrs.get(f.attr) is not None:
                return n.attrs[f.attr]
        return None
    if f.kind == "attrs":
        return [n.attrs[f.attr] for n in nodes if n.attrs.get(f.attr) is not None]
    if f.kind == "links":
        out, pos = [], 0
        for n in nodes:
            href = n.attrs.get("href")
            if href is None:
                continue
            if f.require_class and f.require_class not in n.classes():
                continue
            if f.under and not _has_chain(n, f.under, scope):
                continue
            out.append({"pos": pos, "href": href, "text": n.text(), "cls": n.attrs.get("class")})
            pos += 1
        return out
    raise ValueError(f.kind)


def _has_chain(n: Node, chain: tuple[str, ...], scope: Node) -> bool:
    """True when the ancestors of ``n`` (inside ``scope``) contain the tags
    of ``chain`` in order from outermost to innermost."""
    anc = []
    for a in n.ancestors():
        if a is scope:
            break
        anc.append(a.tag)
    anc.reverse()
    i = 0
    for t in anc:
        if i < len(chain) and t == chain[i]:
            i += 1
    return i == len(chain)


def parse_fields(html: str | None, fields: list[Field]) -> dict:
    if html is None:
        return {f.name: None for f in fields}
    root = parse_html(html)
    return {f.name: _evaluate(root, f) for f in fields}


def extract(df: DataFrame, html_col: str, fields: list[Field], keep: list[str] | None = None,
            error_col: str | None = "parse_error") -> DataFrame:
    """Add one column per field (parsed once per page). A page whose parse
    raises keeps null fields and the error message in ``error_col``
    (``dead_pages`` lists those); with ``error_col=None`` it fails the task."""
    keep = [c for c in (keep if keep is not None else df.columns) if c != html_col]
    schema = T.StructType([df.schema[c] for c in keep] +
                          [T.StructField(f.name, f.spark_type(), True) for f in fields] +
                          ([T.StructField(error_col, T.StringType(), True)] if error_col else []))
    names = [f.name for f in fields]

    def run(batches):
        for pdf in batches:
            recs = []
            for h in pdf[html_col]:
                try:
                    r = parse_fields(h, fields)
                    if error_col:
                        r[error_col] = None
                except Exception as e:  # noqa: BLE001  (row-level failure is data)
                    if not error_col:
                        raise
                    r = {n: None for n in names}
                    r[error_col] = f"{type(e).__name__}: {e}"
                recs.append(r)
            out = pdf[keep].reset_index(drop=True)
            extra = pd.DataFrame.from_records(recs, columns=names + ([error_col] if error_col else []))
            yield pd.concat([out, extra], axis=1)

    return df.select(*keep, html_col).mapInPandas(run, schema)


def dead_pages(extracted: DataFrame, error_col: str = "parse_error") -> DataFrame:
    """The rows whose page could not be parsed."""
    return extracted.where(F.col(error_col).isNotNull())


# ------------------------------------------------------------------ SQL helpers

def resolve_link(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` relative to the page URL ``base``."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    base_dir = F.regexp_extract(base, r"^([^?#]*/)", 1)
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
             .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
             .when(href.startswith("/"), F.concat(origin, href))
             .when(href.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), href))
             .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
             .otherwise(F.concat(base_dir, href)))
