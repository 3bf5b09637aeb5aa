"""Main text of pages by wrapper induction over all pages of a host.

Every page becomes a tree of its block elements, like siblings taken as one node.
Spark counts, over all pages of a host, in how many different pages each node
stands, how much text it holds, and which texts it repeats (pages whose longest
text is the same are copies and count once). Two things follow for a host:

- its wrapper: the nodes that at least ``SHARE`` of its pages have (two at least).
  A node is constant, hence template, if ``CONSTANT`` of its text stands on as many pages;
  the others vary, a line that some of their texts share included;
- the content slot: from the root down, the child that holds at least half of the
  varying text outside links, as long as that text stands in elements further down;
  so single notices, adverts and footers, even where their text varies, lose
  against the part of the layout that varies in elements of its own.

A page is aligned with its host's wrapper by simple tree matching (dynamic
programming over order-keeping matchings of children). A block is content if the
lowest matched node above it lies in the content slot, and its own node is not
constant and less than half links on the host. Elements that HTML itself
defines as something else (``nav``, ``header``, ``footer``, ``aside``, forms and
their fields, dialogs, scripts, hidden ones and the like) hold no content.

A host with a single different page has nothing to align. There, and on pages
that hold nothing at all in the content slot, the elements' names decide:
``article`` or ``main`` if there is one, without elements whose class or id says
that they are something else.

Evidence travels as hashes. A host's wrapper is bounded: what stands in a share of
its pages is at most that many times one page's nodes and texts. Wrappers meet
their pages in a join, by broadcast where they are small, else by host with skew
handled by adaptive execution. Null html gives an empty text; a null url is a host
of its own; repeated rows give repeated results; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.html_tree import Layout, Node, matched, text_hash
from headway.llm.staging import bounded_batches, staged

SHARE = 0.3
CONSTANT = 0.8
LINKED = 0.5

# Elements and roles that HTML and ARIA define as other than main text.
_NO_CONTENT = frozenset(
    "head nav header footer aside form button select input menu dialog script style noscript template iframe svg canvas object textarea".split()
)
_NO_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Class and id words of elements without content; only where a host has no second page.
_NO_CONTENT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|overlay"
    r"|nav\w*|menu|breadcrumbs?|pagination|sidebar|widget|masthead|copyright"
    r"|comments?|replies|share|social|related|newsletter|subscribe|signup|login|search)(?:$|[\s_-])"
)
_SLOT = ("article.", "main.")
EVIDENCE = "host string, path long, parent long, depth int, place int, text long, chars long, links long, page long"
WRAPPER = "host string, pages long, nodes array<struct<path:long,parent:long,place:int,content:boolean,other:boolean>>"


def _defined_as_other(node: Node) -> bool:
    a = node.attributes
    return node.tag in _NO_CONTENT or a.get("role") in _NO_CONTENT_ROLES or "hidden" in a or a.get("aria-hidden") == "true"


def _named_as_other(node: Node) -> bool:
    return _defined_as_other(node) or (node.tag not in ("html", "body") and bool(_NO_CONTENT_NAMES.search(node.kind.partition(".")[2])))


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each page (``text`` null) and its texts with their nodes."""
    names = [f.strip().split(" ")[0] for f in EVIDENCE.split(",")]
    for batch in batches:
        rows: list[tuple] = []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if source is None:
                continue
            layout = Layout(source, _defined_as_other)
            paths, page = layout.paths(), layout.signature()
            for parent, children in enumerate(layout.children):
                for place, k in enumerate(children):
                    rows.append((host, paths[k], paths[parent], layout.depths[k], place, None, 0, 0, page))
            for b in layout.blocks:
                if not b.hidden:
                    g = b.group
                    parent = paths[layout.parents[g]] if g else 0
                    rows.append((host, paths[g], parent, layout.depths[g], 0, text_hash(b.text), len(b.text), b.links, page))
        if rows:
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _content_slot(nodes: dict[int, tuple[int, int, int]]) -> int | None:
    """The wrapper's node that holds the content.

    ``nodes``: path -> (parent, depth, varying unlinked characters of its own blocks).
    """
    children: dict[int, list[int]] = {}
    for path, (parent, _, _) in nodes.items():
        children.setdefault(parent, []).append(path)
    below = {path: own for path, (_, _, own) in nodes.items()}
    for path in sorted(nodes, key=lambda p: -nodes[p][1]):
        parent = nodes[path][0]
        if parent in below:
            below[parent] += below[path]
    roots = [p for p, (parent, _, _) in nodes.items() if parent not in nodes]
    at = max(roots, key=lambda p: (below[p], -p), default=None)
    while at is not None:
        # Only children that hold blocks in elements of their own can be slots; single elements are their items.
        inner = [c for c in children.get(at, ()) if any(below[g] for g in children.get(c, ()))]
        best = max(inner, key=lambda p: (below[p], -p), default=None)
        if best is None or not below[best] or 2 * below[best] < sum(below[c] for c in inner):
            return at
        at = best
    return None


def _wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From each host's counted nodes, its wrapper with the content slot marked."""
    kinds = [("path", pa.int64()), ("parent", pa.int64()), ("place", pa.int32()), ("content", pa.bool_()), ("other", pa.bool_())]
    schema = pa.schema([("host", pa.string()), ("pages", pa.int64()), ("nodes", pa.list_(pa.struct(kinds)))])
    for batch in batches:
        out: list[tuple] = []
        for host, pages, nodes in zip(*(batch.column(k).to_pylist() for k in range(3))):
            found = {n["path"]: (n["parent"], n["depth"], n["varying"]) for n in nodes or ()}
            slot = _content_slot(found)
            inside = set()
            for path in sorted(found, key=lambda p: found[p][1]):
                if path == slot or found[path][0] in inside:
                    inside.add(path)
            out.append((host, pages, [{k: n.get(k, n["path"] in inside) for k, _ in kinds} for n in nodes or ()]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def wrappers(pages: DataFrame) -> DataFrame:
    """One row per host with several different pages: its wrapper, from ``host`` and ``html`` of all of them."""
    found = staged(pages.select("host", "html").mapInArrow(_evidence, EVIDENCE))
    counts = staged(found.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where("pages > 1"))
    enough = F.col("n") >= F.greatest(F.lit(2), F.ceil(F.col("pages") * F.lit(SHARE)))
    by_text = (
        found.where("text IS NOT NULL")
        .groupBy("host", "path", "text", "page")
        .agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"))
        .groupBy("host", "path", "text")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    )
    constant = F.sum(F.when(enough, F.col("chars")).otherwise(0)) >= CONSTANT * F.sum("chars")
    volumes = (
        by_text.join(counts, "host")
        .groupBy("host", "path")
        .agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"), constant.alias("constant"))
        .select(
            "host",
            "path",
            F.when(F.col("constant"), 0).otherwise(F.col("chars") - F.col("links")).alias("varying"),
            (F.col("constant") | (F.col("links") > LINKED * F.col("chars"))).alias("other"),
        )
    )
    by_node = (
        found.where("text IS NULL")
        .groupBy("host", "path", "parent", "depth", "page")
        .agg(F.min("place").alias("place"))
        .groupBy("host", "path", "parent", "depth")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("place").alias("place"))
        .join(counts, "host")
        .where(enough)
    )
    order = F.row_number().over(Window.partitionBy("host", "parent").orderBy("place", "path")).alias("place")
    nodes = (
        by_node.select("host", "path", "parent", "depth", order)
        .join(volumes, ["host", "path"], "left")
        .groupBy("host")
        .agg(
            F.collect_list(
                F.struct(
                    "path",
                    "parent",
                    "depth",
                    "place",
                    F.coalesce("varying", F.lit(0)).alias("varying"),
                    F.coalesce("other", F.lit(False)).alias("other"),
                )
            ).alias("nodes")
        )
    )
    joined = counts.join(nodes, "host", "left").select("host", "pages", "nodes")
    return staged(joined.mapInArrow(_wrap, WRAPPER))


class Wrapper:
    """A host's wrapper, ready to align pages with."""

    def __init__(self, nodes: list[dict]):
        self.nodes = {n["path"]: (n["parent"], n["place"]) for n in nodes}
        self.content = {n["path"] for n in nodes if n["content"]}
        self.other = {n["path"] for n in nodes if n["other"]}

    def text(self, source: str) -> str:
        """The page's blocks in the content slot, a line each."""
        layout = Layout(source, _defined_as_other)
        paths = layout.paths()
        aligned = matched(layout, paths, self.nodes)
        lowest: list[int] = []  # of each group, the lowest matched group above or at it
        for k, parent in enumerate(layout.parents):
            lowest.append(k if k in aligned else lowest[parent])
        return "\n".join(
            b.text
            for b in layout.blocks
            if not b.hidden
            and paths[lowest[b.group]] in self.content
            and paths[b.group] not in self.other
        )


def text_by_names(source: str) -> str:
    """The blocks of a page that stands alone: by its elements' names."""
    layout = Layout(source, _named_as_other)
    inside: list[bool] = []
    for kind, parent in zip(layout.kinds, layout.parents):
        inside.append((parent >= 0 and inside[parent]) or kind.startswith(_SLOT))
    shown = [b for b in layout.blocks if not b.hidden]
    slot = [b for b in shown if inside[b.group]]
    return "\n".join(b.text for b in slot or shown)


def main_text(source: str, wrapper: Wrapper | None) -> str:
    """A page's content, a block a line; ``wrapper`` is None where the host has no other page."""
    return (wrapper.text(source) if wrapper else "") or text_by_names(source)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Wrapper | None] = {}
    for batch in batches:
        texts = []
        for row, (host, source) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            if host not in held:
                if len(held) > 500:
                    held.clear()
                nodes = batch.column(4)[row].as_py()
                held[host] = Wrapper(nodes) if nodes else None
            texts.append(main_text(source or "", held[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every page."""
    bounded_batches(pages.sparkSession)
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.lower(F.regexp_extract("url", r"^[^:/?#]*:?//([^/?#]*)", 1)), F.lit("")).alias("host"),
        F.col("html").alias("html"),
    )
    known = wrappers(own).select(F.col("host").alias("of"), "nodes")
    met = own.join(known, F.col("host") == F.col("of"), "left")
    texts = met.select("page_id", "url", "host", "html", "nodes").mapInArrow(_extract, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
