"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. A linear classifier gives each block the log
odds of being content, from its length, its share of links, its tag and what the
elements around it say of themselves. The labels of all blocks are chosen
together, as the least cut of a graph:

* the source is content, the sink boilerplate; a block has an edge from the
  source with its log odds as capacity if they are positive, else one to the sink;
* neighbouring blocks are joined by smoothness edges, and so is each block with
  the next one under the same parent; the capacity falls with the distance of the
  two in the element tree. What cuts them apart pays it.

Blocks on the source's side of the cut are the main text. Pages are worked on one
by one where they lie; nothing is shuffled.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.html_blocks import BAD, GOOD, Block, Tree, blocks
from tidemark.llm.tables import ID, REST, TEXT, identified, other_columns

#: Smoothness of blocks under one parent; a step in the tree divides it.
SMOOTH = 1.0
_HEADINGS = frozenset("h2 h3 h4 h5 h6".split())
_CLOSING = (".", "!", "?", "…", ":", '"', "”", "»", "。")
_LEGAL = ("©", "copyright", "all rights reserved")


def log_odds(block: Block, text: str) -> float:
    """Classifier: the log odds that a block is content."""
    words = text.count(" ") + 1
    odds = -1.0 + 2.5 * min(words, 30) / 30
    odds -= 4.0 * block.linked / block.chars
    if text.endswith(_CLOSING):
        odds += 0.5
    if block.tag == "h1":
        odds += 1.5
    elif block.tag in _HEADINGS:
        odds += 0.7
    elif block.tag in ("p", "pre", "blockquote"):
        odds += 0.7
    if block.context == GOOD:
        odds += 3.5
    elif block.context == BAD:
        odds -= 8.0
    if text.lower().startswith(_LEGAL):
        odds -= 3.0
    return odds


def smoothness(nodes: list[int], tree: Tree, smooth: float = SMOOTH) -> list[tuple[int, int, float]]:
    """Edges between neighbours in the page, and between neighbours under one parent."""
    edges = []
    last: dict[int, int] = {}
    for at, node in enumerate(nodes):
        near = {at - 1} if at else set()
        parent = tree.parent[node] if node else -1
        if parent in last:
            near.add(last[parent])
        last[parent] = at
        for other in near:
            edges.append((other, at, smooth * 2 / (1 + tree.distance(nodes[other], node))))
    return edges


def least_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the source's side of a least cut.

    Positive odds are capacities from the source, negative ones to the sink.
    Blocking flows over shortest residual paths (Dinic); ties go to the sink.
    """
    count = len(odds)
    source, sink = count, count + 1
    heads: list[list[int]] = [[] for _ in range(count + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(forth)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for at, value in enumerate(odds):
        if value > 0:
            join(source, at, value, 0.0)
        elif value < 0:
            join(at, sink, -value, 0.0)
    for a, b, capacity in edges:
        join(a, b, capacity, capacity)
    least = 1e-9
    while True:
        level = [-1] * (count + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for edge in heads[node]:
                if room[edge] > least and level[to[edge]] < 0:
                    level[to[edge]] = level[node] + 1
                    queue.append(to[edge])
        if level[sink] < 0:
            return [level[at] >= 0 for at in range(count)]
        turn = [0] * (count + 2)
        way: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[edge] for edge in way)
                for edge in way:
                    room[edge] -= flow
                    room[edge ^ 1] += flow
                first = next(at for at, edge in enumerate(way) if room[edge] <= least)
                node = to[way[first] ^ 1]
                del way[first:]
                continue
            while turn[node] < len(heads[node]):
                edge = heads[node][turn[node]]
                if room[edge] > least and level[to[edge]] == level[node] + 1:
                    break
                turn[node] += 1
            if turn[node] < len(heads[node]):
                way.append(edge)
                node = to[edge]
            elif way:
                edge = way.pop()
                node = to[edge ^ 1]
                turn[node] += 1
            else:
                break


def main_text(page: str | None, smooth: float = SMOOTH) -> str:
    """The content blocks of a page, joined by newlines; empty if there are none."""
    made, tree = blocks(page or "")
    found = [(block, text) for block in made if (text := block.text())]
    if not found:
        return ""
    odds = [log_odds(block, text) for block, text in found]
    if min(odds) > 0:
        kept = [True] * len(found)
    else:
        kept = least_cut(odds, smoothness([block.node for block, _ in found], tree, smooth))
    return "\n".join(text for (_, text), keep in zip(found, kept, strict=True) if keep)


def _extract(smooth: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), smooth) for page in batch.column(TEXT)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ID), batch.column(REST), pa.array(texts, pa.string())], names=[ID, REST, "text"]
            )

    return run


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", smooth: float = SMOOTH) -> DataFrame:
    """Id, ``text`` and the other columns of every page, the HTML left out.

    Null and empty pages have an empty text. A column named ``text`` is replaced.
    """
    rows = identified(pages, id_col, html_col)
    schema = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in (ID, REST))
    found = rows.select(ID, TEXT, REST).mapInArrow(_extract(smooth), f"{schema}, text string")
    return found.select(F.col(ID).alias(id_col), "text", *other_columns(found, {id_col, "text"}))
