"""Main text of web pages by a minimum cut between blocks of article and boilerplate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.html_blocks import ARTICLE, HEADINGS, OUTSIDE, SILENT, Block, page_blocks, places
from reviewlab.llm.rows import schema_with, text_first

#: Pages that the classifier is fitted on, about, and blocks used of each, evenly spread.
SAMPLE_PAGES, BLOCKS_PER_PAGE = 1_000, 40
LEAST_EXAMPLES = 40
#: Used where the pages name too few places: more words and full stops speak for an article, links against it.
DEFAULT_WEIGHTS = np.array([-2.0, 0.7, -3.0, 1.0, 0.5, -0.5, 0.0, -1.0])
#: Costs in hundredths: the place in the page outweighs the words, words and neighbours decide elsewhere. On a
#: page without a named article a block is kept unless its words speak against it.
UNIT, IN_ARTICLE, OUT_OF_ARTICLE, BOILERPLATE, UNNAMED, MOST_WORDS = 100, 400, -400, -900, 100, 200
ADJACENT, SIBLING = 100, 50


def block_features(blocks: list[Block]) -> np.ndarray:
    """Numbers about the words of each block; the place in the page is not among them."""
    rows = []
    for block in blocks:
        text, n = block.text, len(block.text)
        rows.append((
            1.0, np.log1p(text.count(" ") + 1), min(1.0, block.linked / n), float(text[-1] in ".!?…\"'”»"),
            float(block.element.tag in HEADINGS), float(block.element.tag in ("li", "td", "th", "dt", "dd")),
            min(1.0, text.count(",") * 20 / n), float("©" in text or "·" in text or "»" in text[:2]),
        ))
    return np.array(rows).reshape(len(rows), len(DEFAULT_WEIGHTS))


def fit_blocks(pages: DataFrame, text: str = "html", sample: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights of a logistic classifier of blocks by their words.

    Examples are blocks whose place is named by the markup (an article; a menu, footer or the like), of
    about `sample` pages with the smallest hashes, at most 40 blocks a page. Both classes weigh the same.
    With fewer than 40 examples of either class the default weights are returned.
    """
    share = min(1.0, sample / max(1, pages.count()))
    drawn = pages.where(F.pmod(F.xxhash64(F.lit("blocks"), F.col(text)), F.lit(1 << 30)) < share * (1 << 30))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                blocks = page_blocks(value.as_py() or "")
                named = [(b, p == ARTICLE) for b, p in zip(blocks, places(blocks)) if p != SILENT]
                named = [named[i * len(named) // BLOCKS_PER_PAGE] for i in range(BLOCKS_PER_PAGE)] if len(named) > BLOCKS_PER_PAGE else named
                rows = block_features([b for b, _ in named])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(rows), pa.list_(pa.float64())), pa.array([bool(p) for _, p in named], pa.bool_())],
                    names=["features", "article"],
                )

    # about `sample` x 40 rows of eight numbers, whatever the size of the table
    table = drawn.select(text).mapInArrow(of_batches, "features array<double>, article boolean").toArrow()
    article = table.column("article").to_numpy().astype(float)
    if min(article.sum(), len(article) - article.sum()) < LEAST_EXAMPLES:
        return DEFAULT_WEIGHTS
    return fit_logistic(np.stack(table.column("features").to_numpy()), article)


def fit_logistic(rows: np.ndarray, wanted: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton's method with a quadratic penalty; both classes have the same total weight."""
    weight = np.where(wanted == 1, 0.5 / wanted.mean(), 0.5 / (1 - wanted.mean()))
    found = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ found, -30, 30)))
        slope = rows.T @ (weight * (p - wanted)) + ridge * found
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge * np.eye(len(found))
        step = np.linalg.solve(curve, slope)
        found = found - step
        if np.abs(step).max() < 1e-8:
            break
    return found


def terminal_costs(blocks: list[Block], weights: np.ndarray) -> list[int]:
    """What it costs to leave a block out of the article (positive) or to keep it there (negative)."""
    by_words = np.clip(np.rint(block_features(blocks) @ weights * UNIT), -MOST_WORDS, MOST_WORDS).astype(int).tolist()
    where = list(places(blocks))
    elsewhere = OUT_OF_ARTICLE if ARTICLE in where else UNNAMED
    by_place = {ARTICLE: IN_ARTICLE, OUTSIDE: BOILERPLATE, SILENT: elsewhere}
    # a title that stands before the article may belong to it
    return [
        w + (UNNAMED if p == SILENT and b.element.tag == "h1" else by_place[p]) for w, p, b in zip(by_words, where, blocks)
    ]


def smoothness_edges(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """`(i, j, cost)` of labelling i and j differently: neighbours in the page, the less the farther apart
    they are in the element tree, and next children of one element with other text between them."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            edges.append((i - 1, i, ADJACENT * 2 // (2 + block.near)))
        before = last.get(id(block.parent))
        if before is not None and before < i - 1:
            edges.append((before, i, SIBLING))
        last[id(block.parent)] = i
    return edges


def minimum_cut(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The labelling of least cost: True for the side of the positive terminal, as many as possible.

    Positive and negative costs are capacities from the source and to the sink. Flow is sent along
    shortest ways in phases (a blocking flow per phase) until no way is left; what then cannot reach the
    sink lies on the source's side.
    """
    n, excess = len(costs), list(costs)
    arcs: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for i, j, capacity in edges:
        for a, b in ((i, j), (j, i)):
            arcs[a].append(len(to))
            to.append(b)
            room.append(capacity)
    while True:
        level = [0 if e > 0 else -1 for e in excess]
        frontier, depth, found = [i for i in range(n) if excess[i] > 0], 0, False
        sources = frontier
        while frontier and not found:
            depth, farther = depth + 1, []
            for i in frontier:
                for arc in arcs[i]:
                    j = to[arc]
                    if room[arc] > 0 and level[j] < 0:
                        level[j] = depth
                        farther.append(j)
                        found |= excess[j] < 0
            frontier = farther
        if not found:
            break
        following = [0] * n
        for source in sources:
            _block_flow(source, excess, arcs, to, room, level, following)
    # backwards from the sink along arcs with room
    reaches = [e < 0 for e in excess]
    frontier = [i for i in range(n) if reaches[i]]
    while frontier:
        i = frontier.pop()
        for arc in arcs[i]:
            j = to[arc]
            if room[arc ^ 1] > 0 and not reaches[j]:
                reaches[j] = True
                frontier.append(j)
    return [not r for r in reaches]


def _block_flow(source, excess, arcs, to, room, level, following) -> None:
    """Send what `source` holds along ways of growing level to nodes that take it."""
    way: list[int] = []
    at = source
    while excess[source] > 0:
        if excess[at] < 0 and way:
            amount = min(excess[source], -excess[at], *[room[arc] for arc in way])
            excess[source] -= amount
            excess[at] += amount
            for arc in way:
                room[arc] -= amount
                room[arc ^ 1] += amount
            way, at = [], source
            continue
        while following[at] < len(arcs[at]):
            arc = arcs[at][following[at]]
            if room[arc] > 0 and level[to[arc]] == level[at] + 1:
                break
            following[at] += 1
        else:
            if not way:
                return
            at = to[way.pop() ^ 1]
            following[at] += 1
            continue
        way.append(arc)
        at = to[arc]


def main_text(page: str | None, weights: np.ndarray = DEFAULT_WEIGHTS) -> str:
    """The article's blocks, one a line."""
    blocks = page_blocks(page or "")
    if not blocks:
        return ""
    kept = minimum_cut(terminal_costs(blocks, weights), smoothness_edges(blocks))
    return "\n".join([b.text for b, keep in zip(blocks, kept) if keep])


def extract_main_text(
    pages: DataFrame, weights: np.ndarray | None = None, text: str = "html", carry: list[str] | None = None,
) -> DataFrame:
    """Add `text`, the main text of a page, and `n_chars`, its code points.

    Input columns of these names give way, all others (or only those in `carry`) stay. Null, empty and
    text-free pages have an empty text. Repeated rows get equal results; an empty table gives an empty
    table. Pages are read whole, however long, and nothing moves. `weights` come from `fit_blocks`; by
    default they are learnt from `pages`. Equal costs on both sides keep a block.
    """
    learnt = fit_blocks(pages, text) if weights is None else weights
    carried = [c for c in (pages.columns if carry is None else carry) if c in pages.columns and c not in ("text", "n_chars")]
    schema = schema_with(pages, carried, "text string, n_chars long")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(v.as_py(), learnt) for v in batch.column(0)]
            columns = [*batch.columns[1:], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return text_first(pages, text, carried).mapInArrow(of_batches, schema)
