"""Hard negatives: score windows over STR-packed R-trees.

For every anchor the best rows of its own label are its positives; for every positive the
best rows of other labels within a window of scores round the positive's are its hard
negatives. Scores are integer inner products of floor(scale * x).

- Rows are dealt by ranges of (width, label, first component, hash of the id), the first
  sort of the packing; equal rows are split by the hash. Each task packs its rows into
  shards of bounded size by sort-tile-recursive order: sorted by a coordinate, cut into
  slabs, each slab sorted by its next coordinate and so on, down to pages. Pages and their
  parents carry minimum bounding boxes and label ranges. The trees are built once and
  written; anchors are packed into blocks the same way.
- A box [lo, hi] bounds the inner product with q coordinate by coordinate: between
  min(q lo, q hi) and max(q lo, q hi), summed over coordinates.
- Blocks of anchors meet shards only where the boxes of both can reach a window and the
  labels allow it; this is settled on boxes alone, before any vector moves.
- Within a shard a queue takes the node with the greatest bound first. A node is left out
  for an anchor once its interval misses the window or lies strictly below the kth score.

All sums are exact (see ``integers``): any finite component is scored.

NULL labels, vectors, ids and NULL or non-finite components: the row takes no part. Rows
of another width than the anchor's are no candidates. A row with the anchor's own id is
neither its positive nor its negative; repeated rows of an anchor's id each ask for
themselves. Repeated rows of another id are several candidates, side by side. Fewer
candidates give fewer rows; an empty table none. Scores beyond 64 bits are ranked
exactly and given as the nearest 64-bit value. Other columns are not read.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrier.llm.integers import approximate, clamp, dump, finite, floors, largest, load, sortable, unsorted, working
from terrier.session import cut_lineage

PAGE, FAN = 64, 8


def str_order(matrix: np.ndarray, labels: np.ndarray, page: int = PAGE) -> np.ndarray:
    """Rows in sort-tile-recursive order; the label is the first coordinate, then the widest spreads."""
    out: list[np.ndarray] = []
    todo = [(np.arange(len(matrix)), True)]
    spread = approximate(matrix)
    while todo:
        rows, by_label = todo.pop()
        pages = -(-len(rows) // page)
        if pages <= 1:
            out.append(rows)
            continue
        if by_label and labels[rows].min() != labels[rows].max():
            order = rows[np.argsort(labels[rows], kind="stable")]
            cuts = np.flatnonzero(np.diff(labels[order])) + 1
            small, kept = 0, []
            for c in [*cuts.tolist(), len(order)]:     # labels with less than a page stay together
                if c - small >= page:
                    kept.append(c)
                    small = c
            slabs = np.split(order, kept[:-1] if kept and kept[-1] == len(order) else kept)
            todo += [(s, False) for s in reversed(slabs) if len(s)]
            continue
        axis = int(np.argmax(np.ptp(spread[rows], axis=0))) if matrix.shape[1] else 0
        order = rows[np.argsort(spread[rows, axis], kind="stable")] if matrix.shape[1] else rows
        slabs = max(2, round(pages ** (1 / max(1, np.log(pages) / np.log(4)))))
        width = -(-pages // slabs) * page              # whole pages a slab
        todo += [(order[k: k + width], False) for k in reversed(range(0, len(order), width))]
    return np.concatenate(out)


class RTree:
    """Pages of consecutive rows and their parents, each with its box and label range."""

    def __init__(self, matrix: np.ndarray, labels: np.ndarray, page: int = PAGE, fan: int = FAN):
        start = np.arange(0, len(matrix), page)
        lo, hi = np.minimum.reduceat(matrix, start, axis=0), np.maximum.reduceat(matrix, start, axis=0)
        first, last = np.minimum.reduceat(labels, start), np.maximum.reduceat(labels, start)
        self.pages = len(start)
        levels = [(lo, hi, first, last, start, np.minimum(start + page, len(matrix)))]
        base = 0
        while len(levels[-1][0]) > 1:
            lo, hi, first, last = levels[-1][:4]
            start = np.arange(0, len(lo), fan)
            ends = np.minimum(start + fan, len(lo))
            levels.append((np.minimum.reduceat(lo, start, axis=0), np.maximum.reduceat(hi, start, axis=0),
                           np.minimum.reduceat(first, start), np.maximum.reduceat(last, start), start + base, ends + base))
            base += len(lo)
        self.lo, self.hi, self.first, self.last, self.start, self.end = (np.concatenate(x) for x in zip(*levels))
        self.root = len(self.lo) - 1


def _first_k(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of every row: greater scores first, then smaller ids."""
    if scores.dtype == object:
        order = np.array([sorted(range(scores.shape[1]), key=lambda j: (-s[j], i[j]))[:k] for s, i in zip(scores, ids)])
    else:
        order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def search(
    tree: RTree, matrix: np.ndarray, ids: np.ndarray, labels: np.ndarray, asked: np.ndarray, own: np.ndarray,
    own_label: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores and ids of the k best rows in each window of each anchor, and how many pages were scored.

    ``low`` and ``high`` have a row per anchor and a column per window, borders included;
    an empty window has low above high. Rows of the anchor's label answer if ``same``,
    all others if not. Unused places have the score -inf.
    """
    q, m, lo, hi = working(asked, matrix, tree.lo, tree.hi, factor=2)
    kind = q.dtype
    none = -np.inf
    tops = np.full((*low.shape, k), none, kind)
    whose = np.full((*low.shape, k), np.iinfo(np.int64).max)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    if kind != object:                             # borders beyond exact doubles lie beyond all scores here
        low, high = (np.clip(approximate(x), -(2.0**60), 2.0**60) for x in (low, high))
    visited = 0

    def able(live, nodes):
        """Bounds of anchors and nodes, and which of them may hold an answer."""
        upper = plus[live] @ hi[nodes].T + minus[live] @ lo[nodes].T
        lower = plus[live] @ lo[nodes].T + minus[live] @ hi[nodes].T
        inside = (tree.first[nodes][None] <= own_label[live][:, None]) & (own_label[live][:, None] <= tree.last[nodes][None])
        alone = inside & (tree.first[nodes] == tree.last[nodes])[None]
        fits = inside if same else ~alone
        kth = tops[live, :, -1]
        window = np.zeros(upper.shape, bool)
        for w in range(low.shape[1]):
            border = np.maximum(low[live, w], kth[:, w])[:, None]
            window |= (upper >= border) & (lower <= high[live, w][:, None]) & (high[live, w][:, None] >= border)
        return upper, fits & window

    queue: list = []
    count = 0

    def push(live, nodes):
        nonlocal count
        if len(live):
            upper, good = able(live, nodes)
            for j, node in enumerate(nodes):
                rows = np.flatnonzero(good[:, j])
                if len(rows):
                    count += 1
                    heapq.heappush(queue, (-upper[rows, j].max(), count, node, live[rows]))

    push(np.arange(len(asked)), np.array([tree.root]))
    while queue:
        _, _, node, live = heapq.heappop(queue)
        if node >= tree.pages:
            push(live, np.arange(tree.start[node], tree.end[node]))
            continue
        live = live[able(live, np.array([node]))[1][:, 0]]     # the kth scores have risen since
        if not len(live):
            continue
        visited += 1
        rows = slice(tree.start[node], tree.end[node])
        scores = q[live] @ m[rows].T
        good = (labels[rows][None] == own_label[live][:, None]) == same
        good &= ids[rows][None] != own[live][:, None]
        for w in range(low.shape[1]):
            here = good & (scores >= low[live, w][:, None]) & (scores <= high[live, w][:, None]) & (scores >= tops[live, w, -1][:, None])
            hit = np.flatnonzero(here.any(1))
            if len(hit):
                at = live[hit]
                found = np.where(here[hit], scores[hit], none)
                names = np.broadcast_to(ids[rows], found.shape)
                tops[at, w], whose[at, w] = _first_k(
                    np.concatenate([tops[at, w], found], axis=1), np.concatenate([whose[at, w], names], axis=1), k)
    return tops, whose, visited


# --- packing ------------------------------------------------------------------------------

PACKED = "part long, width int, first long, last long, lo binary, hi binary, ids binary, labels binary, m binary, tree binary"


def packed(rows: DataFrame, size: int, scale: int, label: str) -> DataFrame:
    """Shards of at most ``size`` rows with their R-trees; see the module's docstring."""
    wide = rows.withColumns({"width": F.size("v"), "x": F.get("v", F.lit(0)), "h": F.xxhash64("vec_id")})
    parts = max(1, -(-rows.count() // size))
    dealt = wide.repartitionByRange(parts, "width", "label", "x", "h").sortWithinPartitions("width", "label", "x", "vec_id", "v")

    def build(batches):
        made, waiting, held = 0, [], 0

        def close():
            nonlocal made, waiting, held
            kind = object if any(w[2].dtype == object for w in waiting) else np.int64
            ids, labels = (np.concatenate([w[c] for w in waiting]) for c in (0, 1))
            matrix = np.concatenate([w[2].astype(kind) for w in waiting])
            order = str_order(matrix, labels)
            ids, labels, matrix = ids[order], labels[order], matrix[order]
            tree = RTree(matrix, labels)
            part = (TaskContext.get().partitionId() << 32) + made
            made, waiting, held = made + 1, [], 0
            row = (part, matrix.shape[1], int(labels.min()), int(labels.max()), dump(tree.lo[tree.root]), dump(tree.hi[tree.root]),
                   ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), dump(matrix), pickle.dumps(tree))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=[c.split()[0] for c in PACKED.split(", ")])

        for batch in batches:
            ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            lists, widths = batch.column("v"), batch.column("width").to_numpy()
            at = 0
            while at < len(batch):
                width = int(widths[at])
                most = max(PAGE, min(size, (1 << 20) // max(1, width)))
                if waiting and (held >= most or waiting[0][2].shape[1] != width):
                    yield close()
                same = np.flatnonzero(widths[at:] != width)
                n = min(most - held, int(same[0]) if len(same) else len(batch) - at)
                waiting.append((ids[at: at + n], labels[at: at + n], floors(lists.slice(at, n), width, scale)))
                at, held = at + n, held + n
        if waiting:
            yield close()

    return cut_lineage(dealt.select("vec_id", "label", "width", "v").mapInArrow(build, PACKED), label)


# --- which blocks meet which shards --------------------------------------------------------

def _reach(a: dict, b: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products between the boxes of two lists of boxes, rounded outwards."""
    corners = [x[:, None] * y[None] for x in (a["lo"], a["hi"]) for y in (b["lo"], b["hi"])]
    upper, lower = np.maximum.reduce(corners).sum(2), np.minimum.reduce(corners).sum(2)
    slack = 1e-9 * np.maximum.reduce([np.abs(c) for c in corners]).sum(2) + 1
    return upper + slack, lower - slack


def pairs(blocks: DataFrame, shards: DataFrame, same: bool, window, group: int = 128) -> DataFrame:
    """(block, part) for every block of anchors and shard whose boxes can meet.

    ``blocks`` has the least and greatest of its positives' scores in ``least`` and
    ``most`` (sortable bytes; NULL: no window). Boxes travel in groups of ``group``; every
    group of blocks meets every group of shards once, and only pairs that pass leave the
    task.
    """
    columns = ["part", "width", "first", "last", "lo", "hi"]

    def gather(df: DataFrame, more: list[str], name: str) -> DataFrame:
        def pack(batches):
            made, held = 0, {}

            def close(width):
                nonlocal made
                made += 1
                rows = held.pop(width)
                data = pickle.dumps([tuple(r[c] for c in [*columns, *more]) for r in rows])
                return pa.RecordBatch.from_arrays([
                    pa.array([width], pa.int32()), pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()),
                    pa.array([data], pa.binary())], names=["width", name, f"{name}_boxes"])

            for batch in batches:
                for row in batch.to_pylist():
                    held.setdefault(row["width"], []).append(row)
                    if len(held[row["width"]]) >= group:
                        yield close(row["width"])
            for width in list(held):
                yield close(width)

        return df.select(*columns, *more).mapInArrow(pack, f"width int, {name} long, {name}_boxes binary")

    asked = cut_lineage(gather(blocks, ["least", "most"], "a"), "block-boxes")
    held = gather(shards, [], "b")
    lists = asked.groupBy("width").agg(F.collect_list("a").alias("a"))     # one number per group of blocks
    met = held.join(F.broadcast(lists), "width").withColumn("a", F.explode("a")).join(asked, ["width", "a"])

    def boxes(rows, width):
        table = {c: np.array([r[k] for r in rows]) for k, c in ((0, "part"), (2, "first"), (3, "last"))}
        return table | {c: np.concatenate([approximate(load(r[k], width)) for r in rows]) if width else np.zeros((len(rows), 0)) for k, c in ((4, "lo"), (5, "hi"))}

    def choose(batches):
        for batch in batches:
            for row in batch.to_pylist():
                mine, theirs = (pickle.loads(row[c]) for c in ("a_boxes", "b_boxes"))
                a, b = boxes(mine, row["width"]), boxes(theirs, row["width"])
                with np.errstate(all="ignore"):
                    upper, lower = _reach(a, b)
                    floor = approximate(np.array([-np.inf if r[6] is None else window(unsorted(r[6]))[0] for r in mine], object))
                    roof = approximate(np.array([np.inf if r[7] is None else window(unsorted(r[7]))[1] for r in mine], object))
                    floor, roof = floor - 1 - 1e-9 * np.abs(floor), roof + 1 + 1e-9 * np.abs(roof)
                    miss = (upper < floor[:, None]) | (lower > roof[:, None])  # NaN (beyond doubles) is no miss
                if same:
                    miss |= (a["last"][:, None] < b["first"][None]) | (b["last"][None] < a["first"][:, None])
                else:
                    miss |= (a["first"] == a["last"])[:, None] & (b["first"] == b["last"])[None] & (a["first"][:, None] == b["first"][None])
                i, j = np.nonzero(~miss)
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(a["part"][i], pa.int64()), pa.array(b["part"][j], pa.int64())], names=["block", "part"])

    return met.mapInArrow(choose, "block long, part long")


# --- the two passes ------------------------------------------------------------------------

FOUND = "block long, place int, window int, anchor_id long, asked_id long, asked_score long, vec_id long, score long, key binary"


def _meet(blocks: DataFrame, shards: DataFrame, same: bool, k: int, window) -> DataFrame:
    """The k best rows of every window of every anchor in every shard it can meet.

    ``window`` gives the borders from a positive's score; NULL windows of ``blocks`` mean
    one window without borders.
    """
    chosen = pairs(blocks, shards, same, window)
    left = shards.select("part", "width", "ids", "labels", "m", "tree")
    right = blocks.select(F.col("part").alias("block"), F.col("ids").alias("q_ids"), F.col("labels").alias("q_labels"), F.col("m").alias("q"), "windows")
    joined = chosen.join(right, "block").join(left, "part")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                width = row["width"]
                ids, labels, own, own_label = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels", "q_ids", "q_labels"))
                asked, matrix = (load(row[c], width) if width else np.zeros((len(n), 0), np.int64) for c, n in (("q", own), ("m", ids)))
                goals = [[] for _ in own]
                for w in row["windows"] or []:
                    goals[w["place"]].append(w)
                if row["windows"] is None:
                    goals = [[None]] * len(own)
                count = max([1, *map(len, goals)])
                low, high = np.full((len(own), count), np.inf, object), np.full((len(own), count), -np.inf, object)
                for place, mine in enumerate(goals):
                    for n, goal in enumerate(mine):
                        low[place, n], high[place, n] = (-np.inf, np.inf) if goal is None else window(unsorted(goal["key"]))
                live = np.flatnonzero((low <= high).any(1))
                tops, whose, _ = search(pickle.loads(row["tree"]), matrix, ids, labels, asked[live], own[live], own_label[live], low[live], high[live], k, same)
                out = []
                for i, n, r in np.argwhere(tops > -np.inf).tolist():
                    goal, score = goals[live[i]][n], int(tops[i, n, r])
                    out.append((row["block"], int(live[i]), n, int(own[live[i]]), goal and goal["vec_id"], goal and clamp(unsorted(goal["key"])),
                                int(whose[i, n, r]), clamp(score), sortable(score)))
                if out:
                    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[c.split()[0] for c in FOUND.split(", ")])

    found = joined.mapInArrow(run, FOUND)
    order = Window.partitionBy("block", "place", "window").orderBy(F.col("key").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchors: str = "vec_id % 100 = 0", positives: int = 5, negatives: int = 10,
    lowest: tuple[int, int] = (30, 100), highest: tuple[int, int] = (90, 100), scale: int = 256, size: int = 8192, block: int = 512,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on vec_id. A negative's score lies between the shares
    ``lowest`` and ``highest`` (numerator, denominator) of the positive's, both included;
    a positive below 0 has no negatives. Labels are integers.
    """
    def borders(score: int) -> tuple[int, int]:
        return -(-lowest[0] * score // lowest[1]), highest[0] * score // highest[1]

    good = vectors.where(finite(vectors) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    good = cut_lineage(good, "vectors")
    shards = packed(good, size, scale, "r-trees")
    blocks = packed(good.where(anchors), block, scale, "anchors")
    nothing = F.lit(None).cast("binary")
    open_ = blocks.withColumns({"least": nothing, "most": nothing, "windows": F.lit(None).cast("array<struct<place:int,rank:int,vec_id:long,key:binary>>")})
    best = cut_lineage(_meet(open_, shards, True, positives, borders), "positives")

    # A block's windows: at most ``positives`` for each of its anchors; below 0 there is none.
    goals = best.where(F.col("key") >= F.lit(sortable(0))).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "rank", "vec_id", "key"))).alias("windows"),
        F.min("key").alias("least"), F.max("key").alias("most"))
    found = _meet(blocks.join(goals.withColumnRenamed("block", "part"), "part"), shards, False, negatives, borders)
    return found.select(
        "anchor_id", F.col("asked_id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("asked_score").alias("positive_score"), F.col("score").alias("negative_score"))
