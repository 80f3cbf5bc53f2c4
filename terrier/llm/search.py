"""Exact top-k search by inner product: a ball tree per shard, branch and bound.

- Rows are dealt by ranges of (width, first component, hash of the id); equal rows are split
  by the hash. Each task cuts what it holds in the widest direction, at the widest gap, until
  shards have a bounded size, so a shard's rows lie together. A shard's ball tree is built
  once and written with it. Queries are packed into blocks the same way.
- A node with centre c and radius r bounds the inner product of q by q.c + |q| r, two balls
  (a, s) and (c, r) by a.c + |a| r + |c| s + s r. Bounds are rounded outwards.
- Every block of queries first looks into the shard of its greatest bound; the kth scores it
  finds there are shared with all others. A block then meets only the shards whose bound
  reaches its least kth score; this is settled on balls alone, before any vector moves.
- Within a shard a queue takes the node with the greatest bound first. A node is left out
  for a query once its bound is below the query's kth score so far, inner nodes with all
  below them.

Every true answer is in a shard that is met, so the k best of all are the exact answer. All
sums are exact (see ``integers``): any finite component is scored.
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
from terrier.llm.negatives import _first_k
from terrier.session import cut_lineage

LEAF = 128
#: Beyond this size of a component squares leave the range of doubles, and nothing is left out.
FAR = 1 << 480


def cut(x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``rows`` cut in the direction in which they lie furthest apart.

    The cut is the widest gap of the middle half, so that clusters stay whole, or the
    median where there is none.
    """
    middle = len(rows) // 2
    if x.shape[1]:
        axis = int(np.argmax(np.ptp(x[rows], axis=0)))
        rows = rows[np.argsort(x[rows, axis], kind="stable")]
        first = max(1, len(rows) // 4)
        gaps = np.diff(x[rows, axis])[first - 1: len(rows) - first]
        if len(gaps) and gaps.max() > 0:
            middle = first + int(np.argmax(gaps))
    return rows[:middle], rows[middle:]


class BallTree:
    """Nodes with centre, radius and a range of ``order``; ``child`` is the first of two, 0 at leaves."""

    def __init__(self, matrix: np.ndarray, leaf: int = LEAF):
        self.far = largest(matrix) > FAR
        x = approximate(matrix)
        self.order = np.arange(len(matrix))
        spans, child, centres, radii = [(0, len(matrix))], [], [], []
        for at, (start, end) in enumerate(spans):           # grows as it goes
            rows = self.order[start:end]
            centre = np.zeros(x.shape[1]) if self.far else x[rows].mean(0)
            centres.append(centre)
            radii.append(0.0 if self.far else float(np.sqrt(((x[rows] - centre) ** 2).sum(1).max())))
            child.append(0)
            if len(rows) > leaf:
                low, high = cut(x, rows)
                self.order[start:end] = np.concatenate([low, high])
                child[at] = len(spans)
                spans += [(start, start + len(low)), (start + len(low), end)]
        self.centres, self.radii = np.array(centres).reshape(len(spans), x.shape[1]), np.array(radii)
        self.child, self.spans = np.array(child), spans


def reach(a: np.ndarray, s: np.ndarray, c: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products between two lists of balls, rounded outwards."""
    one, two = np.sqrt((a**2).sum(1))[:, None], np.sqrt((c**2).sum(1))[None]
    s, r = s[:, None], r[None]
    size = (one + s) * (two + r)
    return a @ c.T + one * r + two * s + s * r + 1e-9 * size + 1


def best(
    tree: BallTree, matrix: np.ndarray, ids: np.ndarray, asked: np.ndarray, own: np.ndarray, kth: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores and ids of each query's k best rows that reach ``kth``, and how many leaves were scored.

    ``matrix`` and ``ids`` are in the tree's order; ``kth`` holds integers or -inf. A row
    with a query's own id takes no part. Unused places have the score -inf.
    """
    q, m = working(asked, matrix)
    kind = q.dtype
    tops = np.full((len(asked), k), -np.inf, kind)
    whose = np.full((len(asked), k), np.iinfo(np.int64).max)
    kth = kth.copy() if kind == object else np.clip(approximate(kth), -(2.0**60), 2.0**60)
    far = tree.far or largest(asked) > FAR
    x, visited, count, queue = approximate(asked), 0, 0, []

    def push(live, node):
        nonlocal count
        upper = np.full(len(live), np.inf) if far else reach(x[live], np.zeros(len(live)), tree.centres[node:node + 1], tree.radii[node:node + 1])[:, 0]
        able = np.flatnonzero(upper >= kth[live])
        if len(able):
            count += 1
            heapq.heappush(queue, (-upper[able].max(), count, node, live[able], upper[able]))

    if len(asked) and len(matrix):
        push(np.arange(len(asked)), 0)
    while queue:
        _, _, node, live, upper = heapq.heappop(queue)
        live = live[np.flatnonzero(upper >= kth[live])]         # the kth scores have risen since
        if not len(live):
            continue
        if tree.child[node]:
            push(live, tree.child[node])
            push(live, tree.child[node] + 1)
            continue
        visited += 1
        rows = slice(*tree.spans[node])
        scores = q[live] @ m[rows].T
        good = (scores >= kth[live][:, None]) & (ids[rows][None] != own[live][:, None])
        hit = np.flatnonzero(good.any(1))
        if len(hit):
            at = live[hit]
            found = np.where(good[hit], scores[hit], -np.inf)
            names = np.where(good[hit], ids[rows][None], np.iinfo(np.int64).max)
            tops[at], whose[at] = _first_k(np.concatenate([tops[at], found], axis=1), np.concatenate([whose[at], names], axis=1), k)
            kth[at] = np.maximum(kth[at], tops[at, -1])
    return tops, whose, visited


PACKED = "part long, width int, centre binary, radius double, far boolean, ids binary, m binary, tree binary"
_PACKED = [pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.bool_(), *[pa.binary()] * 3]
#: Shards that a task cuts from what it holds at a time, and the most components it holds.
TOGETHER, HELD = 4, 1 << 22


def _batch(rows: list[tuple], schema: str, types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in schema.split(", ")])


def packed(rows: DataFrame, size: int, scale: int, label: str) -> DataFrame:
    """Shards of at most ``size`` rows with their ball trees; see the module's docstring."""
    wide = rows.withColumns({"width": F.size("v"), "x": F.get("v", F.lit(0)), "h": F.xxhash64("vec_id")})
    parts = max(1, -(-rows.count() // (TOGETHER * size)))
    dealt = wide.repartitionByRange(parts, "width", "x", "h").sortWithinPartitions("width", "x", "vec_id")

    def build(batches):
        made, waiting, held = 0, [], 0

        def close():
            nonlocal made, waiting, held
            kind = object if any(w[1].dtype == object for w in waiting) else np.int64
            every, whole = np.concatenate([w[0] for w in waiting]), np.concatenate([w[1].astype(kind) for w in waiting])
            waiting, held = [], 0
            x, todo = approximate(whole), [np.arange(len(whole))]
            while todo:
                mine = todo.pop()
                if len(mine) > size:
                    todo += cut(x, mine)
                    continue
                tree = BallTree(whole[mine])
                mine = mine[tree.order]
                part, made = (TaskContext.get().partitionId() << 32) + made, made + 1
                tree.order = None
                yield _batch([(part, whole.shape[1], tree.centres[0].astype("<f8").tobytes(), float(tree.radii[0]), tree.far,
                               every[mine].astype("<i8").tobytes(), dump(whole[mine]), pickle.dumps(tree))], PACKED, _PACKED)

        for batch in batches:
            ids, lists, widths = batch.column("vec_id").to_numpy(), batch.column("v"), batch.column("width").to_numpy()
            at = 0
            while at < len(batch):
                width = int(widths[at])
                most = max(LEAF, min(TOGETHER * size, HELD // max(1, width)))
                if waiting and (held >= most or waiting[0][1].shape[1] != width):
                    yield from close()
                other = np.flatnonzero(widths[at:] != width)
                n = min(most - held, int(other[0]) if len(other) else len(batch) - at)
                waiting.append((ids[at: at + n], floors(lists.slice(at, n), width, scale)))
                at, held = at + n, held + n
        if waiting:
            yield from close()

    return cut_lineage(dealt.select("vec_id", "width", "v").mapInArrow(build, PACKED), label)


def _grouped(df: DataFrame, name: str, group: int) -> DataFrame:
    """The balls of ``df`` in groups of ``group`` of one width."""
    columns = [c for c in ("part", "centre", "radius", "far", "least") if c in df.columns]

    def pack(batches):
        made, held = 0, {}

        def close(width):
            nonlocal made
            made += 1
            return _batch([(width, (TaskContext.get().partitionId() << 32) + made, pickle.dumps(held.pop(width)))],
                          f"width int, {name} long, {name}_balls binary", [pa.int32(), pa.int64(), pa.binary()])

        for batch in batches:
            for row in batch.to_pylist():
                width = row.pop("width")
                held.setdefault(width, []).append(row)
                if len(held[width]) >= group:
                    yield close(width)
        for width in list(held):
            yield close(width)

    return df.select("width", *columns).mapInArrow(pack, f"width int, {name} long, {name}_balls binary")


def pairs(blocks: DataFrame, shards: DataFrame, group: int = 128) -> DataFrame:
    """block and part of every block of queries and shard of which it may need a row.

    With a column ``least`` (sortable bytes; NULL: none) of ``blocks``: those whose bound
    reaches it. Without: one shard a block, that of the greatest bound. Balls travel in
    groups of ``group``, and only what passes leaves a task.
    """
    known = "least" in blocks.columns
    asked = cut_lineage(_grouped(blocks, "a", group), "block-balls")
    lists = asked.groupBy("width").agg(F.collect_list("a").alias("a"))     # one number per group of blocks
    met = _grouped(shards, "b", group).join(lists, "width").withColumn("a", F.explode("a")).join(asked, ["width", "a"])

    def choose(batches):
        for batch in batches:
            for row in batch.to_pylist():
                mine, theirs = pickle.loads(row["a_balls"]), pickle.loads(row["b_balls"])
                (a, s, one), (c, r, two) = ((np.array([np.frombuffer(x["centre"], "<f8") for x in side]).reshape(len(side), -1),
                                            np.array([x["radius"] for x in side]), np.array([x["far"] for x in side])) for side in (mine, theirs))
                upper = np.where(one[:, None] | two[None], np.inf, reach(a, s, c, r))
                if known:
                    floor = approximate(np.array([-np.inf if x["least"] is None else unsorted(x["least"]) for x in mine], object))
                    i, j = np.nonzero(upper >= (floor - 1 - 1e-9 * np.abs(np.where(np.isinf(floor), 0, floor)))[:, None])
                else:
                    i, j = np.arange(len(mine)), upper.argmax(1)
                if len(i):
                    rows = [(mine[x]["part"], theirs[y]["part"], float(upper[x, y])) for x, y in zip(i.tolist(), j.tolist())]
                    yield _batch(rows, "block, part, bound", [pa.int64(), pa.int64(), pa.float64()])

    chosen = met.mapInArrow(choose, "block long, part long, bound double")
    if known:
        return chosen.select("block", "part")
    return chosen.groupBy("block").agg(F.max_by("part", F.struct("bound", "part")).alias("part"))


FOUND = "block long, place int, query_id long, vec_id long, score long, key binary"
_FOUND = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _meet(chosen: DataFrame, blocks: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """The k best rows of every chosen shard for every query of its block; ``kth`` has known scores."""
    right = blocks.select(F.col("part").alias("block"), F.col("ids").alias("q_ids"), F.col("m").alias("q"), "kth")
    joined = chosen.join(right, "block").join(shards.select("part", "width", "ids", "m", "tree"), "part")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, own = (np.frombuffer(row[c], "<i8") for c in ("ids", "q_ids"))
                asked, matrix = (load(row[c], row["width"]) if row["width"] else np.zeros((len(n), 0), np.int64) for c, n in (("q", own), ("m", ids)))
                kth = np.full(len(own), -np.inf, object)
                for known in row["kth"] or []:
                    kth[known["place"]] = unsorted(known["key"])
                tops, whose, _ = best(pickle.loads(row["tree"]), matrix, ids, asked, own, kth, k)
                rows = [(row["block"], i, int(own[i]), int(whose[i, r]), clamp(tops[i, r]), sortable(tops[i, r])) for i, r in np.argwhere(tops > -np.inf).tolist()]
                if rows:
                    yield _batch(rows, FOUND, _FOUND)

    return joined.mapInArrow(run, FOUND)


def top_k(vectors: DataFrame, query: str = "vec_id % 50 = 0", k: int = 5, shard: int = 8192, block: int = 2048, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows by integer inner product.

    ``query`` is a condition on vec_id. Ties go to the smaller vec_id; a row with the
    query's own id is no answer; repeated rows of one id are several answers. Vectors of
    another width than the query's take no part; vectors with NULL or non-finite parts
    neither ask nor answer. Fewer rows than k give fewer answers, an empty table none.
    Scores beyond 64 bits are ranked exactly and given as the nearest 64-bit value. Extra
    columns are not read.

    Shards and query blocks have bounded sizes. Only k rows per query and met shard are
    shuffled.
    """
    good = vectors.where(finite(vectors) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    good = cut_lineage(good, "vectors")
    shards = packed(good, shard, scale, "ball-trees")
    asked = packed(good.where(query), block, scale, "queries")

    nothing = F.lit(None).cast("array<struct<place:int,key:binary>>")
    seeds = cut_lineage(pairs(asked, shards), "seed-pairs")
    first = cut_lineage(_meet(seeds, asked.withColumn("kth", nothing), shards, k), "seeds")
    # A block's kth scores: one for each of its queries that has k answers already.
    full = first.groupBy("block", "place").agg(F.count("*").alias("n"), F.min("key").alias("key")).where(F.col("n") >= k)
    known = full.groupBy("block").agg(F.collect_list(F.struct("place", "key")).alias("kth"), F.min("key").alias("least"), F.count("*").alias("n"))
    asked = asked.join(known.withColumnRenamed("block", "part"), "part", "left").withColumn(
        "least", F.when(F.col("n") == F.octet_length("ids") / 8, F.col("least"))).drop("n")
    asked = cut_lineage(asked, "queries")
    others = pairs(asked, shards).join(seeds, ["block", "part"], "left_anti")
    found = first.unionByName(_meet(others, asked, shards, k))
    order = Window.partitionBy("query_id").orderBy(F.col("key").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
