"""Vector code compression: product codes learnt over metric trees of the anchors hierarchy.

Vectors become integers floor(scale * x) and are cut into ``parts`` consecutive parts. The
codebook of a part position starts as that part of the vectors with the smallest ids and
takes ``rounds`` rounds of assignment and componentwise floor of the means.

Rows are gathered where they lie into shards of bounded size, without a shuffle. Each
shard has one metric tree per part, built once and written to the shared folder:

- anchors: the point farthest from its own anchor becomes the next anchor and takes the
  points nearer to it; points closer to their anchor than half the distance of the two
  anchors are never looked at. There are about sqrt(n) of them.
- middle-out: each anchor's points are split in the same way down to small leaves, and
  the anchors are merged upwards, the pair with the smallest common ball first.
- every ball keeps centre, radius, count and sum of its points.

In a round a ball inherits its parent's candidate entries. Entry j leaves the list when it
is farther than the nearest one m for all points of the ball: |c-j|^2 - |c-m|^2 - 2r|j-m|
is above 0. A ball with one candidate is wholly owned: its count and sum go to the entry
at once. Leaves with several are settled point by point in exact integers, ties to the
lower index. Sums of a task leave it once per entry; Spark adds them up by part and entry,
and only codebooks, of fixed size, reach the driver.

NULL vectors and NULL or non-finite components: the row is dropped. Vectors of another
width form codebooks of their own; a width that 4 does not divide gets parts as equal as
possible. Fewer rows than entries give as many entries as rows; an empty table no row.
Repeated rows are all coded and counted; among rows of one id the smaller vector comes
first, NULL ids come last. Errors beyond 64 bits are given as the largest 64-bit value.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.llm.integers import approximate, clamp, dump, finite, floors, largest, limbs, load, working
from terrier.operators.joins import left_enrich
from terrier.session import cut_lineage

LEAF = 48


def cuts(width: int, parts: int) -> list[tuple[int, int]]:
    """Borders of the parts; the first ones are longer where the width does not divide."""
    edges = np.cumsum([0, *(len(x) for x in np.array_split(np.arange(width), parts))])
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _distances(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - point) ** 2).sum(1))


def anchors(x: np.ndarray, count: int) -> np.ndarray:
    """The anchor (0, 1, ...) of every point; fewer than ``count`` where points coincide."""
    owner, pivots = np.zeros(len(x), np.int64), [0]
    near = _distances(x, x[0])
    while len(pivots) < count:
        new = int(np.argmax(near))
        if near[new] <= 0:
            break
        apart = _distances(x[pivots], x[new])
        able = np.flatnonzero(near > apart[owner] / 2)
        there = _distances(x[able], x[new])
        taken = able[there < near[able]]
        near[taken] = there[there < near[able]]
        owner[taken] = len(pivots)
        pivots.append(new)
    return owner


class Tree:
    """A metric tree over the rows of an integer matrix; see the module's docstring.

    ``order`` lists the rows so that every ball is a range [start, end) of it.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        x = approximate(points)
        if largest(points) > 1 << 500:             # squares leave the range of doubles: one leaf
            leaf = len(points)
        self.nodes: list = []                      # (left, right) or an array of rows
        root = self._split(x, np.arange(len(x)), leaf)
        order, flat, todo, laid_out = [], [], [(root, -1)], 0
        place: dict[int, int] = {}
        while todo:                                # preorder: the right child is put on the stack first
            node, parent = todo.pop()
            place[node] = len(flat)
            made = self.nodes[node]
            flat.append([parent, isinstance(made, tuple), 0, 0])
            if isinstance(made, tuple):
                todo += [(made[1], place[node]), (made[0], place[node])]
            else:
                order.append(made)
                flat[-1][2], laid_out = laid_out, laid_out + len(made)
                flat[-1][3] = laid_out
        del self.nodes
        self.order = np.concatenate(order).astype(np.int32)
        self.parent = np.array([f[0] for f in flat], np.int32)
        self.inner = np.array([f[1] for f in flat], bool)
        self.start, self.end = (np.array([f[k] for f in flat], np.int32) for k in (2, 3))
        for i in range(len(flat) - 1, 0, -1):      # children come after their parent
            p = self.parent[i]
            self.start[p] = self.start[i]
            self.end[p] = max(self.end[p], self.end[i])
        self.right = np.zeros(len(flat), np.int32)
        self.right[self.parent[1:]] = np.arange(1, len(flat))  # the last child of each; the left one is the next node
        laid = points[self.order]
        zero = np.zeros((1, points.shape[1]), laid.dtype)
        sums = np.concatenate([zero, np.cumsum(laid, axis=0, dtype=laid.dtype)])
        self.sums = sums[self.end] - sums[self.start]
        counts = (self.end - self.start)[:, None]
        self.centre = approximate(self.sums) / counts
        x = x[self.order]
        self.radius = np.array([_distances(x[s:e], c).max() for s, e, c in zip(self.start, self.end, self.centre)])

    def _add(self, node) -> int:
        self.nodes.append(node)
        return len(self.nodes) - 1

    def _split(self, x: np.ndarray, rows: np.ndarray, leaf: int) -> int:
        if len(rows) <= leaf:
            return self._add(rows)
        owner = anchors(x[rows], max(2, int(np.sqrt(len(rows)))))
        groups = [rows[owner == a] for a in range(owner.max() + 1)]
        if len(groups) == 1:
            return self._add(rows)
        balls = [self._split(x, g, leaf) for g in groups]
        centre = np.array([x[g].mean(0) for g in groups])
        radius = np.array([_distances(x[g], c).max() for g, c in zip(groups, centre)])
        count = np.array([len(g) for g in groups], np.float64)
        apart = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2))
        cost = self._common(apart, radius[:, None], radius[None])
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(groups) - 1):
            i, j = divmod(int(np.argmin(cost)), len(groups))
            balls[i] = self._add((balls[i], balls[j]))
            merged = (centre[i] * count[i] + centre[j] * count[j]) / (count[i] + count[j])
            radius[i] = max(np.sqrt(((merged - centre[k]) ** 2).sum()) + radius[k] for k in (i, j))
            centre[i], count[i] = merged, count[i] + count[j]
            gone = np.isinf(cost[j]) & np.isinf(cost[i])
            row = self._common(_distances(centre, merged), radius, radius[i])
            row[gone] = np.inf
            row[[i, j]] = np.inf
            cost[i], cost[:, i] = row, row
            cost[j], cost[:, j] = np.inf, np.inf
        return balls[i] if len(groups) > 1 else balls[0]

    @staticmethod
    def _common(apart, a, b) -> np.ndarray:
        """Radius of the smallest ball round two balls."""
        return np.maximum(np.maximum(a, b), (apart + a + b) / 2)


class Codebook:
    """Entries of one part position, with what the bounds need."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.size = len(entries)
        self.points = approximate(entries)
        self.apart = np.sqrt(np.maximum(((self.points[:, None] - self.points[None]) ** 2).sum(2), 0))
        # An entry equal to an earlier one never wins a tie.
        seen: dict = {}
        self.distinct = np.array([i for i, e in enumerate(map(tuple, entries)) if seen.setdefault(e, i) == i], np.int64)


def _settle(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest entry and squared distance, exact."""
    x, entries = working(x, entries, factor=4)
    far = (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None]
    best = np.argmin(far, axis=1)
    return best, far[np.arange(len(x)), best]


def owners(tree: Tree, laid: np.ndarray, book: Codebook) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(node or -1, start, end, entries, squared distances): balls wholly owned, and settled leaves.

    ``laid`` has the points in the order of the tree. A ball gives one entry, a leaf one
    per point; distances are exact.
    """
    todo = [(0, book.distinct)]
    while todo:
        node, able = todo.pop()
        s, e = int(tree.start[node]), int(tree.end[node])
        if len(able) > 1:
            far = ((book.points[able] - tree.centre[node]) ** 2).sum(1)
            m = int(np.argmin(far))
            gap = far - far[m] - 2 * tree.radius[node] * book.apart[able, able[m]]
            able = able[~(gap > 1e-9 * (far + far[m] + 1))]
        if len(able) == 1:
            yield node, s, e, able, _settle(laid[s:e], book.entries[able])[1]
        elif tree.inner[node]:
            todo += [(int(tree.right[node]), able), (node + 1, able)]
        else:
            best, far = _settle(laid[s:e], book.entries[able])
            yield -1, s, e, able[best], far


def _shard(ids, labels, matrix: np.ndarray, parts: int) -> tuple:
    trees, laid = [], []
    for a, b in cuts(matrix.shape[1], parts):
        tree = Tree(matrix[:, a:b]) if b > a else None
        trees.append(tree)
        laid.append(dump(matrix[tree.order, a:b]) if tree else b"")
    known = [x for x in ids if x is not None]
    return matrix.shape[1], min(known) if known else None, ids, labels, pickle.dumps(trees), laid


def shards(vectors: DataFrame, parts: int, scale: int, size: int) -> DataFrame:
    """One row per shard: its ids, labels and trees. Rows are gathered within their task."""
    good = vectors.where(finite(vectors)).select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    id_type, label_type = (good.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    kinds = [pa.int32(), None, None, None, pa.binary(), pa.list_(pa.binary())]
    names = ["width", "least", "ids", "labels", "trees", "laid"]

    def build(batches):
        open_: dict[int, list] = defaultdict(list)

        def close(width):
            ids, labels, rows = [], [], []
            for batch, own in open_.pop(width):
                ids += batch.column(0).to_pylist()
                labels += batch.column(1).to_pylist()
                rows.append(own)
            kind = object if any(r.dtype == object for r in rows) else np.int64
            row = _shard(ids, labels, np.concatenate([r.astype(kind) for r in rows]), parts)
            types = [*kinds[:1], first, pa.list_(first), pa.list_(second), *kinds[4:]]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            first, second = batch.schema.field(0).type, batch.schema.field(1).type
            widths = np.array([len(v) for v in batch.column(2)], np.int64)
            for width in np.unique(widths):
                most = max(LEAF, min(size, (1 << 20) // max(1, int(width))))
                at = np.flatnonzero(widths == width)
                while len(at):
                    free = most - sum(len(o) for _, o in open_[int(width)])
                    part = batch.take(pa.array(at[:free]))
                    open_[int(width)].append((part, floors(part.column(2), int(width), scale)))
                    at = at[free:]
                    if sum(len(o) for _, o in open_[int(width)]) >= most:
                        yield close(int(width))
        for width in list(open_):
            if open_[width]:
                yield close(width)

    schema = f"width int, least {id_type}, ids array<{id_type}>, labels array<{label_type}>, trees binary, laid array<binary>"
    return cut_lineage(good.mapInArrow(build, schema), "code-shards")


def _matrix(laid: list, trees: list, n: int, parts: list) -> np.ndarray:
    """The vectors of a shard in the order of its ids."""
    blocks = []
    for data, tree, (a, b) in zip(laid, trees, parts):
        if tree is not None:
            rows = load(data, b - a)
            block = np.empty_like(rows)
            block[tree.order] = rows
            blocks.append(block)
    kind = object if any(x.dtype == object for x in blocks) else np.int64
    return np.concatenate([x.astype(kind) for x in blocks], axis=1) if blocks else np.zeros((n, 0), np.int64)


def first_entries(built: DataFrame, width: int, entries: int, parts: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids.

    The ``entries`` smallest ids lie in the ``entries`` shards with the smallest least id:
    every shard before them has a row that comes first. Only those shards give rows, each
    at most ``entries``, and these sort once more.
    """
    own = built.where(F.col("width") == width)
    borders = own.select("least").orderBy(F.asc_nulls_last("least")).limit(entries)
    top = borders.agg(F.max("least"), F.count_if(F.col("least").isNull()), F.count(F.lit(1))).first()
    # Ties in the least id stay in, as do shards without an id where ids alone do not fill the codebook.
    near = own if top[1] or top[2] < entries else own.where(F.col("least") <= F.lit(top[0]))
    id_type = built.schema["least"].dataType.simpleString()
    borders_of = cuts(width, parts)

    def smallest(batches):
        for batch in batches:
            kind = batch.schema.field("least").type
            for row in batch.to_pylist():
                matrix = _matrix(row["laid"], pickle.loads(row["trees"]), len(row["ids"]), borders_of)
                ids = row["ids"]
                order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, tuple(matrix[i])))[:entries]
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[i] for i in order], kind), pa.array([[str(x) for x in matrix[i]] for i in order], pa.list_(pa.string()))], names=["id", "v"])

    rows = near.mapInArrow(smallest, f"id {id_type}, v array<string>")
    # Whole vectors break ties of repeated ids; widths are equal, so numbers order by position.
    keys = F.transform("v", lambda x: x.cast("double"))
    taken = rows.orderBy(F.asc_nulls_last("id"), keys, "v").limit(entries).collect()  # at most ``entries`` rows
    taken.sort(key=lambda r: (r["id"] is None, r["id"] if r["id"] is not None else 0, [int(x) for x in r["v"]]))
    found = np.array([[int(x) for x in r["v"]] for r in taken], object).reshape(len(taken), width)
    return [found[:, a:b] for a, b in borders_of]


def _narrow(entries: np.ndarray) -> np.ndarray:
    return entries.astype(np.int64) if all(abs(int(x)) < 1 << 62 for x in entries.reshape(-1)) else entries


def updated(built: DataFrame, books: dict[int, list[np.ndarray]]) -> dict[int, list[np.ndarray]]:
    """Codebooks after one round: the floor of the mean of what each entry owns; unused entries stay."""
    def assign(batches):
        totals: dict = {}
        ready: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                width, trees = row["width"], pickle.loads(row["trees"])
                for p, (tree, data) in enumerate(zip(trees, row["laid"])):
                    if tree is None:
                        continue
                    if (width, p) not in ready:
                        ready[width, p] = Codebook(_narrow(books[width][p]))
                        totals[width, p] = [np.zeros(books[width][p].shape, object), np.zeros(len(books[width][p]), np.int64)]
                    book, (sums, counts) = ready[width, p], totals[width, p]
                    laid = load(data, book.entries.shape[1])
                    local = np.zeros(sums.shape, laid.dtype)
                    for node, s, e, entry, _ in owners(tree, laid, book):
                        if node >= 0:
                            local[entry[0]] += tree.sums[node]
                            counts[entry[0]] += e - s
                        else:
                            np.add.at(local, entry, laid[s:e])
                            np.add.at(counts, entry, 1)
                    sums += local.astype(object)
        out = []
        for (width, p), (sums, counts) in totals.items():
            for entry in np.flatnonzero(counts):
                pieces = [limbs(x) for x in sums[entry]]
                for k in range(max(map(len, pieces))):
                    out.append((width, p, int(entry), k, int(counts[entry]) if k == 0 else 0, [x[k] if k < len(x) else 0 for x in pieces]))
        if out:
            types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["width", "part", "entry", "limb", "n", "sums"])

    found = built.select("width", "trees", "laid").mapInArrow(assign, "width int, part int, entry int, limb int, n long, sums array<long>")
    each = found.select("width", "part", "entry", "limb", "n", F.posexplode("sums").alias("place", "x"))
    summed = each.groupBy("width", "part", "entry", "limb", "place").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    new = {w: [b.copy() for b in parts] for w, parts in books.items()}
    totals: dict = defaultdict(int)
    counts: dict = {}
    for r in summed.collect():                    # codebooks: their size does not grow with the rows
        key = r["width"], r["part"], r["entry"], r["place"]
        totals[key] += r["x"] << (32 * r["limb"])
        if r["limb"] == 0:
            counts[key] = r["n"]
    for (w, p, entry, place), total in totals.items():
        new[w][p][entry, place] = total // counts[w, p, entry, place]
    return new


def learn(built: DataFrame, entries: int = 256, parts: int = 4, rounds: int = 4) -> dict[int, list[np.ndarray]]:
    """Codebooks of every width and part position."""
    widths = sorted(r[0] for r in built.select("width").distinct().collect())  # one row per width
    books = {w: first_entries(built, w, entries, parts) for w in widths}
    for _ in range(rounds):
        if books:
            books = updated(built, books)
    return books


def digest(parts: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for book in parts for x in book.reshape(-1)).encode()).hexdigest()


def assigned(built: DataFrame, books: dict[int, list[np.ndarray]]) -> DataFrame:
    """vec_id, label, code, error, codebooks_sha256 of every row of the shards."""
    shas = {w: digest(parts) for w, parts in books.items()}
    id_type = built.schema["least"].dataType.simpleString()
    label_type = built.schema["labels"].dataType.elementType.simpleString()

    def code(batches):
        ready = {w: [Codebook(_narrow(b)) for b in parts] for w, parts in books.items()}
        for batch in batches:
            kinds = batch.schema.field("least").type, batch.schema.field("labels").type.value_type
            for row in batch.to_pylist():
                n, trees = len(row["ids"]), pickle.loads(row["trees"])
                codes, errors = np.zeros((n, len(trees)), np.int64), np.zeros(n, object)
                for p, (tree, data) in enumerate(zip(trees, row["laid"])):
                    if tree is None:
                        continue
                    laid = load(data, ready[row["width"]][p].entries.shape[1])
                    for _, s, e, entry, far in owners(tree, laid, ready[row["width"]][p]):
                        at = tree.order[s:e]
                        codes[at, p] = entry
                        errors[at] += np.array([int(x) for x in far], object)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["ids"], kinds[0]), pa.array(row["labels"], kinds[1]),
                    pa.array(["".join(f"{x:02x}" for x in c) for c in codes], pa.string()),
                    pa.array([clamp(x) for x in errors], pa.int64()),
                    pa.array([shas[row["width"]]] * n, pa.string())], names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    return built.mapInArrow(code, f"vec_id {id_type}, label {label_type}, code string, error long, codebooks_sha256 string")


def label_errors(coded: DataFrame, salts: int = 16, few: int = 100_000) -> DataFrame:
    """``coded`` with label_error: the sum of errors over equal labels, NULLs together.

    The totals have one row per label. They are broadcast while they are at most ``few``
    rows, counted first; beyond that a label's rows are spread over ``salts`` tasks.
    """
    known = coded.withColumns({"_null": F.col("label").isNull(), "_label": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    total = F.sum(F.col("error").cast("decimal(20,0)"))
    capped = F.least(total, F.lit(2**63 - 1).cast("decimal(30,0)")).cast("long")
    totals = known.groupBy("_null", "_label").agg(capped.alias("label_error"))
    totals = cut_lineage(totals, "label-errors")
    keys = ["_null", "_label"]
    if totals.count() <= few:
        joined = known.join(F.broadcast(totals), keys, "left")
    else:
        joined = left_enrich(known, totals, keys, salts=salts)
    return joined.drop(*keys)


def encode(
    vectors: DataFrame, entries: int = 256, parts: int = 4, rounds: int = 4, scale: int = 1024, size: int = 8192
) -> DataFrame:
    """vec_id, label, code, error, codebooks_sha256, label_error of every kept row."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part")
    built = shards(vectors, parts, scale, size)
    coded = cut_lineage(assigned(built, learn(built, entries, parts, rounds)), "codes")
    return label_errors(coded)
