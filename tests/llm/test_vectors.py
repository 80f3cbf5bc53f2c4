"""Hard negatives and vector codes against brute force in Python integers."""

import hashlib
import math
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
pytest.importorskip("terrier.llm")

from terrier.llm import codes, integers, negatives, search  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank int, part long, width int"
TOP = (1 << 63) - 1


def floors(v, scale):
    return [int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale) for x in v]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2, 3) for i, v, label in rows], SCHEMA)


def strange(n, seed, width=6, spread=1.0):
    make = random.Random(seed)
    rows = [(make.randrange(n * 2), [make.gauss(0, spread) for _ in range(width)], make.randrange(3)) for _ in range(n)]
    rows += [(rows[0][0] + k, list(rows[0][1]), k % 3) for k in range(40)]               # copies of one vector
    rows += [(7, None, 1), (8, [None] * width, 1), (9, [math.nan] * width, 1), (10, [math.inf] * width, 1),
             (None, [0.5] * width, 1), (100, [0.5] * width, None), (200, [0.25] * (width - 2), 1), (301, [0.5] * (width - 2), 1),
             (302, [0.4] * (width - 2), 2), (400, [], 1), (401, [], 1), (402, [], 2), (100, [0.1] * width, 1), (100, [0.1] * width, 1)]
    make.shuffle(rows)
    return rows


def mined(rows, scale=256, positives=5, negatives_=10):
    good = [(i, floors(v, scale), label) for i, v, label in rows if usable(v) and i is not None and label is not None]
    out = []
    for a, q, own in good:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, label) for i, v, label in good if i != a and len(v) == len(q))
        for s, i, label in [x for x in scored if x[2] == own][:positives]:
            p = -s
            inside = [(-t, j) for t, j, other in scored if other != own and 30 * p <= 100 * -t <= 90 * p][:negatives_]
            clamp = lambda x: max(-TOP - 1, min(TOP, x))
            out += [(a, i, r, j, clamp(p), clamp(n)) for r, (n, j) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [1.0, 1e6, 1e12, 1e30])
def test_hard_negatives_equal_brute_force(spark, spread):
    rows = strange(260, 5, spread=spread)
    want = mined(rows)
    got = sorted(map(tuple, negatives.mine(frame(spark, rows), size=64, block=2).collect()))
    assert got == want and len(want) > 20


def test_hard_negatives_of_nothing(spark):
    assert negatives.mine(frame(spark, [])).count() == 0
    assert negatives.mine(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0        # no anchor
    assert negatives.mine(frame(spark, [(100, [1.0], 1)])).count() == 0                      # no other row
    assert negatives.mine(frame(spark, [(100, [1.0], 1), (1, [0.0], 1), (2, [0.0], 2)])).collect() == [
        (100, 1, 1, 2, 0, 0)]                                                                 # a window of one value


def test_queue_leaves_pages_out():
    make = np.random.default_rng(3)
    centres = make.normal(0, 4000, (20, 8))
    labels = np.repeat(np.arange(20), 200)
    matrix = np.floor(centres[labels] + make.normal(0, 50, (4000, 8))).astype(np.int64)
    order = negatives.str_order(matrix, labels)
    assert sorted(order.tolist()) == list(range(4000))
    ids, matrix, labels = order.astype(np.int64), matrix[order], labels[order]
    tree = negatives.RTree(matrix, labels)
    low, high = np.full((5, 1), -np.inf, object), np.full((5, 1), np.inf, object)
    at = np.arange(0, 4000, 800)
    tops, whose, visited = negatives.search(tree, matrix, ids, labels, matrix[at], ids[at], labels[at], low, high, 5, True)
    assert visited < tree.pages / 3
    for i, a in enumerate(at):
        scores = sorted((-int(matrix[a] @ m), int(n)) for m, n, lab in zip(matrix, ids, labels) if lab == labels[a] and n != ids[a])[:5]
        assert [(-s, n) for s, n in scores] == list(zip(tops[i, 0].astype(int).tolist(), whose[i, 0].tolist()))


def test_pairs_are_pruned_by_boxes(spark):
    """A block of anchors meets no shard that its windows cannot reach."""
    far = [(i, [1000.0 + i % 7, 0.0], 0) for i in range(0, 400)] + [(i, [-1000.0 - i % 7, 0.0], 1) for i in range(400, 800)]
    rows = frame(spark, far).selectExpr("vec_id", "cast(label as long) as label", "embedding as v")
    shards = negatives.packed(rows, 100, 256, "s")
    blocks = negatives.packed(rows.where("vec_id < 400 AND vec_id % 100 = 0"), 10, 256, "b").selectExpr(
        "*", "unhex(NULL) AS least", "unhex(NULL) AS most")
    n, m = blocks.count(), shards.count()
    same = negatives.pairs(blocks, shards, True, None).count()
    assert 0 < same < n * m
    least = integers.sortable(10**9)
    from pyspark.sql import functions as F

    reach = blocks.withColumns({"least": F.lit(least), "most": F.lit(least)})
    assert negatives.pairs(reach, shards, False, lambda s: (s // 3, s)).count() == 0


def test_sortable_bytes_sort_like_integers():
    make = random.Random(1)
    values = [0, 1, -1, 255, 256, -255, -256, 1 << 63, -(1 << 63), 1 << 700] + [make.randrange(-(1 << 90), 1 << 90) >> make.randrange(90) for _ in range(500)]
    assert [integers.unsorted(integers.sortable(v)) for v in values] == values
    assert sorted(values) == sorted(values, key=integers.sortable)
    for v in values:
        assert sum(x << (32 * k) for k, x in enumerate(integers.limbs(v))) == v and all(abs(x) < 1 << 40 for x in integers.limbs(v))


def coded(rows, entries=8, rounds=4, parts=4, scale=1024):
    """Codes of rows of one width, as the contract states them."""
    kept = [(i, floors(v, scale), label) for i, v, label in rows if usable(v)]
    if not kept:
        return []
    edges = codes.cuts(len(kept[0][1]), parts)
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))[:entries]
    books = [[r[1][a:b] for r in first] for a, b in edges]

    def nearest(x, book):
        return min((sum((p - q) ** 2 for p, q in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for (a, b), book in zip(edges, books):
            mine = {}
            for r in kept:
                mine.setdefault(nearest(r[1][a:b], book)[1], []).append(r[1][a:b])
            for k, xs in mine.items():
                book[k] = [sum(c) // len(xs) for c in zip(*xs)]
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out, totals = [], {}
    for i, v, label in kept:
        best = [nearest(v[a:b], book) for (a, b), book in zip(edges, books)]
        error = min(TOP, sum(f for f, _ in best))
        totals[label] = totals.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in best), error, label, sha))
    return sorted(((i, c, e, min(TOP, totals[label]), s) for i, c, e, label, s in out), key=repr)


def collected(df):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


@pytest.mark.parametrize("spread, width", [(1.0, 8), (0.01, 8), (1e12, 8), (1e40, 4), (1.0, 6)])
def test_codes_equal_brute_force(spark, spread, width):
    rows = [r for r in strange(300, 9, width, spread) if r[1] is None or len(r[1]) == width]
    got = codes.encode(frame(spark, rows), entries=8, size=70)
    assert collected(got) == coded(rows)


def test_widths_have_codebooks_of_their_own(spark):
    rows = strange(60, 2, 8)
    got = collected(codes.encode(frame(spark, rows), entries=4, size=50))
    by_width = {}
    for r in rows:
        if usable(r[1]):
            by_width.setdefault(len(r[1]), []).append(r)
    want = sorted((x[:3] + x[4:] for own in by_width.values() for x in coded(own, entries=4)), key=repr)
    assert sorted((g[:3] + g[4:] for g in got), key=repr) == want
    assert any(g[1] == "00000000" and g[2] == 0 for g in got)                               # vectors without components


def test_codes_of_few_or_no_rows(spark):
    assert codes.encode(frame(spark, [])).count() == 0
    assert codes.encode(frame(spark, [(1, None, 1), (2, [math.nan] * 4, 1)])).count() == 0
    rows = [(3, [0.1, 0.2, 0.3, 0.4], None), (1, [0.5, 0.5, 0.5, 0.5], None), (2, [0.5, 0.5, 0.5, 0.5], 4)]
    assert collected(codes.encode(frame(spark, rows))) == coded(rows, entries=256)


def test_label_errors_by_join_equal_broadcast(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 3, i) for i in range(200)], "vec_id long, label int, error long")
    one, two = (sorted(map(tuple, codes.label_errors(df, few=few).select("vec_id", "label_error").collect())) for few in (100, 0))
    assert one == two
    assert dict(one)[0] == sum(range(0, 200, 5))


def test_balls_hold_their_points_and_are_owned():
    make = np.random.default_rng(5)
    x = np.floor(np.concatenate([make.normal(c, 3, (400, 4)) for c in (0, 500, 1000, 5000)])).astype(np.int64)
    tree = codes.Tree(x)
    laid = x[tree.order]
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    for n in range(len(tree.start)):
        own = laid[tree.start[n]: tree.end[n]]
        assert (tree.sums[n] == own.sum(0)).all()
        assert np.sqrt(((own - tree.centre[n]) ** 2).sum(1)).max() <= tree.radius[n] + 1e-9
        if tree.inner[n]:
            left, right = n + 1, int(tree.right[n])
            assert (tree.start[n], tree.end[left], tree.end[n]) == (tree.start[left], tree.start[right], tree.end[right])
    book = codes.Codebook(x[[0, 450, 900, 1400, 0]])
    owned = [(e - s, entry) for node, s, e, entry, _ in codes.owners(tree, laid, book) if node >= 0]
    assert sum(n for n, _ in owned) > 1200 and len(owned) < 40                             # whole balls, not points
    assert all(e[0] != 4 for _, e in owned)                                                 # ties to the lower entry


def test_anchors_take_the_nearest_points():
    x = np.random.default_rng(8).normal(0, 1, (500, 3))
    owner = codes.anchors(x, 12)
    pivots = [0]
    while len(pivots) < 12:
        near = np.min([((x - x[p]) ** 2).sum(1) for p in pivots], axis=0)
        pivots.append(int(near.argmax()))
    far = np.array([((x - x[p]) ** 2).sum(1) for p in pivots])
    assert np.allclose(far[owner, np.arange(500)], far.min(0))
    assert set(codes.anchors(np.zeros((9, 2)), 4).tolist()) == {0}


@pytest.mark.parametrize("spread", [1.0, 1e12, 1e30, 1e300])
def test_top_k_equals_brute_force(spark, spread):
    rows = strange(300, 8, spread=spread)
    good = [(i, floors(v, 256)) for i, v, _ in rows if usable(v) and i is not None]
    want = []
    for a in sorted({i for i, _ in good if i % 50 == 0}):
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i) for n, q in good if n == a for i, v in good if i != a and len(v) == len(q))
        want += [(a, r, i, max(-TOP - 1, min(TOP, -s))) for r, (s, i) in enumerate(scored[:5], 1)]
    got = sorted(map(tuple, search.top_k(frame(spark, rows), shard=64, block=2).collect()))
    assert got == sorted(want) and len(want) > 20


def test_search_of_few(spark):
    assert search.top_k(frame(spark, [])).count() == 0
    assert search.top_k(frame(spark, [(1, [1.0], 1), (2, [1.0], 1)])).count() == 0          # no query
    assert search.top_k(frame(spark, [(50, [1.0], 1)])).count() == 0                         # no other row
    assert search.top_k(frame(spark, [(50, [1.0], 1), (1, [2.0], 1)])).collect() == [(50, 1, 1, 131072)]


def clustered(n, seed):
    make = np.random.default_rng(seed)
    centres = make.normal(0, 4000, (20, 8))
    return np.floor(centres[np.arange(n) % 20] + make.normal(0, 50, (n, 8))).astype(np.int64)


def test_inner_nodes_leave_leaves_out():
    matrix = clustered(8000, 4)
    tree = search.BallTree(matrix)
    ids, ordered = tree.order.astype(np.int64), matrix[tree.order]
    leaves = sum(c == 0 for c in tree.child)
    assert leaves < len(tree.child) and sorted(ids.tolist()) == list(range(8000))
    at = np.arange(0, 8000, 1600)
    tops, whose, visited = search.best(tree, ordered, ids, matrix[at], at, np.full(len(at), -np.inf, object), 5)
    assert visited < leaves / 3
    for i, a in enumerate(at):
        scores = sorted((-int(matrix[a] @ m), n) for n, m in enumerate(matrix) if n != a)[:5]
        assert [(-s, n) for s, n in scores] == list(zip(tops[i].astype(int).tolist(), whose[i].tolist()))
    better = search.best(tree, ordered, ids, matrix[at], at, tops[:, -1].astype(np.int64).astype(object), 5)
    assert (better[0] == tops).all() and better[2] <= visited


def test_blocks_meet_few_shards(spark):
    rows = [(i, v) for i, v in enumerate((clustered(4000, 6) / 256).tolist())]
    good = spark.createDataFrame(rows, "vec_id long, v array<double>")
    shards, asked = search.packed(good, 100, 256, "shards"), search.packed(good.where("vec_id % 50 = 0"), 4, 256, "queries")
    seeds = search.pairs(asked, shards, 8)
    assert seeds.count() == asked.count()
    first = search._meet(seeds, asked.selectExpr("*", "cast(NULL AS array<struct<place:int,key:binary>>) AS kth"), shards, 5)
    known = first.groupBy("block").agg({"key": "min"}).toDF("part", "least")
    met = search.pairs(asked.join(known, "part"), shards, 8)
    assert met.count() < asked.count() * shards.count() / 3
