"""Masks as runs, whole batches at once, against plain rules applied point by point."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from annolake.operators import masks, runs


def drawn(points, h, w):
    """Pixels of one polygon by the format's rule, walked point by point on a grid five times finer."""
    corner = [(int(5 * x + 0.5), int(5 * y + 0.5)) for x, y in zip(points[0::2], points[1::2], strict=True)]
    walk = []
    for (xs, ys), (xe, ye) in zip(corner, corner[1:] + corner[:1], strict=True):
        dx, dy = abs(xe - xs), abs(ye - ys)
        turn = (dx >= dy and xs > xe) or (dx < dy and ys > ye)
        if turn:
            xs, ys, xe, ye = xe, ye, xs, ys
        part = []
        for t in range(max(dx, dy) + 1):
            if dx >= dy:
                part.append((xs + t, int(ys + ((ye - ys) / dx if dx else 0.0) * t + 0.5)))
            else:
                part.append((int(xs + (xe - xs) / dy * t + 0.5), ys + t))
        walk += part[::-1] if turn else part
    marks = []
    for (u0, v0), (u1, v1) in zip(walk, walk[1:], strict=False):
        if u0 != u1:
            x = (min(u0, u1) + 0.5) / 5 - 0.5
            if x == math.floor(x) and 0 <= x <= w - 1:
                y = min(max((min(v0, v1) + 0.5) / 5 - 0.5, 0), h)
                marks.append(int(x) * h + math.ceil(y))
    out, on = set(), None
    for m in sorted(marks):
        if on is None:
            on = m
        else:
            out.update(range(on, m))
            on = None
    if on is not None:
        out.update(range(on, h * w))
    return out


def pixels(r):
    out, at = set(), 0
    for k, n in enumerate(r):
        if k % 2:
            out.update(range(at, at + n))
        at += n
    return out, at


@pytest.mark.parametrize("seed", range(6))
def test_polygons_by_the_rule_of_the_format(seed):
    rng = np.random.default_rng(seed)
    rows, sizes = [], []
    for _ in range(60):
        h, w = int(rng.integers(1, 30)), int(rng.integers(1, 30))
        sizes.append((h, w))
        one = lambda h=h, w=w: [float(v) for _ in range(int(rng.integers(3, 9))) for v in (rng.uniform(-0.3, 1.3) * w, rng.uniform(-0.3, 1.3) * h)]
        polygons = [one() for _ in range(int(rng.integers(0, 4)))]
        if rng.random() < 0.3:  # whole and half pixels, where rounding matters
            polygons = [[round(2 * v) / 2 for v in p] for p in polygons]
        rows.append(polygons)
    rows[3], rows[4] = None, [[1.0, 2.0, 3.0, 4.0]]
    h, w = (np.array(v) for v in zip(*sizes, strict=True))
    got = runs.from_polygons(pa.array(rows, pa.list_(pa.list_(pa.float64()))), h, w).to_pylist()
    for polygons, (a, b), r in zip(rows, sizes, got, strict=True):
        want = set().union(*(drawn(p, a, b) for p in polygons or [] if len(p) >= 6))
        assert pixels(r) == (want, a * b) and all(n > 0 for n in r[1:])


def test_rectangles_and_shared_borders():
    square = [[2.0, 3.0, 6.0, 3.0, 6.0, 8.0, 2.0, 8.0]]
    r = runs.from_polygons(pa.array([square]), np.array([10]), np.array([12])).to_pylist()[0]
    assert pixels(r)[0] == {x * 10 + y for x in range(2, 6) for y in range(3, 8)}


@pytest.mark.parametrize("seed", range(4))
def test_texts_of_a_batch(seed):
    rng = np.random.default_rng(seed)
    rows = [rng.integers(0, [3, 40, 70_000][k % 3], int(rng.integers(0, 12))).tolist() for k in range(50)]
    texts = [masks.to_text(np.array(r, np.int64)) for r in rows]
    assert runs.from_texts(pa.array([*texts, None])).to_pylist() == [*rows, []]


def test_canonical_forms_in_one_batch(spark):
    square = [[2.0, 3.0, 6.0, 3.0, 6.0, 8.0, 2.0, 8.0]]
    want = runs.from_polygons(pa.array([square]), np.array([10]), np.array([12])).to_pylist()[0]
    rows = [(1, want, None, None), (2, None, masks.to_text(np.array(want)), None), (3, None, None, square), (4, None, None, None), (5, None, None, square + square)]
    df = spark.createDataFrame([(*r, 10, 12) for r in rows], "id int, counts array<int>, text string, polygons array<array<double>>, height int, width int")
    got = {r.id: r.runs for r in masks.canonical(df).collect()}
    assert got == {1: want, 2: want, 3: want, 4: [120], 5: want}
    assert masks.canonical(df.limit(0)).count() == 0


def test_union_joins_and_drops():
    some = runs.Spans(np.array([1, 1, 1, 0, 1]), np.array([5, 0, 3, 2, 9]), np.array([7, 2, 5, 2, 10]), 3)
    assert runs.runs_of(runs.union(some, np.array([12, 12, 4])), np.array([12, 12, 4])).to_pylist() == [[12], [0, 2, 1, 4, 2, 1, 2], [4]]


def random_masks(rng, n=40):
    sizes = [(int(rng.integers(1, 16)), int(rng.integers(1, 16))) for _ in range(n)]
    maps = [rng.random(s) < rng.choice([0.0, 0.05, 0.4, 0.6, 0.95, 1.0]) for s in sizes]
    h, w = (np.array(v) for v in zip(*sizes, strict=True))
    return maps, h, w, runs.Spans.of(pa.array([masks.from_bitmap(m).tolist() for m in maps], pa.list_(pa.int32())))


def bitmaps(spans, h, w):
    return [masks.to_bitmap(np.array(r), a, b) for r, a, b in zip(runs.runs_of(spans, h * w).to_pylist(), h.tolist(), w.tolist(), strict=True)]


@pytest.mark.parametrize("seed", range(8))
def test_shapes_on_runs_are_those_of_bitmaps(seed):
    from annolake.operators import shapes

    rng = np.random.default_rng(seed)
    maps, h, w, spans = random_masks(rng)
    same = lambda got, want: all((g == x).all() for g, x in zip(got, want, strict=True))
    assert same(bitmaps(shapes.boundary(spans, h, w), h, w), [masks.boundary(m) for m in maps])
    radius = rng.integers(0, 4, len(maps))
    assert same(bitmaps(shapes.dilated(spans, h, w, radius), h, w), [masks.dilate(m, int(r)) for m, r in zip(maps, radius, strict=True)])
    for most in (0, 2, 5, 40):
        want = []
        for m in maps:
            m = m.copy()
            holes = masks.components(~m)
            m |= (holes > 0) & (np.bincount(holes.ravel())[holes] <= most)
            parts = masks.components(m)
            want.append(m & ~((parts > 0) & (np.bincount(parts.ravel())[parts] <= min(most, int(m.sum()) // 2))))
        assert same(bitmaps(shapes.cleaned(spans, h, w, most), h, w), want)
    other = runs.Spans.of(pa.array([masks.from_bitmap(rng.random(m.shape) < 0.5).tolist() for m in maps], pa.list_(pa.int32())))
    got = shapes.boundary_f(spans, other, h, w, 0.1)
    for k, (a, b) in enumerate(zip(maps, bitmaps(other, h, w), strict=True)):
        x, y = masks.boundary(a), masks.boundary(b)
        r = math.ceil(0.1 * math.hypot(*a.shape))
        if not x.any() or not y.any():
            assert got[k] == (1.0 if x.any() == y.any() else 0.0)
        else:
            p, q = (y & masks.dilate(x, r)).sum() / y.sum(), (x & masks.dilate(y, r)).sum() / x.sum()
            assert got[k] == pytest.approx(2 * p * q / (p + q) if p + q else 0.0)


def test_large_images_cost_no_more_than_their_runs():
    """A hundred rings on images of 20,000 x 20,000 pixels, of which a bitmap would take 40 GB."""
    from annolake.operators import shapes

    side, n = 20_000, 100
    ring = [[float(v) for v in p] for p in ([100, 100, 1100, 100, 1100, 1100, 100, 1100],)]
    made = runs.from_polygons(pa.array([ring] * n), np.full(n, side), np.full(n, side))
    spans = runs.Spans.of(made)
    edge = shapes.boundary(spans, np.full(n, side), np.full(n, side))
    assert edge.area().tolist() == [4 * 1000] * n and shapes.cleaned(spans, np.full(n, side), np.full(n, side), 50).area().tolist() == [10**6] * n


def test_polygons_of_a_whole_table(spark, sf):
    from annolake.plans import evaluations
    from annolake.plans import fixtures as fx

    corner = [(0.25, 0.0), (0.75, 0.0), (1.0, 0.4), (0.7, 1.0), (0.3, 0.9), (0.0, 0.5)]
    want = {}
    for r in fx.gt_boxes(spark, sf).collect():
        if r.image_id % 7 == 0:
            ones = drawn([v for a, b in corner for v in (r.x + r.w * a + 0.25, r.y + r.h * b)], 300, 400)
            xs, ys = [p // 300 for p in ones], [p % 300 for p in ones]
            want[r.image_id, r.ann_id] = (len(ones), min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1) if ones else (0, 0, 0, 0, 0)
    got = {(r.image_id, r.ann_id): tuple(r)[2:] for r in evaluations.polygon_masks(spark, sf).collect()}
    assert len(want) > 500 and {k: got[k] for k in want} == want


@pytest.mark.parametrize("seed", range(3))
def test_turned_boxes_against_counted_points(seed):
    """Overlap of boxes at any angle, by the share of a fine grid's points that lie in both; and of equal, touching, nested and empty ones."""
    from annolake.operators import pairs

    rng = np.random.default_rng(seed)
    boxes = np.column_stack([rng.uniform(-3, 3, (60, 2)), rng.uniform(1, 6, (60, 2)), rng.uniform(-400, 400, 60)])
    a, b = boxes[:30], boxes[30:]
    axis = np.linspace(-10, 10, 801)
    x, y = np.meshgrid(axis, axis)

    def inside(box):
        xc, yc, w, h, angle = box
        c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
        u, v = c * (x - xc) - s * (y - yc), s * (x - xc) + c * (y - yc)
        return (abs(u) <= w / 2) & (abs(v) <= h / 2)

    got = pairs.common_area(pairs.corners(a), pairs.corners(b))
    for g, p, q in zip(got, a, b, strict=True):
        assert g == pytest.approx((inside(p) & inside(q)).sum() * (axis[1] - axis[0]) ** 2, abs=0.25)
    same = pairs.common_area(pairs.corners(a), pairs.corners(a))
    assert same == pytest.approx(a[:, 2] * a[:, 3])
    fixed = np.array([[0, 0, 2, 2, 0], [0, 0, 2, 2, 0], [0, 0, 4, 4, 45], [0, 0, 0, 0, 0], [0, 0, 2, 2, 0.0]])
    other = np.array([[2, 0, 2, 2, 0], [0, 0, 1, 1, 30], [0, 0, 2, 2, 0], [0, 0, 2, 2, 0], [9, 9, 2, 2, 10.0]])
    assert pairs.common_area(pairs.corners(fixed), pairs.corners(other)) == pytest.approx([0, 1, 4, 0, 0], abs=1e-12)


def test_only_steps_within_the_image_are_worked_out():
    from annolake.operators import runs

    far = 1e8  # a walk along such edges has two thousand million points
    polygons = [[[-far, -far, far, -far, far, far, -far, far]], [[-far, 2.0, far, 2.0, far, 4.0, -far, 4.0]], [[1.0, -far, 3.0, -far, 3.0, far, 1.0, far]], None]
    got = runs.from_polygons(pa.array(polygons, pa.list_(pa.list_(pa.float64()))), np.full(4, 5), np.full(4, 4))
    assert got.to_pylist() == [[0, 20], [2, 2, 3, 2, 3, 2, 3, 2, 1], [5, 10, 5], [20]]


def test_sizes_are_those_of_the_runs(spark):
    rows = [(1, [2, 3, 7], None, None), (2, None, masks.to_text(np.array([0, 4, 4, 4])), None), (3, None, None, [[0.2, 0.1, 2.7, 0.3, 1.4, 3.6], [1.0, 1.0, 3.0, 1.0, 3.0, 2.0]]), (4, None, None, None)]
    df = spark.createDataFrame([(*r, 4, 3) for r in rows], "k int, counts array<int>, text string, polygons array<array<double>>, height int, width int")
    want = masks.bounds(masks.canonical(df)).select("k", "height", "width", masks.area(F.col("runs")), "mx", "my", "mw", "mh")
    assert sorted(map(tuple, masks.sizes(df).collect())) == sorted(map(tuple, want.collect())) != []
