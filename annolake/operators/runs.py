"""Run lengths of whole Arrow batches in flat arrays: every mask of a batch lies on one line, each at its own stretch of it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


class Spans:
    """Start and end of the ones of each mask in column-major order; `row` is the mask's number in the batch. Null runs are an empty mask."""

    def __init__(self, row: np.ndarray, start: np.ndarray, end: np.ndarray, n: int):
        self.row, self.start, self.end, self.n = row, start, end, n

    @classmethod
    def of(cls, runs: pa.Array) -> Spans:
        lengths = np.asarray(pc.fill_null(pc.list_value_length(runs), 0)).astype(np.int64)
        values = np.asarray(runs.flatten()).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(lengths)])
        upto = np.concatenate([[0], np.cumsum(values)])
        row = np.repeat(np.arange(len(lengths)), lengths)
        end = upto[1:] - upto[first[row]]
        ones = ((np.arange(len(values)) - first[row]) % 2 == 1) & (values > 0)
        return cls(row[ones], (end - values)[ones], end[ones], len(lengths))

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per span, for every mask."""
        total = np.concatenate([[0], np.cumsum(values)])
        edge = np.searchsorted(self.row, np.arange(self.n + 1))
        return total[edge[1:]] - total[edge[:-1]]

    def area(self) -> np.ndarray:
        return self.per_row(self.end - self.start)

    def some(self, rows: np.ndarray) -> Spans:
        """The masks of the given ascending numbers, as 0, 1, ..."""
        place = np.full(self.n, -1)
        place[rows] = np.arange(len(rows))
        row = place[self.row]
        keep = row >= 0
        return Spans(row[keep], self.start[keep], self.end[keep], len(rows))


def overlaps(a: Spans, b: Spans) -> np.ndarray:
    """Common length of the masks of equal number: one search over all spans of the batch."""
    if not len(a.row) or not len(b.row):
        return np.zeros(a.n, np.int64)
    stretch = int(max(a.end.max(), b.end.max())) + 1
    start, end = b.start + b.row * stretch, b.end + b.row * stretch
    total = np.concatenate([[0], np.cumsum(end - start)])

    def upto(x: np.ndarray) -> np.ndarray:
        k = np.searchsorted(start, x, side="right")
        last = np.maximum(k - 1, 0)
        return np.where(k > 0, total[last] + np.minimum(x, end[last]) - start[last], 0)

    return a.per_row(upto(a.end + a.row * stretch) - upto(a.start + a.row * stretch))


def boxes(spans: Spans, height: np.ndarray) -> np.ndarray:
    """(n, 4) x, y, w, h of each mask; zeros for an empty one. A span that goes on into the next column touches top and bottom."""
    out = np.zeros((spans.n, 4), np.int64)
    some = np.unique(spans.row)
    if not len(some):
        return out
    h = height[spans.row]
    left, right, top, low = spans.start // h, (spans.end - 1) // h, spans.start % h, (spans.end - 1) % h + 1
    wraps = left != right
    top, low = np.where(wraps, 0, top), np.where(wraps, h, low)
    first = np.searchsorted(spans.row, some)
    x, y = np.minimum.reduceat(left, first), np.minimum.reduceat(top, first)
    out[some] = np.column_stack([x, y, np.maximum.reduceat(right, first) - x + 1, np.maximum.reduceat(low, first) - y])
    return out


def by_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, np.ndarray | pa.Array]], drop: list[str], more: str) -> DataFrame:
    """`df` less `drop` with the columns that fn gives for each batch (`more`: their names and types)."""
    kept = [c for c in df.columns if c not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = fn(b)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *(v if isinstance(v, pa.Array) else pa.array(v) for v in made.values())], names=[*kept, *made])

    return df.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept), more]))


def union(spans: Spans, size: np.ndarray) -> Spans:
    """Spans of each mask, in any order, as sorted disjoint ones; touching ones are joined, empty ones are gone."""
    stretch = int(size.max(initial=0)) + 1
    some = spans.end > spans.start
    row, start, end = spans.row[some], spans.start[some], spans.end[some]
    at = row * stretch + start
    order = np.argsort(at, kind="stable")
    row, at, reach = row[order], at[order], np.maximum.accumulate((row * stretch + end)[order]) if len(order) else end
    new = np.ones(len(order), bool)
    new[1:] = at[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(order))[: len(first)] - 1
    return Spans(row[first], at[first] - row[first] * stretch, reach[last] - row[first] * stretch, spans.n)


def rectangles(row: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, height: np.ndarray, width: np.ndarray) -> Spans:
    """Columns of filled rectangles, each within the mask of its row; they may touch or overlap."""
    h, w = height[row], width[row]
    x1, y1, x2, y2 = np.maximum(x1, 0), np.maximum(y1, 0), np.minimum(x2, w), np.minimum(y2, h)
    times = np.where(y2 > y1, np.maximum(x2 - x1, 0), 0)
    of = np.repeat(np.arange(len(row)), times)
    at = (x1[of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)) * h[of]
    return Spans(row[of], at + y1[of], at + y2[of], len(height))


def runs_of(spans: Spans, size: np.ndarray) -> pa.ListArray:
    """Run lengths of masks of `size` pixels from sorted, disjoint spans."""
    times = np.bincount(spans.row, minlength=spans.n)
    first = np.concatenate([[0], np.cumsum(times)])
    before = np.concatenate([[0], spans.end[:-1]])[: len(spans.row)]
    before[first[:-1][times > 0]] = 0
    tail = size.astype(np.int64).copy()
    tail[times > 0] -= spans.end[first[1:][times > 0] - 1]
    has_tail = (tail > 0) | (times == 0)
    offsets = np.concatenate([[0], np.cumsum(2 * times + has_tail)])
    out = np.empty(offsets[-1], np.int32)
    at = offsets[spans.row] + 2 * (np.arange(len(spans.row)) - first[spans.row])
    out[at], out[at + 1] = spans.start - before, spans.end - spans.start
    out[offsets[1:][has_tail] - 1] = tail[has_tail]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out))


#: Polygons are walked on a grid this much finer: a fixed value of the format's rule.
FINER = 5


def _whole(x: np.ndarray) -> np.ndarray:
    return np.trunc(x).astype(np.int64)


def from_polygons(polygons: pa.Array, height: np.ndarray, width: np.ndarray) -> pa.ListArray:
    """Runs of the union of each row's polygons (lists of x, y, x, y, ...), by the rule of the COCO format.

    Corners are rounded on a grid FINER times finer, edges walked along their longer axis; where a walk steps from one fine column to the next in the
    middle of a pixel's column, the boundary crosses it, and crossings of a column pair up into spans. Only these steps are worked out, none of the
    walk between them. Nothing of an image's size is made. Null and polygons of fewer than three corners are empty.
    """
    n = len(polygons)
    of_row = np.repeat(np.arange(n), np.asarray(pc.fill_null(pc.list_value_length(polygons), 0)))
    flat = polygons.flatten()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(flat), 0)).astype(np.int64)
    xy = np.asarray(flat.flatten().cast(pa.float64()))
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    of_row, first, corners = of_row[sizes >= 6], first[sizes >= 6], sizes[sizes >= 6] // 2
    poly = np.repeat(np.arange(len(corners)), corners)
    k = np.arange(len(poly)) - np.repeat(np.cumsum(corners) - corners, corners)
    fine = lambda axis, k: _whole(FINER * xy[first[poly] + 2 * k + axis] + 0.5)
    x0, y0, x1, y1 = fine(0, k), fine(1, k), fine(0, (k + 1) % corners[poly]), fine(1, (k + 1) % corners[poly])
    dx, dy = np.abs(x1 - x0), np.abs(y1 - y0)
    flat_edge = dx >= dy
    back = np.where(flat_edge, x0 > x1, y0 > y1)  # an edge is walked upwards on its longer axis, and its points turned round again
    a, b, c, d = (np.where(back, q, p) for p, q in ((x0, x1), (y0, y1), (x1, x0), (y1, y0)))
    long = np.maximum(dx, dy)
    slope = np.divide(np.where(flat_edge, d - b, c - a), long, out=np.zeros(len(long)), where=long > 0)
    # a step is from fine column FINER * c + half to the next one, or back; c is a pixel's column of the image
    half = FINER // 2
    left = np.maximum(-((half - np.minimum(a, c)) // FINER), 0)
    right = np.minimum((np.maximum(a, c) - half - 1) // FINER, width[of_row[poly]] - 1)
    times = np.maximum(right - left + 1, 0)
    edge = np.repeat(np.arange(len(long)), times)
    column = left[edge] + np.arange(len(edge)) - np.repeat(np.cumsum(times) - times, times)
    fine_column, slope, wide = FINER * column + half, slope[edge], flat_edge[edge]
    a, b, of = a[edge], b[edge], poly[edge]
    along = lambda base, t: _whole(base + slope * t + 0.5)
    # a flat edge steps at every point; a steep one steps up to the first point that is past the step, which rounding may put beside the reckoned one
    t = np.where(wide, fine_column - a, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        guess = np.where(wide, 0, np.ceil((fine_column + 0.5 - a) / slope))
    near = np.maximum(guess.astype(np.int64) - 1, 1)
    past = lambda t: (along(a, t) > fine_column) == (slope > 0)
    near += ~past(near)
    near += ~past(near)
    v = np.where(wide, np.minimum(along(b, t), along(b, t + 1)), near - 1 + b)
    row = of_row[of]
    y = np.ceil(np.clip((v + 0.5) / FINER - 0.5, 0, height[row])).astype(np.int64)
    at = column * height[row] + y
    size = (height * width).astype(np.int64)
    # crossings of a polygon pair up in order; one without a partner runs to the end of the image
    stretch = int(size.max(initial=0)) + 1
    of, at = np.divmod(np.sort(of * stretch + at), stretch)
    new = np.append(True, of[1:] != of[:-1])[: len(of)]
    place = np.arange(len(of)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    opens = np.flatnonzero(place % 2 == 0)
    closes = np.minimum(opens + 1, max(0, len(of) - 1))
    paired = (opens + 1 < len(of)) & (of[closes] == of[opens])
    rows = of_row[of[opens]]
    spans = Spans(rows, at[opens], np.where(paired, at[closes], size[rows]), n)
    return runs_of(union(spans, size), size)


def from_texts(texts: pa.Array) -> pa.ListArray:
    """Runs of compressed strings: five bits a character, differences to the run two before from the fourth run on."""
    plain = pc.fill_null(texts, "")
    lengths = np.asarray(pc.binary_length(plain)).astype(np.int64)
    code = np.frombuffer("".join(plain.to_pylist()).encode(), np.uint8).astype(np.int64) - 48
    last = (code & 32) == 0
    number = np.concatenate([[0], np.cumsum(last)[:-1]]) if len(code) else np.zeros(0, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], last[:-1]])) if len(code) else np.zeros(0, np.int64)
    shift = 5 * (np.arange(len(code)) - begin[number])
    value = np.zeros(len(begin), np.int64)
    np.add.at(value, number, (code & 31) << shift)
    end = np.flatnonzero(last)
    value -= np.where(code[end] & 16, np.int64(1) << (shift[end] + 5), 0)
    row = np.repeat(np.arange(len(lengths)), lengths)[end]
    times = np.bincount(row, minlength=len(lengths))
    offsets = np.concatenate([[0], np.cumsum(times)])
    place = np.arange(len(row)) - offsets[row]
    # odd places add up from 1 on, even ones from 2 on; place 0 stands alone
    chain = np.where(place == 0, 0, 1 + (place % 2 == 0))
    order = np.lexsort((place, chain, row))
    total = np.cumsum(value[order])
    key = row[order] * 3 + chain[order]
    start = np.searchsorted(key, key)
    out = np.empty(len(row), np.int64)
    out[order] = total - np.where(start > 0, total[start - 1], 0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out.astype(np.int32)))
