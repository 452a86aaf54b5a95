"""Group-local algorithms in batches: many small groups share one Python call."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str, order: list[str]) -> DataFrame:
    """Apply fn(rows, starts) to batches of whole groups.

    Rows of a partition are sorted by keys and `order`, so a group is a run of rows; `starts` holds the first row
    of each group and the end. A group that a batch cuts waits for the next batch. A group (a frame, an image)
    has to fit in memory, a partition has not. A window over the keys asks for that order: rows that a join has dealt out by the
    keys are not shuffled again.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order or keys)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # batches of the group that is not complete yet
        for batch in batches:
            if len(batch) == 0:
                continue
            batch = batch.drop(columns="__number")
            new = np.zeros(len(batch), bool)
            new[0] = bool(held) and any(held[-1][k].iloc[-1] != batch[k].iloc[0] for k in keys)
            for k in keys:
                col = batch[k].to_numpy()
                new[1:] |= col[1:] != col[:-1]
            cuts = np.flatnonzero(new)
            if len(cuts) == 0:
                held.append(batch)
                continue
            before, last = sum(map(len, held)), int(cuts[-1])
            rows = pd.concat([*held, batch.iloc[:last]], ignore_index=True)
            yield fn(rows, np.concatenate([[0], cuts + before]))
            held = [batch.iloc[last:]]
        if held:
            rows = pd.concat(held, ignore_index=True)
            yield fn(rows, np.array([0, len(rows)]))

    return df.withColumn("__number", number).mapInPandas(run, schema)


def group_of(starts: np.ndarray) -> np.ndarray:
    """The group's number of every row."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def repeated_in(group: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Numbers of the groups in which a value of one of the columns occurs more than once."""
    found = [np.zeros(0, np.int64)]
    for x in columns:
        order = np.lexsort((x, group))
        g, v = group[order], x[order]
        found.append(g[1:][(g[1:] == g[:-1]) & (v[1:] == v[:-1])])
    return np.unique(np.concatenate(found))


def best_pairs(a: np.ndarray, b: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of the assignment of a to b that maximises the summed value (above 0) of each group. A group in which nothing is
    wanted twice keeps all its rows; of the others small ones are solved together, the rest one by one."""
    group = group_of(starts)
    hard = repeated_in(group, a, b)
    keep = ~np.isin(group, hard)
    chosen, hard = small_assignments(a, b, value, group, hard)
    keep[chosen] = True
    for k in hard.tolist():
        lo, hi = int(starts[k]), int(starts[k + 1])
        x, xi = np.unique(a[lo:hi], return_inverse=True)
        y, yi = np.unique(b[lo:hi], return_inverse=True)
        cost, where = np.zeros((len(x), len(y))), np.full((len(x), len(y)), -1)
        cost[xi, yi], where[xi, yi] = -value[lo:hi], np.arange(lo, hi)
        chosen = where[hungarian(cost)]
        keep[chosen[chosen >= 0]] = True
    return np.flatnonzero(keep)


#: The largest side of a group of which all assignments are tried, and how many groups at once.
SIDE, AT_ONCE = 5, 2_048


def small_assignments(a: np.ndarray, b: np.ndarray, value: np.ndarray, group: np.ndarray, hard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the best assignment of each small group of `hard`, the groups that are left): all assignments of many groups are added up at once.

    Left are groups with a side above SIDE or a value that is not above 0, and those in which other pairs come within rounding of the best sum.
    """
    rows = np.flatnonzero(np.isin(group, hard))
    if not len(rows):
        return rows, hard
    at = np.searchsorted(hard, group[rows])
    place, side = [], np.zeros(len(hard), np.int64)
    for x in (a[rows], b[rows]):
        order = np.lexsort((x, at))
        first = np.concatenate([[True], at[order][1:] != at[order][:-1]])
        step = np.cumsum(np.concatenate([[True], x[order][1:] != x[order][:-1]]) | first)
        own = np.empty(len(rows), np.int64)
        own[order] = step - step[first][np.cumsum(first) - 1]
        place.append(own)
        np.maximum.at(side, at, own + 1)
    good = np.ones(len(hard), bool)
    good[at[~((value[rows] > 0) & np.isfinite(value[rows]))]] = False
    solved, chosen = np.zeros(len(hard), bool), [np.zeros(0, np.int64)]
    for k in range(2, SIDE + 1):
        orders = np.array(list(permutations(range(k))))
        own = np.flatnonzero(good & (side == k))
        for some in (own[lo : lo + AT_ONCE] for lo in range(0, len(own), AT_ONCE)):
            inside = np.flatnonzero(np.isin(at, some))
            g, x, y = np.searchsorted(some, at[inside]), place[0][inside], place[1][inside]
            worth, bit, where = np.zeros((len(some), k, k)), np.zeros((len(some), k, k), np.int64), np.full((len(some), k, k), -1)
            worth[g, x, y], bit[g, x, y], where[g, x, y] = value[rows[inside]], np.int64(1) << (x * k + y), rows[inside]
            total, pairs = (sum(m[:, i, orders[:, i]] for i in range(k)) for m in (worth, bit))
            best, n = total.argmax(axis=1), np.arange(len(some))
            near = total >= total[n, best, None] * (1 - 1e-9)
            clear = ~(near & (pairs != pairs[n, best, None])).any(axis=1)
            solved[some[clear]] = True
            got = where[n[:, None], np.arange(k), orders[best]][clear]
            chosen.append(got[got >= 0])
    return np.concatenate(chosen), hard[~solved]


def hungarian(cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a least-cost assignment of min(n, m) pairs (shortest augmenting paths)."""
    if cost.size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    turned = cost.shape[0] > cost.shape[1]
    c = cost.T if turned else cost
    n, m = c.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    match, way = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        best, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = match[j0]
            free = np.flatnonzero(~used[1:]) + 1
            reduced = c[i0 - 1, free - 1] - u[i0] - v[free]
            closer = reduced < best[free]
            best[free[closer]] = reduced[closer]
            way[free[closer]] = j0
            j1 = free[np.argmin(best[free])]
            delta = best[j1]
            u[match[used]] += delta
            v[used] -= delta
            best[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            j1 = way[j0]
            match[j0] = match[j1]
            j0 = j1
    cols = np.flatnonzero(match[1:])
    rows = match[1:][cols] - 1
    by = np.argsort(rows)
    rows, cols = rows[by], cols[by]
    return (cols, rows) if turned else (rows, cols)
