"""Exact percentiles by rank refinement: sketches bracket a rank, a scan counts inside.

A first scan leaves one quantile sketch per column, of which a grid of steps is read.
Each wanted rank lies, nearly always, between two steps around it: its bracket. The
next scan counts what is below, inside and above the brackets, and the values inside
them one by one. Brackets that would hold too many values are sketched again first.
What the sketch promised is checked by the counts: a rank outside its bracket is
looked for in the gap where the counts place it, so the result is always exact.

The driver holds a grid and a few ranks per column, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Steps of the grid read from a sketch. With SKETCH_K a rank is off by some 0.2 %,
# half a step, hence a bracket goes one step beyond the step of its rank.
GRID = 256
SKETCH_K = 2048
# Brackets of at most this many values are counted value by value.
LEAF = 1 << 17

Bracket = tuple[float, float]


def sketch_grid(value: str | Column) -> Column:
    """Aggregate: the value at each of ``GRID`` + 1 evenly spaced ranks, null if none."""
    column = F.col(value) if isinstance(value, str) else value
    ranks = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return F.when(F.count(column) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(column, SKETCH_K), ranks))


def around(grid: Sequence[float], share: float) -> Bracket:
    """The steps of a grid between which a rank lies, and one more to each side."""
    step = min(int(share * GRID), GRID - 1)
    return grid[max(step - 1, 0)], grid[min(step + 2, GRID)]


@dataclass
class _Search:
    """The ranks of one column that are still open, and where they may be."""

    ranks: list[int]
    brackets: list[tuple[float, float, float]]  # low, high, rows expected
    found: dict[int, float] = field(default_factory=dict)

    def edges(self) -> list[Bracket]:
        """The brackets in order, those that meet made one."""
        merged: list[Bracket] = []
        for low, high, _ in sorted(self.brackets):
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        return merged


def _placed(cells: DataFrame, searches: dict[str, _Search]) -> tuple[DataFrame, dict[str, list[Bracket]]]:
    """(column, value, segment): segment 2i + 1 is bracket i of the column, the even
    ones are the gaps around them; only columns with open ranks."""
    edges = {c: s.edges() for c, s in searches.items()}
    width = max(len(e) for e in edges.values())
    rows = []
    for c, pairs in edges.items():
        padded = [*pairs, *[(None, None)] * (width - len(pairs))]
        rows.append((c, *[bound for pair in padded for bound in pair]))
    bounds = ", ".join(f"_low{i} double, _high{i} double" for i in range(width))
    table = cells.sparkSession.createDataFrame(rows, f"column string, {bounds}")
    value = F.col("value")
    passed = [test for i in range(width) for test in (value >= F.col(f"_low{i}"), value > F.col(f"_high{i}"))]
    segment = reduce(add, [F.coalesce(test, F.lit(False)).cast("int") for test in passed])
    # One row per column.
    placed = cells.filter(value.isNotNull()).join(F.broadcast(table), "column")
    return placed.select("column", "value", segment.alias("segment")), edges


def _gap(edges: list[Bracket], segment: int) -> Bracket:
    """The closed range of doubles between two brackets."""
    i = segment // 2
    low = math.nextafter(edges[i - 1][1], math.inf) if i > 0 else -math.inf
    high = math.nextafter(edges[i][0], -math.inf) if i < len(edges) else math.inf
    return low, high


def _sketch(cells: DataFrame, searches: dict[str, _Search]) -> None:
    """Replace each column's brackets by narrower ones; one scan."""
    placed, edges = _placed(cells, searches)
    inside = F.when(F.col("segment") % 2 == 1, F.col("value"))
    counts = placed.groupBy("column", "segment").agg(F.count("*").alias("n"), sketch_grid(inside).alias("grid"))
    found: dict[str, dict] = {c: {} for c in searches}
    for row in counts.collect():
        found[row["column"]][row["segment"]] = (row["n"], row["grid"])
    for c, search in searches.items():
        search.brackets = []
        below = {}
        total = 0
        for segment in sorted(found[c]):
            below[segment] = total
            total += found[c][segment][0]
        for rank in search.ranks:
            segment = max(s for s in below if below[s] <= rank)
            n, grid = found[c][segment]
            if grid is None:
                search.brackets.append((*_gap(edges[c], segment), n))
                continue
            low, high = around(grid, (rank - below[segment]) / n)
            if (low, high) == edges[c][segment // 2] and low < high:
                # Nearly all rows hold one of the two values; the rest is a gap then.
                search.brackets += [(low, low, 0), (high, high, 0)]
            else:
                search.brackets.append((low, high, 0 if low == high else 4 * n / GRID))


def _count(cells: DataFrame, searches: dict[str, _Search]) -> None:
    """Look the ranks up among the values inside the brackets; one scan.

    A rank that falls into a gap, where its sketch missed it, stays open with that
    gap as its bracket.
    """
    placed, edges = _placed(cells, searches)
    inside = F.when(F.col("segment") % 2 == 1, F.col("value")).alias("value")
    counts = placed.groupBy("column", "segment", inside).agg(F.count("*").alias("n"))
    # A few brackets of LEAF values each per column, and a row for every gap.
    smaller = Window.partitionBy("column").orderBy("segment", "value").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.withColumn("before", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
    wanted = cells.sparkSession.createDataFrame(
        [(c, rank) for c, search in searches.items() for rank in search.ranks], "column string, rank bigint"
    )
    here = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    # A few ranks per column.
    hits = runs.join(F.broadcast(wanted), "column").filter(here).collect()
    for search in searches.values():
        search.brackets = []
    for hit in hits:
        search = searches[hit["column"]]
        if hit["segment"] % 2 == 1:
            search.found[hit["rank"]] = hit["value"]
            search.ranks.remove(hit["rank"])
        else:
            search.brackets.append((*_gap(edges[hit["column"]], hit["segment"]), hit["n"]))


def _ranks(n: int, probabilities: Sequence[float]) -> list[int]:
    positions = [p * (n - 1) for p in probabilities]
    return sorted({bound(position) for position in positions for bound in (math.floor, math.ceil)})


def refine(
    cells: DataFrame,
    grids: dict[str, tuple[int, Sequence[float]]],
    probabilities: Sequence[float],
    leaf: int = LEAF,
) -> dict[str, list[float | None]]:
    """Linearly interpolated percentiles per column of (column, value) cells.

    ``grids`` has the count of each column's values and their ``sketch_grid``. Nulls
    are skipped; a column without values has None. One scan where brackets hold
    ``leaf`` values at most, one more for each further factor of some 60.
    """
    searches: dict[str, _Search] = {}
    for c, (n, grid) in grids.items():
        if n == 0:
            continue
        ranks = _ranks(n, probabilities)
        if n <= leaf:
            brackets = [(grid[0], grid[-1], n)]
        else:
            pairs = {around(grid, rank / n) for rank in ranks}
            brackets = [(low, high, 0 if low == high else 4 * n / GRID) for low, high in sorted(pairs)]
        searches[c] = _Search(ranks, brackets)
    everything = dict(searches)
    while searches:
        wide = {c: s for c, s in searches.items() if any(n > leaf for _, _, n in s.brackets)}
        if wide:
            _sketch(cells, wide)
        else:
            _count(cells, searches)
            searches = {c: s for c, s in searches.items() if s.ranks}

    def percentile(c: str, p: float) -> float | None:
        if c not in everything:
            return None
        position = p * (grids[c][0] - 1)
        low, high = (everything[c].found[bound(position)] for bound in (math.floor, math.ceil))
        # Equal infinities have no difference.
        return low if low == high else low + (high - low) * (position - math.floor(position))

    return {c: [percentile(c, p) for p in probabilities] for c in grids}
