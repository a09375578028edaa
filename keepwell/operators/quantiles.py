"""Exact quantiles and quantile bins on data of any size.

``percentile`` keeps every distinct value in one task and ``ntile`` needs one
global sort. Here each wanted order statistic is closed in by counting: its
bracket is cut into bins of equal width, the tasks count rows and note the least
and greatest value of every bin, and the bin that holds the position is the
next bracket. Brackets of few rows are read out. Nothing but bin counts
leaves the tasks, so no task ever holds a column, and a handful of passes
suffices for 10**12 rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

BINS = 1024
#: Rows of a bracket that is read out.
FEW = 4096
_INF = float("inf")


def _as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass
class _Bracket:
    """Values low..high, with the rows below and inside and the positions (0-based) looked for inside."""

    low: float
    high: float
    below: int
    rows: int
    positions: list[int]

    def bin(self, c: Column) -> Column:
        """Bins are monotone in the value; infinities and NaN, which Spark sorts last, have bins of their own."""
        half = max(self.high / 2 - self.low / 2, 5e-324)
        at = F.floor((c / 2 - self.low / 2) / half * BINS)
        return (F.when(F.isnan(c), BINS + 1).when(c == _INF, BINS).when(c == -_INF, -1)
                .otherwise(F.least(F.greatest(at, F.lit(0)), F.lit(BINS - 1)))).cast("int")


def _counted(df: DataFrame, columns: Mapping[str, Column], brackets: Mapping[str, list[_Bracket]], by_value: bool) -> list:
    """Rows per bracket and bin, or per bracket and value."""
    cells = []
    for name, own in brackets.items():
        c, which, cut = columns[name], F.lit(None), F.lit(None)
        for k, b in enumerate(own):
            whole = F.lit(True) if b.low == -_INF else c.between(b.low, b.high)
            which = F.when(c.isNotNull() & whole, k).otherwise(which)
            cut = F.when(whole, b.bin(c)).otherwise(cut) if not by_value else cut
        cells.append(F.struct(F.lit(name).alias("name"), which.cast("int").alias("bracket"), cut.cast("int").alias("bin"), c.alias("v")))
    rows = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").filter("bracket is not null")
    if by_value:
        return rows.groupBy("name", "bracket", "v").agg(F.count(F.lit(1)).alias("n")).collect()      # few rows a bracket
    return rows.groupBy("name", "bracket", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()


def order_statistics(df: DataFrame, columns: Mapping[str, Column], positions) -> tuple[dict[str, int], dict[tuple[str, int], float]]:
    """Rows per column, and the values at 0-based positions of the sorted column.

    ``positions`` gives the wanted positions from the number of rows.
    """
    ends = df.agg(*[e for name, c in columns.items() for e in (F.count(c).alias(f"{name}#n"), F.min(c).alias(f"{name}#low"), F.max(c).alias(f"{name}#high"),
                    *(f(F.when(F.abs(c) < _INF, c)).alias(f"{name}#{k}") for k, f in (("flow", F.min), ("fhigh", F.max))))]).first()
    counts = {name: ends[f"{name}#n"] for name in columns}
    found: dict[tuple[str, int], float] = {}
    open_brackets: dict[str, list[_Bracket]] = {}
    for name, n in counts.items():
        wanted = sorted(set(positions(n))) if n else []
        if wanted:
            low, high = ends[f"{name}#low"], ends[f"{name}#high"]
            finite = abs(low) < _INF and abs(high) < _INF
            first = _Bracket(low, high, 0, n, wanted) if finite else _Bracket(ends[f"{name}#flow"] or 0.0, ends[f"{name}#fhigh"] or 0.0, 0, n, wanted)
            open_brackets[name] = [first]
            if not finite:
                # the first pass bins all rows, the infinite ones beside the range
                open_brackets[name] = _closer(_counted(df, columns, {name: [_Everything(first)]}, False), {name: [first]}, found).get(name, [])
    while any(open_brackets.values()):
        narrow = {name: [b for b in own if b.rows <= FEW] for name, own in open_brackets.items()}
        narrow = {name: own for name, own in narrow.items() if own}
        if narrow:
            _read_out(_counted(df, columns, narrow, True), narrow, found)
        wide = {name: [b for b in own if b.rows > FEW] for name, own in open_brackets.items()}
        wide = {name: own for name, own in wide.items() if own}
        open_brackets = _closer(_counted(df, columns, wide, False), wide, found) if wide else {}
    return counts, found


class _Everything(_Bracket):
    """A bracket that also holds infinities and NaN."""

    def __init__(self, b: _Bracket):
        super().__init__(-_INF, _INF, b.below, b.rows, b.positions)
        self._range = b

    def bin(self, c: Column) -> Column:
        return self._range.bin(c)


def _closer(rows: list, brackets: Mapping[str, list[_Bracket]], found: dict) -> dict[str, list[_Bracket]]:
    """The bins that hold positions, as brackets; a bin of one value answers its positions."""
    bins: dict[tuple[str, int], list] = {}
    for r in rows:
        bins.setdefault((r["name"], r["bracket"]), []).append((r["bin"], r["n"], r["low"], r["high"]))
    out: dict[str, list[_Bracket]] = {}
    for name, own in brackets.items():
        for k, b in enumerate(own):
            below = b.below
            for _, n, low, high in sorted(bins[name, k]):
                inside = [p for p in b.positions if below <= p < below + n]
                if inside and (low == high or low != low):
                    found.update({(name, p): low for p in inside})
                elif inside:
                    out.setdefault(name, []).append(_Bracket(low, high, below, n, inside))
                below += n
    return out


def _read_out(rows: list, brackets: Mapping[str, list[_Bracket]], found: dict) -> None:
    values: dict[tuple[str, int], list] = {}
    for r in rows:
        values.setdefault((r["name"], r["bracket"]), []).append((r["v"], r["n"]))
    for name, own in brackets.items():
        for k, b in enumerate(own):
            below = b.below
            for v, n in sorted(values[name, k], key=lambda x: (x[0] != x[0], x[0])):
                found.update({(name, p): v for p in b.positions if below <= p < below + n})
                below += n


def exact_quantiles(df: DataFrame, columns: Mapping[str, str | Column],
                    qs: Sequence[Fraction]) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles per named column, NULLs ignored.

    A column without values gives ``None``. Positions ``q * (n - 1)`` are
    computed with integers, so no bin edge depends on floating-point noise.
    """
    columns = {name: _as_column(c).cast("double") for name, c in columns.items()}
    qs = [Fraction(q) for q in qs]
    counts, at = order_statistics(df, columns, lambda n: [p for q in qs for p in _positions(q, n)])
    out: dict[str, list[float] | None] = {}
    for name, n in counts.items():
        values = []
        for q in qs if n else ():
            low, high = _positions(q, n)
            a, b = at[name, low], at[name, high]
            values.append(a if a == b else a + (b - a) * float(q * (n - 1) - low))
        out[name] = values if n else None
    return out


def _positions(q: Fraction, n: int) -> tuple[int, int]:
    pos = q * (n - 1)
    low = pos.numerator // pos.denominator
    return low, low if pos.denominator == 1 else low + 1


def exact_median(df: DataFrame, column: str | Column) -> float | None:
    found = exact_quantiles(df, {"m": column}, [Fraction(1, 2)])["m"]
    return None if found is None else found[0]


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    found = exact_quantiles(df, {c: c for c in columns}, [Fraction(1, 2)])
    return {c: None if v is None else v[0] for c, v in found.items()}


def quantile_edges(df: DataFrame, column: str | Column, bins: int) -> list[float]:
    """Distinct bin edges, lowest value first."""
    edges = exact_quantiles(df, {"e": column}, [Fraction(i, bins) for i in range(bins + 1)])["e"]
    if edges is None:
        raise ValueError("no values to bin")
    return sorted(set(edges))


def bin_index(value: Column, edges: Sequence[float]) -> Column:
    """0-based right-closed bin; the lowest value falls in the first bin."""
    index = F.lit(0)
    for edge in edges[1:-1]:
        index = index + (value > edge).cast("int")
    return F.when(value.isNotNull(), index).cast("int")
