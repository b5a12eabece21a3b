"""Exact medians of many columns without sorting a column in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import number, quoted

SETTLE_VALUES = 10_000  # a bracket of at most this many values is read and sorted
SKETCH_STEPS = 500  # each pass narrows a bracket to about three of so many steps
SKETCH_ACCURACY = 2_500
BRACKETS_PER_PASS = 100
SKETCHES_PER_ROW = 10


@dataclass
class _Search:
    """The value of rank ``rank`` (from 0) lies strictly between ``lo`` and ``hi``."""

    column: str
    rank: int
    left_out: int | None = None  # the fold whose rows do not count
    lo: float | None = None
    hi: float | None = None
    below: int = 0  # values <= lo
    inside: int = 0  # values in (lo, hi)
    held: int = 0  # the same, with the fold that is left out
    value: float | None = None

    def bracket(self) -> str:
        """The value where it lies in the bracket, else null."""
        x, tests = _number(self.column), []
        if self.lo is not None:
            tests.append(f"{x} > {number(self.lo)}")
        if self.hi is not None:
            tests.append(f"{x} < {number(self.hi)}")
        return f"(CASE WHEN {' AND '.join(tests)} THEN {x} END)" if tests else x


def _number(column: str) -> str:
    x = f"double({quoted(column)})"
    return f"(CASE WHEN NOT isnan({x}) THEN {x} END)"


def _shared(searches: list[_Search]) -> list[list[_Search]]:
    """Searches with the same bracket, whatever fold they leave out."""
    brackets: dict[tuple, list[_Search]] = {}
    for s in searches:
        brackets.setdefault((s.column, s.lo, s.hi), []).append(s)
    return list(brackets.values())


def _values(df: DataFrame, members: list[list[_Search]], fold: str) -> DataFrame:
    # One row per (bracket, value) inside: few of a table's values, so only these leave their row.
    inside = [(i, m[0].bracket()) for i, m in enumerate(members)]
    pairs = ", ".join(f"CASE WHEN {x} IS NOT NULL THEN struct({i} AS i, {x} AS x) END" for i, x in inside)
    return df.selectExpr(f"{fold} AS f", f"inline(array_compact(array({pairs})))")


def _steps(df: DataFrame, members: list[list[_Search]]) -> list[list[float]]:
    """The sketched steps of the values in each bracket.

    Some brackets share a row and a reducer: a row for each would cost more than its sketch, and all in one row would
    send the sketches of all tasks to one reducer.
    """
    groups = [members[at : at + SKETCHES_PER_ROW] for at in range(0, len(members), SKETCHES_PER_ROW)]
    wide = min(len(members), SKETCHES_PER_ROW)
    rows = []
    for g, own in enumerate(groups):
        values = [m[0].bracket() for m in own] + ["double(null)"] * (wide - len(own))
        rows.append(f"struct({g} AS g, " + ", ".join(f"{x} AS x{j}" for j, x in enumerate(values)) + ")")
    shares = ", ".join(number(j / SKETCH_STEPS) for j in range(SKETCH_STEPS + 1))
    sketches = [F.expr(f"percentile_approx(x{j}, array({shares}), {SKETCH_ACCURACY}) AS s{j}") for j in range(wide)]
    found = {r["g"]: r for r in df.selectExpr(f"inline(array({', '.join(rows)}))").groupBy("g").agg(*sketches).collect()}
    return [found[g][f"s{j}"] for g, own in enumerate(groups) for j in range(len(own))]


def _narrow(df: DataFrame, searches: list[_Search], fold: str) -> None:
    members = _shared(searches)
    steps = _steps(df, members)
    bounds = []
    for i, m in enumerate(members):
        at = [(s.rank - s.below) * SKETCH_STEPS / max(s.inside - 1, 1) for s in m]
        low, high = steps[i][max(int(min(at)) - 1, 0)], steps[i][min(int(max(at)) + 2, SKETCH_STEPS)]
        bounds.append((low, high))
    # Counted per fold: what a fold leaves out is taken from the sum over all of them.
    counts = []
    for i, (low, high) in enumerate((number(a), number(b)) for a, b in bounds):
        tests = [f"x{i} < {low}", f"x{i} = {low}", f"x{i} > {low} AND x{i} < {high}", f"x{i} = {high} AND x{i} > {low}"]
        counts += [F.expr(f"count_if({t}) AS n{i}_{j}") for j, t in enumerate(tests)]
    values = df.selectExpr(f"{fold} AS f", *[f"{m[0].bracket()} AS x{i}" for i, m in enumerate(members)])
    parts: dict[int, dict[int, list[int]]] = {i: {} for i in range(len(members))}
    for r in values.groupBy("f").agg(*counts).collect():
        for i in parts:
            parts[i][r["f"]] = [r[f"n{i}_{j}"] for j in range(4)]
    for i, m in enumerate(members):
        for s in m:
            every = [sum(c) for c in zip(*parts[i].values())]
            _settle(s, *bounds[i], *[n - own for n, own in zip(every, parts[i].get(s.left_out, [0] * 4))], every)


def _settle(
    s: _Search, low: float, high: float, under: int, at_low: int, between: int, at_high: int, every: list[int]
) -> None:
    want = s.rank - s.below
    if want < under:
        s.hi, s.inside, s.held = low, under, every[0]
    elif want < under + at_low:
        s.value = low
    elif want < under + at_low + between:
        s.lo, s.hi, s.below, s.inside, s.held = low, high, s.below + under + at_low, between, every[2]
    elif want < under + at_low + between + at_high:
        s.value = high
    else:
        passed = under + at_low + between + at_high
        s.lo, s.below, s.inside, s.held = high, s.below + passed, s.inside - passed, s.held - sum(every)


def exact_medians(
    df: DataFrame, cols: Sequence[str], settle_values: int = SETTLE_VALUES
) -> dict[str, float | None]:
    """Exact median per column: the mean of the two middle values, nulls and NaN left out.

    Spark's exact percentile gathers every distinct value in one task. Here sketches of bounded
    size bracket the middle ranks, counting passes prove the bracket (a hot value is settled by its
    count alone), and only a bracket of at most ``settle_values`` values is ever gathered. All
    columns share each pass; it reads only ``cols``.
    """
    return _medians(df, cols, None, [None], settle_values)[None]


def leave_one_out_medians(
    df: DataFrame, cols: Sequence[str], fold: str, folds: Sequence[int], settle_values: int = SETTLE_VALUES
) -> dict[int, dict[str, float | None]]:
    """Fold -> exact medians of the rows outside that fold, as :func:`exact_medians` gives them for these rows.

    All folds share the passes: the medians of the training parts of a table lie close together, so
    they have one bracket, and what lies below it is counted per fold and summed without the one left out.
    """
    return _medians(df, cols, fold, list(folds), settle_values)


def _medians(
    df: DataFrame, cols: Sequence[str], fold: str | None, left_out: list[int | None], settle_values: int
) -> dict[int | None, dict[str, float | None]]:
    cols = list(dict.fromkeys(cols))
    out: dict[int | None, dict[str, float | None]] = {g: dict.fromkeys(cols) for g in left_out}
    if not cols:
        return out
    own = "0" if fold is None else quoted(fold)
    df = df.select(*[quoted(c) for c in cols if c != fold], *([] if fold is None else [own]))
    counted = df.groupBy(F.expr(own).alias("f")).agg(*[F.expr(f"count({_number(c)}) AS n{i}") for i, c in enumerate(cols)])
    counts = counted.collect()  # a row per fold
    searches = []
    for i, c in enumerate(cols):
        for g in left_out:
            n, every = (sum(r[f"n{i}"] for r in counts if f is None or r["f"] != f) for f in (g, None))
            searches += [_Search(c, rank, g, inside=n, held=every) for rank in sorted({(n - 1) // 2, n // 2}) if n]
    while wide := [s for s in searches if s.value is None and s.held > settle_values]:
        shared = _shared(wide)
        for start in range(0, len(shared), BRACKETS_PER_PASS):
            _narrow(df, [s for m in shared[start : start + BRACKETS_PER_PASS] for s in m], own)
    near = _shared([s for s in searches if s.value is None])
    if near:
        # Only the wanted values come back.
        held = _values(df, near, own).groupBy("i").agg(F.expr("sort_array(collect_list(struct(x, f))) AS v"))
        wanted = {i: sorted({(s.left_out, s.rank - s.below) for s in m}, key=str) for i, m in enumerate(near)}
        asks = [(i, g, at) for i, asked in wanted.items() for g, at in asked]
        asked = df.sparkSession.createDataFrame(asks, "i int, g int, at int")
        others = "filter(v, e -> g IS NULL OR NOT e.f <=> g)"
        found = held.join(F.broadcast(asked), "i").selectExpr("i", "g", "at", f"get({others}, at).x AS x").collect()
        value = {(r["i"], r["g"], r["at"]): r["x"] for r in found}
        for i, m in enumerate(near):
            for s in m:
                s.value = value[i, s.left_out, s.rank - s.below]
    for g in left_out:
        for c in cols:
            middle = [s.value for s in searches if s.column == c and s.left_out == g]
            if middle:
                out[g][c] = (middle[0] + middle[-1]) / 2
    return out
