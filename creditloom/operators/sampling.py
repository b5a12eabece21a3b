"""Exact-size samples, stratified folds and class rebalancing.

All of them rest on one idea: give each row a hash, and find the (hash, key) pair below which
exactly the wanted number of rows lie. The pairs come from a few narrow counting passes; what is
left is a filter or a ``CASE`` on the row itself. Nothing is sorted or shuffled, the result does
not depend on partitioning, and it is the same when a lost task is run again. Only where a cut goes
through rows that are equal in all columns are these counted and laid out anew.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import HashOrder, quoted, text, with_exprs, xxhash_order

SETTLE_ROWS = 10_000  # a hash range of at most this many rows is read to find the exact pair
FANOUT = 1_000
MAX_STRATA = 1_000

Stratum = object


@dataclass(frozen=True)
class _Range:
    """Rows of one stratum with h in [h_lo, h_hi) and, once h is fixed, key in [k_lo, k_hi)."""

    stratum: Stratum
    h_lo: int
    h_hi: int
    k_lo: int
    k_hi: int

    @property
    def on_key(self) -> bool:
        return self.h_hi - self.h_lo == 1

    @property
    def span(self) -> tuple[int, int]:
        return (self.k_lo, self.k_hi) if self.on_key else (self.h_lo, self.h_hi)

    @property
    def step(self) -> int:
        lo, hi = self.span
        return max(1, -(-(hi - lo) // FANOUT))

    def part(self, index: int) -> _Range:
        lo, hi = self.span
        start, end = lo + index * self.step, min(lo + (index + 1) * self.step, hi)
        if self.on_key:
            return replace(self, k_lo=start, k_hi=end)
        return replace(self, h_lo=start, h_hi=end)

    @property
    def test(self) -> str:
        """Holds for the rows of the range, among columns _g, _h and _k."""
        return (
            f"_g <=> {_literal(self.stratum)} AND _h >= {self.h_lo}L AND _h < {self.h_hi}L "
            f"AND _k >= {self.k_lo}L AND _k < {self.k_hi}L"
        )

    @property
    def part_number(self) -> str:
        lo, _ = self.span
        return f"({'_k' if self.on_key else '_h'} - {lo}L) div {self.step}L"


def _literal(value: Stratum) -> str:
    if value is None:
        return "NULL"
    return text(value) if isinstance(value, str) else str(value)


def _case(branches: Sequence[tuple[str, object]], otherwise: object = "NULL") -> str:
    if not branches:
        return str(otherwise)
    return f"CASE {' '.join(f'WHEN {test} THEN {then}' for test, then in branches)} ELSE {otherwise} END"


@dataclass
class _Target:
    rank: int
    where: _Range
    below: int
    count: int


def class_counts(df: DataFrame, label: str) -> dict[Stratum, int]:
    """Rows per label value. Reads the label column only."""
    rows = df.groupBy(label).count().limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise ValueError(f"{label} has more than {MAX_STRATA} values: not a class label")
    return {r[label]: r["count"] for r in rows}


@dataclass(frozen=True)
class _Cut:
    """Rows up to and with the pair (h, k); ``want`` of the rows that have the pair itself, or all if ``None``."""

    h: int
    k: int
    want: int | None = None


def _cuts(
    rows: DataFrame, span: int, ranks: Mapping[Stratum, Sequence[int]]
) -> dict[Stratum, list[_Cut | None]]:
    """For each stratum and rank r: the cut that exactly r rows do not exceed.

    ``None`` stands for "no row" (r <= 0). A rank at or above the stratum's size gives a pair that
    every row is below.
    """
    sizes = {
        r["_g"]: (r["n"], r["k_lo"], r["k_hi"], r["nulls"])
        for r in rows.groupBy("_g")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("_k").alias("k_lo"),
            F.max("_k").alias("k_hi"),
            F.count_if(F.col("_k").isNull()).alias("nulls"),
        )
        .collect()
    }
    if any(nulls for *_, nulls in sizes.values()):
        raise ValueError("there are null keys: they have no place in the order")
    found: dict[tuple[Stratum, int], _Cut | None] = {}
    targets: list[_Target] = []
    for g, wanted in ranks.items():
        n, k_lo, k_hi, _ = sizes.get(g, (0, 0, 0, 0))
        for r in set(wanted):
            if r <= 0:
                found[g, r] = None
            elif r >= n:
                found[g, r] = _Cut(span, 0)
            else:
                targets.append(_Target(r, _Range(g, 0, span, k_lo, k_hi + 1), 0, n))

    def settle(t: _Target, pair: tuple[int, int], below: int, equal: int) -> None:
        want = t.rank - below
        found[t.where.stratum, t.rank] = _Cut(*pair, want if want < equal else None)

    while wide := [t for t in targets if t.count > SETTLE_ROWS]:
        ranges = list({t.where for t in wide})
        which = _case([(w.test, i) for i, w in enumerate(ranges)])
        part = _case([(w.test, w.part_number) for w in ranges])
        split = (
            rows.selectExpr(f"{which} AS i", f"{part} AS p")
            .filter("i IS NOT NULL")
            .groupBy("i", "p")
            .count()
            .collect()
        )
        parts: dict[int, dict[int, int]] = {}
        for r in split:
            parts.setdefault(r["i"], {})[r["p"]] = r["count"]
        for t in wide:
            for p, n in sorted(parts[ranges.index(t.where)].items()):
                if t.rank <= t.below + n:
                    t.where, t.count = t.where.part(p), n
                    break
                t.below += n
        for t in [t for t in wide if t.where.on_key and t.where.k_hi - t.where.k_lo == 1]:
            settle(t, (t.where.h_lo, t.where.k_lo), t.below, t.count)  # one pair, however many rows
            targets.remove(t)

    if targets:
        ranges = list({t.where for t in targets})
        which = _case([(w.test, i) for i, w in enumerate(ranges)])
        pairs: dict[int, list[tuple[int, int]]] = {}
        for r in rows.selectExpr(f"{which} AS i", "_h", "_k").filter("i IS NOT NULL").collect():
            pairs.setdefault(r["i"], []).append((r["_h"], r["_k"]))
        for members in pairs.values():
            members.sort()
        for t in targets:
            members = pairs[ranges.index(t.where)]
            pair = members[t.rank - t.below - 1]
            first = bisect_left(members, pair)
            settle(t, pair, t.below + first, bisect_right(members, pair) - first)
    return {g: [found[g, r] for r in wanted] for g, wanted in ranks.items()}


NTH = "_nth"
_TIE_SPAN = 2**40


def _tie(df: DataFrame) -> str:
    """A hash of the whole row, to order rows of equal keys by."""
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return f"shiftright(xxhash64({', '.join(map(quoted, hashable))}), 1)"  # differences stay within 64 bits


def _numbered(df: DataFrame, chosen: str) -> DataFrame:
    """``df`` with :data:`NTH`: 0, or where ``chosen`` holds the row's number among its equals, from 1.

    Equal rows can stand for each other, so they are counted per partition and row, and laid out again
    from the counts: no task gets all copies of a row.
    """
    rest = df.filter(f"NOT coalesce({chosen}, false)").withColumn(NTH, F.lit(0).cast("bigint"))
    same = df.filter(chosen).withColumn("_part", F.spark_partition_id())
    counted = same.groupBy(*map(quoted, df.columns), "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.expr(_tie(df))).orderBy("_part", *map(quoted, df.columns))
    start = F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    laid = counted.withColumn("_start", start).selectExpr("*", f"explode(sequence(_start + 1, _start + _n)) AS {NTH}")
    return rest.unionByName(laid.select(*map(quoted, df.columns), NTH))


def _ordered(
    df: DataFrame, key: str, order: HashOrder, stratum: str, ranks: Mapping[Stratum, Sequence[int]]
) -> tuple[DataFrame, dict[Stratum, list[str]]]:
    """For each stratum and rank r a condition that exactly r rows meet, first in hash order.

    Rows are ordered by the hash of their key. Where a cut falls between rows of one key, these rows are
    ordered by a hash of the whole row, and where it falls between equal rows, those are numbered: then the
    table comes back with the column :data:`NTH`.
    """
    k, tie = f"bigint({quoted(key)})", _tie(df)
    h, h2 = order.of(k), f"pmod({tie}, {_TIE_SPAN}L)"
    cuts = _cuts(df.selectExpr(f"{stratum} AS _g", f"{k} AS _k", f"{h} AS _h"), order.span, ranks)
    # The pairs that a cut goes through, and how many of their rows it wants.
    pairs: dict[tuple[Stratum, int, int], list[int]] = {}
    for g, own in cuts.items():
        for cut in own:
            if cut is not None and cut.want is not None:
                pairs.setdefault((g, cut.h, cut.k), []).append(cut.want)
    at = {pair: i for i, pair in enumerate(pairs)}
    tests = [(f"({stratum} <=> {_literal(g)} AND {h} = {a}L AND {k} = {b}L)", i) for (g, a, b), i in at.items()]
    inner: dict[Stratum, list[_Cut | None]] = {}
    if pairs:
        equals = df.selectExpr(f"{_case(tests)} AS _g", f"{tie} AS _k", f"{h2} AS _h").filter("_g IS NOT NULL")
        inner = _cuts(equals, _TIE_SPAN, {i: pairs[pair] for pair, i in at.items()})
    within = {(i, want): cut for pair, i in at.items() for want, cut in zip(pairs[pair], inner[i])}
    split = sorted({(i, cut.k) for (i, _), cut in within.items() if cut.want is not None})
    if split:
        df = _numbered(df, " OR ".join(f"({tests[i][0]} AND {tie} = {b}L)" for i, b in split))

    def condition(g: Stratum, cut: _Cut | None) -> str:
        if cut is None:
            return "false"
        if cut.want is None:
            return f"({h} < {cut.h}L OR ({h} = {cut.h}L AND {k} <= {cut.k}L))"
        own = within[at[g, cut.h, cut.k], cut.want]
        last = "true" if own.want is None else f"{NTH} <= {own.want}"
        same = f"({h2} < {own.h}L OR ({h2} = {own.h}L AND ({tie} < {own.k}L OR ({tie} = {own.k}L AND {last}))))"
        return f"({h} < {cut.h}L OR ({h} = {cut.h}L AND ({k} < {cut.k}L OR ({k} = {cut.k}L AND {same}))))"

    return df, {g: [condition(g, cut) for cut in own] for g, own in cuts.items()}


def take(
    df: DataFrame, label: str | None, quotas: Mapping[Stratum, int], key: str, order: HashOrder
) -> tuple[DataFrame, str]:
    """The table, and a condition that holds for exactly ``quotas[label]`` of its rows, first in hash order.

    Keys may repeat. The table has the helper column :data:`NTH` if equal rows had to be told apart; drop it.
    """
    stratum = "0" if label is None else quoted(label)
    df, tests = _ordered(df, key, order, stratum, {g: [q] for g, q in quotas.items()})
    branches = [(f"{stratum} <=> {_literal(g)}", test) for g, (test,) in tests.items()]
    return df, f"({_case(branches, 'false')})"


def _taken(df: DataFrame, label: str | None, quotas: Mapping[Stratum, int], key: str, order: HashOrder) -> DataFrame:
    table, test = take(df, label, quotas, key, order)
    return table.filter(test).drop(NTH)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42, order: HashOrder | None = None) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows if there are fewer)."""
    return _taken(df, None, {0: n}, key, order or xxhash_order(seed))


def proportional_quotas(counts: Mapping[Stratum, int], n: int) -> dict[Stratum, int]:
    """Split ``n`` by class size: whole parts, then one more by largest remainder, smaller label first."""
    total = sum(counts.values())
    if n >= total:
        return dict(counts)
    shares = {g: Fraction(n * c, total) for g, c in counts.items()}
    quotas = {g: int(s) for g, s in shares.items()}
    rest = sorted(shares, key=lambda g: (quotas[g] - shares[g], str(g)))
    for g in rest[: n - sum(quotas.values())]:
        quotas[g] += 1
    return quotas


def sample_stratified(
    df: DataFrame, label: str, n: int, key: str, seed: int = 42, order: HashOrder | None = None
) -> DataFrame:
    """Exactly ``n`` rows with the label shares of ``df``."""
    quotas = proportional_quotas(class_counts(df, label), n)
    return _taken(df, label, quotas, key, order or xxhash_order(seed))


def stratified_folds(
    df: DataFrame,
    label: str,
    k: int,
    key: str,
    seed: int = 42,
    order: HashOrder | None = None,
    out: str = "fold",
) -> DataFrame:
    """Number each row with its fold, 0 to k-1; per label the fold sizes differ by at most one."""
    order = order or xxhash_order(seed)
    ranks = {
        g: [sum(-(-(n - i) // k) for i in range(j)) for j in range(1, k)]
        for g, n in class_counts(df, label).items()
    }
    table, tests = _ordered(df, key, order, quoted(label), ranks)
    branches = []
    for g, own in tests.items():
        of_label = _case([(test, i) for i, test in enumerate(own)], k - 1)
        branches.append((f"{quoted(label)} <=> {_literal(g)}", of_label))
    return with_exprs(table, {out: f"int({_case(branches)})"}).drop(NTH)


def _two_classes(df: DataFrame, label: str) -> tuple[Stratum, int, Stratum, int]:
    counts = {g: n for g, n in class_counts(df, label).items() if g is not None}
    if len(counts) != 2:
        raise ValueError(f"{label} must have exactly two values, found {sorted(map(str, counts))}")
    (minor, n_minor), (major, n_major) = sorted(counts.items(), key=lambda c: (c[1], str(c[0])))
    return minor, n_minor, major, n_major


def undersample(
    df: DataFrame,
    label: str,
    key: str,
    ratio: float = 1.0,
    seed: int = 42,
    order: HashOrder | None = None,
) -> DataFrame:
    """Drop majority rows until minority / majority = ``ratio``."""
    minor, n_minor, major, n_major = _two_classes(df, label)
    quota = int(n_minor / ratio)
    if quota > n_major:
        raise ValueError(f"ratio {ratio} would need more majority rows than there are")
    quotas = {minor: n_minor, major: quota}
    return _taken(df, label, quotas, key, order or xxhash_order(seed))


def oversample(
    df: DataFrame,
    label: str,
    key: str,
    ratio: float = 1.0,
    seed: int = 42,
    order: HashOrder | None = None,
    copy_col: str | None = None,
) -> DataFrame:
    """Repeat minority rows until minority / majority = ``ratio``.

    Each minority row occurs ``target // n`` times and the first remainder rows in hash order once
    more. ``copy_col`` numbers the copies from 1.
    """
    minor, n_minor, _, n_major = _two_classes(df, label)
    target = max(int(n_major * ratio), n_minor)
    copies, rest = divmod(target, n_minor)
    table, extra = take(df, label, {minor: rest}, key, order or xxhash_order(seed))
    count = f"CASE WHEN {quoted(label)} = {_literal(minor)} THEN {copies} + int({extra}) ELSE 1 END"
    number = copy_col or "_copy"
    repeated = table.selectExpr("*", f"explode(sequence(1, {count})) AS {quoted(number)}").drop(NTH)
    return repeated if copy_col else repeated.drop(number)
