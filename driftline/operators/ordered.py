"""Order statistics and running sums that never sort a whole column in one task.

Range edges come from a quantile sketch. They are a few hundred numbers, and they only decide how
evenly the work is spread: results are exact for any edges. Running sums are formed inside each
value range and completed with the totals of the ranges before it, so a hot group (even one
holding most of the table) is spread over as many tasks as there are ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.session import scratch_path

SKETCH_ACCURACY = 10000
FINE = 256
MIN_SLICES = 512
MIN_RANGES = 32


def sql_double(x: float) -> str:
    """Exact SQL literal of a double."""
    if not math.isfinite(x):
        return "double('NaN')" if math.isnan(x) else f"double('{'-' if x < 0 else ''}Infinity')"
    return f"{x!r}D" if "e" in repr(x) or "." in repr(x) else f"{x!r}.0D"


def _sketch(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int) -> dict[str, list]:
    """Quantile sketches of interleaved slices of the input, combined; slices follow the shuffle partitions.

    One sketch over everything would send a buffer per scan task to one reducer; slicing by scan
    task spreads that merge. Per column and probability one row comes back: total count, minimum,
    maximum, and the smallest, largest and mean slice quantile.
    """
    points = ", ".join(sql_double(p) for p in probs)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.min(c).alias(f"lo{i}"),
            F.max(c).alias(f"hi{i}"),
            F.expr(f"percentile_approx(`{c}`, array({points}), {accuracy})").alias(f"q{i}"),
        ]
    n_slices = max(MIN_SLICES, 4 * _partitions(df.sparkSession))
    slices = df.withColumn("__slice", F.spark_partition_id() % n_slices).groupBy("__slice").agg(*aggs)
    entries = ", ".join(
        f"struct({i} AS c, n{i} AS n, lo{i} AS lo, hi{i} AS hi, q{i} AS q)" for i in range(len(cols))
    )
    rows = (
        slices.select(F.expr(f"inline(array({entries}))"))
        .select("c", "n", "lo", "hi", F.posexplode("q").alias("i", "x"))
        .groupBy("c", "i")
        .agg(
            F.sum("n").alias("n"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.min("x").alias("a"),
            F.max("x").alias("b"),
            (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mid"),
        )
        .collect()
    )
    out: dict[str, list] = {c: [] for c in cols}
    for row in sorted(rows, key=lambda r: r["i"]):
        out[cols[row["c"]]].append(row)
    return out


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_count(spark: SparkSession) -> int:
    """Value ranges per ordered column: a few per shuffle partition, so they follow the cluster."""
    return max(4 * _partitions(spark), MIN_RANGES)


def range_edges(df: DataFrame, cols: Sequence[str], ranges: int | None = None) -> dict[str, list[float]]:
    """Per column, at most ranges-1 increasing edges from one sketch pass."""
    cols = list(cols)
    ranges = ranges or range_count(df.sparkSession)
    probs = [i / ranges for i in range(1, ranges)]
    data = df.select(*[_finite(F.col(c)).alias(c) for c in cols])
    sketch = _sketch(data, cols, probs, min(4 * ranges, SKETCH_ACCURACY))
    return {c: sorted({r["mid"] for r in sketch[c] if math.isfinite(r["mid"])}) for c in cols}


def _finite(c: Column) -> Column:
    d = c.cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def passed_sql(edges: Sequence[Sequence[float]], index: str, value: str) -> str:
    """SQL counting the edges of column number `index` that `value` has reached.

    One lookup per edge position, whatever the number of columns, so the generated code stays
    small enough to be compiled. Short lists are padded with NaN, which no number reaches.
    """
    terms = []
    for k in range(max(len(e) for e in edges)):
        row = ", ".join(sql_double(e[k]) if k < len(e) else "double('NaN')" for e in edges)
        terms.append(f"CAST({value} >= get(array({row}), {index}) AS INT)")
    return " + ".join(terms)


def range_id(value: str, edges: Sequence[float]) -> Column:
    """Index of the value range: a two-level search, about 2*sqrt(n) comparisons per row."""
    if not edges:
        return F.lit(0)
    width = max(int(math.isqrt(len(edges))), 1)
    chunks = [edges[i : i + width] for i in range(0, len(edges), width)]
    tops = ", ".join(sql_double(chunk[-1]) for chunk in chunks)
    nested = ", ".join(
        "array(" + ", ".join(sql_double(x) for x in chunk) + ")" for chunk in chunks
    )
    v = f"CAST(`{value}` AS DOUBLE)"
    chunk = f"size(filter(array({tops}), __edge -> __edge <= {v}))"
    inner = f"coalesce(size(filter(get(array({nested}), {chunk}), __edge -> __edge <= {v})), 0)"
    # size(NULL) is -1 or NULL depending on the session, so past-the-end is spelled out.
    return F.expr(
        f"CASE WHEN {chunk} >= {len(chunks)} THEN {len(chunks) * width} ELSE {chunk} * {width} + {inner} END"
    )


def join_on(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the left key columns once.

    Null-safe equality also keeps the planner from adding a not-null filter to one side, so two
    uses of one aggregated table share a single shuffle.
    """
    if not cols:
        return left.crossJoin(right)
    names = {c: f"__r_{c}" for c in cols}
    renamed = right.select(
        *[F.col(c).alias(names[c]) for c in cols], *[c for c in right.columns if c not in names]
    )
    cond = None
    for c in cols:
        part = F.col(c).eqNullSafe(F.col(names[c]))
        cond = part if cond is None else cond & part
    return left.join(renamed, cond, how).drop(*names.values())


def running_sums(
    grouped: DataFrame,
    by: Sequence[str],
    value: str,
    sums: Sequence[str],
    place: Column,
    *,
    descending: bool = False,
) -> DataFrame:
    """Add, per group, cumulative and total sums over `value` order.

    `grouped` has one row per (by, value); `place` numbers value ranges in value order. For every
    column s in `sums` the result has `s_cum` (inclusive) and `s_total`.
    """
    by = list(by)
    cells = grouped.withColumn("__range", place)
    totals = cells.groupBy(*by, "__range").agg(*[F.sum(s).alias(f"{s}_in") for s in sums])
    # At most one row per group and range, so a window per group is bounded by the range count.
    anchor = by if by else [F.lit(0)]
    key = F.col("__range").desc() if descending else F.col("__range").asc()
    before = Window.partitionBy(*anchor).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*anchor)
    offsets = totals.select(
        *by,
        "__range",
        *[F.coalesce(F.sum(f"{s}_in").over(before), F.lit(0)).alias(f"{s}_before") for s in sums],
        *[F.sum(f"{s}_in").over(whole).alias(f"{s}_total") for s in sums],
    )
    joined = join_on(cells, offsets, [*by, "__range"])
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy(*by, "__range").orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        *grouped.columns,
        *[(F.col(f"{s}_before") + F.sum(s).over(upto)).alias(f"{s}_cum") for s in sums],
        *[F.col(f"{s}_total") for s in sums],
    )


def lerp(low: float, high: float, t: float) -> float:
    """Linear interpolation, anchored at the nearer end; an end itself may be infinite."""
    if low == high or t == 0.0:
        return low
    if t >= 0.5:
        return high - (high - low) * (1.0 - t)
    return low + (high - low) * t


def lerp_col(low: Column, high: Column, t: Column) -> Column:
    gap = high - low
    return F.when((low == high) | (t == 0.0), low).when(t >= 0.5, high - gap * (F.lit(1.0) - t)).otherwise(low + gap * t)


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float] | None]:
    """Exact linearly interpolated quantiles of whole columns, as a handful of driver floats.

    Pass 1 sketches slices of the input: a wanted quantile lies between the smallest and the
    largest of its slice quantiles. Pass 2 counts the rows outside these brackets (combined to a
    few rows per task) and ranks only the distinct values inside them, each bracket cut into
    FINE equal parts so no task sorts a whole bracket. A rank that missed its bracket would be
    found by the full distributed ranking instead.
    """
    cols = list(cols)
    data = df.select(
        *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols]
    )
    eps = 2.0 / accuracy
    around = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-eps, eps)})
    sketch = _sketch(data, cols, around, accuracy)
    size: dict[str, int] = {}
    known: dict[str, dict[int, float]] = {}
    wanted: dict[str, list[int]] = {}
    brackets: dict[str, list[tuple[float, float]]] = {}
    for c in cols:
        if not sketch[c]:
            continue
        n = size[c] = sketch[c][0]["n"]
        known[c] = {0: sketch[c][0]["lo"], n - 1: sketch[c][0]["hi"]}
        ranks, spans = set(), []
        for p in probs:
            h = (n - 1) * p
            need = {math.floor(h), math.ceil(h)} - known[c].keys()
            if need:
                ranks |= need
                low = sketch[c][around.index(min(max(p - eps, 0.0), 1.0))]
                high = sketch[c][around.index(min(max(p + eps, 0.0), 1.0))]
                spans.append((low["a"], high["b"]))
        if ranks:
            wanted[c], brackets[c] = sorted(ranks), _merge(spans)
    for c, found in _values_at_ranks(data, wanted, brackets).items():
        known[c].update(found)
    out: dict[str, list[float] | None] = {}
    for c in cols:
        if c not in size:
            out[c] = None
        elif all(r in known[c] for r in wanted.get(c, [])):
            hs = [(size[c] - 1) * p for p in probs]
            out[c] = [lerp(known[c][math.floor(h)], known[c][math.ceil(h)], h - math.floor(h)) for h in hs]
        else:
            names = {f"p{k}": p for k, p in enumerate(probs)}
            row = grouped_quantiles(data, [], c, names).first()
            out[c] = [row[name] for name in names]
    return out


def _merge(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Union of closed intervals."""
    merged: list[list[float]] = []
    for low, high in sorted(spans):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    return [(a, b) for a, b in merged]


def _values_at_ranks(
    data: DataFrame,
    wanted: dict[str, list[int]],
    brackets: dict[str, list[tuple[float, float]]],
) -> dict[str, dict[int, float]]:
    """Values at 0-based ranks, provided they lie in one of the column's value brackets."""
    active = list(wanted)
    if not active:
        return {}
    # Bracket ends in order: an odd number of ends passed means inside a bracket.
    ends = [[x for pair in brackets[c] for x in pair] for c in active]
    at = "get(array(" + ", ".join("array(" + ", ".join(map(sql_double, e)) + ")" for e in ends) + "), c)"
    a, b = f"get({at}, passed - 1)", f"get({at}, passed)"
    part = f"least(CAST(floor((v - {a}) / ({b} - {a}) * {FINE}) AS INT), {FINE - 1})"
    entries = ", ".join(f"struct({i} AS c, `{c}` AS v)" for i, c in enumerate(active))
    counts = (
        data.select(F.expr(f"inline(array({entries}))"))
        .where("v IS NOT NULL")
        .select("c", "v", F.expr(passed_sql(ends, "c", "v")).alias("passed"))
        .select(
            "c",
            F.expr(f"passed * {FINE} + CASE WHEN passed % 2 = 1 THEN {part} ELSE 0 END").alias("cell"),
            F.expr(f"CASE WHEN passed % 2 = 1 OR v = {a} THEN v END").alias("v"),
        )
        .groupBy("c", "cell", "v")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("c", "cell").agg(F.sum("n").alias("cell_n"))
    earlier = Window.partitionBy("c").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "c", "cell", F.coalesce(F.sum("cell_n").over(earlier), F.lit(0)).alias("before")
    )
    order = Window.partitionBy("c", "cell").orderBy(F.col("v").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        join_on(counts, offsets, ["c", "cell"])
        .withColumn("stop", F.col("before") + F.sum("n").over(upto))
        .withColumn("start", F.col("stop") - F.col("n"))
    )
    ranks = ", ".join("array(" + ", ".join(f"{r}L" for r in wanted[c]) + ")" for c in active)
    hit = F.expr(f"v IS NOT NULL AND exists(get(array({ranks}), c), r -> r >= start AND r < stop)")
    result: dict[str, dict[int, float]] = {c: {} for c in active}
    for row in ranked.where(hit).select("c", "start", "stop", "v").collect():
        c = active[row["c"]]
        for r in wanted[c]:
            if row["start"] <= r < row["stop"]:
                result[c][r] = row["v"]
    return result


def grouped_quantiles(
    df: DataFrame, by: Sequence[str], col: str, probs: dict[str, float], edges: Sequence[float] | None = None
) -> DataFrame:
    """Exact interpolated quantiles per group, fully distributed: one row per group."""
    by = list(by)
    data = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    if edges is None:
        edges = range_edges(data, [col])[col]
    counts = data.groupBy(*by, F.col(col).cast("double").alias("__v")).agg(F.count("*").alias("n"))
    ranked = running_sums(counts, by, "__v", ["n"], range_id("__v", edges))
    aggs = [F.max("n_total").alias("n")]
    for name, p in probs.items():
        h = (F.col("n_total") - 1).cast("double") * F.lit(float(p))
        start = F.col("n_cum") - F.col("n")
        for side, r in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when((start <= r) & (F.col("n_cum") > r), F.col("__v"))).alias(f"{name}_{side}"))
    table = ranked.groupBy(*by).agg(*aggs)
    outs = []
    for name, p in probs.items():
        h = (F.col("n") - 1).cast("double") * F.lit(float(p))
        outs.append(lerp_col(F.col(f"{name}_lo"), F.col(f"{name}_hi"), h - F.floor(h)).alias(name))
    return table.select(*by, "n", *outs)


_POSITION_BITS = 33  # monotonically_increasing_id() is the partition, shifted by this, plus the position in it


def dense_places(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Rows with `place`, their position from 0 inside `by` in the given order, without sorting a group in one task.

    Rows are dealt out by ranges of (by, order), sorted there and written; a place is the position in the partition
    plus the group's rows in earlier partitions. `by` and `order` together should tell rows apart.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    ranged = df.repartitionByRange(range_count(spark), *by, *order).sortWithinPartitions(*by, *order)
    ranged.withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    held = spark.read.parquet(path).withColumn("__part", F.shiftright("__at", _POSITION_BITS))
    runs = held.groupBy(*by, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0))).drop("__rows")
    placed = join_on(held, runs, [*by, "__part"])
    return placed.withColumn("place", F.col("__before") + F.col("__at") - F.col("__first")).drop(
        "__at", "__part", "__first", "__before"
    )
