"""Distribution drift against a reference, window classification and the retrain rule.

The reference is reduced once to a `Profile`: exact deciles, counts per bin, category and distinct
value. Every detector takes a profile or a reference table (which it profiles itself). Each window is
read once: values fall into at most `bins` counters per column, categories into one counter each, so
shuffles carry aggregates only. `by` columns name the windows; without them a side may be empty. Windows
may come as rows or already counted (`Tally`), as the drift stream has them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.functions import columns as X
from driftline.functions.columns import ratio
from driftline.operators import metrics as M
from driftline.operators.ingest import unpivot_text
from driftline.operators.ordered import (
    exact_quantiles,
    join_on,
    passed_sql,
    range_count,
    range_edges,
    range_id,
    running_sums,
    sql_double,
)
from driftline.operators.tally import Tally
from driftline.session import scratch_path
from driftline.spec import TableSpec

# Limits of the drift and retrain rules.
BINS = 10
COLUMN_LIMIT = 0.2
SECOND_LIMIT = 0.1
SHARE_FLOOR = 1e-6
DRIFT_SHARE_LIMIT = 0.30
RECALL_RETRAIN = 0.60
RETRAIN_WINDOWS = 2
MIN_SCALE = 0.001

# Column names the detectors use themselves; a window column of that name would be shadowed.
RESERVED = frozenset(
    "ordinal column value v bin n_bins score reason p q r c k rc cc rn cn area sd mean rr rv cr level next".split()
)


def _window_columns(by: Sequence[str]) -> list[str]:
    clash = RESERVED.intersection(by)
    if clash:
        raise ValueError(f"window columns may not be named {sorted(clash)}")
    return list(by)


@dataclass(frozen=True)
class Cuts:
    """Unique reference deciles per column and why a column cannot be binned."""

    edges: dict[str, list[float]]

    def bins(self, column: str) -> int:
        return max(len(self.edges[column]) - 1, 0)


def reference_cuts(ref: DataFrame, cols: Sequence[str], bins: int = BINS) -> Cuts:
    """Exact linear deciles of the reference, duplicates removed."""
    step = 1.0 / bins
    probs = [i * step for i in range(bins)] + [1.0]
    q = exact_quantiles(ref, cols, probs)
    return Cuts({c: sorted(set(q[c])) if q[c] else [] for c in cols})


def _bin_counts(df: DataFrame, cuts: Cuts, by: Sequence[str], bins: int, prefix: str) -> DataFrame:
    """Per window and column: non-null count and one counter per bin.

    Bins are [a, b) with the last one closed; values outside the cuts are counted in n only. A
    window without any value of a column still gets its row.
    """
    if not cuts.edges:
        none = df.sparkSession.createDataFrame([], f"ordinal int, column string, {prefix}n bigint")
        return none.withColumns({f"{prefix}{k}": F.lit(0).cast("bigint") for k in range(bins)})
    edges = [e if len(e) > 1 else [] for e in cuts.edges.values()]
    number = "CASE WHEN NOT isnan(CAST(`{c}` AS DOUBLE)) THEN CAST(`{c}` AS DOUBLE) END"
    entries = ", ".join(
        f"struct({i} AS ordinal, '{c}' AS column, {number.format(c=c)} AS v)" for i, c in enumerate(cuts.edges)
    )
    long = df.select(*by, F.expr(f"inline(array({entries}))"))
    if any(edges):
        top = ", ".join(sql_double(e[-1]) if e else "double('NaN')" for e in edges)
        last = ", ".join(str(len(e) - 1) for e in edges)
        passed = passed_sql(edges, "ordinal", "v")
        cell = (
            f"CASE WHEN v <= get(array({top}), ordinal) "
            f"THEN least({passed}, get(array({last}), ordinal)) - 1 ELSE -1 END"
        )
    else:
        cell = "-1"
    long = long.withColumn("bin", F.expr(cell))
    return long.groupBy(*by, "ordinal", "column").agg(
        F.count("v").alias(f"{prefix}n"),
        *[F.count_if(F.col("bin") == k).alias(f"{prefix}{k}") for k in range(bins)],
    )


@dataclass(frozen=True)
class Profile:
    """All that the detectors need of a reference; its size follows the distinct values, not the rows."""

    numeric: tuple[str, ...]
    text: tuple[str, ...]
    cuts: Cuts
    bins: DataFrame  # ordinal, n_bins, rn, r0, r1, ...
    numbers: DataFrame  # column, v, rr: rows up to v, rv: their sum of values; one row a distinct finite value
    moments: DataFrame  # column, rn, mean, sd of the finite values; one row a column
    edges: dict[str, list[float]]  # borders of even value ranges
    shares: DataFrame  # column, value, p; one row a category
    is_empty: bool


def profile(
    ref: DataFrame,
    numeric: Sequence[str],
    text: Sequence[str] = (),
    cuts: Cuts | None = None,
    bins: int = BINS,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
    parts: Sequence[str] = ("bins", "numbers", "shares"),
) -> Profile:
    """Reduce a reference. `keep(table, name)` may write each part, so that later uses read it back.

    A detector that profiles a table itself names the parts it reads; the others cost no pass.
    """
    write = keep or (lambda df, name: df)

    def keep(df: DataFrame, name: str) -> DataFrame:
        return write(df, name) if name in parts or (name == "moments" and "numbers" in parts) else df

    numeric, text = list(numeric), list(text)
    if cuts is None:
        cuts = reference_cuts(ref, numeric, bins) if "bins" in parts else Cuts({c: [] for c in numeric})
    spark = ref.sparkSession
    grid = spark.createDataFrame([(i, cuts.bins(c)) for i, c in enumerate(numeric)], "ordinal int, n_bins int")
    counts = grid.join(_bin_counts(ref, cuts, (), bins, "r").drop("column"), "ordinal", "left").na.fill(0)
    edges = range_edges(ref, numeric) if numeric and "numbers" in parts else {c: [] for c in numeric}
    values = _long_numbers(ref, numeric).groupBy("column", "v").agg(F.count("*").alias("r"))
    values = values.withColumn("rv", F.col("v") * F.col("r"))
    sums = running_sums(values, ["column"], "v", ["r", "rv"], _value_range(numeric, edges))
    numbers = sums.select("column", "v", F.col("r_cum").alias("rr"), F.col("rv_cum").alias("rv"))
    numbers = keep(numbers, "numbers")
    spread = ref.agg(
        *[f(_finite(F.col(c))).alias(f"{n}{i}") for i, c in enumerate(numeric) for n, f in _MOMENTS.items()],
        F.count("*").alias("n_rows"),
    )
    entries = [f"struct('{c}' AS column, rn{i} AS rn, mean{i} AS mean, sd{i} AS sd)" for i, c in enumerate(numeric)]
    none = "CAST(array() AS array<struct<column:string,rn:bigint,mean:double,sd:double>>)"
    moments = spread.select(F.expr(f"inline({'array(' + ', '.join(entries) + ')' if entries else none})"))
    r = unpivot_text(ref, text).groupBy("column", "value").agg(F.count("*").alias("rc")) if text else None
    if r is None:
        shares = spark.createDataFrame([], "column string, value string, p double")
    else:
        # One row per column: every row of the reference has one value of each.
        rn = r.groupBy("column").agg(F.sum("rc").alias("rn"))
        shares = join_on(r, F.broadcast(rn), ["column"]).select("column", "value", ratio(F.col("rc"), F.col("rn")).alias("p"))
    return Profile(
        tuple(numeric),
        tuple(text),
        cuts,
        keep(counts, "bins"),
        numbers,
        keep(moments, "moments"),
        edges,
        keep(shares, "shares"),
        "shares" in parts and ref.isEmpty(),
    )


_MOMENTS = {"rn": F.count, "mean": F.avg, "sd": F.stddev_pop}


def written(spark: SparkSession) -> Callable[[DataFrame, str], DataFrame]:
    """Writes each part of a profile below the shared folder, so that a reference is reduced once for all its uses."""

    def keep(part: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"profile-{name}")
        part.write.parquet(path)
        return spark.read.schema(part.schema).parquet(path)

    return keep


def _profiled(
    ref: DataFrame | Profile,
    part: str,
    numeric: Sequence[str] = (),
    text: Sequence[str] = (),
    cuts: Cuts | None = None,
    bins: int = BINS,
) -> Profile:
    """The profile to compare with, its numeric columns numbered as in `numeric`."""
    if not isinstance(ref, Profile):
        return profile(ref, numeric, text, cuts, bins, written(ref.sparkSession) if part == "numbers" else None, [part])
    if part != "bins" or list(numeric) == list(ref.numeric):
        return ref
    numbers = {ref.numeric.index(c): i for i, c in enumerate(numeric)}
    places = ref.bins.sparkSession.createDataFrame(list(numbers.items()), "ordinal int, __new int")
    own = ref.bins.join(F.broadcast(places), "ordinal").drop("ordinal").withColumnRenamed("__new", "ordinal")
    return replace(ref, cuts=Cuts({c: ref.cuts.edges[c] for c in numeric}), bins=own)


def _finite(c: Column) -> Column:
    d = c.cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def _long_numbers(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, v) of the finite values."""
    parts = [F.struct(F.lit(c).alias("column"), _finite(F.col(c)).alias("v")) for c in cols]
    long = F.array(*parts) if parts else F.array().cast("array<struct<column:string,v:double>>")
    return df.select(*keep, F.explode(long).alias("__e")).select(*keep, "__e.*").where("v IS NOT NULL")


def _value_range(cols: Sequence[str], edges: dict[str, list[float]]) -> Column:
    place = F.lit(0)
    for name in cols:
        place = F.when(F.col("column") == name, range_id("v", edges[name])).otherwise(place)
    return place


def _each_column(cur: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(window..., ordinal, column) of every window; without window columns one window, rows or not."""
    windows = cur.select(*by).distinct() if by else cur.sparkSession.range(1).select()
    names = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column")) for i, c in enumerate(cols)])
    return windows.select(*by, F.explode(names).alias("__e")).select(*by, "__e.*")


def psi(
    ref: DataFrame | Profile,
    cur: DataFrame | Tally,
    cols: Sequence[str],
    by: Sequence[str] = (),
    bins: int = BINS,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Population stability index per window and numeric column, with the reason of a zero.

    A column is 0 when either side has fewer than `bins` values (an empty side included) or the
    reference has fewer than three distinct cuts.
    """
    cols, by = list(cols), _window_columns(by)
    known = _profiled(ref, "bins", cols, (), cuts, bins)
    counts = cur.bins(cols, bins) if isinstance(cur, Tally) else _bin_counts(cur, known.cuts, by, bins, "c")
    if not by:
        counts = _each_column(cur, (), cols).join(counts.drop("column"), "ordinal", "left").na.fill(0)
    # One row per column, so this side is always small.
    joined = counts.join(F.broadcast(known.bins), "ordinal")
    terms = []
    for k in range(bins):
        r = F.greatest(ratio(F.col(f"r{k}"), F.col("rn")), F.lit(SHARE_FLOOR))
        c = F.greatest(ratio(F.col(f"c{k}"), F.col("cn")), F.lit(SHARE_FLOOR))
        terms.append(F.when(F.col("n_bins") > k, (c - r) * F.log(c / r)).otherwise(F.lit(0.0)))
    reason = (
        F.when(F.col("rn") < bins, F.lit("short_reference"))
        .when(F.col("cn") < bins, F.lit("short_window"))
        .when(F.col("n_bins") < 2, F.lit("too_few_cuts"))
    )
    value = F.when(reason.isNotNull(), F.lit(0.0)).otherwise(reduce(lambda a, b: a + b, terms))
    return joined.select(*by, "ordinal", "column", value.alias("score"), reason.alias("reason"))


def _category_shares(known: Profile, cur: DataFrame | Tally, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(window, column, value, p, q): shares of the categories seen in the window.

    p is the reference share (0 if absent there). Categories only the reference has are recovered
    by the callers from 1 - sum(p), so the reference is never repeated per window. A window's rows
    are counted on their own: every row has one value of each column.
    """
    by = _window_columns(by)
    if isinstance(cur, Tally):
        c, cn = cur.categories(cols), cur.rows()
    else:
        c = unpivot_text(cur, cols, by).groupBy(*by, "column", "value").agg(F.count("*").alias("cc"))
        cn = cur.groupBy(*by).agg(F.count("*").alias("cn"))
    joined = join_on(c, known.shares, ["column", "value"], "left")
    joined = join_on(joined, cn, by) if by else joined.crossJoin(F.broadcast(cn))
    return joined.select(
        *by, "column", "value", F.coalesce("p", F.lit(0.0)).alias("p"), ratio(F.col("cc"), F.col("cn")).alias("q")
    )


def _per_column(table: DataFrame, cur: DataFrame, cols: Sequence[str], by: Sequence[str], empty: float) -> DataFrame:
    """Scores in contract order; `empty` where a window has no rows at all."""
    if by:
        return table.select(*by, _ordinal(cols).alias("ordinal"), "column", "score")
    return (
        _each_column(cur, (), cols)
        .join(table, "column", "left")
        .select("ordinal", "column", F.coalesce("score", F.lit(empty)).alias("score"))
    )


def total_variation(
    ref: DataFrame | Profile, cur: DataFrame | Tally, cols: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Half the absolute share difference per window and column; null is its own category.

    Against an empty side the shares of the other are compared with zeros.
    """
    known = _profiled(ref, "shares", (), cols)
    whole = 0.0 if known.is_empty else 1.0
    shares = _category_shares(known, cur, cols, by)
    both = F.sum(F.abs(F.col("p") - F.col("q")))
    rest = F.lit(whole) - F.sum("p")
    table = shares.groupBy(*by, "column").agg((F.lit(0.5) * (both + rest)).alias("score"))
    return _per_column(table, cur, cols, by, 0.5 * whole)


def _ordinal(cols: Sequence[str]) -> Column:
    names = F.array(*[F.lit(c) for c in cols])
    return (F.array_position(names, F.col("column")) - 1).cast("int")


def _compared(ref: DataFrame | Profile, cur: DataFrame | Tally, spec: TableSpec) -> tuple[list[str], list[str]]:
    known = {*ref.numeric, *ref.text} if isinstance(ref, Profile) else set(ref.columns)
    both = known & set(cur.columns)
    return [c for c in spec.numeric if c in both], [c for c in spec.categorical if c in both]


def reference_profile(
    ref: DataFrame, spec: TableSpec, cuts: Cuts | None = None, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> Profile:
    """The profile of a reference for all detectors of a contract."""
    has = set(ref.columns)
    return profile(ref, [c for c in spec.numeric if c in has], [c for c in spec.categorical if c in has], cuts, keep=keep)


def drift_scores(
    ref: DataFrame | Profile, cur: DataFrame | Tally, spec: TableSpec, by: Sequence[str] = (), cuts: Cuts | None = None
) -> DataFrame:
    """PSI and total variation of every compared column, in contract order."""
    numeric, text = _compared(ref, cur, spec)
    parts = []
    if numeric:
        parts.append(
            psi(ref, cur, numeric, by, cuts=cuts).select(*by, "ordinal", "column", F.lit("psi").alias("kind"), "score", "reason")
        )
    if text:
        parts.append(
            total_variation(ref, cur, text, by).select(
                *by,
                (F.col("ordinal") + len(numeric)).alias("ordinal"),
                "column",
                F.lit("total_variation").alias("kind"),
                "score",
                F.lit(None).cast("string").alias("reason"),
            )
        )
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("limit", F.lit(COLUMN_LIMIT)).withColumn("drifted", F.col("score") >= COLUMN_LIMIT)


def share_of_drifted(scores: DataFrame, by: Sequence[str] = (), name: str = "psi_share") -> DataFrame:
    """Per window: share of drifted columns, their list in contract order, columns compared."""
    hits = F.sort_array(F.collect_list(F.when(F.col("drifted"), F.struct("ordinal", "column", "score"))))
    table = scores.groupBy(*by).agg(
        F.count("*").alias("n_columns"), F.count_if("drifted").alias("n_drifted"), hits.alias("hits")
    )
    return table.select(
        *by,
        ratio(F.col("n_drifted"), F.col("n_columns")).alias(name),
        F.transform("hits", lambda h: h["column"]).alias("drifted_features"),
        F.transform(
            "hits", lambda h: F.struct(h["column"].alias("column"), X.rounded(h["score"], 4).alias("score"))
        ).alias("details"),
        "n_columns",
    )


def drift_report(
    ref: DataFrame | Profile, cur: DataFrame | Tally, spec: TableSpec, by: Sequence[str] = (), cuts: Cuts | None = None
) -> DataFrame:
    return share_of_drifted(drift_scores(ref, cur, spec, by, cuts), by)


def wasserstein(
    ref: DataFrame | Profile, cur: DataFrame | Tally, cols: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """First Wasserstein distance per window and column, divided by the reference std.

    Between two neighbouring values of a window its cumulative share is a constant, the level. The area
    to the reference's cumulative share then follows from that share's integral at both ends and at the
    reference quantile of the level. Both are looked up in the profile in value order and in share order,
    range by range, for all windows at once: the work follows the distinct values of the windows and of
    the reference, and neither is repeated. Only finite values count; without any on a side the score is 0.
    """
    cols, by = list(cols), _window_columns(by)
    known = _profiled(ref, "numbers", cols)
    keys = [*by, "column"]
    place = _value_range(cols, known.edges)
    if isinstance(cur, Tally):
        c, windows, keep = cur.values(cols), cur.rows(), lambda df, name: df
    else:
        c, windows, keep = _long_numbers(cur, cols, by).groupBy(*keys, "v").agg(F.count("*").alias("c")), cur, written(cur.sparkSession)
    # What is used twice is written, so that neither the rows are counted nor the reference is looked up again.
    c = keep(c, "values")
    c = _reference_below(c.withColumn("__range", place), known.numbers.withColumn("__range", place))
    c = join_on(c, F.broadcast(known.moments), ["column"])
    c = c.withColumn("area", ratio(F.col("v") * F.col("rr") - F.col("rv"), F.col("rn")))
    steps = keep(_levels(keep(c, "areas"), keys), "steps")
    pieces = _between(_quantiles(steps, known))
    area = pieces.groupBy(*keys).agg(F.sum("piece").alias("area"))
    told = join_on(_each_column(windows, by, cols), area, keys, "left")
    told = join_on(told, F.broadcast(known.moments.select("column", "rn", "sd")), ["column"], "left")
    usable = F.when(F.col("rn") > 0, F.col("area"))
    value = F.coalesce(usable, F.lit(0.0)) / F.greatest(F.coalesce("sd", F.lit(0.0)), F.lit(MIN_SCALE))
    return told.select(*by, "ordinal", "column", value.alias("score"))


def _reference_below(c: DataFrame, numbers: DataFrame) -> DataFrame:
    """Window values with the reference's rows up to them (rr) and their sum of values (rv)."""
    nothing = {n: F.lit(None).cast(t) for n, t in c.dtypes if n not in numbers.columns}
    both = c.withColumns({"rr": F.lit(None).cast("bigint"), "rv": F.lit(None).cast("double"), "__own": F.lit(1)}).unionByName(
        numbers.withColumns(nothing | {"__own": F.lit(0)}).select(*c.columns, "rr", "rv", "__own")
    )
    order = Window.partitionBy("column", "__range").orderBy("v", "__own").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumns({n: F.last(n, ignorenulls=True).over(order) for n in ("rr", "rv")}).where("__own = 1")
    # One row per column and range: what lies below the range.
    tops = numbers.groupBy("column", "__range").agg(F.max("rr").alias("rr"), F.max_by("rv", "rr").alias("rv"))
    # By a sum of the counts, not a distinct: below a distinct the planner drops the counting and places every row.
    ranges = c.groupBy("column", "__range").agg(F.sum("c").alias("__n")).where("__n > 0")
    ranges = ranges.select("column", "__range", F.lit(1).alias("__own"))
    line = ranges.unionByName(tops.withColumn("__own", F.lit(0)), allowMissingColumns=True)
    below = Window.partitionBy("column").orderBy("__range").rangeBetween(Window.unboundedPreceding, -1)
    offsets = line.withColumns({f"{n}_below": F.last(n, ignorenulls=True).over(below) for n in ("rr", "rv")}).where("__own = 1")
    joined = join_on(seen.drop("__own"), offsets.select("column", "__range", "rr_below", "rv_below"), ["column", "__range"])
    return joined.withColumns({n: F.coalesce(n, f"{n}_below", F.lit(0)) for n in ("rr", "rv")}).drop("rr_below", "rv_below")


def _levels(c: DataFrame, keys: list[str]) -> DataFrame:
    """Per distinct window value: the share up to it, whether it is the first, and the next value's figures."""
    point = F.struct("v", "rr", "area")
    totals = c.groupBy(*keys, "__range").agg(F.sum("c").alias("c_in"), F.min(point).alias("first"))
    line = Window.partitionBy(*keys).orderBy("__range")
    offsets = totals.select(
        *keys,
        "__range",
        F.coalesce(F.sum("c_in").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("c_before"),
        F.sum("c_in").over(Window.partitionBy(*keys)).alias("cn"),
        F.lead("first").over(line).alias("next_first"),
    )
    inside = Window.partitionBy(*keys, "__range").orderBy("v")
    upto = F.col("c_before") + F.sum("c").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return join_on(c, offsets, [*keys, "__range"]).select(
        *keys,
        "v",
        "rr",
        "rn",
        "area",
        "mean",
        (upto == F.col("c")).alias("is_first"),
        ratio(upto, F.col("cn")).alias("level"),
        F.coalesce(F.lead(point).over(inside), F.col("next_first")).alias("next"),
    )


def _quantiles(steps: DataFrame, known: Profile) -> DataFrame:
    """Steps with `q`, the first reference value whose share reaches the level, and the integral there.

    Looked up in ranges of the share; a step only needs it where it lies between the step and the next.
    """
    cells = range_count(steps.sparkSession)

    def cell(share: Column) -> Column:
        return F.floor(share * cells).cast("int")

    profile = join_on(known.numbers, F.broadcast(known.moments.select("column", "rn")), ["column"])
    profile = profile.withColumn("level", ratio(F.col("rr"), F.col("rn")))
    profile = profile.select(
        "column", "level", F.struct("v", ratio(F.col("v") * F.col("rr") - F.col("rv"), F.col("rn")).alias("area")).alias("q")
    )
    nothing = {n: F.lit(None).cast(t) for n, t in steps.dtypes if n not in profile.columns}
    both = steps.withColumns({"q": F.lit(None).cast(dict(profile.dtypes)["q"]), "__own": F.lit(0)}).unionByName(
        profile.withColumns(nothing | {"__own": F.lit(1)}).select(*steps.columns, "q", "__own")
    )
    both = both.withColumn("__cell", cell(F.col("level")))
    # From the highest level down: a growing frame is updated row by row, one that shrinks is read anew for each.
    ahead = Window.partitionBy("column", "__cell").orderBy(F.desc("level"), F.desc("__own"))
    ahead = ahead.rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("q", F.last("q", ignorenulls=True).over(ahead)).where("__own = 0")
    firsts = profile.groupBy("column", cell(F.col("level")).alias("__cell")).agg(F.min_by("q", "level").alias("q"))
    asked = steps.select("column", cell(F.col("level")).alias("__cell")).distinct().withColumn("__own", F.lit(1))
    line = asked.unionByName(firsts.withColumn("__own", F.lit(0)), allowMissingColumns=True)
    later = Window.partitionBy("column").orderBy(F.desc("__cell")).rangeBetween(Window.unboundedPreceding, -1)
    after = line.withColumn("q_after", F.last("q", ignorenulls=True).over(later)).where("__own = 1")
    joined = join_on(met.drop("__own"), after.select("column", "__cell", "q_after"), ["column", "__cell"])
    return joined.withColumn("q", F.coalesce("q", "q_after"))


def _between(steps: DataFrame) -> DataFrame:
    """Steps with `piece`, their part of the area between the two cumulative shares."""
    a, ia, k = F.col("v"), F.col("area"), F.col("level")
    b, ib = F.col("next.v"), F.col("next.area")
    inner = (F.col("q.v") > a) & (F.col("q.v") < b)
    q = F.when(inner, F.col("q.v")).when(F.coalesce(F.col("q.v") <= a, F.lit(False)), a).otherwise(b)
    iq = F.when(inner, F.col("q.area")).when(F.coalesce(F.col("q.v") <= a, F.lit(False)), ia).otherwise(ib)
    middle = k * (q - a) - (iq - ia) + (ib - iq) - k * (b - q)
    before = F.when(F.col("is_first"), ia).otherwise(0.0)
    # above the last value the window's share is 1
    after = ia - a + F.col("mean")
    return steps.withColumn("piece", before + F.when(F.col("next").isNotNull(), middle).otherwise(after))


def jensen_shannon(
    ref: DataFrame | Profile, cur: DataFrame | Tally, cols: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Jensen-Shannon distance (base 2) per window and column; a missing value is `Unknown`.

    0 where a side is empty.
    """
    known = _profiled(ref, "shares", (), cols)
    filled = known.shares.groupBy("column", X.fill_cat(F.col("value")).alias("value")).agg(F.sum("p").alias("p"))
    known = replace(known, shares=filled)
    if isinstance(cur, Tally):
        cur = cur.filled()
    else:
        rest = [c for c in cur.columns if c not in cols]
        cur = cur.select(*rest, *[X.fill_cat(F.col(c).cast("string")).alias(c) for c in cols])
    shares = _category_shares(known, cur, cols, by)
    p, q = F.col("p"), F.col("q")
    left = F.when(p > 0, p * F.log2(2.0 * p / (p + q))).otherwise(F.lit(0.0))
    right = F.when(q > 0, q * F.log2(2.0 * q / (p + q))).otherwise(F.lit(0.0))
    # A category only the reference has adds p * log2(2) = p.
    body = F.sum(left + right) + (F.lit(1.0) - F.sum("p"))
    score = F.lit(0.0) if known.is_empty else F.sqrt(F.greatest(F.lit(0.5) * body, F.lit(0.0)))
    table = shares.groupBy(*by, "column").agg(F.max(F.lit(0.0)).alias("score") if known.is_empty else score.alias("score"))
    return _per_column(table, cur, cols, by, 0.0)


def drift_second(
    ref: DataFrame | Profile, cur: DataFrame | Tally, spec: TableSpec, by: Sequence[str] = ()
) -> DataFrame:
    """Second detector: normalised Wasserstein for numbers, Jensen-Shannon for categories."""
    numeric, text = _compared(ref, cur, spec)
    parts = []
    if numeric:
        parts.append(wasserstein(ref, cur, numeric, by).withColumn("kind", F.lit("wasserstein")))
    if text:
        t = jensen_shannon(ref, cur, text, by).withColumn("kind", F.lit("jensen_shannon"))
        parts.append(t.withColumn("ordinal", F.col("ordinal") + len(numeric)))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("limit", F.lit(SECOND_LIMIT)).withColumn("drifted", F.col("score") >= SECOND_LIMIT)


def combined_share(first: DataFrame, second: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """Larger share of the available detectors, and which ones were used."""
    if second is None:
        return first.withColumn("second_share", F.lit(None).cast("double")).withColumns(
            {"drift_share": F.col("psi_share"), "method": F.lit("psi")}
        )
    other = second.select(*by, "second_share")
    joined = join_on(first, other, list(by), "left") if by else first.crossJoin(F.broadcast(other))
    has = F.col("second_share").isNotNull()
    return joined.withColumns(
        {
            "drift_share": F.greatest("psi_share", "second_share"),
            "method": F.when(has, F.lit("second+psi")).otherwise(F.lit("psi")),
        }
    )


def classify(share: Column, recall: Column) -> Column:
    """Moved inputs are data drift; weak recall on stable inputs is concept drift."""
    return (
        F.when(share >= DRIFT_SHARE_LIMIT, F.lit("data_drift"))
        .when(recall < RECALL_RETRAIN, F.lit("concept_drift"))
        .otherwise(F.lit("stable"))
    )


def realized(
    df: DataFrame, threshold: float | str, by: Sequence[str] = (), label: str = "label", proba: str = "proba"
) -> DataFrame:
    """Realised recall and AUC of scored, labelled windows at the serving threshold."""
    return M.binary_metrics(df, threshold, by, label, proba).select(
        *by, F.col("recall").alias("realized_recall"), F.col("roc_auc").alias("realized_roc_auc")
    )


def monitor_windows(
    ref: DataFrame | Profile,
    windows: DataFrame | Tally,
    spec: TableSpec,
    by: Sequence[str],
    threshold: float,
    second: bool = True,
    label: str = "label",
    proba: str = "proba",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Monitor record of every window: drift share, realised recall, class.

    Windows that come counted bring the threshold, label and score they were counted with.
    """
    by = list(by)
    if not isinstance(ref, Profile):
        ref = reference_profile(ref, spec, cuts, written(ref.sparkSession))
    first = drift_report(ref, windows, spec, by)
    other = share_of_drifted(drift_second(ref, windows, spec, by), by, "second_share") if second else None
    drift = combined_share(first, other, by)
    scores = windows.realized() if isinstance(windows, Tally) else realized(windows, threshold, by, label, proba)
    joined = join_on(drift, scores, by, "left")
    kind = classify(F.col("drift_share"), F.col("realized_recall"))
    return joined.withColumn("kind", kind).select(
        *by,
        X.rounded(F.col("drift_share"), 4).alias("drift_share"),
        X.rounded(F.col("psi_share"), 4).alias("psi_share"),
        X.rounded(F.col("second_share"), 4).alias("second_share"),
        F.col("method").alias("drift_method"),
        "drifted_features",
        X.rounded(F.col("realized_recall"), 4).alias("realized_recall"),
        X.rounded(F.col("realized_roc_auc"), 4).alias("realized_roc_auc"),
        "kind",
        (F.col("kind") == "data_drift").alias("data_drift"),
        (F.col("kind") == "concept_drift").alias("concept_drift"),
    )


def retrain_decision(
    history: DataFrame, seq: str, by: Sequence[str] = (), scheduled: bool = False
) -> DataFrame:
    """Decision after every window of a monitor history (one row per window and model)."""
    anchor = list(by) if by else [F.lit(0)]
    last = Window.partitionBy(*anchor).orderBy(seq).rowsBetween(-(RETRAIN_WINDOWS - 1), 0)
    recalls = F.col("realized_recall")
    weak = (F.count(recalls).over(last) == RETRAIN_WINDOWS) & (F.max(recalls).over(last) < RECALL_RETRAIN)
    reasons = F.array_compact(
        F.array(
            F.when(F.lit(scheduled), F.lit("scheduled_weekly")),
            F.when(F.col("drift_share") >= DRIFT_SHARE_LIMIT, F.lit("data_drift")),
            F.when(weak, F.lit("concept_drift_two_windows")),
        )
    )
    return history.withColumn("reasons", reasons).withColumn("retrain", F.size("reasons") > 0)


def scheduled_only(df: DataFrame) -> DataFrame:
    """Decision of a scheduled run that has no history yet."""
    return df.select(F.array(F.lit("scheduled_weekly")).alias("reasons"), F.lit(True).alias("retrain"))


@dataclass(frozen=True)
class Shift:
    """value * scale + offset, clipped to the contract range."""

    scale: float
    offset: float
    low: float
    high: float


def shift_features(df: DataFrame, recipe: dict[str, Shift]) -> DataFrame:
    """Move numeric columns while keeping them inside the contract; nulls stay null."""
    out = []
    for c in df.columns:
        if c in recipe:
            s = recipe[c]
            v = F.col(c).cast("double")
            v = v * F.lit(s.scale) if s.scale != 1.0 else v
            out.append(X.clip(v + F.lit(s.offset), s.low, s.high).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def flip_labels(
    df: DataFrame, target: str, a: str, b: str, key: Sequence[str], rate: float = 0.45, seed: int = 7
) -> DataFrame:
    """Swap the two label values on a key-hash share of the rows."""
    hit = X.unit_hash([F.col(c) for c in key], seed) < F.lit(rate)
    return df.withColumn(target, F.when(hit, X.swap(F.col(target), a, b)).otherwise(F.col(target)))
