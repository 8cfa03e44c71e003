"""Counters of windows: all that drift and realised metrics need of their rows, in one aggregation.

Each row gives one entry a numeric column (its bin), one a categorical column (its category), one for its score
and, for the second detector, one a numeric value. Entries are counted per window. The same aggregation serves a
table and a stream: on a stream the counters are the state, which follows columns, bins and categories, not rows,
and is dropped when its window closes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions import columns as X
from driftline.functions.columns import ratio
from driftline.operators import metrics as M
from driftline.operators.ordered import passed_sql, sql_double

#: Decimals of the scores that are told apart; they bound the counters of a window's scores.
SCORE_PLACES = 6
#: Cells of numbers outside the cuts and of missing ones.
OUTSIDE, MISSING = -1, -2
UNUSABLE = -1

_ENTRY = ("kind", "ordinal", "cell", "value", "number")


def _bin_sql(edges: Sequence[Sequence[float]]) -> str:
    """SQL of the bin of `number` in column number `ordinal`: [a, b), the last one closed."""
    usable = [e if len(e) > 1 else [] for e in edges]
    if not any(usable):
        return f"CASE WHEN number IS NULL THEN {MISSING} ELSE {OUTSIDE} END"
    top = ", ".join(sql_double(e[-1]) if e else "double('NaN')" for e in usable)
    last = ", ".join(str(len(e) - 1) for e in usable)
    inside = f"least({passed_sql(usable, 'ordinal', 'number')}, get(array({last}), ordinal)) - 1"
    return (
        f"CASE WHEN number IS NULL THEN {MISSING} WHEN isnan(get(array({top}), ordinal)) THEN {OUTSIDE} "
        f"WHEN number <= get(array({top}), ordinal) THEN {inside} ELSE {OUTSIDE} END"
    )


def count_entries(
    rows: DataFrame,
    edges: dict[str, Sequence[float]],
    text: Sequence[str],
    by: Sequence[str],
    threshold: float,
    label: str = "label",
    proba: str = "proba",
    values: bool = False,
) -> DataFrame:
    """(by.., kind, ordinal, cell, value, number, n); `rows` may be a stream whose `by` is a watermarked window.

    `edges` are the cuts of the numeric columns. A score entry's cell is 2 * label + hit.
    """
    number = "CAST(`{c}` AS DOUBLE)"
    entries = [f"struct('bin', {i}, CAST(NULL AS INT), CAST(NULL AS STRING), nanvl({number.format(c=c)}, NULL))" for i, c in enumerate(edges)]
    if values:
        finite = "CASE WHEN abs({v}) < double('Infinity') THEN {v} END"
        entries += [
            f"struct('value', {i}, CAST(NULL AS INT), CAST(NULL AS STRING), {finite.format(v=number.format(c=c))})"
            for i, c in enumerate(edges)
        ]
    entries += [f"struct('category', {j}, CAST(NULL AS INT), CAST(`{c}` AS STRING), CAST(NULL AS DOUBLE))" for j, c in enumerate(text)]
    usable = f"coalesce(`{label}` IN (0, 1) AND `{proba}` IS NOT NULL AND NOT isnan(`{proba}`), false)"
    hit = f"CAST(`{proba}` >= {sql_double(threshold)} AS INT)"
    entries.append(
        f"struct('score', 0, CASE WHEN {usable} THEN CAST(2 * `{label}` + {hit} AS INT) ELSE {UNUSABLE} END, "
        f"CAST(NULL AS STRING), CASE WHEN {usable} THEN round(CAST(`{proba}` AS DOUBLE), {SCORE_PLACES}) END)"
    )
    names = ", ".join(_ENTRY)
    long = rows.select(*by, F.expr(f"inline(array({', '.join(entries)}))").alias(*_ENTRY))
    long = long.where("kind <> 'value' OR number IS NOT NULL")
    cell = f"CASE WHEN kind = 'bin' THEN {_bin_sql(list(edges.values()))} ELSE cell END AS cell" if edges else "cell"
    kept = "CASE WHEN kind <> 'bin' THEN number END AS number"
    long = long.selectExpr(*[f"`{b}`" for b in by], "kind", "ordinal", cell, "value", kept)
    return long.groupBy(*by, *names.split(", ")).agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Tally:
    """Counted entries of windows, read as the detectors need them."""

    table: DataFrame
    by: tuple[str, ...]
    numeric: tuple[str, ...]
    text: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [*self.by, *self.numeric, *self.text]

    def _named(self, kind: str, names: Sequence[str], cols: Sequence[str]) -> DataFrame:
        """Entries of a kind with the column's name, for the columns asked for."""
        if not names:
            return self.table.where("false").withColumn("column", F.lit(None).cast("string"))
        listed = F.array(*(F.lit(c) for c in names))
        found = self.table.where(F.col("kind") == kind).withColumn("column", F.get(listed, F.col("ordinal")))
        return found.where(F.col("column").isin(*cols)) if cols else found.where("false")

    def bins(self, cols: Sequence[str], bins: int) -> DataFrame:
        """(by.., ordinal in cols, column, cn, c0, ..)."""
        place = F.array_position(F.array(*(F.lit(c) for c in cols)), F.col("column")) - 1
        found = self._named("bin", self.numeric, cols).withColumn("ordinal", place.cast("int"))

        def total(condition):
            return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

        return found.groupBy(*self.by, "ordinal", "column").agg(
            total(F.col("cell") != MISSING).alias("cn"), *(total(F.col("cell") == k).alias(f"c{k}") for k in range(bins))
        )

    def categories(self, cols: Sequence[str]) -> DataFrame:
        found = self._named("category", self.text, cols)
        return found.groupBy(*self.by, "column", "value").agg(F.sum("n").alias("cc"))

    def filled(self) -> Tally:
        """Missing categories as the category of missing ones."""
        value = F.when(F.col("kind") == "category", X.fill_cat(F.col("value"))).otherwise(F.col("value"))
        return replace(self, table=self.table.withColumn("value", value))

    def rows(self) -> DataFrame:
        """(by.., cn): every row has one score entry."""
        return self.table.where("kind = 'score'").groupBy(*self.by).agg(F.sum("n").alias("cn"))

    def values(self, cols: Sequence[str]) -> DataFrame:
        found = self._named("value", self.numeric, cols).withColumnRenamed("number", "v")
        return found.groupBy(*self.by, "column", "v").agg(F.sum("n").alias("c"))

    def realized(self) -> DataFrame:
        """Realised recall and AUC; recall at the threshold of counting, AUC of scores to SCORE_PLACES decimals."""
        scores = self.table.where("kind = 'score'").select(*self.by, "cell", F.col("number").alias("proba"), "n")
        scores = scores.withColumn("label", F.when(F.col("cell") >= 0, F.shiftright("cell", 1)))
        hits, misses = (F.coalesce(F.sum(F.when(F.col("cell") == c, F.col("n"))), F.lit(0)) for c in (3, 2))
        recall = scores.groupBy(*self.by).agg(ratio(hits, hits + misses).alias("realized_recall"))
        auc = M.roc_auc(scores, self.by, "label", "proba", "n").withColumnRenamed("roc_auc", "realized_roc_auc")
        return recall.join(auc, list(self.by), "left")


def tally(
    rows: DataFrame,
    known,
    by: Sequence[str],
    threshold: float,
    label: str = "label",
    proba: str = "proba",
    values: bool = False,
) -> Tally:
    """Counters of a table's windows against a reference profile."""
    has = set(rows.columns)
    edges = {c: known.cuts.edges[c] for c in known.numeric if c in has}
    text = [c for c in known.text if c in has]
    counted = count_entries(rows, edges, text, by, threshold, label, proba, values)
    return Tally(counted, tuple(by), tuple(edges), tuple(text))
