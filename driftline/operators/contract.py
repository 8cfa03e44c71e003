"""Data contract: every rule of every row in one pass, in long form.

Rows without a fault are dropped by one generated boolean before any failure struct is built, so
the cost on clean data is a filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.spec import Rule, TableSpec

PREVIEW = 20  # Fixed value: failures listed in a report before the total.


ABSENT = "column_in_dataframe"  # Fixed value: check that a declared column without data fails.


class ContractError(RuntimeError):
    """A batch broke its contract; it must not be trained on or scored."""

    def __init__(self, message: str, total_failures: int = 0) -> None:
        super().__init__(message)
        self.total_failures = total_failures


def _ordinal(spec: TableSpec, column: str) -> int:
    return next((i for i, r in enumerate(spec.rules) if r.column == column), len(spec.rules))


def present_rules(df: DataFrame, spec: TableSpec, require_target: bool) -> list[tuple[int, Rule]]:
    return [(i, r) for i, r in spec.rules_for(require_target) if r.column in df.columns]


def missing_columns(df: DataFrame, spec: TableSpec, require_target: bool) -> list[str]:
    return [c for c in spec.required_columns(require_target) if c not in df.columns]


def any_violation(rules: list[tuple[int, Rule]]) -> Column:
    return reduce(lambda a, b: a | b, [r.violated() for _, r in rules], F.lit(False))


def _failures(rules: list[tuple[int, Rule]]) -> Column:
    cases = [
        F.when(
            r.violated(),
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(r.column).alias("column"),
                F.lit(r.check).alias("check"),
                F.col(r.column).cast("string").alias("value"),
            ),
        )
        for i, r in rules
    ]
    return F.array_compact(F.array(*cases))


def violations(
    df: DataFrame, spec: TableSpec, require_target: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per failed check: key columns, `keep` columns, ordinal, column, check, value.

    A declared column that is absent gives one failure with a null key.
    """
    rules = present_rules(df, spec, require_target)
    ids = [c for c in dict.fromkeys((*keep, *spec.key)) if c in df.columns]
    bad = df.where(any_violation(rules))
    out = bad.select(*ids, F.explode(_failures(rules)).alias("__f")).select(*ids, "__f.*")
    for c in missing_columns(df, spec, require_target):
        row = df.sparkSession.range(1).select(
            *[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in ids],
            F.lit(_ordinal(spec, c)).alias("ordinal"),
            F.lit(c).alias("column"),
            F.lit(ABSENT).alias("check"),
            F.lit(None).cast("string").alias("value"),
        )
        out = out.unionByName(row)
    return out


def violation_summary(
    df: DataFrame, spec: TableSpec, require_target: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    """Failure count of every rule (zero included), one aggregation over the table.

    A declared column that is absent counts once for every group.
    """
    rules = present_rules(df, spec, require_target)
    counts = df.groupBy(*by).agg(*[F.count_if(r.violated()).alias(f"r{i}") for i, r in rules])
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(r.column).alias("column"),
                F.lit(r.check).alias("check"),
                F.col(f"r{i}").alias("failures"),
            )
            for i, r in rules
        ],
        *[
            F.struct(
                F.lit(_ordinal(spec, c)).alias("ordinal"),
                F.lit(c).alias("column"),
                F.lit(ABSENT).alias("check"),
                F.lit(1).cast("bigint").alias("failures"),
            )
            for c in missing_columns(df, spec, require_target)
        ],
    )
    return counts.select(*by, F.explode(entries).alias("__e")).select(*by, "__e.*")


def failure_report(found: DataFrame, key: Sequence[str], limit: int = PREVIEW) -> DataFrame:
    """First `limit` failures in rule order, then key order, each with the overall total."""
    total = found.agg(F.count("*").alias("total_failures"))
    order = ["ordinal", *key]
    return found.orderBy(*order).limit(limit).crossJoin(F.broadcast(total))


def report_text(report: DataFrame, key: Sequence[str]) -> str:
    """The operator-facing message; at most PREVIEW rows reach the driver."""
    rows = report.collect()
    lines = ["validation failed"]
    for r in sorted(rows, key=lambda r: (r["ordinal"], tuple(str(r[k]) for k in key))):
        row_key = "/".join(str(r[k]) for k in key if k in r)
        lines.append(f"- column={r['column']} check={r['check']} row={row_key} value={r['value']}")
    lines.append(f"total_failures={rows[0]['total_failures'] if rows else 0}")
    return "\n".join(lines)


def gate_batch(df: DataFrame, spec: TableSpec, require_target: bool = True) -> DataFrame:
    """Return the batch unchanged, or raise: one bad cell rejects the whole batch."""
    total = violation_summary(df, spec, require_target).agg(F.sum("failures")).first()[0] or 0
    if not total:
        return df
    found = violations(df, spec, require_target).orderBy("ordinal", *spec.key).limit(PREVIEW)
    report = found.withColumn("total_failures", F.lit(total))
    raise ContractError(report_text(report, spec.key), total)


def gate_batches(df: DataFrame, spec: TableSpec, batch: Sequence[str], require_target: bool = True) -> DataFrame:
    """Accept/reject verdict per batch when many batches share one table.

    Every declared column that is absent is one failure of every batch.
    """
    rules = present_rules(df, spec, require_target)
    absent = len(missing_columns(df, spec, require_target))
    faults = reduce(lambda a, b: a + b, [r.violated().cast("int") for _, r in rules], F.lit(0))
    return df.groupBy(*batch).agg(
        F.count("*").alias("n_rows"),
        (F.sum(faults) + absent).cast("bigint").alias("total_failures"),
        ((F.max(faults) == 0) & F.lit(absent == 0)).alias("accepted"),
    )


def with_reasons(df: DataFrame, spec: TableSpec, require_target: bool = False) -> DataFrame:
    """Add `reasons`, the failed checks of the row in rule order (empty = accepted).

    A plain projection: the same code gates a batch and a stream.
    """
    rules = present_rules(df, spec, require_target)
    cases = [F.when(r.violated(), F.lit(f"{r.column} {r.check}")) for _, r in rules]
    for c in missing_columns(df, spec, require_target):
        cases.append(F.lit(f"{c} {ABSENT}"))
    return df.withColumn("reasons", F.array_compact(F.array(*cases)))


def gate_rows(df: DataFrame, spec: TableSpec, require_target: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with their reasons).

    One compiled boolean decides; reasons are only built for the rows that fail. A declared
    column that is absent rejects every row.
    """
    if missing_columns(df, spec, require_target):
        return df.where(F.lit(False)), with_reasons(df, spec, require_target)
    bad = any_violation(present_rules(df, spec, require_target))
    return df.where(~bad), with_reasons(df.where(bad), spec, require_target)


def contract_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The contract as a table, one row per rule."""
    rows = [
        (
            spec.name,
            spec.version,
            i,
            r.column,
            r.check,
            r.kind,
            None if r.bound is None else float(r.bound),
            list(r.values),
            r.training,
            r.column == spec.target,
        )
        for i, r in enumerate(spec.rules)
    ]
    return spark.createDataFrame(
        rows,
        "contract string, version string, ordinal int, `column` string, `check` string, kind string, "
        "bound double, allowed array<string>, training_only boolean, is_target boolean",
    )


def contract_document(df: DataFrame, spec: TableSpec, require_target: bool = True) -> DataFrame:
    """The contract as a table, with the values that each rule judged in `df` and the failures among them.

    A rule that was not applied (its column is absent, or it is a training rule at serving) has null counts.
    """
    rules = present_rules(df, spec, require_target)
    judged = {i: F.count("*") if r.kind == "not_null" else F.count(r.column) for i, r in rules}
    counts = df.agg(*(c.alias(f"n{i}") for i, c in judged.items()), *(F.count_if(r.violated()).alias(f"f{i}") for i, r in rules))
    entries = [F.struct(F.lit(i).alias("ordinal"), F.col(f"n{i}").alias("n_judged"), F.col(f"f{i}").alias("failures")) for i, _ in rules]
    document = contract_table(df.sparkSession, spec)
    if not entries:
        return document.withColumns({n: F.lit(None).cast("bigint") for n in ("n_judged", "failures")})
    told = counts.select(F.inline(F.array(*entries)))
    return document.join(told, "ordinal", "left")


def inject(df: DataFrame, recipe: dict[str, tuple[Column, object]]) -> DataFrame:
    """Overwrite cells where a predicate holds: column -> (predicate, bad value)."""
    out = []
    for c in df.columns:
        if c in recipe:
            where, bad = recipe[c]
            out.append(F.when(where, F.lit(bad).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
