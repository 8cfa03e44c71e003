"""Quality rules: a bitmask ledger filled in one pass, policies and ablations as bit arithmetic on it.

`ledger` evaluates every rule once per row and keeps the measurements and one long whose bit i says that
rule i failed. A policy is a versioned mask over those bits: applying another version, or asking what one
rule alone rejects, never reads a text again. All work on texts is row-local: no shuffle.

Defined cases: a null or empty text has no words and fails `few_words`; repeated rows are judged each on
its own; a null id is kept as it is; only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import BLANKS, col, let, words_of

WINDOW = 8

#: Measurements in ledger order; all are long.
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct_words",
    "n_upper",
    "n_shouts",
)

#: Rules in bit order: name and failing condition. The text is valid in Spark and in DuckDB.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines"),
    ("few_distinct_words", "n_words < 1000 AND 100 * n_distinct_words < 42 * n_words"),
    ("upper_case", "100 * n_upper > 40 * word_chars"),
    ("shouting", "10 * n_shouts > n_words"),
    ("long_words", "word_chars > 40 * n_words"),
)
BASE_RULES = ("few_words", "repeated_windows")


def bits(*names: str) -> int:
    order = [name for name, _ in RULES]
    return sum(1 << order.index(name) for name in names)


@dataclass(frozen=True)
class Policy:
    """A version of the decision: a row is rejected when it fails any rule of the mask."""

    version: int
    mask: int

    def kept(self, fail_bits: Column) -> Column:
        return fail_bits.bitwiseAND(F.lit(self.mask)) == 0


POLICIES = {
    1: Policy(1, bits(*BASE_RULES)),
    2: Policy(2, bits(*(name for name, _ in RULES))),
}
CURRENT = POLICIES[2]


def _repeated(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text.

    Windows are compared by a 64-bit hash. Only texts that have a repeated hash are sorted.
    """

    def joined(step: int) -> Callable[[Column], Column]:
        return lambda a: F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + step)))

    def of_hashes(words: Column) -> Column:
        last = F.size(words) - WINDOW + 1
        hashes = F.transform(words, lambda x: F.xxhash64(x))
        for step in (1, 2, 4):  # hashes of 2, 4, then 8 words
            hashes = let(hashes, joined(step))
        return F.when(last < 2, F.lit(0)).otherwise(let(F.slice(hashes, F.lit(1), last), covered))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(pairs, lambda s: let(F.sort_array(F.transform(twice(s), lambda x: x["i"])), span))
        )

    def twice(s: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))

        return F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))

    def span(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    return let(words, of_hashes)


def _without(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, MEASURES, fail_bits."""
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("t"))
    rows = rows.select(
        "doc_id",
        "t",
        words_of(F.col("t")).alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{BLANKS}]")).alias("l"),
    )
    rows = rows.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _without(F.col("t"), "[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("w")).cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct_words"),
        _without(F.col("t"), r"\p{Lu}").cast("long").alias("n_upper"),
        _without(F.col("t"), "!").cast("long").alias("n_shouts"),
    )
    mask = " + ".join(f"(CASE WHEN {rule} THEN {1 << i}L ELSE 0L END)" for i, (_, rule) in enumerate(RULES))
    return rows.withColumn("fail_bits", F.expr(mask))


def decide(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Ledger rows with base_failed, policy version and kept."""
    base = F.col("fail_bits").bitwiseAND(F.lit(bits(*BASE_RULES))) != 0
    return rows.select(
        "*",
        base.alias("base_failed"),
        F.lit(policy.version).alias("policy"),
        (~base & policy.kept(F.col("fail_bits"))).alias("kept"),
    )


def ablations(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Per rule of the policy: rows that fail it, and rows that only it rejects.

    The ledger shrinks to one counter per distinct combination of bits (at most two to the number of rules)
    before anything is shuffled; `rescued` is what dropping the rule alone would let through.
    """
    combos = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("b")).agg(F.count("*").alias("n"))
    named = F.array(
        *(
            F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
            for i, (name, _) in enumerate(RULES)
            if policy.mask >> i & 1
        )
    )
    each = combos.select("b", "n", F.explode(named).alias("r")).select("b", "n", "r.rule", "r.bit")
    return each.groupBy("rule", "bit").agg(
        F.sum(F.when(F.col("b").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("b") == F.col("bit"), F.col("n")).otherwise(0)).alias("rescued"),
        F.sum("n").alias("n_rows"),
    )


def compare_policies(rows: DataFrame, old: Policy, new: Policy) -> DataFrame:
    """How many rows two policy versions decide alike or differently."""
    return rows.groupBy(
        old.kept(F.col("fail_bits")).alias("kept_old"), new.kept(F.col("fail_bits")).alias("kept_new")
    ).agg(F.count("*").alias("n_rows"))


def keep_good(docs: DataFrame, policy: Policy = CURRENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that the policy keeps, all columns as they came, in one pass without a join."""
    wrapped = docs.select(
        F.struct(*(col(c) for c in docs.columns)).alias("row"),
        col(id_col).alias("doc_id"),
        col(text_col).alias("text"),
    )
    judged = _judge_beside(wrapped, policy)
    return judged.where("kept").select("row.*")


def _judge_beside(wrapped: DataFrame, policy: Policy) -> DataFrame:
    """`decide(ledger(..))` with the whole row carried in the id's place."""
    rows = wrapped.select(F.struct("row", "doc_id").alias("doc_id"), "text")
    return decide(ledger(rows), policy).select(F.col("doc_id.row").alias("row"), "kept")
