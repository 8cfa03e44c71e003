"""Document fingerprints: SimHash over weighted terms, and permuted block tables for a Hamming radius.

A term is a distinct word of a text, its weight the characters of the word. Each term's 64-bit hash votes with its
weight for every bit that it sets; a bit is set when more than half of the weight votes for it. Two votes are kept
in one long, so a text needs 32 sums, formed in the scan task before anything is shuffled, whatever its length (the
weights of a text add up to less than 2**31). Single words move fewer bits than word pairs do: a changed word is one
term of the old text and one of the new instead of two each.

`near` cuts a fingerprint into BLOCKS blocks and keeps one table for each choice of BLOCKS - radius blocks:
two fingerprints within the radius agree on all chosen blocks of some table. Equal fingerprints are one class,
so copies cost one row; tables hold a hashed key and the fingerprint, 16 bytes of data. A pair counts in the first
table in which it meets. Spark sizes the tables as if they had a row a class, so their joins are by sorting, whatever it
makes of the size: a broadcast would pass all of them through the driver.

`successors` gives each row the next one by descending id without sorting the table in one task: rows are
dealt out by id ranges, and only each range's last row looks into the next range.

Defined cases: ids are numbers; a null or empty text has fingerprint 0; rows of equal id are ordered by text, null ids come
last; a table of one row is its own successor; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import col, looked_up, partitions, stored, words_of

BITS = 64
#: Texts at 5-shingle similarity 0.85 mostly differ in up to 6 bits; two blocks more than that leave two to agree on.
BLOCKS = 8
RADIUS = 6
_PAIR = (1 << 32) + 1


def fingerprints(texts: DataFrame) -> DataFrame:
    """(doc_id, h, f) for rows (doc_id, h, t): the fingerprint of t. Texts without words give no row."""
    words = texts.select("doc_id", "h", F.explode(F.array_distinct(words_of(F.col("t")))).alias("w"))
    terms = words.select("doc_id", "h", F.xxhash64("w").alias("x"), F.length("w").cast("long").alias("n"))
    votes = [
        F.sum(F.shiftrightunsigned("x", j).bitwiseAND(F.lit(_PAIR)) * F.col("n")).alias(f"v{j}") for j in range(32)
    ]
    summed = terms.groupBy("doc_id", "h").agg(F.sum("n").alias("total"), *votes)

    def bit(votes: Column, at: int) -> Column:
        return F.when(2 * votes > F.col("total"), F.lit(1 << at if at < 63 else -(1 << 63))).otherwise(F.lit(0).cast("long"))

    low = [bit(F.col(f"v{j}").bitwiseAND(F.lit((1 << 32) - 1)), j) for j in range(32)]
    high = [bit(F.shiftrightunsigned(f"v{j}", 32), j + 32) for j in range(32)]
    return summed.select("doc_id", "h", reduce(Column.bitwiseOR, low + high).alias("f"))


def likeness(a: Column, b: Column) -> Column:
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, t, next_id, next_t): each row and the next one by descending id; after the last, the first."""
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("t"))
    n = 4 * partitions(docs.sparkSession)
    steps = F.array(*(F.lit(k / n) for k in range(1, n)))
    found = rows.agg(F.percentile_approx("doc_id", steps, 10 * n).alias("b")).first()["b"]
    bounds = sorted(set(found or []))
    ranges = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: F.col("doc_id") >= b)) if bounds else F.lit(0)
    rows = rows.withColumn("r", ranges)
    order = (F.col("doc_id").desc_nulls_last(), F.col("t"))
    within = Window.partitionBy("r").orderBy(*order)
    led = rows.withColumn("after", F.lead(F.struct("doc_id", "t")).over(within))

    # the first row of each range: as many rows as there are ranges
    tops = rows.groupBy("r").agg(F.max("doc_id").alias("top")).withColumnRenamed("r", "tr")
    firsts = rows.join(F.broadcast(tops), (F.col("r") == F.col("tr")) & F.col("doc_id").eqNullSafe(F.col("top")))
    firsts = firsts.groupBy("r", "doc_id").agg(F.min("t").alias("t"))
    down = Window.orderBy(F.col("r").desc())
    whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.struct("doc_id", "t")
    below = firsts.select("r", F.coalesce(F.lead(first).over(down), F.first(first).over(whole)).alias("below"))

    told = led.join(below, "r", "left").withColumn("s", F.coalesce("after", "below"))
    return told.select("doc_id", "t", F.col("s.doc_id").alias("next_id"), F.col("s.t").alias("next_t"))


def edited(text: Column, other: Column) -> Column:
    """The text with its last half replaced by as many first code points of the other (or all)."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its fingerprint, those of its edited text and of its successor, and how alike they are (as longs)."""
    rows = successors(docs, id_col, text_col).withColumn("e", edited(F.col("t"), F.col("next_t")))
    both = F.array(
        F.struct(text_hash(F.col("t")).alias("h"), F.col("t").alias("t")),
        F.struct(text_hash(F.col("e")).alias("h"), F.col("e").alias("t")),
    )
    f = fingerprints(rows.select("doc_id", F.explode(both).alias("x")).select("doc_id", "x.h", "x.t"))
    told = rows.select(
        "doc_id",
        "next_id",
        F.length("t").cast("long").alias("n_chars"),
        F.sha2("e", 256).alias("edited_sha256"),
        text_hash(F.col("t")).alias("h"),
        text_hash(F.col("e")).alias("eh"),
        text_hash(F.col("next_t")).alias("nh"),
    )
    for name, key, h in (("own", "doc_id", "h"), ("changed", "doc_id", "eh"), ("following", "next_id", "nh")):
        side = f.select(F.col("doc_id").alias("k"), F.col("h").alias("kh"), F.col("f").alias(name))
        told = told.join(side, F.col(key).eqNullSafe(F.col("k")) & (F.col(h) == F.col("kh")), "left").drop("k", "kh")
    zero = F.lit(0).cast("long")
    return told.select(
        "doc_id",
        "next_id",
        "n_chars",
        "edited_sha256",
        *(F.coalesce(c, zero).alias(c) for c in ("own", "changed", "following")),
    )


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """One mask a table: the bits of the blocks that must agree."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    each = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(each, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near(queries: DataFrame, classes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(q, f, distance): distinct fingerprints (f) within the radius of distinct query fingerprints (q)."""
    masks = block_masks(radius, blocks)

    def key(f: Column, i: int) -> Column:
        return F.xxhash64(F.lit(i), f.bitwiseAND(F.lit(masks[i])))

    def tables(f: Column) -> Column:
        return F.explode(F.array(*(key(f, i) for i in range(len(masks))))).alias("key")

    left = queries.select("q", tables(F.col("q")))
    right = classes.select("f", tables(F.col("f")))
    differ = F.col("q").bitwiseXOR(F.col("f"))
    first = reduce(
        lambda rest, i: F.when(differ.bitwiseAND(F.lit(masks[i])) == 0, key(F.col("q"), i)).otherwise(rest),
        reversed(range(len(masks))),
        F.lit(None).cast("long"),
    )
    met = left.hint("merge").join(right.hint("merge"), "key").where((F.bit_count(differ) <= radius) & (F.col("key") == first))
    return met.select("q", "f", F.bit_count(differ).alias("distance"))


def near_counts(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For the fingerprints q of rows (doc_id, f) whose id is divisible by 20: other rows within the radius.

    (q, n_asked, n_near, copy_id, near_id, near_distance): how many such rows ask, the number of others, the smallest
    id with q itself, and the smallest id of the nearest other fingerprint with its distance (null if there is none).
    """
    classes = rows.groupBy("f").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"), F.count(F.when(F.col("doc_id") % 20 == 0, 1)).alias("n_asked")
    )
    classes = stored(classes, "fingerprint-classes")
    met = near(classes.where("n_asked > 0").select(F.col("f").alias("q")), classes, radius, max(BLOCKS, radius + 2))
    met = met.join(classes.hint("merge"), "f")
    own = F.col("distance") == 0
    nearest = F.min(F.when(~own, F.struct("distance", "first")))
    found = met.groupBy("q").agg(
        F.max(F.when(own, F.col("n_asked"))).alias("n_asked"),
        (F.sum("n") - 1).alias("n_near"),
        F.min(F.when(own, F.col("first"))).alias("copy_id"),
        nearest.alias("nearest"),
    )
    told = ("q", "n_asked", "n_near", "copy_id")
    return found.select(*told, F.col("nearest.first").alias("near_id"), F.col("nearest.distance").alias("near_distance"))


def with_near(told: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows (a written table with doc_id and own) and what `near_counts` found for those whose id is divisible by 20."""
    counts = stored(near_counts(told.select("doc_id", F.col("own").alias("f")), radius), "fingerprint-near")
    asked = F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))
    answers = counts.withColumnRenamed("q", "own")
    return looked_up(told.where(asked), answers, "own", "n_asked").unionByName(told.where(~asked), allowMissingColumns=True)


def hexed(f: Column) -> Column:
    return F.lower(F.lpad(F.hex(f), 16, "0"))
