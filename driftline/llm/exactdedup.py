"""Exact dedup: rows grouped by a 128-bit content hash, bytes compared inside groups, one row of each class stays.

Texts are equal when they are identical after deleting every blank (`[\\x20\\x09-\\x0D]`). The method:

1. One map gives each row a small entry: a row number, the id, the hash of its normalised text, its length and
   digest. The entries are written, so that row numbers hold for the whole run.
2. Entries are grouped by hash with partial sums in the map tasks: size, and the row that stays (most code
   points in the original text, then smallest id, then first row).
3. Bytes are compared by grouping the normalised texts themselves by (hash, text): copies meet in the map task
   already, so a group of any size travels as one text a task. A hash with two texts is a collision. Rows of such
   hashes go through 2 once more with the text in the hash's place, so that the result is exact for any hash.
4. Each entry is joined to its group. Groups of more than one `HOT`th of all entries, fewer than `HOT` by that
   definition, are broadcast as a list and their entries are salted, so that no task gets a hot group whole.

Only the texts of 3 are shuffled; the driver sees counts.

Defined cases: a null text counts as empty, and all empty or blank texts are equal; of repeated rows (same id, same
text) exactly one stays; null ids come after all others; ids may have any ordered type; an empty table gives an
empty result; `keep_one` returns other columns as they came, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import col, stored

#: A group is hot with more than this part of all rows; so fewer groups than this can be hot.
HOT = 4096
#: Rows of a hot group that go to one task.
SALT_ROWS = 500


def without_blanks(text: Column) -> Column:
    """The text without any of the six blanks; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\f\r", "")


def content_hash(normal: Column) -> Column:
    """128 bits over the normalised text."""
    return F.unhex(F.md5(normal))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), col(text_col).alias("text"))


def _entries(rows: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """Rows (row, id, text) without their texts, but with key, length and digest."""
    normal = without_blanks(F.col("text"))
    length = F.length(F.coalesce("text", F.lit(""))).cast("long")
    return rows.select("row", "id", key(normal).alias("key"), length.alias("n_chars"), F.sha2(normal, 256).alias("text_sha256"))


def _decided(entries: DataFrame) -> DataFrame:
    """Entries with the id that stays, the size of their group and whether they are the row that stays."""
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.isnull("id").alias("no_id"), "id", "row"))
    groups = entries.groupBy("key").agg(F.count("*").alias("group_size"), best.alias("best"))
    groups = groups.select("key", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    total = entries.count()
    salts = F.ceil(F.col("group_size") / SALT_ROWS)
    groups = groups.withColumn("salts", F.when(F.col("group_size") * HOT > total, salts).otherwise(1))
    # fewer than HOT rows, by the definition of a hot group
    hot = groups.where("salts > 1").select("key", "salts")
    salted = entries.join(F.broadcast(hot), "key", "left")
    salted = salted.withColumn("salt", F.col("row") % F.coalesce("salts", F.lit(1))).drop("salts")
    spread = groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    return salted.join(spread, ["key", "salt"]).withColumn("kept", F.col("row") == F.col("keep_row"))


def _collisions(rows: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """Hashes that two different normalised texts share; bytes are compared by grouping the texts themselves."""
    normal = without_blanks(F.col("text"))
    texts = rows.select(key(normal).alias("key"), normal.alias("normal")).groupBy("key", "normal").agg(F.count("*").alias("n"))
    return texts.groupBy("key").agg(F.count("*").alias("n_texts")).where("n_texts > 1").select("key")


_RESULT = ["row", "id", "keep_id", "group_size", "kept", "text_sha256"]


def _told(rows: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """The decision on rows (row, id, text); `row` must be unique."""
    entries = stored(_entries(rows, key), "exact-entries")
    shared = stored(_collisions(rows, key), "exact-collisions")
    told = _decided(entries)
    if shared.isEmpty():
        return told.select(*_RESULT)
    # The same with the text as key, for the rows of these hashes only.
    their = rows.withColumn("key", key(without_blanks(F.col("text")))).join(shared, "key", "left_semi")
    again = stored(_entries(their, lambda normal: normal.cast("binary")), "exact-collided")
    return told.join(shared, "key", "left_anti").select(*_RESULT).unionByName(_decided(again).select(*_RESULT))


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    key: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row a document: id, keep_id, group_size, kept, text_sha256."""
    return _told(_rows(docs, id_col, text_col), key).drop("row")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, columns as they came; the table is written once with its row numbers."""
    whole = F.struct(*(col(c) for c in docs.columns)).alias("doc")
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("row"), whole), "exact-rows")
    doc = F.col("doc")
    rows = numbered.select("row", doc.getField(id_col).alias("id"), doc.getField(text_col).alias("text"))
    gone = _told(rows, content_hash).where("NOT kept").select("row")
    return numbered.join(gone, "row", "left_anti").select("doc.*")


def digests(told: DataFrame) -> DataFrame:
    """The result with the id under the documents' name."""
    return told.withColumnRenamed("id", "doc_id")
