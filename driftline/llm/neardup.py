"""MinHash near-dedup with sequential Bayesian verification.

1. A document's set is its distinct 5-word shingles (64-bit hashes); equal sets form one class, so exact copies
   cost one row from here on. A class is named by its smallest id.
2. Signatures of HASHES minimum hashes are cut into bands; classes that agree in a band share a bucket.
   A pair at the threshold t shares none with probability (1 - t**rows)**bands, below one in a million: 24 bands of
   5 hashes at 0.85, 30 of 4 at 0.80.
3. In every bucket each class is paired with the smallest one: at most as many pairs as bands a class, never all pairs.
   Components of the links so found settle most buckets. Buckets that still hold several components are
   dealt out in blocks of bounded size, and each pair of blocks compares classes of different components
   and reports one link for each two components it joins: nothing is left out, no bucket meets in one
   task, and the pairs inside a group are never written out.
4. A candidate's signatures are compared batch by batch; it is dropped as soon as the posterior probability
   that its similarity reaches the threshold falls below `miss`. Survivors are confirmed on the full sets.

Defined cases: a null or empty text, or one without words, has the empty set and is linked with nothing; with
fewer than five words the whole sequence is the one shingle; rows that share an id count as one document; a
row with a null id is linked with nothing, has a null component and is kept; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import col, stored, with_package

SHINGLE = 5
HASHES = 120
#: Similarity of linked documents unless another numerator is given: 100 * intersection >= 85 * union.
NUMERATOR, DENOMINATOR = 85, 100
MISS = 1e-6
BATCH = 24
#: Classes of a bucket that one block holds.
BLOCK = 256
#: Ids up to which a filter on documents is sent to every task; beyond, it is a shuffle join.
FEW_IDS = 200_000
_WORDS_KEPT = 500_000

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


@cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(20240501).integers(0, 2**63, (2, HASHES), np.int64).astype(np.uint64)
    return drawn[0] * np.uint64(2) + np.uint64(1), drawn[1]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_hashes = _Hashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes; bytes.lower and bytes.split are the contract's lower case and words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    if n < SHINGLE:
        return _mix((w * _MULTIPLIERS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    total = np.zeros(n - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        total += w[k : n - SHINGLE + 1 + k] * _MULTIPLIERS[k]
    return np.unique(_mix(total))


def signature(found: np.ndarray) -> np.ndarray:
    a, b = _permutations()
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), 2048):
        best = np.minimum(best, (found[k : k + 2048, None] * a + b).min(axis=0))
    return (best >> np.uint64(32)).astype("<u4")


def _features(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, signatures = [], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text)
            sizes.append(len(found))
            keys.append(blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            signatures.append(signature(found).tobytes() if len(found) else None)
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_key, signature; written once."""
    from pyspark.sql.pandas.types import to_arrow_schema

    with_package(docs.sparkSession)
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("signature", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    return stored(rows.mapInArrow(lambda it: _features(it, arrow), schema), "minhash")


@cache
def least_matches(threshold: float, miss: float = MISS) -> tuple[int, ...]:
    """Matches that a pair needs after each batch, so that P(similarity >= threshold) stays at `miss` or more.

    The similarity has a uniform prior; after m matches in n hashes its posterior is Beta(m + 1, n - m + 1).
    """
    s = (np.arange(200_000) + 0.5) / 200_000
    needed = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log1p(-s)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() >= miss * weight.sum():
                needed.append(m)
                break
    return tuple(needed)


@cache
def banding(numerator: int) -> tuple[int, int]:
    """(bands, rows): the most hashes a band that still miss a pair at the threshold less than once in 1 / MISS."""
    t = numerator / DENOMINATOR
    rows = max(r for r in range(1, HASHES + 1) if HASHES % r == 0 and (r == 1 or (1 - t**r) ** (HASHES // r) <= MISS))
    return HASHES // rows, rows


def surviving(a: np.ndarray, b: np.ndarray, numerator: int = NUMERATOR) -> np.ndarray:
    """Numbers of the rows of signatures that pass every batch."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches(numerator / DENOMINATOR)):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[alive, cut] == b[alive, cut]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)


def _prune(batches: Iterator[pa.RecordBatch], numerator: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            alive = surviving(_signatures(batch.column(2)), _signatures(batch.column(3)), numerator)
            yield batch.select([0, 1]).take(pa.array(alive))


def _confirm(batches: Iterator[pa.RecordBatch], numerator: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(DENOMINATOR * both >= numerator * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))


def _sets(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], schema=schema)


def buckets(classes: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """(bucket, node, first) for each class in a band bucket that others share; `first` is the smallest."""
    n_bands, rows = banding(numerator)
    width = 4 * rows
    bands = F.array(*(F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(n_bands)))
    each = classes.select("node", F.explode(bands).alias("bucket"))
    shared = each.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("n_nodes")).where("n_nodes > 1")
    return each.join(shared, "bucket")


def prune(pairs: DataFrame, classes: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """Candidate pairs (a, b) that similar sizes and the signatures leave possible."""
    of = classes.select("node", "n", "signature")
    both = pairs.join(of.toDF("a", "na", "sa"), "a").join(of.toDF("b", "nb", "sb"), "b")
    likely = both.where(f"{DENOMINATOR} * least(na, nb) >= {numerator} * greatest(na, nb)").select("a", "b", "sa", "sb")
    return likely.mapInArrow(lambda it: _prune(it, numerator), pairs.select("a", "b").schema)


def sets_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, found): full shingle sets of distinct nodes, from docs (id, text); written once."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ids = stored(nodes.select(F.col("node").alias("id")).distinct(), "ids")
    few = ids.count() <= FEW_IDS
    texts = docs.join(F.broadcast(ids) if few else ids, "id", "left_semi").select("id", "text")
    schema = T.StructType([T.StructField("node", texts.schema["id"].dataType), T.StructField("found", T.BinaryType())])
    arrow = to_arrow_schema(schema)
    return stored(texts.mapInArrow(lambda it: _sets(it, arrow), schema), "sets")


def confirm(pairs: DataFrame, docs: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """Pairs whose full sets reach the threshold. `docs` has id and text; pairs must be stored."""
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), docs)
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(lambda it: _confirm(it, numerator), pairs.select("a", "b").schema)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the ends of stored links (a, b): the smallest node reachable.

    Each round takes the smallest label among neighbours and then that label's own label, and is written out.
    """
    both = links.select("a", "b").union(links.select("b", "a")).toDF("node", "other")
    ends = stored(both.distinct(), "ends")
    labels = stored(ends.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")), "labels")
    while True:
        near = ends.join(labels.toDF("other", "l"), "other").groupBy("node").agg(F.min("l").alias("l"))
        nearer = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "l").alias("l"))
        jump = labels.select(F.col("node").alias("l"), F.col("component").alias("j"))
        moved = stored(
            nearer.join(jump, "l", "left").select("node", "old", F.least("l", "j").alias("component")), "labels"
        )
        labels = moved.select("node", "component")
        if moved.where("component <> old").isEmpty():
            return labels


class _Side:
    """Classes of one block: ids, components, sizes, signatures and sets as numbers of the two blocks' shingles."""

    def __init__(self, t: pa.Table) -> None:
        self.ids = t.column("node").to_pylist()
        self.component = t.column("component").to_pylist()
        self.sizes = t.column("n").to_numpy()
        self.signatures = _signatures(t.column("signature"))
        self.sets = [np.frombuffer(x, np.uint64) for x in t.column("found").to_pylist()]


def _cross(table: pa.Table, numerator: int = NUMERATOR) -> pa.Table:
    """Links between components within one block of a bucket, or between two: a spanning set of them.

    A class is compared with those of other components only: sizes, then signatures batch by batch, then
    the full sets of what survives. Linked components count as one from then on, so a block of n classes
    gives less than n links.
    """
    left, right = (table.filter(pc.equal(table.column("side"), s)) for s in (0, 1))
    x = _Side(left)
    y = _Side(right) if right.num_rows else x
    sides = [x] if y is x else [x, y]
    known = np.unique(np.concatenate([f for side in sides for f in side.sets]))
    number = {}
    roots = [np.array([number.setdefault(c, len(number)) for c in side.component]) for side in sides]
    flat = np.searchsorted(known, np.concatenate(y.sets))
    starts = np.concatenate([[0], np.cumsum([len(f) for f in y.sets])])
    has = np.zeros(len(known), bool)
    links = []
    for i in range(len(x.ids)):
        own, others = roots[0][i], roots[-1]
        size = x.sizes[i]
        near = DENOMINATOR * np.minimum(y.sizes, size) >= numerator * np.maximum(y.sizes, size)
        j = np.flatnonzero(near & (others != own))
        if y is x:
            j = j[j > i]
        if not len(j):
            continue
        j = j[surviving(np.broadcast_to(x.signatures[i], (len(j), HASHES)), y.signatures[j], numerator)]
        if not len(j):
            continue
        mine = np.searchsorted(known, x.sets[i])
        has[mine] = True
        both = np.array([np.count_nonzero(has[flat[starts[k] : starts[k + 1]]]) for k in j])
        has[mine] = False
        union = len(mine) + (starts[j + 1] - starts[j]) - both
        for k in j[DENOMINATOR * both >= numerator * union].tolist():
            a, b = roots[0][i], roots[-1][k]
            if a != b:
                links.append((x.ids[i], y.ids[k]))
                for side in roots:
                    side[side == b] = a
    kind = table.schema.field("node").type
    return pa.table({"a": pa.array([a for a, _ in links], kind), "b": pa.array([b for _, b in links], kind)})


def unsettled(
    members: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, numerator: int = NUMERATOR
) -> DataFrame:
    """Links (a, b) between components in buckets of three or more classes, found by pairs of blocks."""
    held = members.where("n_nodes > 2").join(labels, "node", "left")
    held = held.withColumn("component", F.coalesce("component", "node"))
    mixed = held.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    held = stored(held.join(mixed.where("lo <> hi").select("bucket"), "bucket"), "unsettled")
    full = classes.select("node", "n", "signature").join(sets_of(held.select("node"), docs), "node")
    blocks = F.ceil(F.col("n_nodes") / F.lit(BLOCK)).cast("int")
    held = held.select("bucket", "node", "component", blocks.alias("blocks"))
    held = held.withColumn("own", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int"))
    dealt = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "node",
        "component",
    )
    node = classes.schema["node"].dataType
    schema = T.StructType([T.StructField("a", node), T.StructField("b", node)])
    return dealt.join(full, "node").groupBy("bucket", "i", "j").applyInArrow(lambda t: _cross(t, numerator), schema)


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", numerator: int = NUMERATOR) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, kept; linked are documents alike to numerator / DENOMINATOR."""
    found = features(docs, id_col, text_col)
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    named = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        named.groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("c"))
        .select("set_key", F.col("c.doc_id").alias("node"), F.col("c.n_shingles").alias("n"), "c.signature"),
        "classes",
    )
    members = stored(buckets(classes, numerator), "buckets")
    stars = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(confirm(stored(prune(stars, classes, numerator), "pairs"), texts, numerator), "links")
    labels = components(links)
    rest = stored(unsettled(members, labels, classes, texts, numerator), "links")
    if not rest.isEmpty():
        labels = components(links.unionByName(rest))
    of_set = classes.select("set_key", "node").join(labels, "node", "left")
    of_set = of_set.select("set_key", F.coalesce("component", "node").alias("component"))
    rows = found.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", numerator: int = NUMERATOR) -> DataFrame:
    """The document of smallest id of each component, and rows with a null id; columns as they came."""
    gone = link(docs, id_col, text_col, numerator).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct(*(col(c) for c in docs.columns)).alias("row"), col(id_col).alias("key"))
    return rows.join(gone, F.col("key") == F.col("gone"), "left_anti").select("row.*")
