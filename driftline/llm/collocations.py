"""Phrase collocation mining with counting quotient filters of word-id n-grams.

1. One map reads the texts in blocks (bounded in characters; a block is one shard), splits them into pieces and words,
   numbers the distinct words of each language and keeps the texts as word numbers. Blocks are written.
2. Words are counted over all blocks. A phrase of `least` occurrences has only words of as many, so these words alone get
   ids: dense, from the positions in a written table. Exact; nothing that could be a candidate is lost.
3. Each block receives the ids of its words by a join and counts its phrases of two and three words in a counting
   quotient filter (`cqf`): packed ids are permuted invertibly into quotient and full remainder, so counters are exact.
4. Filters merge across shards by ranges of leading bits. With many shards this takes several hops, each of which merges
   the slices of a group of shards and splits the range further, so that messages grow with the shards, not with
   their square, and no task holds more than about one shard's filter.
5. Phrases of `least` occurrences come back as ids. Their parts' counts, the lowest cut, the longer phrase that covers a
   shorter one and the order are joins, whole-number decimals and windows; the first `top` of each language are
   taken in salted parts first.

Words `[^\\x20\\x09]+` of pieces between `[.,;:!?\\x0A-\\x0D]`, A-Z lower-cased; other characters as they are.

Defined cases: null texts count as empty and give nothing; a null language counts as `und` and is one with that;
repeated rows count each; without a candidate the result is empty; columns other than text and language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm import cqf
from driftline.llm.blocks import documents_by_block, pack_ints, unpack_ints
from driftline.llm.common import col, stored, with_package

LEAST = 10
#: A phrase is dropped if a longer one around it has this many hundredths of its occurrences.
COVERED = 50
TOP = 2000
SCALE = 1_000_000
#: Characters of a block, unless one document alone has more.
SHARD_CHARS = 16_000_000
#: Shards that meet in one hop, at most.
FAN = 1024
SALTS = 64
#: Column type of counts; their squares and products stay whole in a decimal of 38 digits.
_COUNT = "decimal(19,0)"

_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A-Z lower-cased, every break a full stop, which no word holds.
_PLAIN = bytes(46 if b in _BREAKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_POSITION_BITS = 33  # monotonically_increasing_id() is the partition, shifted by this, plus the position in it

_CODED = "block long, words array<struct<lang:string,word:binary,n:long>>, tokens binary"


def words_of(text: str) -> list[bytes]:
    """Lower-cased words, and full stops for breaks, in order."""
    data = text.encode("utf-8", "surrogatepass").translate(_PLAIN).replace(b"\t", b" ").replace(b".", b" . ")
    return [w for w in data.split(b" ") if w]


class _Words(dict):
    """Numbers of the words of one language, from a count that all languages share; 0 is a break."""

    def __init__(self, lang: str, listed: list) -> None:
        super().__init__({b".": 0})
        self.lang, self.listed = lang, listed

    def __missing__(self, word: bytes) -> int:
        self.listed.append((self.lang, word))
        number = self[word] = len(self.listed)
        return number


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a block: its distinct words with counts, and its texts as word numbers with 0 at breaks."""
    for block, langs, texts in documents_by_block(batches, SHARD_CHARS):
        listed: list[tuple[str, bytes]] = []
        numbers: dict[str, _Words] = {}
        found = []
        for lang, text in zip(langs, texts, strict=True):
            if lang not in numbers:
                numbers[lang] = _Words(lang, listed)
            words = words_of(text)
            found.append(np.fromiter(chain(map(numbers[lang].__getitem__, words), (0,)), np.uint32, len(words) + 1))
        tokens = np.concatenate(found)
        counts = np.bincount(tokens, minlength=len(listed) + 1)
        words = [{"lang": lang, "word": word, "n": int(n)} for (lang, word), n in zip(listed, counts[1:], strict=True)]
        row = {"block": block, "words": words, "tokens": pack_ints(tokens)}
        kind = pa.list_(pa.struct([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())]))
        yield pa.RecordBatch.from_pylist([row], pa.schema([("block", pa.int64()), ("words", kind), ("tokens", pa.binary())]))


def coded_blocks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Blocks (block, words, tokens), written."""
    with_package(docs.sparkSession)
    texts = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), col(text_col).alias("text"))
    return stored(texts.mapInArrow(_tokenize, _CODED), "phrases-blocks")


def _listed(coded: DataFrame) -> DataFrame:
    """(block, number, lang, word, n) of each distinct word of each block."""
    return coded.select("block", F.posexplode("words").alias("at", "w")).select(
        "block", (F.col("at") + 1).alias("number"), "w.lang", "w.word", "w.n"
    )


def with_ids(words: DataFrame) -> DataFrame:
    """The rows with `id`, dense from 1; written. The offsets are a row a partition of the written table."""
    held = stored(words.withColumn("__at", F.monotonically_increasing_id()), "phrases-words")
    held = held.withColumn("__part", F.shiftright("__at", _POSITION_BITS))
    sizes = held.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    position = F.col("__at").bitwiseAND((1 << _POSITION_BITS) - 1)
    # a row a task of the write above
    numbered = held.join(F.broadcast(sizes), "__part").withColumn("id", F.col("__before") + position + 1)
    return stored(numbered.drop("__at", "__part", "__before"), "phrases-ids")


def hops_of(shards: int, fan: int = FAN) -> list[int]:
    """Bits by which each hop of the merge splits ranges: as few hops as `fan` allows, together a range a shard."""
    bits = max(1, (shards - 1).bit_length())
    most = fan.bit_length() - 1
    hops = -(-bits // most)
    return [bits // hops + (i < bits % hops) for i in range(hops)]


def _phrases(tokens: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all phrases of two (first is 0) and three words that stand in one piece."""
    x = ids[tokens]
    two = (x[:-1] > 0) & (x[1:] > 0)
    three = two[:-1] & two[1:]
    a, b = x[:-1][two], x[1:][two]
    first = np.concatenate([np.zeros(len(a), np.uint64), x[:-2][three]])
    return first, np.concatenate([a, x[1:-1][three]]), np.concatenate([b, x[2:][three]])


_SLICE = "pool long, range long, filter binary"


def _slices(pool: int, entries: tuple, half: int, common: int) -> pa.RecordBatch:
    found = list(cqf.split(entries, half, common))
    return pa.RecordBatch.from_arrays(
        [pa.array([pool] * len(found), pa.int64()), pa.array([p for p, _ in found], pa.int64()), pa.array([f for _, f in found], pa.binary())],
        names=["pool", "range", "filter"],
    )


def shard_filters(coded: DataFrame, ids: DataFrame, bits: int, common: int) -> DataFrame:
    """(pool, range, filter): the filter of each block, split by its `common` leading bits; pool is the block's hash."""
    packing = cqf.Packing(bits)
    known = _listed(coded).join(ids.select("lang", "word", "id"), ["lang", "word"])
    known = known.groupBy("block").agg(F.collect_list("number").alias("numbers"), F.collect_list("id").alias("ids"))
    rows = coded.select("block", "tokens", F.size("words").alias("size")).join(known, "block")
    rows = rows.select(F.xxhash64("block").alias("pool"), "tokens", "size", "numbers", "ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pool, tokens, size = (batch.column(k)[i].as_py() for k in range(3))
                of = np.zeros(size + 1, np.uint64)
                of[batch.column(3)[i].values.to_numpy()] = batch.column(4)[i].values.to_numpy().astype(np.uint64)
                high, low = packing.pack(*_phrases(unpack_ints(tokens), of))
                entries = packing.summed(high, low, np.ones(len(high), np.uint64))
                yield _slices(pool, entries, packing.half, common)

    return rows.mapInArrow(count, _SLICE)


def merged(filters: DataFrame, bits: int, hops: list[int], least: int) -> DataFrame:
    """(first, second, third, f) of all phrases of `least` occurrences, from the shards' filters."""
    packing = cqf.Packing(bits)
    common = hops[0]

    def merging(common: int, finer: int):
        def run(key: tuple, table: pa.Table) -> pa.Table:
            entries = cqf.merge(table.column("filter").to_pylist(), packing, common, key[0].as_py())
            return pa.Table.from_batches([_slices(key[1].as_py(), entries, packing.half, common + finer)])

        return run

    for done, finer in enumerate(hops[1:], 1):
        # Shards that agree in these bits of their hash meet; the later hops bring the remaining bits together.
        pools = F.pmod("pool", F.lit(1 << sum(hops[done:])))
        filters = filters.withColumn("pool", pools).groupBy("range", "pool").applyInArrow(merging(common, finer), _SLICE)
        common += finer

    def found(key: tuple, table: pa.Table) -> pa.Table:
        high, low, count = cqf.merge(table.column("filter").to_pylist(), packing, common, key[0].as_py())
        keep = count >= least
        ids = packing.unpack(high[keep], low[keep])
        return pa.table([pa.array(x.astype(np.int64)) for x in (*ids, count[keep])], names=["first", "second", "third", "f"])

    return filters.groupBy("range").applyInArrow(found, "first long, second long, third long, f long")


def _scored(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), whole numbers all the way; at most SCALE."""
    a, left, right = (c.cast(_COUNT) for c in (a, left, right))
    up = (F.lit(SCALE).cast("decimal(7,0)") * (a * a)).cast("decimal(38,0)")
    down = (left * right).cast("decimal(38,0)")
    return F.call_function("div", up, down)


def candidates(grams: DataFrame, words: DataFrame, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases that no longer one covers."""
    grams = stored(grams, "phrases-counted")
    unit = words.select("id", "word", F.col("n").alias("f"))
    two = grams.where("first = 0").select(F.col("second").alias("x"), F.col("third").alias("y"), F.col("f").alias("a"))
    three = grams.where("first > 0").select(F.col("first").alias("x"), F.col("second").alias("y"), F.col("third").alias("z"), F.col("f").alias("a"))

    def word(name: str) -> DataFrame:
        return unit.select(F.col("id").alias(name), F.col("word").alias(f"w{name}"), F.col("f").alias(f"f{name}"))

    longer = three.select("x", "y", "a").unionByName(three.select(F.col("y").alias("x"), F.col("z").alias("y"), "a"))
    longer = longer.groupBy("x", "y").agg(F.max("a").alias("longest"))
    pairs = two.join(longer, ["x", "y"], "left").where(f"longest IS NULL OR 100 * longest < {covered} * a")
    pairs = pairs.join(word("x"), "x").join(word("y"), "y")
    pairs = pairs.select(
        F.col("x").alias("id"), F.concat_ws(" ", F.col("wx").cast("string"), F.col("wy").cast("string")).alias("phrase"),
        "a", F.col("fx").alias("l"), F.col("fy").alias("r"), _scored(F.col("a"), F.col("fx"), F.col("fy")).alias("score"),
    )
    head = two.select("x", "y", F.col("a").alias("fxy"))
    tail = two.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("fyz"))
    triples = three.join(head, ["x", "y"]).join(tail, ["y", "z"]).join(word("x"), "x").join(word("y"), "y").join(word("z"), "z")
    one, other = _scored(F.col("a"), F.col("fx"), F.col("fyz")), _scored(F.col("a"), F.col("fxy"), F.col("fz"))
    triples = triples.withColumns({"one": one, "other": other})
    first = F.col("one") <= F.col("other")
    triples = triples.select(
        F.col("x").alias("id"),
        F.concat_ws(" ", *(F.col(w).cast("string") for w in ("wx", "wy", "wz"))).alias("phrase"),
        "a",
        F.when(first, F.col("fx")).otherwise(F.col("fxy")).alias("l"),
        F.when(first, F.col("fyz")).otherwise(F.col("fz")).alias("r"),
        F.least("one", "other").alias("score"),
    )
    return pairs.unionByName(triples).join(words.select("id", "lang"), "id").drop("id")


def mine(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    covered: int = COVERED,
    top: int = TOP,
) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    if least < 2:
        raise ValueError("a phrase must occur twice at least")
    coded = coded_blocks(docs, text_col, lang_col)
    counted = stored(_listed(coded).groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrases-counts")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = with_ids(counted.where(F.col("n") >= least))
    largest = words.agg(F.max("id").alias("id")).first().id or 0
    hops = hops_of(coded.count())
    bits = max(1, int(largest).bit_length(), -(-2 * sum(hops) // 3))
    filters = shard_filters(coded, words, bits, hops[0])
    found = candidates(merged(filters, bits, hops, least), words, covered)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    parts = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
