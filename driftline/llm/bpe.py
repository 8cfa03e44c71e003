"""BPE encoding and decoding over a distinct-word table.

Texts are split into words in Spark tasks, each distinct word is encoded once by the tokenizers library, and
ids return to the words' positions (see `blocks` for the exchange). Decoding joins ids to their pieces through
the tokenizer's id-to-piece table, again once for each distinct word of a block.

Valid for tokenizers that never join tokens across spaces or newlines and drop white space, as the word-end
BPE does; `check` refuses others. Special tokens inside a text are found as the library finds them.

Defined cases: a null or empty text, and one of white space only, has no ids and decodes to the empty string;
repeated rows are encoded each; a null id is carried; only the id and text columns are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm import blocks
from driftline.llm.common import col, partitions, with_package

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@cache
def library(path: str):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)
    coder.no_truncation()
    coder.no_padding()
    return coder


def check(path: str) -> None:
    """Refuse tokenizers whose tokens may depend on the white space between words."""
    for text in ("a b", "a\nb", "a  b", " a b "):
        if library(path).encode(text, add_special_tokens=False).tokens != ["a</w>", "b</w>"]:
            raise ValueError("the tokenizer keeps white space; words can't be encoded on their own")


def split(text: str) -> Iterator[str]:
    return filter(None, text.replace("\n", " ").split(" "))


def encode_words(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words joined, and the number of ids of each."""
    coder, ids = library(path), []
    for k in range(0, len(words), 20_000):
        ids += [e.ids for e in coder.encode_batch(words[k : k + 20_000], add_special_tokens=False)]
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
    return flat, sizes


@cache
def pieces(path: str) -> list[str]:
    """The id-to-piece table."""
    coder = library(path)
    return [coder.id_to_token(i) or "" for i in range(coder.get_vocab_size(with_added_tokens=True))]


def _cut(batches: Iterator[pa.RecordBatch], n_buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row for each block (its texts as word numbers), and one for each bucket it has words of."""
    for block, ids, texts in blocks.documents_by_block(batches):
        words, at, sizes = blocks.numbered(texts, split)
        bucket = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) % n_buckets for w in words), np.uint32, len(words))
        rows = [
            {
                "block": block,
                "bucket": -1,
                "doc_ids": ids,
                "sizes": sizes.tolist(),
                "tokens": blocks.pack_ints(at),
                "bucket_of": blocks.pack_ints(bucket),
            }
        ]
        order = np.argsort(bucket, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(own):
                text = "\n".join([words[i] for i in own])
                rows.append({"block": block, "bucket": int(bucket[own[0]]), "words": blocks.squeeze(text.encode())})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _encode(table: pa.Table, path: str) -> pa.Table:
    """All words of a bucket, each encoded once; a row of answers for each block."""
    number = blocks.Numbering()
    asked = [
        np.fromiter(map(number.__getitem__, blocks.unsqueeze(x).decode().split("\n")), np.int64)
        for x in table.column("words").to_pylist()
    ]
    flat, sizes = encode_words(list(number), path)
    starts = blocks.offsets(sizes)
    answers = [blocks.gather_lists(flat, starts, at) for at in asked]
    return pa.table(
        {
            "block": table.column("block"),
            "bucket": table.column("bucket"),
            "n_ids": pa.array([blocks.pack_ints(n) for _, n in answers], pa.binary()),
            "ids": pa.array([blocks.pack_ints(x) for x, _ in answers], pa.binary()),
        }
    )


def _word_ids(rows: list[dict], bucket_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block's distinct words, joined in order of word number, and their starts."""
    rows = sorted(rows, key=lambda r: r["bucket"])
    sizes = [blocks.unpack_ints(r["n_ids"]).astype(np.int64) for r in rows]
    flat = [blocks.unpack_ints(r["ids"]) for r in rows]
    if not rows:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    flat, starts = np.concatenate(flat), blocks.offsets(np.concatenate(sizes))
    place = np.empty(len(bucket_of), np.int64)
    place[np.argsort(bucket_of, kind="stable")] = np.arange(len(bucket_of))
    own, sizes = blocks.gather_lists(flat, starts, place)
    return own, blocks.offsets(sizes)


def _only_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.select(["block", "bucket", "words"]).filter(pc.greater_equal(batch.column("bucket"), 0))


def _place(table: pa.Table, answered: pa.Table, path: str, schema: pa.Schema) -> pa.Table:
    """Ids and decoded texts of a block's documents."""
    (docs,) = table.filter(pc.less(table.column("bucket"), 0)).to_pylist()
    answers = answered.to_pylist()
    at = blocks.unpack_ints(docs["tokens"]).astype(np.int64)
    bucket_of = blocks.unpack_ints(docs["bucket_of"])
    flat, starts = _word_ids(answers, bucket_of)
    if len(starts) != len(bucket_of) + 1:
        raise ValueError("a block got answers for other words than it asked for")
    table_of = pieces(path)
    named = [" ".join([table_of[i] for i in flat[a:b].tolist()]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
    ids, texts = [], []
    first = 0
    for size in docs["sizes"]:
        own = at[first : first + size]
        first += size
        found, n = blocks.gather_lists(flat, starts, own)
        ids.append(found.astype(np.int32))
        texts.append(" ".join([named[i] for i in own[n > 0].tolist()]))
    lists = pa.ListArray.from_arrays(
        pa.array(blocks.offsets(np.array([len(x) for x in ids], np.int64)), pa.int32()),
        pa.array(np.concatenate(ids), pa.int32()),
    )
    return pa.Table.from_arrays([pa.array(docs["doc_ids"], schema.field(0).type), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, ids, and the text that they decode to."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    with_package(spark)
    check(tokenizer)
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    cut = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("bucket", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("bucket_of", T.BinaryType()),
            T.StructField("words", T.BinaryType()),
        ]
    )
    cut_arrow = to_arrow_schema(cut)
    n_buckets = partitions(spark)
    # Dealt by block once: this exchange feeds the words to the buckets and keeps the texts for the answers.
    table = rows.mapInArrow(lambda it: _cut(it, n_buckets, cut_arrow), cut).repartition("block")
    asked = table.mapInArrow(_only_words, "block long, bucket long, words binary").groupBy("bucket")
    answers = asked.applyInArrow(lambda t: _encode(t, tokenizer), "block long, bucket long, n_ids binary, ids binary")
    out = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )
    out_arrow = to_arrow_schema(out)
    both = table.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(lambda own, found: _place(own, found, tokenizer, out_arrow), out)


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row with ids: doc_id and text, by a join of ids to pieces.

    The table of pieces is as large as the tokenizer's vocabulary, whatever the input.
    """
    spark = encoded.sparkSession
    table = spark.createDataFrame(list(enumerate(pieces(tokenizer))), "id int, piece string")
    rows = encoded.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("doc_id"), col(ids_col).alias("ids"))
    each = rows.select("row", "doc_id", F.posexplode_outer("ids").alias("at", "id"))
    told = each.join(F.broadcast(table), "id", "left").groupBy("row", "doc_id")
    parts = told.agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("piece", F.lit("")).alias("piece")))).alias("p"))
    return parts.select("doc_id", F.array_join("p.piece", " ").alias("text"))
