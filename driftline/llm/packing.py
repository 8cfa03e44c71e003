"""Packing token ids into windows with bounded space: a fixed number of open windows per partition.

Each task keeps `open_windows` windows open. A document's tail goes best-fit into the fullest window that
holds it whole. When none does, the fullest window is topped up with the head of the tail and emitted full,
so emitted windows carry no padding. What is still open when the input ends is at most `open_windows`
windows a partition; these leftovers are merged in groups of neighbouring partitions, one padded window a
group. Pieces are written to the shared folder once, so a lost executor repeats only its own task.

Defined cases: a null or empty text is one piece with only the end id; a text longer than a window fills
windows of its own; repeated rows are packed each; a null id is carried; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import cache, partial

import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import col, stored, with_package

WINDOW = 2048
OPEN_WINDOWS = 16
#: Partitions whose leftovers one task merges: at most 16 * OPEN_WINDOWS windows.
MERGED_PARTITIONS = 16
END_ID = 1


def byte_symbols() -> dict[str, int]:
    """Byte of each printable stand-in that byte-level vocabularies use."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteIds:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, equal to those of the tokenizers library.

    The library's own file is read; a special token's string in a text is that token, as there.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(symbols[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        self.coder = tiktoken.Encoding("byte", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        return self.coder.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


@cache
def byte_ids(path: str) -> ByteIds:
    return ByteIds(path)


class Windows:
    """Open windows of one task; closed ones are handed to `emit(sequence, pieces)`.

    A piece is (doc_id, start, ids, doc_tokens).
    """

    def __init__(self, window: int, limit: int, emit: Callable[[int, list], None]) -> None:
        self.window, self.limit, self.emit = window, limit, emit
        self.open: list[tuple[int, list]] = []  # tokens used, pieces
        self.made = 0

    def close(self, pieces: list) -> None:
        self.emit(self.made, pieces)
        self.made += 1

    def add(self, doc_id, ids: bytes, start: int, end: int, doc_tokens: int) -> None:
        """Place the tokens start..end of a document, of which `ids` holds all of the piece."""

        def piece(a: int, b: int) -> tuple:
            return (doc_id, a, ids[4 * (a - base) : 4 * (b - base)], doc_tokens)

        base = start
        while end - start >= self.window:
            self.close([piece(start, start + self.window)])
            start += self.window
        while start < end:
            size = end - start
            fits = [(used, i) for i, (used, _) in enumerate(self.open) if used + size <= self.window]
            if fits:
                used, i = max(fits)
                pieces = [*self.open[i][1], piece(start, end)]
                self.open[i] = (used + size, pieces)
                if used + size == self.window:
                    del self.open[i]
                    self.close(pieces)
                return
            if len(self.open) < self.limit:
                self.open.append((size, [piece(start, end)]))
                return
            used, i = max((used, i) for i, (used, _) in enumerate(self.open))
            _, pieces = self.open.pop(i)
            cut = start + self.window - used
            self.close([*pieces, piece(start, cut)])
            start = cut


_FIELDS = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


class _Rows:
    """Rows of pieces gathered for one Arrow batch."""

    def __init__(self, schema: pa.Schema, first: int, **fixed) -> None:
        self.schema, self.first, self.fixed, self.rows = schema, first, fixed, []

    def add(self, sequence: int, pieces: list, **fixed) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            n = len(ids) // 4
            values = (doc_id, start, n, ids, doc_tokens, self.first + sequence, offset)
            self.rows.append(dict(zip(_FIELDS, values, strict=True)) | self.fixed | fixed)
            offset += n

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_pylist(rows, schema=self.schema)


def _schema(id_type: T.DataType) -> T.StructType:
    kinds = (id_type, T.LongType(), T.LongType(), T.BinaryType(), T.LongType(), T.LongType(), T.LongType())
    return T.StructType([T.StructField(n, k) for n, k in zip(_FIELDS, kinds, strict=True)])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _pack(batches: Iterator[pa.RecordBatch], path: str, window: int, limit: int, schema: T.StructType):
    number = TaskContext.get().partitionId()
    coder, end = byte_ids(path), END_ID.to_bytes(4, "little")
    rows = _Rows(_arrow(schema), number << 32, part=number)
    windows = Windows(window, limit, partial(rows.add, open=False))
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = coder.encode(text or "") + end
            n = len(ids) // 4
            windows.add(doc_id, ids, 0, n, n)
            if len(rows.rows) >= 4096:
                yield rows.take()
    for k, (_, pieces) in enumerate(windows.open):
        rows.add(windows.made + k, pieces, open=True)
    yield rows.take()


def _merge(table: pa.Table, window: int, schema: T.StructType) -> pa.Table:
    """One group's leftover windows, longest first, in full windows and at most one shorter one."""
    held: dict[int, list] = {}
    rows = table.to_pylist()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        held.setdefault(r["sequence_id"], []).append((r["doc_id"], r["start"], r["ids"], r["doc_tokens"]))
    out = _Rows(_arrow(schema), (1 << 62) + (rows[0]["part"] // MERGED_PARTITIONS << 32))
    windows = Windows(window, 1, out.add)
    for _, pieces in sorted(held.items(), key=lambda x: (-sum(len(p[2]) for p in x[1]), x[0])):
        for doc_id, start, ids, doc_tokens in pieces:
            windows.add(doc_id, ids, start, start + len(ids) // 4, doc_tokens)
    for _, pieces in windows.open:
        windows.close(pieces)
    return pa.Table.from_batches([out.take()])


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    schema = _schema(rows.schema["doc_id"].dataType)
    marked = T.StructType([*schema.fields, T.StructField("part", T.LongType()), T.StructField("open", T.BooleanType())])
    with_package(docs.sparkSession)
    packed = stored(
        rows.mapInArrow(lambda it: _pack(it, tokenizer, window, open_windows, marked), marked), "packed"
    )
    left = packed.where("open").withColumn("g", F.expr(f"part div {MERGED_PARTITIONS}"))
    merged = left.groupBy("g").applyInArrow(lambda t: _merge(t, window, schema), schema)
    return packed.where("NOT open").select(*_FIELDS).unionByName(merged)
