"""Exchange of distinct words between blocks of documents and buckets of the vocabulary.

Per-word work that needs the whole corpus (one encoding a word, corpus counts) would shuffle a row for every
word of every text. Here a block of neighbouring documents sends each of its distinct words once, to the
bucket of that word's hash; buckets answer each block with one value a word, and the block puts the answers
back by position. A word in a third of all rows costs one entry a block. Blocks are bounded in characters;
buckets follow the shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext

#: Characters of a block, unless one document alone has more.
BLOCK_CHARS = 12_000_000


class Numbering(dict):
    """Numbers things in the order in which they are first asked for."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_ints(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Whole numbers, their bytes grouped by significance and compressed."""
    raw = np.ascontiguousarray(values, kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize)
    return squeeze(np.ascontiguousarray(raw.T).tobytes())


def unpack_ints(data: bytes, kind: str = "<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(unsqueeze(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(kind).reshape(-1)


def documents_by_block(batches: Iterable[pa.RecordBatch], chars: int = BLOCK_CHARS) -> Iterator[tuple[int, list, list]]:
    """(block, ids, texts) from batches of (id, text); a block never crosses a partition."""
    block = TaskContext.get().partitionId() << 24
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            if texts and size + len(text) > chars:
                yield block, ids, texts
                block, ids, texts, size = block + 1, [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield block, ids, texts


def numbered(texts: list, split) -> tuple[list, np.ndarray, np.ndarray]:
    """Distinct words in order of first use, the word numbers of all texts, and their number in each text."""
    number = Numbering()
    found, sizes = [], []
    for text in texts:
        at = np.fromiter(map(number.__getitem__, split(text)), np.uint32)
        found.append(at)
        sizes.append(len(at))
    return list(number), np.concatenate(found), np.array(sizes, np.int64)


def offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def gather_lists(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists flat[starts[i]:starts[i + 1]] for each i of `which`, joined, and their sizes."""
    sizes = (starts[1:] - starts[:-1])[which]
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[:-1][which] - (ends - sizes), sizes)
    return flat[at], sizes
