"""LM scoring with a hierarchical Pitman-Yor model, seated by Gibbs sampling.

Restaurants: one for every context, the previous word (the end token at text starts), whose parent is the
unigram restaurant, whose parent is uniform over the known words and one unknown word.

Counts come from the whole corpus. Words are numbered first: a block of documents sends each distinct word to
the bucket of its hash, which gives it a number (bucket, place). The block then sends each distinct (previous
word, word) cell once to the word's bucket (see `blocks`); a bucket holds all cells of its words. A cell's
restaurant is spread over buckets: its customers are the count of the previous word, and its tables are summed in
that word's group of buckets, which tells them to the buckets that hold cells of it seen more than once; a cell seen once
has one table whatever the others do. The driver gets a few sums, whatever the input.

Seating: only numbers of tables matter. A Gibbs sweep draws each cell's number given all other cells, its
customers' seats summed out: t tables of c customers have weight (weight of a new table) ** t times the
generalised Stirling number of c and t. One rule holds for all sizes; the numbers come from their recursion up to
LIMIT customers, beyond from rows interpolated in c, and for cells of more than some LIMIT / 2 tables from their normal
limit. Tables of a cell are the customers of its word in the unigram restaurant, whose tables are drawn alike
given these. During a sweep the totals of restaurants are held. A first round finds
the restaurants' table totals, a second draws SAMPLES seatings after BURN sweeps and sums each one's own totals. A
probability is computed whole from each sample and its totals, then averaged: over all known words and the unknown one
the predictions of a context add up to one. Random numbers depend on the bucket only, so a lost task repeats itself.

Words are told apart by 64-bit hashes. Defined cases: a null or empty text is its end token; without training
tokens every probability is 1; a null id counts as training text; repeated rows are scored and counted each;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm import blocks
from driftline.llm.common import col, partitions, stored, with_package

#: Length of arrays by context in small examples.
CLASSES = 4
STRENGTH = 1.0
BURN = 2
SAMPLES = 3
#: Customers of a cell up to which each number's distribution is tabled, and the tables looked at beyond.
LIMIT = 1024
_GRID = tuple(round(LIMIT * 2 ** (k / 8)) for k in range(33))
_LOG_FACTORIAL = np.concatenate([[0.0], np.log(np.arange(1, LIMIT + 1)).cumsum()])
#: Numbers drawn from at a time.
_DRAWN = 1 << 20
END = b"\n"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _held(doc_id) -> bool:
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def tokens(text: str) -> list[bytes]:
    """bytes.lower and bytes.split are the contract's lower case and words."""
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


def _cut(batches: Iterator[pa.RecordBatch], n_buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row for each block (its texts as word numbers), and one for each bucket with words of it."""
    for block, ids, texts in blocks.documents_by_block(batches):
        words, at, sizes = blocks.numbered(texts, tokens)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((hashes, bucket))
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words))
        rows = [{"block": block, "bucket": -1, "doc_ids": ids, "sizes": sizes.tolist(), "tokens": blocks.pack_ints(rank[at])}]
        hashes, bucket = hashes[order], bucket[order]
        for a, b in _runs(bucket):
            rows.append({"block": block, "bucket": int(bucket[a]), "words": blocks.pack_ints(hashes[a:b], "<u8")})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _runs(sorted_values: np.ndarray) -> list[tuple[int, int]]:
    """First and past-the-last position of each run of equal values."""
    starts = np.flatnonzero(np.diff(sorted_values, prepend=-1)).tolist()
    return list(zip(starts, [*starts[1:], len(sorted_values)], strict=False))


def _number(table: pa.Table) -> pa.Table:
    """For each block, the places of its words among all words of a bucket, by hash."""
    words = [blocks.unpack_ints(x, "<u8") for x in table.column("words").to_pylist()]
    place = np.unique(np.concatenate(words), return_inverse=True)[1]
    places = np.split(place, np.cumsum([len(w) for w in words])[:-1])
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "places": [blocks.pack_ints(x) for x in places]})


def _cells_of(tokens: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct cells of a block (word * n + previous word), the cell of each token, and n."""
    word = blocks.unpack_ints(tokens).astype(np.int64)
    n = int(word.max()) + 1
    before = np.concatenate([word[-1:], word[:-1]])  # texts end with the end token
    cells, at = np.unique(word * n + before, return_inverse=True)
    return cells, at, n


def _send(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """A block's cells, for the buckets of their words."""
    rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
    docs, answers = rows[0], rows[1:]
    places = [blocks.unpack_ints(r["places"]) for r in answers]
    starts = blocks.offsets(np.array([len(x) for x in places]))
    numbers = np.concatenate([(r["bucket"] << 32) + x.astype(np.int64) for r, x in zip(answers, places, strict=True)])
    cells, at, n = _cells_of(docs["tokens"])
    taught = np.repeat([not _held(i) for i in docs["doc_ids"]], docs["sizes"])
    counts = np.bincount(at[taught], minlength=len(cells))
    n_cells = np.bincount(cells // n, minlength=n)
    cell_starts = blocks.offsets(n_cells)
    sent = []
    for r, x, a, b in zip(answers, places, starts, starts[1:], strict=False):
        own = slice(cell_starts[a], cell_starts[b])
        sent.append(
            {
                "block": r["block"],
                "bucket": r["bucket"],
                "words": blocks.pack_ints(x),
                "n_cells": blocks.pack_ints(n_cells[a:b]),
                "contexts": blocks.pack_ints(numbers[cells[own] % n], "<u8"),
                "counts": blocks.pack_ints(counts[own]),
            }
        )
    return pa.Table.from_pylist(sent, schema=schema)


@dataclass
class Cells:
    """Cells of a bucket: cell i is word word[i] after context kind[i], seen count[i] times in training."""

    word: np.ndarray
    kind: np.ndarray
    count: np.ndarray
    n_words: int
    asked: list  # for each block, the cells it asked for
    words_asked: list
    once: np.ndarray | int = 0  # cells of each word that were seen once and are not listed


def _gather(table: pa.Table, per: int, schema: pa.Schema) -> pa.Table:
    """A bucket's cells, added up, and what it tells the buckets of their contexts.

    Blocks ask by code: 0 for a cell unseen in training, 1 for one seen once, i + 2 for listed cell i.
    """
    rows = table.to_pylist()
    words = [blocks.unpack_ints(r["words"]) for r in rows]
    n_words = int(max(w.max() for w in words)) + 1
    word = np.concatenate([np.repeat(w, blocks.unpack_ints(r["n_cells"])) for w, r in zip(words, rows, strict=True)])
    kinds = [blocks.unpack_ints(r["contexts"], "<u8") for r in rows]
    sizes = np.cumsum([len(k) for k in kinds])[:-1]
    kind = np.concatenate(kinds)
    order = np.lexsort((kind, word))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(word[order].astype(np.int64)) != 0) | (np.diff(kind[order]) != 0)
    cell = np.empty(len(order), np.int64)
    cell[order] = np.cumsum(new) - 1
    word, kind = word[order[new]], kind[order[new]]
    count = np.bincount(cell, weights=np.concatenate([blocks.unpack_ints(r["counts"]) for r in rows])).astype(np.int64)
    listed = count > 1
    code = np.minimum(count, 1)
    code[listed] = 2 + np.arange(listed.sum())
    seen = count > 0
    widths = np.bincount(word[seen], minlength=n_words)
    of_word = np.bincount(word, weights=count, minlength=n_words).astype(np.int64)
    bucket = rows[0]["bucket"]
    out = [
        {
            "bucket": bucket,
            "role": "cells",
            "word_counts": blocks.pack_ints(of_word, "<u8"),
            "once": blocks.pack_ints(np.bincount(word[count == 1], minlength=n_words)),
            "words": blocks.pack_ints(word[listed]),
            "contexts": blocks.pack_ints(kind[listed], "<u8"),
            "counts": blocks.pack_ints(count[listed], "<u8"),
            "asked": [
                {"block": r["block"], "words": blocks.pack_ints(w), "codes": blocks.pack_ints(c)}
                for r, w, c in zip(rows, words, np.split(code[cell], sizes), strict=True)
            ],
            "sums": [
                float(x)
                for x in (of_word.sum(), (of_word > 0).sum(), widths.sum(), *(n for k in (1, 2) for n in ((count == k).sum(), (widths == k).sum())))
            ],
        }
    ]
    contexts, at = np.unique(kind[seen], return_inverse=True)
    asks = np.zeros(len(contexts), bool)
    asks[at[listed[seen]]] = True
    out += _to_homes(bucket, "types", per, contexts, np.bincount(at, minlength=len(contexts)), asks)
    return pa.Table.from_pylist(out, schema=schema)


def _to_homes(source: int, role: str, per: int, contexts: np.ndarray, values: np.ndarray, asks: np.ndarray | None = None) -> list[dict]:
    """For each group of `per` buckets, the contexts at home there with their values (one or a row each), and which must be answered."""
    home = (contexts >> np.uint64(32)).astype(np.int64) // per
    return [
        {
            "bucket": int(home[a]),
            "source": source,
            "role": role,
            "contexts": blocks.pack_ints(contexts[a:b], "<u8"),
            "counts": blocks.pack_ints(values[a:b].ravel(), "<u8"),
            "once": None if asks is None else blocks.pack_ints(asks[a:b], "<u1"),
        }
        for a, b in _runs(home)
    ]


def _totals(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """Tables of the contexts of a group of buckets, kept and told to the buckets that asked."""
    told = [(r, blocks.unpack_ints(r["contexts"], "<u8"), blocks.unpack_ints(r["counts"], "<u8")) for r in table.to_pylist()]
    contexts, at = np.unique(np.concatenate([c for _, c, _ in told]), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([n for _, _, n in told])).astype(np.int64)
    group = told[0][0]["bucket"]
    out = [{"bucket": group, "role": "kept", "contexts": blocks.pack_ints(contexts, "<u8"), "counts": blocks.pack_ints(total, "<u8")}]
    for (r, c, _), n in zip(told, np.split(total[at], np.cumsum([len(c) for _, c, _ in told])[:-1]), strict=True):
        if r["once"] is not None:
            n = n[blocks.unpack_ints(r["once"], "<u1") > 0]
        if r["role"] != "kept" and len(n):
            out.append({"bucket": r["source"], "source": group, "role": "answer", "counts": blocks.pack_ints(n, "<u8")})
    return pa.Table.from_pylist(out, schema=schema)


def _listed(table: pa.Table) -> tuple[dict | None, Cells | None, np.ndarray, np.ndarray, dict]:
    """The bucket's row, its listed cells, their contexts and the tables of these, and the bucket's totals."""
    rows = table.to_pylist()
    by_role = {r["role"]: r for r in rows if r["role"] != "answer"}
    row = by_role.get("cells")
    if row is None:
        return None, None, np.zeros(0), np.zeros(0), by_role
    contexts, kind = np.unique(blocks.unpack_ints(row["contexts"], "<u8"), return_inverse=True)
    answers = sorted((r for r in rows if r["role"] == "answer"), key=lambda r: r["source"])
    tables = np.concatenate([np.zeros(0), *(blocks.unpack_ints(r["counts"], "<u8") for r in answers)])
    once = blocks.unpack_ints(row["once"]).astype(np.int64)
    cells = Cells(
        blocks.unpack_ints(row["words"]).astype(np.int64), kind, blocks.unpack_ints(row["counts"], "<u8").astype(np.int64), len(once), [], [], once
    )
    return row, cells, contexts, tables, by_role


@dataclass(frozen=True)
class Totals:
    """What restaurants have in all: customers and tables of contexts, and of the unigram restaurant."""

    train_tokens: int
    n_words: int
    discount: float
    root_discount: float
    customers: np.ndarray
    tables: np.ndarray
    root_customers: float
    root_tables: float

    def root(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probability of words with so many customers and tables in the unigram restaurant."""
        back = (STRENGTH + self.root_discount * self.root_tables) / (self.n_words + 1)
        return (customers - self.root_discount * tables + back) / (STRENGTH + self.root_customers)


@cache
def _log_chances(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Row c, column t: log of the chance that t tables have c customers, up to LIMIT; and rows of `_GRID`, less column 1.

    Sizes of tables are independent, with generating function 1 - (1 - x) ** discount. The generalised Stirling
    number of c and t is c! / (t! discount ** t) times the chance.
    """
    t = np.arange(LIMIT + 1)
    row = np.full(LIMIT + 1, -np.inf)
    row[1] = np.log(discount)
    rows, grid, wanted = [np.full(LIMIT + 1, -np.inf), row], [], set(_GRID)
    with np.errstate(divide="ignore", invalid="ignore"):
        join = np.log(t * discount)
        for c in range(1, _GRID[-1]):
            stay = np.log(np.maximum(c - discount * t, 1e-300)) + row
            row = np.logaddexp(stay, join + np.concatenate([[-np.inf], row[:-1]])) - np.log(c + 1)
            if c < LIMIT:
                rows.append(row)
            if c + 1 in wanted:
                grid.append(row - row[1])
    return np.array(rows), np.array(grid)


class Seating:
    """Tables of cells; `sweep` draws each cell's number of tables given its customers and its weight for a new table.

    The draw is from the number's distribution given all other cells, the customers' seats summed out.
    """

    def __init__(self, count: np.ndarray, discount: float, rng) -> None:
        self.count, self.discount, self.rng = count.astype(np.int64), discount, rng
        self.tables = np.minimum(self.count, 1)
        order = np.argsort(self.count, kind="stable")
        edges = np.searchsorted(self.count[order], np.arange(2, LIMIT + 2))
        self.alike = [(c, order[a:b]) for c, a, b in zip(range(2, LIMIT + 1), edges, edges[1:], strict=False) if a < b]
        self.large = order[edges[-1] :]

    def sweep(self, opening: np.ndarray) -> None:
        rows, grid = _log_chances(self.discount)
        with np.errstate(divide="ignore"):
            rate = np.log(opening / self.discount)
        for c, cells in self.alike:
            for at in np.array_split(cells, -(-len(cells) * c // _DRAWN)):
                self._draw(at, rate[at], rows[c, 1 : c + 1])
        many = opening[self.large] > self.discount * LIMIT / 2
        self._draw_many(self.large[many], opening[self.large[many]])
        few = self.large[~many]
        for at in np.array_split(few, -(-len(few) * LIMIT // _DRAWN)) if len(few) else ():
            self._draw(at, rate[at], self._beyond(self.count[at], grid))

    def _draw(self, cells: np.ndarray, rate: np.ndarray, chances: np.ndarray) -> None:
        t = np.arange(1, chances.shape[-1] + 1)
        log = rate[:, None] * t + (chances - _LOG_FACTORIAL[t])
        total = np.exp(log - log.max(axis=1, keepdims=True)).cumsum(axis=1)
        draw = self.rng.random(len(cells)) * total[:, -1]
        self.tables[cells] = 1 + np.minimum((total <= draw[:, None]).sum(axis=1), len(t) - 1)

    def _beyond(self, count: np.ndarray, grid: np.ndarray) -> np.ndarray:
        """Rows for counts beyond LIMIT: nearly linear in count ** -discount, and t times a constant in the end."""
        x, known = count.astype(np.float64) ** -self.discount, np.array(_GRID, np.float64) ** -self.discount
        end = np.log(np.arange(1, LIMIT + 1))
        known, grid = np.append(known, 0.0), np.vstack([grid[:, 1:], end])
        after = np.clip(np.searchsorted(-known, -x), 1, len(known) - 1)
        share = ((known[after - 1] - x) / (known[after - 1] - known[after]))[:, None]
        return (1 - share) * grid[after - 1] + share * grid[after]

    def _draw_many(self, cells: np.ndarray, opening: np.ndarray) -> None:
        """Cells of many customers and tables: by the normal law that the number of tables follows in the limit.

        Sizes tilted to the cell's customers: opening * (1 - y) * y ** (discount - 1) = customers gives y.
        """
        if not len(cells):
            return
        d, count = self.discount, self.count[cells]
        low, high = np.full(len(cells), -700.0), np.zeros(len(cells))
        for _ in range(60):
            log_y = (low + high) / 2
            over = np.log(opening) + np.log1p(-np.exp(log_y)) + (d - 1) * log_y > np.log(count)
            low, high = np.where(over, log_y, low), np.where(over, high, log_y)
        y = np.exp(log_y)
        mean = opening / d * (1 - y**d)
        spread = np.sqrt(np.maximum(mean - count * y / (1 - d * (1 - y)), 0))
        self.tables[cells] = np.clip(np.rint(self.rng.normal(mean, spread)), 1, count)


def seatings(cells: Cells, totals: Totals, seed: int, burn: int, samples: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """After the burn-in, (tables of each cell, customers and tables of each word in the unigram restaurant)."""
    rng = np.random.default_rng(seed)
    leaf = Seating(cells.count, totals.discount, rng)
    customers = np.bincount(cells.word, weights=leaf.tables, minlength=cells.n_words).astype(np.int64) + cells.once
    tables = np.minimum(customers, 1)
    weight = STRENGTH + totals.discount * totals.tables[cells.kind]
    opening = np.full(cells.n_words, (STRENGTH + totals.root_discount * totals.root_tables) / (totals.n_words + 1))
    for k in range(burn + samples):
        leaf.sweep(weight * totals.root(customers, tables)[cells.word])
        customers = np.bincount(cells.word, weights=leaf.tables, minlength=cells.n_words).astype(np.int64) + cells.once
        root = Seating(customers, totals.root_discount, rng)
        root.sweep(opening)
        tables = root.tables
        if k >= burn:
            yield leaf.tables, customers, tables


def _seat(table: pa.Table, totals: Totals, per: int, schema: pa.Schema, seed: int, samples: int) -> pa.Table:
    """Seatings of a bucket: their sums, further tables of the contexts beside one for each cell, and what answers need."""
    row, cells, contexts, tables, _ = _listed(table)
    if row is None:
        return schema.empty_table()
    bucket, sums, more, customers, at_root = row["bucket"], [], [], [], []
    held = np.zeros(len(cells.count))
    for leaf, seated, root in seatings(cells, replace(totals, tables=tables), seed + bucket, BURN, samples):
        sums += [float(seated.sum()), float(root.sum())]
        more.append(np.bincount(cells.kind, weights=leaf - 1, minlength=len(contexts)))
        customers.append(seated)
        at_root.append(root)
        held += (cells.count - totals.discount * leaf) / samples
    out = [
        {
            "bucket": bucket,
            "role": "seated",
            "sums": sums,
            "counts": blocks.pack_ints(held.astype("<f4").view("<u4")),
            "words": blocks.pack_ints(np.stack(customers, axis=1).ravel(), "<u8"),
            "once": blocks.pack_ints(np.stack(at_root, axis=1).ravel(), "<u8"),
        }
    ]
    out += _to_homes(bucket, "more", per, contexts, np.stack(more, axis=1))
    return pa.Table.from_pylist(out, schema=schema)


def _totals_by_sample(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """Tables of the contexts of a group of buckets in each sample, told to the buckets that these are words of."""
    told = [(r["role"], blocks.unpack_ints(r["contexts"], "<u8"), blocks.unpack_ints(r["counts"], "<u8")) for r in table.to_pylist()]
    contexts, at = np.unique(np.concatenate([c for _, c, _ in told]), return_inverse=True)
    counts = np.concatenate([n.reshape(-1, SAMPLES) if role == "more" else np.repeat(n[:, None], SAMPLES, axis=1) for role, _, n in told])
    total = np.stack([np.bincount(at, weights=counts[:, k], minlength=len(contexts)) for k in range(SAMPLES)], axis=1)
    home, place = (contexts >> np.uint64(32)).astype(np.int64), contexts & np.uint64(0xFFFFFFFF)
    out = [
        {"bucket": int(home[a]), "role": "totals", "words": blocks.pack_ints(place[a:b]), "counts": blocks.pack_ints(total[a:b].ravel(), "<u8")}
        for a, b in _runs(home)
    ]
    return pa.Table.from_pylist(out, schema=schema)


_ANSWER = "block long, bucket long, counts binary, tables binary, root binary, seated binary"


def _answer(table: pa.Table, drawn: list[Totals], schema: pa.Schema) -> pa.Table:
    """For each block, its words' training counts, and by sample their tables as contexts and unigram probabilities; and what its cells hold."""
    by_role = {r["role"]: r for r in table.to_pylist()}
    if "cells" not in by_role:
        return schema.empty_table()
    row, seated = by_role["cells"], by_role["seated"]
    customers, tables = (blocks.unpack_ints(seated[k], "<u8").reshape(-1, SAMPLES).astype(np.float64) for k in ("words", "once"))
    root = np.stack([t.root(customers[:, k], tables[:, k]) for k, t in enumerate(drawn)], axis=1).astype("<f4").view("<u4")
    held = np.concatenate([np.array([0.0, 1 - drawn[0].discount], "<f4").view("<u4"), blocks.unpack_ints(seated["counts"])])
    counts = blocks.unpack_ints(row["word_counts"], "<u8")
    own = np.zeros((len(counts), SAMPLES), np.uint64)
    if "totals" in by_role:
        own[blocks.unpack_ints(by_role["totals"]["words"])] = blocks.unpack_ints(by_role["totals"]["counts"], "<u8").reshape(-1, SAMPLES)
    out = []
    for asked in row["asked"]:
        w = blocks.unpack_ints(asked["words"])
        out.append(
            {
                "block": asked["block"],
                "bucket": row["bucket"],
                "counts": blocks.pack_ints(counts[w], "<u8"),
                "tables": blocks.pack_ints(own[w].ravel(), "<u8"),
                "root": blocks.pack_ints(root[w].ravel()),
                "seated": blocks.pack_ints(held[blocks.unpack_ints(asked["codes"])]),
            }
        )
    return pa.Table.from_pylist(out, schema=schema)


def _score(table: pa.Table, totals: Totals, schema: pa.Schema) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
    docs, answers = rows[0], rows[1:]
    cells, at, n = _cells_of(docs["tokens"])
    word, context = cells // n, cells % n
    counts, tables = (np.concatenate([blocks.unpack_ints(r[k], "<u8") for r in answers]).astype(np.float64) for k in ("counts", "tables"))
    root, seated = (np.concatenate([blocks.unpack_ints(r[k]) for r in answers]).view("<f4").astype(np.float64) for k in ("root", "seated"))
    # a sample's whole predictive probability, with its own totals, averaged over the samples
    opening, root = STRENGTH + totals.discount * tables.reshape(-1, SAMPLES), root.reshape(-1, SAMPLES)
    passed = sum(opening[context, k] * root[word, k] for k in range(SAMPLES)) / SAMPLES
    # a context was seen as often as its word: texts start after the end token, and end with it
    chance = (seated + passed) / (STRENGTH + counts[context])
    logs = np.log10(chance)
    counts = counts[word]
    base = np.log10((counts + 1) / (totals.train_tokens + totals.n_words + 1))
    sizes = np.array(docs["sizes"], np.int64)
    starts = blocks.offsets(sizes)[:-1]
    ids = docs["doc_ids"]
    return pa.Table.from_arrays(
        [
            pa.array(ids, schema.field(0).type),
            pa.array([_held(i) for i in ids]),
            pa.array(sizes),
            pa.array(np.add.reduceat((counts > 0).astype(np.int64)[at], starts)),
            pa.array(np.full(len(ids), totals.train_tokens)),
            pa.array(np.add.reduceat(base[at], starts)),
            pa.array(np.add.reduceat(logs[at], starts)),
        ],
        schema=schema,
    )


def _collected(rows: DataFrame, n: int) -> list[float]:
    """The sums of all buckets: n numbers."""
    found = rows.agg(*(F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(n))).first()
    return [x or 0.0 for x in found]


def _discount(ones: float, twos: float) -> float:
    """The usual estimate from the cells seen once and twice, kept inside (0, 1)."""
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.95)) if ones else 0.5


_TOLD = (
    "bucket long, source long, role string, words binary, contexts binary, counts binary, once binary, word_counts binary,"
    " asked array<struct<block: long, words: binary, codes: binary>>, sums array<double>"
)


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    with_package(spark)
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    cut = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("bucket", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("words", T.BinaryType()),
        ]
    )
    cut_arrow = to_arrow_schema(cut)
    n_buckets = 2 * partitions(spark)
    per = math.isqrt(n_buckets)  # buckets whose contexts are summed by one task: messages grow less than with the square
    table = stored(rows.mapInArrow(lambda it: _cut(it, n_buckets, cut_arrow), cut), "lm-blocks")
    texts = table.where("bucket < 0").drop("words")
    numbers = table.where("bucket >= 0").select("block", "bucket", "words").groupBy("bucket")
    numbers = numbers.applyInArrow(_number, "block long, bucket long, places binary")
    sent = _schema("block long, bucket long, words binary, n_cells binary, contexts binary, counts binary")
    sent_arrow = to_arrow_schema(sent)
    cells = texts.unionByName(numbers, allowMissingColumns=True).groupBy("block").applyInArrow(lambda t: _send(t, sent_arrow), sent)
    told = _schema(_TOLD)
    told_arrow = to_arrow_schema(told)
    gathered = stored(cells.groupBy("bucket").applyInArrow(lambda t: _gather(t, per, told_arrow), told), "lm-cells")
    held = gathered.where("role = 'cells'")

    train_tokens, n_words, types, ones, words_once, twos, words_twice = _collected(held, 7)
    start = Totals(
        int(train_tokens), int(n_words), _discount(ones, twos), _discount(words_once, words_twice), np.zeros(0), np.zeros(0), types, n_words
    )
    first = stored(gathered.where("role = 'types'").groupBy("bucket").applyInArrow(lambda t: _totals(t, told_arrow), told), "lm-tables")
    to_seat = held.withColumn("asked", F.lit(None).cast(told["asked"].dataType))

    def seated(answers: DataFrame, totals: Totals, seed: int, samples: int) -> DataFrame:
        rows = to_seat.unionByName(answers.where("role = 'answer'")).groupBy("bucket")
        return stored(rows.applyInArrow(lambda t: _seat(t, totals, per, told_arrow, seed, samples), told), "lm-tables")

    kept = first.where("role = 'kept'")
    second = seated(first, start, 0, 1)
    root = _collected(second.where("role = 'seated'"), 2)
    settled = replace(start, root_customers=root[0], root_tables=root[1])
    both = kept.unionByName(second.where("role = 'more'"))
    third = seated(both.groupBy("bucket").applyInArrow(lambda t: _totals(t, told_arrow), told), settled, 1_000_003, SAMPLES)
    roots = _collected(third.where("role = 'seated'"), 2 * SAMPLES)
    drawn = [replace(start, root_customers=c, root_tables=t) for c, t in zip(roots[::2], roots[1::2], strict=True)]
    last = kept.unionByName(third.where("role = 'more'")).groupBy("bucket").applyInArrow(lambda t: _totals_by_sample(t, told_arrow), told)
    asked = held.withColumns({n: F.lit(None).cast("binary") for n in ("words", "contexts", "counts", "once")})
    answer = _schema(_ANSWER)
    answer_arrow = to_arrow_schema(answer)
    answers = asked.unionByName(third.where("role = 'seated'")).unionByName(last)
    answers = answers.groupBy("bucket").applyInArrow(lambda t: _answer(t, drawn, answer_arrow), answer)
    both = texts.unionByName(answers, allowMissingColumns=True)
    out = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("held_out", T.BooleanType()),
            *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
            *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score")),
        ]
    )
    out_arrow = to_arrow_schema(out)
    return both.groupBy("block").applyInArrow(lambda t: _score(t, start, out_arrow), out)


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity a token of the model and of the base, apart for training and held-out texts."""

    def of(name: str) -> Column:
        return F.pow(F.lit(10.0), -F.sum(name) / F.sum("n_tokens"))

    return scored.groupBy("held_out").agg(of("score").alias("perplexity"), of("base_score").alias("base_perplexity"))
