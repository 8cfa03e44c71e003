from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from driftline.llm import packing
from tests.llm import rows as R

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    return [e.ids + [1] for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("window,limit", [(2048, 16), (64, 2)])
def test_every_id_lies_in_one_place(spark, window, limit):
    got = packing.pack(R.table(spark), PATH, window=window, open_windows=limit).collect()
    rows = R.rows()
    want = defaultdict(list)
    for row, ids in zip(rows, ids_of([r[1] for r in rows]), strict=True):
        want[row[0]].append(ids)
    by_doc = defaultdict(list)
    for p in got:
        by_doc[p.doc_id].append(p)
        assert len(p.ids) == 4 * p.length and 0 < p.length <= window
    for doc_id, lists in want.items():
        pieces = sorted(by_doc[doc_id], key=lambda p: (p.start, p.sequence_id, p.offset))
        assert sum(p.length for p in pieces) == sum(map(len, lists))
        for p in pieces:
            assert any(np.frombuffer(p.ids, "<u4").tolist() == ids[p.start : p.start + p.length] for ids in lists)
            assert p.doc_tokens in {len(x) for x in lists}
    by_sequence = defaultdict(list)
    for p in got:
        by_sequence[p.sequence_id].append(p)
    short = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        short += at < window
    assert short <= 1  # three partitions merge in one group


def test_best_fit_then_the_fullest_is_topped_up():
    done = []
    w = packing.Windows(10, 2, lambda s, pieces: done.append([(d, a, len(i) // 4) for d, a, i, _ in pieces]))
    for name, n in (("a", 6), ("b", 7), ("c", 3), ("d", 9), ("e", 25)):
        w.add(name, bytes(4 * n), 0, n, n)
    assert done[0] == [("b", 0, 7), ("c", 0, 3)]  # best fit, not first fit
    assert done[1:3] == [[("e", 0, 10)], [("e", 10, 10)]]
    assert done[3] == [("d", 0, 9), ("e", 20, 1)]
    assert done[4] == [("a", 0, 6), ("e", 21, 4)] and not w.open


def test_empty_table(spark):
    assert packing.pack(R.table(spark).limit(0), PATH).count() == 0
