import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from driftline.llm import bpe
from tests.llm import rows as R

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("chars", [16_000_000, 500])
def test_equals_the_library(spark, monkeypatch, chars):
    monkeypatch.setattr("driftline.llm.blocks.documents_by_block.__defaults__", (chars,))
    coder = Tokenizer.from_file(PATH)
    got = bpe.encode(R.table(spark), PATH).collect()
    want = sorted(
        (str(r[0]), (ids := coder.encode(r[1] or "", add_special_tokens=False).ids), coder.decode(ids, skip_special_tokens=False))
        for r in R.rows()
    )
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in got) == want


def test_decode_joins_ids_to_pieces(spark):
    rows = [(1, [320, 49407, 256]), (2, []), (3, None), (None, [5, 5])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    coder = Tokenizer.from_file(PATH)
    got = {r.doc_id: r.text for r in bpe.decode(df, PATH).collect()}
    assert got == {i: coder.decode(ids or [], skip_special_tokens=False) for i, ids in rows}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.check(public_tokenizers.path("byte_bpe_50k.json"))


def test_empty_table(spark):
    assert bpe.encode(R.table(spark).limit(0), PATH).select(F.size("ids")).count() == 0
