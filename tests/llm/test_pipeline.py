"""The corpus pipeline against plain Python over a small folder of tables."""

from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from driftline.llm import quality
from tests.llm import rows as R
from tests.llm.test_neardup import brute

SECRET = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'


def texts():
    out = {}
    for i in range(240):
        insult = " you blorftag " if i % 5 == 0 else " you kind "
        out[i] = R.prose(i, 45) + insult + R.prose(i + 1000, 25)
    for k in range(6):
        out[300 + k] = R.changed(out[1 + 6 * k], 3)  # near copies
        out[310 + k] = out[2 + 6 * k]  # exact copies
        out[320 + k] = " ".join(w + "***" for w in R.words(500 + k, 40))  # junk
        out[330 + k] = R.prose(600 + k, 30) + " you kind " + SECRET.replace("24be", f"{k:04x}") + " " + R.prose(700 + k, 30)
    out[340], out[341], out[342] = None, "", "few words"
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, "en", f"src{i % 4}", len(t or "")) for i, t in texts().items()]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(
        3
    ).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What each stage gets and returns, as lists of rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, out = docs.columns, {}
    for name, stage in P.STAGES:
        got = stage(spark, docs, folder)
        if name != P.STAGES[-1][0]:
            assert got.columns == columns
        kept = got.collect()
        out[name] = ({r.doc_id: r.text for r in docs.collect()}, kept)
        if name != P.STAGES[-1][0]:
            docs = spark.createDataFrame(kept, docs.schema)
    return out


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in P.STAGES] == ["quality", "toxicity", "neardup", "secrets", "packing"]


def test_quality_drops_what_the_policy_rejects(spark, stages):
    before, after = stages["quality"]
    rows = spark.createDataFrame(list(before.items()), "doc_id long, text string")
    kept = {r.doc_id for r in quality.decide(quality.ledger(rows)).where("kept").collect()}
    assert {r.doc_id for r in after} == kept
    assert not kept & {340, 341, 342, *range(320, 326)} and set(range(240)) <= kept


def test_toxicity_drops_insults_and_keeps_the_rest(stages):
    before, after = stages["toxicity"]
    assert {r.doc_id for r in after} == {i for i, t in before.items() if "blorftag" not in t}


def test_neardup_keeps_one_of_each_group(stages):
    before, after = stages["neardup"]
    _, label = brute(before)
    assert {r.doc_id for r in after} == {i for i, c in label.items() if i == c}
    assert not {r.doc_id for r in after} & {301, 303, 311}


def test_neardup_drops_near_copies_from_four_fifths_on(spark):
    """One word of 60 changed: 51 of 61 shingles shared (0.836); two: 46 of 66 (0.70)."""
    out = {}
    for k in range(20):
        text = R.prose(4000 + k, 60)
        out |= {k: text, 100 + k: R.changed(text, 30), 200 + k: R.changed(R.changed(text, 15), 45)}
    docs = spark.createDataFrame(list(out.items()), "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in P.neardup_stage(spark, docs, "").collect()}
    assert kept == {*range(20), *range(200, 220)}


def test_secrets_are_masked_and_nothing_else_changes(stages):
    before, after = stages["secrets"]
    assert {r.doc_id for r in after} == set(before)
    for r in after:
        text = before[r.doc_id]
        if 330 <= r.doc_id < 336:
            value = SECRET.split('"')[1].replace("24be", f"{r.doc_id - 330:04x}")
            text = text.replace(value, "[SECRET]")
        assert r.text == text and r.n_chars == len(text)


def test_packing_holds_every_id_once(stages):
    before, pieces = stages["packing"]
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc = defaultdict(list)
    for p in pieces:
        assert crc32(p.ids) == p.ids_crc32
        by_doc[p.doc_id].append(p)
    assert set(by_doc) == set(before)
    for i, text in before.items():
        got = [np.frombuffer(p.ids, "<u4") for p in sorted(by_doc[i], key=lambda p: p.start)]
        assert np.concatenate(got).tolist() == coder.encode(text, add_special_tokens=False).ids + [1]


def test_run_equals_the_stages(spark, folder, stages):
    def tokens(pieces):
        total = defaultdict(int)
        for p in pieces:
            total[p.doc_id, p.doc_tokens] += p.length
        return total

    assert tokens(P.run(spark, folder).collect()) == tokens(stages["packing"][1])


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert P.run(spark, path).count() == 0
