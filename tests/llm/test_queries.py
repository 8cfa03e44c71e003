"""The registered queries on the smallest given tables: SQL where there is some, rows and ids elsewhere."""

import os

import duckdb
import pytest

from driftline.llm import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")
ONE_ROW_A_DOCUMENT = ["op1_", "op3_", "op5_", "op6_", "op7_", "op8_", "op9_", "op10_", "op12_", "op13_"]


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))
    assert set(Q.ORACLES) <= set(Q.QUERIES)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = Q.QUERIES[name](spark, SF)
    cur = con.execute(Q.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(tuple(r) for r in cur.fetchall())
    assert sorted(tuple(r) for r in got.select(*names).collect()) == want and want


@pytest.mark.parametrize("prefix", ONE_ROW_A_DOCUMENT)
def test_every_document_has_its_row(spark, prefix):
    (name,) = (n for n in Q.QUERIES if n.startswith(prefix))
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = [r.doc_id for r in Q.QUERIES[name](spark, SF).select("doc_id").collect()]
    assert len(got) == len(ids) and set(got) == ids


def test_sql_and_operator_agree_on_every_blank(spark, tmp_path):
    """Words parted by CR, VT, FF, tabs and line feeds, in the text queries with SQL over documents."""
    words = [f"word{i}" for i in range(9)]
    texts = [sep.join(words) for sep in (" ", "\r", "\x0b", "\x0c", "\r\n", "\t ", "\x1c")] + [None, "", " \r"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("op1_quality_rules", "op3_minhash_neardup", "op11_collocations", "op12_exact_dedup", "op13_merkle_manifest"):
        got = Q.QUERIES[name](spark, str(tmp_path))
        cur = con.execute(Q.ORACLES[name])
        names = [d[0] for d in cur.description]
        assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(tuple(r) for r in cur.fetchall()), name
    told = Q.QUERIES["op3_minhash_neardup"](spark, str(tmp_path)).where("doc_id < 6").select("component_id").distinct().collect()
    assert [r.component_id for r in told] == [0]
