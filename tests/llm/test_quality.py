import re

import pytest

from driftline.llm import quality
from tests.llm import rows as R

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = [x for x in BLANK.split(t) if x]
    lines = [x for x in t.split("\n") if BLANK.sub("", x)]
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    m = {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(t.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
    return m, m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]


@pytest.fixture(scope="module")
def ledger(spark):
    return quality.ledger(R.table(spark)).cache()


def test_matches_brute_force(spark, ledger):
    got = {r.doc_id: r for r in quality.decide(ledger).collect()}
    assert quality.decide(ledger).count() == len(R.rows())
    for row in R.rows():
        m, failed = brute(row[1])
        r = got[row[0]]
        assert {k: r[k] for k in m} == m, row[:2]
        assert r.base_failed == failed
        assert not (r.kept and failed)


def test_policies_read_the_ledger_only(ledger):
    base = quality.decide(ledger, quality.POLICIES[1]).where("kept").count()
    full = quality.decide(ledger, quality.POLICIES[2]).where("kept").count()
    assert 0 < full < base
    table = {(r.kept_old, r.kept_new): r.n_rows for r in quality.compare_policies(ledger, *quality.POLICIES.values()).collect()}
    assert (False, True) not in table and sum(table.values()) == len(R.rows())


def test_ablation_counts_what_one_rule_alone_rejects(ledger):
    bits = [r.fail_bits & quality.CURRENT.mask for r in ledger.collect()]
    for r in quality.ablations(ledger).collect():
        assert r.failed == sum(b & r.bit != 0 for b in bits)
        assert r.rescued == sum(b == r.bit for b in bits)


def test_kept_rows_come_whole(spark):
    docs = R.table(spark)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in quality.decide(quality.ledger(docs)).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids


def test_empty_table(spark):
    none = R.table(spark).limit(0)
    assert quality.decide(quality.ledger(none)).count() == 0
    assert quality.keep_good(none).count() == 0
