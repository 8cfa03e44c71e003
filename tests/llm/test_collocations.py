import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import collocations, cqf
from tests.llm import rows as R


def brute(rows, least=10, covered=50, top=2000):
    """The contract over (text, lang), one phrase at a time."""
    counts, out = {}, []
    for text, lang in rows:
        f = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for k in (1, 2, 3):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        n = sum(v for g, v in f.items() if len(g) == 1)
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        hidden = {part for g, a in found.items() if len(g) == 3 for part in (g[:2], g[1:]) if 100 * a >= covered * f[part]}
        kept = []
        for g, a in found.items():
            if g not in hidden:
                score, _, left, right = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                kept.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def check(docs, **options):
    got = sorted(tuple(r) for r in collocations.mine(docs, **options).collect())
    assert got == brute([(r.text, r.lang) for r in docs.collect()], **options)
    return got


def prose_rows():
    """Texts over few words, so that phrases of all kinds repeat."""
    words = "alpha beta gamma delta eps Zeta é 日本 x.y a,b no\tblank".split(" ")
    rng = np.random.default_rng(5)
    out = []
    for k in range(120):
        text = " ".join(words[int(i)] for i in np.minimum(rng.geometric(0.25, 60) - 1, len(words) - 1))
        out.append((text + (" fixed phrase here" * 2 + "! FIXED phrase there. " if k % 3 else "\r\n; "), ["en", None, "und", "fr"][k % 4]))
    return out


def test_hard_rows_equal_brute_force(spark):
    assert check(R.table(spark), least=2)


@pytest.mark.parametrize("options", [{}, {"least": 2}, {"top": 5}, {"covered": 90, "least": 3}])
def test_phrases_equal_brute_force(spark, options):
    docs = spark.createDataFrame(prose_rows(), "text string, lang string").repartition(3)
    got = check(docs, **options)
    assert {r[0] for r in got} == {"en", "und", "fr"}


@pytest.mark.parametrize("fan", [2, 4])
def test_many_shards_merge_in_hops(spark, monkeypatch, fan):
    hops_of = collocations.hops_of
    monkeypatch.setattr(collocations, "hops_of", lambda shards: hops_of(shards, fan))
    docs = spark.createDataFrame(prose_rows(), "text string, lang string").repartition(9)
    assert len(hops_of(9, fan)) > 1
    check(docs, least=3)


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(None, "en"), ("", None), ("one two", "en")], "text string, lang string")
    assert collocations.mine(docs).count() == 0 and collocations.mine(docs.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_019
    row = spark.range(1).selectExpr(f"{big}L a", f"{big + 2}L l", f"{big + 7}L r")
    got = row.select(collocations._scored(row.a, row.l, row.r).alias("s")).first().s
    assert got == 10**6 * big * big // ((big + 2) * (big + 7))


@pytest.mark.parametrize("shards,fan", [(1, 1024), (2, 1024), (211, 1024), (5000, 1024), (9, 2), (10**6, 1024), (10**9, 64)])
def test_hops_cover_the_shards(shards, fan):
    hops = collocations.hops_of(shards, fan)
    assert shards <= 1 << sum(hops) <= max(2, 2 * shards) and all(1 <= 1 << h <= fan for h in hops)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, cqf.MOST_BITS), st.data())
def test_filters_give_back_what_went_in(bits, data):
    packing = cqf.Packing(bits)
    ids = st.integers(0, (1 << bits) - 1)
    grams = data.draw(st.lists(st.tuples(ids, ids, ids), min_size=1, max_size=60))
    counts = data.draw(st.lists(st.integers(1, 2**40), min_size=len(grams), max_size=len(grams)))
    halves = packing.pack(*(np.array(x, np.uint64) for x in zip(*grams, strict=True)))
    assert [tuple(int(v) for v in t) for t in zip(*packing.unpack(*halves), strict=True)] == grams
    want = Counter()
    for g, c in zip(grams, counts, strict=True):
        want[g] += c
    entries = packing.summed(*halves, np.array(counts, np.uint64))
    common = data.draw(st.integers(0, packing.half))
    got = Counter()
    for prefix, found in cqf.split(entries, packing.half, common):
        twice = cqf.merge([found, found], packing, common, prefix)
        assert len(twice[0]) == len(set(zip(twice[0].tolist(), twice[1].tolist(), strict=True)))
        for *g, c in zip(*packing.unpack(*twice[:2]), twice[2], strict=True):
            assert c % 2 == 0
            got[tuple(int(v) for v in g)] += int(c) // 2
    assert got == want
