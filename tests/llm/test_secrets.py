import hashlib
import re

from pyspark.sql import functions as F

from driftline.llm import secrets
from tests.llm import rows as R

PATTERNS = [
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
]


def brute(text):
    found = []
    for k, (name, pattern, group, least) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            if len(m.group(group)) >= least:
                found.append((m.start(), k, name, m.end()))
    return [(name, f"{name}:{a}:{b}") for a, _, name, b in sorted(found)]


def test_base_spans_match_brute_force(spark):
    many = ",".join(f"{i:016x} t" for i in range(700)) + " token=" + "Ab1_" * 5
    docs = R.table(spark).select("doc_id", "text", "source").unionByName(
        spark.createDataFrame([(5000, many, "s"), (5001, "é日" * 9 + many, "s")], "doc_id long, text string, source string")
    )
    got = secrets.digests(secrets.scan(docs)).collect()
    texts = {r[0]: r[1] for r in R.rows()} | {5000: many, 5001: "é日" * 9 + many}
    assert len(got) == len(R.rows()) + 2
    hits = 0
    for r in got:
        want = brute(texts[r.doc_id])
        hits += len(want)
        assert r.base_sha256 == hashlib.sha256(",".join(s for _, s in want).encode()).hexdigest(), r.doc_id
        for name, *_ in PATTERNS:
            assert r[f"n_{name}"] == sum(n == name for n, _ in want)
        assert {s for _, s in want} <= set(r.spans.split(",")) | {""}
    assert hits > 1400


def test_values_are_judged_by_their_owners(spark):
    docs = R.table(spark)
    found = secrets.candidates(docs, "doc_id", "text", "source", "doc_id")
    verdicts = {r.digest: r for r in secrets.ownership(found, example_owners=3).collect()}

    def digest(value):
        return hashlib.sha256(value.encode()).hexdigest()[:32]

    alone, copied = verdicts[digest("Abcdefgh12345678ijklMNOP0")], verdicts[digest("Zbcdefgh12345678ijklMNOP0")]
    assert (alone.n_owners, alone.verdict) == (1, "live")
    assert (copied.n_owners, copied.n_repos, copied.verdict) == (3, 3, "example")
    spans = {r.doc_id: r.spans for r in secrets.digests(secrets.scan(docs)).collect()}
    k = next(r[0] for r in R.rows() if (r[1] or "").startswith("opaque"))
    assert spans[k] == "opaque:7:32"
    assert all(not spans[r[0]] for r in R.rows() if (r[1] or "").startswith("shared"))


def test_masking_leaves_examples_and_other_columns(spark):
    docs = R.table(spark)
    got = {(r.doc_id, r["text.x"]): r.text for r in secrets.masked(docs).collect()}
    assert secrets.masked(docs).columns == docs.columns
    for r in R.rows():
        text = got[r[0], "dot"]
        if r[1] is None:
            assert text is None
        elif r[1].startswith("shared"):
            assert text == r[1]
        elif "Abcdefgh1234" in r[1]:
            assert text == r[1].replace("Abcdefgh12345678ijklMNOP0", secrets.MASKED)
        elif not brute(r[1]):
            assert text == r[1]
        else:
            assert secrets.MASKED in text and "24be64439e3e" not in text


def test_a_hot_value_counts_once_an_owner(spark):
    rows = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.lit("token: 0123456789abcdef0123").alias("text"), (F.col("id") % 2).cast("string").alias("source")
    )
    found = secrets.candidates(rows, "doc_id", "text", "source", "doc_id")
    (r,) = secrets.ownership(found).collect()
    assert (r.n_owners, r.n_repos, r.n_spans, r.verdict) == (2, 2000, 4000, "example")  # assign and hex
    (r,) = secrets.ownership(found, example_repos=2001).collect()
    assert r.verdict == "shared"
    got = secrets.digests(secrets.scan(rows)).groupBy("n_assign", "n_hex", "n_example").count().collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 2000)]


def opaque(k):
    return f"Opq{k:05d}wxYZabCDefGH12"


def test_opaque_values_of_two_owners_are_reported_and_masked(spark):
    rows = [(1, f"x {opaque(1)} y", "a"), (2, f"x {opaque(1)} y", "b"), (3, f"{opaque(2)}", "a")]
    rows += [(10 + k, f"see {opaque(3)}", "hot") for k in range(secrets.EXAMPLE_REPOS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spans = {r.doc_id: r.spans for r in secrets.digests(secrets.scan(docs)).collect()}
    assert [spans[k] for k in (1, 2, 3, 10)] == ["opaque:2:24", "opaque:2:24", "opaque:0:22", ""]
    got = {r.doc_id: r.text for r in secrets.masked(docs).collect()}
    assert [got[k] for k in (1, 2, 3)] == [f"x {secrets.MASKED} y"] * 2 + [secrets.MASKED]
    assert got[10] == f"see {opaque(3)}"


def test_masks_follow_spans_not_characters(spark):
    text = "password=abcdefghijkl abcdefghijklm xabcdefghijklx é日 password: abcdefghijkl"
    word, both = "token=" + opaque(4), "secret: Ab0123456789abcdef0123"  # the second holds a hex span inside the assigned value
    many = "日" * 5000 + " ".join(f"token={opaque(k)}" for k in range(3000)) + "é" * 5000
    rows = [(1, text, "s"), (2, word, "s"), (3, both, "s"), (4, many, "s"), (5, None, "s"), (6, "", "s"), (6, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in secrets.masked(docs).collect()}
    m = secrets.MASKED
    assert got[1] == f"password={m} abcdefghijklm xabcdefghijklx é日 password: {m}"
    assert (got[2], got[3]) == (f"token={m}", f"secret: {m}")
    assert got[4] == "日" * 5000 + " ".join(f"token={m}" for _ in range(3000)) + "é" * 5000
    assert got[5] is None and got[6] == ""


def test_hot_and_cold_digests_get_their_verdicts(spark):
    rows = [
        (k, f"token={opaque(k % 7 if k % 3 else 0)} " + (f"secret={opaque(1000 + k)}" if k % 5 == 0 else ""), str(k % 2)) for k in range(300)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.candidates(docs, "doc_id", "text", "source", "doc_id")
    owned = {r.digest: r for r in secrets.ownership(found).collect()}
    total = sum(r.n_spans for r in owned.values())
    shares = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 0 < sum(r.n_spans * shares > total for r in owned.values()) < len(owned)
    each = found.selectExpr("row_id", "explode(spans) AS s").selectExpr("row_id", "s.start", "s.k", "s.digest").collect()
    want = sorted((r.row_id, r.start, r.k, owned[r.digest].verdict) for r in each if r.k < 3 or owned[r.digest].verdict != "example")
    got = sorted((r.row_id, r.start, r.k, r.verdict) for r in secrets.judged(found).collect())
    assert got == want


def test_empty_table(spark):
    none = R.table(spark).limit(0)
    assert secrets.digests(secrets.scan(none)).count() == 0
    assert secrets.masked(none).count() == 0
