"""Secret scans: spans of candidate credentials, judged by how widely each value is copied in the corpus.

Every kind is one pattern; spans are leftmost and non-overlapping per kind, in code points. Candidates carry
a digest of their value, never the value. Digests are counted by distinct owners and repositories: a value
that several owners hold, or very many repositories of one, is an `example` (documentation, templates); any other
is `live` with a single owner and `shared` with more. The `opaque` kind (long tokens that mix digits and both
cases) is reported unless it is an example; the base kinds always are.

The texts are read once; what is found goes to the shared folder. Counting is done on distinct (digest, owner,
repository) rows, which shrink before each shuffle. Verdicts return to the spans by a join on the digest; the few
digests that hold more than an even share of all spans (at most as many as there are shares) are broadcast, so no
task gets all spans of one value.

`masked` cuts out the reported spans' values, no other place of the same characters. It keeps the rows it masks
below the shared folder while verdicts are found: whole texts, as the table it reads.

Defined cases: a null or empty text has no spans; repeated rows are each reported and count once as owner; a
null owner or repository is one of its own; values that overlap are masked as one; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import col, let, looked_up, stored

#: kind, pattern, group that holds the value, least characters of the value. Fixed values of the contract.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Further kinds, reported where they are no examples. The value must also hold a digit and letters of both cases.
ADDED = (("opaque", r"[A-Za-z0-9+/_-]{20,}", 0, 20),)
KINDS = BASE + ADDED

#: So many owners, or so many repositories, make a value an example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOS = 100
MASKED = "[SECRET]"
_SPAN = "struct<start:bigint,k:int,end:bigint,digest:string>"
#: Code points of the pieces that a text is cut into, so that taking many stretches stays linear.
_PIECE = 4096
#: Matches whose offsets one fold appends; longer lists are folded in such chunks.
_CHUNK = 256


def _starts(sizes: Column) -> Column:
    """Start of each match from (gap, len) pairs: running sums, in chunks so that long lists stay linear."""

    def run(sizes: Column, at: Column) -> Column:
        zero = F.struct(at.cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            sizes,
            zero,
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["len"]).alias("at"),
                F.concat(acc["out"], F.array(acc["at"] + x["gap"])).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    def chunked(sizes: Column) -> Column:
        count = F.ceil(F.size(sizes) / F.lit(_CHUNK)).cast("int")
        parts = F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.slice(sizes, i * _CHUNK + 1, F.lit(_CHUNK))
        )

        def placed(parts: Column) -> Column:
            sums = F.transform(
                parts,
                lambda p: F.struct(
                    F.aggregate(p, F.lit(0).cast("long"), lambda t, x: t + x["gap"] + x["len"]).alias("gap"),
                    F.lit(0).cast("long").alias("len"),
                ),
            )
            # the running sum before a chunk is the one after it less its own
            return let(sums, lambda s: F.flatten(F.zip_with(parts, F.zip_with(run(s, F.lit(0)), s, lambda a, b: a - b["gap"]), run)))

        return let(parts, placed)

    return let(sizes, lambda s: F.when(F.size(s) <= _CHUNK, run(s, F.lit(0))).otherwise(chunked(s)))


def _spans(text: Column, k: int) -> Column:
    """Spans of one kind, as an array of (start, k, end, digest)."""
    name, pattern, group, least = KINDS[k]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        sizes = F.transform(
            F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("hit")),
            lambda x: F.struct(
                F.length(x["gap"]).cast("long").alias("gap"), F.length(x["hit"]).cast("long").alias("len")
            ),
        )
        spans = F.transform(
            F.arrays_zip(_starts(sizes).alias("at"), found.alias("hit"), values.alias("value")),
            lambda x: F.struct(
                x["at"].alias("start"),
                F.lit(k).alias("k"),
                (x["at"] + F.length(x["hit"])).alias("end"),
                x["value"].alias("digest"),
            ),
        )
        return spans

    def good(x: Column) -> Column:
        enough = F.length(x["digest"]) >= least
        if name == "opaque":
            for need in ("[0-9]", "[a-z]", "[A-Z]"):
                enough &= x["digest"].rlike(need)
        return enough

    none = F.array().cast(f"array<{_SPAN}>")
    kept = F.filter(let(found, lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(none)), good)
    return kept


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str, carry: bool = False) -> DataFrame:
    """One row per row, written once: row_id, doc_id, owner, repo, spans (with digest and size of the value) [, row]."""
    rows = docs.select(
        col(id_col).alias("doc_id"),
        col(owner_col).cast("string").alias("owner"),
        col(repo_col).cast("string").alias("repo"),
        F.coalesce(col(text_col), F.lit("")).alias("t"),
        *([F.struct(*(col(c) for c in docs.columns)).alias("row")] if carry else []),
    )
    found = F.array_sort(F.concat(*(_spans(F.col("t"), k) for k in range(len(KINDS)))))
    kept = ["doc_id", "owner", "repo", *(["row"] if carry else [])]
    rows = rows.select(*kept, found.alias("found"))
    hidden = F.transform(
        "found",
        lambda x: F.struct(
            x["start"],
            x["k"],
            x["end"],
            F.substring(F.sha2(x["digest"], 256), 1, 32).alias("digest"),
            F.length(x["digest"]).cast("long").alias("size"),
        ),
    )
    return stored(rows.select(F.monotonically_increasing_id().alias("row_id"), *kept, hidden.alias("spans")), "secrets")


def ownership(found: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """Per value digest: n_owners, n_repos (distinct owner and repository pairs), n_spans and the verdict."""
    each = found.select(F.explode("spans.digest").alias("digest"), "owner", "repo")
    seen = each.groupBy("digest", "owner", "repo").agg(F.count("*").alias("n"))
    owners = seen.groupBy("digest", "owner").agg(F.count("*").alias("n_repos"), F.sum("n").alias("n"))
    counts = owners.groupBy("digest").agg(
        F.count("*").alias("n_owners"), F.sum("n_repos").alias("n_repos"), F.sum("n").alias("n_spans")
    )
    wide = (F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos)
    return counts.withColumn(
        "verdict", F.when(wide, "example").when(F.col("n_owners") == 1, "live").otherwise("shared")
    )


def judged(found: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """The reported spans: (row_id, start, k, end, size, digest, verdict)."""
    owned = stored(ownership(found, example_owners, example_repos).select("digest", "verdict", "n_spans"), "secret-owners")
    each = found.select("row_id", F.explode("spans").alias("s")).select("row_id", "s.*")
    told = looked_up(each, owned, "digest", "n_spans")
    return told.where((F.col("k") < len(BASE)) | (F.col("verdict") != "example"))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
    example_repos: int = EXAMPLE_REPOS,
) -> DataFrame:
    """One row per row: doc_id and `said`, the reported spans (start, k, end, verdict, digest) in order."""
    found = candidates(docs, id_col, text_col, owner_col, repo_col)
    said = judged(found, example_owners, example_repos).groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "k", "end", "verdict", "digest"))).alias("said")
    )
    rows = found.select("row_id", "doc_id").join(said, "row_id", "left")
    empty = F.array().cast(dict(said.dtypes)["said"])
    return rows.select("doc_id", F.coalesce("said", empty).alias("said"))


def listing(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k[0]) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")


def digests(scanned: DataFrame) -> DataFrame:
    base = F.filter("said", lambda s: s["k"] < len(BASE))

    def count(field: str, value: int | str) -> Column:
        return F.size(F.filter("said", lambda s: s[field] == value)).cast("long")

    return scanned.select(
        "doc_id",
        *(count("k", k).alias(f"n_{kind[0]}") for k, kind in enumerate(BASE)),
        F.sha2(listing(base), 256).alias("base_sha256"),
        listing(F.col("said")).alias("spans"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "example").alias("n_example"),
    )


def _stretch(pieces: Column, a: Column, b: Column) -> Column:
    """Code points a (included) to b of a text that is cut into pieces of _PIECE."""
    first = F.floor(a / _PIECE).cast("int")
    last = F.floor((b - 1) / _PIECE).cast("int")
    some = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    return F.when(b > a, F.substring(some, (a - first * _PIECE + 1).cast("int"), (b - a).cast("int"))).otherwise("")


def cut_out(text: Column, cuts: Column) -> Column:
    """The text with MASKED for each of the disjoint places (a, b), given in order; without places as it came."""

    def parted(pieces: Column) -> Column:
        before = F.transform(
            cuts, lambda c, i: _stretch(pieces, F.when(i == 0, 0).otherwise(F.get(cuts, i - 1)["b"]).cast("long"), c["a"])
        )
        tail = _stretch(pieces, F.get(cuts, F.size(cuts) - 1)["b"], F.length(text).cast("long"))
        return F.concat(F.array_join(F.transform(before, lambda x: F.concat(x, F.lit(MASKED))), ""), tail)

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    return F.when(F.size(cuts) > 0, let(pieces, parted)).otherwise(text)


def masked(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
    example_repos: int = EXAMPLE_REPOS,
) -> DataFrame:
    """The rows with the value of every reported span masked that is no widely copied example; other columns as they came."""
    found = candidates(docs, id_col, text_col, owner_col, repo_col, carry=True)
    bad = judged(found, example_owners, example_repos).where("verdict != 'example'")
    places = bad.select("row_id", (F.col("end") - F.col("size")).alias("a"), F.col("end").alias("b"))
    order = Window.partitionBy("row_id").orderBy("a", "b")
    ended = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    places = places.withColumn("new", F.coalesce(F.col("a") >= ended, F.lit(True)).cast("long"))
    islands = places.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    islands = islands.groupBy("row_id", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    cuts = islands.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("cuts"))
    rows = found.select("row_id", "row").join(cuts, "row_id", "left")
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    text = cut_out(F.col("row")[text_col], F.coalesce("cuts", none))
    return rows.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
