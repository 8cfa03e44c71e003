"""Drift, monitoring and retrain queries: line items by ship date and ship year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import drift as D
from driftline.operators import split
from driftline.plans import run
from driftline.plans.catalog import base as B
from driftline.plans.catalog.base import q6, r6, register

CUT = "1998-06-01"
SHIFT = {
    "l_extendedprice": D.Shift(0.5, 30000, 0, 200000),
    "l_quantity": D.Shift(1, 5, 1, 50),
}
THRESHOLD = 0.55
NUM = list(B.LINE_NUMERIC)
TXT = ["l_returnflag", "l_linestatus"]
COLUMNS = NUM + TXT

# Later ship dates are shifted, and lose their status where the flag is A.
SIDES_SQL = (
    B.LINES_SQL
    + f""",
ref AS (SELECT * FROM lines WHERE ship_date < DATE '{CUT}'),
cur AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ship_date,
         least(greatest(l_quantity + 5, 1), 50) AS l_quantity,
         least(greatest(l_extendedprice * 0.5::DOUBLE + 30000, 0), 200000) AS l_extendedprice,
         l_discount, l_tax, l_returnflag,
         CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_linestatus END AS l_linestatus, outcome
  FROM lines WHERE ship_date >= DATE '{CUT}')
"""
)


def sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = B.lines(spark, sf)
    ref = rows.where(F.col("ship_date") < F.lit(CUT).cast("date"))
    cur = D.shift_features(rows.where(F.col("ship_date") >= F.lit(CUT).cast("date")), SHIFT)
    return ref, cur.withColumn("l_linestatus", F.when(F.col("l_returnflag") != "A", F.col("l_linestatus")))


def _lerp(order: str) -> str:
    """Interpolated order statistic: `order` holds the ranked values of one column."""
    return f"""
  SELECT "column", p, CASE WHEN t >= 0.5 THEN b - (b - a) * (1 - t) ELSE a + (b - a) * t END AS cut FROM (
    SELECT h."column", h.p, h.h - floor(h.h) AS t, lo.v AS a, hi.v AS b
    FROM h JOIN {order} lo ON lo."column" = h."column" AND lo.i = floor(h.h)
           JOIN {order} hi ON hi."column" = h."column" AND hi.i = ceil(h.h))"""


def _long(source: str, cols: list[str], keep: str = "") -> str:
    lead = f"{keep}, " if keep else ""
    return " UNION ALL ".join(f"SELECT {lead}'{c}' AS \"column\", {c} AS v FROM {source}" for c in cols)


def cuts_sql(num: list[str] = NUM) -> str:
    return f"""
rl AS (SELECT * FROM ({_long('ref', num)}) WHERE v IS NOT NULL),
ro AS (SELECT "column", v, row_number() OVER (PARTITION BY "column" ORDER BY v) - 1 AS i,
              count(*) OVER (PARTITION BY "column") AS n FROM rl),
rn AS (SELECT "column", max(n) AS n FROM ro GROUP BY 1),
h AS (SELECT "column", k AS p, (n - 1) * CASE WHEN k = 10 THEN 1.0::DOUBLE ELSE k * 0.1::DOUBLE END AS h FROM rn, range(11) g(k)),
q AS ({_lerp('ro')}),
cuts AS (SELECT "column", cut, row_number() OVER (PARTITION BY "column" ORDER BY cut) - 1 AS b,
                lead(cut) OVER (PARTITION BY "column" ORDER BY cut) AS hi,
                max(cut) OVER (PARTITION BY "column") AS top, count(*) OVER (PARTITION BY "column") - 1 AS n_bins
         FROM (SELECT DISTINCT "column", cut FROM q))
"""


def psi_sql(window: str = "", num: list[str] = NUM) -> str:
    """PSI by joining every value with its bin; `window` names a window column of cur."""
    w, on = (f"{window}, ", f"x.{window} = wn.{window} AND ") if window else ("", "")
    windows = f"SELECT DISTINCT {window} FROM cur" if window else "SELECT 1 AS one"
    wsel = f"wn.{window}, " if window else ""
    return f"""{cuts_sql(num)},
cl AS (SELECT * FROM ({_long('cur', num, window)}) WHERE v IS NOT NULL),
cn AS (SELECT {w}"column", count(*) AS n FROM cl GROUP BY ALL),
rb AS (SELECT c."column", c.b, count(*) AS k FROM rl JOIN cuts c ON c."column" = rl."column"
       AND rl.v >= c.cut AND (rl.v < c.hi OR (c.hi = c.top AND rl.v = c.top)) GROUP BY ALL),
cb AS (SELECT {w}c."column", c.b, count(*) AS k FROM cl JOIN cuts c ON c."column" = cl."column"
       AND cl.v >= c.cut AND (cl.v < c.hi OR (c.hi = c.top AND cl.v = c.top)) GROUP BY ALL),
wn AS ({windows}),
sh AS (SELECT {wsel}c."column", greatest(coalesce(rb.k, 0) / rn.n::DOUBLE, 1e-6) AS r,
              greatest(coalesce(x.k, 0) / coalesce(cn.n, 1)::DOUBLE, 1e-6) AS c, n_bins, rn.n AS rn, coalesce(cn.n, 0) AS cn
       FROM wn CROSS JOIN cuts c JOIN rn ON rn."column" = c."column"
       LEFT JOIN cn ON {on.replace('x.', 'cn.')}cn."column" = c."column"
       LEFT JOIN rb ON rb."column" = c."column" AND rb.b = c.b
       LEFT JOIN cb x ON {on}x."column" = c."column" AND x.b = c.b
       WHERE c.hi IS NOT NULL),
psi AS (SELECT {w}"column", CASE WHEN max(rn) < 10 OR max(cn) < 10 OR max(n_bins) < 2 THEN 0
               ELSE sum((c - r) * ln(c / r)) END AS score FROM sh GROUP BY ALL)
"""


def tv_sql(window: str = "", token: str | None = None, txt: list[str] = TXT) -> str:
    """Category shares of both sides, missing ones as zero."""
    w = f"{window}, " if window else ""
    fill = f"coalesce(v, '{token}')" if token else "v"
    windows = f"SELECT DISTINCT {window} FROM cur" if window else "SELECT 1 AS one"
    wsel = f"wn.{window}, " if window else ""
    on = f"x.{window} = k.{window} AND " if window else ""
    total = f"(SELECT count(*) FROM cur z WHERE z.{window} = k.{window})" if window else "(SELECT count(*) FROM cur)"
    return f"""
tr AS (SELECT "column", {fill} AS v, count(*) AS n FROM ({_long('ref', txt)}) GROUP BY ALL),
tc AS (SELECT {w}"column", {fill} AS v, count(*) AS n FROM ({_long('cur', txt, window)}) GROUP BY ALL),
tk AS (SELECT DISTINCT "column", v FROM (SELECT "column", v FROM tr UNION ALL SELECT "column", v FROM tc)),
twn AS ({windows}),
k AS (SELECT {wsel.replace('wn.', 'twn.')}tk."column", tk.v FROM twn CROSS JOIN tk),
tsh AS (SELECT {wsel.replace('wn.', 'k.')}k."column", coalesce(tr.n, 0) / (SELECT count(*) FROM ref)::DOUBLE AS p,
               coalesce(x.n, 0) / {total}::DOUBLE AS q
        FROM k LEFT JOIN tr ON tr."column" = k."column" AND tr.v IS NOT DISTINCT FROM k.v
        LEFT JOIN tc x ON {on}x."column" = k."column" AND x.v IS NOT DISTINCT FROM k.v)
"""


def w1_sql(window: str = "") -> str:
    """Area between the two cumulative shares, over the sorted union of values."""
    w = f"{window}, " if window else ""
    part = f'PARTITION BY {w}"column"'
    repeat = f"(SELECT wn2.{window}, rl2.* FROM (SELECT DISTINCT {window} FROM cur) wn2 CROSS JOIN rl2)" if window else "rl2"
    return f"""
rl2 AS (SELECT * FROM ({_long('ref', NUM)}) WHERE v IS NOT NULL),
cl2 AS (SELECT * FROM ({_long('cur', NUM, window)}) WHERE v IS NOT NULL),
un AS (SELECT {w}"column", v, sum(a) AS a, sum(b) AS b FROM (
         SELECT {w}"column", v, 1 AS a, 0 AS b FROM {repeat} UNION ALL SELECT {w}"column", v, 0, 1 FROM cl2) GROUP BY ALL),
st AS (SELECT {w}"column", lead(v) OVER ({part} ORDER BY v) - v AS gap,
              sum(a) OVER ({part} ORDER BY v) / (sum(a) OVER ({part}))::DOUBLE AS fa,
              sum(b) OVER ({part} ORDER BY v) / (sum(b) OVER ({part}))::DOUBLE AS fb FROM un),
sd AS (SELECT "column", stddev_pop(v) AS sd FROM rl2 GROUP BY 1),
w1 AS (SELECT {w.replace(window, 'st.' + window) if window else ''}st."column", sum(abs(fa - fb) * gap) / greatest(max(sd), 0.001) AS score
       FROM st JOIN sd ON sd."column" = st."column" GROUP BY ALL)
"""


def js_sql(window: str = "") -> str:
    w = f"{window}, " if window else ""
    return f"""
js AS (SELECT {w}"column", sqrt(greatest(0.5 * sum(
         CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END), 0)) AS score FROM jsh GROUP BY ALL)
"""


def _js_shares(window: str = "") -> str:
    text = tv_sql(window, "Unknown")
    for a, b in (("tr AS", "jr AS"), ("tc AS", "jc AS"), ("tk AS", "jk AS"), ("twn AS", "jwn AS"), ("\nk AS", "\njkk AS"), ("tsh AS", "jsh AS")):
        text = text.replace(a, b)
    text = text.replace("FROM tr UNION ALL", "FROM jr UNION ALL").replace("FROM tc)", "FROM jc)")
    text = text.replace("FROM twn CROSS JOIN tk", "FROM jwn CROSS JOIN jk").replace("twn.", "jwn.").replace("tk.", "jk.")
    return (
        text.replace("FROM k LEFT JOIN tr ON tr.", "FROM jkk k LEFT JOIN jr tr ON tr.").replace("LEFT JOIN tc x", "LEFT JOIN jc x")
    )


ORD = "CASE \"column\" " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(COLUMNS)) + " END"
TV = 'tv AS (SELECT "column", 0.5 * sum(abs(p - q)) AS score FROM tsh GROUP BY 1)'


@register("psi", f'WITH {SIDES_SQL}, {psi_sql()} SELECT "column", {q6("score")} AS score FROM psi')
def psi(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = sides(spark, sf)
    return D.psi(ref, cur, NUM).select("column", r6("score"))


@register("total_variation", f'WITH {SIDES_SQL}, {tv_sql()}, {TV} SELECT "column", {q6("score")} AS score FROM tv')
def total_variation(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = sides(spark, sf)
    return D.total_variation(ref, cur, TXT).select("column", r6("score"))


@register(
    "drift_empty_window",
    f"""WITH {SIDES_SQL} SELECT {ORD} AS ordinal, "column", score FROM (
          SELECT unnest({NUM}) AS "column", 0.0::DOUBLE AS score FROM (SELECT count(*) FROM ref)
          UNION ALL SELECT unnest({TXT}), CASE WHEN n > 0 THEN 0.5 ELSE 0 END FROM (SELECT count(*) AS n FROM ref))""",
)
def drift_empty_window(spark: SparkSession, sf: str) -> DataFrame:
    """A window without rows keeps every column."""
    ref, cur = sides(spark, sf)
    return D.drift_scores(ref, cur.where("l_orderkey < 0"), B.LINES).select("ordinal", "column", "score")


@register(
    "drift_scores",
    f"""WITH {SIDES_SQL}, {psi_sql()}, {tv_sql()}, {TV},
        a AS (SELECT "column", 'psi' AS kind, score FROM psi UNION ALL SELECT "column", 'total_variation', score FROM tv)
        SELECT {ORD} AS ordinal, "column", kind, {q6('score')} AS score, score >= 0.2::DOUBLE AS drifted FROM a""",
)
def drift_scores(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = sides(spark, sf)
    return D.drift_scores(ref, cur, B.LINES).select("ordinal", "column", "kind", r6("score"), "drifted")


@register(
    "drift_report",
    f"""WITH {SIDES_SQL}, {psi_sql()}, {tv_sql()}, {TV},
        a AS (SELECT {ORD} AS o, "column", score FROM (SELECT * FROM psi UNION ALL SELECT * FROM tv))
        SELECT {q6('avg((score >= 0.2::DOUBLE)::INT)')} AS psi_share, count(*) AS n_columns,
          coalesce(string_agg(CASE WHEN score >= 0.2::DOUBLE THEN "column" END, ',' ORDER BY o), '') AS drifted_features FROM a""",
)
def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = sides(spark, sf)
    out = D.drift_report(ref, cur, B.LINES)
    return out.select(r6("psi_share"), "n_columns", F.concat_ws(",", "drifted_features").alias("drifted_features"))


SECOND = f"""{w1_sql()}, {_js_shares()}, {js_sql()},
sec AS (SELECT "column", 'wasserstein' AS kind, score FROM w1 UNION ALL SELECT "column", 'jensen_shannon', score FROM js)"""


@register(
    "drift_second",
    f"""WITH {SIDES_SQL}, {SECOND} SELECT "column", kind, {q6('score')} AS score, score >= 0.1::DOUBLE AS drifted FROM sec""",
)
def drift_second(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = sides(spark, sf)
    return D.drift_second(ref, cur, B.LINES).select("column", "kind", r6("score"), "drifted")


@register(
    "combined_share",
    f"""WITH {SIDES_SQL}, {psi_sql()}, {tv_sql()}, {TV}, {SECOND},
        f AS (SELECT avg((score >= 0.2::DOUBLE)::INT) AS psi_share FROM (SELECT * FROM psi UNION ALL SELECT * FROM tv)),
        s AS (SELECT avg((score >= 0.1::DOUBLE)::INT) AS second_share FROM sec)
        SELECT {q6('psi_share')} AS psi_share, {q6('second_share')} AS second_share,
          {q6('greatest(psi_share, second_share)')} AS drift_share, 'second+psi' AS method FROM f, s""",
)
def combined_share(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = sides(spark, sf)
    known = D.reference_profile(ref, B.LINES, keep=D.written(spark))
    other = D.share_of_drifted(D.drift_second(known, cur, B.LINES), name="second_share")
    out = D.combined_share(D.drift_report(known, cur, B.LINES), other)
    return out.select(r6("psi_share"), r6("second_share"), r6("drift_share"), "method")


@register("shift_features", f"WITH {SIDES_SQL} SELECT l_orderkey, l_linenumber, l_quantity, {q6('l_extendedprice')} AS l_extendedprice FROM cur")
def shift_features(spark: SparkSession, sf: str) -> DataFrame:
    return sides(spark, sf)[1].select("l_orderkey", "l_linenumber", "l_quantity", r6("l_extendedprice"))


def flip_sql(rate: str, seed: int) -> str:
    text = "concat_ws('|', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR, '%d')" % seed
    return f"""CASE WHEN ('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE < {rate}::DOUBLE
        THEN CASE outcome WHEN 'Yes' THEN 'No' WHEN 'No' THEN 'Yes' END ELSE outcome END"""


@register(
    "flip_labels",
    f"WITH {B.LINES_SQL} SELECT l_orderkey, l_linenumber, {flip_sql('0.45', 7)} AS outcome FROM lines",
)
def flip_labels(spark: SparkSession, sf: str) -> DataFrame:
    out = D.flip_labels(B.lines(spark, sf), "outcome", "Yes", "No", B.LINE_KEY)
    return out.select("l_orderkey", "l_linenumber", "outcome")


# Ship-year windows: 1998 is shifted, labels are inverted in 1999 and 2000.
WINDOWS_SQL = (
    B.LINES_SQL
    + f""",
ref AS (SELECT * FROM lines WHERE year(ship_date) <= 1996),
cur AS (
  SELECT CAST(year(ship_date) AS INTEGER) AS window_id,
         CASE WHEN year(ship_date) = 1998 THEN least(greatest(l_quantity + 5, 1), 50) ELSE l_quantity END AS l_quantity,
         CASE WHEN year(ship_date) = 1998 THEN least(greatest(l_extendedprice * 0.5::DOUBLE + 30000, 0), 200000)
              ELSE l_extendedprice END AS l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus,
         CASE WHEN year(ship_date) IN (1999, 2000) THEN 1 - (outcome = 'Yes')::INT ELSE (outcome = 'Yes')::INT END AS label,
         {B.blend_sql(0.7, 0.3)} AS proba
  FROM lines WHERE outcome IS NOT NULL AND year(ship_date) >= 1997)
"""
)


def windows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = B.lines(spark, sf).withColumn("window_id", F.year("ship_date"))
    ref = rows.where("window_id <= 1996")
    hot = F.col("window_id") == 1998
    base = rows.where("window_id >= 1997 AND outcome IS NOT NULL").withColumn("proba", B.blend(0.7, 0.3))
    clean, shifted = base.where(~hot), D.shift_features(base.where(hot), SHIFT)
    label = (F.col("outcome") == "Yes").cast("int")
    flipped = F.when(F.col("window_id").isin(1999, 2000), 1 - label).otherwise(label)
    return ref, clean.unionByName(shifted).withColumn("label", flipped)


RECORDS_SQL = f"""{psi_sql('window_id')}, {tv_sql('window_id')},
tv AS (SELECT window_id, "column", 0.5 * sum(abs(p - q)) AS score FROM tsh GROUP BY 1, 2),
sc AS (SELECT window_id, {ORD} AS o, "column", score FROM (SELECT * FROM psi UNION ALL SELECT * FROM tv)),
f AS (SELECT window_id, avg((score >= 0.2::DOUBLE)::INT) AS psi_share,
        coalesce(string_agg(CASE WHEN score >= 0.2::DOUBLE THEN "column" END, ',' ORDER BY o), '') AS drifted_features
      FROM sc GROUP BY 1),
{w1_sql('window_id')}, {_js_shares('window_id')}, {js_sql('window_id')},
s AS (SELECT window_id, avg((score >= 0.1::DOUBLE)::INT) AS second_share
      FROM (SELECT * FROM w1 UNION ALL SELECT * FROM js) GROUP BY 1),
rk AS (SELECT window_id, label, rank() OVER (PARTITION BY window_id ORDER BY proba)
         + (count(*) OVER (PARTITION BY window_id, proba) - 1) / 2.0 AS rk, proba FROM cur),
m AS (SELECT window_id, (sum(CASE WHEN label = 1 THEN rk END) - sum(label) * (sum(label) + 1) / 2.0)
          / nullif(sum(label)::DOUBLE * (count(*) - sum(label))::DOUBLE, 0) AS auc,
        coalesce(count(*) FILTER (WHERE label = 1 AND proba >= {THRESHOLD}::DOUBLE) / nullif(sum(label), 0)::DOUBLE, 0) AS recall
      FROM rk GROUP BY 1),
mon AS (SELECT window_id, greatest(psi_share, second_share) AS drift_share, psi_share, second_share, drifted_features,
          recall, auc, CASE WHEN greatest(psi_share, second_share) >= 0.30::DOUBLE THEN 'data_drift'
            WHEN recall < 0.60::DOUBLE THEN 'concept_drift' ELSE 'stable' END AS kind
        FROM f JOIN s USING (window_id) JOIN m USING (window_id))
"""
MONITOR_SQL = f"{WINDOWS_SQL}, {RECORDS_SQL}"


def r4_sql(x: str) -> str:
    return f"floor(({x}) * 1e4 + 0.5) / 1e4"


@register(
    "monitor_windows",
    f"""WITH {MONITOR_SQL} SELECT window_id, {r4_sql('drift_share')} AS drift_share, {r4_sql('psi_share')} AS psi_share,
        {r4_sql('second_share')} AS second_share, drifted_features, {r4_sql('recall')} AS realized_recall,
        {r4_sql('auc')} AS realized_roc_auc, kind FROM mon""",
)
def monitor_windows(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = windows(spark, sf)
    out = D.monitor_windows(ref, cur, B.LINES, ["window_id"], THRESHOLD)
    return out.select(
        "window_id", "drift_share", "psi_share", "second_share",
        F.concat_ws(",", "drifted_features").alias("drifted_features"), "realized_recall", "realized_roc_auc", "kind",
    )


@register(
    "classify_window",
    f"""WITH {MONITOR_SQL} SELECT window_id, kind, kind = 'data_drift' AS data_drift, kind = 'concept_drift' AS concept_drift FROM mon""",
)
def classify_window(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = windows(spark, sf)
    out = D.monitor_windows(ref, cur, B.LINES, ["window_id"], THRESHOLD)
    return out.select("window_id", "kind", "data_drift", "concept_drift")


@register(
    "retrain_decision",
    f"""WITH {MONITOR_SQL}, l AS (SELECT *, lag({r4_sql('recall')}) OVER (ORDER BY window_id) AS before FROM mon),
        d AS (SELECT window_id, CASE WHEN {r4_sql('drift_share')} >= 0.30::DOUBLE THEN 'data_drift' END AS a,
          CASE WHEN {r4_sql('recall')} < 0.60::DOUBLE AND before < 0.60::DOUBLE THEN 'concept_drift_two_windows' END AS b FROM l)
        SELECT window_id, concat_ws(',', a, b) AS reasons, a IS NOT NULL OR b IS NOT NULL AS retrain FROM d""",
)
def retrain_decision(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = windows(spark, sf)
    history = D.monitor_windows(ref, cur, B.LINES, ["window_id"], THRESHOLD)
    out = D.retrain_decision(history, "window_id")
    return out.select("window_id", F.concat_ws(",", "reasons").alias("reasons"), "retrain")


# Samples of the test part: a reference and four windows, the second shifted, the last two with swapped labels.
KEY_SQL = "l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR"


def _sample_sql(seed: int) -> str:
    return f"""(SELECT * FROM exam ORDER BY ('0x' || substr(md5(concat_ws('|', {KEY_SQL}, '{seed}')), 1, 8))::BIGINT,
    l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 4000)"""


def _window_sql(name: str, seed: int, outcome: str = "outcome", quantity: str = "l_quantity", price: str = "l_extendedprice") -> str:
    return f"""SELECT '{name}' AS window_id, {quantity} AS l_quantity, {price} AS l_extendedprice, l_discount, l_tax, l_returnflag,
    l_linestatus, ({outcome} = 'Yes')::INT AS label, proba FROM {_sample_sql(seed)}"""


DEMO_SQL = f"""{B.LINES_SQL},
lab AS (SELECT *, {B.blend_sql(0.7, 0.3)} AS proba FROM lines WHERE outcome IS NOT NULL),
lix AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT ship_date AS day FROM lab)),
lcut AS (SELECT least(greatest(floor(n * (0.70::DOUBLE + 0.15::DOUBLE))::INT, greatest(floor(n * 0.70::DOUBLE)::INT, 1) + 1), n - 1) AS vc
         FROM lix LIMIT 1),
exam AS (SELECT * FROM lab WHERE ship_date > (SELECT day FROM lix, lcut WHERE i = vc - 1)),
ref AS (SELECT * FROM {_sample_sql(1)}),
cur AS (
  {_window_sql('clean', 2)}
  UNION ALL {_window_sql('data_drift', 3, quantity='least(greatest(l_quantity + 5, 1), 50)',
                         price='least(greatest(l_extendedprice * 0.5::DOUBLE + 30000, 0), 200000)')}
  UNION ALL {_window_sql('concept_1', 4, flip_sql('0.45', 11))}
  UNION ALL {_window_sql('concept_2', 5, flip_sql('0.45', 12))}),
{RECORDS_SQL},
seq AS (SELECT *, CASE window_id WHEN 'clean' THEN 1 WHEN 'data_drift' THEN 2 WHEN 'concept_1' THEN 3 ELSE 4 END AS window_seq FROM mon),
bef AS (SELECT *, lag({r4_sql('recall')}) OVER (ORDER BY window_seq) AS before FROM seq),
dec AS (SELECT *, CASE WHEN {r4_sql('drift_share')} >= 0.30::DOUBLE THEN 'data_drift' END AS a,
          CASE WHEN {r4_sql('recall')} < 0.60::DOUBLE AND before < 0.60::DOUBLE THEN 'concept_drift_two_windows' END AS b FROM bef)
"""


def exercise(spark: SparkSession, sf: str) -> DataFrame:
    rows = split.labeled(B.lines(spark, sf), "outcome").withColumn("proba", B.blend(0.7, 0.3))
    rows = split.take(rows, "ship_date", split.find_cuts(rows, "ship_date"), "test")
    return run.monitor_exercise(rows, B.LINES, SHIFT, lambda df: df, THRESHOLD)


@register(
    "monitor_demo",
    f"""WITH {DEMO_SQL} SELECT window_id, window_seq, {r4_sql('drift_share')} AS drift_share, {r4_sql('recall')} AS realized_recall,
        kind, concat_ws(',', a, b) AS reasons, a IS NOT NULL OR b IS NOT NULL AS retrain FROM dec""",
)
def monitor_demo(spark: SparkSession, sf: str) -> DataFrame:
    """Clean, shifted and two relabelled windows sampled from the test part."""
    told = exercise(spark, sf)
    return told.select("window_id", "window_seq", "drift_share", "realized_recall", "kind", F.concat_ws(",", "reasons").alias("reasons"), "retrain")


@register(
    "retrain_cycle",
    f"""WITH {DEMO_SQL}, t AS (SELECT window_id, a IS NOT NULL OR b IS NOT NULL AS fired FROM dec WHERE window_id IN ('data_drift', 'concept_2'))
        SELECT window_id, fired, (SELECT bool_and(fired) FROM t) AS starts FROM t""",
)
def retrain_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Both triggers of the exercise, and whether they start a retraining."""
    return run.cycle_triggers(exercise(spark, sf))
