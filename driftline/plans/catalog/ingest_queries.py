"""Sources, sinks, coercion, contract and profile queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import columns as X
from driftline.operators import contract, ingest, split
from driftline.plans.catalog import base as B
from driftline.plans.catalog.base import q6, r6, register, table
from driftline.session import scratch_path
from driftline.sources import records, tables
from driftline.spec import TableSpec, not_null

ORDERS = TableSpec(
    name="orders",
    key=("o_orderkey",),
    date="order_date",
    numeric=("o_totalprice",),
    categorical=("o_orderstatus", "o_orderpriority"),
    target="outcome",
    leak=("leak",),
    rules=not_null("order_date"),
)


def order_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Orders, one in seven twice."""
    o = table(spark, sf, "orders")
    return o.unionAll(o.where("o_orderkey % 7 = 0"))


@register(
    "csv_scan",
    """SELECT o_orderkey::VARCHAR AS o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders""",
)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        "o_totalprice",
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("N/A")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.concat(F.lit(" "), "o_orderpriority").alias("o_orderpriority"),
        F.lit(1).alias("leak"),
    )
    raw.write.option("header", True).csv(path)
    return tables.read_table(spark, path, ORDERS)


@register(
    "drop_leaks",
    """SELECT count(*) AS n_rows FROM (SELECT DISTINCT * FROM orders)""",
)
def drop_leaks(spark: SparkSession, sf: str) -> DataFrame:
    # Copies differ only in the leak column, so they collapse once it is gone.
    o = table(spark, sf, "orders")
    leaky = o.withColumn("leak", F.lit(0)).unionAll(o.where("o_orderkey % 7 = 0").withColumn("leak", F.lit(1)))
    clean, _ = tables.drop_leaks(leaky, ["leak"])
    return ingest.dedup_exact(clean).agg(F.count("*").alias("n_rows"))


@register("dedup_exact", "SELECT * FROM orders")
def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.dedup_exact(order_copies(spark, sf))


@register(
    "dedup_count",
    """SELECT count(*) + count(*) FILTER (WHERE o_orderkey % 7 = 0) AS rows_in, count(*) AS rows_out,
       count(*) FILTER (WHERE o_orderkey % 7 = 0) AS rows_dropped FROM orders""",
)
def dedup_count(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.dedup_count(order_copies(spark, sf))


VERSION_SQL = """WITH h AS (
         SELECT o_orderstatus, ('0x' || substr(md5(concat_ws('|', o_orderkey::VARCHAR, o_custkey::VARCHAR,
           o_orderstatus, o_orderpriority, round(o_totalprice * 100)::BIGINT::VARCHAR,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'))), 1, 15))::BIGINT AS h FROM orders)
       SELECT o_orderstatus, count(*) AS n_rows, bit_xor(h) AS hash_xor, sum(h % 1048576)::BIGINT AS hash_sum
       FROM h GROUP BY 1"""
VERSION_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "cents", "day")


def version_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Price in cents and date as text: forms that any SQL engine writes alike."""
    return table(spark, sf, "orders").withColumns(
        {
            "cents": F.round(F.col("o_totalprice") * 100).cast("bigint"),
            "day": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        }
    )


@register("data_version", VERSION_SQL)
def data_version(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.fingerprint(version_rows(spark, sf), VERSION_COLUMNS, ["o_orderstatus"], "md5")


@register("data_manifest", VERSION_SQL)
def data_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as files by status: a manifest of those there first, refreshed when the open ones arrive."""
    rows, folder, kept = version_rows(spark, sf), scratch_path(spark, "orders"), scratch_path(spark, "manifest")
    rows = rows.select(*VERSION_COLUMNS, F.col("o_orderstatus").alias("status"))
    schema = rows.schema

    def read(paths: list[str]) -> DataFrame:
        return spark.read.schema(schema).option("basePath", folder).parquet(*paths)

    def refresh(known: DataFrame | None) -> DataFrame:
        return ingest.refresh_manifest(tables.file_listing(spark, folder), known, read, VERSION_COLUMNS, "md5")

    rows.where("status <> 'O'").write.partitionBy("status").parquet(folder)
    refresh(None).write.parquet(kept)
    rows.where("status = 'O'").write.mode("append").partitionBy("status").parquet(folder)
    status = F.regexp_extract("file", "/status=([^/]*)/", 1).alias("o_orderstatus")
    return ingest.combine_manifest(refresh(spark.read.parquet(kept)), [status])


@register("fingerprint_fast")
def fingerprint_fast(spark: SparkSession, sf: str) -> DataFrame:
    bytes_of = tables.stored_bytes(spark, f"{sf}/lineitem.parquet")
    return ingest.fingerprint(table(spark, sf, "lineitem")).crossJoin(F.broadcast(bytes_of))


@register(
    "request_parse",
    """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
       CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind, CAST(NULL AS DOUBLE) AS absent,
       CAST(ts AS DATE) AS day FROM events""",
)
def request_parse(spark: SparkSession, sf: str) -> DataFrame:
    spec = TableSpec("requests", (), "day", ("k", "absent"), ("kind",), "outcome")
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    full = F.to_json(
        F.struct(F.date_format("ts", "yyyy-MM-dd").alias("day"), k.cast("int").alias("k"), F.col("event_type").alias("kind"))
    )
    part = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.lit("abc").alias("k")))
    body = F.when(F.col("event_id") % 3 != 0, full).otherwise(part)
    out = tables.parse_requests(e.select("event_id", body.alias("body")), "body", spec, ["event_id"])
    return out.select("event_id", "k", "kind", "absent", "day")


@register(
    "stage_sink",
    "SELECT o_orderstatus, count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
)
def stage_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stage")
    o = table(spark, sf, "orders").withColumn("split", F.col("o_orderstatus"))
    tables.write_stage(o, path, ["split"])
    return tables.read_stage(spark, path, "F").groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"))


@register(
    "alert_status",
    f"""WITH {B.FAULTY_SQL}, per AS (
          SELECT l_returnflag AS source, coalesce(year(ship_date), 0) AS run,
                 sum((ship_date IS NULL)::INT + (l_quantity < 1)::INT + (l_discount > 1)::INT
                   + coalesce((l_linestatus NOT IN ('O', 'F'))::INT, 0)
                   + coalesce((outcome NOT IN ('Yes', 'No'))::INT, 0))::BIGINT AS total_failures
          FROM faulty GROUP BY 1, 2),
        last AS (SELECT source, max(run) AS run FROM per GROUP BY 1)
        SELECT per.source, CAST(per.run AS INTEGER) AS run, 'fail' AS status, per.total_failures
        FROM per JOIN last USING (source, run) WHERE total_failures > 0""",
)
def alert_status(spark: SparkSession, sf: str) -> DataFrame:
    df = B.faulty(spark, sf).withColumn("source", F.col("l_returnflag"))
    df = df.withColumn("run", F.coalesce(F.year("ship_date"), F.lit(0)))
    verdict = contract.gate_batches(df, B.LINES, ["source", "run"]).withColumn("message", F.lit("validation failed"))
    path = scratch_path(spark, "alerts")
    records.append_record(records.alert_rows(verdict, ["source", "run"]), path)
    alerts = records.read_records(spark, path)
    return records.open_alerts(alerts, ["source"], "run").select("source", "run", "status", "total_failures")


TEXT_SQL = """
texts AS (
  SELECT o_orderkey,
    CASE o_orderkey % 9 WHEN 0 THEN 'NaN' WHEN 1 THEN 'abc' WHEN 2 THEN '' WHEN 3 THEN ' 7.5 '
      WHEN 4 THEN '1.0d' WHEN 5 THEN '-1e2' ELSE o_custkey::VARCHAR END AS num_text,
    CASE o_orderkey % 6 WHEN 0 THEN '2016-11' WHEN 1 THEN '01/11/2016' WHEN 2 THEN 'x'
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text,
    CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN ' NA ' WHEN 2 THEN 'nan' WHEN 3 THEN 'None' WHEN 4 THEN chr(9) || 'ok '
      ELSE o_orderpriority END AS cat_text
  FROM orders)
"""


def texts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")

    def pick(m: int, values: list[str], other) -> Column:
        out = None
        for i, v in enumerate(values):
            out = F.when(k % m == i, F.lit(v)) if out is None else out.when(k % m == i, F.lit(v))
        return out.otherwise(other)

    return table(spark, sf, "orders").select(
        "o_orderkey",
        pick(9, ["NaN", "abc", "", " 7.5 ", "1.0d", "-1e2"], F.col("o_custkey").cast("string")).alias("num_text"),
        pick(6, ["2016-11", "01/11/2016", "x"], F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_text"),
        pick(8, ["", " NA ", "nan", "None", "\tok "], F.col("o_orderpriority")).alias("cat_text"),
    )


@register(
    "coerce_numeric",
    f"""WITH {TEXT_SQL} SELECT o_orderkey, CASE WHEN num_text IN ('NaN', 'abc', '', '1.0d') THEN NULL
        ELSE CAST(trim(num_text) AS DOUBLE) END AS value FROM texts""",
)
def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select("o_orderkey", X.to_double(F.col("num_text")).alias("value"))


@register(
    "coerce_date",
    f"""WITH {TEXT_SQL} SELECT o_orderkey, CASE WHEN regexp_full_match(date_text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
        THEN CAST(date_text AS DATE) END AS day FROM texts""",
)
def coerce_date(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select("o_orderkey", X.to_date(F.col("date_text")).alias("day"))


@register(
    "norm_text",
    f"""WITH {TEXT_SQL}, t AS (SELECT o_orderkey, trim(cat_text, ' ' || chr(9)) AS v FROM texts)
        SELECT o_orderkey, CASE WHEN v IN ('', 'NA', 'nan', 'None') THEN NULL ELSE v END AS value FROM t""",
)
def norm_text(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf).select("o_orderkey", X.norm_text(F.col("cat_text")).alias("value"))


@register(
    "encode_label",
    f"""WITH {B.LINES_SQL} SELECT CASE outcome WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS label, count(*) AS n_rows
        FROM lines GROUP BY 1""",
)
def encode_label(spark: SparkSession, sf: str) -> DataFrame:
    label = X.encode_label(F.col("outcome"), "Yes", "No")
    return B.lines(spark, sf).groupBy(label.alias("label")).agg(F.count("*").alias("n_rows"))


@register(
    "label_domain",
    f"""WITH {B.FAULTY_SQL} SELECT bool_and(outcome IN ('Yes', 'No')) AS in_domain,
        bool_and(l_returnflag IN ('A', 'N', 'R')) AS flag_in_domain FROM faulty""",
)
def label_domain(spark: SparkSession, sf: str) -> DataFrame:
    return B.faulty(spark, sf).agg(
        F.bool_and(F.col("outcome").isin("Yes", "No")).alias("in_domain"),
        F.bool_and(F.col("l_returnflag").isin("A", "N", "R")).alias("flag_in_domain"),
    )


@register(
    "labeled_rows",
    f"""WITH {B.LINES_SQL} SELECT count(outcome) AS labeled, count(*) - count(outcome) AS dropped_unlabeled FROM lines""",
)
def labeled_rows(spark: SparkSession, sf: str) -> DataFrame:
    return split.label_counts(B.lines(spark, sf), "outcome")


@register(
    "calendar_fields",
    """SELECT o_orderkey, month(o_orderdate)::DOUBLE AS month, dayofyear(o_orderdate)::DOUBLE AS day_of_year FROM orders""",
)
def calendar_fields(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", X.month(d).alias("month"), X.day_of_year(d).alias("day_of_year")
    )


@register(
    "fill_and_flag",
    f"""WITH {B.LINES_SQL} SELECT l_orderkey, l_linenumber, (l_tax IS NULL)::INT::DOUBLE AS tax_missing,
        coalesce(l_linestatus, 'Unknown') AS status_filled FROM lines""",
)
def fill_and_flag(spark: SparkSession, sf: str) -> DataFrame:
    return B.lines(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        X.missing_flag(F.col("l_tax")).alias("tax_missing"),
        X.fill_cat(F.col("l_linestatus")).alias("status_filled"),
    )


@register(
    "align_columns",
    """SELECT o_orderkey, CAST(NULL AS DOUBLE) AS humidity, o_orderstatus, CAST(NULL AS VARCHAR) AS station FROM orders""",
)
def align_columns(spark: SparkSession, sf: str) -> DataFrame:
    return tables.align(
        table(spark, sf, "orders"),
        {"o_orderkey": "bigint", "humidity": "double", "o_orderstatus": "string", "station": "string"},
    )


@register(
    "clip_and_swap",
    f"""WITH {B.LINES_SQL} SELECT l_orderkey, l_linenumber,
        CASE WHEN l_tax IS NOT NULL THEN least(greatest(l_tax, 0.02::DOUBLE), 0.06::DOUBLE) END AS tax_clipped,
        CASE outcome WHEN 'Yes' THEN 'No' WHEN 'No' THEN 'Yes' END AS swapped FROM lines""",
)
def clip_and_swap(spark: SparkSession, sf: str) -> DataFrame:
    return B.lines(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        X.clip(F.col("l_tax"), 0.02, 0.06).alias("tax_clipped"),
        X.swap(F.col("outcome"), "Yes", "No").alias("swapped"),
    )


@register(
    "decide_action",
    f"""WITH {B.SCORED_SQL} SELECT l_linestatus, CASE WHEN proba >= 0.55::DOUBLE THEN 'act' ELSE 'wait' END AS action,
        count(*) AS n_rows FROM scored GROUP BY 1, 2""",
)
def decide_action(spark: SparkSession, sf: str) -> DataFrame:
    act = X.action(X.decide(F.col("proba"), 0.55), "act", "wait")
    return B.scored(spark, sf).groupBy("l_linestatus", act.alias("action")).agg(F.count("*").alias("n_rows"))


@register(
    "contract_violations",
    f"""WITH {B.VIOLATIONS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ordinal, "column", "check", "value" FROM viol""",
)
def contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    return contract.violations(B.faulty(spark, sf), B.LINES)


#: The contract of the lines, rule by rule.
CONTRACT_ROWS = """(VALUES (0, 'ship_date', 'not_nullable', 'not_null', NULL, NULL, false),
          (1, 'l_quantity', 'greater_than_or_equal_to(1)', 'ge', 1.0, NULL, false),
          (2, 'l_quantity', 'less_than_or_equal_to(50)', 'le', 50.0, NULL, false),
          (3, 'l_extendedprice', 'greater_than_or_equal_to(0)', 'ge', 0.0, NULL, false),
          (4, 'l_extendedprice', 'less_than_or_equal_to(200000)', 'le', 200000.0, NULL, false),
          (5, 'l_discount', 'greater_than_or_equal_to(0)', 'ge', 0.0, NULL, false),
          (6, 'l_discount', 'less_than_or_equal_to(1)', 'le', 1.0, NULL, false),
          (7, 'l_tax', 'greater_than_or_equal_to(0)', 'ge', 0.0, NULL, false),
          (8, 'l_tax', 'less_than_or_equal_to(1)', 'le', 1.0, NULL, false),
          (9, 'l_linestatus', 'isin([''O'', ''F''])', 'isin', NULL, 'O|F', false),
          (10, 'outcome', 'isin([''Yes'', ''No''])', 'isin', NULL, 'Yes|No', true))"""


@register(
    "contract_document",
    f"""WITH {B.VIOLATIONS_SQL}, n AS (SELECT count(*) AS n_rows, count(l_quantity) AS q, count(l_extendedprice) AS p,
          count(l_discount) AS d, count(l_tax) AS t, count(l_linestatus) AS s, count(outcome) AS o FROM faulty),
        f AS (SELECT ordinal, count(*) AS failures FROM viol GROUP BY 1)
        SELECT 'lines' AS contract, 'v1' AS version, r.ordinal, r."column", r."check", r.kind, r.bound::DOUBLE AS bound,
          coalesce(r.allowed, '') AS allowed, r.training AS training_only, r."column" = 'outcome' AS is_target,
          CASE r."column" WHEN 'ship_date' THEN n_rows WHEN 'l_quantity' THEN q WHEN 'l_extendedprice' THEN p
            WHEN 'l_discount' THEN d WHEN 'l_tax' THEN t WHEN 'l_linestatus' THEN s ELSE o END AS n_judged,
          coalesce(f.failures, 0) AS failures
        FROM {CONTRACT_ROWS} r(ordinal, "column", "check", kind, bound, allowed, training) CROSS JOIN n LEFT JOIN f USING (ordinal)""",
)
def contract_document(spark: SparkSession, sf: str) -> DataFrame:
    told = contract.contract_document(B.faulty(spark, sf), B.LINES)
    return told.withColumn("allowed", F.concat_ws("|", "allowed"))


@register(
    "serving_violations",
    f"""WITH {B.VIOLATIONS_SQL} SELECT "column", "check", count(*) AS failures FROM viol
        WHERE "column" <> 'outcome' GROUP BY 1, 2""",
)
def serving_violations(spark: SparkSession, sf: str) -> DataFrame:
    found = contract.violations(B.faulty(spark, sf), B.LINES, require_target=False)
    return found.groupBy("column", "check").agg(F.count("*").alias("failures"))


@register(
    "violation_summary",
    f"""WITH {B.VIOLATIONS_SQL}, rules(ordinal, "column", "check") AS (VALUES
          (0, 'ship_date', 'not_nullable'),
          (1, 'l_quantity', 'greater_than_or_equal_to(1)'), (2, 'l_quantity', 'less_than_or_equal_to(50)'),
          (3, 'l_extendedprice', 'greater_than_or_equal_to(0)'), (4, 'l_extendedprice', 'less_than_or_equal_to(200000)'),
          (5, 'l_discount', 'greater_than_or_equal_to(0)'), (6, 'l_discount', 'less_than_or_equal_to(1)'),
          (7, 'l_tax', 'greater_than_or_equal_to(0)'), (8, 'l_tax', 'less_than_or_equal_to(1)'),
          (9, 'l_linestatus', 'isin([''O'', ''F''])'), (10, 'outcome', 'isin([''Yes'', ''No''])'))
        SELECT r.ordinal, r."column", r."check", count(v.l_orderkey) AS failures
        FROM rules r LEFT JOIN viol v ON v.ordinal = r.ordinal GROUP BY 1, 2, 3""",
)
def violation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return contract.violation_summary(B.faulty(spark, sf), B.LINES)


@register(
    "failure_report",
    f"""WITH {B.VIOLATIONS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ordinal, "column", "check", "value",
        (SELECT count(*) FROM viol) AS total_failures FROM viol
        ORDER BY ordinal, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20""",
)
def failure_report(spark: SparkSession, sf: str) -> DataFrame:
    return contract.failure_report(contract.violations(B.faulty(spark, sf), B.LINES), B.LINES.key)


@register(
    "missing_columns",
    """SELECT CAST(NULL AS BIGINT) AS l_orderkey, 'l_tax' AS "column", 'column_in_dataframe' AS "check"
       UNION ALL SELECT CAST(NULL AS BIGINT), 'outcome', 'column_in_dataframe'
       UNION ALL SELECT l_orderkey, 'l_discount', 'less_than_or_equal_to(1)' FROM lineitem WHERE l_orderkey % 101 = 0""",
)
def missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = B.lines(spark, sf).drop("l_tax", "outcome")
    df = contract.inject(df, {"l_discount": (F.col("l_orderkey") % 101 == 0, 1.5)})
    return contract.violations(df, B.LINES).select("l_orderkey", "column", "check")


@register(
    "batch_gate",
    f"""WITH {B.VIOLATIONS_SQL}, n AS (SELECT l_orderkey % 200 AS batch, count(*) AS n_rows FROM faulty GROUP BY 1),
        f AS (SELECT l_orderkey % 200 AS batch, count(*) AS c FROM viol GROUP BY 1)
        SELECT n.batch, n_rows, coalesce(c, 0) AS total_failures, c IS NULL AS accepted FROM n LEFT JOIN f USING (batch)""",
)
def batch_gate(spark: SparkSession, sf: str) -> DataFrame:
    df = B.faulty(spark, sf).withColumn("batch", F.col("l_orderkey") % 200)
    return contract.gate_batches(df, B.LINES, ["batch"])


@register(
    "quarantine_rows",
    f"""WITH {B.VIOLATIONS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        string_agg("column" || ' ' || "check", '; ' ORDER BY ordinal) AS reasons
        FROM viol WHERE "column" <> 'outcome' GROUP BY 1, 2, 3, 4""",
)
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = contract.gate_rows(B.faulty(spark, sf), B.LINES)
    return bad.select(*B.LINE_KEY, F.concat_ws("; ", "reasons").alias("reasons"))


@register(
    "accepted_rows",
    f"""WITH {B.FAULTY_SQL} SELECT l_returnflag, count(*) AS n_rows FROM faulty
        WHERE ship_date IS NOT NULL AND l_quantity >= 1 AND l_discount <= 1
          AND (l_linestatus IS NULL OR l_linestatus IN ('O', 'F')) GROUP BY 1""",
)
def accepted_rows(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = contract.gate_rows(B.faulty(spark, sf), B.LINES)
    return good.groupBy("l_returnflag").agg(F.count("*").alias("n_rows"))


@register(
    "corrupt_rows",
    f"""WITH {B.FAULTY_SQL} SELECT * FROM faulty""",
)
def corrupt_rows(spark: SparkSession, sf: str) -> DataFrame:
    return B.faulty(spark, sf)


def _profile_sql(col: str) -> str:
    return f"""SELECT '{col}' AS "column", {q6(f"avg(({col} IS NULL)::INT)")} AS missing_ratio, min({col}) AS "min",
      max({col}) AS "max", {q6(f"avg({col})")} AS mean, {q6(f"stddev_samp({col})")} AS std FROM lines"""


@register(
    "profile_numeric",
    f"WITH {B.LINES_SQL} " + " UNION ALL ".join(_profile_sql(c) for c in B.LINE_NUMERIC),
)
def profile_numeric(spark: SparkSession, sf: str) -> DataFrame:
    p = ingest.profile_numeric(B.lines(spark, sf), B.LINE_NUMERIC)
    return p.select("column", r6("missing_ratio"), "min", "max", r6("mean"), r6("std"))


@register(
    "profile_nan",
    f"WITH {B.LINES_SQL} " + " UNION ALL ".join(_profile_sql(c) for c in ("l_tax", "l_quantity")),
)
def profile_nan(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of a column whose missing values are NaN is that of one where they are null."""
    rows = B.lines(spark, sf).withColumn("l_tax", F.coalesce("l_tax", F.lit(float("nan"))))
    p = ingest.profile_numeric(rows, ["l_tax", "l_quantity"])
    return p.select("column", r6("missing_ratio"), "min", "max", r6("mean"), r6("std"))


@register(
    "gate_missing_column",
    f"""WITH {B.FAULTY_SQL}
        SELECT l_returnflag, count(*) AS n_rows, (sum((ship_date IS NULL)::INT + (l_discount > 1)::INT
          + coalesce((l_linestatus NOT IN ('O', 'F'))::INT, 0) + coalesce((outcome NOT IN ('Yes', 'No'))::INT, 0)) + 1)::BIGINT
          AS total_failures, false AS accepted FROM faulty GROUP BY 1""",
)
def gate_missing_column(spark: SparkSession, sf: str) -> DataFrame:
    """Batches that lack a declared column: one failure more each, none accepted."""
    return contract.gate_batches(B.faulty(spark, sf).drop("l_quantity"), B.LINES, ["l_returnflag"])


@register(
    "profile_top_values",
    f"""WITH {B.LINES_SQL}, long AS (
          SELECT 'l_returnflag' AS "column", l_returnflag AS "value" FROM lines
          UNION ALL SELECT 'l_linestatus', coalesce(l_linestatus, 'Missing') FROM lines
          UNION ALL SELECT 'outcome', coalesce(outcome, 'Missing') FROM lines
          UNION ALL SELECT 'l_suppkey', l_suppkey::VARCHAR FROM lines),
        c AS (SELECT "column", "value", count(*) AS n FROM long GROUP BY 1, 2),
        k AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, "value") AS rank FROM c)
        SELECT "column", "value", n, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 60""",
)
def profile_top_values(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.profile_top_values(
        B.lines(spark, sf), ["l_returnflag", "l_linestatus", "outcome", "l_suppkey"]
    )


@register("profile_shape", "SELECT count(*) AS n_rows, 6 AS n_columns FROM orders")
def profile_shape(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.profile_shape(table(spark, sf, "orders"))
