"""Scans, sources and sinks, as round trips through the shared folder, and streaming jobs over the event files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarterline import fixtures as X
from quarterline.catalog.registry import query
from quarterline.catalog.sqlparts import ctes, r
from quarterline.catalog.nested import documents
from quarterline.catalog.slicing import ks_sql, with_p
from quarterline.operators import quality as QU
from quarterline.operators import slices as SL
from quarterline.operators.nested import flatten_facts
from quarterline.session import fresh_folder, materialise, rename, subfolders
from quarterline.sources import reports as RP
from quarterline.sources import tables as T
from quarterline.streaming import drift as SD
from quarterline.streaming import landing as ST


@query("a1_scan", "SELECT * FROM customer")
def scan(spark, folder):
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return T.read_table(spark, f"{folder}/customer.parquet", schema)


@query("a12_pruned_scan", "SELECT o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_totalprice > 400000")
def pruned(spark, folder):
    orders = T.read_table(spark, f"{folder}/orders.parquet")
    recent = orders.where((F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")) & (F.col("o_totalprice") > 400000))
    return recent.select("o_custkey", "o_totalprice", "o_orderdate")


@query("a3_keyed_folders", ctes("latest") + "SELECT firm_id, fiscal_year, fiscal_period, tag, value FROM latest")
def keyed_folders(spark, folder):
    path = fresh_folder(spark, "facts")
    rows = X.latest_facts(spark, folder).select("firm_id", "fiscal_year", "fiscal_period", "tag", "value")
    T.write_partitioned(rows, path, ["firm_id"], ["fiscal_year", "fiscal_period", "tag"])
    return T.read_keyed_folders(spark, path, "firm_id", rows.schema).select("firm_id", "fiscal_year", "fiscal_period", "tag", "value")


@query("a7_json_lines", ctes("scores") + "SELECT o_orderkey, firm_id, score, label, fiscal_year, fiscal_period FROM scores")
def json_lines(spark, folder):
    path = fresh_folder(spark, "scores-json")
    rows = X.scores(spark, folder).select("o_orderkey", "firm_id", "score", "label", "fiscal_year", "fiscal_period")
    T.write_json_lines(rows, path, ["fiscal_year", "fiscal_period"])
    schema = "o_orderkey bigint, firm_id string, score double, label int, fiscal_year int, fiscal_period string"
    return spark.read.schema(schema).json(path)


@query("a9_csv", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def csv(spark, folder):
    path = fresh_folder(spark, "parts") + ".csv"
    T.write_csv(X.table(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path)
    return T.read_by_suffix(spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query("a13_daily_layout", "SELECT CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem")
def daily_layout(spark, folder):
    """Every line in the folder of its day, sorted by order there."""
    path = fresh_folder(spark, "daily")
    lines = X.table(spark, folder, "lineitem").select(F.col("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    T.write_daily(lines, path, "day", ["l_orderkey", "l_linenumber"])
    return spark.read.schema("l_orderkey bigint, l_linenumber int, l_returnflag string, l_extendedprice double, day date").parquet(path).select(*lines.columns)


@query(
    "a14_replace_partitions",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 2000 THEN o_totalprice * 2 ELSE o_totalprice END AS amount, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def replace_partitions(spark, folder):
    path = fresh_folder(spark, "orders")
    rows = X.table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("amount"), F.year("o_orderdate").alias("year"))
    T.write_partitioned(rows, path, ["year"], ["o_orderkey"])
    T.replace_partitions(rows.where("year >= 2000").withColumn("amount", F.col("amount") * 2), path, ["year"])
    return spark.read.schema("o_orderkey bigint, amount double, year int").parquet(path)


@query("a2_replace_table", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def replace_table(spark, folder):
    """Written whole, then replaced by a smaller table."""
    path = fresh_folder(spark, "replaced")
    orders = X.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    T.replace_table(orders, path)
    T.replace_table(orders.where("o_orderstatus = 'F'").drop("o_orderstatus"), path)
    return T.read_table(spark, path)


@query(
    "a4_keyed_files",
    ctes("macro") + "SELECT series_id, date, value, o_orderkey FROM macro",
)
def keyed_files(spark, folder):
    """A file per series, called after it; a file with another name is passed over."""
    home = fresh_folder(spark, "series")
    rows = X.macro(spark, folder)
    T.replace_partitions(rows, home, ["series_id"])
    for name in subfolders(spark, home):
        rename(spark, f"{home}/{name}", f"{home}/{name}.parquet")
    T.replace_table(rows.drop("series_id"), f"{home}/series.parquet")
    return T.read_keyed_files(spark, home, "series_id").select("series_id", "date", "value", "o_orderkey")


def _stored_orders(spark, folder):
    home = fresh_folder(spark, "orders")
    orders = X.table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return T.store_bucketed(orders, "orders_" + home.rsplit("-", 1)[1], home, ["o_custkey"], ["o_orderdate", "o_orderkey"], buckets=16)


@query("a6_table_scan", "SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders")
def table_scan(spark, folder):
    """A stored catalog table, read by its name."""
    return _stored_orders(spark, folder)


@query(
    "a6_bucketed_window",
    "SELECT o_orderkey, o_custkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders",
)
def bucketed_window(spark, folder):
    """A window per customer over the bucketed table, which needs no exchange."""
    previous = F.lag("o_totalprice").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return _stored_orders(spark, folder).select("o_orderkey", "o_custkey", previous.alias("previous"))


_ONE_FIRM = "0000000001"


@query("a12_firm_scan", ctes("latest") + f"SELECT fiscal_year, fiscal_period, tag, value FROM latest WHERE firm_id = '{_ONE_FIRM}'")
def firm_scan(spark, folder):
    """One firm's facts from a table sorted by firm."""
    path = fresh_folder(spark, "by-firm")
    T.replace_table(X.latest_facts(spark, folder).repartitionByRange("firm_id").sortWithinPartitions("firm_id"), path)
    return T.read_firm(spark, path, _ONE_FIRM, ["fiscal_year", "fiscal_period", "tag", "value"])


@query("a3_hash_buckets", ctes("latest") + "SELECT firm_id, fiscal_year, fiscal_period, tag, value FROM latest")
def hash_buckets(spark, folder):
    """Facts in a folder per hash bucket of the firm, as many for any number of firms."""
    path = fresh_folder(spark, "buckets")
    T.write_hash_buckets(X.latest_facts(spark, folder).select("firm_id", "fiscal_year", "fiscal_period", "tag", "value"), path, "firm_id", 64)
    return T.read_hash_buckets(spark, path, "firm_id string, fiscal_year int, fiscal_period string, tag string, value double", "firm_id", 64)


@query("a15_read_or_empty", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def read_or_empty(spark, folder):
    """What is stored already (nothing yet) and what has come in since."""
    schema = "c_custkey bigint, c_name string, c_acctbal double"
    earlier = T.read_or_empty(spark, fresh_folder(spark, "customers"), schema)
    return earlier.unionByName(T.read_or_empty(spark, f"{folder}/customer.parquet", schema))


@query("a17_companies", "SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS firm_id, c_mktsegment AS ticker, c_name AS name FROM customer")
def companies(spark, folder):
    """The first dictionary that exists, its ids as text of ten digits."""
    path = fresh_folder(spark, "companies")
    T.write_csv(X.table(spark, folder, "customer").select(F.col("c_custkey").alias("cik"), F.col("c_mktsegment").alias("ticker"), F.col("c_name").alias("name")), path)
    return T.read_companies(spark, [fresh_folder(spark, "companies"), path])


@query("a8_documents", ctes("facts") + "SELECT firm_id, count(*) AS facts FROM facts WHERE NOT (fiscal_period <> 'Q4' AND l_linenumber = 7) GROUP BY firm_id")
def raw_documents(spark, folder):
    """Raw documents land in hash buckets of their firm, with its id in the file, and are flattened from there."""
    path = fresh_folder(spark, "documents")
    T.write_hash_buckets(documents(spark, folder, 64), path, "firm_id", 64, kind="json", dealt=True)
    landed = T.read_hash_buckets(spark, path, "firm_id string, doc string", "firm_id", 64, kind="json")
    return flatten_facts(landed).groupBy("firm_id").agg(F.count(F.lit(1)).alias("facts"))


@query("a10_records", ctes("scores") + "SELECT segment, count(*) AS rows, max(score) AS top FROM scores GROUP BY segment")
def records(spark, folder):
    path = fresh_folder(spark, "records")
    T.write_records(X.scores(spark, folder).groupBy("segment").agg(F.count(F.lit(1)).alias("rows"), F.max("score").alias("top")), path)
    return spark.read.schema("segment string, rows bigint, top double").json(path)


@query("a11_export_table", "SELECT s_suppkey, s_acctbal FROM supplier")
def export_table(spark, folder):
    """A catalog table is replaced and exported; the export is what comes back."""
    home = fresh_folder(spark, "export")
    name = "exported_" + home.rsplit("-", 1)[1]
    T.export_table(X.table(spark, folder, "supplier").select("s_suppkey", "s_acctbal"), name, f"{home}/out", f"{home}/table")
    spark.sql(f"DROP TABLE {name}")
    return T.read_table(spark, f"{home}/out")


@query("a16_report", ctes("scores") + "SELECT 'v2' AS model_version, count(*) AS row_count, 1 AS prediction_horizon FROM scores")
def report(spark, folder):
    path = fresh_folder(spark, "report")
    RP.write_report(RP.manifest(X.scores(spark, folder), model_version="v2", prediction_horizon=1), path)
    return RP.read_report(spark, path, "model_version string, row_count bigint, prediction_horizon int")


# What a run of each segment would have told, with faults that depend on its numbers.
_RUN_FACTS = "SELECT segment, count(*) AS n, sum(label) AS hits, max(o_orderkey) AS last FROM scores GROUP BY segment"


def _manifests(spark, folder):
    """A manifest per segment made from its scores."""
    told = X.scores(spark, folder).groupBy("segment").agg(F.count("*").alias("row_count"), F.sum("label").alias("hits"), F.max("o_orderkey").alias("last"))
    n, hits, last = F.col("row_count"), F.col("hits"), F.col("last")
    return told.select(
        "segment",
        "row_count",
        F.concat(F.lit("1"), F.when(n % 2 == 0, ".").otherwise("-"), F.lit("0")).alias("schema_version"),
        F.when(hits % 2 == 0, F.col("segment")).otherwise("").alias("model_name"),
        F.concat(F.when(last % 2 == 0, "v").otherwise("m"), last.cast("string")).alias("model_version"),
        F.when(last % 3 != 0, F.concat(F.lit("run-"), last.cast("string"))).alias("mlflow_run_id"),
        F.lit("2001-12-31T00:00:00").alias("trained_at"),
        F.when(n % 3 == 0, "soon").otherwise("2002-01-01T00:00:00").alias("scored_at"),
        (hits * 2.0 / n).alias("roc_auc"),
        (hits % 3).cast("int").alias("prediction_horizon"),
        F.when(n % 5 != 0, F.array(F.lit("roa"), F.lit("roe"))).otherwise(F.array().cast("array<string>")).alias("features_used"),
        F.concat(F.lit("gs://scores/"), F.lower("segment"), F.when(hits % 5 == 0, ".csv").otherwise(".parquet")).alias("gcs_scores_path"),
        ((last % 7) - 1.0).alias("inference_duration_seconds"),
    )


@query(
    "q10_manifest_rules",
    ctes("scores")
    + f"""SELECT rule, rows FROM (SELECT count(*) FILTER (n % 2 <> 0) AS "schema_version is N.N", count(*) FILTER (hits % 2 <> 0) AS "model_name is not empty",
 count(*) FILTER (last % 2 <> 0) AS "model_version looks like v1", count(*) FILTER (last % 3 = 0) AS "mlflow_run_id is not empty", count(*) FILTER (n % 3 = 0) AS "scored_at is a time",
 count(*) FILTER (hits * 2 > n) AS "roc_auc in [0, 1]", count(*) FILTER (hits % 3 = 0) AS "prediction_horizon at least 1", count(*) FILTER (n % 5 = 0) AS "features_used is not empty",
 count(*) FILTER (hits % 5 = 0) AS "scores path is a gs parquet path", count(*) FILTER (last % 7 = 0) AS "duration is not negative" FROM ({_RUN_FACTS}))
 UNPIVOT (rows FOR rule IN (COLUMNS(*))) WHERE rows > 0""",
)
def manifest_rules(spark, folder):
    """Broken rules of the manifests of all segments, made from their scores."""
    return QU.findings(_manifests(spark, folder), QU.manifest_rules())


_HALVES = "(SELECT 'l_quantity' AS feature, l_quantity AS value, l_quantity < 25 AS first FROM lineitem UNION ALL SELECT 'l_tax', l_tax, l_quantity < 25 FROM lineitem)"


@query(
    "s15_retrain_flag",
    f"""SELECT 'dataset_drift' AS reason, names AS drifted_features, true AS consumed FROM (SELECT count(*) FILTER (p_value <= 0.05) AS drifted, count(*) AS n,
 string_agg(feature, ',' ORDER BY feature) FILTER (p_value <= 0.05) AS names FROM ({with_p(ks_sql(_HALVES))})) WHERE drifted / n >= 0.5""",
)
def retrain_flag(spark, folder):
    """A drifted quantity raises the flag; reading it consumes it."""
    path = fresh_folder(spark, "flag")
    line = X.table(spark, folder, "lineitem")
    small = F.col("l_quantity") < 25
    decision = SL.drift_decision(SL.dataset_drift(line.where(small), line.where(~small), ["l_quantity", "l_tax"]))
    RP.raise_flag(decision, path)
    first, second = RP.take_flag(spark, path), RP.take_flag(spark, path)
    rows = [(first["reason"], first["drifted_features"], second is None)] if first else []
    return spark.createDataFrame(rows, "reason string, drifted_features string, consumed boolean")


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark, folder):
    """The event files as a stream; event time as an instant, which watermarks need."""
    return ST.file_stream(spark, folder, "events.parquet", EVENTS).withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "x1_land_latest",
    "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def land_latest(spark, folder):
    home = fresh_folder(spark, "landing")
    unique = ST.without_repeats(events(spark, folder), "ts", "31 days", ["event_id"])
    keys = ["user_id", "event_type"]
    ST.land_latest(unique, f"{home}/table", f"{home}/state", keys, "ts", ["event_id"])
    return ST.landed(spark, f"{home}/table", unique.schema).select(*keys, "event_id", "value")


_TWO_FETCHES = (
    "two AS (SELECT firm_id, fiscal_year, fiscal_period, tag, CASE WHEN newest <= 8 THEN value * 2 ELSE value END AS value FROM ("
    "SELECT *, dense_rank() OVER (PARTITION BY firm_id ORDER BY fiscal_year DESC, fiscal_period DESC) AS newest FROM latest WHERE fiscal_year < 2000)"
    " UNION ALL SELECT firm_id, fiscal_year, fiscal_period, tag, value * 2 FROM latest WHERE fiscal_year >= 2000),"
    " ranked AS (SELECT *, dense_rank() OVER (PARTITION BY firm_id ORDER BY fiscal_year DESC, fiscal_period DESC) AS newest FROM two)"
)


@query(
    "x2_refresh_stream",
    ctes("latest", extra=_TWO_FETCHES)
    + """SELECT firm_id, fiscal_year, fiscal_period, tag, value FROM ranked
 WHERE newest > 8 OR firm_id NOT IN (SELECT firm_id FROM latest WHERE fiscal_year < 2001)
 UNION ALL SELECT firm_id, fiscal_year, fiscal_period, tag, value * 3 FROM latest l WHERE fiscal_year < 2001 AND NOT EXISTS (
  SELECT 1 FROM ranked k WHERE newest > 8 AND k.firm_id = l.firm_id AND k.fiscal_year = l.fiscal_year AND k.fiscal_period = l.fiscal_period)""",
)
def refresh_stream(spark, folder):
    """Facts up to 1999 land first, then a full fetch with doubled values, then a short one, up to 2000, with tripled values."""
    home = fresh_folder(spark, "refresh")
    rows = materialise(X.latest_facts(spark, folder).select("firm_id", "fiscal_year", "fiscal_period", "tag", "value"))
    schema = rows.schema
    keys = ["firm_id", "fiscal_year", "fiscal_period", "tag"]
    for part in (rows.where("fiscal_year < 2000"), rows.withColumn("value", F.col("value") * 2), rows.where("fiscal_year < 2001").withColumn("value", F.col("value") * 3)):
        part.write.mode("append").parquet(f"{home}/inbox")
        stream = spark.readStream.schema(schema).parquet(f"{home}/inbox")
        ST.refresh_stream(stream, f"{home}/table", f"{home}/state", ["firm_id"], ["fiscal_year", "fiscal_period"], keys, ["value"], buckets=8)
    return ST.refreshed(spark, f"{home}/table", schema)


@query(
    "x3_downsample",
    """SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, event_type, arg_max(value, (ts, value)) AS value, count(*) AS rows FROM events
 GROUP BY 1, 2 HAVING time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def downsample(spark, folder):
    home = fresh_folder(spark, "downsample")
    stream = ST.downsample(events(spark, folder), "ts", "value", ["event_type"], "6 hours", "1 hour")
    rows = ST.append_to(stream, f"{home}/table", f"{home}/state")
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "value", "rows")


_BIN = "CAST(least(floor((least(greatest(value, 0.0), 100.0) - 0.0) / (100.0 - 0.0) * 10), 9) AS INTEGER)"


@query(
    "x4_window_drift",
    f"""WITH ref AS (SELECT {_BIN} AS bin, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1),
 closed AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, {_BIN} AS bin FROM events WHERE time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)),
 grid AS (SELECT window_start, bin, count(c) AS n FROM (SELECT DISTINCT window_start FROM closed) CROSS JOIN (SELECT CAST(unnest(range(10)) AS INTEGER) AS bin) LEFT JOIN (SELECT *, 1 AS c FROM closed) USING (window_start, bin) GROUP BY ALL)
 SELECT window_start, CAST(sum(n) AS BIGINT) AS rows, {r('sum((q - p) * ln(q / p))', 6)} AS psi FROM (
  SELECT g.window_start, g.n, (coalesce(ref.n, 0) + 1e-6) / ((SELECT sum(n) FROM ref) + 1e-5) AS p, (g.n + 1e-6) / (sum(g.n) OVER (PARTITION BY g.window_start) + 1e-5) AS q
  FROM grid g LEFT JOIN ref USING (bin)) GROUP BY window_start""",
)
def window_drift(spark, folder):
    home = fresh_folder(spark, "drift")
    clicks = X.table(spark, folder, "events").where("event_type = 'click'")
    reference = SD.reference_bins(clicks, "value", 0.0, 100.0)
    stream = SD.window_bins(events(spark, folder), "ts", "value", 0.0, 100.0, "1 day", "1 hour")
    counts = ST.append_to(stream, f"{home}/table", f"{home}/state")
    psi = SD.window_psi(counts, reference)
    return psi.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "rows", F.round("psi", 6).alias("psi"))


