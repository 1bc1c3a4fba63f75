from conftest import rows
from pyspark.sql import functions as F

from quarterline.operators import refresh as RF
from quarterline.operators.dedup import keep_latest
from quarterline.session import exists, fresh_folder, scratch, subfolders
from quarterline.sources import generations as GN
from quarterline.streaming import drift as SD
from quarterline.streaming import landing as ST

FACT = "firm_id string, fiscal_year int, fiscal_period string, tag string, value double, filed timestamp"


def facts(spark, value, quarters, filed):
    data = [("f", 2018 + i // 4, f"Q{i % 4 + 1}", "Assets", value) for i in range(quarters)]
    return spark.createDataFrame(data, FACT.rsplit(",", 1)[0]).withColumn("filed", F.lit(filed).cast("timestamp"))


def test_landing_keeps_the_latest_over_batches(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("inbox", "table", "state"))
    keys = ["firm_id", "fiscal_year", "fiscal_period", "tag"]
    whole = None
    for value, filed in ((1.0, "2020-05-01"), (3.0, "2020-07-01"), (2.0, "2020-06-01")):
        part = facts(spark, value, 3, filed)
        part.write.mode("append").parquet(inbox)
        whole = part if whole is None else whole.unionByName(part)
        ST.land_latest(spark.readStream.schema(FACT).parquet(inbox), table, state, keys, "filed", ["value"])
    assert rows(ST.landed(spark, table, FACT)) == rows(keep_latest(whole, keys, "filed", ["value"]))


def test_refresh_stream_equals_the_batch_operator(spark, tmp_path):
    path = str(tmp_path / "table")
    owner, period, keys = ["firm_id"], ["fiscal_year", "fiscal_period"], ["firm_id", "fiscal_year", "fiscal_period", "tag"]
    stored = None
    for batch, (value, quarters) in enumerate(((1.0, 12), (2.0, 13), (3.0, 11))):
        part = facts(spark, value, quarters, "2020-01-01").drop("filed")
        ST.refresh_batch(part, batch, path, owner, period, keys, ["value"])
        ST.refresh_batch(part, batch, path, owner, period, keys, ["value"])  # a replay leaves the same state
        stored = part if stored is None else RF.refresh(stored, part, owner, period, keys, ["value"])
        got = ST.refreshed(spark, path, part.schema)
        assert rows(got.select(*keys, "value")) == rows(stored.select(*keys, "value"))


def test_downsample_closes_windows_behind_the_watermark(spark, tmp_path):
    data = [("2024-01-01 00:10:00", 1.0), ("2024-01-01 00:50:00", 2.0), ("2024-01-01 01:10:00", 3.0), ("2024-01-01 03:30:00", 4.0)]
    spark.createDataFrame(data, "ts string, v double").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, v double").parquet(str(tmp_path / "in")).withColumn("s", F.lit("a"))
    out = ST.append_to(ST.downsample(stream, "ts", "v", ["s"], "1 hour", "1 hour"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert [(r["v"], r["rows"]) for r in out.orderBy("window_start").collect()] == [(2.0, 2), (3.0, 1)]


def test_window_psi_is_zero_for_the_reference_itself(spark):
    counts = spark.createDataFrame([("w", 0, 50), ("w", 1, 50), ("x", 0, 100)], "window_start string, bin int, rows bigint")
    got = {r["window_start"]: r["psi"] for r in SD.window_psi(counts, [50, 50]).collect()}
    assert abs(got["w"]) < 1e-9 and got["x"] > 1


def test_refresh_over_a_shrinking_fetch(spark, tmp_path):
    """A short fetch drops newest periods; a later full one must not count them as stored."""
    kinds = "firm_id string, fiscal_year int, fiscal_period string, tag string, value double"
    quarters = [(2014 + i // 4, f"Q{i % 4 + 1}") for i in range(20)]
    batches = [spark.createDataFrame([("a", y, q, "t", 100.0 * k + i) for i, (y, q) in enumerate(quarters[:n])], kinds) for k, n in enumerate((20, 12, 20))]
    owner, period, keys = ["firm_id"], ["fiscal_year", "fiscal_period"], ["firm_id", "fiscal_year", "fiscal_period", "tag"]
    stored = batches[0]
    for k, rows in enumerate(batches):
        ST.refresh_batch(rows, k, str(tmp_path / "table"), owner, period, keys, ["value"])
        if k:
            stored = RF.refresh(stored, rows, owner, period, keys, ["value"])
    out = ST.refreshed(spark, str(tmp_path / "table"), kinds)
    assert sorted(map(tuple, out.select(*stored.columns).collect())) == sorted(map(tuple, stored.collect()))


KINDS = "k string, v int, w int"


def latest(stored, fetched):
    return keep_latest(stored.unionByName(fetched), ["k"], "v", ["w"])


def test_a_batch_touches_only_its_buckets_however_many_came_before(spark, tmp_path):
    """Files and rows read by a batch stay the same while batches go on; files that nobody can need are gone."""
    path, read = str(tmp_path / "table"), []

    def merge(stored, fetched):
        read.append((len(stored.inputFiles()), stored.count()))
        return latest(stored, fetched)

    whole = spark.createDataFrame([(f"k{i}", 0, i) for i in range(40)], KINDS)
    GN.rewrite(whole, 0, path, ["k"], merge, buckets=8)
    for batch in range(1, 8):
        GN.rewrite(spark.createDataFrame([("k3", batch, 0)], KINDS), batch, path, ["k"], merge, buckets=8)
    assert len(set(read[1:])) == 1 and read[1][0] <= 2 and read[1][1] < 20
    got = {r["k"]: r["v"] for r in GN.read_current(spark, path, KINDS).collect()}
    assert got == {f"k{i}": 7 if i == 3 else 0 for i in range(40)}
    assert len(subfolders(spark, f"{path}/map")) == 2
    assert sum(bool(subfolders(spark, f"{path}/rows/{g}")) for g in subfolders(spark, f"{path}/rows")) == 3


def test_generations_survive_replays_gaps_and_empty_batches(spark, tmp_path):
    path = str(tmp_path / "table")
    assert GN.read_current(spark, path, KINDS).count() == 0 and GN.last_batch(spark, path) == -1
    parts = [[("a", 1, 1), ("b", 1, 1), (None, 1, 1)], [], [("a", 3, 1), ("a", 2, 9)], [("b", 0, 5), (None, 4, 4)]]
    for batch, part in zip((0, 1, 4, 5), parts, strict=True):
        for _ in range(2):
            GN.rewrite(spark.createDataFrame(part, KINDS), batch, path, ["k"], latest, buckets=3)
    assert rows(GN.read_current(spark, path, KINDS)) == [("a", 3, 1), ("b", 1, 1), (None, 4, 4)]
    # A bucket whose rows a merge drops is gone from the map.
    GN.rewrite(spark.createDataFrame([("a", 9, 9)], KINDS), 6, path, ["k"], lambda stored, fetched: fetched.where("false"), buckets=1000)
    assert GN.last_batch(spark, path) == 6


def test_scratch_removes_what_was_made_inside(spark):
    outer = fresh_folder(spark, "outer")
    spark.range(2).write.parquet(outer)
    with scratch(spark):
        inner = fresh_folder(spark, "inner")
        spark.range(3).write.parquet(inner)
        assert exists(spark, inner)
    assert exists(spark, outer) and not exists(spark, inner)
