import json

import pytest
from pyspark.sql import functions as F

from nestline.sources import readers, schemas, writers
from nestline.sources.scratch import scratch_path
from tests.helpers import rows


def test_lookback_reads_existing_days_only(spark, tmp_path):
    base = tmp_path / "profile"
    for day in ("20200530", "20200601", "20200602", "20200501"):
        folder = base / f"target_date={day}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(json.dumps({"user_id": day, "zip_stats": [{"score": "1"}]}) + "\n")
    df = readers.read_lookback(spark, str(base), "target_date", "20200601", 30, schemas.REAL_PROFILE, "json")
    assert rows(df, "user_id", "target_date") == [("20200530", "20200530"), ("20200601", "20200601")]
    before = readers.read_lookback(spark, str(base), "target_date", "20200601", 5, schemas.REAL_PROFILE,
                                   "json", end_inclusive=False)
    assert rows(before, "user_id") == [("20200530",)]
    assert len(df.inputFiles()) == 2


def test_lookback_keeps_leading_zeros_of_months(spark, tmp_path):
    df = spark.createDataFrame([("u", "c", None, "2020", m, d) for m, d in
                                (("05", "31"), ("06", "01"), ("05", "02"), ("05", "03"))], schemas.PUSH_SENT)
    writers.write_partitioned(df, str(tmp_path / "sent"), ["year", "month", "day"])
    got = readers.read_lookback_ymd(spark, str(tmp_path / "sent"), "20200601", 30, schemas.PUSH_SENT)
    assert rows(got, "month", "day") == [("05", "03"), ("05", "31"), ("06", "01")]


def test_union_years_takes_open_and_last_year(spark):
    df = spark.createDataFrame([(1, "9999"), (2, "2019"), (3, "2018"), (4, "2020")], "k int, year_yyyy string")
    assert rows(readers.union_years(df, 2020), "k") == [(1,), (2,)]
    assert rows(readers.union_years(df, 2020, 2), "k") == [(1,), (2,), (3,)]


def test_writing_a_day_twice_replaces_it_and_leaves_others(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("a", 1), ("b", 2)], "k string, user_group int")
    writers.write_day(one, path, "20200601", ["user_group"])
    writers.write_day(one, path, "20200602", ["user_group"])
    again = writers.materialize(one.withColumn("k", F.upper("k")), path, "20200602", ["user_group"])
    assert rows(again) == [("A", 1), ("B", 2)]
    assert again.schema["user_group"].dataType == one.schema["user_group"].dataType
    assert spark.read.parquet(path).filter("target_date = 20200601").count() == 2


def test_a_second_run_leaves_nothing_of_the_first(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, user_group int")
    writers.write_day(df, path, "20200602", ["user_group"])
    assert rows(writers.materialize(df.filter("k = 'a'"), path, "20200602", ["user_group"])) == [("a", 1)]
    assert rows(writers.materialize(df.limit(0), path, "20200602", ["user_group"])) == []


def test_group_range_and_conform(spark):
    df = spark.createDataFrame([(i,) for i in range(30)], "g int")
    got = readers.group_range(readers.conform(df, {"g": "user_group"}), 10, 10)
    assert [r[0] for r in rows(got)] == list(range(10, 20))


def test_lookups_from_csv(spark, tmp_path):
    paths = []
    for name, keys, value in (("cc", "consumer_ip_city,ldp_city", "con"), ("lc", "consumer_ip_city,ldp_city", "ldp"),
                              ("cz", "consumer_ip_zip,ldp_zip", "con"), ("lz", "consumer_ip_zip,ldp_zip", "ldp")):
        file = tmp_path / f"{name}.csv"
        file.write_text(f"{keys},{value}_pct_web_uls_median,web_uus_sum\na,b,0.5,9\n")
        paths.append(str(file))
    lookups = readers.read_lookups(spark, *paths)
    assert [x.name for x in lookups] == ["con_pct_web_uls_median_city", "ldp_pct_web_uls_median_city",
                                         "con_pct_web_uls_median_zip", "ldp_pct_web_uls_median_zip"]
    assert rows(lookups[2].table, *lookups[2].keys, lookups[2].value) == [("a", "b", "0.5")]


def messages(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("message_id"),
                                 F.concat(F.lit('{"n":'), F.col("id").cast("string"), F.lit("}")).alias("body"))


def test_message_sink_counts_what_it_wrote(spark, tmp_path):
    assert writers.write_messages(messages(spark, 7), str(tmp_path / "m")) == 7
    assert spark.read.text(str(tmp_path / "m")).count() == 7


def test_sender_runs_in_tasks_and_failures_are_not_counted(spark):
    def sender(batch):
        for message_id, body in batch:
            yield json.loads(body)["n"] % 3 != 0
    assert writers.send_messages(messages(spark, 10), sender) == 6
    assert writers.send_messages(messages(spark, 0), sender) == 0


def test_registered_table_sees_new_partitions(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([("a",)], "k string")
    writers.write_day(df, path, "20200601")
    writers.register(spark, "reg_demo", path, df.schema, ["target_date"])
    writers.write_day(df.withColumn("extra", F.lit(1)), path, "20200602")
    writers.register(spark, "reg_demo", path, df.schema, ["target_date"])
    assert rows(spark.table("reg_demo"), "k", "target_date") == [("a", "20200601"), ("a", "20200602")]
    spark.sql("DROP TABLE reg_demo")


def test_a_look_back_opens_its_days_only(spark, tmp_path):
    path = str(tmp_path / "many")
    days = readers.last_days("20200601", 400)
    spark.createDataFrame([(d, 1) for d in days], "target_date string, n int").coalesce(1).write.partitionBy("target_date").parquet(path)
    recent = readers.read_lookback(spark, path, "target_date", "20200601", 5)
    assert len(recent.inputFiles()) == 5
    assert rows(recent.select(F.col("target_date").cast("string"), "n")) == [(d, 1) for d in days[-5:]]
    assert readers.read_lookback(spark, path, "target_date", "20300101", 5).count() == 0
    day = writers.materialize(spark.range(3).toDF("n"), path, "20200601")
    assert all("target_date=20200601" in f for f in day.inputFiles()) and day.count() == 3


def test_scratch_refuses_the_local_disk_of_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    shared = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: None if key == "spark.checkpoint.dir" else shared(self, key, *default))
    with pytest.raises(ValueError):
        scratch_path(spark, "x")
    monkeypatch.setattr(spark.sparkContext, "master", "local[2]")
    assert "/scratch/x-" in scratch_path(spark, "x")


def test_create_table_as_replaces(spark, tmp_path):
    for value in ("x", "y"):
        df = spark.createDataFrame([(value,)], "k string")
        writers.create_table_as(df, "ctas_demo", str(tmp_path / "c"))
    assert rows(spark.table("ctas_demo")) == [("y",)]
    spark.sql("DROP TABLE ctas_demo")


def test_scratch_uses_the_shared_folder_of_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{shared}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_messages_are_written_compressed(spark, tmp_path):
    assert writers.write_messages(messages(spark, 7), str(tmp_path / "m")) == 7
    assert list((tmp_path / "m").glob("part-*.gz")) and not list((tmp_path / "m").glob("part-*.txt"))
    assert spark.read.text(str(tmp_path / "m")).count() == 7
