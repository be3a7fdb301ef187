"""Sinks: text, documents, keyed tables, and the texts sent to topics and databases."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidegauge.sinks import files, jdbc, kafka, tables
from tidegauge.sources.kafka import kafka_lines, kafka_options


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("s_1", 1, 35.8), ("s_2", 2, 15.4), ("s_1", 3, 8.9), ("s_1", 2, 30.8)], "id string, ts long, temperature double"
    )


def test_write_text_overwrites(spark, rows, tmp_path):
    out = str(tmp_path / "t")
    for _ in range(2):
        files.write_text(rows.groupBy("id").count(), out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["(s_1,3)", "(s_2,1)"]


def test_labelled(rows, capsys):
    assert files.labelled(rows, "min temp").first().label == "min temp"
    files.show_labelled(rows.sparkSession.range(50), "min temp")
    assert capsys.readouterr().out.count("min temp> (") == 50


def test_documents_append_and_replace_a_replayed_batch(spark, rows, tmp_path):
    out, mapping = str(tmp_path / "docs"), {"sensor_id": "id", "temperature": "temperature", "ts": "ts"}
    for batch_id in (0, 1, 1):
        files.write_documents(rows, out, mapping, batch_id)
    found = [json.loads(line.value) for line in spark.read.text(f"{out}/*").collect()]
    assert len(found) == 8
    assert {"sensor_id": "s_2", "temperature": "15.4", "ts": "2"} in found
    plain = str(tmp_path / "plain")
    for _ in range(2):
        files.write_documents(rows, plain, mapping)
    assert spark.read.json(plain).count() == 8


def test_upsert_keeps_the_latest_and_may_be_repeated(spark, rows, tmp_path):
    out = str(tmp_path / "table")
    later = spark.createDataFrame([("s_2", 1, 99.0), ("s_3", 1, 7.0), ("s_1", 9, 1.0)], rows.schema)

    def stored():
        return {r.id: r.temperature for r in tables.read_table(spark, out).collect()}

    tables.upsert_table(rows, out, ["id"], ["ts"], ["temperature"], parts=4)
    assert stored() == {"s_1": 8.9, "s_2": 15.4}
    for _ in range(2):
        tables.upsert_table(later, out, ["id"], ["ts"], ["temperature"], parts=4)
        assert stored() == {"s_1": 1.0, "s_2": 15.4, "s_3": 7.0}


def test_upsert_writes_only_touched_parts_and_ignores_unfinished_merges(spark, tmp_path):
    out = str(tmp_path / "table")
    many = spark.range(200).select("id", F.lit(1).alias("ts"), F.col("id").alias("v"))
    change = many.where("id = 5").select("id", F.lit(2).alias("ts"), F.lit(-1).cast("long").alias("v"))

    def parts(n):
        return [d for d in os.listdir(f"{out}/gen={n}") if d.startswith("part=")]

    def stored():
        return {r.id: r.v for r in tables.read_table(spark, out).collect()}

    tables.upsert_table(many, out, ["id"], ["ts"], ["v"], parts=8)
    tables.upsert_table(change, out, ["id"], ["ts"], ["v"], parts=8)
    assert (len(parts(0)), len(parts(1))) == (8, 1)
    assert stored() == {i: -1 if i == 5 else i for i in range(200)}
    os.remove(f"{out}/gen=1/_SUCCESS")  # as if the job had died before its commit
    assert stored() == {i: i for i in range(200)}
    tables.upsert_table(change, out, ["id"], ["ts"], ["v"], parts=8)
    assert stored()[5] == -1 and len(stored()) == 200
    tables.expire(spark, out, keep=1)
    assert (len(parts(0)), len(parts(1))) == (7, 1)
    assert stored()[5] == -1 and len(stored()) == 200


def test_a_table_keeps_its_number_of_parts(spark, tmp_path):
    out = str(tmp_path / "table")
    many = spark.range(20).select("id", F.lit(1).alias("ts"), F.col("id").alias("v"))
    tables.upsert_table(many, out, ["id"], ["ts"], ["v"], parts=4)
    tables.upsert_table(many.where("id = 5").withColumn("ts", F.lit(2)), out, ["id"], ["ts"], ["v"], parts=8)
    assert sorted(r.id for r in tables.read_table(spark, out).collect()) == list(range(20))


def test_merge_statement():
    assert jdbc.merge_sql("readings", "readings_staging", ["sensor"], ["temp"]) == (
        "MERGE INTO readings t USING readings_staging s ON t.sensor = s.sensor "
        "WHEN MATCHED THEN UPDATE SET temp = s.temp "
        "WHEN NOT MATCHED THEN INSERT (sensor, temp) VALUES (s.sensor, s.temp)"
    )


def test_topic_payload_and_options(spark, rows):
    out = kafka.kafka_payload(rows.limit(1), "id", name="SensorReading").first()
    assert (out.key, out.value) == ("s_1", "SensorReading(s_1,1,35.8)")
    assert kafka_lines(spark.createDataFrame([(bytearray(b"a,b"),)], "value binary")).first().value == "a,b"
    assert kafka_options("h:9092", "orderLog", "g") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "orderLog",
        "startingOffsets": "latest",
        "kafka.group.id": "g",
    }


def test_appended_changes_are_merged_on_read_and_by_size(spark, tmp_path):
    out = str(tmp_path / "t")

    def rows(ids, ts, v):
        if isinstance(ids, range):
            return spark.range(ids.start, ids.stop).select("id", F.lit(ts).cast("long").alias("ts"), F.lit(v).alias("v"))
        return spark.createDataFrame([(i, ts, v) for i in ids], "id long, ts long, v string")

    def state():
        return {r.id: (r.ts, r.v) for r in tables.read_table(spark, out).collect()}

    def add(ids, ts, v):
        tables.append_table(rows(ids, ts, v), out, ["id"], ["ts"], ["v"], parts=4)

    want = {}
    for ts, ids, v in [(1, range(40_000), "a"), (2, [3], "b"), (3, [3, 50_000], "c"), (1, [3, 7], "old"), (3, [3, 50_000], "c")]:
        add(ids, ts, v)
        for i in ids:
            want[i] = max(want.get(i, (0, "")), (ts, v), key=lambda x: x[0])
        assert state() == want
    # the first batch became the parts' first generation; the small ones after it are deltas still
    assert tables._complete(spark, out) == [1]
    assert len(tables._complete(spark, out, tables.DELTA)) == 5
    before = {f.name for f in tmp_path.glob("t/gen=*/part=*/*.parquet")}
    add(range(0, 30_000), 9, "new")
    want |= {i: (9, "new") for i in range(30_000)}
    assert state() == want and len(tables._complete(spark, out)) == 2
    assert before <= {f.name for f in tmp_path.glob("t/gen=*/part=*/*.parquet")}
    tables.expire(spark, out, keep=1)
    assert state() == want
    assert not list(tmp_path.glob("t/delta=*/part=*/*.parquet"))
    with pytest.raises(ValueError):
        tables.append_table(rows([1], 1, "x"), out, ["id"], ["v"], ["v"])
    # a delta without its mark does not count
    add([1], 10, "seen")
    (tmp_path / "t" / f"delta={max(tables._complete(spark, out, tables.DELTA))}" / "_SUCCESS").unlink()
    assert state() == want
