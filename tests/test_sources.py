import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from quillstream.sources import records
from quillstream.streaming import signals as streams

SCHEMA = T.StructType([T.StructField("page_id", T.StringType()), T.StructField("page_number", T.IntegerType())])


def test_json_tolerant_and_strict(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"page_id": "x", "page_number": 1}\n\nnonsense\n{"page_id": "y", "page_number": "z"}\n[1]\n', encoding="utf-8")
    good, bad = records.read_json_tolerant(spark, str(tmp_path / "a.jsonl"), SCHEMA)
    assert [tuple(r) for r in good.collect()] == [("x", 1)]
    assert sorted(r["problem"] for r in bad.collect()) == ["invalid_json", "not_a_json_object", "not_a_json_object"]
    with pytest.raises((PySparkException, Py4JError)):
        records.read_json_strict(spark, str(tmp_path / "a.jsonl"), SCHEMA).collect()


def test_metadata_round_trip(spark, tmp_path):
    (tmp_path / "m.csv").write_text('﻿ Source_ID ,Title\nA,"One, two"\nB,nan\n', encoding="utf-8")
    read = records.read_metadata_csv(spark, str(tmp_path / "m.csv"))
    assert sorted(map(tuple, read.collect())) == [("A", "One, two"), ("B", None)]
    records.write_metadata_csv(read, str(tmp_path / "out"))
    assert sorted(map(tuple, records.read_metadata_csv(spark, str(tmp_path / "out")).collect())) == [("A", "One, two"), ("B", None)]


def test_record_checks(spark):
    df = spark.createDataFrame([("a", "t"), ("a", "t"), (None, "t"), ("b", " ")], "chunk_id string, text string")
    with pytest.raises(ValueError, match="duplicate key"):
        records.check_records(df)
    fine = df.where("chunk_id = 'a'").limit(1)
    assert records.check_records(fine) is fine


def test_paged_text_patch_and_files(spark, tmp_path):
    pages = spark.createDataFrame([("f", 2, "p2", "two"), ("f", 1, "p1", "one")], "filename string, page_number int, page_id string, text string")
    patch = spark.createDataFrame([("p2", "TWO")], "page_id string, text string")
    whole = records.paged_text(records.patch_pages(pages, patch)).first()["text"]
    assert whole == "--- PAGE 1 ---\none\n\n--- PAGE 2 ---\nTWO\n"
    (tmp_path / "f.txt").write_text(whole, encoding="utf-8")
    assert [tuple(r) for r in records.read_texts(spark, str(tmp_path)).collect()] == [("f.txt", whole)]


def test_snapshots_and_vectors(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.bin").write_bytes(b"1")
    before = spark.createDataFrame(records.read_binary(spark, str(tmp_path / "in"), "*.bin").collect())
    (tmp_path / "in/a.bin").write_bytes(b"2")
    after = records.read_binary(spark, str(tmp_path / "in"), "*.bin")
    assert [r["change"] for r in records.snapshot_changes(before, after).collect()] == ["changed"]
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    records.write_vectors(e, str(tmp_path / "v"), sort="label")
    checked = records.verify_vectors(spark, str(tmp_path / "v"), e).first()
    assert (checked["rows_written"], checked["different"], checked["dimensions"]) == (e.count(), 0, 1)


def test_streamed_windows_and_sessions(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    stream = streams.read_events(spark, folder, delay="1 hour")
    out = streams.run_to_table(streams.windows_stream(stream, "ts", "6 hours", ["event_type"], "value"), str(tmp_path / "w"), str(tmp_path / "wc"))
    batch = spark.read.parquet(f"{folder}/events.parquet")
    assert 0 < sum(r["n"] for r in out.collect()) <= batch.count()  # windows still open are held back
    sessions = streams.sessions_stream(streams.read_events(spark, folder), "ts", "1 hour", ["user_id"])
    assert streams.run_to_table(sessions, str(tmp_path / "s"), str(tmp_path / "sc")).count() > 0


def test_stream_of_a_folder_of_part_files(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/in/events.parquet")
    got = streams.run_to_table(streams.read_events(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/check")
    assert got.count() == events.count() > 0
