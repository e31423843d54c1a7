"""Payloads, CSV, sinks and the stream, with malformed and repeated input."""

import datetime as dt
import json

import pytest

from pyspark.errors import AnalysisException
from tidemark.schemas import schema, struct
from tidemark.session import scratch_path
from tidemark.sources import csvfiles, payloads, sinks, tables
from tidemark.streaming.ingest import ingest_new_files

EVENTS = "track_id string, played_at timestamp, n int"


def day(d, hour=0):
    return dt.datetime(2024, 1, d, hour)


def frame(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, str) or t is None else json.dumps(t),) for t in texts], "payload string")


def test_bad_event_payloads_are_dropped(spark):
    track = {"id": "t", "name": "n", "duration_ms": 5, "artists": [{"name": "x"}, {"name": "y"}], "album": {"name": "b"}}
    good = {"played_at": "2024-01-02T03:04:05.678Z", "track": track}
    found = payloads.parse_events(
        frame(
            spark, good, {**good, "played_at": "2024-01-02T05:04:05+02:00"}, {**good, "played_at": "soon"},
            {"track": track}, {"played_at": good["played_at"]}, {**good, "track": {**track, "id": ""}},
            {**good, "track": {"id": "bare"}}, json.dumps(good)[:-9], "", None, "[]",
        )
    ).collect()
    assert sorted((r.track_id, r.artist_name, r.album_name, r.played_at) for r in found if r.track_id == "t") == [
        ("t", "x", "b", dt.datetime(2024, 1, 2, 3, 4, 5)), ("t", "x", "b", dt.datetime(2024, 1, 2, 3, 4, 5, 678000)),
    ]
    bare = [r for r in found if r.track_id == "bare"]
    assert len(found) == 3 and (bare[0].artist_name, bare[0].album_name) == (None, None)


def test_parsed_events_fit_the_stored_schema(spark):
    fields = {f.name: f.dataType for f in schema("listening_history_bronze").fields}
    for field in payloads.parse_events(frame(spark, {})).schema.fields:
        assert fields[field.name] == field.dataType


def test_features_are_looked_up_and_the_last_wins(spark):
    tracks = frame(spark, {"id": "a", "name": "A", "artists": []}, {"id": "b"}, {"name": "no id"}, "broken")
    features = spark.createDataFrame(
        [(json.dumps({"id": "a", "energy": 0.25}), 1), (json.dumps({"id": "a", "energy": 0.5}), 2), ("null", 3), ("{}", 4)],
        "payload string, load int",
    )
    found = {r.track_id: r.energy for r in payloads.parse_entities(tracks, features, feature_order="load").collect()}
    assert found == {"a": 0.5, "b": None}


def test_flatten_accepts_both_shapes_and_missing_parts(spark):
    bare = {"id": "a", "artists": [{"id": "1", "name": "x"}, {"id": "2", "name": "y"}], "explicit": True}
    found = {r.track_id: r for r in payloads.flatten_tracks(frame(spark, bare, {"track": {**bare, "id": "w"}}, {"id": "none"})).collect()}
    for key in ("a", "w"):
        assert (found[key].artists, found[key].artist_ids, found[key].explicit) == (["x", "y"], ["1", "2"], True)
    assert (found["none"].artists, found["none"].explicit, found["none"].album_name) == ([], False, None)


def test_csv_modes(spark):
    path = scratch_path(spark, "csv")
    lines = ["id,v", "1,2.5", "2,oops", "3", "4,1.5,extra", '"5","0.5"']
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    wanted = struct("id int, v double")
    strict = csvfiles.read_csv_strict(spark, path, wanted)
    assert sorted(tuple(r) for r in strict.collect()) == [(1, 2.5), (5, 0.5)]
    # Which rows are malformed must not depend on the columns that are used.
    assert strict.select("id").count() == 2 and strict.count() == 2
    loose = csvfiles.read_csv_permissive(spark, path, wanted)
    assert tuple(csvfiles.load_counts(loose).first()) == (5, 3, 0, 2)
    assert csvfiles.without_corrupt_column(loose).columns == ["id", "v"]


def test_optional_tables(spark):
    assert tables.read_optional(spark, None) is None
    assert tables.read_optional(spark, scratch_path(spark, "absent")) is None
    with pytest.raises(AnalysisException):
        tables.read_table(spark, scratch_path(spark, "absent"))
    nothing = tables.optional_or_empty(None, spark, schema("listening_history_bronze"))
    assert nothing.count() == 0 and nothing.schema == schema("listening_history_bronze")


def test_append_is_idempotent_and_drops_copies(spark):
    path = scratch_path(spark, "append")
    first = spark.createDataFrame([("a", day(1), 1), ("a", day(1), 1), ("b", day(2), 2)], EVENTS)
    second = spark.createDataFrame([("b", day(2), 9), ("b", day(2, 5), 3), ("a", day(9), 4)], EVENTS)
    for batch in (first, second, second, first):
        sinks.append_new(batch, path)
    stored = sorted((r.track_id, r.played_at, r.n) for r in spark.read.parquet(path).collect())
    assert stored == [("a", day(1), 1), ("a", day(9), 4), ("b", day(2), 2), ("b", day(2, 5), 3)]
    sinks.append_new(first.limit(0), path)
    assert spark.read.parquet(path).count() == 4


def test_upsert_refuses_to_overwrite_what_it_reads(spark):
    df = spark.createDataFrame([("a", 1)], "track_id string, v int")
    path = sinks.upsert_table(df, None, scratch_path(spark, "up"))
    with pytest.raises(ValueError):
        sinks.upsert_table(df, path, path)
    newer = spark.createDataFrame([("a", 2), ("a", 3), ("b", 4)], "track_id string, v int")
    merged = sinks.upsert_table(newer, path, scratch_path(spark, "up"), latest_by=["v"])
    again = sinks.upsert_table(newer, merged, scratch_path(spark, "up"), latest_by=["v"])
    assert sorted(map(tuple, spark.read.parquet(again).collect())) == [("a", 3), ("b", 4)]


def test_generated_rows_are_appended_once(spark):
    path = scratch_path(spark, "made")
    for keys in (["a"], ["a", "b"]):
        sinks.append_generated(spark.createDataFrame([(k, 1) for k in keys], "track_id string, v int"), path)
    assert spark.read.parquet(path).count() == 2


def test_dynamic_overwrite_replaces_only_given_partitions(spark):
    path = scratch_path(spark, "dyn")
    sinks.write_table(spark.createDataFrame([(1, "x"), (2, "x")], "v int, d string"), path, partition_by=["d"])
    sinks.write_table(spark.createDataFrame([(3, "y")], "v int, d string"), path, partition_by=["d"])
    sinks.write_table(spark.createDataFrame([(4, "x")], "v int, d string"), path, partition_by=["d"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(3, "y"), (4, "x")]


def test_appended_null_keys_are_not_stored_again(spark):
    path = scratch_path(spark, "nulls")
    rows = spark.sql(
        "SELECT * FROM VALUES (NULL, TIMESTAMP'2024-01-01 10:00:00', 1), ('a', NULL, 2), ('b', TIMESTAMP'2024-01-02 10:00:00', 3) "
        "AS t(track_id, played_at, v)"
    )
    for _ in range(2):
        sinks.append_new(rows, path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_whole_overwrite_leaves_no_old_partition(spark):
    path = scratch_path(spark, "whole")
    sinks.write_table(spark.createDataFrame([(1, "x"), (2, "y")], "v int, d string"), path, partition_by=["d"], whole=True)
    sinks.write_table(spark.createDataFrame([(3, "y")], "v int, d string"), path, partition_by=["d"], whole=True)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(3, "y")]


def test_tables_can_be_put_in_the_catalog(spark):
    path = sinks.write_table(spark.range(3), scratch_path(spark, "cat"))
    sinks.create_tables(spark, {"tidemark_catalog_test": path})
    try:
        assert spark.sql("SELECT count(*) FROM tidemark_catalog_test").first()[0] == 3
    finally:
        spark.sql("DROP TABLE tidemark_catalog_test")


def test_jdbc_options_bound_the_connections():
    made = sinks.jdbc_options("jdbc:x", "t", driver="d")
    assert (made["numPartitions"], made["batchsize"], made["driver"], made["dbtable"]) == ("16", "10000", "d", "t")
    assert sinks.jdbc_options("jdbc:x", "t", connections=2)["numPartitions"] == "2"


def test_stream_takes_only_new_files_and_survives_replay(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    first = spark.createDataFrame([("a", day(1), 1), ("b", day(1), 2)], EVENTS)
    first.write.mode("append").parquet(source)
    ingest_new_files(spark, source, first.schema, target, scratch_path(spark, "state"))
    checkpoint = scratch_path(spark, "state")
    # A lost checkpoint means every file is seen again.
    for _ in range(2):
        ingest_new_files(spark, source, first.schema, target, checkpoint, files_per_batch=1)
    spark.createDataFrame([("a", day(1), 1), ("c", day(3), 3)], EVENTS).write.mode("append").parquet(source)
    ingest_new_files(spark, source, first.schema, target, checkpoint)
    stored = sorted((r.track_id, r.n) for r in spark.read.parquet(target).collect())
    assert stored == [("a", 1), ("b", 2), ("c", 3)]


def test_a_large_table_is_not_exported_as_one_file(spark):
    path = scratch_path(spark, "one-file")
    with pytest.raises(ValueError, match="more than 10 rows"):
        sinks.export_csv(spark.range(11), path, single_file=True, most=10)
    sinks.export_csv(spark.range(10), path, single_file=True, most=10)
    assert spark.read.option("header", True).csv(path).count() == 10
