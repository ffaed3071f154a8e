import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewheel import session
from tidewheel.sources import files, messages


def write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_reviews_have_a_fixed_schema(spark, tmp_path):
    path = write_lines(
        tmp_path / "reviews.jsonl",
        [
            json.dumps({"user_id": "u", "parent_asin": "i", "rating": 4.0, "timestamp": 1_600_000_000_000, "text": "x"}),
            json.dumps({"user_id": "v", "rating": 3}),
        ],
    )
    df = files.read_reviews(spark, path)
    assert df.schema == files.REVIEW_SCHEMA
    assert sorted(tuple(r) for r in df.collect())[0] == ("u", "i", 4.0, 1_600_000_000_000)


def test_malformed_metadata_is_skipped_and_order_follows_the_file(spark, tmp_path):
    lines = [json.dumps({"parent_asin": "a", "title": t}) for t in ("first", "second")]
    path = write_lines(tmp_path / "meta.jsonl", [lines[0], "{broken", lines[1], json.dumps({"parent_asin": "b"})])
    df = files.read_item_metadata(spark, path)
    ordered = df.orderBy("record_order").select("parent_asin", "title").collect()
    assert [tuple(r) for r in ordered] == [("a", "first"), ("a", "second"), ("b", None)]


def test_order_holds_across_splits_of_a_file(spark, tmp_path):
    path = write_lines(
        tmp_path / "meta.jsonl", [json.dumps({"parent_asin": "a", "title": f"{n:06d}"}) for n in range(5000)]
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.read_item_metadata(spark, path)
        assert df.rdd.getNumPartitions() > 4
        first = df.groupBy("parent_asin").agg(F.min_by("title", "record_order").alias("t")).first()
        assert first["t"] == "000000"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tables_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(spark.range(5), path)
    files.write_parquet(spark.range(3), path)
    assert files.read_parquet(spark, path).count() == 3


def test_missing_tables_are_empty(spark, tmp_path):
    df = files.read_optional(spark, str(tmp_path / "none"), files.SEGMENT_SCHEMA)
    assert df.count() == 0 and df.schema == files.SEGMENT_SCHEMA
    (tmp_path / "folder").mkdir()
    assert files.read_optional(spark, str(tmp_path / "folder"), files.SEGMENT_SCHEMA).count() == 0


def test_other_errors_are_not_swallowed(spark, tmp_path):
    with pytest.raises(Exception) as error:
        files.read_optional(spark, str(tmp_path), files.SEGMENT_SCHEMA, "nosuchformat")
    assert not isinstance(error.value, AnalysisException) or error.value.getCondition() != "PATH_NOT_FOUND"


def test_topic_options():
    assert messages.kafka_source_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest"
    }
    assert messages.kafka_source_options(max_offsets=10)["maxOffsetsPerTrigger"] == "10"
    assert messages.kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_written_tables_lie_in_the_shared_folder(spark):
    df = session.written(spark.range(4), "t")
    assert all(f.startswith("file://" + spark.conf.get("spark.checkpoint.dir")) for f in df.inputFiles())
    assert df.count() == 4
