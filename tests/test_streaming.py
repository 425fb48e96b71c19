import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from lakekit.operators.compare import assert_same
from lakekit.operators.snapshots import SnapshotTable
from lakekit.operators.tables import matched_update, not_matched_insert
from lakekit.streaming.evolution import JsonStream, SchemaRegistry
from lakekit.streaming.runs import append_to, batches_with_data, file_stream, rows_read, run_to_end, upsert_table

SCHEMA = "id BIGINT, ts TIMESTAMP, k STRING"


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(20).selectExpr("id", "timestamp_seconds(id * 60) AS ts", "CAST(id % 3 AS STRING) AS k").repartition(4).write.parquet(path)
    return path


def test_unsupported_operations_are_rejected(spark, folder, tmp_path):
    s = file_stream(spark, folder, SCHEMA)
    count = 0

    def start(df, mode):
        nonlocal count
        count += 1
        return run_to_end(df.writeStream.format("noop").outputMode(mode).option("checkpointLocation", str(tmp_path / f"c{count}")))

    for df, mode in (
        (s.orderBy("id"), "append"),
        (s.groupBy("k").count(), "append"),
        (s.limit(5), "update"),
        (s, "complete"),
    ):
        with pytest.raises(AnalysisException, match="(?i)stream|output mode"):
            start(df, mode)
    with pytest.raises(AnalysisException, match="(?i)stream"):
        s.count()


def test_progress_and_rerun(spark, folder, tmp_path):
    s = file_stream(spark, folder, SCHEMA, maxFilesPerTrigger=1)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    first = append_to(s, out, check)
    assert (rows_read(first), batches_with_data(first)) == (20, 4)
    assert rows_read(append_to(s, out, check)) == 0
    assert spark.read.parquet(out).count() == 20


def test_stream_equals_batch_whatever_the_file_order(spark, folder, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    s = file_stream(spark, folder, SCHEMA, maxFilesPerTrigger=1)
    upsert_table(
        s, table, str(tmp_path / "c"), ["k"], [matched_update({"n": "t.n + s.n"}), not_matched_insert("*")],
        lambda b: b.groupBy("k").agg(F.count("*").alias("n")),
    )
    assert_same(table.read(), spark.read.parquet(folder).groupBy("k").agg(F.count("*").alias("n")))
    assert table.version() == 3


def write(path, *records):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join(map(json.dumps, records)))


def stream(spark, tmp_path, mode, **options):
    base = tmp_path / mode
    table = SnapshotTable(spark, str(base / "table"))
    return JsonStream(spark, str(tmp_path / "in"), table, str(base / "check"), SchemaRegistry(spark, str(base / "schemas")), mode=mode, **options)


def test_add_new_columns_stops_once(spark, tmp_path, rows):
    write(tmp_path / "in" / "1.json", {"id": 1})
    s = stream(spark, tmp_path, "addNewColumns")
    s.run()
    write(tmp_path / "in" / "2.json", {"id": 2, "coupon": "X"})
    with pytest.raises(StreamingQueryException, match="SchemaChanged"):
        s.run()
    assert s.table.read().count() == 1, "nothing of the failed batch is written"
    s.run()
    assert rows(s.table.read(), "id", "coupon") == [(1, None), (2, "X")]
    assert s.registry.current()[0] == 1


def test_fail_mode_keeps_failing(spark, tmp_path):
    write(tmp_path / "in" / "1.json", {"id": 1})
    s = stream(spark, tmp_path, "failOnNewColumns")
    s.run()
    write(tmp_path / "in" / "2.json", {"id": 2, "coupon": "X"})
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="SchemaChanged"):
            s.run()
    assert s.registry.current()[0] == 0


def test_rescue_none_and_text_columns(spark, tmp_path, rows):
    write(tmp_path / "in" / "1.json", {"id": 1, "amount": 1.5})
    write(tmp_path / "in" / "2.json", {"id": 2, "amount": "12.50 EUR", "more": 1})
    s = stream(spark, tmp_path, "rescue", hints="amount DOUBLE")
    s.run()
    got = {r["id"]: r for r in s.table.read().collect()}
    assert got[1]["_rescued_data"] is None and got[2]["amount"] is None
    assert json.loads(got[2]["_rescued_data"])["amount"] == "12.50 EUR"
    text = stream(spark, tmp_path, "none", column_types=False)
    text.run()
    assert dict(text.table.read().dtypes)["id"] == "string"


def test_widening(spark, tmp_path):
    write(tmp_path / "in" / "1.json", {"n": 1})
    s = stream(spark, tmp_path, "addNewColumns", hints=None, widen=True)
    s.run()
    write(tmp_path / "in" / "2.json", {"n": 2.5})
    with pytest.raises(StreamingQueryException, match="SchemaChanged"):
        s.run()
    assert s.registry.current()[1].simpleString() == "struct<n:double>"


def test_batches_are_known_by_their_query(spark, tmp_path):
    """A new checkpoint's batches count although their numbers were seen; a restart adds nothing; two streams share a table."""
    from lakekit.operators.tables import matched_update, not_matched_insert
    from lakekit.streaming.runs import file_stream, upsert_table

    table = SnapshotTable(spark, str(tmp_path / "t"))
    clauses = [matched_update({"n": "t.n + s.n"}), not_matched_insert("*")]
    for folder in ("a", "b"):
        spark.range(0, 10).selectExpr("id", "1 AS n").write.parquet(str(tmp_path / folder))
        for _ in range(2):
            stream = file_stream(spark, str(tmp_path / folder), "id BIGINT, n INT")
            upsert_table(stream, table, str(tmp_path / f"c-{folder}"), ["id"], clauses)
    assert table.read().agg({"n": "sum"}).first()[0] == 20
