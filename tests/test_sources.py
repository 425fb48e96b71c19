import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.functions import clean
from lakekit.functions.log_lines import parse_log_lines
from lakekit.operators.snapshots import SnapshotTable
from lakekit.session import Tables
from lakekit.sources import files as src
from lakekit.sources import ingest
from lakekit.sources.ingest import Loader
from lakekit.sources.rescue import fit


def test_csv_by_name_with_quotes_and_other_headers(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('id,name\n1,"x, y"\n2,z\n')
    (tmp_path / "b.csv").write_text("name,id,extra\nq,3,e\n")
    (tmp_path / "c.csv").write_text("id,name\n4,w\n")
    out = src.read_csv_by_name(spark, str(tmp_path))
    assert rows(out, "id", "name", "extra") == [("1", "x, y", None), ("2", "z", None), ("3", "q", "e"), ("4", "w", None)]


def test_failfast_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2\nx,3\n")
    with pytest.raises(Exception):
        spark.read.schema("a INT, b INT").csv(str(tmp_path), mode="FAILFAST").collect()


def test_rescue(spark, tmp_path):
    lines = [
        {"id": 1, "amount": 5.5, "tags": ["a"]}, {"id": "oops", "amount": "12.50 EUR", "tags": None}, {"ID": 3, "more": {"x": 1}},
    ]
    (tmp_path / "a.json").write_text("\n".join([*map(json.dumps, lines), "not json"]))
    out = src.read_json_rescued(spark, str(tmp_path), StructType.fromDDL("id INT, amount DOUBLE, tags ARRAY<STRING>")).collect()
    assert len(out) == 4, "no row is lost"
    good, bad, odd, broken = out
    assert (good["id"], good["amount"], good["tags"], good["_rescued_data"]) == (1, 5.5, ["a"], None)
    rescued = json.loads(bad["_rescued_data"])
    assert (bad["id"], bad["amount"], rescued["id"], rescued["amount"]) == (None, None, "oops", "12.50 EUR")
    assert rescued["_file_path"].endswith("a.json")
    assert json.loads(odd["_rescued_data"])["ID"] == "3" and json.loads(json.loads(odd["_rescued_data"])["more"]) == {"x": 1}
    assert json.loads(broken["_rescued_data"])["_line"] == "not json"


def test_hints_override_and_add(spark):
    schema = src.apply_hints(StructType.fromDDL("a BIGINT, b STRING"), "a STRING, c DATE")
    assert schema.simpleString() == "struct<a:string,b:string,c:date>"


def test_loader(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"id": 1}\n{"id": 2}\n')
    loader = Loader(SnapshotTable(spark, str(tmp_path / "t")), "json", "id BIGINT")
    assert loader.preview(str(folder), 1).count() == 1 and not loader.table.exists()
    assert loader.load(str(folder))["rows"] == 2
    (folder / "a.json").write_text('{"id": 9}\n')  # changed later, but the name is known
    assert loader.load(str(folder))["files"] == 0
    (folder / "b.json").write_text('{"id": 3}\n')
    result = loader.load(str(folder), lineage=False)
    assert (result["files"], result["skipped"], result["rows"]) == (1, 1, 1)
    # a crash after the ledger was written but before the version: the file is still pending
    (folder / "c.json").write_text('{"id": 4}\n')
    loader._note(loader.pending(str(folder)), "crashed")
    assert loader.pending(str(folder)).count() == 1
    assert loader.load(str(folder))["rows"] == 1
    assert loader.load(str(folder), pattern="a*", force=True)["files"] == 1


def test_loading_in_steps_named_files_and_preview(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "FILES_AT_ONCE", 3)
    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    for i in range(8):
        (folder / f"f{i}.json").write_text(f'{{"id": {i}}}\n')
    (folder / "sub" / "f1.json").write_text('{"id": 100}\n')
    loader = Loader(SnapshotTable(spark, str(tmp_path / "t")), "json", "id BIGINT")
    assert loader.preview(str(folder), 3).count() == 3 and loader.preview(str(folder), 50).count() == 9
    with pytest.raises(FileNotFoundError, match="nowhere.json"):
        loader.load(str(folder), files=["f0.json", "nowhere.json"])
    result = loader.load(str(folder), files=["sub/f1.json", "f0.json"])
    assert (result["files"], result["rows"]) == (2, 2) and {r["id"] for r in loader.table.read().collect()} == {0, 100}
    result = loader.load(str(folder))
    assert (result["files"], result["skipped"], result["rows"], result["version"]) == (7, 2, 7, 3)
    assert sorted(r["id"] for r in loader.table.read().collect()) == [*range(8), 100]
    assert loader.loaded().groupBy("batch").count().count() == 4 and loader.pending(str(folder)).isEmpty()


def test_csv_that_starts_with_blank_lines(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("\n\nid,name\n1,x\n")
    (tmp_path / "b.csv").write_text("\nname,id\ny,2\n")
    assert rows(src.read_csv_by_name(spark, str(tmp_path)), "id", "name") == [("1", "x"), ("2", "y")]


def test_cleaning_expressions(spark):
    df = spark.createDataFrame([(" Credit - Card ", "USD 12.50", "31/07/2026"), (None, "N/A", "2026-07-31")], "m STRING, a STRING, d STRING")
    out = df.select(clean.standardise("m"), clean.parse_amount("a").cast("string"), F.to_date(clean.parse_ts("d", "yyyy-MM-dd", "dd/MM/yyyy")).cast("string")).collect()
    assert [tuple(r) for r in out] == [("credit_card", "12.50", "2026-07-31"), (None, None, "2026-07-31")]
    assert {r["column"]: r["nulls"] for r in clean.null_counts(df).collect()} == {"m": 1, "a": 0, "d": 0}


def test_log_lines(spark):
    df = spark.createDataFrame([("2026-01-01 10:00:00 ERROR checkout user=1 ms=250",), ("garbage",)], "value STRING")
    good, bad = parse_log_lines(df).select("level", "event", "ms").collect()
    assert tuple(good) == ("ERROR", "checkout", 250) and tuple(bad) == (None, None, None)


def test_nested_rescue_loses_nothing(spark, rows):
    """Value and rest together hold every part, whatever the shape."""
    schema = StructType.fromDDL("w INT, `Case` INT, items ARRAY<STRUCT<q: INT>>, m MAP<STRING, DOUBLE>, t STRUCT<deep: STRUCT<x: BOOLEAN>>, s STRING")
    given = ['{"w":1,"Case":2}', '{"w":"wide","case":3}', '"none"', '{"items":[{"q":1},{"q":"x","z":5},null]}', '{"m":{"a":1.5,"b":"no"},"items":{"q":1}}', "[1,2]",
             "null", None, '{"t":{"deep":{"x":true,"y":"é\\n\\"q\\""}},"s":{"a":1},"say \\"hi\\"":null}', '{"t":{"deep":7},"m":[]}']
    df = spark.createDataFrame(list(enumerate(given)), "i INT, j STRING")
    out = {r.i: r.f for r in df.select("i", fit(F.expr("try_parse_json(j)"), schema).alias("f")).collect()}
    value, rest = {i: f["value"] for i, f in out.items()}, {i: f["rest"] and json.loads(f["rest"]) for i, f in out.items()}
    assert rest[0] is None and (value[0]["w"], value[0]["Case"]) == (1, 2)
    assert rest[1] == {"w": "wide", "case": 3} and value[1]["w"] is None
    assert rest[2] == "none" and value[2] is None and rest[5] == [1, 2]
    assert [x and x["q"] for x in value[3]["items"]] == [1, None, None] and rest[3] == {"items": [{"q": 1}, {"q": "x", "z": 5}, None]}
    assert value[4]["m"] == {"a": 1.5, "b": None} and rest[4] == {"m": {"b": "no"}, "items": {"q": 1}}
    assert (value[6], rest[6], value[7], rest[7]) == (None, None, None, None)
    assert value[8]["t"]["deep"]["x"] is True and value[8]["s"] == '{"a":1}'
    assert rest[8] == {"t": {"deep": {"y": 'é\n"q"'}}, 'say "hi"': None}
    assert rest[9] == {"t": {"deep": 7}, "m": []} and value[9]["t"]["deep"] is None


def test_rescue_of_nested_columns_from_lines_and_csv(spark, tmp_path):
    lines = ['{"id":1,"dims":{"w":"wide","h":2}}', '{"id":2,"dims":"none","ID":9}', '{"id":3,"dims":"{broken"}', '{"id":4,"dims":{"w":1,"w":2}}']
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text("\n".join(lines))
    schema = StructType.fromDDL("id INT, dims STRUCT<w: INT, h: INT>, ID INT")  # the last cannot stand beside the first
    out = {r["id"]: r for r in src.read_json_rescued(spark, str(tmp_path / "j"), schema).collect()}
    kept = {i: json.loads(r["_rescued_data"]) for i, r in out.items()}
    assert out[1]["dims"]["h"] == 2 and kept[1]["dims"] == {"w": "wide"}
    assert out[2]["dims"] is None and kept[2]["dims"] == "none" and kept[2]["ID"] == "9"
    assert kept[3]["dims"] == "{broken" and "w" in str(kept[4]["dims"])  # a repeated name is no readable object
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("id,dims,a.b\n5,\"{\"\"w\"\":1,\"\"h\"\":\"\"x\"\"}\",dot\n")
    (row,) = src.read_csv_rescued(spark, str(tmp_path / "c"), StructType.fromDDL("id INT, dims STRUCT<w: INT, h: INT>"), escape='"').collect()
    kept = json.loads(row["_rescued_data"])
    assert row["dims"]["w"] == 1 and kept["a.b"] == "dot" and kept["_file_path"].endswith("a.csv")


def test_describe_equals_plain_aggregates(spark):
    """Columns of several types, with NULLs, ties, an empty one and a name with a dot."""
    df = spark.range(1000).selectExpr("id", "CAST(CASE WHEN id % 3 > 0 THEN (id * id) % 97 END AS INT) AS n", "id / 8 - 60 AS `d.x`", "CAST(NULL AS DOUBLE) AS none",
                                      "CASE WHEN id % 5 > 0 THEN concat('t', id % 7) END AS t", "CAST(id % 11 AS DECIMAL(9,2)) AS c")
    out = {r["column"]: r for r in clean.describe(df, (10, 50)).collect()}
    assert set(out) == set(df.columns)
    for name in ("id", "n", "d.x", "c"):
        x = F.col(f"`{name}`")
        want = df.agg(F.count(x), F.min(x), F.max(x), F.avg(x), F.stddev(x), F.percentile(x, 0.1), F.percentile(x, 0.5), F.count_distinct(x)).first()
        got = out[name]
        assert (got["count"], float(got["min"]), float(got["max"]), got["distinct"]) == (want[0], float(want[1]), float(want[2]), want[7])
        assert [got["mean"], got["stddev"], got["p10"], got["p50"]] == pytest.approx([float(v) for v in want[3:7]])
    assert tuple(out["none"])[1:] == (0, None, None, None, None, None, None, 0)
    assert (out["t"]["count"], out["t"]["min"], out["t"]["max"], out["t"]["mean"], out["t"]["distinct"]) == (800, "t0", "t6", None, 7)


def test_a_table_written_again_is_read_with_its_new_columns(spark, tmp_path):
    for columns in (["1 AS n_nationkey"], ["1 AS n_nationkey", "'x' AS n_name"]):
        spark.range(1).selectExpr(*columns).write.mode("overwrite").parquet(f"{tmp_path}/nation.parquet")
        assert len(Tables(spark, str(tmp_path)).nation.columns) == len(columns)
