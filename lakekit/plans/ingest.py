"""Idempotent loading queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.snapshots import SnapshotTable
from lakekit.plans.registry import plan
from lakekit.session import Tables, work_path
from lakekit.sources.files import list_files
from lakekit.sources.ingest import Loader, rows_per_file
from lakekit.streaming.evolution import JsonStream, SchemaChanged, SchemaRegistry

ORDER = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE"


def _land(t: Tables, folder: str, part: str, remainder: int, *more: str) -> None:
    t.orders.where(f"o_orderkey % 4 = {remainder}").selectExpr("o_orderkey", "o_custkey", "o_totalprice", *more).write.json(f"{folder}/{part}")


def _loader(t: Tables, schema: str | None = ORDER) -> tuple[Loader, str]:
    table = SnapshotTable(t.spark, work_path(t.spark, "loaded"))
    return Loader(table, "json", schema), work_path(t.spark, "landing")


def _land_all(t: Tables, folder: str, *remainders: int) -> None:
    for r in remainders:
        _land(t, folder, "abcd"[r], r)


@plan("""
SELECT 'first' AS run, count(*) FILTER (WHERE o_orderkey % 4 = 0) AS loaded, count(*) FILTER (WHERE o_orderkey % 4 = 0) AS total FROM orders
UNION ALL SELECT 'again', 0, count(*) FILTER (WHERE o_orderkey % 4 = 0) FROM orders
UNION ALL SELECT 'after new files', count(*) FILTER (WHERE o_orderkey % 4 > 0), count(*) FROM orders
""")
def i1_copy_into(t: Tables) -> DataFrame:
    """Load, load again (nothing), land more files, load once more."""
    loader, folder = _loader(t)
    _land_all(t, folder, 0)
    runs = []
    for name in ("first", "again", "after new files"):
        if name == "after new files":
            _land_all(t, folder, 1, 2, 3)
        result = loader.load(folder, "*.json")
        runs.append((name, loader.table.version(), result["rows"]))
    out = None
    for name, version, rows in runs:
        part = loader.table.read(version).agg(F.lit(name).alias("run"), F.lit(rows).cast("bigint").alias("loaded"), F.count(F.lit(1)).alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("SELECT o_orderkey, o_totalprice, CASE o_orderkey % 4 WHEN 2 THEN 'pattern' ELSE 'list' END AS chosen_by FROM orders WHERE o_orderkey % 4 >= 2")
def i2_pattern_and_file_list(t: Tables) -> DataFrame:
    """Only the wanted files are loaded: by name pattern, then by an explicit list of files. The selection is the feature: two of four
    folders, and a file of another kind, stay behind."""
    loader, folder = _loader(t)
    _land_all(t, folder, 0, 1, 2, 3)
    t.orders.select(F.col("o_orderkey").cast("string")).write.text(f"{folder}/c/notes")
    loader.load([f"{folder}/c"], "*.json")
    wanted = list_files(t.spark, f"{folder}/d", "*.json").select(F.concat(F.lit("d/"), F.substring_index("path", "/", -1)).alias("name"))
    loader.load(folder, files=[r["name"] for r in wanted.collect()])
    chosen = F.when(F.col("o_orderkey") % 4 == 2, "pattern").otherwise("list")
    return loader.table.read().select("o_orderkey", "o_totalprice", chosen.alias("chosen_by"))


@plan("SELECT CAST(20 AS BIGINT) AS previewed, false AS written, count(*) AS available FROM orders")
def i3_preview(t: Tables) -> DataFrame:
    loader, folder = _loader(t)
    _land_all(t, folder, 0, 1, 2, 3)
    available = t.spark.read.schema(ORDER).option("recursiveFileLookup", "true").json(folder).agg(F.count(F.lit(1)).alias("n")).scalar()
    return loader.preview(folder, 20, "*.json").agg(
        F.count(F.lit(1)).alias("previewed"), F.lit(loader.table.exists()).alias("written")
    ).withColumn("available", available)


@plan("SELECT o_orderkey, CAST(2 AS BIGINT) AS copies FROM orders")
def i4_force_reload(t: Tables) -> DataFrame:
    loader, folder = _loader(t)
    _land_all(t, folder, 0, 1, 2, 3)
    loader.load(folder, "*.json")
    loader.load(folder, "*.json", force=True)
    return loader.table.read().groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("copies"))


@plan("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 >= 2 THEN 'card' END AS method FROM orders
""")
def i5_merge_schema(t: Tables) -> DataFrame:
    """A new column in later files: older rows get NULL."""
    loader, folder = _loader(t, None)
    _land_all(t, folder, 0, 1)
    loader.load(folder, "*.json")
    for part, r in (("c", 2), ("d", 3)):
        _land(t, folder, part, r, "'card' AS method")
    loader.load(folder, "*.json", merge_schema=True)
    return loader.table.read().select("o_orderkey", "method")


@plan("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN 'card' END AS method, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS customer FROM orders")
def i5_merge_schema_on_read(t: Tables) -> DataFrame:
    """Files of one load with different columns: the reader unites their schemas, files without a column give NULL."""
    loader, folder = Loader(SnapshotTable(t.spark, work_path(t.spark, "loaded")), "parquet", mergeSchema="true"), work_path(t.spark, "landing")
    t.orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_custkey").alias("customer")).write.parquet(f"{folder}/a")
    t.orders.where("o_orderkey % 2 = 1").select(F.lit("card").alias("method"), "o_orderkey").write.parquet(f"{folder}/b")
    loader.load(folder, "*.parquet")
    return loader.table.read().select("o_orderkey", "method", "customer")


@plan("SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS whole, true AS has_file FROM orders")
def i6_transform_while_loading(t: Tables) -> DataFrame:
    loader, folder = _loader(t)
    _land_all(t, folder, 0, 1, 2, 3)
    loader.load(
        folder, "*.json", lineage=True,
        transform=lambda df: df.select("o_orderkey", F.floor("o_totalprice").alias("whole"), "source_file"),
    )
    return loader.table.read().select("o_orderkey", "whole", F.col("source_file").isNotNull().alias("has_file"))


def _event_lines(t: Tables, folder: str, part: str, where: str, *more: str) -> None:
    t.events.where(where).selectExpr("event_id", "user_id", "value AS amount", *more).write.json(f"{folder}/{part}")


@plan("SELECT event_id, user_id, value AS amount FROM events")
def i7_stream_with_stored_schema(t: Tables) -> DataFrame:
    """Schema inferred at the first run, hinted for one column, stored as version 0 and reused by the second run."""
    folder, out = work_path(t.spark, "events-in"), work_path(t.spark, "events-out")
    table = SnapshotTable(t.spark, f"{out}/table")
    for part, where in (("a", "event_id % 2 = 0"), ("b", "event_id % 2 = 1")):
        _event_lines(t, folder, part, where)
        JsonStream(t.spark, folder, table, f"{out}/checkpoint", SchemaRegistry(t.spark, f"{out}/schemas"), hints="amount DOUBLE").run()
    return table.read().select("event_id", "user_id", "amount")


@plan("""
SELECT mode, event_id, CASE WHEN mode = 'addNewColumns' AND event_id % 2 = 1 THEN event_type END AS coupon, CASE WHEN mode = 'rescue' AND event_id % 2 = 1 THEN event_type END AS rescued,
  CASE WHEN mode <> 'none' AND event_id % 2 = 1 THEN CAST(user_id AS VARCHAR) END AS rescued_case, CAST(mode = 'addNewColumns' AS BIGINT) AS stops
FROM events, (VALUES ('addNewColumns'), ('rescue'), ('none')) AS v(mode)
""")
def i8_schema_evolution_modes(t: Tables) -> DataFrame:
    """The second delivery brings a new column, and one that differs from a known one in case; twin streams treat them by mode."""
    folder, out = work_path(t.spark, "evolving-in"), work_path(t.spark, "evolving-out")
    modes = ("addNewColumns", "rescue", "none")
    tables = {m: SnapshotTable(t.spark, f"{out}/{m}/table") for m in modes}
    stops = dict.fromkeys(modes, 0)

    def run(mode: str) -> None:
        JsonStream(t.spark, folder, tables[mode], f"{out}/{mode}/checkpoint", SchemaRegistry(t.spark, f"{out}/{mode}/schemas"), mode=mode).run()

    more = """concat('{"event_id":', event_id, ',"user_id":', user_id, ',"amount":', value, ',"coupon":"', event_type, '","User_Id":', user_id, '}') AS value"""
    for part in ("a", "b"):
        if part == "a":
            _event_lines(t, folder, part, "event_id % 2 = 0")
        else:
            t.events.where("event_id % 2 = 1").selectExpr(more).write.text(f"{folder}/{part}")
        for mode in modes:
            try:
                run(mode)
            except Exception as e:
                if SchemaChanged.__name__ not in str(e):
                    raise
                stops[mode] += 1
                run(mode)
    result = None
    for mode in modes:
        rows = tables[mode].read()
        coupon = F.col("coupon") if "coupon" in rows.columns else F.lit(None).cast("string")
        kept = lambda name, rows=rows: F.get_json_object("_rescued_data", f"$.{name}") if "_rescued_data" in rows.columns else F.lit(None).cast("string")
        part = rows.select(
            F.lit(mode).alias("mode"), "event_id", coupon.alias("coupon"), kept("coupon").alias("rescued"), kept("User_Id").alias("rescued_case"),
            F.lit(stops[mode]).cast("bigint").alias("stops")
        )
        result = part if result is None else result.unionByName(part)
    return result


@plan("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 >= 2")
def i10_only_files_from_now_on(t: Tables) -> DataFrame:
    """Files present at the start are ignored, which is the feature; later ones come in steps of two files."""
    loader, folder = _loader(t)
    _land_all(t, folder, 0, 1)
    loader.ignore_existing(folder, "*.json")
    _land_all(t, folder, 2, 3)
    while loader.load(folder, "*.json", max_files=2)["files"]:
        pass
    return loader.table.read().select("o_orderkey")


@plan("SELECT 'abcd'[o_orderkey % 4 + 1] AS folder, true AS every_file_named, count(*) AS rows FROM orders GROUP BY 1")
def i11_rows_per_file(t: Tables) -> DataFrame:
    """Rows per file, told by the folder that each file was landed in."""
    loader, folder = _loader(t)
    _land_all(t, folder, 0, 1, 2, 3)
    loader.load(folder, "*.json", lineage=True)
    places = list_files(t.spark, folder, "*.json").select(F.substring_index("path", "/", -1).alias("source_file"), F.element_at(F.split("path", "/"), -2).alias("folder"))
    per_file = rows_per_file(loader.table.read()).join(places, "source_file")
    return per_file.groupBy("folder").agg(F.bool_and(F.col("source_file").endswith(".json")).alias("every_file_named"), F.sum("rows").alias("rows"))


@plan("""
SELECT CAST(o_orderkey % 4 + 1 AS BIGINT) AS batch_id, count(*) AS rows FROM orders GROUP BY 1
""")
def i12_numbered_batches(t: Tables) -> DataFrame:
    """Each run's new files form one batch; a run without new files makes none."""
    loader, folder = _loader(t)
    for r in range(4):
        _land_all(t, folder, r)
        loader.load(folder, "*.json", number_batches=True)
        loader.load(folder, "*.json", number_batches=True)
    return loader.table.read().groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(F.count(F.lit(1)).alias("rows"))
