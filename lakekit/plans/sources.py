"""Source queries: tables are laid out as files of some format and read back."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.operators.layout import write_partitioned
from lakekit.plans.registry import plan
from lakekit.session import Tables, work_path
from lakekit.sources import files as src
from lakekit.sources.ingest import rows_per_file

D = "decimal(18,2)"


@plan("SELECT CAST(n_regionkey AS BIGINT) AS region, count(*) AS n FROM nation GROUP BY 1 UNION ALL SELECT -1, count(*) FROM orders UNION ALL SELECT -2, count(*) FROM orders WHERE o_orderkey % 2 = 0")
def s1_query_files_in_place(t: Tables) -> DataFrame:
    """SQL straight over a file, a folder and a glob, without a table."""
    folder = work_path(t.spark, "orders")
    t.orders.write.parquet(folder)
    halves = work_path(t.spark, "orders-halves")
    for name, rest in (("even", 0), ("odd", 1)):
        t.orders.where(F.col("o_orderkey") % 2 == rest).write.parquet(f"{halves}/{name}")
    return t.spark.sql(f"""
        SELECT CAST(n_regionkey AS BIGINT) AS region, count(*) AS n FROM parquet.`{t.path}/nation.parquet` GROUP BY 1
        UNION ALL SELECT -1, count(*) FROM parquet.`{folder}`
        UNION ALL SELECT -2, count(*) FROM parquet.`{halves}/ev*`
    """)


@plan("SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def s2_typed_csv(t: Tables) -> DataFrame:
    folder = work_path(t.spark, "parts-csv")
    t.part.select("p_partkey", "p_name", "p_brand", "p_retailprice").write.csv(folder, sep=";", header=True)
    schema = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_retailprice DOUBLE"
    return t.spark.read.format("csv").option("header", True).option("sep", ";").schema(schema).load(folder)


@plan("""
SELECT 'permissive' AS mode, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 10 = 0) AS broken, CAST(sum(o_orderkey) AS BIGINT) AS keys,
  CAST(sum(o_custkey) FILTER (WHERE o_orderkey % 10 <> 0) AS BIGINT) AS customers FROM orders
UNION ALL SELECT 'dropmalformed', count(*), 0, CAST(sum(o_orderkey) AS BIGINT), CAST(sum(o_custkey) AS BIGINT) FROM orders WHERE o_orderkey % 10 <> 0
""")
def s3_parse_modes(t: Tables) -> DataFrame:
    """Every tenth line has text where a number belongs. FAILFAST, which raises, is covered by the tests.

    Both modes are counted over the parsed columns: a reader that needs no column parses none, and drops nothing."""
    folder = work_path(t.spark, "broken-csv")
    t.orders.selectExpr(
        "concat(o_orderkey, ',', CASE WHEN o_orderkey % 10 = 0 THEN 'oops' ELSE CAST(o_custkey AS STRING) END) AS value"
    ).write.text(folder)
    schema = "o_orderkey BIGINT, o_custkey BIGINT, broken STRING"
    kept = t.spark.read.schema(schema).csv(folder, mode="PERMISSIVE", columnNameOfCorruptRecord="broken")
    short = t.spark.read.schema("o_orderkey BIGINT, o_custkey BIGINT").csv(folder, mode="DROPMALFORMED").withColumn("broken", F.lit(None).cast("string"))
    out = None
    for mode, rows in (("permissive", kept), ("dropmalformed", short)):
        part = rows.agg(F.lit(mode).alias("mode"), F.count("o_orderkey").alias("n"), F.count_if(F.col("o_custkey").isNull() & F.col("broken").isNotNull()).alias("broken"),
                        F.sum("o_orderkey").alias("keys"), F.sum("o_custkey").alias("customers"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS VARCHAR) AS status FROM orders
""")
def s4_csv_by_name(t: Tables) -> DataFrame:
    """Three deliveries: one with the columns swapped, one with a column more."""
    folder = work_path(t.spark, "headers")
    rows = t.orders.selectExpr("o_orderkey AS id", "o_custkey AS customer", "o_orderstatus AS status")
    rows.where("id % 3 = 0").write.csv(f"{folder}/a", header=True)
    rows.where("id % 3 = 1").select("customer", "id").write.csv(f"{folder}/b", header=True)
    rows.where("id % 3 = 2").select("id", "customer").write.csv(f"{folder}/c", header=True)
    return src.read_csv_by_name(t.spark, folder).select("id", "customer", "status")


@plan("SELECT p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size, p_retailprice FROM part")
def s5_schema_hints(t: Tables) -> DataFrame:
    """Types are inferred but for one column, which stays text by a hint."""
    folder = work_path(t.spark, "parts-json")
    t.part.select("p_partkey", "p_name", "p_size", "p_retailprice").write.json(folder)
    schema = src.infer_schema(t.spark, folder, "json", hints="p_size STRING")
    return t.spark.read.schema(schema).json(folder).select("p_partkey", "p_name", "p_size", "p_retailprice")


_RESCUE = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS customer, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 10 = 0 THEN o_custkey || ' pcs' END AS rescued_customer, CASE WHEN o_orderkey % 13 = 0 THEN o_orderpriority END AS rescued_priority,
  CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus END AS rescued_case FROM orders
"""


@plan(_RESCUE)
def s6_rescued_json(t: Tables) -> DataFrame:
    """Wrong type, unknown column, and a name that differs in case: all kept in the rescue column."""
    folder = work_path(t.spark, "rescue-json")
    t.orders.selectExpr(
        """to_json(map_filter(map('id', CAST(o_orderkey AS STRING), 'customer', concat(o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN ' pcs' ELSE '' END),
             'status', CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END, 'Status', CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus END,
             'priority', CASE WHEN o_orderkey % 13 = 0 THEN o_orderpriority END), (k, v) -> v IS NOT NULL)) AS value"""
    ).write.text(folder)
    schema = StructType.fromDDL("id BIGINT, customer BIGINT, status STRING")
    out = src.read_json_rescued(t.spark, folder, schema)
    kept = F.from_json(src.RESCUED, "map<string,string>")
    return out.select(
        "id", "customer", "status", kept["customer"].alias("rescued_customer"), kept["priority"].alias("rescued_priority"),
        kept["Status"].alias("rescued_case"),
    )


@plan("""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 11 <> 0 THEN o_custkey END AS w, CASE WHEN o_orderkey % 17 <> 0 THEN o_orderkey % 9 END AS h,
  CASE WHEN o_orderkey % 19 <> 0 THEN 2 END AS second, CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 11 = 0 THEN 'wide' END AS rescued_w,
  CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 13 = 0 THEN '7' END AS rescued_case, CASE WHEN o_orderkey % 17 = 0 THEN 'none' END AS rescued_scalar,
  CASE WHEN o_orderkey % 19 = 0 THEN '[{"q":' || o_orderkey % 5 || '},{"q":"few"}]' END AS rescued_parts, CASE WHEN o_orderkey % 23 = 0 THEN 'true' END AS rescued_extra,
  o_orderkey % 17 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 23 = 0 AS has_file FROM orders
""")
def s6_rescued_nested(t: Tables) -> DataFrame:
    """Misfits inside a struct and an array, a scalar in a struct's place, and nested names unknown or in another case."""
    folder = work_path(t.spark, "rescue-nested")
    t.orders.selectExpr(
        """concat('{"id":', o_orderkey, ',"dims":', CASE WHEN o_orderkey % 17 = 0 THEN '"none"' ELSE concat('{"w":', CASE WHEN o_orderkey % 11 = 0 THEN '"wide"' ELSE CAST(o_custkey AS STRING) END,
             ',"h":', o_orderkey % 9, CASE WHEN o_orderkey % 13 = 0 THEN ',"H":7' ELSE '' END, CASE WHEN o_orderkey % 23 = 0 THEN ',"deep":{"new":true}' ELSE '' END, '}') END,
             ',"parts":[{"q":', o_orderkey % 5, '},{"q":', CASE WHEN o_orderkey % 19 = 0 THEN '"few"' ELSE '2' END, '}]',
             CASE WHEN o_orderkey % 23 = 0 AND o_orderkey % 17 = 0 THEN ',"extra":true' ELSE '' END, '}') AS value""").write.text(folder)
    schema = StructType.fromDDL("id BIGINT, dims STRUCT<w: BIGINT, h: BIGINT, deep: STRUCT<old: INT>>, parts ARRAY<STRUCT<q: INT>>")
    out = src.read_json_rescued(t.spark, folder, schema)
    kept = lambda path: F.get_json_object(src.RESCUED, path)
    scalar = F.when(~kept("$.dims").startswith("{"), kept("$.dims"))
    return out.select(
        "id", "dims.w", "dims.h", F.col("parts")[1]["q"].alias("second"), kept("$.dims.w").alias("rescued_w"), kept("$.dims.H").alias("rescued_case"),
        scalar.alias("rescued_scalar"), kept("$.parts").alias("rescued_parts"), F.coalesce(kept("$.dims.deep.new"), kept("$.extra")).alias("rescued_extra"),
        kept("$._file_path").isNotNull().alias("has_file"))


@plan("""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS total, CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' END AS rescued,
  o_orderkey % 10 = 0 OR o_orderkey % 3 = 1 AS has_file, CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS rescued_status FROM orders
""")
def s6_rescued_csv(t: Tables) -> DataFrame:
    """Two kinds of headers: one has a column that the schema lacks. The rescued values name their file."""
    folder = work_path(t.spark, "rescue-csv")
    total = "CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END AS total"
    t.orders.where("o_orderkey % 3 <> 1").selectExpr("o_orderkey AS id", total).write.csv(f"{folder}/plain", header=True)
    t.orders.where("o_orderkey % 3 = 1").selectExpr("o_orderstatus AS status", total, "o_orderkey AS id").write.csv(f"{folder}/more", header=True)
    out = src.read_csv_rescued(t.spark, folder, StructType.fromDDL("id BIGINT, total DOUBLE"))
    kept = lambda name: F.get_json_object(src.RESCUED, f"$.{name}")
    place = F.when(F.col("id") % 3 == 1, "/more/").otherwise("/plain/")
    named = F.coalesce(F.contains(kept("_file_path"), place), F.lit(False))
    return out.select("id", "total", kept("total").alias("rescued"), named.alias("has_file"), kept("status").alias("rescued_status"))


@plan("""
SELECT 'lines' AS layout, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer UNION ALL SELECT 'document', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer
""")
def s7_json_lines_and_documents(t: Tables) -> DataFrame:
    """JSON lines, and files that are one array each (small batches, since a document is read in one piece)."""
    folder = work_path(t.spark, "json")
    rows = t.customer.select("c_custkey", "c_name")
    rows.write.json(f"{folder}/lines")
    batches = rows.groupBy(F.floor(F.col("c_custkey") / 500).alias("b")).agg(F.to_json(F.collect_list(F.struct("c_custkey", "c_name"))).alias("value"))
    batches.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/documents")
    out = None
    for layout, multi in (("lines", False), ("document", True)):
        path = f"{folder}/{'documents' if multi else 'lines'}"
        part = t.spark.read.schema("c_custkey BIGINT, c_name STRING").json(path, multiLine=multi).agg(
            F.lit(layout).alias("layout"), F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys")
        )
        out = part if out is None else out.unionByName(part)
    return out


@plan("""
SELECT lang, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS lines, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1
""")
def s8_text_lines(t: Tables) -> DataFrame:
    """Whole documents written as text below one folder per language, read back line by line."""
    folder = work_path(t.spark, "text")
    t.documents.select("lang", "text").write.partitionBy("lang").option("lineSep", "\n").text(folder)
    lines = t.spark.read.option("lineSep", "\n").text(folder)
    breaks = t.documents.groupBy("lang").agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).alias("breaks"))
    per_lang = lines.groupBy("lang").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("c"))
    return per_lang.join(breaks, "lang").select("lang", "lines", (F.col("c") + F.col("breaks")).alias("chars"))


@plan("SELECT CAST(sum(length(text) + 1) AS BIGINT) AS chars, count(*) AS documents FROM documents")
def s8_whole_text(t: Tables) -> DataFrame:
    """One row per file; files are bounded to 50 documents each."""
    folder = work_path(t.spark, "wholetext")
    t.documents.select("text").write.option("maxRecordsPerFile", 50).option("lineSep", "\n").text(folder)
    whole = t.spark.read.text(folder, wholetext=True)
    n = t.documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    return whole.agg(F.sum(F.length("value")).alias("chars")).withColumn("documents", n)


@plan("SELECT '50415231' AS signature, count(*) AS n, true AS sizes_agree FROM nation")
def s10_binary_files(t: Tables) -> DataFrame:
    """First bytes of stored files, here one small Parquet file per nation."""
    folder = work_path(t.spark, "binary")
    t.nation.repartition(1).write.option("maxRecordsPerFile", 1).parquet(folder)
    files = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return files.groupBy(F.hex(F.substring("content", 1, 4)).alias("signature")).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.length("content") == F.col("length")).alias("sizes_agree")
    )


@plan("SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 8 = 0 THEN 'staged' ELSE 'base' END AS origin FROM orders")
def s11_parquet_and_staged_json(t: Tables) -> DataFrame:
    folder = work_path(t.spark, "staged")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    rows.where("o_orderkey % 8 <> 0").write.parquet(f"{folder}/base")
    rows.where("o_orderkey % 8 = 0").write.json(f"{folder}/staged")
    base = t.spark.read.schema(rows.schema).parquet(f"{folder}/base").withColumn("origin", F.lit("base"))
    staged = t.spark.read.schema(rows.schema).json(f"{folder}/staged").withColumn("origin", F.lit("staged"))
    return base.unionByName(staged)


@plan("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0")
def s12_file_selection(t: Tables) -> DataFrame:
    """Nested folders with foreign files in between: name pattern, recursion and modification time decide."""
    folder = work_path(t.spark, "select")
    t.customer.where("c_custkey % 2 = 0").select("c_custkey").write.json(f"{folder}/in/deep")
    t.customer.where("c_custkey % 2 = 1").select("c_custkey").write.csv(f"{folder}/in/other")
    reader = t.spark.read.schema("c_custkey BIGINT").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    rows = reader.option("modifiedAfter", "2000-01-01T00:00:00").json(f"{folder}/in")
    return rows.where(F.col("_metadata.file_name").like("part-%")).select("c_custkey")


@plan("SELECT strftime(o_orderdate, '%Y') AS order_year, o_orderstatus, count(*) AS n FROM orders WHERE year(o_orderdate) >= 1998 GROUP BY ALL")
def s13_partition_folders(t: Tables) -> DataFrame:
    """Folder names become columns; the year filter never opens the other folders."""
    folder = work_path(t.spark, "by-year")
    write_partitioned(t.orders.withColumn("order_year", F.date_format("o_orderdate", "yyyy")), folder, ["order_year"])
    rows = t.spark.read.parquet(folder).where("order_year >= 1998")
    return rows.groupBy(F.col("order_year").cast("string").alias("order_year"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@plan("SELECT 'orders.parquet' AS source_file, count(*) AS rows FROM orders UNION ALL SELECT 'customer.parquet', count(*) FROM customer")
def s14_file_lineage(t: Tables) -> DataFrame:
    def keys(df, key):
        return df.select(F.col(key).alias("k"), F.col("_metadata.file_name").alias("source_file"), F.current_timestamp().alias("ingested_at"))

    return rows_per_file(keys(t.orders, "o_orderkey").unionByName(keys(t.customer, "c_custkey")))


@plan("SELECT event_type, CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def s15_single_variant_column(t: Tables) -> DataFrame:
    folder = work_path(t.spark, "variant")
    t.events.select("event_type", F.from_json("props", "k BIGINT").alias("props")).write.json(folder)
    raw = t.spark.read.option("singleVariantColumn", "raw").json(folder)
    return raw.groupBy(F.variant_get("raw", "$.event_type", "string").alias("event_type")).agg(
        F.sum(F.variant_get("raw", "$.props.k", "bigint")).alias("total")
    )


@plan("SELECT true AS listed, count(*) AS n FROM supplier")
def s16_catalog_table(t: Tables) -> DataFrame:
    name = f"lakekit_s16_{uuid.uuid4().hex[:8]}"
    t.supplier.createOrReplaceTempView(name)
    listed = t.spark.catalog.tableExists(name)
    return t.spark.table(name).agg(F.lit(listed).alias("listed"), F.count(F.lit(1)).alias("n"))


@plan("""
SELECT label, count(*) AS n FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) AS v(code, label) ON code = o_orderstatus GROUP BY 1
""")
def s17_rows_in_code(t: Tables) -> DataFrame:
    """A three-row lookup written in code, joined to the orders."""
    labels = t.spark.createDataFrame([("F", "finished"), ("O", "open"), ("P", "partial")], "code STRING, label STRING")
    counts = t.orders.groupBy("o_orderstatus").count()
    return counts.join(F.broadcast(labels), F.col("o_orderstatus") == F.col("code")).select("label", F.col("count").alias("n"))


@plan("""
WITH r AS (SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders)
SELECT f AS format, n, total FROM r, (VALUES ('json'), ('csv'), ('xml'), ('parquet'), ('orc')) AS v(f)
""")
def s19_formats(t: Tables) -> DataFrame:
    folder = work_path(t.spark, "formats")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    out = None
    for fmt in ("json", "csv", "xml", "parquet", "orc"):
        options = {"rowTag": "order"} if fmt == "xml" else {}
        rows.write.format(fmt).options(**options).save(f"{folder}/{fmt}")
        part = t.spark.read.format(fmt).schema(rows.schema).options(**options).load(f"{folder}/{fmt}").agg(
            F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast(D)).cast("double").alias("total")
        )
        out = part if out is None else out.unionByName(part)
    return out


@plan("SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type, value FROM events")
def s20_decode_messages(t: Tables) -> DataFrame:
    envelope = t.events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("event_id", "event_type", "value")).cast("binary").alias("value"),
        F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return src.decode_messages(envelope, "event_id BIGINT, event_type STRING, value DOUBLE").select("key", "event_id", "event_type", "value")


@plan("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS currency, count(*) AS rate FROM events GROUP BY ALL")
def s21_object_of_rates(t: Tables) -> DataFrame:
    """A landed document per day holding an object of rates, turned into rows."""
    counts = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").count()
    documents = counts.groupBy("day").agg(
        F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("event_type", "count"))).alias("rates"))).alias("doc")
    )
    return t.spark.sql("""
        SELECT day, r.key AS currency, variant_get(r.value, '$', 'bigint') AS rate
        FROM {d}, LATERAL variant_explode(variant_get(parse_json(doc), '$.rates')) AS r
    """, d=documents)
