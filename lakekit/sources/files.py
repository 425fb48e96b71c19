"""File readers beyond the built-in ones: headers per file, type hints and rescued values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from lakekit.sources.rescue import REST, VALUE, fit, json_object, let, quoted

RESCUED = "_rescued_data"


def list_files(spark: SparkSession, path: str | list[str], pattern: str | None = None, recursive: bool = True, **options) -> DataFrame:
    """Files below a path with size and time, from the file listing alone (contents are not read).

    Options: ``modifiedAfter`` and ``modifiedBefore``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path).select("path", "length", "modificationTime")


def read_csv_by_name(spark: SparkSession, path: str | list[str], sep: str = ",", file: str | None = None, **options) -> DataFrame:
    """CSV files whose headers differ, united by column name; columns a file lacks are NULL. All columns are strings.

    A first pass over all files finds each one's first line that is not blank (combined map-side to one row per file); then
    one reader per distinct header reads that header's files, so the files are scanned twice. Only file names and headers reach the driver, as in any file listing.
    ``file`` adds a column of that name with each row's file.
    """
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"),
        "value",
    )
    lines = lines.where(F.trim("value") != "")  # as the CSV reader does, take the first line that is not blank
    headers = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = headers.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    out = None
    for g in sorted(groups, key=lambda g: g["header"]):
        part = spark.read.csv(g["files"], header=True, sep=sep, **options)
        if file:
            part = part.select("*", F.col("_metadata.file_path").alias(file))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def infer_schema(
    spark: SparkSession, path: str | list[str], fmt: str, hints: str | None = None, types: bool = True,
    sampling_ratio: float = 1.0, **options,
) -> StructType:
    """Inferred schema with some columns overridden by a DDL string; hinted columns unknown so far are added."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "json":
        reader = reader.option("primitivesAsString", str(not types).lower())
    elif fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", str(types).lower())
    if fmt in ("json", "csv"):
        reader = reader.option("samplingRatio", sampling_ratio)
    return apply_hints(reader.load(path).schema, hints)


def apply_hints(schema: StructType, hints: str | None) -> StructType:
    if not hints:
        return schema
    wanted = {f.name: f for f in StructType.fromDDL(hints).fields}
    fields = [wanted.pop(f.name, f) for f in schema.fields]
    return StructType([*fields, *wanted.values()])


def one_case(schema: StructType) -> StructType:
    """The schema without fields that differ from an earlier one in letter case only: a table cannot hold both."""
    seen: dict[str, StructField] = {}
    for f in schema.fields:
        seen.setdefault(f.name.lower(), f)
    return StructType(list(seen.values()))


def _fitted(raw: Column, field: StructField) -> Column:
    """STRUCT<value, rest>: raw text as a value of the field, and what does not fit as JSON text."""
    if isinstance(field.dataType, StructType | ArrayType | MapType):
        parsed = F.try_parse_json(raw)
        unread = F.struct(F.lit(None).cast(field.dataType).alias(VALUE), quoted(raw).alias(REST))
        return F.when(raw.isNotNull() & parsed.isNull(), unread).otherwise(let(parsed, lambda v: fit(v, field.dataType)))
    value = raw if isinstance(field.dataType, StringType) else raw.try_cast(field.dataType)
    return F.struct(value.alias(VALUE), F.when(raw.isNotNull() & value.isNull(), quoted(raw)).alias(REST))


def rescue(df: DataFrame, raw: str, schema: StructType, file: str | None = None) -> DataFrame:
    """Typed columns from a ``MAP<STRING, STRING>`` of raw values, and ``_rescued_data``.

    A value that does not fit its type becomes NULL and is kept, with unknown columns (also such that differ in case
    only) and the file path, as JSON text in ``_rescued_data``. Inside structs, arrays and maps only the parts that do not fit
    are NULL and kept, see ``sources.rescue``. Rows are never lost.
    """
    fields = one_case(schema).fields
    known = [f.name for f in fields]
    out = df.withColumns({f"_v{i}": _fitted(F.col(raw)[f.name], f) for i, f in enumerate(fields)})
    bad = F.map_from_arrays(F.array(*map(F.lit, known)), F.array(*(F.col(f"_v{i}")[REST] for i in range(len(known)))))
    more = F.transform_values(F.map_filter(raw, lambda k, v: v.isNotNull() & ~k.isin(known)), lambda _, v: quoted(v))
    left = F.map_concat(F.map_filter(bad, lambda _, r: r.isNotNull()), more) if known else more
    out = out.withColumn("_left", left)
    noted = F.map_concat("_left", F.create_map(F.lit("_file_path"), quoted(F.col(file)))) if file else F.col("_left")
    rescued = F.when(F.size("_left") > 0, json_object(noted)).alias(RESCUED)
    rest = [c for c in df.columns if c not in (raw, file)]
    return out.select(*rest, *[F.col(f"_v{i}")[VALUE].alias(n) for i, n in enumerate(known)], rescued)


def read_json_rescued(spark: SparkSession, path: str | list[str], schema: StructType, pattern: str | None = None) -> DataFrame:
    """JSON lines with ``_rescued_data``."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    return parse_json_rescued(lines, schema, "value", "_file")


def parse_json_rescued(lines: DataFrame, schema: StructType, value: str = "value", file: str | None = None) -> DataFrame:
    """Same for lines already read, in batch or stream. A line that is no JSON object is rescued under ``_line``."""
    raw = F.from_json(value, "map<string,string>", {"mode": "PERMISSIVE"})
    kept = F.coalesce(raw, F.create_map(F.lit("_line"), F.col(value)))
    return rescue(lines.withColumn("_raw", kept).drop(value), "_raw", schema, file)


def read_csv_rescued(spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",", **options) -> DataFrame:
    """CSV files, each with its own header, with ``_rescued_data``. Columns of nested types hold JSON text."""
    rows = read_csv_by_name(spark, path, sep, file="_file", **options)
    named = [c for c in rows.columns if c != "_file"]
    pairs = F.map_from_arrays(F.array(*[F.lit(c) for c in named]), F.array(*[F.col(f"`{c}`") for c in named]))
    return rescue(rows.select(pairs.alias("_raw"), "_file"), "_raw", schema, "_file")


def decode_messages(df: DataFrame, schema: StructType | str, keep: tuple[str, ...] = ("topic", "partition", "offset", "timestamp")) -> DataFrame:
    """Message-bus rows (binary ``key`` and ``value`` with topic, offset, timestamp) as typed columns."""
    return df.select(
        F.col("key").cast("string").alias("key"), F.from_json(F.col("value").cast("string"), schema).alias("v"), *keep
    ).select("key", "v.*", *keep)
