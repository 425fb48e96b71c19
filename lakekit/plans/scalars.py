"""Scalar function families."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.log_lines import parse_log_lines
from lakekit.plans.registry import plan
from lakekit.session import Tables


@plan("""
SELECT p_partkey, lower(p_type) AS lo, upper(p_name) AS up, trim('  ' || p_brand || ' ') AS tr, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS ini,
  length(p_name) AS len, lpad(CAST(p_size AS VARCHAR), 4, '0') AS pad, concat(p_brand, '/', p_type) AS cc, concat_ws('-', p_brand, p_type) AS cws,
  split_part(p_name, ' ', 1) AS first_word, string_split(p_name, ' ')[-1] AS last_word, substring(p_name, 2, 3) AS sub, left(p_brand, 5) AS lft, right(p_type, 3) AS rgt,
  split_part(p_brand, '#', 1) AS before_hash, replace(p_name, ' ', '_') AS rep, regexp_replace(p_brand, '[0-9]+', 'N', 'g') AS rxr, regexp_extract(p_brand, '#([0-9]+)', 1) AS rxe,
  p_name LIKE '%ring%' AS lk, p_type ILIKE 'eco%' AS ilk, regexp_matches(p_name, '^(red|blue)') AS rlk, contains(p_name, 'bolt') AS cnt, hex(p_type) AS hx FROM part
""")
def f1_string_functions(t: Tables) -> DataFrame:
    return t.sql("""
        SELECT p_partkey, lower(p_type) AS lo, upper(p_name) AS up, trim(concat('  ', p_brand, ' ')) AS tr, initcap(p_name) AS ini,
          CAST(length(p_name) AS BIGINT) AS len, lpad(CAST(p_size AS STRING), 4, '0') AS pad, concat(p_brand, '/', p_type) AS cc, concat_ws('-', p_brand, p_type) AS cws,
          split(p_name, ' ')[0] AS first_word, element_at(split(p_name, ' '), -1) AS last_word, substring(p_name, 2, 3) AS sub, left(p_brand, 5) AS lft, right(p_type, 3) AS rgt,
          substring_index(p_brand, '#', 1) AS before_hash, replace(p_name, ' ', '_') AS rep, regexp_replace(p_brand, '[0-9]+', 'N') AS rxr, regexp_extract(p_brand, '#([0-9]+)', 1) AS rxe,
          p_name LIKE '%ring%' AS lk, p_type ILIKE 'eco%' AS ilk, p_name RLIKE '^(red|blue)' AS rlk, contains(p_name, 'bolt') AS cnt, hex(p_type) AS hx
        FROM {part}
    """)


@plan("""
SELECT o_orderkey, strftime(try_strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y'), '%Y-%m-%d') AS parsed, try_strptime('x' || o_orderkey, '%Y') IS NULL AS unparsed,
  strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS plus30, strftime(o_orderdate - INTERVAL 7 DAY, '%Y-%m-%d') AS minus7,
  strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS quarter_start, strftime(to_timestamp(o_orderkey * 1000)::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS from_epoch,
  CAST(epoch(o_orderdate) AS BIGINT) AS to_epoch, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days, CAST(date_sub('month', TIMESTAMP '1995-01-01', o_orderdate) AS BIGINT) AS months,
  year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, dayofweek(o_orderdate) + 1 AS dow, len(generate_series(o_orderdate, o_orderdate + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS seq, CAST(o_orderdate AS DATE) < current_date AS past FROM orders
""")
def f2_date_functions(t: Tables) -> DataFrame:
    return t.sql("""
        SELECT o_orderkey, date_format(to_date(date_format(o_orderdate, 'dd/MM/yyyy'), 'dd/MM/yyyy'), 'yyyy-MM-dd') AS parsed,
          try_to_timestamp(concat('x', o_orderkey)) IS NULL AS unparsed, date_format(o_orderdate, 'yyyy-MM') AS month,
          date_format(date_add(o_orderdate, 30), 'yyyy-MM-dd') AS plus30, date_format(o_orderdate - INTERVAL 7 DAY, 'yyyy-MM-dd') AS minus7,
          date_format(date_trunc('quarter', o_orderdate), 'yyyy-MM-dd') AS quarter_start, from_unixtime(o_orderkey * 1000) AS from_epoch,
          unix_timestamp(timestamp_seconds(unix_timestamp(CAST(o_orderdate AS TIMESTAMP)))) AS to_epoch,
          CAST(datediff(o_orderdate, DATE'1995-01-01') AS BIGINT) AS days, timestampdiff(MONTH, TIMESTAMP'1995-01-01', CAST(o_orderdate AS TIMESTAMP)) AS months,
          CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(day(o_orderdate) AS BIGINT) AS d, CAST(dayofweek(o_orderdate) AS BIGINT) AS dow,
          CAST(size(sequence(to_date(o_orderdate), date_add(o_orderdate, 3), INTERVAL 1 DAY)) AS BIGINT) AS seq,
          to_date(o_orderdate) < current_date() AS past
        FROM {orders}
    """)


@plan("""
SELECT event_id, round(value, 0) AS rd, abs(user_id - 50) AS ab, ((event_id - 500) % 7 + 7) % 7 AS pm, event_id // 7 AS dv, greatest(event_id, user_id * 10) AS gr, event_id % 5 AS md, true AS hashes_repeat FROM events
""")
def f3_math_functions(t: Tables) -> DataFrame:
    return t.sql("""
        SELECT event_id, round(value, 0) AS rd, abs(user_id - 50) AS ab, pmod(event_id - 500, 7) AS pm, event_id DIV 7 AS dv,
          greatest(event_id, user_id * 10) AS gr, event_id % 5 AS md, hash(event_id) = hash(event_id) AND xxhash64(props) = xxhash64(concat(props, '')) AS hashes_repeat
        FROM {events}
    """)


@plan("""
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END, '?') AS co, TRY_CAST(replace(o_orderpriority, '-', '') AS BIGINT) IS NULL AS bad_cast,
  CAST(o_totalprice AS BIGINT) >= 0 AS cast_ok, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' END AS band,
  (CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END) IS NOT DISTINCT FROM (CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END) AS same_safe,
  (CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END) = (CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END) AS same_plain,
  round(o_totalprice / nullif(o_orderkey % 5, 0), 4) AS ratio, o_orderkey + 1 AS added, CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS number, string_split(o_orderpriority, '-')[3] AS third FROM orders
""")
def f4_null_and_cast_functions(t: Tables) -> DataFrame:
    return t.sql("""
        SELECT o_orderkey, nvl(CASE WHEN o_orderkey % 3 = 0 THEN ifnull(o_orderstatus, '-') END, '?') AS co, try_cast(replace(o_orderpriority, '-', '') AS BIGINT) IS NULL AS bad_cast,
          o_totalprice::BIGINT >= 0 AND typeof(o_totalprice) = 'double' AS cast_ok, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' END AS band,
          (CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END) <=> (CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END) AS same_safe,
          (CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END) = (CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END) AS same_plain,
          round(try_divide(o_totalprice, o_orderkey % 5), 4) AS ratio, try_add(o_orderkey, 1) AS added,
          CAST(try_to_number(substring(o_orderpriority, 1, 1), '9') AS BIGINT) AS number, try_element_at(split(o_orderpriority, '-'), 3) AS third
        FROM {orders}
    """)


@plan("""
WITH a AS (SELECT p_partkey, p_size, [p_size, p_size % 10, p_size % 10, CAST(p_partkey % 7 AS INTEGER)] AS xs, string_split(p_name, ' ') AS ws FROM part)
SELECT p_partkey, len(xs) AS sz, list_contains(xs, 3) AS has3, list_sort(list_distinct(xs)).list_transform(lambda x: CAST(x AS VARCHAR)).array_to_string(',') AS dist,
  flatten([ws, ['z']]).array_to_string('|') AS flat, list_sort(xs).list_transform(lambda x: CAST(x AS VARCHAR)).array_to_string(',') AS sorted, ws[1] AS el, len(list_distinct(list_concat(ws, ['red', 'blue']))) AS un,
  len(generate_series(1, 1 + p_size % 5)) AS seq FROM a
""")
def f5_array_functions(t: Tables) -> DataFrame:
    return t.sql("""
        SELECT p_partkey, CAST(array_size(xs) AS BIGINT) AS sz, array_contains(xs, 3) AS has3, array_join(sort_array(array_distinct(xs)), ',') AS dist,
          array_join(flatten(array(ws, array_compact(array('z', NULL)))), '|') AS flat, array_join(sort_array(xs), ',') AS sorted, element_at(ws, 1) AS el,
          CAST(size(array_union(ws, array('red', 'blue'))) AS BIGINT) AS un, CAST(size(sequence(1, 1 + size0 % 5)) AS BIGINT) AS seq
        FROM (SELECT p_partkey, p_size AS size0, array(p_size, p_size % 10, p_size % 10, CAST(p_partkey % 7 AS INT)) AS xs, split(p_name, ' ') AS ws FROM {part})
    """)


@plan("""
WITH a AS (SELECT p_partkey, [p_size, p_size % 10, CAST(p_partkey % 7 AS INTEGER)] AS xs FROM part)
SELECT p_partkey, list_transform(xs, lambda x: CAST(x * 2 AS VARCHAR)).array_to_string(',') AS doubled, list_filter(xs, lambda x: x > 4).list_transform(lambda x: CAST(x AS VARCHAR)).array_to_string(',') AS big,
  len(list_filter(xs, lambda x: x = 0)) > 0 AS any_zero, CAST(list_sum(xs) AS BIGINT) AS total FROM a
""")
def f6_higher_order_functions(t: Tables) -> DataFrame:
    xs = F.array("p_size", F.col("p_size") % 10, (F.col("p_partkey") % 7).cast("int"))
    rows = t.part.select("p_partkey", xs.alias("xs"))
    return rows.select(
        "p_partkey",
        F.array_join(F.transform("xs", lambda x: (x * 2).cast("string")), ",").alias("doubled"),
        F.array_join(F.filter("xs", lambda x: x > 4).cast("array<string>"), ",").alias("big"),
        F.exists("xs", lambda x: x == 0).alias("any_zero"),
        F.aggregate("xs", F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("total"),
    )


@plan("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k1, CAST(props->>'k' AS BIGINT) AS k2, CAST(props->>'k' AS BIGINT) AS k3, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS js, 'STRUCT<k: BIGINT, tags: ARRAY<STRING>>' AS shape FROM events
""")
def f7_json_functions(t: Tables) -> DataFrame:
    parsed = t.events.withColumn("p", F.from_json("props", "k BIGINT"))
    return parsed.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k1"),
        F.col("p.k").alias("k2"),
        F.expr("parse_json(props):k::bigint").alias("k3"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("js"),
        F.schema_of_json(F.lit('{"k": 7, "tags": ["a"]}')).alias("shape"),
    )


@plan("""
SELECT 'k' AS "key", count(*) AS n, CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS total, 'OBJECT<k: BIGINT>' AS shape, true AS broken_is_null, 'OBJECT<k: BIGINT>' AS least_shape, 1 AS shapes FROM events
""")
def f8_variant_functions(t: Tables) -> DataFrame:
    return t.sql("""
        WITH v AS (SELECT parse_json(props) AS v, try_parse_json(concat('[', props)) AS broken FROM {events}),
             shape AS (SELECT schema_of_variant_agg(v) AS shape, bool_and(broken IS NULL) AS broken_is_null, min(schema_of_variant(v)) AS least_shape,
                              count(DISTINCT schema_of_variant(v)) AS shapes FROM v)
        SELECT e.key, count(*) AS n, sum(variant_get(e.value, '$', 'bigint')) AS total, (SELECT shape FROM shape) AS shape, (SELECT broken_is_null FROM shape) AS broken_is_null,
          (SELECT least_shape FROM shape) AS least_shape, (SELECT shapes FROM shape) AS shapes
        FROM v, LATERAL variant_explode(v.v) AS e GROUP BY e.key
    """)


@plan("""
WITH w AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN [] ELSE string_split(p_name, ' ') END AS ws FROM part)
SELECT 'explode' AS generator, p_partkey, unnest(ws) AS word, -1 AS pos FROM w
UNION ALL SELECT 'posexplode', p_partkey, unnest(ws), unnest(generate_series(0, len(ws) - 1)) FROM w WHERE len(ws) > 0
UNION ALL SELECT 'outer', p_partkey, '(none)', -1 FROM w WHERE len(ws) = 0
UNION ALL SELECT 'outer', p_partkey, unnest(ws), -1 FROM w
""")
def f9_generators(t: Tables) -> DataFrame:
    rows = t.part.selectExpr("p_partkey", "CASE WHEN p_partkey % 4 = 0 THEN array() ELSE split(p_name, ' ') END AS ws")
    plain = rows.selectExpr("'explode' AS generator", "p_partkey", "explode(ws) AS word", "-1L AS pos")
    numbered = rows.select(F.lit("posexplode").alias("generator"), "p_partkey", F.posexplode("ws").alias("pos", "word"))
    outer = rows.select(F.lit("outer").alias("generator"), "p_partkey", F.explode_outer("ws").alias("word")).withColumns(
        {"word": F.coalesce("word", F.lit("(none)")), "pos": F.lit(-1).cast("bigint")}
    )
    return plain.unionByName(numbered.withColumn("pos", F.col("pos").cast("bigint"))).unionByName(outer)


@plan("SELECT count(*) AS n, true AS user_known, true AS catalog_known, true AS schema_is_database, true AS partition_known FROM nation")
def f10_session_functions(t: Tables) -> DataFrame:
    return t.nation.select(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"),
        F.first(F.current_user().isNotNull()).alias("user_known"),
        F.first(F.concat(F.current_catalog(), F.current_database()).isNotNull()).alias("catalog_known"),
        F.first(F.current_schema() == F.current_database()).alias("schema_is_database"),
        F.bool_and(F.col("p") >= 0).alias("partition_known"),
    )


@plan("""
WITH l AS (SELECT event_type AS event, CASE event_id % 4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARN' ELSE 'INFO' END AS level, event_id % 900 AS ms FROM events WHERE event_id % 11 <> 0)
SELECT level, event, count(*) AS n, round(avg(ms), 4) AS avg_ms FROM l WHERE level <> 'INFO' GROUP BY ALL
""")
def s9_log_lines(t: Tables) -> DataFrame:
    """Log text made from the events, every eleventh line damaged, parsed back with patterns."""
    lines = t.events.select(
        F.expr("""CASE WHEN event_id % 11 = 0 THEN concat('## ', event_type)
                  ELSE concat_ws(' ', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), CASE event_id % 4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARN' ELSE 'INFO' END,
                                 event_type, concat('user=', user_id), concat('ms=', event_id % 900)) END""").alias("value")
    )
    parsed = parse_log_lines(lines).where("ts IS NOT NULL AND level <> 'INFO'")
    return parsed.groupBy("level", "event").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("ms"), 4).alias("avg_ms"))
