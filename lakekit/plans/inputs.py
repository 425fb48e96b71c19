"""A messy feed derived from the events: hand-typed meter readings, built the same way for both engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.clean import code, parse_amount, parse_ts, standardise
from lakekit.operators.windows import latest_per_key
from lakekit.session import Tables, stored

#: Fixed values of the feed: kinds of meters as they are typed, and the layouts of the time of reading.
_KINDS = ["Cold Water", "cold-water  ", "\tGAS", "gas", "District  Heat", "district_heat-"]
ISO, COMPACT = "yyyy-MM-dd'T'HH:mm:ss", "yyyyMMdd HHmm"

_READINGS = """
  SELECT event_id AS entry, CASE WHEN event_id % 83 <> 11 THEN event_id END AS reading_no, CASE WHEN event_id % 71 = 3 THEN -1 - user_id ELSE user_id END AS meter,
         CASE event_id % 6 {kinds} END AS kind, CAST(value AS DECIMAL(10,2)) AS exact,
         CASE event_id % 7 WHEN 0 THEN 'm3' WHEN 1 THEN ' M3 ' WHEN 2 THEN 'kWh' WHEN 3 THEN 'KWH' ELSE 'mwh ' END AS unit,
         {iso} AS iso, {compact} AS compact, CASE event_type WHEN 'error' THEN 'estimated' ELSE 'read' END AS state, 4 * event_id AS revision
  FROM {events}
"""
_TYPED_IN = """
  SELECT entry, reading_no, meter, kind,
         CASE WHEN entry % 53 = 5 THEN '' WHEN entry % 47 = 2 THEN 'no display' WHEN entry % 37 = 1 THEN concat('-', CAST(exact AS {string}), ' back-flow')
              WHEN entry % 29 = 4 THEN NULL WHEN entry % 29 = 9 THEN '12 or 13' WHEN entry % 5 < 2 THEN concat(CAST(exact AS {string}), 'm3') WHEN entry % 5 = 2 THEN concat('ca. ', CAST(exact AS {string}))
              ELSE CAST(exact AS {string}) END AS shown,
         unit, CASE WHEN entry % 61 = 8 THEN 'last week' WHEN entry % 3 = 1 THEN compact ELSE iso END AS taken, state, revision
  FROM {base}
"""
_CORRECTED = """
  SELECT entry, reading_no, meter, kind, '1.00' AS shown, unit, taken, 'corrected' AS state, revision + 2 AS revision FROM {base} WHERE reading_no % 23 = 6
  UNION ALL SELECT * FROM {base} WHERE reading_no % 31 = 7
"""


def _kinds() -> str:
    return " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS))


READINGS_SQL = (
    "readings0 AS (" + _READINGS.format(kinds=_kinds(), events="events", iso="strftime(ts, '%Y-%m-%dT%H:%M:%S')", compact="strftime(ts, '%Y%m%d %H%M')")
    + "), readings1 AS (" + _TYPED_IN.format(base="readings0", string="VARCHAR")
    + "), readings AS (SELECT * FROM readings1 UNION ALL " + _CORRECTED.format(base="readings1") + ")"
)

#: The columns of ``readings`` cleaned, in the other engine's functions.
KIND_SQL = r"regexp_replace(regexp_replace(lower(kind), '^[\s_-]+|[\s_-]+$', '', 'g'), '[\s_-]+', '_', 'g')"
UNIT_SQL = "upper(trim(unit))"
VOLUME_SQL = """CASE WHEN regexp_matches(shown, '^(ca\\. )?-?[0-9]+\\.[0-9]{2}(m3)?$') THEN TRY_CAST(regexp_extract(shown, '-?[0-9]+\\.[0-9]+') AS DECIMAL(10,2))
  WHEN shown LIKE '%back-flow' THEN TRY_CAST(regexp_extract(shown, '-?[0-9]+\\.[0-9]+') AS DECIMAL(10,2)) END"""
TAKEN_SQL = "coalesce(try_strptime(taken, '%Y-%m-%dT%H:%M:%S'), try_strptime(taken, '%Y%m%d %H%M'))"

#: The cleaned feed with the latest state of each reading.
CLEAN_SQL = READINGS_SQL + f""",
 typed AS (SELECT entry, reading_no, meter, {KIND_SQL} AS kind, {VOLUME_SQL} AS volume, {UNIT_SQL} AS unit, {TAKEN_SQL} AS taken_at, state, revision FROM readings),
 clean AS (SELECT DISTINCT * FROM typed WHERE reading_no IS NOT NULL QUALIFY row_number() OVER (PARTITION BY reading_no ORDER BY revision DESC) = 1)
"""


def readings(t: Tables) -> DataFrame:
    """Readings with spelling variants, units glued to values, unreadable and missing values, back-flow (negative), two layouts of
    the time, lost numbers, unknown meters, corrections and exact copies."""
    base = t.spark.sql(
        _READINGS.format(kinds=_kinds(), events="{events}", iso="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")", compact="date_format(ts, 'yyyyMMdd HHmm')"),
        events=t.events)
    typed_in = t.spark.sql(_TYPED_IN.format(base="{base}", string="STRING"), base=base)
    return typed_in.unionAll(t.spark.sql(_CORRECTED.format(base="{base}"), base=typed_in))


def clean_readings(t: Tables) -> DataFrame:
    typed = readings(t).select(
        "entry", "reading_no", "meter", standardise("kind").alias("kind"), parse_volume("shown").alias("volume"), code("unit").alias("unit"),
        parse_ts("taken", ISO, COMPACT).alias("taken_at"), "state", "revision")
    return latest_per_key(typed.where("reading_no IS NOT NULL"), ["reading_no"], ["revision"])


def parse_volume(column: str) -> Column:
    """The number of a typed-in value, its glued unit aside."""
    return parse_amount(F.regexp_replace(column, "m3$", ""))


def stored_readings(t: Tables) -> DataFrame:
    """The cleaned feed, written once for queries that read it several times."""
    return stored(clean_readings(t), "readings")
