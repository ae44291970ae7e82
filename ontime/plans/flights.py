"""A flight table derived from the order tables.

The query checks need flight records, and the given data has orders. This view
maps each order line to one flight with cancelled, diverted and impossible
records planted in it. One SQL text serves Spark and the SQL check engine; they
differ in the day-difference function only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROW_KEY = "RowKey"
TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "region")

SPARK_DAYS = "datediff(CAST(od AS DATE), DATE'1995-01-01')"
ANSI_DAYS = "date_diff('day', DATE '1995-01-01', CAST(od AS DATE))"

# Lines with their orders and customers: in the order of the names, or orders with
# customers first, so that the lines are dealt out once.
IN_ORDER = (
    "{lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey\n JOIN {customer} c ON o.o_custkey = c.c_custkey"
)
LINES_ONCE = (
    "{lineitem} l JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey"
)


def _clock(minute: str) -> str:
    """HHMM number of a minute-of-day expression."""
    return f"floor(({minute})/60)*100 + ({minute})%60"


def _block(minute: str) -> str:
    """One-hour block such as 0600-0659."""
    hour = f"lpad(CAST(CAST(floor(({minute})/60) AS INT) AS STRING),2,'0')"
    return f"concat({hour},'00-',{hour},'59')"


def _group(delay: str) -> str:
    """Delay in quarter hours, held within -2 and 12."""
    return f"CAST(greatest(least(CAST(floor(({delay})/15) AS INT),12),-2) AS DOUBLE)"


def flights_sql(days: str, tables: dict[str, str], lines: str = IN_ORDER) -> str:
    """The view as a query over the named tables; ``lines`` says how the three large
    ones are joined."""
    departed, arrived = "CASE WHEN NOT canc THEN", "CASE WHEN NOT canc AND NOT div_ THEN"
    t = tables
    return f"""
WITH b AS (
 SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_linenumber AS ln,
  CAST(l.l_quantity AS INT) AS q, l.l_extendedprice AS px, o.o_orderdate AS od,
  CAST((l.l_orderkey*37 + l.l_partkey*61 + l.l_linenumber*13) % 1440 AS INT) AS dm,
  CAST(60 + (l.l_partkey*7 + l.l_suppkey) % 300 AS INT) AS el,
  sn.n_name AS on_, cn.n_name AS dn, sn.n_nationkey AS ok_, cn.n_nationkey AS dk_,
  sr.r_name AS orr, cr.r_name AS drr
 FROM {lines.format(**t)}
 JOIN {t['supplier']} s ON l.l_suppkey = s.s_suppkey
 JOIN {t['nation']} sn ON s.s_nationkey = sn.n_nationkey
 JOIN {t['nation']} cn ON c.c_nationkey = cn.n_nationkey
 JOIN {t['region']} sr ON sn.n_regionkey = sr.r_regionkey
 JOIN {t['region']} cr ON cn.n_regionkey = cr.r_regionkey),
d AS (SELECT *, ok % 50 = 0 AS canc, ok % 200 = 1 AS div_,
  q - 40 + CAST(floor(dm/60) AS INT) + CAST((sk % 5)*4 AS INT) AS dd,
  CAST(pk % 21 AS INT) - 10 AS ad,
  CAST(month(od) AS INT) AS mo FROM b)
SELECT CAST(od AS DATE) AS FlightDate, concat('Airline ', CAST(sk % 12 AS STRING)) AS Airline,
 concat('AP', CAST(ok_ AS STRING)) AS Origin, concat('AP', CAST(dk_ AS STRING)) AS Dest,
 canc AS Cancelled, (div_ AND NOT canc) AS Diverted, CAST(year(od) AS INT) AS Year,
 CAST(quarter(od) AS INT) AS Quarter, mo AS Month, CAST(day(od) AS INT) AS DayofMonth,
 CAST(1 + ({days}) % 7 AS INT) AS DayOfWeek,
 concat('C', CAST(sk % 12 AS STRING)) AS Operating_Airline,
 CAST(10000+ok_ AS INT) AS OriginAirportID, concat(on_, ' City') AS OriginCityName,
 orr AS OriginState, on_ AS OriginStateName,
 CAST(10000+dk_ AS INT) AS DestAirportID, concat(dn, ' City') AS DestCityName,
 drr AS DestState, dn AS DestStateName,
 {departed} CASE WHEN dd >= 15 THEN 1.0E0 ELSE 0.0E0 END END AS DepDel15,
 {departed} {_group('dd')} END AS DepartureDelayGroups,
 {_block('dm')} AS DepTimeBlk,
 {arrived} {_group('dd+ad')} END AS ArrivalDelayGroups,
 {_block('(dm+el)%1440')} AS ArrTimeBlk,
 {arrived} CASE WHEN dd+ad >= 15 THEN 1.0E0 ELSE 0.0E0 END END AS ArrDel15,
 CAST(1 + floor(px/10000) AS INT) AS DistanceGroup,
 CAST({_clock('dm')} AS INT) AS CRSDepTime,
 {departed} CAST({_clock('(dm+dd+1440)%1440')} AS DOUBLE) END AS DepTime,
 {departed} CAST(greatest(dd,0) AS DOUBLE) END AS DepDelayMinutes,
 {departed} CAST(dd AS DOUBLE) END AS DepDelay,
 {arrived} CAST({_clock('(dm+el+dd+ad+1440)%1440')} AS DOUBLE) END AS ArrTime,
 {arrived} CAST(greatest(dd+ad,0) AS DOUBLE) END AS ArrDelayMinutes,
 {arrived} CAST(el+ad-20 AS DOUBLE) END AS AirTime,
 CASE WHEN pk % 499 = 0 THEN -5.0E0 ELSE CAST(el AS DOUBLE) END AS CRSElapsedTime,
 {arrived} CASE WHEN pk % 97 = 0 THEN -1.0E0 ELSE CAST(el+ad AS DOUBLE) END END AS ActualElapsedTime,
 CAST(floor(px/40) AS DOUBLE) AS Distance,
 {departed} CAST(8 + pk%15 AS DOUBLE) END AS TaxiOut,
 {departed} CAST({_clock('(dm+dd+10+1440)%1440')} AS DOUBLE) END AS WheelsOff,
 {arrived} CAST({_clock('(dm+el+dd+ad-5+1440)%1440')} AS DOUBLE) END AS WheelsOn,
 {arrived} CAST(3 + pk%9 AS DOUBLE) END AS TaxiIn,
 CAST({_clock('(dm+el)%1440')} AS INT) AS CRSArrTime,
 {arrived} CAST(dd+ad AS DOUBLE) END AS ArrDelay,
 CASE WHEN div_ AND NOT canc THEN 1.0E0 ELSE 0.0E0 END AS DivAirportLandings,
 concat_ws('|', CAST(ok AS STRING), CAST(pk AS STRING), CAST(sk AS STRING), CAST(ln AS STRING)) AS {ROW_KEY}
FROM d"""


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flights of a data folder: 44 columns and ``RowKey``.

    Join strategies are left to the optimizer: it broadcasts a side only below
    its size threshold and otherwise sorts, splitting skewed partitions. Orders meet
    their customers before the lines do, so no join moves the lines a second time.
    """
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    return spark.sql(flights_sql(SPARK_DAYS, {n: f"{{{n}}}" for n in TABLES}, LINES_ONCE), **tables)
