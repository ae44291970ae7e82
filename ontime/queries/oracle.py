"""The same queries in SQL, over the raw tables, for a value check by another engine."""

from __future__ import annotations

from ontime import config
from ontime.functions import share_limit
from ontime.operators.encode import index_name, scaled_name, vector_name
from ontime.plans.flights import ANSI_DAYS, ROW_KEY, TABLES, flights_sql
from ontime.queries import stages, tables
from ontime.queries.tables import CATEGORIES

KEY = ROW_KEY
LATE = config.LATE_MINUTES
FEATURE_COLUMNS = [
    "Year", "Month", "DayofMonth", "DayOfWeek", "Operating_Airline", "OriginAirportID",
    "OriginCityName", "OriginStateName", "DestAirportID", "DestCityName", "DestStateName",
    "DistanceGroup", "CRSElapsedTime", "Distance", "label", "ScheduledArrTimeOfDay",
    "ScheduledDepTimeOfDay", "Season",
]
INTEGERS = [
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "OriginAirportID", "DestAirportID",
    "DistanceGroup", "CRSDepTime", "CRSArrTime",
]
DOUBLES = [
    "DepDel15", "DepartureDelayGroups", "ArrivalDelayGroups", "ArrDel15",
    *[c for c in config.NUMERICAL_COLUMNS if c not in ("CRSDepTime", "CRSArrTime")],
]
RAW_NUMERIC = [c for c in config.FLIGHT_COLUMNS if c in INTEGERS + DOUBLES]
CLEAN_NUMERIC = [c for c in RAW_NUMERIC if c not in config.CLEAN_CASTS]


def _names(columns: list[str]) -> str:
    return ", ".join(columns)


def _time_of_day(column: str) -> str:
    hour = f"floor({column} / 100)"
    return (
        f"CASE WHEN {hour} >= 5 AND {hour} < 12 THEN 1 WHEN {hour} >= 12 AND {hour} < 17 THEN 2 "
        f"WHEN {hour} >= 17 AND {hour} < 21 THEN 3 ELSE 4 END"
    )


SEASON = "CASE WHEN Month IN (12, 1, 2) THEN 1 WHEN Month IN (3, 4, 5) THEN 2 WHEN Month IN (6, 7, 8) THEN 3 ELSE 4 END"


def _bucket(seed: object, buckets: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || {KEY}), 1, 8) AS BIGINT) % {buckets}"


def _hash(seed: object) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || {KEY}), 1, 15) AS BIGINT)"


def _not_null(columns: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


_score = " + ".join(
    [f"{stages.SCORE_INTERCEPT}E0", *[f"{w}E0 * {c}" for c, w in stages.SCORE_WEIGHTS.items()]]
)

# Each step of the pipeline over the one before it.
STEPS = {
    "flights": flights_sql(ANSI_DAYS, {t: t for t in TABLES}),
    "cleaned": f"""SELECT * REPLACE (DepDel15 <> 0 AS DepDel15, ArrDel15 <> 0 AS ArrDel15,
        CAST(OriginAirportID AS VARCHAR) AS OriginAirportID, CAST(DestAirportID AS VARCHAR) AS DestAirportID)
        FROM flights WHERE {_not_null(config.FLIGHT_COLUMNS)} AND ActualElapsedTime >= 0""",
    "yearly": "SELECT *, concat('flights_', CAST(Year AS VARCHAR), '.parquet') AS source_file FROM cleaned",
    "model_input": f"""SELECT * EXCLUDE (DivAirportLandings)
        REPLACE (CAST(ArrDel15 AS INT) AS ArrDel15, CAST(DepDel15 AS INT) AS DepDel15),
        CASE WHEN ArrDelayMinutes > {LATE} THEN 1 ELSE 0 END AS label
        FROM cleaned WHERE CRSElapsedTime >= 0""",
    "featured": f"""SELECT {KEY}, {_names([c for c in FEATURE_COLUMNS if c not in ('ScheduledArrTimeOfDay', 'ScheduledDepTimeOfDay', 'Season')])},
        {_time_of_day('CRSArrTime')} AS ScheduledArrTimeOfDay, {_time_of_day('CRSDepTime')} AS ScheduledDepTimeOfDay,
        {SEASON} AS Season FROM model_input""",
    "parted": f"""SELECT *, CASE WHEN {_hash(config.SEED)} < {share_limit(0.7)} THEN 0 ELSE 1 END AS part FROM featured""",
    "scored": f"""SELECT *, CASE WHEN probability > 0.5E0 THEN 1.0E0 ELSE 0.0E0 END AS prediction FROM
        (SELECT *, round(1.0E0 / (1.0E0 + exp(-({_score}))), 12) AS probability FROM featured)""",
}
# Steps each step reads.
BEFORE = {
    "flights": [], "cleaned": ["flights"], "yearly": ["cleaned"], "model_input": ["cleaned"],
    "featured": ["model_input"], "parted": ["featured"], "scored": ["featured"],
}


def _needed(step: str) -> list[str]:
    order: list[str] = []
    for earlier in BEFORE[step]:
        order += [s for s in _needed(earlier) if s not in order]
    return [*order, step]


def query(step: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` after the pipeline up to ``step`` and any extra named tables."""
    named = {s: STEPS[s] for s in _needed(step)} | (extra or {})
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in named.items()) + f"\n{body}"


def _no_dates(source: str) -> str:
    return f"SELECT * REPLACE (CAST(FlightDate AS VARCHAR) AS FlightDate) FROM {source}"


def _casts(columns: list[str], kind: str) -> str:
    return ", ".join(f"CAST({c} AS {kind}) AS {c}" for c in columns)


def _numbers(columns: list[str], source: str, ids: str = "") -> dict[str, str]:
    """Named table ``longs``: (ids, column, value), nulls left out."""
    return {
        "numbers": f"SELECT {ids}{_casts(columns, 'DOUBLE')} FROM {source}",
        "longs": f'SELECT * FROM (UNPIVOT numbers ON {_names(columns)} INTO NAME "column" VALUE value)',
    }


def _texts(columns: list[str], source: str, ids: str = "") -> dict[str, str]:
    """Named table ``cells``: (ids, column, value as text), nulls left out."""
    return {
        "texts": f"SELECT {ids}{_casts(columns, 'VARCHAR')} FROM {source}",
        "cells": f'SELECT * FROM (UNPIVOT texts ON {_names(columns)} INTO NAME "column" VALUE value)',
    }


def _quartiles(value: str = "value") -> str:
    marks = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    return ", ".join(f"round(quantile_cont({value}, {p}), 6) AS {name}" for name, p in marks)


STATISTICS = (
    "round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, "
    "round(min(value), 6) AS min, round(max(value), 6) AS max"
)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _file_counts(names: list[str]) -> str:
    return _union([f"SELECT '{n}.parquet' AS source_file, count(*) AS n_rows FROM {n}" for n in names])


ALL_TABLES = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
]


def _replace_dates(table: str, column: str) -> str:
    return f"SELECT * REPLACE (CAST(CAST({column} AS DATE) AS VARCHAR) AS {column}) FROM {table}"


def _value_counts(step: str, column: str) -> str:
    return query(step, f"SELECT {column}, count(*) AS n FROM {step} GROUP BY {column}")


def _categorical_profile() -> str:
    parts = [
        f"""SELECT source_file, '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
        CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max,
        count(*) - count({c}) AS n_missing FROM yearly GROUP BY source_file"""
        for c in config.CATEGORICAL_COLUMNS
    ]
    return query("yearly", _union(parts))


def _missing_numbers(source: str) -> str:
    missing = _union(
        [
            f"""SELECT source_file, '{c}' AS "column", count(*) - count({c}) AS n_missing FROM {source} GROUP BY source_file"""
            for c in CLEAN_NUMERIC
        ]
    )
    return query(
        source,
        f"""SELECT l.*, m.n_missing FROM (SELECT source_file, "column", {STATISTICS} FROM longs GROUP BY source_file, "column") l
        JOIN ({missing}) m USING (source_file, "column")""",
        _numbers(CLEAN_NUMERIC, source, "source_file, "),
    )


def _profile() -> str:
    raw = config.FLIGHT_COLUMNS
    described = f'SELECT "column", {STATISTICS}, {_quartiles()} FROM longs GROUP BY "column"'
    counts = _union([f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) AS total FROM flights""" for c in raw])
    kinds = [("integer_type", INTEGERS), ("float_type", DOUBLES)]
    flags = [f"""SELECT '{m}' AS metric, '{c}' AS "column", 1.0E0 AS value""" for m, cols in kinds for c in cols]
    body = _union(
        [
            'SELECT metric, "column", value FROM (UNPIVOT described ON mean, std, min, max, p25, p50, p75 INTO NAME metric VALUE value)',
            """SELECT 'values' AS metric, "column", CAST(n AS DOUBLE) AS value FROM counts""",
            """SELECT 'has_nulls' AS metric, "column", 1.0E0 AS value FROM counts WHERE n < total""",
            f"""SELECT 'rows_with_nulls' AS metric, '*' AS "column", CAST(count(*) AS DOUBLE) AS value FROM flights WHERE NOT ({_not_null(raw)})""",
            f"""SELECT 'duplicate_rows' AS metric, '*' AS "column", CAST(coalesce(sum(n - 1), 0) AS DOUBLE) AS value
            FROM (SELECT count(*) AS n FROM flights GROUP BY {_names(raw)})""",
            *flags,
        ]
    )
    return query("flights", body, {**_numbers(RAW_NUMERIC, "flights"), "described": described, "counts": counts})


def _scatter() -> str:
    x, ys, bins = config.SCATTER_X, config.SCATTER_Y, tables.SCATTER_BINS

    def cell(value: str, low: str, high: str) -> str:
        inner = f"least(floor(({value} - {low}) * {bins}.0E0 / ({high} - {low})), {bins - 1})"
        return f"CAST(CASE WHEN {low} = {high} THEN 0 ELSE {inner} END AS INT)"

    extra = {
        "numbers": f"SELECT {x} AS x, {_casts(ys, 'DOUBLE')} FROM flights",
        "points": f"SELECT * FROM (UNPIVOT numbers ON {_names(ys)} INTO NAME y VALUE v)",
        "ybounds": "SELECT y, min(v) AS lo, max(v) AS hi FROM points GROUP BY y",
        "xbounds": f"SELECT min({x}) AS xlo, max({x}) AS xhi FROM flights",
    }
    return query(
        "flights",
        f"""SELECT y, {cell('x', 'xlo', 'xhi')} AS x_bin, {cell('v', 'lo', 'hi')} AS y_bin, count(*) AS n
        FROM points JOIN ybounds USING (y), xbounds WHERE x IS NOT NULL GROUP BY ALL""",
        extra,
    )


CONFUSION = """SELECT l.label, count(*) FILTER (WHERE s.prediction = 0) AS pred_0, count(*) FILTER (WHERE s.prediction = 1) AS pred_1
    FROM (VALUES (0.0E0), (1.0E0)) l(label) LEFT JOIN scored s ON s.label = l.label GROUP BY l.label"""


def _correlation() -> str:
    pairs = [(a, b) for a in config.CORRELATION_COLUMNS for b in config.CORRELATION_COLUMNS]
    values = {(a, b): "max(1.0E0)" if a == b else f"round(corr({a}, {b}), 6)" for a, b in pairs}
    return _union([f"SELECT '{a}' AS a, '{b}' AS b, {r} AS r FROM model_input" for (a, b), r in values.items()])


def _contingency(columns: list[str], source: str = "featured") -> dict[str, str]:
    """(column, category, o, n per label), empty cells included."""
    return {
        "texts": f"SELECT label, {_casts(columns, 'VARCHAR')} FROM {source}",
        "cells": f'SELECT label, "column", value FROM (UNPIVOT texts ON {_names(columns)} INTO NAME "column" VALUE value)',
        "observed": """SELECT "column", value, count(*) FILTER (WHERE label = 0) AS o0,
            count(*) FILTER (WHERE label = 1) AS o1 FROM cells GROUP BY "column", value""",
        "totals": """SELECT "column", CAST(sum(o0) AS DOUBLE) AS n0, CAST(sum(o1) AS DOUBLE) AS n1,
            CAST(sum(o0 + o1) AS DOUBLE) AS n, count(*) AS k FROM observed GROUP BY "column" """,
        "joined": """SELECT *, o0 + o1 AS r FROM observed JOIN totals USING ("column")""",
    }


def _chi(o: str, e: str) -> str:
    return f"({o} - {e}) * ({o} - {e}) / ({e})"


CHI_TABLE = f"""SELECT "column", round(sum({_chi('o0', '(r * n0 / n)')} + {_chi('o1', '(r * n1 / n)')}), 4) AS statistic,
    CAST(max(k) - 1 AS INT) AS dof FROM joined GROUP BY "column" """

CHI_SLOTS = f"""SELECT concat("column", 'Vector_', value) AS feature,
    round({_chi('o0', '(r * n0 / n)')} + {_chi('o1', '(r * n1 / n)')}
    + {_chi('(n0 - o0)', '((n - r) * n0 / n)')} + {_chi('(n1 - o1)', '((n - r) * n1 / n)')}, 4) AS statistic,
    CAST(1 AS INT) AS dof FROM joined"""


def _ranks(source: str = "featured") -> dict[str, str]:
    """One table per text category: value and its index by falling frequency."""
    return {
        f"rank_{c}": f"""SELECT CAST({c} AS VARCHAR) AS v,
        row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS idx FROM {source} GROUP BY {c}"""
        for c in config.STRING_CATEGORIES
    }


def _rank_joins() -> str:
    return " ".join(
        f"JOIN rank_{c} ON rank_{c}.v = CAST(f.{c} AS VARCHAR)" for c in config.STRING_CATEGORIES
    )


def _widths(source: str = "featured") -> list[str]:
    """Slots per category column, as scalar subqueries."""
    return [
        *[f"(SELECT count(*) + 1 FROM rank_{c})" for c in config.STRING_CATEGORIES],
        *[f"(SELECT max({c}) + 1 FROM {source})" for c in config.INTEGER_CATEGORIES],
    ]


def _width_table(source: str = "featured") -> dict[str, str]:
    columns = [f"{w} AS w{i}" for i, w in enumerate(_widths(source))]
    return {"widths": f"SELECT {', '.join(columns)}"}


def _total_width() -> str:
    return " + ".join(f"w{i}" for i in range(len(CATEGORIES))) + f" + {len(config.CONTINUOUS_COLUMNS)}"


def _active() -> str:
    slots = [*[f"rank_{c}.idx" for c in config.STRING_CATEGORIES], *[f"f.{c}" for c in config.INTEGER_CATEGORIES]]
    positions = []
    for i, slot in enumerate(slots):
        offset = " + ".join([f"w{j}" for j in range(i)] + [slot])
        positions.append(f"CAST({offset} AS VARCHAR)")
    return f"concat_ws('|', {', '.join(positions)})"


def _scaled(column: str, source: str) -> str:
    low, high = f"(SELECT min({column}) FROM {source})", f"(SELECT max({column}) FROM {source})"
    return f"round((f.{column} - {low}) / ({high} - {low}), 6)"


def _vectors(source: str, rows: str) -> str:
    body = f"""SELECT f.{KEY}, CAST({_total_width()} AS INT) AS n_slots, {_active()} AS active,
        {_scaled('CRSElapsedTime', source)} AS scaled_elapsed, {_scaled('Distance', source)} AS scaled_distance
        FROM {rows} f {_rank_joins()}, widths"""
    extra = {"train": "SELECT * FROM parted WHERE part = 0", **_ranks(source), **_width_table(source)}
    return query("parted", body, extra)


EARLY_YEARS = 1998
PART_SIZES = query(
    "parted",
    f"""SELECT CASE WHEN part = 0 THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows,
    CAST(sum(label) AS BIGINT) AS n_late, CAST(max({_total_width()}) AS INT) AS n_slots
    FROM parted, widths GROUP BY ALL""",
    {"train": "SELECT * FROM parted WHERE part = 0", **_ranks("train"), **_width_table("train")},
)


def _slots() -> dict[str, str]:
    """Named table ``slots``: index, kind and name of each slot of the training vector."""
    parts = []
    for i, c in enumerate(CATEGORIES):
        offset = " + ".join(["0"] + [f"w{j}" for j in range(i)])
        if c in config.STRING_CATEGORIES:
            parts.append(f"SELECT {offset} + idx AS idx, 'binary' AS kind, '{vector_name(c)}_' || v AS name FROM rank_{c}, widths")
            parts.append(f"SELECT {offset} + w{i} - 1, 'binary', '{vector_name(c)}___unknown' FROM widths")
        else:
            parts.append(
                f"SELECT {offset} + s, 'binary', concat('{vector_name(c)}_', s) FROM (SELECT *, unnest(range(w{i})) AS s FROM widths)"
            )
    for k, c in enumerate(config.CONTINUOUS_COLUMNS):
        offset = " + ".join(f"w{j}" for j in range(len(CATEGORIES)))
        parts.append(f"SELECT {offset} + {k}, 'numeric', '{scaled_name(c)}_0' FROM widths")
    slots = f"SELECT CAST(idx AS INT) AS idx, kind, name FROM ({_union(parts)})"
    return {"train": "SELECT * FROM parted WHERE part = 0", **_ranks("train"), **_width_table("train"), "slots": slots}


def _slot_tests(select: str) -> str:
    """Chi-square of every training slot from counts; a slot without rows has none."""
    columns = [*CATEGORIES, *config.CONTINUOUS_COLUMNS]
    continuous = ", ".join(f"'{c}'" for c in config.CONTINUOUS_COLUMNS)
    tests = f"""SELECT feature AS name, statistic, dof FROM ({CHI_SLOTS} WHERE r < n AND "column" NOT IN ({continuous}))
        UNION ALL SELECT concat("column", 'Scaled_0'), statistic, dof FROM ({CHI_TABLE}) WHERE "column" IN ({continuous})"""
    extra = {**_slots(), **_contingency(columns, "train"), "tests": tests}
    body = f"""SELECT {select}, coalesce(statistic, 0.0E0) AS statistic, CAST(coalesce(dof, 0) AS INT) AS dof
        FROM slots LEFT JOIN tests USING (name)"""
    return query("parted", body, extra)


def _folds() -> dict[str, str]:
    """Named table ``folds``: rows and late rows of each training fold, as one text."""
    return {
        "sizes": f"""SELECT {_bucket(f"fold {config.SEED}", config.FOLDS)} AS fold, count(*) AS n,
            CAST(sum(label) AS BIGINT) AS late FROM parted WHERE part = 0 GROUP BY 1""",
        "folds": "SELECT string_agg(concat(fold, ':', n, ':', late), '|' ORDER BY fold) AS folds FROM sizes",
    }


def _grid() -> str:
    points = [(r, e) for r in config.REG_PARAMS for e in config.ELASTIC_NET_PARAMS]
    values = ", ".join(
        f"""({i}, '{{"elasticNetParam": {e}, "regParam": {r}}}')""" for i, (r, e) in enumerate(points)
    )
    return f"(VALUES {values}) g(position, params)"


def _summary() -> str:
    numbers = [c for c in FEATURE_COLUMNS if c in RAW_NUMERIC and c not in config.CLEAN_CASTS]
    numbers += ["label", "ScheduledArrTimeOfDay", "ScheduledDepTimeOfDay", "Season"]
    return query(
        "featured",
        f'''SELECT "column", count(*) AS n_values, {STATISTICS}, true AS p25, true AS p50, true AS p75
        FROM longs GROUP BY "column"''',
        _numbers(numbers, "featured"),
    )


def _roc(bins: int, select: str) -> str:
    return query(
        "scored",
        f"SELECT {select} FROM points",
        {
            "binned": f"""SELECT CAST(floor(probability * {bins}) AS BIGINT) AS b, count(*) FILTER (WHERE label = 1) AS pos,
                count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY 1
                UNION ALL SELECT {bins + 1}, 0, 0""",
            "points": f"""SELECT round(b / {bins}.0E0, 6) AS threshold,
                round(CAST(sum(neg) OVER w AS DOUBLE) / sum(neg) OVER (), 6) AS fpr,
                round(CAST(sum(pos) OVER w AS DOUBLE) / sum(pos) OVER (), 6) AS tpr FROM binned
                WINDOW w AS (ORDER BY b DESC)""",
        },
    )


DUPLICATES = "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM flights GROUP BY {})"

ORACLE = {
    # Scans, sources, sinks
    "scan_landing": f"SELECT *, 'orders.parquet' AS source_file FROM ({_replace_dates('orders', 'o_orderdate')})",
    "scan_cleaned": _replace_dates("lineitem", "l_shipdate"),
    "scan_until": _file_counts([t for t in ALL_TABLES if f"{t}.parquet" <= tables.LAST_FILE]),
    "write_cleaned": query("cleaned", _no_dates("cleaned")),
    "chart_sink": _value_counts("featured", "ScheduledDepTimeOfDay"),
    "shape_profile": query(
        "flights",
        f"""SELECT {len(config.FLIGHT_COLUMNS) + 1} AS n_columns, (SELECT count(*) FROM flights) AS n_rows, column_name AS "column",
        CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS type
        FROM (DESCRIBE {query('flights', 'SELECT * FROM flights')})""",
    ),
    "write_trusted": PART_SIZES,
    "read_trusted": query("parted", f"SELECT {KEY}, CAST(label AS DOUBLE) AS label FROM parted WHERE part = 0"),
    "save_model": query("parted", "SELECT count(*) AS n_rows, count(*) AS n_same FROM parted WHERE part = 1"),
    # Projections
    "select_relevant": query("flights", f"SELECT * EXCLUDE ({KEY}) FROM ({_no_dates('flights')})"),
    "drop_columns": query("flights", f"SELECT * EXCLUDE (DivAirportLandings) FROM ({_no_dates('flights')})"),
    "to_bool": query(
        "flights",
        f"SELECT {KEY}, DepDel15 <> 0 AS DepDel15, ArrDel15 <> 0 AS ArrDel15 FROM flights WHERE {_not_null(['DepDel15', 'ArrDel15'])}",
    ),
    "ids_to_string": query("flights", f"SELECT {KEY}, {_casts(['OriginAirportID', 'DestAirportID'], 'VARCHAR')} FROM flights"),
    "objects_to_string": query("flights", _no_dates("flights")),
    "flags_to_int": query("cleaned", f"SELECT {KEY}, {_casts(['ArrDel15', 'DepDel15'], 'INT')} FROM cleaned"),
    "delay_groups_to_int": query(
        "cleaned", f"SELECT {KEY}, {_casts(['DepartureDelayGroups', 'ArrivalDelayGroups'], 'INT')} FROM cleaned"
    ),
    "label_to_double": query("model_input", f"SELECT {KEY}, CAST(label AS DOUBLE) AS label FROM model_input"),
    "columns_by_type": query(
        "flights",
        _union(
            [
                f"""SELECT '{c}' AS "column", '{'integer' if c in INTEGERS else 'float' if c in DOUBLES else 'other' if c in ('FlightDate', 'Cancelled', 'Diverted') else 'object'}' AS type_class,
                count({c}) AS n_values FROM flights"""
                for c in [*config.FLIGHT_COLUMNS, KEY]
            ]
        ),
    ),
    "preview": query("cleaned", f"{_no_dates('cleaned')} ORDER BY {KEY} LIMIT 30"),
    # Filters and predicates
    "drop_nulls": query("flights", f"{_no_dates('flights')} WHERE {_not_null(config.FLIGHT_COLUMNS)}"),
    "filter_actual_elapsed": query("flights", f"SELECT {KEY}, ActualElapsedTime FROM flights WHERE ActualElapsedTime >= 0"),
    "filter_crs_elapsed": query("flights", f"SELECT {KEY}, CRSElapsedTime FROM flights WHERE CRSElapsedTime >= 0"),
    "count_zero_delay": query("model_input", "SELECT count(*) AS n_zero_delay FROM model_input WHERE ArrDelayMinutes = 0"),
    "sample_rows": query("flights", f"SELECT {KEY}, Airline, Distance FROM flights WHERE {_hash(config.SEED)} < {share_limit(0.1)}"),
    "clean_flights": query("cleaned", _no_dates("cleaned")),
    "clean_for_model": query("model_input", _no_dates("model_input")),
    "row_count_audit": query(
        "flights",
        _union(
            [
                "SELECT 0 AS position, 'all' AS step, count(*) AS n_rows FROM flights",
                f"SELECT 1, 'no_nulls', count(*) FROM flights WHERE {_not_null(config.FLIGHT_COLUMNS)}",
                f"SELECT 2, 'crs_elapsed', count(*) FROM flights WHERE {_not_null(config.FLIGHT_COLUMNS)} AND CRSElapsedTime >= 0",
            ]
        ),
    ),
    # Derived columns
    "label_late": query(
        "flights", f"SELECT {KEY}, ArrDelayMinutes, CASE WHEN ArrDelayMinutes > {LATE} THEN 1 ELSE 0 END AS label FROM flights"
    ),
    "hour_from_hhmm": query(
        "flights",
        f"SELECT {KEY}, CAST(floor(CRSDepTime / 100) AS INT) AS dep_hour, CAST(floor(CRSArrTime / 100) AS INT) AS arr_hour FROM flights",
    ),
    "time_of_day": query("flights", f"SELECT {KEY}, {_time_of_day('DepTime')} AS DepTimeOfDay FROM flights"),
    "time_of_day_pair": query(
        "flights",
        f"SELECT {KEY}, {_time_of_day('CRSArrTime')} AS ScheduledArrTimeOfDay, {_time_of_day('CRSDepTime')} AS ScheduledDepTimeOfDay FROM flights",
    ),
    "season": query("flights", f"SELECT {KEY}, Month, {SEASON} AS Season FROM flights"),
    "features_table": query("featured", "SELECT * FROM featured"),
    "zone_rename": f"""SELECT n_rows, replace('landing/' || source_file, 'landing/', 'cleaned/') AS target,
        source_file LIKE '%.parquet' AS is_parquet FROM ({_file_counts(ALL_TABLES)})""",
    # Aggregations and profiling
    "non_null_counts": query(
        "flights", _union([f"""SELECT '{c}' AS "column", count({c}) AS n_values FROM flights""" for c in [*config.FLIGHT_COLUMNS, KEY]])
    ),
    "null_counts": query(
        "flights",
        _union([f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_nulls FROM flights""" for c in [*config.FLIGHT_COLUMNS, KEY]]),
    ),
    "columns_with_nulls": query(
        "flights",
        _union([f"""SELECT '{c}' AS "column" FROM flights HAVING count({c}) < count(*)""" for c in [*config.FLIGHT_COLUMNS, KEY]]),
    ),
    "rows_with_nulls": query("flights", f"SELECT count(*) AS n_rows FROM flights WHERE NOT ({_not_null(config.FLIGHT_COLUMNS)})"),
    "duplicate_count": query("flights", DUPLICATES.format(_names(config.FLIGHT_COLUMNS))),
    "duplicate_count_exact": query("flights", DUPLICATES.format(_names(config.FLIGHT_COLUMNS))),
    "duplicate_count_subset": query("flights", DUPLICATES.format("Origin, Dest, Month")),
    "describe_all": query(
        "flights",
        f'SELECT "column", count(*) AS n_values, {STATISTICS}, {_quartiles()} FROM longs GROUP BY "column"',
        _numbers(RAW_NUMERIC, "flights"),
    ),
    "describe_column": query(
        "flights",
        f'SELECT "column", count(*) AS n_values, {STATISTICS} FROM longs GROUP BY "column"',
        _numbers(["ArrDelayMinutes"], "flights"),
    ),
    "profile_numeric": _missing_numbers("yearly"),
    "profile_categorical": _categorical_profile(),
    "profile_all": _profile(),
    "row_count": query("flights", "SELECT count(*) AS n_rows FROM flights"),
    "value_counts": _value_counts("model_input", "ArrDel15"),
    "label_distribution": _value_counts("model_input", "label"),
    "distinct_values": query("model_input", "SELECT count(DISTINCT Operating_Airline) AS n_distinct FROM model_input"),
    "confusion_pivot": query("scored", CONFUSION),
    "fill_zero": query(
        "flights", f"SELECT {KEY}, " + ", ".join(f"coalesce({c}, 0.0E0) AS {c}" for c in tables.NULLABLE) + " FROM flights"
    ),
    # Chart tables
    "bar_counts": _value_counts("featured", "ScheduledArrTimeOfDay"),
    "bar_counts_many": query(
        "cleaned",
        'SELECT "column", value, count(*) AS n FROM cells GROUP BY "column", value',
        _texts(config.CHART_CATEGORIES, "cleaned"),
    ),
    "histogram_unit": query(
        "flights",
        'SELECT "column", CAST(floor(value + 0.5E0) AS BIGINT) AS bin, count(*) AS n FROM longs GROUP BY ALL',
        _numbers(tables.HISTOGRAM_COLUMNS, "flights"),
    ),
    "scatter_grid": _scatter(),
    "heatmap_long": query(
        "scored",
        """SELECT CASE WHEN label = 1 THEN '1.0' ELSE '0.0' END AS "row", 'pred_0' AS "column", CAST(pred_0 AS DOUBLE) AS value FROM confusion
        UNION ALL SELECT CASE WHEN label = 1 THEN '1.0' ELSE '0.0' END, 'pred_1', CAST(pred_1 AS DOUBLE) FROM confusion
        UNION ALL SELECT a, b, r FROM pairs""",
        {"confusion": CONFUSION, "pairs": _correlation()},
    ),
    "roc_chart": _roc(100, "fpr AS x, tpr AS y, threshold"),
    "chi_square_top20": query(
        "featured", "SELECT * FROM slots ORDER BY statistic DESC, feature LIMIT 20", {**_contingency(CATEGORIES), "slots": CHI_SLOTS}
    ),
    # Sorts, limits, top-k
    "sort_by_value": _value_counts("featured", "Season"),
    "sort_by_label": query("scored", CONFUSION),
    "top_k": query("flights", f"SELECT {KEY}, Airline, Distance FROM flights ORDER BY Distance DESC, {KEY} LIMIT 20"),
    "bottom_k": query("flights", f"SELECT {KEY}, Airline, Distance FROM flights ORDER BY Distance, {KEY} LIMIT 10"),
    "arg_best": query(
        "scored",
        """SELECT c.cutoff, round(avg(CASE WHEN (s.probability > c.cutoff) = (s.label = 1) THEN 1.0E0 ELSE 0.0E0 END), 6) AS accuracy
        FROM scored s, (VALUES (0.3E0), (0.4E0), (0.5E0), (0.6E0), (0.7E0)) c(cutoff)
        GROUP BY c.cutoff ORDER BY accuracy DESC, cutoff LIMIT 1""",
    ),
    # Split
    "split_train_test": query("parted", f"SELECT {KEY}, label, part FROM parted"),
    "score_fixed": query("scored", f"SELECT {KEY}, label, round(probability, 6) AS probability, prediction FROM scored"),
    # Encoding and scaling
    "string_index": query(
        "featured",
        f"SELECT f.{KEY}, "
        + ", ".join(f"CAST(rank_{c}.idx AS DOUBLE) AS {index_name(c)}" for c in config.STRING_CATEGORIES)
        + f" FROM featured f {_rank_joins()}",
        _ranks(),
    ),
    "category_dictionary": query(
        "featured",
        " UNION ALL ".join(
            f"""SELECT '{name}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n,
            row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS idx FROM featured GROUP BY {c}"""
            for c, name in [*[(c, c) for c in config.STRING_CATEGORIES], (KEY, "KeyText")]
        ),
    ),
    "dictionary_index": query(
        "featured",
        f"SELECT f.{KEY}, "
        + ", ".join(f"CAST(rank_{c}.idx AS DOUBLE) AS {index_name(c)}" for c in config.STRING_CATEGORIES)
        + f""", CAST(rank_key.idx AS DOUBLE) AS {index_name("KeyText")}
        FROM featured f {_rank_joins()} JOIN rank_key ON rank_key.v = f.{KEY}""",
        _ranks() | {
            "rank_key": f"""SELECT {KEY} AS v, row_number() OVER (ORDER BY count(*) DESC, {KEY}) - 1 AS idx
            FROM featured GROUP BY {KEY}"""
        },
    ),
    "encode_onehot": query(
        "featured",
        f"SELECT f.{KEY}, "
        + ", ".join(f"CAST(rank_{c}.idx AS INT) AS {c}" for c in config.STRING_CATEGORIES)
        + f", {_names(['f.' + c for c in config.INTEGER_CATEGORIES])} FROM featured f {_rank_joins()}",
        _ranks(),
    ),
    "vectorize_continuous": query(
        "featured",
        f"SELECT {KEY}, " + ", ".join(f"{c} AS {vector_name(c)}" for c in config.CONTINUOUS_COLUMNS) + " FROM featured",
    ),
    "minmax_scale": query(
        "parted",
        f"""SELECT f.{KEY}, {_scaled('CRSElapsedTime', 'train')} AS CRSElapsedTimeScaled, {_scaled('Distance', 'train')} AS DistanceScaled
        FROM parted f WHERE part = 1""",
        {"train": "SELECT * FROM parted WHERE part = 0"},
    ),
    "assemble_features": _vectors("train", "train"),
    "feature_pipeline": _vectors("featured", "featured"),
    "fit_transform_split": PART_SIZES,
    "feature_names": query("parted", "SELECT idx, kind, name FROM slots", _slots()),
    # Statistics
    "corr_matrix": query("model_input", _correlation()),
    "chi_square_category": query("featured", CHI_TABLE, _contingency([*CATEGORIES, *config.CONTINUOUS_COLUMNS])),
    "chi_square_onehot_sql": query("featured", CHI_SLOTS, _contingency(CATEGORIES)),
    # Evaluation
    "classification_metrics": query(
        "scored",
        """SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
        round(tp / (tp + fn), 6) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1 FROM
        (SELECT CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
        CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
        CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn,
        CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp FROM scored)""",
    ),
    "auc_exact": query(
        "scored",
        """SELECT round(sum(pos * (neg_before + neg / 2.0E0)) / (sum(pos) * sum(neg)), 6) AS auc FROM
        (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
        FROM (SELECT probability, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos, CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS neg
        FROM scored GROUP BY probability))""",
    ),
    "roc_points": _roc(1000, "threshold, fpr, tpr"),
    # Sketches, random parts and fitted models: counts and names, and what has to hold
    "landing_inventory": f"SELECT source_file AS file_name, true AS has_bytes, n_rows FROM ({_file_counts(ALL_TABLES)})",
    "summary_all": _summary(),
    "random_split": query(
        "featured",
        f"""SELECT CAST(count(*) AS BIGINT) AS n_rows, count(DISTINCT {KEY}) AS n_keys, CAST(0 AS BIGINT) AS n_in_both,
        true AS share_near FROM featured""",
    ),
    "chi_square_slots": _slot_tests("idx"),
    "chi_square_named": _slot_tests("name AS feature"),
    "train_logistic": query(
        "parted",
        """SELECT idx, o0 + o1 AS n_rows, o1 AS n_late, true AS balanced
        FROM slots JOIN observed ON name = concat("column", 'Vector_', value)""",
        {**_slots(), **_contingency(CATEGORIES, "train")},
    ),
    "logistic_coefficients": query(
        "parted", "SELECT idx, true AS finite FROM slots UNION ALL SELECT -1, true", _slots()
    ),
    "named_coefficients": query("parted", "SELECT idx, name, true AS finite FROM slots", _slots()),
    "coef_top_bottom": query(
        "parted",
        """SELECT side, CAST(k AS INT) AS rank, true AS in_order, (SELECT CAST(count(*) AS INT) FROM slots) AS n_slots
        FROM (VALUES ('top'), ('bottom')) v(side), range(1, 11) t(k)""",
        _slots(),
    ),
    "predict": query(
        "parted",
        f"""SELECT {KEY}, CAST(label AS DOUBLE) AS label, true AS score_agrees, true AS prediction_agrees
        FROM parted WHERE part = 1""",
    ),
    "train_forest": query(
        "parted",
        f"""SELECT {KEY}, CAST(label AS DOUBLE) AS label, true AS in_range, true AS prediction_agrees
        FROM parted WHERE part = 1""",
    ),
    "forest_importances": query(
        "parted", "SELECT idx, name, true AS in_range, true AS sums_to_one FROM slots", _slots()
    ),
    "grid_search": query(
        "parted", f"SELECT position, params, true AS in_range, folds FROM {_grid()}, folds", _folds()
    ),
    "best_params": query(
        "parted",
        f"""SELECT true AS is_best, true AS model_has_params, CAST(count(*) AS INT) AS n_points, folds
        FROM {_grid()}, folds GROUP BY folds""",
        _folds(),
    ),
    "auc_model": query(
        "parted",
        """SELECT count(*) FILTER (WHERE label = 1) AS n_late, count(*) FILTER (WHERE label = 0) AS n_on_time,
        true AS areas_agree, true AS beats_chance FROM parted WHERE part = 1""",
    ),
    "model_comparison": query(
        "parted",
        """SELECT model, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_late, true AS whole_cells, true AS auc_in_range
        FROM parted, (VALUES ('logistic'), ('tuned_logistic'), ('forest')) m(model) WHERE part = 1 GROUP BY model""",
    ),
    "roc_tuned_ends": query(
        "parted",
        """SELECT 0.0::DOUBLE AS first_fpr, 0.0::DOUBLE AS first_tpr, 1.0::DOUBLE AS last_fpr, 1.0::DOUBLE AS last_tpr, true AS fpr_rises, true AS tpr_rises,
        true AS whole_rows, count(*) FILTER (WHERE label = 1) AS n_late, count(*) FILTER (WHERE label = 0) AS n_on_time FROM parted WHERE part = 0""",
    ),
    "incremental_cleaning": query(
        "cleaned",
        f"""SELECT CASE WHEN Year < {EARLY_YEARS} THEN 1 ELSE 2 END AS run, count(*) AS n_rows, min(Year) AS first_year, max(Year) AS last_year,
        count(DISTINCT {KEY}) AS n_keys, 0::BIGINT AS n_rewritten FROM cleaned GROUP BY 1""",
    ),
    "scan_landing_folder": query("flights", _no_dates("flights")),
    "sketch_accuracy": query(
        "cleaned",
        f"""SELECT "column", 'number' AS kind, (SELECT count(*) FROM cleaned) AS n_rows, count(*) AS n_values,
        min(value) AS min, max(value) AS max, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text, round(avg(value), 6) AS mean,
        true AS p25, true AS p50, true AS p75, true AS distinct_near FROM longs GROUP BY "column"
        UNION ALL SELECT "column", 'text', (SELECT count(*) FROM cleaned), count(*), NULL, NULL, min(value), max(value), NULL,
        NULL, NULL, NULL, true FROM cells GROUP BY "column\"""",
        {**_numbers(config.NUMERICAL_COLUMNS, "cleaned"), **_texts(config.CATEGORICAL_COLUMNS, "cleaned")},
    ),
}
