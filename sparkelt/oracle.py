"""DuckDB SQL that states, independently of the Spark code, what each registered query must return."""

from __future__ import annotations

# --- the fixture adapter (FIXTURES.md, section 3) ---------------------------------------------

_PICKUP = (
    "TIMESTAMP '2024-01-01 00:00:00' + to_minutes((l_orderkey*37 + l_linenumber*11) % 44640)"
)


def _money(x: str, m: int) -> str:
    return f"CASE l_partkey % {m} WHEN 0 THEN NULL WHEN 1 THEN CAST(-1 AS DOUBLE) ELSE {x} END"


def _adapter(feed: str) -> str:
    p = "lpep" if feed == "green" else "tpep"
    own = (
        f"{_money('l_discount', 43)} AS ehail_fee, CASE l_partkey % 37 WHEN 0 THEN NULL "
        "WHEN 1 THEN CAST(3 AS BIGINT) ELSE 1 + l_partkey % 2 END AS trip_type"
        if feed == "green"
        else f'{_money("l_discount", 53)} AS "Airport_fee"'
    )
    return f"""
SELECT sha256(concat_ws('||', '{feed}', "VendorID", {p}_pickup_datetime, {p}_dropoff_datetime,
                        "PULocationID", "DOLocationID")) AS trip_id, *
FROM (
  SELECT
    CASE WHEN l_orderkey % 50 = 49 THEN NULL WHEN l_orderkey % 50 = 48 THEN CAST(3 AS BIGINT)
         ELSE 1 + l_orderkey % 2 END AS "VendorID",
    {_PICKUP} AS {p}_pickup_datetime,
    {_PICKUP} + to_seconds((l_orderkey*31 + l_linenumber*17) % 3600 - 60) AS {p}_dropoff_datetime,
    CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    NULLIF(l_suppkey % 9, 8) AS "RatecodeID",
    CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE l_orderkey % 265 + 1 END AS "PULocationID",
    (l_orderkey*7 + l_linenumber) % 265 + 1 AS "DOLocationID",
    NULLIF(l_partkey % 8, 7) AS passenger_count,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_quantity - 2 END AS trip_distance,
    CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS payment_type,
    {_money("l_extendedprice", 83)} AS fare_amount,
    {_money("l_extendedprice", 47)} AS total_amount,
    {_money("l_discount", 79)} AS extra,
    {_money("l_discount", 71)} AS tip_amount,
    {_money("l_discount", 59)} AS congestion_surcharge,
    {_money("l_tax", 73)} AS mta_tax,
    {_money("l_tax", 67)} AS tolls_amount,
    {_money("l_tax", 61)} AS improvement_surcharge,
    {own},
    TIMESTAMP '2024-02-01 00:00:00'
      + to_seconds((l_partkey*1000003 + l_suppkey*7919) % 86400) AS loaded_at
  FROM lineitem WHERE l_returnflag {"=" if feed == "green" else "<>"} 'R')"""


_HALF = "TIMESTAMP '2024-02-01 12:00:00'"
_BATCHES = {"all": "TRUE", "one": f"loaded_at <= {_HALF}", "two": f"loaded_at > {_HALF}"}

# --- the models -------------------------------------------------------------------------------

_AMOUNTS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount"]
_AMOUNTS += ["improvement_surcharge", "congestion_surcharge"]
_FEE = {"green": "ehail_fee", "yellow": "airport_fee"}


def _named(feed: str) -> str:
    """Raw rows under domain names, nothing dropped."""
    p = "lpep" if feed == "green" else "tpep"
    fee = "ehail_fee, trip_type" if feed == "green" else '"Airport_fee" AS airport_fee'
    return (
        f'SELECT trip_id, "VendorID" AS vendor_id, {p}_pickup_datetime AS pickup_datetime, '
        f'{p}_dropoff_datetime AS dropoff_datetime, "PULocationID" AS pu_location_id, '
        '"DOLocationID" AS do_location_id, "RatecodeID" AS ratecode_id, payment_type AS payment_id, '
        f"passenger_count, trip_distance, {', '.join(_AMOUNTS)}, {fee}, total_amount, loaded_at "
        f"FROM raw_{feed}"
    )


_VALID = (
    "trip_id IS NOT NULL AND vendor_id IS NOT NULL AND pickup_datetime IS NOT NULL "
    "AND dropoff_datetime IS NOT NULL AND pu_location_id IS NOT NULL "
    "AND do_location_id IS NOT NULL AND dropoff_datetime > pickup_datetime"
)
_NEWEST = (
    "ORDER BY loaded_at DESC NULLS LAST, fare_amount DESC NULLS LAST, trip_distance DESC NULLS LAST"
)


def _latest(rows: str) -> str:
    return f"SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY trip_id {_NEWEST}) = 1"


def _code(c: str) -> str:
    return f"CASE WHEN {c} BETWEEN 1 AND 6 THEN {c} ELSE -1 END"


def _positive(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'missing' WHEN {c} <= 0 THEN 'invalid' ELSE 'valid' END"


def _amount(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN 'missing' WHEN {c} < 0 THEN 'invalid' "
        f"WHEN {c} = 0 THEN 'zero' ELSE 'valid' END"
    )


def _flags(feed: str) -> str:
    out = [f"{_positive(c)} AS {c}_flag" for c in ("passenger_count", "trip_distance")]
    out += [f"{_amount(c)} AS {c}_flag" for c in [*_AMOUNTS, _FEE[feed], "total_amount"]]
    if feed == "green":
        out.append(
            "CASE WHEN trip_type IS NULL THEN 'missing' WHEN trip_type IN (1, 2) THEN 'valid' "
            "ELSE 'invalid' END AS trip_type_flag"
        )
    return ", ".join(out)


_CODES = f"{_code('ratecode_id')} AS ratecode_id_clean, {_code('payment_id')} AS payment_id_clean"


def _ctes(batch: str = "all", suffix: str = "") -> str:
    """raw, staging and intermediate tables of one batch as CTEs (names get the suffix)."""
    parts = []
    for f in ("green", "yellow"):
        s = f"{f}{suffix}"
        parts += [
            f"raw_{s} AS (SELECT * FROM ({_adapter(f)}) WHERE {_BATCHES[batch]})",
            f"named_{s} AS ({_named(f).replace(f'raw_{f}', f'raw_{s}')})",
            f"valid_{s} AS (SELECT * FROM named_{s} WHERE {_VALID})",
            f"uniq_{s} AS ({_latest(f'valid_{s}')})",
            f"stg_{s} AS (SELECT *, {_CODES}, {_flags(f)} FROM uniq_{s})",
        ]
    both = []
    for f in ("green", "yellow"):
        other = _FEE["yellow" if f == "green" else "green"]
        kept = (
            "trip_id vendor_id pickup_datetime dropoff_datetime pu_location_id do_location_id "
            "passenger_count trip_distance total_amount loaded_at"
        ).split() + _AMOUNTS
        judged = ["passenger_count", "trip_distance", "total_amount", *_AMOUNTS, _FEE[f]]
        judged += ["trip_type"] if f == "green" else []
        gate = " AND ".join(f"{c}_flag IN ('zero', 'valid')" for c in judged)
        trip_type = "trip_type" if f == "green" else "CAST(1 AS BIGINT) AS trip_type"
        both.append(
            f"SELECT {', '.join(kept)}, ratecode_id_clean AS ratecode_id, "
            f"payment_id_clean AS payment_id, {_FEE[f]}, CAST(0 AS DOUBLE) AS {other}, {trip_type}, "
            f"'{f}' AS taxi_type FROM stg_{f}{suffix} WHERE {gate}"
        )
    parts.append(f"gated{suffix} AS ({both[0]} UNION ALL BY NAME {both[1]})")
    return ", ".join(parts)


def _metrics(rows: str) -> str:
    return (
        "SELECT * EXCLUDE (trip_type), trip_type AS trip_type_id, "
        "round(epoch(dropoff_datetime - pickup_datetime) / 60, 0) AS trip_duration, "
        "CASE WHEN hour(pickup_datetime) >= 22 OR hour(pickup_datetime) < 6 THEN 1 ELSE 0 END "
        "AS night_flag, CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END "
        f"AS weekend_flag FROM {rows}"
    )


# Two incremental runs: what batch two brings replaces batch one key by key, nothing is retracted.
_TWO_RUNS = (
    f"{_ctes('one', '_1')}, {_ctes('two', '_2')}, "
    "gated AS (SELECT * FROM gated_1 ANTI JOIN gated_2 USING (trip_id) UNION ALL BY NAME "
    "SELECT * FROM gated_2)"
)

# --- fixed values: display labels ---
_LABELS = {
    "vendor_id": ("vendor_name", {1: "Vendor One", 2: "Vendor Two"}, "Unknown Vendor"),
    "payment_id": (
        "payment_name",
        {
            1: "Credit card",
            2: "Cash",
            3: "No charge",
            4: "Dispute",
            5: "Unknown",
            6: "Voided trip",
        },
        "Other",
    ),
    "ratecode_id": (
        "ratecode_name",
        {
            1: "Standard rate",
            2: "JFK",
            3: "Newark",
            4: "Nassau or Westchester",
            5: "Negotiated fare",
            6: "Group ride",
        },
        "Unknown Ratecode",
    ),
    "trip_type_id": ("trip_type_name", {1: "Street-hail", 2: "Dispatch"}, "Unknown Trip Type"),
}
_DIM_KEYS = {
    "dim_vendor": "vendor_id",
    "dim_payment": "payment_id",
    "dim_ratecode": "ratecode_id",
    "dim_trip_type": "trip_type_id",
    "dim_location": "location_id",
}


def _label(key: str) -> tuple[str, str]:
    if key == "location_id":
        return "location_name", f"'Location ' || lpad(CAST({key} AS VARCHAR), 3, '0')"
    name, texts, default = _LABELS[key]
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in texts.items())
    return name, f"CASE {key} {whens} ELSE '{default}' END"


def _dim(key: str, rows: str) -> str:
    name, expr = _label(key)
    source = rows
    if key == "location_id":
        source = (
            f"(SELECT pu_location_id AS location_id, loaded_at FROM {rows} UNION ALL "
            f"SELECT do_location_id, loaded_at FROM {rows})"
        )
    return (
        f"SELECT {key}, {expr} AS {name}, max(loaded_at) AS loaded_at FROM {source} GROUP BY {key}"
    )


def _any_dim(rows: str) -> str:
    """All dimensions in one shape."""
    parts = [
        f"SELECT '{d}' AS dim, {k} AS member, {_label(k)[0]} AS label, loaded_at FROM ({_dim(k, rows)})"
        for d, k in _DIM_KEYS.items()
    ]
    return " UNION ALL ".join(parts)


# --- checks -----------------------------------------------------------------------------------


def _fails(rows: str, tests: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS failures FROM {rows} WHERE {where}"
        for c, where in tests.items()
    )


_DUPLICATES = (
    "SELECT trip_id, count(*) AS n FROM {0} WHERE trip_id IS NOT NULL GROUP BY trip_id "
    "HAVING count(*) > 1"
)
_SIX = "(-1, 1, 2, 3, 4, 5, 6)"


def _report(suffix: str = "", gated: str = "gated", metrics: str = "metrics") -> str:
    def rows(model: str, table: str, tests: list[tuple[str, str, str]]) -> list[str]:
        return [
            f"SELECT '{model}' AS model, '{c}' AS column_name, '{k}' AS check_name, "
            f"count(*) AS failures FROM {table} WHERE {w}"
            for c, k, w in tests
        ]

    parts = []
    for f in ("green", "yellow"):
        present = "trip_id vendor_id pickup_datetime dropoff_datetime pu_location_id do_location_id "
        present += "ratecode_id_clean payment_id_clean loaded_at"
        tests = [("", "dropoff_after_pickup", "dropoff_datetime <= pickup_datetime")]
        tests += [(c, "not_null", f"{c} IS NULL") for c in present.split()]
        tests += [
            ("vendor_id", "accepted_values", "vendor_id NOT IN (1, 2)"),
            ("ratecode_id_clean", "accepted_values", f"ratecode_id_clean NOT IN {_SIX}"),
            ("payment_id_clean", "accepted_values", f"payment_id_clean NOT IN {_SIX}"),
        ]
        parts += rows(f"stg_{f}_taxi", f"stg_{f}{suffix}", tests)
        parts += rows(
            f"stg_{f}_taxi", f"({_DUPLICATES.format(f'stg_{f}{suffix}')})", [("trip_id", "unique", "TRUE")]
        )
    tests = [(c, "positive", f"{c} <= 0 OR {c} IS NULL") for c in ("passenger_count", "trip_distance")]
    for c in [*_AMOUNTS, "ehail_fee", "airport_fee", "total_amount"]:
        tests.append((c, "positive_or_zero", f"{c} < 0 OR {c} IS NULL"))
    tests += [
        ("trip_type", "accepted_values", "trip_type NOT IN (1, 2)"),
        ("taxi_type", "accepted_values", "taxi_type NOT IN ('green', 'yellow')"),
    ]
    parts += rows("int_both_taxi", gated, tests)
    links = {
        "pu_location_id": "location_id",
        "do_location_id": "location_id",
        "vendor_id": "vendor_id",
        "payment_id": "payment_id",
        "ratecode_id": "ratecode_id",
        "trip_type_id": "trip_type_id",
    }
    parts += rows(
        "fact_trip",
        metrics,
        [
            (c, "relationships", f"{c} NOT IN (SELECT {k} FROM ({_dim(k, metrics)}))")
            for c, k in links.items()
        ],
    )
    return " UNION ALL ".join(parts)


# --- wire -------------------------------------------------------------------------------------

# --- fixed values: wire fields of the green feed, in order ---
_WIRE_GREEN = (
    "VendorID lpep_pickup_datetime lpep_dropoff_datetime store_and_fwd_flag RatecodeID PULocationID "
    "DOLocationID passenger_count trip_distance fare_amount extra mta_tax tip_amount tolls_amount "
    "ehail_fee improvement_surcharge total_amount payment_type trip_type congestion_surcharge"
).split()


def _wire(feed: str) -> str:
    p = "lpep" if feed == "green" else "tpep"
    times = [f"{p}_pickup_datetime", f"{p}_dropoff_datetime"]
    iso = ", ".join(f"strftime({t}, '%Y-%m-%dT%H:%M:%S') AS {t}" for t in times)
    return f"SELECT * REPLACE ({iso}) FROM raw_{feed}"


def _each(body) -> str:
    """A statement per feed, told apart by taxi_type; a column that a feed lacks is NULL there."""
    return " UNION ALL BY NAME ".join(f"SELECT *, '{f}' AS taxi_type FROM ({body(f)})" for f in _FEE)


# --- fixed values: wire fields of the yellow feed, in order ---
_WIRE_YELLOW = (
    "VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance RatecodeID "
    "store_and_fwd_flag PULocationID DOLocationID payment_type fare_amount extra mta_tax tip_amount "
    "tolls_amount improvement_surcharge total_amount congestion_surcharge Airport_fee"
).split()


def _json(feed: str) -> str:
    names = _WIRE_GREEN if feed == "green" else _WIRE_YELLOW
    pairs = ", ".join(f"'{c}', \"{c}\"" for c in names)
    return f"CAST(json_object({pairs}) AS VARCHAR)"


def _letters(feed: str) -> str:
    """Raw trips and dead letters of messages that are spoilt by the first digit of their trip_id."""
    bare = "unhex('0000000007')"
    soon = """regexp_replace(body, '_pickup_datetime":"[^"]*"', '_pickup_datetime":"soon"')"""
    return f"""
SELECT CASE WHEN kind NOT IN ('0', '1', '2', '3') THEN trip_id END AS trip_id,
       CASE kind WHEN '0' THEN 'malformed body' WHEN '1' THEN 'no frame' WHEN '2' THEN 'no value'
                 WHEN '3' THEN 'unreadable time' END AS reason,
       sha256(bytes) AS value_sha256, octet_length(bytes) AS value_bytes
FROM (SELECT trip_id, kind,
             CASE kind WHEN '0' THEN {bare} || encode(left(body, length(body) - 3)) WHEN '1' THEN encode(body)
                       WHEN '3' THEN {bare} || encode({soon}) END AS bytes
      FROM (SELECT trip_id, left(trip_id, 1) AS kind, {_json(feed)} AS body FROM ({_wire(feed)})))"""


def _evolved(feed: str) -> str:
    """Messages whose version goes by the drop-off zone; the first one lacks two surcharges."""
    first = '"DOLocationID" % 3 = 0'
    return f"""
SELECT * EXCLUDE (loaded_at) REPLACE (
         CASE WHEN {first} THEN 0 ELSE congestion_surcharge END AS congestion_surcharge,
         CASE WHEN {first} THEN NULL ELSE improvement_surcharge END AS improvement_surcharge),
       CAST(201 + "DOLocationID" % 3 AS INTEGER) AS schema_id
FROM ({_wire(feed)})"""


def _two_drops(feed: str) -> str:
    """Newest version of each trip where load times are those of the drop that brought it."""
    return f"""
SELECT trip_id, fare_amount, trip_distance FROM valid_{feed}
QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY loaded_at > {_HALF} DESC,
  fare_amount DESC NULLS LAST, trip_distance DESC NULLS LAST) = 1"""


def oracle_sql() -> dict[str, str]:
    every = _ctes()
    metrics = f"metrics AS ({_metrics('gated')})"
    json_pairs = ", ".join(f"'{c}', \"{c}\"" for c in _WIRE_GREEN)
    raw_cols = {
        "yellow": (
            "trip_id VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count "
            "trip_distance RatecodeID store_and_fwd_flag PULocationID DOLocationID payment_type "
            "fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge total_amount "
            "congestion_surcharge Airport_fee loaded_at"
        ).split()
    }
    profile = ", ".join(
        f'count("{c}") AS "{c}_non_null", min("{c}") AS "{c}_min", max("{c}") AS "{c}_max"'
        for c in raw_cols["yellow"]
    )

    def q(body: str, ctes: str = every) -> str:
        return f"WITH {ctes} {body}"

    amounts = [*_AMOUNTS, "airport_fee", "total_amount"]
    both_metrics = f"{_TWO_RUNS}, metrics AS ({_metrics('gated')})"
    two_dims = (
        f"{_ctes('one', '_1')}, {_ctes('two', '_2')}, metrics_1 AS ({_metrics('gated_1')}), "
        f"metrics_2 AS ({_metrics('gated_2')}), dims_1 AS ({_any_dim('metrics_1')}), "
        f"dims_2 AS ({_any_dim('metrics_2')})"
    )
    out = {
        "raw_green": q("SELECT * FROM raw_green"),
        "raw_yellow": q("SELECT * FROM raw_yellow"),
        "profile_raw": q(f"SELECT count(*) AS row_count, {profile} FROM raw_yellow"),
        "trip_id_key": q(
            'SELECT trip_id, "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, '
            '"PULocationID", "DOLocationID" FROM raw_yellow'
        ),
        "stg_drop_invalid": q(
            'SELECT * FROM raw_yellow WHERE trip_id IS NOT NULL AND "VendorID" IS NOT NULL '
            'AND "PULocationID" IS NOT NULL AND "DOLocationID" IS NOT NULL '
            "AND tpep_dropoff_datetime > tpep_pickup_datetime"
        ),
        "stg_dedup_latest": q(_latest("raw_yellow")),
        "stg_code_clean": q(f"SELECT trip_id, {_CODES} FROM uniq_yellow"),
        "stg_flags": q(f"SELECT trip_id, {_flags('green')} FROM uniq_green"),
        "stg_green_taxi": q("SELECT * FROM stg_green"),
        "stg_yellow_taxi": q("SELECT * FROM stg_yellow"),
        "int_both_taxi": q("SELECT * FROM gated"),
        "trip_duration": q(
            "SELECT trip_id, round(epoch(dropoff_datetime - pickup_datetime) / 60, 0) "
            "AS trip_duration FROM stg_yellow"
        ),
        "night_weekend_flags": q(
            "SELECT trip_id, CASE WHEN hour(pickup_datetime) BETWEEN 6 AND 21 THEN 0 ELSE 1 END "
            "AS night_flag, CASE WHEN isodow(pickup_datetime) >= 6 THEN 1 ELSE 0 END "
            "AS weekend_flag FROM stg_yellow"
        ),
        "int_metrics_added": q(_metrics("gated")),
        "fact_trip": q(f"SELECT * EXCLUDE (taxi_type) FROM ({_metrics('gated')})"),
        **{
            d: q(_dim(k, "metrics"), f"{every}, {metrics}") for d, k in _DIM_KEYS.items()
        },
        "inc_watermark_filter": q(
            "SELECT * FROM stg_yellow WHERE loaded_at > (SELECT max(loaded_at) FROM stg_yellow_1)",
            f"{every}, {_ctes('one', '_1')}",
        ),
        "inc_merge_upsert": q(
            "SELECT * FROM stg_yellow_1 ANTI JOIN stg_yellow_2 USING (trip_id) UNION ALL "
            "SELECT * FROM stg_yellow_2",
            f"{_ctes('one', '_1')}, {_ctes('two', '_2')}",
        ),
        "inc_two_batch_stg": q("SELECT * FROM stg_yellow"),
        "inc_two_batch_stg_green": q("SELECT * FROM stg_green"),
        "inc_two_batch_int": q("SELECT * FROM gated", _TWO_RUNS),
        "inc_two_batch_fact": q("SELECT * EXCLUDE (taxi_type) FROM metrics", both_metrics),
        "inc_slow_feed": q(
            "SELECT * EXCLUDE (taxi_type) FROM metrics",
            f"{every}, {_ctes('one', '_1')}, {_ctes('two', '_2')}, slow AS ("
            "SELECT * FROM gated_1 ANTI JOIN gated_2 USING (trip_id) WHERE taxi_type = 'green' "
            "UNION ALL BY NAME SELECT * FROM gated_2 WHERE taxi_type = 'green' "
            "UNION ALL BY NAME SELECT * FROM gated WHERE taxi_type = 'yellow'), "
            f"metrics AS ({_metrics('slow')})",
        ),
        "inc_two_batch_dims": q(
            "SELECT * FROM dims_1 ANTI JOIN dims_2 USING (dim, member) UNION ALL SELECT * FROM dims_2",
            two_dims,
        ),
        "inc_merge_upsert_files": q(_each(lambda f: f"SELECT * FROM stg_{f}")),
        "inc_compacted_staging": q(_each(_two_drops)),
        "dq_not_null": q(
            _fails(
                "named_yellow",
                {
                    c: f"{c} IS NULL"
                    for c in "trip_id vendor_id pickup_datetime dropoff_datetime pu_location_id "
                    "do_location_id ratecode_id payment_id loaded_at".split()
                },
            )
        ),
        "dq_unique": q(_fails(f"({_DUPLICATES.format('named_yellow')})", {"trip_id": "TRUE"})),
        "dq_accepted_values": q(
            _fails(
                "named_yellow",
                {
                    "vendor_id": "vendor_id NOT IN (1, 2)",
                    "ratecode_id": f"ratecode_id NOT IN {_SIX}",
                    "payment_id": f"payment_id NOT IN {_SIX}",
                },
            )
        ),
        "dq_dropoff_after_pickup": q(
            _fails("named_yellow", {"": "dropoff_datetime <= pickup_datetime"})
        ),
        "dq_positive": q(
            _fails(
                "named_yellow",
                {c: f"{c} <= 0 OR {c} IS NULL" for c in ("passenger_count", "trip_distance")},
            )
        ),
        "dq_positive_or_zero": q(
            _fails("named_yellow", {c: f"{c} < 0 OR {c} IS NULL" for c in amounts})
        ),
        "dq_relationships": q(
            _fails(
                "named_yellow",
                {
                    "pu_location_id": "pu_location_id > 200",
                    "do_location_id": "do_location_id > 200",
                    "vendor_id": "vendor_id NOT IN (1, 2)",
                },
            )
        ),
        "dq_violating_rows": q("SELECT * FROM named_yellow WHERE trip_distance <= 0 OR trip_distance IS NULL"),
        "dq_duplicate_keys": q(_DUPLICATES.format("named_yellow")),
        "dq_orphan_rows": q("SELECT * FROM named_yellow WHERE pu_location_id > 200"),
        "dq_orphan_rows_bitmap": q(_each(lambda f: f"SELECT * FROM named_{f} WHERE pu_location_id > 200")),
        "dq_report": q(_report(), f"{every}, {metrics}"),
        "dq_report_counted": q(
            f"SELECT 1 AS batch, * FROM ({_report('_1', 'gated_1', 'metrics_1')}) "
            f"UNION ALL SELECT 2 AS batch, * FROM ({_report('', 'both_runs', 'metrics')})",
            f"{every}, {_ctes('one', '_1')}, {_ctes('two', '_2')}, both_runs AS (SELECT * FROM gated_1 ANTI JOIN gated_2 "
            "USING (trip_id) UNION ALL BY NAME SELECT * FROM gated_2), "
            f"metrics AS ({_metrics('both_runs')}), metrics_1 AS ({_metrics('gated_1')})",
        ),
        "model_counts": q(
            " UNION ALL ".join(
                [f"SELECT 'stg_{f}_taxi' AS model, count(*) AS row_count FROM stg_{f}" for f in _FEE]
                + [
                    f"SELECT '{m}' AS model, count(*) AS row_count FROM gated"
                    for m in ("int_both_taxi", "int_metrics_added", "fact_trip")
                ]
                + [
                    f"SELECT '{d}' AS model, count(*) AS row_count FROM ({_dim(k, 'metrics')})"
                    for d, k in _DIM_KEYS.items()
                ]
            ),
            f"{every}, {metrics}",
        ),
        "normalize_payload": q(f"SELECT * EXCLUDE (loaded_at) FROM ({_wire('green')})"),
        "encode_json": q(
            f"SELECT trip_id, CAST(json_object({json_pairs}) AS VARCHAR) AS value "
            f"FROM ({_wire('green')})"
        ),
        "decode_json": q("SELECT * EXCLUDE (loaded_at) FROM raw_green"),
        "decode_frame": q(
            "SELECT trip_id, 7 AS schema_id, "
            f"CAST(strlen(CAST(json_object({json_pairs}) AS VARCHAR)) AS INTEGER) AS body_bytes FROM ({_wire('green')})"
        ),
        "decode_by_schema_id": q(
            f"SELECT 101 AS schema_id, * EXCLUDE (trip_id, loaded_at) FROM ({_wire('green')}) "
            "UNION ALL BY NAME "
            f"SELECT 102 AS schema_id, * EXCLUDE (trip_id, loaded_at) FROM ({_wire('yellow')})"
        ),
        "decode_evolved": q(_each(_evolved)),
        "stream_ingest_green": q("SELECT * EXCLUDE (loaded_at) FROM raw_green"),
        "stream_ingest_yellow": q("SELECT * EXCLUDE (loaded_at) FROM raw_yellow"),
        "stream_resume": q("SELECT * EXCLUDE (loaded_at) FROM raw_yellow"),
        "stream_compaction": q(_each(lambda f: f"SELECT * EXCLUDE (loaded_at) FROM raw_{f}")),
        "stream_dead_letters": q(_each(_letters)),
        "stream_timer": q(_each(lambda f: f"SELECT * EXCLUDE (loaded_at) FROM raw_{f}")),
        "stream_staging": q(_each(lambda f: f"SELECT * FROM stg_{f}")),
        "stream_dims": q(
            "SELECT * FROM dims_1 ANTI JOIN dims_2 USING (dim, member) UNION ALL SELECT * FROM dims_2",
            two_dims,
        ),
        "stream_json_sink": q(f"SELECT * EXCLUDE (trip_id, loaded_at) FROM ({_wire('green')})"),
    }
    return out
