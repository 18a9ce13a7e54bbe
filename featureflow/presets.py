"""Column roles for the two table pairs the library is run on.

FLIGHTS: the airline on-time table joined with the aircraft registry.
TPCH: the driver's ``lineitem`` joined with ``part`` (stand-in roles: see
FIXTURES.md section 2).
"""

from __future__ import annotations

from featureflow.spec import Cyclic, FeatureSpec

# --- fixed values: airline column names and roles --------------------------
FLIGHTS = FeatureSpec(
    label="ArrDelay",
    key="TailNum",
    dim_renames=(
        ("tailnum", "TailNum"),
        ("year", "PlaneIssueYear"),
        ("engine_type", "EngineType"),
        ("aircraft_type", "AircraftType"),
        ("model", "Model"),
        ("manufacturer", "Manufacturer"),
    ),
    exclude=("Cancelled", 1),
    forbidden=(
        "ArrTime", "ActualElapsedTime", "AirTime", "TaxiIn", "Diverted",
        "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
    ),
    useless=(
        "TailNum", "FlightNum", "UniqueCarrier", "CancellationCode", "Cancelled",
        "issue_date", "status", "type",
    ),
    quantitative=("CRSElapsedTime", "DepDelay", "Distance", "TaxiOut"),
    hhmm=("DepTime", "CRSDepTime", "CRSArrTime"),
    cyclic=(
        Cyclic("Month", period=12),
        Cyclic("DayofMonth", month_col="Month"),
        Cyclic("DayOfWeek", period=7),
    ),
    nominal=(
        "Origin", "Dest", "EngineType", "AircraftType", "Manufacturer", "Model",
        "Year", "PlaneIssueYear",
    ),
    cast_type="int",
    label_type="int",
    sentinels=("None",),
)

# --- lineitem x part ---------------------------------------------------------
TPCH = FeatureSpec(
    label="l_extendedprice",
    key="l_partkey",
    dim_renames=(
        ("p_partkey", "l_partkey"),
        ("p_type", "item_type"),
        ("p_brand", "brand"),
        ("p_retailprice", "retail_price"),
    ),
    derived=(
        ("ship_month", "month(l_shipdate)"),
        ("ship_day", "dayofmonth(l_shipdate)"),
        ("ship_dow", "(dayofweek(l_shipdate) + 5) % 7 + 1"),   # ISO weekday, Monday = 1
    ),
    exclude=("l_returnflag", "A"),
    forbidden=(),
    useless=("p_name", "p_size", "l_suppkey", "l_shipdate", "l_partkey"),
    quantitative=("l_quantity", "l_discount", "l_tax", "retail_price"),
    hhmm=(),
    cyclic=(
        Cyclic("ship_month", period=12),
        Cyclic("ship_day", month_col="ship_month"),
        Cyclic("ship_dow", period=7),
    ),
    nominal=("l_returnflag", "l_linestatus", "item_type", "brand"),
    cast_type="double",
    label_type="double",
    sentinels=("None",),
    keep=("l_orderkey", "l_linenumber"),
)
