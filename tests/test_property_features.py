"""Property test: Spark features + quality gate equal the DuckDB oracle's.

Random raw trips (NULLs, zeros, negative values, two-decimal amounts, tips
equal to the total, durations around the rule limits) go through
``add_features`` and the six rules in Spark, and through the oracle's feature
CTEs in DuckDB; every derived column must agree exactly.
"""

import datetime as dt
import os

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from farelens import oracle_sql as O
from farelens.functions.features import DERIVED_COLUMNS, add_features
from farelens.operators.quality import RULE_NAMES, passes, rules
from farelens.schema import RAW_SCHEMA

BASE = dt.datetime(2024, 1, 1)

cents = st.integers(min_value=-2_000, max_value=60_000)
amount = st.one_of(st.none(), cents.map(lambda c: c / 100))
trip = st.fixed_dictionaries({
    "VendorID": st.one_of(st.none(), st.integers(min_value=0, max_value=7)),
    "pickup_s": st.integers(min_value=0, max_value=60 * 86_400),
    "duration_s": st.one_of(st.none(), st.integers(min_value=-120, max_value=16_000),
                            st.sampled_from([0, 1, 14_399, 14_400, 10_799, 10_800])),
    "trip_distance": st.one_of(amount, st.sampled_from([0.0, 1.0, 5.0, 10.0, 99.99, 100.0])),
    "total_amount": st.one_of(amount, st.sampled_from([0.0, 10.0, 25.0, 50.0])),
    "tip_kind": st.sampled_from(["free", "equal", "zero", "null"]),
    "tip_amount": cents.map(lambda c: c / 100),
    "payment_type": st.one_of(st.none(), st.integers(min_value=0, max_value=7)),
})


def _rows(trips):
    out = []
    for i, t in enumerate(trips):
        pickup = BASE + dt.timedelta(seconds=t["pickup_s"])
        dropoff = None if t["duration_s"] is None else pickup + dt.timedelta(seconds=t["duration_s"])
        tip = {"free": t["tip_amount"], "equal": t["total_amount"], "zero": 0.0, "null": None}[t["tip_kind"]]
        out.append((i, t["VendorID"], pickup, dropoff, t["trip_distance"], t["total_amount"], tip,
                    t["payment_type"]))
    return out


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).to_pydatetime().replace(tzinfo=None).isoformat()
    if v is None or (isinstance(v, float) and v != v) or v is pd.NaT:
        return None
    return v


@settings(max_examples=int(os.environ.get("FARELENS_PROPERTY_EXAMPLES", "15")), deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=60))
def test_features_match_oracle(spark, trips):
    rows = _rows(trips)
    cols = ["trip_key"] + [f.name for f in RAW_SCHEMA.fields]
    schema = "trip_key int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)
    sdf = spark.createDataFrame(rows, schema)
    featured = add_features(sdf)
    checks = [passes(p).alias(f"ok_{n}") for n, p in rules()]
    spark_rows = {r["trip_key"]: r for r in featured.select("trip_key", *DERIVED_COLUMNS, *checks).collect()}

    con = duckdb.connect()
    pdf = pd.DataFrame(rows, columns=cols)
    con.register("raw_pdf", pdf)
    typed = ("SELECT CAST(trip_key AS INTEGER) trip_key, CAST(VendorID AS INTEGER) VendorID, "
             "CAST(lpep_pickup_datetime AS TIMESTAMP) lpep_pickup_datetime, "
             "CAST(lpep_dropoff_datetime AS TIMESTAMP) lpep_dropoff_datetime, "
             "CAST(trip_distance AS DOUBLE) trip_distance, CAST(total_amount AS DOUBLE) total_amount, "
             "CAST(tip_amount AS DOUBLE) tip_amount, CAST(payment_type AS INTEGER) payment_type FROM raw_pdf")
    oks = ", ".join(f"COALESCE({p}, FALSE) AS ok_{n}" for n, p in O.RULES)
    sql = f"WITH raw_trips AS ({typed}), {O.PARTS.strip()}, {O.FEATURED.strip()} " \
          f"SELECT trip_key, {', '.join(DERIVED_COLUMNS)}, {oks} FROM featured"
    duck = con.sql(sql)
    names = duck.columns
    for rec in duck.fetchall():
        d = dict(zip(names, rec))
        s = spark_rows[d["trip_key"]]
        for c in DERIVED_COLUMNS + [f"ok_{n}" for n in RULE_NAMES]:
            assert _norm(s[c]) == _norm(d[c]), (c, rows[d["trip_key"]], s[c], d[c])
