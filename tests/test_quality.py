"""Quality gate: rule semantics, NULL handling in rejects, fixture counts."""

from pyspark.sql import functions as F

from conftest import SF01
from farelens.functions.features import add_features
from farelens.operators import quality
from farelens.sources.fixtures import raw_trips


def _featured(spark, sf=SF01):
    return add_features(raw_trips(spark, sf))


def test_fixture_counts_sf001(spark):
    featured = _featured(spark)
    assert featured.count() == 10_000
    assert quality.quality_filter(featured).count() == 8_822
    assert quality.quality_rejects(featured).count() == 1_178


def test_rule_counts_sf001(spark):
    row = quality.rule_failure_counts(_featured(spark)).first().asDict()
    assert row == {
        "raw_rows": 10_000,
        "fail_total_amount_positive": 134,
        "fail_distance_non_negative": 64,
        "fail_distance_below_max": 67,
        "fail_duration_positive": 100,
        "fail_duration_below_max": 104,
        "fail_speed_plausible": 789,
    }


def test_rejects_keep_null_rows(spark):
    featured = _featured(spark)
    naive = featured.filter(~quality.clean_predicate()).count()
    rejects = quality.quality_rejects(featured)
    assert naive < rejects.count()                       # plain negation loses NULL rows
    assert rejects.filter(F.col("trip_distance").isNull()).count() > 0
    assert rejects.filter(F.col("n_failed_rules") < 1).count() == 0


def test_split_is_a_partition(spark):
    featured = _featured(spark)
    clean = quality.quality_filter(featured).select("trip_key")
    rej = quality.quality_rejects(featured).select("trip_key")
    assert clean.join(rej, "trip_key").count() == 0
    assert clean.unionByName(rej).distinct().count() == 10_000


def test_split_counts(spark):
    row = quality.split_counts(_featured(spark)).first()
    assert (row.raw_rows, row.clean_rows, row.removed_rows, row.removed_pct) == (10_000, 8_822, 1_178, 11.78)


def test_uncastable_rows_are_counted_and_named(spark):
    featured = _featured(spark).withColumn("uncastable", F.when(F.col("trip_key") % 100 == 0, "VendorID").otherwise(""))
    assert quality.rule_failure_counts(featured).first().fail_values_castable == 100
    rejected = quality.quality_rejects(featured).filter(F.col("trip_key") % 100 == 0).collect()
    assert len(rejected) == 100 and all("values_castable" in r.reject_reasons for r in rejected)
    assert quality.quality_filter(featured).filter(F.col("trip_key") % 100 == 0).count() == 0


def test_boundaries(spark):
    rows = [
        # total, distance, duration_min, speed -> clean?
        (0.01, 0.0, 0.5, None, True),
        (0.0, 1.0, 10.0, 6.0, False),        # total must be > 0
        (5.0, -0.01, 10.0, None, False),     # distance >= 0
        (5.0, 99.99, 239.9, 25.0, True),
        (5.0, 100.0, 100.0, 60.0, False),    # distance < 100
        (5.0, 1.0, 240.0, 0.25, False),      # duration < 240
        (5.0, 1.0, 0.0, None, False),        # duration > 0
        (5.0, 1.0, 1.0, 100.0, False),       # speed < 100
        (5.0, 1.0, 1.0, 99.99, True),
        (None, 1.0, 1.0, 60.0, False),       # NULL fails
    ]
    schema = "total_amount double, trip_distance double, trip_duration_min double, avg_speed_mph double, want boolean"
    df = spark.createDataFrame(rows, schema)
    got = [r.want for r in quality.quality_filter(df).collect()]
    assert len(got) == sum(1 for r in rows if r[-1]) and all(got)
    rej = quality.quality_rejects(df).select("want").collect()
    assert len(rej) == sum(1 for r in rows if not r[-1]) and not any(r.want for r in rej)
