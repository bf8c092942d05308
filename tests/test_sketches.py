"""Sketches per day, merged, against exact answers; SQL functions and the staging view against the DataFrame form."""

from pyspark.sql import functions as F

from vitrine.functions.text import parse_price, parse_sales_volume
from vitrine.operators.percentiles import exact_percentiles
from vitrine.operators.sketches import daily_sketches, distinct_estimate, merged_sketches, quantile_estimate
from vitrine.plans.sql_staging import create_functions, create_staging_view
from vitrine.plans.staging import staged
from vitrine.sources.sales_tables import raw_products

FRACTIONS = [0.01, 0.25, 0.5, 0.75, 0.99]


def test_merged_sketches_are_near_the_exact_answers(spark):
    rows = spark.range(400_000).selectExpr(
        "CAST(id % 40 AS INT) AS day", "CAST(hash(id) % 60000 AS STRING) AS product", "CAST(pmod(xxhash64(id), 1000003) * (id % 3) AS BIGINT) AS cents"
    )
    daily = daily_sketches(rows, F.col("day"), F.col("product"), F.col("cents"))
    for width in (1, 10, 40):  # sketches of days, of ten days, of all
        period = F.floor(F.col("day") / width)
        found = merged_sketches(daily, period).select(
            "period", "n", distinct_estimate(F.col("distinct_sketch")).alias("distinct"),
            *(quantile_estimate(F.col("value_sketch"), q).alias(f"q{i}") for i, q in enumerate(FRACTIONS)),
        )
        exact = rows.withColumn("period", period).join(F.broadcast(found), "period").groupBy("period").agg(
            F.count_distinct("product").alias("exact"), F.first("distinct").alias("distinct"), F.count("*").alias("n"),
            F.first("n").alias("n_sketch"),
            *(F.count_if(F.col("cents") < F.col(f"q{i}")).alias(f"below{i}") for i in range(5)),
            *(F.count_if(F.col("cents") <= F.col(f"q{i}")).alias(f"upto{i}") for i in range(5)),
        ).collect()
        assert len(exact) == 40 // width
        for r in exact:
            assert r.n == r.n_sketch and abs(r.distinct - r.exact) <= 0.02 * r.exact
            for i, q in enumerate(FRACTIONS):  # the rank of the estimate: from the share below it to that up to it
                assert r[f"below{i}"] / r.n - 0.01 <= q <= r[f"upto{i}"] / r.n + 0.01


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([(1, None, None), (1, None, None), (2, "a", 5)], "day int, product string, cents long")
    merged = merged_sketches(daily_sketches(rows, F.col("day"), F.col("product"), F.col("cents")), F.col("day"))
    found = merged.select("period", "n", distinct_estimate(F.col("distinct_sketch")), quantile_estimate(F.col("value_sketch"), 0.5))
    assert sorted(map(tuple, found.collect())) == [(1, 2, 0, None), (2, 1, 1, 5)]
    assert exact_percentiles(rows, ["day"], F.col("cents"), {"m": 0.5}).count() == 1


def test_sql_functions_equal_the_column_functions(spark):
    create_functions(spark)
    texts = ["R$ 1.999,00", "1299.00", "", None, "x", "1,2,3", "Mais de 1,5 mil compras", "2 MIL", "2 milhões", "500 compras em 30 dias",
             "12.5 mil", "99999999999", "99999999 mil", "0,0004 mil", "٣ mil"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    rows.createOrReplaceTempView("texts_to_parse")
    by_sql = spark.sql("SELECT t, parse_price_br(t) AS price, parse_sales_volume(t) AS units FROM texts_to_parse")
    by_column = rows.select("t", parse_price(F.col("t")).alias("price"), parse_sales_volume(F.col("t")).alias("units"))
    assert by_sql.collect() == by_column.collect() and by_sql.schema == by_column.schema


def test_the_staging_view_equals_staging(spark, small):
    raw = raw_products(spark, small)
    raw.createOrReplaceTempView("raw_for_view")
    view, frame = create_staging_view(spark, "raw_for_view"), staged(raw)
    assert [(f.name, f.dataType) for f in view.schema] == [(f.name, f.dataType) for f in frame.schema]
    assert view.count() > 0 and view.exceptAll(frame).isEmpty() and frame.exceptAll(view).isEmpty()
