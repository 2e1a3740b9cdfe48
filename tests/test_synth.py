from pyspark.sql import functions as F

from sluice.sources.synth import bronze_spec, continue_ids, dirty_spec, synth


def test_same_rows_for_any_partitioning(spark):
    a = synth(spark.range(500), bronze_spec())
    b = synth(spark.range(500).repartition(7), bronze_spec())
    assert sorted(a.collect()) == sorted(b.collect())


def test_planted_defects(spark):
    df = synth(spark.range(20000), dirty_spec())
    n = df.count()
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c)
                     for c in ("client_id", "product_id", "signup_date")]).first()
    assert abs(rates.client_id - 0.3) < 0.02 and abs(rates.product_id - 0.2) < 0.02
    assert abs(rates.signup_date - 0.4) < 0.02
    assert df.filter("address = 'Washington'").count() > 0 and n == 20000
    assert df.filter("email is null").count() == 0
    assert df.agg(F.min("quantity"), F.max("quantity")).first() == (1, 10)


def test_continue_ids(spark):
    existing = synth(spark.range(100), bronze_spec())
    new = continue_ids(existing, "sales_id", spark.range(10), dirty_spec())
    assert sorted(r.sales_id for r in new.collect()) == list(range(100, 110))
    empty = existing.limit(0)
    assert sorted(r.sales_id for r in continue_ids(empty, "sales_id", spark.range(3), dirty_spec()).collect()) == [0, 1, 2]


def test_ids_beyond_31_bits_do_not_repeat_rows(spark):
    from sluice.sources.synth import bronze_spec, synth
    step = 2147483647
    seeds = spark.createDataFrame([(5 + k * step,) for k in range(6)] + [(5 + k, ) for k in range(1, 6)], "id bigint")
    cols = ["first_name", "last_name", "age", "signup_date", "price", "date", "quantity", "sale_amount"]
    assert synth(seeds, bronze_spec()).select(*cols).distinct().count() == 11
