"""Column functions: rounding, exact sums, NaN, keys, names."""

from pyspark.sql import functions as F

from ledgerline.functions import exact_sum, last_path_component, nan_to_null, normalize_key, round_half_away, safe_name


def test_round_half_away_rounds_the_binary_value(spark):
    df = spark.createDataFrame([(1.005, 1), (2.675, 1), (-2.5, 1), (0.125, 1)], "price double, q long")
    got = [r[0] for r in df.select(round_half_away(F.col("price") * F.col("q"), 2)).collect()]
    # 1.005 * 100 is 100.49999999999999 in binary and rounds down; 2.675 * 100 is
    # exactly 267.5 and rounds away from zero (the values a SQL engine returns).
    assert got == [1.0, 2.68, -2.5, 0.13]
    # Spark's own round(x, 2) would round the decimal text instead.
    assert df.select(F.round("price", 2)).first()[0] == 1.01


def test_round_half_away_zero_places(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.49999999999999994,)], "x double")
    assert [r[0] for r in df.select(round_half_away("x", 0)).collect()] == [3.0, -3.0, 0.0]


def test_exact_sum_is_order_independent_and_null_on_empty(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 1000
    df = spark.createDataFrame(vals, "x double")
    a = df.repartition(7).agg(exact_sum("x").alias("s")).first()[0]
    b = df.coalesce(1).agg(exact_sum("x").alias("s")).first()[0]
    assert a == b == 600.0
    empty = df.filter("x < 0").agg(exact_sum("x").alias("s")).first()[0]
    assert empty is None


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(nan_to_null("x")).collect()]
    assert got == [1.0, None, None]


def test_normalize_key(spark):
    df = spark.createDataFrame([("15298",), ("15298.0",), (" abc-1 ",), ("",), (None,), ("7.50",), ("1.00",), ("-12.0",)], "k string")
    got = [r[0] for r in df.select(normalize_key("k")).collect()]
    assert got == ["15298", "15298", "abc-1", None, None, "7.50", "1.00", "-12.0"]


def test_last_path_component(spark):
    df = spark.createDataFrame([("dir/",), ("a/b.txt",), ("",), ("/",), ("x//",), ("plain",)], "p string")
    got = [r[0] for r in df.select(last_path_component("p")).collect()]
    assert got == ["dir", "b.txt", "", "", "x", "plain"]


def test_safe_name(spark):
    df = spark.createDataFrame(
        [("Fichier_érp.xlsx",), ("Crème brûlée™ 25°",), ("ﬁne ½",), (None,)], "n string"
    )
    got = [r[0] for r in df.select(safe_name("n")).collect()]
    # NFKD: accents drop, the trade-mark sign becomes TM, the ligature fi splits,
    # the degree sign has no ASCII form and disappears, a space becomes '_', and
    # one-half decomposes to 1, FRACTION SLASH (non-ASCII, dropped), 2.
    assert got == ["Fichier_erp.xlsx", "Creme_bruleeTM_25", "fine_12", None]


def test_moments_are_equal_bit_by_bit_on_every_partitioning(spark):
    import random
    import statistics
    from fractions import Fraction

    from ledgerline.functions.numeric import exact_moments
    from ledgerline.operators import metrics

    r = random.Random(5)
    values = [r.gauss(10, 3) * 10.0 ** r.choice([-6, 0, 0, 5]) for _ in range(3000)] + [0.0, 1e-300, 5e-324, -1e12]
    frames = [spark.createDataFrame([(v,) for v in values], "v double").repartition(n) for n in (1, 7, 64)]

    def moments(df):
        mean, sd = exact_moments(df, "v")
        return tuple(spark.range(1).select(mean, sd).first())

    found = [moments(df) for df in frames]
    assert len(set(found)) == 1
    assert found[0][0] == float(sum(map(Fraction, values)) / len(values))
    assert abs(found[0][1] / statistics.stdev(values) - 1) < 1e-15
    # a value whose z is 2 up to the last bits keeps its label
    mean, sd = found[0]
    near = [mean + 2 * sd * (1 + k * 2.0**-52) for k in range(-3, 4)]
    labelled = [spark.createDataFrame([(v,) for v in values + near], "v double").repartition(n) for n in (1, 7, 64)]
    z = [sorted((x.v, x.z_score, x.type) for x in metrics.zscore_classify(df, "v").collect()) for df in labelled]
    assert z[0] == z[1] == z[2]


def test_moments_of_few_or_odd_values(spark):
    from ledgerline.functions.numeric import exact_moments

    def moments(*values):
        mean, sd = exact_moments(spark.createDataFrame([(v,) for v in values], "v double"), "v")
        return tuple(spark.range(1).select(mean, sd).first())

    assert moments() == moments(None) == (None, None)
    assert moments(1.0, None) == (1.0, None) and moments(2.0, 2.0, 2.0) == (2.0, 0.0) and moments(0.0, 0.0) == (0.0, 0.0)
    assert moments(1.0, float("inf")) == (None, None)
    assert moments(1e300, -1e300) == (0.0, None)  # the square is beyond a double
