"""Band join against all pairs."""

import random

from tessera.operators.bands import band_join
from tessera.plans import REGISTRY as QUERIES


def brute(rows, bands):
    return sorted((i, b) for i, x in rows for b, lo, hi in bands
                  if None not in (x, lo, hi) and lo <= x <= hi)


def run(spark, rows, bands):
    r = spark.createDataFrame(rows, "i int, x double")
    b = spark.createDataFrame(bands, "b int, lo double, hi double")
    df = band_join(r, b, "x", "lo", "hi")
    assert df.columns == ["i", "x", "b", "lo", "hi"]
    return df, sorted((t["i"], t["b"]) for t in df.collect())


def test_bands_by_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([rng.uniform(-100, 100), float(rng.randrange(-5, 5)), rng.uniform(-1e9, 1e9), rng.uniform(-1e-6, 1e-6)])) for i in range(800)]
    rows += [(900, None), (901, float("nan")), (902, float("inf")), (903, 0.0), (904, -0.0), (905, 1e300), (906, 5e-324)]
    bands = []
    for b in range(300):
        lo = rng.choice([rng.uniform(-100, 100), float(rng.randrange(-5, 5)), rng.uniform(-1e9, 1e9), 0.0])
        bands.append((b, lo, lo + rng.choice([0.0, 1e-9, 0.5, 1.0, 3.0, 64.0, 1e6])))
    bands += [(400, None, 1.0), (401, 0.0, None), (402, 2.0, 1.0), (403, float("nan"), 1.0), (404, 1e299, 2e300), (405, 0.0, 0.0), (406, -1e300, 1e300)]
    assert run(spark, rows, bands)[1] == brute(rows, bands)


def test_no_comparison_of_all_pairs(spark):
    rows = [(i, float(i % 5000)) for i in range(20_000)]
    bands = [(b, float(b), b + 1.5) for b in range(5000)]
    df, got = run(spark, rows, bands)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert len(got) == sum(4 * (1 + (x >= 1)) for x in range(5000))


def test_no_bands(spark):
    assert run(spark, [(1, 1.0)], [])[1] == [] and run(spark, [], [(1, 0.0, 1.0)])[1] == []
    assert run(spark, [(1, 1.0)], [(1, 2.0, 1.0)])[1] == []


def summed(spark, rows, bands):
    r = spark.createDataFrame(rows, "i int, x double, q double")
    df = band_join(r, spark.createDataFrame(bands, "b int, lo double, hi double"), "x", "lo", "hi", sums=["q", "i"], count="m")
    assert df.columns == ["b", "lo", "hi", "m", "q", "i"]
    return df, sorted((t["b"], t["lo"], t["hi"], t["m"], t["q"], t["i"]) for t in df.collect())


def test_sums_of_bands_by_brute_force(spark):
    """Values, bands and whole rows that come twice; NULL, NaN and infinite ones; a NULL summand."""
    rng = random.Random(4)
    rows = [(i, rng.choice([float(rng.randrange(-20, 20)), rng.uniform(-30, 30)]), float(rng.randrange(50))) for i in range(400)]
    rows += [*rows[:9], (900, None, 1.0), (901, float("nan"), 1.0), (902, float("inf"), 1.0), (903, -0.0, 2.0), (904, 500.0, None), (905, 1e300, 3.0)]
    bands = [(b, lo := rng.choice([float(rng.randrange(-20, 20)), rng.uniform(-40, 40)]), lo + rng.choice([0.0, 1.0, 7.5, 60.0])) for b in range(120)]
    bands += [*bands[:5], (400, None, 1.0), (402, 2.0, 1.0), (403, float("nan"), 1.0), (404, 499.0, 501.0), (405, 0.0, 0.0), (406, -0.0, 0.0), (407, -1e300, 1e300), (408, 600.0, 700.0)]
    want = []
    for b, lo, hi in bands:
        inside = [r for r in rows if None not in (r[1], lo, hi) and lo <= r[1] <= hi]
        if inside:
            q = [q for _, _, q in inside if q is not None]
            want.append((b, lo, hi, len(inside), sum(q) if q else None, sum(i for i, _, _ in inside)))
    assert summed(spark, rows, bands)[1] == sorted(want)
    assert summed(spark, rows, [])[1] == [] and summed(spark, [], bands)[1] == [] and summed(spark, rows, [(1, 2.0, 1.0)])[1] == []


def test_line_items_and_parts_that_all_meet(spark, tmp_path):
    """price_bands where each of 60,000 line items is in all bands but every seventh of
    60,000 parts: 3 thousand million pairs, no row of which is made."""
    n = 60_000
    spark.sql(f"select id l_orderkey, 2.0d l_quantity, if(id = 7, 8.0d, 2000.2d + id % 3 * 0.02d) l_extendedprice from range({n})").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql(f"select id p_partkey, 1000.0d p_retailprice from range({n})").write.parquet(f"{tmp_path}/part.parquet")
    out = QUERIES["price_bands"].build(spark, str(tmp_path)).orderBy("p_partkey").collect()
    assert [tuple(r) for r in out] == [(b, n - 1, 2.0 * (n - 1)) for b in range(n) if b % 7]
