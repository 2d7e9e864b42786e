"""Profiles: catalogues beyond the broadcast bound, repeated listings, NULL keys."""

from pyspark.sql import functions as F

from tessera.operators import profile as P


def _tables(spark, apps):
    opens = spark.range(0, 3000, 1, 4).select(
        (F.col("id") % 17).alias("guid"), (F.col("id") * 7 % apps).alias("app_name"),
        F.concat(F.lit("2024010"), (F.col("id") % 5).cast("string")).alias("day"))
    opens = opens.unionByName(spark.createDataFrame([(None, 1, "20240101"), (3, None, "20240101"), (3, 1, None)], opens.schema))
    meta = spark.range(0, apps).select(
        F.col("id").alias("app_name"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), F.col("id") % 4)).alias("category"),
        F.lit("s").alias("sub_category"), F.concat_ws(",", F.lit("a"), F.lit(""), F.col("id").cast("string")).alias("tags"))
    return opens, meta.unionByName(meta.where("app_name = 1"))


def _brute(opens, meta):
    """``{guid: {(family, key): (days, times, apps)}}``"""
    keys = {}
    for a, c, s, t in meta:
        keys.setdefault(a, []).extend([("category", c)] * bool(c) + [("sub_category", s)] + [("tag", x) for x in t.split(",")])
    out = {}
    for g, a, d in opens:
        for k in keys.get(a, []):
            days, times, used = out.setdefault(g, {}).setdefault(k, (set(), [], set()))
            used.add(a)
            if d is not None:
                days.add(d)
                times.append(d)
    return {g: {k: (len(x), len(y), len(z)) for k, (x, y, z) in m.items()} for g, m in out.items()}


def test_profile_by_brute_force_with_listings_repeated(spark):
    opens, meta = _tables(spark, 60)
    want = _brute([tuple(r) for r in opens.collect()], [tuple(r) for r in meta.collect()])
    for bound in ("10485760", "0"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        try:
            got = {r["guid"]: r for r in P.app_profile(None, opens, meta, "d").collect()}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert set(got) == {g for g in want}
        for g, r in got.items():
            for fam, name in (("category", "category"), ("sub_category", "subcategory"), ("tag", "tag")):
                mine = {k: v for (f, k), v in want[g].items() if f == fam}
                assert (r[f"install_{name}_count"] or {}) == {k: 1 if fam == "tag" else v[2] for k, v in mine.items()}
                if g is not None:  # a NULL user meets no opens
                    assert (r[f"open_{name}_days"] or {}) == {k: v[0] for k, v in mine.items()}
                    assert (r[f"open_{name}_times"] or {}) == {k: v[1] for k, v in mine.items()}


def test_large_catalogue_is_not_broadcast(spark, tmp_path):
    """Few bytes on disk, many rows: Spark's estimate alone would broadcast them."""
    _, meta = _tables(spark, 60)
    big = spark.range(0, 400_000).select(F.col("id").alias("app_name"), F.lit("c").alias("category"), F.lit("s").alias("sub_category"),
                                         F.lit("a,b").alias("tags"))
    big.write.parquet(str(tmp_path / "apps"))
    dims = P.app_dimensions(spark.read.parquet(str(tmp_path / "apps")))
    opens, _ = _tables(spark, 60)
    inst = opens.select("guid", "app_name").distinct()
    for df in (P.install_dim_counts(inst, dims["category"], "category"), P.install_tag_counts(inst, dims["tag"]),
               P.open_dim_stats(opens, dims["tag"], "tag")):
        df.collect()
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_given_installs_keep_repeats_and_users_without_apps(spark):
    opens, meta = _tables(spark, 6)
    inst = spark.createDataFrame([(1, 4), (1, 4), (1, 1), (2, None), (None, 2)], "guid long, app_name long")
    got = {r["guid"]: r for r in P.app_profile(inst, opens, meta, "d").collect()}
    assert {g: r["install_app"] for g, r in got.items()} == {1: [1, 4, 4], 2: [], None: [2]}
    assert got[1]["install_category_count"] == {"c1": 1, "c0": 1} and got[1]["install_tag_count"] == {"a": 1, "": 1, "1": 1, "4": 1}
    assert got[2]["install_tag_count"] is None and got[None]["install_subcategory_count"] == {"s": 1} and got[None]["open_app_days"] is None
