"""App install / usage profiles (PRO-01 .. PRO-05, AGG-01 .. AGG-09, AGG-18).

Inputs are long tables:

* ``opens``    -- one row per app open: ``(guid, app_name, day)``
* ``installs`` -- one row per installed app: ``(guid, app_name)``
* app metadata -- ``(app_name, category, sub_category, tags)``

Plan shape: opens are first reduced to ``(guid, app_name, day, n)`` -- one
row per user, app and day with the number of opens.  Every feature family
(app, category, sub-category, tag) derives from that one pre-aggregate, so
the raw open log is scanned and shuffled once; days per category stay exact
because the day column is kept.  Per-user maps are ``collect_list`` of one
entry per distinct key, so their size is bounded by the app catalogue, not
by the number of events.  Dimension joins broadcast a catalogue whose counted
rows fit ``autoBroadcastJoinThreshold``; a larger one meets the rows in a
sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.maps import count_map
from ..functions.scalar import epoch_ms_to_day, non_blank
from ..session import cut_lineage
from .skew import sized

# The four tag bands of the tag-distribution report (PRO-05),
# half-open [low, high).
TAG_BANDS = [
    ("producer", 1120000000, 1130000000),
    ("interest", 1110000000, 1120000000),
    ("mp_media", 1500, 1980),
    ("function", 3000000, 3001506),
]


# ----------------------------------------------------------- inputs ---

def open_actions_from_events(events: DataFrame) -> DataFrame:
    """GEN-01 + DAT-01: open events with an array of ``open_time`` structs ->
    ``(guid, app_name, day)``; rows with a NULL or empty array drop out."""
    return (events.where(F.col("guid").isNotNull())
            .select("guid", "app_name", F.explode("open_time_and_ip").alias("o"))
            .select("guid", "app_name", epoch_ms_to_day(F.col("o.open_time")).alias("day")))


def installs_from_events(events: DataFrame) -> DataFrame:
    """GEN-02 + AGG-12: install lists -> distinct ``(guid, app_name)``."""
    return (events.where(F.col("guid").isNotNull())
            .select("guid", F.explode("installed_applist").alias("app_name"))
            .distinct())


def app_dimensions(meta: DataFrame, tag_sep: str = ",") -> dict[str, DataFrame]:
    """PRO-01: category, sub-category and tag dimensions.

    Categories must be non-blank; tags come from non-blank tag strings split on
    ``tag_sep`` and keep empty pieces (``a,,b`` has the tag ``''``).  No
    de-duplication: an app listed twice multiplies its opens (Q7)."""
    category = meta.where(non_blank("category")).select("app_name", "category")
    sub = meta.where(non_blank("sub_category")).select("app_name", "sub_category")
    tags = (meta.where(non_blank("tags"))
            .select("app_name", F.explode(F.split("tags", _escape(tag_sep), -1)).alias("tag")))
    return {"category": category, "sub_category": sub, "tag": tags}


def _escape(s: str) -> str:
    return "".join("\\" + c if c in ".^$*+?()[]{}|\\" else c for c in s)


_DIM_BYTES = 96  # a dimension row in a hash table


def _of_apps(rows: DataFrame, dim: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the dimension rows of their app; a counted catalogue beyond the
    broadcast bound is joined by shuffle, so no task and no driver holds it."""
    return rows.join(sized(dim, dim.count(), _DIM_BYTES), "app_name", how)


# ---------------------------------------------------- open features ---

def daily_opens(opens: DataFrame) -> DataFrame:
    """``(guid, app_name, day, n)``: the shared pre-aggregate (map-side
    combined, so a hot user is reduced before the shuffle)."""
    return opens.groupBy("guid", "app_name", "day").agg(F.count("day").alias("n"))


def open_app_stats(opens: DataFrame) -> DataFrame:
    """AGG-01: ``(guid, app_name, day_count, times)`` -- distinct days and
    number of opens with a day."""
    d = daily_opens(opens).where(non_blank(F.col("app_name").cast("string")))
    return (d.groupBy("guid", "app_name")
             .agg(F.count("day").alias("day_count"), F.sum("n").alias("times")))


def open_dim_stats(opens: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """AGG-02/03/04: ``(guid, key, days, times)`` through a dimension."""
    d = daily_opens(opens)
    j = _of_apps(d, dim)
    if key != "tag":
        j = j.where(non_blank(key))
    per_day = j.groupBy("guid", key, "day").agg(F.sum("n").alias("n"))
    return (per_day.groupBy("guid", key)
                   .agg(F.count("day").alias("days"), F.sum("n").alias("times")))


# ------------------------------------------------- install features ---

def install_dim_counts(installs: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """AGG-05/06: ``(guid, key, count)`` = distinct installed apps per key."""
    j = _of_apps(installs, dim)
    if key != "tag":
        j = j.where(non_blank(key))
    return j.groupBy("guid", key).agg(F.count_distinct("app_name").alias("count"))


def install_tag_counts(installs: DataFrame, tag_dim: DataFrame, mode: str = "presence") -> DataFrame:
    """AGG-07: per (guid, tag).  ``presence`` reproduces the reference, which
    counts distinct tags per tag (always 1); ``apps`` counts the apps."""
    j = _of_apps(installs, tag_dim)
    if mode == "apps":
        return j.groupBy("guid", "tag").agg(F.count_distinct("app_name").alias("count"))
    return j.select("guid", "tag").distinct().withColumn("count", F.lit(1).cast("bigint"))


def installed_list(installs: DataFrame) -> DataFrame:
    """AGG-09: ``(guid, install_app)`` sorted app list (bounded by catalogue)."""
    return installs.groupBy("guid").agg(F.array_sort(F.collect_list("app_name")).alias("install_app"))


# -------------------------------------------------------- full tables ---

PROFILE_COLUMNS = ["guid", "install_app", "install_category_count", "install_subcategory_count",
                   "install_tag_count", "open_app_days", "open_app_times", "open_category_days",
                   "open_category_times", "open_subcategory_days", "open_subcategory_times", "open_tag_days",
                   "open_tag_times", "date_p"]

FAMILIES = ("category", "sub_category", "tag")
_ROWS_A_TASK = 120_000  # daily rows, before their keys are exploded


def _family_keys(meta: DataFrame, tag_sep: str) -> DataFrame:
    """``(app_name, keys)``: every (family, key) of an app in one row, with the same
    rules as ``app_dimensions`` (non-blank category and sub-category; tags split
    from non-blank tag text, empty pieces kept); an app listed twice has its keys twice."""
    entry = "struct<fam:string,key:string>"
    one = [F.when(non_blank(c), F.struct(F.lit(c).alias("fam"), F.col(c).cast("string").alias("key")))
           for c in ("category", "sub_category")]
    tags = F.when(non_blank("tags"),
                  F.transform(F.split("tags", _escape(tag_sep), -1),
                              lambda x: F.struct(F.lit("tag").alias("fam"), x.alias("key"))))
    allk = F.concat(F.array(*one).cast(f"array<{entry}>"),
                    F.coalesce(tags.cast(f"array<{entry}>"), F.array().cast(f"array<{entry}>")))
    known = F.filter(allk, lambda k: k.isNotNull())
    return (meta.where(F.col("app_name").isNotNull()).groupBy("app_name")
                .agg(F.flatten(F.collect_list(known)).alias("keys")))


def _family_map(fam: str, key: str, value: str):
    """Aggregate expression: the map of one family from a user's rows (a
    conditional ``collect_list`` -- NULL rows are skipped), NULL when the user
    has no entry of that family (as a left join would give)."""
    entries = F.array_sort(F.collect_list(F.when(F.col("fam") == fam,
                                                 F.struct(F.col(key).alias("k"), F.col(value).alias("v")))))
    return F.when(F.size(entries) > 0, F.map_from_entries(entries))


def app_profile(installs: DataFrame | None, opens: DataFrame, meta: DataFrame, date_p: str,
                tag_sep: str = ",", dedupe_meta: bool = False) -> DataFrame:
    """PRO-04: installed users left-joined with their open features, plus the
    partition column.  Users with opens but no installs are not in the output
    (the reference drives from installs, Q10).

    Plan: one daily pre-aggregate of the opens, checkpointed, feeds
    everything; it meets the keys of the apps, one row per app, and is dealt by
    user.  All that follows, from exploding the keys to the maps and the final
    join, is grouped by user within a task, so the exploded rows are never
    shuffled.  ``installs=None`` derives installs from the opens (distinct
    user/app pairs).  ``dedupe_meta`` removes duplicate metadata rows (the
    reference multiplies open times when an app is listed twice, Q7).
    """
    keys = _family_keys(meta, tag_sep)
    if dedupe_meta:  # Q7 option: an app listed twice no longer multiplies its opens
        keys = keys.withColumn("keys", F.array_distinct("keys"))
    keys = cut_lineage(keys)
    daily = cut_lineage(daily_opens(opens))  # the open log is read once, here
    parts = max(opens.sparkSession.sparkContext.defaultParallelism, daily.count() // _ROWS_A_TASK)

    def by_user(rows: DataFrame) -> DataFrame:
        return _of_apps(rows, keys, "left").repartition(parts, "guid")

    used = by_user(daily)
    kind = daily.schema["app_name"].dataType.simpleString()
    entry = f"array<struct<fam:string,app:{kind},key:string>>"
    app = F.array(F.struct(F.lit("app").alias("fam"), F.col("app_name").alias("app"), F.lit(None).cast("string").alias("key")))
    rest = F.transform("keys", lambda k: F.struct(k["fam"].alias("fam"), F.lit(None).cast(kind).alias("app"), k["key"].alias("key")))
    none = F.array().cast(entry)
    entries = F.concat(F.when(non_blank(F.col("app_name").cast("string")), app.cast(entry)).otherwise(none),
                       F.coalesce(rest.cast(entry), none))
    open_long = (used.select("guid", "day", "n", F.explode(entries).alias("e")).select("guid", "day", "n", "e.*")
                 .groupBy("guid", "fam", "app", "key", "day").agg(F.sum("n").alias("n"))
                 .groupBy("guid", "fam", "app", "key").agg(F.count("day").alias("days"), F.sum("n").alias("times")))
    open_cols = [_family_map("app", "app", "days").alias("open_app_days"),
                 _family_map("app", "app", "times").alias("open_app_times")]
    for fam, prefix in (("category", "open_category"), ("sub_category", "open_subcategory"), ("tag", "open_tag")):
        open_cols += [_family_map(fam, "key", "days").alias(f"{prefix}_days"),
                      _family_map(fam, "key", "times").alias(f"{prefix}_times")]
    opened = open_long.groupBy("guid").agg(*open_cols)

    # installs derived from the opens come from the same dealt rows; an app is listed as
    # often as it is installed and counts once for a key
    if installs is None:
        inst = used.where(non_blank(F.col("app_name").cast("string"))).groupBy("guid", "app_name", "keys").agg(F.lit(1).alias("m"))
    else:
        inst = by_user(cut_lineage(installs)).groupBy("guid", "app_name", "keys").agg(F.count(F.lit(1)).cast("int").alias("m"))
    once = F.concat(app.cast(entry), F.coalesce(F.array_distinct(rest.cast(entry)), none))
    inst_long = (inst.select("guid", "m", F.explode(once).alias("e")).select("guid", "m", "e.*")
                 .groupBy("guid", "fam", "app", "key").agg(F.max("m").alias("m"), F.count(F.lit(1)).alias("apps"))
                 .withColumn("count", F.when(F.col("fam") == "tag", F.lit(1).cast("bigint")).otherwise(F.col("apps"))))
    listed = F.collect_list(F.when((F.col("fam") == "app") & F.col("app").isNotNull(), F.struct("app", "m")))
    inst_cols = [F.flatten(F.transform(F.array_sort(listed), lambda e: F.array_repeat(e["app"], e["m"]))).alias("install_app")]
    for fam, name in (("category", "install_category_count"), ("sub_category", "install_subcategory_count"),
                      ("tag", "install_tag_count")):
        inst_cols.append(_family_map(fam, "key", "count").alias(name))
    installed = inst_long.groupBy("guid").agg(*inst_cols)
    out = installed.join(opened, "guid", "left")
    return out.withColumn("date_p", F.lit(str(date_p))).select(*PROFILE_COLUMNS)


# ------------------------------------------------- tag distribution ---

def parse_distribution(df: DataFrame, cell: str = "distr") -> DataFrame:
    """GEN-07: ``k:v<TAB>k:v`` -> rows ``(k double, v bigint)``."""
    kv = df.select("*", F.explode(F.split(F.col(cell), "\t", -1)).alias("_kv"))
    parts = F.split("_kv", ":", -1)
    return kv.select(*[c for c in df.columns if c != cell],
                     F.get(parts, 0).cast("double").alias("k"),
                     F.get(parts, 1).cast("bigint").alias("v"))


def band_of(tagid, bands=TAG_BANDS):
    """FLT-04: band name for an integer tag id (NULL outside every band)."""
    tagid = F.col(tagid) if isinstance(tagid, str) else tagid
    expr = None
    for name, lo, hi in bands:
        cond = (tagid >= lo) & (tagid < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def tag_distribution(df: DataFrame, bands=TAG_BANDS) -> DataFrame:
    """PRO-05: drop ``\\N`` tag ids, cast to int, assign a band, explode the
    histogram cell and sum the counts per (band, k)."""
    t = (df.where(F.col("tagid") != "\\N")
           .withColumn("tagid", F.col("tagid").cast("bigint"))
           .withColumn("band", band_of("tagid", bands))
           .where(F.col("band").isNotNull()))
    return parse_distribution(t).groupBy("band", "k").agg(F.sum("v").alias("sum_v"))
