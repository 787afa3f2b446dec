"""The quarterly series: sixteen measures of three stages for every place and quarter, with its side tallies and checks.

The records of a wide file are read once and give one row for each stage they
report; everything else is aggregates of those rows, which combine before the
shuffle. The grid of places and quarters has the places' size, not the records'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaploom.functions import identifiers as I
from snaploom.functions.scalars import calendar_day, let, plain_number, strip
from snaploom.operators.activities import A2_ACTIVITIES, Activity, count_or_zero
from snaploom.operators.relational import mode_share, quarter_spine

# fixed values: the stages' names in the series, the measures in their order, and the labels they count
STAGES = {"entitlement": "entitlements", "permit": "permits", "completion": "completions"}
MEASURES = ("vli", "li", "mi", "ami", "total", "deed_restricted", "sfd", "sfa", "2_to_4", "5_plus", "adu", "mh", "sb35", "sb9", "ab2011", "density_bonus")
UNIT_CATEGORIES = {"SFD": "sfd", "SFA": "sfa", "2 TO 4": "2_to_4", "5+": "5_plus", "ADU": "adu", "MH": "mh"}
PROGRAMS = {"Y": "sb35", "SB 35 (2017)": "sb35", "SB 423 (2023)": "sb35", "SMAP": "sb35", "SB 9 (2021) - DUPLEX IN SF ZONE": "sb9", "SB 9 (2021) - RESIDENTIAL LOT SPLIT": "sb9", "AB 2011 (2022)": "ab2011"}
NO_PROGRAMS = ("", "N", "NONE", "0")
SKIPPED_PROGRAMS = ("SB 4 (2023)", "SB 6 (2022)")
FLAGS = ("no_apr_rows", "permit_dates_heaped", "entitlement_dates_heaped", "completion_dates_heaped", "provisional_year")
HEAPED_ROWS, HEAPED_SHARE = 10, 0.5
# fixed values: where the other fields are among the 69 columns (from 1)
PLACE, YEAR, UNIT_CATEGORY, PROGRAM, BONUS = 1, 3, 9, 51, 61


def lookup(c: Column, known: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in known.items() for x in pair])[c]


def provisional(last_updated: Column, year: Column) -> Column:
    """A year is provisional up to the end of June of the next one."""
    return last_updated <= F.make_date(year + 1, F.lit(6), F.lit(30))


def stage_rows(loaded: DataFrame, key: str = "source_index", values: str = "raw_values", stages: tuple[Activity, ...] = A2_ACTIVITIES) -> DataFrame:
    """One row for each record and stage that reports units: its place, day, bands, deed-restricted units, category, programs and bonus.

    A bonus that isn't a number counts as none, and is marked.
    """
    v = F.col(values)

    def units(at: tuple[int, ...]) -> Column:
        return F.aggregate(F.array(*[count_or_zero(v[i - 1]) for i in at]), F.lit(0).cast("bigint"), lambda s, x: s + x)

    def one(a: Activity) -> Column:
        # bands come in pairs, with and without a deed restriction, but for the last
        pairs = [a.bands[i : i + 2] for i in range(0, len(a.bands), 2)]
        of = {"vli": sum(pairs[:3], ()), "li": pairs[3], "mi": pairs[4], "ami": pairs[5], "total": a.bands, "deed_restricted": tuple(p[0] for p in pairs[:-1])}
        return F.struct(F.lit(a.name).alias("stage"), calendar_day(v[a.day - 1]).alias("day"), count_or_zero(v[a.total - 1]).alias("reported"), *[units(at).alias(n) for n, at in of.items()])

    bonus = let(strip(v[BONUS - 1]), lambda t: F.when(t == "", F.lit(0.0)).otherwise(plain_number(t).try_cast("double")))
    each = loaded.select(
        key, I.key(v[PLACE - 1]).alias("place"), count_or_zero(v[YEAR - 1]).cast("int").alias("report_year"), I.key(v[UNIT_CATEGORY - 1]).alias("unit_category"),
        I.labels(v[PROGRAM - 1], NO_PROGRAMS).alias("labels"), bonus.alias("bonus"), F.explode(F.array(*[one(a) for a in stages])).alias("s"),
    )
    return each.select(key, "place", "report_year", "unit_category", "labels", F.coalesce("bonus", F.lit(0.0)).alias("bonus"), F.col("bonus").isNull().alias("bonus_unread"), "s.*").where("total > 0 or reported > 0")


def located(rows: DataFrame, places: DataFrame, key: str = "juris_key", display: str = "juris_display") -> DataFrame:
    """The rows with the key of their place, by either of its names; others have a null one, so that none is lost from counts."""
    names = places.select(F.col(key).alias("key"), F.explode(F.array(key, display)).alias("name")).select("key", I.key(F.col("name")).alias("name")).distinct()
    return rows.join(names, F.col("place") == F.col("name"), "left").drop("name").withColumnRenamed("key", key)


def measures() -> list[Column]:
    """The sixteen sums of a cell."""
    total = F.col("total")
    category, programs = lookup(F.col("unit_category"), UNIT_CATEGORIES), F.array_distinct(F.transform("labels", lambda x: lookup(x, PROGRAMS)))
    sums = {m: F.col(m) for m in MEASURES[:6]}
    sums |= {m: F.when(category == m, total) for m in UNIT_CATEGORIES.values()}
    # a programme counts a row's units once, however many labels name it
    sums |= {m: F.when(F.array_contains(programs, m), total) for m in ("sb35", "sb9", "ab2011")}
    sums["density_bonus"] = F.when(F.col("bonus") > 0, total)
    return [F.coalesce(F.sum(sums[m]), F.lit(0)).alias(m) for m in MEASURES]


def cells(rows: DataFrame, key: str = "juris_key") -> DataFrame:
    """(stage, key, year, quarter, sixteen measures) of the dated rows."""
    dated = rows.where("day is not null")
    return dated.groupBy("stage", key, F.year("day").alias("year"), F.quarter("day").alias("quarter")).agg(*measures())


def heaped(rows: DataFrame, key: str = "juris_key") -> DataFrame:
    """(stage, key, year, dated_rows, date, rows, share): where one day has at least half of a year's rows."""
    dated = rows.where("day is not null").select("stage", key, F.year("day").alias("year"), "day")
    return mode_share(dated, ["stage", key, "year"], "day", HEAPED_ROWS, HEAPED_SHARE).toDF("stage", key, "year", "dated_rows", "date", "rows", "share")


def series(rows: DataFrame, file_rows: DataFrame, places: DataFrame, first_year: int, last_year: int, last_updated: Column, key: str = "juris_key") -> DataFrame:
    """The dense table: for each place and quarter its flags and the measures of all stages.

    ``file_rows`` has the place and report year of every record of the file, for the number of rows a place filed.
    """
    cube = cells(rows, key).groupBy(key, "year", "quarter").agg(*[F.coalesce(F.sum(F.when(F.col("stage") == s, F.col(m))), F.lit(0)).alias(f"{name}_{m}") for s, name in STAGES.items() for m in MEASURES])
    filed = file_rows.groupBy(key, F.col("report_year").alias("year")).agg(F.count("*").alias("table_a2_rows"))
    heaps = heaped(rows, key).groupBy(key, "year").agg(F.collect_set("stage").alias("heaps"))
    grid = quarter_spine(places, key, first_year, last_year).withColumnRenamed("starts", "quarter_start")
    every = grid.join(filed, [key, "year"], "left").join(heaps, [key, "year"], "left").join(cube, [key, "year", "quarter"], "left")
    raised = {"no_apr_rows": F.col("table_a2_rows").isNull(), "provisional_year": provisional(last_updated, F.col("year"))} | {f"{s}_dates_heaped": F.array_contains("heaps", s) for s in STAGES}
    flags = F.array_join(F.array_compact(F.array(*[F.when(raised[f], F.lit(f)) for f in FLAGS])), ",")
    names = [f"{n}_{m}" for n in STAGES.values() for m in MEASURES]
    return every.select(F.concat_ws("|", key, F.concat("year", F.lit("-Q"), "quarter")).alias("key"), key, "year", "quarter", "quarter_start", F.coalesce("table_a2_rows", F.lit(0)).alias("table_a2_rows"), flags.alias("data_flags"), *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def series_checks(table: DataFrame, places: DataFrame, first_year: int, last_year: int, key: str = "juris_key") -> DataFrame:
    """(check, objects_checked, failures): that the grid is dense and its keys are unique, that bands and categories add up to no more than totals, and that no measure is below zero."""
    quarters = 4 * (last_year - first_year + 1)
    grid = table.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))
    per_place = places.select(key).join(grid, key, "full").agg(F.count("*").alias("objects_checked"), F.count_if(F.coalesce(F.col("n") != quarters, F.lit(True)) | (F.col("keys") != quarters)).alias("failures"))
    names = [f"{n}_{m}" for n in STAGES.values() for m in MEASURES]

    def over(n: str, parts: tuple[str, ...], exact: bool) -> Column:
        whole = sum((F.col(f"{n}_{m}") for m in parts[1:]), F.col(f"{n}_{parts[0]}"))
        return whole != F.col(f"{n}_total") if exact else whole > F.col(f"{n}_total")

    def per_cell(wrong: list[Column]) -> DataFrame:
        bad = F.lit(False)
        for w in wrong:
            bad = bad | w
        return table.agg(F.count("*").alias("objects_checked"), F.count_if(bad).alias("failures"))

    checks = {
        "dense grid, unique keys": per_place,
        "bands add up to totals": per_cell([over(n, MEASURES[:4], True) for n in STAGES.values()]),
        "categories are within totals": per_cell([over(n, tuple(UNIT_CATEGORIES.values()), False) for n in STAGES.values()]),
        "no measure below zero": per_cell([F.col(c) < 0 for c in names]),
    }
    out = [df.select(F.lit(c).alias("check"), "objects_checked", "failures") for c, df in checks.items()]
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])
