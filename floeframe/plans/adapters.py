"""The driver's tables read as rasters, codes, scenes and tables of patches; the same in SQL.

Line items are pixels of three scenes of 300 x 300, suppliers are chart polygons, parts are coded polygons,
orders are scenes over time. Missing values are put in where an expression of the keys says so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 300


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    nan = F.lit(float("nan"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("scene_id"),
        (F.col("l_orderkey") % SIDE).alias("row"),
        (F.col("l_partkey") * 7 % SIDE).alias("col"),
        F.when(F.col("l_linenumber") == 7, nan).otherwise(-F.col("l_quantity") / 2).alias("hh"),
        F.when(F.col("l_tax") >= 0.08, nan).otherwise(-20 - F.col("l_discount") * 50).alias("hv"),
        (F.col("l_orderkey") % 42).cast("int").alias("distance"),
        F.when(F.col("l_suppkey") % 29 == 0, 65535).otherwise(F.col("l_suppkey")).cast("int").alias("poly_id"),
        F.when(F.col("l_linenumber") == 6, nan).otherwise(F.col("l_extendedprice") / 500).alias("t2m"),
    )


PIXELS = """px AS (
    SELECT l_returnflag AS scene_id, l_orderkey % 300 AS "row", l_partkey * 7 % 300 AS col,
        CASE WHEN l_linenumber = 7 THEN 'NaN'::DOUBLE ELSE -l_quantity / 2 END AS hh,
        CASE WHEN l_tax >= 0.08 THEN 'NaN'::DOUBLE ELSE -20 - l_discount * 50 END AS hv,
        CAST(l_orderkey % 42 AS INTEGER) AS distance,
        CAST(CASE WHEN l_suppkey % 29 = 0 THEN 65535 ELSE l_suppkey END AS INTEGER) AS poly_id,
        CASE WHEN l_linenumber = 6 THEN 'NaN'::DOUBLE ELSE l_extendedprice / 500 END AS t2m
    FROM lineitem
), pv AS (
    SELECT *, (distance <> 0 AND NOT isnan(hh) AND NOT isnan(hv)) AS valid FROM px
)"""

#: Codes by s_suppkey % 13.
CODES = ["80", "0", "55", "91", "92", "-9", "99", "50-70", "90-92", " 10 ", "30", "40-60", "20"]
MEANS = {"80": 8, "0": 0, "55": 0, "91": 10, "92": 10, "50-70": 6, "90-92": 9.5, " 10 ": 1, "30": 3, "40-60": 5, "20": 2}


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygon codes of every scene, as the `;`-separated rows that charts hold."""
    code = F.get(F.array(*map(F.lit, CODES)), (F.col("s_suppkey") % len(CODES)).cast("int"))
    line = F.concat_ws(";", "s_suppkey", code, F.lit("x")).alias("code")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("poly_id"), line)
    scenes = F.array(*map(F.lit, ("A", "N", "R")))
    return rows.select(F.explode(scenes).alias("scene_id"), "poly_id", F.lit("poly_id;CT;CA").alias("header"), "code", F.col("poly_id").alias("line"))


CODE_MEANS = "cm AS (SELECT CAST(s_suppkey AS INTEGER) AS poly_id, CASE s_suppkey % 13 " + " ".join(f"WHEN {i} THEN {MEANS[c]}" for i, c in enumerate(CODES) if c in MEANS) + " END::DOUBLE AS ct FROM supplier)"

CHIPS = """chips AS (
    SELECT v.*, r0.s AS row0, c0.s AS col0, CAST((v."row" - r0.s) // 8 AS BIGINT) AS patch_i, CAST((v.col - c0.s) // 8 AS BIGINT) AS patch_j,
        format('{}_r{:05d}_c{:05d}', v.scene_id, r0.s, c0.s) AS chip_id
    FROM pv v JOIN (VALUES (0), (44)) r0(s) ON v."row" >= r0.s AND v."row" < r0.s + 256
    JOIN (VALUES (0), (44)) c0(s) ON v.col >= c0.s AND v.col < c0.s + 256
)"""


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded polygons: total, three partial concentrations, stages and floe forms, and the kind of polygon."""
    pick = lambda values, key: F.get(F.expr(f"array({', '.join(map(repr, values))})"), (key % len(values)).cast("int"))
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("poly_id"), pick((0, 10, 90, 92, 50, 70, 99), k).alias("ct"),
        pick((-9, 40, 60, 80), k).alias("ca"), pick((-9, 20, 30), F.floor(k / 2)).alias("cb"), pick((-9, 10), F.floor(k / 3)).alias("cc"),
        pick((81, 83, 86, 95, -9), k).alias("sa"), pick((81, 84, 87, -9), F.floor(k / 2)).alias("sb"), pick((86, 97, -9), F.floor(k / 5)).alias("sc"),
        pick((2, 3, 8, 6, -9), F.floor(k / 3)).alias("fa"), pick((3, 4, -9, 6), k).alias("fb"), pick((5, -9, 9), F.floor(k / 7)).alias("fc"),
        pick(("I", "W", "I"), F.floor(k / 4)).alias("kind"),
    )


def _pick(values, key: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[CAST(({key}) % {len(values)} AS INTEGER) + 1]"


POLYGONS = f"""pg AS (
    SELECT p_partkey AS poly_id, {_pick((0, 10, 90, 92, 50, 70, 99), 'p_partkey')} AS ct,
        {_pick((-9, 40, 60, 80), 'p_partkey')} AS ca, {_pick((-9, 20, 30), 'p_partkey // 2')} AS cb, {_pick((-9, 10), 'p_partkey // 3')} AS cc,
        {_pick((81, 83, 86, 95, -9), 'p_partkey')} AS sa, {_pick((81, 84, 87, -9), 'p_partkey // 2')} AS sb, {_pick((86, 97, -9), 'p_partkey // 5')} AS sc,
        {_pick((2, 3, 8, 6, -9), 'p_partkey // 3')} AS fa, {_pick((3, 4, -9, 6), 'p_partkey')} AS fb, {_pick((5, -9, 9), 'p_partkey // 7')} AS fc,
        {_pick(('I', 'W', 'I'), 'p_partkey // 4')} AS kind
    FROM part
)"""
