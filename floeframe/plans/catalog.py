"""Every query over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floeframe.functions import codes, encodings, geo, masks, tiling
from floeframe.operators import array_features, audit, distance, explore, inference, matching, moments, patches, resampling, sampling, scores, tiles, validation, warp
from floeframe.plans.adapters import CHIPS, CODE_MEANS, PIXELS, POLYGONS, SIDE, pixels, polygons, table
from floeframe.plans.adapters import codes as chart_codes
from floeframe.schema import FRACTIONS, GRID, TOKEN
from floeframe.sources import scenes, tables
from floeframe.streaming import running

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Rounded, and without a negative zero."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + 0.0 for c in columns})


def r6(x: str, name: str) -> str:
    return f"round({x}, 6) + 0.0 AS {name}"


def valid_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels(spark, sf_dir).withColumn("valid", masks.valid(F.col("hh"), F.col("hv"), F.col("distance")))


def charted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid pixels with the tenths of their polygon."""
    named = chart_codes(spark, sf_dir).withColumn("CT", codes.field(F.col("header"), F.col("code"), "CT"))
    px = valid_pixels(spark, sf_dir).withColumn("poly_id", masks.polygon(F.col("poly_id")))
    return matching.chart_tenths(px, named)


def chipped(px: DataFrame) -> DataFrame:
    return tiling.with_chips(px, F.lit(SIDE), F.lit(SIDE))


def chip_flags(px: DataFrame) -> DataFrame:
    return patches.chip_flags(px, F.lit(SIDE), F.lit(SIDE))


CHARTED = f"{PIXELS}, {CODE_MEANS}, ch AS (SELECT pv.*, cm.ct FROM pv LEFT JOIN cm ON pv.poly_id = cm.poly_id AND pv.poly_id <> 65535)"
CHIPPED = f"{CHARTED}, {CHIPS.replace('FROM pv v', 'FROM ch v')}"
_COUNTS = ", ".join(f"count(*) FILTER (round_even(ct, 0) = {k}) AS c{k}" for k in range(11))
_SHARES = ", ".join(f"CASE WHEN n > 0 THEN CAST(c{k} / n::DOUBLE AS FLOAT) END AS frac_sic{k}" for k in range(11))


@query(f"""WITH {CHIPPED}, c AS (
    SELECT scene_id, chip_id, patch_i, patch_j, count(ct) AS n, {_COUNTS} FROM chips GROUP BY ALL
), f AS (SELECT scene_id, chip_id, patch_i, patch_j, n, {_SHARES} FROM c)
SELECT scene_id, chip_id, patch_i, patch_j, {", ".join(f"frac_sic{k}" for k in range(11))}, n / 64.0::DOUBLE AS valid_class_fraction,
    CASE WHEN n > 0 THEN floor({" + ".join(f"{k} * frac_sic{k}::DOUBLE" for k in range(11))}) ELSE -1 END AS label,
    coalesce(greatest({", ".join(f"frac_sic{k}" for k in range(11))}) = 1, false) AS is_pure FROM f""")
def patch_labels(spark, sf_dir):
    made = patches.labels(chipped(charted(spark, sf_dir)))
    # a NaN label is shown as -1: NaN has no one text form
    return made.withColumn("label", F.when(F.isnan("label"), -1.0).otherwise(F.col("label"))).select(*patches.KEY, *FRACTIONS, "valid_class_fraction", "label", "is_pure")


_RADAR = ", ".join(f"CASE WHEN count(*) FILTER (valid) > 0 THEN round({f}({x}) FILTER (valid), 6) + 0.0 END AS {n}" for f, x, n in (("avg", "hh", "hh_mean"), ("avg", "hv", "hv_mean"), ("stddev_pop", "hh", "hh_std"), ("stddev_pop", "hv", "hv_std"), ("avg", "hv - hh", "hv_hh_ratio")))


@query(f"WITH {PIXELS}, {CHIPS} SELECT scene_id, chip_id, patch_i, patch_j, {_RADAR}, count(*) FILTER (valid) / 64.0::DOUBLE AS valid_fraction FROM chips GROUP BY ALL")
def patch_radar(spark, sf_dir):
    made = patches.radar(chipped(valid_pixels(spark, sf_dir)))
    five = ["hh_mean", "hv_mean", "hh_std", "hv_std", "hv_hh_ratio"]
    return rounded(made.withColumns({c: masks.null_if_nan(F.col(c)) for c in five}), *five)


@query(f"WITH {PIXELS}, {CHIPS} SELECT scene_id, chip_id, patch_i, patch_j, CASE WHEN bool_or(isnan(t2m)) THEN NULL ELSE round(avg(t2m), 6) END AS t2m FROM chips GROUP BY ALL")
def patch_means(spark, sf_dir):
    made = patches.means(chipped(valid_pixels(spark, sf_dir)), ["t2m"])
    return rounded(made.withColumn("t2m", masks.null_if_nan(F.col("t2m"))), "t2m")


@query(f'WITH {PIXELS}, {CHIPS} SELECT scene_id, chip_id, patch_i, patch_j, max(CASE WHEN ("row" - row0) % 8 = 4 AND (col - col0) % 8 = 4 THEN distance END) AS distance_to_land FROM chips GROUP BY ALL')
def patch_centre_distance(spark, sf_dir):
    return patches.centre_distance(chipped(valid_pixels(spark, sf_dir)))


@query(f"WITH {CHIPPED} SELECT scene_id, chip_id FROM chips GROUP BY ALL HAVING bool_or(valid) AND count(ct) > 0")
def kept_chips(spark, sf_dir):
    return patches.kept_chips(chip_flags(charted(spark, sf_dir)))


@query(f"WITH {CHIPPED}, c AS (SELECT scene_id, chip_id, bool_or(valid) AS v, count(ct) > 0 AS l FROM chips GROUP BY ALL) SELECT scene_id, count(*) FILTER (NOT v) AS no_valid, count(*) FILTER (v AND NOT l) AS no_label FROM c GROUP BY scene_id")
def skipped_chips(spark, sf_dir):
    return patches.skipped_chips(chip_flags(charted(spark, sf_dir)))


@query(f'WITH {PIXELS}, {CHIPS} SELECT scene_id, chip_id, row0, col0, count(*) AS n, count(DISTINCT patch_i * 32 + patch_j) AS patches FROM chips GROUP BY ALL')
def overlapping_chips(spark, sf_dir):
    made = chipped(valid_pixels(spark, sf_dir)).groupBy("scene_id", "row0", "col0")
    patch = F.col("patch_i") * 32 + F.col("patch_j")
    made = made.agg(F.count("*").alias("n"), F.count_distinct(patch).alias("patches"))
    made = made.withColumn("chip_id", tiling.chip_id(F.col("scene_id"), F.col("row0"), F.col("col0")))
    return made.withColumns({c: F.col(c).cast("int") for c in ("row0", "col0")})


@query("SELECT o_orderkey, CAST(r.s AS INTEGER) AS row0, CAST(c.s AS INTEGER) AS col0 FROM orders, unnest(range(0, 256 + o_orderkey % 500, 256)) r(s0), unnest(range(0, 300, 256)) c(s0), LATERAL (SELECT least(r.s0, o_orderkey % 500) AS s) r(s), LATERAL (SELECT least(c.s0, 44) AS s) c(s)".replace("r(s0)", "ra(s0)").replace("r.s0", "ra.s0").replace("c(s0)", "ca(s0)").replace("c.s0", "ca.s0"))
def chip_grid(spark, sf_dir):
    scenes = table(spark, sf_dir, "orders").select("o_orderkey", (256 + F.col("o_orderkey") % 500).cast("int").alias("height"), F.lit(300).alias("width"))
    return tiling.chips(scenes).select("o_orderkey", "row0", "col0")


@query(f"WITH {PIXELS} SELECT scene_id, round(sum(CASE WHEN valid THEN hh ELSE -12.5 END), 4) AS total, count(*) FILTER (valid) AS n_valid FROM pv GROUP BY scene_id")
def mask_and_fill(spark, sf_dir):
    px = valid_pixels(spark, sf_dir)
    made = px.withColumn("hh", masks.filled(F.col("hh"), F.col("valid"), F.lit(-12.5)))
    return made.groupBy("scene_id").agg(F.round(F.sum("hh"), 4).alias("total"), F.count_if("valid").alias("n_valid"))


@query(f"WITH {PIXELS}, {CODE_MEANS} SELECT poly_id, ct FROM cm")
def chart_codes_decoded(spark, sf_dir):
    named = chart_codes(spark, sf_dir).where("scene_id = 'A'").withColumn("CT", codes.field(F.col("header"), F.col("code"), "CT"))
    return named.select("poly_id", codes.tenths(F.col("CT")).alias("ct"))


@query(f"WITH {CHARTED} SELECT scene_id, ct, count(*) AS n FROM ch GROUP BY ALL")
def charted_pixels(spark, sf_dir):
    return charted(spark, sf_dir).groupBy("scene_id", "ct").agg(F.count("*").alias("n"))


def _recoded(table_: dict, x: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {k} THEN {v}" for k, v in table_.items()) + f" ELSE {x} END"


def _dominant(c: str) -> str:
    add = f"CASE WHEN {c}a = {c}c AND {c}a <> -9 THEN cc WHEN {c}a = {c}b AND {c}a <> -9 THEN cb ELSE 0 END"
    b = f"cb + CASE WHEN {c}b = {c}c AND {c}b <> -9 THEN cc ELSE 0 END"
    a = f"ca + {add}"
    most = f"greatest({a}, {b}, cc)"
    which = f"CASE WHEN {a} = {most} THEN {c}a WHEN {b} = {most} THEN {c}b ELSE {c}c END"
    return f"CASE WHEN ct = 0 THEN CASE WHEN {most} > 0 THEN {which} ELSE -9 END WHEN {most} * 100 / ct::DOUBLE >= 65 THEN {which} ELSE -9 END"


_FIELDS = ", ".join(f"{_recoded(t, c)} AS {c}" for t, cs in ((codes.CONCENTRATION, ("ct", "ca", "cb", "cc")), (codes.DEVELOPMENT, ("sa", "sb", "sc")), (codes.FLOE, ("fa", "fb", "fc"))) for c in cs)


_CLASSES = f"""{POLYGONS}, r AS (SELECT poly_id, kind, {_FIELDS} FROM pg), q AS (
    SELECT * REPLACE (CASE WHEN ct > 0 AND ca = -9 THEN ct ELSE ca END AS ca) FROM r
), d AS (
    SELECT poly_id, CASE WHEN lower(kind) = 'w' THEN 0 ELSE ct END AS sic, {_dominant("s")} AS sod,
        CASE WHEN 255 IN (fa, fb, fc) THEN 255 ELSE {_dominant("f")} END AS floe FROM q
), w AS (
    SELECT poly_id, sic, CASE WHEN sic = 0 THEN 0 WHEN sod = -9 THEN 255 ELSE sod END AS sod, CASE WHEN sic = 0 THEN 0 WHEN floe = -9 THEN 255 ELSE floe END AS floe FROM d
), classes AS (
    SELECT poly_id, CASE WHEN sic = 99 THEN 255 ELSE sic END::INTEGER AS sic, CASE WHEN sod = 99 THEN 255 ELSE sod END::INTEGER AS sod, CASE WHEN floe = 99 THEN 255 ELSE floe END::INTEGER AS floe FROM w
)"""


@query(f"WITH {_CLASSES} SELECT * FROM classes")
def polygon_classes(spark, sf_dir):
    tables = {"c": codes.CONCENTRATION, "s": codes.DEVELOPMENT, "f": codes.FLOE}
    re = polygons(spark, sf_dir)
    re = re.withColumns({c: codes.recoded(F.col(c), tables[c[0]]) for c in re.columns if c not in ("poly_id", "kind")})
    re = re.withColumn("ca", codes.partial_filled(F.col("ct"), F.col("ca")))
    three = {x: [x + y for y in "abc"] for x in "csf"}
    return codes.with_polygon_classes(re, "ct", three["c"], three["s"], three["f"], "kind").select("poly_id", "sic", "sod", "floe")


@query("SELECT p_partkey, CASE WHEN p_size % 12 <= 10 THEN concat(p_size % 12 * 10, '%') END AS sic, CASE p_size % 7 WHEN 0 THEN 'Open water' WHEN 1 THEN 'New Ice' WHEN 2 THEN 'Young ice' WHEN 3 THEN 'Thin FYI' WHEN 4 THEN 'Thick FYI' WHEN 5 THEN 'Old ice' END AS sod FROM part")
def class_names(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", codes.sic_name(size % 12).alias("sic"), codes.looked_up(size % 7, codes.DEVELOPMENT_NAMES, "string").alias("sod"))


_KEEP = "NOT isnan(x) AND x NOT IN (255, 2)"


@query(f"""WITH l AS (SELECT l_returnflag AS scene_id, unnest(['hh', 't2m']) AS variable, unnest([l_quantity, CASE WHEN l_linenumber = 6 THEN 'NaN'::DOUBLE ELSE l_extendedprice END]) AS x FROM lineitem)
SELECT scene_id, variable, count(*) AS n, {r6("avg(x)", "mean")}, {r6("stddev_pop(x)", "std")}, min(x) AS min, max(x) AS max FROM l WHERE {_KEEP} GROUP BY ALL""")
def scene_moments(spark, sf_dir):
    return rounded(moments.scene_moments(_variables(spark, sf_dir), masks.for_statistics), "mean", "std").drop("m2")


def _variables(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("scene_id"), F.col("l_quantity").alias("hh"), F.when(F.col("l_linenumber") == 6, F.lit(float("nan"))).otherwise(F.col("l_extendedprice")).alias("t2m"))
    return moments.unpivoted(wide, ["hh", "t2m"])


@query(f"""WITH l AS (SELECT unnest(['hh', 't2m']) AS variable, unnest([l_quantity, CASE WHEN l_linenumber = 6 THEN 'NaN'::DOUBLE ELSE l_extendedprice END]) AS x FROM lineitem)
SELECT variable, round(avg(x), 4) AS mean, round(stddev_pop(x), 4) AS std, count(*) AS n_pixels FROM l WHERE {_KEEP} GROUP BY ALL""")
def corpus_moments(spark, sf_dir):
    return moments.finished(moments.merged(moments.scene_moments(_variables(spark, sf_dir), masks.for_statistics)), 4)


_AUDIT = f"""WITH {PIXELS}, a AS (SELECT scene_id, count(*) FILTER (distance <> 0) AS n_not_land_pixels,
    count(*) FILTER (distance <> 0 AND NOT isnan(hh)) AS primary_valid_pixels, count(*) FILTER (distance <> 0 AND NOT isnan(hv)) AS secondary_valid_pixels,
    count(*) FILTER (valid) AS combined_valid_pixels, count(*) FILTER (distance <> 0 AND NOT isnan(hh) AND isnan(hv)) AS primary_only_pixels,
    count(*) FILTER (distance <> 0 AND isnan(hh) AND NOT isnan(hv)) AS secondary_only_pixels
    FROM (SELECT * REPLACE (scene_id || '_' || poly_id AS scene_id) FROM pv) GROUP BY scene_id HAVING n_not_land_pixels > 0)"""


def _audited(spark, sf_dir):
    return audit.scene_counts(valid_pixels(spark, sf_dir).withColumn("scene_id", F.concat_ws("_", "scene_id", "poly_id")))


@query(f"{_AUDIT} SELECT * FROM a")
def nodata_audit(spark, sf_dir):
    return _audited(spark, sf_dir)


@query(f"{_AUDIT} SELECT {', '.join(f'sum({c})::BIGINT AS {c}' for c in audit.COUNTS)}, {', '.join(r6(f'sum({x}_valid_pixels) / sum(n_not_land_pixels)::DOUBLE', f'{x}_fraction') for x in ('primary', 'secondary', 'combined'))} FROM a")
def nodata_shares(spark, sf_dir):
    return rounded(audit.corpus_shares(_audited(spark, sf_dir)), *(f"{x}_fraction" for x in ("primary", "secondary", "combined")))


@query(f"{_AUDIT} SELECT scene_id, {r6('(primary_only_pixels + secondary_only_pixels) / n_not_land_pixels::DOUBLE', 'mismatch_fraction')} FROM a ORDER BY (primary_only_pixels + secondary_only_pixels) / n_not_land_pixels::DOUBLE DESC, scene_id LIMIT 10")
def worst_scenes(spark, sf_dir):
    return rounded(audit.worst(_audited(spark, sf_dir)), "mismatch_fraction")


@query("SELECT o_orderpriority AS scene_id, count(*) AS n_amsr2_pixels, count(*) FILTER (o_custkey % 10 <> 0) AS amsr2_valid_pixels FROM orders GROUP BY 1")
def native_grid_audit(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("scene_id"), F.lit("btemp_6_9h").alias("band"), F.when(F.col("o_custkey") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("value"))
    return audit.native_counts(rows, ["btemp_6_9h"], "amsr2")


@query("SELECT 's' || o_custkey % 50 AS scene_id, count(*) FILTER (n > 3) AS above, count(*) FILTER (n < 3) AS below FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1")
def chip_sizes(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("s"), F.col("o_custkey") % 50).alias("scene_id"), F.col("o_custkey").alias("chip_id"))
    return validation.chip_sizes(rows, 3)


@query("SELECT o_custkey, count(*) AS copies FROM orders GROUP BY 1 HAVING copies > 1")
def duplicate_ids(spark, sf_dir):
    return validation.duplicates(table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left' ELSE 'right' END AS side FROM (SELECT DISTINCT c_custkey AS k FROM customer) a FULL JOIN (SELECT DISTINCT o_custkey + 20 AS k FROM orders) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL")
def one_sided_ids(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return validation.one_sided(left, table(spark, sf_dir, "orders").select((F.col("o_custkey") + 20).alias("k")), "k")


@query("SELECT label, count(*) FILTER (len(embedding) <> 64) AS wrong_length, count(*) FILTER (embedding[1] < -0.1 OR embedding[1] > 0.1) AS out_of_bounds FROM embeddings GROUP BY label")
def token_checks(spark, sf_dir):
    first = F.get("embedding", F.lit(0)).cast("double")
    rows = table(spark, sf_dir, "embeddings").groupBy("label")
    return rows.agg(F.count_if(F.size("embedding") != 64).alias("wrong_length"), F.count_if(validation.out_of_bounds(first, -0.1, 0.1)).alias("out_of_bounds"))


_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("WITH p AS (" + " UNION ALL ".join(f"SELECT l_returnflag AS scene_id, '{x}' AS x, '{y}' AS y, {r6(f'corr({x}, {y})', 'r')} FROM lineitem GROUP BY 1" for i, x in enumerate(_FEATURES) for y in _FEATURES[i:]) + ") SELECT * FROM p")
def correlations(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "scene_id")
    return rounded(explore.correlations(rows, list(_FEATURES), ["scene_id"]), "r")


@query("WITH p AS (SELECT l_suppkey % 20 AS s, corr(l_quantity, l_extendedprice) AS r FROM lineitem GROUP BY 1 HAVING count(*) >= 100) SELECT round(tanh(avg(atanh(greatest(-0.9999, least(0.9999, r))))), 6) AS r FROM p")
def fisher_mean(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("s", F.col("l_suppkey") % 20)
    each = explore.correlations(rows, ["l_quantity", "l_extendedprice"], ["s"], least=100).where("x <> y")
    return rounded(explore.fisher_mean(each, []), "r")


@query(f"SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, {r6('corr(l_extendedprice, l_quantity)', 'r')} FROM lineitem GROUP BY 1")
def angle_fit(spark, sf_dir):
    made = explore.line_fit(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity", ["l_returnflag"])
    return rounded(rounded(made, "slope", "intercept", digits=4), "r")


@query(f"SELECT c.k AS class, count(q) AS n, {r6('count(q) * 100.0 / (SELECT count(*) FROM lineitem WHERE l_quantity < 11)', 'percent')} FROM range(11) c(k) LEFT JOIN (SELECT floor(l_quantity) AS q FROM lineitem WHERE l_quantity < 11) ON q = c.k GROUP BY 1")
def class_shares(spark, sf_dir):
    return rounded(explore.class_shares(table(spark, sf_dir, "lineitem").where("l_quantity < 11"), "l_quantity"), "percent")


@query("SELECT CAST(least(floor((value - 0) / (100.0 / 20)) + 1, 20) AS BIGINT) AS bin, count(*) AS n FROM events WHERE value BETWEEN 0 AND 100 GROUP BY 1")
def value_histogram(spark, sf_dir):
    return explore.histogram(table(spark, sf_dir, "events"), "value", 0.0, 100.0, 20)


@query("SELECT event_type, round(quantile_cont(value, 0.02), 6) AS p2, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.98), 6) AS p98 FROM events GROUP BY 1")
def value_percentiles(spark, sf_dir):
    return rounded(explore.percentiles(table(spark, sf_dir, "events"), "value", [0.02, 0.5, 0.98], ["event_type"]), "p2", "p50", "p98")


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, round(quantile_cont(o_totalprice, 0.5), 6) AS p50 FROM orders GROUP BY 1")
def monthly_medians(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return rounded(explore.percentiles(rows, "o_totalprice", [0.5], ["month"]), "p50")


@query("SELECT v AS variable, count(*) AS n, round(avg(x), 3) AS mean, round(stddev_pop(x), 3) AS std, round(min(x), 3) AS min, round(max(x), 3) AS max FROM (SELECT unnest(['l_quantity', 'l_tax']) AS v, unnest([CASE WHEN l_quantity = 3 THEN 255 ELSE l_quantity END, l_tax]) AS x FROM lineitem) WHERE x <> 255 GROUP BY 1")
def variable_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.when(F.col("l_quantity") == 3, 255.0).otherwise(F.col("l_quantity")))
    return explore.summary(rows, ["l_quantity", "l_tax"], masks.for_summary)


@query(f'WITH {PIXELS} SELECT scene_id, CAST("row" // 10 AS BIGINT) AS "row", CAST(col // 20 AS BIGINT) AS col, {r6("avg(hh) FILTER (NOT isnan(hh))", "hh")} FROM px GROUP BY 1, 2, 3')
def block_means(spark, sf_dir):
    return rounded(explore.block_means(pixels(spark, sf_dir), "hh", 10, 20, ["scene_id"]), "hh")


@query(f'WITH {PIXELS} SELECT scene_id, "row", col, hv FROM px WHERE "row" % 4 = 0 AND col % 3 = 0 AND "row" < 160 AND col < 90 AND NOT isnan(hv)')
def stride_sample(spark, sf_dir):
    return tiling.decimated(pixels(spark, sf_dir), 4, 3, 40, 30).where(~F.isnan("hv")).select("scene_id", "row", "col", "hv")


@query("SELECT l_returnflag AS scene_id, min(l_tax * 10 + 60) AS min_lat, max(l_tax * 10 + 60) AS max_lat, min(-l_quantity) AS min_lon, max(-l_quantity) AS max_lon, round(avg(l_tax * 10 + 60), 6) AS mid_lat, round(avg(-l_quantity), 6) AS mid_lon FROM lineitem GROUP BY 1")
def scene_box(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("scene_id"), (F.col("l_tax") * 10 + 60).alias("lat"), (-F.col("l_quantity")).alias("lon"))
    return rounded(explore.bounding_box(points, ["scene_id"]), "mid_lat", "mid_lon")


@query(f"WITH {POLYGONS} SELECT DISTINCT chart, value::BIGINT AS value FROM (SELECT unnest(['ct', 'sa', 'fa']) AS chart, unnest([ct, sa, fa]) AS value FROM pg)")
def chart_values(spark, sf_dir):
    return explore.distinct_values(polygons(spark, sf_dir), ["ct", "sa", "fa"])


_TIME = "CAST(round(round({f}({x}), 4) + 0.0, 4) AS DOUBLE)"


@query("SELECT event_id, " + ", ".join(f"round({f}({x})::FLOAT::DOUBLE, 4) + 0.0 AS {f}_{n}" for x, n in (("week(ts) * 2 * pi() / 52", "week"), ("(hour(ts) + minute(ts) / 60.0::DOUBLE) * 2 * pi() / 24", "hour")) for f in ("sin", "cos")) + " FROM events")
def cyclic_time(spark, sf_dir):
    names = ["sin_week", "cos_week", "sin_hour", "cos_hour"]
    made = encodings.time_encoding(F.col("ts").cast("timestamp_ntz"))
    return rounded(table(spark, sf_dir, "events").select("event_id", *(c.alias(n) for c, n in zip(made, names))), *names, digits=4)


@query("SELECT c_custkey, " + ", ".join(f"round({f}(radians({x}))::FLOAT::DOUBLE, 4) + 0.0 AS {f}_{n}" for x, n in (("c_acctbal / 120", "lat"), ("c_custkey % 360 - 180", "lon")) for f in ("sin", "cos")) + " FROM customer")
def cyclic_place(spark, sf_dir):
    names = ["sin_lat", "cos_lat", "sin_lon", "cos_lon"]
    made = encodings.place_encoding(F.col("c_acctbal") / 120, (F.col("c_custkey") % 360 - 180).cast("double"))
    return rounded(table(spark, sf_dir, "customer").select("c_custkey", *(c.alias(n) for c, n in zip(made, names))), *names, digits=4)


@query("SELECT o_orderkey, CAST(date_trunc('second', o_orderdate) AS TIMESTAMP) AS ts, CASE WHEN year(o_orderdate) BETWEEN 1993 AND 1995 THEN strftime(o_orderdate, '%Y-%m') END AS month FROM orders")
def scene_times(spark, sf_dir):
    name = F.concat(F.lit("S1A_EW_GRDM_1SDH_"), F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss"), F.lit("_prep.nc"))
    return table(spark, sf_dir, "orders").select("o_orderkey", encodings.scene_time(name).cast("timestamp_ntz").alias("ts"), encodings.year_month(name, 1993, 1995).alias("month"))


@query("SELECT vec_id, round(list_sum([(x::DOUBLE - 0.01) / 0.125 FOR x IN embedding]), 4) AS total FROM embeddings")
def standardised_vectors(spark, sf_dir):
    made = encodings.standardised(F.col("embedding").cast("array<double>"), F.lit(0.01), F.lit(0.125))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.aggregate(made, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("SELECT event_id, round(greatest(0, least(1, (value - 10) / 80)), 6) AS scaled FROM events")
def clip_scaled(spark, sf_dir):
    return rounded(table(spark, sf_dir, "events").select("event_id", encodings.clip_scaled(F.col("value"), F.lit(10.0), F.lit(90.0)).alias("scaled")), "scaled")


@query("SELECT o_orderkey, round(o_totalprice / 1000 * cos(radians(o_custkey)) + 3 * sin(radians(o_custkey)), 6) + 0.0 AS along, round(3 * cos(radians(o_custkey)) - o_totalprice / 1000 * sin(radians(o_custkey)), 6) + 0.0 AS across FROM orders")
def rotated_wind(spark, sf_dir):
    along, across = encodings.rotated(F.col("o_totalprice") / 1000, F.lit(3.0), F.col("o_custkey").cast("double"))
    return rounded(table(spark, sf_dir, "orders").select("o_orderkey", along.alias("along"), across.alias("across")), "along", "across")


@query("SELECT p_partkey, CAST(CASE WHEN p_size - 1 <= 0 THEN 0 ELSE 1 + (p_size - 1 >= 5)::INT + (p_size - 1 >= 20)::INT + (p_size - 1 >= 40)::INT END AS INTEGER) AS bin, CAST(floor((p_size * 7 - 180 + 180) / 6) + 1 AS INTEGER) AS zone FROM part")
def distance_bins(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", encodings.distance_bin(size - 1, [5, 20, 40]).cast("int").alias("bin"), encodings.utm_zone(size * 7 - 180).alias("zone"))


@query("SELECT c_custkey, " + ", ".join(f"round({v}, 6) AS {n}" for n, v in (("lat", "60 + y / 100.0 + x * x * 0"), ("angle", "30 + 2 * y / 100.0 + x / 100.0"))) + " FROM (SELECT c_custkey, c_custkey % 130 AS y, c_custkey * 3 % 120 AS x FROM customer)")
def bilinear_geolocation(spark, sf_dir):
    rows = [("s", 100.0 * i, 100.0 * j, 60.0 + i, -80.0 + j, 30.0 + 2 * i + j) for i in range(2) for j in range(2)]
    grid = geo.control_grids(spark.createDataFrame(rows, "scene_id string, line double, sample double, lat double, lon double, angle double"))
    at = table(spark, sf_dir, "customer").select("c_custkey", F.lit("s").alias("scene_id"), (F.col("c_custkey") % 130).alias("y"), (F.col("c_custkey") * 3 % 120).alias("x"))
    made = at.join(grid, "scene_id")
    pick = lambda name: geo.bilinear(F.col("lines"), F.col("samples"), F.col(name), F.col("y"), F.col("x"))
    return rounded(made.select("c_custkey", pick("lat").alias("lat"), pick("angle").alias("angle")), "lat", "angle")


#: A coarse 4 x 4 grid for each sixteen parts, with a gap where p_partkey % 11 = 5.
_GRID = """g AS (SELECT 's' || p_partkey // 16 AS scene_id, p_partkey % 16 // 4 AS r, p_partkey % 4 AS c,
    CASE WHEN p_partkey % 11 = 5 THEN NULL ELSE p_retailprice END AS v FROM part)"""


def _coarse(spark, sf_dir, gap) -> tuple[DataFrame, DataFrame]:
    """(targets, coarse): a fine grid of 10 x 10 for each scene, and the scenes' coarse cells."""
    k = F.col("p_partkey")
    cells = table(spark, sf_dir, "part").select(
        F.concat(F.lit("s"), F.floor(k / 16)).alias("scene_id"),
        F.floor(k % 16 / 4).alias("row"),
        (k % 4).alias("col"),
        F.lit(4).alias("h"),
        F.lit(4).alias("w"),
        F.when(k % 11 == 5, gap).otherwise(F.col("p_retailprice")).alias("value"),
    )
    side = F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))
    scenes = resampling.spread(cells.select("scene_id"), "scene_id").distinct()
    return scenes.withColumn("row", F.explode(side)).withColumn("col", F.explode(side)), cells


@query(f"""WITH {_GRID}, w AS (SELECT scene_id, y.i AS "row", x.i AS col, sum(v * wy * wx) FILTER (v IS NOT NULL) AS s, sum(wy * wx) FILTER (v IS NOT NULL) AS n
    FROM g, range(10) y(i), range(10) x(i), LATERAL (SELECT greatest(0, 1 - abs(y.i * 3 / 9.0::DOUBLE - r)) AS wy, greatest(0, 1 - abs(x.i * 3 / 9.0::DOUBLE - c)) AS wx)
    GROUP BY 1, 2, 3)
SELECT scene_id, "row", col, CASE WHEN n > 1e-6 THEN round(s / n, 6) END AS value FROM w""")
def gap_safe_resampling(spark, sf_dir):
    made = resampling.bilinear(*_coarse(spark, sf_dir, F.lit(float("nan"))), 10, 10)
    return rounded(made.withColumn("value", masks.null_if_nan(F.col("value"))), "value")


@query(f"""WITH {_GRID}, s AS (SELECT DISTINCT scene_id FROM g)
SELECT s.scene_id, y.i AS "row", x.i AS col, v AS value FROM s, range(10) y(i), range(10) x(i) LEFT JOIN g ON g.scene_id = s.scene_id AND r = y.i * 4 // 10 AND c = x.i * 4 // 10""")
def nearest_resampling(spark, sf_dir):
    return resampling.nearest(*_coarse(spark, sf_dir, F.lit(None)), 10, 10)


@query(f"""WITH {_GRID}, s AS (SELECT DISTINCT scene_id FROM g)
SELECT s.scene_id, y.i AS "row", x.i AS col, v AS value FROM s, range(10) y(i), range(10) x(i)
LEFT JOIN g ON g.scene_id = s.scene_id AND r = floor(y.i * 3 / 9.0::DOUBLE + 0.5) AND c = floor(x.i * 3 / 9.0::DOUBLE + 0.5)""")
def corner_nearest_resampling(spark, sf_dir):
    return resampling.corner_nearest(*_coarse(spark, sf_dir, F.lit(None)), 10, 10)


_SIDES = "a AS (SELECT event_id, user_id, ts FROM events WHERE event_id % 2 = 0), b AS (SELECT event_id AS other, user_id, ts AS other_ts FROM events WHERE event_id % 2 = 1)"


def _sides(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.where("event_id % 2 = 0").select("event_id", "user_id", "ts"), e.where("event_id % 2 = 1").select(F.col("event_id").alias("other"), "user_id", F.col("ts").alias("other_ts"))


@query(f"WITH {_SIDES} SELECT event_id, other, abs(epoch_us(ts) - epoch_us(other_ts)) / 1000000.0::DOUBLE AS gap_s FROM a JOIN b USING (user_id) WHERE abs(epoch_us(ts) - epoch_us(other_ts)) <= 25200000000")
def within_hours(spark, sf_dir):
    return matching.within(*_sides(spark, sf_dir), "user_id", "ts", "other_ts", 7 * 3600).select("event_id", "other", "gap_s")


@query(f"WITH {_SIDES}, p AS (SELECT event_id, other, abs(epoch_us(ts) - epoch_us(other_ts)) / 1000000.0::DOUBLE AS gap_s FROM a JOIN b USING (user_id)), r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY gap_s, other) AS k FROM p WHERE gap_s <= 25200) SELECT event_id, gap_s, other FROM r WHERE k = 1")
def nearest_in_time(spark, sf_dir):
    return matching.nearest(*_sides(spark, sf_dir), "user_id", "event_id", "ts", "other_ts", 7 * 3600, ["other"])


@query(f'WITH {PIXELS}, {CHIPS}, d AS (SELECT scene_id, "row", col, chip_id, least(patch_i, patch_j, 31 - patch_i, 31 - patch_j) AS depth FROM chips) SELECT scene_id, "row", col, max_by(chip_id, (depth, chip_id)) AS owner FROM d GROUP BY 1, 2, 3')
def overlap_owner(spark, sf_dir):
    places = pixels(spark, sf_dir).select("scene_id", "row", "col").distinct()
    owner = tiling.owner(F.col("row"), F.col("col"), F.lit(SIDE), F.lit(SIDE))
    made = places.withColumn("o", owner)
    return made.select("scene_id", "row", "col", tiling.chip_id(F.col("scene_id"), F.col("o.row0"), F.col("o.col0")).alias("owner"))


@query(f"""WITH {PIXELS}, {CHIPS}, d AS (
    SELECT scene_id, "row", col, chip_id, sum(hh) FILTER (valid) AS v, least(patch_i, patch_j, 31 - patch_i, 31 - patch_j) AS depth FROM chips GROUP BY ALL
) SELECT scene_id, "row", col, round(max_by(coalesce(v, 0), (depth, chip_id)), 4) AS value FROM d GROUP BY 1, 2, 3""")
def overlap_predictions(spark, sf_dir):
    """Values that come as rows a chip, as predictions do: that of the most interior one."""
    each = chipped(valid_pixels(spark, sf_dir))
    each = each.groupBy("scene_id", "row", "col", "row0", "col0", "patch_i", "patch_j")
    each = each.agg(F.coalesce(F.sum(F.when(F.col("valid"), F.col("hh"))), F.lit(0.0)).alias("value"))
    each = each.withColumn("chip_id", tiling.chip_id(F.col("scene_id"), F.col("row0"), F.col("col0")))
    made = matching.most_interior(each, ["scene_id", "row", "col"], "value")
    return made.withColumn("value", F.round("value", 4) + 0.0)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def not_done(spark, sf_dir):
    done = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return matching.not_done(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), done, "c_custkey")


@query("SELECT c_custkey AS scene, 'train' AS split FROM customer UNION ALL SELECT s_suppkey, 'test' FROM supplier")
def split_union(spark, sf_dir):
    train = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("scene"), F.lit("train").alias("split"))
    return train.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("scene"), F.lit("test").alias("split")))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def id_union(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY 1")
def keys_by_month(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return rows.agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 25")
def first_scenes(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"))
    return scenes.first(keys, 25).withColumnRenamed("path", "o_orderkey")


_PAIRS = "p AS (SELECT n_chars % 9 AS truth, (n_chars + (doc_id % 4 = 0)::INT) % 9 AS predicted, lang FROM documents)"


def _scored(spark, sf_dir):
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select((n % 9).alias("truth"), ((n + (F.col("doc_id") % 4 == 0).cast("int")) % 9).alias("predicted"), "lang")


@query(f"WITH {_PAIRS} SELECT lang, round(1 - sum((truth - predicted) * (truth - predicted)) / (var_pop(truth) * count(*)), 6) AS r2 FROM p GROUP BY lang")
def r_squared(spark, sf_dir):
    return rounded(scores.r_squared(_scored(spark, sf_dir), ["lang"]), "r2")


@query(f"WITH {_PAIRS}, t AS (SELECT truth AS c, count(*) AS support, count(*) FILTER (truth = predicted) AS hits FROM p GROUP BY 1), s AS (SELECT predicted AS c, count(*) AS said FROM p GROUP BY 1) SELECT round(sum(2.0::DOUBLE * hits / (support + coalesce(said, 0)) * support) / sum(support), 6) AS f1 FROM t LEFT JOIN s USING (c)")
def weighted_f1(spark, sf_dir):
    return rounded(scores.weighted_f1(_scored(spark, sf_dir)), "f1")


@query(f"WITH {_PAIRS} SELECT lang, round(avg(abs(truth - predicted)), 6) AS penalty FROM p GROUP BY lang")
def ordinal_penalty(spark, sf_dir):
    return rounded(scores.ordinal_penalty(_scored(spark, sf_dir), ["lang"]), "penalty")


@query("SELECT a.vec_id, 128 AS width, round(list_sum(a.embedding)::DOUBLE + list_sum(b.embedding)::DOUBLE, 2) AS total FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id // 10".replace("round(list_sum(a.embedding)::DOUBLE + list_sum(b.embedding)::DOUBLE, 2)", "round(list_sum([x::DOUBLE FOR x IN a.embedding]) + list_sum([x::DOUBLE FOR x IN b.embedding]), 4)"))
def patch_with_chip_token(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    patch = e.select("vec_id", F.floor(F.col("vec_id") / 10).alias("chip_id"), F.col("embedding").alias("patch_token"))
    made = matching.with_chip_token(patch, e.select(F.col("vec_id").alias("chip_id"), F.col("embedding").alias("class_token")), [])
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return made.select("vec_id", F.size("vector").alias("width"), F.round(total, 4).alias("total"))


@query("WITH c AS (SELECT o_custkey % 40 AS chip, o_orderkey % 11 AS k FROM orders) SELECT chip, CAST(round_even(avg(k), 0) AS DOUBLE) AS label FROM c GROUP BY 1")
def chip_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 40).alias("chip"), *((F.col("o_orderkey") % 11 == k).cast("float").alias(f) for k, f in enumerate(FRACTIONS)))
    return explore.chip_labels(rows, FRACTIONS, ["chip"])


@query("""SELECT o_orderkey, month FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders)
QUALIFY row_number() OVER (PARTITION BY month ORDER BY md5(o_orderkey || ':7'), o_orderkey) <= 3""")
def monthly_sample(spark, sf_dir):
    """Three orders a month, the same ones each time."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return sampling.rows_by(rows, "month", "o_orderkey", 3, seed=7)


@query("SELECT c_custkey FROM customer ORDER BY md5(c_custkey || ':3'), c_custkey LIMIT 20")
def scene_sample(spark, sf_dir):
    """Twenty customers, the same ones each time: the sampling operator's own limit."""
    return sampling.rows(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 20, seed=3)


_CROP = "CAST(('0x' || substr(md5(c_custkey || ':' || crop || ':5'), {at}, 8)) AS BIGINT) % ({side} - 255)"


@query(f"""SELECT c_custkey AS scene_id, CAST(crop AS INTEGER) AS crop, {_CROP.format(at=1, side="height")} AS row0, {_CROP.format(at=9, side="300")} AS col0
FROM (SELECT c_custkey, 200 + c_custkey % 400 AS height FROM customer), range(4) r(crop) WHERE height >= 256""")
def random_crops(spark, sf_dir):
    key = F.col("c_custkey")
    scenes = table(spark, sf_dir, "customer").select(key.alias("scene_id"), (200 + key % 400).alias("height"), F.lit(300).alias("width"))
    return sampling.crops(scenes, 256, 4, seed=5).select("scene_id", "crop", "row0", "col0")


@query("SELECT l_orderkey AS crop, count(*) FILTER (l_linenumber <> 3) AS charted FROM lineitem GROUP BY 1 HAVING charted > 1")
def usable_crops(spark, sf_dir):
    chart = F.when(F.col("l_linenumber") == 3, 255).otherwise(F.col("l_linenumber")).alias("sic")
    return sampling.usable(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("crop"), chart), ["crop"])


@query(f"""WITH {CHIPPED}, c AS (SELECT scene_id, chip_id, patch_i, patch_j, count(ct) AS n, {_COUNTS}, count(*) FILTER (valid) / 64.0::DOUBLE AS valid_fraction,
    round(avg(hh) FILTER (valid), 6) + 0.0 AS hh_mean, round(avg(distance), 6) AS distance FROM chips GROUP BY ALL
), f AS (SELECT *, {_SHARES} FROM c)
SELECT scene_id, chip_id, patch_i, patch_j, valid_fraction, hh_mean, distance,
    CASE WHEN n > 0 THEN floor({" + ".join(f"{k} * frac_sic{k}::DOUBLE" for k in range(11))}) ELSE -1 END AS label FROM f""")
def patch_features(spark, sf_dir):
    """Labels, radar and plain means of every patch from one aggregation."""
    made = patches.features(chipped(charted(spark, sf_dir)), ["distance"])
    made = made.withColumn("hh_mean", masks.null_if_nan(F.col("hh_mean")))
    made = made.withColumn("label", F.when(F.isnan("label"), -1.0).otherwise(F.col("label")))
    return rounded(made, "hh_mean", "distance").select(*patches.KEY, "valid_fraction", "hh_mean", "distance", "label")


@query(SQL["patch_features"])
def patch_array_features(spark, sf_dir):
    """The same from arrays of each patch's pixels."""
    px = chipped(charted(spark, sf_dir))
    held = px.groupBy(*patches.PLACES).agg(*(F.collect_list(F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))).alias(c) for c in ("hh", "hv", "distance", "ct")))
    copies = held.withColumn("means_of", F.col("distance"))
    made = array_features.with_features(copies, {"means_of": "mean"}, drop=("distance", "ct", "means_of"))
    made = made.withColumns({
        "chip_id": tiling.chip_id(F.col("scene_id"), F.col("row0"), F.col("col0")),
        "hh_mean": masks.null_if_nan(F.col("hh_mean")),
        "label": F.when(F.isnan("label"), -1.0).otherwise(F.col("label")),
    })
    return rounded(made.withColumnRenamed("mean", "distance"), "hh_mean", "distance").select(*patches.KEY, "valid_fraction", "hh_mean", "distance", "label")


@query("SELECT l_returnflag, f AS feature, round(corr(x, l_quantity), 6) + 0.0 AS r FROM (SELECT l_returnflag, l_quantity, unnest(['l_extendedprice', 'l_discount', 'l_tax']) AS f, unnest([l_extendedprice, l_discount, l_tax]) AS x FROM lineitem) GROUP BY 1, 2")
def feature_correlations(spark, sf_dir):
    made = explore.correlations_with(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_discount", "l_tax"], "l_quantity", ["l_returnflag"])
    return rounded(made, "r")


#: Latitude and longitude at row r and column c of each customer's scene, linear, so that any control grid gives them.
_AT = "60 + k % 7 - {r} / 100.0::DOUBLE + {c} / 1000.0::DOUBLE", "-90 + k % 11 + {c} / 50.0::DOUBLE"


def _control_points(spark, sf_dir) -> DataFrame:
    k, line, sample = F.col("c_custkey"), F.col("line"), F.col("sample")
    steps = F.array(*map(F.lit, (0.0, 200.0, 500.0)))
    each = table(spark, sf_dir, "customer").select(k).withColumn("line", F.explode(steps)).withColumn("sample", F.explode(steps))
    lat, lon = 60 + k % 7 - line / 100 + sample / 1000, -90 + k % 11 + sample / 50
    return each.select(k.alias("scene_id"), "line", "sample", lat.alias("lat"), lon.alias("lon"), (30 + line / 10).alias("angle"))


_CORNERS = "(VALUES (0), (44)) r(row0), (VALUES (0), (44)) c(col0)"


def _scene_chips(spark, sf_dir) -> DataFrame:
    scenes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("scene_id"), F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"))
    return tiling.chips(scenes).select("scene_id", "row0", "col0")


@query(f"""WITH p AS (SELECT c_custkey AS scene_id, row0, col0, {_AT[0].format(r="(row0 + 128)", c="(col0 + 128)").replace("k %", "c_custkey %")} AS lat,
    {_AT[1].format(c="(col0 + 128)").replace("k %", "c_custkey %")} AS lon FROM customer, {_CORNERS})
SELECT scene_id, row0, col0, round(lat, 6) AS centroid_lat, round(lon, 6) AS centroid_lon, {", ".join(f"round({f}(radians({x}))::FLOAT::DOUBLE, 4) + 0.0 AS {f}_{x}" for x in ("lat", "lon") for f in ("sin", "cos"))} FROM p""")
def chip_centroids(spark, sf_dir):
    grids = geo.control_grids(_control_points(spark, sf_dir))
    made = geo.chip_places(_scene_chips(spark, sf_dir), grids)
    made = rounded(made, "centroid_lat", "centroid_lon")
    return rounded(made, "sin_lat", "cos_lat", "sin_lon", "cos_lon", digits=4)


def _conic_sql(lat: str, lon: str) -> tuple[str, str]:
    """EPSG:3978 by the textbook formulas, on SQL's own functions."""
    f = 1 / 298.257222101
    e = f"sqrt({2 * f - f * f!r}::DOUBLE)"
    m = lambda d: f"(cos(radians({d})) / sqrt(1 - pow({e} * sin(radians({d})), 2)))"
    t = lambda d: f"(tan(pi() / 4 - radians({d}) / 2) / pow((1 - {e} * sin(radians({d}))) / (1 + {e} * sin(radians({d}))), {e} / 2))"
    n = f"((ln({m('49.0')}) - ln({m('77.0')})) / (ln({t('49.0')}) - ln({t('77.0')})))"
    scale = f"(6378137.0 * {m('49.0')} / ({n} * pow({t('49.0')}, {n})))"
    rho, theta = f"({scale} * pow({t(lat)}, {n}))", f"({n} * radians({lon} + 95))"
    return f"{rho} * sin({theta})", f"{scale} * pow({t('49.0')}, {n}) - {rho} * cos({theta})"


_RING = [(0, 0), (0, 256), (256, 256), (256, 0)]
_SIDES_AT = ", ".join(f"{_AT[0].format(r=f'(row0 + {r})', c=f'(col0 + {c})').replace('k %', 'c_custkey %')} AS lat{i}, {_AT[1].format(c=f'(col0 + {c})').replace('k %', 'c_custkey %')} AS lon{i}" for i, (r, c) in enumerate(_RING))


@query(f"""WITH p AS (SELECT c_custkey AS scene_id, row0, col0, {_SIDES_AT} FROM customer, {_CORNERS})
SELECT scene_id, row0, col0, {", ".join(f"round({v}, 2) AS {n}{i}" for i in range(4) for n, v in zip("xy", _conic_sql(f"lat{i}", f"lon{i}")))} FROM p""")
def scene_footprints(spark, sf_dir):
    """The projected corners of every chip."""
    grids = geo.control_grids(_control_points(spark, sf_dir))
    held = grids.select("scene_id", F.struct("lines", "samples", "lat", "lon", "angle").alias("grid"))
    chips = _scene_chips(spark, sf_dir).join(held, "scene_id")
    ring = geo.square(F.col("grid"), F.col("row0"), F.col("col0"), 256)
    named = {f"{n}{i}": F.round(v, 2) for i, point in enumerate(ring) for n, v in zip("xy", point)}
    return chips.withColumns(named).drop("grid")


@query(f"""WITH {_CLASSES}, px AS (
    SELECT l_returnflag AS scene_id, CASE WHEN l_linenumber <> 7 THEN l_partkey + l_suppkey END AS poly_id FROM lineitem
), c AS (
    SELECT scene_id, p.poly_id AS n, c.poly_id IS NOT NULL AS coded, c.sic, c.sod, c.floe FROM px p LEFT JOIN classes c ON c.poly_id = p.poly_id
), v AS (
    SELECT scene_id, {", ".join(f"CASE WHEN coded THEN {x} WHEN n = 99 THEN 255 ELSE n END::INTEGER AS {x}" for x in ("sic", "sod", "floe"))} FROM c
) SELECT scene_id, sic, sod, floe, count(*) AS n FROM v GROUP BY ALL""")
def pixel_charts(spark, sf_dir):
    """Charts of pixels by polygon; some polygons have no row, some pixels no polygon."""
    number = F.when(F.col("l_linenumber") != 7, F.col("l_partkey") + F.col("l_suppkey"))
    px = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("scene_id"), number.alias("poly_id"))
    made = matching.pixel_charts(px, polygon_classes(spark, sf_dir))
    return made.groupBy("scene_id", "sic", "sod", "floe").agg(F.count("*").alias("n"))


_RAW_NAME = "'S1_' || o_custkey || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey"


@query(f"SELECT c_custkey::VARCHAR AS scene, file FROM customer LEFT JOIN (SELECT o_custkey, min({_RAW_NAME}) AS file FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def first_file_by_name(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    files = table(spark, sf_dir, "orders").select(F.concat_ws("_", F.lit("S1"), "o_custkey", day, "o_orderkey").alias("file"))
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("scene"))
    return matching.first_by_name(known, files, F.regexp_extract("file", r"^S1_(\d+)_", 1), "scene", "file")


@query("SELECT p_brand AS scene_id, count(*) FILTER (p_size % 10 <> 0 AND abs(p_size / 20000.0::DOUBLE) > 0.00101) AS rows_off FROM part GROUP BY 1")
def share_sums(spark, sf_dir):
    """Labelled rows whose shares don't add up to one: those of larger parts are up to a 400th off."""
    size = F.col("p_size")
    share = {f: F.lit(1 / 11) + (size / 20000.0 if k == 0 else 0.0) for k, f in enumerate(FRACTIONS)}
    rows = table(spark, sf_dir, "part").withColumns(share).withColumn("label", F.when(size % 10 != 0, 1.0))
    return rows.groupBy(F.col("p_brand").alias("scene_id")).agg(F.count_if(validation.fractions_off()).alias("rows_off"))


@query(f"""WITH p AS (
    SELECT o_orderpriority AS scene_id, o_custkey AS chip_id, o_orderkey % 7 / 5.0::DOUBLE AS valid_fraction, o_orderkey % 11 / 10.0::DOUBLE - 0.1 AS valid_class_fraction, o_orderkey % 13 AS n FROM orders
), c AS (SELECT c_mktsegment AS scene_id, c_nationkey AS chip_id, c_custkey % 5 AS n FROM customer), s AS (SELECT scene_id, chip_id, count(*) AS n FROM p GROUP BY 1, 2), v AS (
    SELECT scene_id, 'valid_fraction' AS "check", count(*) FILTER (valid_fraction > 1) AS "rows" FROM p GROUP BY 1
    UNION ALL SELECT scene_id, 'valid_class_fraction', count(*) FILTER (valid_class_fraction < 0) FROM p GROUP BY 1
    UNION ALL SELECT scene_id, 'patch_token', count(*) FILTER (n = 0) FROM p GROUP BY 1
    UNION ALL SELECT scene_id, 'class_token', count(*) FILTER (n = 0) FROM c GROUP BY 1
    UNION ALL SELECT scene_id, 'repeated_chip', count(*) - count(DISTINCT chip_id) FROM c GROUP BY 1
    UNION ALL SELECT scene_id, 'below', count(*) FILTER (n < {GRID * GRID}) FROM s GROUP BY 1
) SELECT * FROM v WHERE "rows" > 0""")
def table_violations(spark, sf_dir):
    """Every check of both output tables, on tables that fail most of them."""
    token = lambda key, n: F.array_repeat(F.lit(0.0), F.when(F.col(key) % n == 0, TOKEN - 1).otherwise(TOKEN))
    share = lambda n, by, less: F.col("o_orderkey") % n / by - less
    made = {"valid_fraction": share(7, 5.0, 0.0), "valid_class_fraction": share(11, 10.0, 0.1), "patch_token": token("o_orderkey", 13)}
    p = table(spark, sf_dir, "orders").withColumns(made | {"label": F.lit(None).cast("double")} | {f: F.lit(0.0) for f in FRACTIONS})
    p = p.withColumns({"scene_id": F.col("o_orderpriority"), "chip_id": F.col("o_custkey")})
    c = table(spark, sf_dir, "customer").withColumn("class_token", token("c_custkey", 5))
    c = c.withColumns({"scene_id": F.col("c_mktsegment"), "chip_id": F.col("c_nationkey")})
    return validation.violations(p, c)


@query("""WITH s AS (SELECT lang, avg((n_chars % 3 = 0)::INT) AS sic, avg((n_chars % 5 = 0)::INT) AS sod, avg((n_chars % 7 = 0)::INT) AS floe FROM documents GROUP BY 1)
SELECT lang, round((2 * round(100 * sic, 3) + 2 * round(100 * sod, 3) + round(100 * floe, 3)) / 5, 3) AS score FROM s""")
def combined_score(spark, sf_dir):
    hit = lambda n: F.avg((F.col("n_chars") % n == 0).cast("int"))
    each = table(spark, sf_dir, "documents").groupBy("lang").agg(hit(3).alias("sic"), hit(5).alias("sod"), hit(7).alias("floe"))
    return each.select("lang", scores.combined_score({k: F.col(k) for k in scores.WEIGHTS}).alias("score"))


@query(f"SELECT vec_id, ((i - 1) // {GRID})::INTEGER AS patch_i, ((i - 1) % {GRID})::INTEGER AS patch_j, embedding[i]::DOUBLE AS patch_token FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def chip_tokens(spark, sf_dir):
    """A chip's token list, one row a patch."""
    made = patches.patches_of(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    return made.select("vec_id", "patch_i", "patch_j", F.col("patch_token").cast("double").alias("patch_token"))


@query(f"WITH {PIXELS}, v AS (SELECT scene_id, CASE WHEN isnan(t2m) THEN 255 ELSE floor(t2m)::INTEGER END AS stamped FROM px) SELECT scene_id, stamped, stamped = 255 AS masked, count(*) AS n FROM v GROUP BY ALL")
def stamped_charts(spark, sf_dir):
    """Chart values as bytes, and which of them scores leave out."""
    value = F.when(~F.isnan("t2m"), F.floor("t2m")).cast("int")
    px = pixels(spark, sf_dir).select("scene_id", masks.stamped(value).alias("stamped"))
    return px.groupBy("scene_id", "stamped", masks.chart_masked(F.col("stamped")).alias("masked")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%dT%H%M%S') || '_' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') || '_prep.nc' AS name FROM orders")
def prepared_names(spark, sf_dir):
    begun = F.concat(F.lit("S1A_EW_GRDM_1SDH_"), F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss"))
    raw = F.concat(F.rpad(begun, 77, "x"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), F.lit(".nc"))
    return table(spark, sf_dir, "orders").select("o_orderkey", encodings.prepared_name(raw).alias("name"))


@query("SELECT variable, round(mean, 6) + 0.0 AS mean FROM (SELECT 'l_quantity' AS variable, avg(l_quantity) AS mean FROM lineitem UNION ALL SELECT 'l_tax', avg(l_tax) FROM lineitem)")
def band_means(spark, sf_dir):
    """Means of the bands asked for; one of them has no statistics."""
    parts = moments.scene_moments(moments.unpivoted(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_returnflag"), key="l_returnflag")
    return tables.band_means(moments.finished(moments.merged(parts)), ["l_quantity", "l_tax", "none"])


@query(f"""WITH {_SIDES}, p AS (SELECT event_id, other, abs(epoch_us(ts) - epoch_us(other_ts)) / 1000000.0::DOUBLE AS gap_s FROM a JOIN b USING (user_id))
SELECT p.event_id, other, gap_s, gap_s <= CASE WHEN value >= 10 THEN 1800.0 ELSE 14400.0 END AS near_enough FROM p JOIN events e ON e.event_id = p.event_id WHERE gap_s <= 25200""")
def dynamic_pairs(spark, sf_dir):
    """Pairs near in time, with how far apart they are and whether that is near enough for the wind."""
    a, b = _sides(spark, sf_dir)
    pairs = matching.within(a.join(table(spark, sf_dir, "events").select("event_id", "value"), "event_id"), b, "user_id", "ts", "other_ts", 7 * 3600)
    near = inference.dynamic(F.col("value"), F.col("gap_s"), still_hours=4.0, moving_hours=0.5)
    return pairs.select("event_id", "other", "gap_s", near.alias("near_enough"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 200000 AND o_orderpriority = '1-URGENT'")
def readable_patches(spark, sf_dir):
    """Pure rows of one split that are valid enough."""
    price = F.col("o_totalprice").alias("valid_fraction")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("split"), price, (F.col("o_orderpriority") == "1-URGENT").alias("is_pure"))
    return inference.readable(rows, "F", 200000.0, pure_only=True).select("o_orderkey")


@query("SELECT 'scene-' || c_custkey || '.nc' AS path FROM customer WHERE c_custkey NOT IN (SELECT o_custkey + 3 FROM orders)")
def absent_files(spark, sf_dir):
    named = lambda name, key: table(spark, sf_dir, name).select(F.concat(F.lit("scene-"), key, F.lit(".nc")).alias("path"))
    return tables.absent(named("customer", F.col("c_custkey")), named("orders", F.col("o_custkey") + 3))


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, -l_quantity / 2 AS hh, -20 - l_discount * 50 AS hv FROM lineitem)
SELECT l_orderkey, l_linenumber, """ + ", ".join(f"round(greatest(0.0, least(1.0, ({x} - ({low})) / {high - low})), 6) + 0.0 AS {n}" for n, x, low, high in (("hh", "hh", -25.0, 0.0), ("hv", "hv", -24.0, -20.0), ("hh_hv", "(hh - hv)", 0.0, 20.0))) + " FROM b")
def radar_composite(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumns({"hh": -F.col("l_quantity") / 2, "hv": -20 - F.col("l_discount") * 50})
    made = encodings.composite(F.col("hh"), F.col("hv"), {"hh": (-25.0, 0.0), "hv": (-24.0, -20.0), "hh_hv": (0.0, 20.0)})
    return rounded(rows.withColumns(made), *made).select("l_orderkey", "l_linenumber", *made)


@query("SELECT p_partkey, CASE p_size % 8 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in codes.FLOE_NAMES.items()) + " END AS floe FROM part")
def floe_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", codes.looked_up(F.col("p_size") % 8, codes.FLOE_NAMES, "string").alias("floe"))


def _raster_scenes(px: DataFrame) -> DataFrame:
    return px.select("scene_id").distinct().withColumns({"height": F.lit(SIDE), "width": F.lit(SIDE)})


@query(f"""WITH {PIXELS}, land AS (SELECT DISTINCT scene_id, "row" AS r, col AS c FROM pv WHERE distance = 0),
cells AS (SELECT scene_id, r."row", c.col FROM (SELECT DISTINCT scene_id FROM pv), range(300) r("row"), range(300) c(col))
SELECT scene_id, CAST("row" AS INTEGER) AS "row", CAST(col AS INTEGER) AS col, least_square AS squared,
    CASE WHEN least_square = 0 THEN 0 ELSE 1 + (least_square >= 1)::INT + (least_square >= 25)::INT + (least_square >= 400)::INT END AS bin
FROM (SELECT k.scene_id, k."row", k.col, min((k."row" - l.r) * (k."row" - l.r) + (k.col - l.c) * (k.col - l.c)) AS least_square
    FROM cells k JOIN land l ON k.scene_id = l.scene_id GROUP BY ALL)""")
def land_distance(spark, sf_dir):
    """Squared distance to land of every place of every scene, and its bin: kilometres are pixels here."""
    px = valid_pixels(spark, sf_dir)
    rows = distance.raster_rows(px.where("distance = 0"), _raster_scenes(px))
    made = distance.pixels(distance.to_land(rows, 64)).where("squared IS NOT NULL")
    return made.withColumn("bin", encodings.distance_bin(F.sqrt("squared"), [1, 5, 20]))


CROP, CROPS_A_SCENE = 24, 40
_DRAWS = f"""{CHARTED}, few AS (SELECT scene_id, "row" AS r, col AS c FROM ch WHERE ct = 8), draws AS (
    SELECT scene_id, crop, attempt, ('0x' || substr(m, 1, 8))::BIGINT % (300 - {CROP} + 1) AS row0, ('0x' || substr(m, 9, 8))::BIGINT % (300 - {CROP} + 1) AS col0
    FROM (SELECT scene_id, crop, attempt, md5(scene_id || ':' || crop || ':' || attempt || ':11') AS m
        FROM (SELECT DISTINCT scene_id FROM ch), range({CROPS_A_SCENE}) c(crop), range(63) a(attempt))
), tried AS (
    SELECT d.scene_id, d.crop, d.attempt, d.row0, d.col0 FROM draws d JOIN few f ON f.scene_id = d.scene_id
        AND f.r >= d.row0 AND f.r < d.row0 + {CROP} AND f.c >= d.col0 AND f.c < d.col0 + {CROP} GROUP BY ALL HAVING count(*) > 1
), taken AS (SELECT * FROM tried QUALIFY row_number() OVER (PARTITION BY scene_id, crop ORDER BY attempt) = 1)"""


def _charted_crops(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    px = charted(spark, sf_dir)
    return px, sampling.accepted_crops(_raster_scenes(px), px.where("ct = 8"), CROP, CROPS_A_SCENE, seed=11)


@query(f"WITH {_DRAWS} SELECT scene_id, CAST(crop AS INTEGER) AS crop, CAST(attempt AS INTEGER) AS attempt, row0, col0 FROM taken")
def charted_crops(spark, sf_dir):
    """Crops drawn again until they hold more than one pixel of a chart class that is rare."""
    return _charted_crops(spark, sf_dir)[1]


@query(f"""WITH {_DRAWS} SELECT t.scene_id, CAST(t.crop AS INTEGER) AS crop, h."row" - t.row0 AS i, h.col - t.col0 AS j, h.hh, h.hv, h.valid, h.ct
FROM taken t JOIN ch h ON h.scene_id = t.scene_id AND h."row" >= t.row0 AND h."row" < t.row0 + {CROP} AND h.col >= t.col0 AND h.col < t.col0 + {CROP}
WHERE h.valid""")
def crop_pixels(spark, sf_dir):
    """The valid pixels of such crops."""
    px, crops = _charted_crops(spark, sf_dir)
    held = sampling.crop_pixels(px.select("scene_id", "row", "col", "hh", "hv", "valid", "ct").where("valid"), crops, CROP)
    return held.select("scene_id", "crop", "i", "j", "hh", "hv", "valid", "ct")


@query(f"""WITH {CHARTED}, one AS (SELECT scene_id, "row" AS r, col AS c, avg(hh) FILTER (NOT isnan(hh)) AS hh, count(ct) = 0 AS masked FROM ch GROUP BY ALL),
near AS (SELECT o.scene_id, o.r, o.c, avg(n.hh) AS m FROM one o, range(-2, 3) i(i), range(-2, 3) j(j), one n
    WHERE n.scene_id = o.scene_id AND n.r = o.r + i AND n.c = o.c + j GROUP BY ALL)
SELECT o.scene_id, o.r AS "row", o.c AS col, CASE WHEN o.masked THEN 255 ELSE round(m, 6) + 0.0 END AS prediction FROM one o JOIN near USING (scene_id, r, c)""")
def tiled_predictions(spark, sf_dir):
    """Predictions of windows of 32 pixels and a halo, as one raster; uncharted pixels are masked."""
    clean = F.when(~F.isnan("hh"), F.col("hh"))
    one = charted(spark, sf_dir).groupBy("scene_id", "row", "col").agg(F.avg(clean).alias("hh"), (F.count("ct") == 0).alias("masked"))
    made = tiles.predicted(one, ["hh"], tiles.box_mean(2), F.lit(SIDE), F.lit(SIDE), 32, 2, "masked")
    return rounded(made.withColumn("prediction", masks.null_if_nan(F.col("prediction"))), "prediction")


_HOLDS = "repeat('x', o_orderkey % 5) || o_orderkey || '-' || strftime(o_orderdate, '%Y%m%d') || 'T' || o_custkey || '_' || o_orderstatus"


@query(f"""WITH n AS (SELECT DISTINCT {_HOLDS} AS name FROM orders)
SELECT c_custkey::VARCHAR AS scene, min(name) AS first, count(name) AS n FROM customer LEFT JOIN n ON name LIKE '%' || c_custkey || '%' GROUP BY 1""")
def names_containing(spark, sf_dir):
    """Files whose names hold a scene's number anywhere, not at a known place."""
    order = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    begin = F.repeat(F.lit("x"), (F.col("o_orderkey") % 5).cast("int"))
    files = order.select(F.concat(begin, "o_orderkey", F.lit("-"), day, F.lit("T"), "o_custkey", F.lit("_"), "o_orderstatus").alias("name"))
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("scene"))
    return matching.containing(known, files, "scene", "name")


#: A raster's plane: x and y of row r and column c, a turned and sheared grid; and the grid's step.
_PLANE, _STEP = ("1000.3 + 2.0 * {c} + 0.5 * {r}", "5000.1 - 1.5 * {r} + 0.25 * {c}"), 4.0
_INVERSE = "(x - 1000.3) * 0.25 - (y - 5000.1) * 2.0", "(-(x - 1000.3) * 1.5 - (y - 5000.1) * 0.5)"


@query(f"""WITH {PIXELS}, one AS (SELECT scene_id, "row", col, max(distance) AS distance FROM px GROUP BY ALL),
g AS (SELECT i.i, j.j, (j.j + 0.5) * {_STEP}::DOUBLE AS x, (i.i + 0.5) * {_STEP}::DOUBLE AS y FROM range(1130, 1272) i(i), range(248, 440) j(j)),
p AS (SELECT i, j, {_INVERSE[0]} AS dr, {_INVERSE[1]} AS dc FROM g),
b AS (SELECT i, j, dr / (0.5 * 0.25 - 2.0 * -1.5) AS r, dc / (0.5 * 0.25 - 2.0 * -1.5) * -1 AS c FROM p)
SELECT o.scene_id, i, j, o."row", o.col, o.distance FROM b JOIN one o ON o."row" = floor(r + 0.5) AND o.col = floor(c + 0.5) WHERE r BETWEEN 0 AND {SIDE} AND c BETWEEN 0 AND {SIDE}""")
def warped_raster(spark, sf_dir):
    """Rasters on a grid of their plane, each cell with its nearest pixel."""
    one = pixels(spark, sf_dir).groupBy("scene_id", "row", "col").agg(F.max("distance").alias("distance"))
    steps = F.array(*(F.lit(float(k)) for k in (0, 90, 200, SIDE)))
    grid = one.select("scene_id").distinct().withColumn("line", F.explode(steps)).withColumn("sample", F.explode(steps))
    x, y = (F.expr(e.format(r="line", c="sample")).cast("double") for e in _PLANE)
    return warp.warped(one, grid.withColumns({"x": x, "y": y}), ["distance"], _STEP)


@query("""WITH l AS (SELECT unnest(['hh', 't2m']) AS variable, unnest([l_quantity, l_extendedprice]) AS x FROM lineitem)
SELECT variable, round(avg(x), 4) AS mean, round(stddev_pop(x), 4) AS std, count(*) AS n_pixels FROM l GROUP BY ALL""")
def running_moments(spark, sf_dir):
    """Moments by supplier, as they arrive in a stream of files, each twice, merged into those of the whole."""
    wide = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("scene_id"), F.col("l_quantity").alias("hh"), F.col("l_extendedprice").alias("t2m")
    )
    here = tables.scratch_path(spark, "running")
    parts = moments.scene_moments(moments.unpivoted(wide, ["hh", "t2m"])).select("scene_id", "variable", "n", "mean", "m2")
    parts.write.parquet(f"{here}/parts")
    for _ in range(2):  # what comes in the second call was there before
        again = spark.read.parquet(f"{here}/parts")
        again.write.mode("append").parquet(f"{here}/arrived")
        arrived = spark.readStream.schema(running.PARTS).option("maxFilesPerTrigger", 4).parquet(f"{here}/arrived")
        running.write_running(arrived, f"{here}/merged", f"{here}/checkpoint").awaitTermination()
    return moments.finished(running.newest(spark.read.parquet(f"{here}/merged")), 4)
