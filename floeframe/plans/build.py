"""The feature-table build: chip rows of scenes in, patch and chip tables out, what is done left alone."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from floeframe.functions import encodings, geo, tiling
from floeframe.operators import array_features, encoder, matching
from floeframe.schema import CHIP, CHIP_TABLE, MICROWAVE, PATCH, PATCH_TABLE, PLACE, RENAMED, SAR, TOKEN, WEATHER
from floeframe.sources import geoparquet, scene_rows, scenes

CHANNELS = [*SAR, *MICROWAVE, *WEATHER, "distance_map", "sar_grid_incidenceangle", "ct"]
#: Chip rows that a round of the build takes; what was written in a round stays if a later one fails.
ROUND = 4096


def hashed_tokens(df: DataFrame) -> DataFrame:
    """A stand-in encoder, with the same interface as a real one: columns patch_token and class_token added."""
    token = lambda *of: F.transform(F.sequence(F.lit(0), F.lit(TOKEN - 1)), lambda k: (F.pmod(F.xxhash64(k, *of), F.lit(2001)) / 1000 - 1).cast("float"))
    return df.withColumns({"patch_token": token("chip_id", "patch_i", "patch_j"), "class_token": F.when(F.col("first"), token("chip_id"))})


def transformer(weights: str, chip: int = CHIP, limit: int = encoder.BYTES) -> Callable[[DataFrame], DataFrame]:
    """The vision transformer with weights kept at a path that all executors read."""
    return lambda df: encoder.encoded(df, weights, SAR, (chip // PATCH) ** 2, limit)


def patch_table(
    rows: DataFrame,
    encode: Callable[[DataFrame], DataFrame] = hashed_tokens,
    chip: int = CHIP,
    band_means: dict[str, float] | None = None,
) -> DataFrame:
    """The patch table from `scene_rows` with CHANNELS; of a chip's first patch also class_token and chip_geometry.

    No step shuffles, and patches stay in the order in which they come. Statistics are those of the radar as it is; the
    encoder sees it with what is invalid filled by band_means (else 0), and the chip's time_encoding and place_encoding.
    """
    # chips without a valid pixel or a label go before the costly steps
    kept = rows.where("any_valid AND any_label").drop("any_valid", "any_label")
    means = {b: b for b in [*MICROWAVE, *WEATHER]} | {"sar_grid_incidenceangle": "ia_mean"}
    aside = kept.withColumnsRenamed({b: f"__{b}" for b in means})
    fill = {b: (band_means or {}).get(b, 0.0) for b in SAR}
    made = array_features.with_features(
        aside, {f"__{b}": out for b, out in means.items()}, *SAR, "distance_map", "ct", fill, (*(f"__{b}" for b in means), "distance_map", "ct")
    )
    first = (F.col("patch_i") == 0) & (F.col("patch_j") == 0)
    middle = [F.get("middle", F.lit(k)) for k in range(2)]
    made = made.withColumns({
        "chip_id": tiling.chip_id(F.col("scene_id"), F.col("row0"), F.col("col0")),
        "first": first,
        "time_encoding": F.array(*encodings.time_encoding(encodings.scene_time(F.col("scene_id")))),
        "place_encoding": F.array(*encodings.place_encoding(*middle)),
    })
    made = geo.with_ring(made, "geometry", "corners")
    made = geo.with_ring(made, "chip_geometry", "chip_corners", first)
    kept = [*PATCH_TABLE, *PLACE, "row0", "first", "class_token", "chip_geometry"]
    made = encode(made.drop("corners", "chip_corners", "middle"))
    # names with dots come last: a step in Python can't take them
    return made.withColumnsRenamed(RENAMED).select(*(F.col(f"`{c}`") for c in kept))


OPEN = "path string, scene_id string, row0 int, of int"


def chip_rows(files: DataFrame, chip: int) -> DataFrame:
    """OPEN: every chip row of files (path, scene_id), and how many its scene has. Only headers are read."""
    schema = StructType.fromDDL(OPEN)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, scene in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                _, rows = scene_rows.open_rows((path, scene), SAR[0], chip, set())
                columns = [[path] * len(rows), [scene] * len(rows), rows, [len(rows)] * len(rows)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return files.select("path", "scene_id").mapInArrow(run, schema)


def _done(spark: SparkSession, path: str) -> DataFrame:
    """Chip rows that are done; none where there is no such table yet."""
    schema = "scene_id string, row0 int, of int"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def whole_scenes(done: DataFrame) -> DataFrame:
    """(scene_id) of scenes whose chip rows are all done."""
    each = done.groupBy("scene_id").agg(F.count_distinct("row0").alias("n"), F.max("of").alias("of"))
    return each.where("n >= of").select("scene_id")


#: What goes into which table's files, by name there.
TABLES = {
    "patches": {"columns": {c: c for c in [*PATCH_TABLE, *PLACE]}},
    "chips": {"columns": {c: "chip_geometry" if c == "geometry" else c for c in CHIP_TABLE}, "where": "first"},
}


def build(
    spark: SparkSession,
    root: str,
    out: str,
    split: str,
    encode: Callable[[DataFrame], DataFrame] = hashed_tokens,
    chip: int = CHIP,
    band_means: dict[str, float] | None = None,
    pattern: str = "*.{nc,npz}",
    round_rows: int = ROUND,
) -> int:
    """Write the tables of the chip rows below root that aren't done; the number of rounds that it took.

    GeoParquet files go to out/patches and out/chips, one for each scene and chip row; out/done comes last in a round
    and holds every chip row that was read, those without a usable chip too. A build that ends half-way loses the round
    it was in: a part's name is its chip row's number, so what is written again replaces what was there.
    """
    rounds = 0
    while True:
        done = _done(spark, f"{out}/done")
        files = matching.not_done(scenes.listed(spark, root, split, pattern), whole_scenes(done))
        todo = chip_rows(files, chip).join(done.select("scene_id", "row0"), ["scene_id", "row0"], "left_anti")
        # at most a round's worth comes to the driver
        taken = todo.orderBy("path", "row0").limit(round_rows).collect()
        if not taken:
            return rounds
        plan = [scene_rows.Split(r.path, r.scene_id, (r.row0,)) for r in taken]
        rows = scene_rows.scene_rows(spark, root, CHANNELS, split, chip, plan=plan)
        made = patch_table(rows, encode, chip, band_means).withColumn("part", F.ceil(F.col("row0") / chip).cast("int"))
        geoparquet.write(made, out, TABLES, "part")
        spark.createDataFrame([(r.scene_id, r.row0, r.of) for r in taken], "scene_id string, row0 int, of int").coalesce(1).write.mode("append").parquet(f"{out}/done")
        rounds += 1

