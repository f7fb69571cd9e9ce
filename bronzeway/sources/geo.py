"""Geographic dimension files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from bronzeway.sources.tables import stored

PARTS = "parts"

_LINE = ArrayType(ArrayType(DoubleType()))
_LINES = ArrayType(_LINE)

_RING_ARCS = ArrayType(ArrayType(LongType()))

# Coordinates nest deeper in a MultiLineString than in a LineString, so no one
# type fits a file that has both; they are read as JSON text and typed per row.
_RAW_GEOMETRY = StructType(
    [StructField("type", StringType()), StructField("coordinates", StringType())]
)


def _feature_schema(properties: StructType) -> StructType:
    return StructType(
        [StructField("properties", properties), StructField("geometry", _RAW_GEOMETRY)]
    )


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """``file, place, text``: the features of collections, each as its JSON text.

    A collection is one document, but its bytes are read in splits, as records that end
    at every opening brace. What a record does to the state of the document (in a string
    or not, braces and brackets open) is known apart from the records before it but for
    whether it begins in a string; so the state at a record is a sum over the splits
    before and the records before it in the split, and a feature is what begins where one
    brace and one bracket are open. Its records, of whichever splits, then meet by its
    number. No task gets more than a split or a feature.
    """
    scanned = spark.read.option("lineSep", "{").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("record"),
    )
    # No escape goes over a record's end: a brace is never escaped.
    bare = F.regexp_replace("record", r"\\.", "")
    pieces = F.split(bare, '"')

    def count(text: Column, character: str) -> Column:
        return F.length(text) - F.length(F.translate(text, character, ""))

    def outside(start: int) -> Column:
        """What is outside of strings if the record begins outside (0) or inside of one (1)."""
        return F.array_join(F.filter(pieces, lambda _, i: i % 2 == start), "")

    columns = {"quotes": (F.size(pieces) - 1) % 2}
    for start in (0, 1):
        columns[f"braces{start}"] = -count(outside(start), "}")
        columns[f"brackets{start}"] = count(outside(start), "[") - count(outside(start), "]")
    records = stored(scanned.withColumns(columns), "records")
    in_split = Window.partitionBy("file", "split").orderBy("at")
    of_file = Window.partitionBy("file").orderBy("split")
    past = (Window.unboundedPreceding, -1)

    def carried(rows: DataFrame, amounts: dict[str, Column]) -> DataFrame:
        """Sums of the amounts over all records in front of each, by split and in the split."""
        rows = rows.withColumns({f"_{n}": c for n, c in amounts.items()})
        totals = rows.groupBy("file", "split").agg(*(F.sum(f"_{n}").alias(f"_{n}_all") for n in amounts))
        # A row for each split of a file.
        fronts = totals.select(
            "file", "split", *(F.coalesce(F.sum(f"_{n}_all").over(of_file.rowsBetween(*past)), F.lit(0)).alias(f"_{n}_front") for n in amounts)
        )
        joined = rows.join(fronts, ["file", "split"])
        sums = {
            n: F.col(f"_{n}_front") + F.coalesce(F.sum(f"_{n}").over(in_split.rowsBetween(*past)), F.lit(0))
            for n in amounts
        }
        return joined.withColumns(sums).drop(*(f"_{n}" for n in amounts), *(f"_{n}_front" for n in amounts))

    told = carried(records, {"quoted": F.col("quotes")}).withColumn("inside", F.col("quoted") % 2 == 1)
    # A record comes behind a brace, but for the first of a file.
    first = (F.col("split") == 0) & (F.row_number().over(in_split) == 1)
    told = told.withColumn("opens", (~F.col("inside") & ~first).cast("int"))
    pick = lambda name: F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    told = carried(told, {"deep": F.col("opens") + pick("braces"), "listed": pick("brackets")})
    begins = (F.col("opens") == 1) & (F.col("deep") == 1) & (F.col("listed") == 1)
    counted = carried(told.withColumn("begins", begins.cast("int")), {"place": F.col("begins")})
    place = F.col("place") + F.col("begins")
    within = (F.col("deep") + F.col("opens") >= 2) & (F.col("listed") >= 1)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("split", "at", "record"))), lambda r: r["record"])
    return (
        counted.filter(within)
        .groupBy("file", place.alias("place"))
        .agg(F.concat(F.lit("{"), F.array_join(parts, "{")).alias("text"))
    )


def read_geojson(
    spark: SparkSession,
    path: str,
    by_line: bool = False,
    properties: StructType | None = None,
) -> DataFrame:
    """Line features: their properties and ``parts``, an array of lines.

    ``by_line`` reads files with one feature per line. A feature collection is one
    document and is split between its features (``feature_texts``); only to infer the
    ``properties`` where they aren't given, one task reads each file whole.
    """
    reader = spark.read.option("multiLine", str(not by_line).lower())
    if properties is None:
        seen = reader.json(path).schema
        feature = seen if by_line else seen["features"].dataType.elementType
        properties = feature["properties"].dataType
    schema = _feature_schema(properties)
    if by_line:
        features = reader.schema(schema).json(path)
    else:
        # In the order of the files, as a reader of whole documents gives them.
        found = feature_texts(spark, path).orderBy("file", "place")
        features = found.select(F.from_json("text", schema).alias("f")).select("f.*")
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    parts = F.when(kind == "LineString", F.array(F.from_json(text, _LINE))).when(
        kind == "MultiLineString", F.from_json(text, _LINES)
    )
    return features.select("properties.*", parts.alias(PARTS))


def read_topojson_attributes(spark: SparkSession, path: str) -> DataFrame:
    """``id`` and properties of every geometry of a topology file."""
    whole = spark.read.option("multiLine", "true").json(path)

    def attributes(name: str) -> DataFrame:
        geometries = whole.select(
            F.explode(F.col("objects")[name]["geometries"]).alias("g")
        )
        has_properties = "properties" in geometries.schema["g"].dataType.names
        return geometries.select("g.id", *(["g.properties.*"] if has_properties else []))

    names = whole.schema["objects"].dataType.names
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        (attributes(name) for name in names),
    )


def read_topojson_rings(spark: SparkSession, path: str) -> DataFrame:
    """The rings of every polygon of a topology file: ``id``, properties, and where.

    ``object`` is the name of the geometry's collection, ``polygon`` and ``ring`` count
    from 0 (ring 0 is the outer one), ``points`` are its corners, the first one again at
    the end. Borders that two areas share are stored once, as arcs of steps from the point
    before, on a grid if the file has one: steps are summed up to points, an area that
    takes a border against its direction gets it turned, and the arcs of a ring are put
    one behind the other with the point between them once. A geometry that isn't a
    polygon has no rings and no row.
    """
    reader = spark.read.option("multiLine", "true")
    seen = reader.json(path).schema
    # Arcs nest deeper in a MultiPolygon, so they are read as text and typed by row.
    objects = StructType(
        [
            StructField(o.name, StructType([StructField("geometries", ArrayType(_arcs_as_text(o.dataType)))]))
            for o in seen["objects"].dataType
        ]
    )
    scale = StructType([StructField(n, ArrayType(DoubleType())) for n in ("scale", "translate")])
    topology = StructType(
        [
            StructField("objects", objects),
            StructField("arcs", ArrayType(ArrayType(ArrayType(DoubleType())))),
            StructField("transform", scale),
        ]
    )
    whole = reader.schema(topology).json(path).withColumn("file", F.input_file_name())

    # Steps of all arcs are summed at once, apart by arc; without a grid points are as given.
    along = Window.partitionBy("file", "arc").orderBy("i")
    steps = whole.select("file", "transform", F.posexplode("arcs").alias("arc", "steps")).select(
        "file", "transform", "arc", F.posexplode("steps").alias("i", "step")
    )

    def placed(axis: int) -> Column:
        step = F.get("step", F.lit(axis))
        grid = F.get("transform.scale", F.lit(axis)), F.get("transform.translate", F.lit(axis))
        return F.when(F.col("transform").isNull(), step).otherwise(F.sum(step).over(along) * grid[0] + grid[1])

    points = steps.select("file", "arc", "i", F.array(placed(0), placed(1)).alias("point"))
    in_order = lambda c, item: F.transform(F.array_sort(F.collect_list(c)), lambda e: e[item])
    arcs = points.groupBy("file", "arc").agg(in_order(F.struct("i", "point"), "point").alias("points"))

    found = []
    for name in objects.names:
        geometries = whole.select("file", F.posexplode(F.col("objects")[name]["geometries"]).alias("g", "geometry"))
        kind, text = F.col("geometry.type"), F.col("geometry.arcs")
        polygons = F.when(kind == "Polygon", F.array(F.from_json(text, _RING_ARCS))).when(
            kind == "MultiPolygon", F.from_json(text, ArrayType(_RING_ARCS))
        )
        rings = (
            geometries.select("file", "g", F.posexplode(polygons).alias("polygon", "rings"))
            .select("file", "g", "polygon", F.posexplode("rings").alias("ring", "refs"))
            .select("file", "g", "polygon", "ring", F.posexplode("refs").alias("k", "ref"))
        )
        # A negative number n is arc -1 - n the other way round.
        own = F.when(F.col("ref") < 0, -1 - F.col("ref")).otherwise(F.col("ref"))
        turned = F.when(F.col("ref") < 0, F.reverse("points")).otherwise(F.col("points"))
        behind = F.when(F.col("k") > 0, F.slice("run", 2, F.size("run"))).otherwise(F.col("run"))
        stitched = (
            rings.withColumn("arc", own.cast("int")).join(arcs, ["file", "arc"]).withColumn("run", turned)
            .withColumn("run", behind).groupBy("file", "g", "polygon", "ring")
            .agg(F.flatten(in_order(F.struct("k", "run"), "run")).alias("points"))
        )
        fields = objects[name].dataType["geometries"].dataType.elementType.names
        told = geometries.select(
            "file", "g", "geometry.id", *(["geometry.properties.*"] if "properties" in fields else [])
        )
        found.append(
            told.join(stitched, ["file", "g"]).withColumn("object", F.lit(name)).drop("file", "g")
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def _arcs_as_text(collection: StructType) -> StructType:
    """The type of a geometry, its arcs read as text; ``id`` and ``type`` are there in any case."""
    seen = collection["geometries"].dataType.elementType
    fields = [f for f in seen if f.name not in ("arcs", "id", "type")]
    return StructType([*fields, *(StructField(n, StringType()) for n in ("id", "type", "arcs"))])
