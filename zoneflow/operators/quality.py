"""Quality counts, scores, constraint checks and schema reports."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.sources.files import output_files

# Fields every event record must carry.
REQUIRED_FIELDS = ("event_id", "timestamp", "vehicle_id", "zone_id", "event_type", "occupancy", "capacity")


def quality_counts(ev: DataFrame) -> DataFrame:
    """Overfull rows, negative durations and surplus copies of ids, in one job."""
    per_id = ev.groupBy("event_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("occupancy") > F.col("capacity")).alias("over"),
        F.count_if(F.col("parking_duration") < 0).alias("negative"),
    )
    return per_id.agg(
        F.sum("over").alias("over_capacity"), F.sum("negative").alias("negative_duration"),
        F.sum(F.col("n") - 1).alias("duplicate_ids"),
    )


def quality_scores(ev: DataFrame, n: int | None = None, order: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """Four percentages over all rows, or over the newest `n` if asked for, and their mean."""
    sample = ev if n is None else ev.orderBy(*[F.desc(c) for c in order]).limit(n)
    in_range = (F.col("occupancy") >= 0) & (F.col("capacity") > 0) & (F.col("occupancy") <= F.col("capacity"))
    present = sum(c in ev.columns for c in REQUIRED_FIELDS) / len(REQUIRED_FIELDS) * 100

    def share(flag: Column) -> Column:
        return F.avg(F.coalesce(flag, F.lit(False)).cast("double")) * 100

    scores = sample.agg(
        F.round(share(F.col("timestamp").isNotNull()), 2).alias("timestamp_completeness"),
        F.round(F.count_distinct("event_id") / F.count("*") * 100, 2).alias("record_uniqueness"),
        F.round(share(in_range), 2).alias("range_validity"),
        F.lit(round(present, 2)).alias("schema_compliance"),
    )
    names = ["timestamp_completeness", "record_uniqueness", "range_validity", "schema_compliance"]
    total = reduce(lambda a, b: a + b, [F.col(c) for c in names])
    return scores.withColumn("quality_average", F.round(total / len(names), 2))


@dataclass
class TableSpec:
    """Constraints of one table; `checks` maps a name to a SQL condition."""

    unique: list[tuple[str, ...]] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    checks: dict[str, str] = field(default_factory=dict)


ZONE_TABLE = TableSpec(
    unique=[("zone_id",)], not_null=["zone_id", "capacity"], checks={"capacity_positive": "capacity > 0"},
)
PREDICTION_TABLE = TableSpec(
    unique=[("zone_id", "timestamp")], not_null=["zone_id", "timestamp"],
    checks={"risk_in_set": "risk_level IN ('LOW', 'MEDIUM', 'HIGH')"},
)
SUMMARY_TABLE = TableSpec(not_null=["timestamp", "zone_id"])


def check_constraints(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per constraint with the number of rows that break it.

    As in SQL, a check passes where its condition is null, and null keys are
    never duplicates of each other.
    """
    parts = []
    simple = {f"not_null({c})": F.col(c).isNull() for c in spec.not_null}
    simple |= {f"check({name})": ~F.coalesce(F.expr(cond), F.lit(True)) for name, cond in spec.checks.items()}
    if simple:
        row = df.agg(*[F.count_if(bad).alias(name) for name, bad in simple.items()])
        parts.append(row.unpivot([], list(simple), "constraint", "violations"))
    for key in spec.unique:
        copies = df.na.drop(subset=list(key)).groupBy(*key).agg(F.count("*").alias("n"))
        parts.append(copies.agg(
            F.lit(f"unique({', '.join(key)})").alias("constraint"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"),
        ))
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, zones: DataFrame, key: str = "zone_id") -> DataFrame:
    """Rows that name a zone the dimension lacks."""
    return child.where(F.col(key).isNotNull()).join(zones.select(key), key, "left_anti")


def schema_report(df: DataFrame) -> DataFrame:
    """Name, type and whether nulls occur, per column."""
    marks = df.agg(*[F.max(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    rows = marks.unpivot([], df.columns, "column_name", "has_nulls")
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    position = F.array_position(F.array(*[F.lit(c) for c in df.columns]), F.col("column_name"))
    return rows.select(
        position.cast("int").alias("position"), "column_name",
        types[F.col("column_name")].alias("data_type"),
        F.coalesce("has_nulls", F.lit(False)).alias("has_nulls"),
    )


def stored_files(df: DataFrame) -> DataFrame:
    """Name, size and time of the files that `df` is read from, from their listing; no row is read for it."""
    paths = sorted(set(df.inputFiles()))
    spark = df.sparkSession
    return output_files(spark, *paths) if paths else spark.createDataFrame([], "file_path string, file_size long, file_modification_time timestamp")


def catalog(layers: dict[str, DataFrame], with_bytes: bool = False) -> DataFrame:
    """Rows and columns per layer, with file bytes for layers read from files."""
    def entry(name: str, df: DataFrame) -> DataFrame:
        out = df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("layer"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        if not with_bytes:
            return out
        size = stored_files(df).agg(F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"))
        return out.withColumn("bytes", size.scalar())

    return reduce(DataFrame.unionByName, [entry(name, df) for name, df in layers.items()])


def newest_files(df: DataFrame, n: int = 6) -> DataFrame:
    """The `n` most recently written files of a file-backed table."""
    name = F.element_at(F.split("file_path", "/"), -1).alias("file_name")
    files = stored_files(df).select(name, "file_size", "file_modification_time")
    return files.orderBy(F.desc("file_modification_time"), "file_name").limit(n)


def _ddl_type(kind: T.DataType) -> str:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "BIGINT"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "DOUBLE PRECISION"
    if isinstance(kind, T.BooleanType):
        return "BOOLEAN"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "TIMESTAMP"
    return "VARCHAR"


def ddl_for(df: DataFrame, name: str) -> DataFrame:
    """One row with a CREATE TABLE text; NOT NULL where no null was seen."""
    types = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, _ddl_type(f.dataType))])
    line = F.concat(
        F.lit('    "'), F.col("column_name"), F.lit('" '), types[F.col("column_name")],
        F.when(F.col("has_nulls"), "").otherwise(" NOT NULL"),
    )
    lines = schema_report(df).agg(F.sort_array(F.collect_list(F.struct("position", line.alias("line")))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["line"]), ",\n")
    return lines.select(F.concat(F.lit(f"CREATE TABLE {name} (\n"), body, F.lit("\n);\n")).alias("ddl"))
