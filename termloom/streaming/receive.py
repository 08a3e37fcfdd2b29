"""Receiving announced data sets as a stream of text lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termloom.operators.lookups import lookup_join
from termloom.scratch import new_folder
from termloom.sources.batches import batch_name


@dataclass(frozen=True)
class ControlTags:
    """Texts that mark a control line."""

    end: str = "END_STREAM"
    name: str = "DATA_NAME"
    store: str = "DATA_STORE"
    uuid: str = "STORE_UUID"

    def all(self) -> list[str]:
        return [self.end, self.name, self.store, self.uuid]


DEFAULT_TAGS = ControlTags()
LINE_SCHEMA = "value string"


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of non-empty lines with the folder of their data set; ``max_files`` never changes what comes out."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    lines = (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).text(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    return lines.select("value", folder.alias("folder")).where(F.length("value") > 0)


def is_control(line: Column, tags: ControlTags = DEFAULT_TAGS) -> Column:
    out = F.lit(False)
    for tag in tags.all():
        out = out | line.contains(tag)
    return out


def stream_strip_control(lines: DataFrame, tags: ControlTags = DEFAULT_TAGS) -> DataFrame:
    return lines.where(~is_control(F.col("value"), tags) & (F.length(F.trim("value")) > 0))


def meta_value(line: Column, tag: str) -> Column:
    """The part after ``=`` of a control line with this tag."""
    return F.when(line.contains(tag), F.regexp_extract(line, "=([^=]*)", 1))


def stream_parse_meta(lines: DataFrame, tags: ControlTags = DEFAULT_TAGS) -> DataFrame:
    """Name, store and uuid per data set folder."""
    value = F.col("value")
    return lines.where(is_control(value, tags)).groupBy("folder").agg(
        F.max(meta_value(value, tags.name)).alias("data_name"),
        F.max(meta_value(value, tags.store)).alias("store"),
        F.max(meta_value(value, tags.uuid)).alias("store_uuid"),
        F.max(value.contains(tags.end)).alias("ended"),
    )


def route_of(name: Column, store: Column, uuid: Column, suffix: str = "supplement") -> Column:
    known = store.isNotNull() & uuid.isNotNull()
    return F.when(~known, "unrecognised").when(name.contains(suffix), "supplement").otherwise("data")


def route_lines(
    lines: DataFrame, tags: ControlTags = DEFAULT_TAGS, suffix: str = "supplement", control: DataFrame | None = None
) -> DataFrame:
    """Data lines with their route and batch folder name.

    The announcements are among the lines, or in ``control``. A data set may hold
    a third of all lines, so its few announcements are looked up rather than
    shuffled together with the lines.
    """
    meta = stream_parse_meta(lines if control is None else control, tags)
    routed = meta.select(
        "folder",
        route_of(F.col("data_name"), F.col("store"), F.col("store_uuid"), suffix).alias("route"),
        F.coalesce(
            batch_name(F.col("store_uuid"), F.col("store"), F.col("data_name")), F.col("data_name")
        ).alias("batch"),
    )
    joined = lookup_join(stream_strip_control(lines, tags), routed, ["folder"], "left")
    return joined.select(F.coalesce("route", F.lit("unrecognised")).alias("route"), "batch", "value")


def _landed(spark: SparkSession, checkpoint: str, part: str) -> DataFrame:
    return spark.read.schema("value string, folder string, epoch long").parquet(f"{checkpoint}-landed/{part}")


def ended_sets(control: DataFrame, tags: ControlTags = DEFAULT_TAGS) -> DataFrame:
    """Data sets whose end line has come, and in which micro-batch it first did."""
    return control.where(F.col("value").contains(tags.end)).groupBy("folder").agg(F.min("epoch").alias("ended_at"))


def waiting_lines(spark: SparkSession, checkpoint: str, tags: ControlTags = DEFAULT_TAGS) -> DataFrame:
    """Landed lines of data sets that have no end line yet."""
    ended = ended_sets(_landed(spark, checkpoint, "control"), tags).select("folder")
    return lookup_join(_landed(spark, checkpoint, "lines"), ended, ["folder"], "left_anti").select("folder", "value")


def stream_route(
    lines: DataFrame, out_path: str, checkpoint: str, tags: ControlTags = DEFAULT_TAGS, suffix: str = "supplement"
) -> StreamingQuery:
    """Write lines to ``out_path`` by route, data set by data set; a replay rewrites its own part.

    Lines and announcements are landed beside the checkpoint. A data set is
    routed once its end line is there, with all its lines so far; lines that come
    later are routed as they come, so micro-batches never show in the result.
    """
    spark = lines.sparkSession

    def sink(batch: DataFrame, epoch: int) -> None:
        announced = is_control(F.col("value"), tags)
        for part, rows in (("control", batch.where(announced)), ("lines", batch.where(~announced))):
            rows.write.mode("overwrite").parquet(f"{checkpoint}-landed/{part}/epoch={epoch}")
        control, landed = (_landed(spark, checkpoint, part).where(F.col("epoch") <= epoch) for part in ("control", "lines"))
        ends = ended_sets(control, tags)
        before, just = ends.where(F.col("ended_at") < epoch), ends.where(F.col("ended_at") == epoch)
        ready = lookup_join(landed.where(F.col("epoch") == epoch), before.select("folder"), ["folder"], "left_semi")
        if not just.isEmpty():
            ready = ready.unionByName(lookup_join(landed, just.select("folder"), ["folder"], "left_semi"))
        routed = route_lines(ready.drop("epoch"), tags, suffix, control)
        routed.write.mode("overwrite").partitionBy("route").parquet(f"{out_path}/epoch={epoch}")

    return (
        lines.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Wait until an available-now query has ended; an error in it, or running past ``timeout`` seconds, is raised here."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        raise TimeoutError(f"the stream still runs after {timeout} s")
    return query


def collect_stream(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Run a stateless stream over what is available and read its output back."""
    out, checkpoint = new_folder(spark, label), new_folder(spark, f"{label}-checkpoint")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    drain(query)
    return spark.read.schema(stream.schema).parquet(out)
