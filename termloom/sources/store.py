"""A data set kept as parquet tables below one folder.

Data tables are partitioned by ``batch_id``: appending, replaying and deleting
a batch touch that batch's folder only.

What is to replace something is written to a staged folder first and checked
there. Renaming that folder is the decision; then its parts are renamed into
place. A failure before the decision leaves the store as it was, one after it is
finished by the next writer (``finish_swaps``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.frame import COLUMNS_SCHEMA, TARGETS_SCHEMA, SparseFrame, cell_parts
from termloom.functions.text import clean_name, decimal_text, value_at
from termloom.operators.lookups import fits_broadcast, lookup_join, measured
from termloom.operators.ranking import number_by_hash
from termloom.scratch import Written, publish, write_table
from termloom.sources import folders
from termloom.sources.tables import check_unique_names, clean_column_names

DATA_SCHEMA = (
    "row_id string, target string, indices array<int>, values array<double>, "
    "row_hash string, ts timestamp, batch_id string"
)
#: Bytes of a row group of the postings: what a search for one term reads at least.
POSTINGS_GROUP = 8 << 20
INDEX_SCHEMA = "term string, row_id string, ts timestamp, batch_id string"
ID_MAP_SCHEMA = "old_id double, row_id string, ts timestamp, batch_id string"
IDENTITY_SCHEMA = "store string, store_uuid string"
DICTIONARY_SUFFIX = ", batch_id string"

TABLES = {
    "data": DATA_SCHEMA,
    "index": INDEX_SCHEMA,
    "columns": COLUMNS_SCHEMA + DICTIONARY_SUFFIX,
    "targets": TARGETS_SCHEMA + DICTIONARY_SUFFIX,
    "id_map": ID_MAP_SCHEMA,
    "identity": IDENTITY_SCHEMA,
}
BATCH_TABLES = ("data", "index", "columns", "targets", "id_map")
# Names outlive the batch that brought them in, as later batches use their numbers.
ROW_TABLES = ("data", "index", "id_map")


@dataclass(frozen=True)
class StoreConfig:
    """Settings of one store."""

    flush: bool = False
    trim: bool = True
    supplement: bool = False
    truncate_overwrite: bool = False
    archive: bool = False
    flush_threshold: int = 100_000
    uid_column: str = "a_uid"
    supplement_suffix: str = "supplement"
    permitted_duplicates: float = 1.0


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    name: str
    config: StoreConfig = StoreConfig()

    def path(self, table: str) -> str:
        return f"{self.root}/{self.name}/{table}"


SWAPS = "_swaps"
STAGED, READY = "staged-", "ready-"


def new_stage(store: Store) -> str:
    """A fresh staged folder. In it ``names/<table>`` holds files to add, ``batches/<table>`` batch folders
    to put in place of those of the same name, ``tables/<table>`` whole tables; an empty folder only removes."""
    return f"{store.path(SWAPS)}/{STAGED}{uuid.uuid4().hex}"


def commit_stage(store: Store, stage: str) -> None:
    """Decide for a staged folder, and put its parts into place."""
    folders.move(store.spark, stage, stage.replace(f"/{STAGED}", f"/{READY}"))
    finish_swaps(store)


def finish_swaps(store: Store) -> None:
    """Put into place what was decided for; each step may be done again after an interruption."""
    spark, root = store.spark, store.path(SWAPS)
    for swap in (n for n in folders.names(spark, root) if n.startswith(READY)):
        ready = f"{root}/{swap}"
        for name in folders.names(spark, f"{ready}/names"):
            for batch in folders.names(spark, f"{ready}/names/{name}"):
                for file in folders.names(spark, f"{ready}/names/{name}/{batch}"):
                    folders.move(spark, f"{ready}/names/{name}/{batch}/{file}", f"{store.path(name)}/{batch}/{file}")
        for name in folders.names(spark, f"{ready}/batches"):
            for batch in folders.names(spark, f"{ready}/batches/{name}"):
                _put(spark, f"{ready}/batches/{name}/{batch}", f"{store.path(name)}/{batch}")
        for name in folders.names(spark, f"{ready}/tables"):
            _put(spark, f"{ready}/tables/{name}", store.path(name))
        folders.drop(spark, ready)


def _put(spark: SparkSession, source: str, target: str) -> None:
    if folders.names(spark, source):
        folders.move(spark, source, target)
    else:
        folders.drop(spark, target)


def create_store(store: Store, store_uuid: str) -> None:
    """Write the empty tables where absent, and the identity row once."""
    create_empty(store)
    store.spark.createDataFrame([(store.name, store_uuid)], IDENTITY_SCHEMA).write.mode("ignore").parquet(
        store.path("identity")
    )


def create_empty(store: Store) -> None:
    for table, schema in TABLES.items():
        if table != "identity":
            store.spark.createDataFrame([], schema).write.mode("ignore").parquet(store.path(table))


def create_supplement(store: Store, like: DataFrame) -> None:
    """Empty supplement with the cleaned text columns of a CSV or DataFrame."""
    names = clean_column_names(like).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    schema = schema.add("ts", T.TimestampType()).add("batch_id", T.StringType())
    store.spark.createDataFrame([], schema).write.mode("ignore").parquet(store.path("supplement"))


def store_exists(store: Store, table: str = "data") -> bool:
    return folders.exists(store.spark, store.path(table))


def scan(store: Store, table: str) -> DataFrame:
    if table in TABLES:
        return store.spark.read.schema(TABLES[table]).parquet(store.path(table))
    return store.spark.read.option("mergeSchema", "true").parquet(store.path(table))


def scan_columns(store: Store) -> DataFrame:
    return scan(store, "columns").select("term", "idx")


def scan_targets(store: Store) -> DataFrame:
    return scan(store, "targets").select("target", "idx")


def scan_id_map(store: Store) -> DataFrame:
    return scan(store, "id_map").select("old_id", "row_id")


def scan_dataframe(store: Store) -> DataFrame:
    return scan(store, "data")


def scan_supplement(store: Store) -> DataFrame:
    return scan(store, "supplement")


def repair_rows(data: DataFrame, place: Column | None = None) -> DataFrame:
    """Sort a row's cells by index and replace an empty id.

    The new id is a digest of ``place``, where the row stands, or else of the row
    itself, so every scan gives the same ids.
    """
    pairs = F.array_sort(F.arrays_zip("indices", "values"))
    digest = F.md5(F.to_json(F.struct(*data.columns)) if place is None else place)
    made = F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return (
        data.withColumn("row_id", F.when(F.length(F.trim("row_id")) > 0, F.col("row_id")).otherwise(made))
        .withColumn("_p", pairs)
        .withColumn("indices", F.col("_p.indices"))
        .withColumn("values", F.col("_p.values"))
        .drop("_p")
    )


def scan_store(store: Store) -> SparseFrame:
    """All rows with their dictionaries, cells by term name; a number without a name is an error."""
    place = F.concat_ws("#", "batch_id", "_metadata.file_name", F.col("_metadata.row_index").cast("string"))
    data = repair_rows(scan(store, "data").withColumn("_place", place), F.col("_place")).drop("_place")
    long = data.select("row_id", "target", F.inline(F.arrays_zip(F.col("indices").alias("idx"), F.col("values").alias("value"))))
    columns = scan_columns(store)
    named = lookup_join(long, measured(columns), ["idx"], "left")
    nameless = F.raise_error(F.concat(F.lit("No name for column "), F.col("idx").cast("string"))).cast("string")
    cells = named.select("row_id", "target", F.coalesce("term", nameless).alias("term"), "value")
    return SparseFrame(data.select("row_id", "target", "batch_id", "ts"), cells, columns, scan_targets(store))


def scan_schema(store: Store) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and labels without the data."""
    return scan_columns(store), scan_targets(store)


def scan_store_where(store: Store, terms: list[str], target: str | None = None) -> DataFrame:
    """Stored rows that contain all the terms, found through the sorted postings; without terms none.

    Postings are counted first, from the term column alone. The rarest list is
    then cut down by the next rarest and so on; each read skips the row groups
    and pages of other terms.
    """
    data = scan(store, "data")
    if target is not None:
        data = data.where(F.col("target") == target)
    wanted = sorted(set(terms))
    sizes = posting_sizes(store, wanted)
    if not wanted or len(sizes) < len(wanted):
        return data.where(F.lit(False))
    rarest, *others = sorted(wanted, key=lambda term: (sizes[term], term))
    found = postings(store, rarest)
    for term in others:
        found = found.join(postings(store, term), "row_id", "left_semi")
    return data.join(found, "row_id", "left_semi")


def postings(store: Store, term: str) -> DataFrame:
    """Ids of the rows that hold a term."""
    return scan(store, "index").where(F.col("term") == term).select("row_id")


def posting_sizes(store: Store, terms: list[str]) -> dict[str, int]:
    """How many postings each of these terms has; those without any are left out."""
    if not terms:
        return {}
    hits = scan(store, "index").where(F.col("term").isin(*terms))
    return {r["term"]: r["n"] for r in hits.groupBy("term").agg(F.count("*").alias("n")).collect()}


def new_terms(incoming: DataFrame, known: DataFrame, key: str = "term") -> DataFrame:
    """Incoming names (lower-cased) that are not known, ignoring case."""
    names = incoming.select(F.lower(key).alias(key)).distinct()
    return names.join(known.select(F.lower(key).alias(key)), key, "left_anti")


def append_dictionary(incoming: DataFrame, known: DataFrame, key: str, kind: str) -> DataFrame:
    """Number the unseen names from the highest known index + 1, in hash order."""
    ranked = number_by_hash(new_terms(incoming, known, key), key, "_rank")
    top = known.agg(F.coalesce(F.max("idx"), F.lit(0)).alias("m")).scalar()
    return ranked.select(key, (F.col("_rank") + top).cast(kind).alias("idx"))


def replace_columns(store: Store, columns: DataFrame, batch_id: str) -> None:
    """Put another vocabulary in the place of the store's, in one swap."""
    stage = new_stage(store)
    fresh = columns.select("term", "idx", F.lit(batch_id).alias("batch_id"))
    fresh.write.partitionBy("batch_id").parquet(f"{stage}/tables/columns")
    commit_stage(store, stage)


def _by_lower_name(dictionary: DataFrame | Written, key: str) -> DataFrame | Written:
    """A dictionary under its lower-cased names; a written one stays measured."""
    table = dictionary.table if isinstance(dictionary, Written) else dictionary
    renamed = table.select(F.lower(key).alias(f"_{key}"), F.col("idx").alias(f"{key}_idx"))
    return replace(dictionary, table=renamed) if isinstance(dictionary, Written) else renamed


def realign(frame: SparseFrame, columns: DataFrame | Written, targets: DataFrame | Written) -> tuple[DataFrame, DataFrame]:
    """Cells and rows in the store's numbering, by lower-cased name.

    Returns (cells with idx and label idx, ids of rows that lost a cell or whose
    label is unknown). Names are matched once per distinct name.
    """
    cells = frame.cells.withColumn("_term", F.lower("term")).withColumn("_target", F.lower("target"))
    with_terms = lookup_join(cells, _by_lower_name(columns, "term"), ["_term"], "left")
    matched = lookup_join(with_terms, _by_lower_name(targets, "target"), ["_target"], "left").drop("_term", "_target")
    lost = matched.groupBy("row_id").agg(
        F.count(F.when(F.col("term_idx").isNull() | F.col("target_idx").isNull(), 1)).alias("_lost")
    )
    return matched, lost.where("_lost > 0").select("row_id")


def realign_to_store(frame: SparseFrame, columns: DataFrame | Written, targets: DataFrame | Written) -> DataFrame:
    """Only whole rows: (row_id, target_idx, term_idx, value)."""
    matched, lost = realign(frame, columns, targets)
    good = matched.join(lost, "row_id", "left_anti")
    return good.select("row_id", "target_idx", "term_idx", "value")


def match_schema(frame: SparseFrame, columns: DataFrame) -> DataFrame:
    """Rows in another vocabulary; unknown terms are dropped."""
    return lookup_join(frame.cells, columns, ["term"]).select("row_id", "target", "term", "idx", "value")


def validate_realigned(before: DataFrame, after: DataFrame) -> DataFrame:
    """(row_id, term) pairs that realignment lost or invented, over all rows: one sum of +1 and -1 per pair."""
    old = before.select("row_id", F.lower("term").alias("term"), F.lit(1).alias("_n"))
    new = after.select("row_id", F.lower("term").alias("term"), F.lit(-1).alias("_n"))
    left = old.unionByName(new).groupBy("row_id", "term").agg(F.sum("_n").alias("_n")).where("_n <> 0")
    problem = F.when(F.col("_n") > 0, "lost").otherwise("added")
    return left.select("row_id", "term", F.explode(F.array_repeat(problem, F.abs("_n").cast("int"))).alias("problem"))


def validate_store_uuid(batches: DataFrame, identity: DataFrame) -> DataFrame:
    """Whether each batch's uuid equals its store's; both must exceed 10 characters."""
    joined = batches.join(identity.withColumnRenamed("store_uuid", "_own"), "store", "left")
    good = (F.length("batch_uuid") > 10) & (F.length("_own") > 10) & (F.col("batch_uuid") == F.col("_own"))
    return joined.withColumn("accepted", F.coalesce(good, F.lit(False))).drop("_own")


def duplicate_share(incoming_hashes: DataFrame, stored_hashes: DataFrame) -> DataFrame:
    """Share of incoming rows whose hash is already stored, as one row.

    Incoming rows are counted per hash first: one text may be a third of them. The
    stored hashes are cut down to those before they are shuffled, or, if the
    incoming ones are too many to broadcast, to one of each.
    """
    counted = write_table(incoming_hashes.groupBy("row_hash").agg(F.count("*").alias("_n")), "hashes")
    asked = replace(counted, table=counted.table.select("row_hash"))
    known = stored_hashes.select("row_hash")
    if fits_broadcast(asked):
        known = lookup_join(known, asked, ["row_hash"], "left_semi")
    known = known.distinct()
    joined = counted.table.join(known.withColumn("_known", F.lit(True)), "row_hash", "left")
    return joined.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("_n"))), F.lit(0)).alias("n_known"),
    ).withColumn("share", F.coalesce(F.try_divide("n_known", "n_rows"), F.lit(0.0)))


def duplicate_gate(incoming_hashes: DataFrame, stored_hashes: DataFrame, permitted: float) -> bool:
    """True when a batch may enter; a permitted share of 1 or more skips the test, and nothing stored has no duplicates."""
    if permitted >= 1.0 or (permitted >= 0 and stored_hashes.isEmpty()):
        return True
    return duplicate_share(incoming_hashes, stored_hashes).first()["share"] <= permitted


def store_rows(
    frame: SparseFrame,
    columns: DataFrame | Written,
    targets: DataFrame | Written,
    now: Column,
    batch_id: str,
) -> DataFrame:
    """Rows in stored form: index and value arrays, hash (as of ``row_hashes``), time and batch.

    Whole rows only; a row without cells is whole and has empty arrays. Cells are
    gathered once, for the arrays and for the hash.
    """
    matched, _ = realign(frame, columns, targets)
    text = F.concat_ws(":", "term", decimal_text(F.col("value")))
    cell = F.struct(F.col("term"), text.alias("text"), F.col("term_idx").alias("idx"), F.col("value"))
    arrays = matched.groupBy("row_id").agg(
        F.array_sort(F.collect_list(cell)).alias("_c"),
        F.count(F.when(F.col("term_idx").isNull() | F.col("target_idx").isNull(), 1)).alias("_lost"),
    )
    whole = frame.rows.select("row_id", "target").join(arrays, "row_id", "left").where(F.coalesce("_lost", F.lit(0)) == 0)
    numbered = F.array_sort(F.transform("_c", lambda c: F.struct(c["idx"].alias("idx"), c["value"].alias("value"))))
    body = F.concat_ws("|", "target", F.coalesce(F.array_join(F.col("_c.text"), " "), F.lit("")))
    return whole.withColumn("_n", numbered).select(
        "row_id",
        F.lower("target").alias("target"),
        F.coalesce(F.col("_n.idx"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col("_n.value"), F.array().cast("array<double>")).alias("values"),
        F.md5(body).alias("row_hash"),
        now.cast("timestamp").alias("ts"),
        F.lit(batch_id).alias("batch_id"),
    )


def pair_sums(cells: DataFrame) -> list[Column]:
    """Number of the (row_id, term) pairs and sums of two hashes of them: tables with the same pairs have the same sums.

    Others differ in them, but for a chance of 2**-96, so no pair need be shuffled.
    """
    pair = [cells["row_id"], F.lower(cells["term"])]
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*pair).cast("decimal(20,0)")).alias("long"),
        F.sum(F.hash(*pair).cast("decimal(20,0)")).alias("short"),
    ]


def inverted_index(data: DataFrame, columns: DataFrame | Written) -> DataFrame:
    """(term, row, batch) from stored rows."""
    exploded = data.select(F.explode("indices").alias("idx"), "row_id", "ts", "batch_id")
    return lookup_join(exploded, columns, ["idx"]).select("term", "row_id", "ts", "batch_id")


def write_postings(index: DataFrame, path: str, parts: int) -> None:
    """Write a batch's postings so that a term's stand together: ranges of (term, row), sorted, in small row groups.

    Ranges are cut by the row too, so a term of a third of all rows is dealt over many tasks.
    """
    parts = max(parts, index.sparkSession.sparkContext.defaultParallelism)
    dealt = index.repartitionByRange(parts, "term", "row_id").sortWithinPartitions("term", "row_id")
    dealt.write.option("parquet.block.size", POSTINGS_GROUP).parquet(path)


def id_map_rows(data: DataFrame, uid_index: Column) -> DataFrame:
    """Old numeric id, read from the uid column's cell, beside the row id."""
    old = value_at(F.col("indices"), F.col("values"), uid_index)
    return data.select(old.alias("old_id"), "row_id", "ts", "batch_id").where("old_id is not null")


# Fixed value: characters that Spark writes as %XX in the folder of a partition, beside control characters.
ESCAPED = set("\"#%'*/:=?\\\x7f{[]^")


def partition_value(value: str) -> str:
    """The value of a partition column as it stands in its folder's name."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 0x20 else c for c in value)


def drop_batch(store: Store, batch_id: str, tables: tuple[str, ...] = ROW_TABLES) -> None:
    """Remove one batch's rows by removing its partition folders, named as Spark names them."""
    for table in tables:
        folders.drop(store.spark, f"{store.path(table)}/batch_id={partition_value(batch_id)}")


delete_batch = drop_batch


def is_own_uuid(store: Store, batch_uuid: str) -> bool:
    """Whether a batch announces the uuid of this store."""
    batch = store.spark.range(1).select(F.lit(store.name).alias("store"), F.lit(batch_uuid).alias("batch_uuid"))
    return validate_store_uuid(batch, scan(store, "identity")).first()["accepted"]


def is_aligned(frame: SparseFrame) -> bool:
    """Whether the dictionaries that came with a batch name all its terms and labels; without dictionaries it is."""
    terms = frame.columns is None or new_terms(frame.cells, frame.columns).isEmpty()
    return terms and (frame.targets is None or new_terms(frame.rows, frame.targets, "target").isEmpty())


def named_cells(data: DataFrame, columns: DataFrame | Written) -> DataFrame:
    """Stored rows as (row_id, term, value); a number that two names share gives both."""
    long = data.select("row_id", F.inline(F.arrays_zip(F.col("indices").alias("idx"), F.col("values").alias("value"))))
    return lookup_join(long, columns, ["idx"]).select("row_id", "term", "value")


def colliding_names(cells: DataFrame) -> DataFrame:
    """(name, terms): clean names that are empty, or that terms different but for case would share."""
    terms = cells.select(F.lower("term").alias("term")).distinct()
    shared = terms.groupBy(clean_name(F.col("term")).alias("name")).agg(F.count("*").alias("terms"))
    return shared.where((F.col("terms") > 1) | (F.length("name") == 0))


def append_batch(
    store: Store, frame: SparseFrame, batch_id: str, now: Column, batch_uuid: str | None = None
) -> dict:
    """Check a batch, write it beside the store, check that, then put it into place.

    Whatever fails, a stored batch of that id stays as it is until the new one
    stands whole: the announced uuid (if any), the batch's own dictionaries,
    names that collide once cleaned, the share of duplicates, unreadable values,
    and rows that do not come back from the store's numbering as they came. A
    replay is compared with the other batches only. With ``truncate_overwrite``
    the batch takes the place of the whole store, supplement included.
    """
    finish_swaps(store)
    if batch_uuid is not None and not is_own_uuid(store, batch_uuid):
        return {"status": "failed", "error": "The batch is for another store"}
    if not is_aligned(frame):
        return {"status": "failed", "error": "The batch uses names that its dictionaries lack"}
    taken = write_table(frame.cells.select("row_id", "target", "term", "value"), "cells")
    taken_rows = publish(frame.rows.select("row_id", F.lower("target").alias("target")), "rows")
    terms = publish(taken.table.select("term").distinct(), "terms")
    if not colliding_names(terms).isEmpty():
        return {"status": "failed", "error": "Names of the batch collide once they are cleaned"}
    anew = store.config.truncate_overwrite
    known_columns = scan_columns(store).where(F.lit(not anew))
    known_targets = scan_targets(store).where(F.lit(not anew))
    cleaned_terms = terms.select(clean_name(F.col("term")).alias("term"))
    columns = publish(append_dictionary(cleaned_terms, known_columns, "term", "int"), "columns")
    targets = publish(append_dictionary(taken_rows, known_targets, "target", "double"), "targets")
    all_columns = write_table(known_columns.unionByName(columns), "columns")
    all_targets = write_table(known_targets.unionByName(targets), "targets")

    # Rows and cells are dealt by row id once; the sums, numbers, arrays and hashes of a row are made in its task.
    parts = cell_parts(taken.rows)
    cells = (
        taken.table.select("row_id", F.lower("target").alias("target"), clean_name(F.col("term")).alias("term"), "value")
        .repartition(parts, "row_id").groupBy("row_id", "target", "term").agg(F.sum("value").alias("value"))
    )
    came = Observation()
    cleaned = SparseFrame(taken_rows.repartition(parts, "row_id"), cells.observe(came, *pair_sums(cells)))

    stage, folder = new_stage(store), f"batch_id={partition_value(batch_id)}"
    names, rows = (f"{stage}/tables", f"{stage}/tables") if anew else (f"{stage}/names", f"{stage}/batches")
    tag = F.lit(batch_id).alias("batch_id")
    columns.select("term", "idx", tag).write.partitionBy("batch_id").parquet(f"{names}/columns")
    targets.select("target", "idx", tag).write.partitionBy("batch_id").parquet(f"{names}/targets")
    # Straight into the batch's folder: dealing out by a partition column would sort all rows first.
    store_rows(cleaned, all_columns, all_targets, now, batch_id).drop("batch_id").write.parquet(f"{rows}/data/{folder}")
    data = store.spark.read.schema(DATA_SCHEMA).parquet(f"{rows}/data")
    others = scan(store, "data").where(F.lit(False) if anew else F.col("batch_id") != batch_id)
    if not duplicate_gate(data, others, store.config.permitted_duplicates):
        folders.drop(store.spark, stage)
        return {"status": "failed", "error": "Too many duplicate records "}
    stored = named_cells(data, all_columns)
    if stored.agg(*pair_sums(stored)).first().asDict() != came.get:
        folders.drop(store.spark, stage)
        return {"status": "failed", "error": "Rows changed in the numbering of the store"}
    write_postings(inverted_index(data, all_columns).drop("batch_id"), f"{rows}/index/{folder}", parts)
    uid = all_columns.table.where(F.col("term") == store.config.uid_column).agg(F.min("idx").alias("i"))
    id_map_rows(data, uid.scalar()).drop("batch_id").write.parquet(f"{rows}/id_map/{folder}")
    if anew:
        folders.make(store.spark, f"{rows}/supplement")
    commit_stage(store, stage)
    if anew:
        create_empty(store)
    return {"status": "persisted", "error": ""}


def overwrite_store(store: Store, store_uuid: str) -> None:
    """Empty all tables, the supplement too, before a full load."""
    for table in (*BATCH_TABLES, "supplement"):
        folders.drop(store.spark, store.path(table))
    create_store(store, store_uuid)


def evolve_schema(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Union by name; a column either side lacks is null text."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def attach_uuid(supplement: DataFrame, id_map: DataFrame, uid_column: str) -> DataFrame:
    """Row ids for supplement rows by their old id, else a fresh ``…-x`` one.

    Rows without a readable id skip the join: their null key would be one group.
    """
    fresh = F.concat(F.uuid(), F.lit("-x"))
    keyed = supplement.withColumn("old_id", F.col(uid_column).try_cast("double"))
    known = keyed.where("old_id is not null").join(
        id_map.select("old_id", F.col("row_id").alias("_found")), "old_id", "left"
    )
    named = known.withColumn("uuid", F.coalesce("_found", fresh)).drop("_found", "old_id")
    return named.unionByName(keyed.where("old_id is null").drop("old_id").withColumn("uuid", fresh))


def filter_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop("any", subset=keys)


def append_supplement(store: Store, supplement: DataFrame, batch_id: str, now: Column) -> None:
    """Clean names, reject repeated ones, drop null keys, stamp, and put in the place of that batch."""
    check_unique_names(supplement)
    cleaned = filter_null_keys(clean_column_names(supplement), ["uuid", "aa_label"])
    put_supplement(store, cleaned.withColumn("ts", now.cast("timestamp")), batch_id)


def put_supplement(store: Store, stamped: DataFrame, batch_id: str) -> None:
    """Put supplement rows into place under a batch id, in one swap."""
    finish_swaps(store)
    stage = new_stage(store)
    tagged = stamped.withColumn("batch_id", F.lit(batch_id))
    tagged.write.partitionBy("batch_id").parquet(f"{stage}/batches/supplement")
    folders.make(store.spark, f"{stage}/batches/supplement/batch_id={partition_value(batch_id)}")
    commit_stage(store, stage)


def store_row_count(store: Store) -> int:
    return scan(store, "data").count()


def approximate_row_count(df: DataFrame, timeout_ms: int = 1000, confidence: float = 0.95) -> int:
    """A count that may stop early, with Spark's own confidence bound; rows never leave the JVM."""
    part = df.select(F.lit(1).alias("one"))._jdf.toJavaRDD().countApprox(timeout_ms, confidence)
    return round(part.initialValue().mean())
