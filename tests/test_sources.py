"""Round trips through files, the store and its gates."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from termloom.frame import SparseFrame
from termloom.scratch import new_folder, publish, shared_folder
from termloom.sources import cache, ledger, tables
from termloom.sources import store as S
from termloom.sources import triplet as L
from termloom.streaming import ingest, receive
from tests.conftest import frame_of

UUID = "0f8fad5b-d9cb-469f-a165-70867728950e"


def now():
    return F.expr("TIMESTAMP '2024-02-01 00:00:00'")


def cells(df):
    return {(r["row_id"], r["target"], r["term"]): r["value"] for r in df.collect()}


def write_text(spark, lines, label):
    path = new_folder(spark, label)
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    return path


def test_scratch_reads_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.fixture
def three_sets(spark):
    """Three sets that overlap in rows, terms and labels but number them differently."""
    specs = [
        (["1 2:1 3:11 6:4", "2 2:2 3:12 1:7"], ["AAA", "A_RowId", "A_UID", "BBB", "CCC", "DDD"], ["AM1", "AM2", "AM3"]),
        (["1 1:2 2:12 4:3", "3 1:4 2:14 3:2 4:2 5:2 6:2"], ["A_RowId", "A_UID", "DDD", "EEE", "FFF", "GGG"], ["AM2", "AM3", "AM4"]),
        (["1 1:5 2:15 8:9"], ["A_RowId", "A_UID", "DDD", "EEE", "FFF", "GGG", "HHHH", "III"], ["AM8", "AM3", "AM4", "AM2"]),
    ]
    frames = []
    for data, terms, labels in specs:
        paths = [
            write_text(spark, data, "data"),
            write_text(spark, [f"ColumnHeadTuple({i + 1},{t})" for i, t in enumerate(terms)], "columns"),
            write_text(spark, [f"({t},{i + 1}.0)" for i, t in enumerate(labels)], "targets"),
        ]
        frames.append(L.to_frame(L.read_libsvm_triplet(spark, *paths), "A_UID"))
    return frames


def test_merge_is_by_name(three_sets):
    merged = L.merge_sparse_batches(three_sets)
    got = cells(merged.cells.where("term <> 'A_RowId'"))
    assert got == {
        ("11", "AM1", "DDD"): 4.0, ("12", "AM2", "AAA"): 7.0, ("12", "AM2", "EEE"): 3.0,
        ("14", "AM4", "DDD"): 2.0, ("14", "AM4", "EEE"): 2.0, ("14", "AM4", "FFF"): 2.0, ("14", "AM4", "GGG"): 2.0,
        ("15", "AM8", "III"): 9.0,
    }
    assert merged.rows.count() == 4


def test_bad_lines_are_rejected(spark):
    lines = spark.createDataFrame(
        [("1", "1.0 1:1.0  2:2"), ("2", "x 1:1"), ("3", "2 1:y"), ("4", "  "), ("5", "3"), ("6", "1 7")], "row_id string, value string"
    )
    good, bad = L.parse_libsvm(lines)
    assert {r["row_id"]: len(r["cells"]) for r in good.collect()} == {"1": 2, "5": 0}
    assert {r["row_id"] for r in bad.collect()} == {"2", "3", "6"}


def test_triplet_round_trip(spark, small):
    paths = L.write_libsvm_triplet(small, new_folder(spark, "rt"), "a|b?#")
    assert all("a_b__" in p for p in paths.values())
    back = L.to_frame(L.read_libsvm_triplet(spark, paths["data"], paths["columnMap"], paths["targetMap"]))
    assert back.rows.count() == 4
    assert sorted((r["target"], r["term"], r["value"]) for r in back.cells.collect()) == sorted(
        (r["target"], r["term"], r["value"]) for r in small.cells.collect()
    )


def test_number_text(spark):
    df = spark.createDataFrame([(1.0,), (0.1234567,), (1e7,), (0.5,), (100.0,)], "v double")
    assert [r[0] for r in df.select(L.number_text(F.col("v"))).collect()] == ["1", "0.123457", "10000000", "0.5", "100"]


def test_item_properties_last_wins(spark):
    rows = [("1", "p", "s", "k", "old", 1), ("1", "p", "s", "k", "new", 2), ("1", "p", "s", "j", "v", 3)]
    df = spark.createDataFrame(rows, "id string, prompt string, stem string, property string, value string, seq int")
    assert tables.read_item_properties(df).first()["properties"] == {"k": "new", "j": "v"}


def test_header_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A b!", "_x", "-y"])
    assert tables.clean_column_names(df).columns == ["ab", "u_x", "u-y"]
    with pytest.raises(ValueError):
        tables.clean_column_names(spark.createDataFrame([(1, 2)], ["a b", "ab"]))


def new_store(spark, **config):
    store = S.Store(spark, new_folder(spark, "store"), "s", S.StoreConfig(**config))
    S.create_store(store, UUID)
    return store


def test_replay_of_a_batch_changes_nothing(spark, small):
    store = new_store(spark)
    S.append_batch(store, small, "b1", now())
    before = (cells(S.scan_store(store).cells), sorted(map(tuple, S.scan_columns(store).collect())))
    S.append_batch(store, small, "b1", now())
    assert (cells(S.scan_store(store).cells), sorted(map(tuple, S.scan_columns(store).collect()))) == before
    S.delete_batch(store, "b1")
    assert S.store_row_count(store) == 0


def test_second_batch_keeps_old_numbers(spark, small):
    store = new_store(spark)
    S.append_batch(store, small, "b1", now())
    old = {r["term"]: r["idx"] for r in S.scan_columns(store).collect()}
    S.append_batch(store, frame_of(spark, [("n1", "C", "X", 1.0), ("n1", "C", "new", 2.0)]), "b2", now())
    new = {r["term"]: r["idx"] for r in S.scan_columns(store).collect()}
    assert {t: new[t] for t in old} == old and new["new"] == 4 and "X" not in new


def test_postings_stand_together_and_are_pruned(spark, monkeypatch):
    """Files are sorted ranges of terms, row groups of other terms are skipped, and the rows are those of a plain search."""
    monkeypatch.setattr(S, "POSTINGS_GROUP", 4_096)
    some = spark.range(6_000).selectExpr("concat('r', id) AS row_id", "if(id % 2 = 0, 'A', 'B') AS target", "id")
    terms = "explode(array('hot', concat('t', id % 7), concat('u', id % 300), concat('v', id))) AS term"
    wide = frame_of(spark, [])
    wide = wide.with_rows(some.select("row_id", "target"), some.selectExpr("row_id", "target", terms, "1D AS value"))
    store = new_store(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert S.append_batch(store, wide, "b1", now())["status"] == "persisted"
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(f"{store.path('index')}/batch_id=b1/*.parquet")
    ranges, overlapping, groups = [], 0, 0
    for file in files:
        part = pq.read_table(file, columns=["term", "row_id"]).to_pydict()
        pairs = list(zip(part["term"], part["row_id"], strict=True))
        assert pairs == sorted(pairs)
        ranges.append((pairs[0], pairs[-1]))
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(0).statistics
            groups += 1
            overlapping += stats.min <= "u17" <= stats.max
    ranges.sort()
    assert len(files) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert groups > 8 and overlapping <= 2
    plan = S.postings(store, "u17")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,u17)" in plan
    for wanted, label in ((["hot", "t3"], None), (["u17", "hot", "t3"], "b"), (["v5"], None), (["hot", "nowhere"], None), ([], None)):
        found = {r["row_id"] for r in S.scan_store_where(store, wanted, label).collect()}
        rows = {
            f"r{i}" for i in range(6_000)
            if wanted and {"hot", f"t{i % 7}", f"u{i % 300}", f"v{i}"} >= set(wanted) and label in (None, "ab"[i % 2])
        }
        assert found == rows


def test_duplicate_gate_rejects_before_writing(spark, small):
    store = new_store(spark, permitted_duplicates=0.5)
    assert S.append_batch(store, small, "b1", now())["status"] == "persisted"
    assert S.append_batch(store, small, "b2", now())["status"] == "failed"
    assert {r["batch_id"] for r in S.scan(store, "data").collect()} == {"b1"}


def test_row_that_loses_a_cell_is_dropped(spark, small):
    columns = spark.createDataFrame([("X", 1), ("y", 2)], "term string, idx int")
    targets = spark.createDataFrame([("a", 1.0), ("B", 2.0)], "target string, idx double")
    got = S.realign_to_store(small, columns, targets).collect()
    assert sorted((r["row_id"], r["term_idx"]) for r in got) == [("r1", 1), ("r1", 2), ("r2", 1)]


def test_repair_sorts_and_fills_ids(spark):
    df = spark.createDataFrame([(None, [3, 1], [30.0, 10.0]), ("k", [1], [1.0])], "row_id string, indices array<int>, values array<double>")
    rows = {tuple(r["indices"]): r for r in S.repair_rows(df).collect()}
    assert rows[(1, 3)]["values"] == [10.0, 30.0] and len(rows[(1, 3)]["row_id"]) == 36
    assert rows[(1,)]["row_id"] == "k"


def test_uuids_for_known_unknown_and_missing_ids(spark):
    supplement = spark.createDataFrame([("1",), ("2",), (None,), ("bad",)], "a_uid string")
    id_map = spark.createDataFrame([(1.0, "row-1")], "old_id double, row_id string")
    got = {r["a_uid"]: r["uuid"] for r in S.attach_uuid(supplement, id_map, "a_uid").collect()}
    assert got["1"] == "row-1" and all(got[k].endswith("-x") for k in ("2", None, "bad"))


def test_cache_needs_its_stamp(spark):
    with pytest.raises(ValueError):
        cache.check_stamp(spark.createDataFrame([("x",)], "dsctimestamp string"))


def test_cache_expires_only_when_large(spark):
    path = new_folder(spark, "cache")
    cache.ttl_cache_append(spark.createDataFrame([(0,), (100_000_000,)], "dsctimestamp long"), path)
    assert not cache.ttl_cache_clean(spark, path, F.lit(100_000_001), 60)
    assert cache.ttl_cache_clean(spark, path, F.lit(100_000_001), 60, above=1)
    assert cache.ttl_cache_read(spark, path, ttl_minutes=0).count() == 1


def test_cache_never_returns_expired_rows(spark):
    path = new_folder(spark, "cache")
    cache.ttl_cache_append(spark.createDataFrame([(0,), (100_000_000,)], "dsctimestamp long"), path)
    got = cache.ttl_cache_read(spark, path, F.lit(100_000_001), 60).collect()
    assert [r["dsctimestamp"] for r in got] == [100_000_000]


def test_names_outlive_their_batch(spark):
    first = frame_of(spark, [("r1", "A", "x", 1.0), ("r1", "A", "y", 2.0)])
    second = frame_of(spark, [("r2", "A", "x", 3.0), ("r2", "A", "z", 4.0)])
    store = new_store(spark)
    for frame, name in ((first, "day:1 a"), (second, "day:2 a"), (first, "day:1 a")):
        assert S.append_batch(store, frame, name, now())["status"] == "persisted"
    left = {("r2", "a", "x"): 3.0, ("r2", "a", "z"): 4.0}
    assert cells(S.scan_store(store).cells) == left | {("r1", "a", "x"): 1.0, ("r1", "a", "y"): 2.0}
    S.delete_batch(store, "day:1 a")
    assert cells(S.scan_store(store).cells) == left


@pytest.mark.parametrize("max_files", [None, 1])
def test_batches_are_whole_however_files_are_dealt(spark, max_files):
    drop, book, state = (new_folder(spark, x) for x in ("drop", "ledger", "state"))
    store = S.Store(spark, new_folder(spark, "store"), "s")

    def arrive(*ids):
        for i in ids:
            row = [("b1", f"r{i}", "A", "x", float(i))]
            spark.createDataFrame(row, ingest.CELL_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(drop)
        receive.drain(ingest.stream_ingest(ingest.stream_cells(spark, drop, max_files), store, UUID, book, state, now()))

    arrive(1, 2, 3)
    assert cells(S.scan_store(store).cells) == {(f"r{i}", "a", "x"): float(i) for i in (1, 2, 3)}
    arrive(4)
    assert cells(S.scan_store(store).cells) == {(f"r{i}", "a", "x"): float(i) for i in (1, 2, 3, 4)}


@pytest.mark.parametrize("max_files", [None, 1])
def test_lines_are_routed_by_data_set(spark, max_files):
    inbox, out, state = (new_folder(spark, x) for x in ("inbox", "out", "state"))
    for value in ("a,1", "DATA_NAME=d1", "DATA_STORE=st", "a,2", "STORE_UUID=u1", "END_STREAM", "a,3"):
        spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("append").text(f"{inbox}/one")
    spark.createDataFrame([("b,1",)], "value string").write.text(f"{inbox}/open")
    receive.drain(receive.stream_route(receive.stream_lines(spark, inbox, max_files), out, state))
    got = spark.read.option("basePath", out).parquet(f"{out}/epoch=*").select("route", "value").collect()
    assert sorted(map(tuple, got)) == [("data", "a,1"), ("data", "a,2"), ("data", "a,3")]
    assert [r["value"] for r in receive.waiting_lines(spark, state).collect()] == ["b,1"]


def test_one_bad_batch_does_not_stop_the_others(spark):
    drop, book = new_folder(spark, "drop"), new_folder(spark, "ledger")
    rows = [("b1", "r1", "A", "x", 1.0), ("b2", "r1", "A", "x", 1.0), ("b3", "r2", "B", "y", 2.0)]
    spark.createDataFrame(rows, ingest.CELL_STREAM_SCHEMA).write.parquet(drop)
    store = S.Store(spark, new_folder(spark, "store"), "s", S.StoreConfig(permitted_duplicates=0.5))
    state = new_folder(spark, "state")
    for _ in range(2):  # the second run finds nothing new
        receive.drain(ingest.stream_ingest(ingest.stream_cells(spark, drop), store, UUID, book, state, now()))
    entries = {r["batch_id"]: (r["status"], r["error_code"]) for r in ledger.read_ledger(spark, book).collect()}
    assert entries == {"b1": ("persisted", ""), "b2": ("failed", "duplicate-"), "b3": ("persisted", "")}
    assert S.store_row_count(store) == 2


def test_promotion_waits_then_moves_once(spark, small):
    staging = new_store(spark, flush=True, flush_threshold=4, trim=False)
    S.append_batch(staging, small, "b1", now())
    final = S.Store(spark, new_folder(spark, "store"), "final")
    book = new_folder(spark, "ledger")
    assert ingest.promote_staging(staging, final, UUID, book, "p1", now()) == "waiting"  # four rows staged, r4 without cells
    assert ingest.promote_staging(staging, final, UUID, book, "p1", now(), force=True) == "promoted"
    assert (S.store_row_count(staging), S.store_row_count(final)) == (0, 4)
    assert ingest.promote_staging(staging, final, UUID, book, "p1", now(), force=True) == "waiting"


def test_failed_promotion_keeps_staging(spark, small):
    staging = new_store(spark, flush=True, trim=False)
    S.append_batch(staging, small, "b1", now())
    final = S.Store(spark, new_folder(spark, "store"), "final", S.StoreConfig(permitted_duplicates=0.1))
    S.create_store(final, UUID)
    S.append_batch(final, small, "b0", now())
    book = new_folder(spark, "ledger")
    assert ingest.promote_staging(staging, final, UUID, book, "p1", now(), force=True) == "failed"
    assert S.store_row_count(staging) == 4


def test_promotion_keeps_to_the_settings(spark, small):
    final, book = S.Store(spark, new_folder(spark, "store"), "final"), new_folder(spark, "ledger")
    held = new_store(spark, trim=False)
    S.append_batch(held, small, "b1", now())
    assert ingest.promote_staging(held, final, UUID, book, "p1", now(), force=True) == "off"
    waits = S.Store(spark, held.root, held.name, S.StoreConfig(flush=True, trim=False, supplement=True))
    assert ingest.promote_staging(waits, final, UUID, book, "p1", now(), force=True) == "waiting"
    notes = spark.createDataFrame([("r1", "A", "note")], "uuid string, aa_label string, remark string")
    S.create_supplement(waits, notes)
    assert ingest.promote_staging(waits, final, UUID, book, "p1", now(), force=True) == "waiting"
    S.append_supplement(waits, notes, "b1", now())
    assert ingest.promote_staging(waits, final, UUID, book, "p1", now(), force=True) == "promoted"
    assert S.scan(final, "supplement").count() == 1


def test_foreign_and_misaligned_batches_change_nothing(spark, small):
    store = new_store(spark)
    assert S.append_batch(store, small, "b1", now(), UUID)["status"] == "persisted"
    before = cells(S.scan_store(store).cells)
    assert S.append_batch(store, small, "b1", now(), "another-store-uuid")["status"] == "failed"
    few = spark.createDataFrame([("x", 1)], "term string, idx int")
    misaligned = SparseFrame(small.rows, small.cells, few)
    assert S.append_batch(store, misaligned, "b1", now(), UUID)["status"] == "failed"
    assert cells(S.scan_store(store).cells) == before


def test_scans_agree_on_missing_ids_and_miss_no_name(spark, small):
    store = new_store(spark)
    S.append_batch(store, small, "b1", now())
    twin = S.scan(store, "data").where("row_id = 'r1'").withColumn("row_id", F.lit(""))
    publish(twin.unionByName(twin), "twins").write.mode("append").partitionBy("batch_id").parquet(store.path("data"))
    first, second = (sorted(r["row_id"] for r in S.scan_store(store).rows.collect()) for _ in range(2))
    assert first == second and len(set(first)) == 6
    nameless = S.scan(store, "data").where("row_id = 'r1'").withColumn("indices", F.array(F.lit(99))).withColumn("values", F.array(F.lit(1.0)))
    publish(nameless, "nameless").write.mode("append").partitionBy("batch_id").parquet(store.path("data"))
    with pytest.raises(Exception, match="No name for column 99"):
        S.scan_store(store).cells.collect()


def test_unknown_labels_and_indices_are_rejected(spark):
    paths = [
        write_text(spark, ["1 1:5", "7 1:5", "1 1:2 9:3"], "data"),
        write_text(spark, ["ColumnHeadTuple(1,x)"], "columns"),
        write_text(spark, ["(A,1.0)"], "targets"),
    ]
    parsed = L.read_libsvm_triplet(spark, *paths)
    assert sorted(r["line"] for r in parsed.rejects.collect()) == ["1 1:2 9:3", "7 1:5"]
    frame = L.to_frame(parsed)
    assert (frame.rows.count(), frame.cells.count()) == (1, 1)


def test_merge_takes_the_first_of_two_values_and_labels(spark):
    sets = [frame_of(spark, [("r", "A", "x", 1.0)]), frame_of(spark, [("r", "B", "x", 5.0), ("r", "B", "y", 2.0)])]
    merged = L.merge_sparse_batches(sets)
    assert cells(merged.cells) == {("r", "A", "x"): 1.0, ("r", "A", "y"): 2.0} and merged.rows.count() == 1


def test_triplet_lines_are_parsed_once(spark, tmp_path):
    """Good lines and rejects are read back from a written table, however many passes go over them."""
    spark.createDataFrame([("1 3:2.5",), ("bad",)], "value string").write.text(f"{tmp_path}/lines")
    good, bad = L.parse_libsvm(spark.read.text(f"{tmp_path}/lines").withColumn("row_id", F.lit("r")))
    assert (good.count(), bad.first()["line"]) == (1, "bad")
    assert not [f for part in (good, bad) for f in part.inputFiles() if f"{tmp_path}/lines" in f]


def test_the_order_store_shuffles_its_cells_once(spark, monkeypatch):
    """Lines, orders and status are dealt by row; the cells made of them stay where they are until they are written."""
    from termloom import frame
    from workload import fixtures

    monkeypatch.setattr(frame, "CELLS_PART", 1000)
    plans = {}

    def noted(df, label, *more):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()  # the last one: cells
        return publish(df, label, *more)

    monkeypatch.setattr(fixtures, "publish", noted)
    store = fixtures.order_store.__wrapped__(spark, "/root/testdata/sf0.001")
    assert plans["by-status"].count("Exchange hashpartitioning(") == 3
    assert {r["batch_id"] for r in S.scan(store, "data").select("batch_id").distinct().collect()} == {"batch-f", "batch-op"}
    cells = S.scan_store(store).cells
    assert cells.where("term = 'a_uid'").count() == S.scan(store, "data").count()


def test_streamed_order_cells_are_shuffled_once(spark, monkeypatch):
    """Nothing above the union of cells and ids deals them out again to learn their batch."""
    from pyspark.sql import DataFrameWriter

    from termloom import frame
    from workload import streams

    class Noted(Exception):
        pass

    def noted(self, path, *more):
        raise Noted(self._df._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(frame, "CELLS_PART", 1000)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.raises(Noted) as told:
            streams.streamed.__wrapped__(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Union" in str(told.value) and "Exchange" not in str(told.value).split("Union")[0]
