"""Swaps of the store, the ingest cycle, and what interruptions leave."""

import pytest
from pyspark.sql import functions as F

from termloom.sources import folders, ledger
from termloom.sources import store as S
from termloom.sources.batches import list_files
from termloom.streaming import ingest, receive
from tests.conftest import frame_of

UUID = "0f8fad5b-d9cb-469f-a165-70867728950e"


def now():
    return F.expr("TIMESTAMP '2024-02-01 00:00:00'")


def cells_of(store):
    return sorted(map(tuple, S.scan_store(store).cells.select("row_id", "target", "term", "value").collect()))


@pytest.fixture
def stored(spark, tmp_path):
    store = S.Store(spark, str(tmp_path), "st")
    S.create_store(store, UUID)
    S.append_batch(store, frame_of(spark, [("r1", "A", "x", 1.0), ("r2", "B", "y", 2.0)]), "b1", now())
    S.append_batch(store, frame_of(spark, [("r3", "A", "x", 3.0)]), "b:2", now())
    return store


def test_failure_while_staging_keeps_the_old_batch(spark, stored, monkeypatch):
    before = cells_of(stored)
    monkeypatch.setattr(S, "commit_stage", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        S.append_batch(stored, frame_of(spark, [("r1", "A", "z", 9.0)]), "b1", now())
    assert cells_of(stored) == before


def test_interrupted_swap_is_finished_by_the_next_writer(spark, stored, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(S, "finish_swaps", lambda store: None)
        S.append_batch(stored, frame_of(spark, [("r1", "A", "z", 9.0)]), "b1", now())
    assert ("r1", "a", "z", 9.0) not in cells_of(stored)
    S.finish_swaps(stored)
    assert cells_of(stored) == [("r1", "a", "z", 9.0), ("r3", "a", "x", 3.0)]
    S.finish_swaps(stored)
    assert cells_of(stored) == [("r1", "a", "z", 9.0), ("r3", "a", "x", 3.0)]
    assert [n for n in folders.names(spark, stored.path(S.SWAPS)) if n.startswith(S.READY)] == []


def test_replay_without_rows_empties_the_batch(spark, stored):
    S.append_batch(stored, frame_of(spark, [], [("r9", "A")]), "b:2", now())
    assert cells_of(stored) == [("r1", "a", "x", 1.0), ("r2", "b", "y", 2.0)]
    assert S.scan(stored, "data").where("batch_id = 'b:2'").select("row_id").first()["row_id"] == "r9"


def test_names_that_collide_or_vanish_are_refused(spark, stored):
    for terms in (("é", "ß"), ("a#", "a?"), ("é", "ok")):
        result = S.append_batch(stored, frame_of(spark, [("r8", "A", t, 1.0) for t in terms]), "b3", now())
        assert result["status"] == "failed" and "collide" in result["error"]
    assert S.append_batch(stored, frame_of(spark, [("r8", "A", "Q", 1.0), ("r8", "A", "q", 2.0)]), "b3", now())["status"] == "persisted"
    assert ("r8", "a", "q", 3.0) in cells_of(stored)


def test_cells_of_a_batch_are_shuffled_once_to_be_stored(spark, stored, monkeypatch):
    """Sums, numbers, arrays and hashes of a row are made where its cells were dealt to, in parts of bounded size."""
    plans, whole = [], S.store_rows
    monkeypatch.setattr("termloom.frame.CELLS_PART", 2)

    def seen(*given):
        made = whole(*given)
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        return made

    monkeypatch.setattr(S, "store_rows", seen)
    frame = frame_of(spark, [("r4", "A", "x", 1.0), ("r4", "A", "X", 2.0), *((f"s{i}", "B", "w", 2.0) for i in range(20))])
    assert S.append_batch(stored, frame, "b4", now())["status"] == "persisted"
    assert plans and "ENSURE_REQUIREMENTS" not in plans[0] and plans[0].count("REPARTITION_BY_NUM") == 2
    assert {("r4", "a", "x", 3.0), ("s9", "b", "w", 2.0)} <= set(cells_of(stored))


def test_signed_difference_keeps_multiplicities(spark):
    old = spark.createDataFrame([("r", "a"), ("r", "a"), ("r", "b"), ("s", "c")], "row_id string, term string")
    new = spark.createDataFrame([("r", "A"), ("s", "c"), ("s", "d"), ("s", "d")], "row_id string, term string")
    got = sorted(map(tuple, S.validate_realigned(old, new).collect()))
    assert got == [("r", "a", "lost"), ("r", "b", "lost"), ("s", "d", "added"), ("s", "d", "added")]


def announced(spark, path):
    def batch(name, kind, rows, uuid=UUID, short=0, modified="2024-01-31 23:00:00"):
        return [(name, kind, uuid, len(rows) + short, modified, *r) for r in rows]

    data = [(f"r{i}", "A" if i % 2 else "B", f"t{i % 3}", float(i + 1), None, None, None) for i in range(12)]
    texts = [(None, None, None, None, f"u{i}", "A", f"text {i}") for i in range(5)]
    rows = [
        *batch("one", "data", data[:5]), *batch("two", "data", data[5:9]), *batch("foreign", "data", data[9:10], "another store's uuid"),
        *batch("text", "supplement", texts), *batch("late", "data", data[10:11], short=1, modified="2024-01-01 00:00:00"), *batch("open", "data", data[11:], short=1),
    ]
    table = spark.createDataFrame([(*r[:4], None, *r[5:]) for r in rows], ingest.CYCLE_SCHEMA)
    when = spark.createDataFrame([(r[0], r[4]) for r in rows], "batch_id string, at string").distinct()
    stamped = table.join(when, "batch_id").withColumn("modified", F.col("at").cast("timestamp")).drop("at")
    stamped.select(table.columns).repartition(4, F.rand(3)).write.parquet(path)
    return data


def cycle_in(spark, root, threshold=0):
    config = S.StoreConfig(flush=True, trim=False, flush_threshold=threshold, archive=True)
    return ingest.Cycle(S.Store(spark, root, "staging", config), S.Store(spark, root, "final"), UUID, f"{root}/book", f"{root}/landed", f"{root}/done", 86_400_000)


def everywhere(cycle):
    """Cells and supplement rows in both stores: what was promoted and what waits."""
    cells, texts = [], []
    for store in (cycle.staging, cycle.final):
        if S.store_exists(store):
            cells += cells_of(store)
        if S.store_exists(store, "supplement"):
            texts += [r["uuid"] for r in S.scan_supplement(store).collect()]
    return sorted(cells), sorted(texts)


def test_a_cycle_gives_the_same_rows_however_files_are_dealt(spark, tmp_path):
    data = announced(spark, str(tmp_path / "in"))
    want = sorted((r, t.lower(), term, v) for r, t, term, v, *_ in data[:9])
    for files in (None, 1):
        cycle = cycle_in(spark, str(tmp_path / f"run{files}"))
        stream = ingest.stream_cells(spark, str(tmp_path / "in"), files, ingest.CYCLE_SCHEMA)
        receive.drain(ingest.stream_cycle(stream, cycle, str(tmp_path / f"state{files}"), now()))
        assert everywhere(cycle) == (want, [f"u{i}" for i in range(5)])
        book = {r["batch_id"]: r["status"] for r in ledger.latest_status(ledger.read_ledger(spark, cycle.ledger_path)).collect()}
        assert {b: book[b] for b in ("one", "two", "foreign", "late", "open")} == {
            "one": "promoted", "two": "promoted", "foreign": "failed", "late": "late", "open": "arrived"
        }
        assert folders.names(spark, cycle.landing) == ["batch_id=open"]
        places = {r[0].split("/done/")[1].rsplit("/batch_id=", 1)[0] for r in list_files(spark, cycle.done).select("path").collect()}
        assert places == {"persisted", "late", "failed/Thebatchisforanother"}


def test_an_interrupted_promotion_is_repeated_without_repeats(spark, tmp_path, monkeypatch):
    announced(spark, str(tmp_path / "in"))
    micro = spark.read.schema(ingest.CYCLE_SCHEMA).parquet(str(tmp_path / "in"))
    cycle = cycle_in(spark, str(tmp_path / "run"))
    S.create_store(cycle.staging, UUID)
    ledger.create_ledger(spark, cycle.ledger_path)
    with monkeypatch.context() as broken:
        broken.setattr(ingest, "overwrite_store", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ingest.run_cycle(micro, 0, cycle, now())
    once = cells_of(cycle.final)
    ingest.run_cycle(micro, 0, cycle, now())
    assert cells_of(cycle.final) == once and len(once) == 9 and cells_of(cycle.staging) == []
    assert S.scan_supplement(cycle.final).count() == 5
    assert ledger.statuses_of(spark, cycle.ledger_path, ["one", "text"]) == {"one": "promoted", "text": "promoted"}
