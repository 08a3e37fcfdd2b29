"""Phrases, clusters, classification and assessments on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from termloom.operators import assessment as A
from termloom.operators import classify, clusters, grouped, phrases, ranking
from termloom.operators.columns import remove_columns, remove_high_frequency, term_table
from tests.conftest import frame_of


@pytest.fixture(scope="module")
def two_topics(spark):
    cells = []
    for i in range(40):
        words = ("sun", "sea", "sand") if i % 2 else ("code", "test", "bug")
        cells += [(f"r{i}", "beach" if i % 2 else "work", w, 1.0 + (i + j) % 3) for j, w in enumerate(words)]
        cells.append((f"r{i}", "beach" if i % 2 else "work", "common", 1.0))
    return frame_of(spark, cells)


def test_kmeans_separates_and_cost_falls_with_k(spark, two_topics):
    data = clusters.vectors(two_topics)
    two, four = (clusters.kmeans_fit(data, k, 10, 2) for k in (2, 4))
    assert four.summary.trainingCost < two.summary.trainingCost
    found = two.transform(data.rows).groupBy("target").agg(F.countDistinct("prediction").alias("n")).collect()
    assert all(r["n"] == 1 for r in found)


def test_vectors_hold_the_cells(two_topics):
    data = clusters.vectors(two_topics)
    names = {r["idx"]: r["term"] for r in data.columns.collect()}
    row = data.rows.where("row_id = 'r1'").first()
    want = {(r["term"], r["value"]) for r in two_topics.cells.where("row_id = 'r1'").collect()}
    assert {(names[int(i)], v) for i, v in zip(row["features"].indices, row["features"].values)} == want


@pytest.mark.parametrize("method", ["kmeans", "lda"])
def test_frequent_terms_of_one_label_are_stop_words_for_all(two_topics, method):
    """A term too frequent under one label goes there, and no clustering reports it, whatever the label."""
    cells = two_topics.cells.union(two_topics.spark.sql(
        "SELECT concat('r', id) AS row_id, if(id % 2 = 1, 'beach', 'work') AS target, 'mixed' AS term, 9D AS value FROM range(40) WHERE id % 2 = 1 OR id % 8 = 0"
    ))
    frame = two_topics.with_cells(cells.where("term <> 'common'"))
    less = remove_high_frequency(remove_high_frequency(frame, 70, ["target"]), 100)
    frequent = {r["term"] for r in less.frequent.collect()}
    held = {(r["target"], r["term"]) for r in less.cells.select("target", "term").distinct().collect()}
    gone = {t for t in frequent if any(term == t for _, term in held)}
    assert gone == {t for t in frequent if t == "mixed"} and remove_columns(less, term_table(frame.spark, ["sun"])).frequent is less.frequent
    settings = clusters.CycleSettings(k=2, iterations=3, init_steps=2, top_terms=8, max_rounds=1)
    whole = (clusters.kmeans_trim_cycle if method == "kmeans" else clusters.lda_trim_cycle)(less, settings)
    reported = {r["term"] for r in whole.union(clusters.cycle_by_target(less, method, settings)).collect()}
    assert reported and not reported & frequent


def test_trim_cycle_reports_known_terms(two_topics):
    settings = clusters.CycleSettings(k=2, iterations=5, init_steps=2, top_terms=3, spread=0, max_rounds=3)
    report = clusters.kmeans_trim_cycle(two_topics, settings)
    vocabulary = {r["term"] for r in two_topics.cells.select("term").distinct().collect()}
    assert {r["term"] for r in report.collect()} <= vocabulary
    assert max(r["n"] for r in report.groupBy("iteration", "cluster").agg(F.count("*").alias("n")).collect()) <= 3


def test_lda_needs_more_than_ten_rows(spark):
    tiny = frame_of(spark, [(f"r{i}", "A", "x", 1.0) for i in range(10)])
    assert clusters.lda_fit(clusters.vectors(tiny), 2) is None


def test_last_iteration_keeps_the_middle_of_long_runs(spark):
    rows = [(t, i, "c", "w", 1.0) for t, top in (("A", 9), ("B", 8)) for i in range(top + 1)]
    df = spark.createDataFrame(rows, "target string, iteration int, cluster string, term string, value double")
    got = {(r["target"], r["iteration"]) for r in phrases.last_iteration_terms(df).collect()}
    assert got == {("A", 9), ("A", 4), ("B", 8)}


def test_pair_sentences_respect_the_label(spark, small):
    top = [("A", "c1", "x", 2.0, 1), ("A", "c1", "y", 1.0, 2), ("ALL", "c2", "y", 2.0, 1), ("ALL", "c2", "z", 1.0, 2), ("A", "c3", "y", 2.0, 1), ("A", "c3", "z", 1.0, 2)]
    df = spark.createDataFrame(top, "target string, cluster string, term string, value double, rank long")
    got = phrases.term_pair_sentences(small.cells, phrases.term_pairs(df)).collect()
    assert {(r["row_id"], r["cluster"], r["term1"], r["term2"]) for r in got} == {("r1", "c1", "x", "y"), ("r3", "c2", "y", "z")}


def test_svm_tells_labels_apart(spark, two_topics):
    models = classify.svm_one_vs_rest(two_topics, 10)
    scored = classify.svm_predict(two_topics.cells, models, phrases.row_names(two_topics.cells))
    rows = scored.join(two_topics.rows, "row_id").collect()
    assert set(models) == {"beach", "work"}
    assert all((r["prediction"] == 1) == (r["code"] == r["target"]) for r in rows)


def test_svm_scores_rows_of_another_vocabulary(spark, two_topics):
    models = classify.svm_one_vs_rest(two_topics, 10)
    shown = F.when(F.col("term") == two_topics.cells.agg(F.max("term")).first()[0], "Zzz").otherwise(F.col("term"))
    other = two_topics.cells.withColumn("term", shown)
    scored = classify.svm_predict(other, models, phrases.row_names(other))
    assert {r["code"] for r in scored.collect()} == set(models)


def test_sides_are_balanced(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("row_id"), (F.col("id") < 10).cast("double").alias("label"))
    assert {r["label"]: r["count"] for r in classify.balance_sides(rows).groupBy("label").count().collect()} == {0.0: 10, 1.0: 10}


@pytest.mark.parametrize("part_rows", [ranking.SMALL_GROUP, 2])
def test_auc_against_brute_force(spark, monkeypatch, part_rows):
    monkeypatch.setattr(ranking, "SMALL_GROUP", part_rows)
    data = [(1, 7.5), (0, 7.5), (1, 0.4), (0, 0.1), (0, 0.35), (1, 1.0), (0, -3.0), (1, -4.0)]
    wins = [1.0 if p > n else 0.5 if p == n else 0.0 for a, p in data if a for b, n in data if not b]
    got = classify.evaluate_auc(spark.createDataFrame(data, "label int, score double")).first()["auc"]
    assert got == pytest.approx(sum(wins) / len(wins))


def test_multiclass_matches_sparks_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    data = [(float(i % 3), float((i * i) % 4 % 3)) for i in range(50)]
    df = spark.createDataFrame(data, "label double, prediction double")
    got = classify.evaluate_multiclass(df).first().asDict()
    names = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "f1": "f1"}
    for ours, theirs in names.items():
        assert got[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))


def test_score_names(spark):
    headings = spark.createDataFrame([(0, "a", "1"), (1, "b", "2"), (2, "c", "3"), (3, "d", "9")], "position int, heading string, item_id string")
    items = spark.createDataFrame(
        [("1", "cet_R01_Likert", "Accounting"), ("2", "cet_R03_Ipsative", "Law"), ("3", "cet_R01_Likert", "Accounting")],
        "item_id string, item_type string, major string",
    )
    got = {r["heading"]: r["var_name"] for r in A.rename_score_columns(headings, items).collect()}
    assert got == {"a": "l1accng1", "b": "f3law1", "c": "l1accng2"}


def test_scores_and_ties(spark):
    wide = spark.createDataFrame([("1", "3", "1", "3"), ("2", "-1", "0", None), ("3", "3", "1", "0")], "A_RowId string, l1bbb1 string, f2aaa1 string, l1ccc1 string")
    scores = A.weighted_scores(A.long_answers(wide))
    choice = {r["A_RowId"]: (r["final_choice"], r["top_score"]) for r in A.top_choice(scores).collect()}
    assert choice == {"1": ("aaa", 3.0), "2": ("", 0.0), "3": ("aaa", 3.0)}


def test_average_counts_only_valid_answers(spark):
    long = spark.createDataFrame([("1", "l1a1", 3.0), ("1", "l1b1", 1.0), ("1", "l1c1", 4.0), ("1", "l2a1", -1.0)], "A_RowId string, item string, value double")
    got = {r["item"]: (r["average"], r["deviation"]) for r in A.deviation_from_row_average(long).collect()}
    assert got == {"l1a1": (2.0, 1.0), "l1b1": (2.0, -1.0), "l1c1": (2.0, 2.0), "l2a1": (-9999.0, -9999.0)}


def test_heading_rules():
    heads = {"1": "What is your gender?", "2": "Short one?"}
    assert A.demographic_heading("182025_1_response_0", heads) == "whatisyourgender"
    assert A.demographic_heading("182025_2_response_0", heads) == "shortone"
    assert A.demographic_heading("A_RowId", heads) == "A_RowId"


def test_registered_cycles_have_no_round_cap(spark, monkeypatch):
    from workload import QUERIES, models, streams

    asked = []

    def seen(*args, **kwargs):
        asked.extend(x for x in (*args, *kwargs.values()) if isinstance(x, clusters.CycleSettings))
        raise InterruptedError

    for name in ("cycle_by_target", "reduce_by_clustering", "reduce_by_clustering_by_target"):
        monkeypatch.setattr(models.K, name, seen)
    for name in ("phrases_kmeans", "phrases_lda"):
        monkeypatch.setattr(streams.presets, name, seen)
    names = ["kmeans_by_target", "lda_by_target", "reduce_by_clustering", "reduce_by_clustering_by_target", "preset_phrases_kmeans", "preset_phrases_lda"]
    for name in names:
        with pytest.raises(InterruptedError):
            QUERIES[name](spark, "/root/testdata/sf0.001")
    assert [x.max_rounds for x in asked] == [None] * len(names)


def plain_kmeans(rows, starts, rounds):
    """Lloyd's rounds over dense rows, the first of equally near centres."""
    centres = [list(s) for s in starts]
    for _ in range(rounds):
        near = [min(range(len(centres)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(r, centres[j], strict=True)), j)) for r in rows]
        for j in range(len(centres)):
            own = [r for r, n in zip(rows, near, strict=True) if n == j]
            if own:
                centres[j] = [sum(x) / len(own) for x in zip(*own, strict=True)]
    return centres


def test_kmeans_of_all_labels_equals_each_label_alone(spark):
    rng = random.Random(3)
    terms = ["a", "b", "c", "d"]
    data = {t: [[float(rng.randint(0, 6)) for _ in terms] for _ in range(n)] for t, n in (("X", 40), ("Y", 25), ("Z", 3))}
    cells = [(f"{t}{i}", t, w, v) for t, rows in data.items() for i, r in enumerate(rows) for w, v in zip(terms, r, strict=True) if v]
    table = spark.createDataFrame(cells, "row_id string, target string, term string, value double")
    starts = {t: [r for r in rows if any(r)][:3] for t, rows in data.items()}
    first = [(t, j, w, v) for t, s in starts.items() for j, r in enumerate(s) for w, v in zip(terms, r, strict=True) if v]
    got = grouped.grouped_kmeans(table, 3, 30, starts=spark.createDataFrame(first, grouped.CENTRES_SCHEMA)).collect()
    found = {(r["target"], r["cluster"], r["term"]): r["value"] for r in got}
    for t, rows in data.items():
        for j, centre in enumerate(plain_kmeans([r for r in rows if any(r)], starts[t], 30)):
            for w, v in zip(terms, centre, strict=True):
                assert found.get((t, j, w), 0.0) == pytest.approx(v, abs=1e-9)


def test_starts_are_distinct_rows(spark, two_topics):
    cells = two_topics.cells.unionByName(spark.createDataFrame([("s1", "same", "x", 1.0), ("s2", "same", "x", 1.0)], two_topics.cells.schema))
    starts = grouped.spread_starts(cells, 3).groupBy("target", "cluster").agg(F.sort_array(F.collect_list(F.struct("term", "value"))).alias("row")).collect()
    by_label = {t: [r["row"] for r in starts if r["target"] == t] for t in ("beach", "work", "same")}
    assert {t: len(rows) for t, rows in by_label.items()} == {"beach": 3, "work": 3, "same": 1}
    assert all(len({str(r) for r in rows}) == len(rows) for rows in by_label.values())


def test_cycle_of_all_labels(spark, two_topics):
    settings = clusters.CycleSettings(k=2, iterations=5, top_terms=3, spread=0)
    report = clusters.cycle_by_target(two_topics, "kmeans", settings).collect()
    own = {t: {r["term"] for r in two_topics.cells.where(F.col("target") == t).select("term").distinct().collect()} for t in ("beach", "work")}
    assert all(r["term"] in own[r["target"]] for r in report)
    for t in own:
        rounds = sorted({r["iteration"] for r in report if r["target"] == t})
        assert rounds == list(range(len(rounds)))
        for i in rounds:
            terms = [r["term"] for r in report if r["target"] == t and r["iteration"] == i]
            wide = {w for w in terms if terms.count(w) > 1}
            assert bool(wide) == (i < rounds[-1])
            assert not wide & {r["term"] for r in report if r["target"] == t and r["iteration"] > i}
    empty = two_topics.with_rows(two_topics.rows.limit(0), two_topics.cells.limit(0))
    assert clusters.cycle_by_target(empty, "kmeans", settings).count() == 0
    assert clusters.cycle_by_target(empty, "lda", settings).count() == 0


def test_second_tier_takes_every_cluster(spark, two_topics):
    mined = [("ALL", "0", f"r{i}") for i in range(30)] + [("beach", "1", f"r{i}") for i in range(8, 32)] + [("work", "0", "r2")]
    phrases_found = spark.createDataFrame(mined, "cluster_target string, cluster string, row_id string")
    report = clusters.second_tier_clusters(two_topics, phrases_found, min_rows=10).collect()
    assert {(r["target"], r["parent"]) for r in report} == {("ALL", "0"), ("beach", "1")}
    # a word that all sentences of a group hold weighs nothing there
    assert {r["term"] for r in report} == {"sun", "sea", "sand", "code", "test", "bug"}


def test_jobs_do_not_grow_with_the_labels(spark):
    def jobs(labels):
        cells = [(f"{t}-{i}", f"t{t}", w, float(1 + (i * 7 + j) % 5)) for t in range(labels) for i in range(6) for j, w in enumerate("abc")]
        table = spark.createDataFrame(cells, "row_id string, target string, term string, value double")
        spark.sparkContext.setJobGroup(f"labels-{labels}", "")
        grouped.grouped_kmeans(table, 2, 1).collect()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"labels-{labels}"))

    try:
        assert abs(jobs(40) - jobs(4)) <= 3
    finally:
        spark.sparkContext.setJobGroup("tests", "")


def _gini_tree(rows, depth):
    """Plain recursion: [(level, term, cut)] over rows of ({term: value}, label)."""
    def impurity(part):
        return 1 - sum((sum(1 for _, y in part if y == k) / len(part)) ** 2 for k in {y for _, y in part})

    def grow(part, level):
        if level == depth or impurity(part) == 0:
            return []
        found = []
        for term in sorted({t for x, _ in part for t in x}):
            for cut in sorted({x[term] for x, _ in part if term in x}):
                right = [p for p in part if p[0].get(term, 0) >= cut]
                left = [p for p in part if p[0].get(term, 0) < cut]
                if left and right:
                    gain = len(part) * impurity(part) - len(left) * impurity(left) - len(right) * impurity(right)
                    found.append((round(gain, 9), -term, -cut, left, right))
        if not found or (best := max(found, key=lambda f: f[:3]))[0] <= 0:
            return []
        return [(level, -best[1], -best[2]), *grow(best[3], level + 1), *grow(best[4], level + 1)]

    return sorted(grow(rows, 0))


def _random_rows(n, size, labels):
    import random

    r = random.Random(3)
    rows = []
    for _ in range(n):
        x = {t: float(r.randint(1, 4)) for t in r.sample(range(size), 4)}
        rows.append((x, (2 * (x.get(1, 0) > 2) + (2 in x) + (r.random() < 0.1)) % labels))
    return rows


def _as_train(spark, rows, size):
    from pyspark.ml.linalg import Vectors

    data = [(str(i), Vectors.sparse(size, sorted(x.items())), float(y)) for i, (x, y) in enumerate(rows)]
    return spark.createDataFrame(data, ["row_id", "features", "label"])


def test_decision_tree_equals_a_plain_one_over_a_huge_vocabulary(spark):
    """As wide as all words of a corpus: no array of that width is held anywhere."""
    rows, size = _random_rows(300, 12, 3), 2_000_000_000
    train = _as_train(spark, rows, size).repartition(5)
    model = classify.decision_tree_fit(train, 4)
    found = []
    level = [(0, 0)]
    while level:
        at, node = level.pop()
        if model.term[node] >= 0:
            found.append((at, int(model.term[node]), float(model.cut[node])))
            level += [(at + 1, int(model.left[node])), (at + 1, int(model.right[node]))]
    assert sorted(found) == _gini_tree(rows, 4)
    wrong = classify.test_error(model.transform(train).select("label", "prediction")).first()
    assert wrong["n_rows"] == 300 and wrong["n_wrong"] == 300 - sum(max(c) for c, t in zip(model.counts, model.term) if t < 0)


def test_forest_learns_and_bins_bound_the_cuts(spark):
    from termloom.operators import forest

    rows = _random_rows(400, 12, 2)
    train = _as_train(spark, rows, 12)
    model = classify.random_forest_fit(train, 8)
    assert len(model.roots) == 8 and abs(model.counts[model.roots].sum() / 8 - 400) < 30
    assert classify.test_error(model.transform(train).select("label", "prediction")).first()["error"] < 0.2
    many = _as_train(spark, [({0: i + 1.0}, i % 2) for i in range(100)], 3).select(F.lit(1).cast("long").alias("id"), F.col("label").cast("int").alias("label"), "features")
    assert 25 <= len(forest.bin_starts(many, 32)[0]) <= 31 and forest.bin_starts(many, 101) == {}


def test_perceptron_steps_equal_a_plain_one_and_hold_no_weights_per_term_on_the_driver(spark):
    """Two steps over 2 * 10^9 terms, of which Spark's own would keep 24 weights each on the driver."""
    import numpy as np

    from termloom.operators import perceptron

    size, units, hidden, labels = 2 * 10**9, 5, 3, 3
    rows = _random_rows(60, 12, labels)
    terms = [7, 1999999999, *range(1000, 1010)]
    table = spark.createDataFrame(
        [(f"r{i}", float(label), (0, size, [sorted(terms)[t] for t, _ in sorted(cells.items())], [v for _, v in sorted(cells.items())])) for i, (cells, label) in enumerate(rows) if cells],
        "row_id string, label double, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>",
    )
    model = perceptron.fit(table, size, (units, hidden), labels, 2, 0.0, 5)
    x = np.array([[cells.get(t, 0.0) for t in range(12)] for cells, _ in rows if cells])
    y = np.array([label for cells, label in rows if cells], dtype=np.int64)
    start = perceptron.fit(table, size, (units, hidden), labels, 0, 0.0, 5)
    w, upper = perceptron.uniform(np.array(sorted(terms)), units, size, 5), start.upper
    old = None
    for _ in range(2):
        def at(step, w=w, upper=upper, way=None):
            moved = perceptron.Upper(upper.sizes, upper.weights + step * way[1])
            loss, back, by = moved.backward(x @ (w + step * way[0]), y)
            return loss / len(y), (x.T @ back / len(y) * way[0]).sum() + by @ way[1] / len(y)

        loss, back, by = upper.backward(x @ w, y)
        g = (x.T @ back / len(y), by / len(y))
        gg = (g[0] ** 2).sum() + g[1] @ g[1]
        turn = 0.0 if old is None else max(0.0, (gg - (g[0] * old[0][0]).sum() - g[1] @ old[0][1]) / old[1])
        way = tuple(-a if old is None else turn * b - a for a, b in zip(g, way if old else g))
        slope = (g[0] * way[0]).sum() + g[1] @ way[1]
        guess = 1 / np.sqrt(gg) if old is None else old[2] * old[3] / slope
        step, _ = perceptron.searched(lambda steps: np.array([at(s, way=way) for s in steps]), guess, loss / len(y), slope)
        w, upper = w + step * way[0], perceptron.Upper(upper.sizes, upper.weights + step * way[1])
        old = (g, gg, step, slope)
    assert np.allclose(model.upper.weights, upper.weights, atol=1e-9)
    told = {r["term"]: [r[f"w{k}"] for k in range(units)] for r in model.first.collect()}
    first = perceptron.uniform(np.array(sorted(terms)), units, size, 5)
    assert all(np.allclose(first[i] + told[t], w[i], atol=1e-9) for i, t in enumerate(sorted(terms)) if t in told)
    found = {r["row_id"]: r["prediction"] for r in model.transform(table).collect()}
    want = np.argmax(upper.outputs(x @ w)[-1], axis=1)
    names = [f"r{i}" for i, (cells, _) in enumerate(rows) if cells]
    assert [found[n] for n in names] == want.tolist()


def test_perceptron_steps_leave_out_terms_of_a_single_row(spark):
    """A term that no second row has adds to its row's own squares and is not sent; sums by row and by term are plain ones."""
    import numpy as np

    from termloom.operators import perceptron

    rng = np.random.default_rng(2)
    rows = [(f"r{i}", float(i % 2), (0, 99, [*sorted(rng.choice(8, 3, replace=False).tolist()), 10 + i], [*rng.integers(1, 5, 3).astype(float).tolist(), 2.5])) for i in range(40)]
    schema = "row_id string, label double, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    table = spark.createDataFrame(rows, schema).withColumn("label", F.col("label").cast("int"))
    blocks = perceptron.packed(table, ["row_id", "label"], "label").collect()
    assert sum(len({r["label"] for r in b["kept"]}) > 1 for b in blocks) <= 1
    shared = {b["block"]: b.asDict() for b in perceptron.shared(perceptron.packed(table, ["row_id", "label"], "label")).collect()}
    values = {r[0]: dict(zip(r[2][2], r[2][3], strict=True)) for r in rows}
    for b in blocks:
        found = shared[b["block"]]
        terms = np.frombuffer(found["terms"], dtype=np.int32)
        x = np.array([[values[r["row_id"]].get(t, 0.0) for t in terms] for r in b["kept"]])
        assert terms.max() < 8 and np.allclose(np.frombuffer(found["own"]), 2.5**2)
        w, g = rng.normal(size=(len(terms), 3)), rng.normal(size=(len(x), 3))
        assert np.allclose(perceptron.Layout.read(found, "r_").added(w), x @ w)
        assert np.allclose(perceptron.Layout.read(found, "t_").added(g), x.T @ g)


def test_packed_vectors_merge_rows_and_sort_cells(spark):
    """Rows of an id and a label stand once, with cells by index, also without an id; as many tasks as cells need."""
    from termloom import scratch
    from termloom.operators.lookups import measured

    cells = [(None, "A", "b", 2.0), (None, "A", "a", 1.0), ("r1", "A", "b", 3.0), ("r1", "B", "a", 4.0), ("r1", "A", "a", 5.0), ("r2", "B", "zz", 1.0)]
    columns = measured(spark.createDataFrame([("a", 0), ("b", 1)], "term string, idx int"))
    before = spark.conf.get(scratch.HASHED_GROUPS)
    found = clusters.pack_vectors(spark.createDataFrame(cells, "row_id string, target string, term string, value double"), columns)
    got = {(r["row_id"], r["target"]): (r["features"].size, r["features"].indices.tolist(), r["features"].values.tolist()) for r in found.collect()}
    assert got == {(None, "A"): (2, [0, 1], [1.0, 2.0]), ("r1", "A"): (2, [0, 1], [5.0, 3.0]), ("r1", "B"): (2, [0], [4.0])}
    assert spark.conf.get(scratch.HASHED_GROUPS) == before


def test_kmeans_by_matrix_equals_that_by_joins(spark, monkeypatch):
    """Same draws and centres, also for rows without a label or an id; a step by matrix is a few jobs."""
    rng = random.Random(7)
    cells = [(f"{t}{i}" if i else None, t, w, float(rng.randint(1, 9))) for t, n in (("X", 30), ("Y", 9), (None, 4)) for i in range(n) for w in rng.sample("abcdef", 3)]
    table = spark.createDataFrame(cells, "row_id string, target string, term string, value double")

    def centres():
        return {(r["target"], r["cluster"], r["term"]): r["value"] for r in grouped.grouped_kmeans(table, 3, 20).collect()}

    def jobs(iterations):
        spark.sparkContext.setJobGroup(f"steps-{iterations}", "")
        grouped.grouped_kmeans(table, 3, iterations).collect()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"steps-{iterations}"))

    monkeypatch.setattr(grouped, "STILL", 0.0)
    try:
        assert jobs(2) - jobs(1) <= 4
    finally:
        spark.sparkContext.setJobGroup("tests", "")
    by_matrix = centres()
    monkeypatch.setattr(grouped, "MATRIX", 0)
    by_joins = {at: v for at, v in centres().items() if v}
    assert by_matrix.keys() == by_joins.keys()
    assert all(v == pytest.approx(by_joins[at], abs=1e-9) for at, v in by_matrix.items())


def test_svms_are_fitted_at_once_within_the_drivers_memory(spark, two_topics, monkeypatch):
    """Several small fits at a time, each over one part per core at most, one after the other where terms are many."""
    assert classify.fits_at_once(750 << 20, 1_000, 4) == 4
    assert classify.fits_at_once(750 << 20, 652_185, 4) == 2
    assert classify.fits_at_once(750 << 20, 5_000_000, 4) == 1
    parts, fit = [], classify.LinearSVC.fit
    monkeypatch.setattr(classify.LinearSVC, "fit", lambda self, train: (parts.append(train.rdd.getNumPartitions()), fit(self, train))[1])
    models = classify.svm_one_vs_rest(two_topics, 3)
    assert list(models) == ["beach", "work"] and len(set(models.values())) == 2
    assert len(parts) == 2 and max(parts) <= spark.sparkContext.defaultParallelism
