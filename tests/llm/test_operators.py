"""The training-data operators against brute force, and on awkward inputs."""

import random
import hashlib
import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from termloom.llm import ctw, knn, licenses, neardup, quality, toxicity, trie
from termloom.llm import tokens as tk
from termloom.llm.components import connected_components
from termloom.llm.decontaminate import benchmark_hits, decontaminate, myers
from termloom.llm.mixing import mix_sources
from termloom.llm.neardup import drop_near_duplicates
from termloom.llm.quality import fit_quality, score_quality
from termloom.llm.simhash import majority, shingle_hashes, simhash_groups
from termloom.llm.substrings import remove_repeats
from termloom.llm.toxicity import fit_toxicity, score_toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


AWKWARD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \t\n ", "en", "a", 5), (4, "One", "en", "b", 3),
    (5, LONG, "en", "a", len(LONG)), (6, "One", "en", None, 3), (None, "no id at all", "en", "b", 12),
    (7, "same row", "de", "b", 8), (7, "same row", "de", "b", 8), (8, "é\u00a0ü ß", "de", "c", 6),
    (9, words(1, 60), "en", "a", 1), (10, words(1, 60), "en", "b", 1), (11, words(1, 60) + " tail", "en", "c", 1),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def clashing(awkward):
    names = ["id", "body", "score", "toxicity", "size", "target", "taken", "row", "mark", "md5", "ord", "n_words", "node", "t"]
    return awkward.withColumns({n: F.lit(n) for n in names})


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    items = spark.createDataFrame([], "item_id long, text string")
    assert score_toxicity(docs, fit_toxicity(docs, labels)).count() == 0
    assert score_quality(docs, fit_quality(docs, labels)).count() == 0
    assert licenses.license_digest(licenses.scan_licenses(docs)).count() == 0
    for made in (simhash_groups(docs), remove_repeats(docs), mix_sources(docs), drop_near_duplicates(docs)):
        assert made.count() == 0
    assert benchmark_hits(docs, items).count() == 0 and decontaminate(docs, items).count() == 0
    assert ctw.lm_scores(docs, F.lit(True)).count() == 0
    assert tk.apply_edits(tk.build_trees(docs).withColumn("edits", F.array().cast("array<struct<start:long,stop:long,insert:string>>"))).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert knn.top_inner(vectors, F.col("id") % 2 == 0).count() == 0


def test_awkward_rows_stay(spark, awkward, clashing):
    labels = spark.createDataFrame([(4, 1, 1), (9, 0, 0), (9, None, None), (None, 1, 1)], LABELS)
    items = spark.createDataFrame([(1, "no such item in any of the texts"), (2, None), (None, "x y")], "item_id long, text string")
    for docs in (awkward, clashing):
        n = len(AWKWARD)
        scored = score_toxicity(docs, fit_toxicity(docs, labels)).select("toxicity").collect()
        assert len(scored) == n and all(0 <= r[0] <= 1 for r in scored)
        scored = score_quality(docs, fit_quality(docs, labels)).select("quality_score").collect()
        assert len(scored) == n and all(0 <= r[0] <= 1 for r in scored)
        assert licenses.scan_licenses(docs).count() == n
        assert simhash_groups(docs).count() == n
        assert remove_repeats(docs).count() == n
        assert mix_sources(docs).count() == n
        assert decontaminate(docs, items).count() == n
        assert benchmark_hits(docs, items).count() == 0
        assert ctw.lm_scores(docs, F.col("doc_id") > 2).count() == n
    assert set(remove_repeats(clashing).columns) >= set(clashing.columns)


def test_factorization_machine_learns_a_pair(spark):
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(600):
        a, b = rng.integers(0, 2, 2)
        docs.append((i, f"{words(i, 6)} {'insult' * a} {'membership' * b}", "en", "s", 1))
        labels.append((i, 1, int(a and b)))
    docs, labels = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)
    machine = fit_toxicity(docs, labels, learn_from=F.col("doc_id") % 3 != 0)
    got = score_toxicity(docs, machine).join(labels, "doc_id").filter("doc_id % 3 = 0").toPandas()
    assert ((got.toxicity >= 0.5) == (got.toxic == 1)).mean() > 0.95


def test_quality_learns_shapes(spark):
    docs, labels = [], []
    for i in range(400):
        text = words(i, 40)
        docs.append((i, " ".join(f"{w.upper()}!!" for w in text.split()) if i % 4 == 0 else text, "en", "s", 1))
        labels.append((i, int(i % 4 != 0), 0))
    docs, labels = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)
    model = fit_quality(docs, labels, learn_from=F.col("doc_id") < 200)
    got = score_quality(docs, model).filter("doc_id >= 200").toPandas()
    assert ((got.quality_score >= 0.7) == (got.doc_id % 4 != 0)).mean() > 0.98


def fewest_edits(pattern, text):
    """Edits between a pattern and the nearest part of a text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i] + [0] * len(text)
        for j, c in enumerate(text, 1):
            row[j] = min(last[j - 1] + (p != c), last[j] + 1, row[j - 1] + 1)
    return min(row)


def test_factorization_machine_equals_the_sum_over_pairs():
    """Linear weights and the dot products of all pairs of a text's slots, one by one."""
    params = toxicity.FMParams(slots=64, factors=3)
    rng = np.random.default_rng(4)
    slots = np.array(sorted(rng.choice(64, 40, replace=False)))
    machine = toxicity.FactorizationMachine(params, slots, -0.3, np.append(rng.normal(size=40), 0), np.vstack([rng.normal(size=(40, 3)), np.zeros((1, 3))]))
    texts = [b"", b"one", b"you are one of them", b"Them them THEM and you", words(3, 30).encode(), b"one two, three! two"]
    for text, found in zip(texts, machine.scorer()(texts), strict=True):
        terms = set(text.translate(toxicity.TERM_BYTES).split())
        held = {int(h) for w in terms for h in toxicity.word_slots(w, params)}
        ids = [i for i, s in enumerate(slots) if int(s) in held]
        raw = machine.bias + sum(machine.weight[i] for i in ids)
        for a, i in enumerate(ids):
            for j in ids[a + 1 :]:
                raw += sum(machine.factor[i][f] * machine.factor[j][f] for f in range(3))
        assert found == pytest.approx(1 / (1 + math.exp(-raw)), abs=1e-9)


def plain_grams(text, params):
    """Value of each slot of a text, gram by gram: words in lower case, and their shapes."""
    mask, found = (1 << 64) - 1, {}
    codes = [quality.word_codes(w) for w in text.split()]
    word = [c >> 32 for c in codes]
    shape = [(c & 0xFFFFFFFF) << 1 | (i > 0 and word[i] == word[i - 1]) for i, c in enumerate(codes)]
    for shift, row in ((40, word), (50, shape)):
        for n in range(1, params.grams + 1):
            for at in range(len(row) - n + 1):
                gram = row[at]
                for one in row[at + 1 : at + n]:
                    gram = (gram * int(quality.MIX) + one) & mask
                slot = ((gram + (n << shift)) * int(quality.MIX) & mask) >> 64 - params.bits
                found[slot] = found.get(slot, 0) + params.scale / len(row)
    found[0] = found.get(0, 0) + 1.0
    return found


def test_quality_equals_plain_ftrl():
    """Features, learned weights and scores against one gram and one weight at a time."""
    params = quality.FTRLParams(bits=12, epochs=2)
    texts = [words(i, 12).encode() + (b" BUY NOW!!! BUY NOW!!!" if i % 3 else b"") for i in range(24)] + [b"", b"one", b"one one"]
    labels = np.array([float(i % 3 == 0) for i in range(len(texts))])
    features = quality.Features(params)
    model = quality.Ftrl.fit(params, [features.of(t) for t in texts], labels)
    plain = [plain_grams(t, params) for t in texts]
    for text, want in zip(texts, plain, strict=True):
        ids, values = features.of(text)
        assert dict(zip(ids.tolist(), values.tolist(), strict=True)) == pytest.approx(want)
    z, n, rng = {}, {}, np.random.default_rng(params.seed)

    def weight(i):
        if abs(z.get(i, 0.0)) <= params.l1:
            return 0.0
        rate = (params.beta + math.sqrt(n[i])) / params.alpha + params.l2
        return -(z[i] - math.copysign(params.l1, z[i])) / rate

    for _ in range(params.epochs):
        for k in rng.permutation(len(texts)):
            old = {i: weight(i) for i in plain[k]}
            guess = 1 / (1 + math.exp(-sum(old[i] * x for i, x in plain[k].items())))
            for i, x in plain[k].items():
                g, before = (guess - labels[k]) * x, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / params.alpha * old[i]
                n[i] = before + g * g
    score = model.scorer()
    for text, x in zip(texts, plain, strict=True):
        assert score(text) == pytest.approx(1 / (1 + math.exp(-sum(weight(i) * v for i, v in x.items()))), abs=1e-5)


def test_benchmark_hits_equal_all_items_against_all_places(spark):
    """A hit is an item some stretch of the text comes near to, by the whole table of edit distances."""
    rng = np.random.default_rng(9)
    items = [(i, " ".join("".join(rng.choice(list("abc"), 4)) for _ in range(6 + i % 3))) for i in range(12)]
    texts = []
    for i in range(40):
        body = list(items[i % 12][1])
        for _ in range(i % 6):
            body[rng.integers(len(body))] = "x"
        texts.append(words(i, 8) + " " + "".join(body).upper() + "  " + words(i + 50, 8) + (" " + items[(i + 5) % 12][1] if i % 4 == 0 else ""))
    texts += ["", " ", items[0][1][:-1], items[1][1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    per_edit = 9
    got = {(r.doc_id, r.item_id): r.distance for r in benchmark_hits(docs, spark.createDataFrame(items, "item_id long, text string"), per_edit).collect()}
    want = {}
    for d, text in enumerate(texts):
        plain = " ".join(text.lower().split())
        for number, item in items:
            row = list(range(len(item) + 1))
            best = row[-1]
            for c in plain:
                new = [0]
                for j, p in enumerate(item, 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
                row, best = new, min(best, new[-1])
            if best <= len(item) // per_edit:
                want[d, number] = best
    assert got == want and len(want) > 30


def test_license_places_equal_a_plain_scan():
    scanner = licenses.Scanner(licenses.make_notices(licenses.NOTICES, 9), licenses.PHRASES)
    rng = np.random.default_rng(4)
    pool = ["mit", "license", "cc", "by", "apache", "GNU", "general", "public", "License,", "x", "permitlicense", "under", "the", "released"]
    for _ in range(300):
        text = " ".join(rng.choice(pool, int(rng.integers(0, 40))))
        parts = text.encode().translate(licenses.WORD_BYTES).decode().split()
        n, base, _ = scanner.scan(text.encode())
        want = []
        for phrase, label in licenses.PHRASES.items():
            own = phrase.split()
            want += [(i, label) for i in range(len(parts)) if parts[i : i + len(own)] == own]
        assert n == len(parts) and sorted(base) == sorted(want)


def test_fuzzy_notices_equal_plain_edit_distance():
    notices = licenses.make_notices(licenses.NOTICES, 9)
    scanner = licenses.Scanner(notices, licenses.PHRASES)
    rng = np.random.default_rng(5)
    found = 0
    for turn in range(60):
        own = list(notices[turn % len(notices)].text)
        for _ in range(int(rng.integers(0, notices[turn % len(notices)].edits + 3))):
            at = int(rng.integers(0, len(own)))
            own[at : at + int(rng.integers(0, 2))] = list(rng.choice(list("abet "), int(rng.integers(0, 2))))
        text = " ".join(f"some words before {''.join(own)} and after".split())
        spans = scanner.fuzzy(text)
        for n in notices:
            want = fewest_edits(n.text, text)
            hits = [s for s in spans if s[0] == n.label and s[4] == len(n.text)]
            same = [m for m in notices if m.label == n.label and len(m.text) == len(n.text)]
            if len(same) == 1:
                assert bool(hits) == (want <= n.edits)
                assert not hits or min(s[3] for s in hits) == want
                found += bool(hits)
            for s in hits:
                assert any(fewest_edits(m.text, text[s[1] : s[2]]) <= s[3] for m in same)
    assert found > 40


def test_every_place_of_a_notice_in_a_long_text():
    """2 MB of repeated places: each is reported, in time that grows with the text."""
    scanner = licenses.Scanner(licenses.make_notices(licenses.NOTICES, 9), licenses.PHRASES)
    line = b"all rights reserved. Some Mit License here; mozila public license "
    n, base, spans = scanner.scan(line * 30_000)
    assert n == 30_000 * 10 and len(base) == 30_000 and base[-1][0] == 10 * 30_000 - 6
    assert sum(s[0] == "mpl" for s in spans) == 30_000 and sum(s[0] == "all-rights-reserved" for s in spans) == 30_000


def test_licenses(spark):
    texts = ["Under the Apache  License!", "licensd under the apache license", "cc by cc by", "nothing", "cc-by", "ccby", "MIT-license"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in licenses.license_digest(licenses.scan_licenses(docs)).collect()}
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["base_labels"], got[0]["n_words"]) == (1, 2, "apache", 4)
    assert got[1]["labels"] == "apache" and got[1]["score"] == 1.0
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["last_word"]) == (2, 0, 2)
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["labels"], got[3]["score"]) == (0, None, "", 0.0)
    assert got[4]["base_labels"] == "cc-by" and got[5]["base_labels"] == "" and got[6]["base_labels"] == "mit"
    scanner = licenses.Scanner(licenses.make_notices(licenses.NOTICES, 9), licenses.PHRASES)
    assert [x[0] for x in scanner.fuzzy("mozila public licence")] == []  # three edits
    assert [x[0] for x in scanner.fuzzy("mozila public license")] == ["mpl"]


def test_trie_join_and_simhash(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    near = [base[rng.integers(0, 200, 300)] ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) for _ in range(3)]
    x = np.unique(np.concatenate([base, *near]))
    want = {(int(i), int(j)) for i, j in zip(*np.where(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2), strict=True) if i < j}
    got = {p for i, j in trie.join_nodes(x, None, 0, 0, 2) for p in zip(i.tolist(), j.tolist(), strict=True)}
    assert got == want
    strings = spark.createDataFrame([(0, int(v), int(v)) for v in x.view(np.int64)], "t int, bits long, node long")
    roots = {r["node"]: r["root"] for r in connected_components(trie.trie_links(strings, 2, limit=64)).collect()}
    signed = x.view(np.int64)
    assert all(roots[int(signed[i])] == roots[int(signed[j])] for i, j in want)
    groups: dict = {}
    for i, j in want:
        groups.setdefault(i, set()).add(j)
        groups.setdefault(j, set()).add(i)
    seen, parts = set(), 0
    for i in groups:
        if i not in seen:
            parts, todo = parts + 1, [i]
            while todo:
                k = todo.pop()
                if k not in seen:
                    seen.add(k)
                    todo += groups[k]
    assert len(set(roots.values())) == parts


def test_components_of_a_long_chain(spark):
    order = np.random.default_rng(3).permutation(300).tolist()
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(299)] + [(1000, 1001)], "a long, b long")
    roots = dict(connected_components(links).collect())
    assert {roots[i] for i in range(300)} == {0} and roots[1001] == 1000


def test_links_of_a_star_are_joined_once(spark, monkeypatch):
    """What a group of copies leaves to later rounds are links between trees, not all its links in each round."""
    from termloom.llm import components

    tables, whole = [], components.publish
    monkeypatch.setattr(components, "publish", lambda df, label, *more: tables.append(whole(df, label, *more)) or tables[-1])
    star = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1, 40)] + [(500, 501), (501, 502)]
    roots = dict(connected_components(spark.createDataFrame(star, "a long, b long")).collect())
    assert roots == {**dict.fromkeys(range(400), 0), 500: 500, 501: 500, 502: 500}
    assert sum(t.count() for t in tables) <= 3 * len(star)


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_fingerprints(awkward):
    got = {(r["doc_id"], r["fingerprint"]) for r in simhash_groups(awkward).collect()}
    assert got == {(r[0], format(brute_fingerprint(r[1]), "016x")) for r in AWKWARD}


def test_remove_repeats(spark):
    p, q = words(2, 30), words(3, 14)
    texts = [(5, f"a {p} b"), (6, f"{q}\n\n{p} z"), (7, f"x {q} y"), (8, p), (8, p), (9, "of " * 40), (10, "of " * 13), (None, q)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], SCHEMA)
    got = remove_repeats(docs, 13).collect()

    def starts(i, t):
        w = t.split()
        return {tuple(w[k : k + 13]) for k in range(len(w) - 12)}

    for r in got:
        original = next(t for i, t in texts if i == r["doc_id"])
        w, own = original.split(), r["doc_id"] if r["doc_id"] is not None else math.inf
        earlier = set().union(*[starts(i, t) for i, t in texts if i is not None and i < own], set())
        gone = {k + j for k in range(len(w) - 12) if tuple(w[k : k + 13]) in earlier for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (r["n_words"], r["n_removed"]) == (len(w), len(gone))
        assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        assert r["text"].split() == kept.split()


def test_myers():
    def distance(p, t):
        row = [0] * (len(t) + 1)
        for i, a in enumerate(p, 1):
            last, row = row, [i]
            for j, b in enumerate(t, 1):
                row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
        return min(row)

    rng = np.random.default_rng(1)
    for _ in range(200):
        p, t = ("".join(rng.choice(list("abc"), n)) for n in rng.integers(1, 90, 2))
        assert myers(p, t)[0] == distance(p, t)


def test_decontamination(spark):
    item = words(4, 40)
    edited = item.replace(item.split()[7], "zz").upper()
    texts = [f"x {item} y", f"x\n{edited}\ty", words(5, 60), None, " ".join(item.split()[:20])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    items = spark.createDataFrame([(1, item), (2, words(6, 40))], "item_id long, text string")
    hits = {(r["doc_id"], r["item_id"]): r for r in benchmark_hits(docs, items).collect()}
    assert set(hits) == {(0, 1), (1, 1)}
    assert hits[0, 1]["distance"] == 0 and hits[0, 1]["end"] - hits[0, 1]["start"] == len(item)
    assert hits[1, 1]["distance"] in range(1, 6)
    assert sorted(r["doc_id"] for r in decontaminate(docs, items).collect()) == [2, 3, 4]


def test_top_inner(spark):
    rng = np.random.default_rng(2)
    v = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(300)]
    odd = [(900, None), (901, [1.0, None]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6), (5, v[5][1])]
    got = knn.top_inner(spark.createDataFrame(v + odd, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0, k=7, pivots=8, group_queries=4)
    want = []
    for q in range(0, 300, 20):
        scores = sorted((-sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(v[q][1], x, strict=True)), i) for i, x in v if i != q)[:7]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_pruning_bounds_keep_every_hit():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 3)) * 20
    x = np.concatenate([c + rng.normal(size=(50, 3)) for c in centres])
    cell = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    dist = np.linalg.norm(x - centres[cell], axis=1)
    far = np.array([dist[cell == c].max() for c in range(6)])
    near = [sorted(dist[cell == c])[:4] for c in range(6)]
    least = knn.cell_thresholds(centres, far, near, far, 3)
    scores = x @ x.T
    for q in range(len(x)):
        for o in np.argsort(-scores[q])[:4]:
            assert dist[o] >= least[cell[q], cell[o]]
    assert np.isinf(least).any()  # something is pruned


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(6)
    docs = [(i, words(i, int(rng.integers(1, 40))), "en", ["a", "b", None, "c"][i % 4 if i % 3 else 0], 1) for i in range(400)]
    got = mix_sources(spark.createDataFrame(docs, SCHEMA)).toPandas()
    assert (got.taken <= 2 * got["size"]).all()
    sums = got.groupby(got.source.fillna("~")).agg(target=("target", "first"), taken=("taken", "sum"), size=("source_size", "first"))
    assert ((sums.target - sums.taken).abs() <= 40).all()
    assert abs(sums.target.sum() - 1.5 * got["size"].sum()) < 1e-6 and (sums.target <= 2 * sums["size"] + 1e-9).all()


def test_context_tree_is_a_distribution_and_beats_nothing():
    zeros, ones = ctw.node_counts(np.arange(32, dtype=float))
    lengths = ctw.code_lengths(((ones + 0.5) / (zeros + ones + 1))[None, :])
    assert abs((2.0 ** -lengths).sum() - 1) < 1e-9
    x = np.array([0.5, 1, 2.5, 7, 8, 100.5])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], atol=1e-9)


def test_no_kept_context_is_lost():
    """Every context of the text is kept with a length of 1 at each symbol: each place costs 1."""
    symbols = ctw.symbol_map(np.bincount(np.arange(97, 123), minlength=256))
    text = bytes(np.random.default_rng(0).integers(97, 123, 20_000).astype(np.uint8))
    deep = np.unique(ctw.framed([text], symbols)[2])
    none, lengths = np.zeros((ctw.SHORT, ctw.SYMBOLS), dtype=np.uint16), np.ones((len(deep), ctw.SYMBOLS), dtype=np.uint16)
    model = ctw.Model(symbols, none, np.zeros(0, dtype=np.int64), none[:0], deep, lengths, np.zeros(256, dtype=np.int64))
    model.unfold()
    assert model.steps([text]).tolist() == [len(text) + 1]


def test_language_model(spark):
    docs = [(i, f"{words(i % 7, 20)} X{i}", "en", "s", 1) for i in range(200)] + [(500, None, None, None, None)]
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    got = ctw.lm_scores(spark.createDataFrame(docs, SCHEMA), learned).toPandas().set_index("doc_id")
    train = [t for i, t, *_ in docs if zlib.crc32(str(i).encode()) % 10]
    counts: dict = {}
    for t in train:
        for w in [*(t or "").lower().split(), None]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, t, *_ in docs:
        own = [*(t or "").lower().split(), None]
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        r = got.loc[i]
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.train_tokens == n
        assert (r.n_tokens, r.n_known) == (len(own), sum(w in counts for w in own))
    assert got[~got.learned].bits_per_byte.mean() < 3


def log_half_sum(a, b):
    return max(a, b) + math.log1p(math.exp(-abs(a - b))) - math.log(2)


class PlainTree:
    """Context-tree weighting by its recursion, node by node, over the places of a few texts."""

    DEPTHS = (0, 1, 2, 3, 4, 6)

    def __init__(self, texts):
        bytes_in = b"".join(texts) + b"\xff" * len(texts)
        self.byte_counts = np.bincount(np.frombuffer(bytes_in, dtype=np.uint8), minlength=256)
        self.symbols = ctw.symbol_map(self.byte_counts).tolist()
        self.counts, self.children = {}, {}
        for text in texts:
            for context, symbol, _ in self.places(text):
                for level, depth in enumerate(self.DEPTHS):
                    for z, bit in self.decisions(symbol, 5):
                        own = self.counts.setdefault((context[6 - depth :], z), [0, 0])
                        own[bit] += 1
                        if level + 1 < len(self.DEPTHS):
                            longer = context[6 - self.DEPTHS[level + 1] :]
                            self.children.setdefault((context[6 - depth :], z), set()).add((longer, z))
        self.weights = {}

    def places(self, text):
        line = [self.symbols[b] for b in b"\xff" * 6 + text + b"\xff"]
        for i, byte in enumerate(text + b"\xff"):
            yield tuple(line[i : i + 6]), line[i + 6], byte

    @staticmethod
    def decisions(symbol, bits):
        z = 1
        for k in range(bits - 1, -1, -1):
            bit = symbol >> k & 1
            yield z, bit
            z = 2 * z + bit

    def own(self, node):
        zeros, ones = self.counts[node]
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    def weight(self, node):
        if node not in self.weights:
            longer = self.children.get(node)
            below = sum(map(self.weight, longer)) if longer else None
            self.weights[node] = self.own(node) if below is None else log_half_sum(self.own(node), below)
        return self.weights[node]

    def one(self, context, z):
        """Probability of a one, from the longest context that was met to the root."""
        p = None
        for depth in reversed(self.DEPTHS):
            node = (context[6 - depth :], z)
            if node not in self.counts:
                continue
            zeros, ones = self.counts[node]
            estimate = (ones + 0.5) / (zeros + ones + 1)
            if p is None:
                p = estimate
                continue
            below = sum(map(self.weight, self.children[node]))
            share = 1 / (1 + math.exp(min(below - self.own(node), 700)))
            p = share * estimate + (1 - share) * p
        return 0.5 if p is None else p

    def bits(self, text):
        total = 0.0
        for context, symbol, byte in self.places(text):
            for z, bit in self.decisions(symbol, 5):
                total -= math.log2(self.one(context, z) if bit else 1 - self.one(context, z))
            if symbol == ctw.OTHER:
                rest = [n if s == ctw.OTHER else 0 for n, s in zip(self.byte_counts, self.symbols, strict=True)]
                low, high = 0, 256
                for k in range(7, -1, -1):
                    middle = (low + high) // 2
                    zeros, ones = sum(rest[low:middle]), sum(rest[middle:high])
                    bit = byte >> k & 1
                    total -= math.log2(((ones if bit else zeros) + 0.5) / (zeros + ones + 1))
                    low, high = (middle, high) if bit else (low, middle)
        return total


@pytest.mark.parametrize("kept", [None, 40])
def test_score_equals_the_recursive_tree(spark, monkeypatch, kept):
    if kept is not None:
        monkeypatch.setattr(ctw, "KEPT", kept)
    texts = [f"{words(i % 3, 6)} tail{i} \u00e9\u00fc{chr(0x4E00 + i)}" for i in range(14)] + ["", "zzzz zzzz zzzz", "Quite 0+1=! NEW"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    tree = PlainTree([t.lower().encode() for i, t in enumerate(texts) if i % 5])
    for r in ctw.lm_scores(docs, F.col("doc_id") % 5 != 0).collect():
        body = texts[r["doc_id"]].lower().encode()
        want = tree.bits(body)
        got = -r["score"] / math.log10(2)
        # each symbol's length, and that of an uncommon byte, is rounded up to a step
        assert -1e-6 <= got - want <= 2 * (len(body) + 1) / ctw.STEPS + 1e-6


def test_code_lengths_have_no_ceiling():
    """One context with 5e7 (1e12) equal decisions: the other symbol costs what its counts say."""
    for n in (5e7, 1e12):
        ones = np.full((1, ctw.SYMBOLS), 0.5 / (n + 1))
        exact = ctw.code_lengths(ones)[0]
        got = ctw.steps_of(ctw.in_steps(ones))[0] / ctw.STEPS
        assert exact.max() > 128 and (got >= exact - 1e-9).all() and (got - exact <= ctw.COARSE / ctw.STEPS).all()


def test_places_of_keys():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 30, 5000).astype(np.int32))
    asked = np.concatenate([keys[::3], rng.integers(0, 1 << 30, 5000).astype(np.int32)])
    where = {k: i for i, k in enumerate(keys.tolist())}
    assert ctw.Places(keys).find(asked).tolist() == [where.get(k, -1) for k in asked.tolist()]
    assert ctw.Places(keys[:0]).find(asked[:4]).tolist() == [-1] * 4


def test_contexts_that_are_not_sent_score_alike(spark, monkeypatch):
    docs = [(i, f"{words(i % 7, 20)} X{i} {words(60 + i, 9)}", "en", "s", 1) for i in range(120)] + [(500, None, None, None, None)]
    docs = spark.createDataFrame(docs, SCHEMA)
    learned = F.col("doc_id") % 5 != 0
    want = rows(ctw.lm_scores(docs, learned))
    for kept in (300, 0):
        monkeypatch.setattr(ctw, "KEPT", kept)
        assert rows(ctw.lm_scores(docs, learned)) == want


def test_edits_equal_a_fresh_count(spark):
    rng = np.random.default_rng(8)
    alphabet = list("ab1 '\n.é") + ["'s", "  ", "the"]
    texts = ["".join(rng.choice(alphabet, int(n))) for n in rng.integers(0, 400, 60)] + [None, "", LONG]
    edits = [[(int(a), int(a + rng.integers(0, 9)), "".join(rng.choice(alphabet, 3))) for a in rng.integers(0, 420, 4)] for _ in texts]
    edits[0], edits[1] = None, [None]
    docs = spark.createDataFrame(list(zip(range(len(texts)), texts, edits, strict=True)), "doc_id long, text string, edits array<struct<start:long,stop:long,insert:string>>")
    edited = tk.apply_edits(tk.build_trees(docs, keep=("edits",)))
    fresh = tk.build_trees(edited.select("doc_id", "text")).toPandas().set_index("doc_id")
    got = edited.toPandas().set_index("doc_id")
    for i in got.index:
        assert list(got.leaf_chars[i]) == list(fresh.leaf_chars[i]) and list(got.leaf_tokens[i]) == list(fresh.leaf_tokens[i])
        assert got.n_tokens[i] == fresh.n_tokens[i]
    assert got.n_encoded[len(texts) - 1] < 200


def test_links_between_near_copies_grow_with_the_texts(spark, monkeypatch):
    """A family of near copies is connected by few links a text, not by one in each table and to each text of a block."""
    from termloom.llm import neardup

    r, plain = random.Random(4), [f"w{i}" for i in range(120)]
    texts = []
    for i in range(300):
        words = list(plain)
        words[r.randrange(120)] = f"x{i}"
        texts.append(" ".join(words))
    seen = []
    whole = neardup.connected_components
    monkeypatch.setattr(neardup, "connected_components", lambda links, *more: seen.append(links.count()) or whole(links, *more))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [row["doc_id"] for row in drop_near_duplicates(docs).collect()] == [0]
    assert max(seen) <= 8 * len(texts)


def test_near_duplicates(spark):
    text = words(20, 200).split()
    near = [*text[:100], "changed", *text[101:]]
    far = text[:100] + words(21, 100).split()
    copies = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate([text, near, text, far])] + [(9, "a b", "en", "s", 1), (9, "a b", "en", "s", 1), (10, None, "en", "s", 1), (11, "", "en", "s", 1)]
    got = drop_near_duplicates(spark.createDataFrame(copies, SCHEMA))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 3, 9, 10]


def test_near_misses_never_displace_a_link(spark):
    """Strings in one Hamming group, nearest first a false partner: the further pair must be met too."""
    rows = [(0, 0, 1, 0, 1), (0, 1 << 32, 2, 0, 2), (0, 3 << 32, 3, 0, 3), (0, 3 << 32, 4, 0, 3), (0, 0, 5, 0, 1)]
    strings = spark.createDataFrame(rows, "t int, bits long, node long, check long, root long")
    got = {(r["a"], r["b"]) for r in trie.trie_pairs(strings, 2, 0).collect()}
    assert got == {(a, b) for a in range(1, 6) for b in range(a + 1, 6) if rows[a - 1][4] != rows[b - 1][4]}


def test_templated_family_keeps_every_true_link_that_met(spark):
    """Pairs at 0.81 among pages that are pairwise at 0.78: none is displaced by false ones, met in a table or in a block."""
    body = words(40, 250)
    texts = [f"{body} {words(1000 + i // 2, 4)} {words(2000 + i, 30)}" for i in range(240)]
    hashes = [np.unique(shingle_hashes(t.encode(), 5)) for t in texts]
    sigs = np.array([[majority(neardup.mixed(h, w)) for w in range(neardup.WORDS)] for h in hashes], dtype=np.uint64)
    tables = sigs[:, :-1].copy().view(np.uint32)

    def met(a, b):
        return (np.bitwise_count(tables[a] ^ tables[b]) <= neardup.BUDGET).any() and np.bitwise_count(sigs[a, -1] ^ sigs[b, -1]) <= neardup.CHECK_BUDGET

    def similar(a, b):
        both = len(np.intersect1d(hashes[a], hashes[b]))
        return both >= 0.8 * (len(hashes[a]) + len(hashes[b]) - both)

    linked = {b for b in range(1, 240, 2) if similar(b - 1, b) and met(b - 1, b)}
    assert len(linked) > 90 and not any(similar(a, b) for a in range(0, 240, 2) for b in range(a + 2, 240))
    true = {b for b in range(1, 240, 2) if similar(b - 1, b)}
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    assert linked <= true and {r["doc_id"] for r in drop_near_duplicates(docs).collect()} == set(range(240)) - true


def test_rows_asked_grow_with_blocks_and_not_with_pairs(spark, monkeypatch):
    """Templated families with nothing to link: what is asked for stays in proportion to the texts times the blocks."""
    asked = {}
    held = neardup.block_links
    monkeypatch.setattr(neardup, "block_links", lambda a, *more: asked.update(n=a.count()) or held(a, *more))
    for n in (100, 400):
        body = words(50, 250)
        docs = spark.createDataFrame([(i, f"{body} {words(5000 + i, 36)}", "en", "s", 1) for i in range(n)], SCHEMA)
        assert drop_near_duplicates(docs).count() == n
        assert asked["n"] <= n * (n // neardup.BLOCK_TEXTS + 1)


def test_meetings_are_told_by_pairs_of_blocks(spark, monkeypatch):
    """80 strings of four blocks that all meet in six tables: rows by pairs of blocks, not by nodes, and each (node, block) once."""
    from pyspark.sql.group import GroupedData

    told, apply = [], GroupedData.applyInArrow
    monkeypatch.setattr(GroupedData, "applyInArrow", lambda self, *more: told.append(apply(self, *more)) or told[-1])
    rows = [(t, 0, node, 0, node, node % 4) for t in range(6) for node in range(80)]
    strings = spark.createDataFrame(rows, "t int, bits long, node long, check long, root long, block long")
    got = [(r["node"], r["block"]) for r in trie.trie_meetings(strings, 2, 0).collect()]
    assert sorted(got) == sorted({(a, b % 4) for a in range(80) for b in range(a + 1, 80)})
    assert told[0].count() == 6 * 4 * 4


def test_texts_with_too_many_shingles_of_their_own_ask_nothing(spark, monkeypatch):
    """Pages that share a body meet in the tables, but a fifth and more of each is its own: none can be similar to another."""
    asked = {}
    held = neardup.block_links
    monkeypatch.setattr(neardup, "block_links", lambda a, *more: asked.update(n=a.count()) or held(a, *more))
    body = words(51, 250)
    texts = [f"{body} {words(7000 + i, 66)}" for i in range(120)]
    copies = [f"{body} {words(6000, 20)} copy{i}" for i in range(4)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate([*texts, *copies])], SCHEMA)
    assert {r["doc_id"] for r in drop_near_duplicates(docs).collect()} == set(range(121))
    assert asked["n"] <= 4


def test_short_texts_meet_exactly(spark):
    """Texts of four to ten shingles, each with a partner of one more word: similarity 0.8 and more."""
    texts = [words(3000 + i, 8 + i % 7) for i in range(150)]
    pairs = [(2 * i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(2 * i + 1, f"{t} more{i}", "en", "s", 1) for i, t in enumerate(texts)]
    got = {r["doc_id"] for r in drop_near_duplicates(spark.createDataFrame(pairs, SCHEMA)).collect()}
    assert got == set(range(0, 300, 2))


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "mixing"]
    last = corpus_pipeline.run(spark, sf)
    assert last.columns == [*docs.columns, "size", "source_size", "target", "taken"]
    assert 0 < last.count() <= docs.count()
