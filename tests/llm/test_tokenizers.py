"""Byte-level BPE and tokenizer alignment against the public libraries and brute force."""

import base64
import hashlib

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from termloom.llm import alignment, bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ALPHABET = ["a", "b", "the", " ", "  ", "\n", "'s", "'", "é", "世", "1", "..", "▁", "aaaa", "ing", " ", "🤖", "<|endoftext|>"]
LONG = "ab" * 20_000 + " " + "x y\n" * 9_000


def mixtures(seed, n, most=60):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(ALPHABET, int(k))) for k in rng.integers(0, most, n)]


@pytest.fixture(scope="module")
def library():
    with open(bpe.VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    with open(bpe.VOCABULARY, "rb") as lines:
        return bpe.TextCoder(lines.read(), bpe.PATTERN)


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)


def test_encoding_equals_the_library_and_decodes_back(spark, library):
    texts = [*mixtures(1, 300), None, "", LONG]
    docs = documents(spark, texts).withColumns({n: F.lit(1) for n in ("id", "ids", "decoded")})
    got = bpe.decode_ids(bpe.encode_texts(docs)).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()


def test_every_prefix_has_the_last_token_of_its_own_encoding(coder, library):
    """Brute force: the table's entry for a prefix is the last token of plainly encoding that prefix."""
    whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=library._mergeable_ranks, special_tokens={})
    for piece in ["internationalisation", "aaaaaaaaa", "=-=-==--", "    ", " éàü世界", "xyzzy" * 9]:
        raw = piece.encode()
        table = coder.coder.table(raw)
        assert len(table) == len(raw)
        for i in range(1, len(raw) + 1):
            assert table[i - 1] == whole._encode_single_piece(raw[:i])[-1]


def test_edits_and_appends_equal_a_fresh_table(spark, library):
    rng = np.random.default_rng(3)
    texts = [*mixtures(4, 120), None, "", "abcdefgh" * 3_000]
    edits = [[(int(a), int(a + rng.integers(0, 9)), "".join(rng.choice(ALPHABET, 2))) for a in rng.integers(0, 70, 4)] for _ in texts]
    edits[0], edits[1], edits[2] = None, [None], [(None, 3, "x")]
    edits[3] = [(10**9, 10**9, " appended"), (0, 0, None)]
    rows = list(zip(range(len(texts)), texts, strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plan = spark.createDataFrame(list(enumerate(edits)), "doc_id long, edits array<struct<start:long,stop:long,insert:string>>")
    edited = bpe.edit_prefix_tables(bpe.build_prefix_tables(docs).join(plan, "doc_id"))
    fresh = {r["doc_id"]: r for r in bpe.build_prefix_tables(edited.select("doc_id", "text")).collect()}
    for r in edited.collect():
        want = fresh[r["doc_id"]]
        assert r["piece_chars"] == want["piece_chars"] and r["last_tokens"] == want["last_tokens"]
        assert r["ids"] == library.encode_ordinary(r["text"])
    assert edited.filter(F.col("doc_id") == len(texts) - 1).first()["n_computed"] < 3_000
    assert edited.filter("doc_id = 3").first()["text"].endswith(" appended")


def test_awkward_rows_and_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert bpe.decode_ids(bpe.encode_texts(none)).count() == 0
    assert bpe.edit_prefix_tables(bpe.build_prefix_tables(none).withColumn("edits", F.array().cast("array<struct<start:long,stop:long,insert:string>>"))).count() == 0
    rows = [(1, "same"), (1, "same"), (None, "no id"), (2, None), (3, ""), (4, " \t\n ")]
    got = bpe.encode_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, len(r["ids"])) for r in got)[:4] == [(False, 1, 1), (False, 1, 1), (False, 2, 0), (False, 3, 0)]
    assert len(got) == 6


def test_registered_digests(spark, library, tmp_path):
    from termloom.llm.queries import QUERIES

    texts = mixtures(9, 40)
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    for r in QUERIES["op13_prefix_bpe"](spark, str(tmp_path)).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def plain_alignment(aligner, text):
    """Brute force: whole texts, every pair of tokens compared."""
    raw = (" " + (text or "")).encode()
    a = aligner.a.encode(" " + (text or ""), add_special_tokens=False).ids
    b = aligner.b.encode(text or "", return_type=int)
    parts = [aligner.a_bytes[i] for i in a], [aligner.b_token(aligner.b.id_to_piece(i)) for i in b]
    if not text or any(b"".join(p) != raw for p in parts):
        return 0, 0, 0, 0, "", []
    spans = []
    for p in parts:
        ends = np.cumsum(list(map(len, p))).tolist()
        spans.append(list(zip([0, *ends], ends, strict=False)))
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups = []
    for low, high in zip([0, *cuts], cuts, strict=False):
        inside = [",".join(str(i) for i, (s, _) in zip(ids, own, strict=True) if low <= s < high) for ids, own in zip((a, b), spans, strict=True)]
        groups.append("|".join(inside))
    links = [(i, j) for i, (s, e) in zip(a, spans[0], strict=True) for j, (u, v) in zip(b, spans[1], strict=True) if s < v and u < e]
    return len(a), len(b), len(cuts), len(links), ";".join(groups), links


MIXED = [*mixtures(21, 150, 30), "The Étranger, naïve 丂 <s> <0x41> \n\n\tend. ", "plain words only, and twice: plain words only", "plain words only", None, "", " ", "x" * 500]


@pytest.fixture(scope="module")
def aligner():
    with open(alignment.BYTE_BPE, "rb") as a, open(alignment.PIECE_BPE, "rb") as b:
        return alignment.Aligner(a.read(), b.read())


def test_alignment_equals_brute_force(spark, aligner):
    docs = documents(spark, MIXED).withColumns({n: F.lit(1) for n in ("id", "row", "links", "n", "groups")})
    found = 0
    for r in alignment.align_tokenizers(docs, spans=True).collect():
        want = plain_alignment(aligner, MIXED[r["doc_id"]])
        assert tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups")) == want[:5]
        assert [(link % 2**32 // 65536, link % 65536) for link in r["links"]] == want[5]
        if want[0]:
            raw = (" " + MIXED[r["doc_id"]]).encode()
            assert r["a_ends"][-1] == r["b_ends"][-1] == len(raw) and len(set(r["a_ends"]) & set(r["b_ends"])) == r["n_groups"]
            found += 1
    assert found > 40


@pytest.mark.parametrize("common", [alignment.COMMON_PAIRS, 20, 0])
def test_link_scores_equal_brute_force(spark, aligner, common):
    docs = documents(spark, MIXED)
    aligned = alignment.align_tokenizers(docs)
    got = {r["row"]: (r["n_best"], r["count_sum"]) for r in alignment.score_links(aligned, "doc_id", alignment.pair_counts(aligned), common).collect()}
    links = [plain_alignment(aligner, t)[5] for t in MIXED]
    counts: dict = {}
    for link in (x for own in links for x in own):
        counts[link] = counts.get(link, 0) + 1
    best: dict = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    want = {i: (sum(counts[x] == best[x[1]] for x in own), sum(counts[x] for x in own)) for i, own in enumerate(links) if own}
    assert got == want


def test_alignment_of_awkward_rows(spark, aligner):
    assert alignment.alignment_scores(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "same"), (1, "same"), (None, "no id"), (2, None), (3, "a▁b"), (4, LONG)]
    got = alignment.alignment_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6 and sum(r["doc_id"] == 1 for r in got) == 2
    zero = [r for r in got if r["doc_id"] in (2, 3)]
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in zero)
    long = next(r for r in got if r["doc_id"] == 4)
    assert long["groups_sha256"] == hashlib.sha256(aligner.texts([LONG])[0][4]).hexdigest() and long["n_links"] > 20_000
