"""Line deduplication, vector codes and the Merkle manifest against plain versions, and on awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastra.llm import lines, merkle, queries, vectors
from tests.conftest import SF
from tests.llm import brute
from tests.llm.test_corpus import DOCS, awkward, empty, no_ids, pairs, small  # noqa: F401

EVERY = pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])


# Lines


def cut_rows(found):
    return pairs(found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept")), "doc_id", "n_lines", "n_dropped", "kept")


def line_texts(rng, n):
    shared = [f"a line that several share {i}" for i in range(12)] + ["\tA LINE that several share 3 ", "short", "äöüäöüäöü", "äöüäöüäöüß", "日本語の行です十文字"]
    parts = lambda: [rng.choice(shared) if rng.random() < 0.6 else f"own line {rng.randrange(10**6)}" for _ in range(rng.randrange(0, 12))]
    return [rng.choice(["\n", "\r\n"]).join(parts()) for _ in range(n)] + [None, "", "\n", "\n\n", "one line alone of some length"]


@EVERY
def test_repeated_lines(request, kind):
    docs = request.getfixturevalue(kind)
    assert cut_rows(lines.drop_repeated_lines(docs)) == sorted(brute.cut_lines([(r["doc_id"], r["text"]) for r in docs.collect()]), key=str)


@pytest.mark.parametrize("sizes", [{}, {"shard_keys": 3, "task_lines": 5}, {"shard_keys": 1, "task_lines": 1}])
def test_repeated_lines_of_many_shards_and_tasks(spark, sizes):
    rng = random.Random(3)
    rows = [(i // 2 if i % 40 == 1 else i, t) for i, t in enumerate(line_texts(rng, 120))] + [(None, "a line that several share 1\nx"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({"row": F.lit(1), "kept": F.lit("x"), "shard": F.lit(None).cast("int")})
    assert cut_rows(lines.drop_repeated_lines(docs, **sizes)) == sorted(brute.cut_lines(rows), key=str)


def test_repeated_lines_of_three_documents(spark):
    rows = [(i, f"line of everyone in here\nline of some, number {i // 3}\nline of two only, number {i // 2}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert cut_rows(lines.drop_repeated_lines(docs, min_docs=3)) == sorted(brute.cut_lines(rows, min_docs=3), key=str)


def test_repeated_lines_query(spark, small):  # noqa: F811
    got = pairs(queries.op11_line_dedup(spark, SF), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == sorted(brute.cut_lines([(r["doc_id"], r["text"]) for r in small.collect()]), key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, (n, 2), dtype=np.uint64)
    keys[: n // 2, 0] = 7  # told apart by the other column alone
    hashed = lines.PerfectHash.build(keys)
    assert sorted(hashed.find(keys).tolist()) == list(range(n))
    other = hashed.find(rng.integers(0, 1 << 63, (1000, 2), dtype=np.uint64))
    assert other.min(initial=0) >= -1 and other.max(initial=-1) < max(n, 1)


# Vectors


def vector_rows(rng, n, width=16, wide=1.0):
    rows = [(i, [float(np.float32(rng.gauss(0, wide))) for _ in range(width)], rng.choice([None, 1, 2, 3])) for i in range(n)]
    return rows + [(n, None, 1), (n + 1, [0.5] * (width - 1) + [None], 1), (n + 2, [float("nan")] * width, 2), (n + 3, [float("inf")] * width, 2), (n + 4, [], 2), (3, rows[3][1], 1), (None, rows[4][1], 1)]


@pytest.mark.parametrize(("n", "wide"), [(200, 1.0), (60, 0.001), (5, 1.0), (40, 7000.0)])
def test_vector_codes(spark, n, wide):
    rows = vector_rows(random.Random(n), n, wide=wide)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).withColumns({"part": F.lit(1), "nth": F.lit("x"), "code": F.lit(2)})
    coded, books = vectors.compress_vectors(df)
    wanted, digest = brute.vector_codes(rows)
    assert pairs(coded, "vec_id", "code", "error", "label_error") == sorted(wanted, key=str)
    assert vectors.books_sha256(books) == digest


def test_vectors_of_one_kind_and_none(spark):
    same = [(i, [0.25, -0.25] * 8, "x") for i in range(40)]
    coded, books = vectors.compress_vectors(spark.createDataFrame(same, "vec_id long, embedding array<double>, label string"))
    assert pairs(coded, "code", "error", "label_error") == [("00" * 8, 0, 0)] * 40
    for rows in ([], [(None, [1.0] * 16, None)], [(1, None, None)]):
        coded, books = vectors.compress_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
        assert coded.collect() == [] and books == []


@pytest.mark.parametrize("bad", [[1.0] * 15, [1.0] * 24, [40000.0] * 16])
def test_vectors_that_cannot_be_coded_are_an_error(spark, bad):
    rows = [(i, [float(i)] * 16, 1) for i in range(4)] + [(9, bad, 1)]
    with pytest.raises(Exception, match="one length|smaller than"):
        vectors.compress_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))[0].collect()


def test_vantage_tree_equals_all_distances():
    rng = np.random.default_rng(1)
    for n, wide in ((1, 5), (2, 2), (16, 2), (16, 1000), (256, 3), (256, 1 << 26)):
        entries, points = rng.integers(-wide, wide, (n, 8)), rng.integers(-wide, wide, (500, 8))
        away = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        index, best = vectors.VantageTree(entries).nearest(points)
        assert (index == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def test_vector_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    wanted, digest = brute.vector_codes(rows)
    got = pairs(queries.op12_vector_codes(spark, SF), "vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert got == sorted(((*w, digest) for w in wanted), key=str)


# Merkle manifest


def manifest_rows(docs, **options):
    proofs = merkle.dataset_manifest(docs, **options).proofs
    folded = proofs.withColumns({"proof": merkle.proof_digest(F.col("path")), "folded": merkle.fold(F.col("altered"), F.col("path"))})
    return pairs(folded.withColumn("same", F.col("folded") == F.col("root")), "doc_id", "leaf", "subroot", "root", "proof", "folded", "same")


def plain(docs, **options):
    return sorted(brute.merkle([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()], **options), key=str)


@EVERY
def test_manifest(request, kind):
    docs = request.getfixturevalue(kind)
    wide = docs.withColumns({"tree": F.lit(1), "digest": F.lit(2), "path": F.lit(None).cast("string"), "at": F.lit(0)})
    assert manifest_rows(wide) == plain(docs)


@pytest.mark.parametrize(("n", "fanout", "rows_a_part"), [(1, 16, 1), (16, 16, 3), (17, 16, 1000), (257, 16, 7), (130, 2, 5), (81, 3, 4)])
def test_manifest_of_any_size(spark, n, fanout, rows_a_part):
    sources = [None, "", "a", "b", "é"]
    rows = [(i * 3, f"Text {i}", "en", sources[0 if i % 3 else i % 5], i) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert manifest_rows(docs, fanout=fanout, rows_a_part=rows_a_part) == plain(docs, fanout=fanout)


def test_manifest_nodes(spark):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(100)]
    made = merkle.dataset_manifest(spark.createDataFrame(rows, DOCS), fanout=4, rows_a_part=9)
    levels = brute.levels_of([brute.leaf_digest((i, "s", "en", i, f"Text {i}")) for i in range(100)], 4)
    wanted = [("s", k, i, d) for k, level in enumerate(levels) if k for i, d in enumerate(level)]
    assert sorted(map(tuple, made.nodes.select("source", "level", "at", "digest").collect())) == wanted
    assert made.root == levels[-1][0] and made.leaves.count() == 100


def test_manifest_query(spark, small):  # noqa: F811
    got = pairs(queries.op13_merkle(spark, SF), "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert got == plain(small)
    assert 0 < sum(not r[-1] for r in got) < len(got)
