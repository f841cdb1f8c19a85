"""The corpus operators and their queries against plain versions, and on awkward rows."""

import hashlib
import io
import math
import random
import time
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rastra.llm import decontaminate, langid, media, mixing, near, queries, sharding, simhash, substrings, tokens, toxicity, urlfilter
from tests.conftest import SF
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(5)
    passage, long = sentence(rng, 70), sentence(rng, 30_000, 5000)
    texts = [
        None, "", " \t\n", "one", "One two THREE", passage, passage, f"before {passage} after", passage.upper(),
        f"{passage[:200]} {sentence(rng, 60)}", long, f"{long} {passage}", "ünï cödé " * 30, "日本語 " * 80, "a\u00a0b \x0b c\x1cd",
        sentence(rng, 100), " ".join(["same"] * 300), " ".join(["same"] * 200),
    ]
    rows = [(i, t, ["en", "de", None][i % 3], ["web", "book", None, "chat"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [(40, passage, "en", "web", 1), (40, passage, "en", "web", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def no_ids(spark, awkward):
    return awkward.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def ids_and_texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


# SimHash


def as_rows(found):
    return pairs(found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("f"), "component_id"), "doc_id", "f", "component_id")


@pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])
def test_simhash_groups(request, kind):
    docs = request.getfixturevalue(kind)
    assert as_rows(simhash.near_duplicate_groups(docs)) == sorted(brute.simhash_groups(ids_and_texts(docs)), key=str)


def test_simhash_query(spark, small):
    got = pairs(queries.op1_simhash(spark, SF), "doc_id", "fingerprint", "component_id")
    assert got == sorted(brute.simhash_groups(ids_and_texts(small)), key=str)


def test_links_within_a_large_list_are_whole(spark):
    """Many fingerprints that share four bytes, compared in blocks."""
    rng = random.Random(1)
    prints = list({0x1122334400000000 | rng.getrandbits(9) << 8 | rng.getrandbits(3) for _ in range(400)})
    nodes = spark.createDataFrame([(p, p) for p in prints], "node long, f0 long")
    links = simhash.near_links(nodes, block_rows=64)
    got = {r["id"]: r["component"] for r in simhash.connected_components(links).collect()}
    parent = {p: p for p in prints}
    for _ in prints:
        before = dict(parent)
        for a in prints:
            parent[a] = min(parent[b] for b in prints if (a ^ b).bit_count() <= 4)
        if before == parent:
            break
    assert {p: got.get(p, p) for p in prints} == parent


def test_near_duplicates_of_several_repetitions(spark):
    rng = random.Random(8)
    rows = []
    for i in range(20):
        words = sentence(rng, 300).split()
        near = words.copy()
        near[150] = "changed"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(near))]
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, f0 string, component_id int")
    kept = simhash.drop_near_duplicates(docs, shingle=5, reps=4, min_match=2, max_bits=27)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 40, 2))


@pytest.mark.parametrize("lossy", [{"reps": 4, "min_match": 3, "max_bits": 42}, {"min_match": 5}, {"max_bits": 8, "min_match": 1}, {"min_match": 0}])
def test_parameters_that_lose_links_are_refused(spark, small, lossy):
    with pytest.raises(ValueError, match="guarantee"):
        simhash.drop_near_duplicates(small, **lossy)


@pytest.mark.parametrize("all_linked", [False, True])
def test_near_duplicates_stay_by_row(spark, all_linked):
    rng = random.Random(9)
    a, b, c, d, e, f = (sentence(rng, 80, 5000) for _ in range(6))
    rows = [(None, a), (None, b), (None, c), (1, c), (None, d), (None, d), (5, e), (5, f), (5, f), (3, f)]
    rows = [r for r in rows if not all_linked or r[1] in (c, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(1, c), (None, d)] + ([] if all_linked else [(None, a), (None, b), (5, e), (3, f)])
    assert pairs(simhash.drop_near_duplicates(docs), "doc_id", "text") == sorted(want, key=str)


def held_against_jaccard(spark, texts):
    import corpus_pipeline

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect())
    assert got == sorted(set(brute.jaccard_groups(texts)))
    return docs, got


def test_pipeline_near_duplicates_equal_jaccard(spark):
    """Pairs of all similarities, a large group of near copies of one text, and texts that share a line."""
    rng = random.Random(10)
    texts, line, base = ["", None, "one", "ONE  "], sentence(rng, 12), sentence(rng, 60, 5000).split()
    for i in range(150):
        words = sentence(rng, rng.choice([12, 40, 150]), 5000).split()
        other = words.copy()
        for _ in range(rng.randrange(1, max(2, len(words) // 18))):
            other[rng.randrange(len(words))] = "changed"
        texts += [" ".join(words), " ".join(other)]
        texts.append(f"{line} {sentence(rng, 30, 5000)}")
        copy = base.copy()
        for _ in range(rng.randrange(1, 4)):
            copy[rng.randrange(60)] = f"x{i}"
        texts.append(" ".join(copy))
    docs, got = held_against_jaccard(spark, texts)
    assert sorted(r["doc_id"] for r in near.drop_near_duplicates(docs, block_rows=20).collect()) == got


def test_pipeline_near_duplicates_go_through_simhash(spark, monkeypatch):
    """Fingerprints are op1's, what they link is settled by the sets, and only pairs that they miss are left to the prefixes."""
    import corpus_pipeline

    rng = random.Random(12)
    texts = [sentence(rng, 400, 5000) for _ in range(30)]
    texts += [t + " end" for t in texts]
    for t in [*texts[:3], "", None, "one"]:
        raw = t if t is None else t.encode()
        hashes = np.concatenate([np.empty(0, np.uint64), *simhash._shingle_hashes(raw or b"", 5)])
        assert simhash.fingerprint_of(hashes) % 2**64 == simhash.fingerprint(raw, 5)[0]
    settled, found = [], near._settled
    monkeypatch.setattr(near, "_settled", lambda pairs, *rest: settled.append(out := found(pairs, *rest)) or out)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()) == list(range(30))
    assert settled[0].count() >= 20  # by bits
    assert settled[0].count() + settled[1].count() == 30


def test_pipeline_near_duplicates_of_short_texts(spark):
    rng = random.Random(11)
    short = [sentence(rng, n + 4, 5000) for n in (4, 6, 8, 10) for _ in range(15)]
    docs, got = held_against_jaccard(spark, [t for text in short for t in (text, text + " more")])
    assert got == list(range(0, 120, 2))


def test_pipeline_keeps_chains_of_distant_texts(spark):
    """Texts that differ from the one before in ten words on end, 14 of 100 shingles: a similarity of 0.75."""
    rng = random.Random(12)
    chain = [sentence(rng, 104, 5000).split()]
    for i in range(40):
        words = chain[-1].copy()
        at = rng.randrange(4, 90)
        words[at : at + 10] = sentence(rng, 10, 5000).split()
        chain.append(words)
    docs, got = held_against_jaccard(spark, [" ".join(w) for w in chain])
    assert got == list(range(41))


# Sharding


@pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])
def test_sharding(request, kind):
    docs = request.getfixturevalue(kind).withColumn("shard", F.lit("clash")).withColumn("key", F.lit(1))
    out = sharding.shard_by_bytes(docs, n_shards=4).collect()
    assert len(out) == docs.count()
    for r in out:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    for shard in {r["shard"] for r in out}:
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_sharding_is_even_with_many_copies(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy " * 20).otherwise(F.concat(F.lit("t" * 80), "id")).alias("text"))
    out = sharding.shard_by_bytes(docs, n_shards=40, cell_bytes=1 << 14)
    sizes = [r["s"] for r in out.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 40 and max(sizes) <= 1.03 * min(sizes)
    assert out.select("shard", "slot").distinct().count() == 6000
    assert pairs(out, "doc_id", "shard", "slot") == pairs(sharding.shard_by_bytes(docs.repartition(7), 40, cell_bytes=1 << 14), "doc_id", "shard", "slot")


def test_sharding_into_many_cells(spark):
    """The plan is the same for any number of cells, and shards are those of large cells but for a splitter's tolerance."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy " * 20).otherwise(F.concat(F.lit("t" * 80), "id")).alias("text"))
    many, few = (sharding.shard_by_bytes(docs, 8, cell_bytes=n) for n in (1 << 8, 1 << 20))
    assert abs(len(many._jdf.queryExecution().optimizedPlan().toString()) - len(few._jdf.queryExecution().optimizedPlan().toString())) < 200
    rows = many.collect()
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 0.02 * max(sizes.values())
    for shard in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_sharding_query(spark, small):
    out = queries.op2_sharding(spark, SF).collect()
    rows = {r["doc_id"]: (r["text"] or "").encode() for r in small.collect()}
    assert sorted(r["doc_id"] for r in out) == sorted(rows)
    shards, places = Counter(), {}
    for r in out:
        raw = rows[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        shards[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append((r["slot"], raw))
    fair = sum(shards.values()) / 40
    assert set(shards) <= set(range(40)) and all(abs(n - fair) <= max(0.01 * fair, max(len(t) for t in rows.values())) for n in shards.values())
    in_order = []
    for shard in sorted(places):
        assert [slot for slot, _ in sorted(places[shard])] == list(range(len(places[shard])))
        in_order += [raw for _, raw in sorted(places[shard])]
    assert sum(a != b for a, b in zip(in_order, in_order[1:])) == len(set(rows.values())) - 1  # equal texts are neighbours


# Media


@pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])
def test_media(request, kind):
    docs = request.getfixturevalue(kind)
    got = pairs(media.stored_media(docs), "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32")
    assert got == sorted((brute.media(d, t) for d, t in ids_and_texts(docs)), key=str)


def test_media_query(spark, small):
    got = queries.op3_media(spark, SF)
    assert pairs(got, "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == sorted((brute.media(d, t) for d, t in ids_and_texts(small)), key=str)


@pytest.mark.parametrize("kind", ["small", "awkward"])
def test_media_files_and_features(request, kind):
    """The stored files byte for byte; hashes and tiles against exact means over areas."""
    docs = request.getfixturevalue(kind).where("length(text) < 3000 OR text IS NULL").limit(60)
    rows = media.stored_media(docs).withColumnRenamed("doc_id", "id").join(docs, F.col("id").eqNullSafe(F.col("doc_id"))).collect()
    assert len({r["media_bytes"] > 1078 + 576 for r in rows}) == 2
    for r in rows:
        file = brute.media_file(r["text"])
        assert (r["media_bytes"], r["media_sha256"], r["error"]) == (len(file), hashlib.sha256(file).hexdigest(), None)
        small = [[round(m) for m in line] for line in brute.mean_grid(r["text"], 8, 9)]
        bits = "".join(str(int(b > a)) for line in small for a, b in zip(line, line[1:]))
        assert r["feature"] == f"{int(bits, 2):016x}"
        tile = np.load(io.BytesIO(r["tile"]))
        assert np.array_equal(tile, [[round(m) for m in line] for line in brute.mean_grid(r["text"], 16, 16)])


@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (17, 24), (4, 7, 3)])
def test_images_survive_a_round_trip(shape):
    image = np.random.default_rng(2).integers(0, 256, shape, dtype=np.uint8)
    for encode, decode in ((media.encode_netpbm, media.decode_netpbm), (media.encode_bmp, media.decode_bmp)):
        assert np.array_equal(decode(encode(image)), image)


def test_text_forms_of_netpbm():
    assert media.decode_netpbm(b"P2 # grey\n2 1\n255\n7 200\n").tolist() == [[7, 200]]
    assert media.decode_netpbm(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert media.decode_netpbm(b"P4 3 1\n\xa0").shape == (1, 3)


def test_area_resize_is_the_mean_of_what_each_pixel_covers():
    image = np.random.default_rng(3).integers(0, 256, (12, 18), dtype=np.uint8)
    assert np.array_equal(media.area_resize(image, 4, 6), np.rint(image.reshape(4, 3, 6, 3).mean(axis=(1, 3))).astype(np.uint8))
    assert np.array_equal(media.area_resize(image, 12, 18), image)
    tile = np.load(__import__("io").BytesIO(media.npy_tile(image, 8)))
    assert tile.shape == (8, 8) and len(media.difference_hash(image)) == 16


def test_broken_media_give_an_error_and_no_failure(spark):
    files = spark.createDataFrame([(1, None), (2, bytearray(b"P5 9")), (3, bytearray(b"")), (4, bytearray(media.encode_bmp(np.zeros((2, 2), np.uint8))))], "id int, media binary")
    out = {r["id"]: r["found"] for r in media.media_features(files).collect()}
    assert [out[i]["error"] is None for i in (1, 2, 3, 4)] == [False, False, False, True]
    empty = bytearray(media.encode_bmp(np.zeros((2, 2), np.uint8)))
    empty[18:26] = bytes(8)
    broken = [b"P5 0 0 255 ", b"P5 0 3 255 ", b"P2 1 1 255 12345678901234567890", b"P5 1 1 70000 ab", b"P5 99999999999 9999999999 255 a", bytes(empty), b"BM", b"P4 3 1"]
    files = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(broken)], "id int, media binary")
    assert media.media_features(files).where("found.error IS NULL OR found.feature IS NOT NULL").isEmpty()


# Toxicity


@pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])
def test_toxicity_takes_any_rows(spark, request, kind):
    docs = request.getfixturevalue(kind)
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (15, None, None), (None, 1, 1), (16, 1, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        out = toxicity.score_toxicity(docs, known).collect()
        assert len(out) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)


def test_toxicity_on_rows_never_learned_from(spark):
    """Held-out recall and false alarms; that no document is toxic would be found wrong."""
    sf = SF.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    scored = queries.op4_toxicity(spark, sf).where("held_out")
    rows = scored.join(labels, "doc_id").join(docs, "doc_id").collect()
    toxic, clean = ([r for r in rows if r["toxic"] == y] for y in (1, 0))
    assert len(toxic) > 80 and sum(r["predicted"] for r in toxic) >= 0.65 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    found = Counter(r["lang"] for r in toxic if r["predicted"])
    assert all(found[lang] for lang in ("en", "de", "fr", "es")) and found["en"] >= 0.75 * sum(r["lang"] == "en" for r in toxic)


def test_dictionaries_of_two_classes_hold_what_sets_them_apart():
    rng = random.Random(4)
    plain = [f" {sentence(rng, 60)} ".encode() for _ in range(80)]
    marked = [p.replace(b" w1", b" zyxwvut w1") for p in plain[:40]]
    toxic, ordinary = toxicity.train_dictionaries([toxicity._words(m) for m in marked], [toxicity._words(p) for p in plain[40:]])
    assert b"zyxwvut" in toxic and b"zyxwvut" not in ordinary


def test_pairs_of_many_common_lists_leave_once(spark, monkeypatch):
    """Sets that meet in twenty lists and stay in different components; rows are counted before they are made distinct."""
    width = len(near._LONGS)
    sets = [(node, 100, node, *[0] * width, b"\0" * 128, *range(near._FIRST)) for node in range(40)]
    kinds = ["node: long", "n: long", "component: long", *[f"{c}: long" for c in near._LONGS], "parity: binary", *[f"list{i}: long" for i in range(near._FIRST)]]
    groups = spark.createDataFrame([(key, sets) for key in range(20)], f"key long, members array<struct<{', '.join(kinds)}>>")
    monkeypatch.setattr(type(groups), "distinct", lambda rows: rows)
    assert near._candidates(groups, Fraction(4, 5), True, 16).count() == 40 * 39 // 2
    a = np.array([list(range(near._FIRST))] * 3)
    assert not near._met_before(0, a, a).any() and near._met_before(1, a, a).all() and not near._met_before(19, a, a + 100).any()


def test_toxic_stems_are_found_under_any_ending():
    """Most toxic texts have plain insults, some a stem of four letters under many endings, made of ordinary syllables."""
    rng = random.Random(5)
    syllables = "re tion ou le que men tre ai pa vi en on eau ier elle ment oi ch an de ro ni qu lu sa to mi ba".split()
    insults = "loser idiot pathetic scum moron clown worthless disgusting trash stupid".split()

    def text(kind: str) -> bytes:
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(200)]
        for at in rng.sample(range(len(words)), 0 if kind == "clean" else 3):
            words[at] = rng.choice(insults) if kind == "plain" else rng.choice(("vequ", "veju")) + "".join(rng.choices(syllables, k=rng.randint(1, 2)))
        return " ".join(words).encode()

    toxic = [text("plain") for _ in range(120)] + [text("stem") for _ in range(30)]
    rng.shuffle(toxic)
    model = toxicity.ToxicityModel(toxic, [text("clean") for _ in range(600)])
    for kind, least, most in (("plain", 90, 100), ("stem", 75, 100), ("clean", 0, 2)):
        assert least <= sum(model.score(text(kind)) >= 0.5 for _ in range(100)) <= most


def test_toxic_documents_go_and_columns_stay(spark, small):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = small.withColumn("score", F.lit("clash")).withColumn("row", F.lit(1))
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    rejected = {r["doc_id"] for r in toxicity.score_toxicity(small, labels).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in small.collect()} - rejected


# Tokens


def encoded(docs):
    from tokenizers import Tokenizer

    tokenizer, start, out = Tokenizer.from_file(queries.tokenizer_file()), 0, []

    def order(row):
        h = 42 if row[1] is None else xxhash.xxh64_intdigest(row[1].encode(), 42)
        return row[0] is not None, row[0] or 0, h - (h >> 63 << 64)

    for d, t in sorted(docs, key=order):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
@pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])
def test_tokens(request, kind, encoding):
    docs = request.getfixturevalue(kind)
    written = tokens.write_tokens(docs, queries.tokenizer_file(), encoding=encoding, group_tokens=1000)
    assert pairs(tokens.token_digests(*written), "doc_id", "start", "n_tokens", "ids_crc32") == encoded(ids_and_texts(docs))


def test_tokens_query(spark, small):
    assert pairs(queries.op5_tokens(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == encoded(ids_and_texts(small))


def test_token_files_have_pages_indexed_and_selective_reads(spark, small):
    import pyarrow.parquet as pq

    path, manifest = tokens.write_tokens(small, queries.tokenizer_file(), group_tokens=5000)
    files = [r["file"] for r in manifest.collect()]
    chunk = pq.ParquetFile(files[0]).metadata.row_group(0).column(0)
    assert chunk.has_offset_index and chunk.has_column_index and chunk.statistics.has_min_max
    some = tokens.read_tokens(manifest, ("doc_id", "n_tokens")).where("doc_id < 10")
    assert some.count() == small.where("doc_id < 10").count()


def test_a_second_attempt_is_not_read(spark, small):
    path, _ = tokens.write_tokens(small, queries.tokenizer_file())
    _, manifest = tokens.write_tokens(small, queries.tokenizer_file(), path=path)
    assert spark.read.parquet(path).count() == 2 * small.count()
    assert tokens.read_tokens(manifest).count() == small.count() == tokens.token_digests(path, manifest).count()
    assert tokens.read_tokens(manifest.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["a b", " a", "a  b", "a \u00a0 b", "it's 3 o'clock", "<|endoftext|> x", "x\ny z", "é è", "\u2003a b\u2003 c", "a\u0085 b", "tab\t x", "one <|endoftext|> two", "a<|endoftext|>"])
def test_chunked_encoding_equals_the_tokenizers_own(text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_file())
    encoder = tokens.ChunkEncoder(queries.tokenizer_file())
    for repeat in (1, 50, 400_000 // len(text)):
        whole = " ".join([text] * repeat)
        for got in encoder.encode([whole.encode(), whole.encode()]):
            assert got.tolist() == plain.encode(whole, add_special_tokens=False).ids


def test_chunks_of_one_hash_keep_their_own_ids():
    """A Thue-Morse word and its complement collide in any polynomial hash modulo a power of two."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_file())
    for n in (1024, 2048, 4096):
        one = "".join("ab"[i.bit_count() % 2] for i in range(n))
        other = one.translate(str.maketrans("ab", "ba"))
        encoder = tokens.ChunkEncoder(queries.tokenizer_file())
        texts = [f"x {one} y", f"x {other} y", f"{other} {one} z", f"x {other} {other}"]
        assert [g.tolist() for g in encoder.encode([t.encode() for t in texts])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert encoder.encode([texts[1].encode()])[0].tolist() == plain.encode(texts[1], add_special_tokens=False).ids


def test_known_chunks_take_few_bytes_each_and_old_ones_are_forgotten():
    import tracemalloc

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_file())
    rng = random.Random(3)
    encoder = tokens.ChunkEncoder(queries.tokenizer_file(), limit=60_000)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=8)) for _ in range(25_000)) for _ in range(4)]
    encoder.encode([b"a " * 300_000])  # the powers of the hash's base are there once, whatever is known
    encoder.encode([texts[0].encode()])
    tracemalloc.start()
    encoder.encode([t.encode() for t in texts[1:3]])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held / 75_000 < 100
    for t in (texts[3], texts[0], texts[3]):  # over the limit: all is learned anew
        assert encoder.encode([t.encode()])[0].tolist() == plain.encode(t, add_special_tokens=False).ids


def test_texts_reach_the_encoder_in_small_batches(spark, awkward, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, settle = spark.conf.get(name), tokens.settle
    monkeypatch.setattr(tokens, "settle", lambda df, n: seen.append(int(spark.conf.get(name).rstrip("b"))) or settle(df, n))
    path, manifest = tokens.write_tokens(awkward, queries.tokenizer_file())
    assert max(seen) <= 8 << 20 and spark.conf.get(name) == before
    assert tokens.token_digests(path, manifest).count() == awkward.count()


# Substrings


@pytest.mark.parametrize("kind", ["awkward", "empty"])
def test_repeats(request, kind):
    docs = request.getfixturevalue(kind)
    cut = substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(brute.cut_repeats(ids_and_texts(docs)), key=str)


def test_repeats_of_rows_without_an_id(no_ids):
    cut = substrings.remove_repeats(no_ids)
    assert cut.count() == no_ids.count()
    assert cut.where("doc_id IS NULL AND n_removed > 0").isEmpty()


def test_repeats_of_rows_that_share_an_id(spark):
    p, q, r = (" ".join(f"{c}{i}" for i in range(60)) for c in "pqr")
    docs = [(1, p), (3, q), (40, p), (40, f"x {q} y"), (40, f"u {r} v"), (40, f"u {r} v"), (50, f"a {r} b"), (50, f"{r} {p} {r}")]
    cut = substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted(map(tuple, cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()), key=str)
    assert got == sorted(brute.cut_repeats(docs), key=str)
    assert {(r["doc_id"], r["n_removed"]) for r in cut.collect()} >= {(40, 60), (40, 0), (50, 60), (50, 180)}


def test_repeats_query(spark, small):
    got = pairs(queries.op6_substrings(spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.cut_repeats(ids_and_texts(small)), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_repeats_at_random(spark, seed):
    """Short windows over few words: many classes of one seed, overlaps, and repeats within a document."""
    rng = random.Random(seed)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(40)]
    cut = substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), window=8, seed=3)
    got = sorted(map(tuple, cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()), key=str)
    assert got == sorted(brute.cut_repeats(docs, 8), key=str)


# Decontamination


ITEMS = "item_id long, text string"


def found_rows(df):
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", digest, F.col("n_hit") > 0).collect()), key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 50])
@pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])
def test_contamination(spark, request, kind, block_bytes):
    docs = request.getfixturevalue(kind)
    some = [t for _, t in ids_and_texts(request.getfixturevalue("awkward"))]
    items = [(1, " ".join(some[5].split()[5:30])), (2, "two three"), (3, None), (4, ""), (5, "same " * 12), (6, "same " * 12), (10, some[15]), (None, "one two")]
    got = decontaminate.find_contamination(docs, spark.createDataFrame(items, ITEMS), block_bytes=block_bytes, shard_words=500)
    named = [("" if i is None else i, t) for i, t in items]
    assert found_rows(got) == sorted(brute.contamination(ids_and_texts(docs), named), key=str)


def test_ten_blocks_find_what_one_does(spark, small):
    """Blocks by hash, several shards to a load, and batches that end within a shard."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0]
    one, ten = (found_rows(decontaminate.find_contamination(small, items, block_bytes=b, shard_words=700)) for b in (8 << 20, size // 9))
    assert one == ten and any(r[2] for r in one)


def test_a_block_is_written_as_arrays():
    items = [("a", b"one two three four"), ("", b""), ("b", b"three four"), ("\u00e9", b"one two three four five six"), ("b", b"three four")]
    made = decontaminate.TestSuffixes.of(items, 3)
    read = decontaminate.TestSuffixes.parse(made.dump())
    assert read.names == made.names and read.vocab == made.vocab and read.shortest == 2
    windows = [tuple(made.words[w - 1].decode() for w in made.flat[made.run(k)[0]:][: made.sizes[k]]) for k in range(len(made.first))]
    assert windows == [tuple(w.split()) for w in ("one two three", "two three four", "three four", "three four five", "four five six")]
    assert [sorted(read.item_of(read.run(k)).tolist()) for k in range(5)] == [[0, 3], [0, 3], [2, 4], [3], [3]]


def test_contamination_without_items(spark, awkward):
    assert decontaminate.decontaminate(awkward, spark.createDataFrame([], ITEMS)).count() == awkward.count()


def test_longest_matches_and_their_places(spark):
    docs = spark.createDataFrame([(1, "x y " + " ".join(f"t{i}" for i in range(15)) + " z", "clash")], "doc_id long, text string, matches string")
    items = spark.createDataFrame([(7, "q " + " ".join(f"t{i}" for i in range(20)))], ITEMS)
    (match,) = decontaminate.find_contamination(docs, items).first()["matches"]
    assert match.asDict() == {"item_id": "7", "item_at": 1, "doc_at": 2, "words": 15}


def test_long_runs_of_one_word_take_no_pairs(spark):
    docs = spark.createDataFrame([(1, "same " * 100_000), (2, "other same " * 5)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "same " * 10_000), (8, "a " + "same " * 10_000 + "b")], ITEMS)
    began = time.monotonic()
    rows = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, items).collect()}
    assert time.monotonic() - began < 40
    assert (rows[1]["n_hit"], rows[1]["item_ids"], rows[2]["n_hit"]) == (100_000, ["7", "8"], 0)
    assert all(m["words"] == 10_000 for m in rows[1]["matches"][:-1]) and len(rows[1]["matches"]) == 11


def test_every_hit_word_lies_in_a_longest_match(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(80)))) for i in range(40)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(30)))) for i in range(12)]
    words = {i: t.split() for i, t in items}
    found = decontaminate.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), window=4)
    assert found_rows(found) == sorted(brute.contamination(docs, items, 4), key=str)
    for r in found.collect():
        text, held = r["text"].split(), set()
        for m in r["matches"]:
            place = text[m["doc_at"] :]
            length = lambda i, at: next((n for n, (x, y) in enumerate(zip(place, words[i][at:])) if x != y), min(len(place), len(words[i]) - at))
            windows = [(i, at) for i, w in words.items() for at in range(len(w) - min(4, len(w)) + 1 if w else 0) if length(i, at) >= min(4, len(w))]
            assert m["words"] == length(int(m["item_id"]), m["item_at"]) == max(length(i, at) for i, at in windows)
            held |= set(range(m["doc_at"], m["doc_at"] + m["words"]))
        assert len(held) == r["n_hit"]


def test_decontamination_query(spark, small):
    got = pairs(queries.op7_decontamination(spark, SF), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    items = ids_and_texts(spark.read.parquet(f"{SF}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    assert got == sorted(brute.contamination(ids_and_texts(small), items), key=str)


# Mixing


def test_targets_stop_at_the_ceiling():
    assert mixing.water_fill({"a": 10, "b": 100, "c": 100}, {"a": 5, "b": 2, "c": 1}, 150) == pytest.approx({"a": 20, "b": 130 * 2 / 3, "c": 130 / 3})
    assert mixing.water_fill({"a": 10}, {"a": 1}, 50) == {"a": 20}
    assert mixing.water_fill({"a": 0}, {"a": 1}, 0) == {"a": 0}


@pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])
def test_mixing_takes_any_rows(request, kind):
    docs = request.getfixturevalue(kind).withColumn("size", F.lit("clash")).withColumn("grp", F.lit(2)).withColumn("id", F.lit(2))
    out = mixing.mix_sources(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r["size"] == len(brute.words(r["text"])) and 0 <= r["copies"] <= 2
    taken = mixing.take_mix(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r["copies"] for r in out)


def test_alike_rows_share_their_copies(spark):
    rows = [(1, "a b c", "s", k) for k in range(40)] + [(None, "d e", "s", k) for k in range(30)] + [(i, f"w{i} x", "t", 0) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, k int")
    found = pairs(mixing.mix_sources(docs), "doc_id", "text", "k", "copies")
    assert found == pairs(mixing.mix_sources(docs.repartition(5)), "doc_id", "text", "k", "copies")
    for doc in (1, None):
        copies = [r[3] for r in found if r[0] == doc]
        assert max(copies) - min(copies) <= 1
    out = mixing.mix_sources(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()
    assert len(out) == 2 and all(abs(r["taken"] - r["target"]) <= 3 for r in out)


def test_mixing_query(spark, small):
    out = queries.op8_mixing(spark, SF).collect()
    rows = {r["doc_id"]: r for r in small.collect()}
    sizes, taken, goal = Counter(), Counter(), {}
    for r in out:
        source = rows[r["doc_id"]]["source"]
        assert r["size"] == len(brute.words(rows[r["doc_id"]]["text"])) and r["taken"] <= 2 * r["size"]
        sizes[source] += r["size"]
        taken[source] += r["taken"]
        goal[source] = r["target"]
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = mixing.water_fill(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(ordered)}, 1.5 * sum(sizes.values()))
    assert goal == pytest.approx(wanted)
    biggest = max(r["size"] for r in out)
    assert all(abs(taken[s] - goal[s]) <= max(0.01 * goal[s], biggest / 2) for s in sizes)
    assert pairs(queries.op8_mixing(spark, SF), "doc_id", "taken") == sorted(((r["doc_id"], r["taken"]) for r in out), key=str)


def test_rounding_keeps_each_units_expectation(spark):
    units = spark.range(4000).select(F.lit("g").alias("grp"), "id", F.lit(0).cast("long").alias("nth"), (F.lit(1.0) + F.col("id") % 7).alias("weight"), F.lit(0.3).alias("mass"))
    rows = {r["id"]: r["copy"] for r in mixing.pivotal_round(units, block_rows=64).collect()}
    assert len(rows) == 4000 and set(rows.values()) <= {0, 1}
    weight = {i: 1 + i % 7 for i in range(4000)}
    assert abs(sum(weight[i] * c for i, c in rows.items()) - 0.3 * sum(weight.values())) <= 4
    for k in range(7):
        share = np.mean([c for i, c in rows.items() if i % 7 == k])
        assert abs(share - 0.3) < 0.08


# URL filters


def test_url_filter_rows(spark):
    urls = [
        None, "", "no scheme", "http://", "https://EXAMPLE.com/en/a", "https://www.example.com/en/a?b", "http://x.example.com/en/", "http://example.com/EN/",
        "http://example.com/en", "ftp://a.net/es/x#y", "http://net/fr/", "http://notnet/fr/", "http://u:p@b.net/fr/?q", "http://c.com", "x://y.com/://z", "http://a.net/es",
        "http://\u00dc.com/en/", "http://a.net./es/", "HTTP://A.NET/es/", "http://A.net\n/es/",
    ]
    pages = spark.createDataFrame([(i % 5 if i % 6 else None, u, "h", "clash") for i, u in enumerate(urls + urls[4:8])], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, action string")
    got = pairs(urlfilter.filter_urls(pages, rules), "url", "host", "path", "rule", "verdict")
    assert got == sorted(((u, *brute.url_verdict(u, queries.URL_RULES)) for u in urls + urls[4:8]), key=str)
    assert {r["verdict"] for r in urlfilter.filter_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert urlfilter.filter_urls(pages.limit(0), rules).isEmpty()


def test_url_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = pairs(queries.queries()["op9_url_filter"](spark, SF), "page_id", "host", "path", "rule", "verdict")
    assert got == sorted(((r["page_id"], *brute.url_verdict(r["url"], queries.URL_RULES)) for r in pages), key=str)


def test_bloom_filter_has_no_false_negatives(spark):
    """Large lists of rules: all that are listed are found, and hardly any other key passes."""
    rules = spark.range(5000).select(F.format_string("h%d.com", "id").alias("host"), F.lit("/").alias("path"), F.lit("block").alias("action"))
    pages = spark.range(10000).select(F.col("id").alias("page_id"), F.format_string("http://www.h%d.com/a", "id").alias("url"))
    out = urlfilter.filter_urls(pages, rules)
    assert out.where("(verdict = 'block') = (page_id < 5000)").count() == 10000


# Language


@pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])
def test_language_takes_any_rows(request, kind):
    docs = request.getfixturevalue(kind)
    out = langid.identify_languages(docs, epochs=1).collect()
    assert len(out) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "und") for r in out)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)


def test_language_without_anything_to_learn_from(awkward):
    out = langid.identify_languages(awkward.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in out} == {"und"}


def test_language_on_rows_never_learned_from(spark, small):
    out = queries.op10_language(spark, SF).where("held_out")
    rows = out.join(small.select("doc_id", "lang"), "doc_id").where("lang_pred <> 'und' AND lang IS NOT NULL").collect()
    assert len(rows) > 20 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.9 * len(rows)


def test_stretches_are_pooled_over_the_whole_text():
    """Every byte counts, in the context of its stretch, and texts of one call don't touch each other."""
    model = langid.LanguageModel(["a", "b", "c"], hidden=4)
    raws = [b"", b"x", b"some words of a text " * 40, "ünï cödé".encode(), bytes(range(97, 121))]
    together = model.pooled(raws, batch=7)
    for raw, got in zip(raws, together):
        parts = [raw[i : i + langid.STRETCH] for i in range(0, len(raw), langid.STRETCH)]
        padded = [np.frombuffer(p.ljust(langid.STRETCH), np.uint8)[:, None] for p in parts]
        total = sum((model.positions(p)[: len(q)].sum(axis=(0, 1), dtype=np.float64) for p, q in zip(padded, parts)), np.zeros(3)) / max(1, len(raw)) ** 0.5
        want = np.exp(total) / np.exp(total).sum()
        assert np.allclose(got, want, atol=1e-5)


def test_gradients_of_the_network():
    """Backpropagation through time against finite differences."""
    model = langid.LanguageModel(["a", "b", "c"], hidden=4)
    for g in (model.ahead.params, model.back.params, model.head):
        for k in g:
            g[k] = g[k].astype(np.float64)
    seq, y = np.array([[1, 2], [3, 1], [2, 2]]), np.array([0, 2])

    def loss():
        return -np.mean([model.positions(seq)[:, i, y[i]].mean() for i in range(2)])

    grads = model._gradients(seq, y)
    rng = np.random.default_rng(1)
    for g, d in zip((model.ahead.params, model.back.params, model.head), grads):
        for name, p in g.items():
            for _ in range(5):
                at = tuple(rng.integers(n) if len(p) != 256 or i else rng.choice([1, 2, 3]) for i, n in enumerate(p.shape))
                was = p[at]
                p[at] = was + 1e-3
                up = loss()
                p[at] = was - 1e-3
                down = loss()
                p[at] = was
                assert math.isclose((up - down) / 2e-3, d[name][at], rel_tol=0.02, abs_tol=2e-5)


# Pipeline


def test_pipeline_stages(spark, small):
    import corpus_pipeline

    docs, kept = small, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.settle(stage(spark, docs, SF), f"test_{name}")
        kept[name] = (before, docs)
        assert docs.columns == small.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, after = kept["toxicity"]
    rejected = toxicity.score_toxicity(before, labels).where("predicted = 1").select("doc_id")
    assert pairs(after, "doc_id") == pairs(before.join(rejected, "doc_id", "left_anti"), "doc_id")
    before, after = kept["simhash"]
    assert after.join(before, before.columns, "left_anti").isEmpty() and 0 < after.count() <= before.count()
    copies = before.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    assert after.select("doc_id").exceptAll(copies.select("doc_id")).isEmpty()
    before, after = kept["decontamination"]
    items = ids_and_texts(spark.read.parquet(f"{SF}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    clean = [r[0] for r in brute.contamination(ids_and_texts(before), items) if not r[5]]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(clean)
    before, after = kept["mixing"]
    assert max(Counter(r["doc_id"] for r in after.collect()).values()) <= 2
    assert after.join(before, before.columns, "left_anti").isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pairs(last, "doc_id", "start", "n_tokens", "ids_crc32") == encoded(ids_and_texts(docs))


@pytest.mark.parametrize("kind", ["awkward", "no_ids", "empty"])
def test_pipeline_takes_any_rows(spark, request, kind):
    import corpus_pipeline

    docs = request.getfixturevalue(kind).withColumns({c: F.lit("clash") for c in ("row", "score", "h", "node", "size", "copies", "matches", "key")})
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.settle(stage(spark, docs, SF), "test_rows")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
            assert docs.join(before.select(*[F.col(c).alias(f"b_{c}") for c in before.columns]), [docs[c].eqNullSafe(F.col(f"b_{c}")) for c in before.columns], "left_anti").isEmpty()
            assert docs.isEmpty() == before.isEmpty()
    assert docs.count() == before.count()


def test_thousands_of_splitters(spark):
    """Each splitter has the bytes below it that it wants, to a row; heavy keys take several splitters."""
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 62)).alias("key"), (16 + F.col("id") % 50).alias("size"))
    rows = rows.unionByName(spark.createDataFrame([(1 << 61, 40_000), (0, 0), (3, 0)], "key long, size long"))
    found = {r["nth"]: r["splitter"] for r in sharding.find_splitters(rows, 4000).collect()}
    data = sorted(map(tuple, rows.collect()))
    total = sum(s for _, s in data)
    below = np.concatenate([[0], np.cumsum([s for _, s in data])])
    keys = np.array([k for k, _ in data])
    assert sorted(found) == list(range(1, 4000)) and [found[i] for i in range(1, 4000)] == sorted(found.values())
    for i, key in found.items():
        at = np.searchsorted(keys, key)
        near = below[max(0, np.searchsorted(below, total * i / 4000) - 1) :][:2]
        assert min(abs(near - total * i / 4000)) >= abs(below[at] - total * i / 4000) - 0.002 * total / 4000
    assert sharding.find_splitters(rows, 1).count() == 0 and sharding.find_splitters(rows.limit(0), 5).count() == 4
