"""Line deduplication: documents probe sharded minimal perfect hashes over the hashes of repeated lines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastra.llm.common import output, texts
from rastra.storage import discard, settle

_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Odd multipliers of the position hash (fixed values).
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_KEYS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("lines", pa.int64())])
_PACKS = pa.schema([("shard", pa.int64()), ("pack", pa.int64()), *[(c, pa.binary()) for c in ("h1", "h2", "doc_id", "row", "at")]])
_INDEX = pa.schema([("shard", pa.int64()), ("keys", pa.int64()), ("weight", pa.int64()), *[(c, pa.binary()) for c in ("sizes", "bits", "prints", "counts", "owners")]])
_ANSWERS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("at", pa.binary())])
_CUT = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'bigint' if f.type == pa.int64() else 'binary' if f.type == pa.binary() else 'string'}" for f in schema)


def split_lines(raw: bytes | None) -> list[bytes]:
    """The lines of a text; null and empty texts are one empty line."""
    return (raw or b"").split(b"\n")


def key_hashes(lines: list[bytes], min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines with a key of ``min_chars`` code points or more are, and the 128-bit hashes of those keys in two columns."""
    at, digests = [], []
    for i, line in enumerate(lines):
        key = line.strip(_SPACE).lower()  # of bytes: A-Z alone
        if len(key) >= 4 * min_chars or len(key) >= min_chars and len(key) - sum(0x80 <= b < 0xC0 for b in key) >= min_chars:
            at.append(i)
            digests.append(xxhash.xxh3_128_digest(key))
    return np.array(at, dtype=np.int32), np.frombuffer(b"".join(digests), dtype=">u8").astype(np.uint64).reshape(-1, 2)


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: each goes to a number of its own below their count.

    Levels of bit arrays, each with two places for every key that the levels
    before it have left over: a key alone at its place sets that bit, all others
    go on. A key's number is the rank of its bit. Keys of two columns that differ
    in one at least are told apart on some level, so building ends.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits  # bits a level, and the levels one after the other
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = keys[:, 0] ^ (keys[:, 1] * np.uint64(_MIX[0]) + np.uint64(level + 1) * np.uint64(_MIX[1]))
            x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX[2])
            x = (x ^ (x >> np.uint64(29))) * np.uint64(_MIX[1])
        return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: rows of two 64-bit columns, all different."""
        sizes, words = [], []
        while len(keys):
            size = 64 * math.ceil(2 * len(keys) / 64)
            at = cls.places(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[at]]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate(words) if words else np.zeros(0, dtype=np.uint64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; any number, or -1, for one that was not among those built from."""
        found, left = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts[:-1], self.sizes, strict=True)):
            if not len(left):
                break
            at = self.places(keys[left], level, int(size)) + start
            word, bit = self.bits[at >> 6], np.uint64(1) << (at & 63).astype(np.uint64)
            hit = (word & bit) != 0
            found[left[hit]] = self.ranks[at[hit] >> 6] + np.bitwise_count(word[hit] & (bit[hit] - np.uint64(1)))
            left = left[~hit]
        return found


def _held_keys(min_chars: int):
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        total = 0

        def flush() -> pa.RecordBatch:
            keys, docs, lines = (np.concatenate([p[i] for p in parts]) for i in range(3))
            parts.clear()
            return output({"h1": pa.array(keys[:, 0].view(np.int64)), "h2": pa.array(keys[:, 1].view(np.int64)), "doc_id": pa.array(docs), "lines": pa.array(lines)}, _KEYS)

        for batch in batches:
            for doc, raw in zip(batch["doc_id"].to_pylist(), texts(batch["text"]), strict=True):
                keys = key_hashes(split_lines(raw), min_chars)[1]
                if not len(keys):
                    continue
                keys, lines = np.unique(keys, axis=0, return_counts=True)
                parts.append((np.ascontiguousarray(keys), np.full(len(keys), doc, dtype=np.int64), lines))
                total += len(keys)
                if total >= 1 << 16:
                    yield flush()
                    total = 0
        if parts:
            yield flush()

    return held


def _build_shard(key: tuple, rows: pa.Table) -> pa.Table:
    """The arrays of one shard, in the order of its perfect hash."""
    keys = np.stack([rows[c].to_numpy().view(np.uint64) for c in ("h1", "h2")], axis=1)
    hashed = PerfectHash.build(keys)
    order = np.argsort(hashed.find(keys))
    arrays = {
        "sizes": hashed.sizes,
        "bits": hashed.bits,
        "prints": keys[order, 1],
        "counts": np.minimum(rows["n"].to_numpy()[order], 0xFFFFFFFF).astype(np.uint32),
        "owners": rows["owner"].to_numpy()[order].astype(np.int64),
    }
    weight = int(rows["lines"].to_numpy().sum())
    return pa.Table.from_batches([output({"shard": [key[0].as_py()], "keys": [len(keys)], "weight": [weight], **{n: [a.tobytes()] for n, a in arrays.items()}}, _INDEX)])


def _probes(min_chars: int, shards: int, pack_lines: int):
    """Hashes of lines, packed by the shard that knows them; all lines of a document that go to one shard are in one pack."""

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, docs, rows, at = (np.concatenate([p[i] for p in parts]) for i in range(4))
            parts.clear()
            shard = (keys[:, 0] % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.diff(shard[order])) + 1
            for own in np.split(order, cuts):
                columns = {"h1": keys[own, 0], "h2": keys[own, 1], "doc_id": docs[own], "row": rows[own], "at": at[own]}
                yield output({"shard": [int(shard[own[0]])], "pack": [int(rows[own[0]])], **{n: [a.tobytes()] for n, a in columns.items()}}, _PACKS)

        for batch in batches:
            for doc, row, raw in zip(batch["doc_id"].to_pylist(), batch["row"].to_pylist(), texts(batch["text"]), strict=True):
                at, keys = key_hashes(split_lines(raw), min_chars)
                if not len(at):
                    continue
                parts.append((keys, np.full(len(at), doc, dtype=np.int64), np.full(len(at), row, dtype=np.int64), at))
                total += len(at)
                if total >= pack_lines:
                    yield from flush()
                    total = 0
        if parts:
            yield from flush()

    return probes


def _answer(packs: pa.Table, index: pa.Table) -> pa.Table:
    """Of the packed lines those that another document keeps: a row a document with the places of its lines to drop."""
    if not packs.num_rows or not index.num_rows:
        return _ANSWERS.empty_table()
    kinds = {"h1": np.uint64, "h2": np.uint64, "doc_id": np.int64, "row": np.int64, "at": np.int32}
    lines = {n: np.frombuffer(b"".join(packs[n].to_pylist()), dtype=k) for n, k in kinds.items()}
    arrays = {n: np.frombuffer(index[n][0].as_py(), dtype=k) for n, k in (("sizes", np.int64), ("bits", np.uint64), ("prints", np.uint64), ("owners", np.int64))}
    number = PerfectHash(arrays["sizes"], arrays["bits"]).find(np.stack([lines["h1"], lines["h2"]], axis=1))
    known = number >= 0
    known[known] = arrays["prints"][number[known]] == lines["h2"][known]
    known[known] = arrays["owners"][number[known]] != lines["doc_id"][known]
    dropped = np.flatnonzero(known)
    if not len(dropped):
        return _ANSWERS.empty_table()
    doc, row, at = (lines[n][dropped] for n in ("doc_id", "row", "at"))
    order = np.lexsort((at, row, doc))
    doc, row, at = doc[order], row[order], at[order]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(row) != 0)]))
    places = [np.unique(x).tobytes() for x in np.split(at, starts[1:])]
    return pa.Table.from_batches([output({"doc_id": pa.array(doc[starts]), "row": pa.array(row[starts]), "at": places}, _ANSWERS)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done: dict[str, list] = {f.name: [] for f in _CUT}
        held = 0
        for doc, raw, parts in zip(batch["doc_id"].to_pylist(), texts(batch["text"]), batch["parts"].to_pylist(), strict=True):
            lines = split_lines(raw)
            gone = set(np.frombuffer(b"".join(parts or []), dtype=np.int32).tolist())
            kept = b"\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else raw or b""
            for name, value in zip(_CUT.names, (doc, len(lines), len(gone), kept.decode("utf-8", "replace")), strict=True):
                done[name].append(value)
            held += len(kept)
            if held > 8 << 20:
                yield output(done, _CUT)
                done, held = {f.name: [] for f in _CUT}, 0
        if done["doc_id"]:
            yield output(done, _CUT)


def index_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, shard_keys: int = 1 << 17) -> tuple[DataFrame, int, int]:
    """The index of all lines that ``min_docs`` documents or more hold, its number of shards, and the number of lines with a key in all.

    ``docs``: ``doc_id, text``, no null id. A row a shard of about ``shard_keys`` keys:
    the perfect hash (``sizes, bits``), and in its order each key's fingerprint
    (the 64 bits of the hash that choose no shard), the number of documents that hold it, and the
    smallest id among them; ``weight`` is the number of lines of these keys.
    """
    held = docs.mapInArrow(_held_keys(min_chars), _ddl(_KEYS))
    counted = held.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count("*").alias("n"), F.sum("lines").alias("lines"))
    counted = settle(counted, "line_counts", compression="zstd")
    total, repeated = counted.agg(F.sum("lines"), F.count_if((F.col("n") >= min_docs) & (F.col("owner") < F.col("last")))).first()
    shards = max(1, math.ceil(repeated / shard_keys))
    keys = counted.where((F.col("n") >= min_docs) & (F.col("owner") < F.col("last")))
    unsigned = F.pmod(F.pmod(F.col("h1"), F.lit(shards)) + F.when(F.col("h1") < 0, F.lit((1 << 64) % shards)).otherwise(F.lit(0)), F.lit(shards))
    built = keys.withColumn("shard", unsigned).groupBy("shard").applyInArrow(_build_shard, _ddl(_INDEX))
    index = settle(built, "line_index")
    discard(counted)
    return index, shards, total or 0


def find_dropped(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, shard_keys: int = 1 << 17, task_lines: int = 1 << 18) -> DataFrame:
    """``doc_id, row, parts``: for rows of ``doc_id, row, text`` that lose lines, their places as packed 32-bit numbers."""
    index, shards, total = index_lines(docs.select("doc_id", "text"), min_chars, min_docs, shard_keys)
    packs = docs.mapInArrow(_probes(min_chars, shards, 1 << 14), _ddl(_PACKS))
    # a shard answers for its own lines and its part of those that no shard knows; one with many lines is copied to several tasks
    known = index.agg(F.sum("weight")).first()[0] or 0
    tasks = F.greatest(F.ceil((F.col("weight") + F.lit((total - known) / shards)) / task_lines), F.lit(1)).cast("int")
    several = index.select("shard", tasks.alias("tasks")).where("tasks > 1")
    dealt = packs.join(F.broadcast(several), "shard", "left").withColumn("salt", F.pmod(F.xxhash64("pack"), F.coalesce("tasks", F.lit(1))).cast("int"))
    copied = index.withColumn("salt", F.explode(F.sequence(F.lit(0), tasks - 1)))
    answers = dealt.drop("tasks", "pack").groupBy("shard", "salt").cogroup(copied.drop("weight", "counts").groupBy("shard", "salt")).applyInArrow(_answer, _ddl(_ANSWERS))
    return answers.groupBy("doc_id", "row").agg(F.collect_set("at").alias("parts"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, text: str = "text", doc_id: str = "doc_id", **sizes: int) -> DataFrame:
    """Drop each line that another document with a smaller id keeps.

    A line's key is the line without white space (U+0020, U+0009 to U+000D) at
    both ends and with A-Z lower-cased. Keys of at least ``min_chars`` code points that at least ``min_docs``
    documents hold lose all their lines except in the smallest id that holds
    them, which keeps all of its own. Distinct lines are counted by 128-bit hashes; those of several documents are indexed
    (``index_lines``), and documents send packed hashes of their lines to the
    shards, which send back the places to drop. No line is exchanged, and no pairs are made; a line of any number
    of documents is dealt over tasks of about ``task_lines`` lines. At least one row a
    document of the input comes back: ``doc_id, n_lines, n_dropped, kept``.

    Null and empty texts have one empty line. Rows without an id are compared
    with nothing and stay whole; rows that share an id are one document, and rows alike in all come back as often. A
    text whose lines are all dropped becomes empty. Other columns of any name are not read. Ids are whole numbers, or text of them; anything else is an error.
    """
    columns = [docs[f"`{doc_id}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("binary").alias("text")]
    body = docs.select(*columns).withColumn("row", F.xxhash64("text"))
    named = body.where("doc_id IS NOT NULL AND text IS NOT NULL")
    places = find_dropped(named, min_chars, min_docs, **sizes).select(F.col("doc_id").alias("found_id"), F.col("row").alias("found_row"), "parts")
    marked = body.join(places.hint("shuffle_hash"), (F.col("doc_id") == F.col("found_id")) & (F.col("row") == F.col("found_row")), "left")
    return marked.select("doc_id", "text", "parts").mapInArrow(_cut, _ddl(_CUT))
