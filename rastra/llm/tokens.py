"""Token ids as Parquet list columns in document order."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rastra.llm.common import arrow_batches, slices, texts
from rastra.storage import scratch, settle


_NONE = np.zeros(0, np.int32)
#: Odd multiplier of the hash over a chunk's bytes, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = 32
_WIDE = np.array([0xC2, 0xE1, 0xE2, 0xE3], np.uint8)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _segments(raw: bytes, step: int = 1 << 20) -> list[bytes]:
    """A long text in segments; at each cut a space between two visible ASCII characters is left out."""
    out, at = [], 0
    while len(raw) - at > step:
        m = _CUT.search(raw, at + step)
        if not m:
            break
        out.append(raw[at : m.start() + 1])
        at = m.start() + 2
    out.append(raw[at:])
    return out


_CUT = re.compile(rb"[!-~] (?=[!-~])")


class ChunkEncoder:
    """Encodes texts with a byte-level BPE tokenizer, each distinct chunk once.

    A space between two characters that aren't white space always begins a new
    pre-token, so a text's ids are those of its chunks cut there, in turn. A
    text with other runs of white space, or with one of the tokenizer's added
    tokens in it, is encoded whole. Chunks are looked up by hashes, many at a
    time, so that a common one costs no look-up of its own, and then held against
    the bytes of the chunk that was found; one that differs has its text encoded
    whole.
    """

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # byte-level vocabularies write the space as U+0120
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(self.tokenizer.get_vocab_size())])
        self.limit = limit
        self.powers = (np.zeros(0, np.uint64),) * 2
        self._forget()

    def _forget(self) -> None:
        #: hashes of the known chunks in order, and the number of each: from 1, or 0 if it can't stand alone
        self.hashes, self.numbers = np.zeros(0, np.uint64), _NONE
        self.starts, self.sizes, self.ids = np.zeros(1, np.int32), np.zeros(1, np.int32), _NONE
        #: bytes of the known chunks, each after a space; where each begins, and its length
        self.bytes, self.begins, self.lengths = np.zeros(1, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _encode(self, whole: list[str]) -> list[np.ndarray]:
        # a few at a time: what the tokenizer makes besides the ids is many times their size
        some = (whole[k : k + 32] for k in range(0, len(whole), 32))
        return [np.array(e.ids, np.int32) for few in some for e in self.tokenizer.encode_batch_fast(few, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, joined: bytes, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number the new chunks, in order of their hashes, and encode them, a hundred at a time: an id that begins with a space begins a chunk."""
        data = np.frombuffer(joined, np.uint8)
        # the bytes at a chunk's two edges; non-ASCII white space begins with one of four bytes
        first, last, second, third = data[np.minimum(at + 1, len(data) - 1)], data[ends - 1], data[ends - 2], data[np.maximum(ends - 3, 0)]
        odd = np.isin(first, _WIDE) | (second == 0xC2) | np.isin(third, _WIDE)
        fit = (ends - at > 1) & (first > _SPACE) & (last > _SPACE)
        for i in np.flatnonzero(odd & fit).tolist():
            chunk = joined[at[i] + 1 : ends[i]].decode("utf-8")
            fit[i] = not (chunk[0].isspace() or chunk[-1].isspace())
        present = [t for t in self.added if t in joined]
        if present:
            fit &= [not any(t in joined[a:b] for t in present) for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
        numbers = np.zeros(len(hashes), np.int32)
        if fit.any():
            new = [joined[a:b] for a, b in zip(at[fit].tolist(), ends[fit].tolist(), strict=True)]
            numbers[fit] = np.arange(len(self.sizes), len(self.sizes) + len(new))
            flat = np.concatenate(self._encode([b"".join(new[k : k + 100]).decode("utf-8") for k in range(0, len(new), 100)]))
            starts = np.flatnonzero(self.spaced[flat]).astype(np.int32)
            self.starts = np.concatenate([self.starts, len(self.ids) + starts])
            self.sizes = np.concatenate([self.sizes, np.diff(np.append(starts, np.int32(len(flat))))])
            self.ids = np.concatenate([self.ids, flat])
            lengths = ends[fit] - at[fit]
            self.begins = np.concatenate([self.begins, len(self.bytes) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(new), np.uint8)])
        places = np.searchsorted(self.hashes, hashes)
        self.hashes, self.numbers = np.insert(self.hashes, places, hashes), np.insert(self.numbers, places, numbers)
        return numbers

    def _alike(self, data: np.ndarray, at: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Whether each chunk of a buffer has the bytes of the known one of its number."""
        where = np.repeat(self.begins[numbers] - at, ends - at)
        where += np.arange(len(where))
        np.minimum(where, len(self.bytes) - 1, out=where)
        differ = np.add.reduceat((self.bytes[where] != data).view(np.uint8), at, dtype=np.int64)
        return (differ == 0) & (self.lengths[numbers] == ends - at)

    def _numbers(self, joined: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where the chunks of a buffer begin, each with the space before it, and their numbers."""
        data = np.frombuffer(joined, np.uint8)
        if len(data) >= len(self.powers[0]):
            self.powers = _powers(_BASE, len(data) + (1 << 16)), _powers(_INVERSE, len(data) + (1 << 16))
        at = np.flatnonzero(data == _SPACE)
        ends = np.append(at[1:], len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[0][: len(data)], out=sums[1:])
        h = (sums[ends] - sums[at + 1]) * self.powers[1][at + 1]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (ends - at).astype(np.uint64)
        distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        places = np.searchsorted(self.hashes, distinct)
        held = places < len(self.hashes)
        held[held] = self.hashes[places[held]] == distinct[held]
        numbers = np.zeros(len(distinct), np.int32)
        numbers[held] = self.numbers[places[held]]
        if not held.all():
            new = first[~held]
            numbers[~held] = self._learn(distinct[~held], joined, at[new], ends[new])
        numbers = numbers[inverse]
        numbers[~self._alike(data, at, ends, numbers)] = 0
        return at, numbers

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text, given as UTF-8."""
        if len(self.hashes) > self.limit:
            self._forget()
        segments, owner = [], []
        for t, raw in enumerate(texts):
            parts = _segments(raw)
            if len(parts) > 1 and any(t in raw for t in self.added):
                parts = [raw]
            segments += parts
            owner += [(t, k) for k in range(len(parts))]
        at, numbers = self._numbers(b"".join([b" " + s for s in segments])) if segments else (_NONE, _NONE)
        bounds = np.cumsum([0, *(len(s) + 1 for s in segments)])
        begins = np.searchsorted(at, bounds)
        heads = np.array([k == 0 for _, k in owner], bool)
        counted = numbers.copy()
        counted[begins[:-1][heads]] = 0  # no space goes before a text's first chunk, so it is encoded by itself
        bad = np.add.reduceat((numbers == 0).astype(np.int64), begins[:-1]) > 0 if segments else heads
        for t in self.added:
            if b" " in t:
                bad |= [t in s for s in segments]
        n = self.sizes[counted]
        ends = np.cumsum(n, dtype=np.int32)
        where = np.repeat(self.starts[counted] - ends + n, n)
        where += np.arange(len(where), dtype=np.int32)
        flat = self.ids[where]
        ends = np.concatenate([[0], ends])[begins]
        alone: list[str] = []
        for s, (_, k), b in zip(segments, owner, bad.tolist(), strict=True):
            if b:
                alone.append((s if k == 0 else b" " + s).decode("utf-8"))
            elif k == 0:
                alone.append(s.partition(b" ")[0].decode("utf-8"))
        found = iter(self._encode(alone))
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for i, ((t, k), b) in enumerate(zip(owner, bad.tolist(), strict=True)):
            if b or k == 0:
                out[t].append(next(found))
            if not b:
                out[t].append(flat[ends[i] : ends[i + 1]])
        return [np.concatenate(x) for x in out]


_ROWS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("local_start", pa.int64()), ("ids", pa.list_(pa.field("element", pa.int32())))])


def _in_turn(encoder: ChunkEncoder, raws: list[bytes], most: int = 1 << 20) -> Iterator[np.ndarray]:
    """The ids of each text, encoding about ``most`` bytes at a time."""
    some, held = [], 0
    for raw in raws:
        some.append(raw)
        held += len(raw)
        if held >= most:
            yield from encoder.encode(some)
            some, held = [], 0
    if some:
        yield from encoder.encode(some)


def _writer(path: str, tokenizer: str, end_id: int, encoding: str, group_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, folder = pafs.FileSystem.from_uri(path)
        # a name for each attempt: only files that a finished task reports are ever read
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.parquet"
        dictionary = encoding == "dictionary"
        options = {
            "compression": "zstd",
            "compression_level": 1,
            "write_page_index": True,
            "data_page_size": 256 << 10,
            "use_dictionary": ["ids.list.element"] if dictionary else False,
            "column_encoding": {c: "DELTA_BINARY_PACKED" for c in ("doc_id", "n_tokens", "local_start")}
            | ({} if dictionary else {"ids.list.element": "DELTA_BINARY_PACKED"}),
            "write_statistics": ["doc_id", "local_start"],
        }
        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, ChunkEncoder(tokenizer))
        out, start, docs, held, held_tokens = None, 0, 0, [], 0

        def flush() -> None:
            nonlocal out, held, held_tokens
            if out is None:
                fs.create_dir(folder, recursive=True)
                out = pq.ParquetWriter(name, _ROWS, filesystem=fs, **options)
            sizes = np.array([len(ids) for _, _, ids in held], np.int64)
            rows = pa.table(
                [
                    pa.array([d for d, _, _ in held], pa.int64()),
                    pa.array(sizes),
                    pa.array([s for _, s, _ in held], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.concatenate([i for _, _, i in held]))
                    ).cast(_ROWS.field("ids").type),
                ],
                schema=_ROWS,
            )
            out.write_table(rows, row_group_size=len(held))
            held, held_tokens = [], 0

        for batch in batches:
            for few in slices([batch], 1024):
                raws = [t or b"" for t in texts(few.column(1))]
                for doc, ids in zip(few.column(0).to_pylist(), _in_turn(encoder, raws), strict=True):
                    ids = np.append(ids, np.int32(end_id))
                    held.append((doc, start, ids))
                    start, held_tokens, docs = start + len(ids), held_tokens + len(ids), docs + 1
                    if held_tokens >= group_tokens:
                        flush()
        if held:
            flush()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "docs": [docs], "tokens": [start]})

    return write


#: Encoders of this Python worker, by tokenizer file.
_ENCODERS: dict[str, ChunkEncoder] = {}


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    path: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    end_id: int = 2,
    encoding: str = "dictionary",
    group_tokens: int = 1 << 20,
) -> tuple[str, DataFrame]:
    """Encode every whole text and write the ids as Parquet, in ascending ``doc_id`` order.

    Files hold ``doc_id, n_tokens, local_start, ids``: ``ids`` is a list column
    with dictionary or delta encoding, in row groups of about ``group_tokens``
    ids, with page indexes and statistics of ``doc_id``, so that single documents
    and the metadata columns can be read without the rest. Returns the folder
    and a manifest of the files of finished tasks: ``part, file, docs, tokens,
    base`` (ids in all files before). Null and empty texts have the end id only;
    null document ids come first; rows that share an id stand side by side, by
    the hash of their text, and may be dealt over several files. ``doc_id`` must
    hold numbers. An empty table gives an empty manifest; further columns are
    not written.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding: {encoding}")
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    narrow = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("binary").alias("text"))
    hashed = narrow.withColumn("h", F.xxhash64("text"))
    ranged = hashed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    files = ranged.mapInArrow(_writer(path, tokenizer, end_id, encoding, group_tokens), "part long, file string, docs long, tokens long")
    with arrow_batches(spark, 4 << 20):
        files = settle(files, "tokens_files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return path, files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def token_digests(path: str, manifest: DataFrame) -> DataFrame:
    """Read the files back: ``doc_id, start, n_tokens, ids_crc32``, a row a document, a row group at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with pq.ParquetFile(file, filesystem=fs) as f:
                    for g in range(f.num_row_groups):
                        rows = f.read_row_group(g).combine_chunks()
                        ids = rows.column("ids").chunk(0)
                        bounds = ids.offsets.to_numpy()
                        flat = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<u4")).cast("B")
                        crcs = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                rows.column("doc_id").chunk(0),
                                pa.array(rows.column("local_start").to_numpy() + base),
                                pa.array(np.diff(bounds).astype(np.int64)),
                                pa.array(crcs, pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    n = max(1, manifest.count())
    dealt = manifest.select("file", "base").repartition(n)
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(manifest: DataFrame, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The token table for selective reads; filters on ``doc_id`` skip row groups and pages.

    Reads the files that the manifest of ``write_tokens`` lists, a name a file, so what attempts that were run again have
    left in the folder is not read. A manifest without files gives an empty table. Null ids stay null, and rows that share an id are all there.
    """
    spark = manifest.sparkSession
    files = [r["file"] for r in manifest.select("file").toLocalIterator()]
    kinds = "doc_id bigint, n_tokens bigint, local_start bigint, ids array<int>"
    return (spark.read.schema(kinds).parquet(*files) if files else spark.createDataFrame([], kinds)).select(*columns)
