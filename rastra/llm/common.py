"""Pieces that several of the corpus operators share."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastra.storage import exchanged

#: The characters that end a word: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 of each text of an Arrow column, without making Python strings."""
    for x in column.cast(pa.large_binary()):
        yield x.as_py()


def release() -> None:
    """Give the memory that a worker has freed back to the system: it waits beside the executor for its next task."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # another C library gives it back by itself
    _LIBC = None


def slices(batches: Iterator, rows: int = 256) -> Iterator:
    """Arrow batches, arrays or tuples of arrays, a few rows at a time, so that a worker's memory follows a few texts and not a batch."""
    for batch in batches:
        n = len(batch[0]) if isinstance(batch, tuple) else batch.num_rows if isinstance(batch, pa.RecordBatch) else len(batch)
        for at in range(0, max(n, 1), rows):
            yield tuple(x.slice(at, rows) for x in batch) if isinstance(batch, tuple) else batch.slice(at, rows)
    release()


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """What Spark runs within sends Arrow batches of about ``most`` bytes to its workers; both sides hold a whole one."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def id_crc(doc_id: Column | str) -> Column:
    """CRC-32 of a document id written as text; null for null."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary"))


def spread_join(rows: DataFrame, table: DataFrame, on: list[str], weight: str, by: list[str], parts: int = 4096) -> DataFrame:
    """Inner join of ``rows`` to a ``table`` with one row a key, such that no key's rows all land in one task.

    ``weight`` is the number of ``rows`` of each key of the table. A key with
    over 1/``parts`` of all is dealt over as many salts as it has such shares,
    by a hash of the columns ``by``; there are fewer than ``parts`` such keys
    whatever the input, so that they can be sent to all tasks. Both should be
    settled, as they are read twice or more.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    share = max(total / parts, 1.0)
    hot = table.where(F.col(weight) > share).select(*[F.col(k).alias(f"_hot_{k}") for k in on], F.ceil(F.col(weight) / share).cast("int").alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1))
    same = [rows[k] == F.col(f"_hot_{k}") for k in on]
    dealt = rows.join(F.broadcast(hot), same, "left").withColumn("_salt", F.pmod(F.xxhash64(*by), salts).cast("int")).drop("_salts", *[f"_hot_{k}" for k in on])
    copies = F.greatest(F.ceil(F.col(weight) / share), F.lit(1)).cast("int")
    copied = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.join(exchanged(copied), [*on, "_salt"]).drop("_salt")


def output(batch: dict[str, list | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of the given columns in the schema's types."""
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v := batch[f.name], pa.Array) and v.type == f.type else pa.array(v, type=f.type) for f in schema],
        schema=schema,
    )


_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def pieces(raw: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """A text in pieces of about ``step`` bytes that end at the end of a word, so that long texts take bounded memory."""
    at = 0
    while len(raw) - at > step:
        m = _SPACE.search(raw, at + step)
        end = m.start() if m else len(raw)
        yield raw[at:end]
        at = end
    yield raw[at:]


class WordHashes(dict):
    """XXH64 of words, remembered up to ``limit`` distinct ones at a time."""

    limit = 1 << 19

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 42)
        return h

    def of(self, raw: bytes | None) -> np.ndarray:
        """The hash of each word of a text (bytes between white space)."""
        parts = []
        for piece in pieces(raw or b""):
            words = piece.split()
            parts.append(np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words)))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)
