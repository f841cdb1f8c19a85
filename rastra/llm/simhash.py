"""SimHash near-duplicates by an inverted index of byte positions with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastra.llm.common import pieces, slices, spread_join, texts
from rastra.operators.graph import connected_components
from rastra.storage import exchanged, settle

_BITS = 64
_BYTES = 8


def _mixed(h: np.ndarray, rep: int) -> np.ndarray:
    """A further 64-bit hash made from a first one; the first repetition keeps it as it is."""
    if not rep:
        return h
    x = h + np.uint64(0x9E3779B97F4A7C15 * rep & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, _BYTES), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255  # so many bytes of 0 or 1 can be added in a byte
    total = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:
        total += bits[:whole].reshape(-1, 255, _BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total


def _shingle_hashes(raw: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, A-Z lower-cased, piece by piece."""
    tail: list[bytes] = []
    seen = False
    for piece in pieces(raw.lower()):
        words = tail + piece.split()
        if len(words) < shingle:
            tail = words
            continue
        tail = words[len(words) - shingle + 1 :]
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends - sizes + 1)[: len(words) - shingle + 1].tolist()
        cuts = map(joined.__getitem__, map(slice, starts, ends[shingle - 1 :].tolist()))
        yield np.fromiter(map(xxhash.xxh64_intdigest, cuts, repeat(42)), dtype=np.uint64, count=len(starts))
        seen = True
    if not seen and tail:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), 42)], dtype=np.uint64)


def fingerprint(raw: bytes | None, shingle: int = 4, reps: int = 1) -> list[int]:
    """``reps`` unsigned 64-bit fingerprints of a text; all zero if it has no words.

    A bit is set if it is set in over half the hashes of the text's shingles,
    repeats included; fewer words than a shingle make one shingle of them all.
    """
    counts, n = np.zeros((reps, _BITS), np.int64), 0
    for h in _shingle_hashes(raw or b"", shingle):
        n += len(h)
        for r in range(reps):
            counts[r] += _bit_counts(_mixed(h, r))
    return np.packbits(counts * 2 > n, axis=1, bitorder="little").view(np.uint64).ravel().tolist()


def fingerprint_of(hashes: np.ndarray) -> int:
    """The fingerprint of a text whose shingles, repeats included, have these hashes, as a signed long."""
    return int(np.packbits(_bit_counts(hashes) * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str, doc_id: str, shingle: int, reps: int, hashed: bool = False) -> DataFrame:
    """``doc_id, node, f0 ..``: fingerprints as signed longs, and one long that stands for them all; ``h`` of the text if asked for."""
    kind = pa.struct([(f"f{r}", pa.int64()) for r in range(reps)])

    @F.arrow_udf("struct<" + ", ".join(f"f{r}: bigint" for r in range(reps)) + ">")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in slices(batches):
            out = np.array([fingerprint(raw, shingle, reps) for raw in texts(batch)], dtype=np.uint64).reshape(-1, reps)
            columns = [pa.array(out[:, r].copy().view(np.int64)) for r in range(reps)]
            yield pa.StructArray.from_arrays(columns, fields=list(kind))

    also = [F.xxhash64(docs[f"`{text}`"]).alias("h")] if hashed else []
    made = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), *also, prints.asNondeterministic()(docs[f"`{text}`"].cast("binary")).alias("f"))
    flat = made.select("doc_id", *["h"] * hashed, *[F.col(f"f.f{r}").alias(f"f{r}") for r in range(reps)])
    return flat.withColumn("node", F.col("f0") if reps == 1 else F.xxhash64(*[f"f{r}" for r in range(reps)]))


class _Index:
    """The lists of the inverted index: one for each choice of ``min_match`` byte positions and their bytes.

    A pair that shares ``t`` positional bytes meets in as many lists as there
    are choices of ``min_match`` out of ``t``, so it meets at all just if its
    tally reaches ``min_match``; its first common list stands for it.
    """

    def __init__(self, reps: int, min_match: int, max_bits: int):
        if not 0 < min_match <= 8 - max_bits // reps:
            raise ValueError(f"{reps} x 64 bits of which {max_bits} differ guarantee no {min_match} equal bytes in any repetition")
        self.reps, self.max_bits = reps, max_bits
        self.choices = list(combinations(range(_BYTES), min_match))
        masks = np.arange(1 << _BYTES)
        inside = np.array([sum(1 << p for p in c) for c in self.choices])
        has = (masks[:, None] & inside) == inside
        self.first = np.where(has.any(axis=1), has.argmax(axis=1), -1)

    def keys(self, prints: np.ndarray) -> np.ndarray:
        """``(n, lists)`` keys for ``(n, reps)`` fingerprints: repetition, choice of positions, bytes."""
        out = np.empty((len(prints), self.reps * len(self.choices)), np.int64)
        for r in range(self.reps):
            b = np.ascontiguousarray(prints[:, r]).view(np.uint8).reshape(-1, _BYTES).astype(np.int64)
            for c, places in enumerate(self.choices):
                key = np.full(len(prints), (r << 8 | c) << 32, np.int64)
                for j, p in enumerate(places):
                    key |= b[:, p] << (8 * j)
                out[:, r * len(self.choices) + c] = key
        return out

    def linked(self, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the fingerprints ``(..., reps)`` are near each other and ``key`` is their first common list."""
        differ = a ^ b
        near = np.bitwise_count(differ).sum(axis=-1, dtype=np.int64) <= self.max_bits
        same = np.ascontiguousarray(differ)[..., None].view(np.uint8) == 0
        tally = np.packbits(same, axis=-1, bitorder="little")[..., 0]
        first = self.first[tally]  # (..., reps), -1 where the tally is too low
        rep = (first >= 0).argmax(axis=-1)
        choice = np.take_along_axis(first, rep[..., None], axis=-1)[..., 0]
        return near & (choice >= 0) & ((rep << 8 | choice) == key >> 32)


def _postings(nodes: DataFrame, index: _Index, step: int = 4096) -> DataFrame:
    reps = index.reps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                prints = np.stack([part.column(1 + r).to_numpy().view(np.uint64) for r in range(reps)], axis=1)
                keys = index.keys(prints)
                node = np.repeat(part.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], names=["key", "node"])

    return nodes.select("node", *[f"f{r}" for r in range(reps)]).mapInArrow(run, "key long, node long")


def _spread(key: int, node: np.ndarray, prints: np.ndarray, index: _Index) -> tuple[list, list]:
    """Edges of a spanning forest of one large list, breadth first in blocks."""
    src, dst = [], []
    left = np.arange(len(node))
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            reached = []
            for at in range(0, len(front), 64):
                if not len(left):
                    break
                rows = front[at : at + 64]
                hit = index.linked(np.int64(key), prints[rows][:, None], prints[left][None])
                got = hit.any(axis=0)
                src += node[rows[hit[:, got].argmax(axis=0)]].tolist()
                dst += node[left[got]].tolist()
                reached.append(left[got])
                left = left[~got]
            front = np.concatenate(reached) if reached else left[:0]
    return src, dst


def _compare(groups: DataFrame, index: _Index, small: int = 16) -> DataFrame:
    """Links among the members of each list; short lists of one length are compared together."""
    reps = index.reps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            members = batch.column(1)
            offsets = members.offsets.to_numpy()
            flat = members.values
            node = flat.field(0).to_numpy()
            prints = np.stack([flat.field(1 + r).to_numpy().view(np.uint64) for r in range(reps)], axis=1)
            sizes = np.diff(offsets)
            for m in np.unique(sizes).tolist():
                which = np.flatnonzero(sizes == m)
                src, dst = [], []
                if m < 2:
                    continue
                if m <= small:
                    i, j = np.triu_indices(m, 1)
                    for at in range(0, len(which), 4096):
                        w = which[at : at + 4096]
                        rows = offsets[w][:, None] + np.arange(m)
                        a, b = rows[:, i], rows[:, j]
                        hit = index.linked(keys[w][:, None], prints[a], prints[b])
                        src.append(node[a[hit]])
                        dst.append(node[b[hit]])
                else:
                    for g in which.tolist():
                        part = slice(offsets[g], offsets[g + 1])
                        s, d = _spread(keys[g], node[part], prints[part], index)
                        src.append(np.array(s, np.int64))
                        dst.append(np.array(d, np.int64))
                s, d = np.concatenate(src), np.concatenate(dst)
                if len(s):
                    yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(d)], names=["src", "dst"])

    return groups.mapInArrow(run, "src long, dst long")


def near_links(nodes: DataFrame, reps: int = 1, min_match: int = 4, max_bits: int = 4, block_rows: int = 2048) -> DataFrame:
    """``src, dst`` such that their components are those of all pairs of near fingerprints.

    ``nodes`` has distinct ``node, f0 ..``. Pairs whose tally of shared
    positional bytes reaches ``min_match`` in some repetition are verified: at
    most ``max_bits`` of all bits may differ. Some repetition has at most its share of the differing
    bits, each of which spoils one byte at most; parameters that ask for more equal bytes than
    that leaves are refused, so nothing is missed. A list of over
    ``block_rows`` members is compared block against block in separate tasks.
    """
    index = _Index(reps, min_match, max_bits)
    # a node makes many postings, so tasks are cut by nodes and not by bytes
    tasks = -(-nodes.count() * reps // 16384) or 1
    postings = _postings(nodes.repartition(tasks), index)
    shared = postings.groupBy("key").count().where("count > 1")
    shared = shared.select("key", F.ceil(F.col("count") / F.lit(block_rows)).cast("int").alias("blocks"))
    members = postings.join(exchanged(shared), "key")
    if reps > 1:
        members = members.join(exchanged(nodes.select("node", *[f"f{r}" for r in range(reps)])), "node")
    else:
        members = members.withColumn("f0", F.col("node"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = members.withColumn("own", own).withColumn(
        "other", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    groups = dealt.groupBy("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).agg(
        F.collect_list(F.struct("node", *[f"f{r}" for r in range(reps)])).alias("members")
    )
    return _compare(groups.select("key", "members"), index)


def _components(prints: DataFrame, reps: int, min_match: int, max_bits: int, block_rows: int) -> DataFrame:
    """``node, rows, first_id, component`` of the distinct fingerprints; ``rows`` have it."""
    columns = [f"f{r}" for r in range(reps)]
    nodes = settle(
        prints.groupBy("node").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in columns]), "simhash_nodes"
    )
    component = connected_components(near_links(nodes, reps, min_match, max_bits, block_rows))
    grouped = nodes.select("node", "rows", "first_id").join(exchanged(component), F.col("node") == F.col("id"), "left")
    return settle(grouped.select("node", "rows", "first_id", F.coalesce("component", "node").alias("component")), "simhash_groups")


def near_duplicate_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = 4,
    reps: int = 1,
    min_match: int = 4,
    max_bits: int = 4,
    block_rows: int = 2048,
) -> DataFrame:
    """Fingerprints and components of near-duplicates: ``doc_id, f0 .., component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable over links between
    fingerprints of which at most ``max_bits`` bits differ. Equal fingerprints
    are one node, so a group of copies costs one node. Null and empty texts have
    fingerprint zero and are linked like any other; repeated rows are kept; rows
    without an id take part, and a group with no id has a null component. An
    empty table gives an empty result.
    """
    prints = settle(fingerprints(docs, text, doc_id, shingle, reps), "simhash")
    columns = [f"f{r}" for r in range(reps)]
    grouped = _components(prints, reps, min_match, max_bits, block_rows)
    smallest = settle(grouped.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("nodes")), "simhash_smallest")
    named = settle(spread_join(grouped, smallest, ["component"], "nodes", ["node"]).select("node", "rows", "component_id"), "simhash_named")
    return spread_join(prints, named, ["node"], "rows", ["doc_id"]).select("doc_id", *columns, "component_id")


def one_row_each(docs: DataFrame, rows: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The rows of ``docs`` that stay if each component of ``rows`` (``doc_id, h, component``) keeps one.

    ``h`` is ``xxhash64`` of the text. It is the row with the smallest id and,
    of rows with one id, the smallest ``h``; rows without an id come last. Of
    rows that agree in both an arbitrary one stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    kept = rows.groupBy("component").agg(F.min(key).alias("kept"))
    kept = settle(kept.select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.h").alias("kept_h")), "simhash_kept")
    counts = rows.groupBy("doc_id", "h").count().where("count > 1")
    repeated = not counts.join(exchanged(kept), counts["doc_id"].eqNullSafe(kept["kept_id"]) & (counts["h"] == kept["kept_h"]), "left_semi").isEmpty()
    tagged = docs.withColumn("_row_h", F.xxhash64(docs[f"`{text}`"]))
    stay = tagged.join(exchanged(kept), tagged[f"`{doc_id}`"].eqNullSafe(kept["kept_id"]) & (tagged["_row_h"] == kept["kept_h"]), "left_semi")
    return (stay.dropDuplicates([doc_id, "_row_h"]) if repeated else stay).drop("_row_h")


def drop_near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = 4,
    reps: int = 1,
    min_match: int = 4,
    max_bits: int = 4,
    block_rows: int = 2048,
) -> DataFrame:
    """One row of each component of near fingerprints.

    Columns and their order stay. The row with the smallest id stays, one
    without an id only if no row of its component has one; rows that share an id
    are judged by their texts.
    """
    prints = settle(fingerprints(docs, text, doc_id, shingle, reps, hashed=True), "simhash")
    grouped = _components(prints, reps, min_match, max_bits, block_rows).select("node", "rows", "component")
    rows = spread_join(prints, grouped, ["node"], "rows", ["doc_id", "h"]).select("doc_id", "h", "component")
    return one_row_each(docs, rows, text, doc_id)
