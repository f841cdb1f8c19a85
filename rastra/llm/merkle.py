"""Merkle manifest of a dataset: leaves hashed in ordered partitions by stacks of peaks, whose open edges are merged by level."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rastra.llm.common import id_crc, output
from rastra.storage import discard, settle

_NODES = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("at", pa.int64()), ("digest", pa.string()), ("open", pa.bool_())])
_NODES_DDL = "tree string, level int, at bigint, digest string, open boolean"
_EMPTY = "array<struct<l: string, r: string>>"


def digest_of(*values: Column) -> Column:
    """SHA-256 of values one after the other: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Range:
    """Mountain range over a run of neighbouring leaves: for each level the finished nodes whose parent isn't finished.

    A leaf is pushed at its place in the tree. Where it fills an aligned run of
    ``fanout`` nodes the run becomes their parent, which is carried one level up and may
    fill a run there. A run that begins before the leaves at hand stays open, as
    does the last one; what is open when the run of leaves ends are the edges that others merge.
    """

    def __init__(self, fanout: int):
        self.fanout = fanout
        self.levels: list[tuple[int, list[str]]] = []  # of each level the first open node's place, and the open nodes from there
        self.next = -1

    def push(self, at: int, digest: str) -> list[tuple[int, int, str, bool]]:
        """The nodes ``level, at, digest, open`` that can get no further parent here, as they have one or never will."""
        done, level = [], 0
        self.next = at + 1
        while True:
            if level == len(self.levels):
                self.levels.append((at, []))
            first, nodes = self.levels[level]
            if not nodes:
                first = at
            nodes.append(digest)
            self.levels[level] = (first, nodes)
            if (at + 1) % self.fanout:
                return done
            # the last node of an aligned run: it has a parent if the run's first one is here
            whole = len(nodes) == self.fanout
            done += [(level, first + i, d, not whole) for i, d in enumerate(nodes) if level or not whole]
            self.levels[level] = (at + 1, [])
            if not whole:
                return done
            digest, at, level = hashlib.sha256("".join(nodes).encode()).hexdigest(), at // self.fanout, level + 1

    def edges(self) -> list[tuple[int, int, str, bool]]:
        """The nodes still open."""
        return [(level, first + i, d, True) for level, (first, nodes) in enumerate(self.levels) for i, d in enumerate(nodes)]


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition with its number, how many trees have begun in it and the row's place in its tree's part."""
    part, tree, run, nth = TaskContext.get().partitionId(), None, -1, 0
    for batch in batches:
        runs, places = [], []
        for name in batch["tree"].to_pylist():
            if name != tree:
                tree, run, nth = name, run + 1, 0
            runs.append(run)
            places.append(nth)
            nth += 1
        more = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(runs, pa.int64()), pa.array(places, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "part", "run", "nth"])


def numbered(leaves: DataFrame, order: list[str], rows_a_part: int) -> DataFrame:
    """``leaves`` (``tree`` and others, no null tree) in the order of tree and ``order``, with ``at``: the place of each in its tree, from 0.

    Rows are dealt by ranges, so a tree of any size is spread; rows alike in all
    of the order are spread by chance, as it makes no difference which of them comes first. A partition needs
    one number from the others: how many rows of its first tree come before it.
    """
    spark = leaves.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(leaves.count() / rows_a_part))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in leaves.schema)
    dealt = leaves.withColumn("_tie", F.rand(13)).repartitionByRange(parts, "tree", *order, "_tie").drop("_tie").sortWithinPartitions("tree", *order)
    sorted_ = settle(dealt.mapInArrow(_number, f"{kinds}, part int, run bigint, nth bigint"), "merkle_sorted", compression="zstd")
    rows = sorted_.groupBy("part", "run", "tree").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row a part and tree
    starts = settle(rows.withColumn("before", F.coalesce(before, F.lit(0))).where("run = 0").select("part", "before"), "merkle_starts")
    last = starts.agg(F.max("part")).first()[0] or 0
    dense = spark.range(last + 1).join(starts, F.col("id") == F.col("part"), "left")
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("before", F.lit(0)).alias("before"))))
    first = F.get(dense.agg(F.transform(listed, lambda x: x["before"]).alias("all")).scalar(), F.col("part"))
    return sorted_.withColumn("at", F.col("nth") + F.when(F.col("run") == 0, first).otherwise(F.lit(0))).drop("part", "run", "nth")


def _peaks(fanout: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, peaks = None, Range(fanout)
        for batch in batches:
            out: list[tuple] = []
            for name, at, digest in zip(batch["tree"].to_pylist(), batch["at"].to_pylist(), batch["digest"].to_pylist(), strict=True):
                if name != tree or at != peaks.next:
                    out += [(tree, *node) for node in peaks.edges()]
                    tree, peaks = name, Range(fanout)
                out += [(name, *node) for node in peaks.push(at, digest)]
            yield output({f.name: [r[i] for r in out] for i, f in enumerate(_NODES)}, _NODES)
        out = [(tree, *node) for node in peaks.edges()]
        yield output({f.name: [r[i] for r in out] for i, f in enumerate(_NODES)}, _NODES)

    return run


@dataclass
class Forest:
    """Numbered leaves ``tree, at, digest, ...``, nodes ``tree, level, at, digest`` from level 1 up, subroots ``tree, digest``, and the number of levels above the leaves."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    height: int
    fanout: int

    def runs(self, level: int, *columns: str) -> DataFrame:
        """``tree, up, nodes, digests, lone``: the nodes under one parent at ``up``; ``lone`` if there is no parent, as this node is the subroot."""
        return _runs(self.leaves if level == 0 else self.nodes.where(F.col("level") == level), self.fanout, *columns)


def _runs(nodes: DataFrame, fanout: int, *columns: str) -> DataFrame:
    up = F.floor(F.col("at") / F.lit(fanout)).cast("long")
    grouped = nodes.groupBy("tree", up.alias("up")).agg(F.array_sort(F.collect_list(F.struct("at", "digest", *columns))).alias("nodes"))
    return grouped.withColumns({"digests": F.transform("nodes", lambda n: n["digest"]), "lone": (F.col("up") == 0) & (F.size("nodes") == 1)})


def build_forest(leaves: DataFrame, order: list[str], fanout: int = 16, rows_a_part: int = 1 << 17) -> Forest:
    """The Merkle tree of each ``tree`` of ``leaves``: every ``fanout`` nodes become one, the last run whatever its length, until one is left.

    Each task hashes the runs that lie whole in its rows; the open edges (fewer than ``2 * fanout`` nodes a level and task)
    are merged by level, a run a group. A single node at the beginning of a level is all of that level: a subroot.
    """
    placed = numbered(leaves, order, rows_a_part)
    height, count = 0, (placed.agg(F.max("at")).first()[0] or 0) + 1
    while count > 1:
        height, count = height + 1, -(-count // fanout)
    found = settle(placed.select("tree", "at", "digest").mapInArrow(_peaks(fanout), _NODES_DDL), "merkle_peaks")
    nodes = found.where("level > 0").select("tree", "level", "at", "digest")
    made = subroots = None
    for level in range(height + 1):
        edges = found.where(F.col("open") & (F.col("level") == level)).select("tree", "at", "digest")
        open_ = _runs(edges if made is None else edges.unionByName(made), fanout)
        parent = F.when(F.col("lone"), F.get("digests", F.lit(0))).otherwise(F.sha2(F.array_join("digests", "").cast("binary"), 256))
        merged = settle(open_.select("tree", F.col("up").alias("at"), parent.alias("digest"), "lone"), "merkle_merged")
        made = merged.where("NOT lone").drop("lone")
        ended = merged.where("lone").select("tree", "digest")
        subroots = ended if subroots is None else subroots.unionByName(ended)
        nodes = nodes.unionByName(made.select("tree", F.lit(level + 1).alias("level"), "at", "digest"))
    return Forest(placed, nodes, subroots, height, fanout)


def _sides(digests: Column, at: Column) -> Column:
    """What stands left and right of the node at ``at`` in its run."""
    left = F.array_join(F.slice(digests, F.lit(1), at), "")
    right = F.array_join(F.slice(digests, at + 2, F.lit(1 << 20)), "")
    return F.struct(left.alias("l"), right.alias("r"))


def with_paths(forest: Forest, above: DataFrame | None, *columns: str) -> DataFrame:
    """Each leaf's ``tree, digest, subroot``, the given columns and ``path``: what stands left and right of the way up at each level, from the leaf's own run to the top.

    ``above``: ``tree, path`` of the subroots in a tree of their own; none for a lone tree. Runs are joined
    from the top down, each level ``fanout`` times as long as the one above it, and a run's
    leaves come out of it at the end.
    """
    lower = None
    for level in range(forest.height, -1, -1):
        runs = forest.runs(level, *(columns if level == 0 else ()))
        top = runs.where("lone").withColumn("subroot", F.get("digests", F.lit(0)))
        top = top.withColumn("path", F.array().cast(_EMPTY)) if above is None else top.join(above, "tree")
        if lower is not None:
            parent = lower.select(*[F.col(c).alias(f"_{c}") for c in ("tree", "up", "digests", "lone", "subroot", "path")])
            met = runs.where("NOT lone").join(parent, (F.col("tree") == F.col("_tree")) & (F.floor(F.col("up") / F.lit(forest.fanout)) == F.col("_up")))
            top = top.unionByName(met.select(*runs.columns, F.col("_subroot").alias("subroot"), _way("_lone", "_digests", "up", "_path", forest.fanout).alias("path")))
        lower = top
    leaves = lower.withColumn("node", F.explode("nodes"))
    path = _way("lone", "digests", "node.at", "path", forest.fanout)
    return leaves.select("tree", "node.digest", "subroot", *[f"node.{c}" for c in columns], path.alias("path"))


def _way(lone: str, digests: str, at: str, path: str, fanout: int) -> Column:
    """The way up from the node ``at`` of a run whose parent's way is ``path``."""
    own = _sides(F.col(digests), F.pmod(F.col(at), F.lit(fanout)).cast("int"))
    return F.when(F.col(lone), F.col(path)).otherwise(F.concat(F.array(own), F.col(path)))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(path, leaf, lambda digest, side: F.sha2(F.concat(side["l"], digest, side["r"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda side: F.concat(side["l"], side["r"])), "").cast("binary"), 256)


@dataclass
class Manifest:
    """``leaves``: the documents with their place ``at`` and digest; ``nodes``: all inner nodes by source; ``subroots`` by source; ``root``: one row; ``proofs``: a row a document."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None
    proofs: DataFrame


def dataset_manifest(
    docs: DataFrame, values: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), doc_id: str = "doc_id", source: str = "source",
    text: str = "text", fanout: int = 16, rows_a_part: int = 1 << 17,
) -> Manifest:
    """Merkle manifest of documents: a tree a source, and a tree of their subroots in the order of sources.

    A leaf is the digest of the row's ``values``; the leaves of a source
    ascend by id. ``proofs`` has ``doc_id, leaf, subroot, root, path`` (left and right
    siblings of each level) and ``altered``: the leaf if the text's A-Z are lower-cased, for an
    audit, where the CRC-32 of the id is divisible by five, else the leaf itself.

    Nulls count as values of their own, a null source is a source and comes
    first, rows without an id come before others and are never altered. Rows that share an id
    are ordered by their digests; rows alike in all are leaves of their own, with proofs of their own. A
    source of one row is its own subroot. An empty table has no root and no proofs. Other columns are not read.
    """
    columns = {c: docs[f"`{c}`"] for c in dict.fromkeys((*values, doc_id, source, text))}
    lowered = {**columns, text: lower_ascii(columns[text])}
    tampered = F.coalesce(id_crc(columns[doc_id]) % 5 == 0, F.lit(False))
    narrow = docs.select(
        F.coalesce(F.concat(F.lit("="), columns[source].cast("string")), F.lit("")).alias("tree"),
        columns[doc_id].alias("doc_id"),
        digest_of(*[columns[c] for c in values]).alias("digest"),
        F.when(tampered, digest_of(*[lowered[c] for c in values])).alias("altered"),
    )
    narrow = settle(narrow, "merkle_digests", compression="zstd")
    trees = build_forest(narrow, ["doc_id", "digest"], fanout, rows_a_part)
    discard(narrow)
    subroots = settle(trees.subroots, "merkle_subroots")
    top = build_forest(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"], fanout, rows_a_part)
    found = top.subroots.first()
    root = found["digest"] if found else None
    above = settle(with_paths(top, None, "name").select(F.col("name").alias("tree"), "path"), "merkle_above")
    leaves = with_paths(trees, above, "doc_id", "altered").withColumns({"root": F.lit(root).cast("string"), "altered": F.coalesce("altered", "digest")})
    proofs = leaves.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", "altered")
    name = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30))
    named = lambda df: df.withColumn("source", name).drop("tree")
    return Manifest(named(trees.leaves.drop("altered")), named(trees.nodes), named(subroots), root, proofs)
