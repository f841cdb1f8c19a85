"""Near-duplicates: SimHash fingerprints meet in the inverted index of byte positions, the exact similarity of shingle sets settles them, and an inverted index of set prefixes finds the pairs whose fingerprints are too far apart."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastra.llm import simhash
from rastra.llm.common import slices, spread_join, texts
from rastra.llm.simhash import _shingle_hashes, fingerprint_of, one_row_each
from rastra.operators.graph import connected_components
from rastra.storage import exchanged, settle

_BITS = 256
_WIDE = 1024
_LONGS = [f"p{i}" for i in range(_BITS // 64)]
#: So many of a set's lists, the first by key, travel with it.
_FIRST = 16


def shingle_set(raw: bytes | None, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending; fewer words than a shingle make one of them all."""
    parts = list(_shingle_hashes(raw or b"", shingle))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def _parity(found: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of the hashes falls on i: the bits in which two sets differ are never more than the members.

    There are as many bits as members, up to a power of two and ``_WIDE`` at least; the halves of a wide one, folded, are the narrower one.
    """
    bits = max(_WIDE, 1 << (len(found) - 1).bit_length())
    odd = np.bincount((found % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _fold(parity: np.ndarray, longs: int) -> np.ndarray:
    return np.bitwise_xor.reduce(parity.reshape(-1, longs), axis=0)


def _differ(a: bytes, b: bytes) -> int:
    """In how many of the bits that both have two parities differ."""
    x, y = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
    longs = min(len(x), len(y))
    return int(np.bitwise_count((_fold(x, longs) ^ _fold(y, longs)).view(np.uint64)).sum(dtype=np.int64))


def _prefix(found: np.ndarray, common: np.ndarray, least: Fraction) -> np.ndarray:
    """The first members in one order for all sets, common ones last, of which two near sets share at least one.

    48 bits of each do for keys, as the sets settle what meets by chance.
    """
    n = len(found)
    late = np.isin(found, common)
    keep = n - -(-least.numerator * n // least.denominator) + 1
    return np.concatenate([found[~late], found[late]])[: keep if n else 0] >> np.uint64(16)


def _common(docs: DataFrame, text: str, shingle: int, sample: int = 4000, most: int = 16384) -> np.ndarray:
    """Shingles that many of some sampled texts have. They order the sets and change no result."""
    n = docs.count()
    drawn = docs.select(docs[f"`{text}`"].cast("binary").alias("text")).sample(min(1.0, sample / max(n, 1)), 42)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for raw in texts(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(raw, shingle).view(np.int64))], names=["h"])

    counts = drawn.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= max(8, min(n, sample) // 400))
    rows = counts.orderBy(F.desc("count"), "h").limit(most).collect()
    return np.array([r["h"] for r in rows], np.int64).view(np.uint64)


def _prints(docs: DataFrame, text: str, doc_id: str, shingle: int, least: Fraction, common: np.ndarray) -> DataFrame:
    kind = pa.struct([("node", pa.int64()), ("n", pa.int64()), ("f0", pa.int64()), *[(p, pa.int64()) for p in _LONGS], ("parity", pa.binary()), ("prefix", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<node: bigint, n: bigint, f0: bigint, " + ", ".join(f"{p}: bigint" for p in _LONGS) + ", parity: binary, prefix: array<bigint>>")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in slices(batches):
            out = []
            for raw in texts(batch):
                hashes = np.concatenate([np.empty(0, np.uint64), *_shingle_hashes(raw or b"", shingle)])
                found = np.unique(hashes)
                row = {"node": _node(found), "n": len(found), "f0": fingerprint_of(hashes), "prefix": _prefix(found, common, least).view(np.int64)}
                parity = _parity(found)
                row |= dict(zip(_LONGS, _fold(parity, len(_LONGS)).tolist(), strict=True))
                out.append(row | {"parity": parity.tobytes()})
            yield pa.array(out, type=kind)

    made = docs.select(
        docs[f"`{doc_id}`"].alias("doc_id"),
        F.xxhash64(docs[f"`{text}`"]).alias("h"),
        prints.asNondeterministic()(docs[f"`{text}`"].cast("binary")).alias("f"),
    )
    return made.select(F.monotonically_increasing_id().alias("row"), "doc_id", "h", "f.*")


def _node(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), 42)).view(np.int64))


def _candidates(groups: DataFrame, least: Fraction, apart: bool, small: int) -> DataFrame:
    """Pairs of each list, of different components, that the bound allows: all of a short list, those with its first member of a long one.

    With ``apart`` all such pairs, of lists of any length;
    these are held against all bits that both have before they leave the task.
    A pair leaves only from the first list in which it is known to meet, by the
    ``_FIRST`` lists that either set brings, so near copies, which share most
    lists, aren't repeated by each.
    The sets of two near texts differ in at most ``(1 - s) / (1 + s)`` of both sizes.
    """
    over, under = least.denominator - least.numerator, least.denominator + least.numerator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            keys, members = batch.column(0).to_numpy(), batch.column(1)
            offsets, flat = members.offsets.to_numpy(), members.values
            node, n, group = (flat.field(i).to_numpy() for i in range(3))
            bits = np.stack([flat.field(3 + i).to_numpy().view(np.uint64) for i in range(len(_LONGS))], axis=1)
            parity = flat.field(3 + len(_LONGS)) if apart else None
            lists = np.stack([flat.field(4 + len(_LONGS) + i).to_numpy() for i in range(_FIRST)], axis=1) if apart else None

            def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                differ = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=-1, dtype=np.int64)
                differ = np.maximum(differ, np.abs(n[a] - n[b]))
                return (differ * under <= over * (n[a] + n[b])) & (node[a] != node[b]) & (group[a] != group[b])

            src, dst = [], []
            sizes = np.diff(offsets)
            for m in np.unique(sizes).tolist():
                starts, named = offsets[:-1][sizes == m], keys[sizes == m].tolist()
                if m < 2:
                    continue
                if m <= small and not apart:
                    i, j = np.triu_indices(m, 1)
                    a, b = (starts[:, None] + i).ravel(), (starts[:, None] + j).ravel()
                    hit = near(a, b)
                    src.append(node[a[hit]])
                    dst.append(node[b[hit]])
                    continue
                for start, key in zip(starts.tolist(), named, strict=True):
                    rows = np.arange(start, start + m)
                    if not apart:
                        rows = rows[np.argsort(node[rows])]
                    elif (group[rows] == group[start]).all():
                        continue
                    for at in range(0, m if apart else 1, 64):
                        a, b = np.broadcast_arrays(rows[at : at + (64 if apart else 1), None], rows[None, at + 1 :])
                        hit = near(a, b) & (np.arange(a.shape[1])[None] >= np.arange(len(a))[:, None])
                        a, b = a[hit], b[hit]
                        if apart and len(a):
                            new = ~_met_before(key, lists[a], lists[b])
                            a, b = a[new], b[new]
                        if apart and len(a):
                            x, y = parity.take(pa.array(a)), parity.take(pa.array(b))
                            differ = np.array([_differ(i, j) for i, j in zip(texts(x), texts(y), strict=True)])
                            hit = differ * under <= over * (n[a] + n[b])
                            a, b = a[hit], b[hit]
                        src.append(node[a])
                        dst.append(node[b])
            if src:
                s, d = np.concatenate(src), np.concatenate(dst)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(s, d)), pa.array(np.maximum(s, d))], names=["src", "dst"])

    return groups.select("key", "members").mapInArrow(run, "src long, dst long").distinct()


def _met_before(key: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the sets with the first lists ``a`` and ``b``, a row each, are known to meet in a list before ``key``."""
    out = np.zeros(len(a), bool)
    for at in range(0, len(a), 16384):
        x, y = a[at : at + 16384, :, None], b[at : at + 16384, None]
        out[at : at + 16384] = ((x == y) & (x < key)).any(axis=(1, 2))
    return out


def _bounded(pairs: DataFrame, nodes: DataFrame, least: Fraction) -> DataFrame:
    """The pairs that the bound allows on all bits that both have."""
    over, under = least.denominator - least.numerator, least.denominator + least.numerator

    @F.arrow_udf("boolean")
    def near(a: pa.Array, b: pa.Array, total: pa.Array) -> pa.Array:
        rows = zip(texts(a), texts(b), total.to_pylist(), strict=True)
        return pa.array([_differ(x, y) * under <= over * n for x, y, n in rows], pa.bool_())

    a = nodes.select(F.col("node").alias("src"), F.col("n").alias("n_a"), F.col("parity").alias("a"))
    b = nodes.select(F.col("node").alias("dst"), F.col("n").alias("n_b"), F.col("parity").alias("b"))
    both = pairs.join(exchanged(a), "src").join(exchanged(b), "dst")
    return both.where(near("a", "b", F.col("n_a") + F.col("n_b"))).select("src", "dst")


def _settled(pairs: DataFrame, docs: DataFrame, text: str, shingle: int, least: Fraction, most: int = 1 << 20) -> DataFrame:
    """The pairs whose sets have at least the similarity; only sets that occur in a pair leave their task.

    The names of up to ``most`` sets are sent to all tasks; more of them are joined.
    """
    pairs = settle(pairs, "near_pairs")
    wanted = settle(pairs.select(F.explode(F.array("src", "dst")).alias("wanted")).distinct(), "near_wanted")
    names = None
    if wanted.count() <= most:
        names = np.sort(wanted.toArrow().column(0).to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            nodes, sets = [], []
            for raw in texts(batch.column(0)):
                found = shingle_set(raw, shingle)
                node = _node(found)
                if names is not None:
                    at = np.searchsorted(names, node)
                    if at == len(names) or names[at] != node:
                        continue
                nodes.append(node)
                sets.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "members"])

    made = docs.select(docs[f"`{text}`"].cast("binary").alias("text")).mapInArrow(run, "node long, members array<long>")
    if names is None:
        made = made.join(exchanged(wanted), F.col("node") == F.col("wanted"), "left_semi")
    sets = made.dropDuplicates(["node"])
    a = sets.select(F.col("node").alias("src"), F.col("members").alias("a"))
    b = sets.select(F.col("node").alias("dst"), F.col("members").alias("b"))
    both = pairs.join(exchanged(a), "src").join(exchanged(b), "dst")
    shared, total = F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b")
    near = shared * (least.numerator + least.denominator) >= total * least.numerator
    return settle(both.where(near).select("src", "dst"), "near_links")


def _by_bits(nodes: DataFrame) -> DataFrame:
    """Pairs of sets that SimHash holds for near: of each fingerprint the first set and every other one, and the first sets of linked fingerprints."""
    heads = settle(nodes.groupBy("f0").agg(F.min("node").alias("head")), "near_fingerprints")
    alike = nodes.join(exchanged(heads), "f0").select(F.col("head").alias("src"), F.col("node").alias("dst")).where("src <> dst")
    linked = simhash.near_links(heads.select(F.col("f0").alias("node"), "f0")).distinct()
    a, b = (heads.select(F.col("f0").alias(end), F.col("head").alias(f"{end}_head")) for end in ("src", "dst"))
    met = linked.join(exchanged(a), "src").join(exchanged(b), "dst").select(F.least("src_head", "dst_head").alias("src"), F.greatest("src_head", "dst_head").alias("dst"))
    return alike.unionByName(met)


def near_links(
    prints: DataFrame, docs: DataFrame, text: str, shingle: int, least: Fraction, block_rows: int = 2048, small: int = 16
) -> DataFrame:
    """``src, dst`` such that their components are those of all pairs of sets with the similarity.

    The fingerprints of the sets go through SimHash's index of byte positions
    first, and what it links is settled by the sets. Bits alone would lose pairs, so the prefixes come after it, for
    pairs that are not in one component by then.

    Two sets of similarity ``s`` share a member among the first ``n - ceil(s n) + 1``
    of each, in any one order of all members, so that every such pair meets in a
    list. Pairs of short lists, and of each long list those with its first
    member, are settled by the sets; then all other pairs of the long lists that
    are not yet in one component. So a large group of near copies makes no
    square of pairs. A list of over ``block_rows`` members is compared block
    against block in separate tasks.
    """
    first = [F.first(c).alias(c) for c in ("n", *_LONGS, "parity")] + [F.min("f0").alias("f0")]
    nodes = settle(prints.groupBy("node").agg(F.min("row").alias("row"), *first), "near_nodes", compression="zstd")
    close = _settled(_bounded(_by_bits(nodes), nodes, least), docs, text, shingle, least)

    def component_of(links: DataFrame, *columns: str) -> DataFrame:
        found = connected_components(links)
        return nodes.join(exchanged(found), F.col("node") == F.col("id"), "left").select("node", "n", F.coalesce("component", "node").alias("component"), *_LONGS, *columns)

    # one exchange of the postings serves both their count and the join
    single = prints.select("row", "node", "prefix").join(exchanged(nodes.select("row")), "row", "left_semi")
    postings = single.select("node", F.explode("prefix").alias("key")).repartition("key")
    lists = postings.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = settle(postings.join(exchanged(lists), "key"), "near_lists", compression="zstd")

    def groups(members: DataFrame, named: DataFrame) -> DataFrame:
        columns = [c for c in named.columns if c != "node"]
        blocks = members.withColumn("blocks", F.ceil(F.col("size") / F.lit(block_rows)).cast("int"))
        full = blocks.join(exchanged(named), "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
        others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
        dealt = full.withColumn("other", F.explode(others))
        return dealt.groupBy("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).agg(
            F.collect_list(F.struct("node", *columns)).alias("members")
        )

    met = _candidates(groups(members, component_of(close)), least, False, small)
    links = close.unionByName(_settled(_bounded(met, nodes, least), docs, text, shingle, least))
    long = members.where(F.col("size") > small)
    if long.isEmpty():
        return links
    named = component_of(links, "parity")
    # lists whose members are all in one component by now have nothing to tell
    ends = [F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("rows")]
    mixed = settle(long.join(exchanged(named.select("node", "component")), "node").groupBy("key").agg(*ends).where("a < b").select("key", "rows"), "near_mixed")
    apart = settle(spread_join(long, mixed, ["key"], "rows", ["node"]).drop("rows"), "near_apart", compression="zstd")
    # the first lists by key of each set; where there are fewer, a key that none comes after fills up
    first = apart.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("key")), 1, _FIRST).alias("first"))
    lists = [F.coalesce(F.get("first", F.lit(i)), F.lit((1 << 63) - 1)).alias(f"list{i}") for i in range(_FIRST)]
    named = named.join(exchanged(first), "node").select(*named.columns, *lists)
    rest = _settled(_candidates(groups(apart, named), least, True, small), docs, text, shingle, least)
    return links.unionByName(rest)


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, text: str = "text", doc_id: str = "doc_id", block_rows: int = 2048
) -> DataFrame:
    """One row of each component of texts linked by a similarity of their shingle sets of at least ``similarity``.

    The similarity is that of Jaccard, of distinct shingles. Texts without words
    are copies of each other. Of a component the row with the smallest id stays,
    one without an id only if no row has one; rows that share an id are judged
    by their texts. Columns and their order stay.
    """
    least = Fraction(similarity).limit_denominator(1000)
    common = _common(docs, text, shingle)
    prints = settle(_prints(docs, text, doc_id, shingle, least, common), "near_prints", compression="zstd")
    component = connected_components(near_links(prints, docs, text, shingle, least, block_rows))
    rows = prints.select("doc_id", "h", "node").join(exchanged(component), F.col("node") == F.col("id"), "left")
    return one_row_each(docs, rows.select("doc_id", "h", F.coalesce("component", "node").alias("component")), text, doc_id)
