"""Sharding by histogram sort: splitters from exact byte counts, then one exchange."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rastra.storage import settle

#: Width of the sort keys, and of the document's hash at their end.
KEY_BITS = 62
_DOC_BITS = 26


def order_key(text: Column, doc_id: Column) -> Column:
    """Sort key of 62 bits: 36 of the text's hash above 26 of the document's hash.

    Equal texts are neighbours in key order, and a group of copies of any size
    still has distinct keys inside, so that a splitter can fall within it. Texts
    that share 36 bits are told apart inside a cell by their whole hash.
    """
    above, below = F.lit(1 << (KEY_BITS - _DOC_BITS)), F.lit(1 << _DOC_BITS)
    return F.pmod(F.xxhash64(text), above) * below + F.pmod(F.xxhash64(F.lit(7), doc_id), below)


def find_splitters(keyed: DataFrame, n_parts: int, tolerance: float = 0.002, bits: int = 10) -> DataFrame:
    """``nth, splitter``: the ``n_parts - 1`` keys that cut ``keyed`` (``key, size``) into parts of near equal bytes.

    Every round counts the exact bytes below equally spaced probes, ``1 << bits`` in each bin
    that still holds an unsettled splitter; a splitter is settled when the bytes
    below its best probe are within ``tolerance`` of a part of its target. Bins, counts and splitters
    are tables throughout; the open bins, at most one a splitter and 16 bytes each, and the numbers of the settled splitters are sent to
    all tasks, and the driver learns just whether there are any. Rows of no size count for nothing.
    """
    spark = keyed.sparkSession
    total = keyed.agg(F.sum("size")).first()[0] or 0
    if not total or n_parts < 2:
        return spark.range(1, max(n_parts, 1)).select(F.col("id").alias("nth"), F.lit(0).cast("long").alias("splitter"))
    slack, n = F.lit(tolerance * total / n_parts), F.lit(float(n_parts))
    nth_at = lambda low: F.ceil(low * n / F.lit(float(total))).cast("long")  # noqa: E731  the first splitter that wants as many bytes below it
    open_ = spark.range(1).select(F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    found, resolved = None, 0
    while True:
        step = min(bits, KEY_BITS - resolved)
        resolved += step
        up = KEY_BITS - resolved
        bins = keyed.select(F.shiftright("key", up).alias("bin"), F.shiftright("key", up + step).alias("prefix"), "size").join(F.broadcast(open_), "prefix")
        counts = bins.groupBy("prefix", "below", "bin").agg(F.sum("size").alias("size")).where("size > 0")
        before = Window.partitionBy("prefix").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as probes
        placed = counts.withColumn("low", F.col("below") + F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn("high", F.col("low") + F.col("size"))
        inside = placed.withColumns({"first": F.greatest(nth_at(F.col("low")), F.lit(1)), "last": F.least(nth_at(F.col("high")) - 1, F.lit(n_parts - 1))}).where("first <= last")
        each = inside.withColumn("nth", F.explode(F.sequence("first", "last"))).withColumn("want", F.col("nth") * F.lit(float(total)) / n)
        if found is not None:  # a bin may hold both kinds
            each = each.join(F.broadcast(found.select("nth")), "nth", "left_anti")
        under, over = F.col("want") - F.col("low"), F.col("high") - F.col("want")
        settled = (F.least(under, over) <= slack) | F.lit(up == 0)
        nearest = F.shiftleft(F.when(under <= over, F.col("bin")).otherwise(F.col("bin") + 1), up)
        judged = settle(each.select("nth", "bin", "low", F.when(settled, nearest).alias("splitter")), "shard_probes")
        done = judged.where("splitter IS NOT NULL").select("nth", "splitter")
        found = done if found is None else found.unionByName(done)
        open_ = judged.where("splitter IS NULL").select(F.col("bin").alias("prefix"), F.col("low").alias("below")).distinct()
        if open_.isEmpty():
            return found


def _sorted_once(table: DataFrame, by: str, value: str) -> Column:
    """A column of a small table as one array in the order of another, found once by a scalar subquery: the plan doesn't grow with it."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(by).alias("by"), F.col(value).alias("value"))))
    return table.agg(F.transform(pairs, lambda p: p["value"]).alias("all")).scalar()


def _with_cells(rows: DataFrame, splitters: DataFrame, n: int) -> DataFrame:
    """``rows`` and ``cell``: how many of ``n`` ascending splitters are at or below their ``key``, by binary search."""
    given = rows.withColumn("_splitters", _sorted_once(splitters, "nth", "splitter"))
    key, splitters = F.col("key"), F.col("_splitters")

    def halve(range_: Column, _: Column) -> Column:
        middle = F.floor((range_["lo"] + range_["hi"]) / 2).cast("int")
        left = (range_["lo"] < range_["hi"]) & (key < F.get(splitters, F.least(middle, F.lit(n - 1))))
        right = (range_["lo"] < range_["hi"]) & ~left
        return F.struct(F.when(right, middle + 1).otherwise(range_["lo"]).alias("lo"), F.when(left, middle).otherwise(range_["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length())), start, halve)["lo"] if n else F.lit(0)
    return given.withColumn("cell", found).drop("_splitters")


def shard_by_bytes(
    df: DataFrame,
    n_shards: int = 40,
    text: str = "text",
    doc_id: str = "doc_id",
    overhead: int = 16,
    cell_bytes: int = 256 << 20,
    tolerance: float = 0.002,
) -> DataFrame:
    """Deal rows into ``n_shards`` of near equal bytes, copies side by side.

    Adds ``size`` (UTF-8 bytes of the text plus ``overhead``; a null text has
    none), ``text_crc32`` (of the empty text for null), ``shard`` and ``slot``
    (gapless from 0 in each shard); columns of those names in the input give
    way to them. Rows are sorted by text hash, then document, so equal texts are
    neighbours and a group is cut only where a splitter must fall within it.
    A shard is made of cells of at most about ``cell_bytes``, and one task
    numbers one cell, whatever the size of a shard. The splitters and the cells'
    first slots, eight bytes a cell each, are all that tasks get. Rows that agree in id and
    text are kept and get slots of their own, but have one key, within which no
    splitter can fall. An empty table gives an empty result.
    """
    base = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))
    body, ident = F.coalesce(F.col(f"row.`{text}`"), F.lit("")), F.col(f"row.`{doc_id}`")
    sized = base.select(
        "row",
        (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        order_key(body, ident).alias("key"),
        F.xxhash64(body).alias("print"),
    )
    narrow = sized.select("key", "size").persist()
    try:
        total = narrow.agg(F.sum("size")).first()[0] or 0
        per = max(1, math.ceil(total / n_shards / cell_bytes))
        edges = settle(find_splitters(narrow, n_shards * per, tolerance), "shard_splitters")
        splitters = n_shards * per - 1
        counts = df.sparkSession.range(n_shards * per).select(F.col("id").cast("int").alias("cell")).join(_with_cells(narrow, edges, splitters).groupBy("cell").count(), "cell", "left")
        before = Window.partitionBy(F.floor(F.col("cell") / F.lit(per))).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # a row a cell
        starts = settle(counts.select("cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")), "shard_starts")
    finally:
        narrow.unpersist()
    placed = _with_cells(sized, edges, splitters)
    order = Window.partitionBy("cell").orderBy(F.shiftright("key", _DOC_BITS), "print", "key", ident, "text_crc32", "size")
    numbered = placed.withColumn("nth", F.row_number().over(order) - 1)
    own = {"size", "text_crc32", "shard", "slot"}
    return numbered.select(
        *[F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in own],
        "size",
        "text_crc32",
        F.floor(F.col("cell") / F.lit(per)).cast("int").alias("shard"),
        (F.col("nth") + F.get(_sorted_once(starts, "cell", "start"), F.col("cell"))).cast("long").alias("slot"),
    )
