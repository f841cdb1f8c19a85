"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rastra.llm.common import WORD
from rastra.storage import discard, exchanged, settle


def water_fill(sizes: dict, weights: dict, total: float, ceiling: float = 2.0) -> dict:
    """Targets in proportion to the weights, none above ``ceiling`` times its source's size.

    What a full source can't take is shared again among the others by weight.
    """
    targets, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), total
    while open_:
        share = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / share > ceiling * sizes[s]}
        for s in full or open_:
            targets[s] = ceiling * sizes[s] if s in full else left * weights[s] / share
        if not full:
            break
        left -= sum(targets[s] for s in full)
        open_ -= full
    return targets


def _fold(units: Column, seed: int) -> Column:
    """Pivotal rounding along an array of ``(weight, id, nth, mass)``.

    Each step pairs the unit still open with the next one and moves weight
    between them, in a random direction, until one of the two is integral. The
    odds of the directions keep each unit's expectation; the sum of weight times
    mass is kept exactly.
    """

    def pair(state: Column, unit: Column) -> Column:
        room_a, room_b = (1 - state["mass"]) * state["weight"], (1 - unit["mass"]) * unit["weight"]
        full_a, full_b = state["mass"] * state["weight"], unit["mass"] * unit["weight"]
        up, down = F.least(room_a, full_b), F.least(full_a, room_b)  # what can move to the open unit, and from it
        coin = F.pmod(F.xxhash64(F.lit(seed), state["id"], state["nth"], unit["id"], unit["nth"]), F.lit(1 << 52)) / F.lit(float(1 << 52))
        rises = coin * (up + down) < down
        a_done = F.when(rises, room_a <= full_b).otherwise(full_a <= room_b)
        copy = F.when(rises == a_done, 1).otherwise(0)
        left = F.when(
            a_done, unit["mass"] + F.when(rises, -up).otherwise(down) / unit["weight"]
        ).otherwise(state["mass"] + F.when(rises, up).otherwise(-down) / state["weight"])
        done = F.struct(
            F.when(a_done, state["id"]).otherwise(unit["id"]).alias("id"),
            F.when(a_done, state["nth"]).otherwise(unit["nth"]).alias("nth"),
            copy.alias("copy"),
        )
        return F.struct(
            F.when(a_done, unit["id"]).otherwise(state["id"]).alias("id"),
            F.when(a_done, unit["nth"]).otherwise(state["nth"]).alias("nth"),
            F.when(a_done, unit["weight"]).otherwise(state["weight"]).alias("weight"),
            F.least(F.lit(1.0), F.greatest(F.lit(0.0), left)).alias("mass"),
            F.concat(state["done"], F.array(done)).alias("done"),
        )

    first = units[0]
    start = F.struct(
        first["id"].alias("id"),
        first["nth"].alias("nth"),
        first["weight"].alias("weight"),
        first["mass"].alias("mass"),
        F.slice(F.array(F.struct(first["id"].alias("id"), first["nth"].alias("nth"), F.lit(0).alias("copy"))), 1, 0).alias("done"),
    )
    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), start, pair)


#: So many rows, one a source or a source and band, can go to all tasks.
FEW = 1 << 16


def pivotal_round(units: DataFrame, group: str = "grp", block_rows: int = 256, seed: int = 11) -> DataFrame:
    """Round the ``mass`` (0 to 1) of the units of each group to 0 or 1 copy.

    ``units`` has ``grp, id, nth, weight, mass``, of positive weight. Blocks of about ``block_rows``
    units of near equal weight are folded side by side; each leaves one open
    unit, and the open units are folded again, level by level, until a group has
    one left, which is rounded to the nearer side: a group's weight of copies is
    off its sum of weight times mass by half that unit's weight at most. Blocks
    come from hashes of the units alone, so that reruns and other partitionings
    agree. Returns ``grp, id, nth, copy``.
    """
    level, decided, alive = 0, None, units.select(group, "id", "nth", "weight", "mass")
    while True:
        # weights a tenth apart share a class at the first level, wider ones later
        band = F.floor(F.log2(F.col("weight") + 1.0) * F.lit([8.0, 1.0][level] if level < 2 else 0.0)).cast("long")
        banded = alive.withColumn("band", band)
        counts = banded.groupBy(group, "band").agg(F.count("*").alias("n"))
        sizes = counts.withColumn("in_group", F.sum("n").over(Window.partitionBy(group)))
        plan = sizes.select(
            F.col(group).alias("g2"),
            F.col("band").alias("b2"),
            (F.col("in_group") <= block_rows).alias("single"),
            F.ceil(F.col("n") / F.lit(block_rows)).cast("long").alias("blocks"),
        )
        plan = settle(plan, "pivotal_plan")
        plan = F.broadcast(plan) if plan.count() <= FEW else exchanged(plan)
        blocked = banded.join(plan, banded[group].eqNullSafe(F.col("g2")) & (F.col("band") == F.col("b2"))).select(
            group,
            F.when(F.col("single"), F.lit(-1)).otherwise(F.col("band")).alias("band"),
            F.when(F.col("single"), F.lit(0)).otherwise(F.pmod(F.xxhash64(F.lit(seed + 1 + level), "id", "nth"), F.col("blocks"))).alias("block"),
            F.struct((-F.col("weight")).alias("w"), "id", "nth", "weight", "mass").alias("unit"),
        )
        folded = blocked.groupBy(group, "band", "block").agg(F.sort_array(F.collect_list("unit")).alias("units"))
        folded = settle(folded.select(group, "band", "block", _fold(F.col("units"), seed).alias("out")), "pivotal")
        done = folded.select(group, F.explode("out.done").alias("d")).select(group, "d.id", "d.nth", "d.copy")
        decided = done if decided is None else decided.unionByName(done)
        alive = folded.select(group, "out.id", "out.nth", "out.weight", "out.mass")
        level += 1
        if alive.groupBy(group).count().where("count > 1").isEmpty():
            break
    last = alive.select(group, "id", "nth", (F.col("mass") >= 0.5).cast("int").alias("copy"))
    return decided.unionByName(last)


def mix_sources(
    df: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    ceiling: float = 2.0,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    block_rows: int = 256,
    seed: int = 11,
) -> DataFrame:
    """How many copies of each row a mix takes, so that sources reach their targets.

    Sources in code point order, null last, get the weights in turn; together
    they get ``share`` of all words, none above ``ceiling`` times its own words.
    A source's rows each get the whole part of target over size, and the
    fraction is settled by pivotal rounding, which keeps the sum of words. Adds
    ``size`` (words of the text, 0 for null), ``source_size``, ``target`` and
    ``copies``; columns of those names in the input give way. A text without
    words gets the whole part alone. Rows that agree in source, id and text are
    one unit of rounding and share its copies evenly, in an order of a hash of
    all their columns. An empty table gives an empty result. Words are counted
    once, into a narrow table. The list of sources and their sizes is held by
    the driver: it is the mix's configuration, one entry a source.
    """
    own = {"size", "source_size", "target", "copies"}
    base = df.select(
        F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"),
    ).select(
        "row",
        F.col(f"row.`{source}`").alias("grp"),
        F.col(f"row.`{doc_id}`").alias("id"),
        F.xxhash64(f"row.`{text}`").alias("nth"),
    )
    words = F.coalesce(F.regexp_count(f"row.`{text}`", F.lit(WORD)), F.lit(0)).cast("long")
    counted = base.select("grp", "id", "nth", words.alias("size")).groupBy("grp", "id", "nth").agg(F.max("size").alias("size"), F.count("*").alias("alike"))
    counted = settle(counted, "mix_sizes", compression="zstd")
    sizes = {r["grp"]: r["size"] for r in counted.groupBy("grp").agg(F.sum(F.col("size") * F.col("alike")).alias("size")).collect()}
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    targets = water_fill(sizes, weight, share * sum(sizes.values()), ceiling)
    spark = df.sparkSession
    rates = []
    for s in ordered:
        rate = targets[s] / sizes[s] if sizes[s] else 0.0
        rates.append((s, sizes[s], float(targets[s]), int(rate), rate - int(rate)))
    goal = spark.createDataFrame(rates, f"g {df.schema[source].dataType.simpleString()}, source_size long, target double, whole long, mass double")
    share_ = F.when(F.col("size") > 0, F.col("mass") * F.col("alike")).otherwise(0.0)
    rated = counted.join(F.broadcast(goal) if len(rates) <= FEW else exchanged(goal), F.col("grp").eqNullSafe(F.col("g"))).drop("g")
    rated = rated.withColumns({"sure": F.floor(share_), "mass": share_ - F.floor(share_)})
    units = rated.where("mass > 0").select("grp", "id", "nth", F.col("size").cast("double").alias("weight"), "mass")
    rounded = pivotal_round(units, "grp", block_rows, seed).select(*[F.col(c).alias(f"r_{c}") for c in ("grp", "id", "nth", "copy")])
    alike = lambda n: [F.col(c).eqNullSafe(F.col(f"{n}_{c}")) for c in ("grp", "id")] + [F.col("nth") == F.col(f"{n}_nth")]
    settled = rated.join(exchanged(rounded), alike("r"), "left").withColumn("extra", F.col("sure") + F.coalesce("r_copy", F.lit(0)))
    keys = [F.col(c).alias(f"k_{c}") for c in ("grp", "id", "nth")]
    settled = settle(settled.select(*keys, "size", "source_size", "target", "whole", "alike", "extra"), "mix_copies", compression="zstd")
    discard(counted)

    def named(found: DataFrame, copies: Column) -> DataFrame:
        return found.withColumn("copies", copies.cast("long")).select(
            *[F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in own], "size", "source_size", "target", "copies"
        )

    out = named(base.join(exchanged(settled.where("alike = 1")), alike("k")), F.col("whole") + F.col("extra"))
    many = settled.where("alike > 1")
    if many.isEmpty():
        return out
    turn = F.row_number().over(Window.partitionBy("grp", "id", "nth").orderBy(F.xxhash64("row")))
    shared = F.floor(F.col("extra") / F.col("alike")) + (turn <= F.col("extra") % F.col("alike")).cast("long")
    return out.unionByName(named(base.join(exchanged(many), alike("k")), F.col("whole") + shared))


def take_mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of the mix: each as often as :func:`mix_sources` takes it, with its columns, in no order.

    Nulls, texts without words, repeated rows and empty tables are as there;
    columns keep their names, whatever these are, and their order.
    """
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("packed"),
        docs[f"`{text}`"].alias("text"),
        docs[f"`{source}`"].alias("source"),
        docs[f"`{doc_id}`"].alias("doc_id"),
    )
    mixed = mix_sources(packed, **options).where("copies > 0")
    times = mixed.select("packed", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth"))
    return times.select(*[F.col(f"packed.`{c}`").alias(c) for c in docs.columns])
