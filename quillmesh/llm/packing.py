"""Filling containers of fixed capacity: harmonic packing.

A piece of size s belongs to class k = capacity // s, so any k pieces of a
class fit into one container.

1. *Harmonic step.*  The pieces of a class are spread over hash shards of bounded
   size, and every (class, shard) is filled by itself: k pieces a container, the
   number being the class's, whatever the sizes.  No worker knows of another.
2. *Tail step.*  A (class, shard) leaves less than k pieces over.  These few,
   of all classes together, are packed best fit in shards of their own.

How full the containers of each step are is told by :func:`fill_report`.  What
the fixed counts leave unused (about 1 / 2(k + 1) of a container) is the price of
independent workers; :func:`pack_tight` is the same rule with the room of every
container topped up from later classes, for when whole shards may be packed
by one worker.

A shard holds ``SHARD_PIECES`` pieces on average whatever the corpus, no
matter how sizes or ids repeat; shards are numbers drawn from the row's place
in a written table, so a lost task is repeated with the same pieces.

Defined results: items without size or of size 0 take no room and are left
out; an item longer than the capacity is split into full containers and
one remainder, which is packed like any piece; equal ids are items of their
own, repeated rows included; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.sources.stages import durable

#: Pieces in a shard on average.
SHARD_PIECES = 20_000


def pieces_of(items: DataFrame, id_col: str, size_col: str, capacity: int) -> DataFrame:
    """(item_id, part, size): whole items, or full containers and a remainder of longer ones."""
    sized = items.select(F.col(id_col).alias("item_id"), F.col(size_col).cast("long").alias("whole")).where("whole > 0")
    parts = F.sequence(F.lit(0).cast("long"), F.expr(f"(whole - 1) div {capacity}"))
    return sized.select("item_id", "whole", F.explode(parts).alias("part")).select("item_id", F.col("part").cast("int").alias("part"), F.least(F.lit(capacity), F.col("whole") - F.col("part") * capacity).cast("int").alias("size"))


def harmonic_fill(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each piece of one shard (sizes from 1 to the capacity)."""
    order = np.argsort(-sizes, kind="stable")
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in order[::-1]:
        stacks[sizes[i]].append(int(i))
    # below[s]: the largest size not above s that still has pieces, with path halving as stacks run empty
    below = list(range(capacity + 1))

    def longest(limit: int) -> int:
        while limit and not stacks[limit]:
            below[limit] = limit - 1 if below[limit] == limit else below[below[limit]]
            limit = below[limit]
        return limit

    container, number = np.full(len(sizes), -1, np.int64), -1
    top = longest(capacity)
    while top:
        number += 1
        k, room = capacity // top, capacity
        for _ in range(k):  # the class's fixed count, longest first; all of them fit
            size = longest(min(top, room))
            if not size or capacity // size != k:
                break
            container[stacks[size].pop()] = number
            room -= size
        while size := longest(room):
            container[stacks[size].pop()] = number
            room -= size
        top = longest(capacity)
    return container


def _numbered(items: DataFrame, id_col: str, size_col: str, capacity: int) -> DataFrame:
    """Written pieces with a number each: sizes are dear to compute, and the shard of a piece must not change when a task is repeated."""
    return durable(pieces_of(items, id_col, size_col, capacity).withColumn("draw", F.xxhash64(F.monotonically_increasing_id())))


def _packed_by_workers(pieces: DataFrame, capacity: int, shard: Column, mark: int) -> DataFrame:
    """Pieces packed best fit, a worker for each shard; ``mark`` tells its containers from others."""
    id_type = pieces.schema["item_id"].dataType.simpleString()

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "item_id", "part"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        number = harmonic_fill(group["size"].to_numpy(np.int64), capacity)
        return group.assign(container_id=(group["shard"] * 2 + mark) * (1 << 32) + number)[["item_id", "part", "size", "container_id"]]

    return pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(fill, f"item_id {id_type}, part int, size int, container_id long")


def pack(items: DataFrame, id_col: str, size_col: str, capacity: int, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(item_id, part, size, container_id, step) of every piece; step is ``harmonic`` or ``tail``."""
    pieces = _numbered(items, id_col, size_col, capacity).withColumn("class", F.floor(F.lit(capacity) / F.col("size")).cast("int"))
    # One row per class, of which there are at most as many as the capacity has units, tells how many shards a class has.
    sizes = pieces.groupBy("class").agg(F.count("*").alias("n")).withColumn("shards", F.ceil(F.col("n") / shard_pieces).cast("long"))
    spread = pieces.join(F.broadcast(sizes.select("class", "shards")), "class").withColumn("shard", F.pmod("draw", "shards"))
    place = F.row_number().over(W.partitionBy("class", "shard").orderBy("draw"))
    numbered = spread.withColumn("at", place - 1).withColumn("held", F.count("*").over(W.partitionBy("class", "shard")))
    bin_of = F.floor(F.col("at") / F.col("class")).cast("long")
    judged = durable(numbered.select("item_id", "part", "size", "draw", "class", "shard", bin_of.alias("bin"), (F.col("at") < F.col("held") - F.col("held") % F.col("class")).alias("full")))
    full = judged.where("full").select("item_id", "part", "size", (F.col("class") * F.lit(1 << 44) + F.col("shard") * F.lit(1 << 24) + F.col("bin")).alias("container_id"), F.lit("harmonic").alias("step"))
    rest = judged.where("NOT full").select("item_id", "part", "size", "draw")
    shards = max(1, -(-rest.count() // shard_pieces))
    tail = _packed_by_workers(rest, capacity, F.pmod("draw", F.lit(shards)), 0)
    # Numbers of the tail are negative: they meet no number of the harmonic step.
    return full.unionByName(tail.select("item_id", "part", "size", (-1 - F.col("container_id")).alias("container_id"), F.lit("tail").alias("step")))


def pack_tight(items: DataFrame, id_col: str, size_col: str, capacity: int, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(item_id, part, size, container_id, step): the harmonic counts open each container, later classes top it up, shard by shard."""
    pieces = _numbered(items, id_col, size_col, capacity)
    shards = max(1, -(-pieces.count() // shard_pieces))
    return _packed_by_workers(pieces, capacity, F.pmod("draw", F.lit(shards)), 1).withColumn("step", F.lit("tight"))


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """(step, n_containers, n_pieces, n_tokens, fullest, least_containers, share_used) of each step and, as step ``all``, of all containers."""
    per = packed.groupBy("step", "container_id").agg(F.sum("size").alias("used"), F.count("*").alias("pieces"))
    both = per.select(F.explode(F.array(F.col("step"), F.lit("all"))).alias("step"), "used", "pieces")
    return both.groupBy("step").agg(
        F.count("*").alias("n_containers"),
        F.sum("pieces").alias("n_pieces"),
        F.sum("used").alias("n_tokens"),
        F.max("used").alias("fullest"),
        F.ceil(F.sum("used") / capacity).alias("least_containers"),
        F.round(F.sum("used") / (F.count("*") * capacity), 4).alias("share_used"),
    )
