"""Vector bin packing of texts into containers of fixed capacity.

Every item has three sizes - tokens, segments (one) and loss-bearing tokens -
and a container has a limit on each. A container is filled by the dot-product
heuristic: of the items that fit, the one whose sizes point most along what the
container has left goes in. An item is divided only if it alone exceeds the
capacity; its full parts are containers of their own and the rest is an item.
An item within the capacity that alone exceeds the limit on loss-bearing tokens
is a container of its own, too.

Items are spread over shards by a hash, as many as their number asks for, and
each shard is packed in one task, as numbers only: a shard holds ``shard_items``
items, but for uneven hashing, on every level and at any corpus size.
Containers that are full by none of their limits are emptied again and their
items packed anew, in shards for the items left: the waste of shard ends does
not add up. When a level places less than a tenth of its items - then it is the
items' sizes that leave room, not the shards - what it packed stays.

Defined results: empty items (no tokens) take a segment but no room; items
are unique by key and part, so repeated texts are placed as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.functions.frames import frame
from fundloom.session import checkpoint, spread

CAPACITY, MAX_SEGMENTS, MAX_LOSS = 2_048, 16, 1_920
SHARD_ITEMS, GOOD_FILL, LEAST_GAIN = 20_000, 0.97, 0.1


def pack(tokens: np.ndarray, loss: np.ndarray, capacity: int, max_segments: int, max_loss: int) -> np.ndarray:
    """Container number of each item; every item fits alone."""
    limits = np.array([capacity, max_segments, max_loss], dtype=float)
    if len(tokens) and (tokens.max() > capacity or loss.max() > max_loss or max_segments < 1):
        raise ValueError("an item exceeds a container")
    sizes, inverse = np.unique(np.stack([tokens, loss], axis=1), axis=0, return_inverse=True)
    inverse = inverse.ravel()
    order = np.argsort(inverse, kind="stable")
    starts = np.searchsorted(inverse[order], np.arange(len(sizes)))
    left = np.bincount(inverse, minlength=len(sizes))
    demand = np.stack([sizes[:, 0], np.ones(len(sizes)), sizes[:, 1]], axis=1).astype(float)
    share = demand / limits
    out, container, remaining = np.zeros(len(tokens), dtype=np.int64), 0, len(tokens)
    live = np.arange(len(sizes))
    while remaining:
        room = limits.copy()
        options = live
        while len(options):
            options = options[(demand[options] <= room).all(axis=1) & (left[options] > 0)]
            if not len(options):
                break
            score = share[options] @ (room / limits)
            best = options[int(score.argmax())]
            out[order[starts[best]]] = container
            starts[best] += 1
            left[best] -= 1
            remaining -= 1
            room -= demand[best]
        live = live[left[live] > 0]
        container += 1
    return out


def items(sizes: DataFrame, key: str, capacity: int) -> DataFrame:
    """(key, part, start, tokens, loss): the parts of each measured text; only oversized ones have several."""
    tokens, prompt = F.col("prompt_tokens") + F.col("answer_tokens"), F.col("prompt_tokens")
    parts = F.when(tokens > capacity, F.ceil(tokens / capacity)).otherwise(F.lit(1))
    width = F.when(tokens > capacity, F.lit(capacity)).otherwise(tokens)
    split = sizes.select(F.col(key), tokens.alias("all"), prompt.alias("prompt"), width.alias("width"), F.explode(F.sequence(F.lit(0), parts.cast("int") - 1)).alias("part"))
    start = F.col("part") * F.col("width")
    size = F.least(F.col("width"), F.col("all") - start)
    return split.select(
        key, "part", start.cast("bigint").alias("start"), size.cast("bigint").alias("tokens"),
        (size - F.least(size, F.greatest(F.lit(0), F.col("prompt") - start))).cast("bigint").alias("loss"),
    )


def containers(
    sizes: DataFrame, key: str, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS,
    shard_items: int = SHARD_ITEMS, good_fill: float = GOOD_FILL,
) -> DataFrame:
    """(container_id, key, part, start, tokens, loss): every item in its container."""
    kind = sizes.schema[key].dataType.simpleString()
    todo = checkpoint(items(sizes, key, capacity))
    # full parts, and items that no other may join, are containers of their own
    alone = (F.col("tokens") == capacity) | (F.col("loss") >= max_loss)
    done = todo.filter(alone).select(F.concat_ws("-", F.lit("f"), F.col(key).cast("string"), "part").alias("container_id"), key, "part", "start", "tokens", "loss")
    todo, level = todo.filter(~alone), 0
    left = todo.count()

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["tokens", "key", "part"])
        tokens, loss = g["tokens"].to_numpy(), g["loss"].to_numpy()
        n = pack(tokens, loss, capacity, max_segments, max_loss)
        fill = np.maximum.reduce([np.bincount(n, weights=tokens) / capacity, np.bincount(n, weights=loss) / max_loss, np.bincount(n) / max_segments])[n]
        prefix = f"{level}-{g['shard'].iloc[0]}-"
        return frame(container_id=[prefix + str(i) for i in n], key=g["key"], part=g["part"], start=g["start"], tokens=g["tokens"], loss=g["loss"], fill=fill)

    while True:
        shards = max(1, -(-left // shard_items))
        sharded = todo.select(
            F.col(key).alias("key"), "part", "start", "tokens", "loss", F.pmod(F.xxhash64(F.lit(level), key, "part"), F.lit(shards)).alias("shard")
        )
        packed = checkpoint(spread(sharded, "shard").groupBy("shard").applyInPandas(
            run, f"container_id string, key {kind}, part int, start bigint, tokens bigint, loss bigint, fill double"
        ).withColumnRenamed("key", key))
        open_ = packed.filter(F.col("fill") < good_fill)
        before, left = left, 0 if shards == 1 else open_.count()
        if left == 0 or left > (1 - LEAST_GAIN) * before:
            return done.unionByName(packed.drop("fill"))
        done = done.unionByName(packed.filter(F.col("fill") >= good_fill).drop("fill"))
        todo, level = open_.drop("fill", "container_id"), level + 1


def report(placed: DataFrame, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS, good_fill: float = GOOD_FILL) -> DataFrame:
    """(containers, items, divided_items, tokens, unused_tokens, fill, full_tokens, full_segments, full_loss) over all containers.

    The last three count the containers that each limit binds: filled to ``good_fill`` of it.
    """
    per = placed.groupBy("container_id").agg(
        F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"), F.sum((F.col("part") > 0).cast("int")).alias("d"), F.sum("loss").alias("l")
    )
    binds = lambda c, limit: F.count_if(F.col(c) >= good_fill * limit)
    return per.agg(
        F.count(F.lit(1)).alias("containers"), F.sum("n").alias("items"), F.sum("d").alias("divided_items"), F.sum("t").alias("tokens"),
        (F.count(F.lit(1)) * capacity - F.sum("t")).alias("unused_tokens"), F.round(F.sum("t") / (F.count(F.lit(1)) * capacity), 6).alias("fill"),
        binds("t", capacity).alias("full_tokens"), binds("n", max_segments).alias("full_segments"), binds("l", max_loss).alias("full_loss"),
    )
