"""Filling fixed-capacity containers with items.

Items are dealt to groups of bounded size; each group places its items in the order they come, then improves
by local search: moves, one-for-one and two-for-one exchanges between underfull bins that raise
the sum of squared fills, until bins empty or nothing improves.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items of a group at most, on average; each group wastes less than one container beyond its bound.
GROUP = 20_000


def quick_fill(sizes: list[int], capacity: int, order: list[int] | None = None) -> list[list[int]]:
    """Bins as lists of item numbers: as they come, each into the fullest bin with room."""
    bins: list[list[int]] = []
    free: list[tuple[int, int]] = []  # (room, bin), ascending
    for i in range(len(sizes)) if order is None else order:
        s = sizes[i]
        at = bisect_left(free, (s, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > s or s == 0:
            insort(free, (room - s, b))
    return bins


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """As quick_fill, largest items first."""
    return quick_fill(sizes, capacity, sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)))


def least_bins(sizes: list[int], capacity: int) -> int:
    """Bins that any packing needs: items above half the capacity share none with each other, and those above
    capacity - k none with items of k or more (the bound L2 of Martello and Toth, over all k)."""
    if not sizes:
        return 0
    n = np.bincount(np.asarray(sizes), minlength=capacity + 1)[:capacity + 1]
    count, weight = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * np.arange(capacity + 1))])
    half = capacity // 2
    k = np.arange(0, half + 1)
    big = count[capacity + 1] - count[capacity - k + 1]
    mid = count[np.maximum(capacity - k, half) + 1] - count[half + 1]
    mid_weight = weight[np.maximum(capacity - k, half) + 1] - weight[half + 1]
    low = weight[half + 1] - weight[k]
    more = np.maximum(0, -(-(low - (mid * capacity - mid_weight)) // capacity))
    return max(1, int((big + mid + more).max()))


def _exchanges(items: list[int], sizes: list[int]) -> list[tuple[int, tuple[int, ...]]]:
    """(size, items) that a bin may give for one item: nothing, one, or two. Items of one size are alike, so a bin offers
    no more than its different sizes, of which there are few: their sum is the capacity at most."""
    by: dict[int, list[int]] = {}
    for i in items:
        if sizes[i] and len(by.setdefault(sizes[i], [])) < 2:
            by[sizes[i]].append(i)
    one = sorted((s, x[0]) for s, x in by.items())
    out: list[tuple[int, tuple[int, ...]]] = [(0, ())] + [(s, (i,)) for s, i in one]
    out += [(2 * s, (x[0], x[1])) for s, x in by.items() if len(x) > 1]
    return out + [(s + r, (i, j)) for k, (s, i) in enumerate(one) for r, j in one[:k]]


def _pour(bins: list[list[int]], fill: list[int], sizes: list[int], capacity: int, givers: list[int], takers: list[int]) -> int:
    """Weight that moves from givers to takers: each taker gets, for nothing or for one or two of its items, the giver's item that
    leaves it fullest, until none does. Givers are emptier than takers, so each step raises the sum of squared fills."""
    pool = sorted((sizes[i], i) for b in givers for i in bins[b] if sizes[i])
    where = {i: b for b in givers for i in bins[b]}
    moved = 0
    for b in takers:
        room = capacity - fill[b]
        while room and pool:
            top, best = 0, None
            for w, out in _exchanges(bins[b], sizes):
                at = bisect_right(pool, (w + room, len(sizes))) - 1
                if at >= 0 and pool[at][0] - w > top and fill[where[pool[at][1]]] <= fill[b]:
                    top, best = pool[at][0] - w, (at, out)
                    if top == room:
                        break
            if best is None:
                break
            at, out = best
            i = pool.pop(at)[1]
            giver = where.pop(i)
            bins[giver] = [x for x in bins[giver] if x != i] + list(out)
            bins[b] = [x for x in bins[b] if x not in out] + [i]
            for x in out:
                where[x] = giver
                insort(pool, (sizes[x], x))
            fill[b] += top
            fill[giver] -= top
            room -= top
            moved += top
    return moved


def improve(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Empty bins by exchanges that raise the sum of squared fills; the search ends once no packing could have fewer bins, or nothing moves.

    The emptiest bins, as many as are above the bound, give to all others, and what is left in them is placed anew if that
    raises the sum; then the emptier half of the underfull bins gives to the fuller one, which gathers room where bins may empty.
    """
    bins = [list(b) for b in bins if b]
    bound = least_bins(sizes, capacity)
    fill = [sum(sizes[i] for i in b) for b in bins]
    while True:
        order = sorted((b for b in range(len(bins)) if bins[b]), key=lambda b: (fill[b], b))
        above = len(order) - bound
        if above <= 0:
            break
        moved = _pour(bins, fill, sizes, capacity, order[:above], order[:above - 1:-1])
        left = [b for b in order[:above] if bins[b]]
        items = [i for b in left for i in bins[b]]
        again = [[items[j] for j in b] for b in best_fit([sizes[i] for i in items], capacity)]
        fills = [sum(sizes[i] for i in b) for b in again]
        if len(again) <= len(left) and sum(f * f for f in fills) > sum(fill[b] ** 2 for b in left):
            for k, b in enumerate(left):
                bins[b], fill[b] = (again[k], fills[k]) if k < len(again) else ([], 0)
            moved += 1
        under = sorted((b for b in range(len(bins)) if bins[b] and fill[b] < capacity), key=lambda b: (fill[b], b))
        half = len(under) // 2
        moved += _pour(bins, fill, sizes, capacity, under[:half], under[:half - 1:-1] if half else under)
        if not moved:
            break
    return [b for b in bins if b]


def fill_bins(sizes: list[int], capacity: int) -> list[list[int]]:
    """The better of two searches; the second starts from the largest items and is made only if the first misses the bound."""
    first = improve(quick_fill(sizes, capacity), sizes, capacity)
    if len(first) <= least_bins(sizes, capacity):
        return first
    return min(first, improve(best_fit(sizes, capacity), sizes, capacity), key=len)


def pack(items: DataFrame, containers: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", group: int = GROUP) -> DataFrame:
    """(container_kind, container_id, doc_id, piece, start, n_tokens): every item in containers of every kind.

    An item larger than the capacity is divided into full containers and a rest; no other item is.
    Sizes that are null count as 0; items of size 0 share a container. Repeated ids are items of their own. Kinds whose
    capacity is null or below 1 are left out. Groups are dealt by row, so no key can make one large. The
    table of kinds is small by nature and refused beyond 1,000 rows.
    """
    from telarium.session import settle

    base = settle(items.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(size_col).cast("int"), F.lit(0)).alias("size")))
    kinds = containers.select(F.col("container_kind").cast("string"), F.col("capacity").cast("int")).where("capacity >= 1").distinct().take(1001)
    if len(kinds) > 1000:
        raise ValueError("more than 1,000 kinds of containers")
    each = F.explode(F.array(*[F.struct(F.lit(k).cast("string").alias("kind"), F.lit(c).alias("capacity")) for k, c in kinds]) if kinds else F.expr("cast(array() as array<struct<kind:string,capacity:int>>)"))
    n = base.count()
    groups = max(1, -(-n // group))
    dealt = base.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id(), "doc_id"), F.lit(groups)).cast("int")).select("doc_id", "size", "g", each.alias("k")).select("doc_id", "size", "g", "k.kind", "k.capacity")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "size"], kind="stable")
        cap, g, kind = int(pdf.capacity.iloc[0]), int(pdf.g.iloc[0]), pdf.kind.iloc[0]
        doc, size = pdf.doc_id.to_numpy(), pdf["size"].to_numpy()
        full, rest = size // cap, size % cap
        bins = fill_bins([int(r) for r, f in zip(rest, full) if r or not f], cap)
        open_ = np.flatnonzero((rest > 0) | (full == 0))
        k = np.zeros(len(open_), np.int64)
        for b, members in enumerate(bins):
            k[members] = b
        which = np.repeat(np.arange(len(doc)), full)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(full) - full, full)
        who = np.concatenate([open_, which])
        piece = np.concatenate([full[open_], nth])
        return pd.DataFrame({
            "container_kind": kind,
            "container_id": (np.int64(g) << 32) + np.concatenate([k, len(bins) + np.arange(len(which))]),
            "doc_id": doc[who], "piece": piece.astype("int32"), "start": (piece * cap).astype("int32"),
            "n_tokens": np.concatenate([rest[open_], np.full(len(which), cap)]).astype("int32"),
        })

    return dealt.repartition(groups * max(1, len(kinds)), "kind", "g").groupBy("kind", "g").applyInPandas(run, "container_kind string, container_id long, doc_id long, piece int, start int, n_tokens int")


def fills(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """(container_kind, capacity, containers, tokens, unused share, bound): how full the containers are; bound is the least number that could hold the tokens."""
    per = packed.groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("t")).groupBy(F.col("container_kind").alias("kind")).agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"))
    c = containers.select("container_kind", F.col("capacity").cast("long").alias("capacity")).distinct()
    return c.join(per, F.col("container_kind") == F.col("kind")).select(
        "container_kind", "capacity", "containers", "tokens", "fullest", (1 - F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("unused"), F.ceil(F.col("tokens") / F.col("capacity")).alias("bound")
    )
