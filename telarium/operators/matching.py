"""Matching rows to objectives by what their statements say."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telarium.functions import text as T

# Least similarity, margin to the second, least length, length of grams.
THRESHOLD, MARGIN, LEAST, GRAM = 0.55, 0.10, 25, 5
#: Least score of a candidate: THRESHOLD - MARGIN, without the error of that subtraction.
CANDIDATE = 0.45
#: Rows or objectives of a group in one block; larger groups are divided. So there are at most rows / BLOCK of these.
BLOCK = 8192
#: Pairs of a block compared at a time, postings counted at a time, pairs returned at a time.
CELLS, POSTINGS, PAIRS = 1 << 17, 1 << 20, 1 << 18

#: Compact texts have these letters only, so a gram is a number of GRAM digits to this base, below 2^26.
_DIGIT = np.zeros(128, np.int64)
_DIGIT[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = np.arange(36)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, gram): the distinct grams of each text, in order of texts."""
    n = np.array([len(t) for t in texts], np.int64)
    x = _DIGIT[np.frombuffer("".join(texts).encode(), np.uint8)]
    code = sum(x[i:len(x) - GRAM + 1 + i] * 36 ** i for i in range(GRAM))
    text = np.repeat(np.arange(len(n)), n)[:len(code)]
    whole = np.arange(len(code)) + GRAM <= np.cumsum(n)[text]
    key = np.unique(text[whole] << 26 | code[whole])
    return key >> 26, key & (1 << 26) - 1


def _ranges(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers starts[i], starts[i] + 1, ... (n[i] of them) of all i in turn."""
    return np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())


def _members(of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places that have each of the numbers below n: their order, first of them and number."""
    many = np.bincount(of, minlength=n)
    return np.argsort(of, kind="stable"), np.cumsum(many) - many, many


def _near(row: np.ndarray, score: np.ndarray, near: float) -> np.ndarray:
    """Of pairs in order of rows, those less than ``near`` below the best of their row, and the two best of it."""
    first = np.flatnonzero(np.diff(row, prepend=-1))
    n = np.diff(first, append=len(row))
    best = np.repeat(np.maximum.reduceat(score, first), n)
    at = np.where(score == best, np.arange(len(row)), len(row))
    rest = score.copy()
    rest[np.minimum.reduceat(at, first)] = -1
    return (best - score < near) | (score >= np.repeat(np.maximum.reduceat(rest, first), n))


def _numbered(texts: list[str], number: dict[str, int]) -> np.ndarray:
    """Of each text its number in ``number``, which takes up new ones."""
    return np.array([number.setdefault(t, len(number)) for t in texts], np.int64)


def _compare(a: list[str], b: list[str], least: float, near: float | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place in a, place in b, score) of the pairs of one block, some at a time; equal texts are compared once."""
    ta, tb = {}, {}
    return _places(ta, _numbered(a, ta), tb, _numbered(b, tb), least, near)


def _places(ta: dict[str, int], of_a: np.ndarray, tb: dict[str, int], of_b: np.ndarray, least: float, near: float | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As _compare(), from the distinct texts and the number of the text at each place."""
    (ma, fa, na), (mb, fb, nb) = _members(of_a, len(ta)), _members(of_b, len(tb))
    for r, c, score in _pairs(list(ta), list(tb), least, len(of_b)):
        r, score, o = np.repeat(r, nb[c]), np.repeat(score, nb[c]), mb[_ranges(fb[c], nb[c])]
        if near is not None and len(r):
            kept = _near(r, score, near)
            r, score, o = r[kept], score[kept], o[kept]
        for k in _slices(np.cumsum(na[r]), PAIRS):
            yield ma[_ranges(fa[r[k]], na[r[k]])], np.repeat(o[k], na[r[k]]), np.repeat(score[k], na[r[k]])


def _pairs(ta: list[str], tb: list[str], least: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(number in ta, number in tb, score) of distinct texts, in order of ta, those of some of ta at a time; width: what one of ta may lead to."""
    text, gram = _grams(ta)
    held, posted = _grams(tb)
    size_a, size_b = np.bincount(text, minlength=len(ta)), np.bincount(held, minlength=len(tb))
    order = np.argsort(posted, kind="stable")
    posted, held = posted[order], held[order]
    known = np.flatnonzero(np.diff(posted, prepend=-1))
    at = np.minimum(np.searchsorted(posted[known], gram), len(known) - 1)
    found = posted[known][at] == gram
    text, start, n = text[found], known[at[found]], np.diff(known, append=len(posted))[at[found]]
    step = max(1, CELLS // width)
    for low in range(0, len(ta), step):
        high = min(low + step, len(ta))
        i, end = np.searchsorted(text, [low, high])
        shared = np.zeros((high - low) * len(tb), np.int64)
        total = np.cumsum(n[i:end])
        for k in _slices(total):
            s = slice(i + k.start, i + k.stop)
            shared += np.bincount(np.repeat(text[s] - low, n[s]) * len(tb) + held[_ranges(start[s], n[s])], minlength=len(shared))
        score = shared.reshape(-1, len(tb)) / np.minimum.outer(size_a[low:high], size_b)
        r, c = np.nonzero((score > 0) & (score >= least))
        yield r + low, c, score[r, c]


def _standings(a: _Side, b: _Side, least: float, near: float, width: int) -> Iterator[list[pa.Array]]:
    """(row, score, n, first, n_agree, last_agree) of one block, as standings() has them, some at a time; equal texts of a kind are compared once."""
    of_a, of_b = a.of, b.of
    rank = np.empty(len(of_b), np.int64)
    order = pc.sort_indices(b.keys).to_numpy()
    rank[order] = np.arange(len(order))
    ordered = b.keys.take(pa.array(order))
    mb, fb, nb = _members(of_b, len(b.texts))
    lowest = np.minimum.reduceat(rank[mb], fb)
    # A null kind has the number 0 and agrees with none: it is left out of what objectives have.
    ua, number = np.unique(of_a * width + a.kinds, return_inverse=True)
    ma, fa, na = _members(number, len(ua))
    own = np.bincount(ua // width, minlength=len(a.texts))
    begin = np.cumsum(own) - own
    at = np.flatnonzero(b.kinds > 0)
    at = at[np.lexsort((rank[at], of_b[at] * width + b.kinds[at]))]
    ub, start, many = np.unique(of_b[at] * width + b.kinds[at], return_index=True, return_counts=True)
    highest = rank[at[start + many - 1]]
    for r, c, score in _pairs(list(a.texts), list(b.texts), least, len(b.texts)):
        if not len(r):
            continue
        kept = _near(r, score, near)
        r, c, score = r[kept], c[kept], score[kept]
        q, c, score = _ranges(begin[r], own[r]), np.repeat(c, own[r]), np.repeat(score, own[r])
        o = np.lexsort((score, q))
        q, c, score = q[o], c[o], score[o]
        key = c * width + ua[q] % width
        place = np.minimum(np.searchsorted(ub, key), max(len(ub) - 1, 0))
        agree = ub[place] == key if len(ub) else np.zeros(len(key), bool)
        top = np.full(len(key), -1)
        count = np.zeros(len(key), np.int64)
        top[agree], count[agree] = highest[place[agree]], many[place[agree]]
        first = np.flatnonzero((np.diff(q, prepend=-1) != 0) | (np.diff(score, prepend=-1) != 0))
        n, low, count, top = np.add.reduceat(nb[c], first), np.minimum.reduceat(lowest[c], first), np.add.reduceat(count, first), np.maximum.reduceat(top, first)
        q, score = q[first], score[first]
        for k in _slices(np.cumsum(na[q]), PAIRS):
            x = np.repeat(np.arange(len(q))[k], na[q[k]])
            yield [a.keys.take(pa.array(ma[_ranges(fa[q[k]], na[q[k]])])), pa.array(score[x]), pa.array(n[x]), ordered.take(pa.array(low[x])), pa.array(count[x]), ordered.take(pa.array(top[x], mask=top[x] < 0))]


def _slices(total: np.ndarray, most: int = POSTINGS) -> Iterator[slice]:
    """Divides places whose weights have the running total ``total``: at most ``most`` in a slice, or one place."""
    i = 0
    while i < len(total):
        j = max(i + 1, int(np.searchsorted(total, most + (total[i - 1] if i else 0), "right")))
        yield slice(i, j)
        i = j


class _Side:
    """Rows or objectives of a block: the distinct texts, and of each place the number of its text, its key and, if asked for, the number of its kind."""

    def __init__(self, key: str) -> None:
        self.key, self.texts = key, {}
        self._of: list[np.ndarray] = []
        self._keys: list[pa.Array] = []
        self._kinds: list[np.ndarray] = []

    def add(self, b: pa.RecordBatch, kinds: dict[str | None, int]) -> None:
        self._of.append(_numbered(b.column("t").to_pylist(), self.texts))
        self._keys.append(b.column(self.key).take(pa.array(np.arange(b.num_rows))))  # a copy; a slice would hold the texts of the batch
        if "kind" in b.schema.names:
            self._kinds.append(_numbered(b.column("kind").to_pylist(), kinds))

    of = property(lambda self: np.concatenate(self._of))
    keys = property(lambda self: pa.concat_arrays(self._keys))
    kinds = property(lambda self: np.concatenate(self._kinds))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Side, _Side, dict[str | None, int]]]:
    """Rows, objectives and kinds of each block (g, i, j) that has both; its rows follow one another, and of a text that repeats one copy is held."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        g, is_row = b.column("g").dictionary_encode().indices.to_numpy(), b.column("is_row").to_numpy(zero_copy_only=False)
        i, j = b.column("i").to_numpy(), b.column("j").to_numpy()
        starts = [0, *(np.flatnonzero((np.diff(g) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0) | (is_row[1:] != is_row[:-1])) + 1).tolist()]
        for low, high in zip(starts, [*starts[1:], b.num_rows]):
            key = (b.column("g")[low].as_py(), i[low], j[low])
            if key != last:
                if last is not None and rows.texts and objectives.texts:
                    yield rows, objectives, kinds
                rows, objectives, kinds, last = _Side("row"), _Side("objective"), {None: 0}, key
            (rows if is_row[low] else objectives).add(b.slice(low, high - low), kinds)
    if last is not None and rows.texts and objectives.texts:
        yield rows, objectives, kinds


def _blocked(rows: DataFrame, objectives: DataFrame, row_key: str, objective_key: str, group: str, statement: str, sample: int | None, kind: str | None = None) -> DataFrame:
    """(g, i, j, is_row, row, objective, t), and kind if asked for: texts of both sides in blocks (g, i, j), whose rows follow one another in one task.

    A group is divided by its statements, not by its rows: those that are equal stay together, so a group that repeats few statements is no larger for it.
    """
    said = F.col(statement) if sample is None else F.substring(F.col(statement), 1, sample)
    g = F.col(group).cast("string").alias("g")
    r, o = (d.where(F.col(group).isNotNull()) for d in (rows, objectives))
    kinds = [] if kind is None else [F.col(kind).cast("string").alias("kind")]
    a = r.select(F.lit(True).alias("is_row"), g, F.col(row_key).alias("row"), F.lit(None).cast(o.schema[objective_key].dataType).alias("objective"), F.xxhash64(said).alias("h"), *kinds, T.compact(T.without_row_code(said)).alias("t"))
    b = o.select(F.lit(False).alias("is_row"), g, F.lit(None).cast(r.schema[row_key].dataType).alias("row"), F.col(objective_key).alias("objective"), F.xxhash64(statement).alias("h"), *kinds, T.compact(F.col(statement)).alias("t"))
    count = a.select("g", "is_row", "h").unionByName(b.select("g", "is_row", "h")).distinct().groupBy("g")
    parts = lambda side: F.greatest(F.ceil(F.count_if(side) / BLOCK).cast("int"), F.lit(1))
    large = count.agg(parts(F.col("is_row")).alias("na"), parts(~F.col("is_row")).alias("nb")).where("na > 1 OR nb > 1")
    own, other = (F.coalesce(F.when(F.col("is_row"), F.col(x)).otherwise(F.col(y)), F.lit(1)) for x, y in (("na", "nb"), ("nb", "na")))
    x = a.unionByName(b).where(F.length("t") >= LEAST).join(F.broadcast(large), "g", "left")
    x = x.select("*", F.pmod("h", own).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), other - 1)).alias("other"))
    i, j = (F.when(F.col("is_row"), F.col(m)).otherwise(F.col(n)) for m, n in (("own", "other"), ("other", "own")))
    x = x.select("g", i.alias("i"), j.alias("j"), "is_row", "row", "objective", *["kind"] * bool(kinds), "t")
    return x.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "is_row")


def scores(rows: DataFrame, objectives: DataFrame, row_key: str, objective_key: str, group: str, statement: str = "statement", least: float = 0.0, sample: int | None = None, near: float | None = None) -> DataFrame:
    """(row, objective, score): containment of 5-grams between rows and objectives of the same group, where it is above 0 and ``least`` or more.

    Texts under LEAST characters and null groups are in no pair. The texts of a group meet in one task, which makes their grams and counts
    those that pairs share, so neither grams nor candidates are shuffled; groups of more than BLOCK different statements of rows or objectives are divided into blocks. ``sample``: only so many characters
    of a row's text count, as for rows of tables whose text was kept so far; by default all. ``near``: of a row's pairs in a block, only those
    less than this below the best, and the two best, are returned; no other can be among the two best of the row or as near to its best, so decide() with this margin and first_match() give the same.
    """
    x = _blocked(rows, objectives, row_key, objective_key, group, statement, sample)
    out = f"row {x.schema['row'].dataType.simpleString()}, objective {x.schema['objective'].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, _ in _blocks(batches):
            row, objective = a.keys, b.keys
            for p, q, score in _places(a.texts, a.of, b.texts, b.of, least, near):
                yield pa.RecordBatch.from_arrays([row.take(pa.array(p)), objective.take(pa.array(q)), pa.array(score, pa.float64())], ["row", "objective", "score"])

    return x.mapInArrow(run, out)


def standings(rows: DataFrame, objectives: DataFrame, row_key: str, objective_key: str, group: str, kind: str, statement: str = "statement", least: float = CANDIDATE, near: float = MARGIN) -> DataFrame:
    """(row, score, n, first, n_agree, last_agree): the pairs of scores() with ``near``, those of a row and score in one: how many objectives have it, the first of them,
    how many are of the row's ``kind``, and the last of these. So what is returned grows with the rows, not with their copies among the objectives. A row in several blocks may have a score several times.
    """
    x = _blocked(rows, objectives, row_key, objective_key, group, statement, None, kind)
    key = x.schema["objective"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, kinds in _blocks(batches):
            for arrays in _standings(a, b, least, near, len(kinds)):
                yield pa.RecordBatch.from_arrays(arrays, ["row", "score", "n", "first", "n_agree", "last_agree"])

    return x.mapInArrow(run, f"row {x.schema['row'].dataType.simpleString()}, score double, n bigint, first {key}, n_agree bigint, last_agree {key}")


def decide_standings(standing: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """As decide(), from standings(); pairs agree where they are of one kind."""
    r = standing.withColumn("top", F.max("score").over(Window.partitionBy("row")))
    first, tied = F.col("score") == F.col("top"), F.col("top") - F.col("score") < margin
    g = r.groupBy("row").agg(
        F.max("top").alias("best"), F.when(F.sum(F.when(first, F.col("n"))) > 1, F.max("top")).otherwise(F.coalesce(F.max(F.when(~first, F.col("score"))), F.lit(0.0))).alias("runner_up"),
        F.min(F.when(first, F.col("first"))).alias("first"), F.coalesce(F.sum(F.when(tied, F.col("n_agree"))), F.lit(0)).alias("n"), F.max(F.when(tied, F.col("last_agree"))).alias("coded"),
    )
    return _outcomes(g, threshold, margin)


def _outcomes(g: DataFrame, threshold: float, margin: float) -> DataFrame:
    """(row, outcome, objective, score) from a row's best score, runner-up, first objective, and the number and last of those whose codes agree."""
    close = F.col("best") - F.col("runner_up") < margin
    outcome = F.when(F.col("best") < threshold, "rejected").when(close & (F.col("n") != 1), "ambiguous").otherwise("attached")
    return g.select("row", outcome.alias("outcome"), F.when(outcome != "ambiguous", F.when(close & (F.col("best") >= threshold), F.col("coded")).otherwise(F.col("first"))).alias("objective"), F.col("best").alias("score"))


def decide(scored: DataFrame, agrees: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """(row, outcome, objective, score): attached, rejected (best below the threshold) or ambiguous.

    Where the second comes within the margin of the best, the one candidate within the margin whose code agrees is taken,
    which need not be the best; none or several make the row ambiguous. agrees(row, objective) lists pairs whose codes
    agree. Equal scores keep the order of the objectives' keys.
    """
    w = Window.partitionBy("row").orderBy(F.desc("score"), "objective")
    r = scored.select("*", F.row_number().over(w).alias("rank"), F.max("score").over(Window.partitionBy("row")).alias("best"), F.lead("score", 1, 0.0).over(w).alias("next"))
    r = r.withColumn("runner_up", F.max(F.when(F.col("rank") == 1, F.col("next"))).over(Window.partitionBy("row")))
    a = agrees.select(F.col("row").alias("r2"), F.col("objective").alias("o2"), F.lit(True).alias("agree"))
    r = r.join(a, (F.col("row") == F.col("r2")) & (F.col("objective") == F.col("o2")), "left")
    tied = (F.col("best") - F.col("score") < margin) & F.coalesce("agree", F.lit(False))
    g = r.groupBy("row").agg(
        F.max("best").alias("best"), F.max("runner_up").alias("runner_up"), F.max(F.when(F.col("rank") == 1, F.col("objective"))).alias("first"),
        F.count_if(tied).alias("n"), F.max(F.when(tied, F.col("objective"))).alias("coded"),
    )
    return _outcomes(g, threshold, margin)


def first_match(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(row, objective, score): the best objective at or above the threshold, the first of equal ones."""
    w = Window.partitionBy("row").orderBy(F.desc("score"), "objective")
    return scored.where(F.col("score") >= threshold).withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")


def attach_lists(decided: DataFrame, rows: DataFrame, row_key: str, items: str) -> DataFrame:
    """(objective, n_rows, items): the distinct items of all rows attached to an objective, in order."""
    x = decided.where("outcome = 'attached'").join(rows.select(F.col(row_key).alias("row"), F.col(items).alias("items")), "row")
    return x.groupBy("objective").agg(F.count("*").alias("n_rows"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("items", F.array().cast("array<string>")))))).alias("items"))
