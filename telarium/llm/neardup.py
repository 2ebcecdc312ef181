"""Near-duplicate records with small edits: all pairs of texts whose word sets are similar.

1. Exact copies are represented by one row.
2. Each word set takes keys such that two sets similar enough surely share one: the rarest words that
   they may miss none of, and, where a word is so common that its bucket would be large, that word with the next ones.
3. In each bucket, bit planes of set sketches are compared, which have the more bits the longer the sets are: for a block of
   sets at once, carry-save counters add up which of the sets' rarest bits others lack. A similar set lacks few words,
   so some more bits than that are enough for nearly all pairs; the others are compared by whole sketches. A sketch never lacks more
   bits of another than its set lacks words, so no pair is lost.
4. What is left is compared word by word.
"""

from __future__ import annotations

import math
import re
import unicodedata as U
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telarium.llm import copies as C
from telarium.llm.lookalike import LOOKALIKES, consistent
from telarium.session import settle

THRESHOLD = 0.70
#: Expected rows of a bucket up to which no further word joins the key.
BUCKET = 3072
#: A word is common beyond this share of the sets (or BUCKET sets); so at most mean set size / COMMON words reach the driver.
COMMON = 1 / 65_536
#: Words in more than this share of the sets aren't in the sketch.
EVERYWHERE = 1 / 8
#: Words of one key at most.
DEPTH = 8
#: Sets of so many words or more also make keys of one word, and of those with more than LONG / similarity words only such.
LONG = 64
#: Buckets beyond this size are compared in blocks by further tasks.
SPLIT = 65_536
BLOCK = 16_384
#: Buckets up to this size are compared row by row.
SMALL = 24
#: Signs of texts that are taken at once.
SIGNS = 1 << 20
#: Bits of a sketch that are looked at first, for each that may be missing; bits of sketches that are made ready for that at once.
LOOKS = 3
AHEAD = 1 << 18

#: Bits of a sketch for sets of so many words or fewer; so its bits don't fill up, and unrelated sets stay apart.
WIDTHS = [(40, 64), (160, 256), (640, 1024), (1 << 62, 4096)]

_WORD = re.compile(r"[^\W_]+")
_ACCENTED = [(c, U.normalize("NFD", c)[0]) for c in "áéíóúñü"]
_APART = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))


def words(text: str) -> str:
    """Distinct words of a text in order, joined by spaces: runs of letters and digits, lower case, without accents, in the consistent form."""
    s = consistent(text).lower()
    for c, plain in _ACCENTED:
        s = s.replace(c, plain)
    if not s.isascii():
        s = "".join(c for c in U.normalize("NFD", s) if U.category(c) != "Mn")
        if not s.isascii():
            return " ".join(sorted(set(_WORD.findall(s))))
    return b" ".join(sorted(set(s.encode().translate(_APART).split()))).decode()


def _map(df: DataFrame, schema: str, arrow: pa.Schema, rows) -> DataFrame:
    """mapInArrow with rows(columns as lists) -> list of result columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = rows(*(c.to_pylist() for c in b.columns))
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(got, arrow.types)], schema=arrow)

    return df.mapInArrow(run, schema)


_ALIKE = re.compile(r"[\W_]+")


def _canonical(text: str) -> str:
    return _ALIKE.sub("", (text if text.isascii() else U.normalize("NFC", text)).lower())


@lru_cache(1 << 16)
def _part(text: str) -> list[str]:
    return words(text).split()


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: the letter or digit of _canonical(), or 0; the one of words(), or a space; whether it takes more than a look at itself, as do all from the last one on. Line ends stay."""
    odd = np.ones(0x2301, bool)
    canon, word = np.zeros(len(odd), np.uint16), np.full(len(odd), 32, np.uint16)
    for cp in (*range(0x530), *range(0x1E00, 0x2300)):
        c = chr(cp)
        low = c.lower()
        bare = "".join(x for x in U.normalize("NFD", low) if U.category(x) != "Mn")
        if len(low) == len(bare) == 1 and c not in LOOKALIKES and consistent(c) == c and not U.combining(c) and U.is_normalized("NFC", c) and c not in "\u03a3\u034f":
            odd[cp] = False
            canon[cp], word[cp] = ord(low) if low.isalnum() else 0, ord(bare) if bare.isalnum() else 32
    canon[10] = word[10] = 10
    return canon, word, odd


def _pieces(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Slices of about most in size, so that arrays over all signs or words of a batch stay small."""
    cut = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1).tolist(), len(sizes)]
    return [(a, b) for a, b in zip(cut, cut[1:]) if b > a]


def _forms(texts: list[str]) -> tuple[list[bytes], list[str]]:
    """_canonical(), encoded, and the words of each text, distinct ones as they come. Many texts at once by code point, but those with odd signs."""
    out: tuple[list[bytes], list[str]] = [], []
    for a, b in _pieces(np.fromiter(map(len, texts), np.int64, len(texts)), SIGNS):
        for whole, some in zip(out, _some_forms(texts[a:b])):
            whole += some
    return out


def _some_forms(texts: list[str]) -> tuple[list[bytes], list[str]]:
    canon, word, odd = _tables()
    joined = "\n".join(texts) + "\n"
    if joined.count("\n") > len(texts):
        joined = "\n".join(t.replace("\n", " ") for t in texts) + "\n"
    cps = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), len(odd) - 1)
    c = canon[cps]
    out = c[c > 0].tobytes().decode("utf-16-le").encode().split(b"\n")[:-1]
    sets = [" ".join(dict.fromkeys(x.split())) for x in word[cps].tobytes().decode("utf-16-le").split("\n")[:-1]]
    for i in np.unique(np.searchsorted(np.flatnonzero(cps == 10), np.flatnonzero(odd[cps]))).tolist():
        out[i], sets[i] = _canonical(texts[i]).encode("utf-8", "replace"), " ".join(dict.fromkeys(w for part in texts[i].split(" ") for w in _part(part)))
    return out, sets


def word_sets(df: DataFrame) -> DataFrame:
    """(id, h1, h2, h3, n, words) of texts (id, text) with letters: two hashes, a third and the length of the letters and digits, and the words."""
    arrow = pa.schema([("id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("h3", pa.int64()), ("n", pa.int32()), ("words", pa.string())])

    def rows(ids: list[int], texts: list[str]) -> list:
        c, sets = _forms(texts)
        h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, c)), np.int64).reshape(len(c), 2)
        return [ids, pa.array(h[:, 0]), pa.array(h[:, 1]), list(map(zlib.crc32, c)), list(map(len, c)), sets]

    return _map(df.where(F.col("text").rlike(r"\p{L}")), "id long, h1 long, h2 long, h3 long, n int, words string", arrow, rows)


def _texts(df: DataFrame) -> DataFrame:
    """The rows of word_sets with the letters and digits themselves, c, in place of the words."""
    arrow = pa.schema([("id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("c", pa.string())])

    def rows(ids: list[int], texts: list[str]) -> list:
        c = list(map(_canonical, texts))
        h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.encode("utf-8", "replace")) for x in c), np.int64).reshape(len(c), 2)
        return [ids, pa.array(h[:, 0]), pa.array(h[:, 1]), c]

    return _map(df.where(F.col("text").rlike(r"\p{L}")), "id long, h1 long, h2 long, c string", arrow, rows)


def common_words(sets: DataFrame, at_least: int) -> dict[int, int]:
    """hash -> number of sets, of the words in more than at_least sets. Counted over all sets, combined within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["w", "n"])
        for b in batches:
            for ws in b.column(0).to_pylist():
                n.update(ws.split())
            if len(n) > 1 << 18:
                yield flush()
                n.clear()
        yield flush()

    got = sets.select("words").mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") > at_least).toPandas()
    return {xxhash.xxh3_64_intdigest(w): int(n) for w, n in zip(got.w, got.n)}


_MASK = (1 << 64) - 1


def set_keys(ws: list[tuple[int, int]], n_sets: int, t: float, bucket: int) -> list[int]:
    """Keys of one set; ws: (0 or number of sets, hash) of its words, ascending, so rare words come first.

    Of two sets with similarity t or more, each has at most n - ceil(t n) words that the other lacks. So their first,
    second, ... common words stand so early that both sets make the key of them; sets whose common words
    may be used up before the key is long enough also make the key that says so. Long sets would make too many keys of several
    words; sets of LONG words or more make keys of one word (told apart by a mark), and keys of several only up to the size
    that a similar set below LONG can have.
    """
    n = len(ws)
    out: list[int] = []
    if n >= LONG:
        out = [(h * 0x9E3779B97F4A7C15 ^ 0x5851F42D4C957F2D) & _MASK for _, h in ws[:n - math.ceil(t * n - 1e-9) + 1]]
        if n * t > LONG:
            return out
    stack = [(0, 0, n - math.ceil(t * n - 1e-9), float(n_sets), 0)]
    while stack:
        key, at, miss, rows, depth = stack.pop()
        if depth and n - at <= miss:
            out.append((key * 0x9E3779B97F4A7C15 + 1) & _MASK)
        for p in range(at, min(n, at + miss + 1)):
            df, h = ws[p]
            k = ((key ^ h) * 0xFF51AFD7ED558CCD + 0x2545F4914F6CDD1D) & _MASK
            k ^= k >> 32
            r = rows * df / n_sets if df else 0.0
            if r <= bucket or depth + 1 >= DEPTH:
                out.append(k)
            else:
                stack.append((k, p + 1, miss - (p - at), r, depth + 1))
    return out


def keyed(sets: DataFrame, common: dict[int, int], n_sets: int, t: float, bucket: int) -> DataFrame:
    """(k, id, s, n): key, set, sketch and number of words, for all keys of all sets."""
    shared = sets.sparkSession.sparkContext.broadcast(common)
    arrow = pa.schema([("k", pa.int64()), ("id", pa.int64()), ("s", pa.binary()), ("n", pa.int32())])
    often = n_sets * EVERYWHERE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _pieces(pc.binary_length(batch.column(1)).to_numpy(), SIGNS):
                n, df, h = sorted_words(batch.column(1).slice(a, b - a), shared.value)
                at, k = keys(n, df, h, n_sets, t, bucket)
                s, at = sketched(n, df, h, often), pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), batch.column(0).slice(a, b - a).take(at), s.take(at), pa.array(n.astype(np.int32)).take(at)], schema=arrow)

    return sets.select("id", "words").where("words <> ''").mapInArrow(run, "k long, id long, s binary, n int")


def sorted_words(sets: pa.Array, common: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each set; of all words, those of a set behind each other and ascending, 0 or their number of sets, and their hash)."""
    split = pc.split_pattern(sets, " ")
    n = pc.list_value_length(split).to_numpy().astype(np.int64)
    all_ = split.flatten().dictionary_encode()
    h = np.array(list(map(xxhash.xxh3_64_intdigest, all_.dictionary.to_pylist())), np.uint64)
    df = np.array([common.get(x, 0) for x in h.tolist()], np.int64)
    order = np.lexsort((h, df))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    mine = order[np.sort(np.repeat(np.arange(len(n)) << 32, n) | rank[all_.indices.to_numpy()]) & 0xFFFFFFFF]
    return n, df[mine], h[mine]


def sketched(n: np.ndarray, df: np.ndarray, h: np.ndarray, often: float) -> pa.Array:
    """Sketches of sets as sorted_words() has them: a bit for each value of the first bits of the words' hashes."""
    wide = np.array([w for _, w in WIDTHS])[np.searchsorted([most for most, _ in WIDTHS], n)]
    end = np.cumsum(wide)
    bits = np.zeros(end[-1], bool)
    some = df <= often
    bits[(np.repeat(end - wide, n) + (h >> np.repeat(64 - np.log2(wide).astype(np.int64), n).astype(np.uint64)).astype(np.int64))[some]] = True
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.concatenate([[0], end // 8]).astype(np.int32)), pa.py_buffer(np.packbits(bits, bitorder="little"))])


def keys(n: np.ndarray, df: np.ndarray, h: np.ndarray, n_sets: int, t: float, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the set, key) for set_keys() of all sets; those that make keys of one rare word only, nearly all, at once."""
    start = np.cumsum(n) - n
    most = n - np.ceil(t * n - 1e-9).astype(np.int64)
    plain = (n < LONG) & (df[start + most] == 0)
    first = np.arange(len(h)) - np.repeat(start, n) <= np.repeat(np.where(plain, most, -1), n)
    k = h[first] * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(0x2545F4914F6CDD1D)
    at, out = [np.repeat(np.arange(len(n)), np.where(plain, most + 1, 0))], [k ^ k >> np.uint64(32)]
    for i in np.flatnonzero(~plain).tolist():
        of = slice(start[i], start[i] + n[i])
        more = set_keys(list(zip(df[of].tolist(), h[of].tolist())), n_sets, t, bucket)
        at.append(np.full(len(more), i))
        out.append(np.array(more, np.uint64))
    return np.concatenate(at), np.concatenate(out)


def radius(n: np.ndarray, m: np.ndarray, t: float) -> np.ndarray:
    """Words in which sets of n and m words with similarity t may differ at most."""
    return np.floor((1 - t) / (1 + t) * (n + m) + 1e-9).astype(np.int64)


def width(n: int) -> int:
    return next(w for most, w in WIDTHS if n <= most)


def sketches(s: pa.Array) -> np.ndarray:
    """Sketches as rows of 64-bit words, those of fewer bits with zeros behind."""
    s = pa.array(s, pa.binary()) if isinstance(s, list) else s
    at = np.frombuffer(s.buffers()[1], np.int32, len(s) + 1, 4 * s.offset)
    data = np.frombuffer(s.buffers()[2] or b"", np.uint8)[at[0]:at[-1]].view(np.uint64)
    words = np.diff(at) // 8
    most = int(words.max(initial=1))
    if (words == most).all():
        return data.reshape(len(s), most)
    out = np.zeros((len(s), most), np.uint64)
    out[np.repeat(np.arange(len(s)), words), np.arange(len(data)) - np.repeat(np.cumsum(words) - words, words)] = data
    return out


def _folded(s: np.ndarray, n: np.ndarray, bits: int) -> np.ndarray:
    """Sketches of sets of n words (all of one width) as they would be with so many bits: each bit stands for several."""
    wide = width(int(n[0])) if len(n) else bits
    s = s[:, :wide // 64]
    if wide == bits:
        return np.ascontiguousarray(s)
    one = np.unpackbits(np.ascontiguousarray(s).view(np.uint8), axis=1, bitorder="little").reshape(len(s), bits, wide // bits).any(2)
    return np.packbits(one, axis=1, bitorder="little").view(np.uint64)


def _runs(n: np.ndarray) -> list[tuple[int, int]]:
    """Slices of ascending n whose sketches have one width."""
    cut = [0, *np.searchsorted(n, [most for most, _ in WIDTHS[:-1]], "right").tolist(), len(n)]
    return [(a, b) for a, b in zip(cut, cut[1:]) if b > a]


def _planes(s: np.ndarray) -> np.ndarray:
    """Bit planes of sketches: row b holds bit b of all of them, 64 sketches a word."""
    n = -(-len(s) // 64) * 64
    padded = np.zeros((n, s.shape[1]), np.uint64)
    padded[:len(s)] = s
    bits = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


class _Sums:
    """Carry-save sums over bit planes, a sum for each bit.

    Summands of weight 1 wait until three are there; a full adder turns them into one of weight 1 and one of weight 2, and so
    on upward. What is put is overwritten.
    """

    def __init__(self, shape: tuple[int, int], most: int) -> None:
        self.shape, self.wait = shape, [[] for _ in range(most.bit_length())]

    def put(self, x: np.ndarray) -> None:
        for level in self.wait:
            level.append(x)
            if len(level) < 3:
                return
            x, b, c = level
            ab = x ^ b
            x &= b
            x |= np.bitwise_and(ab, c, out=b)
            level[:] = [np.bitwise_xor(ab, c, out=ab)]

    def settled(self, r: int) -> np.ndarray:
        """Bits where the sum so far is r or less."""
        carry: list[np.ndarray] = []
        digits = []
        for level in self.wait:
            xs = carry + level
            carry = []
            while len(xs) > 1:
                if len(xs) >= 3:
                    a, b, c = xs.pop(), xs.pop(), xs.pop()
                    ab = a ^ b
                    xs.append(ab ^ c)
                    carry.append((a & b) | (ab & c))
                else:
                    a, b = xs.pop(), xs.pop()
                    xs.append(a ^ b)
                    carry.append(a & b)
            digits.append(xs[0] if xs else None)
        less, equal = np.zeros(self.shape, np.uint64), np.full(self.shape, _MASK, np.uint64)
        for level in reversed(range(len(digits))):
            d = digits[level]
            if r >> level & 1:
                if d is None:
                    less |= equal
                    equal = np.zeros(self.shape, np.uint64)
                else:
                    less |= equal & ~d
                    equal &= d
            elif d is not None:
                equal &= ~d
        return less | equal


def _bits(s: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(s).view(np.uint8), axis=1, bitorder="little").astype(bool)


def _within(planes: np.ndarray, queries: np.ndarray, r: int) -> np.ndarray:
    """For each query, a bit for each sketch at distance r or less, or perhaps more if the block was given up early: none.

    After half and three quarters of the planes a lower bound of all distances is compared with the radius; the block is
    abandoned when all exceed it.
    """
    q, (bits, w) = len(queries), planes.shape
    flip = np.where(_bits(queries), np.uint64(_MASK), np.uint64(0))
    if r >= bits:
        return np.full((q, w), _MASK, np.uint64)
    sums = _Sums((q, w), bits)
    for b in range(bits):
        sums.put(planes[b][None, :] ^ flip[:, b][:, None])
        if b + 1 in (bits // 2, bits * 3 // 4) and not sums.settled(r).any():
            return np.zeros((q, w), np.uint64)
    return sums.settled(r)


def _lacking(planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the planes, those with fewest bits first; in that order a bit for each sketch that lacks the plane's, and a row of none)."""
    order = np.argsort(np.bitwise_count(planes).sum(1, dtype=np.int64), kind="stable")
    return order, np.concatenate([~planes[order], np.zeros((1, planes.shape[1]), np.uint64)])


def _first(s: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Ranks in order of the first bits, at most so many, of each sketch: a row for the first ones, one for the second ones, and so on; the number of planes where there are no more."""
    ones = np.take(_bits(s), order, axis=1)
    many = np.count_nonzero(ones, axis=1)
    out = np.full((min(most, int(many.max(initial=0))), len(s)), len(order))
    if len(order) == 64:
        left = np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]
        for row in out:
            row[:] = np.bitwise_count((left & -left) - np.uint64(1))  # all 64 bits once none is left
            left &= left - np.uint64(1)
        return out
    row, bit = np.nonzero(ones)
    place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    some = place < len(out)
    out[place[some], row[some]] = bit[some]
    return out


def _covered(lacking: np.ndarray, first: np.ndarray, r: int) -> np.ndarray:
    """For each query, a bit for each sketch that lacks r or fewer of the query's first bits."""
    shape = first.shape[1], lacking.shape[1]
    if r >= len(first):
        return np.full(shape, _MASK, np.uint64)
    sums = _Sums(shape, len(first))
    for x in first:
        sums.put(lacking[x])
    return sums.settled(r)


def compare(ids: np.ndarray, s: np.ndarray, n: np.ndarray, t: float, other: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one bucket (or between it and another) that may be similar, as (smaller id, larger id). s: rows of sketches."""
    order = np.argsort(n, kind="stable")
    ids, s, n = ids[order], s[order], n[order]
    if other is None:
        oi, os_, on = ids, s, n
    else:
        o = np.argsort(other[2], kind="stable")
        oi, os_, on = other[0][o], other[1][o], other[2][o]
    A, B = [], []
    for p, q in _runs(n):
        for u, v in _runs(on):
            if v <= p and other is None or on[u] * t > n[q - 1] + 1e-9 or n[p] * t > on[v - 1] + 1e-9:
                continue
            bits = min(width(int(n[p])), width(int(on[u])))
            mine, theirs = _folded(s[p:q], n[p:q], bits), _folded(os_[u:v], on[u:v], bits)
            step = max(8, min(256, 200_000 // max(1, len(on) // 64 + 1) // 8))
            for c in range(u, v, 8192):
                planes = _planes(theirs[c - u:c - u + 8192])
                order, lacking = _lacking(planes)
                for d in range(p, q, AHEAD // bits):
                    some = slice(d - p, min(d + AHEAD // bits, q) - p)
                    first = _first(mine[some], order, LOOKS * missing(n[p + some.stop - 1], 0, t, other is None) + 4)
                    for a in range(d, p + some.stop, step):
                        b = min(a + step, p + some.stop)
                        lo = max(c, int(np.searchsorted(on, math.ceil(n[a] * t - 1e-9))))
                        if other is None:
                            lo = max(lo, a)
                        lo -= (lo - c) % 64
                        hi = min(v, c + 8192, int(np.searchsorted(on, math.floor(n[b - 1] / t + 1e-9), "right")))
                        r = missing(n[b - 1], on[min(lo, hi)] if hi > lo else 0, t, other is None)
                        if lo >= hi or r < 0:
                            continue
                        at = slice((lo - c) // 64, -(-(hi - c) // 64))
                        hit = _covered(lacking[:, at], first[:LOOKS * r + 4, a - d:b - d], r)
                        if np.bitwise_count(hit).sum(dtype=np.int64) > hit.size * 8:
                            hit &= _within(planes[:, at], mine[a - p:b - p], int(radius(n[b - 1], on[hi - 1], t)))
                        x, y = _hits(hit, mine[a - p:b - p], theirs[lo - u:hi - u], n[a:b], on[lo:hi], t)
                        if other is None:
                            ok = y + lo > x + a
                            x, y = x[ok], y[ok]
                        A.append(ids[x + a])
                        B.append(oi[y + lo])
    return _pairs(A, B)


def missing(n: int, m: int, t: float, ascending: bool) -> int:
    """Words that a set of m words or more lacks at most of one of n words or fewer that is similar to it. ascending: it isn't the smaller one."""
    return math.floor(n - t / (1 + t) * (n + max(m, n if ascending else n * t)) + 1e-9)


def _hits(hit: np.ndarray, mine: np.ndarray, theirs: np.ndarray, n: np.ndarray, m: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of both, of those in hit, neither of which has more bits that the other lacks than similar sets of their sizes have words; so they are within the radius, too."""
    at = np.flatnonzero(hit != 0)
    if not len(at):
        return at, at
    one = np.flatnonzero(np.unpackbits(hit.ravel()[at].view(np.uint8), bitorder="little").view(bool))
    at = at[one >> 6]
    x, y = at // hit.shape[1], (at % hit.shape[1] << 6) + (one & 63)
    ok = y < len(m)
    x, y = x[ok], y[ok]
    ok, both = np.ones(len(x), bool), np.ceil(t / (1 + t) * (n[x] + m[y]) - 1e-9)
    for one, other, size in ((mine[x], theirs[y], n[x]), (theirs[y], mine[x], m[y])):
        far = np.bitwise_count(one & ~other)
        ok &= (far[:, 0] if far.shape[1] == 1 else far.sum(1, dtype=np.int64)) <= size - both
    return x[ok], y[ok]


def _pairs(A: list, B: list) -> tuple[np.ndarray, np.ndarray]:
    if not A:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(A), np.concatenate(B)
    ok = a != b
    return np.minimum(a, b)[ok], np.maximum(a, b)[ok]


def _small(k: np.ndarray, ids: np.ndarray, s: np.ndarray, n: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within many small buckets at once: each row with the d-th after it, while some bucket reaches so far."""
    A, B = [], []
    wide = np.array([w for _, w in WIDTHS])[np.searchsorted([most for most, _ in WIDTHS], n)] if s.shape[1] > 1 else None
    for d in range(1, SMALL):
        x = np.flatnonzero(k[d:] == k[:-d])
        if not len(x):
            break
        y = x + d
        ok = np.minimum(n[x], n[y]) >= t * np.maximum(n[x], n[y]) - 1e-9
        x, y = x[ok], y[ok]
        if wide is None:
            far = np.bitwise_count(s[x, 0] ^ s[y, 0])
        else:
            far = np.zeros(len(x), np.int64)
            for p, q in {(int(a), int(b)) for a, b in zip(wide[x], wide[y])}:
                at = np.flatnonzero((wide[x] == p) & (wide[y] == q))
                one, two = (_folded(s[z[at]], n[z[at]], min(p, q)) for z in (x, y))
                far[at] = np.bitwise_count(one ^ two).sum(1, dtype=np.int64)
        ok = far <= radius(n[x], n[y], t)
        A.append(ids[x[ok]])
        B.append(ids[y[ok]])
    return _pairs(A, B)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("rows", pa.int64())])


def _emit(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        u = np.unique(np.stack([a, b], 1), axis=0)
        for at in range(0, len(u), 100_000):
            x = u[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.nulls(len(x), pa.int64())], schema=_PAIR)


def candidates(keys: DataFrame, t: float, split: int = SPLIT, block: int = BLOCK, hold: int = 200_000) -> DataFrame:
    """(a, b): pairs of sets that share a key and whose sketches are within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (numbers: k, id, n; sketches)
        more = 0  # rows of the first held bucket that were counted and let go

        def counted(k: int, n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([int(k)]), pa.nulls(1, pa.int64()), pa.array([int(n)])], schema=_PAIR)

        def together() -> tuple[np.ndarray, np.ndarray]:
            most = max(s.shape[1] for _, s in held)
            return np.concatenate([x for x, _ in held], axis=1), np.concatenate([s if s.shape[1] == most else np.pad(s, ((0, 0), (0, most - s.shape[1]))) for _, s in held])

        def do(rows: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
            """rows: whole buckets, sorted by key."""
            k, ids, n = rows
            if not len(k):
                return
            cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
            size = np.diff(cut)
            low = np.repeat((size > 1) & (size <= SMALL), size)
            A, B = [], []
            a, b = _small(k[low], ids[low], s[low], n[low], t)
            A.append(a)
            B.append(b)
            for j in np.flatnonzero(size > SMALL):
                x = slice(cut[j], cut[j + 1])
                if size[j] > split:
                    yield counted(k[cut[j]], size[j])
                    continue
                a, b = compare(ids[x], s[x], n[x], t)
                A.append(a)
                B.append(b)
            yield from _emit(np.concatenate(A), np.concatenate(B))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 3)]), sketches(batch.column(2))))
            if sum(s.shape[0] * (s.shape[1] + 3) // 4 for _, s in held) >= hold:
                rows, s = together()
                end = int(np.searchsorted(rows[0], rows[0, -1]))
                if end:
                    if more:
                        own = int(np.searchsorted(rows[0], rows[0, 0], "right"))
                        yield counted(rows[0, 0], more + own)
                        rows, s, more = rows[:, own:], s[own:], 0
                        end = int(np.searchsorted(rows[0], rows[0, -1]))
                    yield from do(rows[:, :end], s[:end])
                    held = [(rows[:, end:], s[end:])]
                elif rows.shape[1] > split:  # one bucket so far, too large to be compared here: its rows are only counted
                    more += rows.shape[1] - 1
                    held = [(rows[:, -1:], s[-1:])]
        if held:
            rows, s = together()
            if more:
                own = int(np.searchsorted(rows[0], rows[0, 0], "right"))
                yield counted(rows[0, 0], more + own)
                rows, s = rows[:, own:], s[own:]
            yield from do(rows, s)

    out = settle(keys.repartition("k").sortWithinPartitions("k").mapInArrow(run, "a long, b long, rows long"))
    pairs = out.where("rows IS NULL").select("a", "b")
    big = {int(r.a): int(r.rows) for r in out.where("rows IS NOT NULL").collect()}  # each stands for more than SPLIT rows
    if big:
        pairs = pairs.unionByName(_blocks(keys, big, t, block))
    return pairs.distinct()


def _blocks(keys: DataFrame, big: dict[int, int], t: float, block: int) -> DataFrame:
    """Pairs of the buckets in big, each divided into blocks; one task compares two blocks."""
    parts = {k: -(-n // block) for k, n in big.items()}
    shared = keys.sparkSession.sparkContext.broadcast(parts)
    arrow = pa.schema([("k", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("mine", pa.int32()), ("id", pa.int64()), ("s", pa.binary()), ("n", pa.int32())])

    def deal(k, ids, s, n) -> list:
        out = []
        for key, i, sk, m in zip(k, ids, s, n):
            p = shared.value[key]
            mine = xxhash.xxh3_64_intdigest(i.to_bytes(8, "little", signed=True)) % p
            out += [(key, min(mine, x), max(mine, x), mine, i, sk, m) for x in range(p)]
        return list(zip(*out)) or [[]] * 7

    def both(pdf):
        import pandas as pd

        i, j = int(pdf.i.iloc[0]), int(pdf.j.iloc[0])
        cols = lambda p: (p.id.to_numpy(), sketches(p.s.tolist()), p.n.to_numpy().astype(np.int64))
        if i == j:
            a, b = compare(*cols(pdf), t)
        else:
            a, b = compare(*cols(pdf[pdf.mine == i]), t, cols(pdf[pdf.mine == j]))
        return pd.DataFrame({"a": a, "b": b})

    rows = _map(keys.where(F.col("k").isin(list(parts))), "k long, i int, j int, mine int, id long, s binary, n int", arrow, deal)
    return rows.groupBy("k", "i", "j").applyInPandas(both, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """(a, b, shared, either): the pairs whose sets are similar, word by word."""
    x = pairs.join(sets.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a")
    x = x.join(sets.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b")
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int32()), ("either", pa.int32())])

    def rows(a, b, wa, wb) -> list:
        out = []
        for i, j, x, y in zip(a, b, wa, wb):
            x, y = set(x.split()), set(y.split())
            both = len(x & y)
            either = len(x) + len(y) - both
            if both >= t * either - 1e-9:
                out.append((i, j, both, either))
        return list(zip(*out)) or [[]] * 4

    return _map(x.select("a", "b", "wa", "wb"), "a long, b long, shared int, either int", arrow, rows)


def similar(df: DataFrame, id_col: str = "row_id", text_col: str = "statement", t: float = THRESHOLD, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(pairs between representatives: a, b, shared, either; membership of the other rows: keep_id, copy_id).

    Rows whose text is null or has no letter are in no pair. Rows equal in letters and digits are copies of the smallest id
    and have no pairs among themselves. Ids must be unique; a repeated id makes no pair with itself. Only the two named
    columns are read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    every = settle(word_sets(rows))
    dup = settle(C.grouped(every.drop("words"), _texts(rows))[1])
    sets = settle(every.select("id", "words").join(dup.select(F.col("copy_id").alias("id")), "id", "left_anti"))
    n = sets.count()
    limit = max(bucket, int(n * COMMON))
    common = common_words(sets, limit)
    pairs = candidates(keyed(sets, common, max(1, n), t, limit), t)
    return verified(pairs, sets, t), dup


def expand(pairs: DataFrame, dup: DataFrame) -> DataFrame:
    """(row_a, row_b), row_a < row_b: all pairs of rows that the pairs of representatives stand for."""
    p = pairs.select("a", "b")
    more = dup.select(F.col("keep_id").alias("k"), F.col("copy_id").alias("c"))
    p = p.unionByName(p.join(more, F.col("a") == F.col("k")).select(F.col("c").alias("a"), "b"))
    p = p.unionByName(p.join(more, F.col("b") == F.col("k")).select("a", F.col("c").alias("b")))
    return p.select(F.least("a", "b").alias("row_a"), F.greatest("a", "b").alias("row_b"))
