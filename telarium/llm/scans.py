"""Noise in text from scanned pages: divided words, misread characters, running headers and page numbers.

Skip-gram vectors are learned from the words of the corpus, as sums of vectors of their letter n-grams, so rare words have one
too. Each distinct word is linked once to the frequent words that plausible glyph edits lead to and whose vectors are near;
the context decides between several; then furniture is removed and the text is put together into paragraphs.
"""

from __future__ import annotations

import math
import mmap
import os
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What is read -> what may have been printed.
GLYPHS: list[tuple[str, str]] = [
    ("@", "a"), ("@", "o"), ("!", "i"), ("!", "l"), ("1", "i"), ("1", "l"), ("|", "i"), ("|", "l"), ("5", "s"), ("$", "s"), ("0", "o"),
    ("@", "á"), ("!", "í"), ("1", "í"), ("0", "ó"),
    ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("ii", "u"), ("u", "ii"), ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"),
    ("9", "g"), ("g", "9"), ("6", "b"), ("6", "ó"), ("\\/", "v"), ("li", "h"), ("h", "li"), ("ü", "ú"), ("ï", "í"), ("ö", "ó"), ("ä", "á"), ("ë", "é"),
    ("a´", "á"), ("e´", "é"), ("i´", "í"), ("o´", "ó"), ("u´", "ú"), ("´a", "á"), ("´e", "é"), ("´i", "í"), ("´o", "ó"), ("´u", "ú"),
    ("ﬁ", "fi"), ("ﬂ", "fl"), ("vv", "w"), ("iii", "m"), ("ri", "n"), ("nn", "m"), ("in", "m"), ("n", "u"), ("u", "n"), ("h", "b"), ("b", "h"),
    ("o", "c"), ("c", "o"), ("l", "i"), ("i", "l"), ("8", "b"), ("3", "e"), ("4", "a"), ("7", "t"), ("2", "z"), ("q", "g"), ("g", "q"), ("lc", "k"), ("lt", "k"),
    *((a, b) for a in "�?" for b in "áéíóúñü"),
]
# Edits between letters that other words differ by as well; they need a much more frequent neighbour.
_WEAK = {("n", "u"), ("u", "n"), ("h", "b"), ("b", "h"), ("o", "c"), ("c", "o"), ("l", "i"), ("i", "l"), ("t", "f"), ("d", "cl"), ("u", "ii"), ("h", "li"), ("ri", "n"), ("in", "m"), ("nn", "m"), ("q", "g"), ("g", "q"), ("g", "9")}

#: A linked neighbour is this much more frequent; with a weak edit, this much.
RATIO, WEAK_RATIO = 8, 40
#: Words of the vocabulary are seen this often. Those that make this share of all words are kept in memory, so 1 / SHARE at most; the others lie in files.
MIN_COUNT, SHARE = 4, 1 / (1 << 20)
#: Longer tokens are no words.
LONGEST = 64
#: Vectors: words that have one of their own, buckets of context words on each side and of letter n-grams, dimensions, window, rounds, negative samples.
WORDS, CONTEXTS, GRAMS, DIM, WINDOW, ROUNDS, NEGATIVE = 2048, 1024, 8192, 24, 2, 100, 5
#: Least cosine of a word's vector and that of a neighbour it is linked to, where both have one.
NEAR = 0.3
#: Bits of the filter in front of a file of words, for each word.
FILTER_BITS = 16
#: A line is furniture if it stands on this share of its file's pages, and on so many.
REPEATED, PAGES = 0.4, 2

_ODD = re.compile(r"[0-9@!|$´�?ﬁﬂ\\/]")
_TOKEN = re.compile(r"(?:[^\s.,;:()\[\]«»¿?“”\"…]|(?<=[^\W\d_])\?(?=[^\W\d_]))+")
_BREAK = re.compile(r"([^\W\d_][^\s]*?)([-\xad¬])[ \t]*$")
_INNER = re.compile(r"([^\W\d_][^\s\-\xad¬]*)( ?)(-|\xad|¬)\s+([^\W\d_][^\s.,;:()«»¿?]*)")
_LIGATURE = re.compile(r"([^\W\d_][ﬁﬂ]) +(?=[a-záéíóúñü])")
_LOOSE = re.compile(r"([^\W\d_][^\s]*?) +(-)[ \t]*$")
_NUMBER = re.compile(r"^\W*(?:p[áa]g(?:ina)?s?\.?)?\W*(\d+)(?:\s+(?:de|/)\s+\d+)?\W*$")
_FOLD = str.maketrans({"á": "a", "é": "c", "í": "i", "ó": "o", "ú": "u", "ü": "u", "ñ": "n", "0": "o", "1": "i", "!": "i", "|": "i", "l": "i", "5": "s", "@": "o", "$": "s", "9": "g", "e": "c", "6": "b", "f": "t"})
_DIGIT = re.compile(r"\d")
_ALONE = re.compile(r"(?<![^\W\d_])\d+(?![^\W\d_])")
_OTHER = re.compile(r"[^\w#|:;.,()\[\]–-]+")
_SEEN = re.compile(r"[^\W_]|�")
_PAGE = re.compile(r"[Pp]ag[1!|l]na|[Pp][áa´]+g[i1!|l]n[a@]|[Pp]�gina|[Pp]ágin@")


def skeleton(line: str) -> str:
    """What is left of a line when case, accents, numbers and glyphs that are taken for one another don't count."""
    s = line.strip().lower()
    if _DIGIT.search(s):
        s = _ALONE.sub("#", s)
    for a, b in (("rn", "m"), ("cl", "d"), ("ii", "u"), ("li", "h"), ("\\/", "v"), ("´", ""), ("�", "")):
        s = s.replace(a, b)
    return " ".join(_OTHER.sub(" ", s.translate(_FOLD).replace("a", "o")).split())


def number_of(line: str) -> int | None:
    """The number of a line that is a page number at most."""
    if not _DIGIT.search(line) or not (first := _SEEN.search(line)):
        return None
    core = line[first.start():len(line) - _SEEN.search(line[::-1]).start()]
    m = _NUMBER.match(_PAGE.sub("página", core).lower().replace("ﬁ", "fi")) if len(core) < 40 else None
    return int(m[1]) if m and len(m[1]) < 10 else None


def lines_of(text: str) -> list[str]:
    return [_ligatures(x.strip("\r \t")) for x in text.split("\n")]


def _ligatures(x: str) -> str:
    return _LIGATURE.sub(r"\1", x) if "ﬁ" in x or "ﬂ" in x else x


def _tokens(text: str) -> list[str]:
    return [t for t in _TOKEN.findall(text.lower()) if t[0].isalpha() or any(c.isalpha() for c in t)]


def edits(word: str, depth: int = 2) -> dict[str, bool]:
    """Words one glyph edit away, and for longer words two; True if a weak edit was needed."""
    out: dict[str, bool] = {}

    def step(w: str, weak: bool, left: int) -> None:
        for a, b in GLYPHS:
            at = w.find(a)
            while at >= 0:
                v = w[:at] + b + w[at + len(a):]
                k = weak or (a, b) in _WEAK
                if v != word and out.get(v, True) is True:
                    seen = v in out
                    out[v] = k if not seen else out[v] and k
                    if left > 1 and not seen:
                        step(v, k, left - 1)
                at = w.find(a, at + 1)

    if len(word) > LONGEST:
        return out
    odd = len(_ODD.findall(word))
    step(word, False, depth if odd > 1 else 1)
    if odd and depth > 1:
        for v in [v for v in list(out) if not _ODD.search(v)]:
            step(v, out[v], 1)
    return out


class Store(dict):
    """Words with a text each: the frequent ones in memory, the others in files in the folder all executors share, which workers map.

    The files hold the words in the order of their bytes, of each the places where it and its text end, and a filter
    that most words without a text don't pass.
    """

    def __init__(self, head: dict[str, str], path: str | None, parts: list[tuple[str, bytes]]) -> None:
        super().__init__(head)
        self.path, self.parts = path, parts

    def get(self, w: str, default=None):
        v = super().get(w)
        if v is None and self.parts:
            v = _rare(self.path, self.parts, w.encode("utf-8", "replace"))
        return default if v is None else v

    def __contains__(self, w) -> bool:
        return self.get(w) is not None


class Counts(Store):
    """A store whose texts are counts."""

    def get(self, w: str, default=None):
        v = super().get(w)
        return default if v is None else int(v)


class Strips:
    """Skeletons of strips, and the length of the longest."""

    def __init__(self, strips: dict[str, int], longest: int) -> None:
        self.strips, self.longest = strips, longest

    def __len__(self) -> int:
        return self.longest

    def __contains__(self, x: str) -> bool:
        return x in self.strips


@lru_cache(256)
def _mapped(path: str, part: str) -> tuple[mmap.mmap, memoryview, mmap.mmap]:
    if "://" in path:
        from pyspark import SparkFiles

        path = SparkFiles.get(path.rpartition("/")[2])
    files = []
    for kind in ("words", "index", "filter"):
        with open(f"{path}/{part}.{kind}", "rb") as f:
            files.append(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    return files[0], memoryview(files[1]).cast("q"), files[2]


def _rare(path: str, parts: list[tuple[str, bytes]], w: bytes) -> str | None:
    lo, hi = 0, len(parts)
    while hi - lo > 1:  # the last part that begins with w or before
        k = (lo + hi) // 2
        lo, hi = (lo, k) if parts[k][1] > w else (k, hi)
    if parts[lo][1] > w:
        return None
    words, index, bits = _mapped(path, parts[lo][0])
    h = xxhash.xxh3_64_intdigest(w)
    size = len(bits) * 8
    for at in (h % size, (h >> 32) % size):
        if not bits[at >> 3] >> (at & 7) & 1:
            return None
    lo, hi = 0, len(index) // 2
    while lo < hi:
        k = (lo + hi) // 2
        begin = index[2 * k - 1] if k else 0
        at = words[begin:index[2 * k]]
        if at == w:
            return words[index[2 * k]:index[2 * k + 1]].decode()
        lo, hi = (k + 1, hi) if at < w else (lo, k)
    return None


def store(df: DataFrame, head: DataFrame, kind: type[Store] = Store) -> Store:
    """The texts (w, v) of both tables: those of head come into memory, the rows of df are written to files by the tasks that hold them."""
    from telarium.session import local_path, shared_dir

    spark = df.sparkSession
    url = f"{shared_dir(spark)}/words-{uuid.uuid4().hex}"
    path = local_path(url)
    if "://" in path:
        raise ValueError("the shared folder must be mounted where the workers run")
    arrow = pa.schema([("part", pa.string()), ("first", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, end, hashes = uuid.uuid4().hex, None, 0, []
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{part}.words", "wb") as a, open(f"{path}/{part}.index", "wb") as b:
            for batch in batches:
                for w, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    w = w.encode("utf-8", "replace")
                    first = w if first is None else first
                    hashes.append(xxhash.xxh3_64_intdigest(w))
                    mid = end + a.write(w)
                    end = mid + a.write(v.encode())
                    b.write(mid.to_bytes(8, "little") + end.to_bytes(8, "little"))
        if first is not None:
            bits = np.zeros(-(-len(hashes) * FILTER_BITS // 8), np.uint8)
            h = np.array(hashes, np.uint64)
            for at in (h % np.uint64(len(bits) * 8), (h >> np.uint64(32)) % np.uint64(len(bits) * 8)):
                np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7)).astype(np.int64)).astype(np.uint8))
            bits.tofile(f"{path}/{part}.filter")
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([first], pa.binary())], schema=arrow)

    got = head.toPandas()
    parts = df.where(F.col("w") != "").select("w", "v").repartitionByRange("w").sortWithinPartitions("w").mapInArrow(write, "part string, first binary").collect()
    return kind(dict(zip(got.w, got.v)), path, sorted(((r.part, bytes(r.first)) for r in parts), key=lambda x: x[1]))


def counts(df: DataFrame, bound: int, least: int) -> Counts:
    """The counts (w, n) of least or more; those under bound in files."""
    df = df.select("w", "n", F.col("n").cast("string").alias("v")).where(F.col("n") >= least)
    return store(df.where(F.col("n") < bound), df.where(F.col("n") >= bound), Counts)


class Vectors:
    """Vectors of words: the sum of one of their own, if they have one, and the mean of those of their letter n-grams. And those of contexts."""

    def __init__(self, own: dict[str, np.ndarray], grams: np.ndarray, contexts: np.ndarray) -> None:
        self.own, self.grams, self.contexts = own, grams, contexts
        self.number = {w: i for i, w in enumerate(own)}
        self._memo: dict[str, np.ndarray] = {}

    def __bool__(self) -> bool:
        return bool(self.own)

    def __contains__(self, w: str) -> bool:
        return w in self.own

    def __getitem__(self, w: str) -> np.ndarray:
        v = self._memo.get(w)
        if v is None:
            v = self.grams[letter_grams(w)].mean(0)
            v = v + self.own[w] if w in self.own else v
            if len(self._memo) > 1 << 15:
                self._memo.clear()
            self._memo[w] = v
        return v

    def near(self, a: str, b: str) -> float:
        """Cosine of two words; 1 where nothing is known of one."""
        return self.cosine(self[a], self[b], 1.0)

    @staticmethod
    def cosine(x: np.ndarray, y: np.ndarray, unknown: float = 0.0) -> float:
        n = float(np.sqrt((x @ x) * (y @ y)))
        return float(x @ y) / n if n else unknown

    def context(self, left: list[str], right: list[str]) -> np.ndarray | None:
        """Sum of the vectors of what stands around a word; None if nothing is known of it."""
        at = [self.number[c] % CONTEXTS for c in left[-WINDOW:] if c in self.number] + [CONTEXTS + self.number[c] % CONTEXTS for c in right[:WINDOW] if c in self.number]
        return self.contexts[at].sum(0) if at else None


def letter_grams(w: str) -> list[int]:
    """Buckets of the runs of three and four letters of a word between its ends."""
    b = f"<{w}>"
    return [xxhash.xxh32_intdigest(b[i:i + n]) % GRAMS for n in (3, 4) for i in range(max(1, len(b) - n + 1))]


class Reader:
    """Links words to the vocabulary. links: those of all words of the texts, made before; without them they are made when they are needed."""

    def __init__(self, vocabulary: dict[str, int], vectors: Vectors | None = None, links: Store | None = None) -> None:
        self.n, self.vec, self.links = vocabulary, vectors, links
        self.fresh = lru_cache(1 << 16)(self._link)
        self.link = self.fresh if links is None else lru_cache(1 << 17)(lambda w: tuple(self.links.get(w, "").split()))
        self.fine = lru_cache(1 << 18)(self._fine)
        self.plain: set[str] = set()  # words seen to be fine

    def _link(self, word: str) -> tuple[str, ...]:
        """Frequent neighbours that word may be misread from, the likeliest first; none if it is a word."""
        own = self.n.get(word, 0)
        odd = bool(_ODD.search(word))
        if len(word) < 3 and not odd or not any(c.isalpha() for c in word):
            return ()
        found = []
        for v, weak in edits(word).items():
            n = self.n.get(v, 0)
            if not n or _ODD.search(v):
                continue
            if n >= (1 if odd else WEAK_RATIO if weak else RATIO) * max(own, 1) and (odd or len(v) > 3 or n > 50 * max(own, 1)):
                if not self.vec or self.vec.near(word, v) >= NEAR:
                    found.append((weak, -n, v))
        return tuple(v for _, _, v in sorted(found))

    def correct(self, word: str, context: tuple[list[str], list[str]] = ([], []), link: Callable | None = None) -> str | None:
        """The word that was printed, or None if word is no misreading. The context (words before and behind) decides between neighbours, and whether a word that is known stays."""
        low = word.lower()
        if "-" in low and low not in self.n:
            parts = low.split("-")
            got = [self.correct(p, context, link) if p else None for p in parts]
            return "-".join(g or p for g, p in zip(got, parts)) if any(got) else None
        options = (link or self.link)(low)
        if not options:
            return None
        if self.vec and (around := self.vec.context(*context)) is not None:
            best = max(options, key=lambda v: math.log(self.n.get(v, 1)) + float(around @ self.vec[v]))
            if low in self.vec and not _ODD.search(low):
                fits = lambda v: 0.25 * math.log(self.n.get(v, 1)) + self.vec.cosine(around, self.vec[v])
                return None if fits(low) > fits(best) else best
            return best
        return options[0]

    def _fine(self, word: str) -> bool:
        """No context can make word a misreading: nothing is linked to it or its parts, and it has no signs."""
        w = word.strip("-–'’*•›>·")
        return not _ODD.search(w) and not any(self.link(p) for p in {w.lower(), *w.lower().split("-")} if p)

    def misread(self, word: str, context: tuple[list[str], list[str]] = ([], []), link: Callable | None = None) -> bool:
        """word has misread characters: it is linked, or is an unknown word of letters with signs between them."""
        w = word.strip("-–'’*•›>·")
        if link is None and self.fine(word):
            return False
        if sum(c.isalpha() for c in w) < 2:
            return len(w) == 2 and any(c in "@!|$" for c in w) and bool((link or self.link)(w.lower()))
        if self.correct(w, context, link):
            return True
        if "�" in w or "´" in w or "?" in w:
            return True
        return bool(re.fullmatch(r"[^\W\d_]*[^\W\d_]{2}(?:[0-9@!|$]|\\/)[^\W\d_]*|[^\W\d_]+(?:[0-9@!|$]|\\/)[^\W\d_]{2,}[^\W\d_]*", w)) and len(w) > 4 and w.lower() not in self.n

    def any_misread(self, words: list[str]) -> bool:
        """Some word of a line is misread, in the context of what stands around it."""
        if self.plain.issuperset(words):
            return False
        for j, w in enumerate(words):
            if w in self.plain:
                continue
            if self.fine(w):
                if len(self.plain) < 1 << 18:
                    self.plain.add(w)
            elif self.misread(w, (words[max(0, j - WINDOW):j], words[j + 1:j + 1 + WINDOW])):
                return True
        return False

    def fix(self, text: str) -> str:
        """text with its misread words corrected, in the case they had."""
        words = [t.lower() for t in _TOKEN.findall(text)]
        at = iter(range(len(words)))

        def one(m: re.Match) -> str:
            i = next(at)
            if words[i] in self.plain or self.fine(words[i]) or sum(c.isalpha() for c in m[0]) < 2:
                return m[0]
            v = self.correct(m[0], (words[max(0, i - WINDOW):i], words[i + 1:i + 1 + WINDOW]))
            return m[0] if v is None else v.upper() if m[0].isupper() and len(m[0]) > 2 else v.capitalize() if m[0][:1].isupper() else v

        return _TOKEN.sub(one, text)

    def one_word(self, w: str) -> bool:
        return bool(self.n.get(w.lower()) or self.fresh(w.lower()))

    def divided(self, a: str, b: str, sign: str) -> bool:
        """a and b are halves of one word, not of a compound with a hyphen of its own."""
        if sign != "-":
            return True
        a, b = a.lower(), b.lower()
        whole, compound = self.n.get(a + b, 0), self.n.get(f"{a}-{b}", 0)
        if whole or compound:
            return whole >= compound
        if self.fresh(a + b):
            return True
        if any(self.n.get(x) for x in self.fresh(f"{a}-{b}")):
            return False
        known = lambda w: self.n.get(w, 0) >= MIN_COUNT or bool(self.fresh(w))
        return not (known(a) and known(b) and len(a) > 4 and len(b) > 4)


def page_noise(text: str, page: int | None, furniture: list[str], labels: set[str], r: Reader) -> tuple[list[tuple[int, str]], str]:
    """((line, noise) of a page, the page as continuous paragraphs)."""
    lines = lines_of(text)
    skel = [skeleton(x) for x in lines]
    out: set[tuple[int, str]] = set()
    keep: list[int] = []
    known = set(furniture)
    for i, x in enumerate(lines):
        if not x:
            continue
        n = number_of(x)
        if n is not None:
            before = next((skel[j] for j in range(i - 1, -1, -1) if lines[j]), "")
            plain = x.isdigit()
            is_f = before not in labels and (n == page or not plain) if page is not None else not plain
        else:
            is_f = skel[i] not in labels and (skel[i] in known or bool(known) and len(x) > 5 and x[-1:] not in ":;.," and any(_close(skel[i], k) for k in known))
        if is_f:
            out.add((i, "furniture"))
        else:
            keep.append(i)
    body = {i: lines[i] for i in keep}
    joined: list[str] = []
    for k, i in enumerate(keep):
        x = body[i]
        m = (_BREAK.search(x) or _LOOSE.search(x)) if x.rstrip(" \t")[-1:] in ("-", "\xad", "¬") else None
        nxt = keep[k + 1] if k + 1 < len(keep) else None
        if m and nxt is not None:
            a = re.split(r"[\s.,;:()«»¿?\"“”]", m[1])[-1]
            t = re.match(r"[^\W\d_][^\s.,;:()«»¿?]*|[0-9@!][^\W\d_][^\s.,;:()«»¿?]*", body[nxt])
            if a and t and (r.divided(a, t[0], m[2]) if m[0][len(m[1])] != " " else r.one_word(a + t[0])):
                out.add((i, "hyphen"))
                whole = a + t[0]
                context = _tokens(x)[:-1][-WINDOW:], _tokens(body[nxt])[1:1 + WINDOW]
                fixed = r.correct(whole, context, r.fresh)
                if fixed or r.misread(whole, context, r.fresh):
                    halves = _blame(a, t[0], fixed)
                    out.update((j, "char") for j, bad in zip((i, nxt), halves) if bad)
                done = (fixed or whole) if not whole[:1].isupper() else (fixed or whole).capitalize()
                body[i] = x[:m.end(1) - len(a)]
                body[nxt] = done + body[nxt][t.end():]
                checked = _TOKEN.findall(x[:m.end(1) - len(a)].lower())
            else:
                checked = _TOKEN.findall(x.lower())
        else:
            checked = _TOKEN.findall(x.lower())
        if k and (keep[k - 1], "hyphen") in out:  # the word that begins before was judged there
            checked = checked[1:]
        bad = r.any_misread(checked)
        if bad:
            out.add((i, "char"))
        joined.append(r.fix(body[i]) if bad else body[i])
    return sorted(out), reflow(joined)


def _close(a: str, b: str) -> bool:
    """Skeletons that differ in one or two places."""
    if abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 6 or a[:2] != b[:2] and a[-2:] != b[-2:]:
        return False
    p, allowed = list(range(len(b) + 1)), 1 if len(b) < 12 else 2
    for i, x in enumerate(a):
        q = [i + 1]
        for j, y in enumerate(b):
            q.append(min(p[j] + (x != y), p[j + 1] + 1, q[j] + 1))
        p = q
        if min(p) > allowed:
            return False
    return p[-1] <= allowed


def _blame(a: str, b: str, fixed: str | None) -> tuple[bool, bool]:
    """Which half of a divided word is misread."""
    low = a.lower()
    if not fixed:
        return bool(_ODD.search(a)), bool(_ODD.search(b))
    left = not fixed.startswith(low)
    right = not fixed.endswith(b.lower())
    return (left, right) if left or right else (True, False)


_ITEM_START = re.compile(r"^(?:[-•›*>▪·–]|\d+[.)]|OA\w*\s|\w\))\s*")


def reflow(lines: list[str]) -> str:
    """Paragraphs: a line continues the one before unless it opens an item or the one before ends a paragraph."""
    out: list[str] = []
    for x in lines:
        x = x.strip()
        if not x:
            continue
        if out and not _ITEM_START.match(x) and (out[-1][-1:] not in ".:;)?!" or x[:1].islower() or x[:1] == "("):
            out += [x] if out[-1][-1:] == "-" and out[-1][-2:-1].isalpha() else [" ", x]
        else:
            out += ["\n", x] if out else [x]
    return "".join(out)


def item_noise(text: str, strips: set[str], r: Reader) -> tuple[list[str], str]:
    """(kinds of noise of an item, the item as continuous text)."""
    out: set[str] = set()
    text = _ligatures(text)
    s, cut = text, _strip_furniture(text, strips)
    if cut is not None:
        out.add("furniture")
        s = cut
    label = re.match(r"^\s*\d+\.\d+\s+", s)
    head, s = (label[0].strip() + " ", s[label.end():]) if label else ("", s)

    def join(m: re.Match) -> str:
        a, loose, sign, b = m.groups()
        if loose and not r.one_word(a + b):
            return m[0]
        if not loose and not r.divided(a, b, sign):
            return a + "-" + b
        out.add("hyphen")
        return a + b

    s = " ".join((_INNER.sub(join, s) if "-" in s or "\xad" in s or "¬" in s else s).split())
    if r.any_misread(_TOKEN.findall(s.lower())):
        out.add("char")
        s = r.fix(s)
    return sorted(out), head + s


def _tail(text: str) -> str:
    """What stands behind the last point of an item that ends a word."""
    found = list(re.finditer(r"(?<=[^\W\d_])[.](?=\s|$)|(?<=[)»”\d])[.](?=\s)", text.rstrip()))
    return text.rstrip()[found[-1].end():].strip() if found else ""


def _strip_furniture(text: str, strips: set[str]) -> str | None:
    """The item without the header or footer it contains, or None if there is none."""
    tail = _tail(text)
    if tail and _DIGIT.search(tail) and (number_of(tail) is not None or skeleton(tail) in strips):
        return text.rstrip()[:-len(tail)].rstrip()
    s = text.strip()
    label = re.match(r"^\d+\.\d+\s+", s)
    if not _DIGIT.search(s, label.end() if label else 0):
        return None
    at = label.end() if label else 0
    if not strips:
        return None
    longest = strips.longest if isinstance(strips, Strips) else max(map(len, strips))
    words = list(re.finditer(r"\S+", s))
    skel = [skeleton(w[0]) for w in words]  # that of a part is those of its words, with blanks between
    digit = [bool(_DIGIT.search(w[0])) for w in words]
    for i, w in enumerate(words):
        if w.start() < at and w.start() != 0:
            continue
        if not (s[w.start()].isdigit() or s[w.start()].isupper()):
            continue
        part, has, end = "", False, None
        for k in range(i, len(words)):
            has = has or digit[k]
            if skel[k]:
                part = f"{part} {skel[k]}" if part else skel[k]
                if len(part) > longest:
                    break
            if has and part in strips:
                end = words[k].end()
        if end is not None:
            return (s[:w.start()].rstrip() + " " + s[end:].lstrip()).strip()
    return None


# ---- statistics over the whole corpus -------------------------------------------------------------------------------


def page_lines(pages: DataFrame) -> DataFrame:
    """(source_pdf, page_id, skel, low, next_low, number, label): the lines of pages, of any length."""
    arrow = pa.schema([("source_pdf", pa.string()), ("page_id", pa.int64()), ("skel", pa.string()), ("low", pa.bool_()), ("next_low", pa.bool_()), ("number", pa.int64()), ("is_page", pa.bool_()), ("label", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for pid, pdf, page, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                lines = [x for x in lines_of(text or "") if x]
                for i, x in enumerate(lines):
                    nxt = next((y for y in lines[i + 1:i + 3] if number_of(y) is None), "")
                    n = number_of(x)
                    out.append((pdf, pid, skeleton(x), x[:1].islower() or x[:1] == "(" or x[-1:] in ":.;,)", nxt[:1].islower(), n if n is not None and x.isdigit() else None, n is not None and n == page, skeleton(lines[i - 1]) if i and n is not None else None))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 8, arrow.types)], schema=arrow)

    return pages.select("page_id", "source_pdf", "pdf_page", "text").mapInArrow(run, "source_pdf string, page_id long, skel string, low boolean, next_low boolean, number long, is_page boolean, label string")


def furniture(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(source_pdf, furniture): skeletons of the running lines of each file; at most average lines of a page / REPEATED of them."""
    per = pages.groupBy("source_pdf").agg(F.count("*").alias("pages"))
    rep = lines.where("number IS NULL").groupBy("source_pdf", "page_id", "skel").agg(F.max("low").alias("low"), F.max(F.col("next_low").cast("int")).alias("nl")).groupBy("source_pdf", "skel").agg(
        F.count("*").alias("n"), F.max("low").alias("low"), F.avg("nl").alias("nl"))
    return rep.where("NOT low AND nl < 0.5 AND skel <> ''").join(per, "source_pdf").where((F.col("n") >= PAGES) & (F.col("n") >= REPEATED * F.col("pages"))).groupBy("source_pdf").agg(F.collect_list("skel").alias("furniture"))


def labels(lines: DataFrame) -> DataFrame:
    """(source_pdf, labels): skeletons of lines of a file that numbers follow which mostly aren't those of pages, in any file."""
    known = lines.where("number IS NOT NULL AND label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"), F.avg(F.col("is_page").cast("int")).alias("p")).where("n >= 3 AND p < 0.5").select("label")
    return lines.where("label IS NOT NULL AND source_pdf IS NOT NULL").select("source_pdf", "label").distinct().join(known, "label").groupBy("source_pdf").agg(F.collect_list("label").alias("labels"))


def item_strips(items: DataFrame) -> Strips:
    """The skeletons of what follows the last point of items, if it repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = Counter(skeleton(t) for x in b.column(0).to_pylist() if x and _DIGIT.search(x) and (t := _tail(x)) and _DIGIT.search(t))
            n[""] = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["skel", "n"])

    from telarium.session import settle

    seen = settle(items.select("text").mapInArrow(run, "skel string, n long").groupBy(F.col("skel").alias("w")).agg(F.sum("n").alias("n")))
    total = seen.where("w = ''").agg(F.sum("n")).first()[0] or 0
    longest = seen.where("n >= 2").agg(F.max(F.length("w"))).first()[0] or 0
    return Strips(counts(seen.where("w != ''"), int(total * SHARE), 2), longest)


def words_of(texts: DataFrame) -> DataFrame:
    """(w, n): all words and compounds of the texts and how often they are seen. Halves of divided words count 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()

        def flush() -> pa.RecordBatch:
            for w in list(n):
                if w and not (w[0].isalpha() and w[-1].isalpha()):
                    n[w.strip("-–'’*•›>·")] += 0
            return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["w", "n"])

        for b in batches:
            for text in b.column(0).to_pylist():
                last = False
                for line in lines_of(text or ""):
                    ws = _tokens(line)
                    if not ws:
                        last = False
                        continue
                    if last:
                        n[ws[0]] += 0
                    if "-" not in line and "\xad" not in line and "¬" not in line:
                        n.update(ws[1:] if last else ws)
                        last = False
                        continue
                    for i, w in enumerate(ws):
                        k = not (i == 0 and last or w[-1:] in "-\xad¬" or i and ws[i - 1][-1:] in "-\xad¬")
                        n[w] += k
                        if "-" in w:
                            for p in w.split("-"):
                                n[p] += k
                    last = ws[-1][-1:] in "-\xad¬"
            if len(n) > 1 << 18:
                yield flush()
                n.clear()
        yield flush()

    return texts.mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).where("w != ''")


def vocabulary(words: DataFrame) -> Counts:
    """Counts of the words (w, n) seen MIN_COUNT times or more; words: a settled table."""
    total = words.agg(F.sum("n")).first()[0] or 0
    return counts(words, int(total * SHARE), MIN_COUNT)


def linked(words: DataFrame, vocab: Counts, vectors: Vectors | None) -> Store:
    """The links of all words (w, n); each word is linked once, whatever the texts it stands in."""
    shared = words.sparkSession.sparkContext.broadcast((vocab, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Reader(*shared.value)
        for b in batches:
            got = [(w, " ".join(x)) for w in b.column(0).to_pylist() if (x := r._link(w))]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in (zip(*got) if got else [[], []])], ["w", "v"])

    from telarium.session import settle

    found = settle(words.select("w").repartition(words.sparkSession.sparkContext.defaultParallelism * 2, "w").mapInArrow(run, "w string, v string"))
    return store(found, found.limit(0))


def skip_grams(texts: DataFrame, vocab: dict[str, int]) -> Vectors | None:
    """Skip-gram vectors from the WORDS most frequent words, shared by the letter n-grams of all words.

    Pairs (word, side and bucket of a word at most WINDOW away) are counted over all texts, combined within tasks; the objective with
    negative samples is then followed in full from the counts, of which there are 2 x WORDS x CONTEXTS at most.
    """
    top = sorted((w for w in dict.keys(vocab) if not _ODD.search(w)), key=lambda w: (-vocab.get(w), w))[:WORDS]
    if len(top) < 8:
        return None
    number = {w: i for i, w in enumerate(top)}
    shared = texts.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, n = shared.value, np.zeros(len(shared.value) * 2 * CONTEXTS, np.int64)
        for b in batches:
            ids: list[int] = []
            for text in b.column(0).to_pylist():
                ids += [number.get(w, -1) for w in _tokens(text or "")]
                ids += [-1] * WINDOW
            x = np.array(ids, np.int64)
            for d in range(1, WINDOW + 1):
                a, c = x[:-d], x[d:]
                ok = (a >= 0) & (c >= 0)
                for p, q, side in ((c[ok], a[ok], 0), (a[ok], c[ok], CONTEXTS)):  # what stands before, behind
                    k = p * 2 * CONTEXTS + q % CONTEXTS + side
                    if len(k) * 16 > len(n):
                        n += np.bincount(k, minlength=len(n))
                    else:
                        k, m = np.unique(k, return_counts=True)
                        n[k] += m
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n[k])], ["k", "n"])

    got = texts.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    N = np.zeros((len(top), 2 * CONTEXTS), np.float32)
    k = got.k.to_numpy()
    N[k // (2 * CONTEXTS), k % (2 * CONTEXTS)] = got.n.to_numpy()
    return _train(top, N)


def _train(top: list[str], N: np.ndarray) -> Vectors:
    rng = np.random.default_rng(7)
    W, V = (rng.normal(0, 0.1, (n, DIM)).astype(np.float32) for n in N.shape)
    G = np.zeros((GRAMS, DIM), np.float32)
    grams = [letter_grams(w) for w in top]
    which = np.array([g for gs in grams for g in gs])
    word = np.repeat(np.arange(len(top)), [len(gs) for gs in grams])
    part = (1 / np.array([len(gs) for gs in grams], np.float32))[word]
    begin = np.concatenate([[0], np.cumsum([len(gs) for gs in grams])[:-1]])
    by_gram = np.argsort(which, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(which[by_gram]) > 0]))
    used = which[by_gram][heads]
    row, col = N.sum(1, keepdims=True), N.sum(0, keepdims=True) ** 0.75
    noise = NEGATIVE * row * (col / max(col.sum(), 1e-9))
    weight = 1 / np.maximum(N + noise, 1).mean()
    params = (W, V, G)
    m = [(np.zeros_like(x), np.zeros_like(x)) for x in params]
    for t in range(1, ROUNDS + 1):
        U = W + np.add.reduceat(G[which], begin, axis=0) * part[begin][:, None]
        p = 1 / (1 + np.exp(-(U @ V.T)))
        g = (noise * p - N * (1 - p)) * weight
        dU = g @ V
        dG = np.zeros_like(G)
        dG[used] = np.add.reduceat((dU[word] * part[:, None])[by_gram], heads, axis=0)
        for x, grad, (a, b) in zip(params, (dU, g.T @ U, dG), m):
            a *= 0.9
            a += 0.1 * grad
            b *= 0.99
            b += 0.01 * grad * grad
            x -= 0.05 * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.99 ** t)) + 1e-8)
    return Vectors({w: W[i] for i, w in enumerate(top)}, G, V)


_readers: dict[str, tuple[Reader, Strips]] = {}


def _reader(shared) -> tuple[Reader, Strips]:
    """The reader of a broadcast and the strips; a worker keeps the last one, with what it has remembered of words, for its next task."""
    vocab, vectors, links, strips = shared.value
    if links.path not in _readers:
        _readers.clear()
        _readers[links.path] = Reader(vocab, vectors, links), strips
    return _readers[links.path]


_NOISE = "table_name string, row_id long, pos int, noise string, text string"
_NOISE_ARROW = pa.schema([("table_name", pa.string()), ("row_id", pa.int64()), ("pos", pa.int32()), ("noise", pa.string()), ("text", pa.string())])


def _items(tables: list[tuple[str, DataFrame, str, str]]) -> DataFrame | None:
    out = None
    for name, df, rid, col in tables:
        x = df.select(F.lit(name).alias("table_name"), F.col(rid).cast("long").alias("row_id"), F.posexplode(F.col(col)).alias("pos", "text")).where(F.col("text").isNotNull())
        out = x if out is None else out.unionByName(x)
    return out


def read(pages: DataFrame, item_tables: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """(table_name, row_id, pos, noise, text): one row for each place and kind of noise with text null, and the repaired text of
    each page (pos -1) and item (its pos) with noise null.

    pages(page_id, source_pdf, pdf_page, text); item_tables: (name, table, id column, column of lists). Null and empty texts, lists
    and items give no rows of noise; a null or empty page has no text either. Statistics cover all rows. What workers
    get in memory is bounded: the vocabulary and the strips by SHARE, the vectors by WORDS and GRAMS; what is rarer, and the links, lies in mapped files. Files of any
    number of pages are spread over tasks: pages are handled one by one and meet their file's running lines in a join.
    """
    from telarium.session import settle

    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "source_pdf", F.col("pdf_page").cast("int").alias("pdf_page"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    items = _items(item_tables)
    lines = settle(page_lines(pages))
    running = settle(furniture(lines, pages).join(labels(lines), "source_pdf", "full_outer"))
    texts = pages.select("text").unionByName(items.select("text")) if items is not None else pages.select("text")
    words = settle(words_of(texts))
    vocab = vocabulary(words)
    vectors = skip_grams(texts, vocab)
    links = linked(words, vocab, vectors)
    shared = pages.sparkSession.sparkContext.broadcast((vocab, vectors, links, item_strips(items) if items is not None else {}))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 5, _NOISE_ARROW.types)], schema=_NOISE_ARROW)

    def run_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, _ = _reader(shared)
        for b in batches:
            out = []
            for pid, page, text, fur, lab in zip(*(b.column(i).to_pylist() for i in range(5))):
                noise, clean = page_noise(text, page, fur or [], set(lab or ()), r)
                out += [("bases_pages", pid, i, k, None) for i, k in noise]
                if text.strip():
                    out.append(("bases_pages", pid, -1, None, clean))
            yield batch(out)

    def run_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, strips = _reader(shared)
        for b in batches:
            out = []
            for name, rid, pos, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if not text.strip():
                    continue
                noise, clean = item_noise(text, strips, r)
                out += [(name, rid, pos, k, None) for k in noise]
                out.append((name, rid, pos, None, clean))
            yield batch(out)

    got = pages.join(running, "source_pdf", "left").select("page_id", "pdf_page", "text", "furniture", "labels").mapInArrow(run_pages, _NOISE)
    return got.unionByName(items.select("table_name", "row_id", "pos", "text").mapInArrow(run_items, _NOISE)) if items is not None else got


def found(got: DataFrame) -> DataFrame:
    return got.where("noise IS NOT NULL").select("table_name", "row_id", "pos", "noise")


def repaired(got: DataFrame) -> DataFrame:
    return got.where("noise IS NULL").select("table_name", "row_id", "pos", "text")
