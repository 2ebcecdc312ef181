"""Encoding of a corpus with a public byte-level BPE tokenizer.

The words that are frequent in the corpus are compiled into a minimal acyclic automaton over
their bytes. Each edge holds how many words it skips, so a walk yields the word's number, and
the number yields its ids. The automaton is a flat file that workers map into memory; words
that it doesn't hold are merged exactly by rank.
"""

from __future__ import annotations

import base64
import functools
import heapq
import os
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telarium.session import local_path, shared_dir

#: Folder of the vocabulary files.
TOKENIZERS = os.environ.get("TELARIUM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: how the public tokenizer divides text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words in the lexicon at most; all others are merged when they are met. So it bounds memory, not the result.
LEXICON = 1 << 16
#: A word is worth a place in the lexicon from this count on.
MIN_COUNT = 2
#: Longest word of the lexicon in bytes; longer ones are merged when met.
MAX_BYTES = 64
_MEMO = 1 << 18


@functools.lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def merge(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of lowest rank is joined, leftmost first, until no pair has a rank. O(n log n)."""
    n = len(word)
    if (whole := rank.get(word)) is not None:
        return [whole]
    part: list[bytes | None] = [word[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 1) for i in range(n - 1) if (r := rank.get(word[i:i + 2])) is not None]
    size = [1] * n
    heapq.heapify(heap)
    heap = [(r, i, 2) for r, i, _ in heap]
    while heap:
        r, i, total = heapq.heappop(heap)
        j = after[i] if part[i] is not None else n
        if j >= n or size[i] + size[j] != total:
            continue
        part[i] = part[i] + part[j]  # type: ignore[operator]
        size[i], part[j] = total, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (q := rank.get(part[i] + part[k])) is not None:  # type: ignore[operator]
                heapq.heappush(heap, (q, i, size[i] + size[k]))
        if (h := before[i]) >= 0 and (q := rank.get(part[h] + part[i])) is not None:  # type: ignore[operator]
            heapq.heappush(heap, (q, h, size[h] + size[i]))
    return [rank[p] for p in part if p is not None]


def minimal_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted distinct words, built by adding words in order and sharing equal suffixes.

    keys: state * 256 + byte of each edge, ascending; target: state it leads to; skip: words that come before those
    through this edge among the words of its state; final: states that end a word. State 0 is the start.
    """
    states: list[list] = [[False, {}]]  # final, edges
    register: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []  # parent, byte, child of the last word

    def close(down_to: int) -> None:
        while len(path) > down_to:
            parent, byte, child = path.pop()
            sig = (states[child][0], tuple(states[child][1].items()))
            if (same := register.get(sig)) is not None:
                states[parent][1][byte] = same
                if child == len(states) - 1:
                    states.pop()
            else:
                register[sig] = child

    last = b""
    for w in words:
        common = 0
        while common < min(len(w), len(last)) and w[common] == last[common]:
            common += 1
        close(common)
        at = path[-1][2] if path else 0
        for b in w[common:]:
            states.append([False, {}])
            states[at][1][b] = len(states) - 1
            path.append((at, b, len(states) - 1))
            at = len(states) - 1
        states[at][0] = True
        last = w
    close(0)
    count: dict[int, int] = {}
    stack = [0]
    while stack:
        s = stack[-1]
        if s in count:
            stack.pop()
            continue
        todo = [t for t in states[s][1].values() if t not in count]
        if todo:
            stack += todo
        else:
            count[s] = states[s][0] + sum(count[t] for t in states[s][1].values())
            stack.pop()
    keys, target, skip = [], [], []
    for s in sorted(count):
        before = int(states[s][0])
        for b, t in sorted(states[s][1].items()):
            keys.append(s * 256 + b)
            target.append(t)
            skip.append(before)
            before += count[t]
    return {
        "keys": np.array(keys, np.int64), "target": np.array(target, np.int64), "skip": np.array(skip, np.int64),
        "final": np.array([s[0] for s in states], bool),
    }


def compile_lexicon(words: list[bytes], rank: dict[bytes, int]) -> dict[str, np.ndarray]:
    words = sorted(set(words))
    ids = [merge(w, rank) for w in words]
    return minimal_automaton(words) | {"start": np.cumsum([0, *map(len, ids)]), "ids": np.array([i for x in ids for i in x], np.int64)}


_PARTS = ("keys", "target", "skip", "final", "start", "ids")


def write_lexicon(spark: SparkSession, parts: dict[str, np.ndarray]) -> str:
    """One flat file in the folder all executors share: a header of lengths, then the arrays."""
    blob = b"".join([np.array([len(parts[p]) for p in _PARTS], np.int64).tobytes(), *(parts[p].astype(np.int64).tobytes() for p in _PARTS)])
    url = f"{shared_dir(spark)}/lexicon-{uuid.uuid4().hex}.bin"
    path = local_path(url)
    if "://" not in path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(blob)
        return path
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(url)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(blob)
    out.close()
    spark.sparkContext.addFile(url)  # executors keep their own copy
    return url


class Lexicon:
    """The automaton, mapped into memory."""

    def __init__(self, path: str) -> None:
        if "://" in path:
            from pyspark import SparkFiles

            path = SparkFiles.get(path.rpartition("/")[2])
        flat = np.memmap(path, np.int64, "r")
        at = len(_PARTS)
        for name, n in zip(_PARTS, flat[:at].tolist()):
            setattr(self, name, flat[at:at + n])
            at += n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word in the lexicon, -1 for those it doesn't hold; all words walk at once, byte by byte."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return out
        length = np.fromiter(map(len, words), np.int64, n)
        live = np.flatnonzero((length > 0) & (length <= MAX_BYTES))
        begin = np.concatenate([[0], np.cumsum(length)])
        data = np.frombuffer(b"".join(words), np.uint8)
        state, number, k = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64), 0
        while len(live):
            q = state * 256 + data[begin[live] + k]
            e = np.searchsorted(self.keys, q)
            e[e == len(self.keys)] = 0
            ok = self.keys[e] == q
            live, e = live[ok], e[ok]
            state, number, k = self.target[e], number[ok] + self.skip[e], k + 1
            ended = length[live] == k
            hit = ended & (self.final[state] != 0)
            out[live[hit]] = number[hit]
            live, state, number = live[~ended], state[~ended], number[~ended]
        return out


class Encoder:
    """Words to ids through the lexicon, with a bounded memo; unseen words are merged exactly."""

    def __init__(self, lexicon: str, vocabulary: str) -> None:
        self.lex, self.rank = Lexicon(lexicon), ranks(vocabulary)
        self.find = regex.compile(PATTERN).findall
        self.reset()

    def reset(self) -> None:
        self.memo: dict[str, int] = {}
        self.start, self.ids = [np.zeros(1, np.int64)], []
        self.total = 0

    def learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        numbers = self.lex.numbers(raw)
        for w, b, n in zip(words, raw, numbers.tolist()):
            ids = self.lex.ids[self.lex.start[n]:self.lex.start[n + 1]] if n >= 0 else np.array(merge(b, self.rank), np.int64)
            self.memo[w] = len(self.ids)
            self.ids.append(ids)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts; null and empty texts have no ids."""
        if len(self.memo) > _MEMO:
            self.reset()
        words = [self.find(t) if t else () for t in texts]
        new = set().union(*words).difference(self.memo) if words else set()
        if new:
            self.learn(sorted(new))
            self.flat = np.concatenate(self.ids).astype(np.int32)
            self.at = np.concatenate([[0], np.cumsum([len(x) for x in self.ids])])
        memo = self.memo
        w = np.fromiter((memo[x] for ws in words for x in ws), np.int64, sum(map(len, words)))
        if not len(w):
            return np.zeros(len(texts) + 1, np.int32), np.zeros(0, np.int32)
        n = self.at[w + 1] - self.at[w]
        ends = np.cumsum(n)
        take = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(self.at[w], n)
        per = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
        return np.concatenate([[0], ends])[per].astype(np.int64), self.flat[take]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts of a one-column table; counted within each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen = regex.compile(PATTERN).findall, Counter()
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    seen.update(find(t))
                if len(seen) > _MEMO:
                    yield flush()
                    seen.clear()
        yield flush()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_lexicon(docs: DataFrame, text_col: str = "text", size: int = LEXICON, min_count: int = MIN_COUNT, vocabulary: str | None = None) -> str:
    """Count the words of all texts and compile the most frequent ones; the lexicon's path.

    At most ``size`` words reach the driver, each of MAX_BYTES bytes or less.
    """
    spark, rank = docs.sparkSession, ranks(vocabulary or f"{TOKENIZERS}/{VOCABULARY}")
    top = (
        word_counts(docs.select(F.col(text_col).cast("string")).where(F.col(text_col).isNotNull()))
        .where((F.col("n") >= min_count) & (F.octet_length("word") <= MAX_BYTES))
        .orderBy(F.desc("n"), "word").limit(size).select("word").toPandas()
    )
    return write_lexicon(spark, compile_lexicon([w.encode("utf-8", "surrogatepass") for w in top.word], rank))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, lexicon: str | None = None) -> DataFrame:
    """(doc_id, ids list<int>) of every row, without special tokens.

    Null and empty texts get the empty list. A text that spells a special token is ordinary text. Repeated rows are
    encoded as often as they stand there. Only the two named columns are read. Texts are encoded whole; after
    the count of words, no shuffle.
    """
    vocab = vocabulary or f"{TOKENIZERS}/{VOCABULARY}"
    path = lexicon or fit_lexicon(docs, text_col, vocabulary=vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for b in batches:
            enc = enc or Encoder(path, vocab)
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                off, ids = enc.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every row."""
    return encode(docs, id_col, text_col, vocabulary).select("doc_id", F.size("ids").alias("n_tokens"))
