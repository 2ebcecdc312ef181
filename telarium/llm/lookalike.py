"""One consistent form of visually identical text.

Tokens that hold unordinary characters walk a trie of the corpus' own ordinary words with a
weighted edit automaton: look-alikes, compositions and ignorables cost nothing, other edits cost
their weight. The cheapest and then most frequent word within the allowed cost is the canonical
spelling; tokens that no word matches, and everything between tokens, are normalized by table.
"""

from __future__ import annotations

import re
import unicodedata as U
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts and the Latin letters they look like; the first is the usual one.
LOOKALIKES: dict[str, str] = {
    # Cyrillic
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "А": "A", "В": "B", "С": "C", "Е": "E", "Ԍ": "G", "Н": "H",
    "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "У": "Y", "Ѵ": "V",
    "Ԝ": "W", "Х": "X", "Ү": "Y", "ү": "y",
    # Greek
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "uv", "χ": "x", "γ": "y",
    "η": "n", "ω": "w", "ϲ": "c", "ϳ": "j", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "ό": "ó", "ά": "á", "έ": "é",
    "ί": "í", "ύ": "ú",
    # Armenian, Latin phonetic letters
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q", "ѡ": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ſ": "s",
    "ʏ": "y", "ɩ": "i", "ᴏ": "o", "ᴄ": "c", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s", "Ꭺ": "A", "Ꭼ": "E", "Ꮋ": "H",
    "Ꮇ": "M", "Ꭲ": "T", "Ꮯ": "C", "Ꮲ": "P",
}
# Signs that look like an ordinary one.
SIGNS = {"‐": "-", "‑": "-", ";": ";", "․": ".", "꞉": ":", "ː": ":", "∶": ":", "։": ":", "‚": ",", "٫": ",", "⁄": "/", "∕": "/"}

#: First letters that name a bin of words, and tokens of a bin that one task walks, about.
PREFIX, BIN = 3, 20_000
#: Weight of an edit that changes what is seen.
SUBSTITUTE, INSERT, DELETE = 1.0, 1.0, 1.0


def _compat(ch: str) -> str | None:
    """What ch stands for if it is another code point for ordinary text, else None. Super- and subscripts, fractions and the ellipsis are ordinary."""
    d = U.decomposition(ch)
    if not d.startswith("<"):
        return None
    kind = d[1:d.index(">")]
    if kind in ("wide", "narrow", "font", "noBreak"):
        return U.normalize("NFKC", ch)
    n = U.normalize("NFKC", ch)
    if kind == "compat" and (n.isalpha() and n.isascii() or n == " "):
        return n
    return None


def _table() -> tuple[dict[str, str], set[str]]:
    """(what each character is replaced by, the ignorable ones), by rule over the code space."""
    put, gone = dict(SIGNS), set()
    for cp in (*range(0x80, 0x20000), *range(0xE0000, 0xE0200)):
        ch = chr(cp)
        cat = U.category(ch)
        if cat == "Zs":
            put[ch] = " "
        elif cat == "Cf" or cp in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xFE00 <= cp <= 0xFE0F or 0x180B <= cp <= 0x180E or 0xE0100 <= cp <= 0xE01EF:
            gone.add(ch)
        elif cat == "Cc" and cp != 0x85:
            gone.add(ch)
        elif ch not in SIGNS and (c := _compat(ch)) is not None:
            put[ch] = c
    gone |= {chr(c) for c in (*range(0, 9), 11, 12, *range(14, 32), 127)} - {"\x0b", "\x0c"}
    return put, gone


PUT, IGNORABLE = _table()


def _klass(chars) -> str:
    """Regex class of characters, as ranges."""
    cps, out = sorted(map(ord, chars)), []
    for cp in cps:
        if out and out[-1][1] == cp - 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    esc = lambda c: f"\\u{c:04x}" if c < 0x10000 else f"\\U{c:08x}"
    return "".join(esc(a) + (f"-{esc(b)}" if b > a else "") for a, b in out)


_MARKS = "̀-ͯ"
_IGN = _klass(IGNORABLE)
_TOKEN = re.compile(f"(?:[^\\W_]|[{_MARKS}{_IGN}])+")
_ODD_SET = frozenset(PUT) | IGNORABLE | frozenset(LOOKALIKES)
_ODD = re.compile(f"[{_MARKS}{_klass(_ODD_SET)}]")
#: Java regex of text that may need work: anything but printable ASCII, white space and common ordinary characters.
MAYBE = "[^\\t\\n\\r -~áéíóúñüÁÉÍÓÚÑÜ¿¡«»“”…•°ºª²½–—·’‘›‹€�]"
_MAYBE = re.compile(MAYBE)
#: Java regex of ordinary lower-case words.
WORD = "[a-záéíóúñü]+"


def table_form(token: str) -> str:
    """Normalization by table of one token, or of text between tokens.

    Look-alike letters change only in a token all of whose letters are or look Latin, so words of other scripts stay.
    A single Greek letter is a symbol and stays, but for omicron, which is none.
    """
    s = "".join(PUT.get(c, c) for c in token if c not in IGNORABLE)
    s = U.normalize("NFC", s)
    if any(c in LOOKALIKES for c in s):
        letters = [c for c in s if c.isalpha()]
        single = len(letters) == 1 and "Ͱ" <= letters[0] <= "Ͽ" and letters[0] not in "οΟ"
        if not single and all(c in LOOKALIKES or U.name(c, "").startswith("LATIN") or c in "ºª" for c in letters):
            s = "".join(LOOKALIKES[c][0] if c in LOOKALIKES else c for c in s)
    return s


def consistent(text: str | None) -> str | None:
    """Normalization by table of a whole text; null stays null."""
    if text is None or not _MAYBE.search(text) or not _ODD.search(text):
        return text
    out, at = [], 0
    for m in _TOKEN.finditer(text):
        out.append(table_form(text[at:m.start()]))
        out.append(table_form(m[0]) if _ODD.search(m[0]) else m[0])
        at = m.end()
    out.append(table_form(text[at:]))
    return "".join(out)


class Trie:
    """Words with their counts. A node is a dict of edges; None holds (word, count)."""

    def __init__(self, words) -> None:
        self.root: dict = {}
        for w, n in words:
            node = self.root
            for ch in w:
                node = node.setdefault(ch, {})
            node[None] = (w, int(n))

    def match(self, token: str, budget: float = 0.0) -> tuple[str, float] | None:
        """(word, cost) of least cost within budget, the most frequent and then the first of these; None if there is none.

        Uniform-cost walk over states (position in token, trie node); the token's case doesn't matter.
        """
        import heapq

        chars = list(U.normalize("NFD", token.lower())) if any("̀" <= c <= "ͯ" for c in token) else list(token.lower())
        best: tuple | None = None
        seq, heap, done = 0, [(0.0, 0, 0, self.root)], set()
        while heap:
            cost, _, i, node = heapq.heappop(heap)
            if best and cost > best[0] or (i, id(node)) in done:
                continue
            done.add((i, id(node)))
            if i == len(chars) and None in node:
                w, n = node[None]
                if best is None or (cost, -n, w) < best:
                    best = (cost, -n, w)
            steps = []
            if i < len(chars):
                c = chars[i]
                if c in IGNORABLE:
                    steps.append((0.0, i + 1, node))
                else:
                    shown = {c, PUT.get(c, c).lower(), *LOOKALIKES.get(c, "")}
                    for s in shown:
                        at = node
                        for ch in s:  # a ligature walks several edges
                            at = at.get(ch) if at is not None else None
                        if at is not None:
                            steps.append((0.0, i + 1, at))
                        j, base = i + 1, s  # base letter and marks, with ignorables between them
                        while j < len(chars) and ("̀" <= chars[j] <= "ͯ" or chars[j] in IGNORABLE):
                            if chars[j] not in IGNORABLE:
                                base += chars[j]
                            j += 1
                            if len(whole := U.normalize("NFC", base)) == 1 and whole in node:
                                steps.append((0.0, j, node[whole]))
                    if cost + SUBSTITUTE <= budget:
                        steps += [(SUBSTITUTE, i + 1, x) for ch, x in node.items() if ch is not None]
                    if cost + DELETE <= budget:
                        steps.append((DELETE, i + 1, node))
            if cost + INSERT <= budget:
                steps += [(INSERT, i, x) for ch, x in node.items() if ch is not None]
            for c, j, x in steps:
                if cost + c <= budget:
                    seq += 1
                    heapq.heappush(heap, (cost + c, seq, j, x))
        return (best[2], best[0]) if best else None


def _cased(word: str, like: str) -> str:
    if word == like.lower():
        return like
    return word.upper() if like.isupper() and len(like) > 1 else word.capitalize() if like[:1].isupper() else word


def prefixes(piece: str, plain: str) -> list[str]:
    """The first letters of all words that a token may stand for; several where a look-alike is taken for several letters."""
    low = plain.lower()
    out = {low[:PREFIX]}
    if any(len(LOOKALIKES.get(c, "")) > 1 for c in piece):
        shown = [c for c in U.normalize("NFC", "".join(PUT.get(c, c) for c in piece if c not in IGNORABLE).lower())]
        out = {""}
        for c in shown:
            out = {a if len(a) >= PREFIX else a + b for a in out for b in (LOOKALIKES.get(c) or c)}
        out.add(low[:PREFIX])
    return sorted(x[:PREFIX] for x in out)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(table_name, row_id, h, pos, piece, plain, bins) of texts with unordinary characters; bins only of suspect tokens."""
    for b in batches:
        out: list[tuple] = []
        for name, rid, h, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if not _ODD.search(text):
                continue
            at, pos = 0, 0
            for m in _TOKEN.finditer(text):
                if _ODD.search(m[0]):
                    if m.start() > at:
                        out.append((name, rid, h, pos, text[at:m.start()], table_form(text[at:m.start()]), None))
                    plain = table_form(m[0])
                    out.append((name, rid, h, pos + 1, m[0], plain, prefixes(m[0], plain)))
                    at, pos = m.end(), pos + 2
            if at < len(text):
                out.append((name, rid, h, pos, text[at:], table_form(text[at:]), None))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 7, _PIECES.types)], schema=_PIECES)


_PIECES = pa.schema([("table_name", pa.string()), ("row_id", pa.int64()), ("h", pa.int64()), ("pos", pa.int32()), ("piece", pa.string()), ("plain", pa.string()), ("bins", pa.list_(pa.string()))])


def spellings(words: DataFrame, tokens: DataFrame, budget: float = 0.0, most: int = BIN) -> DataFrame:
    """(piece, canon): canonical spelling of each distinct suspect token that a word of the corpus matches.

    words(word, n), tokens(piece, plain, bins), settled. Both are binned by their first letters, a token in every bin it may belong to, and
    each bin builds its own trie; so no trie holds the vocabulary of a whole corpus. A bin of many tokens is divided by their
    hash into parts of about ``most``, each with the bin's words.
    """

    def walk(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        trie, rows = Trie(zip(right.word, right.n)), []
        counts = dict(zip(right.word, right.n))
        for piece, plain in zip(left.piece, left.plain):
            if hit := trie.match(piece, budget):
                rows.append((piece, _cased(hit[0], plain), hit[1], int(counts[hit[0]]), hit[0]))
        return pd.DataFrame(rows, columns=["piece", "canon", "cost", "n", "word"]).astype({"piece": "str", "canon": "str", "cost": "float64", "n": "int64", "word": "str"})

    t = tokens.select("piece", "plain", F.explode("bins").alias("bin"))
    parts = t.groupBy("bin").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    t = t.join(parts, "bin").withColumn("part", F.pmod(F.xxhash64("piece"), F.col("parts")).cast("int"))
    w = words.select("word", "n", F.substring("word", 1, PREFIX).alias("bin")).join(parts.toDF("bin", "copies"), "bin").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    found = t.groupBy("bin", "part").cogroup(w.groupBy("bin", "part")).applyInPandas(walk, "piece string, canon string, cost double, n long, word string")
    return found.groupBy("piece").agg(F.min(F.struct("cost", (-F.col("n")).alias("n"), "word", "canon")).alias("best")).select("piece", "best.canon")


def rows_of(tables: list[tuple[str, DataFrame]], id_col: str = "row_id", text_col: str = "statement") -> DataFrame:
    out = None
    for name, df in tables:
        x = df.select(F.lit(name).alias("table_name"), F.col(id_col).cast("long").alias("row_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
        out = x if out is None else out.unionByName(x)
    return out


def changed(tables: list[tuple[str, DataFrame]], min_count: int = 2, budget: float = 0.0) -> DataFrame:
    """(table_name, row_id, h, text), h the hash of the text as it was: consistent form of every text that isn't in it already.

    Null texts are left out, empty ones are consistent. Rows of one id with different texts are rows of their own;
    rows that are equal in table, id and text are taken as one. The vocabulary is counted over
    all rows, combined before the shuffle; words seen fewer than ``min_count`` times are no canonical spelling.
    """
    from telarium.session import settle

    rows = rows_of(tables)
    maybe = rows.where(F.col("text").rlike(MAYBE))
    pieces = settle(maybe.select("table_name", "row_id", F.xxhash64("text").alias("h"), "text").mapInArrow(_pieces, "table_name string, row_id long, h long, pos int, piece string, plain string, bins array<string>"))
    words = rows.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    tokens = settle(pieces.where("bins IS NOT NULL").groupBy("piece", "plain").agg(F.any_value("bins").alias("bins")))
    canon = spellings(words, tokens, budget)
    return (
        pieces.where("bins IS NOT NULL").join(canon, "piece", "left").unionByName(pieces.where("bins IS NULL").withColumn("canon", F.lit(None).cast("string")))
        .withColumn("shown", F.coalesce("canon", "plain"))
        .groupBy("table_name", "row_id", "h")
        .agg(F.max(F.col("shown") != F.col("piece")).alias("odd"), F.array_sort(F.collect_set(F.struct("pos", "shown"))).alias("parts"))
        .where("odd")
        .select("table_name", "row_id", "h", F.array_join(F.transform("parts", lambda p: p["shown"]), "").alias("text"))
    )


def normalized(tables: list[tuple[str, DataFrame]], min_count: int = 2) -> DataFrame:
    """(table_name, row_id, statement): every text in its consistent form; null stays null."""
    fixed = changed(tables, min_count).withColumnRenamed("text", "fixed")
    every = None
    for name, df in tables:
        x = df.select(F.lit(name).alias("table_name"), F.col("row_id").cast("long").alias("row_id"), F.col("statement"))
        every = x if every is None else every.unionByName(x)
    return every.withColumn("h", F.xxhash64("statement")).join(fixed, ["table_name", "row_id", "h"], "left").select("table_name", "row_id", F.coalesce("fixed", "statement").alias("statement"))
