import random

import numpy as np
from telarium.llm import neardup as N


def brute(rows, t=0.7):
    from telarium.llm.copies import letters  # noqa: F401
    import re

    canon = lambda s: re.sub(r"[\W_]+", "", s.lower())
    keep = [(i, canon(s), set(N.words(s).split())) for i, s in rows if s and any(c.isalpha() for c in s)]
    out = set()
    for x in range(len(keep)):
        for y in range(x + 1, len(keep)):
            (i, c, a), (j, k, b) = keep[x], keep[y]
            if c != k and i != j and len(a & b) >= t * len(a | b) - 1e-9:
                out.add((min(i, j), max(i, j)))
    return out


def sample(n, seed, vocab=120):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(vocab)]
    rows = []
    while len(rows) < n:
        base = [r.choice(words) for _ in range(r.randint(1, 30))]
        for _ in range(r.randint(1, 5)):
            v = list(base)
            for _ in range(r.randint(0, 4)):
                k = r.randrange(len(v))
                v[k:k + 1] = r.choice([[], [r.choice(words)], [v[k], r.choice(words)]])
                v = v or ["w0"]
            if r.random() < 0.2:
                r.shuffle(v)
            rows.append((len(rows), " ".join(v).upper() if r.random() < 0.2 else " ".join(v)))
    return rows


def run(spark, rows, **kw):
    pairs, dup = N.similar(spark.createDataFrame(rows, "row_id long, statement string"), **kw)
    return sorted(map(tuple, N.expand(pairs, dup).collect()))


def test_against_brute_force_with_long_and_short_keys(spark):
    rows = sample(700, 1)
    want = sorted(brute(rows))
    assert run(spark, rows) == want
    assert run(spark, rows, bucket=8) == want  # almost every word is common, so keys take several words


def test_words():
    assert N.words("Él  medirá—el AGUA, m²; él") == " ".join(sorted({"el", "medira", "agua", "m²"}))
    assert N.words("раra ｅｌ") == "el para" and N.words("...") == ""


def test_sketch_distance_never_exceeds_the_difference():
    r = np.random.default_rng(3)
    for w in (1, 4):
        s = (r.integers(0, 1 << 63, (500, w), dtype=np.int64) & r.integers(0, 1 << 63, (500, w), dtype=np.int64)).astype(np.uint64)
        planes = N._planes(s)
        for radius in (0, 5, 13 * w, 20 * w, 64 * w - 1, 64 * w):
            hit = N._within(planes, s[:40], radius)
            bits = np.unpackbits(hit.view(np.uint8), axis=1, bitorder="little")[:, :500].astype(bool)
            assert (bits == (np.bitwise_count(s[:40, None] ^ s[None, :]).sum(2, dtype=int) <= radius)).all()


def sketched(sets):
    """Hashes of sets as compare() takes them."""
    n = np.array([len(x) for x in sets])
    out = []
    for x in sets:
        wide, sketch = N.width(len(x)), 0
        for h in x:
            sketch |= 1 << (h >> (65 - wide.bit_length()))
        out.append(sketch.to_bytes(wide // 8, "little"))
    return np.arange(len(sets)), N.sketches(out), n


def test_sketches_of_unrelated_sets_stay_apart():
    """Few pairs of unrelated sets are left, however long they are; all similar ones are, across widths too."""
    r = random.Random(4)
    for size in (10, 30, 80, 120, 200, 700):
        sets = [{r.getrandbits(64) for _ in range(size)} for _ in range(400)]
        a, _ = N.compare(*sketched(sets), 0.7)
        assert len(a) < 0.05 * 400 * 399 / 2, size
    sets = []
    for size in (38, 42, 150, 170, 600, 700):
        base = [r.getrandbits(64) for _ in range(size)]
        sets += [set(base), set(base[: int(size * 0.9)]), set(base) | {r.getrandbits(64) for _ in range(size // 6)}]
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(sets[i] & sets[j]) >= 0.7 * len(sets[i] | sets[j])}
    args = sketched(sets)
    assert want and want <= set(zip(*N.compare(*args, 0.7)))
    half = [x[::2] for x in args], [x[1::2] for x in args]
    assert {(i, j) for i, j in want if i % 2 != j % 2} <= set(zip(*N.compare(*half[0], 0.7, half[1])))
    assert want <= set(zip(*N._small(np.zeros(len(sets), int), *args, 0.7)))


def test_long_and_short_texts_against_brute_force(spark):
    r = random.Random(6)
    rows = []
    for size in (38, 42, 90, 150, 170, 300):
        base = [f"v{r.randrange(4000)}" for _ in range(size)]
        for _ in range(5):
            rows.append((len(rows), " ".join(w for w in base if r.random() > 0.1) + f" x{r.randrange(9)}"))
    assert run(spark, rows) == sorted(brute(rows))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " .. "), (4, "Leer el cuento largo"), (5, "leer, el cuento largo"), (6, "Leer el cuento"), (6, "Leer el cuento"), (7, "uno"), (8, "Uno!"), (9, "Úno")]
    assert run(spark, rows) == sorted([(4, 6), (4, 6), (5, 6), (5, 6), (7, 9), (8, 9)])
    assert run(spark, []) == []
    assert run(spark, [(1, "a " * 10), (2, None)]) == []


def test_long_texts(spark):
    long = " ".join(f"p{i}" for i in range(6000))
    rows = [(1, long), (2, long + " fin"), (3, " ".join(f"q{i}" for i in range(6000)))]
    assert run(spark, rows) == [(1, 2)]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d", 5, "k"), (2, "a b c e", 6, "k"), (3, "a b c d e", 7, "k")], "row_id long, statement string, id int, k string")
    pairs, dup = N.similar(df)
    assert sorted(map(tuple, N.expand(pairs, dup).collect())) == [(1, 3), (2, 3)]


def test_big_buckets_are_compared_in_blocks(spark):
    rows = sample(300, 5, vocab=25)
    df = spark.createDataFrame([(i, N.words(s)) for i, s in rows], "id long, words string").dropDuplicates(["words"])
    keys = N.keyed(df, {}, df.count(), 0.7, 1 << 30).cache()
    whole = {tuple(r) for r in N.candidates(keys, 0.7).collect()}
    parts = {tuple(r) for r in N.candidates(keys, 0.7, split=30, block=10).collect()}
    assert whole == parts and whole
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    few = {tuple(r) for r in N.candidates(keys, 0.7, split=30, block=10, hold=20).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert few == whole


def test_keys_of_similar_sets_meet(monkeypatch):
    r = random.Random(9)
    monkeypatch.setattr(N, "LONG", 9)
    for _ in range(300):
        n = r.randint(1, 20)
        a = [(r.choice([0, 50, 500]), h) for h in r.sample(range(10**6), n)]
        b = [x for x in a if r.random() > 0.15] or a[:1]
        b += [(r.choice([0, 50, 500]), r.randrange(10**6, 2 * 10**6)) for _ in range(r.randint(0, 2))]
        if len(set(a) & set(b)) >= 0.7 * len(set(a) | set(b)):
            assert set(N.set_keys(sorted(a), 1000, 0.7, 20)) & set(N.set_keys(sorted(b), 1000, 0.7, 20))


def test_few_planes_tell_unrelated_sets_apart(monkeypatch):
    """Of 26 words, 4 may be missing: some more bits than these are looked at, in place of all 64 planes; no similar pair is lost."""
    r = random.Random(11)
    sets = [{r.getrandbits(64) for _ in range(26)} for _ in range(512)]
    sets += [set(sorted(x)[3:]) | {r.getrandbits(64)} for x in sets[:40]]
    puts, put = [], N._Sums.put
    monkeypatch.setattr(N._Sums, "put", lambda self, x: (puts.append(x.shape), put(self, x))[1])
    ids, s, n = sketched(sets)
    a, b = N.compare(ids, s, n, 0.7)
    assert {(i, 512 + i) for i in range(40)} <= set(zip(a.tolist(), b.tolist()))
    assert sum(q * w for q, w in puts) < 0.3 * 64 * len(sets) * -(-len(sets) // 64)


def test_texts_at_once_are_as_one_by_one(monkeypatch):
    r = random.Random(12)
    signs = [*"aÉñ \n_-ßΣςİº²ﬁаόǅ", "́", "​", "\xa0", "3", ". "]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 15))) for _ in range(3000)]
    texts += [x + chr(cp) + y for cp in (*range(0x600), *range(0x1E00, 0x2400), 0xAC00, 0x1D400, 0xE0041) for x, y in (("", ""), ("a", "b "), ("ό", " á"))]
    for most in (N.SIGNS, 40):
        monkeypatch.setattr(N, "SIGNS", most)
        canon, sets = N._forms(texts)
        assert canon == [N._canonical(t).encode() for t in texts]
        assert [" ".join(sorted(x.split())) for x in sets] == list(map(N.words, texts))
    assert N._forms([]) == ([], [])


def test_keys_at_once_are_as_one_by_one():
    import pyarrow as pa
    import xxhash

    r = random.Random(13)
    texts = [" ".join({f"w{int(r.paretovariate(0.4)) % 3000}" for _ in range(r.choice([1, 3, 12, 30, 70, 150]))}) for _ in range(400)]
    common = {xxhash.xxh3_64_intdigest(f"w{i}"): 400 // i for i in range(1, 12)}
    n, df, h = N.sorted_words(pa.array(texts), common)
    at, k = N.keys(n, df, h, 400, 0.7, 30)
    sketch = N.sketched(n, df, h, 150).to_pylist()
    for i, text in enumerate(texts):
        ws = sorted((common.get(x, 0), x) for x in map(xxhash.xxh3_64_intdigest, text.split()))
        assert sorted(k[at == i].tolist()) == sorted(N.set_keys(ws, 400, 0.7, 30)) and n[i] == len(ws)
        wide = N.width(len(ws))
        assert int.from_bytes(sketch[i], "little") == sum({1 << (x >> (65 - wide.bit_length())) for m, x in ws if m <= 150}) and len(sketch[i]) == wide // 8


def test_texts_without_a_word_make_no_pair(spark):
    assert run(spark, [(1, "ᅟ"), (2, "ᅟㅤ"), (3, "ᅟ uno dos"), (4, "uno, dos!")]) == [(3, 4)]


def test_sketches_of_few_bits_may_lack_them_all():
    """Words of every eighth set aren't in the sketch, so of 26 words 3 bits may be left, and 4 words may be missing."""
    s = np.array([[0b111 << 3 * (i % 20)] for i in range(40)], np.uint64)
    a, b = N.compare(np.arange(40), s, np.full(40, 26), 0.7)
    assert len(a) == 40 * 39 // 2
