"""Prefix trie, vector codes and SimHash against brute force, with awkward rows and small limits."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyard.llm import codes, simhash, trie

TURNS = "conv_id long, turn long, role string, text string"


# ---- prefix trie ------------------------------------------------------------------------------------------------


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = sorted(own.get(c - int(math.fmod(c, 100)), []))
        built[c] = [t[3:] for t in base[:h] + sorted(own[c])[h:]]
    members, enders = defaultdict(set), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        enders[tuple(turns)].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(enders[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def nodes(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def talks(seed, n, words="ab", most=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 420), n):
        shared = rng.random() < 0.4
        for k in range(rng.randint(0 if c % 7 else 1, most)):
            rows.append((c, rng.choice([k, k, None]) if c % 11 == 0 else k, rng.choice(["user", None]), "same start" if shared and k < 4 else rng.choice(words) * rng.randint(0, 2)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("container", "many"), [(1, 2), (3, 10), (1000, 10_000)])
def test_trie(spark, container, many):
    rows = talks(1, 120) + [(7, 3, "user", "é" * 50_000), (None, 0, "user", "no id"), (900, None, None, None), (900, None, None, None)]
    df = spark.createDataFrame(rows, TURNS).withColumns({"head": F.lit(1), "key": F.lit("x"), "depth": F.lit("y")})
    assert nodes(trie.prefix_trie(df, container, many)) == brute_trie(rows)


def test_trie_of_copies_and_long_conversations(spark):
    rows = [(c, k, "user", "hello" if k < 40 else str(c % 5)) for c in range(0, 60) for k in range(45)]
    assert nodes(trie.prefix_trie(spark.createDataFrame(rows, TURNS), 2, 5)) == brute_trie(rows)


def test_trie_of_turnless_conversations_and_empty_tables(spark):
    lost = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 2)  # its base isn't there
    rows = [(lost, 0, "user", "a"), (lost, 1, "user", "b")]
    got = nodes(trie.prefix_trie(spark.createDataFrame(rows, TURNS)))
    assert got == brute_trie(rows) == [(lost, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())]
    assert not trie.prefix_trie(spark.createDataFrame([], TURNS)).collect()
    assert not trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "a")], TURNS)).collect()


# ---- vector codes -----------------------------------------------------------------------------------------------


def brute_codes(rows, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1])
    pad = -width % 16
    kept = [(i, v + [0] * pad, label) for i, v, label in kept]
    size = (width + pad) // 16
    part = lambda v, p: v[p * size : (p + 1) * size]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:64]
    books = [[part(v, p) for _, v, _ in first] for p in range(16)]
    pick = lambda v, p: min((far(part(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v, _ in kept:
            for p in range(16):
                groups[p, pick(v, p)[1]].append(part(v, p))
        for (p, k), parts in groups.items():
            books[p][k] = [sum(c) // len(parts) for c in zip(*parts, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, "".join(f"{pick(v, p)[1]:02x}" for p in range(16)), sum(pick(v, p)[0] for p in range(16)), label) for i, v, label in kept]
    total = Counter()
    for _, _, e, label in out:
        total[label] += e
    return [(i, c, e, total[label], sha) for i, c, e, label in out]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("width", [32, 48, 20, 0])
def test_codes(spark, width):
    rng = np.random.default_rng(width)
    rows = [(int(i), rng.normal(0, 0.1, width).astype(np.float32).tolist(), [None, 1, 2][i % 3]) for i in rng.permutation(150)]
    rows += [(500 + k, rows[k][1], 1) for k in range(20)]  # copies
    rows += [(0, rows[3][1], 2), (None, rows[5][1], 3)]
    if width:
        bad = lambda x: [x, *rows[0][1][1:]]
        rows += [(1, None, 1), (2, bad(None), 1), (3, bad(math.nan), 1), (4, bad(math.inf), 1), (5, [0.0] * width, 1), (6, bad(1000.0), 1), (7, bad(-1000.0), 1)]
    got = codes.compress(vectors(spark, rows).withColumns({"v": F.lit("x"), "same": F.lit(1)}))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, brute_codes(rows)))


def test_codes_of_each_length_and_few_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(0, 1, 16 if k % 3 else 32).astype(np.float32).tolist(), None) for k in range(90)]
    got = {r.vec_id: r for r in codes.compress(vectors(spark, rows)).collect()}
    for width in (16, 32):
        mine = brute_codes([r for r in rows if len(r[1]) == width])
        assert [(i, got[i].code, got[i].error, got[i].codebooks_sha256) for i, *_ in mine] == [(i, c, e, s) for i, c, e, _, s in mine]
    assert {r.label_error for r in got.values()} == {sum(r.error for r in got.values())}
    few = [(9, [1.0] * 16, 1), (10, [1.0] * 16, None)]
    assert sorted(map(tuple, codes.compress(vectors(spark, few)).collect())) == sorted(brute_codes(few))
    assert not codes.compress(vectors(spark, [])).collect() and not codes.compress(vectors(spark, [(1, None, 1)])).collect()


def test_nearest_entry_for_any_radius():
    rng = np.random.default_rng(0)
    for n, d in ((1, 3), (2, 1), (64, 4), (63, 9), (64, 2)):
        book = rng.integers(-20, 20, (n, d))
        parts = np.concatenate([rng.integers(-25, 25, (500, d)), rng.integers(-100_000, 100_000, (50, d)), book])
        slices = codes.Slices(book)
        far = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
        for radius in (0, 1, 50, slices.radius):
            slices.radius = max(1, radius)
            code, best = slices.nearest(parts)
            assert (code == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
        inside = (np.abs(parts[:, None] - book[None]).max(axis=2) <= 7).astype(np.uint64)
        assert (slices.within(parts, np.full(len(parts), 7)) == (inside << np.arange(n, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)).all()


# ---- simhash ----------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys([9, 10, 11, 12, 13], " ")).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=2):
    ids = sorted(fps)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in ids}


def test_simhash(spark):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("abcÄéX") for _ in range(rng.randint(1, 14))) for _ in range(n))
    long = text(300)
    rows = [long, None, "", " \t", "one", "Two WORDS", "two  words", text(4000), "x" * 100_000]
    rows += [text(rng.choice([2, 3, 4, 50])) for _ in range(40)]
    for _ in range(60):
        words = long.split()
        words[rng.randrange(300)] = text(1)
        rows.append("\n".join(words))
    rows += [long] * 5
    docs = [(i, t) for i, t in enumerate(rows)]
    df = spark.createDataFrame([*docs, (None, long), (3, "~ the larger text of an id")], "doc_id long, text string").withColumns({"fp": F.lit(1), "mask": F.lit("x"), "a": F.lit(2)})
    docs[3] = (3, " \t")
    fps = {i: brute_fingerprint(t) for i, t in docs}
    for bucket in (1024, 4):
        got = {r.doc_id: r for r in simhash.near_components(df, bucket=bucket).collect()}
        assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps and all(len(r.fingerprint) == 16 for r in got.values())
        assert {i: r.component_id for i, r in got.items()} == brute_components(fps)
    assert not simhash.near_components(df.limit(0)).collect()


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_sliced_pairs(radius):
    rng = random.Random(radius)
    for mask in (0, (1 << 21) - 1, (1 << 64) - 1 - 0xFFFFF):
        fixed = rng.getrandbits(64)
        fps, bucket = [], []
        for b, size in enumerate([1, 2, 63, 64, 65, 200]):
            near = rng.getrandbits(64)
            for _ in range(size):
                x = near if rng.random() < 0.7 else rng.getrandbits(64)
                for _ in range(rng.randint(0, 5)):
                    x ^= 1 << rng.randrange(64)
                fps.append((x & ~mask) | (fixed & mask))
                bucket.append(b)
        want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if bucket[i] == bucket[j] and bin(fps[i] ^ fps[j]).count("1") <= radius}
        got = [p for i, j in simhash.near_pairs(np.array(fps, np.uint64), np.array(bucket), mask, radius) for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_blocks_cover_all_bits():
    seen = [0]
    for _ in range(12):
        seen = [x for m in seen for x in simhash.masks_below(m, 2)][:50]
    assert simhash.masks_below(0, 2)[0] | simhash.masks_below(0, 2)[1] | simhash.masks_below(0, 2)[2] == (1 << 64) - 1
    assert not simhash.masks_below((1 << 64) - 1, 2)


def test_fingerprints_of_a_slice_boundary(monkeypatch):
    texts = ["a b c d e f", "", None, "a", "A  b\tc d"]
    for size in (1, 2, 1000):
        monkeypatch.setattr(simhash, "HASHES", size)
        assert simhash.fingerprints_of(pa.array(texts)).tolist() == [brute_fingerprint(t) for t in texts]
