import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import simhash
from tests.llm.data import documents, empty, texts

SPACES = " \t\n\x0b\x0c\r"


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps, radius=4):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints():
    for t in [*texts(50), "A b C", "É é x y z", "a\x1cb c\x85d e\xa0f g h", "one two three four five " * 9000]:
        assert simhash.fingerprint((t or "").encode()) == brute_fingerprint(t)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clouds(seed, n=400):
    """Random fingerprints, chains of neighbours and dense clouds."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        x = rng.choice(out)
        for b in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << b
        out.append(x)
    centre = rng.getrandbits(64)
    out += [centre ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)]
    return sorted(set(out))


@pytest.mark.parametrize("radius,blocks", [(4, 4), (4, 3), (4, 2), (4, 1), (4, 5), (0, 1), (7, 3)])
def test_radii(radius, blocks):
    assert sum(r + 1 for r in simhash.radii(radius, blocks)) == radius + 1
    m = simhash.masks(blocks)
    assert sum(m) == (1 << 64) - 1 and len(m) == blocks


def test_visits_lose_no_neighbour():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2)
    for mask, radius in ((simhash.masks(4)[0], 0), (simhash.masks(4)[3], 1), ((1 << 64) - 1, 4)):
        tree = simhash.grow(fps, mask, 5, rng)
        row, leaf, home = simhash.visits(tree, mask, radius, fps)
        homes = dict(zip(row[home].tolist(), leaf[home].tolist(), strict=True))
        assert len(homes) == len(fps) and home.sum() == len(fps)
        seen = set(zip(row.tolist(), leaf.tolist(), strict=True))
        for i in range(0, len(fps), 7):
            for j in np.flatnonzero(np.bitwise_count((fps ^ fps[i]) & np.uint64(mask)) <= radius):
                assert (i, homes[int(j)]) in seen


@pytest.mark.parametrize("seed,blocks,shard_rows,task_rows", [(1, 4, 2048, 32768), (2, 4, 8, 32768), (3, 3, 8, 40), (4, 2, 16, 30), (5, 1, 16, 64)])
def test_components_by_brute_force(spark, seed, blocks, shard_rows, task_rows):
    fps = clouds(seed)
    want = brute_roots(fps)
    nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp long").repartition(3)
    edges = simhash.links(nodes, len(fps), 4, blocks, shard_rows, task_rows)
    assert edges.count() <= blocks * len(fps) * (1 if task_rows == 32768 else 50)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    groups = {}
    for x, w in zip(fps, want, strict=True):
        groups.setdefault(w, set()).add(roots.get(signed(x), signed(x)))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_near_groups(spark):
    rng = random.Random(3)
    rows, docs = documents(spark, 60)
    long = [" ".join(rng.choice(["w%d" % i for i in range(2000)]) for _ in range(800)) for _ in range(5)]
    more = [(100 + i, t if i < 5 else t.replace(t.split()[i], "changed", 1)) for i, t in enumerate(long * 3)]
    rows = [r[:2] for r in rows] + more
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = Counter(tuple(r) for r in simhash.near_groups(docs).collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_roots(fps)
    least = {}
    for (doc_id, _), r in zip(rows, roots, strict=True):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    assert got == Counter((d, f"{f:016x}", least.get(r)) for (d, _), f, r in zip(rows, fps, roots, strict=True))
    assert simhash.near_groups(empty(spark)).collect() == []


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def brute_wide(text):
    words = (text or "").encode().lower().split()
    if not words:
        return bytes(8 * simhash.WIDE_WORDS)
    hashes = {int.from_bytes(xxhash.xxh64_digest(b" ".join(words[i : i + 5]), 42), "little") for i in range(max(1, len(words) - 4))}
    cut, out = (1 << 64) - 1, b""
    for i in range(simhash.WIDE_WORDS):
        spread = []
        for h in hashes:
            x = (h ^ int(simhash.MIX[i])) * int(simhash.MIX[0]) & cut
            x = (x ^ x >> 32) * int(simhash.MIX[1]) & cut
            spread.append(x ^ x >> 29)
        out += sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in spread) > len(spread)).to_bytes(8, "little")
    return out


def test_wide_fingerprints():
    rng = random.Random(2)
    for t in [*texts(40), "a b c", " ".join(str(rng.random()) for _ in range(1500))]:
        assert simhash.wide_fingerprint(simhash.shingle_hashes((t or "").encode())) == brute_wide(t)


def edited(rng, text, share):
    words = text.split()
    for i in rng.sample(range(len(words)), max(1, round(share * len(words)))):
        words[i] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("seed,task_rows", [(1, 32_768), (2, 60)])
def test_near_copies_by_jaccard(spark, seed, task_rows):
    """Components are those of all pairs at 0.8 or more."""
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([60, 150, 500]))) for _ in range(60)]
    rows = list(enumerate(base + [edited(rng, t, 0.012) for t in base[:40]] + [edited(rng, t, 0.15) for t in base[40:]] + base[:5]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = simhash.wide_fingerprints(docs.withColumn("key", simhash.text_key(F.col("text").cast("binary"))), ["doc_id", "key"])
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min_by("key", "doc_id").alias("key"), F.first("wide").alias("wide"))
    edges = simhash.confirmed(docs, nodes, simhash.wide_links(nodes, 105, shard_rows=16, task_rows=task_rows), 0.8, 1024 if task_rows > 1024 else 2)
    got = {r["fp"]: r["component_id"] for r in simhash.grouped(nodes.select("fp", "first"), edges).collect()}
    component = {r["doc_id"]: got[r["fp"]] for r in marked.collect()}
    want = list(range(len(rows)))
    for i, a in rows:
        for j, b in rows[:i]:
            if jaccard(a, b) >= 0.8:
                want = [want[j] if w == want[i] else w for w in want]
    assert [component[i] for i, _ in rows] == [min(j for j in range(len(rows)) if want[j] == w) for w in want]
    assert len(set(want)) == 80


def test_family_of_copies_takes_few_trials(monkeypatch):
    rng = random.Random(3)
    text = " ".join(f"w{i}" for i in range(400))
    copies = [edited(rng, text, 0.004).encode() for _ in range(300)]
    tried = []
    monkeypatch.setattr(simhash, "jaccard", lambda *sets, real=simhash.jaccard: tried.append(1) or real(*sets))
    sets = [simhash.shingle_hashes(c) for c in copies]
    wide = np.frombuffer(b"".join(map(simhash.wide_fingerprint, sets)), np.uint64).reshape(-1, simhash.WIDE_WORDS)
    assert (simhash.alike(wide, sets, simhash.wide_radius(0.8), 0.8) == 0).all() and len(tried) < 600


def test_one_each(spark):
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(300)) for _ in range(30)]
    rows = list(enumerate(base + [edited(rng, t, 0.01) for t in base[:20]] + base[10:15]))
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows + rows[25:27]], "doc_id long, text string, fp int, wide string")
    kept = simhash.one_each(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(30))
    nulls = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "x y z")], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.one_each(nulls).collect()) == ["a b c", "x y z"]
    assert simhash.one_each(empty(spark)).collect() == []


def test_lower_similarities_lose_no_pair(spark):
    shared, rest = [f"w{i}" for i in range(104)], [[f"{c}{i}" for i in range(60)] for c in "xyz"]
    a, b, c = " ".join(shared[:49]), " ".join(shared[:49] + rest[0][:54]), " ".join(rest[1])
    assert 0.4 < jaccard(a, b) < 0.5 and simhash.jaccard(*(simhash.shingle_hashes(t.encode()) for t in (a, b)), 0.4) == jaccard(a, b)
    kept = simhash.one_each(spark.createDataFrame([(1, a), (2, b), (3, c)], "doc_id long, text string"), similarity=0.4)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_many_null_ids_meet_only_their_own_texts(spark):
    rows = [(None, f"text number {i % 50} of all") for i in range(200)]
    assert simhash.one_each(spark.createDataFrame(rows, "doc_id long, text string")).count() == 50


def test_large_components_by_size(spark):
    rng = random.Random(9)
    base = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame(list(enumerate([base, *(edited(rng, base, 0.005) for _ in range(30))])), "doc_id long, text string").withColumn("key", simhash.text_key(F.col("text").cast("binary")))
    nodes = simhash.wide_fingerprints(docs, ["doc_id", "key"]).withColumnRenamed("doc_id", "first")
    edges = nodes.agg(F.min("fp").alias("b")).join(nodes.select(F.col("fp").alias("a"))).where("a <> b")
    got = simhash.grouped(nodes.select("fp", "first"), simhash.confirmed(docs, nodes, edges, 0.8, task_size=5000))
    assert {r["component_id"] for r in got.collect()} == {0}


@pytest.mark.parametrize("seed", [1, 2])
def test_one_each_keeps_no_near_copy_of_any_length(spark, seed):
    """Short texts and texts of unequal length, which wide fingerprints alone lose: all pairs at 0.8 or more are joined."""
    rng = random.Random(seed)
    rows = []
    for n in [8] * 60 + [12, 20, 40, 100, 300] * 6:
        text = [f"w{rng.randint(0, 5000)}" for _ in range(n)]
        more = max(1, (n - 4) // 4)
        rows += [text, text + [f"x{rng.randint(0, 5000)}" for _ in range(more)], text + [f"y{rng.randint(0, 5000)}" for _ in range(more + 1)]]
    line = [f"c{i}" for i in range(30)]
    rows += [line + [f"z{rng.randint(0, 5000)}" for _ in range(rng.choice([5, 9, 40]))] for _ in range(60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(rows)]
    want = list(range(len(rows)))
    for i, a in rows:
        for j, b in rows[:i]:
            if want[i] != want[j] and jaccard(a, b) >= 0.8:
                want = [want[j] if w == want[i] else w for w in want]
    first = {w: min(j for j in range(len(rows)) if want[j] == w) for w in set(want)}
    kept = simhash.one_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values())


def test_rarest_shingles_meet():
    rng = np.random.default_rng(4)
    for _ in range(2000):
        n, more, less = rng.integers(1, 60), rng.integers(0, 12), rng.integers(0, 12)
        a = np.unique(rng.integers(0, 1 << 63, n + more, np.uint64))
        b = np.unique(np.concatenate([a[: len(a) - min(less, len(a) - 1)], rng.integers(0, 1 << 63, less, np.uint64)]))
        common = np.sort(rng.choice(a, len(a) // 2, replace=False)), rng.integers(1, 9, len(a) // 2)
        if simhash.jaccard(a, b) >= 0.8:
            assert set(simhash.rarest(a, 0.8, common)) & set(simhash.rarest(b, 0.8, common))


def test_parities_differ_no_more_than_the_sets():
    rng = np.random.default_rng(6)
    for n, other in ((5, 5), (300, 40), (3000, 900), (0, 3)):
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        b = np.unique(np.concatenate([a[: len(a) // 2], rng.integers(0, 1 << 63, other, np.uint64)]))
        bits = [int.from_bytes(simhash.parities(x)) for x in (a, b)]
        assert (bits[0] ^ bits[1]).bit_count() <= len(np.setxor1d(a, b)) and len(simhash.parities(a)) == 8 * simhash.PARITY_WORDS
        assert simhash.parities(a) == simhash.parities(a[::-1])


def test_a_family_with_members_on_both_sides_of_the_similarity(spark):
    """Copies of one text with so many edits that pairs lie around 0.8: the components are those of exact counts."""
    rng = random.Random(12)
    text = " ".join(f"w{i}" for i in range(120))
    rows = list(enumerate(edited(rng, text, share) for share in [0.008, 0.016, 0.025, 0.033] * 15))
    want = list(range(len(rows)))
    for i, a in rows:
        for j, b in rows[:i]:
            if want[i] != want[j] and jaccard(a, b) >= 0.8:
                want = [want[j] if w == want[i] else w for w in want]
    assert 1 < len(set(want)) < len(rows)
    kept = simhash.one_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(min(j for j in range(len(rows)) if want[j] == w) for w in set(want))
