import random

import numpy as np
import pytest
import xxhash

from gridlap.llm import common, components, simhash


def plain(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash.classes(docs).collect()
    fps = {r.fp & ((1 << 64) - 1) for r in got}
    roots = linked(fps)
    least = {}
    for d, t, _ in rows:
        if d is not None:
            r = roots[plain(t)]
            least[r] = min(d, least.get(r, d))
    want = sorted((d if d is not None else -1, plain(t), least.get(roots[plain(t)])) for d, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fp & ((1 << 64) - 1), r.component_id) for r in got) == want


@pytest.mark.parametrize("least_hot", [2, 256])
def test_against_brute_force(spark, monkeypatch, least_hot):
    monkeypatch.setattr(common, "LEAST_HOT", least_hot)  # 2: all that occur twice are hot
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40, 200]))]
        for _ in range(rng.choice([1, 1, 4])):
            copy = list(base)
            if len(copy) > 30 and rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy), 0))
    check(spark, [*rows, (7, rows[7][1], 0), (900, None, 0), (901, " \n", 0), (902, "É a B", 0), (None, "a b c d", 0), (903, "a\x1cb c", 0)])


def test_fingerprint_goes_over_blocks(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(500))
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text.encode()) == plain(text)


@pytest.mark.parametrize("least_hot", [20, 256])
def test_links_keep_every_neighbour_in_crowded_cells(spark, monkeypatch, least_hot):
    monkeypatch.setattr(common, "LEAST_HOT", least_hot)
    rng = random.Random(5)
    center = rng.getrandbits(64)
    fps = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(400)} | {rng.getrandbits(64) for _ in range(200)}
    points = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    roots = linked(fps)
    for cell_rows in (16, 4096):
        got = components.connected_components(simhash.links(points, cell_rows)).collect()
        mine = {r.node & ((1 << 64) - 1): r.root for r in got}
        groups = {}
        for f in fps:
            groups.setdefault(roots[f], set()).add(mine.get(f, simhash._signed(f)))
        assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_counts_never_exceed_hamming():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 2000, dtype=np.uint64), rng.integers(0, 2**63, 2000, dtype=np.uint64)
    near = b.copy()
    near[:1000] = a[:1000] ^ (np.uint64(1) << rng.integers(0, 64, 1000).astype(np.uint64))
    assert (np.bitwise_count(simhash._unary(a) ^ simhash._unary(near)) <= np.bitwise_count(a ^ near)).all()


def test_components_of_chains_cycles_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hubs_meet_their_minimum_where_they_lie(spark, monkeypatch):
    rng = random.Random(5)
    edges = [(7, i) for i in range(100, 900)] + [(i, i + 1) for i in range(2000, 2040)] + [(880, 2000), (3, 3), (5000, 5001)]
    edges += [(rng.randint(6000, 6100), rng.randint(6000, 6100)) for _ in range(300)]
    rng.shuffle(edges)
    root = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    for least in (4, 1 << 20):
        monkeypatch.setattr(components, "LEAST_ENDS", least)
        got = {r.node: r.root for r in components.connected_components(df).collect()}
        assert got == {x: find(x) for x in root}


def test_deduplication_keeps_one_each(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(5, text, "a"), (2, text, "b"), (9, "other words here", "c"), (None, text, "d"), (2, text, "b")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.source) for r in simhash.deduplicate(docs).collect()) == [(2, "b"), (9, "c")]  # null comes last in its class
    assert simhash.deduplicate(docs.where("false")).count() == 0


def test_rows_of_hot_keys_meet_what_is_known_of_them_where_they_lie(spark):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [2] * 30 + [3, 4, None])], "key long, i int")
    of = rows.groupBy("key").agg(common.F.count("*").alias("n"), common.F.max("i").alias("last")).where("key is null or key <> 4")
    want = sorted((k, i, last) for k, n, last in ((1, 50, 49), (2, 30, 79), (3, 1, 80)) for i in range(last - n + 1, last + 1))
    for least in (1, 40, 100):
        got = common.look_up(rows, of, "key", "n", least)
        assert got.columns == ["key", "i", "last"] and sorted(map(tuple, got.collect())) == want
    assert common.hot_from(10) == 256 and common.hot_from(1 << 20) == 1024
