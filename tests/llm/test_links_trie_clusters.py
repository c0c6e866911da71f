"""SimHash links, the prefix trie and centroid clustering against brute force, odd rows included."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from airledger.llm import op11_simhash_dedup as simhash
from airledger.llm import op12_prefix_trie as trie
from airledger.llm import op13_centroid_clustering as clusters
from airledger.llm.lookup import looked_up

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def bits_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if words and not shingles:
        shingles = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Least member of each fingerprint's component, by comparing all."""
    prints = sorted(set(prints))
    least = {p: p for p in prints}
    again = True
    while again:
        again = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 2 and least[b] < least[a]:
                    least[a], again = least[b], True
    return least


def prose(rng, count):
    return " ".join(f"w{rng.randrange(400)}" for _ in range(count))


def test_places_left_out_cover_all_pairs():
    left = {frozenset(p) for s in simhash._FREE for p in simhash.combinations(s, 2)}
    assert len(left) == 28 and all(len(s) == 3 for s in simhash._FREE)


def test_fingerprints(spark):
    rng = random.Random(3)
    texts = [
        None, "", " \t\n", "one", "One two", "a b c", "A b\x0bC d", "Ünï é " * 5, "x" * 20_000,
        "same " * 9_000, prose(rng, 30_000), "\x1cnot a space\x85 here",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = simhash.fingerprints(docs).collect()
    assert {r.doc_id: r.simhash % 2**64 for r in found} == dict(
        enumerate(map(bits_of, texts))
    )
    assert [r.text for r in sorted(found, key=lambda r: r.doc_id)] == texts


@pytest.mark.parametrize("long_list", [1, 64])
def test_components_of_fingerprints(spark, monkeypatch, long_list):
    """Clouds of close fingerprints, paired off or through flipped bits."""
    monkeypatch.setattr(simhash, "LONG_LIST", long_list)
    rng = random.Random(5)
    prints = [0, 3, 1 << 63, 2**64 - 1]
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(8):
            near = centre
            for bit in rng.sample(range(64), rng.randrange(5)):
                near ^= 1 << bit
            prints.append(near)
    prints += prints[:20]
    rows = [(100 - i, simhash._signed(p)) for i, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id bigint, simhash bigint")
    least = groups(prints)
    first = defaultdict(lambda: 1000)
    for doc_id, p in zip((r[0] for r in rows), prints):
        first[least[p]] = min(first[least[p]], doc_id)
    want = sorted((d, f"{p:016x}", first[least[p]]) for (d, _), p in zip(rows, prints))
    found = simhash.near_copies(df).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, found.collect())) == want


def test_near_copies_odd_rows(spark):
    rng = random.Random(7)
    base = prose(rng, 4_000).split()
    near = [*base[:2000], "changed", *base[2000:]]
    rows = [
        (9, " ".join(base), "x", "y"), (4, " ".join(near), "x", None), (4, " ".join(base), "x", "z"),
        (None, " ".join(base), None, "n"), (5, None, "e", "e"), (7, "", "e", "e"),
        (8, prose(rng, 300), "own", "own"), (None, prose(rng, 200), "alone", "alone"),
    ]
    names = "doc_id bigint, text string, fingerprint string, held string"
    docs = spark.createDataFrame(rows, names)
    found = simhash.near_copies(simhash.fingerprints(docs))
    assert found.columns == ["doc_id", "text", "held", "fingerprint", "component_id"]
    near_enough = (bits_of(rows[0][1]) ^ bits_of(rows[1][1])).bit_count() <= 2
    assert near_enough
    ids = {"y": 4, None: 4, "z": 4, "n": 4, "e": 5, "own": 8, "alone": None}
    got = found.collect()
    assert len(got) == len(rows)
    assert all(r.component_id == ids[r.held] for r in got)
    assert all(r.fingerprint == f"{bits_of(r.text):016x}" for r in got)
    assert simhash.near_copies(simhash.fingerprints(docs.limit(0))).count() == 0


def test_lookup_of_heavy_and_light_keys(spark, monkeypatch):
    from airledger.llm import lookup

    monkeypatch.setattr(lookup, "HEAVY_KEYS", 4)
    keys = [1] * 50 + [2] * 20 + list(range(3, 20))
    rows = spark.createDataFrame(list(enumerate(keys)), "n int, key int")
    labels = rows.groupBy("key").count().selectExpr("key", "count AS held", "key * 2 AS twice")
    found = looked_up(rows, labels, "key")
    assert sorted((r.n, r.twice) for r in found.collect()) == [(i, 2 * k) for i, k in enumerate(keys)]


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))

    def order(t):
        return (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest())

    for turns in own.values():
        turns.sort(key=order)
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        rebuilt[c] = tuple(t[1:] for t in own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    nodes = []
    for key, convs in members.items():
        under = [k for k in members if k[: len(key)] == key]
        children = [k for k in under if len(k) == len(key) + 1]
        leaves = [k for k in under if not any(o[:-1] == k for o in under if len(o) == len(k) + 1)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in under if k)
        ends = sorted(c for c in convs if rebuilt[c] == key)
        nodes.append(
            (
                min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs),
                len(children), len(leaves), saved,
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(nodes, key=str)


def conversations():
    rng = random.Random(11)
    rows = [
        (50, None, "user", "first"), (50, 2, None, "b"), (50, 2, "user", None), (50, 2, "user", None),
        (51, 0, "user", "é一"), (None, 0, "user", "lost"), (-3, 1, "a", "b"), (-5, 0, "a", "c"),
        (0, 0, "a", "c"), (2, 0, "", ""), (9_000_000_000, 0, "user", "big"),
    ]
    for c in range(100, 160):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, "user", rng.choice("pq")))
    rows += [(c, t, "user", f"copy {t}") for c in range(200, 300, 5) for t in range(4)]
    rows += [(400, t, "user", "long " * (t % 3)) for t in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("crowd", [1, 5, 64])
def test_prefix_trie(spark, monkeypatch, crowd):
    monkeypatch.setattr(trie, "CROWD", crowd)
    monkeypatch.setattr(trie, "PIECE", 9)
    rows = conversations()
    schema = "conv_id bigint, turn bigint, role string, text string, key string, depth string"
    df = spark.createDataFrame([(*r, "k", None) for r in rows], schema)
    found = trie.prefix_trie(df)
    assert found.columns == trie.NODE_COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == brute_trie(rows)


def test_prefix_trie_of_nothing(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0


def brute_clusters(vectors):
    """vectors: (vec_id, whole)."""
    def rank(v):
        return (v[0] is None, hashlib.sha256(f"1:{v[0]}".encode()).hexdigest(), v[1])

    centroids = [list(v) for _, v in sorted(vectors, key=rank)[:16]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(3):
        members = defaultdict(list)
        for _, v in vectors:
            members[nearest(v)[1]].append(v)
        for j, vs in members.items():
            centroids[j] = [sum(column) // len(vs) for column in zip(*vs)]
    found = [(i, *nearest(v)) for i, v in vectors]
    by = defaultdict(int)
    for _, d, j in found:
        by[j] += d
    return sorted(
        (
            (i, j, d, by[j], sum(by.values()),
             hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
            for i, d, j in found
        ),
        key=str,
    )


def test_bounds_spare_distances_and_lose_none():
    rng = np.random.default_rng(2)
    middles = rng.integers(-900, 900, (16, 64))
    vectors = middles[rng.integers(0, 16, 3000)] + rng.integers(-60, 60, (3000, 64))
    history, known, evaluated = [vectors[:16].copy()], (), []
    for _ in range(5):
        *known, spent = clusters.assign(vectors, history, *known)
        exact = np.stack([((vectors - c) ** 2).sum(axis=1) for c in history[-1]], axis=1)
        assert (known[0] == exact.argmin(axis=1)).all()
        evaluated.append(spent)
        after = history[-1].copy()
        for j in set(known[0]):
            after[j] = vectors[known[0] == j].sum(axis=0) // (known[0] == j).sum()
        history.append(after)
    assert evaluated[0] == 16 * 3000 and evaluated[-1] < 3000


def test_clusters(spark):
    rng = random.Random(13)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(150)]
    vectors += [(3, vectors[3][1]), (3, vectors[4][1]), (None, vectors[5][1])]
    vectors += [(200 + i, [float(i)] * 64) for i in range(3)]
    odd = [
        (900, None), (901, [1.0] * 63), (902, [1.0] * 65), (903, [1.0] * 63 + [None]),
        (904, [math.nan] + [1.0] * 63), (905, [math.inf] + [1.0] * 63), (906, []),
    ]
    schema = "vec_id bigint, embedding array<double>, cluster string, bounds string, since int"
    df = spark.createDataFrame([(i, v, "c", "b", 1) for i, v in vectors + odd], schema)
    found = clusters.clustered(clusters.whole_vectors(df))
    assert found.columns == ["vec_id", "bounds", "since", "whole", *clusters._RESULTS]
    want = brute_clusters([(i, [math.floor(64 * x) for x in v]) for i, v in vectors])
    got = found.select("vec_id", *clusters._RESULTS).collect()
    assert sorted(map(tuple, got), key=str) == want


def test_fewer_vectors_than_clusters_and_none(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = [(i, [float(i % 2)] * 64) for i in range(3)]
    df = spark.createDataFrame(few, schema)
    got = clusters.clustered(clusters.whole_vectors(df)).select("vec_id", *clusters._RESULTS)
    want = brute_clusters([(i, [math.floor(64 * x) for x in v]) for i, v in few])
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert clusters.clustered(clusters.whole_vectors(df.limit(0))).count() == 0


def test_too_large_components_fail(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="component too large"):
        clusters.clustered(clusters.whole_vectors(df))
