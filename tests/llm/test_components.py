"""Components: right for any edges, and no more rounds than the edges need."""

import random

from airledger.llm import components as stars_module
from airledger.llm import op3_minhash_dedup as near
from airledger.llm.components import components
from airledger.session import Staging


def least_of(edges):
    least = {}

    def top(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((top(a), top(b)))
            least[high] = low
    return {x: top(x) for x in list(least)}


def written(monkeypatch):
    names, put = [], Staging.put

    def counted(self, df, name):
        names.append(name)
        return put(self, df, name)

    monkeypatch.setattr(stars_module.Staging, "put", counted)
    return names


def test_components_of_any_edges(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(40)]
    rng.shuffle(chain)
    ring = [(100 + i, 100 + (i + 1) % 7) for i in range(7)]
    loose = [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges = chain + ring + loose + loose[:9] + [(b, a) for a, b in ring] + [(500, 500), (-3, 0)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.component for r in components(frame).collect()} == least_of(edges)
    assert components(frame.where("a = b")).isEmpty()


def test_stars_need_no_round(spark, monkeypatch):
    """Edges that are stars already are written once and not gone over to see that nothing moves."""
    names = written(monkeypatch)
    edges = [(9, 1), (1, 8), (7, 1), (3, 2), (7, 1)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.component for r in components(frame).collect()} == least_of(edges)
    assert names == ["0"]


def test_links_are_followed_once(spark, monkeypatch):
    """A round hands on the links between components it has found, not those of earlier rounds."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    for group in range(12):
        text = rng.sample(words, 90)
        for copy in range(9):
            text = text[:]
            text[rng.randrange(90)] = f"x{group}_{copy}"
            texts.append(" ".join(text))
    rng.shuffle(texts)
    moved = []

    def stars(edges):
        found = stars_module.stars(edges)
        moved.extend(r.node for r in found.collect())
        return found

    monkeypatch.setattr(near, "stars", stars)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    sets = [
        {tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (text.split() for text in texts)
    ]
    links = [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if 100 * len(a & b) >= 75 * len(a | b)
    ]
    least = least_of(links)
    assert found == {i: least.get(i, i) for i in range(len(texts))}
    assert len(moved) == len(set(moved)) == len(texts) - len(set(found.values()))
