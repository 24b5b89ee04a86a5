"""The genetic search itself: its operators, islands and what it gains over best fit."""

import random

import numpy as np
import pytest

from paylake.llm import dartminhash, ga_packing as ga


def triples(seed, bins, capacity=1000):
    """Pieces of bins that three of them fill exactly: the bound is their number."""
    rng, out = random.Random(seed), []
    for _ in range(bins):
        a = rng.randint(capacity // 4 + 1, capacity // 2 - 2)
        b = rng.randint(capacity // 4 + 1, capacity - a - capacity // 4)
        out += [a, b, capacity - a - b]
    rng.shuffle(out)
    return out


def best_fit(sizes, capacity):
    p = ga.Packing(sizes, capacity)
    p.best_fit(sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)))
    return p


def sound(p, sizes, capacity):
    placed = sorted(i for items in p.bins.values() for i in items)
    assert placed == list(range(len(sizes)))
    assert all(items and sum(sizes[i] for i in items) == capacity - p.free[k] <= capacity for k, items in p.bins.items())


@pytest.mark.parametrize("seed", range(6))
def test_crossover_and_dissolve_keep_every_piece_once(seed):
    sizes, rng = triples(seed, 60), random.Random(seed)
    noisy = ga.Packing(sizes, 1000)
    noisy.best_fit(rng.sample(range(len(sizes)), len(sizes)))
    for a, b in ((best_fit(sizes, 1000), noisy), (noisy, best_fit(sizes, 1000))):
        injected = {frozenset(x) for x in b.bins.values()}
        before = {k: list(v) for k, v in a.bins.items()}
        child = ga.crossover(a, b, rng)
        sound(child, sizes, 1000)
        assert any(frozenset(x) in injected for x in child.bins.values())
        assert a.bins == before  # the parents stay as they are
        ga.dissolve(child, rng)
        sound(child, sizes, 1000)


def test_evolution_never_loses_and_gains_over_best_fit(monkeypatch):
    """Sequences of best fit, the search, and the bound, on pieces that fill bins three by three."""
    calls = []
    real = ga.crossover
    monkeypatch.setattr(ga, "crossover", lambda *a: calls.append(1) or real(*a))
    gains = []
    for seed in range(6):
        sizes = triples(seed, 100)
        fit = best_fit(sizes, 1000)
        best = ga.evolve(sizes, 1000, seed)
        for epoch in range(4):
            new = ga.evolve(sizes, 1000, 100 + epoch, best, ga.evolve(sizes, 1000, 200 + epoch))
            assert new.max() <= best.max()
            best = new
        p = ga._from_assignment(best, sizes, 1000)
        sound(p, sizes, 1000)
        assert 100 <= len(p.bins) <= len(fit.bins)
        gains.append((len(fit.bins), len(p.bins)))
    print("best fit, search (bound 100):", gains)
    assert len(calls) > 50 and sum(a - b for a, b in gains) >= len(gains)


def test_guests_migrate(spark, monkeypatch):
    """An island that is given another's better packing returns one at least as good."""
    sizes = triples(3, 80)
    good = ga.evolve(sizes, 1000, 1, generations=12)
    poor = np.arange(len(sizes), dtype="<i4")  # a bin for each piece
    assert ga.evolve(sizes, 1000, 9, poor, good, generations=0).max() <= good.max()
    rows = [(i, n) for i, n in enumerate(sizes)]
    packed = ga.pack(spark.createDataFrame(rows, "row bigint, length bigint"), 1000, islands=3, epochs=3).collect()
    assert len({r.row for r in packed}) == len(sizes) == len(packed)
    fill = {}
    for r in packed:
        fill.setdefault(r.sequence_id, []).append((r.offset, sizes[r.row]))
    for parts in fill.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0 and sum(parts[-1]) <= 1000
    assert len(fill) <= len(best_fit(sizes, 1000).bins)


def test_blocks_of_long_texts(spark, monkeypatch):
    """Blocks cut by grams and hashed in slices give the classes of whole comparisons."""
    monkeypatch.setattr(dartminhash, "BLOCK_GRAMS", 6000)
    monkeypatch.setattr(dartminhash, "SLICE_BYTES", 1 << 14)
    rng = random.Random(2)
    base = [f"w{rng.randrange(900)}" for _ in range(2000)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(rng.randint(10, 150)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(100, " ".join(f"y{rng.randrange(900)}" for _ in range(20000)))]
    got = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}

    def grams(text):
        w = text.split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}

    sets = {i: grams(t) for i, t in rows}
    comp = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((comp[a], comp[b]))
                comp = {k: x if v == y else v for k, v in comp.items()}
    assert got == comp and len(set(comp.values())) > 2
