"""N-gram Jaccard join, ranked search and whitening held against brute-force versions."""

import collections
import math
import random
import re

import numpy as np
import pytest

from paylake.llm import feast_whitening, ngram_jaccard, taat_search

EXTRA = "sid bigint, n string, key int, lead string, comp double, score string, rank int, item string"
NOTHING = (1, "x", 2, "y", 0.5, "z", 3, "w")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def frame(spark, rows, columns):
    return spark.createDataFrame([(*r, *NOTHING) for r in rows], f"{columns}, {EXTRA}").repartition(3)


# ---------------------------------------------------------------- op12

def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in least[find(i)] if x is not None]
        out.append((d, len(sets[i]), min(known) if known else None))
    return out


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(words))
            if rng.random() < 0.3:
                words.insert(at, f"new{rng.randrange(10**6)}")
            elif rng.random() < 0.3:
                del words[at]
            else:
                words[at] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def prose(rng, n, vocabulary=300):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def jaccard_rows():
    rng = random.Random(5)
    line = prose(rng, 60)
    texts = [prose(rng, rng.randint(1, 200)) for _ in range(40)] + [line + " " + prose(rng, 100) for _ in range(20)]
    for length, n, edits in ((30, 20, 2), (100, 40, 6), (300, 60, 20), (1500, 15, 60)):
        texts += near_copies(rng, prose(rng, length), n, edits)
    chain = prose(rng, 150).split()  # neighbours link, the ends don't
    texts += [" ".join(chain[i * 3:i * 3 + 100]) for i in range(12)]
    texts += [None, None, "", " \t\n", "One TWO", "one\ttwo", "one", "ONE", "É é é é", "é É é é", "a b c", "A  b\nC"]
    texts += [texts[50].upper()] * 3 + ["x " * 40000, "x " * 30000, prose(rng, 20000, 10**6)]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    return rows + [rows[70], rows[70], (rows[70][0], "other text here now"), (None, rows[80][1]), (None, "nobody else says this")]


def as_rows(df, *columns):
    return sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))


@pytest.mark.parametrize("block,large,entries", [(512, 1 << 13, 1 << 21), (4, 8, 64), (16, 1 << 13, 64)])
def test_jaccard_against_brute_force(spark, monkeypatch, block, large, entries):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)  # small: several blocks, rounds of leaders, buckets in steps
    monkeypatch.setattr(ngram_jaccard, "LARGE", large)
    monkeypatch.setattr(ngram_jaccard, "PAIRS", 8 if large > 8 else 0)  # none: forests first
    monkeypatch.setattr(ngram_jaccard, "MEET_ENTRIES", entries)
    rows = jaccard_rows()
    got = ngram_jaccard.jaccard_components(frame(spark, rows, "doc_id bigint, text string"))
    assert as_rows(got, "doc_id", "n_shingles", "component_id") == sorted(map(str, brute_components(rows)))


def test_jaccard_blocks_alone(spark, monkeypatch):
    """Without any test against a lead, the blocks find every link."""
    rng = random.Random(8)
    rows = list(enumerate(near_copies(rng, prose(rng, 200), 50, 16)))
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 8)
    monkeypatch.setattr(ngram_jaccard, "ROUNDS", 0)
    whole = ngram_jaccard.verified
    calls = []

    def first_fails(pairs, arrays):
        calls.append(pairs)
        return whole(pairs, arrays) if len(calls) > 1 else whole(pairs, arrays).where("u is null")

    monkeypatch.setattr(ngram_jaccard, "verified", first_fails)
    got = ngram_jaccard.jaccard_components(frame(spark, rows, "doc_id bigint, text string"))
    assert as_rows(got, "doc_id", "n_shingles", "component_id") == sorted(map(str, brute_components(rows)))


def test_jaccard_empty(spark):
    none = frame(spark, [(1, "a b c")], "doc_id bigint, text string").where("doc_id = 2")
    got = ngram_jaccard.jaccard_components(none)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == 0
    got = ngram_jaccard.jaccard_components(frame(spark, [(1, None), (1, None), (None, "")], "doc_id bigint, text string"))
    assert as_rows(got, "doc_id", "n_shingles", "component_id") == ["(1, 0, 1)", "(1, 0, 1)", "(None, 0, None)"]


def test_segments_of_linked_sets():
    """Pairs at the edge of linking share a segment in a tile of both."""
    rng = np.random.default_rng(3)
    for n in (9, 10, 19, 20, 57, 200, 1000, 5000):
        for extra in range(0, n // 9 + 1, max(1, n // 40)):
            common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            lost = int((n * 10 - 9 * (n + extra)) / 10 / 2)  # from each side, as far as they still link
            a = np.unique(common)
            b = np.unique(np.concatenate([common[lost:], rng.integers(0, 1 << 63, extra, dtype=np.uint64)]))
            if not ngram_jaccard.enough(len(np.intersect1d(a, b)), len(a), len(b)) or np.array_equal(a, b):
                continue
            starts = np.array([0, len(a), len(a) + len(b)])
            hashes = np.concatenate([a, b])
            doc, key = ngram_jaccard.segments(starts, hashes, ngram_jaccard._prefix(hashes))
            assert set(key[doc == 0].tolist()) & set(key[doc == 1].tolist())
            maps = ngram_jaccard.bitmaps([ngram_jaccard.bitmap(a), ngram_jaccard.bitmap(b)])
            assert len(ngram_jaccard.possible(maps, np.array([len(a), len(b)]), 0, np.array([1]))) == 1


# ---------------------------------------------------------------- op13

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_search(docs, items, k=10):
    terms = [TERM.findall(lower(t)) for _, t in docs]
    n_docs, words = sum(map(bool, terms)), sum(map(len, terms))
    counts = [collections.Counter(t) for t in terms]
    df = collections.Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, _), count, own in zip(docs, counts, terms):
            score = 0
            for t in TERM.findall(lower(text)):
                if count[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + 75 * len(own) * n_docs // words
                    score += w * (10**9 * count[t] // (1000 * count[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("block,limit", [(1 << 14, 1 << 20), (7, 200)])
def test_search_against_brute_force(spark, monkeypatch, block, limit):
    monkeypatch.setattr(taat_search, "BLOCK_DOCS", block)   # small: floors of earlier blocks close the accumulators
    monkeypatch.setattr(taat_search, "BLOCK_BYTES", limit)  # small: several passes over the documents
    rng = random.Random(2)
    word = lambda: f"W{int(rng.paretovariate(0.6)) % 500}"
    docs = [(i, " ".join(word() + rng.choice([" ", ", ", "-"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs += [(900 + i, "same text of w7 w9") for i in range(15)] + [(3, docs[3][1])] * 2
    docs += [(None, "w1 w2 W499"), (None, None), (70, None), (71, "... -- \n"), (72, "Éa éa x2y"), (73, "w3 " * 50000 + "w400")]
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 40)))) for i in range(25)]
    items += [(4, items[4][1]), (4, "w7 w7 w9"), (5, None), (6, ""), (7, "?!"), (None, "éa ÉA w1"), (8, "absent words only")]
    got = taat_search.search(frame(spark, docs, "doc_id bigint, text string"), frame(spark, items, "item_id bigint, text string"))
    assert as_rows(got, "item_id", "rank", "doc_id", "score") == sorted(map(str, brute_search(docs, items)))


def test_accumulators_close(monkeypatch):
    """Common terms update documents that rare ones found and create none after the limit."""
    items = taat_search.Items(taat_search.pa.array(["rare common"]))
    order = {h: i for i, h in enumerate(items.terms.tolist())}
    rare, common = (order[taat_search.term_hashes(taat_search.pa.array([w]))[1][0].item()] for w in ("rare", "common"))
    df = np.zeros(2, np.int64)
    df[rare], df[common] = 3, 90
    items.rank_terms(df, 100)
    lists = {rare: (np.array([5, 6, 7]), np.array([100, 90, 80])), common: (np.arange(90), np.full(90, 10))}
    (docs, scores), = taat_search.search_block(items, lists.get, 100, [0], 3)
    assert dict(zip(docs.tolist(), scores.tolist())) == {5: 110, 6: 100, 7: 90}


def test_search_empty(spark):
    docs = frame(spark, [(1, "a b")], "doc_id bigint, text string")
    items = frame(spark, [(1, "b")], "item_id bigint, text string")
    for d, i in ((docs.where("doc_id = 2"), items), (docs, items.where("item_id = 2")), (docs.where("doc_id = 2"), items.where("item_id = 2"))):
        got = taat_search.search(d, i)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


# ---------------------------------------------------------------- op11

def brute_whitening(rows, k=4):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    x = [(i, [math.floor(256 * c) for c in v] + [0] * (d - len(v))) for i, v in kept]
    fit = sorted({tuple(v) for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, float) - np.array(s) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-12 * values[0]).sum()))
    return n, s, values, vectors[:, :k], x


def vector_rows():
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    data = (rng.standard_normal((400, 12)) * np.array([9, 5, 3, 2] + [1] * 8) @ turn).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
    rows += [(500 + i, rows[0][1]) for i in range(200)] + [(7, rows[9][1]), (None, rows[3][1]), (8, rows[8][1][:5]), (9, [])]
    return rows + [(600, None), (601, [None] * 12), (602, [math.nan] * 12), (603, [math.inf] + [0.0] * 11), (604, [-0.0] * 12)]


def test_whitening_against_brute_force(spark):
    rows = vector_rows()
    got = feast_whitening.whiten(spark.createDataFrame([(*r, *NOTHING) for r in rows], f"vec_id bigint, embedding array<float>, {EXTRA}").repartition(3)).collect()
    n, s, values, vectors, x = brute_whitening(rows)
    want = collections.Counter((i, j + 1, n, sum((n * c - t) ** 2 for c, t in zip(v, s))) for i, v in x for j in range(4))
    assert collections.Counter((r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got) == want
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10
    own = collections.defaultdict(list)
    for i, v in x:
        for j in range(4):
            own[i, j + 1].append((np.array(v) - np.array(s) / n) @ vectors[:, j] / math.sqrt(values[j]))
    for j in range(1, 5):
        at = [r for r in got if r["component"] == j]
        assert abs(at[0]["explained"] - values[j - 1] / values.sum()) < 1e-12
        sign = math.copysign(1, sum(r["whitened"] * own[r["vec_id"], j][0] for r in at))
        for key, mine in own.items():
            if key[1] == j:
                assert np.allclose(sorted(mine), sorted(sign * r["whitened"] for r in at if r["vec_id"] == key[0]), atol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])]])
def test_whitening_without_variance(spark, rows):
    got = feast_whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 0


def test_whitening_large_entries(spark):
    """Deviations are exact beyond 53 bits, and null beyond 64."""
    rows = [(1, [3e9, 1.0]), (2, [-3e9, 5.0]), (3, [1.0, 9.0])]
    got = {r["vec_id"]: r["deviation"] for r in feast_whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    want = {i: sum((3 * c - t) ** 2 for c, t in zip(v, s)) for (i, _), v in zip(rows, x)}
    assert got == {i: v if v < 1 << 63 else None for i, v in want.items()}


@pytest.mark.parametrize("kind", ["spread", "steep", "equal", "singular"])
@pytest.mark.parametrize("d", [1, 2, 5, 40])
def test_feast_components(kind, d):
    rng = np.random.default_rng(d)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"spread": rng.random(d) * 10, "steep": rng.random(d) ** 8, "equal": np.repeat([3.0, 1.0], [min(2, d), d - min(2, d)]),
              "singular": np.r_[np.zeros(d // 2), rng.random(d - d // 2)]}[kind]
    v = turn @ np.diag(values) @ turn.T
    v = (v + v.T) / 2
    for shift in rng.random(5) * values.max():
        assert feast_whitening.above(v, shift) == (np.linalg.eigvalsh(v) > shift).sum()
    for k in (4, 40):
        found, vectors = feast_whitening.leading_components(v, k)
        want = np.sort(values[values > 1e-13 * values.max()])[::-1][:k]
        assert len(found) == len(want) and np.allclose(found, want, rtol=1e-8, atol=1e-13)
        assert np.abs(v @ vectors - vectors * found).max() < 1e-13 * values.max()
        assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-10
