"""Seeds and lanes against the alignment of every document with every item, and templates."""

import random
import time

import numpy as np
import pytest

from paylake.llm import decontaminate as dc
from paylake.llm.common import word_hashes


def prose(rng, n, vocabulary=800):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    out = []
    for w in text.split():
        x = rng.random()
        if x < share / 3:
            continue
        out.append(f"e{rng.randrange(999)}" if x < 2 * share / 3 else w)
        if x > 1 - share / 3:
            out.append(f"i{rng.randrange(999)}")
    return " ".join(out)


def brute(docs, items):
    """Pairs whose alignment over the whole document reaches the similarity."""
    import pyarrow as pa

    def hashes(texts):
        starts, words = word_hashes(pa.array(texts), folded=True)
        return [words[a:b] for a, b in zip(starts[:-1], starts[1:])]

    out, asked = {}, hashes([t for _, t in items])
    for (doc, _), words in zip(docs, hashes([t for _, t in docs])):
        for (item, _), mine in zip(items, asked):
            if len(words) and len(mine) >= dc.MIN_ITEM_WORDS:
                score = dc.smith_waterman(mine[None, :], words[None, :])[0][0] / (dc.MATCH * len(mine))
                if score >= dc.SIMILARITY:
                    out[doc, item] = score
    return out


@pytest.mark.parametrize("block_words", [200_000, 300])
def test_recall_against_all_alignments(spark, block_words):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(8, 60))) for i in range(40)]
    items += [(40 + i, "choose the best of the following answers to this question now " + prose(rng, 25)) for i in range(20)]
    docs = [(i, prose(rng, rng.randint(20, 200))) for i in range(60)]
    for i, (item, text) in enumerate(items):
        for k, share in enumerate((0.0, 0.1, 0.2, 0.35)):
            docs.append((100 + 4 * i + k, prose(rng, rng.randint(0, 80)) + " " + edited(rng, text, share) + " " + prose(rng, rng.randint(0, 80))))
    want = brute(docs, items)
    got = dc.benchmark_copies(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
                              spark.createDataFrame(items, "item_id bigint, text string"), block_words=block_words).collect()
    found = {(r.doc_id, r.item_id): r.similarity for r in got}
    assert len(found) == len(got) and set(found) <= set(want)
    assert len(found) >= 0.97 * len(want) and len(want) > 150
    clear = {k for k, v in want.items() if v >= 0.65}
    assert clear <= set(found)
    assert np.mean([abs(found[k] - want[k]) < 1e-9 for k in found]) > 0.95


def test_template_items(spark):
    """Thousands of items with one opening: fast, and a document with the opening alone is clean."""
    rng = random.Random(6)
    opening = " ".join(f"t{i}" for i in range(10))
    items = [(i, opening + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(8))) for i in range(8000)]
    docs = [(i, prose(rng, 12) + " " + opening + " " + prose(rng, 12)) for i in range(200)]
    docs += [(1000 + i, prose(rng, 5) + " " + items[37 * i][1]) for i in range(10)]
    began = time.time()
    asked = spark.createDataFrame(items, "item_id bigint, text string"), spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in dc.benchmark_copies(asked[1], asked[0]).collect()}
    assert got == {(1000 + i, 37 * i) for i in range(10)} and time.time() - began < 60
    left = {r.doc_id for r in dc.drop_contaminated(asked[1], asked[0]).collect()}
    assert left == set(range(200))


def test_equal_items_without_grams_of_their_own(spark):
    """Fifty equal items share every n-gram: each is still found."""
    text = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(i, text) for i in range(50)], "item_id bigint, text string")
    got = dc.benchmark_copies(spark.createDataFrame([(1, f"a b {text} c"), (2, "a b c")], "doc_id bigint, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, i) for i in range(50)}
