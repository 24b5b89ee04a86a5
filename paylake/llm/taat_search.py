"""Ranked lexical search, accumulator-limited and term at a time.

Method.  Documents stay where they lie: each task builds the inverted lists of
the query terms over blocks of its own documents and answers every item from
them.  An item's terms are taken rarest first.  A document gets an accumulator
when a term first meets it, until the largest scores that the remaining terms
could give fall below the k-th best score seen so far (in this block, or whole
scores of the task's earlier blocks).  From then on no accumulator is created,
since a document without one can't reach the first k; the accumulators that
exist are updated to the end, so every score that is kept is exact.  A task
sends its k best of each item, and these are merged in two steps.

Document frequencies and lengths come from a pass over all documents before.
Items are searched by distinct text, in blocks of bounded size; a block's
answer, k rows an item, is written to the shared folder before the next starts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import doc_of, materialize, pick, release_memory, slices, word_hashes

K = 10
BLOCK_BYTES = 1 << 20     # text of the items that are searched in one pass over the documents
BLOCK_DOCS = 1 << 14      # documents whose lists a task holds at a time, or
BLOCK_POSTINGS = 1 << 21  # postings, whichever comes first
SLICE_BYTES = 4 << 20
SHARDS = 64               # first step of the merge, per item
_LAST = np.iinfo(np.int64).max  # sorts null doc_ids after all others
_DOCS, _TERMS = -1, -2    # rows of the statistics that hold N and L


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ASCII letters (A-Z folded), digits and non-ASCII characters, hashed to 64 bits."""
    return word_hashes(texts, folded=True, compat=False)


class Items:
    """The distinct terms of a block of items and each item's terms with their repeats."""

    def __init__(self, texts: pa.Array):
        starts, hashes = term_hashes(texts)
        self.terms, code = np.unique(hashes, return_inverse=True)
        self.items = [np.unique(code[a:b], return_counts=True) for a, b in zip(starts[:-1], starts[1:])]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of hashes that are terms of an item, number of the term)."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        at = np.flatnonzero(self.terms[code] == hashes)
        return at, code[at]

    def rank_terms(self, df: np.ndarray, n_docs: int) -> None:
        """Weights, and each item's terms rarest first."""
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        self.items = [(t[o], r[o].astype(np.int64)) for t, r in self.items for o in [np.argsort(df[t], kind="stable")]]


def _postings(batch: pa.RecordBatch, items: Items):
    """(term, document of the batch, occurrences) by term, and each document's number of terms."""
    starts, hashes = term_hashes(batch.column("text"))
    at, term = items.find(hashes)
    n = max(1, batch.num_rows)
    key, tf = np.unique(term * n + doc_of(starts)[at], return_counts=True)
    return key // n, key % n, tf, np.diff(starts)


def _count_pass(items: Items):
    def run(batches):
        df, n_docs, n_terms = np.zeros(len(items.terms), np.int64), 0, 0
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                term, _, _, size = _postings(batch, items)
                df += np.bincount(term, minlength=len(df))
                n_docs += int((size > 0).sum())
                n_terms += int(size.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [_DOCS, _TERMS])),
                                          pa.array(np.append(df[some], [n_docs, n_terms]))], ["term", "n"])
    return run


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by ascending id."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def search_block(items: Items, lists, size: int, floors: list[int], k: int):
    """Per item (documents, scores) of the first k of a block, by accumulators.

    ``lists`` gives a term's (documents, contributions); ``floors`` is the k-th
    whole score of each item so far, 0 if there are fewer.
    """
    total = np.zeros(size, np.int64)
    for (terms, repeats), floor in zip(items.items, floors):
        own = [(docs, r * gain) for t, r in zip(terms.tolist(), repeats.tolist()) for docs, gain in [lists(t)] if len(docs)]
        bound = np.cumsum([int(gain.max()) for _, gain in own][::-1])[::-1] if own else []
        touched = [np.zeros(0, np.int64)]
        open_ = True
        for (docs, gain), left in zip(own, bound):
            if open_ and left < floor:
                open_ = False
            if open_:
                touched.append(docs[total[docs] == 0])
            else:
                has = total[docs] > 0
                docs, gain = docs[has], gain[has]
            total[docs] += gain
            if open_:
                held = sum(map(len, touched))
                if held >= k and left - int(gain.max()) < (most := int(total[docs].max())) and most > floor:
                    every = total[np.concatenate(touched)]
                    floor = max(floor, int(np.partition(every, -k)[-k]))
        docs = np.concatenate(touched)
        docs = docs[total[docs] > 0]
        yield docs, total[docs].copy()
        total[docs] = 0


def _search_pass(items: Items, n_docs: int, n_terms: int, k: int):
    def run(batches):
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items.items]
        held: list[tuple] = []

        def answer():
            term, doc, tf = (np.concatenate([x[i] for x in held]) for i in range(3))
            size, ids = (np.concatenate([x[i] for x in held]) for i in (3, 4))
            order = np.argsort(term, kind="stable")
            term, doc, tf = term[order], doc[order], tf[order]
            m = 25 + (75 * size * n_docs) // n_terms
            gain = items.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            some = gain > 0
            term, doc, gain = term[some], doc[some], gain[some]
            cuts = np.searchsorted(term, np.arange(len(items.terms) + 1))
            floors = [int(s[-1]) if len(s) == k else 0 for _, s in kept]
            found = search_block(items, lambda t: (doc[cuts[t]:cuts[t + 1]], gain[cuts[t]:cuts[t + 1]]), len(ids), floors, k)
            for i, (docs, scores) in enumerate(found):
                at = best(ids[docs], scores, k)
                both = np.concatenate([kept[i][0], ids[docs[at]]]), np.concatenate([kept[i][1], scores[at]])
                at = best(*both, k)
                kept[i] = both[0][at], both[1][at]
            held.clear()

        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                term, doc, tf, size = _postings(batch, items)
                ids = np.array([_LAST if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
                held.append((term, doc + sum(len(x[4]) for x in held), tf, size, ids))
                if sum(len(x[4]) for x in held) >= BLOCK_DOCS or sum(len(x[0]) for x in held) >= BLOCK_POSTINGS:
                    answer()
        if held:
            answer()
        release_memory()
        ids, scores = (np.concatenate([x[i] for x in kept]) for i in (0, 1))
        item = np.repeat(np.arange(len(kept)), [len(x[0]) for x in kept])
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=ids == _LAST), pa.array(scores)],
                                         ["item", "doc_id", "score"])
    return run


def _first_k(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their rank: per shard of an item, then per item."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    shard = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS))).orderBy(*order)
    few = found.withColumn("at", F.row_number().over(shard)).where(F.col("at") <= k)
    return (few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= k).select("item", "rank", "doc_id", "score"))


def _search(docs: DataFrame, asked: pa.Table, k: int) -> DataFrame | None:
    """(key, rank, doc_id, score) for the items of one block; None if no document holds a term."""
    items = Items(asked.column("text").combine_chunks())
    text = docs.select("text").mapInArrow(_count_pass(items), "term bigint, n bigint")
    counts = dict(text.groupBy("term").agg(F.sum("n")).toArrow().to_pandas().itertuples(index=False, name=None))
    n_docs, n_terms = counts.pop(_DOCS, 0), counts.pop(_TERMS, 0)
    if not counts:
        return None
    df = np.zeros(len(items.terms), np.int64)
    df[list(counts)] = list(counts.values())
    items.rank_terms(df, n_docs)
    found = docs.mapInArrow(_search_pass(items, int(n_docs), int(n_terms), k), "item bigint, doc_id bigint, score bigint")
    spark = docs.sparkSession
    # a row per item of the block, whose text is bounded by BLOCK_BYTES or is one item: a bounded broadcast
    keys = spark.createDataFrame(list(enumerate(asked.column("key").to_pylist())), "item bigint, key string")
    return materialize(_first_k(found, k).join(F.broadcast(keys), "item").select("key", "rank", "doc_id", "score"), "search")


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 of every item.

    Null, empty and term-less texts hold no term: such documents are never found
    and such items get no rows.  Equal scores go by ascending doc_id, null last;
    rows that repeat a doc_id are ranked each by itself, and every row of
    ``items`` gets its own answer, also where item_id or text repeat.  Texts of
    any length are read whole, a slice of rows at a time.  Extra columns are
    ignored; an empty table on either side gives no rows.  Terms are compared by
    64-bit hashes.
    """
    spark = docs.sparkSession
    docs = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    asked = pick(items, item_id=item_id, text=item_text).where("text is not null").withColumn("key", F.sha1("text"))
    distinct = materialize(asked.select("key", "text").dropDuplicates(["key"]), "items")
    blocks = 1 + (distinct.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES
    answers = []
    for block in range(blocks):
        mine = distinct.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block)
        one = mine.orderBy("key").toArrow()
        if one.num_rows:
            answers.append(_search(docs, one, k))
    schema = "key string, rank int, doc_id bigint, score bigint"
    paths = [x for a in answers if a is not None for x in a.inputFiles()]
    found = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return asked.select("item_id", "key").join(found, "key").select("item_id", "rank", "doc_id", "score")
