"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Method.  Test items are taken in blocks of bounded size, each shipped whole to
the workers.  One pass over the corpus counts in how many documents each item
n-gram occurs.  An item's seeds are rare on both sides: n-grams that few items
share (all of its own, if it has none of these), and of them those that are not
far more frequent in documents than its typical one.  A second pass finds the seeds in every document, joins
them to items by diagonal and aligns item and passage word by word
(Smith-Waterman with linear gaps, vectorised over candidates).  A passage whose
alignment reaches the threshold is a copy, edited or not.  Items of few words are
looked up whole instead: only all their words in a row are a copy.  Nothing is
shuffled but the n-gram counts.  Where there are several blocks, each one's result
is written to the shared folder before the next is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import doc_of, fold, materialize, ngram_hashes, pick, ranges, slices, word_hashes

SEED_WORDS = 3
MIN_ITEM_WORDS = 8      # a part of a shorter item is no evidence, only the whole of it
SIMILARITY = 0.5        # alignment score over that of an exact copy
BLOCK_WORDS = 200_000   # words of benchmark items per block
SLICE_BYTES = 2 << 20   # text hashed at once
SHARED = 8              # a seed is an n-gram of this many items at most
FREQUENT = 4            # a seed may occur in this many times the documents of the item's median n-gram
MATCH, MISMATCH, GAP = 2, -1, -1
_MATCHES = "doc_id bigint, item_id bigint, similarity double, first_word bigint, end_word bigint"


class Block:
    """Items with an index of their n-grams."""

    def __init__(self, ids: list, texts: list):
        starts, words = word_hashes(pa.array(texts, pa.string()), folded=True)
        count = np.diff(starts)
        few = np.flatnonzero((count > 0) & (count < MIN_ITEM_WORDS))
        good = np.flatnonzero(count >= MIN_ITEM_WORDS)
        self.ids = [ids[i] for i in [*good, *few]]
        self.short = {}  # words of an item -> (distinct hashes of whole items, their first place in items, items)
        for n in np.unique(count[few]).tolist():
            mine = np.flatnonzero(count[few] == n)
            whole = ngram_hashes(words, n)[starts[few[mine]]]
            order = np.argsort(whole, kind="stable")
            keys, first = np.unique(whole[order], return_index=True)
            self.short[n] = keys, np.append(first, len(order)), len(good) + mine[order]
        self.length = np.diff(starts)[good]
        self.words = words[ranges(starts[good], self.length)]
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        grams = ngram_hashes(self.words, SEED_WORDS)
        item = doc_of(self.start)[: len(grams)]
        at = np.flatnonzero(np.arange(len(grams)) + SEED_WORDS <= self.start[1:][item])
        order = at[np.argsort(grams[at], kind="stable")]
        self.grams, first = np.unique(grams[order], return_index=True)
        self.first = np.append(first, len(order))
        self.item, self.at = item[order], order - self.start[item[order]]
        self.seed = np.ones(len(self.grams), bool)
        self._filter()

    def _filter(self):
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.grams[self.seed] & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def keep_rare(self, documents: np.ndarray) -> None:
        """documents: in how many documents each n-gram occurs.  Only the seeds stay in the index."""
        gram = np.repeat(np.arange(len(self.grams)), np.diff(self.first))
        pairs = np.unique(np.stack([gram, self.item], axis=1), axis=0)[:, 0]
        few = np.bincount(pairs, minlength=len(self.grams)) <= SHARED
        kept = np.zeros(len(gram), bool)
        order = np.argsort(self.item, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(self.item[order])) + 1):
            own = part[few[gram[part]]]
            part = own if len(own) else part  # an item without n-grams of its own
            seen = documents[gram[part]]
            if len(part):
                kept[part[seen <= FREQUENT * np.median(seen) + 1]] = True
        gram, self.item, self.at = gram[kept], self.item[kept], self.at[kept]
        names, first = np.unique(gram, return_index=True)
        self.grams, self.first = self.grams[names], np.append(first, len(gram))
        self.seed = np.ones(len(self.grams), bool)
        self._filter()

    def hits(self, starts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, word, n-gram) of every seed in the documents."""
        grams = ngram_hashes(words, SEED_WORDS)
        near = np.flatnonzero(self.bits[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(near) or not len(self.grams):
            return (np.zeros(0, np.int64),) * 3
        which = np.minimum(np.searchsorted(self.grams, grams[near]), len(self.grams) - 1)
        same = (self.grams[which] == grams[near]) & self.seed[which]
        near, which = near[same], which[same]
        doc = np.searchsorted(starts, near, side="right") - 1
        inside = near + SEED_WORDS <= starts[1:][doc]
        return doc[inside], near[inside], which[inside]

    def whole_hits(self, starts: np.ndarray, words: np.ndarray) -> dict:
        """First place of every short item in each document that holds all its words in a row."""
        found = {}
        for n, (keys, first, items) in self.short.items():
            grams = ngram_hashes(words, n)
            which = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            at = np.flatnonzero(keys[which] == grams)
            doc = np.searchsorted(starts, at, side="right") - 1
            inside = at + n <= starts[1:][doc]
            at, doc, which = at[inside], doc[inside], which[at[inside]]
            _, once = np.unique(doc * len(keys) + which, return_index=True)
            for i in once.tolist():
                d, k, a = int(doc[i]), int(which[i]), int(at[i] - starts[doc[i]])
                found.update({(d, item): (1.0, a, a + n) for item in items[first[k]:first[k + 1]].tolist()})
        return found


def smith_waterman(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best local score, column after its last word) for every pair of rows.

    Pad items with 1 and passages with 0: pads match nothing.
    """
    n, width = passages.shape
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    slope = np.arange(width + 1, dtype=np.int32) * GAP
    for i in range(items.shape[1]):
        here = np.zeros_like(above)
        score = np.where(passages == items[:, i:i + 1], MATCH, MISMATCH).astype(np.int32)
        here[:, 1:] = np.maximum(above[:, :-1] + score, above[:, 1:] + GAP)
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here - slope, axis=1) + slope  # gaps along the passage
        top = here.argmax(axis=1)
        value = here[np.arange(n), top]
        better = value > best
        best[better], end[better] = value[better], top[better]
        above = here
    return best, end


def _cut(words: np.ndarray, first: np.ndarray, end: np.ndarray, width: int, pad: int) -> np.ndarray:
    out = np.full((len(first), width), pad, np.uint64)
    length = end - first
    out[np.repeat(np.arange(len(first)), length), ranges(np.zeros(len(first), np.int64), length)] = words[ranges(first, length)]
    return out


def find_copies(block: Block, starts: np.ndarray, words: np.ndarray, similarity: float):
    """(document, item, similarity, first word, end word), the best of each pair."""
    doc, word, gram = block.hits(starts, words)
    count = np.diff(block.first)[gram]
    posting = ranges(block.first[:-1][gram], count)
    doc, word = np.repeat(doc, count), np.repeat(word, count)
    item = block.item[posting]
    slack = np.maximum(4, block.length[item] // 4)
    lane = (word - starts[doc] - block.at[posting]) // slack
    found = block.whole_hits(starts, words)
    if not len(doc):
        return found
    pairs = np.unique(np.stack([block.length[item], item, doc, lane], axis=1), axis=0)
    for a in range(0, len(pairs), 512):
        length, item, doc, lane = pairs[a:a + 512].T
        slack = np.maximum(4, length // 4)
        first = np.maximum(starts[doc] + (lane - 1) * slack, starts[doc])
        end = np.minimum(starts[doc] + (lane + 2) * slack + length, starts[doc + 1])
        width, high = int((end - first).max()), int(length.max())
        passages = _cut(words, first, end, width, 0)
        asked = _cut(block.words, block.start[item], block.start[item] + length, high, 1)
        best, last = smith_waterman(asked, passages)
        part = best / (MATCH * length)
        good = np.flatnonzero(part >= similarity)
        if not len(good):
            continue
        # the same alignment read backwards gives its first word
        back = _cut(words, first[good], first[good] + last[good], width, 0)
        back = np.stack([np.concatenate([x[:n][::-1], x[n:]]) for x, n in zip(back, last[good])])
        turned = np.stack([np.concatenate([x[:n][::-1], x[n:]]) for x, n in zip(asked[good], length[good])])
        _, size = smith_waterman(turned, back)
        for i, n in zip(good.tolist(), size.tolist()):
            key, e = (int(doc[i]), int(item[i])), int(first[i] + last[i] - starts[doc[i]])
            if part[i] > found.get(key, (0,))[0]:
                found[key] = (float(part[i]), e - n, e)
    return found


def blocks(items: DataFrame, block_words: int = BLOCK_WORDS):
    """The items in blocks of bounded size; the driver holds one at a time."""
    ids, texts, size = [], [], 0
    for x in items.toLocalIterator():
        if x["text"] is not None:
            ids.append(x["item_id"])
            texts.append(x["text"])
            size += 1 + max(len(x["text"]) // 4, len(fold(x["text"].encode("utf-8", "replace")).split()))
        if size >= block_words:
            yield Block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Block(ids, texts)


def _count_pass(block: Block):
    def run(batches):
        for whole in batches:
            total = np.zeros(len(block.grams), np.int64)
            for batch in slices(whole, "text", SLICE_BYTES):
                starts, words = word_hashes(batch.column("text"), folded=True)
                doc, _, gram = block.hits(starts, words)
                each = np.unique(doc * len(block.grams) + gram)
                total += np.bincount(each % max(1, len(block.grams)), minlength=len(total))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "documents"])
    return run


def rare_blocks(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS):
    """Blocks with their seeds chosen by document counts over all documents."""
    for block in blocks(items, block_words):
        if not len(block.grams):
            yield block
            continue
        documents = np.zeros(len(block.grams), np.int64)
        counted = docs.select("text").mapInArrow(_count_pass(block), "gram bigint, documents bigint")
        for gram, n in counted.groupBy("gram").agg(F.sum("documents")).toLocalIterator():  # at most a block's n-grams
            documents[gram] = n
        block.keep_rare(documents)
        yield block


def _match_pass(block: Block, similarity: float):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                starts, words = word_hashes(batch.column("text"), folded=True)
                ids = batch.column("doc_id")
                found = find_copies(block, starts, words, similarity)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([d for d, _ in found], pa.int64())),
                     pa.array([block.ids[i] for _, i in found], pa.int64())]
                    + [pa.array([x[k] for x in found.values()], t) for k, t in enumerate((pa.float64(), pa.int64(), pa.int64()))],
                    ["doc_id", "item_id", "similarity", "first_word", "end_word"])
    return run


def _filter_pass(block: Block, similarity: float):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                starts, words = word_hashes(batch.column("text"), folded=True)
                clean = np.ones(batch.num_rows, bool)
                clean[[d for d, _ in find_copies(block, starts, words, similarity)]] = False
                yield batch.filter(pa.array(clean))
    return run


def _named(docs: DataFrame, items: DataFrame, doc_id: str, text: str):
    mine = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return mine, pick(items, item_id="item_id", text="text").withColumn("item_id", F.col("item_id").cast("bigint"))


def benchmark_copies(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     similarity: float = SIMILARITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, end_word): a row per document row and
    test item of which it holds a copy; the words are those of the best passage.

    Words are runs of letters, marks and digits, in compatibility form (NFKC) and
    case folded; a symbol beyond ASCII and a character of a script without spaces
    (Chinese, Japanese, Thai, ..) is a word of its own.  Items of under 8 words
    match as a whole only.  Null texts and items without a word hold and match nothing, null ids
    are passed on, repeated rows are each reported; empty tables give no rows.
    """
    mine, items = _named(docs, items, doc_id, text)
    out = None
    for block, more in _followed(rare_blocks(mine, items, block_words)):
        found = mine.mapInArrow(_match_pass(block, similarity), _MATCHES)
        found = materialize(found, "copies") if more or out is not None else found
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], _MATCHES) if out is None else out


def drop_contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of documents, with all columns, that hold no copy of a test item."""
    mine, items = _named(docs, items, "doc_id", "text")
    for block, more in _followed(rare_blocks(mine, items)):
        docs = docs.mapInArrow(_filter_pass(block, similarity), docs.schema)
        docs = materialize(docs, "clean") if more else docs
    return docs


def _followed(each):
    """(x, whether another one follows) of every x."""
    last = next(each, None)
    for x in each:
        yield last, True
        last = x
    if last is not None:
        yield last, False
