"""Substring deduplication by seed and extend on winnowed anchors.

Method.  Of the nine 5-word grams inside every 13-word window the one with the
least hash is the window's anchor (winnowing), so equal windows have equal
anchors at equal places.  Neighbouring windows share an anchor: an anchor
occurrence is a seed with the run of windows around it.  Seeds are dealt by
anchor into buckets of bounded size and joined there: a run whose anchor no
other run has is left at once.  Runs that share an anchor are extended along
each other, aligned at the anchor: windows at equal distance from it, on both
sides, are compared by hash, for all runs of an anchor at a time and not pair by
pair.  A window is marked when a smaller doc_id has the same one, and marked
windows are merged to maximal repeats per document.  Before the shuffle each
batch sends a window only for its smallest doc_id, so a passage in a third of
all documents costs a record per batch, not per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import doc_of, mix, n_partitions, ngram_hashes, pick, ranges, release_memory, slices, text_key, word_hashes

GRAM = 5
BUCKET_BYTES = 4 << 20  # text whose seeds share a bucket, about
SLICE_BYTES = 3 << 20
_SEEDS = "bucket int, ids binary, keys binary, runs binary, hashes binary, settled boolean"
_SPANS = "doc_id bigint, tkey bigint, first int, last int"
ROWS = 1 << 15  # of a slice: its documents are numbered in 16 bits
_RUN = np.dtype([("anchor", "<u8"), ("doc", "<u2"), ("pos", "<u4"), ("n", "u1"), ("ahead", "u1")])  # ahead: words before the anchor
_HASH = 6  # bytes kept of a window's hash; runs with one anchor agree in 64 bits besides
_LAST = np.iinfo(np.int64).max  # sorts null doc_ids after all others


def _windows(texts: pa.Array, window: int):
    """(document, first word, anchor hash, words before the anchor, window hash) of every window."""
    starts, words = word_hashes(texts)
    grams = ngram_hashes(words, GRAM)
    hashes = ngram_hashes(words, window, salt=1)
    n, steps = len(hashes), window - GRAM + 1
    best, at = grams[:n].copy(), np.zeros(n, dtype=np.int64)
    for j in range(1, steps):
        better = grams[j:n + j] < best
        best = np.where(better, grams[j:n + j], best)
        at[better] = j
    doc = doc_of(starts)[:n]
    good = np.flatnonzero(np.arange(n) + window <= starts[1:][doc])
    doc = doc[good]
    return doc, good - starts[doc], best[good], at[good], hashes[good]


def _runs(doc, pos, anchor, place, hashes, ids, keys, buckets: int, settled: bool):
    """Batches of seeds: one row per bucket, with runs of windows under one anchor."""
    if not len(doc):
        return
    new = np.ones(len(doc), bool)
    # the anchor of a run stays in its place while its windows move on
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] - 1) | (pos[1:] != pos[:-1] + 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(doc)))
    runs = np.empty(len(first), dtype=_RUN)
    deal = anchor[first]
    if settled:  # needs no partner, so it is dealt by document
        deal = mix(ids[doc[first]].view(np.uint64) + keys[doc[first]].view(np.uint64))
    bucket = (deal % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first, length, bucket = first[order], length[order], bucket[order]
    runs["anchor"], runs["doc"], runs["pos"], runs["n"] = anchor[first], doc[first], pos[first], length
    runs["ahead"] = place[first]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    out = {k: [] for k in ("bucket", "ids", "keys", "runs", "hashes")}
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = runs[a:b].copy()
        docs, part["doc"] = np.unique(part["doc"], return_inverse=True)
        out["bucket"].append(int(bucket[a]))
        out["ids"].append(ids[docs].tobytes())
        out["keys"].append(keys[docs].tobytes())
        out["runs"].append(part.tobytes())
        out["hashes"].append(b"" if settled else hashes[ranges(first[a:b], length[a:b])].view(np.uint8).reshape(-1, 8)[:, :_HASH].tobytes())
    yield pa.RecordBatch.from_arrays(
        [pa.array(out["bucket"], pa.int32())] + [pa.array(out[k], pa.binary()) for k in ("ids", "keys", "runs", "hashes")]
        + [pa.array([settled] * len(out["bucket"]))], ["bucket", "ids", "keys", "runs", "hashes", "settled"])


def _least(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window: the least id with its hash, and whether it is the first such entry."""
    order = np.lexsort((ids, hashes))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    low = ids[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
    out = np.empty_like(ids)
    out[order] = low
    return out


def _seed_pass(window: int, buckets: int):
    def run(batches):
        for whole in (b.slice(a, ROWS) for b in batches for a in range(0, b.num_rows, ROWS)):
            for batch in slices(whole, "text", SLICE_BYTES):
                ids = np.array([_LAST if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
                keys = batch.column("tkey").to_numpy(zero_copy_only=False).astype(np.int64)
                doc, pos, anchor, place, hashes = _windows(batch.column("text"), window)
                own = ids[doc]
                known = own > _least(hashes, own)  # a smaller doc_id in this very batch has it
                for part, settled in ((~known, False), (known, True)):
                    yield from _runs(doc[part], pos[part], anchor[part], place[part], hashes[part], ids, keys,
                                     buckets, settled)
    return run


def _spans(doc_ids, keys, first, last):
    null = doc_ids == _LAST
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, mask=null), pa.array(keys), pa.array(first.astype(np.int32)),
                                       pa.array(last.astype(np.int32))], ["doc_id", "tkey", "first", "last"])


def _extended(rows: list[tuple[bytes, bytes, bytes, bytes]]):
    """Spans of marked windows of one bucket's runs: joined on the anchor, then compared at equal
    distance from it."""
    runs = [np.frombuffer(r[2], _RUN) for r in rows]
    ids = np.concatenate([np.frombuffer(r[0], np.int64)[x["doc"]] for r, x in zip(rows, runs)])
    keys = np.concatenate([np.frombuffer(r[1], np.int64)[x["doc"]] for r, x in zip(rows, runs)])
    runs = np.concatenate(runs)
    _, name, times = np.unique(runs["anchor"], return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times[name] > 1)
    if not len(shared):
        return
    n = runs["n"].astype(np.int64)
    at = ranges((np.cumsum(n) - n)[shared], n[shared])
    whole = np.zeros((len(at), 8), np.uint8)
    whole[:, :_HASH] = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, _HASH)[at]
    n = n[shared]
    run = np.repeat(shared, n)
    step = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    distance = runs["ahead"][run].astype(np.int64) - step
    with np.errstate(over="ignore"):
        windows = mix(runs["anchor"][run] + mix(distance.astype(np.uint64))) + whole.view(np.uint64).ravel()
    own = ids[run]
    marked = np.flatnonzero(own > _least(windows, own))
    if not len(marked):
        return
    own, key = own[marked], keys[run[marked]]
    pos = runs["pos"][run[marked]].astype(np.int64) + step[marked]
    cut = np.ones(len(own), bool)
    cut[1:] = (own[1:] != own[:-1]) | (key[1:] != key[:-1]) | (pos[1:] != pos[:-1] + 1)
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(own)) - 1
    for a in range(0, len(first), 100_000):
        f, e = first[a:a + 100_000], last[a:a + 100_000]
        yield _spans(own[f], key[f], pos[f], pos[e])


def _extend_pass():
    """Rows come by bucket, one of which is held at a time."""
    def run(batches):
        now, held = None, []
        for batch in batches:
            for bucket, ids, keys, runs, hashes, settled in zip(*(batch.column(c).to_pylist() for c in
                                                                  ("bucket", "ids", "keys", "runs", "hashes", "settled"))):
                if settled:
                    runs = np.frombuffer(runs, _RUN)
                    pos = runs["pos"].astype(np.int64)
                    yield _spans(np.frombuffer(ids, np.int64)[runs["doc"]], np.frombuffer(keys, np.int64)[runs["doc"]],
                                 pos, pos + runs["n"] - 1)
                    continue
                if bucket != now and held:
                    yield from _extended(held)
                    held = []
                now = bucket
                held.append((ids, keys, runs, hashes))
        if held:
            yield from _extended(held)
        release_memory()
    return run


def repeat_spans(docs: DataFrame, window: int = 13) -> DataFrame:
    """Spans (doc_id, tkey, first, last) of consecutive windows, by first word,
    whose words also start a window in a document with a smaller doc_id."""
    n = n_partitions(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(n, int(size // BUCKET_BYTES))
    seeds = docs.select("doc_id", "tkey", "text").mapInArrow(_seed_pass(window, buckets), _SEEDS)
    return seeds.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_extend_pass(), _SPANS)


def _cut_pass(window: int):
    names = ["doc_id", "text", "n_words", "n_removed", "repeats", "kept_text"]

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int32)
                for x in spans or ():
                    gone[x["first"]] += 1
                    gone[x["last"] + window] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if len(edge) else words
                out[0].append(len(words))
                out[1].append(len(words) - len(kept))
                out[2].append([{"first_word": int(a), "end_word": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                out[3].append(b" ".join(kept).decode())
            repeats = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], repeats), pa.array(out[3], pa.string())], names)
    return run


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 13) -> DataFrame:
    """One row per input row: doc_id, text, n_words, n_removed, repeats, kept_text.

    Words are runs of non-space; null text has none.  A word goes when a window
    over it also starts in a document with a smaller doc_id.  A null doc_id
    counts as larger than all others; rows that repeat a doc_id don't remove
    each other's words.  ``repeats`` lists the maximal removed word ranges.
    Extra columns are ignored; an empty table gives no rows.
    """
    mine = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                                                       text_key(F.col("text")).alias("tkey"))
    spans = (repeat_spans(mine, window).select(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "tkey",
                                               F.struct("first", "last").alias("span"))
             .groupBy("id", "tkey").agg(F.collect_list("span").alias("spans")))
    joined = (mine.withColumn("id", F.coalesce("doc_id", F.lit(_LAST)))
              .join(spans, ["id", "tkey"], "left").select("doc_id", "text", "spans"))
    return joined.mapInArrow(_cut_pass(window),
                             "doc_id bigint, text string, n_words bigint, n_removed bigint, "
                             "repeats array<struct<first_word:bigint,end_word:bigint>>, kept_text string")


def substring_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_repeats of every document."""
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"),
                                        F.size("repeats").cast("bigint").alias("n_repeats"))
