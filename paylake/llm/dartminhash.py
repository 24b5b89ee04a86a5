"""Near-duplicate classes by DartMinHash signatures and a banded join.

Method.  A document is the multiset of its word 5-grams.  Hashed darts arrive
at each gram along a rank axis, separately in every power-of-two strip of the
gram's weight (a Poisson process, the same for equal grams everywhere); a dart
counts when it falls below the gram's weight.  Every dart carries a coordinate
and each coordinate keeps its earliest dart, which gives signatures whose
agreement is the weighted Jaccard similarity.  Five coordinates make a band;
documents that share a band are candidates and are verified on their whole
texts.

Copies collapse to one node first.  In a band's bucket all nodes are tested
against one leader; connected components then tell which buckets still hold
several classes.  Those are compared whole, in blocks of bounded size, where a
task keeps only the links that join two classes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import _powers, doc_of, materialize, mix, n_partitions, ngram_hashes, pick, slices, text_key, word_hashes
from .components import connected_components

GRAM = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5   # a pair at 0.8 shares a band with probability 0.99995
BLOCK = 400           # members of a bucket that meet those of another block in one group
BLOCK_GRAMS = 1 << 20  # or that hold so many grams, whichever is fewer members
SLICE_BYTES = 1 << 20  # text hashed at once; its arrays take about 60 times that
_LOW = 44             # bits of a gram's hash that are kept beside its document's number
_SIGNED = ("row bigint, doc_id bigint, tkey bigint, c1 bigint, c2 bigint, weight bigint, "
           "bands array<bigint>, text string")


def elements(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, gram, count) of every distinct gram, and two content hashes per document.

    A text of one to four words is one gram; one without words has none.
    """
    starts, words = word_hashes(texts)
    n = len(starts) - 1
    size = np.diff(starts)
    some = np.flatnonzero(size)
    content = np.zeros((2, n), np.uint64)
    doc = doc_of(starts)
    within = np.arange(len(words)) - starts[doc]
    with np.errstate(over="ignore"):
        for k, base in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
            if len(some):
                powers = _powers(int(size.max()) + 1, base)
                content[k][some] = mix(np.add.reduceat(words * powers[within], starts[some]) + size[some].astype(np.uint64))
    grams = ngram_hashes(words, GRAM)
    good = np.flatnonzero(np.arange(len(grams)) + GRAM <= starts[1:][doc[: len(grams)]])
    short = some[size[some] < GRAM]
    low = np.uint64((1 << _LOW) - 1)
    keys = np.concatenate([(doc[good].astype(np.uint64) << np.uint64(_LOW)) | (grams[good] & low),
                           (short.astype(np.uint64) << np.uint64(_LOW)) | (content[0][short] & low)])
    keys, count = np.unique(keys, return_counts=True)
    return (keys >> np.uint64(_LOW)).astype(np.int64), keys & low, count, content[0], content[1]


def _darts(doc, gram, count, limit, coordinates: int):
    """(document, coordinate, rank, dart) of all darts whose rank is under the document's limit."""
    out = []
    strip, floor, width = 0, 0.0, 1.0
    while True:
        at = np.flatnonzero(count > floor)
        if not len(at):
            break
        rank, throw = np.zeros(len(at)), 0
        while len(at):
            with np.errstate(over="ignore"):
                dart = mix(gram[at] + np.uint64((strip << 48) + throw + 1) * np.uint64(0xA24BAED4963EE407))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width
            alive = rank < limit[doc[at]]
            at, rank, dart = at[alive], rank[alive], dart[alive]
            dart = mix(dart ^ np.uint64(0x5851F42D4C957F2D))
            height = floor + width * ((dart >> np.uint64(24)) & np.uint64(0xFFFFFF)).astype(np.float64) * 2.0 ** -24
            hit = np.flatnonzero(height < count[at])
            out.append((doc[at[hit]], ((dart[hit] >> np.uint64(48)) % np.uint64(coordinates)).astype(np.int64), rank[hit], dart[hit]))
            throw += 1
        strip, floor, width = strip + 1, (1.0 if strip == 0 else 2 * floor), (1.0 if strip == 0 else 2 * width)
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0), np.zeros(0, np.uint64)]


def signatures(n: int, doc, gram, count, coordinates: int) -> np.ndarray:
    """(n, coordinates) earliest darts; rows of documents without grams stay 0."""
    weight = np.bincount(doc, weights=count, minlength=n)
    signature = np.zeros((n, coordinates), np.uint64)
    todo = weight > 0
    limit = np.zeros(n)
    limit[todo] = (coordinates * math.log(coordinates) + 2 * coordinates) / weight[todo]
    while todo.any():
        part = todo[doc]
        d, c, rank, dart = _darts(doc[part], gram[part], count[part], limit, coordinates)
        earliest = np.full(n * coordinates, np.inf)
        key = d * coordinates + c
        np.minimum.at(earliest, key, rank)
        first = rank == earliest[key]
        signature.ravel()[key[first]] = dart[first]
        empty = np.isinf(earliest).reshape(n, coordinates).any(axis=1)
        todo &= empty  # a coordinate without a dart: once more with twice the ranks
        limit[todo] *= 2
    return signature


def _sign_pass(bands: int, rows: int):
    def run(batches):
        part, done = TaskContext.get().partitionId() << 40, 0
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                n = batch.num_rows
                doc, gram, count, c1, c2 = elements(batch.column("text"))
                sign = signatures(n, doc, gram, count, bands * rows).reshape(n, bands, rows)
                with np.errstate(over="ignore"):
                    salt = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
                    keys = mix((sign * salt).sum(axis=2, dtype=np.uint64) + mix(np.arange(bands, dtype=np.uint64)))
                weight = np.bincount(doc, weights=count, minlength=n).astype(np.int64)
                some = weight > 0
                flat = pa.array(keys[some].ravel().view(np.int64))
                offsets = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
                row = np.arange(part + done, part + done + n)
                done += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), batch.column("doc_id"), batch.column("tkey"), pa.array(c1.view(np.int64)),
                     pa.array(c2.view(np.int64)), pa.array(weight), pa.ListArray.from_arrays(pa.array(offsets), flat),
                     batch.column("text")], ["row", "doc_id", "tkey", "c1", "c2", "weight", "bands", "text"])
    return run


def weighted_jaccard(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Similarity of the texts at each place, on counts of word 5-grams."""
    n = len(a)
    sides = [elements(x)[:3] for x in (a, b)]
    total = sum(np.bincount(d, weights=c, minlength=n) for d, _, c in sides)
    keys = [(d.astype(np.uint64) << np.uint64(_LOW)) | g for d, g, _ in sides]
    _, i, j = np.intersect1d(*keys, assume_unique=True, return_indices=True)
    both = np.bincount(sides[0][0][i], weights=np.minimum(sides[0][2][i], sides[1][2][j]), minlength=n)
    return both / np.maximum(total - both, 1)


def _verify_pass(similarity: float):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text_u", SLICE_BYTES):
                good = weighted_jaccard(batch.column("text_u"), batch.column("text_v")) >= similarity - 1e-12
                yield batch.select(["u", "v"]).append_column("linked", pa.array(good))
    return run


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """pairs (u, v): tested on their texts; a v with many partners is dealt in parts of about 1000."""
    shares = pairs.groupBy("v").agg((F.count("*") / 1000).cast("int").alias("last"))
    asked = (texts.join(shares, texts["node"] == shares["v"])
             .select("v", F.explode(F.sequence(F.lit(0), "last")).alias("part"), "last", F.col("text").alias("text_v")))
    mine = pairs.join(shares, "v").withColumn("part", F.pmod(F.xxhash64("u"), F.col("last") + 1).cast("int")).select("u", "v", "part")
    mine = mine.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
    return mine.join(asked.drop("last"), ["v", "part"]).select("u", "v", "text_u", "text_v").mapInArrow(
        _verify_pass(similarity), "u bigint, v bigint, linked boolean")


def _groups(batches):
    """Rows of consecutive equal (key, i, j) as one batch each; a batch's texts are hashed at once."""
    held, name = [], None
    for batch in batches:
        names = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j"))))
        cuts = [0, *(x for x in range(1, len(names)) if names[x] != names[x - 1]), len(names)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b == a:
                continue
            if names[a] != name and held:
                yield name, pa.Table.from_batches(held)
                held = []
            name = names[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield name, pa.Table.from_batches(held)


def linked_classes(texts: pa.Array, comp: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """A forest of links (places a, b) that joins all classes with similar members.

    Counts become sets of (gram, occurrence), whose incidence matrix gives every
    intersection of two texts by one product.
    """
    parts, at = [], 0
    for batch in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", SLICE_BYTES):
        doc, gram, count, _, _ = elements(batch.column("text"))
        parts.append((doc + at, gram, count))
        at += batch.num_rows
    doc, gram, count = (np.concatenate(x) for x in zip(*parts))
    n, size = len(texts), np.bincount(doc, weights=count, minlength=len(texts))
    again = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    with np.errstate(over="ignore"):
        item = np.repeat(gram, count) + again.astype(np.uint64) * np.uint64(1 << _LOW)
    items, column, many = np.unique(item, return_inverse=True, return_counts=True)
    doc, shared = np.repeat(doc, count), many[column] > 1
    both = np.zeros((n, n), np.float32)
    if shared.any():
        keep = np.flatnonzero(shared)
        used, column = np.unique(column[keep], return_inverse=True)
        for a in range(0, len(used), 8192):  # the matrix in parts of bounded size
            part = (column >= a) & (column < a + 8192)
            m = np.zeros((n, min(8192, len(used) - a)), np.float32)
            m[doc[keep][part], column[part] - a] = 1
            both += m @ m.T
    similar = both >= similarity * (size[:, None] + size[None, :] - both) - 1e-6
    parent = {c: c for c in comp.tolist()}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(*np.nonzero(np.triu(similar & (comp[:, None] != comp[None, :]), 1))):
        x, y = root(int(comp[a])), root(int(comp[b]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(a), int(b)))
    return out


def _block_pass(similarity: float):
    def run(batches):
        for _, group in _groups(batches):
            group = group.combine_chunks()
            nodes, comp = group.column("node").to_numpy(), group.column("comp").to_numpy()
            texts = group.column("text").combine_chunks()
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            found = linked_classes(texts, comp, similarity)
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], ["u", "v"])
    return run


def _bucket_links(buckets: DataFrame, labels: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between classes that still meet in a bucket, found over all their members.

    A bucket is cut into blocks of about BLOCK members or BLOCK_GRAMS grams; every pair of blocks is
    one group, so a group is bounded however large the bucket, and a task
    returns a forest of links, not the pairs it compared.
    """
    now = buckets.join(labels, "node", "left").select("key", "node", "weight", F.coalesce("comp", "node").alias("comp"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("weight") / BLOCK_GRAMS)).cast("int").alias("blocks")
    active = now.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), blocks).where("a <> b")
    mine = now.join(active.select("key", "blocks"), "key")
    mine = mine.withColumn("x", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn(
        "y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mine = mine.select("key", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "node", "comp")
    return (mine.join(texts, "node").repartition(n_partitions(texts.sparkSession), "key", "i", "j")
            .sortWithinPartitions("key", "i", "j", "node").select("key", "i", "j", "node", "comp", "text")
            .mapInArrow(_block_pass(similarity), "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size, kept, tkey.

    Links join documents whose word 5-gram counts have a weighted Jaccard
    similarity of at least ``similarity``; a class is a connected component and
    class_id its smallest doc_id (nulls last), whose row is kept.  Words are
    runs of non-space.  Texts without words (null, empty) are one class of
    copies; texts of under five words count as one gram.  Extra columns are
    ignored; an empty table gives no rows.
    """
    mine = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                                       text_key(F.col("text")).alias("tkey"), "text")
    signed = materialize(mine.mapInArrow(_sign_pass(bands, rows), _SIGNED), "near-signed")
    copies = materialize(signed.groupBy("c1", "c2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("low"), F.count("*").alias("n"))
        .select("c1", "c2", "low", "n", F.col("low.row").alias("node")), "near-nodes")
    nodes = signed.select(F.col("row").alias("node"), "weight", "bands").join(copies.select("node"), "node")
    rows_ = nodes.select("node", "weight", F.explode("bands").alias("key"))
    size = rows_.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1")
    buckets = materialize(rows_.join(size.drop("n"), "key"), "near-buckets")
    texts = materialize(signed.select(F.col("row").alias("node"), "text").join(
        buckets.select("node").distinct(), "node", "left_semi"), "near-texts")
    weights = buckets.select(F.col("node").alias("lead"), F.col("weight").alias("w")).distinct()
    pairs = buckets.where("node <> lead").select("node", "lead", "weight").distinct().join(weights, "lead")
    pairs = pairs.where(_close("weight", "w", similarity)).select(F.col("node").alias("u"), F.col("lead").alias("v"))
    checked = _verify(materialize(pairs, "near-pairs"), texts, similarity)
    links = materialize(checked.where("linked").select("u", "v"), "near-links")
    labels = materialize(connected_components(links), "near-labels")
    more = materialize(_bucket_links(buckets, labels, texts, similarity), "near-more")
    if not more.isEmpty():
        labels = materialize(connected_components(links.union(more)), "near-labels")
    of = copies.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    classes = of.groupBy("comp").agg(F.sum("n").alias("class_size"), F.min("low").alias("first"))
    of = of.select("c1", "c2", "comp").join(classes, "comp").select(
        "c1", "c2", "class_size", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("keep"))
    return signed.select("row", "doc_id", "tkey", "c1", "c2").join(of, ["c1", "c2"]).select(
        "doc_id", "class_id", "class_size", (F.col("row") == F.col("keep")).alias("kept"), "tkey")


def _close(a: str, b: str, similarity: float):
    """Only texts of similar weight can be similar."""
    return ((F.least(F.col(a), F.col(b)) + F.lit(1e-9)) >= F.lit(similarity) * F.greatest(F.col(a), F.col(b)))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, with all columns (rows that repeat id and text count once)."""
    def key(tkey):
        return F.concat(tkey.cast("string"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))

    kept = near_duplicates(docs).where("kept").select(key(F.col("tkey")).alias("__near"))
    return (docs.withColumn("__near", key(text_key(F.col("text")))).join(kept, "__near", "left_semi")
            .dropDuplicates(["__near"]).drop("__near"))
