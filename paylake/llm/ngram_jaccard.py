"""Exact n-gram Jaccard join in size-banded tiles with hashed bitmap signatures.

Method.  A document is its set of distinct word 3-grams, as a sorted array of
64-bit hashes; equal sets collapse to one.  Sets can link only if their sizes
lie in the same band or in neighbouring ones.  A band's tile cuts the hash space
into one segment more than linked sets of its sizes can differ in (and a few
spare ones), so linked sets hold the same hashes in some segment: sets meet in a
tile only where a whole segment is equal, which shared phrases and frequent words
don't bring about.  Segments of two hashes and fewer are left to documents that
have more of them than there are spare segments.

Inside a tile, bit counts of xor-ed bitmap signatures bound the overlap of two
sets from above; sets that stay possible are intersected as sorted arrays.  A
segment's sets are first tested against one of them.  Connected components then
tell which segments hold sets of several components; these are compared whole,
in blocks of bounded size, two blocks a tile.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import doc_of, materialize, mix, n_partitions, ngram_hashes, pick, release_memory, slices, text_key, word_hashes
from .components import connected_components

GRAM = 3
SHARE = (90, 100)         # of the union that linked sets have in common at least: 100 * overlap >= 90 * union
SPARSE = 2                # hashes of a segment that is too small to tell documents apart
BLOCK = 512               # sets of a block
BLOCK_HASHES = 1 << 21    # hashes of a block, about
BUCKET_HASHES = 1 << 20   # hashes of the documents whose segments share a bucket, about
MEET_ENTRIES = 1 << 21    # segments that a task looks at in one step
LARGE = 1 << 13           # sets of a segment that is not compared whole at once: first
ROUNDS = 3                # so many further tests against one set
PAIRS = 8                 # possible pairs a set that a tile gives at first, beyond a forest of them
SLICE_BYTES = 3 << 20
_LAST = np.iinfo(np.int64).max  # stands for a null doc_id
_ENTRY = np.dtype([("key", "<u8"), ("sid", "<i8")])
_MET = "key bigint, lead bigint, sid bigint"


# ------------------------------------------------------------------- sets

def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(start of each document's hashes with the end appended, distinct hashes rising per document)."""
    starts, words = word_hashes(pc.ascii_lower(pc.fill_null(texts, "")))
    size = np.diff(starts)
    n = np.where(size >= GRAM, size - GRAM + 1, np.minimum(size, 1))
    ends = np.cumsum(n)
    first = ends - n
    hashes = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    doc = doc_of(starts)
    grams = ngram_hashes(words, GRAM)
    good = np.flatnonzero(np.arange(len(grams)) + GRAM <= starts[1:][doc[: len(grams)]])
    hashes[first[doc[good]] + good - starts[doc[good]]] = grams[good]
    for length in range(1, GRAM):  # fewer words: the whole sequence
        short = np.flatnonzero(size == length)
        if len(short):
            hashes[first[short]] = ngram_hashes(words, length, salt=length)[starts[short]]
    for a, b in zip(first.tolist(), ends.tolist()):
        hashes[a:b].sort()
    owner = np.repeat(np.arange(len(n)), n)
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(n)))]).astype(np.int64), hashes[new]


def _prefix(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes), out=out[1:])
    return out


def set_ids(starts: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; sets of equal name and size count as equal."""
    with np.errstate(over="ignore"):
        return mix(prefix[starts[1:]] - prefix[starts[:-1]] + mix(np.diff(starts).astype(np.uint64))).view(np.int64)


# ------------------------------------------------------------------ tiles

def bands(largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least size of each band, segments of its tile, spare ones among them) up to the size given.
    A set's partners lie in its own band or the next ones up and down."""
    low = [1]
    while low[-1] <= largest:
        low.append(low[-1] * SHARE[1] // SHARE[0] + 1)
    low.append(low[-1] * SHARE[1] // SHARE[0] + 1)
    least = np.array(low[:-1], np.int64)
    # the smaller set a of a pair holds SHARE of the union, so they differ in at most a * (1 - SHARE) / SHARE hashes
    apart = (np.array(low[1:], np.int64) - 1) * (SHARE[1] - SHARE[0]) // SHARE[0]
    spare = 1 + apart // 16
    return least, np.where(apart > 0, apart + 1 + spare, 0), spare  # no segments: only equal sets link


def segments(starts: np.ndarray, hashes: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of the segments under which documents look for partners."""
    size = np.diff(starts)
    least, cut, spare = bands(int(size.max(initial=1)))
    own = np.searchsorted(least, size, side="right") - 1
    docs, keys = [], []
    for band in (own, own - 1):
        chosen = np.flatnonzero((band >= 0) & (cut[np.maximum(band, 0)] > 0) & (size > 0))
        if not len(chosen):
            continue
        band = band[chosen]
        pieces, n = cut[band], size[chosen]
        place = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(starts[:-1][chosen] - place, n)
        piece = ((hashes[at] >> np.uint64(32)) * np.repeat(pieces.astype(np.uint64), n)) >> np.uint64(32)
        base = np.cumsum(pieces) - pieces
        held = np.bincount(np.repeat(base, n) + piece.astype(np.int64), minlength=int(pieces.sum()))
        owner = np.repeat(np.arange(len(chosen)), pieces)
        within = np.arange(len(held)) - base[owner]
        done = np.cumsum(held)
        start = starts[:-1][chosen][owner] + done - held - place[owner]
        small = held <= SPARSE
        plenty = np.bincount(owner, weights=small, minlength=len(chosen)) > spare[band]
        sent = np.flatnonzero(~small | plenty[owner])
        with np.errstate(over="ignore"):
            content = prefix[start[sent] + held[sent]] - prefix[start[sent]]
            name = mix((band[owner[sent]].astype(np.uint64) << np.uint64(40)) + within[sent].astype(np.uint64))
            keys.append(mix(content + name + mix(held[sent].astype(np.uint64))))
        docs.append(chosen[owner[sent]])
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(docs), np.concatenate(keys)


def _set_pass():
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                starts, hashes = shingle_sets(batch.column("text"))
                size = np.diff(starts)
                sid = pa.array(set_ids(starts, _prefix(hashes)), mask=size == 0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("id"), batch.column("tkey"), sid, pa.array(size)],
                                                 ["doc_id", "id", "tkey", "sid", "n"])
    return run


def _met(key: np.ndarray, lead: np.ndarray, sid: np.ndarray) -> bytes:
    return np.column_stack([key.view(np.int64), lead, sid]).astype(np.int64).tobytes()


def _deal_pass(buckets: int):
    """Rows of packed (key, set) entries by bucket.  Of the sets of a batch under one key the first is
    sent to the key's bucket; the others have met it already and go to any bucket, marked as met."""
    def run(batches):
        turn = 0
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                starts, hashes = shingle_sets(batch.column("text"))
                prefix = _prefix(hashes)
                sids = set_ids(starts, prefix)
                doc, key = segments(starts, hashes, prefix)
                once = np.zeros(len(sids), bool)
                once[np.unique(sids, return_index=True)[1]] = True
                doc, key = doc[once[doc]], key[once[doc]]
                bucket = key % np.uint64(buckets)
                order = np.lexsort((key, bucket))
                bucket, key, sid = bucket[order].astype(np.int64), key[order], sids[doc[order]]
                new = np.ones(len(key), bool)
                new[1:] = key[1:] != key[:-1]
                lead = sid[np.flatnonzero(new)][np.cumsum(new) - 1]
                rows = [(turn % buckets, True, _met(key[~new], lead[~new], sid[~new]))] if not new.all() else []
                turn += 1
                entries = np.empty(int(new.sum()), _ENTRY)
                entries["key"], entries["sid"] = key[new], sid[new]
                bucket = bucket[new]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
                rows += [(int(bucket[a]), False, entries[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows]),
                                                      pa.array([r[2] for r in rows], pa.binary())], ["bucket", "met", "entries"])
    return run


def _meet_pass():
    """Rows come by bucket: in each, the sets of a key with the first of them."""
    def batch_of(rows: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], ["key", "lead", "sid"])

    def run(batches):
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        (keys, leads), held, n, now = none, [], 0, None

        def meet():
            nonlocal keys, leads, n
            new = np.concatenate(held) if held else np.empty(0, _ENTRY)
            held.clear()
            n = 0
            every, sid = np.concatenate([keys, new["key"]]), np.concatenate([leads, new["sid"]])
            order = np.argsort(every, kind="stable")  # those that led before stay first
            every, sid = every[order], sid[order]
            first = np.ones(len(every), bool)
            first[1:] = every[1:] != every[:-1]
            lead = sid[np.flatnonzero(first)][np.cumsum(first) - 1] if len(sid) else sid
            keys, leads = every[first], sid[first]
            other = np.flatnonzero(sid != lead)
            return np.column_stack([every[other].view(np.int64), lead[other], sid[other]])

        for batch in batches:
            for bucket, met, entries in zip(*(batch.column(c).to_pylist() for c in ("bucket", "met", "entries"))):
                if met:
                    yield batch_of(np.frombuffer(entries, np.int64).reshape(-1, 3))
                    continue
                if bucket != now or n >= MEET_ENTRIES:
                    yield batch_of(meet())
                    if bucket != now:
                        keys, leads = none
                    now = bucket
                held.append(np.frombuffer(entries, _ENTRY))
                n += len(held[-1])
        yield batch_of(meet())
        release_memory()
    return run


# ------------------------------------------------------------ comparisons

def bitmap(hashes: np.ndarray) -> bytes:
    """A bit per low bits of the hashes, set where an odd number of them falls: of two such maps at
    least as many differ as hashes do.  Half as wide a map is one half xor the other."""
    width = 256
    while width < len(hashes):
        width *= 2
    odd = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def bitmaps(maps: list[bytes]) -> np.ndarray:
    """The maps, folded to the narrowest of them, in rows of 64-bit words."""
    rows = [np.frombuffer(m, np.uint64) for m in maps]
    narrow = min(map(len, rows))
    return np.stack([np.bitwise_xor.reduce(r.reshape(-1, narrow), axis=0) for r in rows])


def enough(overlap, n, m):
    """Whether sets of n and m hashes with that overlap (or a bound of it) link."""
    return SHARE[1] * overlap >= SHARE[0] * (n + m - overlap)


def possible(bits: np.ndarray, size: np.ndarray, at: int, others: np.ndarray) -> np.ndarray:
    """Which of the others may link with the set ``at``, by the bit counts of their maps."""
    apart = np.bitwise_count(bits[others] ^ bits[at]).sum(axis=1, dtype=np.int64)
    return others[enough((size[others] + size[at] - apart) // 2, size[others], size[at])]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two rising arrays."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _star_pass(key, group):
    """Links of a tile's one lead with its other sets."""
    lead = group.column("lead").to_numpy()
    sid, at = np.unique(group.column("sid").to_numpy(), return_index=True)
    group = group.take(pa.array(at))
    sets = [np.frombuffer(x, np.uint64) for x in group.column("hashes").to_pylist()]
    size = np.array([len(x) for x in sets], np.int64)
    centre = int(np.flatnonzero(sid == lead[0])[0])
    others = np.delete(np.arange(len(sid)), centre)
    linked = []
    if len(others):
        bits = bitmaps(group.column("bits").to_pylist())
        linked = [i for i in possible(bits, size, centre, others)
                  if enough(overlap(sets[centre], sets[i]), size[centre], size[i])]
    return pa.table({"u": pa.array(np.full(len(linked), lead[0])), "v": pa.array(sid[linked] if linked else np.zeros(0, np.int64))})


def _forest(u: np.ndarray, v: np.ndarray, count: int) -> np.ndarray:
    """Places of pairs that join all that the pairs join, without a circle."""
    root = np.arange(count)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for at, (i, j) in enumerate(zip(u.tolist(), v.tolist())):
        i, j = find(i), find(j)
        if i != j:
            root[i] = j
            kept.append(at)
    return np.array(kept, np.int64)


def _block_pass(limit: int | None):
    """Pairs of different components in a tile that the bitmaps leave possible: of two blocks between
    them, of one within.  Of more than ``limit`` pairs a set, those of a forest over the
    components, marked as not all."""
    def run(key, group):
        side, sid, comp, size = (group.column(c).to_numpy() for c in ("side", "sid", "comp", "n"))
        bits = bitmaps(group.column("bits").to_pylist())
        u, v = [], []
        right = np.flatnonzero(side == 1)
        for i in np.flatnonzero(side == 0).tolist():
            others = right if len(right) else np.arange(i + 1, len(sid))
            others = others[comp[others] != comp[i]]
            others = possible(bits, size, i, others) if len(others) else others
            u.append(np.full(len(others), i))
            v.append(others)
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (u, v))
        whole = limit is None or len(u) <= limit * len(sid)
        if not whole:
            apart = np.bitwise_count(bits[u] ^ bits[v]).sum(axis=1)  # those first that differ least
            order = np.argsort(apart, kind="stable")
            u, v = u[order], v[order]
            names, own = np.unique(comp, return_inverse=True)
            kept = _forest(own[u], own[v], len(names))
            u, v = u[kept], v[kept]
        a, b = sid[u], sid[v]
        return pa.table({"u": pa.array(np.minimum(a, b)), "v": pa.array(np.maximum(a, b)),
                         "whole": pa.array(np.full(len(a), whole))})
    return run


def _array_pass():
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                starts, hashes = shingle_sets(batch.column("text"))
                sets = [hashes[a:b] for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("sid"), pa.array(np.diff(starts)), pa.array([x.tobytes() for x in sets], pa.binary()),
                     pa.array([bitmap(x) for x in sets], pa.binary())], ["sid", "n", "hashes", "bits"])
    return run


def _room(n: Column) -> Column:
    """Sets of a block where they have n hashes."""
    return F.greatest(F.least(F.floor(F.lit(BLOCK_HASHES) / F.greatest(n, F.lit(1))), F.lit(BLOCK)), F.lit(2)).cast("bigint")


def _spread(sid: str, parts: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(sid, F.lit(salt)), parts)


def verified(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """The linked ones of the pairs (u, v): tiles of one u and a bounded number of its v."""
    counts = pairs.groupBy("u").agg(F.count("*").alias("m")).join(arrays.select(F.col("sid").alias("u"), "n"), "u")
    counts = counts.select("u", F.ceil(F.col("m") / _room(F.col("n"))).cast("bigint").alias("parts"))
    tiles = pairs.join(counts, "u").select("u", _spread("v", F.col("parts"), 1).alias("part"), "v")
    rows = (tiles.select("u", "part", F.explode(F.array("u", "v")).alias("sid")).distinct()
            .join(arrays, "sid").select(F.col("u").alias("lead"), "part", "sid", "hashes", "bits"))
    return rows.groupBy("lead", "part").applyInArrow(_star_pass, "u bigint, v bigint")


def _components(links: list[DataFrame]) -> DataFrame:
    every = links[0]
    for x in links[1:]:
        every = every.union(x)
    return materialize(connected_components(every), "components")


def _unsettled(met: DataFrame, pairs: DataFrame, comps: DataFrame, arrays: DataFrame) -> DataFrame:
    """(key, sid, comp, n, m): the m sets of every key whose sets belong to several components.
    Of keys with the same sets one stays."""
    own = F.coalesce("comp", "sid").alias("comp")
    of = pairs.join(comps.select(F.col("node").alias("sid"), "comp"), "sid", "left").select("lead", "sid", own)
    lead = comps.select(F.col("node").alias("lead"), F.col("comp").alias("led"))
    apart = of.join(lead, "lead", "left").where(F.coalesce("led", "lead") != F.col("comp")).select("lead", "sid")
    keys = met.join(apart, ["lead", "sid"], "left_semi").select("key").distinct()
    members = met.join(keys, "key", "left_semi")
    members = members.select("key", F.explode(F.array("lead", "sid")).alias("sid")).distinct()
    sums = members.groupBy("key").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("sid")).alias("x"),
                                      F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("y"))
    one = sums.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key", "m")
    sets = (arrays.select("sid", "n").join(comps.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "n", own))
    return materialize(members.join(one, "key").join(sets, "sid").select("key", "sid", "comp", "n", "m"), "unsettled")


def _by_lead(members: DataFrame, salt: int) -> DataFrame:
    """Pairs of one set of each key with the key's sets of other components."""
    lead = members.groupBy("key").agg(F.min_by(F.struct("sid", "comp"), F.xxhash64("sid", F.lit(salt))).alias("lead"))
    return (members.join(lead, "key").where("lead.comp <> comp")
            .select(F.col("lead.sid").alias("u"), F.col("sid").alias("v")).distinct())


def _by_block(members: DataFrame, arrays: DataFrame, limit: int | None) -> DataFrame:
    """Pairs (u, v, whole) of different components that the bitmaps leave possible: every block
    of a key's sets with every other and itself."""
    parts = F.ceil(F.col("m") / _room(F.col("size"))).cast("bigint")
    # a band's sets are nearly of one size; the largest bounds the block
    most = members.groupBy("key").agg(F.max("n").alias("size"))
    dealt = members.join(most, "key").withColumn("parts", parts).withColumn("a", _spread("sid", F.col("parts"), 2))
    dealt = dealt.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    tiles = dealt.select("key", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"),
                         (F.col("a") > F.col("b")).cast("int").alias("side"), "sid", "comp")
    rows = tiles.join(arrays.select("sid", "n", "bits"), "sid")
    return rows.groupBy("key", "i", "j").applyInArrow(_block_pass(limit), "u bigint, v bigint, whole boolean").distinct()


def _links(docs: DataFrame, sets: DataFrame) -> DataFrame | None:
    """(node, comp) of the sets that link with another one; None if there are no candidates."""
    spark = docs.sparkSession
    parts = n_partitions(spark)
    buckets = max(64, int((sets.agg(F.sum("n")).first()[0] or 0) // BUCKET_HASHES))
    dealt = docs.select("text").mapInArrow(_deal_pass(buckets), "bucket int, met boolean, entries binary")
    met = materialize(dealt.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_meet_pass(), _MET)
                      .where("lead <> sid"), "met")
    pairs = materialize(met.groupBy("lead", "sid").agg(F.count("*").alias("shared")), "pairs")
    if pairs.isEmpty():
        return None
    wanted = pairs.select(F.explode(F.array("lead", "sid")).alias("sid")).distinct()
    rows = sets.where("sid is not null").groupBy("sid").agg(F.min(F.struct("id", "tkey")).alias("row"))
    rows = rows.join(wanted, "sid").select("row.id", "row.tkey", "sid")
    texts = (docs.join(rows, ["id", "tkey"]).groupBy("id", "tkey", "sid").agg(F.first("text").alias("text")).select("sid", "text"))
    arrays = materialize(texts.mapInArrow(_array_pass(), "sid bigint, n bigint, hashes binary, bits binary"), "arrays")

    nearest = pairs.groupBy("sid").agg(F.max_by("lead", F.struct("shared", "lead")).alias("u")).select("u", F.col("sid").alias("v"))
    links = [materialize(verified(nearest, arrays), "links")]
    steps, limit = ROUNDS, PAIRS
    while True:
        comps = _components(links)
        members = _unsettled(met, pairs, comps, arrays)
        most = members.agg(F.max("m")).first()[0]
        if most is None:
            return comps
        if steps and most > LARGE:
            steps -= 1
            wanted = _by_lead(members.where(F.col("m") > LARGE), steps)
            links.append(materialize(verified(wanted, arrays), "links"))
            continue
        # first a bounded number of pairs a set, whose links leave few components; then what is still apart
        left = materialize(_by_block(members, arrays, limit), "possible")
        links.append(materialize(verified(left.select("u", "v").distinct(), arrays), "links"))
        if limit is None or left.where("not whole").isEmpty():
            return _components(links)
        steps, limit = 0, None


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Words are runs of non-space, A-Z lower-cased; the set of a document holds its
    distinct 3-word shingles, or its one or two words as one.  Documents link
    when 100 * overlap >= 90 * union, and component_id is the smallest doc_id
    that links reach.  A document without words, or a null text, has no shingles
    and is its own component.  Null doc_ids link like others but never name a
    component that holds a doc_id; rows that repeat an id or a text are rows of
    their own.  Long texts are read whole, a slice of rows at a time.  Extra
    columns are ignored; an empty table gives no rows.  Shingles are compared by
    64-bit hashes; two sets count as equal by a 64-bit hash of theirs.
    """
    mine = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                                                       text_key(F.col("text")).alias("tkey"))
    mine = mine.withColumn("id", F.coalesce("doc_id", F.lit(_LAST)))
    sets = materialize(mine.mapInArrow(_set_pass(), "doc_id bigint, id bigint, tkey bigint, sid bigint, n bigint"), "sets")
    comps = _links(mine, sets)
    some = sets.where("sid is not null")
    least = some.groupBy("sid").agg(F.min("doc_id").alias("component_id"))
    if comps is not None:
        least = least.join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
        least = (least.select("sid", "comp").join(least.groupBy("comp").agg(F.min("component_id").alias("component_id")), "comp")
                 .select("sid", "component_id"))
    found = some.join(least, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = sets.where("sid is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)
