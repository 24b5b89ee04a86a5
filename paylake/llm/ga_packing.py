"""Best-fit packing of token pieces by a grouping genetic algorithm.

Method.  Documents are tokenised; pieces shorter than a sequence are dealt at
random to shards of bounded size.  Every shard evolves on several islands, each
a task of its own: a population of packings starts from best fit over noisily
sorted pieces; crossover injects whole well-filled bins of one parent into the
other, removes the bins that hold duplicates and best-fits the displaced
pieces, largest first.  Between epochs each island's best packing migrates to
the next island.  Bins that stay poorly filled are packed again together with
those of other shards, until they fit one shard.
"""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import materialize, n_partitions, pick, process_cache, ranges, slices, word_codes

SEQUENCE = 4096
SHARD = 4096       # pieces evolved together
ISLANDS = 2
EPOCHS = 2         # each ends with a migration
GENERATIONS = 12   # of an epoch at most: it ends earlier
PATIENCE = 3       # after so many generations without a better packing
POPULATION = 4
CACHED_WORDS = 1_000_000  # a worker's token cache is emptied beyond this
SLICE_BYTES = 8 << 20   # text encoded at once
END_ID = 1

_PIECES = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _tokenizer(path: str):
    """(tokenizer, byte-level alphabet, bytes of every id, cache of words)."""
    cache = process_cache("tokenizers")
    if path not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        # the byte-level alphabet: printable bytes stand for themselves, others for characters from 256 on
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        tokenizer = Tokenizer.from_file(path)
        id_bytes = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        cache[path] = (tokenizer, {b: b if b in plain else next(others) for b in range(256)}, id_bytes, {"": b""})
    return cache[path]


def _learn(words: list[str], tokenizer, alphabet: dict, id_bytes: list, known: dict) -> None:
    """Encode words that are not known yet; one mark after a simple word is encoded apart.

    Simple are letters up to U+00FF: the tokenizer's normalisation is then
    lower-casing, and the word one run of tokens."""
    rest, marked, ids_of = [], [], tokenizer.model.tokenize

    def learn(word: str) -> None:
        low = word.lower()
        shown = low if low.isascii() else low.encode().decode("latin-1").translate(alphabet)
        known[word] = b"".join([id_bytes[x.id] for x in ids_of(shown)])

    for w in words:
        stem = w[:-1] if w[-1] in ",.;:!?" else w
        if not stem.isalpha() or not (stem.isascii() or max(stem) <= "\xff"):
            rest.append(w)
            continue
        if stem not in known:
            learn(stem)
        if stem is not w:
            marked.append(w)
    rest += list({w[-1] for w in marked} - known.keys())
    for w, x in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
        known[w] = b"".join([id_bytes[i] for i in x.ids])
    for w in marked:
        known[w] = known[w[:-1]] + known[w[-1]]


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(first token of each document with the end appended, ids).

    The tokenizer drops white space and lower-cases, so words are encoded on
    their own, A-Z in lower case, and each distinct word once per worker.  Texts
    that may hold special tokens, which are matched by case, stay as they are."""
    tokenizer, alphabet, id_bytes, known = _tokenizer(path)
    texts = pc.fill_null(texts, "")
    starts, codes, vocab = word_codes(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
    each = list(map(known.get, vocab))
    missing = [i for i, x in enumerate(each) if x is None]
    if missing:
        if len(known) > CACHED_WORDS:
            known.clear()
            known[""] = b""
            missing = [i for i, w in enumerate(vocab) if w]
        _learn([vocab[i] for i in missing], tokenizer, alphabet, id_bytes, known)
        for i in missing:
            each[i] = known[vocab[i]]
    sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
    flat = np.frombuffer(b"".join(each), dtype="<u4")
    first = np.cumsum(sizes) - sizes
    each_size = sizes[codes]
    ids = flat[ranges(first[codes], each_size)]
    total = np.concatenate([[0], np.cumsum(each_size)])
    return total[starts], ids


def _piece_pass(path: str, sequence: int):
    def run(batches):
        part, n = TaskContext.get().partitionId() << 40, 0
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                starts, ids = token_ids(batch.column("text"), path)
                rows = []
                for doc, a, b in zip(batch.column("doc_id").to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                    mine = np.append(ids[a:b], np.array(END_ID, "<u4")).astype("<u4")
                    for k, s in enumerate(range(0, len(mine), sequence)):
                        cut = mine[s:s + sequence]
                        rows.append((part + n, doc, k, s, len(cut), zlib.crc32(cut.tobytes())))
                        n += 1
                cols = list(zip(*rows)) if rows else [[]] * 6
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 ["row", "doc_id", "piece", "start", "length", "ids_crc32"])
    return run


class Packing:
    """Bins over pieces 0..n-1; best fit through a bit set of the free sizes in use."""

    def __init__(self, sizes, capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: dict[int, list[int]] = {}
        self.free: dict[int, int] = {}
        self.by_free: dict[int, set] = {}
        self.mask, self.next = 0, 0

    def _file(self, b: int, room: int) -> None:
        self.free[b] = room
        self.by_free.setdefault(room, set()).add(b)
        self.mask |= 1 << room

    def _unfile(self, b: int) -> int:
        room = self.free.pop(b)
        same = self.by_free[room]
        same.discard(b)
        if not same:
            del self.by_free[room]
            self.mask &= ~(1 << room)
        return room

    def add_bin(self, items: list[int]) -> None:
        b, self.next = self.next, self.next + 1
        self.bins[b] = list(items)
        self._file(b, self.capacity - sum(self.sizes[i] for i in items))

    def drop_bin(self, b: int) -> list[int]:
        self._unfile(b)
        return self.bins.pop(b)

    def best_fit(self, items) -> None:
        sizes = self.sizes
        for i in items:
            size = sizes[i]
            fits = self.mask >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                b = min(self.by_free[room])
                self._unfile(b)
                self.bins[b].append(i)
                self._file(b, room - size)
            else:
                self.add_bin([i])

    def fitness(self) -> tuple:
        """Fewer bins first, then bins as unevenly filled as possible."""
        return len(self.bins), -sum((self.capacity - x) ** 2 for x in self.free.values())

    def assignment(self) -> np.ndarray:
        out = np.zeros(len(self.sizes), dtype="<i4")
        for k, items in enumerate(self.bins.values()):
            out[items] = k
        return out


def _from_assignment(assignment: np.ndarray, sizes, capacity: int) -> Packing:
    p = Packing(sizes, capacity)
    order = np.argsort(assignment, kind="stable")
    cuts = np.flatnonzero(np.diff(assignment[order])) + 1
    for items in np.split(order, cuts):
        p.add_bin(items.tolist())
    return p


def crossover(a: Packing, b: Packing, rng: random.Random) -> Packing:
    """A child of a with a random half of b's well-filled bins."""
    well = sorted(b.bins, key=lambda k: (b.free[k], k))
    well = well[: max(1, len(well) // 2)]
    child = Packing(a.sizes, a.capacity)
    taken: set[int] = set()
    for k in rng.sample(well, max(1, len(well) // 2)):
        child.add_bin(b.bins[k])
        taken.update(b.bins[k])
    displaced: list[int] = []
    for items in a.bins.values():
        rest = [i for i in items if i not in taken]
        if len(rest) == len(items):
            child.add_bin(items)
        else:
            displaced += rest
    child.best_fit(sorted(displaced, key=lambda i: (-child.sizes[i], i)))
    return child


def dissolve(p: Packing, rng: random.Random) -> None:
    """Mutation: the emptiest bins and a few others are taken apart and best-fitted anew."""
    order = sorted(p.bins, key=lambda k: (-p.free[k], k))
    chosen = order[:3] + rng.sample(order, min(len(order), 2))
    loose = [i for k in dict.fromkeys(chosen) for i in p.drop_bin(k)]
    p.best_fit(sorted(loose, key=lambda i: (-p.sizes[i], i)))


def evolve(sizes, capacity: int, seed: int, best=None, guest=None, generations: int = GENERATIONS,
           population: int = POPULATION) -> np.ndarray:
    """Best assignment of one island, from its own best and a guest: generations until the least
    possible number of bins is reached, or no better packing comes, or there were enough."""
    rng = random.Random(seed)
    people = [_from_assignment(x, sizes, capacity) for x in (best, guest) if x is not None]
    bound = -(-sum(sizes) // capacity)
    while len(people) < population:
        noise = 0.0 if not people else 0.15
        order = sorted(range(len(sizes)), key=lambda i: (-sizes[i] * (1 + noise * rng.random()), i))
        p = Packing(sizes, capacity)
        p.best_fit(order)
        people.append(p)
    people.sort(key=Packing.fitness)
    idle = 0
    for _ in range(generations):
        if len(people[0].bins) <= bound or idle >= PATIENCE:
            break
        before, children = people[0].fitness(), []
        for _ in range(population // 2):
            a, b = rng.sample(people, 2)
            child = crossover(a, b, rng)
            dissolve(child, rng)
            children.append(child)
        people = sorted(people + children, key=Packing.fitness)[:population]
        idle = 0 if people[0].fitness() < before else idle + 1
    return people[0].assignment()


_STATE = "shard bigint, island int, rows binary, sizes binary, best binary"


def _island_pass(capacity: int, epoch: int):
    def run(batches):
        for batch in batches:
            for x in batch.to_pylist():
                sizes = np.frombuffer(x["sizes"], "<i4")
                packs = [None if x[k] is None else np.frombuffer(x[k], "<i4") for k in ("best", "guest")]
                seed = (x["shard"] * 31 + x["island"]) * 31 + epoch
                best = evolve(sizes.tolist(), capacity, seed, *packs)
                yield pa.RecordBatch.from_pylist([{k: x[k] for k in ("shard", "island", "rows", "sizes")}
                                                  | {"best": best.tobytes()}],
                                                 schema=pa.schema([("shard", pa.int64()), ("island", pa.int32()),
                                                                   ("rows", pa.binary()), ("sizes", pa.binary()),
                                                                   ("best", pa.binary())]))
    return run


def _gather(islands: int):
    """One shard's pieces to a record per island."""
    def run(key, group):
        group = group.sort_by("row")
        rows = group.column("row").to_numpy().astype("<i8").tobytes()
        sizes = group.column("length").to_numpy().astype("<i4").tobytes()
        return pa.table({"shard": pa.array([key[0].as_py()] * islands, pa.int64()),
                         "island": pa.array(range(islands), pa.int32()),
                         "rows": pa.array([rows] * islands, pa.binary()),
                         "sizes": pa.array([sizes] * islands, pa.binary()),
                         "best": pa.nulls(islands, pa.binary())})
    return run


def _place(batches):
    """Rows of the best packing: place of every piece and how full its bin is."""
    names = ["row", "sequence_id", "offset", "filled", "length"]
    for batch in batches:
        for x in batch.to_pylist():
            rows, sizes = np.frombuffer(x["rows"], "<i8"), np.frombuffer(x["sizes"], "<i4").astype(np.int64)
            bins = np.frombuffer(x["best"], "<i4")
            order = np.argsort(bins, kind="stable")
            rows, sizes, bins = rows[order], sizes[order], bins[order]
            first = np.flatnonzero(np.diff(bins, prepend=-1))
            before = np.cumsum(sizes) - sizes
            count = np.diff(np.append(first, len(bins)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(np.repeat(np.minimum.reduceat(rows, first), count)),
                 pa.array(before - np.repeat(before[first], count)),
                 pa.array(np.repeat(np.add.reduceat(sizes, first), count)), pa.array(sizes)], names)


def pack(items: DataFrame, capacity: int = SEQUENCE, shard: int = SHARD, islands: int = ISLANDS,
         epochs: int = EPOCHS) -> DataFrame:
    """items (row, length <= capacity) -> (row, sequence_id, offset).

    sequence_id is the smallest row in the sequence.  An empty table gives no rows.
    Poorly filled bins are packed again across shards as long as that fills half of
    their pieces well; what is left after that stays as its shard packed it.
    """
    spark, done, level = items.sparkSession, None, 0
    while True:
        n = items.count()
        shards = max(1, -(-n // shard))
        dealt = items.select("row", "length", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(shards)).alias("shard"))
        state = materialize(dealt.groupBy("shard").applyInArrow(_gather(islands), _STATE), "pack-islands")
        for epoch in range(epochs):
            guests = state.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"),
                                  F.col("best").alias("guest"))
            state = materialize(state.join(guests, ["shard", "island"])
                                .repartition(min(max(1, shards * islands), 4 * n_partitions(spark)), "shard", "island")
                                .mapInArrow(_island_pass(capacity, epoch), _STATE), "pack-islands")
        best = state.mapInArrow(_count_bins, "shard bigint, island int, bins bigint")
        best = best.groupBy("shard").agg(F.min(F.struct("bins", "island")).alias("m")).select(
            "shard", F.col("m.island").alias("island"))
        placed = materialize(state.join(best, ["shard", "island"]).mapInArrow(
            _place, "row bigint, sequence_id bigint, offset bigint, filled bigint, length bigint"), "pack-placed")
        good = placed if shards == 1 else placed.where(F.col("filled") >= F.lit(0.98 * capacity))
        good = good.select("row", "sequence_id", "offset")
        done = good if done is None else done.union(good)
        if shards == 1:
            return done
        rest = placed.where(F.col("filled") < F.lit(0.98 * capacity)).select("row", "length")
        items, level = rest, level + 1
        if level > 1 and rest.count() > n // 2:  # big pieces only: nothing more to gain
            return done.union(placed.where(F.col("filled") < F.lit(0.98 * capacity))
                              .select("row", "sequence_id", "offset"))


def _count_bins(batches):
    for batch in batches:
        bins = [int(np.frombuffer(x, "<i4").max(initial=-1)) + 1 for x in batch.column("best").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("island"), pa.array(bins, pa.int64())],
                                         ["shard", "island", "bins"])


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE,
                   tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and an end id; only one longer than a sequence
    is cut, at multiples of the sequence length.  Null text counts as empty: one
    piece of one id.  Null and repeated doc_ids are packed like others; extra
    columns are ignored; an empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()
    mine = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    pieces = materialize(mine.mapInArrow(_piece_pass(path, sequence), _PIECES), "pack-pieces")
    full = pieces.where(F.col("length") == sequence).select("row", F.col("row").alias("sequence_id"),
                                                            F.lit(0).cast("bigint").alias("offset"))
    placed = pack(pieces.where(F.col("length") < sequence).select("row", "length"), sequence)
    return pieces.join(full.union(placed), "row").drop("row")
