"""Helpers shared by the operators: tables, scratch writes, word hashing."""

from __future__ import annotations

import ctypes
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake.config import scratch_dir, shuffle_partitions

#: White space that separates words: space and \t \n \v \f \r.
SPACE = "[\\x20\\x09-\\x0D]+"
_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)  # odd, so invertible modulo 2^64


ARROW_ROWS = 2000  # rows per Arrow batch: bounds a worker's memory also where every text is long


def tune(spark: SparkSession) -> None:
    """Session setting that the operators' memory bounds rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, and
    freezes values such as row numbers so that retries cannot change them."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(written: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    spark = written.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in written.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def n_partitions(spark: SparkSession) -> int:
    return shuffle_partitions(spark)


def process_cache(name: str) -> dict:
    """A dict that the Python worker process keeps until another one is asked for:
    a reused worker doesn't carry the caches of one operator through the next."""
    holder = sys.modules.setdefault("_llm_process_cache", types.ModuleType("_llm_process_cache"))
    caches = holder.__dict__.setdefault("caches", {})
    if name not in caches:
        caches.clear()
    return caches.setdefault(name, {})


def release_memory() -> None:
    """Give freed memory back to the system: a reused worker would hold it through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20):
    """Cut a batch into runs of rows whose text stays near max_bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // max_bytes
    cuts = np.flatnonzero(np.diff(group)) + 1
    start = 0
    for end in [*cuts.tolist(), batch.num_rows]:
        if end > start:
            yield batch.slice(start, end - start)
        start = end
    release_memory()


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix constants)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(30))
        x = x * _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2^64, kept per process and grown on demand."""
    cache = process_cache("powers")
    have = cache.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        have[1:] = _U(base)
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(have)
        cache[base] = have
    return have[:n]


#: Scripts written without spaces: every character of theirs is a word.
_UNSPACED = ((0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x19E0), (0x1A20, 0x1AB0), (0x1B00, 0x1B80),
             (0x3005, 0x3008), (0x3040, 0x3130), (0x31A0, 0x31C0), (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA4D0),
             (0xA980, 0xAA00), (0xAA60, 0xAAE0), (0xF900, 0xFB00), (0x16FE0, 0x18D80), (0x1AFF0, 0x1B300), (0x20000, 0x40000))


def _char_kinds() -> np.ndarray:
    """Per code point the characters it becomes: 0 ignorable, 1 part of a word,
    3 a word of its own between blanks; -1 a blank in its place."""
    cache = process_cache("powers")  # used along with them
    if "kinds" not in cache:
        of = {"L": 1, "M": 1, "N": 1, "S": 3, "Sk": -1, "Cf": 0}  # Sk: accents that stand alone
        names = [unicodedata.category(chr(c)) for c in range(0x110000)]
        kinds = np.array([of.get(x, of.get(x[0], -1)) for x in names], np.int8)
        kinds[[*range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]] = 0  # variation selectors
        for a, b in _UNSPACED:
            kinds[a:b][kinds[a:b] == 1] = 3
        kinds[:128] = [1 if chr(c).isalnum() else -1 for c in range(128)]
        cache["kinds"] = kinds
    return cache["kinds"]


def fold(text: bytes) -> bytes:
    """Text in compatibility form (NFKC) and full case folding, with blanks for what is not part
    of a word and around each symbol and character of a script written without spaces."""
    if text.isascii():  # folded by the byte table
        return text
    whole = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text.decode("utf-8", "replace")).casefold())
    codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kind = _char_kinds()[codes]
    room = np.abs(kind).astype(np.int64)
    out = np.full(int(room.sum()), 0x20, np.uint32)
    kept = kind > 0
    out[(np.cumsum(room) - room + (kind == 3))[kept]] = codes[kept]
    return out.tobytes().decode("utf-32-le").encode()


def fold_texts(texts: pa.Array) -> pa.Array:
    if pc.all(pc.string_is_ascii(texts), min_count=0).as_py() is not False:
        return texts
    return pa.array([x if x is None else fold(x) for x in texts.cast(pa.large_binary()).to_pylist()],
                    pa.large_binary()).cast(pa.large_string())


def _byte_tables(folded: bool) -> tuple[np.ndarray, np.ndarray]:
    """(random value per byte, is-word-byte).  folded: words are runs of ASCII
    letters (case folded), digits and the non-ASCII bytes that ``fold`` leaves; else runs of non-space."""
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
    word = np.ones(256, dtype=bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    if folded:
        word[:128] = False
        for a, b in ((48, 58), (65, 91), (97, 123)):
            word[a:b] = True
        values[65:91] = values[97:123]
    return values, word


def raw_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; null counts as empty."""
    texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    buf = texts.buffers()
    offsets = np.frombuffer(buf[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(buf[2], dtype=np.uint8)[offsets[0]:offsets[-1]] if buf[2] else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def word_hashes(texts: pa.Array, folded: bool = False, compat: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each document with the end appended, 64-bit hash of every word).

    A polynomial hash over random byte values, taken from prefix sums, so a
    whole batch is hashed without a Python loop (folded: one per text that isn't ASCII).
    Without ``compat`` only A-Z are folded and every other non-ASCII byte belongs to a word as it is.
    """
    if folded and compat:
        texts = fold_texts(texts)
    offsets, data = raw_buffers(texts)
    values, word = _byte_tables(folded)
    n = len(data)
    if n == 0:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint64)
    inside = word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts_at = offsets[:-1][offsets[:-1] < n]
    first[starts_at] = inside[starts_at]  # a document's first byte starts a word of its own
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_at = offsets[1:][offsets[1:] > 0] - 1
    last[ends_at] = inside[ends_at]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    base = int(_MULT)
    with np.errstate(over="ignore"):
        prefix = np.empty(n + 1, dtype=np.uint64)
        prefix[0] = 0
        np.cumsum(values[data] * _powers(n, base), out=prefix[1:])
        h = (prefix[e] - prefix[s]) * _powers(n, pow(base, -1, 1 << 64))[s]
    return np.searchsorted(s, offsets).astype(np.int64), mix(h + (e - s).astype(np.uint64))


def ngram_hashes(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of the n words that start at each position (the last n-1 are dropped)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out += words[j: len(words) - n + 1 + j] * mix(np.array([2 * j + 1 + (salt << 8)], np.uint64))[0]
    return mix(out)


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(starts per document with the end appended, code of every word, distinct words).

    Words are runs of non-space; null has none."""
    parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(parts.flatten())
    codes = coded.indices.to_numpy(zero_copy_only=False)
    vocab = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    if "" in vocab:  # an empty text splits to one empty word
        keep = codes != vocab.index("")
        lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[keep], minlength=len(lengths))
        codes = codes[keep]
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), codes, vocab


def doc_of(starts: np.ndarray) -> np.ndarray:
    """Document index of every word, from the starts that word_hashes returns."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices start, start+1, .. start+length-1 of each range, concatenated."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)


def text_key(column) -> object:
    """Content fingerprint used, with doc_id, to name a row without numbering rows."""
    return F.xxhash64(F.coalesce(column, F.lit("")))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the named input columns under fixed names; other columns, also
    ones whose names would clash with an operator's own, are left behind."""
    return df.select(*[F.col(f"`{c}`").alias(k) for k, c in columns.items()])
