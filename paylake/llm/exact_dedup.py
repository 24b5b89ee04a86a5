"""Exact deduplication by Grace hashing.

Method.  Texts are normalised and fingerprinted by Spark.  A first pass over
the input partitions keeps one full record per distinct content that a bounded
open-addressing table sees (so a text that fills a third of the table shrinks
before any shuffle) and writes records and row links to the shared folder.
The records are then dealt to buckets by fingerprint; each bucket builds an
open-addressing table that compares complete contents.  A record that finds
its bucket's table full goes to the next spill table and is dealt anew under
another hash, until nothing spills.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import SPACE, materialize, mix, n_partitions, pick

TABLE_BYTES = 48 << 20  # content held by one open-addressing table


class ContentTable:
    """Open addressing with linear probing; equal only if the contents are equal."""

    def __init__(self, budget: int):
        self.budget, self.used = budget, 0
        self.slots = np.full(1024, -1, dtype=np.int64)
        self.prints: list[int] = []
        self.contents: list[bytes] = []

    def _probe(self, mark: int, content: bytes) -> tuple[int, int]:
        """(slot, entry) where the content is or would go (entry -1)."""
        mask = len(self.slots) - 1
        at = mark & mask
        while True:
            entry = int(self.slots[at])
            if entry < 0 or (self.prints[entry] == mark and self.contents[entry] == content):
                return at, entry
            at = (at + 1) & mask

    def add(self, mark: int, content: bytes) -> tuple[int, bool]:
        """(entry, is it new); entry -1 if the content is new and the table is full."""
        at, entry = self._probe(mark, content)
        if entry >= 0:
            return entry, False
        if self.contents and self.used + len(content) > self.budget:
            return -1, False
        self.slots[at] = entry = len(self.contents)
        self.prints.append(mark)
        self.contents.append(content)
        self.used += len(content) + 64
        if 2 * len(self.contents) > len(self.slots):
            old = self.slots[self.slots >= 0]
            self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
            mask = len(self.slots) - 1
            for x in old.tolist():
                at = self.prints[x] & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = x
        return entry, True


_FIRST = "row bigint, rep bigint, doc_id bigint, sha string, mark bigint, text string"
_NEXT = "rep bigint, same bigint, mark bigint, text string"


def _marks(batch: pa.RecordBatch, level: int) -> list[int]:
    raw = batch.column("mark").to_numpy().view(np.uint64)
    with np.errstate(over="ignore"):
        return mix(raw + np.uint64(level * 0x9E3779B9)).tolist()


def _first_pass(budget: int):
    """Number the rows and keep the text of one row per content seen; the others
    point to it.  A full table is dropped for a new one, which only costs a
    record more for some contents."""
    def run(batches):
        part, n = TaskContext.get().partitionId() << 40, 0
        seen, rows = ContentTable(budget), []
        for batch in batches:
            reps, kept = [], []
            for i, (mark, text) in enumerate(zip(_marks(batch, 0), batch.column("text").cast(pa.binary()))):
                content = text.as_py()
                entry, new = seen.add(mark, content)
                if entry < 0:
                    seen, rows = ContentTable(budget), []
                    entry, new = seen.add(mark, content)
                if new:
                    rows.append(part + n + i)
                reps.append(rows[entry])
                kept.append(i if new else None)
            row = pa.array(np.arange(part + n, part + n + batch.num_rows))
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(reps, pa.int64()), batch.column("doc_id"), batch.column("sha"), batch.column("mark"),
                 batch.column("text").take(pa.array(kept, pa.int64()))],
                ["row", "rep", "doc_id", "sha", "mark", "text"])
    return run


def _bucket_pass(level: int, budget: int):
    """Link each record of this task's buckets to the first record with equal
    content; records that meet a full table are passed on with same = null."""
    def run(batches):
        table, rows = ContentTable(budget), []
        for batch in batches:
            texts, same = batch.column("text").cast(pa.binary()), []
            for mark, text, rep in zip(_marks(batch, level), texts, batch.column("rep").to_pylist()):
                entry, new = table.add(mark, text.as_py())
                if new:
                    rows.append(rep)
                same.append(rows[entry] if entry >= 0 else None)
            spilled = pa.array([i if x is None else None for i, x in enumerate(same)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(same, pa.int64()), batch.column("mark"),
                                              batch.column("text").take(spilled)], ["rep", "same", "mark", "text"])
    return run


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Equal means identical after each run of white space became one space; null
    counts as empty.  The smallest doc_id stays (null ids last); of repeated
    rows with that id exactly one has kept = true.  Extra columns are ignored,
    an empty table gives no rows.
    """
    spark, n = docs.sparkSession, n_partitions(docs.sparkSession)
    norm = pick(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ").alias("text"))
    norm = norm.select("doc_id", F.sha2("text", 256).alias("sha"), F.xxhash64("text").alias("mark"), "text")
    first = materialize(norm.mapInArrow(_first_pass(table_bytes), _FIRST), "dedup-first")
    records, same, level = first.where("text is not null").select("rep", "mark", "text"), None, 0
    while True:
        n_buckets = n << min(12, 2 * level)
        dealt = records.repartition(n_buckets, F.xxhash64("mark", F.lit(level)))
        step = materialize(dealt.mapInArrow(_bucket_pass(level, table_bytes), _NEXT), f"dedup-spill-{level}")
        done = step.where("same is not null").select("rep", "same")
        same = done if same is None else same.union(done)
        records = step.where("same is null").select("rep", "mark", "text")
        if records.select("rep").isEmpty():
            break
        level += 1
    sizes = first.groupBy("rep").agg(F.count("*").alias("n"),
                                     F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("low"))
    groups = sizes.join(same, "rep").groupBy("same").agg(F.sum("n").alias("group_size"), F.min("low").alias("low"))
    found = same.join(groups, "same").select("rep", "group_size", F.col("low.doc_id").alias("keep_id"),
                                             F.col("low.row").alias("keep_row"))
    return first.select("row", "rep", "doc_id", "sha").join(found, "rep").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The kept rows of documents with all their columns.

    Rows are matched by digest and doc_id; of rows that repeat both, one stays.
    """
    def key(sha):
        return F.concat(sha, F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))

    kept = exact_dedup(docs).where("kept").select(key(F.col("text_sha256")).alias("__exact"))
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " "), 256)
    return (docs.withColumn("__exact", key(sha)).join(kept, "__exact", "left_semi")
            .dropDuplicates(["__exact"]).drop("__exact"))
