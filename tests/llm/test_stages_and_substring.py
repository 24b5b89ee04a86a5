"""Pipeline stages with clashing columns, and substring removal bucket by bucket."""

import random

import pytest
from pyspark.sql import functions as F

from paylake.llm import queries, substring, text_cnn
from paylake.llm.common import materialize

CLASH = ["toxic", "fold", "score", "rank", "key", "tkey", "id", "row", "label", "bucket", "comp", "kept"]


def prose(rng, n, vocabulary=2000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, at = random.Random(3), tmp_path_factory.mktemp("stages")
    rows = []
    for i in range(240):
        words = prose(rng, 30 + i % 40).split()
        if i % 4 == 0:
            words[rng.randrange(len(words))] = "scum"
        rows.append((i, " ".join(words), "en", "s", 1))
    rows += [(300, rows[1][1], "en", "s", 1), (301, None, None, None, None), (302, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)], "doc_id bigint, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, prose(rng, 30))], "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), docs


def test_stages_keep_clashing_columns(spark, tables):
    """Every stage gives the rows that it gives without them, and returns them unchanged."""
    import corpus_pipeline

    sf_dir, docs = tables
    clash = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASH})
    for name, stage in corpus_pipeline.STAGES:
        plain, own = stage(spark, docs, sf_dir), stage(spark, clash, sf_dir)
        if name == "packing":
            assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in plain.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in own.collect())
            continue
        assert own.columns == clash.columns
        got = {r.doc_id: tuple(r[c] for c in CLASH) for r in own.collect()}
        assert set(got) == {r.doc_id for r in plain.collect()}
        assert all(v == tuple(f"{c}{k}" for c in CLASH) for k, v in got.items())
        docs, clash = materialize(plain, "plain"), materialize(own, "clash")


def test_sample_holds_a_repeated_id_once(spark, tables, monkeypatch):
    _, docs = tables
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)], "doc_id bigint, toxic int")
    many = docs.unionByName(docs.where("doc_id = 4").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("again"))
    sizes = []
    train = text_cnn.train
    monkeypatch.setattr(text_cnn, "train", lambda texts, y: sizes.append(len(y)) or train(texts, y))
    text_cnn.fit(many, labels)
    assert sizes[0] < 240


def brute_kept(rows, window=13):
    first = {}
    for doc, text in rows:
        words = (text or "").split()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            first[w] = min(first.get(w, doc), doc)
    out = {}
    for doc, text in rows:
        words = (text or "").split()
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < doc:
                gone.update(range(i, i + window))
        out[doc] = " ".join(w for i, w in enumerate(words) if i not in gone)
    return out


@pytest.mark.parametrize("bucket_bytes,slice_bytes", [(4 << 20, 3 << 20), (200, 1 << 12)])
def test_substring_by_buckets(spark, monkeypatch, bucket_bytes, slice_bytes):
    monkeypatch.setattr(substring, "BUCKET_BYTES", bucket_bytes)  # small: many buckets, batches of a few documents
    monkeypatch.setattr(substring, "SLICE_BYTES", slice_bytes)
    rng = random.Random(9)
    passage, line = prose(rng, 60), prose(rng, 14)
    rows = [(i, prose(rng, rng.randint(0, 60)) + (" " + passage if i % 3 == 0 else "") + " " + prose(rng, 20, 30)) for i in range(120)]
    rows += [(200 + i, " ".join(passage.split()[i:i + 13 + i])) for i in range(20)] + [(300 + i, line + f" x{i} " + line) for i in range(10)]
    rows += [(400, prose(rng, 20000)), (401, "a " * 15000), (402, "a " * 12), (403, "a " * 13), (404, None), (405, "")]
    rows += [(406, rows[-6][1])]
    rng.shuffle(rows)
    got = substring.substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert {r.doc_id: r.kept_text for r in got} == brute_kept(rows)


def test_all_dealt_queries_are_registered():
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in queries.QUERIES)] == []
