"""The toxicity model learns from every labelled row and from whole texts, also where parts are many."""

import os
import random
import zlib

import numpy as np
import pytest

from paylake.config import checkpoint_root
from paylake.llm import text_cnn


def prose(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.mark.parametrize("part_rows", [8192, 300])
def test_words_outside_the_start_are_learned(spark, monkeypatch, part_rows):
    """40 marks of 8 rows or so each: a start on 20 rows of a label holds half of them at most."""
    monkeypatch.setattr(text_cnn, "PART_ROWS", part_rows)
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1600):
        words = prose(rng, 30)
        if i % 4 == 0:
            words[rng.randrange(30)] = f"{'abcdefghij'[i // 4 % 10] * 3}{'klmn'[i // 40 % 4] * 4}"
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model, _ = text_cnn.fit(docs, marks, per_class=20)
    again, _ = text_cnn.fit(docs.repartition(3), marks, per_class=20)
    mine = [r for r in rows if held(r[0])]
    score = model.score(text_cnn.pa.array([r[1] for r in mine]))
    right = [(s >= text_cnn.CUT) == (r[0] % 4 == 0) for s, r in zip(score, mine)]
    assert sum(right) > 0.95 * len(right)
    assert np.array_equal(score, again.score(text_cnn.pa.array([r[1] for r in mine])))


def test_whole_texts_are_learned(spark):
    """The mark stands behind 20,000 characters of every toxic text."""
    rng = random.Random(9)
    rows = [(i, " ".join(prose(rng, 5200) + (["zzzmark"] if i % 2 else []) + prose(rng, 3)), "en") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id bigint, toxic int")
    model, _ = text_cnn.fit(docs, marks)
    score = model.score(text_cnn.pa.array(["w1 w2 zzzmark w3", "w1 w2 w3 w4"]))
    assert score[0] > text_cnn.CUT > score[1]


def test_thresholds_count_all_rows_set_aside(spark):
    low, high = np.array([0.1, 0.4, 0.6, 0.9]), np.array([0.2, 0.5, 0.7, 0.95])
    assert text_cnn.best_cut(high, low, np.array([0, 1, 5, 9]), np.array([90, 2, 5, 9])) == pytest.approx(0.3)
    assert text_cnn.best_cut(high, low, np.array([0, 0, 0, 0]), np.array([1, 1, 1, 1])) == 0.5


@pytest.mark.parametrize("few", [8, 1])
def test_a_part_is_one_run_of_one_file_whatever_the_join(spark, monkeypatch, few):
    """A part spread over files would train, and write, a model in each."""
    monkeypatch.setattr(text_cnn, "PART_ROWS", 300)
    monkeypatch.setattr(text_cnn, "FEW_LABELLED", few, raising=False)
    rng = random.Random(10)
    docs = spark.createDataFrame([(i, " ".join(prose(rng, 8)), "en") for i in range(4000)], "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame([(i, y) for i in range(1500) for y in {i % 3 == 0, i % 50 == 0}], "doc_id bigint, toxic boolean")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        rows, count = text_cnn._labelled(docs, marks.unionByName(marks))
        files = rows.select("part", text_cnn.F.input_file_name().alias("file")).distinct().groupBy("part").agg(text_cnn.F.count("*").alias("n")).collect()
        models = rows.select("part", "text", "toxic").mapInArrow(text_cnn._train_parts(text_cnn.Model()), text_cnn._MIXED).where("block = -1").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(files) > 2 and {f["n"] for f in files} == {1} and models == len(files)
    want = sorted((i, int(y)) for i in range(1500) if not held(i) for y in {i % 3 == 0, i % 50 == 0})
    assert sorted((r["doc_id"], r["toxic"]) for r in rows.collect()) == want
    assert sum(count.values()) == len(want)


def test_fit_leaves_no_scratch(spark):
    """The labelled texts are not needed once the model is there."""
    root = checkpoint_root(spark).removeprefix("file://").removeprefix("file:")
    rows = [(i, "bad word" if i % 2 else "good word", "en") for i in range(40)]
    before = set(os.listdir(f"{root}/paylake")) if os.path.exists(f"{root}/paylake") else set()
    text_cnn.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"),
                 spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int"))
    assert set(os.listdir(f"{root}/paylake")) == before
