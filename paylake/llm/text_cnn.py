"""Toxicity by a convolutional text classifier, trained in numpy.

Method.  A word is embedded by hashed features (the word and its first and last
letters); filters of width 1, 2 and 3 run over the words, each is max-pooled
over the whole text and a logistic layer gives the score.  Embeddings start
from smoothed log-odds of the features over all labelled rows and are trained
together with filters and output by Adam.  A bounded sample gives the driver a start;
then every labelled row trains, parts of rows side by side, and after each
epoch the model is the mean of the parts' models (iterative parameter mixing).
Rows set aside, all counted, calibrate the score (0.3 is the best F1 cut overall) and a
threshold for each language.  Scoring is a pass over the table; language, source,
id and labels never enter a score.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize, pick, release_memory, slices, word_codes

TABLE = 1 << 15      # rows of the embedding table
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
PER_CLASS = 4000     # bound on the rows of each label that the start is trained on (in expectation)
MAX_CHARS = 20_000   # longer texts are not used for the start
EPOCHS, BATCH, RATE = 5, 64, 0.01
EPOCHS_WHOLE = 3     # passes over all labelled rows, whole texts
PART_ROWS = 8192     # rows, on average, that train one copy of the model between two means
FEW_LABELLED = 8     # rows of the table, for each that a part trains on, that one task may sort
BLOCK = 256          # rows of the table that are averaged together
STEPS = 256          # runs of scores to a unit of the logit, for thresholds
CUT = 0.3            # the calibrated decision threshold of the score
PAD = max(WIDTHS) - 1
_STRIP = ".,;:!?\"'()[]|"


def features(vocab: list[str]) -> np.ndarray:
    """(words, 5) rows of the embedding table for each word; the last row is for padding."""
    out = np.empty((len(vocab) + 1, 5), np.int64)
    digest = xxhash.xxh3_64_intdigest
    for i, word in enumerate(vocab):
        w = word.strip(_STRIP).lower() or word
        out[i] = (digest("w" + w) % TABLE, digest("3" + w[:3]) % TABLE, digest("4" + w[:4]) % TABLE,
                  digest("5" + w[:5]) % TABLE, digest("s" + w[-4:]) % TABLE)
    out[-1] = -1
    return out


def padded(starts: np.ndarray, codes: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes with PAD pad words after every document, new starts)."""
    n = len(starts) - 1
    fresh = starts + PAD * np.arange(n + 1)
    out = np.full(int(fresh[-1]), pad, np.int64)
    out[np.arange(len(codes)) + PAD * np.repeat(np.arange(n), np.diff(starts))] = codes
    return out, fresh


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.05, (TABLE + 1, DIM)).astype(np.float32)
        self.table[TABLE] = 0  # padding
        self.filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in self.filters:
            f[:, 0, : FILTERS // 2] = np.abs(f[:, 0, : FILTERS // 2]) + 0.5
        self.out = np.abs(rng.normal(0, 0.2, len(WIDTHS) * FILTERS)).astype(np.float32)
        self.bias = np.float32(-2.0)
        self.odds = np.zeros(TABLE, np.float32)  # that the table started from
        self.scale, self.shift = 1.0, 0.0  # calibration of the logit

    def embed(self, feats: np.ndarray) -> np.ndarray:
        out = self.table[feats].mean(axis=1)
        out[-1] = 0
        return out

    def pooled(self, embedded: np.ndarray, codes: np.ndarray, starts: np.ndarray, trace: bool = False):
        """(documents, filters) maxima over all places, 0 for texts without words; with trace also their places."""
        n = len(starts) - 1
        size = np.diff(starts) - PAD
        some = np.flatnonzero(size)
        out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        places = np.zeros(out.shape, np.int64)
        bounds = np.stack([starts[:-1][some], starts[:-1][some] + size[some]], axis=1).ravel()
        if not len(some):
            return out, places
        for k, f in enumerate(self.filters):
            part = [embedded @ f[j] for j in range(len(f))]
            z = np.zeros((len(codes) + 1, FILTERS), np.float32)  # one row more: reduceat bounds may end there
            for j, p in enumerate(part):
                z[: len(codes) - j] += p[codes[j:]]
            at = slice(k * FILTERS, (k + 1) * FILTERS)
            top = np.maximum.reduceat(z, bounds, axis=0)[::2]
            out[some, at] = top
            if trace:
                for i, d in enumerate(some):
                    a = starts[d]
                    places[d, at] = a + z[a: a + size[d]].argmax(axis=0)
        return out, places

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.out + self.bias

    def raw(self, texts: pa.Array) -> np.ndarray:
        """The logit before calibration."""
        starts, codes, vocab = word_codes(texts)
        codes, starts = padded(starts, codes, len(vocab))
        pooled, _ = self.pooled(self.embed(features(vocab)), codes, starts)
        return self.logits(pooled).astype(np.float64)

    def score(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.scale * self.raw(texts) + self.shift)


def _presence(feats, starts, codes, labels) -> tuple[np.ndarray, np.ndarray]:
    """Documents of label 1 and of label 0 that hold each table row."""
    one, zero = np.zeros(TABLE, np.int64), np.zeros(TABLE, np.int64)
    for d in range(len(labels)):
        rows = np.unique(feats[np.unique(codes[starts[d]:starts[d + 1]])])
        (one if labels[d] == 1 else zero)[rows] += 1
    return one, zero


def _log_odds(one: np.ndarray, zero: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Smoothed log-odds of each table row's presence in label 1 against label 0."""
    n1, n0 = max(1, n1), max(1, n0)
    odds = np.log((one + 0.5 * n1 / (n1 + n0)) / (n1 + 1)) - np.log((zero + 0.5 * n0 / (n1 + n0)) / (n0 + 1))
    return np.clip(odds * (one + zero >= 2), -4, 4).astype(np.float32)


class Trainer:
    """Adam over a model's parameters, a batch of documents at a time."""

    def __init__(self, model: Model):
        self.model, self.steps = model, 0
        self.moments = {k: [np.zeros_like(getattr(model, k)), np.zeros_like(getattr(model, k))] for k in ("table", "out", "bias")}
        self.conv = [[np.zeros_like(f), np.zeros_like(f)] for f in model.filters]
        self.moved = np.zeros(TABLE + 1, np.int64)  # batches that moved each row of the table

    def _adam(self, value, grad, state):
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.999 * state[1] + 0.001 * grad * grad
        return (value - RATE * (state[0] / (1 - 0.9 ** self.steps))
                / (np.sqrt(state[1] / (1 - 0.999 ** self.steps)) + 1e-8)).astype(np.float32)

    def step(self, starts: np.ndarray, codes: np.ndarray, feats: np.ndarray, labels: np.ndarray, docs: np.ndarray) -> None:
        model = self.model
        size = starts[docs + 1] - starts[docs]
        mine = np.concatenate([codes[starts[d]:starts[d + 1]] for d in docs]) if len(docs) else codes[:0]
        words, local = np.unique(mine, return_inverse=True)
        f = np.concatenate([feats[words], feats[-1:]])
        seq, at = padded(np.concatenate([[0], np.cumsum(size)]), local, len(words))
        emb = model.embed(f)
        pooled, places = model.pooled(emb, seq, at, trace=True)
        hidden = np.maximum(pooled, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.bias, -30, 30)))
        err = ((p - labels[docs]) / len(docs)).astype(np.float32)
        back = err[:, None] * model.out * (pooled > 0)
        grad_emb = np.zeros_like(emb)
        self.steps += 1
        for k, w in enumerate(model.filters):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            grad_w = np.zeros_like(w)
            for j in range(len(w)):
                where = np.minimum(places[:, cols] + j, len(seq) - 1)
                word = np.where(places[:, cols] + j < len(seq), seq[where], len(words))
                grad_w[j] = np.einsum("nfd,nf->df", emb[word], back[:, cols])
                np.add.at(grad_emb, word.ravel(), (back[:, cols, None] * w[j].T[None]).reshape(-1, DIM))
            model.filters[k] = self._adam(w, grad_w, self.conv[k])
        touched = np.flatnonzero(np.abs(grad_emb[:-1]).sum(axis=1))
        rows = f[touched].ravel()
        grad = np.zeros((len(rows), DIM), np.float32)
        grad[:] = np.repeat(grad_emb[touched] / f.shape[1], f.shape[1], axis=0)
        rows, inverse = np.unique(rows, return_inverse=True)
        total = np.zeros((len(rows), DIM), np.float32)
        np.add.at(total, inverse, grad)
        m, v = self.moments["table"]
        m[rows] = 0.9 * m[rows] + 0.1 * total
        v[rows] = 0.999 * v[rows] + 0.001 * total * total
        model.table[rows] -= 0.3 * RATE * m[rows] / (np.sqrt(v[rows]) + 1e-8)
        self.moved[rows] += 1
        model.out = self._adam(model.out, hidden.T @ err, self.moments["out"])
        model.bias = np.float32(self._adam(model.bias, err.sum(), self.moments["bias"]))


def train(texts: list[str], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    model, rng = Model(seed), np.random.default_rng(seed)
    starts, codes, vocab = word_codes(pa.array(texts, pa.string()))
    feats = features(vocab)
    if not len(labels) or labels.min() == labels.max():
        return model  # nothing to learn from: a constant-like score
    model.odds = _log_odds(*_presence(feats, starts, codes, labels), int(labels.sum()), int((labels == 0).sum()))
    model.table[:TABLE, 0] = model.odds / 2
    trainer = Trainer(model)
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for a in range(0, len(order), BATCH):
            trainer.step(starts, codes, feats, labels, order[a:a + BATCH])
    return model


def best_cut(high: np.ndarray, low: np.ndarray, hits: np.ndarray, n: np.ndarray) -> float:
    """The middle of the gap between scores at which F1 is best (0.5 without both labels), from runs of
    scores that don't overlap: their highest and lowest score, rows of label 1 and rows."""
    if not 0 < hits.sum() < n.sum():
        return 0.5
    order = np.argsort(-high, kind="stable")
    high, low, hits, n = high[order], low[order], hits[order], n[order]
    k = int((2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())).argmax())
    return float((low[k] + (high[k + 1] if k + 1 < len(high) else 0.0)) / 2)


def held_out():
    """Rows never learned from: crc32 of doc_id as text is 2 modulo 4."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def _labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict]:
    """(rows, their number by (aside, toxic)): every labelled row that may be learned from, written once.

    A row of each id and label, however often it is repeated.  ``part`` deals them into parts of
    about PART_ROWS, each in one run of one file; ``fold`` 0 is set aside for calibration.
    """
    marks = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("toxic in (0, 1) and doc_id is not null").where(~held_out()))
    parts = max(1, -(-marks.distinct().count() // PART_ROWS))
    # texts that may carry a label are moved once, with the labels and straight to their part, so no join
    # deals them anew; where labels are few beside the rows, more tasks share the texts
    tasks = max(parts, -(-docs.count() // (FEW_LABELLED * PART_ROWS)))
    row = F.when(F.col("text").isNotNull(), F.struct("text", "lang")).alias("row")
    texts = docs.where("doc_id is not null and text is not null").where(~held_out())
    both = (texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), row, F.lit(None).cast("int").alias("toxic"))
            .unionByName(marks.select("doc_id", "toxic"), allowMissingColumns=True))
    both = both.withColumn("task", F.pmod(F.hash("doc_id"), F.lit(tasks)))
    found = (both.repartitionById(tasks, F.col("task")).groupBy("task", "doc_id")
             .agg(F.min("row").alias("row"), *[F.count_if(F.col("toxic") == y).alias(f"of{y}") for y in (0, 1)]).where("row is not null"))
    given = F.filter(F.array(*[F.when(F.col(f"of{y}") > 0, F.lit(y)) for y in (0, 1)]), lambda y: y.isNotNull())
    rows = found.select("doc_id", "row.text", F.explode(given).alias("toxic"), "row.lang",
                        F.pmod(F.xxhash64("row.text", F.lit(1)), F.lit(5)).alias("fold"), F.pmod("task", F.lit(parts)).alias("part"))
    if tasks > parts:
        rows = rows.repartitionById(parts, F.col("part"))
    rows = rows.sortWithinPartitions("part", F.xxhash64("doc_id", F.lit(3)), "doc_id", "toxic")
    rows = materialize(rows, "labelled")
    count = {(r["aside"], r["toxic"]): r["n"] for r in
             rows.groupBy((F.col("fold") == 0).alias("aside"), "toxic").agg(F.count("*").alias("n")).collect()}
    return rows, count


def _whole_odds(rows: DataFrame, n1: int, n0: int) -> np.ndarray:
    """Log-odds of the table's rows over all documents: a task's counts are summed by table row."""
    def run(batches):
        one, zero = np.zeros(TABLE, np.int64), np.zeros(TABLE, np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                starts, codes, vocab = word_codes(batch.column("text"))
                a, b = _presence(features(vocab), starts, codes, batch.column("toxic").to_numpy())
                one += a
                zero += b
        some = np.flatnonzero(one + zero)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(one[some]), pa.array(zero[some])], ["row", "one", "zero"])

    seen = (rows.select("text", "toxic").mapInArrow(run, "row bigint, one bigint, zero bigint")
            .groupBy("row").agg(F.sum("one").alias("one"), F.sum("zero").alias("zero")).toArrow())  # TABLE rows at most
    one, zero = np.zeros(TABLE, np.int64), np.zeros(TABLE, np.int64)
    at = seen.column("row").to_numpy()
    one[at], zero[at] = seen.column("one").to_numpy(), seen.column("zero").to_numpy()
    return _log_odds(one, zero, n1, n0)


_MIXED = "block int, part int, weight binary, value binary"


def _blocks(trainer: Trainer, part: int, rows: int) -> pa.RecordBatch:
    """A trained part's parameters: blocks of the table with the weight of each row, and the rest as block -1."""
    model = trainer.model
    dense = np.concatenate([*[f.ravel() for f in model.filters], model.out, [model.bias]]).astype(np.float32)
    block, weight, value = [-1], [np.array([rows], np.int64).tobytes()], [dense.tobytes()]
    for a in range(0, TABLE, BLOCK):
        moved = trainer.moved[a:min(a + BLOCK, TABLE)]
        if moved.any():  # others would weigh nothing
            block.append(a // BLOCK)
            weight.append(moved.tobytes())
            value.append(model.table[a:min(a + BLOCK, TABLE)].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(np.full(len(block), part, np.int32)),
                                       pa.array(weight, pa.binary()), pa.array(value, pa.binary())], ["block", "part", "weight", "value"])


def _train_parts(model: Model):
    """Each part trains a copy of the model on all of its rows, batch by batch as they are read."""
    def run(batches):
        part, trainer, rows = None, None, 0
        for whole in batches:
            for batch in slices(whole, "text"):
                parts = batch.column("part").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
                for a, b in zip(cuts, cuts[1:]):
                    if parts[a] != part:
                        if trainer:
                            yield _blocks(trainer, part, rows)
                        part, trainer, rows = int(parts[a]), Trainer(copy.deepcopy(model)), 0
                    piece = batch.slice(a, b - a)
                    starts, codes, vocab = word_codes(piece.column("text"))
                    feats, labels = features(vocab), piece.column("toxic").to_numpy()
                    for i in range(0, b - a, BATCH):
                        trainer.step(starts, codes, feats, labels, np.arange(i, min(i + BATCH, b - a)))
                    rows += b - a
        if trainer:
            yield _blocks(trainer, part, rows)
    return run


def _mean_block(table: pa.Table) -> pa.Table:
    """The weighted mean of a block over all parts, in the order of the parts; weights 0 where no part moved a row."""
    table = table.sort_by([("part", "ascending"), ("weight", "ascending"), ("value", "ascending")])
    total, mean = 0, 0.0
    for weight, value in zip(table.column("weight"), table.column("value")):
        w = np.frombuffer(weight.as_py(), np.int64)
        total = total + w
        mean = mean + w[:, None] * np.frombuffer(value.as_py(), np.float32).reshape(len(w), -1).astype(np.float64)
    mean = (mean / np.maximum(total, 1)[:, None]).astype(np.float32)
    return pa.table({"block": table.column("block")[:1], "part": pa.array([0], pa.int32()),
                     "weight": pa.array([total.tobytes()], pa.binary()), "value": pa.array([mean.tobytes()], pa.binary())})


def _mix(model: Model, rows: DataFrame) -> None:
    """One epoch over all rows: parts train side by side and the model becomes their mean, each table
    row's over the parts that moved it."""
    trained = rows.select("part", "text", "toxic").mapInArrow(_train_parts(model), _MIXED)
    for r in trained.groupBy("block").applyInArrow(_mean_block, _MIXED).collect():  # the size of one model
        weight, value = np.frombuffer(r["weight"], np.int64), np.frombuffer(r["value"], np.float32)
        if r["block"] < 0:
            sizes = np.cumsum([f.size for f in model.filters])
            *filters, rest = np.split(value, sizes)
            model.filters = [part.reshape(f.shape).copy() for part, f in zip(filters, model.filters)]
            model.out, model.bias = rest[:-1].copy(), np.float32(rest[-1])
        else:
            at = r["block"] * BLOCK + np.flatnonzero(weight)
            model.table[at] = value.reshape(len(weight), DIM)[weight > 0]


def _runs(model: Model, rows: DataFrame) -> DataFrame:
    """(lang, run, n, hits, low, high): the rows counted by language and by logit, in steps of 1 / STEPS."""
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                z = pa.array(np.clip(model.raw(batch.column("text")), -40, 40))
                yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("toxic"), z], ["lang", "toxic", "z"])

    scored = rows.select("text", F.coalesce("lang", F.lit("")).alias("lang"), "toxic").mapInArrow(run, "lang string, toxic int, z double")
    return materialize(scored.groupBy("lang", F.floor(F.col("z") * STEPS).alias("run")).agg(
        F.count("*").alias("n"), F.sum("toxic").alias("hits"), F.min("z").alias("low"), F.max("z").alias("high")), "score-runs")


def _cut(runs: pa.Table, shift: float) -> float:
    high, low = (sigmoid(runs.column(c).to_numpy() + shift) for c in ("high", "low"))
    return best_cut(high, low, runs.column("hits").to_numpy(), runs.column("n").to_numpy())


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[Model, dict]:
    """(model, threshold by language) from all labelled rows that aren't held out, whole texts.

    The driver trains a start on a bounded sample.  Its log-odds are then replaced by those over all
    rows, and all rows train it in EPOCHS_WHOLE epochs (:func:`_mix`).  Thresholds come from all
    rows set aside, counted by score.  Rows without text, id or label are not used.  Languages with under 20 rows
    of either label among the calibration rows use the overall threshold.
    """
    rows, count = _labelled(docs, labels)
    n = {y: count.get((True, y), 0) + count.get((False, y), 0) for y in (0, 1)}
    learn = rows.where("fold <> 0") if count.get((False, 0)) and count.get((False, 1)) else rows
    check = rows.where("fold = 0") if count.get((True, 0)) and count.get((True, 1)) else rows
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.when(F.col("toxic") == 1, share < min(1.0, per_class / max(1, n[1]))).otherwise(share < min(1.0, per_class / max(1, n[0])))
    sample = (learn.where(chosen).where(F.length("text") <= MAX_CHARS).select("doc_id", "text", "toxic").toArrow()
              .sort_by([("doc_id", "ascending"), ("text", "ascending"), ("toxic", "ascending")]))
    model = train(sample.column("text").to_pylist(), sample.column("toxic").to_numpy().astype(np.int64))
    del sample
    if n[0] and n[1]:
        mine = {y: count.get((False, y), 0) for y in (0, 1)} if count.get((False, 0)) and count.get((False, 1)) else n
        odds = _whole_odds(learn, mine[1], mine[0])
        model.table[:TABLE, 0] += (odds - model.odds) / 2
        model.odds = odds
        for _ in range(EPOCHS_WHOLE):
            _mix(model, learn)
    runs = _runs(model, check)
    overall = runs.groupBy("run").agg(*[f(c).alias(c) for f, c in ((F.sum, "n"), (F.sum, "hits"), (F.min, "low"), (F.max, "high"))]).toArrow()
    cut = min(max(_cut(overall, 0.0), 1e-6), 1 - 1e-6)
    logit = lambda p: float(np.log(p / (1 - p)))
    model.shift = shift = logit(CUT) - logit(cut)

    def of_language(mine: pa.Table) -> pa.Table:
        return pa.table({"lang": mine.column("lang")[:1], "threshold": pa.array([_cut(mine, shift)], pa.float64())})

    known = runs.groupBy("lang").agg(F.sum("n").alias("_n"), F.sum("hits").alias("_h")).where("_h >= 20 and _n - _h >= 20").select("lang")
    own = runs.join(known, "lang").groupBy("lang").applyInArrow(of_language, "lang string, threshold double")
    thresholds = {r["lang"]: r["threshold"] for r in own.orderBy("lang").collect()}
    for written in (rows, runs):
        discard(written)
    release_memory()  # the driver goes on with later stages
    return model, thresholds


def _score_pass(model: Model):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                score = pa.array(model.score(batch.column("text")), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "score"])
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    lang: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, threshold, rejected.

    predicted is score >= 0.3; threshold is the language's own and rejected is
    score >= threshold.  Null texts are scored as empty; null ids, repeated rows
    and unknown languages are scored like others; extra columns are ignored;
    an empty table gives no rows, empty labels give an untrained score.
    """
    mine = pick(docs, doc_id=doc_id, text=text, lang=lang).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    model, thresholds = fit(mine, labels)
    scored = mine.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang").mapInArrow(
        _drop_text(model), "doc_id bigint, lang string, score double")
    own = F.lit(CUT)
    for name, value in thresholds.items():
        own = F.when(F.coalesce("lang", F.lit("")) == name, F.lit(value)).otherwise(own)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"),
                         own.alias("threshold"), (F.col("score") >= own).alias("rejected"))


def _drop_text(model: Model):
    inner = _score_pass(model)

    def run(batches):
        for batch in inner(batches):
            yield batch.select(["doc_id", "lang", "score"])
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with all columns, whose score stays under their language's threshold."""
    mine = pick(docs, doc_id="doc_id", text="text", lang="lang").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    model, thresholds = fit(mine, labels)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                own = np.array([thresholds.get(x or "", CUT) for x in batch.column("lang").to_pylist()])
                yield batch.filter(pa.array(model.score(batch.column("text")) < own))

    return docs.mapInArrow(run, docs.schema)
