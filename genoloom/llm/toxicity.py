"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of two rows picked by two hashes, so two words share a vector only if
both hashes meet. Filters of several widths run over the words, each keeps its largest response in
the text (max pooling), and a logistic layer gives the score; it is worked out from the words alone.

All labelled texts outside the held-out fold are learnt from. They are cut into two halves with a
model each: tasks train on their own rows from a common start, and their weights are averaged after
each round. Each half sets the scale of the other half's model, a text's score is the mean of both,
and thresholds of the reported flag, by language, come from the scores of all these texts under the
model that did not see them.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoloom.llm.common import settle, whole
from genoloom.llm.tokens import held, slices, values

ROWS = 1 << 17  # embedding rows of each hash
WIDTH = 8
FILTER_WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
ROUNDS = 4  # of training and averaging
STEPS_TEXTS = 30_000  # fewer texts than a quarter of these are gone over repeatedly in a round
REPEATS = 5  # at most
HALVES = 2
CELLS = 1000  # thresholds are counted in cells of the score
DROPPED = 0.5  # share of words left out at each step, so that no single cue is relied on
BATCH = 32
RATE = 0.01
ROW_RATE = 0.05
FOLDS, HELD_OUT = 3, 1  # rows whose crc32(doc_id) mod 3 is 1 are never learnt from
CUT = 0.7

# ASCII characters that are not letters or digits separate words; A-Z are lower-cased.
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def word_rows(text: str) -> np.ndarray:
    """(2, n) embedding rows of the words of a text."""
    words = text.lower().encode().translate(_TABLE).split()
    a = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    b = np.fromiter(map(zlib.adler32, words), np.int64, len(words))
    mixed = (a * 0x9E3779B1 + b * 0x85EBCA6B) >> 7
    return np.stack([a % ROWS, mixed % ROWS])


@dataclass
class Model:
    """Weights: embeddings of both hashes, filters per width, biases, output layer."""

    rows: list[np.ndarray]
    filters: list[np.ndarray]  # (width, WIDTH, FILTERS) each
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Scores of texts given as word rows, all in one run; a text without words has no responses."""
        pooled = self.pool(texts)[0].astype(float)
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * (np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias) + b, -30, 30)))

    def pool(self, texts: list[np.ndarray], where: bool = False) -> tuple[np.ndarray, tuple | None]:
        """Largest filter responses per text, and where they were if asked for.

        Texts are laid one after another with a gap of zero vectors, so that no filter spans two.
        """
        gap = max(FILTER_WIDTHS)
        sizes = np.array([t.shape[1] for t in texts])
        starts = np.concatenate([[0], np.cumsum(sizes + gap)])[:-1]
        x = np.zeros((int((sizes + gap).sum()) + gap, WIDTH), np.float32)
        place = np.concatenate([np.arange(n) + s for n, s in zip(sizes, starts, strict=True)]).astype(int)
        rows = np.concatenate(texts, axis=1).astype(int)
        x[place] = self.rows[0][rows[0]] + self.rows[1][rows[1]]
        pooled, at = [], []
        for f in self.filters:
            z = sum(x[k : len(x) - gap + k] @ f[k] for k in range(len(f)))
            pooled.append(np.maximum.reduceat(z, starts))
            if where:
                at.append(np.stack([s + z[s : s + n + gap].argmax(0) for s, n in zip(starts, sizes, strict=True)]))
        return np.concatenate(pooled, axis=1), (x, place, rows, at) if where else None


class Learner:
    """A model in training: Adam on the weighted logistic loss; max pooling passes a gradient only to the
    words of the best window."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        n_out = FILTERS * len(FILTER_WIDTHS)
        self.model = Model([rng.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32) for _ in range(2)],
                           [rng.normal(0, 0.3, (w, WIDTH, FILTERS)).astype(np.float32) for w in FILTER_WIDTHS],
                           np.zeros(n_out, np.float32), rng.normal(0, 0.3, n_out).astype(np.float32), 0.0)
        self.small = [*self.model.filters, self.model.bias, self.model.out, np.zeros(1, np.float32)]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.small]
        self.squares = [np.zeros(ROWS, np.float32) for _ in range(2)]
        self.changed = [np.zeros(ROWS, bool) for _ in range(2)]
        self.step = 0

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over the texts in random order."""
        model, order = self.model, rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            seen_words = [texts[k][:, rng.random(texts[k].shape[1]) >= DROPPED] for k in pick]
            pooled, (x, place, rows, best) = model.pool(seen_words, where=True)
            hidden = np.maximum(pooled + model.bias, 0)
            error = weights[pick] * (1 / (1 + np.exp(-np.clip(hidden @ model.out + model.out_bias, -30, 30))) - labels[pick]) / len(pick)
            back = error[:, None] * model.out[None, :] * (hidden > 0)
            dx = np.zeros_like(x)
            grads = []
            for k, f in enumerate(model.filters):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                df = np.zeros_like(f)
                for w in range(len(f)):
                    seen = x[best[k] + w]  # texts x filters x WIDTH
                    df[w] = np.einsum("tfd,tf->df", seen, part)
                    np.add.at(dx, best[k] + w, part[:, :, None] * f[w].T[None])
                grads.append(df + 1e-5 * f)
            grads += [back.sum(0), hidden.T @ error + 1e-4 * model.out, np.array([error.sum()], np.float32)]
            self.step += 1
            for p, g, (m, v) in zip(self.small, grads, self.moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)
            model.out_bias = float(self.small[-1][0])
            touched = np.flatnonzero(np.abs(dx[place]).sum(1))
            for h in range(2):
                r, same = np.unique(rows[h][touched], return_inverse=True)
                g = np.zeros((len(r), WIDTH), np.float32)
                np.add.at(g, same, dx[place[touched]])
                self.squares[h][r] += (g * g).mean(1)
                self.changed[h][r] = True
                model.rows[h][r] -= ROW_RATE * g / (np.sqrt(self.squares[h][r]) + 1e-8)[:, None]

    def weights(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, numbers, values) of the embedding rows that changed, by hash, and of the rest as kind 2."""
        for h in range(2):
            r = np.flatnonzero(self.changed[h])
            yield h, r, np.column_stack([self.model.rows[h][r], self.squares[h][r]])
        flat = [np.concatenate([a.ravel() for a in part]) for part in (self.small, *zip(*self.moments, strict=True))]
        flat.append(np.full_like(flat[0], self.step))
        yield 2, np.arange(len(flat[0])), np.column_stack([*flat, *[np.zeros_like(flat[0])] * (WIDTH + 1 - len(flat))])

    def take(self, kind: int, numbers: np.ndarray, values: np.ndarray) -> None:
        """Set what ``weights`` gave, averaged over tasks."""
        if kind < 2:
            self.model.rows[kind][numbers] = values[:, :WIDTH]
            self.squares[kind][numbers] = values[:, WIDTH]
            return
        values, at = values[np.argsort(numbers)], 0
        for p, (m, v) in zip(self.small, self.moments, strict=True):
            for k, into in enumerate((p, m, v)):
                into[...] = values[at : at + p.size, k].reshape(p.shape)
            at += p.size
        self.step, self.model.out_bias = round(float(values[0, 3])), float(self.small[-1][0])


def train(table: DataFrame, n: dict[int, int], seed: int = 7) -> list[Model]:
    """A model for each half of a table of ``half, rows, _label``.

    Every task goes over its rows as they come and returns the weights it changed; their means are the
    start of the next round. What reaches the driver is bounded by the size of the models.
    """
    spark, total = table.sparkSession, sum(n.values())
    halves = 1 + table.agg(F.max("half")).first()[0]
    learners = [Learner(seed) for _ in range(halves)]
    repeats = int(np.clip(STEPS_TEXTS // ROUNDS // total, 1, REPEATS))
    names = [f"w{k}" for k in range(WIDTH + 1)]
    for at in range(ROUNDS):
        shared = spark.sparkContext.broadcast(learners)

        def learnt(batches: Iterator[pa.RecordBatch], shared=shared, at=at) -> Iterator[pa.RecordBatch]:
            own, rng = None, np.random.default_rng(seed + 1 + at)
            for batch in batches:
                own = own or pickle.loads(pickle.dumps(shared.value))
                half, label = np.asarray(batch.column(0)), np.asarray(batch.column(2))
                for h in np.unique(half):
                    mine = np.flatnonzero(half == h)
                    y = label[mine].astype(float)
                    texts = [np.frombuffer(batch.column(1)[int(k)].as_py(), "<i4").reshape(2, -1) for k in mine]
                    for _ in range(repeats):
                        own[h].learn(texts, y, total / 2 / np.where(y == 1, n[1], n[0]), rng)
            for h, learner in enumerate(own or []):
                if learner.step > shared.value[h].step:
                    for kind, numbers, found in learner.weights():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(numbers), v, np.int32)) for v in (h, kind)] + [pa.array(numbers.astype(np.int32))]
                            + [pa.array(np.ascontiguousarray(c, np.float32)) for c in found.T], names=["half", "kind", "number", *names])

        sent = table.select("half", "rows", "_label").mapInArrow(learnt, "half int, kind int, number int, " + ", ".join(f"{c} float" for c in names))
        means = sent.groupBy("half", "kind", "number").agg(*[F.avg(c).cast("float").alias(c) for c in names]).toArrow()
        half, kind, number = (means.column(k).to_numpy() for k in range(3))
        values_ = np.column_stack([means.column(3 + k).to_numpy() for k in range(WIDTH + 1)])
        for h in range(halves):
            for k in range(3):
                mine = (half == h) & (kind == k)
                if mine.any():
                    learners[h].take(k, number[mine], values_[mine])
        shared.unpersist()
    return [learner.model for learner in learners]


def calibrate(models: list[Model], table: DataFrame) -> dict[str | None, float]:
    """Set each model's scale on all texts of the other half, and return a threshold per language: the
    score, in steps of 1 / ``CELLS``, that errs least on all texts there, nearest to a half."""
    shared = table.sparkSession.sparkContext.broadcast(models)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            other, z = (np.asarray(batch.column(0)) + 1) % len(models), np.zeros(batch.num_rows)
            for k in range(0, batch.num_rows, 64):
                texts = [np.frombuffer(r.as_py(), "<i4").reshape(2, -1) for r in batch.column(1)[k : k + 64]]
                for m in np.unique(other[k : k + 64]):
                    mine = np.flatnonzero(other[k : k + 64] == m)
                    p = np.clip(models[m].score([texts[i] for i in mine]), 1e-9, 1 - 1e-9)
                    z[k + mine] = np.log(p / (1 - p))
            yield pa.RecordBatch.from_arrays([pa.array(other.astype(np.int32)), pa.array(z), batch.column(2), batch.column(3)],
                                             names=["model", "z", "y", "lang"])

    seen = settle(table.select("half", "rows", "_label", "lang").mapInArrow(raw, "model int, z double, y int, lang string"))
    scales = [(1.0, 0.0)] * len(models)

    def scaled(p: str = "p"):
        a, b = (F.element_at(F.array(*[F.lit(s[k]) for s in scales]), F.col("model") + 1) for k in (0, 1))
        return (1 / (1 + F.exp(-F.greatest(F.least(a * F.col("z") + b, F.lit(30.0)), F.lit(-30.0))))).alias(p)

    for _ in range(40):
        e, h = F.col("p") - F.col("y"), F.greatest(F.col("p") * (1 - F.col("p")), F.lit(1e-6))
        sums = seen.select("*", scaled()).groupBy("model").agg(*[
            F.sum(c) for c in (h * F.col("z") * F.col("z"), h * F.col("z"), h, e * F.col("z"), e)]).collect()
        moved = 0.0
        for m, hzz, hz, hh, ez, ee in sums:
            a, b = scales[m]
            d = np.clip(np.linalg.solve(np.array([[hzz + 1, hz], [hz, hh + 1]]), [ez + (a - 1), ee + b]), -0.5, 0.5)
            scales[m], moved = (a - float(d[0]), b - float(d[1])), max(moved, float(np.abs(d).max()))
        if moved < 1e-5:
            break
    scales = [(max(a, 0.1), b) for a, b in scales]
    for model, scale in zip(models, scales, strict=True):
        model.scale = scale
    counts = seen.select("lang", "y", scaled()).groupBy("lang", F.floor(F.col("p") * CELLS).cast("int").alias("cell")).agg(
        F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0")).collect()
    cuts: dict[str | None, float] = {}
    for lang in {r["lang"] for r in counts}:
        n = np.zeros((2, CELLS + 2), np.int64)
        for r in counts:
            if r["lang"] == lang:
                n[:, r["cell"] + 1] += r["n0"], r["n1"]
        errors = n[1].cumsum()[:-1] + n[0].sum() - n[0].cumsum()[:-1]  # at each threshold of 0 to CELLS
        least = np.flatnonzero(errors == errors.min())
        cuts[lang] = float(min(least, key=lambda k: abs(k - CELLS / 2))) / CELLS
    return cuts


def held_out(doc_id: str = "doc_id"):
    """True for the fold that is never learnt from; a null doc_id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def labelled_texts(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str, label: str) -> DataFrame:
    """(half, rows, lang, _label) of every labelled text outside the held-out fold, one row of each id, settled."""
    usable = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).where(
        "_id IS NOT NULL AND _label IN (0, 1)").groupBy("_id").agg(F.max("_label").alias("_label")).where(~held_out("_id"))
    own = docs.select(F.col(doc_id).alias("_id"), whole(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    one = own.join(usable, "_id").groupBy("_id").agg(F.min(F.struct("text", "lang", "_label")).alias("r"))
    halved = one.select(F.pmod(F.xxhash64("_id"), F.lit(HALVES)).cast("int").alias("half"), "r.*")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [word_rows(t).astype("<i4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), batch.column(2), batch.column(3)],
                                             names=["half", "rows", "lang", "_label"])

    return settle(halved.select("half", "text", "lang", "_label").mapInArrow(hashed, "half int, rows binary, lang string, _label int"))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        label: str = "toxic") -> tuple[list[Model], dict[str | None, float]]:
    """Trained models and the thresholds; without labels of both classes no model. Where a half lacks
    a class there is one model, trained and calibrated on all."""
    table = labelled_texts(docs, labels, doc_id, text, lang, label)
    found = {(r["half"], r["_label"]): r["count"] for r in table.groupBy("half", "_label").count().collect()}
    n = {y: sum(c for (_, v), c in found.items() if v == y) for y in (0, 1)}
    if not all(n.values()):
        return [], {}
    if len(found) < 2 * HALVES:
        table = table.withColumn("half", F.lit(0))
    models = train(table, n)
    return models, calibrate(models, table)


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                    label: str = "toxic") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (score >= 0.7), flagged (score >= its
    language's threshold; an unseen language takes 0.7).

    A null or empty text has the score of no words. Without labels of both classes all scores are 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text, lang, label))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held()
        models, cuts = shared.value
        for batch in batches:
            found = []
            for part in slices(values(batch.column(1))):
                rows = [word_rows(t) for t in part]
                found.append(np.mean([model.score(rows) for model in models], axis=0) if models else np.zeros(len(part)))
            score = np.concatenate(found).astype(float) if found else np.zeros(0)
            limit = np.array([cuts.get(v, CUT) for v in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(score), pa.array((score >= CUT).astype(np.int32)),
                                              pa.array(score >= limit)], names=["doc_id", "held_out", "score", "predicted", "flagged"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"), F.col(lang).cast("string").alias("lang"),
                       held_out(doc_id).alias("held_out")).mapInArrow(
        scores, "doc_id long, held_out boolean, score double, predicted int, flagged boolean")
