"""Quality classifier: a weak-label model over heuristic labellers, and a hashed linear scorer trained on its posteriors.

Every labeller votes good, bad or nothing on a whole text. Vote patterns are counted over all documents (there are at most 3 to the
power of the number of labellers), and expectation-maximisation on the counts estimates how often each labeller votes how for good
and for bad texts. The posterior labels of a bounded sample, lowest hashes first, half of them bad where there are as many,
train a logistic scorer on hashed features: character shapes in threes, words, and the labellers' measures in steps. All documents are
then scored; no gold label takes part.

Cases: null and empty texts, and texts without words, are bad (score 0); texts of any length are measured whole; repeated rows score
alike; columns beyond id and text are ignored; of an empty table nothing is learned and nothing returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import lowest_hashes, publish, table
from .shingles import chunks, word_hashes

#: Documents that the scorer is fitted on, at most; dimensions for words; steps of a measure; passes of the fit; score from which a text is kept.
FIT_ROWS, WORD_DIMS, STEPS, EPOCHS, KEEP_FROM = 4096, 2048, 8, 8, 0.4
NONE, BAD, GOOD = 0, 1, 2
#: Name; bad from (or, if below good, up to) this; good up to (from) this. Between them a labeller does not vote.
LABELLERS = (
    ("words that repeat the one before", 0.15, 0.03),
    ("share of the most frequent word", 0.35, 0.2),
    ("distinct words of a hundred, each; over all hundreds of a text", 0.25, 0.5),
    ("capitals among letters", 0.5, 0.2),
    ("signs among characters", 0.05, 0.015),
    ("words that are a lone sign", 0.2, 0.02),
    ("words that end in three or more signs or in !!", 0.2, 0.02),
    ("letters and spaces among characters", 0.75, 0.88),
    ("words", 3, 12),
)
#: Shape of a byte: letters (also all beyond ASCII), capitals, digits, space, line end, stop, comma, other marks by kind.
_SHAPE = np.full(256, 11, np.int64)
_SHAPE[[*range(97, 123), *range(128, 256)]] = 0
_SHAPE[65:91] = 1
_SHAPE[48:58] = 2
_SHAPE[[32, 9, 11, 12, 13]] = 3
_SHAPE[10] = 4
for _k, _group in enumerate((".?", ",;:'\"-()", "!", "|", "#$%&*", "@_/+="), 5):
    _SHAPE[[ord(c) for c in _group]] = _k
SHAPES = 12
DIMS = SHAPES**3 + WORD_DIMS + STEPS * len(LABELLERS)


def measure(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(measures by text and labeller; shape and text of each byte; hash of each word with its text's index stacked)."""
    n = len(texts)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    size = np.fromiter(map(len, texts), np.int64, n)
    of = np.repeat(np.arange(n), size + 1)
    shape = _SHAPE[raw]
    own = np.ones(len(raw), bool)
    own[np.cumsum(size + 1) - 1] = False
    count = lambda *kinds: np.bincount(of, np.isin(shape, kinds) & own, n)
    words, text = word_hashes(texts)
    n_words = np.bincount(text, minlength=n)
    some = np.maximum(n_words, 1)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((words, text))
    w, t = words[order], text[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (t[1:] != t[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(w)))
    most = np.zeros(n)
    np.maximum.at(most, t[new], runs)
    begin = np.cumsum(n_words) - n_words
    hundreds = -(-n_words // 100)
    of_hundred = np.repeat(np.cumsum(hundreds) - hundreds, n_words) + (np.arange(len(words)) - np.repeat(begin, n_words)) // 100
    order = np.lexsort((words, of_hundred))
    w, h = words[order], of_hundred[order]
    fresh = np.ones(len(w), bool)
    fresh[1:] = (w[1:] != w[:-1]) | (h[1:] != h[:-1])
    distinct = np.bincount(text[order][fresh], minlength=n) / some  # the mean over hundreds, by their words
    blank = (shape == 3) | (shape == 4)
    sign = shape >= 7
    ends = np.flatnonzero(~blank[:-1] & blank[1:])  # last byte of each word
    pad = np.concatenate([np.ones(2, bool), blank]), np.concatenate([np.zeros(2, bool), sign])
    lone = sign[ends] & pad[0][ends + 1]
    trail = sign[ends] & pad[1][ends + 1] & (pad[1][ends] | (raw[ends] == 33))
    characters = np.maximum(size, 1)
    letters = np.maximum(count(0, 1), 1)
    m = np.stack([np.bincount(text, again, n) / some, np.where(n_words >= 20, most / some, 0), np.where(n_words >= 20, distinct, 1), count(1) / letters, count(7, 8, 9, 11) / characters, np.bincount(of[ends], lone, n) / some, np.bincount(of[ends], trail, n) / some, count(0, 1, 3, 4) / characters, n_words.astype(float)], 1)
    return m, shape, of, np.stack([words.view(np.int64), text])


def votes(m: np.ndarray) -> np.ndarray:
    out = np.zeros(m.shape, np.int8)
    for j, (_, bad, good) in enumerate(LABELLERS):
        x = m[:, j]
        out[:, j] = np.where(x >= bad, BAD, np.where(x <= good, GOOD, NONE)) if bad > good else np.where(x <= bad, BAD, np.where(x >= good, GOOD, NONE))
    return out


def patterns(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int64) @ 3 ** np.arange(v.shape[1])


def features(m: np.ndarray, shape: np.ndarray, of: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashed features, texts by DIMS; counts become shares of the text."""
    n = len(m)
    same = of[2:] == of[:-2]
    code = (shape[:-2] * SHAPES + shape[1:-1]) * SHAPES + shape[2:]
    threes = np.bincount(of[2:][same] * SHAPES**3 + code[same], minlength=n * SHAPES**3).reshape(n, -1)
    word = np.bincount(words[1] * WORD_DIMS + (words[0].view(np.uint64) % np.uint64(WORD_DIMS)).astype(np.int64), minlength=n * WORD_DIMS).reshape(n, -1)
    steps = np.zeros((n, STEPS * len(LABELLERS)), np.float32)
    for j, (_, bad, good) in enumerate(LABELLERS):
        level = np.clip((m[:, j] / (2 * max(bad, good)) * STEPS).astype(int), 0, STEPS - 1)
        steps[np.arange(n), j * STEPS + level] = 0.5
    share = lambda x: (x / np.maximum(x.sum(1, keepdims=True), 1)).astype(np.float32)
    return np.concatenate([np.sqrt(share(threes)), np.sqrt(share(word)), steps], 1)


@dataclass
class LabelModel:
    """P(bad), and P(vote | class) of each labeller, classes good and bad."""

    bad: float
    table: np.ndarray  # labellers x 2 x 3

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """P(bad) of vote vectors."""
        z = np.log([1 - self.bad, self.bad]) + sum(np.log(self.table[j][:, v[:, j]]).T for j in range(v.shape[1]))
        z -= z.max(1, keepdims=True)
        e = np.exp(z)
        return e[:, 1] / e.sum(1)

    @property
    def accuracy(self) -> np.ndarray:
        """Of each labeller, where it votes."""
        right = (1 - self.bad) * self.table[:, 0, GOOD] + self.bad * self.table[:, 1, BAD]
        return right / (right + (1 - self.bad) * self.table[:, 0, BAD] + self.bad * self.table[:, 1, GOOD])


def fit_labels(codes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """EM over counted vote patterns; it starts from the texts that any labeller calls bad."""
    v = (codes[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
    p = np.where((v == BAD).any(1), 0.9, 0.05)
    model = None
    for _ in range(rounds):
        share = np.stack([(1 - p) * counts, p * counts])
        total = share.sum(1)
        # one text of prior weight a cell keeps logs finite; that good texts get bad votes at all is as rare as it looks
        grid = np.stack([np.stack([[share[c][v[:, j] == k].sum() + 1e-3 * (counts.sum() > 0) + 0.1 for k in range(3)] / (total[c] + 0.3 + 3e-3) for c in (0, 1)]) for j in range(v.shape[1])])
        bad = float(np.clip(total[1] / max(total.sum(), 1), 1e-4, 0.9))
        model = LabelModel(bad, grid)
        new = model.posterior(v)
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return model


def fit_scorer(x: np.ndarray, bad: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> np.ndarray:
    """Weights, bias last, of a logistic scorer for good texts; targets are posteriors. Adagrad in small batches."""
    rng = np.random.default_rng(seed)
    w, g2 = np.zeros(x.shape[1] + 1), np.full(x.shape[1] + 1, 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 32):
            rows = order[i : i + 32]
            d = 1 / (1 + np.exp(-(x[rows] @ w[:-1] + w[-1]))) - (1 - bad[rows])
            g = np.append(d @ x[rows], d.sum()) / len(rows) + 1e-5 * w
            g2 += g * g
            w -= 0.3 * g / np.sqrt(g2)
    return w


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def _parts(texts: list[bytes]) -> Iterator[slice]:
    return chunks(np.fromiter(map(len, texts), np.int64, len(texts)), 1_000_000)


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _texts(batch, 1)
        codes = [patterns(votes(measure(texts[part])[0])) for part in _parts(texts)]
        if codes:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(codes))], names=["key", "pattern"])


def _sample(posterior: dict[int, float], last: dict[bool, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, texts = batch.column(0).to_numpy(), _texts(batch, 1)
            near = np.flatnonzero(key <= max(last.values()))
            for part in _parts([texts[i] for i in near]):
                own = near[part]
                measured = measure([texts[i] for i in own])
                bad = np.array([posterior[c] for c in patterns(votes(measured[0])).tolist()])
                x = features(*measured)
                rows = [i for i in range(len(own)) if key[own[i]] <= last.get(bool(bad[i] > 0.5), -(2**63))]
                if rows:
                    at = [np.flatnonzero(x[i]) for i in rows]
                    yield pa.RecordBatch.from_arrays([pa.array(bad[rows]), pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()), pa.array([x[i][a].astype("<f4").tobytes() for i, a in zip(rows, at, strict=True)], pa.binary())], names=["bad", "at", "x"])

    return run


def _fit(group: pa.Table) -> pa.Table:
    x = np.zeros((group.num_rows, DIMS), np.float32)
    order = sorted(range(group.num_rows), key=lambda i: (group["at"][i].as_py(), group["x"][i].as_py()))  # whatever the order of arrival
    for row, i in enumerate(order):
        x[row, np.frombuffer(group["at"][i].as_py(), "<u2")] = np.frombuffer(group["x"][i].as_py(), "<f4")
    return pa.table({"weights": pa.array([fit_scorer(x, group["bad"].to_numpy()[order]).astype("<f4").tobytes()], pa.binary())})


def train(docs: DataFrame, text_col: str = "text", fit_rows: int = FIT_ROWS) -> tuple[LabelModel, np.ndarray] | None:
    """Label model of all documents and scorer's weights, fitted on fit_rows of them at most; None of an empty table."""
    keyed = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    voted = publish(keyed.mapInArrow(_vote, "key long, pattern long"), "quality-votes")
    counted = voted.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()  # at most 3 ** labellers
    if not counted:
        return None
    codes, counts = np.array([r[0] for r in counted]), np.array([r[1] for r in counted], float)
    labels = fit_labels(codes, counts)
    p = labels.posterior((codes[:, None] // 3 ** np.arange(len(LABELLERS))) % 3)
    posterior = dict(zip(codes.tolist(), p.tolist(), strict=True))
    keys = publish(voted.distinct(), "quality-keys")  # copies are one text of the sample
    unlike = {r[0]: r[1] for r in keys.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    last = {}
    for bad in (True, False):
        own = {c for c, q in posterior.items() if (q > 0.5) == bad}
        texts = sum(unlike[c] for c in own)
        lowest = keys.where(F.col("pattern").isin(own) & (F.col("key") <= F.lit(lowest_hashes(fit_rows // 2, texts))))
        if own and lowest.count() < min(texts, fit_rows // 2):  # as good as never: about twice as many lie below the bound
            lowest = keys.where(F.col("pattern").isin(own))
        top = lowest.orderBy("key").limit(fit_rows // 2).agg(F.max("key")).first()[0] if own else None
        if top is not None:
            last[bad] = top
    distinct = keyed.where(F.col("key") <= max(last.values())).groupBy("key").agg(F.first("text").alias("text"))
    sample = distinct.mapInArrow(_sample(posterior, last), "bad double, at binary, x binary")
    weights = sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(_fit, "weights binary").first()[0]
    return labels, np.frombuffer(weights, "<f4")


def classify(docs: DataFrame, model: tuple[LabelModel, np.ndarray] | None, id_col: str = "doc_id", text_col: str = "text", others: tuple[str, ...] = (), keep_from: float = KEEP_FROM) -> DataFrame:
    """(id, score, kept, weak_bad, and the other columns asked for) of each row; score is the scorer's P(good), weak_bad the labellers'."""
    names = [f"c{i}" for i in range(len(others))]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(n) for c, n in zip(others, names, strict=True)))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, w = shared.value
        for batch in batches:
            texts, score, weak = _texts(batch, 1), [np.empty(0)], [np.empty(0)]
            for part in _parts(texts):
                measured = measure(texts[part])
                s = 1 / (1 + np.exp(-(features(*measured) @ w[:-1] + w[-1]).astype(float)))
                score.append(np.where(measured[0][:, -1] > 0, s, 0.0))
                weak.append(labels.posterior(votes(measured[0])))
            s = np.concatenate(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array(s >= keep_from), pa.array(np.concatenate(weak)), *batch.columns[2:], batch.column(1)], names=["id", "score", "kept", "weak_bad", *names, "text"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = rows.mapInArrow(run, f"id {kinds['id']}, score double, kept boolean, weak_bad double, " + "".join(f"{n} {kinds[n]}, " for n in names) + f"text {kinds['text']}")
    return out.select("id", "score", "kept", "weak_bad", *(F.col(n).alias(c) for c, n in zip(others, names, strict=True)), "text")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: score, and whether they are kept."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs)
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(False).alias("kept"), F.lit(1.0).alias("weak_bad"))
    return classify(docs, model).select(F.col("id").alias("doc_id"), "score", "kept", "weak_bad")
