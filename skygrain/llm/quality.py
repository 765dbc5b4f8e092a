"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of 64 words; only the document has a label. Each
passage is encoded from its letters' kinds, its words' lengths and its repeats. Gated
attention gives each passage a weight, the weighted sum of the passages
is the document, and one logistic unit scores it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrain.llm.common import rows_for, slices
from skygrain.llm.training import Adam, Parameters, mix, share, sigmoid, sweep
from skygrain.session import durable, small_side

PASSAGE_WORDS = 64
# Labelled documents of each label the model starts from, about: those with the lowest hashes.
SAMPLE = 2500
# Each round goes over a part's documents so often, and makes at least so many steps of so many documents.
ROUNDS, EPOCHS, LEAST_STEPS, BAGS = 5, 3, 60, 32
# Rate of the first step where the model goes over all labelled documents.
RATE = 0.003
THRESHOLD = 0.3
_HIDDEN, _GATE = 24, 12
_LENGTHS = 12


def _kinds() -> np.ndarray:
    """Kind of every byte: white space, line end, letters, digits, marks, bytes of other letters."""
    kind = np.full(256, 10, np.int64)
    for k, chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\x0b\x0c", "\n\r", ".", ",;:", "!", "?", "'\"()[]-"]):
        kind[[ord(c) for c in chars]] = k
    kind[128:192], kind[192:] = 11, 12
    return kind


_KIND = _kinds()
KINDS = 13
FEATURES = KINDS * KINDS + _LENGTHS + 4
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_POWERS = np.cumprod(np.full(256, 1099511628211, np.uint64), dtype=np.uint64)


def passages(text: bytes) -> np.ndarray:
    """A row of features for each passage of 64 words; one row of zeros for a text without words."""
    data = np.frombuffer(text, np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(data) else np.empty(0, np.int64)
    if not len(starts):
        return np.zeros((1, FEATURES), np.float32)
    count = -(-len(starts) // PASSAGE_WORDS)
    word = np.cumsum(np.bincount(starts, minlength=len(data))) - 1
    of_byte = np.maximum(word, 0) // PASSAGE_WORDS
    kind = _KIND[data]
    pairs = np.bincount(of_byte[1:] * (KINDS * KINDS) + kind[:-1] * KINDS + kind[1:], minlength=count * KINDS * KINDS).reshape(count, -1)
    bytes_in = np.maximum(pairs.sum(axis=1, keepdims=True), 1)
    inside = np.flatnonzero(~space)
    lengths = np.bincount(word[inside], minlength=len(starts))
    of_word = np.arange(len(starts)) // PASSAGE_WORDS
    histogram = np.bincount(of_word * _LENGTHS + np.minimum(lengths, _LENGTHS) - 1, minlength=count * _LENGTHS).reshape(count, -1)
    words_in = np.bincount(of_word, minlength=count)
    place = inside - starts[word[inside]]
    firsts = np.searchsorted(inside, starts)
    hashes = np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[place % 256], firsts)
    order = np.lexsort((hashes, of_word))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
    distinct = np.bincount(of_word[order][fresh], minlength=count)
    same = np.zeros(len(starts))
    same[1:] = hashes[1:] == hashes[:-1]
    again = np.bincount(of_word, weights=same, minlength=count)
    return np.concatenate([np.sqrt(pairs / bytes_in), np.sqrt(histogram / words_in[:, None]),
                           np.stack([distinct / words_in, again / words_in, np.log1p(words_in) / 4, np.ones(count)], axis=1)], axis=1).astype(np.float32)


def fresh_parameters() -> Parameters:
    pick = np.random.default_rng(11)

    def normal(*shape: int) -> np.ndarray:
        return pick.normal(0, 1 / np.sqrt(shape[0]), shape)

    return {"e": normal(FEATURES, _HIDDEN), "e0": np.zeros(_HIDDEN), "v": normal(_HIDDEN, _GATE), "u": normal(_HIDDEN, _GATE),
            "a": normal(_GATE), "c": normal(_HIDDEN), "c0": np.zeros(1)}


class Forward:
    """Scores of bags of passages, and what the gradient needs of them."""

    def __init__(self, params: Parameters, x: np.ndarray, starts: np.ndarray):
        self.params, self.x, self.starts = params, x, starts
        self.bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        self.h = np.tanh(x @ params["e"] + params["e0"])
        self.tanh, self.gate = np.tanh(self.h @ params["v"]), sigmoid(self.h @ params["u"])
        self.gated = self.tanh * self.gate
        logit = self.gated @ params["a"]
        power = np.exp(logit - np.maximum.reduceat(logit, starts)[self.bag])
        self.attention = power / np.add.reduceat(power, starts)[self.bag]
        self.z = np.add.reduceat(self.attention[:, None] * self.h, starts, axis=0)
        self.score = sigmoid(self.z @ params["c"] + params["c0"][0])

    def gradient(self, label: np.ndarray, weight: np.ndarray) -> Parameters:
        p, total = self.params, weight.sum()
        d = (self.score - label) * weight / total
        dz = d[:, None] * p["c"]
        dh = self.attention[:, None] * dz[self.bag]
        pull = (self.h * dz[self.bag]).sum(axis=1)
        mean = np.add.reduceat(self.attention * pull, self.starts)
        dlogit = self.attention * (pull - mean[self.bag])
        dgated = dlogit[:, None] * p["a"]
        dtanh, dgate = dgated * self.gate * (1 - self.tanh ** 2), dgated * self.tanh * self.gate * (1 - self.gate)
        dh += dtanh @ p["v"].T + dgate @ p["u"].T
        dh *= 1 - self.h ** 2
        found = {"e": self.x.T @ dh, "e0": dh.sum(axis=0), "v": self.h.T @ dtanh, "u": self.h.T @ dgate, "a": self.gated.T @ dlogit,
                 "c": self.z.T @ d, "c0": np.array([d.sum()])}
        return {k: g + (1e-5 * p[k] if k in ("e", "v", "u", "c") else 0) for k, g in found.items()}


def _bags(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    found = [passages(t or b"") for t in texts]
    return np.concatenate(found), np.cumsum([0] + [len(f) for f in found])[:-1]


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Parameters | None:
    """Parameters fitted to the labels (1 or not) of ``labels``; None if there is no labelled document.

    Fitted on all labelled documents: a model of about ``SAMPLE`` of each label, chosen by the hash of the key and
    weighted so that the labels count as often as they occur, is where one pass over all of them starts, unless those are all there
    are. Null keys and labels are left out; a null text is an empty one.
    """
    marked = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("_key"), (F.col(label) == 1).cast("int").alias("label"))
    counts = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    if not counts:
        return None
    part = {k: min(1.0, SAMPLE / n) for k, n in counts.items()}
    rate = F.when(F.col("label") == 1, F.lit(part.get(1, 1.0))).otherwise(F.lit(part.get(0, 1.0)))
    chosen = marked.withColumn("rate", rate).filter(share([F.col("_key")], F.col("rate")))
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    rows = texts.join(F.broadcast(chosen), "_key").select("text", "label", (1 / F.col("rate")).alias("weight"))
    rows = durable(rows.repartition(rows_for(sum(min(SAMPLE, n) for n in counts.values()), SAMPLE // 2)), "quality-sample")

    def improve(part: pa.Table, params: Parameters, k: int) -> Parameters:
        bags = [passages(t) for t in part.column("text").to_pylist()]
        label, weight = part.column("label").to_numpy().astype(float), part.column("weight").to_numpy()
        pick, adam = np.random.default_rng(k), Adam(params, 0.01 / (1 + k) ** 0.5)
        for _ in range(max(EPOCHS, LEAST_STEPS * BAGS // len(bags))):
            order = pick.permutation(len(bags))
            for at in range(0, len(order), BAGS):
                some = order[at:at + BAGS]
                x, starts = np.concatenate([bags[i] for i in some]), np.cumsum([0] + [len(bags[i]) for i in some])[:-1]
                adam.update(Forward(adam.params, x, starts).gradient(label[some], weight[some]))
        return adam.params

    params = mix(rows, fresh_parameters(), ROUNDS, improve)
    if min(part.values()) == 1:
        return params
    return sweep(texts.join(small_side(marked), "_key").select("text", "label"), params, _descend)


def _descend(batches: Iterator[pa.RecordBatch], start: Parameters) -> tuple[float, Parameters]:
    """The number of documents of a stream, and parameters after one step along the gradient of each ``BAGS`` of them."""
    adam, seen = Adam(start, RATE), 0
    for some in slices(batches, BAGS):
        x, starts = _bags(some.column("text").to_pylist())
        adam.rate = RATE / (1 + adam.step / 50) ** 0.5
        adam.update(Forward(adam.params, x, starts).gradient(some.column("label").to_numpy().astype(float), np.ones(some.num_rows)))
        seen += some.num_rows
    return float(seen), adam.params


def score(df: DataFrame, params: Parameters | None, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``df`` and the probability of label 1, from the whole text alone.

    Null and empty texts are one passage of zeros and are scored like any other; without a model every
    score is 0.5. A column of that name is replaced. Rows are kept as they are, repeats included.
    """
    df = df.drop(name)
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            scores = np.full(len(texts), 0.5) if params is None else Forward(params, *_bags(texts)).score
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kinds}, `{name}` double")
