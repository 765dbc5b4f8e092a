"""Log probabilities of documents under a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) * P(word | class). The most frequent words
are classes of their own, so is the end of a document, and all other words fall into classes by hash.
The class softmax has hashed features of the history: none, the word before (n-gram), the word
before that (skip) and both (n-gram), made from the words themselves. Within a class a word has its relative
frequency, which is what a softmax with only a bias for each word learns, less the share that Good-Turing
counting keeps for a word never seen.

Weights come from iterative scaling over all training tokens: how often each feature is seen with each class, and how often
the model expects it, are sums over the partitions. What the unigram start expects needs no pass. Documents are scored in blocks of stated size; a block
brings only its own distinct words to their counts and takes the counts back.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrain.llm.common import cuts_of, rows_for, slices, weighted_sums
from skygrain.llm.training import totals
from skygrain.session import durable

OWN, SHARED = 47, 16
CLASSES = 1 + OWN + SHARED  # the end of a document, frequent words, hashed classes
START = CLASSES  # a class only histories have
# Numbers of words in a history, by hash; the last one is the start of a document.
WORDS = (1 << 24) + 1
BUCKETS = 1 << 14
# Passes over the training tokens for what the model expects, the step of each (features of a history that change) and what unseen cells count.
PASSES, STEP, SMOOTH = 1, 1 / 3, 20.0
_PIECE = 1 << 20
_ROWS = 4096
BLOCK_CHARS = 16 << 20
END = b""
_SEED = 42


def tokens(text: bytes) -> list[bytes]:
    """Words of the text with A-Z in lower case, and the end."""
    return [*text.lower().split(), END]


def features(history: np.ndarray, size: int = CLASSES + 1) -> np.ndarray:
    """Buckets of the four features of each history (second word back * ``size`` + word before)."""
    two, one = history // size, history % size
    keys = np.stack([np.zeros_like(one), 1 + one, 1 + size + two, 1 + 2 * size + history], axis=1).astype(np.uint64)
    keys ^= keys >> np.uint64(29)
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.int64)


def _logits(weights: np.ndarray, at: np.ndarray) -> np.ndarray:
    logits = weights[at[:, 0]]
    for column in at.T[1:]:
        logits += weights[column]
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def log_softmax(weights: np.ndarray, history: np.ndarray, size: int = CLASSES + 1) -> np.ndarray:
    return _logits(weights, features(history, size))


def histories(classes: np.ndarray, starts: np.ndarray, size: int = CLASSES + 1) -> np.ndarray:
    """History of each token of documents that begin at ``starts``; tokens are numbers below ``size - 1``, which is the start."""
    one, two = np.full(len(classes), size - 1), np.full(len(classes), size - 1)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    one[starts] = size - 1
    two[starts] = size - 1
    second = starts + 1
    two[second[second < len(classes)]] = size - 1
    return two * size + one


def _number(hashed: int) -> int:
    """Number of a word in a history, from bits of its hash that say nothing of its class."""
    return (hashed >> 20) % (WORDS - 1)


class _Classes(dict):
    """Number in a history * ``CLASSES`` + class of a word; the dictionary starts anew when it is full."""

    def __init__(self, frequent: list[bytes]):
        super().__init__()
        self.frequent = {END: 0} | {w: 1 + k for k, w in enumerate(frequent)}

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        hashed = xxhash.xxh64_intdigest(word, _SEED)
        found = self.frequent.get(word)
        self[word] = found = _number(hashed) * CLASSES + (1 + OWN + (hashed & SHARED - 1) if found is None else found)
        return found


@dataclass(frozen=True)
class Model:
    frequent: list[bytes]
    weights: np.ndarray
    train_tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_once: np.ndarray  # words that occur once

    def inner(self, count: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """log10 P(word | class); a word without a count is the class's unseen one."""
        unseen = (self.class_once + 1) / (self.class_tokens + 2)
        seen = (1 - unseen) / np.maximum(self.class_tokens, 1)
        return np.log10(np.where(count > 0, np.maximum(count, 1) * seen[cls], unseen[cls]))


def _class(word: str, frequent: list[bytes]) -> Column:
    """Class of a word column."""
    other = F.lit(1 + OWN) + F.pmod(F.xxhash64(word), F.lit(SHARED))
    found = F.when(F.octet_length(word) == 0, F.lit(0))
    for k, w in enumerate(frequent):
        found = found.when(F.col(word) == F.lit(bytearray(w)), F.lit(1 + k))
    return found.otherwise(other).cast("int")


def _rows(docs: DataFrame, key: str, text: str, train: Column) -> DataFrame:
    """Rows with a block: part of a file split, about ``BLOCK_CHARS`` long, so that no text moves to count its words."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
                       F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("split"))
    largest = rows.groupBy("split").agg(F.sum(F.octet_length("text").cast("long")).alias("n")).agg(F.max("n")).first()[0]
    parts = rows_for(largest, BLOCK_CHARS)
    return rows.withColumn("block", F.xxhash64("split", F.pmod(F.xxhash64("key", "text"), F.lit(parts)))).drop("split")


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each block, as far as this task sees it, with their number in training documents."""
    seen: dict[int, dict[bytes, int]] = {}
    for batch in slices(batches):
        for block, train, text in zip(*(c.to_pylist() for c in batch.columns)):
            counts = seen.setdefault(block, {})
            if train:
                get = counts.get
                for word in tokens(text):
                    counts[word] = get(word, 0) + 1
            else:
                for word in set(tokens(text)):
                    counts.setdefault(word, 0)
    for block, counts in seen.items():
        words, numbers = list(counts), list(counts.values())
        for at in range(0, len(words), 1 << 16):
            some = words[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(some), pa.int64()), pa.array(some, pa.binary()), pa.array(numbers[at:at + (1 << 16)], pa.int64())],
                                             ["block", "word", "n"])


def _tokens(batches: Iterable[pa.RecordBatch], frequent: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and class of every token, in pieces of about ``_PIECE`` characters of whole texts."""
    known = _Classes(frequent)

    def piece(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(t) for t in lists])
        found = np.fromiter((known[w] for t in lists for w in t), np.int64, int(lengths.sum()))
        return features(histories(found // CLASSES, np.cumsum(lengths) - lengths, WORDS), WORDS), found % CLASSES

    lists, chars = [], 0
    for batch in slices(batches):
        for text in batch.column(0).to_pylist():
            lists.append(tokens(text))
            chars += len(text)
            if chars > _PIECE:
                yield piece(lists)
                lists, chars = [], 0
    if lists:
        yield piece(lists)


def _observed(rows: DataFrame, frequent: list[bytes]) -> np.ndarray:
    """How often each bucket is seen with each class, over all training tokens."""
    def count(batches: Iterable[pa.RecordBatch]) -> tuple[int, np.ndarray]:
        total, n = np.zeros(BUCKETS * CLASSES), 0
        for at, cls in _tokens(batches, frequent):
            total += np.bincount((at * CLASSES + cls[:, None]).ravel(), minlength=len(total))
            n += len(cls)
        return n, total

    return totals(rows, count, BUCKETS * CLASSES)[1].reshape(BUCKETS, CLASSES)


def _expected(rows: DataFrame, frequent: list[bytes], weights: np.ndarray) -> np.ndarray:
    """How often the model expects each bucket with each class, over all training tokens."""
    def count(batches: Iterable[pa.RecordBatch]) -> tuple[int, np.ndarray]:
        total, n = np.zeros((BUCKETS, CLASSES)), 0
        for at, _ in _tokens(batches, frequent):
            for low in range(0, len(at), _ROWS):
                some = at[low:low + _ROWS]
                chance = np.exp(_logits(weights, some)).astype(np.float64)
                column = some.ravel().astype(np.uint16)  # 16-bit numbers are sorted by radix
                order = np.argsort(column, kind="stable")
                column = column[order]
                cuts = cuts_of(column)
                total[column[cuts[:-1]]] += weighted_sums(np.ones(len(column)), order // some.shape[1], chance, cuts)
            n += len(at)
        return n, total.ravel()

    return totals(rows, count, BUCKETS * CLASSES)[1].reshape(BUCKETS, CLASSES)


def _train(rows: DataFrame, frequent: list[bytes], class_tokens: np.ndarray) -> np.ndarray:
    """Weights of every bucket for every class, by iterative scaling over all training tokens."""
    even = (class_tokens + 1) / (class_tokens.sum() + CLASSES)
    weights, bias = np.zeros((BUCKETS, CLASSES)), features(np.zeros(1, np.int64))[0, 0]
    weights[bias] = np.log(even)
    if not class_tokens.sum():
        return weights.astype(np.float32)
    texts = rows.filter("train").select("text")
    seen = _observed(texts, frequent)
    expected = seen.sum(axis=1, keepdims=True) * even
    for left in range(PASSES, -1, -1):
        step = STEP * np.log((seen + SMOOTH * even) / (expected + SMOOTH * even))
        step[bias] = 0
        weights += step
        if left:
            expected = _expected(texts, frequent, weights.astype(np.float32))
    return weights.astype(np.float32)


def _score(model: Model, docs: pa.Table, words: pa.Table) -> pa.Table:
    """Scores of one block's documents; ``words`` has each of its words, some more than once."""
    known = {w: k for k, w in enumerate(words.column("word").to_pylist())}
    number = np.zeros(words.num_rows, np.int64)
    number[list(known.values())] = [_number(xxhash.xxh64_intdigest(w, _SEED)) for w in known]
    count, cls = words.column("c").to_numpy().astype(float), words.column("class").to_numpy()
    base = np.log10(count + 1) - np.log10(model.train_tokens + model.distinct + 1)
    inner = model.inner(count, cls)
    size = docs.num_rows
    out = {name: np.zeros(size, kind) for name, kind in (("n_tokens", np.int64), ("n_known", np.int64), ("base_score", float), ("score", float))}
    texts = docs.column("text")
    at = 0
    while at < size:
        lists, chars, first = [], 0, at
        while at < size and (not lists or chars < 1 << 20):
            text = texts[at].as_py()
            lists.append(tokens(text))
            chars += len(text)
            at += 1
        lengths = np.array([len(t) for t in lists])
        ids = np.fromiter((known[w] for t in lists for w in t), np.int64, int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        classes = cls[ids].astype(np.int64)
        history, logs = histories(number[ids], starts, WORDS), np.empty(len(ids))
        for low in range(0, len(ids), _ROWS):
            part = slice(low, low + _ROWS)
            logs[part] = np.take_along_axis(log_softmax(model.weights, history[part], WORDS), classes[part, None], axis=1)[:, 0]
        logs = logs / np.log(10) + inner[ids]
        out["n_tokens"][first:at] = lengths
        out["n_known"][first:at] = np.add.reduceat((count[ids] > 0).astype(np.int64), starts)
        out["base_score"][first:at] = np.add.reduceat(base[ids], starts)
        out["score"][first:at] = np.add.reduceat(logs, starts)
    return pa.table({"key": docs.column("key"), **out, "train_tokens": np.full(size, model.train_tokens, np.int64)})


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, n_known, base_score, score, train_tokens`` of every row, learned from the rows where ``train`` holds.

    Scores are log10 probabilities of the whole text and its end: ``base_score`` of the add-one unigram
    model, ``score`` of the maximum-entropy model. A null text is an empty one: only an end. Rows whose
    ``train`` is null are not learned from. Null and repeated keys are rows like any others; repeated texts count
    as often as they occur. Without training rows no word is known and the classes are even. An empty table gives an empty one.
    """
    rows = _rows(docs, key, text, train)
    words = durable(rows.select("block", "train", "text").mapInArrow(_words, "block long, word binary, n long"), "words")
    counted = durable(words.groupBy("word").agg(F.sum("n").alias("c")), "counts")
    frequent = [bytes(r.word) for r in counted.filter("c > 0 and octet_length(word) > 0").orderBy(F.desc("c"), "word").limit(OWN).collect()]
    named = counted.withColumn("class", _class("word", frequent))
    per_class = {r["class"]: r for r in named.filter("c > 0").groupBy("class").agg(F.sum("c").alias("tokens"), F.count("*").alias("words"),
                                                                                         F.count_if(F.col("c") == 1).alias("once")).collect()}
    class_tokens, class_words, class_once = (np.array([per_class[k][name] if k in per_class else 0 for k in range(CLASSES)], float)
                                             for name in ("tokens", "words", "once"))
    model = Model(frequent, _train(rows, frequent, class_tokens), int(class_tokens.sum()), int(class_words.sum()), class_tokens, class_once)
    known = words.select("block", "word").join(counted, "word").select("block", "word", "c", _class("word", frequent).alias("class"))

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        return _score(model, docs, words)

    kind = dict(docs.dtypes)[key]
    found = (rows.select("block", "key", "text").groupBy("block").cogroup(known.groupBy("block"))
             .applyInArrow(run, f"key {kind}, n_tokens long, n_known long, base_score double, score double, train_tokens long"))
    return found.withColumnRenamed("key", key)
