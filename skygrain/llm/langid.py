"""Language identification by error-correcting output codes.

Each language has a codeword of -1 and +1. For each bit one logistic
classifier over hashed character n-grams tells the languages with +1 from those with
-1. A text gets a margin per bit; the weighted logistic losses of a codeword's bits are its distance,
where a bit weighs as much as its classifier is right about that language.
The nearest codeword wins; where the next one is almost as near, the text is flagged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygrain.llm.common import rows_for, slices
from skygrain.llm.training import Adam, Parameters, mix, share, sigmoid, sums, sweep, totals
from skygrain.session import durable, small_side

UNKNOWN = "und"
BUCKETS = 4096
# Different labelled texts of each language the model starts from, about: those with the lowest hashes; fewer of each where there are very many
# languages, so that all of them together are about this many, but never fewer than the last number. A language counts as much as so many texts.
SAMPLE, SAMPLE_ALL, SAMPLE_LEAST = 1200, 120_000, 40
ROUNDS, STEPS = 4, 30
# Texts of a step, and the rate of the first one, where the model goes over all texts.
STEP_TEXTS, RATE = 256, 0.01
# A text is ambiguous if its best and second language are closer than this in probability.
AMBIGUOUS = 0.1
_PIECE = 1 << 18

_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _tables:
        _tables["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _tables["letters"]


def _runs(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """Pieces of the texts, with the text's number, in lists of at most 262,144 characters."""
    some, size = [], 0
    for k, text in enumerate(texts):
        for at in range(0, len(text), _PIECE):
            piece = text[at:at + _PIECE]
            if some and size + len(piece) > _PIECE:
                yield some
                some, size = [], 0
            some.append((k, piece))
            size += len(piece)
    if some:
        yield some


def ngram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed 1- to 3-grams of letters and word ends, and the number of letters, of each text."""
    counts, letters = np.zeros((len(texts), BUCKETS), np.float32), np.zeros(len(texts), np.int64)
    for run in _runs([t or "" for t in texts]):
        lowered = [p.lower() for _, p in run]
        codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.array([k for k, _ in run]), [len(p) + 1 for p in lowered])
        letter = _letters()[codes]
        kept = letter.copy()
        kept[1:] |= letter[:-1]  # one gap after each word
        codes, owner, letter = np.where(letter, codes, 32)[kept].astype(np.uint32), owner[kept], letter[kept]
        first = owner.min() if len(owner) else 0
        span = (owner.max() - first + 1) if len(owner) else 0
        letters[first:first + span] += np.bincount(owner[letter] - first, minlength=span)[:span]
        row = (owner - first) * BUCKETS
        mixed = codes * np.uint32(2654435761)
        two = (mixed[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(31) + mixed[1:] * np.uint32(7)
        three = two[:-1] * np.uint32(97) + mixed[2:] * np.uint32(13)
        for length, hashed in enumerate((mixed, two, three)):
            inside = owner[:len(hashed)] == owner[length:]
            hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(2246822519)
            found = np.bincount((row[:len(hashed)] + (hashed >> np.uint32(20)))[inside], minlength=span * BUCKETS)
            counts[first:first + span] += found.reshape(span, BUCKETS)
    return counts, letters


def vectors(counts: np.ndarray) -> np.ndarray:
    logs = np.log1p(counts)
    norm = np.sqrt((logs * logs).sum(axis=1, keepdims=True))
    return logs / np.maximum(norm, 1e-9) * 8


def codebook(languages: int) -> np.ndarray:
    """A codeword of -1 and +1 for each language: all splits for up to 6, else the best of random ones."""
    if languages <= 6:
        splits = 1 << max(0, languages - 1)
        return np.array([[1 if k == 0 or s >> (k - 1) & 1 else -1 for s in range(splits - 1)] for k in range(languages)]).reshape(languages, splits - 1)
    pick, best, far = np.random.default_rng(7), None, -1
    for _ in range(50):
        book = np.where(pick.random((languages, int(np.ceil(10 * np.log2(languages))))) < 0.5, -1, 1)
        apart = book.shape[1] - np.max(book @ book.T - 2 * book.shape[1] * np.eye(languages, dtype=int))
        if apart > far and (np.abs(book.sum(axis=0)) < languages).all():
            best, far = book, apart
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # of each bit for each language, rows add up to 1
    params: Parameters

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return vectors(counts) @ self.params["w"] + self.params["b"]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, probability of it, and whether another is almost as near."""
        counts, letters = ngram_counts(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        loss = np.logaddexp(0, -self.margins(counts)[:, None, :] * self.code[None])
        distance = (loss * self.weights[None]).sum(axis=2) * self.code.shape[1]
        chance = np.exp(distance.min(axis=1, keepdims=True) - distance)
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        ordered = np.sort(np.concatenate([np.zeros((len(texts), 1)), chance], axis=1), axis=1)
        known = letters > 0
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, ordered[:, -1], 0.0), ~known | (ordered[:, -1] - ordered[:, -2] < AMBIGUOUS)


def _matrix(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    counts, _ = ngram_counts(part.column("text").to_pylist())
    return vectors(counts), part.column("label").to_numpy()


def _weighed(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``text, label, weight`` of every row: the copies of a text weigh as much as one, a language no more than its share of the sample."""
    rows = rows.withColumn("hash", F.xxhash64("text"))
    copies = small_side(durable(rows.groupBy("lang", "hash").agg(F.count("*").alias("copies")).filter("copies > 1"), "copies"))
    found = rows.join(F.broadcast(keys), "lang").join(copies, ["lang", "hash"], "left")
    return found.select("text", "label", (F.col("part") / F.coalesce("copies", F.lit(1))).alias("weight"))


def _weights(part: pa.RecordBatch) -> np.ndarray:
    return part.column("weight").to_numpy().astype(np.float32)


def _descend(batches: Iterator[pa.RecordBatch], start: Parameters, code: np.ndarray) -> tuple[float, Parameters]:
    """The weight of a stream of texts, and parameters after one step along the gradient of each ``STEP_TEXTS`` of them."""
    adam, seen = Adam(start, RATE), 0.0
    for part in slices(batches, STEP_TEXTS):
        (x, label), weight = _matrix(part), _weights(part)
        target = code[label]
        adam.rate = RATE / (1 + adam.step / 10) ** 0.5
        pull = -target * sigmoid(-target * (x @ adam.params["w"] + adam.params["b"])) * (weight / weight.sum())[:, None]
        adam.update({"w": (x.T @ pull.astype(np.float32) + 1e-5 * adam.params["w"]).astype(np.float32), "b": pull.sum(axis=0).astype(np.float32)})
        seen += float(weight.sum())
    return seen, adam.params


def _agreement(batches: Iterator[pa.RecordBatch], params: Parameters, code: np.ndarray) -> tuple[float, np.ndarray]:
    """Weight of the texts of each label that each bit is right about, and of all of them."""
    total = np.zeros((len(code), code.shape[1] + 1))
    for part in slices(batches):
        (x, label), weight = _matrix(part), _weights(part)
        agree = np.sign(x @ params["w"] + params["b"]) == code[label]
        np.add.at(total, label, np.concatenate([agree, np.ones((len(x), 1))], axis=1) * weight[:, None])
    return float(total[:, -1].sum()), total.ravel()


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of the labels of ``labelled``; rows with a null label or text are left out.

    Every label is learned, from all of its texts: a model of about ``SAMPLE`` of each, chosen by hash, is where one pass over every text
    starts, unless those are all there are. The weights of the bits come from all texts, too. A text with copies is one text, however many they
    are, and languages with more than ``SAMPLE`` texts count alike.
    Without labels the model knows no language; with one it always answers that one.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    # estimated, as they only say which share of the hashes to take; a row for each language
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("texts")).collect()
    languages = sorted(r.lang for r in counts)
    each = min(SAMPLE, max(SAMPLE_LEAST, SAMPLE_ALL // max(1, len(languages))))
    code = codebook(len(languages))
    params = {"w": np.zeros((BUCKETS, code.shape[1] if languages else 0), np.float32), "b": np.zeros(code.shape[1] if languages else 0, np.float32)}
    even = np.full(code.shape, 1 / max(1, code.shape[1] if len(languages) > 1 else 1))
    if len(languages) < 2:
        return Model(languages, code, even, params)
    number = {name: k for k, name in enumerate(languages)}
    keys = rows.sparkSession.createDataFrame([(r.lang, number[r.lang], min(1.0, each / max(1, r.texts))) for r in counts], "lang string, label int, part double")
    chosen = rows.join(F.broadcast(keys), "lang").filter(share([F.col("text")], F.col("part"))).select("text", "label").distinct()
    chosen = durable(chosen.repartition(rows_for(sum(min(each, r.texts) for r in counts), SAMPLE)), "language-sample")

    def improve(part: pa.Table, params: Parameters, k: int) -> Parameters:
        x, label = _matrix(part)
        target = code[label]
        adam = Adam(params, 0.05 / (1 + k))
        for _ in range(STEPS):
            pull = -target * sigmoid(-target * (x @ adam.params["w"] + adam.params["b"])) / len(x)
            adam.update({"w": (x.T @ pull + 1e-5 * adam.params["w"]).astype(np.float32), "b": pull.sum(axis=0).astype(np.float32)})
        return adam.params

    params = mix(chosen, params, ROUNDS, improve)

    def right(part: pa.Table) -> np.ndarray:
        x, label = _matrix(part)
        agree = (np.sign(x @ params["w"] + params["b"]) == code[label]).astype(float)
        total = np.zeros((len(languages), code.shape[1] + 1))
        np.add.at(total, label, np.concatenate([agree, np.ones((len(x), 1))], axis=1))
        return total.ravel()

    size = len(languages) * (code.shape[1] + 1)
    if all(r.texts <= each for r in counts):
        total = sums(chosen, right, size)
    else:
        every = _weighed(rows, keys)
        params = sweep(every, params, lambda batches, start: _descend(batches, start, code))
        total = totals(every, lambda batches: _agreement(batches, params, code), size)[1]
    total = total.reshape(len(languages), -1)
    weights = (total[:, :-1] + 1) / (total[:, -1:] + 2)
    return Model(languages, code, weights / weights.sum(axis=1, keepdims=True), params)


def identify(df: DataFrame, model: Model, text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """All columns of ``df`` and, from the whole text alone, the language, its score (0 to 1) and an ambiguity flag.

    A null text and one without a letter are ``und`` with score 0, flagged. Columns
    of ``df`` with these names are replaced. Rows are kept as they are, repeats included.
    """
    df = df.drop(*names)
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, score, flag = model.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(flag)],
                                             [*batch.schema.names, *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kinds}, `{names[0]}` string, `{names[1]}` double, `{names[2]}` boolean")

