"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

*Tokens.* A word gives its letters in lower case, its run of other characters, a
mark when it is all capitals, and a mark when it repeats the word before.

*Word vectors.* Every token whatever has a sparse ternary index vector, drawn from
a hash of its text. Those of the vocabulary have a context vector too: the sum of
the index vectors of their neighbours, two to either side, over **all documents**;
each task sums what it has read and Spark adds the sums up per token and dimension.
The word vector is the context vector, centred and scaled to length 1, plus the
index vector of length 1; for a token outside the vocabulary it is the latter alone.
The vocabulary is the tokens that most texts of the training sample contain, up to
``VOCABULARY``; it bounds the context table, not the tokens that count.

*Pooling.* A text is cut into segments of ``SEGMENT`` tokens; its features are
the mean over all tokens and, per dimension, the largest and smallest segment
mean, so a bad passage shows in a long good text.

*Network.* One hidden layer, trained in numpy on a bounded sample of labelled
rows (``per_class`` of each class; rows are weighted to the true class rates);
a fifth of the sample is kept from training to fit the temperature that
calibrates the probabilities.

Defined cases: a null text counts as empty, and an empty text has features of 0
and gets the network's score for them; null ids are scored and count as not held
out; repeated rows are scored one by one; without labels of both classes every
score is the rate of label 1 among labelled rows, or 0.5 without any; an empty
table gives an empty result; further columns are ignored.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketstream.llm.common import batch_of
from basketstream.llm.labelled import class_weights, logistic, training_sample

DIMENSIONS, NONZERO = 64, 6
VOCABULARY = 2048
PER_CLASS = 3000
SEGMENT = 256
WINDOW = 2
HIDDEN = 32
CACHE_WORDS = 400_000
CACHE_TOKENS = 300_000  # outside the vocabulary, with their vectors
LETTERS = re.compile(r"[^\W\d_]+")
CAPITALS, SAME = "<capitals>", "<same>"


def parts(word: str) -> tuple:
    """Tokens of a word: letters in lower case, the rest, a mark for capitals."""
    # Most words are letters alone, or letters and a sign behind them.
    if word.isalpha():
        letters, rest = word, ""
    elif word[:-1].isalpha() and not word[-1].isalnum():
        letters, rest = word[:-1], word[-1]
    else:
        letters, rest = "".join(LETTERS.findall(word)), LETTERS.sub("", word)
    out = [letters.lower()] if letters else []
    if rest:
        out.append(rest)
    if len(letters) > 1 and letters.isupper():
        out.append(CAPITALS)
    return tuple(out)


class Tokens:
    """Token numbers of texts, and index vectors by number; what is remembered is bounded between texts.

    Tokens of the vocabulary have the first numbers; others get the next ones as they
    come, and new numbers after the memory was cleared.
    """

    def __init__(self, vocabulary, vectors=None):
        self.own = {token: i for i, token in enumerate(vocabulary)}
        # For contexts the entries are 0, 1 and -1; in word vectors an index vector has length 1.
        self.first = index_vectors(vocabulary).astype(np.int8) if vectors is None else vectors
        self.length = np.int8(1) if vectors is None else np.float32(1 / np.sqrt(NONZERO))
        self.clear()

    def clear(self):
        self.number, self.known, self.new = dict(self.own), {}, []
        self.table = np.concatenate([self.first, np.zeros((1024, DIMENSIONS), self.first.dtype)])

    def __call__(self, text: str) -> np.ndarray:
        if len(self.known) > CACHE_WORDS or len(self.number) > len(self.own) + CACHE_TOKENS:
            self.clear()
        out, known, number, before, same = [], self.known, self.number, None, self.own[SAME]
        for word in text.split():
            numbers = known.get(word)
            if numbers is None:
                numbers = []
                for token in parts(word):
                    at = number.get(token)
                    if at is None:
                        at = number[token] = len(number)
                        self.new.append(token)
                    numbers.append(at)
                known[word] = numbers
            out += numbers
            if word == before:
                out.append(same)
            before = word
        return np.array(out, np.int32)

    def vectors(self) -> np.ndarray:
        """Vectors of all numbers given so far."""
        if self.new:
            size, end = len(self.number) - len(self.new), len(self.number)
            if end > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((end, DIMENSIONS), self.table.dtype)])
            self.table[size:end] = index_vectors(self.new).astype(self.table.dtype) * self.length
            self.new = []
        return self.table


_GROUPS = np.arange(NONZERO + 1) * DIMENSIONS // NONZERO


def index_vectors(tokens) -> np.ndarray:
    """Sparse ternary vectors: one entry of 1 or -1 in each of ``NONZERO`` groups of dimensions, by the token's hash."""
    drawn = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t) for t in tokens), np.uint8).reshape(-1, 16)
    out, rows = np.zeros((len(drawn), DIMENSIONS), np.float32), np.arange(len(drawn))
    for group in range(NONZERO):
        size = _GROUPS[group + 1] - _GROUPS[group]
        value = drawn[:, 2 * group].astype(np.int64) << 8 | drawn[:, 2 * group + 1]
        out[rows, _GROUPS[group] + (value >> 1) % size] = 1.0 - 2.0 * (value & 1)
    return out


def context_sums(numbers: np.ndarray, index: np.ndarray, into: np.ndarray) -> None:
    """Add to ``into`` the index vectors of the neighbours in one text of each token that it has a row for."""
    for at in range(0, len(numbers), 1 << 16):
        low, high = max(0, at - WINDOW), min(len(numbers), at + (1 << 16) + WINDOW)
        vectors = index[numbers[low:high]]
        near = np.zeros_like(vectors)
        for step in range(1, WINDOW + 1):
            near[step:] += vectors[:-step]
            near[:-step] += vectors[step:]
        own = np.arange(at, min(len(numbers), at + (1 << 16))) - low
        own = own[numbers[low:high][own] < len(into)]
        own = own[np.argsort(numbers[low:high][own], kind="stable")]
        tokens = numbers[low:high][own]
        starts = np.flatnonzero(np.diff(tokens, prepend=-1))
        if len(starts):
            into[tokens[starts]] += np.add.reduceat(near[own], starts, axis=0, dtype=np.int32)


def pool(numbers: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean, largest and smallest segment mean of a text's word vectors."""
    if not len(numbers):
        return np.zeros(3 * DIMENSIONS, np.float32)
    starts = np.arange(0, max(1, len(numbers) - SEGMENT // 2), SEGMENT)
    sums = np.zeros((len(starts), DIMENSIONS), np.float32)
    for first in range(0, len(starts), 64):  # a bounded part of a long text at a time
        part = numbers[starts[first] : starts[first + 64] if first + 64 < len(starts) else len(numbers)]
        sums[first : first + 64] = np.add.reduceat(vectors[part], starts[first : first + 64] - starts[first], axis=0)
    sizes = np.diff(starts, append=len(numbers)).astype(np.float32)
    means = sums / sizes[:, None]
    return np.concatenate([sums.sum(0) / len(numbers), means.max(0), means.min(0)])


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, features):
        hidden = np.tanh((features - self.mean) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, features):
        return logistic(self.logits(features) / self.temperature)


def fit(features, labels, weights, hidden=HIDDEN, steps=400, rate=0.01, decay=1e-3, seed=7) -> Network:
    """Full-batch Adam on the weighted log loss; a fifth of the rows sets the temperature."""
    draw = np.random.default_rng(seed)
    kept = draw.random(len(labels)) < 0.2
    x, y, w = features[~kept], labels[~kept], weights[~kept] / weights[~kept].sum()
    mean, scale = x.mean(0), x.std(0) + 1e-6
    values = [draw.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), draw.normal(0, 0.1, hidden), np.zeros(1)]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    z = (x - mean) / scale
    for step in range(1, steps + 1):
        a, a0, b, b0 = values
        h = np.tanh(z @ a + a0)
        error = w * (logistic(h @ b + b0[0]) - y)
        back = np.outer(error, b) * (1 - h * h)
        slopes = [z.T @ back + decay * a, back.sum(0), h.T @ error + decay * b, np.array([error.sum()])]
        for i, slope in enumerate(slopes):
            m, v = moments[i]
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            values[i] = values[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    net = Network(mean, scale, *values[:3], float(values[3][0]))
    if kept.any():
        logits, best = net.logits(features[kept]), np.inf
        for temperature in np.geomspace(0.25, 8, 61):
            p = np.clip(logistic(logits / temperature), 1e-7, 1 - 1e-7)
            loss = -(weights[kept] * np.where(labels[kept] == 1, np.log(p), np.log(1 - p))).sum()
            if loss < best:
                best, net.temperature = loss, float(temperature)
    return net


@dataclass
class QualityModel:
    vocabulary: list
    vectors: np.ndarray
    network: Network | None
    rate: float

    def _scores(self, tokens, texts):
        if self.network is None or not texts:
            return [self.rate] * len(texts)
        return self.network.scores(np.stack([pool(tokens(t), tokens.vectors()) for t in texts]))

    def score(self, docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
        """doc_id, score of every row."""
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

        def score(batches):
            tokens = Tokens(self.vocabulary, self.vectors) if self.network else None
            for batch in batches:
                yield batch_of(schema, (batch.column("doc_id"), self._scores(tokens, batch.column("text").to_pylist())))

        return _texts(docs, id_column, text_column).mapInArrow(score, "doc_id long, score double")


    def filter(self, docs: DataFrame, threshold: float, text_column="text") -> DataFrame:
        """The rows of ``docs`` with a score of at least ``threshold``."""

        def keep(batches):
            tokens = Tokens(self.vocabulary, self.vectors) if self.network else None
            for batch in batches:
                scores = self._scores(tokens, batch.column("text").to_pylist())
                carried = batch.column("carried").filter(pa.array(np.asarray(scores) >= threshold, pa.bool_()))
                yield pa.RecordBatch.from_arrays([carried], names=["carried"])

        rows = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"), F.struct("*").alias("carried"))
        return rows.mapInArrow(keep, T.StructType().add("carried", docs.schema)).select("carried.*")


def _texts(docs, id_column, text_column):
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))


def choose_vocabulary(sample: DataFrame, size=VOCABULARY) -> list:
    """The tokens that most sampled texts contain, ties by token."""

    def tokens(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = {part for word in set(text.split()) for part in parts(word)}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["token"])

    top = sample.select("text").mapInArrow(tokens, "token string").groupBy("token").count().where("count > 2").orderBy(
        F.desc("count"), "token").limit(size - 2)
    return [SAME, CAPITALS] + [row.token for row in top.collect() if row.token != CAPITALS]


def word_vectors(docs: DataFrame, vocabulary, text_column="text") -> np.ndarray:
    """Random-indexing vectors from the contexts in all documents."""
    index = index_vectors(vocabulary)  # of the vocabulary; tasks draw the others as they meet them

    def sums(batches):
        tokens, into, any_row = Tokens(vocabulary), np.zeros(index.shape, np.float64), False
        for batch in batches:
            for text in batch.column("text").to_pylist():
                numbers = tokens(text)
                context_sums(numbers, tokens.vectors(), into)
                any_row = True
        if any_row:
            seen = np.flatnonzero(np.abs(into).sum(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.int32()), pa.array(into[seen].astype(np.int64).tolist(), pa.list_(pa.int64()))], names=["token", "sums"])

    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    cells = texts.mapInArrow(sums, "token int, sums array<long>").select("token", F.posexplode("sums").alias("dimension", "value"))
    context = np.zeros(index.shape)
    for row in cells.groupBy("token", "dimension").agg(F.sum("value").alias("value")).collect():
        context[row.token, row.dimension] = row.value
    return combine(context, index)


def combine(context, index):
    length = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    context = length(context)
    return (length(context - context.mean(0)) + length(index)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, usable: Column, label_column="quality", per_class=PER_CLASS,
          id_column="doc_id", text_column="text") -> QualityModel:
    sample, counts = training_sample(docs, labels, label_column, usable, per_class, id_column, text_column)
    if set(counts) != {0, 1}:
        return QualityModel([], np.zeros((0, 0)), None, float(max(counts)) if counts else 0.5)
    vocabulary = choose_vocabulary(sample)
    vectors = word_vectors(docs, vocabulary, text_column)
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("features", pa.list_(pa.float32()))])

    def pooled(batches):
        tokens = Tokens(vocabulary, vectors)
        for batch in batches:
            rows = [pool(tokens(t), tokens.vectors()).tolist() for t in batch.column("text").to_pylist()]
            yield batch_of(schema, (batch.column("doc_id"), batch.column("label"), rows))

    # At most 2 * per_class rows reach the driver, in a fixed order.
    rows = sorted(sample.mapInArrow(pooled, "doc_id long, label int, features array<float>").collect(), key=lambda r: (r.doc_id, r.label, r.features))
    weights = class_weights(counts)
    y = np.array([r.label for r in rows], float)
    network = fit(np.array([r.features for r in rows], float), y, np.array([weights[r.label] for r in rows]))
    whole = sum(n for n, _ in counts.values())
    return QualityModel(vocabulary, vectors, network, counts[1][0] / whole)
