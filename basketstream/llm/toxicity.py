"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

*Terms.* A term is the letters of a word in lower case, known by their 64-bit hash.
Term weights are (1 + ln count) * idf with idf = ln((1 + N) / (1 + n)) + 1; **every**
term of a text counts, and n, the number of documents with the term, is counted over
**all documents**. Terms that fewer than one document in ``1 / RAREST`` has weigh like
one that as many have. So a table of the others suffices, with at most (distinct terms
of a text) / ``RAREST`` rows however many documents there are: a task reads it once.
The terms of a document are counted once, into a table of about the texts' compressed
size, from which frequencies and scores are taken.

*Whole texts.* Examples are a bounded sample of labelled rows, ``WHOLE_PER_CLASS`` of
each class, in blocks of ``BLOCK`` similar ones. The ``HEAD`` terms that most examples
have are a dense matrix. The others have inverted lists, cut by block, with the largest
weight of each cut. A block is looked into if its best head score and the largest
weights of its lists can reach the ``NEIGHBOURS``-th best head score. Examples whose
cosine in single precision can be among the best are computed again in double
precision. What is skipped cannot belong to the result: the neighbours are exact, ties
going to the smaller id.

*Telling terms.* In long texts a few toxic words weigh little among hundreds of
others. So neighbours are sought a second time, among ``PER_CLASS`` examples of each
class, over those terms that depend most on the label in the sample (chi-square): words,
and starts of 4 to 6 letters of longer words, so that unseen forms share a term.
Lengths are taken over these terms. Blocks are read from the highest bound on, until
no bound reaches the ``NEIGHBOURS``-th best cosine. This is exact too.

*Votes.* Neighbours vote for their label with cosine times class weight. One logistic
curve over the share of votes and the best cosine of either search, fitted on the
examples with each one left out of its own neighbours, makes the score. The evidence is
the nearest examples by the whole text with label and cosine.

Defined cases: a null text counts as empty; a text without a term of an example
has no neighbours and gets the rate of label 1 among labelled texts without one; null
ids are scored and count as not held out; repeated rows are scored one by one;
without labels of both classes every score is the rate of label 1, or 0 without
any label; an empty table gives an empty result; further columns are ignored. A very
long text is one list of distinct terms.
"""

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from basketstream.llm.common import batch_of, filesystem, shared_folder, write_once
from basketstream.llm.labelled import class_weights, logistic, training_sample

PER_CLASS = 3000
WHOLE_PER_CLASS = 1500  # of them, by whole texts
RAREST = 1e-4
STARTS = (4, 5, 6)
HEAD = 1024
NEIGHBOURS = 16
EVIDENCE = 3
SLACK = 2e-4  # of a cosine: weights are not negative, so single precision is off by less
TERMS = 2048  # telling terms
MIN_CHI2 = 24.0
MIN_DOCUMENTS = 5
BLOCK = 64
FIRST_BLOCKS, MORE_BLOCKS = 4, 32  # blocks that are read before bounds are looked at again
CACHE_RESULTS = 50_000
CACHE_WORDS = 300_000
GROUP_TERMS = 4_000_000  # terms whose documents are counted before they are passed on
QUERIES = 200  # texts that are multiplied with the dense matrix at a time
LETTERS = re.compile(r"[^\W\d_]+")


def letters_of(word: str) -> list:
    """Runs of letters in lower case; most words are letters alone, or letters and a sign behind them."""
    word = word.lower()
    if word.isalpha():
        return (word,)
    if word[:-1].isalpha() and not word[-1].isalnum():
        return (word[:-1],)
    return LETTERS.findall(word)


def terms(word: str) -> list:
    """What can be a telling term."""
    out = []
    for letters in letters_of(word):
        out.append(letters)
        out += [letters[:n] + "*" for n in STARTS if len(letters) > n]
    return out


def telling_hash(term: str) -> int:
    """Key of a telling term in the table of frequencies, apart from that of the same word as a term of whole texts."""
    return xxhash.xxh64_intdigest(term + "\0") - (1 << 63)


class Terms:
    """Terms of a text, and its telling terms by number; words are remembered up to a bound."""

    def __init__(self, telling=()):
        self.number = {term: i for i, term in enumerate(telling)}
        self.starts = {term[: STARTS[0]] for term in telling}
        self.known = {}

    def _learn(self, word):
        digest, words, telling = xxhash.xxh64_intdigest, [], []
        for letters in letters_of(word):
            words.append(digest(letters) - (1 << 63))
            if letters[: STARTS[0]] in self.starts:
                found = (letters, *(letters[:n] + "*" for n in STARTS if len(letters) > n))
                telling += [self.number[term] for term in found if term in self.number]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        self.known[word] = out = words, telling
        return out

    def __call__(self, text: str):
        """(hashes in order, counts), (telling numbers in order, counts)"""
        found, telling, known = [], [], self.known
        for word in text.split():
            words, tells = known.get(word) or self._learn(word)
            found += words
            if tells:
                telling += tells
        both = (np.unique(np.array(x, np.int64), return_counts=True) for x in (found, telling))
        return tuple((numbers, counts.astype(np.int32)) for numbers, counts in both)


def _sums(hashes, counts):
    """Sums of ``counts`` per hash, in order."""
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[starts], np.add.reduceat(counts, starts)


_TABLES = {}


@dataclass
class Frequencies:
    """Numbers of documents of the terms that are not among the rarest; files in the shared folder."""

    documents: int
    least: float  # number of documents that all others count as having
    uri: str
    files: list

    def table(self):
        if self.uri not in _TABLES:
            _TABLES.clear()
            files = filesystem(self.uri)[0]
            shards = [pq.read_table(file, filesystem=files) for file in self.files]
            term, n = (np.concatenate([np.empty(0, np.int64), *(s.column(c).to_numpy() for s in shards)]) for c in ("term", "n"))
            order = np.argsort(term)
            _TABLES[self.uri] = term[order], n[order]
        return _TABLES[self.uri]

    def idf(self, hashes):
        term, n = self.table()
        out = np.full(len(hashes), self.least, float)
        if len(term):
            at = np.minimum(np.searchsorted(term, hashes), len(term) - 1)
            met = term[at] == hashes
            out[met] = n[at[met]]
        return np.log((1 + self.documents) / (1 + out)) + 1


def weights_of(counts, idf):
    """Weights of length 1."""
    weights = (1 + np.log(counts)) * idf
    return weights / np.linalg.norm(weights) if len(weights) else weights


def _ranges(starts, lengths):
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _in_blocks(ids, labels, vectors):
    """Order in which similar examples share a block: by label, then by strongest term."""
    return sorted(range(len(ids)), key=lambda i: (labels[i], int(vectors[i][0][np.argmax(vectors[i][1])]), ids[i]))


class WholeIndex:
    """Examples with vectors of length 1 over term numbers below ``size``: a dense head, and lists cut by block with their maxima."""

    def __init__(self, ids, labels, vectors, size):
        order = _in_blocks(ids, labels, vectors)
        vectors = [vectors[i] for i in order]
        self.ids, self.labels = np.array([ids[i] for i in order], np.int64), np.array([labels[i] for i in order], np.int64)
        self.size, self.blocks = size, -(-len(ids) // BLOCK)
        none = [np.empty(0, np.int64)]
        self.numbers = np.concatenate([n for n, _ in vectors] or none).astype(np.int32)
        self.weights = np.concatenate([w for _, w in vectors] or none).astype(np.float64)
        self.lengths = np.array([len(n) for n, _ in vectors], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        places = np.repeat(np.arange(len(ids), dtype=np.int32), self.lengths)
        often = np.bincount(self.numbers, minlength=size)
        head = np.argsort(-often, kind="stable")[:HEAD]
        self.column = np.full(size, -1, np.int32)  # of a term in the dense matrix
        self.column[head] = np.arange(len(head))
        column = self.column[self.numbers]
        self.dense = np.zeros((len(head), len(ids)), np.float32)
        self.dense[column[column >= 0], places[column >= 0]] = self.weights[column >= 0]
        rest = np.flatnonzero(column < 0)
        rest = rest[np.argsort(self.numbers[rest], kind="stable")]
        term, self.list_places, self.list_weights = self.numbers[rest], places[rest], self.weights[rest].astype(np.float32)
        # A cut is the part of a term's list that lies in one block.
        block = self.list_places // BLOCK
        opens = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else np.empty(0, np.int64)
        self.cut_start, self.cut_length = opens, np.diff(opens, append=len(term))
        self.cut_block = block[opens]
        self.cut_most = np.maximum.reduceat(self.list_weights, opens) if len(opens) else self.list_weights
        self.cuts = np.bincount(term[opens], minlength=size)
        self.first_cut = np.cumsum(self.cuts) - self.cuts

    def nearest_of(self, queries, k=NEIGHBOURS, leave_out=None):
        """Of each of (numbers, weights): (positions, cosines) of the k most similar examples with a positive cosine, best first."""
        dense = np.zeros((len(queries), len(self.dense)), np.float32)
        columns = [self.column[numbers] for numbers, _ in queries]
        for row, (column, (_, weights)) in enumerate(zip(columns, queries)):
            dense[row, column[column >= 0]] = weights[column >= 0]
        near = dense @ self.dense
        whole, edges = np.zeros(self.size), np.arange(0, len(self.ids), BLOCK)
        for row, (column, (numbers, weights)) in enumerate(zip(columns, queries)):
            scores, rest = near[row], column < 0
            own = np.flatnonzero(self.ids == leave_out[row]) if leave_out is not None and leave_out[row] is not None else []
            scores[own] = 0
            number = numbers[rest]
            cuts = _ranges(self.first_cut[number], self.cuts[number])
            if len(cuts):
                floor = np.partition(scores, -k)[-k] * (1 - SLACK) if len(scores) > k else 0
                weight = np.repeat(weights[rest].astype(np.float32), self.cuts[number])
                bounds = np.maximum.reduceat(scores, edges) + np.bincount(
                    self.cut_block[cuts], weight * self.cut_most[cuts], self.blocks).astype(np.float32) * (1 + SLACK)
                open_ = bounds[self.cut_block[cuts]] >= floor
                cuts, weight = cuts[open_], weight[open_]
                at = _ranges(self.cut_start[cuts], self.cut_length[cuts])
                parts = self.list_weights[at] * np.repeat(weight, self.cut_length[cuts])
                scores = scores + np.bincount(self.list_places[at], parts, len(scores))
                scores[own] = 0
            floor = np.partition(scores, -k)[-k] * (1 - SLACK) if len(scores) > k else 0
            places = np.flatnonzero((scores > 0) & (scores >= floor))
            if not len(places):
                yield places, np.empty(0)
                continue
            whole[numbers] = weights
            lengths = self.lengths[places]
            at = _ranges(self.starts[places], lengths)
            cosines = np.add.reduceat(whole[self.numbers[at]] * self.weights[at], np.cumsum(lengths) - lengths)
            whole[numbers] = 0
            order = np.lexsort((self.ids[places], -np.round(cosines, 12)))[:k]
            yield places[order], cosines[order]


class Index:
    """Examples with vectors, in blocks of inverted lists with their maxima.

    A list is the weights that a term has in the ``BLOCK`` examples of a block;
    list 0 is all zeros and stands for terms that the block lacks.
    """

    def __init__(self, ids, labels, vectors, size):
        order = _in_blocks(ids, labels, vectors)
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.labels = np.array([labels[i] for i in order], np.int64)
        vectors = [vectors[i] for i in order]
        self.blocks = -(-len(ids) // BLOCK)
        self.most = np.zeros((size, self.blocks), np.float32)  # rounded up, so that bounds hold
        self.rows = np.zeros((size, self.blocks), np.int64)  # the list of a term in a block
        lists, last = [np.zeros((1, BLOCK))], 0
        for block in range(self.blocks):
            own = vectors[block * BLOCK : (block + 1) * BLOCK]
            met = np.unique(np.concatenate([numbers for numbers, _ in own]))
            self.rows[met, block] = last + 1 + np.arange(len(met))
            new = np.zeros((len(met), BLOCK))
            for place, (numbers, weights) in enumerate(own):
                new[self.rows[numbers, block] - last - 1, place] = weights
            self.most[met, block] = np.nextafter(new.max(1).astype(np.float32), np.float32(2))
            lists.append(new)
            last += len(met)
        self.lists = np.concatenate(lists)

    def nearest(self, numbers, weights, k=NEIGHBOURS, leave_out=None):
        """(positions, cosines) of the k most similar examples with a positive cosine, best first."""
        if not len(numbers) or not self.blocks:
            return np.empty(0, np.int64), np.empty(0)
        bounds = weights @ self.most[numbers]
        waiting = np.argsort(-bounds, kind="stable")
        waiting = waiting[bounds[waiting] > 0]
        best, where, floor, take = np.empty(0), np.empty(0, np.int64), 0.0, FIRST_BLOCKS
        while len(waiting):
            blocks, waiting = waiting[:take], waiting[take:]
            scores = np.tensordot(weights, self.lists[self.rows[numbers][:, blocks]], 1)
            at, place = np.nonzero(scores > max(0.0, floor - 1e-9))  # ties with the floor count
            places, found = blocks[at] * BLOCK + place, scores[at, place]
            if leave_out is not None:
                keep = self.ids[places] != leave_out
                places, found = places[keep], found[keep]
            best, where = np.concatenate([best, found]), np.concatenate([where, places])
            order = np.lexsort((self.ids[where], -np.round(best, 12)))[:k]
            best, where = best[order], where[order]
            if len(best) == k:
                floor = best[-1]
                waiting = waiting[bounds[waiting] >= floor - 1e-9]
            take = MORE_BLOCKS
        return where, best


def votes(index, near, weights):
    """(share of the votes for label 1, share times best cosine); zeros without neighbours."""
    places, cosines = near
    if not len(places):
        return 0.0, 0.0
    labels = index.labels[places]
    strength = cosines * np.where(labels == 1, weights[1], weights[0])
    share = strength[labels == 1].sum() / strength.sum()
    return share, share * cosines[0]


def fit_curve(features, labels, weights, decay=1e-3, steps=50):
    """Logistic regression by Newton's method: coefficients and intercept."""
    x = np.column_stack([features, np.ones(len(features))])
    w, out = weights / weights.sum(), np.zeros(x.shape[1])
    ridge = decay * np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    for _ in range(steps):
        p = logistic(x @ out)
        slope = x.T @ (w * (p - labels)) + ridge @ out
        bend = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge + 1e-9 * np.eye(x.shape[1])
        move = np.linalg.solve(bend, slope)
        out -= move / max(1.0, np.abs(move).max() / 5)
    return out


@dataclass
class ToxicityModel:
    none_rate: float  # score of a text without neighbours
    vocabulary: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # sorted hashes of the examples' terms
    frequencies: Frequencies | None = None
    whole: WholeIndex | None = None
    whole_weights: dict = field(default_factory=dict)
    telling: list = field(default_factory=list)  # terms
    telling_idf: np.ndarray | None = None
    index: Index | None = None
    index_weights: dict = field(default_factory=dict)
    curve: np.ndarray | None = None

    def vectors(self, counted):
        """Of a text: the terms that examples have, with their weights in the whole text; the telling ones, by themselves."""
        (hashes, counts), (tells, tell_counts) = counted
        weights = weights_of(counts, self.frequencies.idf(hashes))
        numbers = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        met = self.vocabulary[numbers] == hashes if len(self.vocabulary) else np.zeros(len(hashes), bool)
        return (numbers[met], weights[met]), (tells, weights_of(tell_counts, self.telling_idf[tells]))

    def features(self, counted, known, ids=None):
        """(features of the curve, nearest by whole text) of each of the counted texts; ``ids`` are left out of their own neighbours."""
        for at in range(0, len(counted), QUERIES):
            some = [self.vectors(c) for c in counted[at : at + QUERIES]]
            out = ids[at : at + QUERIES] if ids else None
            for row, near in enumerate(self.whole.nearest_of([w for w, _ in some], leave_out=out)):
                telling = some[row][1]
                key = telling[0].tobytes(), telling[1].tobytes(), out[row] if out else None
                if key not in known:  # many texts have the same few telling terms
                    if len(known) > CACHE_RESULTS:
                        known.clear()
                    known[key] = votes(self.index, self.index.nearest(*telling, leave_out=out[row] if out else None), self.index_weights)
                yield (*votes(self.whole, near, self.whole_weights), *known[key]), near

    def score_texts(self, counted, known):
        """(score, evidence) of each of the counted texts."""
        for features, (places, cosines) in self.features(counted, known):
            evidence = [{"doc_id": int(self.whole.ids[p]), "label": int(self.whole.labels[p]), "cosine": float(c)}
                        for p, c in zip(places[:EVIDENCE], cosines[:EVIDENCE])]
            none = not len(places) and not any(features)
            yield self.none_rate if none else float(logistic(self.curve @ [*features, 1.0])), evidence

    def score(self, docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
        """doc_id, score, evidence of every row."""
        return self.score_counted(count_terms(docs, self.telling, id_column, text_column))

    def score_counted(self, counts: DataFrame) -> DataFrame:
        """The same of rows whose terms are counted already."""
        entry = pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())])
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", pa.list_(entry))])

        def score(batches):
            known = {}
            for batch in batches:
                for at in range(0, batch.num_rows, QUERIES):
                    part = batch.slice(at, QUERIES)
                    found = [(self.none_rate, [])] * part.num_rows if self.whole is None else self.score_texts(_counted_rows(part), known)
                    yield batch_of(schema, (part.column("doc_id"), *zip(*found)))

        return counts.select("doc_id", *COUNTS).mapInArrow(
            score, "doc_id long, score double, evidence array<struct<doc_id: long, label: int, cosine: double>>")


COUNTS = ("terms", "counts", "tells", "tell_counts")


def _counted_rows(batch: pa.RecordBatch) -> list:
    """((hashes, counts), (telling numbers, counts)) of each row of a batch with the columns ``COUNTS``."""
    rows = zip(*(batch.column(n).to_pylist() for n in COUNTS))
    return [((np.frombuffer(a, np.int64), np.frombuffer(b, np.int32)), (np.frombuffer(c, np.int64), np.frombuffer(d, np.int32))) for a, b, c, d in rows]


def count_terms(docs: DataFrame, telling=(), id_column="doc_id", text_column="text") -> DataFrame:
    """doc_id and the columns ``COUNTS`` of every row: terms and telling terms with their counts, as bytes."""
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.binary()) for n in COUNTS)])

    def counted(batches):
        count = Terms(telling)
        for batch in batches:
            found = [[x.tobytes() for pair in count(text.as_py()) for x in pair] for text in batch.column("text")]
            yield batch_of(schema, (batch.column("doc_id"), *(zip(*found) if found else [[]] * 4)))

    return _texts(docs, id_column, text_column).mapInArrow(counted, "doc_id long, " + ", ".join(f"{n} binary" for n in COUNTS))


def _texts(docs, id_column, text_column):
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))


def choose_vocabulary(sample: DataFrame, counts: dict, size=TERMS, min_chi2=MIN_CHI2) -> list:
    """Terms by chi-square of term against label over the sampled texts."""

    def found(batches):
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                own = sorted({t for word in set(text.split()) for t in terms(word)})
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([label] * len(own), pa.int32())], names=["term", "label"])

    zeros, ones = counts[0][1], counts[1][1]
    n = zeros + ones
    per_term = sample.select("label", "text").mapInArrow(found, "term string, label int").groupBy("term").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).where(F.expr(f"a + b >= {MIN_DOCUMENTS} AND a + b < {n}"))
    chi2 = F.expr(f"{n}D * power(a * ({zeros} - b) - b * ({ones} - a), 2) / ({float(ones) * zeros}D * (a + b) * ({n} - a - b))")
    top = per_term.withColumn("chi2", chi2).where(F.col("chi2") >= min_chi2).orderBy(F.desc("chi2"), "term").limit(size)
    return [row.term for row in top.collect()]


def _numbers(column: pa.Array) -> np.ndarray:
    """The 64-bit numbers that the rows of a binary column hold, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64)


def document_frequencies(counts: DataFrame, telling=()) -> Frequencies:
    """Numbers of documents per term over all documents; each task adds up what it has read, up to a bound."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])
    keys = np.array([telling_hash(t) for t in telling], np.int64)

    def counted(batches):
        sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            new = np.concatenate([_numbers(batch.column("terms")), keys[_numbers(batch.column("tells"))]])
            if len(new):
                sums = _sums(np.concatenate([sums[0], new]), np.concatenate([sums[1], np.ones(len(new), np.int64)]))
            if len(sums[0]) > GROUP_TERMS:
                yield batch_of(schema, sums)
                sums = np.empty(0, np.int64), np.empty(0, np.int64)
        yield batch_of(schema, sums)

    uri, documents = shared_folder(counts.sparkSession, "frequencies"), counts.count()
    least = max(1.0, RAREST * documents)
    counts.select("terms", "tells").mapInArrow(counted, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("n")).where(F.col("n") > least).write.parquet(uri)
    files, path = filesystem(uri)
    names = sorted(f.path for f in files.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet"))
    return Frequencies(documents, least, uri, names)


def train(docs: DataFrame, labels: DataFrame, usable: Column, label_column="toxic", per_class=PER_CLASS,
          id_column="doc_id", text_column="text", whole_per_class=WHOLE_PER_CLASS) -> ToxicityModel:
    return _train(docs, labels, usable, label_column, per_class, id_column, text_column, whole_per_class)[0]


def score_corpus(docs: DataFrame, labels: DataFrame, usable: Column, label_column="toxic", per_class=PER_CLASS,
                 id_column="doc_id", text_column="text", whole_per_class=WHOLE_PER_CLASS) -> DataFrame:
    """doc_id, score, evidence of every row of the documents that the model is made from, whose terms are counted once."""
    model, counts = _train(docs, labels, usable, label_column, per_class, id_column, text_column, whole_per_class)
    return model.score(docs, id_column, text_column) if counts is None else model.score_counted(counts)


def _train(docs, labels, usable, label_column, per_class, id_column, text_column, whole_per_class):
    """(model, written counts of the terms of all documents, if they were needed)"""
    sample, counts = training_sample(docs, labels, label_column, usable, per_class, id_column, text_column)
    if set(counts) != {0, 1}:
        return ToxicityModel(float(max(counts, default=0))), None
    telling = choose_vocabulary(sample, counts)
    labelled = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), *((n, pa.binary()) for n in COUNTS)])

    def counted(batches):
        count = Terms(telling)
        for batch in batches:
            found = [[x.tobytes() for pair in count(text) for x in pair] for text in batch.column("text").to_pylist()]
            yield batch_of(labelled, (batch.column("doc_id"), batch.column("label"), *(zip(*found) if found else [[]] * 4)))

    # At most 2 * per_class rows reach the driver, in the order of a hash of the id as they were chosen.
    rows = sample.mapInArrow(counted, "doc_id long, label int, " + ", ".join(f"{n} binary" for n in COUNTS)).collect()
    rows.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r.doc_id)), r.doc_id, r.label, bytes(r.terms)))
    weights = class_weights(counts)
    bare = [weights[r.label] * np.array([r.label, 1.0]) for r in rows if not r.terms]
    ones, all_bare = np.sum(bare, axis=0) if bare else (0.0, 0.0)
    rate = counts[1][0] / sum(n for n, _ in counts.values())
    model = ToxicityModel(float((ones + rate) / (all_bare + 1)))
    rows = [r for r in rows if r.terms]
    if not rows:
        return model, None
    ids, targets = [r.doc_id for r in rows], [r.label for r in rows]
    found = [((np.frombuffer(r.terms, np.int64), np.frombuffer(r.counts, np.int32)),
              (np.frombuffer(r.tells, np.int64), np.frombuffer(r.tell_counts, np.int32))) for r in rows]
    del rows
    some = sorted(i for label in (0, 1) for i in [i for i, t in enumerate(targets) if t == label][:whole_per_class])
    model.vocabulary = np.unique(np.concatenate([found[i][0][0] for i in some]))
    every = write_once(count_terms(docs, telling, id_column, text_column), "terms", "zstd")
    model.frequencies = document_frequencies(every, telling)
    model.telling, model.telling_idf = telling, model.frequencies.idf(np.array([telling_hash(t) for t in telling], np.int64))
    pick = lambda chosen, kind: ([ids[i] for i in chosen], [targets[i] for i in chosen], [model.vectors(found[i])[kind] for i in chosen])
    model.whole = WholeIndex(*pick(some, 0), len(model.vocabulary))
    model.whole_weights = class_weights({label: (counts[label][0], max(1, sum(targets[i] == label for i in some))) for label in (0, 1)})
    told = [i for i, (_, (tells, _)) in enumerate(found) if len(tells)]
    model.index, model.index_weights = Index(*pick(told, 1), len(telling)), weights
    features = [x for x, _ in model.features(found, {}, ids)]
    model.curve = fit_curve(np.array(features), np.array(targets, float), np.array([weights[t] for t in targets]))
    return model, every
