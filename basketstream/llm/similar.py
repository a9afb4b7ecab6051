"""Near-duplicates by the exact similarity of shingle sets, proposed by SimHash anchors and MinHash bands.

A text's set holds the 64-bit hashes of its runs of ``SHINGLE`` words (fewer words are
one run). Texts are linked if the Jaccard similarity of their sets is ``SIMILARITY`` or
more. Texts of the same set, told by a 64-bit digest of it, are one node from the start.

*Proposals.* Sets whose SimHash differs in at most three bits meet at the anchors of the
covering code (``simhash.links``) and are in one candidate group. Similarity 0.8 is too
far for anchors, as about ten bits differ then; what they cannot reach is proposed by
MinHash. A signature has ``BANDS`` bands of ``ROWS`` minima. Sets that agree in a
band are in one candidate group too, so are groups that share a set. Two sets of
similarity 0.8 miss each other in all bands about 5 times in a million; sets without
a common shingle hardly ever meet. Each task first links the sets that share a band
among its own and passes on one of them per band, so that a band that a third of all
sets have costs one row per task.

*Links.* The sets of a candidate group are walked: a set takes all those it is linked to
out of the rest, then each of them does so, which gives a spanning forest of the links.
A group is cut into blocks by hash, of at most ``block`` sets and about
``BLOCK_SHINGLES`` shingles, and every pair of blocks is a task.

*What moves.* Rows are named by file and position, so that only numbers are shuffled;
texts are read where they lie. Those of candidates move once, to be compared, and the
result is the input without the rows that are dropped.

Defined cases: null and empty texts, and texts of white space, have the empty set and
are equal; null ids are ignored when the smallest id of a component is sought, and a
component in which every id is null keeps one row; where that id is repeated, one of
its rows stays; further columns are carried along, whatever their names; an empty table
gives an empty result. A very long text is one set, held whole by the tasks that
compare it.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from basketstream.llm import simhash
from basketstream.llm.common import batch_of, bytes_of, write_once
from basketstream.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 6
BLOCK = 1000
BLOCK_SHINGLES = 1 << 21
CHUNK = 1024  # shingles whose minima are taken at a time
BROADCAST_ROWS = 500_000  # of three numbers
SEED = 42
_draw = np.random.default_rng(SEED)
FLIP = _draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
FACTOR = _draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = ["file", "position"]


def shingles(text: bytes, words_each: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes; words as in ``simhash.fingerprint``."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(words) - words_each + 1)
    spans = zip(starts[:count].tolist(), ends[-count:].tolist())
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, count))


def bands(found: np.ndarray) -> np.ndarray:
    """One key per band."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), CHUNK):
        np.minimum(least, ((found[at : at + CHUNK] ^ FLIP[:, None]) * FACTOR[:, None]).min(1), out=least)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def forest(sets: list, similarity: float = SIMILARITY):
    """Index pairs that connect what links of ``similarity`` or more connect."""
    sizes, out = np.array([len(s) for s in sets]), []
    left = np.flatnonzero(sizes)
    if len(left) < 2:
        return out
    # Shingles as small numbers: membership in a set is then a look into a table.
    known, codes = np.unique(np.concatenate([sets[i] for i in left]), return_inverse=True)
    codes, ends = codes.astype(np.int32), np.cumsum(sizes[left])
    spans = {i: (end - sizes[i], end) for i, end in zip(left.tolist(), ends.tolist())}
    rest, rest_sizes = codes, sizes[left]
    inside = np.zeros(len(known), np.uint8)
    while len(left) > 1:
        wait, first = [left[0]], True
        while wait and len(left):
            one = wait.pop()
            if first:
                rest, rest_sizes, left, first = rest[rest_sizes[0] :], rest_sizes[1:], left[1:], False
                if not len(left):
                    break
            own = codes[slice(*spans[one])]
            inside[own] = 1
            both = np.add.reduceat(inside[rest], np.cumsum(rest_sizes) - rest_sizes, dtype=np.int64)
            inside[own] = 0
            near = both >= similarity * (rest_sizes + sizes[one] - both) - 1e-9
            if near.any():
                taken = left[near].tolist()
                out += [(one, other) for other in taken]
                wait.extend(taken)
                rest, left, rest_sizes = rest[np.repeat(~near, rest_sizes)], left[~near], rest_sizes[~near]
    return out


def _marks(rows: DataFrame, words_each: int) -> DataFrame:
    """Place, id, print (digest of the set), simhash, n_shingles and bands of every row."""
    schema = pa.schema([("file", pa.int64()), ("position", pa.int64()), ("id", pa.int64()), ("print", pa.int64()),
                        ("simhash", pa.int64()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def mark(batches):
        for batch in batches:
            sets = [shingles(t, words_each) for t in batch.column("text").to_pylist()]
            prints = [xxhash.xxh64_intdigest(s.tobytes(), SEED) - (1 << 63) for s in sets]
            near = np.array([simhash.fingerprint_of(s) for s in sets], np.uint64).view(np.int64)
            yield batch_of(schema, (*(batch.column(n) for n in (*PLACE, "id")), prints, near, [len(s) for s in sets], [bands(s) for s in sets]))

    return rows.select(*PLACE, "id", "text").mapInArrow(
        mark, "file long, position long, id long, print long, simhash long, n_shingles long, bands array<long>")


STAR = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
STAR_TYPE = "key long, a long, b long"


def _stars(keys: np.ndarray, prints: np.ndarray):
    """(first print of every key, with its key; edges from it to the others of the key)."""
    order = np.lexsort((prints, keys))
    keys, prints = keys[order], prints[order]
    opens = np.concatenate([[True], keys[1:] != keys[:-1]])
    centre = prints[np.maximum.accumulate(np.where(opens, np.arange(len(keys)), 0))]
    spoke = ~opens & (centre != prints)
    return keys[opens], prints[opens], np.unique(np.stack([centre[spoke], prints[spoke]], 1), axis=0)


def _anchored(distinct: DataFrame) -> DataFrame:
    """Edges a, b between prints whose SimHash meets within the threshold at an anchor of the covering code.

    Sets of one SimHash are a star around the smallest print, which stands for them.
    """
    groups = write_once(distinct.groupBy("simhash").agg(F.min("print").alias("centre")), "simhashes")
    same = distinct.join(groups, "simhash").where("print <> centre").select(F.col("centre").alias("a"), F.col("print").alias("b"))
    links = simhash.links(groups.select(F.col("simhash").alias("print")))
    first = groups.select(F.col("simhash").alias("a"), F.col("centre").alias("_a"))
    second = groups.select(F.col("simhash").alias("b"), F.col("centre").alias("_b"))
    return same.unionByName(links.join(first, "a").join(second, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))


def _banded(distinct: DataFrame) -> DataFrame:
    """Edges a, b between prints that share a band: stars, first among each task's own, then among those left of every task."""

    def local(batches):
        for batch in batches:
            prints, lists = batch.column("print").to_numpy(), batch.column("bands")
            keys, prints, edges = _stars(lists.flatten().to_numpy(), np.repeat(prints, BANDS))
            yield batch_of(STAR, (keys, prints, pa.nulls(len(keys), pa.int64())))
            yield batch_of(STAR, (pa.nulls(len(edges), pa.int64()), edges[:, 0], edges[:, 1]))

    def meet(batches):
        key = first = None
        for batch in batches:
            keys, prints = batch.column("key").to_numpy(), batch.column("a").to_numpy()
            if not len(keys):
                continue
            if keys[0] == key:
                keys, prints = np.concatenate([[key], keys]), np.concatenate([[first], prints])
            opens = np.concatenate([[True], keys[1:] != keys[:-1]])
            last = np.maximum.accumulate(np.where(opens, np.arange(len(keys)), 0))
            key, first = keys[-1], prints[last[-1]]
            centre = prints[last]
            spoke = centre != prints
            yield batch_of(STAR, (pa.nulls(int(spoke.sum()), pa.int64()), centre[spoke], prints[spoke]))

    near = write_once(distinct.select("print", "bands").mapInArrow(local, STAR_TYPE), "band-stars")
    far = near.where("key IS NOT NULL").select("key", "a").repartition("key").sortWithinPartitions("key", "a").mapInArrow(meet, STAR_TYPE)
    return near.where("key IS NULL").unionByName(far).select("a", "b").distinct()


def _links(grouped: DataFrame, words_each: int, similarity: float) -> DataFrame:
    """Links inside the groups of equal ``key``; ``grouped`` has key, print, text."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches):
        key, prints, sets = None, [], []

        def settle():
            pairs = forest(sets, similarity)
            return batch_of(schema, ([prints[a] for a, _ in pairs], [prints[b] for _, b in pairs]))

        for batch in batches:
            for k, p, t in zip(*(batch.column(n) for n in ("key", "print", "text"))):
                k = k.as_py()
                if k != key:
                    if len(sets) > 1:
                        yield settle()
                    key, prints, sets = k, [], []
                prints.append(p.as_py())
                sets.append(shingles(t.as_py(), words_each))
        if len(sets) > 1:
            yield settle()

    return grouped.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "a long, b long")


def _small(df: DataFrame) -> DataFrame:
    """``df``, which is written already, with the broadcast hint if it has few rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _placed(docs: DataFrame) -> DataFrame:
    """``docs``, read from files, with the columns of ``PLACE`` (prefixed) behind its own."""
    path = F.col("_metadata.file_path")
    names = docs.select(path.alias("path")).distinct().agg(F.count("*"), F.count_distinct(F.xxhash64("path"))).first()
    assert names[0] == names[1], "two file names have the same hash"
    return docs.select("*", F.xxhash64(path).alias("_file"), F.col("_metadata.row_index").alias("_position"))


def _dropped(rows: DataFrame, words_each: int, similarity: float, block: int) -> DataFrame:
    """Places of the rows that another one stands for; ``rows`` has file, position, id, text."""
    marked = write_once(_marks(rows, words_each), "bands")
    distinct = marked.groupBy("print").agg(
        F.first("simhash").alias("simhash"), F.first("bands").alias("bands"))
    near = components(_anchored(distinct.select("print", "simhash")).unionByName(_banded(distinct)))
    group = near.select(F.col("node").alias("print"), "root").unionByName(near.select(F.col("root").alias("print"), "root").distinct())
    group = write_once(group.join(marked.groupBy("print").agg(
        F.min(F.struct(*PLACE)).alias("place"), F.first("n_shingles").alias("n_shingles")), "print"), "candidates")
    blocks = F.greatest(F.ceil(F.count("*") / F.lit(block)), F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES)))
    sizes = group.groupBy("root").agg(blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("print"), F.col("blocks"))
    texts = rows.select(*PLACE, "text").join(_small(write_once(group.select("print", "root", "place.*"), "candidate-rows")), PLACE)
    tasks = texts.join(_small(write_once(sizes, "blocks")), "root").withColumn("own", own).select(
        "root", "print", "text", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    keyed = tasks.select(F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "print", "text")
    linked = components(write_once(_links(keyed, words_each, similarity), "links")).withColumnRenamed("node", "print")
    roots = marked.select(*PLACE, "id", "print").join(linked, "print", "left").withColumn("root", F.coalesce("root", "print"))
    chosen = roots.groupBy("root").agg(
        F.count("*").alias("n"), F.min_by(F.struct(*PLACE), F.struct(F.col("id").isNull(), "id", "print", *PLACE)).alias("kept")).where("n > 1")
    return roots.join(chosen, "root").where(F.struct(*PLACE) != F.col("kept")).select(*PLACE)


def keep_one(docs: DataFrame, id_column="doc_id", text_column="text", words_each=SHINGLE, similarity=SIMILARITY, block=BLOCK,
             from_files=False) -> DataFrame:
    """The rows of ``docs`` with one row of each component, that of the smallest id, and the columns of ``docs``.

    ``from_files`` says that ``docs`` is a plain read of files, whose rows can be named
    by their places; otherwise it is written first.
    """
    placed = _placed(docs if from_files else write_once(docs, "similar", "zstd"))
    rows = placed.select(F.col("_file").alias("file"), F.col("_position").alias("position"),
                         F.col(f"`{id_column}`").cast("long").alias("id"), bytes_of(f"`{text_column}`").alias("text"))
    gone = write_once(_dropped(rows, words_each, similarity, block).select(F.col("file").alias("_file"), F.col("position").alias("_position")), "dropped")
    return placed.join(_small(gone), ["_file", "_position"], "left_anti").drop("_file", "_position").select(docs.columns)
