"""Near-duplicates by SimHash, found through the anchor points of a covering code.

A fingerprint has 64 bits. Two halves of 31 bits are looked at (two bits are left
over): fingerprints that differ in at most 3 bits differ in at most 1 bit in at
least one half. The anchors of a half are the words of the [31, 26] Hamming code,
which covers all 31-bit words with radius 1. So

* every fingerprint has one *home* anchor per half, at distance 0 or 1, and
* is replicated to all anchors within radius + threshold = 1 + 1 = 2 of the half,
  which are 1 (a code word) or 16 anchors.

If two halves differ in at most one bit, the home anchor of either is among the
anchors of the other. Both fingerprints meet there and all 64 bits are compared.
With 2 x 2^26 anchors, unrelated fingerprints hardly ever meet.

Equal fingerprints are one row from the start, so a group of copies costs what
one document costs. Within an anchor, links are found by walking: a fingerprint
takes all those within the threshold out of the rest, then each of them does so.
That gives a spanning forest of the links instead of all pairs, and takes time
(members that are taken late) x (members), which is small for a cloud of
near-copies. An anchor with more than ``block`` fingerprints is cut into blocks
by hash, and every pair of blocks is compared as a task of its own: exact, with
bounded memory, at any size.

Defined cases: null and empty texts, and texts of white space, have fingerprint
0, which links like any other; a null id is ignored when the smallest id of a
group is sought, and such a row keeps its own null id; repeated rows are copies;
an empty table gives an empty result; other columns are carried along.
"""

import numpy as np
import pyarrow as pa
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from basketstream.llm.common import batch_of, bytes_of, write_once
from basketstream.llm.components import components

SHINGLE = 3
SEED = 42
THRESHOLD = 3
BLOCK = 1 << 14
CHUNK = 1 << 16  # shingles that are held as numbers at a time
HALF_BITS = 31
HALF = (1 << HALF_BITS) - 1


def fingerprint(text: bytes | None, words_each: int = SHINGLE) -> int:
    """Unsigned SimHash of the whole text; see ``op3`` for the definition of words and shingles."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    count = max(1, len(words) - words_each + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    ends = ends[-count:]
    set_bits, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, count, CHUNK):
        spans = zip(starts[at : min(at + CHUNK, count)].tolist(), ends[at : at + CHUNK].tolist())
        set_bits += _bit_counts(np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64))
    return _majority(set_bits, count)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _majority(set_bits: np.ndarray, count: int) -> int:
    return int(np.packbits(2 * set_bits > count, bitorder="little").view(np.uint64)[0])


def fingerprint_of(hashes: np.ndarray) -> int:
    """Unsigned SimHash of shingle hashes that are made already; 0 of none."""
    counts = (_bit_counts(hashes[at : at + CHUNK]) for at in range(0, len(hashes), CHUNK))
    return _majority(sum(counts, np.zeros(64, np.int64)), len(hashes))


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


# Hamming code: position p (1 to 31) of a half is bit p - 1; the syndrome of a word is the xor of its set positions.
PARITY = np.array([sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1) for k in range(5)], np.uint64)
HOME = np.array([0] + [1 << (s - 1) for s in range(1, 32)], np.uint64)
PAIRS = np.array([[0] * 15] + [[(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if 0 < (i ^ s) and i < (i ^ s)]
                               for s in range(1, 32)], np.uint64)


def syndrome(half: np.ndarray) -> np.ndarray:
    return sum((np.bitwise_count(half & PARITY[k]).astype(np.int64) & 1) << k for k in range(5))


def anchors(prints: np.ndarray):
    """(anchor, index into ``prints``, is home) of all anchors, for both halves."""
    out, index = [], np.arange(len(prints))
    for part in (0, 1):
        half = (prints >> np.uint64(part * HALF_BITS)) & np.uint64(HALF)
        found, mark = syndrome(half), np.uint64(part << HALF_BITS)
        out.append(((half ^ HOME[found]) | mark, index, np.ones(len(prints), bool)))
        far = np.flatnonzero(found)  # a code word has no other anchor within 2
        out.append((((half[far, None] ^ PAIRS[found[far]]) | mark).ravel(), np.repeat(far, 15), np.zeros(15 * len(far), bool)))
    return tuple(np.concatenate(column) for column in zip(*out))


def forest(prints: np.ndarray, threshold: int = THRESHOLD):
    """Index pairs that connect what links within ``threshold`` bits connect."""
    left, limit = np.arange(len(prints)), threshold
    sources, targets = [], []
    while len(left) > 1:
        wait, left = [left[0]], left[1:]
        while wait and len(left):
            one = wait.pop()
            near = np.bitwise_count(prints[left] ^ prints[one]) <= limit
            if near.any():
                taken, left = left[near], left[~near]
                sources.append(np.full(len(taken), one))
                targets.append(taken)
                wait.extend(taken.tolist())
    if not sources:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(sources), np.concatenate(targets)


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("anchor", pa.int64())])
LINK_TYPE = "a long, b long, anchor long"


def _links(keys, prints, home, threshold):
    """Links inside the runs of equal ``keys``, which are sorted. Runs without a home fingerprint hold no new link."""
    edges = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
    if not len(keys):
        return prints[:0], prints[:0]
    use = (ends - starts > 1) & (np.add.reduceat(home, starts) > 0)
    starts, sizes = starts[use], (ends - starts)[use]
    a, b = [], []
    two = starts[sizes == 2]
    two = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= threshold]
    a.append(prints[two])
    b.append(prints[two + 1])
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        members = prints[start : start + size]
        one, other = forest(members, threshold)
        a.append(members[one])
        b.append(members[other])
    return np.concatenate(a), np.concatenate(b)


def _compare(threshold, block, key_names):
    """Task: rows sorted by key; runs up to ``block`` are compared, longer ones are passed on."""

    def rows(a, b, anchor):
        return batch_of(LINK, (a.view(np.int64), None if b is None else b.view(np.int64), anchor)) if b is not None else (
            pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.nulls(len(a), pa.int64()), pa.array(anchor)], schema=LINK))

    def compare(batches):
        keys = prints = home = None
        passing = None  # a key whose run is longer than a block
        for batch in batches:
            new = [batch.column(n).to_numpy(zero_copy_only=False) for n in key_names]
            new_key = new[0] if len(new) == 1 else new[0] * (1 << 32) + new[1]
            p = batch.column("print").to_numpy().view(np.uint64)
            h = batch.column("home").to_numpy(zero_copy_only=False).astype(np.int64)
            if keys is None:
                keys, prints, home = new_key, p, h
            else:
                keys, prints, home = (np.concatenate(x) for x in ((keys, new_key), (prints, p), (home, h)))
            if passing is not None:
                cut = int(np.searchsorted(keys != passing, True)) if keys[0] == passing else 0
                cut = len(keys) if cut == 0 and keys[0] == passing and (keys == passing).all() else cut
                if cut:
                    yield rows(prints[:cut], None, keys[:cut])
                    keys, prints, home = keys[cut:], prints[cut:], home[cut:]
                if not len(keys):
                    keys = None
                    continue
                passing = None
            last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
            yield from _settle(keys[:last], prints[:last], home[:last])
            keys, prints, home = keys[last:], prints[last:], home[last:]
            if len(keys) > block:
                passing = keys[0]
                yield rows(prints, None, keys)
                keys = None
        if keys is not None and len(keys):
            yield from _settle(keys, prints, home)

    def _settle(keys, prints, home):
        if not len(keys):
            return
        a, b = _links(keys, prints, home, threshold)
        if len(a):
            yield rows(a, b, np.zeros(len(a), np.int64))

    return compare


def links(prints: DataFrame, threshold: int = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """a, b: links between distinct fingerprints (column ``print``), enough to connect all that are linked."""
    assert 0 <= threshold <= 3, "two halves and radius 1 cover up to three differing bits"
    schema = pa.schema([("anchor", pa.int64()), ("print", pa.int64()), ("home", pa.bool_())])

    def replicate(batches):
        for batch in batches:
            values = batch.column("print").to_numpy()
            anchor, index, home = anchors(values.view(np.uint64))
            yield batch_of(schema, (anchor.view(np.int64), values[index], home))

    def compared(rows, keys, limit):
        return write_once(rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
            _compare(threshold, limit, keys), LINK_TYPE), "links")

    replicas = prints.select("print").mapInArrow(replicate, "anchor long, print long, home boolean")
    found = compared(replicas, ["anchor"], block)
    large = found.where("b IS NULL").select("anchor", F.col("a").alias("print"))
    out = found.where("b IS NOT NULL").select("a", "b")
    if not large.isEmpty():
        sizes = large.groupBy("anchor").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
        own = F.pmod(F.xxhash64("print"), F.col("blocks"))
        pairs = large.join(sizes, "anchor").withColumn("own", own).select(
            "anchor", "print", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        keyed = pairs.select(
            F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other")).alias("anchor"),
            "print", F.lit(True).alias("home"))
        out = out.unionByName(compared(keyed, ["anchor"], 1 << 62).select("a", "b"))
    return out


def _groups(rows: DataFrame, threshold: int, block: int) -> DataFrame:
    """print, root, component_id of every distinct print; ``rows`` has id, print."""
    distinct = write_once(rows.groupBy("print").agg(F.min("id").alias("least")), "distinct-prints")
    linked = components(links(distinct, threshold, block))
    roots = distinct.join(linked.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return roots.join(least, "root").select("print", "root", "component_id")


def mark_components(docs: DataFrame, id_column="doc_id", text_column="text", threshold=THRESHOLD, block=BLOCK) -> DataFrame:
    """One row per row of ``docs``: id, print (signed), component_id, the smallest id that links reach."""
    rows = write_once(docs.select(F.col(id_column).cast("long").alias("id"), _fingerprints(bytes_of(text_column)).alias("print")), "prints")
    return rows.join(_groups(rows, threshold, block), "print").select(
        "id", "print", F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_column="doc_id", text_column="text", threshold=THRESHOLD, block=BLOCK) -> DataFrame:
    """The rows of ``docs`` with one row of each component, that of the smallest id, and the columns of ``docs``.

    Where that id is repeated, one row with the smallest fingerprint stays; a
    component in which every id is null keeps one row.
    """
    rows = write_once(docs.select(
        F.col(id_column).cast("long").alias("id"), _fingerprints(bytes_of(text_column)).alias("print"),
        F.monotonically_increasing_id().alias("row"), F.struct("*").alias("carried")), "prints", "zstd")
    # Numbers decide; whole rows move once, in the last join.
    marked = rows.select("id", "print", "row").join(_groups(rows, threshold, block), "print")
    chosen = marked.groupBy("root").agg(F.min_by("row", F.struct(F.col("id").isNull(), "id", "print", "row")).alias("row"))
    return rows.join(chosen, "row", "left_semi").select("carried.*")
