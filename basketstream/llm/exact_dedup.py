"""Exact duplicates by compressed radix tries.

Texts are equal when they are identical after every run of ASCII white space
(space, tab to carriage return) became one space.

1. *Before the shuffle* each task keeps one row per distinct text that it has
   met; later copies only raise that row's count. A text that a third of all
   rows carry therefore leaves each task once.
2. Rows are dealt by (length, content hash of the text), sorted by the same two
   and by id, and inserted as full byte strings into one radix trie per
   (length, hash). Equality is decided by the bytes in the trie, never by the
   hash. A terminal node holds the smallest identifier seen, and how many rows
   stand behind it.
3. A trie that outgrows ``trie_bytes`` *spills by subtree*: its largest subtree
   goes, as rows with the bytes that lead to it, to a written table, which the
   next round deals again by (length, hash, more leading bytes). Only unequal texts of equal
   length and hash share a trie, so this is rare with a 64-bit hash; smaller
   ``hash_bits`` force it.

Defined cases: a null text counts as empty; a row with a null id comes after all
others of its group; rows with equal ids and texts are a group of copies like
any other, and one row of them stays; an empty table gives an empty result;
further columns are carried along by ``keep_first`` whatever their names.
"""

import hashlib
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from basketstream.llm.common import batch_of, bytes_of, squeeze, write_once

HASH_BITS = 64
TRIE_BYTES = 256 << 20
COMBINE_BYTES = 96 << 20  # texts a task remembers before the shuffle; beyond it starts anew
NO_ID = (1 << 63) - 1  # stands for a null id when ids are compared


class Trie:
    """Compressed radix trie over byte strings.

    A node is [edge label, children by first byte, terminal value, bytes below].
    """

    def __init__(self):
        self.root = [b"", {}, None, 0]

    @property
    def size(self):
        return self.root[3]

    def insert(self, key: bytes, value, merge):
        """Add ``value`` at ``key``, where values that meet become merge(old, new); gives what is there."""
        node, at, way = self.root, 0, [self.root]
        added = 0
        while True:
            rest = len(key) - at
            if not rest:
                node[2] = value if node[2] is None else merge(node[2], value)
                break
            child = node[1].get(key[at])
            if child is None:
                size, added = rest + 100, added + rest + 100
                node[1][key[at]] = node = [key[at:], {}, value, size]
                break
            label = child[0]
            same = len(label) if key.startswith(label, at) else _common(label, key, at)
            if same < len(label):  # the edge is cut where the strings part
                lower = [label[same:], child[1], child[2], child[3] - same]
                child[:] = [label[:same], {label[same]: lower}, None, child[3]]
                added += 100
            node, at = child, at + same
            way.append(node)
        if added:
            for above in way:
                above[3] += added
        return node[2]

    def terminals(self, node=None, lead=b""):
        """(key, value) of all terminals, depth first, without recursion."""
        stack = [(node or self.root, lead)]
        while stack:
            node, lead = stack.pop()
            lead += node[0]
            if node[2] is not None:
                yield lead, node[2]
            stack += [(child, lead) for child in node[1].values()]

    def cut_largest(self):
        """Remove the largest subtree below the first branching.

        Gives the bytes that lead to it and its terminals, or None when the trie
        holds a single string.
        """
        node, lead, way = self.root, b"", []
        while len(node[1]) == 1 and node[2] is None:
            way.append(node)
            lead += node[0]
            node = next(iter(node[1].values()))
        lead += node[0]
        if not node[1]:
            return None
        first, child = max(node[1].items(), key=lambda item: item[1][3])
        del node[1][first]
        for above in [*way, node]:
            above[3] -= child[3]
        return lead + child[0], list(self.terminals(child, lead))


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common start of ``label`` and ``key[at:]``, by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[:middle] == key[at : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def content_hash(text: bytes, bits: int = HASH_BITS) -> int:
    """Signed 64-bit hash of which only the upper ``bits`` are used."""
    value = xxhash.xxh64_intdigest(text) >> (64 - bits) if bits else 0
    return value - (1 << 64) if value >> 63 else value


def _first_of_task(combine_bytes):
    """Rows as (row number, number of the row that speaks for it, normalised text, sha256).

    ``text`` is set for the speaking row alone, which is the first of its text.
    """

    def assign(batches, text_column):
        task, row, held, known = TaskContext.get().partitionId() << 40, 0, 0, {}
        for batch in batches:
            rows, speaks, texts, digests = [], [], [], []
            for value in batch.column(text_column).to_pylist():
                text = squeeze(value or b"")
                number = task + row
                row += 1
                speaker = known.get(text)
                if speaker is None:
                    if held > combine_bytes:
                        known.clear()
                        held = 0
                    speaker = number, hashlib.sha256(text).hexdigest()
                    known[text] = speaker
                    held += len(text) + 200
                    texts.append(text)
                else:
                    texts.append(None)
                rows.append(number)
                speaks.append(speaker[0])
                digests.append(speaker[1])
            yield batch, rows, speaks, texts, digests

    return assign


ROW_TYPE = "id long, row long, speaker long, text_sha256 string, length long, hash long, text binary"


def mark_rows(docs: DataFrame, id_column="doc_id", text_column="text", carry=False, combine_bytes=COMBINE_BYTES,
              hash_bits=HASH_BITS, trie_bytes=TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the smallest id of the group; ``kept`` holds for one row of it.
    With ``carry`` the whole row of ``docs`` comes along as the struct ``carried``.
    """
    columns = [F.col(id_column).cast("long").alias("id"), bytes_of(text_column).alias("text")]
    row_type = T.StructType.fromDDL(ROW_TYPE)
    if carry:
        columns.append(F.struct("*").alias("carried"))
        row_type.add("carried", docs.schema)
    assign = _first_of_task(combine_bytes)

    def first(batches):
        for batch, rows, speaks, texts, digests in assign(batches, "text"):
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(rows, pa.int64()), pa.array(speaks, pa.int64()),
                pa.array(digests, pa.string()), pa.array([None if t is None else len(t) for t in texts], pa.int64()),
                pa.array([None if t is None else content_hash(t, hash_bits) for t in texts], pa.int64()),
                pa.array(texts, pa.binary()), *([batch.column("carried")] if carry else []),
            ], names=[part.split()[0] for part in ROW_TYPE.split(", ")] + ["carried"] * carry)

    rows = write_once(docs.select(*columns).mapInArrow(first, row_type), "dedup-rows", "zstd")
    behind = rows.groupBy("speaker").agg(
        F.min(F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "row")).alias("first"), F.count("*").alias("n"))
    speakers = rows.where("text IS NOT NULL").select(F.col("row").alias("speaker"), "length", "hash", "text")
    # The counts are a few bytes a row: they join first, so that texts move only once.
    owners = _owners(speakers, trie_bytes).join(behind, "speaker")
    groups = owners.groupBy("owner").agg(F.min("first").alias("keep"), F.sum("n").alias("group_size"))
    decided = owners.select("speaker", "owner").join(groups, "owner").select("speaker", "keep", "group_size")
    return rows.drop("length", "hash", "text").join(decided, "speaker").select(
        "id", F.when(F.col("keep.id") != NO_ID, F.col("keep.id")).alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256", *(["carried"] if carry else []))


def keep_first(docs: DataFrame, id_column="doc_id", text_column="text", **settings) -> DataFrame:
    """The rows of ``docs`` without later copies, with the columns of ``docs``."""
    marked = mark_rows(docs, id_column, text_column, carry=True, **settings)
    return marked.where("kept").select("carried.*")


OWNER_TYPE = "speaker long, owner long, length long, hash long, text binary, lead binary"
OWNER_ARROW = pa.schema([("speaker", pa.int64()), ("owner", pa.int64()), ("length", pa.int64()),
                         ("hash", pa.int64()), ("text", pa.binary()), ("lead", pa.binary())])


def _owners(speakers: DataFrame, trie_bytes: int) -> DataFrame:
    """speaker, owner: speaking rows with equal texts have the smallest of them as owner."""

    def owners(batches):
        """Rows of one (length, hash, lead) come together, in the order of their number."""
        current, trie, spilled, out = None, Trie(), [], []
        for batch in batches:
            for row in batch.to_pylist():
                key = row["length"], row["hash"], row["lead"]
                if key != current:
                    current, trie, spilled = key, Trie(), []
                text, speaker = row["text"], row["speaker"]
                lead = next((x for x in spilled if text.startswith(x)), None)
                if lead is not None:  # its subtree was spilled: it follows
                    out.append((speaker, None, *key[:2], text, lead))
                    continue
                # Rows are sorted, so the first of a text is the smallest: all others name it.
                out.append((speaker, trie.insert(text, speaker, min), None, None, None, None))
                while trie.size > trie_bytes and (cut := trie.cut_largest()):
                    spilled.append(cut[0])
                    # The owner met so far travels along and stays the smallest.
                    out += [(owner, None, *key[:2], text, cut[0]) for text, owner in cut[1]]
            yield batch_of(OWNER_ARROW, zip(*out) if out else [[]] * 6)
            out = []

    names = ["speaker", "length", "hash", "text", "lead"]
    parts, rows = [], speakers.withColumn("lead", F.lit(None).cast("binary"))
    while True:
        dealt = rows.select(*names).repartition("length", "hash", "lead")
        settled = write_once(dealt.sortWithinPartitions("length", "hash", "lead", "speaker").mapInArrow(
            owners, OWNER_TYPE), "dedup-owners")
        parts.append(settled.where("owner IS NOT NULL").select("speaker", "owner"))
        rows = settled.where("owner IS NULL")
        if rows.isEmpty():
            break
    # An owner that was spilled is settled twice, both times as itself.
    return reduce(DataFrame.unionByName, parts).distinct() if len(parts) > 1 else parts[0]
