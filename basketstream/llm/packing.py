"""Packing of tokenised documents into sequences of one length.

Bounded-space online packing: a task keeps ``open_windows`` windows open. A
document is cut into full windows and a rest; the rest goes to the open window
that it fills best. When none has room, the fullest one is emitted: it is topped
up with the first ids of the rest, unless fewer than ``min_cut`` ids would be cut
off on either side, and the rest goes on. Whatever the table's size, a task holds
one batch of texts and its open windows.

*Leftovers*: windows that are still open at a task's end are merged. The tasks
are taken in groups of ``merge_tasks``; the pieces of a group (at most
``merge_tasks * open_windows * length`` ids) are packed again, and what is open
then is joined and cut into full sequences. The last rest of a group is cut into
powers of two, which need no padding.

Ids are those that the named tokenizer gives with its own settings. A text that
holds the string of one of its added tokens is encoded by it; for all others its
ranks in a faster library give the same ids. Words repeat: a worker remembers the ids of the pieces
between single spaces, which byte-level pre-tokenisation never crosses, and
encodes only new ones. Texts with other white space beside a space are encoded
whole.

Defined cases: a null text counts as empty and gives the end id alone; null and
repeated ids are packed like others, one document per row; a very long text
becomes many full sequences; an empty table gives an empty result; further
columns are ignored.
"""

import array
import base64
import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from basketstream.llm.common import batch_of, write_once

LENGTH = 2048
END_ID = 1
OPEN_WINDOWS = 64
MIN_CUT = 16
MERGE_TASKS = 16
CACHE_PIECES = 600_000  # remembered by a worker, at about 200 bytes each
VOCABULARY = "byte_bpe_50k"  # .json is the tokenizer, .tiktoken has its ids as ranks

PIECE_TYPE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, open boolean"
PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                   ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()), ("open", pa.bool_())])


class Encoder:
    """Byte-level BPE ids of whole texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.named = Tokenizer.from_file(tokenizer_path)
        self.added = [token.content for token in self.named.get_added_tokens_decoder().values()]

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.leading = np.zeros(max(ranks.values()) + 1, bool)
        self.leading[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.known = {}

    def whole(self, text: str) -> bytes:
        return array.array("I", self.plain(text)).tobytes()

    def learn(self, texts) -> None:
        """Encode the pieces of ``texts`` that are not known yet, in one call."""
        new = set()
        for text in texts:
            new.update(text.split(" ")[1:])
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        new = [p for p in new.difference(self.known) if p and not (p[0].isspace() or p[-1].isspace())]
        for at in range(0, len(new), 1 << 16):
            part = new[at : at + (1 << 16)]
            ids = np.array(self.plain(" " + " ".join(part)), np.uint32)
            # Exactly the first token of each piece starts with the space before it.
            starts = np.flatnonzero(self.leading[ids])
            data, ends = ids.tobytes(), [*(4 * starts[1:]).tolist(), 4 * len(ids)]
            self.known.update(zip(part, (data[a:b] for a, b in zip((4 * starts).tolist(), ends))))

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return array.array("I", self.named.encode(text, add_special_tokens=False).ids).tobytes()
        pieces = text.split(" ")
        if len(pieces) == 1 or pieces[0][-1:].isspace() or not pieces[0]:
            return self.whole(text)
        try:
            return self.whole(pieces[0]) + b"".join(map(self.known.__getitem__, pieces[1:]))
        except KeyError:  # white space beside a space, or more pieces than are remembered
            return self.whole(text)


_ENCODERS = {}


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _ENCODERS:
        import public_tokenizers

        files = [public_tokenizers.path(f"{vocabulary}.{kind}") for kind in ("json", "tiktoken")]
        _ENCODERS[vocabulary] = Encoder(*files, public_tokenizers.PATTERN)
    return _ENCODERS[vocabulary]


class Packer:
    """Open windows of one task. A piece is (doc_id, start, ids, doc_tokens); ids have 4 bytes each."""

    def __init__(self, length: int, open_windows: int, min_cut: int, first_id: int):
        self.length, self.most, self.min_cut, self.next_id = length, open_windows, min_cut, first_id
        self.windows = []  # (room, number, pieces), sorted: the fullest first
        self.count = 0
        self.rows = []

    def emit(self, pieces):
        at = 0
        for doc, start, ids, tokens in pieces:
            self.rows.append((doc, start, len(ids) // 4, tokens, self.next_id, at, ids, False))
            at += len(ids) // 4
        self.next_id += 1

    def add(self, doc, start, ids, tokens):
        whole = 4 * self.length
        while len(ids) >= whole:
            self.emit([(doc, start, ids[:whole], tokens)])
            start, ids = start + self.length, ids[whole:]
        while ids:
            need = len(ids) // 4
            at = bisect.bisect_left(self.windows, (need,))
            if at < len(self.windows):  # best fit: the smallest room that suffices
                room, _, pieces = self.windows.pop(at)
            elif len(self.windows) < self.most:
                room, pieces = self.length, []
            else:
                room, _, pieces = self.windows.pop(0)
                if room >= self.min_cut and need - room >= self.min_cut:
                    pieces.append((doc, start, ids[: 4 * room], tokens))
                    start, ids = start + room, ids[4 * room :]
                self.emit(pieces)
                continue
            pieces.append((doc, start, ids, tokens))
            ids = b""
            if room == need:
                self.emit(pieces)
            else:
                self.count += 1
                bisect.insort(self.windows, (room - need, self.count, pieces))

    def leftovers(self):
        """Pieces of the open windows, which close without being emitted."""
        pieces = [piece for _, _, window in self.windows for piece in window]
        self.windows = []
        return pieces

    def finish(self):
        """Join what is open, cut it into full sequences, and the last rest into powers of two."""
        open_pieces = self.leftovers()
        total = sum(len(p[2]) // 4 for p in open_pieces)
        sizes = [self.length] * (total // self.length)
        rest = total % self.length
        sizes += [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
        window, room = [], sizes.pop(0) if sizes else 0
        for doc, start, ids, tokens in open_pieces:
            while ids:
                part = ids[: 4 * room]
                window.append((doc, start, part, tokens))
                start, ids, room = start + len(part) // 4, ids[4 * room :], room - len(part) // 4
                if not room:
                    self.emit(window)
                    window, room = [], sizes.pop(0) if sizes else 0


def pack(docs: DataFrame, id_column="doc_id", text_column="text", vocabulary=VOCABULARY, length=LENGTH, end_id=END_ID,
         open_windows=OPEN_WINDOWS, min_cut=MIN_CUT, merge_tasks=MERGE_TASKS, extra=None, keep_ids=True) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers; a
    document's ids end with ``end_id``. A sequence is its pieces by ``offset``,
    padded to ``length`` unless it has a power of two of ids. ``extra`` (name ->
    column over these) adds columns; with ``keep_ids`` off, ids are dropped after them.
    """
    end = np.uint32(end_id).tobytes()
    extra = extra or {}

    def packed(batches):
        task = TaskContext.get().partitionId()
        encode, packer = encoder(vocabulary), Packer(length, open_windows, min_cut, task << 32)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            encode.learn(texts)
            for doc, text in zip(ids, texts):
                data = encode.ids(text) + end
                packer.add(doc, 0, data, len(data) // 4)
                if len(packer.rows) >= 4096:
                    yield batch_of(PIECE, zip(*packer.rows))
                    packer.rows = []
        rows = packer.rows + [(d, s, len(i) // 4, n, task, None, i, True) for d, s, i, n in packer.leftovers()]
        if rows:
            yield batch_of(PIECE, zip(*rows))

    def merged(key, rows):
        packer = Packer(length, open_windows, min_cut, (1 << 62) + (key[0].as_py() << 32))
        pieces = zip(*(rows.column(n).to_pylist() for n in ("doc_id", "start", "ids", "doc_tokens")))
        for piece in sorted(pieces, key=lambda p: (-len(p[2]), p[0] is None, p[0] or 0, p[1])):
            packer.add(*piece)
        packer.finish()
        return pa.Table.from_batches([batch_of(PIECE, zip(*packer.rows))])

    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    kept = [*names, *(["ids"] if keep_ids else []), *extra]
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    pieces = texts.mapInArrow(packed, PIECE_TYPE).withColumns(extra)
    if not keep_ids:
        pieces = pieces.withColumn("ids", F.expr("CASE WHEN open THEN ids END"))
    pieces = write_once(pieces, "pieces", "zstd")
    left = pieces.where("open").withColumn("group", F.floor(F.col("sequence_id") / merge_tasks))
    joined = left.groupBy("group").applyInArrow(merged, PIECE_TYPE).withColumns(extra)
    return pieces.where("NOT open").select(*kept).unionByName(joined.select(*kept))
