"""Encoding and decoding with the pieces of a SentencePiece model, by streaming Viterbi.

*Encoding.* The model is a byte-pair model: a text's pieces are what greedy merges
leave. They have the property that a Viterbi search needs: cutting the pieces of a
text at a boundary leaves the pieces of its two parts. So every boundary has one
surviving path, given by its last piece, and a piece extends the path of an
earlier boundary exactly if the two neighbouring pieces, merged on their own, stay
apart. Boundaries are visited in order and hold a backpointer to where their last
piece begins.

The search streams: only boundaries within the longest piece's length can still
be extended. Whenever the backpointers of all of them lead to one boundary, the
ids before it are committed and forgotten, so a text of any length without any
break needs a window of bounded size. Between two characters that stand side by
side in no piece, such as a letter and a space, they always do. Words, and the
parts between such places, repeat, so a worker remembers their ids, up to a bound.

*Decoding* joins the pieces, byte pieces as bytes, and takes off the space that
encoding puts first. U+2581, which stands for the space, comes back as a space;
all other texts come back unchanged.

Defined cases: a null text counts as empty and has no ids; null ids and repeated
rows are coded like others; ids out of range raise an error; null ids to decode
give an empty text; an empty table gives an empty result; further columns are
ignored.
"""

import array
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
CACHE_WORDS = 500_000
CACHE_PAIRS = 1_000_000
RUN = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
COMMIT_EVERY = 64


class Pieces:
    """Pieces, scores and ids of a model file, and the two directions of coding."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        plain = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.scores = {piece: model.get_score(i) for piece, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [b""] * len(model)
        for piece, i in self.ids.items():
            self.bytes[i] = piece.replace(SPACE, " ").encode()
        for value, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([value])
        # Two characters that stand side by side in some piece; between others every path has a boundary.
        self.joined = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.apart, self.words, self.runs = {}, {}, {}

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether merging the characters of ``left + right`` ends in just these two pieces."""
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) > CACHE_PAIRS:
                self.apart.clear()
            known = self.apart[left, right] = self._merge_apart(left, right)
        return known

    def _merge_apart(self, left: str, right: str) -> bool:
        symbols, border, scores = [*left, *right], len(left), self.scores
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):  # of equal scores the leftmost
                    best, at = score, i
            if best is None:
                return len(symbols) == (2 if left else 1) and border == (1 if left else 0)
            if at == border - 1:
                return False
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            if at < border:
                border -= 1

    def search(self, text: str, commit_every=COMMIT_EVERY) -> list:
        """Ids of a normalised text. Backpointers are kept for the uncommitted window only."""
        pieces, longest, apart = self.ids, self.longest, self.apart
        out, base = [], 0  # ``last`` starts at the committed boundary ``base``
        last = [""]  # per boundary its last piece
        end = len(text)
        for at in range(1, end + 1):
            for start in range(max(base, at - longest), at):
                piece = text[start:at]
                if piece in pieces or start == at - 1:
                    # The piece extends the path of its start exactly if the two stay apart.
                    before = last[start - base]
                    known = apart.get((before, piece))
                    if known is None:
                        known = self.stay_apart(before, piece)
                    if known:
                        last.append(piece)
                        break
            if at == end:
                self._commit(at, base, last, out)
            elif not at % commit_every:
                heads = set(range(max(base, at - longest + 1), at + 1))
                while len(heads) > 1:  # the path of the furthest boundary is followed until all meet
                    furthest = max(heads)
                    heads.discard(furthest)
                    heads.add(furthest - len(last[furthest - base]))
                meet = heads.pop()
                if meet > base:
                    self._commit(meet, base, last, out)
                    last = last[meet - base :]
                    base = meet
        return out

    def _commit(self, boundary: int, base: int, last: list, out: list) -> None:
        path = []
        while boundary > base:
            piece = last[boundary - base]
            path.append(piece)
            boundary -= len(piece)
        for piece in reversed(path):
            known = self.ids.get(piece)
            if known is None:
                out.extend(self.byte_ids[b] for b in piece.encode())
            else:
                out.append(known)

    def _run(self, run: str) -> bytes:
        """Ids of a run, cut where every path has a boundary; the short parts repeat and are remembered."""
        out, start, joined, runs = [], 0, self.joined, self.runs
        for at in range(1, len(run) + 1):
            if at == len(run) or run[at - 1 : at + 1] not in joined:
                part = run[start:at]
                start = at
                known = runs.get(part)
                if known is None:
                    known = array.array("i", self.search(part)).tobytes()
                    if len(part) <= self.longest * 2:
                        if len(runs) > CACHE_WORDS:
                            runs.clear()
                        runs[part] = known
                out.append(known)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit numbers in this machine's order."""
        if not text:
            return b""
        words, out = self.words, []
        parts = text.split(" ")
        # Between lone spaces stand whole words; elsewhere a run of spaces goes with the word behind it.
        plain = "" not in parts and SPACE not in text
        for word in parts if plain else RUN.findall(SPACE + text.replace(" ", SPACE)):
            known = words.get(word)
            if known is None:
                if len(words) > CACHE_WORDS:
                    words.clear()
                known = self._run(SPACE + word if plain else word)
                if plain:
                    words[word] = known
            out.append(known)
        return b"".join(out)

    def decode(self, ids) -> str:
        data = b"".join(map(self.bytes.__getitem__, ids))
        return (data[1:] if data.startswith(b" ") else data).decode("utf-8", "replace")


_PIECES = {}


def pieces(model: str) -> Pieces:
    if model not in _PIECES:
        import public_tokenizers

        _PIECES[model] = Pieces(public_tokenizers.path(model))
    return _PIECES[model]


def encode(docs: DataFrame, id_column="doc_id", text_column="text", model=MODEL, carry=None) -> DataFrame:
    """doc_id, ids (array of int), carried (the string column ``carry``, or null) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("carried", pa.string())])

    def run(batches):
        coder = pieces(model)
        for batch in batches:
            rows = [coder.encode(text) for text in batch.column("text").to_pylist()]
            ends = np.cumsum([0] + [len(r) // 4 for r in rows], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, batch.column("carried")], schema=schema)

    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        (F.lit(None) if carry is None else carry).cast("string").alias("carried"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>, carried string")


def decode(coded: DataFrame, id_column="doc_id", ids_column="ids", model=MODEL) -> DataFrame:
    """``coded`` (doc_id, ids, carried) with ids_crc32, of the ids as little-endian 32-bit numbers, and text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("carried", pa.string()), ("ids_crc32", pa.int64()), ("text", pa.string())])

    def run(batches):
        coder = pieces(model)
        for batch in batches:
            ids, texts, sums = batch.column("ids"), [], []
            values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            for row in range(len(ids)):
                own = values[ends[row] : ends[row + 1]] if ids[row].is_valid else values[:0]
                texts.append(coder.decode(own.tolist()))
                sums.append(zlib.crc32(own.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, batch.column("carried"), pa.array(sums, pa.int64()), pa.array(texts, pa.string())], schema=schema)

    carried = F.col("carried") if "carried" in coded.columns else F.lit(None)
    rows = coded.select(F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).cast("array<int>").alias("ids"),
                        carried.cast("string").alias("carried"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, carried string, ids_crc32 long, text string")
