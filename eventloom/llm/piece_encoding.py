"""Encoding into pieces and back, by a Viterbi search that words with one beginning share.

A space is marked and joined to the word after it, so a text is a sequence of marked words.
The best segmentation of a word is the one with the largest sum of piece scores; pieces do
not cross word marks, so words are segmented one by one. The distinct words of a batch are
sorted, which makes neighbours share their beginnings as in a trie walked depth first: the
forward scores of the common prefix are kept, and only what follows is computed. Words stay
in a bounded cache, so a frequent word is segmented once per task.

Pieces come from a public model file, whose path is a parameter. Its scores are merge ranks;
the search takes minus the logarithm of the rank, the shape of word frequencies, so that
fewer and more common pieces win. A character without a piece becomes its UTF-8 bytes, so
every text decodes to itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_UNIT = re.compile(r"[ \n][^ \n]*|[^ \n]+")


class Pieces:
    """Vocabulary with scores: pieces by id, and single bytes for all else."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            model = sentencepiece.SentencePieceProcessor(model_proto=file.read())
        size = model.vocab_size()
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.text: list[bytes] = [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                # Words keep their space here, so a mark that a text holds has no piece.
                piece = piece.replace(MARK, " ")
                self.id[piece] = i
                self.score[piece] = -log(2 - model.get_score(i))
                self.text[i] = piece.encode()
        self.longest = max(map(len, self.id), default=1)
        # A byte costs more than any piece, so bytes only stand where nothing else does.
        self.byte_score = 2 * min(self.score.values(), default=-1.0)

    def segment(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word, as little-endian 32-bit numbers. ``words`` sorted and distinct.

        Ties go to the shorter last piece.
        """
        score, longest = self.score, self.longest
        best, back, before, out = [0.0], [0], "", {}
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                # A character alone is a piece or its bytes; longer ones replace it if better.
                char = word[end - 1]
                top = best[end - 1] + score.get(char, 0.0)
                if char not in score:
                    top = best[end - 1] + self.byte_score * len(char.encode())
                at = end - 1
                for begin in range(end - 2, max(-1, end - longest - 1), -1):
                    value = score.get(word[begin:end])
                    if value is not None and best[begin] + value > top:
                        top, at = best[begin] + value, begin
                best.append(top)
                back.append(at)
            out[word] = self._ids(word, back)
            before = word
        return out

    def _ids(self, word: str, back: list[int]) -> bytes:
        ids, end = [], len(word)
        while end:
            begin = back[end]
            known = self.id.get(word[begin:end])
            if known is None:
                ids += [self.byte[b] for b in reversed(word[begin:end].encode())]
            else:
                ids.append(known)
            end = begin
        return np.array(ids[::-1], "<u4").tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the mark that ``marked`` put in front goes."""
        data = b"".join([self.text[i] for i in ids.tolist()])
        return data.decode("utf-8", errors="replace")[1:]


def marked(text: str) -> list[str]:
    """Words with their spaces, one of which is put in front; line ends begin words too."""
    return _UNIT.findall(" " + text)


class Encoder:
    """Encodes texts with a cache of words that is emptied when it is full."""

    def __init__(self, path: str, cache: int = 400_000):
        self.pieces, self.cache, self.known = Pieces(path), cache, {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        units = [marked(t) for t in texts]
        words = {w for u in units for w in u}
        if len(self.known) > self.cache:
            self.known = {}
        new = sorted(w for w in words if w not in self.known)
        self.known |= self.pieces.segment(new)
        return [
            np.frombuffer(b"".join([self.known[w] for w in u]), "<u4") for u in units
        ]


def _encoded(path: str, batch_bytes: int, with_ids: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows, begin, size = [], 0, 0
            for end, text in enumerate(texts, 1):
                size += len(text)
                if size >= batch_bytes or end == len(texts):
                    rows += encoder(texts[begin:end])
                    begin, size = end, 0
            columns = [
                batch.column("doc_id"),
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([zlib.crc32(r.tobytes()) for r in rows], pa.int64()),
                pa.array(
                    [encoder.pieces.decode(r) == t for r, t in zip(rows, texts, strict=True)],
                    pa.bool_(),
                ),
            ]
            names = ["doc_id", "n_pieces", "ids_crc32", "round_trip"]
            if with_ids:
                columns.append(pa.array([r.tolist() for r in rows], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return encode


def encode_documents(
    docs: DataFrame,
    model: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    batch_bytes: int = 4 << 20,
) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, round_trip and, if asked for, ids of every row.

    ``round_trip`` says whether decoding gives the text back. NULL texts count as empty;
    an empty text is the front mark alone. Rows are encoded each for itself, without a
    shuffle; an empty table gives no rows; other columns are not looked at.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_pieces long, ids_crc32 long, round_trip boolean"
    return rows.mapInArrow(
        _encoded(model, batch_bytes, with_ids), schema + (", ids array<int>" if with_ids else "")
    )


def decode_documents(
    encoded: DataFrame, model: str, id_column: str = "doc_id", ids_column: str = "ids"
) -> DataFrame:
    """doc_id and text from arrays of ids; NULL arrays give NULL."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            texts = [
                None if ids is None else pieces.decode(np.array(ids, np.int64))
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    rows = encoded.select(F.col(id_column).alias("doc_id"), F.col(ids_column).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(decode, f"doc_id {kind}, text string")
