"""SentencePiece encoding and decoding with a table of distinct chunks.

The library marks each space (and puts a mark before the text) and merges pieces. Where no piece of the
model holds a mark behind another character, nothing can cross the place before a run of marks, so
the chunks between such places (a run of marks and the word behind it) are segmented independently. A
worker segments each distinct chunk once and puts its ids back at every position where it stands.
Decoding joins the bytes that the ids stand for, from a table of the model's pieces.

Whether chunks are independent is read from the model (`Model.splits`): pieces, normaliser and the side
of the mark. With any other model a whole text is one chunk.

There is no shuffle: a table of all chunks of all texts would send every position through one. What a
worker remembers is bounded by its bytes, which costs time and never results.

Edge cases: null text is empty (the end id alone, decoded to the empty text); a mark (U+2581) inside a
text is a space to the library, and so it is here; special strings inside a text are plain text; ties and
repeated rows don't matter (each row stands alone); very long texts are read whole, one without spaces is
one chunk; an empty table gives an empty table; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import ship

MARK = "▁"
#: Bytes of chunks that a worker remembers, with what one costs besides its own bytes; characters taken at a time.
REMEMBERED, _EACH, _STEP = 1 << 27, 300, 1 << 19
_CHUNK = re.compile(" +[^ ]*")
_loaded: dict[str, "Model"] = {}


class Model:
    """A model file: the library, the bytes of each piece, and the chunks met so far."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.library.serialized_model_proto())
        rules = spec.normalizer_spec
        kinds = spec.SentencePiece
        self.mark = next((i for i, p in enumerate(spec.pieces) if p.piece == MARK), None)
        self.end = self.library.eos_id()
        self.labels = [bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else b"" if p.type == kinds.CONTROL else p.piece.replace(MARK, " ").encode() for p in spec.pieces]
        plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces and rules.add_dummy_prefix
        whole = not any(MARK in p.piece.lstrip(MARK) for p in spec.pieces) and not any(p.type == kinds.USER_DEFINED for p in spec.pieces)
        self.splits = plain and whole and not spec.trainer_spec.treat_whitespace_as_suffix and self.mark is not None
        self.ids: dict[str, bytes] = {}
        self.bytes: dict[str, bytes] = {}
        self.room = REMEMBERED

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text in order, each without its first mark, which the library puts before it."""
        if not text or not self.splits:
            return [text] if text else []
        if MARK in text:
            text = text.replace(MARK, " ")
        parts = text.split(" ")
        return [c[1:] for c in _CHUNK.findall(" " + text)] if "" in parts else parts

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """The ids of each chunk; a mark alone, which the library takes for an empty text, is its own piece."""
        return [i if c else [self.mark] for c, i in zip(chunks, self.library.encode(chunks, num_threads=1), strict=True)]

    def learn(self, chunks: set[str]) -> None:
        """Enter the chunks that the table doesn't hold yet."""
        if self.room < 0:
            self.ids.clear()
            self.bytes.clear()
            self.room = REMEMBERED
        new = [c for c in chunks if c not in self.ids]
        for c, ids in zip(new, self.segment(new), strict=True):
            self.ids[c] = " ".join(map(str, ids)).encode()
            self.bytes[c] = b"".join(map(self.labels.__getitem__, ids))
            self.room -= _EACH + 2 * len(c) + len(self.ids[c])

    def encode(self, text: str) -> list[int]:
        """The ids of a text, without the end id."""
        chunks = self.chunks(text)
        self.learn(set(chunks))
        return [int(i) for c in chunks for i in self.ids[c].split()]

    def decode(self, ids: list[int]) -> str:
        return self.text(b"".join(map(self.labels.__getitem__, ids))).decode("utf-8", "replace")

    def text(self, joined: bytes) -> bytes:
        """The bytes of a text from those of its pieces: without the mark that was put before it."""
        return joined[1:] if joined[:1] == b" " else joined

    def both(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Of each text the ids in decimal, joined by spaces, with the end id, and the decoded bytes."""
        every = [self.chunks(t) for t in texts]
        self.learn(set().union(*every))
        ids, labels, end = self.ids.__getitem__, self.bytes.__getitem__, str(self.end).encode()
        for chunks in every:
            yield b" ".join([*map(ids, chunks), end]), self.text(b"".join(map(labels, chunks)))


def model(path: str) -> Model:
    return _loaded.get(path) or _loaded.setdefault(path, Model(path))


def runs(texts: pa.Array, step: int = _STEP) -> Iterator[list[str]]:
    """Texts in runs of about `step` characters."""
    run: list[str] = []
    room = step
    for v in texts:
        run.append(v.as_py() or "")
        room -= len(run[-1])
        if room <= 0:
            yield run
            run, room = [], step
    if run:
        yield run


def digest_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    known = model(path)
    for batch in batches:
        counts, ids, texts = [], [], []
        for run in runs(batch.column(1)):
            for codes, decoded in known.both(run):
                counts.append(codes.count(b" ") + 1)
                ids.append(hashlib.sha256(codes).hexdigest())
                texts.append(hashlib.sha256(decoded).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def id_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    known = model(path)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[*known.encode(v.as_py() or ""), known.end] for v in batch.column(1)], pa.list_(pa.int32()))], ["doc_id", "ids"])


def text_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    known = model(path)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([known.decode(v.as_py() or []) for v in batch.column(1)], pa.string())], ["doc_id", "text"])


def piece_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids of each whole text, with the end id."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(lambda b: id_batches(b, path), "doc_id long, ids array<int>")


def piece_decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that the ids stand for."""
    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: text_batches(b, path), "doc_id long, text string")


def piece_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each whole text in one pass and return the digests of both."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(lambda b: digest_batches(b, path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
