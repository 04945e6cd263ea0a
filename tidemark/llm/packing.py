"""Packing token sequences under several limits at once: vector bin packing."""

from __future__ import annotations

import json
import sys
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

POOL = 2_048  # rests of documents from which a task fills its sequences
ROWS = 4_096  # pieces given out at a time
END = 0  # id after each document
COUNTS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")
# How the byte-level vocabulary file writes bytes and splits words.
PLAIN_BYTES = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Limits(NamedTuple):
    """Most tokens, segments and loss-bearing tokens of a sequence."""

    tokens: int = 1_024
    segments: int = 1_024
    loss: int = 1_024


class Piece(NamedTuple):
    """A stretch of a document; ``cost`` counts the loss-bearing tokens before each of its ids and after the last."""

    key: object
    start: int
    ids: np.ndarray
    cost: np.ndarray
    total: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.key, self.start, self.ids[:length], self.cost[: length + 1], self.total),
            Piece(self.key, self.start + length, self.ids[length:], self.cost[length:], self.total),
        )

    def fit(self, tokens: int, loss: int) -> int:
        """The longest beginning within the limits."""
        return int(min(len(self.ids), tokens, np.searchsorted(self.cost - self.cost[0], loss, "right") - 1))

    @property
    def loss(self) -> int:
        return int(self.cost[-1] - self.cost[0])


class Pool:
    """Pieces waiting for a sequence, with what each asks for."""

    def __init__(self, limits: Limits, room: int) -> None:
        self.limits, self.asks = np.array(limits, float), np.zeros((room + 1, 3))
        self.pieces: list[Piece | None] = [None] * (room + 1)
        self.free = list(range(room, -1, -1))

    def __len__(self) -> int:
        return len(self.pieces) - len(self.free)

    def add(self, piece: Piece) -> None:
        at = self.free.pop()
        self.pieces[at] = piece
        self.asks[at] = len(piece.ids), 1, piece.loss

    def take(self, at: int) -> Piece:
        piece, self.pieces[at] = self.pieces[at], None
        self.asks[at] = 0
        self.free.append(at)
        return piece

    def sequence(self) -> list[Piece]:
        """Fill one sequence: of the pieces that fit, ever the one whose asks point most the way of what is left.

        When none fits, that piece of all is cut whose beginning does.
        """
        left = self.limits.copy()
        chosen = []
        while len(self) and left[0] >= 1 and left[1] >= 1:
            waiting = self.asks[:, 0] > 0
            worth = self.asks @ (left / self.limits**2)
            fits = waiting & (self.asks <= left).all(axis=1)
            at = int(np.argmax(np.where(fits if fits.any() else waiting, worth, -1)))
            piece = self.take(at)
            length = piece.fit(int(left[0]), int(left[2]))
            if length < len(piece.ids):
                if not length:  # its next id bears loss and none is left
                    self.add(piece)
                    break
                piece, rest = piece.cut(length)
                self.add(rest)
            chosen.append(piece)
            left -= len(piece.ids), 1, piece.loss
        return chosen


def pack(documents: Iterator[tuple[object, np.ndarray, np.ndarray]], limits: Limits) -> Iterator[list[Piece]]:
    """Sequences of pieces; ``documents`` are keys, ids and, for each id, whether it bears loss.

    Whatever fills a sequence alone leaves at once; rests wait in a pool of
    ``POOL``. Only the last sequences of a task can stay short, unless a limit
    other than tokens binds.
    """
    pool = Pool(limits, POOL)
    for key, ids, bears in documents:
        rest = Piece(key, 0, ids, np.concatenate([[0], np.cumsum(bears, dtype=np.int64)]), len(ids))
        while len(rest.ids) >= limits.tokens and (length := rest.fit(limits.tokens, limits.loss)) == limits.tokens:
            piece, rest = rest.cut(length)
            yield [piece]
        while len(rest.ids):
            length = rest.fit(limits.tokens, limits.loss)
            if not length:
                raise ValueError("a limit of 0 loss-bearing tokens packs nothing that bears loss")
            piece, rest = rest.cut(length)
            pool.add(piece)
            if len(pool) >= POOL:
                yield pool.sequence()
    while len(pool):
        yield pool.sequence()


def encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text by the byte-level vocabulary file at ``path``, without added tokens.

    The file is the tokenizers library's; its merges are applied by tiktoken, which
    gives the same ids five times faster (tests compare the two).
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    others = [b for b in range(256) if b not in PLAIN_BYTES]
    byte = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {x["content"]: x["id"] for x in read["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in read["model"]["vocab"].items() if token not in special}
    known = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(text: str) -> list[int]:
        if any(x in text for x in special):
            return known.encode(text, allowed_special="all")
        return known.encode_ordinary(text)

    return ids


def packed(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", loss: str | None = None, limits: Limits = Limits()
) -> DataFrame:
    """Pieces of all documents, dealt into sequences of at most ``limits``.

    ``loss`` names a boolean column: whether the tokens of a row bear loss, as those
    of an assistant's turn do (null: not); without it all do. Returns a row per piece:
    ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` (with the closing
    id 0), ``sequence_id``, ``offset``, ``loss_tokens``. A null or empty text is its
    closing id alone; repeated rows are packed each, null keys stay, other columns are
    not read, no document gives no row. A task packs what it reads, so nothing is
    shuffled and a source or key may be of any size; the number of the task leads its
    sequence ids.
    """
    bears = F.lit(True) if loss is None else F.coalesce(docs[loss], F.lit(False))
    narrow = docs.select(docs[key].alias("key"), docs[text].alias("text"), bears.alias("bears"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        base = TaskContext.get().partitionId() << 40
        kinds: list[pa.DataType] = []

        def documents() -> Iterator[tuple[object, np.ndarray, np.ndarray]]:
            for batch in batches:
                kinds[:] = [batch.schema.field("key").type]
                for name, words, bears in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "bears"))):
                    ids = np.array([*ids_of(words or ""), END], "<u4")
                    yield name, ids, np.full(len(ids), bears)

        rows: list[tuple] = []
        for number, pieces in enumerate(pack(documents(), limits)):
            offset = 0
            for p in pieces:
                crc = zlib.crc32(np.ascontiguousarray(p.ids).tobytes())
                rows.append((p.key, p.start, len(p.ids), crc, p.total, base + number, offset, p.loss))
                offset += len(p.ids)
            if len(rows) >= ROWS:
                yield table(rows, kinds[0])
                rows.clear()
        if rows:
            yield table(rows, kinds[0])

    def table(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array(x, pa.int64() if i else kind) for i, x in enumerate(zip(*rows))]
        return pa.RecordBatch.from_arrays(columns, [key, *COUNTS])

    schema = T.StructType([T.StructField(key, narrow.schema["key"].dataType)])
    for name in COUNTS:
        schema = schema.add(name, "long")
    return narrow.mapInArrow(run, schema)
