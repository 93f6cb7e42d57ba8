"""Byte-level BPE through a sentencepiece model made from the vocabulary."""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import blocks, bytes_of, fresh, plus, text_of

#: Pre-tokens that a worker remembers, and the longest of them.
REMEMBERED, REMEMBERED_LETTERS = 50_000, 64
#: Rows of an output batch.
ROWS = 500


@cache
def byte_letters() -> tuple[str, ...]:
    """A visible letter for each byte: itself where Latin-1 shows one, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return tuple(chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256))


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a rank file; every single byte must have one."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a rank: {missing}")
    return ranks


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    """A field of a protobuf message: bytes by length, or a number."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model: a piece per token in order of rank, scored by the negative rank.

    Bytes are spelt by byte_letters. The normaliser is the identity and neither adds nor
    removes white space. Piece 0 stands for unknown letters, of which there are none.
    """
    letters = byte_letters()
    unknown, normal, bpe = 2, 1, 2

    def piece(text: str, score: float, kind: int) -> bytes:
        body = _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score)
        return _field(1, body + _field(3, kind))

    pieces = [piece("<unk>", 0.0, unknown)]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        pieces.append(piece("".join(letters[b] for b in token), float(-rank), normal))
    trainer = _field(2, _field(3, bpe))
    normaliser = _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return b"".join(pieces) + trainer + normaliser


class Codec:
    """Encodes and decodes by a rank file. Special tokens are not known; their strings are text."""

    def __init__(self, ranks: bytes, pattern: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        self.ranks = read_ranks(ranks)
        self.rank_of_piece = [-1, *sorted(self.ranks.values())]
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.pattern = regex.compile(pattern)
        self.letters = str.maketrans({chr(b): letter for b, letter in enumerate(byte_letters())})
        spelt = byte_letters()
        self.bytes = {letter: b for b, letter in enumerate(spelt)}
        self.spelling = {
            self.rank_of_piece[i]: bytes(self.bytes[x] for x in self.sp.id_to_piece(i))
            for i in range(1, self.sp.get_piece_size())
        }
        self.known: dict[str, bytes] = {}

    def _learn(self, pre_tokens: set[str]) -> dict[str, bytes]:
        """Ids (32 bits each) of pre-tokens: a token as it stands, the others by the model's merges."""
        found, spelt = {}, []
        for token in pre_tokens:
            data = token.encode()
            if (rank := self.ranks.get(data)) is not None:
                found[token] = array("i", [rank]).tobytes()
            else:
                spelt.append((token, data.decode("latin-1").translate(self.letters)))
        if spelt:
            pieces = self.sp.encode([x for _, x in spelt], num_threads=1)
            for (token, _), ids in zip(spelt, pieces, strict=True):
                found[token] = array("i", [self.rank_of_piece[i] for i in ids]).tobytes()
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; each match of the pattern is encoded by itself."""
        parts = []
        for block in blocks(text):
            tokens = self.pattern.findall(block)
            if len(self.known) > self.remembered:
                self.known.clear()
            new = {t for t in set(tokens) if t not in self.known}
            self.known |= self._learn(new)
            parts.append(b"".join(map(self.known.__getitem__, tokens)))
            for token in new:
                if len(token) > REMEMBERED_LETTERS:
                    del self.known[token]
        return np.frombuffer(b"".join(parts), np.int32)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as encode gives them; each distinct match is looked up once for all texts."""
        found = [[t for block in blocks(text) for t in self.pattern.findall(block)] for text in texts]
        coded = pa.array(chain.from_iterable(found), pa.string()).dictionary_encode()
        tokens = coded.dictionary.to_pylist()
        if len(self.known) > self.remembered:
            self.known.clear()
        new = {t for t in tokens if t not in self.known}
        self.known |= self._learn(new)
        offsets, data = bytes_of(pa.array(map(self.known.__getitem__, tokens), pa.binary()).take(coded.indices))
        for token in new:
            if len(token) > REMEMBERED_LETTERS:
                del self.known[token]
        ends = offsets[np.cumsum([0, *map(len, found)])].tolist()
        return [data[a:b].view(np.int32) for a, b in zip(ends, ends[1:])]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids, each piece's letters turned back."""
        return b"".join(map(self.spelling.__getitem__, ids))


@cache
def codec(ranks: bytes, pattern: str, remembered: int = REMEMBERED) -> Codec:
    """One codec for each worker process and vocabulary."""
    return Codec(ranks, pattern, remembered)


def encode(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    text_col: str = "text",
    keep: list[str] | None = None,
) -> tuple[DataFrame, str]:
    """The columns of docs (or those to keep) with the ids of the whole text, and that column's name.

    The name is ids, or another if docs has it. Null counts as empty and has no ids. The vocabulary is
    broadcast (token_counts.read_model bounds it). Every row is encoded by itself, so repeats and
    order do not matter.
    """
    keep = docs.columns if keep is None else keep
    name = fresh(docs.columns, "ids")
    rows = docs.select(*[f"`{c}`" for c in keep])
    schema, carried = plus(rows, **{name: "array<int>"}), len(keep)
    place = keep.index(text_col) if text_col in keep else carried
    if place == carried:
        rows = docs.select(*[f"`{c}`" for c in keep], text_of(text_col).alias(name))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(shared.value, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                ids = [bpe.encode(t.as_py() or "") for t in batch.column(place)]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate(ids))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:carried], lists], names=[*keep, name]
                )

    return rows.mapInArrow(run, schema), name


def decode(encoded: DataFrame, ranks: bytes, pattern: str, ids_col: str = "ids") -> tuple[DataFrame, str]:
    """The columns with the bytes that the ids stand for, and that column's name (decoded, if free).

    Null ids count as none. An id that is not in the vocabulary is an error.
    """
    name = fresh(encoded.columns, "decoded")
    columns = encoded.columns
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(shared.value, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                column = batch.column(columns.index(ids_col))
                ends = column.offsets.to_numpy()
                values = column.values.to_numpy()
                data = [bpe.decode(values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(data, pa.binary())], names=[*columns, name]
                )

    return encoded.mapInArrow(run, plus(encoded, **{name: "binary"})), name


def confirmed(
    encoded: DataFrame, ranks: bytes, pattern: str, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """The rows as they came; an error if the ids of one do not give its text back."""
    decoded, data = decode(encoded, ranks, pattern, ids_col)
    same = F.col(data) == text_of(text_col).cast("binary")
    failed = F.raise_error(F.lit("ids that do not decode to their text")).cast("boolean")
    return decoded.where(F.when(same, F.lit(True)).otherwise(failed)).drop(data)


def digests(encoded: DataFrame, ids_col: str, decoded_col: str) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 in place of ids and bytes."""
    rest = [f"`{c}`" for c in encoded.columns if c not in (ids_col, decoded_col)]
    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    return encoded.select(
        *rest,
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded_col), 256).alias("decoded_sha256"),
    )
