"""Packing documents into windows of tokens: length combinations by least squares, the rest end to end."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from waybill.llm.byte_bpe import byte_letters
from waybill.llm.common import blocks, bytes_of, keyed, plus, small, text_of
from waybill.sources.scratch import Scratch

WINDOW = 4096
#: The id behind each document.
END = 2
#: Steps of the descent; parts of a combination that the greedy pass makes.
STEPS, PARTS = 100, 16
#: Pre-tokens that a worker remembers in each of two generations, and the longest of them.
REMEMBERED, REMEMBERED_LETTERS = 300_000, 64
#: Characters whose words are put together, each distinct one being encoded once.
CHARS = 8 << 20
#: Bytes of ids in an output batch.
BATCH = 4 << 20

#: Words of several kinds whose ids show whether a tokenizer looks across a space.
_PROBE = "ab c 12 3. 's x, <|y|> é ´e ́a A"


#: Letters, digits and signs of words that may be parted without the library: up to Cyrillic, more Latin, punctuation.
_COMMON = [chr(c) for c in (*range(0x21, 0x530), *range(0x1E00, 0x20D0)) if not chr(c).isspace()]


def _pattern(parts: dict | None) -> Callable[[str], list[str]] | None:
    """The matches that a tokenizer keeps, and spaces, if it keeps those of one pattern and spells them as bytes."""
    match parts:
        case {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False},
        ]}:
            own = regex.compile(f"(?:{pattern})| ")
            return None if own.groups else own.findall
    return None


def _folds(normal: dict | None) -> bool | None:
    """Whether a normaliser lower-cases a word of visible ASCII signs; None if it may do more to it."""
    steps = [] if normal is None else normal.get("normalizers", [normal])
    for step in steps:
        blank = step["type"] == "Replace" and step["pattern"] == {"Regex": "\\s+"}
        if step["type"] not in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") and not blank:
            return None
    return any(step["type"] == "Lowercase" for step in steps)


def _spaced(words: pa.StringArray) -> str:
    """The words with a space between each two."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py()


class Encoder:
    """Ids by a tokenizer file, without added tokens around the text.

    Where the tokenizer drops the white space between words and looks at no two words at once, which a
    probe tells, the distinct words of many texts are encoded once. Where the file tells its pattern, so are the distinct
    pre-tokens of these words, which the model encodes and a worker remembers. That holds for words of signs that a probe
    shows to be parted alike by the pattern; ASCII words are also normalised here if that only lower-cases them.
    """

    def __init__(self, model: bytes) -> None:
        self.library = Tokenizer.from_buffer(model)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # Two generations: what the older one has and is met again moves to the younger one.
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        whole = {self._whole(_PROBE.replace(" ", gap)) for gap in (" ", "  ", "\n")}
        self.apart = whole == {b"".join(map(self._whole, _PROBE.split(" ")))}
        self.letters = str.maketrans({chr(b): letter for b, letter in enumerate(byte_letters())})
        spec = json.loads(model)
        self.pattern, self.folds = _pattern(spec.get("pre_tokenizer")), _folds(spec.get("normalizer"))
        if self.pattern and any(" " in p and p != " " for p in self.pattern(_PROBE)):
            self.pattern = None
        alike = {c for c in _COMMON if self._alike(c)} if self.apart and self.pattern else set()
        self.common = re.compile(f"[{''.join(map(re.escape, sorted(alike)))}]+").fullmatch if alike else None
        if any(chr(c) not in alike for c in range(0x21, 0x7F)):
            self.folds = None

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32).tobytes()

    def _spelt(self, part: str) -> str:
        """A letter for each byte of a pre-token."""
        return part.encode().decode("latin-1").translate(self.letters)

    def _alike(self, sign: str) -> bool:
        words = (f"a{sign}a", f"1{sign}1", f".{sign}.", sign + sign, f"'{sign}")
        part = self.library.pre_tokenizer.pre_tokenize_str
        return all(list(map(self._spelt, self.pattern(w))) == [p for p, _ in part(w)] for w in words)

    def _of_pre_tokens(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens; a space has none."""
        if len(self.known) > REMEMBERED:
            self.known, self.known_before = {}, self.known
        known, before, tokenize = self.known, self.known_before, self.library.model.tokenize
        out = list(map(known.get, parts))
        for k, ids in enumerate(out):
            if ids is None:
                part = parts[k]
                if (ids := before.get(part)) is None:
                    own = [] if part == " " else tokenize(self._spelt(part))
                    ids = array("i", [t.id for t in own]).tobytes()
                if len(part) <= REMEMBERED_LETTERS:
                    known[part] = ids
                out[k] = ids
        return out

    def _of_normal(self, text: str, n: int) -> pa.BinaryArray:
        """Ids of n normalised words by the pattern."""
        parts = pa.array(self.pattern(text), pa.string()).dictionary_encode()
        distinct = parts.dictionary.to_pylist()
        ids = pa.array(self._of_pre_tokens(distinct), pa.binary()).take(parts.indices)
        blank = distinct.index(" ") if n > 1 else -1
        gaps = np.flatnonzero(parts.indices.to_numpy() == blank)
        ends = np.concatenate([[0], gaps, [len(parts)]])
        if len(ends) != n + 1:
            raise ValueError("the pattern takes words together")
        offsets, data = bytes_of(ids)
        return pa.Array.from_buffers(
            pa.binary(), n, [None, pa.py_buffer(offsets[ends].astype(np.int32)), pa.py_buffer(data)]
        )

    def _of_words(self, words: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray]:
        """Ids of distinct words, which hold no space, and where each word's are."""
        visible = np.array(pc.match_substring_regex(words, "^[!-~]+$"))
        special = np.zeros(len(words), bool)
        for a in self.added:
            special |= np.array(pc.match_substring(words, a))
        plain = visible & ~special if self.folds is not None else np.zeros(len(words), bool)
        places, found = [np.flatnonzero(plain)], [pa.array([], pa.binary())]
        if n := len(places[0]):
            text = _spaced(words.take(pa.array(places[0])))
            found.append(self._of_normal(text.lower() if self.folds else text, n))
        rest = np.flatnonzero(~plain)
        some = np.flatnonzero(~plain & ~special) if self.common else rest[:0]
        if len(some):
            text = _spaced(words.take(pa.array(some)))
            if text.split() != (apart := text.split(" ")):
                some = some[[w.split() == [w] for w in apart]]
                text = _spaced(words.take(pa.array(some)))
            if self.library.normalizer is not None:
                text = self.library.normalizer.normalize_str(text)
            normal = text.split(" ") if len(some) else []
            if len(normal) == len(some) and not all(map(self.common, normal)):
                good = [self.common(w) is not None for w in normal]
                some, normal = some[good], [w for w, yes in zip(normal, good) if yes]
                text = " ".join(normal)
            if len(normal) == len(some) > 0:
                places.append(some)
                found.append(self._of_normal(text, len(some)))
                rest = np.setdiff1d(rest, some)
        places.append(rest)
        found.append(pa.array(map(self._whole, words.take(pa.array(rest)).to_pylist()), pa.binary()))
        where = np.empty(len(words), np.int64)
        where[np.concatenate(places)] = np.arange(len(words))
        return pa.concat_arrays(found), where

    def _blocks(self, texts: list[str]) -> list[bytes]:
        words = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        coded = words.values.dictionary_encode()
        ids, where = self._of_words(coded.dictionary)
        offsets, data = bytes_of(ids.take(pa.array(where[coded.indices.to_numpy()])))
        ends = offsets[words.offsets.to_numpy()].tolist()
        return [data[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text, four bytes each, low byte first."""
        if not self.apart:
            yield from map(self._whole, texts)
            return
        waiting: list[str] = []
        pieces: list[int] = []  # how many of the waiting blocks are of each text
        start: list[bytes] = []  # of the first waiting text: what is encoded
        held = 0

        def flush() -> Iterator[bytes]:
            nonlocal waiting, pieces, start, held
            found, at = self._blocks(waiting), 0
            for n in pieces[:-1]:
                yield b"".join([*start, *found[at : at + n]])
                start, at = [], at + n
            start = [*start, *found[at:]]
            waiting, pieces, held = [], [0], 0

        for text in texts:
            pieces.append(0)
            for block in blocks(text):
                waiting.append(block)
                pieces[-1] += 1
                held += len(block)
                if held >= CHARS:
                    yield from flush()
        if pieces:
            yield from flush()
            yield b"".join(start)

    def encode(self, text: str) -> bytes:
        """Ids of a text, four bytes each, low byte first."""
        return next(self.encode_all([text]))


@cache
def encoder(model: bytes) -> Encoder:
    """One encoder for each worker process and tokenizer."""
    return Encoder(model)


def encoded(
    docs: DataFrame, model: bytes, space: Scratch, id_col: str, text_col: str, window: int, end: int
) -> tuple[DataFrame, DataFrame, str]:
    """(one row per document, documents with a key, its name).

    The rows have id, row, ids (with the end), n; rest, what is left of n after whole windows; part, the task
    that wrote the row; wholes and alike, how many whole windows and how many rests of the same
    length that task had before. They are stored, so these numbers hold whatever happens to executors.
    """
    docs, key = keyed(docs, id_col, space)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(key).alias("row"), text_of(text_col).alias("text")
    )
    schema = plus(
        rows.drop("text"), ids="binary", n="long", rest="int", part="int", wholes="long", alike="long"
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    last = np.array([end], "<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = TaskContext.get().partitionId(), encoder(shared.value)
        wholes, alike = 0, np.zeros(window, np.int64)

        def packed(places: list[int], ids: list[bytes], of: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal wholes
            n = np.array([len(x) // 4 for x in ids], np.int64)
            rest, before, same = n % window, [], []
            for whole, r in zip((n // window).tolist(), rest.tolist()):
                before.append(wholes)
                same.append(alike[r])
                wholes += whole
                alike[r] += 1
            kept = of.slice(places[0], len(places))
            more = [ids, n, rest, [part] * len(n), before, same]
            kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            columns = [pa.array(x, k) for x, k in zip(more, kinds)]
            return pa.RecordBatch.from_arrays([*kept.columns[:2], *columns], names=schema.names)

        for batch in batches:
            places, ids, held = [], [], 0
            for i, own_ids in enumerate(own.encode_all(text.as_py() for text in batch.column(2))):
                ids.append(own_ids + last)
                places.append(i)
                held += len(ids[-1])
                if held > BATCH:
                    yield packed(places, ids, batch)
                    places, ids, held = [], [], 0
            if places:
                yield packed(places, ids, batch)

    return space.write(rows.mapInArrow(run, schema), "ids"), docs, key


def combinations(counts: np.ndarray, window: int) -> np.ndarray:
    """Rows of up to three lengths that occur and fill a window, falling; zero where there is none."""
    present = counts > 0
    lengths = np.flatnonzero(present)
    found = []
    for a in lengths[::-1].tolist():
        if a == window:
            found.append(np.array([[a, 0, 0]]))
            continue
        b = lengths[(lengths <= a) & (lengths <= window - a)]
        c = window - a - b
        good = (c <= b) & ((c == 0) | present[c])
        found.append(np.stack([np.full(good.sum(), a), b[good], c[good]], 1))
    return np.concatenate([np.zeros((0, 3), np.int64), *found]).astype(np.int32)


def repeats(columns: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 for which the combinations come close to the counts: min |A x - h|^2.

    Each step minimises exactly over a set of combinations that share no length: of those that gain most, the ones that
    gain more than every other with one of their lengths. It ends when no single change gains half a repeat.
    """
    x, rest = np.zeros(len(columns)), counts.astype(float)
    rest[0] = 0.0
    used = (columns > 0).astype(float)
    same = (columns[:, 0] == columns[:, 1]).astype(float), (columns[:, 1] == columns[:, 2]) & (columns[:, 2] > 0)
    square = used.sum(1) + 2 * same[0] + 2 * same[1] + 2 * (same[0] * same[1])
    for _ in range(steps if len(columns) else 0):
        slope = rest[columns].sum(1)
        step = np.maximum(-x, slope / square)
        gain = step * (2 * slope - step * square)
        most = min(len(gain), 4 * len(counts))
        order = np.argpartition(-gain, most - 1)[:most]
        order = order[gain[order] > 0.5]
        order = order[np.lexsort((order, -gain[order]))]
        if not len(order):
            break
        place = np.full(len(counts), len(order))
        np.minimum.at(place, columns[order].ravel(), np.repeat(np.arange(len(order)), 3))
        place[0] = len(order)
        firsts = np.where(columns[order] > 0, place[columns[order]], np.arange(len(order))[:, None])
        chosen = order[(firsts == np.arange(len(order))[:, None]).all(1)]
        x[chosen] += step[chosen]
        np.subtract.at(rest, columns[chosen].ravel(), np.repeat(step[chosen], 3))
        rest[0] = 0.0
    return x


@dataclass(frozen=True)
class Plan:
    """Where the k-th piece of each length goes. Its size depends on the window alone."""

    window: int
    starts: dict[int, np.ndarray]  # by length: first rank of each slot
    slots: dict[int, np.ndarray]  # by length: sequence of that rank and offset of the slot
    used: np.ndarray  # by length: ranks in slots
    behind: np.ndarray  # by length: where the others begin in the tail
    tail: int  # the tail's first sequence
    borders: np.ndarray  # ends of the sequences that share the tail's last window

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, length) of the parts of a piece; one unless a border of the tail cuts it."""
        if rank < self.used[length]:
            k = int(np.searchsorted(self.starts[length], rank, "right")) - 1
            sequence, offset = self.slots[length][k]
            return [(int(sequence + rank - self.starts[length][k]), int(offset), length)]
        at = int(self.behind[length] + (rank - self.used[length]) * length)
        first, end, out = int(self.borders[0]), at + length, []
        while at < end:
            if at < first:
                number, begin = divmod(at, self.window)
                begin, stop = at - begin, min(at - begin + self.window, end)
            else:
                k = int(np.searchsorted(self.borders, at, "right")) - 1
                number, begin = first // self.window + k, int(self.borders[k])
                stop = min(int(self.borders[k + 1]), end)
            out.append((self.tail + number, at - begin, stop - at))
            at = stop
        return out


def plan(counts: np.ndarray, window: int = WINDOW) -> Plan:
    """The plan for a histogram of lengths (0 to window).

    Combinations of lengths get their repeat counts by least squares, rounded and bounded by what is there. What
    remains is packed greedily: the longest piece, then the longest that fits, as long as windows get
    full. All others follow end to end, cut where a window is full; the last window is cut into powers of two.
    So no sequence needs padding.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    columns = combinations(left, window)
    wanted = np.floor(repeats(columns, left) + 0.5).astype(np.int64)
    packed: list[tuple[list[int], int]] = []

    def take(parts: list[int], most: int) -> int:
        kinds, uses = np.unique(parts, return_counts=True)
        n = min(most, int((left[kinds] // uses).min()))
        if n > 0:
            left[kinds] -= n * uses
            packed.append((parts, n))
        return n

    for j in np.argsort(-wanted, kind="stable"):
        if wanted[j] <= 0:
            break
        take([int(p) for p in columns[j] if p], int(wanted[j]))
    spare = left.copy()
    while len(present := np.flatnonzero(spare)):
        parts, gap, free = [], window, spare.copy()
        while gap and len(parts) < PARTS:
            fits = present[(present <= gap) & (free[present] > 0)]
            if not len(fits):
                break
            parts.append(int(fits[-1]))
            free[fits[-1]] -= 1
            gap -= parts[-1]
        if gap:
            spare[parts[0]] = 0
        else:
            take(parts, int(left.max()))
            spare = np.minimum(spare, left)
    starts: dict[int, list] = {}
    slots: dict[int, list] = {}
    used, sequence = np.zeros(window + 1, np.int64), 0
    for parts, n in packed:
        offset = 0
        for p in parts:
            starts.setdefault(p, []).append(used[p])
            slots.setdefault(p, []).append((sequence, offset))
            used[p] += n
            offset += p
        sequence += n
    tokens = left * np.arange(window + 1)
    behind = np.cumsum(tokens[::-1])[::-1] - tokens
    total = int(tokens.sum())
    rest = total % window
    powers = [1 << b for b in range(window.bit_length()) if rest >> b & 1][::-1]
    borders = np.cumsum([total - rest, *powers])
    return Plan(
        window,
        {p: np.array(x) for p, x in starts.items()},
        {p: np.array(x) for p, x in slots.items()},
        used, behind, sequence, borders,
    )


def pack(
    docs: DataFrame,
    model: bytes,
    space: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end: int = END,
) -> tuple[DataFrame, DataFrame, str]:
    """Documents as pieces of sequences of tokens: (one row per piece, documents with a key, its name).

    The rows have id, row, start (ids of the document before), length, ids (of the piece, four bytes each, low
    byte first), doc_tokens (with the end), sequence_id (from 0 without gaps) and offset. Sequences are window
    long, but for at most one of each smaller power of two; none has a gap. Whole windows of a long document are sequences of
    their own, so only what is left of it is combined with others.

    A null text counts as empty and has the end alone. Repeats are documents of their own. An empty table
    gives no rows; other columns of docs are not read. The window is a power of two.

    Pieces are told apart by length and rank. Ranks come from counts per task, so a length that
    a third of all documents have is ranked without being sorted or gathered; the driver gets one count
    per length.
    """
    rows, docs, key = encoded(docs, model, space, id_col, text_col, window, end)
    rests = rows.where("rest > 0").groupBy("part", F.col("rest").alias("size")).agg(F.count("*").alias("n"))
    wholes = rows.groupBy("part").agg(F.sum(F.col("n") - F.col("rest")).alias("n"))
    wholes = wholes.select("part", F.lit(window).alias("size"), (F.col("n") / window).cast("long").alias("n"))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = rests.unionByName(wholes).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cells = space.write(cells, "cells")
    counts = np.zeros(window + 1, np.int64)
    for r in cells.groupBy("size").agg(F.sum("n").alias("n")).collect():
        counts[r["size"]] = r.n
    shared = docs.sparkSession.sparkContext.broadcast(plan(counts, window))
    of_rest = small(space.write(cells.selectExpr("part", "size as rest", "base as rest_base"), "bases"))
    of_whole = cells.where(F.col("size") == window).selectExpr("part", "base as whole_base")
    of_whole = small(space.write(of_whole, "wholes"))
    # A document of whole windows alone has no rest to look up.
    placed = rows.join(of_rest, ["part", "rest"], "left").join(of_whole, "part").select(
        "id", "row", "ids", "n", "rest",
        (F.col("alike") + F.coalesce("rest_base", F.lit(0))).alias("rank"),
        (F.col("wholes") + F.col("whole_base")).alias("whole_rank"),
    )
    schema = plus(
        placed.select("id", "row"),
        start="long", length="long", ids="binary", doc_tokens="long", sequence_id="long", offset="long",
    )
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value

        def flush(batch: pa.RecordBatch, of: list[int], out: list[tuple]) -> pa.RecordBatch:
            ids = [batch.column(k).take(pa.array(of, pa.int64())) for k in (0, 1)]
            more = [pa.array(x, k) for x, k in zip(zip(*out), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*ids, *more], names=schema.names)

        for batch in batches:
            numbers = [batch.column(k).to_pylist() for k in (3, 4, 5, 6)]
            of: list[int] = []
            out: list[tuple] = []
            held = 0
            for i, (n, rest, rank, whole) in enumerate(zip(*numbers)):
                ids = batch.column(2)[i].as_py()
                start = 0
                for k in range(n // window + (rest > 0)):
                    size = min(window, n - start)
                    for sequence, offset, length in own.place(size, whole + k if size == window else rank):
                        data = ids[4 * start : 4 * (start + length)]
                        of.append(i)
                        out.append((start, length, data, n, sequence, offset))
                        start, held = start + length, held + len(data)
                    if held > BATCH:
                        yield flush(batch, of, out)
                        of, out, held = [], [], 0
            if out:
                yield flush(batch, of, out)

    return placed.mapInArrow(run, schema), docs, key
