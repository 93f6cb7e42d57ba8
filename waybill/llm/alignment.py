"""Cross-tokenizer alignment: groups of overlapping tokens by pointer jumping, links counted over the corpus."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator, Mapping
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.byte_bpe import byte_letters, codec
from waybill.llm.common import bytes_of, keyed, small, text_of
from waybill.llm.token_counts import processor, text_parts
from waybill.sources.scratch import Scratch

#: Characters aligned at a time; longer texts come in parts of about that many.
CHARS = 1 << 20
#: Up to so many links a group is spelt out; above, equal ids of a side are taken together first.
PLAIN = 64
#: Pre-tokens of A that a worker remembers.
REMEMBERED = 400_000


def ranks_of(model: bytes) -> bytes:
    """The vocabulary of a byte-level BPE file for the tokenizers library, as a file of ranks.

    Ids must be ranks: single bytes first, then one token per merge in the merges' order.
    """
    inner = json.loads(model)["model"]
    spelt = {letter: b for b, letter in enumerate(byte_letters())}
    merges = [m.split(" ") if isinstance(m, str) else m for m in inner["merges"]]
    bases = [t for t in inner["vocab"] if t in spelt]
    if any(inner["vocab"]["".join(m)] != len(bases) + k for k, m in enumerate(merges)):
        raise ValueError("ids do not follow the merges")
    tokens = [*bases, *("".join(m) for m in merges)]
    lines = [(bytes(spelt[x] for x in t), inner["vocab"][t]) for t in tokens]
    return b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in lines)


class Aligned(NamedTuple):
    """Counts, groups as text, and distinct id pairs with how often they are linked."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    pairs: np.ndarray
    uses: np.ndarray


def jumps(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For each token of A, then of B, the last token of its component of overlapping ones.

    Tokens are given by the ends of their bytes; both sides end at the same byte. Each points to the token that
    reaches farthest right among those it overlaps, which is the other side's token at its own last byte, or the token
    itself; of two that end together the one of B counts. Pointers are replaced by those of their targets until
    nothing changes, which takes as many steps as the logarithm of the longest chain.
    """
    size = int(a_end[-1]) + 1 if len(a_end) else 1
    over, back = _ends_before(b_end, size)[a_end], _ends_before(a_end, size)[b_end]
    own = len(a_end) + np.arange(len(b_end))
    at = np.concatenate([len(a_end) + over, np.where(a_end[back] > b_end, back, own)])
    while not np.array_equal(further := at[at], at):
        at = further
    return at


def _ends_before(ends: np.ndarray, size: int) -> np.ndarray:
    """For each byte offset below size, how many ends are below it."""
    return np.concatenate([[0], np.cumsum(np.bincount(ends, minlength=size))])[:size]


def linked_pairs(
    group_a: np.ndarray, group_b: np.ndarray, a: np.ndarray, b: np.ndarray, unit: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, pair, uses): how often each pair of ids, as a * width + b, is linked in each unit.

    Groups are numbered in order; unit gives each group's.
    """
    n = len(unit)
    of_a, of_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    large = of_a * of_b > PLAIN
    weight_a, weight_b = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
    if large.any():
        group_a, a, weight_a = _merged(group_a, a, large)
        group_b, b, weight_b = _merged(group_b, b, large)
        of_a, of_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    start = np.cumsum(of_b) - of_b
    times = of_b[group_a]
    left = np.repeat(np.arange(len(a)), times)
    right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + start[group_a[left]]
    key = a[left].astype(np.int64) * width + b[right]
    of = unit[group_a[left]]
    most = int(key.max()) + 1 if len(key) else 1
    if not large.any() and n < (1 << 62) // most:
        both = np.sort(of * most + key)
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(key) else np.zeros(0, np.int64)
        uses = np.diff(np.append(first, len(both)))
        return both[first] // most, both[first] % most, uses
    uses = weight_a[left] * weight_b[right]
    order = np.lexsort((key, of))
    key, uses, of = key[order], uses[order], of[order]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])]))
    if not len(key):
        return of, key, uses
    return of[first], key[first], np.add.reduceat(uses, first)


def _merged(group: np.ndarray, ids: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens with their weight; equal ids of a large group are one."""
    some = large[group]
    both = np.stack([group[some], ids[some]], 1)
    both, count = np.unique(both, axis=0, return_counts=True)
    group = np.concatenate([group[~some], both[:, 0]])
    ids = np.concatenate([ids[~some], both[:, 1]])
    weight = np.concatenate([np.ones((~some).sum(), np.int64), count])
    order = np.argsort(group, kind="stable")
    return group[order], ids[order], weight[order]


class Aligner:
    """Aligns the tokens of a byte-level BPE on space and text with those of a sentencepiece model on the text."""

    def __init__(self, ranks: bytes, pattern: str, pieces: bytes) -> None:
        self.a = codec(ranks, pattern, REMEMBERED)
        self.b, self.may_cut = processor(pieces)
        self.width = self.b.get_piece_size()
        self.a_bytes = self.a.spelling
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.width))
        ]
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_size[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_spelt = pa.array([self.a_bytes.get(i, b"") for i in range(len(self.a_size))], pa.binary())
        self.b_spelt = pa.array(self.b_bytes, pa.binary())
        # Ids as they stand in groups: of A, within and at the end of its side, then of B.
        spelt = [f"{i}{mark}" for mark in ",|" for i in range(len(self.a_size))]
        spelt += [f"{i}{mark}" for mark in ",;" for i in range(self.width)]
        self.spelt = pa.array(spelt, pa.string())

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts that start tokens of both sides: cut at single spaces between ASCII letters or digits."""
        return text_parts(text, CHARS) if self.may_cut else iter([text])

    def _tokens(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides, or None where the bytes of one are not those of space and text."""
        data = [b" " + part.encode() for part in parts]
        both = self.a.encode_all([" " + part for part in parts]), self.b.encode(parts, num_threads=1)
        both = both[0], [np.array(ids, np.int32) for ids in both[1]]
        same = [self._gives(*x, data) for x in zip(both, (self.a_spelt, self.b_spelt), strict=True)]
        return [(a, b) if x and y else None for a, b, x, y in zip(*both, *same, strict=True)]

    def _gives(self, ids: list[np.ndarray], spelt: pa.BinaryArray, data: list[bytes]) -> list[bool]:
        """Whether the ids of each part spell its bytes; they are compared at once, and one by one if they differ."""
        offsets, found = bytes_of(spelt.take(pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))))
        ends = offsets[np.cumsum([0, *map(len, ids)])]
        if np.array_equal(np.diff(ends), list(map(len, data))) and found[: ends[-1]].tobytes() == b"".join(data):
            return [True] * len(data)
        return [found[x:y].tobytes() == own for x, y, own in zip(ends, ends[1:], data)]

    def align(self, parts: list[str]) -> list[Aligned | None]:
        """The alignment of each part, all of them at once; None where tokens do not give the bytes back."""
        found = self._tokens(parts)
        good = [x for x in found if x is not None]
        if not good:
            return [None] * len(parts)
        a, b = (np.concatenate([x[k] for x in good]) for k in (0, 1))
        n_a, n_b = (np.array([len(x[k]) for x in good]) for k in (0, 1))
        last = jumps(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
        ends = np.flatnonzero(last == np.arange(len(last)))
        number = np.zeros(len(last), np.int64)
        number[ends] = np.arange(len(ends))
        group = number[last]
        group_a, group_b = group[: len(a)], group[len(a) :]
        unit = np.repeat(np.arange(len(good)), n_b)[ends - len(a)]
        n_groups = np.bincount(unit, minlength=len(good))
        of, pairs, uses = linked_pairs(group_a, group_b, a, b, unit, self.width)
        cut = np.searchsorted(of, np.arange(len(good) + 1))
        a_close, b_close = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        base = 2 * len(self.a_size)
        spelt = np.concatenate([a + len(self.a_size) * a_close, base + b + self.width * b_close])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        offsets, data = bytes_of(self.spelt.take(pa.array(spelt[order])))
        stops = np.cumsum(n_a + n_b)
        done = iter(
            Aligned(
                int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(uses[cut[k] : cut[k + 1]].sum()),
                data[offsets[stop - n_a[k] - n_b[k]] : offsets[stop] - 1].tobytes().decode(),
                pairs[cut[k] : cut[k + 1]], uses[cut[k] : cut[k + 1]],
            )
            for k, stop in enumerate(stops.tolist())
        )
        return [None if x is None else next(done) for x in found]

    def whole(self, parts: list[Aligned | None]) -> Aligned:
        """The alignment of a text from those of its parts; nothing if one of them has none."""
        if len(parts) == 1 and parts[0] is not None:
            return parts[0]
        if not parts or None in parts:
            return Aligned(0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        pairs, place = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
        uses = np.zeros(len(pairs), np.int64)
        np.add.at(uses, place, np.concatenate([p.uses for p in parts]))
        numbers = (sum(p[k] for p in parts) for k in range(4))
        return Aligned(*numbers, ";".join(p.groups for p in parts), pairs, uses)


@cache
def aligner(ranks: bytes, pattern: str, pieces: bytes) -> Aligner:
    """One aligner for each worker process and pair of tokenizers."""
    return Aligner(ranks, pattern, pieces)


def aligned(texts: DataFrame, ranks: bytes, pattern: str, pieces: bytes) -> DataFrame:
    """(one, n, n_a, n_b, n_groups, n_links, groups, pairs, uses) of rows (one, n, text)."""
    shared = texts.sparkSession.sparkContext.broadcast((ranks, pattern, pieces))
    kind = texts.schema["one"].dataType.simpleString()
    schema = f"one {kind}, n long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    schema += "pairs array<long>, uses array<long>"
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def columns(batch: pa.RecordBatch, start: int, rows: list[Aligned]) -> pa.RecordBatch:
        ends = np.cumsum([0, *(len(r.pairs) for r in rows)]).astype(np.int32)
        none = [np.zeros(0, np.int64)]
        lists = [
            pa.ListArray.from_arrays(ends, np.concatenate([*none, *x]))
            for x in ([r.pairs for r in rows], [r.uses for r in rows])
        ]
        numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
        kept = batch.slice(start, len(rows)).columns[:2]
        more = [*numbers, pa.array([r.groups for r in rows], pa.string()), *lists]
        return pa.RecordBatch.from_arrays([*kept, *more], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*shared.value)
        for batch in batches:
            start, found, waiting = 0, {}, []  # found: by place, the parts aligned so far
            held = 0
            for i, text in enumerate(batch.column(2)):
                found[i] = []
                text = text.as_py()
                for part in own.parts(text) if text else ():
                    waiting.append((i, part))
                    held += len(part)
                    if held >= CHARS:
                        for (k, _), x in zip(waiting, own.align([p for _, p in waiting]), strict=True):
                            found[k].append(x)
                        waiting, held = [], 0
                if i + 1 == batch.num_rows or (not waiting and i >= start):
                    for (k, _), x in zip(waiting, own.align([p for _, p in waiting]), strict=True):
                        found[k].append(x)
                    waiting, held = [], 0
                    yield columns(batch, start, [own.whole(found[k]) for k in range(start, i + 1)])
                    start, found = i + 1, {}

    return texts.mapInArrow(run, schema)


def align(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    pieces: bytes,
    space: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    give: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """How two tokenizers cut each document: (one row per document, counts of id pairs, documents with a key, its name).

    The rows have id, row, n_a, n_b (tokens), n_groups, n_links, n_best, count_sum and, unless give names other columns made
    of it, groups: "a1,a2|b1;a3|b2,b3" with the ids in order. A text's byte offsets where tokens of both sides end
    cut it into groups; every token of A is linked with every one of B in its group. The counts have pair (a * number
    of pieces + b), count (documents that hold it linked) and best (whether no pair of that a has more).
    n_best sums the links whose pair is best, count_sum the counts over links.

    Tokens must give back the bytes of a space and the text. A text for which they do not, a null and an empty one have no
    tokens: zeros and no groups. Repeats are documents of their own and count as such; equal texts are aligned
    once. An empty table gives no rows; other columns of docs are not read. Long texts are aligned in parts.
    """
    docs, key = keyed(docs, id_col, space)
    text = text_of(text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(key).alias("row"), F.unhex(F.sha2(text, 256)).alias("digest")
    )
    rows = space.write(rows, "digests")
    classes = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("row").alias("one"))
    classes = space.write(classes, "classes")
    firsts = small(classes.select("one", "n"))
    texts = docs.select(F.col(key).alias("one"), text.alias("text")).join(firsts, "one")
    give = {"groups": F.col("groups")} if give is None else dict(give)
    kept = ["one", "n", "n_a", "n_b", "n_groups", "n_links", "pairs", "uses"]
    found = aligned(texts.select("one", "n", "text"), ranks, pattern, pieces)
    found = space.write(found.select(*kept, *[c.alias(name) for name, c in give.items()]), "aligned")

    width = processor(pieces)[0].get_piece_size()
    counts = found.select("n", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.select("pair", F.floor(F.col("pair") / width).alias("a"), "count")
    counts = space.write(counts, "counts")
    most = space.write(counts.groupBy("a").agg(F.max("count").alias("most")), "most")
    counts = counts.join(small(most), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    counts = space.write(counts, "pairs")

    links = found.select("one", F.inline(F.arrays_zip("pairs", "uses")))
    links = links.join(small(counts), links["pairs"] == counts["pair"])
    sums = links.groupBy("one").agg(
        F.sum(F.col("uses") * F.col("count")).alias("count_sum"),
        F.sum(F.when(F.col("best"), F.col("uses")).otherwise(0)).alias("n_best"),
    )
    sums = space.write(sums, "sums")
    # One stored row per text, so that the rows of a frequent one are split in the joins.
    full = found.drop("pairs", "uses", "n").join(small(sums), "one", "left")
    full = space.write(classes.select("digest", "one").join(full, "one").drop("one"), "full")
    none = F.lit(0).cast("long")
    out = rows.join(full, "digest").select(
        "id", "row", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"),
        *[f"`{name}`" for name in give],
    )
    return out, counts, docs, key
