"""Best-fit packing by sums of squares (operator 9).

Documents become token ids and an end id; only those longer than a sequence are cut, into pieces of full length and a rest. Pieces are
placed one by one: with N(g) the number of open sequences that have g tokens left, a piece goes where the sum of the N(g)^2
becomes smallest, which keeps gaps of all kinds at hand. Longer pieces come first, so that the short ones fill what is left.

Packing is done in blocks of pieces dealt at random, each of bounded size and whole in one task; sequences that a block leaves poorly filled are
dissolved and their pieces packed again, in fewer and fewer blocks, until one is left or a round gains nothing. So the number of half-filled sequences
does not grow with the number of blocks.

Tokens come from the tokenizer's file. As its words never reach over ASCII white space, the ids of a text are those of its parts; each task keeps
the ids of parts it met, up to a bounded number, and asks the tokenizer for new ones only.

Defined results: null text: empty, so the end id alone. Null or repeated ids: documents of their own. A text longer than a sequence: pieces in order.
Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vcat.llm.common import settle
from vcat.llm.textbytes import chunks, data, word_places

SEQUENCE, END_ID = 2048, 0
#: Parts of texts whose ids a task keeps, some 30 bytes each; the longest of them, in bytes; bytes of text worked on at once.
KNOWN, LONGEST, CHUNK = 1_000_000, 64, 1 << 20
BLOCK = 8192
#: A block's sequences with less than this share of tokens are packed again.
GOOD = 0.98
_MARKS = b".,!?;:%$&#*"
_encoders: dict[tuple[str, int], Encoder] = {}


class Encoder:
    """Ids of texts by their parts, which are told by 64-bit hashes: ``flat`` has the ids of all known parts one after the other, ``hashes`` (sorted), ``at`` and ``count``
    say where. Of a million parts two have the same hash once in some ten million times; parts that are longer than ``LONGEST`` bytes are not kept."""

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for words that need no more than a split at white space the steps before the model are left out
        self.full = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.bare = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        size = self.tokenizer.get_vocab_size()
        self.closes = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.kind = np.uint16 if size <= 1 << 16 and end_id < 1 << 16 else np.uint32
        self.hashes, self.at, self.count, self.again = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, bool)
        self.flat, self.used = np.zeros(1 << 16, self.kind), 1
        self.flat[0] = end_id

    def _one(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, parts: list[bytes], runs: list[int]) -> list[np.ndarray]:
        """Ids of parts that are ``runs`` runs of letters or marks each: many at once. Every run ends in an id that shows it."""
        out, step = [], 300
        groups = [parts[i:i + step] for i in range(0, len(parts), step)]
        for k, found in enumerate(self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, self.kind)
            ends = np.flatnonzero(self.closes[ids]) + 1
            last = np.cumsum(runs[k * step:k * step + step]) - 1
            out += np.split(ids, ends[last][:-1]) if len(ends) == last[-1] + 1 else self._one([w.decode() for w in groups[k]])
        return out

    def ids_of(self, parts: list[bytes]) -> list[np.ndarray]:
        """Ids of each part, by the tokenizer."""
        plain, other, rest = ([], [], []), ([], [], []), []
        for i, w in enumerate(parts):
            stem = w.rstrip(_MARKS)
            run = 1 if len(stem) == len(w) else 2
            if stem.isalpha():
                place, text = plain, stem.lower() if run == 1 else stem.lower() + b" " + w[len(stem):]
            elif stem.decode().isalpha():
                place, text = other, w
            else:
                rest.append(i)
                continue
            for column, value in zip(place, (i, text, run)):
                column.append(value)
        out: list[np.ndarray] = [None] * len(parts)
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.bare
        found = self._words(*plain[1:])
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.full
        for i, ids in zip((*plain[0], *other[0], *rest), (*found, *self._words(*other[1:]), *self._one([parts[i].decode() for i in rest]))):
            out[i] = ids
        return out

    def _append(self, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        count = np.array([len(x) for x in found], np.int32)
        new = np.concatenate(found) if found else np.zeros(0, self.kind)
        if self.used + len(new) > len(self.flat):
            self.flat = np.concatenate((self.flat[:self.used], np.zeros(len(new) + (self.used >> 1), self.kind)))
        at = self.used + np.cumsum(count) - count
        self.flat[self.used:self.used + len(new)] = new
        self.used += len(new)
        return at.astype(np.int32), count

    def _forget(self, coming: int) -> None:
        """Room for ``coming`` parts: those go that were not met again, or all if that is not enough."""
        keep = self.again if np.count_nonzero(self.again) + coming <= KNOWN // 2 else np.zeros(len(self.again), bool)
        self.hashes, at, count = self.hashes[keep], self.at[keep], self.count[keep]
        own = self.flat[_runs(at, count)]
        self.flat[1:1 + len(own)] = own
        self.at, self.count, self.used = (1 + np.cumsum(count) - count).astype(np.int32), count, 1 + len(own)
        self.again = np.zeros(len(self.hashes), bool)

    def encode(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id, and the bounds of the texts in them."""
        rows, h, start, length = word_places(raw, ends)
        h[length > LONGEST] = np.arange(np.count_nonzero(length > LONGEST))  # each by itself
        parts, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.hashes) + len(parts) > KNOWN or self.used > 8 * KNOWN:
            self._forget(len(parts))
        spot = np.searchsorted(self.hashes, parts)
        known = np.zeros(len(parts), bool)
        inside = spot < len(self.hashes)
        known[inside] = self.hashes[spot[inside]] == parts[inside]
        self.again[spot[known]] = True
        at, count = np.zeros(len(parts), np.int32), np.zeros(len(parts), np.int32)
        at[known], count[known] = self.at[spot[known]], self.count[spot[known]]
        new = ~known
        text, s, n = raw.tobytes(), start[first[new]], length[first[new]]
        at[new], count[new] = self._append(self.ids_of([text[i:i + k] for i, k in zip(s.tolist(), n.tolist())]))
        keep = np.flatnonzero(new)[n <= LONGEST]
        self.hashes, self.again = np.insert(self.hashes, spot[keep], parts[keep]), np.insert(self.again, spot[keep], False)
        self.at, self.count = np.insert(self.at, spot[keep], at[keep]), np.insert(self.count, spot[keep], count[keep])
        words = np.searchsorted(rows, np.arange(len(ends) - 1), "right")  # an end id behind the last part of each text
        at, count = np.insert(at[inverse], words, 0), np.insert(count[inverse], words, 1)
        bounds = np.cumsum(count)[words + np.arange(len(words))]
        return self.flat[_runs(at, count)].astype("<u4"), np.concatenate(([0], bounds))


def _runs(at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places at, at + 1, ... of every run, one after the other."""
    before = np.cumsum(count) - count
    return np.repeat(at.astype(np.int64) - before, count) + np.arange(int(count.sum()))


def encoder(path: str, end_id: int) -> Encoder:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def _pieces(path: str, sequence: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, end_id)
        for batch in batches:
            docs, texts = batch.column(0), pc.fill_null(batch.column(1), "")
            for i, j in chunks(texts, CHUNK):
                ids, bounds = own.encode(*data(texts.slice(i, j - i)))
                size = np.diff(bounds)
                pieces = -(-size // sequence)
                rows = np.repeat(np.arange(j - i), pieces)
                piece = _runs(np.zeros(j - i, np.int64), pieces)
                begin = bounds[rows] + piece * sequence
                length = np.minimum(sequence, bounds[rows + 1] - begin)
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * b:4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist())]
                cols = [docs.take(pa.array(rows + i)), pa.array(piece.astype(np.int32)), pa.array(piece * sequence), pa.array(length), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate((begin, bounds[-1:])), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def tokenize(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece, and with ``with_ids`` its ``ids``."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(path, sequence, end_id, with_ids), schema)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each size, in the order given. Of equal choices the tightest fit."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap; full ones don't count
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = np.arange(capacity + 1)
    out, made = np.empty(len(sizes), np.int64), 0
    for i, s in enumerate(sizes.tolist()):
        # change of the sum: gap g loses a sequence, g - s gains one
        change = 2 * (count[:capacity + 1 - s] - count[s:]) + 2
        change[0] = 1 - 2 * count[s]
        change[count[s:] == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        fresh = 2 * count[capacity - s] + 1 if s < capacity else 0
        if change[best] <= fresh:
            b = open_by_gap[best + s].pop()
            count[best + s] -= 1
            gap = best
        else:
            b, gap = made, capacity - s
            made += 1
        if gap:
            count[gap] += 1
            open_by_gap[gap].append(b)
        out[i] = b
    return out


def _pack_block(capacity: int, good: float, first: int):
    def run(table: pa.Table) -> pa.Table:
        length = table["length"].to_numpy()
        order = np.lexsort((table["ids_crc32"].to_numpy(), table["piece"].to_numpy(), -length))
        table, length = table.take(pa.array(order)), length[order]
        bins = sum_of_squares(length, capacity)
        fill = np.bincount(bins, weights=length).astype(np.int64)
        by_bin = np.argsort(bins, kind="stable")
        before = np.concatenate(([0], np.cumsum(length[by_bin])[:-1]))
        head = np.full(len(fill), np.iinfo(np.int64).max)
        np.minimum.at(head, bins[by_bin], before)
        offset = np.empty(len(bins), np.int64)
        offset[by_bin] = before - head[bins[by_bin]]
        sequence = first + (int(table["block"][0].as_py()) << 20) + bins
        done = fill[bins] >= good * capacity
        return table.drop_columns(["block"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).append_column("done", pa.array(done))

    return run


def pack(pieces: DataFrame, sequence: int = SEQUENCE, block: int = BLOCK, good: float = GOOD) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; they need ``piece, length, ids_crc32`` and may have more columns."""
    keep = [c for c in pieces.columns if c not in ("block", "sequence_id", "offset", "done")]
    rest, done, before, turn = settle(pieces.select(*keep), "pieces"), None, None, 0
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema) + ", sequence_id long, offset long, done boolean"
    while True:
        blocks = max(1, -(-rest.count() // block))
        last = blocks == 1 or blocks == before
        dealt = rest.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(blocks)))
        placed = settle(dealt.groupBy("block").applyInArrow(_pack_block(sequence, 0.0 if last else good, turn << 56), schema), "packed")
        out = placed.filter("done").drop("done")
        done = out if done is None else done.unionByName(out)
        if last:
            return done
        rest, before, turn = placed.filter("NOT done").select(*keep), blocks, turn + 1


def sequences(docs: DataFrame, packed: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """``sequence_id, ids`` and the ``pieces`` (doc_id, piece, offset, length) in them. ``doc_id`` has to be a key here."""
    ids = tokenize(docs, path, sequence, end_id, with_ids=True).select("doc_id", "piece", "ids")
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    rows = packed.select("doc_id", "piece", "length", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    full = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))  # no more tokens than a sequence has
    return full.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
                       F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["offset"].alias("offset"), x["length"].alias("length"))).alias("pieces"))
