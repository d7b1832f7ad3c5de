"""Packing token sequences: best fit, then a local search that swaps pieces between sequences that are not full.

``cut`` encodes texts and cuts only those longer than a sequence. ``pack`` deals all pieces evenly into groups of about ``GROUP``
pieces; each is packed by best fit in order of falling length and then improved: a piece moves, one is exchanged for one,
or two for one, between two sequences with room, always so that the sum of squared fills grows, which takes tokens from the
emptiest sequence to fuller ones until it is empty. Two pieces of a victim are tried in all pairs, against the sorted
lengths of all others. The search ends when a group has as few sequences as its tokens allow, or when a whole pass over all sequences
with room finds no exchange, which comes as squared fills only grow. A group leaves less than one sequence unfilled
beyond what it alone needs, out of thousands, so packing groups apart costs next to nothing.

Only lengths and keys are shuffled, in equal parts whatever the keys; no task holds more than one group.

Defined results: null text is empty, and then has the end token alone. Rows that repeat a key are packed each. An empty table
gives an empty table. A length above the capacity, or below one, raises. ``sequence_id`` and ``offset`` replace columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm import pretokens as pt
from postsift.llm.bpe import SLICE, lengths, vocabulary
from postsift.sources.shipping import ship

#: Pieces packed together; exchanges looked up at a time.
GROUP, WIDE = 32_768, 1 << 20


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Sequences as lists of pieces: the longest piece first, each where it leaves least room."""
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by the room they have
    rooms = 0  # the bits of all rooms that some sequence has
    out: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        n = sizes[i]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            place = open_[room].pop()
            if not open_[room]:
                rooms ^= 1 << room
            out[place].append(i)
        else:
            room, place = capacity, len(out)
            out.append([i])
        room -= n
        if room:
            open_[room].append(place)
            rooms |= 1 << room
    return out


class Search:
    """Sequences that are not full, with their pieces in one sorted array by length and by the room beside them."""

    def __init__(self, sequences: list[list[int]], sizes: np.ndarray, capacity: int):
        self.capacity, self.sizes, self.held = capacity, sizes, [list(s) for s in sequences]
        self.fill = np.array([int(sizes[s].sum()) for s in self.held], np.int64)
        self.at = {i: k for k, s in enumerate(self.held) for i in s}
        self.lengths = np.unique(sizes[list(self.at)])
        self.pieces = np.sort(np.concatenate([self.pieces_of(k) for k in range(len(self.held))]))
        self.rooms = np.sort((capacity - self.fill) * len(self.held) + np.arange(len(self.held)))

    def pieces_of(self, place: int) -> np.ndarray:
        """Length, room and number of the pieces of a sequence, each as one sortable integer."""
        i = np.array(self.held[place], np.int64)
        return np.sort((self.sizes[i] * (self.capacity + 1) + self.capacity - self.fill[place]) * len(self.sizes) + i)

    def take_out(self, place: int) -> None:
        self.pieces = np.delete(self.pieces, np.searchsorted(self.pieces, self.pieces_of(place)))
        room = (self.capacity - self.fill[place]) * len(self.held) + place
        self.rooms = np.delete(self.rooms, np.searchsorted(self.rooms, room))

    def put_in(self, place: int) -> None:
        mine = self.pieces_of(place)
        self.pieces = np.insert(self.pieces, np.searchsorted(self.pieces, mine), mine)
        room = (self.capacity - self.fill[place]) * len(self.held) + place
        self.rooms = np.insert(self.rooms, np.searchsorted(self.rooms, room), room)

    def exchange(self, victim: int) -> bool:
        """Take tokens from the victim, which is taken out, by the one exchange that raises the sum of squared fills most."""
        if not len(self.rooms):
            return False
        own, places, n = self.held[victim], len(self.held), len(self.sizes)
        size = self.sizes[own]
        lack = self.capacity - int(self.fill[victim])
        best, chosen = 0, None
        found = np.searchsorted(self.rooms, size * places)  # of the sequences with room for it, the fullest
        fits = np.flatnonzero(found < len(self.rooms))
        if len(fits):
            gain = 2 * size[fits] * (lack - self.rooms[found[fits]] // places + size[fits])
            k = int(gain.argmax())
            if gain[k] > best:
                best, chosen = int(gain[k]), ((own[fits[k]],), int(self.rooms[found[fits[k]]] % places), ())
        first, second = np.triu_indices(len(own), 1)
        sums, which = np.unique(np.concatenate([size, size[first] + size[second]]), return_index=True)
        widest = int(self.rooms[-1]) // places
        low, high = np.searchsorted(self.lengths, sums - widest), np.searchsorted(self.lengths, sums)
        for a, b in pt.slices((high - low).tolist(), WIDE):  # every sum of one or two own pieces against all lengths that may return
            count = (high - low)[a:b]
            given = np.repeat(np.arange(a, b), count)
            back = self.lengths[np.arange(len(given)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[a:b], count)]
            net = sums[given] - back
            at = np.searchsorted(self.pieces, (back * (self.capacity + 1) + net) * n)
            key = self.pieces[np.minimum(at, len(self.pieces) - 1)] // n
            fits = (at < len(self.pieces)) & (key // (self.capacity + 1) == back)
            gain = np.where(fits, 2 * net * (lack - key % (self.capacity + 1) + net), 0)
            if len(gain) and gain.max() > best:
                k = int(gain.argmax())
                best, take = int(gain[k]), int(self.pieces[at[k]] % n)
                pair = int(which[given[k]]) - len(own)
                give = (own[pair + len(own)],) if pair < 0 else (own[first[pair]], own[second[pair]])
                chosen = (give, self.at[take], (take,))
        if chosen is None:
            return False
        give, to, take = chosen
        self.take_out(to)
        for moved, source, target in ((give, victim, to), (take, to, victim)):
            for i in moved:
                self.held[source].remove(i)
                self.held[target].append(i)
                self.at[i] = target
        net = int(self.sizes[list(give)].sum()) - int(self.sizes[list(take)].sum())
        self.fill[to] += net
        self.fill[victim] -= net
        self.put_in(to)
        return True

    def run(self, spare: int) -> None:
        """Empty up to ``spare`` sequences; ends before only if no sequence has an exchange left."""
        exchanged = True
        while spare > 0 and exchanged:
            exchanged = False
            for victim in np.argsort(self.fill, kind="stable").tolist():
                if not 0 < self.fill[victim] < self.capacity:
                    continue
                self.take_out(victim)
                while self.fill[victim] and self.exchange(victim):
                    exchanged = True
                if self.fill[victim]:
                    self.put_in(victim)
                    continue
                spare -= 1
                if not spare:
                    return

    def sequences(self) -> list[list[int]]:
        return [s for s in self.held if s]


def packed(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Pieces of each sequence of one group."""
    if len(sizes) and (sizes.max() > capacity or sizes.min() < 1):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    first = best_fit(sizes.tolist(), capacity)
    least = -(-int(sizes.sum()) // capacity)
    if len(first) <= least:
        return first
    fill = [int(sizes[s].sum()) for s in first]
    done = [s for s, f in zip(first, fill) if f == capacity]
    search = Search([s for s, f in zip(first, fill) if f < capacity], sizes, capacity)
    search.run(len(first) - least)
    return done + search.sequences()


def pack(df: DataFrame, length: str = "length", capacity: int = 2048) -> DataFrame:
    """``df`` with ``sequence_id`` and ``offset``. Give keys and lengths only: a task holds a whole group.

    ``df`` should be a written table: it is counted first and then dealt out.
    """
    ship(df.sparkSession)
    rows = df.drop("sequence_id", "offset")
    groups = max(1, math.ceil(rows.count() / GROUP))
    schema = rows.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        sizes = table[length].to_numpy().astype(np.int64)
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        group = TaskContext.get().partitionId() << 32
        for k, pieces in enumerate(packed(sizes, capacity)):
            sequence[pieces] = group + k
            offset[pieces] = np.cumsum(sizes[pieces]) - sizes[pieces]
        table = table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from table.to_batches()

    return rows.repartition(groups).mapInArrow(run, schema)


def cut(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """key, piece, start, length, ids: texts encoded, ended by ``end_id``, and cut into pieces of ``capacity`` tokens if longer.

    Every piece but the first is full. ``ids``: unsigned 32-bit little-endian numbers on end.
    """
    ship(df.sparkSession)
    schema = df.select(F.col(f"`{key}`").alias(key)).schema
    for column, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids", "binary")):
        schema = schema.add(column, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for whole in batches:
            for begin, end in pt.slices(lengths(whole.column(1)).tolist(), SLICE):
                b = whole.slice(begin, end - begin)
                owner, piece, start, size, ids = [], [], [], [], []
                for row, found in enumerate(words.encode([t or "" for t in b.column(1).to_pylist()])):
                    tokens = np.append(found, end_id).astype("<u4")
                    cuts = [0, *range(len(tokens) % capacity or capacity, len(tokens) + 1, capacity)]
                    for k, (at, until) in enumerate(zip(cuts, cuts[1:])):
                        owner.append(row)
                        piece.append(k)
                        start.append(at)
                        size.append(until - at)
                        ids.append(tokens[at:until].tobytes())
                keys = b.column(0).take(pa.array(owner, pa.int64()))
                columns = [keys, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        words.forget()  # the worker may serve other stages next

    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)
