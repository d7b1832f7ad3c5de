"""Byte-pair encoding and decoding with forced boundaries.

A merge joins two neighbouring parts into a vocabulary token, so two bytes that stand side by side inside no token of the
vocabulary are never joined: every such place is a certain cut. A text is cut there (and where its words begin), each
distinct fragment is encoded once on its own, and the codes of a text's fragments are put together in order. The result
equals that of the library, as merges on either side of a certain cut cannot see each other.

``Vocabulary`` reads a tokenizer file with a BPE model over byte-level characters. Two kinds of splitting are known: words
with a leading space (GPT-2 pattern), and lower-cased words that carry an end mark. Other files raise.

Defined results: null text is empty and has no ids; special tokens written out in a text become their ids, as the library
does by default; null ids decode to an empty text; an unknown id raises. Repeated rows are encoded each. Other columns are
kept, whatever their names; the output columns replace columns of the same name.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType

from postsift.llm import pretokens as pt
from postsift.llm.common import batches_of

#: Code points handled at a time, and distinct fragments remembered, by one Python worker.
SLICE, REMEMBERED = 1_000_000, 200_000
#: Rank of a pair that is never joined; bytes from which a fragment is handled alone; a byte that no UTF-8 text has.
NEVER, LONG, END = 1 << 30, 64, b"\xff"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("a BPE model over byte-level characters is needed")
        self.mark: str = model.get("end_of_word_suffix") or ""
        splits = json.dumps(file["pre_tokenizer"])
        self.spaced = '"Split"' not in splits
        if self.spaced and (file["normalizer"] or self.mark) or not self.spaced and "[\\\\p{N}]|" not in splits:
            raise ValueError("this way of splitting words is not known")
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.decoder = (file.get("decoder") or {}).get("type")
        characters = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(characters)}
        self.single = np.array([self.vocab[c] for c in characters], np.int32)
        self.final = np.array([self.vocab[c + self.mark] for c in characters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.may_join = np.zeros((256, 256), bool)
        for token in self.vocab:
            inside = [self.byte_of[c] for c in token.removesuffix(self.mark)]
            self.may_join[inside[:-1], inside[1:]] = True
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        ranked = np.array(list(self.merges.values()), np.int64).reshape(-1, 2)
        order = np.argsort(keys)
        self.pair_keys, self.pair_rank, self.pair_id = keys[order], ranked[order, 0], ranked[order, 1].astype(np.int32)
        self.forget()
        self._library = None

    def library(self):
        """The library's tokenizer, for the splitting of texts with rare characters."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def forget(self) -> None:
        """Start remembering fragments anew."""
        self.known: dict[bytes, int] = {}
        self.flat, self.sizes = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)
        self.used = 0

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of joining each pair, NEVER if it is not in the list, and the id of the result."""
        key = a.astype(np.int64) << 32 | b
        if not len(self.pair_keys):
            return np.full(len(key), NEVER), np.zeros(len(key), np.int32)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], NEVER), self.pair_id[at]

    def long_fragment(self, ids: list[int]) -> list[int]:
        """The same merges for one long fragment: a heap of pairs over a linked list."""
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        merges, alive = self.merges, [True] * n
        heap = [(*merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, new, i, pair = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], alive[j], after[i] = new, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (p := (ids[k], ids[after[k]])) in merges:
                    heapq.heappush(heap, (*merges[p], k, p))
        return [x for x, a in zip(ids, alive) if a]

    def fragments(self, pieces: list[bytes], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct fragments on end, and how many each has.

        In each round every fragment joins its pair of lowest rank, the leftmost first; those without one are done.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        last = np.cumsum(sizes) - 1
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ids = self.single[raw]
        ids[last[ends]] = self.final[raw[last[ends]]]
        long = np.flatnonzero(sizes > LONG)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        if len(long):
            parts = np.split(ids, last[:-1] + 1)
            for i in long.tolist():
                parts[i] = np.array(self.long_fragment(parts[i].tolist()), np.int32)
            ids, owner = np.concatenate(parts), np.repeat(np.arange(len(pieces)), [len(x) for x in parts])
        rank, new = np.full(len(ids), NEVER), np.zeros(len(ids), np.int32)
        inside = np.flatnonzero((owner[1:] == owner[:-1]) & (sizes[owner[1:]] <= LONG))
        rank[inside], new[inside] = self.pairs(ids[inside], ids[inside + 1])
        done_ids, done_owner = [], []
        while len(ids):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), first)
            going = best >> 32 < NEVER
            still = np.repeat(going, np.diff(np.append(first, len(ids))))
            if not still.all():
                done_ids.append(ids[~still])
                done_owner.append(owner[~still])
                moved = np.cumsum(still) - 1
                ids, owner, rank, new = ids[still], owner[still], rank[still], new[still]
                at = moved[best[going] & 0xFFFFFFFF]
            else:
                at = best & 0xFFFFFFFF
            if not len(ids):
                break
            ids[at] = new[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one element before it has gone for each earlier fragment
            ids, owner = ids[keep], owner[keep]
            rank, new = rank[keep], new[keep]
            for k in (at, at[(at > 0)] - 1):
                same = np.append(owner, -1)[k + 1] == owner[k]
                rank[k] = NEVER
                k = k[same]
                rank[k], new[k] = self.pairs(ids[k], ids[k + 1])
        owner = np.concatenate([np.zeros(0, np.int64), *done_owner])
        order = np.argsort(owner, kind="stable")
        flat = np.concatenate([np.zeros(0, np.int32), *done_ids])[order]
        return flat, np.bincount(owner, minlength=len(pieces))

    def lookup(self, keys: list[bytes]) -> np.ndarray:
        """Place of each fragment among the remembered ones. A key ends in END where a word ends."""
        if len(self.known) >= REMEMBERED:
            self.forget()
        get = self.known.get
        places = [get(k, -1) for k in keys]
        missing = [i for i, p in enumerate(places) if p < 0]
        if missing:
            new = [keys[i] for i in missing]
            ends = np.fromiter((k[-1] == END[0] for k in new), bool, len(new))
            flat, sizes = self.fragments([k[:-1] if e else k for k, e in zip(new, ends)], ends)
            begin = len(self.known)
            if self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate((self.flat[: self.used], np.zeros(self.used + 2 * len(flat), np.int32)))
            if begin + len(new) > len(self.sizes):
                self.sizes = np.concatenate((self.sizes[:begin], np.zeros(begin + 2 * len(new), np.int64)))
            self.flat[self.used : self.used + len(flat)] = flat
            self.sizes[begin : begin + len(new)] = sizes
            self.used += len(flat)
            for k, (i, key) in enumerate(zip(missing, new), begin):
                places[i] = self.known[key] = k
        return np.array(places, np.int64)

    def codes(self, data: bytes, word_starts: np.ndarray, dropped: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all bytes on end; for each fragment its first byte and its number of ids.

        ``word_starts`` marks bytes at which a word begins, ``dropped`` those of white space that is not encoded.
        """
        raw = np.frombuffer(data, np.uint8)
        cut = word_starts.copy()
        cut[1:] |= ~self.may_join[raw[:-1], raw[1:]]
        at = np.flatnonzero(cut)
        code, distinct = pt.coded(data, np.append(at, len(raw)))
        ends = np.append(word_starts[at[1:]], True) if self.mark else np.zeros(len(at), bool)
        if dropped is not None:
            kept = ~dropped[at]
            at, code, ends = at[kept], code[kept], ends[kept]
        both = code.astype(np.int64) * 2 + ends
        used = np.flatnonzero(np.bincount(both, minlength=2 * len(distinct)))
        keys = [distinct[k >> 1] + END if k & 1 else distinct[k >> 1] for k in used.tolist()]
        known = np.zeros(2 * len(distinct) + 1, np.int64)
        known[used] = self.lookup(keys)
        which = known[both]
        sizes = self.sizes[: len(self.known)]
        begins = np.cumsum(sizes) - sizes
        n = sizes[which]
        ahead = np.cumsum(n) - n
        gather = np.arange(int(n.sum())) + np.repeat(begins[which] - ahead, n)
        return self.flat[gather], at, n

    def common(self, texts: list[str]) -> tuple[list[np.ndarray | None], None]:
        """Ids of each text, None for texts with characters that the library has to split."""
        t = pt.Texts(texts)
        kind = t.kinds()
        cp = t.cp
        bad = kind == pt.UNSURE
        if not self.spaced:
            cp = pt.lower_table()[np.minimum(cp, pt.TOP)]
            bad |= cp == 0
        unsure = set(t.unsure(bad).tolist())
        if unsure:
            sure = [x for i, x in enumerate(texts) if i not in unsure]
            found = iter(self.common(sure))
            return [None if i in unsure else next(found) for i in range(len(texts))]
        if not len(cp):
            return [np.zeros(0, np.int32) for _ in texts]
        begin = (pt.with_spaces if self.spaced else pt.without_spaces)(cp, kind, t.first)
        data = np.ascontiguousarray(cp, np.uint32).tobytes().decode("utf-32-le").encode() if not self.spaced else "".join(texts).encode()
        place = pt.byte_offsets(cp)
        starts = np.zeros(len(data), bool)
        starts[place[:-1][begin]] = True
        dropped = None
        if not self.spaced:
            dropped = np.zeros(len(data), bool)
            dropped[place[:-1][kind >= pt.BLANK]] = True
        ids, at, n = self.codes(data, starts, dropped)
        until = np.concatenate(([0], np.cumsum(n)))
        borders = until[np.searchsorted(at, place[t.first])]
        return np.split(ids, borders[1:-1]) if len(texts) > 1 else [ids]

    def words(self, text: str) -> list[bytes]:
        """Words as the library splits them."""
        t = self.library()
        if t.normalizer is not None:
            text = t.normalizer.normalize_str(text)
        return [bytes(self.byte_of[c] for c in w) for w, _ in t.pre_tokenizer.pre_tokenize_str(text)]

    def rare(self, text: str) -> np.ndarray:
        words = [w for w in self.words(text) if w]
        data = b"".join(words)
        if not data:
            return np.zeros(0, np.int32)
        starts = np.zeros(len(data), bool)
        starts[np.cumsum([0, *map(len, words[:-1])])] = True
        return self.codes(data, starts, None)[0]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        plain: list[str] = []
        layout: list[list[int]] = []  # of each text: -1 for a plain part, else a special id
        for text in texts:
            parts = [-1]
            if special is None or "<|" not in text and not special.search(text):
                plain.append(text)
            else:
                end = 0
                for m in special.finditer(text):
                    plain.append(text[end : m.start()])
                    parts += [self.special[m[0]], -1]
                    end = m.end()
                plain.append(text[end:])
            layout.append(parts)
        coded: list[np.ndarray] = []
        for a, b in pt.slices([len(x) for x in plain], SLICE):
            done = self.common(plain[a:b])
            coded += [self.rare(plain[a + i]) if x is None else x for i, x in enumerate(done)]
        found = iter(coded)
        out = []
        for parts in layout:
            arrays = [next(found) if p < 0 else np.array([p], np.int32) for p in parts]
            out.append(arrays[0] if len(arrays) == 1 else np.concatenate(arrays))
        return out

    def strings(self) -> pa.Array:
        return pa.array([self.tokens.get(i) for i in range(max(self.tokens) + 1)], pa.string())

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The text of each list of ids, special tokens included."""
        if len(ids) and (ids.min() < 0 or ids.max() > max(self.tokens)):
            raise ValueError("an id is not in the vocabulary")
        names = self.strings().take(pa.array(ids))
        if names.null_count:
            raise ValueError("an id is not in the vocabulary")
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), names)
        if self.decoder is None:
            return pc.binary_join(lists, " ")
        if self.decoder != "ByteLevel":
            raise ValueError("this decoder is not known")
        joined = pc.binary_join(lists, "").to_pylist()
        return pa.array([bytes(self.byte_of[c] for c in t).decode("utf-8", "replace") for t in joined], pa.string())


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per Python worker and file."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text, or entries of each list; nulls are empty."""
    sizes = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
    return sizes.fill_null(0).to_numpy(zero_copy_only=False)


def add_column(df: DataFrame, name: str, kind: DataType, work: Callable[[pa.Array], pa.Array], source: str) -> DataFrame:
    """``df`` with a column computed from the column ``source``, in slices of bounded size."""
    at = df.columns.index(source)

    def slices(whole: pa.RecordBatch) -> Iterator[tuple[int, int, dict]]:
        column = whole.column(at)
        for begin, end in pt.slices(lengths(column).tolist(), SLICE):
            yield begin, end, {name: work(column.slice(begin, end - begin))}

    return batches_of(df, slices, {name: kind})


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each text as ``array<int>``."""

    def work(texts: pa.Array) -> pa.Array:
        found = vocabulary(path).encode([t or "" for t in texts.to_pylist()])
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))

    return add_column(df, ids, ArrayType(IntegerType()), work, text)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids, as the library's ``decode(ids, skip_special_tokens=False)``."""

    def work(lists: pa.Array) -> pa.Array:
        if lists.null_count:
            lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.int32()))
        until = np.concatenate(([0], np.cumsum(lengths(lists))))
        return vocabulary(path).decode(lists.flatten().to_numpy(), until)

    return add_column(df, decoded, StringType(), work, ids)
