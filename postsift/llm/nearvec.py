"""Near-duplicate vectors by spherical-cap filters from a structured random product code.

1. Equal vectors with the same label are one class. A class's vector is scaled to length one and turned by a fixed random rotation.
2. Its components are cut into ``PARTS`` parts; each part has a small code book of random directions. A filter is one direction of
   each book, so few directions make very many filters. A vector is decoded to the list of all filters whose direction
   it exceeds a bound with: part by part, keeping what can still reach the bound with the best of the parts to come.
3. The bound is set so that a vector falls into ``LISTED`` filters on average, and a filter holds about ``HELD`` vectors of the most
   frequent label; a vector in a sparse region, with fewer filters than that, has its bound lowered until it has as many.
   Vectors of cosine 0.98 share most of their filters.
4. Classes that share label and filter are compared exactly, in double precision. Filters are dealt into cells; a filter with more than
   ``TILE`` classes is cut into tiles, and each pair of tiles is a task. A pair that shares several filters is
   counted in the first of them. What comes back are numbers of links and a spanning forest, never all pairs.

Recall depends on chance: a pair is missed if it shares no filter. Tests measure it on pairs at a cosine of exactly 0.98 and
assert 0.99. No link below the bound is ever reported. Numbers and sizes of books follow from the counted rows alone.

Defined results: vectors that are null, empty, of zero length, or that hold nulls or non-finite components, and rows with a null label or
id, link with nothing and are their own component. Vectors of different lengths do not link. Rows that repeat an id are
vectors of their own; each copy counts as a link of the others. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.common import Scratch
from postsift.llm.components import connected
from postsift.llm.ngramjoin import forest

#: Parts of a vector; filters that a vector is expected to fall into; vectors of one label that a filter is expected to hold.
PARTS, LISTED, HELD = 2, 16, 0.5
#: Classes of a filter compared in one task; memberships in a cell; vectors decoded at a time.
TILE, CELL, DECODED = 1024, 4096, 2048


def cap_bound(share: float, dims: int) -> float:
    """Cosine that a random direction exceeds with the given probability."""
    x = np.linspace(-1, 1, 400_001)
    density = np.maximum(0, 1 - x * x) ** ((max(dims, 3) - 3) / 2)
    above = np.cumsum(density[::-1])[::-1]
    return float(x[np.searchsorted(-above / above[0], -share)])


def cap_share(bound: float, dims: int) -> float:
    """Probability that a random direction has at least this cosine with a given one."""
    x = np.linspace(-1, 1, 400_001)
    density = np.maximum(0, 1 - x * x) ** ((max(dims, 3) - 3) / 2)
    return float(density[x >= bound].sum() / density.sum())


@cache
def code(dims: int, largest: int, cosine: float, seed: int = 42) -> tuple[np.ndarray, list[np.ndarray], float]:
    """Rotation, code book of each part, and the bound, for ``largest`` vectors of one label and links of that cosine.

    In few dimensions, caps that hold few vectors are too narrow for two vectors at that cosine; caps are at least twice as
    wide as their angle, and the code is not cut into parts of less than eight components.
    """
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    share = max(HELD / max(largest, 1), cap_share(2 * cosine * cosine - 1, dims))
    share = min(0.02, share) if dims >= 16 else share
    parts = np.array_split(np.arange(dims), max(1, min(PARTS, dims // 8)))
    size = max(2, math.ceil((LISTED / share) ** (1 / len(parts))))
    books = []
    for p in parts:
        book = rng.standard_normal((size, len(p)))
        books.append(book / np.linalg.norm(book, axis=1, keepdims=True) * math.sqrt(len(p) / dims))
    # The books hold a power of an integer of filters; the bound is set for the number that there really are.
    return rotation, books, cap_bound(min(0.5, LISTED / float(size) ** len(parts)), dims)


def decode(vectors: np.ndarray, largest: int, cosine: float = 0.98) -> list[np.ndarray]:
    """The sorted filters of each vector (of length one)."""
    n, dims = vectors.shape
    rotation, books, bound = code(dims, largest, cosine)
    turned = vectors @ rotation
    cuts = np.cumsum([b.shape[1] for b in books])[:-1]
    products = [x @ b.T for x, b in zip(np.split(turned, cuts, axis=1), books)]
    order = [np.argsort(-p, axis=1) for p in products]
    falling = [np.take_along_axis(p, o, 1) for p, o in zip(products, order)]
    rest = np.cumsum([f[:, 0] for f in falling][::-1], axis=0)[::-1]  # the best that this part and later ones add
    rest = np.vstack([rest, np.zeros((1, n))])
    best = np.zeros((n, 1))  # the highest sums that any filters have
    for f in falling:
        best = -np.sort(-(best[:, :, None] + f[:, None, :LISTED]).reshape(n, -1), axis=1)[:, :LISTED]
    bound = np.minimum(bound, best[:, -1] - 1e-9)
    owner, sums, filters = np.arange(n), np.zeros(n), np.zeros(n, np.int64)
    for k, (f, o) in enumerate(zip(falling, order)):
        grown: list[tuple[np.ndarray, ...]] = []
        for a in range(0, len(owner), 1 << 16):
            w, s, c = owner[a : a + (1 << 16)], sums[a : a + (1 << 16)], filters[a : a + (1 << 16)]
            need = bound[w] - s - rest[k + 1, w]
            fits = (f[w] >= need[:, None]).sum(1)
            again = np.repeat(np.arange(len(w)), fits)
            place = np.arange(len(again)) - np.repeat(np.cumsum(fits) - fits, fits)
            who = w[again]
            grown.append((who, s[again] + f[who, place], c[again] * f.shape[1] + o[who, place]))
        owner, sums, filters = (np.concatenate(x) for x in zip(*grown))
    by = np.lexsort((filters, owner))
    return np.split(filters[by], np.searchsorted(owner[by], np.arange(1, n)))


def unit(vectors: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    x = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # very large or small components must not overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def with_filters(classes: DataFrame, largest: int, cosine: float) -> DataFrame:
    """cid, filters: of the classes with columns cid, vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, DECODED):
                b = whole.slice(begin, DECODED)
                dims = b.column(1).value_lengths().to_numpy()
                for d in np.unique(dims):
                    chosen = np.flatnonzero(dims == d)
                    found = decode(unit(b.column(1).take(pa.array(chosen))), largest, cosine)
                    offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in found]))), pa.int32())
                    lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found)))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(chosen)), lists], names=["cid", "filters"])

    return classes.select("cid", "vector").mapInArrow(run, "cid long, filters array<long>")


def linked_in_filter(x: np.ndarray, lists: list[np.ndarray], own: int, tile: np.ndarray | None, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Links among classes that share the filter ``own``: all of them, and those not counted in an earlier shared filter.

    Only pairs of different tiles count if tiles are given.
    """
    linked = x @ x.T >= bound
    np.fill_diagonal(linked, False)
    if tile is not None:
        linked &= tile[:, None] != tile[None, :]
    if not linked.any():
        return linked, linked
    flat, owner = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(f) for f in lists])
    earlier = flat < own
    names, column = np.unique(flat[earlier], return_inverse=True)
    before = np.zeros((len(lists), len(names)), np.float32)
    before[owner[earlier], column] = 1
    return linked, linked & (before @ before.T == 0)


def cell_links(table: pa.Table, bound: float) -> pa.Table:
    """n links of class a (b null), and links a-b of a spanning forest (n zero), from the filters of one cell."""
    out: tuple[list, list, list] = ([], [], [])
    table = table.combine_chunks()
    keys = np.stack([table[c].to_numpy() for c in ("dims", "label_key", "filter")])
    order = np.lexsort(keys)
    keys = keys[:, order]
    first = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
    ids, weight = table["cid"].to_numpy()[order], table["copies"].to_numpy()[order]
    within = table["i"][0].as_py() == table["j"][0].as_py()
    tile = table["tile"].to_numpy()[order]
    lists = table["filters"].combine_chunks().take(pa.array(order))
    vectors = table["vector"].combine_chunks().take(pa.array(order))
    for begin, end in zip(first, np.append(first[1:], len(order))):
        if end - begin < 2:
            continue
        n = int(end - begin)
        own = [np.asarray(f) for f in np.split(lists.slice(begin, n).flatten().to_numpy(), np.cumsum(lists.slice(begin, n).value_lengths().to_numpy())[:-1])]
        linked, new = linked_in_filter(unit(vectors.slice(begin, n)), own, int(keys[2, begin]), None if within else tile[begin:end], bound)
        if not linked.any():
            continue
        id_, links = ids[begin:end], new @ weight[begin:end]
        some = np.flatnonzero(links)
        root = forest(linked)
        joined = np.flatnonzero(root != np.arange(n))
        out[0].extend([*id_[some].tolist(), *id_[joined].tolist()])
        out[1].extend([*[None] * len(some), *id_[root[joined]].tolist()])
        out[2].extend([*links[some].tolist(), *[0] * len(joined)])
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip("abn", out)})


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", bound: float = 0.98) -> DataFrame:
    """id, n_links, component_id, kept: for each vector, the others of its label with at least that cosine, and the smallest id
    that links reach."""
    scratch = Scratch(df.sparkSession, "nearvec")
    v, lab = F.col("vector"), F.col("label")
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").alias("label"))
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    takes_part = F.coalesce(sound & F.exists(v, lambda x: x != 0) & lab.isNotNull() & F.col("id").isNotNull(), F.lit(False))
    keys = [F.when(takes_part, k).alias(n) for n, k in (("k1", F.xxhash64("label", "vector")), ("k2", F.xxhash64(F.lit("again"), "vector", "label")))]
    rows = rows.select("id", "vector", "label", *keys)

    classes = rows.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"), F.first("label").alias("label")
    )
    classes = classes.withColumns({"cid": F.monotonically_increasing_id(), "label_key": F.xxhash64("label"), "dims": F.size("vector").cast("long")})
    classes = scratch.written(classes, "classes", waves=2)
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0

    listed = scratch.written(with_filters(classes, largest, bound), "filters", waves=8)
    member = listed.select("cid", F.explode("filters").alias("filter")).join(classes.select("cid", "label_key", "dims"), "cid")
    held = member.groupBy("label_key", "dims", "filter").agg(F.count("*").alias("n")).where("n > 1")
    cells = max(1, math.ceil(listed.agg(F.sum(F.size("filters"))).first()[0] / CELL)) if largest else 1
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    held = held.select("label_key", "dims", "filter", tiles.alias("tiles"))
    member = member.join(held, ["label_key", "dims", "filter"])
    member = member.withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("tiles")).cast("int"))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    alone = F.when(F.col("tiles") > 1, F.col("filter"))  # a filter of several tiles has its cell to itself
    member = member.select(
        "cid",
        "filter",
        "tile",
        F.least("tile", "other").alias("i"),
        F.greatest("tile", "other").alias("j"),
        F.pmod(F.xxhash64("label_key", "dims", "filter"), F.lit(cells)).alias("cell"),
        alone.alias("alone"),
    )
    full = member.join(classes.select("cid", "label_key", "dims", "copies", "vector").join(listed, "cid"), "cid")
    found = full.groupBy("cell", "alone", "i", "j").applyInArrow(lambda t: cell_links(t, bound), "a long, b long, n long")
    found = scratch.written(found, "links", waves=2)
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "cid")
    roots = connected(found.where("b is not null").select("a", "b"), scratch).withColumnRenamed("node", "cid")

    named = classes.select("k1", "k2", "cid", "least", "copies").join(links, "cid", "left").join(roots, "cid", "left")
    named = named.withColumn("root", F.coalesce("root", "cid"))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    named = named.select("k1", "k2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    done = rows.drop("vector", "label").join(scratch.written(named, "named", waves=2), ["k1", "k2"], "left")
    component = F.coalesce("component_id", "id")
    return done.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
