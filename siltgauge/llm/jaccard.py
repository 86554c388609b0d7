"""Links between documents whose shingle sets are similar, by a blocked product of the incidence matrix.

1.  Documents with equal sets become one row of the matrix, whatever their number.
2.  Rows are put into blocks so that no link crosses two blocks that are not multiplied with each other.
    The threshold bounds how far two linked sets differ by their sizes. The shingles of a row are dealt
    into more parts than that, so two linked rows have a part in common with the same shingles in it.
    Of the rows that share a part, those may link whose narrow sketches, a bit a shingle, do not differ too
    much; most rows share a part by chance, and the more there are, the more of them. Rows that may link,
    directly or over others, form a cluster; a large cluster is cut into blocks, and every two blocks of it
    are multiplied.
3.  Sketches of the rows, a few bits a shingle, meet first. The shingles themselves go only to products in
    which their row may have a link.
4.  A product of blocks accumulates overlap counts over stripes of shingles. A pair of rows goes as soon
    as its overlap so far and what either row has left stay below the bound that the sizes give. Of the
    links found, a spanning forest of the block is put out, so a cluster of any size gives few rows.
5.  The forests are joined to components by union-find over the whole table.

No step lists the pairs of a group. What a cluster of m rows costs is (m / block) ** 2 tasks.
"""

from __future__ import annotations

import hashlib
import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, landed, whole_text
from .components import components
from .lines import fixed_filter, held_twice, parted, passing, wide_can_be_similar
from .words import mixed, shingles, word_hashes

#: A block holds about so many rows and shingles at most; more make a cluster several blocks.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 400_000
#: Shingles multiplied at a time.
STRIPE = 4096
#: Parts at least beyond those that differences can spoil, so that empty parts need not be compared.
SPARE = 2
#: Turns in which shared parts are looked for, each with so large a share of the parts: a shuffle takes that share of their disk.
TURNS = 4
#: Bits a hash in the sketch of a set: with so many, sets of similarity 0.7 differ in too many bits for 0.8.
WIDE = 4
#: Bits a hash in the narrow sketch, which tells sets of similarity 0.4 from those of 0.8; sets that share a part meet by it.
NARROW = 1
#: Sets that share a part are compared at once up to so many; more make several cells. Rows of cells a Python call has about.
CELL_ROWS, CALL_ROWS = 1024, 4096
#: Blocks whose sketches are compared at once, and bits of sketches unpacked at a time.
SKETCHED, TILE_BITS = 16, 1 << 23
#: Standard deviations by which the parts exceed the likely number of empty ones.
CERTAIN = 4.5


@cache
def _class_starts(percent: int) -> np.ndarray:
    """First size of every size class. Linked sets lie in the same or in neighbouring classes."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(100 * starts[-1] // percent + 1)
    return np.array(starts)


@cache
def _part_counts(size_class: int, percent: int) -> tuple[int, int]:
    """Elements in which two linked sets of the class can differ, and the parts their elements are dealt into.

    Beyond one part more than can be spoiled there are as many as are likely to be empty in the smallest
    set of the class, so that hardly any set needs keys for its empty parts, which many sets have in common.
    """
    starts = _class_starts(percent)
    largest, smallest = int(starts[size_class + 1]) - 1, int(starts[max(size_class - 1, 0)])
    differ = (100 - percent) * 2 * largest // (100 + percent)
    count = differ + 1 + SPARE
    while True:
        load = smallest / count
        empty = count * math.exp(-load)
        spread = math.sqrt(max(0.0, empty - count * (1 + load) * math.exp(-2 * load)))
        if count - differ - 1 >= empty + CERTAIN * spread:
            return differ, count
        count += 1 + count // 100


def parts(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the parts of a set, for pairs whose larger set is in its own or in the next size class.

    Two sets x and y with 100 * |x & y| >= percent * |x | y| differ in at most
    (100 - percent) * (|x| + |y|) / (100 + percent) elements. Of more filled parts than that one is equal
    in both. Only a set that has no more filled parts has keys for its empty ones, too.
    """
    starts = _class_starts(percent)
    own = int(np.searchsorted(starts, len(hashes), side="right")) - 1
    keys = []
    for size_class in (own, own + 1):
        differ, count = _part_counts(size_class, percent)
        if differ == 0:
            continue
        place = (hashes % np.uint64(count)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        sizes = np.bincount(place, minlength=count)
        filled = np.flatnonzero(sizes)
        sums = np.zeros(count, dtype=np.uint64)
        sums[filled] = np.add.reduceat(mixed(hashes[order]), (np.cumsum(sizes) - sizes)[filled])
        named = filled if len(filled) > differ else np.arange(count)
        keys.append(mixed(sums[named] + mixed(named.astype(np.uint64) + np.uint64(size_class << 32))))
    return np.concatenate(keys) if keys else np.empty(0, dtype=np.uint64)


def _set(text: str, length: int) -> np.ndarray:
    return shingles(word_hashes(text, folded=True), length)


def _key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketch(hashes: np.ndarray, wide: int = WIDE) -> bytes:
    """A bit wherever the set has hashes, of ``wide`` bits a hash or more: the next power of two, 64 at least."""
    width = max(64, 1 << (wide * len(hashes) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def open_rows(sketches: list[bytes], sizes: np.ndarray, chunk: np.ndarray, side: np.ndarray, cross: bool, percent: int) -> np.ndarray:
    """Row and chunk for every row that may link with a row of the chunk; what is left out does not link.

    Where the sketches of two sets differ, one has an element that the other has not, and linked sets differ in
    (100 - percent) / (100 + percent) of all their elements at most. Sketches of twice the width are folded.
    ``cross``: only pairs of rows from different sides count.
    """
    bits = [np.unpackbits(np.frombuffer(s, dtype=np.uint8)) for s in sketches]
    widths = np.array([len(b) for b in bits])
    by_size = np.argsort(sizes, kind="stable")
    found = [np.empty((0, 2), dtype=np.int64)]
    for width in np.unique(widths):
        rows = by_size[(widths[by_size] == width) | (widths[by_size] == 2 * width)]
        n, tile = sizes[rows].astype(np.float64), max(1, min(512, TILE_BITS // int(width)))

        def unpacked(some: np.ndarray, width: int = width) -> np.ndarray:
            return np.stack([bits[r] if len(bits[r]) == width else bits[r][:width] | bits[r][width:] for r in some]).astype(np.float32)

        for at in range(0, len(rows), tile):
            one = rows[at : at + tile]
            own, n_one = unpacked(one), n[at : at + tile]
            stop = int(np.searchsorted(percent * n, 100 * n_one[-1], side="right"))
            for to in range(at, stop, tile):
                two, n_two = rows[to : to + tile], n[to : to + tile]
                other = own if to == at else unpacked(two)
                apart = own.sum(axis=1)[:, None] + other.sum(axis=1)[None, :] - 2 * (own @ other.T)
                near = (100 + percent) * apart <= (100 - percent) * (n_one[:, None] + n_two[None, :])
                near &= percent * n_two[None, :] <= 100 * n_one[:, None]
                near &= (widths[one] == width)[:, None] | (widths[two] == width)[None, :]
                if to == at:
                    near = np.triu(near, 1)
                if cross:
                    near &= side[one][:, None] != side[two][None, :]
                x, y = np.nonzero(near)
                met = np.concatenate([np.stack([one[x], chunk[two[y]]], axis=1), np.stack([two[y], chunk[one[x]]], axis=1)])
                found.append(np.unique(met, axis=0))
    return np.unique(np.concatenate(found), axis=0)


def bridges(component: np.ndarray, sizes: np.ndarray, words: list[np.ndarray], side: np.ndarray, cross: bool, percent: int) -> list[tuple[int, int]]:
    """Pairs of rows that may link, by their narrow sketches ``words``: a forest that joins all components that
    such pairs join. Rows of one component are not compared.

    ``cross``: only pairs of rows from different sides count.
    """
    component = np.unique(component, return_inverse=True)[1]
    widths = np.array([len(w) for w in words])
    found = []
    for width in np.unique(widths):
        rows = np.flatnonzero((widths == width) | (widths == 2 * width))
        bits = np.stack([words[r] if widths[r] == width else words[r][:width] | words[r][width:] for r in rows])
        for at, one in enumerate(rows[:-1]):
            two = rows[at + 1 :]
            near = (component[two] != component[one]) & ((widths[two] == width) | (widths[one] == width))
            near &= 100 * np.minimum(sizes[two], sizes[one]) >= percent * np.maximum(sizes[two], sizes[one])
            if cross:
                near &= side[two] != side[one]
            near = np.flatnonzero(near)
            apart = np.bitwise_count(bits[at + 1 + near] ^ bits[at]).sum(axis=1, dtype=np.int64)
            two = two[near]
            for other in two[(100 + percent) * apart <= (100 - percent) * (sizes[two] + sizes[one])]:
                if component[other] != component[one]:
                    found.append((int(one), int(other)))
                    component[component == component[other]] = component[one]
    return found


ROW = T.StructType().add("key", T.BinaryType()).add("size", T.LongType()).add("sketch", T.BinaryType()).add("narrow", T.ArrayType(T.LongType()))
for _turn in range(TURNS):
    ROW = ROW.add(f"parts_{_turn}", T.ArrayType(T.LongType()))


def _matrix_rows(length: int, percent: int):
    @F.pandas_udf(ROW)
    def rows(texts: pd.Series) -> pd.DataFrame:
        sets = [_set(t, length) for t in texts]
        keys = [parts(s, percent) if len(s) else np.empty(0, np.uint64) for s in sets]
        # Parts are hashes, so equal ranges of them are equal shares.
        turns = [(k >> np.uint64(32)) * np.uint64(TURNS) >> np.uint64(32) for k in keys]
        dealt = {f"parts_{n}": [k[t == n].view(np.int64) for k, t in zip(keys, turns, strict=True)] for n in range(TURNS)}
        narrow = [np.frombuffer(sketch(s, NARROW) if len(s) else b"", dtype=np.int64) for s in sets]
        wide = [sketch(s) if len(s) else b"" for s in sets]
        return pd.DataFrame({"key": list(map(_key, sets)), "size": list(map(len, sets)), "sketch": wide, "narrow": narrow, **dealt})

    return rows


def _hashes(length: int):
    @F.pandas_udf(T.StructType().add("key", T.BinaryType()).add("hashes", T.ArrayType(T.LongType())))
    def rows(texts: pd.Series) -> pd.DataFrame:
        sets = [_set(t, length) for t in texts]
        return pd.DataFrame({"key": list(map(_key, sets)), "hashes": [s.view(np.int64) for s in sets]})

    return rows


def linked(sets: list[np.ndarray], side: np.ndarray, cross: bool, percent: int) -> np.ndarray:
    """For every row the first row of its component under the links of this block product.

    ``cross``: only pairs of rows from different sides are multiplied.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes.astype(np.int64))
    shared = uses[column] > 1
    row, column = row[shared], column[shared]
    # An overlap o links if 100 * o >= percent * (|x| + |y| - o).
    need = np.ceil(percent * (sizes[:, None] + sizes[None, :]) / (100 + percent) - 1e-9)
    open_pairs = np.triu(np.ones((n, n), dtype=bool), 1) & (need <= np.minimum.outer(sizes, sizes))
    if cross:
        open_pairs &= side[:, None] != side[None, :]
    order = np.argsort(column, kind="stable")
    row, column = row[order], np.cumsum(np.concatenate(([0], np.diff(column[order]) != 0))) if len(order) else column
    overlap = np.zeros((n, n), dtype=np.float32)
    left = np.bincount(row, minlength=n).astype(np.float64)
    at = 0
    while at < len(row) and open_pairs.any():
        stop = int(np.searchsorted(column, column[at] + STRIPE))
        stripe = np.zeros((n, STRIPE), dtype=np.float32)
        stripe[row[at:stop], column[at:stop] - column[at]] = 1
        alive = np.flatnonzero(open_pairs.any(axis=0) | open_pairs.any(axis=1))
        overlap[np.ix_(alive, alive)] += stripe[alive] @ stripe[alive].T
        left -= np.bincount(row[at:stop], minlength=n)
        open_pairs &= overlap + np.minimum.outer(left, left) >= need
        at = stop
    first = np.arange(n)
    links = np.argwhere(open_pairs & (overlap >= need))
    for x, y in links:
        while first[x] != x:
            x = first[x]
        while first[y] != y:
            y = first[y]
        first[max(x, y)] = min(x, y)
    for x in range(n):
        first[x] = first[first[x]]
    return first


def _open(percent: int):
    def rows(block: pd.DataFrame) -> pd.DataFrame:
        cross = bool(block["low"].iloc[0] != block["high"].iloc[0])
        chunk = block["chunk"].to_numpy()
        found = open_rows(list(block["sketch"]), block["size"].to_numpy(), chunk, chunk // SKETCHED, cross, percent)
        row, other = found[:, 0], found[:, 1]
        out = block.iloc[row][["key", "cluster", "chunk"]]
        return out.assign(low=np.minimum(chunk[row], other), high=np.maximum(chunk[row], other))

    return rows


def _bridges(percent: int):
    def rows(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values(["part", "low", "high"])
        place = cells[["part", "low", "high"]].to_numpy()
        borders = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]).any(axis=1), [True])))
        node, component, size, chunk, words = (cells[c].to_numpy() for c in ("node", "component", "size", "chunk", "narrow"))
        out = []
        for start, stop in zip(borders[:-1], borders[1:], strict=True):
            cross = bool(place[start, 1] != place[start, 2])
            own = slice(start, stop)
            found = bridges(component[own], size[own], list(words[own]), chunk[own], cross, percent)
            out += [(node[start + x], node[start + y]) for x, y in found]
        return pd.DataFrame(out, columns=["hub", "node"], dtype=np.int64)

    return rows


def _forest(percent: int):
    def forest(block: pd.DataFrame) -> pd.DataFrame:
        sets = [np.asarray(h, dtype=np.int64).view(np.uint64) for h in block["hashes"]]
        cross = bool(block["low"].iloc[0] != block["high"].iloc[0])
        first = linked(sets, block["chunk"].to_numpy(), cross, percent)
        keys = block["key"].to_numpy()
        rest = np.flatnonzero(first != np.arange(len(first)))
        return pd.DataFrame({"a": keys[first[rest]], "b": keys[rest]}, columns=["a", "b"])

    return forest


def shared_parts(signed: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """hub, node: every node of ``signed`` (node and the parts by turns) with the smallest nodes it shares parts with;
    and by turns part, node of the parts that three nodes have, or more."""
    found, larger = [], []
    for turn in range(TURNS):
        some = signed.select("node", F.explode(f"parts_{turn}").alias("part"))
        # Copies of a set repeat its node; they are one row from here on.
        twice = held_twice(some, "part")
        shared = landed(twice.distinct(), "shared")
        discard(twice)
        met = shared.groupBy("part").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
        near = shared.join(met, "part").where("hub != node")
        found.append(landed(near.select("hub", "node").distinct(), "near"))
        larger.append(landed(shared.join(met.where("_n > 2").select("part"), "part").select("part", "node"), "larger"))
        discard(shared)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs, larger


def may_link(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs hub, node whose sets (node, size, narrow) may link by their sizes and narrow sketches."""

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("size").alias(f"_n_{name}"), F.col("narrow").alias(f"_bits_{name}"))

    both = pairs.distinct().join(side("hub"), "hub").join(side("node"), "node")
    n_hub, n_node = F.col("_n_hub"), F.col("_n_node")
    near = 100 * F.least(n_hub, n_node) >= percent * F.greatest(n_hub, n_node)
    return both.where(near & wide_can_be_similar(n_hub, F.col("_bits_hub"), n_node, F.col("_bits_node"), percent)).select("hub", "node")


def bridged(larger: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """hub, node, landed: pairs of sets that share a part and may link, which join all components that such pairs join.

    ``larger``: part, node; ``labels``: node, component, of all nodes that are not components of their own.
    The sets of the largest component of a part do not meet each other, so they are not repeated for that.
    """
    named = larger.join(labels, "node", "left").select("part", "node", F.coalesce("component", "node").alias("component"))
    held = named.groupBy("part", "component").agg(F.count(F.lit(1)).alias("_n"))
    shape = held.groupBy("part").agg(F.max(F.struct("_n", "component")).alias("_main"), F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_several"))
    shape = landed(shape.where("_several > 1").select("part", F.col("_main.component").alias("_main"), F.col("_main._n").alias("_n_main"), "_all"), "shape")
    rest, main = (F.ceil(n / CELL_ROWS).cast("int") for n in (F.col("_all") - F.col("_n_main"), F.col("_n_main")))
    one, is_main = F.col("_all") <= CELL_ROWS, F.col("component") == F.col("_main")
    drawn = F.xxhash64("node", F.lit(1))
    # The cells of the other components come first.
    chunk = F.when(one, 0).when(is_main, rest + F.pmod(drawn, main)).otherwise(F.pmod(drawn, rest)).cast("int")
    last = F.when(one, 0).when(is_main, rest - 1).otherwise(rest + main - 1)
    placed = named.join(shape, "part").select("part", "node", "component", chunk.alias("chunk"), last.alias("_last"))
    placed = landed(placed.select("part", "node", "component", "chunk", F.explode(F.sequence(F.lit(0), F.col("_last"))).alias("_other")), "placed")
    cells = placed.join(sets.select("node", "size", "narrow"), "node")
    cells = cells.select("part", "node", "component", "chunk", "size", "narrow", F.least("chunk", "_other").alias("low"), F.greatest("chunk", "_other").alias("high"))
    calls = max(1, placed.count() // CALL_ROWS)
    cells = cells.withColumn("_call", F.pmod(F.xxhash64("part", "low", "high"), F.lit(calls)))
    found = landed(cells.groupBy("_call").applyInPandas(_bridges(percent), "hub long, node long"), "bridges")
    for done in (shape, placed):
        discard(done)
    return found


def candidates(pairs: DataFrame, larger: list[DataFrame], sets: DataFrame, percent: int) -> DataFrame:
    """node, component: the sets that may link with others, with components in which every link lies.

    ``pairs``, ``larger``: what sets share parts, see :func:`shared_parts`.
    """
    links = landed(may_link(pairs, sets, percent), "may-link")
    labels = components(links, "hub", "node")
    for groups in larger:
        more = bridged(groups, labels, sets, percent)
        discard(groups)
        links = links.unionByName(more)
    discard(labels)
    labels = components(links, "hub", "node")
    discard(links)
    return labels


def hashed_texts(named: DataFrame, ids: DataFrame, length: int) -> DataFrame:
    """key, hashes of the texts of ``named`` (doc_id, text) whose id is one of ``ids`` (_id).

    A filter of fixed size goes first: of the other texts hardly any is shuffled, and none is hashed.
    """
    known = landed(fixed_filter(ids.select(F.xxhash64("_id").alias("_ref")), "_ref"), "asked")
    near = passing(named.withColumn("_ref", F.xxhash64("doc_id")), "_ref", known).drop("_ref")
    sets = near.join(ids, F.col("doc_id").eqNullSafe(F.col("_id"))).select(_hashes(length)("text").alias("h"))
    # A key that may be NULL makes a join ask for those that are not, below the other join, of every text.
    return sets.select(F.coalesce("h.key", F.lit(b"")).alias("key"), "h.hashes")


def link_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 3, percent: int = 90
) -> DataFrame:
    """doc_id, n_shingles, component_id: the components of documents under links of similar shingle sets.

    Shingles are ``length`` lower-cased (A-Z) words; shorter texts are one shingle as a whole. Two
    documents link if 100 * intersection >= percent * union; component_id is the smallest id reachable.
    A document without words (NULL, empty) links with nothing and is its own component. Repeated rows give
    one row; the texts of one id are in one component, with a row per set size; rows without id take part
    in links, and their component_id is NULL if no document of the component has an id. An empty table
    gives an empty one. Other columns do not matter.
    """
    text = whole_text(text_col)
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    signed = landed(named.select("doc_id", _matrix_rows(length, percent)("text").alias("m")).select("doc_id", "m.*"), "signed")

    # Nodes of the candidate graph are 64 bits of the key: a clash only joins clusters. The parts, which take
    # more disk than the texts, are held once and go as soon as it is known which are shared.
    met, larger = shared_parts(signed.withColumn("node", F.xxhash64("key")))
    # One row per set. Nothing else holds a sketch.
    sets = signed.where("size > 0").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.max(F.col("doc_id").isNull()).alias("nameless"), *[F.any_value(c).alias(c) for c in ("size", "sketch", "narrow")]
    )
    sets = landed(sets.withColumn("node", F.xxhash64("key")), "sets")
    rows = landed(signed.select("doc_id", "key", "size"), "rows")
    discard(signed)
    near = candidates(met, larger, sets, percent)

    filled = rows.where("size > 0")
    clustered = landed(sets.join(near, "node").withColumnRenamed("component", "cluster"), "clustered")
    shape = clustered.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("chunks")
    )
    chunk = F.pmod(F.xxhash64("key", F.lit(1)), F.col("chunks")).cast("int").alias("chunk")
    wanted = landed(clustered.join(landed(shape, "shape"), "cluster").select("rep", "key", "size", "sketch", "cluster", "chunks", chunk), "wanted")
    own = F.floor(F.col("chunk") / SKETCHED).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.floor((F.col("chunks") - 1) / SKETCHED).cast("int"))).alias("other")
    pairs = wanted.select("key", "size", "sketch", "cluster", "chunk", own.alias("own"), other)
    blocks = pairs.select("*", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).drop("own", "other")
    place = "key binary, cluster long, chunk int, low int, high int"
    left = landed(blocks.groupBy("cluster", "low", "high").applyInPandas(_open(percent), place), "open")

    # Only texts of sets that may link are read again; a text is known by its set, as ids may repeat.
    ids = landed(wanted.join(left, "key", "left_semi").select(F.col("rep").alias("_id")).distinct(), "ids")
    members = hashed_texts(named, ids, length).join(left, "key")
    found = members.groupBy("cluster", "low", "high").applyInPandas(_forest(percent), "a binary, b binary")

    # An id with several texts joins their sets.
    several = filled.where("doc_id is not null").groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("_b"))
    several = several.where("a != _b").select("doc_id", "a")
    same_id = filled.join(landed(several, "several"), "doc_id").select("a", F.col("key").alias("b"))
    labels = components(landed(found, "links").unionByName(same_id))

    owner = sets.select("key", "rep").join(labels.withColumnRenamed("node", "key"), "key", "left")
    owner = landed(owner.select("key", "rep", F.coalesce("component", "key").alias("component")), "owner")
    least = landed(owner.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
    owner = landed(owner.join(least, "component").select("key", "component_id"), "owner")
    placed = rows.select("doc_id", "key", "size").join(owner, "key", "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    for done in (met, near, sets, clustered, wanted, left):
        discard(done)
    return placed.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id")).distinct()


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with their columns; repeated rows once.

    Documents without words stay. Rows without id stay where no document of their component has one.
    """
    linked_docs = link_documents(docs, id_col=id_col, text_col=text_col, length=length, percent=percent)
    linked_docs = landed(linked_docs.select("doc_id", "component_id"), "linked")
    whole = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = landed(linked_docs.where(whole).select(F.col("doc_id").alias("_kept")).distinct(), "first")
    # A row of an id that no other row has and that stays is not shuffled; the others may be some of few.
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    asked = ids.where("_n > 1").select("doc_id").unionByName(linked_docs.where(~whole).select("doc_id"))
    asked = landed(fixed_filter(asked.select(F.xxhash64("doc_id").alias("_ref")), "_ref"), "asked")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    some, others = parted(docs.select(row, F.xxhash64(f"`{id_col}`").alias("_ref")), "_ref", asked)
    kept = some.select("_row.*").join(first, F.col(f"`{id_col}`").eqNullSafe(F.col("_kept")), "left_semi")
    discard(linked_docs)
    return others.select("_row.*").unionByName(kept.dropDuplicates([id_col, text_col]))
