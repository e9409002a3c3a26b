"""Merkle manifest of a table: a tree of SHA-256 midstates.

Each row is a leaf; leaves of one group form a tree, the groups' roots form the tree above. A parent is the SHA-256 of its
children's hex digests. As a hex digest fills one block of SHA-256 exactly, the hash state before each child's slot is eight
words, and these copies are retained with the nodes. A replaced leaf is folded by resuming its parent's state at its slot with
the new digest and then the siblings to its right only; left siblings are in the state already.

The states are plain bytes, so they travel in tables: a tree is built in rounds over cells of at most ``fan ** LEVELS``
neighbouring nodes, each round a written table 256 times smaller than the last, then the way to the root is handed down, cell
by cell, until every leaf has its proof. No task holds more than whole cells of a batch, and a group of any size is many cells.

Nulls and ties: a null group is a group of its own, before all others; rows without an id come first; rows of one id are
ordered by their leaf, so equal rows are interchangeable and the root does not depend on how the table was partitioned.
An empty table gives no rows. Rows of an empty proof (one leaf in all) have an empty text as proof.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.llm.cells import complete_groups
from wardmill.llm.shared import stored

FAN = 2
#: Levels that one round climbs: cells of 256 nodes at a fan of two.
LEVELS = 8


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle ** 3 <= x else (low, middle - 1)
    return low


_START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], dtype=np.uint32)[:, None]
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], dtype=np.uint32)


def _turn(x: np.ndarray, k: int) -> np.ndarray:
    return (x >> np.uint32(k)) | (x << np.uint32(32 - k))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """SHA-256 states of shape (8, n) after one block of 16 words each."""
    a, b, c, d, e, f, g, h = state
    w = list(block)
    for i in range(64):
        if i >= 16:
            x, y = w[(i + 1) % 16], w[(i + 14) % 16]
            w[i % 16] = (w[i % 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[(i + 9) % 16]
                         + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[i] + w[i % 16]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + one, c, b, a, one + two
    return np.stack([a, b, c, d, e, f, g, h]) + state


def hex_block(digests: np.ndarray) -> np.ndarray:
    """The one block that a digest's hex text is: (8, n) words to (16, n)."""
    halves = np.stack([digests >> np.uint32(16), digests & np.uint32(0xFFFF)], axis=1).reshape(16, -1)
    spread = ((halves & np.uint32(0xF000)) << np.uint32(12) | (halves & np.uint32(0x0F00)) << np.uint32(8)
              | (halves & np.uint32(0x00F0)) << np.uint32(4) | halves & np.uint32(0x000F))
    letters = ((spread + np.uint32(0x06060606)) >> np.uint32(4)) & np.uint32(0x01010101)
    return spread + np.uint32(0x30303030) + letters * np.uint32(ord("a") - ord("0") - 10)


def _last_block(children: np.ndarray) -> np.ndarray:
    """Padding after so many whole blocks."""
    out = np.zeros((16, len(children)), dtype=np.uint32)
    out[0], out[15] = 0x80000000, children.astype(np.uint32) * np.uint32(512)
    return out


def _words(packed: np.ndarray) -> np.ndarray:
    """(n, 32) bytes to (8, n) words."""
    return np.ascontiguousarray(packed).view(">u4").astype(np.uint32).reshape(-1, 8).T.copy()


def _bytes(words: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(words.T.astype(">u4")).view(np.uint8).reshape(-1, 32)


def _climbed(digests: np.ndarray, local: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the nodes of one level, sorted by cell and place in it: the state before each, its parent's number, the parents' digests."""
    slot = local % fan
    parent = np.cumsum(slot == 0) - 1
    state = np.repeat(_START, int(parent[-1]) + 1, axis=1)
    before = np.empty_like(digests)
    for s in range(fan):
        at = np.flatnonzero(slot == s)
        if len(at):
            before[:, at] = state[:, parent[at]]
            state[:, parent[at]] = compress(before[:, at], hex_block(digests[:, at]))
    return before, parent, compress(state, _last_block(np.bincount(parent)))


def _resumed(value: np.ndarray, before: np.ndarray, right: list[tuple[np.ndarray, np.ndarray]], children: np.ndarray) -> np.ndarray:
    """Parents' digests with ``value`` in place of a child; ``right``: lanes that have another sibling, and its digest."""
    state = compress(before, hex_block(value))
    for lanes, digests in right:
        if len(lanes):
            state[:, lanes] = compress(state[:, lanes], hex_block(digests))
    return compress(state, _last_block(children))


def _height(n: np.ndarray, fan: int) -> np.ndarray:
    left, out = n.copy(), np.zeros(len(n), dtype=np.int64)
    while (left > 1).any():
        out += left > 1
        left = -(-left // fan)
    return out


class _Cells:
    """Some whole cells: their nodes, and the way from each cell's top to the root where it is known."""

    def __init__(self, table: pa.Table, bounds: np.ndarray, fan: int, levels: int, base: int):
        self.fan = fan
        cell = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        is_way = np.asarray(table.column("tag")) == 0
        self.nodes = table.filter(pa.array(~is_way))
        self.ways = table.filter(pa.array(is_way))
        self.way_of = np.full(len(bounds) - 1, -1)
        self.way_of[cell[is_way]] = np.arange(int(is_way.sum()))
        self.cell = cell[~is_way]
        self.pos = self.nodes.column("pos").to_numpy()
        self.digests = self.unpacked(self.nodes.column("digest"))
        n = self.nodes.column("n").to_numpy()
        self.rise = np.zeros(len(bounds) - 1, dtype=np.int64)
        self.rise[self.cell] = np.clip(_height(n, fan) - base, 0, levels)

    @staticmethod
    def unpacked(column: pa.ChunkedArray) -> np.ndarray:
        return _words(np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, 32))

    def climb(self, size: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Level by level: cells, digests, states before, and numbers of the parents; at last the tops."""
        cell, local, digests = self.cell, self.pos % size, self.digests
        for level in range(int(self.rise.max(initial=0))):
            before, parent, parents = _climbed(digests, local, self.fan)
            first = np.flatnonzero(local % self.fan == 0)
            done = self.rise[cell[first]] <= level
            parents[:, done] = digests[:, first[done]]
            yield cell, local, digests, before, parent
            cell, local, digests = cell[first], local[first] // self.fan, parents
        yield cell, local, digests, None, None

    def siblings(self, at: np.ndarray, local: np.ndarray, parent: np.ndarray, total: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Numbers of the siblings of the nodes ``at`` from left to right (-1: none), how many are to the left, and the run's size."""
        left = local[at] % self.fan
        run = np.bincount(parent, minlength=total)[parent[at]]
        places = []
        for j in range(self.fan - 1):
            place = at - left + j + (j >= left)
            places.append(np.where(j < run - 1, place, -1))
        return places, left, run


def _record(fan: int) -> int:
    return 2 + 32 * fan


def _rounds(mode: str, fan: int, levels: int, base: int):
    """Arrow function over sorted cells: ``up`` gives the tops, ``ways`` the nodes' ways to the root, ``fold`` the leaves' results."""
    size, step = fan ** levels, _record(fan)

    def ways_of(cells: _Cells) -> tuple[np.ndarray, np.ndarray]:
        """Records of the ways above the cells, (cells, levels, record), and how many levels each has."""
        texts = [b"" if i < 0 else cells.ways.column("way")[i].as_py() for i in cells.way_of.tolist()]
        depth = np.array([len(x) // step for x in texts], dtype=np.int64)
        room = int(depth.max(initial=0)) * step
        packed = np.frombuffer(b"".join(x.ljust(room, b"\0") for x in texts), dtype=np.uint8)
        return packed.reshape(len(texts), -1, step) if room else np.zeros((len(texts), 0, step), np.uint8), depth

    def up(cells: _Cells) -> pa.RecordBatch:
        *_, (cell, _, digests, _, _) = cells.climb(size)
        first = np.searchsorted(cells.cell, cell)
        return pa.RecordBatch.from_arrays([
            cells.nodes.column("grp").take(pa.array(first)).combine_chunks(), pa.array(cells.pos[first] // size),
            cells.nodes.column("n").take(pa.array(first)).combine_chunks(), pa.array([x.tobytes() for x in _bytes(digests)], pa.binary()),
        ], names=["grp", "pos", "n", "digest"])

    def ways(cells: _Cells) -> pa.RecordBatch:
        total = len(cells.pos)
        at, found = np.arange(total), [[] for _ in range(total)]
        for level, (cell, local, digests, before, parent) in enumerate(cells.climb(size)):
            if before is None:
                break
            places, left, run = cells.siblings(at, local, parent, total)
            records = np.zeros((total, step), dtype=np.uint8)
            records[:, 0], records[:, 1] = left, run - 1 - left
            records[:, 2:34] = _bytes(before[:, at])
            for j, place in enumerate(places):
                has = place >= 0
                records[has, 34 + 32 * j:66 + 32 * j] = _bytes(digests[:, place[has]])
            for i in np.flatnonzero(cells.rise[cells.cell] > level):
                found[i].append(records[i].tobytes())
            at = parent[at]
        above = [cells.ways.column("way")[i].as_py() for i in cells.way_of.tolist()]
        of = pa.array(cells.way_of[cells.cell])
        return pa.RecordBatch.from_arrays([
            cells.nodes.column("grp").combine_chunks(), pa.array(cells.pos), cells.nodes.column("digest").combine_chunks(),
            pa.array([b"".join(x) + above[c] for x, c in zip(found, cells.cell.tolist(), strict=True)], pa.binary()),
            cells.ways.column("root").take(of).combine_chunks(), cells.ways.column("subroot").take(of).combine_chunks(),
        ], names=["grp", "pos", "digest", "way", "root", "subroot"])

    def fold(cells: _Cells) -> pa.RecordBatch:
        total = len(cells.pos)
        packed = [r or d for r, d in zip(cells.nodes.column("replaced").to_pylist(), cells.nodes.column("digest").to_pylist(), strict=True)]
        value = _words(np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(-1, 32))
        at, shown, kept = np.arange(total), [], []

        def show(digests: np.ndarray, lanes: np.ndarray) -> None:
            text, there = np.zeros((total, 64), dtype=np.uint8), np.zeros(total, dtype=bool)
            text[lanes] = hex_block(digests).T.astype(">u4").view(np.uint8).reshape(-1, 64)
            there[lanes] = True
            shown.append(text)
            kept.append(there)

        for level, (_, local, digests, before, parent) in enumerate(cells.climb(size)):
            if before is None:
                break
            rising = cells.rise[cells.cell] > level
            places, left, run = cells.siblings(at, local, parent, total)
            right = []
            for j, place in enumerate(places):
                lanes = np.flatnonzero((place >= 0) & rising)
                show(digests[:, place[lanes]], lanes)
                lanes = lanes[j >= left[lanes]]
                right.append((lanes, digests[:, place[lanes]]))
            new = _resumed(value, before[:, at], right, run)
            value = np.where(rising, new, value)
            at = parent[at]
        records, depth = ways_of(cells)
        for level in range(records.shape[1]):
            rising = np.flatnonzero(depth[cells.cell] > level)
            own = np.ascontiguousarray(records[:, level])
            state, one = _words(own[:, 2:34]), cells.cell[rising]
            counts = own[one, :2].astype(np.int64)
            right = []
            for j in range(fan - 1):
                sibling = _words(own[:, 34 + 32 * j:66 + 32 * j])
                has = np.flatnonzero(j < counts.sum(axis=1))
                show(sibling[:, one[has]], rising[has])
                has = has[j >= counts[has, 0]]
                right.append((has, sibling[:, one[has]]))
            value[:, rising] = _resumed(value[:, rising], state[:, one], right, counts.sum(axis=1) + 1)
        there = np.stack(kept, axis=1) if kept else np.zeros((total, 0), bool)
        data = np.stack(shown, axis=1)[there] if kept else np.zeros((0, 64), np.uint8)
        bounds = np.concatenate([[0], np.cumsum(there.sum(axis=1)) * 64]).astype(np.int64)
        proofs = pa.LargeStringArray.from_buffers(total, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data.tobytes())).cast(pa.string())
        of = pa.array(cells.way_of[cells.cell])
        return pa.RecordBatch.from_arrays([
            cells.nodes.column("id").combine_chunks(), cells.nodes.column("digest").combine_chunks(),
            cells.ways.column("subroot").take(of).combine_chunks(), cells.ways.column("root").take(of).combine_chunks(), proofs,
            pa.array([x.tobytes() for x in _bytes(value)], pa.binary()),
        ], names=["id", "leaf", "subroot", "root", "proof", "folded_root"])

    made = {"up": up, "ways": ways, "fold": fold}[mode]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in complete_groups(batches):
            yield made(_Cells(table, bounds, fan, levels, base))

    return run


_NODES = "grp string, pos long, n long, digest binary"
_WAYS = "grp string, pos long, digest binary, way binary, root binary, subroot binary"


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds ``pos``, a row's place in its ``grp`` by the ``order`` columns, and ``n``, the group's size.

    Ranges over group and order are sorted apart and counted; a large group is many ranges, and only these counts (a row for each
    group and range) are summed up in order.
    """
    line = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    ranges = stored(ranges.withColumns({"__part": F.spark_partition_id(), "__line": line}), name)
    in_group = Window.partitionBy("grp")
    starts = ranges.groupBy("grp", "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__line").alias("__first")).select(
        "grp", "__part", "__first", F.sum("__n").over(in_group).alias("n"),
        (F.sum("__n").over(in_group.orderBy("__part")) - F.col("__n")).alias("__before"))
    return ranges.join(starts, ["grp", "__part"]).withColumn("pos", F.col("__line") - F.col("__first") + F.col("__before")).drop("__part", "__line", "__first", "__before")


def _in_cells(rows: DataFrame, size: int, ways: DataFrame | None = None) -> DataFrame:
    """Rows sorted by cell, the cell's way first."""
    rows = rows.withColumns({"cell": F.concat(F.floor(F.col("pos") / size).cast("string"), F.lit(":"), F.col("grp")), "tag": F.lit(1)})
    if ways is not None:
        ways = ways.withColumns({"cell": F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("grp")), "tag": F.lit(0)})
        rows = rows.unionByName(ways.drop("digest"), allowMissingColumns=True)
    return rows.repartition("cell").sortWithinPartitions("cell", "tag", "pos")


def _tables(nodes: DataFrame, fan: int, levels: int, name: str) -> list[DataFrame]:
    """Nodes of every round, the given ones first; the last table has a row for each group."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    rounds = max(1, -(-int(_height(np.array([most], dtype=np.int64), fan)[0]) // levels))
    out = [nodes]
    for r in range(rounds):
        sorted_ = _in_cells(out[-1].select("grp", "pos", "n", "digest"), fan ** levels)
        out.append(stored(sorted_.mapInArrow(_rounds("up", fan, levels, r * levels), _NODES), f"{name}-{r + 1}"))
    return out


def _handed_down(tables: list[DataFrame], ways: DataFrame, last: int, fan: int, levels: int, name: str) -> DataFrame:
    """Ways of the nodes of table ``last``, from those of the last table."""
    for r in range(len(tables) - 2, last - 1, -1):
        rows = _in_cells(tables[r].select("grp", "pos", "n", "digest"), fan ** levels, ways)
        ways = stored(rows.mapInArrow(_rounds("ways", fan, levels, r * levels), _WAYS), f"{name}-{r}")
    return ways


def manifest(leaves: DataFrame, *, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Proofs of all leaves, and the roots that replaced leaves would give.

    ``leaves``: ``grp`` (text, not null; groups are ordered by it, bytewise), ``id``, ``digest`` (32 bytes) and ``replaced`` (32 bytes, or
    null for none). Returns ``id``, ``leaf``, ``subroot``, ``root``, ``folded_root`` (binary) and ``proof``: the hex digests of the siblings,
    level by level up to the root, from left to right.
    """
    rows = stored(leaves.select("grp", F.col("id").cast("long").alias("id"), "digest", "replaced"), "leaves")
    own = numbered(rows, ["id", "digest"], "leaves-in-order")
    trees = _tables(own, fan, levels, "tree")
    tops = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest")
    above = _tables(numbered(tops, ["of"], "tops-in-order"), fan, levels, "top-tree")
    end = above[-1].select("grp", "pos", "digest", F.lit(b"").alias("way"), F.col("digest").alias("root"), F.lit(None).cast("binary").alias("subroot"))
    ways = _handed_down(above, end, 0, fan, levels, "top-ways")
    ways = ways.drop("grp", "subroot").join(above[0].select("pos", "of"), "pos")
    ways = ways.select(F.col("of").alias("grp"), F.lit(0).cast("long").alias("pos"), "digest", "way", "root", F.col("digest").alias("subroot"))
    ways = _handed_down(trees, ways, 1, fan, levels, "ways")
    folded = _in_cells(own, fan ** levels, ways)
    return folded.mapInArrow(_rounds("fold", fan, levels, 0), "id long, leaf binary, subroot binary, root binary, proof string, folded_root binary")


def group_key(column: Column) -> Column:
    """Text that sorts as the group does: null before everything, also before an empty text."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of the values one after another, each with its length in bytes, so no two rows share a text; null is a dash."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))
