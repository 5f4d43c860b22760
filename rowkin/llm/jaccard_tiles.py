"""N-gram Jaccard join: which texts share so many word n-grams, and the groups that such links make.

A text's set is its distinct word n-grams (64-bit hashes of lower-cased words); a shorter text is one n-gram, a
text without words has an empty set and no links. Equal sets are one node. Two nodes link when
100 * intersection >= percent * union; components of links are found by alternating stars.

Candidates. For sizes a <= b a link means b <= 100 a / percent and a symmetric difference of at most
D(a, b) = (a + b) (100 - percent) / (100 + percent) elements. Sizes are cut into bands; in the tile of a band (smaller
set in the band) the n-gram space is split by hash into more than D parts. A set's keys are the contents of its first
D + 1 parts that aren't empty, D being the most that its size allows in the tile. Of two linked sets take the one whose
D + 1 parts come first: at most D of them differ, so at least one part holds the same elements in both, and both
have it as a key. (A set with too few parts that aren't empty has all parts as keys, the empty ones too.)
Keys need agreement on several n-grams at once, so a passage that many documents share, or a frequent n-gram,
makes no large groups unless whole texts are alike.

Bit bound. Nodes that share a key meet in a tile with their hashed parity bitmaps. The bits in which two bitmaps
differ are at most the elements in which the sets differ, so a count above D(a, b) rules a pair out. Bitmaps are as wide
as the tile's largest sets need. A breadth-first search over the pairs that are left gives a spanning forest, never all
pairs; what is connected isn't compared again.

Exact. First each node's largest tile is searched, in blocks that all hold one and the same pivot, so that this takes as many
rows as nodes. Each node found there meets one of its neighbours, and their sorted arrays are intersected. Links make
labels. Tiles whose nodes have all one label are done with. In the others all nodes of different labels are compared,
and what the bit bound leaves makes families of labels, in which sorted arrays are intersected until nothing more joins.
Every linked pair passes each step or is connected anyway, so components are exact; no cap drops a pair.

Scale and skew. A tile or family with many nodes is split into blocks (BLOCK, EXACT_BLOCK), and pairs of blocks are tasks
of bounded size; nodes of its largest label aren't paired with each other. What is quadratic is bit comparisons between
nodes that share a key and don't link. Keys that very many nodes share are found on a sample of nodes, and their sizes
by a partial aggregate, so they don't meet in one task; all other keys meet in one shuffle of (key, node). Texts are
never shuffled: sets leave the scan only for nodes that are candidates, which a bitmap marks; its size follows their count up to a bound.

Nulls and odd rows: a null text is empty; a null id has no say in component ids and gets its group's smallest, or
null; rows that repeat are equal nodes. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import begun, components, removed_since, sized_broadcast, written
from .textvec import Words, chunks, gram_hash, mix

#: Nodes of a bit tile's block; nodes and n-grams of an exact tile's block, whose sets travel once a block pair.
BLOCK = 2048
EXACT_BLOCK = 2048
TILE = ["tile", "b1", "b2", "side", "n", "node", "label"]
EXACT_ELEMENTS = 2_000_000
#: Bits of the bitmap that marks the documents whose sets are needed: so many for each, and at most.
MARKS_EACH, MOST_MARKS = 128, 1 << 28
#: Rows of a table of hot keys or tiles that is broadcast (16 bytes each); beyond it the join is by shuffle.
MOST_BROADCAST = 1_000_000


class Sizes:
    """Size bands, the tiles a size belongs to, and the bounds for a percentage."""

    def __init__(self, percent: int, ratio: float = 2.0):
        if not 0 < percent <= 100:
            raise ValueError("percent is in 1..100")
        self.percent, self.ratio = percent, ratio
        low, high, top, parts = [], [], [], []
        lo = 1
        while lo < 1 << 40:
            hi = max(lo + 1, int(lo * ratio))
            up = (hi - 1) * 100 // percent
            most = int(self.most(hi - 1, up))
            if most:  # else only equal sets link
                low.append(lo)
                high.append(hi - 1)
                top.append(up)
                parts.append(most + 1 + max(1, most // 20))
            lo = hi
        self.low, self.high, self.top, self.parts = (np.array(x, dtype=np.int64) for x in (low, high, top, parts))

    _made: dict[int, "Sizes"] = {}

    @classmethod
    def of(cls, percent: int) -> "Sizes":
        if percent not in cls._made:
            cls._made[percent] = cls(percent)
        return cls._made[percent]

    def most(self, a, b):
        """The largest symmetric difference of linked sets of these sizes."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def tiles(self, n):
        """(first tile, one after the last) of a size or of an array of sizes."""
        return np.searchsorted(self.top, n), np.searchsorted(self.low, n, side="right")

    def needed(self, n: np.ndarray, tile: np.ndarray) -> np.ndarray:
        """How many of a set's parts in the tile are keys: one more than the largest difference from any partner there."""
        a = np.minimum(n, self.high[tile])
        b = np.where(n > self.high[tile], n, np.minimum(self.top[tile], n * 100 // self.percent))
        return self.most(a, b) + 1

    def bits(self, n: int) -> int:
        """Bits of a set's bitmap, a power of two: at least 2.5 times the largest difference in the highest tile of its size.

        Unrelated sets differ in about half the bits, which must be more than that difference, else nothing is ruled out.
        """
        _, after = self.tiles(n)
        want = 5 * int(self.most(self.high[after - 1], self.top[after - 1])) // 2 if after else 64
        return max(64, 1 << (max(1, want) - 1).bit_length())


def parity_bitmap(elements: np.ndarray, bits: int) -> np.ndarray:
    odd = np.bincount((elements >> np.uint64(7)) & np.uint64(bits - 1), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little")


def folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """A parity bitmap of `size` bytes: the halves' exclusive or, until it fits."""
    while len(bitmap) > size:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] ^ bitmap[half:]
    return bitmap


def element_sets(texts: list[str | None], n: int) -> Iterator[list[np.ndarray]]:
    """For each chunk, the texts' sorted arrays of distinct n-gram hashes."""
    for _, block in chunks(texts):
        w = Words(block)
        grams = gram_hash(w.hash, n)
        out = []
        for a, b in zip(w.first[:-1], w.first[1:], strict=True):
            if b - a >= n:
                out.append(np.unique(grams[a : b - n + 1]))
            else:
                out.append(gram_hash(w.hash[a:b], int(b - a)) if b > a else grams[:0])
        yield out


def node_of(elements: np.ndarray) -> int:
    return int(np.add.reduce(mix(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5))).astype(np.int64))


def _part(elements: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Which of `parts` stretches of the hash space an element is in; it ascends with the element."""
    return ((elements >> np.uint64(32)) * parts.astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def _key(sums: np.ndarray, part: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """A key from the sum of a part's mixed elements, which names its content."""
    return mix(sums ^ mix(part.astype(np.uint64) + (tile.astype(np.uint64) + np.uint64(1) << np.uint64(32))))


def all_keys(sets: list[np.ndarray], sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """(indexes of sets, keys): each set's keys in all its tiles."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    first, after = sizes.tiles(n)
    whose, keys = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for down in range(int((after - first).max(initial=0))):
        mine = np.flatnonzero((n > 0) & (after - 1 - down >= first))
        if not len(mine):
            break
        tile, count = after[mine] - 1 - down, n[mine]
        elements = np.concatenate([sets[i] for i in mine])
        of = np.repeat(np.arange(len(mine)), count)
        part = _part(elements, sizes.parts[tile][of])
        start = np.flatnonzero(np.concatenate([[True], (np.diff(part) != 0) | (np.diff(of) != 0)]))
        sums, part, of = np.add.reduceat(mix(elements), start), part[start], of[start]
        full = np.bincount(of, minlength=len(mine))  # parts that aren't empty
        rank = np.arange(len(of)) - np.repeat(np.cumsum(full) - full, full)
        needed = sizes.needed(count, tile)
        few = full < needed
        chosen = (rank < needed[of]) | few[of]
        whose.append(mine[of[chosen]])
        keys.append(_key(sums[chosen], part[chosen], tile[of[chosen]]))
        for i in np.flatnonzero(few):  # the empty parts, too
            empty = np.setdiff1d(np.arange(sizes.parts[tile[i]]), part[of == i])
            whose.append(np.full(len(empty), mine[i]))
            keys.append(_key(np.zeros(len(empty), dtype=np.uint64), empty, np.full(len(empty), tile[i])))
    return np.concatenate(whose), np.concatenate(keys).view(np.int64)


def keys_of(sets: list[np.ndarray], sizes: Sizes) -> Iterator[tuple[int, np.ndarray]]:
    """(index, keys) of each set, in order."""
    whose, keys = all_keys(sets, sizes)
    by = np.argsort(whose, kind="stable")
    return enumerate(np.split(keys[by], np.searchsorted(whose[by], np.arange(1, len(sets)))) if sets else ())


def _scan_nodes(id_col: str, n: int, percent: int, sample: int):
    """Each row's size, node and bitmap, and the keys of every sample-th node."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes.of(percent)
        for b in batches:
            ids, at = b.column(id_col), 0
            for sets in element_sets(b.column("_t").to_pylist(), n):
                bits = [parity_bitmap(s, sizes.bits(len(s))).tobytes() if len(s) else None for s in sets]
                nodes = [node_of(s) if len(s) else None for s in sets]
                some = [k for _, k in keys_of([s if v is not None and v % sample == 0 else s[:0] for s, v in zip(sets, nodes, strict=True)], sizes)]
                cut = np.cumsum([0, *map(len, some)]).astype(np.int32)
                columns = [ids.slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64())]
                columns += [pa.array(bits, pa.binary()), pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(some)))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "node", "bits", "some"])
                at += len(sets)

    return scan


def _scan_keys(n: int, percent: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes.of(percent)
        for b in batches:
            for sets in element_sets(b.column("_t").to_pylist(), n):
                whose, keys = all_keys(sets, sizes)
                if len(keys):
                    nodes = np.array([node_of(s) for s in sets], dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes[whose])], names=["key", "node"])

    return scan


def _scan_sets(n: int, marks: Broadcast):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(marks.value, dtype=np.uint8)
        for b in batches:
            place = b.column("_place").to_numpy()
            b = b.filter(pa.array((bits[place >> 3] >> (place & 7) & 1).astype(bool)))
            for sets in element_sets(b.column("_t").to_pylist(), n):
                sets = [s for s in sets if len(s)]
                if sets:
                    offsets = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
                    values = pa.array(np.concatenate(sets).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets]), pa.ListArray.from_arrays(offsets, values)], names=["node", "elements"])

    return scan


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted arrays of distinct elements are similar enough."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def forest(n: np.ndarray, words: np.ndarray, label: np.ndarray, side: np.ndarray | None, sizes: Sizes, exact=None) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs (i, j) whose labels differ and whose sizes, bits and, if given, exact(i, j) allow a link.

    n, label: sizes and labels; words: bitmaps, one row each; side: only pairs of different sides count. Breadth first: what
    is reached, with all of its label, isn't compared with anything reached before.
    """
    left = np.ones(len(n), dtype=bool)
    names, of = np.unique(label, return_inverse=True)
    if len(names) == len(label):
        alike = None
    else:
        by = np.argsort(of, kind="stable")
        cut = np.searchsorted(of[by], np.arange(len(names) + 1))
        alike = lambda i: by[cut[of[i]] : cut[of[i] + 1]].tolist()
    for s in range(len(n)):
        if not left[s]:
            continue
        queue = [s] if alike is None else alike(s)
        left[queue] = False
        while queue:
            i = queue.pop()
            j = np.flatnonzero(left)
            if not len(j):
                return
            if side is not None:
                j = j[side[j] != side[i]]
            low, high = np.minimum(n[j], n[i]), np.maximum(n[j], n[i])
            fits = high * sizes.percent <= 100 * low
            j, most = j[fits], sizes.most(low[fits], high[fits])
            if not len(j):
                continue
            j = j[np.bitwise_count(words[j] ^ words[i]).sum(axis=1, dtype=np.int64) <= most]
            for k in j.tolist():
                if left[k] and (exact is None or exact(i, k)):
                    yield i, k
                    more = [k] if alike is None else alike(k)
                    left[more] = False
                    queue += more


def _by_tile(links_of):
    """A scan of rows sorted by (tile, b1, b2) that hands each such group to links_of, however many there are.

    Groups are cut out of Arrow batches; the last one of a batch waits for the rest of it. links_of takes the group's
    columns as arrays (a list of arrays for the last, bits or elements) and yields pairs of row numbers.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            found, last = _linked(t, links_of, False)
            held = t.slice(last)
            if found is not None:
                yield found
        if held is not None:
            found, _ = _linked(held.combine_chunks(), links_of, True)
            if found is not None:
                yield found

    return scan


def _linked(t: pa.Table, links_of, ends: bool) -> tuple[pa.RecordBatch | None, int]:
    """(u, v) of all groups but the last (with it if the rows end), and where the last begins."""
    c = {name: t.column(name).to_numpy() for name in TILE}
    new = (np.diff(c["tile"]) != 0) | (np.diff(c["b1"]) != 0) | (np.diff(c["b2"]) != 0)
    cut = np.concatenate([[0], np.flatnonzero(new) + 1, [t.num_rows]])
    cut = cut if ends else cut[:-1]
    sets = t.column(t.column_names[-1]).combine_chunks()
    sets = sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets
    offsets = np.frombuffer(sets.buffers()[1], dtype=np.int32)[sets.offset : sets.offset + len(sets) + 1]
    whole = np.frombuffer(sets.buffers()[2], np.uint8) if pa.types.is_binary(sets.type) else sets.values.to_numpy().view(np.uint64)
    u, v = [], []
    for x, y in zip(cut[:-1], cut[1:], strict=True):
        if y - x > 1:
            side = c["side"][x:y] if c["b1"][x] != c["b2"][x] else None
            for i, j in links_of(c["n"][x:y], [whole[offsets[k] : offsets[k + 1]] for k in range(x, y)], c["label"][x:y], side):
                u.append(c["node"][x + i])
                v.append(c["node"][x + j])
    found = pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]) if u else None
    return found, int(cut[-1])


def _bit_links(percent: int):
    def links(n: np.ndarray, bitmaps: list[np.ndarray], label: np.ndarray, side: np.ndarray | None) -> Iterator[tuple[int, int]]:
        width = min(map(len, bitmaps))
        words = np.stack([folded(b, width) for b in bitmaps]).view(np.uint64)
        return forest(n, words, label, side, Sizes.of(percent))

    return links


def _exact_links(percent: int):
    def links(n: np.ndarray, sets: list[np.ndarray], label: np.ndarray, side: np.ndarray | None) -> Iterator[tuple[int, int]]:
        sizes = Sizes.of(percent)
        bits = sizes.bits(int(n.max()))
        words = np.stack([parity_bitmap(s, bits) for s in sets]).view(np.uint64)
        return forest(n, words, label, side, sizes, lambda i, j: linked(sets[i], sets[j], percent))

    return links


def _hub_links(percent: int):
    """Links between a hub, the only node of side 0, and the others."""

    def links(n: np.ndarray, sets: list[np.ndarray], label: np.ndarray, side: np.ndarray | None) -> Iterator[tuple[int, int]]:
        hub = int(np.argmin(side))
        return ((hub, j) for j in range(len(n)) if j != hub and linked(sets[hub], sets[j], percent))

    return links


def _pairs(rows: DataFrame, links_of) -> DataFrame:
    """(u, v) of links_of over rows (TILE and a last column), dealt out by tile and pair of blocks."""
    dealt = rows.repartition("tile", "b1", "b2").sortWithinPartitions("tile", "b1", "b2", "n", "node")
    return dealt.mapInArrow(_by_tile(links_of), "u bigint, v bigint")


def _in_blocks(rows: DataFrame, weight: str, block: int, most_weight: int) -> DataFrame:
    """rows (tile, node, n, label, ...) of tiles with several labels, once for each pair of blocks (b1 <= b2) they are in.

    The nodes of a tile's largest label have blocks of their own, which aren't paired with each other. A block has
    about `block` nodes, and most_weight of the column `weight` in sum. Counts are partial aggregates by (tile, label).
    """
    label = rows.groupBy("tile", "label").agg(F.count("*").alias("c"), F.sum(weight).cast("double").alias("w"))
    tile = label.groupBy("tile").agg(
        F.max_by("label", F.struct("c", "label")).alias("big"), F.max("c").alias("bc"), F.sum("c").alias("c"), F.max("w").alias("bw"), F.sum("w").alias("w"), F.count("*").alias("labels")
    ).filter("labels > 1")
    cut = lambda c, w: F.greatest(F.ceil(c / block), F.ceil(w / most_weight), F.lit(1)).cast("int")
    tile = tile.select("tile", "big", cut(F.col("c") - F.col("bc"), F.col("w")).alias("rest"), cut(F.col("bc"), F.col("bw")).alias("own"))
    rows = rows.join(tile, "tile").withColumn("is_big", F.col("label") == F.col("big"))
    hashed = lambda k: F.pmod(F.xxhash64("node", F.lit(7)), k).cast("int")
    rows = rows.withColumn("side", F.when(F.col("is_big"), F.col("rest") + hashed(F.col("own"))).otherwise(hashed(F.col("rest"))))
    others = F.when(F.col("is_big"), F.col("rest")).otherwise(F.col("rest") + F.col("own"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    return rows.withColumns({"b1": F.least("side", "other"), "b2": F.greatest("side", "other")})


def _near_pivot(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of TILE and bits for each node's largest tile, all members of it, cut into blocks that all hold its smallest node."""
    best = members.groupBy("node").agg(F.max_by("tile", F.struct("size", "tile")).alias("tile")).select("tile").distinct()
    mine = members.join(best, "tile", "left_semi")
    pivot = mine.groupBy("tile").agg(F.min("node").alias("node"), F.first("blocks").alias("blocks"))
    every = pivot.select("tile", "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b1"))
    block = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    rows = mine.select("tile", "node", block.alias("b1")).unionByName(every).distinct()
    rows = rows.join(nodes.select("node", "n", "bits"), "node")
    return rows.withColumns({"b2": F.col("b1"), "side": F.lit(0), "label": F.col("node")}).select(*TILE, "bits")


def _sets_of(source: DataFrame, wanted: DataFrame, ngram: int) -> DataFrame:
    """(node, elements) of the nodes whose representative ids are in wanted (rep), and of a few others."""
    size = min(MOST_MARKS, max(1 << 16, 1 << (MARKS_EACH * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64("rep"), F.lit(size)).cast("int")
    words = wanted.select(place.alias("p")).groupBy(F.shiftright("p", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1, p % 32)")).alias("b"))
    words = words.toArrow()  # one job; at most MOST_MARKS / 32 rows of 8 bytes, whatever the input
    marks = np.zeros(size // 32, dtype="<i4")
    marks[words["w"].to_numpy()] = words["b"].to_numpy()
    marked = source.sparkSession.sparkContext.broadcast(marks.tobytes())
    placed = source.select("_t", F.pmod(F.xxhash64("doc_id"), F.lit(size)).cast("int").alias("_place"))
    return placed.mapInArrow(_scan_sets(ngram, marked), "node bigint, elements array<bigint>")


def _tiles(source: DataFrame, rows: DataFrame, ngram: int, percent: int, sample: int) -> DataFrame:
    """members(tile, node, size): the nodes that share a key; keys with the same nodes are one tile."""
    keys = source.select("_t").mapInArrow(_scan_keys(ngram, percent), "key bigint, node bigint")
    # keys of very many nodes, estimated on every sample-th node: more than 1024, and more than one in 2000
    some = rows.filter("size(some) > 0").select("node", F.explode("some").alias("key")).distinct().groupBy("key").count()
    least = max(64, rows.count() // (2000 * sample))
    hot = written(some.filter(F.col("count") > least).select("key"), "jaccard-hot")
    has_hot = bool(hot.take(1))
    hot = sized_broadcast(hot, MOST_BROADCAST)
    cold = keys.join(hot, "key", "left_anti") if has_hot else keys
    by_key = Window.partitionBy("key")
    named = F.xxhash64(F.min("node").over(by_key), F.max("node").over(by_key), F.count("*").over(by_key), *[F.bit_xor(F.xxhash64("node", F.lit(k))).over(by_key) for k in (1, 2)])
    cold = cold.withColumns({"tile": named, "lo": F.min("node").over(by_key), "hi": F.max("node").over(by_key), "size": F.count("*").over(by_key)})
    members = cold.filter("lo <> hi").select("tile", "node", "size")
    if has_hot:
        mine = keys.join(hot, "key").distinct()
        size = mine.groupBy("key").agg(F.count("*").alias("size"))
        members = members.unionByName(mine.join(sized_broadcast(size, MOST_BROADCAST), "key").select(F.col("key").alias("tile"), "node", "size"))
    return written(members.distinct().withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")), "jaccard-members")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members with their node's label, itself if it has none."""
    return members.join(labels.select("node", "root"), "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 3, percent: int = 90, sample: int = 16) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
    mark = begun()
    rows = written(source.mapInArrow(_scan_nodes("doc_id", ngram, percent, sample), f"doc_id {id_type}, n bigint, node bigint, bits binary, some array<bigint>"), "jaccard-nodes")
    nodes = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    members = _tiles(source, rows, ngram, percent, sample)

    # one neighbour for each node of the largest tiles, the one that most others have
    near = written(_pairs(_near_pivot(members, nodes), _bit_links(percent)), "jaccard-near")
    degree = near.groupBy("u").agg(F.count("*").alias("d"))
    hubs = near.join(degree, "u").groupBy(F.col("v").alias("node")).agg(F.max_by("u", F.struct("d", "u")).alias("tile"))
    blocks = hubs.groupBy("tile").agg(F.ceil(F.count("*") / EXACT_BLOCK).cast("int").alias("blocks"))
    leaf = hubs.join(blocks, "tile").select("tile", "node", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("b2"), F.lit(1).alias("side"))
    hub = blocks.select("tile", F.col("tile").alias("node"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b2"), F.lit(0).alias("side"))
    stars = written(leaf.unionByName(hub).join(nodes.select("node", "rep", "n"), "node"), "jaccard-stars")
    sets = _sets_of(source, stars.select("rep"), ngram)
    whole = stars.join(sets, "node").withColumns({"b1": F.lit(-1), "label": F.col("node")}).select(*TILE, "elements")
    sure = written(_pairs(whole, _hub_links(percent)), "jaccard-sure")
    labels = _members_of(components(sure, "jaccard-labels"))

    # what is left: tiles of several labels, and families of labels that the bit bound doesn't keep apart
    left = _in_blocks(_labelled(members, labels).join(nodes.select("node", "n", "bits"), "node"), "n", BLOCK, 1 << 40)
    maybe = written(_pairs(left.select(*TILE, "bits"), _bit_links(percent)), "jaccard-maybe")
    links = sure
    if maybe.take(1):
        named = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_label"))
        between = maybe.join(named("u"), "u", "left").join(named("v"), "v", "left").select(F.coalesce("u_label", "u").alias("u"), F.coalesce("v_label", "v").alias("v"))
        families = _members_of(components(between, "jaccard-families")).select(F.col("node").alias("label"), F.col("root").alias("tile"))
        ends = families.select(F.col("label").alias("node"), "label", "tile")
        inner = labels.select("node", F.col("root").alias("label")).join(families, "label").select("node", "label", "tile")
        member = written(inner.unionByName(ends).distinct().join(nodes.select("node", "rep", "n"), "node"), "jaccard-family")
        blocks = _in_blocks(member, "n", EXACT_BLOCK, EXACT_ELEMENTS)
        sets = _sets_of(source, member.select("rep"), ngram)
        whole = blocks.join(sets, "node").select(*TILE, "elements")
        links = sure.unionByName(_pairs(whole, _exact_links(percent)))
    found = components(links, "jaccard-links")
    removed_since(docs.sparkSession, mark, rows, found)

    named = nodes.select("node", "rep").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    groups = named.join(low, "root").select("node", "component_id")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n", "node").join(groups, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _members_of(components: DataFrame) -> DataFrame:
    """components with a row for each root, too: its own root."""
    return components.select("node", "root").unionByName(components.select(F.col("root").alias("node"), "root").distinct())
