"""N-gram Jaccard self-join by T-occurrence search.

Two documents link when the Jaccard similarity of their sets of distinct word
n-grams reaches ``percent`` / 100. The result is exact: every link between
different texts decides about the groups, and none is lost to a cap.

1. Documents of one set are one node per input partition (``sets``).
2. A node's set is cut by hash range into more segments than a linked pair can
   have differing n-grams, so linked nodes share a whole segment (pigeonhole); or,
   with ``route="rare"``, it has its rarest n-grams as keys, as many as it may miss in a
   partner and one more, so linked nodes share one of these. The order by rarity comes
   from a table of counts and bits of common places, both of fixed size; any order loses
   no link. At lower similarities segments get short and are met by chance, rare n-grams are not.
   Nodes that share a key are joined to its first node, first within the
   input partition, then across: at most one row per key and partition is
   shuffled, however many documents share it. A rare n-gram that few nodes have makes
   pairs of them instead, unless the n-grams of a set that come after it are too few to
   link, and a pair stays only if the parity bits of its sets differ
   in no more places than linked sets may have differing n-grams. So documents that share
   a passage do not chain. Components of stars and pairs are candidate groups:
   supersets of the groups that are wanted.
3. The sets of candidate groups meet in tasks, once each. There every set is a
   query against an inverted index of the others. ``divide_skip`` heap-merges the
   query's short inverted lists with skips, probes its long ones by binary
   search, and returns the sets that occur in as many lists as the overlap
   demands.
4. A group too large for a task is dealt over many. A few of its sets, the
   pivots, are searched by all; afterwards the sets outside of its largest
   component are indexed, in chunks, and searched by all. Pairs inside one
   component need no more search, so this stays exact.

Nulls: a null or wordless text has an empty set and links with nothing; a null
``doc_id`` is a document like others, its group's id is the smallest that is not
null. Rows are kept one for one, repeated rows too. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial, reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm import words
from eventlake.llm.store import Forest, components, stored
from eventlake.llm.worker import give_back

# Segments a pair may share that are empty in both: those keys are left out.
SPARE = 2
# Nodes that share a rare n-gram and are paired; more of them are a star.
PAIRED = 16
# Parity bits of a set of so many n-grams; each size divides the next one.
BIT_SIZES = ((1 << 9, 1 << 9), (1 << 12, 1 << 12), (1 << 40, 1 << 15))
# N-grams of the sets that one task holds at a time.
TASK_GRAMS = 1 << 20
# Pivots per group that does not fit into a task, and in a task per round.
PIVOTS = 24
# Candidate rows that are small enough to be broadcast.
BROADCAST_ROWS = 200_000

SETS = (
    "row long, doc_id long, n long, sig string, node long, keys array<long>, crowded array<long>, "
    "hubs array<long>, bits binary, t1 long, t2 long"
)
# What tells rows apart: the id, and two hashes of the text.
ROW = ("doc_id", "t1", "t2")


# ------------------------------------------------------------ segment keys


def _level_bounds(top: int) -> np.ndarray:
    """Smallest set size of each level; sizes of a level differ by a quarter at most."""
    bounds = [1]
    while bounds[-1] <= top:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 5 // 4))
    return np.array(bounds, dtype=np.int64)


LEVELS = _level_bounds(1 << 40)


def _level(size: int) -> int:
    return int(np.searchsorted(LEVELS, size, side="right")) - 1


def segment_keys(grams: np.ndarray, percent: int) -> np.ndarray:
    """Keys such that two sets that link, and differ, share one at least.

    A set has keys at the level of its size and at that of the largest set it can
    link with; the larger set of a pair has them there as well.
    """
    size = len(grams)
    if not size:
        return np.zeros(0, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(grams))])
    keys = []
    for level in {_level(size), _level(size * 100 // percent)}:
        top = int(LEVELS[level + 1]) - 1
        differing = 2 * top * (100 - percent) // (100 + percent)
        if not differing:
            continue  # sets that link at this level are equal, so one node
        count = differing + 1 + SPARE
        cuts = np.searchsorted(((grams >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32), np.arange(count + 1))
        full = cuts[1:] > cuts[:-1]
        if count - full.sum() > SPARE:
            full[:] = True
        content = sums[cuts[1:]] - sums[cuts[:-1]]
        place = words.mix(np.arange(count, dtype=np.uint64) + np.uint64(level << 40))
        keys.append(words.mix(content + place)[full])
    return np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)


# Places of the table of n-gram counts, places that are told common or not, and the parts both are summed in.
COUNT_PLACES, COMMON_PLACES, COUNT_PARTS = 1 << 20, 1 << 27, 64
# N-grams whose places a task sends at once.
SENT_GRAMS = 1 << 21
# The step that leads to no place but goes on.
LONGEST_STEP = 255


def _codes(grams: np.ndarray) -> np.ndarray:
    """Where the n-grams are among the common places: the part, then the place in it."""
    places = grams & np.uint64(COMMON_PLACES - 1)
    return (places % COUNT_PARTS * np.uint64(COMMON_PLACES // COUNT_PARTS) + places // COUNT_PARTS).astype(np.int64)


def _steps(places: np.ndarray) -> bytes:
    """Ascending places as a byte per step from one to the next, more where they are far apart."""
    gaps = np.diff(places, prepend=0)
    far = gaps // LONGEST_STEP
    out = np.full(len(gaps) + far.sum(), LONGEST_STEP, dtype=np.uint8)
    out[np.arange(len(gaps)) + np.cumsum(far)] = gaps % LONGEST_STEP
    return out.tobytes()


def _places(steps: bytes) -> np.ndarray:
    """What :func:`_steps` was given."""
    steps = np.frombuffer(steps, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < LONGEST_STEP]


def _sent(held: list[np.ndarray]) -> pa.RecordBatch:
    """A row per part of the table: the places of the n-grams in it."""
    codes = np.sort(_codes(np.concatenate(held)))
    first = np.arange(COUNT_PARTS + 1) * (COMMON_PLACES // COUNT_PARTS)
    edges = np.searchsorted(codes, first)
    steps = [_steps(codes[low:high] - start) for low, high, start in zip(edges, edges[1:], first)]
    return pa.RecordBatch.from_arrays([pa.array(range(COUNT_PARTS), pa.int32()), pa.array(steps, pa.binary())], ["part", "steps"])


def _tables(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of a partition's n-grams, by document, in parts of the table."""
    held, size = [], 0
    for batch in batches:
        for _, grams in words.shingle_rows(batch.column("text"), width):
            held.append(np.unique(grams))
            size += len(held[-1])
            if size >= SENT_GRAMS:
                yield _sent(held)
                held, size = [], 0
    if size:
        yield _sent(held)
    del held
    give_back()


def _summed(part: int, sums: np.ndarray) -> pa.RecordBatch:
    """Counts of a part, and bits of its common places: more have them than are paired, or than come by chance."""
    counts = sums.reshape(-1, COUNT_PLACES // COUNT_PARTS).sum(axis=0, dtype=np.uint64)
    mean = sums.mean()
    common = np.packbits(sums > max(PAIRED, mean + 2 * mean**0.5), bitorder="little")
    columns = [pa.array([part], pa.int32()), pa.array([counts.tobytes()], pa.binary()), pa.array([common.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "counts", "common"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per part, which the partition is sorted by."""
    now, sums = None, None
    for batch in batches:
        for part, steps in zip(batch.column("part").to_pylist(), batch.column("steps")):
            if part != now:
                if now is not None:
                    yield _summed(now, sums)
                now, sums = part, np.zeros(COMMON_PLACES // COUNT_PARTS, dtype=np.uint32)
            np.add.at(sums, _places(steps.as_buffer()), 1)
    if now is not None:
        yield _summed(now, sums)
    del sums
    give_back()


def gram_counts(docs: DataFrame, width: int):
    """A broadcast pair, of fixed size: how many documents have an n-gram of each place, and bits of the common places."""
    tables = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(partial(_tables, width), "part int, steps binary")
    found = tables.repartition("part").sortWithinPartitions("part").mapInArrow(_sums, "part int, counts binary, common binary")
    counts = np.zeros((COUNT_PLACES // COUNT_PARTS, COUNT_PARTS), dtype=np.uint64)
    common = np.zeros((COUNT_PARTS, COMMON_PLACES // COUNT_PARTS // 8), dtype=np.uint8)
    for row in found.toArrow().to_batches():
        for part, some, bits in zip(row.column("part").to_pylist(), row.column("counts"), row.column("common")):
            counts[:, part] = np.frombuffer(some.as_buffer(), np.uint64)
            common[part] = np.frombuffer(bits.as_buffer(), np.uint8)
    return docs.sparkSession.sparkContext.broadcast((counts.ravel(), common.ravel()))


def rare_keys(grams: np.ndarray, percent: int, counts: np.ndarray, common: np.ndarray | None = None) -> np.ndarray:
    """The first n-grams of a set in the order of their counts, common ones last, such that two linked sets share one.

    A partner has at least ``percent`` of the set, so of the set's first n-grams, one
    more than may be missing, the partner has one; the first one that both have is among
    the first ones of both.
    """
    kept = len(grams) - -(-len(grams) * percent // 100) + 1
    if not len(grams):
        return grams
    order = [grams, counts[(grams & np.uint64(COUNT_PLACES - 1)).astype(np.int64)]]
    if common is not None:
        codes = _codes(grams)
        order.append(common[codes >> 3] >> (codes & 7).astype(np.uint8) & 1)
    return grams[np.lexsort(order)[:kept]]


def _signature(grams: np.ndarray) -> str:
    """128 bits of the set and its size."""
    return f"{xxhash.xxh3_128_hexdigest(grams.tobytes())}{len(grams):x}"


def parity_bits(grams: np.ndarray) -> bytes:
    """For each place whether an odd number of the set's n-grams falls there."""
    places = next(places for top, places in BIT_SIZES if len(grams) <= top)
    counts = np.bincount((words.mix(grams) & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(a: bytes, b: bytes, size_a: int, size_b: int, percent: int) -> bool:
    """Whether sets of these sizes and parity bits can reach the similarity.

    Places in which the bits differ are n-grams that one set lacks, each at least one. The
    longer bits, folded, are what the set has in the places of the shorter.
    """
    need = -(-(size_a + size_b) * percent // (100 + percent))
    if min(size_a, size_b) < need:
        return False
    short, long = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    folded = np.bitwise_xor.reduce(long.reshape(-1, len(short)), axis=0)
    return size_a + size_b - int(np.bitwise_count(folded ^ short).sum()) >= 2 * need


def _possible(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that may link."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("u_bits", "v_bits", "u_n", "v_n"))
        keep = [may_link(*pair, percent) for pair in zip(*columns)]
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(keys)))


def _lists(holder: np.ndarray, values: np.ndarray, count: int) -> pa.ListArray:
    """The values of each holder from 0 to ``count``."""
    order = np.argsort(holder, kind="stable")
    limits = np.searchsorted(holder[order], np.arange(count + 1))
    return pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(values[order]))


def _node_rows(width: int, percent: int, counts, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``SETS``; a key that too many nodes of the partition have is crowded: its first node has it, the others a hub."""
    rows, docs, sizes, sigs, nodes, bits = [], [], [], [], [], []
    first: dict[str, int] = {}
    all_keys, owners, hashes = [], [], ([], [])
    paired = 1 if counts is None else PAIRED
    for batch in batches:
        own = [batch.column(name).to_numpy() for name in ROW[1:]]
        ids = batch.column("row").to_pylist()
        names = batch.column("doc_id").to_pylist()
        for at, grams in words.shingle_rows(batch.column("text"), width):
            grams = np.unique(grams)
            sig = _signature(grams)
            node = first.setdefault(sig, ids[at])
            rows.append(ids[at]), docs.append(names[at]), sizes.append(len(grams))
            sigs.append(sig), nodes.append(node)
            for held, values in zip(hashes, own):
                held.append(values[at])
            is_new = node == ids[at]
            if is_new:
                keys = segment_keys(grams, percent) if counts is None else rare_keys(grams, percent, *counts.value)
                all_keys.append(keys)
                owners.append(np.full(len(keys), len(rows) - 1, dtype=np.int64))
            bits.append(parity_bits(grams) if is_new and counts is not None else None)
    if not rows:
        return
    keys = own_keys = np.concatenate(all_keys).view(np.int64)
    owner = own_rows = np.concatenate(owners)
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    starts, lengths = _runs(keys)
    crowded = np.repeat(lengths > paired, lengths)
    # The others stay in the order in which the set has them.
    others = np.sort(order[~crowded])
    hub = np.repeat(owner[starts], lengths)
    ids = np.array(rows, dtype=np.int64)
    links = np.unique(np.stack([owner, ids[hub]], axis=1)[crowded & (owner != hub)], axis=0)
    tops = starts[lengths > paired]
    columns = [
        pa.array(ids),
        pa.array(docs, pa.int64()),
        pa.array(sizes, pa.int64()),
        pa.array(sigs),
        pa.array(nodes, pa.int64()),
        _lists(own_rows[others], own_keys[others], len(rows)),
        _lists(owner[tops], keys[tops], len(rows)),
        _lists(links[:, 0], links[:, 1], len(rows)),
        pa.array(bits, pa.binary()),
        *(pa.array(held, pa.int64()) for held in hashes),
    ]
    names = ["row", "doc_id", "n", "sig", "node", "keys", "crowded", "hubs", "bits", *ROW[1:]]
    whole = pa.RecordBatch.from_arrays(columns, names)
    del all_keys, owners, keys, owner, own_keys, own_rows, order, others, links, columns, sigs, bits, hashes
    give_back()
    for at in range(0, len(rows), 2048):
        yield whole.slice(at, 2048)


def _row_keys(text: str = "text") -> list[Column]:
    text = F.col(text).cast("string")
    return [F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit(1)).alias("t2")]


def sets(docs: DataFrame, width: int, percent: int, counts=None) -> DataFrame:
    """One row per document: its set's size and signature, and keys of new sets."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *_row_keys(),
    )
    return stored(numbered.mapInArrow(partial(_node_rows, width, percent, counts), SETS), "sets")


def _key_edges(paired: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v, sure) of a partition that holds all rows of its keys: stars of crowded keys, pairs of the others.

    ``reach`` has the size of a node's set and, in the lower half, one more than the n-grams
    before the key; 0 is a crowded key. Without pairs it is 1 else. All that a pair shares comes at or after the first key
    that both have, so a pair is made only where this is enough to link it.
    """
    parts = [[b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "node", "reach")] for b in batches]
    if not parts:
        return
    keys, nodes, reach = (np.concatenate(c) for c in zip(*parts))
    del parts
    order = np.lexsort((nodes, keys))
    keys, nodes, reach = keys[order], nodes[order], reach[order]
    starts, lengths = _runs(keys)
    if not len(starts):
        return
    star = np.repeat((lengths > paired) | np.logical_or.reduceat(reach == 0, starts), lengths)
    edges = [(nodes[star], np.repeat(nodes[starts], lengths)[star], True)]
    sizes = reach >> 32
    rest = sizes + 1 - (reach & ((1 << 32) - 1))
    for gap in range(1, paired):
        at = np.flatnonzero((keys[gap:] == keys[: max(0, len(keys) - gap)]) & ~star[gap:])
        need = -(-(sizes[at] + sizes[at + gap]) * percent // (100 + percent))
        at = at[np.minimum(rest[at], rest[at + gap]) >= need]
        edges.append((nodes[at + gap], nodes[at], False))
    for sure in (True, False):
        u, v = (np.concatenate([e[side] for e in edges if e[2] == sure] or [np.zeros(0, np.int64)]) for side in (0, 1))
        order = np.lexsort((v, u))
        u, v = u[order], v[order]
        new = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])[: len(u)] & (u != v)
        u, v = u[new], v[new]
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(np.full(len(u), sure))], ["u", "v", "sure"])


def _candidate_edges(rows: DataFrame, percent: int, paired: int) -> DataFrame:
    """Edges (u, v) between nodes whose components hold all groups."""
    # The place of a key in a list without the crowded ones is at most its place among all.
    keyed = rows.where("size(keys) > 0").select("n", "node", F.posexplode("keys").alias("place", "key"))
    reach = F.shiftleft("n", 32) + F.col("place") + 1 if paired > 1 else F.lit(1).cast("long")
    keyed = keyed.select("key", "node", reach.alias("reach"))
    tops = rows.where("size(crowded) > 0").select(F.explode("crowded").alias("key"), "node", F.lit(0).cast("long").alias("reach"))
    across = keyed.unionByName(tops).repartition("key")
    across = across.mapInArrow(partial(_key_edges, paired, percent), "u long, v long, sure boolean")
    within = rows.where("size(hubs) > 0").select(F.col("node").alias("u"), F.explode("hubs").alias("v"))
    if paired > 1:
        across = stored(across, "key-edges")
        pairs = across.where("not sure").select("u", "v").distinct()
        of_node = rows.where("bits is not null").select("node", "n", "bits")
        for side in ("u", "v"):
            pairs = pairs.join(of_node.toDF(side, f"{side}_n", f"{side}_bits"), side)
        # Stored, as a task that runs two Python functions holds two workers.
        within = within.unionByName(stored(pairs.mapInArrow(partial(_possible, percent), "u long, v long"), "pairs"))
    edges = across.where("sure").select("u", "v").unionByName(within)
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


# ------------------------------------------------------------ T-occurrence search


def divide_skip(lists: list[list[int]], need: int) -> list[int]:
    """Members that occur in ``need`` of the ascending lists or more.

    The longest lists are set aside, as many as pays off but fewer than ``need``.
    The others are merged by a heap, where a value with too few occurrences makes
    the merge skip ahead; what reaches the rest of the need is looked up in the
    long lists by binary search.
    """
    if need < 1 or len(lists) < need:
        return []
    lists = sorted(lists, key=len)
    longest = len(lists[-1])
    aside = min(need - 1, int(need / (0.01 * max(1, longest).bit_length() + 1)))
    short, far = lists[: len(lists) - aside], lists[len(lists) - aside :]
    least = need - aside
    heap = [(values[0], at, 0) for at, values in enumerate(short)]
    heapq.heapify(heap)
    found = []
    while len(heap) >= least:
        value = heap[0][0]
        popped = []
        while heap and heap[0][0] == value:
            popped.append(heapq.heappop(heap))
        count = len(popped)
        if count >= least:
            for rest, values in enumerate(far):
                if count + len(far) - rest < need:
                    break
                at = bisect_left(values, value)
                count += at < len(values) and values[at] == value
            if count >= need:
                found.append(value)
            target = value + 1
        else:
            while len(popped) < least - 1 and heap:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            target = max(heap[0][0], value + 1)
        for _, at, place in popped:
            values = short[at]
            place = bisect_left(values, target, place)
            if place < len(values):
                heapq.heappush(heap, (values[place], at, place))
    return found


class Search:
    """Sets of one group, an inverted index of some of them, and what is linked."""

    def __init__(self, percent: int):
        self.percent = percent
        self.sets: list[np.ndarray] = []
        self.index: dict[int, list[int]] = {}

    def linked(self, x: np.ndarray, y: np.ndarray) -> bool:
        shared = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * shared >= self.percent * (len(x) + len(y) - shared)

    def add(self, member: int) -> None:
        for gram in self.sets[member].tolist():
            self.index.setdefault(gram, []).append(member)

    def query(self, grams: np.ndarray, forest: Forest, me: int) -> None:
        """Joins ``me`` with every indexed set that it links with."""
        need = -(-self.percent * len(grams) // 100)
        get = self.index.get
        lists = [x for x in map(get, grams.tolist()) if x is not None]
        for other in divide_skip(lists, need):
            if forest.find(other) != forest.find(me) and self.linked(self.sets[other], grams):
                forest.union(other, me)


def _overlaps(joined: np.ndarray, bounds: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    """How many members of each concatenated set are in the pivot."""
    at = np.searchsorted(pivot, joined)
    at[at == len(pivot)] = 0
    hits = np.concatenate([[0], np.cumsum(pivot[at] == joined)])
    return hits[bounds[1:]] - hits[bounds[:-1]]


def _largest(forest: Forest, size: int) -> set[int]:
    """Members of the largest component."""
    roots = np.array([forest.find(x) for x in range(size)])
    return set(np.flatnonzero(roots == np.bincount(roots).argmax()).tolist())


def group_links(members: list[np.ndarray], percent: int) -> list[int]:
    """The smallest member of each set's component; members must not be empty sets."""
    search, size = Search(percent), len(members)
    search.sets = members
    forest = Forest(size)
    done: set[int] = set()
    if size > 2 * PIVOTS:
        joined = np.concatenate(members)
        sizes = np.array([len(x) for x in members])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        for _ in range(PIVOTS):
            rest = [x for x in range(size) if x not in done]
            if len(rest) <= PIVOTS:
                break
            pivot = rest[len(rest) // 2]
            shared = _overlaps(joined, bounds, members[pivot])
            near = np.flatnonzero(100 * shared >= percent * (sizes + len(members[pivot]) - shared)).tolist()
            for other in near:
                forest.union(other, pivot)
            if len(near) < 2:
                break
            done = _largest(forest, size)
        done = _largest(forest, size)
    for x in range(size):
        if x not in done:
            search.query(members[x], forest, x)
            search.add(x)
    for x in sorted(done):
        search.query(members[x], forest, x)
    return [forest.find(x) for x in range(size)]


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[tuple]]:
    """Runs of rows with equal keys, which the partition is sorted by."""
    now, run = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
            key = row[: len(keys)]
            if key != now and run:
                yield run
                run = []
            now = key
            run.append(row)
    if run:
        yield run


def _group_edges(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of groups that fit into a task, as (uid, smallest uid of its component)."""
    for run in _grouped(batches, ["group"]):
        by_uid = {uid: grams for _, uid, grams in run}
        uids = sorted(by_uid)
        roots = group_links([np.frombuffer(by_uid[x], np.uint64) for x in uids], percent)
        pairs = [(u, uids[r]) for u, r in zip(uids, roots) if u != uids[r]]
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs)], ["u", "v"])


def _probe_edges(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the indexed rows of a key and its probes, which come after them."""
    now, search, forest, uids, place = None, Search(percent), Forest(0), [], {}
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("group", "chunk", "salt", "probe", "uid", "grams"))
        edges = []
        for *key, probe, uid, grams in zip(*columns):
            if key != now:
                now, search, forest, uids, place = key, Search(percent), Forest(0), [], {}
            grams = np.frombuffer(grams, np.uint64)
            if not probe:
                place[uid] = len(uids)
                uids.append(uid)
                search.sets.append(grams)
                search.add(len(uids) - 1)
                continue
            # Each probe is a tree of its own that may join indexed sets.
            forest = Forest(len(uids) + 1)
            search.query(grams, forest, len(uids))
            edges += [(uid, uids[x]) for x in range(len(uids)) if forest.find(x) == forest.find(len(uids))]
        edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["u", "v"])


def _set_rows(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, uid, grams) of candidate documents; a text of another set than the node's is left out."""
    for batch in batches:
        groups, uids, sigs, grams = batch.column("group"), batch.column("uid"), batch.column("sig"), []
        keep = []
        for at, row in words.shingle_rows(batch.column("text"), width):
            row = np.unique(row)
            if _signature(row) == sigs[at].as_py():
                keep.append(at)
                grams.append(row.tobytes())
        yield pa.RecordBatch.from_arrays(
            [groups.take(pa.array(keep, pa.int64())), uids.take(pa.array(keep, pa.int64())), pa.array(grams, pa.binary())],
            ["group", "uid", "grams"],
        )


def _large_group_edges(members: DataFrame, percent: int) -> DataFrame:
    """Links of groups that are dealt over tasks: pivots first, then what they left out."""
    members = stored(members, "large-sets")
    weight = Window.partitionBy("group")
    size = members.groupBy("group").agg(F.sum(F.octet_length("grams") / 8).alias("grams_in_group"))
    salts = F.greatest(F.lit(1), F.ceil(F.col("grams_in_group") / TASK_GRAMS)).cast("int")
    members = members.join(size.select("group", salts.alias("salts")), "group")

    def searched(indexed: DataFrame, chunks: DataFrame) -> DataFrame:
        """Edges between all members and the indexed rows (group, chunk, salts, uid, grams)."""
        index_rows = indexed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        probes = members.join(chunks, "group").withColumn("salt", F.pmod(F.xxhash64("uid"), "salts").cast("int"))
        columns = ["group", "chunk", "salt", "probe", "uid", "grams"]
        both = index_rows.withColumn("probe", F.lit(0)).select(columns).unionByName(
            probes.withColumn("probe", F.lit(1)).select(columns)
        )
        both = both.repartition("group", "chunk", "salt").sortWithinPartitions("group", "chunk", "salt", "probe")
        return both.mapInArrow(partial(_probe_edges, percent), "u long, v long")

    # Pivots: those of the smallest hash, by two aggregations so that no window holds a group.
    spread = members.select("group", "uid", F.xxhash64("uid").alias("h")).withColumn("part", F.pmod("h", F.lit(64)))
    lowest = spread.groupBy("group", "part").agg(F.min(F.struct("h", "uid")).alias("low"))
    ranked = lowest.withColumn("rank", F.row_number().over(weight.orderBy("low"))).where(F.col("rank") <= PIVOTS)
    pivots = members.join(ranked.select(F.col("low.uid").alias("uid")), "uid").withColumn("chunk", F.lit(0))
    edges = stored(searched(pivots, size.select("group", F.lit(0).alias("chunk"))), "pivot-edges")
    roots = components(edges)
    labelled = members.select("group", "uid", "salts", F.octet_length("grams").alias("bytes")).join(
        roots.withColumnRenamed("node", "uid"), "uid", "left"
    )
    labelled = stored(labelled.withColumn("root", F.coalesce("root", "uid")), "pivot-roots")
    counts = labelled.groupBy("group", "root").agg(F.count("*").alias("members"))
    largest = counts.groupBy("group").agg(F.max(F.struct("members", "root")).alias("top"))
    rest = labelled.join(largest.select(F.col("top.root").alias("root")), "root", "left_anti")
    rest_size = rest.groupBy("group").agg(F.ceil(F.sum("bytes") / (8 * TASK_GRAMS)).cast("int").alias("chunks"))
    chunked = rest.join(rest_size, "group").select(
        "uid", F.pmod(F.xxhash64("uid", F.lit(1)), F.col("chunks")).cast("int").alias("chunk")
    )
    chunk_list = rest_size.select("group", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    return edges.unionByName(searched(members.join(chunked, "uid"), chunk_list))


# ------------------------------------------------------------ the operator


def _same_row(left: DataFrame, right: DataFrame, prefix: str) -> Column:
    """Whether two rows have the same id, or none, and the same text."""
    same = [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in ROW[:1]]
    return reduce(and_, same + [left[c] == right[f"{prefix}{c}"] for c in ROW[1:]])


def _with_groups(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Candidate documents' texts; the candidate list is broadcast only when it is short."""
    count = wanted.count()
    side = F.broadcast(wanted) if count <= BROADCAST_ROWS else wanted
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *_row_keys()
    )
    names = [f"wanted_{c}" for c in ROW]
    return texts.join(side, _same_row(texts, side, "wanted_")).drop(*ROW, *names)


def _linked_rows(docs: DataFrame, width: int, percent: int, route: str) -> DataFrame:
    """(doc_id, t1, t2, n, root, component_id) per row; root tells groups apart and is null without a set."""
    if route not in ("segments", "rare"):
        raise ValueError(f"unknown route {route!r}")
    rows = sets(docs, width, percent, gram_counts(docs, width) if route == "rare" else None)
    nodes = rows.where("node = row").select("node", "sig", "n", *ROW)
    uids = nodes.where("n > 0").groupBy("sig").agg(F.min("node").alias("uid"))
    groups = components(_candidate_edges(rows, percent, PAIRED if route == "rare" else 1))
    lone = groups.select(F.col("root").alias("node"), "root").distinct()
    of_node = groups.unionByName(lone).select("node", F.col("root").alias("group"))

    candidates = (
        nodes.join(of_node, "node")
        .join(uids, "sig")
        .where("node = uid")
        .select(*(F.col(c).alias(f"wanted_{c}") for c in ROW), "sig", "uid", "group", "n")
    )
    candidates = stored(candidates, "candidates")
    # A group of one set is copies only.
    weights = candidates.groupBy("group").agg(F.sum("n").alias("grams_in_group"), F.count("*").alias("sets"))
    candidates = candidates.join(weights.where("sets > 1").drop("sets"), "group").drop("n")
    split = F.col("grams_in_group") > TASK_GRAMS
    fitting = _with_groups(docs, candidates.where(~split).drop("grams_in_group"))
    fitting = fitting.mapInArrow(partial(_set_rows, width), "group long, uid long, grams binary")
    links = fitting.repartition("group").sortWithinPartitions("group", "uid")
    links = links.mapInArrow(partial(_group_edges, percent), "u long, v long")
    links = stored(links, "links")
    split_rows = candidates.where(split).drop("grams_in_group")
    if not split_rows.isEmpty():
        large = _with_groups(docs, split_rows)
        large = large.mapInArrow(partial(_set_rows, width), "group long, uid long, grams binary").distinct()
        large = _large_group_edges(large, percent)
        # In the pipeline's long-lived executors no task holds two workers.
        links = links.unionByName(stored(large, "large-links") if route == "rare" else large)
        links = components(links).select(F.col("node").alias("u"), F.col("root").alias("v"))

    # Labels go from sets to nodes to rows: no key has more rows than a partition.
    roots = uids.join(links.select(F.col("u").alias("uid"), F.col("v").alias("root")), "uid", "left")
    roots = roots.select("sig", F.coalesce("root", "uid").alias("root"))
    low = rows.groupBy("node").agg(F.min("doc_id").alias("low"))
    labelled = nodes.select("node", "sig").join(roots, "sig").select("node", "root").join(low, "node")
    ids = labelled.groupBy("root").agg(F.min("low").alias("component_id"))
    named = labelled.select("node", "root").join(ids, "root").select("node", "root", "component_id")
    return rows.select(*ROW, "n", "node").join(named, "node", "left").drop("node")


def ngram_components(docs: DataFrame, width: int = 3, percent: int = 90, route: str = "segments") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text); ``route``: segments or rare."""
    return _linked_rows(docs, width, percent, route).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def without_copies(docs: DataFrame, width: int = 5, percent: int = 80, route: str = "rare") -> DataFrame:
    """``docs`` (doc_id, text, ...) with one row of each group: the smallest id that is not null, then the smallest hash.

    Rows are told apart by id and text, so another text under a copy's id stays and null
    ids are no exception; rows equal in both are copies, and one of them stays, whichever
    it is. Rows without words link with nothing and all stay.
    """
    rows = stored(_linked_rows(docs, width, percent, route).where("root is not null").select("root", *ROW), "grouped")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), *ROW)
    first = rows.groupBy("root").agg(F.min(order).alias("first"))
    # Equal rows are one before anything is joined, also where a third of the rows are equal.
    keys = rows.groupBy("root", *ROW).agg(F.count("*").alias("times"))
    keys = keys.join(first, "root").withColumn("stays", order == F.col("first"))
    keys = keys.where("not stays or times > 1").select(*(F.col(c).alias(f"_of_{c}") for c in ROW), "stays")
    keys = stored(keys.withColumnRenamed("stays", "_stays"), "copies")
    texts = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("whole"), F.col("doc_id").cast("long").alias("doc_id"), *_row_keys()
    )
    side = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    marked = texts.join(side, _same_row(texts, side, "_of_"), "left")
    repeated = marked.where("_stays").groupBy(*ROW).agg(F.first("whole").alias("whole"))
    return marked.where("_stays is null").select("whole.*").unionByName(repeated.select("whole.*"))
