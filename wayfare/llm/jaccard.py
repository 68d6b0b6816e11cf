"""Size-aware heavy-light similarity join on sets of word shingles, and its classes.

Equal sets become one vertex first. Then two documents that link share a key:

- *Light* sets, of at most x shingles, enumerate their subsets of each size that a link to
  a set of size m demands, ceil(t (n + m) / (1 + t)), and join on the subset.
- *Heavy* sets scan inverted lists. A set is listed under its first n - ceil(t n) + 1 shingles in a global order; two sets
  that link meet in a list. Light sets large enough to link to a heavy one are listed too.

x is where the cost of subsets meets the cost of lists, taken from the sizes and list lengths found.
The order puts shingles last that a count over all documents finds frequent (a count-min table, fixed in size), so a
passage that a third of the documents share makes no list of them. Sets listed under a frequent shingle because their rare ones
run out are *poor* in rare shingles or *rich*: two sets of n and m shingles that link differ in (n + m) (1 - t) / (1 + t) at most, so
two rich sets, each with more rare ones than its share of that, must have a rare one in common and meet there. Documents of a list are
compared with its least member; what that leaves apart is compared block by block, rich sets with poor ones only. A parity signature bounds the
difference of two sets from below and drops only pairs that cannot link; the rest are
compared exactly on their texts. Of each pair of blocks a least spanning forest of them comes first, so a group of copies that all link costs a
pair a member, not one for every two; then all pairs that are still apart. No pair inside a class that is already joined is looked at again.
"""

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.llm import graph
from wayfare.llm.common import stage, table
from wayfare.llm.textarrays import FACTOR, STEP, blocks, mix64, shingle_sets

PERCENT = 80
WORDS = 5
CELL_BITS = 23  # the count table: 8 million cells
CELL_BLOCK = 1 << 14
HOT_CELLS = 1 << 20  # of them, so many at most are sent out: 16 MB
SIGNATURE_BITS = 1024  # the shortest signature
LARGEST_LIGHT = 30  # sizes among which the boundary is sought
LIST_CHECK = 4
LIST_PART = 4096  # members of a list that one group holds
BLOCK = 256
ID_BITS = 10  # of a bitmap, for each id in it
MOST_BITS = 1 << 29  # of a bitmap that is broadcast: 64 MB
ORDINARY, POOR, RICH = 0, 1, 2  # roles in a list
POSTINGS = "h long, part int, s1 long, n int, role int"
POSTING_FIELDS = [field.split()[0] for field in POSTINGS.split(", ")]
CANDIDATES = "h long, a long, b long, more boolean"
ROWS = "kind int, doc_id long, n int, s1 long, s2 long, least long, blob binary"


def needed(n: int, m: int, percent: int = PERCENT) -> int:
    """Least overlap of linked sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def subset_sizes(n: int, largest: int, percent: int = PERCENT) -> list[int]:
    """Subset sizes that links from a set of size n to sets of at most ``largest`` shingles demand."""
    low, high = -(-percent * n // 100), min(largest, 100 * n // percent)
    return sorted({needed(n, m, percent) for m in range(low, high + 1) if needed(n, m, percent) <= min(n, m)})


def subset_count(n: int, largest: int, percent: int = PERCENT) -> int:
    return sum(math.comb(n, c) for c in subset_sizes(n, largest, percent))


def boundary(counts: dict[int, tuple[int, float]], percent: int = PERCENT) -> int:
    """The size x up to which subsets are cheaper than lists. ``counts``: size -> (sets, mean list length).

    A subset is one key, and sets that share it do link. A listing is a key too, and every set met in the list has to
    be compared, which costs about as much as LIST_CHECK keys.
    """

    def cost(x: int) -> float:
        total = 0.0
        for n, (k, length) in counts.items():
            if n <= x:
                total += k * subset_count(n, x, percent)
            if n > x:
                total += k * prefix_length(n, percent) * (1 + LIST_CHECK * length)
            elif 100 * n >= percent * (x + 1):
                total += k * prefix_length(n, percent)
        return total

    return min(range(1, LARGEST_LIGHT + 1), key=lambda x: (cost(x), x))


def signature(shingles: np.ndarray) -> bytes:
    """Parity of the number of shingles in each slot, at least as many slots as shingles.

    Sets that differ in d shingles differ in at most d bits. A signature folds to half its length by XOR of its halves.
    """
    bits = SIGNATURE_BITS
    while bits < len(shingles):
        bits *= 2
    slots = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(slots, minlength=bits) & 1).tobytes()


def _folded(words: np.ndarray) -> np.ndarray:
    half = words.shape[-1] // 2
    return words[..., :half] ^ words[..., half:]


def may_link(one: bytes, other: bytes, n: int, m: int, percent: int = PERCENT) -> bool:
    """Whether sizes and signatures of two sets allow a link."""
    if 100 * n < percent * m or 100 * m < percent * n:
        return False
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    while len(a) != len(b):
        a, b = (_folded(a), b) if len(a) > len(b) else (a, _folded(b))
    return (100 + percent) * int(np.bitwise_count(a ^ b).sum(dtype=np.int64)) <= (100 - percent) * (n + m)


def _signed(x) -> int:
    return int(np.uint64(x).astype(np.int64))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its size, 128-bit digest, least shingle and signature; at the end the task's count table."""
    table_, pending, held = np.zeros(1 << CELL_BITS, np.uint32), [], 0

    def spill():
        nonlocal pending, held
        if pending:
            cells, n = np.unique((np.concatenate(pending) >> np.uint64(64 - CELL_BITS)).astype(np.uint32), return_counts=True)
            table_[cells] += n.astype(np.uint32)
        pending, held = [], 0

    for batch in batches:
        ids = batch.column(0)
        for row, texts in blocks(batch.column(1)):
            sets = shingle_sets(texts, WORDS)
            n = [len(s) for s in sets]
            s1 = [_signed(mix64(s).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
            s2 = [_signed(mix64(s ^ STEP).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
            least = [_signed(s[0]) if len(s) else 0 for s in sets]
            pending += sets
            held += sum(n)
            if held >= 1 << 20:
                spill()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(sets), np.int32)),
                    ids.slice(row, len(sets)),
                    pa.array(n, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (s1, s2, least)],
                    pa.array([signature(s) for s in sets], pa.binary()),
                ],
                ["kind", "doc_id", "n", "s1", "s2", "least", "blob"],
            )
    spill()
    parts = table_.reshape(-1, CELL_BLOCK)
    full = [i for i, part in enumerate(parts) if part.any()]
    zero = pa.array(np.zeros(len(full), np.int64))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(full), np.int32)), pa.nulls(len(full), pa.int64()), pa.array(full, pa.int32()), zero, zero, zero, pa.array([zlib.compress(np.minimum(parts[i], 65535).astype(np.uint16).tobytes(), 1) for i in full], pa.binary())],
        ["kind", "doc_id", "n", "s1", "s2", "least", "blob"],
    )


def _hot_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the count tables of all tasks block by block (rows arrive sorted by block) and keep cells far above the mean."""
    at, total = None, None

    def hot():
        mean = total.mean()
        cells = np.flatnonzero(total > mean + 8 * math.sqrt(mean) + 16)
        return pa.RecordBatch.from_arrays([pa.array(cells + at * CELL_BLOCK, pa.int64()), pa.array(total[cells].astype(np.int64))], ["cell", "n"])

    for batch in batches:
        for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            if block != at:
                if at is not None:
                    yield hot()
                at, total = block, np.zeros(CELL_BLOCK, np.uint64)
            total += np.frombuffer(zlib.decompress(blob.as_py()), np.uint16)
    if at is not None:
        yield hot()


def _postings(cells: np.ndarray, counts: np.ndarray, largest: int, light_parts: int, percent: int):
    """The keys of every set: prefix shingles of heavy sets, subsets of light ones. Long lists come in parts."""
    subsets: dict[int, list[np.ndarray]] = {}

    def light_keys(s: np.ndarray) -> np.ndarray:
        if len(s) not in subsets:
            sizes = subset_sizes(len(s), largest, percent)
            subsets[len(s)] = [np.array(list(combinations(range(len(s)), c))) for c in sizes]
        mixed = mix64(s)
        return np.concatenate([mix64(mixed[index].sum(axis=1, dtype=np.uint64) * np.uint64(FACTOR) + np.full(1, index.shape[1], np.uint64) * STEP) for index in subsets[len(s)]] or [s[:0]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # digests of the task's sets: copies of a text list nothing anew
        for batch in batches:
            for _, texts in blocks(batch.column(0)):
                columns: list[list[np.ndarray]] = [[] for _ in POSTING_FIELDS]

                def post(keys: np.ndarray, part, own: int, n: int, role: int):
                    for column, values in zip(columns, (keys, part, own, n, role)):
                        column.append(values if isinstance(values, np.ndarray) else np.full(len(keys), values))

                for s in shingle_sets(texts, WORDS):
                    n = len(s)
                    own = _signed(mix64(s).sum(dtype=np.uint64)) if n else 0
                    if not n or own in seen:
                        continue
                    seen.add(own)
                    if 100 * n >= percent * (largest + 1):
                        cell = (s >> np.uint64(64 - CELL_BITS)).astype(np.int64)
                        at = np.searchsorted(cells, cell)
                        hot = cells[np.minimum(at, len(cells) - 1)] == cell if len(cells) else np.zeros(n, bool)
                        length, rare = prefix_length(n, percent), n - int(hot.sum())
                        cold = np.flatnonzero(~hot)[:length]
                        extra = np.flatnonzero(hot)[: length - len(cold)]
                        post(s[cold], 0, own, n, ORDINARY)
                        if len(extra):
                            split = -(-counts[at[extra]] // LIST_PART)
                            role = RICH if rare * (100 + percent) > n * (100 - percent) else POOR
                            post(s[extra], own % split + 1, own, n, role)
                    if n <= largest:
                        post(light_keys(s), own % light_parts + 1, own, n, ORDINARY)
                if columns[0]:
                    kinds = (np.int64, np.int32, np.int64, np.int32, np.int32)
                    arrays = [pa.array(np.concatenate([v.astype(kind) for v in column])) for column, kind in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, POSTING_FIELDS)

    return work


def forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of the pairs (a, b) of members that make a spanning forest of the labels, earlier pairs first."""
    _, label = np.unique(label, return_inverse=True)
    ends, chosen = np.stack([label[a], label[b]]), []
    while len(apart := np.flatnonzero(ends[0] != ends[1])):
        # every class takes its first pair: in one order for all, so these never make a circle
        least = np.full(len(label), len(a))
        np.minimum.at(least, ends[:, apart].ravel(), np.tile(apart, 2))
        picked = np.unique(least[least < len(a)])
        chosen.append(picked)
        root = np.arange(len(label))
        for x, y in ends[:, picked].T.tolist():
            root[root == root[x]] = root[y]
        ends = root[ends]
    return np.sort(np.concatenate([np.zeros(0, np.int64), *chosen]))


def _compare_blocks(percent: int, whole: bool):
    """Pairs of one block pair that may link: different labels, sizes in range, signatures near enough.

    Without ``whole`` only a spanning forest of them, nearest signatures first, and in ``more`` whether there are others.
    """

    def pairs(group: pa.Table) -> tuple[list[int], list[int], bool]:
        v, label, n, side = (group.column(c).to_numpy() for c in ("v", "label", "n", "side"))
        n = n.astype(np.int64)
        blobs = group.column("blob").to_pylist()
        length = np.array([len(x) for x in blobs])
        # the signatures of one length, and those of twice that length folded to it
        shelves, at = {}, np.zeros(len(v), np.int64)
        for own in np.unique(length).tolist():
            rows = np.flatnonzero(length == own)
            at[rows] = np.arange(len(rows))
            words = np.frombuffer(b"".join(blobs[i] for i in rows), np.uint64).reshape(len(rows), -1)
            shelves[own, own] = words
            shelves[own, own // 2] = _folded(words)
        right = np.flatnonzero((side == 0) | (side == 2))
        a, b, far = [], [], []
        for i in np.flatnonzero(side <= 1).tolist():
            js = right[(label[right] != label[i]) & (100 * n[right] >= percent * n[i]) & (100 * n[i] >= percent * n[right])]
            if side[i] == 0:
                js = js[v[js] > v[i]]
            for own in np.unique(length[js]).tolist():
                same, common = js[length[js] == own], min(own, int(length[i]))
                differ = np.bitwise_count(shelves[own, common][at[same]] ^ shelves[int(length[i]), common][at[i]]).sum(axis=1, dtype=np.int64)
                near = (100 + percent) * differ <= (100 - percent) * (n[same] + n[i])
                a.append(np.full(int(near.sum()), i))
                b.append(same[near])
                far.append(differ[near])
        if not a:
            return [], [], False
        a, b, far = (np.concatenate(x) for x in (a, b, far))
        kept, more = slice(None), False
        if not whole:
            # one order of all pairs, whatever list or block they are met in: lists of the same texts choose the same pairs
            order = np.lexsort((np.maximum(v[a], v[b]), np.minimum(v[a], v[b]), far))
            kept = order[forest(label, a[order], b[order])]
            more = len(kept) < len(a)
        return v[a[kept]].tolist(), v[b[kept]].tolist(), more

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, found = [], None, []

        def close():
            a, b, more = pairs(pa.Table.from_batches(held))
            found.extend((key[0], x, y, more) for x, y in zip(a, b))

        def rows() -> pa.RecordBatch:
            columns = list(zip(*found)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["h", "a", "b", "more"])

        for batch in batches:
            h, i, j = (batch.column(c).to_numpy() for c in ("h", "bi", "bj"))
            change = np.flatnonzero((h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            edges = [0, *change.tolist(), len(h)]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                here = (int(h[start]), i[start], j[start])
                if here != key and held:
                    close()
                    held = []
                held.append(batch.slice(start, end - start))
                key = here
            yield rows()
            found.clear()
        if held:
            close()
            yield rows()

    return work


def _verify(percent: int):
    """Exact comparison: rows arrive sorted, the text of a hub before those compared with it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hubs = None, []
        for batch in batches:
            hub, part, role, ids = (batch.column(c).to_pylist() for c in ("hub", "part", "role", "doc_id"))
            a, b = [], []
            for first, texts in blocks(batch.column("text")):
                for at, s in enumerate(shingle_sets(texts, WORDS), first):
                    if (hub[at], part[at]) != key:
                        key, hubs = (hub[at], part[at]), []
                    if role[at] == 0:
                        hubs.append(s)
                        continue
                    for other in hubs:
                        both = len(np.intersect1d(s, other, assume_unique=True))
                        if both and 100 * both >= percent * (len(s) + len(other) - both):
                            a.append(hub[at])
                            b.append(ids[at])
                            break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return work


def with_ids(docs: DataFrame, ids: DataFrame, wanted: bool) -> DataFrame:
    """Documents whose doc_id may be among ``ids`` (a stored table), or with ``wanted`` false surely is not, without a shuffle.

    Ids are hashed to the bits of a bitmap of ID_BITS bits an id, so it grows with the ids and about a tenth of the others pass by mistake. It is
    broadcast up to MOST_BITS; for more ids the documents' ids are joined, which is exact. A null id is never among them.
    """
    bits = ids.count() * ID_BITS
    if bits > MOST_BITS:
        distinct = ids.select("doc_id").distinct()
        return docs.join(distinct, "doc_id", "left_semi" if wanted else "left_anti")
    bits = max(1 << 15, bits)

    def bit(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits)) + 1

    maps = ids.filter("doc_id is not null").groupBy(F.bitmap_bucket_number(bit("doc_id")).alias("_bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit("doc_id"))).alias("_map"))
    numbered = docs.withColumn("_bit", bit("doc_id"))
    joined = numbered.join(F.broadcast(maps), F.bitmap_bucket_number("_bit") == F.col("_bucket"), "left")
    position = F.bitmap_bit_position("_bit")
    byte = F.conv(F.hex(F.substring("_map", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (position % 8).cast("int")) == 1
    among = F.col("doc_id").isNotNull() & F.coalesce(is_set, F.lit(False))
    return joined.filter(among if wanted else ~among).drop("_bit", "_bucket", "_map")


def verified(docs: DataFrame, edges: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those candidate pairs (a, b) whose shingle sets link, compared on their whole texts.

    Each text travels to its hub a; a hub with many partners is split, its own text going to every part.
    """
    degree = edges.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    dealt = edges.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    spokes = dealt.select(F.col("b").alias("doc_id"), F.col("a").alias("hub"), "part", F.lit(1).alias("role"))
    hubs = dealt.select(F.col("a").alias("doc_id"), F.col("a").alias("hub"), "part", F.lit(0).alias("role")).distinct()
    wanted = stage(spokes.unionAll(hubs), "wanted")
    texts = with_ids(docs.select("doc_id", "text"), wanted, True).join(wanted, "doc_id")
    ordered = texts.repartition("hub", "part").sortWithinPartitions("hub", "part", "role")
    return ordered.select("hub", "part", "role", "doc_id", "text").mapInArrow(_verify(percent), "a long, b long").distinct()


def _near(edges: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs whose sizes and signatures allow a link."""
    left = reps.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("blob").alias("ba"))
    right = reps.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("blob").alias("bb"))
    sizes = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    joined = edges.join(right, "b").join(left, "a").filter(sizes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("ba", "bb", "na", "nb"))
            flags = [may_link(*row, percent) for row in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(flags, pa.bool_()))

    return joined.select("a", "b", "ba", "bb", "na", "nb").mapInArrow(work, "a long, b long").distinct()


def dealt_blocks(labelled: DataFrame, reps: DataFrame) -> DataFrame:
    """The members of every list that is not one class yet, dealt to pairs of blocks (bi, bj) that are to be compared.

    Members that are not rich pair with each other, rich ones only with those; a list of rich ones alone is dealt to nothing. Side 0 is
    a block with itself, 1 the left and 2 the right block of a pair.
    """
    plain = F.count(F.when(F.col("role") != RICH, F.lit(1)))
    apart = labelled.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("k"), plain.alias("k1"))
    apart = apart.filter("lo != hi and k > 2 and k1 > 0")
    apart = apart.select("h", F.ceil(F.col("k1") / BLOCK).cast("int").alias("g"), F.ceil((F.col("k") - F.col("k1")) / BLOCK).cast("int").alias("gr"))
    placed = labelled.join(apart, "h").join(reps.select("v", F.col("n").alias("m"), "blob"), "v").filter("n = m")
    row = ["v", "n", "label", "blob"]
    rich, own, left = F.col("role") == RICH, F.xxhash64("v"), F.col("mine") < F.col("other")
    ordinary = placed.filter(~rich).withColumn("mine", F.pmod(own, F.col("g")).cast("int"))
    among = ordinary.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    side = F.when(F.col("mine") == F.col("other"), 0).when(left, 1).otherwise(2)
    among = among.select("h", F.least("mine", "other").alias("bi"), F.greatest("mine", "other").alias("bj"), side.alias("side"), *row)
    met = ordinary.filter("gr > 0").withColumn("bi", F.explode(F.sequence(-F.col("gr"), F.lit(-1))))
    met = met.select("h", "bi", F.col("mine").alias("bj"), F.lit(2).alias("side"), *row)
    others = placed.filter(rich).withColumn("bj", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    others = others.select("h", (-1 - F.pmod(own, F.col("gr"))).cast("int").alias("bi"), "bj", F.lit(1).alias("side"), *row)
    return among.unionByName(met).unionByName(others)


def similarity_classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id reachable by links) of every document.

    Null and blank texts have no shingles, link with nothing and are their own component. Rows
    that repeat a doc_id are one vertex; each row is returned. A row with a null doc_id takes the component of
    its set; it cannot name a component itself, so sets that only such rows own link with nothing and have a null one.
    Texts of any length count whole. Only doc_id and text are read, whatever other columns there are.
    An empty table gives an empty result.
    """
    texts = docs.select("doc_id", "text")
    scanned = stage(texts.mapInArrow(_scan, ROWS), "sets")
    rows = scanned.filter("kind = 0")
    sets = rows.filter("n > 0 and doc_id is not null").groupBy("s1", "s2", "n", "least").agg(F.min("doc_id").alias("v"), F.first("blob").alias("blob"))
    reps = stage(sets, "reps")

    tables = scanned.filter("kind = 1").select("n", "blob").repartition("n").sortWithinPartitions("n")
    # the order of shingles alone depends on them, never the result
    hottest = tables.mapInArrow(_hot_cells, "cell long, n long").orderBy(F.desc("n"), "cell").limit(HOT_CELLS)
    found = hottest.toArrow().sort_by("cell")
    cells, counts = found["cell"].to_numpy(), found["n"].to_numpy()
    small = reps.filter(F.col("n") <= LARGEST_LIGHT).groupBy("n").agg(F.count(F.lit(1)).alias("k"), F.count_distinct("least").alias("d")).collect()
    largest = boundary({r.n: (r.k, r.k / r.d) for r in small}, percent)
    light_parts = max(1, -(-sum(r.k for r in small if r.n <= largest) // LIST_PART))

    keys = texts.select("text").mapInArrow(_postings(cells, counts, largest, light_parts, percent), POSTINGS)
    listed = W.partitionBy("h", "part")
    met = keys.withColumns({"lo": F.min("s1").over(listed), "hi": F.max("s1").over(listed)}).filter("lo != hi or part > 0")
    met = met.select(*POSTING_FIELDS).join(reps.select("s1", "n", "v"), ["s1", "n"]).select("h", "part", "v", "n", "role").distinct()
    lists = stage(met.withColumn("hub", F.min("v").over(listed)), "lists")

    stars = lists.filter("v != hub").select(F.col("hub").alias("a"), F.col("v").alias("b"))
    tops = lists.filter("part > 0").select("h", "hub").distinct().withColumn("top", F.min("hub").over(W.partitionBy("h")))
    stars = stars.unionAll(tops.filter("hub != top").select(F.col("top").alias("a"), F.col("hub").alias("b")))
    first = stage(_near(stars.distinct(), reps, percent), "candidates")
    links = stage(verified(docs, first, percent), "links")

    labels, tested = graph.components(links), first
    members = lists.select("h", "v", "n", "role").distinct()
    for whole in (False, True):
        labelled = members.join(labels.withColumnRenamed("id", "v"), "v", "left").withColumn("label", F.coalesce("label", "v"))
        labelled = stage(labelled.select("h", "v", "n", "role", "label"), "labelled")
        dealt = dealt_blocks(labelled, reps).repartition("h", "bi", "bj").sortWithinPartitions("h", "bi", "bj")
        near = stage(dealt.mapInArrow(_compare_blocks(percent, whole), CANDIDATES), "near")
        pairs = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        more = stage(pairs.join(tested, ["a", "b"], "left_anti"), "candidates")
        if not more.isEmpty():
            links = links.unionAll(verified(docs, more, percent)) if whole else stage(links.unionAll(verified(docs, more, percent)), "links")
            labels, tested = graph.components(links), tested.unionAll(more)
        # only lists that hold pairs beyond their forests are looked at again
        members = members.join(near.filter("more").select("h").distinct(), "h", "left_semi")
        if whole or near.filter("more").isEmpty():
            break

    known = reps.select("s1", "s2", "n", "v").join(labels.withColumnRenamed("id", "v"), "v", "left")
    known = known.select("s1", "s2", "n", F.coalesce("label", "v").alias("component"))
    joined = rows.select("doc_id", "n", "s1", "s2").join(known, ["s1", "s2", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return joined.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"))


def distinct_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each class, the one with the least doc_id (null last), with all its columns.

    Rows are told apart by a hash of doc_id and text, so ids that are null or shared neither keep a copy nor cost a document: of two
    equal rows one stays, of two texts under one id both, unless they link. Documents without words link with nothing and all stay.
    """
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    keyed = docs.select(key.alias("doc_id"), "text")
    classes = similarity_classes(keyed, percent).filter("n_shingles > 0")
    named = docs.select(key.alias("_key"), F.col("doc_id").alias("_id")).distinct()
    ids = classes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"), F.min("component_id").alias("component"))
    ids = stage(ids.join(named, F.col("doc_id") == F.col("_key")).select("doc_id", "_id", "k", "component"), "classes")
    first = ids.groupBy("component").agg(F.min(F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "doc_id")).alias("first"))
    judged = ids.join(first, "component").select("doc_id", "k", (F.col("first.doc_id") == F.col("doc_id")).alias("_keep"))
    suspect = stage(judged.filter("k > 1 or not _keep").select("doc_id", "k", "_keep"), "suspect")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    # most documents are alone and pass by; only those that share a bit with a copy are shuffled
    rows = docs.select(row, key.alias("doc_id"))
    clear = with_ids(rows, suspect, False)
    doubtful = with_ids(rows, suspect, True).join(suspect, "doc_id", "left").filter("k is null or (k = 1 and _keep)")
    repeated = suspect.filter("k > 1 and _keep").select("doc_id")
    equal = with_ids(rows, repeated, True).join(repeated, "doc_id").withColumn("place", F.row_number().over(W.partitionBy("doc_id").orderBy(F.lit(1))))
    return clear.select("row.*").unionAll(doubtful.select("row.*")).unionAll(equal.filter("place = 1").select("row.*"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents: five words, similarity of 0.8 or more."""
    return similarity_classes(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) >= 5
           THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
           WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingles
  FROM w),
n AS MATERIALIZED (SELECT doc_id, coalesce(len(shingles), 0) AS n, md5(array_to_string(list_sort(shingles), '|')) AS digest FROM s),
r AS MATERIALIZED (SELECT digest, min(doc_id) AS v, min(n) AS n FROM n WHERE n > 0 GROUP BY digest),
p AS MATERIALIZED (SELECT r.v, r.n, unnest(s.shingles) AS g FROM r JOIN s ON s.doc_id = r.v),
q AS (SELECT a.v AS a, b.v AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
      FROM p a JOIN p b ON a.g = b.g AND a.v < b.v AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM q WHERE 100 * k >= 80 * (na + nb - k) UNION SELECT b, a FROM q WHERE 100 * k >= 80 * (na + nb - k)),
c AS (SELECT v, v AS label FROM r UNION SELECT e.b, c.label FROM c JOIN e ON e.a = c.v),
l AS (SELECT v, min(label) AS label FROM c GROUP BY v)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, CASE WHEN n.n = 0 THEN n.doc_id ELSE l.label END AS component_id
FROM n LEFT JOIN r ON n.digest = r.digest AND n.n > 0 LEFT JOIN l ON l.v = r.v
"""
