"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits. A-Z are lower-cased, words are runs of bytes other than white space
(0x20, 0x09-0x0D), shingles are ``width`` consecutive words with repeats, joined by a space
(a text of fewer words is one shingle, a text without words has fingerprint zero). A bit is 1 if
it is set in over half of the shingles' XXH64 hashes (seed 42).

Two fingerprints link at ``BITS`` = 2 or fewer differing bits. If the bits are cut into m parts with
thresholds that add up to ``BITS - m + 1``, linked fingerprints agree within its threshold in some
part. Correlated bits share a part; the number of parts and the thresholds (-1: part not used)
come from dynamic programming over estimated candidate counts. Different fingerprints are probed
in all variants within the threshold, meet in buckets and are verified; a bucket returns the edges
of a spanning forest, never all its pairs. The members of buckets over ``BUCKET_LIMIT`` rows go
another exact way: each fingerprint and its 64 neighbours at one bit are keys, and two
fingerprints within two bits share a key, whose group has 65 members at most.

Defined cases: null text is empty; documents without words link with each other; equal rows are
rows of one component; null ids do not count for ``component_id`` (null if a component has no
other); an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.components import components
from marginalia.llm.text import steps, unused_name
from marginalia.storage import stage

WIDTH, BITS, SEED = 3, 2, 42
BUCKET_LIMIT = 4096
PART_COUNTS = (2, 3)


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[place:] for place in range(width)] if len(words) >= width else [[word] for word in words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(shingle, SEED) for shingle in map(b" ".join, zip(*runs, strict=False))], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(``doc_id``, ``fp``): the fingerprint of each row as a signed long."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                codes = np.array([fingerprint(text, width) for text in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(codes.view(np.int64))], ["doc_id", "fp"]
                )

    return source.mapInArrow(scan, "doc_id long, fp long")


def bit_groups(together: np.ndarray, ones: np.ndarray, count: int, parts: int) -> list[list[int]]:
    """Split the 64 bits into ``parts`` groups, keeping strongly correlated bits together."""
    share = ones / max(count, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    strength = np.abs((together / max(count, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    free, groups = set(range(64)), []
    for size in [64 // parts + (place < 64 % parts) for place in range(parts)]:
        group: list[int] = []
        while len(group) < size:
            ties = strength[:, group or sorted(free)].sum(1)
            group.append(max(sorted(free), key=lambda bit: ties[bit]))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def within(ones: np.ndarray, count: int, group: list[int], bits: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0, 1, ... ``bits`` bits of ``group``."""
    chance = np.zeros(bits + 1)
    chance[0] = 1
    for bit in group:
        share = ones[bit] / max(count, 1)
        differ = 2 * share * (1 - share)
        chance = chance * (1 - differ) + np.concatenate([[0], chance[:-1]]) * differ
    return np.maximum(np.cumsum(chance), 1e-300)


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one per part and -1 or more, that add up to ``total`` at the least cost.

    ``costs[part][threshold + 1]``; solved part by part over the sum reached so far.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for reached, (cost, chosen) in best.items():
            for threshold, extra in enumerate(row, -1):
                entry = (cost + extra, [*chosen, threshold])
                if reached + threshold not in step or entry < step[reached + threshold]:
                    step[reached + threshold] = entry
        best = step
    return best[total]


def part_values(codes: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group``, packed, of each fingerprint."""
    out = np.zeros(len(codes), np.uint64)
    for place, bit in enumerate(group):
        out |= ((codes >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def _bit_counts(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How often two bits are both 1 (64 x 64), summed in Spark; ones on the diagonal."""

    def scan(batches):
        total = np.zeros((64, 64))
        for batch in batches:
            codes = batch.column("fp").to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(codes, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(4096), pa.int32()), pa.array(total.ravel().astype(np.int64))], ["cell", "n"]
        )

    rows = nodes.select("fp").mapInArrow(scan, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    together = np.zeros(4096)
    for row in rows:
        together[row.cell] = row.n
    together = together.reshape(64, 64)
    return together, together.diagonal().copy()


def _keys(nodes: DataFrame, parts: list[tuple[int, list[int], int]]) -> DataFrame:
    """(``part``, ``value``, ``fp``, ``probe``): each fingerprint under its value in every part,
    and as a probe under all values within the part's threshold."""

    def scan(batches):
        for batch in batches:
            codes = batch.column("fp").to_numpy().view(np.uint64)
            for name, group, threshold in parts:
                own = part_values(codes, group)
                for flips in itertools.chain.from_iterable(
                    itertools.combinations(range(len(group)), size) for size in range(threshold + 1)
                ):
                    mask = np.uint64(sum(1 << place for place in flips))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(codes), name, np.int32)),
                            pa.array((own ^ mask).view(np.int64)),
                            batch.column("fp"),
                            pa.array(np.full(len(codes), bool(flips))),
                        ],
                        ["part", "value", "fp", "probe"],
                    )

    return nodes.select("fp").mapInArrow(scan, "part int, value long, fp long, probe boolean")


def plan(nodes: DataFrame, bits: int = BITS) -> list[tuple[int, list[int], int]]:
    """(part, its bits, its threshold) for the parts in use, at the least estimated cost."""
    count = nodes.count()
    together, ones = _bit_counts(nodes)
    splits = {parts: bit_groups(together, ones, count, parts) for parts in PART_COUNTS}
    named = [(100 * parts + place, group, 0) for parts, groups in splits.items() for place, group in enumerate(groups)]
    sizes = _keys(nodes, named).groupBy("part", "value").count()
    pairs = {row.part: row.pairs for row in sizes.groupBy("part").agg(F.sum(F.expr("double(count) * count")).alias("pairs")).collect()}
    best = None
    for parts, groups in splits.items():
        costs = []
        for place, group in enumerate(groups):
            # Pairs that agree exactly are counted; wider radii follow from the bits' shares.
            chance = within(ones, count, group, bits)
            probes = np.cumsum([len(list(itertools.combinations(group, size))) for size in range(bits + 1)])
            found = pairs.get(100 * parts + place, 0) * chance / chance[0]
            costs.append([0.0, *(found + count * probes).tolist()])
        cost, thresholds = allocate(costs, bits - parts + 1)
        if best is None or cost < best[0]:
            best = (cost, [(place, group, held) for place, (group, held) in enumerate(zip(groups, thresholds, strict=True)) if held >= 0])
    return best[1]


def forest(codes: np.ndarray, probe: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of one bucket's links, found in blocks of bounded size."""
    index = codes[~probe]
    parent = list(range(len(codes)))

    def root(node: int) -> int:
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    at = np.flatnonzero(~probe)
    edges = []
    block = max(1, (1 << 20) // max(1, len(index)))
    for start in range(0, len(codes), block):
        near = np.bitwise_count(codes[start : start + block, None] ^ index[None, :]) <= bits
        for left, right in np.argwhere(near):
            a, b = root(start + int(left)), root(int(at[right]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((int(codes[start + left]), int(index[right])))
    return edges


def _verified(rows: DataFrame, bits: int) -> DataFrame:
    """Edges (``u``, ``v``) of all buckets; a task streams over its buckets, sorted by key."""

    def edges_of(part, value, fp, probe):
        cuts = np.flatnonzero((part[1:] != part[:-1]) | (value[1:] != value[:-1])) + 1
        bounds = np.concatenate([[0], cuts, [len(part)]])
        sizes = np.diff(bounds)
        two = bounds[:-1][sizes == 2]
        close = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= bits]
        found = list(zip(fp[close].tolist(), fp[close + 1].tolist(), strict=True))
        for start, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            found += forest(fp[start : start + size], probe[start : start + size], bits)
        pairs = np.array(found, np.uint64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))], ["u", "v"]
        )

    def scan(batches):
        held = None
        for batch in (batch for batch in batches if batch.num_rows):
            now = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("part", "value", "fp", "probe")]
            now[2] = now[2].view(np.uint64)
            if held is not None:
                now = [np.concatenate(pair) for pair in zip(held, now, strict=True)]
            # The last bucket may go on in the next batch.
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            cut = int(np.flatnonzero(last)[0])
            held = [column[cut:] for column in now]
            if cut:
                yield edges_of(*(column[:cut] for column in now))
        if held is not None and len(held[0]):
            yield edges_of(*held)

    ordered = rows.repartition("part", "value").sortWithinPartitions("part", "value")
    return ordered.mapInArrow(scan, "u long, v long")


def _by_midpoints(members: DataFrame) -> DataFrame:
    """Edges among ``members`` within two bits: both are within one bit of a common key."""
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda bit: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))
    keys = members.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("middle"))
    groups = keys.groupBy("middle").agg(F.collect_set("fp").alias("group")).filter("size(group) > 1")
    return groups.select(F.explode("group").alias("u"), F.array_min("group").alias("v")).filter("u <> v").distinct()


def links(nodes: DataFrame, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Edges (``u``, ``v``) between different fingerprints that span every component."""
    rows = _keys(nodes, plan(nodes))
    size = rows.groupBy("part", "value").agg(F.count("*").alias("n")).filter("n > 1")
    rows = stage(rows.join(size, ["part", "value"]), "buckets")
    small = _verified(rows.filter(F.col("n") <= bucket_limit).drop("n"), BITS)
    large = _by_midpoints(rows.filter(F.col("n") > bucket_limit).select("fp").distinct())
    return small.unionByName(large)


def _classes(marked: DataFrame, bucket_limit: int) -> DataFrame:
    """(``fp``, ``root``): the component of each fingerprint, named by its least fingerprint."""
    nodes = stage(marked.select("fp").distinct(), "nodes")
    roots = components(links(nodes, bucket_limit)).withColumnRenamed("u", "fp")
    return nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    bucket_limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """(``doc_id``, ``fp``, ``component_id``): the least id that links reach from each row."""
    marked = stage(fingerprints(docs, id_col, text_col, width), "fingerprints")
    placed = stage(_classes(marked, bucket_limit), "classes")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).join(placed, "fp")
    names = least.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = placed.join(names, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    bucket_limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """All columns of one row per component: a row of the least id, null ids last.

    Rows are told apart by their place, so ``docs`` has to be a table that is read in the same
    order each time, such as files.
    """
    place = unused_name("place", docs.columns)
    numbered = docs.withColumn(place, F.monotonically_increasing_id())
    marked = stage(fingerprints(numbered, place, text_col, width).withColumnRenamed("doc_id", place), "fingerprints")
    ids = numbered.select(place, F.col(id_col).cast("long").alias("id"))
    placed = marked.join(_classes(marked, bucket_limit), "fp").join(ids, place)
    first = F.min(F.struct(F.col("id").isNull(), "id", place)).alias("first")
    winners = stage(placed.groupBy("root").agg(first).select(f"first.{place}"), "kept")
    # The kept rows grow with the documents, so they are not broadcast at any size.
    return numbered.join(winners.hint("merge"), place, "left_semi").drop(place)


def fingerprint_text(column: str = "fp"):
    """16 lower-case hex digits of a signed fingerprint."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
