"""Near-duplicates by exact Jaccard similarity, found with SimHash and rarity-ordered prefixes.

Texts are lower-cased, words are runs of bytes other than white space (0x20, 0x09-0x0D), and a
text is the set of 64-bit hashes of its shingles of ``WIDTH`` consecutive words (a text of fewer
words is one shingle). Two texts link if their sets have a Jaccard similarity of 4/5 or more.

Texts of equal sets are one node. A node's sketch has one bit for each of ``SKETCH_BITS`` hashed
cells: whether its number of shingles there is odd. The bits in which two sketches differ never
outnumber the shingles in which the sets differ, so a pair whose sketches are too far apart is out
without a look at its texts. A node of more shingles than bits has a second sketch, as long in bits
as the set in shingles, for pairs that pass the first. All shingles have one order, the rarer first: shingles are counted
in hashed cells, whose logarithm and then the hash decide. Of n shingles, linked texts miss at most
``n - ceil(0.8 n)`` each, so the first common one is among the first ``n - ceil(0.8 n) + 1`` of
both: no link is missed, whatever the cells hold. They only keep lines that many texts share
out of the prefixes. Candidates are verified by their whole sets. The first come from ``simhash``:
nodes of equal fingerprints and the links of its search. It misses pairs whose fingerprints are
further apart, so nodes that share a prefix shingle, may link by sizes and places, and are not yet in
one component follow: first each with one leader, the one of most of its shingles' groups, and then,
where a group still has several components, those outside its largest one with all other members.

Defined cases: null is an empty text; texts without words link with each other; null ids come last;
an empty table gives an empty table; other columns are kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm import simhash
from marginalia.llm.components import components, joined
from marginalia.llm.text import flat, gram_hashes, mix, steps, unused_name, word_hashes
from marginalia.storage import discard, stage

WIDTH = 5
# Cells of the shingle counts: one per ``PER_CELL`` shingles, within these powers of two.
PER_CELL, CELL_BITS = 16, (12, 24)
# A task reports cells with this many shingles more than so many times its average.
NOTABLE = 4
CELL_ROWS = 1 << 18
# Bits of a node's first sketch, and leaders a node is verified with first.
SKETCH_BITS, LEADERS = 512, 3
# Draws of members before all pairs left are tried, and pairs per row that are not worth a draw.
DRAWS, FEW = 2, 4
# Names of texts that a task remembers.
SEEN = 1 << 18

WORD_BYTE = ~np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The different shingle hashes of all rows, sorted in each, and where each row begins."""
    raw, offsets = flat(pc.utf8_lower(pc.fill_null(texts, "")))
    words, rows, _ = word_hashes(raw, offsets, WORD_BYTE)
    sizes = np.bincount(rows, minlength=len(texts))
    hashes, owners = gram_hashes(words, rows, WIDTH)
    found = [(hashes, owners)]
    for width in range(1, WIDTH):
        short = sizes[rows] == width
        found.append(gram_hashes(words[short], rows[short], width))
    hashes, owners = (np.concatenate(column) for column in zip(*found, strict=True))
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[new], owners[new]
    return hashes, np.searchsorted(owners, np.arange(len(texts) + 1))


def nodes_of(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One 64-bit name per row, the same for equal sets."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)]) for part in (hashes, mix(~hashes))]
    first, second = (part[starts[1:]] - part[starts[:-1]] for part in sums)
    return mix(first + mix(second + np.diff(starts).astype(np.uint64))).view(np.int64)


def sketches_of(hashes: np.ndarray, starts: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parity of the shingles in each of a row's ``bits`` cells (0 or multiples of 64), 64 to a
    long, and each row's first long. Halves of a sketch fold into that of half as many bits."""
    wide = np.repeat(bits, np.diff(starts))
    used = wide > 0
    cells = (mix(hashes[used]) >> np.uint64(24)).astype(np.int64) % wide[used]
    first = np.concatenate([[0], np.cumsum(bits)])
    cells += np.repeat(first[:-1], np.diff(starts))[used]
    odd = np.bincount(cells, minlength=first[-1]) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64), first // 64


def long_bits(sizes: np.ndarray) -> np.ndarray:
    """Bits of the second sketch: the least power of two that is the size or more, 0 for small sets."""
    return np.where(sizes > SKETCH_BITS, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64), 0)


def prefix_places(hashes: np.ndarray, starts: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle, row and place in the row's order of all prefix shingles."""
    sizes = np.diff(starts)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((hashes, ranks[(hashes & np.uint64(len(ranks) - 1)).astype(np.int64)], rows))
    places = np.arange(len(hashes)) - starts[rows]
    taken = places < (sizes - (4 * sizes + 4) // 5 + 1)[rows]
    return hashes[order][taken], rows[taken], places[taken]


def _sets(source: DataFrame, columns: list[str], schema: str, work) -> DataFrame:
    """``work(part, hashes, starts)`` gives the ``columns`` of each slice of ``source``."""

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "text"):
                yield pa.RecordBatch.from_arrays(work(part, *shingle_sets(part.column("text"))), columns)

    return source.mapInArrow(scan, schema)


def _ranks(source: DataFrame, total: int) -> np.ndarray:
    """Logarithm of the shingles counted in each cell; summed in Spark."""
    bits = min(max(math.ceil(math.log2(max(total, 1) / PER_CELL + 1)), CELL_BITS[0]), CELL_BITS[1])
    cells = 1 << bits

    def scan(batches):
        counts = np.zeros(cells, np.int64)
        for batch in batches:
            for part in steps(batch, "text"):
                hashes, _ = shingle_sets(part.column("text"))
                used, times = np.unique(hashes & np.uint64(cells - 1), return_counts=True)
                counts[used.astype(np.int64)] += times
        used = np.flatnonzero(counts >= NOTABLE * (1 + counts.sum() / cells))
        for start in range(0, len(used), CELL_ROWS):
            some = used[start : start + CELL_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["cell", "n"])

    sums = source.mapInArrow(scan, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(cells)
    counts[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    # What cells hold on average says nothing about a shingle.
    return np.log2(np.maximum(counts / (4 * PER_CELL + 4 * total / cells), 1)).astype(np.uint8)


def _prefixes(source: DataFrame, ranks: np.ndarray) -> DataFrame:
    """(``shingle``, ``node``, ``n``, ``at``) of the prefixes of all nodes that share a shingle there."""
    shared = source.sparkSession.sparkContext.broadcast(ranks)

    def scan(batches):
        # Copies that one task meets are sent once, so that copies of one text are no hot keys.
        seen: set[int] = set()
        for batch in batches:
            for part in steps(batch, "text"):
                hashes, starts = shingle_sets(part.column("text"))
                nodes = nodes_of(hashes, starts)
                fresh = np.zeros(len(nodes), bool)
                for row, node in enumerate(nodes.tolist()):
                    if node not in seen:
                        seen.add(node)
                        fresh[row] = True
                shingles, rows, places = prefix_places(hashes, starts, shared.value)
                taken = fresh[rows]
                rows = rows[taken]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shingles[taken].view(np.int64)),
                        pa.array(nodes[rows]),
                        pa.array(np.diff(starts)[rows].astype(np.int32)),
                        pa.array(places[taken].astype(np.int32)),
                    ],
                    ["shingle", "node", "n", "at"],
                )
                if len(seen) > SEEN:
                    seen.clear()

    rows = source.mapInArrow(scan, "shingle long, node long, n int, at int")
    # One shuffle serves the removal of copies and the groups.
    rows = rows.repartition("shingle").dropDuplicates(["shingle", "node"])
    group = Window.partitionBy("shingle")
    leader = F.min(F.struct(F.xxhash64("node").alias("deal"), "node", "n", "at")).over(group)
    rows = rows.select("*", F.count("*").over(group).alias("members"), leader.alias("leader"))
    return stage(rows.filter("members > 1").drop("members"), "groups")


def _may_link(n: str, at: str, other_n: str, other_at: str):
    """If the shingle is their first common one, all common ones are at or behind its places."""
    return F.expr(f"9L * least({n} - {at}, {other_n} - {other_at}) >= 4L * ({n} + {other_n})")


def _alike(n: str, sketch: str, other_n: str, other_sketch: str):
    """Linked sets differ in a ninth of both sizes at most, and sketches in no more bits."""
    bits = " + ".join(f"bit_count({sketch}[{i}] ^ {other_sketch}[{i}])" for i in range(SKETCH_BITS // 64))
    return F.expr(f"9L * ({bits}) <= {n} + {other_n}")


def _alike_long(n: str, sketch: str, other_n: str, other_sketch: str):
    """The same by the second sketches, the longer one folded; sets that lack one pass."""

    def folded(name: str, other: str) -> str:
        half = f"size({name}) div 2"
        halves = f"slice({name}, 1, cast({half} as int)), slice({name}, cast({half} + 1 as int), cast({half} as int))"
        return f"if(size({name}) = 2 * size({other}), zip_with({halves}, (x, y) -> x ^ y), {name})"

    differing = f"zip_with({folded(sketch, other_sketch)}, {folded(other_sketch, sketch)}, (x, y) -> bit_count(x ^ y))"
    total = f"aggregate({differing}, 0L, (sum, x) -> sum + x)"
    return F.expr(f"size({sketch}) = 0 OR size({other_sketch}) = 0 OR 9L * {total} <= {n} + {other_n}")


def _verified(pairs: DataFrame, numbered: DataFrame, keys: DataFrame, sketches: DataFrame, place: str) -> DataFrame:
    """The ``pairs`` (``u``, ``v``) whose whole sets have a Jaccard similarity of 4/5 or more."""
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    own, other = (sketches.select("node", "n", "long").toDF(*names) for names in (("u", "n", "long"), ("v", "m", "other")))
    pairs = pairs.join(own, "u").join(other, "v").filter(_alike_long("n", "long", "m", "other"))
    pairs = stage(pairs.select("u", "v"), "pairs")
    if pairs.isEmpty():
        return pairs
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    chosen = keys.join(wanted, "node").groupBy("node").agg(F.min(place).alias(place))
    source = numbered.select(place, "text").join(chosen.hint("merge"), place).select("node", "text")

    # Texts are compressed where they are shuffled and written, which hashes cannot be.
    texts = stage(source, "texts")
    both = pairs.join(texts.selectExpr("node AS u", "text AS a"), "u").join(texts.selectExpr("node AS v", "text AS b"), "v").select("u", "v", "a", "b")

    def scan(batches):
        for batch in batches:
            for part in steps(batch, "a"):
                sets = [shingle_sets(part.column(name)) for name in ("a", "b")]
                sizes = sum(np.diff(starts) for _, starts in sets)
                hashes = np.concatenate([values for values, _ in sets])
                rows = np.concatenate([np.repeat(np.arange(part.num_rows), np.diff(starts)) for _, starts in sets])
                order = np.lexsort((hashes, rows))
                hashes, rows = hashes[order], rows[order]
                twice = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
                common = np.bincount(rows[1:][twice], minlength=part.num_rows)
                yield part.select(["u", "v"]).filter(pa.array(9 * common >= 4 * sizes))

    links = stage(both.mapInArrow(scan, "u long, v long"), "links")
    discard(pairs)
    discard(texts)
    return links


def _mixed(groups: DataFrame, sketches: DataFrame, roots: DataFrame) -> tuple[DataFrame, int, int]:
    """Members of the groups that several components share, with the ``root`` of each and that of the
    group's largest one (``main``); the pairs of those outside of it with all members; the rows."""
    placed = groups.join(roots.withColumnRenamed("u", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = stage(placed.groupBy("shingle", "root").agg(F.count("*").alias("size")), "sizes")
    main = sizes.groupBy("shingle").agg(
        F.max(F.struct("size", "root")).alias("most"), F.sum("size").alias("all"), F.count("*").alias("several")
    )
    main = main.filter("several > 1").select("shingle", F.col("most.root").alias("main"), "all", F.col("most.size").alias("size"))
    left = main.agg(F.sum(F.expr("cast(all AS decimal(38, 0)) * (all - size)")).alias("full"), F.sum("all").alias("rows")).first()
    members = placed.join(main.select("shingle", "main"), "shingle").join(sketches.select("node", "sketch"), "node")
    members = stage(members, "mixed")
    discard(sizes)
    return members, int(left.full or 0), int(left.rows or 0)


def _drawn(members: DataFrame, draw: int) -> DataFrame:
    """Each member outside its group's largest component with a few members of that."""
    said = F.struct("node", "n", "at", "sketch")
    some = [
        F.min(F.struct(F.xxhash64("node", F.lit(draw), F.lit(number)).alias("deal"), said.alias("said"))) for number in range(LEADERS)
    ]
    chosen = members.filter("root = main").groupBy("shingle").agg(F.array_distinct(F.array(*some)).alias("some"))
    chosen = chosen.select("shingle", F.explode("some.said").alias("said"))
    chosen = chosen.selectExpr("shingle", "said.node AS v", "said.n AS m", "said.at AS to", "said.sketch AS other")
    met = members.filter("root <> main").join(chosen, "shingle").filter(_may_link("n", "at", "m", "to"))
    return met.filter(_alike("n", "sketch", "m", "other")).select(F.col("node").alias("u"), "v")


def _left(members: DataFrame) -> DataFrame:
    """Each member outside its group's largest component with all members of others."""
    rest = members.filter("root <> main").selectExpr("shingle", "node AS v", "root AS w", "n AS m", "at AS to", "sketch AS other")
    left = members.join(rest, "shingle").filter("root <> w").filter(_may_link("n", "at", "m", "to"))
    return left.filter(_alike("n", "sketch", "m", "other")).select(F.col("node").alias("u"), "v")


def _fingerprinted(numbered: DataFrame, keys: DataFrame, place: str) -> DataFrame:
    """Pairs (``u``, ``v``) of different nodes that span the components of the SimHash search: one
    node of a fingerprint with its others, and such nodes of linked fingerprints."""
    # Equal sets have equal texts but for repeats of shingles: one row of each node is enough.
    rows = keys.groupBy("node").agg(F.min(place).alias(place))
    some = numbered.select(place, "text").join(rows.hint("merge"), place)
    marked = stage(simhash.fingerprints(some, "node", "text", WIDTH).toDF("node", "fp"), "fingerprints")
    firsts = stage(marked.groupBy("fp").agg(F.min("node").alias("first")), "firsts")
    equal = marked.join(firsts, "fp").filter("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    own, other = (firsts.toDF(*names) for names in (("u", "a"), ("v", "b")))
    linked = simhash.links(firsts.select("fp")).join(own, "u").join(other, "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return stage(equal.unionByName(linked), "near")


def _roots(numbered: DataFrame, keys: DataFrame, place: str) -> DataFrame:
    """(``u``, ``root``): the least node of its component for every node that has a smaller one.

    Links that are found later join the components of those before, and where none are found, or no
    group has several components left, nothing more is run: each step costs the driver a plan.
    """
    source = numbered.select("text")
    total = keys.agg(F.sum("n")).first()[0] or 0
    groups = _prefixes(source, _ranks(source, total))
    # Equal sets have equal sketches.
    sketches = keys.dropDuplicates(["node"]).select("node", "n", "sketch", "long")
    # Only nodes that share a prefix shingle are looked at from here on.
    held = groups.select("node").distinct()
    sketches = stage(sketches.join(held.hint("merge"), "node"), "sketches")
    own, other = (sketches.drop("long").toDF(*names) for names in (("u", "n", "sketch"), ("v", "m", "other")))
    near = _fingerprinted(numbered, keys, place)
    alike = near.join(own, "u").join(other, "v").filter(_alike("n", "sketch", "m", "other")).select("u", "v")
    links = _verified(alike, numbered, keys, sketches, place)
    discard(near)
    # Whatever fingerprints have joined needs no further look.
    roots = components(links)
    led = groups.filter("node <> leader.node").filter(_may_link("n", "at", "leader.n", "leader.at"))
    led = led.groupBy(F.col("node").alias("u"), F.col("leader.node").alias("v")).agg(F.count("*").alias("times"))
    first, second = (roots.toDF(*names) for names in (("u", "of_u"), ("v", "of_v")))
    led = led.join(first, "u", "left").join(second, "v", "left")
    led = led.filter(F.coalesce("of_u", "u") != F.coalesce("of_v", "v")).select("u", "v", "times")
    led = led.join(own, "u").join(other, "v").filter(_alike("n", "sketch", "m", "other"))
    # A node has no more leaders than prefix shingles.
    most = F.slice(F.sort_array(F.collect_list(F.struct("times", "v")), asc=False), 1, LEADERS)
    led = led.groupBy("u").agg(most.alias("most")).select("u", F.explode("most.v").alias("v"))
    roots = joined(roots, _verified(led, numbered, keys, sketches, place))

    for draw in range(DRAWS + 1):
        members, full, rows = _mixed(groups.drop("leader"), sketches, roots)
        if draw == DRAWS or full <= FEW * rows:
            break
        found = _verified(_drawn(members, draw), numbered, keys, sketches, place)
        discard(members)
        roots = joined(roots, found)
    if full:
        roots = joined(roots, _verified(_left(members), numbered, keys, sketches, place))
    for table in (groups, sketches, members):
        discard(table)
    return roots


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of one row per component: a row of the least id, null ids last.

    Rows are told apart by their place, so ``docs`` has to be a table that is read in the same
    order each time, such as files.
    """
    place = unused_name("place", docs.columns)
    numbered = docs.withColumn(place, F.monotonically_increasing_id())
    narrow = "place"
    source = numbered.select(F.col(place).alias(narrow), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def work(part, hashes, starts):
        sizes = pa.array(np.diff(starts).astype(np.int32))
        lists = []
        for bits in (np.full(part.num_rows, SKETCH_BITS), long_bits(np.diff(starts))):
            longs, firsts = sketches_of(hashes, starts, bits)
            lists.append(pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), longs))
        return [part.column(narrow), part.column("id"), pa.array(nodes_of(hashes, starts)), sizes, *lists]

    schema = f"{narrow} long, id long, node long, n int, sketch array<long>, long array<long>"
    keys = stage(_sets(source, [narrow, "id", "node", "n", "sketch", "long"], schema, work), "keys")
    roots = _roots(source, keys, narrow).withColumnRenamed("u", "node")
    placed = keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.min(F.struct(F.col("id").isNull(), "id", narrow)).alias("first")
    winners = stage(placed.groupBy("root").agg(first).select(F.col(f"first.{narrow}").alias(place)), "kept")
    discard(keys)
    # The kept rows grow with the documents, so they are not broadcast at any size.
    return numbered.join(winners.hint("merge"), place, "left_semi").drop(place)
