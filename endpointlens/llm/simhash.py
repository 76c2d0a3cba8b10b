"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into segments of 4 bits and mapped to their bit counts, a point in a 16-dimensional grid.
One differing bit moves one coordinate by one, so the Manhattan distance of two points is a lower bound of the
Hamming distance of their fingerprints. The grid range-join: every distinct fingerprint enters its own cell and the
cells one step away, and two fingerprints at Manhattan distance 2 or less always meet in a cell. Candidates are then
verified on the fingerprints themselves. Members of a cell of more than `crowd` go through a finer grid, of segments
of 2 bits and then of 1 bit, where the same bound holds and a cell can't hold more than 65 fingerprints; so pairs come
from bounded cells alone, however many fingerprints there are, and none is left out. Equal fingerprints are one node.

`near_duplicates` links documents at 2 or fewer differing bits. `similar_documents` links them by the share of common
shingles: two texts of Jaccard 0.8 differ in some ten bits of a plain fingerprint, which no grid can search, so it
uses `draws` fingerprints whose shingles weigh 1 / u, u a random number of the shingle and the draw. The few heaviest
shingles decide such a fingerprint: two texts of Jaccard 0.8 are within two bits in a draw with a chance of 0.44, and
in one of eight with a chance of 0.99. Candidates pass by their plain fingerprints, then by their exact shingle sets. Texts
of one fingerprint meet the smallest of them; where a group's members aren't alike, those that share two draws meet
the smallest of theirs, so candidates grow with the rows, not with the square of a group.

Defined results: fewer words than a shingle make one shingle of the whole sequence; no words (or null) give
fingerprint zero, which links like any other. Ties of the bit vote (exactly half) give 0. Repeated ids are rows of
their own; each gets the component of its own fingerprint. A null id is larger than all others; a component of null
ids alone has a null id. Other columns are not returned. Long texts are fingerprinted in bounded memory beside their
words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, forget, settled, written


def shingle_hashes(text: str | None, words: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased (A-Z) text, repeats included."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(tokens) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist())), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is 1 if more than half of the hashes have it; signed, as Spark's long holds it."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):  # bounded memory on very long texts
        part = np.unpackbits(hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += part.sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """docs' other columns and `fp` (long)."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(shingle_hashes(t, words, seed)) for t in texts], dtype="int64")

    return docs.withColumn("fp", fp(text)).drop(text)


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """Random-looking 64-bit numbers of 64-bit numbers."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """XXH64 of each word, kept until there are `most` of them."""

    def __init__(self, seed: int, most: int = 300_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return made


def distinct_shingles(text: str | None, words: int, known: WordHashes) -> np.ndarray:
    """A 64-bit number of each distinct shingle, sorted: the hashes of its words times an odd factor for each place."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), known.seed)] if tokens else [], np.uint64)
    hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    n = len(tokens) - words + 1
    total = np.zeros(n, np.uint64)
    for k, factor in enumerate(mixed(np.arange(words, dtype=np.uint64), 1) | np.uint64(1)):
        total += hashes[k : k + n] * factor
    return np.unique(mixed(total, 0))


def votes_of_draws(hashes: np.ndarray, draws: int, block: int = 400) -> np.ndarray:
    """The plain fingerprint, then one a draw: the shingles vote with weight 1 / u, u uniform by shingle and draw.

    All votes of a block are one product of weights and bits, small enough for one thread and in bounded memory.
    """
    factors = mixed(np.arange(draws, dtype=np.uint64), 2)[:, None] | np.uint64(1)
    votes = np.zeros((draws + 1, 64))
    for at in range(0, len(hashes), block):
        part = hashes[at : at + block]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        weight = np.ones((draws + 1, len(part)), np.float32)
        weight[1:] = np.float32(1 << 24) / (((part * factors) >> np.uint64(40)).astype(np.float32) + np.float32(0.5))
        votes += 2 * (weight @ bits).astype(np.float64) - weight.sum(1, dtype=np.float64)[:, None]
    return np.packbits(votes > 0, axis=1, bitorder="little").view("<i8")[:, 0]


def embed(fps: np.ndarray, width: int) -> np.ndarray:
    """The bit counts of the segments of `width` (1, 2 or 4) bits, each in the place of its segment."""
    x = fps.view(np.uint64)
    if width >= 2:
        x = x - ((x >> np.uint64(1)) & np.uint64(0x5555555555555555))
    if width >= 4:
        x = (x & np.uint64(0x3333333333333333)) + ((x >> np.uint64(2)) & np.uint64(0x3333333333333333))
    return x


def cells_of(fps: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the fingerprint, cell): the own cell and the cells one step away."""
    own = embed(fps, width)[:, None]
    shifts = np.arange(0, 64, width, dtype=np.uint64)
    counts, steps = (own >> shifts) & np.uint64((1 << width) - 1), np.uint64(1) << shifts
    every = np.concatenate([own, own + steps, own - steps], 1)
    row, column = np.nonzero(np.concatenate([np.ones(own.shape, bool), counts < width, counts > 0], 1))
    return row, every[row, column].view(np.int64)


def spread(points: DataFrame, width: int) -> DataFrame:
    """(draw, fp, cell): the cells that each fingerprint of `points` (draw, fp) enters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            draws, fps = np.asarray(b.column(0), np.int32), np.asarray(b.column(1), np.int64)
            for k in range(0, len(fps), 4096):
                row, cell = cells_of(fps[k : k + 4096], width)
                yield pa.RecordBatch.from_arrays([pa.array(draws[k : k + 4096][row]), pa.array(fps[k : k + 4096][row]), pa.array(cell)], names=["draw", "fp", "cell"])

    return points.select(F.col("draw").cast("int"), "fp").mapInArrow(run, "draw int, fp long, cell long")


def hamming_links(points: DataFrame, crowd: int = 32) -> DataFrame:
    """(draw, a, b): the pairs of distinct fingerprints of a draw that differ in 2 or fewer bits."""
    found = []
    close = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= 2
    for width in (4, 2, 1):
        # most cells hold one fingerprint, so all of them are shuffled once: the counts and the members read one exchange
        cells = spread(points, width).repartition("draw", "cell")
        met = cells.groupBy("draw", "cell").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where((F.col("n") > 2) | ((F.col("n") == 2) & close("a", "b")))
        # a cell of two holds its smallest and its largest member, so only cells of three or more are joined
        members = cells.join(met.hint("shuffle_hash"), ["draw", "cell"]).where("n > 2 or fp = a").select("draw", "cell", "fp", "n", F.when(F.col("n") == 2, F.col("b")).alias("other"))
        shared = settled(members, "shared-cells")
        few = shared.where((F.col("n") > 2) & (F.col("n") <= crowd if width > 1 else F.lit(True)))
        x, y = few.select("draw", "cell", F.col("fp").alias("a")), few.select("draw", "cell", F.col("fp").alias("b"))
        pairs = x.join(y, ["draw", "cell"]).where((F.col("a") < F.col("b")) & close("a", "b")).select("draw", "a", "b")
        found.append(settled(pairs.unionByName(shared.where("n = 2").select("draw", F.col("fp").alias("a"), F.col("other").alias("b"))).distinct(), "grid-links"))
        if width > 1:
            points = settled(shared.where((F.col("n") > 2) & (F.col("n") > crowd)).select("draw", "fp").distinct(), "crowded")
        forget(shared)
        if width > 1 and points.isEmpty():
            break
    return reduce(DataFrame.unionByName, found).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of `edges` (a, b) can reach, roots excluded.

    Alternates large-star (link larger neighbours to the smallest one) and small-star (link the rest to it) until
    nothing changes, which it must: every round but the last moves a link to a smaller node. A node's links are only
    ever aggregated by min, never listed. Rounds grow with the logarithm of the longest path; each is checkpointed.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = checkpointed(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        # settled when every node has one link and no target has links of its own
        ends = new.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            new.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        )
        ends = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        edges = new
        if ends.where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1))).isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42, crowd: int = 32) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id reachable over links of 2 bits or fewer."""
    marked = written(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", words, seed), "fingerprints")
    fps = marked.groupBy("fp").agg(F.min("doc_id").alias("node"))
    roots = components(hamming_links(fps.select(F.lit(0).alias("draw"), "fp"), crowd).select("a", "b"))
    placed = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = placed.groupBy("root").agg(F.min("node").alias("component_id"))
    return marked.join(placed.select("fp", "root").join(smallest, "root"), "fp").select("doc_id", "fp", "component_id")


def marks(docs: DataFrame, words: int, draws: int, seed: int) -> DataFrame:
    """docs (row, text) as (row, same, plain, fps): a digest of the words, the plain and the weighted fingerprints."""

    known = WordHashes(seed)

    @F.pandas_udf("struct<same:binary,plain:long,fps:array<long>>")
    def mark(texts: pd.Series) -> pd.DataFrame:
        out = {"same": [], "plain": [], "fps": []}
        for t in texts:
            made = votes_of_draws(distinct_shingles(t, words, known), draws)
            out["same"].append(xxhash.xxh3_128_digest(b" ".join(t.encode("utf-8", "surrogatepass").lower().split()) if t else b""))
            out["plain"].append(int(made[0]))
            out["fps"].append(made[1:])
        return pd.DataFrame(out)

    return docs.select("row", mark("text").alias("m")).select("row", "m.same", "m.plain", "m.fps")


def similar_documents(docs: DataFrame, row: str = "row", text: str = "text", words: int = 5, similarity: float = 0.8, draws: int = 8, seed: int = 42, crowd: int = 32, spare: int = 20) -> DataFrame:
    """(row, group): group is the smallest row reachable over links of texts that share `similarity` of their shingles.

    row: a distinct long for each row. spare: the differing bits of the plain fingerprints above which a pair isn't
    looked at; 20 are some four deviations from what Jaccard 0.8 gives.
    """
    docs = docs.select(F.col(row).alias("row"), F.col(text).alias("text"))
    marked = written(marks(docs, words, draws, seed), "marks")
    texts = written(marked.groupBy("same").agg(F.min(F.struct("row", "plain", "fps")).alias("m")).select("same", "m.*"), "distinct-marks")
    drawn = texts.select(F.col("row").alias("node"), "plain", F.posexplode("fps").alias("draw", "fp"))
    # texts with one fingerprint in a draw meet the smallest of them, and so do the groups of the grid's links
    heads = written(drawn.groupBy("draw", "fp").agg(F.min(F.struct("node", "plain")).alias("head"), F.count("*").alias("n")), "heads")
    stars = drawn.join(heads.where("n > 1"), ["draw", "fp"]).select("draw", "fp", F.col("head.node").alias("a"), F.col("node").alias("b"), F.col("head.plain").alias("pa"), F.col("plain").alias("pb")).where("a <> b")
    # two draws at a time: cells and their shuffles take disk in proportion to the fingerprints that go through the grid
    links = reduce(DataFrame.unionByName, [hamming_links(heads.where(F.col("draw").between(k, k + 1)).select("draw", "fp"), crowd) for k in range(0, draws, 2)])
    one, two = (heads.select("draw", F.col("fp").alias(c), F.col("head.node").alias(f"n{c}"), F.col("head.plain").alias(f"p{c}")) for c in ("a", "b"))
    met = links.join(one, ["draw", "a"]).join(two, ["draw", "b"]).select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"), "pa", "pb")
    close = F.bit_count(F.col("pa").bitwiseXOR(F.col("pb"))) <= spare
    first = settled(stars.select("a", "b", "pa", "pb").unionByName(met).where(close).select("a", "b").distinct(), "candidates")
    edges = alike(docs, first, words, similarity, seed)
    # the texts of a group with members that aren't like its head meet the smallest of those that share two draws
    mixed_groups = stars.join(edges, ["a", "b"], "left_anti").select("draw", "fp").distinct()
    members = settled(drawn.join(mixed_groups, ["draw", "fp"], "left_semi").select("node").distinct(), "members")
    pairs_of = [(k, m) for m in range(draws) for k in range(m)]
    twice = texts.withColumnRenamed("row", "node").join(members, "node", "left_semi").select(
        "node", "plain", F.explode(F.array(*[F.xxhash64(F.lit(k * draws + m), F.col("fps")[k], F.col("fps")[m]) for k, m in pairs_of])).alias("key")
    )
    tops = twice.groupBy("key").agg(F.min(F.struct("node", "plain")).alias("head"), F.count("*").alias("n")).where("n > 1")
    again = twice.join(tops, "key").where((F.col("node") > F.col("head.node")) & (F.bit_count(F.col("plain").bitwiseXOR(F.col("head.plain"))) <= spare))
    again = again.select(F.col("head.node").alias("a"), F.col("node").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    edges = edges.unionByName(alike(docs, settled(again, "candidates"), words, similarity, seed))
    groups = texts.select("same", F.col("row").alias("node")).join(components(edges), "node", "left").select("same", F.coalesce("root", "node").alias("group"))
    return marked.select("row", "same").join(groups, "same").select("row", "group")


def alike(docs: DataFrame, pairs: DataFrame, words: int, similarity: float, seed: int) -> DataFrame:
    """The pairs (a, b) of rows whose shingle sets have a Jaccard similarity of `similarity` or more."""

    known = WordHashes(seed)

    @F.pandas_udf("array<long>")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([distinct_shingles(t, words, known).view(np.int64) for t in texts])

    asked = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    sets = written(docs.join(asked, "row", "left_semi").select("row", shingles("text").alias("s")), "shingle-sets")
    both = pairs.join(sets.select(F.col("row").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("row").alias("b"), F.col("s").alias("sb")), "b")
    common, sizes = F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb")
    made = settled(both.where(common >= similarity * (sizes - common)).select("a", "b"), "alike")
    forget(sets)
    return made
