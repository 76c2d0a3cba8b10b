"""Language-model scores from a probabilistic suffix tree over words.

A context is a string of words seen `least` times or more in the training texts; it is a node if a divergence test
says that what follows it differs from what follows its own suffix. A node's distribution gives the discounted
frequency to each follower that is seen `least` times with the context, and shares the rest in proportion to the
suffix's distribution; the root is the smoothed word frequency. A word is scored in the state of the longest suffix
of its past that is a node. Contexts grow by one word a round until none passes the test, up to `depth` words.

A context with one follower alone needs no look: every longer context then has that follower alone too, is as
frequent with it as without, and can't diverge. So copies of long passages don't make the tree grow.

The tree grows with the corpus, so no process ever holds it: nothing is broadcast or collected but totals. Texts are
held in blocks of about `block_tokens` words, in a bucketed table that no round shuffles. A block sends the 64-bit keys
of its strings, each once, packed by key range; the range adds up what all blocks sent and tells each block those of
its keys that are frequent. What a round tells goes to a table in the same buckets, so that later rounds read it where
the blocks are. The same way, a round adds up what the followers of each context come to, from which the
range makes the context's test and weight. A string is added up in the smallest block that has it. No join sees a
row per token.

Defined results: null or empty text is the end symbol alone. Without training text every base score is 0 and the
tree is its root. Repeated ids are texts of their own; other columns are not returned. A null id stays null; ids
that aren't whole numbers are cast to long. A text is never split, so a very long one takes memory in proportion.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import holding, shared_dir

#: No word holds white space, so this names the end symbol alone.
END = b" end "
SMOOTH = 0.1
BLOCK = "block long, tokens long, ids binary, lengths binary, held binary, codes binary, hashes binary"
ANSWER = "block long, kind int, at int, values binary, first binary, distinct long, own long"


def encode_block(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(tokens per text with its end, codes, words by code); code 0 is the end, which closes every text."""
    texts = texts.take(pa.array(np.arange(len(texts))))  # a compact copy: the string kernels below misread slices
    low = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    split = pc.ascii_split_whitespace(low)
    lengths = np.where(pc.equal(low, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(split).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = split.flatten()
    coded = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
    words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    ends = np.cumsum(lengths)
    codes = np.insert(words, ends, 0).astype(np.int32)
    return lengths + 1, codes, [END, *(w.encode("utf-8", "surrogatepass") for w in coded.dictionary.to_pylist())]


def to_blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """docs (doc_id long, held boolean, text) as blocks of consecutive rows."""
    most_bytes = 6 * block_tokens

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(sizes // most_bytes, prepend=0, append=-1)) if b.num_rows else []
            for start, stop in zip([0, *cuts], cuts):
                if stop <= start:
                    continue
                piece = b.slice(start, stop - start)
                lengths, codes, words = encode_block(piece.column(2))
                hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
                row = {
                    "block": (part << 32) | k, "tokens": len(codes), "lengths": lengths.tobytes(), "hashes": hashes.tobytes(),
                    "ids": piece.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False).tobytes(),
                    "held": np.asarray(piece.column(1).cast(pa.uint8()), np.uint8).tobytes(), "codes": squeezed(codes, 3),
                }
                yield pa.RecordBatch.from_pylist([row], BLOCK_ARROW)
                k += 1

    return docs.mapInArrow(build, BLOCK)


BLOCK_ARROW = pa.schema([("block", pa.int64()), ("tokens", pa.int64()), *((c, pa.binary()) for c in ("ids", "lengths", "held", "codes", "hashes"))])


def in_buckets(rows: DataFrame, buckets: int, name: str) -> DataFrame:
    """A row a block, written to the shared folder in buckets of its id, so that joins on it leave rows where they are."""
    spark, name = rows.sparkSession, f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    with holding(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        rows.write.bucketBy(buckets, "block").option("path", path).option("compression", "none").saveAsTable(name)
    made = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay until they are forgotten
    return made


@cache
def compressor(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level)


@cache
def decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def squeezed(a: np.ndarray, level: int = 1) -> bytes:
    """Compressed, byte by byte of the numbers."""
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else np.zeros(0, np.uint8)
    return compressor(level).compress(np.ascontiguousarray(planes).tobytes())


def spread(a: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(decompressor().decompress(a), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as their steps."""
    return squeezed(np.diff(keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(spread(data, np.uint64), dtype=np.uint64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys (uint64) in order, the first place of each, each key's place among them).

    Plain numbers sort several times faster than places by a key, so the places lie in the low bits of what is sorted.
    """
    low = np.uint64((1 << max(len(keys) - 1, 0).bit_length()) - 1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    found = keys[order]
    if (found[1:] < found[:-1]).any():  # keys that differ in the low bits alone
        order = np.argsort(keys, kind="stable")
        found = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = found[1:] != found[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return found[new], order[new], place


def longer(strings: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys (uint64) of strings with a word appended."""
    x = strings * np.uint64(0x9E3779B97F4A7C15) + ((words << np.uint64(31)) | (words >> np.uint64(33)))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def rest_factor(above: np.ndarray, entries: np.ndarray, n: np.ndarray, gain: np.ndarray, low: np.ndarray, discount: float, strict: float) -> np.ndarray:
    """For each context, the factor of its suffix's distribution; nan where the divergence test fails.

    above: how often the context is seen; entries, n, gain, low: over its frequent followers, their number, their
    counts, count * log(frequency / suffix's probability) and the suffix's probability, each summed.
    """
    left = np.clip(1 - n / above, 0, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        other = np.where(left > 0, above * left * np.log(left / np.clip(1 - low, 1e-12, 1)), 0.0)
        node = (entries > 0) & (2 * (gain + other) > entries + strict * np.sqrt(2 * entries))
    spare = 1 - (n - discount * entries) / above
    return np.where(node, np.clip(spare, 1e-12, 1) / np.clip(1 - low, 1e-12, 1), np.nan)


class Strings:
    """The frequent strings of one length that end at tokens of a block.

    at: the tokens; keys; counts in all training texts; above: counts of the strings without their last word
    (of a word: a number above all counts); added: the one token of each string that this block adds up.
    """

    def __init__(self, at: np.ndarray, keys: np.ndarray, counts: np.ndarray, above: np.ndarray, added: np.ndarray):
        self.at, self.keys, self.counts, self.above, self.added = at, keys, counts, above, added

    def where(self, keep: np.ndarray) -> "Strings":
        keep = np.flatnonzero(keep)
        return Strings(self.at[keep], self.keys[keep], self.counts[keep], self.above[keep], self.added[keep])


class Block:
    """A row of the block table with what the key ranges told it.

    An answer has a value for each distinct key that the block asked for, in the order of the keys: kind 2 n holds
    counts of strings of n words (0: rare), kind 2 n + 1 weights of contexts of n words (nan: no node).
    """

    def __init__(self, row: dict, tokens: int, distinct: int, least: int, discount: float):
        self.least, self.discount = least, discount
        self.ids, self.lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int64)
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.codes, self.hashes = spread(row["codes"], np.int32), np.frombuffer(row["hashes"], np.uint64)
        self.told: dict[int, list] = {}
        told = [r for rows in row.get("told") or [] for r in rows]
        for r in sorted(told, key=lambda r: r["at"]):
            self.told.setdefault(r["kind"], []).append(r)
        self.words = self.hashes[self.codes]
        self.before = np.arange(len(self.codes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.train = np.repeat(~self.held, self.lengths)  # which tokens are of training texts
        self.totals = np.zeros(len(self.hashes), np.int64)
        if told:
            self.totals[np.argsort(self.hashes)] = self.answer(2)[0]
        self.root = ((self.totals + SMOOTH) / (tokens + SMOOTH * (distinct + 1)))[self.codes]

    def answer(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """(values, whether no smaller block asked for the key)."""
        rows, value = self.told.get(kind, []), np.float32 if kind % 2 else np.int64
        return np.concatenate([np.zeros(0, value), *(spread(r["values"], value) for r in rows)]), np.concatenate([np.zeros(0, bool), *(spread(r["first"], bool) for r in rows)])

    def places(self, strings: Strings, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(distinct keys in order, the place of each string's key); words are told apart by their codes."""
        if size > 1:
            keys, _, place = distinct(strings.keys)
            return keys, place
        codes = np.flatnonzero(self.totals >= self.least)
        codes = codes[np.argsort(self.hashes[codes])]
        place = np.zeros(len(self.hashes), np.int64)
        place[codes] = np.arange(len(codes))
        return self.hashes[codes], place[self.codes[strings.at]]

    def candidates(self, own: Strings, size: int) -> tuple[Strings, np.ndarray]:
        """Strings of `size` words whose two parts of size - 1 are frequent, and the places of those to be counted.

        The others have a context whose suffix has one follower: they are as frequent as the context.
        """
        j = np.flatnonzero((np.diff(own.at, prepend=-2) == 1) & (self.before[own.at] >= size - 1))
        at, above = own.at[j], own.counts[j - 1]
        return Strings(at, longer(own.keys[j - 1], self.words[at]), above.copy(), above, np.zeros(len(j), bool)), np.flatnonzero(own.counts[j] < own.above[j])

    def next(self, own: Strings, size: int) -> Strings:
        """The frequent strings of `size` words, from those of size - 1."""
        found, asked = self.candidates(own, size)
        keys, _, place = distinct(found.keys[asked])
        total, first = self.answer(2 * size)
        found.counts[asked] = total[place]
        one = np.zeros(len(keys), np.int64)
        one[place] = asked
        found.added[one[first & (total >= self.least)]] = True
        return found.where(found.counts >= self.least)

    def after(self, p: np.ndarray, contexts: Strings, strings: Strings, size: int) -> np.ndarray:
        """Probabilities of the tokens given up to `size` words before them, from those given fewer."""
        rest = self.answer(2 * size + 1)[0][self.places(contexts, size)[1]].astype(np.float64)
        inside = ~np.isnan(rest) & (contexts.at + 1 < len(p))
        inside[inside] &= self.before[contexts.at[inside] + 1] >= size
        at, seen, out = contexts.at[inside] + 1, np.zeros(len(p), np.int64), p.copy()
        seen[strings.at] = strings.counts
        out[at] = np.where(seen[at] > 0, (seen[at] - self.discount) / contexts.counts[inside], rest[inside] * p[at])
        return out

    def walk(self, size: int, scored: bool) -> tuple[np.ndarray, Strings, Strings]:
        """(probabilities of the tokens given up to size - 2 words, strings of `size` and of size - 1 words)."""
        counts, p = self.totals[self.codes], self.root
        own = Strings(np.arange(len(counts)), self.words, counts, np.full(len(counts), np.iinfo(np.int64).max), np.zeros(len(counts), bool)).where(counts >= self.least)
        shorter = own
        for k in range(2, size + 1):
            shorter, own = own, self.next(own, k)
            if scored and k < size:
                p = self.after(p, shorter, own, k - 1)
        return p, own, shorter


def each(rows: pa.RecordBatch) -> Iterator[dict]:
    """One row after the other, since a row is a whole block."""
    for k in range(rows.num_rows):
        yield rows.slice(k, 1).to_pylist()[0]


def by_range(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """The runs of sorted uint64 keys that lie in each range."""
    place = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(place)) + 1
    for start, stop in zip([0, *cuts], [*cuts, len(keys)]):
        if stop > start:
            yield int(place[start]), slice(int(start), int(stop))


def exchange(blocks: DataFrame, ask: Callable, kinds: list[tuple[int, Callable]], ranges: int, buckets: int) -> DataFrame:
    """Each block's questions answered by key range: (block, told: array of (kind, at, values, first), distinct, own, nodes), written.

    ask(row) gives, for each kind of question, a block's sorted keys and arrays of the same length. A kind's
    add_up(places, first, arrays) gives an array for the distinct keys of a range from the arrays of all blocks, how
    many of them count, and the range's own sum. `values` holds it for the block's keys in their order, `first` is 1
    where no smaller block has the key; distinct and own add up to all ranges' numbers, nodes to those of weights.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in each(b):
                for which, (keys, arrays) in enumerate(ask(row)):
                    for at, run in by_range(keys, ranges):
                        values = [[squeezed(a[run]) for a in arrays]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([which * ranges + at], pa.int32()), pa.array([row["block"]], pa.int64()), pa.array([packed(keys[run])], pa.binary()), pa.array(values, pa.list_(pa.binary()))],
                            names=["at", "block", "keys", "arrays"],
                        )

    def answer(part: pa.Table) -> pa.Table:
        part = part.sort_by("block")
        kind, add_up = kinds[part["at"][0].as_py() // ranges]
        sent = [unpacked(k) for k in part["keys"].to_pylist()]
        ends = np.cumsum([len(k) for k in sent])
        _, first, places = distinct(np.concatenate(sent))
        values, kept, own = add_up(places, first, part["arrays"].to_pylist())
        fresh = np.zeros(ends[-1], bool)
        fresh[first] = True
        out = {"values": [squeezed(values[places[a:z]]) for a, z in zip([0, *ends], ends)], "first": [squeezed(fresh[a:z]) for a, z in zip([0, *ends], ends)]}
        once = [0] * (len(sent) - 1)
        return pa.table({
            "block": part["block"], "kind": pa.array([kind] * len(sent), pa.int32()), "at": part["at"], **{c: pa.array(x, pa.binary()) for c, x in out.items()},
            "distinct": pa.array([kept, *once], pa.int64()), "own": pa.array([own, *once], pa.int64()),
        })

    sent = blocks.mapInArrow(send, "at int, block long, keys binary, arrays array<binary>")
    told = sent.groupBy("at").applyInArrow(answer, ANSWER).groupBy("block")
    sums = F.sum("distinct").alias("distinct"), F.sum("own").alias("own"), F.sum(F.when(F.col("kind") % 2 == 1, F.col("distinct"))).alias("nodes")
    return in_buckets(told.agg(F.collect_list(F.struct("kind", "at", "values", "first")).alias("told"), *sums), buckets, "answers")


def counts_of(least: int) -> Callable:
    """Adds counts up; those below `least` are told as 0."""

    def add_up(places: np.ndarray, first: np.ndarray, sent: list) -> tuple[np.ndarray, np.ndarray, int]:
        total = np.bincount(places, np.concatenate([spread(a[0], np.int32) for a in sent]), len(first)).astype(np.int64)
        return np.where(total >= least, total, 0), int((total >= least).sum()), int(total.sum())

    return add_up


def weights_of(discount: float, strict: float) -> Callable:
    """Adds up what a context's entries come to, and tests it."""

    def add_up(places: np.ndarray, first: np.ndarray, sent: list) -> tuple[np.ndarray, np.ndarray, int]:
        above, *sums = (np.concatenate([spread(a[k], np.float64) for a in sent]) for k in range(5))
        rest = rest_factor(above[first], *(np.bincount(places, s, len(first)) for s in sums), discount, strict)
        return rest.astype(np.float32), int((~np.isnan(rest)).sum()), 0

    return add_up


def score_texts(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
    depth: int = 5, least: int = 2, discount: float = 0.5, strict: float = 3.0, block_tokens: int = 1_000_000, range_tokens: int = 1_000_000,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text; held-out ones teach nothing.

    depth: the most words of a context, the memory of the tree.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).alias("text"))
    spark = docs.sparkSession
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(wide, 8 * rows.rdd.getNumPartitions())  # a task holds all blocks of a bucket, so that few have two
    blocks = in_buckets(to_blocks(rows, block_tokens), buckets, "blocks")
    size = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    ranges = max(wide, size // range_tokens + 1)
    answers: list[DataFrame] = []

    def with_told() -> DataFrame:
        every = reduce(DataFrame.unionByName, [a.select(F.col("block").alias("_b"), "told") for a in answers])  # still in buckets
        told = every.groupBy("_b").agg(F.collect_list("told").alias("told"))
        return blocks.join(told.hint("shuffle_hash"), F.col("block") == F.col("_b"), "left").drop("_b")

    def ask_words(row: dict) -> list:
        block = Block(row, 0, 0, least, discount)
        own, order = np.bincount(block.codes[block.train], minlength=len(block.hashes)), np.argsort(block.hashes)
        return [(block.hashes[order], [own[order].astype(np.int32)])]

    answers.append(exchange(blocks, ask_words, [(2, counts_of(1))], ranges, buckets))
    known = answers[0].agg(F.coalesce(F.sum("own"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()
    facts = known["n"], known["v"], least, discount
    deepest = depth
    for k in range(1, depth + 2):  # counts the strings of k + 1 words and tests the contexts of k - 1 words
        count, weigh = k <= depth, k > 1

        def ask(row: dict, k: int = k, count: bool = count, weigh: bool = weigh) -> list:
            block, out = Block(row, *facts), []
            p, own, shorter = block.walk(k, weigh)
            if count:
                found, asked = block.candidates(own, k + 1)
                keys, _, place = distinct(found.keys[asked])
                out.append((keys, [np.bincount(place, block.train[found.at[asked]], len(keys)).astype(np.int32)]))
            if weigh:
                keys, place = block.places(shorter, k - 1)
                above, at = np.zeros(len(keys)), np.zeros(len(p), np.int64)
                above[place], at[shorter.at] = shorter.counts, place
                mine = own.where(own.added)
                of, low, n = at[mine.at - 1], p[mine.at], mine.counts
                sums = (np.ones(len(n)), n, n * np.log(n / mine.above / low), low)
                out.append((keys, [above, *(np.bincount(of, x, len(keys)).astype(np.float64) for x in sums)]))
            return out

        kinds = [(2 * k + 2, counts_of(least))] * count + [(2 * k - 1, weights_of(discount, strict))] * weigh
        answers.append(exchange(with_told(), ask, kinds, ranges, buckets))
        if weigh and not answers[-1].agg(F.sum("nodes")).first()[0]:
            deepest = k - 2  # no context of k - 1 words diverges from its suffix
            break
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in each(b):
                block = Block(row, *facts)
                p, own, contexts = block.walk(deepest + 1, True)
                p = block.after(p, contexts, own, deepest) if deepest else p
                n, text = len(block.ids), np.repeat(np.arange(len(block.ids)), block.lengths)
                sums = [np.bincount(text, x, n) for x in (block.totals[block.codes] > 0, np.log10(block.root), np.log10(p))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids, mask=block.ids == np.iinfo(np.int64).min), *(pa.array(x) for x in (block.held, block.lengths, sums[0].astype(np.int64), np.full(n, facts[0], np.int64), sums[1], sums[2]))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return with_told().mapInArrow(score, schema)
