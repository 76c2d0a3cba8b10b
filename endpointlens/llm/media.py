"""Copies among pictures, cropped or edited, from local descriptors.

1. Corners are found at several scales: every point that is the strongest within `REACH` pixels, so their number grows
   with the picture and a crop keeps those inside it. Each gets the orientation of its patch's intensity centroid, and
   256 binary tests turned by it make its descriptor.
2. Pictures meet if pairs of corners of one match pairs of the other, of three corners or more on either side. A pair of
   corners of a picture, at most `SIGHT` apart, is a key in each of sixteen tables: 16 bits of either descriptor, both
   angles against the line between them, and their distance in units of their scale, so a key holds under turns and
   changes of size. Members of a key's cell match if 48 other bits of either corner differ in `apart` or fewer. The keys
   of one table, or of a part of one, are in the shuffle at a time. A member that matches more than `crowd` others in a
   cell - a patch that many pictures share, or a large group of copies - makes them a star: they meet the smallest
   picture, and those that aren't copies of it meet the other members.
3. Pictures that met are compared as a whole: corners whose descriptors are each other's nearest vote for similarity
   transforms, and the pictures are linked if enough of them agree on one in place, scale and turn, and make up enough
   of all matches.

Equal pictures are one node from the start. The members of a cell go to one task, 26 bytes each, which compares each
with each and gives out those that match.

Pictures are binary columns with raw PGM or PPM data (P5 or P6, 8 bits). Defined results: null, empty or unreadable
data has no corners and is linked only to equal data (null to nothing). Repeated ids are pictures of their own and
share the id's component; a null id is a picture too. Pictures of fewer than `least` corners are linked only to equal
ones. Extra columns are ignored. A picture takes memory in proportion to its pixels.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_at_once, forget, settled, written
from .simhash import components

SCALES = (1.0, 1.5, 2.25)
#: A corner is the strongest within REACH pixels and as far from the edge.
REACH = 11
#: Tables of pairs of corners: slices of 16 bits, and as many bins of a turn and of a factor e in distance.
PAIR_TABLES, TURNS, STRETCH = 16, 24, 2
#: How far apart the corners of a pair are, in units of their scale.
SIGHT = (4.0, 128.0)
#: A test is 1 only if the second point is brighter by this much, so that noise on flat areas leaves it at 0.
MARGIN = 1.0
_rng = np.random.default_rng(2024)
#: Test points around a corner, in pixels of its scale; points outside the picture are moved to its edge.
TESTS = np.clip(_rng.normal(0, 8, (256, 2, 2)), -17, 17)
_y, _x = np.mgrid[-10:11, -10:11]
DISC = (_x**2 + _y**2 <= 100).astype(np.float32)


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey levels of raw PGM or PPM data."""
    head = re.match(rb"P([56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s", data or b"")
    if not head:
        return None
    planes, width, height, most = 3 if head[1] == b"6" else 1, int(head[2]), int(head[3]), int(head[4])
    body = data[head.end() :]
    if most > 255 or len(body) < planes * width * height or not width * height:
        return None
    grey = np.frombuffer(body, np.uint8, planes * width * height).reshape(height, width, planes).astype(np.float32)
    return grey @ np.array([0.299, 0.587, 0.114], np.float32) if planes == 3 else grey[:, :, 0]


def resized(grey: np.ndarray, scale: float) -> np.ndarray:
    """Smaller by `scale`, bilinear after a box blur of its size."""
    if scale == 1:
        return grey
    height, width = int(grey.shape[0] / scale), int(grey.shape[1] / scale)
    soft = box(grey, 1)
    y, x = np.minimum(np.arange(height) * scale, grey.shape[0] - 1.001), np.minimum(np.arange(width) * scale, grey.shape[1] - 1.001)
    i, j = y.astype(int), x.astype(int)
    a, b = (y - i)[:, None], (x - j)[None, :]
    return (soft[i][:, j] * (1 - b) + soft[i][:, j + 1] * b) * (1 - a) + (soft[i + 1][:, j] * (1 - b) + soft[i + 1][:, j + 1] * b) * a


def box(a: np.ndarray, r: int) -> np.ndarray:
    """Mean over (2r + 1)^2 neighbours, edges repeated."""
    p = np.pad(a, r + 1, mode="edge").cumsum(0).cumsum(1)
    n = 2 * r + 1
    return ((p[n:, n:] - p[:-n, n:] - p[n:, :-n] + p[:-n, :-n])[: a.shape[0], : a.shape[1]] / (n * n)).astype(np.float32)


def strongest(a: np.ndarray, r: int) -> np.ndarray:
    """The largest value within r rows and columns."""
    for axis in (0, 1):
        p = np.pad(a, [(r, r) if k == axis else (0, 0) for k in (0, 1)], constant_values=-np.inf)
        n, width = p.shape[axis], 1
        cut = lambda x, start, stop: x[start:stop] if axis == 0 else x[:, start:stop]  # noqa: E731, B023
        while 2 * width <= 2 * r + 1:  # p holds the maximum of `width` values from each on
            p = np.maximum(cut(p, 0, n - 2 * width + 1), cut(p, width, n - width + 1))
            width *= 2
        rest = 2 * r + 1 - width
        a = np.maximum(cut(p, 0, n - 2 * r), cut(p, rest, rest + n - 2 * r))
    return a


def corners(grey: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(y, x) of the points, at least REACH from the edge, that are the strongest corner within REACH."""
    if min(grey.shape) <= 2 * REACH + 2:
        return np.zeros(0, int), np.zeros(0, int)
    dy, dx = np.gradient(box(grey, 1))
    xx, yy, xy = box(dx * dx, 2), box(dy * dy, 2), box(dx * dy, 2)
    strength = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
    core = strength[REACH:-REACH, REACH:-REACH]
    y, x = np.nonzero((core > 1.0) & (core >= strongest(strength, REACH)[REACH:-REACH, REACH:-REACH]))
    return y + REACH, x + REACH


def describe(grey: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(corners x (x, y, scale, angle) in picture coordinates, corners x 32 bytes)."""
    places, bits = [], []
    for scale in SCALES if grey is not None else ():
        small = resized(grey, scale)
        y, x = corners(small)
        if not len(y):
            continue
        patch = small[y[:, None, None] + _y, x[:, None, None] + _x] * DISC
        angle = np.arctan2((patch * _y).sum((1, 2)), (patch * _x).sum((1, 2)))
        c, s = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
        tx = np.rint(x[:, None, None] + c * TESTS[None, :, :, 0] - s * TESTS[None, :, :, 1]).astype(int)
        ty = np.rint(y[:, None, None] + s * TESTS[None, :, :, 0] + c * TESTS[None, :, :, 1]).astype(int)
        soft = box(small, 2)
        level = soft[np.clip(ty, 0, soft.shape[0] - 1), np.clip(tx, 0, soft.shape[1] - 1)]
        bits.append(np.packbits(level[:, :, 0] + MARGIN < level[:, :, 1], axis=1))
        places.append(np.stack([x * scale, y * scale, np.full(len(x), scale), angle], 1))
    if not places:
        return np.zeros((0, 4)), np.zeros((0, 32), np.uint8)
    return np.concatenate(places), np.concatenate(bits)


def matched(a: np.ndarray, b: np.ndarray, most: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """(corner of a, corner of b): descriptors (corners x 32 bytes) that are each other's nearest, at `most` or fewer bits."""
    if not len(a) or not len(b):
        return np.zeros(0, int), np.zeros(0, int)
    apart = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]).sum(2, dtype=np.int32)
    to, back = apart.argmin(1), apart.argmin(0)
    own = np.flatnonzero((back[to] == np.arange(len(a))) & (apart[np.arange(len(a)), to] <= most))
    return own, to[own]


def agreeing(a: np.ndarray, b: np.ndarray, within: float = 4.0) -> int:
    """The most places of a that one similarity transform, proposed by a match, takes to their matches in b.

    a, b: matched corners x (x, y, scale, angle). A match agrees in place (within pixels of the scale), in scale (a
    factor of 1.6) and in turn (0.5).
    """
    if not len(a):
        return 0
    scale, turn = b[:, 2] / a[:, 2], b[:, 3] - a[:, 3]
    dx, dy, ex, ey = (v[None, :, k] - v[:, k, None] for v, k in ((a, 0), (a, 1), (b, 0), (b, 1)))  # from the proposing match
    alike = np.cos(turn[None, :] - turn[:, None]) > np.cos(0.5)
    _, place = np.unique(np.floor(a[:, :2] / 6), axis=0, return_inverse=True)
    spots = np.zeros((len(a), place.max() + 1), np.float32)
    spots[np.arange(len(a)), place.ravel()] = 1
    slack = (within * np.maximum(b[:, 2], 1)) ** 2 + 0.01 * (ex**2 + ey**2)
    best = 0
    for factor in (1, 1 / 1.22, 1.22):  # corners are found at few scales, so their ratio is coarse
        r = (scale * factor)[:, None]
        c, s = r * np.cos(turn)[:, None], r * np.sin(turn)[:, None]
        near = ((c * dx - s * dy - ex) ** 2 + (s * dx + c * dy - ey) ** 2 <= slack) & alike & (np.abs(np.log(scale[None, :] / r)) < 0.47)
        best = max(best, int(((near @ spots) > 0).sum(1).max()))
    return best


def copies(a: np.ndarray, da: np.ndarray, b: np.ndarray, db: np.ndarray, least: int = 5, share: float = 0.4) -> bool:
    """Whether two pictures (places, descriptors) agree on a transform in `least` places and in `share` of their matches."""
    p, q = matched(da, db)
    return len(p) >= least and agreeing(a[p], b[q]) >= max(least, share * len(p))


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, since a row is a whole picture."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def descriptors(pictures: DataFrame) -> DataFrame:
    """(row, media_id, digest, n_corners, places, bits) of pictures (row, media_id, _data).

    digest: of the data; places: x, y, scale, angle of each corner; bits: its 32 bytes, flat. The pictures themselves
    go no further.
    """
    kind = pictures.schema["media_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            data = b.column(2).to_pylist()
            found = [describe(decode(d)) for d in data]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), b.column(1), pa.array([None if d is None else hashlib.sha256(d).hexdigest() for d in data], pa.string()), pa.array([len(p) for p, _ in found], pa.int32()),
                    pa.array([p.astype("<f4").tobytes() for p, _ in found], pa.binary()), pa.array([d.tobytes() for _, d in found], pa.binary()),
                ],
                names=["row", "media_id", "digest", "n_corners", "places", "bits"],
            )

    return pictures.select("row", "media_id", "_data").mapInArrow(run, f"row long, media_id {kind}, digest string, n_corners int, places binary, bits binary")


# Meetings by single corners, up to `meetings`: every pair with two matching corners. Matches of unrelated corners grow
# with the square of the pictures, so `picture_links` takes pairs of corners instead; tests hold those against these.

#: Tables of single corners, and the bits of a descriptor's slice that make its cell.
TABLES, SLICE = 8, 28
BITS = ("b0", "b1", "b2", "b3")


def table_cells(described: DataFrame) -> DataFrame:
    """(cell, node, corner, b0 to b3): a row for each corner and table; the descriptor's 256 bits are turned to begin with the table's own slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            counts = np.array([len(x) // 32 for x in b.column(1).to_pylist()])
            slices, node = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4").reshape(-1, TABLES), np.repeat(np.asarray(b.column(0), np.int64), counts)
            corner = (np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)
            for t in range(TABLES):
                own = np.ascontiguousarray(np.roll(slices, -t, 1)).view("<i8")
                cell = (np.int64(t) << 32) | (own[:, 0] & ((1 << SLICE) - 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(node), pa.array(corner), *(pa.array(np.ascontiguousarray(own[:, k])) for k in range(4))], names=["cell", "node", "corner", *BITS]
                )

    return described.select("node", "bits").mapInArrow(run, "cell long, node long, corner int, " + ", ".join(f"{c} long" for c in BITS))


def slice_of(words: list[Column], k: int) -> Column:
    """Slice k of four words of a turned descriptor."""
    return (F.shiftrightunsigned(words[k // 2], 32) if k % 2 else words[k // 2]).bitwiseAND(F.lit((1 << SLICE) - 1))


def split_cells(members: DataFrame) -> DataFrame:
    """Members of full cells in the cells of their own and one other slice, whose number ends the cell's."""
    others = [F.struct(F.lit(k).alias("k"), slice_of([F.col(c) for c in BITS], k).alias("slice")) for k in range(1, TABLES)]
    split = members.select("cell", "node", "corner", *BITS, F.explode(F.array(*others)).alias("o"))
    return split.select(F.shiftleft(F.xxhash64("cell", "o.slice"), 3).bitwiseOR(F.col("o.k")).alias("cell"), "node", "corner", *BITS)


def full_cells(cells: DataFrame, crowd: int) -> DataFrame:
    """(cell, head, parts): cells of more than `crowd` members, their smallest node and in how many parts of `crowd` they go."""
    counted = cells.groupBy("cell").agg(F.count("*").alias("n"), F.min("node").alias("head")).where(F.col("n") > crowd)
    return settled(counted.select("cell", "head", F.ceil(F.col("n") / max(crowd, 1)).alias("parts")), "full-cells")


def in_table(k: int) -> Column:
    """Whether slice k of a turned descriptor is that of an earlier table than its cell's."""
    return F.shiftright("x.cell", 32) + k >= TABLES


def in_split(k: int) -> Column:
    """Whether slice k splits a full cell before the slice of this split cell."""
    return F.col("x.cell").bitwiseAND(7) > k


def matches(cells: DataFrame, near: int, earlier: Callable[[int], Column]) -> DataFrame:
    """(a, b, i, j): corners i of node a and j of node b that share a cell and differ in `near` or fewer bits.

    Corners that agree in an earlier slice too are left to that slice's cell, so a match comes once, not once a slice.
    If that cell is full its split cells have the match, and if they stay full, both nodes are members of one.
    """
    x, y = cells.alias("x"), cells.alias("y")
    differ = [F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}")) for c in BITS]
    apart = reduce(Column.__add__, [F.bit_count(d) for d in differ])
    first = reduce(Column.__and__, [(slice_of(differ, k) != 0) | ~earlier(k) for k in range(1, TABLES)])
    found = x.join(y, (F.col("x.cell") == F.col("y.cell")) & (F.col("x.node") < F.col("y.node")) & (apart <= near) & first)
    return found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.corner").alias("i"), F.col("y.corner").alias("j"))


def lone_matches(members: DataFrame, near: int) -> DataFrame:
    """(a, b, i, j): matches among members (cell, parts, ...) of full cells that agree in the cell's slice alone, which no split cell holds.

    Every part of a cell meets every other and itself, each in a group of its own: a group holds two parts, however
    many members the cell has.
    """
    part = members.withColumn("part", F.pmod(F.xxhash64("node", "corner"), "parts")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    part = part.withColumns({"p": F.least("part", "other"), "q": F.greatest("part", "other")}).select("cell", "p", "q", "part", "node", "corner", *BITS)
    x, y = part.where("part = p").alias("x"), part.where("part = q").alias("y")
    differ = [F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}")) for c in BITS]
    rest = [slice_of(differ, k) != 0 for k in range(1, TABLES)]
    once = F.when(F.col("x.p") == F.col("x.q"), F.col("x.node") < F.col("y.node")).otherwise(F.col("x.node") != F.col("y.node"))
    close = reduce(Column.__add__, [F.bit_count(d) for d in differ]) <= near
    same_group = reduce(Column.__and__, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("cell", "p", "q")])
    found = x.join(y, same_group & once & close & reduce(Column.__and__, rest))
    first = F.col("x.node") < F.col("y.node")
    ends = lambda c: (F.when(first, F.col(f"x.{c}")).otherwise(F.col(f"y.{c}")), F.when(first, F.col(f"y.{c}")).otherwise(F.col(f"x.{c}")))
    (a, b), (i, j) = ends("node"), ends("corner")
    return found.select(a.alias("a"), b.alias("b"), i.alias("i"), j.alias("j"))


def met(found: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes of which two corners or more of either match.

    Few pairs have a second match, so matches are dealt as short rows and not added up before.
    """
    dealt = found.select("a", "b", F.shiftleft(F.col("i").cast("long"), 32).bitwiseOR(F.col("j").cast("long")).alias("ij")).repartition("a", "b")
    corner = {"i": F.shiftright("ij", 32), "j": F.col("ij").bitwiseAND(F.lit((1 << 32) - 1))}
    ends = [f(corner[c]).alias(f"{f.__name__}_{c}") for c in "ij" for f in (F.min, F.max)]
    return dealt.groupBy("a", "b").agg(*ends).where("min_i < max_i and min_j < max_j").select("a", "b")


def verified(described: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) that are copies."""

    @F.pandas_udf("boolean")
    def same(pa_: pd.Series, da: pd.Series, pb: pd.Series, db: pd.Series) -> pd.Series:
        places = lambda x: np.frombuffer(x, "<f4").reshape(-1, 4).astype(np.float64)
        bits = lambda x: np.frombuffer(x, np.uint8).reshape(-1, 32)
        return pd.Series([copies(places(a), bits(x), places(b), bits(y), least) for a, x, b, y in zip(pa_, da, pb, db)], dtype=bool)

    one, two = (described.select(F.col("node").alias(c), F.col("places").alias(f"p{c}"), F.col("bits").alias(f"d{c}")) for c in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").where(same("pa", "da", "pb", "db")).select("a", "b")


def meetings(cells: DataFrame, crowd: int, near: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): the pairs (a, b) with two matching corners or more, and the members (cell, head, node) of cells that stay full when split.

    A match of a full cell is found by the split cell of a second slice that it agrees in, or else part by part. Cells
    that stay full make no pairs; their members are returned instead.
    """
    full = full_cells(cells, crowd)
    crowded = cells.join(full, "cell").drop("head")
    split = split_cells(crowded)
    fuller = full_cells(split, crowd)
    rest = cells.join(full, "cell", "left_anti")
    # half of the tables at a time: their cells are gone before matches are dealt to pairs
    halves = [rest.where(F.shiftright("cell", 32).between(t, t + TABLES // 2 - 1)) for t in (0, TABLES // 2)]
    found = [settled(matches(half, near, in_table), "matches") for half in halves]
    found += [matches(split.join(fuller, "cell", "left_anti"), near, in_split), lone_matches(crowded, near)]
    members = settled(split.select("cell", "node").distinct().join(fuller, "cell").where("node <> head").select("cell", "head", "node"), "members")
    pairs = settled(met(reduce(DataFrame.unionByName, found)), "pairs")
    forget(*found[:2])
    return pairs, members


def neighbours(counts: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): all pairs of corners i < j of one picture, about `most` at a time; counts: corners of each picture."""
    left = np.repeat(np.cumsum(counts), counts) - np.arange(counts.sum()) - 1
    upto, start = np.cumsum(left), 0
    while start < len(left):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, "right")))
        own = left[start:stop]
        i = np.repeat(np.arange(start, stop), own)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own)
        start = stop


def pair_keys(places: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray, table: int, part: int = 0, parts: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, key, check) of the pairs (i, j) that are near enough: their places in i, 64 mixed bits, and 96 other bits of the two descriptors as three words.

    places: corners x (x, y, scale, angle); bits: corners x 32 bytes. The corner with the smaller slice is the first.
    part: which of `parts` equal parts of all keys.
    """
    slices = bits.view("<u2")
    first = slices[:, table].astype(np.uint32)
    pair = np.flatnonzero(((first[i] ^ first[j]) * np.uint32(0x9E3779B1) >> np.uint32(16)) % parts == part)
    i, j = i[pair], j[pair]
    d = places[j, :2] - places[i, :2]
    far = np.hypot(d[:, 0], d[:, 1]) / np.sqrt(places[i, 2] * places[j, 2])
    near = np.flatnonzero((far >= SIGHT[0]) & (far <= SIGHT[1]))
    i, j, d, far, pair = i[near], j[near], d[near], far[near], pair[near]
    own = first << np.uint32(16) | slices[:, (table + 1) % 16]
    swap = own[i] > own[j]
    line = np.arctan2(d[:, 1], d[:, 0]) + np.pi * swap
    a, b = np.where(swap, j, i), np.where(swap, i, j)
    turn_a, turn_b = (np.floor((places[c, 3] - line) / (2 * np.pi) % 1 * TURNS).astype(np.uint64) for c in (a, b))
    key = first[a].astype(np.uint64) << np.uint64(16) | first[b]
    key = ((key * TURNS + turn_a) * TURNS + turn_b) << np.uint64(8) | np.floor(np.log(far) * STRETCH).astype(np.uint64)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        key = (key ^ (key >> np.uint64(33))) * np.uint64(factor)
    others = np.ascontiguousarray(slices[:, [(table + k) % 16 for k in (4, 5, 6)]])
    return pair, key ^ (key >> np.uint64(33)), np.concatenate([others[a], others[b]], 1).view("<u4")


#: What a bucket's row holds of each key, flat: its lower bits, the picture, the number of the pair in it, the check.
FLAT = {"keys": "<u4", "nodes": "<i8", "pairs": "<u2", "checks": "<u4"}


def pair_cells(described: DataFrame, table: int, part: int, parts: int, buckets: int, flush: int = 1 << 20) -> DataFrame:
    """(bucket, keys, nodes, pairs, checks): keys of one table or of a part of it, dealt to buckets; a row has many."""

    def dealt(held: list) -> pa.RecordBatch:
        node, pair, key, check = (np.concatenate(x) for x in zip(*held))
        bucket = (key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        columns = [x[order].astype(kind) for x, kind in zip((key & np.uint64((1 << 32) - 1), node, pair, check), FLAT.values())]
        flat = [pa.array([x[s:e].tobytes() for s, e in zip(cuts[:-1], cuts[1:])], pa.binary()) for x in columns]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int64)), *flat], names=["bucket", *FLAT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in pieces_of(batches):
            bits = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(-1, 32)
            places = np.frombuffer(b"".join(b.column(1).to_pylist()), "<f4").reshape(-1, 4)
            counts = np.array([len(x) // 32 for x in b.column(2).to_pylist()])
            node, start = np.repeat(np.asarray(b.column(0), np.int64), counts), np.repeat(np.cumsum(counts) - counts, counts)
            for i, j in neighbours(counts):
                pair, key, check = pair_keys(places, bits, i, j, table, part, parts)
                i, j = i[pair], j[pair]
                held.append((node[i], ((i - start[i]) * 256 + j - start[i]) % 65521, key, check))
                n += len(key)
                if n > flush:
                    yield dealt(held)
                    held, n = [], 0
        if n:
            yield dealt(held)

    return described.select("node", "places", "bits").mapInArrow(run, "bucket long, " + ", ".join(f"{c} binary" for c in FLAT))


def cell_matches(keys: np.ndarray, nodes: np.ndarray, checks: np.ndarray, crowd: int, apart: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(x, y, star): places of members that match in a cell; a star's members y with its head. Rows are in order of keys and nodes."""
    close = lambda x, y: (np.bitwise_count(checks[x] ^ checks[y]).sum(-1, dtype=np.int32) <= apart) & (nodes[x] != nodes[y])
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    size = np.diff(cuts)
    end = np.repeat(np.where(size <= crowd + 1, cuts[1:], cuts[:-1]), size)  # cells too small for a star: all at once
    x, lag = np.arange(len(keys)), 1
    while len(x := x[x + lag < end[x]]):
        good = x[close(x, x + lag)]
        yield good, good + lag, False
        lag += 1
    for k in np.flatnonzero(size > crowd + 1):
        star, outside = np.full(size[k], -1), {-1: np.arange(cuts[k], cuts[k + 1])}
        for x in range(cuts[k], cuts[k + 1]):  # members of a star have met; they are compared with the others only
            y = outside[star[x - cuts[k]]]
            y = y[np.searchsorted(y, x + 1) :]
            y = y[close(x, y)]
            if full := len(y) > crowd:
                star[x - cuts[k]] = star[y - cuts[k]] = x
                outside[x] = cuts[k] + np.flatnonzero(star != x)
            yield np.full(len(y), x), y, full


def by_pair(rows: np.ndarray) -> np.ndarray:
    """Rows (a, b, least pair of a, largest, least pair of b, largest), one for each (a, b)."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]) if len(rows) else np.zeros(0, int)
    ends = [f.reduceat(rows[:, c], first) for f, c in ((np.minimum, 2), (np.maximum, 3), (np.minimum, 4), (np.maximum, 5))] if len(rows) else [np.zeros(0, int)] * 4
    return np.column_stack([rows[first, :2], *ends])


MATCHED = ("a", "b", "low_a", "high_a", "low_b", "high_b")


def pair_matches(described: DataFrame, table: int, part: int, parts: int, buckets: int, crowd: int, apart: int) -> DataFrame:
    """(a, b, low_a, high_a, low_b, high_b, star): nodes that match, the least and largest numbers of the pairs by which they do; star: the star of a, its head, and b, or null."""

    def found(bucket: int, rows: list) -> pa.RecordBatch:
        keys, nodes, pairs, checks = (np.frombuffer(b"".join(r[k].as_py() for r in rows), kind) for k, kind in enumerate(FLAT.values()))
        order = np.lexsort((nodes, keys))
        keys, nodes, pairs, checks = keys[order], nodes[order], pairs[order].astype(np.int64), checks.reshape(-1, 3)[order]
        stars, held, n, most = [], [np.zeros((0, 6), np.int64)], 0, 1 << 20
        for x, y, star in cell_matches(keys, nodes, checks, crowd, apart):
            own = np.column_stack([nodes[x], nodes[y], pairs[x], pairs[x], pairs[y], pairs[y]])
            if star:
                stars.append((f"{table}-{part}-{bucket}-{x[0]}", by_pair(own)))
            elif len(x):
                held.append(own)
                n += len(x)
                if n > most:  # copies match by many pairs
                    held = [by_pair(np.concatenate(held))]
                    n, most = 0, max(most, len(held[0]))
        every = [*stars, (None, by_pair(np.concatenate(held)))]
        ends = np.concatenate([x for _, x in every])
        names = pa.array([name for name, x in every for _ in x], pa.string())
        return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in ends.T), names], names=[*MATCHED, "star"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for b in batches:
            for k, own in enumerate(b.column(0).to_pylist()):
                if own != bucket and rows:
                    yield found(bucket, rows)
                    rows = []
                bucket = own
                rows.append([b.column(c)[k] for c in range(1, 5)])
        if rows:
            yield found(bucket, rows)

    cells = pair_cells(described, table, part, parts, buckets).repartition("bucket").sortWithinPartitions("bucket")
    return cells.mapInArrow(run, ", ".join(f"{c} long" for c in MATCHED) + ", star string")


def pair_meetings(described: DataFrame, crowd: int, apart: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): the pairs (a, b) that match by pairs of three corners or more, or are in a star with its head; the members (cell, head, node) of stars."""
    n = described.agg(F.sum(F.col("n_corners") * F.least(F.lit(100), "n_corners") / 2)).first()[0] or 0
    parts = 1 + min(3, int(n / 4_000_000))
    buckets = 1 + int(n / 500_000 / parts)
    with few_at_once(described.sparkSession):  # one after the other: the keys of one are gone before the next one's come
        tables = [settled(pair_matches(described, t, p, parts, buckets, crowd, apart), "matches") for t in range(PAIR_TABLES) for p in range(parts)]
    found = reduce(DataFrame.unionByName, tables)
    stars = found.where("star is not null").select(F.col("star").alias("cell"), F.col("a").alias("head"), F.col("b").alias("node"))
    ends = [f(c).alias(c) for f, c in ((F.min, "low_a"), (F.max, "high_a"), (F.min, "low_b"), (F.max, "high_b"))]
    three = found.groupBy("a", "b").agg(*ends, F.count("star").alias("stars")).where("stars > 0 or low_a < high_a and low_b < high_b")
    pairs, members = settled(three.select("a", "b"), "pairs"), settled(stars, "members")
    forget(*tables)
    return pairs, members


def picture_links(described: DataFrame, least: int, crowd: int, apart: int) -> DataFrame:
    """(a, b): links among pictures that keep every group of copies whole."""
    first, members = pair_meetings(described.where(F.col("n_corners") >= least), crowd, apart)
    with few_at_once(described.sparkSession):
        links = settled(verified(described, first, least), "picture-links")
    # in stars, members that aren't copies of the head meet the others
    lost = members.join(links.select(F.col("a").alias("head"), F.col("b").alias("node")), ["head", "node"], "left_anti")
    again = lost.alias("x").join(members.alias("y"), (F.col("x.cell") == F.col("y.cell")) & (F.col("x.node") != F.col("y.node")))
    again = again.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    with few_at_once(described.sparkSession):
        late = settled(verified(described, again, least), "picture-links")
    forget(first, members)
    return links.unionByName(late)


def picture_copies(pictures: DataFrame, media_id: str = "media_id", media: str = "image", least: int = 5, crowd: int = 4096, apart: int = 10) -> DataFrame:
    """(media_id, n_corners, copy_id): copy_id is the smallest id of the picture's group of copies."""
    own = pictures.select(F.monotonically_increasing_id().alias("row"), F.col(media_id).alias("media_id"), F.col(media).alias("_data"))
    with few_at_once(own.sparkSession):
        described = written(descriptors(own), "corners")
    same = F.coalesce("digest", F.concat(F.lit("null-"), F.col("row").cast("string")))
    ids = settled(described.select(same.alias("media"), "row", "media_id", "n_corners"), "ids")
    nodes = ids.groupBy("media").agg(F.min("row").alias("node"))
    one = settled(described.withColumnRenamed("row", "node").join(nodes.select("node"), "node", "left_semi").select("node", "n_corners", "places", "bits"), "nodes")
    forget(described)
    links = picture_links(one, least, crowd, apart)
    forget(one)
    roots = components(links)
    placed = nodes.join(roots, "node", "left").select("media", F.coalesce("root", "node").alias("root"))
    named = ids.join(placed, "media")
    smallest = named.groupBy("root").agg(F.min("media_id").alias("copy_id"))
    return named.join(smallest, "root").select("media_id", "n_corners", "copy_id")
