import random
from pathlib import Path

import numpy as np
import pytest
from endpointlens.llm import media
from endpointlens.llm.media import copies, decode, describe, in_table, matches, meetings, picture_copies, table_cells
from endpointlens.llm.nearest import nearest
from endpointlens.llm.pictures import KINDS, draw, edited, kind_of, pgm, render


def exact(vectors, queries, k):
    good = {i: np.array(v, float) for i, v in vectors if v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in queries:
        if q in good:
            near = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q)[:k]
            out[q] = near
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(600)]
    vectors += [(700 + i, vectors[3][1]) for i in range(40)]  # ties
    vectors += [(800, None), (801, [0.0] * 8), (802, [float("nan")] * 8), (803, [1.0] * 5), (804, [None] + [1.0] * 7), (805, [float("inf")] + [0.0] * 7)]
    df = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in nearest(df, df.where("vec_id % 20 = 0"), k=10, block=7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    want = exact(vectors, [i for i, _ in vectors if i % 20 == 0], 10)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hits >= 0.97
    by_id = dict(vectors)
    for q, rows in got.items():
        assert all(abs(s - np.sqrt(((np.array(by_id[i], float) - np.array(by_id[q], float)) ** 2).sum())) < 1e-12 for s, i in rows)
    assert [i for _, i in got[700]][:10] == [3, *range(701, 710)]


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    rows = nearest(df, df.where("vec_id = 0")).collect()
    assert [(r["vec_id"], r["rank"]) for r in rows] == [(1, 1)]
    assert nearest(df.limit(0), df).count() == 0 and nearest(df, df.limit(0)).count() == 0


def pictures(n, seed=1):
    rng = random.Random(seed)
    return [draw([rng.random() for _ in range(4)]) for _ in range(n)]


def plain_groups(found, is_copy):
    """Smallest reachable place by brute force over all pairs."""
    root = list(range(len(found)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(found)):
        for j in range(i):
            if is_copy(found[j], found[i]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(found))]


@pytest.mark.parametrize("crowd", [512, 2, 0])
def test_copies_as_by_brute_force(spark, crowd):
    """Edits of edits, a large group, equal pictures, unreadable ones; with cells split and with full ones."""
    own = pictures(40)
    images = [pgm(p) for p in own] + [pgm(edited(p, i, KINDS[i % 5])) for i, p in enumerate(own[:30])] + [pgm(edited(own[3], 100 + i, "light")) for i in range(25)]
    rows = list(enumerate(images)) + [(1000 + i, images[0]) for i in range(5)] + [(300, None), (301, None), (302, b""), (303, b"junk"), (303, b"junk"), (None, images[1])]
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], "media_id long, image binary, n_corners int, node string").repartition(3)
    out = picture_copies(df, crowd=crowd).collect()
    assert len(out) == len(rows)
    got = {r["media_id"]: r["copy_id"] for r in out}
    found = [describe(decode(x)) for x in images]
    want = plain_groups(found, lambda a, b: copies(*a, *b))
    assert all(want[got[k]] == want[k] for k in range(len(images)))  # no false links
    linked = [k for k in range(len(images)) if want[k] != k]
    assert len(linked) > 50 and sum(got[k] == want[k] for k in linked) >= 0.95 * len(linked)
    assert all(got[1000 + i] == 0 for i in range(5)) and (got[300], got[301], got[302], got[303], got[None]) == (300, 301, 302, 303, 1)
    assert picture_copies(df.limit(0)).count() == 0


def test_full_cells_lose_no_match(spark):
    """Corners that agree in the slice of a full cell alone, corners that agree in a second one too, and corners too far apart."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2, (2, 256)).astype(np.uint8)
    rows = []
    for node in range(9):
        own = base.copy()
        for t in range(1, 8):
            if not (node in (3, 4) and t == 5):
                own[:, 32 * t + node] ^= 1
        if node == 8:
            own[:, 74:80] ^= 1
            own[:, 106:112] ^= 1
        rows.append((node, bytearray(np.packbits(own, axis=1, bitorder="little").tobytes())))
    cells = table_cells(spark.createDataFrame(rows, "node long, bits binary").repartition(2))
    want = {(a, b) for a in range(8) for b in range(a + 1, 8)}
    for crowd in (1000, 8, 5, 2):
        pairs, members = meetings(cells, crowd, 24)
        assert members.isEmpty()
        got = [(r["a"], r["b"]) for r in pairs.collect()]
        assert len(got) == len(set(got)) and set(got) == want, crowd


def test_a_match_of_many_slices_comes_once(spark):
    """Equal corners agree in all eight slices, others in some; every match is one row, and pairs need two corners."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2, (3, 256)).astype(np.uint8)
    rows = []
    for node in range(5):
        own = base.copy()
        for t in range(node + 1):
            own[:, 32 * t + node] ^= 1
        rows.append((node, bytearray(np.packbits(own[: 1 if node == 4 else 3], axis=1, bitorder="little").tobytes())))
    cells = table_cells(spark.createDataFrame(rows, "node long, bits binary").repartition(2))
    got = [tuple(r) for r in matches(cells, 24, in_table).collect()]
    want = {(a, b, i, i) for a in range(5) for b in range(a + 1, 5) for i in range(1 if b == 4 else 3)}
    assert len(got) == len(set(got)) and set(got) == want
    assert {tuple(r) for r in meetings(cells, 1000, 24)[0].collect()} == {(a, b) for a in range(4) for b in range(a + 1, 4)}


def test_pictures_go_to_python_few_at_a_time(spark, monkeypatch):
    """A row is a picture or two sets of corners; 10,000 of them a batch took 3 GB of an executor."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    usual = spark.conf.get(key)
    for name in ("written", "settled"):
        write = getattr(media, name)
        monkeypatch.setattr(media, name, lambda df, table, write=write: seen.append((table, int(spark.conf.get(key)))) or write(df, table))
    images = [(k, bytearray(pgm(p))) for k, p in enumerate(pictures(3))]
    assert picture_copies(spark.createDataFrame(images, "media_id long, image binary"), crowd=0).count() == 3
    assert {t for t, _ in seen} >= {"corners", "picture-links"} and all(n <= 128 for t, n in seen if t in ("corners", "picture-links"))
    assert spark.conf.get(key) == usual


def test_no_random_pair_is_a_copy():
    found = [describe(decode(pgm(p))) for p in pictures(450, 9)]
    pairs = [(i, j) for i in range(len(found)) for j in range(i)]
    assert len(pairs) > 100_000 and not any(copies(*found[i], *found[j]) for i, j in pairs)


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="no test tables here")
def test_recall_of_derived_copies(spark):
    drawn = render(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    source = {r["media_id"]: r["source_id"] for r in drawn.select("media_id", "source_id").collect()}
    got = {r["media_id"]: r["copy_id"] for r in picture_copies(drawn).collect()}
    made = [k for k in source if source[k] != k]
    hits = {kind: [got[k] == got[source[k]] for k in made if kind_of(k) == kind] for kind in KINDS}
    assert sum(map(sum, hits.values())) >= 0.95 * len(made), {k: sum(v) / len(v) for k, v in hits.items()}
    groups = {}
    for k, c in got.items():
        groups.setdefault(c, set()).add(source[k])
    assert all(len(g) == 1 for g in groups.values())
    print({k: round(sum(v) / len(v), 3) for k, v in hits.items()})


def test_turned_pictures_are_copies():
    p = pictures(1)[0]
    assert copies(*describe(p), *describe(np.ascontiguousarray(np.rot90(p))))


def test_formats():
    grey = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert (decode(pgm(grey)) == grey).all()
    assert decode(b"P6 1 1 255\n\x0a\x0a\x0a")[0, 0] == np.float32(10)
    assert decode(b"P5 9 9 255\n\x00") is None and decode(None) is None
