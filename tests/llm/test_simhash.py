import random

import numpy as np
import pytest
import xxhash

from endpointlens.llm.simhash import cells_of, components, embed, fingerprint, hamming_links, near_duplicates, shingle_hashes, similar_documents


def slow(text):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(items, near):
    """Smallest reachable index by brute force."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if near(items[i], items[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def test_fingerprints():
    for text in [None, "", " \n ", "one", "One TWO", "a b c", "a b c d e f g " * 5000, "ÄÖ \x1c x\x0by z"]:
        assert fingerprint(shingle_hashes(text, 3, 42)) & (2**64 - 1) == slow(text)


@pytest.mark.parametrize("width", [4, 2, 1])
def test_embedding_bounds_hamming(width):
    rng = np.random.default_rng(1)
    a = rng.integers(-(2**63), 2**63 - 1, 300, dtype=np.int64)
    b = a ^ (np.int64(1) << rng.integers(0, 63, 300)) ^ (np.int64(1) << rng.integers(0, 63, 300))
    hamming = np.bitwise_count((a ^ b).view(np.uint64))
    points = [[[(int(p) >> at) & ((1 << width) - 1) for at in range(0, 64, width)] for p in embed(x, width)] for x in (a, b)]
    assert points[0][0] == [bin((int(a[0]) >> at) & ((1 << width) - 1)).count("1") for at in range(0, 64, width)]
    assert (np.abs(np.array(points[0]) - np.array(points[1])).sum(1) <= hamming).all()
    for x, y in zip(a[:50], b[:50]):
        cells = [set(cells_of(np.array([v], np.int64), width)[1].tolist()) for v in (x, y)]
        assert cells[0] & cells[1]  # at distance two or less they meet


def test_links_are_all_pairs_in_light_and_crowded_cells(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base[:10]:  # dense groups and chains
        for _ in range(60):
            b ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            fps.add(b)
        for _ in range(40):
            fps.add(base[0] ^ (1 << rng.randrange(64)))
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(0, f) for f in fps] + [(1, f) for f in fps[::3]], "draw int, fp long")
    place = {f: k for k, f in enumerate(fps)}
    near = {(0, i, j) for i in range(len(fps)) for j in range(len(fps)) if fps[i] < fps[j] and ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 2}
    near |= {(1, i, j) for _, i, j in near if i % 3 == 0 and j % 3 == 0}
    for crowd in (1, 8, 1000):
        got = [(r["draw"], place[r["a"]], place[r["b"]]) for r in hamming_links(df, crowd).collect()]
        assert len(got) == len(set(got)) and set(got) == near, crowd


def test_cells_are_shuffled_once(spark):
    """Not once to be counted and again to be joined with their counts, which made the shuffle grow faster than the input."""
    rng = np.random.default_rng(5)
    fps = rng.integers(-(2**63), 2**63 - 1, 2000)
    df = spark.createDataFrame([(0, int(f) ^ k) for f in fps for k in (0, 1)], "draw int, fp long")
    cells = sum(len(cells_of(np.array([f, f ^ 1], np.int64), 4)[1]) for f in fps)
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)

    def records():
        stages = store.stageList(None, False, False, none, None)
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = records()
        assert hamming_links(df).count() == 2000
        written = records() - before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # every cell once; the rest are members of the shared ones (44 of the 60-odd cells of a pair of fingerprints are)
    assert written < 2.5 * cells, (written, cells)


def test_components_chain_and_star(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{k: 1 for k in range(2, 41)}, **{k: 100 for k in range(101, 130)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    long = " ".join(f"w{k}" for k in range(400))
    docs = [(4, long), (9, long), (2, long.replace("w7 ", "W7  ")), (11, None), (12, ""), (13, "alone in the world"), (13, "alone in the world"), (20, "x")]
    df = spark.createDataFrame([(*d, "extra") for d in docs], "doc_id long, text string, fp string")
    out = sorted((r["doc_id"], r["component_id"]) for r in near_duplicates(df).collect())
    assert out == [(2, 2), (4, 2), (9, 2), (11, 11), (12, 11), (13, 13), (13, 13), (20, 20)]
    assert near_duplicates(df.limit(0)).count() == 0


def sets_of(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def test_similar_documents(spark):
    """Against all pairs by brute force: texts around the limit, groups of copies, a passage that many texts share."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = " ".join(word() for _ in range(60))
    texts = []
    for k in range(120):
        base = [word() for _ in range(rng.randint(60, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            own = list(base)
            for _ in range(rng.randint(1, max(1, len(base) // 40))):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
    texts += [passage + " " + " ".join(word() for _ in range(80)) for _ in range(60)]
    texts += [texts[0].upper().replace(" ", "\n ")] * 30 + [None, "", " \n", "two words", "Two  words", "x"]
    rows = [(k, t, "extra", 1) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "row long, text string, same string, node int").repartition(4)
    got = {r["row"]: r["group"] for r in similar_documents(df).collect()}
    sets = [sets_of(t) for t in texts]
    alike = lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    want = groups(list(range(len(texts))), alike)
    assert sorted(got) == list(range(len(texts)))
    assert all(want[k] == want[got[k]] for k in got)  # no false links
    linked = [k for k in got if want[k] != k]
    assert sum(got[k] == want[k] for k in linked) >= 0.98 * len(linked)
    assert similar_documents(df.limit(0)).count() == 0


def test_few_draws_go_through_the_grid_at_once(spark, monkeypatch):
    """Cells of all draws never lie on disk together: the grid gets two draws at a time, and every draw once."""
    from endpointlens.llm import simhash

    seen, whole = [], simhash.hamming_links

    def watched(points, crowd):
        seen.append(sorted(r["draw"] for r in points.select("draw").distinct().collect()))
        return whole(points, crowd)

    monkeypatch.setattr(simhash, "hamming_links", watched)
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{i}" for i in range(9))) for k in range(4)], "row long, text string")
    assert simhash.similar_documents(docs, draws=3).count() == 4
    assert seen == [[0, 1], [2]]
