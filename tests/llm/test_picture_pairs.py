import numpy as np
import pytest
from endpointlens.llm import media
from endpointlens.llm.media import cell_matches, copies, decode, describe, meetings, neighbours, pair_keys, pair_meetings, picture_copies, table_cells
from endpointlens.llm.pictures import KINDS, draw, edited, pgm


def pictures(n, seed=1):
    rng = np.random.default_rng(seed)
    return [draw(rng.random(4).tolist()) for _ in range(n)]


def test_unrelated_pictures_rarely_meet(spark, monkeypatch):
    """Corners of unrelated pictures are often alike; matches of single corners grew with the square of the pictures."""
    own, seen = pictures(400, 5), []
    images = own + [edited(p, i, KINDS[i % 5]) for i, p in enumerate(own[:10])]
    real = media.verified
    monkeypatch.setattr(media, "verified", lambda described, pairs, least: seen.append(pairs.count()) or real(described, pairs, least))
    df = spark.createDataFrame([(i, bytearray(pgm(p))) for i, p in enumerate(images)], "media_id long, image binary")
    got = {r["media_id"]: r["copy_id"] for r in picture_copies(df).collect()}
    assert sum(got[400 + i] == i for i in range(10)) >= 9
    assert sum(seen) <= 16


def test_pairs_lose_few_links_of_single_corners(spark):
    """Pairs of corners keep the copies that two matching single corners find, and others."""
    own = pictures(100, 7)
    found = [describe(decode(pgm(p))) for p in own + [edited(p, i, KINDS[i % 5]) for i, p in enumerate(own)]]
    rows = [(i, len(p), bytearray(p.astype("<f4").tobytes()), bytearray(d.tobytes())) for i, (p, d) in enumerate(found)]
    df = spark.createDataFrame(rows, "node long, n_corners int, places binary, bits binary").repartition(3)
    links = {(i, 100 + i) for i in range(100) if copies(*found[i], *found[100 + i])}
    true = lambda pairs: {(r["a"], r["b"]) for r in pairs.collect()} & links
    by_corners, (pairs, members) = true(meetings(table_cells(df), 4096, 24)[0]), pair_meetings(df, 4096, 10)
    by_pairs = true(pairs)
    assert members.isEmpty() and len(links) >= 95
    assert len(by_pairs) >= len(by_corners) - 1 and len(by_corners - by_pairs) <= 2, (len(links), len(by_corners), len(by_pairs))


@pytest.mark.parametrize("crowd", [100, 20, 3, 0])
def test_matches_of_a_cell_as_by_brute_force(crowd):
    """Every match comes once, or both members are in one star."""
    rng = np.random.default_rng(crowd)
    base = rng.integers(0, 1 << 32, (4, 3), np.uint32)
    n = 90
    checks = base[rng.integers(0, 4, n)] ^ (np.uint32(1) << rng.integers(0, 32, (n, 3), np.uint32)) * rng.integers(0, 2, (n, 3), np.uint32)
    keys, nodes = np.sort(rng.integers(0, 3, n).astype(np.uint32)), rng.integers(0, 60, n)
    order = np.lexsort((nodes, keys))
    nodes = nodes[order]
    near = {(x, y) for y in range(n) for x in range(y) if keys[x] == keys[y] and nodes[x] != nodes[y] and np.bitwise_count(checks[x] ^ checks[y]).sum() <= 4}
    pairs, stars = [], {}
    for x, y, star in cell_matches(keys, nodes, checks, crowd, 4):
        pairs += [] if star else list(zip(x.tolist(), y.tolist()))
        if star:
            stars[int(x[0])] = {int(x[0]), *y.tolist()}
    assert len(pairs) == len(set(pairs)) and set(pairs) <= near and all((h, y) in near for h, own in stars.items() for y in own - {h})
    assert all(p in pairs or any(set(p) <= own for own in stars.values()) for p in near)
    assert bool(stars) == (crowd < 10) and all(len(own) > crowd + 1 for own in stars.values())


def test_parts_hold_every_key_once():
    places, bits = zip(*(describe(p) for p in pictures(5)))
    counts = np.array([len(p) for p in places])
    places, bits = np.concatenate(places).astype("<f4"), np.concatenate(bits)
    pieces = list(neighbours(counts, 50))
    i, j = np.concatenate([a for a, _ in pieces]), np.concatenate([b for _, b in pieces])
    picture = np.repeat(np.arange(5), counts)
    assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a in range(len(picture)) for b in range(a + 1, len(picture)) if picture[a] == picture[b]]
    whole = pair_keys(places, bits, i, j, 3)
    parts = [pair_keys(places, bits, i, j, 3, part, 4) for part in range(4)]
    assert sorted(np.concatenate([k for _, k, _ in parts]).tolist()) == sorted(whole[1].tolist())
    # the same pair turned, at another size and with its corners in another order is the same key
    moved = places.copy()
    moved[:, 0], moved[:, 1], moved[:, 2], moved[:, 3] = -1.5 * places[:, 1], 1.5 * places[:, 0], 1.5 * places[:, 2], places[:, 3] + np.pi / 2
    again = pair_keys(moved[::-1].copy(), bits[::-1].copy(), len(bits) - 1 - j, len(bits) - 1 - i, 3)
    assert len(set(again[1].tolist()) & set(whole[1].tolist())) >= 0.95 * len(set(whole[1].tolist()))
