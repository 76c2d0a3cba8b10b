import math
import random

import numpy as np
import pytest

from endpointlens.llm.vector_codes import compress, digest, with_label_errors

SCHEMA = "vec_id long, embedding array<float>, label int, row string, code int"


def slow(rows, parts=8, entries=16, rounds=6):
    """Plain Lloyd on the whole table: rows (vec_id, vector, label)."""
    kept = [(r[0], r[2], [math.floor(4096 * x) for x in r[1]]) for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    books, codes, errors = [], [""] * len(kept), [0] * len(kept)
    width = len(kept[0][2]) // parts
    for p in range(parts):
        cut = [r[2][p * width : (p + 1) * width] for r in kept]
        book = [list(c) for c in cut[:entries]]
        for k in range(rounds + 1):
            away = [[sum((a - b) ** 2 for a, b in zip(c, e)) for e in book] for c in cut]
            chosen = [d.index(min(d)) for d in away]
            if k < rounds:
                for e in range(len(book)):
                    if own := [c for c, x in zip(cut, chosen) if x == e]:
                        book[e] = [sum(v) // len(own) for v in zip(*own)]
        books += book
        for k, (x, d) in enumerate(zip(chosen, away)):
            codes[k] += f"{x:02x}"
            errors[k] += min(d)
    totals = {}
    for r, e in zip(kept, errors):
        totals[r[1]] = totals.get(r[1], 0) + e
    return [(r[0], c, e, totals[r[1]]) for r, c, e in zip(kept, codes, errors)], digest(np.array(books))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def run(spark, rows, **given):
    df = spark.createDataFrame([(*r, "mine", 7) for r in rows], SCHEMA).repartition(5)
    coded, books = compress(df, **given)
    return ordered((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in with_label_errors(coded).collect()), digest(books)


def vectors(seed, n, size=16):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(9)]
    draw = lambda c: [float(np.float32(x + rng.gauss(0, 0.3))) for x in c]
    return [(k, draw(rng.choice(centres)), rng.choice([0, 1, None])) for k in range(n)]


@pytest.mark.parametrize("given", [{}, {"resident": 3}, {"resident": 10**6}, {"rounds": 1}, {"rounds": 0}, {"entries": 5, "parts": 4}])
def test_equals_plain_lloyd(spark, given):
    rows = vectors(2, 160)
    rows += [(500, None, 1), (501, [float("nan")] * 16, 1), (502, [1.0] * 15 + [None], 0), (503, [float("inf")] + [0.0] * 15, 0), (None, rows[3][1], 1), (3, rows[3][1], 1), (4, [0.0] * 16, 2)]
    want = slow(rows, **{k: v for k, v in given.items() if k != "resident"})
    got = run(spark, rows, **given)
    assert got == (ordered(want[0]), want[1])


def test_one_vector_of_most_rows_and_ties(spark):
    rows = [(k, [1.0, -1.0] * 4, 0) for k in range(300)] + [(300 + k, [float(k % 3), 0.5] * 4, 1) for k in range(40)]
    want = slow(rows)
    assert run(spark, rows, resident=20) == (ordered(want[0]), want[1])


def test_fewer_rows_than_entries(spark):
    rows = vectors(4, 5, 8)
    want = slow(rows)
    assert run(spark, rows) == (ordered(want[0]), want[1])


def test_no_rows_other_lengths_and_large_components(spark):
    df = spark.createDataFrame([], SCHEMA)
    coded, books = compress(df)
    assert with_label_errors(coded).collect() == [] and books.size == 0
    assert with_label_errors(coded).columns == ["vec_id", "label", "code", "error", "label_error"]
    rows = vectors(5, 30, 8)
    assert run(spark, [*rows, (90, [1.0] * 16, 0), (91, [], 0)])[0] == ordered(slow(rows)[0])
    with pytest.raises(ValueError):
        run(spark, [(1, [1.0] * 7, 0)])
    with pytest.raises(ValueError):
        run(spark, [(1, [1e6] * 8, 0)])


def test_only_changed_members_move(spark):
    """Residents that keep their entry stay in their partition: the union shuffles nothing."""
    from endpointlens.llm.vector_codes import held, home

    sc = spark.sparkContext
    at = sc.parallelize([(k % 7, (np.array([k]), np.array([[k]]))) for k in range(70)]).partitionBy(4, home)
    kept = held(at)
    stay = kept.filter(lambda r: r[0] != 3)
    joined = held(stay.union(kept.filter(lambda r: r[0] == 3).map(lambda r: (5, r[1])).partitionBy(4, home)))
    assert joined.getNumPartitions() == 4
    found = dict(joined.collect())
    assert sorted(found) == [0, 1, 2, 4, 5, 6] and len(found[5][0]) == 20
