"""Quality, toxicity and language-model scores: held-out accuracy, exact bases, defined edge cases."""

import math
import random
from collections import Counter

import pytest
from endpointlens.llm import quality, toxicity
from endpointlens.llm.suffix_tree import distinct, score_texts
from pyspark.sql import functions as F

SYLLABLES = ["ka", "lo", "mi", "ren", "tu", "sol", "ver", "nd"]


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


def labelled(n=400):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        text, good, toxic = prose(rng, rng.randint(20, 150)), int(i % 4 > 0), int(i % 5 == 0)
        if toxic:
            at = rng.randrange(len(text))
            text = text[:at] + f" {rng.choice(['vilewort', 'vilerna', 'Scumbag'])} " + text[at:]
        if not good:
            text = " ".join(f"{w.upper()}!!" for w in text.split())
        rows.append((i, text, good, toxic, 0.5))
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    df = spark.createDataFrame(labelled(), "doc_id long, text string, quality int, toxic int, score double").cache()
    edge = spark.createDataFrame([(9001, None), (9002, ""), (9003, "ka " * 60_000), (9003, "ka " * 60_000)], "doc_id long, text string")
    return df, df.select("doc_id", "text", "score").unionByName(edge.withColumn("score", F.lit(0.1)))


@pytest.mark.parametrize("module, label, threshold", [(quality, "quality", 0.3), (toxicity, "toxic", 0.5)])
def test_classifiers(spark, corpus, module, label, threshold):
    df, docs = corpus
    train = df.where("doc_id % 5 <> 3").select("doc_id", F.col(label))
    out = {}
    rows = module.judge(docs, train, label).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1
        out[r["doc_id"]] = r["score"]
    held = [r for r in df.where("doc_id % 5 = 3 or doc_id % 10 = 0").collect()]
    right = sum((out[r["doc_id"]] >= threshold) == bool(r[label]) for r in held) / len(held)
    assert right > 0.93, right
    again = {r["doc_id"]: r["score"] for r in module.judge(docs.repartition(3), train, label).collect()}
    assert all(abs(out[k] - again[k]) < 1e-6 for k in out)


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_without_labels(spark, corpus, module, label):
    df, docs = corpus
    none = df.select("doc_id", F.col(label)).limit(0)
    assert {r["score"] for r in module.judge(docs, none, label).collect()} == {0.5 if label == "quality" else 0.0}
    assert module.judge(docs.limit(0), none, label).count() == 0
    ones = df.where(f"{label} = 1").select("doc_id", F.col(label))
    assert len({r["score"] for r in module.judge(docs, ones, label).collect()}) == 1


def planted_votes(n=40_000):
    """Votes of six voters with known rates; the fifth repeats the fourth in four of five rows, whatever the label."""
    import numpy as np

    rng = np.random.default_rng(0)
    y = rng.random(n) < 0.15
    rates = np.array([[0.02, 0.8], [0.05, 0.7], [0.01, 0.5], [0.2, 0.4], [0.2, 0.4], [0.3, 0.3]])
    votes = (rng.random((n, 6)) < np.where(y[:, None], rates[:, 1], rates[:, 0])).astype(float)
    same = rng.random(n) < 0.8
    votes[same, 4] = votes[same, 3]
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    first = np.where(patterns[:, :3].sum(1) >= 1, 0.6, 0.05)
    return rates, patterns, count.astype(float), first


def test_label_model_finds_planted_rates_and_correlation():
    import numpy as np

    rates, patterns, count, first = planted_votes()
    model = toxicity.LabelModel(0.15).fit(patterns, count, first)
    assert np.abs(model.accuracy - rates.T).max() < 0.03
    assert {frozenset((i, j)) for i, j in enumerate(model.parent) if j >= 0} == {frozenset((3, 4))}
    # the pair adds no more than one of its voters: without the tree it counts twice
    both = np.array([[0, 0, 0, 1, 1, 0], [0, 0, 0, 1, 0, 0], [0, 0, 0, 0, 0, 0.0]])
    naive = toxicity.LabelModel(0.15, dependent=np.inf).fit(patterns, count, first)
    logit = lambda p: np.log(p / (1 - p))
    gain = lambda m: logit(m.posterior(both))[0] - logit(m.posterior(both))[2]
    assert gain(model) < 0.8 * gain(naive)


def test_label_model_equals_a_slow_one():
    """Independent voters: every row on its own, by the rule as it reads."""
    import numpy as np

    _, patterns, count, first = planted_votes(3000)
    model = toxicity.LabelModel(0.15, dependent=np.inf).fit(patterns, count, first, rounds=12)
    rows = [(pattern, p) for pattern, n, p in zip(patterns.tolist(), count, first) for _ in range(int(n))]
    for _ in range(12):
        size = [sum(1 - p for _, p in rows), sum(p for _, p in rows)]
        hits = [[sum((p if y else 1 - p) * v[i] for v, p in rows) for i in range(6)] for y in (0, 1)]
        rate = [[(hits[y][i] + (hits[y][i] + 0.5) / (size[y] + 1)) / (size[y] + 1) for i in range(6)] for y in (0, 1)]
        new = []
        for v, _ in rows:
            like = [math.prod(rate[y][i] if v[i] else 1 - rate[y][i] for i in range(6)) for y in (0, 1)]
            new.append((v, 0.15 * like[1] / (0.15 * like[1] + 0.85 * like[0])))
        rows = new
    slow = {tuple(v): p for v, p in rows}
    assert all(abs(p - slow[tuple(v)]) < 1e-6 for v, p in zip(patterns.tolist(), model.posterior(patterns)))


def test_linear_fit_equals_newton(spark):
    """The summed quasi-Newton fit against plain Newton steps on the dense matrix."""
    import numpy as np

    rng = np.random.default_rng(1)
    x = (rng.random((400, 7)) < 0.3).astype(float)
    p = 1 / (1 + np.exp(-(x @ rng.normal(0, 2, 7) - 1)))
    rows = [(np.flatnonzero(r).tolist(), float(q), 2) for r, q in zip(x, p)]
    got = toxicity.linear_fit(spark.createDataFrame(rows, "places array<int>, p double, n long").repartition(3), 7, rounds=60)
    design, beta, ridge = np.c_[x, np.ones(400)], np.zeros(8), np.diag([1.0] * 7 + [0.0])
    for _ in range(30):
        q = 1 / (1 + np.exp(-design @ beta))
        beta -= np.linalg.solve((design * (2 * q * (1 - q))[:, None]).T @ design + ridge, design.T @ (2 * (q - p)) + ridge @ beta)
    assert np.abs(got - beta).max() < 0.1


def test_language_model(spark):
    rng = random.Random(4)
    words = [prose(rng, 1) for _ in range(40)]
    chain = {w: rng.sample(words, 2) for w in words}

    def text(n):
        w, out = rng.choice(words), []
        for _ in range(n):
            out.append(w)
            w = rng.choice(chain[w])
        return " ".join(out)

    docs = [(i, text(rng.randint(0, 80)).title() if i % 7 == 0 else text(rng.randint(0, 80))) for i in range(300)] + [(500, None), (501, " \n"), (502, "new words \x1c here"), (503, None), (503, "a\tb\x0bc")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string")
    held = lambda i: i % 10 == 0
    rows = score_texts(df, F.col("doc_id") % 10 == 0, block_tokens=500).collect()
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for _, t in docs]
    counts = Counter(w for (i, _), ws in zip(docs, tokens) if not held(i) for w in ws)
    n, distinct = sum(counts.values()), len(counts)
    base = lambda ws: sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (distinct + 1))) for w in ws)
    want = sorted((i, len(ws), sum(counts[w] > 0 for w in ws), round(base(ws), 6)) for (i, _), ws in zip(docs, tokens))
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows) == want
    assert {r["train_tokens"] for r in rows} == {n}
    out = [r for r in rows if r["held_out"]]
    assert all(held(r["doc_id"]) for r in out)
    assert sum(r["score"] for r in out) > 0.6 * sum(r["base_score"] for r in out)  # two followers a word are learned
    assert all(r["score"] < 0 for r in rows)
    nothing = score_texts(df, F.lit(True)).collect()
    assert {r["base_score"] for r in nothing} == {0.0} and score_texts(df.limit(0), F.lit(False)).count() == 0


class SlowTree:
    """The suffix tree from dictionaries of word tuples, tested context by context."""

    def __init__(self, texts, depth, least=2, discount=0.5, strict=3.0):
        self.counts = Counter(tuple(t[i : i + n]) for t in texts for n in range(1, depth + 2) for i in range(len(t) - n + 1))
        self.words = sorted({w for t in texts for w in t})
        self.total, self.discount, self.least, self.rest = sum(map(len, texts)), discount, least, {}
        after = {}
        for g, n in self.counts.items():
            if len(g) > 1 and n >= least:
                after.setdefault(g[:-1], []).append((g[-1], n))
        for k in range(1, depth + 1):
            found = {}
            for c, own in after.items():
                if len(c) == k:
                    above, n = self.counts[c], sum(x for _, x in own)
                    low = {v: self.p(v, c[1:]) for v, _ in own}
                    gain, left = sum(x * math.log(x / above / low[v]) for v, x in own), 1 - n / above
                    under = max(1 - sum(low.values()), 1e-12)
                    gain += above * left * math.log(left / under) if left > 0 else 0
                    if 2 * gain > len(own) + strict * math.sqrt(2 * len(own)):
                        found[c] = max(1 - (n - discount * len(own)) / above, 1e-12) / under
            self.rest |= found
            if not found:
                break

    def p(self, word, context):
        """Probability of a word (None: one unknown word) after a tuple of words."""
        if not context:
            return (self.counts[(word,)] + 0.1) / (self.total + 0.1 * (len(self.words) + 1))
        if context not in self.rest:
            return self.p(word, context[1:])
        n = self.counts[(*context, word)]
        return (n - self.discount) / self.counts[context] if n >= self.least else self.rest[context] * self.p(word, context[1:])


def chained(rng, words, followers, n):
    chain = {w: rng.sample(words, followers) for w in words}
    pairs = {(a, b): rng.choice(words) for a in words for b in chain[a]}
    out = [rng.choice(words), rng.choice(words)]
    while len(out) < n:
        out.append(pairs[tuple(out[-2:])] if tuple(out[-2:]) in pairs and rng.random() < 0.5 else rng.choice(chain[out[-1]]))
    return out[:n]


def test_language_model_equals_a_slow_tree(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(25)]
    stream = chained(rng, words, 4, 9000)
    docs, at = [], 0
    for k in range(320):
        n = rng.randint(0, 45)
        docs.append((k, " ".join(stream[at : at + n])))
        at += n
    docs += [(1000 + k, docs[7][1]) for k in range(4)] + [(2001, "rare one here and there"), (2002, "rare one here and there"), (2010, "rare one here and now")]
    held = lambda k: k % 10 == 0
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    texts = {k: [*t.split(), "END"] for k, t in docs}
    for depth in (1, 3, 5):
        tree = SlowTree([t for k, t in texts.items() if not held(k)], depth)
        assert max(map(len, tree.rest)) >= min(depth, 3)
        got = {r["doc_id"]: r["score"] for r in score_texts(df, F.col("doc_id") % 10 == 0, depth=depth, block_tokens=700).collect()}
        for k, t in texts.items():
            want = sum(math.log10(tree.p(w, tuple(t[max(0, i - depth) : i]))) for i, w in enumerate(t))
            assert abs(want - got[k]) < 1e-5 * len(t), (depth, k)


def test_told_answers_are_not_shuffled_again(spark):
    """What rounds told lies in the buckets of its blocks; shuffling all of it again in each round took the disk."""
    df = spark.createDataFrame([(k, f"a b c{k % 3} d a b") for k in range(40)], "doc_id long, text string").repartition(2)
    plan = score_texts(df, F.col("doc_id") % 10 == 0, block_tokens=50)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "answers_" in plan


def test_distinct_keys():
    import numpy as np

    rng = np.random.default_rng(3)
    wide = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    for keys in (wide[:0], wide[:1], wide, rng.choice(wide[:200], 5000), rng.integers(0, 40, 1000).astype(np.uint64), np.array([9, 8, 9, 8, 1], np.uint64)):
        for got, want in zip(distinct(keys), np.unique(keys, return_index=True, return_inverse=True)):
            assert (got == want).all()


def test_slow_tree_is_a_distribution():
    rng = random.Random(2)
    stream = chained(rng, [f"w{k}" for k in range(8)], 3, 3000)
    tree = SlowTree([[*stream[k : k + 30], "END"] for k in range(0, 3000, 30)], 4)
    for k in range(0, 2900, 7):
        for n in range(5):
            context = tuple(stream[k : k + n])
            assert abs(sum(tree.p(w, context) for w in [*tree.words, None]) - 1) < 1e-9
