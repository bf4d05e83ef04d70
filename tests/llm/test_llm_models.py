"""The mixture and the co-training against plain versions of the same methods."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wageledger.llm import languages, quality_model

WORDS = {
    "aa": "the cat and a dog went over this wide green field then home".split(),
    "bb": "der hund und die katze gehen heute nach hause zum garten".split(),
    "cc": "le chien et la chatte vont vers cette maison du jardin vert".split(),
    "dd": "kissa ja koira menivat yli vihrean niityn kotiin illalla".split(),
}


def learned(spark):
    rng = random.Random(1)
    rows = [(" ".join(rng.choices(w, k=200)), lang) for lang, w in WORDS.items() for _ in range(6)]
    return languages.learn(spark.createDataFrame(rows, "text string, lang string"))


def brute_fit(seen, counts):
    """Long expectation maximisation, a trigram at a time."""
    share = [1 / seen.shape[1]] * seen.shape[1]
    for _ in range(100):
        new = [0.0] * len(share)
        for row, n in zip(seen, counts, strict=True):
            joint = sum(p * s for p, s in zip(row, share, strict=True))
            for j, (p, s) in enumerate(zip(row, share, strict=True)):
                new[j] += n * p * s / joint
        share = [x / sum(new) for x in new]
    return sum(n * np.log(sum(p * s for p, s in zip(row, share, strict=True))) for row, n in zip(seen, counts, strict=True)), share


def test_mixtures_are_the_best_of_all_language_sets(spark):
    model = learned(spark)
    assert model.names == tuple(WORDS)
    rng = random.Random(2)
    for parts in ({"aa": 60}, {"aa": 40, "cc": 40}, {"bb": 60, "dd": 25}, {"aa": 30, "bb": 30, "cc": 30}, {"cc": 3}):
        text = " ".join(" ".join(rng.choices(WORDS[lang], k=n)) for lang, n in parts.items())
        found = languages.trigrams(text)
        buckets, counts = np.unique(found, return_counts=True)
        seen = model.likelihood[buckets]
        best = {}
        for size in range(1, 5):
            for chosen in combinations(range(4), size):
                value, share = brute_fit(seen[:, chosen], counts)
                best[chosen] = (value - (size - 1) * languages.PENALTY * np.log(len(found)), share)
        top = max(best, key=lambda c: best[c][0])
        got = model.mixture(text)
        assert set(got) == {model.names[j] for j in top} == set(parts)
        for j, p in zip(top, best[top][1], strict=True):
            assert abs(got[model.names[j]] - p) < 0.01


def test_learned_counts_equal_brute_force(spark):
    rows = [("Ab ab", "x"), ("ab 12 b", "x"), ("ß", "y"), (None, "x"), ("lost", None), ("lost", " ")]
    model = languages.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.names == ("x", "y")
    table = np.full((languages.BUCKETS, 2), languages.SMOOTHING)
    for text, lang in rows[:3]:
        for b in languages.trigrams(text):
            table[b, "xy".index(lang)] += 1
    assert np.allclose(model.likelihood, table / table.sum(axis=0))


def documents(n=160):
    rng = random.Random(3)
    good, bad = "river stone meadow quiet morning letter window garden".split(), "buy now cheap click win prize offer free".split()
    rows = []
    for i in range(n):
        kind = rng.random() < 0.5
        text = " ".join(rng.choices(good if kind else bad, k=rng.randrange(5, 60))) + ("." if kind else "!!! 99")
        rows.append((i, text, "en" if i % 5 else None, "journal" if kind == (rng.random() < 0.9) else "shop", kind))
    return rows


def plain_training(rows, labels, exchanged):
    """The same exchange over lists, without Spark."""
    y_of = dict(labels)
    views = {i: (quality_model.content(t).astype(np.float16).astype(np.float32), quality_model.metadata(t, s, lang)) for i, t, lang, s, _ in rows}
    known = sorted(y_of, key=lambda i: (y_of[i], views[i][0].astype(np.float16).tobytes(), views[i][1].tobytes()))
    apart = quality_model.set_apart(np.array([y_of[i] for i in known]))
    known = [i for flag in (True, False) for i, here in zip(known, apart, strict=True) if here == flag]
    used = set(known)
    widths = [len(x) for x in views[known[0]]]

    def exchange(models, scales):
        picked = []
        for k in (0, 1):
            exact = {i: (quality_model.content(t), quality_model.metadata(t, s, lang))[k] for i, t, lang, s, _ in rows if i not in used}
            p = {i: float(quality_model._sigmoid(scales[k].logit(np.array([models[k].logit(x) / 4])))) for i, x in exact.items()}
            mine = []
            for label in (0.0, 1.0):
                sure = [(max(q, 1 - q), i) for i, q in p.items() if (q >= 0.5) == bool(label) and max(q, 1 - q) >= quality_model.CONFIDENT]
                mine += [(i, label) for _, i in sorted(sure, reverse=True)[:exchanged]]
            picked.append(mine)
        used.update(i for mine in picked for i, _ in mine)
        given = []
        for mine in picked:
            mine.sort(key=lambda m: (views[m[0]][0].astype(np.float16).tobytes(), views[m[0]][1].tobytes(), m[1], m[0]))
            a, b = (np.array([views[i][j] for i, _ in mine], np.float32).reshape(len(mine), n) for j, n in enumerate(widths))
            given.append((a, b, np.array([z for _, z in mine])))
        return given

    a, b = (np.array([views[i][k] for i in known]) for k in (0, 1))
    return quality_model.co_train(a, b, np.array([y_of[i] for i in known]), exchange, int(apart.sum())), used


@pytest.mark.parametrize("exchanged", [3, 200])
def test_co_training_equals_a_plain_version(spark, monkeypatch, exchanged):
    monkeypatch.setattr(quality_model, "EXCHANGED", exchanged)
    rows = documents()
    labels = [(i, float(kind)) for i, *_, kind in rows[:40]]
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string").repartition(7)
    got = quality_model.train(docs, spark.createDataFrame(labels, "doc_id long, quality double"))
    want, used = plain_training(rows, labels, exchanged)
    assert len(used) > 40
    for mine, other in ((got.content, want.content), (got.metadata, want.metadata), (got.combined, want.combined)):
        assert np.allclose(mine.weights, other.weights, atol=1e-4) and abs(mine.bias - other.bias) < 1e-4
    scored = quality_model.score(docs, got).collect()
    right = np.mean([(r.score >= 0.5) == rows[r.doc_id][4] for r in scored])
    assert right > 0.95


def test_pseudo_labels_come_from_all_documents(spark):
    """Every document without a label is scored in a round, not a sample of them."""
    rows = documents(300)
    docs = spark.createDataFrame([(r[0], r[1], r[3], r[2]) for r in rows], "id long, t string, s string, l string")
    model = quality_model.Linear(np.zeros(quality_model.CONTENT, np.float32), 0.0)
    other = quality_model.Linear(np.zeros(quality_model.SOURCES + quality_model.LANGS + 8, np.float32), 0.0)
    sure = quality_model.Linear(np.zeros(1, np.float32), 9.0)
    found = quality_model._confident(docs, {0, 1, 2}, [model, other], [sure, sure])
    assert found.groupBy("view", "label").count().collect() and found.count() == 2 * quality_model.EXCHANGED
    assert found.agg(F.min("id")).first()[0] >= 3
