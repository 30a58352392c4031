import random

import numpy as np

from helpers import CLASHING, docs, vocabulary
from martforge.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed=1):
    """Two languages; toxic texts hold a bad word, in the second one with changing ends."""
    rng = random.Random(seed)
    words = {"aa": vocabulary(600, 1), "bb": [w + "z" for w in vocabulary(600, 2)]}
    rows, labels = [], []
    for i in range(n):
        lang = "aa" if i % 3 else "bb"
        own = [rng.choice(words[lang]) for _ in range(rng.randint(20, 120))]
        toxic = int(rng.random() < 0.25)
        for _ in range(toxic * rng.randint(1, 3)):
            own[rng.randrange(len(own))] = rng.choice(["vilest", "crudex"]) if lang == "aa" else "qwurk" + rng.choice(vocabulary(300, 3))
        rows.append((i, " ".join(own), lang, "s", 0))
        labels.append((i, 1, toxic))
    return rows, labels


def test_held_out_accuracy_and_inputs(spark):
    rows, labels = corpus(1500)
    frame, label = docs(spark, rows), spark.createDataFrame(labels, LABELS)
    model = toxicity.train(frame, label.filter("doc_id % 3 <> 0 OR doc_id % 2 = 0"))
    got = {r["row"]["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score(frame, model).collect()}
    held = [i for i in got if i % 3 == 0 and i % 2]
    truth = {i: t for i, _, t in labels}
    assert np.mean([got[i][1] == truth[i] for i in held]) > 0.93
    assert all(0 <= s <= 1 and p == (s >= 0.5) for s, p in got.values())
    # Neither ids, languages nor sources change a score; training again gives the same model.
    other = docs(spark, [(i + 10**6, t, None, "x", None) for i, t, *_ in rows], CLASHING)
    again = {r["row"]["doc_id"] - 10**6: r["score"] for r in toxicity.score(other, toxicity.train(
        frame, label.filter("doc_id % 3 <> 0 OR doc_id % 2 = 0"))).collect()}
    assert all(abs(again[i] - got[i][0]) < 1e-5 for i in got)


def test_whole_texts_are_read(spark):
    rows, labels = corpus(900, 2)
    model = toxicity.train(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    clean = next(t for (i, t, *_), (_, _, y) in zip(rows, labels) if not y and i % 3)
    long = " ".join([clean] * 400)
    frame = docs(spark, [(1, long), (2, long + " vilest"), (3, None), (4, ""), (5, " \n"), (5, " \n"), (None, "vilest crudex")])
    got = {r["row"]["doc_id"]: r["score"] for r in toxicity.score(frame, model).collect()}
    assert got[2] > 0.5 > got[1] and got[None] > 0.5
    assert got[3] == got[4] == got[5] < 0.5


def test_without_labels_or_with_one_kind(spark):
    frame = docs(spark, [(1, "a"), (2, None)])
    none = spark.createDataFrame([], LABELS)
    assert [r["score"] for r in toxicity.score(frame, toxicity.train(frame, none)).collect()] == [0.0, 0.0]
    ones = spark.createDataFrame([(1, 0, 1), (9, 0, 1), (2, None, None), (None, 1, 1)], LABELS)
    assert [r["predicted"] for r in toxicity.score(frame, toxicity.train(frame, ones)).collect()] == [1, 1]
    assert toxicity.score(docs(spark, []), toxicity.train(frame, ones)).count() == 0


def test_few_texts_train(spark):
    frame = docs(spark, [(1, "bad"), (2, "good"), (3, None), (4, "")])
    model = toxicity.train(frame, spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 1, 0), (4, 1, 1)], LABELS))
    assert toxicity.score(frame, model).count() == 4


def test_gradient_is_that_of_the_loss():
    net = toxicity.Network(3)
    rng = np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["out"] += 1
    lengths = [5, 1, 9]
    x = np.zeros((sum(lengths) + 9, toxicity.DIM))
    bounds, at = [], 0
    for n in lengths:
        x[at:at + n] = rng.normal(size=(n, toxicity.DIM))
        bounds.append((at, at + n))
        at += n + 3
    y, w = np.array([1.0, 0, 1]), np.array([1.0, 2, 0.5])

    def loss():
        z = net.responses(x)
        pooled = np.concatenate([np.stack([np.maximum(q[a:b].max(axis=0), 0) for a, b in bounds]) for q in z], axis=1)
        logit = pooled @ net.p["out"] + net.p["bias"][0]
        return float((w * (np.log1p(np.exp(logit)) - y * logit)).sum())

    grads, rows, own = net.gradient(x, bounds, y, w)
    for name in ("w1", "w2", "w3", "b2", "out", "bias"):
        flat, g = net.p[name].reshape(-1), grads[name].reshape(-1)
        for i in range(0, flat.size, max(1, flat.size // 5)):
            flat[i] += 1e-5
            up = loss()
            flat[i] -= 2e-5
            slope = (up - loss()) / 2e-5
            flat[i] += 1e-5
            assert abs(slope - g[i]) < 1e-3 * max(1, abs(slope))
    full = np.zeros_like(x)
    np.add.at(full, rows, own)
    x[2, 1] += 1e-5
    up = loss()
    x[2, 1] -= 2e-5
    assert abs((up - loss()) / 2e-5 - full[2, 1]) < 1e-3


def test_the_whole_training_sample_is_drawn(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(toxicity, "Classifier", lambda rows, shares: taken.extend(y for _, y, _ in rows))
    frame = docs(spark, [(i, f"text {i}") for i in range(14_000)])
    toxicity.train(frame, spark.createDataFrame([(i, 1, int(i % 2)) for i in range(14_000)], LABELS))
    assert abs(sum(taken) - 3000) < 200 and abs(len(taken) - sum(taken) - 5000) < 200


def test_fit_learns_from_every_labelled_text(spark):
    rows, labels = corpus(1200, 3)
    # One bad word stands in few texts, which a sample of 60 would hardly hold.
    rows = [(i, t + " zzrarest" if i % 50 == 0 else t, *rest) for i, t, *rest in rows]
    labels = [(i, 1, 1 if i % 50 == 0 else y) for i, _, y in labels]
    frame, label = docs(spark, rows), spark.createDataFrame(labels, LABELS)
    seen = toxicity._counted(toxicity._labelled(frame, label, "doc_id", "text", "lang", "toxic"))
    whole = sum(n for k, b, n in zip(*(seen.column(c).to_pylist() for c in ("kind", "bucket", "n"))) if k == "1" and b == toxicity.features([b"zzrarest"])[0][0])
    assert whole >= 24
    model = toxicity.fit(frame, label, toxic=20, clean=40)
    got = {r["row"]["doc_id"]: r["predicted"] for r in toxicity.score(frame, model).collect()}
    assert np.mean([got[i] == y for i, _, y in labels]) > 0.93 and np.mean([got[i] for i in got if i % 50 == 0]) > 0.8
    again = toxicity.fit(frame, label, toxic=20, clean=40)
    assert np.allclose(again.network.p["embedding"], model.network.p["embedding"], atol=1e-5)


def test_rounds_move_no_texts(spark, monkeypatch):
    """Each round trains every text where it is stored, in as few tasks as asked for, whatever the shuffle partitions are."""
    rows, labels = corpus(300, 4)
    stored = toxicity.written(toxicity._labelled(docs(spark, rows), spark.createDataFrame(labels, LABELS), "doc_id", "text", "lang", "toxic"), "labelled")
    model = toxicity.Classifier([], {})
    model.network = toxicity.Network(1)
    monkeypatch.setattr(type(stored), "repartition", None)  # not to be called
    sent, collect = [], type(stored).collect
    monkeypatch.setattr(type(stored), "collect", lambda df: sent.append(collect(df)) or sent[-1])
    first = toxicity._round(stored, model, 1, 2)
    assert len(sent[0]) <= 2 and sum(r["n"] for r in sent[0]) == 300
    assert all(np.array_equal(v, first[k]) for k, v in toxicity._round(stored, model, 1, 2).items())


def test_sums_by_row_are_those_of_add_at():
    rng = np.random.default_rng(5)
    to, of, values = rng.zipf(1.5, 3000) % 40, rng.integers(0, 500, 3000), rng.normal(size=(500, 4))
    want = np.zeros((40, 4), dtype=np.float32)
    np.add.at(want, to, values[of])
    assert np.array_equal(toxicity.summed(to, of, values, want), want)
    assert not toxicity.summed(to[:0], of[:0], values, want).any()


def test_words_are_numbered_by_text():
    own, at, ends = toxicity.numbered([[b"b", b"a", b"b"], [], [b"c", b"a"]])
    assert own == [b"b", b"a", b"c"] and at.tolist() == [0, 1, 0, 2, 1] and ends.tolist() == [3, 3, 5]
    assert toxicity.numbered([[], []])[0] == []


def test_a_score_does_not_depend_on_the_texts_beside_it(spark):
    rows, labels = corpus(300, 6)
    model = toxicity.train(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    every = [t.encode() for _, t, *_ in rows] + [None, b""]
    kept = {}
    parts = [x for a in range(0, len(every), 70) for x in model.scores(every[a:a + 70], kept)]
    assert np.allclose(parts, model.scores(every, {}), atol=1e-5)
