import math
import random
from collections import Counter, defaultdict

import numpy as np

from helpers import CLASHING, docs, vocabulary
from martforge.llm import language_id


def plain_ppm(train, text, order=3):
    """Bits of a text by dictionaries: method C, escape by escape."""
    follow = defaultdict(Counter)
    data = b"".join(b"\n" * order + t.lower() for t in train)
    for n in range(order + 1):
        for i in range(order, len(data)):
            follow[data[i - n:i]][data[i]] += 1
    padded, bits = b"\n" * order + text.lower(), 0.0
    for i in range(order, len(padded)):
        for n in range(order, -1, -1):
            own = follow.get(padded[i - n:i])
            if not own:
                continue
            seen, kinds = sum(own.values()), len(own)
            if padded[i] in own:
                bits -= math.log2(own[padded[i]] / (seen + kinds))
                break
            bits -= math.log2(kinds / (seen + kinds))
        else:
            bits += 8
    return bits


def corpus(n, seed=0):
    rng = random.Random(seed)
    words = {"xx": vocabulary(300, 1), "yy": ["k" + w[::-1] for w in vocabulary(300, 2)], "é": [w + "é" for w in vocabulary(200, 3)]}
    return [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 40))), lang)
            for i, lang in ((i, list(words)[i % 3]) for i in range(n))]


def test_code_lengths_equal_a_plain_ppm():
    rows = [(lang, t.encode()) for _, t, lang in corpus(60)]
    model = language_id.Model(rows)
    probes = [t.encode() for _, t, _ in corpus(20, 9)] + [b"", b"a", "ÿ☃ unseen 123".encode(), bytes(range(1, 128)), b"ab " * 5000]
    got = model.code_lengths(probes)
    for i, text in enumerate(probes):
        for j, lang in enumerate(model.langs):
            want = plain_ppm([t for la, t in rows if la == lang], text)
            assert abs(got[i, j] - want) < 1e-3 * max(1, want)


def test_blocks_do_not_change_code_lengths(monkeypatch):
    model = language_id.Model([(lang, t.encode()) for _, t, lang in corpus(30)])
    probes = [t.encode() for _, t, _ in corpus(12, 4)] + [b"", b"long text " * 400]
    whole = model.code_lengths(probes)
    monkeypatch.setattr(language_id, "BLOCK", 37)
    assert np.allclose(model.code_lengths(probes), whole, rtol=1e-6)


def test_held_out_accuracy(spark):
    rows = [(i, t, lang) for i, t, lang in corpus(900)]
    frame = docs(spark, rows, "doc_id long, text string, lang string")
    model = language_id.train(frame.filter("doc_id % 4 <> 0"))
    got = {r["row"]["doc_id"]: r for r in language_id.detect(frame, model).collect()}
    held = [(i, lang) for i, _, lang in rows if i % 4 == 0]
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_nulls_letters_and_clashing_columns(spark):
    frame = docs(spark, [(1, None), (2, ""), (3, "12 34!"), (4, "é"), (5, "ab " * 60_000), (None, "ab"), (4, "é")], CLASHING)
    model = language_id.Model([("aa", b"ab ab ab"), ("bb", b"xyz xyz")])
    got = language_id.detect(frame, model)
    found = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0)
    assert found[5][0] == found[None][0] == "aa" and found[4][0] in ("aa", "bb")
    assert got.select("row.*").columns == frame.columns


def test_empty_tables_and_no_labels(spark):
    empty = language_id.train(docs(spark, []))
    assert [r["lang_pred"] for r in language_id.detect(docs(spark, [(1, "text")]), empty).collect()] == ["und"]
    assert language_id.train(docs(spark, [(1, "text", None), (2, None, "xx")])).predict([b"a"])[0] in (["und"], ["xx"])
    assert language_id.detect(docs(spark, []), empty).count() == 0


def test_sample_is_bounded_and_stable(spark):
    frame = docs(spark, [(i, f"text {i}", "hot" if i % 10 else "rare") for i in range(4000)])
    first = language_id.sample(frame, per_lang=100)
    assert first == language_id.sample(frame.repartition(7), per_lang=100)
    counts = Counter(lang for lang, _ in first)
    assert 60 <= counts["hot"] <= 150 and 60 <= counts["rare"] <= 150
