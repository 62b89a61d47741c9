from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
from awkward_texts import awkward_texts
from siltworks.llm import language


def plain_kernel(a, b):
    def grams(text):
        text = f" {' '.join(text.lower().split())} "
        return {text[i : i + n] for n in language.LENGTHS for i in range(len(text) - n + 1)}

    return len(grams(a) & grams(b))


def test_shared_grams_are_counted():
    texts = ["the cat sat", "die Katze saß", "le chat 日本 😀", "a"]
    grams = language.Grams.of(texts)
    found = np.array([grams.present(t) for t in texts]).astype(int)
    assert (found @ found.T == [[plain_kernel(a, b) for b in texts] for a in texts]).all()
    # Unknown characters are in no known n-gram.
    new = grams.present("zebra cat Ω")
    assert (found @ new == [plain_kernel(t, "zebra cat Ω") for t in texts]).all()


def test_direct_and_searched_tables_agree():
    texts = [chr(c) * 3 + chr(c + 1) for c in range(0x4E00, 0x4F00)] + ["abc"]
    grams = language.Grams.of(texts)
    assert grams.tables[0] is not None and grams.tables[2] is None
    assert grams.present("abc").sum() == len({"a", "b", "c", " ", " a", "ab", "bc", "c ", " ab", "abc", "bc "})


def test_awkward_rows(spark, awkward, nothing):
    model = language.train(awkward)
    out = language.identify(awkward, model)
    rows = out.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(awkward_texts())
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.language.lang in ("en", "de")) == letters and 0 <= r.language.score <= 1
        assert letters or r.language.lang == language.UNKNOWN
    assert language.identify(nothing, model).collect() == []
    assert language.train(nothing) is None
    assert {r.language.lang for r in language.identify(awkward, None).collect()} == {"und"}


def test_held_out_rows_teach_nothing(spark):
    rows = [(k, f"word{k} text", "xx") for k in range(40) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert rows and language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string")) is None


def test_long_text_does_not_end_the_sample(spark):
    rows = [(k, f"the cat sat on the mat {k}", "en") for k in range(40)] + [(50 + k, f"die Katze saß da {k}", "de") for k in range(40)]
    long = [(200 + k, f"long {k} " + "word " * 4_000, "en") for k in range(8)]
    docs = spark.createDataFrame(rows + long, "doc_id long, text string, lang string")
    model = language.train(docs, max_bytes=16_000)
    assert model["names"] == ["de", "en"] and len(model["basis"]) == sum(not held_out(k) for k, _, _ in rows)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = language.identify(docs, language.train(docs)).collect()
    test = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([r.language.lang == r.lang for r in test]) > 0.97


def made_up(languages, rows, words):
    """(text, language): each language has letters and words of its own."""
    rng = random.Random(6)
    out = []
    for n in range(languages):
        letters = [chr(0x61 + (n * 3 + k) % 26) for k in range(9)] + [chr(0x100 + 40 * n + k) for k in range(6)]
        known = ["".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(300)]
        out += [(" ".join(rng.choices(known, k=words)), f"l{n:03}") for _ in range(rows)]
    return out


def plain_fit(rows, marks, ridge):
    """Kernel ridge regression on Nystroem features, by sets and the textbook."""

    def grams(text):
        text = f" {' '.join(text.lower().split())} "
        return {text[i : i + n] for n in language.LENGTHS for i in range(len(text) - n + 1)}

    known = set().union(*(grams(t) for t in marks))

    def kernel(a, b):
        a, b = grams(a) & known, grams(b)
        return len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))

    names = sorted({lang for _, lang in rows})
    inner = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(inner)
    to = vectors[:, values > 1e-8 * values.max()] / np.sqrt(values[values > 1e-8 * values.max()])

    def features(text):
        return np.append(np.array([kernel(text, m) for m in marks]) @ to, 1)

    x = np.array([features(t) for t, _ in rows])
    y = np.array([[1.0 if lang == n else -1.0 for n in names] for _, lang in rows])
    w = np.array([len(rows) / len(names) / sum(o == lang for _, o in rows) for _, lang in rows])
    solved = np.linalg.solve((x.T * w) @ x + ridge * np.eye(x.shape[1]), (x.T * w) @ y)

    def predict(text):
        answers = features(text) @ solved
        odds = np.exp(4 * (answers - answers.max()))
        return names[int(answers.argmax())], odds.max() / odds.sum()

    return predict


def test_prediction_equals_plain_kernel_ridge_regression(monkeypatch):
    """Also when n-grams come in many blocks and landmarks are unpacked each time."""
    rows = made_up(3, 14, 12) + made_up(2, 5, 3)
    seen = []
    of = language.Grams.of.__func__
    monkeypatch.setattr(language.Grams, "of", classmethod(lambda cls, texts: seen.append(texts) or of(cls, texts)))
    for columns, kept in ((1 << 14, 64 << 20), (64, 0)):
        monkeypatch.setattr(language, "COLUMNS", columns)
        monkeypatch.setattr(language, "KEPT_BYTES", kept)
        model = language.fit(rows, landmarks=15, ridge=0.1)
        plain = plain_fit(rows, seen[-1], 0.1)
        asked = [t for t, _ in rows] + ["abc", "x", "zebra Ω", made_up(5, 1, 4)[3][0]]
        for text, (name, score) in zip(asked, language.Predictor(model).predict(asked), strict=True):
            wanted, sure = plain(text)
            assert name == wanted and abs(score - sure) < 1e-4


def test_many_languages_in_bounded_memory():
    rows = made_up(40, 100, 120)
    tracemalloc.start()
    model = language.fit(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20 and len(model["basis"]) == 160
    fresh = [rows[k * 100 + 7] for k in range(40)]
    found = language.Predictor(model).predict([t[: len(t) // 2] for t, _ in fresh])
    assert np.mean([name == lang for (name, _), (_, lang) in zip(found, fresh, strict=True)]) > 0.9


def test_every_language_has_landmarks_and_rows(spark):
    rows = made_up(60, 5, 10)
    docs = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.train(docs, max_rows=100, landmarks=30)
    learned = {lang for k, (_, lang) in enumerate(rows) if not held_out(k)}
    assert model["names"] == sorted(learned) and len(learned) <= len(model["basis"]) <= 4 * len(learned)
