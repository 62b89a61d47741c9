from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.compute as pc
import pytest
from awkward_texts import awkward_texts
from siltworks.llm import perplexity


class Plain:
    """Interpolated modified Kneser-Ney, by the book."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = {order: Counter()}
        for t in texts:
            data = bytes(order - 1) + t.encode()
            for i in range(order - 1, len(data)):
                self.counts[order][data[i - order + 1 : i + 1]] += 1
        for size in range(order - 1, 0, -1):
            self.counts[size] = Counter(g[1:] for g in self.counts[size + 1])
        self.cut, self.total, self.weight = {}, {}, {}
        for size, counts in self.counts.items():
            n = [sum(c == k for c in counts.values()) for k in range(5)]
            y = n[1] / max(n[1] + 2 * n[2], 1)
            self.cut[size] = [min(max(k - (k + 1) * y * n[k + 1] / max(n[k], 1), 0.05), k - 0.05) for k in (1, 2, 3)]
            total, taken = defaultdict(int), defaultdict(float)
            for g, c in counts.items():
                total[g[:-1]] += c
                taken[g[:-1]] += self.cut[size][min(c, 3) - 1]
            self.total[size], self.weight[size] = total, {h: taken[h] / total[h] for h in total}

    def p(self, gram):
        if not gram:
            return 1 / 256
        size, below = len(gram), self.p(gram[1:])
        if gram[:-1] not in self.total[size]:
            return below
        c = self.counts[size].get(gram, 0)
        direct = max(c - self.cut[size][min(c, 3) - 1], 0) / self.total[size][gram[:-1]] if c else 0
        return direct + self.weight[size][gram[:-1]] * below

    def logs(self, text):
        data = bytes(self.order - 1) + text.encode()
        return sum(np.log(self.p(data[i - self.order + 1 : i + 1])) for i in range(self.order - 1, len(data)))


@pytest.mark.parametrize("shard_rows", [2_000_000, 60])
def test_equals_plain_model(spark, shard_rows):
    train = {"en": ["the cat sat on the mat", "the dog ate the cat food", "", "that hat"], "de": ["die Katze saß auf der Matte"]}
    frame = spark.createDataFrame([(lang, t) for lang, ts in train.items() for t in ts], "lang string, text string")
    model = perplexity.tables(perplexity.counted(frame))
    asked = [("en", "the hat sat"), ("en", "é😀"), ("de", "die Matte"), ("en", ""), ("xx", "the"), (None, "the"), ("en", None)]
    docs = spark.createDataFrame(asked, "lang string, text string")
    rows = perplexity.log_likelihoods(docs, model, shard_rows=shard_rows).collect()
    plain = {lang: Plain(ts, perplexity.ORDER) for lang, ts in train.items()}
    for r in rows:
        if r.row.lang in plain:
            assert r.logs == pytest.approx(plain[r.row.lang].logs(r.row.text or ""), abs=1e-9)
        else:
            assert r.logs is None


def test_other_languages_take_the_pooled_model(spark):
    train = ["the cat sat on the mat", "die Katze sitzt"]
    rows = [("en", train[0]), (perplexity.POOLED, train[0]), (perplexity.POOLED, train[1])]
    frame = spark.createDataFrame(rows, "lang string, text string")
    docs = spark.createDataFrame([("xx", "the Katze"), (None, "the Katze"), ("en", "the Katze")], "lang string, text string")
    model = perplexity.tables(perplexity.counted(frame))
    pooled, english = Plain(train, perplexity.ORDER), Plain(train[:1], perplexity.ORDER)
    for shard_rows in (2_000_000, 60):
        for r in perplexity.log_likelihoods(docs, model, shard_rows=shard_rows).collect():
            plain = english if r.row.lang == "en" else pooled
            assert r.logs == pytest.approx(plain.logs(r.row.text), abs=1e-9)


def joined(spark, docs, model, **how):
    return {r.row.k: (r.row, r.logs) for r in perplexity.log_likelihoods(docs, model, **how).collect()}


def test_many_shards_equal_one(spark):
    """A frequent pair of bytes, blocks of a few rows, several copies of each shard."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdé "), size=rng.integers(1, 9))) for _ in range(120)]
    texts = [" ".join(rng.choice(words, size=rng.integers(0, 60))) for _ in range(160)]
    train = [("en" if k % 3 else "de", t) for k, t in enumerate(texts[:60])]
    train += [(perplexity.POOLED, t) for _, t in train]
    model = perplexity.tables(perplexity.counted(spark.createDataFrame(train, "lang string, text string"))).cache()
    rows = [(k, ("en", "de", None, "xx")[k % 4], None if k % 31 == 0 else t, str(k)) for k, t in enumerate(texts)]
    rows += [(900, "en", "x" * 5000, "long"), (901, "en", "", "none"), (902, "de", "\0\0a", "zero")]
    docs = spark.createDataFrame(rows, "k int, lang string, text string, shard string").repartition(3)
    one = joined(spark, docs, model)
    cells, entries = perplexity.sharded(model, 300)
    assert cells.count >= 8 and cells.parts.max() > 1
    assert entries.groupBy("shard").count().agg({"count": "max"}).first()[0] < model.count() / 2
    many = joined(spark, docs, model, shard_rows=300, block_bytes=2_000, asked_grams=400)
    assert many.keys() == one.keys() and len(one) == len(rows)
    for k, (row, logs) in one.items():
        assert many[k][0] == row and many[k][1] == pytest.approx(logs, abs=1e-9)


def test_shards_hold_what_their_grams_need(spark):
    """Each n-gram's probability from its shard alone is that from the whole model."""
    texts = ["the cat sat on the mat", "that hat, the other hat", "a theatre at the other end"] * 2
    model = perplexity.tables(perplexity.counted(spark.createDataFrame([("a", t) for t in texts], "lang string, text string"))).cache()
    cells, entries = perplexity.sharded(model, 25)
    rows = entries.toArrow()
    everything = perplexity.Shard(perplexity._held(model.toArrow()), perplexity.ORDER)
    data = np.frombuffer(b"\0\0\0\0the hat of that other cat zz" + bytes(range(256)), np.uint8)
    grams = np.unique(perplexity._grams(data, 5)[4:])
    shards = cells.shards("a", grams)
    assert len(set(shards.tolist())) >= 4 and cells.parts.max() > 1
    for shard in set(shards.tolist()):
        own = perplexity.Shard(perplexity._held(rows.filter(pc.equal(rows["shard"], shard))), perplexity.ORDER)
        asked = grams[shards == shard]
        assert own.logs("a", asked) == pytest.approx(everything.logs("a", asked), abs=1e-12)


def test_larger_models_do_not_come_to_the_driver(spark, monkeypatch):
    model = perplexity.tables(perplexity.counted(spark.createDataFrame([("a", "some text " * 9)], "lang string, text string")))
    docs = spark.createDataFrame([(1, "a", "text")], "k int, lang string, text string")
    monkeypatch.setattr(type(docs), "toArrow", lambda *_: pytest.fail("the model is gathered"))
    assert joined(spark, docs, model, shard_rows=5)[1][1] < 0


def plain_quantile(values, share):
    """As the approximate one of few values: the smallest with that share at or below it."""
    values = sorted(values)
    return values[max(0, int(np.ceil(share * len(values))) - 1)]


@pytest.mark.parametrize("shard_rows", [2_000_000, 20_000])
def test_limits_and_keep_equal_plain(spark, shard_rows, monkeypatch):
    """Perplexities by the textbook model, limits of each language, and what lies between them."""
    rng = np.random.default_rng(11)
    words = {"en": ["the", "cat", "sat", "on", "mat", "dog"], "de": ["die", "Katze", "saß", "auf", "der", "Matte"]}
    rows = [(k, lang := ("en", "de")[k % 2], " ".join(rng.choice(words[lang], size=rng.integers(3, 12)))) for k in range(400)]
    rows += [(1000 + k, "en", "".join(rng.choice(list("qxzjk"), size=30))) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(300)], "doc_id long, quality int")
    score = perplexity.log_likelihoods
    monkeypatch.setattr(perplexity, "log_likelihoods", lambda *a, **how: score(*a, **how, shard_rows=shard_rows))
    found = {r.doc_id: r.quality for r in perplexity.judge(docs, labels, low=0.05, high=0.9).collect()}

    unseen = {k for k in range(300) if zlib.crc32(str(k).encode()) % 4 == 2}
    plain = {lang: Plain([t for k, o, t in rows if o == lang and k < 300 and k not in unseen], perplexity.ORDER) for lang in words}
    wanted = {k: np.exp(-plain[lang].logs(t) / len(t.encode())) for k, lang, t in rows}
    for lang in words:
        own = [wanted[k] for k, o, _ in rows if o == lang and k in unseen]
        assert len(own) >= 20
        ends = [plain_quantile(own, share) for share in (0.05, 0.9)]
        for k in (k for k, o, _ in rows if o == lang):
            q = found[k]
            assert q.perplexity == pytest.approx(wanted[k], rel=1e-9)
            assert [q.low, q.high] == pytest.approx(ends, rel=1e-9)
            assert q.keep == (ends[0] * (1 - 1e-12) <= wanted[k] <= ends[1] * (1 + 1e-12)) or min(abs(wanted[k] - e) for e in ends) < 1e-9


def test_probabilities_sum_to_one(spark):
    frame = spark.createDataFrame([("a", "abracadabra abba"), ("a", "cab")], "lang string, text string")
    held = perplexity._held(perplexity.tables(perplexity.counted(frame)).toArrow())
    shard = perplexity.Shard(held, perplexity.ORDER)
    for context in (b"abra", b"\0\0\0\0", b"zzzz", b"zzza"):
        grams = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)])
        assert np.exp(shard.logs("a", grams)).sum() == pytest.approx(1, abs=1e-9)


def test_long_texts_come_in_parts(monkeypatch):
    monkeypatch.setattr(perplexity, "CHUNK", 10)
    texts = ["abcdefghijklmnopqrstuvwxyz", "short", None, "", "exactly10!", "another rather long one"]
    got = defaultdict(list)
    for first, end, lengths, grams in perplexity._texts(texts, 3):
        ends = np.cumsum(lengths)
        for k, (a, b) in enumerate(zip(ends - lengths, ends, strict=True)):
            got[first + k] += grams[a:b].tolist()
    for k, t in enumerate(texts):
        data = b"\0\0" + (t or "").encode()
        assert got[k] == [int.from_bytes(data[i : i + 3], "big") for i in range(len(data) - 2)]


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(k, 1) for k in range(100, 130)] + [(1, 0), (None, 1), (7, None), (100, 1)], "doc_id long, quality int")
    judged = perplexity.judge(awkward, labels, least=2)
    rows = judged.collect()
    assert set(judged.columns) == {*awkward.columns, "quality"}
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(awkward_texts())
    for r in rows:
        assert r.quality.keep is not None
        assert (r.quality.perplexity is None) or r.text
        if r.text and r.quality.perplexity is None:
            assert r.quality.keep
        if not r.text:
            assert not r.quality.keep
    assert perplexity.judge(nothing, labels).collect() == []
    assert all(r.quality.keep == bool(r.text) for r in perplexity.judge(awkward, labels.where("false")).collect())


def some_documents(spark, where):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(where)
    return docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def kept_shares(docs, labels, told):
    """Of the rows of each quality in `told`, how many are kept."""
    judged = perplexity.judge(docs, labels, carried=["doc_id", "lang"])
    rows = judged.join(told.withColumnRenamed("quality", "good"), "doc_id").collect()
    assert rows and all(r.quality.low < r.quality.perplexity < r.quality.high for r in rows if r.quality.keep)
    assert all(r.quality.low is not None and r.quality.high is not None for r in rows)
    return [np.mean([r.quality.keep for r in rows if r.good == g]) for g in (1, 0)]


def test_languages_with_few_trusted_documents_are_judged(spark):
    docs, labels = some_documents(spark, "true")
    few = labels.join(docs.where("lang <> 'en'").select("doc_id"), "doc_id")
    good, bad = kept_shares(docs, labels, few)
    assert good > 0.9 and bad < 0.3


def test_language_without_trusted_documents_is_judged(spark):
    docs, labels = some_documents(spark, "true")
    french = docs.where("lang = 'fr'").select("doc_id")
    good, bad = kept_shares(docs, labels.join(french, "doc_id", "left_anti"), labels.join(french, "doc_id"))
    assert good > 0.8 and bad < 0.5


def test_small_table_is_judged(spark):
    docs, labels = some_documents(spark, "doc_id % 12 = 0")
    good, bad = kept_shares(docs, labels, labels.join(docs.select("doc_id"), "doc_id"))
    assert good > 0.8 and bad < 0.5


def test_without_unseen_documents_all_are_judged(spark):
    docs, labels = some_documents(spark, "true")
    seen = perplexity.trusted(labels).where("not unseen").selectExpr("trusted doc_id", "1 quality")
    good, bad = kept_shares(docs, seen, labels)
    assert good > 0.8 and bad < 0.5


def test_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = perplexity.judge(docs, labels, carried=["doc_id"]).join(labels.withColumnRenamed("quality", "good"), "doc_id").collect()
    good, bad = ([r.quality.keep for r in judged if r.good == g] for g in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2
