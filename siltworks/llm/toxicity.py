"""A convolutional text classifier of toxic documents, trained in numpy.

Words are embedded through two hash functions, filters of width 1 to 3 slide over the whole text,
and the largest answer of each goes to a logistic layer. All labelled rows are learned from: they are
dealt to shards of bounded size, every shard goes on from the common parameters for one pass, and the
changes are averaged, for each word slot over the shards that changed it. Word counts and thresholds
are sums over all rows too. The driver holds one model. Scoring is a map over all documents.

The share of each language that should be rejected differs, so the threshold is calibrated for each
language on rows kept back from the fit, and the score is bent so that this threshold becomes
`cut`. The language is guessed from the words of the text alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import blocks, held_out, opened, stored, text_bytes, whole

_WORD = re.compile(r"\w+")
BUCKETS = 1 << 17
HALF = 8
WIDTHS = (1, 2, 3)
FILTERS = 12
LANGUAGE_BUCKETS = 4096
CHUNK = 4096
#: Scores are counted in this many cells to find thresholds.
CELLS = 1 << 16
#: The score from which a document is predicted toxic.
CUT = 0.3


def word_hashes(text: str | None) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in _WORD.findall((text or "").lower())), dtype=np.uint64)


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(BUCKETS - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(20)) & mask).astype(np.int64)


def _language_slots(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(44)) % np.uint64(LANGUAGE_BUCKETS)).astype(np.int64)


@dataclass
class Model:
    left: np.ndarray
    right: np.ndarray
    filters: list[np.ndarray]  # by width: (width, 2 * HALF, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    base: float
    languages: np.ndarray  # log share of each word slot, by language
    thresholds: np.ndarray = field(default_factory=lambda: np.array([CUT]))

    def pooled(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of every filter over the whole text, and where it began."""
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, dtype=np.float32)
        where = np.zeros(len(best), dtype=np.int64)
        a, b = _slots(hashes)
        for at in range(0, len(hashes), CHUNK):
            n = min(CHUNK, len(hashes) - at)
            x = np.zeros((n + WIDTHS[-1] - 1, 2 * HALF), dtype=np.float32)
            own = slice(at, at + len(x))
            x[: len(a[own]), :HALF] = self.left[a[own]]
            x[: len(a[own]), HALF:] = self.right[b[own]]
            for k, width in enumerate(WIDTHS):
                answers = sum(x[i : i + n] @ self.filters[k][i] for i in range(width))
                spots = answers.argmax(axis=0)
                peaks = answers[spots, np.arange(FILTERS)]
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                where[part] = np.where(peaks > best[part], spots + at, where[part])
                best[part] = np.maximum(peaks, best[part])
        if not len(hashes):
            best[:] = 0
        return best, where

    def raw(self, hashes: np.ndarray) -> float:
        peaks, _ = self.pooled(hashes)
        return _sigmoid(float(np.maximum(peaks + self.bias, 0) @ self.weights) + self.base)

    def language(self, hashes: np.ndarray) -> int:
        if not len(hashes) or self.languages.shape[1] < 2:
            return 0
        counts = np.bincount(_language_slots(hashes), minlength=LANGUAGE_BUCKETS)
        return int((counts @ self.languages).argmax())

    def score(self, text: str | None) -> float:
        hashes = word_hashes(text)
        raw, cut = self.raw(hashes), float(self.thresholds[self.language(hashes)])
        return CUT * raw / cut if raw < cut else CUT + (1 - CUT) * (raw - cut) / (1 - cut)


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -30.0), 30.0)))


def _log_odds(counts: np.ndarray, share: float) -> np.ndarray:
    """How much more often documents with a slot are toxic, drawn towards none for rare slots.

    `counts`: documents of label 0 and of label 1 that hold each slot; `share`: how many are toxic.
    """
    rows = 10.0
    odds = np.log((counts[1] + rows * share) / (counts[0] + rows * (1 - share))) - np.log(share / (1 - share))
    return np.clip(odds, -6, 6).astype(np.float32)


def _count_slots(counts: np.ndarray, hashes: np.ndarray, label: int) -> None:
    """Add a document to the counts, by table (left, right), label and slot."""
    for table, own in enumerate(_slots(hashes)):
        counts[table, label][np.unique(own)] += 1


def _started(counts: np.ndarray, share: float, rng: np.random.Generator) -> Model:
    size = len(WIDTHS) * FILTERS
    model = Model(
        left=rng.normal(0, 0.05, (BUCKETS, HALF)).astype(np.float32),
        right=rng.normal(0, 0.05, (BUCKETS, HALF)).astype(np.float32),
        filters=[rng.normal(0, 0.3, (w, 2 * HALF, FILTERS)).astype(np.float32) for w in WIDTHS],
        bias=np.full(size, -0.5, dtype=np.float32),
        weights=rng.normal(0, 0.2, size).astype(np.float32),
        base=float(np.log(share / (1 - share))),
        languages=np.zeros((LANGUAGE_BUCKETS, 1)),
    )
    # Start from what single words tell; training goes on from there.
    model.left[:, 0] = _log_odds(counts[0], share) / 2
    model.right[:, 0] = _log_odds(counts[1], share) / 2
    for weights in model.filters:
        weights[:, [0, HALF], :4] = 0.5
    model.weights[np.arange(size) % FILTERS < 4] = 0.3
    return model


def _start(hashes: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> Model:
    counts = np.zeros((2, 2, BUCKETS))
    for own, label in zip(hashes, labels, strict=True):
        _count_slots(counts, own, label)
    return _started(counts, labels.mean(), rng)


@dataclass
class _Seen:
    """Squared gradients so far, which shorten the steps (Adagrad)."""

    weights: np.ndarray
    bias: np.ndarray
    base: float
    filters: list[np.ndarray]

    @classmethod
    def of(cls, model: Model) -> _Seen:
        return cls(
            np.full_like(model.weights, 0.1), np.full_like(model.bias, 0.1), 0.1,
            [np.full_like(f, 0.1) for f in model.filters],
        )


def _weights_of_labels(share: float) -> tuple[float, float]:
    return 0.5 / max(1 - share, 1e-6), 0.5 / max(share, 1e-6)


def _learn(model: Model, seen: _Seen, hashes: np.ndarray, label: int, weight: float, rate: float) -> None:
    """One gradient step; a filter's gradient goes to where its peak began."""
    if not len(hashes):
        return
    peaks, where = model.pooled(hashes)
    active = np.maximum(peaks + model.bias, 0)
    slope = weight * (_sigmoid(float(active @ model.weights) + model.base) - label)
    if abs(slope) < 1e-3:
        return
    back = slope * model.weights * (active > 0)
    a, b = _slots(hashes)
    gradient = slope * active
    seen.weights += gradient**2
    model.weights -= rate * gradient / np.sqrt(seen.weights)
    seen.bias += back**2
    model.bias -= rate * back / np.sqrt(seen.bias)
    seen.base += slope**2
    model.base -= rate * slope / np.sqrt(seen.base)
    steps = [np.zeros_like(f) for f in model.filters]
    for j in np.flatnonzero(back).tolist():
        w, f = j // FILTERS, j % FILTERS
        for i in range(WIDTHS[w]):
            at = where[j] + i
            if at >= len(a):
                break
            x = np.concatenate([model.left[a[at]], model.right[b[at]]])
            steps[w][i, :, f] += back[j] * x
            step = rate * 0.3 * back[j] * model.filters[w][i, :, f]
            model.left[a[at]] -= step[:HALF]
            model.right[b[at]] -= step[HALF:]
    for own, step, past in zip(model.filters, steps, seen.filters, strict=True):
        past += step**2
        own -= rate * step / np.sqrt(past)


def _train(model: Model, hashes: list[np.ndarray], labels: np.ndarray, rng, epochs: int, rate: float) -> None:
    """Stochastic gradient steps over rows in memory."""
    seen, weight = _Seen.of(model), _weights_of_labels(labels.mean())
    for _ in range(epochs):
        for k in rng.permutation(len(hashes)):
            _learn(model, seen, hashes[k], labels[k], weight[labels[k]], rate)


def _best_gap(lowest: np.ndarray, highest: np.ndarray, rows: np.ndarray, hits: np.ndarray) -> float:
    """The middle of the gap with the best F1, between groups of scores in falling order.

    Of each group: its lowest and highest score, its rows, and those of them that are toxic.
    """
    right, taken = np.cumsum(hits), np.cumsum(rows)
    at = int((2 * right / (taken + max(right[-1], 1))).argmax())
    below = highest[at + 1] if at + 1 < len(highest) else 0.0
    return float(np.clip((lowest[at] + below) / 2, 0.02, 0.98))


def _best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    levels, of = np.unique(-scores, return_inverse=True)
    return _best_gap(-levels, -levels, np.bincount(of), np.bincount(of, weights=labels))


def fit(rows: list[tuple[str, int, str | None]], *, epochs: int = 4, rate: float = 0.05, seed: int = 7) -> Model | None:
    """A model of (text, label, language) rows in memory; None if not both labels are there."""
    rng = np.random.default_rng(seed)
    labels = np.array([int(label) for _, label, _ in rows], dtype=np.int64)
    if len(np.unique(labels)) < 2:
        return None
    hashes = [word_hashes(text) for text, _, _ in rows]
    back = rng.random(len(rows)) < 0.2 if len(rows) >= 200 else np.zeros(len(rows), dtype=bool)
    if len(np.unique(labels[~back])) < 2:
        back[:] = False
    fitted = np.flatnonzero(~back)
    model = _start([hashes[k] for k in fitted], labels[fitted], rng)
    _train(model, [hashes[k] for k in fitted], labels[fitted], rng, epochs, rate)

    names = sorted({lang for _, _, lang in rows if lang is not None}) or [""]
    counts = np.ones((LANGUAGE_BUCKETS, len(names)))
    for own, (_, _, lang) in zip(hashes, rows, strict=True):
        if lang in names:
            np.add.at(counts[:, names.index(lang)], _language_slots(own), 1)
    model.languages = np.log(counts / counts.sum(axis=0))

    tested = np.flatnonzero(back) if back.any() else np.arange(len(rows))
    raw = np.array([model.raw(hashes[k]) for k in tested])
    guessed = np.array([model.language(hashes[k]) for k in tested])
    common = _best_cut(raw, labels[tested])
    model.thresholds = np.full(len(names), common)
    for k in range(len(names)):
        own = guessed == k
        if labels[tested][own].sum() >= 5 and (1 - labels[tested][own]).sum() >= 5:
            model.thresholds[k] = _best_cut(raw[own], labels[tested][own])
    return model


# -- the same on tables: one pass of Spark over all labelled rows for each step ------------------


def _flat(model: Model, seen: _Seen) -> np.ndarray:
    """All parameters in rows of `HALF` numbers: the two tables of word slots, then the rest."""
    rest = [*model.filters, model.bias, model.weights, model.base, *seen.filters, seen.bias, seen.weights, seen.base]
    rest = np.concatenate([np.ravel(x).astype(np.float64) for x in rest])
    rest = np.pad(rest, (0, -len(rest) % HALF)).reshape(-1, HALF)
    return np.concatenate([model.left, model.right, rest]).astype(np.float32)


def _unflat(flat: np.ndarray) -> tuple[Model, _Seen]:
    """Parameters from such rows; languages are left out."""
    rest, at = flat[2 * BUCKETS :].ravel(), 0

    def take(shape: tuple[int, ...]) -> np.ndarray:
        nonlocal at
        at += (n := int(np.prod(shape)))
        return rest[at - n : at].reshape(shape).copy()

    def half() -> tuple:
        filters = [take((w, 2 * HALF, FILTERS)) for w in WIDTHS]
        size = (len(WIDTHS) * FILTERS,)
        return filters, take(size), take(size), float(take((1,))[0])

    (filters, bias, weights, base), past = half(), half()
    tables = [flat[k * BUCKETS : (k + 1) * BUCKETS].copy() for k in (0, 1)]
    found = Model(*tables, filters, bias, weights, base, np.zeros((LANGUAGE_BUCKETS, 1)))
    return found, _Seen(past[2], past[1], past[3], past[0])


# Changes are added up as whole numbers, so that the sum does not depend on their order.
_UNIT = 2.0**32
_CHANGES = ["slot", *(f"c{k}" for k in range(HALF))]


def _pass(sent, rate: float):
    """One pass over the shard of a task, on from the common parameters: what it has changed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, weight = sent.value
        model, seen = _unflat(flat)
        for batch in batches:
            for label, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                _learn(model, seen, _hashes_of(words), label, weight[label], rate)
        moved = np.rint((_flat(model, seen).astype(np.float64) - flat) * _UNIT).astype(np.int64)
        slots = np.flatnonzero(moved.any(axis=1))
        columns = [pa.array(slots), *(pa.array(moved[slots, k]) for k in range(HALF))]
        yield pa.RecordBatch.from_arrays(columns, _CHANGES)

    return run


def _hashes_of(words: pa.Scalar) -> np.ndarray:
    return np.frombuffer(words.as_buffer(), dtype=np.uint64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of rows (fitted, label, lang, hashes), as rows (lang, slot, n0, n1).

    Without `lang`: documents to be fitted that hold a slot of either table, by label. With it: words
    of all documents of the language.
    """
    slots = np.zeros((2, 2, BUCKETS), dtype=np.int64)
    words: dict = {}
    for batch in batches:
        rows = zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3), strict=True)
        for fitted, label, lang, data in rows:
            hashes = _hashes_of(data)
            if fitted:
                _count_slots(slots, hashes, label)
            if lang is not None:
                own = words.setdefault(lang, np.zeros(LANGUAGE_BUCKETS, dtype=np.int64))
                own += np.bincount(_language_slots(hashes), minlength=LANGUAGE_BUCKETS)
    for lang, (one, two) in {None: (slots[:, 0].ravel(), slots[:, 1].ravel()), **{k: (v, 0 * v) for k, v in words.items()}}.items():
        at = np.flatnonzero(one + two)
        columns = [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(one[at]), pa.array(two[at])]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "slot", "n0", "n1"])


def _raw_scores(sent):
    """(guessed language, raw score, label) of rows (label, hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value)
        for batch in batches:
            hashes = [_hashes_of(words) for words in batch.column(1)]
            raw = pa.array([model.raw(h) for h in hashes], pa.float64())
            guessed = pa.array([model.language(h) for h in hashes], pa.int64())
            yield pa.RecordBatch.from_arrays([guessed, raw, batch.column(0)], ["guessed", "raw", "label"])

    return run


def _numbers(df: DataFrame) -> list[np.ndarray]:
    """The columns of a frame of numbers, of bounded length."""
    return [c.to_numpy() for c in df.toArrow().columns]


def _thresholds(scored: DataFrame, languages: int) -> np.ndarray:
    """The best cut of each language that has rows enough, else that of all rows."""
    cell = F.floor(F.col("raw") * CELLS)
    counted = scored.groupBy("guessed", cell.alias("cell")).agg(
        F.min("raw"), F.max("raw"), F.count(F.lit(1)), F.sum("label")
    )
    guessed, cells, lowest, highest, rows, hits = _numbers(counted.orderBy(F.desc("cell"), "guessed"))
    _, first, of = np.unique(-cells, return_index=True, return_inverse=True)
    merged = (
        np.minimum.reduceat(lowest, first), np.maximum.reduceat(highest, first),
        np.bincount(of, weights=rows), np.bincount(of, weights=hits),
    )
    cuts = np.full(languages, _best_gap(*merged))
    for k in range(languages):
        own = guessed == k
        if hits[own].sum() >= 5 and (rows[own] - hits[own]).sum() >= 5:
            cuts[k] = _best_gap(lowest[own], highest[own], rows[own], hits[own])
    return cuts


def _labelled(
    docs: DataFrame, marks: DataFrame, id_col: str, text_col: str, lang_col: str, max_bytes: int
) -> tuple[DataFrame, int]:
    """(label, lang, place, hashes) of all rows to learn from, stored, and how many shards to make of them.

    Equal texts of a label come once. Rows of a partition are in the order of `place`, a hash of id
    and text, so neither rows nor their order depend on how `docs` is cut. Which rows are wanted is
    found on ids and hashes; text crosses the network once and is not stored.
    """
    there = docs.where(~held_out(F.col(id_col)) & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(text_col).alias("text_hash"),
    )
    slim = stored(
        there.select("id", "text_hash", F.octet_length("text").alias("bytes"))
        .join(marks, "id")
        .groupBy("label", "text_hash")
        .agg(F.min(F.struct(F.xxhash64("id", "text_hash").alias("place"), "id", "bytes")).alias("first"))
        .select("label", "text_hash", "first.*")
    )
    shards = blocks(slim.select(F.sum("bytes").alias("n")).first()["n"] or 0, max_bytes)
    parts = max(shards, blocks(text_bytes(there), 2 * max_bytes))
    wanted = slim.groupBy("id").agg(F.collect_list(F.struct("label", "text_hash", "place")).alias("wanted"))
    dealt = (
        there.repartition(parts, "id")
        .join(wanted.repartition(parts, "id").hint("merge"), "id")
        .select("lang", "text", F.col("text_hash").alias("own"), F.inline("wanted"))
        .where("own = text_hash")
        .select("place", "label", "text_hash", "lang", "text")
        .sortWithinPartitions("place", "label", F.col("lang").asc_nulls_last())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            kept, hashes = [], []
            for k, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                if key != last:  # a row may come twice
                    last = key
                    kept.append(k)
                    hashes.append(word_hashes(batch.column(4)[k].as_py()).tobytes())
            some = batch.take(pa.array(kept, pa.int64()))
            columns = [some.column(1), some.column(3), some.column(0), pa.array(hashes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "lang", "place", "hashes"])

    return stored(dealt.mapInArrow(run, "label int, lang string, place long, hashes binary")), shards


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "toxic",
    max_bytes: int = 24_000_000,
    epochs: int = 4,
    rate: float = 0.05,
    seed: int = 7,
) -> Model | None:
    """A model of all labelled rows; None if not both labels are there.

    Rows that are held out, or whose id, text or label is missing, are not learned from. An id that
    has both labels counts as toxic, and equal texts of a label count once. Rows are dealt to shards
    of `max_bytes` of text, which bounds what one task learns in a row; none are left out.
    """
    marks = (
        labels.where(F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    rows, shards = _labelled(docs, marks, id_col, text_col, lang_col, max_bytes)
    context = docs.sparkSession.sparkContext
    # One in five is kept back from the fit, for the thresholds.
    back = F.pmod(F.xxhash64("place", F.lit(seed)), F.lit(5)) == 0
    counts = dict.fromkeys(((0, False), (1, False), (0, True), (1, True)), 0)
    for row in rows.groupBy("label", back.alias("back")).agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["label"], row["back"]] = row["n"]
    if not (counts[0, False] + counts[0, True] and counts[1, False] + counts[1, True]):
        return None
    apart = sum(counts.values()) >= 200 and counts[0, False] and counts[1, False] and counts[0, True] + counts[1, True]
    if not apart:
        counts = {(label, False): counts[label, False] + counts[label, True] for label in (0, 1)}
    fitted, tested = (rows.where(~back), rows.where(back)) if apart else (rows, rows)
    share = counts[1, False] / (counts[0, False] + counts[1, False])

    fits = ~back if apart else F.lit(True)
    found = rows.select(fits.alias("fitted"), "label", "lang", "hashes").mapInArrow(
        _counted, "lang string, slot long, n0 long, n1 long"
    )
    found = found.groupBy("lang", "slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    langs = np.array(found["lang"].to_pylist(), dtype=object)
    slots, *numbers = (found[c].to_numpy() for c in ("slot", "n0", "n1"))
    of_words = np.array([lang is None for lang in langs], dtype=bool)
    by_label = np.zeros((2, 2 * BUCKETS))
    for own, n in zip(by_label, numbers, strict=True):
        own[slots[of_words]] = n[of_words]
    model = _started(by_label.reshape(2, 2, BUCKETS).swapaxes(0, 1), share, np.random.default_rng(seed))
    flat = _flat(model, _Seen.of(model))
    schema = ", ".join(f"{c} long" for c in _CHANGES)
    for _ in range(epochs):
        sent = context.broadcast((flat, _weights_of_labels(share)))
        moved = fitted.select("label", "hashes").coalesce(shards).mapInArrow(_pass(sent, rate), schema)
        moved = moved.groupBy("slot").agg(F.count(F.lit(1)), *(F.sum(c) for c in _CHANGES[1:]))
        at, changed, *sums = _numbers(moved)
        flat[at] += np.stack(sums, axis=1) / _UNIT / changed[:, None]
        sent.destroy()
    model, _ = _unflat(flat)

    names = sorted(set(langs[~of_words])) or [""]
    place = {name: k for k, name in enumerate(names)}
    words = np.ones((LANGUAGE_BUCKETS, len(names)))
    words[slots[~of_words], [place[lang] for lang in langs[~of_words]]] += numbers[0][~of_words]
    model.languages = np.log(words / words.sum(axis=0))

    sent = context.broadcast(vars(model))
    scored = tested.select("label", "hashes").mapInArrow(_raw_scores(sent), "guessed long, raw double, label int")
    model.thresholds = _thresholds(scored, len(names))
    sent.destroy()
    return model


def scorer(docs: DataFrame, model: Model | None) -> Column:
    """A function of a text column: its score, 0 to 1. Without a model every score is 0."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(**sent.value) if sent.value else None
        for texts in batches:
            yield pa.array([own.score(t) if own else 0.0 for t in texts.to_pylist()], pa.float64())

    return F.arrow_udf(run, "double")


def score(docs: DataFrame, model: Model | None, *, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """All rows and columns of `docs` and the score `out`; empty and null texts have one too."""
    scored = whole(docs).withColumn("score", scorer(docs, model)(F.col("row")[text_col]))
    return opened(scored, docs.columns, **{out: F.col("score")})


def keep_clean(docs: DataFrame, model: Model | None, *, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows whose score is below `cut`, with all columns."""
    scored = whole(docs).where(scorer(docs, model)(F.col("row")[text_col]) < cut)
    return opened(scored, docs.columns)
