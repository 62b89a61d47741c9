"""A quality classifier: perplexity under an n-gram model of trusted text.

The model is interpolated modified Kneser-Ney over UTF-8 bytes, one for each language. Tasks count
the n-grams of all trusted text, and Spark adds the counts up. Lower orders, totals of contexts,
discounts and probabilities come from grouped counts and joins by n-gram, sharded by key.

For scoring, n-grams of documents are joined with the tables. While the tables are small, measured by
their rows, they are sent to all tasks. Beyond that both sides are sharded: documents are put into
blocks, each of which asks for its different n-grams, and tables go to shards by the two bytes before
the one that is predicted, and by a third where these two are frequent. Every shard then holds all
that its n-grams need, and no more than a bounded number of rows. Answers go back to the blocks, where
they are added up by document. Nothing of the tables passes through the driver there but counts by
pairs of bytes, and documents are read once, however large the tables are.

A document is kept if its perplexity lies between two quantiles, taken for each language over
trusted documents that the model has not seen. Languages with few of those take limits from all
languages, relative to what is usual in each.
"""

from __future__ import annotations

from collections.abc import Iterator

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.common import blocks, held_out, small, stored, whole

ORDER = 5
CHUNK = 2_000_000
SPREAD = 1 << 20
NO_LANGUAGE = ""
#: Names the model of all trusted text together.
POOLED = "\0all"


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte, it and the `order` - 1 bytes before it, as one number."""
    out = data.astype(np.int64)
    for back in range(1, order):
        out[back:] |= data[:-back].astype(np.int64) << (8 * back)
    return out


def _texts(values: list[str | None], order: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks of whole texts: (first row, end row, bytes each, n-grams that end at each byte).

    Before a text stand zero bytes. A text longer than a chunk comes in parts, with the bytes before.
    """
    some: list[bytes] = []
    first = size = 0

    def told(first, parts):
        lengths = np.array([len(p) for p in parts])
        pad = bytes(order - 1)
        data = np.frombuffer(b"".join(pad + p for p in parts), dtype=np.uint8)
        inside = np.ones(len(data), dtype=bool)
        starts = np.cumsum(lengths + order - 1) - lengths - (order - 1)
        for k in range(order - 1):
            inside[starts + k] = False
        return first, first + len(parts), lengths, _grams(data, order)[inside]

    for k, value in enumerate(values):
        data = (value or "").encode("utf-8", "surrogatepass")
        if len(data) > CHUNK:
            if some:
                yield told(first, some)
            for at in range(0, len(data), CHUNK):
                back = data[max(0, at - order + 1) : at]
                part = np.frombuffer(back.rjust(order - 1, b"\0") + data[at : at + CHUNK], dtype=np.uint8)
                grams = _grams(part, order)[order - 1 :]
                yield k, k + 1, np.array([len(grams)]), grams
            some, first, size = [], k + 1, 0
            continue
        some.append(data)
        size += len(data)
        if size >= CHUNK:
            yield told(first, some)
            some, first, size = [], k + 1, 0
    if some:
        yield told(first, some)


def _count(order: int):
    def merged(parts):
        keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)
        return [(keys, counts)]

    def told(lang, parts):
        for keys, counts in parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], ["lang", "gram", "n"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            langs = batch.column(0)
            for lang in langs.unique().to_pylist():
                own = batch.filter(pc.equal(langs, lang)).column(1).to_pylist()
                for _, _, _, grams in _texts(own, order):
                    keys, counts = np.unique(grams, return_counts=True)
                    parts = held.setdefault(lang, [])
                    parts.append((keys, counts))
                    if sum(len(p[0]) for p in parts) > SPREAD:
                        held[lang] = merged(parts)
                        if len(held[lang][0][0]) > SPREAD // 2:
                            yield from told(lang, held.pop(lang))
        for lang, parts in held.items():
            yield from told(lang, merged(parts))

    return run


def counted(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) of rows (lang, text): how often each n-gram of bytes comes in a language."""
    found = texts.select("lang", "text").mapInArrow(_count(order), "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): what is taken from counts of one, two, and more, by counts of counts."""
    n = [F.sum(F.when(F.col("n") == k, 1.0).otherwise(0.0)).alias(f"n{k}") for k in (1, 2, 3, 4)]
    seen = counts.groupBy("lang").agg(*n).withColumn("y", F.expr("n1 / greatest(n1 + 2 * n2, 1)"))

    def d(k: int):
        value = k - (k + 1) * F.col("y") * F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1))
        return F.least(F.greatest(value, F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}")

    return seen.select("lang", *(d(k) for k in (1, 2, 3)))


def tables(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, size, gram, seen, back): the model, of counts of the highest order.

    `seen` is the log probability of the last byte of a gram after the others; `back` the log weight
    that the shorter context gets after the bytes of a gram. Either may be missing.
    """
    levels = {order: stored(counts)}
    for size in range(order - 1, 0, -1):
        # How many different bytes come before each shorter gram.
        levels[size] = stored(
            levels[size + 1]
            .groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1)).alias("gram"))
            .agg(F.count("*").alias("n"))
        )
    lower, out = None, []
    for size in range(1, order + 1):
        own = levels[size].withColumn("context", F.shiftright("gram", 8)).join(small(stored(discounts(levels[size]))), "lang")
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        contexts = own.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), (F.sum(cut) / F.sum("n")).alias("weight")
        )
        joined = own.join(contexts, ["lang", "context"])
        direct = F.greatest(F.col("n") - cut, F.lit(0.0)) / F.col("total")
        if lower is None:
            joined = joined.withColumn("below", F.lit(1 / 256))
        else:
            joined = joined.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 8 * (size - 1)) - 1))).join(
                lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"]
            )
        lower = stored(joined.select("lang", "gram", (direct + F.col("weight") * F.col("below")).alias("p")))
        out.append(lower.select("lang", F.lit(size).alias("size"), "gram", F.log("p").alias("seen"), F.lit(None).cast("double").alias("back")))
        out.append(
            contexts.select("lang", F.lit(size - 1).alias("size"), F.col("context").alias("gram"), F.lit(None).cast("double").alias("seen"), F.log("weight").alias("back"))
        )
    both = out[0]
    for part in out[1:]:
        both = both.unionAll(part)
    return both.groupBy("lang", "size", "gram").agg(F.max("seen").alias("seen"), F.max("back").alias("back"))


class Shard:
    """Tables of one shard, by language and size, sorted by gram."""

    def __init__(self, held: dict, order: int):
        self.held, self.order = held, order

    def _find(self, lang: str, size: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, seen, back = self.held.get((lang, size), (np.empty(0, np.int64), np.empty(0), np.empty(0)))
        if not len(keys):
            return np.full(len(grams), np.nan), np.full(len(grams), np.nan)
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        hit = keys[at] == grams
        return np.where(hit, seen[at], np.nan), np.where(hit, back[at], np.nan)

    def logs(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last byte of each gram of the highest order."""
        # Of a byte that no trusted text has, only the even share is left.
        total = np.full(len(grams), np.log(1 / 256)) + np.nan_to_num(self._find(lang, 0, grams * 0)[1])
        for size in range(1, self.order + 1):
            mask = np.int64((1 << 8 * size) - 1)
            seen, _ = self._find(lang, size, grams & mask)
            if size > 1:
                total += np.nan_to_num(self._find(lang, size - 1, (grams & mask) >> 8)[1])
            total = np.where(np.isnan(seen), total, seen)
        return total


def _names(langs: list[str | None], known: set[str]) -> np.ndarray:
    """The model each row is scored by; others than those in `known` have none."""
    names = np.array([NO_LANGUAGE if x is None else x for x in langs], dtype=object)
    if POOLED in known:
        names[[x not in known for x in names]] = POOLED
    return names


def _sums(names: np.ndarray, texts: list[str | None], known: set[str], logs_of, order: int) -> np.ndarray:
    """Sums over each text of what `logs_of(language, different grams)` gives; NaN without a model."""
    sums = np.full(len(texts), np.nan)
    values = np.array([*texts, None], dtype=object)[:-1]
    for lang in known:
        rows = np.flatnonzero(names == lang)
        sums[rows] = 0.0
        for first, end, lengths, grams in _texts(list(values[rows]), order):
            keys, where = np.unique(grams, return_inverse=True)
            ends = np.cumsum(lengths)
            running = np.concatenate([[0.0], np.cumsum(logs_of(lang, keys)[where])])
            sums[rows[first:end]] += running[ends] - running[ends - lengths]
    return sums


def _sum(sent, order: int):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        shard = Shard(sent.value, order)
        known = {lang for lang, _ in shard.held}
        for langs, texts in batches:
            names = _names(langs.to_pylist(), known)
            yield pa.array(_sums(names, texts.to_pylist(), known, shard.logs, order), pa.float64(), from_pandas=True)

    run.__annotations__ = _iterator_types()
    return F.arrow_udf(run, T.DoubleType())


def _iterator_types() -> dict:
    return {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def _held(rows: pa.Table) -> dict:
    rows = rows.sort_by([("lang", "ascending"), ("size", "ascending"), ("gram", "ascending")])
    langs, sizes = rows["lang"].to_pylist(), rows["size"].to_numpy()
    columns = [rows["gram"].to_numpy(), *(rows[c].cast(pa.float64()).to_numpy() for c in ("seen", "back"))]
    out, start = {}, 0
    for k in range(1, len(langs) + 1):
        if k == len(langs) or (langs[k], sizes[k]) != (langs[start], sizes[start]):
            # A gram and a context may come as two rows.
            grams, seen, back = (c[start:k] for c in columns)
            new = np.flatnonzero(np.append(True, np.diff(grams) != 0))
            out[langs[start], int(sizes[start])] = grams[new], np.fmax.reduceat(seen, new), np.fmax.reduceat(back, new)
            start = k
    return out


class Cells:
    """Which shard n-grams belong to, by the two bytes before the last and, of frequent pairs of bytes,
    by the byte before these and the language."""

    def __init__(self, counts: dict[int, int], shard_rows: int):
        self.first, self.parts = np.zeros(1 << 16, dtype=np.int64), np.ones(1 << 16, dtype=np.int64)
        shard = held = 0
        for pair, n in sorted(counts.items()):
            if held and held + n > shard_rows:
                shard, held = shard + 1, 0
            self.first[pair], self.parts[pair] = shard, blocks(n, shard_rows)
            shard, held = shard + int(self.parts[pair]) - 1, held + n
        self.count = shard + 1
        others = np.setdiff1d(np.arange(1 << 16), list(counts))
        self.first[others] = others % self.count

    def shards(self, lang: str, grams: np.ndarray) -> np.ndarray:
        pair = grams >> 8 & 0xFFFF
        return self.first[pair] + ((grams >> 24 & 0xFF) * 31 + zlib.crc32(lang.encode())) % self.parts[pair]

    def table(self) -> list[tuple[int, int, int]]:
        return list(zip(range(1 << 16), self.first.tolist(), self.parts.tolist(), strict=True))


def _pair(seen: bool) -> Column:
    """The two bytes before a predicted one, of grams and of contexts; null where one is not there."""
    if seen:
        return F.when(F.col("size") >= 3, F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF)))
    return F.when(F.col("size") >= 2, F.col("gram").bitwiseAND(F.lit(0xFFFF)))


def sharded(model: DataFrame, shard_rows: int) -> tuple[Cells, DataFrame]:
    """Which shard n-grams belong to, and the tables with their shard.

    An entry goes to every shard where n-grams need it: one without two bytes before the predicted
    one to all, one with no third byte to all of its pair. Of the former there are at most 65,793 for
    a language, of the latter 256 for a language and a pair. Of n-grams and contexts of three bytes
    before the predicted one, a shard has about `shard_rows`, or those with the same three if that is
    more: at most 65,536 n-grams of five bytes for a language.
    """
    entries = [
        model.where(F.col(value).isNotNull()).select(
            "lang",
            "size",
            "gram",
            *(F.col(c) if c == value else F.lit(None).cast("double").alias(c) for c in ("seen", "back")),
            _pair(value == "seen").cast("int").alias("pair"),
            F.when(
                F.col("size") >= (4 if value == "seen" else 3),
                F.shiftright("gram", 24 if value == "seen" else 16).bitwiseAND(F.lit(0xFF)),
            ).alias("third"),
        )
        for value in ("seen", "back")
    ]
    both = entries[0].unionAll(entries[1])
    counts = both.where("pair is not null").groupBy("pair").count().collect()  # at most 65,536
    cells = Cells({r["pair"]: r["count"] for r in counts}, shard_rows)
    places = model.sparkSession.createDataFrame(cells.table(), "at int, first long, parts long")
    own = F.col("first") + (F.col("third") * 31 + F.crc32(F.encode("lang", "utf-8"))) % F.col("parts")
    shards = (
        F.when(F.col("pair").isNull(), F.sequence(F.lit(0).cast("long"), F.lit(cells.count - 1).cast("long")))
        .when(F.col("third").isNull(), F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1))
        .otherwise(F.array(own))
    )
    placed = both.join(F.broadcast(places), F.col("pair") == F.col("at"), "left")
    return cells, placed.select(F.explode(shards).alias("shard"), "lang", "size", "gram", "seen", "back")


def _zip(data: bytes) -> bytes:
    import zstandard

    return zstandard.compress(data, 3)


def _unzip(data: bytes) -> bytes:
    import zstandard

    return zstandard.decompress(data)


def _told(grams: np.ndarray) -> bytes:
    """Sorted grams as their differences, which compress well."""
    return _zip(np.diff(grams, prepend=0).tobytes())


def _heard(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(_unzip(data), np.int64))


ASKED = "block long, blob binary, shard long, lang string, grams binary, n long"


def _ask(sent, order: int, block_bytes: int):
    """For each block of rows (row, lang, text) one row with the packed rows, and one for each shard and
    language with the different n-grams that it holds."""
    schema = pa.schema(
        [("block", pa.int64()), ("blob", pa.binary()), ("shard", pa.int64()), ("lang", pa.string()), ("grams", pa.binary()), ("n", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, known = sent.value
        count = 0

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            number = (TaskContext.get().partitionId() << 32) + count
            rows = [{"block": number, "blob": _zip(sink.getvalue().to_pybytes())}]
            names = _names(table["lang"].to_pylist(), known)
            texts = np.array([*table["text"].to_pylist(), None], dtype=object)[:-1]
            for lang in sorted(known & set(names)):
                found = [np.empty(0, np.int64)]
                for _, _, _, grams in _texts(list(texts[names == lang]), order):
                    found.append(np.unique(grams))
                grams = np.unique(np.concatenate(found))
                if not len(grams):
                    continue
                shards = cells.shards(lang, grams)
                by_shard = np.argsort(shards, kind="stable")
                every, starts = np.unique(shards[by_shard], return_index=True)
                for shard, own in zip(every.tolist(), np.split(grams[by_shard], starts[1:]), strict=True):
                    rows.append({"block": number, "shard": shard, "lang": lang, "grams": _told(own), "n": len(own)})
            return pa.RecordBatch.from_pylist(rows, schema)

        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                held.append(batch.slice(at, 64))
                size += pc.sum(pc.binary_length(held[-1].column(2))).as_py() or 0
                if size >= block_bytes:
                    yield block(held)
                    held, size, count = [], 0, count + 1
        if held:
            yield block(held)

    return run


def _answer(order: int):
    def run(asked: pa.Table, model: pa.Table) -> pa.Table:
        shard = Shard(_held(model), order)
        rows = [
            {"block": r["block"], "lang": r["lang"], "grams": r["grams"], "logs": _zip(shard.logs(r["lang"], _heard(r["grams"])).tobytes())}
            for r in asked.select(["block", "lang", "grams"]).to_pylist()
        ]
        kinds = [("block", pa.int64()), ("lang", pa.string()), ("grams", pa.binary()), ("logs", pa.binary())]
        return pa.Table.from_pylist(rows, pa.schema(kinds))

    return run


def _add_up(sent, order: int):
    """The rows of a block, each with the sum over its text."""

    def run(group: pa.Table) -> pa.Table:
        known = sent.value[1]
        blob, by_lang = None, {}
        for row in group.to_pylist():
            if row["blob"] is not None:
                blob = row["blob"]
            else:
                logs = np.frombuffer(_unzip(row["logs"]), np.float64)
                by_lang.setdefault(row["lang"], []).append((_heard(row["grams"]), logs))
        answers = {}
        for lang, parts in by_lang.items():
            grams, logs = (np.concatenate(x) for x in zip(*parts, strict=True))
            by_gram = np.argsort(grams)
            answers[lang] = grams[by_gram], logs[by_gram]

        def logs_of(lang, keys):
            if not len(keys):
                return np.empty(0)
            grams, logs = answers[lang]
            return logs[np.searchsorted(grams, keys)]

        table = pa.ipc.open_stream(_unzip(blob)).read_all()
        names = _names(table["lang"].to_pylist(), known)
        sums = _sums(names, table["text"].to_pylist(), known, logs_of, order)
        return pa.table({"row": table["row"], "logs": pa.array(sums, pa.float64(), from_pandas=True)})

    return run


def _joined(
    docs: DataFrame, model: DataFrame, text_col: str, lang_col: str, order: int, shard_rows: int,
    block_bytes: int, asked_grams: int,
) -> DataFrame:
    """(row, logs) by a sharded join of the n-grams of blocks with a stored model."""
    spark = docs.sparkSession
    known = {r["lang"] for r in model.select("lang").distinct().collect()}
    cells, entries = sharded(model, shard_rows)
    sent = spark.sparkContext.broadcast((cells, known))
    row = F.col("row")
    rows = whole(docs).select("row", row[lang_col].alias("lang"), row[text_col].alias("text"))
    asked = stored(rows.mapInArrow(_ask(sent, order, block_bytes), ASKED))
    # Where many blocks ask, their questions to a shard are dealt to several copies of it.
    total = asked.agg(F.sum("n").alias("n")).first()["n"] or 0
    copies = blocks(total, cells.count * asked_grams)
    questions = asked.where("shard is not null").withColumn("copy", F.pmod("block", F.lit(copies)))
    tables_ = entries.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    answered = (
        questions.groupBy("shard", "copy")
        .cogroup(tables_.groupBy("shard", "copy"))
        .applyInArrow(_answer(order), "block long, lang string, grams binary, logs binary")
    )
    nothing = [F.lit(None).cast("string").alias("lang"), *(F.lit(None).cast("binary").alias(c) for c in ("grams", "logs"))]
    both = asked.where("blob is not null").select("block", "blob", *nothing).unionAll(
        answered.select("block", F.lit(None).cast("binary"), "lang", "grams", "logs")
    )
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("logs", T.DoubleType())])
    return both.groupBy("block").applyInArrow(_add_up(sent, order), schema)


def log_likelihoods(
    docs: DataFrame,
    model: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    shard_rows: int = 2_000_000,
    block_bytes: int = 16_000_000,
    asked_grams: int = 10_000_000,
) -> DataFrame:
    """(row, logs): each row and the log probability of its text.

    Languages without a model take that of all trusted text, if `model` has it; else it is null.
    Models of up to `shard_rows` rows are sent to all tasks; larger ones are joined in shards of that
    size with the n-grams of blocks of `block_bytes` of text. Results are the same.
    """
    model = stored(model)
    if model.count() > shard_rows:
        return _joined(docs, model, text_col, lang_col, order, shard_rows, block_bytes, asked_grams)
    sent = docs.sparkSession.sparkContext.broadcast(_held(model.toArrow()))
    logs = _sum(sent, order)(F.col("row")[lang_col], F.col("row")[text_col])
    return whole(docs).withColumn("logs", logs)


def trusted(labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(trusted, unseen): different ids of good quality, and whether the model is not to learn them."""
    good = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("trusted")).agg(F.min(label_col).alias("least"))
    return good.where("least = 1").select("trusted", held_out(F.col("trusted")).alias("unseen"))


def _limits(scored: DataFrame, ids: DataFrame, low: float, high: float, least: int) -> DataFrame:
    """(of, low, high) for each language of `scored` (id, language, perplexity).

    With `least` unseen trusted documents they are quantiles over those. With fewer, they are
    quantiles over such documents of all languages, of the log distance to the centre of the own
    language: the median of its documents not learned from, drawn towards that of all languages as
    if `least` more documents had it. If even these are fewer than `least`, whatever is within three
    standard deviations of the centre, by the quartiles of the documents not learned from, is inside
    too, and so are the more probable documents that were learned from.
    """
    rows = stored(
        scored.where("perplexity is not null")
        .join(ids, F.col("id") == F.col("trusted"), "left")
        .select("language", "perplexity", "unseen", F.log("perplexity").alias("log"))
    )
    unseen = F.when(F.col("unseen"), F.col("perplexity"))
    free = F.coalesce(F.col("unseen"), F.lit(True))
    middles = (
        F.coalesce(F.percentile_approx(F.when(free, F.col("log")), 0.5), F.percentile_approx("log", 0.5)).alias("middle"),
        F.count_if(free).alias("n"),
    )
    middle = rows.agg(*middles).first()["middle"]
    own = stored(
        rows.groupBy(F.col("language").alias("of"))
        .agg(
            F.count(unseen).alias("rows"),
            F.percentile_approx(unseen, low, 100_000).alias("low"),
            F.percentile_approx(unseen, high, 100_000).alias("high"),
            *middles,
        )
        .withColumn("centre", (F.col("middle") * F.col("n") + F.lit(middle).cast("double") * least) / (F.col("n") + least))
    )
    away = F.col("log") - F.col("centre")
    pool = (
        rows.join(small(own.select("of", "centre")), F.col("language") == F.col("of"))
        .agg(
            F.count(unseen).alias("rows"),
            F.percentile_approx(F.when(F.col("unseen"), away), low, 100_000).alias("low"),
            F.percentile_approx(F.when(F.col("unseen"), away), high, 100_000).alias("high"),
            F.percentile_approx(F.when(F.col("unseen").isNotNull(), away), low, 100_000).alias("learned"),
            F.coalesce(F.percentile_approx(F.when(free, away), [0.25, 0.75]), F.percentile_approx(away, [0.25, 0.75])).alias("half"),
        )
        .first()
    )
    ends = [pool["low"], pool["high"]]
    if pool["rows"] < least and pool["half"]:
        spread = 3 * (pool["half"][1] - pool["half"][0]) / 1.349
        ends = [min(-spread, ends[0] or 0.0, pool["learned"] or 0.0), max(spread, ends[1] or 0.0)]
    # A rounding error wider, so that the document at a limit is inside.
    common = [
        F.exp(F.col("centre") + F.lit(end).cast("double") + slack) for end, slack in zip(ends, (-1e-9, 1e-9), strict=True)
    ]
    enough = F.col("rows") >= least
    return stored(
        own.select("of", F.when(enough, F.col("low")).otherwise(common[0]).alias("low"), F.when(enough, F.col("high")).otherwise(common[1]).alias("high"))
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    low: float = 0.002,
    high: float = 0.995,
    least: int = 20,
    sent_ids: int = 2_000_000,
    carried: list[str] | None = None,
    out: str = "quality",
) -> DataFrame:
    """The columns of `docs`, or those in `carried`, and a struct `out` of (perplexity, low, high, keep).

    Trusted documents are those labelled of good quality; a quarter of them is not learned from and
    gives the quantiles. `keep` is whether the perplexity lies between them. Languages without
    `least` such documents have limits from all languages, see `_limits`; those nothing is learned
    of are scored by the model of all trusted text. Only where no text is trusted at all is there no
    perplexity, and all text is kept. Rows without a language are one language. Null and empty text
    has no perplexity and is not kept.
    """
    ids = stored(trusted(labels, id_col=id_col))
    learned = small(ids.where("not unseen").select("trusted"), sent_ids)
    lang = F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE))
    texts = docs.join(learned, docs[id_col] == learned["trusted"], "left_semi").select(
        lang.alias("lang"), F.col(text_col).alias("text")
    )
    counts = counted(texts)
    # Languages that nothing is learned of are scored by a model of all trusted text.
    has_text = F.octet_length(text_col) > 0
    own = small(stored(texts.where("octet_length(text) > 0").select("lang").distinct()))
    others = docs.where(has_text).select(lang.alias("lang")).join(own, "lang", "left_anti")
    if others.limit(1).count():
        counts = stored(counts)
        counts = counts.unionAll(counts.groupBy("gram").agg(F.sum("n").alias("n")).select(F.lit(POOLED).alias("lang"), "gram", "n"))
    scored = log_likelihoods(docs, tables(counts), text_col=text_col, lang_col=lang_col)
    row = F.col("row")
    size = F.coalesce(F.octet_length(row[text_col]), F.lit(0))
    kept = [c for c in carried or docs.columns if c.lower() != out.lower()]
    # Stored, as each text is to be scored once: for the quantiles and for the result.
    scored = stored(
        scored.select(
            F.struct(*(row[c].alias(c) for c in kept)).alias("row"),
            row[id_col].alias("id"),
            F.coalesce(row[lang_col], F.lit(NO_LANGUAGE)).alias("language"),
            F.when(size > 0, F.exp(-F.col("logs") / size)).alias("perplexity"),
            size.alias("size"),
        )
    )
    limits = _limits(scored, small(ids, sent_ids), low, high, least)
    judged = scored.join(small(limits), F.col("language") == F.col("of"), "left")
    inside = F.col("perplexity").between(F.col("low"), F.col("high"))
    keep = (F.col("size") > 0) & F.coalesce(inside, F.lit(True))
    result = F.struct("perplexity", "low", "high", keep.alias("keep"))
    return judged.select(*(F.col("row")[c].alias(c) for c in kept), result.alias(out))
