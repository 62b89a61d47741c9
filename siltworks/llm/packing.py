"""Packing of token pieces into sequences of a fixed length, by minimum bin slack.

Only the histogram of lengths, at most `capacity` rows, is needed to plan: for one bin after the
other, starting from the longest piece left, a bitset of reachable sums over the lengths still
available finds the fullest combination, which is taken out. A combination is taken as often as the
counts allow, so the plan has about as many lines as there are lengths, whatever the number of bins.

Pieces then find their place by rank within their length. Ranks come from counts per partition of
the stored pieces, so that a length which a third of all pieces have is ranked in parallel.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import stored

#: Fixed values of the token files: the id that ends each document.
END_ID = 0
#: The pattern that cuts text into words, for characters below U+0100, in lower case,
#: and what special tokens begin with.
_LETTER, _DIGIT, _BLANK = "a-z\u00AA\u00B5\u00BA\u00DF-\u00F6\u00F8-\u00FF", "0-9\u00B2\u00B3\u00B9\u00BC-\u00BE", "\\x09-\\x0D\\x20\u0085\u00A0"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_LETTER}{_DIGIT}{_BLANK}]+")
SPECIAL = "<|"
CACHED_WORDS = 600_000
WORDS_TOGETHER = 256

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of a text as bytes, four for each, little-endian.

    The tokenizer composes letters, folds case, drops white space, and merges within words alone:
    runs of letters, single digits, runs of marks. So the ids of a text are those of its words, one
    after the other, and words are kept for a while, as most come again. Texts whose characters are
    all below U+0100, where composing changes nothing and each letter has one lower case, are cut
    into words by the tokenizer's pattern; of others, the parts between blanks that are not ASCII
    are left to the tokenizer as they are, and so are parts that may hold its special marks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _one(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4").tobytes()

    @staticmethod
    def words(text: str, odd: set[str]) -> list[str]:
        """The words of a text; parts that are left as they are are put into `odd` too."""
        if SPECIAL not in text:
            try:
                text.encode("latin-1")
                return _WORD.findall(text.lower())
            except UnicodeEncodeError:
                pass
        out = []
        for part in text.replace("\n", " ").split(" "):
            if part.isascii() and SPECIAL not in part:
                out += _WORD.findall(part.lower())
            elif part:
                out.append(part)
                odd.add(part)
        return out

    def _learn(self, new: list[str]) -> None:
        # Together, and without the places of tokens in the text, which nobody needs.
        parts = [new[at : at + WORDS_TOGETHER] for at in range(0, len(new), WORDS_TOGETHER)]
        found = self.tokenizer.encode_batch_fast([" ".join(some) for some in parts], add_special_tokens=False)
        for some, encoded in zip(parts, found, strict=True):
            ids = np.array(encoded.ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            data = ids.tobytes()
            self.known.update(zip(some, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        odd: set[str] = set()
        cut = [self.words(t or "", odd) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        # Looks up the new words; subtracting the keys would go through all that are known.
        new = set().union(*cut).difference(self.known)
        self.known.update((w, self._one(w)) for w in new & odd)
        self._learn(list(new - odd))
        return [b"".join(map(self.known.__getitem__, words)) for words in cut]


def _cut(path: str, capacity: int, with_ids: bool):
    end = np.array([END_ID], dtype="<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        gc.disable()  # many small values and no cycles among them
        encoder = Encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows: list[list] = [[], [], [], [], [], []]
                for k, ids in enumerate(encoder.ids(some.column(1).to_pylist())):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), width)):
                        part = ids[start : start + width]
                        for column, value in zip(
                            rows, (k, piece, start // 4, len(part) // 4, zlib.crc32(part), part), strict=True
                        ):
                            column.append(value)
                out = [
                    some.column(0).take(pa.array(rows[0], pa.int64())),
                    pa.array(rows[1], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in rows[2:5]),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    flat = np.frombuffer(b"".join(rows[5]), dtype="<u4").astype(np.int32)
                    ends = np.concatenate([[0], np.cumsum(rows[3])]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    return run


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32 and, if asked for, ids) per piece of each document.

    A document is the ids of its text and an end id; null text is empty. Only documents longer than
    `capacity` are cut, and only their last piece may be shorter. Rows without an id, and repeated
    rows, are documents like any other.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = PIECES.format(id=narrow.schema["doc_id"].dataType.simpleString())
    if with_ids:
        schema += ", ids array<int>"
    return narrow.mapInArrow(_cut(tokenizer_path, capacity, with_ids), schema)


def fullest(counts: dict[int, int], first: int, capacity: int) -> dict[int, int]:
    """The combination with `first` in it whose sum is largest within `capacity`, as length: times.

    Sums are bits of one integer. Lengths are added from the longest on, in doubling lots of their
    count, until the bin can be full; the way back through the lots gives the combination.
    """
    room = capacity - first
    within = (1 << room + 1) - 1
    reach, lots = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left = min(counts[length] - (length == first), room // length)
        size = 1
        while left > 0 and not reach >> room & 1:
            size = min(size, left)
            lots.append((length, size, reach))
            reach |= (reach << length * size) & within
            left -= size
            size *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen = {first: 1}
    for length, size, before in reversed(lots):
        if not before >> at & 1:
            at -= length * size
            chosen[length] = chosen.get(length, 0) + size
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, combination) until no piece is left."""
    left = {x: n for x, n in histogram.items() if n > 0}
    out = []
    while left:
        chosen = fullest(left, max(left), capacity)
        times = min(left[x] // n for x, n in chosen.items())
        out.append((times, chosen))
        for x, n in chosen.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return out


def _places(planned: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length, lines (first rank, copies in a bin, first bin, first offset), by rank."""
    out: dict[int, list] = {}
    bins, ranks = 0, {}
    for times, chosen in planned:
        offset = 0
        for length, copies in chosen.items():
            out.setdefault(length, []).append((ranks.get(length, 0), copies, bins, offset))
            ranks[length] = ranks.get(length, 0) + copies * times
            offset += length * copies
        bins += times
    return {length: np.array(lines, dtype=np.int64) for length, lines in out.items()}


def _seat(places):
    def run(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        lengths, ranks = lengths.to_numpy(), ranks.to_numpy()
        bins, offsets = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        order = np.argsort(lengths, kind="stable")
        values, starts = np.unique(lengths[order], return_index=True)
        for length, own in zip(values.tolist(), np.split(order, starts[1:]), strict=True):
            lines = places.value[length]
            line = lines[np.searchsorted(lines[:, 0], ranks[own], side="right") - 1]
            within = ranks[own] - line[:, 0]
            bins[own] = line[:, 2] + within // line[:, 1]
            offsets[own] = line[:, 3] + within % line[:, 1] * length
        return pa.StructArray.from_arrays([pa.array(bins), pa.array(offsets)], ["sequence_id", "offset"])

    run.__annotations__ = {"lengths": pa.Array, "ranks": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "sequence_id long, offset long")


def place(rows: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """`rows`, which have a column length from 1 to `capacity`, with sequence_id and offset.

    Any further columns stay, but for earlier ones of these two names. An empty table stays empty.
    """
    names = [c for c in rows.columns if c.lower() not in ("sequence_id", "offset")]
    base = stored(rows.select(F.struct(*names).alias("row"), F.col("length").cast("long").alias("length")))
    base = base.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    counts = stored(base.groupBy("length", "part").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if histogram and not 1 <= min(histogram) <= max(histogram) <= capacity:
        raise ValueError("a length is outside 1 to the capacity")
    places = rows.sparkSession.sparkContext.broadcast(_places(plan(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("length").alias("l"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    ranked = base.withColumn(
        "nth", F.row_number().over(Window.partitionBy("length", "part").orderBy("at")) - 1
    ).join(starts, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p")))
    seat = _seat(places)(F.col("length"), F.col("base") + F.col("nth"))
    return ranked.select("row.*", seat.alias("seat")).select(*names, "seat.sequence_id", "seat.offset")


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = 2048, with_ids: bool = False, **columns) -> DataFrame:
    """The pieces of `docs` with their place: which sequence, and where in it."""
    return place(pieces(docs, tokenizer_path, capacity=capacity, with_ids=with_ids, **columns), capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, docs): token sequences of pieces that carry their ids."""
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("docs"))
    )
