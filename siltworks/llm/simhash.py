"""Documents whose SimHash fingerprints are linked by few differing bits.

Anchors are the words of a covering code of the 64-bit space: the perfect Hamming code on bits 0-62,
with bit 63 free. Every fingerprint is within distance 1 of an anchor. Two fingerprints at most t
bits apart have a midpoint within ceil(t/2) of both, and the midpoint has its anchor, so both are
replicated to every anchor within 1 + ceil(t/2): the covering radius plus each side's share of the
threshold. At t = 2 that is 33 anchors for a fingerprint, and at most 2,081 different fingerprints
at an anchor, however many rows share one. They are compared there, and each group of linked ones is
told as a star, so the links are no more than the copies of fingerprints.

Only different fingerprints are replicated. Groups are then joined by passing the smallest label
along links, in rounds that are each stored in the shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import opened, stored, whole

#: A word, after lower-casing A-Z, and the seed of the shingle hash.
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42
BITS = 64


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of word shingles; repeats count."""
    import xxhash

    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.fromiter((digest(p, seed) for p in parts), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        some = hashes[at : at + 8192]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(shingle: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t, shingle) for t in texts.to_pylist()], pa.int64())

    return F.arrow_udf(run, "long")


def _syndromes(prints: np.ndarray) -> np.ndarray:
    """XOR of the positions 1..63 of the bits set among bits 0-62."""
    out = np.zeros(len(prints), dtype=np.uint64)
    one = np.uint64(1)
    for bit in range(63):
        out ^= np.where((prints >> np.uint64(bit)) & one, np.uint64(bit + 1), np.uint64(0))
    return out


def _patterns(radius: int) -> list[np.ndarray]:
    """By syndrome, the changes of up to `radius` bits that lead from a word to an anchor."""
    out: list[list[int]] = [[] for _ in range(64)]
    for weight in range(radius + 1):
        for spots in combinations(range(63), weight):
            s = mask = 0
            for spot in spots:
                s ^= spot + 1
                mask |= 1 << spot
            out[s].append(mask)
            if weight < radius:
                out[s].append(mask | 1 << 63)
    return [np.array(x, dtype=np.uint64) for x in out]


def anchors(prints: np.ndarray, radius: int, patterns=None) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, index into `prints`) for every anchor within `radius`."""
    patterns = patterns or _patterns(radius)
    syndromes = _syndromes(prints)
    to, whose = [], []
    for s in np.unique(syndromes):
        own = np.flatnonzero(syndromes == s)
        masks = patterns[int(s)]
        to.append((prints[own][:, None] ^ masks[None, :]).ravel())
        whose.append(np.repeat(own, len(masks)))
    return np.concatenate(to), np.concatenate(whose)


def _replicate(max_bits: int):
    radius = 1 + -(-max_bits // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = _patterns(radius)
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(prints), 16_384):
                some = prints[at : at + 16_384]
                to, whose = anchors(some, radius, patterns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to.view(np.int64)), pa.array(some[whose].view(np.int64))],
                    ["anchor", "fp"],
                )

    return run


def _stars(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member linked to it) of the fingerprints at one anchor."""
    n = len(members)
    members = np.sort(members)
    label = np.arange(n)
    left, right = [], []
    for at in range(0, n, 512):
        far = np.bitwise_count(members[at : at + 512, None].view(np.uint64) ^ members.view(np.uint64))
        a, b = np.nonzero(far <= max_bits)
        left.append(a + at)
        right.append(b)
    left, right = np.concatenate(left), np.concatenate(right)
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(n)
    return members[moved], members[label[moved]]


def _compare(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            a, b = [], []
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                if end - start == 2:
                    x, y = sorted(flat[start:end].tolist())
                    if ((x ^ y) & (2**BITS - 1)).bit_count() <= max_bits:
                        a.append(np.array([y]))
                        b.append(np.array([x]))
                else:
                    member, least = _stars(flat[start:end], max_bits)
                    a.append(member)
                    b.append(least)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (a, b)], ["a", "b"]
                )

    return run


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): pairs of different fingerprints that join all within `max_bits` of each other.

    `prints` has one column fp without repeats. a is larger than b as a signed number.
    """
    posts = prints.select("fp").mapInArrow(_replicate(max_bits), "anchor long, fp long")
    met = (
        posts.groupBy("anchor")
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
        .select("members")
    )
    return met.mapInArrow(_compare(max_bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of `edges` (a, b) reaches.

    Rounds of two steps: the larger neighbours of a node, then the smaller ones and itself, are tied
    to the smallest node that it knows. Edges never grow in number, and long chains are halved. Ends
    when a round changes nothing: where counts and sums over the stored edges have not changed, the
    edges themselves are compared. The tables of smallest nodes are stored, so that joins with them
    can be split at a node with many edges.
    """
    before = earlier = None
    edges = stored(edges.select("a", "b"))
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("low")))
        large = stored(
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(low, "a")
        edges = stored(
            small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionAll(low.select("a", F.col("low").alias("b")))
            .distinct()
        )
        now = edges.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1_000_003))), F.sum(F.col("b") % 1_000_003)
        ).first()
        if now == before and edges.join(earlier, ["a", "b"], "left_anti").isEmpty():
            break
        before, earlier = now, edges
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """(id, fp, component): per row of `docs` its fingerprint and the smallest id it reaches.

    Text without words, and null, has fingerprint zero and is linked like any other. Rows with equal
    fingerprints are in one component, also rows without an id; a component without any id is null.
    """
    prints = stored(
        docs.select(F.col(id_col).alias("id"), fingerprints(shingle)(F.col(text_col)).alias("fp"))
    )
    return with_component(prints, max_bits).drop("root")


def with_component(prints: DataFrame, max_bits: int) -> DataFrame:
    """`prints`, stored and with columns id and fp, and columns component and root.

    The root, a fingerprint, names the component; two components without any id differ in it only.
    """
    kinds = stored(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(kinds, max_bits))
    rooted = kinds.join(roots, kinds["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    known = rooted.join(least, "root").select(F.col("fp").alias("known"), "component", "root")
    return prints.join(known, prints["fp"] == known["known"]).drop("known")


def one_of_each(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """The rows of `docs` that are first of their component: one row for each, all columns.

    Of repeated rows with the smallest id one stays, the smallest by text hash. Rows without an id
    stay only if no row of their component has one, and then one of them.
    """
    columns = docs.columns
    row = F.col("row")
    prints = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"),
            fingerprints(shingle)(F.col(text_col)).alias("fp"),
        )
    )
    first = with_component(prints, max_bits).where(F.col("id").eqNullSafe(F.col("component")))
    best = first.groupBy("root").agg(
        F.min("id").alias("keep"), F.min(F.struct("fp", "version")).alias("best")
    )
    chosen = stored(
        prints.alias("p")
        .join(best.alias("b"), (F.col("p.fp") == F.col("b.best.fp")) & (F.col("p.version") == F.col("b.best.version")))
        .where(F.col("p.id").eqNullSafe(F.col("b.keep")))
        .groupBy("b.root", F.col("b.keep").alias("keep"), F.col("b.best.version").alias("keep_version"))
        .agg(F.count("*").alias("copies"))
    )
    rows = (
        whole(docs)
        .withColumn("id", row[id_col])
        .withColumn("version", F.xxhash64(F.coalesce(row[text_col], F.lit(""))))
        .join(
            chosen,
            F.col("id").eqNullSafe(F.col("keep")) & (F.col("version") == F.col("keep_version")),
        )
    )
    kept = rows.where("copies = 1")
    if not chosen.where("copies > 1").isEmpty():
        kept = kept.unionAll(rows.where("copies > 1").dropDuplicates(["root"]))
    return opened(kept, columns)
