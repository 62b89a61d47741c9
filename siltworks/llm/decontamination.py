"""Passages of benchmark items in documents: one automaton, one scan of the text.

Items are cut into windows of normalised words. The windows become an Aho-Corasick automaton over
words (each word of the windows is one symbol), which every task builds once and runs over each text
from end to end. Hits are mapped back to code points of the original.

Windows are sent to all tasks, so their size is measured first: beyond `max_bytes` they are dealt by
hash into several automata, and the documents are scanned for one after the other.
"""

from __future__ import annotations

import re
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.common import ascii_lower, blocks, opened, stored, whole

#: Fixed value: a word, in text whose A-Z are in lower case, and the same in UTF-8.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_UNKNOWN = "\x00"

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("words", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_HITS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int32()))),
        ("words", pa.list_(pa.list_(pa.int32()))),
        ("items", pa.list_(pa.string())),
    ]
)


def windows(items: DataFrame, *, id_col: str, text_col: str, length: int) -> DataFrame:
    """(item, window): distinct windows of `length` words joined by spaces; one for shorter items."""
    words = F.regexp_extract_all("folded", F.lit(WORD), F.lit(0))
    last = F.greatest(F.size("words") - length, F.lit(0))
    return (
        items.select(
            F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
            ascii_lower(F.col(text_col)).alias("folded"),
        )
        .select("item", words.alias("words"))
        .where(F.size("words") > 0)
        .select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select("item", F.array_join(F.slice("words", F.col("at") + 1, length), " ").alias("window"))
        .distinct()
    )


class _Scanner:
    """The automaton of some windows: from UTF-8 text to hits."""

    def __init__(self, posts: list[tuple[str, str]]):
        import ahocorasick

        self.symbols: dict[bytes, str] = {}
        self.automaton = ahocorasick.Automaton()
        named: dict[str, tuple[int, set[str]]] = {}
        for item, window in posts:
            words = window.encode().split(b" ")
            key = "".join(self.symbols.setdefault(w, self._symbol(len(self.symbols))) for w in words)
            named.setdefault(key, (len(words), set()))[1].add(item)
        for key, value in named.items():
            self.automaton.add_word(key, value)
        if named:
            self.automaton.make_automaton()
        self.empty = not named

    @staticmethod
    def _symbol(n: int) -> str:
        return chr(n + 1 if n + 1 < 0xD800 else n + 0x801)

    def hits(self, text: str | None, known: list[list[int]], items: list[str]) -> dict:
        data = (text or "").encode("utf-8", "surrogatepass")
        words = _WORD.findall(data.lower())
        found, runs = set(items), [tuple(r) for r in known]
        if not self.empty:
            symbols = "".join(map(self.symbols.get, words, repeat(_UNKNOWN)))
            for end, (n, names) in self.automaton.iter(symbols):
                runs.append((end + 1 - n, end + 1))
                found |= names
        merged: list[list[int]] = []
        for start, end in sorted(runs):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(end, merged[-1][1])
            else:
                merged.append([start, end])
        return {
            "n_words": len(words),
            "n_hit": sum(b - a for a, b in merged),
            "spans": _code_points(data, merged) if merged else [],
            "words": merged,
            "items": sorted(found),
        }


def _code_points(data: bytes, runs: list[list[int]]) -> list[list[int]]:
    """Runs of words as [start, end) in code points of the text."""
    spots = [m.span() for m in _WORD.finditer(data.lower())]
    out, at, seen = [], 0, 0
    for first, end in runs:
        pair = []
        for spot in (spots[first][0], spots[end - 1][1]):
            seen += len(data[at:spot].decode("utf-8", "surrogatepass"))
            at = spot
            pair.append(seen)
        out.append(pair)
    return out


def _scan(posts) -> Column:
    built: list[_Scanner] = []

    def run(batches):
        if not built:
            built.append(_Scanner(posts.value))
        for text, hits in batches:
            before = hits.to_pylist()
            out = [
                built[0].hits(t, h["words"] if h else [], h["items"] if h else [])
                for t, h in zip(text.to_pylist(), before, strict=True)
            ]
            yield pa.array(out, _HITS)

    run.__annotations__ = _ITERATOR
    return F.arrow_udf(run, HITS)


def _iterator_types() -> dict:
    from collections.abc import Iterator

    return {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


_ITERATOR = _iterator_types()


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    length: int = 10,
    max_bytes: int = 8_000_000,
    out: str = "hits",
) -> DataFrame:
    """All columns of `docs` and a struct `out` of (n_words, n_hit, spans, words, items).

    `words` are merged runs [from, to) of words hit, `spans` the same in code points of the original
    text, `items` the ids, as sorted strings, of items with an occurring window. Null text has no
    words; items without words have no window; items without an id count as one, named "". Repeated
    rows stay. An input column named as `out` is replaced.
    """
    posts = windows(items, id_col=item_col, text_col=item_text_col, length=length)
    size = posts.select(F.sum(F.octet_length("window") + F.octet_length("item") + 16).alias("n"))
    parts = blocks(size.first()["n"] or 0, max_bytes)
    context = docs.sparkSession.sparkContext
    found = whole(docs).withColumn("hits", F.lit(None).cast(HITS))
    if parts > 1:
        posts = stored(posts)
    for part in range(parts):
        mine = posts.where(F.pmod(F.xxhash64("item", "window"), F.lit(parts)) == part)
        sent = context.broadcast([(r["item"], r["window"]) for r in mine.collect()])
        found = found.withColumn("hits", _scan(sent)(F.col("row")[text_col], F.col("hits")))
        if parts > 1:
            found = stored(found)
    return opened(found, docs.columns, **{out: F.col("hits")})
