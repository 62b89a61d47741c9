"""Language identification with a string kernel.

The kernel counts the different character n-grams, of lengths 1 to 3 together, that two texts share,
divided by the geometric mean of how many each has. It is approximated from landmark texts (Nystroem)
and a kernel ridge regression is solved for each language against the others. Both are fitted on the
driver on a bounded sample of rows whose language is known. Scoring is a map: the n-grams of whole
texts become rows of presence, and matrix products give the kernel and the answers of a batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import held_out, opened, whole
from siltworks.llm.sampling import bounded

LENGTHS = (1, 2, 3)
#: What text without letters is taken for.
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_BLANKS = re.compile(r"\s+")
RESULT = "lang string, score double"
BATCH = 256
#: N-grams that a matrix product takes at a time, and bytes of unpacked landmarks that are kept.
COLUMNS, KEPT_BYTES = 1 << 14, 64 << 20


def _points(text: str) -> np.ndarray:
    folded = f" {_BLANKS.sub(' ', text.lower()).strip()} "
    return np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), dtype="<u4")


class Grams:
    """The n-grams of some texts, each with a number; others are unknown.

    Characters are numbered first, so that an n-gram is a number too, in base (characters + 1).
    """

    def __init__(self, characters: np.ndarray, known: list[np.ndarray]):
        self.characters, self.known = characters, known
        self.base = len(characters) + 1
        self.starts = np.cumsum([0, *map(len, known)])
        self.low = np.zeros(1 << 16, dtype=np.int64)
        small = characters < len(self.low)
        self.low[characters[small]] = np.flatnonzero(small) + 1
        # A direct table where it is small; other lengths are searched.
        self.tables = []
        for n, grams in zip(LENGTHS, known, strict=True):
            table = None
            if self.base**n <= 1 << 22:
                table = np.full(self.base**n, -1, dtype=np.int32)
                table[grams] = np.arange(len(grams))
            self.tables.append(table)

    @classmethod
    def of(cls, texts: list[str]) -> Grams:
        characters = np.unique(np.concatenate([np.unique(_points(t)) for t in texts])).astype(np.int64)
        empty = cls(characters, [np.empty(0, np.int64)] * len(LENGTHS))
        seen = [[np.unique(c) for c in empty.codes(_points(t))] for t in texts]
        return cls(characters, [np.unique(np.concatenate(x)) for x in zip(*seen, strict=True)])

    @property
    def size(self) -> int:
        return int(self.starts[-1])

    def codes(self, points: np.ndarray) -> list[np.ndarray]:
        """By length, the n-grams whose characters are all known."""
        points = points.astype(np.int64)
        numbers = self.low[np.minimum(points, len(self.low) - 1)]
        high = points >= len(self.low) - 1
        if high.any():
            at = np.searchsorted(self.characters, points[high])
            at = np.minimum(at, len(self.characters) - 1)
            numbers[high] = np.where(self.characters[at] == points[high], at + 1, 0)
        out = []
        for n in LENGTHS:
            parts = [numbers[i : len(numbers) - n + 1 + i] for i in range(n)]
            code = np.zeros(len(parts[0]), dtype=np.int64)
            known = np.ones(len(code), dtype=bool)
            for part in parts:
                code = code * self.base + part
                known &= part > 0
            out.append(code[known])
        return out

    def present(self, text: str) -> np.ndarray:
        """The numbers of the different known n-grams of a text."""
        flags = np.zeros(self.size, dtype=bool)
        for k, code in enumerate(self.codes(_points(text))):
            if self.tables[k] is not None:
                at = self.tables[k][code]
                at = at[at >= 0]
            else:
                spot = np.minimum(np.searchsorted(self.known[k], code), max(len(self.known[k]) - 1, 0))
                at = spot[self.known[k][spot] == code] if len(self.known[k]) else spot[:0]
            flags[self.starts[k] + at] = True
        return flags


class Landmarks:
    """Presence of n-grams in the landmark texts, packed; kernels of other texts with them."""

    def __init__(self, packed: np.ndarray, size: int):
        self.packed, self.size = packed, size
        self.counts = np.maximum(np.bitwise_count(packed).sum(axis=1, dtype=np.int64), 1)
        self.blocks = None
        if 4 * size * len(packed) <= KEPT_BYTES:
            self.blocks = [self._unpacked(at) for at in range(0, size, COLUMNS)]

    def _unpacked(self, at: int) -> np.ndarray:
        width = min(COLUMNS, self.size - at)
        bits = self.packed[:, at // 8 : (at + COLUMNS) // 8]
        return np.unpackbits(bits, axis=1, count=width).astype(np.float32).T

    def kernel(self, found: np.ndarray) -> np.ndarray:
        """Of rows of presence, a block of n-grams at a time; sums of ones are exact."""
        shared = np.zeros((len(found), len(self.packed)), dtype=np.float32)
        for k, at in enumerate(range(0, self.size, COLUMNS)):
            block = self.blocks[k] if self.blocks is not None else self._unpacked(at)
            shared += found[:, at : at + COLUMNS].astype(np.float32) @ block
        mine = np.maximum(found.sum(axis=1), 1)
        return shared / np.sqrt(mine[:, None] * self.counts[None, :])


def fit(
    rows: list[tuple[str, str]], *, landmarks: int = 160, least: int = 4, ridge: float = 1e-2, seed: int = 5
) -> dict | None:
    """What `predict` needs, of (text, language) rows; None without any.

    Landmarks are `landmarks` of the rows, an equal number of each language, and `least` of each at
    least. In memory are, beside the texts, the packed presence of n-grams in landmarks and the
    kernel of rows and landmarks; presence in rows is made for `BATCH` rows at a time.
    """
    rows = [(t, lang) for t, lang in rows if _LETTER.search(t)]
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    names = sorted({lang for _, lang in rows})
    by_name: list[list[int]] = [[] for _ in names]
    place = {name: k for k, name in enumerate(names)}
    for k, (_, lang) in enumerate(rows):
        by_name[place[lang]].append(k)
    each = max(least, landmarks // len(names))
    marks = [k for own in by_name for k in rng.permutation(own)[:each]]
    grams = Grams.of([rows[k][0] for k in marks])
    packed = np.array([np.packbits(grams.present(rows[k][0])) for k in marks])
    basis = Landmarks(packed, grams.size)
    parts = []
    for at in range(0, len(rows), BATCH):
        parts.append(basis.kernel(np.array([grams.present(t) for t, _ in rows[at : at + BATCH]])))
    kernel = np.concatenate(parts)
    values, vectors = np.linalg.eigh(kernel[marks].astype(np.float64))
    good = values > 1e-8 * values.max()
    to = vectors[:, good] / np.sqrt(values[good])
    x = np.hstack([kernel @ to, np.ones((len(rows), 1))])
    own = np.array([place[lang] for _, lang in rows])
    y = np.where(own[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = len(rows) / len(names) / np.array([len(b) for b in by_name])[own]
    gram = (x * weight[:, None]).T @ x + ridge * np.eye(x.shape[1])
    solved = np.linalg.solve(gram, (x * weight[:, None]).T @ y)
    return {
        "names": names,
        "characters": grams.characters,
        "known": grams.known,
        "basis": packed,
        "answers": to @ solved[:-1],
        "bias": solved[-1],
    }


class Predictor:
    def __init__(self, model: dict):
        self.model = model
        self.grams = Grams(model["characters"], model["known"])
        self.basis = Landmarks(model["basis"], self.grams.size)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        own = [k for k, t in enumerate(texts) if t and _LETTER.search(t)]
        for at in range(0, len(own), BATCH):
            some = own[at : at + BATCH]
            found = np.array([self.grams.present(texts[k]) for k in some])
            answers = self.basis.kernel(found) @ self.model["answers"] + self.model["bias"]
            best = answers.argmax(axis=1)
            odds = np.exp(4 * (answers - answers.max(axis=1, keepdims=True)))
            sure = odds.max(axis=1) / odds.sum(axis=1)
            for k, name, score in zip(some, best, sure, strict=True):
                out[k] = (self.model["names"][name], float(score))
        return out


def train(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    max_bytes: int = 16_000_000,
    max_rows: int = 4_000,
    **options,
) -> dict | None:
    """Fit on at most `per_language` rows of each language, `max_rows` rows (or one of each language,
    if these are more) and `max_bytes` of text, shared by them.

    Rows that are held out, or whose text or language is missing, are not learned from.
    """
    sample = bounded(
        docs.where(~held_out(F.col(id_col))),
        None,
        by=lang_col,
        per_group=per_language,
        max_bytes=max_bytes,
        max_rows=max_rows,
        id_col=id_col,
        text_col=text_col,
    )
    return fit(sample, **options)


def identifier(docs: DataFrame, model: dict | None) -> Column:
    """A function of a text column: struct of lang and score. Without a model all are unknown."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predictor = Predictor(sent.value) if sent.value else None
        for texts in batches:
            values = texts.to_pylist()
            found = predictor.predict(values) if predictor else [(UNKNOWN, 0.0)] * len(values)
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang", "score"],
            )

    return F.arrow_udf(run, RESULT)


def identify(docs: DataFrame, model: dict | None, *, text_col: str = "text", out: str = "language") -> DataFrame:
    """All rows and columns of `docs` and a struct `out` of (lang, score).

    Null text, and text without a letter, is "und" with score 0. Scores are the share of the best
    language among the exponentials of all answers. An input column named as `out` is replaced.
    """
    found = whole(docs).withColumn("found", identifier(docs, model)(F.col("row")[text_col]))
    return opened(found, docs.columns, **{out: F.col("found")})
