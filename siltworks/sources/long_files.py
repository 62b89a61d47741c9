"""Reading CSV files of any length in blocks, although their records may span lines.

The multi-line CSV reader gives each file to one task.  Here the file is read as
text, in blocks, and records are put together from lines.  At the start of a line
a parser is either between records or inside quotes, so each line is a map of
those two states: it resets the state, keeps it, or turns it.

A survey follows each block from both states and keeps a few numbers of it: the
state it ends in, and where records begin and end that it shares with other blocks.
Block by block, that tells in which state each one begins.  Then every block is
read again where it lies: records inside it are put together by its task, and only
lines of records cut by a block's border cross the network.

The result equals the multi-line reader's, also for irregular quotes.  A file's
lines end as its first one does, which the first bytes of the file show.  Where a
file mixes line ends, a line feed that is not its line end is text here, while the
multi-line reader takes it for a line end at the start of a field only.  If no line
of an extract leaves quotes open, lines are records and the plain line reader takes
over.

The survey's numbers, about 100 bytes a block, pass through the driver and are sent
to all tasks: 0.1 GB for an extract of a million blocks, which are 128 TB unless
shorter blocks are asked for.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltworks.sources.shared_files import first_text

# Executors get the functions of this module by value, so they need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Blocks are read together while a task gets less than this.
TASK_BYTES = 16 << 20
CSV_OPTIONS = {"escape": '"', "multiLine": "true"}
# A block: a stretch of a file, and the task that reads it.
_BLOCK = ("file", "block", "length", "task")

# A line, begun at the start of a field, that ends inside quotes.  Before its last
# field stand whole ones: plain, empty, or quoted with anything after the closing
# quote, which the parser takes up to the next comma.
_FIELDS = r'(?:(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+)?+,)*+'
_OPEN = rf'^{_FIELDS}"(?:[^"]|"")*+$'
# A line with something between a closing quote and the next comma.
_LOOSE = r'^(?:(?:"(?:[^"]|"")*+"|[^",][^,]*+)?+,)*+"(?:[^"]|"")*+"[^,]'


def file_column(columns: list[str]) -> str:
    """A name for the file of a row that no column of the extract has."""
    name = "_read_from"
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name


def _with_settings_of(spark: SparkSession) -> SparkSession:
    """A session in which files are always cut into the same blocks, whatever becomes of ``spark``.

    Otherwise changed settings, or the number of executors, could cut them anew between the survey
    and the reading.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name) and session.conf.get(name, None) != value:
            session.conf.set(name, value)
    least = "spark.sql.files.minPartitionNum"
    if not session.conf.get(least, None):
        session.conf.set(least, str(spark.sparkContext.defaultParallelism))
    return session


def _line_end(spark: SparkSession, file: str) -> str:
    """How the first line of a file ends."""
    length = 1 << 14
    while True:
        text = first_text(spark, file, length)
        at = min((k for k in (text.find("\n"), text.find("\r")) if k >= 0), default=-1)
        if 0 <= at < len(text) - 1:
            return "\n" if text[at] == "\n" else "\r\n" if text[at + 1] == "\n" else "\r"
        if len(text) < length:
            return text[at] if at >= 0 else "\n"
        length *= 16


def _files_by_line_end(spark: SparkSession, path: str) -> dict[str, list[str]]:
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(16) as pool:
        ends = pool.map(inheritable_thread_target(spark)(lambda f: _line_end(spark, f)), files)
        found = defaultdict(list)
        for file, end in zip(files, ends, strict=True):
            found[end].append(file)
    return dict(found)


def _lines(spark: SparkSession, files: str | list[str], separator: str) -> DataFrame:
    """Lines with the block they are read in and their order there."""
    lines = spark.read.text(files, lineSep=separator).select(
        F.col("value").alias("line"),
        F.input_file_name().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"),
        F.spark_partition_id().alias("task"),
        F.monotonically_increasing_id().alias("at"),
        (F.octet_length("value") + len(separator)).alias("bytes"),
        F.col("_metadata.file_size").alias("size"),
    )
    mark = F.when(F.col("block") == 0, F.regexp_replace("line", "^\ufeff", "")).otherwise(F.col("line"))
    return lines.withColumn("line", mark)


def _with_maps(lines: DataFrame) -> DataFrame:
    """Lines with the state each leads to: inside quotes or not, from either state."""
    quoted = F.col("line").contains('"')
    return lines.withColumns(
        {
            "from_out": F.when(quoted, F.col("line").rlike(_OPEN)).otherwise(F.lit(False)),
            "from_in": F.when(quoted, F.concat(F.lit('"'), "line").rlike(_OPEN)).otherwise(
                F.lit(True)
            ),
        }
    )


def _followed(changes: Column) -> Column:
    """What the state-changing lines of a block make of a block begun outside quotes and inside.

    ``out0``, ``out1``: the state at its end.  ``head1``: the line that ends the record the block
    begins in.  ``tail0``, ``tail1``: the line that begins the last record with open quotes.
    """
    nowhere = F.lit(None).cast("bigint")
    begun = F.struct(
        F.lit(False).alias("out0"), F.lit(True).alias("out1"), nowhere.alias("head1"),
        nowhere.alias("tail0"), nowhere.alias("tail1"),
    )

    def step(so_far: Column, change: Column) -> Column:
        now = {
            b: F.when(change["turns"], ~so_far[f"out{b}"]).otherwise(change["inside"]) for b in (0, 1)
        }
        tails = [
            F.when(now[b] & ~so_far[f"out{b}"], change["at"]).otherwise(so_far[f"tail{b}"]).alias(f"tail{b}")
            for b in (0, 1)
        ]
        head = F.coalesce(so_far["head1"], F.when(~now[1], change["at"]))
        return F.struct(now[0].alias("out0"), now[1].alias("out1"), head.alias("head1"), *tails)

    return F.aggregate(F.array_sort(changes), begun, step)


def _survey(lines: DataFrame) -> list:
    """One row per block, by file and place."""
    line = F.col("line")
    same = F.col("from_out") == F.col("from_in")
    turns = F.col("from_out") & ~F.col("from_in")
    change = F.struct("at", turns.alias("turns"), F.col("from_out").alias("inside"))
    found = _with_maps(lines).groupBy(*_BLOCK).agg(
        F.collect_list(F.when(same | turns, change)).alias("changes"),
        F.max("at").alias("last_at"),
        F.min(F.when(line != "", F.col("at"))).alias("text_at"),
        F.sum("bytes").alias("bytes"),
        F.max("size").alias("size"),
        F.max(F.col("from_out") | (line.contains('"') & line.rlike(_LOOSE))).alias("spans"),
        F.max(line.contains("\r") | line.contains("\n")).alias("mixed"),
        F.max(line.rlike(r"^[\x00-\x20]+$")).alias("blank"),
    )
    found = found.withColumn("followed", _followed(F.col("changes")))
    return found.drop("changes").select("*", "followed.*").drop("followed").orderBy("file", "block").collect()


# What tasks get to know of each block: its number, the line that ends the record it begins in,
# whether that record goes on behind it, the number of the block that record began in, and the line
# that begins a record which goes on behind it.
_PLACES = (
    "file string, block bigint, length bigint, task int, nth int, head bigint, through boolean, "
    "begun int, tail bigint"
)


def _placed(blocks: list) -> tuple[list[tuple], set[int], set[int], dict[int, tuple[bool, str]]]:
    """Blocks in their true state.

    Rows of ``_PLACES``; blocks whose first record is a header; blocks whose last record has no line
    end; and for each block in which a cut record begins, whether that is a header, and what to put
    behind it.
    """
    rows, headers, unended, cut = [], set(), set(), {}
    for nth, b in enumerate(blocks):
        if not rows or b.file != blocks[nth - 1].file:
            inside, begun, header, total = False, None, False, 0
        total += b.bytes
        head, through = (b.head1, b.head1 is None) if inside else (None, False)
        ends = b.out1 if inside else b.out0
        tail = (b.tail1 if inside else b.tail0) if ends else None
        rows.append((b.file, b.block, b.length, b.task, nth, head, through, begun, tail))
        if tail is not None:
            cut[nth] = (not header and b.text_at == tail, "\n")
        if not header and b.text_at is not None:
            header = True
            if b.text_at != tail:
                headers.add(nth)
        if head is not None:
            cut[begun] = (cut[begun][0], ",")
        last = nth + 1 == len(blocks) or blocks[nth + 1].file != b.file
        if last and total != b.size:
            # The parser treats the end of its input unlike the end of a field in a line.
            owner = nth if tail is not None else begun if through or head == b.last_at else None
            if owner is None:
                unended.add(nth)
            else:
                cut[owner] = (cut[owner][0], "")
        inside, begun = ends, (nth if tail is not None else begun) if ends else None
    return rows, headers, unended, cut


def _after(from_out: np.ndarray, from_in: np.ndarray, inside: bool) -> np.ndarray:
    """The state behind each line, if it is ``inside`` before the first."""
    turn = np.cumsum(from_out & ~from_in)
    place = np.where(from_out == from_in, np.arange(len(from_out)), -1)
    last = np.maximum.accumulate(place)
    state = np.where(last >= 0, from_out[last], inside)
    return state ^ ((turn - np.where(last >= 0, turn[last], 0)) % 2 == 1)


class _Assembler:
    """Records of one block after the other, from lines that come in order."""

    def __init__(self, headers: set[int], unended: set[int]):
        self.headers, self.unended = headers, unended
        self.block, self.inside = None, False
        self.open: list[str] = []

    def begin(self, block: int) -> list[str]:
        """Go on with another block; what was kept back of the last one."""
        rest = [] if self.block is None else self.kept
        self.block, self.inside, self.open, self.kept = block, False, [], []
        self.header = block in self.headers
        return rest

    def records(self, lines: pa.Array, from_out: np.ndarray, from_in: np.ndarray) -> Iterator[pa.Array]:
        after = _after(from_out, from_in, self.inside)
        before = np.append(self.inside, after[:-1])
        alone = np.flatnonzero(~before & ~after)
        alone = alone[pc.not_equal(lines.take(alone), "").to_numpy(zero_copy_only=False)]
        opens, closes = np.flatnonzero(~before & after).tolist(), np.flatnonzero(before & ~after).tolist()
        spanning: list[tuple[int, str]] = []
        if self.inside:
            opens.insert(0, -1)
        for k, start in enumerate(opens):
            end = closes[k] if k < len(closes) else len(lines) - 1
            piece = lines.slice(max(start, 0), end + 1 - max(start, 0)).to_pylist()
            self.open = self.open + piece if start < 0 else piece
            if k < len(closes):
                spanning.append((start, "\n".join(self.open)))
                self.open = []
        self.inside = bool(after[-1])
        if self.header:
            # The first record that is not empty; it may go on behind these lines.
            first = min([*alone[:1].tolist(), *opens[:1]], default=None)
            if first is not None and (not opens or first != opens[0] or closes):
                self.header = False
                spanning = [s for s in spanning if s[0] != first]
                alone = alone[alone != first]
        if self.block not in self.unended:
            texts = pa.concat_arrays([lines.take(alone), pa.array([t for _, t in spanning], lines.type)])
            yield pc.binary_join_element_wise(texts, ",", "")
            return
        # The last record of the file has no line end.
        found = sorted([*spanning, *zip(alone.tolist(), lines.take(alone).to_pylist(), strict=True)])
        if found:
            yield pa.array([f"{t}," for t in self.kept + [t for _, t in found[:-1]]], lines.type)
            self.kept = [found[-1][1]]


def _assembled(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _Assembler(*sent.value)

        def told(nth: int, records: pa.Array) -> pa.RecordBatch:
            numbers = pa.array(np.full(len(records), nth, dtype=np.int32))
            return pa.RecordBatch.from_arrays([numbers, records], ["nth", "record"])

        for batch in batches:
            nth = batch.column(0).to_numpy()
            maps = [batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in (2, 3)]
            borders = [0, *(np.flatnonzero(np.diff(nth)) + 1).tolist(), len(nth)]
            for a, b in zip(borders, borders[1:], strict=False):
                if a == b:
                    continue
                if nth[a] != work.block:
                    before = work.block
                    if rest := work.begin(int(nth[a])):
                        yield told(before, pa.array(rest, pa.string()))
                for records in work.records(batch.column(1).slice(a, b - a), *(m[a:b] for m in maps)):
                    yield told(work.block, records)
        if work.block is not None and (rest := work.begin(-1)):
            yield told(int(nth[-1]), pa.array(rest, pa.string()))

    return run


def _records(spark: SparkSession, files: str | list[str], separator: str, blocks: list) -> DataFrame:
    """(file, record): whole records of all lines but each file's first.

    A record that a line end follows gets a comma, one field more than there are columns or one that
    is null anyway; quotes that are never closed hold the rest of the file, its last line end
    included.
    """
    rows, headers, unended, cut = _placed(blocks)
    places = F.broadcast(spark.createDataFrame(rows, _PLACES))
    lines = _lines(spark, files, separator)
    # Short blocks, as of many small files, are read several to a task, one after the other.
    tasks, total = len({b.task for b in blocks}), sum(b.bytes for b in blocks)
    wanted = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    if tasks > 2 * wanted:
        lines = lines.coalesce(wanted)
    lines = lines.join(places, list(_BLOCK), "left")
    moved = F.raise_error(F.lit("the files, or the blocks they are cut into, have changed: read again"))
    through = F.when(F.col("nth").isNull(), moved.cast("boolean")).otherwise(F.col("through"))
    ends_record = through | F.coalesce(F.col("at") <= F.col("head"), F.lit(False))
    begins_record = F.coalesce(F.col("at") >= F.col("tail"), F.lit(False))
    sent = spark.sparkContext.broadcast((headers, unended))
    whole = (
        _with_maps(lines.filter(~ends_record & ~begins_record))
        .select("nth", "line", "from_out", "from_in")
        .mapInArrow(_assembled(sent), "nth int, record string")
    )
    if cut:
        pieces = lines.filter(ends_record | begins_record).select(
            F.when(ends_record, F.col("begun")).otherwise(F.col("nth")).alias("first"), "nth", "at", "line"
        )
        endings = [(n, header, ending) for n, (header, ending) in cut.items()]
        known = F.broadcast(spark.createDataFrame(endings, "first int, header boolean, ending string"))
        joined = pieces.groupBy("first").agg(
            F.array_sort(F.collect_list(F.struct("nth", "at", "line"))).alias("lines")
        )
        text = F.concat(F.array_join("lines.line", "\n"), "ending")
        joined = joined.join(known, "first").filter(~F.col("header"))
        whole = whole.unionByName(joined.select(F.col("first").alias("nth"), text.alias("record")))
    names = F.broadcast(spark.createDataFrame([(r[4], r[0]) for r in rows], "nth int, file string"))
    return whole.join(names, "nth").select("file", "record")


def read_long_extract(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """Same rows as the multi-line reader, from any number of tasks, and the name of a further
    column that tells each row's file."""
    columns = spark.read.options(header=True, **CSV_OPTIONS).csv(path).columns
    name = file_column(columns)
    session = _with_settings_of(spark)
    groups = _files_by_line_end(spark, path)
    found = {
        end: _survey(_lines(session, path if len(groups) == 1 else files, end))
        for end, files in groups.items()
    }
    blocks = [b for of in found.values() for b in of]
    ended = sum(b.bytes for b in blocks) == sum({b.file: b.size for b in blocks}.values())
    plain = list(found) in ([], ["\n"]) or (list(found) == ["\r\n"] and ended)
    if plain and not any(b.spans or b.mixed or b.blank for b in blocks):
        separator = next(iter(found), "\n")
        read = spark.read.csv(path, header=True, escape='"', lineSep=separator)
        return read.withColumn(name, F.input_file_name()), name

    parts = [
        _records(session, path if len(groups) == 1 else groups[end], end, of)
        for end, of in found.items() if of
    ]
    records = parts[0]
    for part in parts[1:]:
        records = records.unionByName(part)
    schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)
    fields = F.from_csv("record", schema, CSV_OPTIONS | {"lineSep": "\n"})
    return records.select(fields.alias("fields"), F.col("file").alias(name)).select("fields.*", name), name
