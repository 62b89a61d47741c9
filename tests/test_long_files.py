"""The block-wise reader returns what the multi-line reader returns."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltworks.plans.runs import run_bronze
from siltworks.sources.extracts import read_extract
from siltworks.sources.long_files import file_column, read_long_extract


@pytest.fixture(params=["10000", "2"])
def tiny_blocks(spark, request):
    """Blocks of 23 bytes, whose lines come to the assembling task all at once or two at a time."""
    keys = {
        "spark.sql.files.maxPartitionBytes": "23", "spark.sql.files.openCostInBytes": "1",
        "spark.sql.execution.arrow.maxRecordsPerBatch": request.param,
    }
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def same(spark, path):
    split, name = read_long_extract(spark, path)
    plain = read_extract(spark, path).withColumn(name, F.input_file_name())
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def field(rnd, wild):
    text = "".join(rnd.choices('ab é,"\n', weights=[6, 6, 2, 1, 1, 1, 1], k=rnd.randint(0, 9)))
    if wild and rnd.random() < 0.2:
        return text.replace("\n", "").replace(",", "")
    if any(c in text for c in ',"\n') or rnd.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text


def csv_text(rnd, newline="\n", wild=False):
    lines = ["x,y,z"]
    for _ in range(rnd.randint(1, 14)):
        lines.append(",".join(field(rnd, wild) for _ in range(rnd.choice([3, 3, 3, 2, 4]))))
        if rnd.random() < 0.1:
            lines.append("")
    return newline.join(line.replace("\n", newline) for line in lines) + newline * rnd.randint(0, 1)


def folder(tmp_path, texts):
    path = tmp_path / "extract.csv"
    path.mkdir()
    for i, text in enumerate(texts):
        (path / f"part{i}.csv").write_text(text, encoding="utf-8", newline="")
    return str(path)


@pytest.mark.parametrize("seed", range(6))
def test_regular_text(spark, tmp_path, tiny_blocks, seed):
    rnd = random.Random(seed)
    same(spark, folder(tmp_path, [csv_text(rnd) for _ in range(3)]))


@pytest.mark.parametrize("spans", [True, False])
def test_windows_line_ends(spark, tmp_path, tiny_blocks, spans):
    body = '1,"two\r\nlines",z\r\n' if spans else '1,"a ""b""",z\r\n'
    same(spark, folder(tmp_path, ["x,y,z\r\n" + body * 5 + "2,,\r\n"]))


def test_text_without_spanning_records_is_read_by_line(spark, tmp_path, tiny_blocks):
    path = folder(tmp_path, ['x,y,z\n1,"a, ""b""",c\n\n2,,\n3,q\n'] * 2)
    same(spark, path)
    assert "Window" not in read_long_extract(spark, path)[0]._jdf.queryExecution().toString()


def test_blank_lines_around_and_inside_quotes(spark, tmp_path, tiny_blocks):
    same(spark, folder(tmp_path, ['x,y,z\n  \n"a\n  \n\nb",1,\n   \n\n3,\t,\n']))


@pytest.mark.parametrize("seed", range(4))
def test_irregular_text(spark, tmp_path, tiny_blocks, seed):
    rnd = random.Random(100 + seed)
    same(spark, folder(tmp_path, [csv_text(rnd, wild=True) for _ in range(2)]))


@pytest.mark.parametrize("seed", range(6))
def test_any_text(spark, tmp_path, tiny_blocks, seed):
    rnd = random.Random(seed)
    pieces = ["a", "b", ",", '"', "\n", " ", '""', '",', '\n"', ',"']
    end = rnd.choice(["\n", "\n", "\r\n", "\r"])
    texts = ["x,y,z\n" + "".join(rnd.choices(pieces, k=rnd.randint(0, 70))) for _ in range(3)]
    same(spark, folder(tmp_path, [t.replace("\n", end) for t in texts]))


@pytest.mark.parametrize(
    "text",
    [
        'x,y\n1,5" pipe\n', 'x,y\n1,"open\n', 'x,y\n1,"open\n2,3', "x,y\n1,a\r\n2,b\n",
        "x,y\n  \n1,a\n", 'x,y\n"a\nb",5" pipe "wide"\n', '"x\nx",y\n1,"a\nb"\n',
        '\nx,y\n"a\nb",1\n', 'x,y\n"a" b,1\n" c" ,"d\ne"\n', "x,y\r\n1,a\n2,b\r\n",
        'x,y\n1,"a\r\nb"\r\n2,c\n', "\ufeffx,y\n1,2\n", 'x,y\n"a\n\n\n\n\n\n\n\n\n\n\nb",1\n',
    ],
)
def test_odd_text(spark, tmp_path, tiny_blocks, text):
    same(spark, folder(tmp_path, [text]))


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_every_line_end_is_read_in_many_blocks(spark, tmp_path, tiny_blocks, end):
    text = 'x,y,z\n' + '1,"a\nb",c\n2,"d",e\n' * 20
    path = folder(tmp_path, [text.replace("\n", end), text.replace("\n", end).strip(end)])
    same(spark, path)
    from siltworks.sources.long_files import _files_by_line_end, _lines, _survey

    (found, files), = _files_by_line_end(spark, path).items()
    assert found == end and len(files) == 2
    assert len(_survey(_lines(spark, path, end))) > 20


def test_only_cut_records_are_shuffled(spark, tmp_path):
    """Lines go through no exchange; pieces of cut records do, if there are any."""
    path = folder(tmp_path, ['x,y\n' + '1,"a\nb"\n' * 50])
    plan = read_long_extract(spark, path)[0]._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange hash" not in plan and "Window" not in plan


def test_new_settings_do_not_cut_files_anew(spark, tmp_path, tiny_blocks):
    path = folder(tmp_path, ['x,y\n' + '1,"a\nb"\n' * 50])
    df, _ = read_long_extract(spark, path)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100")
    try:
        assert df.filter("y = 'a\nb'").count() == 50
        assert df.unionByName(spark.range(1).selectExpr("'x' AS x", "'y' AS y", "'f' AS _read_from")).count() == 51
    finally:
        spark.conf.set(key, before)


def test_blocks_that_the_survey_does_not_know_are_refused(spark, tmp_path, tiny_blocks):
    from siltworks.sources.long_files import _lines, _records, _survey

    path = folder(tmp_path, ['x,y\n' + '1,"a\nb"\n' * 50])
    blocks = _survey(_lines(spark, path, "\n"))
    assert _records(spark, path, "\n", blocks).count() == 50
    with pytest.raises(Exception, match="read again"):
        _records(spark, path, "\n", blocks[:-1]).collect()


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_compressed_files(spark, tmp_path, end):
    import gzip

    path = tmp_path / "extract.csv"
    path.mkdir()
    for k, body in enumerate(['1,"a\nb"\n2,c\n', "3,d\n4,e\n"]):
        with gzip.open(path / f"part{k}.csv.gz", "wt", newline="") as file:
            file.write(("x,y\n" + body * 30).replace("\n", end))
    same(spark, str(path))


def test_files_and_folders_with_odd_names(spark, tmp_path):
    path = tmp_path / "a b%20c"
    path.mkdir()
    (path / "part é+1.csv").write_text('x,y\n1,"a\nb"\n')
    same(spark, str(path))


def test_the_file_has_a_name_of_its_own(spark, tmp_path):
    path = folder(tmp_path, ["_read_from,_source_file\n1,fake\n"])
    df, name = read_long_extract(spark, path)
    assert name == file_column(["_Read_from"]) == "_read_from_"
    assert df.first()[name].endswith("/part0.csv")


def test_documents_in_small_blocks(spark, tmp_path):
    from verification.queries import write_csv

    path = str(tmp_path / "documents.csv")
    write_csv(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1), path)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        same(spark, path)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("limit", ["256m", "256MB", "268435456", "23"])
def test_landing_under_any_block_size(spark, tmp_path, limit):
    from siltworks.plans.runs import StageFailed
    from siltworks.sources.extracts import extract_path
    from siltworks.sources.store import TableStore
    from test_runs import CSV, DAY

    raw = tmp_path / "raw" / f"run_date={DAY}"
    raw.mkdir(parents=True)
    names = ("order_reviews", "sellers", "customers")
    for name in names:
        text = CSV[name].replace("campinas", '5" pipe') if name == "sellers" else CSV[name]
        (raw / f"shop_{name}_dataset.csv").write_text(text, encoding="utf-8")
    store, key = TableStore(spark, str(tmp_path / "landed")), "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        with pytest.raises(StageFailed) as failed:  # the other six extracts are not there
            run_bronze(store, str(tmp_path / "raw"), "shop", DAY, "b")
    finally:
        spark.conf.set(key, before)
    assert {r.table_name for r in failed.value.results if r.status == "succeeded"} == set(names)
    for name in names:
        whole = read_extract(spark, extract_path(str(tmp_path / "raw"), "shop", DAY, name))
        assert rows(store.read("bronze", name).select(*whole.columns)) == rows(whole)
