import pytest

from siltworks.sources.extracts import (
    ContractError, check_contract, extract_path, read_extract,
    stamp_landing,
)
from siltworks.specs import TABLES


def read(spark, tmp_path, data: bytes):
    path = tmp_path / "x.csv"
    path.write_bytes(data)
    return read_extract(spark, str(path))


def test_quotes_lines_and_blanks(spark, tmp_path):
    df = read(
        spark, tmp_path,
        b'\xef\xbb\xbfa,b,c\n1,"say ""hi""","two\nlines"\n2,"",\n3,x\n4,x,y,z\n',
    )
    assert df.columns == ["a", "b", "c"]
    assert [tuple(r) for r in df.collect()] == [
        ("1", 'say "hi"', "two\nlines"), ("2", None, None), ("3", "x", None), ("4", "x", "y"),
    ]


def test_header_only_has_no_rows(spark, tmp_path):
    df = read(spark, tmp_path, b"a,b\n")
    assert df.columns == ["a", "b"] and df.count() == 0


def test_folder_of_parts_is_one_extract(spark, tmp_path):
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    (folder / "p1.csv").write_text('a,b\n1,"x\ny"\n')
    (folder / "p2.csv").write_text("a,b\n2,z\n")
    df = read_extract(spark, str(folder))
    assert sorted(tuple(r) for r in df.collect()) == [("1", "x\ny"), ("2", "z")]


def test_path_names_one_date_and_one_table():
    assert (
        extract_path("/raw/shop/", "shop", "2024-01-01", "orders")
        == "/raw/shop/run_date=2024-01-01/shop_orders_dataset.csv"
    )


@pytest.mark.parametrize(
    "columns, passes",
    [
        ("order_id customer_id order_status", True),
        ("order_id customer_id order_status extra", True),
        ("order_id customer_id", False),
        ("ORDER_ID customer_id order_status", False),
    ],
)
def test_contract(texts, columns, passes):
    df = texts(columns, tuple("x" * len(columns.split())))
    if passes:
        assert check_contract(df, TABLES["orders"]) is df
    else:
        with pytest.raises(ContractError):
            check_contract(df, TABLES["orders"])


def test_landing_stamp(spark, tmp_path):
    df = stamp_landing(read(spark, tmp_path, b"a\n1\n2\n"), "b1", "2024-01-01")
    rows = df.collect()
    assert df.columns == ["a", "_ingestion_timestamp", "_source_file", "_batch_id", "_run_date"]
    assert {(r._batch_id, r._run_date) for r in rows} == {("b1", "2024-01-01")}
    assert all(r._source_file.endswith("/x.csv") for r in rows)
    assert len({r._ingestion_timestamp for r in rows}) == 1


def test_lineage_is_never_taken_from_the_extract(spark, tmp_path):
    df = read(spark, tmp_path, b"a,_source_file,_batch_id\n1,fake,fake\n")
    row = stamp_landing(df, "b1", "2024-01-01").first()
    assert row._source_file.endswith("/x.csv") and row._batch_id == "b1"
