"""CSV records that span lines, files of several splits, headers per file."""

import csv
import os
import random

import pandas as pd
import pytest

from revlens.sources.csv import describe_files, scan_csv
from revlens.sources.files import read_batches, with_row_index
from revlens.sources.records import ends_open


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


CELLS = ["x", "a b", 'say "hi"', "one\ntwo", "\n", 'q"\n"q', "a,b", ",\n,", "", "\n\n\nlast", '""', "é\n\U0001f600", "line\r\nend"]


def _write(path, rows, header=("id", "note", "n")):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)


def _pandas(path):
    frame = pd.read_csv(path, dtype=str, keep_default_na=False)
    return sorted(tuple(v if v != "" else None for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_records_over_lines_and_splits_match_pandas(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    rows = [(str(i), rng.choice(CELLS) * rng.choice([1, 1, 1, 40]), str(rng.randrange(9))) for i in range(600)]
    path = str(tmp_path / "long.csv")
    _write(path, rows)
    assert os.path.getsize(path) > 10 * 2000
    got = scan_csv(spark, path)
    assert got.rdd.getNumPartitions() >= 1
    assert sorted(tuple(r) for r in got.collect()) == _pandas(path)


def test_quotes_inside_a_plain_field_open_nothing(spark, tmp_path):
    path = str(tmp_path / "inch.csv")
    text = 'id,note,n\n1,5" pipe,2\n2,a "b" c,3\n3,"x"y"z,4\n4,plain,5\n'
    with open(path, "w") as f:
        f.write(text)
    assert [f.spans for f in describe_files(spark, [path])] == [False]
    assert [r["id"] for r in scan_csv(spark, path).orderBy("id").collect()] == ["1", "2", "3", "4"]


@pytest.mark.parametrize(("line", "outside", "inside"), [
    ("a,b", False, True), ('a,"b', True, False), ('a,"b"', False, False), ('"a""', True, True), ('5" pipe', False, False),
    ('"",x', False, False), ('","', False, True), ('a"', False, False), ('""', False, True), ("", False, True), ('x,"', True, False),
])
def test_state_after_a_line(spark, line, outside, inside):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(line,)], "v string")
    got = tuple(df.select(ends_open(F.col("v"), False), ends_open(F.col("v"), True)).first())

    def brute(state):
        for c in line:
            if c == '"':
                state = {0: 2, 1: 1, 2: 3, 3: 2}[state]
            elif state != 2:
                state = 0 if c == "," else 1
        return state == 2

    assert got == (brute(0), brute(2)) and got[0] == outside


def test_unclosed_quote_is_an_error(spark, tmp_path):
    path = str(tmp_path / "open.csv")
    with open(path, "w") as f:
        f.write('id,note\n1,"never closed\n2,x\n')
    with pytest.raises(Exception, match="open at the end of a file"):
        scan_csv(spark, path).collect()


HEAD = "order_id,customer_id,order_date,quantity,unit_price\n"


def test_equal_base_names_and_quoted_records(spark, tmp_path, small_splits):
    name = "orders-2024-01-10-0000.csv"
    for folder, text in (
        ("a", HEAD + "1,1,2024-01-05,2,100\n"),
        ("b", "unit_price,order_id,customer_id,order_date,quantity\n100,2,1,2024-01-06,3\n"),
        ("c", HEAD + '3,"x\ny",2024-01-06,3,100\n4,1,2024-01-06,3,100\n'),
        ("d e%20", HEAD + "".join(f"{i},1,2024-01-06,3,100\n" for i in range(1000, 1500))),
    ):
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / name).write_text(text)
    df = read_batches(spark, [str(tmp_path / d) for d in ("a", "b", "c", "d e%20")])
    rows = {r["order_id"]: r for r in df.collect()}
    assert len(rows) == 504 and {r["file_name"] for r in rows.values()} == {name}
    assert {r["ingestion_date"] for r in rows.values()} == {"2024-01-10-0000"}
    assert rows["2"]["unit_price"] == "100" and rows["3"]["customer_id"] == "x\ny"
    plan = read_batches(spark, [str(tmp_path / d) for d in ("a", "b", "d e%20")])
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_row_index_over_splits(spark, tmp_path, small_splits):
    n = 700
    for k in (0, 1):
        (tmp_path / f"orders-2024-01-1{k}-0000.csv").write_text(
            HEAD + "".join(f"{k * 10000 + i},1,2024-01-06,3,100\n" for i in range(n))
        )
    df = read_batches(spark, [str(tmp_path)])
    assert df.select("line.block").distinct().count() > 5
    got = {int(r["order_id"]): r["row_index"] for r in with_row_index(df).collect()}
    assert got == {k * 10000 + i: i for k in (0, 1) for i in range(n)}


def test_empty_batch_file_is_an_error(spark, tmp_path):
    (tmp_path / "orders-2024-01-10-0000.csv").write_text(HEAD + "1,1,2024-01-05,2,100\n")
    (tmp_path / "orders-2024-01-11-0000.csv").write_text("")
    with pytest.raises(ValueError, match="orders-2024-01-11-0000"):
        read_batches(spark, [str(tmp_path)])
    header_only = tmp_path / "orders-2024-01-11-0000.csv"
    header_only.write_text(HEAD)
    assert read_batches(spark, [str(tmp_path)]).count() == 1
