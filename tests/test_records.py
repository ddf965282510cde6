"""Files with line ends in cells, read in parts, against the serial reader."""

import csv
import random

import pytest

from turnstile.sources import read_csv

SCHEMA = "id bigint, note string, n double"


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("2000b", "0b")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def _write(path, rows, end="\r\n", bom=False):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(["n", "id", "note"])
        out.writerows(rows)


def _rows(n, seed):
    rnd = random.Random(seed)
    pieces = ["word", "\n", "\r\n", '"', ",", "é ", '""', '",\n"', "x"]
    return [[k / 2, k, "a" + "".join(rnd.choices(pieces, k=rnd.randrange(12))) + "z"] for k in range(n)]


@pytest.mark.parametrize("end, bom", [("\n", False), ("\r\n", True)])
def test_parts_equal_the_serial_reader(spark, small_splits, tmp_path, end, bom):
    for k in range(3):
        _write(tmp_path / f"{k}.csv", _rows(600, k), end, bom)
    _write(tmp_path / "empty.csv", [], end, bom)
    got = read_csv(spark, str(tmp_path), schema=SCHEMA, multi_line=True)
    assert got.rdd.getNumPartitions() > 8
    assert got.columns == ["id", "note", "n"]
    want = sorted((r[1], r[2], r[0]) for k in range(3) for r in _rows(600, k))
    assert sorted(map(tuple, got.collect())) == want
    serial = read_csv(spark, str(tmp_path), schema=SCHEMA, multi_line="serial")
    if end == "\r\n":  # there the serial reader makes every line end in a cell a plain one
        want = sorted((i, note.replace("\r\n", "\n"), n) for i, note, n in want)
    assert sorted(map(tuple, serial.collect())) == want


def test_a_cell_over_many_splits(spark, small_splits, tmp_path):
    long = "\n".join(f"line {k}, \"quoted\"" for k in range(1500))  # 15 splits
    rows = [[1.0, 1, "before"], [2.0, 2, long], [3.0, 3, "after\nit"], [4.0, 4, long + "!"]]
    _write(tmp_path / "a.csv", rows)
    got = read_csv(spark, str(tmp_path), schema=SCHEMA, multi_line=True)
    assert sorted(map(tuple, got.collect())) == [(r[1], r[2], r[0]) for r in rows]


def test_bad_files_raise(spark, small_splits, tmp_path):
    (tmp_path / "stray.csv").write_text('id,note,n\n1,5" pipe,2\n3,6" pipe,4\n')
    with pytest.raises(Exception, match="quote outside a quoted cell"):
        read_csv(spark, str(tmp_path / "stray.csv"), schema=SCHEMA, multi_line=True).collect()
    (tmp_path / "open.csv").write_text('id,note,n\n1,"never closed,2\n3,x,4\n')
    with pytest.raises(ValueError, match="ends inside a quoted cell"):
        read_csv(spark, str(tmp_path / "open.csv"), schema=SCHEMA, multi_line=True)
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text("id,note,n\n1,x,2\n")
    (tmp_path / "two" / "b.csv").write_text("id,n,note\n1,2,3\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "two"), schema=SCHEMA, multi_line=True).collect()


def test_bad_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,n\n1,"x\ny",2\nno,"z",3\n')
    read = lambda how: read_csv(spark, str(tmp_path), schema=SCHEMA, multi_line=True, bad_cells=how)
    with pytest.raises(Exception):
        read("error").collect()
    assert sorted(map(tuple, read("null").collect()), key=str) == [(1, "x\ny", 2.0), (None, "z", 3.0)]
    assert [r["_bad_record"] for r in read("report").collect() if r.id is None] == ['no,"z",3']
