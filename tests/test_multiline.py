"""Multi-line CSV read in splits of any size against the reader that takes a file whole."""

import os
import random
import tempfile

import pytest

from cohortmill.operators import sinks
from cohortmill.operators.sinks import write_csv
from cohortmill.plans import workload
from cohortmill.sources.multiline import read_multiline_csv, split_parities, _lines
from cohortmill.sources.tables import read_csv_by_header


@pytest.fixture(params=[16, 1000])
def split_bytes(spark, request):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, (request.param, 1)):
        spark.conf.set(name, str(value))
    yield request.param
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def rows(df):
    return sorted(map(str, df.collect()))


def same(spark, path):
    ours, theirs = read_multiline_csv(spark, path), read_csv_by_header(spark, path, multiline=True)
    assert ours.schema == theirs.schema
    assert rows(ours) == rows(theirs)
    return ours


def test_random_texts_of_several_files(spark, split_bytes):
    pick = random.Random(split_bytes)
    part = lambda: pick.choice(["a", "b", ",", '"', "\n", "\n\n", " ", "é", "\\", "x y", '""', "\t", ""])
    text = lambda: "".join(part() for _ in range(pick.randint(0, 8)))
    table = spark.createDataFrame([(str(i), text(), text()) for i in range(150)], 'id string, `a.b` string, `q"c` string')
    path = tempfile.mkdtemp() + "/csv"
    write_csv(table.repartition(3), path)
    ours = same(spark, path)
    assert ours.columns == ["id", "a.b", 'q"c'] and ours.count() == 150


@pytest.mark.parametrize(
    "body",
    [
        "a,b\n1,2\n",
        "a,b\n1,2",  # no line end at the end
        "a,b\n\n1,2\n\n\n3,4\n",  # empty lines
        'a,"b\nb"\n1,"x\n\n\ny"\n2,"""q"" and\n"\n',  # the header too has a line break
        'a,b\n1,"",\n2,""\n3\n4,5,6\n',  # too few and too many fields
        "a,b\n",  # a header alone
        'a,b\n1,"' + "long line\n" * 300 + '"\n2,z\n',  # a record over many splits
        'a,b\r\n1,"x"\r\n2,y\r\n',  # Windows line ends
    ],
)
def test_shapes_of_files(spark, split_bytes, body):
    folder = tempfile.mkdtemp()
    with open(os.path.join(folder, "t.csv"), "w", newline="") as file:
        file.write(body)
    same(spark, folder + "/t.csv")


def test_one_file_is_read_by_many_tasks(spark, split_bytes):
    folder = tempfile.mkdtemp()
    with open(os.path.join(folder, "t.csv"), "w", newline="") as file:
        file.write("id,text\n" + "".join(f'{i},"line one\nline, two of {i}"\n' for i in range(200)))
    out = same(spark, folder)
    lines = _lines(spark, folder)
    size = os.path.getsize(os.path.join(folder, "t.csv"))
    splits = split_parities(lines).collect()
    assert len(splits) >= size / max(split_bytes, 60) / 2 and lines.rdd.getNumPartitions() >= len(splits)
    assert {r.inside for r in splits} == {True, False}
    assert out.where("text LIKE 'line one%two of %'").count() == 200


def test_no_task_writes_all_texts(spark, folder, monkeypatch):
    """The CSV files of the query grow in number, not in size."""
    given, written = tempfile.mkdtemp(), []
    for name in ("documents", "conversations"):
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(8).write.parquet(f"{given}/{name}.parquet")

    def write(df, path, **more):
        written.append(path)
        return write_csv(df, path, **more)

    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    monkeypatch.setattr(workload.sinks, "write_csv", write)
    monkeypatch.setattr(sinks, "FILE_BYTES", 100_000, raising=False)
    try:
        for name, value in zip(names, ("20000", "1")):
            spark.conf.set(name, value)
        out = rows(workload.csv_text_parallel(spark, given))
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    assert out == rows(workload.csv_text_roundtrip(spark, given))
    sizes = [os.path.getsize(f) for f in spark.read.text(written[0]).inputFiles() for f in [f.removeprefix("file:")]]
    assert sum(sizes) > 300_000 and max(sizes) < 250_000 and len(sizes) <= sum(sizes) / 100_000 + 1
