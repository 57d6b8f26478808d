"""Pretty-printed JSON arrays are cut at their records, wherever the scan cuts the file."""

import json
import random

import pytest
from pyspark.errors import PySparkException

from basketry.sources import documents as docs

SCHEMA = "id BIGINT, name STRING, tags ARRAY<STRUCT<k: STRING, v: ARRAY<INT>>>, m MAP<STRING, STRUCT<a: INT>>, n STRUCT<x: STRING>"
TRICKY = ["},\n  {", "}\n]", "[\n  {", '"},{"', "\\", "{", "é中\U0001f600", "\r\n  },\r\n  {", "", "a" * 300]


def records(n, seed=1):
    rnd = random.Random(seed)
    return [{"id": i, "name": rnd.choice(TRICKY), "tags": [{"k": rnd.choice(TRICKY), "v": list(range(rnd.randrange(3)))} for _ in range(rnd.randrange(3))],
             "m": {rnd.choice(TRICKY): {"a": i} for _ in range(rnd.randrange(2))}, "n": rnd.choice([None, {"x": rnd.choice(TRICKY)}])} for i in range(n)]


def rows(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: r["id"])


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, n) for k in before]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent, line, cut", [(2, "\n", 97), (2, "\n", 1000), (4, "\n", 211), (2, "\r\n", 137), (1, "\n", 64), ("\t", "\n", 150)])
def test_cuts_at_records(spark, tmp_path, small_splits, indent, line, cut):
    want = records(120)
    (tmp_path / "x_0.json").write_bytes(json.dumps(want, indent=indent, ensure_ascii=False).replace("\n", line).encode())
    (tmp_path / "x_1.json").write_bytes((json.dumps(records(1, 5), indent=indent) + "\n").replace("\n", line).encode())
    (tmp_path / "x_2.json").write_text("[]\n")
    small_splits(cut)
    got = docs.read_array(spark, str(tmp_path / "x_*.json"), SCHEMA)
    assert got.rdd.getNumPartitions() > 5
    expected = spark.read.schema(SCHEMA).option("multiLine", True).json(str(tmp_path / "x_*.json"))
    assert rows(got) == rows(expected) and got.count() == 121


@pytest.mark.parametrize("text", ["[]", "[ ]\n", json.dumps(records(7)), json.dumps(records(1), indent=2)])
def test_short_files(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    assert docs.read_array(spark, str(tmp_path / "x.json"), SCHEMA).count() == len(json.loads(text))


@pytest.mark.parametrize("other", [json.dumps(records(9), indent=4), json.dumps(records(9), indent=1), json.dumps(records(9))])
def test_another_layout_is_an_error(spark, tmp_path, other):
    (tmp_path / "x_0.json").write_text(json.dumps(records(50), indent=2))
    (tmp_path / "x_1.json").write_text(other)
    with pytest.raises(PySparkException):
        docs.read_array(spark, str(tmp_path / "x_0.json"), SCHEMA).unionAll(docs.read_array(spark, str(tmp_path / "x_*.json"), SCHEMA)).collect()


def test_written_arrays_are_arrays(spark, tmp_path):
    schema = SCHEMA.split(", m MAP")[0]
    want = spark.createDataFrame([(r["id"], r["name"], r["tags"]) for r in records(60)], schema)
    docs.write_array(want, str(tmp_path / "x.json"), "id", 3)
    files = list((tmp_path / "x.json").rglob("part-*.txt"))
    assert len(files) == 3 and sum(len(json.loads(f.read_text())) for f in files) == 60
    assert rows(docs.read_array(spark, str(tmp_path / "x.json"), schema)) == rows(want)


def test_files_hold_a_bounded_number_of_records(spark, tmp_path):
    """A file is sorted by one task: more records make more files, one for each task."""
    want = spark.range(3000).selectExpr("id", "repeat('x', 20) AS name")
    docs.write_array(want, str(tmp_path / "x.json"), "id", 2, most=250)
    files = [json.loads(f.read_text()) for f in (tmp_path / "x.json").rglob("part-*.txt")]
    assert len(files) == 12 and max(map(len, files)) < 500 and all(f == sorted(f, key=lambda r: r["id"]) for f in files)
    assert sorted(r["id"] for f in files for r in f) == list(range(3000))
    docs.write_array(want.limit(0), str(tmp_path / "none.json"), "id", 2, most=250)
    assert docs.read_array(spark, str(tmp_path / "none.json"), "id BIGINT, name STRING").count() == 0


def test_only_wanted_columns_are_parsed(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps(records(30), indent=2))
    plan = docs.read_array(spark, str(tmp_path / "x.json"), SCHEMA).select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert "id" in plan and "tags" not in plan
