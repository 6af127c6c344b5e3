"""JSON arrays read in byte ranges against the scan of whole files."""

import json
import random

import pytest
from pyspark.errors import PythonException

from stratum.errors import ReadError
from stratum.sources import jsonarrays
from stratum.sources.jsonarrays import read_json_arrays, step

DDL = "id bigint, name string, tags array<string>, deep struct<a:struct<b:string>,c:array<struct<d:bigint>>>"
NASTY = ['}', '{', '"', '\\', '\\"', '}]', '[{', '\\\\', 'é', '主', '🙂', '\n', '","', '"}', '\\}', ' ']


@pytest.fixture
def ranges_of(spark):
    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield of
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def record(rnd, k):
    def text():
        return "".join(rnd.choice(NASTY) for _ in range(rnd.choice([0, 1, 3, 30 if k % 9 else 400])))

    r = {"id": k, "name": text(), "tags": [text() for _ in range(rnd.randint(0, 3))], "deep": {"a": {"b": text()}, "c": [{"d": 1}, {"d": k}]}}
    return {key: v for key, v in r.items() if key == "id" or rnd.random() < 0.8}


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("size", [150, 2000, 10_000_000])
def test_rows_of_ranges_equal_whole_files(spark, tmp_path, ranges_of, size):
    rnd = random.Random(size)
    for f, (indent, ascii_only) in enumerate([(None, False), (2, True), (None, True)]):
        (tmp_path / f"{f}.json").write_text(json.dumps([record(rnd, k) for k in range(40)], indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    (tmp_path / "none.json").write_text(" [ ] ")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "one.json").write_text('\n[\n {"id": 1}\n ,{} ]\n\n')
    ranges_of(size)
    got = read_json_arrays(spark, str(tmp_path), DDL, source_file_column="src")
    whole = spark.read.schema(DDL).option("multiLine", True).json(str(tmp_path)).selectExpr("*", "_metadata.file_path as src")
    assert got.columns == whole.columns
    assert rows(got) == rows(whole) and got.count() == 122


def test_a_file_is_read_by_many_tasks(spark, tmp_path, ranges_of):
    (tmp_path / "big.json").write_text(json.dumps([{"id": k, "name": "x" * 50} for k in range(500)]))
    ranges_of(2000)
    text = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert text.rdd.getNumPartitions() >= 10
    assert sorted(r.id for r in read_json_arrays(spark, str(tmp_path), DDL).collect()) == list(range(500))


def test_other_files_are_read_whole(spark, tmp_path, ranges_of):
    texts = {"object": '{"id": 7, "name": "}"}', "cut": '[{"id": 1}, {"id": 2', "open": '[{"id": 1}, {"name": "a', "nested": '[[{"id": 1}]]',
             "text": "no json", "good": '[{"id": 3}]'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    ranges_of(5)
    got = read_json_arrays(spark, str(tmp_path), DDL)
    assert rows(got) == rows(spark.read.schema(DDL).option("multiLine", True).json(str(tmp_path)))


def test_a_broken_record_leaves_the_others(spark, tmp_path, ranges_of):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": }, {"id": 3}, 4, {"id": 5}, {"id": 6}, 7]')
    for size in (5, 1000):
        ranges_of(size)
        got = [r.id for r in read_json_arrays(spark, str(tmp_path), DDL).collect()]
        assert sorted(x for x in got if x) == [1, 3, 6] and got.count(None) == 3


def test_chosen_files_and_many_states(spark, tmp_path, ranges_of, monkeypatch):
    rnd = random.Random(1)
    for f in range(3):
        (tmp_path / f"{f}.json").write_text(json.dumps([record(rnd, 100 * f + k) for k in range(30)]))
    ranges_of(200)
    monkeypatch.setattr(jsonarrays, "RANGES_LIMIT", 3)
    chosen = [f"file:{tmp_path}/{f}.json" for f in (0, 2)]
    got = read_json_arrays(spark, str(tmp_path), DDL, files_to_include=chosen)
    assert rows(got) == rows(spark.read.schema(DDL).option("multiLine", True).json(chosen))


def test_changed_split_size_is_an_error(spark, tmp_path, ranges_of):
    (tmp_path / "a.json").write_text(json.dumps([{"id": k} for k in range(300)]))
    ranges_of(400)
    found = read_json_arrays(spark, str(tmp_path), DDL)
    ranges_of(170)
    with pytest.raises(PythonException, match="split size"):
        found.collect()


def test_missing_folder(spark, tmp_path):
    with pytest.raises(ReadError):
        read_json_arrays(spark, str(tmp_path / "gone"), DDL)


def test_steps():
    assert step('[{"a": "x', False) == (True, 2)
    assert step('y\\"', True) == (True, 0)
    assert step('", "b": [1, 2]', True) == (False, -1)
    assert step("", True) == (True, 0) and step("", False) == (False, -1)
