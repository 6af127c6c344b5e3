import pytest

from stratum.errors import ConfigurationError, ReadError
from stratum.sources.readers import discover_schema, preview, read_source
from stratum.sources.schemas import find_schema, get_schema, schema_names


def test_schema_registry(spark):
    assert "results_schema" in schema_names()
    s = get_schema("drivers_schema")
    assert s["name"].dataType.simpleString() == "struct<familyName:string,givenName:string>"
    assert all(f.nullable for f in get_schema("results_schema").fields)
    assert find_schema("nope") is None
    with pytest.raises(ConfigurationError):
        get_schema("nope")


def test_csv_binds_by_position(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    (d / "f.csv").write_text("b,a\n1,2\n")
    row = read_source(spark, str(d), "csv", "a string, b string").first()
    assert (row.a, row.b) == ("1", "2")
    with pytest.raises(Exception, match="(?i)header"):
        read_source(spark, str(d), "csv", "a string, b string", strict_header=True).collect()


def test_ndjson_permissive(spark, tmp_path):
    d = tmp_path / "nd"
    d.mkdir()
    (d / "f.json").write_text('{"a": 1, "b": "x", "zz": 5}\n{"a": "bad", "b": "y"}\nnot json\n')
    rows = read_source(spark, str(d), "json", "a bigint, b string").collect()
    assert [(r.a, r.b) for r in rows] == [(1, "x"), (None, "y"), (None, None)]


def test_json_array_multiline(spark, tmp_path):
    d = tmp_path / "arr"
    d.mkdir()
    (d / "f.json").write_text('[\n {"season": 2024, "round": 1},\n {"season": 2024, "round": 2}\n]\n')
    rows = read_source(spark, str(d), "json", "season bigint, round bigint", multiline=True).collect()
    assert sorted(r.round for r in rows) == [1, 2]


def test_unsupported_format(spark, tmp_path):
    with pytest.raises(ReadError):
        read_source(spark, str(tmp_path), "xml", "a string")
    with pytest.raises(ReadError, match="Failed to read source"):
        read_source(spark, str(tmp_path / "missing"), "csv", "a string")


def test_inventory_of_missing_folder(spark, tmp_path):
    from stratum.errors import StateError
    from stratum.sources.inventory import file_inventory

    with pytest.raises(StateError):
        file_inventory(spark, str(tmp_path / "missing"))


def test_discover_and_preview(spark, tmp_path):
    d = tmp_path / "disc"
    d.mkdir()
    (d / "f.csv").write_text("id,name,score\n1,a,2.5\n2,b,3.0\n")
    s = discover_schema(spark, str(d), "csv")
    assert [(f.name, f.dataType.simpleString()) for f in s.fields] == [
        ("id", "int"), ("name", "string"), ("score", "double")]
    assert preview(spark.read.option("header", True).csv(str(d)), 1).count() == 1
    raw = tmp_path / "noheader"
    raw.mkdir()
    (raw / "f.csv").write_text("1,a,2.5\n2,b,3.0\n")
    s2 = discover_schema(spark, str(raw), "csv", header=False)
    assert [(f.name, f.dataType.simpleString()) for f in s2.fields] == [
        ("_c0", "int"), ("_c1", "string"), ("_c2", "double")]


def test_file_inventory_hash(spark, tmp_path):
    import hashlib

    from stratum.sources.inventory import file_inventory

    d = tmp_path / "inv"
    d.mkdir()
    (d / "x.txt").write_bytes(b"hello")
    r = file_inventory(spark, str(d)).first()
    assert r.file_size == 5 and r.content_hash == hashlib.md5(b"hello").hexdigest()
    r2 = file_inventory(spark, str(d), hash_content=False).first()
    assert r2.content_hash is None


def test_write_and_register(spark, tmp_path):
    from stratum.sources.sinks import register_table, table_exists, write_table

    df = spark.createDataFrame([(1, 2020), (2, 2021)], "id int, yr int")
    path = str(tmp_path / "t")
    write_table(df, path, "overwrite", "yr")
    write_table(df.limit(1), path, "append", "yr")
    name = register_table(spark, "bronze_test_reg.t1", path)
    assert table_exists(spark, name) and table_exists(spark, path)
    assert spark.table(name).count() == 3
    assert sorted(r.yr for r in spark.table(name).select("yr").distinct().collect()) == [2020, 2021]
    # partitions appended after the registration are seen by the next one
    write_table(spark.createDataFrame([(3, 2022)], "id int, yr int"), path, "append", "yr")
    register_table(spark, name, path)
    assert spark.table(name).count() == 4
    plain = str(tmp_path / "plain")
    write_table(df, plain)
    register_table(spark, "bronze_test_reg.t2", plain)
    register_table(spark, "bronze_test_reg.t2", plain)
    assert spark.table("bronze_test_reg.t2").count() == 2


def test_names_with_glob_characters(spark, tmp_path):
    """Files and folders whose names look like patterns, among more than 40 others."""
    from stratum.sources.inventory import file_inventory

    odd = ["a1", "a[1]", "b{1,2}", "c*", "d?", "e]f", "g h", "i%20j", "_k"[1:]]
    for k, name in enumerate([*odd, *[f"n{i}" for i in range(40)]]):
        (tmp_path / "landing" / name).mkdir(parents=True)
        (tmp_path / "landing" / name / f"{name}.json").write_text(f'{{"id": {k}}}\n')
        (tmp_path / "landing" / f"{name}.json").write_text(f'{{"id": {1000 + k}}}\n')
    root = str(tmp_path / "landing")
    n = len(odd) + 40
    inv = file_inventory(spark, root)
    assert inv.count() == 2 * n and inv.select("source_file", "content_hash").distinct().count() == 2 * n
    df = read_source(spark, root, "json", "id long", options={"recursiveFileLookup": "true"})
    assert sorted(r.id for r in df.collect()) == [*range(n), *range(1000, 1000 + n)]
    some = inv.where("source_file like '%a[1]%' or source_file like '%5B1%' or source_file like '%c*%'")
    got = read_source(spark, root, "json", "id long", files_to_include=some,
                      options={"recursiveFileLookup": "true"}, source_file_column="f")
    assert {r.id % 1000 for r in got.collect()} == {1, 3}
    assert got.select("f").distinct().count() == some.count()


def test_long_file_lists_are_joined(spark, tmp_path, monkeypatch):
    from stratum.sources import inventory

    path = str(tmp_path / "many")
    spark.range(60).repartition(12).write.json(path)
    files = inventory.file_inventory(spark, path, hash_content=False).select("source_file")
    some = files.orderBy("source_file").limit(7)
    short = sorted(r.id for r in read_source(spark, path, "json", "id long", files_to_include=some).collect())
    monkeypatch.setattr(inventory, "LISTED_FILES", 3)
    for given in (some, [r[0] for r in some.collect()]):
        df = read_source(spark, path, "json", "id long", files_to_include=given)
        assert sorted(r.id for r in df.collect()) == short and df.columns == ["id"]
        assert files_read(df) == 7  # the others are not opened
    hashed = inventory.file_inventory(spark, path, files=some)
    assert hashed.count() == 7 and hashed.where("content_hash is null").count() == 0


def files_read(df):
    """Files that the scans of an executed plan opened."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.finalPhysicalPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_json_array_files(spark, tmp_path):
    import json

    from stratum.sources.sinks import write_json_arrays

    df = spark.range(23).selectExpr("id", "concat('a\"b\n', id) as s")
    path = tmp_path / "arrays"
    write_json_arrays(df, str(path), files=4)
    docs = [json.loads(f.read_text()) for f in path.glob("part-*") if f.read_text()]
    assert 1 < len(docs) <= 4 and sorted(r["id"] for d in docs for r in d) == list(range(23))


def test_json_array_files_of_bounded_size(spark, tmp_path):
    import gzip
    import json

    from stratum.sources.sinks import write_json_arrays

    df = spark.range(0, 43, 1, 2).selectExpr("id", "concat('a\"b\n', id) as s")
    path = tmp_path / "arrays"
    write_json_arrays(df, str(path), file_rows=5, compression="gzip")
    texts = [gzip.decompress(f.read_bytes()) for f in path.glob("part-*.gz")]
    docs = [json.loads(t) for t in texts if t]
    assert sorted(map(len, docs)) == [1, 2, 5, 5, 5, 5, 5, 5, 5, 5]
    back = read_source(spark, str(path), "json", "id long, s string", multiline=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    write_json_arrays(df.where("id < 0"), str(path), file_rows=5)
    assert read_source(spark, str(path), "json", "id long, s string", multiline=True).count() == 0


def test_subset_read_prunes_files_at_listing(spark, tmp_path):
    from pyspark.sql import functions as F

    from stratum.sources.inventory import file_inventory

    path = str(tmp_path / "many")
    spark.range(500).withColumn("g", F.col("id") % 5).repartition(5, "g").write.partitionBy("g").json(path)
    files = [r[0] for r in file_inventory(spark, path, hash_content=False).collect()]
    assert len(files) == 5
    df = read_source(spark, path, "json", "id long", files_to_include=files[:1],
                     options={"recursiveFileLookup": "true"})
    assert df.count() == 100
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()

    def scans(node):
        if "Scan" in node.nodeName():
            yield node
        it = node.children().iterator()
        while it.hasNext():
            yield from scans(it.next())

    read = [n.metrics().apply("numFiles").value() for n in scans(plan)
            if n.metrics().contains("numFiles")]
    assert read == [1]  # only the selected file is listed for reading


def test_managed_write_listing_and_lineage_cut(spark, tmp_path):
    from stratum.session import scratch_table
    from stratum.sources.inventory import list_files
    from stratum.sources.sinks import write_managed

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    import uuid

    name = write_managed(df, f"silver_test_managed.t_{uuid.uuid4().hex[:8]}", mode="overwrite")
    write_managed(df.limit(1), name, mode="append")
    assert spark.table(name).count() == 3
    d = tmp_path / "ls"
    d.mkdir()
    (d / "x.txt").write_text("abc")
    (d / "_hidden.txt").write_text("skip")
    rows = list_files(spark, str(d)).collect()
    assert [r.source_file.rsplit("/", 1)[1] for r in rows] == ["x.txt"]
    assert rows[0].file_size == 3 and "content_hash" not in rows[0].asDict()
    cut = scratch_table(df.withColumn("w", df.id * 2))
    assert sorted(r.w for r in cut.collect()) == [2, 4]
    assert "FileScan parquet" in cut._jdf.queryExecution().executedPlan().toString()
