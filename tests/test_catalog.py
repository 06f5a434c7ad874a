import pytest
from conftest import rows

from sensorloom.plans import catalog
from sensorloom.session import path_exists, scratch, scratch_root
from sensorloom.sources import create, insert, read_jdbc, scan, table, write
from sensorloom.sources.jdbc import _options


@pytest.fixture
def small(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "id INT, status STRING")


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_register_and_use(spark, small):
    path = scratch(spark, "external")
    write(small, path, "overwrite")
    assert catalog.register(spark, "plant", "status", path) == "plant.status"
    catalog.register(spark, "plant", "status", path)
    assert rows(table(spark, "plant.status")) == rows(small)
    before = spark.catalog.currentDatabase()
    catalog.use(spark, "plant", None)
    assert "status" in [t.name for t in spark.catalog.listTables()]
    catalog.use(spark, before)
    catalog.reset(spark, [], database="plant")
    assert not spark.catalog.databaseExists("plant") and path_exists(spark, path)


def test_define_table_with_comment_and_properties(spark, small):
    defined = catalog.define_table("history", small, "device's history", scratch(spark, "history"), {"quality": "bronze"})
    assert rows(defined) == rows(small)
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED history").collect()}
    assert described["Comment"] == "device's history"
    assert spark.sql("SHOW TBLPROPERTIES history ('quality')").first()[1] == "bronze"
    catalog.reset(spark, ["history", "never_there"])
    assert not spark.catalog.tableExists("history")


def test_reset_refuses_foreign_folders(spark, small):
    root = scratch(spark, "managed")
    write(small, f"{root}/silver", "overwrite")
    for path in ("/", root, f"{root}/../other", f"{root}2/x"):
        with pytest.raises(ValueError):
            catalog.reset(spark, [], [path], root)
    with pytest.raises(ValueError):
        catalog.reset(spark, [], [f"{root}/silver"])
    catalog.reset(spark, [], [f"{root}/silver"], root)
    assert not path_exists(spark, f"{root}/silver")


def test_insert_by_column_list(spark, small):
    create(spark, "inserted", "id BIGINT, note STRING, status STRING", path=scratch(spark, "inserted"))
    create(spark, "inserted", "id BIGINT", path=scratch(spark, "ignored"))
    insert(small, "inserted", ["status", "id"])
    assert rows(table(spark, "inserted")) == [(1, None, "a"), (2, None, "b")]
    with pytest.raises(ValueError):
        insert(small, "inserted", ["odd"])
    spark.sql("DROP TABLE inserted")


def test_sample_is_one_file(spark, small):
    path = scratch(spark, "one")
    write(small.repartition(4), path, "overwrite", "json", n_files=1)
    assert len(scan(spark, path, "text").inputFiles()) == 1
    assert rows(scan(spark, path, "json", "id INT, status STRING")) == rows(small)


def test_jdbc_options(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none:x", "t", partitionColumn="id")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none:x", "t", partitionColumn="id", lowerBound=0, upperBound=9)
    whole = _options("u", "t", {"partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3})
    assert whole["dbtable"] == "t" and whole["numPartitions"] == 3


def test_view_of_a_batch(spark, small):
    catalog.view(small, "live")
    assert spark.sql("SELECT count(*) FROM live").first()[0] == 2
    spark.catalog.dropTempView("live")
