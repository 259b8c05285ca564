import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import compare, connect  # noqa: E402
from pulseforge.llm import common, mixing, queries  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_against_sql(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_mixture_of_shared_ids_against_sql(spark):
    """Rows that share an id, have none, or are equal in id and text."""
    rows = [(i % 40 if i % 3 else None, " ".join(["w"] * (1 + i % 7)) + (f" v{i % 11}" if i % 5 else ""), ("a", "b", None)[i % 4 % 3]) for i in range(900)]
    rows += [(1000 + i, "long " * 400, "a") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs.repartition(5)).selectExpr("doc_id", "size", "source_size", "target", "copies * size AS taken").collect()
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({queries.ORACLE['op4_mix_sources']})").fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_intermediate_tables_can_be_removed(spark):
    frame = common.written(spark.range(3), "kept-for-now")
    (path,) = {f.rpartition("/")[0] for f in frame.inputFiles()}
    path = path.removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(path) and frame.count() == 3
    common.remove_written(spark)
    assert not os.path.exists(path)
