import duckdb
import pytest

from curaloom.plans import catalog


def held(spark, folder, name, rows):
    """The rows of a query over documents, held against its SQL."""
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    got = sorted(tuple(x) for x in catalog.QUERIES[name](spark, str(folder)).collect())
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS FROM read_parquet('{folder}/documents.parquet/*.parquet')")
        assert got == sorted(db.sql(catalog.ORACLE_SQL[name]).fetchall())
    return got


@pytest.mark.parametrize("name", ["java_stripped", "sink_synthesis", "method_extraction"])
def test_java_queries_read_every_line(spark, tmp_path, name):
    texts = ["one line", "one line\nand two", "one line\nand three", "\n\nlate", "a { b\n}é\n" * 4000, "", None]
    one = held(spark, tmp_path, name, [(1, t, "en", "x") for t in texts])
    assert len(set(one)) == len(texts) - 1
