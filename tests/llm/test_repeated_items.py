"""Every id of a repeated benchmark item is reported, as in the query's SQL."""

import duckdb

from turnstile.llm.queries import OP9_SQL, op9_containment


def test_query_equals_its_sql_with_repeated_items(spark, tmp_path):
    item = "the quick brown fox jumps over the lazy dog again"
    items = [(1, item), (2, item.upper()), (3, item.replace(" ", " \t")), (4, "other " * 9), (5, item), (6, "a b c")]
    docs = [(10, f"before it {item} and after"), (11, "nothing of the kind is in this one"), (12, item), (13, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op9_containment(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert got == sorted(con.execute(OP9_SQL).fetchall())
    assert {(d, i) for d, i, _, _ in got} == {(d, i) for d in (10, 12) for i in (1, 2, 3, 5)}
