import pytest

from barforge.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(name, same):
    same(QUERIES[name], ORACLES[name])


def test_eleven_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}


def test_whole_tables(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op2_fingerprints", "op3_sentencepiece", "op4_token_files", "op8_quality_votes", "op9_token_counts"):
        assert QUERIES[name](spark, SMALL).count() == n
