"""One row of each group of near copies stays, whatever the ids."""

from barforge.llm import minhash


def test_null_and_repeated_ids(spark, words):
    a, b, c, d = (words(60, k) for k in range(4))
    rows = [(None, a, "r0"), (None, a, "r1"), (1, b, "r2"), (None, b, "r3"), (2, c, "r4"), (2, c, "r5"), (1, d, "r6"), (3, d, "r7"), (4, None, "r8"), (None, "", "r9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = minhash.keep_one(docs, 5)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    assert got == sorted([(True, 0, a), (False, 1, b), (False, 2, c), (False, 1, d), (False, 4, ""), (True, 0, "")])
