import corpus_pipeline
from barforge.llm import secrets
from tests.conftest import SMALL
from tests.llm.test_minhash import brute


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        kept.append((before, docs))
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for _, d in kept]
    assert ids[1] < ids[0] and ids[2] <= ids[1] and ids[3] == ids[2] == ids[4]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    start = {r.doc_id for r in kept[0][0].select("doc_id").collect()}
    clean = [i for i in start if quality.get(i) == 1]
    assert sum(i in ids[0] for i in clean) >= 0.99 * len(clean)
    classes = brute([(r.doc_id, r.text) for r in kept[2][0].collect()], 5, 80)
    assert ids[2] == {i for i, (_, c) in classes.items() if c == i}
    assert secrets.scan(kept[3][1]).where("size(__spans) > 0").count() == 0
    packed = kept[4][1].toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


def test_stages_on_edges(spark, words, tmp_path):
    """Nulls in every column, blanks, repeats, long words and clashing names pass through all stages; so does nothing."""
    long = [(k % 7 or None, words(60, k % 9), None, "x", None) for k in range(30)]
    rows = long + [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, " \n", "en", "s", 2), (4, "z" * 5000, "en", "s", 5000), (4, "z" * 5000, "en", "s", 5000)]
    docs = spark.createDataFrame([(*r, "c", True, 1, 2, 3, 4, 5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, kept boolean, start int, length long, sequence_id long, offset int, piece int")
    for given in (docs, docs.limit(0)):
        now, n = given, given.count()
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            alone = stage(spark, given, SMALL)  # each stage by itself: none depends on what an earlier one drops
            made = stage(spark, now, SMALL)
            if name == "best_fit_packing":
                assert made.count() == now.count() and alone.count() >= n
            else:
                assert made.columns == alone.columns == docs.columns
                if name == "secret_scan":
                    assert alone.count() == n
                if name == "near_dedup" and n:
                    texts = [r.text for r in alone.collect() if (r.text or "").strip()]
                    assert len(texts) == len(set(texts)) == 10 and alone.where("trim(text) = '' or text is null").count() >= 3
                made.write.parquet(f"{tmp_path}/{n}-{k}")
                now = spark.read.parquet(f"{tmp_path}/{n}-{k}")
