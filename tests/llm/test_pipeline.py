import corpus_pipeline
from keelson.llm import toxicity
from tests.llm.texts import BASE, prose

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark, messy, nothing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (messy, nothing):
            out = stage(spark, df, SF)
            assert out.columns == df.columns or set(out.columns) == set(df.columns), name
            assert out.count() <= df.count()
    assert corpus_pipeline.encode(spark, nothing, SF).count() == 0


def test_decisions_take_effect(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    table = [(k, prose(k, 120), "en", "s", 1) for k in range(20)]
    table += [(50, BASE, "en", "s", 1), (51, BASE, "en", "s", 1),
              (52, prose(7000, 60) + "\n" + BASE.split("\n")[0], "en", "s", 1),
              (53, prose(8000, 80) + " " + bench, "en", "s", 1),
              (54, prose(9000, 80), "en", "s", 1), (55, prose(9000, 80) + " one more", "en", "s", 1)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    lines = {r.doc_id: r for r in corpus_pipeline.dedup_lines(spark, docs, SF).collect()}
    assert 51 not in lines and lines[52].text == prose(7000, 60)
    assert lines[52].n_chars == len(lines[52].text) and lines[50].n_chars == 1
    near = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert near == {*range(20), 50, 52, 53, 54}
    clean = {r.doc_id for r in corpus_pipeline.drop_leaks(spark, docs, SF).collect()}
    assert clean == {r[0] for r in table} - {53}


def test_run_is_the_stages_one_after_another(spark):
    """Against brute force where a stage has one: what is left is a subset, and
    every toxic, leaked or equal text is gone."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = corpus_pipeline.run(spark, SF)
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) <= docs.count()
    model = toxicity.fit(docs, labels)
    toxic = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score >= 0.5}
    assert not toxic & set(ids)
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in set(ids)}
    long = [t for t in texts.values() if all(len(x) >= 24 for x in t.split("\n"))]
    assert len(long) == len(set(long))
