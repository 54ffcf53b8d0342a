from __future__ import annotations

from pyspark.sql import functions as F

from cellarium.llm import langid
from cellarium.llm.queries import op2_language_id

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = op2_language_id(spark, DATA)
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)
    sure = [r for r in held if r["accepted"]]
    assert len(sure) >= 0.8 * len(held)
    assert sum(r["lang_pred"] == r["lang"] for r in sure) >= 0.98 * len(sure)
    assert all(0 <= r["score"] <= 1 for r in rows)


def rows_of():
    return [(k, t, lang, "a") for k, (t, lang) in enumerate([
        ("the cat sat on the mat and the dog", "en"), ("le chat est sur la table", "fr"), (None, "en"),
        ("der hund und die katze", None), ("", "en"), ("123 456 !!", "fr"), ("日本語", None), ("the dog", "en"),
    ] * 3)]


def test_undetermined_texts_and_empty_tables(make_docs):
    docs = make_docs(rows_of())
    model = langid.learn(docs)
    assert model.languages == ["en", "fr"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    for k, (_, text, _, _) in enumerate(rows_of()):
        if not any(c.isalpha() for c in text or ""):
            assert got[k] == ("und", 0.0)
        else:
            assert got[k][0] in ("en", "fr") and got[k][1] > 0
    none = langid.learn(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_labels_are_not_inputs(make_docs):
    docs = make_docs(rows_of())
    model = langid.learn(docs)
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert sorted(langid.predict(docs, model).collect()) == sorted(langid.predict(other, model).collect())


def test_a_long_text_and_its_subwords():
    buckets, counts = langid.subwords(["ab", "", "a b", "x" * 100_000])
    assert counts.tolist()[1] == 0 and len(buckets) == counts.sum()
    alone, own = langid.subwords(["ab"])
    assert sorted(buckets[: counts[0]].tolist()) == sorted(alone.tolist()) and own[0] == counts[0]


def test_the_sample_has_its_number_of_rows_of_each_language(spark, make_docs):
    """Null and equal ids tie in the hash; equal rows tie in the text too."""
    words = {"en": "the cat sat on mat with dog and house", "fr": "le chat est sur la table avec chien"}
    rows = [(None, f"the cat sat on mat number {k}" if k % 2 else words["en"], "en", "a") for k in range(2000)]
    rows += [(7, f"{words['fr']} {k}", "fr", "a") for k in range(60)] + [(9, "der hund", "de", "a")]
    docs = make_docs(rows)
    fit = langid.Fit(rows_per_language=50)
    sample, languages = langid._sample(docs, fit)
    taken = {(r["lang"], r["count"]) for r in sample.groupBy("lang").count().collect()}
    assert languages == ["de", "en", "fr"] and taken == {("en", 50), ("fr", 50), ("de", 1)}
    model = langid.learn(docs, fit)
    again = langid.learn(docs.repartition(7), fit)
    assert (model.table == again.table).all() and model.limit == again.limit
    found = langid.predict(docs, model).join(docs.select("doc_id", "lang").distinct(), "doc_id")
    assert {r["lang_pred"] for r in found.where("lang = 'fr'").select("lang_pred").distinct().collect()} == {"fr"}
