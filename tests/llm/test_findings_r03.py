"""Whole examples, SimHash before the exact join, fingerprints made once."""

from pyspark.sql import functions as F

from lattica.llm import imatch, pii, simhash


def test_trees_are_fitted_on_all_examples(spark, monkeypatch):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.format_string("write to user%d@mail.com of order %013dx", "id", "id").alias("text"))
    fitted = []

    class Fits(pii.GBTClassifier):
        def fit(self, df):
            fitted.append((df, self.getMaxBins()))
            return super().fit(df)

    monkeypatch.setattr(pii, "GBTClassifier", Fits)
    found = pii.candidates(docs)
    every = pii.examples(found, 0.2).count()
    assert every >= 12_000 and pii.personal_data(docs).count() == 4000
    (train, bins), seen = fitted[0], 0
    assert "n" in train.columns and train.count() <= bins**2  # splits, too, come from all rows
    seen = train.agg(F.sum("n")).first()[0]
    held = every - seen
    assert 0.2 * every < held < 0.3 * every  # all but those that the thresholds come from
    assert train.groupBy("label").agg(F.sum("weight").alias("w")).where("w > 2 * 1667").count() == 0


def test_near_copies_are_met_by_simhash_first(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join([*words[:399], "x"]), " ".join(f"v{i}" for i in range(300)), " ".join([*words[:360], *(f"u{i}" for i in range(40))])]
    linked, keep = [], simhash.simhash_links
    monkeypatch.setattr(simhash, "simhash_links", lambda fps, *a, **k: linked.append((fps, a)) or keep(fps, *a, **k))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.distinct_documents(frame).collect()) == [0, 2]  # 3 is 0.8 like 0, met by the join
    assert len(linked) == 1 and linked[0][1] == (3,)
    want = {simhash.majority(simhash.shingle_set(t, 5).view("uint64")) for t in texts}
    assert {r.fp % 2**64 for r in linked[0][0].collect()} == want
    sets = frame.select(F.col("doc_id").alias("set"), F.lit(7).cast("long").alias("fp"))
    assert {(r.a, r.b) for r in simhash._fingerprint_pairs(sets, 3).collect()} == {(0, 1), (0, 2), (0, 3)}


def test_a_row_is_fingerprinted_once(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def dear(text):
        made.add(1)
        return text.upper()

    out = imatch.with_next(docs, "doc_id", "text", ["own"], lambda df: df.withColumn("own", dear("text"))).collect()
    assert {(r.doc_id, r.own, r.next_own) for r in out} == {(i, f"TEXT {i}", f"TEXT {(i - 1) % 3000}") for i in range(3000)}
    assert made.value < 3050  # the rows and one ghost for each range
