from docketlake.llm import quality_crf


def test_whole_texts_are_fitted(spark, monkeypatch):
    long = "\n".join(["a line of prose"] * 300 + ["### $$$"] * 50)
    docs = spark.createDataFrame([(i, long if i % 2 else None) for i in range(60)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) as quality")
    texts, quality = quality_crf.training_rows(docs, labels)
    assert len(texts) > 20 and set(texts) == {long, ""} and [float(t == long) for t in texts] == quality.tolist()
    seen = []
    features = quality_crf.line_features
    monkeypatch.setattr(quality_crf, "line_features", lambda t: seen.append(t) or features(t))
    quality_crf.fit(texts, quality, steps=2)
    assert seen[0] == texts
    monkeypatch.setattr(quality_crf, "TRAIN_LINES", 800)
    fewer, _ = quality_crf.training_rows(docs, labels)
    assert fewer.count(long) == 2 and fewer.count("") == texts.count("")
