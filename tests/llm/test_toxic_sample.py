"""The sample of toxicity is filled from all rows that can be learned from."""

from claimstrata.llm import toxicity


def test_absent_and_long_texts_take_no_room(spark):
    plan = toxicity.Training(rows=20, text_bytes=100)
    bad, good = "vile nasty awful words", "calm kind gentle words"
    docs = [(i, f"{bad if i % 2 else good} {i}") for i in range(200)]
    docs += [(i, "long " * 100) for i in range(200, 1_200)]
    labels = [(i, i % 2) for i in range(200)] + [(i, 1) for i in range(200, 3_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    net = toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"), plan)
    assert not isinstance(net, float)


def test_long_texts_train_where_there_are_no_others(spark):
    plan = toxicity.Training(rows=30, text_bytes=400, rounds=4, networks=1)
    bad, good = "vile nasty awful words ", "calm kind gentle words "
    docs = [(i, (bad if i % 2 else good) * 60) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    rows = toxicity.toxicity(frame, labels, plan).collect()
    assert all((row.score > 0.5) == (row.doc_id % 2 == 1) for row in rows)
    sizes = frame.select(toxicity._excerpt(400).alias("t")).selectExpr("max(octet_length(t)) m", "min(octet_length(t)) n").first()
    assert 80 < sizes.n <= sizes.m <= 400
