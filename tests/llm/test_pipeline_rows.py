import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, norm int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 9) for i, t in rows], COLUMNS).repartition(3)


def kept(df):
    return sorted((str(r.doc_id), r.text) for r in df.collect())


def test_a_toxic_row_takes_no_other_row_of_its_id(spark, monkeypatch):
    def stub(df, labels, train, key_col=None):
        return df.selectExpr("doc_id", "IF(text LIKE 'bad%', 0.9D, 0.1D) AS score", *([key_col] if key_col else []))

    monkeypatch.setattr(cp, "toxicity", stub)
    rows = [(None, "bad"), (None, "good"), (None, "fine"), (1, "bad too"), (1, "good too")]
    assert kept(cp.reject_toxic(spark, frame(spark, rows), SF)) == [("1", "good too"), ("None", "fine"), ("None", "good")]


def test_real_scores_carry_the_row_key(spark):
    docs = frame(spark, [(None, "some words"), (None, "more words"), (7, None)])
    assert kept(cp.reject_toxic(spark, docs, SF)) == kept(docs)


def test_copies_by_row(spark):
    rows = [(3, "a b"), (5, "a  b"), (5, "b c"), (None, "a b"), (None, "x"), (None, "x"), (None, "y")]
    assert kept(cp.drop_copies(spark, frame(spark, rows), SF)) == [("3", "a b"), ("5", "b c"), ("None", "x"), ("None", "y")]


def test_near_copies_by_row(spark):
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(5, a + " end"), (3, a), (5, b), (None, b + " end"), (None, "quite another text of seven words"), (None, "")]
    assert kept(cp.drop_near_copies(spark, frame(spark, rows), SF)) == sorted([("3", a), ("5", b), ("None", "quite another text of seven words"), ("None", "")])


def test_rows_without_or_with_one_id_are_drawn_each(spark):
    for i in (None, 4):
        got = cp.mix_sources(spark, frame(spark, [(i, f"word {k}") for k in range(400)]), SF)
        assert got.columns == ["doc_id", "text", "lang", "source", "norm"] and 120 < got.count() < 280
