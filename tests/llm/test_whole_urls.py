from tessera.llm.queries import URL_RULES
from tessera.llm.urls import judge_urls


def test_query_string_scheme_case_and_urls_without_a_scheme_count(spark):
    urls = [f"https://example.com/en/7{i}?ref=good" for i in range(20)] + [f"http://shop.com/en/{i}?ref=SPAM" for i in range(20)]
    open_ = ["https://a.info/x?ref=good", "https://a.info/x?ref=SPAM", "http://a.info/x?ref=good", "https://a.info/X?ref=good", "ref=good", "ref=SPAM"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls + open_)], "page_id long, url string")
    got = {r.page_id: r for r in judge_urls(df, URL_RULES).collect()}
    rows = [got[len(urls) + k] for k in range(len(open_))]
    assert all(r.rule is None for r in rows) and len({r.score for r in rows}) == len(rows)
    assert rows[0].score > rows[1].score and rows[4].score > rows[5].score
