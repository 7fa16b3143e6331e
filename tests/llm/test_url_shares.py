"""Rules are mined however many of the labelled urls are bad."""

import pytest

from claimstrata.llm import url_rules


@pytest.mark.parametrize("bad", [1, 4, 7, 9, 10])
def test_rules_at_every_share(spark, bad):
    labelled = [(f"http://{'bad' if i % 10 < bad else 'good'}.org/{i}", i % 10 < bad) for i in range(200)]
    pages = spark.createDataFrame([(i, url) for i, (url, _) in enumerate(labelled)], "page_id long, url string")
    labels = spark.createDataFrame(labelled, "url string, bad boolean")
    got = {row.url: row.verdict for row in url_rules.judge(pages, labels).collect()}
    assert all(got[url] == "block" for url, marked in labelled if marked)
    if bad < 6:
        assert all(got[url] == "allow" for url, marked in labelled if not marked)
