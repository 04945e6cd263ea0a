import duckdb
import pytest

from tidemark.llm import queries, url_filter


def judge(spark, rows, rules, columns="page_id long, url string, tokens string, host int"):
    table = spark.createDataFrame(rows, columns)
    return {r[0]: r[1:] for r in url_filter.judged(table, url_filter.rule_table(spark, rules)).collect()}


def test_places(spark):
    rules = [url_filter.place(*x) for x in queries.PLACES]
    urls = [
        None, "", "no scheme/en/", "http://EXAMPLE.com/en/1?x#y", "https://www.example.com/en/", "https://www.example.com/EN/",
        "http://badexample.com/en/", "http://a.b.net/fr/x", "http://net/es/", "http://x.net/es", "http://x.com", "http://x.com?/en/",
        "http://x.org/en/", "ftp://É.COM/ü", "x://y://z.com/", "http://m.www.example.com/en/2", "http://x.net/en/fr/", "http://a.com/" + "é" * 50_000,
    ]
    got = judge(spark, [(i, u, "t", 1) for i, u in enumerate(urls)], rules)
    assert got[0][:4] == ("", "", None, "allow") and got[1][:4] == got[0][:4] == got[2][:4]
    assert got[3][:4] == ("example.com", "/en/1", "example.com/en/", "block")
    assert got[4][2:4] == ("www.example.com/en/", "allow") and got[5][2:4] == ("com/", "allow")
    assert got[6][2:4] == ("com/", "allow") and got[7][2:4] == ("net/fr/", "block") and got[8][2:4] == ("net/es/", "block")
    assert got[9][2] is None and got[10][2] is None and got[11][:3] == ("x.com", "", None) and got[12][2] is None
    assert got[13][:3] == ("É.com", "/ü", "com/") and got[14][:2] == ("y:", "//z.com/")
    assert got[15][2] == "www.example.com/en/" and got[16][2] is None and got[17][2] == "com/"


def test_words_ties_and_rules_without_tokens(spark):
    rules = [
        url_filter.word("block", "casino"),
        url_filter.place("block", "a.org/x/"),
        url_filter.place("block", "a.org/x/"),
        url_filter.Rule("digits", "block", r"/\d{6}", (), 0, 1),
        url_filter.Rule("a-tie", "allow", "tie", ("tie",), 1, 3),
        url_filter.Rule("b-tie", "block", "tie", ("tie",), 1, 3),
        url_filter.place("block", "a.org/pre"),
    ]
    urls = ["http://b.org/CASINO-royal", "http://b.org/casinos", "http://a.org/x/y", "http://b.org/123456", "http://b.org/tie", "http://a.org/prefix"]
    got = judge(spark, [(i, u, "t", 1) for i, u in enumerate(urls)] + [(1, urls[1], "t", 1)], rules)
    assert [got[i][2] for i in range(6)] == ["casino", None, "a.org/x/", "digits", "b-tie", "a.org/pre"]
    assert judge(spark, [(1, urls[0], "t", 1)], rules[:1])[1][3] == "block"


def test_rarest_token(spark):
    rules = url_filter.rule_table(spark, [url_filter.place("block", "example.com/en/"), url_filter.word("block", "poker")])
    urls = spark.createDataFrame([(["example", "com", "en"],), (["com", "en"],), (["en"],)], "tokens array<string>")
    got = {r["name"]: r.token for r in url_filter.rarest(rules, urls).collect()}
    assert got == {"example.com/en/": "example", "poker": "poker"}


def test_repeats_and_empty(spark):
    rules = url_filter.rule_table(spark, [url_filter.place("block", "net/")])
    rows = [(None, "http://x.net/"), (5, "http://x.net/"), (5, "http://x.net/"), (None, None)]
    table = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted((str(r.page_id), r.verdict) for r in url_filter.judged(table, rules).collect())
    assert got == [("5", "block"), ("5", "block"), ("None", "allow"), ("None", "block")]
    assert url_filter.judged(table.limit(0), rules).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql_twin(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view pages as from '/root/testdata/{sf}/pages.parquet'")
    want = sorted(con.execute(f"select page_id, host, path, rule, verdict from ({queries.OP7_SQL})").fetchall())
    assert sorted(map(tuple, queries.op7_url_filter(spark, f"/root/testdata/{sf}").collect())) == want
    plan = queries.op7_url_filter(spark, f"/root/testdata/{sf}")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
