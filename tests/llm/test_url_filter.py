import pytest
from pyspark.sql import functions as F

from orderlens.llm import url_filter as op


@pytest.fixture(scope="module")
def judged(spark):
    def run(pages, labels=(), **options):
        rows = spark.createDataFrame(pages, "page_id long, url string")
        known = spark.createDataFrame([*labels], "page_id long, bad boolean")
        return {r["page_id"]: r for r in op.judge(rows, known, **options).collect()}

    return run


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://A.B.COM/x?y#z", "a.b.com", "/x", "com/", "allow"),
        ("https://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://x.www.example.com/en/1", "x.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
        ("https://example.com/en", "example.com", "/en", "com/", "allow"),
        ("https://example.com", "example.com", "", None, "allow"),
        ("http://n.net/es/1", "n.net", "/es/1", "net/es/", "block"),
        ("http://n.net/ES/1", "n.net", "/ES/1", None, "allow"),
        ("http://n.org?a/b", "n.org", "", None, "allow"),
        ("http://n.org#a/b", "n.org", "", None, "allow"),
        ("http://a.org/x://y.com/z", "a.org", "/x://y.com/z", None, "allow"),
        ("http://a.org/line\nbreak", "a.org", "/line\nbreak", None, "allow"),
        ("no scheme.com/x", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_rules(judged, url, host, path, rule, verdict):
    row = judged([(1, url)])[1]
    assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, verdict)


def test_bad_templates_go_and_their_neighbours_stay(judged):
    pages = [(k, f"http://h.org/spam/{k}") for k in range(100)] + [(k, f"http://h.org/news/{k}") for k in range(100, 300)]
    pages += [(k, f"http://other.org/{k}") for k in range(300, 400)]
    labels = [(k, k < 100) for k in range(0, 400, 2)]
    found = judged(pages, labels)
    assert {k for k, r in found.items() if r["verdict"] == "block"} == set(range(100))


def test_few_labels_do_not_reject(judged):
    pages = [(k, f"http://h{k % 7}.org/a/{k}") for k in range(100)] + [(500, "http://solo.org/x")]
    found = judged(pages, [(k, False) for k in range(60)] + [(500, True), (500, True), (None, True)])
    assert {r["verdict"] for r in found.values()} == {"allow"}


def test_variable_segments_become_wildcards(spark):
    rows = spark.createDataFrame([("h", [f"slug-{k}".replace(str(k), chr(97 + k % 26) * (k // 26 + 1)), "p"], 1) for k in range(80)] + [("h", ["{n}"], 1), ("g", ["a"], 1), ("g", [], 1)], "host string, shape array<string>, n int")
    found = {tuple(r["template"]) for r in op.templates(rows).collect()}
    assert found == {("*", "p"), ("*",), ("a",), ()}
    shape = lambda p: spark.createDataFrame([(p,)], "p string").select(op.shape_of(F.col("p"))).first()[0]
    assert shape("/en/123/0123456789abcdef/v2.html") == ["en", "{n}", "{x}", "v#.html"]
    assert shape("//a//b/c/d/e/f") == ["a", "b", "c", "d", "**"] and shape("") == []


def test_empty_table(judged):
    assert judged([]) == {}
