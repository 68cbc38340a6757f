import math
import random

import pytest

from orderlens.llm import url_filter as op


@pytest.fixture(scope="module")
def blocked(spark):
    """Indices of the blocked among (url, bad) pairs, where bad is None for a page without label."""

    def run(pages, **options):
        rows = spark.createDataFrame([(k, url) for k, (url, _) in enumerate(pages)], "page_id long, url string")
        labels = spark.createDataFrame([(k, bad) for k, (_, bad) in enumerate(pages) if bad is not None], "page_id long, bad boolean")
        return {r["page_id"] for r in op.judge(rows, labels, **options).where("verdict = 'block'").collect()}

    return run


def name(k):
    return "".join(chr(97 + k // 26**p % 26) for p in range(3))


@pytest.mark.parametrize("sections", [50, 51, 200])
def test_a_bad_section_goes_among_any_number_of_sections(blocked, sections):
    pages = [(f"http://h.org/casino/{name(k)}", True if k % 2 else None) for k in range(120)]
    for s in range(sections - 1):
        pages += [(f"http://h.org/s{name(s)}/{name(k)}", False if k % 2 else None) for k in range(6 + s % 30)]
    assert blocked(pages) == set(range(120))


def test_segments_that_are_alike_still_share_labels(blocked):
    pages = [(f"http://h.org/{name(u)}/{kind}/x", kind == "casino") for u in range(80) for kind in ("casino", "casino", "news", "news", "news")]
    assert blocked(pages) == {k for k, (_, bad) in enumerate(pages) if bad}


@pytest.mark.parametrize("between", ["", "posts/all/of/them/"])
def test_templates_that_differ_below_four_segments_are_told_apart(blocked, between):
    pages = []
    for kind, bad in (("casino", True), ("news", False), ("sport", False)):
        pages += [(f"http://h.org/blog/user/2020/05/{between}{kind}/{name(k)}", bad if k % 2 else None) for k in range(60)]
    assert blocked(pages) == set(range(60))


def test_one_kind_of_labels_needs_no_deeper_tree(spark):
    rows = [("h", list("abcdefg"), 3, 0), ("h", list("abcdexy"), 3, 0), ("g", list("abcdefg"), 3, 0), ("g", list("abcdexy"), 3, 3), ("g", list("abcd"), 1, 0)]
    frame = spark.createDataFrame(rows, "host string, shape array<string>, labelled int, bad int")
    found = {(r["host"], "".join(r["template"])) for r in op.templates(frame).collect()}
    assert found == {("h", "abcd**"), ("g", "abcdef**"), ("g", "abcdex**"), ("g", "abcd")}


@pytest.mark.parametrize(("sections", "labels"), [(2, 9), (50, 9), (51, 9), (200, 30)])
def test_the_width_of_a_place_does_not_matter(blocked, sections, labels):
    """One section with bad labels only, the others with 2 bad ones of 9: the verdict is the same among any number of them."""
    pages = [(f"http://h.org/casino/{name(k)}", True) for k in range(labels)]
    for s in range(sections - 1):
        pages += [(f"http://h.org/s{name(s)}/{name(k)}", k < 2) for k in range(9)]
    assert {k for k in blocked(pages) if k < labels} == set(range(labels))


def brute_force(pages, z=1.96, weight=10.0):
    """The tree by recursion over whole paths of letters, without rounds, depth or chains."""

    def differs(own, all_):
        (n, b), (N, B) = own, all_
        if not n or N == n:
            return False
        p, gap = B / N, abs(b / n - (B - b) / (N - n))
        return gap > z * math.sqrt(p * (1 - p) * (1 / n + 1 / (N - n)))

    total = lambda rows: (sum(bad is not None for _, _, bad in rows), sum(bad is True for _, _, bad in rows))
    found = set()

    def visit(rows, at, above, estimate):
        own = total(rows)
        if differs(own, above):
            estimate = (own[1] + estimate * weight) / (own[0] + weight)
        found.update(k for k, path, _ in rows if len(path) <= at and estimate >= 0.5)
        rows = [r for r in rows if len(r[1]) > at]
        children = {}
        for r in rows:
            children.setdefault(r[1][at], []).append(r)
        inner, merged = total(rows), {}
        for segment, some in children.items():
            alone = len(children) == 1 or differs(total(some), inner)
            merged.setdefault(segment if alone else "*", []).extend(some)
        for some in merged.values():
            visit(some, at + 1, own, estimate)

    hosts = {}
    for k, (url, bad) in enumerate(pages):
        _, _, host, *path = url.split("/")
        hosts.setdefault(host, []).append((k, [p for p in path if p], bad))
    everything = [r for rows in hosts.values() for r in rows]
    labelled, bad = total(everything)
    for rows in hosts.values():
        visit(rows, 0, (labelled, bad), bad / max(labelled, 1))
    return found


@pytest.mark.parametrize("seed", range(2))
def test_random_trees_equal_brute_force(blocked, seed):
    rng = random.Random(seed)
    taste = {}
    pages = []
    for _ in range(1200):
        path = [rng.choice("abcde"[: rng.choice([1, 2, 5])]) for _ in range(rng.randrange(8))]
        share = 0.2
        for k in range(len(path)):
            share = taste.setdefault(tuple(path[: k + 1]), rng.choice([share, share, share, 0.0, 0.95]))
        url = "/".join([f"http://{rng.choice('xxxyz')}.org", *path])
        pages.append((url, rng.random() < share if rng.random() < 0.7 else None))
    assert blocked(pages) == brute_force(pages)


def test_a_long_mixed_path_is_a_few_rounds(spark, monkeypatch):
    """500 segments without a branch, then one, then 500 more."""
    head, tail = [f"a{chr(97 + k % 26)}" for k in range(500)], [f"b{chr(97 + k % 26)}" for k in range(500)]
    rows = [("h", [*head, kind, *tail, end], 30, 30 if bad else 0) for kind, bad in (("x", True), ("y", False)) for end in "pq"]
    rows.append(("h", head[:200], 10, 10))
    frame = spark.createDataFrame(rows, "host string, shape array<string>, labelled int, bad int")
    rounds = []
    plain = op._starred
    monkeypatch.setattr(op, "_starred", lambda *a: rounds.append(1) or plain(*a))
    found = {tuple(r["template"][:4]): r["template"][4:] for r in op.templates(frame).collect()}
    assert len(rounds) <= op.DEPTH + 4 and len(found) == 1
    assert {r["template"][-1] for r in op.templates(frame).collect()} == {"**", "/".join(head[4:200])}


def test_long_urls_and_names_that_clash(spark):
    long_url = "http://h.org/" + "/".join("ab" for _ in range(20_000))
    rows = [(1, long_url, "x", "y", True), (1, long_url, None, "y", None), (None, long_url, "x", "y", False)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string, bad boolean")
    labels = spark.createDataFrame([(1, True, "z"), (None, True, "z"), (9, None, "z")], "page_id long, bad boolean, host string")
    found = op.judge(pages, labels)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert [(r["page_id"], r["host"], len(r["path"]), r["verdict"]) for r in found.orderBy("page_id").collect()] == [
        (None, "h.org", 60_000, "block"), (1, "h.org", 60_000, "block"), (1, "h.org", 60_000, "block")]
