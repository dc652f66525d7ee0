"""Odd rows for the operators that are DataFrame operations only, against plain Python."""

import pytest

from reviewlab.llm import decontamination, line_dedup, url_filters

LONG = "A line that is long enough to be counted, number "


def test_line_dedup_of_odd_rows(spark):
    schema = "doc_id long, text string, n_lines string, kept_text string, _id int, hash string, at int"
    extra = ("x", "y", 1, "z", 2)
    shared = [(i, f"{LONG}1\n  {LONG.upper()}1\t\nshort {i}\n", *extra) for i in range(1, 7)]
    rows = [
        *shared, (6, f"{LONG}1\n  {LONG.upper()}1\t\nshort 6\n", *extra), (None, f"{LONG}1", *extra), (None, None, *extra),
        (10, None, *extra), (11, "", *extra), (12, "\n\n", None, None, None, None, None), (13, f"{LONG}2\n" * 50_000 + "x", *extra),
        *[(i, f"{LONG}3\r", *extra) for i in range(20, 24)],
    ]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == len(rows)
    by = {(r.doc_id, r.text): (r.n_lines, r.n_dropped, r.kept_text) for r in found}
    for i in range(1, 6):
        assert by[i, shared[i - 1][1]] == (4, 2, f"short {i}\n")
    assert by[6, shared[5][1]] == (4, 0, shared[5][1])
    assert by[None, f"{LONG}1"] == (1, 1, "") and by[None, None] == by[10, None] == by[11, ""] == (1, 0, "")
    assert by[12, "\n\n"] == (3, 0, "\n\n") and by[13, rows[-5][1]][:2] == (50_001, 0)
    assert by[20, f"{LONG}3\r"][1] == 0
    assert {r["_id"] for r in found} == {1, None}
    assert line_dedup.dedup_lines(spark.createDataFrame([], schema)).count() == 0


def test_decontamination_of_odd_rows(spark):
    schema = "doc_id long, text string, n_words string, window string, hash int, item_ids string"
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(1, f"x {passage.upper()}! y", "a", "b", 1, "c"), (1, f"x {passage.upper()}! y", "a", "b", 1, "c"),
            (2, " ".join(f"p{i}" for i in range(9)), None, None, None, None), (3, None, "a", "b", 1, "c"), (4, "", "a", "b", 1, "c"),
            (None, f"{passage} {passage}", "a", "b", 1, "c"), (5, "solo. Duo, wort", "a", "b", 1, "c"), (6, "é solo-é", "a", "b", 1, "c"),
            (7, f"{passage} " * 5000, "a", "b", 1, "c"), (8, "duo trio solo", "a", "b", 1, "c")]
    items = [(1, passage), (1, passage), (2, None), (3, "..."), (4, "SOLO"), (5, "duo wort"), (None, "trio"), (10, f"{passage} more")]
    found = decontamination.mark_contamination(
        spark.createDataFrame(rows, schema), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids)) for r in found}
    assert by == {1: (16, 14, ["1", "10"]), 2: (9, 0, []), 3: (0, 0, []), 4: (0, 0, []), None: (28, 28, ["1", "10"]),
                  5: (3, 3, ["4", "5"]), 6: (3, 1, ["4"]), 7: (70_000, 70_000, ["1", "10"]), 8: (3, 2, ["4"])}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.mark_contamination(spark.createDataFrame(rows, schema), empty).where("contaminated").count() == 0
    assert decontamination.mark_contamination(spark.createDataFrame([], schema), empty).count() == 0


def adblock_fits(pattern, address):
    """Patterns by a hand-written matcher over the address."""
    import re

    anchored = pattern.startswith("|")
    host_anchor = pattern.startswith("||")
    body = pattern.lstrip("|")
    ends = body.endswith("|")
    regex = "".join(".*" if c == "*" else "(?:[^A-Za-z0-9._%-]|$)" if c == "^" else re.escape(c) for c in body.rstrip("|"))
    start = r"(?:[^/?#]*\.)?" if host_anchor else "" if anchored else ".*"
    return re.match(f"(?s)^{start}{regex}{'$' if ends else ''}", address) is not None


URLS = [None, "", "no scheme", "http://", "://", "HTTP://User@EXAMPLE.org:80/es/x?q#f", "http://a.b.example.org/es", "x://example.org/en/12",
        "x://org", "x://org/", "x://norg/", "x://a.com/de/?de", "x://a.com?/fr/", "x://a.com#/fr/", "x://casino-x.net/", "x://my-casino-x.net/",
        "x://sub.adult-x.com/fr/1", "x://ads-track.com/de/", "a://b/affiliate/1/click?x", "a://b/affiliate/1/clicker", "a://b/p?gclid=3",
        "é://ü.é/ö", "a://b/\n://c.com/fr/", "a://b.com/FR/1", "a://" + "x/" * 20_000]


def test_url_filters_of_odd_rows(spark):
    schema = "page_id long, url string, host string, token string, _url int, rule string"
    rows = [(i, u, "h", "t", 1, "r") for i, u in enumerate(URLS)] + [(5, URLS[5], "h", "t", 1, "r"), (None, "x://org/", None, None, None, None)]
    found = url_filters.filter_urls(spark.createDataFrame(rows, schema), url_filters.default_rules(spark)).collect()
    assert len(found) == len(rows)
    for r in found:
        url = r.url or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, tail = rest[:cut].lower() if rest[:cut].isascii() else rest[:cut], rest[cut:]
        path = tail[:next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
        fitting = [
            (len(h + p), h + p, v) for h, p, v in url_filters.HOST_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        blocked = any(adblock_fits(p, host + tail) for p in url_filters.BLOCKED_PATTERNS)
        _, rule, verdict = max(fitting, default=(0, None, "block" if blocked else "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict), r.url
    assert url_filters.filter_urls(spark.createDataFrame([], schema), url_filters.default_rules(spark)).count() == 0


def test_the_listed_rules_judge_as_their_contract_says(spark):
    expected = {
        "x://a.org/es/": ("org/", "allow"), "x://example.org/es/1": ("example.org/es/", "block"), "x://a.example.org/en/12": ("example.org/en/1", "block"),
        "x://example.org/en/2": ("org/", "allow"), "x://a.com/fr/": ("com/fr/", "allow"), "x://casino-a.com/de/": ("com/de/", "block"), "x://a.com/en/1": (None, "allow"),
    }
    pages = spark.createDataFrame([(u,) for u in expected], "url string")
    found = url_filters.filter_urls(pages, url_filters.default_rules(spark)).collect()
    assert {r.url: (r.rule, r.verdict) for r in found} == expected


@pytest.mark.parametrize("patterns", [["||b.com|", "/x*y^", "*", "|a.", "q=1|", None], []])
def test_other_rules(spark, patterns):
    urls = ["s://b.com", "s://a.b.com", "s://a.b.com/x/y/", "s://c/xy?q=1", "s://ab/xyz", "s://a.d/?q=12"]
    rules = spark.createDataFrame([(p, None, None, "block") for p in patterns], url_filters.RULES_SCHEMA)
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    found = {r.url: r.verdict for r in url_filters.filter_urls(pages, rules).collect()}
    for u in urls:
        blocked = any(p and adblock_fits(p, u.split("://")[1]) for p in patterns)
        assert found[u] == ("block" if blocked else "allow"), u


def test_rules_are_indexed_by_their_rarest_token(spark):
    counts = spark.createDataFrame([("org", 900), ("example", 1000), ("es", 3)], "token string, n long")
    index = url_filters.index_rules(url_filters.default_rules(spark), counts).collect()
    by = {r.pattern: r.token for r in index}
    assert by["||example.org/es/"] == "es" and by["||org/"] == "org" and by["?gclid="] == "gclid"
    assert by["||example.org/en/1"] == "en" and by["||casino-"] == "casino"


def test_no_python_in_native_plans(spark, sf):
    from reviewlab.llm import queries

    for name in ("op2_line_dedup", "op4_url_filters", "op9_benchmark_decontamination"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas")), name
