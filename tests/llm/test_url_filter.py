import datetime as dt

import pytest

from checks.compare import _rows, duck
from voicetide.llm import queries
from voicetide.llm import url_filter as uf

DAY = dt.datetime(2024, 1, 1)


def at(days):
    return None if days is None else DAY + dt.timedelta(days=days)


@pytest.mark.parametrize(("url", "host"), [
    ("http://WWW.Example.com/a?b#c", "www.example.com"), ("https://u:p@h.org:8080/x", "h.org"),
    ("HTTP://h.org.", "h.org"), (" https://a.b ", "a.b"), ("ftp://x/y@z", "x"), ("no url", None), ("", None),
    (None, None), ("http://", None), ("//h.org/a", None), ("http://h?x", "h"), ("http://./x", None), ("http://.../", None),
])
def test_host(spark, url, host):
    row = spark.createDataFrame([(url,)], "url string").select(uf.host(uf.F.col("url")).alias("h")).first()
    assert row.h == host


def brute(captures, entries):
    """Plays the log forward to each fetch time."""
    out = []
    for url, day, host in captures:
        lists = {}
        if host is not None and day is not None:
            state = {}
            rank = {"remove": 0, "allow": 1, "block": 2}
            usable = [e for e in entries if None not in e and e[2].lower() in rank]
            for name, domain, action, since in sorted(usable, key=lambda e: (e[3], rank[e[2].lower()])):
                if since <= day:
                    state[name, domain.lower()] = action.lower()
            for (name, domain), action in state.items():
                if action != "remove" and (host == domain or host.endswith("." + domain)):
                    if len(domain) > len(lists.get(name, ("", ""))[0]):
                        lists[name] = (domain, action)
        blocking = sorted(n for n, (_, a) in lists.items() if a == "block")
        out.append((str(url), str(day), len(lists), len(blocking), str(blocking[0] if blocking else None)))
    return sorted(out)


ENTRIES = [
    ("ads", "example.com", "block", 0), ("ads", "example.com", "remove", 10), ("ads", "example.com", "block", 400),
    ("ads", "good.example.com", "allow", 5), ("adult", "EXAMPLE.com", "Block", 3), ("adult", "example.com", "allow", 3),
    ("adult", "com", "block", 100), ("adult", "com", "remove", 100), ("x", None, "block", 1), (None, "a.org", "block", 1),
    ("x", "a.org", None, 1), ("x", "a.org", "block", None), ("x", "a.org", "unknown", 1), ("ads", "example.com", "block", 0),
    ("late", "org", "block", 5000),
] + [("long", "org", "block" if k % 2 else "allow", 3 * k) for k in range(200)]
CAPTURES = [
    (f"http://{h}/p", d, h) for h in ("example.com", "a.good.example.com", "a.org", "bexample.com", "org")
    for d in (-1, 0, 2, 3, 9, 10, 11, 29, 30, 31, 99, 100, 101, 399, 400, 650)
] + [("http://example.com/p", None, "example.com"), ("bad", 5, None), (None, 5, None),
     ("http://a.org/p", 30, "a.org"), ("http://a.org/p", 30, "a.org")]


def frames(spark, captures, entries):
    return (
        spark.createDataFrame(
            [(u, at(d), "clash", "clash") for u, d, _ in captures],
            "url string, fetched_at timestamp_ntz, host string, domain string",
        ),
        spark.createDataFrame(
            [(n, d, a, at(t), "clash") for n, d, a, t in entries],
            "list string, domain string, action string, effective_at timestamp_ntz, valid_to string",
        ),
    )


@pytest.mark.parametrize("hot_rows", [uf.HOT_ROWS, 2])  # 2: most domains are dealt over tasks
@pytest.mark.parametrize("entries", [ENTRIES, []])
@pytest.mark.parametrize("captures", [CAPTURES, []])
def test_against_playing_the_log(spark, captures, entries, hot_rows):
    found = uf.judge(*frames(spark, captures, entries), hot_rows=hot_rows).collect()
    got = sorted(
        (str(r.url), str(None if r.fetched_at is None else (r.fetched_at - DAY).days), r.n_lists, r.n_blocking,
         str(r.blocked_by)) for r in found
    )
    assert got == brute(captures, entries)
    assert all(r.blocked == (r.n_blocking > 0) and r.domain == "clash" for r in found)


def test_the_main_path_has_no_python_and_prunes(spark, small):
    frame = queries.op10_url_filter(spark, small)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas")) and "html" not in plan


def test_some_pages_are_blocked_and_some_not(spark, small):
    verdicts = {r.blocked for r in queries.op10_url_filter(spark, small).collect()}
    assert verdicts == {True, False}


def test_sql_on_odd_urls(spark, tmp_path):
    urls = [None, "", "bad", "http://single/x", "http://a.b.c.d.example.com/", "HTTP://u@A.b:80?q", "http://x.org./",
            "http://./x"]
    rows = [(i, u, "h") for i, u in enumerate(urls * 20)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(
        str(tmp_path / "pages.parquet")
    )
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cursor = con.execute(queries.OP10_SQL)
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    found = queries.op10_url_filter(spark, str(tmp_path))
    assert _rows(found.columns, [tuple(r) for r in found.collect()]) == want
