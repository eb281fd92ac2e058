"""Months, grids and link following."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow import schemas as S
from folioflow.operators import links, months
from folioflow.session import stored_count


def spans(spark, *rows):
    return spark.createDataFrame(list(rows), "a string, b string").select(
        F.to_date("a").alias("a"), F.to_date("b").alias("b")
    )


def months_of(spark, a, b):
    rows = months.month_partitions(spans(spark, (a, b)), "a", "b").orderBy("start_date").collect()
    return [(r.partition_date, str(r.start_date), str(r.end_date)) for r in rows]


def test_month_partitions(spark):
    assert months_of(spark, "2024-01-01", "2024-01-31") == [("2024-01", "2024-01-01", "2024-01-31")]
    assert [m[0] for m in months_of(spark, "2024-01-01", "2024-03-31")] == ["2024-01", "2024-02", "2024-03"]
    assert [m[0] for m in months_of(spark, "2023-12-01", "2024-01-31")] == ["2023-12", "2024-01"]
    assert months_of(spark, "2024-01-17", "2024-02-28") == [
        ("2024-01", "2024-01-01", "2024-01-31"), ("2024-02", "2024-02-01", "2024-02-28"),
    ]
    assert months_of(spark, "2024-03-01", "2024-01-31") == []
    assert months_of(spark, "2024-01-20", "2024-01-05") == [("2024-01", "2024-01-01", "2024-01-05")]


def test_grid_manifest_and_requests(spark):
    bodies = months.body_dimension(spark)
    picked = months.select_bodies(bodies, " Labour Court ,nobody, Equality Tribunal")
    assert {r.body for r in picked.collect()} == {"Labour Court", "Equality Tribunal"}
    assert months.select_bodies(bodies, "").count() == months.select_bodies(bodies, None).count() == 4
    grid = months.partition_grid(picked, F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-02-10")))
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    rows = months.crawl_manifest(grid, "https://s.example/%20/").where("code = '3'").orderBy("start_date")
    assert [r.url for r in rows.collect()] == [
        "https://s.example/%20/?decisions=1&from=01/01/2024&to=31/01/2024&legislationsub=&body=3",
        "https://s.example/%20/?decisions=1&from=01/02/2024&to=10/02/2024&legislationsub=&body=3",
    ]
    requests = months.run_requests(picked, F.to_date(F.lit("2024-01-05"))).collect()
    assert {r.run_key for r in requests} == {"2023-12-01|Labour Court", "2023-12-01|Equality Tribunal"}
    first = months.partition_grid(bodies, F.to_date(F.lit(S.FIRST_MONTH)), F.to_date(F.lit("2012-12-31")))
    assert first.count() == 48


def test_pending_and_ready(spark):
    schema = "body string, partition_date string"
    landing = spark.createDataFrame([("a", "2024-01"), ("a", "2024-01"), ("b", "2024-02")], schema)
    done = spark.createDataFrame([("a", "2024-01")], schema)
    grid = spark.createDataFrame([("a", "2024-01"), ("a", "2024-02")], schema)
    assert [tuple(r) for r in months.pending_partitions(landing, done).collect()] == [("b", "2024-02")]
    assert [tuple(r) for r in months.ready_partitions(grid, landing).collect()] == [("a", "2024-01")]


def test_month_range(spark):
    rows = spark.createDataFrame(
        [("a", "2024-01"), ("a", "2024-03"), ("b", "2024-02"), ("a", "unknown"), ("a", None)],
        "body string, partition_date string",
    )
    assert months.month_range(rows, "2024-01", "2024-02").count() == 2
    assert months.month_range(rows, "2024-01", "2024-12", "a").count() == 2


def test_time_range_reaches_the_scan(spark, tmp_path):
    spark.sql("SELECT timestamp_ntz'2024-01-31 23:59:59' AS t UNION ALL SELECT timestamp_ntz'2024-02-01'").write.parquet(
        str(tmp_path / "t")
    )
    picked = months.month_range_on_time(spark.read.parquet(str(tmp_path / "t")), "t", "2024-01", "2024-01")
    assert picked.count() == 1
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan


def test_results_chains(spark):
    edges = [("a1", "a2"), ("a2", "a3"), ("a3", "a1"), ("b1", "b2"), ("b2", "a3"), ("c1", "c1"), ("z", "y")]
    starts = [("a1", 1), ("b1", 2), ("c1", 3), ("d1", 4), ("a1", 5)]
    got = links.results_chains(
        spark.createDataFrame(starts, "url string, start int"),
        spark.createDataFrame(edges, "src string, dst string"),
        ["start"],
    ).collect()
    assert sorted((r.url, r.start, r.page) for r in got) == [
        ("a1", 1, 1), ("a2", 1, 2), ("a3", 1, 3), ("b1", 2, 1), ("b2", 2, 2), ("c1", 3, 1), ("d1", 4, 1),
    ]


def test_long_chain_takes_few_rounds(spark):
    edges = [(f"p{i}", f"p{i + 1}") for i in range(1, 200)]
    got = links.results_chains(
        spark.createDataFrame([("p1", 0)], "url string, start int"),
        spark.createDataFrame(edges, "src string, dst string"),
        ["start"],
    )
    assert {r.url: r.page for r in got.collect()} == {f"p{i}": i for i in range(1, 201)}


def reach_model(starts, edges):
    """Breadth first from all starts, page by page."""
    out, frontier = {}, {}
    for url, start in starts:
        frontier[url] = min(start, frontier.get(url, start))
    page = 1
    while frontier:
        out |= {url: (start, page) for url, start in frontier.items()}
        onward = {}
        for url, start in frontier.items():
            if url in edges and edges[url] not in out:
                onward[edges[url]] = min(start, onward.get(edges[url], start))
        frontier, page = onward, page + 1
    return sorted((url, *found) for url, found in out.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_results_chains_equal_the_model(spark, seed):
    """Random links make trees with loops at their roots; others make long chains and loops."""
    rng = random.Random(seed)
    edges = {f"p{i}": f"p{rng.randrange(150) if seed == 1 else i + 1 if rng.random() < 0.9 else rng.randrange(150)}" for i in range(150) if rng.random() < 0.95}
    starts = [(f"p{rng.randrange(150)}", i) for i in range(seed * 3)]
    got = links.results_chains(
        spark.createDataFrame(starts, "url string, start int"), spark.createDataFrame(list(edges.items()), "src string, dst string"), ["start"]
    )
    assert sorted((r.url, r.start, r.page) for r in got.collect()) == reach_model(starts, edges)


def test_rounds_of_a_chain_shrink_geometrically(spark, monkeypatch):
    """A long chain, a loop and links nothing reaches: every round has a fraction of the rows of the one before."""
    sizes = []

    def counted(df):
        out, n = stored_count(df)
        sizes.append(n)
        return out, n

    monkeypatch.setattr(links, "stored_count", counted)
    chain = [(f"p{i}", f"p{i + 1}") for i in range(1, 1500)] + [(f"l{i}", f"l{(i + 1) % 700}") for i in range(700)] + [(f"x{i}", "y") for i in range(700)]
    got = links.results_chains(spark.createDataFrame([("p1", 0), ("l5", 1)], "url string, start int"), spark.createDataFrame(chain, "src string, dst string"), ["start"])
    assert {r.url: r.page for r in got.collect()} == {f"p{i}": i for i in range(1, 1501)} | {f"l{i}": (i - 5) % 700 + 1 for i in range(700)}
    assert sizes[0] == 1500 + 700 + 701 and sizes[-1] == 0
    assert all(b <= 0.85 * a + 3 for a, b in zip(sizes, sizes[1:])) and sum(sizes) < 4 * sizes[0]


def follow_model(listings, pages):
    """Breadth first with every URL requested once, hop by hop in listing order."""
    requested, settled, frontier = set(), [], []
    for position, url in sorted(listings):
        if url not in requested:
            requested.add(url)
            frontier.append((position, url, url))
    while frontier:
        wanted = []
        for position, first, at in sorted(frontier):
            if at not in pages:
                continue
            route, onward = pages[at]
            if route == "follow":
                wanted.append((position, first, onward))
            else:
                settled.append((position, first, at, route))
        frontier = []
        for position, first, at in sorted(wanted):
            if at not in requested:
                requested.add(at)
                frontier.append((position, first, at))
    done = {first for _, first, _, _ in settled}
    lost = {}
    for position, url in sorted(listings, reverse=True):
        if url not in done:
            lost[url] = (position, url, None, None)
    return sorted([*settled, *lost.values()])


def test_attach_documents_equals_the_model(spark):
    rng = random.Random(9)
    names = [f"http://h.example/{i}" for i in range(60)]
    pages = {
        n: ("follow", rng.choice([*names, "http://h.example/none"])) if rng.random() < 0.6 else ("html", None)
        for n in names
    }
    listings = [(i, rng.choice(names)) for i in range(40)] + [(99, "http://h.example/gone")]
    got = links.attach_documents(
        spark.createDataFrame(listings, "position int, document_url string"),
        spark.createDataFrame([(u, *v) for u, v in pages.items()], "url string, route string, follow_url string"),
        ["position"],
    ).collect()
    assert sorted((r.position, r.document_url, r.final_url, r.route) for r in got) == follow_model(listings, pages)


def test_attach_documents_keeps_to_the_hosts(spark):
    pages = [
        ("http://h.example/1", "follow", "http://x.test/2"), ("http://x.test/2", "file", None),
        ("http://h.example/3", "html", None),
    ]
    got = links.attach_documents(
        spark.createDataFrame([(1, "http://h.example/1"), (2, "http://x.test/2"), (3, "http://h.example/3")], "position int, document_url string"),
        spark.createDataFrame(pages, "url string, route string, follow_url string"),
        ["position"],
        ["h.example"],
    ).collect()
    assert sorted((r.position, r.final_url) for r in got) == [(1, None), (3, "http://h.example/3")]


def test_requests_ignore_fragment_and_order_of_arguments(spark):
    urls = ["http://h/a", "http://h/a#x", "http://h/a?b=2&a=1#y", "http://h/a?a=1&b=2", "http://h/a?", "http://h/#a?b"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(links.request_key("u"))
    assert [r[0] for r in rows.collect()] == ["http://h/a", "http://h/a", "http://h/a?a=1&b=2", "http://h/a?a=1&b=2", "http://h/a?", "http://h/"]
    got = links.results_chains(
        spark.createDataFrame([("http://h/1", 0)], "url string, start int"),
        spark.createDataFrame([("http://h/1#top", "http://h/2?b=1&a=2#z"), ("http://h/2?a=2&b=1", "http://h/3")], "src string, dst string"),
        ["start"],
    ).collect()
    assert sorted((r.page, r.url) for r in got) == [(1, "http://h/1#top"), (2, "http://h/2?a=2&b=1"), (3, "http://h/3")]


def test_normal_forms_of_requests(spark):
    same = [
        ["HTTP://User:Pw@H.Example:8080/A%2fb/%7e%41c", "http://User:Pw@h.example:8080/A%2Fb/~Ac"],
        ["http://h?b=1&a=2", "http://h/?a=2&b=1", "http://H/?b=1&a=2#z"],
        ["http://h/é x", "http://h/%c3%A9%20x", "http://h/%C3%A9 x#"],
        ["http://h/a?q=a b&p", "http://h/a?p&q=a+b", "http://h/a?q=a%20b&p"],
        ["http://h/a?a-b=1&a=2", "http://h/a?a=2&a-b=1"],
        ["http://h/100%", "http://h/100%#x"],
        ["http://h/%e2%82%ac%zz", "http://h/€%zz"],
    ]
    rows = spark.createDataFrame([(i, u) for i, group in enumerate(same) for u in group], "i int, u string")
    keys = rows.select("i", links.request_key("u").alias("k")).distinct().collect()
    assert len(keys) == len(same) and len({r.k for r in keys}) == len(same)
    other = ["http://h/a%2Fb", "http://h/a/b", "http://h/A/b", "http://h/a/b?", "http://h/a/b?c=%26", "http://h/a/b?c=&", "http://h/a/b?c="]
    keys = spark.createDataFrame([(u,) for u in other], "u string").select(links.request_key("u")).distinct()
    assert keys.count() == len(other)
    got = links.attach_documents(
        spark.createDataFrame([(1, "http://H.example/a%7Eb"), (2, "http://h.example/a~b")], "position int, document_url string"),
        spark.createDataFrame([("http://h.example/a~b", "follow", "http://h.example/f é?y=2&x=1"), ("http://h.example/f%20%C3%A9?x=1&y=2", "file", None)], "url string, route string, follow_url string"),
        ["position"],
    ).collect()
    assert [(r.position, r.final_url) for r in got] == [(1, "http://h.example/f%20%C3%A9?x=1&y=2")]


def test_first_by_keeps_whole_rows(spark):
    rows = spark.createDataFrame([("u", 2, None), ("u", 1, "x"), ("v", 3, "y")], "url string, n int, t string")
    got = links.first_by(rows, "url", ["n"])
    assert sorted(tuple(r) for r in got.collect()) == [("u", 1, "x"), ("v", 3, "y")]
