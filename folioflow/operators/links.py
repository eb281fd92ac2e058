"""Following links through tables of captured pages."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import text, urls
from folioflow.functions.text import once
from folioflow.session import stored, stored_count


def first_by(rows: DataFrame, key: str, order: Iterable[str]) -> DataFrame:
    """First row per key in the given order, aggregated before the shuffle."""
    others = [c for c in rows.columns if c != key]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_row")
    return rows.groupBy(key).agg(first).select(key, *[f"_row.{c}" for c in others]).select(
        *rows.columns
    )


def request_key(url: Column | str) -> Column:
    """What makes two URLs the same request: no fragment, scheme and host in lower case, escapes in their normal form, arguments
    in order of name and value. An absolute URL without a path asks for `/`."""
    plain = F.substring_index(text.as_column(url), "#", 1)

    def parts(u: Column) -> Column:
        site = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?)[^/?]*", 0)
        user = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?@]*@)", 1)
        named = F.when(user == "", F.lower(site)).otherwise(F.replace(F.lower(site), F.lower(user), user))
        rest = F.substring(u, F.length(site) + 1, F.length(u))
        path, query = F.substring_index(rest, "?", 1), F.regexp_extract(rest, r"(?s)\?(.*)$", 1)
        return once(F.struct(named.alias("site"), path.alias("path"), query.alias("query"), rest.contains("?").alias("asks")), joined)

    def joined(v: Column) -> Column:
        path = F.when((v.site != "") & (v.path == ""), "/").otherwise(urls.normal_escapes(v.path))
        arguments = F.transform(F.split(v.query, "&"), lambda a: F.replace(urls.normal_escapes(F.replace(a, F.lit("+"), F.lit("%20"))), F.lit("%20"), F.lit("+")))
        by_name = F.array_sort(F.transform(arguments, lambda a: F.struct(F.substring_index(a, "=", 1).alias("name"), a.alias("whole"))))
        query = F.when(v.query == "", "").otherwise(F.array_join(F.transform(by_name, lambda a: a.whole), "&"))
        return F.concat(v.site, path, F.when(v.asks, F.concat(F.lit("?"), query)).otherwise(""))

    return once(plain, parts)


def results_chains(starts: DataFrame, edges: DataFrame, order: Iterable[str]) -> DataFrame:
    """Number the results pages reached from each start by `next` links.

    `starts`: `url` and context columns, page 1 of each partition; `order` ranks the starts.
    `edges`: `src, dst`, at most one per `src`. A page reached more than once belongs to the
    start that reaches it in the fewest steps. URLs are compared by `request_key`; a page is given
    by the URL under which it is an edge's `src`, or else by the one that leads to it.

    Nothing is nearer to a start than itself, so links that lead to a start are left out; what remains are trees of
    links, some with a loop at their root, which `nearest` contracts.
    """
    order = list(order)
    context = [c for c in starts.columns if c != "url"]
    named = edges.select(request_key("src").alias("src"), request_key("dst").alias("dst"), F.col("src").alias("url"), F.col("dst").alias("to"))
    named = stored(first_by(named, "src", ["url", "to"]))
    first = starts.withColumn("key", request_key("url"))
    begun = stored(first_by(first, "key", [*order, "url"]).drop("url"))

    rank = [c for c in order if c in context]
    value = F.struct(F.lit(1).cast("long").alias("page"), *[F.col(c) for c in [*rank, *[c for c in context if c not in rank]]])
    starting = begun.select("key", value.alias("cand"))
    inward = named.select("src", "dst").join(begun.select(F.col("key").alias("dst")), "dst", "left_anti")
    nodes = starting.select("key").unionByName(inward.select(F.col("src").alias("key"))).unionByName(inward.select(F.col("dst").alias("key"))).distinct()
    out = inward.select(F.col("src").alias("key"), "dst", F.lit(1).cast("long").alias("steps"))
    reach = nearest(nodes.join(starting, "key", "left").join(out, "key", "left")).select("key", "value.*")

    urls_of = named.select(F.col("src").alias("key"), F.col("url"), F.lit(0).alias("rank"))
    urls_of = urls_of.unionByName(first.select("key", "url", F.lit(1).alias("rank")))
    urls_of = urls_of.unionByName(named.select(F.col("dst").alias("key"), F.col("to").alias("url"), F.lit(2).alias("rank")))
    known = first_by(urls_of, "key", ["rank", "url"]).drop("rank")
    return reach.join(known, "key").select("url", *context, "page")


def nearest(live: DataFrame) -> DataFrame:
    """`key, value` of the nodes that a candidate reaches: the least of its own and those of the nodes that lead to it.

    `live`: `key`, its candidate `cand` (a struct that begins with `page`, or NULL), its one link `dst` or NULL, and the
    `steps` the link adds to `page`. A node that has a candidate of page 1 has no links to it.

    Each round takes out two kinds of nodes. One to which no link leads is settled: it hands its candidate on, or nothing,
    if it has none. One with a single link to it, and whose random number is less than those of both its neighbours, is
    bridged: its predecessor takes over its link, and it waits for that one's value. About a third of the nodes of chains
    and all ends of trees go in a round, loops shrink to a node that leads to itself, and the work of all rounds together is
    a few times that of the first. Bridged nodes are then given their values, last round first.
    """
    settled: list[DataFrame] = []
    bridged: list[DataFrame] = []
    while True:
        chance = lambda c, salt=len(settled): F.xxhash64(F.lit(salt), F.col(c))
        links = live.where("dst is not null")
        before = links.groupBy(F.col("dst").alias("key")).agg(F.count("*").alias("n"), F.min("key").alias("pred"), F.max("steps").alias("behind"))
        least = (chance("key") < chance("pred")) & (F.col("dst").isNull() | (chance("key") < chance("dst")))
        single = (F.col("n") == 1) & (F.col("pred") != F.col("key")) & least
        state = live.join(before, "key", "left").select("key", "cand", "dst", "steps", "n", "pred", "behind", F.coalesce(single, F.lit(False)).alias("out"))
        state, number = stored_count(state)
        if not number:
            break
        gone = state.where("out")
        bridged.append(gone.select("key", "cand", "pred", "behind"))

        over = gone.select(F.col("pred").alias("key"), F.lit(True).alias("took"), F.col("dst").alias("onward"), F.col("steps").alias("further"))
        rest = state.where("not out").join(over, "key", "left")
        dst = F.when(F.col("took"), F.col("onward")).otherwise(F.col("dst"))
        steps = F.when(F.col("took"), F.col("steps") + F.col("further")).otherwise(F.col("steps"))
        # A node that leads to itself has come round a loop.
        rest = rest.select("key", "cand", "n", F.nullif(dst, F.col("key")).alias("dst"), steps.alias("steps"))
        ends = rest.where("n is null")
        settled.append(state.where("n is null and cand is not null").select("key", F.col("cand").alias("value")))

        handed = gone.unionByName(ends, allowMissingColumns=True).where("cand is not null and dst is not null")
        handed = handed.select(F.col("dst").alias("key"), _further("cand", F.col("steps")).alias("given"))
        given = handed.groupBy("key").agg(F.min("given").alias("given"))
        kept = rest.where("n is not null").join(given, "key", "left")
        live = kept.select("key", F.least("cand", "given").alias("cand"), "dst", "steps")

    known: list[DataFrame] = []
    for own, waiting in zip(reversed(settled), reversed(bridged)):
        # A predecessor was settled in the same round, or has its value from a later one; those are few as against all.
        known.append(own)
        later = reduce(DataFrame.unionByName, known).withColumnRenamed("key", "pred")
        found = waiting.join(later, "pred", "left").select("key", F.least("cand", _further("value", F.col("behind"))).alias("value"))
        known.append(stored(found.where("value is not null")))
    return reduce(DataFrame.unionByName, known) if known else state.select("key", F.col("cand").alias("value"))


def _further(value: str, steps: Column) -> Column:
    """A candidate so many pages on, NULL if there is none."""
    return F.when(F.col(value).isNotNull(), F.col(value).withField("page", F.col(f"{value}.page") + steps))


def attach_documents(
    listings: DataFrame, documents: DataFrame, order: Iterable[str], hosts: list[str] | None = None
) -> DataFrame:
    """The final document page of each listing; `final_url` and `route` are NULL where there is none.

    `listings`: one row per listing with its absolute `document_url`. `documents`: `url, route,
    follow_url` of each captured page. A page routed `follow` leads on to its attachment until a
    page of another route is reached. Each URL is requested once, compared by `request_key`: the first
    listing in `order` gets it, and a listing whose next URL was requested before ends there, so loops
    end too.

    So a URL goes to the listing that comes to it in the fewest hops, the first of them in `order`: one that comes later
    would meet the other on all of its further way. `nearest` finds it along the links of the pages that lead on.

    Only these narrow columns move; join page contents to `final_url` afterwards.
    """
    order = list(order)
    if hosts:
        listings = listings.where(urls.host_allowed("document_url", hosts))
    keyed = listings.withColumn("_at", request_key("document_url"))
    rows = stored(first_by(keyed, "_at", order))
    pages = documents.select(request_key("url").alias("key"), "url", "route", "follow_url")
    pages = stored(first_by(pages, "key", ["url"]))

    claim = F.struct(F.lit(1).cast("long").alias("page"), *order, F.col("_at").alias("start"))
    asked = rows.select(F.col("_at").alias("key"), claim.alias("cand"))
    onward = pages.where("route = 'follow'")
    if hosts:
        onward = onward.where(urls.host_allowed("follow_url", hosts))
    onward = onward.select("key", request_key("follow_url").alias("dst"))
    # What a listing names itself is requested first; no link makes it another's.
    onward = onward.where("dst is not null").join(asked.select(F.col("key").alias("dst")), "dst", "left_anti")
    nodes = asked.select("key").unionByName(onward.select("key")).unionByName(onward.select(F.col("dst").alias("key"))).distinct()
    live = nodes.join(asked, "key", "left").join(onward.withColumn("steps", F.lit(1).cast("long")), "key", "left")
    ended = pages.where("route <> 'follow'").join(nearest(live), "key").select("value.start", F.col("url").alias("final_url"), "route")
    return rows.join(ended, rows["_at"] == ended["start"], "left").drop("_at", "start")
