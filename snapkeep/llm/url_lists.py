"""URL filters by temporal list join.

Lists change over time: a dated entry adds a domain to a list or removes it.
Each entry holds from its date until the next entry for the same list and
domain, which gives validity intervals; a capture is judged by the entries
active on the day it was fetched (an as-of join), not by today's list.

A domain covers its subdomains, so a host is looked up by all its suffixes.
Captures are reduced to distinct (host, day) pairs first: the join works on
those, however many captures a popular host has, and the verdict is joined
back (a hot host is split like any skewed join key).  Entries are collapsed
to one per list, domain and day, so the interval window of a domain holds at
most as many rows as there are days.

Defined cases: a null or unparsable URL has no host and matches no list; a
null day matches nothing; entries with a null list, domain, action or day are
ignored; of several entries on one day for a list and domain `remove` wins
(the safe reading of a correction on the same day); repeated captures each
get the verdict; empty tables are fine; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOREVER = "9999-12-31"


def url_host(url: Column) -> Column:
    """Lower-case host of a URL without user, port and trailing dot; null if none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.rtrim(host, F.lit("."))
    return F.when(host != "", host)


def host_suffixes(host: Column) -> Column:
    """All domains covering a host: itself and every parent domain."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, valid_from, valid_to) from entries (list, domain, action, day).

    Half-open day intervals in which the domain is on the list.
    """
    days = (
        entries.where("list is not null and domain is not null and action is not null and day is not null")
        .groupBy("list", F.lower("domain").alias("domain"), F.col("day").cast("date").alias("day"))
        .agg(F.max("action").alias("action"))  # 'remove' sorts after 'add'
    )
    order = Window.partitionBy("list", "domain").orderBy("day")
    return (
        days.withColumn("valid_to", F.coalesce(F.lead("day").over(order), F.lit(FOREVER).cast("date")))
        .where("action = 'add'")
        .select("list", "domain", F.col("day").alias("valid_from"), "valid_to")
    )


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, url, fetch_day, host, n_lists, lists, blocked) of captures (page_id, url, fetch_day)."""
    pages = captures.select(
        captures["page_id"], captures["url"], captures["fetch_day"].cast("date").alias("fetch_day"),
        url_host(captures["url"]).alias("host"),
    )
    asked = pages.where("host is not null and fetch_day is not null").select("host", "fetch_day").distinct()
    spans = validity_intervals(entries)
    hits = (
        asked.withColumn("domain", F.explode(host_suffixes(F.col("host"))))
        .join(spans, "domain")
        .where("fetch_day >= valid_from and fetch_day < valid_to")
        .groupBy("host", "fetch_day")
        .agg(F.array_sort(F.collect_set("list")).alias("lists"))
    )
    return pages.join(hits, ["host", "fetch_day"], "left").select(
        "page_id", "url", "fetch_day", "host",
        F.when(F.col("lists").isNull(), 0).otherwise(F.size("lists")).cast("int").alias("n_lists"),
        F.coalesce(F.array_join("lists", ","), F.lit("")).alias("lists"),
        F.col("lists").isNotNull().alias("blocked"),
    )


def derived_entries(pages: DataFrame) -> DataFrame:
    """Dated entries made from the hosts of a page table.

    The tables hold no lists, so the query derives some from the data: each
    domain (the last three labels of a host) with a hyphen enters a list named
    by its first letter, leaves it and returns, on days that follow from its
    least page_id and number of pages.
    """
    host = url_host(F.col("url"))
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    d = (
        pages.select("page_id", domain.alias("domain")).where("domain like '%-%.%'")
        .groupBy("domain").agg(F.min("page_id").alias("k"), F.count("*").alias("n"))
    )
    first = F.expr("cast(pmod(k * 13, 120) as int)")
    stay = F.expr("cast(40 + pmod(n, 50) as int)")
    change = F.array(
        F.struct(F.lit("add").alias("action"), first.alias("offset")),
        F.struct(F.lit("remove").alias("action"), (first + stay).alias("offset")),
        F.struct(F.lit("add").alias("action"), (first + 2 * stay).alias("offset")),
    )
    return d.withColumn("c", F.explode(change)).select(
        F.concat(F.lit("list-"), F.substring("domain", 1, 1)).alias("list"), "domain", "c.action",
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("c.offset")).alias("day"),
    )


def derived_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day that follows from the page_id."""
    return pages.select(
        "page_id", "url",
        F.date_add(F.lit("2024-01-01").cast("date"), F.expr("cast(pmod(page_id * 7919, 365) as int)")).alias("fetch_day"),
    )
