"""URL filters as a temporal join with dated lists.

A list is a log of (entry, category, day, action): from `add` to the next `remove` the entry is active. The log becomes
validity intervals [from_day, to_day), and every capture is judged by the intervals that hold on the day it was fetched
(an as-of join), so a page is not judged by entries made later or withdrawn before.

Entries are a host with everything below it (`example.org`) or a path below a host (`example.org/a/`). A capture meets
its host, every parent of it, and every directory of its path. It is blocked if any entry is active; the longest active
entry is reported, then the first category by name.

On one day a `remove` outweighs an `add`; further adds of an active entry change nothing; an entry that is never removed
stays. Rows of the log with a null entry, day or action have no effect, a null category is a category. Hosts are compared
in lower case, also an entry's, paths as they are; scheme, user, port, query and fragment don't matter. A null or unreadable URL, or a null day, is not
blocked. Repeated captures keep a row each. Captures meet the list as distinct (URL, day), and first as distinct
(candidate, day): a common host is looked up once a day, however many captures it has. Empty tables give empty results
or nothing blocked. Other columns of the captures stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def candidates(url: Column) -> Column:
    """The entries that could hold for a URL: the host and its parents, and host/dir/ for each directory."""
    labels = F.split(host(url), r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    dirs = F.split(F.regexp_extract(url, _PATH, 1), "/")
    n_dirs = F.size(dirs) - 2
    paths = F.transform(F.sequence(F.lit(1), n_dirs), lambda i: F.concat(host(url), F.array_join(F.slice(dirs, F.lit(1), i + 1), "/"), F.lit("/")))
    paths = F.when(n_dirs > 0, paths).otherwise(F.array().cast("array<string>"))
    return F.when(host(url) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(parents, paths)))


def _entry(entry: Column) -> Column:
    """The entry with its host in lower case."""
    return F.concat(F.lower(F.substring_index(entry, "/", 1)), F.regexp_extract(entry, r"(?s)^[^/]*(.*)$", 1))


def intervals(events: DataFrame) -> DataFrame:
    """entry, category, from_day, to_day (null: still active) of a log (entry, category, day, action)."""
    per_day = (
        events.filter(F.col("entry").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove"))
        .groupBy(_entry(F.col("entry")).alias("entry"), "category", F.col("day").cast("date").alias("day"))
        .agg(F.max("action").alias("action"))
    )
    # One row per entry and day.
    in_time = Window.partitionBy("entry", "category").orderBy("day")
    changes = per_day.withColumn("_before", F.lag("action").over(in_time)).filter(F.coalesce("_before", F.lit("remove")) != F.col("action"))
    return (
        changes.withColumn("to_day", F.lead("day").over(in_time))
        .filter("action = 'add'")
        .select("entry", "category", F.col("day").alias("from_day"), "to_day")
    )


def filter_urls(captures: DataFrame, events: DataFrame) -> DataFrame:
    """`captures` (with url, fetched_on) with blocked, entry, category, listed_on, in place of columns so named."""
    keys = captures.filter("url IS NOT NULL AND fetched_on IS NOT NULL").select(F.col("url").alias("_url"), F.col("fetched_on").cast("date").alias("_on")).distinct()
    tried = keys.withColumn("_entry", F.explode(candidates(F.col("_url"))))
    active = (
        tried.select("_entry", "_on")
        .distinct()
        .join(
            intervals(events),
            (F.col("_entry") == F.col("entry")) & (F.col("from_day") <= F.col("_on")) & (F.col("to_day").isNull() | (F.col("_on") < F.col("to_day"))),
        )
        .groupBy("_entry", "_on")
        .agg(F.min(F.struct(F.coalesce("category", F.lit("")).alias("name"), "category", "from_day")).alias("hit"))
    )
    best = (
        tried.join(active, ["_entry", "_on"])
        .groupBy("_url", "_on")
        .agg(F.min(F.struct((-F.length("_entry")).alias("n"), "_entry", "hit")).alias("hit"))
    )
    # The captures' own columns stay in one struct, whatever their names.
    rows = captures.select(F.struct("*").alias("row"))
    same = (F.col("row.url") == F.col("_url")) & (F.col("row.fetched_on").cast("date") == F.col("_on"))
    return rows.join(best, same, "left").select(
        *[F.col("row")[c].alias(c) for c in captures.columns if c not in ("blocked", "entry", "category", "listed_on")],
        F.col("hit").isNotNull().alias("blocked"),
        F.col("hit._entry").alias("entry"),
        F.col("hit.hit.category").alias("category"),
        F.col("hit.hit.from_day").alias("listed_on"),
    )


def fetch_day(page_id: Column) -> Column:
    """The pages carry no fetch time: page n counts as fetched on day n mod 365 of 2024."""
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(page_id, F.lit(365)).cast("int"))


def list_events(pages: DataFrame) -> DataFrame:
    """A dated list made from the pages' own hosts and first directories; digits of an entry's MD5 set its category and days.

    One entry in four is listed, withdrawn later if its third digit is even, and listed again if that is 0 to 4 too.
    """
    at = host(F.col("url"))
    first_dir = F.concat(at, F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*(/[^/?#]+/)", 1))
    entry = F.explode(F.array_distinct(F.array(at, F.regexp_replace(at, r"^www\.", ""), first_dir)))
    digit = lambda i: F.conv(F.substring(F.md5("entry"), i, 1), 16, 10).cast("int")
    entries = pages.select(entry.alias("entry")).filter("entry != ''").distinct().withColumns({f"d{i}": digit(i) for i in range(1, 6)})
    listed = entries.filter("d1 < 4")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    first = F.col("d2") * 8 + F.col("d4")
    rows = [F.struct(day(first).alias("day"), F.lit("add").alias("action"), F.lit(True).alias("made"))]
    even, again = F.col("d3") % 2 == 0, (F.col("d3") % 2 == 0) & (F.col("d3") <= 4)
    rows.append(F.struct(day(first + 30 + F.col("d5") * 6).alias("day"), F.lit("remove").alias("action"), even.alias("made")))
    rows.append(F.struct(day(first + 150 + F.col("d5") * 6).alias("day"), F.lit("add").alias("action"), again.alias("made")))
    category = F.element_at(F.array(*map(F.lit, ("spam", "adult", "malware", "gambling"))), F.col("d1") + 1)
    return listed.select("entry", category.alias("category"), F.inline(F.array(*rows))).filter("made").drop("made")
