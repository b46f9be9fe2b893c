"""URL filters: dated list entries become validity intervals; captures meet those active at fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)"
#: Intervals are cut into pieces of so many days, so that a capture meets only those of its time.
PIECE_DAYS = 32


def host_of(url: Column) -> Column:
    """Lower-case host, without the dot that may end it, an IPv6 address in its brackets; null where there is none."""
    return F.nullif(F.rtrim(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(".")), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals (domain, action, list, valid_from, valid_to) of dated entries.

    An entry (list, domain, action, listed_on) holds from its day until the
    next entry of that list for that domain; ``unlist`` only ends what was
    there. Entries of one day: the last of block, allow, unlist counts. The
    history of a domain on one list is ordered as a running maximum from
    the end would be: one window by (list, domain) over distinct days.
    Entries with a null field are left out.
    """
    rank = F.array_position(F.array(*map(F.lit, ["block", "allow", "unlist"])), F.col("action"))
    day = (
        entries.select("list", F.rtrim(F.lower("domain"), F.lit(".")).alias("domain"), "action", "listed_on")
        .dropna()
        .groupBy("list", "domain", "listed_on")
        .agg(F.max_by("action", rank).alias("action"))
    )
    following = F.lead("listed_on").over(Window.partitionBy("list", "domain").orderBy("listed_on"))
    return (
        day.select("domain", "action", "list", F.col("listed_on").alias("valid_from"), following.alias("valid_to"))
        .filter("action != 'unlist'")
    )


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (url, fetched_on) with host, list_action, list_domain and ``kept``.

    A capture is under the entries for its host and the host's parent domains
    that are active on its day. The longest domain decides; of equal ones
    ``block`` goes before ``allow``. ``kept`` is false under ``block``, and
    where there is no host (null or unreadable url). Without a day no entry is
    active. Rows that repeat are all returned, alike.

    All captures of one host and day meet the lists as one row, so a host with
    a third of all captures is no hot key; interval pieces of PIECE_DAYS days
    make the join an equality of (domain, piece), from the first capture's piece
    to the last one's. The verdicts go back to the
    captures by (host, day), where adaptive execution may split or broadcast.
    """
    names = [c for c in captures.columns if c not in ("host", "list_action", "list_domain", "kept")]
    hosted = captures.select(*names).withColumn("host", host_of(F.col("url")))
    days = hosted.select("host", "fetched_on").dropna().distinct()
    piece = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / PIECE_DAYS)
    labels = F.split("host", r"\.", -1)
    asked = days.select(
        "host", "fetched_on", piece(F.col("fetched_on")).alias("piece"),
        F.explode(F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )).alias("domain"),
    )
    ends = days.agg(F.struct(F.min("fetched_on").alias("first"), F.max("fetched_on").alias("last")))
    seen = (F.col("valid_from") <= F.col("__ends.last")) & F.coalesce(F.col("valid_to") > F.col("__ends.first"), F.lit(True))
    pieces = intervals(entries).withColumn("__ends", ends.scalar()).filter(seen).select(
        "domain", "action", "valid_from", "valid_to",
        F.explode(F.sequence(
            piece(F.greatest("valid_from", "__ends.first")), piece(F.least("valid_to", "__ends.last")),
        )).alias("piece"),
    )
    active = asked.join(pieces, ["domain", "piece"]).filter(
        (F.col("valid_from") <= F.col("fetched_on"))
        & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    )
    verdict = (
        active.groupBy("host", "fetched_on")
        .agg(F.max(F.struct(F.length("domain"), F.col("action") == "block", "domain", "action")).alias("best"))
        .select(
            F.col("host").alias("__host"), F.col("fetched_on").alias("__day"),
            F.col("best.action").alias("list_action"), F.col("best.domain").alias("list_domain"),
        )
    )
    on = (F.col("host") == F.col("__host")) & (F.col("fetched_on") == F.col("__day"))
    blocked = F.coalesce(F.col("list_action") == "block", F.lit(False))
    return hosted.join(verdict, on, "left").drop("__host", "__day").withColumn(
        "kept", F.col("host").isNotNull() & ~blocked
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """The pages as captures of 2024; the table has no fetch time, so the day follows from the id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated entries made from the hosts of the pages: every host's history, and its parent domain's."""
    hosts = (
        pages.select(host_of(F.col("url")).alias("host"), "page_id").dropna()
        .groupBy("host").agg(F.min("page_id").alias("low"), F.max("page_id").alias("high"))
    )
    on = lambda x: F.date_add(F.lit("2023-12-01").cast("date"), F.pmod(x, F.lit(396)).cast("int"))
    low, high, host = F.col("low"), F.col("high"), F.col("host")
    rows = F.array(*[
        F.struct(F.lit(l).alias("list"), d.alias("domain"), F.lit(a).alias("action"), t.alias("listed_on"))
        for l, d, a, t in [
            ("spam", host, "block", on(low * 7 + 3)),
            ("spam", host, "unlist", on(low * 7 + 150)),
            ("spam", host, "block", on(high * 11 + 40)),
            ("trusted", host, "allow", on(high * 5 + 9)),
            ("adult", F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), "block", on(high * 13)),
            ("adult", F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), "unlist", on(high * 13 + 20)),
        ]
    ])
    return hosts.select(F.inline(rows)).filter("domain != ''")


def query(spark, sf_dir) -> DataFrame:
    from registrar.llm.common import table

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return evaluate(captures_of(pages), entries_of(pages)).select(
        "page_id", "host", "fetched_on", "list_action", "list_domain", "kept"
    )


SQL = r"""
WITH page AS (
    SELECT page_id, nullif(rtrim(lower(regexp_extract(url,
               '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)', 1)), '.'), '') AS host,
           DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INTEGER) AS fetched_on
    FROM pages
), host AS (
    SELECT host, min(page_id) AS low, max(page_id) AS high, regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS parent
    FROM page WHERE host IS NOT NULL GROUP BY host
), made AS (
    SELECT 'spam' AS list, host AS domain, 'block' AS action, low * 7 + 3 AS k FROM host
    UNION ALL SELECT 'spam', host, 'unlist', low * 7 + 150 FROM host
    UNION ALL SELECT 'spam', host, 'block', high * 11 + 40 FROM host
    UNION ALL SELECT 'trusted', host, 'allow', high * 5 + 9 FROM host
    UNION ALL SELECT 'adult', parent, 'block', high * 13 FROM host
    UNION ALL SELECT 'adult', parent, 'unlist', high * 13 + 20 FROM host
), entry AS (
    SELECT list, domain, DATE '2023-12-01' + CAST(k % 396 AS INTEGER) AS listed_on,
           max(CASE action WHEN 'block' THEN 1 WHEN 'allow' THEN 2 ELSE 3 END) AS rank
    FROM made WHERE domain <> '' GROUP BY ALL
), span AS (
    SELECT *, lead(listed_on) OVER (PARTITION BY list, domain ORDER BY listed_on) AS ended_on FROM entry
), day AS (
    SELECT DISTINCT host, fetched_on FROM page WHERE host IS NOT NULL
), best AS (
    SELECT host, fetched_on, domain, rank FROM day JOIN span
    ON (host = domain OR suffix(host, '.' || domain)) AND rank < 3
       AND listed_on <= fetched_on AND (ended_on IS NULL OR fetched_on < ended_on)
    QUALIFY row_number() OVER (PARTITION BY host, fetched_on ORDER BY length(domain) DESC, rank) = 1
)
SELECT page_id, page.host, page.fetched_on, CASE rank WHEN 1 THEN 'block' WHEN 2 THEN 'allow' END AS list_action,
       domain AS list_domain, page.host IS NOT NULL AND coalesce(rank, 0) <> 1 AS kept
FROM page LEFT JOIN best ON page.host = best.host AND page.fetched_on = best.fetched_on
"""
