"""Discovery over snapshots: report candidates of scanned pages, investor pages by tiers, publication hubs, search results.

Pages come from a fetch log or a table; nothing is fetched here. A page is parsed once, in Arrow batches; points and choices are columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions import urls
from loomspark.functions.rounding import matches
from loomspark.functions.urls import resolve_text
from loomspark.operators import rank
from loomspark.operators.scanners import PDF, ir_points

_SCAN = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("base", T.StringType()),
        T.StructField("ord", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("heading", T.StringType()),
        T.StructField("near", T.StringType()),
    ]
)
# Patterns, paths, and the characters about an address that count as its context.
BINARY = r"\.(zip|xlsx?|docx?|pptx?|csv|png|jpg|jpeg|gif|svg|mp4|mp3)(\?|$)"
OPAQUE_HOSTS = r"sanity\.io|cloudinary\.com|ctfassets\.net|prismic\.io|contentful\.com"
ANNUAL_CONTEXT = r"annual\s*(and\s*sustainability\s*)?report|årsredovisning|integrated\s*(annual\s*)?report|financial\s*statements|koncernredovisning|arsredovisning|års-?\s*och\s*hållbarhets"
CONTEXT = 550
#: The last one has a word boundary that knows ASCII letters alone, so it stands after one of them.
SUB_PAGE_TEXT = (r"\breports?\b", r"\bpublications?\b", r"\bdocuments?\b", r"\barchive\b", r"\bfinancial\s*information\b", r"\brapporter\b", r"\bpublikationer\b", r"\bannual\s*report", r"(?<=[0-9A-Za-z_])årsredovisning")
HUB_PATHS = (
    "/investor-relations/reports-and-publications",
    "/investor-relations/reports-and-presentations",
    "/investor-relations/financial-reports",
    "/investors/reports",
    "/investors/financial-reports",
    "/our-offering/reports-and-publications",
    "/en/investor-relations/reports-and-publications",
    "/en/investors/reports",
    "/about/investors/reports",
    "/investor-relations/annual-reports",
    "/investors/annual-reports",
    "/reports-and-publications",
    "/financial-reports",
)
_EMBEDDED = re.compile(r"https?://[^\s\"'<>]+?\.pdf(?:\?[^\s\"'<>]*)?", re.I)
_ESCAPED = re.compile(r"https?:\\/\\/[^\s\"'<>]+?\.pdf(?:\\/\?[^\s\"'<>]*)?", re.I)
_HEADINGS = ("h1", "h2", "h3", "h4")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
LEVELS = 8


class _Anchors(HTMLParser):
    """Anchors in order with their text, and of each of the eight levels around them the nearest heading before that level."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        #: Of each open element its name and the latest heading among its children.
        self.open: list[list] = [["", None]]
        self.found: list[tuple[str, list[str], list[str]]] = []
        self.anchor: list[str] | None = None
        self.heading: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            return
        if tag == "a":
            self._end_anchor()
            href = dict(attrs).get("href")
            if href:
                self.anchor = []
                around = [e[1] for e in reversed(self.open[:-1])][:LEVELS]
                self.found.append((href, self.anchor, [h for h in around if h]))
        self.open.append([tag, None])
        if tag in _HEADINGS:
            self.heading = []

    def _end_anchor(self) -> None:
        self.anchor = None

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self._end_anchor()
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i][0] == tag), None)
        if at is None:
            return
        del self.open[at:]
        if tag in _HEADINGS and self.heading is not None:
            self.open[-1][1] = " ".join("".join(self.heading).split())
            self.heading = None

    def handle_data(self, data: str) -> None:
        if self.anchor is not None:
            self.anchor.append(data)
        if self.heading is not None:
            self.heading.append(data)


def scan_text(html: str | None, base: str | None) -> list[tuple[str, str, str, str | None, str | None]]:
    """(kind, url, text, headings, context) of a page's anchors, then of the PDF addresses in its text, then of the escaped ones; each address once."""
    out, seen = [], set()
    html = html or ""
    page = _Anchors()
    page.feed(html)
    page.close()
    for href, text, headings in page.found:
        url = resolve_text(base, href)
        if url and url not in seen:
            seen.add(url)
            out.append(("anchor", url, " ".join("".join(text).split()), "\n".join(headings) or None, None))
    for kind, pattern in (("embedded", _EMBEDDED), ("escaped", _ESCAPED)):
        for m in pattern.finditer(html):
            url = m[0].replace("\\/", "/")
            if url not in seen:
                seen.add(url)
                near = f"{html[max(0, m.start() - CONTEXT) : m.start() + len(url) + CONTEXT]} {url}"
                out.append((kind, url, {"embedded": "Embedded PDF URL", "escaped": "Embedded escaped PDF URL"}[kind], None, near))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            pages = part.column(2)
            rows = [(i, base, n, *x) for k, (i, base) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)) for n, x in enumerate(scan_text(pages[k].as_py(), base))]
            kinds = (pa.int64(), pa.string(), pa.int32(), *[pa.string()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)], names=_SCAN.names)


def scan_pages(pages: DataFrame, page_id: str = "page_id", base: str = "url", html: str = "html") -> DataFrame:
    """``page_id, base, ord, kind, url, text, heading, near``: the candidates of each page in order, addresses resolved. No shuffle; memory is one page."""
    return pages.select(F.col(page_id).cast("long"), F.col(base).cast("string"), F.col(html).cast("string")).mapInArrow(_scan, _SCAN)


def embedded_points(base_points: Column, url: Column, base: Column, near: Column) -> Column:
    """A PDF address in a page's text keeps its points on the page's own site; on a content network's host, whose file names say nothing, it has 10 more if the annual report is spoken of
    nearby, and else 1 at most."""
    opaque = matches(urls.host(url), OPAQUE_HOSTS)
    host, own = F.regexp_replace(urls.host(url), r"^www\.", ""), F.regexp_replace(urls.host(base), r"^www\.", "")
    same = (host == own) | host.endswith(F.concat(F.lit("."), own))
    return F.when(F.coalesce(same, F.lit(False)) | ~opaque, base_points).when(matches(near, ANNUAL_CONTEXT), base_points + 10).otherwise(F.least(base_points, F.lit(1)))


def report_candidates(scanned: DataFrame, as_of_year: int) -> DataFrame:
    """The scan with ``score``; stale candidates are left out, texts cut at 150 characters."""
    url, text = F.col("url"), F.col("text")
    floor = F.when(F.col("kind") == "embedded", 3).otherwise(4)
    alone = F.greatest(floor, rank.url_score(url, as_of_year) + rank.year_points(rank.latest_year(url), as_of_year))
    inside = embedded_points(alone, url, F.col("base"), F.col("near"))
    score = F.when(F.col("kind") == "anchor", rank.link_score(text, url, as_of_year, F.col("heading"))).otherwise(inside)
    hay = F.when(F.col("kind") == "anchor", text).otherwise(url)
    rows = scanned.where(~F.coalesce(rank.stale(url, hay, as_of_year), F.lit(False)))
    return rows.select("page_id", "base", "ord", "kind", "url", F.substring(text, 1, 150).alias("text"), score.cast("int").alias("score"))


def sub_pages(scanned: DataFrame, most: int = 5) -> DataFrame:
    """The best links to follow of each page: report wording, no file."""
    text = F.lower("text")
    points = (
        sum((F.when(matches(text, p), 5).otherwise(0) for p in SUB_PAGE_TEXT), F.lit(0))
        + F.when(matches(text, "annual"), 3).otherwise(0)
        + F.when(matches("url", "investor"), 2).otherwise(0)
        + F.when(matches(text, "calendar|event|press|news|contact|career|cookie|privacy"), -10).otherwise(0)
    )
    rows = scanned.where((F.col("kind") == "anchor") & ~matches("url", PDF) & ~matches("url", BINARY) & (F.col("url") != F.col("base"))).withColumn("points", points).where("points >= 5")
    order = Window.partitionBy("page_id").orderBy(F.desc("points"), "ord")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("page_id", "url", "points", "rank")


def report_discovery(candidates: DataFrame, key: str = "page_id", most: int = 10) -> DataFrame:
    """Per company or page its report: ``url, fiscal_year, confidence, considered`` and the best ``most`` candidates.

    Of equal addresses the best score counts, the first of equals; what is no PDF needs 25 points. Annual-like candidates go first. Confidence is low under 8 points, medium at a lead of 3 or less.
    """
    best = candidates.groupBy(key, "url").agg(F.max_by(F.struct("ord", "text", "score"), F.struct("score", -F.col("ord"))).alias("b")).select(key, "url", "b.*")
    kept = best.where(matches("url", PDF) | (F.col("score") >= 25))
    ranked = rank.rank_class_first(kept, key)
    lists = ranked.groupBy(key).agg(
        F.count(F.lit(1)).alias("considered"),
        F.array_sort(F.collect_list(F.when(F.col("rank") <= most, F.struct("rank", "url", "score", "text")))).alias("top"),
    )
    first, second = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    level = F.when(first["score"] < 8, "low").when(second.isNotNull() & (first["score"] - second["score"] <= 3), "medium").otherwise("high")
    year = F.coalesce(rank.latest_year(first["text"]), rank.latest_year(first["url"]))
    return lists.select(key, first["url"].alias("url"), year.alias("fiscal_year"), level.alias("confidence"), "considered", F.transform("top", lambda t: t["url"]).alias("candidates"))


def investor_page_valid(html: Column, as_of_year: int) -> Column:
    """A page that links a PDF, speaks of the annual report, or names this year or the last."""
    years = html.contains(str(as_of_year)) | html.contains(str(as_of_year - 1))
    return F.coalesce(matches(html, r"href\s*=\s*[\"'][^\"']*\.pdf") | matches(html, "annual report|årsredovisning") | years, F.lit(False))


def investor_page_wording(url: Column, title: Column) -> Column:
    """Search results that are investor pages by their wording."""
    both = F.concat_ws(" ", url, title)
    return matches(both, "investor.?relations|investerare") | matches(url, r"/investors?\b") | (matches(both, "annual.report") & ~matches(url, r"\.pdf"))


#: The ways to an investor page, the first one first.
TIERS = ("homepage", "paths", "sitemap")


def investor_tiers(links: DataFrame, homepage: str, paths: DataFrame, sitemap: DataFrame, fetches: DataFrame, as_of_year: int, key: str = "company_id") -> DataFrame:
    """``key, url, tier, score``: the first address that holds, homepage links of 3 points or more by points, then usual paths, then the sitemap.

    ``links`` has key, url, text, ord; ``paths`` and ``sitemap`` have key, url, ord; ``fetches`` (url, body, status) answers whether an address is an investor page.
    """
    place = lambda n: F.lit(n).alias("_tier")
    home = links.where(urls.same_site(F.col(homepage), F.col("url"))).select(key, "url", place(0), ir_points(F.col("text"), F.col("url")).alias("score"), "ord").where("score >= 3")
    usual = paths.select(key, "url", place(1), F.greatest(F.lit(5), ir_points(F.lit("investors"), F.col("url"))).alias("score"), "ord")
    maps = sitemap.select(key, "url", place(2), F.lit(0).alias("score"), "ord")
    spark = fetches.sparkSession
    # By number, since a few megabytes of short rows that compress well would become one task, whatever they weigh in memory.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    # An address that was fetched very often is dealt out by salt and leaves one row of each.
    good = fetches.where((F.col("status") == 200) & F.isnotnull("url") & investor_page_valid(F.col("body"), as_of_year)).select("url", F.pmod(F.monotonically_increasing_id(), F.lit(16)).alias("_salt"))
    good = good.repartition(parts, "url", "_salt").distinct().select("url", F.lit(True).alias("_good"))
    # Addresses and answers meet in one sort. A semi-join would be pushed below the union, and a task would sort and hash for all its joins at a time.
    tries = home.unionByName(usual).unionByName(maps).where("url IS NOT NULL")
    rows = tries.unionByName(good, allowMissingColumns=True).repartition(parts, "url")
    holds = F.max("_good").over(Window.partitionBy("url"))
    tried = rows.withColumn("_holds", holds).where("_holds AND _tier IS NOT NULL")
    best = tried.groupBy(key).agg(F.min(F.struct("_tier", (-F.col("score")).alias("_less"), "ord", "url")).alias("b"))
    return best.select(key, "b.url", F.get(F.array(*map(F.lit, TIERS)), F.col("b._tier")).alias("tier"), (-F.col("b._less")).alias("score"))


def hub_addresses(companies: DataFrame, fetches: DataFrame, most: int = 8) -> DataFrame:
    """``company_id, url``: the publication pages of each origin that the log has answered, of the first ``most`` paths."""
    origin = F.regexp_extract(F.when(F.col("website").rlike("(?i)^http"), F.col("website")).otherwise(F.concat(F.lit("https://"), "website")), r"^(https?://[^/?#]+)", 1)
    asked = companies.select("company_id", F.explode(F.array(*(F.concat(origin, F.lit(p)) for p in HUB_PATHS[: max(1, most)]))).alias("url"))
    return asked.join(fetches.where("status < 400").select("url").distinct(), "url", "left_semi").select("company_id", "url").distinct()


def search_results(results: DataFrame, engines: tuple[str, ...]) -> DataFrame:
    """Of each query the results of the first engine that has any, each address once, in order. ``results`` has query, engine, ord, url, title, snippet."""
    place = F.array_position(F.array(*map(F.lit, engines)), F.col("engine"))
    rows = results.withColumn("_e", place).where("_e > 0")
    first = rows.groupBy("query").agg(F.min("_e").alias("_first"))
    kept = rows.join(first, "query").where(F.col("_e") == F.col("_first"))
    once = kept.groupBy("query", "engine", "url").agg(F.min_by(F.struct("ord", "title", "snippet"), "ord").alias("b"))
    return once.select("query", "engine", "url", "b.*")


def rendered_skip(url: Column, enabled: bool, disabled_hosts: tuple[str, ...]) -> Column:
    """Whether the browser is not used: it is off, or the host is on the list."""
    host = F.regexp_replace(urls.host(url), r"^www\.", "")
    return F.lit(not enabled) | F.coalesce(host.isin(*disabled_hosts) if disabled_hosts else F.lit(False), F.lit(False))


#: Sites about companies, which are no company's own.
PORTALS = r"bing|google|duckduckgo|youtube|facebook|twitter|linkedin|allabolag|avanza|nasdaq|bloomberg|wikipedia|reuters|ft\.com|di\.se"


def corporate_domains(results: DataFrame, fetches: DataFrame, portals: str = PORTALS) -> DataFrame:
    """``company_id, url, host, score, rank``: a company's own sites among search results, best first.

    ``results`` has company_id, query_no, ord, url, title, snippet, slugs. PDF files, portals and hosts without any of the company's slugs are left out (without slugs any host is trusted), as are origins that the log
    hasn't answered. Of a host the first result counts: the lengths of the slugs it holds, 12 at most each, 8 more for investor wording, 4 for an official page.
    """
    host = F.regexp_replace(urls.host(F.col("url")), r"^www\.", "")
    rows = results.withColumn("host", host).where(F.col("host").isNotNull() & ~matches("url", PDF) & ~matches("host", portals))
    rows = rows.where((F.size("slugs") == 0) | F.exists("slugs", lambda s: F.col("host").contains(s)))
    rows = rows.withColumn("origin", F.concat(F.lower(F.regexp_extract("url", r"(?i)^(https?://[^/?#]+)", 1)), F.lit("/")))
    answered = fetches.where("status < 400").groupBy(F.col("url").alias("origin")).agg(F.first("final_url", ignorenulls=True).alias("final_url"))
    first = rows.join(answered, "origin").groupBy("company_id", "host").agg(F.min_by(F.struct("query_no", "ord", "origin", "final_url", "url", "title", "snippet", "slugs"), F.struct("query_no", "ord")).alias("b")).select("company_id", "host", "b.*")
    names = F.aggregate("slugs", F.lit(0), lambda a, s: a + F.when(F.col("host").contains(s), F.least(F.length(s), F.lit(12))).otherwise(0))
    blob = F.concat_ws(" ", "url", "title", "snippet")
    score = names + F.when(matches(blob, r"investor|investerare|ir\b|financial\s+reports"), 8).otherwise(0) + F.when(matches(blob, "official|corporate|homepage|hemsida"), 4).otherwise(0)
    order = Window.partitionBy("company_id").orderBy(F.desc("score"), "query_no", "ord")
    found = first.withColumn("score", score.cast("int")).withColumn("rank", F.row_number().over(order))
    return found.select("company_id", F.regexp_replace(F.coalesce("final_url", "origin"), "/$", "").alias("url"), "host", "score", "rank")
