"""What keeps the cost of a query in step with its input: dealt-out rows, literals before patterns, values bound once."""

import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomspark.functions.rounding import matches, needles
from loomspark.operators import discovery, merge, rank, report, scanners
from loomspark.operators import extract as ex

SF = "/root/testdata/sf0.001"

PATTERNS = [report.STATEMENT, report.BOUNDARY, report.SEGMENT, report.HIGHLIGHTS, report.MEETING, report.SMALL_WORDS, rank.CLASS_OTHER, discovery.ANNUAL_CONTEXT, discovery.BINARY]
PATTERNS += [p for rules in (rank.TEXT_POSITIVE, rank.TEXT_NEGATIVE, rank.URL_RULES, scanners.BROWSER_BOTH, scanners.WIRE_URL, scanners.IR_TEXT) for p, _ in rules]
TEXTS = [
    "Annual and Sustainability Report 2024", "ÅRSREDOVISNING", "Års- och hållbarhetsredovisning", "q3 interim", "M&A presentation", "Mergers and acquisitions: a presentation", "acqisition-present.pdf?x",
    "Consolidated statement of comprehensive income", "Koncernens resultaträkning 12", "Rapport över det samlade resultatet", "Notes to the financial statements", "Key figures", "I korthet", "postal  voting", "post-vote",
    "Notice of the annual meeting", "nomination committee's", "corp-gov", "x_PR_y", "/agm", "bolagsstamma", "we do", "integrated report", "a.xlsx", "Fact book", "pillar 3", "financial reports", "profit & loss statement", "",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_a_matching_text_holds_a_needle(pattern):
    rng = random.Random(1)
    for text in TEXTS + ["".join(rng.choice(TEXTS)[: rng.randrange(30)] for _ in range(3)) for _ in range(300)]:
        if re.search("(?i)" + pattern, text):
            assert not needles(pattern) or any(n in text.lower() for n in needles(pattern))


def test_odd_letters_match_as_before(spark):
    odd = TEXTS + ["CONſOLIDATED INCOME ſTATEMENT", "İnterım", "ÅRSREDOVISNING", "Kallelse", None]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").coalesce(1)
    for p in (report.STATEMENT, rank.TEXT_NEGATIVE[1][0], rank.TEXT_POSITIVE[1][0], r"\bkallelse\b", "x*"):
        got = rows.select(matches("t", p), F.coalesce("t", F.lit("")).rlike("(?iu)" + p)).collect()
        assert [r[0] for r in got] == [r[1] for r in got]
    assert needles("x*") == () and needles("a|") == () and needles("[") == ()


def tables(tmp_path):
    """The small tables as one row group each, which one task reads."""
    for t in ("customer", "part"):
        shutil.copy(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["report_sections", "report_fields"])
def test_rows_are_dealt_out(spark, tmp_path, name):
    assert entry.queries()[name](spark, tables(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_a_reports_places_are_found_once(spark):
    docs = spark.createDataFrame([(1, "Consolidated income statement\na\nb\nc\nd\ne")], "doc_id long, text string")
    places = docs.select(report.report_lines(F.col("text")).alias("lines")).select(report.structure(F.col("lines")).alias("p"))
    plan = places.select(F.size("p.sections"), F.get("p.sections", F.lit(0))["first"], F.size("p.marks"), F.size("p.highlights"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("segmentinformation") == 1
    assert places.select("p.*").first()[0][0].asDict() == {"first": 0, "stop": 6, "parent": False}


def test_a_labelled_line_is_read_once(spark):
    lines = report.report_lines(F.lit("Net sales  100  90\nother"))
    assert [h["pass_no"] for h in spark.range(1).select(ex.label_hits(lines, ["net sales"]).alias("h")).first()["h"]] == [0]
    assert [x["no"] for x in spark.range(1).select(ex.labelled_lines(lines, ["net sales", "ebit"]).alias("h")).first()["h"]] == [0]


def test_union_first_keeps_a_row_a_key_by_hash(spark):
    big, small = 2**63 - 1, -(2**63)
    one = spark.createDataFrame([("a", 5, 1), ("a", None, 2), ("b", big, 3), (None, 1, 4)], "k string, o long, v int")
    two = spark.createDataFrame([("b", small, 5), ("c", 2, 6), ("c", small, 7), ("c", 3, 8), (None, None, 9)], "k string, o long, v int")
    found = merge.union_first([one, two], ["k"], "o")
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r["k"]: (r["o"], r["v"]) for r in found.collect()} == {"a": (None, 2), "b": (big, 3), None: (1, 4), "c": (small, 7)}
    assert found.columns == ["k", "o", "v"]
    # Texts beside the key go by the sorted way, with the same rows.
    texts = merge.union_first([p.withColumn("v", F.col("v").cast("string")) for p in (one, two)], ["k"], "o")
    assert {r["k"]: r["v"] for r in texts.collect()} == {"a": "2", "b": "3", None: "4", "c": "7"}


@pytest.mark.parametrize("name", ["page_scan", "page_candidates", "page_reports", "followed_pages"])
def test_the_first_stage_is_dealt_out(spark, tmp_path, name):
    plan = entry.queries()[name](spark, tables(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert f"RoundRobinPartitioning({4 * spark.sparkContext.defaultParallelism})" in plan


def test_addresses_and_answers_meet_in_one_sort(spark, tmp_path):
    plan = entry.queries()["investor_page"](spark, tables(tmp_path))._jdf.queryExecution().executedPlan().toString()
    # One sort by address and two by company; a join below the union sorts for each of its branches in the same task.
    assert "Join" not in plan and len(re.findall(r"[ -]Sort \[", plan)) == 3
    assert {int(n) for n in re.findall(r"hashpartitioning\(url#\d+, (\d+)\), REPARTITION_BY_NUM", plan)} == {4 * spark.sparkContext.defaultParallelism}


def test_investor_tiers_of_odd_rows(spark):
    rng = random.Random(7)
    # A site is shared by companies; the log holds misses, repeats, an address many times and one that is null.
    site = lambda k: f"https://s{k % 5}.example"
    texts = {"Investor relations": 10 + 6, "Investors": 8 + 6, "Contact": -5, None: 0}
    links = [(k, site(k), rng.choice([f"{site(k)}/l{rng.randrange(4)}", "https://other.example/l0", None]), rng.choice(list(texts)), n) for k in range(20) for n in range(4)]
    paths = [(k, rng.choice([f"{site(k)}/p{n}", None]), n) for k in range(20) for n in range(2)]
    maps = [(k, f"{site(k)}/m", 0) for k in range(25)]
    log = [(f"https://s{i}.example/{p}", rng.choice(["Annual report", "nothing", "in 2025", None]), rng.choice([200, 200, 404])) for i in range(5) for p in ("l0", "l1", "p0", "p1", "m") for _ in range(2)]
    log += [(None, "annual report", 200)] + [("https://s0.example/m", "annual report", 200)] * 5000
    good = {u for u, body, status in log if u and status == 200 and body in ("Annual report", "annual report", "in 2025")}
    tried = [(k, 0, -texts[t], n, u) for k, home, u, t, n in links if u and u.startswith(home) and texts[t] >= 3] + [(k, 1, -max(5, 14), n, u) for k, u, n in paths if u] + [(k, 2, 0, n, u) for k, u, n in maps]
    want = {}
    for k, *x in tried:
        if x[-1] in good:
            want[k] = min(want.get(k, x), x)
    frames = [spark.createDataFrame(r, s) for r, s in ((links, "company_id int, home string, url string, text string, ord int"), (paths, "company_id int, url string, ord int"), (maps, "company_id int, url string, ord int"), (log, "url string, body string, status int"))]
    got = discovery.investor_tiers(frames[0], "home", *frames[1:], 2025)
    assert got.columns == ["company_id", "url", "tier", "score"]
    rows = got.collect()
    assert len(rows) == len(want) and {r["company_id"]: (discovery.TIERS.index(r["tier"]), -r["score"], r["url"]) for r in rows} == {k: (t, s, u) for k, (t, s, _, u) in want.items()}
    assert {t for t, *_ in want.values()} == {0, 1, 2}
