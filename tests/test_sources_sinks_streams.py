import json

import pytest
from pyspark.sql import functions as F

from loomspark.operators import quality
from loomspark.sources import readers, writers
from loomspark.streaming import logs

RESULTS = [
    {"company": "Acme", "ticker": "A.ST", "status": "complete", "confidence": 90, "fiscalYear": 2024, "detectedCompanyType": "industrial", "dataSource": "pdf", "extractedData": {"revenue_msek": 10.0, "ebit_msek": 1.0, "employees": 5, "ceo": "A B"}, "extractionNotes": ["one", "two"]},
    {"company": "Bolt", "ticker": None, "status": "timeout", "extractedData": None, "extractionNotes": []},
]


@pytest.mark.parametrize("shape", ["envelope", "array", "broken", "missing"])
def test_read_results(spark, tmp_path, shape):
    path = tmp_path / "results.json"
    if shape != "missing":
        path.write_text({"envelope": json.dumps({"generatedAt": "x", "results": RESULTS}), "array": json.dumps(RESULTS), "broken": "{oops"}[shape])
    rows = readers.read_results(spark, str(path))
    if shape in ("broken", "missing"):
        assert rows.count() == 0
        return
    flat = readers.flat_results(rows)
    got = {r["company"]: r for r in quality.with_status(flat).collect()}
    assert got["Acme"]["status"] == "complete" and got["Acme"]["notes"] == "one | two" and got["Bolt"]["status"] == "timeout"


def test_read_registry(spark, tmp_path):
    path = tmp_path / "ticker.json"
    path.write_text(json.dumps({"A.ST": "Acme AB", "B.ST": {"name": "Bolt AB", "website": 7, "annualReportPdfUrls": ["https://x/a.pdf", "ftp://no"], "manual": {"revenue_msek": None, "employees": 12, "ceo": 5}}}))
    got = {r["ticker"]: r for r in readers.read_registry(spark, str(path)).collect()}
    assert got["A.ST"]["name"] == "Acme AB"
    b = got["B.ST"]
    assert (b["name"], b["website"], b["annual_report_pdf_urls"]) == ("Bolt AB", None, ["https://x/a.pdf"])
    assert (b["has_revenue_msek"], b["manual_revenue_msek"], b["manual_employees"], b["has_employees"], bool(b["has_ceo"]), bool(b["has_ebit_msek"])) == (True, None, 12.0, True, False, False)
    assert readers.read_registry(spark, str(tmp_path / "none.json")).count() == 0


def test_read_list(spark, tmp_path):
    (tmp_path / "a.json").write_text('[" A ", "", "B"]')
    assert sorted(r[0] for r in readers.read_list(spark, str(tmp_path / "a.json")).collect()) == ["A", "B"]
    (tmp_path / "b.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="JSON array"):
        readers.read_list(spark, str(tmp_path / "b.json")).collect()


def test_reports_sitemaps_and_json_urls(spark, tmp_path):
    (tmp_path / "good.pdf").write_bytes(b"%PDF-1.7" + b"x" * 2000)
    (tmp_path / "short.pdf").write_bytes(b"%PDF-1.7")
    (tmp_path / "page.pdf").write_bytes(b"<html>" + b"x" * 2000)
    got = readers.read_reports(spark, str(tmp_path)).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in got] == ["good.pdf"] and len(got[0]["name8"]) == 8
    body = spark.createDataFrame([("<urlset><url><loc> https://x/annual-report </loc></url><loc>https://x/jobs</loc>", '{"a": ["https:\\/\\/x\\/r.pdf"]}'), (None, None)], "body string, json string")
    assert [r[0] for r in readers.sitemap_urls(body).collect()] == ["https://x/annual-report"]
    assert [r[0] for r in readers.json_urls(body, "json").collect()] == ["https://x/r.pdf"]


def test_reachable(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    log = spark.createDataFrame([("a", 200), ("b", 404), ("a", 200)], "url string, status int")
    assert [r[0] for r in readers.reachable(urls, log).collect()] == ["a"]


def test_envelope_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("Acme", None, 1)], "company string, ticker string, confidence int")
    writers.write_envelope(rows, str(tmp_path / "out"), "2024-01-01")
    text = spark.read.text(str(tmp_path / "out")).first()[0]
    assert json.loads(text) == {"generatedAt": "2024-01-01", "companyCount": 1, "results": [{"company": "Acme", "ticker": None, "confidence": 1}]}
    assert readers.read_results(spark, str(tmp_path / "out")).first()["company"] == "Acme"


def test_csv_quotes_and_tsv(spark, tmp_path):
    rows = spark.createDataFrame([('a "b", c', "x\ty")], "a string, b string")
    writers.write_review_csv(rows, str(tmp_path / "csv"))
    assert any('"a ""b"", c"' in r[0] for r in spark.read.text(str(tmp_path / "csv")).collect())
    writers.write_partial_tsv(rows, str(tmp_path / "tsv"))
    assert spark.read.csv(str(tmp_path / "tsv"), sep="\t", header=True).first()["b"] == "x\ty"


def test_streams(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.txt").write_text("2024-01-01T00:00:00 ok\nplain\n")
    got = {r[0] for r in logs.run_to_memory(logs.log_stream(spark, str(tmp_path / "logs")), "t_lines", "append").collect()}
    assert got == {"2024-01-01T00:00:00 ok", "[raw] plain"}
    table = spark.sql("SELECT id AS event_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id * 7) AS ts, id % 3 AS user_id, IF(id % 2 = 0, 'a', 'b') AS event_type, id * 0.5D AS value, '{}' AS props FROM range(100)")
    table.write.parquet(str(tmp_path / "events"))
    streamed = logs.run_to_memory(logs.windowed_counts(logs.event_stream(spark, str(tmp_path / "events"))), "t_events")
    batch = logs.windowed_counts(spark.read.parquet(str(tmp_path / "events")).withColumn("ts", F.col("ts").cast("timestamp")))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_single_files_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/one.json"
    writers.replace_text(spark, path, '{"a": 1}')
    writers.replace_text(spark, path, '{"a": "två"}')
    assert json.loads((tmp_path / "one.json").read_text()) == {"a": "två"}
    assert [p.name for p in tmp_path.iterdir() if p.suffix == ".json" or p.name.endswith(".tmp")] == ["one.json"]
    writers.seed_results(spark, path, f"{tmp_path}/two.json")
    assert (tmp_path / "two.json").read_text() == (tmp_path / "one.json").read_text()
    (tmp_path / "bad.json").write_text("{oops")
    with pytest.raises(ValueError, match="JSON"):
        writers.seed_results(spark, f"{tmp_path}/bad.json", path)
    assert json.loads((tmp_path / "one.json").read_text()) == {"a": "två"}


def test_preflight_ledger_and_registry_files(spark, tmp_path):
    rows = spark.createDataFrame([("A.ST", "Acme", None, 10, "low", [], []), ("B.ST", "Bolt", "https://b", 70, "high", ["x"], ["s"])], readers.PREFLIGHT_ROW)
    writers.write_preflight(rows, f"{tmp_path}/p.json", "now")
    r = readers.read_preflight(spark, f"{tmp_path}/p.json").first()
    assert (r["generated_at"], r["company_count"], [x["ticker"] for x in r["results"]]) == ("now", 2, ["B.ST", "A.ST"])
    ledger = spark.createDataFrame([("Acme", None), ("Bolt", "not_found")], "company string, ebit_msek string")
    tallies = spark.createDataFrame([("ebit_msek", "not_found", 1)], "field string, reason string, n int")
    writers.write_null_ledger(ledger, tallies, f"{tmp_path}/l.json", "now")
    got = json.loads((tmp_path / "l.json").read_text())
    assert got["source_row_count"] == 2 and got["tallies"] == {"ebit_msek": {"not_found": 1}} and got["per_row"][0] == {"company": "Acme", "ebit_msek": None}
    writers.write_registry(spark.createDataFrame([("B.ST", "Bolt", "https://b"), ("A.ST", "Acme", None)], "ticker string, name string, irPage string"), f"{tmp_path}/r.json")
    assert {r["ticker"]: r["ir_page"] for r in readers.read_registry(spark, f"{tmp_path}/r.json").collect()} == {"A.ST": None, "B.ST": "https://b"}


def test_rule_and_list_files_of_any_kind(spark, tmp_path):
    for name, text in (("missing", None), ("broken", "{oops"), ("list", "[1, 2]"), ("object", "{}")):
        path = tmp_path / name
        if text is not None:
            path.write_text(text)
        assert readers.read_collision_rules(spark, str(path)).count() == 0 and readers.read_hard_list(spark, str(path)).count() == 0
        assert readers.read_preflight(spark, str(path)).count() == (1 if name in ("list", "object") else 0)


def test_binary_answers(spark, tmp_path):
    (tmp_path / "https%3A%2F%2Fx.example%2Fa.pdf").write_bytes(b"%PDF-1")
    (tmp_path / "https%3A%2F%2Fx.example%2Fb").write_bytes(b"")
    got = {r["url"]: bytes(r["content"]) for r in readers.read_binaries(spark, str(tmp_path)).collect()}
    assert got == {"https://x.example/a.pdf": b"%PDF-1"}


def test_rows_logs_and_texts_are_written_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("Acme", None, 2024), ("Bolt", "B.ST", 2023)], "company string, ticker string, fiscal_year int")
    writers.write_results(rows, f"{tmp_path}/rows")
    assert sorted(tuple(r) for r in spark.read.schema(rows.schema).json(f"{tmp_path}/rows").collect()) == sorted(tuple(r) for r in rows.collect())
    assert '"ticker":null' in "".join(r[0] for r in spark.read.text(f"{tmp_path}/rows").collect())
    texts = spark.createDataFrame([(1, "a", 2024), (2, "b", 2023), (3, None, 2024)], "doc_id long, text string, fiscal_year int")
    writers.write_year_partitioned(texts, f"{tmp_path}/texts")
    assert spark.read.parquet(f"{tmp_path}/texts").where("fiscal_year = 2024").count() == 2
    log = spark.createDataFrame([("https://a", 200, "x", "http", 1), ("https://a", 200, "y", "browser", 2), ("https://b", 404, "z", "http", 3)], "url string, status int, body string, transport string, ord long")
    log.write.parquet(f"{tmp_path}/log")
    read = readers.read_fetch_log(spark, f"{tmp_path}/log")
    assert read.columns[:3] == ["url", "final_url", "host"] and [r["body"] for r in readers.page_texts(read).collect()] == ["y"]
    assert [r["body"] for r in readers.page_texts(read, "http").collect()] == ["x"]


def test_collated_order_and_unmatched_seeds(spark):
    from loomspark.functions import numbers
    from loomspark.operators import company

    names = spark.createDataFrame([(n,) for n in ("Öst", "alfa", "Zeta", "Ära", "Åre")], "name string")
    assert [r[0] for r in company.collated(names, "name").collect()] == ["alfa", "Zeta", "Åre", "Ära", "Öst"]
    registry = spark.createDataFrame([("VOLV-B.ST", None)], "ticker string, url string")
    seeds = spark.createDataFrame([("volv b", "https://v"), ("none a", "https://n")], "symbol string, url string")
    assert [r["symbol"] for r in company.unmatched_seeds(registry, seeds).collect()] == ["none a"]
    got = names.select(numbers.plausible(F.lit(5.0), 1, 10).alias("a"), numbers.plausible(F.lit(50.0), 1, 10).alias("b")).first()
    assert tuple(got) == (5.0, None)
