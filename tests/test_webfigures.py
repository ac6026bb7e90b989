from loomspark.operators import webfigures as w


def test_strategies_in_order(spark):
    pages = [
        (1, 0, '<script type="application/ld+json">{"revenue": {"value": "12000"}, "numberOfEmployees": 55}</script><table><tr><td>Net sales</td><td>9 000</td></tr></table>'),
        (2, 0, "<table><tr><th>SEK m</th><th>2024</th></tr><tr><td>Net sales</td><td></td><td>9&nbsp;000</td></tr><tr><td>Operating profit</td><td>1,234</td></tr></table>".replace("&nbsp;", " ")),
        (3, 0, "<p>nothing</p>"),
        (3, 1, "<dl><dt>Employees</dt> <dd>1 500</dd></dl><p>Revenue amounted to 77 000 million</p>"),
        (4, 0, "<p>Revenue was 12 kronor</p>"),
        (5, 0, None),
    ]
    got = {r["company_id"]: tuple(r)[1:] for r in w.key_figures(spark.createDataFrame(pages, "company_id long, ord int, html string")).collect()}
    assert got == {1: (12000.0, None, 55.0, 50), 2: (9000.0, 1234.0, None, 50), 3: (77000.0, None, 1500.0, 50), 4: (None, None, None, 30), 5: (None, None, None, 30)}
