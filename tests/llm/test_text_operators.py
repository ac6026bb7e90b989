import hashlib
import math
import os
import random
import re
import time

import numpy as np
import pytest

from loomspark.llm import htmltext, queries
from loomspark.llm.bpe import ForcedBoundaryBpe, bpe_encode
from loomspark.llm.decontam import ContainmentIndex, contained_items, decontaminate
from loomspark.llm.htmltext import html_text, main_text
from loomspark.llm.linededup import line_dedup
from loomspark.llm.suffixdedup import suffix_dedup
from loomspark.llm.urlfilter import UrlTrie, split_url, url_filter
from tests.llm.helpers import documents, hard_rows

tokenizers = pytest.importorskip("tokenizers")


# --- BPE ---------------------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    if not os.path.exists(queries.WORD_BPE):
        pytest.skip("no tokenizer files here")
    library = tokenizers.Tokenizer.from_file(queries.WORD_BPE)
    library.no_padding()
    library.no_truncation()
    return ForcedBoundaryBpe(queries.WORD_BPE), library


def test_bpe_equals_the_library_on_random_text(bpe):
    own, library = bpe
    r = random.Random(2)
    letters = "abcXYZ ÉéÅå's't   \u0085\x1c\x0b<|endoftext|>ΣσςİIıß日本語é!?.,0123½²٣ﬁ😀\n\t'LL've"
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randrange(40))) + r.choice(["", "<|startoftext|>x", "Straße hello-world"])
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_forced_boundaries_change_nothing(bpe):
    own, _ = bpe
    r = random.Random(4)
    cut = 0
    for _ in range(2000):
        base = [r.randrange(256) for _ in range(r.randrange(1, 12))]
        whole = own._merge(list(base))
        parts = own.fragments(base)
        cut += len(parts) > 1
        assert [i for p in parts for i in own._merge(p)] == whole
    assert cut > 100


def test_long_words_equal_the_library(bpe):
    own, library = bpe
    r = random.Random(6)
    words = ["".join(r.choice(letters) for _ in range(n)) for letters, n in (("etaoinshrdlu", 3000), ("ab", 5000), ("a", 4097), ("abcdefghijklmnopqrstuvwxyz", 20_000), ("é日a", 2000))]
    for text in (*words, " ".join(words)):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_a_word_of_a_million_letters_takes_seconds(bpe):
    own, _ = bpe
    r = random.Random(7)
    word = "".join(r.choice("etaoinshrdlu") for _ in range(1_000_000))
    began = time.perf_counter()
    ids = own.encode(word)
    assert time.perf_counter() - began < 60
    assert "".join(own.strings[i] for i in ids).replace("</w>", "") == word
    assert word not in own.memo


def test_the_memo_is_bounded_by_bytes(bpe, monkeypatch):
    own = ForcedBoundaryBpe(queries.WORD_BPE)
    monkeypatch.setattr(own, "MEMO", 400_000)
    r = random.Random(8)
    for _ in range(3000):
        own.encode("".join(r.choice("etaoin") for _ in range(r.choice([3, 12, 600]))))
        assert own.held <= own.MEMO and sum(4 * len(w) for w in own.memo) <= own.held


def test_bpe_rows(spark, bpe):
    own, _ = bpe
    rows = [*hard_rows(n=40), (None, "x", None, None, None), (7, "x", None, None, None)]
    got = bpe_encode(documents(spark, rows), queries.WORD_BPE).collect()
    assert len(got) == len(rows)
    for r, g in zip(sorted(rows, key=lambda r: (str(r[0]), r[1] or "")), sorted(got, key=lambda g: (str(g["doc_id"]), "")), strict=True):
        assert r[0] == g["doc_id"] and g["n_tokens"] == len(g["ids"]) and own.decode(g["ids"]) == g["decoded"]
        assert g["decoded_sha256"] == hashlib.sha256(g["decoded"].encode()).hexdigest()
    assert bpe_encode(documents(spark, []), queries.WORD_BPE).collect() == []


# --- URL filter ----------------------------------------------------------------------------------------------------------------------


def brute_verdict(url, rules):
    host, path = split_url(url)
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    if not fits:
        return (None, "allow")
    best = max(fits, key=lambda r: (len(r[1].split(".")), len(r[2]), r[0] == "block"))
    return (best[1] + best[2], best[0])


@pytest.mark.parametrize(
    "url,parts",
    [(None, ("", "")), ("nothing", ("", "")), ("http://A.B/c?d#e", ("a.b", "/c")), ("http://ÄB?x/", ("Äb", "")), ("x://h#/p", ("h", "")), ("://h//p", ("h", "//p")), ("http:///p", ("", "/p")), ("a://b://c", ("b:", "//c"))],
)
def test_split_url(url, parts):
    assert split_url(url) == parts


def test_url_filter_equals_brute_force(spark):
    r = random.Random(5)
    rules = [*queries.URL_RULES, ("block", "b.example.org", "/"), ("allow", "b.example.org", "/en/"), ("block", "b.example.org", "/en/"), ("block", "net", "/a/b")]
    hosts = ["org", "example.org", "x.example.org", "b.example.org", "z.b.example.org", "com", "a.com", "xcom", "net", "q.net", "example.org:80", ""]
    urls = [f"https://{r.choice(hosts)}{r.choice(['', '/', '/en/1', '/en/12/x', '/en/2', '/es/', '/es', '/fr/', '/de/x', '/a/b', '/a/bc', '/EN/1', '//'])}{r.choice(['', '?q=/en/1', '#/es/'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "HTTP://EXAMPLE.ORG/en/1"]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, host string")
    for block in (1 << 20, 20):
        got = {x["page_id"]: x for x in url_filter(pages, rules, block_bytes=block).collect()}
        for i, u in enumerate(urls):
            assert (got[i]["host"], got[i]["path"]) == split_url(u)
            assert (got[i]["rule"], got[i]["verdict"]) == brute_verdict(u, rules), u
    assert url_filter(pages.limit(0), rules).collect() == []
    with pytest.raises(ValueError):
        UrlTrie([("maybe", "a", "/")])


# --- HTML ----------------------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=1>menu one</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, many of them, for a long sentence of text.</div><div class="ad">Buy this long advertised thing now, it is really very good.</div>
<main><article><header><h1>The &amp; title</h1></header><p><b>First   paragraph,\n with <i>inline</i> marks that is long enough to count as content.<br><p>Short.</p><ul><li>one item</li><li>two</li></ul>
<p>Second paragraph, unclosed, with enough words in it to weigh something.<div class="comments"><p>A reader writes a long comment about the article, longer than some paragraphs.</p></div></article></main>
<aside>Side words side words side words side words</aside><form><p>Your name</p><input></form><footer>&copy; foot</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "\n\n".join(
        ["The & title", "First paragraph, with inline marks that is long enough to count as content.", "Short.", "one item", "two", "Second paragraph, unclosed, with enough words in it to weigh something."]
    )


def test_main_text_without_article_element():
    page = "<body><div id=menu><a href=1>a</a> <a href=2>b</a></div><h1>Head</h1><div class='post-content'><p>" + "words and words " * 20 + "</p><p>End.</p></div><div class=footer>foot foot foot foot foot foot</div>"
    assert main_text(page) == "Head\n\n" + ("words and words " * 20).strip() + "\n\nEnd."


LONG = "A sentence of the article that goes on for a while, so that it weighs something. "
WANTED = ["Head", LONG.strip(), "Short.", "a quote", "cell one", "cell two", "a caption", "see the source", (LONG * 3).strip()]
BODY = f"<h1>Head</h1><p>{LONG}</p><p>Short.</p><blockquote>a quote</blockquote><table><tr><td>cell one<td>cell two</tr></table><figure><img src=x><figcaption>a caption</figcaption></figure><ul><li><a href=1>see the source</a></ul><p>{LONG * 3}</p>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><nav>menu menu</nav><article>{BODY}<footer>by line</footer></article><section id=comments><h2>Comments</h2><p>{LONG * 5}</p></section></body>",
        f"<body><div class=main-menu><a href=1>one</a></div><main>{BODY}<div class='share-buttons'>Share</div><div id=disqus_thread>{LONG}</div></main><div id=sidebar>{LONG * 2}</div></body>",
        f"<body><div class=topbar>{LONG}</div><article class=post><div class=entry-header></div>{BODY}<p class=advert>{LONG}</p><p style='display: none'>{LONG}</p><aside>{LONG}</aside><div class=related-posts><p>{LONG}</p></div></article><div role=contentinfo>{LONG}</div>",
        f"<html><body><header>{LONG}</header><div id=cookieNotice>{LONG * 4}</div><article>{BODY}<form><label>Mail</label> <button>Go</button>{LONG}</form><script>document.write('<p>x</p>')</script><noscript>{LONG}</noscript></article><div class=newsletter>{LONG}</div></body></html>",
    ],
)
def test_articles_among_boilerplate(page):
    assert main_text(page).split("\n\n") == WANTED


BEFORE, AFTER = "<h1>Head</h1><p>" + LONG + "</p><p>Short.</p>", "<p>" + LONG + "</p><p>End.</p>"
BULK = LONG * 12


@pytest.mark.parametrize("name", ["<div id=content>", "<div>"])
@pytest.mark.parametrize(
    ("bulk", "found"),
    [
        (f"<ul><li>{BULK}</li><li>{BULK}</li></ul>", [BULK.strip()] * 2),
        (f"<ul><li>{BULK}</li><li>two</li></ul>", [BULK.strip(), "two"]),
        (f"<blockquote><p>{BULK}</p><p>{BULK}</p></blockquote>", [BULK.strip()] * 2),
        (f"<table><tr><td>one</td><td>{BULK}</td></tr></table>", ["one", BULK.strip()]),
        (f"<section><h2>Part</h2><p>{BULK}</p></section><section><p>{LONG}</p></section>", ["Part", BULK.strip(), LONG.strip()]),
    ],
)
def test_pages_of_divs_with_a_dominant_element(name, bulk, found):
    page = f"<body><div class=menu><a href=1>one</a></div>{name}{BEFORE}{bulk}{AFTER}</div><div class=footer>{LONG}</div></body>"
    assert main_text(page).split("\n\n") == ["Head", LONG.strip(), "Short.", *found, LONG.strip(), "End."]


def test_short_paragraphs_beside_a_dominant_list():
    page = f"<body><div class=post><p>One.</p><ul>{f'<li>{BULK}</li>' * 5}</ul><p>Two.</p><section><p>Three.</p></section></div><div id=sidebar><p>{LONG}</p></div></body>"
    assert main_text(page).split("\n\n") == ["One.", *[BULK.strip()] * 5, "Two.", "Three."]


@pytest.mark.parametrize(
    ("start", "end"),
    [
        ("<div class='layout with-sidebar'>", "</div>"),
        ("<div id=page class='has-comments'>", "</div>"),
        ("<div class=hasSidebar><article>", "</article></div>"),
        ("<article class='post share-enabled'>", "</article>"),
        ("<form><div>", "</div></form>"),
        ("<form id=form1><div class=banner><main>", "</main></div></form>"),
        ("<div class=widget><div class=overlay>", "</div></div>"),
        (f"<p>{LONG}</p><article class='related'>", "</article>"),
    ],
)
def test_wrappers_with_names_of_boilerplate(start, end):
    menu, comments = f"<div class=main-menu><a href=1>one</a></div><div class=notice>{LONG}</div>", f"<div id=comments><article class=comment><p>{LONG}</p></article><p>{LONG}</p></div>"
    body = f"<h1>Head</h1><p>{BULK}</p><p>Short.</p><p>{LONG}</p>"
    inside, outside = start.startswith(("<div", "<form")), [LONG.strip()] if start.startswith("<p") and "article" not in start else []
    page = f"<body>{start}{menu if inside and 'main' not in start else ''}{body}<div class='share-buttons'>Share</div>{comments if inside else ''}{end}</body>"
    assert main_text(page).split("\n\n") == [*outside, "Head", BULK.strip(), "Short.", LONG.strip()]


def test_named_boilerplate_stays_out_beside_an_article():
    teasers = f"<section class=related-posts><article><p>{LONG * 2}</p></article><article><p>{LONG}</p></article></section>"
    for body in (f"<article><p>{LONG}</p></article>", f"<div><p>{LONG * 3}</p></div>"):
        page = f"<body>{body}{teasers}<div id=comments><article class=comment><p>{BULK}</p><p>{BULK}</p></article></div><form><p>{BULK}</p><p>{BULK}</p></form></body>"
        assert main_text(page) in ((LONG * 3).strip(), LONG.strip())


@pytest.mark.parametrize(
    ("start", "end"),
    [
        ("<article class='post comments-open'>", "</article>"),
        ("<div class='content no-sidebar'>", "</div>"),
        ("<div class='has-search'><article>", "</article></div>"),
        ("<article class='category-social'>", "</article>"),
        ("<div class='page-with-sidebar comments-closed'><div>", "</div></div>"),
    ],
)
def test_ordinary_class_names_keep_the_article(start, end):
    page = f"<body><div><a href=1>Home</a> <a href=2>About</a></div>{start}<h2>Head</h2><p>{LONG * 2}</p><p>Short.</p><ul><li><a href=1>a source</a></ul><p>{LONG}</p>{end}<div class=sidebar><p>{LONG}</p></div></body>"
    assert main_text(page).split("\n\n") == ["Head", (LONG * 2).strip(), "Short.", "a source", LONG.strip()]


#: Pages that name nothing: what is no article there shows by its ratio of text to tags alone.
UNNAMED = [
    f"<body><div><a href=1>Home</a> <b>|</b> <i>Log in</i> <b>|</b> <i>Help</i></div><div><h1>Head</h1><p>{LONG * 2}</p><p>Short.</p><p>{LONG}</p></div><div><span>All</span> <span>rights</span> <b>kept</b></div></body>",
    f"<body><table><tr><td><b>One</b><td><b>Two</b><td><b>Three</b></tr></table><section><h1>Head</h1><p>{LONG * 2}</p><p>Short.</p></section><section><p>{LONG}</p></section><div><i>Phone</i> <b>123</b></div></body>",
]


@pytest.mark.parametrize("page", UNNAMED)
def test_ratios_decide_where_nothing_is_named(page):
    assert main_text(page).split("\n\n") == ["Head", (LONG * 2).strip(), "Short.", LONG.strip()]


@pytest.mark.parametrize("page", UNNAMED)
def test_a_constant_ratio_changes_the_text(page, monkeypatch):
    before = main_text(page)
    monkeypatch.setattr(htmltext, "smooth", lambda ratios, sigma: np.ones(len(ratios)))
    assert main_text(page) != before


def brute_clusters(lines, sigma=1.0):
    """The content lines by the definition: for each line a weighted mean of the ratios of all lines within three sigma."""
    ratios = [max(0, len(x.text) - x.linked) / max(1, x.tags) for x in lines]
    weight = lambda d: math.exp(-0.5 * (d / sigma) ** 2) if abs(d) <= 3 * sigma else 0.0
    smoothed = [sum(weight(i - j) * r for j, r in enumerate(ratios)) / sum(weight(i - j) for j in range(len(ratios))) for i in range(len(ratios))]
    mean, middle = sum(ratios) / len(ratios), sum(smoothed) / len(smoothed)
    threshold = min(math.sqrt(sum((s - middle) ** 2 for s in smoothed) / len(smoothed)), mean / 2)
    over = [s >= threshold - 1e-12 and s > 0 for s in smoothed]

    def reached(i, step):
        """Whether a line of the cluster with a high ratio of its own stands at i or beyond it."""
        while 0 <= i < len(lines) and over[i]:
            if ratios[i] >= threshold / 2:
                return True
            i += step
        return False

    return [over[i] and reached(i, 1) and reached(i, -1) and x.linked <= len(x.text) / 2 for i, x in enumerate(lines)]


def test_clusters_equal_brute_force():
    r = random.Random(12)
    for _ in range(200):
        lines = [htmltext.Line("x" * (n := r.choice([1, 3, 9, 40, 200])), r.randrange(9), r.choice([0, 0, 0, n]), "p", (1,), False) for _ in range(r.randrange(1, 40))]
        assert htmltext.clusters(lines, lines) == brute_clusters(lines)


@pytest.mark.parametrize("page", [None, "", "   ", "<nav>only menu</nav>", "<script>x</script>", "<p></p>", "<!-- a -->"])
def test_pages_without_text(page):
    assert main_text(page) == ""


def test_broken_markup_and_very_long_pages():
    assert main_text("plain words only") == "plain words only"
    assert main_text("<article><p>one<p>two</article") == "one\n\ntwo"
    long = "<article>" + "".join(f"<p>{'word ' * 30}{i}</p>" for i in range(5000)) + "</article><footer>f</footer>"
    assert main_text(long).count("\n\n") == 4999


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "own"), (1, "u", PAGE, "own"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = html_text(pages).collect()
    assert sorted((r["page_id"] is None, r["n_chars"]) for r in got) == [(False, len(main_text(PAGE)))] * 2 + [(True, 0)]
    assert html_text(pages.limit(0)).collect() == []


# --- line dedup ----------------------------------------------------------------------------------------------------------------------


def brute_lines(rows, width=3):
    seen, out = {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        lines = (text or "").split("\n")
        for k in range(len(lines) - width + 1):
            seen.setdefault(tuple(lines[k : k + width]), (i, k))
    for i, text in rows:
        lines, gone = (text or "").split("\n"), set()
        for k in range(len(lines) - width + 1):
            w = tuple(lines[k : k + width])
            if any(x.strip(" ") for x in w) and seen[w] < (i, k):
                gone |= set(range(k, k + width))
        out[i] = (None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    return out


def test_line_dedup_equals_brute_force(spark):
    rows = list({r[0]: r for r in hard_rows(n=150)}.values())
    rows.append((6000, "\n".join(str(k % 2000) for k in range(9000)), None, None, None))
    want = brute_lines([r[:2] for r in rows])
    df = documents(spark, rows).repartition(7)
    got = line_dedup(df)
    assert {r["doc_id"]: (r["text"], r["lines_removed"]) for r in got.collect()} == want
    assert [c for c in got.columns if c not in ("lines_removed", "lines_kept")] == [c for c in df.columns if c != "lines_removed"]


def test_line_dedup_edges(spark):
    passage = "a\nb\nc"
    rows = [(None, passage, None, None, None), (1, passage, None, None, None), (2, passage, None, None, None), (2, passage, None, None, None), (3, "a\nb", None, None, None), (4, None, None, None, None)]
    got = sorted(((r["doc_id"], r["text"]) for r in line_dedup(documents(spark, rows)).collect()), key=str)
    assert got == sorted([(None, passage), (1, ""), (2, ""), (2, ""), (3, "a\nb"), (4, None)], key=str)
    assert line_dedup(documents(spark, [])).collect() == []


# --- decontamination -----------------------------------------------------------------------------------------------------------------


def test_contained_items_equal_brute_force(spark):
    r = random.Random(8)
    items = [(k, " ".join(r.choice("abcdefghij") + str(r.randrange(30)) for _ in range(r.choice([2, 4, 5, 12, 40])))) for k in range(30)] + [(30, None), (31, "..."), (0, "same id w1 w2 w3 w4")]
    rows = [(i, " ".join([r.choice("xyz") + str(r.randrange(9)) for _ in range(r.randrange(200))] + self_mix(r, items) + ["end"]), "en", "s", 1) for i in range(80)] + [(80, None, "", "", 1), (81, "", "", "", 1), (82, items[9][1].upper().replace(" ", ",\n"), "", "", 1)]
    shingles = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    want = set()
    for i, text, *_ in rows:
        words = re.findall(r"\w+", (text or "").lower())
        for k, item in items:
            w = re.findall(r"\w+", (item or "").lower())
            own = shingles(w, min(5, len(w))) if w else set()
            if own and len(own & shingles(words, min(5, len(w)))) >= 0.8 * len(own):
                want.add((i, k, len(own)))
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 60):
        got = contained_items(documents(spark, rows), table, block_bytes=block).collect()
        assert {(g["doc_id"], g["item_id"], g["n_shingles"]) for g in got} == want and len(got) == len(want)
        kept = decontaminate(documents(spark, rows), table, block_bytes=block)
        assert {x["doc_id"] for x in kept.collect()} == {x[0] for x in rows} - {w[0] for w in want}
        assert kept.columns == documents(spark, rows).columns
    assert len(want) > 10
    assert contained_items(documents(spark, []), table).collect() == [] and contained_items(documents(spark, rows), table.limit(0)).collect() == []


def test_signatures_choose_the_candidates():
    r = random.Random(21)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.choice([6, 20, 80])))) for k in range(60)]
    index = ContainmentIndex(items, 5, 0.8)
    few = many = 0
    for k, text in items:
        words = text.split()
        for cut in (0.1, 0.5, 0.95):
            document = " ".join(["x"] * 50 + words[: max(5, int(cut * len(words)))] + ["x"] * 2000)
            ids = np.array([index.vocab.get(w, -1) for w in document.split()], np.int32)
            chosen = index.candidates(ids)
            few += len(chosen)
            # Without signatures every item that shares a shingle would be compared.
            shared = [m for m, (_, n, own) in enumerate(index.items) if {tuple(x) for x in np.lib.stride_tricks.sliding_window_view(own, n).tolist()} & {tuple(x) for x in np.lib.stride_tricks.sliding_window_view(ids, n).tolist()}]
            many += len(shared)
            assert {i for i, *_ in index.search(document)} <= {items[m][0] for m in chosen} <= {items[m][0] for m in shared}
    assert 0 < few < many


def self_mix(r, items):
    words = (items[r.randrange(30)][1] or "").split()
    if r.random() < 0.5 and words:
        words[r.randrange(len(words))] = "changed"
    return words if r.random() < 0.6 else []


# --- suffix dedup ----------------------------------------------------------------------------------------------------------------------


def brute_suffix(rows, length):
    seen, out = {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        for p in range(len(b) - length + 1):
            seen.setdefault(b[p : p + length], (i, p))
    for i, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] < (i, p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1])), hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize("options", [{}, {"hot_runs": (1, 1)}, {"hot_runs": (2, 5)}, {"length": 40, "q": 8}, {"bucket_bytes": 4096}])
def test_suffix_dedup_equals_brute_force(spark, options):
    rows = list({r[0]: r for r in hard_rows(n=150)}.values())
    want = brute_suffix([r[:2] for r in rows], options.get("length", 100))
    got = {r[0]: (*tuple(r)[1:5], bytes(r[5])) for r in suffix_dedup(documents(spark, rows).repartition(5), **options).collect()}
    assert got == want
    assert sum(x[1] for x in want.values()) > 1000


def test_suffix_dedup_edges(spark):
    text = "".join(map(str, range(200)))
    rows = [(None, text, None, None, None), (1, text, None, None, None), (1, text, None, None, None), (2, text[:99], None, None, None), (3, None, None, None, None)]
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup(documents(spark, rows), full=False).collect()), key=str)
    assert got == sorted([(None, 490, 0), (1, 490, 490), (1, 490, 490), (2, 99, 0), (3, 0, 0)], key=str)
    repeated = [(1, text, None, None, None)] * 3
    assert all(r["n_removed"] == 0 for r in suffix_dedup(documents(spark, repeated).repartition(3)).collect())
    assert suffix_dedup(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup(documents(spark, rows), q=4)


@pytest.mark.parametrize("options", [{}, {"hot_runs": (1, 1)}])
def test_suffix_dedup_of_many_texts_without_identifier(spark, options):
    r = random.Random(11)
    passages = ["".join(r.choice("abcdefgh ") for _ in range(130)) for _ in range(40)]
    texts = [f"{k} " + "".join(r.choice("ijklmnop ") for _ in range(r.randrange(200))) + r.choice(passages) * (k % 3 > 0) for k in range(4000)]
    rows = [(None if k % 8 else 7, t, None, None, None) for k, t in enumerate([*texts, *texts[:50]])]
    df = documents(spark, rows).repartition(6)
    # A text under an identifier is a document; its hash is its place among the texts of one identifier.
    place = {(x[0], x[1]): (-(2**63) if x[0] is None else x[0], x[2]) for x in df.selectExpr("doc_id", "text", "xxhash64(text)").collect()}
    want = brute_suffix([(p, text) for (_, text), p in place.items()], 100)
    got = [(tuple(x)[1:5], bytes(x[5])) for x in suffix_dedup(df, **options).collect()]
    assert sorted(got) == sorted((want[place[x[:2]]][:4], want[place[x[:2]]][4]) for x in rows)
    assert sum(x[1] for x in want.values()) > 100_000


def test_suffix_dedup_across_blocks(spark, monkeypatch):
    from loomspark.llm import suffixdedup

    monkeypatch.setattr(suffixdedup, "BLOCK", 64)
    r = random.Random(3)
    text = "".join(r.choice("abc") for _ in range(500)).encode()
    runs = list(suffixdedup.window_runs(text, 100, 24))
    starts = [s for _, start, n in runs for s, k in zip(start.tolist(), n.tolist(), strict=True) for s in range(s, s + k)]
    assert starts == list(range(401))
