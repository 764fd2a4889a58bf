"""Each training-data operator against brute force, an exact round trip or held-out accuracy, and its edge cases."""

import gzip
import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import ann, decontaminate, html_extract, jaccard_join, langid, lm_score, mixing, oracles, queries, token_counts, url_filter, warc
from strata.llm.common import maybe_in
from strata.llm.components import components
from strata.llm.elias_fano import EliasFano
from strata.llm.hashing import WordHashes
from strata.session import scratch_path
from strata.sinks.writer import stage
from tests.compare import compare, duck
from tests.conftest import SF_SMALL

DOC = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [(1, None, None, None, None), (2, "", "en", None, 0), (3, " \n\t", None, "s", None), (None, "only words here", "en", "s", 1),
        (4, "only words here", "en", "t", 1), (4, "only words here", "en", "t", 1), (5, "x " * 30_000, "en", "t", 1), (6, "日本語 ÀÉ ß", "xx", "t", 1)]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def edge_docs(spark):
    """Nulls, empty, blank, very long and repeated rows, and columns whose names clash with results and helpers."""
    return spark.createDataFrame(EDGE, DOC).withColumns({c: F.lit("clash") for c in ("size", "target", "rank", "node", "score", "n", "count")})


def empty_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_matches_sql(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r.get("match"), r


# ------------------------------------------------------------ 1 url filter
def plain_verdict(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and re.match("(?s)" + ".*".join(map(re.escape, r.path.split("*"))), path)]
    best = max(fits, key=lambda r: (len(r.text), r.action == "block"), default=None)
    return host, path, best.text if best else None, best.action if best else "allow"


def test_url_rules_against_plain_matching(spark):
    rules = [*queries.URL_RULES, url_filter.UrlRule("block", "ads.example.com"), url_filter.UrlRule("block", "example.com", "/a*/pixel"),
             url_filter.UrlRule("allow", "a-b.co", "/x(1)/"), url_filter.UrlRule("block", "org", "/fr/"), url_filter.UrlRule("allow", "org", "/fr/")]
    urls = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://X.NET/a?b#c", "https://evilnet/", "http://example.net/en/1?q=://x/",
            "http://www.example.net/en", "http://example.com/de/", "http://example.com/de", "http://EXAMPLE.com/abc/de/pixel.gif", "http://ads.example.com/en/",
            "http://a-b.co/x(1)/", "http://b.org/fr/2", "http://b.org/FR/2", "http://net:80/", "http://é.net/ü/\n?x", "ftp://u@net/x"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(0, urls[6], "clash")] * 2, "page_id long, url string, rule string")
    got = [tuple(r) for r in url_filter.judge(df, rules).select("url", "host", "path", "rule", "verdict").collect()]
    assert sorted(got, key=str) == sorted([(u, *plain_verdict(u, rules)) for u in urls + [urls[6]] * 2], key=str)
    assert {r["verdict"] for r in url_filter.judge(df, [], default="block").collect()} == {"block"}


def test_url_rules_are_filed_under_their_rarest_token(spark):
    df = spark.createDataFrame([("http://a.example.net/en/1",), ("http://example.net/x",), ("http://b.net/en/",)], "url string")
    rule = url_filter.UrlRule("allow", "example.net", "/en/")
    assert url_filter.rarest_tokens(df, F.col("url"), [rule])[rule] in ("en", "example")
    assert url_filter.UrlRule("block", "x.y", "/ab*cd/ef").tokens == ["x", "y"]


def test_many_url_rules_and_columns_named_like_helpers(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "RULES_PER_INDEX", 700)  # several indexes
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b-c", "ads", "shop", "é", "x1", "news"])
    rules = [url_filter.UrlRule(rng.choice(["block", "allow"]), f"{word()}.{word()}.{rng.choice(['net', 'org'])}",
                                f"/{word()}{rng.choice(['/', '*', '', '*/'])}{i if i % 3 else ''}") for i in range(2000)]
    urls = [f"http://{word()}.{word()}.{word()}.{rng.choice(['net', 'org', 'com'])}/{word()}/{rng.randrange(2000)}" for _ in range(150)]
    by_text = sorted(rules, key=lambda r: r.text, reverse=True)  # of rules of one length and action the greatest text wins
    df = spark.createDataFrame([(i, u, "kept", 7) for i, u in enumerate(urls)], "page_id long, url string, __host string, __Best int")
    got = url_filter.judge(df, rules)
    assert got.columns == [*df.columns, "host", "path", "rule", "verdict"]
    assert {(r["__host"], r["__Best"]) for r in got.collect()} == {("kept", 7)}
    assert [tuple(r) for r in got.orderBy("page_id").select("host", "path", "rule", "verdict").collect()] == [plain_verdict(u, by_text) for u in urls]


def test_url_filter_plan_has_no_python(spark):
    plan = queries.op1_url_filter(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# ------------------------------------------------------------ 2 mixing
def water_fill(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over


def test_mix_targets_and_bounds(spark):
    rng = np.random.default_rng(3)
    docs = [(i, "w " * int(rng.integers(0, 60)), "en", ["a", "b", "c", "d", None][min(4, int(rng.integers(0, 5)))] if i % 3 else "hot", 0) for i in range(900)]
    docs += [(10_000, "tiny source", "en", "zz", 0), (10_001, None, "en", "z0", 0)]
    got = mixing.mix(spark.createDataFrame(docs, DOC)).collect()
    assert sorted(r.doc_id for r in got) == sorted(d[0] for d in docs)
    size = Counter()
    for d in docs:
        size[d[3]] += len((d[1] or "").split())
    want, taken = water_fill(dict(size)), Counter()
    for r in got:
        assert math.isclose(r.target, want[r.source], abs_tol=1e-6) and r.source_size == size[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 4 + 0.01 * want[s], (s, taken[s], want[s])
    again = {(r.doc_id, r.taken) for r in mixing.mix(spark.createDataFrame(docs, DOC).repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_mix_meets_the_targets_of_sources_far_smaller_than_a_block(spark):
    sizes = {"a": 1, "b": 10, "c": 50, "d": 1_000, "e": 9_000, "huge": 3_000_000}
    docs = [(100 * i + j, "w " * (n // 10 + (n % 10 if j == 0 else 0)), "en", s, 0) for i, (s, n) in enumerate(sizes.items()) for j in range(10)]
    got = mixing.mix(spark.createDataFrame(docs, DOC), slots=64).collect()  # blocks of 123 words
    want, taken = water_fill(sizes), Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert len(got) == len(docs)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1 + 0.001 * want[s], (s, taken[s], want[s])


def test_mix_edge_cases(spark):
    got = mixing.mix(edge_docs(spark)).collect()
    assert len(got) == len(EDGE) and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix(empty_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOC)
    assert [(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_mix_plan_has_no_python(spark):
    plan = queries.op2_mixing(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# ------------------------------------------------------------ 3 decontamination
def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def plain_hits(text, items):
    w, hit, who = word_list(text), set(), set()
    for item, t in items:
        p = word_list(t)
        m = min(10, len(p))
        windows = {tuple(p[i:i + m]) for i in range(len(p) - m + 1)} if m else set()
        for i in range(len(w) - m + 1 if m else 0):
            if tuple(w[i:i + m]) in windows:
                hit.update(range(i, i + m))
                who.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(who)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("a b c d".split()), max_size=60), st.lists(st.lists(st.sampled_from("a b c".split()), max_size=14), max_size=4))
def test_machines_find_what_plain_search_finds(doc, items):
    named = [(str(i), " ".join(p).encode()) for i, p in enumerate(items)]
    w, spans, who = decontaminate.words(" ".join(doc).encode()), [], set()
    for m in decontaminate.machines(named, 10):
        m.scan(w, spans, who)
    n, hit, ids = plain_hits(" ".join(doc), [(i, t.decode()) for i, t in named])
    assert (len(w), sum(s["last"] - s["first"] + 1 for s in decontaminate._united(spans)), sorted(who)) == (n, hit, ids)


def test_decontamination_of_edge_cases_in_one_chunk_and_in_many(spark):
    items = [(1, "only words here"), (2, "ONLY Words"), (2, "here"), (None, "日本語"), (3, None), (4, "..."), (5, "x " * 40), (6, "words here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((d[0], *plain_hits(d[1], items)) for d in EDGE if d[0] is not None)
    for size in (decontaminate.MAX_CHUNK_BYTES, 1):
        got = decontaminate.report(edge_docs(spark), bench, max_chunk_bytes=size).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in got if r.doc_id is not None) == \
            [(i, n, h, hashlib.sha256(",".join(ids).encode()).hexdigest()) for i, n, h, ids in want]
        assert all(r.contaminated == (r.n_hit > 0) for r in got)
    assert decontaminate.report(empty_docs(spark), bench).count() == 0
    assert decontaminate.report(edge_docs(spark), bench.limit(0)).where("contaminated").count() == 0


# ------------------------------------------------------------ 4 html
def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    for r in pages.join(html_extract.extract(pages), "page_id").collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub("</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


PROSE = "This is a long paragraph of the article and it is rich in the words that every text has to have, so it is kept."


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain text", "plain text"), ("<p>a &amp; b&nbsp;c</p>\n<p> d\n\te </p>", "a & b c\nd e"),
    (f"<nav>{PROSE}</nav><article><header><h1>Title</h1></header><p>{PROSE}<p>Short.</p><div class='comments'><p>{PROSE}</p></div></article><footer>{PROSE}</footer>",
     f"Title\n{PROSE}\nShort."),
    (f"<div class=ad>{PROSE}<article><p>{PROSE}</article>", PROSE),
    (f"<script>var a='</p><p>';{PROSE}</script><style>p{{}}</style><!-- <p>{PROSE}</p> --><p>{PROSE}", PROSE),
    (f"<p title='a>b'>{PROSE}</p><form><p>{PROSE}</p></form><aside>{PROSE}</aside><div id='cookie-notice'>{PROSE}</div>", PROSE),
    (f"<ul><li><a href=x>{PROSE}</a></li></ul><p>{PROSE}</p>", PROSE), ("<p>unclosed <b>bold <a href='x", "unclosed bold"),
])
def test_html_cases(page, text):
    assert html_extract.main_text(page) == text


LINKS = "<ul><li><a href=x>one link of many</a></li><li><a href=y>another link</a></li></ul>"
POLISH = "Wczoraj wieczorem mieszkańcy miasteczka zebrali się przed ratuszem, żeby posłuchać koncertu orkiestry dętej."
RUSSIAN = "Вчера вечером жители городка собрались перед ратушей, чтобы послушать концерт духового оркестра под открытым небом."
JAPANESE = "昨日の夕方、町の住民たちは市役所の前に集まり、吹奏楽団の演奏会を聴いた。" * 3
CODE = "x = compute(alpha, beta, gamma); y = transform(x, delta); print(y, epsilon, zeta, eta, theta, iota, kappa)"


@pytest.mark.parametrize("text", [POLISH, RUSSIAN, JAPANESE])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>"])
def test_html_of_other_languages_outlives_a_list_of_links(text, wrap):
    for inner in (f"<h1>Tytuł</h1><p>{text}</p><p>{text}</p>{LINKS}", f"{LINKS}<h1>Tytuł</h1><p>{text}</p><p>{text}</p>{LINKS}"):
        assert html_extract.main_text(wrap.format(inner)) == f"Tytuł\n{text}\n{text}"


def test_html_long_code_and_short_pages_outlive_a_list_of_links():
    assert html_extract.main_text(f"<p>{PROSE}</p>{LINKS}<pre>{CODE}</pre>{LINKS}") == f"{PROSE}\n{CODE}"
    assert html_extract.main_text(f"{LINKS}<p>Krótki tekst.</p>") == "Krótki tekst."
    assert html_extract.main_text(f"<p>{PROSE}</p>{LINKS}<p>Menu</p>{LINKS}") == PROSE


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "layout--with-header", "related-work", "search-results-explained", "market-share"])
def test_html_names_that_only_mention_boilerplate(name):
    for page in (f"<div class='{name}'><p>{PROSE}</p></div>", f"<article><section id='{name.split()[-1]}'><p>{PROSE}</p></section></article>"):
        assert html_extract.main_text(page) == PROSE


@pytest.mark.parametrize("name", ["sidebar", "left-sidebar", "site-footer", "comment-12", "cookie-banner", "related-posts", "box ad-slot-300x250", "share-buttons"])
def test_html_names_of_boilerplate(name):
    assert html_extract.main_text(f"<p>{PROSE}</p><div class='{name}'><p>{PROSE}</p></div>") == PROSE


def test_html_a_text_in_a_named_wrapper_of_an_empty_page_is_kept():
    assert html_extract.main_text(f"<nav>{PROSE}</nav><div class=search><h1>Title</h1><p>{PROSE}</p></div><footer>{PROSE}</footer>") == f"Title\n{PROSE}"
    assert html_extract.main_text("<div class=search><p>Find</p></div>") == ""
    assert html_extract.main_text(f"<div style='display:none' class=ad><p>{PROSE}</p></div>") == ""


FOREIGN = "And this is another long text that is not of the article but of the page around it, and it has to go with the rest of it."


@pytest.mark.parametrize("part", [
    "<p class='ad'>{}</p>", "<p hidden>{}</p>", "<ul><li class='comment'>{}<li class=comment>{}</ul>", "<table><tr><td class='sidebar'>{}</td></tr></table>", "<ol class='commentlist'><li>{}</li></ol>",
    "<div class='commentSection'><p>{}</p></div>", "<div class='replies'><p>{}</p></div>", "<div id='gdpr-cookie-message'><p>{}</p></div>", "<h2 class=newsletter>{}</h2>",
    "<div style='visibility: hidden'><p>{}</p></div>", "<div aria-hidden=true>{}</div>", "<dl><dt class=ad>{}<dd class=ad>{}</dl>", "<article class='comment'><p>{}</p></article>"])
def test_html_boilerplate_in_any_element(part):
    part = part.replace("{}", FOREIGN)
    for page in (f"<div><p>{PROSE}</p>{part}<p>{PROSE}</p></div>", f"<article><p>{PROSE}</p>{part}<p>{PROSE}</p></article>"):
        if "<article class" not in part or "<div><p>" not in page[:8]:
            assert html_extract.main_text(page) == f"{PROSE}\n{PROSE}"


def test_html_named_elements_without_end_tags_end_with_the_next():
    assert html_extract.main_text(f"<p class=ad>{FOREIGN}<p>{PROSE}") == PROSE
    assert html_extract.main_text(f"<ul><li class=ad>{FOREIGN}<li>{PROSE}</ul>") == PROSE
    assert html_extract.main_text(f"<table><tr><td class=sidebar>{FOREIGN}<td>{PROSE}<tr><td>{PROSE}</table>") == f"{PROSE}\n{PROSE}"
    assert html_extract.main_text(f"<ul><li class=menu><ul><li>{FOREIGN}</li></ul></li><li>{PROSE}</li></ul>") == PROSE


@pytest.mark.parametrize("attributes", ["style='overflow:hidden'", "aria-hidden=false", "data-state='hidden'", "hidden='until-found'"])
def test_html_shown_elements_stay(attributes):
    assert html_extract.main_text(f"<div {attributes}><p>{PROSE}</p></div>") == PROSE


def test_html_self_closing_icons_swallow_nothing():
    for icon in ("<svg class=icon />", "<svg class='a/>b' />", "<svg/>", "<svg><path d='M1/2' /></svg>", "<math><mi/></math>"):
        assert html_extract.main_text(f"{icon}<p>{PROSE}</p>") == PROSE


def test_html_a_teaser_marks_no_article():
    for teaser in (f"<article><p>{FOREIGN}</p></article>", "<article><p>Read on.</p></article>", f"<article class=teaser><p>{FOREIGN}</p></article>"):
        got = html_extract.main_text(f"<div><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>{teaser}")
        assert got.startswith(f"Title\n{PROSE}\n{PROSE}\n{PROSE}")
    assert html_extract.main_text(f"<article><p>{POLISH}</p></article><div><p>{FOREIGN}</p></div>") == POLISH


def test_html_paragraphs_of_links_stay_in_a_marked_article():
    linked = f"<p><a href=x>{PROSE}</a></p>"
    assert html_extract.main_text(f"<article>{linked}<p>Short.</p>{linked}<p>{PROSE}</p></article>") == f"{PROSE}\nShort.\n{PROSE}\n{PROSE}"


def test_html_of_odd_tables(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<p>x</p>"), (1, None, None), (2, "u", "<p>" + "the word of it " * 20_000)], "page_id long, url string, html string")
    got = html_extract.extract(pages.withColumn("text", F.lit("clash"))).collect()
    assert sorted((r.n_chars for r in got)) == [0, 0, 1, 15 * 20_000 - 1]
    assert html_extract.extract(pages.limit(0)).count() == 0


# ------------------------------------------------------------ 5 language
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op5_langid(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97 and got.score.between(0, 1).all()


def test_language_edge_cases(spark):
    model = langid.train(spark.createDataFrame([(i, t, lang) for i in range(30) for t, lang in (
        ("the house is red and the dog runs", "en"), ("das haus ist rot und der hund läuft", "de"), ("la casa es roja y el perro corre", "es"))], "doc_id long, text string, lang string"))
    assert set(model.families) == {"germanic", "romance"}
    got = {(r.doc_id, r.l.lang) for r in edge_docs(spark).select("doc_id", langid.identify(model).alias("l")).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= got and all(x == "und" or x in "en de es" for _, x in got)
    assert model.predict("der hund und das haus")[0] == "de" and model.predict("123 %%%") == ("und", 0.0)
    nothing = langid.train(empty_docs(spark))
    assert nothing.predict("the dog") == ("und", 0.0)
    one = langid.train(spark.createDataFrame([(1, "the dog", "en")], "doc_id long, text string, lang string"))
    assert one.predict("irgendwas") == ("en", 1.0)


def test_language_sample_is_bounded(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the dog and the cat").alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    assert langid.train(rows, per_language=20).language_pairs == [("de", "en")]


# ------------------------------------------------------------ 6 warc
def test_warc_round_trip(spark):
    pages = [(3, "http://a/ü b", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (5, "u", ""), (7, "x%20y", "z" * 3_000_000), (3, "http://a/ü b", "<p>é</p>"),
             (None, "n", "<p>é</p>"), (None, "n", "alone"), (9, "v", "alone two")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    archives = stage(warc.write_archives(warc.mark_revisits(df), scratch_path(spark, "warc-test"), max_archive_bytes=300), "t")
    got = [(r.page_id, r.url, r.payload_bytes, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in warc.read_archives(archives).collect()]
    first = {"<p>é</p>": 1, "": 2}
    want = []
    for i, u, h in pages:
        data, ref = (h or "").encode(), first.get(h or "")
        revisit = ref is not None and (i is None or i > ref)
        want.append((i, u, len(data), "revisit" if revisit else "response", ref if revisit else None, None if revisit else data))
    assert sorted(got, key=str) == sorted(want, key=str)
    for a in archives.collect():
        data = gzip.open(a.file.replace("file:", "")).read()  # a standard reader agrees
        assert data.count(b"WARC/1.1\r\n") == a.records + 1
    none = stage(warc.write_archives(warc.mark_revisits(df.limit(0)), scratch_path(spark, "warc-none")), "t")
    assert warc.read_archives(none).count() == 0


def test_warc_faults_are_found():
    good = warc.page_record(1, "u", b"payload", None)
    (member,) = warc.members(iter([good[:20], good[20:]]))
    assert warc.parse(member)[1].endswith(b"payload")
    assert len(list(warc.members(iter([good + good[:7], good[7:]])))) == 2
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.members(iter([good[:-3]])))
    with pytest.raises(ValueError, match="digest"):
        warc.parse(member.replace(b"payload", b"pAyload"))
    with pytest.raises(ValueError, match="frame"):
        warc.parse(member[:-5])
    with pytest.raises(zlib.error):
        list(warc.members(iter([b"not gzip at all"])))


# ------------------------------------------------------------ 7 jaccard join
def plain_components(docs, n=5):
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def variants(seed, n_docs, vocab=2000):
    """Texts of many sizes with chains of near copies around the threshold."""
    rng = np.random.default_rng(seed)
    docs = []
    while len(docs) < n_docs:
        w = [f"w{x}" for x in rng.integers(0, vocab, int(rng.choice([1, 3, 5, 6, 8, 12, 20, 40, 90, 200, 400])))]
        for _ in range(int(rng.integers(1, 9))):
            docs.append(" ".join(w))
            w = list(w)
            for _ in range(int(rng.integers(0, 1 + max(1, len(w) // 45)))):
                k = int(rng.integers(0, len(w)))
                w[k:k + 1] = [[], ["new"], [w[k], "more"]][int(rng.integers(0, 3))]
            if rng.random() < 0.3:
                w = w[:max(1, int(len(w) * rng.uniform(0.75, 1)))]
            w = w or ["w"]
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_join_matches_all_pairs(spark, seed):
    docs = variants(seed, 350)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == plain_components(docs)


def test_join_of_a_large_family_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FAMILY_BLOCK", 8)
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in range(120)]
    docs = []
    for i in range(150):
        w = list(base)
        for k in rng.choice(120, int(rng.integers(1, 5)), replace=False):
            w[k] = f"v{i}-{k}"
        docs.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == plain_components(docs)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 10**6))
def test_linked_sets_share_a_signature_and_sketches_bound_their_difference(common, only_a, only_b, seed):
    rng = np.random.default_rng(seed)
    h = np.unique(rng.integers(0, 1 << 63, common + only_a + only_b, dtype=np.int64).astype(np.uint64))
    rng.shuffle(h)
    a, b = np.sort(h[:common + only_a]), np.sort(np.concatenate([h[:common], h[common + only_a:]]))
    both, union = min(common, len(h)), len(h)
    far = int(np.bitwise_count(np.frombuffer(jaccard_join.sketch(a), np.uint8) ^ np.frombuffer(jaccard_join.sketch(b), np.uint8)).sum())
    assert far <= union - both
    if 100 * both >= 80 * union:
        assert set(jaccard_join.signatures(a).tolist()) & set(jaccard_join.signatures(b).tolist())


def test_join_edge_cases(spark):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(edge_docs(spark)).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 1, None), (4, 1, 4), (4, 1, 4), (5, 1, 5), (6, 1, 6)], key=str)
    assert jaccard_join.join(empty_docs(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[x] == 100 for x in range(101, 130))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmap_never_misses(spark):
    ids = spark.range(0, 3000, 3)
    seen = {r.id for r in maybe_in(spark.range(3000), "id", ids, buckets=1).where("__maybe").collect()}
    assert set(range(0, 3000, 3)) <= seen and len(seen) < 1400


# ------------------------------------------------------------ 8 language model
def test_scores_against_a_plain_model(spark):
    docs = [(i, f"The cat {x} sat on the {x} mat {i % 3}") for i, x in enumerate("a b c a b a a d e f b b a".split())] + [(50, None), (51, ""), (52, "unseen words only")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 1}
    got = {r.doc_id: r for r in lm_score.score_documents(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1).collect()}
    tokens = lambda t: (t or "").lower().split() + ["</s>"]
    uni, pair, context = Counter(), Counter(), Counter()
    for i, t in docs:
        if i not in held:
            w = tokens(t)
            uni.update(w)
            pair.update(zip(["<s>", *w[:-1]], w, strict=True))
            context.update(["<s>", *w[:-1]])
    n, v = sum(uni.values()), len(uni)
    base = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    kept = {p: c for p, c in pair.items() if c >= lm_score.MIN_COUNT}
    mass = defaultdict(float)
    for (a, _), c in kept.items():
        mass[a] += (c - lm_score.DISCOUNT) / context[a]

    def prob(a, w):
        if a not in context:
            return base(w)
        return max(0.0, kept.get((a, w), 0) - lm_score.DISCOUNT) / context[a] + (1 - mass[a]) * base(w)

    for a in list(context)[:5]:  # a proper distribution
        assert math.isclose(sum(prob(a, w) for w in uni) + prob(a, "unseen"), 1)
    for i, t in docs:
        w, r = tokens(t), got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(w), sum(x in uni for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10(base(x)) for x in w))
        assert abs(r.score - sum(math.log10(prob(a, x)) for a, x in zip(["<s>", *w[:-1]], w, strict=True))) < 2 * lm_score._STEP * len(w)


def test_a_pair_seen_once_is_kept(spark):
    docs = [(0, "red house"), (1, "green tree"), (2, "red car"), (10, "red house"), (11, "red tree")]
    got = {r.doc_id: r for r in lm_score.score_documents(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id") >= 10).collect()}
    assert got[10].base_score == got[11].base_score and got[10].score > got[11].score + 0.3


def test_model_beats_the_base_on_held_out_texts(spark):
    got = queries.op8_lm_score(spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()


def test_pair_counts_united_in_a_tree_give_the_same_scores(spark, monkeypatch):
    df = spark.range(0, 300, 1, 12).selectExpr("id AS doc_id", "concat('the word', id % 7, ' the word', id % 5, ' the end') AS text")
    held = F.col("doc_id") % 5 == 1
    want = sorted(map(tuple, lm_score.score_documents(df, held).collect()))
    monkeypatch.setattr(lm_score, "BYTES_PER_SHARD", 2_000)
    monkeypatch.setattr(lm_score, "BYTES_PER_SLICE", 1_000)
    monkeypatch.setattr(lm_score, "FAN_IN", 2)
    got = sorted(map(tuple, lm_score.score_documents(df, held).collect()))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(a, b, rel_tol=1e-12) for x, y in zip(got, want, strict=True) for a, b in zip(x[5:], y[5:], strict=True))


def test_scores_of_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BYTES_PER_SHARD", 1 << 10)  # many shards
    got = lm_score.score_documents(edge_docs(spark), F.lit(False)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 4, 4, 4, 4, 30_001] and all(r.n_known == r.n_tokens for r in got)
    held = lm_score.score_documents(edge_docs(spark), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == r.base_score for r in held)
    assert lm_score.score_documents(empty_docs(spark), F.lit(False)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=80), st.lists(st.integers(0, 2**41), max_size=20))
def test_elias_fano(values, wanted):
    values = sorted(values)
    e = EliasFano.encode(np.array(values, np.uint64))
    assert e.at(np.arange(len(values))).tolist() == values
    x = np.array(wanted + values, np.uint64)
    lo = np.zeros(len(x), np.int64)
    assert e.successor(x, lo, np.full(len(x), len(values))).tolist() == np.searchsorted(np.array(values, np.uint64), x).tolist()
    if len(values) > 4:
        part = np.array(values[2:-1], np.uint64)
        assert e.successor(x, lo + 2, np.full(len(x), len(values) - 1)).tolist() == (np.searchsorted(part, x) + 2).tolist()


# ------------------------------------------------------------ 9 nearest
def plain_nearest(ids, x, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


@pytest.mark.parametrize("scale", [False, True])
def test_recall_against_brute_force(spark, scale):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((6000, 32)).astype(np.float32)
    x[::50] = x[0]  # a common vector: ties
    if scale:
        x *= rng.uniform(0.2, 3, (6000, 1)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 20 == 0, rows_per_block=2000, queries_per_block=100).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = plain_nearest(np.arange(6000), x.astype(np.float64))
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / 20 for q, w in want.items()])
    assert recall >= 0.9
    for rows in got.values():
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0])) and len(rows) == 20


def test_few_and_unusable_vectors(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (20, [0.0, 2.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0])]
    df = spark.createDataFrame(bad + good, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in ann.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 1.0), (0, 2, 8, 1.0), (0, 3, 20, 0.0), (20, 1, 7, 2.0), (20, 2, 8, 2.0), (20, 3, 0, 0.0)]
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# ------------------------------------------------------------ 10 token counts
def test_counts_against_direct_tokenising(spark):
    enc = token_counts.encoding()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in queries.op10_token_counts(spark, SF_SMALL).collect()}
    assert got == {r.doc_id: len(enc.encode_ordinary(r.text)) for r in docs.collect()}
    special = EDGE + [(7, "<|endoftext|> is text", "en", "s", 1)]
    odd = token_counts.count(spark.createDataFrame(special, DOC).withColumn("file", F.lit("clash")), scratch_path(spark, "tokens-test")).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in odd), key=str) == sorted(((d[0], len(enc.encode_ordinary(d[1] or ""))) for d in special), key=str)
    assert token_counts.count(empty_docs(spark), scratch_path(spark, "tokens-none")).count() == 0


@pytest.mark.parametrize("ended", [True, False])
def test_documents_over_many_blocks(spark, tmp_dir, ended):
    import os

    os.makedirs(tmp_dir)
    rng = np.random.default_rng(2)
    sizes = [0, 0, 5, 400, 1, 0, 37, 900, 3, 12]
    ids = np.concatenate([np.append(rng.integers(0, 1000, n), token_counts.END_OF_DOCUMENT) for n in sizes])
    (ids if ended else ids[:-1]).astype(token_counts.DTYPE).tofile(f"{tmp_dir}/a.bin")
    open(f"{tmp_dir}/empty.bin", "wb").close()
    df = spark.createDataFrame([(f"{tmp_dir}/a.bin",), (f"{tmp_dir}/empty.bin",)], "file string")
    got = [tuple(r) for r in token_counts.scan(df, block_bytes=64).orderBy("ordinal").select("ordinal", "n_tokens", "ended").collect()]
    assert got == [(i, n, ended or i < len(sizes) - 1) for i, n in enumerate(sizes)]


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert [re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES] == [str(i) for i in range(1, 14)]
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries()) and set(oracles.ORACLES) <= set(entry.oracle_sql())


