"""HTML extraction, language id, quality and url filter on small planted cases."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexis.llm import language_id, quality, url_filter
from lexis.llm.html_text import extract, main_texts
from lexis.session import materialize

FURNITURE = ("<header><h2>Site</h2></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>"
             "<div class='cookie-banner'>We use cookies, accept them all please.</div>")
TAIL = ("<aside class=sidebar><p>Popular stories that many readers liked this week.</p></aside>"
        "<section id=comments><p>What a long and thoughtful reader comment this is, indeed.</p></section>"
        "<form><label>Search</label><input name=q></form><footer>&copy; 2024 Site</footer><script>if (a < b) go();</script>")


@pytest.mark.parametrize("article", [
    "<article><h1>Title &amp; more</h1><p>First   paragraph of\n some length.</p><p>Second <b>bold</b> one &eacute;.</p></article>",
    "<main><div><h1>Title &amp; more</h1><p>First paragraph of some length.<p>Second <i>bold</i> one &#233;.</div></main>",
    "<div class='post-content'><h1>Title &amp; more</h1><p>First paragraph of some length.</p><p>Second bold one é.</div>"])
def test_article_without_furniture(article):
    want = "Title & more\nFirst paragraph of some length.\nSecond bold one é."
    assert extract(f"<html><head><title>T</title></head><body>{FURNITURE}{article}{TAIL}</body></html>") == want


@pytest.mark.parametrize("tag", ['<p class="a"">', "<img alt='It's here'>", '<p title="a" b">', "<p title=a'b>", '<br / ">',
                                 '<a href=x?a="b>', "<p data-x = 'a' ' c>"])
def test_stray_quotes_end_with_their_tag(tag):
    assert extract(f"<div><p>before</p>{tag}middle</p><p>it's the \"end\" of it</p></div>") == "before\nmiddle\nit's the \"end\" of it"
    assert extract(f"<div><p>before</p>{tag}middle</p><p>the end</p></div>") == "before\nmiddle\nthe end"


@pytest.mark.parametrize("tag", ["article", "main"])
def test_article_keeps_its_link_lists_and_sections(tag):
    links = "<ul><li><a href=/1>First source</a></li><li><a href=/2>Second source</a></li></ul>"
    body = ("<h1>Sources</h1><p>A paper that lists all of its sources.</p>" + links +
            "<section id=discussion><h2 id='search-algorithms'>Search</h2><p>Discussed here.</p></section>"
            "<div class='social-science'>Social.</div><section id='related-work'>Others did it <b id=notice>too</b>.</section>")
    out = ("<nav>" + links + "</nav><ul class='related'><li><a href=/3>Not this</a></li></ul><div role=navigation>nor this</div>"
           "<div class='social-share'>share</div><div class='cookiebar'>ok?</div><div id=comments>me too</div>")
    want = ("Sources\nA paper that lists all of its sources.\nFirst source\nSecond source\nSearch\nDiscussed here.\nSocial.\n"
            "Others did it too.")
    assert extract(f"<body>{FURNITURE}<{tag}>{body}{out}</{tag}>{TAIL}</body>") == want
    assert extract(f"<body>{FURNITURE}<{tag}><h1>Links</h1>{links}</{tag}>{TAIL}</body>") == "Links\nFirst source\nSecond source"


def test_value_without_closing_quote():
    assert extract('<p>before</p><p class="a>middle</p><p>end') == "before\nmiddle\nend"
    assert extract('<p title="a > b">x</p><p title=\'<p>\'>y</p>') == "x\ny"


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<html></html>", ""), ("just words", "just words"), ("<p>a<p>b<br>c", "a\nb c"),
    ("<p>1 < 2 &lt; 3", "1 < 2 < 3"), ("<p>cut off <b", "cut off"), ("<style>p{}</style><p>x</p><!-- y -->", "x"),
    ("<p>a <span class=ad>buy <span>this</span> now</span> b <b>c</b></p>", "a b c"), ("<p>a <span class=ad>buy<p>b", "a\nb"),
    ("<div id=cookiebar>ok?</div><p>text of the page</p>", "text of the page"),
    ("<p>caf&eacute;&#x21;&nbsp;&unknown;", "café! &unknown;")])
def test_odd_pages(page, want):
    assert extract(page) == want


def test_given_pages_equal_their_articles(spark, sf):
    import html
    import re
    rows = duckdb.sql(f"select page_id, url, html from read_parquet('{sf}/pages.parquet')").fetchall()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: (r.text, r.n_chars) for r in main_texts(df).collect()}
    for page, _, source in rows:
        body = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>?", " ", x) if "<br>" in x else re.sub(r"<[^>]*>?", "", x)).split())
                 for x in re.split(r"</?(?:p|h1)>", body))
        want = "\n".join(x for x in parts if x)
        assert got[page] == (want, len(want))


def test_language_of_held_out_documents(spark, sf):
    from lexis.llm.queries import QUERIES
    langs = dict(duckdb.sql(f"select doc_id, lang from read_parquet('{sf}/documents.parquet')").fetchall())
    rows = [r for r in QUERIES["op6_language_id"](spark, sf).collect() if r.held_out]
    assert rows and sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    train = spark.createDataFrame([(1, "the house is big", "en"), (2, "das haus ist groß", "de"), (3, None, "en"), (4, "x", None)],
                                  "doc_id long, text string, lang string")
    model = language_id.fit(train)
    rows = [(1, "THE house!"), (2, "größer HAUS"), (3, None), (4, "12 34 --"), (5, ""), (6, "groß " * 50_000), (None, "house")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: r.lang_pred for r in language_id.identify(df, model).collect()}
    assert got == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "de", None: "en"}
    empty = language_id.fit(train.limit(0))
    assert language_id.identify(df, empty).filter("lang_pred <> 'und'").count() == 0
    assert language_id.identify(df.limit(0), model).count() == 0


def test_quality_keeps_trusted_and_rejects_junk(spark, sf):
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")
    labels = spark.read.parquet(sf.replace("0.001", "0.01") + "/labels.parquet")
    got = quality.classify(docs.withColumn("kept", F.lit(1)), labels)
    rows = got.join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.toxic]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(junk) <= 0.35 * len(junk)


def test_quality_edges(spark):
    docs = [(i, f"a sound text number {i} with some plain words in it", "en") for i in range(40)]
    docs += [(100, None, "en"), (101, "", "en"), (102, "no model here", "xx"), (103, "some text", None), (None, "a sound text", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(5, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(df, labels, with_text=True).collect()
    assert len(rows) == len(docs) and all(r.kept for r in rows if (r.doc_id or 0) >= 100)
    assert {r.doc_id for r in rows if r.perplexity is None} == {100, 101, 102, 103}
    assert all(r.kept for r in quality.classify(df, labels.limit(0)).collect())
    assert quality.classify(df.limit(0), labels).count() == 0


def test_quality_writes_no_table_of_texts(spark, monkeypatch):
    rows = [(i, f"some sound words of text number {i % 7}", "en") for i in range(60)] + [(99, "vile vile words", "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(99, 0, 1)], "doc_id long, quality int, toxic int")
    written = []
    monkeypatch.setattr(quality, "materialize", lambda df, name, *codec: written.append(df.columns) or materialize(df, name, *codec))
    got = quality.classify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels).collect()
    assert len(got) == 61 and all(r.perplexity is not None for r in got) and written
    assert not any("text" in columns for columns in written)


def test_packed_counts_of_the_quality_model_come_back_whole():
    keys = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 50).astype(np.uint64))
    counts = [np.arange(50) * k for k in (1, 300, 0, 7)]
    batch = quality._sharded("en", "contexts", 0, keys, [keys], counts)
    back = quality._unpacked(pa.Table.from_batches([batch, batch]), 1, 4)
    assert all((np.tile(a, 2) == b).all() for a, b in zip([keys, *counts], back))
    assert len(batch.column("data")[0].as_py()) == 8 * 51 + 4 * 50 + 8 * sum((c >= 255).sum() for c in counts)


def test_quality_rejects_toxic_documents_whose_labels_it_has_not_seen(spark, sf):
    docs = spark.read.parquet(sf.replace("0.001", "0.1") + "/documents.parquet").filter("lang = 'en'")
    labels = spark.read.parquet(sf.replace("0.001", "0.1") + "/labels.parquet")
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = quality.classify(docs, labels.filter(~hidden)).join(labels.filter(hidden & (F.col("quality") == 1)), "doc_id").collect()
    clean, toxic = [r.kept for r in rows if not r.toxic], [r.kept for r in rows if r.toxic]
    assert len(toxic) > 40 and sum(toxic) <= 0.15 * len(toxic)
    assert sum(clean) >= 0.98 * len(clean)


def test_quality_model_for_a_rare_language(spark):
    text = "a sound text number %d with some plain words in it and a few more of them"
    docs = [(i, text % i, "en") for i in range(3000)] + [(5000 + i, "ein ganz " + text % i, "de") for i in range(20)]
    df = spark.createDataFrame([*docs, (9000, "XQ# 77 ZZ! @@ 0x1 QQ# 99", "de")], "doc_id long, text string, lang string").repartition(4)
    labels = df.filter("doc_id < 9000").selectExpr("doc_id", "1 as quality", "0 as toxic")
    rows = {r.doc_id: r for r in quality.classify(df, labels, max_docs=100).collect()}
    assert all(r.perplexity is not None for r in rows.values())
    assert not rows[9000].kept and all(rows[d].kept for d, _, lang in docs if lang == "de")
    drawn = {r.lang: r.n for r in quality.sample_ids(df, labels, 100).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert drawn["de"] >= 10 and 60 <= drawn["en"] <= 140
    assert quality.sample_ids(df, labels, 3000, 20_000).filter("lang = 'en'").count() < 500


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def test_url_rules_and_model(spark):
    rows = [(1, "http://a.B.example.NET/en/x?q", "allow", "example.net/en/"), (2, "https://example.net/de/", "block", "net/"),
            (3, "https://m.example.com/de/1#t", "block", "example.com/de/"), (4, "http://x.org/fr/", "allow", "org/fr/"),
            (5, "http://x.net", None, None), (6, "no scheme", None, None), (7, None, None, None), (8, "a://://b", None, None),
            (9, "http://badexample.com/de/1", None, None), (10, "http://www.casino-bets.com/en/5", "block", None),
            (11, "https://blog.quietgarden.com/en/7", "allow", None), (12, "x" * 200_000, None, None)]
    df = spark.createDataFrame([(a, b) for a, b, *_ in rows], "page_id long, url string").withColumn("rule", F.lit("clash"))
    model = url_filter.fit(url_filter.labelled_urls(spark))
    got = {r.page_id: r for r in url_filter.judge(df, model, RULES).collect()}
    for page, _, verdict, rule in rows:
        assert got[page].rule == rule and (verdict is None or got[page].verdict == verdict), page
    assert (got[1].host, got[1].path) == ("a.b.example.net", "/en/x")
    assert (got[6].host, got[6].path, got[7].host) == ("", "", "") and (got[8].host, got[8].path) == (":", "//b")
    assert (got[5].host, got[5].path) == ("x.net", "")
    with pytest.raises(ValueError):
        url_filter.longest_rule(F.lit(""), F.lit(""), [("x/", "block")] * 10_001)


def test_quality_perplexity_equals_brute_force(spark, sf):
    """Sharded counts against a dictionary Kneser-Ney model of the same sample."""
    import collections
    import math

    import numpy as np
    import pyarrow as pa
    from lexis.llm.lm import BEGIN, discounts
    from lexis.llm.registry import table
    from lexis.llm.words import text_slices

    docs = table(spark, sf, "documents").select("doc_id", "text", "lang").filter("doc_id < 120")
    docs = docs.union(spark.createDataFrame([(900, "one two one two one", None), (901, "", None), (902, "one one one one", None)], docs.schema))
    chosen = docs.filter("doc_id % 2 = 0").select("doc_id", "lang")
    models = quality.fit(docs, chosen)
    got = {r.doc_id: r for r in quality.perplexities(docs, models, {}).collect()}
    rows = docs.collect()
    for lang in {r.lang for r in rows}:
        mine = [r for r in rows if r.lang == lang]

        def tokens(texts, common):
            (_, _, words), = text_slices(pa.record_batch([pa.array(texts, pa.string())], names=["text"]))
            flow, before, sizes = quality.stream(words, quality.raw_tokens(words), common)
            return np.split(flow, np.cumsum(sizes)[:-1])

        texts = [r.text for r in mine if r.doc_id % 2 == 0]
        (_, _, words), = text_slices(pa.record_batch([pa.array(texts, pa.string())], names=["text"]))
        held = collections.Counter(quality.raw_tokens(words)[0].tolist())
        common = np.array(sorted(w for w, n in held.items() if n >= quality.COMMON), np.uint64)
        pairs = collections.Counter((a, b) for doc in tokens(texts, common) for a, b in zip([int(BEGIN), *doc.tolist()], doc.tolist()))
        fans = collections.Counter(w for _, w in pairs)
        of = collections.Counter()
        for (v, _), n in pairs.items():
            of[v] += n
        d1, d2 = ([0, *discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)])] for c in (fans, pairs))
        unknown = sum(d1[min(n, 3)] for n in fans.values()) / len(pairs) / (len(fans) + 1)
        gamma = collections.Counter()
        for (v, _), n in pairs.items():
            gamma[v] += d2[min(n, 3)] / of[v]
        for r in mine:
            if not (r.text or "").split():
                assert got[r.doc_id].perplexity is None
                continue
            doc = tokens([r.text], common)[0].tolist()
            logs = 0.0
            for v, w in zip([int(BEGIN), *doc], doc):
                p1 = (fans[w] - d1[min(fans[w], 3)] if fans[w] else 0) / len(pairs) + unknown
                n = pairs[v, w]
                logs += math.log((max(n - d2[min(n, 3)], 0) / of[v] if n else 0) + (gamma[v] if of[v] else 1.0) * p1)
            assert math.isclose(got[r.doc_id].perplexity, math.exp(-logs / len(doc)), rel_tol=1e-9)


def test_rare_languages_are_sampled_like_frequent_ones(spark):
    assert language_id.sample_share(10 ** 10, 3_000) == 3e-7 and language_id.sample_share(2, 3_000) == 1.0
    rows = [(i, f"alpha beta gamma delta {i}", "name") for i in range(30_000)]
    rows += [(100_000 + i, "ключ вода зима", "odd`lang") for i in range(3)]
    rows += [(200_000 + i, "uno dos tres", "1") for i in range(40)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(train, max_docs=200, max_words=12, max_grams=60)
    assert model.langs == ["1", "name", "odd`lang"] and len(model.names[0]) <= 12
    asked = spark.createDataFrame([(1, "вода зима"), (2, "beta gamma"), (3, "dos tres")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(asked, model).collect()} == {1: "odd`lang", 2: "name", 3: "1"}


def test_quality_counts_every_trusted_document(spark, monkeypatch):
    """Four fifths train and the others give thresholds, however many there are; more shards give the same model."""
    docs = [(i, f"the {i % 97} plain words of text {i % 89} in a row of {i % 53}", "en") for i in range(6000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    trusted = df.select("doc_id")
    chosen = quality.sample_ids(df, trusted)
    assert 4650 <= chosen.count() <= 4950
    folder, counts, bits = quality.fit(df, chosen)
    few = {r.doc_id: r.perplexity for r in quality.perplexities(df, (folder, counts, bits), {}).collect()}
    monkeypatch.setattr(quality, "BYTES_PER_SHARD", 2_000)
    models = quality.fit(df, chosen)
    assert bits == quality.SHARD_BITS and models[2] > bits and models[1]["en"].tolist() == counts["en"].tolist()
    many = {r.doc_id: r.perplexity for r in quality.perplexities(df, models, {}).collect()}
    assert many.keys() == few.keys() and all(abs(many[k] - few[k]) <= 1e-12 * few[k] for k in few)
    labels = trusted.selectExpr("doc_id", "1 as quality", "0 as toxic")
    whole = {r.doc_id: r.perplexity for r in quality.classify(df, labels).collect()}
    assert all(abs(whole[k] - few[k]) <= 1e-12 * few[k] for k in few)


def test_quality_shuffles_ids_and_counts_but_no_text(spark, monkeypatch):
    """Labelled rows are found without a join of texts; merging a task's counts and wide values change nothing."""
    text = "some plain words of text %d in a row with %d and a few more of them"
    docs = [(i, text % (i % 97, i % 53), "en" if i % 3 else None) for i in range(2000)] + [(2000, None, "en"), (None, "no id", "en"), (7, "again 7", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    labels = df.filter("doc_id % 2 = 0").selectExpr("doc_id", "1 as quality", "cast(doc_id % 40 = 0 as int) as toxic")
    labels = labels.union(labels.limit(5)).union(spark.createDataFrame([(None, 1, 0)], labels.schema))
    marks = quality.marked(labels)
    told = quality.told(df, marks)
    assert "Exchange" not in told._jdf.queryExecution().executedPlan().toString().replace("Exchange RoundRobin", "").replace("REPARTITION", "")
    want = {r.doc_id: quality.TRUSTED for r in quality.trusted_ids(labels).collect()} | {r.doc_id: quality.TOXIC for r in quality.toxic_ids(labels).collect()}
    assert all(r["__mark"] == want.get(r.doc_id, 0) for r in told.collect())
    monkeypatch.setattr(quality, "IDS_PER_SHARD", 100)
    sharded = quality.marked(labels)
    assert sharded[1] > 0 and all(r["__mark"] == want.get(r.doc_id, 0) for r in quality.told(df, sharded).collect())


def test_quality_merges_the_counts_of_a_task():
    import numpy as np
    rng = np.random.default_rng(1)
    slices = [("a" if k % 3 else None, *np.unique(rng.integers(0, 300, 200).astype(np.uint64), return_counts=True)) for k in range(40)]
    whole, merged = {}, {}
    for lang, keys, counts in slices:
        for k, n in zip(keys.tolist(), counts.tolist()):
            whole[lang, k] = whole.get((lang, k), 0) + n
    sent = list(quality._combined(iter(slices)))
    for lang, keys, counts in sent:
        for k, n in zip(keys.tolist(), counts.tolist()):
            merged[lang, k] = merged.get((lang, k), 0) + n
    assert merged == whole and sum(len(x[1]) for x in sent) == len(whole)


def test_quality_tables_hold_counts_of_any_size(tmp_path):
    import numpy as np
    for top in (1, 300, 70_000, 1 << 40):
        keys, values = np.array([3, 5, 9], np.uint64), np.array([[0, 1], [top, 2], [7, top]], np.int64)
        quality._save(str(tmp_path), f"t{top}", 0, keys, values)
        assert quality.Table(str(tmp_path), f"t{top}", 2, 0).join(np.array([4, 5, 9], np.uint64)).tolist() == [[0, 0], [top, 2], [7, top]]
