"""Cleaning-step contracts (examples in the style of the reference's tests)."""

import pytest
from pyspark.sql import functions as F

from lexis.functions import text as tx
from lexis.operators import clean as cl


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


def test_normalize_quotes(spark):
    got = run(spark, tx.normalize_quotes, ["it’s a test", "don`t", "don´t", "“Hello”",
                                           "„Hello“", "«Hello»", "nothing here"])
    assert got == ["it's a test", "don't", "don't", '"Hello"', '"Hello"', '"Hello"', "nothing here"]


def test_remove_urls_and_mentions(spark):
    urls = run(spark, tx.remove_urls, ["check https://example.com/docs/python ok", "go to www.example.org/x now",
                                       "no links here"])
    assert "example.com" not in urls[0] and "example.org" not in urls[1] and urls[2] == "no links here"
    ments = run(spark, tx.remove_mentions, ["hey @john_doe what's up", "thanks u/helpful_user", "no mentions here"])
    assert "@john_doe" not in ments[0] and "u/helpful_user" not in ments[1] and ments[2] == "no mentions here"


def test_hashtags_emojis_special_spaces(spark):
    assert run(spark, tx.normalize_hashtags, ["#Python", "love #MachineLearning and #AI"]) == \
        ["Python", "love MachineLearning and AI"]
    emo = run(spark, tx.remove_emojis, ["hello\U0001f525world", "from \U0001f1f2\U0001f1fdMexico", "smile :) sad :("])
    assert "\U0001f525" not in emo[0] and "\U0001f1f2" not in emo[1] and ":)" not in emo[2] and ":(" not in emo[2]
    spec = run(spark, tx.remove_special_characters, ["don't", "hello123", "a$b&c!?", "café naïve"])
    assert spec[0] == "don't" and spec[1] == "hello123" and "$" not in spec[2] and "é" not in spec[3]
    assert run(spark, tx.normalize_spaces, ["hello    world", "hello\t\n\nworld", "  hello world  ", "", "     "]) == \
        ["hello world", "hello world", "hello world", "", ""]


def test_clean_text_chain(spark):
    got = run(spark, tx.clean_text, ["Check https://example.com/t/test @mod_bot THIS is FINE \U0001f525 #Tag $5 & more",
                                     "", None, "https://example.com/all", "time:people :D"])
    assert got[0] == "check this is fine tag 5 more"
    assert got[1] == "" and got[2] == "" and got[3] == ""
    # lower-casing precedes emoticon removal: ':D' becomes ':d' and its 'd' survives; ':p' inside words is eaten
    assert got[4] == "time eople d"


def test_fix_encoding_subset(spark):
    got = run(spark, tx.clean_text, ["canâ€™t stop", "fish &amp; chips", "ＡＢＣ ﬁne",
                                     "ctrl\x00char"])
    assert got == ["can't stop", "fish chips", "abc fine", "ctrlchar"]


def test_fix_encoding_of_both_codecs(spark):
    """Expected values are literals; the garbled forms are made by Python's codecs."""
    garble = lambda t, codec, times=1: t if not times else garble("".join(
        bytes([b]).decode(codec) if codec == "latin-1" or b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in t.encode()), codec, times - 1)
    cases = [("it\u00e2\u0080\u0099s fine", "it's fine"), ("caf\u00c3\u00a9", "café"),
             ("he said \u00e2\u0080\u009chello\u00e2\u0080\u009d", 'he said "hello"'), ("clean text here", "clean text here"),
             ("hello\x00world", "helloworld"), ("voilà\u00a0» naïve Ärger â la carte", "voilà\u00a0\" naïve Ärger â la carte"),
             ("garbled Ã©\ue000 seam", "garbled Ã©\ue000 seam"), (None, None), ("", "")]
    for plain, fixed in (("don’t", "don't"), ("“naïve” café – Über €5…", '"naïve" café – Über €5…'), ("привет ελλάδα", "привет ελλάδα"),
                         ("fire 🔥!", "fire 🔥!")):
        cases += [(garble(plain, codec, times), fixed) for codec in ("latin-1", "cp1252") for times in (1, 2, 3)]
    assert run(spark, tx.fix_encoding, [c[0] for c in cases]) == [c[1] for c in cases]
    assert run(spark, tx.clean_text, ["it\u00e2\u0080\u0099s fine", "caf\u00c3\u00a9 \u00e2\u0080\u009chello\u00e2\u0080\u009d"]) == ["it's fine", "caf hello"]


def test_variants(spark):
    gen = run(spark, cl.clean_general, ["I do not want this and never that"])[0].split()
    assert "not" in gen and "never" in gen and "and" not in gen and "this" not in gen
    cur = run(spark, cl.clean_curated, ["this is the sentence in english"])[0].split()
    assert cur == ["sentence", "english"]
    assert run(spark, cl.clean_curated, [""]) == [""]


def test_stemming_variant(spark):
    df = spark.createDataFrame([(1, "die"), (2, "dying"), (3, "died"), (4, "running runs ran runner"), (5, "")],
                               "text_id int, text string")
    out = dict(cl.clean_frame(df, "text", "stemming").select("text_id", "text").collect())
    assert out[1] == out[2] == out[3] == "die"
    assert len(out[4].split()) == 4 and out[4].split()[0] == out[4].split()[1] == "run"
    assert out[5] == ""
    with pytest.raises(ValueError):
        cl.clean_frame(df, "text", "nope")


def test_ngrams_short_documents(spark):
    df = spark.createDataFrame([(["a"],), ([],), (["a", "b", "c"],)], "w array<string>")
    got = [r[0] for r in df.select(tx.ngrams(F.col("w"), 1, 3)).collect()]
    assert got == [["a"], [], ["a", "b", "c", "a b", "b c", "a b c"]]


def test_stems_of_the_extended_rules():
    from lexis.functions.porter import stem
    assert [stem(w) for w in ("emotionally", "conditionally", "geology", "hopelessly")] == ["emot", "condit", "geolog", "hopelessli"]


def test_cleaning_of_odd_blanks_entities_and_double_mojibake(spark):
    from lexis.functions import text as tx
    cases = {"https://x.com hello world": "hello world", "don&#8217;t can&rsquo;t caf&eacute; &#x41;&unknown;": "don't can't caf a unknown",
             "isnÃ¢â‚¬â„¢t": "isn't", "a &amp;lt; b": "a lt b", "x <b> &amp;": "x b amp"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", tx.clean_text("t").alias("c")).collect()
    assert {r.t: r.c for r in rows} == cases


def test_special_classes_equal_the_negated_pattern(spark):
    points = [*range(0xD800), *range(0xE000, 0x10000), *range(0x1F600, 0x1F650), 0x10FFFF]
    df = spark.createDataFrame([("".join(f"a{chr(p)}" for p in points[k:k + 500]),) for k in range(0, len(points), 500)], "s string")
    negated = F.regexp_replace("s", tx.SPECIAL_PATTERN, " ")
    assert df.where(tx.remove_special_characters("s") != negated).count() == 0
    fused = F.trim(F.regexp_replace("s", tx.SPECIAL_OR_SPACE_RUN, " "))
    assert df.where(fused != tx.normalize_spaces(negated)).count() == 0


def test_repair_levels_do_not_multiply(spark):
    plan = spark.createDataFrame([("x",)], "s string").select(tx.fix_encoding("s"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(tx.MOJIBAKE_SEQUENCE) <= 20  # each level naming its input three times made it 184


def test_first_characters_of_the_repair_trigger(spark):
    heads = [chr(p) for p in range(0x80, 0x10000) if not 0xD800 <= p < 0xE000] + ["&"]
    tails = ["", "\x80", "\x92", "\x86", "\x9c", "€", "\x9f\x98\x80", "¬\x80", "»\x80"]
    df = spark.createDataFrame([(h + t,) for h in heads for t in tails if not h.isspace()], "s string")
    assert df.where(F.col("s").rlike(tx.REPAIR_TRIGGER) & ~F.col("s").rlike(tx.REPAIR_FIRST)).count() == 0
    assert df.where(F.col("s").rlike(tx.REPAIR_TRIGGER)).count() > 100


def test_variants_side_by_side_share_one_base_clean(spark):
    df = spark.createDataFrame([("The news &amp; it's NOT running",), ("",), (None,), ("of the",)], "t string")
    wide = cl.with_variants(df, "t", list(cl.VARIANTS))
    got = wide.collect()
    for name in cl.VARIANTS:
        want = [r[0] for r in cl.clean_frame(df, "t", name).collect()]
        assert [r[f"clean_{name}"] for r in got] == want
    with pytest.raises(ValueError):
        cl.with_variants(df, "t", ["lemmas"])
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(tx.CONTROL_CHARS_PATTERN) == cl.clean_frame(df, "t")._jdf.queryExecution().optimizedPlan().toString().count(
        tx.CONTROL_CHARS_PATTERN)


def test_gated_cleaning_equals_the_plain_chain(spark):
    """Every step on every text, mojibake level by level over whole texts."""
    def plain(c):
        c = F.regexp_replace(c, tx.CONTROL_CHARS_PATTERN, "")
        rep = c
        for _ in range(tx.GARBLING_LEVELS):
            rep = tx.decode_mojibake(rep)
        rep = tx._replace_all(F.when(F.instr(c, "<") > 0, rep).otherwise(tx.unescape_html(rep)), tx.LIGATURES)
        return F.translate(F.when(c.rlike(tx.REPAIR_TRIGGER), rep).otherwise(c), tx.SINGLE_FROM, tx.SINGLE_TO)

    def plain_clean(c):
        c = F.lower(plain(F.coalesce(c, F.lit(""))))
        c = tx.remove_emojis(tx.normalize_hashtags(tx.remove_mentions(tx.remove_urls(c))))
        return tx.normalize_spaces(tx.remove_special_characters(c))

    garbled = "it’s “naïve” 🔥 Ünï привет".encode().decode("latin-1")
    twice = garbled.encode().decode("latin-1")
    texts = [chr(p) for p in [*range(0x3100), *range(0xE000, 0x10000), 0x1F525, 0x10FFFF]]
    texts += [garbled, twice, f"日本{twice}日本 é{garbled}", f"&amp; {garbled} <b>", f"{garbled}\ue000", "\x01 &#8217; ﬁ", "WWW.a.de x", "a/u/b @c #  d",
              "é Ã©", ":p=) ;-D", None, "", "plain words only"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").withColumn("t", F.concat(F.lit("a"), F.col("s"), F.lit("b ")))
    for t in ("s", "t"):
        c = F.col(t)
        assert [r.s for r in df.where(~tx.fix_encoding(c).eqNullSafe(plain(c))).collect()] == []
        assert [r.s for r in df.where(~tx.clean_text(c).eqNullSafe(plain_clean(c))).collect()] == []
    assert df.where(~plain(F.col("s")).eqNullSafe(F.col("s")) & ~(F.col("s").rlike(tx.NOT_PLAIN) & F.col("s").rlike(tx.REPAIR_OR_MAP))).count() == 0


def test_cleaning_is_one_pass_without_regex_scans(spark):
    df = spark.createDataFrame([("a",)], "t string")
    for name in cl.VARIANTS:
        plan = cl.clean_frame(df, "t", name)._jdf.queryExecution().executedPlan().toString()
        assert "regexp" not in plan and plan.count("ArrowEvalPython") == 1
    wide = cl.with_variants(df, "t", list(cl.VARIANTS))._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in wide and wide.count("_cleaned(") == 1


def test_cleaning_of_texts_that_are_not_sound_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"Abc\xff \xc3 def"),)], "b binary").selectExpr("cast(b as string) as t")
    assert [r[0] for r in df.select(tx.clean_text("t")).collect()] == ["abc def"]


def test_word_tokens_of_plain_and_other_texts_follow_one_pattern(spark):
    texts = ["", "a", "it's a_b 1 22 a-bc  x", "Zoë and ÉCOLE ab", "日本ab cd", None, "ab\tcd\ne", "_ __ a1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_extract_all(F.lower(F.coalesce("t", F.lit(""))), F.lit(tx.WORD_TOKEN_PATTERN), 0)
    assert df.where(~tx.word_tokens("t").eqNullSafe(plain)).count() == 0
