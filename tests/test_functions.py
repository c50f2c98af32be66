import math
import random

import porter
import pytest
from pyspark.sql import functions as F

from voxloom.functions import dates as D
from voxloom.functions import emoji as E
from voxloom.functions import labels as L
from voxloom.functions import stem as S
from voxloom.functions import text as X
from voxloom.functions.stats import wilson_ci
from voxloom.taxonomy import (SERVICE_ASPECTS, aspect_regex, keyword_regex, minimal_keywords,
                              taxonomy_frame)


def one(spark, column, *values, schema="t string"):
    df = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
    return [r[0] for r in df.select(column.alias("x")).collect()]


NBSP, EM, LSEP, NEL = chr(0xA0), chr(0x2003), chr(0x2028), chr(0x85)


@pytest.mark.parametrize("raw, want", [
    ("sooooo good", "soo good"),
    ("1000/100", "100/100"),
    ("wait...", "wait.."),
    ("a\n\n\n\nb", "a b"),
    (f"a{NBSP * 3}b", "a b"),
    (f"{EM}lead", "lead"),
    (f"x{LSEP * 3}y", "x y"),
    (f"x{NEL}y", "x y"),
    ("p\x1cq\x1f\x1dr", "p q r"),
    ("\U0001F600" * 5, "\U0001F600" * 2),
    ("see https://a.b/c?d<e> www.x.y z", "see z"),
    ("https://a.b\x1cnext", "next"),
    ("a<\n>b", "a b"),
    ("a < b > c", "a c"),
    ("", ""),
    (None, ""),
    ("KEEPS Case", "KEEPS Case"),
    ("aaa" + "bbb" * 2, "aabb"),
])
def test_clean_text(spark, raw, want):
    assert one(spark, X.clean_text("t"), raw) == [want]


def test_clean_is_idempotent_on_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    once = docs.select(X.clean_text("text").alias("a")).withColumn("b", X.clean_text("a"))
    assert once.filter("a <> b").count() == 0


def test_word_count(spark):
    assert one(spark, X.word_count("t"), "", None, "a", "a b", "a b c") == [0, 0, 1, 2, 3]


def test_keyword_boundaries(spark):
    texts = ["my lag.", "élag", "é lag", "lag_x", "LAG", "lagging", "rm50", "rm 50", None]
    assert one(spark, X.keyword_match("t", ["lag", "rm"]), *texts) == [
        True, False, True, False, True, False, False, True, False]


def test_phrases_and_meta_characters(spark):
    assert one(spark, X.keyword_match("t", ["c++", "a.b"]), "use c++x", "c++", "a.b", "aXb") == [
        True, False, True, False]
    assert one(spark, X.keyword_match("t", []), "anything") == [False]


def test_minimal_keywords_keep_the_result(spark):
    for aspect, keywords in SERVICE_ASPECTS.items():
        kept = minimal_keywords(keywords)
        assert set(kept) <= set(keywords) and kept, aspect
    assert "no signal" not in minimal_keywords(SERVICE_ASPECTS["coverage"])
    assert "dropped call" in minimal_keywords(SERVICE_ASPECTS["coverage"])
    every = [k for ks in SERVICE_ASPECTS.values() for k in ks]
    full = F.lower("t").rlike("|".join(keyword_regex(k) for k in SERVICE_ASPECTS["coverage"]))
    slim = F.lower("t").rlike(aspect_regex(SERVICE_ASPECTS["coverage"]))
    assert one(spark, full == slim, *every) == [True] * len(every)


def test_aspects_in_taxonomy_order(spark):
    got = one(spark, X.extract_aspects("t", SERVICE_ASPECTS),
              "App crashes, slow speed and no signal", "nothing here", None)
    assert got == [["coverage", "speed", "app_usability"], [], []]
    assert taxonomy_frame(spark, SERVICE_ASPECTS).select(F.size("keywords")).collect()[2][0] == 18


def test_matched_keywords_overlap(spark):
    got = one(spark, X.matched_keywords("t", SERVICE_ASPECTS), "no signal, signal")
    assert {(r.aspect, r.keyword) for r in got[0]} == {
        ("coverage", "no signal"), ("coverage", "signal")}


def test_sentences(spark):
    text = "A lag. B fast!\n\nC\nD? "
    assert one(spark, X.split_sentences("t"), text) == [["A lag.", "B fast!", "C", "D?", ""]]
    assert one(spark, X.aspect_sentences("t", ["fast", "lag"]), text) == ["A lag. B fast!"]
    assert one(spark, X.aspect_sentences("t", ["zzz"]), text) == [text]


def test_tokens_and_ngrams(spark):
    assert one(spark, X.tokenize("t"), "A bb ÉÉ c_d x1, y", None) == [["bb", "éé", "c_d", "x1"], []]
    arrays = [(["a", "b", "c"],), (["a"],), ([],)]
    assert one(spark, X.ngrams("t", 3), *arrays, schema="t array<string>") == [
        ["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_term_counts(spark):
    arrays = [(["b", "a", "b", "b"],), ([],), (["x"],)]
    got = one(spark, X.term_counts("t"), *arrays, schema="t array<string>")
    assert [[(r.term, r.tf) for r in rows] for rows in got] == [
        [("a", 1), ("b", 3)], [], [("x", 1)]]


def test_small_string_forms(spark):
    assert one(spark, X.slug("t"), "XLM-R a/b c") == ["XLM_R_a_b_c"]
    assert one(spark, X.tier_short("t"), "Forum (cross)", "Plain") == ["Forum", "Plain"]
    assert one(spark, X.display_aspect("t"), "app_usability") == ["app usability"]
    assert one(spark, X.percent(F.lit(0.873)), "x") == ["87%"]
    assert one(spark, X.extract_topic_id("t"), "/topic/77/all", "/x") == ["77", None]
    assert one(spark, X.concat_title_body("t", F.lit(None)), " Hi ") == ["Hi"]
    assert one(spark, X.concat_title_body("t", F.lit("b")), "Hi") == ["Hi\n\nb"]
    assert one(spark, X.truncate_text("t", 3), "abcdef", "ab") == ["abc", "ab"]
    assert one(spark, X.page_url("u", "t", F.lit(0)), "5") == ["u/topic/5"]
    assert one(spark, X.page_url("u", "t", F.lit(20)), "5") == ["u/topic/5?st=20"]
    assert one(spark, X.page_number_url("t", F.lit(1)), "u") == ["u"]
    assert one(spark, X.page_number_url("t", F.lit(2)), "u") == ["u?page=2"]
    assert one(spark, X.id_fallback("t", F.lit("B"), F.lit(2), F.lit(7)), "", None, "k") == [
        "B_2_7", "B_2_7", "k"]


def test_emoji(spark):
    thumbs, heart = "\U0001F44D\U0001F3FD", "❤️"
    texts = [f"ok {thumbs}!", f"{heart}x_y", "plain_9 #", None]
    assert one(spark, E.has_emoji("t"), *texts) == [True, True, False, False]
    assert one(spark, E.emoji_strip("t"), *texts) == ["ok !", "x_y", "plain_9 #", ""]
    assert one(spark, E.emoji_demojize("t"), *texts) == [
        "ok  thumbs up medium skin tone !", " heavy black heart x y", "plain 9 #", ""]
    more = ["⭐⏰ ‼ ™ ✓", "a\u200Db", "\U0001F468\u200D\U0001F469 x", "#️⃣ 5 # 2⃣", "▶️x"]
    assert one(spark, E.has_emoji("t"), *more) == [True, False, True, True, True]
    assert one(spark, E.emoji_strip("t"), *more) == ["   ✓", "a\u200Db", " x", " 5 # ", "x"]
    assert one(spark, E.emoji_demojize("t"), *more[2:4]) == [" family man woman  x", " keycap #  5 #  keycap 2 "]
    sequences = ["\U0001F1F2\U0001F1FE\U0001F1F2", "\U0001F468\U0001F3FF\u200D\U0001F469\u200D\U0001F466\u200D\U0001F466",
                 "\u2764\uFE0F\u200D\U0001F525", "\U0001F3F4\U000E0067\U000E0062\U000E0073\U000E0063\U000E0074\U000E007F.", "\U0001F3FD"]
    assert one(spark, E.emoji_demojize("t"), *sequences) == [
        " flag my  regional indicator symbol letter m ", " family man dark skin tone woman boy boy ", " heavy black heart fire ",
        " flag gbsct .", " medium skin tone "]
    assert one(spark, E.emoji_demojize("t", flags={"my": "malaysia"}), *sequences[:1]) == [
        " flag malaysia  regional indicator symbol letter m "]
    assert one(spark, E.emoji_variant("t", "raw"), texts[0]) == [texts[0]]
    with pytest.raises(ValueError):
        E.emoji_variant("t", "other")


PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "agreed": "agre",
    "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "vietnamization": "vietnam",
    "hopefulness": "hope", "triplicate": "triplic", "electriciti": "electr", "goodness": "good",
    "revival": "reviv", "adjustment": "adjust", "adoption": "adopt", "probate": "probat",
    "rate": "rate", "controll": "control", "roll": "roll", "dying": "die", "enjoyed": "enjoy",
    "as": "as", "died": "die", "archaeology": "archaeolog",
}


def stems(spark, words):
    [row] = spark.createDataFrame([(words,)], "t array<string>").select(S.stem_tokens("t").alias("s")).collect()
    return dict(zip(words, row.s.split(" "), strict=True))


def test_porter_published_examples(spark):
    assert stems(spark, list(PORTER)) == PORTER
    assert {w: porter.porter_stem(w) for w in PORTER} == PORTER


def test_stems_are_those_of_plain_python(spark):
    rng = random.Random(7)
    ends = [s for s, _ in porter.STEP2 + porter.STEP3] + porter.STEP4 + [
        "s", "es", "sses", "ies", "ied", "eed", "ed", "ing", "y", "e", "ll", "logi", ""]
    words = {*porter.IRREGULAR, "Ünïes".lower(), "été", "x9ing", "a_b", "ееed", "日本ing"}
    while len(words) < 20_000:
        word = "".join(rng.choices("aeiouybcdlmstwxzrngp", k=rng.randrange(7))) + rng.choice(ends) + rng.choice(["", rng.choice(ends)])
        if len(word) > 1 and "yy" not in word:
            words.add(word)
    assert stems(spark, sorted(words)) == {w: porter.porter_stem(w) for w in words}


def test_stem_text(spark):
    assert one(spark, S.stem_text("t"), "The Motoring cats, x hopping!", None) == [
        "the motor cat hop", ""]
    assert one(spark, S.stem_variant("t", "unstemmed"), "Cats") == ["Cats"]
    with pytest.raises(ValueError):
        S.stem_variant("t", "other")


def test_star_label(spark):
    values = [(None,), (1.0,), (2.0,), (2.9,), (3.0,), (3.9,), (4.0,), (5.0,)]
    assert one(spark, L.star_label("t"), *values, schema="t double") == [
        "", "negative", "negative", "negative", "neutral", "neutral", "positive", "positive"]


def test_labels(spark):
    assert one(spark, L.label_id("t"), "negative", "positive", "odd", None) == [0, 2, None, None]
    assert one(spark, L.norm_label("t"), " Neutral\n", None) == ["neutral", ""]
    rows = [("positive", "negative"), (" NEUTRAL ", "negative"), ("odd", " Negative"),
            (None, "positive"), (None, None)]
    assert one(spark, L.final_label("a", "b"), *rows, schema="a string, b string") == [
        "positive", "neutral", "negative", "positive", ""]
    assert one(spark, L.language_name("t"), "en", "xx")[1] == "xx"
    assert one(spark, L.language_name("t"), "id")[0].startswith("Indonesian — note")
    scores = [([0.1, 0.7, 0.2],), ([0.5, 0.5, 0.0],), ([],)]
    assert one(spark, L.argmax_label("t", ["n", "u", "p"]), *scores, schema="t array<double>") == [
        "u", "n", None]


def test_wilson(spark):
    rows = [(0, 0), (0, 5), (5, 5), (6, 12), (142, 240)]
    df = spark.createDataFrame(rows, "k int, n int")
    low, high = wilson_ci("k", "n")
    got = df.select(low.alias("l"), high.alias("h")).collect()
    assert (got[0].l, got[0].h) == (None, None)
    assert got[1].l == 0.0 and got[2].h <= 1.0
    assert math.isclose(got[3].l, 0.2537781703934222, rel_tol=1e-12)
    assert math.isclose(got[3].h, 0.7462218296065778, rel_tol=1e-12)
    assert math.isclose(got[4].l, 0.5285108645804661, rel_tol=1e-12)
    assert math.isclose(got[4].h, 0.6519341456228789, rel_tol=1e-12)


def test_dates(spark):
    assert one(spark, F.unix_seconds(D.epoch_to_ts("t")), (5,), schema="t long") == [5]
    assert one(spark, F.unix_seconds(D.iso_to_ts("t")), "1970-01-02T00:00:01.000Z", "no") == [
        86401, None]
    assert one(spark, F.unix_seconds(D.post_date_to_ts("t")), "Jan 2 1970, 12:05 AM", "x") == [
        86700, None]
    page = "on Jan 2 1970, 1:05 PM and Feb 30 2020, 9:15 AM, jan 1 1970, 1:00 PM"
    assert one(spark, D.find_post_dates("t"), page) == [
        ["Jan 2 1970, 1:05 PM", "Feb 30 2020, 9:15 AM"]]


def test_row_local_functions_stream(spark, tmp_path):
    spark.createDataFrame([("Sooooo slow app",), (None,)], "text string").write.parquet(
        str(tmp_path / "in"))
    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    out = stream.select(X.clean_text("text").alias("c"),
                        X.extract_aspects("text", SERVICE_ASPECTS).alias("a"))
    q = (out.writeStream.format("memory").queryName("streamed").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start())
    q.awaitTermination(60)
    got = {r.c: r.a for r in spark.table("streamed").collect()}
    assert got == {"Soo slow app": ["speed", "app_usability"], "": []}


def test_known_stems_change_nothing(spark):
    import random

    from voxloom.functions import stem

    rng = random.Random(3)
    some = ["running", "flies", "relational", "sky", "happily", "generalizations", "y", "yyy", "été", "agreed", "hopping", "news", "oo", "1st"]
    texts = [" ".join(rng.choices(some, k=rng.randrange(12))) for _ in range(60)] + [None, "", "...", "Running RUNNING ran"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for limit in (0, 1, 4, 100):
        known = stem.learn_stems(df, "text", limit)
        assert known.size == min(limit, known.size) and known.size <= limit
        both = df.select(stem.stem_text("text", known).alias("a"), stem.stem_text("text").alias("b")).collect()
        assert all(r.a == r.b for r in both)
    plan = df.select(stem.stem_text("text", known))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
