from pyspark.sql import functions as F

from clickweave.llm.language_id import NO_LANGUAGE, fit_dictionaries, identify_language, judge, compressors
from clickweave.llm.queries import op7_language_id

from .helpers import AWKWARD, awkward, empty

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op7_language_id(spark, SF).join(truth, "doc_id").filter("held_out and lang is not null")
    right, accepted, n = got.agg(F.count_if(F.col("lang_pred") == F.col("lang")), F.count_if("accepted"), F.count("*")).first()
    assert n > 200 and right / n > 0.95 and accepted / n > 0.98
    assert got.filter("score < 0 or score > 1").count() == 0


def test_awkward_rows(spark):
    docs = awkward(spark).selectExpr("*", "'x' as score", "'y' as read", "'z' as Margin")
    dictionaries = fit_dictionaries(docs, min_docs=1)
    assert sorted(dictionaries) == ["de", "en", "fr"]
    got = identify_language(docs, dictionaries)
    assert got.filter("doc_id = 1").first()["read"] == "y" and got.count() == len(AWKWARD)
    made = compressors(dictionaries)
    for r in got.collect():
        assert (r.lang_pred, r.score, r.margin) == judge(r.text, made, 1024)
        if not r.text or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score, r.accepted) == (NO_LANGUAGE, 0.0, False)
    assert got.filter("doc_id = 6").first().lang_pred == "de"
    assert fit_dictionaries(empty(spark)) == {}
    assert {r.lang_pred for r in identify_language(awkward(spark), {}).collect()} == {NO_LANGUAGE}
    assert identify_language(empty(spark), dictionaries).count() == 0


def test_scripts_without_blanks(spark):
    import random

    pick = random.Random(3)
    signs = {
        "zh": "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可她里后",
        "ja": "のにはをたがでてとしれさあるいもするからなことして日本人年大国学生会社長時間",
        "th": "กขคงจฉชซญดตถทธนบปผฝพฟมยรลวศสหอะาิีุูเแโใไ",
        "en": None,
    }
    words = {lang: ["".join(pick.choices(s, k=pick.randrange(1, 4))) for _ in range(120)] if s else
             ["".join(pick.choices("abcdefghijklmnoprstuvw", k=pick.randrange(2, 8))) for _ in range(120)] for lang, s in signs.items()}
    rows = []
    for i in range(240):
        lang = sorted(signs)[i % 4]
        blank = " " if lang == "en" else ""
        rows.append((i, "。".join(blank.join(pick.choices(words[lang], k=25)) for _ in range(4)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = identify_language(docs.filter("doc_id >= 160"), fit_dictionaries(docs.filter("doc_id < 160")))
    assert judged.filter("lang_pred = lang and accepted").count() == 80


def test_a_word_that_does_not_fit_keeps_no_other_out(spark):
    rows = [(i, "x" * 9000 + " short words stay here", "en") for i in range(5)]
    made = fit_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"), chars_per_doc=10_000)
    assert made["en"].split() == [b"words", b"stay", b"short", b"here"]


def test_dictionaries_and_judgement_equal_a_plain_computation(spark):
    import math

    import zstandard as z

    vocabulary = {"aa": "alpha beta gamma delta omega kappa".split(), "bb": "uno dos tres cuatro cinco seis".split()}
    rows = [(i, " ".join(vocabulary[lang][(i * 5 + k) % 6] for k in range(4 + i % 9)) + "!", lang)
            for i, lang in enumerate(["aa", "bb"] * 20)] + [(99, "lonely", "aa"), (100, None, "aa"), (101, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    made = fit_dictionaries(docs)
    for lang in vocabulary:
        texts = [set(t.rstrip("!").split()) for _, t, of in rows if of == lang and t]
        uses = {w: sum(w in t for t in texts) for w in vocabulary[lang]}
        listed = sorted((w for w in uses if uses[w] >= 2), key=lambda w: (-uses[w], w))
        assert made[lang] == b" " + b"".join(w.encode() + b" " for w in reversed(listed))

    settings = z.ZstdCompressionParameters(window_log=17, hash_log=14, chain_log=14, search_log=2, min_match=4, target_length=8,
                                           strategy=z.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
    long = ("alpha beta uno " * 300, "gamma delta ", "cinco! seis? dos.", "12 !", "aé")
    asked = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    for r in identify_language(asked, made, window=100).collect():
        text = long[r.doc_id]
        if not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == (NO_LANGUAGE, 0.0)
            continue
        data = (" " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " ").encode()
        sizes = {}
        for lang, words in made.items():
            d = z.ZstdCompressionDict(words, dict_type=z.DICT_TYPE_RAWCONTENT)
            sizes[lang] = sum(len(z.ZstdCompressor(dict_data=d, compression_params=settings).compress(data[i : i + 100])) for i in range(0, len(data), 100))
        first, second = sorted(sizes, key=lambda k: (sizes[k], k))
        margin = (sizes[second] - sizes[first]) / sizes[second]
        assert (r.lang_pred, r.accepted) == (first, margin >= 0.002)
        assert math.isclose(r.margin, margin) and math.isclose(r.score, min(1.0, 0.5 + 4 * margin))
