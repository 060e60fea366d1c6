import random
import zlib

import pytest
from helpers import documents, with_clashing

from yieldlens.llm import language
from yieldlens.llm.common import held_out

SYLLABLES = {
    "en": "the ing tion er th wh sh ly ed and".split(),
    "de": "der ung sch ein ich keit ver ß ü zu".split(),
    "fr": "le eau tion é è oi re que eux ai".split(),
    "es": "el ción ñ ado os la rr ll í que".split(),
}


def text_of(r, lang, n):
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(6)
    return [(i, text_of(r, lang, r.randint(5, 80)), lang) for i in range(600) for lang in [r.choice(list(SYLLABLES))]]


def test_families():
    assert language.family_of("de") == language.family_of("EN-us") == "germanic"
    assert language.family_of("es") == "romance"
    assert language.family_of("xx") != language.family_of("xy")


def test_held_out_accuracy(spark, rows):
    docs = with_clashing(documents(spark, rows)).repartition(4)
    found = language.identify(docs, language.train(docs))
    truth = {i: lang for i, _, lang in rows}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found.collect()}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i][0] == truth[i] for i in out) / len(out) >= 0.97
    assert all(0 <= s <= 1 for _, s in got.values())


def test_held_out_labels_are_not_learned(spark, rows):
    lied = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    found = language.identify(documents(spark, lied), language.train(documents(spark, lied)))
    assert "xx" not in {r["lang_pred"] for r in found.collect()}
    flags = {r["doc_id"]: r["h"] for r in documents(spark, lied).select("doc_id", held_out("doc_id").alias("h")).collect()}
    assert all(flags[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in flags)


def test_odd_texts(spark, rows):
    model = language.train(documents(spark, rows))
    odd = [(1, None), (2, ""), (3, "123 !? \n"), (4, "é"), (5, "ß" * 200_000), (5, "the"), (None, "the and")]
    found = language.identify(documents(spark, odd), model).collect()
    assert len(found) == len(odd)
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert und == {1, 2, 3}
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und")


def test_nothing_or_one_language_learned(spark):
    docs = documents(spark, [(1, "abc", None), (2, None, "en"), (3, "...", "en")])
    assert {r["lang_pred"] for r in language.identify(docs, language.train(docs)).collect()} == {"und"}
    one = documents(spark, [(i, "abc def", "en") for i in range(10)])
    assert {r["lang_pred"] for r in language.identify(one, language.train(one)).collect()} == {"en"}
    assert language.identify(one.where("doc_id > 99"), language.train(one.where("doc_id > 99"))).count() == 0


def test_kept_columns(spark, rows):
    docs = with_clashing(documents(spark, rows[:50]))
    judged = language.identify(docs, language.train(docs), keep=True)
    assert judged.columns == [*docs.columns, "lang_pred_", "score_"]
    assert judged.drop("lang_pred_", "score_").exceptAll(docs).count() == 0
