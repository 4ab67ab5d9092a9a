import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkflow.llm import langid, queries


def plain_kneser_ney(vocabulary, order):
    """Interpolated Kneser-Ney from its definition, on dictionaries of strings."""
    pad = "\x02" * (order - 1)
    raw = Counter()
    for w, n in vocabulary.items():
        full = f"{pad}{w}\x03"
        for i in range(order - 1, len(full)):
            raw[full[i - order + 1 : i + 1]] += n
    count = {order: raw}
    for n in range(order - 1, 0, -1):
        count[n] = Counter(g[1:] for g in count[n + 1])

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (len(count[1]) + 1)
        ones, twos = (sum(v == k for v in count[n].values()) for k in (1, 2))
        d = min(max(ones / (ones + 2 * twos), 0.1), 0.95) if ones + twos else 0.5
        here = {g: c for g, c in count[n].items() if g[:-1] == gram[:-1]}
        if not here:
            return p(gram[1:])
        total = sum(here.values())
        return max(here.get(gram, 0) - d, 0) / total + d * len(here) / total * p(gram[1:])

    return p, pad


def model(vocabularies, order):
    models, grams = {}, {}
    for k, v in vocabularies.items():
        models[k] = langid.learn(list(v), np.array(list(v.values()), float), order)
    for n in range(1, order + 1):
        keys, of, suffix = [], [], []
        for v in vocabularies.values():
            g, c, _ = langid._grams(list(v), order)
            keys.append(g[n]), of.append(c[n]), suffix.append(g[n - 1])
        key, first = np.unique(np.concatenate(keys), return_index=True)
        grams[n] = (key, np.concatenate(of)[first], np.concatenate(suffix)[first])
    return langid.Model(models, grams, order)


def test_probabilities_follow_the_definition():
    va, vb = {"banana": 3, "bandana": 1, "an": 5, "nab": 2}, {"obo": 4, "bob": 2, "naob": 1}
    m = model({"a": va, "b": vb}, 3)
    tests = ["banana", "bob", "zzz", "nabob", "a"]
    got = m.score(tests)
    for j, v in enumerate((va, vb)):
        p, pad = plain_kneser_ney(v, 3)
        for i, w in enumerate(tests):
            full = f"{pad}{w}\x03"
            want = sum(math.log10(p(full[k - 2 : k + 1])) for k in range(2, len(full)))
            assert math.isclose(got[i, j], want, rel_tol=1e-4), (w, j)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op1_langid(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in docs)
    held = [r for r in docs if got[r.doc_id].held_out]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) >= 0.99
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edges(spark):
    base = [(i, t, x) for i, (t, x) in enumerate([("the cat and the hat", "en"), ("le chat et le chapeau", "fr")] * 20)]
    odd = [(100, None, "en"), (101, "", None), (102, "123 !!", "fr"), (None, "the the", None), (103, "the " * 60_000, "zz"), (104, "猫" * 5000, None), (105, "THE HAT", "fr"), (105, "THE HAT", "fr")]
    df = spark.createDataFrame([(*r, 0.5) for r in base + odd], "doc_id long, text string, lang string, score double")
    held = F.coalesce(F.col("doc_id"), F.lit(100)) >= 100
    m = langid.fit(df.where(~held).select("doc_id", "text", "lang"))
    got = defaultdict(list)
    for r in langid.predict(df, m, held).collect():
        got[r.doc_id].append((r.lang_pred, r.score))
    assert m.languages == ["en", "fr"]
    assert [got[i][0] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[None][0][0] == "en" and got[103][0][0] == "en" and got[104][0][0] in m.languages and [x for x, _ in got[105]] == ["en", "en"]
    assert langid.predict(df, None, held).where("lang_pred != 'und'").count() == 0
    assert langid.fit(df.limit(0)) is None and langid.predict(df.limit(0), m, held).count() == 0
    far = langid.predict(df.where("doc_id = 104"), m, held, reject=True).first()
    assert far.rejected and far.lang_pred == "und"


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet=[chr(i) for i in range(0x300)], max_size=40))
def test_words_follow_the_unicode_categories(text):
    out, word = [], ""
    for ch in text.lower() + " ":
        kind = unicodedata.category(ch)[0]
        if kind == "L" or (kind == "M" and word):
            word += ch
        if word and (kind not in "LM" or len(word) == 24):
            out.append(word)
            word = ""
    assert langid.words(text) == out


def test_letters_marks_and_numerals():
    assert langid.words("²") == langid.words("½²①Ⅷ 123 __") == langid.words("\u0301\u0903 !") == []
    assert langid.words("हिन्दी caf\u0065\u0301") == ["हिन्दी", "cafe\u0301"]
    assert [len(w) for w in langid.words("x" * 60)] == [24, 24, 12]


def test_a_language_of_few_rows_does_not_spoil_calibration(spark):
    rows = [(i, t, x) for i, (t, x) in enumerate([("the cat and the hat in the house", "en"), ("le chat et le chapeau de la maison", "fr")] * 60)]
    df = spark.createDataFrame([*rows, (900, "der hund und die katze", "de")], "doc_id long, text string, lang string")
    m = langid.fit(df)
    assert m.languages == ["de", "en", "fr"] and math.isinf(m.reject[0]) and not np.isinf(m.reject[1:]).any()
    assert langid.predict(df.where("doc_id = 900"), m, F.lit(True)).first().lang_pred == "de"
