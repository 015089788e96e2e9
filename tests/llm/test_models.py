"""Language identification and toxicity: held-out accuracy on made rows, and odd rows."""

import random

import numpy as np
import pytest

from strandlake.llm import langid, toxicity

SYLLABLES = {"aa": "ka to mi ru shi ne ho", "bb": "sch ung ein ber lich gen", "cc": "eau oir ent que ux ais", "dd": "cion ado les que mente ar", "ee": "ski ow cz rze wie ny", "ff": "ing the ly ed er tion", "gg": "ija ost ovo ka je ma", "hh": "aan ij oe sch een lijk"}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang].split(), k=rng.randint(1, 4))) for _ in range(n))


@pytest.mark.parametrize("n_languages", [4, 8])
def test_languages(spark, n_languages):
    rng = random.Random(n_languages)
    names = list(SYLLABLES)[:n_languages]
    rows = [(i, text(rng, lang := rng.choice(names), rng.randint(8, 80)), lang) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(frame.where("doc_id < 400"))
    assert model.languages == names
    odd = [(1000, None), (1001, ""), (1002, "123 !?"), (1003, "é" * 10), (None, "ka to")]
    test = [(i, t) for i, t, _ in rows[400:]] + odd
    got = {r["doc_id"]: r for r in langid.predict_languages(spark.createDataFrame([(i, t, 7, "z") for i, t in test], "doc_id long, text string, extra int, lang string"), model).collect()}
    assert len(got) == len(test) and got[401]["extra"] == 7
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in rows[400:]]) > 0.95
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1003]["lang_pred"] in names
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_codewords():
    for n in (2, 3, 4, 6, 9, 30):
        code = langid.codewords(n)
        far = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert len(code) == n and far >= max(1, code.shape[1] // 4)
        assert np.all(np.abs(code.sum(0)) < n) or n == 1


def test_pieces_add_up(monkeypatch):
    t = "Das ist ein längerer Text. " * 50
    whole, letters = langid.ngram_counts(t)
    monkeypatch.setattr(langid, "PIECE", 1 << 30)
    again, _ = langid.ngram_counts(t)
    assert np.array_equal(whole, again) and letters == sum(c.isalpha() for c in t)


def test_languages_without_rows(spark, no_documents):
    model = langid.train(no_documents)
    assert model.languages == []
    assert [r["lang_pred"] for r in langid.predict_languages(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).collect()] == ["und"]
    one = langid.train(spark.createDataFrame([(1, "abc", "aa")], "doc_id long, text string, lang string"))
    assert [r["lang_pred"] for r in langid.predict_languages(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), one).collect()] == ["aa"]


def test_clashing_names_and_odd_rows(spark):
    """Columns with the names of results are replaced; repeated and null ids stay; equal ids of two languages are learned from."""
    rows = [(1, "ka to mi", "aa"), (1, "ka to mi", "aa"), (2, "sch ung ein", "bb"), (2, "sch ung", "aa"), (None, "que ment", "cc"), (3, None, "bb"), (4, "ein ber", None)]
    frame = spark.createDataFrame([(*r, "p", 0.5, True, "k") for r in rows], "doc_id long, text string, lang string, lang_pred string, score double, ambiguous boolean, _share string")
    model = langid.train(frame)
    assert model.languages == ["aa", "bb"]
    got = langid.predict_languages(frame, model).select("doc_id", "lang_pred", "score", "ambiguous", "_share").collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got} <= {"aa", "bb", "und"}
    labels = spark.createDataFrame([(1, 1, "z"), (2, 0, "z"), (2, 1, "z"), (4, 0, "z")], "doc_id long, toxic int, lang string")
    judge = toxicity.train(frame, labels)
    scored = toxicity.score_documents(frame, judge)
    assert scored.columns.count("score") == 1 and scored.select("score").count() == len(rows)
    odd = frame.withColumnRenamed("lang_pred", "_own_score")
    assert toxicity.reject_toxic(odd, judge).columns == odd.columns


def test_predictions_against_plain_reading(spark):
    """Scores of the operators are those of a slow reading of the same models: n-grams one by one, windows one by one."""
    rng = random.Random(12)
    rows = [(i, text(rng, lang := rng.choice(["aa", "bb", "cc"]), rng.randint(1, 40)), lang) for i in range(200)] + [(900, "É! ka  to", "aa"), (901, "x", "bb")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(frame)
    got = {r["doc_id"]: r for r in langid.predict_languages(frame, model).collect()}
    for i, t, _ in rows:
        kept = "".join(c if c.isalpha() else " " for c in t.lower())
        while "  " in kept:
            kept = kept.replace("  ", " ")
        counts = np.zeros(langid.FEATURES)
        for n in (1, 2, 3):
            for a in range(len(kept) - n + 1):
                h = ord(kept[a]) + (n << 32)
                for c in kept[a + 1 : a + n]:
                    h = (h * 1_000_003 + ord(c)) % 2**64
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
                    h = ((h ^ (h >> shift)) * factor) % 2**64
                counts[h % langid.FEATURES] += 1
        x = np.sqrt(counts / counts.sum())
        losses = []
        for word in model.code:
            losses.append(sum(w * np.log1p(np.exp(-c * (x @ model.weights[:, b] + model.bias[b]))) for b, (c, w) in enumerate(zip(word, model.trust))) / model.trust.sum())
        assert got[i]["lang_pred"] == model.languages[int(np.argmin(losses))]
        share = np.exp(-8 * (np.array(losses) - min(losses)))
        assert abs(got[i]["score"] - share.max() / share.sum()) < 1e-3
    labels = spark.createDataFrame([(i, int(lang == "aa")) for i, _, lang in rows], "doc_id long, toxic int")
    judge = toxicity.train(frame, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(frame, judge).collect()}
    for i, t, _ in rows[::7]:
        x = judge.embed(toxicity.word_rows(t, toxicity.WordHash()))
        best = []
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                found = [sum(float(x[a + j] @ judge.filters[k][j][:, f]) for j in range(width)) + float(judge.bias[k][f]) for a in range(len(x) - width + 1)]
                best.append(max([0.0, *found]))
        z = float(np.array(best) @ judge.out) + judge.out_bias
        assert abs(scores[i] - 1 / (1 + np.exp(-z))) < 1e-3


BAD = "vile wretch scum awful".split()


def labelled(rng, n):
    rows = []
    for i in range(n):
        words = text(rng, rng.choice(["ff", "dd"]), rng.randint(5, 120)).split()
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randint(1, 3) * toxic):
            words[rng.randrange(len(words))] = rng.choice(BAD).upper()
        rows.append((i, " ".join(words), rng.choice(["ff", "dd", None]), toxic))
    return rows


def test_toxicity(spark):
    rows = labelled(random.Random(3), 1500)
    docs = spark.createDataFrame([(i, t, lang, 0.1) for i, t, lang, _ in rows] + [(9000, None, None, 0.1), (9001, "", "ff", 0.1), (None, "x", "ff", 0.1)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, _, y in rows if i < 1000] + [(None, 1, 1), (5000, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs.select("doc_id", "text"), model).collect()}
    truth = {i: y for i, _, _, y in rows if i >= 1000}
    assert np.mean([(got[i] >= 0.5) == y for i, y in truth.items()]) > 0.95
    assert got[9000] == got[9001] < 0.5
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns
    stay = {r["doc_id"] for r in kept.collect()}
    assert {9000, 9001, None} <= stay and np.mean([(i not in stay) == bool(y) for i, y in truth.items()]) > 0.95


def test_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 50, (30, 2)).astype(np.int32) for _ in range(40)]
    model = toxicity.fit(rows, np.arange(40) % 2, epochs=1)
    whole = model.raw(np.concatenate(rows))
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert abs(model.raw(np.concatenate(rows)) - whole) < 1e-4


def test_one_label_and_none(spark, no_documents):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for y in (0, 1):
        model = toxicity.train(docs, spark.createDataFrame([(1, y), (2, y)], "doc_id long, toxic int"))
        assert {r["score"] >= 0.5 for r in toxicity.score_documents(docs, model).collect()} == {bool(y)}
    model = toxicity.train(no_documents, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_documents(no_documents, model).count() == 0
    assert all(0 <= r["score"] <= 1 for r in toxicity.score_documents(docs, model).collect())
