"""Language identification: held-out accuracy, chunks, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from tripwire.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.query(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = np.mean([r.lang_pred == r.lang for r in got])
    assert len(got) > 200 and right >= 0.97
    wrong_ids = docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1).count()
    assert len(got) == wrong_ids


def test_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Voilà une phrase, with 42 words! " * 50 + "Ende"
    whole = langid.subword_counts(text, 1 << 12)
    monkeypatch.setattr(langid, "CHUNK", 37)
    assert (langid.subword_counts(text, 1 << 12) == whole).all()
    # brute force: byte n-grams of " word word " with no space strictly inside
    raw = (" " + langid._NOT_LETTERS.sub(" ", text.lower()).strip() + " ").encode()
    grams = sum(b" " not in raw[i + 1:i + n - 1] for n in range(2, 6) for i in range(len(raw) - n + 1))
    assert whole.sum() == grams


def test_odd_rows(spark):
    rows = [(1, "hello world and the thing", "en", "x"), (2, "bonjour le monde et la chose", "fr", "x"),
            (4, None, "en", "x"), (5, "", None, "x"), (None, "the thing of the world", None, "x"),
            (7, "123 ... ²", "en", "x"), (7, "123 ... ²", "en", "x"), (8, "the world " * 30000, "en", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.train([(t, g) for _, t, g, _ in rows if t and g], epochs=30)
    got = langid.identify(df, model).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text): r for r in got}
    assert by[(1, rows[0][1])].lang_pred == "en" and by[(2, rows[1][1])].lang_pred == "fr"
    for key in [(4, None), (5, ""), (7, "123 ... ²")]:
        assert by[key].lang_pred == "und" and by[key].score == 0 and by[key].rejected
    assert by[(8, rows[7][1])].lang_pred == "en" and all(0 <= r.score <= 1 for r in got)
    empty = spark.createDataFrame([], df.schema)
    none = langid.fit_language_model(empty)
    assert langid.identify(empty, model).count() == 0
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}


def test_rejects_what_was_never_learned(spark):
    model = langid.fit_language_model(spark.read.parquet(f"{SF}/documents.parquet"))
    rng = np.random.default_rng(3)
    noise = "".join(chr(0x4E00 + int(x)) for x in rng.integers(0, 5000, 400))
    assert model.predict(noise)[1] < 0.5 or len(model.languages) < 3
