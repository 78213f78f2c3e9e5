"""The pipeline against brute-force versions of its stages; odd rows through every stage."""

import re

import corpus_pipeline
from test_decontaminate import brute as brute_leaks
from test_mixing import fill
from test_secrets import brute as brute_secrets
from test_simhash import brute_components, brute_fp

from tripwire.llm import langid, secrets

SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_language_model(docs)
    rows = {r.doc_id: r for r in docs.collect()}
    left = {d: r for d, r in rows.items() if model.predict(r.text)[0] != "und" and model.predict(r.text)[1] >= model.reject_below}
    fp = {d: brute_fp(r.text) for d, r in left.items()}
    root = brute_components(set(fp.values()), lambda x, y: (x ^ y).bit_count() <= 3)
    best = {}
    for d in sorted(left):
        best.setdefault(root[fp[d]], d)
    left = {d: left[d] for d in best.values()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {k for k, _ in brute_leaks([(d, r.text) for d, r in left.items()], items)}
    left = {d: r for d, r in left.items() if d not in dirty}
    size, per = {}, {}
    for d, r in left.items():
        text, at = "", 0
        for a, b, _ in brute_secrets(r.text)[1]:
            if a >= at:
                text += r.text[at:a] + secrets.MARK
            at = max(at, b)
        size[d] = len(re.findall(r"[^\x20\x09-\x0D]+", text + r.text[at:]))
        per[r.source] = per.get(r.source, 0) + size[d]
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r["size"] for r in got} == size and len(got) == len(size)
    target = fill(per)
    for s in per:
        assert sum(r.taken for r in got if r.source == s) == int(target[s] + 1e-9)


def test_stages_with_odd_rows(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame(
        [(None, "some the and of words in no particular order", "en", None, None), (-1, None, None, "src0", None), (-2, "", "en", "src1", 0),
         (-3, "the of and in " * 20000, "en", "src0", 80000)], base.schema)
    docs = base.unionByName(odd).unionByName(base.limit(3))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        out.count()
        empty = stage(spark, docs.limit(0), SF)
        assert empty.columns == docs.columns and empty.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
