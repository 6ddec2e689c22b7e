"""The pipeline's stages one by one and run() as a whole."""

from collections import Counter

import corpus_pipeline as P
from test_operators import SF, brute_components, check_pack


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    out = {}
    for name, f in P.STAGES:
        df = f(spark, docs, SF)
        out[name] = df.cache()
        if name != P.STAGES[-1][0]:
            assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = df
    assert [n for n, _ in P.STAGES] == ["language_id", "ngram_jaccard", "secret_scan", "mix_sources", "best_fit_packing"]
    # no clean document goes in the first stage; one of each group stays in the second
    known = {r.doc_id for r in out["language_id"].collect()}
    assert len(known) >= 0.97 * len(before)
    want = {i for i, (n, c) in brute_components({i: before[i] for i in known}, 5, 80).items() if i == c}
    assert {r.doc_id for r in out["ngram_jaccard"].collect()} == want
    texts = {r.doc_id: r.text for r in out["secret_scan"].collect()}
    assert set(texts) == want and all("token = \"" not in t for t in texts.values())
    mixed = out["mix_sources"].collect()
    assert all(r.text == texts[r.doc_id] or texts[r.doc_id].startswith(r.text) for r in mixed)
    assert Counter(r.doc_id for r in mixed).most_common(1)[0][1] <= 2


def test_run_and_odd_rows(spark, odd_docs, tmp_path):
    odd_docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    out = P.run(spark, str(tmp_path))
    assert set(out.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert out.count() > 0
    odd_docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert P.run(spark, f"{tmp_path}/none").count() == 0
