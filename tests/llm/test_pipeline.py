from collections import defaultdict

import brute
from fixture import SCHEMA, documents
from pyspark.sql import functions as F

import corpus_pipeline as P
from kinetrace.llm import packing


def test_stages(spark, tmp_path):
    rows = documents(seed=8, n=120)
    text = {r[0]: r[1] for r in rows}
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    seen = []
    for name, stage in P.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs)
    language, exact, near, secret, packed = seen
    assert all(d.columns == names for d in seen[:4])
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    lettered = {d: t for d, t in text.items() if t and any(c.isalpha() for c in t)}
    assert ids(language) == sorted(lettered)
    groups = defaultdict(list)
    for d, t in lettered.items():
        groups[brute.lower(t)].append(d)
    kept = {max(g): lettered[max(g)] for g in groups.values()}
    assert ids(exact) == sorted(kept)
    want = brute.near(list(kept.items()), 5)
    kept = {d: t for d, t in kept.items() if want[d][1] == d}
    assert ids(near) == sorted(kept) == ids(secret)
    clean = {r.doc_id: r.text for r in secret.collect()}
    assert all(not brute.base_spans(t) for t in clean.values())
    assert all(clean[d] == t for d, t in kept.items() if not brute.base_spans(t))
    pieces = defaultdict(int)
    for r in packed.collect():
        pieces[r.doc_id] += r.length
    assert pieces == {d: len(t) for d, t in clean.items()} and max(pieces.values()) <= packing.CAPACITY * 9


def test_stages_on_repeated_ids_and_nulls(spark, tmp_path):
    """Null and repeated ids, null texts and clashing names go through all stages; each keeps what it should."""
    words = " ".join(f"wörd{i}" for i in range(60))
    rows = [(None, words), (None, words + " end"), (None, None), (1, "alpha beta gamma delta epsilon zeta"), (1, "other words that stand alone here"), (1, "other words that stand alone here"), (2, "12 34"), (3, "ALPHA beta gamma delta epsilon zeta"), (4, words.upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "cast(null as string) lang", "'s' source", "char_length(text) n_chars", "'l' lost", "'p' lang_pred", "1 score", "'m' mark")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()) if name != "packing" else docs.count())
        assert name == "packing" or docs.columns == df.columns
    language, exact, near, secret, packed = seen
    assert len(language) == 7  # nothing is labelled, so every text with a letter stays
    labelled = df.drop("lang").withColumn("lang", F.lit("aa")).select(*df.columns)
    labelled.write.parquet(f"{tmp_path}/two/documents.parquet")
    out = [labelled]
    for name, stage in P.STAGES[:4]:
        stage(spark, out[-1], str(tmp_path)).write.parquet(f"{tmp_path}/two/{name}")
        out.append(spark.read.parquet(f"{tmp_path}/two/{name}"))
    texts = [sorted((r.text or "")[:12] for r in o.collect()) for o in out]
    assert len(texts[1]) == 7 and texts[2] == sorted(["ALPHA beta g", "other words ", words[:12], (words + " end")[:12], words.upper()[:12]])
    assert texts[4] == texts[3]


def test_unlabelled_corpus_is_packed_from_the_redacted_texts(spark, tmp_path):
    rows = [(r[0], r[1], None, *r[3:]) for r in documents(seed=9, n=60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = P.run(spark, str(tmp_path))
    text = {r.doc_id: r.text for r in spark.read.parquet(out.first().texts).collect()}
    size = defaultdict(int)
    for r in out.collect():
        size[r.doc_id] += r.length
    assert size == {d: len(t) for d, t in text.items()} and len(text) > 20


def test_whole_pipeline_on_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
