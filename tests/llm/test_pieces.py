import os
import random
from collections import Counter

import numpy as np
import pytest

from kinetrace.llm import pieces as P

pytestmark = pytest.mark.skipif(not os.path.exists(P.MODEL), reason="no model here")


@pytest.fixture(scope="module")
def p():
    with open(P.MODEL, "rb") as f:
        return P.loaded(f.read())


def text_of(rng, n):
    parts = ["the", " the", "  ", "\n\n", "don't", "1234", "é", " über", "漢字", "!!", " a", "b", "\t", "aaaaaaa", " x", ".", "ththe", "reation", "😀", "    "]
    return "".join(rng.choice(parts) for _ in range(n))


def test_scan_equals_the_library(p):
    rng = random.Random(3)
    for _ in range(60):
        text = text_of(rng, rng.randint(1, 150))
        want = p.sp.encode(text)
        for size in (7, 64, 1000):
            assert P.encode_giant(p, p.sp.normalize(text), size) == want


def test_max_plus_product_is_associative():
    rng = np.random.default_rng(0)
    a, b, c = (np.where(rng.random((4, 4)) < 0.5, 0.0, P.NONE) for _ in range(3))
    assert (P.product(P.product(a, b), c) == P.product(a, P.product(b, c))).all()


def test_documents(spark, p):
    rng = random.Random(4)
    rows = [(1, text_of(rng, 900)), (2, "the cat sat "), (3, None), (4, ""), (None, text_of(rng, 700)), (5, "a▁b"), (6, text_of(rng, 800))]
    rows += [rows[0], (7, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.encode_documents(spark, df, P.Model(spark), giant=500, size=300)
    want = Counter()
    for d, t in rows:
        ids = p.sp.encode(t or "")
        want[d, len(ids), P.digest(ids), p.sp.decode(ids) == (t or "")] += 1
    found = got.collect()
    assert Counter((r.doc_id, r.n_pieces, r.ids_sha256, r.round_trip) for r in found) == want
    assert max(r.n_chunks for r in found) > 5
    assert P.encode_documents(spark, df.limit(0), P.Model(spark)).count() == 0
    ids = spark.createDataFrame([(1, p.sp.encode("the cat")), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in P.decode_documents(spark, ids, P.Model(spark)).collect()} == {1: "the cat", 2: ""}
