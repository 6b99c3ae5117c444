import os
import random

import pytest

from kinetrace.llm import token_counts as T

HAVE = os.path.exists(T.VOCABULARY)
pytestmark = pytest.mark.skipif(not HAVE, reason="no vocabulary here")


@pytest.fixture(scope="module")
def count():
    with open(T.VOCABULARY, "rb") as f:
        return T.counter(f.read(), T.PATTERN)


def text_of(rng, n):
    parts = ["the", " the", "  ", "\n\n", "don't", "'s", " 's", "1234", "é", " über", "漢字", "!!", " a", "b", "\t", "I'll", " x", ".", " <|endoftext|>"]
    return "".join(rng.choice(parts) for _ in range(n))


def test_leaves_add_up(count):
    rng = random.Random(1)
    for size in (1, 5, 40):
        for _ in range(60):
            text = text_of(rng, rng.randint(0, 120))
            leaves = T.leaves_of(text, size)
            assert "".join(leaves) == text and sum(map(count, leaves)) == count(text)


def test_edits_match_a_full_count(count):
    rng = random.Random(2)
    for _ in range(40):
        text = text_of(rng, rng.randint(0, 300))
        tree = T.build(text, count, 20)
        for _ in range(8):
            a = rng.randint(0, len(text) + 3)
            b = a + rng.choice([0, 0, 1, 5, 60])
            text2, again = T.apply_edit(text, tree, a, b, text_of(rng, rng.choice([0, 0, 1, 4, 40])), count, 20)
            assert tree.total == count(text2) and tree.chars == len(text2) and sum(tree.leaves()[0]) == len(text2)
            text = text2


def test_leaves_in_other_scripts_and_growing_leaves(count):
    import random

    rng = random.Random(6)
    han = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) + ("，" if rng.random() < 0.1 else "") for _ in range(4000))
    code = "\n".join(f"x{i}=f({i},'a{i}');//{'#' * (i % 5)}" for i in range(400))
    for text in (han, code, "1,234.5 " * 500, "é’s " * 900):
        tree = T.build(text, count)
        assert tree.total == count(text) and tree.n > len(text) / 1500
        for _ in range(12):
            a = rng.randrange(len(text))
            new = rng.choice(("", " ", "'s", "word, " * 400, "漢字。", "9"))
            text, again = T.apply_edit(text, tree, a, a + rng.randrange(30), new, count)
            assert tree.total == count(text) and again < len(new) + 6 * T.LEAF_CHARS
        chars, _ = tree.leaves()
        assert max(chars) < 4 * T.LEAF_CHARS


def test_an_edit_reads_little(count):
    text = "some words here and there " * 4000
    tree = T.build(text, count)
    text2, again = T.apply_edit(text, tree, 50_000, 50_003, "new", count)
    assert again < 3000 and tree.total == count(text2)


def height(node):
    return 0 if node.left is None else 1 + max(height(node.left), height(node.right))


def test_tree_splits_and_joins_in_balance():
    rng = random.Random(3)
    tree, plain = T.CountTree([1], [0]), [(1, 0)]
    for turn in range(3000):
        first = rng.randrange(len(plain))
        last = min(len(plain) - 1, first + (rng.randrange(40) if turn % 3 == 0 else 0))
        new = [(rng.randint(1, 9), rng.randint(0, 5)) for _ in range(rng.randint(1, 30 if turn % 3 else 2))]
        tree.replace(first, last, *zip(*new))
        plain[first : last + 1] = new
        if turn % 100 == 0:
            assert list(zip(*tree.leaves())) == plain and tree.n == len(plain)
            at = rng.randrange(sum(c for c, _ in plain))
            leaf, start = tree.locate(at)
            assert start == sum(c for c, _ in plain[:leaf]) <= at < start + plain[leaf][0] == start + tree.size_of(leaf)
    assert len(plain) > 1000 and height(tree.root) <= 2.5 * len(plain).bit_length()


def test_leaves_merge_after_deletions(count):
    text = "some words here and there, " * 2000
    tree = T.build(text, count)
    before = tree.n
    while len(text) > 3000:
        text, _ = T.apply_edit(text, tree, 700, 900, "", count)
    assert tree.total == count(text) and tree.n <= len(text) // (T.LEAF_CHARS // 2) + 2 < before


def test_a_long_text(count):
    text = "".join(f"line {i} of a long text, " for i in range(60_000))
    assert len(text) > 1_000_000
    tree = T.build(text, count)
    for at in (0, 500_000, len(text)):
        text, again = T.apply_edit(text, tree, at, at + 7, "edited", count)
        assert again < 4 * T.LEAF_CHARS
    assert tree.total == count(text)
    endless, grown = T.build("x" * 200_000, count), "x" * 100 + "y" + "x" * 199_900
    assert T.apply_edit("x" * 200_000, endless, 100, 100, "y", count)[0] == grown and endless.total == count(grown)


ROWS = [(1, "the cat sat on the mat " * 100), (2, None), (3, ""), (None, "don't"), (1, "the cat sat on the mat " * 100)]


def test_edits_of_a_table(spark, count):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, source string")
    tok = T.Tokenizer(spark)
    trees = T.with_trees(df, tok)
    assert sorted(r.n_tokens for r in trees.collect()) == sorted(count(t or "") for _, t in ROWS)
    edits = trees.selectExpr("*", f"cast(array(named_struct('start', 3, 'stop', 9, 'text', ' new '), null, named_struct('start', null, 'stop', 4, 'text', 'no'), named_struct('start', 0, 'stop', 2, 'text', null)) as {T.EDIT}) edits")
    once = T.edited(edits, tok)
    twice = T.edited(once.withColumnRenamed("chars_encoded", "first"), tok)

    def plain(text):
        text = text[:3] + " new " + text[9:]
        return text[2:]

    for df, turns in ((once, 1), (twice, 2)):
        got = df.collect()
        assert len(got) == 5 and {r.source for r in got} == {"x"}
        for r in got:
            want = dict(ROWS).get(r.doc_id) or ""
            for _ in range(turns):
                want = plain(want)
            assert r.text == want and r.n_tokens == count(want) == sum(r.leaf_tokens) and sum(r.leaf_chars) == len(want)
    assert T.edited(edits.limit(0), tok).count() == 0
    with pytest.raises(ValueError):
        T.with_trees(trees, tok)
    untouched = T.edited(trees.selectExpr("*", f"cast(null as {T.EDIT}) edits"), tok)
    assert {(r.doc_id, r.text, r.chars_encoded) for r in untouched.collect()} == {(*r, 0) for r in ROWS}


def test_query(spark, count, tmp_path):
    from kinetrace.llm.queries import op4_token_counts

    spark.createDataFrame(ROWS[:3] + ROWS[4:], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op4_token_counts(spark, str(tmp_path)).collect()}
    for doc, text in ROWS[:3]:
        text, r = text or "", got[doc]
        assert (r.n_chars, r.n_tokens) == (len(text), count(text))
        m = len(text) // 2
        text = text[:m] + "[edited] the middle" + text[m + 16 :]
        text = text[: m + 5] + text[m + 9 :]
        assert (r.edited_chars, r.edited_tokens) == (len(text), count(text))
        a, b = len(text) // 5, 2 * len(text) // 5
        text = "A new start. " + text
        text = text[:a] + " " + text[b:]
        assert (r.again_chars, r.again_tokens) == (len(text), count(text))
