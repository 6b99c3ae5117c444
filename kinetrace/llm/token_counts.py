"""Edit-aware token counting: a segment tree per document, of which edits touch one path.

A leaf is a run of pre-tokens of about LEAF_CHARS characters. Leaves end where a letter or digit is
followed by white space or punctuation other than an apostrophe: there every pre-token pattern of the
byte-level BPE family ends a pre-token whatever stands around, so counts of leaves add up to the count
of the text. An edit re-encodes the leaves it touches, with so much context that the two characters at
each outer boundary are untouched, and updates the sums above them; leaves that grow are split. A text
without such a place (one endless word) is one leaf.

Defined cases: null and empty texts have no tokens and one empty leaf; edits beyond the end of a text
are clipped to it, a null edit changes nothing; special tokens in a text count as ordinary text;
repeated rows each get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dense, fresh

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pre-token pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF_CHARS = 512
#: Letters and digits, then spaces and punctuation, on which all versions of Unicode agree.
CUT = re.compile(
    "[0-9A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F\u0391-\u03A1\u03A3-\u03C9\u0400-\u0481\u048A-\u04FF\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3]"
    "(?=[ \t\n!-&(-/:-@\\[-`{-~\u3001\u3002\u300C\u300D\uFF01\uFF0C\uFF1A\uFF1B\uFF1F])"
)
Counter = Callable[[str], int]


def leaves_of(text: str, size: int = LEAF_CHARS) -> list[str]:
    """The text in leaves of `size` characters or a little more."""
    out, at = [], 0
    while len(text) - at > size:
        m = CUT.search(text, at + size - 1)
        if not m:
            break
        out.append(text[at : m.start() + 1])
        at = m.start() + 1
    out.append(text[at:])
    return out


class Node:
    """A leaf, or the sums over two subtrees. Nodes never change, so trees share what they have in common."""

    __slots__ = ("left", "right", "leaves", "chars", "tokens")

    def __init__(self, left: Node | None, right: Node | None, chars: int = 0, tokens: int = 0):
        self.left, self.right = left, right
        if left is None:
            self.leaves, self.chars, self.tokens = 1, chars, tokens
        else:
            self.leaves, self.chars, self.tokens = left.leaves + right.leaves, left.chars + right.chars, left.tokens + right.tokens


#: Fixed values of weight-balanced trees: no subtree has over 3 times its neighbour's leaves; a single
#: rotation mends it where the inner grandchild has less than twice the outer one's.
HEAVY, INNER = 3, 2


def balanced(a: Node, b: Node) -> Node:
    """a before b, where one may have grown or shrunk by a step."""
    if b.leaves > HEAVY * a.leaves:
        if b.left.leaves < INNER * b.right.leaves:
            return Node(Node(a, b.left), b.right)
        return Node(Node(a, b.left.left), Node(b.left.right, b.right))
    if a.leaves > HEAVY * b.leaves:
        if a.right.leaves < INNER * a.left.leaves:
            return Node(a.left, Node(a.right, b))
        return Node(Node(a.left, a.right.left), Node(a.right.right, b))
    return Node(a, b)


def joined(a: Node | None, b: Node | None) -> Node | None:
    """The leaves of a, then those of b, in as many steps as their heights differ."""
    if a is None or b is None:
        return b if a is None else a
    if a.leaves > HEAVY * b.leaves:
        return balanced(a.left, joined(a.right, b))
    if b.leaves > HEAVY * a.leaves:
        return balanced(joined(a, b.left), b.right)
    return Node(a, b)


def parted(t: Node | None, k: int) -> tuple[Node | None, Node | None]:
    """The first k leaves, and the others."""
    if t is None or k <= 0:
        return None, t
    if k >= t.leaves:
        return t, None
    if k <= t.left.leaves:
        a, b = parted(t.left, k)
        return a, joined(b, t.right)
    a, b = parted(t.right, k - t.left.leaves)
    return joined(t.left, a), b


def planted(chars, tokens) -> Node | None:
    """A tree over leaves in order, level by level."""
    level = [Node(None, None, int(c), int(n)) for c, n in zip(chars, tokens)]

    def over(i: int, j: int) -> Node:
        return level[i] if j - i == 1 else Node(over(i, (i + j) // 2), over((i + j) // 2, j))

    return over(0, len(level)) if level else None


class CountTree:
    """Sums of characters and tokens over a text's leaves, as a tree that splits and joins in O(log n)."""

    def __init__(self, chars, tokens):
        self.root = planted(chars, tokens) or Node(None, None)

    def locate(self, at: int) -> tuple[int, int]:
        """The leaf that holds character `at`, and where it starts; the last one beyond the end."""
        node, leaf, start = self.root, 0, 0
        while node.left is not None:
            if at - start < node.left.chars:
                node = node.left
            else:
                leaf, start, node = leaf + node.left.leaves, start + node.left.chars, node.right
        return leaf, start

    def size_of(self, leaf: int) -> int:
        """The characters of a leaf."""
        node = self.root
        while node.left is not None:
            if leaf < node.left.leaves:
                node = node.left
            else:
                leaf, node = leaf - node.left.leaves, node.right
        return node.chars

    def replace(self, first: int, last: int, chars, tokens) -> None:
        """Other leaves in place of those from first to last."""
        before, rest = parted(self.root, first)
        _, after = parted(rest, last - first + 1)
        self.root = joined(joined(before, planted(chars, tokens)), after)

    def leaves(self) -> tuple[list[int], list[int]]:
        chars, tokens, todo = [], [], [self.root]
        while todo:
            node = todo.pop()
            if node.left is None:
                chars.append(node.chars)
                tokens.append(node.tokens)
            else:
                todo += [node.right, node.left]
        return chars, tokens

    @property
    def n(self) -> int:
        return self.root.leaves

    @property
    def chars(self) -> int:
        return self.root.chars

    @property
    def total(self) -> int:
        return self.root.tokens


def build(text: str, count: Counter, size: int = LEAF_CHARS) -> CountTree:
    leaves = leaves_of(text, size)
    return CountTree([len(x) for x in leaves], [count(x) for x in leaves])


def apply_edit(text: str, tree: CountTree, start: int, stop: int, new: str, count: Counter, size: int = LEAF_CHARS) -> tuple[str, int]:
    """Replace [start, stop) by `new`: the edited text and how many characters were encoded again. What
    is left of a leaf goes together with the next one when it is shorter than half a leaf."""
    start = min(max(start, 0), len(text))
    stop = min(max(stop, start), len(text))
    first, left = tree.locate(max(start - 2, 0))
    last, at = tree.locate(stop)
    right = at + tree.size_of(last)
    pieces = leaves_of(text[left:start] + new + text[stop:right], size)
    while len(pieces[-1]) < size // 2 and last < tree.n - 1:
        last += 1
        more = tree.size_of(last)
        pieces[-1:] = leaves_of(pieces[-1] + text[right : right + more], size)
        right += more
    tree.replace(first, last, [len(p) for p in pieces], [count(p) for p in pieces])
    return text[:start] + new + text[stop:], sum(map(len, pieces))


@cache
def counter(vocabulary: bytes, pattern: str) -> Counter:
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text)) if text else 0


class Tokenizer:
    """A vocabulary read once on the driver and broadcast (under 1 MB)."""

    def __init__(self, spark: SparkSession, vocabulary: str = VOCABULARY, pattern: str = PATTERN):
        with open(vocabulary, "rb") as f:
            self.shared = spark.sparkContext.broadcast(f.read())
        self.pattern = pattern

    def __getstate__(self):
        return {"shared": self.shared, "pattern": self.pattern}

    def counter(self) -> Counter:
        return counter(self.shared.value, self.pattern)


def with_trees(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """docs (doc_id, text, ...) with `leaf_chars`, `leaf_tokens` (the tree's leaves; sums follow from
    them) and `n_tokens`."""
    names = docs.columns
    at = names.index("text")
    if taken := [c for c in ("leaf_chars", "leaf_tokens", "n_tokens") if fresh(docs, c) != c]:
        raise ValueError(f"the table has columns of these names already: {', '.join(taken)}")
    schema = docs.selectExpr("*", "cast(null as array<int>) leaf_chars", "cast(null as array<int>) leaf_tokens", "cast(0 as long) n_tokens").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer.counter()
        for batch in batches:
            chars, tokens = [], []
            for text in batch.column(at).to_pylist():
                leaves = leaves_of(text or "")
                chars.append([len(x) for x in leaves])
                tokens.append([count(x) for x in leaves])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chars, kind), pa.array(tokens, kind), pa.array([sum(t) for t in tokens], pa.int64())], names=[*names, "leaf_chars", "leaf_tokens", "n_tokens"])

    return dense(docs).mapInArrow(run, schema)


EDIT = "array<struct<start: long, stop: long, text: string>>"


def edited(rows: DataFrame, tokenizer: Tokenizer, edits: str = "edits", encoded: str = "chars_encoded") -> DataFrame:
    """Rows of `with_trees` after their edits: `edits` is a column of type EDIT, whose members apply one
    after the other, each to what the one before left. `text`, `leaf_chars`, `leaf_tokens` and `n_tokens`
    are those of the edited text, so that later edits go on from them; `encoded` is added."""
    names = rows.columns
    schema = rows.select("*", F.lit(0).cast("long").alias(encoded)).schema
    place = {c: names.index(c) for c in ("text", "leaf_chars", "leaf_tokens", "n_tokens", edits)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer.counter()
        for batch in batches:
            out = {c: batch.column(k).to_pylist() for c, k in place.items()}
            again = []
            for i, todo in enumerate(out[edits]):
                again.append(0)
                todo = [e for e in todo or [] if e and e["start"] is not None and e["stop"] is not None]
                if not todo:
                    continue
                text, tree = out["text"][i] or "", CountTree(out["leaf_chars"][i], out["leaf_tokens"][i])
                for e in todo:
                    text, n = apply_edit(text, tree, e["start"], e["stop"], e["text"] or "", count)
                    again[i] += n
                out["text"][i], out["n_tokens"][i] = text, tree.total
                out["leaf_chars"][i], out["leaf_tokens"][i] = tree.leaves()
            columns = list(batch.columns)
            for c, k in place.items():
                if c != edits:
                    columns[k] = pa.array(out[c], columns[k].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(again, pa.int64())], names=[*names, encoded])

    return rows.mapInArrow(run, schema)
