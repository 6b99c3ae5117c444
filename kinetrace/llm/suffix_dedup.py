"""Removal of repeated passages: every byte covered by a LENGTH-byte string that starts elsewhere too.

Suffixes are sampled at content anchors, so a repeated passage is sampled alike wherever it stands:
of the GRAM-byte strings in a window of LENGTH bytes the one of smallest fingerprint is the window's
anchor, and equal windows have equal anchors. The anchor's fingerprint is the suffix's leading token.

1. One scan emits, per text, its anchors with the run of windows that each one serves. Equal texts
   are one from here on; a text with copies is covered whole.
2. Anchors are counted by (token, context), a context being the bytes of the whole run: a context
   that occurs twice is covered whole, without comparing anything.
3. Tokens with several contexts send one copy of each context to a bucket. Spark's sampled splitters
   range-partition them by leading token; a bucket takes its tokens in that order, CHUNK bytes or so
   at a time, and sorts the suffixes that start at their windows by multikey quicksort, eight bytes a
   step: suffixes that agree so far are split by their next eight bytes, and those left alone are
   done. What stays together for LENGTH bytes is repeated.
4. A token of more than HOT_CONTEXTS contexts is split by context as well, so it straddles buckets and
   chunks, and is compared across their boundaries: each chunk gives one fingerprint of each of its
   distinct windows, and those of several chunks are repeated too.
5. Runs of repeated windows go back to the texts, which are read again to remove their bytes.

Beside the bytes, passages of WORDS words are looked up in the same manner, since many of them are
shorter than LENGTH bytes: `n_repeated_words` counts the words, letters A-Z in either case, that lie
in a string of WORDS words that starts elsewhere too. They are counted, not removed, and windows of
words are compared by their fingerprint and their anchor's, not sorted.

Defined cases: null counts as empty; texts shorter than LENGTH keep all their bytes; repeated rows are
copies of one another and so are removed whole if long enough; null and repeated ids are reported as
they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, BYTE_VALUE, Scratch, join_groups, mix, prefix_sums, range_hash, small, spans_of, utf8
from .minhash import groups_in, word_hashes

LENGTH = 400
GRAM = 64
#: The same in words.
WORDS, WORD_GRAM = 50, 12
#: Bytes of contexts that are sorted together, about, and contexts of a token that stay together.
CHUNK = 2 << 20
HOT_CONTEXTS = 8192
BLOCK = 1 << 19
PLACE_BITS = np.uint64(22)
SHA_OF_NOTHING = hashlib.sha256(b"").hexdigest()

ANCHOR = "struct<token:long,ctx:long,start:long,n:int>"
SCAN = f"doc_id long, ka long, kb long, n_bytes long, n_words long, sha string, anchors array<{ANCHOR}>, word_anchors array<{ANCHOR}>"


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours."""
    have = 1
    while have * 2 <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[: len(v) - (width - have)], v[width - have :]) if have < width else v


def anchors_of(values: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, token, ctx, start, n) of the runs of windows with one anchor, by row and start. values are
    64-bit fingerprints of the units (bytes or words), offsets those of texts, or of one long text."""
    if len(values) > 2 * BLOCK and len(offsets) == 2:  # in parts that share no window
        got = []
        for a in range(0, len(values) - length + 1, BLOCK):
            piece = values[a : a + BLOCK + length - 1]
            row, token, ctx, start, n = anchors_of(piece, np.array([0, len(piece)]), length, gram)
            got.append((row, token, ctx, start + a, n))
        return tuple(np.concatenate(x) for x in zip(*got))
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int32))
    if len(values) < length:
        return none
    sums = prefix_sums(values)
    at = np.arange(len(values) - gram + 1)
    grams = range_hash(sums, at, at + gram)
    best = sliding_min((grams >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64), length - gram + 1)
    room = np.diff(offsets) - length + 1
    rows = np.flatnonzero(room > 0)
    if not len(rows):
        return none
    room = room[rows]
    ends = np.cumsum(room)
    window = np.arange(ends[-1]) - np.repeat(ends - room - offsets[rows], room)
    row = np.repeat(rows, room)
    anchor = (best[window] & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    n = np.diff(np.append(cut, len(anchor)))
    first, place, row = window[cut], anchor[cut], row[cut]
    token = grams[place]
    ctx = mix(range_hash(sums, first, first + n + length - 1) + (place - first).astype(np.uint64))
    return row, token.view(np.int64), ctx.view(np.int64), first - offsets[row], n.astype(np.int32)


def anchor_lists(found: tuple[np.ndarray, ...], rows: int) -> pa.ListArray:
    row, token, ctx, start, n = found
    lists = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(token), pa.array(ctx), pa.array(start.astype(np.int64)), pa.array(n)], names=["token", "ctx", "start", "n"])
    return pa.ListArray.from_arrays(pa.array(lists), items)


def scan(docs: DataFrame, length: int, gram: int, words: int, word_gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in spans_of(offsets, BLOCK):
                own = offsets[i : j + 1] - offsets[i]
                part = data[offsets[i] : offsets[j]]
                in_bytes = anchor_lists(anchors_of(BYTE_VALUE[part], own, length, gram), j - i)
                hashes, first = word_hashes(part, own)
                in_words = anchor_lists(anchors_of(hashes, first, words, word_gram), j - i)
                raw = part.tobytes()
                shas = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(own[:-1], own[1:])]
                keys = np.frombuffer(b"".join(shas), np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array(np.diff(own)), pa.array(np.diff(first)), pa.array([s.hex() for s in shas]), in_bytes, in_words],
                    names=["doc_id", "ka", "kb", "n_bytes", "n_words", "sha", "anchors", "word_anchors"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCAN)


def one_row_a_text(scanned: DataFrame, total: int, scratch: Scratch) -> DataFrame:
    """(ka, kb, copies, rep, anchors, word_anchors) of each different text. Texts without a copy stay
    where they are; of the others the row of the smallest id is taken."""
    classes = scanned.groupBy("ka", "kb").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep")).where("copies > 1")
    classes = scratch.store(classes, "classes", total)
    held = small(classes)
    picked = lambda rows: rows.join(held, ["ka", "kb"], "left").where("copies is null or doc_id <=> rep")
    sums = classes.agg(F.count("*").alias("n"), F.sum("copies").alias("rows")).first()
    one = picked(scanned)
    if picked(scanned.select("doc_id", "ka", "kb")).count() != total - (sums.rows or 0) + sums.n:  # rows that repeat an id and its text
        one = one.dropDuplicates(["ka", "kb"])
    return one.select("ka", "kb", F.coalesce("copies", F.lit(1)).alias("copies"), F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("rep")).alias("rep"), "anchors", "word_anchors")


def window_starts(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where all windows of several contexts start, and how many each context has."""
    n = np.diff(offsets) - length + 1
    ends = np.cumsum(n)
    return np.arange(ends[-1]) - np.repeat(ends - n - offsets[:-1], n), n


def multikey_classes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """The class of each suffix, -1 for one alone: two have the same class if they belong to one group
    and agree for `length` bytes (8 or more). `group` doesn't fall."""
    step = 8
    words = np.zeros(len(data) - step + 1, np.uint64)
    for k in range(step):
        words = (words << np.uint64(8)) | data[k : len(data) - step + 1 + k]
    item = np.arange(len(starts))
    part = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))
    depths = [*range(0, length - step, step), length - step]
    for depth in depths:
        heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        size = np.diff(np.append(heads, len(part)))
        many = size > 1
        if not many.all():  # suffixes alone are done
            keep = np.repeat(many, size)
            item, part = item[keep], part[keep]
            size = size[many]
            heads = np.cumsum(size) - size
        if not len(item):
            break
        key = words[starts[item] + depth]
        unlike = np.flatnonzero(key != np.repeat(key[heads], size))
        if not len(unlike):
            continue
        which = np.unique(np.searchsorted(heads, unlike, "right") - 1)
        split = np.zeros(len(heads), bool)
        split[which] = True
        at = np.flatnonzero(np.repeat(split, size))
        order = np.lexsort((key[at], part[at]))
        item[at], key[at] = item[at[order]], key[at[order]]
        part = np.cumsum(np.concatenate([[0], (part[1:] != part[:-1]) | (key[1:] != key[:-1])]))
    out = np.full(len(starts), -1)
    if len(item):
        size = np.bincount(part)
        alike = size[part] > 1
        out[item[alike]] = part[alike]
    return out


def flag_runs(flags: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to) of runs of set flags; row i has the next n[i] flags."""
    first = np.concatenate([[0], np.cumsum(n)])
    edge = np.zeros(len(flags) + 1, bool)
    edge[first] = True
    start = flags & (np.concatenate([[True], ~flags[:-1]]) | edge[:-1])
    end = flags & (np.concatenate([~flags[1:], [True]]) | edge[1:])
    a, b = np.flatnonzero(start), np.flatnonzero(end) + 1
    row = np.searchsorted(first, a, "right") - 1
    return row, a - first[row], b - first[row]


SORTED = "token long, ctx long, runs array<struct<a:int,b:int>>, edge array<struct<t:int,print:long,alone:boolean>>"


def sorted_chunk(table: pa.Table, length: int, straddles: bool) -> pa.RecordBatch | None:
    """SORTED of one chunk of contexts (token, ctx, text), by token: the runs of windows that repeat in
    it, and, of a token that straddles chunks, one window of each class."""
    data, offsets = utf8(table.column(2))
    tokens = table.column(0).to_numpy()
    starts, n = window_starts(offsets, length)
    owner = np.repeat(np.arange(len(n)), n)
    classes = multikey_classes(data, starts, tokens[owner], length)
    row, a, b = flag_runs(classes >= 0, n)
    outer = np.arange(len(starts)) if straddles else np.zeros(0, np.int64)
    known = outer[classes[outer] >= 0]
    shown = np.sort(np.concatenate([outer[classes[outer] < 0], known[np.unique(classes[known], return_index=True)[1]]]))
    prints = np.zeros(len(shown), np.int64)
    for i, j in spans_of(offsets, BLOCK):
        sums = prefix_sums(BYTE_VALUE[data[offsets[i] : offsets[j]]])
        lo, hi = np.searchsorted(owner[shown], [i, j])
        at = starts[shown[lo:hi]] - offsets[i]
        prints[lo:hi] = range_hash(sums, at, at + length).view(np.int64)
    t = starts[shown] - offsets[owner[shown]]
    rows = np.union1d(row, owner[shown])
    if not len(rows):
        return None
    cut = lambda of: pa.array(np.append(np.searchsorted(of, rows), len(of)).astype(np.int32))
    runs = pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["a", "b"])
    edge = pa.StructArray.from_arrays([pa.array(t.astype(np.int32)), pa.array(prints), pa.array(classes[shown] < 0)], names=["t", "print", "alone"])
    take = lambda k: table.column(k).combine_chunks().take(pa.array(rows))
    return pa.RecordBatch.from_arrays([take(0), take(1), pa.ListArray.from_arrays(cut(row), runs), pa.ListArray.from_arrays(cut(owner[shown]), edge)], names=["token", "ctx", "runs", "edge"])


def bucket_repeats(contexts: DataFrame, length: int, parts: int, chunk: int) -> DataFrame:
    """SORTED of contexts (token, ctx, text, hot), in range-partitioned buckets. Equal tokens stay
    together, but for hot ones."""
    split = F.when(F.col("hot"), F.col("ctx")).otherwise(F.lit(0))
    ranged = contexts.select("token", "ctx", "text", "hot").repartitionByRange(parts, F.col("token"), split).sortWithinPartitions("token", "ctx")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, bool]]:
        held, size = [], 0
        for group in groups_in(batches, 1):
            if group.column(3)[0].as_py():
                rows = max(1, chunk * group.num_rows // max(1, group.nbytes))
                for i in range(0, group.num_rows, rows):
                    yield group.slice(i, rows), True
                continue
            held.append(group)
            size += group.nbytes
            if size >= chunk:
                yield pa.concat_tables(held), False
                held, size = [], 0
        if held:
            yield pa.concat_tables(held), False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, straddles in chunks(batches):
            if found := sorted_chunk(table, length, straddles):
                yield found

    return ranged.mapInArrow(run, SORTED)


def boundary_repeats(found: DataFrame) -> DataFrame:
    """(token, ctx, runs) of windows that no other of their chunk equals, but one of another chunk."""
    edges = found.select("token", "ctx", F.explode("edge").alias("e")).select("token", "ctx", "e.*")
    several = edges.groupBy("token", "print").agg(F.count("*").alias("times")).where("times > 1").select("token", "print")
    again = edges.where("alone").join(several, ["token", "print"], "left_semi")
    return again.groupBy("token", "ctx").agg(F.collect_list(F.struct(F.col("t").alias("a"), (F.col("t") + 1).alias("b"))).alias("runs"))


def texts_of(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """asked (rep, ka, kb, ...) with the text of document rep. While the ids asked for are few they
    travel to the texts and only those texts are dealt; else all texts are."""
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    ids = asked.select("rep").distinct()
    if ids.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(ids), texts["rep"].eqNullSafe(ids["rep"]), "left_semi")
    texts = texts.select(F.col("rep").alias("__rep"), "text")
    return asked.join(texts, F.col("rep").eqNullSafe(F.col("__rep"))).drop("__rep")


def same_text(raw: bytes, ka: int, kb: int) -> bool:
    digest = hashlib.sha256(raw).digest()
    return int.from_bytes(digest[:8], "little", signed=True) == ka and int.from_bytes(digest[8:16], "little", signed=True) == kb


FETCHED = "kind int, token long, ctx long, hot boolean, text binary, prints array<long>"


def fetched(needed: DataFrame, docs: DataFrame, length: int, words: int) -> DataFrame:
    """FETCHED of the runs of windows asked for: of kind 0 (bytes) their text, of kind 1 (words) the
    fingerprint of each window. Texts are read once for both."""
    asked = needed.groupBy("rep", "ka", "kb").agg(F.collect_list(F.struct("kind", "token", "ctx", "start", "n", "hot")).alias("want"))
    joined = texts_of(asked, docs).select("ka", "kb", "want", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).cast(pa.large_binary())
            lists = batch.column(2)
            ends, flat = lists.offsets.to_numpy(), lists.values
            kind, token, ctx, start, n, hot = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(6))
            order, bodies, prints = [], [], []
            for k in range(batch.num_rows):
                raw = texts[k].as_py() or b""
                if not same_text(raw, batch.column(0)[k].as_py(), batch.column(1)[k].as_py()):
                    continue
                own = np.arange(ends[k], ends[k + 1])
                whole, worded = own[kind[own] == 0], own[kind[own] == 1]
                order += [whole, worded]
                bodies += [raw[a : a + m + length - 1] for a, m in zip(start[whole].tolist(), n[whole].tolist())] + [None] * len(worded)
                prints += [None] * len(whole)
                if len(worded):
                    sums = prefix_sums(word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])
                    spans = [np.arange(a, a + m) for a, m in zip(start[worded].tolist(), n[worded].tolist())]
                    prints += [range_hash(sums, at, at + words).view(np.int64) for at in spans]
            if order:
                at = np.concatenate(order)
                cols = [pa.array(kind[at], pa.int32()), pa.array(token[at]), pa.array(ctx[at]), pa.array(hot[at], pa.bool_()), pa.array(bodies, pa.binary()), pa.array(prints, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["kind", "token", "ctx", "hot", "text", "prints"])

    # Rows that repeat an id and its text would give a context twice.
    return joined.mapInArrow(run, FETCHED).dropDuplicates(["kind", "token", "ctx"])


def word_repeats(contexts: DataFrame) -> DataFrame:
    """(token, ctx, runs) of windows of words that occur in several of the contexts (token, ctx, prints)."""
    each = contexts.select("token", "ctx", F.posexplode("prints").alias("t", "print"))
    counts = each.groupBy("token", "print").agg(F.count("*").alias("times")).where("times > 1")
    again = each.join(counts.select("token", "print"), ["token", "print"], "left_semi")
    return again.groupBy("token", "ctx").agg(F.collect_list(F.struct(F.col("t").alias("a"), (F.col("t") + 1).alias("b"))).alias("runs"))


def words_covered(covers: DataFrame) -> DataFrame:
    """(ka, kb, n_repeated_words) of texts with covered ranges of words (ka, kb, ranges)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = batch.column(2)
            ends, flat = ranges.offsets.to_numpy(), ranges.values
            lo, hi = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            n = [sum(b - a for a, b in merged(lo[i:j], hi[i:j])) for i, j in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["ka", "kb", "n_repeated_words"])

    return covers.select("ka", "kb", "ranges").mapInArrow(run, "ka long, kb long, n_repeated_words long")


def removed_from(covers: DataFrame, docs: DataFrame) -> DataFrame:
    """(ka, kb, n_removed, n_spans, kept_sha) of texts with covered ranges (rep, ka, kb, ranges)."""
    joined = texts_of(covers, docs).select("ka", "kb", "ranges", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).cast(pa.large_binary())
            ranges = batch.column(2)
            offsets, flat = ranges.offsets.to_numpy(), ranges.values
            lo, hi = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            out = []
            for k in range(batch.num_rows):
                raw = texts[k].as_py() or b""
                ka, kb = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                if same_text(raw, ka, kb):
                    spans = merged(lo[offsets[k] : offsets[k + 1]], hi[offsets[k] : offsets[k + 1]])
                    out.append((ka, kb, sum(b - a for a, b in spans), len(spans), hashlib.sha256(without(raw, spans)).hexdigest()))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["ka", "kb", "n_removed", "n_spans", "kept_sha"])

    return joined.mapInArrow(run, "ka long, kb long, n_removed long, n_spans long, kept_sha string").dropDuplicates(["ka", "kb"])


def merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes; ranges that touch are one run."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    fresh = np.concatenate([[True], lo[1:] > hi[:-1]])
    at = np.flatnonzero(fresh)
    return [(int(a), int(b)) for a, b in zip(lo[at], hi[np.append(at[1:], len(lo)) - 1])]


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out)


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, words: int = WORDS, word_gram: int = WORD_GRAM, chunk: int = CHUNK, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated_words, has_repeat) per document."""
    scratch = Scratch(spark, "suffix-dedup", docs)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    scanned = scratch.store(scan(docs, length, gram, words, word_gram), "scan")
    total = scanned.count()
    texts = scratch.store(one_row_a_text(scanned, total, scratch), "texts")
    narrow = scratch.store(scanned.drop("anchors", "word_anchors"), "narrow")
    scratch.delete("scan")
    both = [texts.select("ka", "kb", "rep", "copies", F.lit(k).alias("kind"), F.explode(c).alias("x")) for k, c in enumerate(("anchors", "word_anchors"))]
    anchors = both[0].unionByName(both[1]).select("kind", "ka", "kb", "rep", "copies", "x.*")
    keys = ["kind", "token", "ctx"]
    # Any place of a context will do as the one to read it at.
    place = ("rep", "ka", "kb", "start", "n")
    contexts = anchors.groupBy(*keys).agg(F.sum("copies").alias("c"), *[F.first(x).alias(x) for x in place])
    contexts = scratch.store(contexts, "contexts")
    n_contexts = contexts.count()
    n_places = contexts.agg(F.sum("c")).first()[0] or 0
    tokens = scratch.store(contexts.groupBy("kind", "token").agg(F.count("*").alias("n_ctx")).where("n_ctx > 1"), "tokens", n_contexts)
    needed = join_groups(contexts, tokens, ["kind", "token"], "n_ctx", n_contexts, "inner").select(*keys, *place, (F.col("n_ctx") > hot_contexts).alias("hot"))
    needed = scratch.store(needed, "needed", n_contexts)
    read = scratch.store(fetched(needed, docs, length, words), "fetched")
    scratch.delete("tokens", "needed")
    bodies = read.where("kind = 0").select("token", "ctx", "text", "hot")
    found = scratch.store(bucket_repeats(bodies, length, parts, chunk), "sorted", n_contexts)
    runs = found.where(F.size("runs") > 0).select("token", "ctx", "runs").unionByName(boundary_repeats(found)).withColumn("kind", F.lit(0))
    runs = runs.unionByName(word_repeats(read.where("kind = 1")).withColumn("kind", F.lit(1)))
    # A context that occurs twice is covered whole; for others the runs found in the buckets count.
    whole = contexts.where("c > 1").select(*keys, "c", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("runs"))
    once = contexts.where("c = 1").select(*keys, "c").join(runs, keys)
    repeats = scratch.store(whole.unionByName(once), "repeats", n_contexts)
    scratch.delete("fetched", "sorted", "contexts")
    single = anchors.where("copies = 1")
    hits = join_groups(single, repeats, keys, "c", n_places, "inner")
    spans = hits.select("kind", "rep", "ka", "kb", "start", F.explode("runs").alias("r"))
    width = F.when(F.col("kind") == 0, length).otherwise(words)
    covered = F.struct((F.col("start") + F.col("r.a")).alias("lo"), (F.col("start") + F.col("r.b") - 1 + width).alias("hi"))
    covers = spans.groupBy("kind", "rep", "ka", "kb").agg(F.collect_list(covered).alias("ranges"))
    covers = scratch.store(covers, "covers", total)
    changed = scratch.store(removed_from(covers.where("kind = 0"), docs), "changed", total)
    counted = words_covered(covers.where("kind = 1"))
    verdict = texts.select("ka", "kb", "copies").join(changed, ["ka", "kb"], "left").join(counted, ["ka", "kb"], "left")
    verdict = verdict.where(F.col("n_removed").isNotNull() | F.col("n_repeated_words").isNotNull() | (F.col("copies") > 1))
    verdict = scratch.store(verdict, "verdict", total)
    out = join_groups(narrow, verdict, ["ka", "kb"], "copies", total)
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    pick = lambda full, else_: F.when(gone, full).otherwise(else_)
    n_words = F.when((F.col("copies") > 1) & (F.col("n_words") >= words), F.col("n_words")).otherwise(F.coalesce("n_repeated_words", F.lit(0))).cast("long")
    out = out.select(
        "doc_id",
        "n_bytes",
        pick(F.col("n_bytes"), F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        pick(F.lit(1), F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        pick(F.lit(SHA_OF_NOTHING), F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        n_words.alias("n_repeated_words"),
        (n_words > 0).alias("has_repeat"),
    )
    return scratch.finish(out)
