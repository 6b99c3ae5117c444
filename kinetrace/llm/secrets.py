"""Secret scanning: rules find the base findings, a character convolutional network adds more.

Candidates are all rule matches and, outside them, all runs of 6 or more token characters but plain
words: a run counts when it holds a digit, a sign of `+/_=` or a capital after a small letter, or when
it follows `:` or `=`. Of a run that a rule matches in part, the rest is a candidate. Every candidate is
read, with the characters around it, by a small convolutional network in numpy. It is trained on
labelled findings: the distinct candidates of all documents, labelled by the rules, and generated ones
of kinds that the rules don't know. Candidates are dealt into blocks by hash; in each round every block
trains a copy of the network on its rows and the generated ones, and the copies' mean starts the next.
Weights keep the balance between labels and generated findings, however many candidates there are. Its
scores are calibrated, and the threshold chosen, on all candidates held out by doc_id and on generated
ones: the highest that keeps the wanted recall in each. Scores are whole multiples of 1/256, so counts
by score say all of the held-out candidates. Candidates over the threshold outside base findings become spans of kind `model`; base
findings always stay, and `n_confirmed` counts those that the network finds too.

Defined cases: a null text counts as empty and has no findings; spans are in code points of the
whole text; long candidates are read in windows and get their highest score; documents without any
rule match train on generated findings alone; a null doc_id counts as an empty text in the hold-out
rule; repeated rows each get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dense, small_batches

KINDS = ("assign", "access", "hex", "model")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: What tells a run from a plain word: within it, or before it.
UNLIKE_WORDS = re.compile(r"[0-9+/_=]|[a-z][A-Z]")
ASSIGNED = re.compile(r"[:=]\x20{0,2}[\"']?$")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

CONTEXT, BODY = 24, 48
WIDTH = 2 * CONTEXT + BODY
N_CLASSES = 72
EMBED, FILTERS, KERNEL = 12, 24, 5
RECALL = 0.99
#: Labelled candidates weigh as much as so many generated ones for each label, at most.
LABEL_WEIGHT = 1000
#: Candidates of a block, about; rounds of training, and epochs of each.
BLOCK_ROWS, ROUNDS, EPOCHS = 4096, 4, 3
#: Scores are multiples of 1 / SCORE_STEPS within SCORE_LIMIT.
SCORE_STEPS, SCORE_LIMIT = 256, 64
#: Generated findings for training and for calibration.
N_TRAIN, N_CALIBRATE = 2000, 1500


def base_findings(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' matches, sorted. Access keys and hexadecimal runs lie within
    runs of token characters that are no shorter, so only those are searched."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= MIN_ASSIGN]
    for a, b in runs:
        if b - a >= MIN_ACCESS:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, a, b) if m.end() - m.start() >= MIN_ACCESS]
        if b - a >= MIN_HEX:
            out += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, b) if m.end() - m.start() >= MIN_HEX]
    return sorted(out)


#: What a character is to token_runs, as bits.
TOKEN, UNLIKE, SMALL, CAPITAL, SIGN = 1, 2, 4, 8, 16


@cache
def run_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for group, bits in (("abcdefghijklmnopqrstuvwxyz", TOKEN | SMALL), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", TOKEN | CAPITAL), ("0123456789+/_=", TOKEN | UNLIKE), (".-", TOKEN), (":=", SIGN)):
        for ch in group:
            table[ord(ch)] |= bits
    return table


def token_runs(text: str) -> list[tuple[int, int]]:
    """Runs of 6 or more token characters, but those that are plain words of under MIN_ACCESS characters
    with neither `:` nor `=` close before them: of texts, a small part."""
    if len(text) < 6:
        return []
    kind = run_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    token = np.concatenate([[False], (kind & TOKEN).astype(bool), [False]])
    edges = np.flatnonzero(token[1:] != token[:-1])
    starts, ends = edges[::2], edges[1::2]
    wide = ends - starts >= 6
    starts, ends = starts[wide], ends[wide]
    if not len(starts):
        return []
    picked = ends - starts >= MIN_ACCESS
    inner = np.flatnonzero((kind[:-1] & SMALL).astype(bool) & (kind[1:] & CAPITAL).astype(bool))
    marks = np.concatenate([np.flatnonzero(kind & UNLIKE), inner])
    run = np.searchsorted(starts, marks, "right") - 1
    picked[run[(run >= 0) & (marks < ends[run])]] = True
    signs = np.flatnonzero(kind & SIGN)
    run = np.searchsorted(starts, signs, "right")
    signs, run = signs[run < len(starts)], run[run < len(starts)]
    picked[run[starts[run] - signs <= 4]] = True
    return list(zip(starts[picked].tolist(), ends[picked].tolist()))


def candidates(text: str, runs: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans outside the base findings that the network is to judge."""
    out = []
    k = 0
    for a, b in runs:
        while k < len(base) and base[k][2] <= a:
            k += 1
        rest, j = [], k
        while j < len(base) and base[j][0] < b:
            rest.append((a, base[j][0]))
            a = max(a, base[j][2])
            j += 1
        for lo, hi in (*rest, (a, b)):
            if hi - lo >= 6 and (UNLIKE_WORDS.search(text, lo, hi) or ASSIGNED.search(text, max(0, lo - 4), lo)):
                out.append((lo, hi))
    return out


@cache
def class_table() -> np.ndarray:
    """Character classes by code point: 0 outside the text, own classes for ASCII letters and digits."""
    table = np.full(0x110000, 71, np.uint8)
    for i in range(26):
        table[97 + i] = 1 + i
        table[65 + i] = 27 + i
    for i in range(10):
        table[48 + i] = 53 + i
    for i, group in enumerate(("+/", "_", ".", "=", "-", "\"'", ":")):
        for ch in group:
            table[ord(ch)] = 63 + i
    for ch in " \t\n\r":
        table[ord(ch)] = 70
    return table


def windows(text: str, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Class windows (n x WIDTH) of the candidates, and the candidate of each."""
    rows, owner = [], []
    for k, (a, b) in enumerate(spans):
        for at in range(a, max(b, a + 1), BODY):
            lo, hi = at - CONTEXT, at + BODY + CONTEXT
            piece = text[max(lo, 0) : hi]
            row = np.zeros(WIDTH, np.uint8)
            left = max(0, -lo)
            row[left : left + len(piece)] = class_table()[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
            rows.append(row)
            owner.append(k)
    return (np.stack(rows) if rows else np.zeros((0, WIDTH), np.uint8)), np.array(owner, np.int64)


#: Scores, labels, how many candidates have them, and what each of these weighs.
Scores = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Network:
    """Embedding, one convolution, ReLU, maximum over positions, one output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {
            "e": rng.normal(0, 0.5, (N_CLASSES, EMBED)),
            "k": rng.normal(0, (KERNEL * EMBED) ** -0.5, (KERNEL * EMBED, FILTERS)),
            "b": np.zeros(FILTERS),
            "w": rng.normal(0, FILTERS**-0.5, FILTERS),
            "c": np.zeros(1),
        }
        self.slope, self.shift, self.threshold = 1.0, 0.0, 0.5

    def forward(self, x: np.ndarray) -> tuple:
        seen = self.p["e"][x]
        n = seen.shape[1] - KERNEL + 1
        cols = np.concatenate([seen[:, i : i + n] for i in range(KERNEL)], axis=2)
        conv = cols @ self.p["k"] + self.p["b"]
        at = conv.argmax(axis=1)
        top = np.take_along_axis(conv, at[:, None, :], axis=1)[:, 0, :]
        hidden = np.maximum(top, 0)
        return cols, at, top, hidden, hidden @ self.p["w"] + self.p["c"][0]

    def flat(self) -> np.ndarray:
        return np.concatenate([v.reshape(-1) for v in self.p.values()])

    def put(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).copy()
            at += v.size

    def logits(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        z = np.concatenate([self.forward(x[i : i + 1024])[-1] for i in range(0, len(x), 1024)])
        return np.floor(np.clip(z, -SCORE_LIMIT, SCORE_LIMIT) * SCORE_STEPS) / SCORE_STEPS

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -50, 50)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.logits(x))

    def gradients(self, x: np.ndarray, y: np.ndarray, w: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
        cols, at, top, hidden, z = self.forward(x)
        dz = (1 / (1 + np.exp(-z)) - y) * w / len(y)
        dtop = dz[:, None] * self.p["w"] * (top > 0)
        picked = np.take_along_axis(cols, at[:, :, None], axis=1)  # rows x filters x (kernel * embed)
        dcols = dtop[:, :, None] * self.p["k"].T[None]
        de = np.zeros_like(self.p["e"])
        place = at[:, :, None] + np.arange(KERNEL)
        np.add.at(de, x[np.arange(len(x))[:, None, None], place], dcols.reshape(len(x), FILTERS, KERNEL, EMBED))
        return {"e": de, "k": np.einsum("nf,nfd->df", dtop, picked), "b": dtop.sum(0), "w": hidden.T @ dz, "c": np.array([dz.sum()])}

    def train(self, x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None, epochs: int = ROUNDS * EPOCHS, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        w = np.ones(len(y)) if w is None else w
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                step += 1
                some = order[i : i + batch]
                for k, g in self.gradients(x[some], y[some], w[some]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, sets: list[Scores], recall: float = RECALL) -> None:
        """Logistic calibration on all sets, towards targets that allow for their size, then the highest
        threshold that reaches the recall in each set."""
        z, y, w = (np.concatenate(c) for c in zip(*[(z, y, n * weight) for z, y, n, weight in sets]))
        yes, no = (w * y).sum(), (w * (1 - y)).sum()
        target = np.where(y == 1, (yes + 1) / (yes + 2), 1 / (no + 2))
        spread = max(float(np.sqrt((w * (z - (w * z).sum() / w.sum()) ** 2).sum() / w.sum())), 1e-9)
        x = np.stack([z / spread, np.ones_like(z)], axis=1)
        ridge = np.array([1e-3, 0.0])
        loss = lambda c: float((w * (np.logaddexp(0, x @ c) - target * (x @ c))).sum() + (ridge * c * c).sum() / 2)
        c = np.zeros(2)
        for _ in range(100):  # Newton steps, halved until they gain
            p = 1 / (1 + np.exp(-np.clip(x @ c, -500, 500)))
            grad = x.T @ (w * (p - target)) + ridge * c
            step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9), grad)
            size = 1.0
            while size > 1e-6 and loss(c - size * step) > loss(c):
                size /= 2
            if size <= 1e-6 or np.abs(size * step).sum() < 1e-9:
                break
            c = c - size * step
        self.slope, self.shift = float(c[0] / spread), float(c[1])
        tops = []
        for z, y, n, _ in sets:
            order = np.argsort(z[y == 1], kind="stable")
            upto = np.cumsum(n[y == 1][order])
            if len(upto):
                k = np.searchsorted(upto, int(np.floor((1 - recall) * upto[-1])), "right")
                tops.append(float(self.calibrated(z[y == 1][order][k])))
        self.threshold = min(tops) if tops else 1.0


def labelled_findings(n: int, seed: int) -> tuple[list[tuple[str, int, int]], np.ndarray]:
    """Labelled candidates: (text, start, end) and 1 for a secret, 0 for what only looks like one."""
    rng = np.random.default_rng(seed)
    pick = lambda chars, k: "".join(chars[i] for i in rng.integers(0, len(chars), k))
    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    both = low + up + num
    word = lambda: pick(low, int(rng.integers(2, 9)))
    prose = lambda: " ".join(word() for _ in range(int(rng.integers(2, 8))))
    secrets = (
        lambda: ("", pick("0123456789abcdef", int(rng.integers(24, 65))), ""),
        lambda: ("", "AKIA" + pick(up + num, 16), ""),
        lambda: ("password=", pick(both, int(rng.integers(16, 33))), ""),
        lambda: ('token = "', pick("0123456789abcdef", 40), '"'),
        lambda: ("Authorization: Bearer ", pick(both + "_-", int(rng.integers(30, 60))), ""),
        lambda: ("", pick(low, 2) + "_" + pick(low, 4) + "_" + pick(both, int(rng.integers(24, 40))), ""),
        lambda: ("key: ", pick(both + "+/", int(rng.integers(32, 64))) + "==", ""),
        lambda: ("", pick(both, int(rng.integers(28, 48))), ""),
    )
    benign = (
        lambda: ("", pick(num, int(rng.integers(16, 20))), ""),
        lambda: (pick(low, 6) + "." + pick(num, 2) + "@", "mail" + pick(num, 1) + ".example.com", ""),
        lambda: ("", pick(low, int(rng.integers(3, 8))) + "." + pick(num, 2) + "-" + pick(low, 10), ""),
        lambda: ("", "-".join((pick(num, 4), pick(num, 2), pick(num, 2))) + "-" + word() + "-" + word(), ""),
        lambda: ("https://", word() + ".example.org/" + word() + "/" + word() + "/" + pick(num, 4), ""),
        lambda: ("", "_".join(word() for _ in range(4)) + pick(num, 1), ""),
        lambda: ("", word() * 3 + word() + word() + pick(num, 2), ""),
        lambda: ("", "=" * 12 + "-" * 8 + pick(num, 1), ""),
        lambda: ("", ".".join(pick(num, 3) for _ in range(5)), ""),
    )
    out, y = [], np.zeros(n)
    for k in range(n):
        y[k] = k % 2
        kinds = secrets if k % 2 else benign
        before, body, after = kinds[int(rng.integers(0, len(kinds)))]()
        if len(body) < 16:
            body += "-" + pick(low, 16 - len(body))
        head = prose() + " " + before
        out.append((head + body + after + " " + prose(), len(head), len(head) + len(body)))
    return out, y


def examples(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    found, y = labelled_findings(n, seed)
    return np.stack([windows(t, [(a, b)])[0][0] for t, a, b in found]), y


LABELLED = "x binary, y int, held boolean"


def labelled(docs: DataFrame) -> DataFrame:
    """(x, y, held): the distinct windows of the candidates of all documents, with the rules' labels."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = dense(docs.where(F.col("text").isNotNull()).select((F.pmod(F.crc32(key.cast("binary")), F.lit(4)) == 2).alias("held"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, text in zip(*(c.to_pylist() for c in batch.columns)):
                runs = token_runs(text)
                base = base_findings(text, runs)
                spans = [(a, b) for a, _, b in base] + candidates(text, runs, base)
                if not spans:
                    continue
                x, owner = windows(text, spans)
                first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                y = (owner[first] < len(base)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x[first]], pa.binary()), pa.array(y), pa.array([held] * len(y))], names=["x", "y", "held"])

    return rows.mapInArrow(run, LABELLED).distinct()


def stacked(x: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(x), np.uint8).reshape(-1, WIDTH)


def trained_round(rows: DataFrame, blocks: int, net: Network, weight: dict[int, float], turn: int) -> np.ndarray:
    """The mean of the parameters that the blocks of rows (block, x, y) reach from the network's own. It is
    a sum of whole numbers, which no order of rows or blocks changes."""
    start, one = net.flat(), 1 << 40

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["x", "y"])
        own = examples(N_TRAIN, 1)
        y = pdf["y"].to_numpy(np.int64)
        part = Network()
        part.put(start)
        w = np.concatenate([np.ones(N_TRAIN), np.array([weight[k] for k in y.tolist()])])
        part.train(np.concatenate([own[0], stacked(pdf["x"])]), np.concatenate([own[1], y]), w, EPOCHS, seed=11 + turn)
        return pd.DataFrame({"at": np.arange(len(start)), "v": np.rint(part.flat() * one).astype(np.int64)})

    done = rows.repartition(blocks, "block").groupBy("block").applyInPandas(run, "at long, v long")  # small rows, long work: no task gets them all
    got = done.groupBy("at").agg(F.sum("v").alias("v"), F.count("*").alias("n")).orderBy("at").toArrow()
    return got["v"].to_numpy() / got["n"].to_numpy() / one


def score_counts(rows: DataFrame, net: Network) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, labels, counts) of all rows (x, y): as many as there are scores, at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = net.logits(stacked(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(z), batch.column(1)], names=["z", "y"])

    got = rows.select("x", "y").mapInArrow(run, "z double, y int").groupBy("z", "y").agg(F.count("*").alias("n")).orderBy("y", "z").toArrow()
    return got["z"].to_numpy(), got["y"].to_numpy().astype(float), got["n"].to_numpy().astype(float)


def plain_scores(net: Network, x: np.ndarray, y: np.ndarray) -> Scores:
    return net.logits(x), y, np.ones(len(y)), np.ones(len(y))


def fitted(x: np.ndarray, y: np.ndarray, held: np.ndarray, n_train: int = N_TRAIN, n_calibrate: int = N_CALIBRATE) -> Network:
    """A network trained and calibrated on generated findings and a few labelled ones, without Spark."""
    net = Network()
    own = examples(n_train, 1)
    net.train(np.concatenate([own[0], x[~held]]), np.concatenate([own[1], y[~held]]))
    net.calibrate([plain_scores(net, *examples(n_calibrate, 2)), plain_scores(net, x[held], y[held])])
    return net


def fit(docs: DataFrame) -> Network:
    """A network trained and calibrated on the candidates of all documents and on generated findings."""
    rows = labelled(docs).persist(StorageLevel.DISK_ONLY)
    n = {(r.y, r.held): r.n for r in rows.groupBy("y", "held").agg(F.count("*").alias("n")).collect()}
    ours = sum(k for (_, held), k in n.items() if not held)
    if not ours:
        net = fitted(stacked([]), np.zeros(0), np.zeros(0, bool))
    else:
        blocks = -(-ours // BLOCK_ROWS)
        share = {y: min(1.0, LABEL_WEIGHT / max(1, n.get((y, False), 0) + n.get((y, True), 0))) for y in (0, 1)}
        dealt = rows.where("not held").withColumn("block", F.pmod(F.xxhash64("x"), F.lit(blocks)))
        net = Network()
        for turn in range(ROUNDS):
            net.put(trained_round(dealt, blocks, net, {y: blocks * s for y, s in share.items()}, turn))
        z, y, count = score_counts(rows.where("held"), net)
        net.calibrate([plain_scores(net, *examples(N_CALIBRATE, 2)), (z, y, count, np.where(y == 1, share[1], share[0]))])
    rows.unpersist()
    return net


def scan_texts(texts: list[str], net: Network) -> tuple[list[list[tuple[int, int, int]]], list[int]]:
    """All findings (start, kind, end) of each text, sorted, and how many of its base findings the
    network finds as well."""
    found, asked, rows, owners = [], [], [], []
    for k, text in enumerate(texts):
        runs = token_runs(text)
        base = base_findings(text, runs)
        found.append(base)
        spans = [(a, b, True) for a, _, b in base] + [(a, b, False) for a, b in candidates(text, runs, base)]
        if spans:
            x, owner = windows(text, [(a, b) for a, b, _ in spans])
            rows.append(x)
            owners.append(owner + len(asked))
            asked += [(k, *s) for s in spans]
    confirmed = [0] * len(texts)
    more: list[list] = [[] for _ in texts]
    if asked:
        best = np.zeros(len(asked))
        np.maximum.at(best, np.concatenate(owners), net.probability(np.concatenate(rows)))
        for (k, a, b, known), p in zip(asked, best):
            if p >= net.threshold:
                if known:
                    confirmed[k] += 1
                else:
                    more[k].append((a, 3, b))
    return [sorted(f + m) for f, m in zip(found, more)], confirmed


def listed(findings: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in findings)


FOUND = "array<struct<start:long,kind:string,stop:long>>"


def find_secrets(spark: SparkSession, docs: DataFrame, net: Network | None = None) -> DataFrame:
    """(doc_id, findings, n_confirmed), findings an array of (start, kind, stop) by start, then kind as
    listed."""
    shared = spark.sparkContext.broadcast(net or fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("stop", pa.int64())]))
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                found, confirmed = scan_texts([t or "" for t in part.column(1).to_pylist()], shared.value)
                rows = [[{"start": a, "kind": KINDS[k], "stop": b} for a, k, b in f] for f in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind), pa.array(confirmed, pa.int64())], names=["doc_id", "findings", "n_confirmed"])

    narrow = dense(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return narrow.mapInArrow(run, f"doc_id long, findings {FOUND}, n_confirmed long")


def report(spark: SparkSession, docs: DataFrame, net: Network | None = None) -> DataFrame:
    """Counts, the digest of the base findings, and the list of all findings, per document."""
    found = find_secrets(spark, docs, net)
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))
    base = F.filter("findings", lambda x: x["kind"] != "model")
    n = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(F.concat_ws(",", F.transform(base, one)), 256).alias("base_sha256"), F.concat_ws(",", F.transform("findings", one)).alias("spans"), n("model"), "n_confirmed")


def redacted(text: str | None, findings: list[tuple[int, int]]) -> str | None:
    """The text with each finding, or run of overlapping findings, replaced by a mark."""
    if not findings or text is None:
        return text
    out, at = [], 0
    joined: list[list[int]] = []
    for a, b in sorted(findings):
        if joined and a < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    for a, b in joined:
        out += [text[at:a], "[SECRET]"]
        at = b
    return "".join([*out, text[at:]])


def redact(spark: SparkSession, docs: DataFrame, net: Network | None = None) -> DataFrame:
    """docs with findings replaced in the text; every row and column stays, and a column n_chars, where
    there is one, follows the text."""
    net = spark.sparkContext.broadcast(net or fit(docs))
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                texts = part.column(at).to_pylist()
                found, _ = scan_texts([t or "" for t in texts], net.value)
                if not any(found):
                    yield part
                    continue
                new = [redacted(t, [(a, b) for a, _, b in f]) for t, f in zip(texts, found)]
                cols = list(part.columns)
                cols[at] = pa.array(new, part.schema.field(at).type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    old = cols[k].to_pylist()
                    cols[k] = pa.array([len(t) if f and t is not None else o for t, f, o in zip(new, found, old)], part.schema.field(k).type)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return dense(docs).mapInArrow(run, docs.schema)
