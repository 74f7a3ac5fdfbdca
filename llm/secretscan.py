"""Secret scans: base patterns, and a character convolutional network over every other candidate.

Every run of token characters is a candidate. The network reads its characters and those
around it: embeddings, a convolution, the maximum over all places, and two dense layers, in
numpy over Arrow batches. Candidates that a base pattern covers are findings labelled as secrets,
the others as none. The network learns from all distinct findings, four fifths of them, and from made-up
ones of known shapes: every task learns from its part, the parts' weights are averaged, and so on for
``ROUNDS`` rounds. Its probabilities are calibrated on the fifth that is kept apart, where each kind's
threshold is the greatest that recalls ``RECALL`` of that kind.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StringType, StructField, StructType

from bankmart.sources import stage
from llm.common import map_texts

#: Kinds of spans; the last is the network's.
KINDS = ("assign", "access", "hex", "cnn")
#: Classes of candidates that no base pattern covers: letters alone, capitals alone, all others, made-up ones.
HARMLESS = ("word", "shout", "mixed", "named")
#: Base patterns and least lengths. Fixed values.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12
_HINTS = ("passw", "secret", "token", "apikey", "api_key")
#: A candidate: a whole run of such characters, with closing marks of base64.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]{12,}={0,2}")
#: Characters before and after a candidate that the network reads.
BEFORE, AFTER = 16, 8
#: One of so many findings is kept apart for calibration.
APART = 5
#: Findings that one task learns from, rounds of learning and averaging, and passes of a task over its
#: findings in a round: so many passes as make ``WORK`` findings, ``PASSES`` at most, one at least.
PART, ROUNDS, WORK, PASSES = 50_000, 3, 60_000, 6
#: Made-up findings, secret and not, of shapes that issuers publish.
MADE = 4_000
RECALL = 0.95
#: Network: characters at one time, embedding, width and number of filters, hidden units.
SPAN, EMBED, WIDTH, FILTERS, HIDDEN = 56, 8, 5, 24, 12
BATCH, LEAST, RATE = 128, 4, 0.004
#: Rows of ``SPAN`` whose gradient is taken at one time, and cells of the logit per unit in the histogram.
ROWS_AT_ONCE, CELLS = 2_048, 1_000
OTHER_LETTER, OTHER, PAD = 128, 129, 130
ROLES = 3
_CUT = "\0"

#: Prefix, alphabet and number of characters of tokens as issuers document them. Fixed values.
SECRET_SHAPES = [
    ("ghp_", string.ascii_letters + string.digits, 36), ("glpat-", string.ascii_letters + string.digits, 20), ("sk_live_", string.ascii_letters + string.digits, 24),
    ("xoxb-", string.digits + string.ascii_letters, 40), ("AIza", string.ascii_letters + string.digits + "-_", 35), ("SG.", string.ascii_letters + string.digits + "-_", 43),
    ("eyJ", string.ascii_letters + string.digits + "-_", 60), ("", string.ascii_letters + string.digits + "+/", 40), ("", string.hexdigits[:16], 32), ("", string.ascii_letters + string.digits, 24),
]
#: What stands before a value in settings, and in prose. Fixed values.
LEADS = ["key: ", "auth=", "credential = \"", "export KEY=", "Authorization: Bearer ", "pwd:", "", "is ", "the ", "with "]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns' spans, in that order."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def findings(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """(start, end, kind number or -1, reading) of every candidate; of several base kinds the first."""
    out, open_spans, k = [], [], 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while k < len(base) and base[k][0] < end:
            open_spans.append(base[k])
            k += 1
        open_spans = [s for s in open_spans if s[2] > start]
        kinds = [kind for _, kind, _ in open_spans]
        before, after = text[max(0, start - BEFORE) : start], text[end : end + AFTER]
        out.append((start, end, min(kinds, default=-1), _CUT.join((before.replace(_CUT, " "), m[0], after.replace(_CUT, " ")))))
    return out


def _class(kind: int, reading: str) -> str:
    """Class of a finding for sampling and weights: its kind, or what a candidate is made of."""
    if kind >= 0:
        return KINDS[kind]
    value = reading.split(_CUT)[1]
    return "mixed" if not value.isalpha() else "shout" if value.isupper() else "word"


def made_findings(count: int = MADE, seed: int = 12) -> list[tuple[str, str]]:
    """(reading, class) of made-up findings: random tokens of known shapes, and names, addresses, versions, paths."""
    rng = np.random.default_rng(seed)

    def some(alphabet: str, n: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    def word() -> str:
        return some(string.ascii_lowercase, int(rng.integers(3, 9)))

    def harmless(kind: int) -> str:
        if kind == 0:
            return "_".join(word() for _ in range(3))
        if kind == 1:
            return "/".join(word() for _ in range(3)) + "." + some(string.ascii_lowercase, 2)
        if kind == 2:
            return ".".join((word(), word() + str(rng.integers(0, 99)), "com"))
        if kind == 3:
            return "2" + "-".join((some(string.digits, 3), some(string.digits, 2), some(string.digits, 2) + "T" + some(string.digits, 2)))
        if kind == 4:
            return ".".join(some(string.digits, 3) for _ in range(4))
        return "".join(word().capitalize() for _ in range(3))

    out = []
    for i in range(count):
        secret = i % 2 == 0
        prefix, alphabet, n = SECRET_SHAPES[i // 2 % len(SECRET_SHAPES)]
        value = prefix + some(alphabet, n) if secret else harmless(i // 2 % 6)
        lead = LEADS[int(rng.integers(0, len(LEADS)))]
        before = f"{word()} {word()} {lead}"[-BEFORE:]
        out.append((_CUT.join((before, value, f" {word()} {word()}"[:AFTER])), "made" if secret else "named"))
    return out


_TABLE = np.arange(PAD + 1, dtype=np.uint8)


def _characters(reading: str) -> tuple[np.ndarray, np.ndarray]:
    """Character and role numbers (before, inside, after) of a reading, of any length."""
    parts = reading.split(_CUT)
    text = "".join(parts)
    if text.isascii():
        chars = np.frombuffer(text.encode(), np.uint8)
    else:
        chars = np.array([ord(c) if c < "\x80" else OTHER_LETTER if c.isalpha() else OTHER for c in text], np.uint8)
    return chars, np.repeat(np.arange(ROLES, dtype=np.uint8), [len(p) for p in parts])


def encoded(readings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character and role numbers in rows of ``SPAN``, and the first row of each reading.

    Long readings take several rows which overlap so that each place of the convolution occurs once.
    """
    step = SPAN - WIDTH + 1
    pairs = [_characters(r) for r in readings]
    rows = np.array([max(1, -(-(len(c) - WIDTH + 1) // step)) for c, _ in pairs], np.int64)
    first = np.cumsum(rows) - rows
    chars = np.full((int(rows.sum()), SPAN), PAD, np.uint8)
    roles = np.zeros((int(rows.sum()), SPAN), np.uint8)
    for at, n, (c, r) in zip(first.tolist(), rows.tolist(), pairs):
        for k in range(n):
            own = c[k * step : k * step + SPAN]
            chars[at + k, : len(own)] = own
            roles[at + k, : len(own)] = r[k * step : k * step + SPAN]
    return chars, roles, first


@dataclass
class Network:
    """Weights, calibration (slope and shift of the logit) and threshold; without findings it says nothing.

    ``learned`` and ``held`` are the numbers of findings it learned from in each pass and was calibrated on.
    """

    weights: list[np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0
    learned: int = 0
    held: int = 0

    @classmethod
    def fresh(cls, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        shapes = [(PAD + 1, EMBED), (WIDTH * (EMBED + ROLES), FILTERS), (FILTERS,), (FILTERS, HIDDEN), (HIDDEN,), (HIDDEN, 1), (1,)]
        scales = [0.5, *[(2 / s[0]) ** 0.5 if len(s) == 2 else 0.0 for s in shapes[1:]]]
        return cls([(rng.standard_normal(s) * k).astype(np.float32) for s, k in zip(shapes, scales)])

    def columns(self, chars: np.ndarray, roles: np.ndarray) -> np.ndarray:
        """Inputs of each place of the convolution: rows, places, width times channels."""
        x = np.concatenate([self.weights[0][chars], np.eye(ROLES, dtype=np.float32)[roles]], axis=2)
        places = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)
        return places.transpose(0, 1, 3, 2).reshape(len(chars), SPAN - WIDTH + 1, -1)

    def pooled(self, chars: np.ndarray, roles: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Greatest answer of each filter over all places of each reading."""
        rows = np.concatenate([
            (self.columns(chars[i : i + 256], roles[i : i + 256]) @ self.weights[1]).max(1) for i in range(0, len(chars), 256)
        ])
        return np.maximum(np.maximum.reduceat(rows, first, axis=0) + self.weights[2], 0)

    def logits(self, chars: np.ndarray, roles: np.ndarray, first: np.ndarray) -> np.ndarray:
        _, _, _, w, b, v, c = self.weights
        hidden = np.maximum(self.pooled(chars, roles, first) @ w + b, 0)
        return (hidden @ v + c)[:, 0]

    def probabilities(self, readings: list[str]) -> np.ndarray:
        if not readings:
            return np.empty(0)
        z = self.slope * self.logits(*encoded(readings)).astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))

    def gradients(self, chars: np.ndarray, roles: np.ndarray, first: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted logistic loss, by hand, from the places that the maximum chose."""
        e, f, bias, w, b, v, c = self.weights
        columns = self.columns(chars, roles)
        answers = columns @ f
        place = answers.argmax(1)
        best = np.take_along_axis(answers, place[:, None], 1)[:, 0]
        top = np.maximum.reduceat(best, first, axis=0)
        # The row of each reading that holds the maximum.
        owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(chars))))
        row = np.minimum.reduceat(np.where(best == top[owner], np.arange(len(chars))[:, None], len(chars)), first, axis=0)
        pool = np.maximum(top + bias, 0)
        h = np.maximum(pool @ w + b, 0)
        p = 1 / (1 + np.exp(-np.clip((h @ v + c)[:, 0], -35, 35)))
        dz = ((p - labels) * weight / weight.sum()).astype(np.float32)[:, None]
        dh = (dz @ v.T) * (h > 0)
        dp = (dh @ w.T) * (pool > 0)
        at = place[row, np.arange(FILTERS)]
        chosen = columns[row, at]
        df = np.einsum("nf,nfc->cf", dp, chosen)
        back = (dp[:, :, None] * f.T[None]).reshape(len(first), FILTERS, WIDTH, EMBED + ROLES)[..., :EMBED]
        ids = chars[row[:, :, None], at[:, :, None] + np.arange(WIDTH)]
        de = np.stack([np.bincount(ids.ravel(), back[..., d].ravel(), PAD + 1) for d in range(EMBED)], axis=1)
        return [de, df, dp.sum(0), pool.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0)]


def _calibrated(z: np.ndarray, labels: np.ndarray, count: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logit by Newton steps on softened labels; ``count`` findings stand at each logit."""
    high = count[labels > 0].sum()
    low = count.sum() - high
    goal = np.where(labels > 0, (high + 1) / (high + 2), 1 / (low + 2))
    x = np.stack([z, np.ones(len(z))], axis=1)
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -35, 35)))
        curve = (x * (count * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (count * (p - goal)))
        ab = ab - np.clip(step, -2, 2)
    return float(ab[0]), float(ab[1])


def portions(counts: dict[str, int]) -> dict[str, int]:
    """Findings of each class in a batch: ``LEAST``, and the rest of ``BATCH`` by their numbers."""
    rest, total = BATCH - LEAST * len(counts), sum(counts.values())
    return {c: LEAST + rest * n // total for c, n in counts.items()}


def batches(names: np.ndarray, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """One pass: places of the findings of each batch. Every finding occurs, those of rarer classes repeatedly."""
    own = {str(c): rng.permutation(np.flatnonzero(names == c)) for c in np.unique(names)}
    size = portions({c: len(x) for c, x in own.items()})
    for step in range(max(-(-len(x) // size[c]) for c, x in own.items())):
        yield np.concatenate([np.take(x, np.arange(step * size[c], (step + 1) * size[c]), mode="wrap") for c, x in own.items()])


def learn(weights: list[np.ndarray], sample: list[tuple[str, str]], turn: int) -> list[np.ndarray]:
    """Weights after round ``turn`` of learning from all (reading, class) findings of a part.

    In a batch secrets weigh as much as the rest, and the classes of each side weigh alike. A third of
    the secrets is shown without what is around them.
    """
    net = Network([w.copy() for w in weights])
    readings, names = [r for r, _ in sample], np.array([c for _, c in sample])
    labels = ~np.isin(names, HARMLESS)
    rng = np.random.default_rng(7 + turn)
    first, second = [np.zeros_like(x, np.float64) for x in net.weights], [np.zeros_like(x, np.float64) for x in net.weights]
    passes = max(1, min(PASSES, WORK // len(sample)))
    step = 0
    for k in range(passes):
        for own in batches(names, rng):
            step += 1
            rate = RATE * (1 - (turn + k / passes) / ROUNDS) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            bare = labels[own] & (rng.random(len(own)) < 1 / 3)
            shown = [f" {_CUT}{readings[i].split(_CUT)[1]}{_CUT} " if b else readings[i] for i, b in zip(own, bare)]
            for j, g in enumerate(_gradients(net, shown, labels[own].astype(np.float32), _weights(names[own], labels[own]))):
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                net.weights[j] = (net.weights[j] - rate * first[j] / (np.sqrt(second[j]) + 1e-8)).astype(np.float32)
    return net.weights


def _weights(names: np.ndarray, labels: np.ndarray) -> np.ndarray:
    out = np.empty(len(names), np.float32)
    for side in (True, False):
        classes = np.unique(names[labels == side])
        for c in classes:
            out[names == c] = 1 / (len(classes) * (names == c).sum())
    return out


def _gradients(net: Network, readings: list[str], labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Of a batch, in parts where long readings take many rows."""
    chars, roles, first = encoded(readings)
    ends = np.append(first, len(chars))[1:]
    out, at = [np.zeros(w.shape) for w in net.weights], 0
    while at < len(readings):
        to = max(at + 1, int(np.searchsorted(ends, first[at] + ROWS_AT_ONCE, side="right")))
        rows = slice(first[at], ends[to - 1])
        part = net.gradients(chars[rows], roles[rows], first[at:to] - first[at], labels[at:to], weight[at:to])
        share = weight[at:to].sum() / weight.sum()
        out, at = [o + share * g for o, g in zip(out, part)], to
    return out


def thresholds(p: np.ndarray, names: np.ndarray, secret: np.ndarray, count: np.ndarray | None = None) -> dict[str, float]:
    """Per class of secrets the greatest threshold that recalls ``RECALL`` of them; ``count`` of them stand at each."""
    out = {}
    count = np.ones(len(p), np.int64) if count is None else count
    for name in sorted(set(names[secret])):
        own = np.flatnonzero(secret & (names == name))
        own = own[np.argsort(p[own])]
        upto = np.cumsum(count[own])
        out[name] = float(p[own[np.searchsorted(upto, int((1 - RECALL) * upto[-1] + 1e-9), side="right")]])
    return out


FOUND = ArrayType(StructType([StructField("start", IntegerType()), StructField("kind", IntegerType()), StructField("end", IntegerType())]))
CANDIDATES = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("kind", IntegerType()), StructField("class", StringType()), StructField("reading", StringType())]))


def extract(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Columns ``keep``, ``base`` spans and ``candidates`` of whole texts."""
    span = pa.list_(pa.struct([(c, pa.int32()) for c in ("start", "kind", "end")]))
    candidate = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("class", pa.string()), ("reading", pa.string())]))

    def compute():
        def run(texts):
            spans, found = [], []
            for t in texts:
                base = base_spans(t or "")
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                found.append([{"start": s, "end": e, "kind": k, "class": _class(k, r), "reading": r} for s, e, k, r in findings(t or "", base)])
            return [pa.array(spans, span), pa.array(found, candidate)]

        return run

    return map_texts(docs, text, [StructField("base", FOUND), StructField("candidates", CANDIDATES)], compute, keep)


def _round(known: DataFrame, parts: int, net: Network, made: list[tuple[str, str]], turn: int) -> Network:
    """All parts learn from the same weights; the mean of theirs, by their numbers of findings."""
    shapes = [w.shape for w in net.weights]
    weights = net.weights

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [(r, c) for b in rows for r, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        if sample:
            flat = np.concatenate([w.ravel() for w in learn(weights, sample + made, turn)]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([len(sample)], pa.int64()), pa.array([flat], pa.list_(pa.float64()))], names=["n", "weights"])

    dealt = known.repartition(parts, "reading").sortWithinPartitions(F.xxhash64("reading"), "reading")
    learned = dealt.mapInArrow(run, "n long, weights array<double>").select("n", F.posexplode("weights").alias("place", "weight"))
    # Sums of decimals do not depend on the order of the parts.
    total = F.sum((F.col("weight") * F.col("n")).cast("decimal(38,12)")).cast("double")
    mean = learned.groupBy("place").agg((total / F.sum("n")).alias("weight"), F.sum("n").alias("n")).orderBy("place").collect()
    if not mean:
        return net
    flat = np.array([r.weight for r in mean], np.float32)
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    return Network([w.reshape(s) for w, s in zip(np.split(flat, cuts), shapes)], learned=mean[0].n + len(made))


def _cells(z: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(z, -40, 40).astype(np.float64) * CELLS).astype(np.int32)


def fit(extracted: DataFrame) -> Network:
    """Learns from all distinct findings and from made-up ones, one in ``APART`` of which calibrates.

    Findings are dealt by hash into parts of about ``PART``, each learned in one task. Of them the driver
    gets averaged weights and a histogram of the logits of those kept apart, both of bounded size.
    """
    seen = extracted.select(F.explode("candidates").alias("c")).select("c.reading", "c.class")
    # A reading that is a secret somewhere counts as one.
    marked = F.when(F.col("class").isin(*HARMLESS), F.concat(F.lit("~"), "class")).otherwise(F.col("class"))
    known = seen.groupBy("reading").agg(F.ltrim(F.min(marked), F.lit("~")).alias("class"))
    apart = F.pmod(F.xxhash64(F.lit("apart"), "reading"), F.lit(APART)) == 0
    known = stage(known.withColumn("apart", apart), "secret-findings", compression="zstd")
    learning, held = known.where("NOT apart").select("reading", "class"), known.where("apart").select("reading", "class")
    n = learning.count()
    net = Network.fresh()
    if not n and held.isEmpty():
        return net
    made, made_apart, times = [], [], {}
    for reading, name in made_findings():
        times[name] = times.get(name, 0) + 1
        (made if times[name] % APART else made_apart).append((reading, name))
    for turn in range(ROUNDS):
        net = _round(learning, -(-n // PART) or 1, net, made, turn)

    def logits(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for at in range(0, b.num_rows, 200):
                own = b.slice(at, 200)
                cells = _cells(net.logits(*encoded(own.column(0).to_pylist())))
                yield pa.RecordBatch.from_arrays([own.column(1), pa.array(cells, pa.int32())], names=["class", "cell"])

    seen_cells = held.mapInArrow(logits, "class string, cell int").groupBy("class", "cell").agg(F.count("*").alias("n")).orderBy("class", "cell").collect()
    own = [(r["class"], r.cell, r.n) for r in seen_cells]
    own += [(c, int(x), 1) for (_, c), x in zip(made_apart, _cells(net.logits(*encoded([r for r, _ in made_apart]))))]
    names, z, count = np.array([c for c, _, _ in own]), np.array([x for _, x, _ in own]) / CELLS, np.array([n for _, _, n in own], np.int64)
    labels = ~np.isin(names, HARMLESS)
    net.slope, net.shift = _calibrated(z, labels.astype(float), count)
    p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -35, 35)))
    net.threshold = min(thresholds(p, names, labels, count).values())
    net.held = int(count.sum())
    return net


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` and ``spans`` of each whole text: start, kind (number in ``KINDS``), end.

    Starts and ends are code points; spans are in order of start, then kind. Base spans always
    stay; the network adds candidates that no base span touches and whose probability reaches the
    threshold. Null and empty texts have no spans; very long texts and candidates are read whole;
    repeated rows get equal answers; without any candidate the network adds nothing; an empty table gives no
    rows; columns of ``docs`` named spans, base or candidates must not be in ``keep``; others are not read.
    """
    keep = keep or ["doc_id"]
    extracted = stage(extract(docs, text, keep), "secret-candidates")
    net = fit(extracted)
    span = pa.list_(pa.struct([(c, pa.int32()) for c in ("start", "kind", "end")]))
    n = len(keep)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                base, found = rows.column(n).to_pylist(), rows.column(n + 1).to_pylist()
                asked = [(k, c) for k, own in enumerate(found) for c in own if c["kind"] < 0]
                for (k, c), p in zip(asked, net.probabilities([c["reading"] for _, c in asked])):
                    if p >= net.threshold:
                        base[k].append({"start": c["start"], "kind": KINDS.index("cnn"), "end": c["end"]})
                out = [sorted(own, key=lambda s: (s["start"], s["kind"])) for own in base]
                yield pa.RecordBatch.from_arrays([*rows.columns[:n], pa.array(out, span)], names=[*keep, "spans"])

    schema = StructType([*[extracted.schema[c] for c in keep], StructField("spans", FOUND)])
    return extracted.mapInArrow(judge, schema)


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans, n_added. Cases as in ``scan``."""
    found = scan(docs)
    names = F.array(*[F.lit(k) for k in KINDS])

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter(F.col("spans"), lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(F.col("spans"), lambda s: s["kind"] < KINDS.index("cnn"))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)], F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"), count(3).alias("n_added"),
    )
