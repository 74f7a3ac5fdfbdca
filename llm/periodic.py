"""Periodic runs of words by a dictionary of basic factors.

For every power of two, equal factors (stretches of so many words) of a text share a name,
given from the names of their halves. Two occurrences of a factor less than twice its length
apart propose their distance as a period. Where a factor occurs three times or more in that
reach, its occurrences form an arithmetic progression, of which all but the first can only begin a run where
the progression's own run begins. Proposals that no left neighbour continues are extended to
the right by the names, from the longest factors down, and equal stretches keep the smallest period.

Texts are named many at a time, each with its own names, so the work is in sorts of whole arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from llm.common import map_texts, trimmed, word_array

#: Words of the shortest run, and how often it holds its period at least.
LEAST, TIMES = 12, 2
#: Characters of the texts that are named at one time (one text at least).
AT_ONCE = 1_000_000


def _named(keys: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``at`` of keys that occur twice or more, by key and position, and their names.

    ``keys`` are under 2 ** (63 - bits), positions under 2 ** bits.
    """
    both = np.sort((keys << bits) | at)
    key = both >> bits
    change = np.flatnonzero(key[1:] != key[:-1]) + 1
    begins = np.concatenate([[0], change])
    sizes = np.diff(np.concatenate([begins, [len(key)]]))
    often = np.repeat(sizes > 1, sizes)
    names = np.repeat(np.cumsum(sizes > 1) - 1, sizes)
    return (both & ((1 << bits) - 1))[often], names[often]


def find_runs(words: np.ndarray, owner: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in a sequence of word numbers, by start, then period.

    ``owner`` numbers the texts that follow each other in the sequence; no run crosses a text.
    ``words`` and ``owner`` are non-negative, and the product of their ranges is under 2 ** 63.
    """
    n = len(words)
    none = (np.empty(0, np.int64),) * 3
    if n < least:
        return none
    bits = max(1, int(n).bit_length())
    keys = owner.astype(np.int64) * (int(words.max()) + 1) + words
    if int(keys.max()) >> (62 - bits):
        keys = np.unique(keys, return_inverse=True)[1].astype(np.int64)
    raw = keys
    pos, names = _named(keys, np.arange(n, dtype=np.int64), bits)
    levels: list[np.ndarray] = []
    starts, periods = [], []
    length = 1
    while len(pos):
        dense = np.full(n, -1, np.int32)
        dense[pos] = names
        levels.append(dense)
        # Occurrences whose next one is near enough to reach a distance of length to twice that.
        near = np.flatnonzero((names[1:] == names[:-1]) & (pos[1:] - pos[:-1] < 2 * length))
        if len(near):
            wide = n + 2 * length
            places = names * wide + pos
            low = np.searchsorted(places, places[near] + length)
            high = np.searchsorted(places, places[near] + 2 * length)
            met = high > low
            near, low, count = near[met], low[met], (high - low)[met]
            first = pos[near]
            starts.append(first)
            periods.append(pos[low] - first)
            two = count == 2
            starts.append(first[two])
            periods.append(pos[low[two] + 1] - first[two])
            many = np.flatnonzero(count > 2)
            if len(many):
                step = pos[low[many] + 1] - pos[low[many]]
                at = first[many]
                begins = (at == 0) | (raw[at - 1] != raw[np.maximum(at - 1 + step, 0)])
                many = many[begins]
                rest = count[many] - 1
                which = np.repeat(many, rest)
                nth = np.arange(rest.sum()) - np.repeat(np.cumsum(rest) - rest, rest) + 1
                starts.append(first[which])
                periods.append(pos[low[which] + nth] - first[which])
        # Names of factors twice as long: pairs of names, both of which occur again.
        whole = pos[pos + length < n]
        left, right = dense[whole].astype(np.int64), dense[np.minimum(whole + length, n - 1)].astype(np.int64)
        both = right >= 0
        whole, pairs = whole[both], left[both] * (len(pos) + 1) + right[both]
        if not len(whole):
            break
        if int(pairs.max()) >> (62 - bits):
            pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        pos, names = _named(pairs, whole, bits)
        length *= 2
    if not starts:
        return none
    start, period = np.concatenate(starts), np.concatenate(periods)
    # A run has no left neighbour that keeps its period.
    opens = (start == 0) | (raw[np.maximum(start - 1, 0)] != raw[start - 1 + period])
    start, period = start[opens], period[opens]
    same = np.zeros(len(start), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = start + same, start + period + same
        inside = j < n
        i, j = np.minimum(i, n - 1), np.minimum(j, n - 1)
        alike = inside & (levels[k][i] >= 0) & (levels[k][i] == levels[k][j])
        same[alike] += 1 << k
    total = same + period
    long = total >= np.maximum(least, times * period)
    start, total, period = start[long], total[long], period[long]
    order = np.lexsort((period, total, start))
    start, total, period = start[order], total[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (total[1:] != total[:-1])
    start, total, period = start[fresh], total[fresh], period[fresh]
    order = np.lexsort((period, start))
    return start[order], total[order], period[order]


def _batches(texts: list[str | None]):
    """Words of each text, in groups of at most ``AT_ONCE`` characters."""
    group, held = [], 0
    for t in texts:
        # Splitting bytes parts words at just the six ASCII space characters.
        if group and held + len(t or "") > AT_ONCE:
            yield group
            group, held = [], 0
        group.append((t or "").encode("utf-8", "surrogatepass").split())
        held += len(t or "")
    if group:
        yield group


def collapsed_texts(group: list[list[bytes]]) -> list[tuple[list[tuple[int, int, int]], str]]:
    """Runs and collapsed text of each text of a group."""
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(w) for w in group], np.int64)
    at = np.fromiter((numbers.setdefault(w, len(numbers)) for words in group for w in words), np.int64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    start, length, period = find_runs(at, np.repeat(np.arange(len(group)), sizes))
    owner = np.searchsorted(first, start, side="right") - 1
    cut = np.searchsorted(owner, np.arange(len(group) + 1))
    out = []
    for k, words in enumerate(group):
        low, high = cut[k], cut[k + 1]
        if low == high:
            out.append(([], b" ".join(words).decode("utf-8", "surrogatepass")))
            continue
        s, n, p = start[low:high] - first[k], length[low:high], period[low:high]
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, s + p, 1)
        np.add.at(edge, s + n, -1)
        kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
        text = b" ".join([words[i] for i in kept.tolist()]).decode("utf-8", "surrogatepass")
        out.append((list(zip(s.tolist(), n.tolist(), p.tolist())), text))
    return out


RUNS = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))


def collapse_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` with ``runs`` (start, length, period by start, then period) and ``collapsed``.

    A run is a stretch of consecutive words that repeats with its smallest period, at least
    ``LEAST`` words and ``TIMES`` periods long, that no neighbouring word continues. ``collapsed``
    is the text without the words that a run holds after its first period, joined by single spaces.
    Null, empty and blank texts have no runs and collapse to the empty text. Very long texts are
    taken alone and whole. Repeated rows are rows of their own; an empty table gives no rows;
    columns of ``docs`` named like the new ones must not be in ``keep``; others are not read.
    """
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def compute():
        def run(texts):
            runs, out = [], []
            for group in _batches(texts):
                for own, collapsed in collapsed_texts(group):
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                    out.append(collapsed)
            return [pa.array(runs, kind), pa.array(out, pa.string())]

        return run

    return map_texts(docs, text, [StructField("runs", RUNS), StructField("collapsed", StringType())], compute, keep or ["doc_id"])


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where about a tenth of the texts repeat a stretch of theirs up to their end.

    With h the crc32 of the decimal doc_id and g a tenth of it: if h % 10 is 0, each word from
    a = g % n on is word a + (i - a) % p, where p = 1 + (n - a) / (3 + g % 8). A null doc_id has no
    crc32, so its text stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = word_array(trimmed(F.col("text")))
    n = F.size("_words")
    a, g = F.col("_a"), F.col("_g")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    own = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"), F.floor(h / 10).alias("_g"))
    own = own.withColumn("_a", F.when(n > 0, F.pmod(g, n)).cast("int"))
    head = F.slice("_words", 1, F.col("_a"))
    once = F.slice("_words", F.col("_a") + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(once, times)), 1, n - a)
    made = F.array_join(F.concat(head, tail), " ")
    return own.select("doc_id", F.when(F.col("_words").isNotNull() & (n > 0), made).otherwise(F.col("text")).alias("text"))


def _text(row: Column, *names: str) -> Column:
    return F.concat_ws(",", *[row[c].cast("string") for c in names])


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the collapsed text.

    Ties for the longest run go to the smallest start, then period. Cases as in ``collapse_runs``.
    """
    found = collapse_runs(with_planted_runs(docs))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(_text(r, "start", "length", "period"), F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("_top"), lines.alias("_lines"), "collapsed")
    top = F.col("_top")
    return out.select(
        "doc_id", "n_runs", (-top["start"]).alias("start"), top["length"].alias("length"), (-top["period"]).alias("period"),
        F.floor(1000 * top["length"] / -top["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.col("_lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
