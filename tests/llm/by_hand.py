"""Plain Python versions of what the queries and the pipeline compute, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from llm import quality, simhash, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


def tables(con, sf_dir, name, columns):
    return con.execute(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


def statistics(text):
    """Number of words, and of the other counts of the quality rules."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(runs)
    covered = {j for i, r in enumerate(runs) if seen[r] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_capitals": sum(c.isupper() for c in text), "n_marks": sum(c in "!?|=~^" for c in text),
    }


def robust_estimates(x):
    """Mean and inverse factor of least determinant from three starts, over all vectors of a group at once."""
    floors = np.array(list(quality.FLOORS.values()))
    n, p = x.shape
    ordered = np.sort(x, axis=0)
    low, mid, high = (ordered[math.ceil(q * n) - 1] for q in (0.25, 0.5, 0.75))
    scale = np.maximum((high - low) / 1.349, floors)
    z = (x - mid) / scale
    length = np.sqrt((z * z).sum(1, keepdims=True))
    limit = quality.chi_square_limit(quality.CORE, p)
    wider = quality.CORE / quality.chi_square(limit, p + 2)

    def estimate(mu, cover):
        factor = np.zeros((p, p))
        for j in range(p):
            factor[j, j] = math.sqrt(max(cover[j, j] - (factor[j, :j] ** 2).sum(), floors[j] ** 2 / 4))
            for i in range(j + 1, p):
                factor[i, j] = (cover[i, j] - (factor[i, :j] * factor[j, :j]).sum()) / factor[j, j]
        return 2 * np.log(np.diag(factor)).sum(), mu, np.linalg.inv(factor)

    def step(_, mu, w):
        d2 = (((x - mu) @ w.T) ** 2).sum(1)
        classes = np.floor(8 * np.log2(np.clip(d2, 1e-3, 1e12)))
        before = np.array([(classes < c).sum() for c in classes])
        core = x[before < quality.CORE * n]
        mean = core.mean(0)
        return estimate(mean, (core.T @ core / len(core) - np.outer(mean, mean)) * wider + np.diag(floors**2))

    found = []
    for y in (None, np.where(length > 0, z / np.where(length > 0, length, 1), 0), np.tanh(z)):
        alike = np.eye(p)
        if y is not None:
            q = y.T @ y
            size = np.sqrt(np.outer(np.diag(q), np.diag(q)))
            alike = np.where(size > 0, q / np.where(size > 0, size, 1), 0)
            np.fill_diagonal(alike, 1)
        own = estimate(mid, alike * np.outer(scale, scale))
        for _ in range(quality.STEPS):
            own = step(*own)
        found.append(own)
    best = min(found, key=lambda e: e[0])
    for _ in range(quality.MOST_STEPS):
        new = step(*best)
        if new[0] >= best[0] - quality.FALL:
            break
        best = new
    return best[1:]


def quality_verdicts(docs):
    """(base_failed, kept, distance) of each (doc_id, text, lang, source)."""
    stats = [statistics(d[1]) for d in docs]
    bad = [s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"] for s in stats]

    def vector(s):
        share = lambda a, b: math.sqrt(s[a] / max(1, s[b]))
        return [
            math.log((s["word_chars"] + 1) / (s["n_words"] + 1)), share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"),
            share("n_repeat_words", "n_words"), share("n_capitals", "word_chars"), share("n_marks", "word_chars"),
        ]

    x = np.array([vector(s) for s in stats])
    good = [i for i, b in enumerate(bad) if not b]
    own, wide = Counter(docs[i][2:4] for i in good), Counter(docs[i][2] for i in good)
    least = quality.LEAST_ROWS
    level = {g: g if own[g] >= least else g[0] if wide[g[0]] >= least else "all" for g in own}
    judges = {
        v: [i for i in good if v == "all" or v in (docs[i][2:4], docs[i][2])] for v in set(level.values())
    }
    cut = quality.chi_square_limit(1 - quality.TAIL, x.shape[1])
    out = [(b, not b, None) for b in bad]
    for v, rows in judges.items():
        if len(rows) >= least:
            mu, w = robust_estimates(x[rows])
            for i in good:
                if level[docs[i][2:4]] == v:
                    d2 = float((((x[i] - mu) @ w.T) ** 2).sum())
                    out[i] = (False, d2 <= cut, math.sqrt(d2))
    return out


def toxicity_score(model, text):
    """Score from a dictionary of weights, one feature at a time."""
    import xxhash

    bare = [t.strip("\"'()[]{}<>.,;:!?*#$%&|_-=~^/\\").lower() for t in (text or "").split()]
    word = [xxhash.xxh64_intdigest(b, seed=1) for b in bare]
    mix, down = [int(m) for m in toxicity._MIX], 64 - toxicity.BITS
    found = {(h * mix[0] & MASK) >> down for h in word}
    found |= {(xxhash.xxh64_intdigest(b[: toxicity.STEM], seed=2) * mix[1] & MASK) >> down for b in bare}
    for gap in (0, *toxicity.SKIPS):
        for a, b in zip(word, word[gap + 1 :]):
            found.add((a * mix[2 + (gap > 0)] + b * mix[gap % 2] & MASK) >> down)
    total = model.get(1 << toxicity.BITS, 0.0) + sum(model.get(f, 0.0) for f in found)
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, total))))


def components(docs):
    """(fingerprint, smallest doc_id reached) of each (doc_id, text, ...)."""
    prints = [simhash.fingerprint(d[1]) & MASK for d in docs]
    left, least = set(prints), {}
    smallest = defaultdict(lambda: math.inf)
    for d, f in zip(docs, prints):
        smallest[f] = min(smallest[f], d[0])
    while left:
        todo, group = [left.pop()], []
        while todo:
            x = todo.pop()
            group.append(x)
            near = {y for y in left if (x ^ y).bit_count() <= 3}
            left -= near
            todo += near
        for x in group:
            least[x] = min(smallest[y] for y in group)
    return [(f, least[f]) for f in prints]


def mix(docs):
    """(size, source_size, target, taken) of each (doc_id, text, lang, source)."""
    sizes = [len(WORD.findall(d[1] or "")) for d in docs]
    whole = Counter()
    for d, n in zip(docs, sizes):
        whole[d[3]] += n
    order = sorted((s for s in whole if s is not None)) + [None] * (None in whole)
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    full, target = set(), {}
    while True:
        left, shared = sum(whole.values()) - sum(3 * whole[s] for s in full), sum(weight[s] for s in order if s not in full)
        target = {s: 3 * whole[s] if s in full else left * weight[s] / shared for s in order}
        over = {s for s in order if target[s] > 3 * whole[s]}
        if not over:
            break
        full |= over
    begins, at = {}, Counter()
    for i in sorted(range(len(docs)), key=lambda i: (hashlib.md5(str(docs[i][0]).encode()).hexdigest(), sizes[i])):
        begins[i] = at[docs[i][3]]
        at[docs[i][3]] += sizes[i]
    out = []
    for i, d in enumerate(docs):
        goal = math.floor(round(target[d[3]], 6))
        taken = 0
        for k in range(3):
            low = begins[i] + k * whole[d[3]]
            taken += max(0, min(low + sizes[i], goal) - low)
        out.append((sizes[i], whole[d[3]], target[d[3]], taken))
    return out


def pieces(docs, tokenizer):
    """How often each (doc_id, piece, start, length, crc32) has to come out of packing."""
    model, out = Tokenizer.from_file(tokenizer), Counter()
    for d in docs:
        ids = model.encode(d[1] or "", add_special_tokens=False).ids + [1]
        for p, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            out[d[0], p, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


def gapless(rows):
    """Fails unless the sequences of packed rows are gapless and within 4096; their number."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    return len(bins)


def language_answers(learned, texts, least=3):
    """(language, score) of each text, trained on (text, lang) pairs: word first, then shorter n-grams."""
    letters = re.compile(r"[^\W\d_]+")

    def grams(word, n):
        padded = word if n == 1 else f" {word} "
        return [padded[i : i + n] for i in range(len(padded) - n + 1)]

    langs = sorted({lang for _, lang in learned})
    counts = {n: {lang: Counter() for lang in langs} for n in range(6)}
    for text, lang in learned:
        for word in letters.findall((text or "").lower()):
            counts[0][lang][word] += 1
            for n in range(1, 6):
                counts[n][lang].update(grams(word, n))
    size = {n: len({x for lang in langs for x in counts[n][lang]}) for n in counts}
    total = {n: {lang: sum(counts[n][lang].values()) for lang in langs} for n in counts}

    def logs(n, part):
        if sum(counts[n][lang][part] for lang in langs) < least:
            return None
        return [math.log((counts[n][lang][part] + 0.5) / (total[n][lang] + 0.5 * (size[n] + 1))) for lang in langs]

    def word_scores(word):
        own = logs(0, word)
        for n in (5, 4, 3, 2, 1):
            if own is None:
                known = [x for x in (logs(n, g) for g in grams(word, n)) if x]
                own = [sum(col) / len(known) for col in zip(*known)] if known else None
        return own or [0.0] * len(langs)

    seen = {}
    out = []
    for text in texts:
        words = letters.findall((text or "").lower())
        if not words:
            out.append(("und", 0.0))
            continue
        sums = [0.0] * len(langs)
        for w in words:
            if w not in seen:
                seen[w] = word_scores(w)
            sums = [a + b for a, b in zip(sums, seen[w])]
        sums = [x / math.sqrt(len(words)) for x in sums]
        best = max(range(len(langs)), key=lambda i: (sums[i], -i))
        out.append((langs[best], 1 / sum(math.exp(x - sums[best]) for x in sums)))
    return out
