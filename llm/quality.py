"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each document becomes a vector of transformed statistics. Centre and covariance of each
language and source come from the tightest part of its documents: of several starts the one whose
concentration steps reach the least covariance determinant, so junk does not widen the limits it is judged by. A
document is rejected if its Mahalanobis distance is beyond the chi-square limit.

Built-in SQL functions only. All statistics, estimates and verdicts cover all documents: the
steps shuffle one row per group, distance class and map task, never documents, so a source
with a third of all rows is summed where it lies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from bankmart.sources import stage
from llm.common import SPACE, free_name, trimmed, word_array

WINDOW = 8
#: Part of a group that its estimates come from.
CORE = 0.75
#: Documents that a group needs for estimates of its own; smaller ones go by wider groups.
LEAST_ROWS = 60
#: Concentration steps from each start, most steps from the best one, and by how much a determinant's logarithm falls to count.
STEPS, MOST_STEPS, FALL = 2, 12, 1e-4
#: Chance of a distance beyond the limit in normal data.
TAIL = 1e-3
#: Per statistic: least deviation, added to each variance so that a group at zero is not singular. A third to
#: a half of what one occurrence makes in a short text: a mark in 100 letters, a line in ten, a passage in 250 words.
FLOORS = {"word_length": 0.05, "symbols": 0.05, "dup_lines": 0.10, "repeats": 0.08, "capitals": 0.05, "marks": 0.05}
P = len(FLOORS)


def chi_square(x: float, degrees: int) -> float:
    """Distribution function of chi-square by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = degrees / 2, x / 2
    term = total = 1 / a
    k = 0
    while term > total * 1e-16:
        k += 1
        term *= half / (a + k)
        total += term
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a)))


def chi_square_limit(share: float, degrees: int) -> float:
    low, high = 0.0, 1e3
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, degrees) < share else (low, mid)
    return high


def _shifted(hashes: Column, by: int) -> Column:
    """Hashes of runs twice as long: each element with the one ``by`` places on."""
    n = F.greatest(F.size(hashes) - by, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, by + 1, n), lambda a, b: F.xxhash64(a, b))


def document_statistics(docs: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the struct ``out`` of base statistics of whole texts; a null text has no words."""
    steps = {k: free_name(docs, f"_{k}") for k in ("clean", "words", "h1", "h2", "h4", "h8", "places", "covered")}
    c = {k: F.col(f"`{v}`") for k, v in steps.items()}
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.withColumn(steps["clean"], trimmed(F.col(f"`{text}`")))
    df = df.withColumn(steps["words"], word_array(c["clean"]))
    df = df.withColumn(steps["h1"], F.transform(c["words"], lambda w: F.xxhash64(w)))
    for name, before, by in (("h2", "h1", 1), ("h4", "h2", 2), ("h8", "h4", 4)):
        df = df.withColumn(steps[name], _shifted(c[before], by))
    # Places of windows that occur again: equal neighbours after sorting. Most texts have none.
    n = F.size(c["h8"])
    tagged = F.array_sort(F.transform(c["h8"], lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    again = F.size(F.array_distinct(c["h8"])) < n
    df = df.withColumn(steps["places"], F.when(again, tagged))
    s = c["places"]
    before, after = F.slice(s, 1, n - 1), F.slice(s, 2, n - 1)
    pairs = F.filter(F.arrays_zip(before.alias("a"), after.alias("b")), lambda x: x["a"]["h"] == x["b"]["h"])
    found = F.concat(F.transform(pairs, lambda x: x["a"]["i"]), F.transform(pairs, lambda x: x["b"]["i"]))
    df = df.withColumn(steps["covered"], F.when(s.isNotNull(), F.array_sort(F.array_distinct(found))))
    at = c["covered"]
    gaps = F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    repeated = F.when(at.isNull(), F.lit(0)).otherwise(F.aggregate(gaps, F.lit(WINDOW), lambda x, y: x + y))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    df = df.withColumn(
        out,
        F.struct(
            F.size(c["words"]).cast("long").alias("n_words"),
            F.length(F.array_join(c["words"], "")).cast("long").alias("word_chars"),
            F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated.cast("long").alias("n_repeat_words"),
            F.regexp_count(body, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            F.regexp_count(body, F.lit("[!?|=~^]")).cast("long").alias("n_marks"),
        ),
    )
    return df.drop(*steps.values())


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def vector(s: Column) -> dict[str, Column]:
    """Transformed statistics: a logarithm for the length, square roots for shares."""
    def share(part: str, whole: str) -> Column:
        return F.sqrt(s[part] / F.greatest(s[whole], F.lit(1)))

    return {
        "word_length": F.log((s["word_chars"] + 1) / (s["n_words"] + 1)),
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "marks": share("n_marks", "word_chars"),
    }


def _group_of(docs: DataFrame, names: list[str]) -> Column:
    """Text key of a language and source; null and a text such as 'null' stay apart."""
    have = {c.lower() for c in docs.columns}
    return F.to_json(F.struct(*[(F.col(f"`{n}`") if n in have else F.lit(None)).cast("string").alias(n) for n in names]))


def distance_square(x: list[Column], mu: Column, w: Column) -> Column:
    """Squared length of the inverse Cholesky factor ``w`` (rows of a triangle) times x - mu."""
    centred = [x[j] - mu[j] for j in range(P)]
    total, k = F.lit(0.0), 0
    for i in range(P):
        row = F.lit(0.0)
        for j in range(i + 1):
            row = row + w[k + j] * centred[j]
        k += i + 1
        total = total + row * row
    return total


def _triangle(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i + 1)]


def _inverse_factor(df: DataFrame, keys: list[str]) -> DataFrame:
    """Columns ``a_i_j`` of a covariance to the array ``w``, inverse of its Cholesky factor, and the
    logarithm ``det`` of its determinant."""
    col = F.col
    for j in range(P):
        diagonal = col(f"a_{j}_{j}")
        for k in range(j):
            diagonal = diagonal - col(f"l_{j}_{k}") * col(f"l_{j}_{k}")
        df = df.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(diagonal, F.lit(list(FLOORS.values())[j] ** 2 / 4))))
        below = {}
        for i in range(j + 1, P):
            e = col(f"a_{i}_{j}")
            for k in range(j):
                e = e - col(f"l_{i}_{k}") * col(f"l_{j}_{k}")
            below[f"l_{i}_{j}"] = e / col(f"l_{j}_{j}")
        df = df.withColumns(below) if below else df
    for i in range(P):
        new = {f"w_{i}_{i}": 1 / col(f"l_{i}_{i}")}
        for j in range(i):
            e = col(f"l_{i}_{j}") * col(f"w_{j}_{j}")
            for k in range(j + 1, i):
                e = e + col(f"l_{i}_{k}") * col(f"w_{k}_{j}")
            new[f"w_{i}_{j}"] = -e / col(f"l_{i}_{i}")
        df = df.withColumns(new)
    det = F.lit(0.0)
    for i in range(P):
        det = det + 2 * F.log(f"l_{i}_{i}")
    return df.select(*keys, "mu", F.array(*[f"w_{i}_{j}" for i, j in _triangle(P)]).alias("w"), det.alias("det"))


def starts(rows: DataFrame, group: str, x: list[str]) -> DataFrame:
    """Three estimates to start from for each group: ``group``, ``start``, ``mu``, ``w``, ``det``.

    All are centred at the medians and scaled by the quartiles: without correlations, with those
    of the directions from the centre, and with those of the bounded distances (tanh).
    """
    floors = list(FLOORS.values())
    quartiles = rows.groupBy(group).agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], 10000).alias(c) for c in x])
    scale = [F.greatest((F.col(c)[2] - F.col(c)[0]) / 1.349, F.lit(f)) for c, f in zip(x, floors)]
    known = quartiles.select(group, F.array(*[F.col(c)[1].cast("double") for c in x]).alias("mu"), F.array(*scale).alias("scale"))
    known = stage(known, "quality-quartiles")
    z = [(F.col(c) - F.col("mu")[i]) / F.col("scale")[i] for i, c in enumerate(x)]
    scaled = rows.join(known, group).select(group, *[e.alias(f"z_{i}") for i, e in enumerate(z)])
    length = F.sqrt(sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(P)), F.lit(0.0)))
    forms = {1: [F.coalesce(F.try_divide(F.col(f"z_{i}"), length), F.lit(0.0)) for i in range(P)], 2: [F.tanh(f"z_{i}") for i in range(P)]}
    seen = scaled.select(group, *[e.alias(f"y{k}_{i}") for k, form in forms.items() for i, e in enumerate(form)])
    sums = seen.groupBy(group).agg(*[
        F.sum(F.col(f"y{k}_{i}") * F.col(f"y{k}_{j}")).alias(f"q{k}_{i}_{j}") for k in forms for i, j in _triangle(P)
    ])
    # A statistic that never leaves its median has no correlation.
    found = []
    for k in (0, *forms):
        cover = {}
        for i, j in _triangle(P):
            size = F.col("scale")[i] * F.col("scale")[j]
            if i == j:
                cover[f"a_{i}_{j}"] = size
            elif k:
                both = F.try_divide(F.col(f"q{k}_{i}_{j}"), F.sqrt(F.col(f"q{k}_{i}_{i}") * F.col(f"q{k}_{j}_{j}")))
                cover[f"a_{i}_{j}"] = F.coalesce(both, F.lit(0.0)) * size
            else:
                cover[f"a_{i}_{j}"] = F.lit(0.0)
        base = known.join(sums, group).select(group, F.lit(k).alias("start"), "mu", *[e.alias(n) for n, e in cover.items()])
        found.append(_inverse_factor(base, [group, "start"]))
    return found[0].unionByName(found[1]).unionByName(found[2])


def concentrated(rows: DataFrame, group: str, x: list[str], params: DataFrame) -> DataFrame:
    """One concentration step of each ``start`` of ``params``: moments of the nearest ``CORE`` of a
    group, up to a class of distances an eighth of a doubling wide. One row for each group, start,
    class and map task is shuffled."""
    floors = list(FLOORS.values())
    # The core has a smaller spread than the group it stands for.
    limit = chi_square_limit(CORE, P)
    wider = CORE / chi_square(limit, P + 2)
    d2 = distance_square([F.col(c) for c in x], F.col("mu"), F.col("w"))
    near = rows.join(params.select(group, "start", "mu", "w"), group)
    near = near.withColumn("_class", F.floor(8 * F.log2(F.least(F.greatest(d2, F.lit(1e-3)), F.lit(1e12)))).cast("int"))
    sums = [F.count("*").alias("n")] + [F.sum(c).alias(f"s_{i}") for i, c in enumerate(x)]
    sums += [F.sum(F.col(x[i]) * F.col(x[j])).alias(f"q_{i}_{j}") for i, j in _triangle(P)]
    keys = [group, "start"]
    classes = near.groupBy(*keys, "_class").agg(*sums)
    every = Window.partitionBy(*keys)
    so_far = every.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    core = classes.withColumn("_before", F.coalesce(F.sum("n").over(so_far), F.lit(0))).withColumn("_all", F.sum("n").over(every))
    core = core.where(F.col("_before") < CORE * F.col("_all")).groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.sum(f"s_{i}").alias(f"s_{i}") for i in range(P)],
        *[F.sum(f"q_{i}_{j}").alias(f"q_{i}_{j}") for i, j in _triangle(P)],
    )
    mean = [F.col(f"s_{i}") / F.col("n") for i in range(P)]
    cover = {}
    for i, j in _triangle(P):
        e = (F.col(f"q_{i}_{j}") / F.col("n") - mean[i] * mean[j]) * wider
        cover[f"a_{i}_{j}"] = e + floors[i] ** 2 if i == j else e
    return _inverse_factor(core.select(*keys, F.array(*mean).alias("mu"), *[e.alias(k) for k, e in cover.items()]), keys)


def fit(rows: DataFrame, group: str, x: list[str]) -> DataFrame:
    """Minimum covariance determinant of each group: ``group``, ``mu`` (means), ``w`` (inverse factor).

    ``rows`` has a text key ``group`` and the vector's columns ``x``. ``STEPS`` concentration
    steps are taken from each of three starts; the one of least determinant goes on until that stops
    falling in every group, ``MOST_STEPS`` at most.
    """
    params = stage(starts(rows, group, x), "quality-starts")
    for step in range(STEPS):
        params = stage(concentrated(rows, group, x, params), f"quality-step-{step}")
    best = F.min_by(F.struct("mu", "w", "det"), F.struct("det", "start"))
    params = stage(params.groupBy(group).agg(best.alias("b")).select(group, F.lit(0).alias("start"), "b.mu", "b.w", "b.det"), "quality-best")
    falling = params
    for step in range(MOST_STEPS):
        new = concentrated(rows, group, x, falling).select(F.col(group).alias("_g"), F.struct("mu", "w", "det").alias("_n"))
        met = params.join(new, F.col(group) == F.col("_g"), "left").withColumn("fell", F.coalesce(F.col("_n.det") < F.col("det") - FALL, F.lit(False)))
        met = stage(met, f"quality-fall-{step}")
        params = met.select(group, "start", *[F.when(F.col("fell"), F.col(f"_n.{c}")).otherwise(F.col(c)).alias(c) for c in ("mu", "w", "det")])
        falling = met.where("fell").select(group, "start", "_n.mu", "_n.w", "_n.det")
        if falling.isEmpty():
            break
    return params.select(group, "mu", "w")


def judge(docs: DataFrame, text: str, keep: list[str]) -> tuple[DataFrame, str, str]:
    """Columns ``keep`` of ``docs`` with two structs, and the names of these.

    The first has the statistics, the second ``base_failed``, ``distance`` and ``kept``. A language and
    source under ``LEAST_ROWS`` documents is judged by the estimates of its whole language, a language under
    that by those of all documents; in a table under that nothing is called an outlier. Documents that fail
    the base rules are rejected anyway and take no part in the estimates.
    """
    stats, verdict = free_name(docs, "_stats"), free_name(docs, "_verdict")
    own, wide = free_name(docs, "_own"), free_name(docs, "_wide")
    df = document_statistics(docs, text, stats).withColumn(own, _group_of(docs, ["lang", "source"])).withColumn(wide, _group_of(docs, ["lang"]))
    s = F.col(f"`{stats}`")
    rows = stage(df.select(*[F.col(f"`{c}`") for c in keep], stats, own, wide), "quality-statistics")
    x = [f"x_{n}" for n in FLOORS]
    vectors = rows.where(~base_failed(s)).select(F.col(own).alias("own"), F.col(wide).alias("wide"), *[v.alias(f"x_{n}") for n, v in vector(s).items()])
    sizes = vectors.groupBy("own", "wide").agg(F.count("*").alias("n"))
    language, every = Window.partitionBy("wide"), Window.partitionBy(F.lit(0))
    enough = F.col("n") >= LEAST_ROWS
    sizes = sizes.select("own", "wide", enough.alias("alone"), (F.sum("n").over(language) >= LEAST_ROWS).alias("known"), (F.sum("n").over(every) >= LEAST_ROWS).alias("some"))
    level = F.when(F.col("alone"), F.concat(F.lit("own"), "own")).when(F.col("known"), F.concat(F.lit("language"), "wide")).when(F.col("some"), F.lit("all"))
    groups = stage(sizes.select("own", "wide", level.alias("level")), "quality-groups")
    # A group that is judged by a wider one makes all documents of that one count for it.
    wanted = groups.select("level").distinct()
    of = F.explode(F.array(F.concat(F.lit("own"), "own"), F.concat(F.lit("language"), "wide"), F.lit("all")))
    members = groups.select("own", of.alias("level")).join(wanted, "level", "left_semi").select("own", F.col("level").alias("fitted"))
    params = fit(vectors.join(stage(members, "quality-members"), "own"), "fitted", x)
    limits = groups.join(params, F.col("level") == F.col("fitted")).select(F.col("own").alias("_limit_of"), F.struct("mu", "w").alias("_limits"))
    named = free_name(rows, "_limit_of"), free_name(rows, "_limits")
    limits = limits.toDF(*named)
    values = vector(s)
    d2 = distance_square([values[n] for n in FLOORS], F.col(named[1])["mu"], F.col(named[1])["w"])
    out = rows.join(limits, F.col(own) == F.col(named[0]), "left")
    bad = base_failed(s)
    cut = chi_square_limit(1 - TAIL, P)
    kept = ~bad & ~F.coalesce(d2 > cut, F.lit(False))
    found = F.struct(bad.alias("base_failed"), F.sqrt(d2).alias("distance"), kept.alias("kept"))
    return out.select(*[F.col(f"`{c}`") for c in keep], stats, found.alias(verdict)), stats, verdict


def quality_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: base statistics, ``base_failed``, ``distance``, ``kept``.

    Null, empty and blank texts have no words and fail the base rules; very long texts are read whole. A missing or null
    language or source is a group of its own. Ties: equal statistics get equal verdicts, so
    repeated rows do too. An empty table gives no rows. Other columns are not read.
    """
    have = [c for c in docs.columns if c.lower() in {"doc_id", "lang", "source", text.lower()}]
    out, stats, verdict = judge(docs.select(*have), text, ["doc_id"])
    s, v = F.col(stats), F.col(verdict)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *[s[n].alias(n) for n in names], v["base_failed"].alias("base_failed"), v["kept"].alias("kept"), v["distance"].alias("distance"))


def quality_filter(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns. Cases as in ``quality_report``."""
    columns = docs.columns
    out, _, verdict = judge(docs, text, columns)
    return out.where(F.col(verdict)["kept"]).select(*[F.col(f"`{c}`") for c in columns])
