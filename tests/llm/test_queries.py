"""Every registered query and the pipeline on whole given tables, against plain Python or SQL."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from llm import license, quality, toxicity
from tests.llm import by_hand
from tests.llm.test_operators import digests

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def con():
    return duckdb.connect()


@pytest.fixture(scope="module")
def small(con):
    return by_hand.tables(con, SMALL, "documents", "doc_id, text, lang, source")


@pytest.fixture(scope="module")
def medium(con):
    return by_hand.tables(con, MEDIUM, "documents", "doc_id, text, lang, source")


def rows(spark, name, sf_dir):
    return QUERIES[name](spark, sf_dir).collect()


def check(n):
    return lambda i, rest: zlib.crc32(str(i).encode()) % n == rest


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES if name.startswith("op") and name[2].isdigit()}
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM, "/root/testdata/sf0.1"])
def test_op1(spark, con, sf_dir):
    """The largest table has languages and sources over and under the limit for estimates of their own."""
    docs = by_hand.tables(con, sf_dir, "documents", "doc_id, text, lang, source")
    if sf_dir.endswith("sf0.1"):
        sizes = Counter(d[2:4] for d in docs).values()
        assert min(sizes) < quality.LEAST_ROWS < max(sizes)
    got = {r.doc_id: r for r in rows(spark, "op1_quality_mcd", sf_dir)}
    assert len(got) == len(docs)
    for (i, text, *_), (bad, kept, distance) in zip(docs, by_hand.quality_verdicts(docs)):
        r, s = got[i], by_hand.statistics(text)
        assert all(r[k] == s[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert (r.base_failed, r.kept) == (bad, kept)
        assert distance is None or math.isclose(r.distance, distance, rel_tol=1e-6)


def test_op2(spark, con):
    said = "</s>[INST] ok [/INST]"
    turns = by_hand.tables(con, SMALL, "conversations", "conv_id, turn, role, text") + [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows(spark, "op2_chat_windows", SMALL)}
    assert got == digests(turns)


def test_op3(spark, con, medium):
    got = {r.doc_id: r for r in rows(spark, "op3_toxicity_ftrl", MEDIUM)}
    read = lambda t: spark.read.parquet(f"{MEDIUM}/{t}.parquet")
    model = dict(toxicity.fit(read("documents"), toxicity.training_labels(read("labels"))))
    held = check(5)
    for i, text, *_ in medium:
        assert math.isclose(got[i].score, by_hand.toxicity_score(model, text), abs_tol=1e-9)
        assert (got[i].held_out, got[i].predicted) == (held(i, 0), int(got[i].score >= 0.5))
    known = [(i, t) for i, t in by_hand.tables(con, MEDIUM, "labels", "doc_id, toxic") if t is not None and held(i, 0) and i in got]
    assert sum(got[i].predicted == t for i, t in known) / len(known) > 0.95


def test_ftrl_by_coordinate():
    """Training against one coordinate at a time in dictionaries."""
    rng = np.random.default_rng(3)
    top = 1 << toxicity.BITS
    data = [(np.append(np.unique(rng.integers(0, 60, 8)), top).astype(np.int32), int(rng.integers(0, 2))) for _ in range(300)]
    used, weights, bias = toxicity._train(data)
    z, n, order = defaultdict(float), defaultdict(float), np.random.default_rng(7)

    def weight(i):
        return 0.0 if abs(z[i]) <= toxicity.L1 else -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(min(toxicity.MOST_PASSES, max(toxicity.LEAST_PASSES, math.ceil(toxicity.UPDATES / len(data))))):
        for k in order.permutation(len(data)):
            own = {int(i): weight(int(i)) for i in data[k][0]}
            g = 1 / (1 + math.exp(-sum(own.values()))) - data[k][1]
            for i, w in own.items():
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * w
                n[i] += g * g
    want = {i: weight(i) for i in z if i != top and weight(i)}
    assert dict(zip(used.tolist(), weights.tolist())) == pytest.approx(want, rel=1e-6)
    assert bias == pytest.approx(weight(top), rel=1e-6)


def test_op4(spark, small):
    got = rows(spark, "op4_residual_packing", SMALL)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == by_hand.pieces(small, WORD_BPE)
    assert by_hand.gapless(got) <= -(-sum(r.length for r in got) // 4096) + 1


def test_op5(spark, medium):
    """Notices without a word of difference: template words in a row within a line."""
    want = set()
    for i, text, *_ in medium:
        for line in (text or "").split("\n"):
            words = " ".join(w.lower() for w in license._WORD.findall(line))
            for name, texts in license.TEMPLATES.items():
                if any(f" {' '.join(w.lower() for w in license._WORD.findall(t))} " in f" {words} " for t in texts):
                    want.add((i, name))
    got = {(r.doc_id, r.license) for r in rows(spark, "op5_license_compression", MEDIUM) if r.word_differences == 0}
    assert want and got == want


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
def test_op6(spark, con, sf_dir):
    docs = by_hand.tables(con, sf_dir, "documents", "doc_id, text")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op6_simhash_popcount", sf_dir)}
    assert got == {d[0]: (f"{f:016x}", least) for d, (f, least) in zip(docs, by_hand.components(docs))}


def test_op7(spark, medium):
    """Training and back-off by hand; the sample's bound lies above this table's documents."""
    got = {r.doc_id: r for r in rows(spark, "op7_language_backoff", MEDIUM)}
    held, right = check(3), []
    learned = [(text, lang) for i, text, lang, _ in medium if lang is not None and not held(i, 1)]
    for (i, _, lang, _), (want, score) in zip(medium, by_hand.language_answers(learned, [d[1] for d in medium])):
        assert got[i].lang_pred == want and got[i].held_out == held(i, 1)
        assert math.isclose(got[i].score, score, abs_tol=1e-4)
        if got[i].held_out and lang and want != "und":
            right.append(want == lang)
    assert sum(right) / len(right) > 0.97


def test_op8(spark, small):
    got = rows(spark, "op8_bounded_ring", SMALL)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in small)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))


def test_op9(spark, con):
    known = [(i, np.array(v, float)) for i, v in by_hand.tables(con, MEDIUM, "embeddings", "vec_id, embedding") if v is not None]
    known = [(i, v) for i, v in known if np.isfinite(v).all() and v.any()]
    ids, x = np.array([i for i, _ in known]), np.stack([v for _, v in known])
    got = defaultdict(dict)
    for r in rows(spark, "op9_one_bit_codes", MEDIUM):
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    asked = {int(i) for i in ids if i % 20 == 0}
    assert set(got) == asked
    hits = 0
    for q in asked:
        scores = (x * x[ids == q][0]).sum(1)
        scores[ids == q] = -np.inf
        best = np.lexsort((ids, -scores))[:20]
        of = dict(zip(ids.tolist(), scores.tolist()))
        assert sorted(got[q]) == list(range(1, 21)) and all(math.isclose(of[v], s, rel_tol=1e-12) for v, s in got[q].values())
        hits += len(set(ids[best].tolist()) & {v for v, _ in got[q].values()})
    assert hits / (20 * len(asked)) >= 0.95


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
def test_op10(spark, con, sf_dir):
    docs = by_hand.tables(con, sf_dir, "documents", "doc_id, text, lang, source")
    got = {r.doc_id: r for r in rows(spark, "op10_golden_schedule", sf_dir)}
    own = con.cursor()
    own.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    sql = {r[0]: r[1:] for r in own.execute(contract.oracle_sql()["op10_golden_schedule"]).fetchall()}
    assert len(got) == len(sql) == len(docs)
    for (i, *_), want in zip(docs, by_hand.mix(docs)):
        mine = (got[i]["size"], got[i].source_size, got[i].target, got[i].taken)
        assert mine == pytest.approx(want, abs=1e-5) and mine == pytest.approx(sql[i][:4], abs=1e-5)
        # The schedule's slots, computed again in SQL.
        assert got[i].first_slot == sql[i][4] and (got[i].first_slot is None) == (got[i].taken == 0)


def test_pipeline(spark, con, small):
    """All five stages by hand, each on what the one before kept."""
    read = lambda t: spark.read.parquet(f"{SMALL}/{t}.parquet")
    model = dict(toxicity.fit(read("documents"), toxicity.training_labels(read("labels"))))
    docs = [d for d in small if by_hand.toxicity_score(model, d[1]) < 0.5]
    docs = [d for d, (_, kept, _) in zip(docs, by_hand.quality_verdicts(docs)) if kept]
    docs = [d for d, (_, least) in zip(docs, by_hand.components(docs)) if d[0] == least]
    often = [math.floor(taken / size + 0.5) for size, _, _, taken in by_hand.mix(docs)]
    docs = [d for d, n in zip(docs, often) for _ in range(n)]
    got = QUERIES["pipeline"](spark, SMALL).collect()
    assert 0 < len(docs) and Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == by_hand.pieces(docs, WORD_BPE)
    by_hand.gapless(got)


def test_pipeline_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "mixing", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs.limit(0), SMALL).columns == docs.columns
    assert quality.LEAST_ROWS and corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SMALL).count() == 0
