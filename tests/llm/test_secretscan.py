"""Secret scans: base spans by hand, gradients by differences, held-out recall, whole queries."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest

import __spark_entry__ as contract
from llm import secretscan
from llm.secretscan import KINDS, Network, encoded, made_findings

PLAIN = {
    "assign": (r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def plain_base(text):
    """(start, kind number, end): all matches of the loose patterns, less those that are too short."""
    out = []
    for k, (pattern, group, least) in enumerate(PLAIN.values()):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return sorted(out)


def told(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


CASES = ["", "password: abcdefghijkl", "PassWd = 'abcdefghijk'", "api_key=\"0123456789abcdef0\" apiKEY:x token=token=abcdefghijkl", "toKen=abcdefghijklm paſſword=abcdefghijklm", "AKIA" + "A1" * 7, "AKIA" + "A1" * 6 + "A", "xAKIAAKIA" + "Z" * 13, "deadbeef" * 2, "deadbee" * 2, "éé secret='\n\"abcdefghijklmn", "secret: " + "ab12" * 5000, "f" * 40_000, "password=" * 6]


@pytest.mark.parametrize("text", CASES)
def test_base_spans(text):
    assert secretscan.base_spans(text) == plain_base(text)


def test_base_spans_of_random_texts():
    rng = random.Random(4)
    parts = ["password", "Secret", "token", "api", "_", "key", "\"", "'", " ", ":", "=", "AKIA", "Q7", "0a1b2c3d", "zzzz", "+/", "\n", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert secretscan.base_spans(text) == plain_base(text)


def test_candidates_and_their_kinds():
    text = "see password=abcdefghijkl0 or abcdefghijklmnop and deadbeefdeadbeef99=="
    base = secretscan.base_spans(text)
    found = secretscan.findings(text, base)
    assert [(text[s:e], k) for s, e, k, _ in found] == [("abcdefghijkl0", 0), ("abcdefghijklmnop", -1), ("deadbeefdeadbeef99==", 2)]
    assert found[0][3] == "see password=\0abcdefghijkl0\0 or abcd"[max(0, 13 - 16) :]


def test_long_readings_are_read_whole():
    net = Network.fresh()
    tail = "\0" + "a" * 500 + "Zq9Zq9Zq9" + "a" * 300 + "\0 end"
    chars, roles, first = encoded(["x" + tail])
    once = net.columns(chars, roles) @ net.weights[1]
    c, r = secretscan._characters("x" + tail)
    x = np.concatenate([net.weights[0][c], np.eye(3, dtype=np.float32)[r]], axis=1)
    every = np.stack([x[i : i + secretscan.WIDTH].ravel() for i in range(len(x) - secretscan.WIDTH + 1)]) @ net.weights[1]
    assert first.tolist() == [0]
    whole = once.reshape(-1, secretscan.FILTERS)[: len(every)]
    assert np.allclose(whole, every, atol=1e-5)


def test_gradients_by_differences():
    net = Network.fresh()
    net.weights = [w.astype(np.float64) for w in net.weights]
    readings = [r for r, _ in made_findings(8)] + ["ab\0" + "xYz019" * 20 + "\0 q"]
    y, w = np.array([1.0, 0.0] * 4 + [1.0]), np.linspace(1, 2, 9)
    data = encoded(readings)

    def loss():
        p = 1 / (1 + np.exp(-net.logits(*data)))
        return -(w / w.sum() * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    rng = np.random.default_rng(0)
    for k, g in enumerate(net.gradients(*data, y, w)):
        for _ in range(8):
            at = tuple(rng.integers(0, n) for n in net.weights[k].shape)
            old = net.weights[k][at]
            net.weights[k][at] = old + 1e-5
            high = loss()
            net.weights[k][at] = old - 1e-5
            low = loss()
            net.weights[k][at] = old
            assert abs((high - low) / 2e-5 - g[at]) < 1e-4


def test_thresholds_recall_each_kind():
    rng = np.random.default_rng(2)
    p, names = rng.random(400), np.array(["hex"] * 100 + ["made"] * 100 + ["word"] * 200)
    found = secretscan.thresholds(p, names, names != "word")
    for name, t in found.items():
        own = p[names == name]
        assert (own >= t).mean() >= secretscan.RECALL and (own > t).mean() < secretscan.RECALL + 0.011


def test_every_finding_is_learned_or_calibrates(spark):
    """More distinct findings than any sample held: each is in a pass or among those kept apart."""
    rng = random.Random(8)
    n = 12_500
    texts = [f"{i} " + " ".join("".join(rng.choice("0123456789abcdef") for _ in range(16)) for _ in range(25)) + " plainlowerword" for i in range(n // 25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    extracted = secretscan.extract(docs, "text", ["doc_id"])
    distinct = extracted.selectExpr("explode(candidates.reading) AS r").distinct().count()
    assert distinct > n
    net = secretscan.fit(extracted)
    assert net.learned + net.held == distinct + secretscan.MADE and net.held > distinct // 6


def test_parts_learn_every_finding_and_are_averaged(spark, monkeypatch):
    names = np.array(["word"] * 1000 + ["hex"] * 300 + ["access"] * 2)
    seen = [secretscan.batches(names, np.random.default_rng(k)) for k in range(3)]
    for own in seen:
        own = list(own)
        assert set(np.concatenate(own)) == set(range(len(names)))
        assert all({"word", "hex", "access"} == set(names[b]) for b in own)
    known = spark.createDataFrame([(f"\0{i:012d}\0", "word") for i in range(40)], "reading string, class string")
    parts = known.repartition(4, "reading").selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    monkeypatch.setattr(secretscan, "learn", lambda weights, sample, turn: [w * 0 + len(sample) for w in weights])
    net = secretscan._round(known, 4, Network.fresh(), [], 0)
    want = sum(r["count"] ** 2 for r in parts) / 40
    assert len(parts) > 1 and net.learned == 40 and all(np.allclose(w, want) for w in net.weights)


def test_a_batch_of_long_readings_has_the_gradient_of_its_parts(monkeypatch):
    net = Network.fresh()
    readings = [r for r, _ in made_findings(6)] + ["ab\0" + "xYz019" * 200 + "\0 q"]
    y, w = np.array([1.0, 0.0] * 3 + [1.0], np.float32), np.linspace(1, 2, 7).astype(np.float32)
    whole = net.gradients(*encoded(readings), y, w)
    monkeypatch.setattr(secretscan, "ROWS_AT_ONCE", 3)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(whole, secretscan._gradients(net, readings, y, w)))


def test_counted_thresholds_are_those_of_the_findings():
    rng = np.random.default_rng(5)
    p, count = np.round(rng.random(50), 2), rng.integers(1, 9, 50)
    names = np.array(["hex"] * 30 + ["made"] * 20)
    secret = np.ones(50, bool)
    every = secretscan.thresholds(np.repeat(p, count), np.repeat(names, count), np.ones(count.sum(), bool))
    assert secretscan.thresholds(p, names, secret, count) == every


@pytest.fixture(scope="module")
def answers(spark):
    return {d: contract.queries()["op12_char_cnn"](spark, f"/root/testdata/{d}").collect() for d in ("sf0.001", "sf0.01")}


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query_keeps_the_base(spark, answers, name):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{name}/documents.parquet").collect()}
    assert len(answers[name]) == len(texts)
    for r in answers[name]:
        base = plain_base(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert r.base_sha256 == sha256(told(base).encode()).hexdigest()
        own = r.spans.split(",") if r.spans else []
        assert [s for s in own if not s.startswith("cnn")] == ([] if not base else told(base).split(","))
        assert len(own) - len(base) == r.n_added


def test_few_candidates_are_added_to_given_texts(answers):
    assert sum(r.n_added for r in answers["sf0.01"]) <= 10


def test_secrets_beyond_the_base_are_found(spark):
    """Held-out made-up tokens in given texts: nearly all found, harmless names left alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = made_findings(400, seed=99)
    extra = [(10_000 + i, r.replace("\0", "")) for i, (r, _) in enumerate(held)]
    extra += [(None, None), (None, ""), (20_000, "a" * 100_000), (20_001, "9"), (20_001, "9")]
    # Clashing names of other columns do no harm.
    rows = docs.unionByName(spark.createDataFrame(extra, docs.schema)).selectExpr("*", "text AS spans", "text AS base", "text AS candidates")
    got = {r.doc_id: r for r in secretscan.secret_report(rows).collect()}
    hit = {secret: [] for secret in (True, False)}
    for (i, text), (_, name) in zip(extra, held):
        hit[name == "made"].append(got[i].spans != "")
    assert np.mean(hit[True]) >= 0.93 and np.mean(hit[False]) <= 0.07
    assert got[None].spans == "" and got[20_001].spans == ""


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert secretscan.secret_report(none).collect() == []
    none = spark.createDataFrame([(1, "plain words"), (2, "hello password=abcdefghijklmnop")], "doc_id long, text string")
    assert [r.n_added for r in secretscan.secret_report(none).collect()] == [0, 0]
