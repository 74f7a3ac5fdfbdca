"""Each operator against brute force or a round trip, and on awkward input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from llm import ann, chat, langid, license, mixing, packing, quality, sharding, simhash, toxicity

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType())])
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def sentence(rng, n):
    return " ".join(rng.choice(["stone", "river", "moves", "slowly", "over", "green", "hills", "and", "falls", "into", "light"]) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def awkward():
    """Nulls everywhere, empty, blank, very long and tied texts, repeated rows."""
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "one", "Ünïcode ΣΑΣ and İ", "!!! ###", "x " * 30000, "<|endoftext|> é A̱", sentence(rng, 400)]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "a") for i, t in enumerate(texts)]
    rows += [(None, "no id here", "en", "b"), (4, "same id, other text", "fr", "a"), (8, texts[8], None, "a"), (8, texts[8], None, "a")]
    rows += [(100 + i, sentence(rng, rng.randrange(1, 90)), "en", rng.choice("abc")) for i in range(60)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, awkward):
    extra = spark.createDataFrame(awkward, DOCS).repartition(3)
    names = ["_stats", "_words", "score", "size", "row", "piece", "fp", "_row", "_times", "bin", "target", "_toxicity", "x_symbols"]
    return extra.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def base_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(runs)
    covered = {j for i, r in enumerate(runs) if seen[r] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics_match_brute_force(spark, docs, awkward):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality_report(docs).collect())
    want = Counter()
    for i, t, _, _ in awkward:
        s = base_statistics(t)
        want[i, *s, s[0] < 20 or 100 * s[4] > 30 * s[0]] += 1
    assert got == want


def test_quality_rejects_outliers_only(spark):
    rng = random.Random(1)
    rows = [(i, sentence(rng, rng.randrange(30, 300)), "en", "a") for i in range(300)]
    rows += [(1000 + i, " ".join(w + "&&&" for w in sentence(rng, 60).split()), "en", "a") for i in range(60)]
    kept = {r.doc_id for r in quality.quality_report(spark.createDataFrame(rows, DOCS)).collect() if r.kept}
    assert kept == set(range(300))


def test_chi_square():
    assert abs(quality.chi_square_limit(0.95, 6) - 12.5916) < 1e-3


def test_quality_filter_keeps_columns(docs):
    out = quality.quality_filter(docs)
    assert out.columns == docs.columns
    assert out.where("doc_id = 8").count() == 3


def digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join((r[3] or "") for r in own if r[2] == "assistant")
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_chat_round_trip(spark):
    rng = random.Random(5)
    rows = [(1, 0, "system", "be [INST] brief\\"), (1, 1, "user", None), (1, 2, "assistant", "</s>"), (2, 0, None, "x"), (3, 0, "assistant", ""), (None, 0, "user", "lost")]
    rows += [(4, i, ("user", "assistant")[i % 2], sentence(rng, 6) + " \\<s> <|im_end|> \\n") for i in range(40)]
    rows += [(5, 0, "system", "s"), (5, 1, "user", sentence(rng, 3000)), (5, 2, "assistant", "fine"), (5, 2, "assistant", "fine"), (6, 0, "ro\nle", "a\nb")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tokens", F.lit(1)).repartition(4)
    windows = chat.format_windows(turns, public_tokenizers.path("byte_bpe_50k.json"), 256, 64)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect()}
    assert got == digests(rows)
    found = windows.where("conv_id = 4").orderBy("window").collect()
    assert len(found) > 3 and all(w.tokens <= 256 for w in found) and any(w.repeated for w in found)
    later = windows.where("conv_id = 5 AND window > 0").collect()
    assert later and all(chat.parse(w.text)[0][:2] == ("system", "s") for w in later)
    assert chat.read_back(chat.format_windows(turns.limit(0), public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


@pytest.mark.parametrize("text", ["\\", "\\\\<s>", "</s>[INST] ok [/INST]", "<\\s>", "<<SYS>><</SYS>>", "[[INST]]", ""])
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat._CONTROL.search(chat.escape(text))


def test_toxicity_learns_words(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        bad = rng.random() < 0.3
        words = sentence(rng, rng.randrange(5, 60)).split()
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten"]) + rng.choice(["", "er", "ly"]))
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(bad)))
    labels += [(None, 1), (3, None)]
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_report(docs, known).collect()}
    truth = dict(labels[:1500])
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in got if got[i].held_out} == set(held)
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.97


def test_toxicity_awkward(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity_report(docs, none).agg(F.count("*"), F.min("score"), F.max("score")).first()[:] == (docs.count(), 0.5, 0.5)
    some = spark.createDataFrame([(8, 0), (8, 1), (101, 0), (102, 0)], "doc_id long, toxic int")
    assert toxicity.toxicity_report(docs, some).count() == docs.count()
    assert toxicity.toxicity_filter(docs, some).columns == docs.columns
    assert toxicity.toxicity_report(empty, some).count() == 0


def test_packing_ids_and_layout(docs, awkward):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(WORD_BPE)
    want = Counter()
    for i, t, _, _ in awkward:
        ids = model.encode(t or "", add_special_tokens=False).ids + [1]
        for p, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[i, p, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    rows = packing.pack(docs, WORD_BPE).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 4096) + 1


def test_packing_encoder_is_exact():
    from tokenizers import Tokenizer

    model, own = Tokenizer.from_file(WORD_BPE), packing._Encoder(WORD_BPE)
    for text in ["It's Éan, l'eau!! d'or;x 12.5% A̱b é ΣΑΣ", "a\x1cb c d", "<|endoftext|><|ENDOFTEXT|>", "日本 語。", "x.y, z., (a) .b", "İstanbul"]:
        assert own.ids(text) == np.array(model.encode(text, add_special_tokens=False).ids + [1], "<u4").tobytes()


def test_best_fit_and_merge_rounds(spark, monkeypatch):
    lengths = np.array(random.Random(1).choices(range(1, 4097), k=2000))
    bins, offsets, fills = packing.best_fit(lengths)
    assert max(fills) <= 4096 and sum(fills) == lengths.sum() and len(fills) < lengths.sum() / 4096 * 1.05
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rows = [(i, "word " * (100 + 37 * (i % 50)), None, None) for i in range(120)]
    out = packing.pack(spark.createDataFrame(rows, DOCS).repartition(9), WORD_BPE).collect()
    used = len({r.sequence_id for r in out})
    assert len(out) == 120 and used <= sum(r.length for r in out) / 4096 + 4


def brute_components(prints):
    group = {f: f for f in prints}

    def find(x):
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 3:
                group[find(b)] = find(a)
    return {f: find(f) for f in prints}


def test_fingerprint_by_definition():
    text = "The A the Ébc\x0bd e the a THE Ébc d"
    words = "the a the Ébc d e the a the Ébc d".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), seed=42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert simhash.fingerprint(text) % (1 << 64) == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("One two") % (1 << 64) == xxhash.xxh64_intdigest("one two", seed=42)


def test_links_connect_like_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    prints = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 30)):
            prints.add(x)
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                x ^= 1 << b
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    frame = spark.createDataFrame(signed, "fp long")
    want = brute_components(prints)
    for direct in (3000, 4):
        monkeypatch.setattr(simhash, "DIRECT", direct)
        root = {f % (1 << 64): f % (1 << 64) for f, in signed}
        root |= {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.components(simhash.near_links(frame)).collect()}
        assert Counter(map(frozenset, grouped(root))) == Counter(map(frozenset, grouped(want)))


def grouped(root):
    out = {}
    for k, v in root.items():
        out.setdefault(v, set()).add(k)
    return out.values()


def test_near_duplicates_awkward(docs, awkward, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(awkward)
    prints = {simhash.fingerprint(t) % (1 << 64) for _, t, _, _ in awkward}
    root = brute_components(prints)
    least = {}
    for i, t, _, _ in awkward:
        r = root[simhash.fingerprint(t) % (1 << 64)]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = Counter((i, least[root[simhash.fingerprint(t) % (1 << 64)]]) for i, t, _, _ in awkward)
    assert Counter((r.doc_id, r.component_id) for r in rows) == want
    assert simhash.near_duplicates(empty).count() == 0
    stays = simhash.near_duplicate_filter(docs)
    assert stays.columns == docs.columns
    ids = [r.doc_id for r in stays.collect()]
    assert ids.count(8) == 1 and 0 in ids and 1 not in ids


def test_language(spark, docs, empty):
    words = {"en": "the and of stone river house".split(), "fr": "le et de pierre rivière maison".split(), "de": "der und von stein fluss häuser".split()}
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randrange(3, 40))), lang, "a") for i in range(600) for lang in [rng.choice(list(words))]]
    rows += [(10_001, "123 ... !!", "en", "a"), (10_002, None, None, None), (10_003, "steinhäuser flusslich", None, None)]
    got = {r.doc_id: r for r in langid.language_report(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows[:600])
    assert got[10_001].lang_pred == got[10_002].lang_pred == "und" and got[10_003].lang_pred == "de"
    assert {i for i in got if got[i].held_out} == {i for i in got if zlib.crc32(str(i).encode()) % 3 == 1}
    assert langid.language_report(docs).count() == docs.count()
    assert langid.language_report(empty).count() == 0


def test_sharding(spark, docs, awkward, empty):
    rows = sharding.shard_report(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in awkward)
    for s in range(16):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard_report(empty).count() == 0
    rng = random.Random(8)
    hot = [(i, "the same long text " * 5 if i % 3 == 0 else sentence(rng, 15), None, None) for i in range(6000)]
    loads = [r.b for r in sharding.assign(spark.createDataFrame(hot, DOCS)).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(loads) == 16 and max(loads) < 1.01 * min(loads)


def test_ring_moves_little():
    rng = random.Random(6)
    pieces = [(c, 0, rng.randrange(900, 1100)) for c in range(0, sharding.CELLS, 3)]
    before, after = sharding.place(pieces, 16), sharding.place(pieces, 17)
    assert sum(before[k] != after[k] for k in before) / len(before) < 0.12


def test_ann_recall_and_order(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((6, 32))
    x = centres[rng.integers(0, 6, 1500)] + 0.7 * rng.standard_normal((1500, 32))
    x[100:140] = x[100]
    rows = [(i, [float(v) for v in np.float32(r)]) for i, r in enumerate(x)]
    bad = [(2000, None), (2020, [0.0] * 32), (2040, [float("nan")] * 32), (2060, [1.0]), (2080, [None] * 32), (None, rows[0][1])]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(frame).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 1500, 20))
    x = np.float32(x).astype(float)
    hits = 0
    for q, found in got.items():
        scores = (x * x[q]).sum(1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -scores))[:20]
        hits += len(set(best) & {v for v, _ in found.values()})
        assert [found[k][1] for k in sorted(found)] == sorted((found[k][1] for k in found), reverse=True)
        assert all(abs(s - scores[v]) < 1e-12 for v, s in found.values())
    assert hits / (20 * len(got)) > 0.97
    assert ann.nearest(frame.limit(0)).count() == 0


def test_mixing_targets_and_takes(spark, docs, awkward, empty):
    rows = mixing.mixing_report(docs).collect()
    assert len(rows) == len(awkward) and all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mixing_report(empty).count() == 0
    rng = random.Random(7)
    many = [(i, sentence(rng, rng.randrange(0, 60)), None, s) for i in range(900) for s in [rng.choice(["a", "b", "c", "c", "c", None, "é"])]]
    frame = spark.createDataFrame(many, DOCS)
    rows = mixing.mixing_report(frame).collect()
    sizes, targets, taken = {}, {}, Counter()
    source = {i: s for i, _, _, s in many}
    for r in rows:
        sizes[source[r.doc_id]], targets[source[r.doc_id]] = r.source_size, r.target
        taken[source[r.doc_id]] += r.taken
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight, full, level = {s: k % 3 + 1 for k, s in enumerate(order)}, set(), {}
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        level = {s: 3 * sizes[s] if s in full else left * weight[s] / sum(weight[t] for t in order if t not in full) for s in order}
        over = {s for s in order if level[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    assert all(abs(targets[s] - level[s]) < 1e-5 and taken[s] == int(targets[s]) for s in order)
    targets = mixing.source_targets(mixing.measured(frame))
    slots = mixing.schedule(targets).orderBy("slot").collect()
    for s in order:
        blocks = [r.block for r in slots if r.source == s]
        assert blocks == list(range(len(blocks)))
    half = [r.source for r in slots[: len(slots) // 2]]
    for s in order:
        assert abs(half.count(s) - level[s] / sum(level.values()) * len(half)) < 4
    assert mixing.mixing_filter(docs).columns == docs.columns


def test_license_scan(spark, docs, empty):
    rows = [(1, "Licensed under CC BY-NC 4.0.", None, None), (2, "foo bar\nThis work is licensed under the GNU General Public License, version 2.\nbaz", None, None),
            (3, "we have no license to do this", None, None), (4, "so it is Released under the MIT  license and more words follow here", None, None), (5, "Licensed under CC BY-NC 3.0.", None, None)]
    got = {(r.doc_id, r.license) for r in license.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(1, "CC-BY-NC-4.0"), (2, "GPL-2.0"), (4, "MIT")}
    assert license.scan(docs).count() == 0 and license.scan(empty).count() == 0


def test_small_sources_get_all_their_blocks(spark):
    """Sources of a few words beside huge ones: every block of every target has exactly one slot."""
    targets = [("big1", 2_000_000.0), ("big2", 2_000_000.0), ("big3", 2_000_000.0), ("s1", 30.0), ("s2", 300.0), (None, 10_000.0)]
    frame = spark.createDataFrame(targets, "source string, target double")
    rows = mixing.schedule(frame).collect()
    for source, target in targets:
        assert sorted(r.block for r in rows if r.source == source) == list(range(-(-int(target) // mixing.BLOCK)))
        blocks = [r.block for r in sorted(rows, key=lambda r: r.slot) if r.source == source]
        assert blocks == sorted(blocks)
    assert len({r.slot for r in rows}) == len(rows)


def test_near_duplicate_filter_by_row(spark):
    """Null and repeated ids: each component keeps exactly one row, of the smallest id."""
    rng = random.Random(12)
    a, b, c, d = (sentence(rng, 120) for _ in range(4))
    long = sentence(rng, 4000)
    near = next(t for t in (f"{long} {k}" for k in range(200)) if 0 < (simhash.fingerprint(t) ^ simhash.fingerprint(long)).bit_count() <= 3)
    rows = [(5, a), (5, b), (3, b), (None, c), (7, c), (None, d), (None, long), (None, near), (9, "x y z"), (9, "x y z")]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], DOCS).repartition(3)
    got = [(r.doc_id, r.text) for r in simhash.near_duplicate_filter(docs).collect()]
    assert Counter(got[k] for k in range(len(got)) if got[k][1] not in (long, near)) == Counter([(5, a), (3, b), (7, c), (None, d), (9, "x y z")])
    assert sum(t in (long, near) for _, t in got) == 1


def test_license_every_notice_of_a_block(spark):
    """Many licenses on a line, one notice twice, and a changed first word that also occurs earlier."""
    short = {n: license.TEMPLATES[n][0] for n in ("Apache-2.0", "CC-BY-4.0", "CC-BY-NC-4.0", "GPL-3.0", "LGPL-3.0", "MIT")}
    short["MIT"] = "Released under the MIT License."
    rows = [(1, " ".join(short.values())), (2, f"{short['MIT']} and again {short['MIT']}"),
            (3, "This is an old tool and nobody knows who wrote it. The work is licensed under the GNU General Public License, version 2.")]
    got = sorted((r.doc_id, r.license, r.word_differences) for r in license.scan(spark.createDataFrame([(i, t, None, None) for i, t in rows], DOCS)).collect())
    assert got == [*((1, n, 0) for n in sorted(short)), (2, "MIT", 0), (2, "MIT", 0), (3, "GPL-2.0", 1)]


def test_license_headers_bodies_and_tags(spark):
    """Headers and bodies as they stand in files: wrapped, in comments, with tags."""
    gpl = """/*
 * This file is part of Foo, a program for stones.
 *
 * Foo is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {} as published by
 * the Free Software Foundation, either version {} of the License, or
 * (at your option) any later version.
 */"""
    bsd = "\n".join("# " + x for x in """Copyright 2001 The Stone Authors. All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.{}
THIS SOFTWARE IS PROVIDED BY THE AUTHORS "AS IS".""".split("\n"))
    third = "\n# 3. Neither the name of the MIT nor the names of its\n#    contributors may be used to endorse or promote products derived from this\n#    software without specific prior written permission."
    mit = "dnl Permission is hereby granted, free of charge, to any person obtaining a copy\ndnl of this software and associated documentation files (the \"Software\"), to deal\ndnl in the Software without restriction, including without limitation the rights\ndnl to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ndnl copies of the Software, and to permit persons to whom the Software is\ndnl furnished to do so, subject to the following conditions:"
    isc = "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."
    rows = [(gpl.format("General Public License", 3), ["GPL-3.0"]), (gpl.format("General Public License", 2), ["GPL-2.0"]), (gpl.format("Lesser General Public License", "2.1"), ["LGPL-2.1"]),
            (gpl.format("Affero General Public License", 3), ["AGPL-3.0"]), (bsd.format(""), ["BSD-2-Clause"]), (bsd.format(third), ["BSD-3-Clause"]), (mit, ["MIT"]), (isc, ["ISC"]),
            ("This is free and unencumbered software released into\nthe public domain.", ["Unlicense"]),
            ("// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note OR BSD-3-Clause) AND OFL-1.1\nint and = 1;", ["BSD-3-Clause", "GPL-2.0", "OFL-1.1"]),
            ("a driver's license and public software without permission", [])]
    frame = spark.createDataFrame([(i, t, None, None) for i, (t, _) in enumerate(rows)], DOCS)
    got = {}
    for r in license.scan(frame).collect():
        got.setdefault(r.doc_id, []).append(r.license)
    assert [sorted(got.get(i, [])) for i in range(len(rows))] == [want for _, want in rows]


def test_license_cues_reach_every_notice():
    """Every template has more cues than words that may differ, and is found as its own license."""
    scanner = license.Scanner()
    for name, texts in license.TEMPLATES.items():
        for text in texts:
            assert len(license._CUE.findall(text)) > license._allowed(len(license._WORD.findall(text)))
            assert [f[0] for f in scanner.block(f"foo bar {text} baz qux")] == [name]


def test_quality_rejects_each_statistic_alone(spark):
    """An outlier in one statistic is rejected, whichever it is; a single occurrence is not."""
    rng = random.Random(14)

    def lines(words, n=9):
        return "\n".join(" ".join(words[k : k + n]) for k in range(0, len(words), n))

    clean = [lines(sentence(rng, rng.randrange(100, 300)).split()) for _ in range(400)]
    words = sentence(rng, 200).split()
    short = [sentence(rng, 3) for _ in range(60)]
    planted = {
        "word_length": lines([w + "ab1" for w in words]),
        "symbols": lines([w + "#" * (k % 2) for k, w in enumerate(words)]),
        "dup_lines": "\n".join(rng.choices(short, k=200)),
        "repeats": lines(words[:25] + words[30:150] + words[:25] + words[155:185]),
        "capitals": lines([w.upper() if k % 2 else w for k, w in enumerate(words)]),
        "marks": lines([w + "!" * (k % 2) for k, w in enumerate(words)]),
    }
    single = [lines(words[:99] + ["&"]), lines(words[:99] + ["a!"]), lines(words[:60], 6) + "\n" + lines(words[:6])]
    texts = clean + list(planted.values()) + single
    rows = quality.quality_report(spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], DOCS)).collect()
    out = {r.doc_id: r for r in rows}
    assert not any(r.base_failed for r in rows)
    assert {n: out[400 + k].kept for k, n in enumerate(planted)} == dict.fromkeys(planted, False)
    assert all(out[406 + k].kept for k in range(3))
    assert sum(not out[i].kept for i in range(400)) <= 2


def zstd_size(data, template=None):
    import zstandard as z

    sizes = z.ZstdCompressionParameters.from_level(3, source_size=4096, dict_size=len(template or ""), write_content_size=False, write_dict_id=False)
    known = z.ZstdCompressionDict(template.lower().encode(), dict_type=z.DICT_TYPE_RAWCONTENT) if template else None
    if known:
        known.precompute_compress(compression_params=sizes)
    return len(z.ZstdCompressor(dict_data=known, compression_params=sizes).compress(data))


def test_license_compression_chooses(monkeypatch):
    """Savings by hand; a notice that saves nothing is not looked at; of two at one place the one that gains more."""
    scanner = license.Scanner()
    mit, zero = license.TEMPLATES["MIT"][1], license.TEMPLATES["MIT-0"][0]
    for name, text in (("MIT", mit), ("MIT-0", zero)):
        block = license._WORD.sub(lambda m: m.group(), text).rstrip(".").lower().encode()
        (found,) = scanner.block(f"Some words before it. {text} And some behind.")
        assert found[0] == name and found[2] == 0
        assert found[1] == (zstd_size(block) - zstd_size(block, text)) / len(block) > 0.5
    gains = {t: zstd_size(zero.lower().encode()) - zstd_size(zero.lower().encode(), t) - zstd_size(t.lower().encode(), zero) for t in (mit, zero)}
    assert gains[zero] > gains[mit]
    real = license.Scanner.saved
    monkeypatch.setattr(license.Scanner, "saved", lambda self, block, template: 0 if template == zero else real(self, block, template))
    assert [f[0] for f in license.Scanner().block(zero)] != ["MIT-0"]


def test_license_with_differences(spark):
    """Notices with words changed, left out or put in, as many as may differ and one more."""
    notice = "Distributed under the Boost Software License, Version 1.0."
    body = license.TEMPLATES["BSD-2-Clause"][1]
    rng, rows, want = random.Random(6), [], set()
    for i in range(40):
        words = body.split()
        spots = [k for k in range(3, len(words) - 3) if not license._TELLING.search(words[k].lower()) and words[k].isalpha()]
        allowed = int(0.12 * len(license._WORD.findall(body)))
        n = rng.choice([0, 1, 2, 4])
        for k in rng.sample(spots[:: max(1, len(spots) // 8)], n):
            words[k] = rng.choice([f"zz{k}", words[k] + f" yy{k}", f"xx{k}"])
        assert n <= allowed
        rows.append((i, "A tool. " + " ".join(words) + " The end.", None, None))
        want.add((i, "BSD-2-Clause", n))
    rows += [(100, notice, None, None), (101, notice.replace("Boost", "Bust"), None, None), (102, "", None, None), (103, None, None, None)]
    got = {(r.doc_id, r.license, r.word_differences) for r in license.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert want <= got and (100, "BSL-1.0", 0) in got and not any(i in (101, 102, 103) for i, _, _ in got)


def test_chat_ids_stay_exact(spark):
    """Ids beyond doubles beside a null id, and a null conversation with a third of all rows."""
    ids = [2**53 + 1, 2**53 + 2, None, 2**53 + 3, -(2**60) - 1]
    rows = [(i, t, "user" if t % 2 else "assistant", f"turn {t} of {i}") for i in ids for t in range(4)] + [(None, t, "assistant", f"word {t}") for t in range(4, 14)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.format_windows(frame, BYTE_BPE)).collect()}
    assert set(got) == set(ids) and got[None].n_turns == 14
    for i in ids:
        own = sorted((t, r, x) for c, t, r, x in rows if c == i)
        assert got[i].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
    words = frame.selectExpr("concat('c', coalesce(cast(conv_id AS string), '')) AS conv_id", "turn", "role", "text", "role AS tokens", "text AS window")
    assert {r.conv_id for r in chat.read_back(chat.format_windows(words, BYTE_BPE)).collect()} == {f"c{i if i is not None else ''}" for i in ids}


def test_toxicity_repeated_rows_crowd_nothing_out(spark):
    rng = random.Random(9)
    kind = lambda i: rng.choice(["vile", "scum", "filth"]) if i % 3 == 0 else rng.choice(["river", "stone", "light"])
    rows = [(i, f"{sentence(rng, 6)} {kind(i)} {sentence(rng, 4)} {kind(i)}", "en", "a") for i in range(600)]
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    plain = toxicity.fit(spark.createDataFrame(rows, DOCS), toxicity.training_labels(labels))
    more = rows + [rows[1]] * 5000 + [(2, "another text of this id", "en", "a")] * 500
    crowded = spark.createDataFrame(more, DOCS).repartition(5)
    scored = toxicity.toxicity_report(crowded, labels)
    held = {r.doc_id: r.predicted for r in scored.where("held_out").collect()}
    assert sum(held[i] == int(i % 3 == 0) for i in held) / len(held) > 0.97
    assert len(plain) > 3


def test_sharding_cuts_rows_that_are_alike(spark):
    """A third of all rows alike in id and text, and null ids with equal texts: sizes stay near equal."""
    rng = random.Random(10)
    alike = [(7 if i % 2 else None, "the same long text " * 5, None, None) if i % 3 == 0 else (i, sentence(rng, 15), None, None) for i in range(6000)]
    placed = sharding.assign(spark.createDataFrame(alike, DOCS).repartition(4)).collect()
    loads, slots = Counter(), defaultdict(list)
    for r in placed:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    share = sum(loads.values()) / 16
    assert len(loads) == 16 and max(loads.values()) <= share * (1 + sharding.EXCESS) + max(r["size"] for r in placed)
    assert min(loads.values()) > 0.98 * share and all(sorted(s) == list(range(len(s))) for s in slots.values())


def plain_place(pieces, shards):
    """Clockwise from its cell to the first virtual node whose shard has room."""
    nodes = {}
    for shard in range(shards):
        for v in range(sharding.VIRTUAL):
            cell = xxhash.xxh64_intdigest(f"node {shard} {v}") % sharding.CELLS
            while cell in nodes:
                cell = (cell + 1) % sharding.CELLS
            nodes[cell] = shard
    most = sum(b for _, _, b in pieces) / shards * (1 + sharding.EXCESS)
    load, out = [0] * shards, {}
    for cell, piece, size in sorted(pieces):
        turn = [nodes[c % sharding.CELLS] for c in range(cell, cell + sharding.CELLS) if c % sharding.CELLS in nodes]
        shard = next((s for s in turn if load[s] + size <= most), min(range(shards), key=lambda s: (load[s], s)))
        load[shard] += size
        out[cell, piece] = shard
    return out


def test_ring_by_hand_and_how_little_moves():
    rng = random.Random(6)
    pieces = [(c, 0, rng.randrange(900, 1100)) for c in range(0, sharding.CELLS, 3)]
    before, after = sharding.place(pieces, 16), sharding.place(pieces, 17)
    assert before == plain_place(pieces, 16) and after == plain_place(pieces, 17)
    moved = sum(before[k] != after[k] for k in before) / len(before)
    assert moved < 0.12, moved


def test_mixing_splits_ids_that_are_alike(spark):
    """A third of all rows without an id, and many with one id: positions are exact, by size, then row."""
    rng = random.Random(11)
    many = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, sentence(rng, rng.randrange(1, 30)), None, "a") for i in range(900)]
    rows = mixing.measured(spark.createDataFrame(many, DOCS).repartition(4))
    placed = sorted(mixing.positions(rows, 7).collect(), key=lambda r: r.start)
    key = lambda r: (hashlib.md5(str(r.doc_id if r.doc_id is not None else "").encode()).hexdigest(), r["size"], r.row)
    assert placed == sorted(placed, key=key)
    assert [r.start for r in placed] == [sum(r["size"] for r in placed[:k]) for k in range(len(placed))]


def test_mixing_filter_keeps_the_order_of_the_mix(spark):
    rng = random.Random(12)
    many = [(i, sentence(rng, 256), None, rng.choice("abb")) for i in range(120)]
    out = mixing.mixing_filter(spark.createDataFrame(many, DOCS))
    first = {}
    for r in mixing.mixing_report(spark.createDataFrame(many, DOCS)).collect():
        first[r.doc_id] = r.first_slot
    order = []
    for r in out.collect():
        if r.doc_id not in order:
            order.append(r.doc_id)
    assert order == sorted(order, key=first.get)


def test_ann_other_columns_and_blocks(spark, monkeypatch):
    """Columns of clashing names do no harm; many small blocks answer like one."""
    rng = np.random.default_rng(13)
    x = rng.standard_normal((400, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(None, x[0].tolist()), (20, None), (40, [0.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "vec_id AS v", "vec_id AS qb", "vec_id AS rb", "vec_id AS code", "vec_id AS score").repartition(3)
    one = sorted(map(tuple, ann.nearest(frame).collect()))
    monkeypatch.setattr(ann, "ROWS", 64)
    monkeypatch.setattr(ann, "QUERIES", 8)
    assert sorted(map(tuple, ann.nearest(frame).collect())) == one
    assert np.allclose(ann.centre(ann.valid(frame)), x.mean(0)) and len(one) == 20 * 20
    for q, rank, i, score in one:
        assert abs(score - float((x[i] * x[q]).sum())) < 1e-12 and i != q
