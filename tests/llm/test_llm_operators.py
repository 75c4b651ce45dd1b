"""The training-data operators against brute force, on hand-made rows: nulls, empty and long texts, ties, repeats, empty tables."""

from __future__ import annotations

import base64
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import (byte_bpe, chat_grammar, common, fm_classifier, host_rules, license_rules, minhash_join, mixing,
                            pivot_index, pyp_lm, recompression)
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd_rows():
    """Documents with nulls, empty and long texts, repeats and near copies."""
    base, passage = prose(1, 300), prose(2, 80)
    near = base[:100] + ["changed"] + base[101:]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "One two"),
            (9, "one two"), (10, " ".join(prose(3, 60) + passage + prose(4, 70))), (11, " ".join(prose(5, 90) + passage)),
            (12, " ".join(passage + prose(6, 40))), (13, "a " * 400), (14, "a " * 300), (15, "ab cd " * 200),
            (16, "ab cd " * 150 + "tail"), (17, "LINE one two three\n" * 30), (18, " ".join(prose(7, 6000, 50_000))),
            (18, " ".join(prose(7, 6000, 50_000))), (19, "é ü 漢字 🙂 " * 60), (-20, " ".join(passage))]
    for k in range(21, 40):
        copy = list(base)
        for j in range(k - 20):
            copy[(37 * k + 11 * j) % 300] = f"x{k}{j}"
        rows.append((k, " ".join(copy)))
    return rows


# --- mixing --------------------------------------------------------------------------------------------------------------

def test_targets_share_all_words_below_their_caps(spark):
    totals = [("a", 10), ("b", 1000), ("c", 0), (None, 500), ("d", 70), ("e", 3)]
    rows = mixing.source_targets(spark.createDataFrame(totals, "source string, source_size long")).collect()
    size = dict(totals)
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    # Resharing step by step.
    fixed, left, total = {}, set(order), sum(size.values())
    while True:
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * size[s]}
        if not over:
            break
        fixed |= {s: 3 * size[s] for s in over}
        left -= over
    want = fixed | share
    for r in rows:
        assert r.target == pytest.approx(want[r.source])
    assert sum(r.target for r in rows) == pytest.approx(total)


def test_mix_cuts_at_the_exact_word(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), rng.choice(["a", "a", "a", "b", None])) for i in range(400)] + [(7, None, "b")] * 2
    docs = H.frame(spark, rows)
    out = mixing.mix(docs, mixing.n_words(F.col("text"))).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    for source in ("a", "b", None):
        mine = [r for r in out if r.source == source]
        assert sum(r.taken for r in mine) == math.floor(mine[0].target)
        assert all(0 <= r.taken <= 3 * r.size for r in mine)
        assert sum(1 for r in mine if 0 < r.part < r.size) <= 1          # one document lies on the cut
    again = mixing.mix(docs.repartition(7), mixing.n_words(F.col("text"))).collect()
    assert Counter(again) == Counter(out)
    mixed = mixing.mixed_documents(docs).collect()
    assert sum(len(H.words(r.text)) for r in mixed) == sum(r.taken for r in out)
    assert mixing.mixed_documents(docs).columns == list(common.DOCUMENT_COLUMNS)


def test_words_are_counted_and_cut_without_an_array_of_them(spark):
    texts = [None, "", "   ", "\x0b\x0c\r\n", "a", " a", "a ", "\t a\n\nb\x0b c\r\n", "\x1c\x1f\x85\u00a0 \u2003x\u3000", "\U0001f600 \U0001f600\U0001f600",
             "\x00 w $1 \\1 w", "ww www", "x" * 5000, " x" * 5000, "é\n" * 3 + " " * 100]
    docs = H.frame(spark, list(enumerate(texts)))
    counted = docs.select("doc_id", mixing.n_words(F.col("text")).alias("n"))
    assert {r.doc_id: r.n for r in counted.collect()} == {i: len(H.words(t)) for i, t in enumerate(texts)}
    parts = docs.crossJoin(spark.range(1, 7).select(F.col("id").alias("part"))).withColumn("size", mixing.n_words(F.col("text"))).filter("part < size")
    cut = parts.select("doc_id", "part", mixing.first_words(F.col("text"), F.col("part")).alias("cut")).collect()
    assert len(cut) > 12 and all(r.cut == " ".join(H.words(texts[r.doc_id])[:r.part]) for r in cut)
    # All words of a text in one array take several times its size.
    for df in (counted, mixing.mixed_documents(docs)):
        assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()


# --- host rules ------------------------------------------------------------------------------------------------------------

def test_measures_equal_brute_force(spark, odd_rows):
    rows = [r for r in odd_rows if r[0] != 18] + [(50, "x y z " * 4 + "x y"), (51, "l\nl\n\n \nl\nm"), (52, "#1 $$ a|b <c>")]
    got = {r.doc_id: r for r in host_rules.measures(H.frame(spark, rows)).collect()}
    for d, t in rows:
        w, lines = H.words(t), [x for x in (t or "").split("\n") if H.words(x)]
        assert got[d].n_words == len(w) and got[d].word_chars == sum(map(len, w)), d
        assert got[d].n_symbols == sum(c in "#*$%&|<>" for c in t or ""), d
        assert got[d].n_dup_lines == len(lines) - len(set(lines)), d
        if len(w) < 1000:
            assert got[d].n_repeat_words == H.repeat_words(w), d


def test_bad_host_is_rejected_and_small_hosts_are_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, good, f"h{i % 9}") for i in range(900)] + [(1000 + i, "too short", "bad") for i in range(95)]
    rows += [(2000 + i, good, "bad") for i in range(5)] + [(3000, "too short", "tiny"), (3001, good, None), (3002, None, None)]
    out = {r.doc_id: r for r in host_rules.judge(H.frame(spark, rows)).collect()}
    assert len(out) == len(rows)
    assert not out[2000].base_failed and not out[2000].kept and out[2000].host_rejected
    assert not out[3000].host_rejected and out[3001].kept and not out[3002].kept
    assert all(out[i].kept for i in range(900))


def test_prior_tells_spread_between_hosts_from_sampling(spark):
    rng = np.random.default_rng(9)
    def weight(rows):
        hosts = spark.createDataFrame([(f"h{i}", int(n), *[int(a)] * 4) for i, (n, a) in enumerate(rows)],
                                      "source string, n long, short long, repeats long, symbols long, lines long")
        alpha, beta = host_rules.prior(hosts)["short"]
        return alpha / (alpha + beta), alpha + beta
    # Hosts of one document each say nothing about hosts: rates 0 and 1 are sampling.
    mean, total = weight([(1, rng.random() < 0.3) for _ in range(2000)] + [(100, 30)])
    assert mean == pytest.approx(0.3, abs=0.04) and total > 50
    # Rates drawn from a beta of weight 5, hosts of 2 to 200 documents.
    n = rng.integers(2, 200, 3000)
    mean, total = weight(zip(n, rng.binomial(n, rng.beta(2, 3, 3000))))
    assert mean == pytest.approx(0.4, abs=0.02) and total == pytest.approx(5, rel=0.15)


# --- licences --------------------------------------------------------------------------------------------------------------

def test_license_rules_match_in_order(spark):
    apache = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
              "the License.\nYou may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\nUnless required by "
              "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
              "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
              "governing permissions and limitations under the License.")
    rows = [(1, apache), (2, "Text.\nReleased under the MIT License."), (3, "This work is licensed under the GNU General Public License, "
            "version 3. Also: Licensed under CC BY-NC 4.0."), (4, None), (5, ""), (6, "The MIT license is nice."),
            (7, "Also: text!\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.\nReleased under the MIT License.")]
    out = {r.doc_id: (r.licenses, r.verdict, r.sentence_ids) for r in license_rules.scan(H.frame(spark, rows)).collect()}
    assert out[1] == ("Apache-2.0", "permissive", "ap2 ap3 ap4 ap5")
    assert out[2] == ("MIT", "permissive", "mi1") and out[3][1] == "copyleft" and out[4] == out[5] == out[6] == ("", "none", "")
    assert out[7][:2] == ("MIT,CC-BY-NC-4.0", "noncommercial")


MIT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """   Copyright 2020 Jane Doe

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""


@pytest.mark.parametrize("leader", ["", "# ", "// ", " * ", "REM ", "dnl "])
def test_wrapped_license_notices_are_found(spark, leader):
    rows = [(k, "".join(f"{leader}{line}".rstrip() + "\n" for line in text.splitlines()) + "\nint main() { return 0; }\n")
            for k, text in enumerate((MIT, BSD, APACHE, GPL))]
    rows += [(4, "Released.\nUnder the MIT License"), (5, "x released under\nthe MIT License"), (6, MIT.replace("free of charge", "freely"))]
    out = {r.doc_id: (r.licenses, r.sentence_ids) for r in license_rules.scan(H.frame(spark, rows)).collect()}
    assert [out[k] for k in range(4)] == [("MIT", "mi2 mi3"), ("BSD-3-Clause", "bs1 bs2 bs3"), ("Apache-2.0", "ap2 ap3 ap4 ap5"),
                                          ("GPL-3.0", "gp2 gp3 gp4")]
    assert [out[k] for k in (4, 5, 6)] == [("", ""), ("", ""), ("", "mi3")]


# --- byte-level BPE --------------------------------------------------------------------------------------------------------

def test_bpe_equals_tiktoken(spark, odd_rows):
    import public_tokenizers
    import tiktoken

    path, pattern = byte_bpe.public_vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    rows = odd_rows + [(100 + i, "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), 10, 32, 0x3000]))
                                         for _ in range(200))) for i in range(60)]
    rows += [(200, "x" * 5000), (201, "".join(rng.choice("etaoin") for _ in range(3000))), (202, "I'LL don't  \n\n ' s'll<|endoftext|>")]
    docs = H.frame(spark, rows)
    encoded = byte_bpe.encode(docs, path, pattern, carry=("doc_id", "text"), decoded=True).collect()
    assert len(encoded) == len(rows)
    for r in encoded:
        assert r.ids == np.array(library.encode_ordinary(r.text or ""), dtype="<u4").tobytes(), r.doc_id
        assert bytes(r.decoded).decode() == (r.text or "")
    back = byte_bpe.decode(byte_bpe.encode(docs, path, pattern), path, pattern).collect()
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in back) == Counter((d, t or "") for d, t in rows)


# --- language model --------------------------------------------------------------------------------------------------------

def test_language_model_counts_and_held_out_gain(spark, monkeypatch):
    monkeypatch.setattr(pyp_lm, "BUCKET_TOKENS", 20_000)      # several buckets
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = pyp_lm.score(docs).collect()
    tokens = {r.doc_id: [*H.words(H.lower(r.text)), None] for r in docs.select("doc_id", "text").collect()}
    counts = Counter(x for d, w in tokens.items() if H.remainder(d, 7) != 2 for x in w)
    total, distinct = sum(counts.values()), len(counts)
    held = [r for r in out if r.held_out]
    assert len(out) == len(tokens) and {r.doc_id for r in held} == {d for d in tokens if H.remainder(d, 7) == 2}
    for r in out:
        w = tokens[r.doc_id]
        base = sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in counts for x in w), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)


def packed(token, context):
    """Counts of tokens by context as the tasks send them."""
    order = np.lexsort((context, token))
    token, context = token[order], context[order]
    new = np.append(True, (token[1:] != token[:-1]) | (context[1:] != context[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(token))).astype("<u2")
    return pyp_lm.pack(*pyp_lm._runs(token[first]), context[first].astype("<u2"), count)


def learned_history(counts):
    """Totals before the first sweep and after each, from one bucket alone."""
    place = counts.key % pyp_lm.CONTEXTS
    customers, tables = (np.bincount(place, weights=x, minlength=pyp_lm.CONTEXTS).astype(int)
                         for x in (counts.c, pyp_lm.start(counts.c, pyp_lm.DISCOUNT)))
    s = pyp_lm.Seating.of(counts)
    history = [pyp_lm.Totals(customers, tables, (int(s.sat.sum()), int(s.parent_t.sum())), len(counts.words))]
    for _ in range(pyp_lm.SWEEPS):
        s = pyp_lm.Seating.of(counts)
        *_, (t, sat, parent_t) = s.sweeps(history)
        history.append(history[0].next(tables + s.more(), (int(sat.sum()), int(parent_t.sum()))))
    return history


def test_language_model_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    token, context = rng.zipf(1.3, 4000).astype(np.uint64) % 300, rng.integers(0, 5, 4000)
    counts = pyp_lm.Counts([packed(token, context)]).merge()
    history = learned_history(counts)
    assert counts.c.sum() == 4000
    for t, sat, parent_t in pyp_lm.Seating.of(counts).sweeps(history[:-1]):
        assert (t >= 1).all() and (t <= counts.c[counts.c > 1]).all() and (parent_t <= sat).all()
    words = np.unique(token)
    scorer = pyp_lm.Scorer(counts, history)
    for u in (0, 3, 4000):
        known = np.append(words, np.uint64(10 ** 9))          # the last stands for the unknown
        data = pyp_lm.pack(known.astype("<u8"), np.ones(len(known), dtype="<u4"), np.full(len(known), u, dtype="<u2"),
                           np.arange(len(known), dtype="<u2"))
        score = pyp_lm.unpack(scorer.sums(data), "<u2", "<u4", "<f8", "<f8")[3]
        assert (10 ** score).sum() == pytest.approx(1.0)


def test_counts_are_merged_as_they_arrive(monkeypatch):
    rng = np.random.default_rng(1)
    blobs = [packed(rng.integers(0, 40, 500).astype(np.uint64), rng.integers(0, 7, 500)) for _ in range(20)]
    whole = pyp_lm.Counts(blobs).merge()
    monkeypatch.setattr(pyp_lm, "WAITING", 300)
    pieces, most = pyp_lm.Counts(), 0
    for blob in blobs:
        pieces.add(blob)
        most = max(most, pieces._size)
    pieces.merge()
    assert most <= 300 and whole.c.sum() == 10_000
    for a, b in ((whole.words, pieces.words), (whole.key, pieces.key), (whole.c, pieces.c)):
        assert (a == b).all()


def one_by_one(pairs, words, sweeps, rng):
    """An independent sampler: every customer in turn leaves and sits down again, in context and parent.

    Returns mean tables of each pair and the mean probability of each pair over the sweeps after the first third.
    """
    d, s, d0, s0 = pyp_lm.DISCOUNT, pyp_lm.STRENGTH, pyp_lm.PARENT_DISCOUNT, pyp_lm.PARENT_STRENGTH
    seats = {(u, w): [1] * c for (u, w), c in pairs.items()}       # customers by table
    parent = {w: [1] * sum(len(t) for (_, x), t in seats.items() if x == w) for w in words}
    n_tables = {u: sum(len(t) for (x, _), t in seats.items() if x == u) for u, _ in seats}
    total = Counter()
    for (u, _), c in pairs.items():
        total[u] += c

    def leave(tables):
        k = rng.choices(range(len(tables)), tables)[0]
        tables[k] -= 1
        if not tables[k]:
            del tables[k]
            return True
        return False

    def sit(tables, discount, new):
        k = rng.choices(range(len(tables) + 1), [n - discount for n in tables] + [new])[0]
        if k == len(tables):
            tables.append(1)
            return True
        tables[k] += 1
        return False

    def uniform():
        return (s0 + d0 * sum(map(len, parent.values()))) / (len(words) + 1)

    def odds(w):
        everyone = sum(map(sum, parent.values()))
        return (sum(parent[w]) - d0 * len(parent[w]) + uniform()) / (s0 + everyone)

    tables, p, samples = Counter(), Counter(), 0
    for step in range(sweeps):
        for (u, w), mine in seats.items():
            for _ in range(pairs[u, w]):
                if leave(mine):
                    n_tables[u] -= 1
                    leave(parent[w])
                if sit(mine, d, (s + d * n_tables[u]) * odds(w)):
                    n_tables[u] += 1
                    sit(parent[w], d0, uniform())
        if step >= sweeps // 3:
            samples += 1
            for (u, w), mine in seats.items():
                tables[u, w] += len(mine)
                p[u, w] += (pairs[u, w] - d * len(mine) + (s + d * n_tables[u]) * odds(w)) / (s + total[u])
    return {k: v / samples for k, v in tables.items()}, {k: v / samples for k, v in p.items()}


def test_probabilities_are_those_of_an_independent_sampler(monkeypatch):
    monkeypatch.setattr(pyp_lm, "SWEEPS", 80)                  # long enough to compare means
    monkeypatch.setattr(pyp_lm, "SAMPLES", 60)
    rng = random.Random(3)
    pairs = Counter((rng.randrange(3), min(7, int(rng.expovariate(0.5)))) for _ in range(150))
    words = sorted({w for _, w in pairs})
    tables, p = one_by_one(pairs, words, 300, rng)
    token = np.array([w for (_, w), c in pairs.items() for _ in range(c)], dtype=np.uint64)
    context = np.array([u for (u, _), c in pairs.items() for _ in range(c)])
    counts = pyp_lm.Counts([packed(token, context)]).merge()
    history = learned_history(counts)
    scorer = pyp_lm.Scorer(counts, history)
    got = sum(h.tables.sum() for h in history[-pyp_lm.SAMPLES:]) / pyp_lm.SAMPLES
    assert got == pytest.approx(sum(tables.values()), rel=0.05)
    for (u, w), expected in p.items():
        data = pyp_lm.pack(np.array([w], dtype="<u8"), np.array([1], dtype="<u4"), np.array([u], dtype="<u2"), np.array([0], dtype="<u2"))
        assert 10 ** pyp_lm.unpack(scorer.sums(data), "<u2", "<u4", "<f8", "<f8")[3][0] == pytest.approx(expected, rel=0.05, abs=0.002)


@pytest.mark.parametrize("c, w", [(10, 3.0), (100, 20.0), (1000, 150.0), (100_000, 480.0)])
def test_tables_have_the_odds_of_seating_one_by_one(c, w):
    """Customers are added one by one to the odds of each number of tables (cut off far above the mean)."""
    d, most = pyp_lm.DISCOUNT, min(c, int(3 * w) + 20)
    t = np.arange(most + 1)
    log = np.full(most + 1, -np.inf)
    log[1] = math.log(w)
    for n in range(1, c):
        with np.errstate(divide="ignore", invalid="ignore"):
            join = np.where(t <= n, log + np.log(np.maximum(n - d * t, 1e-300)), -np.inf)
        log = np.logaddexp(join, np.append(-np.inf, log[:-1] + math.log(w)))
    odds = np.exp(log - log.max())
    mean = (odds * t).sum() / odds.sum()
    spread = math.sqrt((odds * (t - mean) ** 2).sum() / odds.sum())
    got = pyp_lm.seat(np.random.default_rng(5).random(20_000), np.full(20_000, c), np.full(20_000, w), d)
    assert got.mean() == pytest.approx(mean, rel=0.01) and got.std() == pytest.approx(spread, rel=0.05)
    assert (got >= 1).all() and (got <= c).all()


def test_sweeps_seat_all_customers():
    """Sampled tables follow from counts and weights at any count, not from where they start."""
    words = np.arange(1, 41, dtype="<u8")
    blob = pyp_lm.pack(words, np.full(40, 50, dtype="<u4"), np.tile(np.arange(50, dtype="<u2"), 40), np.full(2000, 60_000, dtype="<u2"))
    counts = pyp_lm.Counts([blob]).merge()
    history = learned_history(counts)
    *_, (t, sat, parent_t) = pyp_lm.Seating.of(counts).sweeps(history[:-1])
    weight = np.full(len(t), (pyp_lm.STRENGTH + pyp_lm.DISCOUNT * history[-2].tables.sum() / 50) / 40)
    expected = pyp_lm.seat(np.random.default_rng(5).random(len(t)), np.full(len(t), 60_000), weight, pyp_lm.DISCOUNT).mean()
    assert t.mean() == pytest.approx(expected, rel=0.2)
    assert t.mean() > round(60_000 ** 0.4) + 11 and parent_t.max() > 12


def test_scores_do_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    """Buckets of one, three and ten; a frequent token's bucket is dealt to several tasks; odd rows among them."""
    rows = [(i, "the " * 50 + f"word{i % 7} other{i}") for i in range(300)]
    rows += [(1000, None), (1001, ""), (None, "the word1 the"), (None, None), (5, rows[5][1]), (5, rows[5][1]), (1002, "The wOrd2 the\n" * 4000)]
    chars, out = sum(len(t or "") for _, t in rows), []
    for buckets in (1, 3, 10):
        monkeypatch.setattr(pyp_lm, "BUCKET_TOKENS", math.ceil(chars / 6 / buckets))
        got = [tuple(r) for r in pyp_lm.score(H.frame(spark, rows)).collect()]
        out.append(sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[2])))
        assert len(got) == len(rows)
    for a, b, c in zip(*out):
        assert a[:5] == b[:5] == c[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-6) and a[5:] == pytest.approx(c[5:], rel=1e-6)
    by_id = {r[0]: r for r in out[0]}
    assert by_id[1000][2:] == by_id[1001][2:] and by_id[1000][2] == 1 and by_id[1002][2] == 12_001
    assert len({r[2:] for r in out[0] if r[0] == 5}) == 1 and sum(r[0] is None for r in out[0]) == 2


# --- licences by name and further notices ------------------------------------------------------------------------------------

GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version."""
AGPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU Affero General Public License as
    published by the Free Software Foundation, either version 3 of the
    License, or (at your option) any later version."""
MPL2 = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
UNLICENSE = "This is free and unencumbered software released into the public domain."


@pytest.mark.parametrize("text,licences,verdict", [
    (GPL2, "GPL-2.0", "copyleft"), (AGPL3, "AGPL-3.0", "copyleft"), (MPL2, "MPL-2.0", "copyleft"), (ISC, "ISC", "permissive"),
    (UNLICENSE, "Unlicense", "permissive"), ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0", "copyleft"),
    ("# SPDX-License-Identifier: MIT", "MIT", "permissive"), ("Licensed under the MIT License.", "MIT", "permissive"),
    ("This project is released under the MIT License.", "MIT", "permissive"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0", "copyleft"),
    ("SPDX-License-Identifier: (Apache-2.0 OR MIT)", "MIT,Apache-2.0", "permissive"),
    ("The code is licensed under the Apache License, Version 2.0 and the MIT licence.", "MIT,Apache-2.0", "permissive"),
    ("The data are available under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0", "noncommercial"),
    # Near misses.
    ("The MIT license is nice.", "", "none"), ("He was released under the Boost bridge.", "", "none"), ("Licensed under the Made-up License.", "", "none"),
    ("We spoke of what is licensed under the MIT License yesterday.", "", "none"), ("SPDX-License-Identifier: NONE", "", "none"),
    ("Permission to use, copy, modify, and/or distribute this hardware is hereby granted.", "", "none")])
def test_licences_are_known_by_notice_and_by_name(spark, text, licences, verdict):
    out = license_rules.scan(H.frame(spark, [(1, "Some words before.\n\n" + text + "\nand words behind")])).first()
    assert (out.licenses, out.verdict) == (licences, verdict)


def test_names_in_sql_are_the_same(spark):
    import duckdb
    rows = [(k, t) for k, t in enumerate([
        "Licensed under the MIT License.", "SPDX-License-Identifier: GPL-3.0-only WITH Classpath-exception-2.0", "SPDX-License-Identifier: (Apache-2.0 OR MIT)",
        "Released under the MIT License. This dataset is published under the terms of the EUPL-1.2 licence!", None, "", "spdx license identifier", UNLICENSE,
        "x spdx license identifier 0bsd and isc\nlicensed under mit or later", "Licensed under CC BY 4.0.", "Provided under the license license."])]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cur = con.execute(license_rules.ORACLE)
    names = [d[0] for d in cur.description]
    got = license_rules.scan(H.frame(spark, rows)).select(*names).collect()
    assert Counter(tuple(r) for r in got) == Counter(cur.fetchall())
    assert len({i for _, i in license_rules.NAMES.items()}) == len(license_rules.NAMED) >= 30


# --- top-k search ----------------------------------------------------------------------------------------------------------

def test_search_equals_brute_force(spark, monkeypatch):
    for name, value in (("PIVOTS", 5), ("RINGS", 3), ("BLOCK", 40), ("QUERY_BLOCK", 4), ("SAMPLE", 100)):
        monkeypatch.setattr(pivot_index, name, value)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(700)] + [(1000 + i, [0.5] * 8) for i in range(200)]
    rows += [(2000, None), (2100, [float("nan")] * 8), (2200, [None] * 8), (2300, [float("inf")] * 8), (None, [1.0] * 8), (2400, [1.0, 2.0]),
             (2500, []), (1100, [0.25] * 8)]
    vectors = pivot_index.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = pivot_index.search(vectors, vectors.filter("vec_id % 100 = 0")).collect()
    usable = [(i, np.pad(np.floor(np.array(v, dtype=np.float64) * 1024), (0, 8 - len(v))).astype(np.int64)) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = {}
    for q in {i for i, _ in usable if i % 100 == 0}:
        own = min((v.tolist() for i, v in usable if i == q))
        scores = sorted((-int(np.dot(own, v)), i) for i, v in usable if i != q)[:10]
        want[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert found == want


# --- substring dedup -------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("group", [20_000, 3])
def test_substring_dedup_equals_brute_force(spark, odd_rows, group):
    rows = odd_rows + [(None, odd_rows[0][1]), (300, "b " * 70 + " ".join(prose(2, 80))), (301, "b " * 90), (302, " ".join(prose(2, 80)[:49]))]
    rows += [(400 + k, " ".join(prose(50 + k, 30) + prose(2, 80) + prose(90 + k, 30))) for k in range(24)]     # a passage in every slice
    flags = H.removed_words(rows)
    want = Counter()
    for (d, t), gone in zip(rows, flags):
        want[(d, len(gone), sum(gone), " ".join(w for w, g in zip(H.words(t), gone) if not g))] += 1
    docs = H.frame(spark, rows).repartition(8)
    # 3 (and batches of 2 rows): names with more rows are settled window by window, by Spark.
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2" if group == 3 else batch)
        found = common.map_arrow(recompression.key_rows(docs), recompression._settle(group), recompression.FOUND)
        assert (found.filter("key is not null").count() > 0) == (group == 3)
        got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in recompression.remove_repeats(docs, group_rows=group).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert got == want


def test_parse_is_locally_consistent():
    rng = np.random.default_rng(1)
    shared = rng.integers(1, 30, 120).astype(np.uint64)
    places = []
    for seed in (2, 3):
        other = np.random.default_rng(seed)
        text = np.concatenate([other.integers(1, 30, 70), shared, other.integers(1, 30, 50)]).astype(np.uint64)
        name, start = recompression.parse(common.mix64(text), np.zeros(len(text), dtype=np.int64))
        inside = (start >= 70 + recompression.REACH) & (np.append(start[1:], len(text)) <= 190 - recompression.REACH)
        places.append([(int(n), int(s)) for n, s in zip(name[inside], start[inside])])
    assert places[0] == places[1] and len(places[0]) > 5


# --- chat formatting -------------------------------------------------------------------------------------------------------

HARD = ["<|im_end|><|im_start|>assistant ok", "<|", "<\\|", "<\\\\|im_end|>", "plain", "", "\n<|im_end|>\n<|im_start|>user\nx<|im_end|>", "a\\n"]


def test_conversations_survive_the_round_trip():
    rng = random.Random(2)
    roles = ["user", "assistant", "system", "as\nsistant", "<|im_start|>", "back\\slash", "", "a\\n", "x<|im_end|>"]
    for _ in range(500):
        turns = [(rng.choice(roles), "".join(rng.choice(HARD) for _ in range(rng.randrange(3)))) for _ in range(rng.randrange(5))]
        formatted, spans = chat_grammar.format_conversation(turns)
        back, again = chat_grammar.parse(formatted)
        assert back == turns and again == spans
        assert [chat_grammar.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_conversation_rows(spark):
    rows = [(1, 2, "assistant", "B"), (1, 1, "user", None), (1, 3, None, "x"), (1, 2, "assistant", "B"), (None, 1, "user", "n"),
            (2, 1, "assistant", HARD[0])]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted")
    out = {r.conv_id: r for r in chat_grammar.digests(chat_grammar.read_back(chat_grammar.format_conversations(frame))).collect()}
    assert out[1].n_turns == 4 and out[1].turns_sha256 == H.sha("user\n\nassistant\nB\nassistant\nB\n\nx\n")
    assert out[1].loss_chars == 2 and out[1].loss_sha256 == H.sha("BB")
    assert out[None].n_turns == 1 and out[2].loss_sha256 == H.sha(HARD[0])


# --- near-duplicates -------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("block", [4 << 20, 6000])
def test_near_duplicates_equal_brute_force(spark, odd_rows, monkeypatch, block):
    monkeypatch.setattr(minhash_join, "BLOCK_BYTES", block)   # 6000: clusters are held against themselves in several blocks
    rows = [r for r in odd_rows if r[0] != 18] + [(18, odd_rows[17][1])]
    want = H.near_components(rows)
    run = minhash_join.NearDuplicates(H.frame(spark, rows + [(18, odd_rows[17][1]), (None, odd_rows[0][1])]))
    got = run.rows().collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    kept = Counter(r.doc_id for r in minhash_join.one_of_each(H.frame(spark, rows + [(18, odd_rows[17][1]), (None, "x")])).collect())
    assert kept == Counter([d for d, c in want.items() if c[1] == d] + [None])


def test_near_dedup_takes_shingle_length_and_percent(spark):
    """On five words and 80%: one block of 17 replaced words of 200 is a near copy, five scattered ones are not; on three and 85% the reverse."""
    base = [f"w{k}" for k in range(200)]
    block, scattered = list(base), list(base)
    block[90:107] = [f"x{k}" for k in range(17)]
    for k in (20, 60, 100, 140, 180):
        scattered[k] = f"y{k}"
    rows = [(1, " ".join(base)), (2, " ".join(block)), (3, " ".join(scattered)), (4, "another text")]
    for size, percent, want in ((5, 80, [1, 3, 4]), (3, 85, [1, 2, 4])):
        assert sorted(d for d, (_, c) in H.near_components(rows, size, percent).items() if c == d) == want
        out = minhash_join.one_of_each(H.frame(spark, rows), shingle=size, percent=percent)
        assert sorted(r.doc_id for r in out.collect()) == want
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = H.near_components([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    out = minhash_join.one_of_each(docs, shingle=5, percent=80)
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, (_, c) in want.items() if c == d)


def test_matches_follow_the_similarity():
    for percent in (85, 80):
        p, m = (percent / 100) ** 2, minhash_join.least_matches(percent)
        below = [sum(math.comb(32, k) * p ** k * (1 - p) ** (32 - k) for k in range(n)) for n in (m, m + 1)]
        assert below[0] < 1e-6 <= below[1]
    assert minhash_join.least_matches(85) == 10


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 3), (200, 200)]
    out = dict(tuple(r) for r in minhash_join.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(out[i] == 0 for i in range(41)) and all(out[100 + i] == 100 for i in range(20))


# --- quality classifier ----------------------------------------------------------------------------------------------------

def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    out = fm_classifier.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = out.filter("held_out").select("quality", "predicted", "score").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert sum(r.quality == r.predicted for r in rows) > 0.98 * len(rows)


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    machine = fm_classifier.Machine()
    machine.linear, machine.factors = rng.normal(size=fm_classifier.WIDTH), rng.normal(size=(fm_classifier.WIDTH, fm_classifier.RANK))
    x = np.zeros((1, fm_classifier.WIDTH))
    at = rng.choice(fm_classifier.WIDTH, 12, replace=False)
    x[0, at] = rng.normal(size=12)
    pairs = sum(machine.factors[i] @ machine.factors[j] * x[0, i] * x[0, j] for k, i in enumerate(at) for j in at[k + 1:])
    assert machine._logit(x)[0][0] == pytest.approx(x[0] @ machine.linear + pairs)


def test_classifier_scores_odd_texts_and_learns_without_labels(spark, odd_rows):
    docs = H.frame(spark, odd_rows).withColumn("n_chars", F.when(F.col("doc_id") > 3, F.col("n_chars")))
    machine = fm_classifier.train(docs, spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int"))
    scores = fm_classifier.score(docs, machine).collect()
    assert len(scores) == len(odd_rows) and all(r.score == 0.5 for r in scores)


# --- empty tables ----------------------------------------------------------------------------------------------------------

def test_empty_tables_give_empty_results(spark):
    docs = spark.createDataFrame([], H.DOCUMENTS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.mix(docs, mixing.n_words(F.col("text"))).count() == mixing.mixed_documents(docs).count() == 0
    assert host_rules.judge(docs).count() == license_rules.scan(docs).count() == 0
    assert byte_bpe.encode(docs, *byte_bpe.public_vocabulary()).count() == 0
    assert pyp_lm.score(docs).count() == 0
    assert recompression.remove_repeats(docs).count() == 0
    assert minhash_join.NearDuplicates(docs).rows().count() == minhash_join.one_of_each(docs).count() == 0
    assert fm_classifier.score(docs, fm_classifier.train(docs, labels)).count() == 0
    vectors = pivot_index.integer_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert pivot_index.search(vectors, vectors).count() == 0
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_grammar.read_back(chat_grammar.format_conversations(rows)).count() == 0
