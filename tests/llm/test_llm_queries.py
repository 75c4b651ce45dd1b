"""Registered training-data queries against their SQL, and the pipeline against brute force, on sf0.001."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from ledgerline.llm import byte_bpe, common, queries
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_each_dealt_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cur = duck.execute(queries.ORACLES[name])
    at = {d[0]: k for k, d in enumerate(cur.description)}
    assert set(at) == set(df.columns)
    want = Counter(tuple(row[at[c]] for c in df.columns) for row in cur.fetchall())
    assert Counter(tuple(r) for r in df.collect()) == want


def test_pipeline_stage_by_stage(spark):
    """Each stage against a brute-force version on its own input."""
    docs = common.read_table(spark, SF, "documents")
    quality = {r.doc_id: r.quality for r in common.read_table(spark, SF, "labels").collect()}
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = common.staged(stage(spark, docs, SF), "test")
        rows[name] = (before, docs.collect(), docs.columns)
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert rows[name][2] == list(common.DOCUMENT_COLUMNS), name

    before, after, _ = rows[names[0]]
    assert {tuple(r) for r in after} <= set(before)
    kept = {r.doc_id for r in after}
    # Its decisions are those of the classifier's query; accuracy is tested where there are enough labels to learn from.
    assert kept == {r.doc_id for r in queries.QUERIES["op1_fm_classifier"](spark, SF).collect() if r.predicted}
    right = [(d in kept) == bool(q) for d, q in quality.items()]
    assert sum(right) > 0.8 * len(right)

    before, after, _ = rows[names[1]]
    component = H.near_components([(r[0], r[1]) for r in before], 5, 80)     # what stages on word shingles take
    assert sorted(r.doc_id for r in after) == sorted(d for d, (_, c) in component.items() if c == d)

    before, after, _ = rows[names[2]]
    flags = H.removed_words([(r[0], r[1]) for r in before])
    want = {r[0]: " ".join(w for w, g in zip(H.words(r[1]), f) if not g) if any(f) else r[1] for r, f in zip(before, flags)}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)

    before, after, _ = rows[names[3]]
    size = Counter()
    for r in before:
        size[r[3]] += len(H.words(r[1]))
    taken = Counter()
    for r in after:
        taken[r.source] += len(H.words(r.text))
    assert sum(taken.values()) == pytest.approx(sum(size.values()), abs=len(size))
    assert all(taken[s] <= 3 * n for s, n in size.items())
    texts = {r[0]: r[1] for r in before}
    whole = Counter(r.doc_id for r in after if r.text == texts[r.doc_id])
    assert max(whole.values()) <= 3 and all(texts[r.doc_id] == r.text or " ".join(H.words(texts[r.doc_id])).startswith(r.text) for r in after)

    before, after, _ = rows[names[4]]
    tokenizer = byte_bpe.Tokenizer(byte_bpe.vocabulary(byte_bpe.public_vocabulary()[0]), byte_bpe.public_vocabulary()[1])
    assert len(after) == len(before) and all(r.round_trip for r in after)
    assert all(tokenizer.decode(bytes(r.ids)).decode() == r.text and r.n_tokens == len(r.ids) // 4 for r in after)


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and out.filter("not round_trip").count() == 0


def odd_table(spark, path, rows):
    """A documents table with clashing extra columns, and labels for some rows."""
    H.frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int(r[0] % 2), 0) for r in rows if r[0] is not None and r[1]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_pipeline_of_odd_rows(spark, tmp_path, monkeypatch):
    # Nulls in any column, empty and very long texts, repeated rows and ids; a classifier that keeps all rows, so every stage meets them.
    words = lambda seed, n: " ".join(f"w{(seed * 7919 + k * (seed + 3)) % 5003}" for k in range(n))
    passage = words(91, 60)
    rows = [(1, words(1, 200), "a"), (2, words(1, 200), "b"), (3, None, "a"), (4, "", "a"), (5, " \n\t", None), (6, words(2, 90) + " " + passage, None),
            (7, words(3, 90) + " " + passage, "b"), (None, words(4, 70), "a"), (None, None, None), (8, words(5, 60_000), "c"),
            (9, words(6, 80), "a"), (9, words(6, 80), "a"), (9, words(7, 80), "a"), (-3, "one", "a"), (10, "é 漢字 🙂 " * 40, "b")]
    odd_table(spark, str(tmp_path / "odd"), rows)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("all", lambda s, d, f: d.select(*common.DOCUMENT_COLUMNS)), *corpus_pipeline.STAGES[1:]])
    out = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    assert all(r.round_trip for r in out) and set(out[0].asDict()) == {*common.DOCUMENT_COLUMNS, "ids", "n_tokens", "round_trip"}
    texts = {d: t for d, t, _ in rows}
    ids = Counter(r.doc_id for r in out)
    assert 2 not in ids and {1, 6, 7, 8, None, 10, -3} <= {r[0] for r in rows} and not {3, 4, 5} & set(ids)
    assert all(passage not in r.text for r in out if r.doc_id == 7)
    long = [r for r in out if r.doc_id == 8]
    assert all(texts[8].startswith(r.text) for r in long)
    # The classifier itself on the same table, trained on its labels: any decision, no crash, whole rows.
    kept = corpus_pipeline.quality(spark, common.read_table(spark, str(tmp_path / "odd"), "documents"), str(tmp_path / "odd")).collect()
    assert not Counter(tuple(r) for r in kept) - Counter((d, t, "en", s, None if t is None else len(t)) for d, t, s in rows)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    odd_table(spark, str(tmp_path / "none"), [])
    out = corpus_pipeline.run(spark, str(tmp_path / "none"))
    assert out.count() == 0 and {"doc_id", "text", "ids", "n_tokens", "round_trip"} <= set(out.columns)
