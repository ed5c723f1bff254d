"""The pipeline against a plain composition of its stages, and the registered queries that SQL can't express."""

import hashlib
import html
import os
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_native import brute_contamination, brute_lines
from tests.llm.test_neardup import brute
from tideline.llm import spiece as P

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, folder = random.Random(21), tmp_path_factory.mktemp("tables")
    vocabulary = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 9))) for _ in range(500)]

    def text(n):
        return " ".join(rng.choices(vocabulary, k=n))

    shared = [f"Shared line number {i} {text(12)}" for i in range(3)]
    items = [(i, text(25)) for i in range(8)]
    docs, toxic = [], set()
    for i in range(400):
        body = text(rng.randint(30, 80))
        if i % 3 == 0:
            toxic.add(i)
            w = body.split()
            for _ in range(6):
                w.insert(rng.randrange(len(w)), f"zzvile{rng.choice(vocabulary)[:2]}")
            body = " ".join(w)
        elif i % 10 == 1 and i > 20:
            base = rng.choice([d for d in docs if d[0] % 3])[1].split("\n")[0].split()
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
            body = " ".join(base)
        elif i % 17 == 2:
            body = f"{body} {items[i % 8][1]} {text(3)}"
        if i % 5 == 0:
            body = f"{body}\n{rng.choice(shared)}"
        docs.append((i, body, "en", f"src{i % 3}", len(body)))
    docs += [(400, "", "en", "src0", 0), (401, None, None, None, 0)]
    labels = [(i, 1, int(i in toxic)) for i in range(0, 400)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs, items, toxic


def test_pipeline_is_its_stages(spark, tables):
    folder, docs, items, toxic = tables
    rows = [(i, t) for i, t, *_ in docs if i not in toxic]
    rows = [(i, brute_lines(rows)[i][0]) for i, _ in rows]
    kept = {i for i, _, _, k in brute(rows) if k}
    clean = brute_contamination(rows, items)
    rows = [(i, t) for i, t in rows if i in kept and not clean[i][3]]
    library = P._library(P.read_model())
    want = {i: (library.encode(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows}
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: (r.token_ids, r.decoded_sha256) for r in out} == want
    assert all(r.parity and r.round_trip for r in out)
    dropped = {i for i, *_ in docs} - set(want)
    assert toxic <= dropped and any(clean[i][3] for i in clean) and len(kept) < len(clean)


def test_stages_keep_the_columns_of_documents(spark, tables):
    folder, *_ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), folder).dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_stages_keep_columns_with_names_of_results(spark, tables):
    folder, rows, *_ = tables
    docs = spark.createDataFrame([(*r, f"own {r[0]}", -r[0], "x", None, 7) for r in rows[:40]] + [(500, "z " * 200_000, "en", "s", 5, "own 500", -500, "x", None, 7)] * 2, "doc_id long, text string, lang string, source string, n_chars long, score string, n_dropped long, items string, predicted int, rest int").repartition(3)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes and out.where("score <> concat('own ', doc_id) OR n_dropped <> -doc_id OR items <> 'x' OR predicted IS NOT NULL OR rest <> 7").count() == 0
        assert out.where("doc_id = 500").count() == 2
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.columns == ["doc_id", "lang", "source", "n_chars", "score", "n_dropped", "items", "predicted", "rest", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256", "round_trip", "parity"]
    assert last.where("round_trip AND parity").count() == 42


@needs_data
def test_queries_that_sql_cannot_express(spark):
    q = entry.queries()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tox = {r.doc_id: r for r in q["op3_toxicity"](spark, SF).collect()}
    assert set(tox) == set(docs) and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in tox.items())
    library = P._library(P.read_model())
    for r in q["op4_sentencepiece"](spark, SF).collect():
        ids = library.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest() and r.parity and r.round_trip
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    for r in q["op6_media"](spark, SF).collect():
        raw = docs[r.doc_id].encode()
        payload = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    pages = q["op7_html_extraction"](spark, SF).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in pages:
        inside = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", inside))
        assert r.text == "\n".join(b for b in blocks if b)
    assert len(pages) == spark.read.parquet(f"{SF}/pages.parquet").count() and all(r.n_chars == len(r.text) > 0 and not re.search(r"<\w+|\n\n", r.text) for r in pages)


@needs_data
@pytest.mark.parametrize("name", ["op1_decontamination", "op2_chat_format", "op5_near_duplicates", "op8_license_scan", "op9_warc", "op10_line_dedup"])
def test_query_equals_its_sql(spark, name):
    import duckdb

    from tools.compare import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())
