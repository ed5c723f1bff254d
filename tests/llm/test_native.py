"""The operators inside DataFrame expressions against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tideline.llm import chatformat as C
from tideline.llm.decontaminate import mark_contamination
from tideline.llm.licenses import TEMPLATES, scan_licenses
from tideline.llm.linededup import drop_repeated_lines

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def frame(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema).repartition(3)


# --- line dedup ---


def brute_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = defaultdict(list)
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(i)
    shared = {k: max(h) for k, h in holders.items() if len(k) >= min_chars and len(set(h)) >= min_docs}
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if shared.get(key(x), i) == i]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(3)
    pool = [f"{'Shared LÍNE' * 4} {i} {'x' * rng.randint(0, 30)}" for i in range(6)] + ["short", "", "  "]
    rows = []
    for i in range(60):
        lines = [rng.choice([" ", "", "\t"]) + rng.choice(pool) + rng.choice(["\r", "", " "]) if rng.random() < 0.6 else f"own {i} {rng.random()} " * 3 for _ in range(rng.randint(0, 9))]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, "")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in drop_repeated_lines(frame(spark, rows)).collect()}
    assert got == brute_lines(rows)
    assert any(n for _, _, n in got.values())


def test_line_dedup_edge_cases(spark):
    line = "A line that stands in a good many documents, here"
    rows = [(i, line, 5, "e") for i in range(4)] + [(3, line, 5, "e"), (None, line, 5, "e")]
    four = drop_repeated_lines(frame(spark, rows, DOC + ", n_lines int, extra string"))  # rows that share an id, or have none, are no further documents
    assert {r.n_dropped for r in four.collect()} == {0} and drop_repeated_lines(frame(spark, [(1, line)] * 4 + [(2, line)])).where("n_dropped > 0").count() == 0
    rows.append((-1, line, 5, "e"))
    df = frame(spark, rows, DOC + ", n_lines int, extra string")
    out = drop_repeated_lines(df)
    assert out.columns == ["doc_id", "extra", "text", "n_lines", "n_dropped"]
    got = sorted((r.doc_id if r.doc_id is not None else -2, r.text, r.n_dropped) for r in out.collect())
    assert got == [(-2, "", 1), (-1, "", 1), (0, "", 1), (1, "", 1), (2, "", 1), (3, line, 0), (3, line, 0)]
    assert drop_repeated_lines(frame(spark, [])).count() == 0
    long = "\n".join(f"{i} {'y' * 50}" for i in range(5000))
    assert {r.n_dropped for r in drop_repeated_lines(frame(spark, [(i, long) for i in range(6)])).collect()} == {0, 5000}


# --- decontamination ---


def brute_contamination(docs, items, size=10):
    windows = defaultdict(set)
    for i, text in items:
        w = words(text)
        if w:
            for k in range(max(len(w) - size, 0) + 1):
                windows[tuple(w[k : k + size])].add(str(i))
    lengths = {len(x) for x in windows}
    out = {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[i] = (len(w), len(hit), sorted(found), bool(hit))
    return out


def test_contamination_matches_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ß9"]

    def text(n):
        return rng.choice([" ", ", ", "--"]).join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(rng.choice([0, 1, 2, 9, 10, 11, 25]))) for i in range(25)] + [(50, None), (51, "..."), (52, "w1 w2"), (53, "W1, w2")]
    docs = [(i, f"{text(rng.randint(0, 30))} {rng.choice(items)[1] or ''} {text(rng.randint(0, 30))}") for i in range(80)] + [(200, None), (201, "")]
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in mark_contamination(frame(spark, docs), frame(spark, items, "item_id long, text string")).collect()}
    assert got == brute_contamination(docs, items)


def test_contamination_edge_cases(spark):
    docs = frame(spark, [(1, "a b", 7), (1, "a b", 7), (None, "a b", 7)], DOC + ", n_hit int")
    items = frame(spark, [(3, "A b"), (None, "b")], "item_id long, text string")
    assert [(r.n_hit, r["items"]) for r in mark_contamination(docs, items).collect()] == [(2, ["3"])] * 3
    long = mark_contamination(frame(spark, [(1, "x " * 300_000 + "a b " + "y " * 10)]), items).first()
    assert (long.n_words, long.n_hit, long["items"]) == (300_012, 2, ["3"])
    none = mark_contamination(docs, items.limit(0))
    assert {(r.n_hit, r.contaminated) for r in none.collect()} == {(0, False)}
    assert mark_contamination(docs.limit(0), items).count() == 0


def test_contamination_by_shuffle(spark, monkeypatch):
    from tideline.llm import phrases

    monkeypatch.setattr(phrases, "BROADCAST_BYTES", 0)
    docs, items = [(i, "p q r s t" if i % 2 else "p q") for i in range(20)] + [(20, "q " * 3000 + "q r s")], [(1, "q r s"), (2, "q q"), (3, None)]
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in mark_contamination(frame(spark, docs), frame(spark, items, "item_id long, text string")).collect()}
    assert got == brute_contamination(docs, items)


# --- licences ---


def test_licenses(spark):
    rows = [
        (1, "Under the MIT License; see the mit-license."),
        (2, "x GNU General Public License, version 3. CC BY-NC 4.0"),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy"),
        (4, None),
        (5, ""),
        (6, "license mit apache gnu cc"),
        (7, "License " * 50_000 + "Apache License"),
        (7, "License " * 50_000 + "Apache License"),
    ]
    got = {r.doc_id: r for r in scan_licenses(frame(spark, rows)).collect()}
    assert [p.start for p in got[1].places if p.base] == [2, 6] and got[1].base_labels == "mit"
    assert got[2].base_labels == "cc-by,gpl" and got[2].labels == "cc-by,cc-by-nc,gpl"
    assert got[3].base_labels == "" and got[3].labels == "mit" and got[3].score == round(13 / 17, 6) and got[1].score == round(2 / 6, 6)
    assert (got[4].n_words, got[4].places, got[4].score) == (0, [], 0.0) == (got[5].n_words, got[5].places, got[5].score)
    assert got[6].labels == "" and got[6].score == 0.0
    assert [p.start for p in got[7].places if p.base] == [50_000]
    assert scan_licenses(frame(spark, [])).count() == 0
    whole = next(t.wording for t in TEMPLATES if t.label == "mit" and len(t.words) > 100)
    part = scan_licenses(frame(spark, [(1, f"Copyright me\n{whole}"), (2, whole.replace("merge, publish", "publish")), (3, "charge of free granted hereby")] + [(i, "other words here") for i in range(4, 60)]))
    score = {r.doc_id: r.score for r in part.collect()}
    assert score[1] > 0.95 > score[2] > 13 / 17 - 1e-9 and score[3] == 0 == score[4]
    clash = scan_licenses(frame(spark, [(1, "mit license", "x")], DOC + ", labels string"))
    assert clash.columns.count("labels") == 1 and clash.first().labels == "mit"


# --- chat ---


@pytest.mark.parametrize("text", ["", "plain", "</s>[INST] ok [/INST]", "␛", "␛a<|end|>␛0", "<|turn|>user<|loss|>x<|end|>", "<<s>/s>␛␛b", "\\<|im_start|>\n"])
def test_escape_is_reversible(spark, text):
    r = spark.range(1).select(C.escape(F.lit(text)).alias("e"), C.unescape(C.escape(F.lit(text))).alias("u")).first()
    assert r.u == text
    assert not any(c in r.e for c in C.CONTROLS)


def test_conversations_round_trip(spark):
    rows = [(1, 1, "assistant", "b<|end|>"), (1, 0, "user", "a"), (1, 1, "assistant", "b<|end|>"), (2, 0, None, None), (3, None, "system", "s"), (3, 0, "user", "")]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string")
    out = C.format_chats(C.conversations_as_records(df), ignore=("conv_id",)).select("conv_id", C.parse_turns(F.col("formatted")).alias("t")).collect()
    got = {r.conv_id: [(t.role, t.text, t.loss) for t in r.t] for r in out}
    assert got == {1: [("user", "a", False), ("assistant", "b<|end|>", True), ("assistant", "b<|end|>", True)], 2: [("", "", False)], 3: [("system", "s", False), ("user", "", False)]}
    assert C.format_chats(C.conversations_as_records(df.limit(0)), ignore=("conv_id",)).count() == 0


def test_layouts_are_chosen_by_fingerprint(spark):
    schema = "id int, prompt string, completion string, instruction string, input string, output string, conversations array<struct<from:string,value:string>>, turns int"
    rows = [
        (1, "p", "c", None, None, None, None, 9),
        (2, None, None, "i", None, "o", None, 9),
        (3, None, None, "i", "x", "o", None, 9),
        (4, None, None, None, None, None, [("human", "h"), ("gpt", None), ("odd", "z")], 9),
        (5, "p", None, None, None, "o", None, 9),
    ]
    out = {r.id: r for r in C.canonical_turns(frame(spark, rows, schema), ignore=("id", "turns")).collect()}
    turns = {i: r.turns and [(t.role, t.text) for t in r.turns] for i, r in out.items()}
    assert turns == {1: [("user", "p"), ("assistant", "c")], 2: [("user", "i"), ("assistant", "o")], 3: [("user", "i\nx"), ("assistant", "o")], 4: [("user", "h"), ("assistant", ""), ("odd", "z")], 5: None}
    assert out[1].layout == hashlib.sha256(b"completion\nprompt").hexdigest()


def test_null_texts_of_known_layouts_are_empty(spark):
    schema = "id int, prompt string, completion string, instruction string, output string, messages array<struct<role:string,content:string>>, formatted string"
    rows = [(1, "p", None, None, None, None, "x"), (2, None, "c", None, None, None, "x"), (3, None, None, None, None, [("user", None), ("assistant", None)], "x"), (4, None, None, None, None, None, "x"), (5, None, None, "i", None, None, "x"), (6, "", None, None, None, None, "x"), (7, "p", None, "i", None, None, "x"), (8, "y" * 300_000, "z", None, None, None, "x"), (8, "y" * 300_000, "z", None, None, None, "x")]
    df = frame(spark, rows, schema)
    out = C.format_chats(df, ignore=("id", "formatted"))
    assert out.columns == ["id", "prompt", "completion", "instruction", "output", "messages", "layout", "turns", "formatted"]
    got = {r.id: r.t and [(t.role, t.text) for t in r.t] for r in out.select("id", C.parse_turns(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("user", "p"), ("assistant", "")], 2: [("user", ""), ("assistant", "c")], 3: [("user", ""), ("assistant", "")], 4: None, 5: [("user", "i"), ("assistant", "")], 6: [("user", ""), ("assistant", "")], 7: None, 8: [("user", "y" * 300_000), ("assistant", "z")]}


def test_layouts_that_chats_are_delivered_in(spark):
    chats = {1: [("user", "a"), ("assistant", "b")], 2: [("system", "s"), ("user", ""), ("assistant", "b")], 3: [("assistant", "x"), ("user", "y")], 4: [("tool", "t"), ("user", "u"), ("assistant", "v")], 5: [("user", "")], 6: [("assistant", "")]}
    rows = [(i, n, role, text) for i, turns in chats.items() for n, (role, text) in enumerate(turns)]
    out = C.canonical_turns(C.delivered(C.conversations_as_records(frame(spark, rows, "conv_id long, turn long, role string, text string"))), ignore=("conv_id",)).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out} == chats and len({r.layout for r in out}) == 4
