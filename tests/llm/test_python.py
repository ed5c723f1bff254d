"""Operators that run Python: exact round trips, brute force, held-out accuracy, and their edge cases."""

import gzip
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import htmlmodel as H
from tideline.llm import media as M
from tideline.llm import spiece as P
from tideline.llm import toxicity as X
from tideline.llm import warc as W
from tideline.llm._shingles import _super_minhash, shingle_sets

DOC = "doc_id long, text string"
TEXTS = [None, "", "plain text", "É ß 漢字 😀\n\ttab  two ", "x" * 70_000, "plain text"]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], DOC + ", score string").repartition(2)


# --- shingles and signatures ---


def test_shingles_match_python(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("aAbÉ \n\t\x1c 漢") for _ in range(rng.randint(0, 60))) for _ in range(500)] + [None, "q " * 300_000]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = {}
    for text, got in zip(texts, shingle_sets(pa.array(texts)), strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        want = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        assert len(got) == len(want)
        for shingle, h in [(min(want), got[0])] if len(want) == 1 else []:
            assert seen.setdefault(shingle, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("similarity", [0.5, 0.75, 0.9])
def test_super_minhash_estimates_with_less_variance(similarity):
    rng, m, n, errors = np.random.default_rng(1), 128, 100, []
    for _ in range(150):
        u = rng.integers(0, 2**63, n, dtype=np.uint64)
        both = round(similarity * n)
        half = (n - both) // 2
        a, b = np.sort(u[: both + half]), np.sort(np.concatenate([u[:both], u[both + half :]]))
        x = _super_minhash([a, b], m)
        errors.append((x[0] == x[1]).mean() - both / n)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < (similarity * (1 - similarity) / m) ** 0.5


# --- toxicity ---


def test_toxicity_on_held_out_texts(spark):
    rng = random.Random(8)
    plain = ["".join(rng.choices("aeiounrst", k=rng.randint(2, 8))) for _ in range(300)]

    def text(bad):
        w = rng.choices(plain, k=rng.randint(10, 200))
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["scoundrel", "knave"]) + rng.choice(plain)[:2])
        return " ".join(w)

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(900)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 600] + [(600, None), (None, 1)], "doc_id long, toxic int")
    model = X.train(docs(spark, [t for _, t, _ in rows]), labels)
    out = {r.doc_id: r for r in X.score_toxicity(docs(spark, [t for _, t, _ in rows]), model).collect()}
    held = [(out[i], y) for i, _, y in rows if i >= 600]
    assert np.mean([r.predicted == y for r, y in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r, _ in held)
    edge = X.score_toxicity(docs(spark), model)
    assert edge.columns == ["doc_id", "text", "score", "predicted"]
    got = {r.doc_id: r.score for r in edge.collect()}
    assert got[0] == got[1] and got[2] == got[5] and len(got) == 6
    assert X.score_toxicity(docs(spark).limit(0), model).count() == 0
    prior = X.train(docs(spark), labels.limit(0))
    assert {r.score for r in X.score_toxicity(docs(spark), prior).collect()} == {0.5}


def brute_model(rows, labels):
    """The classifier written out text by text with dictionaries: buckets, counts, ratios, features, and the same steps of Adam."""
    import math

    def mixed(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = ((x ^ (x >> shift)) * factor) % 2**64
        return x ^ (x >> 31)

    def grams(text):
        data = text.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
        return {mixed((int.from_bytes(data[i : i + n], "big") + (n << 56)) % 2**64) >> (64 - X.BUCKET_BITS) for n in X.GRAMS for i in range(len(data) - n + 1)}

    sets = {i: grams(t or "") for i, t in rows}
    train = [(sets[i], y) for i, y in labels]
    pos, every = {}, {}
    for s, y in train:
        for g in s:
            every[g] = every.get(g, 0) + 1
            pos[g] = pos.get(g, 0) + y
    share, n = sum(y for _, y in train) / len(train), len(train)
    surety = {g: abs(pos[g] - k * share) / math.sqrt(k * share * (1 - share)) for g, k in every.items() if k >= X.MIN_TEXTS}
    chosen = sorted(sorted((g for g in surety if surety[g] > 0), key=lambda g: (-surety[g], g))[: X.FEATURES])
    space = X.SMOOTHING * (1 << X.BUCKET_BITS)
    p, q = sum(pos.values()) + space, sum(every[g] - pos[g] for g in every) + space
    ratio = {g: math.log((pos[g] + X.SMOOTHING) / p / ((every[g] - pos[g] + X.SMOOTHING) / q)) for g in chosen}
    norm = math.sqrt(max(1.0, sum(ratio[g] ** 2 for s, _ in train for g in s if g in ratio) / n))
    w, prior = dict.fromkeys(chosen, 0.0), (sum(y for _, y in train) + 1) / (n + 2)
    w["b"] = math.log(prior / (1 - prior))
    m, v = dict.fromkeys(w, 0.0), dict.fromkeys(w, 0.0)
    for step in range(1, X.STEPS + 1):
        g = {k: X.PENALTY / n * x for k, x in w.items()} | {"b": 0.0}
        for s, y in train:
            z = sum(ratio[f] / norm * w[f] for f in s if f in ratio) + w["b"]
            e = (1 / (1 + math.exp(-max(-30, min(30, z)))) - y) / n
            g["b"] += e
            for f in s:
                if f in ratio:
                    g[f] += ratio[f] / norm * e
        for k in w:
            m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.999 * v[k] + 0.001 * g[k] ** 2
            w[k] -= 0.1 * (m[k] / (1 - 0.9**step)) / (math.sqrt(v[k] / (1 - 0.999**step)) + 1e-9)
    return {i: 1 / (1 + math.exp(-sum(ratio[g] / norm * w[g] for g in s if g in ratio) - w["b"])) for i, s in sets.items()}


def test_toxicity_is_that_of_a_plain_version(spark):
    rng = random.Random(12)
    words = ["".join(rng.choices("aeiounrst", k=rng.randint(2, 6))) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 14))) + (" Scoundrél" if i % 3 == 0 else "")) for i in range(90)] + [(90, None), (91, ""), (92, "x" * 5000)]
    labels = [(i, int(i % 3 == 0)) for i in range(60)] + [(4, 1), (90, 0)]
    text = docs(spark, [t for _, t in rows])
    model = X.train(text, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in X.score_toxicity(text, model).collect()}
    want = brute_model(rows, labels)
    assert set(got) == set(want) and max(abs(got[i] - want[i]) for i in want) < 1e-4


def test_a_cap_on_labels_leaves_predictions_nearly_unchanged(spark):
    rng = random.Random(9)
    plain = ["".join(rng.choices("aeiounrst", k=rng.randint(2, 8))) for _ in range(300)]

    def text(bad):  # the words tell the classes apart only in part
        w = rng.choices(plain, k=rng.randint(10, 60))
        for _ in range(rng.choice([1, 2]) if bad else rng.choice([0, 0, 0, 1])):
            w.insert(rng.randrange(len(w)), rng.choice(["scoundrel", "knave"]))
        return " ".join(w)

    rows = [(i, text(i % 10 == 0), int(i % 10 == 0)) for i in range(3000)]
    texts = docs(spark, [t for _, t, _ in rows]).cache()
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 2000], "doc_id long, toxic int")
    out = [{r.doc_id: r for r in X.score_toxicity(texts, X.train(texts, labels, rows_per_class=n)).collect()} for n in (2000, 200)]
    whole, capped = ([by[i] for i in range(2000, 3000)] for by in out)
    assert np.mean([a.predicted != b.predicted for a, b in zip(whole, capped, strict=True)]) < 0.05


# --- SentencePiece ---


def test_sentencepiece_parity_and_round_trip(spark):
    import sentencepiece

    data = P.read_model()
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = [*TEXTS, " ", "  a  b ", "▁x ▁", "a\u0000b", "ab" * 3000]
    out = {r.doc_id: r for r in P.encode_documents(docs(spark, texts), data).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        assert out[i].token_ids == ids and out[i].n_tokens == len(ids) and out[i].parity
        assert out[i].ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        assert out[i].decoded == library.decode(ids)
        assert out[i].round_trip == (out[i].decoded == (t or ""))
    assert all(out[i].round_trip for i in range(len(TEXTS)))
    assert P.encode_documents(docs(spark).limit(0), data).count() == 0
    clash = P.encode_documents(docs(spark, ["one two"]).withColumnRenamed("score", "parity").withColumn("extra", F.lit(1)), data)
    assert clash.columns == ["doc_id", "text", "extra", "n_tokens", "token_ids", "decoded", "ids_sha256", "round_trip", "parity"] and clash.first().parity is True


def test_unigram_models_are_rebuilt():
    def field(number, value):
        if isinstance(value, int):
            return bytes([number << 3]) + (bytes([value]) if value < 128 else bytes([value & 127 | 128, value >> 7]))
        return bytes([*([(number << 3) | 2] if number < 16 else []), len(value)]) + value

    def piece(text, score, kind=1):
        import struct

        return field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + field(3, kind))

    import sentencepiece

    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("▁", -3), ("a", -4), ("b", -4), ("ab", -3.5), ("▁a", -3), ("▁ab", -6)]
    trainer = field(3, 1)
    normalizer = field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1)
    data = b"".join(piece(*p) for p in pieces) + field(2, trainer) + field(3, normalizer)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["ab", "aab b", "a b", "", "abab ba"]
    ids, same = P.Codec(data).encode(texts, library)
    assert ids == [library.encode(t) for t in texts] and all(same) and P.Codec(data).decode(ids) == texts


# --- media ---


def test_media_round_trip(spark):
    rows = {r.doc_id: r for r in M.store_as_video(docs(spark)).collect()}
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        video = M.read_avi(bytes(r.media))
        assert M.decode_frames(video.jpegs).tobytes()[: video.payload_bytes] == payload
        assert r.media_sha256 == hashlib.sha256(r.media).hexdigest() and r.media_bytes == len(r.media)
        assert sum(c.n_frames for c in r.clips) == len(video.jpegs)
    assert rows[2][2:] == rows[5][2:] and rows[0][3:] == rows[1][3:]
    assert M.store_as_video(docs(spark).limit(0)).count() == 0
    assert M.clip_rows(docs(spark)).select("doc_id").distinct().count() == 6


@pytest.mark.parametrize("n", [0, 64, 1024, 1088, 40_000])
def test_every_byte_survives(n):
    payload = os.urandom(n) + b"\xff" * 64 + bytes(range(256)) * 2
    video = M.read_avi(M.write_avi(payload))
    assert M.decode_frames(video.jpegs).tobytes()[: video.payload_bytes] == payload


def test_shots_and_damage():
    rng = np.random.default_rng(0)
    dark, light = rng.integers(0, 60, (20, M.HEIGHT, M.WIDTH)), rng.integers(190, 255, (15, M.HEIGHT, M.WIDTH))
    frames = np.concatenate([dark, light, dark]).astype(np.uint8)
    assert M.find_shots(M.histograms(frames)) == [(0, 20), (20, 35), (35, 55)]
    data = M.write_avi(frames.tobytes())
    with pytest.raises(ValueError):
        M.read_avi(data[:-100])
    with pytest.raises(ValueError):
        M.decode_frames([b"\xff\xd8 no frame \xff\xd9"])


def baseline_jpeg(planes, sampling, quant, tables=True, restart=0):
    """A plain encoder of baseline frames: planes of samples, their sampling factors, one quantiser."""
    from tideline.llm import jpeg as J

    h, v = max(x for x, _ in sampling), max(y for _, y in sampling)
    height, width = planes[0].shape
    across, down = -(-width // (8 * h)), -(-height // (8 * v))
    coders = []
    for kind in (J.DC_LUMA, J.AC_LUMA):
        codes, code, k = {}, 0, 0
        for length, n in enumerate(kind[0], 1):
            for _ in range(n):
                codes[kind[1][k]] = (code, length)
                code, k = code + 1, k + 1
            code <<= 1
        coders.append(codes)
    out, bits = b"", []

    def put(value, length):
        bits.extend((value >> (length - 1 - i)) & 1 for i in range(length))

    def number(v):
        n = abs(v).bit_length()
        put(v if v > 0 else v + (1 << n) - 1, n)

    def flush():
        nonlocal out
        bits.extend([1] * (-len(bits) % 8))
        out += np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")
        bits.clear()

    grids = []
    for p, (x, y) in zip(planes, sampling, strict=True):
        full = np.pad(p, ((0, down * 8 * y - p.shape[0]), (0, across * 8 * x - p.shape[1])), mode="edge").astype(float) - 128
        grids.append(full.reshape(down * y, 8, across * x, 8).transpose(0, 2, 1, 3))
    last = [0] * len(planes)
    for mcu in range(across * down):
        if restart and mcu and mcu % restart == 0:
            flush()
            out += bytes([0xFF, 0xD0 + (mcu // restart - 1) % 8])
            last = [0] * len(planes)
        r, c = divmod(mcu, across)
        for i, (x, y) in enumerate(sampling):
            for b in range(y):
                for a in range(x):
                    coef = np.rint(J.BASIS @ grids[i][r * y + b, c * x + a] @ J.BASIS.T / quant).astype(int).ravel()[J.ZIGZAG]
                    d = int(coef[0]) - last[i]
                    last[i] = int(coef[0])
                    put(*coders[0][abs(d).bit_length()])
                    number(d) if d else None
                    run = 0
                    for k in range(1, 64):
                        if not coef[k]:
                            run += 1
                            continue
                        while run > 15:
                            put(*coders[1][0xF0])
                            run -= 16
                        put(*coders[1][run << 4 | abs(int(coef[k])).bit_length()])
                        number(int(coef[k]))
                        run = 0
                    if run:
                        put(*coders[1][0])
    flush()

    def segment(kind, body):
        return bytes([0xFF, kind]) + (len(body) + 2).to_bytes(2, "big") + body

    head = segment(0xE0, b"AVI1") + segment(0xDB, bytes([0]) + bytes([quant] * 64))
    sof = bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(planes)])
    sof += b"".join(bytes([i + 1, x << 4 | y, 0]) for i, (x, y) in enumerate(sampling))
    if tables:
        head += b"".join(segment(0xC4, bytes([k << 4]) + t[0] + t[1]) for k, t in ((0, J.DC_LUMA), (1, J.AC_LUMA)))
    if restart:
        head += segment(0xDD, restart.to_bytes(2, "big"))
    sos = bytes([len(planes)]) + b"".join(bytes([i + 1, 0]) for i in range(len(planes))) + bytes([0, 63, 0])
    return b"\xff\xd8" + head + segment(0xC0, sof) + segment(0xDA, sos) + out + b"\xff\xd9"


@pytest.mark.parametrize("sampling", [[(1, 1)], [(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)]])
@pytest.mark.parametrize("restart", [0, 2])
def test_baseline_frames_of_other_writers(sampling, restart):
    from tideline.llm import jpeg as J

    y, x = np.mgrid[0:37, 0:51]
    image = (128 + 60 * np.sin(x / 7) + 50 * np.cos(y / 5)).astype(np.uint8)
    planes = [image, *(np.full((-(-37 // sampling[0][1]), -(-51 // sampling[0][0])), 90, np.uint8) for _ in sampling[1:])]
    for tables in (True, False):
        back = J.first_component(baseline_jpeg(planes, sampling, 2, tables, restart))
        assert back.shape == image.shape and np.abs(back.astype(int) - image).max() <= 4
    whole = baseline_jpeg(planes, sampling, 2, True, restart)
    for bad in (b"", b"no", whole[:200], whole[:-60], whole.replace(b"\xff\xc0", b"\xff\xc2")):
        with pytest.raises(J.UnknownJpeg):
            J.first_component(bad)


def test_lossless_frames_by_the_general_decoder():
    from tideline.llm import jpeg as J

    frames = np.random.default_rng(4).integers(0, 256, (3, M.HEIGHT, M.WIDTH)).astype(np.uint8)
    for frame, data in zip(frames, M.encode_frames(frames), strict=True):
        assert (J.first_component(data) == frame).all()


def test_clips_of_stored_files(spark):
    dark, light = (np.full((24, 40), v, np.uint8) for v in (20, 220))
    jpegs = [baseline_jpeg([p], [(1, 1)], 4, tables=False) for p in [dark] * 6 + [light] * 4]
    body = b"".join(M._chunk(b"00dc", j) for j in jpegs)
    avih = M._chunk(b"avih", (100_000).to_bytes(4, "little") + bytes(52))
    avi = M._chunk(b"RIFF", b"AVI " + M._chunk(b"LIST", b"hdrl" + avih) + M._chunk(b"LIST", b"movi" + body))
    own = M.write_avi(b"some payload" * 300)
    rows = [(1, avi, "x"), (2, None, "x"), (3, b"", "x"), (4, b"RIFFnothing", "x"), (5, avi[:-30], "x"), (1, avi, "x"), (6, own, "x")]
    df = spark.createDataFrame(rows, "id long, media binary, error string").repartition(2)
    out = M.find_clips(df)
    assert out.columns == ["id", "media", "n_frames", "clips", "error"]
    got = {r.id: (r.n_frames, [(c.first_frame, c.n_frames, c.start_s, c.end_s) for c in r.clips], r.error is None) for r in out.collect()}
    assert got[1] == (10, [(0, 6, 0.0, 0.6), (6, 4, 0.6, 1.0)], True) and got[2] == (0, [], True) and got[6][0] == 4
    assert all(got[i] == (0, [], False) for i in (3, 4, 5)) and M.find_clips(df.limit(0)).count() == 0


# --- html ---


@pytest.mark.parametrize(
    "start",
    [
        "<script>for(i=0;i<n;i++){} // don't</script>", "<script>var s='<!--';</script>", "<style>a:after{content:'<b \"'}</STYLE >", "<textarea><p it's></textarea\n>", "<script>x='</scripts>'</script>",
        '<datalist><option value="x"></datalist>', '<datalist><option>x<option>y</datalist>', '<svg><path d="</svg>', "<datalist>", "<select><option>x</select>",
    ],
)
def test_raw_elements_end_at_their_own_end_tag(start):
    page = H.parse(f"{start}<article><p>Main text</p></article>")
    assert [t for _, _, t in page.segments] == ["Main text"]


def test_an_option_has_an_implied_end():
    assert [t for _, _, t in H.parse("<option>a<option>b<p>Main text</p>").segments] == ["a", "b", "Main text"]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p title=don't>Hello there it's</p>", "Hello there it's"), ("<article><p>Short text.</p></article>", "Short text."), ("<div><p>First bit.</p><p>Second bit.</p></div>", "First bit.\nSecond bit."),
        ("<script>if(a<b)c()</script><article><p>Main text here</p></article>", "Main text here"), ("<article><p>if x <y and z> w then stop</p></article>", "if x <y and z> w then stop"),
        ('<article><p a="x>y" b=\'<p>\' c=d\'e>q</p></article>', "q"), ("plain text &amp; only", "plain text & only"), ("<nav><a href=/>Home</a></nav><footer>Copyright</footer>", ""), ("<article><p>one <z-y hidden>two</z-y></p></article>", "one\ntwo"),
    ],
)
def test_small_pages(page, text):
    assert H.extract([H.parse(page)], H.default_model()) == [text]


def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    page = H.parse("<div><p>a</p><p>b<i>c</i></p></div><ul><li>d<li>e</ul>")
    _, parent, edge, levels = H._forest([page])
    n = len(parent)
    unary, pair = rng.normal(size=n), rng.normal(size=(H.N_EDGES, 2, 2))
    weight = np.zeros((1 << n,))
    states = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    for s, y in enumerate(states):
        weight[s] = np.exp(unary @ y + sum(pair[edge[c], y[parent[c]], y[c]] for c in range(n) if parent[c] >= 0))
    want = (weight[:, None] * states).sum(axis=0) / weight.sum()
    assert np.allclose(H._sum_product(unary, pair, parent, edge, levels)[0], want)


def test_held_out_pages():
    pages = H.labelled_pages(150, seed=1234)
    x, parent, edge, levels = H._forest(pages)
    w, pair = H.default_model()
    p = H._sum_product(x @ w, pair, parent, edge, levels)[0]
    assert ((p > 0.5) == np.array([v for q in pages for v in q.label])).mean() > 0.99


def test_extraction(spark):
    page = (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></ul></nav>"
        '<div class="cookie-notice"><p>We use cookies, and lots of them too</p><button>Fine</button></div><article><h1>A &amp; B</h1><p>One\n  two&nbsp;<b>three.<br>four<p>Five &#x41;&lt;p&gt;'
        '<div class="ad">Buy this now</div><ul><li>Six<li>Seven seven</ul></article><div class="comments"><div class="comment"><p>I like this article a great deal</p></div></div><aside><p>Else</p></aside><footer>&copy; X</footer>'
    )
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "<nav>x</nav><script>never ends"), (5, "u", page), (6, "u", f"<article>{'<p>word word word word.</p>' * 5000}</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = {r.page_id: r for r in H.extract_text(df).collect()}
    assert got[1].text == "A & B\nOne two three. four\nFive A<p>\nSix\nSeven seven" == got[5].text
    assert got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[3].text, got[4].text) == ("", "", "")
    assert got[6].text == "\n".join(["word word word word."] * 5000)
    assert H.extract_text(df.limit(0)).count() == 0


def test_pages_match_their_source(spark):
    """The tables' pages have one article, whose blocks are its h1 and p; all of them come out, and nothing else."""
    path = "/root/testdata/sf0.001/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    import html

    for r in H.extract_text(spark.read.parquet(path)).collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (H.SPACES.sub(" ", html.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", inside))
        assert r.text == "\n".join(b for b in blocks if b)


# --- warc ---


def pages(spark):
    big, other = "<p>é</p>" * 300, "<p>x</p>" * 300
    rows = [(1, "http://a/", big, 1), (2, None, big, 1), (3, "http://a b\r\n", "small", 1), (4, "u", "small", 1), (5, "u", None, 1), (6, "u", "", 1), (7, "u", other, 1), (None, "u", big, 1), (2, None, big, 1), (8, "u", "\r\n\r\n" * 400, 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload int").repartition(3)


def test_warc_round_trip(spark, tmp_path):
    df = pages(spark)
    assert W.write_warc(df, f"file://{tmp_path}/w") == 10
    out = W.read_warc(spark, f"file://{tmp_path}/w").collect()
    got = sorted((str(W.page_of(r.record_id)), r.record_type, W.page_of(r.refers_to) if r.refers_to else None, r.header_length, bytes(r.payload) if r.payload is not None else None) for r in out)
    big, other, crlf = ("<p>é</p>" * 300).encode(), b"<p>x</p>" * 300, b"\r\n\r\n" * 400
    want = [
        ("1", "revisit", 2, len(big), None), ("2", "response", None, len(big), big), ("2", "response", None, len(big), big), ("3", "response", None, 5, b"small"), ("4", "response", None, 5, b"small"),
        ("5", "response", None, 0, b""), ("6", "response", None, 0, b""), ("7", "response", None, len(other), other), ("8", "response", None, len(crlf), crlf), ("None", "revisit", 2, len(big), None),
    ]
    assert got == sorted(want)
    assert all(r.payload_digest == r.header_digest.removeprefix("sha1:") == hashlib.sha1(r.payload).hexdigest() for r in out if r.payload is not None)


def test_warc_filters_are_pushed_down(spark, tmp_path):
    W.write_warc(pages(spark), str(tmp_path / "w"))
    revisits = W.read_warc(spark, str(tmp_path / "w"), "record_id", "record_type").where("record_type = 'revisit'")
    assert revisits.count() == 2
    reader = W.WarcReader(str(tmp_path / "w"), ["record_id", "payload"])
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("record_id",), ("<urn:page:7>", "<urn:page:1>")), GreaterThan(("header_length",), 3)]))
    assert len(left) == 1
    rows = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
    assert [r["record_id"] for r in rows] == ["<urn:page:7>"]


def test_archives_of_other_writers(spark, tmp_path):
    """Plain archives and gzip members without the skip field are read as well."""
    records = [W.build_record(i, "u", b"z" * (5000 * i), hashlib.sha1(b"z" * (5000 * i)).hexdigest(), None) for i in range(4)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    from pyarrow import fs

    for name, kind in (("a.warc.gz", W.Members), ("b.warc", W._plain)):  # block by block as from memory
        with fs.LocalFileSystem().open_input_file(str(tmp_path / name)) as f:
            got = [(h, rest()) for h, rest in kind(W.FileBytes(f, block=7))]
        assert got == [(h, rest()) for h, rest in kind((tmp_path / name).read_bytes())] and len(got) == 4
    out = W.read_warc(spark, str(tmp_path), "record_id", "payload_length").collect()
    assert sorted((W.page_of(r.record_id), r.payload_length) for r in out) == sorted([(i, 5000 * i) for i in range(4)] * 2)


def test_empty_warc(spark, tmp_path):
    assert W.write_warc(pages(spark).limit(0), str(tmp_path / "w")) == 0
    assert W.read_warc(spark, str(tmp_path / "w")).count() == 0


def test_toxic_hash_split_is_that_of_zlib(spark):
    from tideline.llm.queries import in_training

    got = spark.range(200).select(F.col("id").alias("doc_id")).withColumn("t", in_training()).collect()
    assert all(r.t == (zlib.crc32(str(r.doc_id).encode()) % 5 != 0) for r in got)
