"""The training-data operators against plain re-statements, with the odd inputs each must take."""

from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caseloom.llm import attention, bpe, decontaminate, flac, jaccard, langid, licenses, planes, toxicity, urls
from caseloom.llm.subwords import Subwords

RANKS, PATTERN, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, "a b c"), (2, ""), (3, None), (3, None), (4, "x " * 60_000), (None, "a b c"), (1, "a b c"), (5, " \n\t "), (6, "é𝄞中 \x00 z")]
ALPHABET = "  \n\t\x1c\x85\xa0aAbBzéßñ×12'stre.,!?-_\U0001F600中文…"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def texts(seed, n=300, size=40):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) if r.random() < 0.3 else r.choice("abc é,. \n") for _ in range(r.randint(0, size))) for _ in range(n)]


# 1 FLAC


def test_flac_round_trips():
    rng = np.random.default_rng(0)
    made = [
        b"", b"a", bytes(15), bytes(17), b"x" * 10_000, rng.integers(0, 256, 5000, dtype=np.uint8).tobytes(), (np.arange(20_000) % 256).astype(np.uint8).tobytes(),
        (128 + 100 * np.sin(np.arange(30_000) / 50)).astype(np.uint8).tobytes(), bytes([0, 255] * 3000), bytes([128] * 1000 + [0] + [128] * 1000 + [255] * 5 + [128] * 3000), None,
    ]
    streams = flac.encode_many(made)
    assert [d and d.pcm for d in flac.decode_many(streams)] == made
    long = rng.integers(120, 130, 50_000, dtype=np.uint8).tobytes()
    stream = flac.encode_many([long])[0]
    assert (flac.read_range(stream, 30_001, 77)[:, 0] + 128).tolist() == list(long[30_001:30_078])
    info = flac.metadata(stream)
    assert flac.decode_many([stream[:4] + b"\x80" + stream[5:42] + stream[info.first :]])[0].pcm == long  # without the seek table
    for at in (info.first + 3, info.first + 500):
        broken = bytearray(stream)
        broken[at] ^= 4
        with pytest.raises(flac.FlacError):
            flac.decode_many([bytes(broken)])


def test_flac_stereo_from_other_encoders():
    # two channels, 16 bits, one verbatim left/side frame of 16 samples, written by hand
    left, side = np.arange(16) * 100, np.arange(16) - 8
    head = bytes([0xFF, 0xF8, 0x70, 0x88, 0x00]) + (15).to_bytes(2, "big")
    head += bytes([flac.crc8(head)])
    bits = "00000010" + "".join(format(int(v) & 0xFFFF, "016b") for v in left) + "00000010" + "".join(format(int(v) & 0x1FFFF, "017b") for v in side)
    bits += "0" * (-len(bits) % 8)
    frame = head + int(bits, 2).to_bytes(len(bits) // 8, "big")
    frame += flac._Crc16._slow(frame).to_bytes(2, "big")
    packed = 44_100 << 44 | 1 << 41 | 15 << 36 | 16
    stream = b"fLaC\x80" + (34).to_bytes(3, "big") + (16).to_bytes(2, "big") * 2 + bytes(6) + packed.to_bytes(8, "big") + bytes(16) + frame
    got = flac.decode_many([stream])[0].samples
    assert got[:, 0].tolist() == left.tolist() and got[:, 1].tolist() == (left - side).tolist()


def test_flac_columns(spark):
    df = spark.createDataFrame([(1, b"abc" * 2000, "m"), (2, None, "m"), (3, b"", "m")], "k long, payload binary, media string")
    got = {r.k: r for r in flac.decode(flac.encode(df)).collect()}
    assert bytes(got[1].pcm) == b"abc" * 2000 and got[2].pcm is None and bytes(got[3].pcm) == b""
    blocks = flac.pcm_blocks(flac.decode(flac.encode(df)), "k").orderBy("k", "block").collect()
    assert b"".join(bytes(b.pcm) for b in blocks) == b"abc" * 2000 and [b.sample_offset for b in blocks] == [0, 4608]
    assert flac.decode(flac.encode(df.limit(0))).count() == 0


# 2 decontamination


def test_decontamination(spark):
    item = "Alice walked 12 km from London to Paris and paid 30 euros for the long trip home"
    other = "the quick brown fox jumps over the lazy dog near a small river bank today"
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (4, "one two"), (5, "five plain words stand here")], "item_id long, text string")
    docs = [
        (1, f"Start here. {item} End."), (2, "Start. Bob walked 15 km from Berlin to Rome and paid 45 dollars for the long trip home."),
        (3, "nothing of that kind at all"), (4, None), (5, ""), (6, item.lower()), (7, "one two"), (8, "x " * 30_000), (9, "say five plain words stand here now"), (1, f"Start here. {item} End."),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("old"))
    got = {r.doc_id: (r.contaminated, r["items"]) for r in decontaminate.mark(df, bench).collect()}
    assert {k for k, v in got.items() if v[0]} == {1, 2, 6, 9} and got[2][1] == "1" and got[9][1] == "5"
    assert sorted(r.doc_id for r in decontaminate.remove(df, bench).collect()) == [3, 4, 5, 7, 8]
    assert decontaminate.mark(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.mark(df.limit(0), bench).count() == 0


def test_inconsistent_slots_are_left_out(spark):
    bench = spark.createDataFrame([(1, "take 3 of the red ones then 3 of the blue ones then 3 of the green ones then 3 of the rest")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "take 5 of the red ones then 5 of the blue ones then 5 of the green ones then 5 of the rest"), (2, "take 5 of the red ones then 6 of the blue ones then 7 of the green ones then 8 of the rest")], "doc_id long, text string")
    assert {r.doc_id: r.contaminated for r in decontaminate.mark(docs, bench).collect()} == {1: True, 2: False}


def test_changed_names_that_open_sentences(spark):
    item = "Tom has 5 red apples now. Ann gives Tom 3 more today. Tom eats 2 of them fast. Ann buys 4 green pears too. How many fruits do they have left?"
    dense = "Pay for 12 kg at 3 euros and 7 kg at 5 euros and 9 kg at 2 euros and say the sum"
    bench = spark.createDataFrame([(1, item), (2, dense)], "item_id long, text string")
    docs = [
        (1, item.replace("Tom", "Bob").replace("Ann", "Eve").replace("5", "6")), (2, dense.replace("12", "14").replace("3", "8").replace("7", "6").replace("5", "1").replace("9", "4")),
        (3, "Tall trees grow near the house. Small birds sing there in spring. People walk by and stop."), (4, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 kg 3 kg 4 kg 5"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r["items"] for r in decontaminate.mark(df, bench).collect()}
    assert got == {1: "1", 2: "2", 3: "", 4: ""}


def test_plain_windows_count_in_an_inconsistent_alignment(spark):
    head = "the old mill by the river was built in 1987 and has been closed since 1987 because"
    tail = "nobody in the village wanted to pay for a new wheel or for the repair of its roof and walls"
    bench = spark.createDataFrame([(1, f"{head} {tail}")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{head.replace('since 1987', 'since 1990')} {tail}"), (2, f"{head} of that")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.mark(docs, bench).collect()}
    n = len(f"{head} {tail}".split()) - 7
    assert got[1].contaminated and got[1].coverage == (n - 8) / n  # all but the windows over the changed year
    assert got[2].contaminated


# 3 language


def sentences(seed, words, n):
    r = random.Random(seed)
    return [" ".join(r.choice(words) for _ in range(r.randint(4, 40))) for _ in range(n)]


EN, FR = "the of and with house river water people thing other".split(), "le la les avec maison rivière eau gens chose autre".split()


def test_language(spark, odd):
    rows = [(i, t, "en") for i, t in enumerate(sentences(1, EN, 60))] + [(100 + i, t, "fr") for i, t in enumerate(sentences(2, FR, 60))] + [(999, None, "en"), (998, "the", None)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["en", "fr"]
    new = [(t, "en") for t in sentences(3, EN, 40)] + [(t, "fr") for t in sentences(4, FR, 40)]
    got = model.predict([t for t, _ in new])
    assert np.mean([g[0] == w for g, (_, w) in zip(got, new)]) >= 0.98 and all(g[2] for g in got)
    alone = [model.predict([t])[0] for t, _ in new[:10]]
    assert [a[0] for a in alone] == [g[0] for g in got[:10]] and np.allclose([a[1] for a in alone], [g[1] for g in got[:10]], atol=1e-5)
    assert model.predict(["жжж ддд ффф"])[0][2] is False
    # probabilities after a context add up to one over the known characters and the unknown
    code = langid.characters(["the house"])[0]
    chars = np.unique(np.concatenate([langid.characters([t])[0] for t, _ in new]))
    total = sum(np.exp(model.log_prob(np.append(code[:-1], c)))[-1] for c in chars)
    assert np.all(total <= 1.001) and np.all(total > 0.5)
    found = langid.identify(odd.withColumn("score", F.lit("old")), model).collect()
    assert len(found) == len(ODD) and {r.lang_pred for r in found if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert langid.identify(odd.limit(0), model).count() == 0
    empty = langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in langid.identify(odd, empty).collect()} == {"und"}


def test_held_out_is_crc32(spark):
    df = spark.range(200)
    got = [r[0] for r in df.orderBy("id").select(langid.held_out(F.col("id"), 5, 0)).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)]


# 4 licences


WRAPPED = """intro text
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of it, or later.
"""


def test_license_scan(spark, odd):
    docs = [
        (1, "Licensed under the Apache License, Version 2.0."), (2, "CC BY CC BY-NC cc by"), (3, "GNU General Public License"), (4, "Licensed under CC BY-NC 4.0."), (5, "Released under the MIT License.\nMIT License"),
        (6, "released\nunder the mit license"), (8, WRAPPED), (9, "released " + "x " * 12 + "under the mit license"), (7, "\u212a License mit  license"),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string").withColumn("labels", F.lit(1))).collect()}
    assert (got[1].labels, got[1].n_base, got[1].first_word) == ("apache,apache-notice", 1, 3)
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].labels) == (3, 0, 5, "cc-by")
    assert got[3].labels == "gpl" and got[4].labels == "cc-by,cc-by-family-notice,cc-by-nc-notice" and got[5].labels == "mit,mit-notice" and got[5].score == 1.0
    assert got[6].labels == "mit,mit-notice" and (got[7].n_words, got[7].n_base, got[7].first_word) == (4, 1, 2)
    assert got[8].labels == "gpl,gpl-program" and got[8].score > 0.9 and got[9].labels == "mit"
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(odd.limit(0)).count() == 0
    none_ = [r for r in licenses.scan(odd).collect() if r.doc_id == 3]
    assert len(none_) == 2 and none_[0].n_words == 0 and none_[0].first_word is None and none_[0].labels == ""


# 5 attention


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: rng.standard_normal((4, 4)) * 0.5 for k in "qkvo"} | {"e": rng.standard_normal((7, 4)), "p": rng.standard_normal((5, 4)), "u": rng.standard_normal((4, 3)), "b": rng.standard_normal(3)}
    x, c, used = rng.integers(0, 7, (2, 5)), rng.integers(0, 3, (2, 5)), rng.random((2, 5)) < 0.8
    _, g = attention.gradients(p, x, c, used)
    for k in p:
        for _ in range(6):
            i = tuple(rng.integers(0, s) for s in p[k].shape)
            old = p[k][i]
            p[k][i] = old + 1e-5
            up = attention.gradients(p, x, c, used)[0]
            p[k][i] = old - 1e-5
            down = attention.gradients(p, x, c, used)[0]
            p[k][i] = old
            assert abs((up - down) / 2e-5 - g[k][i]) < 1e-7


def test_attention_scores_each_id_once():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 15, 16, 17, 40, 100]
    ids, starts = rng.integers(0, 50, sum(sizes)), np.concatenate(([0], np.cumsum(sizes)))
    m = attention.train(ids, starts, 51, 50, steps=5)
    got = m.score(ids, starts)
    for i, n in enumerate(sizes):  # plain: every place by the window that owns it
        seq = np.concatenate(([50], ids[starts[i] : starts[i + 1]], [50]))
        total = 0.0
        for t in range(n + 1):
            k = 0 if t < attention.WINDOW else (t - attention.WINDOW) // attention.STRIDE + 1
            w = np.full(attention.WINDOW, 50)
            part = seq[:-1][k * attention.STRIDE :][: attention.WINDOW]
            w[: len(part)] = part
            y = np.full(attention.WINDOW, seq[t + 1])
            total += m._window(w[None], y[None])[0, t - k * attention.STRIDE]
        assert abs(total - got[i]) < 1e-3
    # a place does not see what comes after it, and next ids' probabilities add up to one
    w = rng.integers(0, 50, (1, attention.WINDOW))
    p = sum(np.exp(m._window(w, np.full_like(w, y))[0, 3]) for y in range(51))
    changed = w.copy()
    changed[0, 4:] = 7
    assert abs(p - 1) < 1e-4 and np.isclose(m._window(w, w)[0, 3], m._window(changed, np.where(np.arange(w.size) == 3, w, changed))[0, 3])


def test_attention_learns_from_every_text(spark, monkeypatch):
    """The sample only sets the start: counts, classes and gradients are of all texts."""
    monkeypatch.setattr(attention, "DOCS", 2)
    monkeypatch.setattr(attention, "SPACING", 1)
    rows = [(i, "plain words here" if i % 2 else "violet zebras dance") for i in range(60)] + [(60, "quartz " * 300), (61, "solo " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids, starts = attention.encoder(RANKS, PATTERN).encode([t.encode() for _, t in rows])
    source, target = attention.shifted(ids, starts, 50_256)
    count = np.bincount(target, minlength=50_257)
    texts, _ = attention.encoded(df, F.lit(True), RANKS, PATTERN, 50_257)
    m = attention.fit(texts, 50_257)
    inside = np.log(count + 0.1) - np.log(np.bincount(m.of, weights=count + 0.1, minlength=attention.CLASSES)[m.of] + 1e-300)
    assert np.allclose(m.inside, inside, atol=1e-4)
    assert np.array_equal(m.of, attention.classes(count.astype(float), target, attention.common_column(count.astype(float))[source], np.ones(target.size)))
    # the sums by task equal the gradient over all windows of a part
    stored = texts.where(F.col("part") >= 0)
    rng = np.random.default_rng(0)
    seen = np.union1d(np.flatnonzero(count), [50_256])
    small = np.zeros(50_257, dtype=np.int64)
    small[seen] = np.arange(seen.size)
    d = attention.WIDTH
    p = {k: rng.standard_normal((d, d)) * 0.3 for k in "qkvo"} | {"e": rng.standard_normal((seen.size, d)), "p": rng.standard_normal((attention.WINDOW, d)), "u": rng.standard_normal((d, attention.CLASSES)), "b": np.zeros(attention.CLASSES)}
    sums, total = attention._sums(stored, 50_256), 0
    for part in range(attention.PARTS):
        texts = [np.frombuffer(r["ids"], "<u2").tolist() for r in stored.where(F.col("part") == part).collect()]
        x, c, used = [], [], []
        for t in texts:
            a, b = [50_256, *t], [*t, 50_256]
            for i in range(0, len(a), attention.WINDOW):
                n = len(a[i : i + attention.WINDOW])
                x.append(small[a[i : i + n] + [50_256] * (attention.WINDOW - n)])
                c.append(m.of[b[i : i + n] + [50_256] * (attention.WINDOW - n)])
                used.append(np.arange(attention.WINDOW) < n)
        base = rng.standard_normal((seen.size + 1, attention.CLASSES))
        g = sums(part, p, small, m.of, base)
        total += len(texts)
        if not texts:
            assert g is None
            continue
        _, want = attention.gradients(p, np.array(x), np.array(c), np.array(used), base[np.array(x)])
        assert all(np.allclose(g[k], want[k], atol=1e-5) for k in p)
    assert total == len(rows)


def test_attention_beats_a_bigram():
    """Held out, the model knows more than an interpolated bigram of the same ids."""
    r = random.Random(7)
    kinds = {k: [r.randrange(40 * k, 40 * k + 60) for _ in range(40)] for k in range(4)}

    def text():
        k, out = r.randrange(4), []
        for _ in range(r.randint(10, 120)):
            out.append(r.choice(kinds[k]) if r.random() < 0.7 else r.randrange(200, 230))
        return out

    some = [text() for _ in range(500)]
    ids, starts = np.concatenate(some[:400]), np.concatenate(([0], np.cumsum([len(t) for t in some[:400]])))
    new, at = np.concatenate(some[400:]), np.concatenate(([0], np.cumsum([len(t) for t in some[400:]])))
    m = attention.train(ids, starts, 300, 299, steps=200)
    got = -m.score(new, at).sum() / (new.size + 100)
    (s, y), (s2, y2) = attention.shifted(ids, starts, 299), attention.shifted(new, at, 299)
    uni = (np.bincount(y, minlength=300) + 0.1) / (y.size + 30)
    pairs = np.zeros((300, 300))
    np.add.at(pairs, (s, y), 1)
    total, seen = np.maximum(pairs.sum(axis=1), 1), (pairs > 0).sum(axis=1)
    bigram = min(-np.log(np.maximum(pairs[s2, y2] - d, 0) / total[s2] + np.where(seen[s2] > 0, d * seen[s2] / total[s2], 1) * uni[y2]).mean() for d in (0.5, 0.7, 0.9))
    assert got < bigram


def test_word_scores(spark, odd):
    rows = [(i, t) for i, t in enumerate(["a b a", "b c", "A d", "", None, "zz a", "q " * 50])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    learn = F.col("doc_id") < 4
    got = {r.doc_id: r for r in attention.score(df, learn, RANKS, PATTERN, 50_257).collect()}
    words = [[*(t or "").lower().split(), "<end>"] for _, t in rows]
    train = [w for ws in words[:4] for w in ws]
    n, v = len(train), len(set(train))
    for i, ws in enumerate(words):
        base = sum(np.log10((train.count(w) + 1) / (n + v + 1)) for w in ws)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(ws), sum(w in train for w in ws), n) and abs(got[i].base_score - base) < 1e-9 and got[i].score < 0
    assert attention.score(odd, F.col("doc_id") >= 0, RANKS, PATTERN, 50_257).count() == len(ODD)
    assert attention.score(odd.limit(0), F.lit(True), RANKS, PATTERN, 50_257).count() == 0


# 6 planes


def test_subwords_equal_the_library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    plain = lambda x: np.array(t.encode(x, add_special_tokens=False).ids, dtype="<u4")
    s = Subwords(plain)
    for seed in range(8):
        some = texts(seed)
        ids, at = s.encode([x.encode() for x in some])
        for k, x in enumerate(some):
            assert np.array_equal(ids[at[k] : at[k + 1]], plain(x)), repr(x)


@pytest.mark.parametrize("bits", [False, True])
def test_plane_files(spark, tmp_path, bits, monkeypatch):
    monkeypatch.setattr(planes, "PIECE", 300)
    rows = [(5, "hello world"), (2, None), (9, ""), (1, "many words " * 500), (2, "again"), (None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = planes.write(df, JSON, folder=f"file://{tmp_path}", files=3, bits=bits, block=256)
    got = planes.read(manifest).collect()
    t = Tokenizer.from_file(JSON)
    want = sorted((i is not None, i, tuple([*t.encode(x or "", add_special_tokens=False).ids, 0])) for i, x in rows)
    have = sorted((r.doc_id is not None, r.doc_id, tuple(np.frombuffer(bytes(r.ids), dtype="<u4").tolist())) for r in got)
    assert have == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1].tolist()
    assert [r.doc_id for r in ordered] == [None, 1, 2, 2, 5, 9]
    from pyarrow import fs

    big = max(manifest.collect(), key=lambda r: r.n_tokens)
    store, name = fs.FileSystem.from_uri(big.file)
    with store.open_input_file(name) as f:
        reader = planes.Reader(f)
        every = np.concatenate([x for _, _, x in reader.each()])
        assert np.array_equal(reader.read(700, 300), every[700:1000])
    assert planes.read(planes.write(df.limit(0), JSON, folder=f"file://{tmp_path}/none", files=2)).count() == 0


def test_subwords_tell_equal_hashes_apart_and_grow():
    t = Tokenizer.from_file(JSON)
    plain = lambda x: np.array(t.encode(x, add_special_tokens=False).ids, dtype="<u4")
    s = Subwords(plain, 300, 10)
    many = " ".join(f"w{k * 7919}x," for k in range(3000))
    assert np.array_equal(s.encode([many.encode()])[0], plain(many)) and s.bits > 10
    s = Subwords(plain)
    s.keys_of = lambda b, begin, n: np.minimum(n, 3).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    some = ["one two three", "four five", "one one", "x y z", ""]
    ids, at = s.encode([x.encode() for x in some])
    assert all(np.array_equal(ids[at[k] : at[k + 1]], plain(x)) for k, x in enumerate(some))


def test_queries_by_plain_python(spark, tmp_path):
    """Digests of the registered queries against plain re-statements."""
    import hashlib

    from caseloom.llm import queries

    rows = [(i, x) for i, x in enumerate(["", None, "abc", "x" * 192, "é" * 100, "Some words here. " * 40, *texts(9, 20)])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    media = {r.doc_id: r for r in queries.op1_flac(spark, str(tmp_path)).collect()}
    coded = {r.doc_id: r for r in queries.op9_byte_bpe(spark, str(tmp_path)).collect()}
    planes_ = {r.doc_id: r for r in queries.op6_bit_planes(spark, str(tmp_path)).collect()}
    v, t, start = bpe.vocabulary(RANKS, PATTERN), Tokenizer.from_file(JSON), 0
    for i, x in rows:
        raw = (x or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        got = media[i]
        assert (got.n_bytes, got.payload_bytes, got.payload_sha256, got.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        ids = v.encode(x)
        assert (coded[i].n_tokens, coded[i].ids_sha256, coded[i].decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest())
        mine = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert (planes_[i].start, planes_[i].n_tokens, planes_[i].ids_crc32) == (start, mine.size, zlib.crc32(mine.tobytes()))
        start += mine.size


# 7 near duplicates


def brute(rows):
    sets, nodes = {}, {}
    for i, t in rows:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        nodes[i] = i
    changed = True
    while changed:
        changed = False
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and 100 * len(a & b) >= 75 * len(a | b) and nodes[i] != nodes[j]:
                    nodes[i] = nodes[j] = min(nodes[i], nodes[j])
                    changed = True
    return {i: (len(sets[i]), nodes[i]) for i in sets}


def test_jaccard_equals_brute_force(spark):
    r = random.Random(5)
    rows, base = [], [[f"w{r.randint(0, 500)}" for _ in range(r.choice([3, 6, 20, 60, 200]))] for _ in range(12)]
    passage = [f"p{k}" for k in range(40)]
    for i in range(160):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 5])):
            w[r.randrange(len(w))] = f"x{r.randint(0, 9)}"
        if r.random() < 0.2:
            w = w + passage
        rows.append((i, " ".join(w).title() if r.random() < 0.3 else " ".join(w)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A\tb")]
    r.shuffle(rows)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_jaccard_odd_rows(spark, odd, none):
    got = jaccard.link(odd).collect()
    assert len(got) == len(ODD) and {(r.doc_id, r.component_id) for r in got} >= {(1, 1), (None, None), (3, 3)}
    assert jaccard.link(none).count() == 0
    kept = jaccard.keep_one(spark.createDataFrame([(2, "a b c d e f", "x"), (1, "a b c d e f", "y"), (None, "a b c d e f", "z")], "doc_id long, text string, n string"))
    assert sorted(r.n for r in kept.collect()) == ["y", "z"]


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.component) for r in jaccard.components(links, "a", "b").collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (1, 7, 60, 400, 3000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate((a[: n - n // 5], rng.integers(0, 1 << 63, n // 3).astype(np.uint64)))
        sa, sb = jaccard.signature(a)[None], jaccard.signature(b)[None]
        w = min(sa.shape[1], sb.shape[1])
        bits = int(np.bitwise_count(jaccard.folded(sa, w) ^ jaccard.folded(sb, w)).sum())
        assert bits <= np.setxor1d(a, b).size


def test_jaccard_in_small_blocks(spark, monkeypatch):
    """Large families are cut into blocks without losing a link."""
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "PAIRS", 10)
    r = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 4])):
            w[r.randrange(60)] = f"x{i}-{r.randint(0, 3)}"
        rows.append((i, " ".join(w)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


# 8 toxicity


def test_toxicity(spark, odd):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        w = [r.choice(EN) for _ in range(r.randint(5, 60))]
        if bad := r.random() < 0.25:
            for _ in range(r.randint(1, 3)):
                w.insert(r.randrange(len(w)), r.choice(["idiot", "moron", "trash", "scum", "zorgle", "zorgling"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    chain = toxicity.fit(docs.where("doc_id < 400"), marks)
    got = {x.doc_id: x for x in toxicity.score(docs, chain).collect()}
    test = [(got[i].toxic, bool(y)) for i, y in labels if i >= 400]
    assert np.mean([a == b for a, b in test]) > 0.97 and not any(a and not b for a, b in test)
    # a text of one marker is of that marker's kind; copies share a fold and a result
    p = [[got[i][f"p_{c}"] for c in toxicity.CATEGORIES[:-1]] for i, t in rows if got[i].toxic]
    assert all(max(x) > 0.5 for x in p)
    assert toxicity.score(odd.withColumn("toxic", F.lit("old")), chain).where("toxic").count() == 0
    nothing = toxicity.fit(docs, marks.limit(0))
    assert toxicity.score(odd, nothing).where("toxic or p_toxic > 0").count() == 0 and toxicity.score(odd.limit(0), chain).count() == 0


# 9 byte-level BPE


def test_bpe_equals_the_library(spark, odd):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    v = bpe.vocabulary(RANKS, PATTERN)
    for seed in range(6):
        some = texts(seed, 500)
        for x, ids in zip(some, v.encode_many([x.encode() for x in some])):
            assert np.frombuffer(ids, dtype="<u4").tolist() == e.encode_ordinary(x), repr(x)
            assert v.decode(ids) == x.encode()
    for x in ("a" * 20_000, "ab" * 5000, "\n" * 3000, " " * 3000, "x" + " " * 50 + "y", "é" * 999):
        assert np.frombuffer(v.encode(x), dtype="<u4").tolist() == e.encode_ordinary(x)
    r = random.Random(4)
    for _ in range(300):  # pieces that are no words, so that tokens must be given back
        x = bytes(r.choice(b"aeinorst") for _ in range(r.randint(1, 60)))
        assert v.encode_piece(x) == e._encode_single_piece(x)
    got = bpe.decode(bpe.encode(odd, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert len(got) == len(ODD) and all(bytes(g.decoded) == (g.text or "").encode() for g in got)
    assert bpe.encode(odd.limit(0), RANKS, PATTERN).count() == 0


# 10 URLs


def test_urls(spark):
    rows = [
        (1, "http://a.example.org/en/12"), (2, "https://x.org/"), (3, "http://x.org"), (4, "HTTP://Shop.COM/de/?q=1"), (5, None), (6, "no scheme"), (7, "http://casino.net/a"), (8, "http://casinos.net/a"),
        (9, "http://a.net/free-loan"), (10, "http://a.net/free-free"), (11, "http://badexample.org/es/1"), (12, "x://y.net#z://w"), (13, ""), (1, "http://a.example.org/en/12"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(3))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df).collect()}
    assert got[1] == ("a.example.org", "/en/12", "example.org/en/1", "block") and got[2] == ("x.org", "/", "org/", "allow") and got[3] == ("x.org", "", None, "allow")
    assert got[4] == ("shop.com", "/de/", "com/de/", "block") and got[5] == got[6] == got[13] == ("", "", None, "allow")
    assert got[7][3] == "block" and got[8][3] == "allow" and got[9][3] == "block" and got[10][3] == "allow" and got[11][2] == "org/" and got[12][:2] == ("y.net", "")
    assert urls.filter_urls(df.limit(0)).count() == 0
