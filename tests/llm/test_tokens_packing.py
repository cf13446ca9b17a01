"""Packing, token store and winnowing against brute force, and their odd inputs."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from lakezones.llm import queries as q
from lakezones.llm.packing import fullest, pack_documents, packing_plan, sequences
from lakezones.llm.token_store import Dac, dac_encode, open_store, read_documents, write_store
from lakezones.llm.tokens import Encoder
from lakezones.llm.winnow import edit_fingerprints, gram_hashes, likeness, winnow
from lakezones.session import scratch_dir

ODD = "doc_id long, text string, extra int, sequence_id int, part int, bucket int, length int"
ODD_ROWS = [(3, None, 1, 1, 1, 1, 1), (1, "", 1, 1, 1, 1, 1), (2, "one two  three \n\n four", 1, 1, 1, 1, 1),
            (5, "wörd <|endoftext|> \U0001f600 ", 1, 1, 1, 1, 1), (5, "wörd <|endoftext|> \U0001f600 ", 2, 2, 2, 2, 2),
            (None, "no id", 1, 1, 1, 1, 1), (9, "long text, " * 9000, 1, 1, 1, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def plain(name, special_as_text=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(q.tokenizer_path(name))
    t.encode_special_tokens = special_as_text
    return t


def any_texts(rng, n):
    """Texts of letters of all scripts, marks, spaces and strings of added tokens in any case."""
    wide = [chr(c) for c in range(0x80, 0x110000, 37) if not 0xD800 <= c <= 0xDFFF]
    near = [chr(c) for c in range(0x80, 0x600)]
    more = ["İ", "İ", "ẞ", "Σ", "ŉ", "ǰ", "\u0307", "\u0301", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "'S", "'ll", "\u212b"]
    for _ in range(n):
        some = rng.choices(near, k=4) + rng.choices(wide, k=2) + rng.choices(more, k=3) + list("aB9") + [" ", " ", ".", ",", "!", "\n", "? "]
        yield "".join(rng.choice(some) for _ in range(rng.randrange(25)))


@pytest.mark.parametrize("name,space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_ids_are_the_tokenizers_ids(docs, name, space):
    rng = random.Random(1)
    texts = [r[0] for r in docs.select("text").collect()]
    texts += ["", " ", "  ", "a ", "a  ", " \n ", "a \n b", "a\n b", "a \n\n  b ", "it's  we'll\t x", "ΣΣ Σ", "á ́b"]
    texts += ["".join(rng.choice("ab' \n\t. 1é") for _ in range(rng.randrange(30))) for _ in range(2000)]
    texts += [f"a{m}" for m in ("İ. ", "İ, x", "İİ! ", "ı. ", "\u0307. ")] + list(any_texts(rng, 30_000))
    for special_as_text in (False, True):
        enc, library = Encoder(q.tokenizer_path(name), space, 50, special_as_text), plain(name, special_as_text)
        for i in range(0, len(texts), 500):
            some = texts[i:i + 500]
            assert enc.encode(some) == [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(some, add_special_tokens=False)]


def test_fullest_is_optimal():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randrange(1, 20): rng.randrange(1, 4) for _ in range(4)}
        room = rng.randrange(0, 40)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * c for s in sums for c in range(n + 1) if s + k * c <= room}
        use = fullest(counts, room)
        assert sum(k * c for k, c in use) == max(sums)
        assert all(c <= counts[k] for k, c in use)


def test_plan_uses_every_piece_once():
    rng = random.Random(3)
    counts = {k: rng.randrange(1, 9000 // k) for k in range(1, 65)}  # enough short pieces for full bins
    plan, left = packing_plan(counts, 64), dict(counts)
    for repeats, use in plan:
        assert sum(k * c for k, c in use) <= 64
        for k, c in use:
            left[k] -= repeats * c
    assert not any(left.values())
    assert sum(r for r, _ in plan) <= math.ceil(sum(k * n for k, n in counts.items()) / 64) + 2
    assert len(plan) <= sum(1 + 64 // k for k in range(1, 65)) and packing_plan({}, 64) == []


def check_packing(rows, texts, capacity):
    tok = plain("byte_bpe_50k.json")
    bins, seen = {}, {}
    for r in rows:
        seen.setdefault((r.doc_id), []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in texts:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(seen[doc], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) and len(pieces) == math.ceil(len(ids) / capacity)
        assert sum(p.length for p in pieces) == len(ids) and all(p.length == capacity for p in pieces[1:])
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    total = sum(r.length for r in rows)
    return len(bins), math.ceil(total / capacity)


def test_op2(spark, docs):
    rows = q.op2_best_fit_packing(spark, SF_SMALL).collect()
    used, least = check_packing(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 1024)
    assert used <= 1.02 * least + 1


def test_packing_odd_rows(spark):
    odd = spark.createDataFrame(ODD_ROWS, ODD)
    packed = pack_documents(odd, q.tokenizer_path("byte_bpe_50k.json"), capacity=64)
    rows = packed.collect()
    assert sum(r.doc_id == 5 and r.piece == 0 for r in rows) == 2
    whole = {r.sequence_id: len(r.ids) // 4 for r in sequences(packed).collect()}
    assert sum(whole.values()) == sum(r.length for r in rows) and max(whole.values()) <= 64
    assert pack_documents(odd.where("false"), q.tokenizer_path("byte_bpe_50k.json")).collect() == []


def test_dac_access():
    rng = np.random.default_rng(4)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.choice([3, 255, 256, 70_000, 2**32 - 1], n).astype(np.uint32)
        dac = Dac(dac_encode(ids))
        assert len(dac) == n
        assert [dac.access(i) for i in range(n)] == ids.tolist()
        for a in range(0, n, 97):
            b = min(n, a + int(rng.integers(0, 700)))
            assert (dac.slice(a, b) == ids[a:b]).all()


def test_op4(spark, docs):
    tok, at = plain("word_bpe_49k.json"), 0
    got = {r.doc_id: r for r in q.op4_token_store(spark, SF_SMALL).collect()}
    for r in docs.orderBy("doc_id").collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_store_odd_rows(spark):
    odd = spark.createDataFrame(ODD_ROWS, ODD).repartition(3)
    path = scratch_dir(spark, "store-test")
    write_store(odd, path, q.tokenizer_path("word_bpe_49k.json"), shard_tokens=4)
    rows = sorted(read_documents(open_store(spark, path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 5, 5, 9]
    texts = {r[0]: r[1] or "" for r in ODD_ROWS}
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == [*plain("word_bpe_49k.json").encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    empty = scratch_dir(spark, "store-test")
    write_store(odd.where("false"), empty, q.tokenizer_path("word_bpe_49k.json"))
    assert read_documents(open_store(spark, empty)).collect() == []


def brute_winnow(text, k, w):
    n = len(text)
    if not n:
        return []
    h = gram_hashes(np.array([ord(c) for c in text], np.uint32), min(k, n)).tolist()
    span = min(w, len(h))
    return sorted({max((-h[j], j) for j in range(i, i + span))[1] for i in range(len(h) - span + 1)})


def test_winnow_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("abé") for _ in range(rng.randrange(60)))
        k, w = rng.randrange(1, 12), rng.randrange(1, 12)
        h, p = winnow(text, k, w)
        assert p.tolist() == brute_winnow(text, k, w)
        for i in range(len(text) - k + 1):  # equal grams have equal hashes wherever they stand
            assert gram_hashes(np.array([ord(c) for c in text], np.uint32), k)[i] == gram_hashes(np.array([ord(c) for c in text[i:i + k]], np.uint32), k)[0]


def test_match_guarantee():
    rng = random.Random(6)
    shared = "".join(rng.choice("abcdef ") for _ in range(87))
    a = "".join(rng.choice("abcdef ") for _ in range(400)) + shared
    b = shared + "".join(rng.choice("abcdef ") for _ in range(400))
    assert set(winnow(a)[0].tolist()) & set(winnow(b)[0].tolist())
    assert likeness(winnow("")[0], winnow("")[0]) == 1.0 and likeness(winnow("a")[0], winnow("")[0]) == 0.0


def check_edits(rows, ordered):
    got = {(r.doc_id, r.n_chars, r.edited_sha256, r.near_next) for r in rows}
    assert len(rows) == len(ordered)
    for i, (doc, text) in enumerate(ordered):
        nxt = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        assert (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(winnow(text)[0], winnow(nxt)[0])) in got


def test_op6(spark, docs):
    rows = q.op6_winnowing(spark, SF_SMALL).collect()
    check_edits(rows, [(r.doc_id, r.text or "") for r in docs.orderBy("doc_id", ascending=False).collect()])
    by_text = {}
    for r, t in zip(sorted(rows, key=lambda r: r.doc_id), docs.orderBy("doc_id").collect()):
        assert by_text.setdefault(t.text, r.fingerprint) == r.fingerprint


def test_winnow_odd_rows(spark):
    odd = spark.createDataFrame(ODD_ROWS, ODD)
    rows = edit_fingerprints(odd).collect()
    check_edits(rows, sorted(((r[0], r[1] or "") for r in ODD_ROWS), key=lambda r: -1 if r[0] is None else r[0], reverse=True))
    assert edit_fingerprints(odd.where("false")).collect() == []
    one = edit_fingerprints(odd.where("doc_id = 2")).collect()
    check_edits(one, [(2, ODD_ROWS[2][1])])


def test_a_full_cache_keeps_the_parts_met_last(monkeypatch):
    """A full cache once started anew: the most frequent words were encoded again and again."""
    from lakezones.llm.queries import tokenizer_path
    from lakezones.llm.tokens import Encoder

    for name, keeps_space in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        enc, plain, learned = Encoder(tokenizer_path(name), keeps_space, 60), Encoder(tokenizer_path(name), keeps_space), []
        real = enc._learn
        monkeypatch.setattr(enc, "_learn", lambda new: (learned.extend(new), real(new)))
        for i in range(30):
            text = " ".join(["the and of", *(f"w{chr(97 + i % 26)}{chr(97 + j)}{'x' * (i // 26)}" for j in range(20))])
            assert enc.encode([text]) == plain.encode([text])
            assert len(enc.parts) + len(enc.older) <= 60 + 2 * 25  # and what one call adds
        assert [learned.count(w) for w in ("and", "of")] == [1, 1]


@pytest.mark.parametrize("name,space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_word_is_learnt_once_whatever_closes_it(name, space):
    """Marks other than . , ; : ! ? once stayed with their word, and each such pair was a part of its own."""
    enc, library = Encoder(q.tokenizer_path(name), space), plain(name)
    marks = ["###", "$$$", ",&&&", ".***", ")", "%", "'", "\"'", "_", ".", "", "'\n", ")\n\n"]
    texts = [f"{mark}x {word}{mark} y {word}{mark}" for mark in marks for word in ("carpet", "écran", "x7", "it's", "İ", "a-b")]
    assert enc.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert not [p for p in enc.parts if p.startswith("carpet") and p not in ("carpet", "carpet)\n\n")]


def test_a_shard_is_decoded_once(spark, monkeypatch):
    """Each document's ids once went through all levels of their own."""
    texts, seen = ["a b c", "", None, "é" * 300, "d"], []
    path = scratch_dir(spark, "store-shards")
    write_store(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, q.tokenizer_path("word_bpe_49k.json"), shard_tokens=1000)
    store = open_store(spark, path)
    run = []
    monkeypatch.setattr(type(store), "mapInArrow", lambda df, f, schema: run.append(f) or df)
    frame = read_documents(store)
    monkeypatch.undo()
    real = Dac.slice
    monkeypatch.setattr(Dac, "slice", lambda dac, a, b: seen.append((a, b)) or real(dac, a, b))
    shards = frame.toArrow()
    rows = [r for b in shards.to_batches() for out in run[0](iter([b])) for r in out.to_pylist()]
    assert len(seen) == shards.num_rows
    ids = [np.array(plain("word_bpe_49k.json").encode(t or "", add_special_tokens=False).ids + [2], "<u4") for t in texts]
    rows.sort(key=lambda r: r["start"])
    assert [(r["doc_id"], r["n_tokens"], r["ids"]) for r in rows] == [(i, len(x), x.tobytes()) for i, x in enumerate(ids)]
    assert [r["start"] for r in rows] == [sum(map(len, ids[:i])) for i in range(len(ids))]
