"""Merkle manifest, BPE and divergence audit against plain programs, and their odd inputs."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from conftest import SF_SMALL
from lakezones.llm import queries as q
from lakezones.llm.bpe import Bpe, decoded, encoded, round_trip
from lakezones.llm.divergence import _words, divergence
from lakezones.llm.merkle import OpenSubtrees, fold, manifest_rows, node

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, tree string, place int, size int, digest string, "
          "n int, term string, value int, ids string, _part int, closed int")
EXTRA = ("x", 1, 1, "x", 1, "x", 1, "x", 1, 1)
ODD = [(3, None, "en", "a", 5), (1, "", "en", None, 0), (2, "One two\nTWO ünï", "en", "b", None), (2, "One two\nTWO ünï", "en", "b", None),
       (2, "another of this id", "en", "b", 9), (None, "no id", None, "a", 5), (-7, "<|endoftext|> İ. 中文 x", "", "a", 9223372036854775807),
       (21, "long text, " * 9000, "en", None, 99000), (14, "a" * 40_000 + "ab" * 3000, "en", "a", 46000), (28, "é", None, None, None)]


def odd(spark):
    return spark.createDataFrame([(*r, *EXTRA) for r in ODD], SCHEMA)


def told(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def proofs(leaves):
    """Root and each leaf's siblings as (side, digest), level by level."""
    way, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            if p ^ 1 < len(nodes):
                way[i].append((p & 1, nodes[p ^ 1]))
            else:
                way[i].append(None)
        nodes = [hashed(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        at = [p >> 1 for p in at]
    return nodes[0], way


def plain_manifest(rows):
    by_lang = defaultdict(list)
    for doc, text, lang, source, n in rows:
        leaf = hashed(*map(told, (doc, source, lang, n, text)))
        altered = None
        if doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0:
            altered = hashed(*map(told, (doc, source, lang, None if n is None else n + 1, text)))
        by_lang[lang].append((doc is not None, doc or 0, leaf, doc, altered))
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    subs = {}
    for lang in order:
        by_lang[lang].sort(key=lambda r: r[:3])
        subs[lang] = proofs([r[2] for r in by_lang[lang]])
    root, above = proofs([subs[lang][0] for lang in order])
    out = []
    for lang, up in zip(order, above):
        sub, ways = subs[lang]
        for (_, _, leaf, doc, altered), way in zip(by_lang[lang], ways):
            steps, v = [*way, *up], altered or leaf
            for s in steps:
                v = hashed(v) if s is None else hashed(s[1], v) if s[0] else hashed(v, s[1])
            out.append((doc, leaf, sub, root, hashed(*(s[1] for s in steps if s)), v, v == root))
    return out


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_manifest_equals_plain_trees(spark, bits):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert as_rows(manifest_rows(docs, bits)) == sorted(plain_manifest(rows), key=repr)


def test_manifest_of_odd_rows(spark):
    got = as_rows(manifest_rows(odd(spark), 1))
    assert got == sorted(plain_manifest(ODD), key=repr)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)
    assert manifest_rows(odd(spark).where("false")).count() == 0
    one = manifest_rows(odd(spark).where("doc_id = 3")).collect()
    assert [(r.leaf, r.leaf, r.verified) for r in one] == [(r.root, r.subroot, True) for r in one]


def test_witnesses_grow_with_later_siblings():
    leaves = [bytes([i]) * 32 for i in range(11)]
    run = OpenSubtrees()
    for i, leaf in enumerate(leaves):
        run.append(leaf)
        assert [1 << h for h, *_ in run.open] == [1 << b for b in range(4, -1, -1) if i + 1 >> b & 1]
    assert [len(w) for w in run.witness] == [3] * 8 + [1, 1, 0]
    root = run.close()
    for place, (leaf, w) in enumerate(zip(leaves, run.witness)):
        assert fold(leaf, place, 11, b"".join(w)) == (root, b"")
        assert fold(node(leaf), place, 11, b"".join(w))[0] != root


def test_manifest_tells_a_moved_or_changed_row(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    root = manifest_rows(docs).first().root
    assert manifest_rows(docs.repartition(7)).first().root == root
    assert manifest_rows(docs.replace(["en"], ["ne"], "lang")).first().root != root


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(q.tokenizer_path("byte_bpe_50k.json"))


def odd_texts():
    rng = random.Random(4)
    texts = ["", " ", "  x ", "<|endoftext|>", "a<|endoftext|> <|endoftext|", "İ. ", "it's we'LL", "a" * 5000, "ab" * 3000 + "c", "՘₏\x85\x1c"]
    texts += ["".join(rng.choice("ab' \n\t.1éİ中<|endoftext|>") for _ in range(rng.randrange(40))) for _ in range(2000)]
    wide = lambda: chr(rng.choice([rng.randrange(0x20, 0xD800), rng.randrange(0xE000, 0x110000)]))
    return texts + ["".join(wide() for _ in range(20)) for _ in range(3000)]


@pytest.mark.parametrize("one_at_a_time", [False, True])
@pytest.mark.parametrize("long_word", [4, 1024])
def test_bpe_equals_the_library(library, long_word, one_at_a_time):
    texts = odd_texts()
    model = Bpe(q.tokenizer_path("byte_bpe_50k.json"), cache_words=100, long_word=long_word)
    assert model.in_order
    model.in_order = not one_at_a_time
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = model.encode(texts[:1000]) + model.encode(texts[1000:])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert [model.decode(g) for g in got] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_any_ids_decode_as_in_the_library(library):
    rng, model = random.Random(5), Bpe(q.tokenizer_path("byte_bpe_50k.json"))
    for _ in range(2000):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(8))]
        assert model.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_bpe_query_and_odd_rows(spark, library):
    def want(texts):
        for doc, text in texts:
            ids = library.encode(text or "", add_special_tokens=False).ids
            back = library.decode(ids, skip_special_tokens=False)
            yield doc, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(back.encode()).hexdigest()

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert as_rows(q.op12_bpe(spark, SF_SMALL)) == sorted(want(docs), key=repr)
    path = q.tokenizer_path("byte_bpe_50k.json")
    assert as_rows(round_trip(odd(spark), path)) == sorted(want([r[:2] for r in ODD]), key=repr)
    back = decoded(encoded(odd(spark), path), path)
    assert as_rows(back.select("doc_id", "text")) == sorted(((r[0], r[1] or "") for r in ODD), key=repr)
    assert encoded(odd(spark).where("false"), path).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        Bpe(q.tokenizer_path("word_bpe_49k.json"))


def plain_audit(rows, min_docs, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups.add((lang, source))
        n[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = [t for t, c in docs[lang].items() if c >= min_docs]
        every = sum((n[g] for g in groups if g[0] == lang), Counter())

        def p(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        own, common = p(n[lang, source]), p(every)
        pairs = [(sum(f(own[t], other[t]) for t in kept), s) for x, s in groups if x == lang and s != source
                 for other in [p(n[lang, s])]]
        terms = [(f(own[t], common[t]), t) for t in kept if n[lang, source][t] and own[t] > common[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, i, v, k) for k, (v, i) in enumerate(items[:most], 1)]
    return sorted(out, key=repr)


def test_audit_equals_plain_counts(spark, monkeypatch):
    from lakezones.llm import divergence as module

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    want = plain_audit(rows, 10, 10)
    assert as_rows(divergence(docs)) == want
    monkeypatch.setattr(module, "PART_ROWS", 50)
    assert as_rows(divergence(docs)) == want


def test_audit_of_odd_rows(spark):
    rng = random.Random(6)
    ties = [(i, " ".join(rng.choice(["Aa", "b", "ccc", "É", "é", "zz", "\U0001f600", "￿"]) for _ in range(12)), "en", f"s{i % 3}", 1)
            for i in range(60)]
    rows = ODD + ties + [(99, None, "xx", "a", 1), (98, "rare", "xx", "b", 1)]
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    for min_docs, top in ((10, 10), (1, 3), (100, 10)):
        assert as_rows(divergence(docs, min_docs, top)) == plain_audit(rows, min_docs, top)
    assert divergence(docs.where("false")).count() == 0


def test_long_texts_are_cut_between_terms(monkeypatch):
    from lakezones.llm import divergence as module

    monkeypatch.setattr(module, "SLICE_BYTES", 50)
    text = "aß" * 60 + " b " * 200 + "c" * 120
    assert [w for part in _words(text) for w in part] == [w.encode() for w in text.split()]
