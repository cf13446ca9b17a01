"""Pipeline stages against their operators, and odd rows of the remaining operators."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from lakezones.llm import decontam, lang_crf
from lakezones.llm import queries as q
from lakezones.llm.chat_format import END, START, Spans, escape, format_turns, marked_turns, read_back, unescape
from lakezones.llm.licenses import TEMPLATES, license_matches
from lakezones.llm.lang_crf import fit, in_language, posteriors, predict
from lakezones.llm import url_filter
from lakezones.llm.url_filter import url_verdicts
from test_suffix_dedup import brute as brute_removal
from test_jaccard import brute as brute_components


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_escape_is_reversible():
    rng = random.Random(1)
    for _ in range(500):
        t = "".join(rng.choice(["<", "|", "\\", "im_end", ">", "a", "\n", "|>", "<|", START, END]) for _ in range(8))
        assert unescape(escape(t)) == t and "<|" not in escape(t)


def test_spans_join_to_the_whole_rendering():
    turns = [("user", "a<|im_end|>"), ("assistant", "<|im_end|>\\ ok"), ("system", ""), ("assistant", ""), ("assistant", "<x")] * 20
    for window in (3, 200):
        spans = Spans(marked_turns, window)
        got = [spans.add(t) for t in turns]
        assert "".join(g["piece"] for g in got) == marked_turns(turns) and not any(g["rewrites"] for g in got)
        for (role, text), g in zip(turns, got):
            assert unescape(g["piece"][g["loss_from"]:g["loss_to"]]) == (text if role == "assistant" else "")


def test_templates_that_rewrite_history_are_found():
    def last_marked(turns, open_reply=False):  # only the last turn has its mark
        return "".join(f"[{i == len(turns) - 1}:{r}:{t}]" for i, (r, t) in enumerate(turns)) + ("[True:assistant:" if open_reply else "")

    spans = Spans(last_marked)
    got = [spans.add(t) for t in [("user", "a"), ("assistant", "b"), ("user", "c")]]
    assert [g["rewrites"] for g in got] == [False, True, True] and got[1]["start"] == 1


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (None, 0, "assistant", "x" * 100000),
            (None, None, None, "y"), (2, 5, "a\nb", "\\n<|")]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, start int, ord int")
    got = {r.conv_id: r for r in read_back(format_turns(turns)).collect()}
    assert (got[1].n_turns, got[None].n_turns, got[2].n_turns) == (3, 2, 1)
    assert (got[1].loss_chars, got[None].loss_chars, got[2].loss_chars) == (0, 100000, 0)
    assert read_back(format_turns(turns.where("false"))).collect() == []


def test_op3_accuracy_and_rules(spark, docs, tmp_path):
    rows = q.op3_language_id(spark, SF_SMALL).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and held and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    # neither the languages of held-out documents nor any source has a part in a prediction
    other = docs.withColumn("lang", F.when(q.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.reverse("source"))
    other.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, q.op3_language_id(spark, str(tmp_path)).collect())) == sorted(map(tuple, rows))


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(2)
    scores, trans, init = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    paths = np.array(np.meshgrid(*[range(3)] * 4)).T.reshape(-1, 4)
    weight = np.exp([init[p[0]] + sum(scores[0, i, p[i]] for i in range(4)) + sum(trans[a, b] for a, b in zip(p, p[1:])) for p in paths])
    want = np.array([[weight[paths[:, i] == k].sum() for k in range(3)] for i in range(4)]) / weight.sum()
    got, pairs = posteriors(scores, np.array([4]), trans, init, pairs=True)
    assert np.allclose(got[0], want)
    want_pairs = sum(np.array([[weight[(paths[:, i] == a) & (paths[:, i + 1] == b)].sum() for b in range(3)] for a in range(3)])
                     for i in range(3)) / weight.sum()
    assert np.allclose(pairs, want_pairs)
    padded = np.concatenate([scores[:, :2], np.zeros((1, 2, 3))], axis=1)
    short, _ = posteriors(scores[:, :2], np.array([2]), trans, init)
    assert np.allclose(posteriors(padded, np.array([2]), trans, init)[0][:, :2], short)


def test_code_switched_words_and_odd_rows(spark, docs):
    sample = [(r.lang, r.text) for r in docs.collect()]
    model = fit(sample, rounds=40)
    by = {lang: next(t for n, t in sample if n == lang and len(t) > 800)[100:500] for lang in ("en", "de")}
    rows = [(1, by["en"] + " " + by["de"], "x", 1), (2, None, None, 1), (3, " 123 — !", "x", 1), (4, "", "x", 1), (None, by["de"], None, 1),
            (4, by["en"] * 2000, "x", 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = predict(odd, model, keep_words=True).collect()
    mixed = next(r for r in got if r.doc_id == 1)
    half = len(by["en"].encode())
    right = [w.lang == ("en" if w.to <= half else "de") for w in mixed.words]
    assert np.mean(right) > 0.9
    assert {(r.doc_id, r.lang_pred) for r in got if r.doc_id != 1} == {(2, "und"), (3, "und"), (4, "und"), (None, "de"), (4, "en")}
    assert sorted(in_language(odd, model).select("doc_id", "score").collect(), key=str) == [(1, 1), (4, 1), (None, 1)]
    assert predict(odd.where("false"), model).collect() == []
    assert {r.lang_pred for r in predict(odd, None).collect()} == {"und"}
    assert lang_crf.fit_documents(odd.where("false")) is None


def test_license_odd_rows(spark):
    rows = [(1, "x\n" + TEMPLATES["mit-text"].upper() + "\ny", 1), (1, "Released under  the MIT Licence", 1), (2, None, 1), (3, "", 1),
            (None, "All rights reserved!", 1), (4, "all rights are reserved " * 5000, 1),
            (5, "line\n\n" + TEMPLATES["gpl-3.0-header"].replace(", ", ",\n") + "\n\nend", 1)]
    found = {(r.doc_id, r.license) for r in license_matches(spark.createDataFrame(rows, "doc_id long, text string, license int")).collect()}
    # "Released under the MIT" is a window of permitted size: 6 of 7
    assert found == {(1, "mit-text"), (1, "mit"), (None, "all-rights-reserved"), (5, "gpl-3.0-header")}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_matches(empty).collect() == [] and license_matches(empty, {}).collect() == []


@pytest.mark.parametrize("max_bits", [1 << 25, 64])
def test_url_odd_rows(spark, max_bits):
    urls = ["http://A.Net/x", "net/", None, "http://", "https://a.example.net/en/?q", "https://example.net/en", "http://b.org/fr/#", "x://b.org/fr",
            "http://bad.host/", "http://sub.bad.host/", "http://BAD.host?x", "http://a..net/", "http://a.net/" + "p" * 20000]
    pages = spark.createDataFrame([(i, u, 1, 1) for i, u in enumerate(urls)] + [(None, "http://a.net/", 1, 1)] * 2,
                                  "page_id long, url string, host int, key int")
    rules = spark.createDataFrame(q.URL_RULES, "host string, path string, action string")
    hosts = spark.createDataFrame([("bad.host",), (None,)], "host string")
    got = url_verdicts(pages, rules, hosts, max_bits).collect()
    by = {r.page_id: (r.host, r.rule, r.verdict) for r in got if r.page_id is not None}
    want = ["net/", None, None, None, "example.net/en/", "net/", "org/fr/", None, None, None, None, "net/", "net/"]
    assert [by[i][1] for i in range(len(urls))] == want
    assert [i for i in range(len(urls)) if by[i][2] == "block"] == [0, 5, 8, 10, 11, 12] and len(got) == len(urls) + 2
    assert by[0][0] == "a.net" and by[1][0] == by[2][0] == ""
    assert url_verdicts(pages.where("false"), rules, hosts).collect() == []
    assert {r.verdict for r in url_verdicts(pages, rules.where("false"), hosts.where("false")).collect()} == {"allow"}


def test_url_long_lists_in_shards_and_passes(spark, monkeypatch):
    rng = random.Random(9)
    hosts = [f"h{rng.randrange(10**9)}.{rng.choice(['net', 'org', 'com'])}" for _ in range(2500)]
    blocked, paths = set(rng.sample(hosts, 900)), ["/", "/en/x", "/fr/", ""]
    ruled = {h + p: a for h in rng.sample(hosts, 500) for p, a in [("/", "block"), ("/en/", "allow")]}
    pages = [(i, "https://" + rng.choice(["", "www."]) + rng.choice(hosts) + rng.choice(paths)) for i in range(4000)]
    rules = spark.createDataFrame([(k[:k.index("/")], k[k.index("/"):], a) for k, a in ruled.items()], "host string, path string, action string")
    listed = spark.createDataFrame([(h,) for h in blocked] * 2, "host string")
    passes, dealt = [], url_filter.waves
    monkeypatch.setattr(url_filter, "waves", lambda *a: passes.extend(dealt(*a)) or passes)
    got = url_filter.url_verdicts(spark.createDataFrame(pages, "page_id long, url string"), rules, listed, 1, 1 << 12).collect()
    want = set()
    for i, url in pages:
        host, slash, path = url[8:].partition("/")
        path = slash + path
        fits = [k for h in (host, host[4:] if host.startswith("www.") else host) for p in ("/", "/en/") if path.startswith(p) and (k := h + p) in ruled]
        rule = max(fits, key=lambda k: (len(k), k), default=None)
        want.add((i, host, path, rule, ruled[rule] if rule else "block" if host in blocked else "allow"))
    assert {tuple(r) for r in got} == want and len(got) == len(pages)
    dealt = [c for wave in passes for c, _, _ in wave]
    assert len(passes) > 3 and max(c.shards for c in dealt) > 1 and all(c.shard_words * 64 <= 1 << 12 for c in dealt)


def test_lcs_bits():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        masks = [sum(1 << i for i, x in enumerate(a) if x == y) for y in b]
        assert decontam.lcs([m for m in masks if m], len(a)) == table[-1][-1]


def brute_leaks(docs, bench):
    """Every item against every stretch of every document."""
    items, out = decontam.read_items(bench), set()
    for d in docs:
        texts = decontam.Texts(pa.array([d.text]))
        h = decontam.Words(texts, decontam.ALNUM).hash.tolist()
        for item in items:
            n, known = len(item.words), set(item.words.tolist())
            for a in range(0, max(1, len(h)), n):
                part = h[a:a + 3 * n]
                if sum(x in known for x in part) >= 0.6 * n and decontam.leaks(item, part)[0]:
                    out.add((d.doc_id, item.item_id))
                    break
    return out


def test_op10_recall(spark, docs):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in q.op10_decontamination(spark, SF_SMALL).collect()}
    want = brute_leaks(docs.collect(), bench)
    assert len(got & want) >= 0.9 * len(want) and want
    exact = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench if b.text in (d.text or "")}
    assert exact <= got and got <= want | exact


def test_leak_paraphrases_and_odd_rows(spark, docs):
    rng = random.Random(4)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").limit(6).collect()
    filler = [r.text for r in docs.limit(40).collect()]
    rows = [(i, t, "x") for i, t in enumerate(filler)]
    for b in bench:  # one word in eight dropped or replaced
        words = [w if rng.random() > 0.125 else rng.choice(["", "other"]) for w in b.text.split()]
        rows.append((1000 + b.item_id, f"{filler[0][:300]} {' '.join(words)} {filler[1][:300]}", "y"))
    rows += [(5000, None, "x"), (5001, "", "x"), (None, bench[0].text, "x"), (5002, "of " * 30000, "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    table = spark.createDataFrame([(b.item_id, b.text, 1) for b in bench] + [(77, None, 1), (78, "", 1), (79, "one", 1), (None, bench[1].text, 1)],
                                  "item_id long, text string, cosine int")
    got = {(r.doc_id, r.item_id) for r in decontam.contamination(odd, table).collect()}
    assert {(1000 + b.item_id, b.item_id) for b in bench} <= got and (None, bench[0].item_id) in got
    assert not any(d in (5000, 5001, 5002) for d, _ in got)
    clean = {r.doc_id for r in decontam.without_leaks(odd, table).collect()}
    assert clean == {r[0] for r in rows} - {d for d, _ in got}
    assert decontam.contamination(odd.where("false"), table).collect() == []
    assert decontam.contamination(odd, table.where("false")).collect() == []


def test_pipeline_stages(spark, docs):
    names = docs.columns
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF_SMALL)
    assert kept.columns == names and kept.exceptAll(docs).isEmpty()
    near = corpus_pipeline.STAGES[1][1](spark, kept, SF_SMALL)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for _, _, c in brute_components(rows, 5, 80, 100)})
    assert near.schema.names == names and near.select(names).exceptAll(kept).isEmpty()
    cut = corpus_pipeline.STAGES[2][1](spark, near, SF_SMALL)
    before = [(r.doc_id, (r.text or "").encode()) for r in near.orderBy("doc_id").collect()]
    want = {d: n - gone for d, n, gone, _, _ in brute_removal(before)}
    got = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == names and set(got) == set(want)
    for d, n in want.items():
        assert n - 6 <= len(got[d].text.encode()) <= n and got[d].n_chars == len(got[d].text)
    clean = corpus_pipeline.STAGES[3][1](spark, cut, SF_SMALL)
    leaky = {d for d, _ in brute_leaks(cut.collect(), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect())}
    assert clean.columns == names and {r.doc_id for r in clean.collect()} >= set(got) - leaky
    packed = corpus_pipeline.STAGES[4][1](spark, clean, SF_SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}


def test_stages_take_odd_rows(spark):
    text = "Ein Satz mit vielen Worten, der in zwei Texten steht und über fünfzig Bytes lang ist. "
    rows = [(1, text * 3, "de", "a", 5), (2, text * 3, "de", "a", 5), (2, text * 3, "de", "a", 5), (None, text + "Ende.", None, None, None),
            (3, None, "de", "a", 5), (4, "", "de", "a", 5), (5, "12345", "de", 'q"\n', 5)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for data in (odd, odd.where("false")):
        out = data
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, data, SF_SMALL).collect() is not None
            out = stage(spark, out, SF_SMALL)
        assert out.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]
    near = corpus_pipeline.near_duplicates(spark, odd, SF_SMALL)
    assert sorted(near.collect(), key=str) == sorted((r for i, r in enumerate(odd.collect()) if i not in (1, 2)), key=str)


def test_scratch_tables_go_with_their_scope(spark):
    import os

    from lakezones.llm.common import scratch_tables, stored

    def there(df):
        return os.path.isdir(os.path.dirname(df.inputFiles()[0].removeprefix("file:")))

    with scratch_tables(spark):
        outer = stored(spark.range(3), "t")
        with scratch_tables(spark):
            inner, kept = stored(spark.range(3), "t"), stored(spark.range(3), "t", keep=True)
            folders = [os.path.dirname(d.inputFiles()[0].removeprefix("file:")) for d in (outer, inner, kept)]
            assert there(inner) and there(kept)
        assert [os.path.isdir(f) for f in folders] == [True, False, True]
        last = stored(spark.range(4), "t", keep=True)
    assert [os.path.isdir(f) for f in folders] == [False, False, False] and last.count() == 4
