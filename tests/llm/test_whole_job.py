"""Cases that the operators once cut off."""

import random

from lakezones.llm import decontam


def text_of(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def leaks_of(spark, docs, items):
    rows = decontam.contamination(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
                                  spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert all(0 < r.cosine <= 1 for r in rows)
    return {(r.doc_id, r.item_id) for r in rows}


def test_leaks_of_an_item_that_a_third_of_the_documents_hold(spark):
    rng = random.Random(5)
    common, names = [f"w{i}" for i in range(3000)], [f"q{i}" for i in range(400)]
    hot, cold, long, short = (text_of(rng, n, names) for n in (30, 30, 150, 3))
    docs, want = [], set()
    for i in range(90):
        held = [x for x, every in ((0, 3), (1, 45), (2, 4), (3, 5)) if i % every == 0]
        want |= {(i, x) for x in held}
        docs.append(" ".join([text_of(rng, 60, common), *(f"{(hot, cold, long, short)[x]} {text_of(rng, 50, common)}" for x in held)]))
    assert leaks_of(spark, docs, [hot, cold, long, short]) == want


def test_leaks_of_three_documents(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    items = [text_of(rng, n, words) for n in (2, 3, 20, 59)]
    docs = [f"{text_of(rng, 100, words)} {items[2]} {items[0]} {text_of(rng, 100, words)}", text_of(rng, 300, words),
            f"{items[3]} {text_of(rng, 40, words)} {items[1]}"]
    assert leaks_of(spark, docs, items) == {(0, 2), (0, 0), (2, 3), (2, 1)}


def test_every_stretch_that_leaks_is_proposed():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(7)
    words = [f"w{i}" for i in range(12)]
    bench = [{"item_id": i, "text": text_of(rng, rng.randrange(2, 9), words) + rng.choice(["", ". " + text_of(rng, 3, words)])}
             for i in range(40)]
    items = decontam.read_items(bench)
    texts = decontam.Texts(pa.array([text_of(rng, rng.randrange(0, 60), words) for _ in range(60)] + [None, "w1"]))
    w = decontam.Words(texts, decontam.ALNUM)
    v = decontam.Vocabulary(np.unique(np.concatenate([i.words for i in items])))
    counts = w.counts(texts)
    first = np.cumsum(counts) - counts
    for hits in (decontam.HITS, 50):
        decontam.HITS, kept = hits, decontam.HITS
        try:
            got = set(decontam.Signatures.of(v, items, np.zeros(v.size, int)).stretches(w, first, v.columns(w.hash), len(v.known)))
        finally:
            decontam.HITS = kept
        want = {(int(a), i) for f, n in zip(first, counts) for i, item in enumerate(items) for a in range(f, f + n, len(item.words))
                if decontam.leaks(item, w.hash[a:min(a + 3 * len(item.words), f + n)].tolist())[0]}
        assert want and want <= got


def test_short_texts_that_share_half_are_alike(spark):
    from lakezones.llm.winnow import edit_fingerprints

    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefghij  ") for _ in range(n)) for n in range(40, 175)]
    rng.shuffle(texts)
    rows = edit_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts) and all(r.near_edited > 0 and r.near_edited > r.near_next for r in rows)


def test_templates_see_every_turn_of_long_conversations(spark):
    from lakezones.llm.chat_format import Spans, format_turns

    def last_forty(turns, open_reply=False):
        """Keeps the last 40 turns only."""
        return "".join(f"[{r}:{t}]" for r, t in turns[-40:]) + ("[assistant:" if open_reply else "")

    def numbered(turns, open_reply=False):
        return "".join(f"[{i}:{r}:{t}]" for i, (r, t) in enumerate(turns)) + (f"[{len(turns)}:assistant:" if open_reply else "")

    turns = [("assistant" if i % 2 else "user", f"t{i}") for i in range(60)]
    spans = Spans(last_forty)
    got = [spans.add(t) for t in turns]
    assert [g["rewrites"] for g in got] == [i >= 40 for i in range(60)]
    text = ""
    for i, g in enumerate(got):
        text = text[:g["start"]] + g["piece"]
        assert text == last_forty(turns[:i + 1])
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    pieces = format_turns(rows, numbered).orderBy("ord").collect()
    assert "".join(p.piece for p in pieces) == numbered(turns) and not any(p.rewrites for p in pieces)
    for (role, text), p in zip(turns, pieces):
        assert p.piece[p.loss_from:p.loss_to] == (text if role == "assistant" else "")
        assert numbered(turns)[p.start:].startswith(p.piece)


def test_latent_space_is_fitted_on_every_passage_of_every_document(spark):
    import numpy as np

    rng = random.Random(8)
    words = [f"w{i}" for i in range(50)]
    texts = [text_of(rng, rng.choice((0, 1, 31, 32, 33, 700)), [*words, "other", "more"]) for _ in range(40)] + [text_of(rng, 9000, words), None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    known = np.unique(decontam.Words(decontam.Texts(column_of([" ".join(words)])), decontam.ALNUM).hash)
    v = decontam.Vocabulary(known)
    v.weight = np.linspace(1.0, 3.0, v.size)  # some of the benchmark's words do not project
    rows = []
    for t in texts:
        cols = v.columns(decontam.Words(decontam.Texts(column_of([t])), decontam.ALNUM).hash)
        for a in range(0, len(cols), decontam.PASSAGE):
            part, row = cols[a:a + decontam.PASSAGE], np.zeros(len(known))
            own = part[part < len(known)]
            np.add.at(row, own, v.weight[own] * v.rare()[own])
            rows.append(row / np.sqrt((v.weight[part] ** 2).sum()))
    want = np.array(rows)
    assert len(want) > 8 * len([t for t in texts if t])  # more than the eight of a document once taken
    got, n = decontam._product(docs, v, np.eye(len(known)))
    assert n == len(want)
    assert np.allclose(got, want.T @ want, rtol=1e-4, atol=1e-5)


def column_of(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())


def test_word_hashes_beyond_a_table_of_powers():
    """A word's hash does not depend on its place, nor on a border between two tables."""
    from lakezones.llm import words as w

    filler = "ab " * (w._RUN // 3)
    texts = [filler + "Needle " + "x" * (2 * w._RUN), "needle", "", None, "x" * (2 * w._RUN)]
    got = w.Words(w.Texts(column_of(texts)), w.ALNUM)
    first = got.text == 0
    assert got.hash[first][-2] == got.hash[got.text == 1][0] and got.hash[first][-1] == got.hash[got.text == 4][0]
    assert len(set(got.hash.tolist())) == 3 and got.counts(w.Texts(column_of(texts))).tolist() == [len(filler) // 3 + 2, 1, 0, 0, 1]
