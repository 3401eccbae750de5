import numpy as np

from lavra.llm import tagger
from lavra.llm.pii import find_personal_data, redact_personal_data, spans_of
from lavra.llm.tagger import CLASSES, CharTagger, encode

TEXT = "Nosso método compara cada acervo. Agradeço a Fernanda Urbatino Cordela pela leitura atenta. Contato: ana.urbatino@correio.example. CPF/RG informado: 123.456.789-00. Ligar para +55 52 93518-1782 em horário comercial."
KINDS = ["PERSON", "EMAIL", "ID", "PHONE"]


def test_gradients_agree_with_differences():
    t = CharTagger.fresh(4, 5, seed=3)
    rng = np.random.default_rng(1)
    ids, gold = rng.integers(0, CLASSES, (3, 6)).astype(np.int16), rng.integers(0, 5, (3, 6))
    _, grads = t.gradients(ids, gold)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = t.w[name][at]
        t.w[name][at] = kept + 1e-2
        up = t.gradients(ids, gold)[0]
        t.w[name][at] = kept - 1e-2
        down = t.gradients(ids, gold)[0]
        t.w[name][at] = kept
        assert abs(g[at] - (up - down) / 2e-2 * 6) < 2e-2 * max(1, abs(g[at]))


def test_training_learns_a_small_language_and_weights_survive():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc "), 20)) + "99" + "".join(rng.choice(list("abc "), 10)) for _ in range(120)]
    gold = np.zeros((120, 32), np.int8)
    gold[:, 20], gold[:, 21] = 1, 2
    t = CharTagger.fresh(6, 3, seed=1)
    t.fit(np.stack([encode(x) for x in texts]), gold, epochs=40, batch=30, rate=0.03)
    again = CharTagger.from_bytes(t.to_bytes())
    tags = again.decode(again.text_scores(texts[:40]))
    assert np.mean([(x == g).all() for x, g in zip(tags, gold)]) > 0.9


def test_decoding_skips_nothing_that_the_search_would_find():
    t = CharTagger.from_bytes(__import__("lavra.llm.pii", fromlist=["x"]).WEIGHTS.read_bytes())
    texts = [TEXT, TEXT.upper(), "", "sem nada", TEXT * 4]
    scores = t.text_scores(texts)
    whole = [t._viterbi(s[:, None, :])[:, 0] if len(s) else np.zeros(0, np.int8) for s in scores]
    assert all((a == b).all() for a, b in zip(t.decode(scores), whole))


def test_items_are_found_and_masked(spark):
    rows = [(1, TEXT), (2, "plain text"), (3, None), (4, ""), (None, TEXT), (1, TEXT), (5, "x " * 3000 + TEXT)]
    df = spark.createDataFrame(rows, "k long, text string").withColumnRenamed("text", "pii_kind")
    found = find_personal_data(df, "k", "pii_kind").collect()
    one = sorted((r["start_pos"], r["pii_kind"]) for r in found if r["k"] == 5)
    assert [k for _, k in one] == KINDS and one[0][0] == 6000 + TEXT.index("Fernanda") + 1
    assert sum(r["k"] == 1 for r in found) == 8 and sum(r["k"] is None for r in found) == 4 and not [r for r in found if r["k"] in (2, 3, 4)]
    masked = {r["k"]: (r["pii_kind"], r["redactions"]) for r in redact_personal_data(df.where("k > 1"), "k", "pii_kind").collect()}
    assert masked[2] == ("plain text", 0) and masked[3] == (None, 0) and masked[4] == ("", 0)
    assert masked[5][0].endswith("Agradeço a <<PERSON>> pela leitura atenta. Contato: <<EMAIL>>. CPF/RG informado: <<ID>>. Ligar para <<PHONE>> em horário comercial.")
    assert find_personal_data(df.limit(0), "k", "pii_kind").count() == 0


def test_spans_end_at_words_and_spare_placeholders():
    text = "veja <<PERSON>> e Ana Lima."
    tags = np.zeros(len(text), np.int8)
    tags[7:13], tags[19:22], tags[22:25] = 10, 10, 10
    assert [text[a:b] for a, b, _ in spans_of(text, tags)] == ["Ana Lima"]


def test_one_product_a_step_serves_both_directions(monkeypatch):
    t, shapes, product = CharTagger.fresh(5, 7, seed=2), set(), np.matmul
    ids = np.random.default_rng(4).integers(0, CLASSES, (6, 45)).astype(np.int16)
    monkeypatch.setattr(tagger.np, "matmul", lambda *a, **k: shapes.add(a[0].shape) or product(*a, **k))
    found = t.scores(ids)
    assert shapes == {(2, 6, 5)}
    assert np.abs(found - t._forward(ids)[0]).max() < 1e-4
    sizes = np.array([1, 8, 9, 30, 45, 45])
    for r, size in enumerate(sizes):
        assert np.abs(t.scores(ids, sizes)[:size, r] - t._forward(ids[r : r + 1, :size])[0][:, 0]).max() < 1e-4


def test_one_product_a_step_serves_all_gates(monkeypatch):
    t, product = CharTagger.fresh(5, 7, seed=3), np.matmul
    t.w["bias"][:] = np.arange(7)
    for steps in (1, 2, 9, 10):
        ids, shapes = np.random.default_rng(steps).integers(0, CLASSES, (6, steps)).astype(np.int16), []
        with monkeypatch.context() as m:
            m.setattr(tagger.np, "matmul", lambda *a, **k: shapes.append(a[1].shape) or product(*a, **k))
            found = t.scores(ids)
        assert sorted(shapes) == [(2, 5, 7)] * steps + [(2, 5, 20)] * steps  # gates, then tags
        assert np.abs(found - t._forward(ids)[0]).max() < 1e-4


def test_windows_in_parts_have_the_scores_of_all_together(monkeypatch):
    t, sizes = CharTagger.fresh(5, 7, seed=3), np.array([3, 8, 9, 9, 10])
    ids = np.random.default_rng(8).integers(0, CLASSES, (5, 10)).astype(np.int16)
    room = np.empty(400, np.float32)
    for together in (1, 2, 4, 5):
        monkeypatch.setattr(tagger, "TOGETHER", together)
        for found in (t.scores(ids, sizes), t.scores(ids, sizes, room)):
            for r, size in enumerate(sizes):
                assert np.abs(found[:size, r] - t._forward(ids[r : r + 1, :size])[0][:, 0]).max() < 1e-4


def test_stretches_that_cannot_pay_are_found_for_all_texts_at_once():
    t, rng = CharTagger.fresh(3, 5, seed=7), np.random.default_rng(5)
    t.w["trans"][:] = rng.normal(0, 0.1, (5, 5))
    t.w["trans"][0, 1:] -= 8
    trans, scores = t.w["trans"].astype(np.float64), [rng.normal(-1.2, 1.5, (n, 5)).astype(np.float32) for n in (0, 1, 15, 16, 17, 200, 900)]
    for s in scores[3:]:
        s[:, 0] += 3
    for s, near in zip(scores, t._possible(scores)):
        runs = np.zeros(len(s), bool)
        for b in (1, 3):
            gain = np.maximum(s[:, b], s[:, b + 1]) - s[:, 0] + trans[b + 1, b + 1] - trans[0, 0]
            price = trans[0, b] + trans[b, b + 1] + trans[b + 1, 0] - 2 * trans[b + 1, b + 1] - trans[0, 0]
            for a in range(len(s)):
                for e in np.flatnonzero(np.cumsum(gain[a:].astype(np.float64)) + price > -t.EDGE):
                    runs[a : a + e + 1] = True
        assert np.flatnonzero(runs).tolist() == near.tolist()
    assert t._possible([]) == [] and 0 < sum(map(len, t._possible(scores[3:]))) < 900


def test_windows_cover_a_text_and_their_weights_make_one(monkeypatch):
    t = CharTagger.fresh(3, 5, seed=1)
    monkeypatch.setattr(t, "scores", lambda ids, sizes=None: np.ones((ids.shape[1], len(ids), 5), np.float32))
    sizes = [0, 1, 31, 32, 33, 320, 321, 400, 607, 608, 609, 2200]
    for size, s in zip(sizes, t.text_scores(["x" * n for n in sizes])):
        assert s.shape == (size, 5) and np.abs(s - 1).max(initial=0) < 1e-6
        windows = tagger.windows_of(size)
        assert all(b - a <= tagger.WINDOW for a, b in windows) and all(b - c == tagger.OVERLAP for (_, b), (c, _) in zip(windows, windows[1:]))


def test_tags_are_those_of_whole_scores_and_only_stretches_that_may_pay_are_blended(monkeypatch):
    t, rng = CharTagger.from_bytes(__import__("lavra.llm.pii", fromlist=["x"]).WEIGHTS.read_bytes()), np.random.default_rng(6)
    plain = "nosso método compara os dados de cada acervo com os resultados descritos antes. "
    texts = ["", TEXT, "a", "sem nada " * 30, "\ud800", *((plain * 9)[-n:] + TEXT + plain * 30 for n in rng.integers(1, 700, 12)), TEXT[:32] * 5, ""]
    fresh = CharTagger.fresh(4, 5, seed=9)
    fresh.w["trans"][0, 1:] -= 4
    for model, rows in ((t, 768), (t, 7), (fresh, 5), (CharTagger.fresh(4, 5, seed=8), 5)):
        for got, want in zip(model.tag(texts, rows), model.decode(model.text_scores(texts)), strict=True):
            assert got.tolist() == want.tolist()
    assert t.tag([]) == [] and [len(x) for x in t.tag(["", ""])] == [0, 0]
    blended, blend = [], t._blended
    monkeypatch.setattr(t, "_blended", lambda spans, *a: blended.extend(b - a for a, b in spans) or blend(spans, *a))
    assert sum((x > 0).sum() for x in t.tag(texts)) > 1000 and sum(blended) < 0.5 * sum(map(len, texts))


def test_the_end_of_a_text_is_read_alike_whatever_stands_beside_it():
    t = CharTagger.from_bytes(__import__("lavra.llm.pii", fromlist=["x"]).WEIGHTS.read_bytes())
    texts = [x for n in (0, 5, 40, 60) for x in (" " * n + "1" * (43 + n), " " * (52 + n), TEXT[: TEXT.index(" pela") - n])] + [TEXT]
    together = [x.tolist() for x in t.tag(texts)]
    assert together == [t.tag([x])[0].tolist() for x in texts]
    behind = np.array([[0] + [-1e4] * (t.tags - 1)], np.float32)
    assert together == [t._viterbi(np.concatenate([s, behind])[:, None, :])[:-1, 0].tolist() for s in t.text_scores(texts)]
