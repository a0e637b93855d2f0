"""The language model: counts and base scores against brute force, normalised chances, held-out gain."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from queixa.llm import bilinear
from queixa.llm.bilinear import Model, Settings
from queixa.llm.chunks import unpacked
from queixa.llm.registry import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = Settings(own=20, shared=15, width=6, before=3, noise=8, run=8, batch=4, rounds=2)


def tokens(text):
    return [*WORD.findall((text or "").translate(FOLD)), "\n"]


def held_out(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 10 == 0


def counts_of(rows):
    return Counter(t for doc_id, text in rows if held_out(doc_id) is False for t in tokens(text))


def base_of(rows):
    counts = counts_of(rows)
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        own = tokens(text)
        out.append((doc_id, held_out(doc_id), len(own), sum(counts[t] > 0 for t in own), n,
                    round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own), 6)))
    return out


def counted(rows):
    return sorted((repr((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in rows))


@pytest.mark.parametrize("chunk_bytes", [300, bilinear.CHUNK_BYTES])
def test_counts_and_base(documents, odd_rows, chunk_bytes):
    rng = random.Random(8)
    rows = [r for r in odd_rows if r[0] != 8] + [(100 + i, " ".join(rng.choice(["Ab", "aB", "c", "é", "ÉT", "中", "d."]) for _ in range(rng.randrange(30))))
                                                for i in range(60)] + [(100, "a\u0085b c\x1cd e"), (200, None)]
    got = bilinear.score_texts(documents(rows), SMALL, chunk_bytes).collect()
    assert counted(got) == sorted(map(repr, base_of(rows)))
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_are_normalised(documents):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(1))}" for _ in range(rng.randrange(40)))) for i in range(150)]
    encoded, model, s, _ = bilinear.fitted(documents(rows), SMALL, 500)
    score, schema = bilinear._score(model, s, 1)
    got = {r.doc_id: r.score for r in encoded.mapInArrow(score, schema).collect()}
    counts = counts_of(rows)
    classes = {}
    for r in encoded.select("doc_id", "n_tokens", "classes").collect():
        for word, c in zip(tokens(dict(rows)[r.doc_id]), unpacked(r.classes, np.int16, r.n_tokens).tolist(), strict=True):
            assert classes.setdefault(word, c) == c
    shared = [c for c in set(classes.values()) if c >= s.own]
    assert shared and len(set(classes.values())) - len(shared) == s.own
    total = {c: sum(n + 0.1 for w, n in counts.items() if classes[w] == c) + (0.1 if c >= s.own else 0) for c in set(classes.values())}
    for doc_id, text in rows:
        own, expected = tokens(text), 0.0
        for i, word in enumerate(own):
            before = [classes[own[i - k]] if i >= k else s.classes for k in range(1, s.before + 1)]
            predicted = sum(model.context[c].astype(float) * model.scale[k] for k, c in enumerate(before))
            scores = model.target.astype(float) @ predicted + model.bias
            chances = np.exp(scores - scores.max())
            expected += math.log10(chances[classes[word]] / chances.sum()) + math.log10((counts[word] + 0.1) / total[classes[word]])
        assert got[doc_id] == pytest.approx(expected, abs=1e-3)


def test_training_learns_what_follows(documents):
    """Words that alternate: counts alone give each half the chance, the word before gives it away."""
    rows = [(i, " ".join(["tick", "tock"] * 40)) for i in range(200)]
    got = bilinear.score_texts(documents(rows), SMALL).where("held_out").groupBy().sum("base_score", "score").first()
    assert got[1] > 0.4 * got[0]


def test_gradient_is_that_of_the_objective():
    rng = np.random.default_rng(3)
    s = Settings(own=6, shared=4, width=3, before=2, noise=5, run=3, batch=4, rate=1e-4)
    noise = np.full(s.classes, 1 / s.classes)
    runs = rng.integers(0, s.classes + 1, (4, 5)).astype(np.int32)
    before = np.array([[r[t - 1], r[t - 2]] for r in runs for t in range(2, 5) if r[t] < s.classes])
    classes = np.array([r[t] for r in runs for t in range(2, 5) if r[t] < s.classes])

    def objective(m, drawn):
        p = sum(m.context[before[:, i]].astype(float) * m.scale[i] for i in range(2))
        own = (p * m.target[classes]).sum(1) + m.bias[classes] - np.log(s.noise * noise[classes])
        other = p @ m.target[drawn].T.astype(float) + m.bias[drawn] - np.log(s.noise * noise[drawn])
        return -np.log1p(np.exp(-own)).sum() - np.log1p(np.exp(other)).sum()
    start = Model.start(noise, s)
    trainer = bilinear.Trainer(start.of(start.weights()), noise, s, 5)
    for had in (trainer.had.context, trainer.had.target, trainer.had.scale, trainer.had.bias):
        had[:] = 1e6  # the step is the gradient, scaled
    drawn = np.minimum(np.searchsorted(trainer.cumulated, np.random.default_rng(5).random(s.noise)), s.classes - 1)
    trainer.s = Settings(**{**s.__dict__, "rate": 1.0})
    trainer.step(runs)
    moved = (trainer.m.weights().astype(float) - start.weights()) * 1e3
    flat = start.weights().astype(float)
    for i in rng.permutation(len(flat))[:40]:
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-3
        down[i] -= 1e-3
        slope = (objective(start.of(up), drawn) - objective(start.of(down), drawn)) / 2e-3
        assert moved[i] == pytest.approx(slope, abs=0.02 + 0.02 * abs(slope))


@pytest.mark.parametrize("size", [1.0, 6.0, 40.0])
def test_whole_softmax_without_exponentials_per_token(size, monkeypatch):
    """Scores as by explicit softmax; what is exponentiated does not grow with the text, unless products could leave single precision."""
    rng = np.random.default_rng(4)
    shares = rng.dirichlet(np.ones(SMALL.classes))
    model = Model.start(shares, SMALL)
    model.context, model.target = model.context * 10 * size, model.target * 10
    run = rng.integers(0, SMALL.classes + 1, 700 + SMALL.before).astype(np.int32)
    run[SMALL.before:] %= SMALL.classes
    expected = []
    for t in range(SMALL.before, len(run)):
        predicted = sum(model.context[run[t - 1 - i]].astype(float) * model.scale[i] for i in range(SMALL.before))
        scores = model.target.astype(float) @ predicted + model.bias
        expected.append(scores[run[t]] - scores.max() - np.log(np.exp(scores - scores.max()).sum()))
    done, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, **more: (done.append(np.size(x)), exp(x, **more))[1])
    found = model.log_probabilities(run)
    first = sum(done)
    assert found == pytest.approx(np.array(expected), rel=1e-5, abs=1e-4)
    again = model.log_probabilities(np.tile(run, 3))
    assert again[:len(found)] == pytest.approx(found, rel=1e-5, abs=1e-4)
    if size == 1.0:
        assert sum(done) == first == SMALL.before * (SMALL.classes + 1) * SMALL.classes


def test_large_models_are_scored_without_factors(monkeypatch):
    rng = np.random.default_rng(5)
    model = Model.start(rng.dirichlet(np.ones(SMALL.classes)), SMALL)
    run = rng.integers(0, SMALL.classes, 90).astype(np.int32)
    found = model.log_probabilities(run)
    monkeypatch.setattr(bilinear, "FACTOR_BYTES", 1000)
    whole = model.of(model.weights())
    assert whole.log_probabilities(run) == pytest.approx(found, abs=1e-5)
    assert not len(whole.factors) and len(model.factors)


def test_steps_drawn_ahead_are_those_drawn_one_by_one():
    rng = np.random.default_rng(6)
    shares = rng.dirichlet(np.ones(SMALL.classes))
    start = Model.start(shares, SMALL)
    runs = rng.integers(0, SMALL.classes + 1, (30, SMALL.run + SMALL.before)).astype(np.int32)
    ahead, single = (bilinear.Trainer(start.of(start.weights()), shares, SMALL, 3) for _ in range(2))
    ahead.learn(runs)
    order = single.rng.permutation(len(runs))
    for at in range(0, len(order), SMALL.batch):
        single.step(runs[order[at:at + SMALL.batch]])
    assert np.array_equal(ahead.m.weights(), single.m.weights())


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_log_bilinear_scores"](spark, sf_dir).collect()
    assert counted(got) == sorted(map(repr, base_of(rows)))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from(documents):
    assert bilinear.score_texts(documents([]), SMALL).collect() == []
    ids = [i for i in range(200) if held_out(i)][:3]
    got = bilinear.score_texts(documents([(i, "only held out") for i in ids] + [(None, None)]), SMALL).collect()
    assert len(got) == 4 and all(r.train_tokens == 0 and r.n_known == 0 and np.isfinite(r.score) for r in got)


def test_reruns_agree(documents):
    rng = random.Random(10)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(1))}" for _ in range(rng.randrange(40)))) for i in range(120)]
    first, again = ({r.doc_id: r.score for r in bilinear.score_texts(documents(rows), SMALL, 400).collect()} for _ in range(2))
    assert first == again
