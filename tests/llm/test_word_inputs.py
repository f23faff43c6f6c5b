"""Toxicity: the input of a word is made once."""

import numpy as np

from finlake.llm import toxicity as T


def test_toxicity_makes_the_input_of_a_word_once(monkeypatch):
    texts = ["these words come again " * 40, None, "", "again these", "words " + "Ünï ß " * 30000]
    p, made, inputs = T.initial(), [], T.Words.inputs
    want = []
    for t in texts:
        some = [T.window_logits(p, w, s) for w, s in T.word_chunks(t)]
        want.append(np.concatenate(some) if some else np.zeros(0))
    monkeypatch.setattr(T.Words, "inputs", lambda self, p: (made.append(self.n), inputs(self, p))[1])
    got = T.document_logits(p, texts)
    assert sum(made) == 6
    for (m, total, n), w in zip(got, want):
        assert n == len(w) and (not n or np.isclose(m, w.max(), atol=1e-5))
        assert np.isclose(total, T._sigmoid(w.astype(np.float64)).sum(), rtol=1e-4)
