import random

import numpy as np
import pytest
import sentencepiece

from queuelog.llm import pieces, transducer


@pytest.fixture(scope="module")
def machine():
    return transducer.Transducer()


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_equal_to_the_model(machine, model):
    r = random.Random(11)
    names = list(machine.model.ids)
    texts = ["", " ", "  ", "▁", "a", " a", "a ", "\n", "x" * 3000, "中文字" * 400, "ab" * 700 + " é😀"]
    texts += ["".join(r.choice(names) for _ in range(r.randint(1, 12))).replace("▁", r.choice(["▁", " "])) for _ in range(1500)]
    for text, ids in zip(texts, machine.encode_all(texts)):
        assert ids.tolist() == model.encode(text)
    ids = machine.encode_all(texts)
    ends = [0, *np.cumsum(list(map(len, ids))).tolist()]
    assert machine.decode_all(np.concatenate(ids), ends) == [t.replace("▁", " ") for t in texts]


def test_acceptor_by_merging(machine):
    """A pair passes just when merging the characters of both gives back the two."""
    r = random.Random(3)
    ids = list(machine.name)
    left, right = np.array([(r.choice(ids), r.choice(ids)) for _ in range(4000)]).T
    inside = [p for p in machine.model.ids if len(p) > 3]
    cut = [(p[:n], p[n:]) for p in r.sample(inside, 1500) for n in [r.randint(1, len(p) - 1)]]
    more = [(machine.model.ids[a], machine.model.ids[b]) for a, b in cut if a in machine.model.ids and b in machine.model.ids]
    left, right = np.append(left, [a for a, _ in more]), np.append(right, [b for _, b in more])
    want = [machine.merged(machine.name[a] + machine.name[b])[0] == [machine.name[a], machine.name[b]] for a, b in zip(left.tolist(), right.tolist())]
    assert machine.accepted(left, right).tolist() == want
    assert machine.passes(left, right).tolist() == want == machine.passes(left, right).tolist()


def test_shortest_path_against_every_path(machine):
    """Of all paths through the composed machine the least weight wins; there is one at most."""
    def paths(text, at, last):
        if at == len(text):
            yield 0.0, []
            return
        for n in range(1, len(text) - at + 1):
            piece = machine.model.ids.get(text[at : at + n])
            if piece is not None and machine.accepted(np.array([last]), np.array([piece]))[0]:
                yield from ((w + machine.cost[piece], [piece, *rest]) for w, rest in paths(text, at + n, piece))

    r = random.Random(9)
    for _ in range(60):
        word = "▁" + "".join(r.choice("aeinrst") for _ in range(r.randint(1, 8)))
        found = sorted(paths(word, 0, -1))
        assert len(found) == 1
        assert machine.shortest([word])[0].tolist() == found[0][1]


@pytest.mark.parametrize("together, cache", [(3, 5), (256, 200_000)])
def test_long_parts_and_small_caches(monkeypatch, machine, model, together, cache):
    monkeypatch.setattr(transducer, "TOGETHER", together)
    monkeypatch.setattr(transducer, "CACHE", cache)
    monkeypatch.setattr(transducer, "VERDICTS", cache)
    r = random.Random(2)
    for _ in range(30):
        texts = ["".join(r.choice("aeiost n") for _ in range(r.randint(0, 80))) for _ in range(5)]
        assert [x.tolist() for x in machine.encode_all(texts)] == [model.encode(t) for t in texts]


def test_numbers_and_trie():
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 1 << 40, 5000))
    found = pieces.Numbers(keys, np.arange(len(keys)), -1)
    assert (found.get(keys) == np.arange(len(keys))).all()
    other = r.integers(1 << 41, 1 << 42, 2000)
    assert (found.get(other) == -1).all()
    assert (pieces.Numbers(np.empty(0, np.int64), np.empty(0), 0.5).get(keys[:3]) == 0.5).all()
    words = {"a": 4, "ab": 5, "abc": 6, "bc": 7, "é": 8}
    trie = pieces.Trie(words)
    text = "abcxéab"
    letters = trie.letter[pieces.codes_of(text)]
    for ends in (np.full(len(text), len(text)), np.array([2, 2, 7, 7, 7, 7, 7])):
        got = sorted(zip(*(x.tolist() for x in trie.arcs(letters, ends))))
        assert got == sorted((a, b, words[text[a:b]]) for a in range(len(text)) for b in range(a + 1, ends[a] + 1) if text[a:b] in words)
