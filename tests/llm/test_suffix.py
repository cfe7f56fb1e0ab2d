import random

import numpy as np
import pytest
from .brute import AWKWARD, repeats

from tierforge.llm import suffix as S


def held(rows):
    return sorted((str(r["doc_id"]), *r[1:]) for r in rows)


def wanted(pairs, length):
    return sorted((str(i), *x) for (i, _), x in zip(pairs, repeats([t for _, t in pairs], length)))


@pytest.mark.parametrize("length", [8, 40])
def test_awkward_texts(awkward, length):
    pairs = [(i, (t or "")[:4000]) for i, t in AWKWARD]
    table = awkward.sparkSession.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    assert held(S.repeats(table, length=length, block=3000).collect()) == wanted(pairs, length)


def test_documents(docs):
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert held(S.repeats(docs, block=100_000).collect()) == wanted(pairs, 200)


def test_shared_passages_in_many_places(shipped):
    random.seed(5)
    parts = ["".join(random.choice("abcdé ") for _ in range(random.randrange(1, 400))) for _ in range(30)]
    pairs = [(i, "".join(random.choices(parts, k=random.randrange(6)))) for i in range(200)]
    pairs += [(900, "a" * 3000), (901, "ab" * 900), (902, "x" * 199), (903, "x" * 200), (904, parts[0] + "a" * 210), (905, parts[1]), (905, parts[1])]
    table = shipped.createDataFrame(pairs, "doc_id long, text string").repartition(6)
    assert held(S.repeats(table, block=20_000).collect()) == wanted(pairs, 200)


def test_pieces_of_a_long_text_find_the_same(monkeypatch):
    random.seed(6)
    text = "".join(random.choice("abc") for _ in range(3000)) * 2
    data, offs = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    keys = lambda: sorted(np.concatenate([p.strings(p.starts + p.low, 40)[0] for p in S.pieces(data, offs, 40)]).tolist())
    whole = keys()
    monkeypatch.setattr(S, "_PIECE", 700)
    assert keys() == whole and len(set(whole)) == 3000


def test_refinement_separates_what_differs_late():
    text = np.frombuffer(b"a" * 39 + b"b" + b"a" * 39 + b"c", np.uint8)
    piece = S.Piece(text, np.array([0, 80]), 0, 80, 40)
    pointers, _ = piece.strings(np.array([0, 40]), 40)
    assert pointers[0] != pointers[1] and piece.pointers[0] == piece.pointers[40]


def test_empty_table(awkward):
    assert S.repeats(awkward.filter("false")).collect() == []
