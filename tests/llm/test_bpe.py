import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from .brute import AWKWARD

from tierforge.llm import bpe as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(library, t):
    ids = np.array(library.encode_ordinary(t or ""), "<u4")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()


def test_documents_and_awkward_rows(docs, awkward, library):
    for table in (docs, awkward):
        want = sorted((str(r["doc_id"]), *digest(library, r["text"])) for r in table.collect())
        assert sorted((str(r[0]), *r[1:]) for r in B.digests(table, PATH, PATTERN).collect()) == want


def test_random_strings(library):
    random.seed(2)
    codec = B.Codec(B.load_ranks(PATH), PATTERN)
    alphabet = "ab \n\tcdeé漢🙂1!aá'stx<|endoftext|>"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randrange(60))) for _ in range(2000)]
    texts += ["a" * 20000, " " * 20000, "ab" * 9999, "漢" * 3000, "!" * 9999, "the quick brown fox " * 500]
    for t in texts:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t) and codec.decode(ids) == t.encode()


def test_bounded_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(B, "KEPT_PIECES", 3)
    monkeypatch.setattr(B, "KEPT_PAIRS", 2)
    codec = B.Codec(B.load_ranks(PATH), PATTERN)
    t = "Words that come and words that gooooo again, zxcvqwrt zxcvqwrtx"
    assert np.frombuffer(codec.encode(t), "<u4").tolist() == library.encode_ordinary(t)


def test_unreachable_entry_only_as_a_whole_piece():
    tokens = [bytes([i]) for i in range(256)] + [b"xyz"]
    codec = B.Codec(tokens, r"\S+|\s+")
    assert np.frombuffer(codec.encode("xyz xyzz"), "<u4").tolist() == [256, 32, 120, 121, 122, 122]


def test_encoded_and_decoded(awkward):
    rows = B.encoded(awkward, PATH, PATTERN)
    assert rows.filter("not round_trip").count() == 0
    back = B.decoded(rows, PATH).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in AWKWARD)


def test_empty_table(awkward):
    assert B.digests(awkward.filter("false"), PATH, PATTERN).collect() == []
