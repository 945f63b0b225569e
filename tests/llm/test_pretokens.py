"""Pieces of plain letters and signs go to the model pre-token by pre-token: same ids, fewer calls."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from docketlake.llm.token_output import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["word", "Été", "naïve", "ß", "ɏ", "ɐ", "×", "'s", "'re", "'S", "'", "\n", "\n\n", "\t", "12", "½", "٣", "²", ".", "...", "&&&", "\xad", "Ġ", "Ċ", "̀", "日本", "\xa0", "_", "€"]


def test_same_ids():
    r = random.Random(3)
    texts = [" ".join("".join(r.choice(PARTS) for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(1, 40))) for _ in range(400)]
    t, coder = Tokenizer.from_file(PATH), PieceEncoder(PATH)
    for some in (texts[:200], texts[200:], texts[:50]):
        ids, sizes = coder.encode(some)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [t.encode(x, add_special_tokens=False).ids for x in some]


def test_new_pieces_of_known_words(monkeypatch):
    """What the library gets of pieces that hold words it had before, with other signs: nothing."""
    coder = PieceEncoder(PATH)
    coder.encode(["x alpha beta gamma , . ; x, x. x; ! x! é"])
    given = []
    lists = coder._lists
    monkeypatch.setattr(coder, "_lists", lambda texts: given.extend(texts) or lists(texts))
    ids, _ = coder.encode(["x alpha, beta. gamma; alpha. beta!"])
    assert ids.tolist() == Tokenizer.from_file(PATH).encode("x alpha, beta. gamma; alpha. beta!", add_special_tokens=False).ids
    assert given == ["x"], given
