import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from docketlake.llm.token_output import PieceEncoder


def test_added_tokens():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = ["plain words here", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "<|endoftext|", "", "plain <| words"]
    ids, sizes = PieceEncoder(path).encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert 50256 in ids
