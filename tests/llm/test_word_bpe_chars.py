"""Every character of the quick way's table gives the library's ids, alone and between others."""

import numpy as np
from folioflow.llm import op5_tokens
from folioflow.llm.word_bpe import LIMIT, Encoder


def test_each_character_below_limit():
    enc = Encoder(op5_tokens.tokenizer_path())
    for c in map(chr, range(LIMIT)):
        texts = [c, f"a{c}b", f"1{c} {c}{c}, x'{c}", "plain"]
        count, ids = enc.encode(texts)
        want = [x.ids for x in enc.full.encode_batch(texts, add_special_tokens=False)]
        assert [p.tolist() for p in np.split(ids, np.cumsum(count)[:-1])] == want, hex(ord(c))
