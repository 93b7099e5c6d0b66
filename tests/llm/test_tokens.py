"""What the library is asked to encode, and that its ids stay those of whole texts."""
import numpy as np

from recoengine.llm import tokens

TEXTS = ["alpha beta. beta, beta! gamma\nbeta (beta) beta", " beta it's beta's 12beta12 é.\n", "", None, "x beta\n\nbeta  beta", "日本 beta\0 \n beta\n"]


class Counted:
    def __init__(self, inner):
        self.inner, self.sent = inner, []

    def encode_batch_fast(self, batches, **options):
        self.sent += [p for b in batches for p in b]
        return self.inner.encode_batch_fast(batches, **options)


def _whole(enc, text):
    return np.array([*enc.whole.encode(text or "", add_special_tokens=False).ids, tokens.END_ID], dtype="<u4").tobytes()


def test_a_piece_that_units_share_is_encoded_once():
    enc = tokens.Encoder(tokens.default_tokenizer())
    enc.pieces = Counted(enc.pieces)
    assert enc(TEXTS) == [_whole(enc, t) for t in TEXTS]
    assert enc.pieces.sent and len(enc.pieces.sent) == len(set(enc.pieces.sent))


def test_ids_stay_right_where_tokens_do_not_tell_the_ends():
    enc = tokens.Encoder(tokens.default_tokenizer())
    enc.sizes = enc.sizes + 1
    assert enc(TEXTS) == [_whole(enc, t) for t in TEXTS]
