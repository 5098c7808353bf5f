"""Texts cut at single spaces give the ids of texts encoded match by match."""

import random

from matchloom.llm import bpe


def test_spaces_of_all_kinds():
    t = bpe.tokenizer(*bpe.default_vocabulary())
    r = random.Random(5)
    parts = ["a", "word", "été", "酒店", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "1234", "don't", "x" * 80, "", "ab" * 40]
    for _ in range(400):
        text = "".join(r.choice(parts) + r.choice([" ", " ", "", "\n"]) for _ in range(r.randint(0, 12)))
        whole = [i for m in t.pattern.findall(text) for i in t.encode_piece(m.encode())]
        assert t.encode(text) == whole
        assert t.decode_text(t.encode_text(text)) == t.decode(whole) == text.encode()


def test_full_memory_forgets_only_what_is_not_used(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 4)
    t = bpe.Tokenizer(bpe.tokenizer(*bpe.default_vocabulary()).ranks, bpe.default_vocabulary()[1])
    made = []
    encode = t.encode_stretch
    t.encode_stretch = lambda text: made.append(text) or encode(text)
    for k in range(50):
        assert t.encode(f"often w{k}") == encode(f"often w{k}")
        assert len(t.first) <= 4 and len(t.rest) <= 4 and len(t.rest.older) <= 4
    for k in range(5):
        t.rest["kept"], t.rest[f"v{k}"]
    assert made.count(" kept") == 1 and made.count("often") == 1
