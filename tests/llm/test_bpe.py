import hashlib
import random

import public_tokenizers
import pytest
from genoframe.llm import bpe
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(2)
    tokens = [t.replace("</w>", "") for t in bpe.load(PATH).tokens]
    out = ["", "  ", "a", "<|endoftext|> hi <|startoftext|>there<|endoftext|>", "<|endoftext", "don't WE'LL I'd '''s", "Ünï ²³ ½ ﬁ Σας ΣΑΣ İ 日本語 한국어 é \x1f \x85 \xa0 __x__", "😀😀👍🏽", "a" * 50, "ab" * 300, "!?" * 40]
    out += ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))) for _ in range(1500)]
    out += ["".join(rng.choice("abcdeth'. 1é") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    return out + ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0x3000), rng.randint(0x1F300, 0x1F9FF)])) for _ in range(rng.randint(1, 30))) for _ in range(300)]


def test_ids_are_those_of_the_library(library):
    own = bpe.load(PATH)
    for text in texts():
        want = library.encode(text, add_special_tokens=False).ids
        ids, said, back = own.text(text)
        assert ids == want and said == " ".join(map(str, want)) and back == library.decode(want, skip_special_tokens=False), text
        assert own.decode(want) == back


def test_a_full_cache_is_dropped(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    own = bpe.Tokenizer(PATH)
    first = [own.text(t) for t in texts()[:300]]
    assert first == [bpe.load(PATH).text(t) for t in texts()[:300]] and len(own.known) <= 11


def test_frames(table, odd, empty, library):
    out = bpe.encode(odd, PATH)
    want = library.encode("a b c d e f", add_special_tokens=False).ids
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == 6 and rows[1].ids == want and rows[1].ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
    assert rows[3].n_tokens == 0 and rows[3].ids == [] and rows[3].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert {r.text for r in bpe.decode(out.where("doc_id = 1"), PATH).collect()} == {library.decode(want, skip_special_tokens=False)}
    assert bpe.encode(empty, PATH).count() == 0
