"""Random strings among words, separators and base spans."""

import random
import string

import public_tokenizers as P

from gridloom.llm import byte_bpe, secrets

WORDS = ["https://hooks.example.com/services/notifications/production/", "/users/alice/projects/website/deployment/credentials/", "https://downloads.example.com/releases/stable/installer/"]


def test_random_strings_in_runs():
    enc = byte_bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rng = random.Random(8)
    for words in WORDS:
        for n in (20, 24, 32):
            for _ in range(40):
                key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n - 2)) + "a7"
                text = f"see {words}{key}/index-of-all-documents end"
                spans = secrets.spans_of(text, enc, 2.0)[1]
                at = text.index(key)
                assert any(a <= at and at + n <= b for a, b, _ in spans), text


def test_rest_of_a_run_beside_a_base_span():
    enc = byte_bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    key, digest = "q7Zk29XvB4mT8sWpL3nRfH6y", "0a" * 20
    text = f"x {key}/{digest}/{key} y"
    base, spans = secrets.spans_of(text, enc, 2.0)
    assert [k for _, _, k in base] == ["hex"] and [k for _, _, k in spans] == ["random", "hex", "random"]
    assert spans[0][:2] == (2, 2 + len(key) + 1) or spans[0][:2] == (2, 2 + len(key))
    assert all(key not in text[a:b] or k == "random" for a, b, k in spans)


def test_words_and_identifiers_are_not_random():
    enc = byte_bpe.encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    ident = "123e4567-e89b-12d3-a456-426614174000"
    for text in [*WORDS, f"/users/alice/Documents/website/deployment/{ident}", f"/releases/Stable/documents/{'AB12' * 10}/notes", "/archive/Documents/2024-01-15/meeting-notes"]:
        assert not secrets.spans_of(text, enc, 2.0)[1], text
