import hashlib
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardlake.llm.bpe_automaton import Encoder, code_digests, coded


@pytest.fixture(scope="module")
def both(tokenizer):
    return Encoder(tokenizer), Tokenizer.from_file(tokenizer)


def _ids(encoder, text):
    raw = encoder.encode(text)
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def _agree(both, text):
    encoder, reference = both
    expected = reference.encode(text, add_special_tokens=False).ids
    assert _ids(encoder, text) == expected
    assert encoder.automaton.decode(expected) == reference.decode(expected, skip_special_tokens=False)


PARTS = [
    "a", "b", "aa", "th", "the", "e", "ing", " ", "  ", "\n", "\t", "\r", "'s", "'ll", "'", "1", "23",
    "é", "ß", "漢", "😀", "$$", "!", "-", "_", "=", "<|endoftext|>", "<|endo", "\x1c", "\x85", "́",
    " ", "१", "²", "Ⅷ", "‍",
]


def test_random_texts_as_the_library(both):
    random.seed(5)
    for n in range(6000):
        text = "".join(random.choice(PARTS) for _ in range(random.randrange(14)))
        if n % 3 == 0:
            text += random.choice("abcde-=_.") * random.randrange(200)
        _agree(both, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(blacklist_categories=["Cs", "Cn", "Co"], max_codepoint=0x2FFF)))
def test_any_text_as_the_library(both, text):
    _agree(both, text)


def test_exactly_one_path_spells_a_word(both):
    automaton = both[0].automaton

    def paths(word, last=-1):
        if not word:
            yield []
        for size in range(1, len(word) + 1):
            token = automaton.ids.get(word[:size])
            if token is not None and (last < 0 or automaton._arc(last, token)):
                for rest in paths(word[size:], token):
                    yield [token, *rest]

    for word in (b" the", b"aaaaaaa", b" stthing", b"abcabc", b"----=", "éé".encode()):
        assert list(paths(word)) == [automaton.encode_word(word)]


def test_each_byte_is_read_once_and_each_state_ends_the_path_so_far(both):
    encoder, reference = both
    random.seed(8)
    words = [" unbelievable", " antidisestablishmentarianism", " " + "ab" * 90, " zzzzyzx", " the"]
    words += [" " + "".join(random.choices("aeinrst", k=random.randrange(1, 25))) for _ in range(200)]
    for word in words:
        read = []

        def stream(word=word, read=read):
            for byte in word.encode():
                read.append(byte)
                yield byte

        for n, state in enumerate(encoder.automaton.states(stream()), 1):
            assert len(read) == n  # nothing is looked at ahead, or again
            assert state == reference.encode(word[:n], add_special_tokens=False).ids[-1]
        assert bytes(read) == word.encode()


def test_states_share_rows_of_the_table(both):
    automaton = both[0].automaton
    rows = len(automaton.next_node) // 256
    assert len(set(automaton.row_of)) == rows < 0.7 * len(automaton.row_of)


def test_table(documents, both, tokenizer):
    found = {r.doc_id: r for r in code_digests(documents, tokenizer).collect()}
    for r in documents.select("doc_id", "text").collect():
        ids = both[1].encode(r.text, add_special_tokens=False).ids
        own = found[r.doc_id]
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_odd_rows(odd, none, tokenizer):
    rows = coded(odd, tokenizer).collect()
    texts = sorted(r.text or "" for r in odd.collect())
    assert sorted(r.decoded for r in rows) == texts
    empty = [r for r in rows if not r.decoded]
    assert len(empty) == 3 and all(not r.ids for r in empty)
    assert coded(none, tokenizer).count() == 0 and code_digests(none, tokenizer).count() == 0
