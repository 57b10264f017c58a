import random
import struct
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardlake.llm.packing import HarmonicBins, TokenizerIds, cut, pack


@given(st.integers(1, 9000), st.sampled_from([7, 64, 2048]), st.integers(0, 3))
def test_cut_covers_a_document_once(tokens, capacity, cuts):
    pieces = cut(tokens, capacity, cuts)
    place = 0
    for start, length in pieces:
        assert start == place and 0 < length <= capacity
        place += length
    assert place == tokens
    assert len(pieces) <= tokens // capacity + cuts + 1


@given(st.lists(st.integers(1, 64), max_size=300))
def test_bins_take_a_fixed_number_of_a_class(lengths):
    bins, closed = HarmonicBins(64, 10), []
    for n, length in enumerate(lengths):
        found = bins.add((n, 0, length))
        if found:
            kinds = {64 // p[2] for p in found}
            assert len(kinds) == 1 and len(found) == kinds.pop()
            closed.append(found)
    closed += list(bins.rest())
    assert sorted(p[0] for b in closed for p in b) == list(range(len(lengths)))
    assert [b[0][-2] for b in closed] == list(range(10, 10 + len(closed)))
    for bin_ in closed:
        place = 0
        for piece in bin_:
            assert piece[-1] == place
            place += piece[2]
        assert place <= 64


def test_ids_are_those_of_the_library(tokenizer):
    reference, own = Tokenizer.from_file(tokenizer), TokenizerIds(tokenizer)
    assert own.fast is not None
    letters = [chr(c) for c in range(1, 0x250)]
    random.seed(9)
    texts = [x + y for x in letters for y in ("a", " ", "1", "'s", ".", "\n", "é")]
    texts += [y + x for x in letters for y in ("a", " ", "1", "'", ".", "\n", " \n ")]
    texts += ["".join(random.choices(letters, k=random.randrange(40))) for _ in range(3000)]
    texts += ["".join(random.choices([*"ab ,.\n\t's19", "漢", "<|endoftext|>", "ж", "é"],
                                     k=random.randrange(30))) for _ in range(3000)]
    texts += ["x" * 200_000, " " * 5000, "", "ab" * 3000 + "  \n"]
    expected = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert [list(struct.unpack(f"<{len(i) // 4}I", i)) for i in own.encode(texts)] == expected


def _check(found, docs, tokenizer, capacity):
    reference = Tokenizer.from_file(tokenizer)
    ids = {}
    for r in docs:
        whole = reference.encode(r.text or "", add_special_tokens=False).ids + [1]
        ids.setdefault(r.doc_id, []).append(whole)
    pieces, sequences = {}, {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == ids.keys()
    for doc, own in pieces.items():
        if len(ids[doc]) == 1:
            (whole,) = ids[doc]
            place = 0
            for r in sorted(own, key=lambda r: r.start):
                part = whole[r.start:r.start + r.length]
                assert r.start == place and r.doc_tokens == len(whole)
                assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
                place += r.length
            assert place == len(whole)
        else:
            assert sum(r.length for r in own) == sum(map(len, ids[doc]))
    for own in sequences.values():
        place = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= capacity
    return 1 - sum(r.length for r in found) / (len(sequences) * capacity)


def test_table(documents, tokenizer):
    found = pack(documents, tokenizer).collect()
    assert _check(found, documents.collect(), tokenizer, 2048) < 0.04


def test_tasks_pack_on_their_own(documents, tokenizer):
    docs = documents.repartition(6)
    found = pack(docs, tokenizer, capacity=512, with_ids=True).collect()
    assert _check(found, documents.collect(), tokenizer, 512) < 0.04
    assert {r.sequence_id >> 33 for r in found} == set(range(6))
    assert all(len(r.ids) == r.length for r in found)


def test_odd_rows(odd, none, tokenizer):
    _check(pack(odd, tokenizer).collect(), odd.collect(), tokenizer, 2048)
    assert pack(none, tokenizer).count() == 0
    with pytest.raises(ValueError):
        pack(none, tokenizer, capacity=0)
