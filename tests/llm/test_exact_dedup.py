import hashlib
import random
import re

from cardlake.llm import exact_dedup
from cardlake.llm.exact_dedup import CuckooIndex, change_index, digests, find_duplicates


def _digest(n):
    return hashlib.sha256(str(n).encode()).digest()


def test_index_against_a_dict_through_growth_and_deletions():
    random.seed(3)
    index, live = CuckooIndex(buckets=2), {}
    for _ in range(6000):
        n = random.randrange(900)
        if random.random() < 0.3:
            assert index.delete(_digest(n)) == (live.pop(n, None) is not None)
        else:
            keep = (False, random.randrange(50), 0)
            index.insert(_digest(n), keep, 1)
            least, rows = live.get(n, (keep, 0))
            live[n] = (min(least, keep), rows + 1)
    assert index.live == len(live) and index.buckets > 2
    assert {e[0]: (e[1], e[2]) for e in index.entries if e} == {
        _digest(n): v for n, v in live.items()}
    assert all((_digest(n) in index) == (n in live) for n in range(1000))


def test_fingerprints_that_agree_are_verified():
    index = CuckooIndex(buckets=2)
    same = b"\x01\x02" + bytes(8)
    first, second = same + b"a" * 22, same + b"b" * 22
    index.insert(first, (False, 1, 0), 1)
    assert first in index and second not in index
    index.insert(second, (False, 2, 0), 1)
    assert index.live == 2 and index.delete(first) and second in index


def test_batches_of_inserts_and_deletions(make):
    def state(index):
        return {(r.keep_id, r.group_size) for r in index.collect()}

    index = change_index(None, inserts=digests(make([(3, "a"), (1, "b"), (2, "a")])))
    assert state(index) == {(2, 2), (1, 1)}
    gone = digests(make([(9, "a"), (9, "never")])).select("digest")
    index = change_index(index, inserts=digests(make([(7, "a"), (0, "b")])), deletes=gone)
    assert state(index) == {(7, 1), (0, 2)}
    assert state(change_index(index, deletes=gone)) == {(0, 2)}


def test_against_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        groups.setdefault(hashlib.sha256(key.encode()).hexdigest(), []).append(r.doc_id)
    expected = {(i, min(g), len(g), i == min(g), h) for h, g in groups.items() for i in g}
    assert {tuple(r)[:5] for r in find_duplicates(documents).collect()} == expected


def test_nulls_ties_and_repeated_rows(make, none):
    docs = make([(None, "b"), (4, "a  c"), (4, "a c"), (2, None), (3, ""), (None, "a\tc"), (None, "b")])
    found = find_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in found) == sorted([
        ("None", "None", 2), ("None", "None", 2), ("4", "4", 3), ("4", "4", 3), ("None", "4", 3),
        ("2", "2", 2), ("3", "2", 2)])
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(texts) == 3 and (2, None) in texts and (None, "b") in texts
    assert find_duplicates(none).count() == 0 and exact_dedup.drop_duplicates(none).count() == 0


def test_a_group_of_a_third_of_all_rows(make):
    docs = make([(i, "same" if i % 3 == 0 else str(i)) for i in range(3000)]).repartition(7)
    found = {r.doc_id: r for r in find_duplicates(docs).collect()}
    assert found[2997].keep_id == 0 and found[0].group_size == 1000
    assert sum(r.kept for r in found.values()) == 2001
