import zlib

import pytest

from cardlake.llm.sharding import shard_by_bytes


def _check(found, rows, shards):
    expected = sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), str(i)) for i, t in rows)
    assert sorted((r["size"], r.text_crc32, str(r.doc_id)) for r in found) == expected
    total, longest = sum(e[0] for e in expected), max(e[0] for e in expected)
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r)
    for shard, own in by_shard.items():
        assert 0 <= shard < shards
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= longest
    order = sorted(found, key=lambda r: (r.shard, r.slot))
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert ids == sorted(ids)
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}


@pytest.mark.parametrize("partitions", [1, 5, None])
def test_whole_table(documents, partitions):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    _check(shard_by_bytes(documents, partitions=partitions).collect(), rows, 16)


def test_partitions_do_not_change_the_result(documents):
    first, second = (
        {tuple(r) for r in shard_by_bytes(documents.repartition(n), partitions=n).collect()}
        for n in (2, 9))
    assert first == second


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    _check(shard_by_bytes(odd, shards=3).collect(), rows, 3)
    assert shard_by_bytes(none).count() == 0
    with pytest.raises(ValueError):
        shard_by_bytes(none, shards=0)


def test_fewer_rows_than_shards_and_one_id_for_all(make):
    found = shard_by_bytes(make([(7, "x")] * 3), shards=8).collect()
    assert len(found) == 3 and len({r.shard for r in found}) == 3
    found = shard_by_bytes(make([(7, "x")] * 4000), shards=4, partitions=6).collect()
    _check(found, [(7, "x")] * 4000, 4)
