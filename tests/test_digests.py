"""Digests hash a value once, and their sums are exact."""

import hashlib

import pyarrow as pa

from arenamart.plans.catalogue import digests


def test_values_that_come_again_are_hashed_once(monkeypatch):
    made = []

    def md5(text, **options):
        made.append(text)
        return hashlib.new("md5", text, **options)

    monkeypatch.setattr(digests.hashlib, "md5", md5)
    cells = digests._cells("c", pa.array([7, None, 7, 10**15, 7]))
    first = int(hashlib.new("md5", b"c=7.000000").hexdigest()[:7], 16)
    large = int(hashlib.new("md5", b"c=1000000000000000").hexdigest()[:7], 16)
    assert cells.tolist() == [first, 0, first, large, first] and len(made) == 2


def test_squares_of_digests_are_exact():
    batch = pa.RecordBatch.from_pydict({f"c{i}": list(range(50)) for i in range(90)})
    [found] = digests._sums(iter([batch]))
    rows = zip(*[digests._cells(n, c).tolist() for n, c in zip(batch.schema.names, batch.columns)])
    assert found.to_pylist() == [{"n": 50, "squares": sum(sum(r) ** 2 for r in rows)}]
