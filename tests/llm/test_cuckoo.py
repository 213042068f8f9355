import hashlib
import random

import numpy as np

from mailframe.llm import cuckoo


def _digests(n, seed=0):
    return np.frombuffer(b"".join(hashlib.sha256(f"{seed}-{i}".encode()).digest() for i in range(n)), np.uint64).reshape(-1, 4)


def test_insert_lookup_delete_and_resize():
    index = cuckoo.CuckooIndex(buckets=4, kicks=20)
    d = _digests(5000)
    for lo in range(0, 5000, 500):
        part = d[lo : lo + 500]
        index.insert(part, np.arange(lo, lo + 500), np.ones(500, np.int64))
    assert index.resizes > 3
    rows = index.lookup(d)
    assert (index.best[rows] == np.arange(5000)).all()
    assert (index.lookup(_digests(2000, seed=1)) == -1).all()  # a fingerprint alone is no hit
    index.delete(rows[::2])
    again = index.lookup(d)
    assert (again[::2] == -1).all() and (again[1::2] == rows[1::2]).all()
    index.insert(d[::2], np.arange(0, 5000, 2), np.ones(2500, np.int64))
    assert (index.best[index.lookup(d)] == np.arange(5000)).all()


def test_upsert_keeps_the_largest_id():
    rng = random.Random(3)
    index, want = cuckoo.CuckooIndex(buckets=2), {}
    d = _digests(50)
    for _ in range(60):
        pick = np.array(rng.sample(range(50), 20))
        ids = np.array([rng.randint(-100, 100) for _ in pick])
        index.upsert(d[pick], ids, np.full(20, 2))
        for p, i in zip(pick.tolist(), ids.tolist(), strict=True):
            best, n = want.get(p, (i, 0))
            want[p] = (max(best, i), n + 2)
    digest, best, count = index.entries()
    at = {x.tobytes(): k for k, x in enumerate(d)}
    assert {at[x.tobytes()]: (int(b), int(c)) for x, b, c in zip(digest, best, count, strict=True)} == want


def test_edge_rows(spark, documents, clashing):
    long = "long " * 50_000
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "b"), (None, "b"), (5, long), (6, long + "x"), (None, "a")]
    got = cuckoo.exact_dedup(clashing(documents(rows))).collect()
    sha = {t: hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows}
    want = []
    for i, t in rows:
        same = [j for j, u in rows if (u or "") == (t or "")]
        keep = max((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, sha[t]))
    assert sorted(map(str, [tuple(r) for r in got])) == sorted(map(str, want))
    assert cuckoo.exact_dedup(documents(rows).limit(0)).count() == 0


def test_many_copies_over_many_salts(spark, documents):
    got = cuckoo.exact_dedup(documents([(i, "same") for i in range(500)])).collect()
    assert {(r["keep_id"], r["group_size"]) for r in got} == {(499, 500)} and sum(r["kept"] for r in got) == 1
