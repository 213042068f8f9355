import collections
import math
import random
import re

import pytest

from mailframe.llm import jaccard_join as J
from mailframe.llm.components import connected
from tests.conftest import SF_ORACLE
from tests.llm.conftest import words


def brute(rows):
    """(links, least id of the component, least id of the copies, copies) of each row, in order."""
    sets = []
    for _, t in rows:
        w = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k, s in enumerate(sets):
        shared = collections.Counter(o for x in s for o in holders[x] if o < k)
        for o, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[o]) - n):
                links[k] += 1
                links[o] += 1
                root[find(k)] = find(o)
    out = []
    for k, (i, _) in enumerate(rows):
        group = [rows[o][0] for o in range(len(rows)) if find(o) == find(k)]
        copies = [rows[o][0] for o in range(len(rows)) if sets[k] and sets[o] == sets[k]] or [i]
        least = [min((x for x in g if x is not None), default=None) for g in (group if sets[k] else [i], copies)]
        out.append((i, least[0], links[k], least[1], len(copies)))
    return out


def _rows(df):
    return sorted(map(str, [tuple(r) for r in df.select("doc_id", "class_id", "n_links", "copy_id", "n_copies").collect()]))


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert _rows(J.jaccard_join(docs)) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("block", [512, 7])
def test_hot_near_copies_and_edges(spark, documents, clashing, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(block)
    base = words(rng, 120).split()
    rows = []
    for i in range(60):  # one large group around the threshold
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = words(rng, 1)
        rows.append((i, " ".join(w)))
    line = words(rng, 12)
    rows += [(100 + i, line + " " + words(rng, 15)) for i in range(40)]  # a common line, nothing more
    rows += [(200, None), (201, ""), (202, "..."), (203, "one two"), (204, "One, two!"), (205, "one"), (None, "one two"), (206, words(rng, 20_000))]
    rows += [(1, rows[1][1]), (300, rows[1][1])]
    assert _rows(J.jaccard_join(clashing(documents(rows)))) == sorted(map(str, brute(rows)))


def test_empty_table(spark, documents):
    assert J.jaccard_join(documents([(1, "a b")]).limit(0)).count() == 0


def test_posterior_bound_is_the_beta_tail():
    for n, least in J.least_matches(0.8, 1e-6).items():

        def tail(m, n=n):
            steps = 20_000
            mass = [math.exp(m * math.log(x) + (n - m) * math.log1p(-x)) for x in ((k + 0.5) / steps for k in range(steps))]
            return sum(mass[int(0.8 * steps) :]) / sum(mass)

        assert tail(least) >= 1e-6 * 0.99
        assert least == 0 or tail(least - 1) < 1e-6 * 1.01


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected(edges, "a", "b").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_near_copies_never_become_pair_rows(documents, monkeypatch):
    """A cluster of n near copies leaves a few rows for each, not n(n-1)/2 of anything."""
    import random

    rng = random.Random(3)
    base = words(rng, 120).split()
    n = 120
    docs = documents([(k, " ".join([*base, f"tail{k}"])) for k in range(n)])
    tables = {}
    plain = J.scratch_table

    def seen(df, name, **more):
        tables[name] = plain(df, name, **more)
        return tables[name]

    monkeypatch.setattr(J, "scratch_table", seen)
    got = J.jaccard_join(docs).collect()
    assert {r["class_id"] for r in got} == {0} and {r["n_links"] for r in got} == {n - 1}
    for name, table in tables.items():
        assert not [f for f in table.schema if f.dataType.typeName() == "array"], name
    assert tables["jaccard-left"].count() <= n * J.BANDS
    assert tables["jaccard-links"].count() <= n * J.BANDS
