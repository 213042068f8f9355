import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailframe.llm import ctw
from mailframe.llm.queries import op9_lm_score
from tests.conftest import SF_ORACLE
from tests.llm.conftest import words


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode()


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Brute:
    """Context-tree weighting by recursion over dictionaries."""

    def __init__(self, texts, depth):
        self.depth = depth
        symbols = [(bytes(depth) + lower(t) + b"\0") for t in texts]
        self.count = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for s in symbols:
            for i in range(depth, len(s)):
                for node, bit in self.decisions(s[:i], s[i]):
                    for k, path in enumerate(node):
                        self.count[path][bit] += 1
                        if k:
                            self.children[node[k - 1]].add(path)
        self.memo = {}

    def decisions(self, before, byte):
        """For every bit: its path of nodes from the root down, and the bit."""
        contexts = [before[len(before) - d :] for d in range(self.depth + 1)]
        for k in range(8):
            yield [(c, (1 << k) | (byte >> (8 - k))) for c in contexts], (byte >> (7 - k)) & 1

    def weighted(self, node):
        if node not in self.memo:
            own = kt(*self.count[node])
            if not self.children[node]:
                self.memo[node] = own
            else:
                below = sum(self.weighted(c) for c in self.children[node])
                self.memo[node] = np.logaddexp(own, below) + math.log(0.5)
        return self.memo[node]

    def bits(self, text):
        s, total = bytes(self.depth) + lower(text) + b"\0", 0.0
        for i in range(self.depth, len(s)):
            for path, bit in self.decisions(s[:i], s[i]):
                chance = None
                for node in reversed(path):
                    if node not in self.count:
                        continue
                    a, b = self.count[node]
                    one = (b + 0.5) / (a + b + 1)
                    if chance is None:
                        chance = one
                    else:
                        stop = math.exp(math.log(0.5) + kt(a, b) - self.weighted(node))
                        chance = stop * one + (1 - stop) * chance
                chance = 0.5 if chance is None else chance
                total -= math.log2(chance if bit else 1 - chance)
        return total


def base(texts, text):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t).decode())
    c = Counter(w for t in texts for w in [*split(t), None])
    n, v = sum(c.values()), len(c)
    tokens = [*split(text), None]
    return len(tokens), sum(c[w] > 0 for w in tokens), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)


@pytest.mark.parametrize(("depth", "block", "row"), [(2, 16 << 20, 8192), (3, 1, 7), (5, 3000, 8192)])
def test_against_brute_force(spark, documents, depth, block, row, monkeypatch):
    monkeypatch.setattr(ctw, "BLOCK_BYTES", block)  # read by the closures that tasks get
    monkeypatch.setattr(ctw, "ROW_KEYS", row)
    rng = random.Random(depth)
    rows = [(i, words(rng, rng.randint(1, 30)).replace("ka", "KÄ")) for i in range(30)]
    rows += [(100, None), (101, ""), (102, "unseen: ÿ\t\x0b日本 \n"), (103, rows[3][1]), (None, "x y"), (104, " \n "), (105, "w " * 3000)]
    learn = lambda i: i is not None and i % 3 > 0
    texts = [t for i, t in rows if learn(i)]
    brute = Brute(texts, depth)
    got = ctw.score_documents(documents(rows), F.coalesce(F.col("doc_id") % 3 > 0, F.lit(False)), depth=depth).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t in rows if i == r["doc_id"])
        tokens, known, n, want = base(texts, text)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert r["base_score"] == pytest.approx(want, rel=1e-9)
        assert -r["score"] / math.log10(2) == pytest.approx(brute.bits(text), rel=2e-5)
        assert r["bits_per_byte"] == pytest.approx(brute.bits(text) / (len(lower(text)) + 1), rel=2e-5)


def test_probabilities_sum_to_one():
    rng = random.Random(4)
    texts = [lower(words(rng, 40)) for _ in range(10)]
    offs = np.cumsum([0, *map(len, texts)])
    gram, n = np.unique(ctw.grams(np.frombuffer(b"".join(texts), np.uint8), offs, 3)[0], return_counts=True)
    tree = ctw.Subtrees(gram, n, 3)
    for context in (b"\0\0\0", b"kal", b"zzz", b"o k"):
        gram = (np.uint64(int.from_bytes(context, "big")) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert (2.0 ** -tree.code_length(gram, ctw.upper_levels(*tree.above))).sum() == pytest.approx(1, abs=1e-4)


def test_other_text_takes_no_context_away(spark, documents):
    """However much else is learned, the estimates of a context that only these texts hold stay theirs."""
    rng = random.Random(9)
    own = [(i, "QZ" + words(rng, 20).replace(" ", "ZQ")) for i in range(5)]
    other = [(100 + i, words(rng, 400)) for i in range(40)]
    nodes = []
    for rows in (own, own + other):
        texts = ctw.in_blocks(documents(rows).select("doc_id", F.lit(True).alias("learn"), "text"))
        merged = ctw.merge(ctw.count(texts, 5, 16), 5, 3).filter(F.col("kind") == ctw.GRAM).toArrow()
        found = [zip(ctw._unpack(k, np.uint64).tolist(), ctw._unpack(n, np.int64).tolist(), strict=True) for k, n in zip(merged["keys"], merged["counts"], strict=True)]
        nodes.append({k: n for part in found for k, n in part})
    assert nodes[0].keys() <= nodes[1].keys() and all(nodes[1][k] >= n for k, n in nodes[0].items())
    assert sum(nodes[1].values()) == sum(len(lower(t)) + 1 for _, t in own + other)


def test_query_beats_the_token_model_on_held_out_rows(spark):
    got = op9_lm_score(spark, SF_ORACLE).toPandas()  # 2 MB of text; with a tenth of that the tree is still behind
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 10 == 0 for i in got["doc_id"]]).all()
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()


def test_nothing_to_learn_from(spark, documents, clashing):
    rows = clashing(documents([(1, "ab"), (2, None)]))
    got = {r["doc_id"]: r for r in ctw.score_documents(rows, F.lit(False)).collect()}
    assert got[1]["bits_per_byte"] == pytest.approx(8) and got[2]["n_tokens"] == 1 and got[2]["n_known"] == 0
    assert ctw.score_documents(rows.limit(0), F.lit(True)).count() == 0
