import re

import corpus_pipeline
from mailframe.llm import decontam, packing
from mailframe.llm.common import scratch_table
from tests.conftest import SF_SMALL
from tests.llm.test_jaccard_join import brute
from tests.llm.test_langid import GIBBERISH, GREEK


def _stages(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(scratch_table(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def test_stages_against_brute_force(spark, documents):
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first()["text"]
    rows = [tuple(r) for r in given]
    rows += [(9001, None, None), (9002, "", "en"), (9003, "12 %%", "en"), (9004, rows[0][1], "fr"), (9005, "Well now. " + item, "en")]
    rows += [(9006, rows[5][1] + " tail", "en"), (9004, rows[0][1], "fr")]
    foreign = [(9007, GREEK, None), (9008, GIBBERISH, None)]
    stages = _stages(spark, documents(rows + foreign))
    for s in stages[:-1]:
        assert s.columns == corpus_pipeline.COLUMNS
    kept = [sorted(r["doc_id"] for r in s.select("doc_id").collect()) for s in stages[:-1]]

    now = [(i, t) for i, t, _ in rows if t and re.search(r"[^\W\d_]", t)]
    assert kept[1] == sorted(i for i, _ in now)
    last = {}
    for i, t in now:
        last[t] = max(i, last.get(t, i))
    now = [(i, t) for t, i in last.items()]
    assert kept[2] == sorted(i for i, _ in now)
    now = [(i, t) for (i, t), b in zip(now, brute(now), strict=True) if b[1] == i]
    assert kept[3] == sorted(i for i, _ in now)

    def plain(t):
        return " ".join(re.findall(r"[^\W_]+", t.lower()))

    items = [plain(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaking = {i for i, t in now if any(f" {x} " in f" {plain(t)} " for x in items)}
    assert 9005 in leaking and not leaking & set(kept[4])
    assert len(set(kept[3]) - set(kept[4]) - leaking) <= 2  # passages that only in part stand in a document

    encode = packing.load_encoder(packing.tokenizer_path())
    tokens = sum(len(encode(t)) + 1 for i, t in now if i in set(kept[4]))
    pieces = stages[-1].collect()
    assert sum(r["length"] for r in pieces) == tokens and {r["doc_id"] for r in pieces} == set(kept[4])


def test_run_and_edges(spark, documents):
    empty = documents([(1, "a")]).limit(0)
    assert _stages(spark, empty)[-1].count() == 0
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
    assert decontam.WINDOW == 8


def test_null_and_shared_ids_and_clashing_columns(spark, documents, clashing):
    given = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").limit(60).collect()]
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first()["text"]
    clean = " ".join(reversed(given[7][1].split()))
    rows = [*given, (None, f"Well then. {item}", "en"), (None, clean, "en"), (None, clean, "en"), (None, None, None), (None, f"{given[12][1]} end", "en")]
    stages = _stages(spark, clashing(documents(rows)))
    for s in stages[1:-1]:
        assert s.columns == corpus_pipeline.COLUMNS
    texts = [{r["text"] for r in s.filter("doc_id IS NULL").collect()} for s in stages[1:-1]]
    # the near copy and the leaking row go, the other row of that id stays
    assert texts[1] == {f"Well then. {item}", clean, f"{given[12][1]} end"} and texts[2] == {f"Well then. {item}", clean} and texts[3] == {clean}
    assert stages[2].filter("doc_id IS NULL").count() == 3
    assert stages[-1].filter("doc_id IS NULL").agg({"length": "sum"}).first()[0] > 0


def test_the_language_found_is_what_follows_goes_by(spark, documents):
    given = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("lang = 'en'").select("text").collect()]
    german = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("lang = 'de'").select("text").collect()]
    rows = [(i, t, "en") for i, t in enumerate(given)] + [(1000 + i, t, "de") for i, t in enumerate(german)]
    long = max(given, key=len)
    words = long.split()
    rows += [(5000, " ".join(reversed(words)), "de"), (5001, " ".join(words[::2]), None)]  # English, wrongly labelled or not at all
    docs = documents(rows).coalesce(1)
    found = corpus_pipeline.language_id(spark, docs, SF_SMALL)
    assert found.columns == corpus_pipeline.COLUMNS
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1  # each text is scored once
    lang = {r["doc_id"]: r["lang"] for r in found.select("doc_id", "lang").collect()}
    assert lang[5000] == lang[5001] == "en" and set(lang.values()) == {"en", "de"}
    pieces = corpus_pipeline.pack(spark, scratch_table(found, "test-language").coalesce(1), SF_SMALL).collect()
    assert {r["doc_id"] for r in pieces} == set(lang)
    mixed = {}
    for r in pieces:
        mixed.setdefault(r["sequence_id"], set()).add(lang[r["doc_id"]])
    assert all(len(x) == 1 for x in mixed.values()) and len(mixed) > 2
