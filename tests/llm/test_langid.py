import numpy as np
from pyspark.sql import functions as F

from mailframe.llm import langid
from mailframe.llm.queries import op1_language_id
from tests.conftest import SF_ORACLE, SF_SMALL


def _bits(*texts):
    raw = [t.encode() for t in texts]
    return langid.presence(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))


def test_kernel_is_shared_grams_over_root_of_own():
    def grams(t):
        return {t[i : i + n] for n in range(1, langid.MAX_N + 1) for i in range(len(t) - n + 1)}

    a, b = "abcab", "bcabd"
    bits = _bits(a, b).astype(int)
    assert bits[0].sum() == len(grams(a)) and bits[1].sum() == len(grams(b))
    assert (bits[0] & bits[1]).sum() == len(grams(a) & grams(b))


def test_presence_does_not_cross_texts_and_ignores_case():
    alone, joined = _bits("Ab"), _bits("zz", "ab", "zz")
    assert (alone[0] == joined[1]).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    got = op1_language_id(spark, SF_ORACLE).join(docs, "doc_id").filter("held_out").toPandas()
    assert len(got) > 150 and (got["lang_pred"] == got["lang"]).mean() >= 0.98
    assert got["score"].between(0, 1).all()


def test_edge_rows(spark, documents, clashing):
    known = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text")
    model = langid.fit(known)
    text = known.filter("label = 'de'").first()["text"]
    rows = clashing(documents([(1, None), (2, ""), (3, "123 !?"), (4, text), (4, text), (None, text), (5, text * 40)]))
    got = rows.select("doc_id", langid.identify(rows, model, F.col("text")).alias("g")).select("doc_id", "g.*").collect()
    assert [r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert {r["lang_pred"] for r in got if r["doc_id"] not in (1, 2, 3)} == {"de"}
    empty = rows.limit(0)
    assert empty.select(langid.identify(empty, model, F.col("text"))).count() == 0


def test_no_labels(spark, documents):
    rows = documents([(1, "some text", None)])
    model = langid.fit(rows.select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text"))
    assert model is None
    assert rows.select(langid.identify(rows, model, F.col("text"))["lang_pred"]).first()[0] == "und"


GREEK = "Η γλώσσα αυτή δεν έχει μαθευτεί ποτέ από το μοντέλο και πρέπει να απορριφθεί"
GIBBERISH = "xqzt wvkp jjrf zzqx bbtk pqlm wxyz kkvv hgfd sdfg"


def test_foreign_texts_are_rejected_and_all_others_stay(spark, documents, clashing):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs.select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text"))
    assert docs.filter(F.col("text").rlike(r"\p{L}") & ~langid.in_learned_language(docs, model, F.col("text"))).count() == 0
    rows = clashing(documents([(1, GREEK), (2, GIBBERISH), (3, None), (4, ""), (5, "12 %"), (6, "это русский текст")]))
    assert not [r for r in rows.select(langid.in_learned_language(rows, model, F.col("text"))).collect() if r[0]]
    assert rows.filter(langid.in_learned_language(rows, None, F.col("text"))).count() == 3


def test_long_texts_are_scored_in_pieces(spark, documents, monkeypatch):
    cut, first = langid.pieces(np.array([0, 0, 10, 10 + 2 * langid.PIECE + 1]))
    assert cut.tolist() == [0, 0, 10, 10 + langid.PIECE, 10 + 2 * langid.PIECE, 11 + 2 * langid.PIECE] and first.tolist() == [0, 1, 2]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text")
    text = {lang: " ".join(r["text"] for r in docs.filter(docs["label"] == lang).limit(40).collect()) for lang in ("de", "en")}
    model = langid.fit(docs)
    rows = documents([(1, text["de"] * 40), (2, text["en"] * 40), (3, GREEK * 20000)])
    got = rows.select("doc_id", langid.identify(rows, model, F.col("text")).alias("g")).select("doc_id", "g.*").orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got[:2]] == ["de", "en"]
    assert min(r["coverage"] for r in got[:2]) > model.bound > got[2]["coverage"]


def test_prediction_against_plain_kernel_ridge(spark, documents):
    """The model's scores equal ridge regression on explicit Nyström features of the blended-spectrum kernel."""
    texts = ["der hund und die katze", "das haus und der garten", "the dog and the cat", "the house and the garden"]
    labels = ["de", "de", "en", "en"]

    def grams(t):
        t = f"{t}"
        return {t[i : i + n] for n in range(1, langid.MAX_N + 1) for i in range(len(t) - n + 1)} - {" " * n for n in range(1, 5)}

    kernel = lambda a, b: len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b)))
    full = np.array([[kernel(a, b) for b in texts] for a in texts])
    value, vector = np.linalg.eigh(full)
    phi = full @ vector / np.sqrt(value)
    target = np.array([[1.0, -1.0], [1.0, -1.0], [-1.0, 1.0], [-1.0, 1.0]])
    weights = np.linalg.solve(phi.T @ phi + langid.RIDGE * 4 * np.eye(4), phi.T @ target)
    model = langid.fit_kernel_ridge(_bits(*texts), labels)
    new = "der garten and the hund"
    want = np.array([kernel(new, t) for t in texts]) @ vector / np.sqrt(value) @ weights
    assert np.allclose(model.scores(_bits(new))[0], want, atol=2e-3)
    assert model.labels == ["de", "en"] and len(model.landmarks) == 4
