import numpy as np
from pyspark.sql import functions as F

from shelflens.llm import language_id as L
from shelflens.llm.queries import op1_language_id
from tests_llm import SF, frame, held_out


def test_held_out_accuracy(spark):
    rows = op1_language_id(spark, SF).toPandas().merge(frame(SF, "documents"), on="doc_id")
    assert (rows.held_out == rows.doc_id.map(held_out)).all()
    assert rows.score.between(0, 1).all()
    right = (rows.lang_pred == rows.lang)
    assert right[rows.held_out].mean() > 0.9  # 200 documents teach little; see README for larger tables
    assert right[rows.held_out & rows.accepted].mean() >= right[rows.held_out].mean()


def test_sizes_are_those_of_whole_texts():
    model = L.LanguageModel(("x", "y"), (b"abc abd abe " * 40, b"xyz xyw xyv " * 40))
    text = "abc abd " * 3000
    size = L.sizes([text, None, ""], model)
    raw, total = L.normal(text), np.zeros(2, int)
    for a in range(0, len(raw), L.PIECE):
        total += L.sizes([raw[a:a + L.PIECE].decode()], model)[0]
    assert (size[0] - total).tolist() == [0, 0] or abs(size[0] - total).max() < 60  # pieces may lose a border space
    assert size[0, 0] < size[0, 1] and size[1].tolist() == size[2].tolist() == [0, 0]


def test_narrow_margins_are_rejected():
    size = np.array([[100, 150], [100, 100], [1000, 1003]])
    names, score, margin, ok = L.decide(size, np.array([True, True, True]), ("en", "fr"))
    assert names == ["en", "en", "en"] and ok.tolist() == [True, False, False] and score[1] == 0.5
    assert L.decide(size, np.array([False] * 3), ("en", "fr"))[0] == ["und"] * 3


def test_edges(edge, none):
    out = L.identify(edge, L.train(edge))
    rows = out.collect()
    assert len(rows) == edge.count() and out.columns[:2] == ["doc_id", "text"] and "a.b" in out.columns
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred == "en"
    assert L.identify(none, L.train(none)).count() == 0
    assert {r.lang_pred for r in L.identify(edge, L.train(none)).collect()} == {"und"}
    assert L.train(edge.withColumn("lang", F.lit(None).cast("string"))).languages == ()


def test_dictionaries_take_windows_of_the_whole_text(spark):
    from shelflens.llm.common import windows
    long = "".join(chr(0x4E00 + k) for k in range(16_000))
    df = spark.createDataFrame([(1, long), (2, "kurz"), (3, ""), (4, None)], "h long, text string")
    got = {r.h: r.w for r in df.select("h", windows(F.col("text"), 1000, 4, F.col("h")).alias("w")).collect()}
    assert got[2] == "kurz" and got[3] == "" and got[4] is None
    cut = got[1].split(" ")
    assert [len(c) for c in cut] == [250] * 4 and all(c in long for c in cut)
    assert [long.index(c) // 4000 for c in cut] == [0, 1, 2, 3]
    # the language shows only behind the first thousands of characters
    rows = [(k, "12 34 " * 1500 + t * 900, lang) for k in range(30) for t, lang in ((f"abc abd{k} ", "x"), (f"xyz xyw{k} ", "y"))]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert L.decide(L.sizes(["abc abd " * 50, "xyz xyw " * 50], model), np.array([True, True]), model.languages)[0] == ["x", "y"]


def test_by_brute_force(spark):
    """Every text of the table compressed one by one with nothing but the library."""
    import zstandard as z
    docs = frame(SF, "documents")
    model = L.train(spark.read.parquet(f"{SF}/documents.parquet"))
    got = L.identify(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), model).toPandas().set_index("doc_id")
    parameters = z.ZstdCompressionParameters.from_level(L.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    tools = [z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=parameters) for d in model.dictionaries]
    for r in docs.itertuples():
        letters = [c if c.isalpha() else " " for c in (r.text or "").lower()]
        if not any(c != " " for c in letters):
            continue
        raw = L.normal(r.text)
        size = [sum(len(t.compress(raw[a:a + L.PIECE])) for a in range(0, len(raw), L.PIECE)) for t in tools]
        best = min(range(len(size)), key=lambda k: (size[k], k))
        second = min(x for k, x in enumerate(size) if k != best)
        assert got.lang_pred[r.doc_id] == model.languages[best]
        assert got.accepted[r.doc_id] == ((second - size[best]) / size[best] >= L.MIN_MARGIN)
