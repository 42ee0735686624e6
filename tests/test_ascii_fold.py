import unicodedata

from tessera.functions.terms import GREEK, PUNCTUATION
from tessera.queries import QUERIES

TEXTS = ["plain", "café", "Straße ﬁsh ①", "“q” – ‘s’ −1", "ERα Δ ς", "𝐀𝟏 🄐 😀", "中文 ½", "é", "a\nb\tÅ", "", None]


def fold(text):
    if text is None or text.isascii():
        return text
    out = []
    for ch in text:
        plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        out.append(GREEK.get(ch) or PUNCTUATION.get(ch) or (plain if plain and plain.isascii() else "?"))
    return "".join(out)


def test_every_document(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "Größe")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r.doc_id), r.value) for r in QUERIES["ascii_fold"](spark, str(tmp_path)).collect())
    assert got == sorted((str(i), fold(t)) for i, t in rows)


def test_tables(spark):
    want = {r.doc_id: fold(r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id: r.value for r in QUERIES["ascii_fold"](spark, "/root/testdata/sf0.001").collect()} == want
