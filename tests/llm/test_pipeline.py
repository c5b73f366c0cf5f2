import uuid

import corpus_pipeline as P
from parquill.llm import _common as C
from tests.conftest import SF
from tests.llm import brute


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    before, kept = {r["doc_id"]: r for r in docs.collect()}, None
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        if name == "jaccard_join":
            expected = {i for i, c, _ in brute.jaccard([(r["doc_id"], r["text"]) for r in docs.collect()]) if i == c}
            assert {r["doc_id"] for r in rows} == expected
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            expected = {i for i, *_, c in brute.contaminated([(r["doc_id"], r["text"]) for r in docs.collect()], items) if not c}
            assert {r["doc_id"] for r in rows} == expected
        if name == "language_id":
            assert {r["doc_id"] for r in rows} >= {i for i, r in before.items() if len(r["text"].split()) > 40}
        if name != "bpe":
            assert out.columns == names
            docs = spark.createDataFrame(rows, out.schema)
        kept = {r["doc_id"] for r in rows}
    final = P.run(spark, SF).collect()
    assert {r["doc_id"] for r in final} == kept and len(final) == len(kept)
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "bpe"]


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


def test_language_keeps_short_and_unlabelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    short = docs.selectExpr("doc_id + 1000000 as doc_id", "concat(substring(text, 1, 3), ' 12345 67890 #') as text", "cast(null as string) as lang", "source", "n_chars")
    both = docs.select(*P.COLUMNS).unionByName(short)
    found = {r["doc_id"] for r in P.identify(spark, both, SF).collect()}
    assert found == {r["doc_id"] for r in both.collect() if any(c.isalpha() for c in r["text"])}
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars")
    assert P.identify(spark, unlabelled, SF).count() == docs.count()


def test_rows_and_not_ids(spark):
    """Repeated ids with different texts, null ids and texts, copies and clashing names, in every stage."""
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    one, two, near, leak = " ".join(words), " ".join(words[::-1]), " ".join(["edit", *words[1:]]), " ".join(["zz", *words[5:50:2]])
    rows = [(1, one), (5, one), (5, two), (5, two), (7, near), (None, one), (None, leak), (8, leak), (8, "clean words of eight"), (9, None), (None, None), (9, ""), (9, ""), (10, "1 2 3")]
    docs = spark.createDataFrame([(i, t, "xx", "s", 0, "clash", 1, 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, body string, group_id int, id_ int")
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert pairs(P.identify(spark, docs, SF)) == sorted([r for r in rows if r[1] and any(c.isalpha() for c in r[1])], key=str)
    assert pairs(P.drop_lines(spark, docs, SF)) == sorted(rows, key=str)
    assert pairs(P.one_of_each(spark, docs, SF)) == sorted([(1, one), (5, two), (8, leak), (8, "clean words of eight"), (9, None), (None, None), (9, ""), (9, ""), (10, "1 2 3")], key=str)
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    folder = f"{C.shared_dir(spark)}/bench-{uuid.uuid4().hex}"
    bench.write.parquet(f"{folder}/benchmark.parquet")
    assert pairs(P.decontaminate(spark, docs, folder)) == sorted([r for r in rows if r[1] != leak], key=str)
    encoded = [(r["doc_id"], r["n_tokens"]) for r in P.encode(spark, docs, SF).collect()]
    assert sorted((i for i, _ in encoded), key=str) == sorted((i for i, _ in rows), key=str) and encoded.count((9, 0)) == 3
